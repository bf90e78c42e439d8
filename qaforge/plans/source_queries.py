"""Sources, sinks and adapters: test tables are written to files in the shared folder and read back through readers and adapters."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import values
from ..session import shared_dir, table
from ..sources import adapters, readers, sinks
from ..sources.adapters import Kind
from . import split_queries
from .sqlbits import strip


def _qa(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "qa_samples")


def _folder(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/qaforge/{uuid.uuid4().hex}"


_FIELDS = ("row_id", "id", "question", "context", "options", "reference_answer")


def json_lines_by_source(spark: SparkSession, d: str) -> DataFrame:
    """One folder of JSON lines per source, written by executors and read back; values with line breaks, quotes and NULLs survive."""
    to = _folder(spark)
    sinks.write_json_lines(_qa(spark, d).select("source", *_FIELDS), to, ["source"])
    back = readers.json_lines(spark, f"{to}/*", "row_id bigint, id string, question string, context string, options array<string>, reference_answer string")
    return back.select("row_id", "id", F.regexp_replace("parent", "^source=", "").alias("source"), F.md5("question").alias("question_md5"), F.md5("context").alias("context_md5"), F.array_join("options", "|").alias("options"), "reference_answer")


def split_files(spark: SparkSession, d: str) -> DataFrame:
    """Split, write a folder per source and split, and count what stands in each."""
    to = _folder(spark)
    n = sinks.write_json_lines(split_queries.assigned(spark, d).select("source", "split", "row_id"), to, ["source", "split"])
    back = readers.json_lines(spark, f"{to}/*/*", "row_id bigint").withColumn("split", F.regexp_replace("parent", "^split=", ""))
    return back.groupBy("split").agg(F.count("*").alias("n")).withColumn("written", F.lit(n).cast("bigint"))


def csv_rows(spark: SparkSession, d: str) -> DataFrame:
    """CSV with quotes, commas and line breaks in fields, read with positions."""
    to = _folder(spark)
    q = _qa(spark, d).select(F.col("row_id").cast("string").alias("row_id"), F.coalesce("question", F.lit("")).alias("question"), F.coalesce("context", F.lit("")).alias("context"))
    q.write.csv(to, header=True, quote='"', escape='"', emptyValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    back = readers.csv_files(spark, to, ["row_id", "question", "context"])
    return back.select(F.col("row_id").cast("bigint").alias("row_id"), F.md5("question").alias("question_md5"), F.md5("context").alias("context_md5"))


def parquet_positions(spark: SparkSession, d: str) -> DataFrame:
    df = readers.parquet_files(spark, f"{d}/orders.parquet")
    return df.agg(F.count("*").alias("n"), F.countDistinct("file_name", "row_index").alias("places"), F.countDistinct("o_orderkey").alias("orders"))


def shard_files(spark: SparkSession, d: str) -> DataFrame:
    """Files of 1,000 rows each in order, named by their bounds, and read back in that order."""
    to = _folder(spark)
    sinks.write_shards(table(spark, d, "customer").select("c_custkey", "c_name"), to, ["c_custkey"], 1000, "customers")
    s = readers.shards(spark, to)
    return s.select(F.get_json_object("value", "$.c_custkey").cast("bigint").alias("c_custkey"), F.get_json_object("value", "$.c_name").alias("c_name"), "shard_start", "shard_end")


def last_line_of_id(spark: SparkSession, d: str) -> DataFrame:
    """Two files of a cache in which ids repeat: the later file's line holds."""
    to = _folder(spark)
    c = table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("id"), F.col("c_custkey").alias("n"))
    sinks.write_shards(c.withColumn("v", F.lit("old")), f"{to}/a", ["n"], 10**9, "cache")
    sinks.write_shards(c.where("n % 3 = 0").withColumn("v", F.lit("new")), f"{to}/b", ["n"], 10**9, "later")
    v = readers.last_by_id(readers.json_lines(spark, f"{to}/*"))
    return v.select("id", F.get_json_object("value", "$.v").alias("v"))


def replaced_output(spark: SparkSession, d: str) -> DataFrame:
    """An output is written, replaced, and a job that fails leaves it as it is."""
    to = _folder(spark)
    r = table(spark, d, "nation").select("n_nationkey", "n_name")
    sinks.write_json_lines(r, to)
    sinks.write_json_lines(r.where("n_nationkey % 2 = 0"), to)
    try:
        sinks.write_json_lines(r.withColumn("bad", F.raise_error(F.lit("planned failure"))), to)
    except Exception as e:  # noqa: BLE001 - the failure is the point
        if "planned failure" not in str(e):
            raise
    return readers.json_lines(spark, to, "n_nationkey int, n_name string").select("n_nationkey", "n_name")


def json_report(spark: SparkSession, d: str) -> DataFrame:
    """A report of counts per source and task, written as one JSON document and read back."""
    to = f"{_folder(spark)}.json"
    counts = _qa(spark, d).groupBy(F.coalesce("source", F.lit("")).alias("source"), F.coalesce(F.lower(F.trim("task_type")), F.lit("none")).alias("task_type")).agg(F.count("*").alias("n"))
    sinks.write_report(spark, to, sinks.figures(counts, ["source", "task_type"]))
    back = F.from_json(F.lit(sinks.read_text(spark, to)), "map<string,map<string,struct<n:bigint>>>")
    one = spark.range(1).select(F.explode(back).alias("source", "tasks"))
    return one.select("source", F.explode("tasks").alias("task_type", "x")).select("source", "task_type", "x.n")


def published(spark: SparkSession, d: str) -> DataFrame:
    """Two artifacts under fixed names, and the rows of each."""
    j = table(spark, d, "judged_rows").select("id", F.coalesce(F.col("judge_success") & (F.col("judge.score") == 1), F.lit(False)).alias("kept"))
    n = sinks.publish({"train.keep": j.where("kept"), "train.drop": j.where("not kept")}, _folder(spark))
    return spark.createDataFrame(sorted(n.items()), "artifact string, n bigint")


def values_as_text(spark: SparkSession, d: str) -> DataFrame:
    """Typed values as text and as JSON: lists of lists, Booleans, times, maps with number keys."""
    o = table(spark, d, "orders").select(
        "o_orderkey", F.array(F.array(F.col("o_orderpriority"), F.lit(" ")), F.array(F.lit(""), F.col("o_orderstatus"))).alias("nested"), (F.col("o_orderkey") % 2 == 0).alias("even"),
        F.create_map(F.col("o_orderkey"), F.col("o_orderdate").cast("date")).alias("dates"),
    )
    kinds = {f.name: f.dataType for f in o.schema.fields}
    as_text = lambda c: values.to_text(F.col(c), kinds[c])
    return o.select("o_orderkey", as_text("nested").alias("nested"), as_text("even").alias("even"), as_text("dates").alias("dates"))


def _documents(spark: SparkSession, df: DataFrame, names: dict[str, int], key: str = "row_id") -> str:
    """df as JSON arrays, one file per name: rows by their key modulo the number of names."""
    to = _folder(spark)
    sinks.write_json_array(df, to, {n: F.col(f"_{key}") % len(names) == k for n, k in names.items()})
    return to


def _kind(source: str, task: str = "reasoning") -> Kind:
    return Kind(source, task, "domain", "en")


def _shown(df: DataFrame) -> DataFrame:
    return df.select("id", "raw_split", "question", F.md5("context").alias("context_md5"), F.array_join("options", "|").alias("options"), "reference_answer")


def table_text_adapter(spark: SparkSession, d: str) -> DataFrame:
    q = _qa(spark, d).where("source = 'finqa'")
    doc = q.select(
        F.col("row_id").alias("_row_id"), F.concat(F.lit("r"), F.col("row_id").cast("string")).alias("id"), F.array("context", F.lit("second")).alias("pre_text"), F.array(F.array(F.lit("a"), F.lit("")), F.array(F.lit("b"), F.lit("1"))).alias("table"),
        F.array().cast("array<string>").alias("post_text"), F.struct("question", F.when(F.col("row_id") % 2 == 0, F.col("reference_answer")).otherwise("").alias("answer"), F.lit("spare").alias("final_result")).alias("qa"),
    )
    return _shown(adapters.table_text_qa(spark, _documents(spark, doc, {"train": 0, "dev": 1, "test": 2}), _kind("finqa")))


def dialogue_adapter(spark: SparkSession, d: str) -> DataFrame:
    q = _qa(spark, d).where("source = 'convfinqa'")
    turn = lambda k, ask, say: F.struct(ask.alias("question"), say.alias("answer")).alias(f"qa_{k}")
    doc = q.select(
        F.col("row_id").alias("_row_id"), F.concat(F.lit("r"), F.col("row_id").cast("string"), F.lit("_1")).alias("id"), F.array("context").alias("pre_text"), F.array(F.array(F.lit("a"), F.lit("b"))).alias("table_ori"), F.array(F.lit("end")).alias("post_text"),
        turn(0, F.lit("before?"), F.lit("zero")), turn(1, F.col("question"), F.col("reference_answer")), turn(2, F.lit("after?"), F.lit("two")),
    )
    return _shown(adapters.dialogue_qa(spark, _documents(spark, doc, {"train_turn": 0, "dev_turn": 1}), _kind("convfinqa")))


def table_paragraph_adapter(spark: SparkSession, d: str) -> DataFrame:
    q = _qa(spark, d).where("source = 'tatqa'")
    ask = lambda k, words: F.struct(F.concat(F.lit("u"), F.col("row_id").cast("string"), F.lit(f"-{k}")).alias("uid"), F.col("question"), words.alias("answer"), F.lit("span").alias("answer_type"), F.lit("thousand").alias("scale"))
    doc = q.select(
        F.col("row_id").alias("_row_id"), F.struct(F.lit("t").alias("uid"), F.array(F.array(F.lit("x"), F.lit("y"))).alias("table")).alias("table"), F.array(F.struct(F.col("context").alias("text")), F.struct(F.lit("more").alias("text"))).alias("paragraphs"),
        F.array(ask(0, F.array("reference_answer", F.lit(""), F.lit("z"))), ask(1, F.array(F.lit("second")))).alias("questions"),
    )
    return _shown(adapters.table_paragraph_qa(spark, _documents(spark, doc, {"tatqa_dataset_train": 0, "tatqa_dataset_dev": 1}), _kind("tatqa"), "tatqa_dataset_"))


def exam_csv_adapter(spark: SparkSession, d: str) -> DataFrame:
    to = _folder(spark)
    q = _qa(spark, d).where("source = 'financeiq'")
    cell = lambda c: F.coalesce(F.col(c), F.lit(""))
    rows = q.select(F.col("row_id").cast("string").alias("id"), cell("question").alias("Question"), F.lit("one").alias("A"), F.lit("").alias("B"), F.concat(F.lit('three, "3" '), F.col("row_id").cast("string")).alias("C"), cell("reference_answer").alias("Answer"))
    rows.coalesce(1).write.csv(f"{to}/test", header=True, quote='"', escape='"', emptyValue="")
    got = adapters.exam_csv(spark, to, _kind("financeiq", "mcq"), ["id", "Question", "A", "B", "C", "Answer"])
    return _shown(got).withColumn("id", F.regexp_extract("id", "_([0-9]+)$", 1))


def instruction_adapters(spark: SparkSession, d: str) -> DataFrame:
    """Instruction data from Parquet files and from a JSON array, as one table; ids made of positions are left out."""
    to = _folder(spark)
    q = _qa(spark, d)
    made = lambda df: df.select(F.col("question").alias("instruction"), F.col("context").alias("input"), F.col("reference_answer").alias("output"), F.col("row_id").alias("_row_id"))
    made(q.where("source = 'fincuge_instruction'")).withColumn("task", F.lit("FINQA")).drop("_row_id").write.parquet(f"{to}/a")
    arrays = _documents(spark, made(q.where("source = 'finance_alpaca'")), {"all": 0})
    jobs = [lambda s: adapters.instruction_parquet(s, f"{to}/a", _kind("fincuge_instruction", "instruction")), lambda s: adapters.instruction_json(s, arrays, _kind("finance_alpaca", "instruction"))]
    return adapters.normalise(spark, jobs).select("source", "question", F.md5("context").alias("context_md5"), F.md5("reference_answer").alias("answer_md5"))


QUERIES = {
    f.__name__: f
    for f in (
        json_lines_by_source, split_files, csv_rows, parquet_positions, shard_files, last_line_of_id, replaced_output, json_report, published, values_as_text, table_text_adapter, dialogue_adapter,
        table_paragraph_adapter, exam_csv_adapter, instruction_adapters,
    )
}

_SECTIONS = lambda *parts: "array_to_string(list_filter([" + ", ".join(parts) + "], lambda x: x <> ''), chr(10) || chr(10))"
_Q, _C, _R = strip("question"), strip("context"), strip("reference_answer")

ORACLES = {
    "json_lines_by_source": "select row_id, id, source, md5(question) as question_md5, md5(context) as context_md5, array_to_string(options, '|') as options, reference_answer from qa_samples",
    "csv_rows": "select row_id, md5(coalesce(question, '')) as question_md5, md5(coalesce(context, '')) as context_md5 from qa_samples",
    "parquet_positions": "select count(*) as n, count(*) as places, count(distinct o_orderkey) as orders from orders",
    "shard_files": """select c_custkey, c_name, (o - o % 1000)::bigint as shard_start, least(o - o % 1000 + 1000, n)::bigint as shard_end from (
        select c_custkey, c_name, row_number() over (order by c_custkey) - 1 as o, count(*) over () as n from customer)""",
    "last_line_of_id": "select cast(c_custkey as varchar) as id, case when c_custkey % 3 = 0 then 'new' else 'old' end as v from customer",
    "replaced_output": "select n_nationkey, n_name from nation where n_nationkey % 2 = 0",
    "json_report": "select coalesce(source, '') as source, coalesce(lower(trim(task_type)), 'none') as task_type, count(*) as n from qa_samples group by all",
    "published": "select case when coalesce(judge_success and judge.score = 1, false) then 'train.keep' else 'train.drop' end as artifact, count(*) as n from judged_rows group by all",
    "values_as_text": """select o_orderkey, concat(o_orderpriority, ' | ', o_orderstatus) as nested, case when o_orderkey % 2 = 0 then 'True' else 'False' end as even,
        concat('{"', o_orderkey, '":"', strftime(o_orderdate, '%Y-%m-%d'), '"}') as dates from orders""",
    "table_text_adapter": f"""select concat('r', row_id) as id, case row_id % 3 when 0 then 'train' when 1 then 'dev' else 'test' end as raw_split, {_Q} as question,
        md5({_SECTIONS(strip("concat_ws(chr(10), context, 'second')"), "'a | ' || chr(10) || 'b | 1'")}) as context_md5, '' as options,
        case when row_id % 2 = 0 and {_R} <> '' then {_R} else 'spare' end as reference_answer from qa_samples where source = 'finqa'""",
    "dialogue_adapter": f"""select concat('r', row_id, '_1') as id, case row_id % 2 when 0 then 'train' else 'dev' end as raw_split, {_Q} as question,
        md5({_SECTIONS(_C, "'a | b'", "'end'", "'qa_0 question: before?' || chr(10) || 'qa_0 answer: zero'")}) as context_md5, '' as options, {_R} as reference_answer from qa_samples where source = 'convfinqa'""",
    "table_paragraph_adapter": f"""select concat('u', row_id, '-', k) as id, case row_id % 2 when 0 then 'train' else 'dev' end as raw_split, {_Q} as question,
        md5({_SECTIONS(strip("concat(coalesce(context, ''), chr(10), 'more')"), "'x | y'")}) as context_md5, '' as options,
        case when k = 1 then 'second' when {_R} = '' then 'z' else concat({_R}, ' | z') end as reference_answer from qa_samples, (values (0), (1)) v(k) where source = 'tatqa'""",
    "exam_csv_adapter": f"""select cast(row_id as varchar) as id, 'test' as raw_split, {_Q} as question, md5('') as context_md5, concat('A. one|C. three, "3" ', row_id) as options, {_R} as reference_answer
        from qa_samples where source = 'financeiq'""",
    "instruction_adapters": f"select source, {_Q} as question, md5({_C}) as context_md5, md5({_R}) as answer_md5 from qa_samples where source in ('fincuge_instruction', 'finance_alpaca')",
}
ORACLES["split_files"] = f"select split, sum(n)::bigint as n, sum(sum(n)) over ()::bigint as written from ({split_queries.ORACLES['split_dataset_counts']}) group by split"
