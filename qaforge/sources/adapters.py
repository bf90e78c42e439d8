"""Adapters: raw data sets to normalised samples (N1-N10). Each is scan, explode and project over VARIANT or string columns.

Every adapter returns (id, source, raw_split, task_type, task_domain, language, question, context, options, reference_answer,
metadata); split is empty until ``operators.splits`` assigns it. metadata is JSON text.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, fields

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import merge
from . import readers, sinks


@dataclass(frozen=True)
class Kind:
    """Constant fields of a data set."""

    source: str
    task_type: str
    task_domain: str
    language: str


def _v(c: Column, path: str, kind: str = "string") -> Column:
    return F.try_variant_get(c, path, kind)


def _scalar(c: Column, path: str) -> Column:
    """Text of a scalar; a list's items joined by ' | ' (H1); '' if absent. Numbers keep the text they have in JSON."""
    items = _v(c, path, "array<string>")
    return F.coalesce(F.when(items.isNotNull(), T.joined_texts(items, " | ")), T.strip(_v(c, path)), F.lit(""))


def _lines(c: Column, path: str) -> Column:
    return F.coalesce(F.array_join(_v(c, path, "array<string>"), "\n"), F.lit(""))


def _table(c: Column, path: str) -> Column:
    return T.table_text(_v(c, path, "array<array<string>>"))


def gold_info(primary: Column, intermediate: Column | None = None, execution: Column | None = None, answer_type: Column | None = None, answer_from: Column | None = None) -> Column:
    """STRUCT of what is known of the gold answer (H9)."""
    empty = F.lit("")
    return F.struct(
        T.strip(primary).alias("primary_answer"),
        (T.text_list(intermediate) if intermediate is not None else F.array().cast("array<string>")).alias("intermediate_answers"),
        (T.strip(execution) if execution is not None else empty).alias("execution_answer"),
        (T.strip(answer_type) if answer_type is not None else empty).alias("answer_type"),
        (T.strip(answer_from) if answer_from is not None else empty).alias("answer_from"),
    )


def sample(df: DataFrame, kind: Kind, id: Column, raw_split: Column, question: Column, context: Column, options: Column | None, answer: Column, gold: Column, **extra: Column) -> DataFrame:
    """Normalised columns in their fixed order (N10); an empty language is 'unknown'."""
    meta = F.to_json(F.struct(T.strip(raw_split).alias("raw_split"), *(c.alias(k) for k, c in extra.items()), gold.alias("gold_answer_info")))
    return df.select(
        T.strip(id).alias("id"), F.lit(kind.source).alias("source"), T.strip(raw_split).alias("raw_split"), F.lit(kind.task_type).alias("task_type"),
        F.lit(kind.task_domain).alias("task_domain"), F.lit(kind.language or "unknown").alias("language"), T.strip(question).alias("question"), T.strip(context).alias("context"),
        (options if options is not None else F.array().cast("array<string>")).alias("options"), T.strip(answer).alias("reference_answer"), meta.alias("metadata"),
    )


def _id(v: Column, path: str, *parts: Column | str) -> Column:
    made = F.concat_ws("_", *(F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts))
    return T.first_filled(_v(v, path), made)


def table_text_qa(spark: SparkSession, path: str, kind: Kind) -> DataFrame:
    """Question on text and a table; one JSON array per split."""
    df, v = readers.json_array(spark, path), F.col("value")
    answer = T.first_filled(_scalar(v, "$.qa.answer"), _scalar(v, "$.qa.final_result"), _scalar(v, "$.qa.exe_ans"), _scalar(v, "$.answer"))
    context = T.sections(_lines(v, "$.pre_text"), _table(v, "$.table"), _lines(v, "$.post_text"))
    return sample(df, kind, _id(v, "$.id", kind.source, F.col("stem"), F.col("row_index")), F.col("stem"), _v(v, "$.qa.question"), context, None, answer, gold_info(answer, execution=_scalar(v, "$.qa.exe_ans")),
                  program=T.first_filled(_v(v, "$.qa.program_re"), _v(v, "$.qa.program")))


def dialogue_qa(spark: SparkSession, path: str, kind: Kind, compat: bool = False) -> DataFrame:
    """Multi-turn question answering.

    The active turn is the plain qa object, else the turn that the id ends in, else the last turn. Earlier turns become history
    in the context; with a plain qa object all numbered turns do. compat compares turn names as strings and stops at the first
    that is not smaller, as some pipelines did, so that histories end early from turn 10 on.
    """
    df, v = readers.json_array(spark, path), F.col("value")
    turns = F.map_filter(F.try_variant_get(v, "$", "map<string,variant>"), lambda k, _: k.rlike(r"^qa_[0-9]+$"))
    number = lambda e: F.regexp_extract(e["key"], "([0-9]+)$", 1).cast("int")
    by_number = F.array_sort(F.map_entries(turns), lambda a, b: number(a) - number(b))
    plain = F.coalesce(F.startswith(F.schema_of_variant(F.try_variant_get(v, "$.qa", "variant")), F.lit("OBJECT")), F.lit(False))
    from_id = F.concat(F.lit("qa_"), F.regexp_extract(T.filled(_v(v, "$.id")), r"_([0-9]+)$", 1).try_cast("int").cast("string"))
    last = F.try_element_at(by_number, F.lit(-1))["key"]
    df = df.withColumn("_turns", by_number).withColumn("_key", F.when(plain, F.lit(None).cast("string")).when(F.map_contains_key(turns, F.coalesce(from_id, F.lit(""))), from_id).otherwise(last))
    qa = F.when(plain, F.try_variant_get(v, "$.qa", "variant")).otherwise(F.try_element_at(turns, F.coalesce(F.col("_key"), F.lit(""))))
    df = df.withColumn("_qa", qa)
    now = F.regexp_extract(F.col("_key"), "([0-9]+)$", 1).cast("int")
    if compat:
        stop = F.array_position(F.transform(F.col("_turns"), lambda e: e["key"] >= F.col("_key")), F.lit(True))
        earlier = F.when(F.col("_key").isNull() | (stop == 0), F.col("_turns")).otherwise(F.slice(F.col("_turns"), 1, F.greatest(stop - 1, F.lit(0)).cast("int")))
    else:
        earlier = F.filter(F.col("_turns"), lambda e: F.col("_key").isNull() | (number(e) < now))
    one = lambda e, what: F.when(_scalar(e["value"], f"$.{what}") != "", F.concat(e["key"], F.lit(f" {what}: "), _scalar(e["value"], f"$.{what}")))
    history = F.array_join(F.array_compact(F.flatten(F.transform(earlier, lambda e: F.array(one(e, "question"), one(e, "answer"))))), "\n")
    q = F.col("_qa")
    answer = T.first_filled(_scalar(q, "$.answer"), _scalar(q, "$.exe_ans"))
    table = F.coalesce(F.nullif(_table(v, "$.table_ori"), F.lit("")), _table(v, "$.table"))
    full = lambda c: F.when(F.size(c) > 0, c)
    own = F.try_element_at(F.try_variant_get(v, "$.annotation", "map<string,variant>"), F.concat(F.lit("answer_list_"), now.cast("string")))
    steps = F.coalesce(full(F.try_variant_get(own, "$", "array<string>")), *(full(_v(c, p, "array<string>")) for c, p in ((q, "$.answer_list"), (v, "$.annotation.answer_list"), (q, "$.exe_ans_list"), (v, "$.annotation.exe_ans_list"))))
    raw_split = F.regexp_replace("stem", "_turn", "")
    context = T.sections(_lines(v, "$.pre_text"), table, _lines(v, "$.post_text"), history)
    return sample(df, kind, _id(v, "$.id", kind.source, raw_split, F.col("row_index")), raw_split, _v(q, "$.question"), context, None, answer, gold_info(answer, steps, _scalar(q, "$.exe_ans")),
                  current_turn_key=T.filled(F.col("_key")), program=T.first_filled(_v(q, "$.program_re"), _v(q, "$.program")))


def table_paragraph_qa(spark: SparkSession, path: str, kind: Kind, prefix: str = "") -> DataFrame:
    """Several questions on one table and its paragraphs (N3): one row per question; documents without any give none."""
    df, v = readers.json_array(spark, path), F.col("value")
    df = df.select("stem", "row_index", "value", F.posexplode(_v(v, "$.questions", "array<variant>")).alias("q_index", "q"))
    v, q = F.col("value"), F.col("q")
    paragraphs = F.array_join(F.transform(F.coalesce(_v(v, "$.paragraphs", "array<variant>"), F.array().cast("array<variant>")), lambda p: T.filled(_v(p, "$.text"))), "\n")
    raw_split = F.replace("stem", F.lit(prefix), F.lit("")) if prefix else F.col("stem")
    answer = _scalar(q, "$.answer")
    return sample(df, kind, _id(q, "$.uid", kind.source, raw_split, F.col("row_index"), F.col("q_index")), raw_split, _v(q, "$.question"), T.sections(paragraphs, _table(v, "$.table.table")), None, answer,
                  gold_info(answer, answer_type=_v(q, "$.answer_type"), answer_from=_v(q, "$.answer_from")), table_uid=T.filled(_v(v, "$.table.uid")), scale=T.filled(_v(q, "$.scale")))


_LETTERS = ("A", "B", "C", "D", "E", "F", "G")


def exam_csv(spark: SparkSession, path: str, kind: Kind, columns: list[str]) -> DataFrame:
    """Exam questions in CSV files, the split being the folder (N4). columns names the header's fields; an unnamed first one is ''."""
    df = readers.csv_files(spark, path, columns)
    col = lambda c: F.col(c) if c in df.columns else F.lit("")
    row = T.first_filled(col("_unnamed"), col("id"), F.col("row_index"))
    return sample(df, kind, F.concat_ws("_", F.lit(kind.source), F.col("parent"), F.col("stem"), row), F.col("parent"), col("Question"), F.lit(""), T.lettered_options(*map(col, _LETTERS)), col("Answer"), gold_info(col("Answer")), file_name=F.col("file_name"))


def exam_zip(spark: SparkSession, path: str, kind: Kind, columns: list[str]) -> DataFrame:
    """Exam questions in CSV members of a zip archive, the split being the first folder."""
    df = readers.zip_csv(spark, path, columns)
    col = lambda c: F.col(c) if c in df.columns else F.lit("")
    first, stem = F.regexp_extract("member", "^([^/]+)", 1), F.regexp_extract("member", r"([^/]+?)(?:\.[^./]*)?$", 1)
    row = T.first_filled(col("id"), F.col("row_index"))
    return sample(df, kind, F.concat_ws("_", F.lit(kind.source), first, stem, row), first, col("question"), F.lit(""), T.lettered_options(*map(col, _LETTERS)), col("answer"), gold_info(col("answer")), member_name=F.col("member"))


def instruction_parquet(spark: SparkSession, path: str, kind: Kind) -> DataFrame:
    """Instruction, input and output columns in Parquet files, the split being the name up to the first '-' (N5)."""
    df = readers.parquet_files(spark, path)
    raw_split = F.substring_index("stem", "-", 1)
    return sample(df, kind, F.concat_ws("_", F.lit(kind.source), raw_split, F.col("row_index")), raw_split, F.col("instruction"), F.col("input"), None, F.col("output"), gold_info(F.col("output")), file_name=F.col("file_name"),
                  **{c: T.filled(F.col(c)) for c in ("task", "desc") if c in df.columns})


def instruction_json(spark: SparkSession, path: str, kind: Kind) -> DataFrame:
    """Instruction, input and output in one JSON array; everything is training data."""
    df, v = readers.json_array(spark, path), F.col("value")
    answer = _scalar(v, "$.output")
    return sample(df, kind, F.concat_ws("_", F.lit(kind.source), F.lit("train"), F.col("row_index")), F.lit("train"), _scalar(v, "$.instruction"), _scalar(v, "$.input"), None, answer, gold_info(answer))


def labelled_lines(spark: SparkSession, path: str, kind: Kind, question: str, options: list[str]) -> DataFrame:
    """'sentence@label' lines of text members of a zip archive (N7): split at the last '@'; lines without one are left out but
    count for the row number."""
    df = readers.zip_lines(spark, path, has="Sentences_").where(F.contains("line", F.lit("@")))
    label = F.substring_index("line", "@", -1)
    sentence = F.substr(F.col("line"), F.lit(1), F.length("line") - F.length(label) - 1)
    agreement = F.lower(F.replace(F.replace(F.regexp_extract("member", r"([^/]+?)\.[^./]*$", 1), F.lit("Sentences_"), F.lit("")), F.lit("Agree"), F.lit("")))
    return sample(df, kind, F.concat_ws("_", F.lit(kind.source), agreement, F.col("row_index")), F.lit(""), F.lit(question), sentence, F.array(*map(F.lit, options)), label, gold_info(label), agreement_split=agreement, member_name=F.col("member"))


def exam_folder(spark: SparkSession, path: str, kind: Kind, columns: list[str]) -> DataFrame:
    """Exam questions of an unpacked archive (N8): CSV files below path, the split being their folder."""
    df = readers.csv_files(spark, path, columns)
    col = lambda c: F.col(c) if c in df.columns else F.lit("")
    row = T.first_filled(col("id"), F.col("row_index"))
    return sample(df, kind, F.concat_ws("_", F.lit(kind.source), F.col("parent"), F.col("stem"), row), F.col("parent"), col("question"), F.lit(""), T.lettered_options(*map(col, _LETTERS)), col("answer"), gold_info(col("answer")), file_name=F.col("file_name"))


#: Adapters by the name that settings use.
REGISTRY: dict[str, Callable[..., DataFrame]] = {
    f.__name__: f for f in (table_text_qa, dialogue_qa, table_paragraph_qa, exam_csv, exam_zip, exam_folder, instruction_parquet, instruction_json, labelled_lines)
}


def normalise(spark: SparkSession, jobs: list[Callable[[SparkSession], DataFrame]]) -> DataFrame:
    """All registered data sets as one table, in any order."""
    return merge.union_all([job(spark) for job in jobs])


def job(settings: dict) -> Callable[[SparkSession], DataFrame]:
    """What a data set's settings ask for: adapter, path, source, task_type, task_domain, language, and the adapter's own options. KeyError
    for an unknown adapter."""
    own = dict(settings)
    adapter, path = REGISTRY[own.pop("adapter")], own.pop("path")
    kind = Kind(*(own.pop(f.name) for f in fields(Kind)))
    return lambda spark: adapter(spark, path, kind, **own)


def normalise_all(spark: SparkSession, datasets: list[dict], out: str) -> list[dict]:
    """Write each data set as JSON lines below out under its source, and a report in the order of the settings."""
    report = [{"source": s["source"], "rows": sinks.write_json_lines(job(s)(spark), f"{out}/{s['source']}")} for s in datasets]
    sinks.write_report(spark, f"{out}/report.json", report)
    return report
