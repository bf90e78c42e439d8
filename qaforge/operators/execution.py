"""Execution accuracy: gold answers and programs of raw records, predictions that are programs, and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import compare as C
from ..functions import program as P
from ..functions import text as T


def _object(v: Column) -> Column:
    """v where it is a JSON object, else NULL."""
    return F.when(F.startswith(F.schema_of_variant(v), F.lit("OBJECT")), v)


def _either(v: Column, first: str, last: str) -> Column:
    """Text of the first key if its value is set, else of the last one: missing, NULL, '', the number 0, false and empty
    containers are not set, the text '0' is."""
    kind = F.schema_of_variant(F.try_variant_get(v, f"$.{first}", "variant"))
    text = F.try_variant_get(v, f"$.{first}", "string")
    unset = F.when(kind == "STRING", text == "").otherwise(text.rlike(r"^(?:-?0+(?:\.0+)?(?:[eE][-+]?\d+)?|false|null|\[\]|\{\})$"))
    return F.coalesce(F.when(~unset, text), F.try_variant_get(v, f"$.{last}", "string"), F.lit(""))


def active_turn(raw: Column, sample_id: Column) -> Column:
    """VARIANT of the question-and-answer object of a raw dialogue record: the plain one, else that of the number the id ends
    in, else the last by number; NULL if there is none."""
    turns = F.map_filter(F.try_variant_get(raw, "$", "map<string,variant>"), lambda k, _: k.rlike(r"^qa_[0-9]+$"))
    number = lambda e: F.regexp_extract(e["key"], "([0-9]+)$", 1).cast("int")
    last = F.try_element_at(F.array_sort(F.map_entries(turns), lambda a, b: number(a) - number(b)), F.lit(-1))
    own = F.concat(F.lit("qa_"), F.regexp_extract(T.filled(sample_id), r"_([0-9]+)$", 1).try_cast("int").cast("string"))
    return F.coalesce(_object(F.try_variant_get(raw, "$.qa", "variant")), _object(F.try_element_at(turns, F.coalesce(own, F.lit("")))), _object(last["value"]))


def gold(df: DataFrame) -> DataFrame:
    """df (id, source, reference_answer, metadata as JSON text) with gold_answer and gold_program (C9): the reference, else the
    answer or executed answer of the raw record; the re-run program, else the given one."""
    raw = F.try_variant_get(F.try_parse_json("metadata"), "$.raw_sample", "variant")
    source = F.lower(T.filled(F.col("source")))
    qa = F.when(source == "finqa", _object(F.try_variant_get(F.col("_raw"), "$.qa", "variant"))).when(source == "convfinqa", active_turn(F.col("_raw"), F.col("id")))
    x = df.withColumn("_raw", raw).withColumn("_qa", qa)
    reference = F.when(T.strip(F.col("reference_answer")) != "", F.col("reference_answer")).otherwise(_either(F.col("_qa"), "answer", "exe_ans"))
    return x.withColumn("gold_answer", reference).withColumn("gold_program", _either(F.col("_qa"), "program_re", "program")).drop("_raw", "_qa")


def executed(df: DataFrame, program: str, out: str = "executed") -> DataFrame:
    """df with the STRUCT<executable, num, txt, error> of each program. Programs of the common flat shape are computed in the
    JVM; only the others, split off before, go through Python."""
    flat = df.withColumn("_flat", P.flat_value(F.col(program)))
    kind = "struct<executable:boolean,num:double,txt:string,error:string>"
    none = F.lit(None).cast("string")
    done = flat.where("_flat is not null").withColumn(out, F.struct(F.lit(True).alias("executable"), F.col("_flat").alias("num"), none.alias("txt"), F.lit("").alias("error")).cast(kind))
    rest = flat.where("_flat is null").withColumn(out, P.execute(program).cast(kind))
    return done.unionByName(rest).drop("_flat")


def resolved(df: DataFrame, answer: str = "model_answer") -> DataFrame:
    """df with prediction and executable (C12): the value of an answer that is a program ('' if it fails), else the answer."""
    x = df.withColumn("_answer", T.strip(F.col(answer)))
    is_program = P.looks_like_program(F.col("_answer"))
    run = executed(x.where(is_program), "_answer")
    value = F.when(F.col("executed.executable"), F.coalesce(F.col("executed.txt"), F.col("executed.num").cast("string"))).otherwise("")
    run = run.withColumn("prediction", value).withColumn("executable", F.col("executed.executable")).drop("executed")
    plain = x.where(~is_program).withColumn("prediction", F.col("_answer")).withColumn("executable", F.lit(False))
    return run.unionByName(plain).drop("_answer")


def evaluated(df: DataFrame, answer: str = "model_answer") -> DataFrame:
    """df with gold_answer, gold_program, prediction, executable and correct."""
    return resolved(gold(df), answer).withColumn("correct", C.answers_match(F.col("prediction"), F.col("gold_answer")))


def report(evaluated: DataFrame, by: list[str] | None = None) -> DataFrame:
    """n, accuracy and executable_rate, per group if by is given; an empty table has one row of zeros, or none by group."""
    rate = lambda c: F.coalesce(F.avg(F.coalesce(F.col(c), F.lit(False)).cast("double")), F.lit(0.0))
    out = [F.count("*").alias("n"), rate("correct").alias("accuracy"), rate("executable").alias("executable_rate")]
    return evaluated.groupBy(*by).agg(*out) if by else evaluated.agg(*out)
