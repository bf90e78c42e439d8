"""Merging, validating and profiling sets of samples."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T

STRINGS = ("id", "source", "split", "task_type", "task_domain", "language", "question", "context", "reference_answer")


def union_all(parts: list[DataFrame]) -> DataFrame:
    """All rows of all parts by column name (P10, P16); columns that a part lacks are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def json_issues(line: Column, fields: list[str], strings: tuple[str, ...] = STRINGS) -> Column:
    """Sorted list of what is wrong with a sample's JSON text (P10): field_set_mismatch or field_order_mismatch,
    {field}_not_string, options_not_list, metadata_not_dict; not_json for a line that is no object."""
    want = F.array(*map(F.lit, fields))

    def found(s: Column) -> Column:
        keys, of = s["keys"], s["fields"]
        kind = lambda f: F.schema_of_variant(F.try_element_at(of, F.lit(f)))
        out = [F.when(F.array_sort(keys) != F.array_sort(want), "field_set_mismatch").when(keys != want, "field_order_mismatch")]
        out += [F.when(F.coalesce(kind(f) != "STRING", F.lit(True)), f"{f}_not_string") for f in fields if f in strings]
        for f, shape, issue in (("options", "ARRAY", "options_not_list"), ("metadata", "OBJECT", "metadata_not_dict")):
            if f in fields:
                out.append(F.when(~F.coalesce(F.startswith(kind(f), F.lit(shape)), F.lit(False)), issue))
        return F.when(keys.isNull(), F.array(F.lit("not_json"))).otherwise(F.array_sort(F.array_compact(F.array(*out))))

    # the text is parsed once for its keys in order and once for all values
    return T.let(T.record(keys=F.json_object_keys(line), fields=F.try_variant_get(F.try_parse_json(line), "$", "map<string,variant>")), found)


def validate(lines: DataFrame, fields: list[str], line: str = "value") -> DataFrame:
    """lines with a column issues, only those that have any."""
    return lines.withColumn("issues", json_issues(F.col(line), fields)).where(F.size("issues") > 0)


def missing_values(df: DataFrame, columns: tuple[str, ...] = STRINGS) -> Column:
    """Names of the columns that are NULL or blank, as a sorted array."""
    return F.array_sort(F.array_compact(F.array(*(F.when(T.strip(F.col(c)) == "", c) for c in columns if c in df.columns))))


def repeats(df: DataFrame, key: str = "id", order: list[str] | None = None) -> DataFrame:
    """Second and later rows of each key, with their number (occurrence) in the given order.

    Keys that occur once are dropped before rows are ordered, so a window only sees rows that do repeat.
    """
    more = df.groupBy(key).agg(F.count("*").alias("_n")).where("_n > 1").drop("_n")
    w = Window.partitionBy(key).orderBy(*(order or []))
    return df.join(more, key).withColumn("occurrence", F.row_number().over(w)).where("occurrence > 1")


def latest(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The last row of each non-empty key (S7, the build side of F5): one aggregation, no window."""
    cols = [c for c in df.columns if c != key]
    rows = df.where(F.col(key).isNotNull() & (F.col(key) != ""))
    return rows.groupBy(key).agg(F.max_by(F.struct(*cols), F.struct(*order)).alias("_r")).select(key, "_r.*")


def with_model_fields(df: DataFrame, split: str = "split") -> DataFrame:
    """model_answer '' everywhere; model_reasoning '' in train and val and NULL in test."""
    return df.withColumn("model_answer", F.lit("")).withColumn("model_reasoning", F.when(F.col(split) == "test", F.lit(None)).otherwise(F.lit("")))


def profile(df: DataFrame, by: str, columns: list[str], empty: list[str]) -> DataFrame:
    """(by, metric, value, n, ratio) per group (P14): one row per value of each column and one per column that can be empty.

    One aggregation over grouping sets, so each row is read once.
    """
    kinds = [F.struct(F.lit(c).alias("metric"), T.filled(F.col(c)).alias("value"), F.lit(1).alias("hit")) for c in columns]
    kinds += [F.struct(F.lit(f"empty_{c}").alias("metric"), F.lit("").alias("value"), (T.filled(F.col(c)) == "").cast("int").alias("hit")) for c in empty]
    kinds += [F.struct(F.lit("rows").alias("metric"), F.lit("").alias("value"), F.lit(1).alias("hit"))]
    long = df.select(by, F.explode(F.array(*kinds)).alias("k")).groupBy(by, "k.metric", "k.value").agg(F.sum("k.hit").alias("n"), F.count("*").alias("of"))
    total = F.max(F.when(F.col("metric") == "rows", F.col("of"))).over(Window.partitionBy(by))
    return long.withColumn("ratio", F.col("n") / total).select(by, "metric", "value", "n", "ratio")


def verify_files(manifest: DataFrame, files: DataFrame) -> DataFrame:
    """(name, issues) of the data sets whose manifest entry and files on disk differ.

    manifest: (name, success, file_count, total_bytes); files: (name, length), one row per file. Issues: not_downloaded,
    missing_on_disk, empty, file_count_mismatch, size_mismatch, not_in_manifest.
    """
    there = files.groupBy("name").agg(F.count("*").alias("files"), F.sum("length").alias("bytes"))
    j = manifest.join(there, "name", "full_outer")
    known = F.col("success").isNotNull()
    checks = F.array_compact(
        F.array(
            F.when(~known, "not_in_manifest"),
            F.when(known & ~F.col("success"), "not_downloaded"),
            F.when(F.col("success") & F.col("files").isNull(), "missing_on_disk"),
            F.when(F.col("success") & (F.col("bytes") == 0), "empty"),
            F.when(F.col("success") & (F.col("files") != F.col("file_count")), "file_count_mismatch"),
            F.when(F.col("success") & (F.col("bytes") != F.col("total_bytes")), "size_mismatch"),
        )
    )
    return j.select("name", checks.alias("issues")).where(F.size("issues") > 0)


def slice_rows(df: DataFrame, order: list[str], start: int = 0, end: int | None = None) -> DataFrame:
    """Rows start to end (exclusive) of df in the given order (M8), with their position.

    Positions come from a range-partitioned sort and the row counts of its partitions, not from a window in one task.
    """
    s = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_part", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id() % (1 << 33))
    from ..session import materialise

    s = materialise(s)
    counts = s.groupBy("_part").agg(F.count("*").alias("_n"))
    before = counts.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))  # one row per partition
    out = s.join(F.broadcast(before), "_part").withColumn("position", F.col("_before") + F.col("_at")).drop("_part", "_at", "_before")
    keep = F.col("position") >= start
    return out.where(keep if end is None else keep & (F.col("position") < end))
