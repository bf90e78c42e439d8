"""Sources: files to DataFrames with stable row positions.

All schemas are given, never inferred. Where the position of a row within its file matters (it becomes part of an id), it is
carried as a column from the source on; nothing later relies on the order of rows.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ship


def _named(df: DataFrame) -> DataFrame:
    path = F.col("_metadata.file_path")
    name = F.url_decode(F.regexp_extract(path, r"([^/]+)$", 1))
    parent = F.url_decode(F.regexp_extract(path, r"([^/]+)/[^/]+$", 1))
    return df.withColumn("file_name", name).withColumn("stem", F.regexp_replace(name, r"\.[^.]+$", "")).withColumn("parent", parent)


def json_array(spark: SparkSession, path: str) -> DataFrame:
    """(file_name, stem, parent, row_index, value VARIANT): elements of JSON documents that are one array each (S1). A document is
    the unit of parallel reading; an empty array gives no rows."""
    raw = _named(spark.read.text(path, wholetext=True))
    text = F.regexp_replace("value", "^﻿", "")
    return raw.select("file_name", "stem", "parent", F.posexplode(F.from_json(text, "array<variant>")).alias("row_index", "value"))


def json_lines(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """JSON objects by line (S6): (file_name, stem, parent, block_start, row_index, value) with the raw line, or with the schema's
    columns in place of value. Blank lines are skipped, a byte order mark is dropped, missing keys are NULL."""
    raw = _named(spark.read.text(path))
    line = F.regexp_replace("value", "^﻿", "")
    rows = raw.select("file_name", "stem", "parent", F.col("_metadata.file_block_start").alias("block_start"), F.monotonically_increasing_id().alias("row_index"), line.alias("value"))
    rows = rows.where(F.trim("value") != "")
    if schema is None:
        return rows
    return rows.withColumn("_v", F.from_json("value", schema)).select("file_name", "stem", "parent", "block_start", "row_index", "_v.*")


def csv_files(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """CSV files with a header in that order of columns (S2): quotes, commas and newlines in fields, byte order mark, empty fields
    ''. A file is read by one task, which numbers its rows (row_index from 0)."""
    schema = ", ".join(f"`{c or '_unnamed'}` string" for c in columns)
    df = spark.read.csv(path, header=True, schema=schema, quote='"', escape='"', multiLine=True, encoding="UTF-8", enforceSchema=True, recursiveFileLookup=True, pathGlobFilter="*.csv", nullValue="\u0000", emptyValue="")
    at = F.monotonically_increasing_id()
    names = [c or "_unnamed" for c in columns]
    out = _named(df).select("file_name", "stem", "parent", at.alias("_at"), *(F.coalesce(F.col(c), F.lit("")).alias(c) for c in names))
    from pyspark.sql import Window

    return out.withColumn("row_index", F.row_number().over(Window.partitionBy("parent", "file_name").orderBy("_at")) - 1).drop("_at")


def parquet_files(spark: SparkSession, path: str) -> DataFrame:
    """Parquet files with their name and the position of each row in its file."""
    return _named(spark.read.parquet(path)).withColumn("row_index", F.col("_metadata.row_index"))


def _members(suffix: str, has: str, encoding: str, lines: bool, columns: list[str] | None):
    import csv

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            for path, content in zip(pdf["path"], pdf["content"]):
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    for name in sorted(n for n in z.namelist() if n.endswith(suffix) and has in n and "__MACOSX" not in n):
                        text = z.read(name).decode(encoding)
                        if lines:
                            rows = text.splitlines()
                            yield pd.DataFrame({"archive": path, "member": name, "row_index": range(len(rows)), "line": rows})
                        else:
                            got = [[r.get(c) or "" for c in columns] for r in csv.DictReader(io.StringIO(text, newline=""))]
                            out = pd.DataFrame(got, columns=columns, dtype=object)
                            out.insert(0, "row_index", range(len(got)))
                            out.insert(0, "member", name)
                            out.insert(0, "archive", path)
                            yield out

    return run


def zip_lines(spark: SparkSession, path: str, suffix: str = ".txt", has: str = "", encoding: str = "iso-8859-1") -> DataFrame:
    """(archive, member, row_index, line) of text members of zip archives (S4); an archive is read by one task."""
    ship(spark)
    raw = spark.read.format("binaryFile").load(path).select("path", "content")
    return raw.mapInPandas(_members(suffix, has, encoding, True, None), "archive string, member string, row_index bigint, line string")


def zip_csv(spark: SparkSession, path: str, columns: list[str], encoding: str = "utf-8-sig") -> DataFrame:
    """(archive, member, row_index, ...columns) of CSV members of zip archives, empty fields '' (S3)."""
    ship(spark)
    raw = spark.read.format("binaryFile").load(path).select("path", "content")
    return raw.mapInPandas(_members(".csv", "", encoding, False, columns), "archive string, member string, row_index bigint, " + ", ".join(f"`{c}` string" for c in columns))


_SHARD = r"^(.+)\.(\d+)_(\d+)\.([^.]+)$"


def shard_bounds(file_name: Column) -> Column:
    """STRUCT<stem, start, end> of a shard's file name 'stem.start_end.suffix' (S11); any other name raises an error."""
    part = lambda k: F.regexp_extract(file_name, _SHARD, k)
    good = F.struct(part(1).alias("stem"), part(2).try_cast("bigint").alias("start"), part(3).try_cast("bigint").alias("end"))
    return F.when(file_name.rlike(_SHARD), good).otherwise(F.raise_error(F.concat(F.lit("not a shard: "), file_name)).cast("struct<stem:string,start:bigint,end:bigint>"))


def shards(spark: SparkSession, path: str) -> DataFrame:
    """Lines of shard files with shard_start, shard_end and row_index; their order is (shard_start, shard_end, file_name,
    block_start, row_index) (S11, P16)."""
    df = json_lines(spark, path)
    b = shard_bounds(F.col("file_name"))
    return df.select("file_name", b["start"].alias("shard_start"), b["end"].alias("shard_end"), "block_start", "row_index", "value")


def file_listing(spark: SparkSession, path: str) -> DataFrame:
    """(path, name, length) of all files below a folder (S8, P15); name is the first folder below it. Contents are not read."""
    root = re.escape(path.rstrip("/").removeprefix("file://"))
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return raw.select("path", F.regexp_extract("path", rf"{root}/([^/]+)/", 1).alias("name"), "length")


def last_by_id(lines: DataFrame, key: str = "id") -> DataFrame:
    """Last line of each id of a cache (S7); lines as from ``json_lines`` without a schema."""
    k = F.get_json_object("value", f"$.{key}")
    order = F.struct("file_name", "block_start", "row_index")
    return lines.withColumn(key, k).where(F.col(key).isNotNull()).groupBy(key).agg(F.max_by("value", order).alias("value"))
