"""Sinks: JSON lines, partitioned and sharded outputs, reports, and replacement of a whole output at once (K1-K9).

Everything is written by executors to a folder beside the target and then moved into place, through the file system of the
path, so a reader sees the old output or the new one and a failed job leaves the old one.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators import merge


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def replaced(spark: SparkSession, path: str, write: Callable[[str], None]) -> None:
    """Let write fill a new folder beside path, then put that in the place of path (K5). If write fails, path is untouched."""
    fs, target = _fs(spark, path.rstrip("/"))
    new, old = f"{path.rstrip('/')}.new-{uuid.uuid4().hex}", f"{path.rstrip('/')}.old-{uuid.uuid4().hex}"
    try:
        write(new)
        if target.getParent() is not None:
            fs.mkdirs(target.getParent())
        there = fs.exists(target)
        if there and not fs.rename(target, _path(spark, old)):
            raise OSError(f"cannot move {path}")
        if not fs.rename(_path(spark, new), target):
            if there:
                fs.rename(_path(spark, old), target)
            raise OSError(f"cannot move the new output to {path}")
        fs.delete(_path(spark, old), True)
    finally:
        fs.delete(_path(spark, new), True)


def write_json_lines(df: DataFrame, path: str, by: list[str] | None = None) -> int:
    """df as JSON lines (K1), with a folder per value of the columns by (K2 splits, K3 keep and drop, K4 categories); NULLs are
    written, other scripts stay as they are. Returns the number of rows, counted while writing. Empty tables give an empty
    folder."""
    seen = Observation()

    def write(to: str) -> None:
        w = df.observe(seen, F.count(F.lit(1)).alias("n")).write.option("ignoreNullFields", "false")
        (w.partitionBy(*by) if by else w).json(to)

    replaced(df.sparkSession, path, write)
    return int(seen.get["n"])


def write_ordered(df: DataFrame, path: str, order: list[str]) -> int:
    """df as JSON lines in that order over the files by name (K7): ranges of the order, each sorted, none in one task."""
    return write_json_lines(df.repartitionByRange(*order).sortWithinPartitions(*order), path)


def shard_name(stem: str, start: int, end: int, suffix: str = "jsonl") -> str:
    """File name of a shard of rows start to end (exclusive) (K9)."""
    return f"{stem}.{start}_{end}.{suffix}"


def write_shards(df: DataFrame, path: str, order: list[str], rows: int, stem: str = "part") -> list[str]:
    """df in that order as files of so many rows named by ``shard_name`` (K9); returns their names."""
    spark = df.sparkSession
    placed = merge.slice_rows(df, order)
    n = int(placed.agg(F.max("position").alias("n")).first()["n"] or -1) + 1 if placed.head(1) else 0
    names = [shard_name(stem, a, min(a + rows, n)) for a in range(0, n, rows)]

    def write(to: str) -> None:
        number = F.floor(F.col("position") / rows).cast("int")
        out = placed.withColumn("_shard", number).repartition("_shard").sortWithinPartitions("_shard", "position")
        out.select("_shard", F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("value")).write.partitionBy("_shard").text(to)
        fs, _ = _fs(spark, to)
        for k, name in enumerate(names):
            part = fs.globStatus(_path(spark, f"{to}/_shard={k}/part-*"))
            if len(part) != 1 or not fs.rename(part[0].getPath(), _path(spark, f"{to}/{name}")):
                raise OSError(f"shard {k} of {path} is not one file")
            fs.delete(_path(spark, f"{to}/_shard={k}"), True)

    replaced(spark, path, write)
    return names


def write_json_array(df: DataFrame, path: str, documents: dict[str, Column]) -> None:
    """Documents of one JSON array each (the inverse of ``readers.json_array``): documents names the file of each and the condition of
    its rows. For fixtures and small exports: an array is one value."""
    spark = df.sparkSession

    def write(to: str) -> None:
        fs, _ = _fs(spark, to)
        for name, rows in documents.items():
            part = df.where(rows).select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("v")).agg(F.concat(F.lit("["), F.array_join(F.collect_list("v"), ","), F.lit("]")).alias("value"))
            part.coalesce(1).write.text(f"{to}/_{name}")
            got = fs.globStatus(_path(spark, f"{to}/_{name}/part-*"))[0].getPath()
            fs.rename(got, _path(spark, f"{to}/{name}.json"))
            fs.delete(_path(spark, f"{to}/_{name}"), True)

    replaced(spark, path, write)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, p = _fs(spark, path)
    tmp = _path(spark, f"{path}.new-{uuid.uuid4().hex}")
    out = fs.create(tmp, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    fs.delete(p, False)
    if not fs.rename(tmp, p):
        raise OSError(f"cannot move the new report to {path}")


def read_text(spark: SparkSession, path: str) -> str:
    return spark.read.text(path, wholetext=True).first()["value"]


def write_report(spark: SparkSession, path: str, report: dict | list) -> None:
    """A report of collected figures as indented JSON (K6); other scripts stay as they are."""
    write_text(spark, path, json.dumps(report, ensure_ascii=False, indent=2, default=str))


def figures(df: DataFrame, keys: list[str], most: int = 100_000) -> dict:
    """A small table of figures as nested objects by its key columns, for ``write_report``. ValueError if it has more rows than
    a report can hold."""
    rows = df.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"a report of more than {most} rows")
    out: dict = {}
    for r in rows:
        at = out
        for k in keys:
            at = at.setdefault(str(r[k]), {})
        at.update({c: r[c] for c in df.columns if c not in keys})
    return out


def publish(artifacts: dict[str, DataFrame], path: str) -> dict[str, int]:
    """Each artifact as JSON lines under its own fixed name below path (K8); all or none are replaced. Returns their rows."""
    if bad := [a for a in artifacts if not re.fullmatch(r"[\w.-]+", a)]:
        raise ValueError(f"names that are no file names: {bad}")
    counts = {}

    def write(to: str) -> None:
        for name, df in artifacts.items():
            seen = Observation()
            df.observe(seen, F.count(F.lit(1)).alias("n")).write.option("ignoreNullFields", "false").json(f"{to}/{name}")
            counts[name] = int(seen.get["n"])

    replaced(next(iter(artifacts.values())).sparkSession, path, write)
    return counts
