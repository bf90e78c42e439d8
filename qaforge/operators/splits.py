"""Train, validation and test splits."""

from __future__ import annotations

import math
import random

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T

# fixed values: spellings of split names
TRAIN = ("train", "training")
VAL = ("val", "dev", "valid", "validation", "eval")
TEST = ("test", "test_gold")
SPLITS = ("train", "val", "test")
RATIOS = {"train": 0.8, "val": 0.1, "test": 0.1}


def canonical(raw: Column) -> Column:
    """train, val, test, or '' for any other name."""
    s = F.lower(T.strip(raw))
    return F.when(s.isin(*TRAIN), "train").when(s.isin(*VAL), "val").when(s.isin(*TEST), "test").otherwise("")


def distribution(df: DataFrame, raw: str = "split", by: str = "source") -> DataFrame:
    """(by, raw_split, canonical_split, n); empty names are '__missing__' (P3)."""
    named = lambda c: F.coalesce(F.nullif(c, F.lit("")), F.lit("__missing__"))
    return df.groupBy(F.col(by), named(T.strip(F.col(raw))).alias("raw_split"), named(canonical(F.col(raw))).alias("canonical_split")).agg(F.count("*").alias("n"))


def completeness(df: DataFrame, raw: str = "split", by: str = "source") -> DataFrame:
    """(by, n, preserved): preserved if all three splits occur and no row lacks one."""
    s = canonical(F.col(raw))
    some = [F.count_if(s == k) > 0 for k in SPLITS]
    return df.groupBy(by).agg(F.count("*").alias("n"), ((F.count_if(s == "") == 0) & some[0] & some[1] & some[2]).alias("preserved"))


def sizes(n: int, ratios: dict[str, float] | None = None) -> dict[str, int]:
    """Rows per split (P5): one each, the rest by ratio rounded down, what is left by largest fraction. ValueError below 3."""
    if n < len(SPLITS):
        raise ValueError(f"{n} rows are too few for three splits")
    r = ratios or RATIOS
    want = {s: (n - len(SPLITS)) * r[s] for s in SPLITS}
    out = {s: 1 + math.floor(want[s]) for s in SPLITS}
    spare = n - sum(out.values())
    for s in sorted(SPLITS, key=lambda s: (math.floor(want[s]) - want[s], SPLITS.index(s)))[: max(spare, 0)]:
        out[s] += 1
    return out


def size_column(n: Column, ratios: dict[str, float] | None = None) -> Column:
    """STRUCT<train, val> sizes as a Column of the number of rows, for n >= 3."""
    r = ratios or RATIOS
    rest = (n - 3).cast("double")
    want = [rest * F.lit(r[s]) for s in SPLITS]
    base = [F.floor(w).cast("bigint") for w in want]
    frac = [w - b for w, b in zip(want, base)]
    spare = n - 3 - base[0] - base[1] - base[2]
    rank = lambda i: sum(((frac[j] > frac[i]) | ((frac[j] == frac[i]) & F.lit(j < i))).cast("int") for j in range(3) if j != i)
    out = [1 + base[i] + F.when(rank(i) < spare, 1).otherwise(0) for i in range(3)]
    return F.struct(out[0].cast("bigint").alias("train"), out[1].cast("bigint").alias("val"))


def preserved(df: DataFrame, raw: str = "split") -> DataFrame:
    """df with split replaced by its canonical name (P6, P8); the raw one is kept as raw_split."""
    return df.withColumn("raw_split", T.strip(F.col(raw))).withColumn("split", canonical(F.col(raw)))


def resplit(df: DataFrame, key: str = "id", by: str = "source", seed: int = 42, ratios: dict[str, float] | None = None, mode: str = "hash") -> DataFrame:
    """df with a new split column (P7). Groups of fewer than 3 rows fail, as no split may be empty.

    hash: rows of a group ordered by md5(seed:key). Ranks are found without sorting a group in one task: rows are counted
    per leading part of the hash, and only the rows of one part are ranked together. replay: the seeded Mersenne shuffle of
    rows in key order, for data small enough to be reproduced exactly that way (the permutation is made on the driver).
    """
    if mode == "replay":
        parts = [(r[by], r["n"]) for r in df.groupBy(by).agg(F.count("*").alias("n")).collect()]
        rows = []
        for g, n in parts:
            order = list(range(n))
            random.Random(seed).shuffle(order)
            cut = sizes(n, ratios)
            names = [s for s in SPLITS for _ in range(cut[s])]
            rows += [(g, i, s) for i, s in zip(order, names)]
        plan = df.sparkSession.createDataFrame(rows, f"`{by}` string, _at int, split string")
        at = F.row_number().over(Window.partitionBy(by).orderBy(F.col(key).cast("string"))) - 1
        return df.drop("split").withColumn("_at", at).join(plan, [by, "_at"]).drop("_at")
    h = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")))
    rows = df.drop("split").withColumn("_h", h).withColumn("_p", F.substring("_h", 1, 3))
    w = Window.partitionBy(by).orderBy("_p")
    parts = rows.groupBy(by, "_p").agg(F.count("*").alias("_k"))
    parts = parts.select(by, "_p", (F.sum("_k").over(w) - F.col("_k")).alias("_before"), F.sum("_k").over(Window.partitionBy(by)).alias("_n"))
    small = F.raise_error(F.concat(F.lit("too few rows for three splits: "), F.col("_n").cast("string")))
    at = F.col("_before") + F.row_number().over(Window.partitionBy(by, "_p").orderBy("_h", key))
    cut = size_column(F.col("_n"), ratios)
    ranked = rows.join(parts, [by, "_p"]).withColumn("_at", at)
    split = F.when(F.col("_n") < 3, small.cast("string")).when(F.col("_at") <= cut["train"], "train").when(F.col("_at") <= cut["train"] + cut["val"], "val").otherwise("test")
    return ranked.withColumn("split", split).drop("_h", "_p", "_before", "_n", "_at")


def split_dataset(df: DataFrame, key: str = "id", by: str = "source", raw: str = "split", seed: int = 42, ratios: dict[str, float] | None = None) -> DataFrame:
    """Each group keeps its own splits if they are complete and is split anew otherwise."""
    whole = df.join(completeness(df, raw, by).select(by, "preserved"), by)
    kept = preserved(whole.where("preserved"), raw)
    fresh = resplit(whole.where("not preserved").withColumn("raw_split", T.strip(F.col(raw))), key, by, seed, ratios)
    return kept.unionByName(fresh).drop("preserved")


def bucket(source: Column, raw: Column, held_out: tuple[str, ...] = ("finqa", "convfinqa")) -> Column:
    """Older routing by the start of the raw split's name."""
    s = F.lower(T.strip(raw))
    test = F.startswith(s, F.lit("test"))
    return F.when(test & source.isin(*held_out), "test").when(test, "val").when(s.isin("dev", "val", "valid", "validation", "eval"), "val").otherwise("train")
