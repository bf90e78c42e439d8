"""Weighted and capped training manifests, and fixed-size samples."""

from __future__ import annotations

import math
import random
from bisect import bisect_left
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def uniform_md5(*parts: Column) -> Column:
    """Number in [0, 1) from the first 32 bits of the md5 of the parts joined by ':'."""
    h = F.md5(F.concat_ws(":", *parts))
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)


def fixed_sample(df: DataFrame, size: int, key: str = "id", seed: int = 42, mode: str = "hash", order: list[str] | None = None) -> DataFrame:
    """size rows without replacement (M1), with a column position: their rank in the given order (by key if None).

    hash: the rows with the smallest md5(seed:key), a distributed top-k. replay: the positions that a seeded Mersenne sampler
    gives for that many rows, made on the driver. ValueError if size exceeds the number of rows.
    """
    n = df.count()
    if size > n:
        raise ValueError(f"sample of {size} from {n} rows")
    order = order or [key]
    if mode == "replay":
        from .merge import slice_rows

        at = sorted(random.Random(seed).sample(range(n), size))
        want = df.sparkSession.createDataFrame([(i,) for i in at], "position bigint")
        return slice_rows(df, order).join(want, "position")
    h = df.withColumn("_h", F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string"))))
    # rows of hash ranges that fit whole are taken; only the range in which the sample ends is ordered row by row
    h = h.withColumn("_bin", F.substring("_h", 1, 3))
    sums = h.groupBy("_bin").agg(F.count("*").alias("_n")).withColumn("_upto", F.sum("_n").over(Window.orderBy("_bin")))  # at most 4,096 ranges
    ends = F.broadcast(sums.where(F.col("_upto") - F.col("_n") < size).select("_bin", F.least(F.col("_n"), F.lit(size) - (F.col("_upto") - F.col("_n"))).alias("_take"), (F.col("_upto") <= size).alias("_whole")))
    j = h.join(ends, "_bin")
    cut = j.where("not _whole").withColumn("_at", F.row_number().over(Window.partitionBy("_bin").orderBy("_h", key))).where("_at <= _take").drop("_at")
    from .merge import slice_rows

    return slice_rows(j.where("_whole").unionByName(cut).select(*df.columns), order).withColumn("position", F.col("position").cast("int"))


def weighted_choice(u: Column, items: list[tuple[str, float]]) -> Column:
    """The item whose share of the summed weights holds u in [0, 1] (M2): the first with u * total <= its running sum."""
    total = sum(w for _, w in items)
    if total <= 0:
        raise ValueError("weights sum to 0")
    out, run = None, 0.0
    for name, w in items[:-1]:
        run += w
        hit = u * F.lit(total) <= F.lit(run)
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return F.lit(items[-1][0]) if out is None else out.otherwise(items[-1][0])


def pools(refs: DataFrame, weights: dict[str, dict[str, float]], factor: float = 3.0) -> DataFrame:
    """(task_domain, source, weight, train_size, max_draws) of each configured source (M3). A factor below 1 and a source
    without rows raise an error."""
    if factor < 1:
        raise ValueError("factor must be at least 1")
    cfg = [(d, s, float(w)) for d, ss in weights.items() for s, w in ss.items()]
    want = refs.sparkSession.createDataFrame(cfg, "task_domain string, source string, weight double")
    have = refs.groupBy("source").agg(F.count("*").alias("train_size"))
    out = F.broadcast(want).join(have, "source", "left")
    size = F.coalesce(F.col("train_size"), F.raise_error(F.concat(F.lit("no rows for source "), F.col("source"))).cast("bigint"))
    return out.select("task_domain", "source", "weight", size.alias("train_size"), F.ceil(size * F.lit(float(factor))).cast("bigint").alias("max_draws"))


def pool_statistics(p: DataFrame) -> DataFrame:
    """Sizes and caps per source, per domain (source NULL) and in all (both NULL) (M4)."""
    return p.rollup("task_domain", "source").agg(F.sum("train_size").alias("train_size"), F.sum("max_draws").alias("max_draws"))


def quotas(sizes: dict[tuple[str, str], tuple[float, int]], domain_weights: dict[str, float], target: int) -> dict[tuple[str, str], int]:
    """Draws per (domain, source): shares by weight, filled up to caps, what a full pool cannot take going to the others.

    sizes: (weight, cap) of each pool. ValueError if the caps sum to less than target.
    """
    if target > sum(c for _, c in sizes.values()):
        raise ValueError(f"{target} draws exceed the capacity of the pools")

    def fill(weights: dict, caps: dict, total: int) -> dict:
        out, open_, left = dict.fromkeys(caps, 0), {k for k in caps if caps[k] > 0}, total
        while left > 0 and open_:
            w = sum(weights[k] for k in open_) or 1
            want = {k: left * weights[k] / w if sum(weights[j] for j in open_) else left / len(open_) for k in open_}
            full = {k for k in open_ if out[k] + want[k] >= caps[k]}
            if full:
                for k in full:
                    left -= caps[k] - out[k]
                    out[k] = caps[k]
                open_ -= full
                continue
            add = {k: math.floor(want[k]) for k in open_}
            spare = left - sum(add.values())
            for k in sorted(open_, key=lambda k: (math.floor(want[k]) - want[k], str(k)))[:spare]:
                add[k] += 1
            for k in open_:
                out[k] += add[k]
            left = 0
        return out

    caps = {d: sum(c for (e, _), (_, c) in sizes.items() if e == d) for d in domain_weights}
    per = fill(dict(domain_weights), caps, target)
    out: dict[tuple[str, str], int] = {}
    for d, n in per.items():
        own = {k: v for k, v in sizes.items() if k[0] == d}
        out |= fill({k: w for k, (w, _) in own.items()}, {k: c for k, (_, c) in own.items()}, n)
    return out


def numbered(refs: DataFrame, by: str = "source", order: list[str] | None = None, digits: int = 3) -> DataFrame:
    """refs with row_index, the position from 0 within its group in the order of the md5 of some columns, found without sorting a
    whole group in one task: only rows that agree in so many leading digits are ranked together."""
    order = order or ["sample_id", "line_number", "dataset_path"]
    r = refs.withColumn("_h", F.md5(F.concat_ws(":", *(F.col(c).cast("string") for c in order)))).withColumn("_p", F.substring("_h", 1, digits))
    c = r.groupBy(by, "_p").agg(F.count("*").alias("_n"))
    c = c.select(by, "_p", (F.sum("_n").over(Window.partitionBy(by).orderBy("_p")) - F.col("_n")).alias("_before"))
    at = F.col("_before") + F.row_number().over(Window.partitionBy(by, "_p").orderBy("_h", *order)) - 1
    return r.join(c, [by, "_p"]).withColumn("row_index", at).drop("_h", "_p", "_before")


def draw(refs: DataFrame, weights: dict[str, dict[str, float]], domain_weights: dict[str, float], target: int, factor: float = 3.0, seed: int = 42, mode: str = "hash") -> DataFrame:
    """A manifest of target draws with replacement within caps (M5): manifest_index, source, task_domain, split, sample_id,
    dataset_path, line_number, draw_index_within_dataset.

    hash: draws per pool are quotas by weight; the k-th draw of a pool takes row floor(u * size) with u from md5(seed:source:k),
    so every draw can be made anywhere. replay: the sequence of weighted choices of a seeded Mersenne generator, which depends on
    the pool sizes only and is made on the driver; rows are then looked up by position (refs in dataset_path, line_number order).
    """
    spark = refs.sparkSession
    p = [r.asDict() for r in pools(refs, weights, factor).orderBy("task_domain", "source").collect()]
    if mode == "replay":
        plan = spark.createDataFrame(_replay(p, weights, domain_weights, target, seed), "manifest_index bigint, task_domain string, source string, row_index bigint, draw_index_within_dataset bigint")
        at = F.row_number().over(Window.partitionBy("source").orderBy("dataset_path", "line_number")) - 1
        return plan.join(refs.drop("task_domain").withColumn("row_index", at), ["source", "row_index"]).select(
            "manifest_index", "source", "task_domain", F.lit("train").alias("split"), "sample_id", "dataset_path", "line_number", "draw_index_within_dataset")
    q = quotas({(r["task_domain"], r["source"]): (r["weight"], r["max_draws"]) for r in p}, domain_weights, target)
    rows, at = [], 0
    for r in p:
        n = q.get((r["task_domain"], r["source"]), 0)
        rows.append((r["task_domain"], r["source"], n, r["train_size"], at))
        at += n
    plan = spark.createDataFrame(rows, "task_domain string, source string, draws bigint, train_size bigint, first bigint")
    chunk = 100_000
    k = plan.select("*", F.explode(F.sequence(F.lit(0), F.greatest(F.ceil(F.col("draws") / chunk) - 1, F.lit(0)))).alias("c")).where("draws > 0")
    k = k.repartition("source", "c").select("*", F.explode(F.sequence(F.col("c") * chunk, F.least(F.col("draws"), (F.col("c") + 1) * chunk) - 1)).alias("k"))
    u = uniform_md5(F.lit(str(seed)), F.col("source"), F.col("k").cast("string"))
    picks = k.select("task_domain", "source", (F.col("k") + 1).alias("draw_index_within_dataset"), (F.col("first") + F.col("k")).alias("manifest_index"), F.floor(u * F.col("train_size")).alias("row_index"))
    return picks.join(numbered(refs.drop("task_domain")), ["source", "row_index"]).select(
        "manifest_index", "source", "task_domain", F.lit("train").alias("split"), "sample_id", "dataset_path", "line_number", "draw_index_within_dataset")


def _replay(p: list[dict], weights: dict, domain_weights: dict, target: int, seed: int) -> list[tuple]:
    rng = random.Random(seed)
    size = {r["source"]: r["train_size"] for r in p}
    left = {r["source"]: r["max_draws"] for r in p}
    cap = dict(left)
    if target > sum(left.values()):
        raise ValueError(f"{target} draws exceed the capacity of the pools")

    def choose(items: list[tuple[str, float]]) -> str:
        ends = list(accumulate(w for _, w in items))
        if not ends or ends[-1] <= 0:
            raise ValueError("weights sum to 0")
        return items[min(bisect_left(ends, rng.random() * ends[-1]), len(items) - 1)][0]

    out = []
    for i in range(target):
        d = choose([(d, w) for d, w in domain_weights.items() if any(left[s] > 0 for s in weights.get(d, {}))])
        s = choose([(s, w) for s, w in weights[d].items() if left[s] > 0])
        at = rng.randrange(size[s])
        left[s] -= 1
        out.append((i, d, s, at, cap[s] - left[s]))
    return out


def oversampling(manifest: DataFrame, p: DataFrame) -> DataFrame:
    """(task_domain, source, train_size, draws, max_draws, oversample_factor) (M6)."""
    n = manifest.groupBy("source").agg(F.count("*").alias("draws"))
    return p.join(n, "source", "left").fillna(0, ["draws"]).select("task_domain", "source", "train_size", "draws", "max_draws", (F.col("draws") / F.col("train_size")).alias("oversample_factor"))
