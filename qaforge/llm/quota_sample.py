"""Samples whose categories take given target shares, with a minimum from small categories.

Records are grouped by *signature*, the set of the request's categories that they belong to; there are few of them. The
number to draw from each signature is found by swap repair: a random sample that satisfies the minimum of every category as
far as the pool allows is changed by exchanging records of one signature for records of another while that lowers the
summed deviation from the target counts. Which records are drawn is then random, by exact selection within signatures.
"""

from __future__ import annotations

import random

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialise
from . import strata


def swap_repair(counts: dict[frozenset, int], targets: dict[str, float], floors: dict[str, int], n: int, seed: int = 42) -> dict[frozenset, int]:
    """How many records to draw from each signature. counts: pool records by signature; targets: wished counts."""
    rng = random.Random(seed)
    sigs = sorted(counts, key=lambda s: sorted(s))
    n = min(n, sum(counts.values()))
    take = dict.fromkeys(sigs, 0)

    def have(c: str) -> int:
        return sum(k for s, k in take.items() if c in s)

    for c in sorted(floors, key=lambda c: sum(k for s, k in counts.items() if c in s)):  # scarce categories first
        own = [s for s in sigs if c in s]
        rng.shuffle(own)
        for s in own:
            more = min(counts[s] - take[s], floors[c] - have(c), n - sum(take.values()))
            take[s] += max(0, more)
    rest = n - sum(take.values())
    left = sum(counts[s] - take[s] for s in sigs)
    for s in sigs:  # the rest at random, in expectation in proportion to what is left
        room = counts[s] - take[s]
        if left <= 0 or rest <= 0:
            break
        share = rest * room / left
        k = min(room, rest, int(share) + (rng.random() < share - int(share)))
        left -= room
        rest -= k
        take[s] += k
    for s in sigs:
        k = min(counts[s] - take[s], rest)
        take[s] += k
        rest -= k

    def cost(t: dict[frozenset, int]) -> float:
        total = 0.0
        for c, goal in targets.items():
            got = sum(k for s, k in t.items() if c in s)
            total += (got - goal) ** 2 / max(goal, 1.0) + 1e6 * max(0, min(floors.get(c, 0), sum(k for s, k in counts.items() if c in s)) - got)
        return total

    now, step = cost(take), max(1, n)
    while step:
        best, move = now, None
        for a in sigs:
            for b in sigs:
                if a == b or take[a] < step or counts[b] - take[b] < step:
                    continue
                take[a] -= step
                take[b] += step
                got = cost(take)
                if got < best - 1e-9:
                    best, move = got, (a, b)
                take[a] += step
                take[b] -= step
        if move:
            take[move[0]] -= step
            take[move[1]] += step
            now = best
        else:
            step //= 2
    return take


def _memberships(refs: DataFrame, samples: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(pool ids, (id, field_name, category)): distinct records that refs and samples both know, and what their rows name."""
    name = lambda c: F.lower(F.trim(F.col(c)))
    s = samples.where("id is not null").select("id", F.explode(F.array(F.struct(F.lit("task_type").alias("field_name"), name("task_type").alias("category")), F.struct(F.lit("language").alias("field_name"), name("language").alias("category")))).alias("x")).select("id", "x.*").distinct()
    r = refs.where("sample_id is not null").select(F.col("sample_id").alias("id"), F.lit("task_domain").alias("field_name"), name("task_domain").alias("category")).distinct()
    pool = r.select("id").distinct().join(s.select("id").distinct(), "id", "left_semi")
    return pool, r.unionByName(s)


def plan(refs: DataFrame, samples: DataFrame, targets: DataFrame, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """(drawn, report).

    drawn: (request_id, id), each record at most once per request. report: one row per request and category with
    target_share, min_rows, sample_size, pool_rows, needed_rows (the larger of min_rows and target_share * n), drawn_rows,
    drawn_share and reachable (whether the pool holds needed_rows).

    refs: (sample_id, task_domain); samples: (id, task_type, language); targets: (request_id, field_name, category,
    target_share, min_rows, sample_share). Names are trimmed and lower-cased; a record belongs to every category that one
    of its rows names. Rows with a NULL id are ignored, records of no category of a request can still be drawn for it.
    With an empty pool all counts are 0. targets is read to the driver: it is a list of requests, of fixed size.
    """
    spark = refs.sparkSession
    pool, named = _memberships(refs, samples)
    req = [r.asDict() for r in targets.select("request_id", "field_name", F.lower(F.trim("category")).alias("category"), "target_share", "min_rows", "sample_share").orderBy("request_id", "field_name", "category").collect()]
    wanted = spark.createDataFrame([(r["request_id"], r["field_name"], r["category"]) for r in req], "request_id int, field_name string, category string").distinct()
    hits = named.join(F.broadcast(wanted), ["field_name", "category"]).groupBy("id", "request_id").agg(F.array_sort(F.collect_set("category")).alias("signature"))
    rows = materialise(
        pool.select("id", F.explode(F.array(*(F.lit(k).cast("int") for k in sorted({r["request_id"] for r in req})))).alias("request_id"))
        .join(hits, ["id", "request_id"], "left").select("request_id", "id", F.coalesce("signature", F.array().cast("array<string>")).alias("signature"))
    )  # a row per record and request; requests are few
    seen: dict[int, dict[frozenset, int]] = {}
    for r in rows.groupBy("request_id", "signature").count().collect():  # at most 2^(categories of a request) rows
        seen.setdefault(r["request_id"], {})[frozenset(r["signature"])] = r["count"]
    budgets, report = [], []
    for k in sorted({r["request_id"] for r in req}):
        own, counts = [r for r in req if r["request_id"] == k], seen.get(k, {})
        size = sum(counts.values())
        n = own[0]["sample_share"] * size
        take = swap_repair(counts, {r["category"]: r["target_share"] * n for r in own}, {r["category"]: r["min_rows"] for r in own}, int(n), seed)
        budgets += [(k, sorted(s), float(v)) for s, v in take.items()]
        drawn = sum(take.values())
        for r in own:
            there, got = (sum(v for s, v in c.items() if r["category"] in s) for c in (counts, take))
            need = max(float(r["min_rows"]), r["target_share"] * n)
            report.append((k, r["field_name"], r["category"], r["target_share"], r["min_rows"], drawn, there, need, got, got / drawn if drawn else 0.0, there >= need - 1e-9 * need))  # a product of shares may be off in its last digit
    b = spark.createDataFrame(budgets, "request_id int, signature array<string>, budget double")
    drawn = strata.take(rows.withColumn("u", strata.uniform("request_id", "id", seed=seed)), b, ["request_id", "signature"], "u", None, "id").select("request_id", "id")
    return drawn, spark.createDataFrame(report, "request_id int, field_name string, category string, target_share double, min_rows int, sample_size bigint, pool_rows bigint, needed_rows double, drawn_rows bigint, drawn_share double, reachable boolean")
