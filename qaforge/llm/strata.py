"""Exact selections within strata without sorting a stratum in one task.

Rows of a stratum are ordered by a number in [0, 1). ``take`` picks those whose running size stays within the stratum's
budget. The order is cut into BINS ranges; sizes are summed per range (a small table), ranges that fit whole are taken
whole, and only the one range in which a budget ends is ordered row by row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BINS = 65_536


def uniform(*cols: Column | str, seed: int = 42) -> Column:
    """A number in (0, 1) fixed by the values of cols and the seed."""
    h = F.xxhash64(F.lit(seed), *cols)
    return (F.shiftrightunsigned(h, 11).cast("double") + F.lit(0.5)) / F.lit(float(2**53))


def take(rows: DataFrame, budgets: DataFrame, on: list[str], order: str, size: str | None, tie: str) -> DataFrame:
    """The rows of each stratum, by ascending order (tie breaks ties), whose running size is at most the budget.

    rows: on, order in [0, 1), size (1 if None), tie, ...; budgets: on, budget (NULL and absent: nothing is taken).
    Strata with no row give none; rows with a NULL stratum or order are not taken.
    """
    r = rows.where(F.col(order).isNotNull()).withColumn("_size", F.col(size).cast("double") if size else F.lit(1.0))
    r = r.withColumn("_bin", F.least(F.floor(F.col(order) * BINS), F.lit(BINS - 1)).cast("int"))
    b = budgets.select(*on, F.col("budget").cast("double").alias("_budget"))
    w = Window.partitionBy(*on).orderBy("_bin")
    sums = (
        r.groupBy(*on, "_bin").agg(F.sum("_size").alias("_sum"))
        .withColumn("_upto", F.sum("_sum").over(w))
        .join(b, on)
        .withColumn("_before", F.col("_upto") - F.col("_sum"))
        .where("_before < _budget")
        .select(*on, "_bin", "_before", "_budget", (F.col("_upto") <= F.col("_budget")).alias("_whole"))
    )
    cut = r.join(sums, [*on, "_bin"])
    whole = cut.where("_whole")
    w2 = Window.partitionBy(*on, "_bin").orderBy(order, tie).rowsBetween(Window.unboundedPreceding, 0)
    part = cut.where("not _whole").withColumn("_run", F.col("_before") + F.sum("_size").over(w2)).where("_run <= _budget").drop("_run")
    return whole.unionByName(part).drop("_size", "_bin", "_before", "_budget", "_whole")
