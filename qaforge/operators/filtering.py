"""Keep and drop decisions, joins with verdicts, and summaries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import merge

# fixed values: mismatch types under which an answer judged inconsistent is still kept
SOFT_MISMATCHES = ("rounding", "percent_decimal_equivalent", "format_only", "none")


def keep_soft(consistent: Column, mismatch: Column) -> Column:
    """keep if consistent, or inconsistent for a soft reason only."""
    soft = F.coalesce(mismatch, F.lit("")).isin(*SOFT_MISMATCHES)
    return F.when(F.coalesce(consistent, F.lit(False)) | F.coalesce(soft, F.lit(False)), "keep").otherwise("drop")


def with_verdict(samples: DataFrame, judged: DataFrame, key: str = "id", order: list[str] | None = None) -> DataFrame:
    """samples left-joined with the last verdict of each key (F5): bucket keep (score 1 and success), drop, or missing_judge.

    Verdicts are reduced to one row per key before the join; an empty key never joins.
    """
    order = order or ["judged_at"]
    last = merge.latest(judged.select(key, "judge_success", "judge", *(c for c in order if c not in (key, "judge_success", "judge"))), key, order)
    j = samples.join(last.select(key, "judge_success", "judge"), key, "left")
    bucket = F.when(F.col("judge_success").isNull(), "missing_judge").when(F.col("judge_success") & (F.col("judge.score") == 1), "keep").otherwise("drop")
    return j.withColumn("bucket", bucket)


def summary(judged: DataFrame, by: list[str]) -> DataFrame:
    """Counts and rates of verdicts per group (F7): total, success, failure, keep (score 1), keep_rate (of successes, 0 if
    none), rule and llm scored, mean latency over positive ones (0 if none)."""
    score, mode, lat = F.col("judge.score"), F.col("judge.scoring_mode"), F.col("judge_latency_ms")
    return judged.groupBy(*by).agg(
        F.count("*").alias("total"),
        F.count_if("judge_success").alias("success"),
        F.count_if(~F.coalesce(F.col("judge_success"), F.lit(False))).alias("failure"),
        F.count_if(score == 1).alias("keep"),
        F.coalesce(F.try_divide(F.count_if(score == 1), F.count_if("judge_success")), F.lit(0.0)).alias("keep_rate"),
        F.count_if(mode == "rule").alias("rule_scored"),
        F.count_if(mode == "llm").alias("llm_scored"),
        F.coalesce(F.avg(F.when(lat > 0, lat)), F.lit(0.0)).alias("mean_latency_ms"),
    )


def mismatch_counts(judged: DataFrame, by: list[str]) -> DataFrame:
    """Rows per group and non-empty mismatch type."""
    m = F.col("judge.mismatch_type")
    return judged.where(m.isNotNull() & (m != "")).groupBy(*by, m.alias("mismatch_type")).agg(F.count("*").alias("n"))


def rule_first(samples: DataFrame, rule: Column, model: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """samples with a column judge: by rule where it settles the row, else by the model (F1, F2).

    The rows are split before the model is called, as a Python function within a condition would run for every row. Without a
    model, rows that the rules do not settle have a NULL judge.
    """
    ruled = samples.withColumn("judge", rule)
    done = ruled.where("judge.score is not null")
    rest = ruled.where("judge.score is null").drop("judge")
    asked = model(rest) if model else rest.withColumn("judge", F.lit(None).cast(dict(done.dtypes)["judge"]))
    return done.unionByName(asked, allowMissingColumns=True)


def stage_buckets(first: Column, second: Column) -> Column:
    """Where a sample ends in the two-stage filter (F1): dropped at the answer, dropped at the reasoning, kept; a missing
    verdict is 0."""
    return F.when(F.coalesce(first, F.lit(0)) != 1, "answer_drop").when(F.coalesce(second, F.lit(0)) != 1, "reasoning_drop").otherwise("keep")


def publish(artifacts: dict[str, DataFrame], path: str, by: str = "artifact") -> DataFrame:
    """Write all artifacts as one table partitioned by their names (K2-K4, K8) and return rows per artifact."""
    parts = [df.withColumn(by, F.lit(name)) for name, df in artifacts.items()]
    merge.union_all(parts).write.mode("overwrite").partitionBy(by).parquet(path)
    return next(iter(artifacts.values())).sparkSession.read.parquet(path).groupBy(by).agg(F.count("*").alias("n"))
