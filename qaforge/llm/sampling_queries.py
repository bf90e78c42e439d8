"""Queries of the sampling operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import quota_sample
from ..session import table


def _plan(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return quota_sample.plan(table(spark, sf_dir, "sample_refs"), table(spark, sf_dir, "qa_samples"), table(spark, sf_dir, "sample_targets"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plan(spark, sf_dir)[1].where("not reachable").select("request_id", "category")


def p3_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plan(spark, sf_dir)[0]


def p3_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per request and category: pool and needed rows, and whether they suffice; what was drawn is in p3_sample and p3_checks."""
    return _plan(spark, sf_dir)[1].select("request_id", "field_name", "category", "target_share", "min_rows", "pool_rows", "needed_rows", "reachable")


def p3_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What must hold of every sample: its size, no record twice, minimums met as far as the pool goes, at most as many of a
    category as the pool has."""
    drawn, report = _plan(spark, sf_dir)
    per = drawn.groupBy("request_id").agg(F.count("*").alias("drawn"), (F.count("*") - F.countDistinct("id")).alias("repeated"))
    kept = report.groupBy("request_id").agg(F.bool_and(F.col("drawn_rows") >= F.least("min_rows", "pool_rows")).alias("floors_met"), F.bool_and(F.col("drawn_rows") <= F.col("pool_rows")).alias("within_pool"))
    return per.join(kept, "request_id")


_POOL = """
with pool as (select distinct sample_id as id from sample_refs where sample_id in (select id from qa_samples)),
named as (
  select distinct sample_id as id, 'task_domain' as field_name, lower(trim(task_domain)) as category from sample_refs
  union all select distinct id, 'task_type', lower(trim(task_type)) from qa_samples
  union all select distinct id, 'language', lower(trim(language)) from qa_samples),
have as (
  select t.request_id, t.field_name, t.category, t.target_share, t.min_rows, t.target_share * (t.sample_share * (select count(*) from pool)) as goal,
    (select count(*) from pool p join named n on p.id = n.id where n.field_name = t.field_name and n.category = t.category) as n
  from sample_targets t)
"""

QUERIES = {"p3_found": p3_found, "p3_sample": p3_sample, "p3_report": p3_report, "p3_checks": p3_checks}
ORACLES = {
    "p3_found": _POOL + "select request_id, category from have where n < greatest(min_rows, goal) * (1 - 1e-9)",
    "p3_report": _POOL + "select request_id, field_name, category, target_share, min_rows, n as pool_rows, greatest(min_rows, goal) as needed_rows, n >= greatest(min_rows, goal) * (1 - 1e-9) as reachable from have",
    "p3_checks": _POOL + """select request_id, floor(any_value(sample_share) * (select count(*) from pool))::bigint as drawn, 0::bigint as repeated, true as floors_met, true as within_pool
      from sample_targets group by request_id""",
}
