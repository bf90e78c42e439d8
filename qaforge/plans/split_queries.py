"""Splits, merging, validation and profiles over qa_samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema
from ..functions import text as T
from ..operators import merge, splits
from ..session import table
from .sqlbits import WS, canonical, strip


def _qa(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "qa_samples")


def resplit_assign(spark: SparkSession, d: str) -> DataFrame:
    return splits.resplit(_qa(spark, d).select("row_id", "source"), key="row_id").select("row_id", "source", "split")


def resplit_counts(spark: SparkSession, d: str) -> DataFrame:
    return resplit_assign(spark, d).groupBy("source", "split").agg(F.count("*").alias("n"))


def canonical_split_counts(spark: SparkSession, d: str) -> DataFrame:
    return splits.distribution(_qa(spark, d))


def complete_split(spark: SparkSession, d: str) -> DataFrame:
    return splits.completeness(_qa(spark, d))


def preserved_split(spark: SparkSession, d: str) -> DataFrame:
    return splits.preserved(_qa(spark, d).select("row_id", "split")).select("row_id", "raw_split", "split")


def assigned(spark: SparkSession, d: str) -> DataFrame:
    named = _qa(spark, d).where(splits.canonical(F.col("split")) != "").select("row_id", "source", "split")
    whole = named.where("source <> 'finqa' or lower(trim(split)) not like 'test%'")  # one source lacks a split and is split anew
    return splits.split_dataset(whole, key="row_id")


def split_dataset_counts(spark: SparkSession, d: str) -> DataFrame:
    return assigned(spark, d).groupBy("source", "split").agg(F.count("*").alias("n"))


def global_merge_fields(spark: SparkSession, d: str) -> DataFrame:
    df = merge.with_model_fields(_qa(spark, d).select("row_id", "source", splits.canonical(F.col("split")).alias("split")))
    return df.groupBy("source", "split").agg(F.count("*").alias("n"), F.count("model_answer").alias("answers"), F.count("model_reasoning").alias("reasonings"))


def legacy_bucket(spark: SparkSession, d: str) -> DataFrame:
    b = _qa(spark, d).select(splits.bucket(F.col("source"), F.col("split")).alias("bucket"), "source", T.strip(F.col("split")).alias("raw_split"))
    return b.groupingSets([["bucket"], ["bucket", "source"], ["bucket", "raw_split"]], "bucket", "source", "raw_split").agg(F.count("*").alias("n"), F.grouping_id().alias("level"))


def validate_records(spark: SparkSession, d: str) -> DataFrame:
    fields = schema.SAMPLE.fieldNames()
    lines = _qa(spark, d).select("row_id", F.to_json(F.struct(*fields)).alias("value"))
    return merge.validate(lines, fields).select("row_id", F.array_join("issues", ",").alias("issues"))


def missing_fields(spark: SparkSession, d: str) -> DataFrame:
    q = _qa(spark, d)
    return q.select("source", F.explode(merge.missing_values(q)).alias("field")).groupBy("source", "field").agg(F.count("*").alias("n"))


def duplicate_ids(spark: SparkSession, d: str) -> DataFrame:
    return merge.repeats(_qa(spark, d).select("row_id", "id"), "id", ["row_id"]).select("id", "row_id", "occurrence")


def latest_rows(spark: SparkSession, d: str) -> DataFrame:
    return merge.latest(_qa(spark, d).select("id", "row_id", "source", "ingested_at"), "id", ["ingested_at", "row_id"]).select("id", "row_id", "source")


def profile_by_source(spark: SparkSession, d: str) -> DataFrame:
    return merge.profile(_qa(spark, d), "source", ["task_type", "task_domain", "language"], ["context", "model_reasoning"])


def shard_slice(spark: SparkSession, d: str) -> DataFrame:
    return merge.slice_rows(table(spark, d, "orders").select("o_orderkey", "o_custkey"), ["o_orderkey", "o_custkey"], 1000, 3000).select("position", "o_orderkey", "o_custkey")


def event_windows(spark: SparkSession, d: str) -> DataFrame:
    return _qa(spark, d).where("ingested_at is not null").groupBy(F.window("ingested_at", "1 day").alias("w"), "source").agg(F.count("*").alias("n")).select(F.col("w.start").alias("day"), "source", "n")


_SIZES = """
sized as (select source, n, 0.8e0 * (n - 3) as a, 0.1e0 * (n - 3) as b, 0.1e0 * (n - 3) as c from (select source, count(*) as n from rows group by source)),
spare as (select source, n, floor(a) as fa, floor(b) as fb, floor(c) as fc, a - floor(a) as ra, b - floor(b) as rb, c - floor(c) as rc, n - 3 - floor(a) - floor(b) - floor(c) as k from sized),
cuts as (select source,
  1 + fa + case when (case when rb > ra then 1 else 0 end) + (case when rc > ra then 1 else 0 end) < k then 1 else 0 end as train,
  1 + fb + case when (case when ra >= rb then 1 else 0 end) + (case when rc > rb then 1 else 0 end) < k then 1 else 0 end as val from spare),
placed as (select row_id, source, row_number() over (partition by source order by md5(concat('42:', cast(row_id as varchar))), row_id) as pos from rows),
assigned as (select row_id, p.source, case when pos <= train then 'train' when pos <= train + val then 'val' else 'test' end as split from placed p join cuts c on p.source = c.source)
"""
_ROWS = "with rows as (select row_id, source from qa_samples),"
_KEPT = f"""
named as (select row_id, source, {canonical('split')} as split from qa_samples where {canonical('split')} <> '' and (source <> 'finqa' or coalesce(lower(trim(split)), '') not like 'test%')),
whole as (select source from named group by source having count(distinct split) = 3)
"""
_FIELDS = ["id", "source", "split", "task_type", "task_domain", "language", "question", "context", "options", "reference_answer", "metadata"]
_TEXT = [f for f in _FIELDS if f not in ("options", "metadata")]
_ISSUES = (
    "list_sort(list_filter(["
    + f"case when {' or '.join(f + ' is null' for f in _FIELDS)} then 'field_set_mismatch' end, "
    + ", ".join(f"case when {f} is null then '{f}_not_string' end" for f in _TEXT)
    + ", case when options is null then 'options_not_list' end, 'metadata_not_dict'], lambda x: x is not null))"
)

QUERIES = {
    f.__name__: f
    for f in (
        resplit_assign, resplit_counts, canonical_split_counts, complete_split, preserved_split, split_dataset_counts, global_merge_fields, legacy_bucket, validate_records,
        missing_fields, duplicate_ids, latest_rows, profile_by_source, shard_slice, event_windows,
    )
}

ORACLES = {
    "resplit_assign": _ROWS + _SIZES + "select row_id, source, split from assigned",
    "resplit_counts": _ROWS + _SIZES + "select source, split, count(*) as n from assigned group by source, split",
    "canonical_split_counts": f"select source, coalesce(nullif({strip('split')}, ''), '__missing__') as raw_split, coalesce(nullif({canonical('split')}, ''), '__missing__') as canonical_split, count(*) as n from qa_samples group by all",
    "complete_split": f"select source, count(*) as n, bool_and(c <> '') and count(distinct c) = 3 as preserved from (select source, {canonical('split')} as c from qa_samples) group by source",
    "preserved_split": f"select row_id, {strip('split')} as raw_split, {canonical('split')} as split from qa_samples",
    "split_dataset_counts": f"with {_KEPT}, rows as (select row_id, source from named where source not in (select source from whole)), {_SIZES} "
    "select source, split, count(*) as n from (select source, split from assigned union all select source, split from named where source in (select source from whole)) group by all",
    "global_merge_fields": f"select source, s as split, count(*) as n, count(*) as answers, sum(case when s = 'test' then 0 else 1 end)::bigint as reasonings from (select source, {canonical('split')} as s from qa_samples) group by all",
    "legacy_bucket": f"""select bucket, source, raw_split, count(*) as n, cast(grouping(bucket, source, raw_split) as bigint) as level from (
        select source, {strip('split')} as raw_split, case when lower({strip('split')}) like 'test%' and source in ('finqa', 'convfinqa') then 'test' when lower({strip('split')}) like 'test%' then 'val'
          when lower({strip('split')}) in ('dev', 'val', 'valid', 'validation', 'eval') then 'val' else 'train' end as bucket from qa_samples)
        group by grouping sets ((bucket), (bucket, source), (bucket, raw_split))""",
    "validate_records": f"select row_id, array_to_string({_ISSUES}, ',') as issues from qa_samples where len({_ISSUES}) > 0",
    "missing_fields": "select source, field, count(*) as n from (select source, unnest(["
    + ", ".join(f"case when {strip(f)} = '' then '{f}' end" for f in _TEXT)
    + "]) as field from qa_samples) where field is not null group by all",
    "duplicate_ids": "select id, row_id, o as occurrence from (select id, row_id, row_number() over (partition by id order by row_id) as o from qa_samples where id is not null) where o > 1",
    "latest_rows": "select id, row_id, source from (select *, row_number() over (partition by id order by ingested_at desc nulls last, row_id desc) as o from qa_samples where id is not null and id <> '') where o = 1",
    "profile_by_source": """with t as (select source, count(*) as total from qa_samples group by source),
      m as (select source, 'task_type' as metric, coalesce(task_type, '') as value, count(*) as n from qa_samples group by all
        union all select source, 'task_domain', coalesce(task_domain, ''), count(*) from qa_samples group by all
        union all select source, 'language', coalesce(language, ''), count(*) from qa_samples group by all
        union all select source, 'empty_context', '', count(*) filter (coalesce(context, '') = '') from qa_samples group by all
        union all select source, 'empty_model_reasoning', '', count(*) filter (coalesce(model_reasoning, '') = '') from qa_samples group by all
        union all select source, 'rows', '', count(*) from qa_samples group by all)
      select m.source, metric, value, n, n::double / total as ratio from m join t on m.source = t.source""",
    "shard_slice": "select o as position, o_orderkey, o_custkey from (select row_number() over (order by o_orderkey, o_custkey) - 1 as o, o_orderkey, o_custkey from orders) where o >= 1000 and o < 3000",
    "event_windows": "select cast(date_trunc('day', ingested_at) as timestamp) as day, source, count(*) as n from qa_samples where ingested_at is not null group by all",
}
