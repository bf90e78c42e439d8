"""Queries of the operators on pairs of records, and brute-force SQL for them: word bags of all distinct texts, pairs that share
one of their rarest words (a prefix filter, which loses nothing), exact likeness."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import table
from . import crosssplit, neardup


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicate_pairs(table(spark, sf_dir, "qa_samples"))


def p1_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each record with the number of records that are alike, without forming pairs of records."""
    return neardup.groups(table(spark, sf_dir, "qa_samples")).select("id", (F.col("copies") + F.col("links")).alias("alike"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crosssplit.overlap_pairs(table(spark, sf_dir, "qa_samples"))


def p5_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crosssplit.overlap_report(table(spark, sf_dir, "qa_samples"))


QUERIES = {f.__name__: f for f in (p1_found, p1_groups, p5_found, p5_report)}

_BAGS = r"""
rec as materialized (select id, arg_min(coalesce(question, ''), row_id) as q, arg_min(coalesce(context, ''), row_id) as c, arg_min(source, row_id) as source, lower(trim(arg_min(coalesce(split, ''), row_id))) as split from qa_samples where id is not null group by id),
txt as (select q as t from rec union select c from rec),
tok as (select t, unnest(regexp_extract_all(regexp_replace(regexp_replace(lower(t), '([0-9])[.,]([0-9])', '\1\2', 'g'), '([0-9])[.,]([0-9])', '\1\2', 'g'), '[\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}\x{F900}-\x{FAFF}]|[\p{Latin}\p{Greek}\p{Cyrillic}\p{N}]+')) as w from txt),
numbered as materialized (select t, w || '#' || row_number() over (partition by t, w) as w from tok),
bag as materialized (select txt.t, coalesce(list(w) filter (w is not null), []) as ws, count(w) as n from txt left join numbered using (t) group by txt.t),
freq as (select w, count(*) as df from numbered group by w),
rare as materialized (select t, w from (select t, w, row_number() over (partition by t order by df, w) as o, count(*) over (partition by t) as n from numbered join freq using (w)) where o <= n - ceil(0.85 * n / 1.15 - 1e-9) + 1),
near as materialized (select distinct x.t as ta, y.t as tb from rare x join rare y using (w) where x.t <> y.t),
alike as materialized (select ta, tb from near join bag a on a.t = ta join bag b on b.t = tb where abs(a.n - b.n) <= 0.15 * (a.n + b.n) + 1e-9 and 2 * len(list_intersect(a.ws, b.ws)) >= 0.85 * (a.n + b.n) - 1e-9
  union select a.t, b.t from bag a join bag b on a.n = 0 and b.n = 0 or a.t = b.t)
"""
_PAIRS = "select x.id as id_a, y.id as id_b, x.split as sa, y.split as sb from alike q join rec x on x.q = q.ta join rec y on y.q = q.tb and x.id < y.id join alike c on c.ta = x.c and c.tb = y.c"
_TRAIN, _VAL, _TEST = "('train', 'training')", "('val', 'dev', 'valid', 'validation')", "('test', 'test_gold')"
_SIDE = f"case when split in {_VAL} then 'val' when split in {_TEST} then 'test' end"

ORACLES = {
    "p1_found": f"with{_BAGS}select id_a, id_b from ({_PAIRS})",
    "p1_groups": f"""with{_BAGS}, pairs as materialized ({_PAIRS}), ends as (select id_a as id from pairs union all select id_b from pairs)
      select rec.id, count(ends.id) as alike from rec left join ends on rec.id = ends.id group by rec.id""",
    "p5_found": f"""with{_BAGS}select id_a, id_b from ({_PAIRS}) where sa in {_TRAIN} and (sb in {_VAL} or sb in {_TEST}) or sb in {_TRAIN} and (sa in {_VAL} or sa in {_TEST})""",
    "p5_report": f"""with{_BAGS}, pairs as materialized ({_PAIRS}), hit as (select id_b as id from pairs where sa in {_TRAIN} union select id_a from pairs where sb in {_TRAIN})
      select {_SIDE} as split, source, count(*) as records, count(hit.id) as overlapping, count(hit.id) / count(*) as share from rec left join hit on rec.id = hit.id where {_SIDE} is not null group by all""",
}
