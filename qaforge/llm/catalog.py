"""Registered queries of this subpackage, and SQL where it can express them; the others are tested on small fixtures."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import table
from . import langid, leakage, mixing, pairs, pairs_queries, sampling_queries, truncation


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return truncation.cut_values(table(spark, sf_dir, "qa_samples"))


def p2_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return truncation.report(table(spark, sf_dir, "qa_samples"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs.defective_pairs(table(spark, sf_dir, "qa_samples"), langid.fit(table(spark, sf_dir, "documents")))


def p4_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p4_found(spark, sf_dir).groupBy("defect").agg(F.count("*").alias("records"))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leakage.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items")).select("doc_id", "item_id")


def p6_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leakage.leaked_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items")).select("item_id", "documents")


def _mix(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return mixing.mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets"))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mix(spark, sf_dir)[1].where("not reachable").select("mix_id", "source")


def p7_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mix(spark, sf_dir)[0]


def p7_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mix(spark, sf_dir)[1]


def p7_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What must hold of every mix: no source gives more than its share, none repeats a document above its cap, and a source that
    can reach its share lies below it by less than four of its largest drawn documents, or gives all it has."""
    drawn, report = _mix(spark, sf_dir)
    docs = drawn.groupBy("mix_id", "source").agg(F.max("repeats").alias("most"), F.max("tokens").alias("largest"))
    r = report.join(docs, ["mix_id", "source"], "left").fillna(0, ["most", "largest"])
    gap = F.col("wanted_tokens") - F.col("drawn_tokens")
    full = F.col("drawn_tokens") == F.col("source_tokens") * F.col("max_repeats")
    return r.select("mix_id", "source", (gap >= -1e-6).alias("within_share"), (F.col("most") <= F.col("max_repeats")).alias("within_cap"), (~F.col("reachable") | full | (gap < F.greatest("largest", F.lit(1)) * 4)).alias("close"))


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.unnamed_languages(table(spark, sf_dir, "documents"))


def p8_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.labels(table(spark, sf_dir, "documents"))


def p8_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.segments(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (p2_found, p2_report, p4_found, p4_report, p6_found, p6_report, p7_found, p7_mix, p7_report, p7_checks, p8_found, p8_labels, p8_segments)
}
ORACLES: dict[str, str] = {"p7_checks": "select mix_id, lower(trim(source)) as source, true as within_share, true as within_cap, true as close from mix_targets"}
for _m in (pairs_queries, sampling_queries):
    QUERIES.update(_m.QUERIES)
    ORACLES.update(_m.ORACLES)
