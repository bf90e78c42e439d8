"""All registered queries of the core library, by name, and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import answer_queries, pipeline_queries, source_queries, split_queries, text_queries

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

for _m in (split_queries, text_queries, answer_queries, pipeline_queries, source_queries):
    QUERIES.update(_m.QUERIES)
    ORACLES.update(_m.ORACLES)
