"""Incremental scoring of samples that arrive as files: Structured Streaming in place of a resume file.

The checkpoint of the stream remembers which files were seen; ``foreachBatch`` writes each batch under its number, so that a
batch that is repeated after a failure replaces its own output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery


def arriving(spark: SparkSession, path: str, schema: T.StructType | str, files_per_batch: int = 100) -> DataFrame:
    """Stream of Parquet files that appear in a folder."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def first_deliveries(stream: DataFrame, key: str = "id", time: str = "ingested_at", late: str = "7 days") -> DataFrame:
    """Rows whose key was not seen before, as far back as late; NULL keys are dropped. State is bounded by the watermark."""
    return stream.where(F.col(key).isNotNull()).withWatermark(time, late).dropDuplicatesWithinWatermark([key])


def windowed_counts(stream: DataFrame, by: list[str], time: str = "ingested_at", window: str = "1 day", late: str = "2 days") -> DataFrame:
    """Rows per window and group; rows later than the watermark are left out."""
    return stream.withWatermark(time, late).groupBy(F.window(time, window).alias("window"), *by).agg(F.count("*").alias("n"))


def run_batches(stream: DataFrame, transform: Callable[[DataFrame], DataFrame], out: str, checkpoint: str) -> StreamingQuery:
    """Process what is there, batch by batch, into out/batch=N, then stop."""

    def write(batch: DataFrame, number: int) -> None:
        transform(batch).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
