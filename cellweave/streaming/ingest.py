"""Append-only ingestion of features: each micro-batch adds its sums per cell to a partial table.

Every cell metric is a sum, so totals are sums of the batches' partial sums; a batch that is
repeated after a failure replaces its own folder.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def ingest(stream: DataFrame, metrics: Callable[[DataFrame], DataFrame], out: str, checkpoint: str) -> StreamingQuery:
    """Start the stream; ``metrics`` turns a batch of features into sums per cell."""

    def add(batch: DataFrame, number: int) -> None:
        metrics(batch).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def totals(spark: SparkSession, out: str, key: str = "cell", drop: Sequence[str] = ("avg_height_m",)) -> DataFrame:
    """Sums over all batches so far."""
    rows = spark.read.parquet(out).drop("batch", *drop)
    return rows.groupBy(key).agg(*[F.sum(c).alias(c) for c in rows.columns if c != key])


def compact(spark: SparkSession, out: str, target: str, key: str = "cell") -> None:
    """The totals as one table, for readers that should not see batches."""
    totals(spark, out, key).write.mode("overwrite").parquet(target)


def windowed(stream: DataFrame, time: str, width: str, late: str, key: str, value: str) -> DataFrame:
    """Counts and sums by time window and key, with rows later than ``late`` left out."""
    return stream.withWatermark(time, late).groupBy(F.window(time, width), key).agg(F.count("*").alias("n"), F.sum(value).alias("total"))
