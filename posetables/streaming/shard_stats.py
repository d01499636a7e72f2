"""Shard statistics kept up to date as shards arrive."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..sources.records import read_records, register
from ..sources.stats import StatsStore


def _follow(stream: DataFrame, stats: str, checkpoint: str, observe: Callable[[DataFrame], DataFrame]) -> StreamingQuery:
    def update(batch: DataFrame, number: int) -> None:
        StatsStore(batch.sparkSession, stats).add(observe(batch), number)

    return stream.writeStream.foreachBatch(update).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def follow_shards(spark: SparkSession, source: str, schema: str, stats: str, checkpoint: str) -> StreamingQuery:
    """Read what is new below source (observations, each frame in one file), and add the partials of the shards met.

    A batch that is run again after a failure is passed over if it was added; a shard that arrives in several batches adds up.
    """
    return _follow(spark.readStream.schema(schema).parquet(source), stats, checkpoint, lambda batch: batch)


def follow_records(spark: SparkSession, root: str, keys: list[str], stats: str, checkpoint: str, observe: Callable[[DataFrame], DataFrame]) -> StreamingQuery:
    """The same over record shards below root, from whose rows observe makes observations. Keys that a record lacks are null."""
    register(spark)
    stream = spark.readStream.format("pose_records").schema(_schema_of(spark, root, keys)).load(root)
    return _follow(stream, stats, checkpoint, observe)


def _schema_of(spark: SparkSession, root: str, keys: list[str]):
    return read_records(spark, root, keys).schema


def summary(spark: SparkSession, stats: str) -> DataFrame:
    """Dataset statistics of all shards so far."""
    return StatsStore(spark, stats).summary()
