"""Sharded Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_shards(frames: DataFrame, path: str) -> None:
    """A folder for each shard of a subset, its frames in order. A shard that is written again replaces itself; the others stay."""
    n = int(frames.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = frames.repartition(n, "subset", "shard_id").sortWithinPartitions("subset", "shard_id", "frame_id")
    dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("subset", "shard_id").parquet(path)
