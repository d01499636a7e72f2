"""The folder that the driver and all executors share."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir.

    Where nothing is set, a local session gets a new one; on a cluster that is an error, because a folder of the driver's
    machine is none of the executors'.
    """
    context = spark.sparkContext
    if not context._jsc.sc().getCheckpointDir().isDefined():
        named = context.getConf().get("spark.checkpoint.dir")
        if not named and not (context.master == "local" or context.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="spark-"))
    return context._jsc.sc().getCheckpointDir().get()


def mounted(path: str) -> str:
    """A path of the shared folder as Python's open() takes it; an error where it isn't mounted."""
    parts = urlparse(path)
    if parts.scheme not in ("", "file"):
        raise RuntimeError(f"{path}: record files are written to a mounted folder")
    return parts.path


#: Spark's setting for removing the shuffle files of a query once it has ended.
_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _cleaned(spark: SparkSession):
    """Queries within let go of their shuffle files as soon as they have ended."""
    before = spark.conf.get(_CLEAN, "false")
    spark.conf.set(_CLEAN, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEAN, before)


def shared(df: DataFrame) -> DataFrame:
    """df, written to the shared folder, so that it outlives executors and is computed once.

    The shuffle files that were needed to make it go as soon as it is written.
    """
    spark = df.sparkSession
    shared_folder(spark)
    with _cleaned(spark):
        return df.select("*").checkpoint(eager=True)  # a query of its own, which takes the setting


def written(df: DataFrame) -> DataFrame:
    """shared(), as compressed Parquet: smaller, and read by column. The files stay until the shared folder goes."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/written-{uuid.uuid4().hex}"
    with _cleaned(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.parquet(path)
