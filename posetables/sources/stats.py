"""Statistics of shards, kept in versions.

A version is a small manifest that names Parquet folders. It is written under another name and renamed, which fails where that version
is there already: readers see all of an update or nothing of it, a run that is killed leaves the version before, and of two runs
at once one is told so. Each shard is kept with a fingerprint of its rows, so that a shard that changed is computed anew and one that
went is dropped. An update adds a folder; when there are more than MOST_PARTS, the next update writes one folder for all.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..operators.aggregates import PARTIAL, merge_partials, shard_partials

MOST_PARTS = 8
#: Versions that stay readable for those who began with them.
KEPT_VERSIONS = 3
_KEY = ["fraction", "shard_id"]


class Conflict(RuntimeError):
    """Another run wrote the version that this one was to be."""


class Files:
    """The few things that a manifest needs of the file system that a path belongs to."""

    def __init__(self, spark: SparkSession, root: str):
        jvm = spark.sparkContext._jvm
        self._path, self.root = jvm.org.apache.hadoop.fs.Path, root
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._path(root).getFileSystem(conf)
        self._context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._path(root).toUri() if "://" in root else self._fs.getUri(), conf)
        self._no_options = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        self._io = jvm.org.apache.commons.io.IOUtils

    def names(self) -> list[str]:
        folder = self._path(self.root)
        return [s.getPath().getName() for s in self._fs.listStatus(folder)] if self._fs.exists(folder) else []

    def text(self, name: str) -> str:
        stream = self._fs.open(self._path(f"{self.root}/{name}"))
        try:
            return bytes(self._io.toByteArray(stream)).decode()
        finally:
            stream.close()

    def create(self, name: str, text: str) -> None:
        """All of the file, or an error if it is there."""
        temporary = self._path(f"{self.root}/_{uuid.uuid4().hex}")
        stream = self._fs.create(temporary, False)
        stream.write(text.encode())
        stream.close()
        try:
            self._context.rename(temporary, self._path(f"{self.root}/{name}"), self._no_options)
        except Exception as e:
            self._fs.delete(temporary, False)
            if "FileAlreadyExistsException" in str(e):
                raise Conflict(f"{name} is there already") from None
            raise

    def remove(self, name: str) -> None:
        self._fs.delete(self._path(f"{self.root}/{name}"), True)


def fingerprints(observed: DataFrame) -> DataFrame:
    """shard_id, fingerprint: the same for the same rows in any order."""
    h = F.xxhash64(*sorted(observed.columns))
    other = F.xxhash64(F.lit(1), *sorted(observed.columns))
    return observed.groupBy("shard_id").agg(F.concat_ws("-", F.count("*"), F.hex(F.bit_xor(h)), F.hex(F.sum(F.shiftright(other, 20)))).alias("fingerprint"))


class StatsStore:
    """Partials of shards below a folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.files = spark, root.rstrip("/"), Files(spark, root.rstrip("/"))

    def manifest(self) -> dict:
        versions = sorted(n for n in self.files.names() if n.startswith("version-"))
        return json.loads(self.files.text(versions[-1])) if versions else {"version": 0, "parts": [], "batch": -1}

    def _rows(self, manifest: dict) -> DataFrame | None:
        """One row for each shard: what replaced it last, and what was added since."""
        if not manifest["parts"]:
            return None
        rows = self.spark.read.parquet(*[f"{self.root}/{p}" for p in manifest["parts"]])
        of_shard = Window.partitionBy(*_KEY)
        since = F.max(F.when(F.col("replaces"), F.col("version"))).over(of_shard)
        live = rows.withColumn("_since", F.coalesce(since, F.lit(0))).where("version >= _since")
        return live.groupBy(*_KEY).agg(F.max_by("fingerprint", "version").alias("fingerprint"), *[F.sum(c).alias(c) for c in PARTIAL]).where("n_images > 0")

    def read(self, fraction: float = 1.0) -> DataFrame:
        """shard_id and partials of the latest version."""
        rows = self._rows(self.manifest())
        if rows is None:
            raise ValueError(f"{self.root} holds no statistics yet")
        return rows.where(F.col("fraction") == fraction)

    def summary(self, fraction: float = 1.0) -> DataFrame:
        return merge_partials(self.read(fraction))

    def _commit(self, before: dict, rows: DataFrame, batch: int) -> None:
        """rows, with `replaces`, become a part of the next version; too many parts become one."""
        version, part = before["version"] + 1, f"part-{uuid.uuid4().hex}"
        columns = [*_KEY, "fingerprint", *PARTIAL, "replaces"]
        kept = before["parts"]
        rows.select(*columns).withColumn("version", F.lit(version)).write.parquet(f"{self.root}/{part}")
        after = {"version": version, "parts": [*kept, part], "batch": batch}
        if len(after["parts"]) > MOST_PARTS:
            whole = f"part-{uuid.uuid4().hex}"
            self._rows(after).withColumns({"replaces": F.lit(True), "version": F.lit(version)}).write.parquet(f"{self.root}/{whole}")
            self.files.remove(part)
            after["parts"] = [whole]
        self.files.create(f"version-{version:09}", json.dumps(after))
        self._sweep()

    def _sweep(self) -> None:
        """Old versions go, and parts that were only theirs. Parts that no version names may be of a run at work; they stay for a later call of vacuum()."""
        versions = sorted(n for n in self.files.names() if n.startswith("version-"))
        for old in versions[:-KEPT_VERSIONS]:
            gone = set(json.loads(self.files.text(old))["parts"])
            live = {p for v in versions[-KEPT_VERSIONS:] for p in json.loads(self.files.text(v))["parts"]}
            for part in gone - live:
                self.files.remove(part)
            self.files.remove(old)

    def vacuum(self) -> None:
        """Remove what killed runs left. No other run may be at work."""
        live = {p for n in self.files.names() if n.startswith("version-") for p in json.loads(self.files.text(n))["parts"]}
        for name in self.files.names():
            if name.startswith("_") or (name.startswith("part-") and name not in live):
                self.files.remove(name)

    def update(self, observed: DataFrame, fraction: float = 1.0) -> None:
        """Bring the store to the shards of observed: new and changed ones are computed, those that went are dropped.

        observed is read for the fingerprints, and then the pending shards again.
        """
        before = self.manifest()
        prints = fingerprints(observed)
        rows = self._rows(before)
        kept = rows.where(F.col("fraction") == fraction).select("shard_id", F.col("fingerprint").alias("known")) if rows is not None else self.spark.createDataFrame([], "shard_id long, known string")
        compared = prints.join(kept, "shard_id", "full")
        pending = compared.where("fingerprint IS NOT NULL AND NOT fingerprint <=> known").select("shard_id", "fingerprint")
        gone = compared.where("fingerprint IS NULL").select("shard_id")
        fresh = shard_partials(observed.join(pending.select("shard_id"), "shard_id", "left_semi")).join(pending, "shard_id")
        zeros: dict[str, Column] = {c: F.lit(0).cast(fresh.schema[c].dataType) for c in PARTIAL}
        dropped = gone.withColumns({**zeros, "fingerprint": F.lit(None).cast("string")})
        told = fresh.unionByName(dropped).withColumns({"fraction": F.lit(fraction), "replaces": F.lit(True)})
        self._commit(before, told, before["batch"])

    def add(self, observed: DataFrame, batch: int, fraction: float = 1.0) -> None:
        """Add rows of a stream's batch to what is kept of their shards; a batch that was added before is passed over."""
        before = self.manifest()
        if batch <= before["batch"]:
            return
        told = shard_partials(observed).withColumns({"fraction": F.lit(fraction), "replaces": F.lit(False), "fingerprint": F.lit(None).cast("string")})
        self._commit(before, told, batch)
