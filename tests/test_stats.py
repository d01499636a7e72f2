"""The store of shard statistics: changed shards, killed runs, two runs at once, few files."""

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from posetables.fixtures import read
from posetables.operators.aggregates import merge_partials, observations, shard_partials
from posetables.sources import stats
from posetables.sources.records import write_records
from posetables.streaming.shard_stats import follow_records, summary

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def observed(spark):
    made = observations(read(spark, SF, "fx_frames"), read(spark, SF, "fx_annotations")).where("shard_id < 12").cache()
    yield made
    made.unpersist()


def whole(df):
    return merge_partials(shard_partials(df)).first()


def parts(root: Path) -> list[str]:
    return sorted(p.name for p in root.iterdir() if p.name.startswith("part-"))


def computed(store) -> int:
    """Shards in the newest part."""
    return store.spark.read.parquet(f"{store.root}/{store.manifest()['parts'][-1]}").count()


def test_new_changed_and_gone_shards(spark, observed, tmp_path):
    store = stats.StatsStore(spark, str(tmp_path / "s"))
    with pytest.raises(ValueError, match="no statistics"):
        store.read()
    store.update(observed.where("shard_id < 8"))
    assert computed(store) == 8 and store.summary().first() == whole(observed.where("shard_id < 8"))
    store.update(observed.repartition(7))
    assert computed(store) == 4 and store.summary().first() == whole(observed)
    store.update(observed)
    assert computed(store) == 0
    changed = observed.withColumn("dist", F.when(F.col("shard_id") == 3, F.col("dist") + 1).otherwise(F.col("dist"))).where("shard_id <> 9")
    store.update(changed)
    assert computed(store) == 2 and store.summary().first() == whole(changed)  # one changed, one gone
    assert store.read().where("shard_id = 9").count() == 0
    store.update(observed.where("shard_id < 2"), fraction=0.5)
    assert store.summary(0.5).first() == whole(observed.where("shard_id < 2")) and store.summary().first() == whole(changed)


def test_killed_runs_leave_the_old_version(spark, observed, tmp_path, monkeypatch):
    root = tmp_path / "s"
    store = stats.StatsStore(spark, str(root))
    store.update(observed.where("shard_id < 4"))
    before, found = parts(root), store.summary().first()
    bad = observed.withColumn("dist", F.when(F.col("shard_id") == 6, F.raise_error("lost").cast("double")).otherwise(F.col("dist")))
    with pytest.raises(Exception, match="lost"):
        store.update(bad)
    assert store.summary().first() == found and store.manifest()["version"] == 1

    def killed(self, name, text):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(stats.Files, "create", killed)
        with pytest.raises(KeyboardInterrupt):
            store.update(observed)
    assert store.summary().first() == found and len(parts(root)) > 1
    store.vacuum()
    assert parts(root) == before and store.summary().first() == found


def test_two_runs_at_once(spark, observed, tmp_path, monkeypatch):
    store = stats.StatsStore(spark, str(tmp_path / "s"))
    store.update(observed.where("shard_id < 4"))
    old = store.manifest()
    store.update(observed.where("shard_id < 6"))
    monkeypatch.setattr(stats.StatsStore, "manifest", lambda self: old)
    with pytest.raises(stats.Conflict):
        store.update(observed)
    monkeypatch.undo()
    assert store.summary().first() == whole(observed.where("shard_id < 6"))


def test_files_stay_few(spark, observed, tmp_path, monkeypatch):
    monkeypatch.setattr(stats, "MOST_PARTS", 3)
    root = tmp_path / "s"
    store = stats.StatsStore(spark, str(root))
    for k in range(9):
        store.add(observed.where(f"frame_id % 9 = {k}"), k)
        store.add(observed.where(f"frame_id % 9 = {k}"), k)  # the batch again
        assert len(store.manifest()["parts"]) <= 3
    assert len(parts(root)) <= 3 + stats.KEPT_VERSIONS and len([p for p in root.iterdir() if p.name.startswith("version-")]) == stats.KEPT_VERSIONS
    assert store.summary().first() == whole(observed)
    store.update(observed)  # rows that were added have no fingerprint
    assert store.summary().first() == whole(observed) and json.loads((root / f"version-{store.manifest()['version']:09}").read_text())["batch"] == 8


def test_stream_over_record_shards(spark, observed, tmp_path):
    rows = observed.groupBy("frame_id", "shard_id").agg(F.collect_list(F.when(F.col("seen"), F.struct("cls", "dist", "side"))).alias("o"))
    frames = rows.select(
        F.col("frame_id").cast("int").alias("frame_index"), F.col("o.cls").alias("obj_classes"),
        F.transform("o", lambda x: F.array(x["dist"].cast("float"), x["side"].cast("float"), F.lit(0).cast("float"))).alias("obj_pos"), F.array(F.col("shard_id").cast("float")).alias("cam_location"),
    )

    def observe(df):
        each = df.withColumn("frame_id", F.concat_ws("/", "shard", "position")).select("frame_id", F.col("cam_location")[0].cast("long").alias("shard_id"), F.explode_outer(F.arrays_zip("obj_classes", "obj_pos")).alias("o"))
        return each.select("frame_id", "shard_id", F.col("o.obj_classes").isNotNull().alias("seen"), F.col("o.obj_classes").alias("cls"), F.col("o.obj_pos")[0].cast("double").alias("dist"), F.col("o.obj_pos")[1].cast("double").alias("side"))

    keys = ["obj_classes", "obj_pos", "cam_location"]
    for part in ("shard_id < 5", "shard_id >= 5"):  # the stream is started anew for each
        write_records(frames.where(F.col("cam_location")[0] < 5) if part == "shard_id < 5" else frames.where(F.col("cam_location")[0] >= 5), str(tmp_path / "in"), 50)
        follow_records(spark, str(tmp_path / "in"), keys, str(tmp_path / "stats"), str(tmp_path / "check"), observe).awaitTermination()
    follow_records(spark, str(tmp_path / "in"), keys, str(tmp_path / "stats"), str(tmp_path / "check"), observe).awaitTermination()
    got, want = summary(spark, str(tmp_path / "stats")).first().asDict(), whole(observed).asDict()
    assert all(abs(got[k] - want[k]) < 1e-5 for k in want)
