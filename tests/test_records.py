"""Record files: tensors, framing, both layouts, written shards, and streams of them."""

import json
import struct
import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from posetables.operators.windows import shard_plan
from posetables.sources import records as r, tensors as t


def slow_crc(data: bytes) -> int:
    c = 0xFFFFFFFF
    for b in data:
        c ^= b
        for _ in range(8):
            c = c >> 1 ^ (0x82F63B78 if c & 1 else 0)
    return c ^ 0xFFFFFFFF


def test_checksum():
    assert t.crc32c(b"123456789") == 0xE3069283 and t.crc32c(b"") == 0
    rng = np.random.default_rng(1)
    for n in (1, 63, 1023, 1024, 1025, 5000, 65_536, 70_001):
        data = rng.integers(0, 256, n).astype(np.uint8).tobytes()
        assert t.crc32c(data) == slow_crc(data), n


@pytest.mark.parametrize("values", [np.float32([[1, 2, 3], [4, 5, 6]]), np.zeros((0, 4), np.int32), np.uint8([[[1, 2, 3]], [[4, 5, 6]]]), np.float32(0.25), np.int32([-1, 7]), np.zeros(0, np.float32)])
def test_tensor_keeps_shape_and_type(values):
    back = t.decode_tensor(memoryview(t.encode_tensor(np.asarray(values))))
    assert back.shape == values.shape and back.dtype == values.dtype and (back == values).all()


def test_tensor_wire_format():
    assert t.encode_tensor(np.int32([[5], [6]])) == b"\x08\x03\x12\x08\x12\x02\x08\x02\x12\x02\x08\x01\x22\x08\x05\0\0\0\x06\0\0\0"
    assert t.encode_tensor(["a", "ü"]) == b"\x08\x07\x12\x04\x12\x02\x08\x02\x42\x01a\x42\x02\xc3\xbc"
    listed = b"\x08\x01\x12\x04\x12\x02\x08\x03\x2a\x08" + struct.pack("<2f", 1.5, 2)  # two values for three places: the last one stays
    assert t.decode_tensor(memoryview(listed)).tolist() == [1.5, 2, 2]
    assert t.decode_tensor(memoryview(b"\x08\x03\x12\x04\x12\x02\x08\x02\x38\x05\x38" + b"\xff" * 9 + b"\x01")).tolist() == [5, -1]
    with pytest.raises(ValueError, match="type 2"):
        t.decode_tensor(memoryview(b"\x08\x02"))
    with pytest.raises(ValueError, match="another type"):
        t.from_tensor("obj_ids", np.float32([1]))


def test_nulls_inside_values():
    assert t.to_tensor("obj_classes", ["a", None]) == ["a", ""]
    assert t.to_tensor("obj_ids", [1, None]).tolist() == [1, 0] and t.to_tensor("obj_ids", []).shape == (0,)
    assert t.to_tensor("obj_bbox_obj", [[1, 2, 3, None], None]).tolist() == [[1, 2, 3, 0], [0, 0, 0, 0]]
    assert np.isnan(t.to_tensor("obj_pos", [None, [1.0, None, 2.0]])).tolist() == [[True] * 3, [False, True, False]]
    assert t.to_tensor("cam_matrix", list(range(9))).shape == (3, 3) and t.to_tensor("obj_pos", []).shape == (0, 3)


def test_damaged_shards_are_errors():
    whole = b"".join(t.frame_record(x) for x in (b"one", b"two" * 50, b"", b"z" * 3_000_000))
    pieces = lambda data, n=7001: (data[a : a + n] for a in range(0, len(data), n))
    packed = zlib.compress(whole)
    assert list(t.records(pieces(packed), "s")) == [b"one", b"two" * 50, b"", b"z" * 3_000_000]
    for bad in (zlib.compress(whole[:-5]), packed[:-6], zlib.compress(whole.replace(b"one", b"ane")), zlib.compress(b"\1" + whole[1:]), b""):
        with pytest.raises((ValueError, zlib.error)):
            list(t.records(pieces(bad), "s"))


def image(a: np.ndarray) -> dict:
    h, w, c = (*a.shape, 1)[:3]
    return {"height": h, "width": w, "channels": c, "dtype": a.dtype.name, "data": a.tobytes()}


def frame(i: int, objects: int = 2) -> dict:
    rng = np.random.default_rng(i)
    table = lambda n, kind: rng.integers(0, 50, (objects, n)).astype(kind).tolist()
    return {
        "rgb": image(rng.integers(0, 255, (4, 6, 3)).astype(np.uint8)), "rgb_R": image(np.zeros((4, 6, 3), np.uint8)), "depth": image(rng.random((4, 6)).astype(np.float32)), "depth_R": image(np.ones((4, 6), np.float32)),
        "depth_gt": image(np.ones((2, 3), np.float32)), "depth_gt_R": image(np.ones((2, 3), np.float32)), "mask": image(rng.integers(0, 9, (4, 6)).astype(np.int32)),
        "cam_matrix": [[500.0, 0.0, 3.0], [0.0, 500.0, 2.0], [0.0, 0.0, 1.0]], "cam_location": [0.5, float(i), 2.0], "cam_rotation": [0.0, 0.0, 0.0, 1.0], "stereo_baseline": 0.0625,
        "obj_classes": [f"c{k}ü" for k in range(objects)], "obj_ids": list(range(1, objects + 1)), "obj_pos": table(3, np.float32), "obj_rot": table(4, np.float32),
        "obj_bbox_visib": table(4, np.int32), "obj_visib_fract": [0.5] * objects, "obj_px_count_visib": [3] * objects, "obj_px_count_valid": [2] * objects, "obj_px_count_all": [6] * objects, "obj_bbox_obj": table(4, np.int32),
    }


def plain(row) -> dict:
    return {k: v.asDict() if hasattr(v, "asDict") else v for k, v in row.asDict().items()} if row is not None else None


def shard(path: Path, rows: list[dict], keys=None) -> None:
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(zlib.compress(b"".join(t.frame_record(t.encode_example({k: v for k, v in x.items() if keys is None or k in keys})) for x in rows)))


def clean(row) -> dict:
    return {k: (v | {"data": bytes(v["data"])} if isinstance(v, dict) else v) for k, v in plain(row).items() if k not in ("subset", "shard", "position")}


def test_all_keys_round_trip_with_shapes(spark, tmp_path):
    frames = [frame(i, objects=i % 3) for i in range(7)]
    schema = "frame_index int, " + ", ".join(f"{k} {t.spark_type(k)}" for k in t.KEYS)
    df = spark.createDataFrame([{"frame_index": i, **f} for i, f in enumerate(frames)], schema)
    r.write_records(df, str(tmp_path), 3)
    assert json.loads((tmp_path / "metadata.json").read_text()) == {"version": 2.0}
    stored = {}
    for path in (tmp_path / "data").glob("*.tfrecord"):
        for k, data in enumerate(t.records(r.pieces_of(str(path)), "s")):
            shapes = {}
            for key, feature in t._features(data):
                tensor = t.decode_tensor(dict(t._fields(dict(t._fields(feature))[1]))[1])
                shapes[key] = (len(tensor),) if isinstance(tensor, list) else tensor.shape
            stored[int(path.stem[:6]) + k] = shapes
    for i, shapes in stored.items():
        n = i % 3
        assert shapes["rgb"] == (4, 6, 3) and shapes["depth"] == (4, 6) and shapes["mask"] == (4, 6) and shapes["depth_gt"] == (2, 3)
        assert shapes["cam_matrix"] == (3, 3) and shapes["cam_location"] == (3,) and shapes["stereo_baseline"] == ()
        assert shapes["obj_pos"] == (n, 3) and shapes["obj_rot"] == (n, 4) and shapes["obj_bbox_visib"] == (n, 4) and shapes["obj_classes"] == (n,)
    assert len(stored) == 7
    back = r.read_records(spark, str(tmp_path))
    assert back.columns == ["subset", "shard", "position", *t.KEYS]
    assert {int(x.shard[:6]) + x.position: clean(x) for x in back.collect()} == dict(enumerate(frames))
    few = r.read_records(spark, str(tmp_path), ["obj_pos", "nonsense"])
    assert few.columns == ["subset", "shard", "position", "obj_pos"]
    stored = r.read_records_from_store(spark, f"file://{tmp_path}", ["mask", "obj_pos"]).collect()
    assert {int(x.shard[:6]) + x.position: clean(x) for x in stored} == {i: {k: f[k] for k in ("mask", "obj_pos")} for i, f in enumerate(frames)}


def test_subsets_patterns_and_pruned_shards(spark, tmp_path):
    for s in ("a", "b"):
        for k in (0, 2):
            shard(tmp_path / f"subsets/{s}/data/{k:06}_{k + 1:06}.tfrecord", [frame(k), frame(k + 1)], ["obj_ids"] + ["cam_location"] * (s == "b"))
    rows = r.read_records(spark, str(tmp_path))
    assert rows.columns == ["subset", "shard", "position", "cam_location", "obj_ids"] and rows.count() == 8
    assert rows.where("cam_location IS NULL").count() == 4
    assert r.read_records(spark, str(tmp_path), pattern="subsets/b/data/*.tfrecord").count() == 4
    assert rows.where("subset = 'subsets/b'").count() == 4 and rows.count() == 8
    (tmp_path / "subsets/a/data/000002_000003.tfrecord").write_bytes(b"no shard")
    assert r.read_records(spark, str(tmp_path), subsets="subsets/b").count() == 4  # shards that are left out aren't opened
    assert r.read_records(spark, str(tmp_path), subsets="subsets/*", shards="000000_*,000001_*").count() == 4
    with pytest.raises(Exception, match="header|incorrect"):
        rows.count()
    assert {x.subset for x in r.read_records_from_store(spark, f"file://{tmp_path}/subsets/b", ["obj_ids"]).collect()} == {""}
    good = r.read_records_from_store(spark, f"file://{tmp_path}", ["obj_ids"], pattern="000000_*.tfrecord")
    assert {x.subset for x in good.collect()} == {"subsets/a", "subsets/b"}


def test_strict_keys(spark, tmp_path):
    shard(tmp_path / "data/000000_000001.tfrecord", [frame(0), {k: v for k, v in frame(1).items() if k != "mask"}])
    assert [x.mask is None for x in r.read_records(spark, str(tmp_path), ["mask"]).orderBy("position").collect()] == [False, True]
    with pytest.raises(Exception, match="record 1 has no mask"):
        r.read_records(spark, str(tmp_path), ["mask", "obj_ids"], safe=False).collect()
    with pytest.raises(Exception, match="unknown keys: nonsense"):
        r.read_records(spark, str(tmp_path), ["nonsense"], safe=False).collect()
    assert r.read_records(spark, str(tmp_path), ["obj_ids"], safe=False).count() == 2
    (tmp_path / "metadata.json").write_text('{"version": 3.0}')
    with pytest.raises(Exception, match="version 3"):
        r.read_records(spark, str(tmp_path)).collect()


def test_empty_folder(spark, tmp_path):
    assert r.read_records(spark, str(tmp_path)).count() == 0


def test_families_are_zipped(spark, tmp_path):
    (tmp_path / "metadata.json").write_text('{"version": 1.0}')
    frames = [frame(i) | {"mask": image(np.full((4, 6), i, np.uint8))} for i in range(5)]
    for family, keys in r.FAMILIES.items():
        shard(tmp_path / family / "000000_000002.tfrecord", frames[:3], keys)
        shard(tmp_path / family / "000003_000004.tfrecord", frames[3:] if family != "depth" else frames[3:4], keys)  # depth ends early
    small = lambda i: t._field(1, t._field(1, t._field(1, b"mask") + t._field(2, t._field(1, t._field(1, t.encode_tensor(np.full((4, 6), i, np.uint8)))))))
    for name, own in (("000000_000002", range(3)), ("000003_000004", range(3, 5))):  # masks of this version are bytes
        (tmp_path / f"mask/{name}.tfrecord").write_bytes(zlib.compress(b"".join(t.frame_record(small(i)) for i in own)))
    rows = r.read_records(spark, str(tmp_path), ["rgb", "depth", "mask", "obj_pos", "stereo_baseline"])
    got = {int(x.shard[:6]) + x.position: clean(x) for x in rows.collect()}
    assert got == {i: {k: frames[i][k] for k in rows.columns[3:]} for i in range(4)}
    assert r.read_records(spark, str(tmp_path), ["obj_ids"]).count() == 5  # only its family is opened
    (tmp_path / "depth/000003_000004.tfrecord").unlink()
    with pytest.raises(Exception, match="different shards"):
        r.read_records(spark, str(tmp_path), ["rgb", "depth"]).collect()
    assert r.read_records(spark, str(tmp_path), ["rgb"]).count() == 5


def indexed(spark, n, **more):
    df = spark.range(n).selectExpr("cast(id * 3 as int) as frame_index", "array(cast(id as int)) as obj_ids")
    return df.withColumns({k: F.lit(v) for k, v in more.items()})


def test_shard_names_are_those_of_the_plan(spark, tmp_path):
    df = indexed(spark, 103)
    plan = sorted(f"{x.start:06}_{x.end:06}.tfrecord" for x in shard_plan(df, "frame_index", 20).collect())
    try:
        for n in (1, 3, 8):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            r.write_records(df.repartition(5), f"{tmp_path}/{n}", 20)
            assert sorted(x.name for x in Path(f"{tmp_path}/{n}/data").iterdir()) == plan
            assert [x.obj_ids[0] for x in r.read_records(spark, f"{tmp_path}/{n}").orderBy("shard", "position").collect()] == list(range(103))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)


def test_rewritten_and_failed_shards(spark, tmp_path):
    df = indexed(spark, 40)
    r.write_records(df, str(tmp_path), 10)
    names = sorted(x.name for x in (tmp_path / "data").iterdir())
    first = df.where("frame_index <= 27")
    r.write_records(first.withColumn("obj_ids", F.array(F.lit(7))), str(tmp_path), 10)  # one range of four
    assert sorted(x.name for x in (tmp_path / "data").iterdir()) == names
    assert r.read_records(spark, str(tmp_path)).groupBy("obj_ids").count().where("obj_ids[0] = 7 AND count = 10").count() == 1
    before = {x.name: x.read_bytes() for x in (tmp_path / "data").iterdir()}
    broken = df.withColumn("obj_ids", F.when(F.col("frame_index") == 90, F.array(F.raise_error("no such frame").cast("int"))).otherwise(F.array(F.lit(8))))
    with pytest.raises(Exception, match="no such frame"):
        r.write_records(broken, str(tmp_path), 10)
    assert {x.name: x.read_bytes() for x in (tmp_path / "data").iterdir()} == before
    r.write_records(first, str(tmp_path), 5, mode="overwrite")
    assert sorted(x.name for x in (tmp_path / "data").iterdir()) == ["000000_000012.tfrecord", "000015_000027.tfrecord"]
    with pytest.raises(Exception, match="one shard"):
        indexed(spark, 8, shard_start=0, shard_end=99).repartition(3).write.format("pose_records").mode("append").save(str(tmp_path))
    assert len(list((tmp_path / "data").iterdir())) == 2


def test_stream_of_shards(spark, tmp_path):
    r.write_records(indexed(spark, 20), str(tmp_path / "in"), 10)

    def follow():
        stream = spark.readStream.format("pose_records").option("keys", "obj_ids").load(str(tmp_path / "in"))
        q = stream.selectExpr("shard", "position", "obj_ids[0] as id").writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start()
        q.awaitTermination()
        return sorted(x.id for x in spark.read.parquet(str(tmp_path / "out")).collect())

    assert follow() == list(range(20))
    more = spark.range(20, 33).selectExpr("cast(id * 3 as int) as frame_index", "array(cast(id as int)) as obj_ids")
    r.write_records(more, str(tmp_path / "in"), 5)
    assert follow() == list(range(33))
    assert follow() == list(range(33))


def test_many_records_at_once_are_as_one_by_one():
    rng = np.random.default_rng(3)
    parts = [rng.integers(0, 256, n).astype(np.uint8).tobytes() for n in (0, 1, 3, 4, 5, 63, 64, 65, 700, 5000, 70_000)]
    assert t.frame_records(parts) == [t.frame_record(p) for p in parts]
    rows = [{k: v for k, v in frame(i, i % 3).items() if t.KEYS[k][0] != "image" and k != "stereo_baseline"} for i in range(40)]
    rows[5]["obj_classes"], rows[6]["obj_pos"], rows[7]["obj_ids"], rows[8]["obj_classes"] = None, None, [1, None], ["a", "long"]
    rows[9]["obj_pos"] = [[1.0, None, 2.0], None]
    keys = list(rows[0])
    batch = pa.RecordBatch.from_pylist(rows, pa.schema([(k, t.arrow_type(k)) for k in keys]))
    data = [t.encode_example(x) for x in rows]
    assert t.encode_examples(dict(zip(keys, batch.columns))) == data and t.encode_examples(dict(zip(keys, batch.slice(4, 9).columns))) == data[4:13]
    data += [t.encode_example(frame(50)), t.encode_example({})]
    for wanted in (keys, ["obj_pos", "rgb", "obj_classes", "stereo_baseline"], []):
        columns = t.decode_examples(data, wanted)
        for i, d in enumerate(data):
            assert repr({k: c[i].as_py() for k, c in zip(wanted, columns)}) == repr({k: t.decode_example(d, wanted).get(k) for k in wanted})


def test_a_task_reads_many_small_shards(spark, tmp_path):
    for i in range(150):
        shard(tmp_path / f"data/{i:06}_{i:06}.tfrecord", [frame(i, 1)], ["obj_ids", "cam_location"])
    back = r.read_records(spark, str(tmp_path), ["obj_ids", "cam_location"])
    assert back.rdd.getNumPartitions() < 10
    assert sorted(x.cam_location[1] for x in back.collect()) == [float(i) for i in range(150)]
    assert sum(len(x.of) for x in r.dealt_out(r.find_shards(str(tmp_path), r.PATTERN, ["obj_ids"]))) == 150
