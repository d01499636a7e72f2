import json
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from posetables.operators.aggregates import merge_partials, observations, shard_partials
from posetables.fixtures import read
from posetables.sources import files, images, sinks
from posetables.streaming.shard_stats import follow_shards, summary

SF = "/root/testdata/sf0.001"


def png(a: np.ndarray) -> bytes:
    h, w = a.shape[:2]
    colour = 2 if a.ndim == 3 else 0
    raw = b"".join(b"\0" + a[y].astype(">u2" if a.dtype == np.uint16 else np.uint8).tobytes() for y in range(h))
    chunk = lambda k, d: struct.pack(">I", len(d)) + k + d + struct.pack(">I", zlib.crc32(k + d))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 16 if a.dtype == np.uint16 else 8, colour, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")


@pytest.fixture
def scene(tmp_path):
    d = tmp_path / "000001"
    (d / "rgb").mkdir(parents=True)
    (d / "depth").mkdir()
    for i in (0, 1):
        (d / f"rgb/{i:06}.png").write_bytes(png(np.full((4, 6, 3), i, np.uint8)))
    depth = np.zeros((4, 6), np.uint16)
    depth[1, 2:4] = 1000
    (d / "depth/000000.png").write_bytes(png(depth))
    (d / "scene_camera.json").write_text(json.dumps({str(i): {"cam_K": [500, 0, 3, 0, 500, 2, 0, 0, 1], "depth_scale": 0.1} for i in (0, 1)}))
    gt = {"cam_R_m2c": [1, 0, 0, 0, 1, 0, 0, 0, 1], "cam_t_m2c": [10, 20, 1000], "obj_id": 5}
    (d / "scene_gt.json").write_text(json.dumps({"0": [gt, gt], "7": [gt]}))  # image 7 is missing, image 1 has no objects
    return str(tmp_path)


def test_scene(spark, scene):
    classes = spark.createDataFrame([(5, "can")], "class_id int, class_name string")
    rows = files.convert_scenes(spark, scene, classes).orderBy("img_index", "instance_index").collect()
    assert [(r.img_index, r.obj_id, r.class_name) for r in rows] == [(0, 1, "can"), (0, 2, "can"), (1, None, None)]
    assert rows[0].position == [0.01, 0.02, 1.0] and rows[0].depth_scale == 0.1
    unknown = spark.createDataFrame([(6, "cup")], "class_id int, class_name string")
    with pytest.raises(Exception):
        files.convert_scenes(spark, scene, unknown).collect()


def test_convert_dataset(spark, tmp_path):
    d = tmp_path / "data/test/000002"
    for k in ("rgb", "depth", "mask", "mask_visib"):
        (d / k).mkdir(parents=True)
    depth, whole, seen = np.full((4, 6), 2000, np.uint16), np.zeros((4, 6), np.uint8), np.zeros((4, 6), np.uint8)
    depth[1, 2] = 0
    whole[1:3, 1:5], seen[1, 2:4] = 255, 255
    for i in (3, 8):  # become frames 0 and 1
        (d / f"rgb/{i:06}.png").write_bytes(png(np.full((4, 6, 3), i, np.uint8)))
        (d / f"depth/{i:06}.png").write_bytes(png(depth))
    for k, m in (("mask", whole), ("mask_visib", seen)):
        (d / f"{k}/000008_000000.png").write_bytes(png(m))
        (d / f"{k}/000008_000001.png").write_bytes(png(np.zeros((4, 6), np.uint8)))
    (d / "scene_camera.json").write_text(json.dumps({str(i): {"cam_K": [500, 0, 3, 0, 500, 2, 0, 0, 1], "depth_scale": 0.1} for i in (3, 8)}))
    gt = {"cam_R_m2c": [1, 0, 0, 0, 1, 0, 0, 0, 1], "cam_t_m2c": [10, 20, 1000], "obj_id": 5}
    (d / "scene_gt.json").write_text(json.dumps({"3": [], "8": [gt, gt]}))
    classes = spark.createDataFrame([(5, "can")], "class_id int, class_name string")
    files.convert_dataset(spark, f"{tmp_path}/data", "lm", classes, f"{tmp_path}/out")
    a, b = spark.read.parquet(f"{tmp_path}/out").orderBy("frame_index").collect()
    assert (a.frame_index, a.img_index, a.objs, b.frame_index, b.img_index) == (0, 3, [], 1, 8)
    assert b.rgb == bytes([8]) * 72 and (tmp_path / "out/subset=000002").is_dir()
    assert np.allclose(np.frombuffer(b.depth, np.float32).reshape(4, 6), depth * 0.0001)
    assert (np.frombuffer(b.mask, np.int32).reshape(4, 6) == (seen > 0)).all()
    x, y = b.objs
    assert (x["class"], x["object id"], x.pos, x.rotation) == ("can", 1, [0.01, 0.02, 1.0], [0, 0, 0, 1])
    assert (x.bbox_visib, x.bbox_obj, x.px_count_visib, x.px_count_valid, x.px_count_all, x.visib_fract) == ([2, 1, 3, 1], [1, 1, 4, 2], 2, 1, 8, 0.25)
    assert (y["object id"], y.bbox_obj, y.px_count_all, y.visib_fract) == (2, [0, 0, 0, 0], 0, 0.0)
    files.convert_dataset(spark, f"{tmp_path}/data", "lm", None, f"{tmp_path}/own")  # the dataset's own classes
    assert spark.read.parquet(f"{tmp_path}/own").where("img_index = 8").first().objs == b.objs
    (d / "mask_visib/000008_000001.png").unlink()
    with pytest.raises(Exception, match="no partner"):
        files.convert_dataset(spark, f"{tmp_path}/data", "lm", classes, f"{tmp_path}/out2")


def test_dataset_classes(spark):
    assert {k: len(v) for k, v in files.CLASSES.items()} == {"lm": 15, "lmo": 15, "tless": 30, "hb": 33, "ycbv": 21, "hope": 28}
    assert set(files.CLASSES) == set(files.IMAGE_FOLDERS)
    of = lambda name: dict(map(tuple, files.dataset_classes(spark, name).collect()))
    assert (of("ycbv")[12], of("hb")[33], of("hope")[20]) == ("021_bleach_cleanser", "obj_33", "Peas&Carrots")
    with pytest.raises(KeyError):
        files.dataset_classes(spark, "other")


def test_images(spark, scene):
    table = images.image_table(spark, scene)
    depth = table.where("dtype = 'uint16'")
    assert [tuple(r)[1:] for r in images.mask_labels(depth).collect()] == [(2, 1, 3, 1, 2)]
    scaled = images.depth_metres(depth, depth.selectExpr("path", "0.1D AS depth_scale")).first()
    assert np.isclose(np.frombuffer(scaled.data, np.float32).max(), 0.1)
    assert table.where("channels = 3").count() == 2


def filtered_png(a: np.ndarray, kinds: list[int]) -> bytes:
    """A PNG of an 8- or 16-bit picture whose rows are filtered as told, by plain loops."""
    h, w = a.shape[:2]
    rows = (a.astype(">u2").view(np.uint8) if a.dtype == np.uint16 else a).reshape(h, -1).astype(int)
    n = rows.shape[1] // w
    raw = b""
    for y, kind in enumerate(kinds):
        line = []
        for i in range(rows.shape[1]):
            left, up, corner = (rows[y, i - n] if i >= n else 0), (rows[y - 1, i] if y else 0), (rows[y - 1, i - n] if y and i >= n else 0)
            paeth = min((abs(up - corner), 0, left), (abs(left - corner), 1, up), (abs(left + up - 2 * corner), 2, corner))[2]
            line.append((rows[y, i] - [0, left, up, (left + up) // 2, paeth][kind]) & 255)
        raw += bytes([kind, *line])
    chunk = lambda k, d: struct.pack(">I", len(d)) + k + d + struct.pack(">I", zlib.crc32(k + d))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 16 if a.dtype == np.uint16 else 8, 2 if a.ndim == 3 else 0, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")


@pytest.mark.parametrize("shape,kind", [((9, 7, 3), np.uint8), ((7, 12), np.uint16), ((1, 5), np.uint8), ((6, 1, 3), np.uint8), ((1, 1), np.uint16), ((20, 31), np.uint8)])
def test_png_filters(shape, kind):
    rng = np.random.default_rng(sum(shape))
    a = rng.integers(0, np.iinfo(kind).max + 1, shape).astype(kind)
    for kinds in (*([k] * shape[0] for k in range(5)), rng.integers(0, 5, shape[0]).tolist(), rng.integers(0, 3, shape[0]).tolist()):
        got = images.decode_png(filtered_png(a, kinds))
        assert got.dtype == kind and (got.reshape(shape) == a).all(), kinds


def test_broken_images_are_rows(spark, tmp_path):
    (tmp_path / "rgb").mkdir()
    good = png(np.full((4, 6, 3), 9, np.uint8))
    bad = {"rgb_0001.png": b"no image", "rgb_0002.png": good[:-30], "rgb_0003.png": good[:8], "rgb_0004.png": b"\x89", "rgb_0005.png": good.replace(b"IDAT", b"IDAX")}
    for name, data in {"rgb_0000.png": good, "rgb_0000_R.png": png(np.full((4, 6, 3), 7, np.uint8)), **bad}.items():
        (tmp_path / "rgb" / name).write_bytes(data)
    rows = {r.path.rsplit("/", 1)[1]: r for r in images.image_table(spark, str(tmp_path), permissive=True).collect()}
    assert {k for k, r in rows.items() if r.corrupt} == set(bad) == {k for k, r in rows.items() if r.data is None} and rows["rgb_0000.png"].height == 4
    with pytest.raises(Exception, match="rgb_000"):
        images.image_table(spark, str(tmp_path)).collect()
    frames = {r.frame_index: r for r in files.pose_pixels(spark, str(tmp_path / "rgb")).collect()}
    assert sorted(frames) == list(range(6)) and frames[0].rgb.data == bytes([9]) * 72 and frames[0].rgb_R.data == bytes([7]) * 72 and frames[3].rgb is None and frames[3].rgb_R is None


def test_pose_json_and_assets(spark, tmp_path):
    (tmp_path / "gt").mkdir()
    (tmp_path / "rgb").mkdir()
    obj = {"class": "can", "object id": 3, "pos": [0, 0, 1], "rotation": [0, 0, 0, 1], "bbox_visib": [1, 2, 3, 4]}
    (tmp_path / "gt/gt_00012.json").write_text(json.dumps({"cam_location": [0, 0, 0], "objs": [obj]}, indent=1))
    (tmp_path / "rgb/rgb_0012.png").write_bytes(b"x")
    (tmp_path / "rgb/rgb_0012_R.png").write_bytes(b"x")
    both = files.pose_json(spark, str(tmp_path / "gt")).join(files.pose_images(spark, str(tmp_path / "rgb")), "frame_index").first()
    assert both.frame_index == 12 and both.objs[0]["object id"] == 3 and both.path_R.endswith("_R.png")
    for n in ("a.obj", "a_vhacd.obj", "a_collision.obj", "b.txt"):
        (tmp_path / n).write_text("x")
    assert [r.name for r in files.asset_catalog(spark, str(tmp_path)).collect()] == ["a"]
    (tmp_path / "objects.json").write_text('{"cup": "m/cup.obj"}')
    assert files.asset_manifest(spark, f"{tmp_path}/objects.json").first().path == f"{tmp_path}/m/cup.obj"


def test_shards_and_stream(spark, tmp_path):
    frames = read(spark, SF, "fx_frames")
    sinks.write_shards(frames, f"{tmp_path}/frames")
    assert spark.read.parquet(f"{tmp_path}/frames").count() == frames.count()
    one = frames.where("shard_id = 7").withColumn("fx", F.lit(1.0))
    sinks.write_shards(one, f"{tmp_path}/frames")  # replaces that shard alone
    again = spark.read.parquet(f"{tmp_path}/frames")
    assert again.count() == frames.count() and again.where("fx = 1").count() == one.count() == again.where("shard_id = 7").count()
    observed = observations(frames, read(spark, SF, "fx_annotations"))
    whole = merge_partials(shard_partials(observed)).first()
    for part in ("shard_id < 5", "shard_id >= 5 and frame_id % 2 = 0", "shard_id >= 5 and frame_id % 2 = 1"):  # shards land in three goes, some of them in two
        observed.where(part).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        follow_shards(spark, f"{tmp_path}/in", observed.schema, f"{tmp_path}/stats", f"{tmp_path}/check").awaitTermination()
    assert summary(spark, f"{tmp_path}/stats").first() == whole
