"""Readers of scene folders, per-frame JSON, and asset catalogs, as DataFrames over Spark's own file sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .images import image_table

CAMERA = "map<string,struct<cam_K:array<double>,depth_scale:double>>"
GROUND_TRUTH = "map<string,array<struct<cam_R_m2c:array<double>,cam_t_m2c:array<double>,obj_id:int>>>"
POSE = """cam_matrix array<array<double>>, cam_location array<double>, cam_rotation array<double>, stereo_baseline double,
 objs array<struct<class: string, `object id`: int, pos: array<double>, rotation: array<double>, bbox_visib: array<int>, bbox_obj: array<int>, visib_fract: double, px_count_visib: int, px_count_valid: int, px_count_all: int>>"""
#: Image folder of each scene dataset. Fixed values.
IMAGE_FOLDERS = {"lm": "test", "lmo": "test", "tless": "test_primesense", "hb": "val_primesense", "ycbv": "test", "hope": "val"}
#: Classes of each scene dataset, numbered from 1 in this order. Fixed values; tless and hb name theirs by number.
_LM = "ape benchvise bowl cam can cat cup driller duck eggbox glue holepuncher iron lamp phone"
_YCBV = (
    "002_master_chef_can 003_cracker_box 004_sugar_box 005_tomato_soup_can 006_mustard_bottle 007_tuna_fish_can 008_pudding_box 009_gelatin_box "
    "010_potted_meat_can 011_banana 019_pitcher_base 021_bleach_cleanser 024_bowl 025_mug 035_power_drill 036_wood_block 037_scissors "
    "040_large_marker 051_large_clamp 052_extra_large_clamp 061_foam_brick"
)
_HOPE = (
    "AlphabetSoup BBQSauce Butter Cherries ChocolatePudding Cookies Corn CreamCheese GranolaBars GreenBeans Ketchup Macaroni&Cheese Mayo Milk "
    "Mushrooms Mustard OrangeJuice Parmesan Peaches Peas&Carrots Pineapple Popcorn Raisins SaladDressing Spaghetti TomatoSauce Tuna Yogurt"
)
CLASSES = {"lm": _LM.split(), "lmo": _LM.split(), "tless": [f"obj_{i:02d}" for i in range(1, 31)], "hb": [f"obj_{i:02d}" for i in range(1, 34)], "ycbv": _YCBV.split(), "hope": _HOPE.split()}
ASSET_PATTERNS = {"YCB": "textured.obj", "SYNTHDET": "*.fbx", "OMNI3D": "simplified.obj", "ANY": "*.{obj,ply,gltf,fbx}"}
_SUBSET = r"([^/]+)/[^/]+$"


def _documents(spark: SparkSession, root: str, name: str, kind: str) -> DataFrame:
    """subset, m (the parsed map) of each file of a name below root."""
    raw = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", name).text(root, wholetext=True)
    return raw.select(F.regexp_extract(F.col("_metadata.file_path"), _SUBSET, 1).alias("subset"), F.from_json("value", kind).alias("m"))


def scene_cameras(spark: SparkSession, root: str) -> DataFrame:
    """subset, img_index, cam_matrix (nine numbers), depth_scale."""
    rows = _documents(spark, root, "scene_camera.json", CAMERA).select("subset", F.explode("m").alias("k", "v"))
    return rows.select("subset", F.col("k").cast("int").alias("img_index"), F.col("v.cam_K").cast("array<float>").alias("cam_matrix"), F.col("v.depth_scale").alias("depth_scale"))


def scene_annotations(spark: SparkSession, root: str) -> DataFrame:
    """subset, img_index, instance_index, obj_id (place + 1), class_id, rotation (nine numbers), position in metres."""
    images = _documents(spark, root, "scene_gt.json", GROUND_TRUTH).select("subset", F.explode("m").alias("k", "v"))
    rows = images.select("subset", F.col("k").cast("int").alias("img_index"), F.posexplode("v").alias("instance_index", "o"))
    return rows.select("subset", "img_index", "instance_index", (F.col("instance_index") + 1).alias("obj_id"), F.col("o.obj_id").alias("class_id"), F.col("o.cam_R_m2c").alias("rotation"), F.transform("o.cam_t_m2c", lambda v: v / 1000).alias("position"))


def frame_listing(spark: SparkSession, root: str, folder: str = "rgb") -> DataFrame:
    """subset, img_index of every image; only the names are read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.png").load(root).select("path")
    part = lambda k: F.regexp_extract("path", rf"([^/]+)/{folder}/(\d+)\.png$", k)
    return files.where(part(2) != "").select(part(1).alias("subset"), part(2).cast("int").alias("img_index"))


def convert_scenes(spark: SparkSession, root: str, classes: DataFrame) -> DataFrame:
    """Frames of all scenes with their annotations; frames come from the images, and a frame without camera or an unknown class is an error."""
    from ..operators.joins import require_match

    frames = require_match(frame_listing(spark, root), scene_cameras(spark, root), ["subset", "img_index"])
    found = require_match(scene_annotations(spark, root), classes.select("class_id", "class_name"), ["class_id"])
    return frames.join(found, ["subset", "img_index"], "left")


def image_files(spark: SparkSession, root: str) -> DataFrame:
    """subset, img_index, kind (rgb, depth, mask, mask_visib), instance_index (-1 for rgb and depth), path, content of every image."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.png").load(root).select("path", "content")
    part = lambda k: F.regexp_extract("path", r"([^/]+)/(rgb|depth|mask|mask_visib)/(\d+)(?:_(\d+))?\.png$", k)
    instance = F.when(part(4) != "", part(4).cast("int")).otherwise(F.lit(-1))
    return files.where(part(3) != "").select(part(1).alias("subset"), part(3).cast("int").alias("img_index"), part(2).alias("kind"), instance.alias("instance_index"), "path", "content")


def join_frame_images(frames: DataFrame, annotations: DataFrame, images: DataFrame) -> DataFrame:
    """images of each frame (rgb, depth) and of each instance (mask, mask_visib) of frames; a missing one is an error."""
    from ..operators.joins import require_match

    kinds = lambda *names: F.explode(F.array(*map(F.lit, names))).alias("kind")
    ids = frames.select("subset", "img_index").distinct()
    own = ids.select("subset", "img_index", kinds("rgb", "depth"), F.lit(-1).alias("instance_index"))
    masks = annotations.join(ids, ["subset", "img_index"], "left_semi").select("subset", "img_index", kinds("mask", "mask_visib"), "instance_index")
    return require_match(own.unionByName(masks), images, ["subset", "img_index", "kind", "instance_index"])


_BOX = "array<int>"
_LABELS = f"array<struct<bbox_visib: {_BOX}, bbox_obj: {_BOX}, px_count_visib: long, px_count_valid: long, px_count_all: long, visib_fract: double>>"
_PIXELS = f"subset string, img_index int, height int, width int, rgb binary, depth binary, mask binary, labels {_LABELS}"


def _frame_pixels(group):
    """One frame's images: rgb, depth in float32 metres, instances as int32 (0 is background), and the labels of its masks in order."""
    import numpy as np
    import pandas as pd

    from .images import decode_png

    def box(m):
        y, x = np.nonzero(m)
        return [int(x.min()), int(y.min()), int(x.max()), int(y.max())] if len(x) else [0] * 4

    at = {(k, i): decode_png(bytes(c)) for k, i, c in zip(group["kind"], group["instance_index"], group["content"])}
    rgb, scale = at["rgb", -1].astype(np.uint8), float(group["depth_scale"].iloc[0])
    depth = (at["depth", -1][..., 0].astype(np.float64) * scale / 1000).astype(np.float32)
    mask, labels = np.zeros(depth.shape, np.int32), []
    for i in sorted(i for k, i in at if k == "mask"):
        whole, visible = at["mask", i][..., 0] > 0, at["mask_visib", i][..., 0] > 0
        mask[visible] = i + 1
        n, seen = int(whole.sum()), int(visible.sum())
        labels.append({"bbox_visib": box(visible), "bbox_obj": box(whole), "px_count_visib": seen, "px_count_valid": int((visible & (depth > 0)).sum()), "px_count_all": n, "visib_fract": seen / n if n else 0.0})
    row = (group["subset"].iloc[0], group["img_index"].iloc[0], *depth.shape, rgb.tobytes(), depth.tobytes(), mask.tobytes(), labels)
    return pd.DataFrame([row], columns=["subset", "img_index", "height", "width", "rgb", "depth", "mask", "labels"])


def converted_frames(spark: SparkSession, root: str, classes: DataFrame) -> DataFrame:
    """A row for each frame of all scenes: subset, frame_index (from 0 in each subset), pixels, cam_matrix and labelled objs."""
    from ..functions.geometry import matrix_to_quat
    from ..operators.joins import require_match

    key = ["subset", "img_index"]
    frames = require_match(frame_listing(spark, root), scene_cameras(spark, root), key)
    poses = scene_annotations(spark, root).join(frames.select(*key), key, "left_semi")
    found = require_match(poses, classes.select("class_id", "class_name"), ["class_id"])
    pixels = join_frame_images(frames, found, image_files(spark, root)).join(frames.select(*key, "depth_scale"), key)
    pixels = pixels.groupBy(*key).applyInPandas(_frame_pixels, _PIXELS)
    quat = F.array(*matrix_to_quat(tuple(F.col("rotation")[i] for i in range(9))))
    objs = found.withColumn("quat", quat).groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("instance_index", "class_name", "obj_id", "position", "quat"))).alias("o"))
    whole = frames.join(pixels, key).join(objs, key, "left").withColumn("o", F.coalesce("o", F.array().cast(objs.schema["o"].dataType)))

    def labelled(o, i):
        own = F.col("labels")[i]
        return F.struct(o["class_name"].alias("class"), o["obj_id"].alias("object id"), o["position"].alias("pos"), o["quat"].alias("rotation"), *(own[n].alias(n) for n in ("bbox_visib", "bbox_obj", "px_count_visib", "px_count_valid", "px_count_all", "visib_fract")))

    order = F.row_number().over(Window.partitionBy("subset").orderBy("img_index")) - 1
    numbers = frames.select(*key, order.alias("frame_index"))  # over names only
    return whole.join(numbers, key).select("subset", "frame_index", "img_index", "height", "width", "rgb", "depth", "mask", "cam_matrix", F.transform("o", labelled).alias("objs"))


def dataset_classes(spark: SparkSession, name: str) -> DataFrame:
    """class_id, class_name of a scene dataset; an unknown dataset is an error."""
    return spark.createDataFrame(list(enumerate(CLASSES[name], 1)), "class_id int, class_name string")


def convert_dataset(spark: SparkSession, root: str, name: str, classes: DataFrame | None, out: str) -> None:
    """Write the frames of a scene dataset below root, a folder for each subset. Without classes, those of the dataset's own list are taken."""
    classes = dataset_classes(spark, name) if classes is None else classes
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    frames = converted_frames(spark, f"{root}/{IMAGE_FOLDERS[name]}", classes)
    frames.repartitionByRange(n, "subset", "frame_index").sortWithinPartitions("subset", "frame_index").write.mode("overwrite").partitionBy("subset").parquet(out)


def pose_json(spark: SparkSession, root: str) -> DataFrame:
    """frame_index and the fields of gt/gt_<index>.json."""
    raw = spark.read.schema(POSE).option("multiLine", "true").option("recursiveFileLookup", "true").option("pathGlobFilter", "gt_*.json").json(root)
    return raw.select(F.regexp_extract(F.col("_metadata.file_path"), r"gt_(\d+)\.json$", 1).cast("int").alias("frame_index"), "*")


def pose_images(spark: SparkSession, root: str) -> DataFrame:
    """frame_index, path and path_R (null without a right image) of rgb/rgb_<index>[_R].png."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "rgb_*.png").load(root).select("path")
    named = files.select("path", F.regexp_extract("path", r"rgb_(\d+)(_R)?\.png$", 1).cast("int").alias("frame_index"), F.col("path").endswith("_R.png").alias("right"))
    left = named.where(~F.col("right")).select("frame_index", "path")
    return left.join(named.where("right").select("frame_index", F.col("path").alias("path_R")), "frame_index", "left")


def pose_pixels(spark: SparkSession, root: str) -> DataFrame:
    """frame_index, rgb and rgb_R (null without a right image, or where a file can't be decoded) of rgb/rgb_<index>[_R].png, decoded."""
    paths = pose_images(spark, root)
    payload = image_table(spark, root, "rgb_*.png", permissive=True).where("corrupt IS NULL").select("path", F.struct("height", "width", "channels", "dtype", "data").alias("image"))
    sides = paths.select("frame_index", F.explode(F.array(F.struct(F.lit("rgb").alias("side"), F.col("path")), F.struct(F.lit("rgb_R").alias("side"), F.col("path_R").alias("path")))).alias("s")).select("frame_index", "s.side", "s.path")
    met = sides.join(payload, "path", "left")
    of = lambda side: F.first(F.when(F.col("side") == side, F.col("image")), ignorenulls=True).alias(side)
    return met.groupBy("frame_index").agg(of("rgb"), of("rgb_R"))


def asset_catalog(spark: SparkSession, root: str, source: str = "ANY") -> DataFrame:
    """path, name of the meshes below root, without derived ones."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", ASSET_PATTERNS[source]).load(root).select("path")
    up = {"YCB": 2, "OMNI3D": 2}.get(source, 0)  # the name is that of a folder above the mesh
    parts = F.split("path", "/")
    name = F.regexp_replace(F.element_at(parts, -1), r"\.[^.]+$", "") if not up else F.element_at(parts, -1 - up)
    return files.where(~F.col("path").contains("_vhacd.obj") & ~F.col("path").contains("_collision.obj")).select("path", name.alias("name"))


def asset_manifest(spark: SparkSession, path: str) -> DataFrame:
    """name, path of an objects.json, paths made absolute."""
    folder = path.rsplit("/", 1)[0]
    rows = spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", "map<string,string>")).alias("name", "rel"))
    return rows.select("name", F.concat(F.lit(folder + "/"), "rel").alias("path"))
