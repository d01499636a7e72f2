"""Projections: keys and types, depth and translation units, masks as images, class names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..queries import query, r6

#: Declared type of each frame key.
KEY_TYPES = {"frame_id": "bigint", "subset": "string", "img_w": "int", "img_h": "int", "cam_x": "float", "cam_y": "float", "cam_z": "float", "fx": "float", "fy": "float", "depth_scale": "float"}
INCH = 0.0254
FAR = 100.0


def select_keys(frames: DataFrame, keys: list[str] | None = None, safe: bool = True) -> DataFrame:
    """The wanted keys; absent ones are left out if safe, and an error otherwise."""
    keys = keys or frames.columns
    return frames.select([k for k in keys if not safe or k in frames.columns])


def cast_keys(frames: DataFrame) -> DataFrame:
    return frames.select([F.col(k).cast(t).alias(k) for k, t in KEY_TYPES.items()])


def depth_metres(raw: Column, scale: Column) -> Column:
    return (raw * scale / 1000).cast("float")


def clip_depth(depth: Column) -> Column:
    """No hit is no depth."""
    return F.when(depth > FAR, 0.0).otherwise(depth)


def class_from_name(name: Column) -> Column:
    """Leading word of an instance name; a name without one is an error."""
    found = F.regexp_extract(name, r"(?U)^(\w+)", 1)
    return F.when(F.length(found) > 0, found).otherwise(F.raise_error(F.concat(F.lit("no class in "), name)))


def unit_scale(source: Column) -> Column:
    """Metres a unit of the source: inches, millimetres, or metres."""
    return F.when(source == "SYNTHDET", F.lit(INCH)).when(source == "OMNI3D", F.lit(0.001)).otherwise(F.lit(1.0))


def instance_mask(pixels: DataFrame, masks: DataFrame) -> DataFrame:
    """frame_id, y, x, id: the last instance on a pixel wins; 0 where there is none.

    What is painted is packed by frame, as rows of an image: both sides meet by frame_id alone, so that pixels and masks which are dealt out by it
    already are not shuffled again.
    """
    painted = masks.where("y IS NOT NULL AND x IS NOT NULL").groupBy("frame_id", "y", "x").agg((F.max("instance_index") + 1).alias("id"))
    lines = painted.groupBy("frame_id", "y").agg(F.map_from_entries(F.collect_list(F.struct("x", "id"))).alias("line"))  # one row of an image
    images = lines.groupBy("frame_id").agg(F.map_from_entries(F.collect_list(F.struct("y", "line"))).alias("image"))  # one image
    found = F.try_element_at(F.try_element_at("image", F.col("y")), F.col("x"))
    return pixels.join(images, "frame_id", "left").select("frame_id", "y", "x", "depth_raw", "depth_scale", F.coalesce(found, F.lit(0)).alias("id"))


MASK = """fx_mask AS MATERIALIZED (SELECT p.frame_id, p.y, p.x, p.depth_raw, p.depth_scale, coalesce(m.id, 0) AS id FROM fx_pixels p LEFT JOIN
 (SELECT frame_id, y, x, CAST(max(instance_index) + 1 AS INT) AS id FROM fx_masks GROUP BY ALL) m ON p.frame_id = m.frame_id AND p.y = m.y AND p.x = m.x)"""


@query("proj_keys", "SELECT frame_id, subset, fx FROM fx_frames", "fx_frames")
def proj_keys(frames):
    return select_keys(frames, ["frame_id", "subset", "fx", "stereo_baseline"])


@query("proj_cast", "SELECT " + ", ".join(f"CAST({k} AS {t.replace('string', 'varchar')}) AS {k}" for k, t in KEY_TYPES.items()) + " FROM fx_frames", "fx_frames")
def proj_cast(frames):
    return cast_keys(frames)


@query("proj_depth_to_m", "SELECT frame_id, y, x, round(CAST(CAST(depth_raw * depth_scale / 1000 AS FLOAT) AS DOUBLE), 6) + 0.0 AS depth FROM fx_pixels", "fx_pixels")
def proj_depth_to_m(pixels):
    return pixels.select("frame_id", "y", "x", r6(depth_metres(F.col("depth_raw"), F.col("depth_scale")).cast("double")).alias("depth"))


@query("proj_depth_clip", "SELECT frame_id, y, x, CASE WHEN depth_raw * 0.125e0 > 100 THEN 0.0e0 ELSE depth_raw * 0.125e0 END AS depth FROM fx_pixels", "fx_pixels")
def proj_depth_clip(pixels):
    return pixels.select("frame_id", "y", "x", clip_depth(F.col("depth_raw") * 0.125).alias("depth"))


@query("proj_trans_to_m", "SELECT frame_id, instance_index, round(pos_x / 1000, 6) + 0.0 AS tx, round(pos_y / 1000, 6) + 0.0 AS ty, round(pos_z / 1000, 6) + 0.0 AS tz FROM fx_annotations", "fx_annotations")
def proj_trans_to_m(annotations):
    t = F.transform(F.array("pos_x", "pos_y", "pos_z"), lambda v: v / 1000)
    return annotations.select("frame_id", "instance_index", *[r6(t[i]).alias(n) for i, n in enumerate(("tx", "ty", "tz"))])


@query("proj_intrinsics", "SELECT frame_id, fx AS k00, cx AS k02, fy AS k11, cy AS k12, 1.0e0 AS k22, depth_scale FROM fx_frames", "fx_frames")
def proj_intrinsics(frames):
    zero = F.lit(0.0)
    k = frames.select("frame_id", "depth_scale", F.array("fx", zero, "cx", zero, "fy", "cy", zero, zero, F.lit(1.0)).alias("k"))
    at = lambda r, c: F.element_at("k", 3 * r + c + 1).alias(f"k{r}{c}")
    return k.select("frame_id", at(0, 0), at(0, 2), at(1, 1), at(1, 2), at(2, 2), "depth_scale")


@query("proj_instance_id", "SELECT frame_id, obj_id, cls FROM fx_annotations", "fx_annotations")
def proj_instance_id(annotations):
    packed = annotations.groupBy("frame_id").agg(F.array_sort(F.collect_list(F.struct("instance_index", "cls"))).alias("objs"))  # the objects of one frame
    return packed.select("frame_id", F.posexplode("objs")).select("frame_id", (F.col("pos") + 1).alias("obj_id"), "col.cls")


@query("proj_identity_camera", "SELECT frame_id, 0.0e0 AS lx, 0.0e0 AS ly, 0.0e0 AS lz, 0.0e0 AS qx, 0.0e0 AS qy, 0.0e0 AS qz, 1.0e0 AS qw FROM fx_frames", "fx_frames")
def proj_identity_camera(frames):
    return frames.select("frame_id", *[F.lit(v).alias(n) for n, v in zip(("lx", "ly", "lz", "qx", "qy", "qz", "qw"), (0.0,) * 6 + (1.0,))])


@query("proj_class_from_name", "SELECT p_partkey, regexp_extract(replace(p_name, ' ', '_') || '.001', '^(\\w+)', 1) AS cls FROM part", "part")
def proj_class_from_name(part):
    return part.select("p_partkey", class_from_name(F.concat(F.replace("p_name", F.lit(" "), F.lit("_")), F.lit(".001"))).alias("cls"))


@query("proj_unit_scale", "SELECT asset_id, CASE source WHEN 'SYNTHDET' THEN 0.0254e0 WHEN 'OMNI3D' THEN 0.001e0 ELSE 1.0e0 END AS scale FROM fx_assets", "fx_assets")
def proj_unit_scale(assets):
    return assets.select("asset_id", unit_scale(F.col("source")).alias("scale"))


@query("proj_binary_mask", f"WITH {MASK} SELECT m.frame_id, a.obj_id, string_agg(CASE WHEN m.id = a.obj_id THEN '1' ELSE '0' END, '' ORDER BY m.y, m.x) AS bits FROM fx_mask m JOIN fx_annotations a ON a.frame_id = m.frame_id GROUP BY m.frame_id, a.obj_id", "fx_pixels", "fx_masks", "fx_annotations")
def proj_binary_mask(pixels, masks, annotations):
    """The 0/1 mask of each object, row by row; the instance mask is an array for each frame."""
    mask = instance_mask(pixels, masks).groupBy("frame_id").agg(F.array_sort(F.collect_list(F.struct("y", "x", "id"))).alias("m"))  # the pixels of one frame
    both = mask.join(annotations.select("frame_id", "obj_id"), "frame_id")
    return both.select("frame_id", "obj_id", F.array_join(F.transform("m.id", lambda v: F.when(v == F.col("obj_id"), "1").otherwise("0")), "").alias("bits"))


@query("proj_semantic_mask", f"WITH {MASK} SELECT m.frame_id, m.y, m.x, coalesce(a.class_id, 0) AS class_id FROM fx_mask m LEFT JOIN fx_annotations a ON a.frame_id = m.frame_id AND a.obj_id = m.id AND a.has_semantics", "fx_pixels", "fx_masks", "fx_annotations")
def proj_semantic_mask(pixels, masks, annotations):
    classes = annotations.where("has_semantics").groupBy("frame_id").agg(F.map_from_entries(F.collect_list(F.struct("obj_id", "class_id"))).alias("classes"))  # the objects of one frame
    return instance_mask(pixels, masks).join(classes, "frame_id", "left").select("frame_id", "y", "x", F.coalesce(F.try_element_at("classes", F.col("id")), F.lit(0)).alias("class_id"))


@query("proj_depth_u8", "SELECT frame_id, y, x, CAST(least(255, round_even(abs(depth_raw / 1000.0e0 * 170), 0)) AS INT) AS v FROM fx_pixels", "fx_pixels")
def proj_depth_u8(pixels):
    return pixels.select("frame_id", "y", "x", F.least(F.lit(255), F.bround(F.abs(F.col("depth_raw") / 1000.0 * 170), 0)).cast("int").alias("v"))


@query("proj_mask_u8", f"WITH {MASK} SELECT frame_id, y, x, CAST(coalesce(round_even(id * 255.0e0 / nullif(max(id) OVER (PARTITION BY frame_id), 0), 0), 0) AS INT) AS v FROM fx_mask", "fx_pixels", "fx_masks")
def proj_mask_u8(pixels, masks):
    top = F.max("id").over(Window.partitionBy("frame_id"))
    return instance_mask(pixels, masks).select("frame_id", "y", "x", F.coalesce(F.bround(F.col("id") * 255.0 / F.nullif(top, F.lit(0)), 0), F.lit(0)).cast("int").alias("v"))


def record_summary(frames: DataFrame) -> DataFrame:
    """key, dtype and shape (sizes, comma-joined; empty for a scalar) of each column of each frame; null values have no shape.

    An array of arrays has the size of its first row as the second number.
    """
    id_, *rest = frames.columns
    parts = []
    for f in frames.schema.fields[1:]:
        kind, sizes = f.dataType, []
        at = F.col(f.name)
        while kind.typeName() == "array":
            sizes.append(F.size(at).cast("string"))
            kind, at = kind.elementType, F.get(at, F.lit(0))
        shape = F.concat_ws(",", *sizes) if sizes else F.lit("")
        parts.append(F.struct(F.lit(f.name).alias("key"), F.lit(kind.simpleString()).alias("dtype"), F.when(F.col(f.name).isNotNull(), shape).alias("shape")))
    return frames.select(id_, F.explode(F.array(*parts)).alias("s")).select(id_, "s.*")


@query("proj_record_summary", """WITH n AS (SELECT frame_id, CAST(count(*) AS VARCHAR) AS n FROM fx_annotations GROUP BY frame_id), k AS (SELECT f.frame_id, n FROM fx_frames f LEFT JOIN n ON n.frame_id = f.frame_id)
 SELECT frame_id, 'cam_matrix' AS key, 'double' AS dtype, '3,3' AS shape FROM k UNION ALL SELECT frame_id, 'cam_location', 'double', '3' FROM k UNION ALL SELECT frame_id, 'depth_scale', 'double', '' FROM k
 UNION ALL SELECT frame_id, 'obj_classes', 'string', n FROM k UNION ALL SELECT frame_id, 'obj_pos', 'double', n || ',3' FROM k UNION ALL SELECT frame_id, 'obj_bbox_visib', 'int', n || ',4' FROM k""", "fx_frames", "fx_annotations")
def proj_record_summary(frames, annotations):
    """Keys of each frame's record with their types and shapes."""
    zero, one = F.lit(0.0), F.lit(1.0)
    camera = frames.select("frame_id", F.array(F.array("fx", zero, "cx"), F.array(zero, "fy", "cy"), F.array(zero, zero, one)).alias("cam_matrix"), F.array("cam_x", "cam_y", "cam_z").alias("cam_location"), "depth_scale")
    objects = annotations.groupBy("frame_id").agg(F.array_sort(F.collect_list(F.struct("instance_index", "cls", F.array("pos_x", "pos_y", "pos_z").alias("pos"), F.array("x1", "y1", "x2", "y2").alias("box")))).alias("o"))  # the objects of one frame
    packed = objects.select("frame_id", F.col("o.cls").alias("obj_classes"), F.col("o.pos").alias("obj_pos"), F.col("o.box").alias("obj_bbox_visib"))
    return record_summary(camera.join(packed, "frame_id", "left"))
