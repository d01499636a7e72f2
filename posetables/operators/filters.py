"""Filters: visible and labelled objects, valid depth, assets, shards and index ranges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..queries import query

VISIBLE = "(x1 > 0 OR y1 > 0 OR x2 > 0 OR y2 > 0)"


def visible(x1: str = "x1", y1: str = "y1", x2: str = "x2", y2: str = "y2") -> Column:
    """Some value of the visible box is positive; a box at pixel (0, 0) alone counts as unseen."""
    return (F.col(x1) > 0) | (F.col(y1) > 0) | (F.col(x2) > 0) | (F.col(y2) > 0)


@query("flt_visible", f"SELECT frame_id, obj_id, cls FROM fx_annotations WHERE {VISIBLE}", "fx_annotations")
def flt_visible(annotations):
    return annotations.where(visible()).select("frame_id", "obj_id", "cls")


@query("flt_hidden", "SELECT frame_id, obj_id, has_semantics FROM fx_annotations WHERE NOT hidden AND has_semantics", "fx_annotations")
def flt_hidden(annotations):
    return annotations.where(~F.col("hidden") & F.col("has_semantics")).select("frame_id", "obj_id", "has_semantics")


@query("flt_valid_depth", "SELECT frame_id, y, x, depth_raw FROM fx_pixels WHERE depth_raw > 0", "fx_pixels")
def flt_valid_depth(pixels):
    return pixels.where("depth_raw > 0").select("frame_id", "y", "x", "depth_raw")


@query("flt_asset_exclude", "SELECT asset_id, path FROM fx_assets WHERE NOT contains(path, '_vhacd.obj') AND NOT contains(path, '_collision.obj') AND name NOT IN ('almond_antique', 'goldenrod_lavender')", "fx_assets")
def flt_asset_exclude(assets, exclude=("almond_antique", "goldenrod_lavender")):
    derived = F.col("path").contains("_vhacd.obj") | F.col("path").contains("_collision.obj")
    return assets.where(~derived & ~F.col("name").isin(*exclude)).select("asset_id", "path")


@query("flt_textures", "SELECT path, kind FROM (SELECT path, CASE WHEN NOT contains(lower(path), 'norm') AND path LIKE '%.png' THEN 'floor' WHEN path LIKE '%.jpg' THEN 'background' END AS kind FROM (SELECT concat('textures/', replace(p_name, ' ', '_'), CASE p_partkey % 5 WHEN 0 THEN '_Normal.png' WHEN 1 THEN '_norm.png' WHEN 2 THEN '.jpg' WHEN 3 THEN '.exr' ELSE '_color.png' END) AS path FROM part) f) t WHERE kind IS NOT NULL", "part")
def flt_textures(part):
    """Floor textures and backgrounds of a listing of files, whose names come from the parts."""
    tails = F.element_at(F.array(*map(F.lit, ("_Normal.png", "_norm.png", ".jpg", ".exr", "_color.png"))), (F.col("p_partkey") % 5 + 1).cast("int"))
    return textures(part.select(F.concat(F.lit("textures/"), F.replace("p_name", F.lit(" "), F.lit("_")), tails).alias("path")))


def textures(files: DataFrame) -> DataFrame:
    """path, kind: floors are the .png files without norm in their name, backgrounds the .jpg files; the rest goes."""
    path = F.col("path")
    kind = F.when(~F.lower(path).contains("norm") & path.endswith(".png"), "floor").when(path.endswith(".jpg"), "background")
    return files.select("path", kind.alias("kind")).where("kind is not null")


@query("flt_diameter_ratio", "SELECT asset_id, diameter FROM fx_assets, (SELECT diameter AS d0 FROM fx_assets WHERE diameter > 0 ORDER BY asset_id LIMIT 1) f WHERE abs(diameter - d0) / d0 <= 0.7e0", "fx_assets")
def flt_diameter_ratio(assets, most=0.7):
    first = assets.where("diameter > 0").orderBy("asset_id").limit(1).select(F.col("diameter").alias("d0"))  # one row
    return assets.join(F.broadcast(first)).where(F.abs(F.col("diameter") - F.col("d0")) / F.col("d0") <= most).select("asset_id", "diameter")


@query("flt_shard_pattern", "SELECT subset, shard_id, frame_id FROM fx_frames WHERE subset = '000003' AND shard_id BETWEEN 2 AND 9", "fx_frames")
def flt_shard_pattern(frames):
    return frames.where((F.col("subset") == "000003") & F.col("shard_id").between(2, 9)).select("subset", "shard_id", "frame_id")


def pending_indices(written: DataFrame, start: int, end: int) -> DataFrame:
    """frame_id of the inclusive range start to end that isn't among written."""
    wanted = written.sparkSession.range(start, end + 1).withColumnRenamed("id", "frame_id")
    return wanted.join(written.select("frame_id"), "frame_id", "left_anti")


@query("flt_index_range", "SELECT r.i AS frame_id FROM (SELECT unnest(range(1, (SELECT max(frame_id) FROM fx_frames) + 1)) AS i) r LEFT JOIN fx_frames f ON f.frame_id = r.i AND f.fx < 530 WHERE f.frame_id IS NULL", "fx_frames")
def flt_index_range(frames):
    """Indices from 1 to the last frame's that are still to be written; frames of short focal length have been."""
    last = frames.agg(F.max("frame_id")).first()[0]
    return pending_indices(frames.where("fx < 530"), 1, last or 0)


@query("flt_square_pixels", "SELECT frame_id, abs(fy - fx) > 0.001e0 AS not_square FROM fx_frames", "fx_frames")
def flt_square_pixels(frames):
    return frames.select("frame_id", (F.abs(F.col("fy") - F.col("fx")) > 0.001).alias("not_square"))
