"""Joins of frames, cameras, annotations, classes, masks, assets and shards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..queries import query, r6
from ..storage import written
from .projections import MASK, instance_mask


def digest(seed: int, key: Column | str, channel: str) -> Column:
    """32 hexadecimal digits that depend on seed, key and channel only."""
    key = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat_ws("|", F.lit(str(seed)), key.cast("string"), F.lit(channel)).cast("binary"))


def digest_sql(seed: int, key: str, channel: str) -> str:
    return f"md5(concat_ws('|', '{seed}', CAST({key} AS VARCHAR), '{channel}'))"


def part_of(digest: Column, part: int) -> Column:
    """One of a digest's four numbers in [0, 1)."""
    return F.conv(F.substring(digest, 8 * part + 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def part_sql(digest: str, part: int) -> str:
    return f"(CAST(('0x' || substring({digest}, {8 * part + 1}, 8)) AS BIGINT) / 4294967296.0e0)"


def uniform(seed: int, key: Column | str, channel: str) -> Column:
    """A number in [0, 1) that depends on seed, key and channel only."""
    return part_of(digest(seed, key, channel), 0)


def uniform_sql(seed: int, key: str, channel: str) -> str:
    return part_sql(digest_sql(seed, key, channel), 0)


def require_match(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """Inner join in which a row of left without a partner is an error."""
    marked = left.join(right.withColumn("_met", F.lit(True)), on, "left")
    checked = marked.withColumn("_ok", F.when(F.col("_met"), True).otherwise(F.raise_error(F.lit("a row has no partner")).cast("boolean")))
    return checked.where("_ok").drop("_met", "_ok")


def cumulated(choices: DataFrame, key: str) -> DataFrame:
    """key, weight and `hi`, the sum of the weights up to a key: sums of ranges of keys, and sums within each."""
    ranged = written(choices.where("weight > 0").select(key, F.col("weight").cast("double").alias("weight")).repartitionByRange(key).withColumn("_p", F.spark_partition_id()))
    sums = ranged.groupBy("_p").agg(F.sum("weight").alias("s"))
    before = sums.select("_p", (F.sum("s").over(Window.orderBy("_p")) - F.col("s")).alias("before"))  # a row for each partition
    within = F.sum("weight").over(Window.partitionBy("_p").orderBy(key).rowsBetween(Window.unboundedPreceding, 0))
    return ranged.join(before, "_p").select(key, "weight", (F.col("before") + within).alias("hi"))


def pick_by_weight(draws: DataFrame, choices: DataFrame, key: str) -> DataFrame:
    """draws with a key of choices (key, weight; keys from low to high) for its u in [0, 1), each with its share of the weights.

    A guide table: [0, 1) is cut into as many cells as there are choices, and a choice has a row for each cell that its interval touches,
    about two in the mean. A draw meets the few choices of its own cell, so a draw takes the same time whatever their number.
    Choices without weight are never drawn; without choices there are no rows.
    """
    intervals = cumulated(choices, key)
    size = intervals.agg(F.count("*").alias("_n"), F.max("hi").alias("_total")).where("_n > 0")  # one row
    cell = lambda c: F.least(F.greatest(F.floor(c / F.col("_total") * F.col("_n")), F.lit(0)), F.col("_n") - 1)
    guide = intervals.join(F.broadcast(size)).select(
        F.explode(F.sequence(cell(F.col("hi") - F.col("weight")), cell(F.col("hi")))).alias("_cell"),
        F.col(key), (F.col("hi") - F.col("weight")).alias("_lo"), F.col("hi").alias("_hi"),
    )
    placed = draws.join(F.broadcast(size)).withColumn("_at", F.col("u") * F.col("_total")).withColumn("_cell", cell(F.col("_at")))
    return placed.join(guide, "_cell").where("_at >= _lo AND _at < _hi").select(*[c for c in draws.columns if c != "u"], key)


@query("join_frame_camera", "SELECT o_orderkey AS frame_id, f.subset, f.fx, f.cx, f.depth_scale FROM orders o JOIN fx_frames f ON f.frame_id = o_orderkey AND f.subset = lpad(CAST(o.o_custkey % 15 + 1 AS STRING), 6, '0')", "orders", "fx_frames")
def join_frame_camera(orders, cameras):
    """The camera entry of each listed image, by subset and index; an image without one is an error."""
    listed = orders.select(F.col("o_orderkey").alias("frame_id"), F.lpad((F.col("o_custkey") % 15 + 1).cast("string"), 6, "0").alias("subset"))
    return require_match(listed, cameras.select("subset", "frame_id", "fx", "cx", "depth_scale"), ["subset", "frame_id"])


@query("join_frame_annotations", "SELECT f.frame_id, f.subset, a.obj_id, a.cls FROM fx_frames f LEFT JOIN fx_annotations a ON a.frame_id = f.frame_id", "fx_frames", "fx_annotations")
def join_frame_annotations(frames, annotations):
    return frames.select("frame_id", "subset").join(annotations.select("frame_id", "obj_id", "cls"), "frame_id", "left")


@query("join_class_dim", "SELECT a.frame_id, a.obj_id, p.p_name AS class_name FROM fx_annotations a JOIN part p ON p_partkey = class_id", "fx_annotations", "part")
def join_class_dim(annotations, part):
    return require_match(annotations.select("frame_id", "obj_id", F.col("class_id").alias("p_partkey")), part.select("p_partkey", F.col("p_name").alias("class_name")), ["p_partkey"]).drop("p_partkey")


def positions(frames: DataFrame) -> DataFrame:
    """Record position of each frame in its shard."""
    return frames.withColumn("position", F.row_number().over(Window.partitionBy("shard_id").orderBy("frame_id")))


@query("join_v1_families", "WITH r AS (SELECT shard_id, row_number() OVER (PARTITION BY shard_id ORDER BY frame_id) AS position, fx, frame_id FROM fx_frames), g AS (SELECT shard_id, row_number() OVER (PARTITION BY shard_id ORDER BY frame_id) AS position, cam_x FROM fx_frames WHERE fx < 540) SELECT r.shard_id, CAST(r.position AS INT) AS position, fx, cam_x FROM r JOIN g ON r.shard_id = g.shard_id AND r.position = g.position", "fx_frames")
def join_v1_families(frames):
    """Two file families of a shard, of which the second is shorter, zipped by position: the shorter one wins."""
    rgb = positions(frames).select("shard_id", "position", "fx")
    gt = positions(frames.where("fx < 540")).select("shard_id", "position", "cam_x")
    return rgb.join(gt, ["shard_id", "position"])


@query("join_mask_depth", f"WITH {MASK} SELECT frame_id, id, count(*) AS n, CAST(sum(CASE WHEN depth_raw > 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_valid FROM fx_mask GROUP BY frame_id, id", "fx_pixels", "fx_masks")
def join_mask_depth(pixels, masks):
    return instance_mask(pixels, masks).groupBy("frame_id", "id").agg(F.count("*").alias("n"), F.count_if(F.col("depth_raw") > 0).alias("n_valid"))


@query("join_asset_meta", "SELECT a.asset_id, coalesce(m.mass, 1.0e0) AS mass, coalesce(m.name, a.name) AS name FROM fx_assets a LEFT JOIN (SELECT p_partkey AS asset_id, CAST(p_size AS DOUBLE) / 4 AS mass, CASE WHEN p_size > 25 THEN 'heavy' END AS name FROM part WHERE p_size > 10) m ON m.asset_id = a.asset_id", "fx_assets", "part")
def join_asset_meta(assets, part):
    meta = part.where("p_size > 10").select(F.col("p_partkey").alias("asset_id"), (F.col("p_size").cast("double") / 4).alias("mass"), F.when(F.col("p_size") > 25, "heavy").alias("meta_name"))
    return assets.join(meta, "asset_id", "left").select("asset_id", F.coalesce("mass", F.lit(1.0)).alias("mass"), F.coalesce("meta_name", "name").alias("name"))


@query("join_pending_shards", "SELECT DISTINCT shard_id FROM fx_frames WHERE shard_id NOT IN (SELECT CAST(floor(l_orderkey / 100) AS BIGINT) FROM lineitem WHERE l_returnflag = 'A' AND l_linenumber = 7 AND l_quantity < 3)", "fx_frames", "lineitem")
def join_pending_shards(frames, lineitem):
    """Shards for which no partial is kept; here those that hold a certain kind of line count as kept."""
    cached = lineitem.where("l_returnflag = 'A' and l_linenumber = 7 and l_quantity < 3").select(F.floor(F.col("l_orderkey") / 100).alias("shard_id"))
    return frames.select("shard_id").distinct().join(cached, "shard_id", "left_anti")


@query("join_clearance", "SELECT f.frame_id FROM fx_frames f LEFT JOIN fx_annotations a ON a.frame_id = f.frame_id GROUP BY f.frame_id HAVING coalesce(bool_and(sqrt((pos_x - cam_x) * (pos_x - cam_x) + (pos_y - cam_y) * (pos_y - cam_y) + (pos_z - cam_z) * (pos_z - cam_z)) - 0.05e0 > 0.4e0), true)", "fx_frames", "fx_annotations")
def join_clearance(frames, annotations, diameter=0.1, least=0.4):
    """Cameras that are far enough from every object of their frame."""
    d = [F.col(f"pos_{k}") - F.col(f"cam_{k}") for k in "xyz"]
    near = frames.join(annotations, "frame_id").where(~(F.sqrt(d[0] * d[0] + d[1] * d[1] + d[2] * d[2]) - diameter / 2 > least))
    return frames.select("frame_id").join(near.select("frame_id"), "frame_id", "left_anti")


@query("join_weighted_pick", f"""WITH w AS (SELECT n_nationkey, n_nationkey + 1 AS weight FROM nation), c AS (SELECT n_nationkey, sum(weight) OVER (ORDER BY n_nationkey) AS hi, weight, (SELECT sum(weight) FROM w) AS total FROM w)
 SELECT frame_id, n_nationkey AS picked FROM (SELECT frame_id, {uniform_sql(3, 'frame_id', 'pick')} AS u FROM fx_frames) f JOIN c ON u * total >= hi - weight AND u * total < hi""", "fx_frames", "nation")
def join_weighted_pick(frames, nation):
    """A stable pose for each frame, drawn with its probability."""
    weights = nation.select(F.col("n_nationkey").alias("picked"), (F.col("n_nationkey") + 1).alias("weight"))
    return pick_by_weight(frames.select("frame_id", uniform(3, "frame_id", "pick").alias("u")), weights, "picked").select("frame_id", "picked")
