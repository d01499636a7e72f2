"""Order, limits, samples, shard plans and unions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..queries import query
from ..storage import written


@query("ord_frames", "SELECT frame_id, subset FROM fx_frames ORDER BY frame_id", "fx_frames")
def ord_frames(frames):
    return frames.select("frame_id", "subset").orderBy("frame_id")


@query("lim_take", "SELECT frame_id, subset FROM fx_frames ORDER BY frame_id LIMIT 25", "fx_frames")
def lim_take(frames, n=25):
    """The first n records: the limit is the feature."""
    return frames.select("frame_id", "subset").orderBy("frame_id").limit(n)


def head_per_shard(frames: DataFrame, fraction: float) -> DataFrame:
    """The first max(1, int(fraction * n)) frames of each shard of n frames."""
    w = Window.partitionBy("shard_id")
    placed = frames.withColumn("_n", F.count("*").over(w)).withColumn("_k", F.row_number().over(w.orderBy("frame_id")))
    return placed.where(F.col("_k") <= F.greatest(F.lit(1), F.floor(F.col("_n") * fraction))).drop("_n", "_k")


@query("smp_head_per_shard", "SELECT frame_id, shard_id FROM (SELECT frame_id, shard_id, count(*) OVER (PARTITION BY shard_id) AS n, row_number() OVER (PARTITION BY shard_id ORDER BY frame_id) AS k FROM fx_frames) s WHERE k <= greatest(1, floor(n * 0.25e0))", "fx_frames")
def smp_head_per_shard(frames):
    return head_per_shard(frames, 0.25).select("frame_id", "shard_id")


def shuffled(df: DataFrame, key: str, seed: int) -> DataFrame:
    """df in an order that depends on seed and key only, with its rank key."""
    return df.withColumn("h", F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(key).cast("string")).cast("binary"))).orderBy("h")


@query("smp_shuffle_files", "SELECT shard_id, md5(concat_ws('|', '5', CAST(shard_id AS VARCHAR))) AS h FROM (SELECT DISTINCT shard_id FROM fx_frames) s ORDER BY h", "fx_frames")
def smp_shuffle_files(frames):
    return shuffled(frames.select("shard_id").distinct(), "shard_id", 5)


@query("smp_shuffle_rows", "SELECT frame_id, md5(concat_ws('|', '6', CAST(frame_id AS VARCHAR))) AS h FROM fx_frames ORDER BY h", "fx_frames")
def smp_shuffle_rows(frames):
    return shuffled(frames.select("frame_id"), "frame_id", 6)


@query("win_frame_at", "SELECT subset, frame_id FROM (SELECT subset, frame_id, row_number() OVER (PARTITION BY subset ORDER BY frame_id) AS k FROM fx_frames) s WHERE k = 3", "fx_frames")
def win_frame_at(frames, position=2):
    """The frame at a position (from 0) of each subset."""
    return at_position(frames, "subset", "frame_id", position)


#: Ranges into which a range of indices is cut to find a position.
FAN_OUT = 4096


def at_position(df: DataFrame, group: str, index: str, position: int) -> DataFrame:
    """group, index: the index (whole, not null) at a position (from 0) of each group that has one.

    Indices are counted in equal ranges; the range that holds the position is cut up anew until it holds FAN_OUT indices at most, and only
    these are sorted. Each step goes over the indices that are still in question.
    """
    rows = df.select(group, F.col(index).cast("long").alias(index))
    low, high = rows.agg(F.min(index), F.max(index)).first()
    if low is None:
        return rows
    width = 1
    while width * FAN_OUT <= high - low:
        width *= FAN_OUT
    left = F.lit(position).cast("long")
    part = rows.withColumns({"_from": F.lit(low), "_left": left})
    while width > 1:
        cut = part.withColumn("_from", F.col("_from") + F.floor((F.col(index) - F.col("_from")) / width) * width)
        counts = cut.groupBy(group, "_from", "_left").agg(F.count("*").alias("_n"))
        before = F.sum("_n").over(Window.partitionBy(group).orderBy("_from")) - F.col("_n")  # FAN_OUT rows of a group
        chosen = counts.withColumn("_before", before).where("_before <= _left AND _left < _before + _n").select(F.col(group).alias("_g"), F.col("_from").alias("_f"), (F.col("_left") - F.col("_before")).alias("_l"))
        part = cut.drop("_left").join(written(chosen), (F.col(group).eqNullSafe(F.col("_g"))) & (F.col("_from") == F.col("_f"))).select(group, index, "_from", F.col("_l").alias("_left"))
        width //= FAN_OUT
    k = F.row_number().over(Window.partitionBy(group).orderBy(index))
    return part.withColumn("_k", k).where(F.col("_k") == F.col("_left") + 1).select(group, index)


def permuted(position: Column, n: int, seed: int, rounds: int = 4) -> Column:
    """A permutation of 0 to n - 1 that depends on seed and n only: a Feistel network on the next even number of bits.

    Where it leads out of the range it is applied again, which ends after a few times: less than a quarter of the numbers are inside at worst.
    """
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    mask = (1 << half) - 1

    def once(x: Column) -> Column:
        left, right = F.shiftright(x, half), x.bitwiseAND(F.lit(mask))
        for k in range(rounds):
            left, right = right, left.bitwiseXOR(F.xxhash64(F.lit(seed), F.lit(k), right).bitwiseAND(F.lit(mask)))
        return F.shiftleft(left, half).bitwiseOR(right)

    # an array's last number is inside, or a number that has yet to be led on
    walk = F.aggregate(F.sequence(F.lit(1), F.lit(_MOST_WALKS)), once(position.cast("long")), lambda x, _: F.when(x < n, x).otherwise(once(x)))
    return F.when(walk < n, walk).otherwise(F.raise_error(F.lit("no place after so many steps")).cast("long"))


#: Each step leads into the range with a chance of a quarter or more.
_MOST_WALKS = 150


def shuffled_page(df: DataFrame, index: str, seed: int, page: int, size: int) -> DataFrame:
    """Rows of a page (from 0) of df in an order that depends on seed alone, with their place in it; no sort of all rows.

    The places of the page are led to ranks of the index (whole, not null or repeated), which are looked up by counts of ranges.
    """
    n = df.count()
    places = df.sparkSession.range(page * size, min(n, (page + 1) * size)).select(F.col("id").alias("place"), permuted(F.col("id"), max(n, 1), seed).alias("rank"))
    return df.join(ranks(df, index).join(places, "rank").select(F.col("i").alias(index), "place"), index)


def ranks(indices: DataFrame, column: str) -> DataFrame:
    """i (the column's integers) and rank (from 0), by counts of ranges of 4096 integers, so no task orders all of them."""
    ranged = indices.select(F.col(column).alias("i"), F.floor(F.col(column) / 4096).alias("r"))
    counts = ranged.groupBy("r").agg(F.count("*").alias("c"))
    before = counts.select("r", (F.sum("c").over(Window.orderBy("r")) - F.col("c")).alias("before"))  # one row for 4096 indices
    return ranged.join(before, "r").select("i", (F.col("before") + F.row_number().over(Window.partitionBy("r").orderBy("i")) - 1).alias("rank"))


def _shard_of_rank(indices: DataFrame, column: str, divisor: int) -> DataFrame:
    """i, rank and shard (from 1) of each index: max(1, n // divisor) contiguous shards of nearly equal size."""
    n = indices.count()
    shards = max(1, n // divisor)
    small, more = divmod(n, shards)
    edge = more * (small + 1)  # the first shards have one more
    rank = F.col("rank")
    shard = F.when(rank < edge, F.floor(rank / (small + 1))).otherwise(more + F.floor((rank - edge) / max(1, small)))
    return ranks(indices, column).withColumn("shard", (shard + 1).cast("int"))


def shard_plan(indices: DataFrame, column: str, divisor: int) -> DataFrame:
    """shard, start, end, n: contiguous shards of nearly equal size, max(1, n // divisor) of them."""
    return _shard_of_rank(indices, column, divisor).groupBy("shard").agg(F.min("i").alias("start"), F.max("i").alias("end"), F.count("*").alias("n"))


def placed_in_shards(indices: DataFrame, column: str, divisor: int) -> DataFrame:
    """i, shard, start, end: the range of the plan in which each index lies."""
    placed = _shard_of_rank(indices, column, divisor)
    plan = placed.groupBy("shard").agg(F.min("i").alias("start"), F.max("i").alias("end"))
    return placed.select("i", "shard").join(plan, "shard")


#: Frames with the shard of the plan in which they lie, for oracles.
PLACED = """placed AS (SELECT frame_id, CASE WHEN rk < more * (small + 1) THEN floor(rk / (small + 1)) ELSE more + floor((rk - more * (small + 1)) / small) END + 1 AS shard FROM (SELECT frame_id, row_number() OVER (ORDER BY frame_id) - 1 AS rk FROM fx_frames) a,
 (SELECT count(*) // greatest(1, count(*) // 70) AS small, count(*) % greatest(1, count(*) // 70) AS more FROM fx_frames) b)"""


@query("win_shard_plan", f"WITH {PLACED} SELECT CAST(shard AS INT) AS shard, min(frame_id) AS start, max(frame_id) AS \"end\", count(*) AS n FROM placed GROUP BY shard", "fx_frames")
def win_shard_plan(frames):
    return shard_plan(frames, "frame_id", 70)


@query("set_concat_datasets", "SELECT frame_id, subset, fx, NULL::DOUBLE AS baseline FROM fx_frames WHERE subset < '000008' UNION ALL SELECT frame_id, subset, NULL::DOUBLE AS fx, cam_x AS baseline FROM fx_frames WHERE subset >= '000008'", "fx_frames")
def set_concat_datasets(frames):
    """Two datasets with different keys under one root."""
    one = frames.where("subset < '000008'").select("frame_id", "subset", "fx")
    two = frames.where("subset >= '000008'").select("frame_id", "subset", F.col("cam_x").alias("baseline"))
    return one.unionByName(two, allowMissingColumns=True)


@query("set_join_catalogs", "SELECT source, asset_id, name, 1.0e0 / (SELECT count(*) FROM fx_assets) AS chance FROM fx_assets", "fx_assets")
def set_join_catalogs(assets):
    """Catalogs joined to one; each asset of the union is as likely as any other."""
    parts = [assets.where(F.col("source") == s).select("source", "asset_id", "name") for s in ("SYNTHDET", "OMNI3D", "YCB")]
    union = parts[0].unionByName(parts[1]).unionByName(parts[2])
    total = union.agg(F.count("*").alias("t"))  # one row
    return union.join(F.broadcast(total)).select("source", "asset_id", "name", (F.lit(1.0) / F.col("t")).alias("chance"))
