"""Aggregates: boxes and pixel counts of masks, packed frames, dataset statistics, histograms."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.geometry import cols, longest_side, norm, subtract
from ..queries import query, r6
from ..storage import written
from .filters import VISIBLE, visible
from .projections import MASK, instance_mask

PX_KEYS = ["frame_id", "instance_index"]


def boxes(masks: DataFrame) -> DataFrame:
    """Tight inclusive box and pixel count of each mask."""
    return masks.groupBy(*PX_KEYS).agg(F.min("x").alias("x1"), F.min("y").alias("y1"), F.max("x").alias("x2"), F.max("y").alias("y2"), F.count("*").alias("px_all"))


def visible_parts(pixels: DataFrame, masks: DataFrame) -> DataFrame:
    """Box, pixels and valid pixels of what each instance shows in the painted mask."""
    shown = instance_mask(pixels, masks).where("id > 0").withColumn("instance_index", F.col("id") - 1)
    return shown.groupBy(*PX_KEYS).agg(
        F.min("x").alias("vx1"), F.min("y").alias("vy1"), F.max("x").alias("vx2"), F.max("y").alias("vy2"),
        F.count("*").alias("px_visib"), F.count_if(F.col("depth_raw") > 0).alias("px_valid"),
    )


def annotate(pixels: DataFrame, masks: DataFrame, annotations: DataFrame) -> DataFrame:
    """The annotation record of each object; objects without semantics have full-mask fields of zero."""
    full, seen = boxes(masks), visible_parts(pixels, masks)
    both = annotations.select(*PX_KEYS, "cls", "has_semantics").join(full, PX_KEYS, "left").join(seen, PX_KEYS, "left")
    zero = lambda c: F.coalesce(c, F.lit(0))
    labelled = lambda c: F.when(F.col("has_semantics"), zero(F.col(c))).otherwise(F.lit(0))
    px_all, px_visib = labelled("px_all"), zero(F.col("px_visib"))
    return both.select(
        *PX_KEYS, "cls", *[zero(F.col(f"v{c}")).alias(f"v{c}") for c in ("x1", "y1", "x2", "y2")], *[labelled(c).alias(c) for c in ("x1", "y1", "x2", "y2")],
        px_visib.alias("px_visib"), labelled("px_valid").alias("px_valid"), px_all.alias("px_all"), r6(F.when(px_all > 0, px_visib / px_all).otherwise(0.0)).alias("visib_fract"),
    )


_VIS = f"{MASK}, vis AS (SELECT frame_id, CAST(id - 1 AS INT) AS instance_index, min(x) AS vx1, min(y) AS vy1, max(x) AS vx2, max(y) AS vy2, count(*) AS px_visib, CAST(sum(CASE WHEN depth_raw > 0 THEN 1 ELSE 0 END) AS BIGINT) AS px_valid FROM fx_mask WHERE id > 0 GROUP BY frame_id, id)"
_FULL = "full_mask AS (SELECT frame_id, instance_index, min(x) AS x1, min(y) AS y1, max(x) AS x2, max(y) AS y2, count(*) AS px_all FROM fx_masks GROUP BY ALL)"


@query("agg_bbox", f"WITH {_FULL} SELECT a.frame_id, a.instance_index, coalesce(m.x1, 0) AS x1, coalesce(m.y1, 0) AS y1, coalesce(m.x2, 0) AS x2, coalesce(m.y2, 0) AS y2 FROM fx_annotations a LEFT JOIN full_mask m USING (frame_id, instance_index)", "fx_annotations", "fx_masks")
def agg_bbox(annotations, masks):
    return annotations.select(*PX_KEYS).join(boxes(masks), PX_KEYS, "left").select(*PX_KEYS, *[F.coalesce(c, F.lit(0)).alias(c) for c in ("x1", "y1", "x2", "y2")])


@query("agg_px_visib", f"WITH {_VIS} SELECT frame_id, instance_index, px_visib FROM vis", "fx_pixels", "fx_masks")
def agg_px_visib(pixels, masks):
    return visible_parts(pixels, masks).select(*PX_KEYS, "px_visib")


@query("agg_px_all", f"WITH {_FULL} SELECT frame_id, instance_index, px_all FROM full_mask", "fx_masks")
def agg_px_all(masks):
    return boxes(masks).select(*PX_KEYS, "px_all")


@query("agg_px_valid", f"WITH {_VIS} SELECT frame_id, instance_index, px_valid FROM vis", "fx_pixels", "fx_masks")
def agg_px_valid(pixels, masks):
    return visible_parts(pixels, masks).select(*PX_KEYS, "px_valid")


@query("agg_visib_fract", f"WITH {_VIS}, {_FULL} SELECT a.frame_id, a.instance_index, round(CASE WHEN px_all > 0 THEN coalesce(px_visib, 0) / px_all ELSE 0.0e0 END, 6) + 0.0 AS visib_fract FROM fx_annotations a LEFT JOIN full_mask f USING (frame_id, instance_index) LEFT JOIN vis USING (frame_id, instance_index)", "fx_annotations", "fx_pixels", "fx_masks")
def agg_visib_fract(annotations, pixels, masks):
    both = annotations.select(*PX_KEYS).join(boxes(masks).select(*PX_KEYS, "px_all"), PX_KEYS, "left").join(visible_parts(pixels, masks).select(*PX_KEYS, "px_visib"), PX_KEYS, "left")
    return both.select(*PX_KEYS, r6(F.when(F.col("px_all") > 0, F.coalesce("px_visib", F.lit(0)) / F.col("px_all")).otherwise(0.0)).alias("visib_fract"))


@query("agg_instance_mask", f"WITH {MASK} SELECT frame_id, y, x, id FROM fx_mask", "fx_pixels", "fx_masks")
def agg_instance_mask(pixels, masks):
    return instance_mask(pixels, masks).select("frame_id", "y", "x", "id")


ANNOTATE = f"""WITH {_VIS}, {_FULL} SELECT a.frame_id, a.instance_index, a.cls, coalesce(vx1, 0) AS vx1, coalesce(vy1, 0) AS vy1, coalesce(vx2, 0) AS vx2, coalesce(vy2, 0) AS vy2,
 CASE WHEN has_semantics THEN coalesce(f.x1, 0) ELSE 0 END AS x1, CASE WHEN has_semantics THEN coalesce(f.y1, 0) ELSE 0 END AS y1, CASE WHEN has_semantics THEN coalesce(f.x2, 0) ELSE 0 END AS x2, CASE WHEN has_semantics THEN coalesce(f.y2, 0) ELSE 0 END AS y2,
 coalesce(px_visib, 0) AS px_visib, CASE WHEN has_semantics THEN coalesce(px_valid, 0) ELSE 0 END AS px_valid, CASE WHEN has_semantics THEN coalesce(px_all, 0) ELSE 0 END AS px_all,
 round(CASE WHEN has_semantics AND px_all > 0 THEN coalesce(px_visib, 0) / px_all ELSE 0.0e0 END, 6) + 0.0 AS visib_fract
 FROM fx_annotations a LEFT JOIN full_mask f USING (frame_id, instance_index) LEFT JOIN vis USING (frame_id, instance_index)"""


def annotate_columns(px_visib: str, px_all: str) -> Column:
    """Visible share of an object's pixels."""
    return r6(F.when(F.col(px_all) > 0, F.col(px_visib) / F.col(px_all)).otherwise(0.0)).alias("visib_fract")


@query("agg_annotate", ANNOTATE, "fx_pixels", "fx_masks", "fx_annotations")
def agg_annotate(pixels, masks, annotations):
    return annotate(pixels, masks, annotations)


def pack_frames(annotations: DataFrame, fields: list[str]) -> DataFrame:
    """Parallel arrays of the fields for each frame, in instance order."""
    rows = annotations.groupBy("frame_id").agg(F.array_sort(F.collect_list(F.struct("instance_index", *fields))).alias("o"))  # the objects of one frame
    return rows.select("frame_id", *[F.col(f"o.{f}").alias(f) for f in fields])


def unpack_frames(packed: DataFrame, fields: list[str]) -> DataFrame:
    rows = packed.select("frame_id", F.posexplode(F.arrays_zip(*fields)).alias("instance_index", "o"))
    return rows.select("frame_id", "instance_index", *[F.col(f"o.{f}").alias(f) for f in fields])


@query("agg_pack_frame", "SELECT frame_id, string_agg(cls, ',' ORDER BY instance_index) AS classes, string_agg(CAST(x1 AS VARCHAR), ',' ORDER BY instance_index) AS lefts, count(*) AS n FROM fx_annotations GROUP BY frame_id", "fx_annotations")
def agg_pack_frame(annotations):
    packed = pack_frames(annotations, ["cls", "x1"])
    return packed.select("frame_id", F.array_join("cls", ",").alias("classes"), F.array_join(F.transform("x1", lambda v: v.cast("string")), ",").alias("lefts"), F.size("cls").cast("long").alias("n"))


@query("agg_unpack_frame", "SELECT frame_id, instance_index, cls, x1 FROM fx_annotations", "fx_annotations")
def agg_unpack_frame(annotations):
    return unpack_frames(pack_frames(annotations, ["cls", "x1"]), ["cls", "x1"])


@query("agg_n_objects", f"SELECT f.frame_id, CAST(coalesce(sum(CASE WHEN {VISIBLE} THEN 1 ELSE 0 END), 0) AS BIGINT) AS n_objects FROM fx_frames f LEFT JOIN fx_annotations a ON a.frame_id = f.frame_id GROUP BY f.frame_id", "fx_frames", "fx_annotations")
def agg_n_objects(frames, annotations):
    return frames.select("frame_id").join(annotations, "frame_id", "left").groupBy("frame_id").agg(F.count_if(visible()).alias("n_objects"))


@query("agg_n_classes", f"SELECT f.frame_id, count(DISTINCT CASE WHEN {VISIBLE} THEN cls END) AS n_classes, coalesce(string_agg(DISTINCT CASE WHEN {VISIBLE} THEN cls END, ',' ORDER BY CASE WHEN {VISIBLE} THEN cls END), '') AS classes FROM fx_frames f LEFT JOIN fx_annotations a ON a.frame_id = f.frame_id GROUP BY f.frame_id", "fx_frames", "fx_annotations")
def agg_n_classes(frames, annotations):
    found = frames.select("frame_id").join(annotations, "frame_id", "left").groupBy("frame_id").agg(F.sort_array(F.collect_set(F.when(visible(), F.col("cls")))).alias("c"))
    return found.select("frame_id", F.size("c").cast("long").alias("n_classes"), F.array_join("c", ",").alias("classes"))


def observations(frames: DataFrame, annotations: DataFrame) -> DataFrame:
    """A row for each object, and one for each frame without any: seen, distance to the camera, longest side."""
    both = frames.select("frame_id", "shard_id", "img_w", "img_h", "cam_x", "cam_y", "cam_z").join(annotations.drop("hidden"), "frame_id", "left")
    dist = norm(subtract(cols("pos_x", "pos_y", "pos_z"), cols("cam_x", "cam_y", "cam_z")))
    return both.select("frame_id", "shard_id", F.coalesce(visible(), F.lit(False)).alias("seen"), "cls", dist.alias("dist"), longest_side(*cols("x1", "y1", "x2", "y2", "img_w", "img_h")).alias("side"))


OBSERVED = f"""obs AS (SELECT f.frame_id, f.shard_id, a.cls, CASE WHEN {VISIBLE} THEN 1 ELSE 0 END AS v, greatest((x2 - x1) / CAST(img_w AS DOUBLE), (y2 - y1) / CAST(img_h AS DOUBLE)) AS side,
 sqrt((pos_x - cam_x) * (pos_x - cam_x) + (pos_y - cam_y) * (pos_y - cam_y) + (pos_z - cam_z) * (pos_z - cam_z)) AS dist FROM fx_frames f LEFT JOIN fx_annotations a ON f.frame_id = a.frame_id)"""
PARTIAL = ["n_images", "n_objects", "n_classes", "sum_dist", "sum_dist2", "sum_side", "sum_side2"]


def per_frame(observed: DataFrame) -> DataFrame:
    """One row for each frame: counts and sums over its seen objects."""
    seen = F.col("seen")
    total = lambda c: F.coalesce(F.sum(F.when(seen, c)), F.lit(0.0))
    return observed.groupBy("shard_id", "frame_id").agg(
        F.count_if(seen).alias("n_objects"), F.size(F.collect_set(F.when(seen, F.col("cls")))).cast("long").alias("n_classes"),
        total(F.col("dist")).alias("sum_dist"), total(F.col("dist") * F.col("dist")).alias("sum_dist2"), total(F.col("side")).alias("sum_side"), total(F.col("side") * F.col("side")).alias("sum_side2"),
    )


def shard_partials(observed: DataFrame) -> DataFrame:
    """Mergeable statistics of each shard: a few sums, no lists of values."""
    return per_frame(observed).groupBy("shard_id").agg(F.count("*").alias("n_images"), *[F.sum(c).alias(c) for c in PARTIAL[1:]])


def merge_partials(partials: DataFrame) -> DataFrame:
    """Dataset statistics of shard partials; standard deviations are those of the population, and a mean of nothing is null."""
    s = partials.agg(*[F.sum(c).alias(c) for c in PARTIAL])
    n = F.col("n_objects")
    mean = lambda total, count: F.try_divide(F.col(total), count)
    std = lambda k: F.when(n > 0, F.sqrt(F.greatest(mean(f"sum_{k}2", n) - mean(f"sum_{k}", n) ** 2, F.lit(0.0))))
    return s.select(
        r6(mean("sum_dist", n)).alias("mean_dist"), r6(std("dist")).alias("std_dist"), r6(mean("sum_side", n)).alias("mean_side"), r6(std("side")).alias("std_side"),
        r6(mean("n_classes", F.col("n_images"))).alias("mean_cls"), r6(mean("n_objects", F.col("n_images"))).alias("mean_obj"), F.col("n_images").alias("total_images"), n.alias("total_objects"),
    )


STATS = f"""WITH {OBSERVED}, pf AS (SELECT frame_id, sum(v) AS n_obj, count(DISTINCT CASE WHEN v = 1 THEN cls END) AS n_cls FROM obs GROUP BY frame_id),
 g AS (SELECT round(avg(dist), 6) AS mean_dist, round(stddev_pop(dist), 6) AS std_dist, round(avg(side), 6) AS mean_side, round(stddev_pop(side), 6) AS std_side FROM obs WHERE v = 1),
 h AS (SELECT round(avg(n_cls), 6) AS mean_cls, round(avg(n_obj), 6) AS mean_obj, count(*) AS total_images, CAST(sum(n_obj) AS BIGINT) AS total_objects FROM pf) SELECT * FROM g CROSS JOIN h"""


@query("agg_dataset_stats", STATS, "fx_frames", "fx_annotations")
def agg_dataset_stats(frames, annotations):
    """One pass: partials of the shards, merged."""
    return merge_partials(shard_partials(observations(frames, annotations)))


@query("agg_shard_partial", f"WITH {OBSERVED}, pf AS (SELECT shard_id, frame_id, sum(v) AS n_obj, count(DISTINCT CASE WHEN v = 1 THEN cls END) AS n_cls, coalesce(sum(CASE WHEN v = 1 THEN dist END), 0) AS d, coalesce(sum(CASE WHEN v = 1 THEN side END), 0) AS s FROM obs GROUP BY ALL) SELECT shard_id, count(*) AS n_images, CAST(sum(n_obj) AS BIGINT) AS n_objects, CAST(sum(n_cls) AS BIGINT) AS n_classes, round(sum(d), 6) + 0.0 AS sum_dist, round(sum(s), 9) + 0.0 AS sum_side FROM pf GROUP BY shard_id", "fx_frames", "fx_annotations")
def agg_shard_partial(frames, annotations):
    return shard_partials(observations(frames, annotations)).select("shard_id", "n_images", "n_objects", "n_classes", r6(F.col("sum_dist")).alias("sum_dist"), r6(F.col("sum_side"), 9).alias("sum_side"))


def fixed_histogram(values: DataFrame, column: str, low: float, high: float, bins: int) -> DataFrame:
    """bin (from 1), n: equal bins on [low, high], the last one closed; values outside are dropped and empty bins stay."""
    v = F.col(column)
    bucket = F.least(F.width_bucket(v, F.lit(low), F.lit(high), F.lit(bins)), F.lit(bins)).cast("int")
    counts = values.where(v.between(low, high)).groupBy(bucket.alias("bin")).agg(F.count("*").alias("n"))
    every = values.sparkSession.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"))
    return every.join(counts, "bin", "left").select("bin", F.coalesce("n", F.lit(0)).alias("n"))


def _fixed_sql(column: str, high: float, bins: int) -> str:
    bucket = f"CAST(least(floor({bins} * (({column} - 0.0e0) / ({high}e0 - 0.0e0))) + 1, {bins}) AS INT)"
    return f"SELECT b.bin, coalesce(n, 0) AS n FROM (SELECT CAST(unnest(range(1, {bins + 1})) AS INT) AS bin) b LEFT JOIN (SELECT {bucket} AS bin, count(*) AS n FROM obs WHERE v = 1 AND {column} BETWEEN 0 AND {high} GROUP BY 1) c ON b.bin = c.bin"


@query("agg_hist_fixed", f"WITH {OBSERVED} SELECT 'dist' AS what, * FROM ({_fixed_sql('dist', 1.5, 19)}) UNION ALL SELECT 'side' AS what, * FROM ({_fixed_sql('side', 1.0, 19)})", "fx_frames", "fx_annotations")
def agg_hist_fixed(frames, annotations):
    seen = observations(frames, annotations).where("seen")
    one = lambda c, high: fixed_histogram(seen, c, 0.0, high, 19).select(F.lit(c).alias("what"), "bin", "n")
    return one("dist", 1.5).union(one("side", 1.0))


#: Quantiles that a pass asks of the sketch of each window, the sketch's accuracy, and about how many values a window may hold to be counted one by one.
GRID, ACCURACY, COUNTED = 1000, 10_000, 100_000
#: Grid steps that are added on both sides of a rank, more than the sketch may be wrong by.
MARGIN = 3


def exact_quantiles(values: DataFrame, quantiles: tuple[float, ...]) -> dict[str, tuple[int, float, float, list[float]]]:
    """what -> (count, least, greatest, linearly interpolated quantiles) of the values (what, v), all of them at once.

    A pass sketches all windows in which a rank may lie (the first one: everything), and cuts each to less than a hundredth of its
    values, but for values that come often. As many passes are made as the count asks for; then a last one counts each distinct value in the
    windows. Windows are checked by exact counts; one that misses its rank is opened wider. Nulls don't count; a value that isn't
    finite is an error.
    """
    v, spark = F.col("v"), values.sparkSession
    finite = F.when(F.isnan("v") | (F.abs(v) == float("inf")), F.raise_error(F.lit("a value is not finite")).cast("double")).otherwise(v)
    values = values.where(v.isNotNull()).select("what", finite.alias("v"))
    grid = [k / GRID for k in range(GRID + 1)]
    first = {r["what"]: r for r in values.groupBy("what").agg(F.count("*").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"), F.percentile_approx("v", grid, ACCURACY).alias("grid")).collect()}
    rank = {(w, q): math.floor(q * (r["n"] - 1)) for w, r in first.items() for q in quantiles}
    margin = dict.fromkeys(rank, MARGIN)

    def cut(key: tuple[str, float], points: list[float], share: float) -> tuple[float, float]:
        return points[max(0, math.floor(share * GRID) - margin[key])], points[min(GRID, math.ceil(share * GRID) + margin[key])]

    def opened(key: tuple[str, float]) -> tuple[float, float]:
        return cut(key, first[key[0]]["grid"], rank[key] / first[key[0]]["n"])

    def in_windows(keys) -> DataFrame:
        rows = [(*k, *window[k]) for k in keys]  # a few
        return values.join(F.broadcast(spark.createDataFrame(rows, "what string, q double, lo double, hi double")), "what")

    window = {k: opened(k) for k in rank}
    left = max((r["n"] for r in first.values()), default=0) * 2 * (MARGIN + 1) / GRID
    while left > COUNTED:
        inside = v.between(F.col("lo"), F.col("hi"))
        sketch = F.percentile_approx(F.when(inside, v), grid, ACCURACY)
        for r in in_windows(rank).groupBy("what", "q").agg(F.count_if(v < F.col("lo")).alias("below"), F.count_if(inside).alias("inside"), sketch.alias("grid")).collect():
            key = (r["what"], r["q"])
            if r["below"] <= rank[key] and rank[key] + 1 < r["below"] + r["inside"]:
                window[key] = cut(key, r["grid"], (rank[key] - r["below"]) / r["inside"])
        left *= 2 * (MARGIN + 1) / GRID
    found: dict[tuple[str, float], float] = {}
    while missing := [k for k in rank if k not in found]:
        counts = in_windows(missing).where(v <= F.col("hi")).groupBy("what", "q", F.when(v >= F.col("lo"), v).alias("v")).agg(F.count("*").alias("n")).collect()
        for key in missing:
            own = {r["v"]: r["n"] for r in counts if (r["what"], r["q"]) == key}
            total, n = own.pop(None, 0), first[key[0]]["n"]
            wanted, picked = (rank[key], min(rank[key] + 1, n - 1)), []
            if total <= wanted[0]:
                for value in sorted(own):
                    total += own[value]
                    picked += [value] * sum(k < total for k in wanted[len(picked) :])
            if len(picked) == 2:
                found[key] = picked[0] + (picked[1] - picked[0]) * (key[1] * (n - 1) - rank[key])
            else:
                margin[key] *= 4
                window[key] = opened(key)
    return {w: (r["n"], r["low"], r["high"], [found[w, q] for q in quantiles]) for w, r in first.items()}


def auto_histograms(values: DataFrame, whole_numbers: tuple[str, ...] = ()) -> DataFrame:
    """what, bin (from 1), n with NumPy's "auto" width: the smaller of Freedman-Diaconis (not below half the square-root rule) and Sturges.

    values: what, v. Those named whole_numbers get bins of one at least. Without values there are no bins.
    """
    spark, shapes = values.sparkSession, []
    for what, (c, low, high, (lower, upper)) in exact_quantiles(values, (0.25, 0.75)).items():
        span = high - low
        width = min(max(2 * (upper - lower) * c ** (-1 / 3), span / math.sqrt(c) / 2), span / (math.log2(c) + 1))
        width = max(width, 1.0) if what in whole_numbers and width else width
        shapes.append((what, low, span or 1.0, math.ceil(span / width) if width else 1))
    shape = spark.createDataFrame(shapes, "what string, low double, span double, bins int")  # a row for each histogram
    bucket = F.least(F.floor((F.col("v") - F.col("low")) / F.col("span") * F.col("bins")) + 1, F.col("bins")).cast("int")
    counts = values.where("v IS NOT NULL").join(F.broadcast(shape), "what").groupBy("what", bucket.alias("bin")).agg(F.count("*").alias("n"))
    every = shape.select("what", F.explode(F.sequence(F.lit(1), F.col("bins"))).alias("bin"))
    return every.join(counts, ["what", "bin"], "left").select("what", "bin", F.coalesce("n", F.lit(0)).alias("n"))


def _auto_sql(name: str, source: str, whole: bool) -> str:
    floor = f"CASE WHEN w0 > 0 THEN greatest(w0, {1.0 if whole else 0.0}e0) ELSE 0 END"
    return f"""SELECT '{name}' AS what, b.bin, coalesce(n, 0) AS n FROM (WITH x AS ({source}), s AS (SELECT count(v) AS c, min(v) AS lo, max(v) AS hi, quantile_cont(v, 0.75) - quantile_cont(v, 0.25) AS iqr FROM x),
 w AS (SELECT lo, hi, {floor} AS width FROM (SELECT *, least(greatest(2 * iqr * pow(c, -1.0e0 / 3), (hi - lo) / sqrt(c) / 2), (hi - lo) / (log2(c) + 1)) AS w0 FROM s) t), p AS (SELECT lo, hi, CAST(CASE WHEN width > 0 THEN ceil((hi - lo) / width) ELSE 1 END AS INT) AS bins FROM w)
 SELECT b.bin, n FROM (SELECT CAST(unnest(range(1, bins + 1)) AS INT) AS bin FROM p) b LEFT JOIN (SELECT CAST(least(floor((v - lo) / CASE WHEN hi > lo THEN hi - lo ELSE 1 END * bins) + 1, bins) AS INT) AS bin, count(*) AS n FROM x, p GROUP BY 1) c ON b.bin = c.bin) b"""


_PER_FRAME = "SELECT CAST({} AS DOUBLE) AS v FROM pf"


@query("agg_hist_auto", f"WITH {OBSERVED}, pf AS (SELECT frame_id, sum(v) AS n_obj, count(DISTINCT CASE WHEN v = 1 THEN cls END) AS n_cls FROM obs GROUP BY frame_id) " + " UNION ALL ".join([_auto_sql("objects", _PER_FRAME.format("n_obj"), True), _auto_sql("classes", _PER_FRAME.format("n_cls"), True), _auto_sql("dist", "SELECT dist AS v FROM obs WHERE v = 1", False), _auto_sql("side", "SELECT side AS v FROM obs WHERE v = 1", False)]), "fx_frames", "fx_annotations")
def agg_hist_auto(frames, annotations):
    """Objects and classes of a frame, and distance and longest side of the seen objects."""
    observed = observations(frames, annotations)
    stacked = lambda *names: F.explode(F.array(*[F.struct(F.lit(what).alias("what"), F.col(c).cast("double").alias("v")) for what, c in names])).alias("x")
    each = per_frame(observed).select(stacked(("objects", "n_objects"), ("classes", "n_classes")))
    seen = observed.where("seen").select(stacked(("dist", "dist"), ("side", "side")))
    values = written(each.union(seen).select("x.what", "x.v"))
    return auto_histograms(values, ("objects", "classes"))


@query("agg_dataset_size", "SELECT CAST(sum(n) AS BIGINT) AS n_frames FROM (SELECT subset, max(frame_id) + 1 AS n FROM fx_frames GROUP BY subset) s", "fx_frames")
def agg_dataset_size(frames):
    return dataset_size(frames.groupBy("subset", "shard_id").agg(shard_name(F.min("frame_id"), F.max("frame_id")).alias("name")))


def shard_name(first: Column, last: Column) -> Column:
    """Six digits or more for each index."""
    index = lambda c: F.lpad(c.cast("string"), F.greatest(F.lit(6), F.length(c.cast("string"))), F.lit("0"))
    return F.concat(index(first), F.lit("_"), index(last), F.lit(".tfrecord"))


def dataset_size(shards: DataFrame) -> DataFrame:
    """n_frames of shards (subset, name) from their names alone: the last index of each subset, plus one, summed."""
    last = shards.groupBy("subset").agg(F.max(F.regexp_extract("name", r"_(\d+)\.tfrecord$", 1).cast("long")).alias("last"))
    return last.agg(F.sum(F.col("last") + 1).alias("n_frames"))


@query("agg_one_per_class", "SELECT cls, arg_max(struct_pack(f := frame_id, i := instance_index), (frame_id, instance_index)).f AS frame_id, arg_max(instance_index, (frame_id, instance_index)) AS instance_index FROM fx_annotations GROUP BY cls", "fx_annotations")
def agg_one_per_class(annotations):
    last = F.max(F.struct("frame_id", "instance_index"))
    return annotations.groupBy("cls").agg(last.alias("o")).select("cls", "o.frame_id", "o.instance_index")


@query("agg_max_diameter", "SELECT frame_id, round(max(greatest(x2 - x1, y2 - y1) / 640.0e0), 9) + 0.0 AS diameter FROM fx_annotations GROUP BY frame_id", "fx_annotations")
def agg_max_diameter(annotations):
    return annotations.groupBy("frame_id").agg(r6(F.max(F.greatest(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")) / 640.0), 9).alias("diameter"))
