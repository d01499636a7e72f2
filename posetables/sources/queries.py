"""Queries over what they write first: record files, and statistics kept of shards."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators.aggregates import STATS, observations, pack_frames
from ..operators.windows import PLACED
from ..queries import query
from ..storage import mounted, shared_folder
from .records import read_records, write_records
from .stats import StatsStore

DIVISOR = 70
_OBJECTS = ["obj_id", "cls", "pos_x", "pos_y", "pos_z", "x1", "y1", "x2", "y2"]


@query("src_tfrecord_v2", f"""WITH {PLACED} SELECT format('{{:06d}}_{{:06d}}', lo, hi) AS shard, CAST(row_number() OVER (PARTITION BY lo ORDER BY frame_id) - 1 AS INT) AS position, n_objects, classes, boxes, sum_x, cam_y, fx
 FROM (SELECT f.frame_id, min(f.frame_id) OVER (PARTITION BY shard) AS lo, max(f.frame_id) OVER (PARTITION BY shard) AS hi, cam_y, fx FROM fx_frames f JOIN placed p ON f.frame_id = p.frame_id) a
 LEFT JOIN (SELECT frame_id, count(*) AS n_objects, string_agg(cls, ',' ORDER BY instance_index) AS classes, string_agg(concat_ws(' ', x1, y1, x2, y2), ',' ORDER BY instance_index) AS boxes, round(sum(pos_x), 6) + 0.0 AS sum_x FROM fx_annotations GROUP BY frame_id) o USING (frame_id)""", "fx_frames", "fx_annotations")
def src_tfrecord_v2(frames, annotations):
    """Frames and their objects, written as record files and read again."""
    spark = frames.sparkSession
    real = lambda c: F.col(c).cast("float")
    zero, one = F.lit(0.0).cast("float"), F.lit(1.0).cast("float")
    table = lambda *names: F.transform(F.arrays_zip(*names), lambda o: F.array(*[o[n] for n in names]))
    packed = pack_frames(annotations, _OBJECTS).select(
        "frame_id", F.col("obj_id").alias("obj_ids"), F.col("cls").alias("obj_classes"), table("pos_x", "pos_y", "pos_z").cast("array<array<float>>").alias("obj_pos"), table("x1", "y1", "x2", "y2").alias("obj_bbox_visib")
    )
    camera = frames.select(
        "frame_id", F.array(F.array(real("fx"), zero, real("cx")), F.array(zero, real("fy"), real("cy")), F.array(zero, zero, one)).alias("cam_matrix"),
        F.array(*map(real, ("cam_x", "cam_y", "cam_z"))).alias("cam_location"), F.array(*map(real, ("cam_qx", "cam_qy", "cam_qz", "cam_qw"))).alias("cam_rotation"),
    )
    root = mounted(f"{shared_folder(spark)}/records-{uuid.uuid4().hex}")
    write_records(camera.join(packed, "frame_id", "left").withColumnRenamed("frame_id", "frame_index"), root, DIVISOR)
    back = read_records(spark, root, ["cam_matrix", "cam_location", "obj_classes", "obj_pos", "obj_bbox_visib"])
    has = F.col("obj_classes").isNotNull()
    x = F.aggregate("obj_pos", F.lit(0.0), lambda total, p: total + p[0])
    return back.select(
        "shard", "position", F.when(has, F.size("obj_classes").cast("long")).alias("n_objects"), F.array_join("obj_classes", ",").alias("classes"),
        F.array_join(F.transform("obj_bbox_visib", lambda b: F.array_join(b.cast("array<string>"), " ")), ",").alias("boxes"),
        (F.round(x, 6) + F.lit(0.0)).alias("sum_x"), F.col("cam_location")[1].cast("double").alias("cam_y"), F.col("cam_matrix")[0][0].cast("double").alias("fx"),
    )


@query("agg_incremental", STATS, "fx_frames", "fx_annotations")
def agg_incremental(frames, annotations):
    """A part of the shards is kept, some of them incomplete; a later run computes what is new or has changed, and merges all."""
    observed, store = observations(frames, annotations), StatsStore(frames.sparkSession, f"{shared_folder(frames.sparkSession)}/partials-{uuid.uuid4().hex}")
    store.update(observed.where("shard_id % 3 <> 0 AND (shard_id % 5 <> 0 OR frame_id % 2 = 0)"))
    store.update(observed)
    return store.summary()
