"""Queries over the geometry functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..queries import query, r6
from . import geometry as g
from .geometry import cols

Q, V = ("qx", "qy", "qz", "qw"), ("vx", "vy", "vz")
M = "1 - 2*(qy*qy + qz*qz) AS m0, 2*(qx*qy - qz*qw) AS m1, 2*(qx*qz + qy*qw) AS m2, 2*(qx*qy + qz*qw) AS m3, 1 - 2*(qx*qx + qz*qz) AS m4, 2*(qy*qz - qx*qw) AS m5, 2*(qx*qz - qy*qw) AS m6, 2*(qy*qz + qx*qw) AS m7, 1 - 2*(qx*qx + qy*qy) AS m8"
MATRICES = f"mm AS (SELECT vec_id, {M}, vx, vy, vz FROM fx_quats)"
#: Sign of a rotation matrix's quaternion follows its largest component; it is that of q with the largest one positive.
UNSIGNED = "uq AS (SELECT vec_id, qx*s AS qx, qy*s AS qy, qz*s AS qz, qw*s AS qw FROM (SELECT *, CASE WHEN (CASE greatest(abs(qx), abs(qy), abs(qz), abs(qw)) WHEN abs(qw) THEN qw WHEN abs(qx) THEN qx WHEN abs(qy) THEN qy ELSE qz END) < 0 THEN -1.0e0 ELSE 1.0e0 END AS s FROM fx_quats) t)"
IN_CAMERA = """rel AS (SELECT f.frame_id, a.instance_index, f.fx, f.fy, f.cx, f.cy, pos_x - cam_x AS dx, pos_y - cam_y AS dy, pos_z - cam_z AS dz, cam_qx AS qx, cam_qy AS qy, cam_qz AS qz, cam_qw AS qw, sin(0.39269908169872414e0 * (class_id % 8)) AS sz, cos(0.39269908169872414e0 * (class_id % 8)) AS sw FROM fx_frames f JOIN fx_annotations a ON a.frame_id = f.frame_id),
 cam AS (SELECT frame_id, instance_index, fx, fy, cx, cy, 1 - 2*sz*sz AS w0, -2*sz*sw AS w1, m0, m1, m2, m3, m4, m5, m6, m7, m8, sz, sw, qx, qy, qz, qw, m0*dx + m3*dy + m6*dz AS tx, m1*dx + m4*dy + m7*dz AS ty, m2*dx + m5*dy + m8*dz AS tz FROM (SELECT *, """ + M + " FROM rel) r)"


def _rounded(**columns) -> list:
    return [r6(c).alias(n) for n, c in columns.items()]


def _round_sql(**columns) -> str:
    return ", ".join(f"round({c}, 6) + 0.0 AS {n}" for n, c in columns.items())


@query("geo_quat_to_matrix", f"WITH {MATRICES} SELECT vec_id, {_round_sql(**{f'r{i}': f'm{i}' for i in range(9)})} FROM mm", "fx_quats")
def geo_quat_to_matrix(quats):
    return quats.select("vec_id", *_rounded(**{f"r{i}": c for i, c in enumerate(g.quat_to_matrix(cols(*Q)))}))


def _with_matrix(quats):
    return quats.select("vec_id", *[c.alias(f"m{i}") for i, c in enumerate(g.quat_to_matrix(cols(*Q)))])


@query("geo_matrix_to_quat", f"WITH {UNSIGNED} SELECT vec_id, {_round_sql(x='qx', y='qy', z='qz', w='qw')} FROM uq", "fx_quats")
def geo_matrix_to_quat(quats):
    return _with_matrix(quats).select("vec_id", *_rounded(**dict(zip("xyzw", g.matrix_to_quat(cols(*[f"m{i}" for i in range(9)]))))))


@query("geo_matrix_to_rotvec", "WITH n AS (SELECT *, CASE WHEN qw < 0 THEN -1.0e0 ELSE 1.0e0 END AS s, sqrt(qx*qx + qy*qy + qz*qz) AS l FROM fx_quats), f AS (SELECT *, s * CASE WHEN l < 1e-12 THEN 2.0e0 ELSE 2 * atan2(l, s * qw) / l END AS k FROM n) SELECT vec_id, " + _round_sql(rx="k*qx", ry="k*qy", rz="k*qz") + " FROM f", "fx_quats")
def geo_matrix_to_rotvec(quats):
    q = _with_matrix(quats).select("vec_id", *[c.alias(n) for c, n in zip(g.matrix_to_quat(cols(*[f"m{i}" for i in range(9)])), Q)])
    return q.select("vec_id", *_rounded(**dict(zip(("rx", "ry", "rz"), g.quat_to_rotvec(cols(*Q))))))


@query("geo_quat_multiply", "WITH r AS (SELECT *, sqrt(0.5e0) AS h FROM fx_quats) SELECT vec_id, " + _round_sql(lx="h*qx + h*qy", ly="h*qy - h*qx", lz="h*qz + h*qw", lw="h*qw - h*qz", gx="h*qx - h*qy", gy="h*qy + h*qx", gz="h*qz + h*qw", gw="h*qw - h*qz") + " FROM r", "fx_quats")
def geo_quat_multiply(quats):
    """A quarter turn about z as a local offset (q r) and as a global one (r q)."""
    h, q = F.sqrt(F.lit(0.5)), cols(*Q)
    turn = (F.lit(0.0), F.lit(0.0), h, h)
    return quats.select("vec_id", *_rounded(**dict(zip(("lx", "ly", "lz", "lw"), g.quat_multiply(q, turn)))), *_rounded(**dict(zip(("gx", "gy", "gz", "gw"), g.quat_multiply(turn, q)))))


@query("geo_quat_rotate", f"WITH {MATRICES} SELECT vec_id, {_round_sql(x='m0*vx + m1*vy + m2*vz', y='m3*vx + m4*vy + m5*vz', z='m6*vx + m7*vy + m8*vz')} FROM mm", "fx_quats")
def geo_quat_rotate(quats):
    return quats.select("vec_id", *_rounded(**dict(zip("xyz", g.quat_rotate(cols(*Q), cols(*V))))))


def in_camera(frames, annotations):
    """Each object's position t and rotation o in its camera's frame; objects are turned about z by eighths, by their class."""
    half = F.lit(0.39269908169872414) * (F.col("class_id") % 8)
    both = frames.join(annotations, "frame_id").withColumns({"sz": F.sin(half), "sw": F.cos(half)})
    t = g.object_in_camera(cols("pos_x", "pos_y", "pos_z"), cols("cam_x", "cam_y", "cam_z"), cols("cam_qx", "cam_qy", "cam_qz", "cam_qw"))
    o = g.object_rotation_in_camera((F.lit(0.0), F.lit(0.0), F.col("sz"), F.col("sw")), cols("cam_qx", "cam_qy", "cam_qz", "cam_qw"))
    return both.select("frame_id", "instance_index", "fx", "fy", "cx", "cy", *[c.alias(n) for n, c in zip(("tx", "ty", "tz", "ox", "oy", "oz", "ow"), (*t, *o))])


@query("geo_object_in_camera", f"WITH {IN_CAMERA} SELECT frame_id, instance_index, {_round_sql(tx='tx', ty='ty', tz='tz', ox='-qx*sw - qy*sz', oy='-qy*sw + qx*sz', oz='qw*sz - qz*sw', ow='qw*sw + qz*sz')} FROM cam", "fx_frames", "fx_annotations")
def geo_object_in_camera(frames, annotations):
    """Position and rotation of each object in its camera's frame."""
    return in_camera(frames, annotations).select("frame_id", "instance_index", *_rounded(**{n: F.col(n) for n in ("tx", "ty", "tz", "ox", "oy", "oz", "ow")}))


#: Length of the drawn axes, in metres. Fixed value.
AXIS = 0.05
_TIPS = {f"{n}{k}": (f"tx + {AXIS}e0 * ({x})", f"ty + {AXIS}e0 * ({y})", f"tz + {AXIS}e0 * ({z})") for k, (x, y, z) in {
    "x": ("m0*w0 - m3*w1", "m1*w0 - m4*w1", "m2*w0 - m5*w1"), "y": ("m0*w1 + m3*w0", "m1*w1 + m4*w0", "m2*w1 + m5*w0"), "z": ("m6", "m7", "m8"),
}.items() for n in ("tip_",)}


def _tips_sql() -> str:
    return ", ".join(f"CASE WHEN {z} > 0.001e0 THEN round(fx*({x})/({z}) + cx, 5) + 0.0 END AS {n}_u, CASE WHEN {z} > 0.001e0 THEN round(fy*({y})/({z}) + cy, 5) + 0.0 END AS {n}_v" for n, (x, y, z) in _TIPS.items())


@query("geo_project", f"WITH {IN_CAMERA} SELECT frame_id, instance_index, CASE WHEN tz > 0.001e0 THEN round(fx*tx/tz + cx, 5) + 0.0 END AS u, CASE WHEN tz > 0.001e0 THEN round(fy*ty/tz + cy, 5) + 0.0 END AS v, {_tips_sql()} FROM cam", "fx_frames", "fx_annotations")
def geo_project(frames, annotations):
    """Image points of an object's centre and of the tips of its axes, to five digits; null within 1 mm of the image plane."""
    m = g.quat_to_matrix(cols("ox", "oy", "oz", "ow"))
    points = {"": cols("tx", "ty", "tz")} | {f"tip_{k}_": tuple(F.col(t) + AXIS * m[3 * r + c] for r, t in enumerate(("tx", "ty", "tz"))) for c, k in enumerate("xyz")}
    out = []
    for name, p in points.items():
        for axis, image in zip("uv", g.project(p, *cols("fx", "fy", "cx", "cy"))):
            out.append(F.when(p[2] > 0.001, F.round(image, 5) + 0.0).alias(f"{name}{axis}"))
    return in_camera(frames, annotations).select("frame_id", "instance_index", *out)


@query("geo_dist_to_camera", f"WITH {IN_CAMERA} SELECT frame_id, instance_index, round(sqrt(dx*dx + dy*dy + dz*dz), 6) AS dist FROM rel", "fx_frames", "fx_annotations")
def geo_dist_to_camera(frames, annotations):
    dist = g.norm(g.subtract(cols("pos_x", "pos_y", "pos_z"), cols("cam_x", "cam_y", "cam_z")))
    return frames.join(annotations, "frame_id").select("frame_id", "instance_index", r6(dist).alias("dist"))


@query("geo_longest_side", "SELECT a.frame_id, instance_index, round(greatest((x2 - x1) / 640.0e0, (y2 - y1) / 480.0e0), 9) + 0.0 AS side FROM fx_annotations a JOIN fx_frames f ON f.frame_id = a.frame_id", "fx_frames", "fx_annotations")
def geo_longest_side(frames, annotations):
    return frames.join(annotations, "frame_id").select("frame_id", "instance_index", r6(g.longest_side(*cols("x1", "y1", "x2", "y2", "img_w", "img_h")), 9).alias("side"))


_LENS = "36.0e0 AS sensor, fx * 36.0e0 / img_w AS f, cam_x / 10 AS sx, cam_y / 10 AS sy"


@query("geo_intrinsics_from_lens", f"SELECT frame_id, {_round_sql(kfx='f * (img_w / sensor)', kfy='f * (img_h / (sensor / img_w * img_h))', kcx='img_w * 0.5e0 + img_w * sx', kcy='img_h * 0.5e0 - img_h * sy')} FROM (SELECT *, {_LENS} FROM fx_frames) f", "fx_frames")
def geo_intrinsics_from_lens(frames):
    """Intrinsics of a lens for each camera, whose shifts come from its place."""
    lens = frames.withColumns({"f": F.col("fx") * 36.0 / F.col("img_w"), "sx": F.col("cam_x") / 10, "sy": F.col("cam_y") / 10})
    fx, fy, cx, cy = g.intrinsics_from_lens(F.col("f"), F.lit(36.0), *cols("sx", "sy", "img_w", "img_h"))
    return lens.select("frame_id", *_rounded(kfx=fx, kfy=fy, kcx=cx, kcy=cy))


@query("geo_lens_from_intrinsics", "SELECT frame_id, " + _round_sql(f_mm="fx / (img_w / 36.0e0)", shift_x="cx / img_w - 0.5e0", shift_y="0.5e0 - cy / img_h") + " FROM fx_frames", "fx_frames")
def geo_lens_from_intrinsics(frames):
    f, sx, sy = g.lens_from_intrinsics(*cols("fx", "cx", "cy"), F.lit(36.0), *cols("img_w", "img_h"))
    return frames.select("frame_id", *_rounded(f_mm=f, shift_x=sx, shift_y=sy))


@query("geo_fov", "SELECT frame_id, " + _round_sql(hfov="2 * atan(img_w / (2 * fx))", vfov="2 * atan(img_w / (2 * fx)) * img_h / img_w", half="tan(atan(img_w / (2 * fx)))") + " FROM fx_frames", "fx_frames")
def geo_fov(frames):
    h, v = g.field_of_view(*cols("fx", "img_w", "img_h"))
    return frames.select("frame_id", *_rounded(hfov=h, vfov=v, half=F.tan(h / 2)))


@query("geo_look_at", "WITH a AS (SELECT vec_id, atan2(vy, vx) + pi() / 2 AS yaw, -pi() / 2 - atan2(vz, sqrt(vx*vx + vy*vy)) AS pitch FROM fx_quats) SELECT vec_id, " + _round_sql(x="cos(yaw/2) * sin(pitch/2)", y="sin(yaw/2) * sin(pitch/2)", z="sin(yaw/2) * cos(pitch/2)", w="cos(yaw/2) * cos(pitch/2)") + " FROM a", "fx_quats")
def geo_look_at(quats):
    zero = (F.lit(0.0),) * 3
    return quats.select("vec_id", *_rounded(**dict(zip("xyzw", g.look_at(cols(*V), zero)))))


@query("geo_ray_ground", "SELECT vec_id, " + _round_sql(x="CASE WHEN abs(vz) > 0.001e0 THEN qx - (qz + 2) / vz * vx END", y="CASE WHEN abs(vz) > 0.001e0 THEN qy - (qz + 2) / vz * vy END") + " FROM fx_quats", "fx_quats")
def geo_ray_ground(quats):
    start = (F.col("qx"), F.col("qy"), F.col("qz") + 2)
    steep = quats.withColumn("vz", F.when(F.abs("vz") > 0.001, F.col("vz")))
    return steep.select("vec_id", *_rounded(**dict(zip("xy", g.ray_ground(start, cols(*V))))))


@query("geo_fill_distance", "SELECT frame_id, " + _round_sql(distance="max(greatest(x2 - x1, y2 - y1) / 640.0e0) / tan(0.2e0 * 2 * atan(any_value(img_w) / (2 * any_value(fx))) * 2)") + " FROM fx_frames f JOIN fx_annotations a USING (frame_id) GROUP BY frame_id", "fx_frames", "fx_annotations")
def geo_fill_distance(frames, annotations):
    largest = annotations.groupBy("frame_id").agg(F.max(F.greatest(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")) / 640.0).alias("d"))
    hfov, _ = g.field_of_view(*cols("fx", "img_w", "img_h"))
    return frames.join(largest, "frame_id").select("frame_id", r6(g.fill_distance(F.col("d"), F.lit(0.2), hfov)).alias("distance"))
