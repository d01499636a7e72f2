"""Pose and camera geometry as Column functions.

Vectors are tuples of Columns (x, y, z), quaternions (x, y, z, w), matrices nine Columns row by row. Nothing here is
a UDF, so the expressions stay inside Spark's generated code.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

Vector = tuple[Column, ...]


def cols(*names: str) -> Vector:
    return tuple(F.col(n) for n in names)


def norm(v: Vector) -> Column:
    total = v[0] * v[0]
    for c in v[1:]:
        total = total + c * c
    return F.sqrt(total)


def subtract(a: Vector, b: Vector) -> Vector:
    return tuple(x - y for x, y in zip(a, b))


def quat_multiply(p: Vector, q: Vector) -> Vector:
    """p after q."""
    px, py, pz, pw = p
    qx, qy, qz, qw = q
    return (pw * qx + px * qw + py * qz - pz * qy, pw * qy - px * qz + py * qw + pz * qx, pw * qz + px * qy - py * qx + pz * qw, pw * qw - px * qx - py * qy - pz * qz)


def quat_conjugate(q: Vector) -> Vector:
    return (-q[0], -q[1], -q[2], q[3])


def quat_to_matrix(q: Vector) -> Vector:
    """Rotation matrix of a unit quaternion, which is not normalised here."""
    x, y, z, w = q
    return (
        1 - 2 * (y * y + z * z), 2 * (x * y - z * w), 2 * (x * z + y * w),
        2 * (x * y + z * w), 1 - 2 * (x * x + z * z), 2 * (y * z - x * w),
        2 * (x * z - y * w), 2 * (y * z + x * w), 1 - 2 * (x * x + y * y),
    )


def matrix_times(m: Vector, v: Vector) -> Vector:
    return tuple(m[3 * r] * v[0] + m[3 * r + 1] * v[1] + m[3 * r + 2] * v[2] for r in range(3))


def transposed_times(m: Vector, v: Vector) -> Vector:
    return tuple(m[r] * v[0] + m[3 + r] * v[1] + m[6 + r] * v[2] for r in range(3))


def quat_rotate(q: Vector, v: Vector) -> Vector:
    return matrix_times(quat_to_matrix(q), v)


def matrix_to_quat(m: Vector) -> Vector:
    """Unit quaternion of a rotation matrix by the largest of the trace and the diagonal (Markley, 2008)."""
    trace = m[0] + m[4] + m[8]
    top = F.greatest(m[0], m[4], m[8], trace)
    raw = []
    by_trace = (m[7] - m[5], m[2] - m[6], m[3] - m[1], 1 + trace)
    by_x = (1 - trace + 2 * m[0], m[3] + m[1], m[6] + m[2], m[7] - m[5])
    by_y = (m[3] + m[1], 1 - trace + 2 * m[4], m[7] + m[5], m[2] - m[6])
    by_z = (m[6] + m[2], m[7] + m[5], 1 - trace + 2 * m[8], m[3] - m[1])
    for k in range(4):
        raw.append(F.when(top == trace, by_trace[k]).when(top == m[0], by_x[k]).when(top == m[4], by_y[k]).otherwise(by_z[k]))
    n = norm(tuple(raw))
    return tuple(r / n for r in raw)


def quat_to_rotvec(q: Vector) -> Vector:
    """Axis times angle; zero for no rotation. The angle is at most pi."""
    sign = F.when(q[3] < 0, F.lit(-1.0)).otherwise(F.lit(1.0))
    n = norm(q[:3])
    factor = F.when(n < 1e-12, F.lit(2.0)).otherwise(2 * F.atan2(n, sign * q[3]) / n)
    return tuple(sign * factor * c for c in q[:3])


def object_in_camera(position: Vector, camera: Vector, camera_rotation: Vector) -> Vector:
    """A world position in the camera's frame."""
    return transposed_times(quat_to_matrix(camera_rotation), subtract(position, camera))


def object_rotation_in_camera(rotation: Vector, camera_rotation: Vector) -> Vector:
    """The quaternion of a world rotation in the camera's frame: the camera's inverse after it."""
    return quat_multiply(quat_conjugate(camera_rotation), rotation)


def project(p: Vector, fx: Column, fy: Column, cx: Column, cy: Column) -> Vector:
    """Image point of a position in the camera's frame; null behind the camera."""
    return (F.when(p[2] > 0, fx * p[0] / p[2] + cx), F.when(p[2] > 0, fy * p[1] / p[2] + cy))


def longest_side(x1: Column, y1: Column, x2: Column, y2: Column, w: Column, h: Column) -> Column:
    return F.greatest((x2 - x1) / w.cast("double"), (y2 - y1) / h.cast("double"))


def intrinsics_from_lens(f_mm: Column, sensor_mm: Column, shift_x: Column, shift_y: Column, w: Column, h: Column) -> Vector:
    """(fx, fy, cx, cy). Signs of the shifts are those of lens_from_intrinsics, so that the two undo each other."""
    fx = f_mm / sensor_mm * w
    return fx, fx, w * (0.5 + shift_x), h * (0.5 - shift_y)


def lens_from_intrinsics(fx: Column, cx: Column, cy: Column, sensor_mm: Column, w: Column, h: Column) -> Vector:
    """(f_mm, shift_x, shift_y); the sensor's width is fixed, and y points downwards in the image."""
    return fx * sensor_mm / w, cx / w - 0.5, 0.5 - cy / h


def field_of_view(fx: Column, w: Column, h: Column) -> Vector:
    """(horizontal, vertical) in radians."""
    hfov = 2 * F.atan(w / (2 * fx))
    return hfov, hfov * h / w


def look_at(p: Vector, target: Vector) -> Vector:
    """Quaternion whose z axis points from p to target, with the world's z upwards."""
    d = subtract(p, target)
    yaw = F.atan2(d[1], d[0]) + F.lit(3.141592653589793 / 2)
    pitch = F.lit(-3.141592653589793 / 2) - F.atan2(d[2], F.sqrt(d[0] * d[0] + d[1] * d[1]))
    zero = F.lit(0.0)
    about_z = (zero, zero, F.sin(yaw / 2), F.cos(yaw / 2))
    about_x = (F.sin(pitch / 2), zero, zero, F.cos(pitch / 2))
    return quat_multiply(about_z, about_x)


def ray_ground(start: Vector, direction: Vector) -> Vector:
    """x and y where a ray meets z = 0; null if it runs along the ground."""
    t = F.when(direction[2] != 0, -start[2] / direction[2])
    return start[0] + t * direction[0], start[1] + t * direction[1]


def fill_distance(diameter: Column, fill: Column, fov: Column) -> Column:
    """Distance at which an object fills a share of the view."""
    return diameter / F.tan(fill * fov * 2)
