"""Rotations and rigid poses as Column expressions.

A vector or matrix is an array<double> column: positions of 3, quaternions x, y, z, w, 3x3 matrices of 9 by rows. All is
computed in double; sinks cast to float. What is a sum of products is one array of scalar expressions, which the planner
compiles and whose common parts it computes once; ``bind`` keeps longer chains small, at the price of an interpreted step. Values at the edge of a domain (arc sine just beyond 1)
are clamped; a zero-length basis vector of a 6-D rotation, or a zero quaternion, gives NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

AXES = {"X": 0, "Y": 1, "Z": 2}
IDENTITY6 = (1.0, 0.0, 0.0, 0.0, 1.0, 0.0)


def parts(v: Column, n: int) -> list[Column]:
    return [F.get(v, F.lit(i)) for i in range(n)]


def vec(values) -> Column:
    return F.array(*[x if isinstance(x, Column) else F.lit(float(x)) for x in values])


def bind(value: Column, body) -> Column:
    """body(value) with value computed once."""
    return F.transform(F.array(value), body)[0]


def dot(a, b) -> Column:
    out = a[0] * b[0]
    for x, y in zip(a[1:], b[1:]):
        out = out + x * y
    return out


def matmul(a: Column, b: Column, transpose_a: bool = False, transpose_b: bool = False) -> Column:
    x, y = parts(a, 9), parts(b, 9)
    row = (lambda i: [x[i], x[3 + i], x[6 + i]]) if transpose_a else (lambda i: x[3 * i : 3 * i + 3])
    col = (lambda j: y[3 * j : 3 * j + 3]) if transpose_b else (lambda j: [y[j], y[3 + j], y[6 + j]])
    return vec(dot(row(i), col(j)) for i in range(3) for j in range(3))


def matvec(m: Column, v: Column, transpose: bool = False) -> Column:
    x, y = parts(m, 9), parts(v, 3)
    return vec(dot([x[i], x[3 + i], x[6 + i]] if transpose else x[3 * i : 3 * i + 3], y) for i in range(3))


def transpose(m: Column) -> Column:
    x = parts(m, 9)
    return vec(x[3 * j + i] for i in range(3) for j in range(3))


def trace(m: Column) -> Column:
    x = parts(m, 9)
    return x[0] + x[4] + x[8]


def det(m: Column) -> Column:
    a, b, c, d, e, f, g, h, i = parts(m, 9)
    return a * (e * i - f * h) - b * (d * i - f * g) + c * (d * h - e * g)


def norm(v: Column, n: int) -> Column:
    x = parts(v, n)
    return F.sqrt(dot(x, x))


def _clamp(x: Column) -> Column:
    return F.greatest(F.least(x, F.lit(1.0)), F.lit(-1.0))


def _elementary(axis: str, angle: Column) -> list[list]:
    """Rotation about one axis: entries are columns, or the numbers 0 and 1."""
    c, s = F.cos(angle), F.sin(angle)
    return {"X": [[1, 0, 0], [0, c, -s], [0, s, c]], "Y": [[c, 0, s], [0, 1, 0], [-s, 0, c]], "Z": [[c, -s, 0], [s, c, 0], [0, 0, 1]]}[axis]


def _product(a: list[list], b: list[list]) -> list[list]:
    """Without the terms that are 0 and the factors that are 1."""

    def entry(i: int, j: int):
        out = None
        for k in range(3):
            x, y = a[i][k], b[k][j]
            if isinstance(x, int) and x == 0 or isinstance(y, int) and y == 0:
                continue
            term = y if isinstance(x, int) else x if isinstance(y, int) else x * y
            out = term if out is None else out + term
        return 0 if out is None else out

    return [[entry(i, j) for j in range(3)] for i in range(3)]


def elementary(axis: str, angle: Column) -> Column:
    """Rotation about one axis."""
    return vec(x for row in _elementary(axis, angle) for x in row)


def euler_to_matrix(angles: Column, convention: str = "XYZ") -> Column:
    """Intrinsic rotation about the three axes in turn."""
    a, b, c = (_elementary(axis, angle) for axis, angle in zip(convention, parts(angles, 3)))
    return vec(x for row in _product(_product(a, b), c) for x in row)


def matrix_to_euler(m: Column, convention: str = "XYZ") -> Column:
    """Angles of ``convention``: three axes that differ (central angle by arc sine) or repeat (by arc cosine)."""
    i, j, k = (AXES[c] for c in convention)
    at = lambda r, c: F.get(m, F.lit(3 * r + c))
    even = (j - i) % 3 == 1
    if i != k:
        sign = 1.0 if even else -1.0
        first = F.atan2(-sign * at(j, k), at(k, k))
        central = F.asin(_clamp(sign * at(i, k)))
        last = F.atan2(-sign * at(i, j), at(i, i))
    else:
        other = 3 - i - j
        sign = 1.0 if even else -1.0
        first = F.atan2(at(j, i), -sign * at(other, i))
        central = F.acos(_clamp(at(i, i)))
        last = F.atan2(at(i, j), sign * at(i, other))
    return F.array(first, central, last)


def quaternion_to_matrix(q: Column) -> Column:
    """Of any non-zero quaternion, scalar last."""
    i, j, k, r = parts(q, 4)
    s = F.try_divide(F.lit(2.0), dot([i, j, k, r], [i, j, k, r]))
    flat = vec(
        (1 - s * (j * j + k * k), s * (i * j - k * r), s * (i * k + j * r), s * (i * j + k * r), 1 - s * (i * i + k * k), s * (j * k - i * r), s * (i * k - j * r), s * (j * k + i * r), 1 - s * (i * i + j * j))
    )
    return F.when(s.isNotNull(), flat)


def matrix_to_quaternion(m: Column) -> Column:
    """Scalar last and not negative. At a half turn a component whose sign can't be told is 0. NULL of NULL."""
    x = parts(m, 9)
    root = lambda v: F.sqrt(F.greatest(v, F.lit(0.0))) / 2.0
    w = root(1.0 + x[0] + x[4] + x[8])
    i = root(1.0 + x[0] - x[4] - x[8]) * F.signum(x[7] - x[5])
    j = root(1.0 - x[0] + x[4] - x[8]) * F.signum(x[2] - x[6])
    k = root(1.0 - x[0] - x[4] + x[8]) * F.signum(x[3] - x[1])
    return F.when(m.isNotNull(), F.array(i, j, k, w))


def axis_angle_to_matrix(v: Column) -> Column:
    """Of a rotation vector, by Rodrigues' formula; the zero vector gives the identity."""

    def turn(angle: Column) -> Column:
        x, y, z = (c / F.greatest(angle, F.lit(1e-8)) for c in parts(v, 3))
        s, c = F.sin(angle), F.cos(angle)
        d = 1.0 - c
        return vec((c + x * x * d, x * y * d - z * s, x * z * d + y * s, y * x * d + z * s, c + y * y * d, y * z * d - x * s, z * x * d - y * s, z * y * d + x * s, c + z * z * d))

    return bind(norm(v, 3), turn)


def matrix_to_axis_angle(m: Column) -> Column:
    def back(q: Column) -> Column:
        half = norm(q, 3)
        scale = F.when(half < 1e-8, F.lit(2.0)).otherwise(2.0 * F.atan2(half, F.get(q, F.lit(3))) / F.greatest(half, F.lit(1e-8)))
        return vec(c * scale for c in parts(q, 3))

    return bind(matrix_to_quaternion(m), back)


def _basis(v: Column) -> Column:
    """(unit a, unit b less its part along a, their cross product), of a and b one after the other."""
    a, b = parts(v, 6)[:3], parts(v, 6)[3:]
    unit = lambda u: bind(F.sqrt(dot(u, u)), lambda n: F.when(n > 0, vec(c / n for c in u)))

    def second(e: Column) -> Column:
        e1 = parts(e, 3)
        along = dot(e1, b)
        return bind(unit([y - along * x for x, y in zip(e1, b)]), lambda g: third(e1, g))

    def third(e1, g: Column) -> Column:
        e2 = parts(g, 3)
        cross = [e1[1] * e2[2] - e1[2] * e2[1], e1[2] * e2[0] - e1[0] * e2[2], e1[0] * e2[1] - e1[1] * e2[0]]
        return F.when(g.isNotNull(), vec([*e1, *e2, *cross]))

    return bind(unit(a), second)


def rotation_6d_to_matrix(v: Column) -> Column:
    """The two vectors are the first two columns."""
    return bind(_basis(v), lambda m: F.when(m.isNotNull(), transpose(m)))


def matrix_to_rotation_6d(m: Column) -> Column:
    x = parts(m, 9)
    return F.array(x[0], x[3], x[6], x[1], x[4], x[7])


def rot6d_rows_to_matrix(v: Column) -> Column:
    """The other convention: the two vectors are the first two rows."""
    return _basis(v)


def matrix_to_rot6d_rows(m: Column) -> Column:
    return F.slice(m, 1, 6)


def rpy_to_matrix(rpy: Column, extrinsic: bool = False) -> Column:
    """Roll, pitch, yaw: intrinsic XYZ, or about the fixed axes (Rz Ry Rx)."""
    return euler_to_matrix(F.reverse(rpy), "ZYX") if extrinsic else euler_to_matrix(rpy, "XYZ")


def matrix_to_rpy(m: Column, extrinsic: bool = False) -> Column:
    return F.reverse(matrix_to_euler(m, "ZYX")) if extrinsic else matrix_to_euler(m, "XYZ")


_TO = {"quaternion": quaternion_to_matrix, "rotation_6d": rotation_6d_to_matrix, "axis_angle": axis_angle_to_matrix, "rot6d_rows": rot6d_rows_to_matrix, "matrix": lambda m: m}
_FROM = {"quaternion": matrix_to_quaternion, "rotation_6d": matrix_to_rotation_6d, "axis_angle": matrix_to_axis_angle, "rot6d_rows": matrix_to_rot6d_rows, "matrix": lambda m: m}
REPRESENTATIONS = ("matrix", "euler", "quaternion", "rotation_6d", "axis_angle", "rot6d_rows")


def to_matrix(rotation: Column, rep: str, *, convention: str = "XYZ", extrinsic: bool = False) -> Column:
    if rep == "euler":
        return euler_to_matrix(rotation, convention)
    if rep == "rpy":
        return rpy_to_matrix(rotation, extrinsic)
    if rep not in _TO:
        raise ValueError(f"no rotation representation {rep!r}")
    return _TO[rep](rotation)


def from_matrix(m: Column, rep: str, *, convention: str = "XYZ") -> Column:
    if rep == "euler":
        return matrix_to_euler(m, convention)
    if rep not in _FROM:
        raise ValueError(f"no rotation representation {rep!r}")
    return _FROM[rep](m)


def convert_rotation(rotation: Column, source: str, target: str) -> Column:
    return bind(to_matrix(rotation, source), lambda m: from_matrix(m, target))


def axis_alignment_matrix(x_to: str, y_to: str, z_to: str) -> Column:
    """The constant rotation that takes the source axes to the signed axes named; an error unless it is proper."""
    return vec(v for row in alignment_rows(x_to, y_to, z_to) for v in row)


def alignment_rows(x_to: str, y_to: str, z_to: str) -> list[list[float]]:
    columns = []
    for name in (x_to, y_to, z_to):
        axis = name.removeprefix("-")
        if axis not in ("x", "y", "z"):
            raise ValueError(f"{name!r} is no signed axis")
        columns.append([(-1.0 if name[0] == "-" else 1.0) * (axis == a) for a in "xyz"])
    if any(sum(abs(c[r]) for c in columns) != 1 for r in range(3)):
        raise ValueError("an axis is named twice")
    (a, d, g), (b, e, h), (c, f, i) = columns
    if a * (e * i - f * h) - b * (d * i - f * g) + c * (d * h - e * g) < 0:
        raise ValueError("the axes mirror space")
    return [[columns[k][r] + 0.0 for k in range(3)] for r in range(3)]


def align_axis(R: Column, p: Column, world: Column, gripper: Column | None = None) -> tuple[Column, Column]:
    """(world R gripper^T, world p)"""
    out = matmul(world, R)
    return (out if gripper is None else bind(out, lambda m: matmul(m, gripper, transpose_b=True))), matvec(world, p)


def plus(a: Column, b: Column) -> Column:
    return vec(x + y for x, y in zip(parts(a, 3), parts(b, 3)))


def _minus(a: Column, b: Column) -> Column:
    return vec(x - y for x, y in zip(parts(a, 3), parts(b, 3)))


def gripper_delta_pose(R: Column, p: Column, R_to: Column, p_to: Column) -> tuple[Column, Column]:
    """The move to a target pose in the frame of the pose itself."""
    return matmul(R, R_to, transpose_a=True), matvec(R, _minus(p_to, p), transpose=True)


def world_delta_pose(R: Column, p: Column, R_to: Column, p_to: Column) -> tuple[Column, Column]:
    return matmul(R_to, R, transpose_b=True), _minus(p_to, p)


def change_delta_pose_frame(R: Column, p: Column, into: Column) -> tuple[Column, Column]:
    return bind(matmul(into, R), lambda m: matmul(m, into, transpose_b=True)), matvec(into, p)


def world_pose_from_model_delta(R: Column, p: Column, R_now: Column, p_now: Column, R_frame: Column) -> tuple[Column, Column]:
    """Absolute target of a move given in a frame."""
    turn, shift = change_delta_pose_frame(R, p, R_frame)
    return bind(turn, lambda m: matmul(m, R_now)), bind(shift, lambda d: vec(x + y for x, y in zip(parts(p_now, 3), parts(d, 3))))


def gripper_delta_from_model_delta(R: Column, p: Column, R_now: Column, R_frame: Column) -> tuple[Column, Column]:
    into = matmul(R_now, R_frame, transpose_a=True)
    return bind(into, lambda m: change_delta_pose_frame(R, p, m)[0]), bind(into, lambda m: matvec(m, p))


def geodesic_degrees(a: Column, b: Column) -> Column:
    """The angle between two rotations."""
    return F.degrees(F.acos(_clamp((dot(parts(a, 9), parts(b, 9)) - 1.0) / 2.0)))


def orthogonality_error(m: Column) -> Column:
    """The largest element of |R R^T - 1|."""
    return bind(matmul(m, m, transpose_b=True), lambda s: F.greatest(*[F.abs(x - float(k % 4 == 0)) for k, x in enumerate(parts(s, 9))]))


def determinant_error(m: Column) -> Column:
    return F.abs(det(m) - 1.0)


def focal_length(height: Column, fovy_degrees: Column) -> Column:
    """Pixels, of a camera with a vertical field of view."""
    return 0.5 * height / F.tan(fovy_degrees * 3.141592653589793 / 360.0)


def camera_intrinsics(height: Column, width: Column, fovy_degrees: Column) -> Column:
    return bind(focal_length(height, fovy_degrees), lambda f: vec((f, 0, width / 2.0, 0, f, height / 2.0, 0, 0, 1)))


def camera_axis_correction(pose: Column) -> Column:
    """A 4x4 pose (16 by rows) times diag(1, -1, -1, 1)."""
    return vec(x * s for k, x in enumerate(parts(pose, 16)) for s in [(1.0, -1.0, -1.0, 1.0)[k % 4]])


def linear_depth(d: Column, near: float, far: float) -> Column:
    """Metres from a depth buffer's [0, 1]."""
    return near / (1.0 - d * (1.0 - near / far))


# Where each robot's native gripper axes point in the canonical gripper frame (x right, y down, z out).
ALIGNMENTS = {"franka": ("-y", "x", "z"), "widowx": ("-y", "-x", "-z"), "google": ("x", "y", "z"), "piper": ("y", "-x", "z"), "arx5": ("z", "-x", "-y")}
