"""Rotation columns against numpy, and their own inverses."""

import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from framewright.functions import so3


def run(spark, rows, schema, **columns):
    df = spark.createDataFrame(rows, schema)
    return [[r[n] for n in columns] for r in df.select(*[c.alias(n) for n, c in columns.items()]).collect()]


def elementary(axis, a):
    c, s = math.cos(a), math.sin(a)
    return np.array({"X": [[1, 0, 0], [0, c, -s], [0, s, c]], "Y": [[c, 0, s], [0, 1, 0], [-s, 0, c]], "Z": [[c, -s, 0], [s, c, 0], [0, 0, 1]]}[axis])


CONVENTIONS = ["XYZ", "XZY", "YXZ", "YZX", "ZXY", "ZYX", "XYX", "XZX", "YXY", "YZY", "ZXZ", "ZYZ"]
ANGLES = [(0.3, -0.4, 1.1), (-2.0, 0.7, 0.2), (1.2, 1.0, -2.9), (0.0, 0.5, 0.0)]


@pytest.mark.parametrize("convention", CONVENTIONS)
def test_euler(spark, convention):
    m = so3.euler_to_matrix(F.col("a"), convention)
    got = run(spark, [(list(a),) for a in ANGLES], "a array<double>", m=m, again=so3.bind(m, lambda x: so3.euler_to_matrix(so3.matrix_to_euler(x, convention), convention)))
    for a, (flat, again) in zip(ANGLES, got):
        want = elementary(convention[0], a[0]) @ elementary(convention[1], a[1]) @ elementary(convention[2], a[2])
        assert np.allclose(np.reshape(flat, (3, 3)), want)
        assert np.allclose(again, flat, atol=1e-9)


def test_extrinsic_is_reversed_intrinsic(spark):
    got = run(spark, [(list(a),) for a in ANGLES], "a array<double>", m=so3.rpy_to_matrix(F.col("a"), True), a=so3.bind(so3.rpy_to_matrix(F.col("a"), True), lambda m: so3.rpy_to_matrix(so3.matrix_to_rpy(m, True), True)))
    for a, (m, again) in zip(ANGLES, got):
        assert np.allclose(np.reshape(m, (3, 3)), elementary("Z", a[2]) @ elementary("Y", a[1]) @ elementary("X", a[0]))
        assert np.allclose(m, again)


@pytest.mark.parametrize("rep", ["quaternion", "rotation_6d", "axis_angle", "rot6d_rows", "euler"])
def test_round_trip(spark, rep):
    m = so3.rpy_to_matrix(F.col("a"))
    got = run(spark, [(list(a),) for a in ANGLES], "a array<double>", m=m, back=so3.bind(m, lambda x: so3.to_matrix(so3.from_matrix(x, rep), rep)))
    for a, b in got:
        assert np.allclose(a, b, atol=1e-9)


def test_quaternion_any_length_and_sign(spark):
    q = so3.quaternion_to_matrix(F.col("q"))
    got = run(spark, [([0.1, 0.2, 0.3, 0.9],), ([-0.2, -0.4, -0.6, -1.8],), ([0.0, 0.0, 0.0, 0.0],)], "q array<double>", m=q, back=so3.bind(q, so3.matrix_to_quaternion))
    assert np.allclose(got[0][0], got[1][0])
    assert got[1][1][3] > 0
    assert got[2] == [None, None]


def test_domain_edges(spark):
    lock = so3.rpy_to_matrix(F.array(F.lit(0.2), F.lit(math.pi / 2), F.lit(0.1)))
    (row,) = run(spark, [(0,)], "x int", e=so3.bind(lock, lambda m: so3.matrix_to_euler(m, "XYZ")), zero=so3.axis_angle_to_matrix(so3.vec((0, 0, 0))), none=so3.rotation_6d_to_matrix(so3.vec((0, 0, 0, 1, 0, 0))), turn=so3.bind(so3.axis_angle_to_matrix(so3.vec((math.pi, 0, 0))), so3.matrix_to_quaternion))
    assert not any(math.isnan(x) for x in row[0]) and abs(row[0][1] - math.pi / 2) < 1e-6
    assert row[1] == [1, 0, 0, 0, 1, 0, 0, 0, 1]
    assert row[2] is None
    assert abs(row[3][3]) < 1e-9


def test_alignment():
    assert so3.alignment_rows("x", "-y", "-z") == [[1, 0, 0], [0, -1, 0], [0, 0, -1]]
    for bad in (("x", "y", "-z"), ("x", "x", "z"), ("w", "y", "z")):
        with pytest.raises(ValueError):
            so3.alignment_rows(*bad)


def test_deltas_compose(spark):
    R, T = so3.rpy_to_matrix(F.col("a")), so3.rpy_to_matrix(F.col("b"))
    df = spark.createDataFrame([([0.3, -0.2, 0.9], [-0.1, 0.4, 0.2], [1.0, 2.0, 3.0], [0.5, 0.1, -1.0])], "a array<double>, b array<double>, p array<double>, t array<double>").withColumns({"Rm": R, "Tm": T})
    c = {"R": F.col("Rm"), "T": F.col("Tm"), "p": F.col("p"), "t": F.col("t")}
    dR, dp = so3.gripper_delta_pose(c["R"], c["p"], c["T"], c["t"])
    df = df.withColumns({"dR": dR, "dp": dp})
    W, w = so3.world_pose_from_model_delta(F.col("dR"), F.col("dp"), c["R"], c["p"], c["R"])
    G, g = so3.gripper_delta_from_model_delta(F.col("dR"), F.col("dp"), c["R"], c["R"])
    row = df.select(F.col("Tm"), "t", "dR", "dp", W.alias("W9"), w.alias("w3"), G.alias("G9"), g.alias("g3"), so3.geodesic_degrees(c["R"], c["R"]).alias("zero"), so3.determinant_error(c["R"]).alias("det"), so3.orthogonality_error(c["R"]).alias("orth")).first()
    assert np.allclose(row.W9, row.Tm) and np.allclose(row.w3, row.t)
    assert np.allclose(row.G9, row.dR) and np.allclose(row.g3, row.dp)
    assert row.zero < 1e-5 and row.det < 1e-9 and row.orth < 1e-9


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(*[st.floats(-3, 3)] * 3), min_size=1, max_size=20))
def test_six_numbers_of_any_rotation(spark, angles):
    m = so3.rpy_to_matrix(F.col("a"))
    got = run(spark, [(list(a),) for a in angles], "a array<double>", m=m, back=so3.bind(m, lambda x: so3.rotation_6d_to_matrix(so3.matrix_to_rotation_6d(x))))
    for a, b in got:
        assert np.allclose(a, b, atol=1e-8)


def test_camera(spark):
    (row,) = run(spark, [(0,)], "x int", k=so3.camera_intrinsics(F.lit(256.0), F.lit(320.0), F.lit(90.0)), d=so3.linear_depth(F.lit(0.0), 0.1, 10.0), e=so3.linear_depth(F.lit(1.0), 0.1, 10.0))
    assert np.allclose(row[0], [128, 0, 160, 0, 128, 128, 0, 0, 1])
    assert abs(row[1] - 0.1) < 1e-12 and abs(row[2] - 10) < 1e-9
