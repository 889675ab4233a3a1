"""Trajectory operators on small episodes: golden cases, edges, and sequential restatements."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from framewright.functions import signals, so3, text
from framewright.operators import kinematics, meta, resample, stats, trajectory
from framewright.operators.trajectory import Frames
from framewright.plans import packing, registry

EP = Frames("ep", "t")


def episodes(spark, series, more=""):
    rows = [(e, t, *(x if isinstance(x, tuple) else (x,))) for e, xs in series.items() for t, x in enumerate(xs)]
    return spark.createDataFrame(rows, f"ep long, t long, x double{more}")


def column(df, name="v"):
    out = {}
    for r in df.orderBy("ep", "t").collect():
        out.setdefault(r.ep, []).append(r[name])
    return out


def test_noops(spark):
    df = episodes(spark, {0: [(0.0, -1.0), (0.0, 1.0), (0.0, 1.0)], 1: [(1.0, 0.0), (0.0, 0.0), (0.0, 1.0), (0.0, 1.0)], 2: [(0.0, 0.0)]}, ", g double")
    got = column(df.withColumn("v", trajectory.is_noop(F.col("x"), F.col("g"), EP)))
    assert got == {0: [True] * 3, 1: [False, True, False, True], 2: [True]}


def test_noops_as_a_scan(spark):
    rng = random.Random(1)
    data = {e: [(rng.choice([0.0, 1.0]), rng.choice([0.0, 1.0])) for _ in range(rng.randint(1, 12))] for e in range(60)}
    want = {}
    for e, steps in data.items():
        kept, want[e] = None, []
        for arm, grip in steps:
            noop = arm < 1e-4 and (kept is None or grip == kept)
            want[e].append(noop)
            kept = kept if noop else grip
    df = episodes(spark, data, ", g double")
    assert column(df.withColumn("v", trajectory.is_noop(F.col("x"), F.col("g"), EP))) == want


def test_gripper_states(spark):
    data = {0: [0.5, 0.99, 0.5, 0.01, 0.3], 1: [0.4], 2: [1.0, 1.0], 3: [0.5, 0.6]}
    got = column(episodes(spark, data).withColumn("v", trajectory.binarize_gripper(F.col("x"), EP)))
    assert got == {0: [1, 1, 0, 0, 0.3], 1: [0.4], 2: [1, 1], 3: [0.6, 0.6]}
    moves = {0: [0.0, 0.5, 0.0, -0.5, 0.0], 1: [0.0, 0.0], 2: [0.0, -0.5]}
    got = column(episodes(spark, moves).withColumn("v", trajectory.relative_to_absolute_gripper(F.col("x"), EP)))
    assert got == {0: [1, 0, 0, 1, 1], 1: [1, 1], 2: [0, 1]}


def test_delta_edges(spark):
    got = column(episodes(spark, {0: [1.0, 4.0, 2.0], 1: [5.0]}).withColumn("v", trajectory.forward_delta(F.col("x"), EP)))
    assert got == {0: [3, -2, 0], 1: [0]}


def test_last_delta_is_no_motion(spark):
    df = spark.createDataFrame([(0, 0, [0.1, -0.2, 0.5], [0.0, 0.0, 0.0]), (0, 1, [0.11, -0.2, 0.5], [0.0, 0.0, 0.1])], "ep long, t long, p array<double>, a array<double>").withColumn("R", so3.axis_angle_to_matrix(F.col("a")))
    rows = trajectory.next_pose_delta(df, EP, "p", "R").orderBy("t").collect()
    assert rows[1].gripper_eef_rot6d == [1, 0, 0, 0, 1, 0] and rows[1].gripper_eef_xyz == [0, 0, 0]
    assert np.allclose(rows[0].gripper_eef_xyz, [0.01, 0, 0])


def test_packing_at_the_limit(spark):
    def files(sizes, limit):
        df = spark.createDataFrame([(i, float(s)) for i, s in enumerate(sizes)], "e long, s double")
        return [r.ordinal for r in packing.pack(df, [], "e", "s", limit).orderBy("e").collect()]

    assert files([40, 40, 40, 30, 90, 10], 100) == [0, 0, 1, 1, 2, 3]
    assert files([150, 10], 100) == [0, 1]
    assert files([100], 100) == [0]
    assert files([], 100) == []
    rows = spark.createDataFrame([(g, i, s) for g in ("a", None, "b") for i, s in enumerate([60.0, 60.0, None, 30.0, 70.0])], "g string, e long, s double")
    got = packing.pack(rows.withColumn("ordinal", F.lit(7)), ["g"], "e", "s", 100, 2).orderBy("g", "e").collect()
    assert [r.ordinal for r in got] == [0, 1, 1, 1, 2] * 3
    assert [(r.chunk_index, r.file_index) for r in got[:5]] == [(0, 0), (0, 1), (0, 1), (0, 1), (1, 0)]


def test_merged_deviation_of_a_large_mean(spark):
    x = [1e8 + d for d in (-1.0, 1.0, -2.0, 2.0, -1.5, 1.5)]
    df = spark.createDataFrame([(k, i // 2, v) for k in ("a", None) for i, v in enumerate(x)], "k string, part long, x double")
    merged = stats.merge_stats(stats.feature_stats(df, ["k", "part"], "x", ()), ["k"]).collect()
    assert len(merged) == 2
    assert all(np.isclose(r["std"], np.std(x), rtol=1e-6) and r["count"] == 6 for r in merged)


def test_runs(spark):
    df = spark.createDataFrame([(0, "a"), (1, "a"), (2, "b"), (3, "a")], "i long, ep string")
    assert {r.ep: r.runs for r in trajectory.episode_runs(df, "ep", ["i"]).collect()} == {"a": 2, "b": 1}


def test_nearest_and_linear(spark):
    s = spark.createDataFrame([(0, 0.0, 0.0), (0, 2.0, 20.0), (0, 4.0, 0.0)], "k long, t double, v double")
    q = spark.createDataFrame([(0, x) for x in (-1.0, 0.0, 1.0, 1.5, 3.0, 9.0)] + [(1, 0.0)], "k long, t double")
    get = lambda df: [r.v for r in df.where("k = 0").orderBy("t").collect()]
    assert get(resample.nearest(s, q, ["k"], "t", ["v"])) == [0, 0, 0, 20, 20, 0]
    assert get(resample.nearest(s, q, ["k"], "t", ["v"], "later")) == [0, 0, 20, 20, 0, 0]
    assert get(resample.linear(s, q, ["k"], "t", ["v"])) == list(np.interp([-1, 0, 1, 1.5, 3, 9], [0, 2, 4], [0, 20, 0]))


def test_grid_rounds_half_to_even(spark):
    df = spark.createDataFrame([(0, 0.0, 2.5), (1, 0.0, 3.5), (2, 1.0, 1.0)], "k long, a double, b double")
    assert {r.k: r["count"] for r in resample.uniform_grid(df, ["k"], "a", "b", 1.0).groupBy("k").count().collect()} == {0: 3, 1: 5, 2: 1}


def test_butterworth():
    b, a = resample.butterworth(2, 0.25)
    assert np.allclose(b, [0.0976310729, 0.1952621459, 0.0976310729]) and np.allclose(a, [1, -0.9428090416, 0.3333333333])
    x = np.linspace(0, 1, 60)
    assert np.allclose(resample.filtfilt(b, a, np.full(40, 3.0)), 3.0)
    assert np.allclose(resample.filtfilt(b, a, x)[20:40], x[20:40], atol=1e-3)
    assert (resample.filtfilt(b, a, x[:9]) == x[:9]).all()
    noisy = x + 0.1 * np.sin(np.arange(60) * 2.8)
    assert np.abs(np.diff(resample.filtfilt(b, a, noisy), 2)).mean() < 0.2 * np.abs(np.diff(noisy, 2)).mean()


URDF = """<robot><joint name="a" type="revolute"><parent link="base"/><child link="l1"/><origin xyz="0 0 0.1" rpy="0 0 0.5"/><axis xyz="0 0 2"/></joint>
<joint name="f" type="fixed"><parent link="l1"/><child link="l2"/><origin xyz="0.3 0 0" rpy="0.1 0.2 0.3"/></joint>
<joint name="b" type="continuous"><parent link="l2"/><child link="tip"/><axis xyz="0 1 0"/></joint>
<joint name="s" type="prismatic"><parent link="tip"/><child link="slide"/></joint></robot>"""


def test_kinematics(spark):
    chain = kinematics.Chain.from_urdf(URDF, "base", "tip", (0.0, 0.0, 0.2))
    assert chain.dof == 2
    df = spark.createDataFrame([([0.0, 0.0],), ([0.4, -1.2],), ([1.0],), (None,)], "q array<double>")
    rows = kinematics.fk(df, chain, "q").collect()
    own = df.select(kinematics.fk_columns(chain, F.col("q")).alias("t")).collect()
    for r, o in list(zip(rows, own))[:2]:
        assert np.allclose(r.R, o.t.R) and np.allclose(r.p, o.t.p)
    assert rows[2].R is None and rows[3].p is None
    for tip in ("slide", "nowhere"):
        with pytest.raises(ValueError):
            kinematics.Chain.from_urdf(URDF, "base", tip)


def test_merged_stats_and_histogram(spark):
    rng = np.random.default_rng(3)
    df = spark.createDataFrame([(int(i % 3), float(v)) for i, v in enumerate(rng.integers(0, 40, 500))], "g long, x double")
    merged = stats.merge_stats(stats.feature_stats(df, ["g"], "x", ()), []).first()
    x = np.array([r.x for r in df.collect()])
    assert np.isclose(merged["mean"], x.mean()) and np.isclose(merged["std"], x.std()) and merged["count"] == 500
    got = {r.q: r.value for r in stats.histogram_quantiles(stats.value_histogram(df.withColumn("k", F.lit(0)), ["k"], "x"), ["k"], (0.0, 0.13, 0.5, 1.0)).collect()}
    assert all(np.isclose(v, np.quantile(x, q)) for q, v in got.items())


def test_fit(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(50, 3))
    df = spark.createDataFrame([(0, a.tolist(), float(a @ [1.0, -2.0, 0.5])) for a in x], "k long, x array<double>, y double")
    r = stats.linear_fit3(df, ["k"], "x", "y").first()
    assert np.allclose(r.coefficients, [1, -2, 0.5]) and abs(r.r2 - 1) < 1e-9


def test_strict_joins_fail_loudly(spark):
    a = spark.createDataFrame([(1,), (2,)], "k long")
    b = spark.createDataFrame([(1, "x")], "k long, v string")
    with pytest.raises(Exception, match="no metadata for 2"):
        meta.strict_lookup(a, b, ["k"]).collect()
    with pytest.raises(Exception, match="lacks a part"):
        meta.keyed_merge([a, b], "k").collect()
    assert [r.v for r in meta.left_lookup(a, b, ["k"], {"v": "none"}).orderBy("k").collect()] == ["x", "none"]


def test_shards(spark):
    for n, k in ((10, 3), (7, 7), (3, 5), (100, 8)):
        rows = spark.range(n).select(meta.array_split_shard(F.col("id"), n, k).alias("a"), meta.linspace_shard(F.col("id"), n, k).alias("l")).collect()
        assert [r.a for r in rows] == [i for i, part in enumerate(np.array_split(range(n), k)) for _ in part]
        bounds = [i * n // k for i in range(k + 1)]
        assert [r.l for r in rows] == [next(i for i in range(k) if bounds[i] <= x < bounds[i + 1]) for x in range(n)]
    got = spark.range(1).select(meta.even_indices(10, 4).alias("v"), meta.even_indices(0, 4).alias("z")).first()
    assert got.v == np.unique(np.round(np.linspace(0, 9, 4))).astype(int).tolist() and got.z == []


def test_slices(spark):
    df = spark.createDataFrame([([0.0, 1.0, 2.0, 3.0],)], "v array<double>")
    for a, b in ((0, 2), (1, None), (-1, None), (-3, -1), (0, -1), (2, 9), (3, 1)):
        assert df.select(signals.vector_slice(F.col("v"), a, b)).first()[0] == [0.0, 1.0, 2.0, 3.0][a:b]


def test_texts(spark):
    df = spark.createDataFrame([("", "b", "A_openpi", "https://x.org/a/b?c", "tf.Tensor(b'pick it', shape=(), dtype=string)")], "a string, b string, p string, u string, t string")
    r = df.select(text.first_nonempty(F.col("a"), F.col("b")), text.first_nonempty(F.col("a"), F.col("a")), text.policy_name(F.col("p")), text.url_host(F.col("u")), text.url_segment(F.col("u"), 2), text.unwrap_tensor_text(F.col("t")), text.iso_utc(F.lit(0))).first()
    assert list(r) == ["b", "", "openpi", "x.org", "b", "pick it", "1970-01-01T00:00:00Z"]
    assert text.flat_name("observation.images.top") == "top" and text.flat_name("action") == "action"


NATIVE = {
    "kuka": "observation struct<natural_language_instruction:string>, action struct<world_vector:array<double>,rotation_delta:array<double>,gripper_closedness_action:array<double>>",
    "fractal20220817_data": "observation struct<natural_language_instruction:string,base_pose_tool_reached:array<double>,gripper_closed:array<double>>, action struct<world_vector:array<double>,rotation_delta:array<double>,gripper_closedness_action:array<double>>",
    "droid": "observation struct<cartesian_position:array<double>,joint_position:array<double>,gripper_position:array<double>>, action_dict struct<cartesian_position:array<double>,joint_position:array<double>,gripper_position:array<double>>, language_instruction string, language_instruction_2 string",
    "bridge_oxe": "observation struct<natural_language_instruction:string,state:array<double>>, action struct<world_vector:array<double>,rotation_delta:array<double>,open_gripper:boolean>",
    "taco_play": "observation struct<natural_language_instruction:string,robot_obs:array<double>>, action struct<actions:array<double>>",
}


def test_rules(spark):
    v = lambda n, s=0.1: [s * (i + 1) for i in range(n)]
    rows = {
        "kuka": [(("go",), (v(3), v(3), [x])) for x in (0.0, 0.5)],
        "fractal20220817_data": [(("go", [*v(3), 0.0, 0.0, 0.0, 1.0], [0.25]), (v(3), [0.0] * 3, [x])) for x in (-0.5, 0.0)],
        "droid": [((v(6), v(7), [0.25]), (v(6), v(7), [0.5]), "", "pick") for _ in range(2)],
        "bridge_oxe": [(("go", v(7, s)), (v(3), v(3), True)) for s in (0.1, 0.2, 0.4)],
        "taco_play": [(("go", v(14, 0.02)), (v(7),)) for _ in range(2)],
    }
    out = {}
    for name, data in rows.items():
        df = spark.createDataFrame([(0, t, *r) for t, r in enumerate(data)], f"ep long, t long, {', '.join([NATIVE[name]])}")
        out[name] = registry.standardize(df, name, EP).orderBy("t").collect()
    assert [r.action[-1] for r in out["kuka"]] == [1.0, 0.0] and len(out["kuka"][0].action) == 7
    assert np.allclose(out["fractal20220817_data"][0].target.eef_xyz, [0.2, 0.4, 0.6]) and out["fractal20220817_data"][0].state.gripper_state == [0.75]
    assert out["droid"][0].language_instruction == "pick" and out["droid"][1].debug.gripper_eef_rot6d == [1, 0, 0, 0, 1, 0]
    assert len(out["bridge_oxe"]) == 1 and np.allclose(out["bridge_oxe"][0].action, [*v(6, 0.2), 1.0])
    assert len(out["taco_play"][0].state.joint_pos) == 7 and out["taco_play"][0].state.gripper_state == [1.0]
    assert len(registry.DATASETS) == 74 and registry.dataset("none such").fps == 10
    assert {d.rule for d in registry.DATASETS.values()} <= set(registry.RULES)
