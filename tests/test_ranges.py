"""Operators without a single task: long episodes, running sums, packing and exact quantiles over ranges."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from framewright.operators import ranges, resample, selection, stats, trajectory
from framewright.operators.trajectory import Frames
from framewright.plans import packing


@pytest.fixture(scope="module")
def hot(spark):
    """One episode holds nine tenths of the frames; order has ties in ts; values hold nulls."""
    rng = random.Random(4)
    rows = []
    for i in range(4000):
        e = "hot" if rng.random() < 0.9 else rng.choice(["a", "b", None])
        rows.append((e, rng.randint(0, 900), i, rng.choice([None, 0.0, 0.02, 0.5, 0.5, 0.5, 1.0]), rng.choice([0.0] * 30 + [0.3, -0.3]), rng.choice([0.0] * 9 + [1.0])))
    rows += [("rest", t, 10_000 + t, 0.5, 0.0, 0.0) for t in range(300)]
    return spark.createDataFrame(rows, "ep string, ts long, id long, grip double, move double, arm double").repartition(5).cache()


F_ = Frames("ep", ["ts", "id"])
KEY = (["ep"], ["ts", "id"])


def same(a, b):
    rows = lambda df: sorted((tuple(r) for r in df.collect()), key=repr)
    assert rows(a) == rows(b)


@pytest.mark.parametrize("parts", [1, 7, 40])
def test_long_episodes_equal_windows(hot, parts):
    d = hot
    same(ranges.long_forward_delta(d, *KEY, "grip", parts=parts).select("id", "delta"), d.select("id", trajectory.forward_delta(F.col("grip"), F_)))
    same(ranges.long_binarize_gripper(d, *KEY, "grip", parts=parts).select("id", "grip"), d.select("id", trajectory.binarize_gripper(F.col("grip"), F_)))
    same(ranges.long_absolute_gripper(d, *KEY, "move", parts=parts).select("id", "grip"), d.select("id", trajectory.relative_to_absolute_gripper(F.col("move"), F_)))
    same(ranges.long_noops(d, *KEY, F.col("arm"), F.col("grip"), parts=parts).select("id", "noop"), d.select("id", trajectory.is_noop(F.col("arm"), F.col("grip"), F_)))


@pytest.mark.parametrize("tie", ["earlier", "later"])
def test_long_nearest_equals_windows(hot, tie):
    s = hot.where("id % 3 > 0").groupBy("ep", "ts").agg(F.max("id").alias("v")).where("ep is not null")
    q = hot.where("id % 3 = 0 and ep is not null").select("ep", "ts", "id")
    want = resample.nearest(s, q, ["ep"], "ts", ["v"], tie)
    same(ranges.long_nearest(s, q, ["ep"], "ts", ["v"], tie, parts=9).select(want.columns), want)


def test_a_hot_episode_is_many_even_ranges(hot):
    sizes = [r["count"] for r in ranges.dealt(hot, ["ep", "ts", "id"], 16).groupBy(ranges.PART).count().collect()]
    assert len(sizes) >= 14 and max(sizes) < 2 * np.median(sizes)


def test_carried_rows_are_two_a_range_at_most(hot):
    plan = ranges.long_forward_delta(hot, *KEY, "grip", parts=8)._jdf.queryExecution().optimizedPlan().toString()
    assert "ResolvedHint" in plan or "broadcast" in plan.lower()


def test_running_sums(spark):
    rows = [(i, v) for i, v in enumerate(random.Random(3).choices([0, 1, 5, None, 10**12], k=500))]
    df = spark.createDataFrame(rows, "k long, v long").repartition(6)
    got = {r.k: r.upto for r in ranges.running_sums(df, ["k"], {"upto": F.coalesce(F.col("v"), F.lit(0).cast("long"))}, 7).collect()}
    total = 0
    for k, v in rows:
        total += v or 0
        assert got[k] == total


def no_single_task(df):
    assert "SinglePartition" not in df._jdf.queryExecution().executedPlan().toString()


def test_offsets_and_numbers_without_a_single_task(spark):
    e = spark.range(300).select(F.col("id").alias("episode_index"), (F.col("id") % 7 + 1).alias("length"))
    out = trajectory.dataset_offsets(e)
    no_single_task(out)
    at = 0
    for r in out.orderBy("episode_index").collect():
        assert (r.dataset_from_index, r.dataset_to_index) == (at, at + r.episode_index % 7 + 1)
        at = r.dataset_to_index
    no_single_task(trajectory.global_rank(e, ["length", "episode_index"]))


def plain_pack(rows, limit):
    out, at, held, ordinal = {}, "none", 0, 0
    for g, k, s, i in sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1], r[2] or 0)):
        s = s or 0
        if g != at:
            at, held, ordinal = g, s, 0
        elif held + s >= limit:
            held, ordinal = s, ordinal + 1
        else:
            held += s
        out[i] = ordinal
    return out


@pytest.mark.parametrize("parts", [1, 4, 40])
@pytest.mark.parametrize("sizes, limit", [([1, 2, 3, 50], 40), ([7], 21), ([0, 0, 0, 5], 5), ([100, 3], 10), ([0.5, 0.25, 2.75, None], 4.5), ([1], 10**6)])
def test_packing_over_ranges(spark, parts, sizes, limit):
    rng = random.Random(repr((sizes, limit)))
    rows = [(rng.choice(["x"] * 6 + ["y", "z", None]), k // 2, x if (x := rng.choice(sizes)) is None else float(x), k) for k in range(400)]
    df = spark.createDataFrame(rows, "g string, k long, s double, id long").repartition(5)
    got = packing.pack(df, ["g"], "k", "s", limit, parts=parts)
    if parts > 1:
        no_single_task(got)
    assert sorted(r.ordinal for r in got.collect()) == sorted(plain_pack(rows, limit).values())
    tie_free = {r.id: r.ordinal for r in packing.pack(df.withColumn("k", F.col("id")), ["g"], "k", "s", limit, parts=parts).collect()}
    assert tie_free == plain_pack([(g, i, s, i) for g, _, s, i in rows], limit)


def test_packing_one_group_and_none(spark):
    rows = [("", k, float(k % 9), k) for k in range(200)]
    df = spark.createDataFrame(rows, "g string, k long, s double, id long")
    assert {r.id: r.ordinal for r in packing.pack(df, [], "k", "s", 30, parts=9).collect()} == plain_pack(rows, 30)
    assert packing.pack(df.limit(0), ["g"], "k", "s", 30).collect() == []


@pytest.mark.parametrize("most", [1, 40, 100_000])
def test_exact_quantiles(spark, most):
    rng = random.Random(most)
    values = {"wide": [rng.lognormvariate(0, 30) * rng.choice([1, -1]) for _ in range(700)], "ties": [rng.choice([1.0, 2.0, 2.0, 3.5]) for _ in range(500)], "one": [4.0], "odd": [math.inf, -math.inf, 0.0, -0.0, 1e-300, 5.0] * 30, None: [float(k) for k in range(101)]}
    rows = [(k, v) for k, vs in values.items() for v in vs] + [("ties", None), ("none", None)]
    df = spark.createDataFrame(rows, "k string, x double").repartition(7)
    qs = [0.0, 0.01, 0.3, 0.5, 0.99, 1.0]
    got = {(r.k, r.q): r.value for r in selection.exact_quantiles(df, ["k"], "x", qs, most=most).collect()}
    assert set(k for k, _ in got) == set(values)
    for k, vs in values.items():
        if k != "odd":
            assert [got[k, q] for q in qs] == pytest.approx(np.quantile(vs, qs).tolist(), rel=1e-12)
    assert got["odd", 0.0] == -math.inf and got["odd", 1.0] == math.inf and got["odd", 0.5] == 0.5e-300


def test_exact_quantiles_by_weight(spark):
    rng = random.Random(1)
    rows = [(rng.choice("ab"), float(rng.randint(0, 60)), rng.randint(0, 9)) for _ in range(300)]
    df = spark.createDataFrame(rows, "k string, x double, n long")
    got = {(r.k, r.q): r.value for r in selection.exact_quantiles(df, ["k"], "x", [0.1, 0.5, 0.9], weight="n", most=5).collect()}
    for k in "ab":
        vs = [x for kk, x, n in rows for _ in range(n) if kk == k]
        assert [got[k, q] for q in (0.1, 0.5, 0.9)] == pytest.approx(np.quantile(vs, [0.1, 0.5, 0.9]).tolist())


def test_a_million_distinct_values(spark):
    df = spark.range(1_000_003).select(((F.col("id") * 7919) % 1_000_003 / 16).alias("x"))
    r = stats.global_stats(df, [], "x", most=2000).first()
    want = [(1_000_002 * q) / 16 for q in stats.QUANTILES]
    assert [r.q01, r.q10, r.q50, r.q90, r.q99] == pytest.approx(want) and r["count"] == 1_000_003 and r.min == 0.0


def plain_filter(b, a, x):
    z = resample._steady(b, a)
    pad = 3 * max(len(a), len(b))
    if len(x) <= pad:
        return list(x)
    x = [*(2 * x[0] - v for v in x[pad:0:-1]), *x, *(2 * x[-1] - v for v in x[-2 : -pad - 2 : -1])]
    for _ in range(2):
        s, y = [k * x[0] for k in z], []
        for v in x:
            y.append(b[0] * v + s[0])
            s = [(s[k + 1] if k + 1 < len(s) else 0.0) + b[k + 1] * v - a[k + 1] * y[-1] for k in range(len(s))]
        x = y[::-1]
    return x[pad:-pad]


@pytest.mark.parametrize("order, cutoff", [(1, 0.5), (2, 1 / 3), (4, 0.05)])
def test_blocked_filter(order, cutoff):
    rng = np.random.default_rng(order)
    b, a = resample.butterworth(order, cutoff)
    pad = 3 * len(a)
    sizes = np.array([0, 1, pad, pad + 1, 64, 64 - 2 * pad, 500, 3, 129])
    x = rng.normal(size=sizes.sum()).cumsum()
    got = np.split(resample.filtfilt_all(b, a, x, sizes), np.cumsum(sizes)[:-1])
    for g, v in zip(got, np.split(x, np.cumsum(sizes)[:-1])):
        assert np.allclose(g, plain_filter(b, a, v.tolist()), atol=1e-9)


def test_smoothing_streams_whole_episodes(spark):
    rng = np.random.default_rng(0)
    rows = [(f"e{k % 13}" if k % 11 else None, k, float(v), 1) for k, v in enumerate(rng.normal(size=3000).cumsum())]
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 37)
    try:
        got = resample.smooth(spark.createDataFrame(rows, "e string, k long, x double, y int"), ["e"], ["k"], ["x"], 30.0, 5.0).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    by = {}
    for r in sorted(got, key=lambda r: r.k):
        by.setdefault(r.e, []).append(r.x)
    b, a = resample.butterworth(2, 1 / 3)
    for e, vs in by.items():
        assert np.allclose(vs, plain_filter(b, a, [x for ee, _, x, _ in rows if ee == e]))
