"""Recordings made here, read back: entities, series, times, channels on one clock and on a grid."""

import struct

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from framewright.operators import resample
from framewright.sources import rrd

rng = np.random.default_rng(6)


def varint(n):
    out = b""
    while n > 127:
        out, n = out + bytes([n & 127 | 128]), n >> 7
    return out + bytes([n])


def field(number, value):
    return varint(number << 3) + varint(value) if isinstance(value, int) else varint(number << 3 | 2) + varint(len(value)) + value


def chunk(entity, times, name, values, packed=False, spelling="rerun:"):
    meta = lambda **k: {f"{spelling}{a}": b for a, b in k.items()}
    schema = pa.schema(
        [
            pa.field("id", pa.binary(16), metadata=meta(kind="control")),
            pa.field("log_time", pa.timestamp("ns"), metadata=meta(kind="index")),
            pa.field("step", pa.int64(), metadata=meta(kind="index")),
            pa.field(name, values.type, metadata=meta(kind="data")),
        ],
        metadata=meta(entity_path=entity, id="x"),
    )
    n = len(times)
    batch = pa.RecordBatch.from_arrays([pa.array([bytes(16)] * n, pa.binary(16)), pa.array((np.asarray(times) * 1e9).round().astype("i8")).cast(pa.timestamp("ns")), pa.array(range(n), pa.int64()), values], schema=schema)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, schema) as w:
        w.write_batch(batch)
    raw = sink.getvalue().to_pybytes()
    body = pa.Codec("lz4_raw").compress(raw).to_pybytes() if packed else raw
    return field(1, field(1, 2) + field(2, b"app")) + field(2, 2 if packed else 1) + field(3, len(raw)) + field(4, 1) + field(5, body)


def message(kind, body):
    return struct.pack("<QQ", kind, len(body)) + body


def recording(*chunks, end=True):
    return b"RRF2" + bytes([0, 23, 0, 0]) + bytes([1, 2, 0, 0]) + message(1, b"\x0a\x03abc") + b"".join(message(2, c) for c in chunks) + (message(0, b"") if end else b"")


def lists(values):
    return pa.array([None if v is None else [v] for v in values], pa.list_(pa.float64()))


@pytest.fixture(scope="module")
def made(spark, tmp_path_factory):
    """Seven channels, each on its own rows, staggered, in several chunks out of order; a camera; broken files."""
    at = tmp_path_factory.mktemp("logs")
    series, parts = {}, []
    for k in range(7):
        entity = f"/arm/cur_joint/joint_{k + 1}" if k < 6 else "/arm/cur_gripper"
        t = 100 + np.arange(60) / 138 + k * 3e-4 + rng.uniform(0, 1e-4, 60)
        v = np.sin(t * (k + 1))
        series[entity] = (t, v)
        for a in (30, 0):
            parts.append(chunk(entity, t[a : a + 30], "Scalars:scalars", lists(v[a : a + 30]), packed=k % 2 == 1, spelling="rerun." if k == 3 else "rerun:"))
    frames = 100 + np.arange(12) / 28
    parts.append(chunk("/videos_left", frames, "VideoStream:sample", pa.array([[b"x" * 50_000] if i % 4 else None for i in range(12)], pa.list_(pa.binary()))))
    (at / "a.rrd").write_bytes(recording(*parts))
    (at / "b.rrd").write_bytes(recording(chunk("/arm/cur_gripper", [1.0, 2.0, 3.0], "Scalars:scalars", lists([0.5, None, 0.25])), end=False))
    (at / "cut.rrd").write_bytes(recording(*parts)[:-3000])
    (at / "old.rrd").write_bytes(b"RRF0 and what follows")
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.rrd").load(str(at)).select("path")
    return rrd.chunks(listed), series, frames, at


def test_chunks_and_entities(spark, made):
    found, series, _, _ = made
    rows = found.withColumn("path", F.element_at(F.split("path", "/"), -1)).collect()
    a = [r for r in rows if r.path == "a.rrd"]
    assert len(a) == 15 and {r.entity for r in a} == {*series, "/videos_left"} and all(r.timelines == ["log_time", "step"] and r.error is None for r in a)
    errors = {r.path: r.error for r in rows if r.error}
    assert set(errors) == {"cut.rrd", "old.rrd"} and "ends early" in errors["cut.rrd"] and len([r for r in rows if r.path == "cut.rrd"]) == 15
    present = {r.path.rsplit("/", 1)[1]: r.present for r in rrd.entities(found, ["/videos_front", "/videos_left", "/arm/cur_gripper"]).collect()}
    assert present["a.rrd"] == ["/videos_left", "/arm/cur_gripper"] and present["b.rrd"] == ["/arm/cur_gripper"]


def test_series_and_times(made):
    found, series, frames, _ = made
    got = {}
    for r in rrd.scalars(found.where("path like '%a.rrd'")).collect():
        got.setdefault(r.entity, []).append((r.t, r.value))
    assert set(got) == set(series)
    for entity, (t, v) in series.items():
        rows = sorted(got[entity])
        assert np.allclose([x for x, _ in rows], t, atol=1e-6) and np.allclose([x for _, x in rows], v, atol=1e-12)
    assert sorted((r.t, r.value) for r in rrd.scalars(found.where("path like '%b.rrd'")).collect()) == [(1.0, 0.5), (3.0, 0.25)]
    assert sorted(r.value for r in rrd.scalars(found.where("path like '%b.rrd'"), "step").collect()) == [0.25, 0.5]
    seen = sorted(r.t for r in rrd.times(found.where("path like '%a.rrd'")).collect())
    assert np.allclose(seen, [t for i, t in enumerate(frames) if i % 4])


def test_entities_not_asked_for_are_not_read(spark, made, tmp_path):
    _, series, _, at = made
    raw = bytearray((at / "a.rrd").read_bytes())
    found = rrd.chunks(spark.createDataFrame([(f"file://{at}/a.rrd",)], "path string"))
    for r in found.where("entity = '/videos_left'").collect():
        raw[r.at + r.size // 2 : r.at + r.size] = b"\xee" * (r.size - r.size // 2)
    (tmp_path / "a.rrd").write_bytes(bytes(raw))
    spoilt = rrd.chunks(spark.createDataFrame([(f"file://{tmp_path}/a.rrd",)], "path string"))
    assert spoilt.where("error is not null").count() == 0 and rrd.scalars(spoilt).count() == 7 * 60


def nearest(t, v, at):
    return [v[min(range(len(t)), key=lambda k: (abs(t[k] - x), t[k]))] for x in at]


def test_channels_on_one_clock_and_on_a_grid(spark, made):
    found, series, _, _ = made
    s = rrd.scalars(found.where("path like '%a.rrd'")).withColumn("t", F.round("t", 9))
    channels = {f"j{k + 1}": f"/arm/cur_joint/joint_{k + 1}" for k in range(6)} | {"grip": "/arm/cur_gripper"}
    rows = rrd.aligned(s, channels, "j1").orderBy("t").collect()
    t = np.round(series[channels["j1"]][0], 9)
    assert len(rows) == 60
    for column, entity in channels.items():
        assert np.allclose([r[column] for r in rows], nearest(np.round(series[entity][0], 9), series[entity][1], t), atol=1e-9)
    # 30 Hz: nearest joints, linear gripper.
    spans = s.where(F.col("entity") == channels["j1"]).groupBy("path").agg(F.min("t").alias("a"), F.max("t").alias("b"))
    grid = resample.uniform_grid(spans, ["path"], "a", "b", 30.0)
    g = s.where(F.col("entity") == channels["grip"]).select("path", "t", "value")
    out = resample.linear(g, grid, ["path"], "t", ["value"]).orderBy("t").collect()
    gt, gv = series[channels["grip"]]
    assert len(out) == round((t[-1] - t[0]) * 30) + 1 and np.allclose([r.value for r in out], np.interp([r.t for r in out], gt, gv), atol=1e-6)
