"""Layouts, files and streams: round trips."""

import json
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from framewright.plans import layout
from framewright.sources import files
from framewright.streaming import ingest


@pytest.fixture()
def frames(spark):
    rows = [(e, t, t / 10, e % 2, [float(e), float(t)]) for e, n in enumerate([3, 1, 5, 2]) for t in range(n)]
    return spark.createDataFrame(rows, "episode_index long, frame_index long, timestamp double, task_index long, state array<float>")


@pytest.fixture()
def tasks(spark):
    return spark.createDataFrame([(0, "pick"), (1, "place")], "task_index long, task string")


def contents(df):
    return sorted(tuple(map(str, r)) for r in df.select("episode_index", "frame_index", "timestamp", "task_index", "state").collect())


def test_layouts_round_trip(spark, frames, tasks, tmp_path):
    a, b, c = (f"file://{tmp_path}/{x}" for x in "abc")
    info = layout.Info("v2.1", "arm", 10.0)
    layout.write_by_episode(frames, tasks, a, info)
    episodes = layout.v21_to_v30(spark, a, b, bytes_per_frame=1 << 20, limit_mb=6)
    assert [(r.length, r.file_index, r.dataset_from_index) for r in episodes.orderBy("episode_index").collect()] == [(3, 0, 0), (1, 0, 3), (5, 1, 4), (2, 2, 9)]
    for r in episodes.collect():
        placed = spark.read.parquet(f"{b}/data/chunk_index={r.chunk_index}/file_index={r.file_index}").where(F.col("episode_index") == r.episode_index)
        assert placed.count() == r.length
    layout.v30_to_v21(spark, b, c)
    for root, version in ((a, "v2.1"), (b, "v3.0"), (c, "v2.1")):
        assert contents(layout.read_frames(spark, root)) == contents(frames)
        assert layout.read_tasks(spark, root).count() == 2
        assert layout.read_info(spark, root, version).total_frames == 11
    with pytest.raises(ValueError):
        layout.read_info(spark, a, "v3.0")


def test_task_columns(spark, frames):
    f, t = layout.v16_to_v20(frames.withColumn("say", F.concat(F.lit("tf.Tensor(b'task "), F.col("task_index").cast("string"), F.lit("', shape=(), dtype=string)"))).drop("task_index"), task_column="say")
    assert [(r.task, r.task_index) for r in t.orderBy("task_index").collect()] == [("task 0", 0), ("task 1", 1)]
    assert f.where("task_index <> episode_index % 2").count() == 0
    with pytest.raises(ValueError):
        layout.v16_to_v20(frames)


def test_detailed_checks_widths(spark, frames):
    assert layout.detailed(frames, {"state": 2}).count() == 11
    with pytest.raises(Exception, match="another width"):
        layout.detailed(frames, {"state": 3}).collect()


def test_predicates_reach_the_scan(spark, frames, tmp_path):
    frames.write.parquet(f"{tmp_path}/p")
    plan = files.read_episode(spark, f"{tmp_path}/p", 2, ["frame_index"])._jdf.queryExecution().toString()
    assert "EqualTo(episode_index,2)" in plan and "state" not in plan.split("ReadSchema")[1]


def test_json_csv_and_listing(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"k": 1}\n\n{"k": 2}\n')
    assert files.read_jsonl(spark, str(tmp_path / "a.jsonl"), "k long").count() == 2
    (tmp_path / "t.csv").write_text("task,text\na,x\na,x\nb,y\n")
    assert files.read_csv_tasks(spark, str(tmp_path / "t.csv"), "task string, text string").count() == 2
    for n in (10, 9, 2):
        (tmp_path / f"episode_{n}.npz").write_bytes(b"x")
    assert [r.number for r in files.list_files(spark, str(tmp_path), "episode_*").collect()] == [2, 9, 10]


def test_npz_and_safetensors(spark, tmp_path):
    np.savez(tmp_path / "e.npz", steps=np.array([{"q": np.array([1.0, 2.0])}, {"q": np.array([3.0, 4.0])}], object))
    assert [r.q for r in files.read_npz_steps(spark, str(tmp_path / "e.npz"), "steps", {"q": 2}).orderBy("step").collect()] == [[1, 2], [3, 4]]
    head = json.dumps({"action/mean": {"dtype": "F32", "shape": [2], "data_offsets": [0, 8]}}).encode()
    (tmp_path / "s.safetensors").write_bytes(struct.pack("<Q", len(head)) + head + np.array([1.5, -2], "<f4").tobytes())
    r = files.read_safetensors(spark, str(tmp_path / "s.safetensors")).first()
    assert (r.name, r.shape, r["values"]) == ("action/mean", [2], [1.5, -2])
    nested = files.nested_stats({"action/mean": 1, "action/max": 2})
    assert nested == {"action": {"mean": 1, "max": 2}} and files.flat_stats(nested) == {"action/mean": 1, "action/max": 2}


def test_tfrecords(spark, tmp_path):
    assert files.masked_crc32c(b"") == 0xA282EAD8
    df = spark.createDataFrame([(7, [(1.5, [1.0, 2.0]), (2.5, [3.0, 4.0])], "go")], "ep long, steps array<struct<r:double,v:array<double>>>, text string")
    record = files.tfrecord_payload(df, ["ep", "steps", "text"]).first().record
    (tmp_path / "x.tfrecord").write_bytes(bytes(record) * 2)
    got = {(r.ordinal, r.feature): r.floats or r.longs or r["bytes"] for r in files.read_tfrecords(spark, str(tmp_path / "x.tfrecord")).collect()}
    assert got[(1, "steps/v")] == [1, 2, 3, 4] and got[(0, "ep")] == [7] and bytes(got[(0, "text")][0]) == b"go"
    broken = bytearray(record)
    broken[20] ^= 1
    with pytest.raises(ValueError):
        list(files.records(bytes(broken)))


def test_ingest_takes_each_file_once(spark, frames, tmp_path):
    source, target, ledger = (f"{tmp_path}/{x}" for x in ("in", "out", "ck"))
    for k in range(2):
        frames.where(f"episode_index % 2 = {k}").write.mode("append").parquet(source)
        ingest.ingest_new(spark, source, frames.schema, target, ledger)
    assert contents(spark.read.parquet(target)) == contents(frames)


def test_sessions(spark, sf):
    e = spark.read.parquet(f"{sf}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    s = ingest.session_stats(e, "user_id", "ts", "value")
    assert s.agg(F.sum("n")).first()[0] == e.count()
    assert ingest.tumbling_counts(e, "ts", "1 day", "event_type").agg(F.sum("n")).first()[0] == e.count()


