"""Files bounded by their real sizes: pointers and sizes against what lies on disk, and what a failed task leaves."""

import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from framewright.sources import sized


def frames(spark, lengths):
    rows = [(e, t) for e, n in enumerate(lengths) for t in range(n)]
    df = spark.createDataFrame(rows, "episode_index long, frame_index long")
    return df.withColumn("state", F.transform(F.sequence(F.lit(0), F.lit(20)), lambda k: F.sin(F.col("episode_index") * 7 + F.col("frame_index") * k)))


def on_disk(root):
    return sorted(f"{d}/{f}"[len(str(root)) + 1 :] for d, _, fs in os.walk(f"{root}/data") for f in fs if f.endswith(".parquet"))


def test_pointers_say_where_rows_lie(spark, tmp_path):
    lengths = [30, 1, 200, 45, 45, 2, 3, 90, 10, 60, 700, 5]
    limit = 60_000
    df = frames(spark, lengths)
    episodes = {r.episode_index: r for r in sized.write_sized(df, f"file://{tmp_path}", limit, files_per_chunk=2, parts=3).collect()}
    files = spark.read.parquet(f"{tmp_path}/meta/files").collect()
    assert on_disk(tmp_path) == sorted(f.path for f in files) and len(files) > 3
    assert [e for e in sorted(episodes)] == list(range(12)) and [episodes[e].length for e in range(12)] == lengths
    at = 0
    for e in range(12):
        assert (episodes[e].dataset_from_index, episodes[e].dataset_to_index) == (at, at + lengths[e])
        at += lengths[e]
    for f in files:
        table = pq.read_table(tmp_path / f.path)
        held = [r for r in episodes.values() if (r["data/chunk_index"], r["data/file_index"]) == (f.chunk_index, f.file_index)]
        assert os.path.getsize(tmp_path / f.path) == f.bytes and table.num_rows == f.rows == sum(r.length for r in held)
        assert f.bytes < limit or len(held) == 1
        for r in held:
            part = table.slice(r.from_row, r.length)
            assert set(part.column("episode_index").to_pylist()) == {r.episode_index} and part.column("frame_index").to_pylist() == list(range(r.length))
    back = spark.read.option("recursiveFileLookup", True).parquet(f"{tmp_path}/data")
    assert back.count() == sum(lengths) and back.exceptAll(df).count() == 0
    order = sorted(files, key=lambda f: (f.chunk_index, f.file_index))
    assert [f.path for f in order[:3]] == ["data/chunk-000/file-000.parquet", "data/chunk-000/file-001.parquet", "data/chunk-001/file-000.parquet"]


def test_a_failed_task_leaves_no_visible_file(spark, tmp_path):
    bad = frames(spark, [50] * 8).withColumn("state", F.when((F.col("episode_index") == 6) & (F.col("frame_index") == 40), F.raise_error(F.lit("broken frame")).cast("array<double>")).otherwise(F.col("state")))
    with pytest.raises(Exception, match="broken frame"):
        sized.write_sized(bad, f"file://{tmp_path}", 20_000, parts=4)
    assert on_disk(tmp_path) == [] and not os.path.exists(tmp_path / "meta") and not [f for f in os.listdir(tmp_path) if f.startswith("_staged")]


def test_no_frames(spark, tmp_path):
    assert sized.write_sized(frames(spark, [3]).limit(0), f"file://{tmp_path}", 1000).collect() == []


def test_a_file_for_each_episode(spark, tmp_path):
    df = frames(spark, [3, 5, 1, 4]).withColumn("episode_index", F.col("episode_index") * 7)
    got = {r.path: (r.rows, r.bytes) for r in sized.write_each(df, f"file://{tmp_path}", per_chunk=10, parts=2).collect()}
    assert on_disk(tmp_path) == sorted(got) == ["data/chunk-000/episode_000000.parquet", "data/chunk-000/episode_000007.parquet", "data/chunk-001/episode_000014.parquet", "data/chunk-002/episode_000021.parquet"]
    for path, (rows, size) in got.items():
        assert os.path.getsize(tmp_path / path) == size and pq.read_table(tmp_path / path).num_rows == rows
