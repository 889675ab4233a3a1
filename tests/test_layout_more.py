"""Split strings, legacy statistics, features by name and kind, filters."""

import json

import pytest
from pyspark.sql import functions as F

from framewright.operators import meta
from framewright.plans import layout


def picked(spark, total, split):
    return [r.id for r in spark.range(total).where(meta.in_split(F.col("id"), total, split)).orderBy("id").collect()]


@pytest.mark.parametrize(
    "split, low, high",
    [("train", 0, 37), ("train[3:8]", 3, 8), ("train[:-5]", 0, 32), ("train[-4:]", 33, 37), ("train[0%:25%]", 0, 9), ("train[25%:50%]", 9, 19), ("train[50%:]", 19, 37), ("train[-10%:]", 33, 37), ("train[30:99]", 30, 37), ("train[5:5]", 0, 0)],
)
def test_split_strings(spark, split, low, high):
    assert picked(spark, 37, split) == list(range(low, high))


def test_splits_cover_everything_once(spark):
    shares = [picked(spark, 101, f"train[{k}%:{k + 10}%]") for k in range(0, 100, 10)]
    assert [i for s in shares for i in s] == list(range(101))
    assert picked(spark, 10, "train[:2] + test[8:]") == [0, 1, 8, 9]
    for bad in ("train[", "train[1]", "train[200%:]"):
        with pytest.raises(ValueError):
            meta.in_split(F.lit(1), 10, bad)


def test_legacy_statistics(spark, tmp_path):
    rows = [(e, [float(e)], [e + 1.0, 2.0], [0.5], [9], [7.0]) for e in (2, 0, 1)]
    df = spark.createDataFrame(rows, "episode_index long, `stats/obs.state/min` array<double>, `stats/obs.state/max` array<double>, `stats/act/mean` array<double>, `stats/act/count` array<long>, `stats/act/q50` array<double>")
    layout.write_legacy_stats(df, str(tmp_path))
    lines = [json.loads(r.value) for r in spark.read.text(f"{tmp_path}/meta/episodes_stats").collect()]
    assert sorted(lines, key=lambda x: x["episode_index"])[1] == {"episode_index": 1, "stats": {"obs.state": {"min": [1.0], "max": [2.0, 2.0]}, "act": {"mean": [0.5], "count": [9]}}}
    got = {(r.episode_index, r.feature, r.statistic): r["values"] for r in layout.read_legacy_stats(spark, str(tmp_path)).collect()}
    assert got[2, "obs.state", "max"] == [3.0, 2.0] and got[0, "act", "count"] == [9.0] and len(got) == 12


def test_nested_statistics_are_flat(spark, tmp_path):
    (tmp_path / "meta").mkdir()
    (tmp_path / "meta" / "episodes_stats").mkdir()
    (tmp_path / "meta" / "episodes_stats" / "a.json").write_text(json.dumps({"episode_index": 4, "stats": {"image": {"mean": [[[0.5]], [[0.25]], [[1e-3]]], "count": [12]}}}) + "\n")
    got = {r.statistic: r["values"] for r in layout.read_legacy_stats(spark, str(tmp_path)).collect()}
    assert got == {"mean": [0.5, 0.25, 0.001], "count": [12.0]}


def test_features_by_name_and_kind(spark):
    df = spark.createDataFrame([(1.0, [2.0], "x", 3)], "`observation.images.top` double, `observation.state.left.arm` array<double>, `task` string, `n` int")
    renamed = layout.rename_features(df, {"n": "count"})
    assert renamed.columns == ["top", "left_arm", "task", "count"]
    assert layout.features_of(renamed, ("double",)).columns == ["top", "left_arm"]
    with pytest.raises(ValueError, match="share a name"):
        layout.rename_features(df, {"n": "task"})


def test_yaml_sessions(spark, tmp_path):
    pytest.importorskip("yaml")
    from framewright.sources import files

    for name, text in (("s1", "language_instruction: fold it\npolicies:\n  A: {binary_success: 1, duration: 2.5}\nwhen: 2024-05-01\n"), ("s2", "# nothing\n"), ("s3", "a: [1")):
        (tmp_path / name).mkdir()
        (tmp_path / name / "metadata.yaml").write_text(text)
    got = {r.path.split("/")[-2]: r for r in files.read_yaml(spark, str(tmp_path)).select("*", F.get_json_object("json", "$.policies.A.duration").alias("duration")).collect()}
    assert got["s1"].duration == "2.5" and json.loads(got["s1"].json)["when"] == "2024-05-01" and got["s2"].json == "{}" and got["s3"].json is None and got["s3"].error


def test_filters(spark):
    e = spark.createDataFrame([(1, 0, "a", True), (2, 3, "a", None), (3, 3, "k", None), (4, 3, "k", False), (5, 3, "k", True), (6, None, "a", True), (7, 3, None, None)], "e int, length int, dataset string, success boolean")
    assert sorted(r.e for r in meta.keep_episodes(e, F.col("length"), F.col("dataset"), F.col("success"), ["k"]).collect()) == [2, 5, 7]
    present = spark.createDataFrame([(2, "top"), (2, "wrist"), (2, "wrist"), (3, "top"), (3, "other")], "e int, camera string")
    assert [r.e for r in meta.with_all_present(e, present, "e", "camera", ["wrist", "top"]).collect()] == [2]
    assert meta.with_all_present(e, present, "e", "camera", []).count() == 7
    names = spark.createDataFrame([("ARX5", "Fold Towel"), ("arx5", None), ("ur5", "towel")], "robot string, task string")
    assert meta.matching(names, {"robot": "Arx5"}, {"task": "TOWEL"}).count() == 1 and meta.matching(names, {"robot": None}, {"task": None}).count() == 3
