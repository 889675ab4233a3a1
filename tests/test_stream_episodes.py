"""Streaming gripper states and no-ops against the batch operators, over a restart, with late frames."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from framewright.operators import trajectory
from framewright.operators.trajectory import Frames
from framewright.streaming import episodes

SCHEMA = "episode string, ts long, id long, grip double, move double, arm double, arrived timestamp"
START = datetime(2024, 1, 1)


def made(seed):
    rng = random.Random(seed)
    rows = []
    for e, n in (("a", 60), ("b", 1), ("c", 33), ("still", 12)):
        for t in range(n):
            grip = 0.5 if e == "still" else rng.choice([0.0, 0.5, 0.5, 0.5, 1.0, None])
            move = None if e == "still" else rng.choice([0.0, 0.0, 0.0, 0.2, -0.2, None])
            rows.append((e, t // 2, t, grip, move, rng.choice([0.0, 0.0, 1.0, None])))
    return rows


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    at = tmp_path_factory.mktemp("stream")
    rows = made(1)
    rng = random.Random(2)
    # Out of order by up to 3 of the episodes' clock, in batches; each batch a file that arrives a minute later.
    order = sorted(rows, key=lambda r: r[1] + rng.uniform(0, 3))
    size = 20
    batches = [order[k : k + size] for k in range(0, len(order), size)]
    late = [("a", 0, 1000, 1.0, 0.0, 0.0), ("c", 1, 1001, 0.0, 0.0, 0.0)]
    batches[-1] = batches[-1] + late
    # Long after, one frame of another episode: all others close.
    stream = lambda: episodes.frame_states(spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{at}/in"), "episode", "ts", "id", "grip", "move", "arm", "arrived", 3, 600_000)

    def put(k, batch, minutes):
        when = START + timedelta(minutes=minutes)
        spark.createDataFrame([(*r, when) for r in batch], SCHEMA).coalesce(1).write.mode("append").parquet(f"{at}/in")

    places = (f"{at}/out", f"{at}/late", f"{at}/checkpoint")
    half = len(batches) // 2
    for k, b in enumerate(batches[:half]):
        put(k, b, k)
    episodes.by_batches(stream, *places)
    for k, b in enumerate(batches[half:], half):
        put(k, b, k)
    put(99, [("z", 0, 0, 0.5, 0.0, 0.0)], 1000)
    put(100, [("z", 1, 1, 0.5, 0.0, 0.0)], 1001)
    episodes.by_batches(stream, *places)
    return rows, late, places


def test_equals_the_batch_operators(spark, run):
    rows, _, places = run
    f = Frames("episode", ["ts", "id"])
    df = spark.createDataFrame(rows, "episode string, ts long, id long, grip double, move double, arm double")
    want = df.select(
        "episode", "ts", "id", trajectory.binarize_gripper(F.col("grip"), f).alias("state"), trajectory.relative_to_absolute_gripper(F.col("move"), f).alias("absolute"),
        trajectory.is_noop(F.col("arm"), F.col("grip"), f).alias("noop"),
    )
    key = lambda r: (r[0], r[2])
    got = [tuple(r) for r in spark.read.parquet(places[0]).where("episode <> 'z'").select("episode", "ts", "id", "state", "absolute", "noop").collect()]
    assert sorted(got, key=key) == sorted((tuple(r) for r in want.collect()), key=key)


def test_late_frames_go_aside(spark, run):
    _, late, places = run
    assert sorted((r.episode, r.ts, r.id) for r in spark.read.parquet(places[1]).collect()) == sorted(r[:3] for r in late)
