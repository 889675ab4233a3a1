"""HDF5 files made by a small writer, read back as tables."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from framewright.operators import resample
from framewright.sources import hdf5

from hdf5_writer import write

rng = np.random.default_rng(3)


@pytest.fixture(scope="module")
def demos(tmp_path_factory):
    """Two files of demos as simulators record them: several episodes a file, images beside states."""
    at, made = tmp_path_factory.mktemp("demos"), {}
    for k in range(2):
        data = {}
        for e, n in enumerate([7, 40, 1][: 3 - k]):
            obs = {
                "ee_states": (rng.normal(size=(n, 6)), {"chunk": (3, 4), "filters": (2, 1, 3)}),
                "gripper_states": (rng.normal(size=(n, 2)).astype("f4"), {"chunk": (16, 2), "filters": (1,)}),
                "joint_states": rng.normal(size=(n, 7)).astype(">f8"),
                "agentview_rgb": (rng.integers(0, 256, (n, 4, 5, 3)).astype("u1"), {"chunk": (1, 4, 5, 3), "filters": (1,)}),
            }
            data[f"demo_{e}"] = {"obs": obs, "actions": rng.uniform(-1, 1, (n, 7)), "dones": (np.arange(n) == n - 1)}
        write(at / f"task_{k}.hdf5", {"data": data}, {"problem_info": np.array(json.dumps({"language_instruction": f"put {k}"}), object), "total": np.array([3, k])})
        made[k] = data
    (at / "broken.hdf5").write_bytes(b"\x89HDF\r\n\x1a\nno more")
    (at / "other.hdf5").write_bytes(b"plain text")
    return at, made


def plain(v):
    return v[0] if isinstance(v, tuple) else v


def test_objects_and_errors(spark, demos):
    at, made = demos
    found = hdf5.objects(hdf5.files(spark, str(at))).collect()
    good = {(r.path.rsplit("/", 1)[1], r.dataset): r for r in found if not r.error}
    assert len(good) == 5 * 6
    r = good["task_0.hdf5", "data/demo_1/obs/ee_states"]
    assert r.shape == [40, 6] and r.dtype == "<f8" and r.chunk == [3, 4] and [(f.id, f.arg) for f in r.filters] == [(2, 8), (1, 4), (3, 0)]
    assert [s.row for s in r.slabs] == list(range(0, 40, 3)) and len(r.slabs[0].chunks) == 2
    bad = {r.path.rsplit("/", 1)[1]: r.error for r in found if r.error}
    assert set(bad) == {"broken.hdf5", "other.hdf5"} and all(e.startswith("Unsupported") for e in bad.values()), bad


def test_every_dataset_reads_back(spark, demos):
    at, made = demos
    found = hdf5.objects(hdf5.files(spark, str(at)))
    got = {}
    for r in hdf5.rows(found).collect():
        got.setdefault((r.path.rsplit("/", 1)[1], r.dataset), {})[r.row] = r.value
    for k, data in made.items():
        for demo, parts in data.items():
            flat = {**{f"obs/{n}": v for n, v in parts["obs"].items()}, "actions": parts["actions"], "dones": parts["dones"]}
            for name, v in flat.items():
                v = plain(v)
                rows = got[f"task_{k}.hdf5", f"data/{demo}/{name}"]
                assert [rows[i] for i in range(len(v))] == np.asarray(v, float).reshape(len(v), -1).tolist()


def test_frames_of_demos(spark, demos):
    """A reader of such demos: state of pose and gripper, action with the gripper turned to 0 closed, 1 open."""
    at, made = demos
    found = hdf5.objects(hdf5.files(spark, str(at), "task_*.hdf5"))
    f = hdf5.frames(found, "data/([^/]+)/", {"obs/ee_states": "ee", "obs/gripper_states": "grip", "actions": "action"})
    turned = F.concat(F.slice("action", 1, 6), F.array(1 - F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.element_at("action", -1)))))
    out = {(r.path.rsplit("/", 1)[1], r.episode, r.row): r for r in f.select("path", "episode", "row", F.concat("ee", "grip").alias("state"), turned.alias("action")).collect()}
    assert len(out) == sum(len(plain(p["actions"])) for d in made.values() for p in d.values())
    for k, data in made.items():
        for demo, p in data.items():
            for i, a in enumerate(p["actions"]):
                r = out[f"task_{k}.hdf5", demo, i]
                assert r.state == pytest.approx([*plain(p["obs"]["ee_states"])[i], *plain(p["obs"]["gripper_states"])[i].astype(float)])
                assert r.action == pytest.approx([*a[:6], 1 - min(max(a[6], 0), 1)])


def test_attributes_and_text(spark, tmp_path):
    texts = np.array(["pick up", "", "ünder the table " * 9], object)
    write(tmp_path / "a.h5", {"lang": texts, "fixed": np.array([b"ab", b"c"], "S5"), "empty": np.zeros((0, 3))}, {"env": np.array("kitchen", object), "fps": np.array(20), "name": np.array(b"arm", "S8")})
    listed = hdf5.files(spark, str(tmp_path))
    assert {(r.name, r.value) for r in hdf5.attributes(listed).collect()} == {("env", "kitchen"), ("fps", "20"), ("name", "arm")}
    found = hdf5.objects(listed)
    text = {(r.dataset, r.row): r.value for r in hdf5.rows(found.where("dataset in ('lang', 'fixed')"), "string").collect()}
    assert [text["lang", i] for i in range(3)] == texts.tolist() and [text["fixed", i] for i in range(2)] == ["ab", "c"]
    assert hdf5.rows(found.where("dataset = 'empty'")).count() == 0


def test_images_as_bytes_and_only_what_is_asked_for(spark, demos, tmp_path):
    at, made = demos
    image = plain(made[0]["demo_0"]["obs"]["agentview_rgb"])
    raw = bytearray((at / "task_0.hdf5").read_bytes())
    found = hdf5.objects(hdf5.files(spark, str(at), "task_0.hdf5")).where("dataset like 'data/demo_0/%'")
    got = {r.row: r.value for r in hdf5.rows(found.where("dataset like '%rgb'"), "binary").collect()}
    assert [bytes(got[i]) for i in range(7)] == [v.tobytes() for v in image]
    # Spoil every image chunk: states still read, images don't.
    for r in found.where("dataset like '%rgb'").collect():
        for s in r.slabs:
            for c in s.chunks:
                raw[c.at : c.at + c.size] = b"\xff" * c.size
    (tmp_path / "spoilt.hdf5").write_bytes(bytes(raw))
    spoilt = hdf5.objects(hdf5.files(spark, str(tmp_path))).where("dataset like 'data/demo_0/%'")
    assert hdf5.rows(spoilt.where("dataset like '%ee_states'")).count() == 7
    with pytest.raises(Exception, match="zlib|decompress"):
        hdf5.rows(spoilt.where("dataset like '%rgb'"), "binary").collect()


def test_statuses_instead_of_failures(spark, tmp_path):
    write(tmp_path / "whole.h5", {"puppet": {"arm": np.zeros((3, 2))}, "master": {"arm": np.ones((3, 2))}})
    write(tmp_path / "half.h5", {"puppet": {"arm": np.zeros((3, 2))}})
    (tmp_path / "bad.h5").write_bytes(b"\0")
    got = {r.path.rsplit("/", 1)[1]: (r.ok, r.error) for r in hdf5.statuses(hdf5.objects(hdf5.files(spark, str(tmp_path))), ["puppet/arm", "master/arm"]).collect()}
    assert got["whole.h5"] == (True, None) and got["half.h5"] == (False, "KeyError: master/arm") and not got["bad.h5"][0]


def test_short_actions_are_laid_over_states(spark, tmp_path):
    """Recordings whose action series is short, empty or too long, repaired by the recorded index."""
    state = {"1": np.arange(6.0), "2": np.arange(4.0), "3": np.arange(3.0), "4": np.arange(2.0)}
    action = {"1": np.array([-1.0, -3.0]), "2": np.zeros(0), "3": -np.arange(3.0), "4": np.zeros(5)}
    index = {"1": np.array([1, 4]), "2": np.zeros(0, int), "3": np.arange(3), "4": np.arange(5)}
    for k in state:
        write(tmp_path / f"{k}.h5", {"state": {"p": state[k][:, None]}, "action": {"p": action[k][:, None], "index": index[k][:, None]}})
    found = hdf5.objects(hdf5.files(spark, str(tmp_path))).withColumn("ep", F.regexp_extract("path", r"(\d)\.h5$", 1))
    read = lambda name: hdf5.rows(found.where(f"dataset = '{name}'").drop("ep")).select(F.regexp_extract("path", r"(\d)\.h5$", 1).alias("ep"), "row", F.col("value")[0].alias("v"))
    s, a, i = read("state/p"), read("action/p"), read("action/index")
    fixed = resample.repair_lengths(s.withColumnRenamed("row", "frame"), a.withColumnRenamed("row", "position"), i.select("ep", F.col("row").alias("position"), F.col("v").cast("long").alias("frame")), "ep", "frame", "v", F.lit(0.0))
    got = {}
    for r in fixed.orderBy("ep", "frame").collect():
        got.setdefault(r.ep, []).append(r.v)
    assert got == {"1": [0.0, -1.0, 2.0, 3.0, -3.0, 5.0], "2": [0.0] * 4, "3": [0.0, -1.0, -2.0]}
