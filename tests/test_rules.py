"""Every dataset rule on native steps of its shape, against numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from framewright.operators.trajectory import Frames
from framewright.plans import registry

EP = Frames("e", "t")
rng = np.random.default_rng(12)
N = 5
WORLD = {"world_vector": 3, "rotation_delta": 3}
TEXT = "natural_language_instruction"


def carried(g, threshold=0.1):
    """Relative gripper moves as 1 open, 0 closed."""
    moves = [1.0 if x < -threshold else -1.0 if x > threshold else None for x in g]
    first = next((m for m in moves if m), None)
    out, at = [], None if first is None else -first
    for m in moves:
        at = m if m is not None else at
        out.append([1.0 if at is None else at / 2 + 0.5])
    return np.array(out)


def reached(g, high=0.95, low=0.05):
    out, nxt = [], g[-1]
    for x in g[::-1]:
        nxt = 1.0 if x > high else 0.0 if x < low else nxt
        out.append([nxt])
    return np.array(out[::-1])


def rpy(q):
    x, y, z, w = (q / np.linalg.norm(q, axis=1, keepdims=True)).T
    return np.stack([np.arctan2(2 * (w * x + y * z), 1 - 2 * (x * x + y * y)), np.arcsin(np.clip(2 * (w * y - z * x), -1, 1)), np.arctan2(2 * (w * z + x * y), 1 - 2 * (y * y + z * z))], axis=1)


def clip(x):
    return np.clip(x, 0, 1)


def zeros(n):
    return np.zeros((N, n))


cat = lambda *parts: np.concatenate(parts, axis=1)
one = lambda x: x[:, None]

# rule: (observation, action, expected columns); a shape is a vector's width, 0 a scalar, or fields with such.
S8, A7 = {"state": 8}, 7
CASES = {
    "ppgm": ({"cartesian_position": 8, "gripper_position": 2}, 7, lambda o, a: {"action": cat(a[:, :6], reached(a[:, -1])), "eef_state": o["cartesian_position"][:, :6], "gripper_state": o["gripper_position"][:, -1:]}),
    "tdroid": ({"cartesian_position": 6, "gripper_position": 1}, 7, lambda o, a: {"action": cat(a[:, :6], reached(a[:, -1])), "eef_state": o["cartesian_position"], "gripper_state": o["gripper_position"]}),
    "kuka": ({TEXT: "text"}, WORLD | {"gripper_closedness_action": 1}, lambda o, a: {"action": cat(a["world_vector"], a["rotation_delta"], carried(a["gripper_closedness_action"][:, 0]))}),
    "nyu_door_opening": ({TEXT: "text"}, WORLD | {"gripper_closedness_action": 1}, lambda o, a: {"action": cat(a["world_vector"], a["rotation_delta"], carried(a["gripper_closedness_action"][:, 0]))}),
    "jaco_play": ({TEXT: "text", "end_effector_cartesian_pos": 7}, WORLD | {"gripper_closedness_action": 1}, lambda o, a: {"action": cat(a["world_vector"], zeros(3), carried(a["gripper_closedness_action"][:, 0])), "eef_state": o["end_effector_cartesian_pos"][:, :6], "gripper_state": o["end_effector_cartesian_pos"][:, -1:]}),
    "berkeley_cable_routing": ({TEXT: "text"}, WORLD, lambda o, a: {"action": cat(a["world_vector"], a["rotation_delta"], zeros(1))}),
    "roboturk": ({TEXT: "text"}, WORLD | {"gripper_closedness_action": 1}, lambda o, a: {"action": cat(a["world_vector"], a["rotation_delta"], 1 - clip(a["gripper_closedness_action"]))}),
    "viola": ({TEXT: "text"}, WORLD | {"gripper_closedness_action": 0}, lambda o, a: {"action": cat(a["world_vector"], a["rotation_delta"], 1 - clip(one(a["gripper_closedness_action"])))}),
    "berkeley_autolab_ur5": ({TEXT: "text", "robot_state": 15}, WORLD | {"gripper_closedness_action": 0}, lambda o, a: {"state": o["robot_state"][:, 6:14], "action": cat(a["world_vector"], a["rotation_delta"], carried(a["gripper_closedness_action"]))}),
    "toto": ({TEXT: "text"}, WORLD | {"open_gripper": 0}, lambda o, a: {"action": cat(a["world_vector"], a["rotation_delta"], one(a["open_gripper"]))}),
    "pusht": ({TEXT: "text"}, WORLD | {"gripper_closedness_action": 0}, lambda o, a: {"action": cat(a["world_vector"], a["rotation_delta"], one(a["gripper_closedness_action"]))}),
    "stanford_kuka_multimodal": ({"x": 1}, 4, lambda o, a: {"action": cat(a[:, :3], zeros(3), a[:, -1:])}),
    "nyu_rot": (S8, 9, lambda o, a: {"action": a[:, :7], "eef_state": o["state"][:, :6], "gripper_state": o["state"][:, -1:]}),
    "stanford_hydra": ({"state": 14}, 7, lambda o, a: {"action": cat(a[:, :6], 1 - a[:, -1:]), "eef_state": cat(o["state"][:, :3], o["state"][:, 7:10]), "gripper_state": o["state"][:, -3:-2]}),
    "austin_buds": ({"state": 24}, 7, lambda o, a: {"action": cat(a[:, :6], 1 - clip(a[:, -1:])), "state": o["state"][:, :8]}),
    "nyu_franka_play": ({"state": 13}, 15, lambda o, a: {"eef_state": o["state"][:, -6:], "action": cat(a[:, -8:-2], clip(a[:, -2:-1]))}),
    "maniskill": ({"state": 18}, 7, lambda o, a: {"gripper_state": o["state"][:, 7:8]}),
    "furniture_bench": ({"state": 35}, 8, lambda o, a: {"state": cat(o["state"][:, :7], o["state"][:, -1:]), "action": cat(a[:, :3], rpy(a[:, 3:7]), 1 - clip(a[:, -1:]))}),
    "cmu_franka_exploration": ({"x": 1}, 8, lambda o, a: {"action": a[:, :-1]}),
    "ucsd_kitchen": ({"state": 21}, 8, lambda o, a: {"joint_state": o["state"][:, :7], "action": a[:, :-1]}),
    "ucsd_pick_place": (S8, 4, lambda o, a: {"eef_state": o["state"][:, :6], "gripper_state": o["state"][:, -1:], "action": cat(a[:, :3], zeros(3), a[:, -1:])}),
    "austin_sailor": (S8, 7, lambda o, a: {"action": cat(a[:, :6], 1 - clip(a[:, -1:]))}),
    "austin_sirius": (S8, 7, lambda o, a: {"action": cat(a[:, :6], 1 - clip(a[:, -1:]))}),
    "tokyo_pr2_opening_fridge": ({"state": 7}, 8, lambda o, a: {"eef_state": o["state"][:, :6], "gripper_state": o["state"][:, -1:], "action": a[:, :-1]}),
    "tokyo_pr2_tabletop_manipulation": ({"state": 7}, 8, lambda o, a: {"eef_state": o["state"][:, :6], "gripper_state": o["state"][:, -1:], "action": a[:, :-1]}),
    "utokyo_xarm_pick_place": (S8, 7, lambda o, a: {"action": a}),
    "utokyo_xarm_bimanual": (S8, 14, lambda o, a: {"action": a[:, -7:]}),
    "robo_net": ({"state": 5}, 5, lambda o, a: {"eef_state": cat(o["state"][:, :4], zeros(2)), "gripper_state": o["state"][:, -1:], "action": cat(a[:, :4], zeros(2), a[:, -1:])}),
    "berkeley_mvp": ({"gripper": 0}, 8, lambda o, a: {"gripper": one(o["gripper"]), "action": a}),
    "berkeley_rpt": ({"gripper": 0}, 8, lambda o, a: {"gripper": one(o["gripper"]), "action": a}),
    "kaist_nonprehensible": ({"state": 21}, 20, lambda o, a: {"state": o["state"][:, -7:], "action": cat(a[:, :6], zeros(1))}),
    "stanford_mask_vit": ({"end_effector_pose": 5}, 5, lambda o, a: {"eef_state": cat(o["end_effector_pose"][:, :4], zeros(2)), "gripper_state": o["end_effector_pose"][:, -1:], "action": cat(a[:, :4], zeros(2), a[:, -1:])}),
    "tokyo_lsmo": ({"state": 13}, 7, lambda o, a: {"eef_state": o["state"][:, :6], "gripper_state": o["state"][:, -1:]}),
    "dlr_sara_pour": ({"state": 6}, 7, lambda o, a: {"action": a}),
    "dlr_sara_grid_clamp": ({"state": 12}, 7, lambda o, a: {"state": o["state"][:, :6]}),
    "dlr_edan_shared_control": ({"state": 7}, 7, lambda o, a: {"action": cat(a[:, :6], 1 - a[:, -1:])}),
    "robocook": ({"state": 7}, 7, lambda o, a: {"eef_state": o["state"][:, :6], "gripper_state": o["state"][:, -1:]}),
    "imperial_wristcam": ({"x": 1}, 8, lambda o, a: {"action": a[:, :-1]}),
    "iamlab_pick_insert": ({"state": 20}, 8, lambda o, a: {"joint_state": o["state"][:, :7], "gripper_state": o["state"][:, 7:8], "action": cat(a[:, :3], rpy(a[:, 3:7]), a[:, 7:8])}),
    "uiuc_d3field": ({"x": 1}, 3, lambda o, a: {"action": cat(a, zeros(3), zeros(1))}),
    "utaustin_mutex": ({"state": 24}, 7, lambda o, a: {"state": o["state"][:, :8], "action": cat(a[:, :6], 1 - clip(a[:, -1:]))}),
    "berkeley_fanuc": ({"state": 13}, 6, lambda o, a: {"joint_state": o["state"][:, :6], "gripper_state": o["state"][:, 6:7], "action": cat(a, 1 - o["state"][:, 6:7])}),
    "cmu_playing_with_food": ({"x": 1}, 8, lambda o, a: {"action": cat(a[:, :3], rpy(a[:, 3:7]), a[:, -1:])}),
    "playfusion": ({"x": 1}, 9, lambda o, a: {"action": cat(a[:, :3], a[:, -4:])}),
    "cmu_stretch": ({"state": 4}, 8, lambda o, a: {"eef_state": cat(o["state"][:, :3], zeros(3)), "gripper_state": o["state"][:, -1:], "action": a[:, :-1]}),
    "gnm": ({"position": 2, "yaw": 1}, 2, lambda o, a: {"state": cat(o["position"], zeros(3), o["yaw"]), "action": cat(a, zeros(2), zeros(2), zeros(1))}),
    "fmb": ({"eef_pose": 7, "state_gripper_pose": 0}, 7, lambda o, a: {"proprio": cat(o["eef_pose"], one(o["state_gripper_pose"]))}),
    "dobbe": ({"state": 7}, 7, lambda o, a: {"eef_state": o["state"][:, :6], "gripper_state": o["state"][:, -1:]}),
    "roboset": ({"state": 8}, 8, lambda o, a: {"proprio": o["state"], "action": cat(a[:, :7], 1 - clip(a[:, -1:]))}),
    "rh20t": ({"tcp_base": 7, "gripper_width": 0}, {"tcp_base": 7, "gripper": 0}, lambda o, a: {"action": cat(a["tcp_base"], one(a["gripper"])), "proprio": cat(o["tcp_base"], one(o["gripper_width"]))}),
    "libero": (S8, 7, lambda o, a: {"action": cat(a[:, :6], 1 - clip(a[:, -1:])), "eef_state": o["state"][:, :6], "gripper_state": o["state"][:, -2:]}),
    "language_table": ({"instruction": "points"}, 2, lambda o, a: {"action": cat(a, zeros(2), zeros(2), np.ones((N, 1)))}),
}


def native(shape):
    if isinstance(shape, dict):
        return {k: native(v) for k, v in shape.items()}
    if shape == "text":
        return np.array([f"do {k}" for k in range(N)])
    if shape == "points":
        return np.array([[104, 105, 0, 0]] * N)
    return rng.uniform(-1.3, 1.3, (N, shape) if shape else N)


def ddl(shape):
    if isinstance(shape, dict):
        return "struct<" + ", ".join(f"{k}: {ddl(v)}" for k, v in shape.items()) + ">"
    return {"text": "string", "points": "array<int>"}.get(shape, "array<double>" if shape else "double")


def at(values, t):
    return {k: at(v, t) for k, v in values.items()} if isinstance(values, dict) else values[t].tolist()


@pytest.mark.parametrize("rule", list(CASES))
def test_rule(spark, rule):
    observation, action, expected = CASES[rule]
    o, a = native(observation), native(action)
    rows = [(1, t, at(o, t), at(a, t)) for t in range(N)]
    df = spark.createDataFrame(rows, f"e int, t int, observation {ddl(observation)}, action {ddl(action)}")
    got = registry.RULES[rule].apply(df, EP).orderBy("t").collect()
    assert len(got) == N
    for name, want in expected(o, a).items():
        assert np.allclose([r[name] for r in got], want, atol=1e-12), name
    if TEXT in observation:
        assert [r.language_instruction for r in got] == o[TEXT].tolist()


def test_every_rule_has_a_case():
    grouped = {"droid", "bridge_oxe", "bridge_orig", "rt1", "taco_play", "bc_z", "asu_table_top", "identity"}
    assert set(registry.RULES) - set(CASES) == grouped


def test_table_top_takes_ground_truth(spark):
    df = spark.createDataFrame([(1, 0, {"state": [1.0, 2.0]}, [0.0] * 7, {"EE": [3.0] * 6})], "e int, t int, observation struct<state: array<double>>, action array<double>, ground_truth_states struct<EE: array<double>>")
    r = registry.RULES["asu_table_top"].apply(df, EP).first()
    assert r.eef_state == [3.0] * 6 and r.gripper_state == [2.0]
    assert registry.RULES["identity"].apply(df, EP).select(F.count("*")).first()[0] == 1
