"""Datasets by name: rate, robot, encodings, and the rules that turn native steps into standard columns.

A step table has an episode column, frame_index, a struct ``observation`` and ``action`` (a vector or a struct). A rule
names output columns and how to make them; ``standardize`` applies a dataset's rule. Paths are written as
``observation.state[:6]``, slices as in Python. Five rules give the contract's groups raw_state, state, raw_target,
target and debug; the others give vectors ``action`` and observation columns. Pixels are not touched here: where native
images are turned or have their channels swapped, FLIPPED says so.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import signals, so3, text
from ..operators import trajectory
from ..operators.trajectory import Frames

Make = Callable[[Frames], Column]


def path(name: str) -> Make:
    """A field, or a slice of a vector field."""
    m = re.fullmatch(r"([^\[]+)(?:\[(-?\d*):(-?\d*)\])?", name)
    head, *rest = m[1].split(".", 1)
    full = head + "".join(f".`{r}`" for r in rest)
    if m[2] is None:
        return lambda f: F.col(full)
    return lambda f: signals.vector_slice(F.col(full), int(m[2] or 0), int(m[3]) if m[3] else None)


def _make(x: str | Make) -> Make:
    return path(x) if isinstance(x, str) else x


def cat(*parts) -> Make:
    made = [_make(p) for p in parts]
    return lambda f: F.concat(*[F.transform(p(f), lambda v: v.cast("double")) for p in made])


def fill(n: int, value: float = 0.0) -> Make:
    return lambda f: signals.zeros(n, value)


def like(x, value: float = 0.0) -> Make:
    """As wide as x."""
    return lambda f: F.transform(_make(x)(f), lambda v: F.lit(value))


def single(x) -> Make:
    """A scalar as a vector of one."""
    return lambda f: F.array(_make(x)(f).cast("double"))


def each(fn: Callable[[Column], Column], x) -> Make:
    return lambda f: F.transform(_make(x)(f), fn)


def inverted(x) -> Make:
    return each(signals.invert, x)


def inverted_clip(x) -> Make:
    return each(signals.invert_clipped, x)


def clipped(x) -> Make:
    return each(lambda v: signals.clip(v), x)


def rel2abs(x) -> Make:
    """Of the first dimension."""
    return lambda f: F.array(trajectory.relative_to_absolute_gripper(F.get(_make(x)(f), F.lit(0)), f))


def rel2abs_scalar(x) -> Make:
    return lambda f: F.array(trajectory.relative_to_absolute_gripper(_make(x)(f), f))


def binarized(x) -> Make:
    return lambda f: F.array(trajectory.binarize_gripper(F.get(_make(x)(f), F.lit(0)), f))


def euler_of_quaternion(x) -> Make:
    """Roll, pitch, yaw about fixed axes."""
    return lambda f: so3.bind(so3.quaternion_to_matrix(_make(x)(f)), lambda m: so3.matrix_to_rpy(m, extrinsic=True))


@dataclass(frozen=True)
class Rule:
    columns: dict[str, Make | str] = field(default_factory=dict)
    language: str | None = None
    then: Callable[[DataFrame, Frames], DataFrame] | None = None
    first: Callable[[DataFrame, Frames], DataFrame] | None = None

    def apply(self, df: DataFrame, f: Frames) -> DataFrame:
        if self.first:
            df = self.first(df, f)
        made = {k: _make(v)(f) for k, v in self.columns.items()}
        if self.language:
            made["language_instruction"] = _make(self.language)(f)
        df = df.withColumns(made) if made else df
        return self.then(df, f) if self.then else df


_NLI = "observation.natural_language_instruction"
_WORLD = ("action.world_vector", "action.rotation_delta")
_CLOSED = "action.gripper_closedness_action"


def _sliced(eef: str | None = "observation.state[:6]", grip: str | None = "observation.state[-1:]", **more) -> Rule:
    return Rule(({"eef_state": eef} if eef else {}) | ({"gripper_state": grip} if grip else {}) | more)


# --- rules with the contract's groups ------------------------------------------------------------
def _posed(df: DataFrame, name: str, R: Column, xyz: Column, robot: str, **more: Column) -> DataFrame:
    """A struct of xyz, the rotation (9 by rows) in the canonical gripper frame, and more."""
    align = so3.axis_alignment_matrix(*so3.ALIGNMENTS[robot])
    return df.withColumn(name, F.struct(xyz.alias("eef_xyz"), so3.bind(R, lambda m: so3.matmul(m, align, transpose_b=True)).alias("eef_rot9d"), *[c.alias(k) for k, c in more.items()]))


def _debugged(df: DataFrame, f: Frames) -> DataFrame:
    """debug: the true next move in the gripper frame."""
    flat = df.withColumns({"__p": F.col("state.eef_xyz"), "__R": F.col("state.eef_rot9d")})
    out = trajectory.next_pose_delta(flat, f, "__p", "__R")
    return out.withColumn("debug", F.struct("gripper_eef_xyz", "gripper_eef_rot6d")).drop("__p", "__R", "gripper_eef_xyz", "gripper_eef_rot6d")


def _struct(**columns: Column) -> Column:
    return F.struct(*[c.alias(k) for k, c in columns.items()])


def _of_pose_vectors(df: DataFrame, name: str, xyz: Column, rpy: Column, robot: str, gripper: Column, **more: Column) -> DataFrame:
    return _posed(df, name, so3.rpy_to_matrix(rpy, extrinsic=True), xyz, robot, **more, gripper_state=gripper)


def _droid(df: DataFrame, f: Frames) -> DataFrame:
    for raw, group, source in (("raw_state", "state", "observation"), ("raw_target", "target", "action_dict")):
        cart, joints, grip = (F.col(f"{source}.{c}") for c in ("cartesian_position", "joint_position", "gripper_position"))
        df = df.withColumn(raw, _struct(eef_xyz=signals.vector_slice(cart, 0, 3), eef_rpy=signals.vector_slice(cart, 3, 6), joint_pos=joints, gripper_state=grip))
        df = _of_pose_vectors(df, group, F.col(f"{raw}.eef_xyz"), F.col(f"{raw}.eef_rpy"), "franka", F.transform(grip, signals.invert), joint_pos=joints)
    texts = [F.col(c) for c in ("language_instruction", "language_instruction_2", "language_instruction_3") if c in df.columns]
    return _debugged(df.withColumn("language_instruction", text.first_nonempty(*texts)), f)


def _bridge(df: DataFrame, f: Frames) -> DataFrame:
    s = F.col("observation.state")
    grip = signals.vector_slice(s, 6, 7)
    df = df.withColumn("raw_state", _struct(eef_xyz=signals.vector_slice(s, 0, 3), eef_rpy=signals.vector_slice(s, 3, 6), gripper_state=grip))
    df = _of_pose_vectors(df, "state", F.col("raw_state.eef_xyz"), F.col("raw_state.eef_rpy"), "widowx", grip)
    a = signals.vector_slice(F.col("action"), 6, 7)
    df = df.withColumns({"raw_target": _struct(gripper_state=a), "target": _struct(gripper_state=F.array(trajectory.binarize_gripper(F.get(a, F.lit(0)), f)))})
    return _debugged(df, f)


def _rt1(df: DataFrame, f: Frames) -> DataFrame:
    pose, closed = F.col("observation.base_pose_tool_reached"), F.col("observation.gripper_closed")
    xyz, quat = signals.vector_slice(pose, 0, 3), signals.vector_slice(pose, 3, 7)
    df = df.withColumns({"raw_state": _struct(eef_xyz=xyz, eef_quat=quat, gripper_state=closed), "__R": so3.quaternion_to_matrix(quat)})
    df = _posed(df, "state", F.col("__R"), xyz, "google", gripper_state=F.transform(closed, signals.invert))
    opened = F.array(trajectory.relative_to_absolute_gripper(F.get(_CLOSED, F.lit(0)), f))
    df = df.withColumns({"__d": so3.rpy_to_matrix(F.col("action.rotation_delta"), extrinsic=True), "__open": opened})
    df = df.withColumn("__T", so3.matmul(F.col("__d"), F.col("__R")))
    to = signals.add_scaled(xyz, F.col("action.world_vector"))
    df = df.withColumn("raw_target", _struct(eef_xyz=to, eef_quat=so3.matrix_to_quaternion(F.col("__T")), gripper_state=F.transform("__open", signals.invert)))
    df = _posed(df, "target", F.col("__T"), to, "google", gripper_state=F.col("__open"))
    return _debugged(df.withColumn("language_instruction", F.col(_NLI)).drop("__R", "__d", "__T", "__open"), f)


def _taco(df: DataFrame, f: Frames) -> DataFrame:
    o, c = F.col("observation.robot_obs"), F.col("action.actions")
    cut = signals.vector_slice
    df = df.withColumn("raw_state", _struct(eef_xyz=cut(o, 0, 3), eef_rpy=cut(o, 3, 6), gripper_state=cut(o, 6, 7), joint_pos=cut(o, 7, 14)))
    df = _of_pose_vectors(df, "state", cut(o, 0, 3), cut(o, 3, 6), "franka", F.transform(cut(o, 6, 7), lambda x: signals.normalise_width(x, 0.08)), joint_pos=cut(o, 7, 14))
    df = df.withColumn("raw_target", _struct(eef_xyz=cut(c, 0, 3), eef_rpy=cut(c, 3, 6), gripper_state=cut(c, 6, 7)))
    df = _of_pose_vectors(df, "target", cut(c, 0, 3), cut(c, 3, 6), "franka", F.transform(cut(c, 6, 7), lambda x: signals.clip(x)))
    return _debugged(df.withColumn("language_instruction", F.col(_NLI)), f)


def _bc_z(df: DataFrame, f: Frames) -> DataFrame:
    at = lambda s, k: F.col(f"{s}.`{k}`")
    xyz, turn, closed = at("observation", "present/xyz"), at("observation", "present/axis_angle"), at("observation", "present/sensed_close")
    df = df.withColumns({"raw_state": _struct(eef_xyz=xyz, eef_axis_angle=turn, gripper_state=closed), "__R": so3.axis_angle_to_matrix(turn)})
    df = _posed(df, "state", F.col("__R"), xyz, "google", gripper_state=F.transform(closed, lambda x: signals.clip((1.0 - x) / 0.8)))
    residual = so3.axis_angle_to_matrix(signals.vector_slice(at("action", "future/axis_angle_residual"), 0, 3))
    df = df.withColumn("__T", so3.bind(residual, lambda m: so3.matmul(m, F.col("__R"))))
    to = signals.add_scaled(xyz, signals.vector_slice(at("action", "future/xyz_residual"), 0, 3))
    grip = F.transform(signals.vector_slice(at("action", "future/target_close"), 0, 1), lambda x: x.cast("double"))
    df = df.withColumn("raw_target", _struct(eef_xyz=to, eef_axis_angle=so3.matrix_to_axis_angle(F.col("__T")), gripper_state=grip))
    df = _posed(df, "target", F.col("__T"), to, "google", gripper_state=F.transform(grip, signals.invert))
    return _debugged(df.withColumn("language_instruction", F.col(_NLI)).drop("__R", "__T"), f)


def _relabel(df: DataFrame, f: Frames) -> DataFrame:
    df = df.withColumn("__state", F.transform("observation.state", lambda v: v.cast("double")))
    return trajectory.relabel_actions(df, f, "__state", "action").drop("__state")


_INV6 = Rule({"action": cat("action[:6]", inverted_clip("action[-1:]"))})
_ALL_BUT_LAST = {"action": "action[:-1]"}

RULES: dict[str, Rule] = {
    "droid": Rule(then=_droid),
    "bridge_oxe": Rule({"action": cat(*_WORLD, single("action.open_gripper")), "eef_state": "observation.state[:6]", "gripper_state": "observation.state[-1:]"}, _NLI, then=_relabel, first=trajectory.drop_first),
    "bridge_orig": Rule(then=_bridge),
    "ppgm": Rule({"action": cat("action[:6]", binarized("action[-1:]")), "eef_state": "observation.cartesian_position[:6]", "gripper_state": "observation.gripper_position[-1:]"}),
    "rt1": Rule(then=_rt1),
    "kuka": Rule({"action": cat(*_WORLD, rel2abs(_CLOSED))}, _NLI),
    "taco_play": Rule(then=_taco),
    "jaco_play": Rule({"eef_state": "observation.end_effector_cartesian_pos[:6]", "gripper_state": "observation.end_effector_cartesian_pos[-1:]", "action": cat("action.world_vector", like("action.world_vector"), rel2abs(_CLOSED))}, _NLI),
    "berkeley_cable_routing": Rule({"action": cat(*_WORLD, fill(1))}, _NLI),
    "roboturk": Rule({"action": cat(*_WORLD, inverted_clip(_CLOSED))}, _NLI),
    "nyu_door_opening": Rule({"action": cat(*_WORLD, rel2abs(_CLOSED))}, _NLI),
    "viola": Rule({"action": cat(*_WORLD, inverted_clip(single(_CLOSED)))}, _NLI),
    "berkeley_autolab_ur5": Rule({"state": "observation.robot_state[6:14]", "action": cat(*_WORLD, rel2abs_scalar(_CLOSED))}, _NLI),
    "toto": Rule({"action": cat(*_WORLD, single("action.open_gripper"))}, _NLI),
    "language_table": Rule({"action": cat("action", like("action"), like("action"), fill(1, 1.0)), "language_instruction": lambda f: text.codepoints_to_text(F.col("observation.instruction"))}),
    "pusht": Rule({"action": cat(*_WORLD, single(_CLOSED))}, _NLI),
    "stanford_kuka_multimodal": Rule({"action": cat("action[:3]", fill(3), "action[-1:]")}),
    "nyu_rot": _sliced(action="action[:7]"),
    "stanford_hydra": Rule({"action": cat("action[:6]", inverted("action[-1:]")), "eef_state": cat("observation.state[:3]", "observation.state[7:10]"), "gripper_state": "observation.state[-3:-2]"}),
    "austin_buds": Rule(_INV6.columns | {"state": "observation.state[:8]"}),
    "nyu_franka_play": Rule({"eef_state": "observation.state[-6:]", "action": cat("action[-8:-2]", clipped("action[-2:-1]"))}),
    "maniskill": Rule({"gripper_state": "observation.state[7:8]"}),
    "furniture_bench": Rule({"state": cat("observation.state[:7]", "observation.state[-1:]"), "action": cat("action[:3]", euler_of_quaternion("action[3:7]"), inverted_clip("action[-1:]"))}),
    "cmu_franka_exploration": Rule(_ALL_BUT_LAST),
    "ucsd_kitchen": Rule({"joint_state": "observation.state[:7]"} | _ALL_BUT_LAST),
    "ucsd_pick_place": _sliced(action=cat("action[:3]", fill(3), "action[-1:]")),
    "austin_sailor": _INV6,
    "austin_sirius": _INV6,
    "bc_z": Rule(then=_bc_z),
    "tokyo_pr2_opening_fridge": _sliced(**_ALL_BUT_LAST),
    "tokyo_pr2_tabletop_manipulation": _sliced(**_ALL_BUT_LAST),
    "utokyo_xarm_pick_place": Rule(),
    "utokyo_xarm_bimanual": Rule({"action": "action[-7:]"}),
    "robo_net": _sliced(eef=cat("observation.state[:4]", fill(2)), action=cat("action[:4]", fill(2), "action[-1:]")),
    "berkeley_mvp": Rule({"gripper": single("observation.gripper")}),
    "berkeley_rpt": Rule({"gripper": single("observation.gripper")}),
    "kaist_nonprehensible": Rule({"state": "observation.state[-7:]", "action": cat("action[:6]", fill(1))}),
    "stanford_mask_vit": _sliced(eef=cat("observation.end_effector_pose[:4]", fill(2)), grip="observation.end_effector_pose[-1:]", action=cat("action[:4]", fill(2), "action[-1:]")),
    "tokyo_lsmo": _sliced(),
    "dlr_sara_pour": Rule(),
    "dlr_sara_grid_clamp": Rule({"state": "observation.state[:6]"}),
    "dlr_edan_shared_control": Rule({"action": cat("action[:6]", inverted("action[-1:]"))}),
    "asu_table_top": Rule({"eef_state": "ground_truth_states.EE", "gripper_state": "observation.state[-1:]"}),
    "robocook": _sliced(),
    "imperial_wristcam": Rule(_ALL_BUT_LAST),
    "iamlab_pick_insert": Rule({"joint_state": "observation.state[:7]", "gripper_state": "observation.state[7:8]", "action": cat("action[:3]", euler_of_quaternion("action[3:7]"), "action[7:8]")}),
    "uiuc_d3field": Rule({"action": cat("action", like("action"), fill(1))}),
    "utaustin_mutex": Rule(_INV6.columns | {"state": "observation.state[:8]"}),
    "berkeley_fanuc": Rule({"joint_state": "observation.state[:6]", "gripper_state": "observation.state[6:7]", "action": cat("action", inverted("observation.state[6:7]"))}),
    "cmu_playing_with_food": Rule({"action": cat("action[:3]", euler_of_quaternion("action[3:7]"), "action[-1:]")}),
    "playfusion": Rule({"action": cat("action[:3]", "action[-4:]")}),
    "cmu_stretch": _sliced(eef=cat("observation.state[:3]", fill(3)), **_ALL_BUT_LAST),
    "gnm": Rule({"state": cat("observation.position", fill(3), "observation.yaw"), "action": cat("action", like("action"), like("action"), fill(1))}),
    "fmb": Rule({"proprio": cat("observation.eef_pose", single("observation.state_gripper_pose"))}),
    "dobbe": _sliced(),
    "roboset": Rule({"proprio": "observation.state", "action": cat("action[:7]", inverted_clip("action[-1:]"))}),
    "rh20t": Rule({"action": cat("action.tcp_base", single("action.gripper")), "proprio": cat("observation.tcp_base", single("observation.gripper_width"))}),
    "tdroid": Rule({"action": cat("action[:6]", binarized("action[-1:]")), "eef_state": "observation.cartesian_position[:6]", "gripper_state": "observation.gripper_position[-1:]"}),
    "libero": _sliced(grip="observation.state[-2:]", action=cat("action[:6]", inverted_clip("action[-1:]"))),
    "identity": Rule(),
}

#: Rules whose native images have their channels swapped (bgr) or are turned by 180 degrees.
FLIPPED = {"droid": "turned", "berkeley_autolab_ur5": "bgr", "stanford_hydra": "bgr", "utaustin_mutex": "bgr", "berkeley_fanuc": "bgr", "fmb": "bgr"}

# Encodings as ordered widths.
ENCODINGS: dict[str, dict[str, int]] = {
    "NONE": {},
    "POS_EULER": {"xyz": 3, "rpy": 3, "pad": 1, "gripper": 1},
    "POS_QUAT": {"xyz": 3, "quat": 4, "gripper": 1},
    "JOINT": {"joints": 7, "gripper": 1},
    "JOINT_BIMANUAL": {"left_joints": 6, "left_gripper": 1, "right_joints": 6, "right_gripper": 1},
    "POSE_R6": {"eef_xyz": 3, "eef_rot6d": 6, "gripper_state": 1},
    "POSE_FULL": {"eef_xyz": 3, "eef_rpy": 3, "eef_rot6d": 6, "joint_position": 7, "gripper_state": 1},
    "EEF_POS": {"xyz": 3, "rpy": 3, "gripper": 1},
    "EEF_POS_QUAT": {"xyz": 3, "quat": 4, "gripper": 1},
    "JOINT_POS": {"joints": 7, "gripper": 1},
    "JOINT_POS_BIMANUAL": {"left_joints": 6, "left_gripper": 1, "right_joints": 6, "right_gripper": 1},
    "GRIPPER_R6": {"gripper_eef_xyz": 3, "gripper_eef_rot6d": 6, "gripper_state": 1},
}


@dataclass(frozen=True)
class Dataset:
    fps: float
    robot: str
    state: str
    action: str
    rule: str


UNKNOWN = Dataset(10, "unknown", "NONE", "NONE", "identity")

# Name, frames a second, robot, state encoding, action encoding, rule.
_DATASETS = """
fractal20220817_data | 3 | Google Robot | POSE_R6 | GRIPPER_R6 | rt1
kuka | 10 | Kuka iiwa | POS_QUAT | EEF_POS | kuka
bridge_oxe | 5 | WidowX | POS_EULER | EEF_POS | bridge_oxe
bridge_orig | 5 | WidowX | POSE_R6 | GRIPPER_R6 | bridge_orig
bridge_dataset | 5 | WidowX | POSE_R6 | GRIPPER_R6 | bridge_orig
taco_play | 15 | Franka | POSE_R6 | GRIPPER_R6 | taco_play
jaco_play | 10 | Jaco 2 | POS_EULER | EEF_POS | jaco_play
berkeley_cable_routing | 10 | Franka | JOINT | EEF_POS | berkeley_cable_routing
roboturk | 10 | Sawyer | NONE | EEF_POS | roboturk
nyu_door_opening_surprising_effectiveness | 3 | Hello Stretch | NONE | EEF_POS | nyu_door_opening
viola | 20 | Franka | JOINT | EEF_POS | viola
berkeley_autolab_ur5 | 5 | UR5 | POS_QUAT | EEF_POS | berkeley_autolab_ur5
toto | 30 | Franka | JOINT | EEF_POS | toto
language_table | 10 | xArm | POS_EULER | EEF_POS | language_table
columbia_cairlab_pusht_real | 10 | UR5 | POS_EULER | EEF_POS | pusht
stanford_kuka_multimodal_dataset_converted_externally_to_rlds | 20 | Kuka iiwa | POS_QUAT | EEF_POS | stanford_kuka_multimodal
nyu_rot_dataset_converted_externally_to_rlds | 3 | xArm | POS_EULER | EEF_POS | nyu_rot
stanford_hydra_dataset_converted_externally_to_rlds | 10 | Franka | POS_EULER | EEF_POS | stanford_hydra
austin_buds_dataset_converted_externally_to_rlds | 20 | Franka | JOINT | EEF_POS | austin_buds
nyu_franka_play_dataset_converted_externally_to_rlds | 3 | Franka | POS_EULER | EEF_POS | nyu_franka_play
maniskill_dataset_converted_externally_to_rlds | 20 | Franka | POS_QUAT | EEF_POS | maniskill
furniture_bench_dataset_converted_externally_to_rlds | 10 | Franka | POS_QUAT | EEF_POS | furniture_bench
cmu_franka_exploration_dataset_converted_externally_to_rlds | 10 | Franka | NONE | EEF_POS | cmu_franka_exploration
ucsd_kitchen_dataset_converted_externally_to_rlds | 2 | xArm | JOINT | EEF_POS | ucsd_kitchen
ucsd_pick_and_place_dataset_converted_externally_to_rlds | 3 | xArm | POS_EULER | EEF_POS | ucsd_pick_place
austin_sailor_dataset_converted_externally_to_rlds | 20 | Franka | POS_QUAT | EEF_POS | austin_sailor
austin_sirius_dataset_converted_externally_to_rlds | 20 | Franka | POS_QUAT | EEF_POS | austin_sirius
bc_z | 10 | Google Robot | POSE_R6 | GRIPPER_R6 | bc_z
utokyo_pr2_opening_fridge_converted_externally_to_rlds | 10 | PR2 | POS_EULER | EEF_POS | tokyo_pr2_opening_fridge
utokyo_pr2_tabletop_manipulation_converted_externally_to_rlds | 10 | PR2 | POS_EULER | EEF_POS | tokyo_pr2_tabletop_manipulation
utokyo_xarm_pick_and_place_converted_externally_to_rlds | 10 | xArm | POS_EULER | EEF_POS | utokyo_xarm_pick_place
utokyo_xarm_bimanual_converted_externally_to_rlds | 10 | xArm Bimanual | POS_EULER | EEF_POS | utokyo_xarm_bimanual
robo_net | 1 | Multi-Robot | POS_EULER | EEF_POS | robo_net
berkeley_mvp_converted_externally_to_rlds | 5 | xArm | POS_QUAT | JOINT_POS | berkeley_mvp
berkeley_rpt_converted_externally_to_rlds | 30 | Franka | JOINT | JOINT_POS | berkeley_rpt
kaist_nonprehensile_converted_externally_to_rlds | 10 | Franka | POS_QUAT | EEF_POS | kaist_nonprehensible
stanford_mask_vit_converted_externally_to_rlds |  | Sawyer | POS_EULER | EEF_POS | stanford_mask_vit
tokyo_u_lsmo_converted_externally_to_rlds | 10 | Cobotta | POS_EULER | EEF_POS | tokyo_lsmo
dlr_sara_pour_converted_externally_to_rlds | 10 | DLR SARA | POS_EULER | EEF_POS | dlr_sara_pour
dlr_sara_grid_clamp_converted_externally_to_rlds | 10 | DLR SARA | POS_EULER | EEF_POS | dlr_sara_grid_clamp
dlr_edan_shared_control_converted_externally_to_rlds | 5 | DLR EDAN | POS_EULER | EEF_POS | dlr_edan_shared_control
asu_table_top_converted_externally_to_rlds | 12.5 | UR5 | POS_EULER | EEF_POS | asu_table_top
stanford_robocook_converted_externally_to_rlds | 5 | Franka | POS_EULER | EEF_POS | robocook
imperialcollege_sawyer_wrist_cam | 10 | Sawyer | NONE | EEF_POS | imperial_wristcam
iamlab_cmu_pickup_insert_converted_externally_to_rlds | 20 | Franka | JOINT | EEF_POS | iamlab_pick_insert
uiuc_d3field | 1 | Kinova Gen3 | NONE | EEF_POS | uiuc_d3field
utaustin_mutex | 20 | Franka | JOINT | EEF_POS | utaustin_mutex
berkeley_fanuc_manipulation | 10 | Fanuc Mate | JOINT | EEF_POS | berkeley_fanuc
cmu_playing_with_food | 10 | Franka | POS_EULER | EEF_POS | cmu_playing_with_food
cmu_play_fusion | 5 | Franka | JOINT | EEF_POS | playfusion
cmu_stretch | 10 | Hello Stretch | POS_EULER | EEF_POS | cmu_stretch
berkeley_gnm_recon | 3 | Jackal | POS_EULER | EEF_POS | gnm
berkeley_gnm_cory_hall | 5 | RC Car | POS_EULER | EEF_POS | gnm
berkeley_gnm_sac_son | 10 | TurtleBot 2 | POS_EULER | EEF_POS | gnm
droid | 15 | Franka | POSE_R6 | GRIPPER_R6 | droid
fmb_dataset | 10 | Franka | POS_EULER | EEF_POS | fmb
dobbe | 3.75 | Hello Stretch | POS_EULER | EEF_POS | dobbe
roboset | 5 | Franka | JOINT | JOINT_POS | roboset
rh20t | 10 | Flexiv | POS_EULER | EEF_POS | identity
tdroid_carrot_in_bowl | 5 | Franka | POS_EULER | EEF_POS | tdroid
tdroid_pour_corn_in_pot | 5 | Franka | POS_EULER | EEF_POS | tdroid
tdroid_flip_pot_upright | 5 | Franka | POS_EULER | EEF_POS | tdroid
tdroid_move_object_onto_plate | 5 | Franka | POS_EULER | EEF_POS | tdroid
tdroid_knock_object_over | 5 | Franka | POS_EULER | EEF_POS | tdroid
tdroid_cover_object_with_towel | 5 | Franka | POS_EULER | EEF_POS | tdroid
droid_wipe | 15 | Franka | POSE_FULL | GRIPPER_R6 | droid
libero_spatial_no_noops | 20 | Franka | POS_EULER | EEF_POS | libero
libero_object_no_noops | 20 | Franka | POS_EULER | EEF_POS | libero
libero_goal_no_noops | 20 | Franka | POS_EULER | EEF_POS | libero
libero_10_no_noops | 20 | Franka | POS_EULER | EEF_POS | libero
ppgm | 10 | unknown | NONE | NONE | ppgm
ppgm_static | 10 | unknown | NONE | NONE | ppgm
ppgm_wrist | 10 | unknown | NONE | NONE | ppgm
rh20t_rlds | 10 | unknown | NONE | NONE | rh20t
"""


def _read() -> dict[str, Dataset]:
    out = {}
    for line in _DATASETS.strip().splitlines():
        name, fps, robot, state, action, rule = (x.strip() for x in line.split("|"))
        out[name] = Dataset(float(fps or 10), robot, state, action, rule)
    return out


DATASETS = _read()


def dataset(name: str) -> Dataset:
    """What is known of a dataset; a name that isn't listed has 10 frames a second and an unknown robot."""
    return DATASETS.get(name, UNKNOWN)


def table(spark: SparkSession) -> DataFrame:
    """(name, fps, robot, state_width, action_width, rule): the registry as a dimension."""
    width = lambda e: sum(ENCODINGS[e].values())
    rows = [(n, x.fps, x.robot, width(x.state), width(x.action), x.rule) for n, x in DATASETS.items()]
    return spark.createDataFrame(rows, "name string, fps double, robot string, state_width long, action_width long, rule string")


def standardize(df: DataFrame, name: str, frames: Frames) -> DataFrame:
    """The dataset's steps with its rule applied."""
    return RULES[dataset(name).rule].apply(df, frames)
