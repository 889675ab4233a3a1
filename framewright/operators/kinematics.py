"""Forward kinematics of serial chains from URDF.

A chain of n turning joints is a fixed number of affine steps, so it is one Column expression for short chains
(``fk_columns``); ``fk`` runs it vectorised over Arrow batches, which suits long chains.
"""

from __future__ import annotations

import xml.etree.ElementTree as ET
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import so3
from ..functions.signals import norm
from .trajectory import Frames, mean_where_any, moving_mask


@dataclass(frozen=True)
class Joint:
    name: str
    turns: bool
    origin: tuple[float, ...]  # rotation by rows, 9
    offset: tuple[float, ...]
    axis: tuple[float, ...]


def _fixed_axis(roll: float, pitch: float, yaw: float) -> np.ndarray:
    (cr, sr), (cp, sp), (cy, sy) = ((np.cos(v), np.sin(v)) for v in (roll, pitch, yaw))
    x = np.array([[1, 0, 0], [0, cr, -sr], [0, sr, cr]])
    y = np.array([[cp, 0, sp], [0, 1, 0], [-sp, 0, cp]])
    z = np.array([[cy, -sy, 0], [sy, cy, 0], [0, 0, 1]])
    return z @ y @ x


@dataclass(frozen=True)
class Chain:
    joints: tuple[Joint, ...]
    tool: tuple[float, float, float] = (0.0, 0.0, 0.0)

    @property
    def dof(self) -> int:
        return sum(j.turns for j in self.joints)

    @classmethod
    def from_urdf(cls, xml: str, base: str, tip: str, tool=(0.0, 0.0, 0.0)) -> Chain:
        """The joints from base to tip; sliding joints and broken chains are errors."""
        numbers = lambda e, key, default: tuple(float(v) for v in ((e.get(key) if e is not None else None) or default).split())
        above = {j.find("child").get("link"): j for j in ET.fromstring(xml).iter("joint") if j.find("child") is not None}
        out, link = [], tip
        while link != base:
            if link not in above:
                raise ValueError(f"no chain from {base} to {tip}: nothing holds {link}")
            j = above[link]
            kind = j.get("type")
            if kind not in ("revolute", "continuous", "fixed"):
                raise ValueError(f"joint {j.get('name')} is {kind}")
            axis = np.array(numbers(j.find("axis"), "xyz", "1 0 0"))
            size = np.linalg.norm(axis)
            out.append(Joint(j.get("name"), kind != "fixed", tuple(_fixed_axis(*numbers(j.find("origin"), "rpy", "0 0 0")).ravel()), numbers(j.find("origin"), "xyz", "0 0 0"), tuple(axis / size if size else axis)))
            link = j.find("parent").get("link")
        return cls(tuple(reversed(out)), tuple(tool))

    def pose(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(R: n x 3 x 3, p: n x 3) for joint angles n x dof."""
        R, p = np.broadcast_to(np.eye(3), (len(q), 3, 3)), np.zeros((len(q), 3))
        k = 0
        for j in self.joints:
            p = p + R @ np.array(j.offset)
            R = R @ np.array(j.origin).reshape(3, 3)
            if j.turns:
                x, y, z = j.axis
                cross = np.array([[0, -z, y], [z, 0, -x], [-y, x, 0]])
                a = q[:, k, None, None]
                R = R @ (np.eye(3) + np.sin(a) * cross + (1 - np.cos(a)) * (cross @ cross))
                k += 1
        return R, p + R @ np.array(self.tool)


def fk(df: DataFrame, chain: Chain, q: str, R: str = "R", p: str = "p") -> DataFrame:
    """df with the tip's rotation (9 by rows) and place; a vector of another width, or null, gives NULL."""
    dof = chain.dof

    @F.pandas_udf("array<double>")
    def pose(column: pd.Series) -> pd.Series:
        ok = np.array([v is not None and len(v) == dof for v in column], bool)
        out = np.full(len(column), None, object)
        if ok.any():
            r, t = chain.pose(np.stack(column[ok].to_numpy()).astype(np.float64))
            for i, row in zip(np.flatnonzero(ok), np.concatenate([r.reshape(-1, 9), t], axis=1)):
                out[i] = row
        return pd.Series(out)

    out = df.withColumn("__pose", pose(F.col(q)))
    return out.withColumns({R: F.slice("__pose", 1, 9), p: F.slice("__pose", 10, 3)}).drop("__pose")


def _step(j: Joint, angle: Column | None):
    """From the pose before a joint to the pose after it."""

    def step(t: Column) -> Column:
        turned = so3.matmul(t["R"], so3.vec(j.origin))
        if angle is not None:
            turn = so3.axis_angle_to_matrix(F.array(*[F.lit(a) * angle for a in j.axis]))
            turned = so3.bind(turned, lambda m: so3.bind(turn, lambda r: so3.matmul(m, r)))
        return F.struct(turned.alias("R"), so3.plus(t["p"], so3.matvec(t["R"], so3.vec(j.offset))).alias("p"))

    return step


def fk_columns(chain: Chain, q: Column) -> Column:
    """A struct (R, p) by Column expressions alone; each joint's pose is bound, so the expression grows with the chain only."""
    pose = F.struct(so3.vec((1, 0, 0, 0, 1, 0, 0, 0, 1)).alias("R"), so3.vec((0, 0, 0)).alias("p"))
    k = 0
    for j in chain.joints:
        pose = so3.bind(pose, _step(j, F.get(q, F.lit(k)) if j.turns else None))
        k += j.turns
    if any(chain.tool):
        pose = so3.bind(pose, lambda t: F.struct(t["R"].alias("R"), so3.plus(t["p"], so3.matvec(t["R"], so3.vec(chain.tool))).alias("p")))
    return pose


def snap_axes(m: Column) -> Column:
    """The signed permutation nearest a rotation: the largest element of each column's direction, +1 or -1."""
    x = so3.parts(m, 9)
    cols = [F.greatest(F.abs(x[j]), F.abs(x[3 + j]), F.abs(x[6 + j])) for j in range(3)]
    return so3.vec(F.when(F.abs(x[3 * i + j]) == cols[j], F.signum(x[3 * i + j])).otherwise(0.0) for i in range(3) for j in range(3))


def fk_residual(df: DataFrame, f: Frames, chain: Chain, q: str, action: str, eef: str, threshold: float = 1e-4) -> DataFrame:
    """By episode: state, the mean distance of FK(q) at the next frame from the recorded eef, and target, that of FK(action).

    Means are over frames that move (the state's: whose next eef is away by more than the threshold; the target's: next
    to such a move), or over all if none does. Both are near zero on sound recordings.
    """
    solved = fk(fk(df, chain, q, "__R", "__now"), chain, action, "__R", "__target")
    far = lambda a, b: norm(F.zip_with(a, b, lambda x, y: x - y))
    seen, nxt = F.col(eef), F.lead("__now").over(f.by)
    moves = F.coalesce(far(F.lead(seen).over(f.by), seen) > threshold, F.lit(False))
    rows = solved.select(*f.episode, far(nxt, seen).alias("__s"), moves.alias("__moves"), far(F.col("__target"), seen).alias("__t"), moving_mask(seen, f, threshold).alias("__near"))
    return rows.groupBy(*f.episode).agg(mean_where_any(F.col("__s"), F.col("__moves")).alias("state"), mean_where_any(F.col("__t"), F.col("__near")).alias("target"))
