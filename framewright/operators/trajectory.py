"""Ordered operators within episodes: differences, gripper states, no-ops, runs, offsets, keys.

Every window is partitioned by episode and totally ordered, so an episode is the unit of parallelism. Offsets over
episodes are windows over the episode table (a row for each episode), never over frames.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import so3
from ..functions.signals import norm
from .ranges import PART, dealt, running_sums, sums_before


class Frames:
    """How a table's rows form episodes: its episode columns and a total order within one."""

    def __init__(self, episode: str | list[str], order: str | list[str]):
        self.episode = [episode] if isinstance(episode, str) else list(episode)
        self.order = [order] if isinstance(order, str) else list(order)

    @property
    def by(self):
        return W.partitionBy(*self.episode).orderBy(*self.order)

    @property
    def whole(self):
        return self.by.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)

    @property
    def upto(self):
        return self.by.rowsBetween(W.unboundedPreceding, W.currentRow)

    @property
    def back(self):
        """From the last frame back to the current one: linear, where a frame onward would be gone through for each row."""
        return W.partitionBy(*self.episode).orderBy(*[F.desc(o) for o in self.order]).rowsBetween(W.unboundedPreceding, W.currentRow)


def with_frame_index(df: DataFrame, f: Frames, name: str = "frame_index") -> DataFrame:
    return df.withColumn(name, (F.row_number().over(f.by) - 1).cast("long"))


def with_timestamp(df: DataFrame, fps: float) -> DataFrame:
    return df.withColumn("timestamp", F.col("frame_index") / F.lit(float(fps)))


def forward_delta(x: Column, f: Frames) -> Column:
    """x[t+1] - x[t], 0 at the last frame."""
    return F.coalesce(F.lead(x).over(f.by) - x, F.lit(0.0))


def forward_delta_vector(v: Column, f: Frames) -> Column:
    return F.coalesce(F.zip_with(F.lead(v).over(f.by), v, lambda a, b: a - b), F.transform(v, lambda x: x * 0.0))


def relabel_actions(df: DataFrame, f: Frames, state: str, action: str, n: int = 6, out: str = "action") -> DataFrame:
    """Action: the state's next difference in the first n dimensions and the action's own last; the last frame goes."""
    nxt = F.lead(state).over(f.by)
    moved = F.zip_with(F.slice(nxt, 1, n), F.slice(state, 1, n), lambda a, b: a - b)
    return df.withColumn(out, F.concat(moved, F.slice(action, -1, 1))).where(F.col(out).isNotNull())


def drop_first(df: DataFrame, f: Frames) -> DataFrame:
    """All but each episode's first frame, numbered anew."""
    return with_frame_index(with_frame_index(df, f).where("frame_index > 0"), f)


def binarize_gripper(x: Column, f: Frames, high: float = 0.95, low: float = 0.05) -> Column:
    """1 above high, 0 below low; between, the state that is reached next; after the last such, the last raw value."""
    state = F.when(x > high, F.lit(1.0)).when(x < low, F.lit(0.0))
    return F.coalesce(F.last(state, ignorenulls=True).over(f.back), F.last(x).over(f.whole))


def relative_to_absolute_gripper(x: Column, f: Frames, threshold: float = 0.1) -> Column:
    """Opening (below -threshold) and closing moves as 1 open, 0 closed, carried forward; before the first move its opposite."""
    move = F.when(x < -threshold, F.lit(1.0)).when(x > threshold, F.lit(-1.0))
    state = F.coalesce(F.last(move, ignorenulls=True).over(f.upto), -F.first(move, ignorenulls=True).over(f.whole), F.lit(1.0))
    return state / 2.0 + 0.5


def is_noop(arm: Column, gripper: Column, f: Frames, threshold: float = 1e-4) -> Column:
    """The arm rests and the gripper is as in the last frame that isn't a no-op (or there is none yet)."""
    rests = arm < threshold
    before = f.by.rowsBetween(W.unboundedPreceding, -1)
    moved = F.max(F.when(~rests, 1).otherwise(0)).over(before)
    return rests & ((F.coalesce(moved, F.lit(0)) == 0) | (gripper == F.lag(gripper).over(f.by)))


def is_noop_action(action: Column, f: Frames, threshold: float = 1e-4) -> Column:
    return is_noop(norm(F.slice(action, F.lit(1), F.size(action) - 1)), F.element_at(action, -1), f, threshold)


def episode_runs(df: DataFrame, episode: str, order: list[str]) -> DataFrame:
    """(episode, runs): contiguous runs of each episode in the table's order; over 1 if it is interleaved with others.

    The order is cut into ranges; a run that spans a boundary counts once, for each row looks at its predecessor by
    rank. The table's order is a global one, so this sorts once and needs no single task: neighbours meet by rank.
    """
    ranked = global_rank(df.select(episode, *order), order)
    prev = ranked.select((F.col("rank") + 1).alias("rank"), F.col(episode).alias("was"))
    starts = ranked.join(prev, "rank", "left").where(~F.col(episode).eqNullSafe(F.col("was")))
    return starts.groupBy(episode).agg(F.count("*").alias("runs"))


def global_rank(df: DataFrame, order: list[str], name: str = "rank", parts: int | None = None) -> DataFrame:
    """Dense numbers from 0 in a total order: range partitions, ranks within, and an offset for each partition."""
    ranges = dealt(df, order, parts)
    inside = F.row_number().over(W.partitionBy(PART).orderBy(*order)) - 1
    before = sums_before(ranges, {"__before": F.lit(1).cast("long")})
    return ranges.withColumn("__in", inside).join(F.broadcast(before), PART).withColumn(name, F.col("__before") + F.col("__in")).drop(PART, "__in", "__before")


def dataset_offsets(episodes: DataFrame, episode: str = "episode_index", length: str = "length") -> DataFrame:
    """episodes and dataset_from_index, dataset_to_index: running sums of lengths."""
    out = running_sums(episodes, [episode], {"dataset_to_index": F.col(length)})
    return out.withColumn("dataset_from_index", F.col("dataset_to_index") - F.col(length))


def video_offsets(packed: DataFrame, file: list[str], order: str, duration: str) -> DataFrame:
    """packed and from_timestamp, to_timestamp: running sums of durations within each file."""
    upto = F.sum(duration).over(W.partitionBy(*file).orderBy(order).rowsBetween(W.unboundedPreceding, W.currentRow))
    return packed.withColumn("to_timestamp", upto).withColumn("from_timestamp", F.col("to_timestamp") - F.col(duration))


def global_index(frames: DataFrame, episodes: DataFrame, episode: str = "episode_index") -> DataFrame:
    """frames and index: the episode's offset and the frame's number."""
    return frames.join(dataset_offsets(episodes, episode).select(episode, "dataset_from_index"), episode).withColumn("index", F.col("dataset_from_index") + F.col("frame_index")).drop("dataset_from_index")


def step_flags(df: DataFrame, f: Frames) -> DataFrame:
    """df and is_first, is_last, is_terminal."""
    last = F.lead(F.lit(1)).over(f.by).isNull()
    return df.withColumns({"is_first": F.row_number().over(f.by) == 1, "is_last": last, "is_terminal": last})


def shard_reoffset(sidecar: DataFrame, shards: DataFrame, shard: str = "shard", total: str = "total_episodes") -> DataFrame:
    """sidecar with episode_index moved by the episodes of earlier shards."""
    sums = running_sums(shards.select(shard, total), [shard], {"__upto": F.col(total)})
    return sidecar.join(sums.select(shard, (F.col("__upto") - F.col(total)).alias("__off")), shard).withColumn("episode_index", F.col("episode_index") + F.col("__off")).drop("__off")


def moving_mask(xyz: Column, f: Frames, threshold: float = 1e-4) -> Column:
    """Frames next to a transition that moves."""
    def far(a: Column, b: Column) -> Column:
        return F.coalesce(norm(F.zip_with(a, b, lambda x, y: x - y)) > threshold, F.lit(False))

    return far(F.lead(xyz).over(f.by), xyz) | far(xyz, F.lag(xyz).over(f.by))


def mean_where_any(value: Column, mask: Column) -> Column:
    """An aggregate: the mean over the mask, or over all if the mask is empty."""
    return F.coalesce(F.avg(F.when(mask, value)), F.avg(value))


def relative_motion(df: DataFrame, f: Frames, xyz: str, rpy: str, R: str) -> DataFrame:
    """df and world_xyz, world_rpy (by component), world_rot6d, gripper_xyz, gripper_rot6d to the next frame; no move at the last."""
    nxt = F.lead(F.struct(F.col(xyz).alias("p"), F.col(rpy).alias("a"), F.col(R).alias("R"))).over(f.by)
    out = df.withColumn("__next", nxt)
    n = F.col("__next")
    minus = lambda a, b: F.zip_with(a, b, lambda x, y: x - y)
    still, same = F.transform(F.col(xyz), lambda x: x * 0.0), so3.vec(so3.IDENTITY6)
    turn_g, shift_g = so3.gripper_delta_pose(F.col(R), F.col(xyz), n["R"], n["p"])
    turn_w, _ = so3.world_delta_pose(F.col(R), F.col(xyz), n["R"], n["p"])
    rot6 = lambda m: F.when(n.isNotNull(), so3.matrix_to_rotation_6d(m)).otherwise(same)
    return out.withColumns(
        {
            "world_xyz": F.when(n.isNotNull(), minus(n["p"], F.col(xyz))).otherwise(still),
            "world_rpy": F.when(n.isNotNull(), minus(n["a"], F.col(rpy))).otherwise(still),
            "world_rot6d": rot6(turn_w),
            "gripper_xyz": F.when(n.isNotNull(), shift_g).otherwise(still),
            "gripper_rot6d": rot6(turn_g),
        }
    ).drop("__next")


def mixed_motion(df: DataFrame, f: Frames, xyz: str, euler: str, quat: str, R: str) -> DataFrame:
    """df and the move to the next frame with differences of position, euler angles and quaternion by component and rot6d in the gripper frame."""
    out = relative_motion(df, f, xyz, euler, R)
    return out.withColumn("world_quat", forward_delta_vector(F.col(quat), f))


def next_pose_delta(df: DataFrame, f: Frames, xyz: str, R: str) -> DataFrame:
    """df and gripper_eef_xyz, gripper_eef_rot6d: the true next move in the gripper frame; none at the last frame."""
    out = df.withColumn("__next", F.lead(F.struct(F.col(xyz).alias("p"), F.col(R).alias("R"))).over(f.by))
    n = F.col("__next")
    turn, shift = so3.gripper_delta_pose(F.col(R), F.col(xyz), n["R"], n["p"])
    return out.withColumns(
        {
            "gripper_eef_xyz": F.when(n.isNotNull(), shift).otherwise(so3.vec((0, 0, 0))),
            "gripper_eef_rot6d": F.when(n.isNotNull(), so3.matrix_to_rotation_6d(turn)).otherwise(so3.vec(so3.IDENTITY6)),
        }
    ).drop("__next")


def nest(df: DataFrame, f: Frames, columns: list[str], name: str = "steps") -> DataFrame:
    """A row for each episode with its frames as an ordered array of structs."""
    return df.groupBy(*f.episode).agg(F.sort_array(F.collect_list(F.struct(*f.order, *[c for c in columns if c not in f.order]))).alias(name))


def unnest(df: DataFrame, name: str = "steps") -> DataFrame:
    """A row for each frame of nested episodes, numbered from 0."""
    rest = [c for c in df.columns if c != name]
    out = df.select(*rest, F.posexplode(name).alias("frame_index", "__s"))
    return out.select(*rest, F.col("frame_index").cast("long"), "__s.*")
