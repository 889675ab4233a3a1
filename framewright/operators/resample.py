"""Resampling to a grid: nearest and linear as-of joins, uniform grids, smoothing, length repair.

Both as-of joins are one union, sorted within the episode, and windows that carry the nearest samples: one shuffle on
the episode, no range join.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def uniform_grid(spans: DataFrame, key: list[str], start: str, end: str, fps: float, name: str = "t") -> DataFrame:
    """key and t: max(1, round((end - start) fps) + 1) times, halves rounded to even."""
    n = F.greatest(F.lit(1), F.bround((F.col(end) - F.col(start)) * fps).cast("int") + 1)
    return spans.select(*key, F.posexplode(F.transform(F.sequence(F.lit(0), n - 1), lambda k: F.col(start) + k / F.lit(float(fps)))).alias("step", name))


def _around(source: DataFrame, query: DataFrame, key: list[str], t: str, values: list[str], tie: str) -> DataFrame:
    """query's rows with the samples before (or at) and after as structs __p and __n, from one sort for each key."""
    sample = F.struct(F.col(t).alias("t"), *[F.col(v).alias(v) for v in values])
    rest = [c for c in query.columns if c not in (*key, t)]
    s = source.select(*key, t, F.lit(0).alias("__q"), sample.alias("__s"), *[F.lit(None).cast(query.schema[c].dataType).alias(c) for c in rest])
    q = query.select(*key, t, F.lit(1).alias("__q"), F.lit(None).cast(s.schema["__s"].dataType).alias("__s"), *rest)
    both = s.unionByName(q)
    by = W.partitionBy(*key).orderBy(t, "__q")
    prev = F.last("__s", ignorenulls=True).over(by.rowsBetween(W.unboundedPreceding, W.currentRow))
    back = W.partitionBy(*key).orderBy(F.col(t).desc(), F.col("__q").desc() if tie == "strict" else F.col("__q"))
    nxt = F.last("__s", ignorenulls=True).over(back.rowsBetween(W.unboundedPreceding, W.currentRow))
    return both.withColumn("__p", prev).withColumn("__n", nxt).where("__q = 1").drop("__q", "__s")


def nearest(source: DataFrame, query: DataFrame, key: list[str], t: str, values: list[str], tie: str = "earlier") -> DataFrame:
    """query with source_t and values of the nearest sample; beyond the ends, the end's. tie: 'earlier' or 'later' of two as near."""
    out = _around(source, query, key, t, values, tie)
    p, n = F.col("__p"), F.col("__n")
    left = F.col(t) - p["t"] <= n["t"] - F.col(t) if tie == "earlier" else F.col(t) - p["t"] < n["t"] - F.col(t)
    best = F.when(n.isNull() | (p.isNotNull() & left), p).otherwise(n)
    return out.withColumn("__b", best).select(*[c for c in out.columns if not c.startswith("__")], F.col("__b.t").alias(f"source_{t}"), *[F.col(f"__b.{v}").alias(v) for v in values])


def linear(source: DataFrame, query: DataFrame, key: list[str], t: str, values: list[str]) -> DataFrame:
    """query with values interpolated between the samples around it; beyond the ends, the end's."""
    out = _around(source, query, key, t, values, "earlier")
    p, n = F.col("__p"), F.col("__n")

    def lerp(v: str) -> Column:
        between = p[v] + (n[v] - p[v]) * F.try_divide(F.col(t) - p["t"], n["t"] - p["t"])
        return F.when(p.isNull(), n[v]).when(n.isNull(), p[v]).when(p["t"] == n["t"], p[v]).otherwise(between).alias(v)

    return out.select(*[c for c in out.columns if not c.startswith("__")], *[lerp(v) for v in values])


def butterworth(order: int, cutoff: float) -> tuple[np.ndarray, np.ndarray]:
    """(b, a) of a digital low-pass; cutoff as a part of the Nyquist frequency. Bilinear transform of the analog poles."""
    warped = 4.0 * np.tan(np.pi * cutoff / 2.0)
    poles = warped * np.exp(1j * np.pi * (2 * np.arange(1, order + 1) + order - 1) / (2 * order))
    z = (4.0 + poles) / (4.0 - poles)
    a = np.real(np.poly(z))
    b = np.real(np.poly(-np.ones(order)))
    return b * a.sum() / b.sum(), a


def _steady(b: np.ndarray, a: np.ndarray) -> np.ndarray:
    """State of the filter for a constant input of 1."""
    n = len(a) - 1
    companion = np.zeros((n, n))
    companion[:, 0] = -a[1:]
    companion[:-1, 1:] = np.eye(n - 1)
    return np.linalg.solve(np.eye(n) - companion, b[1:] - a[1:] * b[0])


class _Blocked:
    """A linear recurrence over blocks of samples: within a block products with fixed matrices, between blocks the state.

    The state goes on by s' = M s + B x, y = s[0] + b0 x. A block's outputs are those of a zero state (a triangular
    matrix of the impulse response) and what the state at its start adds (powers of M).
    """

    def __init__(self, b: np.ndarray, a: np.ndarray, size: int = 64):
        n = len(a) - 1
        move = np.zeros((n, n))
        move[:-1, 1:] = np.eye(n - 1)
        move[:, 0] -= a[1:]
        drive = b[1:] - a[1:] * b[0]
        powers = [np.eye(n)]
        for _ in range(size):
            powers.append(powers[-1] @ move)
        response = np.array([b[0], *(p[0] @ drive for p in powers[: size - 1])])
        lag = np.arange(size)[:, None] - np.arange(size)[None, :]
        self.size = size
        self.alone = np.where(lag >= 0, response[np.maximum(lag, 0)], 0.0)
        self.seen = np.stack([p[0] for p in powers[:size]])
        self.kept = np.stack([powers[size - 1 - u] @ drive for u in range(size)], axis=1)
        self.over = powers[size]

    def run(self, x: np.ndarray, sizes: np.ndarray, steady: np.ndarray) -> np.ndarray:
        """Each of the sequences that lie one after another in x, from the steady state of its first sample."""
        blocks = -(-sizes // self.size)
        first = np.cumsum(blocks) - blocks
        at = np.arange(len(x)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(first * self.size, sizes)
        laid = np.zeros(int(blocks.sum()) * self.size)
        laid[at] = x
        laid = laid.reshape(-1, self.size)
        gained = laid @ self.kept.T
        states = np.empty((len(laid), len(steady)))
        longest = np.argsort(-blocks, kind="stable")
        state = steady[None, :] * laid[first[longest], 0][:, None]
        for k in range(int(blocks.max(initial=0))):
            on = int(np.searchsorted(-blocks[longest], -k, "left"))
            here = first[longest[:on]] + k
            states[here] = state[:on]
            state = state[:on] @ self.over.T + gained[here]
        return (laid @ self.alone.T + states @ self.seen.T).ravel()[at]


def filtfilt_all(b: np.ndarray, a: np.ndarray, x: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Forward and backward over each of the sequences in x, with odd extension at the ends.

    What is no longer than the extension, 3 max(len(a), len(b)), stays as it is.
    """
    pad = 3 * max(len(a), len(b))
    start = np.cumsum(sizes) - sizes
    long = sizes > pad
    out = x.astype(np.float64)
    if not long.any():
        return out
    start, sizes = start[long], sizes[long]
    wide = sizes + 2 * pad
    of = np.repeat(np.arange(len(sizes)), wide)
    place = np.arange(len(of)) - np.repeat(np.cumsum(wide) - wide, wide) - pad
    last = sizes[of] - 1
    mirrored = np.where(place < 0, -place, np.where(place > last, 2 * last - place, place))
    ext = out[start[of] + mirrored]
    for outside, end in ((place < 0, 0), (place > last, last)):
        ext = np.where(outside, 2 * out[start[of] + end] - ext, ext)
    recurrence, steady = _Blocked(b, a), _steady(b, a)
    turned = np.cumsum(wide)[of] - 1 - (place + pad)
    back = recurrence.run(recurrence.run(ext, wide, steady)[turned], wide, steady)[turned]
    inside = (place >= 0) & (place <= last)
    out[start[of[inside]] + place[inside]] = back[inside]
    return out


def filtfilt(b: np.ndarray, a: np.ndarray, x: np.ndarray) -> np.ndarray:
    return filtfilt_all(b, a, np.asarray(x), np.array([len(x)]))


def _changes(batch: pa.RecordBatch, columns: list[str]) -> np.ndarray:
    """Row numbers at which a column differs from the row before; nulls are equal."""
    n = batch.num_rows
    new = np.zeros(max(n - 1, 0), bool)
    for c in columns:
        x, y = batch.column(c).slice(0, n - 1), batch.column(c).slice(1)
        both = pc.and_(pc.is_null(x), pc.is_null(y))
        new |= pc.and_not(pc.fill_null(pc.not_equal(x, y), True), both).to_numpy(zero_copy_only=False)
    return np.flatnonzero(new) + 1


def smooth(df: DataFrame, key: list[str], order_by: list[str], columns: list[str], fps: float, cutoff_hz: float, order: int = 2) -> DataFrame:
    """df with columns low-passed in zero phase; all whole episodes of a batch at once, one episode is in one task."""
    b, a = butterworth(order, cutoff_hz / (fps / 2.0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            if held and not len(_changes(pa.concat_batches([held[-1].slice(held[-1].num_rows - 1), batch]), key)):
                held.append(batch)  # one episode still
                continue
            whole = pa.concat_batches([*held, batch])
            edges = _changes(whole, key)
            cut = int(edges[-1]) if len(edges) else 0
            if cut:
                yield filtered(whole.slice(0, cut), np.diff([0, *edges]))
            held = [whole.slice(cut)]
        if held:
            whole = pa.concat_batches(held)
            yield filtered(whole, np.diff([0, *_changes(whole, key), whole.num_rows]))

    def filtered(batch: pa.RecordBatch, sizes: np.ndarray) -> pa.RecordBatch:
        for c in columns:
            x = batch.column(c).to_numpy(zero_copy_only=False)
            batch = batch.set_column(batch.schema.get_field_index(c), c, pa.array(filtfilt_all(b, a, x, sizes)))
        return batch

    typed = df.withColumns({c: F.col(c).cast("double") for c in columns})
    return typed.repartition(*key).sortWithinPartitions(*key, *order_by).mapInArrow(run, typed.schema)


def repair_lengths(state: DataFrame, action: DataFrame, index: DataFrame, episode: str, frame: str, value: str, zero: Column) -> DataFrame:
    """(episode, frame, value): an action series for every frame of the state.

    index: (episode, position, frame) of the recorded steps. A short series is laid over the state at its recorded
    frames; an empty one is zeros; an episode with more actions than frames goes.
    """
    frames = state.groupBy(episode).agg(F.count("*").alias("__frames"))
    actions = action.groupBy(episode).agg(F.count("*").alias("__actions"))
    sizes = frames.join(actions, episode, "left").withColumn("__actions", F.coalesce("__actions", F.lit(0))).where("__actions <= __frames")
    placed = action.join(index, [episode, "position"], "left").join(sizes, episode)
    placed = placed.select(episode, F.when(F.col("__actions") == F.col("__frames"), F.col("position")).otherwise(F.col(frame)).alias(frame), F.col(value).alias("__v")).where(F.col(frame).isNotNull())
    out = state.select(episode, frame, value).join(sizes, episode).join(placed, [episode, frame], "left")
    return out.select(episode, frame, F.when(F.col("__actions") == 0, zero).otherwise(F.coalesce("__v", value)).alias(value))
