"""Scalar and vector signals: slices, padding, encodings, gripper conventions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def vector_slice(v: Column, start: int, stop: int | None = None) -> Column:
    """v[start:stop] with Python's meaning, of bounds that may be negative."""
    size = F.size(v)
    clip = lambda k: F.greatest(F.lit(0), size + k) if k < 0 else F.least(F.lit(k), size)
    a, b = clip(start), size if stop is None else clip(stop)
    return F.slice(v, a + 1, F.greatest(b - a, F.lit(0)))


def zeros(n: int, value: float = 0.0) -> Column:
    return F.array_repeat(F.lit(value), n)


def concat_vectors(*parts: Column) -> Column:
    return F.concat(*parts)


def encode(encoding: dict[str, int], fields: dict[str, Column]) -> Column:
    """One vector of the named blocks in order; ``pad`` is zeros; a block of another width gives NULL."""
    blocks = [zeros(n) if name.startswith("pad") else F.when(F.size(fields[name]) == n, fields[name]) for name, n in encoding.items()]
    return F.concat(*blocks)


def add_scaled(v: Column, delta: Column, scale: float = 1.0) -> Column:
    return F.zip_with(v, delta, lambda x, d: x + F.lit(scale) * d)


def clip(x: Column, low: float = 0.0, high: float = 1.0) -> Column:
    return F.greatest(F.least(x, F.lit(high)), F.lit(low))


def normalise_width(width: Column, full: float) -> Column:
    """0 closed to 1 open."""
    return clip(width / full)


def invert(x: Column) -> Column:
    return 1.0 - x


def halve_signed(x: Column) -> Column:
    """-1 open, 1 closed -> 1 open, 0 closed; values between keep their place."""
    return (1.0 - x) / 2.0


def invert_clipped(x: Column) -> Column:
    """1 - x after clipping to [0, 1]: differs from halve_signed between -1 and 1."""
    return 1.0 - clip(x)


def route(mode: Column, name: str, command: Column, width: int) -> tuple[Column, Column]:
    """(the command where mode is name, else zeros; 1.0 or 0.0 for active)"""
    active = mode == name
    return F.when(active, command).otherwise(zeros(width)), F.when(active, F.lit(1.0)).otherwise(0.0)


def is_binary(x: Column) -> Column:
    return x.isin(0.0, 1.0)


def norm(v: Column) -> Column:
    return F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x))


def is_zero_action(action: Column, low: Column, high: Column, threshold: float = 1e-5) -> Column:
    """No dimension of the action, scaled by its quantile range to [-1, 1], is away from 0."""
    scaled = F.transform(F.arrays_zip(action.alias("a"), low.alias("l"), high.alias("h")), lambda x: clip(2.0 * (x["a"] - x["l"]) / (x["h"] - x["l"] + 1e-8) - 1.0, -1.0, 1.0))
    return ~F.exists(scaled, lambda x: F.abs(x) > threshold)


def widths_ok(v: Column, n: int) -> Column:
    """Right width and no null or NaN inside."""
    return (F.size(v) == n) & ~F.exists(v, lambda x: x.isNull() | F.isnan(x))
