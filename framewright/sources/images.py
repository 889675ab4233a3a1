"""Images of frames: PNG and raw buffers decoded in batches, turned, resized, and their statistics by channel.

PNG files of 8 and 16 bits (grey, colour, palette, with or without alpha, not interlaced) are decoded with zlib and
numpy. A row's filters depend on the pixel to the left, the one above and the one left above, so pixels on an
anti-diagonal are undone together, for all images of a batch that have the same shape. A buffer that is no image is
taken as raw pixels if its size is a known one. Other formats (JPEG) and broken images are rows with an error.

Statistics are sums over pixels by episode and channel, of evenly sampled frames, and combine in any order.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Sizes in bytes of raw frames and their shapes.
RAW_COLOUR = {2764800: (720, 1280, 3), 921600: (480, 640, 3)}
RAW_DEPTH = {921600: (720, 1280, 1), 307200: (480, 640, 1)}
#: Frames decoded at once.
BATCH = 16

_CHANNELS = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}
_DECODED = "height int, width int, channels int, depth int, pixels binary, error string"


def _chunks(data: bytes) -> dict[bytes, bytes]:
    out: dict[bytes, bytes] = {}
    at = 8
    while at + 8 <= len(data):
        size, kind = struct.unpack_from(">I4s", data, at)
        if at + 12 + size > len(data):
            raise ValueError("image ends early")
        out[kind] = out.get(kind, b"") + data[at + 8 : at + 8 + size]
        at += 12 + size
        if kind == b"IEND":
            break
    return out


def _unfilter(rows: np.ndarray, filters: np.ndarray, step: int) -> np.ndarray:
    """rows: images x height x pixels x step bytes as filtered, filters: images x height; all images at once."""
    n, height, width, _ = rows.shape
    out = np.zeros((n, height + 1, width + 1, step), np.int16)  # a border of zeros above and to the left
    kind = filters[:, :, None]
    for d in range(height + width - 1):
        y = np.arange(max(0, d - width + 1), min(height, d + 1))
        x = d - y
        left, up, corner = out[:, y + 1, x], out[:, y, x + 1], out[:, y, x]
        pa_, pb, pc_ = np.abs(up - corner), np.abs(left - corner), np.abs(left + up - 2 * corner)
        near = np.where((pa_ <= pb) & (pa_ <= pc_), left, np.where(pb <= pc_, up, corner))
        k = kind[:, y]
        guess = np.where(k == 1, left, np.where(k == 2, up, np.where(k == 3, (left + up) >> 1, np.where(k == 4, near, 0))))
        out[:, y + 1, x + 1] = (rows[:, y, x] + guess) & 255
    return out[:, 1:, 1:].astype(np.uint8)


def _header(data: bytes) -> tuple[tuple, np.ndarray, np.ndarray, bytes]:
    """(width, height, bits, colour kind; filtered rows; filters; palette) of one PNG."""
    parts = _chunks(data)
    width, height, bits, colour, _, _, interlaced = struct.unpack(">IIBBBBB", parts[b"IHDR"][:13])
    if bits not in (8, 16) or interlaced or colour not in _CHANNELS:
        raise ValueError(f"PNG of {bits} bits, kind {colour}{', interlaced' if interlaced else ''}")
    step = _CHANNELS[colour] * bits // 8
    raw = zlib.decompress(parts[b"IDAT"])
    if len(raw) != height * (1 + width * step):
        raise ValueError("image ends early")
    lines = np.frombuffer(raw, np.uint8).reshape(height, 1 + width * step)
    if lines[:, 0].max(initial=0) > 4:
        raise ValueError("unknown row filter")
    return (width, height, bits, colour), lines[:, 1:].reshape(height, width, step), lines[:, 0], parts.get(b"PLTE", b"")


def decode(images: list[bytes | None], raw_sizes: dict[int, tuple[int, int, int]] | None = None) -> list[np.ndarray | str | None]:
    """Height x width x channels arrays (uint8 or uint16), an error's text, or None for None."""
    out: list = [None] * len(images)
    same: dict[tuple, list] = {}
    for i, data in enumerate(images):
        if data is None:
            continue
        if not data.startswith(b"\x89PNG\r\n\x1a\n"):
            shape = (raw_sizes or {}).get(len(data))
            out[i] = np.frombuffer(data, np.uint8).reshape(shape) if shape else f"no image that can be read, of {len(data)} bytes"
            continue
        try:
            head, rows, filters, palette = _header(data)
            same.setdefault(head, []).append((i, rows, filters, palette))
        except (ValueError, KeyError, struct.error, zlib.error) as e:
            out[i] = f"{type(e).__name__}: {e}"
    for (_, _, bits, colour), found in same.items():
        for k in range(0, len(found), BATCH):
            some = found[k : k + BATCH]
            pixels = _unfilter(np.stack([f[1] for f in some]), np.stack([f[2] for f in some]), some[0][1].shape[2])
            for (i, _, _, palette), image in zip(some, pixels):
                if bits == 16:
                    image = image.reshape(*image.shape[:2], -1, 2).astype(np.uint16)
                    image = image[..., 0] << 8 | image[..., 1]
                if colour == 3:
                    table = np.zeros((256, 3), np.uint8)
                    table[: len(palette) // 3] = np.frombuffer(palette, np.uint8).reshape(-1, 3)
                    image = table[image[..., 0]]
                out[i] = image
    return out


def resized(image: np.ndarray, height: int, width: int) -> np.ndarray:
    """Bilinear, pixel centres aligned, edges held; whole numbers are rounded, halves to even."""
    axes = []
    for new, old in ((height, image.shape[0]), (width, image.shape[1])):
        at = np.clip((np.arange(new) + 0.5) * old / new - 0.5, 0, old - 1)
        low = np.floor(at).astype(int)
        axes.append((low, np.minimum(low + 1, old - 1), at - low))
    (y0, y1, fy), (x0, x1, fx) = axes
    v = image.astype(np.float64)
    fy, fx = fy[:, None, None], fx[None, :, None]
    top = v[y0][:, x0] * (1 - fx) + v[y0][:, x1] * fx
    low = v[y1][:, x0] * (1 - fx) + v[y1][:, x1] * fx
    made = top * (1 - fy) + low * fy
    return np.rint(made).astype(image.dtype) if image.dtype.kind in "ui" else made


def turned(image: np.ndarray, rows: bool = True, columns: bool = True) -> np.ndarray:
    """Rows and columns from the end; both are a turn by 180 degrees."""
    return image[:: -1 if rows else 1, :: -1 if columns else 1]


def shrunk(image: np.ndarray, target: int = 150, most: int = 300) -> np.ndarray:
    """Every k-th row and column of an image with a side of ``most`` or more, so that the longer side is about ``target``."""
    side = max(image.shape[:2])
    if side < most:
        return image
    k = int(image.shape[1] / target) if image.shape[1] > image.shape[0] else int(image.shape[0] / target)
    return image[::k, ::k]


def decoded(df: DataFrame, column: str, raw_sizes: dict[int, tuple[int, int, int]] | None = None, bgr: bool = False, size: tuple[int, int] | None = None, turn: bool = False) -> DataFrame:
    """df with height, width, channels, depth (bits), pixels (bytes by row, pixel, channel; 16 bits little-endian) and error.

    bgr: channels come in reverse order; size: (height, width) to resize to; turn: by 180 degrees.
    """
    names = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            for at in range(0, rb.num_rows, BATCH):
                some = rb.slice(at, BATCH)
                made = []
                for v in decode(some.column(column).to_pylist(), raw_sizes):
                    if v is None or isinstance(v, str):
                        made.append((None, None, None, None, None, v))
                        continue
                    v = v[..., ::-1] if bgr and v.shape[2] >= 3 else v
                    v = turned(v) if turn else v
                    v = resized(v, *size) if size else v
                    made.append((*v.shape, 8 * v.itemsize, np.ascontiguousarray(v).tobytes(), None))
                kinds = [pa.int32()] * 4 + [pa.binary(), pa.string()]
                columns = [pa.array(list(c), k) for c, k in zip(zip(*made), kinds)]
                yield pa.RecordBatch.from_arrays([*some.columns, *columns], [*names, *_ADDED])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    return df.mapInArrow(run, f"{schema}, {_DECODED}")


_ADDED = [c.split()[0] for c in _DECODED.split(", ")]


def channel_sums(df: DataFrame, keys: list[str], scale: float = 255.0) -> DataFrame:
    """keys, channel, min, max, mean, std, count of the decoded frames, over scale; count: frames that were read.

    Large frames are thinned to about 150 pixels a side first. A task hands on a row for each frame and channel; sums
    of values and squares are whole numbers, so they are exact however rows are dealt.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            rows, sums = [], []
            for i, r in enumerate(rb.select(["height", "width", "channels", "depth", "pixels"]).to_pylist()):
                if r["pixels"] is None:
                    continue
                v = np.frombuffer(r["pixels"], "<u2" if r["depth"] == 16 else np.uint8).reshape(r["height"], r["width"], r["channels"])
                v = shrunk(v).reshape(-1, r["channels"]).astype(np.int64)
                for c in range(r["channels"] if len(v) else 0):
                    rows.append(i)
                    sums.append((c, int(v[:, c].min()), int(v[:, c].max()), len(v), int(v[:, c].sum()), int((v[:, c] ** 2).sum())))
            if rows:
                kept = rb.select(keys).take(pa.array(rows))
                columns = [pa.array(list(c), k) for c, k in zip(zip(*sums), [pa.int32(), *[pa.int64()] * 5])]
                yield pa.RecordBatch.from_arrays([*kept.columns, *columns], [*keys, "channel", "low", "high", "n", "s", "ss"])

    schema = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys)
    per = df.select(*keys, "height", "width", "channels", "depth", "pixels").mapInArrow(run, f"{schema}, channel int, low long, high long, n long, s long, ss long")
    exact = [F.sum(F.col(c).cast("decimal(38, 0)")).alias(c) for c in ("n", "s", "ss")]
    all_ = per.groupBy(*keys, "channel").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.count("*").alias("count"), *exact)
    n, s = F.col("n").cast("double"), F.col("s").cast("double")
    # n ss - s^2 as whole numbers, for both are large and near one another.
    spread = (F.col("n") * F.col("ss") - F.col("s") * F.col("s")).cast("double")
    return all_.select(*keys, "channel", (F.col("low") / scale).alias("min"), (F.col("high") / scale).alias("max"), (s / n / scale).alias("mean"), (F.sqrt(spread) / n / scale).alias("std"), "count")


def sampled(df: DataFrame, episode: str, frame: str, count: Column) -> DataFrame:
    """The frames of each episode that lie at ``count`` even places from its first to its last (see ``meta.even_indices``).

    count: how many, over ``length``, the episode's number of frames; frames are numbered from 0.
    """
    lengths = df.groupBy(episode).agg((F.max(frame) + 1).alias("length"))
    wanted = lengths.withColumn("__n", F.greatest(F.lit(1), F.least(count, F.col("length"))).cast("int"))
    step = F.when(F.col("__n") > 1, (F.col("length") - 1) / (F.col("__n") - 1)).otherwise(F.lit(0.0))
    at = F.array_distinct(F.transform(F.sequence(F.lit(0), F.col("__n") - 1), lambda i: F.bround(i * step).cast("long")))
    return df.join(wanted.select(episode, F.explode(at).alias(frame)), [episode, frame])
