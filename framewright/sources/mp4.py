"""MP4 sample tables as rows: where each frame of a video lies, when it is shown, and whether it stands alone.

``tracks`` follows a file's boxes and gives a row for each track with its tables as they are stored, run-length coded.
``frames`` joins them by Spark: runs of durations give times, runs of samples per chunk give each frame's chunk, sums
of sizes within the chunk its place. Frame data are never read, and a file that can't be followed is a row with an error.
The tables may be of any length: they are exploded, and sums run within a track.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .ranged import RangedFile, Unsupported

_RUN = "array<struct<n: long, v: long>>"
_TRACKS = f"path string, track int, kind string, codec string, width int, height int, timescale long, duration long, shift long, times {_RUN}, shown {_RUN}, per_chunk {_RUN}, size long, sizes array<long>, chunks array<long>, sync array<long>, error string"
_NAMES = ["path", "track", "kind", "codec", "width", "height", "timescale", "duration", "shift", "times", "shown", "per_chunk", "size", "sizes", "chunks", "sync", "error"]
_NESTED = {b"moov", b"trak", b"mdia", b"minf", b"stbl", b"edts"}


def _boxes(read: RangedFile, at: int, end: int) -> Iterator[tuple[bytes, int, int]]:
    """(kind, start, end) of the boxes between two places."""
    while at + 8 <= end:
        size, kind = struct.unpack(">I4s", read(at, 8))
        head = 8
        if size == 1:
            size, head = struct.unpack(">Q", read(at + 8, 8))[0], 16
        elif size == 0:
            size = end - at
        if size < head or at + size > end:
            raise Unsupported(f"box {kind!r} ends beyond what holds it")
        yield kind, at + head, at + size
        at += size


def _leaves(read: RangedFile, at: int, end: int) -> dict[bytes, tuple[int, int]]:
    out = {}
    for kind, start, stop in _boxes(read, at, end):
        if kind in _NESTED and kind != b"trak":
            out |= _leaves(read, start, stop)
        else:
            out[kind] = (start, stop)
    return out


def _table(read: RangedFile, box: tuple[int, int] | None, form: str, head: int = 4) -> np.ndarray | None:
    """The entries of a counted table, a row each; head: where the count is."""
    if box is None:
        return None
    n = struct.unpack(">I", read(box[0] + head, 4))[0]
    kinds = np.dtype([(f"f{k}", f">{c}") for k, c in enumerate(form)])
    if box[0] + head + 4 + n * kinds.itemsize > box[1]:
        raise Unsupported("a table ends beyond its box")
    found = np.frombuffer(read.raw(box[0] + head + 4, n * kinds.itemsize), kinds) if n else np.zeros(0, kinds)
    return np.stack([found[f"f{k}"].astype(np.int64) for k in range(len(form))], axis=1)


def _runs(table: np.ndarray | None) -> list[dict] | None:
    return None if table is None else [{"n": n, "v": v} for n, v in table.tolist()]


def _track(read: RangedFile, start: int, end: int) -> dict | None:
    b = _leaves(read, start, end)
    if b"stsz" not in b and b"stts" not in b:
        return None
    version = read(b[b"mdhd"][0], 1)[0]
    timescale, duration = struct.unpack(">IQ" if version else ">II", read(b[b"mdhd"][0] + (20 if version else 12), 12 if version else 8))
    number = struct.unpack(">I", read(b[b"tkhd"][0] + (20 if read(b[b"tkhd"][0], 1)[0] else 12), 4))[0]
    entry = b[b"stsd"][0] + 8
    codec = read(entry + 4, 4).decode("latin-1")
    kind = read(b[b"hdlr"][0] + 8, 4).decode("latin-1")
    width, height = struct.unpack(">HH", read(entry + 32, 4)) if kind == "vide" else (None, None)
    size = struct.unpack(">I", read(b[b"stsz"][0] + 4, 4))[0]
    sizes = None if size else _table(read, b[b"stsz"], "I", 8)
    count = struct.unpack(">I", read(b[b"stsz"][0] + 8, 4))[0]
    wide = b"co64" in b
    chunks = _table(read, b[b"co64" if wide else b"stco"], "Q" if wide else "I")[:, 0].tolist()
    first = _table(read, b[b"stsc"], "III")
    ends = [*first[1:, 0].tolist(), len(chunks) + 1] if len(first) else []
    per_chunk = [{"n": e - f, "v": v} for (f, v, _), e in zip(first.tolist(), ends)]
    shown = _table(read, b.get(b"ctts"), "Ii" if b"ctts" in b and read(b[b"ctts"][0], 1)[0] else "II")
    times = _table(read, b[b"stts"], "II")
    sync = _table(read, b.get(b"stss"), "I")
    held = sum(r["n"] * r["v"] for r in per_chunk)
    if not held == count == int(times[:, 0].sum()):
        raise Unsupported(f"tables of {count}, {held} and {int(times[:, 0].sum())} samples")
    shift = 0
    if b"elst" in b:
        form = "QqI" if read(b[b"elst"][0], 1)[0] else "IiI"
        starts = [m for _, m, _ in _table(read, b[b"elst"], form).tolist() if m >= 0]
        shift = starts[0] if starts else 0
    return {
        "track": number, "kind": kind, "codec": codec, "width": width, "height": height, "timescale": timescale, "duration": duration, "shift": shift,
        "times": _runs(times), "shown": _runs(shown), "per_chunk": per_chunk, "size": size if size else None, "sizes": None if sizes is None else sizes[:, 0].tolist(), "chunks": chunks, "sync": None if sync is None else sync[:, 0].tolist(),
    }


def tracks(listed: DataFrame) -> DataFrame:
    """A row for each track of the files in ``path``: its kind, codec, size, clock and sample tables, or an error.

    times, shown: runs of n samples with durations or offsets v; per_chunk: runs of n chunks with v samples; size: of
    every sample, else sizes of each; chunks: their places; sync: numbers, from 1, of samples that stand alone, null if
    all do; shift: media time at which showing begins.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                try:
                    read = RangedFile(path)
                    movie = [(s, e) for kind, s, e in _boxes(read, 0, read.size) if kind == b"moov"]
                    if not movie:
                        raise Unsupported("no movie box")
                    found = [_track(read, s, e) for m in movie for kind, s, e in _boxes(read, *m) if kind == b"trak"]
                    made = [{"path": path, **t} for t in found if t]
                except (OSError, ValueError, KeyError, struct.error) as e:
                    made = [{"path": path, "error": f"{type(e).__name__}: {e}"}]
                for one in made:  # a row at a time, for tables may be long
                    yield pa.RecordBatch.from_pylist([{n: one.get(n) for n in schema.names}], schema)

    longs, runs = pa.list_(pa.int64()), pa.list_(pa.struct([("n", pa.int64()), ("v", pa.int64())]))
    types = {"path": pa.string(), "kind": pa.string(), "codec": pa.string(), "error": pa.string(), "track": pa.int32(), "width": pa.int32(), "height": pa.int32(), "times": runs, "shown": runs, "per_chunk": runs, "sizes": longs, "chunks": longs, "sync": longs}
    schema = pa.schema([(c, types.get(c, pa.int64())) for c in _NAMES])
    n = int(listed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return listed.select("path").repartition(n, "path").mapInArrow(run, _TRACKS)


_TRACK = ["path", "track"]


def _upto(x: str, order: str, *by: str) -> Column:
    """The sum of x over the rows before, within the track."""
    return F.coalesce(F.sum(x).over(W.partitionBy(*_TRACK, *by).orderBy(order).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))


def _expanded(found: DataFrame, runs: str, value: str) -> DataFrame:
    """(path, track, sample, value and its sum before): a run-length table with a row for each of its samples."""
    r = found.select(*_TRACK, F.posexplode(runs).alias("run", "r")).select(*_TRACK, "run", "r.n", "r.v").withColumn("total", F.col("n") * F.col("v"))
    r = r.withColumns({"first": _upto("n", "run"), "before": _upto("total", "run")}).where("n > 0")
    r = r.withColumn("sample", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("n") - 1)))
    return r.select(*_TRACK, "sample", F.col("v").alias(value), (F.col("before") + (F.col("sample") - F.col("first")) * F.col("v")).alias(f"{value}_before"))


def frames(found: DataFrame) -> DataFrame:
    """(path, track, frame, time, shown, duration, offset, size, sync): a row for each sample of the tracks, in decoding order.

    time and shown are seconds of decoding and of showing, from the edit list's start.
    """
    found = found.where("error is null")
    clock = found.select(*_TRACK, "timescale", "shift")
    times = _expanded(found, "times", "delta").withColumnRenamed("delta_before", "ticks")
    offsets = _expanded(found.where("shown is not null"), "shown", "later").drop("later_before")
    # Samples of a chunk follow one another: its first sample's number, then sums of sizes within it.
    per = _expanded(found, "per_chunk", "in_chunk").withColumnsRenamed({"sample": "chunk", "in_chunk_before": "first"})
    at = found.select(*_TRACK, F.posexplode("chunks").alias("chunk", "start")).withColumn("chunk", F.col("chunk").cast("long"))
    placed = per.join(at, [*_TRACK, "chunk"]).where("in_chunk > 0").withColumn("sample", F.explode(F.expr("sequence(first, first + in_chunk - 1)")))
    each = found.where("size is null").select(*_TRACK, F.posexplode("sizes").alias("sample", "size")).withColumn("sample", F.col("sample").cast("long"))
    same = found.where("size is not null").select(*_TRACK, "size").join(times.select(*_TRACK, "sample"), _TRACK).select(*_TRACK, "sample", "size")
    sized = placed.join(each.unionByName(same), [*_TRACK, "sample"]).withColumn("offset", F.col("start") + _upto("size", "sample", "chunk"))
    alone = found.where("sync is not null").select(*_TRACK, F.explode("sync").alias("sample")).withColumns({"sample": F.col("sample") - 1, "alone": F.lit(True)})
    marked = found.select(*_TRACK, F.col("sync").isNotNull().alias("marked"))
    out = times.join(sized.select(*_TRACK, "sample", "offset", "size"), [*_TRACK, "sample"]).join(offsets, [*_TRACK, "sample"], "left").join(alone, [*_TRACK, "sample"], "left").join(marked, _TRACK).join(clock, _TRACK)
    seconds = lambda ticks: (ticks - F.col("shift")) / F.col("timescale")
    return out.select(
        *_TRACK, F.col("sample").alias("frame"), seconds(F.col("ticks")).alias("time"), seconds(F.col("ticks") + F.coalesce("later", F.lit(0))).alias("shown"), (F.col("delta") / F.col("timescale")).alias("duration"),
        "offset", "size", (~F.col("marked") | F.coalesce("alone", F.lit(False))).alias("sync"),
    )


def frame_counts(found: DataFrame, wanted: DataFrame, tolerance: int = 2) -> DataFrame:
    """(path, n_frames, n_steps, ok): whether a video has as many frames as its episode steps, and no more than tolerance beyond them.

    wanted: path, n_steps. Only a video's first n_steps frames are its episode's; one with fewer can't be used.
    """
    n = found.where("kind = 'vide'").select("path", F.aggregate("times", F.lit(0).cast("long"), lambda s, r: s + r["n"]).alias("n_frames"))
    both = wanted.join(n, "path", "left").withColumn("n_frames", F.coalesce("n_frames", F.lit(0).cast("long")))
    return both.withColumn("ok", F.col("n_frames").between(F.col("n_steps"), F.col("n_steps") + tolerance))


def cut_points(shots: DataFrame, segments: DataFrame, tolerance: float = 1e-4) -> DataFrame:
    """segments with what a cut without decoding takes: first frame (the last that stands alone at or before the start), last frame, bytes, exact.

    shots: rows of ``frames``; segments: path, from_timestamp, to_timestamp and further columns. A segment is exact if
    its start is such a frame, to the tolerance. Segments of a file are few, its frames many: the join is by file.
    """
    s = segments.withColumn("__id", F.monotonically_increasing_id())
    f = shots.select("path", "frame", "shown", "size", "sync")
    met = s.join(f, "path").where(F.col("shown") < F.col("to_timestamp") - tolerance)
    starts = F.max(F.when(F.col("sync") & (F.col("shown") <= F.col("from_timestamp") + tolerance), F.struct("frame", "shown")))
    by = W.partitionBy("__id")
    cut = met.withColumn("__s", starts.over(by)).where(F.col("frame") >= F.col("__s.frame"))
    out = cut.groupBy("__id").agg(F.first("__s.frame").alias("first_frame"), F.first("__s.shown").alias("cut_from"), F.max("frame").alias("last_frame"), F.sum("size").alias("bytes"))
    return s.join(out, "__id", "left").withColumn("exact", F.coalesce(F.abs(F.col("cut_from") - F.col("from_timestamp")) <= tolerance, F.lit(False))).drop("__id")
