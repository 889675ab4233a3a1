"""Recordings of chunked logs as tables: what was logged where, scalar series, and times of frames.

A recording is a header and framed messages; a data message is a small envelope around an Arrow stream of one chunk: an
entity, a row for each event, time columns and component columns of lists. ``chunks`` follows the frames and reads of
each payload only the schema that it begins with, so entities that aren't asked for are never read (a compressed payload
is, to its schema). ``scalars`` and ``times`` read the chunks asked for, each a row of its own wherever it lies.

Known are streams of version 2 with envelopes of protocol buffers, payloads as they are or in LZ4 blocks. A file that
can't be followed is a row with an error, after the chunks that could.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ranged import RangedFile, Unsupported

#: The mark of a stream, the kinds of messages, the fields of a data message's envelope.
MARK = b"RRF2"
END, DATA = 0, 2
COMPRESSION, SIZE, ENCODING, PAYLOAD = 2, 3, 4, 5
_LZ4 = 2
_CHUNKS = "path string, entity string, timelines array<string>, components array<string>, at long, size long, packed int, unpacked long, error string"


def _varint(read, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = read(at, 1)[0]
        value |= (byte & 127) << shift
        at += 1
        if byte < 128:
            return value, at
        shift += 7
        if shift > 63:
            raise Unsupported("broken number")


def _envelope(read, at: int, end: int) -> dict[int, int | tuple[int, int]]:
    """Fields of a protocol buffer by number: numbers, or (place, size) of what has a length."""
    out: dict = {}
    while at < end:
        key, at = _varint(read, at)
        if key & 7 == 0:
            out[key >> 3], at = _varint(read, at)
        elif key & 7 == 2:
            size, at = _varint(read, at)
            out[key >> 3] = (at, size)
            at += size
        elif key & 7 in (1, 5):
            at += 8 if key & 7 == 1 else 4
        else:
            raise Unsupported("broken envelope")
    if at != end:
        raise Unsupported("broken envelope")
    return out


def _payload(file: RangedFile, at: int, size: int, packed: int, unpacked: int) -> bytes:
    data = file.raw(at, size)
    return pa.Codec("lz4_raw").decompress(data, unpacked).to_pybytes() if packed == _LZ4 else data


def _schema(file: RangedFile, at: int, size: int, packed: int, unpacked: int) -> pa.Schema:
    if packed == _LZ4:
        return pa.ipc.open_stream(_payload(file, at, size, packed, unpacked)).schema
    head = file(at, min(size, 8))
    length = struct.unpack("<i", head[4:8])[0] if head[:4] == b"\xff\xff\xff\xff" and len(head) == 8 else -1
    if not 0 < length <= size - 8:
        raise Unsupported("payload without a schema")
    return pa.ipc.read_schema(pa.py_buffer(file(at, 8 + length)))


def _said(metadata: dict | None, name: str) -> str | None:
    """A value of the metadata, whose keys begin with the writer's name and a dot or colon."""
    for key, value in (metadata or {}).items():
        if key.replace(b":", b".").split(b".")[-1] == name.encode():
            return value.decode()
    return None


def _kind(field: pa.Field) -> str:
    return _said(field.metadata, "kind") or ("time" if pa.types.is_timestamp(field.type) or pa.types.is_duration(field.type) else "data" if pa.types.is_list(field.type) else "control")


def chunks(listed: DataFrame) -> DataFrame:
    """A row for each chunk of the files in ``path``: entity, timelines and components by name, and where its payload lies."""

    def follow(path: str) -> Iterator[dict]:
        file = RangedFile(path)
        if file(0, 4) != MARK:
            raise Unsupported("no stream of version 2")
        at = 12
        while at + 16 <= file.size:
            kind, size = file.ints(at, "QQ")
            at += 16
            if kind == END:
                return
            if at + size > file.size:
                raise Unsupported("file ends early")
            if kind == DATA:
                e = _envelope(file, at, at + size)
                if PAYLOAD not in e:
                    raise Unsupported("data without a payload")
                place, n = e[PAYLOAD]
                packed, unpacked = e.get(COMPRESSION, 0), e.get(SIZE, 0)
                schema = _schema(file, place, n, packed, unpacked)
                names = lambda wanted: [f.name for f in schema if _kind(f) in wanted]
                yield {"path": path, "entity": _said(schema.metadata, "entity_path"), "timelines": names(("time", "index")), "components": names(("data",)), "at": place, "size": n, "packed": packed, "unpacked": unpacked}
            at += size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                found = []
                try:
                    for one in follow(path):
                        found.append(one)
                        if len(found) == 1000:
                            yield made(found)
                            found = []
                except (OSError, ValueError, struct.error, pa.ArrowException) as e:
                    found.append({"path": path, "error": f"{type(e).__name__}: {e}"})
                if found:
                    yield made(found)

    def made(rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([{n: r.get(n) for n in schema.names} for r in rows], schema)

    texts = pa.list_(pa.string())
    schema = pa.schema([("path", pa.string()), ("entity", pa.string()), ("timelines", texts), ("components", texts), ("at", pa.int64()), ("size", pa.int64()), ("packed", pa.int32()), ("unpacked", pa.int64()), ("error", pa.string())])
    return _spread(listed.select("path"), "path").mapInArrow(run, _CHUNKS)


def _spread(df: DataFrame, *by: str) -> DataFrame:
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *by)


def _seconds(column: pa.ChunkedArray) -> np.ndarray:
    """Times as seconds (of whole numbers, as they are); not a number where there is none."""
    if pa.types.is_timestamp(column.type) or pa.types.is_duration(column.type):
        ns = column.cast(pa.timestamp("ns") if pa.types.is_timestamp(column.type) else pa.duration("ns")).cast(pa.int64())
        return ns.cast(pa.float64(), safe=False).to_numpy() / 1e9
    return column.cast(pa.float64(), safe=False).to_numpy()


def _events(found: DataFrame, timeline: str, component: str, schema: str, take) -> DataFrame:
    """Rows of the chunks that have the timeline and a component whose name ends as asked; take(column) -> (rows that count, values or None)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, at = None, None
        for batch in batches:
            for r in batch.to_pylist():
                if r["path"] != at:
                    file, at = RangedFile(r["path"]), r["path"]
                table = pa.ipc.open_stream(_payload(file, r["at"], r["size"], r["packed"], r["unpacked"])).read_all()
                rows, values = take(table.column(r["name"]))
                columns = [pa.array([r["path"]] * len(rows)), pa.array([r["entity"]] * len(rows)), pa.array(_seconds(table.column(timeline))[rows], from_pandas=True)]
                yield pa.RecordBatch.from_arrays(columns + ([] if values is None else [values]), names)

    names = [c.split()[0] for c in schema.split(", ")]
    named = found.where(F.col("error").isNull() & F.array_contains("timelines", timeline)).withColumn("name", F.explode(F.filter("components", lambda c: c.endswith(component))))
    wanted = named.select("path", "entity", "at", "size", "packed", "unpacked", "name")
    return _spread(wanted, "path", "at").mapInArrow(run, schema).where("t is not null")


def scalars(found: DataFrame, timeline: str = "log_time", component: str = "scalars") -> DataFrame:
    """(path, entity, t, value): the first number of every event of the chunks asked for; empty events don't count."""

    def take(column: pa.ChunkedArray):
        column = column.combine_chunks()
        if not pa.types.is_list(column.type):
            return np.flatnonzero(column.is_valid().to_numpy(zero_copy_only=False)), column.drop_null().cast(pa.float64())
        lists = column.to_pylist()
        rows = np.array([k for k, v in enumerate(lists) if v and v[0] is not None], np.int64)
        return rows, pa.array([float(lists[k][0]) for k in rows], pa.float64())

    return _events(found, timeline, component, "path string, entity string, t double, value double", take)


def times(found: DataFrame, timeline: str = "log_time", component: str = "VideoStream:sample") -> DataFrame:
    """(path, entity, t): when events of a component were logged, the component itself unread by the caller."""
    return _events(found, timeline, component, "path string, entity string, t double", lambda c: (np.flatnonzero(c.combine_chunks().is_valid().to_numpy(zero_copy_only=False)), None))


def entities(found: DataFrame, wanted: list[str]) -> DataFrame:
    """(path, present): of the wanted entities those a recording has, in the order they are wanted in."""
    has = found.where("error is null").groupBy("path").agg(F.collect_set("entity").alias("__has"))
    return has.select("path", F.filter(F.array(*[F.lit(w) for w in wanted]), lambda w: F.array_contains("__has", w)).alias("present"))


def aligned(series: DataFrame, channels: dict[str, str], reference: str) -> DataFrame:
    """(path, t, and a column of each channel): every other channel's nearest value at the reference channel's times, the earlier of two as near.

    series: rows of ``scalars``; channels: entity by column. A recording without the reference has no rows; where another
    channel has none, its column is null.
    """
    from ..operators import resample

    at = series.where(F.col("entity") == channels[reference]).select("path", "t", F.col("value").alias(reference))
    for column, entity in channels.items():
        if column != reference:
            other = series.where(F.col("entity") == entity).select("path", "t", F.col("value").alias(column))
            at = resample.nearest(other, at, ["path"], "t", [column]).drop("source_t")
    return at.select("path", "t", *channels)
