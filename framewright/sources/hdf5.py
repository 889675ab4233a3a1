"""HDF5 episode files as tables: objects, attributes and rows of datasets.

Three steps, each a DataFrame. ``files`` lists paths by Spark's own reader, which doesn't read contents. ``objects``
follows a file's headers and gives a row for each dataset with the slabs it is stored in: first row, and the place, size
and filter mask of the chunks. ``rows`` decodes slabs, each a unit of its own wherever it lies, so one large file is read
by many tasks, and datasets that aren't asked for are never read. A file that can't be followed is a row with an error.

Read are superblocks 0 to 3, both kinds of object headers, symbol-table and compact groups, compact, contiguous and
chunked (version 1 index or single chunk) layouts, deflate, shuffle and checksum filters, integers, floats, booleans
and strings of fixed or variable length. Anything else is named in the error.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .ranged import RangedFile, Unsupported

_NONE = (1 << 64) - 1
_CHUNK = "struct<start: array<long>, at: long, size: long, mask: int>"
_OBJECTS = f"path string, dataset string, shape array<long>, dtype string, chunk array<long>, filters array<struct<id: int, arg: int>>, slabs array<struct<row: long, chunks: array<{_CHUNK}>>>, error string"


def _root(read: RangedFile) -> int:
    at = 0
    while read(at, 8) != b"\x89HDF\r\n\x1a\n":
        at = at * 2 or 512
    version = read(at + 8, 1)[0]
    if version <= 1:
        if read(at + 13, 2) != b"\x08\x08":
            raise Unsupported("offsets of other than 8 bytes")
        return read.ints(at + 64 + 4 * version, "Q")[0]
    if version <= 3:
        return read.ints(at + 36, "Q")[0]
    raise Unsupported(f"superblock {version}")


def _messages(read: RangedFile, at: int) -> Iterator[tuple[int, bytes]]:
    """(kind, body) of an object's header messages."""
    new = read(at, 4) == b"OHDR"
    if new:
        flags = read(at + 5, 1)[0]
        body = at + 6 + (16 if flags & 0x20 else 0) + (4 if flags & 0x10 else 0)
        width = 1 << (flags & 3)
        blocks = [(body + width, int.from_bytes(read(body, width), "little"))]
        head = 6 if flags & 4 else 4
    else:
        if read(at, 1) != b"\x01":
            raise Unsupported("object header")
        blocks, head = [(at + 16, read.ints(at + 8, "I")[0])], 8
    while blocks:
        at, size = blocks.pop(0)
        end = at + size
        while at + head <= end:
            if new:
                kind, n, flags = read.ints(at, "BHB")
            else:
                kind, n, flags = read.ints(at, "HHB")
            data = read(at + head, n) if n else b""
            at += head + n
            if kind == 0x10:
                where, length = struct.unpack("<QQ", data[:16])
                blocks.append((where + 4, length - 8) if new else (where, length))
            elif flags & 2 and kind in (1, 3, 8, 11):
                raise Unsupported("shared header message")
            else:
                yield kind, data


def _children(read: RangedFile, at: int) -> Iterator[tuple[str, int]]:
    """(name, header) of what a group holds."""
    for kind, data in _messages(read, at):
        if kind == 0x11:
            tree, heap = struct.unpack("<QQ", data[:16])
            names = read.ints(heap + 24, "Q")[0]
            yield from _symbols(read, tree, names)
        elif kind == 0x06:
            flags, p = data[1], 2
            link = data[p] if flags & 8 else 0
            p += (1 if flags & 8 else 0) + (8 if flags & 4 else 0) + (1 if flags & 0x10 else 0)
            width = 1 << (flags & 3)
            n = int.from_bytes(data[p : p + width], "little")
            p += width
            if link == 0:
                yield data[p : p + n].decode(), struct.unpack_from("<Q", data, p + n)[0]
        elif kind == 0x02:
            p = 2 + (8 if data[1] & 1 else 0)
            if struct.unpack_from("<Q", data, p)[0] != _NONE:
                raise Unsupported("group with a link heap")


def _symbols(read: RangedFile, at: int, names: int) -> Iterator[tuple[str, int]]:
    if read(at, 4) == b"SNOD":
        for k in range(read.ints(at + 6, "H")[0]):
            name, header, cached = read.ints(at + 8 + 40 * k, "QQI")
            if cached != 2:  # not a soft link
                text = b""
                while b"\0" not in text:
                    text += read(names + name + len(text), min(32, read.size - names - name - len(text)))
                yield text.split(b"\0")[0].decode(), header
        return
    if read(at, 4) != b"TREE":
        raise Unsupported("group index")
    for k in range(read.ints(at + 6, "H")[0]):
        yield from _symbols(read, read.ints(at + 32 + 16 * k, "Q")[0], names)


def _dtype(data: bytes) -> str:
    """numpy's name of a type; 'V' for text of variable length."""
    kind, bits, size = data[0] & 15, data[1], struct.unpack_from("<I", data, 4)[0]
    order = ">" if bits & 1 else "<"
    if kind == 0:
        return f"{order}{'i' if bits & 8 else 'u'}{size}"
    if kind == 1:
        return f"{order}f{size}"
    if kind == 3:
        return f"S{size}"
    if kind == 8:
        return _dtype(data[8:])
    if kind == 9 and bits & 15 == 1:
        return "V"
    raise Unsupported(f"type of class {kind}")


def _shape(data: bytes) -> list[int]:
    return list(struct.unpack_from(f"<{data[1]}Q", data, 8 if data[0] == 1 else 4))


def _filters(data: bytes) -> list[dict]:
    out, p = [], 8 if data[0] == 1 else 2
    for _ in range(data[1]):
        (kind,) = struct.unpack_from("<H", data, p)
        named = data[0] == 1 or kind >= 256
        name = struct.unpack_from("<H", data, p + 2)[0] if named else 0
        p += 4 if named else 2
        _, n = struct.unpack_from("<HH", data, p)
        p += 4 + (-(-name // 8) * 8 if data[0] == 1 else name)
        args = struct.unpack_from(f"<{n}I", data, p)
        p += 4 * n + (4 if data[0] == 1 and n % 2 else 0)
        if kind not in (1, 2, 3):
            raise Unsupported(f"filter {kind}")
        out.append({"id": kind, "arg": int(args[0]) if args else 0})
    return out


def _indexed(read: RangedFile, at: int, rank: int) -> Iterator[dict]:
    """The chunks of a version 1 index."""
    if at == _NONE:
        return
    if read(at, 4) != b"TREE":
        raise Unsupported("chunk index")
    level, n = read(at + 5, 1)[0], read.ints(at + 6, "H")[0]
    step = 8 + 8 * (rank + 1) + 8
    for k in range(n):
        p = at + 24 + step * k
        size, mask, *start = read.ints(p, f"II{rank}Q")
        child = read.ints(p + step - 8, "Q")[0]
        if level:
            yield from _indexed(read, child, rank)
        else:
            yield {"start": start, "at": child, "size": size, "mask": mask}


def _dataset(read: RangedFile, messages: list[tuple[int, bytes]]) -> dict:
    """shape, dtype, chunk, filters and slabs of a dataset."""
    found = dict(messages)
    if 1 not in found or 3 not in found:
        raise Unsupported("dataset without shape or type")
    shape, dtype, layout = _shape(found[1]), _dtype(found[3]), found[8]
    width = 16 if dtype == "V" else np.dtype(dtype).itemsize
    out = {"shape": shape, "dtype": dtype, "chunk": shape, "filters": _filters(found[11]) if 11 in found else [], "slabs": []}
    rank, whole = len(shape), int(np.prod(shape, dtype=np.int64)) * width
    if layout[0] not in (3, 4):
        raise Unsupported(f"layout {layout[0]}")
    if layout[1] == 0:
        raise Unsupported("compact dataset")
    if layout[1] == 1:
        at = struct.unpack_from("<Q", layout, 2)[0]
        rows = shape[0] if shape else 1
        step = max(1, (4 << 20) // max(1, whole // max(rows, 1)))
        one = whole // max(rows, 1)
        if at != _NONE and whole:
            out["chunk"] = [step, *shape[1:]] if shape else []
            out["slabs"] = [{"row": r, "chunks": [{"start": [r, *[0] * (rank - 1)] if shape else [], "at": at + r * one, "size": min(step, rows - r) * one, "mask": 0}]} for r in range(0, rows, step)]
        return out
    if layout[0] == 3:
        dims = struct.unpack_from(f"<{layout[2]}I", layout, 11)
        chunks = list(_indexed(read, struct.unpack_from("<Q", layout, 3)[0], rank))
        out["chunk"] = list(dims[:-1])
    else:
        n, enc = layout[3], layout[4]
        dims = [int.from_bytes(layout[5 + enc * k : 5 + enc * (k + 1)], "little") for k in range(n)]
        p = 5 + enc * n
        if layout[p] != 1:
            raise Unsupported(f"chunk index {layout[p]}")
        out["chunk"] = dims[:-1] if len(dims) > rank else dims
        size, mask = struct.unpack_from("<QI", layout, p + 1) if layout[2] & 2 else (int(np.prod(dims)) * (1 if len(dims) > rank else width), 0)
        at = struct.unpack_from("<Q", layout, p + 1 + (12 if layout[2] & 2 else 0))[0]
        chunks = [{"start": [0] * rank, "at": at, "size": size, "mask": mask}] if at != _NONE else []
    by: dict[int, list[dict]] = {}
    for c in chunks:
        by.setdefault(c["start"][0] if rank else 0, []).append(c)
    out["slabs"] = [{"row": r, "chunks": by[r]} for r in sorted(by)]
    return out


def _walk(read: RangedFile, at: int, name: str = "") -> Iterator[tuple[str, list[tuple[int, bytes]]]]:
    """(name, messages) of every object, groups before what they hold."""
    messages = list(_messages(read, at))
    yield name, messages
    if not any(kind == 8 for kind, _ in messages):
        for child, header in _children(read, at):
            yield from _walk(read, header, f"{name}/{child}" if name else child)


def files(spark: SparkSession, root: str, glob: str = "*.{h5,hdf5}") -> DataFrame:
    """(path, length) of a folder's files; contents aren't read. Files of no bytes aren't listed."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(root)
    return found.select("path", "length")


def objects(listed: DataFrame) -> DataFrame:
    """A row for each dataset: path, dataset, shape, dtype, chunk, filters, slabs; error, alone, if a file can't be followed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                rows, error = [], None
                try:
                    read = RangedFile(path)
                    for name, messages in _walk(read, _root(read)):
                        if any(kind == 8 for kind, _ in messages):
                            rows.append({"path": path, "dataset": name, **_dataset(read, messages)})
                except (OSError, ValueError, KeyError, struct.error, RecursionError) as e:
                    error = f"{type(e).__name__}: {e}"
                if error:
                    rows = [{"path": path, "error": error}]
                if rows:
                    yield pa.RecordBatch.from_pylist([{n: r.get(n) for n in schema.names} for r in rows], schema)

    longs, chunk = pa.list_(pa.int64()), pa.struct([("start", pa.list_(pa.int64())), ("at", pa.int64()), ("size", pa.int64()), ("mask", pa.int32())])
    schema = pa.schema(
        [("path", pa.string()), ("dataset", pa.string()), ("shape", longs), ("dtype", pa.string()), ("chunk", longs)]
        + [("filters", pa.list_(pa.struct([("id", pa.int32()), ("arg", pa.int32())]))), ("slabs", pa.list_(pa.struct([("row", pa.int64()), ("chunks", pa.list_(chunk))]))), ("error", pa.string())]
    )
    return _spread(listed.select("path"), "path").mapInArrow(run, _OBJECTS)


def attributes(listed: DataFrame) -> DataFrame:
    """(path, object, name, value): attributes as text, JSON for numbers; the root object's name is empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                rows = []
                try:
                    read = RangedFile(path)
                    for name, messages in _walk(read, _root(read)):
                        rows += [{"path": path, "object": name, **_attribute(read, data)} for kind, data in messages if kind == 12]
                except (OSError, ValueError, KeyError, struct.error, RecursionError):
                    rows = []  # named by ``objects``
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    form = "path string, object string, name string, value string"
    schema = pa.schema([(n, pa.string()) for n in ("path", "object", "name", "value")])
    return _spread(listed.select("path"), "path").mapInArrow(run, form)


def _attribute(read: RangedFile, data: bytes) -> dict:
    version, _, n, t, s = struct.unpack_from("<BBHHH", data, 0)
    p = 9 if version == 3 else 8
    wide = (lambda k: -(-k // 8) * 8) if version == 1 else (lambda k: k)
    name = data[p : p + n].split(b"\0")[0].decode()
    kind, space = data[p + wide(n) : p + wide(n) + t], data[p + wide(n) + wide(t) : p + wide(n) + wide(t) + s]
    body = data[p + wide(n) + wide(t) + wide(s) :]
    dtype, shape = _dtype(kind), _shape(space)
    count = int(np.prod(shape, dtype=np.int64))
    values = _decoded(read, body, dtype, count)
    if dtype[0] in "SV":
        return {"name": name, "value": "\n".join(values)}
    return {"name": name, "value": str(values.reshape(shape).tolist())}


def _decoded(read: RangedFile, body: bytes, dtype: str, count: int):
    if dtype == "V":
        out = []
        for k in range(count):
            n, heap, index = struct.unpack_from("<IQI", body, 16 * k)
            out.append(_heap(read, heap, index)[:n].decode(errors="replace") if n else "")
        return out
    values = np.frombuffer(body, dtype, count)
    return [v.decode(errors="replace") for v in values.tolist()] if dtype[0] == "S" else values


def _heap(read: RangedFile, at: int, index: int) -> bytes:
    if read(at, 4) != b"GCOL":
        raise Unsupported("global heap")
    end = at + read.ints(at + 8, "Q")[0]
    at += 16
    while at + 16 <= end:
        number, _, _, size = read.ints(at, "HHIQ")
        if number == index:
            return read(at + 16, size)
        if not number:
            break
        at += 16 + -(-size // 8) * 8
    raise Unsupported("string that the heap doesn't hold")


def _unfiltered(data: bytes, filters: list[dict], mask: int) -> bytes:
    for k in reversed(range(len(filters))):
        if mask >> k & 1:
            continue
        f = filters[k]
        if f["id"] == 1:
            data = zlib.decompress(data)
        elif f["id"] == 3:
            data = data[:-4]
        elif f["arg"] > 1:
            n = len(data) // f["arg"] * f["arg"]
            data = np.frombuffer(data, np.uint8, n).reshape(f["arg"], -1).T.tobytes() + data[n:]
    return data


def _slab(read: RangedFile, row: dict) -> tuple[np.ndarray | list, int]:
    """(the values of a slab's rows, how many rows)."""
    shape, chunk, dtype = row["shape"], row["chunk"], row["dtype"]
    n = min(chunk[0], shape[0] - row["row"])
    if dtype == "V":
        texts: list = []
        for c in row["chunks"]:
            data = _unfiltered(read.raw(c["at"], c["size"]), row["filters"], c["mask"])
            texts += _decoded(read, data, dtype, min(len(data) // 16, n))
        return texts, n
    out = np.zeros((n, *shape[1:]), dtype)
    for c in row["chunks"]:
        data = _unfiltered(read.raw(c["at"], c["size"]), row["filters"], c["mask"])
        whole = len(data) // out.itemsize == int(np.prod(chunk))
        part = np.frombuffer(data, dtype, int(np.prod(chunk if whole else out.shape))).reshape(chunk if whole else out.shape)
        at = [0, *c["start"][1:]]
        ends = [min(a + s, m) for a, s, m in zip(at, part.shape, out.shape)]
        out[tuple(slice(a, e) for a, e in zip(at, ends))] = part[tuple(slice(0, e - a) for a, e in zip(at, ends))]
    return ([v.decode(errors="replace") for v in out.ravel().tolist()] if dtype[0] == "S" else out), n


def rows(found: DataFrame, kind: str = "array<double>") -> DataFrame:
    """(path, dataset, row, value): a row of each dataset along its first dimension.

    found: rows of ``objects``, as many as are wanted. kind: array<double> (a row's values in order), binary (its bytes,
    for images) or string.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read, at = None, None
        for batch in batches:
            for r in batch.to_pylist():
                if r["path"] != at:
                    read, at = RangedFile(r["path"]), r["path"]
                values, n = _slab(read, r)
                if kind == "string":
                    column = pa.array(values, pa.string())
                elif kind == "binary":
                    column = pa.array([v.tobytes() for v in values], pa.binary())
                else:
                    flat = np.ascontiguousarray(values.reshape(n, -1), np.float64)
                    column = pa.ListArray.from_arrays(np.arange(0, flat.size + 1, flat.shape[1], dtype=np.int32) if flat.shape[1] else np.zeros(n + 1, np.int32), flat.ravel())
                yield pa.RecordBatch.from_arrays([pa.array([r["path"]] * n), pa.array([r["dataset"]] * n), pa.array(np.arange(r["row"], r["row"] + n)), column], ["path", "dataset", "row", "value"])

    slabs = found.where("error is null and size(shape) > 0").select("path", "dataset", "shape", "dtype", "chunk", "filters", F.explode("slabs").alias("s"))
    slabs = slabs.select("path", "dataset", "shape", "dtype", "chunk", "filters", "s.*")
    return _spread(slabs, "path", "dataset", "row").mapInArrow(run, f"path string, dataset string, row long, value {kind}")


def frames(found: DataFrame, group: str, columns: dict[str, str]) -> DataFrame:
    """(path, episode, row, and a column of each dataset): the datasets of a group side by side by row.

    group: a pattern whose first bracket is the episode (``data/([^/]+)/`` for files of several), or ``()`` for one
    episode a file; columns: column by dataset name below it. Rows that a dataset lacks are null.
    """
    pattern = f"^{group}"
    named = found.withColumns({"episode": F.regexp_extract("dataset", pattern, 1), "__at": F.regexp_replace("dataset", pattern, "")})
    named = named.where(F.col("error").isNull() & F.col("dataset").rlike(pattern) & F.col("__at").isin(list(columns)))
    long = rows(named.select(found.columns)).withColumns({"episode": F.regexp_extract("dataset", pattern, 1), "__at": F.regexp_replace("dataset", pattern, "")})
    return long.groupBy("path", "episode", "row").agg(*[F.first(F.when(F.col("__at") == at, F.col("value")), ignorenulls=True).alias(name) for at, name in columns.items()])


def statuses(found: DataFrame, wanted: list[str]) -> DataFrame:
    """(path, ok, error): whether a file could be followed and has all wanted datasets."""
    has = found.groupBy("path").agg(F.first("error", ignorenulls=True).alias("error"), F.collect_set(F.when(F.col("dataset").isin(wanted), F.col("dataset"))).alias("has"))
    lacks = F.array_except(F.array(*[F.lit(w) for w in wanted]), "has")
    error = F.coalesce("error", F.when(F.size(lacks) > 0, F.concat(F.lit("KeyError: "), F.array_join(lacks, ", "))))
    return has.select("path", error.isNull().alias("ok"), error.alias("error"))


def _spread(df: DataFrame, *by: str) -> DataFrame:
    """A few large rows over all tasks; the planner, who sees small ones, would give them to one."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, *by)
