"""Readers and writers of episodic files: Parquet, JSON lines, CSV, NumPy archives, safetensors, TFRecord, folders.

Schemas are given, never inferred. Binary formats are read through Spark's own binaryFile source, so any store that
Spark reads will do, and decoded a file at a time in Arrow batches.
"""

from __future__ import annotations

import io
import json
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_parquet(spark: SparkSession, path: str, columns: list[str] | None = None, where: Column | str | None = None) -> DataFrame:
    """Columns and a predicate, both pushed into the scan."""
    df = spark.read.parquet(path)
    if where is not None:
        df = df.where(where)
    return df.select(*columns) if columns else df


def read_episode(spark: SparkSession, path: str, episode: int, columns: list[str] | None = None) -> DataFrame:
    return read_parquet(spark, path, columns, F.col("episode_index") == episode)


def read_jsonl(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """JSON lines; blank lines are skipped."""
    return spark.read.schema(schema).json(path)


def read_csv_tasks(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """A table of instructions with a header; repeated rows once."""
    return spark.read.schema(schema).option("header", True).csv(path).dropDuplicates()


def list_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """path, name, stem, number (the last in the name) and length of every file below a folder, in natural order.

    Only names are read, not contents.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(path).select("path", "length")
    name = F.element_at(F.split("path", "/"), -1)
    stem = F.regexp_replace(name, r"\.[^.]*$", "")
    return files.withColumns({"name": name, "stem": stem, "number": F.nullif(F.regexp_extract(stem, r"(\d+)\D*$", 1), F.lit("")).cast("long")}).orderBy("number", "name")


def read_npz_steps(spark: SparkSession, path: str, key: str, fields: dict[str, int]) -> DataFrame:
    """path, step and a vector for each field, of archives that hold an object array of dicts under ``key``.

    Object arrays are pickled, so read only files that you trust.
    """
    schema = "path string, step long, " + ", ".join(f"`{f}` array<double>" for f in fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for where, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist()):
                steps = np.load(io.BytesIO(content), allow_pickle=True)[key]
                columns = [[np.ravel(s[f]).astype(np.float64).tolist() for s in steps] for f in fields]
                for name, column in zip(fields, columns):
                    if any(len(v) != fields[name] for v in column):
                        raise ValueError(f"{where}: {name} has another width than {fields[name]}")
                yield pa.RecordBatch.from_arrays([pa.array([where] * len(steps)), pa.array(range(len(steps)), pa.int64()), *(pa.array(c, pa.list_(pa.float64())) for c in columns)], ["path", "step", *fields])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, schema)


# Element types of the safetensors format.
SAFETENSORS = {"F64": "<f8", "F32": "<f4", "F16": "<f2", "I64": "<i8", "I32": "<i4", "I16": "<i2", "I8": "i1", "U8": "u1", "BOOL": "?"}


def read_safetensors(spark: SparkSession, path: str) -> DataFrame:
    """path, name, shape, values (double) of every tensor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for where, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist()):
                size = struct.unpack_from("<Q", content)[0]
                head = json.loads(content[8 : 8 + size])
                rows = [(where, n, t["shape"], np.frombuffer(content[8 + size + t["data_offsets"][0] : 8 + size + t["data_offsets"][1]], SAFETENSORS[t["dtype"]]).astype(np.float64).tolist()) for n, t in head.items() if n != "__metadata__"]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 4, (pa.string(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.float64())))], ["path", "name", "shape", "values"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, "path string, name string, shape array<long>, values array<double>")


def nested_stats(flat: dict[str, object]) -> dict:
    """{"a/b": 1} -> {"a": {"b": 1}}"""
    out: dict = {}
    for key, value in flat.items():
        *above, last = key.split("/")
        at = out
        for k in above:
            at = at.setdefault(k, {})
        at[last] = value
    return out


def flat_stats(nested: dict, prefix: str = "") -> dict[str, object]:
    out = {}
    for key, value in nested.items():
        name = f"{prefix}/{key}" if prefix else key
        out |= flat_stats(value, name) if isinstance(value, dict) else {name: value}
    return out


# --- TFRecord ------------------------------------------------------------------------------------
def _crc_table() -> list[int]:
    out = []
    for n in range(256):
        for _ in range(8):
            n = n >> 1 ^ (0x82F63B78 if n & 1 else 0)
        out.append(n)
    return out


_CRC = _crc_table()


def masked_crc32c(data: bytes) -> int:
    crc = 0xFFFFFFFF
    for b in data:
        crc = crc >> 8 ^ _CRC[(crc ^ b) & 255]
    crc ^= 0xFFFFFFFF
    return ((crc >> 15 | crc << 17) + 0xA282EAD8) & 0xFFFFFFFF


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        b = data[at]
        at += 1
        value |= (b & 127) << shift
        if b < 128:
            return value, at
        shift += 7


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """(number, bytes or integer) of a protobuf message."""
    at = 0
    while at < len(data):
        tag, at = _varint(data, at)
        if tag & 7 == 0:
            value, at = _varint(data, at)
        elif tag & 7 == 2:
            n, at = _varint(data, at)
            value, at = data[at : at + n], at + n
        else:
            n = {1: 8, 5: 4}[tag & 7]
            value, at = data[at : at + n], at + n
        yield tag >> 3, value


def parse_example(data: bytes) -> dict[str, list]:
    """Features of a tf.train.Example: name -> list of bytes, floats or integers."""
    out: dict[str, list] = {}
    for number, features in _fields(data):
        if number != 1:
            continue
        for _, entry in _fields(features):
            pair = dict(_fields(entry))
            values: list = []
            for kind, packed in _fields(pair.get(2, b"")):
                for _, v in _fields(packed):
                    if kind == 1:
                        values.append(v)
                    elif kind == 2:
                        values += np.frombuffer(v, "<f4").tolist()
                    elif isinstance(v, int):
                        values.append(v - (1 << 64) if v >> 63 else v)
                    else:
                        at = 0
                        while at < len(v):
                            x, at = _varint(v, at)
                            values.append(x - (1 << 64) if x >> 63 else x)
            out[pair[1].decode()] = values
    return out


def _emit(value: int) -> bytes:
    out = bytearray()
    while value > 127:
        out.append(value & 127 | 128)
        value >>= 7
    out.append(value)
    return bytes(out)


def _block(number: int, data: bytes) -> bytes:
    return _emit(number << 3 | 2) + _emit(len(data)) + data


def make_example(features: dict[str, list]) -> bytes:
    out = b""
    for name, values in features.items():
        if values and isinstance(values[0], (bytes, str)):
            kind = _block(1, b"".join(_block(1, v.encode() if isinstance(v, str) else v) for v in values))
        elif values and isinstance(values[0], float):
            kind = _block(2, _block(1, np.array(values, "<f4").tobytes()))
        else:
            kind = _block(3, _block(1, b"".join(_emit(int(v) & (1 << 64) - 1) for v in values)))
        out += _block(1, _block(1, name.encode()) + _block(2, kind))
    return _block(1, out)


def records(content: bytes) -> Iterator[bytes]:
    """Records of a TFRecord file, their checksums verified."""
    at = 0
    while at < len(content):
        n, crc = struct.unpack_from("<QI", content, at)
        data = content[at + 12 : at + 12 + n]
        if crc != masked_crc32c(content[at : at + 8]) or len(data) < n or struct.unpack_from("<I", content, at + 12 + n)[0] != masked_crc32c(data):
            raise ValueError(f"damaged record at byte {at}")
        yield data
        at += n + 16


def frame(data: bytes) -> bytes:
    size = struct.pack("<Q", len(data))
    return size + struct.pack("<I", masked_crc32c(size)) + data + struct.pack("<I", masked_crc32c(data))


def read_tfrecords(spark: SparkSession, path: str) -> DataFrame:
    """path, ordinal, feature, and its values as floats, integers or bytes: a row for each feature of each record."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = (pa.string(), pa.int64(), pa.string(), pa.list_(pa.float64()), pa.list_(pa.int64()), pa.list_(pa.binary()))
        names = ["path", "ordinal", "feature", "floats", "longs", "bytes"]
        for batch in batches:
            for where, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist()):
                rows = []
                for k, r in enumerate(records(content)):
                    for name, v in parse_example(r).items():
                        kind = type(v[0]) if v else int
                        rows.append((where, k, name, v if kind is float else None, v if kind is int else None, v if kind is bytes else None))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 6, types)], names)

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, "path string, ordinal long, feature string, floats array<double>, longs array<long>, bytes array<binary>")


def tfrecord_payload(nested: DataFrame, columns: list[str]) -> DataFrame:
    """nested and ``record``: each row's columns as one framed tf.train.Example; arrays of structs are flattened to name/field."""
    schema = StructType([*nested.schema.fields]).add("record", "binary")

    def flatten(row: dict) -> dict[str, list]:
        out: dict[str, list] = {}
        for c in columns:
            v = row[c]
            if isinstance(v, list) and v and isinstance(v[0], dict):
                for f in v[0]:
                    cells = [s[f] for s in v]
                    out[f"{c}/{f}"] = [x for cell in cells for x in (cell if isinstance(cell, list) else [cell])]
            else:
                out[c] = v if isinstance(v, list) else [v]
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = pa.array([frame(make_example(flatten(r))) for r in batch.to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, made], [*batch.schema.names, "record"])

    return nested.mapInArrow(run, schema)


def append_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def read_yaml(spark: SparkSession, path: str, glob: str = "*.yaml") -> DataFrame:
    """(path, json, error): each YAML file's content as JSON text, for ``get_json_object`` and ``from_json``; one without content is {}. Files of no bytes aren't listed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import json

        import yaml

        for batch in batches:
            made = []
            for at, text in zip(batch.column("path").to_pylist(), batch.column("value").to_pylist()):
                try:
                    made.append({"path": at, "json": json.dumps(yaml.safe_load(text) or {}, default=str, ensure_ascii=False), "error": None})
                except yaml.YAMLError as e:
                    made.append({"path": at, "json": None, "error": str(e).splitlines()[0]})
            yield pa.RecordBatch.from_pylist(made, pa.schema([(n, pa.string()) for n in ("path", "json", "error")]))

    texts = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", glob).text(path, wholetext=True)
    return texts.select(F.col("_metadata.file_path").alias("path"), "value").mapInArrow(run, "path string, json string, error string")
