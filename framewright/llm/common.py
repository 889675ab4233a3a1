"""What the training-data operators share: shared-folder tables, batches, hashing.

Null, empty and odd input, the same for every operator unless its docstring says otherwise: a null text counts as
empty, a null id is an ordinary value that stays null, repeated rows each give a row, an empty table gives an empty
result, and further columns are neither read nor returned.
"""

from __future__ import annotations

import ctypes
import gc
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words of all contracts: runs of anything but ASCII white space. ``bytes.split()`` cuts at the same bytes.
WORD = r"[^\x20\x09-\x0D]+"

#: Rows are taken from an Arrow batch in slices of about so many bytes, so memory doesn't depend on the batch size.
SLICE_BYTES = 2 << 20


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir; only where that is unset and all runs in this process (tests), a local one."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        if not re.match(r"local(\[|$)", spark.conf.get("spark.master", "local")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        where = "file://" + tempfile.mkdtemp(prefix="framewright-")
        spark.conf.set("spark.checkpoint.dir", where)
    return where.rstrip("/")


def release(spark: SparkSession) -> None:
    """Let go of shuffles that nothing refers to."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def stage_table(df: DataFrame, tag: str, codec: str = "zstd", by: str | None = None) -> DataFrame:
    """Write df to the shared folder and read it again: cuts lineage and survives the loss of executors.

    by: a column to lay the table out by. What shuffles df needed is let go, for their files else stay on the
    executors' disks until the driver happens to collect its garbage.
    """
    spark, schema = df.sparkSession, df.schema
    path = f"{shared_dir(spark)}/fw-{tag}-{uuid.uuid4().hex}"
    writer = df.write.option("compression", codec)
    (writer.partitionBy(by) if by else writer).parquet(path)
    del df, writer
    release(spark)
    out = spark.read.schema(schema).parquet(path)
    out.staged_at = path
    return out


def discard(df: DataFrame, part: str = "") -> None:
    """Delete a staged table (or a part of it) that nothing will read again."""
    jvm, spark = df.sparkSession.sparkContext._jvm, df.sparkSession
    at = jvm.org.apache.hadoop.fs.Path(f"{df.staged_at}/{part}" if part else df.staged_at)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Rows in order, about ``most`` bytes of ``column`` at a time, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes)
        at = 0
        while at < batch.num_rows:
            base = ends[at - 1] if at else 0
            upto = max(at + 1, int(np.searchsorted(ends, base + most, "right")))
            yield batch.slice(at, upto - at)
            at = upto


def tidy(run: Callable) -> Callable:
    """A function for mapInArrow that returns freed memory to the system when its task ends.

    Python workers outlive a task, and what they keep adds to whatever their executor does next.
    """

    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # glibc's
            trim(0)

    return tidied


def text_rows(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, text) with a null text as empty."""
    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def utf8(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """The texts of a batch as UTF-8 bytes."""
    return batch.column(column).cast(pa.binary()).to_pylist()


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64), vectorised."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Bounded(dict):
    """A memo of two generations of ``most`` entries: a pure cache, so results never depend on it."""

    def __init__(self, make, most: int = 300_000):
        super().__init__()
        self.make, self.most, self.old = make, most, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value

    def forget(self) -> None:
        self.clear()
        self.old = {}
