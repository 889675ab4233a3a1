"""A writer of episodes into Parquet files whose real sizes stay below a limit.

Each task streams whole episodes, in order, into files: an episode's frames are encoded, and if the file holds something
and would reach the limit with their bytes, the next file begins. Tasks write under names of their own attempt in a
staging folder and report what they wrote (file, rows, bytes); the commit moves exactly the reported files to their
places, numbered in order, and writes the manifest last. What failed or repeated tasks leave in the staging folder is
deleted, and a reader that goes by the manifest never sees a file that isn't whole.

``write_sized`` deals frames out by ranges of episodes, writes them, and then makes the episode table from the manifest
and the pointers that the tasks left beside their files, so pointers say where rows lie, not where they were planned.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

FORMAT = "framewright_sized"
MANIFEST = "files.json"


def _at(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path if "://" in path else "file://" + path)


@dataclass
class Wrote(WriterCommitMessage):
    """Files of a task, in order: name in the staging folder, first episode, rows, bytes."""

    files: list[tuple[str, int, int, int]]


class _Files:
    """The files of one task attempt."""

    def __init__(self, store: fs.FileSystem, folder: str, schema: pa.Schema, episode: str, limit: int):
        self.store, self.folder, self.schema, self.episode, self.limit = store, folder, schema, episode, limit
        self.attempt, self.done, self.pointers = uuid.uuid4().hex, [], []
        self.writer = self.sink = None

    def _encoded(self, table: pa.Table) -> int:
        """Bytes that a table takes in a file of its own; several in one file take less, for they share its ends."""
        held = pa.BufferOutputStream()
        pq.write_table(table, held, compression="zstd")
        return held.getvalue().size

    def add(self, table: pa.Table) -> None:
        """The frames of one episode."""
        episode = table.column(self.episode)[0].as_py()
        size = self._encoded(table)
        if self.writer is not None and self.held + size >= self.limit:
            self.close()
        if self.writer is None:
            self.name = f"{self.attempt}-{len(self.done)}.parquet"
            self.sink = self.store.open_output_stream(f"{self.folder}/{self.name}")
            self.writer = pq.ParquetWriter(self.sink, self.schema, compression="zstd")
            self.first, self.rows, self.held = episode, 0, 0
        self.pointers.append((episode, self.name, self.rows, self.rows + len(table)))
        self.writer.write_table(table)
        self.held += size
        self.rows += len(table)

    def close(self) -> None:
        if self.writer is not None:
            self.writer.close()
            self.sink.close()
            size = self.store.get_file_info(f"{self.folder}/{self.name}").size
            self.done.append((self.name, self.first, self.rows, size))
            self.writer = None

    def finish(self) -> Wrote:
        self.close()
        if self.pointers:
            columns = [pa.array(c) for c in zip(*self.pointers)]
            table = pa.table(dict(zip(("episode_index", "name", "from_row", "to_row"), columns)))
            with self.store.open_output_stream(f"{self.folder}/pointers/{self.attempt}.parquet") as out:
                pq.write_table(table, out)
        return Wrote(self.done)


class _Writer(DataSourceArrowWriter):
    def __init__(self, options: dict[str, str]):
        self.root, self.episode = options["path"], options["episode"]
        self.limit, self.per_chunk = int(options["limit"]), int(options["files_per_chunk"])
        self.each = options.get("each", "") == "true"
        self.run = options["run"]

    @property
    def staged(self) -> str:
        return f"{self.root}/_staged-{self.run}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Wrote:
        store, folder = _at(self.staged)
        store.create_dir(f"{folder}/pointers", recursive=True)
        files, held = None, []
        for batch in iterator:
            if not batch.num_rows:
                continue
            files = files or _Files(store, folder, batch.schema, self.episode, self.limit)
            column = batch.column(self.episode).to_numpy(zero_copy_only=False)
            edges = [0, *(i + 1 for i in range(len(column) - 1) if column[i] != column[i + 1]), len(column)]
            for low, high in zip(edges, edges[1:]):
                part = batch.slice(low, high - low)
                if held and held[-1].column(self.episode)[0] != part.column(self.episode)[0]:
                    files.add(pa.Table.from_batches(held))
                    held = []
                held.append(part)
        if held:
            files.add(pa.Table.from_batches(held))
        return files.finish() if files else Wrote([])

    def commit(self, messages: list[Wrote | None]) -> None:
        store, folder = _at(self.staged)
        _, root = _at(self.root)
        found = sorted((f for m in messages if m for f in m.files), key=lambda f: f[1])
        manifest = []
        for k, (name, first, rows, size) in enumerate(found):
            chunk, number = divmod(first if self.each else k, self.per_chunk)
            place = f"data/chunk-{chunk:03d}/" + (f"episode_{first:06d}.parquet" if self.each else f"file-{number:03d}.parquet")
            store.create_dir(f"{root}/data/chunk-{chunk:03d}", recursive=True)
            store.move(f"{folder}/{name}", f"{root}/{place}")
            manifest.append({"name": name, "chunk_index": chunk, "file_index": number, "path": place, "rows": rows, "bytes": size})
        with store.open_output_stream(f"{folder}/{MANIFEST}") as out:
            out.write("\n".join(map(json.dumps, manifest)).encode())
        for left in store.get_file_info(fs.FileSelector(folder)):
            if left.type == fs.FileType.File and left.base_name.endswith(".parquet"):
                store.delete_file(left.path)
        # Last, in one step: from here on the files are there.
        store.move(folder, f"{root}/_written-{self.run}")

    def abort(self, messages: list[Wrote | None]) -> None:
        store, folder = _at(self.staged)
        if store.get_file_info(folder).type == fs.FileType.Directory:
            store.delete_dir(folder)


class SizedFiles(DataSource):
    """Write-only format: options path, episode (a column), limit (bytes of a file), files_per_chunk, run, each (files by episode)."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema, overwrite: bool) -> _Writer:
        return _Writer(dict(self.options))


def write_sized(frames: DataFrame, root: str, limit: int, episode: str = "episode_index", frame: str = "frame_index", files_per_chunk: int = 1000, parts: int | None = None) -> DataFrame:
    """Write frames under ``root``/data in files of less than limit bytes (or of one episode) and the episode table to meta/episodes.

    Returns (episode_index, length, data/chunk_index, data/file_index, from_row, to_row, dataset_from_index,
    dataset_to_index). The last file of each range of episodes may hold little.
    """
    spark, run = frames.sparkSession, uuid.uuid4().hex
    spark.dataSource.register(SizedFiles)
    n = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = frames.repartitionByRange(n, episode).sortWithinPartitions(episode, frame)
    dealt.write.format(FORMAT).options(path=root, episode=episode, limit=str(limit), files_per_chunk=str(files_per_chunk), run=run).mode("append").save()
    return _episodes(spark, root, run)


def write_each(frames: DataFrame, root: str, episode: str = "episode_index", frame: str = "frame_index", per_chunk: int = 1000, parts: int | None = None) -> DataFrame:
    """Write a file for each episode, ``data/chunk-000/episode_000000.parquet``; returns (path, rows, bytes) of the files."""
    spark, run = frames.sparkSession, uuid.uuid4().hex
    spark.dataSource.register(SizedFiles)
    n = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = frames.repartitionByRange(n, episode).sortWithinPartitions(episode, frame)
    dealt.write.format(FORMAT).options(path=root, episode=episode, limit="0", files_per_chunk=str(per_chunk), run=run, each="true").mode("append").save()
    return spark.read.schema("path string, rows long, bytes long").json(f"{root}/_written-{run}/{MANIFEST}")


def _episodes(spark, root: str, run: str) -> DataFrame:
    from ..operators.trajectory import dataset_offsets

    files = spark.read.schema("name string, chunk_index long, file_index long, path string, rows long, bytes long").json(f"{root}/_written-{run}/{MANIFEST}")
    pointers = spark.read.schema("episode_index long, name string, from_row long, to_row long").parquet(f"{root}/_written-{run}/pointers")
    placed = pointers.join(files, "name").select("episode_index", (F.col("to_row") - F.col("from_row")).alias("length"), F.col("chunk_index").alias("data/chunk_index"), F.col("file_index").alias("data/file_index"), "from_row", "to_row")
    files.drop("name").coalesce(1).write.mode("overwrite").parquet(f"{root}/meta/files")
    dataset_offsets(placed).write.mode("overwrite").parquet(f"{root}/meta/episodes")
    return spark.read.parquet(f"{root}/meta/episodes")
