"""Greedy packing of episodes into files of bounded size, over ranges of their order.

An episode opens a new file if the file holds something and would reach the limit: a fold over the episodes in order.
The order is cut into ranges that are read side by side, twice. First each range tells how what is held at its entry
turns into what is held at its exit: the entry only decides which episode is the first to open a file, so that is a step
function with at most as many steps as a file has episodes, and chains that open a file at the same episode are one from
there on. The driver goes through these functions, a row for each range, for the state at every entry; then
each range packs its episodes from there. Groups may be any number and of any size, one group included.

Sizes are taken to a millionth, so sums don't depend on where they begin. Of equal places the smaller size comes first;
a null size counts as 0; null groups are a group.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from ..operators.ranges import PART, dealt

UNIT = 1_000_000


class _Transfer:
    """How entry turns into exit within the first group of a range, by rows in order."""

    def __init__(self, limit: int):
        self.limit, self.total, self.low = limit, 0, None
        self.cuts: list[int] = []  # an entry from cuts[i] up to before cuts[i - 1] opens its first file with chain[i]
        self.chain: list[int] = []
        # A chain is what is held, the files opened so far, and, once joined to another, that one and the difference in files.
        self.held: list[int] = []
        self.files: list[int] = []
        self.into: list[tuple[int, int] | None] = []
        self.live: list[int] = []

    def _new(self, held: int, files: int) -> int:
        self.held.append(held)
        self.files.append(files)
        self.into.append(None)
        return len(self.held) - 1

    def add(self, size: int) -> None:
        opened, on = [], []
        for c in self.live:
            (opened if self.held[c] + size >= self.limit else on).append(c)
        for c in on:
            self.held[c] += size
        for c in opened:
            self.files[c] += 1
            self.held[c] = size
        if self.total == 0 and self.low is None:
            on.append(self._new(size, 0))  # chain 0: nothing is held at entry
        cut = self.limit - self.total - size
        if self.low is None or cut < self.low and self.low > 0:
            c = self._new(size, 1)
            self.cuts.append(cut)
            self.chain.append(c)
            self.low = cut
            opened.append(c)
        if opened:
            first = opened[0]
            for c in opened[1:]:
                self.into[c] = (first, self.files[c] - self.files[first])
            on.append(first)
        self.live = on
        self.total += size

    def _exit(self, c: int) -> tuple[int, int]:
        more = 0
        while self.into[c] is not None:
            c, d = self.into[c]
            more += d
        return self.held[c], self.files[c] + more

    def exits(self) -> tuple[list[int], list[int], list[int]]:
        """(cuts; held and files: of an empty entry, then of each cut)."""
        ends = [self._exit(c) for c in [0, *self.chain]]
        return self.cuts, [e[0] for e in ends], [e[1] for e in ends]


def _keyed(batches: Iterator[pa.RecordBatch], group: list[str]) -> Iterator[tuple[pa.RecordBatch, list[tuple]]]:
    for batch in batches:
        keys = zip(batch.column(PART).to_pylist(), *(batch.column(g).to_pylist() for g in group))
        yield batch, list(keys)


def _transfers(ordered: DataFrame, group: list[str], limit: int) -> DataFrame:
    """A row for each range: part, first, last (its groups), total, cuts, held, files, and the exit if it holds several groups."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = first = transfer = later = None

        def told() -> pa.RecordBatch:
            cuts, held, files = transfer.exits()
            one = {"part": at[0], "first": repr(first[1:]), "last": repr(at[1:]), "total": transfer.total, "cuts": cuts, "held": held, "files": files, "later_held": later and later[0], "later_files": later and later[1]}
            return pa.RecordBatch.from_pylist([one], schema)

        for batch, keys in _keyed(batches, group):
            for key, size in zip(keys, batch.column("__size").to_pylist()):
                if at is None or key[0] != at[0]:
                    if at is not None:
                        yield told()
                    first, transfer, later = key, _Transfer(limit), None
                elif key != at:
                    later = [size, 0]
                    at = key
                    continue
                at = key
                if later is None:
                    transfer.add(size)
                elif later[0] + size >= limit:
                    later = [size, later[1] + 1]
                else:
                    later[0] += size
        if at is not None:
            yield told()

    longs = pa.list_(pa.int64())
    schema = pa.schema([("part", pa.int32()), ("first", pa.string()), ("last", pa.string()), ("total", pa.int64()), ("cuts", longs), ("held", longs), ("files", longs), ("later_held", pa.int64()), ("later_files", pa.int64())])
    return ordered.select(PART, *group, "__size").mapInArrow(run, "part int, first string, last string, total long, cuts array<long>, held array<long>, files array<long>, later_held long, later_files long")


def _entries(transfers: DataFrame) -> dict[int, tuple[str, int, int]]:
    """For each range (the group before it, held, ordinal) at its entry."""
    state, entries = ("", 0, 0), {}
    # A row for each range, a parameter, with a number for each episode that can be the first to open a file in it.
    for r in sorted(transfers.collect(), key=lambda r: r.part):
        last, held, ordinal = state
        entries[r.part] = state
        if r.later_held is not None:
            state = (r.last, r.later_held, r.later_files)
            continue
        if r.first != last:
            state = (r.last, r.held[0], r.files[0])
            continue
        # The first cut that the entry reaches; cuts fall.
        i = len(r.cuts) - bisect_right(r.cuts[::-1], held)
        state = (r.last, held + r.total, ordinal) if i == len(r.cuts) else (r.last, r.held[i + 1], ordinal + r.files[i + 1])
    return entries


def pack(episodes: DataFrame, group: list[str], order: str, size: str, limit: float, files_per_chunk: int = 1000, parts: int | None = None) -> DataFrame:
    """episodes and ordinal (of the file within its group), chunk_index, file_index."""
    plain = episodes.drop("ordinal")
    exact = F.coalesce(F.round(F.col(size).cast("double") * UNIT).cast("long"), F.lit(0).cast("long"))
    ranges = dealt(plain.withColumn("__size", exact), [*group, order, "__size"], parts)
    n = parts or int(episodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = ranges.repartition(n, PART).sortWithinPartitions(PART, *group, order, "__size")
    most = round(limit * UNIT)
    entries = _entries(_transfers(ordered, group, most))

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, ordinal = None, 0, 0
        for batch, keys in _keyed(batches, group):
            ordinals = []
            for key, s in zip(keys, batch.column("__size").to_pylist()):
                goes_on = key == at
                if at is None or key[0] != at[0]:
                    last, held, ordinal = entries[key[0]]
                    goes_on = last == repr(key[1:])
                if not goes_on:
                    held, ordinal = s, 0
                elif held + s >= most:
                    held, ordinal = s, ordinal + 1
                else:
                    held += s
                at = key
                ordinals.append(ordinal)
            yield batch.drop_columns(["__size", PART]).append_column("ordinal", pa.array(ordinals, pa.int64()))

    out = ordered.mapInArrow(fold, StructType([*plain.schema.fields]).add("ordinal", LongType()))
    return out.withColumns({"chunk_index": F.floor(F.col("ordinal") / files_per_chunk), "file_index": F.col("ordinal") % files_per_chunk})
