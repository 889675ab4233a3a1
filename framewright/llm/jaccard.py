"""N-gram Jaccard join with parity sketches.

A document's shingles are hashed to 64 bits; each flips one bit of a sketch, so the Hamming distance of two sketches is
no more than their sets' symmetric difference, which the threshold bounds by the sizes alone:
|A^B| <= D = (1-t)/(1+t) (|A|+|B|). Shingles have one order for all sets: the rarer first, by counts of hash cells over the
whole table (which decide about work, never about results), then by hash. A set that links shares t|A| of its shingles at
least, so of its first |A| - t|A| + SHARED no fewer than SHARED are in the other set, and among the first of that one
too: they are its pigeonholes and the keys that it sends. A key carries the set's size and its place there; where the
shingles from that place on can't make up for what the two sizes ask, the pair does not meet there. The first SHARED that
linked sets have in common always pass. A set that could link with none but its equals sends nothing. Thresholds below
67 percent could link sets with fewer than SHARED shingles in common and are refused.

Sets that are equal are one class from the start. Then:

1. Keys meet in buckets. Two classes that alone share a key are a pair of it; of keys with more, each class is paired with
   the key's first, and the key is held for step 3. A pair of SHARED keys or more is a candidate: one with fewer either
   doesn't link or shares a held key.
2. A candidate pair must pass the sizes, the Hamming distance of parity sketches (1024 bits, and from 2,048 shingles on
   bits in proportion to the set, folded to the shorter of two), and the exact sets.
3. In keys that still hold several components, each class outside the key's largest takes its partners in other
   components, nearest first by sketch; those pass the same tests, and components grow with each link. A key is left as
   soon as no such partner remains in it. So a group of near copies seldom comes to all its pairs, and none that could
   link two components is left out. A key with many classes is dealt to tasks as pairs of chunks.
4. Connected components of the links: those of step 2, then those that the links of step 3 make of them.

A task sends a class once, and a key once for each slice; the rest of a slice's holders of a key go past the buckets.

Null and empty texts and texts without words have no shingles and are their own component. Repeated rows are linked (if
they have words). A null doc_id is never the component's name unless there is no other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from .components import components
from .hashing import Words, pack5, unpack5
from .phrases import Bloom
from .substrings import _by_bucket, _rows

SKETCH_BITS = 1024

#: Keys that linked sets share at least.
SHARED = 3

#: Cells of the shingle counts, and the rows that a task's counts are sent in. Counts decide the order of shingles only.
CELL_BITS, CELL_ROWS = 22, 64

#: Classes of one key up to which all pairs are tested as to sizes and places before the key is held.
FEW = 16

#: Shingles of which SKETCH_BITS still tell unrelated sets apart; the wide sketch of a larger set doubles with it.
SKETCHED = 2048

#: Classes of one key, and shingles of theirs, of about which a chunk is made; keys with more are dealt as pairs of chunks.
CHUNK, CHUNK_SHINGLES = 512, 1 << 20

BUCKET_BYTES, LEAST_BUCKETS = 4 << 20, 256
U = np.uint64


def bound(total, percent: int):
    """The largest symmetric difference of two linked sets with ``total`` shingles in all."""
    return total * (100 - percent) // (100 + percent)


class Shingles:
    """Sorted distinct shingle hashes of some texts; those of text k are at first[k]:first[k + 1]."""

    def __init__(self, texts: list[bytes], n: int):
        w = Words(texts, lower=True)
        owner = np.repeat(np.arange(len(texts)), w.counts)
        h, whole = w.windows(n)
        hs, owners = [h[whole]], [owner[: len(h)][whole]]
        for short in range(1, n):
            h, whole = w.windows(short)
            only = whole & (w.counts[owner[: len(h)]] == short)
            hs.append(h[only])
            owners.append(owner[: len(h)][only])
        h, owner = np.concatenate(hs), np.concatenate(owners)
        order = np.lexsort((h, owner))
        h, owner = h[order], owner[order]
        new = np.append(True, (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])) if len(h) else np.zeros(0, bool)
        self.hashes, self.owner = h[new], owner[new]
        self.counts = np.bincount(self.owner, minlength=len(texts))
        self.first = np.append(0, np.cumsum(self.counts))
        sums = np.append(U(0), np.cumsum(common.mix64(self.hashes ^ U(0xA5A5F00D12345678))))
        self.classes = common.mix64(sums[self.first[1:]] - sums[self.first[:-1]] + self.counts.astype(np.uint64) * U(0x9E3779B97F4A7C15)).view(np.int64)

    def sketches(self) -> np.ndarray:
        out = []
        for at in range(0, len(self.counts), 1024):
            upto = min(len(self.counts), at + 1024)
            part = slice(self.first[at], self.first[upto])
            bit = (self.owner[part] - at) * SKETCH_BITS + (self.hashes[part] & U(SKETCH_BITS - 1)).astype(np.int64)
            odd = (np.bincount(bit, minlength=(upto - at) * SKETCH_BITS) & 1).astype(np.uint8)
            out.append(np.packbits(odd.reshape(-1, SKETCH_BITS), axis=1))
        return np.concatenate(out) if out else np.zeros((0, SKETCH_BITS // 8), np.uint8)

    def wide(self, k: int) -> bytes:
        """Text k's sketch with bits in proportion to its set."""
        n = int(self.counts[k])
        bits = SKETCH_BITS << max(0, (-(-n // SKETCHED) - 1).bit_length())
        at = (self.hashes[self.first[k] : self.first[k + 1]] & U(bits - 1)).astype(np.int64)
        return np.packbits((np.bincount(at, minlength=bits) & 1).astype(np.uint8)).tobytes()

    def keys(self, texts: np.ndarray, percent: int, levels: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(keys, their texts, places not counting the first SHARED) of the texts named by number."""
        n = self.counts[texts]
        who = texts[100 * n >= percent * (n + 1)]
        n = self.counts[who]
        at, row = _ranges(self.first[who], n)
        h = self.hashes[at]
        # Hashes rise within a text and sorting is stable, so what ties here goes by the whole hash.
        order = np.lexsort((levels[h >> U(64 - CELL_BITS)].astype(np.uint64) << U(56) | h >> U(8), row))
        at, row = _ranges(np.cumsum(n) - n, n - -(-n * percent // 100) + SHARED)
        place = _ranges(np.zeros(len(n), np.int64), n - -(-n * percent // 100) + SHARED)[0]
        return common.mix64(h[order[at]] ^ U(0xD6E8FEB86659FD93)), who[row], np.maximum(place + 1 - SHARED, 0)


def _short(x: np.ndarray) -> np.ndarray:
    """16 bits of which ``_least`` and ``_most`` tell a number's bounds: exact below 2048, the leading 11 bits beyond."""
    shift = np.maximum(np.frexp(x.astype(float))[1] - 11, 0)
    return (shift << 11 | x >> shift).astype("<u2")


def _least(code: np.ndarray) -> np.ndarray:
    code = code.astype(np.int64)
    return (code & 2047) << (code >> 11)


def _most(code: np.ndarray) -> np.ndarray:
    code = code.astype(np.int64)
    return (((code & 2047) + 1) << (code >> 11)) - 1


def _ranges(start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers start..start+size of each row, and the rows."""
    row = np.repeat(np.arange(len(size)), size)
    return np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + start[row], row


_SENT = "kind int, doc_id long, n long, cls long, sketch binary, wide binary, bucket long, packed binary, key long, first long"
_NAMES = [x.split()[0] for x in _SENT.split(", ")]
_TYPES = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.binary(), pa.int64(), pa.int64()]


def _table(names, types, **columns) -> pa.RecordBatch:
    size = len(next(iter(columns.values())))
    return pa.RecordBatch.from_arrays([pa.array(columns[n], t) if n in columns else pa.nulls(size, t) for n, t in zip(names, types)], names)


def _levels(docs: DataFrame, n: int) -> np.ndarray:
    """By cell of the shingle hashes, how often they occur (a byte, on a scale of logarithms)."""
    width = (1 << CELL_BITS) // CELL_ROWS

    def rows(total: np.ndarray) -> pa.RecordBatch:
        cells = np.ascontiguousarray(np.minimum(total, 255).astype(np.uint8)).reshape(CELL_ROWS, width)
        return pa.RecordBatch.from_arrays([pa.array(range(CELL_ROWS), pa.int32()), pa.array([c.tobytes() for c in cells], pa.binary())], ["row", "cells"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << CELL_BITS, np.int32)
        for rb in common.slices(batches, "text"):
            h, whole = Words(common.utf8(rb), lower=True).windows(n)
            np.add.at(total, (h[whole] >> U(64 - CELL_BITS)).astype(np.int64), 1)
        if total.any():
            yield rows(total)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for rb in batches:
            for row, cells in zip(rb.column("row").to_pylist(), rb.column("cells").to_pylist()):
                total[row] = total.get(row, 0) + np.frombuffer(cells, np.uint8).astype(np.int64)
        out = [np.minimum(12 * np.log2(1 + t), 255).astype(np.uint8).tobytes() for t in total.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array(out, pa.binary())], ["row", "cells"])

    counted = docs.select("text").mapInArrow(common.tidy(count), "row int, cells binary").repartition(CELL_ROWS, "row").mapInArrow(add, "row int, cells binary")
    levels = np.zeros((CELL_ROWS, width), np.uint8)
    for r in counted.toLocalIterator():
        levels[r.row] = np.frombuffer(r.cells, np.uint8)
    return levels.ravel()


def _send(docs: DataFrame, n: int, percent: int, buckets: int) -> DataFrame:
    """kind 0: a row for each document; 1: packed (key, class, size, place) by bucket; 2: a key's further classes within a slice."""

    shipped = docs.sparkSession.sparkContext.broadcast(_levels(docs, n))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[int] = set()
        for rb in common.slices(batches, "text"):
            s = Shingles(common.utf8(rb), n)
            fresh = []
            for k, c in enumerate(s.classes.tolist()):
                if s.counts[k] and c not in sent:
                    sent.add(c)
                    fresh.append(k)
            if len(sent) > 1_000_000:
                sent.clear()  # a class may then be sent again, which does no harm
            fresh = np.array(fresh, np.int64)
            sketch, wide = np.full(len(s.counts), None, object), np.full(len(s.counts), None, object)
            if len(fresh):
                made = s.sketches()
                for k in fresh.tolist():
                    sketch[k] = made[k].tobytes()
                    if s.counts[k] > SKETCHED:
                        wide[k] = s.wide(k)
            yield _table(_NAMES, _TYPES, kind=np.zeros(len(s.counts), np.int32), doc_id=rb.column("doc_id"), n=s.counts, cls=s.classes, sketch=sketch, wide=wide)
            if not len(fresh):
                continue
            key, who, place = s.keys(fresh, percent, shipped.value)
            if not len(key):
                continue
            bucket = (key >> U(40)) % U(buckets)
            key, cls = bucket << U(40) | key & U((1 << 40) - 2), s.classes[who]  # the last bit: several classes here
            order = np.lexsort((cls, key))
            key, cls, size, place = key[order], cls[order], _short(s.counts[who])[order], _short(place)[order]
            start = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
            count = np.diff(np.append(start, len(key)))
            first = np.repeat(cls[start], count)
            more = np.repeat(count > 1, count) & (cls != first)
            if more.any():
                yield _table(_NAMES, _TYPES, kind=np.full(int(more.sum()), 2, np.int32), key=key[more].view(np.int64), cls=cls[more], first=first[more])
            key = key[start] | (count > 1)
            rows = [(b, pack5(k) + c.astype("<i8").tobytes() + x.tobytes() + y.tobytes()) for b, (k, c, x, y) in _by_bucket(key >> U(40), key, cls[start], size[start], place[start])]
            yield _table(_NAMES, _TYPES, kind=np.ones(len(rows), np.int32), bucket=[b for b, _ in rows], packed=[p for _, p in rows])

    return docs.select("doc_id", "text").mapInArrow(common.tidy(run), _SENT)


def _meet(percent: int):
    def run(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        keys, classes, sizes, places = [], [], [], []
        for p in table.column("packed").to_pylist():
            n = len(p) // 17
            keys.append(unpack5(p[: 5 * n]))
            classes.append(np.frombuffer(p, "<i8", n, 5 * n))
            sizes.append(np.frombuffer(p, "<u2", n, 13 * n))
            places.append(np.frombuffer(p, "<u2", n, 15 * n))
        key, cls, size, place = (np.concatenate(x) for x in (keys, classes, sizes, places))
        order = np.lexsort((cls, key >> U(1)))
        key, cls, size, place = key[order], cls[order], size[order], place[order]
        new = np.append(True, ((key[1:] ^ key[:-1]) > U(1)) | (cls[1:] != cls[:-1]))
        several = np.bitwise_or.reduceat(key & U(1), np.flatnonzero(new)) > 0
        key, cls, size, place = key[new] & ~U(1), cls[new], size[new], place[new]
        start = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        count = np.diff(np.append(start, len(key)))
        several = np.logical_or.reduceat(several, start)

        def meets(x: np.ndarray, y: np.ndarray) -> np.ndarray:
            """Whether rows x and y of one key could be among the first SHARED that linked sets have in common."""
            ok = np.ones(x.shape, bool)
            for p, q in ((x, y), (y, x)):
                ok &= percent * _least(size[q]) + (100 + percent) * _least(place[p]) <= 100 * _most(size[p])
            return ok

        held, a, b = np.zeros(len(key), bool), [], []
        for g in range(2, FEW + 1):
            at = start[(count == g) & ~several][:, None] + np.arange(g)
            x, y = np.triu_indices(g, 1)
            ok = meets(at[:, x], at[:, y])
            found = ok.sum(axis=1)
            # One pair is told at once; where there are more, the key is held for those that meet.
            one, many = ok & (found == 1)[:, None], ok & (found > 1)[:, None]
            told = one | many & (x == 0)
            u, v = at[:, x], at[:, y]
            held[u[many]] = held[v[many]] = True
            a.append(u[told])
            b.append(v[told])
        rest = several & (count > 1) | (count > FEW)
        at, row = _ranges(start[rest], count[rest])
        held[at] = True
        first = start[rest][row]
        told = (at != first) & meets(first, at)
        a, b = np.concatenate([*a, first[told]]), np.concatenate([*b, at[told]])
        pairs, shared = np.zeros((2, 0), np.int64), np.zeros(0, np.int64)
        if len(a):
            pairs, shared = np.unique(np.stack([cls[a], cls[b]]), axis=1, return_counts=True)  # classes rise within a key
        key = (U(bucket) << U(40) | key[held]).view(np.int64)
        n, m = pairs.shape[1], len(key)
        return pa.table(
            {
                "key": pa.concat_arrays([pa.nulls(n, pa.int64()), pa.array(key)]),
                "cls": pa.array(np.concatenate([pairs[0], cls[held]])),
                "first": pa.concat_arrays([pa.array(pairs[1]), pa.nulls(m, pa.int64())]),
                "shared": pa.concat_arrays([pa.array(shared), pa.nulls(m, pa.int64())]),
            }
        )

    return run


def _popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x).sum(axis=-1, dtype=np.int64)


def _passes(na, nb, sa: np.ndarray, sb: np.ndarray, percent: int) -> np.ndarray:
    return (100 * np.minimum(na, nb) >= percent * np.maximum(na, nb)) & (_popcount(sa ^ sb) <= bound(na + nb, percent))


def _sketch_array(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, SKETCH_BITS // 8)


def _far(x: bytes, y: bytes) -> int:
    """Hamming distance of two sketches, the longer folded to the shorter."""
    size = min(len(x), len(y))
    p, q = (np.bitwise_xor.reduce(np.frombuffer(v, np.uint8).reshape(-1, size), axis=0) for v in (x, y))
    return int(_popcount(p ^ q))


def _near(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Of the pairs (a, b) of classes, those that sizes and sketches allow."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            if rb.num_rows:
                na, nb = (rb.column(c).to_numpy(zero_copy_only=False) for c in ("na", "nb"))
                ok = _passes(na, nb, _sketch_array(rb.column("sa")), _sketch_array(rb.column("sb")), percent)
                for k in np.flatnonzero(ok & (np.minimum(na, nb) > SKETCHED)):
                    ok[k] = _far(rb.column("wa")[k].as_py(), rb.column("wb")[k].as_py()) <= bound(na[k] + nb[k], percent)
                yield rb.select(["a", "b"]).filter(pa.array(ok))

    a, b = (classes.select(F.col("cls").alias(x), F.col("n").alias(f"n{x}"), F.col("sketch").alias(f"s{x}"), F.col("wide").alias(f"w{x}")) for x in "ab")
    return pairs.join(a, "a").join(b, "b").select("a", "b", "na", "nb", "sa", "sb", "wa", "wb").mapInArrow(common.tidy(run), "a long, b long")


def _sets(wanted: DataFrame, classes: DataFrame, docs: DataFrame, n: int) -> DataFrame:
    """(cls, hashes): the exact sets of the classes, made anew from a text of each."""
    # Texts aren't shuffled: a filter of bounded size picks them where they lie, and what it lets through by chance goes by the join below.
    ids = wanted.join(classes, "cls").select(F.xxhash64("rep").alias("h"))
    shipped = docs.sparkSession.sparkContext.broadcast(Bloom(ids, wanted.count()))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = (rb.filter(pa.array(shipped.value.holds(rb.column("h").to_numpy().view(U)))) for rb in batches)
        for rb in common.slices(held, "text"):
            s = Shingles(common.utf8(rb), n)
            packed = [s.hashes[x:y].astype("<u8").tobytes() for x, y in zip(s.first[:-1].tolist(), s.first[1:].tolist())]
            yield pa.RecordBatch.from_arrays([pa.array(s.classes), pa.array(packed, pa.binary())], ["cls", "hashes"])

    made = docs.select("text", F.xxhash64("doc_id").alias("h")).mapInArrow(common.tidy(sets), "cls long, hashes binary")
    # Not compressed: the sets of near copies would pack to little, and the planner broadcasts by the size of files.
    return common.stage_table(made.join(wanted, "cls", "left_semi").dropDuplicates(["cls"]), "sets", "none")


def _links(x: bytes, y: bytes, percent: int) -> bool:
    p, q = np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8")
    both = np.concatenate([p, q])
    both.sort()
    same = int((both[1:] == both[:-1]).sum())
    return 100 * same >= percent * (len(p) + len(q) - same)


def _verify(near: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs that link."""

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            ok = [_links(x, y, percent) for x, y in zip(rb.column("ha").to_pylist(), rb.column("hb").to_pylist())]
            yield rb.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    a, b = (sets.select(F.col("cls").alias(x), F.col("hashes").alias(f"h{x}")) for x in "ab")
    return near.join(a, "a").join(b, "b").select("a", "b", "ha", "hb").mapInArrow(common.tidy(exact), "a long, b long")


def _across(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) that join components of a key's classes; members: key, chunks, cls, comp, big, n, sketch.

    Each class that isn't big (in its key's largest component) meets all others of the key in another component. A key
    of several chunks is dealt as pairs of chunks, each a group of its own. Sketches tell first which classes have a
    partner at all, and only those bring their exact sets.
    """
    dealt = members.withColumn("own", F.pmod(F.xxhash64("cls"), "chunks")).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
    dealt = dealt.select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "cls", "comp", "big", "n", "sketch")

    def partners(table: pa.Table):
        """(k, may): each class k that asks, and by class, whether sizes and sketches allow the pair."""
        own, size, i, j = (table.column(c).to_numpy() for c in ("own", "n", "i", "j"))
        big = table.column("big").to_numpy(zero_copy_only=False)
        sketch = _sketch_array(table.column("sketch").combine_chunks()).view(np.uint64)
        for k in np.flatnonzero(~big):
            far = _popcount(sketch[k] ^ sketch)
            # In a group of two chunks only pairs across them: the others have a group of their own.
            yield k, far, (100 * np.minimum(size[k], size) >= percent * np.maximum(size[k], size)) & (far <= bound(size[k] + size, percent)) & ((own != own[k]) | (i == j))

    def asked(table: pa.Table) -> pa.Table:
        comp = table.column("comp").to_numpy()
        some = np.zeros(len(comp), bool)
        for k, _, may in partners(table):
            may &= comp != comp[k]
            some |= may
            some[k] |= may.any()
        return table.filter(pa.array(some))

    def exact(table: pa.Table) -> pa.Table:
        cls, comp = table.column("cls").to_numpy(), table.column("comp").to_numpy().copy()
        hashes = table.column("hashes").combine_chunks()
        a, b = [], []
        for k, far, may in partners(table):
            near = np.flatnonzero(may & (comp != comp[k]))
            near = near[np.lexsort((cls[near], far[near]))]
            while len(near):
                if _links(hashes[k].as_buffer(), hashes[near[0]].as_buffer(), percent):
                    a.append(cls[k])
                    b.append(cls[near[0]])
                    comp[comp == comp[near[0]]] = comp[k]
                near = near[1:]
                near = near[comp[near] != comp[k]]
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    some = common.stage_table(dealt.groupBy("key", "i", "j").applyInArrow(asked, dealt.schema), "asked")
    return some.join(sets, "cls").groupBy("key", "i", "j").applyInArrow(exact, "a long, b long")


def _labelled(df: DataFrame, labels: DataFrame) -> DataFrame:
    """df with ``comp``, the component of its class so far."""
    return df.join(labels.withColumnRenamed("node", "cls"), "cls", "left").withColumn("comp", F.coalesce("label", "cls")).drop("label")


def jaccard_groups(df: DataFrame, n: int, percent: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_shingles, component_id of the links with 100 |A&B| >= percent |A|B|.

    Components only: pairs within a component are skipped, so there are neither pairs nor a document's number of links.
    """
    if percent < 67:
        raise ValueError(f"a threshold below 67 percent could link sets with fewer than {SHARED} shingles in common")
    docs = common.text_rows(df, id_col, text_col)
    size = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    buckets = max(LEAST_BUCKETS, size * 5 // 6 // BUCKET_BYTES)
    sent = common.stage_table(_send(docs, n, percent, buckets), "sent", by="kind")
    rows = sent.where("kind = 0").select("doc_id", "n", "cls", "sketch", "wide")
    reps = rows.where("n > 0").groupBy("cls").agg(F.min("doc_id").alias("rep"))
    sketches = rows.where("sketch is not null").select("cls", "n", "sketch", "wide").dropDuplicates(["cls"])
    classes = common.stage_table(reps.join(sketches, "cls"), "classes", "none")
    met = sent.where("kind = 1").select("bucket", "packed").groupBy("bucket").applyInArrow(_meet(percent), "key long, cls long, first long, shared long")
    met = common.stage_table(met, "met")
    common.discard(sent, "kind=1")
    beside = sent.where("kind = 2").select("key", "cls", "first")
    pairs = met.where("key is null").select(F.col("cls").alias("a"), F.col("first").alias("b"), "shared")
    pairs = pairs.unionByName(beside.select(F.least("cls", "first").alias("a"), F.greatest("cls", "first").alias("b"), F.lit(1).cast("long").alias("shared")))
    pairs = pairs.groupBy("a", "b").agg(F.sum("shared").alias("shared")).where(F.col("shared") >= SHARED).select("a", "b")
    near = common.stage_table(_near(pairs, classes, percent), "near")
    holders = met.where("key is not null").select("key", "cls").unionByName(beside.select("key", "cls")).unionByName(beside.select("key", F.col("first").alias("cls"))).distinct()
    # Keys of two classes are done with their pair.
    holders = common.stage_table(holders.join(holders.groupBy("key").count().where("count > 2").select("key"), "key", "left_semi"), "holders")
    wanted = near.select(F.col("a").alias("cls")).unionByName(near.select(F.col("b").alias("cls"))).unionByName(holders.select("cls")).distinct()
    sets = _sets(common.stage_table(wanted, "wanted"), classes, docs, n)
    links = common.stage_table(_verify(near, sets, percent), "links")
    labels = components(links)
    holders = _labelled(holders, labels).join(classes.select("cls", "n"), "cls")
    # Keys that hold several components; many keys hold the same classes, and one of them is enough.
    own = holders.groupBy("key", "comp").agg(F.count("*").alias("c"), F.sum("n").alias("n"), F.bit_xor(F.xxhash64("cls")).alias("x"), F.bit_xor(F.xxhash64("cls", F.lit(1))).alias("y"))
    keys = own.groupBy("key").agg(F.sum("c").alias("g"), F.sum("n").alias("n"), F.count("*").alias("comps"), F.max_by("comp", F.struct("c", "comp")).alias("most"), F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"))
    chunks = F.ceil(F.greatest(F.col("g") / CHUNK, F.col("n") / CHUNK_SHINGLES)).cast("long")
    keys = keys.where("comps > 1").withColumn("chunks", chunks).groupBy("g", "x", "y").agg(F.min(F.struct("key", "most", "chunks")).alias("k")).select("k.*")
    members = holders.drop("n").join(keys, "key").join(classes, "cls").select("key", "chunks", "cls", "comp", (F.col("comp") == F.col("most")).alias("big"), "n", "sketch")
    found = common.stage_table(_across(common.stage_table(members, "members"), sets, percent), "across")
    named = _labelled(classes.select("cls", "rep"), labels)
    if found.limit(1).count():
        # Components of components: a link's ends stand for what they are in already.
        ends = (_labelled(found.select(F.col(x).alias("cls"), F.col("a").alias("l0"), F.col("b").alias("l1")), labels).select("l0", "l1", F.col("comp").alias(f"c{x}")) for x in "ab")
        merged = components(next(ends).join(next(ends), ["l0", "l1"]).select(F.col("ca").alias("a"), F.col("cb").alias("b")))
        named = named.join(merged.select(F.col("node").alias("comp"), "label"), "comp", "left").select("cls", "rep", F.coalesce("label", "comp").alias("comp"))
    common.discard(sets)
    least = named.groupBy("comp").agg(F.min("rep").alias("component_id"))
    named = named.join(least, "comp").select("cls", "component_id")
    done = rows.where("n > 0").join(named, "cls").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    return done.unionByName(rows.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")))


def op2_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_groups(common.documents(spark, sf_dir), 4, 85)
