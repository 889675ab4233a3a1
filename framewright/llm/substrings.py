"""Substring removal with fixed-block anchors.

A document's words are cut into non-overlapping reference blocks of BLOCK = WINDOW // 2 words; whatever WINDOW-word run
two documents share holds a whole reference block of either. Four steps:

1. Index the reference blocks and probe them with every rolling BLOCK-word window: both go, once for each batch of
   documents and hash, packed in 5 bytes to the hash's bucket. A hash that has an index entry and a second place is a hit.
2. Hits come back to their batches. There a hit is extended: the WINDOW-word windows around it are the candidates.
   Documents without candidates are done.
3. Candidates meet by hash, again once for each batch, with the batch's least doc_id; a batch hears of a window only if
   an earlier document than its own has it.
4. Where windows that an earlier document has overlap or touch, they form its maximal exact repeats; their words go.

Nothing is sent as a pair of documents, so a passage that a third of all documents share costs a row for each batch.
Buckets follow the size of the input, so that one fits a task.

Null and empty texts have no words; documents shorter than a window keep all; equal doc_ids don't remove from each
other; a null doc_id neither loses words nor makes others lose them. Repeated rows each give a row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from . import common
from .hashing import Words, pack5, unpack5

WINDOW = 50

#: Documents of a batch.
BATCH = 1024

#: Bytes of packed hashes that a bucket is given, about, and the least number of buckets.
BUCKET_BYTES, LEAST_BUCKETS = 4 << 20, 256

KEY = np.uint64(38)


def located(df: DataFrame) -> DataFrame:
    """df with ``batch``: a number for every BATCH rows of a file, the same whenever it is read."""
    try:
        at = df.select("*", F.col("_metadata.file_path").alias("__file"), F.col("_metadata.row_index").alias("__row"))
    except AnalysisException:
        at = common.stage_table(df, "rows").select("*", F.col("_metadata.file_path").alias("__file"), F.col("_metadata.row_index").alias("__row"))
    return at.withColumn("batch", F.xxhash64("__file", F.floor(F.col("__row") / BATCH))).drop("__file", "__row")


def _bucket_key(h: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    return (h >> np.uint64(40)) % np.uint64(buckets), h & np.uint64((1 << 38) - 1)


def _rows(names: list[str], types: list, rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * len(types), types)], names)


def _by_bucket(bucket: np.ndarray, *values: np.ndarray):
    """(bucket, its part of each array)."""
    order = np.argsort(bucket, kind="stable")
    bucket, values = bucket[order], [v[order] for v in values]
    cuts = np.flatnonzero(np.diff(bucket)) + 1
    for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(bucket)]):
        if b > a:
            yield int(bucket[a]), [v[a:b] for v in values]


def _probe(docs: DataFrame, block: int, buckets: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in common.slices(batches, "text", 8 << 20):
            places, texts = np.array(rb.column("batch").to_pylist()), common.utf8(rb)
            for batch in dict.fromkeys(places.tolist()):
                w = Words([t for t, p in zip(texts, places) if p == batch])
                h, whole = w.windows(block)
                offset = np.arange(len(h)) - np.repeat(w.first[:-1], w.counts)[: len(h)]
                anchor = (offset % block == 0) & whole
                bucket, key = _bucket_key(h[whole], buckets)
                both = np.sort(bucket << KEY | key)
                index = np.unique((lambda b, k: b << KEY | k)(*_bucket_key(h[anchor], buckets)))
                if not len(both):
                    continue
                new = np.append(True, both[1:] != both[:-1])
                counts = np.diff(np.append(np.flatnonzero(new), len(both)))
                both = both[new]
                is_index = index[np.minimum(np.searchsorted(index, both), len(index) - 1)] == both
                value = (both & np.uint64((1 << 38) - 1)) << np.uint64(2) | is_index.astype(np.uint64) | (counts > 1).astype(np.uint64) << np.uint64(1)
                rows = [(b, batch, pack5(v)) for b, (v,) in _by_bucket(both >> KEY, value)]
                yield _rows(["bucket", "batch", "packed"], [pa.int64(), pa.int64(), pa.binary()], rows)

    return docs.select("batch", "text").mapInArrow(run, "bucket long, batch long, packed binary")


def _hits(table: pa.Table) -> pa.Table:
    bucket = table.column("bucket")[0].as_py()
    parts = [unpack5(x) for x in table.column("packed").to_pylist()]
    sender = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    value = np.concatenate(parts)
    key, flags = value >> np.uint64(2), value & np.uint64(3)
    order = np.argsort(key, kind="stable")
    key, flags, sender = key[order], flags[order], sender[order]
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    count = np.diff(np.append(first, len(key)))
    flag = np.bitwise_or.reduceat(flags, first)
    hit = np.repeat((flag & np.uint64(1) > 0) & ((count > 1) | (flag & np.uint64(2) > 0)), count)
    batches = table.column("batch").to_pylist()
    rows = [(batches[s], bucket, pack5(k)) for s, (k,) in _by_bucket(sender[hit], key[hit])]
    return pa.Table.from_batches([_rows(["batch", "bucket", "packed"], [pa.int64(), pa.int64(), pa.binary()], rows)])


def _kept(raw: bytes, gone: np.ndarray | None) -> bytes:
    """The kept words joined by one blank."""
    if gone is None or not gone.any():
        return b" ".join(raw.split())
    return b" ".join(w for w, g in zip(raw.split(), gone.tolist()) if not g)


_DONE = "kind int, batch long, doc_id long, n_words long, n_removed long, kept_sha256 string, text string, bucket long, packed binary"
_NAMES = [x.split()[0] for x in _DONE.split(", ")]
_TYPES = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]


def _pieces(table: pa.Table) -> Iterator[pa.RecordBatch]:
    return common.slices(iter(table.to_batches()), "text", 4 << 20)


def _extend(block: int, window: int, buckets: int, texts: bool):
    def run(docs: pa.Table, hits: pa.Table) -> pa.Table:
        out, found = [], []
        if not docs.num_rows:
            return pa.Table.from_batches([_rows(_NAMES, _TYPES, [])])
        batch = docs.column("batch")[0].as_py()
        known = [np.uint64(b) << KEY | unpack5(p) for b, p in zip(hits.column("bucket").to_pylist(), hits.column("packed").to_pylist())]
        known = np.sort(np.concatenate(known)) if known else np.zeros(0, np.uint64)
        for rb in _pieces(docs):
            raw, ids, text = common.utf8(rb), rb.column("doc_id").to_pylist(), rb.column("text")
            w = Words(raw)
            h, whole = w.windows(block)
            around = np.zeros(len(w.hashes) + 1, np.int64)
            if len(known) and len(h):
                b, k = _bucket_key(h, buckets)
                short = b << KEY | k
                hit = (known[np.minimum(np.searchsorted(known, short), len(known) - 1)] == short) & whole
                around[1 : len(h) + 1] = np.cumsum(hit)
                around[len(h) + 1 :] = around[len(h)]
            hw, wide = w.windows(window)
            at = np.arange(len(hw))
            candidate = wide & (around[np.minimum(at + window - block + 1, len(w.hashes))] > around[at]) if len(hw) else np.zeros(0, bool)
            owner = np.repeat(np.arange(len(raw)), w.counts)
            marked = np.bincount(owner[: len(hw)][candidate], minlength=len(raw)) > 0
            for k, (x, d) in enumerate(zip(raw, ids)):
                if marked[k] and d is not None:
                    out.append((1, batch, d, None, None, None, text[k].as_py(), None, None))
                else:
                    kept = _kept(x, None)
                    out.append((0, batch, d, int(w.counts[k]), 0, hashlib.sha256(kept).hexdigest(), kept.decode() if texts else None, None, None))
            own = np.array([d if d is not None else 0 for d in ids], np.int64)[owner[: len(hw)][candidate]]
            ok = np.array([d is not None for d in ids], bool)[owner[: len(hw)][candidate]]
            found.append((hw[candidate][ok], own[ok]))
        h, d = (np.concatenate(x) for x in zip(*found))
        if len(h):
            order = np.lexsort((d, h))
            h, d = h[order], d[order]
            new = np.append(True, h[1:] != h[:-1])
            h, d = h[new], d[new]
            for b, (hh, dd) in _by_bucket((h >> np.uint64(40)) % np.uint64(buckets), h, d):
                out.append((2, batch, None, None, None, None, None, b, hh.astype("<u8").tobytes() + dd.astype("<i8").tobytes()))
        return pa.Table.from_batches([_rows(_NAMES, _TYPES, out)])

    return run


def _halves(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    half = len(packed) // 2
    return np.frombuffer(packed[:half], "<u8"), np.frombuffer(packed[half:], "<i8")


def _earliest(table: pa.Table) -> pa.Table:
    parts = [_halves(x) for x in table.column("packed").to_pylist()]
    sender = np.repeat(np.arange(len(parts)), [len(p[0]) for p in parts])
    h, d = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(h, kind="stable")
    h, d, sender = h[order], d[order], sender[order]
    first = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
    least = np.repeat(np.minimum.reduceat(d, first), np.diff(np.append(first, len(h))))
    tell = least < d
    batches = table.column("batch").to_pylist()
    rows = [(batches[s], hh.astype("<u8").tobytes() + dd.astype("<i8").tobytes()) for s, (hh, dd) in _by_bucket(sender[tell], h[tell], least[tell])]
    return pa.Table.from_batches([_rows(["batch", "packed"], [pa.int64(), pa.binary()], rows)])


def _cut(window: int, texts: bool):
    def run(docs: pa.Table, told: pa.Table) -> pa.Table:
        names, types = ["doc_id", "n_words", "n_removed", "kept_sha256", "kept"], [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
        out, pieces = [], []
        if not docs.num_rows:
            return pa.Table.from_batches([_rows(names, types, [])])
        for rb in _pieces(docs):
            raw = common.utf8(rb)
            w = Words(raw)
            h, whole = w.windows(window)
            owner = np.repeat(np.arange(len(raw)), w.counts)[: len(h)]
            pieces.append((raw, w, h, whole, owner, np.array(rb.column("doc_id").to_pylist(), np.int64)))
        # The least doc_id of each window: of the batch's own documents and as told by the others.
        known = [_halves(x) for x in told.column("packed").to_pylist()]
        hs = np.concatenate([p[2][p[3]] for p in pieces] + [k[0] for k in known])
        ds = np.concatenate([p[5][p[4]][p[3]] for p in pieces] + [k[1] for k in known])
        order = np.argsort(hs, kind="stable")
        hs, ds = hs[order], ds[order]
        first = np.flatnonzero(np.append(True, hs[1:] != hs[:-1])) if len(hs) else np.zeros(0, np.int64)
        keys, least = (hs[first], np.minimum.reduceat(ds, first)) if len(hs) else (hs, ds)
        for raw, w, h, whole, owner, ids in pieces:
            gone = np.zeros(len(w.hashes) + 1, np.int64)
            if len(h) and len(keys):
                at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
                later = np.flatnonzero(whole & (keys[at] == h) & (least[at] < ids[owner]))
                np.add.at(gone, later, 1)
                np.add.at(gone, later + window, -1)
            gone = np.cumsum(gone)[:-1] > 0
            for k, x in enumerate(raw):
                g = gone[w.first[k] : w.first[k + 1]]
                kept = _kept(x, g)
                out.append((int(ids[k]), len(g), int(g.sum()), hashlib.sha256(kept).hexdigest(), kept.decode() if texts else None))
        return pa.Table.from_batches([_rows(names, types, out)])

    return run


def remove_repeats(df: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", texts: bool = False) -> DataFrame:
    """Per row: doc_id, n_words, n_removed, kept_sha256 (of the kept words joined by one blank); with texts also kept, those words."""
    block = window // 2
    docs = located(df).select("batch", F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # About six bytes of text make a word, a word makes a window, and a window five bytes.
    size = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    buckets = max(LEAST_BUCKETS, size * 5 // 6 // BUCKET_BYTES)
    hits = common.stage_table(_probe(docs, block, buckets).groupBy("bucket").applyInArrow(_hits, "batch long, bucket long, packed binary"), "hits")
    extended = common.stage_table(docs.groupBy("batch").cogroup(hits.groupBy("batch")).applyInArrow(_extend(block, window, buckets, texts), _DONE), "extended", by="kind")
    told = extended.where("kind = 2").select("bucket", "batch", "packed").groupBy("bucket").applyInArrow(_earliest, "batch long, packed binary")
    cut = extended.where("kind = 1").select("batch", "doc_id", "text").groupBy("batch").cogroup(told.groupBy("batch")).applyInArrow(_cut(window, texts), "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string")
    columns = ["doc_id", "n_words", "n_removed", "kept_sha256", *(["kept"] if texts else [])]
    return extended.where("kind = 0").withColumnRenamed("text", "kept").select(*columns).unionByName(cut.select(*columns))


def op3_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(common.documents(spark, sf_dir))
