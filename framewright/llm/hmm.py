"""A hidden Markov language model.

Training documents are those whose crc32(doc_id as text) modulo FOLDS is not HELD_OUT. Tokens are words in lower case
(A-Z) and one end for each text.

1. Every token is counted over all training documents: a batch of documents sends each of its words once, packed by
   bucket of the word's hash; the bucket adds up and answers each batch. What is gathered grows with the corpus.
2. The VOCABULARY commonest words are the model's symbols, with the end and CLASSES classes of the remaining words (by their last
   letters). Within a class a word has probability (c + 1) / (N_class + V_class + 1), and all unknown words share the 1.
3. Baum-Welch: each round, every partition runs the scaled forward and backward recursions over its training texts, in
   segments of SEGMENT tokens, and adds up expected starts, transitions and emissions; the sums over partitions (in
   whole 2^-20ths, so that their order doesn't matter) give the next round's parameters.
4. The scaled forward recursion over each whole text gives its exact likelihood under the model.

The model is STATES x (VOCABULARY + CLASSES + 1) numbers, whatever the corpus; only that is ever on the driver.

Null and empty texts are the end alone. A null doc_id counts as the text '' for its fold, hence as training. Repeated
rows each count and each give a row. Without training tokens the base is 1 / (V + 1) with V = 0 and the model uniform.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from .hashing import Words, mix64
from .substrings import _by_bucket, _rows, located

FOLDS, HELD_OUT = 7, 2
STATES, VOCABULARY, CLASSES, SEGMENT, ROUNDS, LEAST_COUNT = 8, 1 << 15, 256, 64, 5, 3
#: Part of the emissions that is the corpus' own distribution of symbols, so that no state excludes one.
SHARED = 0.02
BUCKET_BYTES, LEAST_BUCKETS = 4 << 20, 256
UNIT = 1 << 20
U = np.uint64


def in_training(ids: list) -> np.ndarray:
    return np.array([zlib.crc32(b"" if d is None else str(d).encode()) % FOLDS != HELD_OUT for d in ids], bool)


def word_classes(w: Words) -> np.ndarray:
    """Class of each word: its last two bytes and whether it has any beyond ASCII."""
    raw = np.frombuffer(w.buffer, np.uint8)
    if not len(w.starts):
        return np.zeros(0, np.int64)
    high = np.append(0, np.cumsum(raw > 127))
    last, before = raw[w.ends - 1].astype(np.uint64) | U(32), raw[np.maximum(w.ends - 2, w.starts)].astype(np.uint64) | U(32)
    return (mix64((last * U(257) + before) * U(2) + (high[w.ends] > high[w.starts])) % U(CLASSES)).astype(np.int64)


_COUNT_COLUMNS = "batch long, bucket long, packed binary, hash long, c long, class int, distinct long"
_NAMES = [x.split()[0] for x in _COUNT_COLUMNS.split(", ")]
_TYPES = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]


def _send(docs: DataFrame, buckets: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in common.slices(batches, "text", 8 << 20):
            places, texts, train = np.array(rb.column("batch").to_pylist()), common.utf8(rb), in_training(rb.column("doc_id").to_pylist())
            for batch in dict.fromkeys(places.tolist()):
                here = np.flatnonzero(places == batch)
                w = Words([texts[k] for k in here], lower=True)
                if not len(w.hashes):
                    continue
                counted = np.repeat(train[here], w.counts).astype(np.int64)
                order = np.argsort(w.hashes, kind="stable")
                h, cls = w.hashes[order], word_classes(w)[order]
                start = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
                c = np.add.reduceat(counted[order], start)
                rows = [(b, batch, x.astype("<u8").tobytes() + y.astype("<u4").tobytes() + z.astype(np.uint8).tobytes()) for b, (x, y, z) in _by_bucket((h[start] >> U(40)) % U(buckets), h[start], c, cls[start])]
                yield _rows(["bucket", "batch", "packed"], [pa.int64(), pa.int64(), pa.binary()], rows)

    return docs.select("doc_id", "batch", "text").mapInArrow(run, "bucket long, batch long, packed binary")


def _add_up(table: pa.Table) -> pa.Table:
    """Answers for the batches, totals by class, and words that may be in the vocabulary."""
    bucket, packed = table.column("bucket")[0].as_py(), table.column("packed").to_pylist()
    n = [len(p) // 13 for p in packed]
    h = np.concatenate([np.frombuffer(p[: 8 * k], "<u8") for p, k in zip(packed, n)])
    c = np.concatenate([np.frombuffer(p[8 * k : 12 * k], "<u4") for p, k in zip(packed, n)]).astype(np.int64)
    cls = np.concatenate([np.frombuffer(p[12 * k :], np.uint8) for p, k in zip(packed, n)]).astype(np.int64)
    sender = np.repeat(np.arange(len(n)), n)
    order = np.argsort(h, kind="stable")
    h, c, cls, sender = h[order], c[order], cls[order], sender[order]
    start = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
    total = np.add.reduceat(c, start)
    every = np.repeat(total, np.diff(np.append(start, len(h))))
    batches = table.column("batch").to_pylist()
    out = [(batches[s], bucket, x.astype("<u8").tobytes() + y.astype("<u8").tobytes(), None, None, None, None) for s, (x, y) in _by_bucket(sender[every > 0], h[every > 0], every[every > 0])]
    seen = total > 0
    by_class, distinct = np.bincount(cls[start][seen], total[seen], CLASSES), np.bincount(cls[start][seen], minlength=CLASSES)
    out += [(None, None, None, None, int(by_class[k]), k, int(distinct[k])) for k in np.flatnonzero(distinct).tolist()]
    common_words = total >= LEAST_COUNT
    out += [(None, None, None, x, y, z, None) for x, y, z in zip(h[start][common_words].view(np.int64).tolist(), total[common_words].tolist(), cls[start][common_words].tolist())]
    return pa.Table.from_batches([_rows(_NAMES, _TYPES, out)])


class Model:
    """Symbols: vocabulary words by rising hash, the end, classes."""

    def __init__(self, vocabulary: list[tuple], classes: list[tuple], texts: int, states: int):
        vocabulary = sorted((h % (1 << 64), c, k) for h, c, k in vocabulary)
        self.words = np.array([h for h, _, _ in vocabulary], np.uint64)
        v = len(vocabulary)
        self.end, self.states = v, states
        tokens, distinct = np.zeros(CLASSES, np.int64), np.zeros(CLASSES, np.int64)
        for k, c, d in classes:
            tokens[k] += c
            distinct[k] += d
        self.total, self.distinct = int(tokens.sum()) + texts, int(distinct.sum()) + (texts > 0)
        for _, c, k in vocabulary:
            tokens[k] -= c
            distinct[k] -= 1
        self.class_size = tokens + distinct + 1
        self.texts = texts
        counts = np.concatenate([[c for _, c, _ in vocabulary], [texts], tokens]).astype(np.float64) + 0.5
        self.share = counts / counts.sum()
        # States start apart by a fixed hash, and inclined to stay.
        noise = mix64(np.arange((v + 1 + CLASSES) * states, dtype=np.uint64) + U(12345)).reshape(-1, states) / 2.0**64
        self.set(np.full(states, 1 / states), np.full((states, states), 0.1 / states) + 0.9 * np.eye(states), self.share[:, None] * (0.2 + noise**3 * 4))

    def set(self, start: np.ndarray, move: np.ndarray, emit: np.ndarray) -> None:
        self.start = (start + 1e-3) / (start + 1e-3).sum()
        move = move + 1e-6 * move.sum() + 1e-9
        self.move = move / move.sum(1, keepdims=True)
        total = emit.sum(0)
        self.emit = (1 - SHARED) * emit / np.where(total > 0, total, 1) + np.where(total > 0, SHARED, 1) * self.share[:, None]

    def symbols(self, w: Words) -> tuple[np.ndarray, np.ndarray]:
        """(symbol of each word, number of its class where it is outside the vocabulary, else -1)."""
        cls = word_classes(w)
        if not len(self.words):
            return self.end + 1 + cls, cls
        at = np.minimum(np.searchsorted(self.words, w.hashes), len(self.words) - 1)
        inside = self.words[at] == w.hashes
        return np.where(inside, at, self.end + 1 + cls), np.where(inside, -1, cls)


def _with_ends(symbols: np.ndarray, w: Words, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of all texts, each with its end, and where each text begins (and all end)."""
    first = w.first + np.arange(len(w.first))
    out = np.full(first[-1], end, np.int64)
    out[np.arange(len(symbols)) + np.repeat(np.arange(len(w.counts)), w.counts)] = symbols
    return out, first


def expect(model: Model, symbols: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Expected starts, transitions and emissions over segments of the texts (Baum-Welch's first step)."""
    size = np.diff(first)
    per = -(-size // SEGMENT)
    text = np.repeat(np.arange(len(size)), per)
    begin = first[:-1][text] + SEGMENT * (np.arange(per.sum()) - np.repeat(np.cumsum(per) - per, per))
    length = np.minimum(SEGMENT, first[1:][text] - begin)
    s = model.states
    starts, moves, emits, ones = np.zeros(s), np.zeros((s, s)), np.zeros_like(model.emit), np.ones(s)
    for a in range(0, len(begin), 8192):
        order = np.argsort(-length[a : a + 8192], kind="stable") + a
        b, n = begin[order], length[order]
        steps = int(n[0])
        alive = np.searchsorted(-n, -np.arange(steps), "left")  # texts longer than t
        # All symbols of the chunk step after step, and what each step has of them: rows at[t]:at[t + 1].
        at = np.append(0, np.cumsum(alive))
        flat = np.concatenate([symbols[b[:k] + t] for t, k in enumerate(alive)])
        seen = model.emit[flat]
        alpha, scale = np.empty_like(seen), np.empty(len(flat))
        for t in range(steps):
            k, here = alive[t], slice(at[t], at[t + 1])
            x = (alpha[at[t - 1] : at[t - 1] + k] @ model.move if t else model.start) * seen[here]
            scale[here] = x @ ones
            np.divide(x, scale[here, None], out=alpha[here])
        beta = np.ones((len(b), s))
        for t in range(steps - 1, -1, -1):
            k, here = alive[t], slice(at[t], at[t + 1])
            if t:
                before = alpha[at[t - 1] : at[t - 1] + k]
                y = seen[here] * beta[:k] / scale[here, None]
                moves += model.move * (before.T @ y)
            gamma = alpha[here]
            gamma *= beta[:k]
            gamma /= (gamma @ ones)[:, None]
            if t:
                beta[:k] = y @ model.move.T
        starts += alpha[: at[1]].sum(0)
        for j in range(s):
            emits[:, j] += np.bincount(flat, alpha[:, j], len(emits))
    return starts, moves, emits


def log10_likelihood(model: Model, symbols: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Exact log10 probability of each text's symbols: the scaled forward recursion, all texts a step at a time."""
    size = np.diff(first)
    order = np.argsort(-size, kind="stable")
    b, n = first[:-1][order], size[order]
    out = np.zeros(len(size))
    if not len(size):
        return out
    steps = int(n[0])
    alive = np.searchsorted(-n, -np.arange(steps), "left")
    x, total, product, ones = None, np.zeros(len(b)), np.ones(len(b)), np.ones(model.states)
    for t in range(steps):
        k = alive[t]
        x = (x[:k] @ model.move if t else model.start) * model.emit[symbols[b[:k] + t]]
        norm = x @ ones
        x /= norm[:, None]
        product[:k] *= norm
        if t & 15 == 15:
            total += np.log10(product)
            product[:] = 1
    out[order] = total + np.log10(product)
    return out


def _train_round(docs: DataFrame, model: Model) -> Model:
    shipped = docs.sparkSession.sparkContext.broadcast(model)
    s = model.states

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, sums = shipped.value, None
        for rb in common.slices(batches, "text", 4 << 20):
            texts = [x for x, t in zip(common.utf8(rb), in_training(rb.column("doc_id").to_pylist())) if t]
            if texts:
                w = Words(texts, lower=True)
                found = expect(m, *_with_ends(m.symbols(w)[0], w, m.end))
                sums = found if sums is None else [a + b for a, b in zip(sums, found)]
        if sums is not None:
            flat = np.rint(np.concatenate([sums[0][None], sums[1], sums[2]]) * UNIT).astype(np.int64)
            at = np.flatnonzero(flat.any(1))
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), *(pa.array(flat[at, j]) for j in range(s))], ["row", *(f"s{j}" for j in range(s))])

    names = [f"s{j}" for j in range(s)]
    rows = docs.select("doc_id", "text").mapInArrow(run, "row long, " + ", ".join(f"{n} long" for n in names)).groupBy("row").agg(*(F.sum(n).alias(n) for n in names)).toPandas()
    flat = np.zeros((1 + s + len(model.emit), s))
    flat[rows["row"].to_numpy(np.int64)] = rows[names].to_numpy(np.float64) / UNIT
    model.set(flat[0], flat[1 : 1 + s], flat[1 + s :])
    common.release(docs.sparkSession)
    return model


def _score(model_of):
    def run(docs: pa.Table, told: pa.Table) -> pa.Table:
        names, types = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"], [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
        m = model_of.value
        out = []
        known = [(np.frombuffer(p[: len(p) // 2], "<u8"), np.frombuffer(p[len(p) // 2 :], "<u8")) for p in told.column("packed").to_pylist()]
        h, c = (np.concatenate(x) for x in zip(*known)) if known else (np.zeros(0, np.uint64), np.zeros(0, np.uint32))
        order = np.argsort(h, kind="stable")
        h, c = h[order], c[order].astype(np.int64)
        base = np.log10(m.total + m.distinct + 1)
        for rb in common.slices(iter(docs.to_batches()), "text", 8 << 20):
            w, ids = Words(common.utf8(rb), lower=True), rb.column("doc_id").to_pylist()
            count = np.zeros(len(w.hashes), np.int64)
            if len(h):
                at = np.minimum(np.searchsorted(h, w.hashes), len(h) - 1)
                count = np.where(h[at] == w.hashes, c[at], 0)
            owner = np.repeat(np.arange(len(ids)), w.counts)
            n = w.counts + 1
            base_score = np.bincount(owner, np.log10(count + 1), len(ids)) + np.log10(m.texts + 1) - n * base
            symbols, cls = m.symbols(w)
            outside = cls >= 0
            within = np.bincount(owner[outside], np.log10((count[outside] + 1) / m.class_size[cls[outside]]), len(ids))
            score = log10_likelihood(m, *_with_ends(symbols, w, m.end)) + within
            n_known = np.bincount(owner, count > 0, len(ids)).astype(np.int64) + (m.texts > 0)
            out.append(pa.table([pa.array(ids, pa.int64()), pa.array(~in_training(ids)), pa.array(n, pa.int64()), pa.array(n_known, pa.int64()), pa.array([m.total] * len(ids), pa.int64()), pa.array(base_score), pa.array(score)], names))
        return pa.concat_tables(out) if out else pa.Table.from_batches([_rows(names, types, [])])

    return run


def hmm_scores(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", states: int = STATES, vocabulary: int = VOCABULARY, rounds: int = ROUNDS) -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    docs = located(df).select("batch", F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    size, = docs.agg(F.sum(F.length("text"))).first()
    buckets = max(LEAST_BUCKETS, (size or 0) * 3 // 6 // BUCKET_BYTES)
    added = common.stage_table(_send(docs, buckets).groupBy("bucket").applyInArrow(_add_up, _COUNT_COLUMNS), "counts")
    # The model's size is fixed: so many words at most, and a row for each class.
    words = added.where("hash is not null").select("hash", "c", "class").orderBy(F.desc("c"), "hash").limit(vocabulary).collect()
    classes = added.where("distinct is not null").groupBy("class").agg(F.sum("c"), F.sum("distinct")).collect()
    texts = docs.where(F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(FOLDS)) != HELD_OUT).count()
    model = Model([tuple(r) for r in words], [tuple(r) for r in classes], texts, states)
    for _ in range(rounds):
        model = _train_round(docs, model)
    told = added.where("packed is not null").select("batch", "packed")
    shipped = df.sparkSession.sparkContext.broadcast(model)
    return docs.groupBy("batch").cogroup(told.groupBy("batch")).applyInArrow(_score(shipped), "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def op7_hmm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm_scores(common.documents(spark, sf_dir))
