"""Token ids in a binary file format: frequency-ranked ids, byte-aligned, with separate control bytes.

Ids are renumbered by falling corpus frequency, so that the commonest 256 take one byte. Four values share a control
byte that holds each one's length less one in two bits; a block keeps its control bytes apart from its data bytes, and
decoding is a numpy table lookup: control byte -> four lengths, running sum -> offsets, gather. The file is Parquet
with a row for each block (so any store that Spark writes will do): ``start`` (ids of all documents before the block),
``doc_ids``, ``n_tokens`` (by document), ``control`` and ``data``; blocks are in ascending doc_id order, then text for
equal ids, null ids first. The rank table is a file of its own beside it.

Null and empty texts hold the end id alone.
"""

from __future__ import annotations

import gc
import json
import uuid
import zlib
from array import array
from collections.abc import Iterator
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

#: Ids of a block, about; a longer document is a block of its own.
BLOCK_IDS = 1 << 16

#: Bytes of text that one range partition is given.
PART_BYTES = 24 << 20

#: Lengths of four values by control byte.
LENGTHS = np.array([[1 + (c >> 2 * k & 3) for k in range(4)] for c in range(256)], np.int64)


def pack(values: np.ndarray) -> tuple[bytes, bytes]:
    """(control, data) of unsigned 32-bit values."""
    v = np.asarray(values, np.uint32)
    size = 1 + (v > 0xFF).astype(np.uint8) + (v > 0xFFFF) + (v > 0xFFFFFF)
    codes = np.zeros(-(-len(v) // 4) * 4, np.uint8)
    codes[: len(v)] = size - 1
    quad = codes.reshape(-1, 4)
    control = quad[:, 0] | quad[:, 1] << 2 | quad[:, 2] << 4 | quad[:, 3] << 6
    raw = v.astype("<u4").view(np.uint8).reshape(-1, 4)
    return control.astype(np.uint8).tobytes(), raw[np.arange(4) < size[:, None]].tobytes()


def unpack(control: bytes, data: bytes, n: int) -> np.ndarray:
    sizes = LENGTHS[np.frombuffer(control, np.uint8)].ravel()[:n]
    ends = np.cumsum(sizes)
    d = np.concatenate([np.frombuffer(data, np.uint8), np.zeros(3, np.uint8)]).astype(np.uint32)
    at = ends - sizes
    out = d[at]
    for k in (1, 2, 3):
        if (more := sizes > k).any():
            out[more] |= d[at[more] + k] << np.uint32(8 * k)
    return out


_MARKS = b"!\"#$%&'()*+,-./:;=?@[\\]^_`{}~"

_tokenizers: dict = {}


class WordEncoder:
    """The library's ids, memoised by white-space delimited word: this tokenizer's normaliser and pre-tokenizer never reach across white space, so a text's ids are its words' ids in turn."""

    def __init__(self, spec: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(spec)
        self.plain = Tokenizer.from_str(json.dumps(json.loads(spec) | {"normalizer": None, "added_tokens": []}))
        self.known: dict[bytes, bytes] = {b"": b""}
        self.older: dict[bytes, bytes] = {}
        self.marks: dict[bytes, bytes] = {}
        self.most = 500_000
        model = json.loads(spec)["model"]
        self.specials = [t["content"].lower().encode() for t in json.loads(spec).get("added_tokens", [])]
        self.ends = np.zeros(max(model["vocab"].values()) + 1, bool)
        self.ends[[i for t, i in model["vocab"].items() if t.endswith(model["end_of_word_suffix"])]] = True

    @staticmethod
    def separable(spec: str) -> bool:
        s = json.loads(spec)
        pre = [x.get("pattern", {}).get("Regex", "") for x in (s.get("pre_tokenizer") or {}).get("pretokenizers", []) if x["type"] == "Split" and x.get("behavior") == "Removed" and x.get("invert")]
        norms = {x["type"] for x in (s.get("normalizer") or {}).get("normalizers", [])}
        return bool(pre) and bool(s["model"].get("end_of_word_suffix")) and all(r"[\p{L}]+" in p and " " not in p for p in pre) and {"Lowercase"} <= norms <= {"NFC", "Replace", "Lowercase"} and not any(t.get("lstrip") or t.get("rstrip") for t in s.get("added_tokens", []))

    @staticmethod
    def _cut(word: bytes) -> tuple[bytes, bytes]:
        """A Latin word and its closing ASCII marks are encoded apart; they are pieces of their own for the pre-tokenizer, and words recur with many marks. The word in lower case, as the normaliser has it; Latin letters stand in NFC."""
        core = word.rstrip(_MARKS)
        if core.isalpha():
            return core.lower(), word[len(core) :]
        text = core.decode().lower()
        return (text.encode(), word[len(core) :]) if text.isalpha() and max(text) <= "\u024f" else (b"", word)

    def _learn(self, words: set[bytes]) -> None:
        """Encode what is new: letters many to a call, each word ending in a token that ends words."""
        known, older, marks = self.known, self.older, self.marks
        again = {w: older[w] for w in words if w in older}
        known.update(again)
        words.difference_update(again)
        whole = [w for w in words if w.isalpha() and w.islower()]
        cut = [(w, *self._cut(w)) for w in words.difference(whole)]
        cores = {a for _, a, _ in cut}.difference(known)  # a core is a word too, with the same ids
        known.update({a: older[a] for a in cores if a in older})
        letters = list(cores.union(whole).difference(known))
        for at in range(0, len(letters), 64 * 64):
            groups = [letters[k : k + 64] for k in range(at, min(len(letters), at + 64 * 64), 64)]
            for some, e in zip(groups, self.plain.encode_batch_fast([b" ".join(g).decode() for g in groups], add_special_tokens=False)):
                raw = array("I", e.ids).tobytes()
                stops = (4 * np.flatnonzero(self.ends[np.frombuffer(raw, "<u4")]) + 4).tolist()
                if len(stops) != len(some):
                    raise ValueError("a word is not one piece")
                known.update(zip(some, [raw[a:b] for a, b in zip([0, *stops], stops)]))
        rest = list({b for *_, b in cut}.difference(marks))
        for w, e in zip(rest, self.tokenizer.encode_batch_fast([w.decode() for w in rest], add_special_tokens=False)):
            marks[w] = array("I", e.ids).tobytes()
        known.update([(w, known[a] + marks[b]) for w, a, b in cut])

    def _lower(self, text: bytes) -> bytes:
        """ASCII letters in lower case, so that words are known by one form; not where an added token or a combining mark (which may join one case of a letter only) could come to mean something else."""
        low = text.lower()
        return text if b"\xcc" in low or b"\xcd" in low or any(s in low for s in self.specials) else low

    def encode(self, texts: list[bytes]) -> list[bytes]:
        if len(self.known) > self.most:
            self.known, self.older = {b"": b""}, self.known
        if len(self.marks) > self.most // 4:
            self.marks.clear()
        split = [self._lower(t).split() for t in texts]
        words, known = list(chain.from_iterable(split)), self.known
        # One look-up for each word; those not known yet are filled in when they have been learnt.
        ids = list(map(known.get, words))
        missing = [k for k, x in enumerate(ids) if x is None]
        self._learn({words[k] for k in missing})
        for k in missing:
            ids[k] = known[words[k]]
        ends = list(accumulate(map(len, split)))
        return [b"".join(ids[a:b]) for a, b in zip([0, *ends], ends)]


class PlainEncoder:
    def __init__(self, spec: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(spec)

    def encode(self, texts: list[bytes]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast([t.decode() for t in texts], add_special_tokens=False)]


def _encoder(shipped):
    import os

    spec = shipped.value
    if (key := hash(spec)) not in _tokenizers:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _tokenizers.clear()
        _tokenizers[key] = (WordEncoder if WordEncoder.separable(spec) else PlainEncoder)(spec)
    return _tokenizers[key]


def encode_ordered(df: DataFrame, spec: str, end_id: int, id_col: str, text_col: str, parts: int) -> DataFrame:
    """(part, before, doc_id, n, ids, id, count): documents range-partitioned and sorted by doc_id; ids as 16- or 32-bit integers with the end id; before: ids of the part's earlier documents.

    Rows without ids are a task's counts: a row for each id it has seen at most.
    """
    shipped = df.sparkSession.sparkContext.broadcast(spec)

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end, done, total = _encoder(shipped), np.array([end_id], "<u4").tobytes(), 0, np.zeros(0, np.int64)
        for batch in common.slices(batches, "text", 1 << 20):
            ids = [np.frombuffer(x + end, "<u4") for x in encoder.encode(common.utf8(batch))]
            n = np.array([len(x) for x in ids], np.int64)
            before = done + np.cumsum(n) - n
            done += int(n.sum())
            c = np.bincount(np.concatenate(ids), minlength=len(total))
            c[: len(total)] += total
            total = c
            packed = [x.astype("<u2").tobytes() if x.max() < 65536 else b"\x00" + x.tobytes() for x in ids]
            none = pa.nulls(len(n), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("part"), pa.array(before), batch.column("doc_id"), pa.array(n), pa.array(packed, pa.binary()), none, none], names)
        at = np.flatnonzero(total)
        none = pa.nulls(len(at), pa.int64())
        yield pa.RecordBatch.from_arrays([none.cast(pa.int32()), none, none, none, pa.nulls(len(at), pa.binary()), pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # There are no cycles to find in words and ids, and looking for them in long lists takes a tenth of the time.
        gc.disable()
        try:
            yield from encoded(batches)
        finally:
            gc.enable()

    names = ["part", "before", "doc_id", "n", "ids", "id", "count"]
    rows = common.text_rows(df, id_col, text_col).repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "text")
    return rows.withColumn("part", F.spark_partition_id()).mapInArrow(run, "part int, before long, doc_id long, n long, ids binary, id long, count long")


def raw_ids(x: bytes, n: int) -> np.ndarray:
    return np.frombuffer(x, "<u2").astype("<u4") if len(x) == 2 * n else np.frombuffer(x[1:], "<u4")


def write_token_file(df: DataFrame, path: str, spec: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write blocks to ``path``/blocks and the rank table to ``path``/ranks."""
    spark = df.sparkSession
    # How many ranges: from the size of the text, so that a task's share stays the same at any input.
    size = df.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    staged = common.stage_table(encode_ordered(df, spec, end_id, id_col, text_col, max(1, -(-size // PART_BYTES))), "ids")
    # The vocabulary bounds both: as many ranks as ids; and a sum for each range partition.
    counted = staged.where("id is not null").groupBy("id").agg(F.sum("count").alias("n"))
    order = [r.id for r in counted.orderBy(F.desc("n"), "id").collect()]
    encoded = staged.where("ids is not null").select("part", "before", "doc_id", "n", "ids")
    ranks = np.zeros(max(order, default=0) + 1, np.uint32)
    ranks[order] = np.arange(len(order), dtype=np.uint32)
    spark.createDataFrame([(i, t) for i, t in enumerate(order)], "rank int, id int").coalesce(1).write.parquet(f"{path}/ranks")
    sums = dict(encoded.groupBy("part").agg(F.sum("n")).collect())
    base, at = {}, 0
    for part in sorted(sums):
        base[part], at = at, at + sums[part]
    shipped = spark.sparkContext.broadcast((ranks, base))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks, base = shipped.value
        held: list[tuple] = []

        def block():
            part, before = held[0][:2]
            ids = np.concatenate([raw_ids(x, n) for *_, n, x in held])
            row = ([base[part] + before], [[r[2] for r in held]], [[r[3] for r in held]], *([x] for x in pack(ranks[ids])))
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, (pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary(), pa.binary()))], ["start", "doc_ids", "n_tokens", "control", "data"])

        count = 0
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("part", "before", "doc_id", "n", "ids"))):
                # Rows come in order within a piece of a file; a block ends where the next piece begins.
                if held and (count + row[3] > BLOCK_IDS or held[-1][0] != row[0] or held[-1][1] + held[-1][3] != row[1]):
                    yield block()
                    count = 0
                held.append(row)
                count += row[3]
        if held:
            yield block()

    encoded.mapInArrow(run, "start long, doc_ids array<long>, n_tokens array<int>, control binary, data binary").write.option("compression", "none").parquet(f"{path}/blocks")


def read_token_file(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) from the files."""
    order = [r.id for r in spark.read.parquet(f"{path}/ranks").orderBy("rank").collect()]
    shipped = spark.sparkContext.broadcast(np.array(order, "<u4"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = shipped.value
        for batch in batches:
            for start, docs, sizes, control, data in zip(*(c.to_pylist() for c in batch.columns)):
                ends = np.cumsum(sizes)
                ids = ids_of[unpack(control, data, int(ends[-1]))]
                starts = ends - sizes
                crc = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(starts.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(starts + start, pa.int64()), pa.array(sizes, pa.int64()), pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    blocks = spark.read.schema("start long, doc_ids array<long>, n_tokens array<int>, control binary, data binary").parquet(f"{path}/blocks")
    return blocks.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op1_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as P

    with open(P.path("word_bpe_49k.json"), encoding="utf-8") as f:
        spec = f.read()
    path = f"{common.shared_dir(spark)}/fw-tokens-{uuid.uuid4().hex}"
    write_token_file(common.documents(spark, sf_dir), path, spec, 1)
    return read_token_file(spark, path)
