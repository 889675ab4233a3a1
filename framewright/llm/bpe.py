"""Byte-level BPE encoding and decoding as a tree reduction.

Every match of the split pattern is a piece of its own. A piece is encoded as a reduction over a balanced tree: halves
are encoded on their own and neighbours are joined. A join re-encodes a window of tokens around the boundary and
doubles it until the window's first and last tokens are those that stood there before (or the window has reached the
end). That is enough: a token sequence is the BPE encoding of its bytes exactly if every adjacent pair is what its own
bytes encode to, the pairs outside the window have not changed, those inside come from an encoding, and the two at the
rims are old pairs because the rim tokens are. Decoding concatenates up the same kind of tree.

Null text: encoded as the empty text, no tokens. Any Unicode text is legal; very long pieces cost n log n per level.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
from array import array
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from . import common

#: Rust's and Unicode's White_Space; regex's own \s may differ at the control characters.
SPACE = r"[\t-\r\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"

#: Bytes up to which a node is encoded directly.
LEAF = 6

MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"

#: Bytes up to which the encodings of leaves and windows are memoised; they recur in most words.
SHORT = 48

#: Single blanks between two characters that aren't white space: no match of the pattern reaches across their left side.
_CUT = re.compile(r"(?<=\S) (?=\S)")
_DOUBLE = re.compile(r"\s\s")


def read_ranks(data: bytes) -> dict[bytes, int]:
    """Ranks of a .tiktoken file: base64 bytes, blank, rank on each line."""
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in data.splitlines() if line.strip())}


class TreeBpe:
    def __init__(self, ranks: dict[bytes, int], pattern: str, leaf: int = LEAF):
        import regex

        self.ranks, self.leaf = ranks, leaf
        self.vocab = {v: k for k, v in ranks.items()}
        pattern = pattern.replace(r"[^\s", "[^" + SPACE[1:-1]).replace(r"\S", "[^" + SPACE[1:]).replace(r"\s", SPACE)
        self.find = regex.compile(pattern).findall
        self.short = common.Bounded(self._merge)
        self.pieces = common.Bounded(lambda x: array("I", self.encode_piece(x.encode())).tobytes())
        self.chunks = common.Bounded(self._chunk)

    def forget(self) -> None:
        """Empty the memos, which hold some 150 MB after a long task."""
        for memo in (self.short, self.pieces, self.chunks):
            memo.forget()

    def _chunk(self, s: str) -> bytes:
        # A blank, letters and ASCII marks: the marks are a match of their own.
        core = s.rstrip(MARKS)
        if core[:1] == " " and core[1:].isalpha():
            return self.pieces[core] + self.pieces[s[len(core) :]] if len(core) < len(s) else self.pieces[s]
        return b"".join([self.pieces[x] for x in self.find(s)])

    def direct(self, data: bytes) -> list[int]:
        return self.short[data] if len(data) <= SHORT else self._merge(data)

    def _merge(self, data: bytes) -> list[int]:
        """The merge loop itself: the lowest rank first, of equal ranks the leftmost."""
        ranks = self.ranks
        if (whole := ranks.get(data)) is not None:
            return [whole]
        if len(data) > 128:
            return self._heap(data)
        parts = [data[i : i + 1] for i in range(len(data))]
        pairs = [ranks.get(data[i : i + 2], 1 << 40) for i in range(len(data) - 1)]
        while pairs:
            low = min(pairs)
            if low == 1 << 40:
                break
            i = pairs.index(low)
            parts[i] += parts[i + 1]
            del parts[i + 1], pairs[i]
            if i < len(pairs):
                pairs[i] = ranks.get(parts[i] + parts[i + 1], 1 << 40)
            if i:
                pairs[i - 1] = ranks.get(parts[i - 1] + parts[i], 1 << 40)
        return [ranks[p] for p in parts]

    def _heap(self, data: bytes) -> list[int]:
        ranks, n = self.ranks, len(data)
        end, before = list(range(1, n + 1)), list(range(-1, n - 1))
        alive = [True] * n
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(data[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, stop = heapq.heappop(heap)
            if not alive[i] or end[i] >= n or end[end[i]] != stop:
                continue
            j = end[i]
            alive[j], end[i] = False, stop
            if stop < n:
                before[stop] = i
                if (r := ranks.get(data[i : end[stop]])) is not None:
                    heapq.heappush(heap, (r, i, end[stop]))
            if (p := before[i]) >= 0 and (r := ranks.get(data[p:stop])) is not None:
                heapq.heappush(heap, (r, p, stop))
        out, i = [], 0
        while i < n:
            out.append(ranks[data[i : end[i]]])
            i = end[i]
        return out

    def join(self, left: list[int], right: list[int]) -> list[int]:
        k = 1
        while True:
            a, c = max(0, len(left) - k), min(len(right), k)
            window = self.direct(b"".join([self.vocab[t] for t in left[a:] + right[:c]]))
            if (not a or window[0] == left[a]) and (c == len(right) or window[-1] == right[c - 1]):
                return left[:a] + window + right[c:]
            k *= 2

    def encode_piece(self, data: bytes) -> list[int]:
        if len(data) <= self.leaf:
            return self.direct(data) if data else []
        half = len(data) // 2
        return self.join(self.encode_piece(data[:half]), self.encode_piece(data[half:]))

    def encode(self, text: str) -> bytes:
        """Ids of a text as native 32-bit unsigned integers."""
        if not text:
            return b""
        parts = _CUT.split(text) if _DOUBLE.search(text) else text.split(" ")
        chunks = self.chunks
        head = chunks[parts[0]] if parts[0] else b""
        return head + b"".join([chunks[" " + x] for x in islice(parts, 1, None)])

    def decode(self, ids) -> bytes:
        if len(ids) <= 4096:
            return b"".join(map(self.vocab.__getitem__, ids))
        half = len(ids) // 2
        return self.decode(ids[:half]) + self.decode(ids[half:])


_made: dict = {}


def _bpe(shipped) -> TreeBpe:
    data, pattern = shipped.value
    key = hash((data, pattern))
    if key not in _made:
        _made.clear()
        _made[key] = TreeBpe(read_ranks(data), pattern)
    return _made[key]


def bpe_round_trip(df: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """Per row: doc_id, n_tokens, ids_sha256, decoded_sha256 and, if keep_ids, ids (array<int>).

    The vocabulary (a megabyte, whatever the input) is read on the driver and broadcast. One pass, no shuffle.
    """
    with open(ranks_path, "rb") as f:
        shipped = df.sparkSession.sparkContext.broadcast((f.read(), pattern))
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * keep_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _bpe(shipped)
        for batch in common.slices(batches, "text"):
            n, ids_sha, out_sha, kept = [], [], [], []
            for text in batch.column("text").to_pylist():
                ids = array("I")
                ids.frombytes(raw := bpe.encode(text))
                n.append(len(ids))
                ids_sha.append(hashlib.sha256(raw).hexdigest())
                out_sha.append(hashlib.sha256(bpe.decode(ids)).hexdigest())
                if keep_ids:
                    kept.append(ids.tolist())
            columns = [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids_sha), pa.array(out_sha)]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if keep_ids:
                columns.append(pa.array(kept, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)
        bpe.forget()

    return common.text_rows(df, id_col, text_col).mapInArrow(common.tidy(run), schema)


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as P

    return bpe_round_trip(common.documents(spark, sf_dir), P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
