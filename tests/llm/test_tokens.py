import hashlib
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from framewright.llm import bpe, tokenbin

RANKS = bpe.read_ranks(open(P.path("byte_bpe_50k.tiktoken"), "rb").read())
TREE = bpe.TreeBpe(RANKS, P.PATTERN)
REAL = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=RANKS, special_tokens={})
SPEC = open(P.path("word_bpe_49k.json"), encoding="utf-8").read()
WORDS = Tokenizer.from_file(P.path("word_bpe_49k.json"))


def ids_of(text):
    return np.frombuffer(TREE.encode(text), "<u4").tolist()


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(max_size=200), st.text("ab '\n\tes\x1c\x85.", max_size=120), st.text("aé ß1-", min_size=100, max_size=400)))
def test_tree_is_the_library(text):
    assert ids_of(text) == REAL.encode_ordinary(text)
    assert TREE.decode(ids_of(text)) == text.encode()


@pytest.mark.parametrize("text", ["a" * 3001, "ab" * 999, " " * 700, "\n" * 301 + "x", "thethe" * 500, "".join(random.Random(1).choice("abcde") for _ in range(4000)), "é" * 777, "1234567890" * 90])
def test_long_pieces(text):
    assert ids_of(text) == REAL.encode_ordinary(text)
    assert TREE._heap(text.encode()) == TREE._merge(text.encode())


def test_round_trip_query(docs_of, odd_rows):
    got = {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.bpe_round_trip(docs_of(odd_rows), P.path("byte_bpe_50k.tiktoken"), P.PATTERN).collect()}
    want = set()
    for d, t, _ in odd_rows:
        ids = REAL.encode_ordinary(t or "")
        want.add((d, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert got == want


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1), max_size=70))
def test_pack(values):
    v = np.array(values, np.uint32)
    assert tokenbin.unpack(*tokenbin.pack(v), len(v)).tolist() == values


def test_control_bytes_are_apart():
    control, data = tokenbin.pack(np.array([1, 256, 65536, 1 << 24, 5], np.uint32))
    assert control == bytes([0b11100100, 0]) and len(data) == 1 + 2 + 3 + 4 + 1


@settings(max_examples=150, deadline=None)
@given(st.text(st.one_of(st.characters(codec="utf-8", exclude_characters="<"), st.sampled_from("abc 's.,!ÉİΣσ́\x85")), max_size=120))
def test_words_are_the_library(text):
    encoder = tokenbin.WordEncoder(SPEC)
    assert np.frombuffer(encoder.encode([text.encode()])[0], "<u4").tolist() == WORDS.encode(text, add_special_tokens=False).ids


def test_special_strings_as_the_library_has_them():
    text = "a <|endoftext|> b<|startoftext|>c Don't WE'LL x'S"
    assert np.frombuffer(tokenbin.WordEncoder(SPEC).encode([text.encode()])[0], "<u4").tolist() == WORDS.encode(text, add_special_tokens=False).ids


def test_file(spark, docs_of, odd_rows, tmp_path):
    rows = odd_rows + [(1000 - i, f"text number {i} " * (i % 50)) for i in range(300)]
    tokenbin.write_token_file(docs_of(rows), f"file://{tmp_path}/f", SPEC, 1)
    got = sorted((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in tokenbin.read_token_file(spark, f"file://{tmp_path}/f").collect())
    at, want = 0, []
    for d, t, *_ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = [*WORDS.encode(t or "", add_special_tokens=False).ids, 1]
        want.append((at, d, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert got == want


def test_empty_file(spark, docs_of, tmp_path):
    tokenbin.write_token_file(docs_of([(1, "x")]).where("false"), f"file://{tmp_path}/e", SPEC, 1)
    assert tokenbin.read_token_file(spark, f"file://{tmp_path}/e").collect() == []


@pytest.mark.parametrize("text", ["W̊ ẘ W̱̊ H̱ J̌ İ i̇", "<|ENDOFTEXT|> <|endoftext|>", "The the THE, the. É é"])
def test_case_is_folded_as_the_library_folds_it(text):
    assert np.frombuffer(tokenbin.WordEncoder(SPEC).encode([text.encode()])[0], "<u4").tolist() == WORDS.encode(text, add_special_tokens=False).ids


def test_forgotten_words_are_the_same():
    encoder = tokenbin.WordEncoder(SPEC)
    encoder.most = 5
    for k in range(30):
        text = " ".join(f"the word{'abcdefg'[i % 7]}, {i % 3 * k}" for i in range(k % 9))
        assert np.frombuffer(encoder.encode([text.encode()])[0], "<u4").tolist() == WORDS.encode(text, add_special_tokens=False).ids


def test_workers_keep_no_memos(docs_of, spark):
    """What encoding has learnt doesn't stay in a worker, where the pipeline's next steps would add to it."""
    import pyarrow as pa

    letters = np.random.default_rng(3).integers(97, 123, (4, 10_000, 9), np.uint8)
    rows = [(i, " ".join(w.tobytes().decode() for w in x)) for i, x in enumerate(letters)]
    assert bpe.bpe_round_trip(docs_of(rows).coalesce(1), P.path("byte_bpe_50k.tiktoken"), P.PATTERN).count() == 4

    def held(batches):
        list(batches)
        sizes = [len(m) + len(m.old) for b in bpe._made.values() for m in (b.short, b.pieces, b.chunks)]
        yield pa.RecordBatch.from_pydict({"memos": pa.array([sum(sizes)], pa.int64())})

    assert [r.memos for r in spark.range(0, 8, 1, 8).mapInArrow(held, "memos long").collect()] == [0] * 8


def test_words_are_looked_up_once():
    class Counted(dict):
        def get(self, *key):
            self.asked = getattr(self, "asked", 0) + 1
            return super().get(*key)

    e = tokenbin.WordEncoder(SPEC)
    e.known = Counted(e.known)
    texts = ["one two, two (three) One", "", "Étude étude. one's two"]
    for _ in range(2):
        assert [np.frombuffer(x, "<u4").tolist() for x in e.encode([t.encode() for t in texts])] == [WORDS.encode(t, add_special_tokens=False).ids for t in texts]
    assert e.known.asked == 2 * sum(len(t.split()) for t in texts)


def test_words_across_generations():
    """Cores and words share a memo; both stay right when it starts anew at any moment."""
    r = random.Random(5)
    e = tokenbin.WordEncoder(SPEC)
    e.most = 6
    some = ["tree", "Tree", "TREE.", "tree,", "(tree", "straße", "Straße!", "ÉTÉ?", "été", "it's", "x1", "...", "<|endoftext|>", "ét", "日本", "İx", "a b", "!"]
    for _ in range(300):
        texts = [" ".join(r.choices(some, k=r.randrange(5))) for _ in range(3)]
        assert [np.frombuffer(x, "<u4").tolist() for x in e.encode([t.encode() for t in texts])] == [WORDS.encode(t, add_special_tokens=False).ids for t in texts]
