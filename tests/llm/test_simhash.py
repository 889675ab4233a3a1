"""SimHash: fingerprints against a plain version, components against all pairs."""

import random

import numpy as np
import pytest
import xxhash

from framewright.llm import simhash

LOWER = bytes(c + 32 if 65 <= c < 91 else c for c in range(256))


def plain_fingerprint(text, n=4):
    words = (text or "").encode().translate(LOWER).split()
    shingles = [b" ".join(words[i : i + n]) for i in range(len(words) - n + 1)] or ([b" ".join(words)] if words else [])
    counts = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s, seed=42)
        for b in range(64):
            counts[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * counts[b] > len(shingles))


def plain_components(fps, budget):
    parent = list(range(len(fps)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(fps):
        for j in range(i):
            if bin(a ^ fps[j]).count("1") <= budget:
                parent[root(i)] = root(j)
    return [root(i) for i in range(len(fps))]


@pytest.mark.parametrize("chunk", [7, 64, 1 << 20])
def test_fingerprint_of_one_text(monkeypatch, chunk):
    monkeypatch.setattr(simhash, "CHUNK", chunk)
    for text in ["", " \n", "one", "A b", "one two three", "one two three four", "The Cat\x0bsat on the MAT and the cat sat on the mat", "ÄÖ \x85 x y z " * 40, "x" * 300 + " y"]:
        assert simhash.simhash(text.encode()) == plain_fingerprint(text)


def ball(rng, n, flips):
    centre = rng.getrandbits(64)
    return [centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, flips))) for _ in range(n)]


@pytest.mark.parametrize("leaf", [16, 1 << 14])
def test_trie_join_finds_all_components(spark, monkeypatch, leaf):
    rng = random.Random(5)
    fps = ball(rng, 60, 3) + ball(rng, 60, 6) + ball(rng, 40, 9) + [rng.getrandbits(64) for _ in range(150)] + [0, 1, (1 << 64) - 1, 1 << 63, 0b11111, 0b111110000]
    fps += [f ^ (1 << 63) ^ (1 << 31) for f in fps[:20]]
    fps = sorted(set(fps))
    monkeypatch.setattr(simhash, "LEAF", leaf)
    monkeypatch.setattr(simhash, "FRONTIER", 50)
    signed = [int(np.uint64(f).astype(np.int64)) for f in fps]
    labels = {r.node: r.label for r in simhash.near_fingerprints(spark.createDataFrame([(s,) for s in signed], "fp long"), 4).collect()}
    plain = plain_components(fps, 4)
    groups = {}
    for s, r in zip(signed, plain):
        groups.setdefault(r, set()).add(s)
    got = {}
    for s in signed:
        got.setdefault(labels.get(s, s), set()).add(s)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, groups.values()))


def test_groups_of_documents(spark, docs_of, odd_rows):
    base = " ".join(f"word{i % 61} and{i % 7}" for i in range(300))
    rows = [*odd_rows, (30, base, "a"), (31, base + " end", "a"), (29, base.upper(), "b"), (32, base.replace("word5 ", "other "), "b")]
    got = simhash.simhash_groups(docs_of(rows), 4, 4).collect()
    assert len(got) == len(rows)
    fps = [plain_fingerprint(t) for _, t, *_ in rows]
    roots = plain_components(fps, 4)
    least = {}
    for (i, *_), r in zip(rows, roots):
        least[r] = min(x for x in (least.get(r), i) if x is not None) if i is not None or r in least else None
    want = sorted(((i if i is not None else -1), int(np.uint64(f).astype(np.int64)), least[r]) for (i, *_), f, r in zip(rows, fps, roots))
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.fp, r.component_id) for r in got) == want
    assert simhash.simhash_groups(docs_of([(1, "x")]).limit(0)).collect() == []


def test_query_over_its_table(spark, sf):
    from framewright.llm.simhash import op13_simhash

    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: r for r in op13_simhash(spark, sf).collect()}
    fps = [plain_fingerprint(r.text) for r in docs]
    least = {}
    roots = plain_components(fps, 4)
    for d, r in zip(docs, roots):
        least[r] = min(least.get(r, d.doc_id), d.doc_id)
    assert len(got) == len(docs)
    for d, f, r in zip(docs, fps, roots):
        assert got[d.doc_id].fingerprint == f"{f:016x}" and got[d.doc_id].component_id == least[r]
