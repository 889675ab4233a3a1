import random

import brute
import pytest

from framewright.llm import substrings


def run(df, window=50):
    return sorted((tuple(r) for r in substrings.remove_repeats(df, window).collect()), key=repr)


@pytest.mark.parametrize("window", [50, 8])
def test_planted_repeats(docs_of, window):
    rng = random.Random(window)
    rows, passages = [], [[f"p{k}_{i}" for i in range(n)] for k, n in enumerate((window - 1, window, window + 1, 3 * window, 2 * window - 1))]
    for d in range(80):
        w = []
        for _ in range(rng.randint(0, 4)):
            w += [f"w{rng.randint(0, 10**6)}" for _ in range(rng.randint(0, 2 * window))]
            if rng.random() < 0.6:
                p = rng.choice(passages)
                cut = rng.randint(0, 3)
                w += p[cut:] if rng.random() < 0.5 else p
        rows.append((rng.randint(0, 60), " ".join(w)))
    rows += rows[:5]
    assert run(docs_of(rows), window) == sorted(brute.repeats(rows, window), key=repr)


def test_repetition_within_a_document_stays(docs_of):
    rows = [(1, "a b " * 200), (2, "a b " * 100), (3, "b a " * 60)]
    assert run(docs_of(rows)) == sorted(brute.repeats(rows, 50), key=repr)


def test_odd_rows(docs_of, odd_rows):
    rows = [(d, t) for d, t, _ in odd_rows]
    assert run(docs_of(rows)) == sorted(brute.repeats(rows, 50), key=repr)


def test_empty(docs_of):
    assert run(docs_of([(1, "x")]).where("false")) == []


def test_kept_texts_on_request(docs_of):
    import hashlib

    shared = " ".join(f"s{i}" for i in range(60))
    rows = [(1, f"a  b {shared} c", "s"), (2, f"d {shared}\te\u00e9 f", "s"), (3, "not\nshared", "s"), (4, None, "s")]
    got = {r.doc_id: r for r in substrings.remove_repeats(docs_of(rows), texts=True).collect()}
    assert {d: r.kept for d, r in got.items()} == {1: f"a b {shared} c", 2: "d e\u00e9 f", 3: "not shared", 4: ""}
    assert all(hashlib.sha256(r.kept.encode()).hexdigest() == r.kept_sha256 for r in got.values())
    assert "kept" not in substrings.remove_repeats(docs_of(rows)).columns
