"""Collocations against counting everything in Python."""

import random
import re
from collections import Counter

import pytest

from framewright.llm import phrases

LOWER = {c: c + 32 for c in range(65, 91)}


def plain(rows, least, top, percent):
    f, n = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        counts = f.setdefault(lang, Counter())
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, 6):
                counts.update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, counts in f.items():
        found = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        kept = []
        for p, a in found.items():
            inside = (q for q in found if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q))))
            if any(100 * found[q] >= percent * a for q in inside):
                continue
            cuts = [(1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            kept.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, p, l, r) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, n[lang], -score))
    return sorted(out)


def collected(spark, rows, **options):
    df = spark.createDataFrame([(i, t, l, "x") for i, (l, t) in enumerate(rows)], "doc_id long, text string, lang string, word string")
    return sorted(tuple(r) for r in phrases.collocations(df, **options).collect())


def corpus(seed, n):
    rng = random.Random(seed)
    words = ["a", "b", "C", "dd", "É", "f-f", "x" * 300, "the", "The"]
    fixed = ["one two three four five six", "the cat sat", "a a a a a a a a"]
    return [(rng.choice(["en", "de", None, "und", ""]), "".join(rng.choice([" ", "  ", "\t", ". ", "\n", "!", " ", " "]) + (rng.choice(fixed) if rng.random() < 0.2 else rng.choice(words)) for _ in range(rng.randint(0, 60)))) for _ in range(n)]


@pytest.mark.parametrize("hot, held, percent", [(1 << 16, 400_000, 100), (12, 30, 100), (40, 400_000, 80)])
def test_against_plain_counting(spark, monkeypatch, hot, held, percent):
    monkeypatch.setattr(phrases, "HOT", hot)
    monkeypatch.setattr(phrases, "HELD", held)
    rows = [*corpus(hot, 90), ("en", None), (None, ""), ("en", " .,\n"), ("fr", "only once")] + [("en", "again and again and again")] * 9
    assert collected(spark, rows, least=5, top=40, percent=percent) == plain(rows, 5, 40, percent)


def test_ties_at_the_end_go_by_text(spark):
    rows = [("en", " . ".join(f"{a} {b}" for a in ("m", "k", "z") for b in ("q", "p")))] * 6
    got = collected(spark, rows, least=6, top=4)
    assert got == plain(rows, 6, 4, 100) and [r[2] for r in got] == ["k p", "k q", "m p", "m q"]


def test_full_filters_only_cost_work(spark, monkeypatch):
    monkeypatch.setattr(phrases, "BLOOM_BITS", (64, 64))
    rows = corpus(3, 60)
    assert collected(spark, rows, least=5, top=50) == plain(rows, 5, 50, 100)


def test_languages_without_phrases_beside_others(spark):
    rows = [(f"l{k:02}", "") for k in range(9)] + [("aa", "x")] * 3 + [("zz", "again and again and again")] * 9
    assert collected(spark, rows, least=5, top=9) == plain(rows, 5, 9, 100)


def test_empty_and_null_only(spark):
    assert collected(spark, [("en", None), (None, "")], least=1) == []
    assert phrases.collocations(spark.createDataFrame([], "text string, lang string")).collect() == []


def test_products_past_64_bits(spark):
    """The score's arithmetic with counts as a corpus of 10^13 words has."""
    a, n, l, r = 10**10, 10**13, 3 * 10**11, 7 * 10**10
    big = spark.createDataFrame([(a, n, l, r)], "a long, n long, l long, r long").selectExpr(f"{phrases.SCORE} as score").first()[0]
    assert big == 1000 * a * n // (l * r)
