import random

import brute
import pytest

from framewright.llm import jaccard
from framewright.llm.components import components


def run(df, n, percent):
    return sorted((tuple(r) for r in jaccard.jaccard_groups(df, n, percent).collect()), key=repr)


def edited(rng, words, share):
    return [rng.choice("abcdefgh") + str(rng.randint(0, 99)) if rng.random() < share else w for w in words]


@pytest.mark.parametrize("seed", [1, 2])
def test_borderline_copies(docs_of, seed):
    """Groups whose members are near the threshold of each other, of many sizes, so that links form chains."""
    rng = random.Random(seed)
    rows = []
    for size in (5, 9, 30, 70, 150, 400):
        base = [f"v{rng.randint(0, 5000)}" for _ in range(size)]
        for share in (0.0, 0.01, 0.02, 0.03):
            for _ in range(12):
                base = edited(rng, base, 0.004)
                rows.append((len(rows) * 3 % 997, " ".join(edited(rng, base, share))))
    assert run(docs_of(rows), 4, 85) == sorted(brute.jaccard_groups(rows, 4, 85), key=repr)


def test_exactly_at_the_threshold(docs_of):
    a = [f"w{i}" for i in range(40)]
    rows = [(1, " ".join(a)), (2, " ".join(a[:36] + ["z"])), (3, " ".join(a[:34])), (4, " ".join(a[:35])), (5, " ".join(a).upper())]
    assert run(docs_of(rows), 1, 85) == sorted(brute.jaccard_groups(rows, 1, 85), key=repr)


def test_shared_passage_is_no_link(docs_of):
    rng = random.Random(3)
    passage = [f"p{i}" for i in range(40)]
    rows = [(i, " ".join([f"a{rng.randint(0, 9999)}" for _ in range(30)] + passage)) for i in range(120)]
    assert run(docs_of(rows), 4, 85) == sorted(brute.jaccard_groups(rows, 4, 85), key=repr)


def test_odd_rows(docs_of, odd_rows):
    rows = [(d, t) for d, t, _ in odd_rows if d is not None]
    assert run(docs_of(rows), 4, 85) == sorted(brute.jaccard_groups(rows, 4, 85), key=repr)
    got = {(r[0], r[2]) for r in run(docs_of(odd_rows), 4, 85)}
    assert (None, None) in got


def test_empty(docs_of):
    assert run(docs_of([(1, "x")]).where("false"), 4, 85) == []


def test_sketch_bounds_the_difference():
    texts = [b"a b c d e f g h", b"a b c d e f g x y"]
    s = jaccard.Shingles(texts, 1)
    k = s.sketches()
    far = jaccard._popcount((k[0] ^ k[1])[None])[0]
    a, b = ({*s.hashes[s.first[i] : s.first[i + 1]].tolist()} for i in (0, 1))
    assert far <= len(a ^ b) == 3


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (102, 101), (7, 7)]
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(41), 0), 100: 100, 101: 100, 102: 100}


def test_small_sets(docs_of):
    """Sets of every size up to 70, with near copies at, above and below the threshold."""
    rng = random.Random(11)
    rows = []
    for size in range(1, 71):
        base = [f"s{size}x{i}" for i in range(size)]
        for cut in (0, 0, size // 12, size // 8, size // 6, size // 5):
            rows.append((len(rows), " ".join(base[: size - cut])))
            rows.append((len(rows), " ".join(base[: size - cut] + [f"n{rng.randint(0, 10**9)}" for _ in range(cut // 2)])))
    for n, percent in ((1, 85), (4, 85), (5, 80)):
        assert run(docs_of(rows), n, percent) == sorted(brute.jaccard_groups(rows, n, percent), key=repr)


def test_large_sets(docs_of):
    """Sets of thousands of shingles, beyond what the narrow sketch tells apart."""
    rng = random.Random(12)
    rows = []
    for size in (1900, 2100, 4000, 9000):
        shared = [f"p{i}" for i in range(400)]
        for _ in range(3):
            base = [f"v{rng.randint(0, 10**6)}" for _ in range(size)] + shared
            for share in (0.0, 0.005, 0.015, 0.025, 0.04):
                rows.append((len(rows), " ".join(edited(rng, base, share))))
    assert run(docs_of(rows), 4, 85) == sorted(brute.jaccard_groups(rows, 4, 85), key=repr)


def test_keys_of_many_classes(docs_of, monkeypatch):
    """A key with more classes than a chunk is dealt as pairs of chunks, and nothing is lost."""
    monkeypatch.setattr(jaccard, "CHUNK", 5)
    rng = random.Random(13)
    rows = []
    for _ in range(4):
        base = [f"v{rng.randint(0, 5000)}" for _ in range(150)]
        for _ in range(30):
            base = edited(rng, base, 0.004)
            rows.append((len(rows), " ".join(edited(rng, base, 0.02))))
    assert run(docs_of(rows), 4, 85) == sorted(brute.jaccard_groups(rows, 4, 85), key=repr)


def test_wide_sketches_bound_the_difference():
    rng = random.Random(14)
    base = [f"v{rng.randint(0, 10**6)}" for _ in range(9000)]
    texts = [" ".join(x).encode() for x in (base, edited(rng, base, 0.02), base[:4200], edited(rng, base, 1.0))]
    s = jaccard.Shingles(texts, 4)
    sets = [{*s.hashes[s.first[i] : s.first[i + 1]].tolist()} for i in range(4)]
    for i in range(4):
        for j in range(4):
            assert jaccard._far(s.wide(i), s.wide(j)) <= len(sets[i] ^ sets[j])
    n = len(sets[0]) + len(sets[3])
    assert jaccard._far(s.wide(0), s.wide(3)) > jaccard.bound(n, 85)


def test_chance_meetings_stay_few(spark, docs_of, monkeypatch):
    """Texts that share a few phrases each with many others, without a link: hardly a pair of them may reach the sketches."""
    rng = random.Random(15)
    phrases = [[f"p{k}x{i}" for i in range(6)] for k in range(60)]
    rows = []
    for d in range(400):
        words = [f"d{d}w{i}" for i in range(60)]
        for p in rng.sample(phrases, 8):
            words += [*p, f"d{d}z{len(words)}"]
        rows.append((d, " ".join(words)))
    rows.append((400, rows[7][1] + " tail"))
    asked = []
    near = jaccard._near
    monkeypatch.setattr(jaccard, "_near", lambda pairs, *more: asked.append(pairs.count()) or near(pairs, *more))
    got = run(docs_of(rows), 5, 80)
    assert {r[0]: r[2] for r in got} == {d: 7 if d == 400 else d for d in range(401)}
    assert sum(asked) < 20


def test_short_numbers_bound_the_number():
    x = jaccard.np.array([0, 1, 2047, 2048, 2049, 4095, 4096, 70_001, 10**9])
    code = jaccard._short(x)
    assert (jaccard._least(code) <= x).all() and (x <= jaccard._most(code)).all()
    assert (jaccard._least(code)[:3] == x[:3]).all() and (jaccard._most(code)[:3] == x[:3]).all()


def test_near_copies_in_one_pass(docs_of, monkeypatch):
    """A key's classes come to their components in one pass, however many partners they have to try, and no text is shuffled for the exact sets."""
    rng = random.Random(16)
    base = [f"v{rng.randint(0, 5000)}" for _ in range(150)]
    rows = [(i, " ".join(edited(rng, base, 0.022))) for i in range(70)]
    made, plans, stage = [], [], jaccard.common.stage_table

    def staged(df, tag, *more, **named):
        if tag == "sets":
            plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return stage(df, tag, *more, **named)

    monkeypatch.setattr(jaccard.common, "stage_table", staged)
    monkeypatch.setattr(jaccard, "components", lambda links: made.append(1) or components(links))
    assert run(docs_of(rows), 4, 85) == sorted(brute.jaccard_groups(rows, 4, 85), key=repr)
    assert len(made) <= 2
    assert plans and all("Join" not in p.split("MapInArrow")[1] for p in plans)
