"""Product codes against plain Lloyd rounds."""

import hashlib
import math

import numpy as np
import pytest

from framewright.llm import codebooks


def plain(rows, entries, parts=4, rounds=4):
    kept = [(i, [math.floor(1024 * float(np.float32(x))) for x in v], l) for i, v, l in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = len(kept[0][1]) // parts
    cut = lambda v, p: v[p * width : (p + 1) * width]
    books = [[cut(v, p) for _, v, _ in kept[:entries]] for p in range(parts)]

    def nearest(v, p):
        return min((sum((a - b) ** 2 for a, b in zip(cut(v, p), e)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(parts):
            at = {}
            for _, v, _ in kept:
                at.setdefault(nearest(v, p)[1], []).append(cut(v, p))
            for k, vs in at.items():
                books[p][k] = [sum(c) // len(vs) for c in zip(*vs)]
    out = [(i, [nearest(v, p)[1] for p in range(parts)], sum(nearest(v, p)[0] for p in range(parts)), l) for i, v, l in kept]
    digest = hashlib.sha256(",".join(str(c) for p in books for e in p for c in e).encode()).hexdigest()
    return out, digest


def frame(spark, rows):
    return spark.createDataFrame([(i, v, l, "x", 1) for i, v, l in rows], "vec_id long, embedding array<float>, label int, code string, row long")


def order(r):
    return (r[0] is None, r[0] or 0, repr(r))


@pytest.mark.parametrize("scale, entries", [(0.3, 6), (3000.0, 9)])
def test_against_plain_rounds(spark, scale, entries):
    rng = np.random.default_rng(int(scale))
    centres = rng.normal(size=(5, 8)) * scale
    rows = [(i, (centres[i % 5] + rng.normal(size=8) * scale / 4).astype("f4").tolist(), [None, 1, 2][i % 3]) for i in rng.permutation(120).tolist()]
    rows += [rows[0], rows[0], (None, rows[1][1], 1), (3, [0.0] * 8, None), (500, None, 1), (501, [1.0, None] + [0.0] * 6, 1), (502, [float("nan")] + [0.0] * 7, 2), (503, [float("-inf")] + [0.0] * 7, 2), (504, [-0.0004] * 8, 9)]
    want, digest = plain(rows, entries)
    coded, books = codebooks.product_codes(frame(spark, rows), entries=entries)
    got = [(r.vec_id, r.code, r.error, r.label) for r in coded.collect()]
    assert sorted(got, key=order) == sorted(want, key=order)
    assert books.sha256() == digest


def test_vectors_that_cannot_be_coded(spark):
    rows = [(1, [1.0] * 4, 1), (2, [2.0] * 4, 1), (3, [1.0] * 8, 1), (4, [], 1), (5, [1e30] * 4, 2), (6, [1.0] * 4, 2)]
    coded, books = codebooks.product_codes(frame(spark, rows), entries=2)
    got = {r.vec_id: (r.code, r.error) for r in coded.collect()}
    assert got == {1: ([0] * 4, 0), 2: ([1] * 4, 0), 3: (None, None), 4: (None, None), 5: (None, None), 6: ([0] * 4, 0)}
    coded, books = codebooks.product_codes(frame(spark, [(1, [1.0, 2.0, 3.0], 1), (2, [1.0] * 4, 1)]))
    assert books is None and {r.vec_id: r.code for r in coded.collect()} == {1: None, 2: None}
    coded, books = codebooks.product_codes(frame(spark, []))
    assert books is None and coded.collect() == []


def test_query_sums_errors_of_equal_labels(spark, sf):
    got = codebooks.op11_product_codes(spark, sf).collect()
    table = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    assert len(got) == len(table) and len({r.codebooks_sha256 for r in got}) == 1
    label = {r.vec_id: r.label for r in table}
    sums = {}
    for r in got:
        sums[label[r.vec_id]] = sums.get(label[r.vec_id], 0) + r.error
    assert all(r.label_error == sums[label[r.vec_id]] and len(r.code) == 8 for r in got)


def test_nothing_is_left_behind(spark):
    before = {t.name for t in spark.catalog.listTables()}
    coded, _ = codebooks.product_codes(frame(spark, [(i, [float(i)] * 4, 1) for i in range(9)]), entries=3)
    coded.collect()
    assert {t.name for t in spark.catalog.listTables()} == before
