import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table of (doc_id, text[, source]) rows, with extra columns whose names clash with the operators' own."""

    def make(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None if r[1] is None else len(r[1])) for r in rows]
        df = spark.createDataFrame(full, SCHEMA)
        return df.selectExpr("*", "lang as batch", "lang as bucket", "lang as key", "lang as size", "lang as cls", "lang as taken", "lang as score")

    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty texts, ties, repeated rows, a very long text."""
    long = " ".join(f"w{i % 977}x{i % 31}" for i in range(60_000))
    return [(1, None, None), (2, "", "a"), (3, " \n\t", "a"), (4, "one", "b"), (4, "one", "b"), (4, "other words here", "b"), (None, "no id here", None), (5, long, "a"), (6, "UPPER lower Ünïcode\x85nel nbsp", "c"), (7, "x" * 5000, "c")]
