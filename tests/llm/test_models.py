"""Quality rules, mixing, the language model, HTML wrappers and the pipeline."""

import collections
import math
import re
import zlib

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from framewright.llm import hmm, mixing, quality, queries, wrappers
from framewright.llm.hashing import Words


# --- quality -------------------------------------------------------------------------------------
def features(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    seen = collections.Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    gone = [0] * len(w)
    for i in range(len(w) - 7):
        if seen[tuple(w[i : i + 8])] > 1:
            gone[i : i + 8] = [1] * 8
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), sum(gone)


def test_base_rules(docs_of, odd_rows):
    rows = odd_rows + [(20, "a b c d e f g h i " * 3, "s"), (21, "x\ny\nx\n\nx \n x", "s"), (22, "#a *b $c %d &e |f <g>", "s"), (23, "a " * 30, "s")]
    got = quality.base_features(docs_of(rows)).select("text", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed").collect()
    for r in got:
        want = features(r.text)
        assert tuple(r[1:6]) == want
        assert r.base_failed == (want[0] < 20 or 100 * want[4] > 30 * want[0])


def test_white_space_is_counted_by_the_cut_and_ngrams_are_a_column(spark, docs_of, monkeypatch):
    """CPU time: no strings made of each white space, n-grams made once and not within the generator, which Spark then compiles."""
    rows = [(0, " \t a\n\nb \x0b\x0c\r", "s"), (1, " \n ", "s"), (2, None, "s"), (3, " ".join(map(str, range(9))) + "  " + " ".join(map(str, range(9))), "s")]
    df = docs_of(rows)
    base = quality.base_features(df)
    assert [tuple(r) for r in base.orderBy("doc_id").select("n_words", "word_chars", "n_repeat_words").collect()] == [features(text)[:2] + features(text)[-1:] for _, text, _ in rows]
    plan = lambda out: out._jdf.queryExecution().optimizedPlan().toString()
    assert plan(base).count("regexp_extract_all") == 1
    staged, stage = [], quality.common.stage_table
    monkeypatch.setattr(quality.common, "stage_table", lambda out, *a, **k: staged.append(out) or stage(out, *a, **k))
    quality.fit(df, spark.createDataFrame([(0, 1, 0)], "doc_id long, quality int, toxic int"))
    assert "Generate explode(grams#" in plan(staged[0]) and plan(staged[0]).count("regexp_extract_all") == 1


def buckets(text):
    t = re.findall(r"[^\W_]+|(?:[^\w\s]|_)+", (text or "").lower())
    h = lambda *x: _chain(x) % quality.BUCKETS
    return [h(x) for x in t] + [h(a, b) for a, b in zip(t, t[1:])]


def _chain(parts):
    seed = 42
    for p in parts:
        seed = xxhash.xxh64(p.encode(), seed=seed).intdigest()
    return seed - (1 << 64) if seed >> 63 else seed


def test_likelihood_ratio(spark, docs_of):
    rows = [(i, f"clean words number {i} in a row, and some more of them here to make twenty words or so for the rules {i % 3}", "s") for i in range(40)]
    rows += [(100 + i, " ".join(f"JUNK{k}!!" for k in range(30)), "s") for i in range(10)]
    labels = spark.createDataFrame([(i, 1, 0) for i in range(30)] + [(100, 0, 0), (101, 1, 1)], "doc_id long, quality int, toxic int")
    out = {r.doc_id: r for r in quality.quality_rules(docs_of(rows).drop("score"), labels).collect()}
    c, t = collections.Counter(), collections.Counter()
    for d, text, _ in rows:
        c.update(buckets(text))
        if d < 30:
            t.update(buckets(text))
    n, nt = sum(c.values()), sum(t.values())
    for d, text, _ in rows:
        g = [round(math.log((t[b] + 1) / (nt + quality.BUCKETS)) - math.log((c[b] + 1) / (n + quality.BUCKETS)), 6) for b in buckets(text)]
        assert abs(out[d].score - sum(g) / len(g)) < 1e-5
        assert out[d].kept == (d < 100)


def test_a_few_insults_in_a_long_text_are_toxic(spark, docs_of):
    plain = lambda i: " ".join(f"word{(i * 7 + k) % 90} of{k % 11}" for k in range(150))
    rows = [(i, plain(i) + (" you Idiot, " if i % 4 == 0 else " you see, ") + plain(i + 3), "s") for i in range(120)]
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(60)], "doc_id long, quality int, toxic int")
    out = {r.doc_id: r for r in quality.quality_rules(docs_of(rows), labels).collect()}
    assert all(out[i].kept == (i % 4 > 0) and out[i].score >= quality.THRESHOLD for i in range(120))


def test_toxic_recall_on_the_table(spark):
    """With half of the labels: of the other half's good documents, toxic ones are caught and no clean one is lost for it."""
    at = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{at}/labels.parquet")
    out = quality.quality_rules(spark.read.parquet(f"{at}/documents.parquet"), labels.where("xxhash64(doc_id) % 2 = 0"))
    out = out.withColumn("by_rest", ~F.col("base_failed") & (F.col("score") >= quality.THRESHOLD)).join(labels, "doc_id")
    rest = out.where("xxhash64(doc_id) % 2 <> 0 and quality = 1").groupBy("toxic").agg(*(F.avg(F.col(c).cast("int")).alias(c) for c in ("kept", "by_rest")))
    found = {r.toxic: r for r in rest.collect()}
    assert found[1].kept < 0.5 and found[0].kept == found[0].by_rest


def test_quality_without_labels_and_rows(spark, docs_of, odd_rows):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    df = docs_of(odd_rows).drop("score")
    assert quality.quality_rules(df, labels).where("score <> 0").count() == 0
    assert quality.quality_rules(df.where("false"), labels).count() == 0


# --- mixing --------------------------------------------------------------------------------------
def level(sizes, weights):
    """Targets by the rule itself: cap, share the rest anew, until none is above."""
    total, capped = sum(sizes), set()
    while True:
        rest = [i for i in range(len(sizes)) if i not in capped]
        left = total - sum(3 * sizes[i] for i in capped)
        target = {i: weights[i] * left / sum(weights[j] for j in rest) for i in rest}
        over = {i for i in rest if target[i] > 3 * sizes[i]}
        if not over:
            return [3.0 * sizes[i] if i in capped else target[i] for i in range(len(sizes))]
        capped |= over


@pytest.mark.parametrize("sizes", [[100, 5, 3, 800, 50, 40], [10], [1, 1, 1, 1000], [0, 30, 30]])
def test_targets(spark, sizes):
    df = spark.createDataFrame([(f"s{i}", s) for i, s in enumerate(sizes)], "source string, size long")
    got = [r.target for r in mixing.targets(df).orderBy("sid").collect()]
    assert np.allclose(got, level(sizes, [(5, 2, 1)[i % 3] for i in range(len(sizes))]))


def test_mix_against_sql(spark, sf, docs_of, odd_rows, tmp_path):
    rows = odd_rows + [(i, "w " * (i * 7 % 90), ["a", "b", "c", None, "é"][i % 5]) for i in range(20, 300)]
    docs_of(rows).select("doc_id", "text", "lang", "source", "n_chars").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    c = duckdb.connect()
    c.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    got = sorted((tuple(r) for r in mixing.op5_mixing(spark, str(tmp_path)).collect()), key=repr)
    assert got == sorted(c.sql(mixing.OP5_SQL).fetchall(), key=repr)
    by = collections.defaultdict(lambda: [0, 0.0])
    source = {(d, len((t or "").split())): s for d, t, s in rows}
    for d, size, _, target, taken in got:
        assert taken <= 3 * size
        by[source.get((d, size), "?")][0] += taken
        by[source.get((d, size), "?")][1] = target
    for s, (taken, target) in by.items():
        assert s == "?" or abs(taken - target) <= 12


def test_mix_of_nothing(docs_of):
    assert mixing.mix(docs_of([(1, "x")]).where("false"), ["doc_id"]).count() == 0
    assert {r.taken for r in mixing.mix(docs_of([(1, ""), (2, None)]), ["doc_id"]).collect()} == {0}


def test_mixed_documents_keep_columns(docs_of):
    df = docs_of([(i, "w " * 50, "ab"[i % 2]) for i in range(40)])
    out = mixing.mixed_documents(df)
    assert out.columns == df.columns
    n = {r.source: r["count"] for r in out.groupBy("source").count().collect()}
    assert sum(n.values()) == 40 and abs(n["a"] - 40 * 5 / 7) <= 1.5


# --- language model ------------------------------------------------------------------------------
def tokens(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in re.findall(r"[^\x20\x09-\x0D]+", text or "")] + ["\n"]


def held(d):
    return zlib.crc32(str(d).encode()) % 7 == 2


def test_base_score(docs_of, odd_rows):
    rows = [r for r in odd_rows if r[0] is not None] + [(i, f"the {i % 9} words of Line {i % 4}", "s") for i in range(50, 130)]
    got = sorted((tuple(r) for r in hmm.hmm_scores(docs_of(rows), states=2, vocabulary=50, rounds=1).collect()), key=repr)
    c = collections.Counter(t for d, x, _ in rows if not held(d) for t in tokens(x))
    n, v = sum(c.values()), len(c)
    want = sorted(((d, held(d), len(tokens(x)), sum(c[t] > 0 for t in tokens(x)), n, sum(math.log10((c[t] + 1) / (n + v + 1)) for t in tokens(x))) for d, x, _ in rows), key=repr)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert all(abs(g[5] - w[5]) < 1e-6 * max(1, abs(w[5])) and g[6] < 0 for g, w in zip(got, want))
    assert hmm.hmm_scores(docs_of(rows).where("false"), rounds=1).collect() == []


def toy(states=3):
    m = hmm.Model([(hash_of(w), 5, 0) for w in "abcd"], [(0, 20, 4)], 6, states)
    rng = np.random.default_rng(7)
    m.set(rng.random(states), rng.random((states, states)), rng.random(m.emit.shape))
    return m


def hash_of(word):
    return int(Words([word.encode()]).hashes[0])


def test_forward_is_the_sum_over_paths():
    m = toy()
    w = Words([b"a b c", b"", b"d d"])
    symbols, first = hmm._with_ends(m.symbols(w)[0], w, m.end)
    got = hmm.log10_likelihood(m, symbols, first)
    for k in range(3):
        s = symbols[first[k] : first[k + 1]]
        total = 0.0
        for path in np.ndindex(*[m.states] * len(s)):
            p = m.start[path[0]] * m.emit[s[0], path[0]]
            for i in range(1, len(s)):
                p *= m.move[path[i - 1], path[i]] * m.emit[s[i], path[i]]
            total += p
        assert abs(got[k] - math.log10(total)) < 1e-9


def test_expectations_are_those_of_all_paths():
    m = toy(2)
    w = Words([b"a b d", b"c"])
    symbols, first = hmm._with_ends(m.symbols(w)[0], w, m.end)
    starts, moves, emits = hmm.expect(m, symbols, first)
    s2, m2, e2 = np.zeros(2), np.zeros((2, 2)), np.zeros_like(m.emit)
    for k in range(2):
        s = symbols[first[k] : first[k + 1]]
        weights = {}
        for path in np.ndindex(*[2] * len(s)):
            p = m.start[path[0]] * m.emit[s[0], path[0]]
            for i in range(1, len(s)):
                p *= m.move[path[i - 1], path[i]] * m.emit[s[i], path[i]]
            weights[path] = p
        z = sum(weights.values())
        for path, p in weights.items():
            s2[path[0]] += p / z
            for i, x in enumerate(path):
                e2[s[i], x] += p / z
                if i:
                    m2[path[i - 1], x] += p / z
    assert np.allclose(starts, s2) and np.allclose(moves, m2) and np.allclose(emits, e2)


def test_model_is_a_distribution():
    m = toy()
    assert np.allclose(m.emit.sum(0), 1) and np.allclose(m.move.sum(1), 1) and abs(m.start.sum() - 1) < 1e-12


def test_states_help_on_held_out_text(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = hmm.hmm_scores(df, vocabulary=4096, rounds=3).where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert out[0] > 0.97 * out[1]
    again = hmm.hmm_scores(df.repartition(7), vocabulary=4096, rounds=1).agg(F.sum("score")).first()[0]
    assert abs(again - hmm.hmm_scores(df, vocabulary=4096, rounds=1).agg(F.sum("score")).first()[0]) < 1e-3


# --- wrappers ------------------------------------------------------------------------------------
PAGE = """<!DOCTYPE html><html><head><title>t &amp; u</title><style>p{{}}</style><script>var x="</p>";</script></head><body>
<header><h2>Site</h2></header><nav><ul><li><a href=/a>Menu</a><li>More</ul></nav><!-- <p>not this</p> -->
{open}<h1>Head {n}</h1><p>First &eacute;t&#233; &lt;b&gt; {n}<p>Second  <b>bold</b>
text {n}<br>line</p>{extra}<aside>Aside</aside><div class="ad banner">Buy</div>{close}
<section class="comments"><p>Nice page!</p></section><form><p>Sign up</p></form><div id=cookie-notice>We use cookies</div><footer>&copy; us</footer></body>"""


@pytest.mark.parametrize("open,close", [("<article>", "</article>"), ("<main>", "</main>"), ('<div class="content">', "</div>")])
def test_main_text(spark, open, close):
    rows = [(i, f"http://Host.org/{i}", PAGE.format(n=f"number{i} " * (i + 1), open=open, close=close, extra="<ul><li>a<li>b</ul>" * (i % 2))) for i in range(6)]
    rows += [(7, None, None), (8, "nonsense", "plain &amp; simple"), (9, "http://host.org/9", "<p>odd page</p>"), (0, *rows[0][1:])]
    got = {r.page_id: r for r in wrappers.extract_main(spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit("clash"))).collect()}
    for i in range(6):
        n = " ".join([f"number{i}"] * (i + 1))
        want = [f"Head {n}", f"First été <b> {n}", f"Second bold text {n}", "line"] + (["a", "b"] if i % 2 else [])
        assert got[i].text == "\n".join(want) and got[i].n_chars == len(got[i].text)
    assert got[7].text == "" and got[8].text == "plain & simple" and got[9].text == "odd page"


def test_inference_marks_optional_repeated_and_slots():
    a, b = "<div><p>x</p><p>y</p></div>", "<div><h1>t</h1><p>z</p></div>"
    (div,) = wrappers.infer([a, b])[1][5]
    h1, p = div[5]
    assert (h1[0], h1[1], h1[2]) == ("h1", True, False) and (p[0], p[1], p[2], p[3]) == ("p", False, True, 1)


def test_all_article_text_of_the_table(spark, sf):
    import html

    for r in wrappers.op8_html(spark, sf).join(spark.read.parquet(f"{sf}/pages.parquet"), "page_id").collect():
        m = re.search(r"<article>(.*?)</article>", r.html, re.S)
        parts = [" ".join(html.unescape(re.sub("<[^>]*>", "", x)).split()) for x in re.split(r"</?(?:p|h1|br)>", m[1])]
        assert r.text == "\n".join(x for x in parts if x)


def main_texts(spark, pages):
    df = spark.createDataFrame([(i, f"http://host.org/{i}", p) for i, p in enumerate(pages)], "page_id long, url string, html string")
    return [r.text for r in wrappers.extract_main(df).orderBy("page_id").collect()]


def test_copies_of_a_page_keep_their_text(spark):
    page = '<div class="content"><h1>Title</h1><p>The whole text</p></div>'
    assert main_texts(spark, [page] * 5) == ["Title\nThe whole text"] * 5
    assert main_texts(spark, [page] * 5 + [page.replace("Title", "Other")])[:5] == ["Title\nThe whole text"] * 5


def test_text_of_one_page_is_not_constant(spark):
    page = '<div class="content"><h1>Title {0}</h1><p>{1}</p><p>By us</p><div>{2}</div></div>'
    got = main_texts(spark, [page.format(i, f"text {i}", "only here" if i == 2 else "") for i in range(5)])
    assert got == [f"Title {i}\ntext {i}\nBy us" + "\nonly here" * (i == 2) for i in range(5)]
    page = '<div class="content"><h1>Title {0}</h1><h2>By us</h2><div>{1}</div></div>'
    got = main_texts(spark, [page.format(i, "<p>only here</p>" * (i == 2)) for i in range(5)])
    assert got == [f"Title {i}" + "\nonly here" * (i == 2) for i in range(5)]


def test_texts_of_equal_beginning_differ(spark):
    same = "the same words " * 20
    page = '<div class="content"><h1>Title {0}</h1><p>' + same + "{0}</p><div>By A &amp; B</div></div>"
    assert main_texts(spark, [page.format(i) for i in range(5)]) == [f"Title {i}\n{same}{i}" for i in range(5)]


@pytest.mark.parametrize("page,want", [
    ("<body class='single has-sidebar'><article><p>text</p></article></body>", "text"),
    ("<body class='sidebar-left'><div><p>text</p></div></body>", "text"),
    ("<body><div class='content with-sidebar'><h1>title</h1><p>text</p></div></body>", "title\ntext"),
    ("<body><p>x</p><div class='content sidebar-left'><article><p>text</p></article></div></body>", "text"),
    ("<body><article class='post no-comments'><p>text</p><div class='comments'>nice</div></article></body>", "text"),
    ("<body><main><h1>t</h1><article class='post sidebar-right'><p>text</p></article></main></body>", "t\ntext"),
    ("<body><article><p>text</p></article><div class='comments'><article class='comment'><p>a longer comment</p></article></div></body>", "text"),
    ("<body><div class='search'><p>text</p></div></body>", "text"),
])
def test_class_words_leave_the_main_text(page, want):
    assert wrappers.extract(page, None) == want
    assert wrappers.extract(page, wrappers.infer([page] * 5)) == want


# --- all together --------------------------------------------------------------------------------
@pytest.mark.parametrize("tag", ["div", "article", "b", "section"])
def test_pages_nested_very_deep(tag):
    deep = 10_000
    page = f"<html><body><nav>menu</nav>{f'<{tag}>' * deep}<p>the text of the page</p>{f'</{tag}>' * deep}</body></html>"
    found = wrappers.infer([page, page.replace("text", "other text")])
    said = wrappers.dump(found)
    assert wrappers.dump(wrappers.load(said)) == said
    assert wrappers.extract(page, found) == "the text of the page"


def test_pipeline_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    kept = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs = corpus_pipeline.common.stage_table(stage(spark, docs, sf), name)
        kept[name] = docs.collect()
        if k < 4:
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    good = {r.doc_id for r in quality.quality_rules(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")).where("kept").collect()}
    assert {r.doc_id for r in kept["quality_rules"]} == good
    import brute
    from framewright.llm import pii

    first = [(d, texts[d]) for d in sorted(good)]
    heads = {c for _, _, c in brute.jaccard_groups(first, 5, 80)}
    assert {r.doc_id for r in kept["ngram_jaccard_join"]} == heads
    assert {r.doc_id: r.text for r in kept["pii"]} == {d: pii.redact(texts[d]) for d in heads}
    assert {r.doc_id for r in kept["source_mixing"]} <= heads and len(kept["byte_level_bpe"]) == len(kept["source_mixing"])


def test_names():
    assert [n for n in range(1, 11) if not any(k.startswith(f"op{n}_") for k in queries.QUERIES)] == []
    assert len(corpus_pipeline.STAGES) == 5
