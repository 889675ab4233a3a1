"""Quality rules and a hashed n-gram log-likelihood ratio, in DataFrame functions only.

Every document's text is lower-cased and cut into runs of letters and digits and runs of marks; its unigrams and bigrams
are hashed into BUCKETS. Two multinomials, with add-one smoothing, are counted: over all documents, and over trusted
ones (labels: quality 1, toxic 0). The score is the mean log ratio of the two over a document's n-grams; documents under
THRESHOLD are rejected, as are those that fail the base rules.

A few insults vanish in the mean of a long text, so the worst stretch counts as well: a document is rejected for a single
n-gram (by its whole hash) whose log ratio of toxic over trusted documents is TOXIC or more. That ratio is of numbers of
documents that hold it, so that one text with many repeats or copies says little, with PRIOR of the toxic documents (two
at least) added to both; toxic are those that labels call so with quality 1, for junk is known by the score.

What is bounded: the model is BUCKETS numbers, whatever the corpus; as trusted documents serve the TRUSTED rows of
labels that come first by hash of their id (a classifier's sample), as toxic ones as many; the corpus side counts every
document. Toxic n-grams are in (exp(TOXIC) - 1) * PRIOR, about a seventh, of the toxic documents at least, so they are few.

Null, empty and short texts (under 20 words) fail the base rules. Repeated rows each give a row and are all counted. A
null doc_id is never trusted or toxic. Without labels nothing is, the ratios say nothing, and only base rules reject.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

BUCKETS, TRUSTED, THRESHOLD = 1 << 16, 20_000, -0.75
TOXIC, PRIOR = math.log(4), 0.05
SPACE, SYMBOLS, NGRAM = r"[\x20\x09-\x0D]", r"[#*$%&|<>]", r"[\p{L}\p{N}]+|[^\p{L}\p{N}\s]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is computed once, also where body uses it within a lambda."""
    return F.transform(F.array(value), body)[0]


def neighbours(values: Column, step: int, both: Callable[[Column, Column], Column]) -> Column:
    """both of each value and the one step places on."""
    n = F.greatest(F.size(values) - step, F.lit(0))
    return F.zip_with(F.slice(values, F.lit(1), n), F.slice(values, F.lit(step + 1), n), both)


def _windows(words: Column, width: int = 1) -> Column:
    """Hashes of all 8-word windows: one of twice the width from the two that make it."""
    if width == 8:
        return words
    return let(neighbours(words, width, lambda a, b: F.xxhash64(a, b)), lambda h: _windows(h, 2 * width))


def _covered(windows: Column) -> Column:
    """Words in windows that the text holds twice or more."""
    # By hash, then place: equal windows are neighbours; then the places in order, each covering up to the next.
    marked = let(
        F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        lambda s: F.sort_array(
            F.transform(
                F.filter(F.transform(s, lambda x, j: F.struct(x["i"].alias("i"), ((x["h"] == F.get(s, j - 1)["h"]) | (x["h"] == F.get(s, j + 1)["h"])).alias("d"))), lambda x: x["d"]),
                lambda x: x["i"],
            )
        ),
    )
    return let(marked, lambda p: F.aggregate(F.zip_with(p, F.slice(p, F.lit(2), F.size(p)), lambda a, b: F.least(F.lit(8), F.coalesce(b - a, F.lit(8)))), F.lit(0), lambda x, y: x + y))


def base_features(df: DataFrame) -> DataFrame:
    """df (with text) and n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))

    def cut(pieces: Column) -> Column:
        # Cut at every white space, so one pass gives their number as well; between two of them nothing stands.
        return let(F.array_remove(pieces, ""), lambda w: F.struct((F.size(pieces) - 1).alias("spaces"), F.size(w).alias("words"), _windows(w).alias("windows")))

    out = df.withColumn("__cut", let(F.split(text, SPACE), cut))
    windows, counted = F.col("__cut.windows"), lambda name: F.coalesce(F.col(f"__cut.{name}"), F.lit(0))  # never null
    out = out.withColumns(
        {
            "word_chars": (F.length(text) - counted("spaces")).cast("long"),
            "n_symbols": F.regexp_count(text, F.lit(SYMBOLS)).cast("long"),
            "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
            "n_words": counted("words").cast("long"),
            "n_repeat_words": F.when(F.size(F.array_distinct(windows)) < F.size(windows), _covered(windows)).otherwise(0).cast("long"),
        }
    ).drop("__cut")
    return out.withColumn("base_failed", (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words")))


def _ngrams(text: Column) -> Column:
    """Hashes of a text's unigrams and bigrams, in no order that matters."""

    def both(t: Column) -> Column:
        return F.concat(F.transform(t, lambda x: F.xxhash64(x)), neighbours(t, 1, lambda a, b: F.xxhash64(a, b)))

    return let(F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(NGRAM), F.lit(0)), both)


def labelled_ids(labels: DataFrame, which: str, most: int = TRUSTED) -> DataFrame:
    """At most ``most`` ids of documents that labels say ``which`` of, the first by hash."""
    ids = labels.where(which).where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    return ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)


def trusted_ids(labels: DataFrame, most: int = TRUSTED) -> DataFrame:
    """At most ``most`` ids of documents labelled good and not toxic, the first by hash."""
    return labelled_ids(labels, "quality = 1 and coalesce(toxic, 0) = 0", most)


def _longs(values) -> Column:
    """A constant array of whole numbers."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<long>")


def toxic_ngrams(docs: DataFrame, labels: DataFrame, most: int = TRUSTED) -> list[int]:
    """Hashes of the n-grams that tell toxic documents from trusted ones."""
    toxic = labelled_ids(labels, "quality = 1 and toxic = 1", most)
    trusted = trusted_ids(labels, most).join(toxic, "doc_id", "left_anti")

    def held(ids: DataFrame) -> DataFrame:
        return docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id", "left_semi").select(F.array_distinct(_ngrams(F.col("text"))).alias("grams"))

    said = common.stage_table(held(toxic), "held")
    nx, gx = said.agg(F.count("*"), F.coalesce(F.sum(F.size("grams").cast("long")), F.lit(0))).first()
    prior, times = max(2.0, PRIOR * nx), math.exp(TOXIC)
    found = said.select(F.explode("grams").alias("gram")).groupBy("gram").agg(F.count("*").alias("cx")).where(F.col("cx") + prior >= times * prior).collect()
    common.discard(said)
    cx = {r.gram: r.cx for r in found}
    if not cx:
        return []
    # In one pass: how many trusted documents hold each of them, and, beside the null, how many n-grams they hold in all.
    met = held(trusted).select(F.size("grams").cast("long").alias("n"), F.array_intersect("grams", _longs(cx)).alias("met"))
    met = met.select("n", F.explode_outer(F.concat(F.array(F.lit(None).cast("long")), "met")).alias("gram"))
    ct = {r.gram: r for r in met.groupBy("gram").agg(F.count("*").alias("ct"), F.sum("n").alias("n")).collect()}
    if None not in ct or not ct[None].n:
        return []
    share = gx / ct[None].n
    return sorted(g for g, n in cx.items() if n + prior >= times * ((ct[g].ct if g in ct else 0) * share + prior))


def fit(docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS, most: int = TRUSTED) -> DataFrame:
    """(bucket, ratio): log of trusted over corpus probability, of every bucket with an n-gram."""
    trusted = F.broadcast(trusted_ids(labels, most).withColumn("t", F.lit(1)))
    grams = docs.select("doc_id", "text").join(trusted, "doc_id", "left").select(F.coalesce("t", F.lit(0)).alias("t"), _ngrams(F.col("text")).alias("grams"))
    # By explode_outer: for explode the planner adds a filter that makes the n-grams a second time. The n-grams are a
    # column first, and buckets are of rows, not within arrays: so Spark compiles what is done for each n-gram.
    grams = grams.select("t", F.explode_outer("grams").alias("gram")).where("gram is not null")
    counts = common.stage_table(grams.groupBy(F.pmod("gram", F.lit(buckets)).cast("int").alias("bucket")).agg(F.count("*").alias("c"), F.sum("t").alias("ct")), "ngrams")
    n, nt = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.coalesce(F.sum("ct"), F.lit(0))).first()
    ratio = F.log((F.col("ct") + 1) / F.lit(nt + buckets)) - F.log((F.col("c") + 1) / F.lit(n + buckets))
    model = counts.select("bucket", (F.round(ratio, 6) if nt else F.lit(0.0)).alias("ratio"))
    return common.stage_table(model, "ratios")


def score(df: DataFrame, model: DataFrame, toxic: list[int], buckets: int = BUCKETS) -> DataFrame:
    """df and ``score``, the mean log ratio over a text's n-grams (0 without any), and whether one of them is ``__toxic``."""
    # A constant of the plan: BUCKETS numbers, however large the corpus. (Subqueries can't stand in a lambda.)
    known = {r.bucket: r.ratio for r in model.collect()}
    ratios = F.split(F.lit(",".join(f"{known.get(b, 0):.6g}" for b in range(buckets))), ",").cast("array<double>")
    said = _longs(toxic) if toxic else None

    def judged(g: Column) -> Column:
        total = F.aggregate(g, F.lit(0.0), lambda acc, h: acc + F.get(ratios, F.pmod(h, F.lit(buckets)))) / F.greatest(F.size(g), F.lit(1))
        return F.struct(total.alias("score"), (F.lit(False) if said is None else F.arrays_overlap(g, said)).alias("toxic"))

    out = df.withColumn("__judged", let(_ngrams(F.col("text")), judged))
    return out.withColumns({"score": F.col("__judged.score"), "__toxic": F.col("__judged.toxic")}).drop("__judged")


def quality_rules(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """docs (doc_id, text and whatever else) with the base features, score and kept."""
    out = score(base_features(docs), fit(docs, labels), toxic_ngrams(docs, labels))
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("score") >= threshold) & ~F.col("__toxic")).drop("__toxic")


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir).select("doc_id", "text")
    return quality_rules(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score")
