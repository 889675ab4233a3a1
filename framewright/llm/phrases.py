"""Phrase collocations by contiguous pattern growth, in the manner of PrefixSpan.

A phrase with at least LEAST occurrences has only parts with as many, so a frequent prefix is grown to the right by
what follows its occurrences. Words are counted first, then pairs of frequent words. An occurrence of a frequent pair is
projected: a pointer to it is a row with the words it points at, up to five, cut where a pair isn't frequent. Rows of
one (lang, pair) meet in one task, sorted, so the projection of a prefix is a range of rows; the task counts what follows
the prefix within the range and goes on depth-first with each frequent extension.

Pairs with HOT occurrences or more aren't grown in one task: their rows are dealt by the words that follow, every prefix
of each is counted where it lies, and sums are taken after. Equal rows are one row with a count from the start.
Frequent words and pairs reach the tasks as Bloom filters of at most 16 MB; what these let through by chance, or because
they are full, costs work and doesn't survive counting. Words are known by 64-bit hashes; their texts are joined to the
phrases that are returned.

Null texts are empty, a null lang is ``und``; null ids and repeated rows count like others, further columns are not
read, an empty table has no phrases. Scores are integers of up to 38 digits.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import common
from .hashing import Words

LONGEST = 5
#: Occurrences of a pair from which its rows are dealt to many tasks.
HOT = 1 << 16
#: Entries that a task counts before it hands them on.
HELD = 400_000
BLOOM_BITS = (1 << 16, 1 << 27)

#: floor(1000 a n / (l r)) in up to 38 digits.
SCORE = "cast(1000 * cast(a as decimal(19, 0)) * cast(n as decimal(15, 0)) as decimal(38, 0)) div cast(cast(l as decimal(19, 0)) * cast(r as decimal(19, 0)) as decimal(38, 0))"

_breaks = np.zeros(256, bool)
_breaks[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_parts = _breaks.copy()
_parts[[0x20, 0x09]] = True
_to_blank = bytes(0x20 if _parts[c] else c + 32 if 65 <= c < 91 else c for c in range(256))
_columns = [f"w{k}" for k in range(1, LONGEST + 1)]


def _by_lang(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[bytes]]]:
    for rb in common.slices(batches, "text"):
        by: dict[str, list[bytes]] = {}
        for lang, text in zip(rb.column("lang").to_pylist(), common.utf8(rb)):
            by.setdefault(lang, []).append(text)
        yield from by.items()


def _tagged(h: np.ndarray, lang: str) -> np.ndarray:
    """Word hashes told apart by language."""
    return common.mix64(h ^ Words([lang.encode() + b"\n"], space=_parts).hashes[:1].sum() ^ np.uint64(len(lang)))


def _pairs(h: np.ndarray) -> np.ndarray:
    """A hash of each word with the next."""
    return common.mix64(h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:])


def _words(texts: list[bytes], lang: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word hashes; by number of the first word: pair hashes with the language; whether both are in one piece)."""
    w = Words(texts, lower=True, space=_parts)
    piece = np.cumsum(_breaks[np.frombuffer(w.buffer, np.uint8)])[w.starts] if len(w.starts) else np.zeros(0, np.int64)
    return w.hashes, _pairs(_tagged(w.hashes, lang)), piece[1:] == piece[:-1]


def word_counts(docs: DataFrame) -> DataFrame:
    """(lang, word, h, a): every word's occurrences; docs: lang, text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = {}
        for lang, texts in _by_lang(batches):
            counter = held.setdefault(lang, Counter())
            for text in texts:
                counter.update(text.translate(_to_blank).split())
            if sum(map(len, held.values())) > HELD:
                yield from hand_on(held)
                held.clear()
        yield from hand_on(held)

    def hand_on(held: dict[str, Counter]) -> Iterator[pa.RecordBatch]:
        for lang, counter in held.items():
            if counter:
                words = list(counter)
                columns = [pa.array([lang] * len(words)), pa.array([w.decode() for w in words]), pa.array(Words(words, space=_parts).hashes.view(np.int64)), pa.array(list(counter.values()), pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["lang", "word", "h", "a"])

    return docs.mapInArrow(run, "lang string, word string, h long, a long").groupBy("lang", "word", "h").agg(F.sum("a").alias("a"))


class Bloom:
    """Two bits of each of some 64-bit hashes, in a size that grows with their number up to a bound."""

    def __init__(self, hashes: DataFrame, n: int):
        low, high = BLOOM_BITS
        self.bits = min(high, max(low, 1 << (16 * n - 1).bit_length() if n else low))
        at = F.explode(F.array(F.col("h"), F.shiftrightunsigned("h", 32))).alias("p")
        at = hashes.select(at).select(F.col("p").bitwiseAND(F.lit(self.bits - 1)).alias("p"))
        at = at.select(F.shiftrightunsigned("p", 6).alias("k"), F.expr("shiftleft(1L, cast(p & 63 as int))").alias("v"))
        rows = at.groupBy("k").agg(F.bit_or("v").alias("v")).toArrow()
        self.words = np.zeros(self.bits // 64, np.uint64)
        self.words[rows.column("k").to_numpy()] = rows.column("v").to_numpy().view(np.uint64)

    def holds(self, h: np.ndarray) -> np.ndarray:
        out = np.ones(len(h), bool)
        for p in (h, h >> np.uint64(32)):
            p = p & np.uint64(self.bits - 1)
            out &= (self.words[p >> np.uint64(6)] >> (p & np.uint64(63)) & np.uint64(1)).astype(bool)
        return out


def _pair_counts(docs: DataFrame, frequent) -> DataFrame:
    """(h, a) of pairs of frequent words; h names the language too."""

    def merged(parts: list) -> tuple[np.ndarray, np.ndarray]:
        h, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        return h, np.bincount(at, np.concatenate([p[1] for p in parts]), len(h)).astype(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = []
        for lang, texts in _by_lang(batches):
            h, pair, one = _words(texts, lang)
            often = frequent.value.holds(_tagged(h, lang))
            parts.append(np.unique(pair[one & often[1:] & often[:-1]], return_counts=True))
            if sum(len(p[0]) for p in parts) > 4 * HELD:
                parts = [merged(parts)]
                if len(parts[0][0]) > 2 * HELD:
                    yield from hand_on(parts.pop())
        if parts:
            yield from hand_on(merged(parts))

    def hand_on(part) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_arrays([pa.array(part[0].view(np.int64)), pa.array(part[1])], ["h", "a"])

    return docs.mapInArrow(run, "h long, a long").groupBy("h").agg(F.sum("a").alias("a"))


def _projections(docs: DataFrame, frequent, hot) -> DataFrame:
    """(lang, w1 .. w5, n, hot): what occurrences of frequent pairs point at, 0 beyond its end, and how often."""

    def merged(parts: list) -> tuple:
        key = np.concatenate([p[0] for p in parts])
        key, first, at = np.unique(key, return_index=True, return_inverse=True)
        window, is_hot, n = (np.concatenate([p[k] for p in parts]) for k in (1, 2, 3))
        return key, window[first], is_hot[first], np.bincount(at, n, len(key)).astype(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}
        for lang, texts in _by_lang(batches):
            h, pair, one = _words(texts, lang)
            one &= frequent.value.holds(pair)
            at = np.flatnonzero(one)
            window = np.zeros((len(at), LONGEST), np.uint64)
            window[:, 0] = h[at]
            go = np.append(one, np.zeros(LONGEST, bool))
            on = np.ones(len(at), bool)
            for k in range(1, LONGEST):
                on &= go[at + k - 1]
                window[on, k] = h[at[on] + k]
            key = np.zeros(len(at), np.uint64)
            for k in range(LONGEST):
                key = common.mix64(key * np.uint64(0x9E3779B97F4A7C15) + window[:, k])
            parts = held.setdefault(lang, [])
            parts.append(merged([(key, window, hot.value.holds(pair[at]), np.ones(len(at), np.int64))]))
            if sum(len(p[0]) for p in parts) > HELD:
                parts[:] = [merged(parts)]
            if sum(len(p[0]) for parts in held.values() for p in parts) > 2 * HELD:
                yield from hand_on(held)
                held.clear()
        yield from hand_on(held)

    def hand_on(held: dict[str, list]) -> Iterator[pa.RecordBatch]:
        for lang, parts in held.items():
            _, window, is_hot, n = merged(parts)
            columns = [pa.array([lang] * len(n), pa.string()), *[pa.array(np.ascontiguousarray(window[:, k]).view(np.int64)) for k in range(LONGEST)], pa.array(n), pa.array(is_hot)]
            yield pa.RecordBatch.from_arrays(columns, ["lang", *_columns, "n", "hot"])

    return docs.mapInArrow(run, f"lang string, {', '.join(f'{c} long' for c in _columns)}, n long, hot boolean")


class _Rows:
    """Sorted rows of projections: words (a column for each place), counts, and where a new (lang, pair) begins."""

    def __init__(self, batch: pa.RecordBatch):
        self.batch = batch
        self.lang = batch.column("lang").dictionary_encode()
        self.words = [batch.column(c).to_numpy() for c in _columns]
        self.n = batch.column("n").to_numpy()
        self.upto = np.concatenate([[0], np.cumsum(self.n)])
        code = self.lang.indices.to_numpy(zero_copy_only=False)
        new = (code[1:] != code[:-1]) | (self.words[0][1:] != self.words[0][:-1]) | (self.words[1][1:] != self.words[1][:-1])
        self.pairs = np.concatenate([[0], np.flatnonzero(new) + 1]) if len(self.n) else np.zeros(0, np.int64)

    def grow(self, low: int, high: int, k: int, least: int, out: list) -> None:
        """The prefix of k words that rows low to high share, then what extends it to the right, depth-first."""
        out.append((low, k, int(self.upto[high] - self.upto[low])))
        if k == LONGEST:
            return
        following = self.words[k][low:high]
        edges = np.concatenate([[0], np.flatnonzero(following[1:] != following[:-1]) + 1, [high - low]]) + low
        often = self.upto[edges[1:]] - self.upto[edges[:-1]] >= least
        for i in np.flatnonzero(often & (self.words[k][edges[:-1]] != 0)):
            self.grow(int(edges[i]), int(edges[i + 1]), k + 1, least, out)

    def frequent(self, least: int) -> pa.RecordBatch:
        out: list = []
        edges = np.append(self.pairs, len(self.n))
        for i in np.flatnonzero(self.upto[edges[1:]] - self.upto[edges[:-1]] >= least):
            self.grow(int(edges[i]), int(edges[i + 1]), 2, least, out)
        return self.phrases(*np.array(out, np.int64).reshape(-1, 3).T)

    def prefixes(self) -> pa.RecordBatch:
        """Every prefix of two words or more of every row, counted here only."""
        found = []
        for k in range(2, LONGEST + 1):
            at = np.flatnonzero(self.words[k - 1] != 0)
            if len(at):
                code = self.lang.indices.to_numpy(zero_copy_only=False)[at]
                new = code[1:] != code[:-1]
                for w in self.words[:k]:
                    new |= w[at][1:] != w[at][:-1]
                first = np.concatenate([[0], np.flatnonzero(new) + 1])
                found.append(np.stack([at[first], np.full(len(first), k), np.add.reduceat(self.n[at], first)]))
        return self.phrases(*(np.concatenate(found, axis=1) if found else np.zeros((3, 0), np.int64)))

    def phrases(self, row: np.ndarray, k: np.ndarray, a: np.ndarray) -> pa.RecordBatch:
        words = [pa.array(np.where(place < k, self.words[place][row], 0)) for place in range(LONGEST)]
        return pa.RecordBatch.from_arrays([self.lang.dictionary_decode().take(pa.array(row)), *words, pa.array(a)], ["lang", *_columns, "a"])


def _grown(projected: DataFrame, least: int) -> DataFrame:
    """(lang, w1 .. w5, a) of the phrases of two words or more with least occurrences."""
    spread = F.when(F.col("hot"), F.xxhash64("w3", "w4", "w5")).otherwise(F.lit(0))
    parts = max(int(projected.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    dealt = projected.withColumn("spread", spread).repartition(parts, "lang", "w1", "w2", "spread").drop("spread")
    dealt = dealt.sortWithinPartitions("hot", "lang", *_columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            is_hot = batch.column("hot")
            spread_out = batch.filter(is_hot)
            if spread_out.num_rows:
                yield _Rows(spread_out).prefixes()
            batch = batch.filter(pc.invert(is_hot))
            if held is not None and held.num_rows:
                batch = pa.concat_batches([held, batch])
            if batch.num_rows:
                # The last pair's rows may go on in the next batch; they are fewer than HOT.
                rows = _Rows(batch)
                yield _Rows(batch.slice(0, int(rows.pairs[-1]))).frequent(least)
                held = batch.slice(int(rows.pairs[-1]))
        if held is not None and held.num_rows:
            yield _Rows(held).frequent(least)

    grown = dealt.mapInArrow(run, f"lang string, {', '.join(f'{c} long' for c in _columns)}, a long")
    return grown.groupBy("lang", *_columns).agg(F.sum("a").alias("a")).where(F.col("a") >= least)


def frequent_phrases(df: DataFrame, least: int = 100, lang_col: str = "lang", text_col: str = "text") -> tuple[DataFrame, DataFrame, DataFrame]:
    """((lang, n): all words; (lang, word, h): frequent ones; (lang, p, k, a): frequent phrases of 1 to 5 words as hashes)."""
    docs = df.select(F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    context = df.sparkSession.sparkContext
    counted = word_counts(docs)
    kept = counted.withColumn("few", F.col("a") < least)
    kept = kept.groupBy("lang", F.when(~F.col("few"), F.col("word")).alias("word"), F.when(~F.col("few"), F.col("h")).alias("h")).agg(F.sum("a").alias("a"))
    kept = common.stage_table(kept, "words")  # frequent words, and all others of a language as one row
    sizes = kept.groupBy("lang").agg(F.sum("a").alias("n"))
    words = kept.where("word is not null")

    def tags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            h = rb.column("h").to_numpy().view(np.uint64).copy()
            langs = rb.column("lang").dictionary_encode()
            code = langs.indices.to_numpy(zero_copy_only=False)
            for k, lang in enumerate(langs.dictionary.to_pylist()):
                h[code == k] = _tagged(h[code == k], lang)
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64))], ["h"])

    often = common.stage_table(words.select("lang", "h").mapInArrow(tags, "h long"), "often")
    often_words = context.broadcast(Bloom(often, often.count()))
    pairs = common.stage_table(_pair_counts(docs, often_words).where(F.col("a") >= least), "pairs")
    hot_pairs = pairs.where(F.col("a") >= HOT).select("h")
    often_pairs, hot = (context.broadcast(Bloom(d, d.count())) for d in (pairs.select("h"), hot_pairs))
    longer = _grown(_projections(docs, often_pairs, hot), least)
    all_words = F.filter(F.array(*_columns), lambda x: x != 0)
    longer = longer.select("lang", all_words.alias("p"), "a")
    phrases = words.select("lang", F.array("h").alias("p"), "a").unionByName(longer).withColumn("k", F.size("p"))
    phrases = common.stage_table(phrases, "phrases")
    for b in (often_words, often_pairs, hot):
        b.unpersist()
    return sizes, words.select("lang", "word", "h"), phrases


def collocations(df: DataFrame, least: int = 100, top: int = 2000, percent: int = 100, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """Per language its first ``top`` phrases of 2 to 5 words: lang, rank, phrase, a, l, r, n, score.

    The score of a phrase is the least over its cuts of floor(1000 a n / (l r)). A phrase within a longer one with at
    least ``percent`` of its occurrences goes; as counts fall with length, longer ones of one more word suffice.
    """
    sizes, words, phrases = frequent_phrases(df, least, lang_col, text_col)
    of = lambda name, side: phrases.select("lang", F.col("p").alias(side), F.col("a").alias(name))
    longer = phrases.where("k > 2")
    within = longer.select("lang", "a", F.explode(F.array(F.expr("slice(p, 1, k - 1)"), F.expr("slice(p, 2, k - 1)"))).alias("p")).groupBy("lang", "p").agg(F.max("a").alias("outer"))
    kept = phrases.where("k > 1").join(within, ["lang", "p"], "left").where(F.col("outer").isNull() | (100 * F.col("outer") < percent * F.col("a")))
    cuts = kept.select("lang", "p", "k", "a", F.explode(F.expr("sequence(1, k - 1)")).alias("j"))
    cuts = cuts.withColumns({"left": F.expr("slice(p, 1, j)"), "right": F.expr("slice(p, j + 1, k - j)")})
    cuts = cuts.join(of("l", "left"), ["lang", "left"]).join(of("r", "right"), ["lang", "right"]).join(sizes, "lang")
    cut = cuts.withColumn("score", F.expr(SCORE)).groupBy("lang", "p").agg(F.min(F.struct("score", "j", "l", "r", "a", "n")).alias("c"))
    scored = cut.select("lang", "p", "c.a", "c.l", "c.r", "c.n", "c.score")
    # Ties at the end are told apart by their texts, so all of them stay until those are known.
    first = scored.withColumn("at", F.rank().over(W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a")))).where(F.col("at") <= top)
    spelt = first.select("*", F.posexplode("p").alias("i", "h")).join(words, ["lang", "h"])
    spelt = spelt.groupBy("lang", "p", "a", "l", "r", "n", "score").agg(F.sort_array(F.collect_list(F.struct("i", "word"))).alias("words"))
    spelt = spelt.withColumn("phrase", F.concat_ws(" ", F.col("words.word")))
    rank = F.row_number().over(W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")).cast("long")
    return spelt.withColumn("rank", rank).where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(common.documents(spark, sf_dir), 100, 2000, 100)


OP12_SQL = r"""
with docs as (
  select row_number() over () as d, coalesce(lang, 'und') as lang,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t
  from documents),
pieces as (select d, lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) as piece, generate_subscripts(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]'), 1) as s from docs),
words as (
  select d, s, lang, unnest(ws) as w, generate_subscripts(ws, 1) as i
  from (select d, s, lang, regexp_extract_all(piece, '[^\x20\x09]+') as ws from pieces)),
n as (select lang, count(*) as n from words group by lang),
often as (select lang, w from words group by lang, w having count(*) >= 100),
near as (
  select lang, w as w1, lead(w, 1) over o as w2, lead(w, 2) over o as w3, lead(w, 3) over o as w4, lead(w, 4) over o as w5
  from words window o as (partition by d, s order by i)),
kept as (select near.* from near join often on near.lang = often.lang and near.w1 = often.w),
f as (
  select lang, 1 as k, w1 as p, count(*) as a from kept group by all having count(*) >= 100
  union all select lang, 2, w1 || ' ' || w2, count(*) from kept where w2 is not null group by all having count(*) >= 100
  union all select lang, 3, w1 || ' ' || w2 || ' ' || w3, count(*) from kept where w3 is not null group by all having count(*) >= 100
  union all select lang, 4, w1 || ' ' || w2 || ' ' || w3 || ' ' || w4, count(*) from kept where w4 is not null group by all having count(*) >= 100
  union all select lang, 5, w1 || ' ' || w2 || ' ' || w3 || ' ' || w4 || ' ' || w5, count(*) from kept where w5 is not null group by all having count(*) >= 100),
g as (select lang, k, p, a, string_split(p, ' ') as ws from f),
parts as (
  select lang, a as longer, array_to_string(ws[x:y], ' ') as p
  from g, range(1, 6) as t1(x), range(1, 6) as t2(y)
  where x <= k and y <= k and x < y and y - x + 1 < k),
within as (select lang, p, max(longer) as longer from parts group by lang, p),
cand as (select g.* from g left join within using (lang, p) where k >= 2 and (longer is null or 100 * longer < 100 * a)),
cuts as (
  select c.lang, c.p, c.a, j, l.a as l, r.a as r, n.n, ((1000 * c.a::hugeint * n.n) // (l.a::hugeint * r.a))::bigint as score
  from cand c, range(1, 5) as t(j), f l, f r, n
  where j < c.k and l.lang = c.lang and l.p = array_to_string(c.ws[1:j], ' ')
    and r.lang = c.lang and r.p = array_to_string(c.ws[j + 1:c.k], ' ') and n.lang = c.lang),
least as (select * from cuts qualify row_number() over (partition by lang, p order by score, j) = 1),
ranked as (select lang, row_number() over (partition by lang order by score desc, a desc, p) as rank, p as phrase, a, l, r, n, score from least)
select * from ranked where rank <= 2000
"""
