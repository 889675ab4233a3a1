"""SimHash near-duplicates: fingerprints of 4-word shingles, joined with themselves through binary tries.

A fingerprint is 64 majority bits of the XXH64 of all shingles. Distinct fingerprints form two tries, one read from the
first bit and one from bit 32 on (the halves swapped): of two fingerprints with at most e differing bits, one half has
at most e // 2, so each trie may stop at that budget within its leading half and at e in all. Pairs of nodes go down
together and are dropped as soon as the bits in which they differ pass the budget. The upper nodes are rows of a table:
a node with more than LEAF fingerprints has children, others are blocks, and pairs of blocks are found by joins, level by
level. Below, each pair of blocks is a row, and the descent goes on bit by bit in numpy, a bounded number of node pairs
at a time.

Only components are asked for. A pair of blocks returns a spanning forest of its links, so a dense group costs a link
for each member, not for each pair; node pairs that already lie in one component are not entered again. Nothing is
capped or sampled. Equal fingerprints are one entry, however many documents have them.

Null and empty texts and texts without words have fingerprint zero, which links like any other. Fewer words than a
shingle are one shingle. Null ids stay; a component's id is the least that isn't null. Repeated rows each give a row, an
empty table an empty result, and further columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from .components import components

SEED = 42
#: Fingerprints in a block of a trie at most.
LEAF = 1 << 14
#: Bits between levels of the upper part.
STEP = 2
#: Node pairs that are split at once.
FRONTIER = 1 << 18
#: Leaves are compared directly where two nodes hold so many pairs at most.
DIRECT = 16
#: Bytes of a text whose words are held at once.
CHUNK = 4 << 20

_space = re.compile(rb"[\x20\x09-\x0D]")
_bits = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
_place = (np.arange(8) * 256)[None, :]


def _shingle_hashes(text: bytes, n: int) -> Iterator[np.ndarray]:
    """XXH64 of every shingle of a text, some at a time."""
    at, held, some = 0, [], False
    digest = xxhash.xxh64_intdigest
    while at < len(text):
        cut = _space.search(text, at + CHUNK) if len(text) - at > CHUNK else None
        upto = cut.start() if cut else len(text)
        words = held + text[at:upto].lower().split()
        at = upto
        if len(words) < n:
            held = words
            continue
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(sizes + 1) - 1
        line = b" ".join(words)
        yield np.fromiter((digest(line[s:e], SEED) for s, e in zip((ends - sizes)[: len(words) - n + 1].tolist(), ends[n - 1 :].tolist())), np.uint64, len(words) - n + 1)
        held, some = words[len(words) - n + 1 :], True
    if held and not some:
        yield np.array([digest(b" ".join(held), SEED)], np.uint64)


def simhash(text: bytes, n: int = 4) -> int:
    """The fingerprint of one text, unsigned."""
    total, ones = 0, np.zeros((8, 256), np.int64)
    for hashes in _shingle_hashes(text, n):
        total += len(hashes)
        ones += np.bincount((hashes.astype("<u8").view(np.uint8).reshape(-1, 8) + _place).ravel(), minlength=2048).reshape(8, 256)
    major = (2 * (ones @ _bits) > total).astype(np.uint8).ravel()
    return int(np.packbits(major, bitorder="little").view("<u8")[0]) if total else 0


def fingerprints(df: DataFrame, n: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed long, a row for each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in common.slices(batches, "text"):
            fps = np.fromiter((simhash(t, n) for t in common.utf8(rb)), np.uint64, rb.num_rows)
            yield pa.RecordBatch.from_arrays([rb.column("doc_id"), pa.array(fps.view(np.int64))], ["doc_id", "fp"])

    return common.text_rows(df, id_col, text_col).mapInArrow(run, "doc_id long, fp long")


def _halves_swapped(x: Column) -> Column:
    return F.shiftleft(x, 32).bitwiseOR(F.shiftrightunsigned(x, 32))


def _top(x: Column, depth: Column | int) -> Column:
    """x with all but its first ``depth`` bits cleared."""
    d = F.lit(depth) if isinstance(depth, int) else depth
    return F.when(d > 0, x.bitwiseAND(F.call_function("shiftleft", F.lit(-1).cast("long"), (F.lit(64) - d).cast("int")))).otherwise(F.lit(0).cast("long"))


def _blocks(keys: DataFrame, n: int) -> DataFrame:
    """(trie, depth, node, keys): the tries' nodes with LEAF keys at most; keys: trie, key, of n distinct ones a trie."""
    depth, left, placed = 0, keys, None
    while LEAF // 2 << depth < n and depth < 64:
        depth += STEP
    while True:
        at = left.withColumn("node", _top(F.col("key"), depth))
        here = at.withColumn("depth", F.lit(depth))
        big = common.stage_table(at.groupBy("trie", "node").count().where(F.col("count") > LEAF).select("trie", "node"), "big") if depth < 64 else None
        last = big is None or not big.limit(1).count()
        here = here if last else here.join(big, ["trie", "node"], "left_anti")
        here = here.select("trie", "depth", "node", "key")
        placed = here if placed is None else placed.unionByName(here)
        if last:
            return placed.groupBy("trie", "depth", "node").agg(F.sort_array(F.collect_list("key")).alias("keys"))
        left = common.stage_table(at.join(big, ["trie", "node"], "left_semi").drop("node"), "keys")
        depth += STEP


def _block_pairs(blocks: DataFrame, budget: int) -> DataFrame:
    """(trie, a, da, b, db): the pairs of blocks, once each and with themselves, that the budget allows."""
    leaves = blocks.select("trie", "depth", "node", F.lit(True).alias("leaf"))
    above = leaves.where("depth > 0").withColumn("depth", F.explode(F.sequence(F.lit(0), F.col("depth") - STEP, F.lit(STEP))))
    above = above.select("trie", "depth", _top(F.col("node"), F.col("depth")).alias("node"), F.lit(False).alias("leaf")).distinct()
    nodes = common.stage_table(leaves.unionByName(above), "nodes")
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    root = nodes.where("depth = 0")
    pairs = root.select("trie", *[F.col(c).alias(f"{c}{s}") for s in "ab" for c in ("node", "depth", "leaf")])
    done = pairs.where("leafa and leafb")
    for depth in range(STEP, deepest + 1, STEP):
        kids = nodes.where(F.col("depth") == depth).withColumn("parent", _top(F.col("node"), depth - STEP))
        pairs = pairs.where("not (leafa and leafb)").withColumn("same", F.col("nodea") == F.col("nodeb"))
        for s in "ab":
            k = kids.select(F.col("trie").alias("kt"), F.col("parent").alias("kp"), F.col("node").alias("kn"), F.col("leaf").alias("kl"))
            pairs = pairs.join(k, (F.col("trie") == F.col("kt")) & (F.col(f"node{s}") == F.col("kp")) & ~F.col(f"leaf{s}"), "left")
            pairs = pairs.withColumns({f"node{s}": F.coalesce("kn", f"node{s}"), f"depth{s}": F.when(F.col("kn").isNotNull(), F.lit(depth)).otherwise(F.col(f"depth{s}")), f"leaf{s}": F.coalesce("kl", f"leaf{s}")}).drop("kt", "kp", "kn", "kl")
        differ = _top(F.col("nodea").bitwiseXOR(F.col("nodeb")), F.least("deptha", "depthb"))
        allowed = (F.bit_count(differ) <= budget) & (F.bit_count(_top(differ, 32)) <= budget // 2)
        pairs = common.stage_table(pairs.where(allowed & (~F.col("same") | (F.col("nodea") <= F.col("nodeb")))).drop("same"), "pairs")
        done = done.unionByName(pairs.where("leafa and leafb"))
    return done.select("trie", F.col("nodea").alias("a"), F.col("deptha").alias("da"), F.col("nodeb").alias("b"), F.col("depthb").alias("db"))


class _Forest:
    """Components of the keys of a pair of blocks so far; ``run`` numbers stretches of equal labels, so that a node's keys lie in one component if its ends do."""

    def __init__(self, n: int):
        self.label = np.arange(n)
        self.run = np.arange(n)

    def link(self, x: np.ndarray, y: np.ndarray) -> None:
        label = self.label
        while True:
            p, q = label[x], label[y]
            apart = p != q
            if not apart.any():
                break
            x, y, p, q = x[apart], y[apart], p[apart], q[apart]
            np.minimum.at(label, np.maximum(p, q), np.minimum(p, q))
            while True:
                up = label[label]
                if (up == label).all():
                    break
                label[:] = up
        self.run = np.cumsum(np.concatenate([[0], label[1:] != label[:-1]]))

    def joined(self, alo, ahi, blo, bhi) -> np.ndarray:
        r, label = self.run, self.label
        return (r[alo] == r[ahi - 1]) & (r[blo] == r[bhi - 1]) & (label[alo] == label[blo])


def _expand(lo: np.ndarray, hi: np.ndarray, blo: np.ndarray, bhi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of places from [lo, hi) and [blo, bhi) of each row."""
    wide = bhi - blo
    size = (hi - lo) * wide
    of = np.repeat(np.arange(len(lo)), size)
    k = np.arange(len(of)) - np.repeat(np.cumsum(size) - size, size)
    return lo[of] + k // wide[of], blo[of] + k % wide[of]


def _descend(keys: np.ndarray, na: int, same: bool, budget: int, forest: _Forest) -> None:
    """Link in ``forest`` the keys of the first na and the others (or, if same, of all) that differ in budget bits at most.

    keys: uint64, sorted within both parts. Node pairs are ranges of both parts with a common depth; ranges at different
    depths of their trie differ only in bits that are not yet compared.
    """
    n = len(keys)
    second = (0, n) if same else (na, n)
    stack = [(0, np.array([[0], [n if same else na], [second[0]], [second[1]]]), np.zeros(1, np.int64))]
    while stack:
        depth, (alo, ahi, blo, bhi), errors = stack.pop()
        open_ = ~forest.joined(alo, ahi, blo, bhi)
        small = open_ & ((ahi - alo) * (bhi - blo) <= DIRECT) | (depth == 64)
        if small.any():
            x, y = _expand(alo[small], ahi[small], blo[small], bhi[small])
            near = (np.bitwise_count(keys[x] ^ keys[y]) <= budget) & (x != y)
            if near.any():
                forest.link(x[near], y[near])
        go = open_ & ~small
        if not go.any():
            continue
        alo, ahi, blo, bhi, errors = (v[go] for v in (alo, ahi, blo, bhi, errors))
        if len(alo) > FRONTIER:
            for part in np.array_split(np.arange(len(alo)), -(-len(alo) // FRONTIER)):
                stack.append((depth, np.stack([alo, ahi, blo, bhi])[:, part], errors[part]))
            continue
        amid, bmid = (_middle(keys, lo, hi, depth, lo_at, hi_at) for lo, hi, lo_at, hi_at in ((alo, ahi, 0, n if same else na), (blo, bhi, *second)))
        diagonal = (alo == blo) & (ahi == bhi)
        kept = []
        for a0, a1, b0, b1, e in ((alo, amid, blo, bmid, 0), (amid, ahi, bmid, bhi, 0), (alo, amid, bmid, bhi, 1), (amid, ahi, blo, bmid, 1)):
            err = errors + e
            ok = (a0 < a1) & (b0 < b1) & (err <= (budget // 2 if depth < 32 else budget))
            if (a0 is amid) and (b0 is blo):
                ok &= ~diagonal  # the mirror of the pair before
            kept.append((np.stack([a0, a1, b0, b1])[:, ok], err[ok]))
        stack.append((depth + 1, np.concatenate([k[0] for k in kept], axis=1), np.concatenate([k[1] for k in kept])))


def _middle(keys: np.ndarray, lo: np.ndarray, hi: np.ndarray, depth: int, first: int, last: int) -> np.ndarray:
    """Where within each range bit ``depth`` is set first."""
    bit = np.uint64(1 << (63 - depth))
    above = np.uint64((1 << 64) - (1 << (64 - depth))) if depth else np.uint64(0)
    at = first + np.searchsorted(keys[first:last], (keys[lo] & above) | bit)
    return np.minimum(np.maximum(at, lo), hi)


def _links(pairs: DataFrame, blocks: DataFrame, budget: int) -> DataFrame:
    """(a, b): a spanning forest of the links of each pair of blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                trie = batch.column("trie")[i].as_py()
                ka, kb = (np.sort(batch.column(c)[i].values.to_numpy(zero_copy_only=False).view(np.uint64)) for c in ("ka", "kb"))
                same = batch.column("same")[i].as_py()
                keys = ka if same else np.concatenate([ka, kb])
                forest = _Forest(len(keys))
                # Few differing bits first: what is dense is one component before the rest is looked at.
                for upto in sorted({min(1, budget), budget}):
                    _descend(keys, len(ka), same, upto, forest)
                found = np.flatnonzero(forest.label != np.arange(len(keys)))
                x, y = keys[found], keys[forest.label[found]]
                if trie:
                    x, y = ((v << np.uint64(32)) | (v >> np.uint64(32)) for v in (x, y))
                yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)), pa.array(y.view(np.int64))], ["a", "b"])

    a, b = (blocks.select("trie", F.col("node").alias(s), F.col("depth").alias(f"d{s}"), F.col("keys").alias(f"k{s}")) for s in "ab")
    both = pairs.join(a, ["trie", "a", "da"]).join(b, ["trie", "b", "db"])
    shape = both.select("trie", ((F.col("a") == F.col("b")) & (F.col("da") == F.col("db"))).alias("same"), "ka", "kb")
    # The planner counts bytes, but what a pair costs is its descent: deal pairs out evenly.
    return shape.repartition(max(16, int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions")))).mapInArrow(run, "a long, b long")


def near_fingerprints(fps: DataFrame, budget: int) -> DataFrame:
    """(node, label): for each fingerprint with a link, one of its component; fps: (fp), distinct."""
    n = fps.count()
    keys = fps.select(F.explode(F.array(F.struct(F.lit(0).alias("trie"), F.col("fp").alias("key")), F.struct(F.lit(1).alias("trie"), _halves_swapped(F.col("fp")).alias("key")))).alias("k")).select("k.*")
    blocks = common.stage_table(_blocks(keys, n), "blocks", "none")
    pairs = common.stage_table(_block_pairs(blocks, budget), "pairs")
    links = _links(pairs, blocks, budget)
    return components(common.stage_table(links.distinct(), "links"))


def simhash_groups(df: DataFrame, n: int = 4, budget: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, fp (signed long), component_id of the links at ``budget`` differing bits or fewer."""
    prints = common.stage_table(fingerprints(df, n, id_col, text_col), "prints")
    fps = common.stage_table(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "fps")
    labels = near_fingerprints(fps.select("fp"), budget)
    named = fps.join(labels.withColumnRenamed("node", "fp"), "fp", "left").withColumn("label", F.coalesce("label", "fp"))
    named = common.stage_table(named, "named")
    least = named.groupBy("label").agg(F.min("least").alias("component_id"))
    return prints.join(named.join(least, "label").select("fp", "component_id"), "fp").select("doc_id", "fp", "component_id")


def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash_groups(common.documents(spark, sf_dir), 4, 4)
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
