"""Mixing sources to target weights by a low-discrepancy schedule, in DataFrame functions only.

Sizes are words. Sources in code-point order (null last) weigh 5, 2, 1 and so on; each targets its share of all words,
but no more than three times its own, the excess going to the others by weight. Then:

1. Each source's documents, in an order shuffled by hash, are one line of words, cut into blocks of (within one word)
   equal size; there are about SLOTS blocks in all, so blocks grow with the corpus and the schedule doesn't.
2. Slot k of the schedule has the point frac(k * golden ratio), in integer arithmetic; the cumulative targets (in blocks)
   map it to a source. Points meet sources by an equal join on a bin of the unit interval.
3. Slots are ranked within their source, by counts of chunks of slots and then within a chunk: no source, however hot, is
   ranked or summed in one task. Rank r takes block r modulo the blocks of its source; a fourth pass never begins.
4. Blocks join the pieces of documents in them; what a document's pieces give, times their blocks' slots, is its share.

Null and empty texts have size 0 and are taken 0 times, as is everything if no text has a word. Repeated rows each take
their own place. Null sources are one source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import common

WEIGHTS, PASSES, SLOTS = (5, 2, 1), 3, 1 << 22

#: The golden ratio as a multiplier modulo 2^32, bins of the unit interval, slots ranked together, hex digits of a shuffle bucket.
GOLDEN, BINS, CHUNK, HEX = 2654435769, 4096, 8192, 3


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(common.WORD)), F.lit(0)).cast("long")


def targets(sized: DataFrame) -> DataFrame:
    """A row for each source: source, sid, source_size, weight, target; sized has source and size."""
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = W.orderBy(F.col("source").asc_nulls_last())
    ranked = sums.withColumn("sid", F.row_number().over(order) - 1)
    ranked = ranked.withColumn("weight", F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("sid") % len(WEIGHTS) + 1).cast("int")))
    # By rising cap for its weight, the first that isn't above its share of what is left sets the share of all after it.
    by_cap = W.orderBy(PASSES * F.col("source_size") / F.col("weight"), "sid")
    before = by_cap.rowsBetween(W.unboundedPreceding, -1)
    whole = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    level = (F.sum("source_size").over(whole) - F.coalesce(F.sum(PASSES * F.col("source_size")).over(before), F.lit(0))) / (F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    leveled = ranked.withColumns({"level": level, "place": F.row_number().over(by_cap)})
    fits = PASSES * F.col("source_size") / F.col("weight") >= F.col("level")
    share = F.min_by(F.when(fits, F.col("level")), F.when(fits, F.col("place"))).over(whole)
    return leveled.withColumn("target", F.least((PASSES * F.col("source_size")).cast("double"), F.col("weight") * share)).select("source", "sid", "source_size", "weight", "target")


def schedule(sources: DataFrame) -> DataFrame:
    """(sid, block, times): how often the schedule takes each block; sources as planned() gives them."""
    spark = sources.sparkSession
    k_all = sources.agg(F.sum("slots")).first()[0] or 0
    spans = sources.where("slots > 0").select("sid", "blocks", F.sum("slots").over(W.orderBy("sid")).alias("upto"), "slots").withColumn("start", F.col("upto") - F.col("slots"))
    bin_of = lambda pos: F.expr(f"({pos}) * {BINS} div {max(k_all, 1)}")
    binned = spans.withColumn("bin", F.explode(F.sequence(bin_of("start"), bin_of("upto - 1"))))
    slots = spark.range(k_all).select(F.col("id").alias("k"), F.expr(f"(id * {GOLDEN} % 4294967296) * {k_all} div 4294967296").alias("pos")).withColumn("bin", bin_of("pos"))
    placed = slots.join(binned, (slots.bin == binned.bin) & (slots.pos >= binned.start) & (slots.pos < binned.upto)).select("k", "sid", "blocks", F.expr(f"k div {CHUNK}").alias("chunk"))
    counts = placed.groupBy("sid", "chunk").agg(F.count("*").alias("c"))
    counts = counts.select("sid", "chunk", (F.sum("c").over(W.partitionBy("sid").orderBy("chunk")) - F.col("c")).alias("before"))
    within = F.row_number().over(W.partitionBy("sid", "chunk").orderBy("k")) - 1
    ranked = placed.withColumn("within", within).join(counts, ["sid", "chunk"]).withColumn("rank", F.col("before") + F.col("within"))
    ranked = ranked.where(F.col("rank") < PASSES * F.col("blocks"))
    return ranked.groupBy("sid", (F.col("rank") % F.col("blocks")).alias("block")).agg(F.count("*").alias("times"))


def planned(sources: DataFrame) -> DataFrame:
    """sources with blocks, and the slots that meet the target."""
    total = F.sum("source_size").over(W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    out = sources.withColumn("block_words", F.greatest(F.lit(1).cast("long"), F.floor(total / SLOTS)))
    out = out.withColumn("blocks", F.ceil(F.col("source_size") / F.col("block_words")).cast("long"))
    return out.withColumn("slots", F.when(F.col("source_size") > 0, F.floor(F.col("target") * F.col("blocks") / F.col("source_size") + 0.5)).otherwise(0).cast("long"))


def mix(df: DataFrame, row: list[str], text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The columns ``row`` of each row (the first of them drives the shuffle) and size, source_size, target, taken."""
    sized = common.stage_table(df.select(*row, F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"), F.md5(F.concat(F.lit("mix:"), F.coalesce(F.col(row[0]).cast("string"), F.lit("")))).alias("h")), "sized")
    sources = common.stage_table(planned(targets(sized)).coalesce(1), "sources")
    docs = sized.join(sources.select("source", "sid", "source_size", "target", "blocks"), sized.source.eqNullSafe(sources.source)).drop("source")
    # Places on the source's line: sums by bucket of the shuffle, then within a bucket.
    docs = docs.withColumn("bucket", F.substring("h", 1, HEX))
    sums = docs.groupBy("sid", "bucket").agg(F.sum("size").alias("s"))
    sums = sums.select("sid", "bucket", (F.sum("s").over(W.partitionBy("sid").orderBy("bucket")) - F.col("s")).alias("before"))
    inside = F.sum("size").over(W.partitionBy("sid", "bucket").orderBy("h", row[0], "size", *row[1:]).rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("size")
    lined = docs.withColumn("inside", inside).join(sums, ["sid", "bucket"]).withColumn("start", F.col("before") + F.col("inside"))
    # Blocks: the first (source_size modulo blocks) have a word more than the others.
    lined = lined.withColumns({"base": F.expr("if(blocks > 0, source_size div blocks, 1)"), "extra": F.expr("if(blocks > 0, source_size % blocks, 0)")})
    block_of = lambda t: f"if({t} < extra * (base + 1), ({t}) div (base + 1), extra + ({t} - extra * (base + 1)) div base)"
    lined = common.stage_table(lined.select(*row, "sid", "size", "source_size", "target", "start", "base", "extra"), "lined")
    pieces = lined.where("size > 0").withColumn("block", F.explode(F.expr(f"sequence({block_of('start')}, {block_of('start + size - 1')})")))
    at = "block * base + least(block, extra)"
    words = F.expr(f"least(start + size, {at} + base + if(block < extra, 1, 0)) - greatest(start, {at})")
    # Both sides grow with the corpus; the planner takes the pieces for as small as the rows that they come from.
    given = pieces.select("sid", "block", "start", words.alias("words")).hint("merge").join(schedule(sources).hint("merge"), ["sid", "block"])
    given = given.groupBy("sid", "start").agg(F.sum(F.col("words") * F.col("times")).alias("taken"))
    out = lined.where("size > 0").join(given, ["sid", "start"], "left").withColumn("taken", F.coalesce("taken", F.lit(0).cast("long")))
    none = lined.where("size = 0").withColumn("taken", F.lit(0).cast("long"))
    columns = [*row, "size", "source_size", "target", "taken"]
    return out.select(*columns).unionByName(none.select(*columns))


def mixed_documents(docs: DataFrame) -> DataFrame:
    """docs with each row as often as the mix takes it, to the nearest whole number; rows taken less than half go."""
    from .substrings import located

    rows = located(docs).withColumn("__row", F.xxhash64("batch", *[F.col(c) for c in docs.columns]))
    taken = mix(rows, ["__row"]).where("size > 0").groupBy("__row").agg(F.max(F.floor(F.col("taken") / F.col("size") + 0.5)).alias("copies")).where("copies > 0")
    return rows.join(taken, "__row").withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select(*docs.columns)


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(common.documents(spark, sf_dir), ["doc_id"])


OP5_SQL = rf"""
with sized as (
    select doc_id, source, cast(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) as bigint) as size,
           md5('mix:' || coalesce(cast(doc_id as varchar), '')) as h
    from documents),
sums as (select source, cast(sum(size) as bigint) as source_size from sized group by source),
ranked as (select *, row_number() over (order by source nulls last) - 1 as sid from sums),
weighed as (select *, [5, 2, 1][sid % 3 + 1] as weight, 3 * source_size as cap from ranked),
leveled as (
    select *, cast(cap as double) / weight as ratio,
           row_number() over (order by cast(cap as double) / weight, sid) as place,
           cast(sum(source_size) over () - coalesce(sum(cap) over (order by cast(cap as double) / weight, sid rows between unbounded preceding and 1 preceding), 0) as double)
           / cast(sum(weight) over () - coalesce(sum(weight) over (order by cast(cap as double) / weight, sid rows between unbounded preceding and 1 preceding), 0) as double) as level
    from weighed),
share as (select level from leveled where ratio >= level order by place limit 1),
planned as (
    select source, sid, source_size, least(cast(cap as double), weight * share.level) as target,
           greatest(1, cast(floor(sum(source_size) over () / {SLOTS}) as bigint)) as block_words
    from leveled left join share on true),
blocked as (select *, cast(ceil(cast(source_size as double) / block_words) as bigint) as blocks from planned),
slotted as (select *, case when source_size > 0 then cast(floor(target * blocks / source_size + 0.5) as bigint) else 0 end as slots from blocked),
spans as (select *, sum(slots) over (order by sid) as upto from slotted),
total as (select cast(sum(slots) as bigint) as n from slotted),
slots as (select r.k, cast(((r.k * {GOLDEN} % 4294967296) * n) // 4294967296 as bigint) as pos from total, lateral (select unnest(range(n)) as k) r),
placed as (select k, sid, blocks from slots asof join (select sid, blocks, cast(upto - slots as bigint) as start from spans where slots > 0) s on slots.pos >= s.start),
taken_blocks as (
    select sid, rank % blocks as block, count(*) as times
    from (select *, row_number() over (partition by sid order by k) - 1 as rank from placed)
    where rank < {PASSES} * blocks group by all),
lined as (
    select d.doc_id, d.size, s.sid, s.source_size, s.target, s.blocks,
           cast(sum(d.size) over (partition by s.sid order by d.h, d.doc_id, d.size rows between unbounded preceding and current row) - d.size as bigint) as start,
           row_number() over () as uid
    from sized d join slotted s on d.source is not distinct from s.source),
edges as (
    select *, case when blocks > 0 then source_size // blocks else 1 end as base, case when blocks > 0 then source_size % blocks else 0 end as extra from lined),
pieces as (
    select uid, sid, size, start, base, extra, unnest(range(
        case when start < extra * (base + 1) then start // (base + 1) else extra + (start - extra * (base + 1)) // base end,
        1 + case when start + size - 1 < extra * (base + 1) then (start + size - 1) // (base + 1) else extra + (start + size - 1 - extra * (base + 1)) // base end)) as block
    from edges where size > 0),
given as (
    select uid, sum((least(start + size, block * base + least(block, extra) + base + case when block < extra then 1 else 0 end)
                     - greatest(start, block * base + least(block, extra))) * times) as taken
    from pieces join taken_blocks using (sid, block) group by uid)
select doc_id, size, source_size, coalesce(target, 0.0) as target, cast(coalesce(taken, 0) as bigint) as taken
from edges left join given using (uid)
"""
