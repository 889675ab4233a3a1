"""Product codes of vectors by Lloyd rounds whose sums are kept up by differences.

Vectors become integers and are cut into parts; each part position has a codebook of up to ENTRIES entries. The vectors
lie in a table bucketed by row; each round's assignments are a narrow table bucketed the same way, so a round joins both
without a shuffle. A part whose entry changed adds its components to the new entry and takes them from the old one: a
task sums these contributions and only their sums, at most a row for each (part, entry), are shuffled. The running
integer sums (parts x entries x components, a fixed size) are on the driver, which replaces the codebooks by floors of
sum / count. Everything is exact: distances in float64 where all squares fit into 53 bits, else in int64.

Dropped: null vectors and those with null, infinite or not-a-number components. A vector whose length isn't that of the
first one kept, or with components too large for squares in 64 bits, or any if that length isn't a positive multiple of
the parts, has a null code and error and trains nothing. Order is by vec_id, nulls last, then by components; repeated
rows each count; without vectors the result is empty. Further columns are not read.
"""

from __future__ import annotations

import hashlib
import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

ENTRIES, PARTS, ROUNDS, SCALE = 256, 4, 4, 1024
#: Bytes of vectors in a bucket, about; at least as many buckets as shuffle partitions.
BUCKET_BYTES = 64 << 20


class Codebooks:
    """Integer codebooks (parts x entries x components), with running sums and counts of their parts."""

    def __init__(self, first: np.ndarray, parts: int):
        """first: the vectors that the entries start as."""
        rows, dim = first.shape
        self.entries = first.reshape(rows, parts, dim // parts).transpose(1, 0, 2).copy()
        self.sums = np.zeros_like(self.entries)
        self.counts = np.zeros(self.entries.shape[:2], np.int64)

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(entry of each part, ties to the lower; squared distance): both rows x parts."""
        parts, _, width = self.entries.shape
        code, far = (np.zeros((len(vectors), parts), np.int64) for _ in range(2))
        most = max((int(np.abs(v).max()) for v in (vectors, self.entries) if v.size), default=0)
        exact = np.float64 if width * (2 * most) ** 2 < 1 << 53 else np.int64
        for p in range(parts):
            x = vectors[:, p * width : (p + 1) * width].astype(exact)
            c = self.entries[p].astype(exact)
            for at in range(0, len(x), 4096):
                some = x[at : at + 4096]
                # |x|^2 is the same for all entries, so it is added to the least only.
                d = (c * c).sum(axis=1)[None, :] - 2 * (some @ c.T)
                code[at : at + 4096, p] = d.argmin(axis=1)
                far[at : at + 4096, p] = (d.min(axis=1) + (some * some).sum(axis=1)).astype(np.int64)
        return code, far

    def update(self, part: np.ndarray, entry: np.ndarray, count: np.ndarray, sums: np.ndarray) -> None:
        """Take over differences of counts and sums, then set the entries that have parts to the floor of their mean."""
        self.counts[part, entry] += count
        self.sums[part, entry] += sums
        used = self.counts > 0
        self.entries[used] = self.sums[used] // self.counts[used][:, None]

    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def integer_vectors(df: DataFrame, id_col: str, vector_col: str, label_col: str, scale: int = SCALE) -> DataFrame:
    """(vec_id, label, v): kept rows with integer components floor(scale x); v is null where one doesn't fit in 64 bits."""
    x = F.col(vector_col)
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(math.inf)))
    whole = F.transform(x, lambda c: F.floor(F.lit(float(scale)) * c.cast("double")))
    fits = F.forall(x, lambda c: F.abs(c.cast("double")) < F.lit(2.0**62 / scale))
    return df.where(x.isNotNull() & finite).select(F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), F.when(fits, whole).alias("v"))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(-1, dim)


class _Tables:
    """Tables bucketed by row number, in the shared folder; ``drop`` forgets and deletes one."""

    def __init__(self, spark: SparkSession, buckets: int):
        self.spark, self.buckets, self.at = spark, buckets, {}

    def write(self, df: DataFrame, tag: str) -> str:
        name = f"fw_{tag}_{uuid.uuid4().hex}"
        self.at[name] = path = f"{common.shared_dir(self.spark)}/fw-{tag}-{uuid.uuid4().hex}"
        df.write.bucketBy(self.buckets, "row").option("path", path).saveAsTable(name, format="parquet")
        return name

    def drop(self, name: str) -> None:
        self.spark.sql(f"drop table if exists {name}")
        jvm, context = self.spark.sparkContext._jvm, self.spark.sparkContext
        at = jvm.org.apache.hadoop.fs.Path(self.at.pop(name))
        at.getFileSystem(context._jsc.hadoopConfiguration()).delete(at, True)


def _round(vectors: DataFrame, before: DataFrame | None, books: Codebooks) -> DataFrame:
    """(row, code) of every vector and, with part set, differences (part, entry, count, sums) of a task's changed parts."""
    parts, entries, width = books.entries.shape
    first = before is None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros((parts, entries), np.int64)
        sums = np.zeros((parts, entries, width), np.int64)
        touched = np.zeros((parts, entries), bool)
        some_row = None
        for rb in batches:
            if not rb.num_rows:
                continue
            some_row = rb.column("row")[0].as_py()
            v = _matrix(rb.column("v"), parts * width)
            code, _ = books.nearest(v)
            was = None
            if not first:
                was = np.frombuffer(b"".join(rb.column("was").to_pylist()), "<u4").reshape(-1, parts).astype(np.int64)
            for p in range(parts):
                changed = np.arange(len(v)) if was is None else np.flatnonzero(code[:, p] != was[:, p])
                x = v[changed, p * width : (p + 1) * width]
                for sign, at in ((1, code[changed, p]), *(() if was is None else ((-1, was[changed, p]),))):
                    np.add.at(count[p], at, sign)
                    np.add.at(sums[p], at, sign * x)
                    touched[p, at] = True
            codes = code.astype("<u4").view(np.uint8).reshape(len(v), -1)
            none = lambda kind: pa.nulls(len(v), kind)
            yield pa.RecordBatch.from_arrays([rb.column("row"), pa.array([c.tobytes() for c in codes], pa.binary()), none(pa.int32()), none(pa.int32()), none(pa.int64()), none(pa.list_(pa.int64()))], names)
        p, e = np.nonzero(touched)
        if len(p):
            columns = [pa.array([some_row] * len(p), pa.int64()), pa.nulls(len(p), pa.binary()), pa.array(p, pa.int32()), pa.array(e, pa.int32()), pa.array(count[p, e]), pa.array(list(sums[p, e]), pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names)

    names = ["row", "code", "part", "entry", "count", "sums"]
    joined = vectors if before is None else vectors.join(before.where("code is not null").select("row", F.col("code").alias("was")).hint("shuffle_hash"), "row")
    return joined.mapInArrow(run, "row long, code binary, part int, entry int, count long, sums array<long>")


def _differences(assigned: DataFrame, width: int) -> pa.Table:
    """The sums over all tasks: at most a row for each (part, entry)."""
    sums = [F.sum(F.get("sums", F.lit(i))).alias(f"s{i}") for i in range(width)]
    found = assigned.where("part is not null").groupBy("part", "entry").agg(F.sum("count").alias("count"), *sums)
    return found.select("part", "entry", "count", F.array(*[f"s{i}" for i in range(width)]).alias("sums")).toArrow()


def train(vectors: DataFrame, first: np.ndarray, parts: int, rounds: int, buckets: int) -> Codebooks:
    """Codebooks after Lloyd rounds from the first vectors; vectors: row, v, all of one length."""
    books = Codebooks(first, parts)
    tables = _Tables(vectors.sparkSession, buckets)
    spark, width = vectors.sparkSession, books.entries.shape[2]
    dealt = tables.write(vectors.repartition(buckets, "row"), "vectors")
    before = None
    for _ in range(rounds):
        now = tables.write(_round(spark.table(dealt), spark.table(before) if before else None, books), "codes")
        d = _differences(spark.table(now), width)
        if d.num_rows:
            part, entry, count = (d.column(c).to_numpy() for c in ("part", "entry", "count"))
            books.update(part, entry, count, _matrix(d.column("sums").combine_chunks(), width))
        if before:
            tables.drop(before)
        before = now
    for name in list(tables.at):
        tables.drop(name)
    return books


def product_codes(df: DataFrame, entries: int = ENTRIES, parts: int = PARTS, rounds: int = ROUNDS, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> tuple[DataFrame, Codebooks | None]:
    """(vec_id, label, code: entry of each part, error: squared distance) of each kept row, and the codebooks."""
    spark = df.sparkSession
    number = F.monotonically_increasing_id().alias("row")
    kept = common.stage_table(integer_vectors(df, id_col, vector_col, label_col).select(number, "vec_id", "label", "v"), "vectors")
    least = [F.asc_nulls_last("vec_id"), F.asc_nulls_last("v")]
    head = kept.orderBy(*least).limit(1).collect()
    dim = len(head[0].v or ()) if head else 0
    # Sums of squares over all parts of a vector stay in 64 bits.
    bound = math.isqrt((1 << 62) // dim) // 2 if dim else 0
    coded: Column = F.lit(False)
    if dim and dim % parts == 0:
        coded = F.coalesce((F.size("v") == dim) & F.forall("v", lambda c: F.abs(c) < bound), F.lit(False))
    good = kept.where(coded)
    first = good.orderBy(*least).limit(entries).select("v").toArrow().column("v").combine_chunks()
    if not len(first):
        out = kept.select("vec_id", "label", F.lit(None).cast("array<int>").alias("code"), F.lit(None).cast("long").alias("error"))
        return out, None
    n = good.count()
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), n * dim * 8 // BUCKET_BYTES)
    books = train(good.select("row", "v"), _matrix(first, dim), parts, rounds, buckets)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            entry, far = books.nearest(_matrix(rb.column("v"), dim))
            yield pa.RecordBatch.from_arrays([rb.column("vec_id"), rb.column("label"), pa.array(list(entry.astype(np.int32)), pa.list_(pa.int32())), pa.array(far.sum(axis=1))], ["vec_id", "label", "code", "error"])

    types = dict(kept.dtypes)
    out = good.select("vec_id", "label", "v").mapInArrow(code, f"vec_id {types['vec_id']}, label {types['label']}, code array<int>, error long")
    rest = kept.where(~coded).select("vec_id", "label", F.lit(None).cast("array<int>").alias("code"), F.lit(None).cast("long").alias("error"))
    return out.unionByName(rest), books


def op11_product_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = product_codes(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    coded = common.stage_table(coded, "coded")
    errors = coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    digits = F.concat_ws("", F.transform("code", lambda c: F.lower(F.lpad(F.hex(c), 2, "0"))))
    out = coded.join(errors, F.col("label").eqNullSafe(F.col("of")))
    return out.select("vec_id", F.when(F.col("code").isNotNull(), digits).alias("code"), "error", "label_error", F.lit(books.sha256() if books else hashlib.sha256(b"").hexdigest()).alias("codebooks_sha256"))


def _lloyd_sql(rounds: int = ROUNDS, parts: int = PARTS, entries: int = ENTRIES) -> str:
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""
far{r} as materialized (
  select v.vec_id, v.part, b.entry, list_sum(list_transform(list_zip(v.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::bigint as d
  from parts v join book{r} b on v.part = b.part),
near{r} as materialized (select vec_id, part, min(d) as d, arg_min(entry, (d, entry)) as entry from far{r} group by vec_id, part),""")
        if r < rounds:
            steps.append(f"""
mean{r} as (
  select part, entry, list(m order by i) as x from (
    select n.part, n.entry, i, floor_div(sum(v.x[i])::bigint, count(*)) as m
    from near{r} n join parts v on v.vec_id = n.vec_id and v.part = n.part, generate_series(1, (select max(len(x)) from parts)) as g(i)
    group by n.part, n.entry, i) group by part, entry),
book{r + 1} as materialized (select b.part, b.entry, coalesce(m.x, b.x) as x from book{r} b left join mean{r} m on m.part = b.part and m.entry = b.entry),""")
    text = "".join(steps)
    text = text.replace("floor_div(sum(v.x[i])::bigint, count(*))", "(sum(v.x[i])::bigint - ((sum(v.x[i])::bigint % count(*)) + count(*)) % count(*)) // count(*)")
    return f"""
with kept as (
  select vec_id, label, list_transform(embedding, lambda c: floor(1024 * c::double)::bigint) as v
  from embeddings where embedding is not null and len(list_filter(embedding, lambda c: c is null or not isfinite(c))) = 0),
parts as materialized (
  select vec_id, label, part, v[part * (len(v) // {parts}) + 1:(part + 1) * (len(v) // {parts})] as x from kept, range(0, {parts}) as t(part)),
book0 as materialized (
  select part, x, row_number() over (partition by part order by vec_id) - 1 as entry from parts
  qualify row_number() over (partition by part order by vec_id) <= {entries}),{text}
coded as (select vec_id, string_agg(lower(lpad(to_hex(entry), 2, '0')), '' order by part) as code, sum(d)::bigint as error from near{rounds} group by vec_id),
labelled as (select c.*, k.label from coded c join kept k using (vec_id)),
digest as (select sha256(string_agg(array_to_string(x, ','), ',' order by part, entry)) as codebooks_sha256 from book{rounds})
select vec_id, code, error, (sum(error) over (partition by label))::bigint as label_error, codebooks_sha256 from labelled, digest
"""


OP11_SQL = _lloyd_sql()
