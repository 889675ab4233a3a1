"""A training-corpus pipeline of five stages over the documents table.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept and returns the columns of documents; the
last returns the token digests. Between stages the rows are written as Parquet and read again.

Nulls, empty and very long texts, ties, repeated rows, empty tables and further columns: as the operators say. A rule of
the near-duplicate stage is its own: of rows that are wholly equal, one stays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framewright.llm import bpe, common, jaccard, mixing, pii, quality


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    judged = quality.quality_rules(docs, labels).withColumn("kept", F.col("kept") & (F.monotonically_increasing_id() >= 0))
    # The filter must not be pushed below what it judges by, where each use of the n-grams would make them again.
    return judged.where("kept").select(*docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the least doc_id, of each group linked at 0.8 of five-word shingles."""
    groups = jaccard.jaccard_groups(docs, 5, 80)
    heads = groups.where("doc_id <=> component_id").select("doc_id").distinct()
    kept = docs.join(heads, docs.doc_id.eqNullSafe(heads.doc_id), "left_semi")
    twice = docs.groupBy("doc_id").count().where("count > 1").limit(1).count()
    return kept.dropDuplicates() if twice else kept


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in texts become [KIND]; n_chars follows the text."""
    out = pii.redact_column(docs)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, to the nearest whole number."""
    return mixing.mixed_documents(docs)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of each document's tokens and of what they decode to."""
    import public_tokenizers as P

    return bpe.bpe_round_trip(docs, P.path("byte_bpe_50k.tiktoken"), P.PATTERN)


STAGES = [
    ("quality_rules", quality_stage),
    ("ngram_jaccard_join", near_duplicate_stage),
    ("pii", pii_stage),
    ("source_mixing", mixing_stage),
    ("byte_level_bpe", bpe_stage),
]

#: The model of the quality rules and the tokenizer are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir)
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = common.stage_table(docs, name)
    return docs
