"""Incremental ingestion: new rows only, a ledger, sessions with late data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def ingest_new(spark: SparkSession, source: str, schema, target: str, checkpoint: str, transform=None) -> None:
    """Files of source that haven't been taken yet go to target, once each; the checkpoint is the ledger."""
    stream = spark.readStream.schema(schema).parquet(source)
    out = transform(stream) if transform else stream
    out.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def session_stats(stream: DataFrame, key: str, ts: str, value: str, gap: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    """key, start, end, n, mean of sessions that a gap ends; rows later than the watermark don't count."""
    s = stream.withWatermark(ts, late).groupBy(key, F.session_window(ts, gap).alias("w")).agg(F.count("*").alias("n"), F.avg(value).alias("mean"))
    return s.select(key, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n", "mean")


def tumbling_counts(stream: DataFrame, ts: str, width: str, *keys: str | Column, late: str = "10 minutes") -> DataFrame:
    w = stream.withWatermark(ts, late).groupBy(F.window(ts, width).alias("w"), *keys).agg(F.count("*").alias("n"))
    return w.select(F.col("w.start").alias("start"), *keys, "n")
