"""Tables written to the folder that the cluster's executors share, to cut lineage and to pin what must not be computed twice."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; only where that is unset and all runs in this process (tests), a local folder."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        if not re.match(r"local(\[|$)", spark.conf.get("spark.master", "local")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        where = "file://" + tempfile.mkdtemp(prefix="framewright-")
        spark.conf.set("spark.checkpoint.dir", where)
    return where.rstrip("/")


def written(df: DataFrame, tag: str = "table") -> DataFrame:
    path = f"{shared_dir(df.sparkSession)}/fw-{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
