"""Connected components by least labels and pointer jumping, all in DataFrames; a hub's edges meet in partial aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage_table


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label): the least node of its component, for every node with an edge. Repeated edges and loops do no harm."""
    both = edges.select(F.col(a).alias("u"), F.col(b).alias("v"))
    both = stage_table(both.unionByName(both.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), "edges")
    labels = stage_table(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("label")).withColumnRenamed("u", "node"), "labels")
    while True:
        heard = both.join(labels, both.v == labels.node).groupBy("u").agg(F.min("label").alias("heard"))
        new = labels.join(heard, labels.node == heard.u).select("node", F.col("label").alias("was"), F.least("label", "heard").alias("via"))
        # Jump: a label is a node too, and takes over what that node has.
        at = labels.select(F.col("node").alias("via"), F.col("label").alias("of_via"))
        new = stage_table(new.join(at, "via", "left").select("node", "was", F.least("via", "of_via").alias("label")), "labels")
        labels = new.select("node", "label")
        if not new.where("label <> was").limit(1).count():
            return labels
