"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import hot_keys, salted_join, written


def components(edges: DataFrame) -> DataFrame:
    """node, component (the smallest node reachable) of edges(a, b).

    Smallest labels spread over the edges, and each label is replaced by its own label, so chains shrink by half in a pass.
    Hubs are split in joins and pre-aggregated before the shuffle; each pass is written, so lineage stays short.
    """
    both = written(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).filter("a <> b").distinct(), "cc-edges")
    labels = written(both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("label")), "cc-labels")
    hubs = hot_keys(both, ["b"])
    while True:
        known = labels.withColumnRenamed("node", "b")
        heard = (salted_join(both, known, ["b"], ["a"], hot=hubs) if hubs else both.join(known, "b")).groupBy("a").agg(F.min("label").alias("heard")).withColumnRenamed("a", "node")
        nearer = labels.join(heard, "node").select("node", F.col("label").alias("old"), F.least("label", "heard").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("further"))
        new = written(salted_join(nearer, jump, ["label"], ["node"], "left", counted=labels).select("node", "old", F.least("label", F.coalesce("further", "label")).alias("label")), "cc-labels")
        if not new.filter("old <> label").limit(1).count():
            return new.select("node", F.col("label").alias("component"))
        labels = new.select("node", "label")
