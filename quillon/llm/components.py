"""Connected components of a graph of links, without gathering it anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillon.session import materialise

MAX_ROUNDS = 60


def components(links: DataFrame) -> DataFrame:
    """links: (a, b). Returns (node, component): the smallest node that each linked node reaches, itself included.

    Every round gives each node the least label of its neighbours and then the
    label of its label, so that the rounds grow with the logarithm of the
    longest way. Labels are pre-aggregated before they are shuffled; a node with
    very many links is no large group.
    """
    spark = links.sparkSession
    both = links.select(F.col("a").alias("node"), F.col("b").alias("other")).union(links.select("b", "a")).where("node <> other").distinct()
    both = materialise(both)
    labels = materialise(both.groupBy("node").agg(F.least(F.col("node"), F.min("other")).alias("label")))
    for _ in range(MAX_ROUNDS):
        heard = both.join(labels.withColumnsRenamed({"node": "other"}), "other").groupBy("node").agg(F.min("label").alias("heard"))
        near = labels.join(heard, "node").select("node", "label", F.least("label", "heard").alias("least"))
        # The label's own label; and what a node has heard goes to its old label too, which hooks whole trees.
        told = near.where("least < label").select(F.col("label").alias("node"), "least")
        new = near.select("node", "least").union(told).groupBy("node").agg(F.min("least").alias("label"))
        jump = new.select(F.col("node").alias("label"), F.col("label").alias("next"))
        new = new.join(jump, "label", "left").select("node", F.coalesce(F.least("label", "next"), F.col("label")).alias("label"))
        new = materialise(new)
        changed = new.join(labels.withColumnRenamed("label", "old"), "node").where("label <> old").limit(1).count()
        labels = new
        if not changed:
            return labels.withColumnRenamed("label", "component")
    raise RuntimeError(f"links of {spark.sparkContext.appName} need more than {MAX_ROUNDS} rounds")
