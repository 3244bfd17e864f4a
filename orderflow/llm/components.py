"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.session import frozen


def components(edges: DataFrame) -> DataFrame:
    """(``node``, ``label``) of all nodes of ``edges`` (``a``, ``b``); the label is the least node of the component.

    Each round takes the least label of the neighbours and then that label's own label, which halves the way to
    the least node; star-shaped edges settle in two rounds. Both tables are read from checkpoints, so joins on a hub
    with very many neighbours can be split. Loops and repeated edges change nothing; no edges, no nodes.
    """
    pairs = edges.select("a", "b").where("a <> b")
    both = frozen(pairs.union(pairs.select("b", "a")).distinct())
    first = both.groupBy("a").agg(F.min("b").alias("b"))
    labels = frozen(first.select(F.col("a").alias("node"), F.least("a", "b").alias("label")))
    while True:
        near = (
            both.join(labels.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("label").alias("near"))
        )
        lower = labels.join(near, F.col("node") == F.col("a")).select("node", "label", F.least("label", "near").alias("low"))
        of_low = labels.select(F.col("node").alias("low"), F.col("label").alias("lower"))
        moved = lower.join(of_low, "low", "left").select(
            "node", F.least("low", "lower").alias("label"), (F.least("low", "lower") < F.col("label")).alias("moved")
        )
        labels = frozen(moved)
        if labels.where("moved").isEmpty():
            return labels.select("node", "label")
        labels = labels.select("node", "label")
