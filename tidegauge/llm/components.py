"""Connected components of links, as joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.frames import stored


def connected(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b): root is the least node it reaches.

    Labels start as the least neighbour. In each step a node takes the least label of its
    neighbours, and then its label's own label, so paths shorten by half or more. A hub's
    links are reduced to one minimum before the shuffle.
    """
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = stored(both.distinct(), "links")
    labels = both.groupBy("a").agg(F.least("a", F.min("b")).alias("root")).withColumnRenamed("a", "node")
    labels = stored(labels, "labels")
    total = None
    while (now := labels.agg(F.sum(F.col("root").cast("decimal(38,0)"))).first()[0]) != total:
        total = now
        theirs = labels.select(F.col("node").alias("b"), F.col("root").alias("theirs"))
        least = both.join(theirs, "b").groupBy("a").agg(F.min("theirs").alias("theirs"))
        better = labels.join(least.withColumnRenamed("a", "node"), "node").select(
            "node", F.least("root", "theirs").alias("root")
        )
        above = labels.select(F.col("node").alias("root"), F.col("root").alias("above"))
        labels = stored(better.join(above, "root").select("node", F.col("above").alias("root")), "labels")
    return labels
