"""Connected components of links, by stars that shrink round by round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import materialize


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every linked node; links has columns a and b, the component is its least node.

    Each round connects a node's larger neighbours to its least one, then its
    smaller ones likewise, until only stars around the least nodes are left: a
    logarithmic number of rounds, each written to the shared folder. A node's
    least neighbour comes from an aggregate that combines before the shuffle, and
    is stored, so that the join with a node of very many links can be split.
    """
    links = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    links = materialize(links, "links")
    mark = None
    while True:
        seen = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % 1_000_000_007)).first()
        if seen == mark or seen[0] == 0:
            return links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
                links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )
        mark = seen
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = materialize(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "least")
        down = both.where("b > a").join(least, "a")
        # a node without larger neighbours keeps its link to the least one
        kept = least.where("m < a")
        large = down.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(kept.select("a", F.col("m").alias("b")))
        large = materialize(large.where("a > b").distinct(), "large")
        lowest = materialize(large.groupBy("a").agg(F.min("b").alias("m")), "lowest")
        small = large.join(lowest, "a").select(
            F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b")
        )
        links = materialize(small.distinct(), "links")
