"""Connected components of a graph of links, by stars that are folded towards their least member."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewell.llm.common import discard, stage


def connected(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of edges (a, b): root is the least node of its component.

    Alternates large and small stars until nothing changes, at most some log(nodes) squared
    rounds. Minima are combined before each shuffle and joins can be split by Spark, so a node
    may have any number of links. No links, no rows; self links and nulls are ignored.
    """
    current = stage(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    mark = None
    while True:
        # Large star: of a node's neighbours, those above it go to the least of all.
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = stage(both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(), "large-star")
        discard(current)
        # Small star: a node and its neighbours below it go to the least of them.
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
        current = stage(small.distinct(), "small-star")
        discard(large)
        new = current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if new == mark:
            break
        mark = new
    pairs = current.groupBy("a").agg(F.min("b").alias("root")).select(F.col("a").alias("node"), "root")
    return pairs.unionByName(pairs.select(F.col("root").alias("node"), "root").distinct())
