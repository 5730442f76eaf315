"""Connected components of any number of edges by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areastats.llm.common import materialise


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the undirected edges (a, b): root is the component's smallest node.

    Every round hangs each node's larger neighbours on its smallest one, and then its smaller ones; the rounds grow with
    the logarithm of the longest path. Each round's edges are written, minima are partial aggregates, and a node with
    many neighbours is the skewed side of a join, which adaptive execution splits.
    """
    now = materialise(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state = None
    while True:
        both = now.union(now.select("b", "a"))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low")).withColumnRenamed("a", "n")
        large = both.where("b > a").join(low, F.col("a") == F.col("n")).select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = materialise(large.where("a <> b").distinct())
        low = large.groupBy("a").agg(F.min("b").alias("low")).withColumnRenamed("a", "n")
        met = large.join(low, F.col("a") == F.col("n"))
        small = met.where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
        now = materialise(small.union(low.select("n", "low").toDF("a", "b")).distinct())
        seen = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen == state:
            return now.toDF("node", "root")
        state = seen
