"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from replivote.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``edges (a, b)``; component is the smallest node reachable.

    Each round links every node's larger neighbours to its smallest neighbour (large
    star) and then its smaller ones (small star), until nothing changes: about the
    logarithm of the longest path. Rounds move one row per edge, minima are combined
    before the shuffle, and each round is a written table. Self-loops and repeated
    edges are allowed; edges with a null end are ignored.
    """
    spark = edges.sparkSession
    down = stored(
        edges.where("a is not null and b is not null")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "edges",
    )
    loops = down.where("a = b")
    down = down.where("a > b")
    mark = None
    while True:
        both = down.union(down.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a > b").distinct()
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lowest, "a")
        small = small.select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        down = stored(small.select("e.*").where("a > b").distinct(), "stars")
        new = down.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if new == mark or new[0] == 0:
            break
        mark = new
    nodes = down.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = down.select(F.col("b").alias("node"), F.col("b").alias("component"))
    alone = loops.select(F.col("a").alias("node")).join(nodes.select("node"), "node", "left_anti")
    return nodes.union(roots).union(alone.select("node", F.col("node").alias("component"))).distinct()
