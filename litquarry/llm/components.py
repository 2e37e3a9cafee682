"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from litquarry.session import discard, materialize


def _fixed(edges: DataFrame, name: str) -> tuple[DataFrame, tuple]:
    edges = materialize(edges.filter("u > v").distinct(), name)
    return edges, tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every linked node, the root being the smallest node it reaches.

    ``links`` has long columns a and b. A round is a large star, which hangs each node's larger
    neighbours on its smallest one, and a small star, which does so with the smaller ones; edges
    only shrink towards stars, so a chain of n nodes takes O(log n) rounds. Both are one aggregate
    and one join on edges; a node with very many neighbours is combined within each task first, and
    its side of the join is split by adaptive execution. Every round is a written table, so a lost
    executor repeats one round. Self links and repeated links change nothing.
    """
    edges, mark = _fixed(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")), "links")
    while mark[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy(F.col("u").alias("v")).agg(F.min("v").alias("m"))
        large = edges.join(least, "v").select("u", F.least("v", "m").alias("v")).distinct()
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(smallest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        new, new_mark = _fixed(small.unionByName(smallest.select("u", F.col("m").alias("v"))), "stars")
        discard(edges)
        edges, done, mark = new, new_mark == mark, new_mark
        if done:
            break
    roots = edges.select(F.col("v").alias("node")).distinct().withColumn("root", F.col("node"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
