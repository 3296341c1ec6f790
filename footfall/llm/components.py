"""Connected components of an edge table by alternating stars.

A round points every node at the smallest node among its neighbours: first the larger neighbours of
a node, then its smaller ones. It repeats until the edges are stars, which takes a number of rounds
that grows with the logarithm of the component size. Each round is written to the shared folder, so
a lost executor repeats one round at most; only the number of edges and a check sum reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from footfall.operators.joins import join_per_key
from footfall.sources.storage import materialise


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    smallest = both.groupBy("u").agg(F.min(F.least("u", "v")).alias("m"))
    larger = join_per_key(both.filter("v > u"), smallest, ["u"])
    return larger.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    smallest = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = join_per_key(down, smallest, ["u"]).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.filter("u != v").unionByName(smallest.select("u", F.col("m").alias("v"))).distinct()


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node with an edge, root the smallest node of its component.

    ``edges`` has two bigint columns u and v in any order; repeated edges, loops and nulls add
    nothing. No edges give no rows."""
    edges = materialise(edges.select("u", "v").filter("u != v").distinct(), "edges")
    mark = _mark(edges)
    while mark[0]:
        edges = materialise(_small_star(_large_star(edges)), "edges")
        before, mark = mark, _mark(edges)
        if before == mark:
            break
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return stars.unionByName(stars.select(F.col("root").alias("node"), "root").distinct())
