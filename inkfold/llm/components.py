"""Connected components of links between integers, by alternating stars.

A round joins every node to the least of its neighbours: first its larger
neighbours (large star), then its smaller ones (small star). Each round is
written to the shared folder; the links settle into stars around the least node
after about log(n) rounds. The least neighbour is found by an aggregation that
combines before it shuffles, and it joins the links of a node through a shuffled
equi-join, which Spark deals anew where a node has very many links.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkfold.llm.common import dealt_join, stored


def _both_ways(links: DataFrame) -> DataFrame:
    return links.select(F.inline(F.array(F.struct(F.col("a").alias("u"), F.col("b").alias("v")),
                                         F.struct(F.col("b").alias("u"), F.col("a").alias("v")))))


def _star(pairs: DataFrame, large: bool) -> DataFrame:
    """``pairs``: u, v. Links the larger (or the smaller) neighbours of u with the least one."""
    least = pairs.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    joined = dealt_join(pairs, least, "u")
    if large:
        moved = joined.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        moved = joined.select(F.inline(F.array(F.struct(F.col("v").alias("a"), F.col("m").alias("b")),
                                               F.struct(F.col("u").alias("a"), F.col("m").alias("b")))))
    return moved.where("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links`` (``a, b``, bigint): root is its least reachable node.

    Links to itself and repeated links change nothing; nodes without another node
    are not listed; no links give an empty result.
    """
    now = stored(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    mark = [F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")]
    before = now.agg(*mark).first()
    while before["n"]:
        after_large = _star(_both_ways(now), large=True)
        small = after_large.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        now = stored(_star(small, large=False), "links")
        after = now.agg(*mark).first()
        if after == before:
            break
        before = after
    leaves = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return leaves.unionByName(leaves.select(F.col("root").alias("node"), "root").distinct())
