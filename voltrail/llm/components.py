"""Connected components of a table of links, by alternating star contraction.

Each round hangs every node's larger neighbours, then its smaller ones, on the smallest node seen;
the trees become stars whose centre is the smallest node.  Rounds grow with the logarithm of the
longest path.  A round's links are a table in the shared folder, so the lineage stays short and a
lost executor loses nothing.  A node with very many links costs no task more than its share: the
smallest neighbour is a partial aggregate, and it is joined back (skewed joins are split).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltrail.llm.store import written


def star(links: DataFrame, large: bool) -> DataFrame:
    """One contraction of links ``a > b``."""
    if large:
        near = links.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(links.select(F.col("b").alias("u"), F.col("a").alias("v")))
    else:
        near = links.select(F.col("a").alias("u"), F.col("b").alias("v"))
    least = near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    moved = near.join(least, "u")
    out = moved.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")) if large else moved.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return out.where("a <> b").distinct()


def mark(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root) of every node of the links ``a``, ``b``; root is the smallest node reachable."""
    links = written(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before = mark(links)
    for _ in range(rounds if before[0] else 0):
        links = written(star(star(links, True), False), "links")
        now = mark(links)
        if now == before:
            break
        before = now
    else:
        if before[0]:
            raise RuntimeError(f"components not found in {rounds} rounds")
    found = links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return found.unionByName(found.select(F.col("root").alias("node"), "root").distinct())
