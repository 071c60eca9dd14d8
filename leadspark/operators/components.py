"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .grouping import shuffled


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root) of every node of a link ``a, b``; the root is the least node of its component.

    Every round points each node to the least node that it or a neighbour knows, then links what
    pointed to the same node through that one. Distances fall by half or more, so the rounds grow with the
    logarithm of the longest chain; the links never outnumber those of the start. A round is one reliable checkpoint; the
    driver sees two counters of it.
    """
    links = cut_lineage(_downward(links))
    seen = None
    while (now := _counters(links)) != seen:
        seen = now
        if not now[0]:
            break
        ways = links.unionByName(links.select(F.col("lo").alias("hi"), F.col("hi").alias("lo")))
        least = ways.groupBy(F.col("hi").alias("node")).agg(F.min("lo").alias("lowest")).select(
            "node", F.least("node", "lowest").alias("lowest"))
        # Larger neighbours hang below the least neighbour of a node, and so does the node itself.
        hung = ways.join(shuffled(least), F.col("hi") == F.col("node")).select(
            F.greatest("lo", "node").alias("a"), F.col("lowest").alias("b"))
        down = _downward(hung)
        lowest = down.groupBy("hi").agg(F.min("lo").alias("lowest"))
        links = cut_lineage(_downward(down.join(shuffled(lowest), "hi").select(F.explode(F.array(
            F.struct(F.col("hi").alias("a"), F.col("lowest").alias("b")),
            F.struct(F.col("lo").alias("a"), F.col("lowest").alias("b")))).alias("e")).select("e.*")))
    return links.select(F.col("hi").alias("node"), F.col("lo").alias("root")).unionByName(
        links.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct())


def _downward(links: DataFrame) -> DataFrame:
    """Distinct links (hi, lo) of two different nodes."""
    return links.filter("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct()


def _counters(links: DataFrame) -> tuple[int, int]:
    row = links.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("hi", "lo")).alias("mark")).first()
    return row.n, row.mark
