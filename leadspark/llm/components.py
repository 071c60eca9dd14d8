"""Connected components of an edge table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def connected_components(edges: DataFrame, name: str = "stars") -> DataFrame:
    """(node, root) for every node of an edge with two ends; ``root`` is the least node reachable.

    ``edges`` has two columns ``a``, ``b`` of one ordered type. Each round hangs all larger
    neighbours of a node below its least neighbour, then all smaller ones; rounds grow with the
    logarithm of the longest chain. A round's edges are written to the shared folder, and only
    their count and hash sum reach the driver.
    """
    low, high = F.least("a", "b"), F.greatest("a", "b")
    state = stored(edges.where("a <> b").select(high.alias("a"), low.alias("b")).distinct(), name)
    mark = _mark(state)
    while mark[0]:
        both = state.select("a", "b").unionAll(state.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        state = stored(small.select("e.a", "e.b").where("a <> b").distinct(), name)
        before, mark = mark, _mark(state)
        if before == mark:
            break
    return state.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(state.select(F.col("b"), F.col("b")).distinct())


def _mark(state: DataFrame) -> tuple[int, int]:
    row = state.agg(F.count(F.lit(1)).alias("n"), F.sum(F.shiftright(F.xxhash64("a", "b"), 16)).alias("h")).first()
    return row["n"], row["h"]
