"""Exact top-k inner products by pivot-table elimination.

Every vector keeps its distances to a few pivots. The triangle inequality turns them into a
lower bound of its distance to a query, and so into an upper bound of their inner product.
A query reads the candidates of a block in the order of that bound and stops as soon as no
later one can enter its list.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import map_batches, pick, stored

#: Pivots, and the rows they are chosen from (those with the least hash of their id).
PIVOTS, PIVOT_SAMPLE = 32, 1024
#: Rows of a block, about.
CANDIDATE_BLOCK, QUERY_BLOCK = 4096, 512
#: Candidates that a query evaluates before it looks at its bound again.
FIRST_STEP = 64


def scaled(embedding: list | None, factor: int) -> list[int] | None:
    """floor(factor * x) of every component; None if the vector or a component is missing or not finite."""
    if embedding is None or any(x is None for x in embedding):
        return None
    values = np.floor(np.asarray(embedding, dtype=np.float64) * factor)
    return [int(x) for x in values] if np.isfinite(values).all() else None


def integer_vectors(rows: DataFrame, factor: int = 256, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, v) of the rows that take part, v as integers; equal rows once. Components are taken as doubles."""
    source = pick(rows, vec_id=id_col, v=vector_col).where("vec_id IS NOT NULL AND v IS NOT NULL").select(F.col("vec_id").cast("long"), F.col("v").cast("array<double>"))

    def start():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            vectors = [scaled(v, factor) for v in batch.column(1).to_pylist()]
            kept = [i for i, v in enumerate(vectors) if v is not None]
            ids = batch.column(0).take(pa.array(kept, pa.int64()))
            return pa.RecordBatch.from_arrays([ids, pa.array([vectors[i] for i in kept], pa.list_(pa.int64()))], names=["vec_id", "v"])

        return step

    return map_batches(source, start, "vec_id long, v array<long>").distinct()


def matrix(vectors: list[list[int]], width: int) -> np.ndarray:
    """Rows of equal width; shorter vectors end in zeros."""
    out = np.zeros((len(vectors), width), dtype=np.int64)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def farthest_first(vectors: np.ndarray, count: int) -> np.ndarray:
    """Up to ``count`` rows, each the farthest from those before it."""
    points = vectors.astype(np.float64)
    chosen = [0]
    nearest = ((points - points[0]) ** 2).sum(axis=1)
    while len(chosen) < min(count, len(points)) and nearest.max() > 0:
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, ((points - points[chosen[-1]]) ** 2).sum(axis=1))
    return points[chosen]


def distances(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    points = vectors.astype(np.float64)
    return np.stack([np.sqrt(((points - p) ** 2).sum(axis=1)) for p in pivots], axis=1)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of integer rows, by floating point where that is exact."""
    bound = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, a.shape[-1])
    if bound < 2**53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


@dataclass
class Block:
    ids: np.ndarray
    vectors: np.ndarray
    to_pivots: np.ndarray

    @property
    def squares(self) -> np.ndarray:
        return (self.vectors.astype(np.float64) ** 2).sum(axis=1)


def search_block(queries: Block, candidates: Block, k: int) -> tuple[list[tuple[int, int, int]], int]:
    """((query row, vec_id, score) of the best ``k`` of each query within the block, evaluated candidates).

    Ties go to the smaller id; a candidate with the query's own id takes no part.
    """
    # Rounding must not make a bound too low: it is widened by more than its error.
    slack = 1e-9 * (queries.squares.max(initial=0) + candidates.squares.max(initial=0)) + 1e-6
    low = np.zeros((len(queries.ids), len(candidates.ids)))
    for p in range(queries.to_pivots.shape[1]):
        np.maximum(low, np.abs(queries.to_pivots[:, p, None] - candidates.to_pivots[None, :, p]), out=low)
    upper = (queries.squares[:, None] + candidates.squares[None, :] - low**2) / 2 + slack
    found, evaluated = [], 0
    for i, own in enumerate(queries.ids):
        order = np.argsort(-upper[i], kind="stable")
        bound = upper[i][order]
        ids, scores = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        at, step = 0, FIRST_STEP
        while at < len(order):
            if len(ids) == k and bound[at] < scores[-1]:
                break
            part = order[at : at + step]
            evaluated += len(part)
            score = products(queries.vectors[i : i + 1], candidates.vectors[part])[0]
            other = candidates.ids[part] != own
            ids, scores = np.concatenate([ids, candidates.ids[part][other]]), np.concatenate([scores, score[other]])
            best = np.lexsort((ids, -scores))[:k]
            ids, scores = ids[best], scores[best]
            at, step = at + step, 2 * step
        found += [(i, int(a), int(s)) for a, s in zip(ids, scores, strict=True)]
    return found, evaluated


def top_products(rows: DataFrame, query_every: int = 50, k: int = 5, factor: int = 256, pivots: int = PIVOTS,
                 id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` largest inner products of every row whose id ``query_every`` divides.

    Vectors that are NULL, hold NULL or are not finite, and rows without id take no part; shorter
    vectors count as ended by zeros; equal rows count once, and several vectors of one id are
    never partners of each other. Fewer candidates give fewer rows, an empty table none. The
    driver sees the pivot sample and one count per pivot.
    """
    vectors = stored(integer_vectors(rows, factor, id_col, vector_col), "vectors")
    width = max(1, vectors.agg(F.max(F.size("v"))).first()[0] or 0)
    sample = vectors.orderBy(F.xxhash64("vec_id"), "vec_id", "v").limit(PIVOT_SAMPLE).collect()
    places = farthest_first(matrix([r["v"] for r in sample], width), pivots) if sample else np.zeros((1, width))

    def measure():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            far = distances(matrix(batch.column(1).to_pylist(), width), places)
            return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(list(far), pa.list_(pa.float64())), pa.array(far.argmin(axis=1).astype(np.int32))], names=["vec_id", "v", "far", "cell"])

        return step

    table = stored(map_batches(vectors, measure, "vec_id long, v array<long>, far array<double>, cell int"), "pivot-table")

    def blocks(part: DataFrame, size: int) -> tuple[DataFrame, int]:
        """Rows numbered by block: rows of a cell together, a large cell dealt out by hash."""
        counts = {r["cell"]: r["n"] for r in part.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}
        starts, total = [], 0
        for cell in sorted(counts):
            share = -(-counts[cell] // size)
            starts.append((cell, total, share))
            total += share
        first = F.create_map(*[F.lit(x) for c, s, _ in starts for x in (c, s)]) if starts else F.create_map(F.lit(0), F.lit(0))
        shares = F.create_map(*[F.lit(x) for c, _, n in starts for x in (c, n)]) if starts else F.create_map(F.lit(0), F.lit(1))
        number = first[F.col("cell")] + F.pmod(F.xxhash64("vec_id", F.lit(7)), shares[F.col("cell")].cast("long")).cast("int")
        return part.withColumn("block", number), total

    candidates, n_candidates = blocks(table, CANDIDATE_BLOCK)
    queries, n_queries = blocks(table.where(F.col("vec_id") % query_every == 0), QUERY_BLOCK)
    # Each block of queries meets each block of candidates once.
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(max(1, n) - 1)))
    left = candidates.select("vec_id", "v", "far", F.col("block").alias("c"), each(n_queries).alias("q"))
    right = queries.select("vec_id", "v", "far", F.col("block").alias("q"), each(n_candidates).alias("c"))

    def block_of(part: pa.Table) -> Block:
        return Block(part.column("vec_id").to_numpy(), matrix(part.column("v").to_pylist(), width),
                     np.array(part.column("far").to_pylist(), dtype=np.float64).reshape(part.num_rows, -1))

    def search(some_candidates: pa.Table, some_queries: pa.Table) -> pa.Table:
        own, found = block_of(some_queries), []
        if some_queries.num_rows and some_candidates.num_rows:
            found, _ = search_block(own, block_of(some_candidates), k)
        vectors = some_queries.column("v").to_pylist()
        return pa.table({
            "query_id": pa.array([int(own.ids[i]) for i, _, _ in found], pa.int64()),
            "query_v": pa.array([hash(tuple(vectors[i])) for i, _, _ in found], pa.int64()),
            "vec_id": pa.array([a for _, a, _ in found], pa.int64()),
            "score": pa.array([s for _, _, s in found], pa.int64()),
        })

    found = left.groupBy("c", "q").cogroup(right.groupBy("c", "q")).applyInArrow(search, "query_id long, query_v long, vec_id long, score long")
    rank = F.row_number().over(W.partitionBy("query_id", "query_v").orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
