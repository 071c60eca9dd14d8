"""Whitening of embeddings: equal vectors are fitted and whitened once, by their multiplicity.

1. Every vector becomes whole numbers; equal ones are grouped (``HashAggregate``, partial on the map
   side, so a vector that a third of all rows share is one row a task before the shuffle).
2. Exact sums, then a weighted centred product a task, summed by Spark: only ``d`` sums and ``d * d``
   products reach the driver, whatever the number of rows.
3. The eigenvectors go to the tasks with the function; every distinct vector is projected once.
4. Rows get their projection by a join on the digest of the vector. Vectors held by ``1 / HOT_SHARE``
   of the rows or more (so fewer than ``HOT_SHARE`` of them) are joined as a broadcast, the
   others by a shuffle in which no key is hot.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_batches, pick, stored

FACTOR, OFFSET, COMPONENTS = 64, 1_000_000, 32
#: A vector is hot if at least one row in this many holds it.
HOT_SHARE = 1024
#: A covariance of more dimensions does not belong on one driver.
MAX_DIMENSIONS = 8192
#: Whole numbers beyond this size are cut to it: they stay longs.
LARGEST = 1 << 62
#: Directions with less than this share of the variance (times the dimensions) count as constant.
ROUNDING = 1e-13
_EXACT = float(1 << 52)


@dataclass(frozen=True)
class Model:
    """The fit: ``n`` vectors, their sums, and the leading unit eigenvectors as columns."""

    n: int
    sums: tuple[int, ...]
    eigenvalues: np.ndarray
    vectors: np.ndarray
    trace: float

    @property
    def explained(self) -> list[float]:
        return [float(e / self.trace) if self.trace > 0 else 0.0 for e in self.eigenvalues]


def _whole(vectors: pa.ListArray, dimensions: int, factor: int, offset: int) -> np.ndarray:
    """``floor(factor * c) + offset`` of every entry, cut to longs; a row a vector."""
    entries = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    lengths = vectors.value_lengths().to_numpy(zero_copy_only=False)
    with np.errstate(over="ignore"):
        scaled = np.zeros((len(vectors), dimensions))
        scaled[np.arange(dimensions) < lengths[:, None]] = np.floor(entries * factor)
    if np.abs(scaled).max(initial=0.0) < _EXACT:
        return scaled.astype(np.int64) + offset
    whole = [[int(v) if np.isfinite(v) else int(np.sign(v)) * LARGEST for v in row] for row in scaled]
    return np.array([[max(-LARGEST, min(LARGEST, v + offset)) for v in row] for row in whole], dtype=np.int64)


def _lists(rows: np.ndarray) -> pa.ListArray:
    ends = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
    return pa.ListArray.from_arrays(ends, np.ascontiguousarray(rows).reshape(-1))


def digests(x: np.ndarray) -> pa.Array:
    """A key of every row of whole numbers."""
    x = np.ascontiguousarray(x, dtype="<i8")
    return pa.array([hashlib.blake2b(row.data, digest_size=20).digest() for row in x], pa.binary())


def usable(column: str) -> Column:
    """Whether a vector takes part: not null, all entries there and finite."""
    limit = F.lit(float("inf"))
    return F.col(column).isNotNull() & F.forall(
        column, lambda x: F.coalesce((F.abs(x.cast("double")) < limit) & ~F.isnan(x.cast("double")), F.lit(False)))


def _vectors(df: DataFrame, dimensions: int, factor: int, offset: int, key: bool) -> DataFrame:
    """``vec_id`` and the digest (``key``), or the whole-number vector itself, of every usable row."""
    rows = pick(df, vec_id="vec_id", embedding="embedding").filter(usable("embedding"))
    identity = rows.schema["vec_id"].dataType.simpleString()

    def start() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            x = _whole(batch["embedding"], dimensions, factor, offset)
            if key:
                return pa.RecordBatch.from_arrays([batch["vec_id"], digests(x)], ["vec_id", "key"])
            return pa.RecordBatch.from_arrays([_lists(x)], ["x"])

        return step

    rows = rows if key else rows.select("embedding")
    return map_batches(rows, start, f"vec_id {identity}, key binary" if key else "x array<long>")


def distinct_vectors(df: DataFrame, dimensions: int, factor: int = FACTOR, offset: int = OFFSET) -> DataFrame:
    """``x, n``: every different vector once, with the number of rows that hold it."""
    return _vectors(df, dimensions, factor, offset, key=False).groupBy("x").agg(F.count(F.lit(1)).alias("n"))


def _matrix(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    x = batch["x"]
    flat = x.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(batch.num_rows, -1), batch["w"].to_numpy(zero_copy_only=False)


def offsets(x: np.ndarray, n: int, sums: tuple[int, ...]) -> np.ndarray:
    """``n * x - sums``, exact: 64-bit where it fits, whole Python numbers where not."""
    top = max(int(np.abs(x).max(initial=0)) * n, max((abs(s) for s in sums), default=0))
    if top < 1 << 62:
        return x * np.int64(n) - np.asarray(sums, dtype=np.int64)
    return x.astype(object) * n - np.asarray(sums, dtype=object)


def centred(x: np.ndarray, n: int, sums: tuple[int, ...]) -> np.ndarray:
    """``x - sums / n`` with one rounding an entry."""
    return np.asarray(offsets(x, n, sums) / n, dtype=np.float64)


def deviations(x: np.ndarray, n: int, sums: tuple[int, ...]) -> list[int | None]:
    """Sum of squares of ``n * x - sums``, exact; None where it is no long."""
    off = offsets(x, n, sums)
    top = int(np.abs(off).max(initial=0))
    if off.dtype == object or top * top * max(1, x.shape[1]) >= 1 << 63:
        totals = [int(t) for t in (off.astype(object) ** 2).sum(axis=1)]
        return [t if t < 1 << 63 else None for t in totals]
    return (off * off).sum(axis=1).tolist()


def _summed(parts: DataFrame, d: int) -> np.ndarray:
    """Partial ``d x d`` products (a row of the matrix a row of the table), summed by Spark."""
    cells = parts.select("i", F.posexplode("row").alias("j", "v")).groupBy("i", "j").agg(F.sum("v").alias("v"))
    out = np.zeros((d, d))
    for r in cells.collect():
        out[r.i, r.j] = r.v
    return out


def _products(df: DataFrame, values: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    """Weighted products of ``values(x)`` with itself, one partial matrix a batch of vectors."""

    def start() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            x, w = _matrix(batch)
            y = values(x)
            product = (y * w[:, None]).T @ y
            return pa.RecordBatch.from_arrays(
                [pa.array(range(len(product)), pa.int32()), _lists(product)], ["i", "row"])

        return step

    return map_batches(df, start, "i int, row array<double>", rows=100_000)


def _sums(rows: DataFrame) -> DataFrame:
    """Exact weighted sum ``s`` of every dimension ``i``, added up a batch and then by Spark."""

    def start() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            x, w = _matrix(batch)
            if int(np.abs(x).max(initial=0)) * int(w.sum()) >= 1 << 62:
                x, w = x.astype(object), w.astype(object)
            totals = [Decimal(int(t)) for t in w @ x]
            return pa.RecordBatch.from_arrays(
                [pa.array(range(len(totals)), pa.int32()), pa.array(totals, pa.decimal128(38, 0))], ["i", "s"])

        return step

    return map_batches(rows, start, "i int, s decimal(38,0)", rows=100_000).groupBy("i").agg(
        F.sum("s").cast("decimal(38,0)").alias("s"))


def fit(distinct: DataFrame, dimensions: int, components: int = COMPONENTS, weights: str = "counts") -> Model | None:
    """The model of distinct vectors ``x, n``; None without a vector.

    ``weights`` is ``counts`` (every row counts) or ``one`` (every different vector counts once).
    """
    rows = distinct.select("x", _weight(weights).alias("w"))
    total = rows.agg(F.sum("w").alias("n")).first().n
    if not total:
        return None
    sums = [0] * dimensions
    for r in _sums(rows).collect():
        sums[r.i] = int(r.s)
    sums = tuple(sums)
    if not dimensions:
        return Model(total, (), np.zeros(0), np.zeros((0, 0)), 0.0)
    covariance = _summed(_products(rows, lambda x: centred(x, total, sums)), dimensions) / total
    values, vectors = np.linalg.eigh((covariance + covariance.T) / 2)
    order = np.argsort(-values, kind="stable")[: min(components, dimensions)]
    return Model(total, sums, np.maximum(values[order], 0.0), vectors[:, order], float(np.trace(covariance)))


def _weight(weights: str) -> Column:
    if weights not in ("counts", "one"):
        raise ValueError("weights are counts or one")
    return F.col("n").cast("long") if weights == "counts" else F.lit(1).cast("long")


def scales(model: Model) -> np.ndarray:
    """One over the root of every eigenvalue; 0 for directions without variance."""
    floor = ROUNDING * max(1, len(model.sums)) * model.trace
    live = model.eigenvalues > floor
    return np.where(live, 1.0 / np.sqrt(np.where(live, model.eigenvalues, 1.0)), 0.0)


def project(x: np.ndarray, model: Model) -> np.ndarray:
    return centred(x, model.n, model.sums) @ model.vectors * scales(model)


def whiten_distinct(distinct: DataFrame, model: Model) -> DataFrame:
    """``key, n, deviation, whitened`` of every different vector."""

    def start() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            x = batch["x"].flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            return pa.RecordBatch.from_arrays([
                digests(x), batch["n"], pa.array(deviations(x, model.n, model.sums), pa.int64()),
                _lists(project(x, model)),
            ], ["key", "n", "deviation", "whitened"])

        return step

    return map_batches(distinct, start, "key binary, n long, deviation long, whitened array<double>")


def identity_error(distinct: DataFrame, model: Model, weights: str = "counts") -> float:
    """Largest entry of the covariance of the whitened fit list minus the identity (live directions)."""
    live = scales(model) > 0
    if not live.any():
        return 0.0
    rows = distinct.select("x", _weight(weights).alias("w"))

    def sums_of() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            x, w = _matrix(batch)
            total = w @ project(x, model)
            return pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], ["row"])

        return step

    parts = map_batches(rows, sums_of, "row array<double>", rows=100_000)
    mean = np.zeros(len(live))
    for r in parts.select(F.posexplode("row").alias("i", "v")).groupBy("i").agg(F.sum("v").alias("v")).collect():
        mean[r.i] = r.v / model.n
    covariance = _summed(_products(rows, lambda x: project(x, model) - mean), len(live)) / model.n
    return float(np.abs((covariance - np.eye(len(live)))[np.ix_(live, live)]).max())


def whiten(df: DataFrame, components: int = COMPONENTS, weights: str = "counts", factor: int = FACTOR,
           offset: int = OFFSET) -> DataFrame:
    """A row a usable vector and component: ``vec_id, component, n, deviation, whitened, explained, identity_error``.

    Rows whose vector is null or holds null or non-finite entries take no part. Shorter vectors count
    as filled up with zeros to the longest length. Entries beyond ``LARGEST`` are cut to it; a
    deviation that is no long is null. A direction without variance (fewer vectors than dimensions,
    or one vector only) has ``whitened`` and ``explained`` 0 and no part in ``identity_error``; equal
    eigenvalues leave the choice of their vectors to the decomposition, one choice for all rows.
    Repeated rows are repeated in the result; ``vec_id`` may be null. An empty table, or one of empty
    vectors only, gives an empty result. Further columns, also of clashing names, are not read.
    """
    spark = df.sparkSession
    embeddings = pick(df, vec_id="vec_id", embedding="embedding")
    identity = embeddings.schema["vec_id"].dataType.simpleString()
    schema = (f"vec_id {identity}, component int, n long, deviation long, whitened double, explained double, "
              "identity_error double")
    dimensions = embeddings.filter(usable("embedding")).agg(F.max(F.size("embedding")).alias("d")).first().d or 0
    if dimensions > MAX_DIMENSIONS:
        raise ValueError(f"{dimensions} dimensions; at most {MAX_DIMENSIONS} can be decomposed")
    if not dimensions:
        return spark.createDataFrame([], schema)
    distinct = stored(distinct_vectors(embeddings, dimensions, factor, offset), "whitening-distinct")
    model = fit(distinct, dimensions, components, weights)
    error = identity_error(distinct, model, weights)

    rows = _vectors(embeddings, dimensions, factor, offset, key=True)
    n_rows = distinct.agg(F.sum("n").alias("n")).first().n
    hot_from = n_rows // HOT_SHARE + 1
    hot = F.broadcast(whiten_distinct(distinct.filter(F.col("n") >= hot_from), model))
    rest = whiten_distinct(distinct.filter(F.col("n") < hot_from), model)
    wanted = ["vec_id", "deviation", "whitened"]
    joined = rows.join(hot, "key").select(*wanted).unionByName(
        rows.join(hot.select("key"), "key", "left_anti").join(rest, "key").select(*wanted))
    shares = F.array(*[F.lit(e) for e in model.explained])
    return joined.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
        F.element_at(shares, F.col("at") + 1).alias("explained"), F.lit(error).alias("identity_error"))
