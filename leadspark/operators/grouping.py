"""Skew-safe building blocks: first row per group, long running counters, row numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from ..session import cut_lineage


def shuffled(df: DataFrame) -> DataFrame:
    """A side of a join that grows with the input, so that neither side is broadcast.

    A checkpointed table is believed to be as small as the compressed files it came from, also where an explode made
    many rows of each. A broadcast chosen by that estimate builds the whole table on the driver.
    """
    return df.hint("merge")


def first_per_group(df: DataFrame, keys: list[str], order_cols: list, last: bool = False) -> DataFrame:
    """One row per key: the first (or last) by ``order_cols``.

    An aggregate rather than a window: partial results shrink a hot key on the
    map side, so no task ever sees the whole group. Works with NULL keys.
    """
    order = F.struct(*[F.col(c) if isinstance(c, str) else c for c in order_cols])
    pick = (F.max_by if last else F.min_by)(F.struct(*[F.col(f"`{c}`") for c in df.columns]), order)
    return df.groupBy(*[F.col(k).alias(f"__key_{i}") for i, k in enumerate(keys)]).agg(pick.alias("__row")).select("__row.*")


def digest(keys: list[str]) -> Column:
    """256 bits of the key columns; NULL differs from every text."""
    parts = [F.coalesce(F.concat(F.length(F.col(f"`{k}`").cast("string")).cast("string"), F.lit(":"), F.col(f"`{k}`").cast("string")), F.lit("-")) for k in keys]
    return F.unhex(F.sha2(F.concat(*parts), 256))


def first_row_of_key(df: DataFrame, keys: list[str], order_col: str, last: bool = False) -> DataFrame:
    """The row of the first (or last) ``order_col`` of every key, for wide rows and long keys.

    ``order_col`` tells rows apart (no two rows share a value, none is NULL). The
    aggregate sees 32 bytes and the order of a row only; whole rows are fetched afterwards by that order.
    """
    pick = F.max(order_col) if last else F.min(order_col)
    chosen = df.groupBy(digest(keys).alias("__key")).agg(pick.alias("__chosen")).select("__chosen")
    return df.join(shuffled(chosen), F.col(order_col) == F.col("__chosen"), "left_semi")


def in_ranges(df: DataFrame, order: list, name: str = "__range") -> DataFrame:
    """Rows dealt by ranges of the whole order, with the number of their range (it never decreases along
    the order). Equal leading columns spread over tasks; rows equal in all of them share a range.
    """
    return cut_lineage(df.repartitionByRange(*order).withColumn(name, F.spark_partition_id()))


def sorted_positions(df: DataFrame, order: list[Column], name: str = "n") -> DataFrame:
    """1-based position of every row in the given order, which tells rows apart.

    Rows are dealt by ranges of the whole order, so equal leading values spread over
    tasks; each range is numbered by itself and shifted by the sizes of those before it (a row a range).
    """
    ranges = in_ranges(df, order)
    sizes = ranges.groupBy("__range").agg(F.count(F.lit(1)).alias("__size"))
    before = F.sum("__size").over(W.orderBy("__range").rowsBetween(W.unboundedPreceding, -1))
    offsets = sizes.select("__range", F.coalesce(before, F.lit(0)).alias("__before"))
    local = F.row_number().over(W.partitionBy("__range").orderBy(*order))
    return ranges.withColumn("__local", local).join(F.broadcast(offsets), "__range").withColumn(
        name, F.col("__local") + F.col("__before")).drop("__range", "__local", "__before")


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on ``keys`` where NULL equals NULL; the keys appear once."""
    renamed = right.select(*[F.col(c).alias(f"__r_{c}") if c in keys else F.col(c) for c in right.columns])
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"__r_{k}"))
    return left.join(renamed, cond, how).drop(*[f"__r_{k}" for k in keys])


def streaks(
    df: DataFrame,
    group: list[str],
    order_cols: list[str],
    hit: Column,
    reset: Column,
    bucket: Column,
    name: str = "streak",
) -> DataFrame:
    """Running count of ``hit`` rows since the last ``reset`` row, per group.

    ``bucket`` is any expression that never decreases along ``order_cols``. Rows are
    counted inside (group, bucket) and the counts carried from bucket to bucket,
    so a group with a third of all rows spreads over its buckets; only one row
    per bucket goes through the group-wide window.
    """
    rows = df.withColumn("__b", bucket).withColumn("__hit", hit.cast("long")).withColumn("__reset", reset.cast("long"))
    local = W.partitionBy(*group, "__b").orderBy(*order_cols).rowsBetween(W.unboundedPreceding, W.currentRow)
    rows = rows.withColumn("__seg", F.sum("__reset").over(local))
    in_segment = W.partitionBy(*group, "__b", "__seg").orderBy(*order_cols).rowsBetween(W.unboundedPreceding, W.currentRow)
    rows = rows.withColumn("__run", F.sum("__hit").over(in_segment))

    # Per bucket: is there a reset, and how many hits follow the last one. Same
    # partitioning as the windows above, so no further shuffle of the rows.
    per_bucket = rows.groupBy(*group, "__b").agg(
        F.max(F.when(F.col("__seg") > 0, 1).otherwise(0)).alias("__has_reset"),
        F.max_by("__run", F.struct(*order_cols)).alias("__tail"),
    )
    order_b = W.partitionBy(*group).orderBy("__b")
    per_bucket = per_bucket.withColumn(
        "__island", F.sum("__has_reset").over(order_b.rowsBetween(W.unboundedPreceding, W.currentRow))
    )
    running = F.sum("__tail").over(
        W.partitionBy(*group, "__island").orderBy("__b").rowsBetween(W.unboundedPreceding, W.currentRow)
    )
    per_bucket = per_bucket.withColumn("__upto", running)
    carry = per_bucket.select(*group, "__b", F.lag("__upto", 1, 0).over(order_b).alias("__carry"))
    joined = null_safe_join(rows, carry, [*group, "__b"])
    total = F.when(F.col("__seg") == 0, F.col("__run") + F.col("__carry")).otherwise(F.col("__run"))
    return joined.withColumn(name, total).drop("__b", "__hit", "__reset", "__seg", "__run", "__carry")


def order_bucket(df: DataFrame, col: str) -> Column:
    """A coarse, never decreasing bucket of an order column: hours of a time, blocks of a number."""
    dtype = df.schema[col].dataType
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.floor(F.unix_micros(F.col(col).cast("timestamp")) / 3_600_000_000)
    return F.floor(F.col(col) / 100_000)


def global_row_number(df: DataFrame, order_col: str, name: str = "row_no", buckets: int | None = None,
                      ties: tuple[str, ...] = ()) -> DataFrame:
    """1-based position by a numeric ``order_col`` without a single-task sort.

    ``ties`` are the columns that put rows of equal ``order_col`` in order; few rows may share one.

    The value range is cut at a bounded number of quantiles (the only thing the
    driver sees); rows are numbered inside their slice and shifted by the sizes
    of the slices before it. ``buckets`` defaults to twice the shuffle partitions.
    """
    buckets = buckets or max(64, 2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    probes = [i / buckets for i in range(1, buckets)]
    cuts = sorted(set(df.approxQuantile(order_col, probes, 1.0 / (2 * buckets))))
    edges = F.array(*[F.lit(float(c)) for c in cuts]) if cuts else F.array().cast("array<double>")
    slice_no = F.size(F.filter(edges, lambda e: e < F.col(order_col).cast("double")))
    sliced = df.withColumn("__slice", slice_no)
    sizes = sliced.groupBy("__slice").agg(F.count(F.lit(1)).alias("__n"))
    # At most `buckets` rows reach this window.
    before = F.sum("__n").over(W.orderBy("__slice").rowsBetween(W.unboundedPreceding, -1))
    offsets = sizes.select("__slice", F.coalesce(before, F.lit(0)).alias("__before"))
    local = F.row_number().over(W.partitionBy("__slice").orderBy(order_col, *ties))
    return (
        sliced.withColumn("__local", local)
        .join(F.broadcast(offsets), "__slice")
        .withColumn(name, F.col("__local") + F.col("__before"))
        .drop("__slice", "__local", "__before")
    )


def frequent_lookup(df: DataFrame, lookup: DataFrame, key: str, hot_keys: int = 256) -> DataFrame:
    """Left join on ``key`` (one lookup row a key) for keys that may hold any share of the rows.

    The ``hot_keys`` most frequent keys get their row from a broadcast of as many rows; what is left is joined by a
    shuffle, where a key has less than one row in ``hot_keys``. Rows without a key or with a hot one
    take a salted stand-in there.
    """
    added = [c for c in lookup.columns if c != key]
    rows = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("__n"))
    hot = rows.orderBy(F.desc("__n"), key).limit(hot_keys).join(lookup, key, "left").select(
        F.col(key).alias("__hot"), F.struct(*added).alias("__row"))
    known = df.join(F.broadcast(hot), F.col(key) == F.col("__hot"), "left")
    known = known.withColumn("__key", F.when(F.col("__hot").isNull(), F.col(key)))
    rest = lookup.select(F.col(key).alias("__key"), F.struct(*added).alias("__found"))
    out = left_lookup(known, rest, ["__key"])
    return out.select(*df.columns, *[F.coalesce(F.col("__row")[c], F.col("__found")[c]).alias(c) for c in added])


def left_lookup(df: DataFrame, lookup: DataFrame, keys: list[str]) -> DataFrame:
    """Left join on ``keys`` that spreads rows whose key is NULL.

    Rows without a key can never match, so they take a salted stand-in key
    instead of meeting in one reducer; hot real keys are split by AQE.
    """
    salt = F.concat(F.lit("\u0000"), F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns
                                                          if df.schema[c].dataType.typeName() not in ("variant", "map")]),
                                              F.lit(512)).cast("string"))
    left, right = df, lookup
    conds = []
    missing = F.lit(False)
    for k in keys:
        missing = missing | F.col(f"`{k}`").isNull()
    for i, k in enumerate(keys):
        stand_in = salt if i == 0 else F.lit("")
        left = left.withColumn(f"__l{i}", F.when(missing, stand_in).otherwise(F.col(f"`{k}`").cast("string")))
        right = right.withColumn(f"__r{i}", F.col(f"`{k}`").cast("string")).drop(k)
        conds.append(F.col(f"__l{i}") == F.col(f"__r{i}"))
    out = left.join(right, conds, "left")
    return out.drop(*[f"__l{i}" for i in range(len(keys))], *[f"__r{i}" for i in range(len(keys))])
