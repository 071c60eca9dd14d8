"""Bottom-k sketches of shingle hashes, in DataFrame functions only.

A sketch is the sorted array of the ``k`` least distinct 64-bit hashes of a text's word
shingles. The sketch of a union follows from the sketches of its parts, so parts of a corpus
can be sketched apart and merged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import pick

#: Words of a shingle and hashes of a sketch.
WORDS, SIZE = 5, 128


def _least(hashes: Column, k: int) -> Column:
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)


def bottom_k(text: Column, words: int = WORDS, k: int = SIZE) -> Column:
    """Sketch of a text: its shingles are runs of ``words`` words between white space, the whole
    text where it has fewer; NULL, empty and blank texts have the empty sketch."""
    tokens = F.filter(F.split(F.coalesce(text, F.lit("")), r"[ \t\n\x0B\f\r]+"), lambda w: w != "")

    def hashes(held: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(held) - (words - 1), F.lit(1)))
        return F.when(F.size(held) > 0, F.transform(starts, lambda i: F.xxhash64(F.slice(held, i, words)))).otherwise(F.array().cast("array<bigint>"))

    # The words are the variable of a lambda: written out, they would be split anew for every shingle.
    return _least(F.flatten(F.transform(F.array(tokens), hashes)), k)


def union_sketch(a: Column, b: Column, k: int = SIZE) -> Column:
    return _least(F.concat(a, b), k)


def resemblance(a: Column, b: Column, k: int = SIZE) -> Column:
    """Estimated share of common shingles in all shingles of two texts; 1 where both have none.

    Exact while the union has at most ``k`` shingles.
    """
    union = union_sketch(a, b, k)
    both = F.size(F.array_intersect(union, F.array_intersect(a, b)))
    return F.when(F.size(union) == 0, F.lit(1.0)).otherwise(both / F.size(union))


def distinct_shingles(a: Column, k: int = SIZE) -> Column:
    """Estimated number of distinct shingles; exact below ``k``."""
    share = (F.element_at(a, -1).cast("double") + 2.0**63) / 2.0**64
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise(F.lit(k - 1.0) / share)


def containment(a: Column, b: Column, k: int = SIZE) -> Column:
    """Estimated share of a's shingles that b has too; 1 where a has none."""
    of_union = resemblance(a, b, k) * distinct_shingles(union_sketch(a, b, k), k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), of_union / distinct_shingles(a, k)))


def merge_sketches(parts: DataFrame, keys: list[str], sketch_col: str = "sketch", k: int = SIZE) -> DataFrame:
    """One sketch per key of any number of partial ones: (keys, sketch).

    Hashes are distinct before they are ranked, and the rank limit applies on the map side, so
    that no task gets more than ``k`` hashes of a key from another. NULL and empty sketches merge to the
    empty one, a NULL key is a key, repeated sketches change nothing, extra columns are ignored, an
    empty table gives no rows.
    """
    hashes = parts.select(*keys, F.explode_outer(sketch_col).alias("hash")).distinct()
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(F.col("hash").asc_nulls_last()))
    kept = hashes.withColumn("rank", rank).where(F.col("rank") <= k)
    return kept.groupBy(*keys).agg(F.sort_array(F.collect_list("hash")).alias("sketch"))


def shown(sketch: Column) -> Column:
    """The hashes of a sketch as one string, 16 hexadecimal digits each."""
    return F.array_join(F.transform(sketch, lambda h: F.lpad(F.hex(h), 16, "0")), "")


def with_next(docs: DataFrame, columns: list[str], slices: int | None = None) -> DataFrame:
    """``docs`` (a column doc_id among others) with ``next_<c>`` of the next row by descending doc_id.

    After the last row comes the first. Rows with equal ids follow each other by ``columns``,
    NULL ids come last. Ids are cut into slices at quantiles; the first row of a slice is also
    sent to the slice above, so no task sees more than a slice. The driver sees one id per slice.
    """
    slices = slices or max(64, 2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ids = docs.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("double").alias("v"))
    probes = [i / slices for i in range(1, slices)]
    cuts = sorted(set(ids.approxQuantile("v", probes, 1 / (2 * slices)))) if probes else []
    edges = F.array(*[F.lit(c) for c in cuts]) if cuts else F.array().cast("array<double>")
    number = F.coalesce(F.size(F.filter(edges, lambda e: e <= F.col("doc_id").cast("double"))), F.lit(-1))
    placed = docs.withColumn("slice", F.when(F.col("doc_id").isNull(), F.lit(-1)).otherwise(number))
    heads = {r["slice"]: r["head"] for r in placed.groupBy("slice").agg(F.max("doc_id").alias("head")).collect()}
    order = sorted(heads)
    # The head of each slice follows the last row of the next one above, the top one that of the lowest.
    targets = [(s, order[(i + 1) % len(order)]) for i, s in enumerate(order)]
    above = F.create_map(*[F.lit(x) for pair in targets for x in pair]) if targets else F.create_map(F.lit(0), F.lit(0))
    head = F.create_map(*[x for s in order for x in (F.lit(s), F.lit(heads[s]).cast("bigint"))]) if order else F.create_map(F.lit(0), F.lit(0).cast("bigint"))
    again = F.col("doc_id").eqNullSafe(head[F.col("slice")])
    copies = F.when(again, F.array(F.struct(F.col("slice").alias("slice"), F.lit(False).alias("guest")), F.struct(above[F.col("slice")].alias("slice"), F.lit(True).alias("guest")))).otherwise(
        F.array(F.struct(F.col("slice").alias("slice"), F.lit(False).alias("guest"))))
    dealt = placed.withColumn("place", F.explode(copies)).withColumn("slice", F.col("place.slice")).withColumn("guest", F.col("place.guest")).drop("place")
    in_slice = W.partitionBy("slice").orderBy("guest", F.col("doc_id").desc_nulls_last(), *columns)
    for c in columns:
        dealt = dealt.withColumn(f"next_{c}", F.lead(c).over(in_slice))
    return dealt.where(~F.col("guest")).drop("slice", "guest")


def document_fingerprints(docs: DataFrame, words: int = WORDS, k: int = SIZE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Sketches of every whole text, of its edited text, and of the next document's.

    Edited: the last third (code points, rounded down) gives way to as many of the next
    document's first ones, or all it has. Columns: doc_id, n_chars, edited, sketch,
    edited_sketch, next_sketch. NULL and empty texts have the empty sketch; a table of one row is
    its own next document; repeated rows and NULL ids come back as they are; an empty table
    gives no rows.
    """
    source = pick(docs, doc_id=id_col, text=text_col).select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = with_next(source.withColumn("sketch", bottom_k(F.col("text"), words, k)), ["text", "sketch"])
    size = F.length("text")
    cut = F.floor(size / 3).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), size - cut), F.substring("next_text", F.lit(1), cut))
    return rows.select(
        "doc_id", size.cast("long").alias("n_chars"), edited.alias("edited"), "sketch", F.col("next_sketch")
    ).withColumn("edited_sketch", bottom_k(F.col("edited"), words, k))
