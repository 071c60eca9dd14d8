"""Near-duplicates by word shingles: texts whose sets of five-word shingles are alike to 0.8 or more.

Candidates are SimHash links and texts that share a band of min-hashes: two texts of similarity
s have the same least hash with chance s, so one of 32 bands of five is equal with chance
1 - (1 - s**5)**32: 0.999997 at 0.8, more above. Every link is then checked by the exact similarity of
the two sets. A band's texts are first compared with its least one; texts that this leaves outside the
band's largest group are compared with all of the band that they are not connected with, if their
parity maps allow it: a shingle flips one bit of a map, so maps differ in at most as many bits as the sets differ in
shingles, and a pair of the wanted similarity never differs in more. That leaves few pairs but links.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_batches, pick, stored
from .components import connected_components
from .simhash import fingerprint, fingerprint_links, keep_first, shingle_hashes

#: Words of a shingle.
WORDS = 5
#: Least similarity: so many common shingles of so many.
COMMON, OF = 4, 5
#: Bands of min-hashes and hashes of a band.
BANDS, ROWS = 32, 5
#: Words (of 64 bits) of a parity map; sets with more shingles than ``WIDE_FROM`` also have a wide one,
#: of four bits a shingle or more.
PARITY_WORDS, WIDE_FROM = 16, 2048
#: Shingles hashed at a time.
BLOCK = 1024

_DRAWN = np.random.default_rng(5).integers(0, 2**64, (2, BANDS * ROWS), dtype=np.uint64)
_TIMES, _PLUS = _DRAWN[0] | np.uint64(1), _DRAWN[1]


def shingle_set(text: str) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles; none without words."""
    return np.unique(shingle_hashes(text, WORDS))


def band_keys(hashes: np.ndarray) -> list[int]:
    """One signed 64-bit key for each band of a set that is not empty."""
    least = np.full(BANDS * ROWS, 2**64 - 1, dtype=np.uint64)
    for at in range(0, len(hashes), BLOCK):
        np.minimum(least, (hashes[at : at + BLOCK, None] * _TIMES + _PLUS).min(axis=0), out=least)
    keys = [xxhash.xxh64_intdigest(least[b * ROWS : (b + 1) * ROWS].tobytes(), b) for b in range(BANDS)]
    return np.array(keys, dtype=np.uint64).view(np.int64).tolist()


def parity_map(held: np.ndarray, words: int) -> np.ndarray:
    """``words`` longs (a power of two): a bit is set if an odd number of hashes ends in its place."""
    bits = np.bincount((held & np.uint64(64 * words - 1)).astype(np.int64), minlength=64 * words).astype(np.uint8) & 1
    return np.packbits(bits, bitorder="little").view("<i8")


def wide_map(held: np.ndarray) -> list[int] | None:
    if len(held) <= WIDE_FROM:
        return None
    return parity_map(held, 1 << (4 * len(held) // 64).bit_length()).tolist()


def may_be_alike(a: str, b: str) -> Column:
    """Whether rows aliased ``a`` and ``b`` (n, parity, wide) can be alike; never false for a pair that is.

    Sets of n and m shingles with COMMON of OF in common differ in (n + m) * (OF - COMMON) / (OF + COMMON)
    shingles at most. Of two wide maps the longer is folded onto the shorter.
    """
    n = F.col(f"{a}.n") + F.col(f"{b}.n")

    def few(different: Column) -> Column:
        return (OF + COMMON) * different <= (OF - COMMON) * n

    def folded(long: Column, short: Column) -> Column:
        half = F.size(short)
        return F.when(F.size(long) == half, long).otherwise(
            F.zip_with(F.slice(long, F.lit(1), half), F.slice(long, half + 1, half), lambda x, y: x.bitwiseXOR(y)))

    def apart(x: Column, y: Column) -> Column:
        return F.aggregate(F.zip_with(x, y, lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda t, v: t + v)

    narrow = sum((F.bit_count(F.get(f"{a}.parity", i).bitwiseXOR(F.get(f"{b}.parity", i))) for i in range(PARITY_WORDS)), F.lit(0))
    x, y = F.col(f"{a}.wide"), F.col(f"{b}.wide")
    sizes = F.least(F.col(f"{a}.n"), F.col(f"{b}.n")) * OF >= F.greatest(F.col(f"{a}.n"), F.col(f"{b}.n")) * COMMON
    wide = F.when(F.size(x) >= F.size(y), apart(folded(x, y), y)).otherwise(apart(x, folded(y, x)))
    return sizes & few(narrow) & (x.isNull() | y.isNull() | few(wide))


def alike(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sets (sorted, distinct) have COMMON of OF shingles in common."""
    if OF * min(len(a), len(b)) < COMMON * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return OF * both >= COMMON * (len(a) + len(b) - both)


def _prints(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, fp, set_id, n, bands) of every row; texts with equal sets have one ``set_id``."""
    source = pick(docs, doc_id="doc_id", text="text").select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.xxhash64("text").alias("text_hash"))

    def start():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            fps, ids, sizes, bands = [], [], [], []
            for text in batch.column(1).to_pylist():
                held = shingle_set(text or "")
                fps.append(fingerprint(text or ""))
                ids.append(xxhash.xxh64_intdigest(held.tobytes()) if len(held) else 0)
                sizes.append(len(held))
                bands.append(band_keys(held) if len(held) else [])
            signed = [pa.array(np.array(x, dtype=np.uint64).view(np.int64)) for x in (fps, ids)]
            return pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), *signed, pa.array(sizes, pa.int64()), pa.array(bands, pa.list_(pa.int64()))],
                                              names=["doc_id", "text_hash", "fp", "set_id", "n", "bands"])

        return step

    return map_batches(source, start, "doc_id long, text_hash long, fp long, set_id long, n long, bands array<long>")


def _sets_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(set_id, held, parity, wide) for the rows (set_id, text_hash) of ``wanted``: the hashes of the set as bytes, its parity maps."""
    text = pick(docs, text="text").select(F.col("text").cast("string"), F.xxhash64("text").alias("text_hash"))
    found = text.groupBy("text_hash").agg(F.first("text").alias("text")).join(wanted, "text_hash").select("set_id", "text")

    def start():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            sets = [shingle_set(t or "") for t in batch.column(1).to_pylist()]
            maps = [[parity_map(held, PARITY_WORDS).tolist() for held in sets], [wide_map(held) for held in sets]]
            return pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([held.tobytes() for held in sets], pa.binary()), *(pa.array(m, pa.list_(pa.int64())) for m in maps)],
                names=["set_id", "held", "parity", "wide"])

        return step

    return map_batches(found, start, "set_id long, held binary, parity array<long>, wide array<long>")


def _verified(pairs: DataFrame, sets: DataFrame, name: str) -> DataFrame:
    """Those pairs (a, b) of sets that are alike."""
    sets = sets.select("set_id", "held")
    both = pairs.join(sets.toDF("b", "held_b"), "b").join(sets.toDF("a", "held_a"), "a").select("a", "b", "held_a", "held_b")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = [[np.frombuffer(x.as_buffer(), dtype="<u8") for x in batch.column(i)] for i in (2, 3)]
            good = pa.array([alike(a, b) for a, b in zip(*held, strict=True)], pa.bool_())
            yield batch.select(["a", "b"]).filter(good)

    return stored(both.mapInArrow(check, "a long, b long"), name)


def near_copies(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, group_id) for every row of ``docs``.

    Rows have one ``group_id`` if links of similarity 0.8 or more connect them. NULL, empty and
    wordless texts are one group. Repeated rows and NULL ids come back as often, extra columns are
    ignored, an empty table gives no rows, texts count whole.
    """
    prints = stored(_prints(docs), "shingle-prints")
    sets = stored(prints.where("n > 0").groupBy("set_id").agg(F.min("text_hash").alias("text_hash"), F.first("n").alias("n"), F.first("bands").alias("bands")), "shingle-sets")
    keyed = sets.select("set_id", "n", F.explode("bands").alias("key"))
    # Bands that hold the same sets are one.
    shared = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.min("set_id").alias("least"), F.bit_xor(F.xxhash64("set_id")).alias("mark")).where("size > 1")
    bands = shared.groupBy("size", "least", "mark").agg(F.min("key").alias("key")).select("key", "least")
    members = stored(keyed.join(bands, "key").select("key", "least", "set_id", "n"), "band-members")

    of_print = stored(prints.where("n > 0").groupBy("fp").agg(F.min("set_id").alias("first")), "first-set-of-fingerprint")
    # Many buckets give the same link.
    near = fingerprint_links(of_print.select("fp")).distinct().toDF("a", "b").join(of_print.toDF("a", "first_a"), "a").join(of_print.toDF("b", "first_b"), "b")
    same = prints.where("n > 0").select("fp", "set_id").distinct().join(of_print, "fp")
    pairs = members.select("least", "set_id").unionAll(near.select("first_a", "first_b")).unionAll(same.select("first", "set_id")).toDF("x", "y").where("x <> y")
    pairs = stored(pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "shingle-pairs")

    wanted = pairs.select(F.col("a").alias("set_id")).unionAll(pairs.select("b")).distinct()
    held = stored(_sets_of(docs, sets.select("set_id", "text_hash").join(wanted, "set_id")), "held-sets")
    roots = stored(connected_components(_verified(pairs, held, "shingle-links")), "first-roots")
    placed = stored(members.join(roots, F.col("set_id") == F.col("node"), "left").select("key", "set_id", "n", F.coalesce("root", "set_id").alias("root")), "placed-members")
    parts = placed.groupBy("key", "root").agg(F.count(F.lit(1)).alias("size")).groupBy("key").agg(F.count(F.lit(1)).alias("parts"), F.max(F.struct("size", "root")).alias("top"))
    mixed = parts.where("parts > 1").select("key", F.col("top.root").alias("main"))
    around = stored(placed.join(mixed, "key").join(held.drop("held"), "set_id"), "mixed-band-members")
    outside = around.where("root <> main").alias("x")
    more = outside.join(around.alias("y"), (F.col("x.key") == F.col("y.key")) & (F.col("x.root") != F.col("y.root")) & (
        (F.col("y.root") == F.col("y.main")) | (F.col("x.set_id") < F.col("y.set_id"))) & may_be_alike("x", "y"))
    more = more.select(F.least("x.set_id", "y.set_id").alias("a"), F.greatest("x.set_id", "y.set_id").alias("b")).distinct().join(pairs, ["a", "b"], "left_anti")
    # What the first links connect is a star around each root by now: an edge a set, however many links it had.
    stars = roots.where("node <> root").toDF("a", "b")
    roots = connected_components(stars.unionAll(_verified(more, held, "more-shingle-links")))
    return prints.join(roots, F.col("set_id") == F.col("node"), "left").select("doc_id", "text_hash", F.coalesce("root", "set_id").alias("group_id"))


def keep_one_of_each(docs: DataFrame) -> DataFrame:
    """One row of each group of near copies: that of the least doc_id (NULL last), all columns as they were.

    Of rows that share it, the one with the least text hash stays, once.
    """
    return keep_first(docs, near_copies(docs), "group_id")
