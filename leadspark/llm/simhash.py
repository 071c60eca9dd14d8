"""Near-duplicates by SimHash fingerprints and Golay-code fuzzy hashing.

A fingerprint of 64 bits has three segments A (23), B (23) and C (18 bits). Every 23-bit word
lies within 3 bits of exactly one word of the perfect Golay code; taking also the code words
at 4 bits gives one or six code numbers, and any two words that differ in up to 2 bits share
one (the code word nearest to a word between them is within 4 of both). Four errors spread
over the segments leave always one of these keys equal on both sides:

    no error in C                  C whole with A's or B's code (one of them has 2 errors at most)
    no error in A, or in B         that segment whole
    (A,B,C) = (1|2,1,1)            A's code, the equal half of B, the equal half of C
    (1,2,1)                        B's code, the equal half of A, the equal half of C
    (1,1,2)                        the equal halves of A and B

so the join on keys loses no pair; candidates are verified by their differing bits. Keys are
joined for distinct fingerprints, and a bucket gives a spanning set of its links, never its
pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import map_batches, pick, position, stored
from .components import connected_components

#: Rows of a bucket compared within one step; the rest of a larger bucket is compared block by block.
BLOCK = 4096


def shingle_hashes(text: str, words: int, seed: int = 42) -> np.ndarray:
    """Hashes of the ``words``-word shingles in their order (repeats too), ASCII letters lower-cased; none without words."""
    tokens = text.encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return np.zeros(0, dtype="<u8")
    line, n = b" ".join(tokens), max(1, len(tokens) - words + 1)
    starts = np.zeros(len(tokens) + 1, dtype=np.int64)
    np.cumsum([len(t) + 1 for t in tokens], out=starts[1:])
    ends = (starts[min(words, len(tokens)) :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    return np.array([digest(line[a:b], seed) for a, b in zip(starts[:n].tolist(), ends, strict=False)], dtype="<u8")


def fingerprint(text: str, words: int = 4, seed: int = 42) -> int:
    """SimHash of the ``words``-word shingles (repeats count), ASCII letters lower-cased; 0 without words."""
    hashes = shingle_hashes(text, words, seed)
    n = len(hashes)
    if not n:
        return 0
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, n, 1 << 16):
        part = hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def document_fingerprints(docs: DataFrame, words: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_hash, fp): the fingerprint of each whole text as a signed 64-bit number."""
    source = pick(docs, doc_id=id_col, text=text_col).select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.xxhash64("text").alias("text_hash"))

    def start():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            fps = np.array([fingerprint(t or "", words) for t in batch.column(1).to_pylist()], dtype=np.uint64)
            return pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(fps.view(np.int64))], names=["doc_id", "text_hash", "fp"])

        return step

    return map_batches(source, start, "doc_id long, text_hash long, fp long")


def golay_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(parity of each 12-bit message, error patterns by syndrome, how many of those).

    From the generator polynomial x^11+x^10+x^6+x^5+x^4+x^2+1: the first pattern of a syndrome is
    the one of weight 3 at most; where that is of weight 3, the five of weight 4 follow.
    """
    generator = 0b110001110101
    parity = np.zeros(4096, dtype=np.int64)
    for message in range(4096):
        rest = message << 11
        for bit in range(22, 10, -1):
            if rest >> bit & 1:
                rest ^= generator << (bit - 11)
        parity[message] = rest
    syndrome_of = [int(parity[1 << (bit - 11)]) if bit >= 11 else 1 << bit for bit in range(23)]
    patterns, counts = np.zeros((2048, 6), dtype=np.int64), np.zeros(2048, dtype=np.int64)

    def add(weight: int, first: int, pattern: int, syndrome: int) -> None:
        if not weight:
            if not counts[syndrome] or patterns[syndrome, 0].bit_count() + pattern.bit_count() == 7:
                patterns[syndrome, counts[syndrome]] = pattern
                counts[syndrome] += 1
            return
        for bit in range(first, 23):
            add(weight - 1, bit + 1, pattern | 1 << bit, syndrome ^ syndrome_of[bit])

    for weight in range(5):
        add(weight, 0, 0, 0)
    return parity, patterns, counts


class GolayKeys:
    """Join keys of fingerprints."""

    def __init__(self):
        self.parity, self.patterns, self.counts = golay_tables()

    def codes(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, code number) of the code words near each 23-bit word."""
        syndrome = self.parity[words >> 11] ^ (words & 2047)
        count = self.counts[syndrome]
        row = np.repeat(np.arange(len(words)), count)
        which = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
        return row, (words[row] ^ self.patterns[syndrome[row], which]) >> 11

    def __call__(self, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(key, fingerprint) rows; a key starts with the number of its rule."""
        bits = fps.view(np.uint64)
        a, b, c = ((bits >> np.uint64(s) & np.uint64((1 << n) - 1)).astype(np.int64) for s, n in ((41, 23), (18, 23), (0, 18)))
        halves_a, halves_b, halves_c = (a >> 11, a & 2047), (b >> 11, b & 2047), (c >> 9, c & 511)
        row_a, code_a = self.codes(a)
        row_b, code_b = self.codes(b)
        keys, rows, every = [], [], np.arange(len(fps))
        tables = [(row_a, code_a << 18 | c[row_a]), (row_b, code_b << 18 | c[row_b]), (every, a), (every, b)]
        for row, code, halves in ((row_a, code_a, halves_b), (row_b, code_b, halves_a)):
            tables += [(row, (code << 12 | h[row]) << 9 | k[row]) for h in halves for k in halves_c]
        tables += [(every, h << 12 | k) for h in halves_a for k in halves_b]
        for rule, (row, key) in enumerate(tables):
            rows.append(row)
            keys.append(rule << 40 | key)
        return np.concatenate(keys), fps[np.concatenate(rows)]


def spanning_links(keys: np.ndarray, fps: np.ndarray, most: int, sides: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Links within runs of equal keys (sorted) that connect all that links of ``most`` bits connect.

    Rows are compared at growing distances; a link is kept when its ends do not yet carry the
    same label, and equal labels are only ever handed along kept links. With ``sides``, only
    rows of different sides are compared.
    """
    label, bits = np.arange(len(keys)), fps.view(np.uint64)
    left, right = [], []
    active = np.arange(len(keys) - 1)
    step = 1
    while len(active):
        active = active[active + step < len(keys)]
        active = active[keys[active] == keys[active + step]]
        near = np.bitwise_count(bits[active] ^ bits[active + step]) <= most
        if sides is not None:
            near &= sides[active] != sides[active + step]
        i = active[near]
        j = i + step
        new = label[i] != label[j]
        i, j = i[new], j[new]
        if len(i):
            least = np.minimum(label[i], label[j])
            np.minimum.at(label, i, least)
            np.minimum.at(label, j, least)
            left.append(fps[i])
            right.append(fps[j])
        step += 1
    empty = np.zeros(0, dtype=np.int64)
    return (np.concatenate(left) if left else empty), (np.concatenate(right) if right else empty)


def fingerprint_links(fps: DataFrame, most: int = 4) -> DataFrame:
    """Links (a, b) among distinct fingerprints ``fp`` whose closure is that of all links of ``most`` bits (4 at most).

    Buckets are streamed in key order, a block of ``BLOCK`` rows at a time. The blocks of a
    larger bucket are compared within; pairs of its blocks become groups of their own.
    """
    if not 0 <= most <= 4:
        raise ValueError("the keys find links of 4 bits at most")

    def start():
        keys_of = GolayKeys()

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            key, fp = keys_of(batch.column(0).to_numpy())
            return pa.RecordBatch.from_arrays([pa.array(key), pa.array(fp)], names=["key", "fp"])

        return step

    keyed = map_batches(fps.select("fp"), start, "key long, fp long", rows=4000).repartition("key").sortWithinPartitions("key", "fp")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Links as (NULL, NULL, a, b); rows of buckets of several blocks as (key, block, fp, NULL)."""
        keys, values, block, open_key = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), 0, None

        def flush(keys: np.ndarray, values: np.ndarray, spread: int | None) -> Iterator[pa.RecordBatch]:
            a, b = spanning_links(keys, values, most)
            if len(a):
                none = pa.nulls(len(a), pa.int64())
                yield pa.RecordBatch.from_arrays([none, none, pa.array(a), pa.array(b)], names=["key", "block", "a", "b"])
            if spread is not None:
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(np.full(len(keys), spread)), pa.array(values), pa.nulls(len(keys), pa.int64())], names=["key", "block", "a", "b"])

        for batch in batches:
            keys, values = np.concatenate([keys, batch.column(0).to_numpy()]), np.concatenate([values, batch.column(1).to_numpy()])
            while len(keys):
                last = int(np.searchsorted(keys, keys[-1]))  # the run that may go on
                if open_key is not None and keys[0] != open_key:
                    open_key, block = None, 0
                if open_key is None and last:
                    # whole runs, but for one that is longer than a block
                    first = int(np.searchsorted(keys, keys[0], side="right"))
                    if first <= BLOCK:
                        ends = np.flatnonzero(np.append(keys[1:] != keys[:-1], False)) + 1
                        sizes = np.diff(np.append(0, ends))
                        long = np.flatnonzero(sizes > BLOCK)
                        upto = int(ends[long[0] - 1]) if len(long) else last
                        yield from flush(keys[:upto], values[:upto], None)
                        keys, values = keys[upto:], values[upto:]
                        continue
                first = int(np.searchsorted(keys, keys[0], side="right"))
                if first > BLOCK or (open_key is not None and first < len(keys)):
                    take = min(first, BLOCK)
                    open_key = int(keys[0])
                    yield from flush(keys[:take], values[:take], block)
                    block += 1
                    keys, values = keys[take:], values[take:]
                    continue
                break
        if len(keys):
            yield from flush(keys, values, block if open_key is not None and keys[0] == open_key else None)

    found = stored(keyed.mapInArrow(compare, "key long, block long, a long, b long"), "simhash-links")
    links = found.where("key IS NULL").select("a", "b")
    wide = found.where("key IS NOT NULL").select("key", "block", F.col("a").alias("fp"))
    spans = wide.groupBy("key").agg(F.max("block").alias("top"))
    dealt = wide.join(spans, "key").where("top > 0").select(
        "key", "fp", "block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("top"))).alias("other")).where("other <> block").select(
        "key", "fp", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))

    def across(table: pa.Table) -> pa.Table:
        fps, side = table.column("fp").to_numpy(), table.column("block").to_numpy()
        order = np.lexsort((fps, side))
        a, b = spanning_links(np.zeros(len(fps), dtype=np.int64), fps[order], most, side[order])
        return pa.table({"a": a, "b": b})

    return links.unionAll(dealt.groupBy("key", "i", "j").applyInArrow(across, "a long, b long"))


def near_duplicates(docs: DataFrame, words: int = 4, most: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_hash, fp, group_fp, component_id) for every row of ``docs``.

    ``component_id`` is the least doc_id reachable over links of ``most`` differing bits,
    ``group_fp`` the least fingerprint. NULL, empty and wordless texts have fingerprint 0 and link
    like others; repeated rows come back as often; NULL ids get the least id of their component,
    if it has one. Extra columns are ignored, an empty table gives no rows, texts count whole.
    """
    prints = stored(document_fingerprints(docs, words, id_col, text_col), "fingerprints")
    first = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("doc")), "first-of-fingerprint")
    roots = connected_components(fingerprint_links(first.select("fp"), most))
    # Only fingerprints with a link have a root.
    linked = first.join(roots, F.col("fp") == F.col("node")).select("fp", "doc", "root")
    least = linked.groupBy("root").agg(F.min("doc").alias("component"))
    owner = linked.join(least, "root").select("fp", "component", "root")
    known = stored(first.join(owner, "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("group_fp"), F.coalesce("component", "doc").alias("component_id")), "component-of-fingerprint")
    return prints.join(known, "fp").select("doc_id", "text_hash", "fp", "group_fp", "component_id")


def keep_one_of_each(docs: DataFrame, words: int = 4, most: int = 4) -> DataFrame:
    """One row of each near-duplicate group: that of the least doc_id (NULL last), all columns as they were.

    Of rows that share it, the one with the least text hash stays, once. NULL, empty and wordless texts
    are one group; an empty table stays empty.
    """
    return keep_first(docs, near_duplicates(docs, words, most), "group_fp")


def keep_first(docs: DataFrame, near: DataFrame, group: str) -> DataFrame:
    """The one row of each ``group`` of ``near`` (doc_id, text_hash, group) that ``keep_one_of_each`` names."""
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"), F.col("text_hash").alias("hash"))
    kept = near.groupBy(group).agg(F.min(order).alias("first")).select(F.col("first.id").alias("kept_id"), F.col("first.hash").alias("kept_hash"))
    names = docs.columns
    flat = docs.toDF(*[f"c{i}" for i in range(len(names))])
    own_id, own_hash = F.col(f"c{position(names, 'doc_id')}"), F.xxhash64(f"c{position(names, 'text')}")
    rows = flat.withColumn("own_id", own_id).withColumn("own_hash", own_hash).join(
        kept, F.col("own_id").eqNullSafe(F.col("kept_id")) & (F.col("own_hash") == F.col("kept_hash")), "left_semi")
    turn = F.row_number().over(W.partitionBy("own_id", "own_hash").orderBy("own_id"))
    return rows.withColumn("turn", turn).where("turn = 1").select(*[f"c{i}" for i in range(len(names))]).toDF(*names)
