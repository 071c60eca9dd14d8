"""Exact similarity join on token-sorted names.

The result equals comparing every pair, without comparing every pair. Work is
done on *distinct* sorted-token strings ("nodes"):

* Two strings with ratio >= T share at least ``(la+lb)(1.5T/100 - 1) - 1``
  character pairs (a deletion breaks at most two, an insertion one). So each
  node emits only its rarest grams, just enough that any partner must share
  one (prefix filter). Where that bound gives nothing (very short strings, low
  T) the same is done with single characters.
* A node meets only nodes whose length can still reach T (length bands in the
  block key). 256-bit signatures of letter counts and of grams bound the edits
  and the shared grams (bitmap filters), and the built-in Levenshtein distance, never above the insert/delete
  distance, ends most comparisons inside the JVM. No filter drops a true pair.
* A pair is let through only at its first shared gram, so candidates need no
  ``distinct`` and no shuffle of their own.
* Block sizes are estimated in a fixed-size hashed histogram. One side of a big
  block is split at random and the other copied to the splits, so a hot gram
  becomes many tasks.

Short names of few lengths need no grams: two of them match exactly if they share a subsequence of the length that
the threshold asks for, and after their common beginning is taken off there are few of these (``common_keys``).

Names of at most 64 characters whose grams are so common that blocks would meet more pairs than there are (whole titles at a
low threshold) are compared block against block instead: each pair once, a name against some blocks at a time (``_cell_pairs``).

Grams, signatures and the final bit-vector LCS are expressions; only these blocks are compared in Python workers, and the grams
counted that choose this way.
"""

from __future__ import annotations

import math
import os
from collections import Counter
from collections.abc import Iterable
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import characters, lcs_length, let
from ..session import cut_lineage
from .grouping import shuffled

GRAM_BUCKETS = 4096
BLOCK_BUCKETS = 16384
BITMAP_WORDS = 4
EPS = 1e-9
#: Subsequences a node may have on average, and at most, for pairs to be found by them.
KEYS_PER_NODE, MOST_KEYS = 64, 1024
#: Pairs of lengths that the expression of the subsequences may tell apart.
KEY_CASES = 100
#: Names of a block that is compared as a whole, at least and at most, and the longest of them (bits of a word).
LEAST_CELL, CELL_ROWS, CELL_CHARS = 500, 4000, 64
#: Blocks of a side that are aimed at, so that there is work for all cores, and blocks of the other side that are compared at once.
CELLS, WIDE = 24, 6
#: Characters of a name whose order is compared first: on average, and at most (bits of a short word).
PART_CHARS, PART_BITS = 28, 32
#: Pairs whose common subsequences are computed at once.
SETTLED = 50_000
#: Beginning of the keys for partners of another length.
_OTHER = "x"


# ---------------------------------------------------------------- bounds


def _shared_floor(total, threshold: float, size: int):
    """Fewest shared grams of a pair with ``total`` characters that reaches the threshold.

    Works for numbers and for columns alike.
    """
    t = threshold / 100.0
    return total * (t / 2) if size == 1 else total * (1.5 * t - 1) - 1


def _shortest_partner(n: int, threshold: float) -> int:
    t = threshold / 100.0
    return math.ceil(t * n / (2 - t) - EPS)


def _longest_partner(n: int, threshold: float) -> int:
    t = threshold / 100.0
    return math.floor((2 - t) * n / t + EPS)


def gram_floor_length(threshold: float, horizon: int = 2000) -> int | None:
    """Shortest length from which on the character-pair bound always gives >= 1."""
    if 1.5 * threshold / 100.0 - 1 <= EPS:
        return None
    start = None
    for n in range(2, horizon):
        ok = _shared_floor(n + _shortest_partner(n, threshold), threshold, 2) > EPS
        if not ok:
            start = None
        elif start is None:
            start = n
    return start


def routes(threshold: float) -> list[tuple[int, int, int | None, int | None]]:
    """Passes that together see every pair once.

    Each is (gram size, shortest node, longest node, bound below which the
    shorter string of a pair must lie).
    """
    start = gram_floor_length(threshold)
    if start is None:
        return [(1, 0, None, None)]
    return [(2, start, None, None), (1, 0, _longest_partner(start - 1, threshold), start)]


# ---------------------------------------------------------------- grams


def _fixed_array(values: list[int]) -> Column:
    """A constant array; folded to one literal by the optimizer."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def _occurrences(values: Column, code) -> Column:
    """``code(value, how often it came before)`` of every element, in the order of the elements."""
    return let(F.sort_array(values), lambda g: F.transform(g, lambda x, i: code(x, i + 1 - F.array_position(g, x))))


def gram_codes(s, size: int) -> Column:
    """Grams with occurrence numbers as codes: equal bags give equal sets. Empty text has one code."""
    s = F.col(s) if isinstance(s, str) else s
    places = F.when(F.length(s) == 0, F.sequence(F.lit(1), F.lit(1))).when(
        F.length(s) < size, F.array().cast("array<int>")).otherwise(F.sequence(F.lit(1), F.length(s) - (size - 1)))
    return _occurrences(F.transform(places, lambda i: F.substring(s, i, F.lit(size))), lambda x, n: F.xxhash64(x, n))


def _words(places: Column) -> Column:
    """``BITMAP_WORDS`` longs with the bits at the given places."""
    def word(w: int) -> Column:
        return F.aggregate(places, F.lit(0).cast("long"), lambda bits, at: bits.bitwiseOR(
            F.when(F.shiftright(at, 6) == w, F.call_function("shiftleft", F.lit(1).cast("long"), at.bitwiseAND(F.lit(63)))).otherwise(F.lit(0).cast("long"))))

    return F.array(*[word(w) for w in range(BITMAP_WORDS)])


def gram_signature(codes: Column) -> Column:
    """256 hashed bits of a gram set."""
    return let(F.transform(codes, lambda c: F.shiftright(c, 7).bitwiseAND(F.lit(64 * BITMAP_WORDS - 1)).cast("int")), _words)


def letter_signature(s) -> Column:
    """Letter counts in unary: 32 letter classes of 8 bits.

    The bits in which two texts differ never exceed their insert/delete
    distance, since each operation changes one count by one.
    """
    classes = F.transform(characters(s), lambda ch: F.ascii(ch).bitwiseAND(F.lit(31)))
    return let(_occurrences(classes, lambda x, n: x * 8 + F.least(n, F.lit(7)).cast("int")), _words)


def _histogram(buckets: DataFrame, size: int) -> list[int]:
    """Counts per bucket; at most ``size`` rows reach the driver."""
    counts = [0] * size
    for row in buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).collect():
        counts[row["bucket"]] = row["n"]
    return counts


def _bucket(code: Column) -> Column:
    return F.pmod(code, F.lit(GRAM_BUCKETS)).cast("int")


def _rarest_first(codes: Column, weights: list[int]) -> Column:
    """The codes by how many the bucket of each holds."""
    weight = _fixed_array(weights)
    ranked = F.sort_array(F.transform(codes, lambda c: F.struct(F.element_at(weight, _bucket(c) + 1).alias("w"), c.alias("c"))))
    return F.transform(ranked, lambda x: x["c"])


def _band(length: Column, threshold: float) -> Column:
    t = threshold / 100.0
    if t >= 1:
        return length.cast("int")
    return F.floor(F.log(F.greatest(length, F.lit(1)).cast("double")) / math.log((2 - t) / t)).cast("int")


# ---------------------------------------------------------------- common subsequences


def _key_cases(sizes: dict[int, int], start: int, threshold: float) -> dict[int, list[tuple[int, int, int]]] | None:
    """(shorter, longer, common) of every partner length, by length; None where there would be too many keys.

    ``sizes`` are counts by length without the ``start`` characters that all texts begin with. A pair of these lengths
    reaches the threshold if it has ``common`` more characters in common than those.
    """
    cases, keys = {}, 0
    for n, held in sizes.items():
        cases[n], most = [], 0
        for partner in sizes:
            lo, hi = min(n, partner), max(n, partner)
            common = max(0, math.ceil(threshold * (n + partner + 2 * start) / 200 - EPS) - start)
            if common <= lo:
                cases[n].append((lo, hi, common))
                most += max(math.comb(n, k) for k in range(n - common + 1)) if common else 1
        if most > MOST_KEYS:
            return None
        keys += held * most
    if sum(map(len, cases.values())) > KEY_CASES or keys > KEYS_PER_NODE * sum(sizes.values()):
        return None
    return cases


def _subsequences(s: Column, size: int, common: int) -> Column:
    """The different subsequences of ``common`` characters of a text of ``size``: characters go from left to right."""
    if not common:
        return F.array(F.lit(""))
    found = F.array(F.struct(s.alias("t"), F.lit(1).alias("at")))

    def shorter(x):
        return F.transform(F.sequence(x["at"], F.lit(common + 1)), lambda i: F.struct(
            F.concat(x["t"].substr(F.lit(1), i - 1), x["t"].substr(i + 1, F.lit(size))).alias("t"), i.alias("at")))

    for _ in range(size - common):
        found = F.flatten(F.transform(found, shorter))
    return F.array_distinct(F.transform(found, lambda x: x["t"]))


def common_keys(sides: list[DataFrame], threshold: float) -> Column | None:
    """Texts that two nodes share exactly if their ratio reaches the threshold; None where a node would have many.

    A key is a subsequence of the length that the two lengths ask for, with these lengths. The driver
    sees a row per length, and gives up beyond a few.
    """
    rows = reduce(DataFrame.unionByName, [df.select("s") for df in sides])
    head = F.substring("s", 1, 256)
    seen = rows.groupBy(F.length("s").alias("n")).agg(
        F.count(F.lit(1)).alias("rows"), F.min(head).alias("least"), F.max(head).alias("most")).limit(KEY_CASES + 1).collect()
    start = len(os.path.commonprefix([text for row in seen for text in (row["least"], row["most"])]))
    cases = _key_cases({row["n"] - start: row["rows"] for row in seen}, start, threshold) if 0 < len(seen) <= KEY_CASES else None
    if cases is None:
        return None
    rest, keys = F.expr(f"substring(s, {start + 1})"), None

    def texts_of(n: int, lo: int, hi: int, common: int) -> Column:
        mark = f"{lo} " if lo == hi else f"{_OTHER}{lo} {hi} "
        return F.transform(_subsequences(rest, n, common), lambda t: F.concat(F.lit(mark), t))

    for n, partners in cases.items():
        texts = [texts_of(n, *case) for case in partners]
        when = (F.length("s") == n + start, F.concat(*texts) if len(texts) > 1 else texts[0])
        keys = F.when(*when) if keys is None else keys.when(*when)
    return keys


def _keyed_pairs(sides: list[DataFrame], keys: Column, on: list[str], with_texts: bool = True) -> DataFrame:
    """Pairs of nodes that share a key, each once."""
    held = ["id", "s"] if with_texts else ["id"]
    n = int(sides[0].sparkSession.conf.get("spark.sql.shuffle.partitions"))
    posted = [df.select("id", "s", *on).repartition(n).select(
        *held, *on, F.length("s").alias("len"), F.explode(keys).alias("key")) for df in sides]
    a, b = shuffled(posted[0]).alias("a"), posted[-1].alias("b")
    # Two nodes of one length may also share a key of theirs that is meant for partners of another.
    cond = (F.col("a.len") != F.col("b.len")) == F.col("a.key").startswith(_OTHER)
    if len(sides) == 1:
        cond = cond & (F.col("a.id") < F.col("b.id"))
    for k in ["key", *on]:
        cond = cond & (F.col(f"a.{k}") == F.col(f"b.{k}"))
    return a.join(b, cond).select(*[F.col(f"{side}.{c}").alias(f"{c}_{side}") for side in "ab" for c in held]).distinct()


# ---------------------------------------------------------------- blocks


def _in_route(nodes: DataFrame, route) -> DataFrame:
    _, shortest, longest, _ = route
    df = nodes.filter(F.col("len") >= shortest)
    return df if longest is None else df.filter(F.col("len") <= longest)


def _postings(nodes: DataFrame, threshold: float, route, on: list[str], longer: bool) -> DataFrame:
    """(block key, node) rows of one route.

    The shorter string of a pair posts in its own length band only; the longer
    one in every band a shorter partner can have. ``before`` are the grams of
    the prefix in front of the posted one.
    """
    size = route[0]
    t = threshold / 100.0
    length, ranked = F.col("len"), F.col(f"ranked_{size}")
    partner = F.ceil(length * (t / (2 - t)) - EPS).cast("int") if longer else length
    need = F.greatest(F.ceil(_shared_floor(length + partner, threshold, size) - EPS), F.lit(1)).cast("int")
    bands = F.sequence(_band(partner, threshold), _band(length, threshold)) if longer else F.array(_band(length, threshold))
    held = ["id", "s", "len", *on, F.size(ranked).alias("n_grams"), F.col(f"grams_{size}").alias("gram_bits"), "letter_bits"]
    prefix = F.slice(ranked, F.lit(1), F.greatest(F.size(ranked) - need + 1, F.lit(0)))
    df = _in_route(nodes, route).select(*held, bands.alias("bands"), prefix.alias("prefix"))
    held = ["id", "s", "len", *on, "n_grams", "gram_bits", "letter_bits"]
    df = df.select(*held, "bands", "prefix", F.posexplode("prefix").alias("rank", "gram"))
    df = df.select(*held, "gram", F.slice("prefix", F.lit(1), F.col("rank")).alias("before"), F.explode("bands").alias("band"))
    return df.select("*", F.xxhash64("gram", "band", *on).alias("block"))


def _candidates(short: DataFrame, long: DataFrame, threshold: float, route, on: list[str], order: str,
                block_rows: int, may_be_hot: bool) -> DataFrame:
    """Pairs of one route that pass all filters, each once.

    ``order`` tells which pairs count: ``id`` (self-join: shorter first, ids break
    ties), ``le`` or ``lt`` (lengths of the short and the long side).
    """
    size, _, _, below = route
    bucket = F.pmod("block", F.lit(BLOCK_BUCKETS)).cast("int")
    sizes = _histogram(short.select(bucket.alias("bucket")), BLOCK_BUCKETS) if may_be_hot else [0]
    if max(sizes) > block_rows:
        cuts = F.element_at(_fixed_array([max(1, -(-n // block_rows)) for n in sizes]), bucket + 1)
        short = short.withColumn("cut", F.pmod(F.xxhash64("id", "s"), cuts).cast("int"))
        long = long.withColumn("cut", F.explode(F.sequence(F.lit(0), cuts.cast("int") - 1)))
    else:
        short, long = short.withColumn("cut", F.lit(0)), long.withColumn("cut", F.lit(0))
    a, b = shuffled(short).alias("a"), long.alias("b")
    t = threshold / 100.0
    la, lb = F.col("a.len"), F.col("b.len")
    cond = F.lit(True)
    for k in ["block", "cut", "gram", "band", *on]:
        cond = cond & (F.col(f"a.{k}") == F.col(f"b.{k}"))
    if order == "id":
        cond = cond & ((la < lb) | ((la == lb) & (F.col("a.id") < F.col("b.id"))))
    else:
        cond = cond & (la <= lb if order == "le" else la < lb)
    if below is not None:
        cond = cond & (la < below)
    def differing(kind: str) -> Column:
        words = range(BITMAP_WORDS)
        return sum((F.bit_count(F.get(f"a.{kind}", w).bitwiseXOR(F.get(f"b.{kind}", w))) for w in words), F.lit(0))

    most_edits = F.floor((la + lb) * (1 - t) + EPS).cast("int")
    shared_cap = (F.col("a.n_grams") + F.col("b.n_grams") - differing("gram_bits")) / 2
    cond = cond & (differing("letter_bits") <= most_edits)
    cond = cond & (la * (2 - t) >= lb * t - EPS) & (shared_cap >= _shared_floor(la + lb, threshold, size) - 1e-6)
    cond = cond & ~F.arrays_overlap("a.before", "b.before")
    distance = F.call_function("levenshtein", F.col("a.s"), F.col("b.s"), most_edits)
    return a.join(b, cond & (distance >= 0)).select(
        F.col("a.id").alias("id_a"), F.col("a.s").alias("s_a"), F.col("b.id").alias("id_b"), F.col("b.s").alias("s_b")
    )


# ---------------------------------------------------------------- blocks of whole names


def _gram_counts(texts: list[str], size: int) -> np.ndarray:
    """How many grams of the texts, with occurrence numbers as in ``gram_codes``, fall into each of GRAM_BUCKETS buckets."""
    points = np.frombuffer("".join(texts).encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    rows = np.repeat(np.arange(len(texts)), lengths)
    if size == 2:
        inside = np.flatnonzero(rows[1:] == rows[:-1])
        points, rows = (points[inside] << 21) + points[inside + 1], rows[inside]
    empty = np.flatnonzero(lengths == 0)
    points, rows = np.append(points, np.full(len(empty), -1)), np.append(rows, empty)
    order = np.lexsort((points, rows))
    points, rows, at = points[order], rows[order], np.arange(len(order))
    first = np.append(True, (points[1:] != points[:-1]) | (rows[1:] != rows[:-1]))[: len(order)]
    times = at - np.maximum.accumulate(np.where(first, at, 0))
    mixed = (points.astype(np.uint64) * np.uint64(64) + times.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    return np.bincount((mixed >> np.uint64(40)).astype(np.int64) % GRAM_BUCKETS, minlength=GRAM_BUCKETS)


def _gram_histogram(df: DataFrame, size: int) -> list[int]:
    """Grams of ``s`` by bucket; at most GRAM_BUCKETS rows reach the driver."""
    def count(batches):
        for batch in batches:
            counts = _gram_counts(batch.column(0).to_pylist(), size)
            held = np.flatnonzero(counts)
            yield pa.RecordBatch.from_pydict({"bucket": pa.array(held.astype(np.int32)), "n": pa.array(counts[held])})

    counts = [0] * GRAM_BUCKETS
    for row in df.select("s").mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        counts[row["bucket"]] = row["n"]
    return counts


def _cells_of(sides: list[DataFrame], threshold: float) -> list[int] | None:
    """Blocks of each side if comparing all pairs is less work than the pairs that meet at shared grams; None if not.

    A node posts the rarest grams, as large a share of them as the threshold leaves. The driver sees counts of buckets.
    """
    sizes = [df.agg(F.count(F.lit(1)), F.coalesce(F.max(F.length("s")), F.lit(0))).first() for df in sides]
    if max(longest for _, longest in sizes) > CELL_CHARS or not all(n for n, _ in sizes):
        return None
    size = 2 if gram_floor_length(threshold) is not None else 1
    share = 1 - max(0.0, _shared_floor(2, threshold, size) if size == 1 else 3 * threshold / 100.0 - 2)
    counts = [_gram_histogram(df, size) for df in sides]
    posted, met, upto = 0, 0, share * sum(map(sum, counts))
    for held in sorted(zip(counts[0], counts[-1], strict=True), key=sum):
        posted += held[0] + (held[1] if len(sides) > 1 else held[0])
        if posted > upto * (1 if len(sides) > 1 else 2):
            break
        met += held[0] * held[1]
    return [-(-n // min(max(-(-n // CELLS), LEAST_CELL), CELL_ROWS)) for n, _ in sizes] if met >= sizes[0][0] * sizes[-1][0] else None


def _lcs_steps(rows: Iterable[np.ndarray], size: int, kind) -> np.ndarray:
    """Common subsequences of ``size`` pairs: ``rows`` has, a character of the one text a step, its places in the other."""
    state = np.full(size, np.iinfo(kind).max, dtype=kind)
    both, more = np.empty_like(state), np.empty_like(state)
    for row in rows:
        np.bitwise_and(state, row, out=both)
        np.add(state, both, out=more)
        np.subtract(state, both, out=both)
        np.bitwise_or(more, both, out=state)
    return np.bitwise_count(~state)


class _Block:
    """Texts of a block by character: how often and where each text has it.

    ``part`` tells the characters of the shorter common subsequence that is computed first: those of middle frequency, PART_CHARS
    a text on average. Places among them are ``near``; what a text has beyond PART_BITS is counted as common (``beyond``).
    """

    def __init__(self, texts: list[str]):
        self.lengths = np.array([len(t) for t in texts], dtype=np.int64)
        points = np.frombuffer("".join(texts).encode("utf-32-le"), dtype=np.uint32)
        self.letters = np.flatnonzero(np.bincount(points))
        code = np.searchsorted(self.letters, np.arange(int(points.max(initial=0)) + 1))[points]
        size, ends = (len(self.letters), len(texts)), np.cumsum(self.lengths)
        rows = np.repeat(np.arange(len(texts)), self.lengths)
        columns = np.arange(len(points)) - np.repeat(ends - self.lengths, self.lengths)
        self.held = np.bincount(code * len(texts) + rows, minlength=size[0] * size[1]).astype(np.uint8).reshape(size)
        self.near = np.zeros(size, dtype=np.uint32)
        self.places = np.zeros((size[0] + 1, size[1]), dtype=np.uint64)  # the last line is that of a character no text has
        np.bitwise_or.at(self.places, (code, rows), np.uint64(1) << columns.astype(np.uint64))
        often = self.held.sum(axis=1, dtype=np.int64)
        order = np.argsort(-often, kind="stable")[2:]
        self.part = np.zeros(len(self.letters), dtype=bool)
        self.part[order[np.cumsum(often[order]) <= PART_CHARS * len(texts)]] = True
        chosen = self.part[code]
        before = np.cumsum(chosen) - chosen
        at = before - np.append(before, 0)[ends - self.lengths][rows]
        fits = chosen & (at < PART_BITS)
        np.bitwise_or.at(self.near, (code[fits], rows[fits]), np.uint32(1) << at[fits].astype(np.uint32))
        own = self.held[self.part].sum(axis=0, dtype=np.int64)
        self.beyond = np.maximum(own - PART_BITS, 0).astype(np.uint8)
        self._capped: dict[tuple[int, int], np.ndarray] = {}

    def capped(self, letter: int, most: int) -> np.ndarray:
        """How often the texts have a character, ``most`` times at the most."""
        if (letter, most) not in self._capped:
            self._capped[letter, most] = np.minimum(self.held[letter], np.uint8(most))
        return self._capped[letter, most]


def block_lcs(a: list[str], b: list[str], threshold: float, ahead: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place in a, place in b, score) of the pairs of two blocks that reach the threshold; with ``ahead``, later places of ``b`` only.

    Texts have at most CELL_CHARS characters. The common subsequence is computed for one text against all left of the
    block, a character a step. Two bounds come before: the characters in common, and of those the
    characters of middle frequency only as far as they stand in the same order.
    """
    block = _Block(b)
    lengths, index = block.lengths, {chr(x): k for k, x in enumerate(block.letters.tolist())}
    part, sizes = block.part.tolist(), np.array([len(t) for t in a], dtype=np.int64)
    needs = {n: np.maximum(np.ceil(threshold * (lengths + n) / 200 - EPS), 0).astype(np.uint8) for n in np.unique(sizes).tolist()}
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    left: list[tuple[np.ndarray, np.ndarray]] = []

    def settle() -> None:
        """The whole common subsequence of the pairs that are left."""
        first, second = (np.concatenate(x) for x in zip(*left, strict=True))
        left.clear()
        own, of = np.unique(first, return_inverse=True)
        codes = np.full((len(own), int(sizes[own].max())), len(index), dtype=np.int64)  # behind the letters: none
        for row, text in zip(codes, (a[i] for i in own), strict=True):
            row[: len(text)] = [index.get(ch, len(index)) for ch in text]
        lcs = _lcs_steps((block.places[line[of], second] for line in codes.T), len(of), np.uint64).astype(np.int64)
        total = lengths[second] + sizes[first]
        good = 200 * lcs >= threshold * total
        found.append((first[good], second[good], np.where(total == 0, 100.0, 200.0 * lcs / np.maximum(total, 1))[good]))

    waiting = 0
    for i, text in enumerate(a):
        start, need = i + 1 if ahead else 0, needs[len(text)]
        known = [(index[ch], ch, many) for ch, many in Counter(text).items() if ch in index]
        common = np.zeros(len(b) - start, dtype=np.uint8)
        for letter, _, many in known:
            if not part[letter]:
                np.add(common, block.capped(letter, many)[start:], out=common)
        others = common.copy()
        for letter, _, many in known:
            if part[letter]:
                np.add(common, block.capped(letter, many)[start:], out=common)
        may = np.flatnonzero(common >= need[start:])
        others, may = others[may], may + start
        rows = {ch: block.near[letter].take(may) for letter, ch, _ in known if part[letter]}
        if len(may) and rows:
            near = _lcs_steps((rows[ch] for ch in text if ch in rows), len(may), np.uint32)
            may = may[near + block.beyond[may] + others >= need[may]]
        if len(may):
            left.append((np.full(len(may), i), may))
            waiting += len(may)
        if waiting >= SETTLED:
            settle()
            waiting = 0
    if left:
        settle()
    if not found:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0)
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _cell_pairs(sides: list[DataFrame], threshold: float, blocks: list[int]) -> DataFrame:
    """All pairs that reach the threshold; a block of one side and a wide block (WIDE blocks) of the other are a group of their own.

    A name is compared with a whole wide block at a time, which costs less the wider it is. In a self-join a block meets
    itself and the blocks behind it.
    """
    self_join = len(sides) == 1
    first, second = blocks[0], blocks[-1]
    wide = -(-second // WIDE)

    def dealt(df: DataFrame, side: int) -> DataFrame:
        cell = F.pmod(F.xxhash64("id", F.lit(7)), F.lit(second if side else first)).cast("int")
        df = df.select("id", "s", cell.alias("cell"), F.lit(side).alias("side"))
        of = F.floor(F.col("cell") / WIDE).cast("int")
        if side:
            return df.withColumns({"i": F.explode(F.sequence(F.lit(0), F.col("cell") if self_join else F.lit(first - 1))), "j": of})
        return df.withColumns({"i": F.col("cell"), "j": F.explode(F.sequence(of if self_join else F.lit(0), F.lit(wide - 1)))})

    groups = sum(wide - i // WIDE for i in range(first)) if self_join else first * wide
    kind = sides[0].schema["id"].dataType.simpleString()

    def compare(table: pa.Table) -> pa.Table:
        table = table.sort_by([("cell", "ascending"), ("id", "ascending")])
        side = table.column("side").to_numpy()
        a, b = (table.take(pa.array(np.flatnonzero(side == k))) for k in (0, 1))
        # The names of the block itself come first on the other side too.
        same = self_join and len(table) and table.column("i")[0].as_py() // WIDE == table.column("j")[0].as_py()
        i, j, score = block_lcs(a.column("s").to_pylist(), b.column("s").to_pylist(), threshold, same)
        return pa.table({"id_a": a.column("id").take(pa.array(i)), "id_b": b.column("id").take(pa.array(j)), "score": pa.array(score)})

    rows = dealt(sides[0], 0).unionByName(dealt(sides[-1], 1))
    # Comparing costs CPU, not bytes: a fixed number of partitions is not merged.
    found = rows.repartition(min(2 * groups, 1000), "i", "j").groupBy("i", "j").applyInArrow(compare, f"id_a {kind}, id_b {kind}, score double")
    # A checkpoint runs the last stage twice; behind an exchange the blocks are compared once.
    return found.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def candidate_pairs(left: DataFrame, right: DataFrame | None, threshold: float, on: list[str] | None = None,
                    block_rows: int = 20_000) -> DataFrame:
    """Distinct node pairs left after all filters: what the LCS is computed for."""
    on = on or []
    self_join = right is None
    sides = [left] if self_join else [left, right]

    passes = routes(threshold)
    sizes = sorted({route[0] for route in passes})

    def prepare(df: DataFrame) -> DataFrame:
        # Comparing costs CPU, not bytes: spread the nodes whatever their size.
        n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        df = df.select("id", "s", *on, F.length("s").alias("len")).repartition(n)
        df = df.select("*", letter_signature("s").alias("letter_bits"), *[gram_codes("s", k).alias(f"codes_{k}") for k in sizes])
        return cut_lineage(df.withColumns({f"grams_{k}": gram_signature(F.col(f"codes_{k}")) for k in sizes}))

    nodes = [prepare(df) for df in sides]
    found = []
    # Gram counts of all passes and sides in one job: at most 4 * GRAM_BUCKETS rows.
    grams = [
        _in_route(df, route).select(F.lit(i).alias("pass"), F.lit(side).alias("side"), F.explode(F.transform(f"codes_{route[0]}", _bucket)).alias("bucket"))
        for i, route in enumerate(passes) for side, df in enumerate(nodes)]
    seen = {(i, side): [0] * GRAM_BUCKETS for i in range(len(passes)) for side in range(len(nodes))}
    for row in reduce(DataFrame.unionByName, grams).groupBy("pass", "side", "bucket").agg(F.count(F.lit(1)).alias("n")).collect():
        seen[row["pass"], row["side"]][row["bucket"]] = row["n"]
    counts = {route[0]: [sum(n) for n in zip(*(seen[i, side] for side in range(len(nodes))))] for i, route in enumerate(passes)}
    nodes = [cut_lineage(df.select(
        *[c for c in df.columns if not c.startswith("codes_")],
        *[_rarest_first(F.col(f"codes_{k}"), counts[k]).alias(f"ranked_{k}") for k in sizes])) for df in nodes]
    for i, route in enumerate(passes):
        if not all(any(seen[i, side]) for side in range(len(nodes))):
            continue  # nothing to pair on one side
        may_be_hot = max(counts[route[0]]) > block_rows  # a block is never bigger than its gram's count

        def pairs(short: DataFrame, long: DataFrame, order: str) -> DataFrame:
            return _candidates(
                _postings(short, threshold, route, on, False), _postings(long, threshold, route, on, True),
                threshold, route, on, order, block_rows, may_be_hot)

        if self_join:
            found.append(pairs(nodes[0], nodes[0], "id"))
        else:
            swapped = pairs(nodes[1], nodes[0], "lt")
            found += [pairs(nodes[0], nodes[1], "le"), swapped.select(
                F.col("id_b").alias("id_a"), F.col("s_b").alias("s_a"), F.col("id_a").alias("id_b"), F.col("s_a").alias("s_b"))]
    if found:
        return reduce(DataFrame.unionByName, found)
    a = nodes[0].select(F.col("id").alias("id_a"), F.col("s").alias("s_a")).filter(F.lit(False))
    return a.join(nodes[-1].select(F.col("id").alias("id_b"), F.col("s").alias("s_b")), F.col("s_a") == F.col("s_b"))


def similar_pairs(left: DataFrame, right: DataFrame | None = None, threshold: float = 85,
                  on: list[str] | None = None, block_rows: int = 20_000, scored: bool = True) -> DataFrame:
    """Pairs of nodes with ratio >= threshold: ``id_a, id_b, score``.

    ``left`` (and ``right``) hold distinct nodes: a unique ``id``, the sorted-token
    text ``s`` and the columns in ``on`` that both sides must share. Without
    ``right`` each unordered pair of different ids appears once. Runs small
    bounded jobs at build time (gram and block histograms); the pairs are lazy.
    Without ``scored`` the pairs come alone, and those whose Levenshtein distance already tells that
    they reach the threshold (insertions and deletions are at most twice as many) cost no score.
    """
    sides = [left] if right is None else [left, right]
    keys = common_keys(sides, threshold)
    if keys is not None and not scored:
        return _keyed_pairs(sides, keys, on or [], False)
    blocks = None if keys is not None or on else _cells_of(sides, threshold)
    if blocks is not None:
        found = _cell_pairs(sides, threshold, blocks)
        return found if scored else found.select("id_a", "id_b")
    total = F.length("s_a") + F.length("s_b")
    lcs = lcs_length("s_a", "s_b")
    if not scored:
        edits = F.call_function("levenshtein", F.col("s_a"), F.col("s_b"))
        lcs = F.when(200 * 2 * edits <= (200 - 2 * threshold) * total, F.lit(None).cast("int")).otherwise(lcs)
    # One-row explode: the length is computed once, for the filter and for the score.
    pairs = candidate_pairs(left, right, threshold, on, block_rows) if keys is None else _keyed_pairs(sides, keys, on or [])
    pairs = pairs.select("*", F.explode(F.array(lcs)).alias("lcs"))
    good = pairs.filter(F.col("lcs").isNull() | (F.lit(200) * F.col("lcs") >= F.lit(threshold) * total))
    if not scored:
        return good.select("id_a", "id_b")
    return good.select(
        "id_a", "id_b",
        F.when(total == 0, F.lit(100.0)).otherwise(F.lit(200.0) * F.col("lcs") / total).alias("score"),
    )
