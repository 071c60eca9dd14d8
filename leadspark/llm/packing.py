"""Best-fit packing of tokenised documents into sequences under several capacities.

Every document becomes one short piece at most and otherwise whole sequences, so a piece is
known by its length. Pieces of one length are alike, so the vector best-fit-decreasing run
works on the histogram of lengths (at most ``max_tokens`` counts, whatever the number of
documents) and places runs of equal pieces into runs of equal bins at a time; its result is
that of placing them one by one. Which document takes which place is then a matter of its
rank among the pieces of its length, counted per partition and carried over.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import map_batches, pick, stored

#: Token id after each document.
END_ID = 0
#: Chunks of text kept encoded by a task, and the longest that are kept.
MEMO_CHUNKS, MEMO_CHARS = 500_000, 40

#: A space belongs to the word after it and a run of white space gives its last space away:
#: no token of the byte-level BPE reaches over the borders of these chunks.
_CHUNKS = re.compile(r" ?\S+|\s+(?!\S)|\s+")
#: Fixed value: the published split of this byte-level BPE.
PRETOKENS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Characters that ``re`` and the tokenizer do not both call white space.
_ODD_SPACE = re.compile("[\x1c-\x1f]")


class ByteEncoder:
    """Token ids of a text as little-endian unsigned 32-bit bytes; words are looked up before they are encoded.

    Ids are those of ``tokenizers`` on the same file. Its merges are carried out by ``tiktoken``,
    which is faster: ids of this vocabulary are ranks of merges. Texts that hold a special token
    or odd white space go to ``tokenizers`` itself.
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        # The file writes each byte as a printable letter; the letters of a text of known bytes tell which.
        byte_of = {}
        for cp in [*range(0x80), *range(0x80, 0x800), *range(0x1000, 0xD800, 0x40), *range(0x10000, 0x110000, 0x1000)]:
            text = chr(cp)
            shown = "".join(t for t, _ in pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str(text))
            byte_of.update(zip(shown, text.encode(), strict=True))
        vocab = self.tokenizer.get_vocab(with_added_tokens=False)
        ranks = {bytes(byte_of.get(c, 0) for c in token): i for token, i in vocab.items() if token not in self.specials}
        ranks.update({bytes([b]): vocab[c] for c, b in byte_of.items() if c in vocab})
        # Bytes that no text in UTF-8 holds still need a rank each.
        ranks.update({bytes([b]): len(vocab) + b for b in range(256) if bytes([b]) not in ranks})
        self.fast = tiktoken.Encoding("bytes", pat_str=PRETOKENS, mergeable_ranks=ranks, special_tokens={})
        self.memo: dict[str, bytes] = {}

    def _encode(self, text: str) -> bytes:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def __call__(self, text: str) -> bytes:
        if _ODD_SPACE.search(text) or any(s in text for s in self.specials):
            return self._encode(text)
        out, memo, encode = [], self.memo, self.fast.encode_ordinary
        for chunk in _CHUNKS.findall(text):
            ids = memo.get(chunk)
            if ids is None:
                ids = array("I", encode(chunk)).tobytes()
                if len(chunk) <= MEMO_CHARS:
                    if len(memo) >= MEMO_CHUNKS:
                        memo.clear()
                    memo[chunk] = ids
            out.append(ids)
        return b"".join(out)


def cut_pieces(length: int, most: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document; only the first may be shorter than ``most``."""
    first = length % most or most
    return [(0, first)] + [(at, most) for at in range(first, length, most)]


@dataclass(frozen=True)
class Capacity:
    """What a sequence holds: tokens, documents, and attention cost (sum of squared lengths). None: no bound."""

    tokens: int = 2048
    documents: int | None = None
    attention: int | None = None

    def vector(self) -> np.ndarray:
        return np.array([self.tokens, self.documents or self.tokens, self.attention or self.tokens**2], dtype=np.int64)


@dataclass(frozen=True)
class Slot:
    """Pieces ``rank .. rank + count`` of one length: ``per_bin`` side by side from ``offset`` in each bin from ``first_bin``."""

    length: int
    rank: int
    count: int
    per_bin: int
    first_bin: int
    offset: int


def plan_slots(counts: dict[int, int], capacity: Capacity, rule: str = "norm", weights: tuple[float, float, float] = (1.0, 0.05, 0.05)) -> list[Slot]:
    """Vector best-fit decreasing over pieces of the given lengths.

    A bin state is the residual (tokens, documents, attention). Of the states that satisfy
    every constraint, ``norm`` takes the one with the least weighted norm of what would remain,
    ``dot`` the one with the largest weighted dot product of demand and residual; ties go to the
    state that appeared first. Bins of equal state are kept as runs of numbers.
    """
    full = capacity.vector()
    weight = np.asarray(weights)
    states: dict[tuple[int, ...], list[list[int]]] = {}
    slots: list[Slot] = []
    bins = 0

    def settle(rest: tuple[int, ...], start: int, count: int) -> None:
        if not count:
            return
        runs = states.setdefault(rest, [])
        if runs and runs[-1][0] + runs[-1][1] == start:
            runs[-1][1] += count
        else:
            runs.append([start, count])

    for length in sorted(counts, reverse=True):
        demand = np.array([length, 1, length * length], dtype=np.int64)
        if (demand > full).any():
            raise ValueError(f"a piece of {length} tokens fits no sequence")
        left, rank = counts[length], 0
        while left:
            keys = list(states)
            rest = np.array(keys, dtype=np.int64).reshape(-1, 3)
            fits = (rest >= demand).all(axis=1)
            if fits.any():
                if rule == "norm":
                    cost = ((weight * (rest - demand) / full) ** 2).sum(axis=1)
                else:
                    cost = -(weight * (demand / full) * (rest / full)).sum(axis=1)
                state = keys[int(np.where(fits, cost, np.inf).argmin())]
                runs = states[state]
            else:
                state, runs = tuple(int(x) for x in full), [[bins, left]]
            # By residual norm the bin just used is the next best; by dot product the worst.
            per_bin = int((np.array(state) // demand).min()) if rule == "norm" else 1
            start, have = runs[0]
            offset = int(full[0]) - state[0]
            use, each = (min(have, left // per_bin), per_bin) if left >= per_bin else (1, left)
            slots.append(Slot(length, rank, use * each, each, start, offset))
            if fits.any():
                if use == have:
                    runs.pop(0)
                    if not runs:
                        del states[state]
                else:
                    runs[0] = [start + use, have - use]
            else:
                bins = start + use
            settle(tuple(int(x) for x in np.array(state) - each * demand), start, use)
            rank, left = rank + use * each, left - use * each
    return slots


def tokenised_pieces(docs: DataFrame, tokenizer: str, most: int = 2048, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of every whole text: doc_id, piece, start, length, ids_crc32 and the place (part, local_rank) among equal lengths."""
    source = pick(docs, doc_id=id_col, text=text_col).select(F.col("doc_id").cast("long"), F.col("text").cast("string"))

    def start():
        encode, seen, part = ByteEncoder(tokenizer), Counter(), TaskContext.get().partitionId()
        end = np.array([END_ID], dtype="<u4").tobytes()

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            out = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = encode(text or "") + end
                for k, (at, n) in enumerate(cut_pieces(len(ids) // 4, most)):
                    out.append((doc_id, k, at, n, zlib.crc32(memoryview(ids)[4 * at : 4 * (at + n)]), part, seen[n]))
                    seen[n] += 1
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names=["doc_id", "piece", "start", "length", "ids_crc32", "part", "local_rank"])

        return step

    return map_batches(source, start, "doc_id long, piece int, start long, length long, ids_crc32 long, part int, local_rank long", rows=250)


def pack_documents(docs: DataFrame, tokenizer: str, capacity: Capacity = Capacity(), rule: str = "norm", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All documents in as few sequences as best fit gives: one row per piece.

    Columns: doc_id, piece, start, length, ids_crc32, sequence_id, offset.
    A NULL or empty text is its end id alone; a NULL id stays NULL; repeated rows are packed as
    often as they come; extra columns are ignored; an empty table gives no rows. The driver sees
    one count per length (``capacity.tokens`` at most).
    """
    spark = docs.sparkSession
    pieces = stored(tokenised_pieces(docs, tokenizer, capacity.tokens, id_col, text_col), "pieces")
    sizes = pieces.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    counts = {r["length"]: r["n"] for r in sizes.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    slots = plan_slots(counts, capacity, rule)
    before = F.sum("n").over(W.partitionBy("length").orderBy("part").rowsBetween(W.unboundedPreceding, -1))
    places = sizes.select("length", "part", F.coalesce(before, F.lit(0)).alias("before"))
    ranked = pieces.join(places, ["length", "part"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("local_rank") + F.col("before")).alias("rank"))
    plan = np.array([(s.length, s.rank, s.per_bin, s.first_bin, s.offset) for s in slots], dtype=np.int64).reshape(-1, 5)
    plan = plan[np.lexsort((plan[:, 1], plan[:, 0]))]
    shared = spark.sparkContext.broadcast(plan)  # bounded by the number of lengths, not of documents

    def start():
        table = shared.value
        keys = table[:, 0] << 44 | table[:, 1]

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            length, rank = (batch.column(i).to_numpy(zero_copy_only=False) for i in (3, 5))
            row = table[np.searchsorted(keys, length << 44 | rank, side="right") - 1]
            at = rank - row[:, 1]
            sequence, offset = row[:, 3] + at // row[:, 2], row[:, 4] + at % row[:, 2] * length
            return pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(5)), pa.array(sequence), pa.array(offset)], names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

        return step

    return map_batches(ranked, start, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long", rows=50_000)
