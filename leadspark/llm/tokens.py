"""Token counts of a unigram tokenizer: Aho-Corasick matches and count-only Viterbi.

Pieces never hold a space mark after another character, so the best segmentation of a text is
that of its words (with the marks before them) one after the other, and a word is solved once.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, pick

SPACE = "▁"
#: What an unknown character costs below the lowest score (fixed value of the tokenizer).
UNKNOWN_PENALTY = 10.0
#: Words kept solved by a task, and the longest that are kept.
MEMO_WORDS, MEMO_CHARS = 400_000, 40

_WORDS = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")


def vocabulary(path: str) -> dict[str, tuple[int, float]]:
    """(id, score) of the normal pieces of a sentencepiece model."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    special = (model.is_control, model.is_unknown, model.is_byte, model.is_unused)
    pieces = {model.id_to_piece(i): (i, model.get_score(i)) for i in range(model.get_piece_size()) if not any(f(i) for f in special)}
    if any(SPACE in p.lstrip(SPACE) for p in pieces):
        raise ValueError("pieces reach over the start of a word")
    return pieces


def normalised(text: str) -> str:
    """Spaces as marks, and one before the text; nothing of an empty text."""
    return SPACE + text.replace(" ", SPACE) if text else ""


class PieceCounter:
    """(pieces, score, unknown characters) of the best segmentation.

    At each end position the pieces that end there come longest first, and a later one must be
    better, not equal: the tie rule of the tokenizer, which relaxes from left to right. A
    character that is no piece costs the lowest score less 10 and counts as one piece a byte.
    """

    def __init__(self, path: str):
        import ahocorasick

        pieces = vocabulary(path)
        self.automaton = ahocorasick.Automaton()
        for piece, (_, score) in pieces.items():
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.known = {p for p in pieces if len(p) == 1}
        self.unknown = min(score for _, score in pieces.values()) - UNKNOWN_PENALTY
        self.memo: dict[str, tuple[int, float, int]] = {}

    def solve(self, word: str) -> tuple[int, float, int]:
        n = len(word)
        if self.known.issuperset(word):
            best, count = [0.0] + [-np.inf] * n, [0] * (n + 1)
            for at, (length, score) in self.automaton.iter(word):
                start = at + 1 - length
                total = best[start] + score
                if total > best[at + 1]:
                    best[at + 1], count[at + 1] = total, count[start] + 1
            return count[n], best[n], 0
        best, count, odd = [0.0] + [-np.inf] * n, [0] * (n + 1), [0] * (n + 1)
        done, unknown = 0, self.unknown

        def settle(upto: int) -> None:
            """Positions that no piece reaches are reached by an unknown character."""
            for end in range(done + 1, upto + 1):
                if not single[end] and best[end - 1] + unknown > best[end]:
                    best[end], count[end], odd[end] = best[end - 1] + unknown, count[end - 1] + len(word[end - 1].encode("utf-8", "surrogatepass")), odd[end - 1] + 1

        single = [False] * (n + 1)
        last = 0
        for at, (length, score) in self.automaton.iter(word):
            end = at + 1
            if end != last:
                settle(last)
                done = last
                settle(end - 1)
                done = end - 1
                last = end
            start = end - length
            single[end] |= length == 1
            total = best[start] + score
            if total > best[end]:
                best[end], count[end], odd[end] = total, count[start] + 1, odd[start]
        settle(n)
        return count[n], best[n], odd[n]

    def __call__(self, text: str) -> tuple[int, float, int]:
        pieces, score, odd, memo = 0, 0.0, 0, self.memo
        for word in _WORDS.findall(normalised(text)):
            found = memo.get(word)
            if found is None:
                found = self.solve(word)
                if len(word) <= MEMO_CHARS:
                    if len(memo) >= MEMO_WORDS:
                        memo.clear()
                    memo[word] = found
            pieces += found[0]
            score += found[1]
            odd += found[2]
        return pieces, score, odd


def count_tokens(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, score, n_unknown) of every whole text.

    ``score`` is that of the best segmentation, ``n_unknown`` its characters without a piece
    (counted as their bytes). NULL and empty texts have 0 tokens; repeated rows and NULL ids come
    back as they are; extra columns are ignored; an empty table gives no rows.
    """
    source = pick(docs, doc_id=id_col, text=text_col).select(F.col("doc_id"), F.col("text").cast("string"))

    def start():
        count = PieceCounter(model)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [count(t or "") for t in batch.column(1).to_pylist()]
            return pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.float64()), pa.array([f[2] for f in found], pa.int64())],
                names=["doc_id", "n_tokens", "score", "n_unknown"])

        return step

    return map_batches(source, start, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, n_tokens long, score double, n_unknown long")
