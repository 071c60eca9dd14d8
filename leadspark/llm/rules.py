"""Quality rules as a ledger: every rule is evaluated once a text, policies only read its bits.

``ledger`` stores, a document, what the rules measured and one bit a failed rule. A policy is a
named, versioned mask over these bits; judging by another policy or counting what a rule removes
reads the ledger, never a text. Measuring is a narrow map over the rows (one text at a time);
counting groups by the bits, of which there are at most ``2 ** len(RULES)`` values, so a group
never grows with the corpus.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_batches, pick

#: White space that parts words, and the characters counted as symbols.
SPACES = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
#: Words of a window whose repetition counts.
WINDOW = 5
#: Distinct words a task remembers the answer for.
WORD_MEMO = 1 << 16

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_letter_words", "n_lines"]


@dataclass(frozen=True)
class Rule:
    """``fails`` is a condition over the measures; a text fails where it is true."""

    name: str
    fails: str


#: The place of a rule is its bit; new rules go to the end, so stored ledgers stay readable.
RULES = [
    Rule("few_words", "n_words < 10"),
    Rule("repeated_words", "100 * n_repeat_words > 20 * n_words"),
    Rule("symbols", "10 * n_symbols > n_words"),
    Rule("letterless_words", "10 * n_letter_words < 8 * n_words"),
    Rule("word_length", "word_chars < 2 * n_words OR word_chars > 12 * n_words"),
    Rule("repeated_lines", "100 * n_dup_lines > 30 * n_lines"),
    Rule("many_words", "n_words > 1000000"),
]
BASE = ("few_words", "repeated_words")


@dataclass(frozen=True)
class Policy:
    """A document is removed if it fails a rule of ``any_of``, or ``least`` rules of ``several``."""

    name: str
    version: int
    any_of: tuple[str, ...]
    several: tuple[str, ...] = ()
    least: int = 2


POLICIES = [
    Policy("web", 1, BASE),
    Policy("web", 2, (*BASE, "symbols", "letterless_words", "word_length")),
    Policy("web", 3, (*BASE, "symbols"), ("letterless_words", "word_length", "repeated_lines", "many_words")),
]


def policy(name: str, version: int) -> Policy:
    for p in POLICIES:
        if (p.name, p.version) == (name, version):
            return p
    raise ValueError(f"no policy {name!r} of version {version}")


def mask(names: tuple[str, ...], rules: list[Rule] = RULES) -> int:
    at = {r.name: i for i, r in enumerate(rules)}
    return sum(1 << at[n] for n in set(names))


@lru_cache(maxsize=WORD_MEMO)
def _has_letter(word: bytes) -> bool:
    return any(map(str.isalpha, word.decode()))


def _repeated(words: list[bytes]) -> int:
    """Words inside windows of ``WINDOW`` words that the text holds twice or more."""
    windows = list(zip(*(words[i:] for i in range(WINDOW)), strict=False))
    if len(set(windows)) == len(windows):
        return 0
    seen = Counter(windows)
    total = end = 0
    for at, window in enumerate(windows):
        if seen[window] > 1:
            total += at + WINDOW - max(at, end)
            end = at + WINDOW
    return total


def measure_text(text: str | None) -> tuple[int, ...]:
    """The measures of one text, in the order of ``MEASURES``; a null text measures as an empty one."""
    text = text or ""
    # Splitting bytes parts words at exactly the six ASCII spaces.
    words = text.encode("utf-8", "surrogatepass").split()
    lines = [line for line in text.split("\n") if line.strip(SPACES)]
    return (
        len(words),
        len(text) - sum(map(text.count, SPACES)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        _repeated(words),
        sum(map(_has_letter, words)),
        len(lines),
    )


def _start() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [measure_text(t) for t in batch["text"].to_pylist()]
        columns = list(zip(*found, strict=True)) if found else [[] for _ in MEASURES]
        return pa.RecordBatch.from_arrays(
            [batch["doc_id"], *(pa.array(c, pa.int64()) for c in columns)], ["doc_id", *MEASURES])

    return step


def measure(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the measures of every whole text. See ``ledger`` for special cases."""
    rows = pick(docs, doc_id="doc_id", text="text")
    schema = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, " + ", ".join(f"{m} long" for m in MEASURES)
    return map_batches(rows, _start, schema)


def failure_bits(rules: list[Rule] = RULES) -> Column:
    bits = F.lit(0).cast("long")
    for i, rule in enumerate(rules):
        bits = bits.bitwiseOR(F.when(F.expr(rule.fails), F.lit(1 << i)).otherwise(F.lit(0)).cast("long"))
    return bits


def ledger(docs: DataFrame, rules: list[Rule] = RULES) -> DataFrame:
    """One row a document: ``doc_id``, the measures and ``bits`` (one a failed rule).

    Null and empty texts have no word and fail ``few_words``. A text is read whole, whatever its
    length; a task holds the words of one text at a time. Repeated rows give repeated ledger rows, an
    empty table an empty ledger; further columns, also of clashing names, are not read; ``doc_id``
    may be null. No measure depends on another row, so ties do not arise.
    """
    return measure(docs).withColumn("bits", failure_bits(rules))


def removed(p: Policy, bits: Column | str = "bits", rules: list[Rule] = RULES) -> Column:
    """Whether the policy removes a document, from its bits alone."""
    bits = F.col(bits) if isinstance(bits, str) else bits
    out = bits.bitwiseAND(F.lit(mask(p.any_of, rules)).cast("long")) != 0
    if p.several:
        out = out | (F.bit_count(bits.bitwiseAND(F.lit(mask(p.several, rules)).cast("long"))) >= p.least)
    return out


def judge(rows: DataFrame, p: Policy, rules: list[Rule] = RULES) -> DataFrame:
    """The ledger with ``policy`` and ``kept``; an empty ledger gives an empty table."""
    return rows.withColumns({"policy": F.lit(f"{p.name}-{p.version}"), "kept": ~removed(p, rules=rules)})


def ablations(rows: DataFrame, policies: list[Policy] = POLICIES, rules: list[Rule] = RULES) -> DataFrame:
    """A row a policy and rule of it: documents ``failing`` the rule, ``removed`` by the policy,
    ``rescued`` if the policy went without the rule, and ``only_one`` that fail no other rule of it.

    The ledger is first counted a value of ``bits`` (map-side, at most ``2 ** len(rules)`` rows leave a
    task); everything else is done on those counts. An empty ledger gives no row.
    """
    counts = rows.groupBy("bits").agg(F.count(F.lit(1)).alias("n"))
    parts = []
    for p in policies:
        used = mask((*p.any_of, *p.several), rules)
        for name in dict.fromkeys((*p.any_of, *p.several)):
            bit = mask((name,), rules)
            without = removed(p, F.col("bits").bitwiseAND(F.lit(~bit).cast("long")), rules)
            failing = F.col("bits").bitwiseAND(F.lit(bit).cast("long")) != 0
            gone = removed(p, rules=rules)

            def total(cond: Column) -> Column:
                return F.sum(F.when(cond, F.col("n")).otherwise(0))

            parts.append(F.struct(
                F.lit(p.name).alias("policy"), F.lit(p.version).alias("version"), F.lit(name).alias("rule"),
                total(failing).alias("failing"), total(gone).alias("removed"), total(gone & ~without).alias("rescued"),
                total(F.col("bits").bitwiseAND(F.lit(used).cast("long")) == bit).alias("only_one"),
            ))
    return counts.agg(F.explode(F.array(*parts)).alias("r")).select("r.*").filter(F.col("failing").isNotNull())


def failed_rules(bits: Column | str = "bits", rules: list[Rule] = RULES) -> Column:
    """The names of the failed rules, in the order of their bits."""
    bits = F.col(bits) if isinstance(bits, str) else bits
    named = [F.when(bits.bitwiseAND(F.lit(1 << i).cast("long")) != 0, F.lit(r.name)) for i, r in enumerate(rules)]
    return F.array_compact(F.array(*named))
