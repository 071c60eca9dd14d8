"""Repair of conversations: the cheapest edits that make the turns follow ``(s?(ua)+)?``.

Weighted CYK over spans of turns. The grammar (``RULES``, Chomsky normal form) has one symbol for every
kind of turn sequence: empty, or by its first and last role, with or without a leading system turn.
A cell holds, for every symbol, the least (cost, audit) of the edits that turn the span's rows into
such a sequence; the cell of a row is closed under insertions on both sides. Cells are combined bottom-up
by span length. The symbols are closed under cutting (every cut of a sequence of a symbol gives
two sequences that have symbols), so all cuts of a span give one and the same cell, and it is enough to combine a span at
one of them: spans of 1, 2, 4 ... rows, work linear in the turns. Of two audits of one span and cost neither begins
with the other (both use every row, and one more insertion costs more), so least audits of parts make
the least audit of the whole.

Rows are sorted by range partitioning over (conversation, turn, beginnings of role and text), so a conversation
with a third of all rows lies in many tasks. A task cuts its rows into chunks of bounded
size. Conversations that lie in one chunk, away from the ends of their task, are repaired there. The others
(two a task, and the long ones) share repeated turns by digest, and combine the
cells of their chunks 16 at a time, with a written table a round; texts move only once more, chunk by
chunk, for the digest of their repaired form.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..operators.grouping import null_safe_join
from .common import map_batches, pick, scratch, stored

SPACES = " \t\n\x0b\f\r"
ENDS = ".!?"
DELETE, REROLE, INSERT, TRUNCATED = 3, 2, 2, 1
FULL = {"u": "user", "a": "assistant"}
LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}

#: Rows and characters of a chunk (a longer text is a chunk of its own), and chunks combined at a time.
CHUNK_ROWS, CHUNK_CHARS = 1024, 4_000_000
FAN_IN = 16
#: Beginnings of role and text that take part in the range partitioning.
ROLE_HEAD, TEXT_HEAD = 32, 64
#: Rows of a chunk without faults and with each of them.
SOUND, CUT_OFF, BLANK, DUPLICATE = range(4)

# ------------------------------------------------------------------ grammar

#: Symbols: empty, first and last role of an alternation, the system turn, alternations after it.
SYMBOLS = ["E", "UU", "UA", "AU", "AA", "S", "SU", "SA"]
#: parent -> left right
RULES = [
    ("UU", "UU", "AU"), ("UU", "UA", "UU"),
    ("UA", "UU", "AA"), ("UA", "UA", "UA"),
    ("AU", "AU", "AU"), ("AU", "AA", "UU"),
    ("AA", "AU", "AA"), ("AA", "AA", "UA"),
    ("SU", "S", "UU"), ("SU", "SU", "AU"), ("SU", "SA", "UU"),
    ("SA", "S", "UA"), ("SA", "SU", "AA"), ("SA", "SA", "UA"),
    ("E", "E", "E"), *[(x, "E", x) for x in SYMBOLS[1:]], *[(x, x, "E") for x in SYMBOLS[1:]],
]
TERMINALS = {"u": "UU", "a": "AA", "s": "S"}
#: A whole conversation is one of these.
ACCEPTED = ["E", "UA", "SA"]

Cell = tuple  # of (cost, audit) or None, one a symbol
_AT = {name: i for i, name in enumerate(SYMBOLS)}
_RULES = [(_AT[p], _AT[left], _AT[right]) for p, left, right in RULES]
_INITIALS = "sua"
_OTHER = len(_INITIALS)


def combine(left: Cell, right: Cell) -> Cell:
    """The cell of two neighbouring spans."""
    out: list = [None] * len(SYMBOLS)
    for parent, a, b in _RULES:
        x, y = left[a], right[b]
        if x is None or y is None:
            continue
        cost, best = x[0] + y[0], out[parent]
        if best is None or cost < best[0]:
            out[parent] = (cost, x[1] + y[1])
        elif cost == best[0] and (audit := x[1] + y[1]) < best[1]:
            out[parent] = (cost, audit)
    return tuple(out)


def _least(a: Cell, b: Cell) -> Cell:
    return tuple(min((v for v in pair if v is not None), default=None) for pair in zip(a, b, strict=True))


def _cell(entries: dict[str, tuple[int, str]]) -> Cell:
    return tuple(entries.get(name) for name in SYMBOLS)


@lru_cache(maxsize=1)
def insertions() -> Cell:
    """What insertions alone can make, cheapest first: combined until nothing gets cheaper."""
    cell = _cell({"E": (0, ""), TERMINALS["u"]: (INSERT, "I"), TERMINALS["a"]: (INSERT, "I")})
    while (more := _least(cell, combine(cell, cell))) != cell:
        cell = more
    return cell


def code(initial: str, fault: int) -> int:
    """One byte a row: its role initial (s, u, a, another) and its first fault."""
    at = _INITIALS.find(initial) if initial else -1
    return (at if at >= 0 else _OTHER) + 4 * fault


@lru_cache(maxsize=64)
def row_cell(row: int) -> Cell:
    """The edits of one row, closed under insertions before and after it."""
    initial, fault = row % 4, row // 4
    entries = {"E": (DELETE, "D")}
    if fault in (SOUND, CUT_OFF):
        late = TRUNCATED if fault == CUT_OFF else 0
        for symbol in "ua":
            entries[TERMINALS[symbol]] = (REROLE + late, "R")
        if initial < _OTHER:
            entries[TERMINALS[_INITIALS[initial]]] = (late, "K")
    return combine(combine(insertions(), _cell(entries)), insertions())


def fold(cells: list[Cell]) -> Cell:
    """The cell of a run of neighbouring spans, combined bottom-up by span length."""
    while len(cells) > 1:
        pairs = [combine(cells[i], cells[i + 1]) for i in range(0, len(cells) - 1, 2)]
        cells = pairs + cells[len(pairs) * 2:]
    return cells[0] if cells else insertions()


@lru_cache(maxsize=1 << 14)
def _parse_short(codes: bytes) -> Cell:
    return fold([row_cell(c) for c in codes])


def parse(codes: bytes) -> Cell:
    return _parse_short(codes) if len(codes) <= 32 else fold([row_cell(c) for c in codes])


def accepted(cell: Cell) -> tuple[int, str, str]:
    """(cost, audit, symbol) of the cheapest way to a whole conversation."""
    return min((*cell[_AT[name]], name) for name in ACCEPTED if cell[_AT[name]] is not None)


# ------------------------------------------------------------------ rows


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows with planted faults (nulls as one space), by ``crc32(conv_id:turn) % 20``.

    ``copies`` is 0 for a dropped row and 2 for a repeated one, else 1.
    """
    rows = pick(conversations, conv_id="conv_id", turn="turn", role="role", text="text")
    named = F.concat(*[F.coalesce(F.col(c).cast("string"), F.lit(" ")) if c else F.lit(":") for c in ("conv_id", "", "turn")])
    fault = F.crc32(named) % 20
    text = F.coalesce("text", F.lit(" "))
    return rows.select(
        "conv_id", "turn",
        F.when(fault == 4, "user").otherwise(F.coalesce("role", F.lit(" "))).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1).alias("copies"),
    )


_SUMMARY = [
    ("n", "long"), ("codes", "binary"), ("first", "string"), ("last", "string"), ("illegal", "long"),
    ("low", "long"), ("high", "long"), ("turns", "long"),
]
_REPORT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


class _Chunk:
    """Rows of one conversation, in order; turns that repeat are coded within the chunk only."""

    def __init__(self, conv_id):
        self.conv_id, self.codes, self.roles, self.texts, self.chars = conv_id, bytearray(), [], [], 0
        self.seen: set = set()
        self.first = self.last = self.low = self.high = None
        self.illegal = self.turns = 0

    def add(self, turn, role: str, text: str) -> None:
        end = text.rstrip(SPACES)[-1:]
        if not end:
            fault = BLANK
        elif (role, text) in self.seen:
            fault = DUPLICATE
        else:
            self.seen.add((role, text))
            fault = SOUND if end in ENDS else CUT_OFF
        initial = role[:1]
        if self.codes:
            self.illegal += (self.last, initial) not in LEGAL
        else:
            self.first = initial
        self.last = initial
        if turn is not None:
            self.turns += self.high is None or turn != self.high
            self.low = turn if self.low is None else self.low
            self.high = turn
        self.codes.append(code(initial, fault))
        self.roles.append(role)
        self.texts.append(text)
        self.chars += len(text) + len(role)

    def full(self, rows: int) -> bool:
        return len(self.codes) >= rows or self.chars >= CHUNK_CHARS

    def row(self, task: int, seq: int, open_: bool) -> dict:
        keys = None
        if open_:
            keys = [
                hashlib.sha256(f"{len(r)}:{r}{t}".encode()).digest() if c // 4 in (SOUND, CUT_OFF) else None
                for c, r, t in zip(self.codes, self.roles, self.texts, strict=True)
            ]
        return {
            "conv_id": self.conv_id, "task": task, "seq": seq, "open": open_, "n": len(self.codes),
            "codes": bytes(self.codes), "first": self.first, "last": self.last, "illegal": self.illegal, "low": self.low,
            "high": self.high, "turns": self.turns, "roles": self.roles, "texts": self.texts, "keys": keys,
        }


_CHUNK_ARROW = [
    ("task", pa.int32()), ("seq", pa.int64()), ("open", pa.bool_()), ("n", pa.int64()), ("codes", pa.binary()),
    ("first", pa.string()), ("last", pa.string()), ("illegal", pa.int64()), ("low", pa.int64()), ("high", pa.int64()),
    ("turns", pa.int64()), ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string())), ("keys", pa.list_(pa.binary())),
]
_CHUNK_SQL = ("task int, seq long, open boolean, n long, codes binary, first string, last string, illegal long, low long, "
              "high long, turns long, roles array<string>, texts array<string>, keys array<binary>")


def _cut(rows: Iterator[tuple], task: int, most: int = CHUNK_ROWS) -> Iterator[dict]:
    """Chunks of sorted rows. Conversations that may go on in another chunk or task are open."""
    chunk, seq, first, several = None, 0, True, False
    for conv_id, turn, role, text, copies in rows:
        if chunk is not None and conv_id != chunk.conv_id:
            yield chunk.row(task, seq, first or several)
            chunk, seq, first, several = None, seq + 1, False, False
        chunk = chunk or _Chunk(conv_id)
        for _ in range(copies):
            if chunk.full(most):
                yield chunk.row(task, seq, True)
                chunk, seq, several = _Chunk(conv_id), seq + 1, True
            chunk.add(turn, role, text)
    if chunk is not None:
        yield chunk.row(task, seq, True)


def _chunks(rows: DataFrame, most: int) -> DataFrame:
    """All rows as chunks, in the order of (task, seq)."""
    rows = pick(rows, conv_id="conv_id", turn="turn", role="role", text="text", copies="copies").withColumn(
        "turn", F.col("turn").cast("long"))
    heads = [F.substring("role", 1, ROLE_HEAD), F.substring("text", 1, TEXT_HEAD)]
    turn = F.col("turn").asc_nulls_first()
    ordered = rows.repartitionByRange(F.col("conv_id").asc_nulls_first(), turn, *heads).sortWithinPartitions(
        F.col("conv_id").asc_nulls_first(), turn, *heads, "role", "text")
    identity = rows.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = None

        def stream() -> Iterator[tuple]:
            nonlocal kind
            for batch in batches:
                kind = batch.schema.field("conv_id").type
                for at in range(0, batch.num_rows, 256):
                    yield from zip(*(c.to_pylist() for c in batch.slice(at, 256).columns), strict=True)

        def packed(out: list[dict]) -> pa.RecordBatch:
            arrays = [pa.array([r[name] for r in out], of) for name, of in [("conv_id", kind), *_CHUNK_ARROW]]
            return pa.RecordBatch.from_arrays(arrays, ["conv_id", *[name for name, _ in _CHUNK_ARROW]])

        out, chars = [], 0
        for row in _cut(stream(), TaskContext.get().partitionId(), most):
            out.append(row)
            chars += sum(map(len, row["texts"])) + 100
            if chars > CHUNK_CHARS:
                yield packed(out)
                out, chars = [], 0
        if out:
            yield packed(out)

    return ordered.mapInArrow(run, f"conv_id {identity}, {_CHUNK_SQL}")


def _counts(codes: bytes) -> dict[int, int]:
    faults = [c // 4 for c in codes]
    return {kind: faults.count(kind) for kind in (BLANK, DUPLICATE, CUT_OFF)}


def _report(chunks: list[dict], cost: int, audit: str) -> dict:
    """The figures of a conversation from its chunks in order (dropped rows are in none)."""
    found = {"gaps": 0, "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "cost": cost, "audit": audit}
    last = low = high = None
    turns = 0
    for chunk in chunks:
        if not chunk["n"]:
            continue
        found["illegal"] += chunk["illegal"] + (last is not None and (last, chunk["first"]) not in LEGAL)
        last = chunk["last"]
        if chunk["low"] is not None:
            turns += chunk["turns"] - (chunk["low"] == high)
            low = chunk["low"] if low is None else low
            high = chunk["high"]
        for name in ("blank", "duplicate", "truncated"):
            found[name] += chunk[name]
    if low is not None:
        found["gaps"] = min(high - low + 1 - turns, (1 << 63) - 1)
    return found


def _repaired(roles: list[str], texts: list[str], audit: str, expected: str) -> list[str]:
    """``role:text`` of the rows after the edits; ``expected`` is the role the next user or assistant turn has."""
    out, at = [], 0
    for edit in audit:
        system = False
        if edit == "I":
            out.append(f"{FULL[expected]}:")
        elif edit == "R":
            out.append(f"{FULL[expected]}:{texts[at]}")
        elif edit == "K":
            out.append(f"{roles[at]}:{texts[at]}")
            system = roles[at][:1] == "s"
        at += edit != "I"
        if edit != "D" and not system:
            expected = "a" if expected == "u" else "u"
    return out


def pieces(sizes: list[int], audit: str, symbol: str) -> list[tuple[str, str]]:
    """The audit cut at the chunks of ``sizes`` rows: (part, role expected at its start); the last
    chunk takes the insertions at the end."""
    out, at, expected = [], 0, "u"
    leading = symbol == "SA"
    for k, size in enumerate(sizes):
        start, left = at, size
        while left:
            left -= audit[at] != "I"
            at += 1
        if k == len(sizes) - 1:
            at = len(audit)
        part = audit[start:at]
        out.append((part, expected))
        made = len(part) - part.count("D")
        if made and leading:
            made, leading = made - 1, False
        if made % 2:
            expected = "a" if expected == "u" else "u"
    return out


@dataclass(frozen=True)
class Repaired:
    """``whole``: conversations of one chunk, with their report and ``repaired`` text. ``reports``
    and ``parts`` (conv_id, part, lines, repaired): the others, whose repaired text is the parts with lines, in
    order, joined by line breaks."""

    whole: DataFrame
    reports: DataFrame
    parts: DataFrame


def _finish_whole():
    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = batch.to_pylist()
        found, texts = [], []
        for r in rows:
            cost, audit, _ = accepted(parse(r["codes"]))
            counts = _counts(r["codes"])
            r |= {"blank": counts[BLANK], "duplicate": counts[DUPLICATE], "truncated": counts[CUT_OFF]}
            found.append(_report([r], cost, audit))
            texts.append("\n".join(_repaired(r["roles"], r["texts"], audit, "u")))
        names = [c.split()[0] for c in _REPORT.split(", ")]
        arrays = [pa.array([f[n] for f in found], pa.string() if n == "audit" else pa.int64()) for n in names]
        return pa.RecordBatch.from_arrays([batch["conv_id"], *arrays, pa.array(texts, pa.string())], ["conv_id", *names, "repaired"])

    return step


_CELLS = pa.list_(pa.struct([("cost", pa.int64()), ("audit", pa.string())]))
_CELLS_SQL = "cells array<struct<cost:long, audit:string>>"


def _to_rows(cell: Cell) -> list:
    return [None if v is None else {"cost": v[0], "audit": v[1]} for v in cell]


def _to_cell(rows: list) -> Cell:
    return tuple(None if v is None else (v["cost"], v["audit"]) for v in rows)


def _first_cells():
    """Codes of a chunk with the turns that repeat earlier chunks, their counts and the chunk's cell."""
    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        codes, cells, counts = [], [], []
        for old, again in zip(batch["codes"].to_pylist(), batch["again"].to_pylist(), strict=True):
            new = bytearray(old)
            for at in again or ():
                new[at] = new[at] % 4 + 4 * DUPLICATE
            codes.append(bytes(new))
            counts.append(_counts(new))
            cells.append(_to_rows(parse(bytes(new))))
        keep = [n for n in batch.schema.names if n not in ("codes", "again")]
        return pa.RecordBatch.from_arrays(
            [*(batch[n] for n in keep), pa.array(codes, pa.binary()),
             *(pa.array([c[k] for c in counts], pa.int64()) for k in (BLANK, DUPLICATE, CUT_OFF)), pa.array(cells, _CELLS)],
            [*keep, "codes", "blank", "duplicate", "truncated", "cells"])

    return step


def _fold_groups():
    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        cells = [_to_rows(fold([_to_cell(m["cells"]) for m in members])) for members in batch["members"].to_pylist()]
        return pa.RecordBatch.from_arrays([batch["conv_id"], batch["at"], pa.array(cells, _CELLS)], ["conv_id", "at", "cells"])

    return step


def _assemble():
    """Report and parts of a conversation from its cell and the summaries of its chunks."""
    piece = pa.list_(pa.struct([("task", pa.int32()), ("seq", pa.int64()), ("part", pa.int64()),
                                ("edits", pa.string()), ("expected", pa.string())]))

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        found, parts = [], []
        for cell, chunks in zip(batch["cells"].to_pylist(), batch["chunks"].to_pylist(), strict=True):
            cost, audit, symbol = accepted(_to_cell(cell))
            found.append(_report(chunks, cost, audit))
            cut = pieces([c["n"] for c in chunks], audit, symbol)
            parts.append([
                {"task": c["task"], "seq": c["seq"], "part": k, "edits": edits, "expected": expected}
                for k, (c, (edits, expected)) in enumerate(zip(chunks, cut, strict=True))])
        names = [c.split()[0] for c in _REPORT.split(", ")]
        arrays = [pa.array([f[n] for f in found], pa.string() if n == "audit" else pa.int64()) for n in names]
        return pa.RecordBatch.from_arrays([batch["conv_id"], *arrays, pa.array(parts, piece)], ["conv_id", *names, "pieces"])

    return step


def _finish_parts():
    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        lines = [
            _repaired(r["roles"], r["texts"], r["edits"], r["expected"])
            for r in batch.select(["roles", "texts", "edits", "expected"]).to_pylist()]
        return pa.RecordBatch.from_arrays(
            [batch["conv_id"], batch["part"], pa.array(map(len, lines), pa.int64()), pa.array(map("\n".join, lines), pa.string())],
            ["conv_id", "part", "lines", "repaired"])

    return step


def _repeats(chunks: DataFrame) -> DataFrame:
    """``task, seq, again``: places of turns that an earlier chunk of their conversation holds."""
    rows = chunks.select("conv_id", "task", "seq", F.posexplode("keys").alias("at", "key")).filter(F.col("key").isNotNull())
    place = F.struct("task", "seq", "at")
    # A conversation in one chunk repeats nothing that its chunk does not know.
    earliest = rows.groupBy("conv_id", "key").agg(F.min(place).alias("earliest"), F.count(F.lit(1)).alias("times")).filter(
        F.col("times") > 1).drop("times")
    again = null_safe_join(rows, earliest, ["conv_id", "key"]).filter(place > F.col("earliest"))
    return again.groupBy("task", "seq").agg(F.collect_list("at").alias("again"))


def repair(rows: DataFrame, chunk_rows: int = CHUNK_ROWS, fan_in: int = FAN_IN) -> Repaired:
    """Conversations (``conv_id, turn, role, text, copies``) with their faults and cheapest repair.

    Rows are taken by turn (nulls first), then by role and text (so ties and repeated rows have one
    order; equal rows are duplicates). A null ``conv_id`` is a conversation of its own. Empty texts are
    blank; a text of any length counts whole. A role other than s..., u..., a... can only be deleted or
    given a new role. Gaps beyond a long are cut to its largest value. Conversations without a row left
    have zeros and empty texts; an empty table gives an empty result. Further columns, also
    of clashing names, are not read.
    """
    spark = rows.sparkSession
    cut = _chunks(rows, chunk_rows)
    path = scratch(spark, "turns-chunks")
    cut.write.option("compression", "zstd").parquet(path)
    chunks = spark.read.schema(cut.schema).parquet(path)
    identity = f"conv_id {cut.schema['conv_id'].dataType.simpleString()}"

    whole = map_batches(chunks.filter("NOT open").drop("keys"), _finish_whole, f"{identity}, {_REPORT}, repaired string")

    open_ = chunks.filter("open")
    summary = open_.select("conv_id", "task", "seq", *[name for name, _ in _SUMMARY])
    summary = summary.join(_repeats(open_), ["task", "seq"], "left").select(*summary.columns, "again")
    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in summary.schema if f.name not in ("codes", "again"))
    known = stored(map_batches(
        summary.select(*[c for c in summary.columns if c not in ("codes", "again")], "codes", "again"), _first_cells,
        f"{types}, codes binary, blank long, duplicate long, truncated long, {_CELLS_SQL}"), "turns-open")

    order = W.partitionBy("conv_id").orderBy("task", "seq")
    state = known.select("conv_id", (F.row_number().over(order) - 1).cast("long").alias("at"), "cells")
    width = known.groupBy("conv_id").count().agg(F.max("count").alias("n")).first().n or 0
    while width > 1:
        groups = state.groupBy("conv_id", F.floor(F.col("at") / fan_in).alias("up")).agg(
            F.sort_array(F.collect_list(F.struct("at", "cells"))).alias("members"))
        state = stored(map_batches(groups.withColumnRenamed("up", "at"), _fold_groups, f"{identity}, at long, {_CELLS_SQL}"), "turns-round")
        width = -(-width // fan_in)

    listed = known.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct(
        "task", "seq", "n", "first", "last", "illegal", "low", "high", "turns", "blank", "duplicate", "truncated"))).alias("chunks"))
    done = stored(map_batches(
        null_safe_join(state.select("conv_id", "cells"), listed, ["conv_id"]), _assemble,
        f"{identity}, {_REPORT}, pieces array<struct<task:int, seq:long, part:long, edits:string, expected:string>>"), "turns-done")

    placed = done.select(F.explode("pieces").alias("p")).select("p.*")
    texts = open_.select("conv_id", "task", "seq", "roles", "texts").join(placed, ["task", "seq"])
    parts = map_batches(texts, _finish_parts, f"{identity}, part long, lines long, repaired string")
    return Repaired(whole, done.drop("pieces"), parts)


def _digest_parts(parts: DataFrame) -> DataFrame:
    """The digest of every conversation, its parts streamed in order through one state."""
    ordered = parts.filter("lines > 0").repartition("conv_id").sortWithinPartitions("conv_id", "part").select("conv_id", "repaired")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None  # (conv_id, digest)
        for batch in batches:
            kind = batch["conv_id"].type
            for at in range(0, batch.num_rows, 64):
                some = batch.slice(at, 64)
                done = []
                for conv_id, text in zip(some["conv_id"].to_pylist(), some["repaired"].to_pylist(), strict=True):
                    if state is not None and state[0] == conv_id:
                        state[1].update(b"\n")
                    else:
                        done += [state] * (state is not None)
                        state = (conv_id, hashlib.sha256())
                    state[1].update(text.encode())
                if done:
                    yield _digest_rows(done, kind)
        if state is not None:
            yield _digest_rows([state], kind)

    return ordered.mapInArrow(run, f"conv_id {parts.schema['conv_id'].dataType.simpleString()}, repaired_sha256 string")


def _digest_rows(done: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([d[0] for d in done], kind), pa.array([d[1].hexdigest() for d in done], pa.string())], ["conv_id", "repaired_sha256"])


def digested(result: Repaired) -> DataFrame:
    """A row a conversation: the report and the SHA-256 of the repaired text."""
    whole = result.whole.withColumn("repaired_sha256", F.sha2("repaired", 256)).drop("repaired")
    digests = _digest_parts(result.parts)
    empty = F.sha2(F.lit(""), 256)
    split = null_safe_join(result.reports, digests, ["conv_id"], "left").withColumn(
        "repaired_sha256", F.coalesce("repaired_sha256", empty))
    return whole.unionByName(split)

