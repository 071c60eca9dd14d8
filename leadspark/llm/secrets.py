"""Secret scan: patterns on a text and on everything that is encoded in it.

A worklist unwraps URL escapes, Unicode escapes, base64 and compressed layers until nothing
new comes out. Each layer knows, for every character, the span of the original text it came
from, so a secret found five layers deep is reported where its outermost code stands.

A code need not begin or end where a run of its characters does: runs over line breaks are one, every phase
of a run is decoded, and the printable stretches of the bytes and compressed data among them are layers.
"""

from __future__ import annotations

import base64
import bz2
import hashlib
import lzma
import re
import zlib
from collections import deque

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, pick, position

KINDS = ("assign", "access", "hex")
#: Letters of the keyword in either ASCII case; the value has 6 characters or more.
_ASSIGN = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")

_PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
_UNICODE = re.compile(r"(?:\\u[0-9A-Fa-f]{4}|\\U[0-9A-Fa-f]{8}|\\x[0-9A-Fa-f]{2}|\\u\{[0-9A-Fa-f]{1,6}\})+")
_UNICODE_ONE = re.compile(r"\\u\{([0-9A-Fa-f]{1,6})\}|\\u([0-9A-Fa-f]{4})|\\U([0-9A-Fa-f]{8})|\\x([0-9A-Fa-f]{2})")
_BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
#: Starts of compressed data: gzip, zlib (three levels), bz2, xz, zstandard.
_MAGIC = (b"\x1f\x8b", b"\x78\x01", b"\x78\x9c", b"\x78\xda", b"BZh", b"\xfd7zXZ", b"\x28\xb5\x2f\xfd")


def find_base(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end), leftmost without overlap within a kind."""
    found = [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[1]) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    found.sort()
    return found


def _plain(data: bytes) -> str | None:
    """The text of decoded bytes, None when they are no text."""
    try:
        text = data.decode("utf-8")
    except UnicodeDecodeError:
        return None
    odd = sum(1 for c in text if c < " " and c not in "\t\n\r\x0b\x0c")
    return text if text and not odd else None


#: Printable stretches of decoded bytes; the shortest secret has 12 characters.
_STRETCH = re.compile("[^\x00-\x08\x0e-\x1f\udc80-\udcff]{12,}")
_MAGIC_AT = re.compile(rb"\x1f\x8b\x08|x[\x01\x5e\x9c\xda]|BZh[1-9]|\xfd7zXZ\x00|\x28\xb5\x2f\xfd")
#: Bytes fed to a decompressor at a time: what stands before a broken place comes out.
_FED = 256


def _decompressor(data: bytes):
    if data.startswith(b"BZh"):
        return bz2.BZ2Decompressor()
    if data.startswith(b"\xfd7zXZ"):
        return lzma.LZMADecompressor()
    if data.startswith(b"\x28\xb5\x2f\xfd"):
        import zstandard

        return zstandard.ZstdDecompressor().decompressobj()
    return zlib.decompressobj(47)


def _unpack(data: bytes) -> tuple[bytes, int]:
    """What compressed data holds, all members of it, up to its end or a broken place; how many bytes it took."""
    out, at = [], 0
    while _MAGIC_AT.match(data, at):
        one, begun = _decompressor(data[at : at + 8]), at
        try:
            while at < len(data) and not one.eof:
                out.append(one.decompress(data[at : at + _FED]))
                at = min(len(data), at + _FED)
        except (zlib.error, OSError, EOFError, lzma.LZMAError, ValueError):
            return b"".join(out), begun + 1 if at == begun else at
        except Exception as error:  # zstandard has an error class of its own
            if type(error).__name__ != "ZstdError":
                raise
            return b"".join(out), begun + 1 if at == begun else at
        at -= len(one.unused_data)
    return b"".join(out), at


class Layer:
    """Decoded text with the original span of each character (arrays), or of all at once (two numbers)."""

    __slots__ = ("text", "start", "end")

    def __init__(self, text: str, start, end):
        self.text, self.start, self.end = text, start, end

    def span(self, a: int, b: int) -> tuple[int, int]:
        if isinstance(self.start, int):
            return self.start, self.end
        return int(self.start[a]), int(self.end[b - 1])


def _unescaped(layer: Layer, pattern: re.Pattern, decode) -> Layer | None:
    """The whole layer with its escapes undone, other characters as they were."""
    parts, starts, ends, at, changed = [], [], [], 0, False
    text = layer.text
    for m in pattern.finditer(text):
        units = decode(m)
        if units is None:
            continue
        changed = True
        parts += [text[at : m.start()], "".join(u[0] for u in units)]
        starts += [np.arange(at, m.start()), np.array([u[1] for u in units], dtype=np.int64)]
        ends += [np.arange(at, m.start()), np.array([u[2] - 1 for u in units], dtype=np.int64)]
        at = m.end()
    if not changed:
        return None
    parts.append(text[at:])
    first, last = np.concatenate([*starts, np.arange(at, len(text))]).astype(np.int64), np.concatenate([*ends, np.arange(at, len(text))]).astype(np.int64)
    new = "".join(parts)
    if isinstance(layer.start, int):
        return Layer(new, layer.start, layer.end)
    return Layer(new, layer.start[first], layer.end[last])


def _percent_units(m: re.Match) -> list[tuple[str, int, int]] | None:
    """Units of the characters; bytes that are no text stay as they are written."""
    data, at = bytes.fromhex(m[0].replace("%", "")), m.start()
    units, changed = [], False
    for c in data.decode("utf-8", "surrogateescape"):
        n = 3 * len(c.encode("utf-8", "surrogateescape"))
        if c < " " and c not in "\t\n\r\x0b\x0c" or "\udc80" <= c <= "\udcff":
            units += [(m[0][i - m.start()], i, i + 1) for i in range(at, at + n)]
        else:
            units.append((c, at, at + n))
            changed = True
        at += n
    return units if changed else None


def _unicode_units(m: re.Match) -> list[tuple[str, int, int]] | None:
    """Units of the characters; halves without a partner and numbers that are no character stay as they are written."""
    units: list[tuple[str, int, int]] = []
    for one in _UNICODE_ONE.finditer(m[0]):
        code = int(next(g for g in one.groups() if g), 16)
        a, b = m.start() + one.start(), m.start() + one.end()
        if units and 0xDC00 <= code < 0xE000 and 0xD800 <= ord(units[-1][0]) < 0xDC00:
            high = units.pop()
            units.append((chr(0x10000 + ((ord(high[0]) - 0xD800) << 10) + code - 0xDC00), high[1], b))
        elif code > 0x10FFFF:
            units += [(m[0][i - m.start()], i, i + 1) for i in range(a, b)]
        else:
            units.append((chr(code), a, b))
    out = []
    for c, a, b in units:
        out += [(m[0][i - m.start()], i, i + 1) for i in range(a, b)] if 0xD800 <= ord(c) < 0xE000 else [(c, a, b)]
    return out if "".join(u[0] for u in out) != m[0] else None


def _byte_layers(layer: Layer, data: bytes, first: np.ndarray, last: np.ndarray, stretches: bool = True) -> list[Layer]:
    """Layers in decoded bytes; ``first`` and ``last`` are the characters of ``layer`` that hold each byte."""
    out, at = [], 0
    while found := _MAGIC_AT.search(data, at):
        unpacked, used = _unpack(data[found.start() :])
        at = found.start() + max(1, used if unpacked else 1)
        span = layer.span(int(first[found.start()]), int(last[at - 1]) + 1)
        out += [Layer(m[0], *span) for m in _STRETCH.finditer(unpacked.decode("utf-8", "surrogateescape"))]
    if not stretches:
        return out
    text = data.decode("utf-8", "surrogateescape")
    done, offset = 0, 0
    for m in _STRETCH.finditer(text):
        if len(text) == len(data):
            begin = np.arange(m.start(), m.end() + 1)
        else:
            offset += len(text[done : m.start()].encode("utf-8", "surrogateescape"))
            done = m.start()
            begin = offset + np.concatenate([[0], np.cumsum([len(c.encode()) for c in m[0]])])
        a, b = first[begin[:-1]], last[begin[1:] - 1]
        out.append(Layer(m[0], layer.start, layer.end) if isinstance(layer.start, int) else Layer(m[0], layer.start[a], layer.end[b]))
    return out


def _whole(data: bytes) -> str | None:
    """The text of decoded bytes that are text, or compressed text, from end to end."""
    unpacked = _unpack(data)[0] if data.startswith(_MAGIC) else b""
    return _plain(unpacked or data)


def _run_layers(layer: Layer, run: re.Match, bits: int, decode, done: bool) -> list[Layer]:
    """Layers in a run of characters of ``bits`` bits each, from every phase; ``done``: not from the first."""
    places = np.array([i for i in range(run.start(), run.end()) if not layer.text[i].isspace() and layer.text[i] != "="])
    code, out = "".join(layer.text[i] for i in places), []
    for phase in range(1 if done else 0, 4 if bits == 6 else 2):
        data = decode(code[phase:])
        byte = np.arange(len(data))
        out += _byte_layers(layer, data, places[phase + 8 * byte // bits], places[phase + (8 * byte + 7) // bits])
    return out


def _base64_bytes(code: str) -> bytes:
    code = code.replace("-", "+").replace("_", "/")
    # A run that is not a multiple of four long can have a stray character at its end.
    if len(code) % 4 == 1:
        code = code[:-1]
    return base64.b64decode(code + "=" * (-len(code) % 4))


def _hex_bytes(code: str) -> bytes:
    return bytes.fromhex(code[: len(code) // 2 * 2])


def _inner_layers(layer: Layer) -> list[Layer]:
    """All layers one step inside this one."""
    text, out = layer.text, []
    if "%" in text and (found := _unescaped(layer, _PERCENT, _percent_units)):
        out.append(found)
        for m in _PERCENT.finditer(text):
            data = bytes.fromhex(m[0].replace("%", ""))
            at = m.start() + 3 * np.arange(len(data))
            out += _byte_layers(layer, data, at, at + 2, stretches=False)
    if "\\" in text and (found := _unescaped(layer, _UNICODE, _unicode_units)):
        out.append(found)
    for whole, wrapped, bits, decode in ((_BASE64, _BASE64_RUN, 6, _base64_bytes), (_HEX_CODE, _HEX_RUN, 4, _hex_bytes)):
        done = set()
        for m in whole.finditer(text):
            inner = _whole(decode(m[0].rstrip("=")))
            if inner is not None:
                done.add(m.span())
                out.append(Layer(inner, *layer.span(m.start(), m.end())))
        for m in wrapped.finditer(text):
            out += _run_layers(layer, m, bits, decode, m.span() in done)
    return out


_HEX_CODE = re.compile(r"(?:[0-9a-f]{24,}|[0-9A-F]{24,})")
#: Runs that go on after line breaks.
_BASE64_RUN = re.compile(r"[A-Za-z0-9+/_-]{16,}(?:\r?\n[ \t]*[A-Za-z0-9+/_-]+)*={0,2}")
_HEX_RUN = re.compile(r"[0-9A-Fa-f]{16,}(?:\r?\n[ \t]*[0-9A-Fa-f]+)*")
_ENCODED = re.compile(r"%[0-9A-Fa-f]{2}|\\[uUx]|[A-Za-z0-9+/_-]{16}")


def scan_text(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Base spans of the text itself, and all spans: those and what decoded layers add.

    A layer is not opened twice (cycle guard by digest of text and place); every layer is
    scanned whole. Each step inside shortens or unpacks, so the list runs empty.
    """
    base = find_base(text)
    if not _ENCODED.search(text):
        return base, base
    every, seen = set(base), set()
    here = np.arange(len(text), dtype=np.int64)
    work = deque([Layer(text, here, here + 1)])
    while work:
        for inner in _inner_layers(work.popleft()):
            place = inner.span(0, len(inner.text))
            mark = (hashlib.blake2b(inner.text.encode("utf-8", "surrogatepass"), digest_size=16).digest(), place)
            if mark in seen:
                continue
            seen.add(mark)
            for a, kind, b in find_base(inner.text):
                start, end = inner.span(a, b)
                every.add((start, kind, end))
            work.append(inner)
    return base, sorted(every)


def shown(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Secrets of every whole text: one row per row of ``docs``.

    Columns: doc_id, n_assign, n_access, n_hex, base_spans and spans (arrays of kind, start,
    end; code points, end exclusive). NULL or empty text: no spans. Repeated rows and NULL ids
    give a row each, an empty table none, extra columns are ignored. Very long texts are scanned whole;
    a text's layers, with what its compressed data unpacks to, are held by its task one text at a time.
    """
    source = pick(docs, doc_id=id_col, text=text_col).select(F.col("doc_id"), F.col("text").cast("string"))
    id_type = source.schema["doc_id"].dataType.simpleString()
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def start():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            counts, bases, alls = [[], [], []], [], []
            for text in batch.column(1).to_pylist():
                base, every = scan_text(text or "")
                for k, c in enumerate(counts):
                    c.append(sum(1 for s in base if s[1] == k))
                bases.append([{"kind": KINDS[k], "start": a, "end": b} for a, k, b in base])
                alls.append([{"kind": KINDS[k], "start": a, "end": b} for a, k, b in every])
            return pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.int64()) for c in counts), pa.array(bases, span), pa.array(alls, span)],
                                              names=["doc_id", "n_assign", "n_access", "n_hex", "base_spans", "spans"])

        return step

    spans = "array<struct<kind:string,start:bigint,end:bigint>>"
    return map_batches(source, start, f"doc_id {id_type}, n_assign long, n_access long, n_hex long, base_spans {spans}, spans {spans}")


def joined(spans: str):
    """Column: ``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact_text(text: str, mark: str) -> str:
    """Each maximal run of overlapping spans becomes ``mark``."""
    _, spans = scan_text(text)
    out, at, last = [], 0, -1
    for start, _, end in spans:
        if start >= last:
            out += [text[at:start], mark]
        last = max(last, end)
        at = last
    return "".join(out) + text[at:]


def redact_documents(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every secret in ``text`` replaced and ``n_chars`` counted anew; other columns as they were.

    NULL texts stay NULL and keep their count, repeated rows come back as often, an empty table stays
    empty. A table without ``n_chars`` gets none.
    """
    names = docs.columns
    at = position(names, "text")
    counted = position(names, "n_chars") if "n_chars" in (n.lower() for n in names) else None

    def start():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = [None if t is None else redact_text(t, mark) for t in batch.column(at).to_pylist()]
            columns = batch.columns
            columns[at] = pa.array(texts, columns[at].type)
            if counted is not None:
                sizes = [n if t is None else len(t) for t, n in zip(texts, columns[counted].to_pylist(), strict=True)]
                columns[counted] = pa.array(sizes, columns[counted].type)
            return pa.RecordBatch.from_arrays(columns, schema=batch.schema)

        return step

    return map_batches(docs, start, docs.schema)
