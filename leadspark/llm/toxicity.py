"""Toxicity by compression distance.

Two zstandard dictionaries are trained, one on ordinary text and one on what sets toxic text
apart. A document is read in windows; each window is compressed with the ordinary dictionary
and with both, and the bytes that the toxic dictionary saves are its distance. A logistic
model over a document's distances gives the score, shifted so that the threshold that was
best on labelled documents not used for the dictionaries falls on 0.7.

Each byte of a text is written as two before compression: a match then saves twice what it
replaces but costs the same, so that short words can be told from noise.
"""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_batches, pick, position

#: Labelled documents of each class that the model is fitted on, at most.
TOXIC_SAMPLE, ORDINARY_SAMPLE = 1500, 2500
#: Windows of the ordinary sample that its dictionary is trained on, at most.
ORDINARY_WINDOWS = 40_000
#: Bytes of a window (it ends at a space), and sizes of the dictionaries.
WINDOW, TOXIC_BYTES, ORDINARY_BYTES = 64, 2048, 8192
#: A fragment belongs to the toxic samples if so many toxic documents have it, so many times as often as ordinary ones.
LEAST_SHARE, LEAST_LIFT = 0.02, 6.0
THRESHOLD = 0.7
#: Distances (bytes) from which windows are counted.
STEPS = (2, 3, 5, 7, 9, 12)

_WORD = re.compile(r"[^\W\d_]+")
_SECOND = np.array([(i * 167 + 91) & 255 for i in range(256)], dtype=np.uint8)


def doubled(data: bytes) -> bytes:
    first = np.frombuffer(data, dtype=np.uint8)
    out = np.empty((len(first), 2), dtype=np.uint8)
    out[:, 0] = first
    out[:, 1] = _SECOND[first]
    return out.tobytes()


def window_ends(data: bytes, size: int = WINDOW) -> list[int]:
    """Ends of windows of ``size`` bytes and on to the next space, ``2 * size`` at most."""
    ends, at, n = [], 0, len(data)
    while n - at > size:
        end = data.find(b" ", at + size, at + 2 * size)
        at = end if end >= 0 else min(n, at + 2 * size)
        ends.append(at)
    if at < n or not ends:
        ends.append(n)
    return ends


@dataclass(frozen=True)
class Model:
    """Dictionary contents, and weights of the standardised features with the shift of the threshold."""

    toxic: bytes
    ordinary: bytes
    centre: tuple[float, ...]
    scale: tuple[float, ...]
    weights: tuple[float, ...]
    shift: float


class Distances:
    """Saved bytes of every window of a text."""

    def __init__(self, toxic: bytes, ordinary: bytes):
        settings = zstandard.ZstdCompressionParameters(
            window_log=17, hash_log=15, chain_log=15, search_log=6, min_match=6, target_length=32,
            strategy=zstandard.STRATEGY_LAZY2, write_content_size=False, write_checksum=False, write_dict_id=False)

        def compressor(content: bytes) -> zstandard.ZstdCompressor:
            if not content:
                return zstandard.ZstdCompressor(compression_params=settings)
            held = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            held.precompute_compress(compression_params=settings)
            return zstandard.ZstdCompressor(dict_data=held, compression_params=settings)

        self.both, self.plain = compressor(toxic + ordinary).compress, compressor(ordinary).compress

    def __call__(self, text: str) -> np.ndarray:
        data = text.lower().encode("utf-8", "surrogatepass")
        coded, at, out = memoryview(doubled(data)), 0, []
        both, plain = self.both, self.plain
        for end in window_ends(data):
            window = coded[2 * at : 2 * end]
            out.append(len(plain(window)) - len(both(window)))
            at = end
        return np.array(out, dtype=np.float64)


def features(distances: np.ndarray) -> list[float]:
    n = len(distances)
    top = np.sort(distances)[-3:][::-1]
    counts = [int((distances >= k).sum()) for k in STEPS]
    return [*top, *[0.0] * (3 - len(top)), *np.log1p(counts), *(c / n for c in counts), float(np.log1p(n))]


def _different(texts: list[str]) -> list[list[str]]:
    """Words of the texts, without those that mostly repeat earlier ones."""
    seen: set[int] = set()
    out = []
    for text in texts:
        words = _WORD.findall(text.lower())
        shingles = {zlib.crc32(" ".join(words[i : i + 4]).encode()) for i in range(max(1, len(words) - 3))}
        if 2 * len(shingles & seen) <= len(shingles):
            seen |= shingles
            out.append(words)
    return out


def _fragments(toxic: list[list[str]], ordinary: list[list[str]]) -> list[str]:
    """Words and word beginnings that many toxic and few ordinary documents have, the longest that are as frequent."""

    def counted(docs: list[list[str]]) -> Counter:
        total: Counter = Counter()
        for words in docs:
            total.update({w[:n] for w in set(words) for n in range(4, min(len(w), 24) + 1)})
        return total

    count, other = counted(toxic), counted(ordinary)
    least, n, m = max(3, LEAST_SHARE * len(toxic)), max(1, len(toxic)), max(1, len(ordinary))
    good = {g: c for g, c in count.items() if c >= least and c / n >= LEAST_LIFT * (other[g] + 1) / m}
    longer = {g[:-1]: max(good[g], 0) for g in sorted(good, key=good.get)}
    return sorted((g for g in good if longer.get(g, 0) < 0.8 * good[g]), key=lambda g: (good[g], g))


def _trained(samples: list[bytes], size: int) -> bytes:
    """A zstandard dictionary of the samples; their end itself where they are too few to train on."""
    try:
        return zstandard.train_dictionary(size, samples, k=48, d=8).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


def fit(toxic: list[str], ordinary: list[str], odds: float = 1.0, ordinary_windows: int = ORDINARY_WINDOWS) -> Model | None:
    """The model of labelled texts; None if a class has none.

    ``odds``: how many ordinary documents there are for a toxic one. ``ordinary_windows``: so many windows
    of ordinary text at most, drawn at random, train its dictionary. Half of the texts train the
    dictionaries, the others the weights and the threshold.
    """
    if not toxic or not ordinary:
        return None
    known, spare = (toxic[::2], ordinary[::2]), (toxic[1::2] or toxic, ordinary[1::2] or ordinary)
    words, others = _different(known[0]), _different(known[1])
    fragments = _fragments(words, others)
    starts = tuple(fragments)
    samples = [doubled(f" {' '.join(marked)} ".encode()) for d in words if (marked := [w for w in d if w.startswith(starts)])] if starts else []
    plain = []
    for text in known[1]:
        data = text.lower().encode("utf-8", "surrogatepass")
        at = 0
        for end in window_ends(data, 4 * WINDOW):
            plain.append(doubled(data[at:end]))
            at = end
    random.Random(1).shuffle(plain)
    contents = _trained(samples, TOXIC_BYTES) if samples else b"", _trained(plain[:ordinary_windows], ORDINARY_BYTES)
    distances = Distances(*contents)
    x = np.array([features(distances(t)) for t in [*spare[0], *spare[1]]])
    y = np.r_[np.ones(len(spare[0])), np.zeros(len(spare[1]))]
    share = np.where(y == 1, 1.0, odds * len(spare[0]) / len(spare[1]))
    centre, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.c_[np.ones(len(x)), (x - centre) / scale]
    w = np.zeros(z.shape[1])
    ridge = np.diag([0.01, *[2.0] * (z.shape[1] - 1)])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (share * p * (1 - p))[:, None]).T @ z + ridge, z.T @ (share * (p - y)) + ridge @ w)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    raw = z @ w
    order = np.argsort(-raw, kind="stable")
    hits, all_taken = np.cumsum(y[order]), np.cumsum(share[order])
    # Of all cuts, the one with the best F0.7 (a wrong rejection weighs more than a miss).
    quality = 1.49 * hits / (all_taken + 0.49 * y.sum())
    quality[np.append(raw[order][1:] == raw[order][:-1], False)] = -1
    best = int(quality.argmax())
    cut = raw[order][best] if best + 1 == len(raw) else (raw[order][best] + raw[order][best + 1]) / 2
    return Model(*contents, tuple(centre), tuple(scale), tuple(w), float(np.log(THRESHOLD / (1 - THRESHOLD)) - cut))


class Scorer:
    """Score of a text, 0 to 1; a model of None scores 0."""

    def __init__(self, model: Model | None):
        self.model = model
        if model:
            self.distances = Distances(model.toxic, model.ordinary)
            self.centre, self.scale, self.weights = (np.array(v) for v in (model.centre, model.scale, model.weights))

    def __call__(self, text: str) -> float:
        if not self.model:
            return 0.0
        z = (np.array(features(self.distances(text))) - self.centre) / self.scale
        raw = self.weights[0] + z @ self.weights[1:] + self.model.shift
        return float(1 / (1 + np.exp(-np.clip(raw, -30, 30))))


def held_out(doc_id: Column) -> Column:
    """Documents whose labels are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, toxic_sample: int = TOXIC_SAMPLE, ordinary_sample: int = ORDINARY_SAMPLE) -> Model | None:
    """The model from at most ``toxic_sample`` and ``ordinary_sample`` labelled documents that are not held out.

    The ids come first (by the order of their hash), their texts after; a repeated label counts
    as toxic if one of its rows is, a repeated document gives one of its texts.
    """
    texts = pick(docs, doc_id="doc_id", text="text").where("doc_id IS NOT NULL")
    marks = pick(labels, doc_id="doc_id", toxic="toxic").where("doc_id IS NOT NULL AND toxic IS NOT NULL").where(~held_out(F.col("doc_id")))
    known = marks.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")).join(texts.select("doc_id").distinct(), "doc_id", "left_semi")
    counts = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    chosen = [known.where(F.col("toxic") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n) for k, n in ((1, toxic_sample), (0, ordinary_sample))]
    held = texts.join(F.broadcast(chosen[0].unionAll(chosen[1])), "doc_id").select("doc_id", "toxic", F.coalesce("text", F.lit("")).alias("text"))
    rows = held.groupBy("doc_id", "toxic").agg(F.min_by("text", F.struct(F.xxhash64("text"), F.length("text"))).alias("text")).collect()
    rows.sort(key=lambda r: (zlib.crc32(str(r["doc_id"]).encode()), r["doc_id"], r["text"]))
    return fit([r["text"] for r in rows if r["toxic"]], [r["text"] for r in rows if not r["toxic"]], counts.get(0, 0) / max(1, counts.get(1, 0)))


def score_documents(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, score) of every row of ``docs``; NULL and empty texts are scored as the empty text.

    Repeated rows and NULL ids give a row each with equal scores, extra columns are ignored, an empty
    table gives none. A text is scored whole, window by window, whatever its length.
    """
    source = pick(docs, doc_id="doc_id", text="text").select(F.col("doc_id"), F.col("text").cast("string"))

    def start():
        score = Scorer(model)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array([score(t or "") for t in batch.column(1).to_pylist()], pa.float64())], names=["doc_id", "score"])

        return step

    return map_batches(source, start, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, score double")


def keep_civil(docs: DataFrame, model: Model | None, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose score is below ``threshold``, all columns as they were.

    NULL and empty texts are scored as the empty text, repeated rows are decided alike; an empty table stays empty.
    """
    at = position(docs.columns, "text")

    def start():
        score = Scorer(model)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            return batch.filter(pa.array([score(t or "") < threshold for t in batch.column(at).to_pylist()], pa.bool_()))

        return step

    return map_batches(docs, start, docs.schema)
