"""Language of a text as a mixture of languages.

Letter trigrams (hashed) have a likelihood in every learned language. Expectation-maximisation
finds the shares of the languages in a document; of the sets made of its largest shares the
one with the best penalised likelihood is taken.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .common import map_batches, pick, position

UNKNOWN = "und"
#: Labelled documents of each language that the trigram counts are taken from, about.
SAMPLE_PER_LANGUAGE = 2000
#: Trigrams are counted in 2 ** BUCKET_BITS buckets; count added to each.
BUCKET_BITS, SMOOTHING = 16, 0.5
#: Steps of expectation-maximisation, at most, and the change of a share that ends it.
EM_STEPS, EM_CHANGE = 40, 1e-4
#: Trigrams of an even mixture that every document gets, and the share from which a language is tried.
PRIOR, LEAST_SHARE = 3.0, 0.02


class Trigrams:
    """Buckets of the letter trigrams of a text; anything else than letters is one space."""

    def __init__(self):
        self.letter = np.zeros(0x110000, dtype=bool)
        self.letter[[i for i in range(0x110000) if chr(i).isalpha()]] = True

    def __call__(self, text: str) -> np.ndarray:
        codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        is_letter = self.letter[codes]
        if not is_letter.any():
            return np.zeros(0, dtype=np.uint32)
        keep = is_letter.copy()
        keep[1:] |= is_letter[:-1]  # the first of a run of other characters
        padded = np.concatenate([[32], np.where(is_letter, codes, 32)[keep], [32]]).astype(np.uint32)
        mixed = padded[:-2] * np.uint32(0x9E3779B1) ^ padded[1:-1] * np.uint32(0x85EBCA77) ^ padded[2:] * np.uint32(0xC2B2AE3D)
        return (mixed ^ mixed >> np.uint32(15)) * np.uint32(0x27D4EB2F) >> np.uint32(32 - BUCKET_BITS)


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    likelihood: np.ndarray  # bucket x language


def model_of(counts: dict[str, np.ndarray]) -> Model | None:
    if not counts:
        return None
    languages = tuple(sorted(counts))
    table = np.stack([counts[k] for k in languages], axis=1).astype(np.float64) + SMOOTHING
    return Model(languages, (table / table.sum(axis=0)).astype(np.float32))


def mixture(count: np.ndarray, likelihood: np.ndarray, steps: int = EM_STEPS) -> tuple[np.ndarray, float]:
    """(shares, log likelihood) of the trigram counts (n) under likelihoods (n x languages)."""
    k = likelihood.shape[1]
    if k == 1:
        return np.ones(1), float(count @ np.log(likelihood[:, 0]))
    shares, total = np.full(k, 1.0 / k), count.sum() + PRIOR
    for _ in range(steps):
        weight = likelihood @ shares
        new = (shares * (likelihood.T @ (count / weight)) + PRIOR / k) / total
        change = np.abs(new - shares).max()
        shares = new
        if change < EM_CHANGE:
            break
    return shares, float(count @ np.log(likelihood @ shares))


class Identifier:
    """(language, score, languages of the set) of a text."""

    def __init__(self, model: Model | None):
        self.model, self.trigrams = model, Trigrams()

    def __call__(self, text: str) -> tuple[str, float, list[str]]:
        buckets = self.trigrams(text)
        if not len(buckets) or not self.model:
            return UNKNOWN, 0.0, []
        counts = np.bincount(buckets, minlength=1 << BUCKET_BITS)
        used = np.flatnonzero(counts)
        count, likelihood = counts[used].astype(np.float64), self.model.likelihood[used].astype(np.float64)
        shares, _ = mixture(count, likelihood)
        order = np.argsort(-shares, kind="stable")
        best, chosen, within = -np.inf, order[:1], np.ones(1)
        for k in range(1, len(order) + 1):
            if k > 1 and shares[order[k - 1]] < LEAST_SHARE:
                break
            part, fit = mixture(count, likelihood[:, order[:k]])
            fit -= 0.5 * (k - 1) * np.log(count.sum() + 1)
            if fit > best:
                best, chosen, within = fit, order[:k], part
        first = int(within.argmax())
        return self.model.languages[chosen[first]], float(min(1.0, shares[chosen[first]])), [self.model.languages[i] for i in sorted(chosen)]


def held_out(doc_id: Column) -> Column:
    """Documents whose language is never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE) -> Model | None:
    """Trigram counts of about ``per_language`` documents of each language, those with the least hash of their id.

    Documents without id, text or language and the held-out ones are not learned from. The
    driver sees one vector of counts per language.
    """
    known = pick(docs, doc_id="doc_id", text="text", lang="lang").where("doc_id IS NOT NULL AND text IS NOT NULL AND lang IS NOT NULL").where(~held_out(F.col("doc_id")))
    sizes = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return None
    span = 1 << 30
    limit = F.create_map(*[x for k, n in sizes.items() for x in (F.lit(k), F.lit(min(span, span * per_language // n)))])
    chosen = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(span)) < limit[F.col("lang")]).select("lang", "text")

    def count(batches):
        trigrams, total = Trigrams(), {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                total.setdefault(lang, np.zeros(1 << BUCKET_BITS, dtype=np.int64))
                total[lang] += np.bincount(trigrams(text), minlength=1 << BUCKET_BITS)
        for lang, counts in total.items():
            used = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(used), pa.string()), pa.array(used.astype(np.int32)), pa.array(counts[used])], names=["lang", "bucket", "n"])

    summed = chosen.mapInArrow(count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    table = summed.toArrow()
    counts: dict[str, np.ndarray] = {}
    buckets, values = table.column("bucket").to_numpy(), table.column("n").to_numpy()
    names = np.array(table.column("lang").to_pylist(), dtype=object)
    for lang in set(names.tolist()):
        own = names == lang
        counts[lang] = np.zeros(1 << BUCKET_BITS, dtype=np.int64)
        counts[lang][buckets[own]] = values[own]
    return model_of(counts)


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, lang_pred, score, languages) of every row of ``docs``.

    A NULL text, one without a letter, or any text where nothing was learned is ``und`` with
    score 0. ``languages``: the chosen set. Repeated rows and NULL ids give a row each, extra
    columns are ignored, an empty table gives none; a text is read whole, whatever its length.
    """
    source = pick(docs, doc_id="doc_id", text="text").select(F.col("doc_id"), F.col("text").cast("string"))

    def start():
        known = Identifier(model)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [known(t or "") for t in batch.column(1).to_pylist()]
            return pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64()), pa.array([f[2] for f in found], pa.list_(pa.string()))],
                names=["doc_id", "lang_pred", "score", "languages"])

        return step

    return map_batches(source, start, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, lang_pred string, score double, languages array<string>")


def keep_identified(docs: DataFrame, model: Model | None) -> DataFrame:
    """The rows of ``docs`` whose text has a language; ``und`` goes. A NULL in a text column ``lang`` takes the prediction.

    All other columns stay as they were, and so does a ``lang`` that is there. Without a model (nothing learned) only
    texts without a letter go and no ``lang`` is filled; NULL and empty texts go. Repeated rows are decided
    alike, extra columns stay, an empty table stays empty.
    """
    at = position(docs.columns, "text")
    lang = position(docs.columns, "lang") if "lang" in [n.lower() for n in docs.columns] else None
    if lang is not None and docs.schema[lang].dataType != StringType():
        lang = None

    def start():
        known = Identifier(model)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = [t or "" for t in batch.column(at).to_pylist()]
            if not model:
                return batch.filter(pa.array([bool(len(known.trigrams(t))) for t in texts], pa.bool_()))
            found = [known(t)[0] for t in texts]
            if lang is not None:
                columns = batch.columns
                columns[lang] = pc.coalesce(columns[lang], pa.array(found, columns[lang].type))
                batch = pa.RecordBatch.from_arrays(columns, schema=batch.schema)
            return batch.filter(pa.array([f != UNKNOWN for f in found], pa.bool_()))

        return step

    return map_batches(docs, start, docs.schema)
