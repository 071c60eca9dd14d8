"""Corpus pipeline: civil, identified, distinct documents without secrets, packed into sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from leadspark.llm import langid, neardup, packing, secrets, toxicity
from leadspark.llm.common import documents, stored
from leadspark.llm.queries import BYTE_BPE, MAX_TOKENS


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below 0.7; NULL and empty texts are scored as the empty text."""
    return toxicity.keep_civil(docs, toxicity.train(docs, documents(spark, sf_dir, "labels")))


def drop_unidentified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a letter of a learned language; NULL and empty texts go."""
    return langid.keep_identified(docs, langid.train(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (similarity 0.8): the least doc_id, NULL last."""
    return neardup.keep_one_of_each(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each secret replaced by ``[SECRET]``; NULL texts stay NULL."""
    return secrets.redact_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 2048 tokens; a NULL text is its end id alone."""
    return packing.pack_documents(docs, BYTE_BPE, packing.Capacity(tokens=MAX_TOKENS))


#: Each stage reads what the one before wrote; all but the last return the columns of documents.
STAGES = [
    ("toxicity", drop_toxic),
    ("language_id", drop_unidentified),
    ("simhash_near_dedup", drop_near_duplicates),
    ("secret_scan", redact_secrets),
    ("best_fit_packing", pack),
]

#: Classifiers, fingerprints and token ids have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of what every stage keeps of ``documents``.

    Stages keep all columns; repeated rows are near copies, one of them stays. An empty table gives no rows.
    """
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs


QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}
