"""Every named query against its SQL twin on the smallest data."""

import os

import pytest
from oracle import compare, connect

import __spark_entry__ as entry

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
from leadspark.catalog import ORACLES, QUERIES  # noqa: E402


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, FOLDER)
    if name in ORACLES:
        assert compare(df, con, ORACLES[name]) is None
    else:
        assert df.count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0


ODD_TEXTS = [None, "", "   ", " \t\n", "jo@a.com 11 4444-5555", "  ", "sin datos"]


@pytest.mark.parametrize("name", ["x19_join_texts", "x31_extraction_record"])
def test_blank_and_missing_parts_of_documents(spark, con, tmp_path, name):
    """Texts, languages and sources that are empty or NULL, in all combinations."""
    parts = [(text, lang, source) for text in ODD_TEXTS for lang in (None, "", "de", "es", "en") for source in (None, "", "src1")]
    rows = [(i, *part, len(part[0] or "")) for i, part in enumerate(parts)]
    odd = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    odd.coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    sql = f"WITH documents AS (SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')) {ORACLES[name]}"
    assert compare(QUERIES[name](spark, str(tmp_path)), con, sql) is None


def test_record_of_a_page_without_text(spark):
    from leadspark.operators.enrich import extraction_records

    rows = spark.createDataFrame([(i, "n", "u", text) for i, text in enumerate(ODD_TEXTS)], "id long, nombre string, url string, text string")
    got = {int(r.barrio_id): (r.modelo_usado, r.error) for r in extraction_records(rows).collect()}
    assert got == {i: ("regex_only", None if (text or "").strip() else "Texto vacío") for i, text in enumerate(ODD_TEXTS)}
