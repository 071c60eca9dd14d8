"""CSV records over many splits against Python's csv module."""

import csv
import io
import random

import pytest

from leadspark.sources import csv_records


@pytest.fixture
def small_splits(spark):
    names = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"]
    before = {n: spark.conf.get(n) for n in names}
    for n in names:
        spark.conf.set(n, "64")
    yield
    for n, v in before.items():
        spark.conf.set(n, v)


def text_of(rows, end="\n"):
    out = io.StringIO()
    csv.writer(out, lineterminator=end).writerows(rows)
    return out.getvalue()


def test_records_over_splits(spark, tmp_path, small_splits):
    rnd = random.Random(7)
    parts = ["a", "", 'say "x"', "two\nlines", "a, b", "\n\n", "ñandú", '"', "x" * 150, 'q"\n"r', " pad "]
    want = []
    for k in range(3):
        rows = [[str(i), rnd.choice(parts) + str(i), rnd.choice(parts)] for i in range(60)]
        (tmp_path / f"in{k}.csv").write_text(text_of([["id", "nombre", "nota"]] + rows), encoding="utf-8")
        want += rows
    df = csv_records.read_csv_rows(spark, str(tmp_path))
    assert df.columns == ["id", "nombre", "nota", "row_id"]
    got = {int(r.row_id): r for r in df.collect()}
    assert len(got) == len(want) == df.count()
    for n, row in enumerate(want):
        assert [got[n].id, got[n].nombre, got[n].nota or ""] == row
    scanned = csv_records._lines(spark, str(tmp_path))
    assert scanned.select("__split").distinct().count() > 10


def test_ids_types_and_edges(spark, tmp_path):
    one = tmp_path / "one.csv"
    one.write_bytes("\ufeffid,row_id,n\r\n7,x,1\r\n\r\n8,y,oops\r\n".encode())
    got = csv_records.read_csv_rows(spark, str(one), "id long, row_id string, n int", "id").orderBy("id").collect()
    assert [tuple(r) for r in got] == [(7, 1, "7"), (8, None, "8")]
    assert csv_records.read_csv_rows(spark, str(tmp_path / "absent")).count() == 0
    (tmp_path / "head.csv").write_text("a,b\n")
    head = csv_records.read_csv_rows(spark, str(tmp_path / "head.csv"))
    assert head.columns == ["a", "b", "row_id"] and head.count() == 0
    (tmp_path / "empty.csv").write_text("")
    assert csv_records.read_csv_rows(spark, str(tmp_path / "empty.csv")).count() == 0
    with pytest.raises(ValueError):
        csv_records.read_csv_rows(spark, str(tmp_path))
    (tmp_path / "torn.csv").write_text('a,b\n1,"never\nclosed\n')
    assert csv_records.csv_records(spark, str(tmp_path / "torn.csv")).count() == 2


def test_inferred_types(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a,b,c,d,e\n1,1.5,true,x,\n,2,false,3,\n")
    df = csv_records.read_csv_rows(spark, str(tmp_path), infer=True)
    assert [f.dataType.simpleString() for f in df.schema] == ["bigint", "double", "boolean", "string", "string", "string"]
    assert {tuple(r) for r in df.collect()} == {(1, 1.5, True, "x", None, "0"), (None, 2.0, False, "3", None, "1")}
