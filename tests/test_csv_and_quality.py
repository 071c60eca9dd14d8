"""Export contract, lead scores, batch summaries, production comparison, ledger."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from leadspark.functions import scoring
from leadspark.operators import quality
from leadspark.plans import jobs
from leadspark.schemas import CSV_COLUMNS, LEAD_SCHEMA
from leadspark.sources import jsonl, lead_csv, ledger, lots

T0 = datetime(2025, 6, 15, 12, 30)


def lead(**values):
    base = {"nombre": "X", "vertical": "hoteles", "estado_comercial": "SIN_CONTACTAR", "email_validado": False,
            "fecha_enriquecimiento": T0, "pais": "Argentina", "metadata": "{}"}
    return tuple({**base, **values}.get(f.name) for f in LEAD_SCHEMA.fields)


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), LEAD_SCHEMA)


def test_export_row(spark):
    meta = '{"tipo_barrio":"cerrado","lotes":450,"amenities":["piscina"]}'
    df = frame(spark, lead(nombre='Club "Náutico", Ñ\nsur', latitud=-34.458712, longitud=-58.914801, email_validado=True,
                           email_score=80, metadata=meta), lead())
    rows = lead_csv.export_row(df).collect()
    assert lead_csv.export_row(df).columns == CSV_COLUMNS and len(CSV_COLUMNS) == 21 and "notas" not in CSV_COLUMNS
    assert (rows[0].latitud, rows[0].longitud) == ("-34.458712", "-58.914801")
    assert (rows[0].email_validado, rows[1].email_validado) == ("true", "false")
    assert rows[0].fecha_enriquecimiento == "2025-06-15T12:30:00Z" and rows[0].metadata == meta
    assert (rows[1].email, rows[1].metadata, rows[1].email_score) == ("", "", "")


def test_csv_round_trip(spark, tmp_path):
    path = str(tmp_path / "out")
    assert lead_csv.read_leads_csv(spark, path).count() == 0
    df = frame(spark, lead(nombre='Club "Náutico", Ñ\nsur', metadata='{"a":"b, c"}'), lead(nombre="\\barra"))
    lead_csv.append_leads_csv(df, path)
    lead_csv.append_leads_csv(df, path)
    back = lead_csv.read_leads_csv(spark, path)
    assert back.columns == CSV_COLUMNS and back.count() == 4
    assert {r.nombre for r in back.collect()} == {'Club "Náutico", Ñ\nsur', "\\barra"}
    assert {r.metadata for r in back.collect()} == {'{"a":"b, c"}', ""}
    lead_csv.write_leads_csv(df, path)
    assert lead_csv.read_leads_csv(spark, path).count() == 2


def test_python_reads_the_export(spark, tmp_path):
    import csv
    import glob

    path = str(tmp_path / "out")
    lead_csv.write_leads_csv(frame(spark, lead(nombre='a "b", c', email="x@y.com")).coalesce(1), path)
    with open(glob.glob(path + "/part-*.csv")[0], newline="", encoding="utf-8") as f:
        rows = list(csv.DictReader(f))
    assert list(rows[0]) == CSV_COLUMNS and rows[0]["nombre"] == 'a "b", c' and rows[0]["email_2"] == ""


def test_minimal_and_production_lead(spark):
    rows = lead_csv.export_row(frame(spark, lead(email="a@b.com", latitud=1.5), lead(nombre="")))
    got = lead_csv.minimal_lead(rows).collect()
    assert len(got) == 1 and got[0].latitud == 1.5 and got[0].telefono is None
    prod = spark.createDataFrame([(" A ", "hoteles", " "), ("B", "raro", "Tigre"), ("  ", "hoteles", "x")], "nombre string, vertical string, partido string")
    assert [tuple(r) for r in lead_csv.production_lead(prod).collect()] == [("A", "hoteles", None), ("B", "barrios_privados", "Tigre")]


def test_scores(spark):
    full = lead(email="i@t.com", telefono="011", sitio_web="https://t.com", partido="Pilar", localidad="Pilar",
                latitud=-34.45, longitud=-58.91, email_validado=True)
    got = quality.score_leads(frame(spark, full, lead(), lead(email="x@x.com"), lead(latitud=1.0, email=""))).collect()
    assert [r.score for r in got] == [100.0, 0.0, 25.0, 0.0]
    assert got[0].missing_fields == [] and got[1].missing_fields == ["email", "telefono", "sitio_web", "partido", "localidad", "coordenadas"]
    assert [r.has_critical for r in got] == [True, False, True, False]
    assert got[1].completeness == 10.0 and got[3].completeness == 30.0


def test_summary(spark):
    rows = [lead(nombre=f"Lead {i}", email=f"l{i}@x.com" if i % 2 == 0 else None, telefono="011" if i % 3 == 0 else None,
                 sitio_web="https://x.com" if i % 4 == 0 else None) for i in range(10)]
    df = frame(spark, *rows).withColumn("ord", F.monotonically_increasing_id())
    s = quality.summarize_batch(df, "hoteles").first()
    assert (s.total, s.pct_with_email, s.exact_duplicates) == (10, 50.0, 0)
    empty = quality.summarize_batch(df.filter("false"), "hoteles").first()
    assert (empty.total, empty.avg_score, empty.upload_ready) == (0, 0.0, False)
    few = quality.upload_ready(quality.field_metrics(df.limit(3))).first()
    assert not few.upload_ready
    twice = frame(spark, lead(nombre="N", partido="T"), lead(nombre="N", partido="T"), lead(nombre="El Canton")).withColumn(
        "ord", F.monotonically_increasing_id())
    assert quality.summarize_batch(twice, "hoteles").first().exact_duplicates == 1
    floor = quality.floor_percent_summary(df.filter("false")).first()
    assert (floor.total, floor.pct_con_email) == (0, 0)


def test_production_comparison(spark):
    new = spark.createDataFrame([(1, "Intercontinental Hotel", "Retiro"), (2, "Hotel Nuevo", None)], "ord bigint, nombre string, partido string")
    prod = spark.createDataFrame([(1, "Hotel Intercontinental", "Retiro", "hoteles")], "ord bigint, nombre string, partido string, vertical string")
    unique, matches, summary = jobs.production_job(new, prod)
    assert [r.nombre for r in unique.collect()] == ["Hotel Nuevo"] and matches.count() == 1
    assert summary.first().pct_new == 50.0
    assert jobs.production_job(new, None)[2].first().pct_new == 100.0


def test_bands(spark):
    df = spark.createDataFrame([(70.0,), (69.9,), (40.0,), (39.0,)], "score double")
    assert [r[0] for r in df.select(scoring.quality_band()).collect()] == ["alta", "media", "media", "baja"]


def test_ledger(spark, tmp_path):
    book = ledger.Ledger(spark, str(tmp_path / "ledger"))
    assert [r.vertical for r in book.active().collect()] == ["barrios_privados"]
    book.activate("hoteles", T0, "p1", "s1")
    book.activate("hoteles", T0 + timedelta(hours=1), "p2", "s2")
    row = book.active().filter("vertical = 'hoteles'").first()
    assert (row.activado_en, row.prompt_path) == (T0, "p2")
    book.deactivate("hoteles", T0 + timedelta(hours=2))
    assert book.active().filter("vertical = 'hoteles'").count() == 0
    book.activate("hoteles", T0 + timedelta(hours=3), "p3", "s3")
    assert book.active().filter("vertical = 'hoteles'").first().activado_en == T0 + timedelta(hours=3)
    with pytest.raises(ValueError):
        book.deactivate("barrios_privados", T0)
    with pytest.raises(ValueError):
        book.activate("otra", T0)
    book.create_lot("l1", "hoteles", T0, 7)
    book.update_lot("l1", "subido", T0 + timedelta(hours=1), uploaded=T0)
    lot = book.lots().first()
    assert (lot.estado, lot.leads_count, lot.subido_en, lot.vertical) == ("subido", 7, T0, "hoteles")
    book.start_run("r1", "hoteles", T0)
    assert book.runs().first().fin is None
    book.finish_run("r1", T0 + timedelta(minutes=5), 3, 2, 1, 1, 0)
    assert book.runs().first().discovered == 3


def test_lots_and_consolidation(spark, tmp_path):
    book = ledger.Ledger(spark, str(tmp_path / "ledger"))
    root = str(tmp_path / "lots")
    lot = lots.save_lot(book, frame(spark, lead(nombre="A"), lead(nombre="B")), root, "hoteles")
    gone = lots.save_lot(book, frame(spark, lead(nombre="C")), root, "hoteles")
    book.update_lot(gone, "descartado", datetime(2100, 1, 1))
    out = lots.consolidated(spark, root, book.lots(), "hoteles")
    assert sorted(r.nombre for r in out.collect()) == ["A", "B"] and out.columns == CSV_COLUMNS
    assert book.lots().filter(F.col("lote_id") == lot).first().leads_count == 2
    assert ledger.lot_summary(book.lots()).first().total == 1


def test_tolerant_and_strict_log(spark, tmp_path):
    path = tmp_path / "log.jsonl"
    path.write_text('{"barrio_id": "1", "barrio_nombre": "ñ"}\n\n{roto\n{"barrio_id": "2"}\n', encoding="utf-8")
    log = jsonl.read_log(spark, str(path)).cache()
    assert sorted(r.barrio_id for r in jsonl.good_rows(log).collect()) == ["1", "2"]
    assert jsonl.corrupt_rows(log).count() == 1
    with pytest.raises(Exception):
        jsonl.read_log_strict(spark, str(path)).collect()


def test_lot_of_a_repeated_or_broken_run(spark, tmp_path):
    book = ledger.Ledger(spark, str(tmp_path / "ledger"))
    root = str(tmp_path / "lots")
    rows = frame(spark, lead(nombre="A"), lead(nombre="B"))
    lots.stage_lot(rows, root, "hoteles", "l1")  # broken before its commit
    assert lots.committed_lots(spark, root).count() == 0
    assert lots.consolidated(spark, root, book.lots(), "hoteles").count() == 0
    for _ in range(2):
        assert lots.save_lot(book, rows, root, "hoteles", "l1") == "l1"
    assert lots.read_lots(spark, root, book.lots()).count() == 2
    # A second writer commits later: the first commit stays.
    first = lots.committed_lots(spark, root).first()
    late = lots.stage_lot(frame(spark, lead(nombre="C")), root, "hoteles", "l1")
    assert lots.commit_lot(spark, root, "hoteles", "l1", late, 1).intento == first.intento
    assert sorted(r.nombre for r in lots.read_lots(spark, root, book.lots()).collect()) == ["A", "B"]
    book.update_lot("l1", "subido", datetime(2100, 1, 1))
    lots.save_lot(book, rows, root, "hoteles", "l1")  # an upload is not undone by a repeated run
    lot = book.lots().first()
    assert (lot.estado, lot.leads_count, book.lots().count()) == ("subido", 2, 1)
    with pytest.raises(ValueError):
        lots.save_lot(book, rows, root, "clinicas", "l1")
    empty = lots.save_lot(book, rows.limit(0), root, "clinicas")
    assert book.lots().filter(F.col("lote_id") == empty).first().leads_count == 0
    assert lots.consolidated(spark, root, book.lots(), "clinicas").count() == 0


def test_ledger_files_are_bounded(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ledger, "COMPACT_AFTER", 4)
    book = ledger.Ledger(spark, str(tmp_path))
    for i in range(11):
        book.create_lot(f"l{i % 3}", "hoteles", T0 + timedelta(hours=i), i)
        assert len(list((tmp_path / "lots").glob("*.parquet"))) <= 5
    want = {("l0", 9), ("l1", 10), ("l2", 8)}
    assert {(r.lote_id, r.leads_count) for r in book.lots().collect()} == want
    # A merge broken before it deletes: every event is there twice.
    book.events("lots").write.mode("append").parquet(str(tmp_path / "copy"))
    book.append_frame("lots", spark.read.parquet(str(tmp_path / "copy")))
    assert {(r.lote_id, r.leads_count) for r in book.lots().collect()} == want
    book.compact("lots")
    assert book.events("lots").count() == 11 and len(list((tmp_path / "lots").glob("*.parquet"))) == 1


def test_lots_of_several_verticals(spark, tmp_path):
    book, root = ledger.Ledger(spark, str(tmp_path / "ledger")), str(tmp_path / "lots")
    rows = frame(spark, lead(nombre="A"), lead(nombre="B"), lead(nombre="C", vertical="clinicas"))
    saved = lots.save_lots(book, rows, root)
    assert set(saved) == {"hoteles", "clinicas"} and len(set(saved.values())) == 2
    assert {(r.vertical, r.lote_id, r.estado, r.leads_count) for r in book.lots().collect()} == {
        ("hoteles", saved["hoteles"], "pendiente", 2), ("clinicas", saved["clinicas"], "pendiente", 1)}
    book.update_lot(saved["hoteles"], "subido", datetime(2100, 1, 1))
    assert [r.nombre for r in lots.read_lots(spark, root, lots.open_lots(book.lots())).collect()] == ["C"]
    assert lots.save_lots(book, rows.filter("nombre = 'no'"), root) == {}
    with pytest.raises(Exception, match="no such vertical"):
        lots.save_lots(book, rows.withColumn("vertical", F.lit("otra")), root)
    assert lots.committed_lots(spark, root).count() == 2
