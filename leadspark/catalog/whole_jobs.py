"""Whole jobs from their sources to what they leave behind: files, lots, ledger rows, reports."""

from __future__ import annotations

import json
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import replies
from ..functions.extract import ALL_FAILED_ERROR, NO_PAGE_ERROR
from ..operators import dedup, discover, enrich
from ..operators.grouping import shuffled
from ..plans import jobs
from ..schemas import METADATA_FIELDS, VERTICALS, Field
from ..sources import jsonl, lead_csv, ledger, lots
from . import views as V
from .functions import portal_pages
from .jobs import Q1_BODY, extraction_inputs, run_inputs
from .registry import query
from .relational import KNOWN_EMAILS, NEW_EMAILS, NEW_SQL, PROD_SQL, SUMMARY_SQL, VERIF, known_emails, new_batch, production
from .scans import LOG_SQL, UNIFIED, typed_leads, v_log
from .views import v_cust, with_cust

# ---------------------------------------------------------------- Q1

_DISTRICT = "CASE WHEN estado_comercial <> 'CLIENTE' AND localidad IS NOT NULL THEN localidad ELSE partido END"
_GEO = "concat_ws(', ', direccion, {}, 'Buenos Aires', 'Argentina')"


def lead_gazetteer(t, region: str, shift: float) -> DataFrame:
    """Coordinates of the query texts that leads of a region have after the run."""
    rows = v_cust(t).filter((F.col("provincia") == region) & (F.col("ord") > 10)).selectExpr(
        "ord", "direccion", f"{_DISTRICT} AS partido", "CAST(NULL AS STRING) AS localidad", "CAST(NULL AS STRING) AS provincia")
    return enrich.with_geo_query(rows).select(
        F.col("geo_query").alias("query"), (F.col("ord") + F.lit(shift)).alias("lat"), (F.col("ord") * 2.0).alias("lon"), F.lit("g").alias("provider"))


def _gazetteer_sql(region: str, shift: float) -> str:
    return (f"SELECT {_GEO.format(_DISTRICT)} AS query, min(ord + {shift}) AS lat, min(ord * 2.0) AS lon FROM v "
            f"WHERE provincia = '{region}' AND ord > 10 GROUP BY 1")


@query("q1_whole_run", with_cust(Q1_BODY.replace("l AS (SELECT ord,", "l AS (SELECT ord, CASE WHEN ok THEN direccion END AS direccion,")
    + f""", g1 AS ({_gazetteer_sql('AFRICA', 0.0)}), g2 AS ({_gazetteer_sql('AMERICA', 1000.0)}),
  q AS (SELECT *, {_GEO.format("nullif(partido, '')")} AS query FROM l)
  SELECT nombre, q.email, telefono, partido, CASE WHEN r.status IS NOT NULL AND r.error IS NULL THEN r.status IN ('valid', 'accept_all') ELSE false END AS email_validado,
    coalesce(g1.lat, g2.lat)::DOUBLE AS latitud, coalesce(g1.lon, g2.lon)::DOUBLE AS longitud, 'pendiente' AS estado, (SELECT count(*) FROM l) AS leads_count,
    (SELECT count(*) FROM l) AS discovered, (SELECT count(*) FROM l WHERE url IS NOT NULL AND NOT con_texto) AS errors
  FROM q LEFT JOIN ({VERIF}) r ON r.email = q.email LEFT JOIN g1 USING (query) LEFT JOIN g2 USING (query)"""))
def q1_whole(t):
    """Listing pages through a shipped source, texts, answers, verifications, two gazetteers, the lot and the run in the ledger."""
    root = t.scratch("q1w")
    book = ledger.Ledger(t.spark, f"{root}/ledger")
    inputs = run_inputs(t)
    inputs["candidates"] = discover.discovery_source("barrios_privados")(portal_pages(t)).withColumn("ord", F.col("page_id"))
    inputs["gazetteer"], inputs["gazetteer_2"] = lead_gazetteer(t, "AFRICA", 0.0), lead_gazetteer(t, "AMERICA", 1000.0)
    jobs.run_enrichment(book, f"{root}/lots", jobs.RunOptions("barrios_privados"), **inputs)
    rows = lots.read_lots(t.spark, f"{root}/lots", lots.open_lots(book.lots()))
    kept = rows.join(book.lots().select("lote_id", "estado", "leads_count"), "lote_id")
    runs = book.runs().select("vertical", "discovered", "errors")
    return kept.join(runs, "vertical").select("nombre", "email", "telefono", "partido", "email_validado", "latitud", "longitud",
                                              "estado", "leads_count", "discovered", "errors")


# ---------------------------------------------------------------- Q2


@query("q2_whole_job", with_cust(f"""SELECT (row_number() OVER (ORDER BY ord) - 1)::STRING AS barrio_id,
  CASE WHEN provincia <> 'AFRICA' THEN coalesce(sitio_web, CASE WHEN provincia <> 'ASIA' THEN 'https://hallado.example.com.ar/' || ord::STRING END, '') END AS url_usada,
  CASE WHEN provincia = 'AFRICA' THEN NULL WHEN sitio_web IS NULL THEN '{NO_PAGE_ERROR}' WHEN estado_comercial <> 'CLIENTE' THEN '{ALL_FAILED_ERROR}' END AS error,
  CASE WHEN provincia <> 'AFRICA' AND sitio_web IS NOT NULL THEN coalesce(email, '') END AS emails,
  CASE WHEN provincia = 'AFRICA' THEN NULL WHEN sitio_web IS NULL THEN '' WHEN estado_comercial = 'CLIENTE' THEN
    array_to_string(list_sort(list_distinct(list_filter([email, 'general@example.org'], lambda x: x IS NOT NULL))), ',') END AS unificados FROM v"""))
def q2_whole(t):
    """Source CSV by row position, log file of an earlier run, answers, records appended to the log, the log read back."""
    root = t.scratch("q2w")
    leads = v_cust(t)
    rows = leads.select("ord", "nombre", "partido", "provincia", "estado_comercial", "sitio_web").repartitionByRange(4, "ord").sortWithinPartitions("ord")
    rows.write.option("header", True).option("escape", '"').csv(f"{root}/source")
    source = jsonl.read_source_csv(t.spark, f"{root}/source")
    jsonl.append_log(source.filter("provincia = 'AFRICA'").select(F.col("row_id").alias("barrio_id")), f"{root}/log")
    log = jsonl.good_rows(jsonl.read_log(t.spark, f"{root}/log"))
    results, pages = extraction_inputs(leads)
    results = results.join(source.select(F.col("ord").cast("string").alias("ord"), "row_id"), F.col("id") == F.col("ord")).drop("id", "ord")
    answers = source.filter("estado_comercial = 'CLIENTE'").select(
        F.col("row_id").alias("id"), F.lit("p").alias("provider"),
        F.array().cast("array<struct<nombre_completo:string,cargo:string,email:string,telefono:string>>").alias("contactos"),
        F.array(F.lit("general@example.org")).alias("emails_generales"), F.lit(None).cast("string").alias("telefono_general"), F.lit(True).alias("tiene_datos_contacto"))
    records = jobs.extraction_job(source.select("row_id", "nombre", "partido", "sitio_web"), log, results, pages,
                                  discover.subpage_priority(t.spark, discover.CONTACT_PAGES_V1), answers)
    jsonl.append_log(records, f"{root}/log")
    return jsonl.good_rows(jsonl.read_log(t.spark, f"{root}/log")).select(
        "barrio_id", "url_usada", "error", F.array_join("emails_regex", ",").alias("emails"), F.array_join("todos_los_emails_unificados", ",").alias("unificados"))


# ---------------------------------------------------------------- Q3


@query("q3_whole_view", f"""SELECT s.*, r.run_id FROM ({SUMMARY_SQL}) s LEFT JOIN (
  SELECT {V.VERTICAL_OF_NATION} AS vertical, max_by(o_orderkey::STRING, (o_orderdate, o_orderkey::STRING)) AS run_id
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1) r USING (vertical) WHERE vertical <> 'embajadas'""")
def q3_whole(t):
    """One lot a vertical, one of them uploaded; the consolidated rows and the run table give the view."""
    root = t.scratch("q3w")
    book = ledger.Ledger(t.spark, f"{root}/ledger")
    saved = lots.save_lots(book, typed_leads(t), f"{root}/lots")
    book.update_lot(saved["embajadas"], "subido", datetime(2100, 1, 1))
    orders = t.orders.join(shuffled(t.customer), F.col("o_custkey") == F.col("c_custkey")).join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    none = F.lit(None).cast("long")
    book.append_frame("runs", orders.select(
        F.col("o_orderkey").cast("string").alias("run_id"), F.expr(V.VERTICAL_OF_NATION).alias("vertical"), F.lit("inicio").alias("tipo"),
        F.col("o_orderdate").cast("timestamp").alias("ts"), *[none.alias(c) for c in ("discovered", "scraped", "enriched", "validated", "errors")]))
    rows = lead_csv.export_row(lots.read_lots(t.spark, f"{root}/lots", lots.open_lots(book.lots())))
    rows = rows.withColumn("ord", F.regexp_extract("nombre", r"(\d+)$", 1).cast("long"))
    summary, runs = jobs.quality_view(rows, book.runs())
    return summary.join(runs.select("vertical", "run_id"), "vertical", "left").select(
        "vertical", "total", "exact_duplicates", "fuzzy_duplicates", "upload_ready", "run_id")


# ---------------------------------------------------------------- Q4 / Q5


@query("j4_any_match", f"""WITH n AS (SELECT *, {V.sort_tokens('nombre')} AS s, {V.norm('partido')} AS d FROM ({NEW_SQL})
    WHERE {V.dedup_key()} NOT IN (SELECT {V.dedup_key()} FROM ({PROD_SQL}))),
  p AS (SELECT *, {V.sort_tokens('nombre')} AS s, {V.norm('partido')} AS d FROM ({PROD_SQL})),
  sc AS (SELECT a.s, b.s AS t, {V.ratio('a.s', 'b.s')} AS score FROM (SELECT DISTINCT s FROM n) a, (SELECT DISTINCT s FROM p) b)
  SELECT n.ord AS ord_a, p.ord AS ord_b, round(score, 6) AS score FROM n JOIN sc ON sc.s = n.s AND score >= 85 JOIN p ON p.s = t AND (n.d = p.d OR n.d = '' OR p.d = '')
  QUALIFY row_number() OVER (PARTITION BY n.ord ORDER BY score DESC, p.ord) = 1""")
def j4_any(t):
    _, matches = dedup.dedup_vs_production(new_batch(t), production(t), any_match=True)
    return matches.select("ord_a", "ord_b", F.round("score", 6).alias("score"))


SUPPLIERS = "SELECT s_suppkey AS ord, s_name || ' ' || n_name AS nombre, n_name AS partido FROM supplier JOIN nation ON s_nationkey = n_nationkey"


@query("q5_whole_review", f"""WITH k AS (SELECT *, {V.sort_tokens('nombre')} AS s, {V.norm('partido')} AS d FROM ({SUPPLIERS})),
  c AS (SELECT a.ord AS ord_a, b.ord AS ord_b, a.nombre AS lead_a, b.nombre AS lead_b, {V.ratio('a.s', 'b.s')} AS r, a.partido || ' / ' || b.partido AS partidos,
    CASE WHEN a.d = b.d THEN 'nombre+partido' ELSE 'nombre' END AS match_type FROM k a JOIN k b ON a.ord < b.ord)
  SELECT ord_a, ord_b, lead_a, lead_b, round(r)::INT AS score, partidos, match_type FROM c WHERE r >= 85 ORDER BY r DESC, ord_a, ord_b LIMIT 20""")
def q5_whole(t):
    """The newest export of the suppliers, whose names differ: every pair ranks below 100."""
    root = t.scratch("q5w")
    named = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.concat_ws(" ", "s_name", "n_name").alias("nombre"), F.col("n_name").alias("partido"))
    blank = [F.lit("").alias(c) for c in lead_csv.CSV_COLUMNS if c not in ("nombre", "partido")]
    rows = named.select("nombre", "partido", *blank).select(*lead_csv.CSV_COLUMNS)
    for folder, part in (("antes", rows.filter("partido < 'K'")), ("ahora", rows)):
        part.write.option("header", True).option("escape", '"').csv(f"{root}/{folder}/consolidated.csv")
    export = lead_csv.read_latest_export(t.spark, root)
    return jobs.duplicate_review(export.withColumn("ord", F.regexp_extract("nombre", r"#(\d+)", 1).cast("long")))


# ---------------------------------------------------------------- Q6

_TS = "CASE WHEN {0} % 5 > 0 THEN '2025-06-15T' || lpad(CAST({0} % 24 AS STRING), 2, '0') || ':' || lpad(CAST({0} % 60 AS STRING), 2, '0') || ':00' END"


@query("q6_whole_report", f"""WITH l AS (SELECT *, {_TS.format('ord')} AS ts FROM ({LOG_SQL})),
  n AS (SELECT * FROM ({NEW_EMAILS}) WHERE lower(email) NOT IN (SELECT email FROM ({KNOWN_EMAILS})))
  SELECT 'total' AS seccion, '' AS clave, count(*)::STRING AS a, count(*) FILTER (WHERE llm)::STRING AS b FROM l
  UNION ALL SELECT 'lapso', '', arg_min(ts, ord), arg_max(ts, ord) FROM l WHERE ts IS NOT NULL
  UNION ALL SELECT 'nuevos', confirmado::STRING, count(*)::STRING, count(DISTINCT email)::STRING FROM n GROUP BY confirmado
  UNION ALL SELECT 'nuevo', barrio_nombre, email, confirmado::STRING FROM n
  UNION ALL SELECT 'detalle', l.ord::STRING, url_usada, CASE WHEN coalesce(llm, false) THEN '' ELSE array_to_string(er, ', ') END
    FROM l WHERE coalesce(llm, false) OR ({UNIFIED})""")
def q6_whole(t):
    """Every part of the report over the log file, one section under the other."""
    root = t.scratch("q6w")
    jsonl.append_log(v_log(t).withColumn("timestamp", F.expr(_TS.format("ord"))), root)
    schema = v_log(t).withColumn("timestamp", F.lit("")).schema
    out = jobs.extraction_report(jsonl.good_rows(jsonl.read_log(t.spark, root, schema)), known_emails(t))

    def section(name: str, df: DataFrame, key, a, b) -> DataFrame:
        text = [c if not isinstance(c, str) else F.col(c) for c in (key, a, b)]
        return df.select(F.lit(name).alias("seccion"), *[c.cast("string").alias(n) for c, n in zip(text, ("clave", "a", "b"))])

    none = F.lit("")
    return (section("total", out["totals"], none, "total", "llm_ok")
            .unionByName(section("lapso", out["span"], none, "primero", "ultimo"))
            .unionByName(section("nuevos", out["new_email_counts"], "confirmado", "n", "distintos"))
            .unionByName(section("nuevo", out["new_emails"], "barrio_nombre", "email", "confirmado"))
            .unionByName(section("detalle", out["details"], "ord", "url", "regex_only")))


# ---------------------------------------------------------------- X29


def _right(field: Field):
    return {"str": "texto", "enum": field.options[-1] if field.options else "", "int": field.high or 3, "float": 2.5, "bool": True,
            "list": ["a", "b"]}[field.kind]


def _wrong(field: Field):
    """A value of a type the field does not take; an option that is none."""
    return {"str": 7, "enum": "otra", "int": 3.5, "float": "2.5", "bool": "true", "list": [1]}[field.kind]


def metadata_cases(vertical: str) -> list[tuple[str, str]]:
    """(reply, metadata) of a vertical: each field wrong in turn, all right nested and at the top, none, one NULL."""
    fields = METADATA_FIELDS[vertical]
    good = {f.name: _right(f) for f in fields}

    def dump(value) -> str:
        return json.dumps(value, separators=(",", ":"), ensure_ascii=False)

    def absent(f: Field):
        return [] if f.kind == "list" else f.default

    nothing = {f.name: absent(f) for f in fields if absent(f) is not None}
    last = {f.name: good[f.name] if f is not fields[-1] else absent(f) for f in fields}
    cases = [({"metadata": {**good, f.name: _wrong(f)}}, {}) for f in fields]
    cases += [({"metadata": good}, good), (good, good), ({"nombre": "x"}, nothing),
              ({"metadata": {**good, fields[-1].name: None}}, {k: v for k, v in last.items() if v is not None})]
    return [(dump(reply), dump(meta)) for reply, meta in cases]


def _by_document(which: int) -> str:
    """The case of a document: its vertical by the remainder of 15, the case by what is left of the id."""
    out = "CASE doc_id % 15"
    for i, vertical in enumerate(VERTICALS):
        cases = metadata_cases(vertical)
        out += f" WHEN {i} THEN CASE CAST(floor(doc_id / 15) AS BIGINT) % {len(cases)}"
        out += "".join(f" WHEN {k} THEN '{case[which]}'" for k, case in enumerate(cases)) + " END"
    return out + " END"


@query("x29_all_verticals", f"SELECT doc_id, {_by_document(1)} AS metadata FROM documents")
def x29_all(t):
    """Strict metadata of all 15 verticals, every field of every kind right, wrong, absent and NULL."""
    vertical = F.expr("CASE doc_id % 15 " + " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(VERTICALS)) + " END")
    rows = t.documents.select("doc_id", vertical.alias("vertical"), replies.parse_reply(F.expr(_by_document(0))).alias("v"))
    return rows.select("doc_id", replies.metadata_json_for("v", "vertical").alias("metadata"))
