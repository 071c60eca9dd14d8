"""Scans, sinks, projections and filters (S, P, F)."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from ..functions import extract as X
from ..functions import html as H
from ..functions import scoring as Q
from ..functions import text as X1
from ..operators import crawlplan, discover, enrich, prompts, report
from ..schemas import DISPLAY_NAMES
from ..sources import jsonl, lead_csv, ledger, lots, places
from . import views as V
from .registry import query
from .views import v_cust, with_cust

# ---------------------------------------------------------------- S

EXPORT_SQL = """SELECT nombre, vertical, estado_comercial, coalesce(email, '') AS email, coalesce(email_2, '') AS email_2,
  coalesce(email_3, '') AS email_3, CASE WHEN email_validado THEN 'true' ELSE 'false' END AS email_validado,
  coalesce(CAST(email_score AS STRING), '') AS email_score, coalesce(telefono, '') AS telefono,
  coalesce(sitio_web, '') AS sitio_web, fuente_contacto, '2025-06-15T12:30:00Z' AS fecha_enriquecimiento,
  coalesce(direccion, '') AS direccion, coalesce(localidad, '') AS localidad, coalesce(partido, '') AS partido,
  provincia, CASE WHEN pais = '' THEN 'Argentina' ELSE pais END AS pais, coalesce(cp, '') AS cp,
  CASE WHEN latitud IS NULL THEN '' ELSE printf('%.6f', latitud) END AS latitud,
  CASE WHEN longitud IS NULL THEN '' ELSE printf('%.6f', longitud) END AS longitud,
  CASE WHEN metadata = '{}' THEN '' ELSE metadata END AS metadata FROM v"""


def typed_leads(t):
    return v_cust(t).withColumn("fecha_enriquecimiento", F.lit(datetime(2025, 6, 15, 12, 30)).cast("timestamp"))


@query("s1_read_csv", with_cust(EXPORT_SQL))
def s1(t):
    path = t.scratch("s1")
    lead_csv.write_leads_csv(typed_leads(t), path)
    return lead_csv.read_leads_csv(t.spark, path)


@query("s2_write_csv", with_cust("SELECT vertical, count(*) AS n, sum(CASE WHEN email <> '' THEN 1 ELSE 0 END)::BIGINT AS con_email FROM v GROUP BY vertical"))
def s2(t):
    path = t.scratch("s2")
    lead_csv.write_leads_csv(typed_leads(t), path)
    lead_csv.write_leads_csv(typed_leads(t), path)  # the second write replaces the first
    return lead_csv.read_leads_csv(t.spark, path).groupBy("vertical").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("email") != "").alias("con_email"))


@query("s3_append_csv", with_cust("SELECT provincia, 2 * count(*) AS n FROM v GROUP BY provincia"))
def s3(t):
    path = t.scratch("s3")
    lead_csv.append_leads_csv(typed_leads(t), path)
    lead_csv.append_leads_csv(typed_leads(t), path)
    return lead_csv.read_leads_csv(t.spark, path).groupBy("provincia").agg(F.count(F.lit(1)).alias("n"))


def log_lines(t, turns="true"):
    """Conversation turns as log lines: user turns are records, the others are broken lines."""
    ident = F.concat_ws("-", "conv_id", "turn")
    record = F.to_json(F.struct(ident.alias("barrio_id"), F.col("role").alias("barrio_nombre")))
    broken = F.concat(F.lit("{"), F.regexp_replace("text", r"\s", " "))
    return t.conversations.filter(turns).select(F.when(F.col("role") == "user", record).otherwise(broken).alias("value"))


@query("s4_read_jsonl", """SELECT role = 'user' AS legible, count(*) AS n, count(DISTINCT CASE WHEN role = 'user' THEN conv_id::STRING || '-' || turn::STRING END) AS ids
  FROM conversations GROUP BY 1""")
def s4(t):
    path = t.scratch("s4")
    log_lines(t).write.text(path)
    log = jsonl.read_log(t.spark, path).select("barrio_id", jsonl.CORRUPT)
    return log.groupBy(F.col(jsonl.CORRUPT).isNull().alias("legible")).agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("barrio_id").alias("ids"))


@query("s5_read_jsonl_strict", "SELECT conv_id::STRING || '-' || turn::STRING AS barrio_id, role AS barrio_nombre FROM conversations WHERE role = 'user'")
def s5(t):
    path = t.scratch("s5")
    log_lines(t, "role = 'user'").write.text(path)
    return jsonl.read_log_strict(t.spark, path).select("barrio_id", "barrio_nombre")


def doc_pages(t):
    return t.documents.select(F.col("doc_id").alias("id"), F.col("source").alias("nombre"), F.lit("").alias("url"), "text")


@query("s6_append_jsonl", f"""SELECT source AS barrio_nombre, 2 * count(*) AS n, 2 * sum(len({V.hits('text', V.EMAIL_RE)}))::BIGINT AS emails
  FROM documents GROUP BY source""")
def s6(t):
    path = t.scratch("s6")
    records = enrich.extraction_records(doc_pages(t))
    jsonl.append_log(records, path)
    jsonl.append_log(records, path)
    log = jsonl.good_rows(jsonl.read_log(t.spark, path))
    return log.groupBy("barrio_nombre").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.size("emails_regex")).cast("long").alias("emails"))


@query("s7_source_csv", "SELECT c_custkey::STRING AS row_id, c_name, c_acctbal FROM customer")
def s7(t):
    path = t.scratch("s7")
    t.customer.select("c_custkey", "c_name", "c_acctbal").write.option("header", True).csv(path)
    return jsonl.read_source_csv(t.spark, path, "c_custkey").select("row_id", "c_name", F.col("c_acctbal").cast("double").alias("c_acctbal"))


@query("s7_row_position", """SELECT (row_number() OVER (ORDER BY c_custkey) - 1)::STRING AS row_id, c_custkey, c_acctbal,
  c_name || CASE WHEN c_custkey % 3 = 0 THEN chr(10) || ' "' || c_mktsegment || '", fin' ELSE '' END AS nota FROM customer""")
def s7_position(t):
    """Several files in order, every third row over two lines; rows without a key are known by their position."""
    path = t.scratch("s7p")
    note = F.concat("c_name", F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit('\n "'), "c_mktsegment", F.lit('", fin'))).otherwise(""))
    rows = t.customer.select("c_custkey", "c_acctbal", note.alias("nota")).repartitionByRange(4, "c_custkey").sortWithinPartitions("c_custkey")
    rows.write.option("header", True).option("escape", '"').csv(path)
    return jsonl.read_source_csv(t.spark, path).select("row_id", "c_custkey", "c_acctbal", "nota")


@query("s8_latest_export", with_cust("SELECT nombre, vertical FROM v"))
def s8(t):
    root = t.scratch("s8")
    lead_csv.write_leads_csv(typed_leads(t).filter("provincia IN ('AFRICA', 'AMERICA')"), f"{root}/a/consolidated.csv")
    lead_csv.write_leads_csv(typed_leads(t), f"{root}/b/consolidated.csv")
    lead_csv.write_leads_csv(typed_leads(t).filter("provincia = 'EUROPE'"), f"{root}/c/lote.csv")
    return lead_csv.read_latest_export(t.spark, root).select("nombre", "vertical")


@query("s9_resume_chunks", """SELECT doc_id, ((row_number() OVER (ORDER BY doc_id) - 1) // 100)::BIGINT AS chunk_id FROM documents
  WHERE doc_id NOT IN (SELECT doc_id FROM labels)""")
def s9(t):
    pending = enrich.resume(t.documents.select("doc_id"), t.labels, "doc_id")
    return report.with_chunks(pending, "doc_id", 100).select("doc_id", "chunk_id")


H1 = r"regexp_extract(card, '(?is)<h1\b[^>]*>(.*?)</h1\s*>', 1)"
CARD_SQL = rf"SELECT page_id, unnest(regexp_extract_all(html, '(?is)<article\b[^>]*>.*?</article\s*>')) AS card FROM pages"


@query("s10_listing_source", f"""SELECT page_id, nombre FROM (SELECT page_id, {V.node_text(H1, '')} AS nombre FROM ({CARD_SQL})) WHERE length(nombre) > 2""")
def s10(t):
    own = {"portada": lambda p: discover.parse_cards(p, "zonaprop", title_tags=("h2", "h3", "h1"))}
    return discover.discovery_source("portada", own)(t.pages.select("page_id", "html")).select("page_id", "nombre")


def place_answers(t):
    place = F.struct(
        F.col("nombre").alias("name"), F.concat_ws(", ", "direccion", "localidad", "provincia", F.lit("Argentina")).alias("formatted_address"),
        F.col("sitio_web").alias("website"), F.concat(F.lit("pl"), "ord").alias("place_id"), (F.col("email_score") / 25).alias("rating"))
    status = F.when(F.col("estado_comercial") == "CLIENTE", "ZERO_RESULTS").otherwise("OK")
    return v_cust(t).select("ord", F.to_json(F.struct(status.alias("status"), F.array(place).alias("results"))).alias("body"))


@query("s11_places", with_cust("""SELECT ord, nombre, sitio_web,
  CASE WHEN (CASE WHEN direccion IS NULL THEN 0 ELSE 1 END + CASE WHEN localidad IS NULL THEN 0 ELSE 1 END) >= 1 THEN provincia END AS provincia,
  'pl' || ord::STRING AS place_id FROM v WHERE estado_comercial <> 'CLIENTE'"""))
def s11(t):
    return places.places_candidates(place_answers(t)).select(
        "ord", "nombre", "sitio_web", "provincia", F.col("raw_data")["place_id"].alias("place_id"))


@query("s12_save_lot", with_cust("SELECT 'hoteles' AS vertical, 'pendiente' AS estado, count(*) AS leads_count, count(DISTINCT nombre) AS filas FROM v WHERE vertical = 'hoteles'"))
def s12(t):
    root = t.scratch("s12")
    book = ledger.Ledger(t.spark, f"{root}/ledger")
    lots.save_lot(book, typed_leads(t).filter("vertical = 'hoteles'").drop("ord"), f"{root}/lots", "hoteles")
    rows = lots.read_lots(t.spark, f"{root}/lots", book.lots()).groupBy("vertical").agg(F.countDistinct("nombre").alias("filas"))
    return book.lots().join(rows, "vertical").select("vertical", "estado", "leads_count", "filas")


# ---------------------------------------------------------------- P


@query("p1_export_row", with_cust(EXPORT_SQL))
def p1(t):
    return lead_csv.export_row(typed_leads(t))


@query("p2_minimal_lead", with_cust("""SELECT ord, nombre, vertical, nullif(email, '') AS email, nullif(telefono, '') AS telefono, sitio_web, partido, localidad,
  round(latitud, 6) AS latitud, round(longitud, 6) AS longitud, email_validado FROM v"""))
def p2(t):
    rows = lead_csv.export_row(typed_leads(t)).withColumn("ord", F.regexp_extract("nombre", r"(\d+)$", 1).cast("long"))
    return lead_csv.minimal_lead(rows)


@query("p3_preview", with_cust("""SELECT ord, nombre, CASE WHEN coalesce(email, '') <> '' THEN email ELSE '—' END AS email,
  CASE WHEN coalesce(telefono, '') <> '' THEN telefono ELSE '—' END AS telefono, coalesce(partido, '—') AS partido,
  CASE WHEN email_validado THEN '✓' ELSE '·' END AS v_email FROM v ORDER BY ord LIMIT 10"""))
def p3(t):
    return lead_csv.preview(v_cust(t))


@query("p4_production_lead", with_cust("""SELECT ord, nombre, CASE WHEN provincia = 'ASIA' THEN 'barrios_privados' ELSE vertical END AS vertical, partido FROM v"""))
def p4(t):
    odd = F.when(F.col("provincia") == "ASIA", F.concat(F.lit("otra_"), "vertical")).otherwise(F.col("vertical"))
    rows = v_cust(t).select("ord", F.concat(F.lit("  "), "nombre", F.lit(" ")).alias("nombre"), odd.alias("vertical"), "partido")
    return lead_csv.production_lead(rows)


def cust_candidates(t):
    return v_cust(t).select("ord", "nombre", "sitio_web", "partido", "provincia", "localidad", F.col("fuente_contacto").alias("fuente"),
                            "email", "telefono", "estado_comercial", "vertical")


@query("p5_minimal_from_candidate", with_cust("""SELECT ord, nombre, 'hoteles' AS vertical, 'SIN_CONTACTAR' AS estado_comercial, sitio_web,
  'customer' AS fuente_contacto, partido, 'Argentina' AS pais, false AS email_validado, CAST(NULL AS STRING) AS email FROM v"""))
def p5(t):
    lead = enrich.minimal_lead(F.lit("hoteles"), F.current_timestamp())
    return cust_candidates(t).select("ord", lead.alias("l")).select(
        "ord", "l.nombre", "l.vertical", "l.estado_comercial", "l.sitio_web", "l.fuente_contacto", "l.partido", "l.pais", "l.email_validado", "l.email")


@query("p6_fill_missing", with_cust("""SELECT ord, CASE WHEN coalesce(localidad, '') <> '' THEN localidad ELSE partido END AS partido,
  CASE WHEN coalesce(telefono, '') <> '' THEN telefono ELSE sitio_web END AS sitio_web FROM v"""))
def p6(t):
    extracted = F.struct(F.col("localidad").alias("partido"), F.col("telefono").alias("sitio_web"))
    merged = enrich.fill_missing(extracted, partido=F.col("partido"), sitio_web=F.col("sitio_web"))
    return v_cust(t).select("ord", merged.alias("l")).select("ord", "l.partido", "l.sitio_web")


@query("p7_record_merge", f"""SELECT doc_id::STRING AS barrio_id, source AS barrio_nombre,
  CASE WHEN lang = 'de' THEN 'Sin web / Texto vacío' WHEN trim(text) = '' THEN 'Texto vacío' END AS error,
  CASE WHEN lang = 'de' THEN NULL ELSE array_to_string({V.hits('text', V.EMAIL_RE)}, ',') END AS emails_regex FROM documents""")
def p7(t):
    records = enrich.extraction_records(doc_pages(t).withColumn("nombre", F.concat_ws("|", "nombre", F.lit(""))))
    lang = t.documents.select(F.col("doc_id").cast("string").alias("barrio_id"), "lang")
    merged = enrich.mark_missing_pages(records.join(lang, "barrio_id"), F.col("lang") != "de")
    return merged.select("barrio_id", F.regexp_replace("barrio_nombre", r"\|$", "").alias("barrio_nombre"), "error",
                         F.array_join("emails_regex", ",").alias("emails_regex"))


@query("p8_cut_text", "SELECT doc_id, md5(substr(text, 1, 6000)) AS h6, md5(substr(text, 1, 8000)) AS h8, length(substr(text, 1, 12000)) AS n12 FROM documents")
def p8(t):
    return t.documents.select("doc_id", F.md5(X.cut_text("text", X.EXTRACTION_BUDGET)).alias("h6"),
                              F.md5(X.cut_text("text", X.REQUEST_BUDGET)).alias("h8"),
                              F.length(X.cut_text("text", X.PAGE_BUDGET)).cast("long").alias("n12"))


NAME_CASE = "CASE vertical " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in DISPLAY_NAMES.items()) + " ELSE vertical END"


@query("p9_display_name", with_cust(f"SELECT ord, {NAME_CASE} AS display_name FROM (SELECT ord, CASE WHEN provincia = 'ASIA' THEN 'otra' ELSE vertical END AS vertical FROM v)"))
def p9(t):
    odd = F.when(F.col("provincia") == "ASIA", "otra").otherwise(F.col("vertical"))
    return v_cust(t).select("ord", ledger.display_name(odd).alias("display_name"))


@query("p10_rank", "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS n FROM orders")
def p10(t):
    return report.ranked(t.orders.select("o_orderkey"), "o_orderkey", "n").select("o_orderkey", "n")


@query("p11_short_ids", "SELECT substr(md5(o_orderkey::STRING), 1, 8) AS id, strftime(o_orderdate, '%Y-%m-%d %H:%M') AS fecha, o_totalprice FROM orders")
def p11(t):
    rows = t.orders.select(F.md5(F.col("o_orderkey").cast("string")).alias("id"), F.col("o_orderdate").cast("timestamp").alias("fecha"), "o_totalprice")
    return ledger.short_ids(rows, "id", "fecha")


@query("p12_batch_requests", f"""SELECT doc_id, md5('{prompts.REQUEST_BEFORE}' || text || '{prompts.REQUEST_AFTER}') AS usuario, false AS truncated,
  CASE lang WHEN 'es' THEN 'Hoteles' WHEN 'en' THEN 'Clínicas Privadas' ELSE 'Empresas' END AS titulo FROM documents""")
def p12(t):
    vertical = F.when(F.col("lang") == "es", "hoteles").when(F.col("lang") == "en", "clinicas").otherwise("empresas")
    pages = t.documents.select("doc_id", vertical.alias("vertical"), "text")
    out = prompts.batch_requests(pages, prompts.prompt_table(t.spark))
    return out.select("doc_id", F.md5("user").alias("usuario"), "truncated", F.regexp_extract("system", r"^# Prompt de extracción — (.*)\n", 1).alias("titulo"))


# ---------------------------------------------------------------- F


@query("f1_has_website", with_cust("SELECT ord, sitio_web FROM v WHERE coalesce(sitio_web, '') <> ''"))
def f1(t):
    return discover.has_website(v_cust(t)).select("ord", "sitio_web")


@query("f2_not_social", "SELECT page_id, url FROM pages WHERE NOT contains(lower(url), 'blog.th')")
def f2(t):
    return discover.not_social(t.pages, "url", "blog.th").select("page_id", "url")


BANNED = [*discover.SEARCH_BANNED, "spam-farm", "cheap-pills"]


@query("f3_url_allowed", f"SELECT page_id, url FROM pages WHERE NOT {V.any_contains(V.netloc('url'), BANNED)}")
def f3(t):
    return t.pages.filter(discover.url_allowed("url", BANNED)).select("page_id", "url")


EXACT_BANNED = [*discover.SECTOR_BANNED, "spam-farm.example.org", "cheap-pills.example.com"]


@query("f4_drop_banned_domains", f"SELECT page_id, url FROM pages WHERE {V.domain('url')} NOT IN {V.in_list(EXACT_BANNED)}")
def f4(t):
    table = discover.ban_table(t.spark, discover.SECTOR_BANNED, EXACT_BANNED)
    return discover.drop_banned_domains(t.pages.select("page_id", "url"), table, "url")


@query("f5_name_length", "SELECT p_partkey, p_name, length(p_name) > 9 AS largo, length(p_name) > 5 AND contains(lower(p_name), 'gear') AS con_palabra FROM part")
def f5(t):
    return t.part.select("p_partkey", "p_name", discover.name_ok("p_name", 9).alias("largo"), discover.name_ok("p_name", 5, "gear").alias("con_palabra"))


@query("f6_not_header", "SELECT p_partkey, p_name FROM part WHERE lower(p_name) NOT IN ('red gear', 'hot rod')")
def f6(t):
    return t.part.filter(discover.not_header("p_name", ["red gear", "hot rod"])).select("p_partkey", "p_name")


@query("f7_has_content", "SELECT doc_id FROM documents WHERE length(text) >= 300")
def f7(t):
    return t.documents.filter(H.has_content("text")).select("doc_id")


PAGE_TEXT = f"SELECT page_id, url, html, {V.html_text('html', H.FETCH_DROP)} AS text FROM pages"
SPA = V.any_contains("html", H.SPA_MARKERS)
PAGE_STATUS = "CASE WHEN contains(url, 'blog.') THEN 403 WHEN contains(url, '/es/') THEN 503 WHEN contains(url, 'm.') THEN 404 ELSE 200 END"


@query("f8_looks_unrendered", f"SELECT page_id, length(text) < 300 OR {SPA} AS vacia FROM ({PAGE_TEXT})")
def f8(t):
    return t.pages.select("page_id", H.looks_unrendered("html", H.html_text("html")).alias("vacia"))


@query("f9_needs_render", f"SELECT page_id, {PAGE_STATUS} IN (403, 429, 503) OR html = '' OR length(text) < 300 OR {SPA} AS render FROM ({PAGE_TEXT})")
def f9(t):
    return t.pages.select("page_id", H.needs_render("html", H.html_text("html"), F.expr(PAGE_STATUS)).alias("render"))


@query("f10_http_scheme", "SELECT page_id, starts_with(ref, 'http') AS ok FROM (SELECT page_id, CASE WHEN contains(url, '?') THEN substr(url, 6) ELSE url END AS ref FROM pages)")
def f10(t):
    ref = F.when(F.col("url").contains("?"), F.expr("substr(url, 6)")).otherwise(F.col("url"))
    return t.pages.select("page_id", X1.has_http_scheme(ref).alias("ok"))


@query("f11_page_outcome", f"""SELECT page_id, CASE WHEN contains(url, '#') THEN 'URL inválida' WHEN contains(url, 'spam-farm') THEN 'bloqueado por robots.txt'
  WHEN length(text) < 300 THEN 'página sin contenido suficiente' END AS error FROM ({PAGE_TEXT})""")
def f11(t):
    url = F.when(F.col("url").contains("#"), F.expr("substr(url, 9)")).otherwise(F.col("url"))
    allowed = ~F.col("url").contains("spam-farm")
    return t.pages.select("page_id", crawlplan.fetch_error(url, H.html_text("html"), allowed).alias("error"))


LOTS_SQL = f"""SELECT o_orderkey::STRING AS lote_id, {V.VERTICAL_OF_NATION} AS vertical, o_orderdate AS creado_en,
  coalesce({V.STATE_OF_ORDER}, 'pendiente') AS estado, coalesce(n, 0) AS leads_count
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey"""


def lot_events(t):
    """Lot events of the orders: created, counted when the line items are in, state changed."""
    base = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    ident = F.col("o_orderkey").cast("string").alias("lote_id")
    at = F.col("o_orderdate").cast("timestamp")
    null = F.lit(None)
    created = base.select(ident, F.expr(V.VERTICAL_OF_NATION).alias("vertical"), at.alias("ts"), F.lit("pendiente").alias("estado"),
                          F.lit(0).cast("long").alias("leads_count"), null.cast("timestamp").alias("subido_en"))
    counts = t.lineitem.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))
    counted = t.orders.join(counts, F.col("o_orderkey") == F.col("l_orderkey")).select(
        ident, null.cast("string").alias("vertical"), (at + F.expr("INTERVAL 1 HOUR")).alias("ts"), null.cast("string").alias("estado"),
        F.col("n").alias("leads_count"), null.cast("timestamp").alias("subido_en"))
    moved = t.orders.select(
        ident, null.cast("string").alias("vertical"), (at + F.expr("INTERVAL 2 HOURS")).alias("ts"), F.expr(V.STATE_OF_ORDER).alias("estado"),
        null.cast("long").alias("leads_count"),
        F.when(F.col("o_orderstatus") == "F", at + F.expr("INTERVAL 2 HOURS")).alias("subido_en")).filter("estado is not null")
    return created.unionByName(counted).unionByName(moved)


def v_lots(t):
    return ledger.lot_states(lot_events(t))


@query("f12_filter_lots", f"SELECT lote_id, leads_count FROM ({LOTS_SQL}) WHERE vertical = 'hoteles' AND estado = 'subido'")
def f12(t):
    return ledger.filter_lots(v_lots(t), "hoteles", "subido").select("lote_id", "leads_count")


@query("f13_pending_lots", f"SELECT lote_id, leads_count FROM ({LOTS_SQL}) WHERE vertical = 'clinicas' AND estado = 'pendiente'")
def f13(t):
    return ledger.pending_lots(v_lots(t), "clinicas").select("lote_id", "leads_count")


LOG_SQL = f"""SELECT doc_id AS ord, source AS barrio_nombre, lang,
  CASE WHEN lang = 'de' THEN '' ELSE 'https://' || source || '.example.org/' || lang END AS url_usada,
  CASE WHEN lang = 'de' THEN 'Sin web / Texto vacío' END AS error, lang = 'en' AND quality = 1 AS llm,
  {V.hits('text', V.EMAIL_RE)} AS er, {V.hits('text', V.PHONE_RE)} AS pr
  FROM documents LEFT JOIN labels USING (doc_id)"""


def v_log(t):
    """Extraction log over the documents: quality-labelled English ones were answered."""
    docs = t.documents.join(t.labels, "doc_id", "left")
    url = F.when(F.col("lang") == "de", "").otherwise(F.concat(F.lit("https://"), "source", F.lit(".example.org/"), "lang"))
    answered = F.coalesce((F.col("lang") == "en") & (F.col("quality") == 1), F.lit(False))
    emails = X.emails_in("text")
    return docs.select(
        F.col("doc_id").alias("ord"), F.col("source").alias("barrio_nombre"), url.alias("url_usada"),
        F.when(F.col("lang") == "de", X.NO_PAGE_ERROR).alias("error"), answered.alias("tiene_datos_contacto_llm"),
        emails.alias("emails_regex"), X.phones_in("text").alias("phones_regex"),
        F.when(answered, "openrouter_paid").otherwise("regex_only").alias("modelo_usado"),
        F.when(answered | (F.col("lang") != "fr"), emails).alias("todos_los_emails_unificados"),
        F.when(answered, F.array(F.struct(
            F.when(F.col("toxic") == 1, "NO_ENCONTRADO").otherwise(F.concat(F.lit("Persona "), "doc_id")).alias("nombre_completo"),
            F.lit("Intendente").alias("cargo"), F.lit(None).cast("string").alias("email"), F.lit(None).cast("string").alias("telefono"))))
        .alias("contactos_llm"),
        F.array().cast("array<string>").alias("emails_generales_llm"), F.lit(None).cast("string").alias("telefono_general_llm"),
        F.date_format(F.timestamp_seconds(F.lit(1_700_000_000) + F.col("doc_id")), "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"),
    )


UNIFIED = "(coalesce(llm, false) OR lang <> 'fr') AND len(er) > 0"


@query("f14_log_flags", f"""SELECT ord, error IS NOT NULL AS sin_web, url_usada <> '' AS con_url, coalesce(llm, false) AS llm_ok,
  coalesce(llm, false) AND {UNIFIED} AS email_admin, NOT coalesce(llm, false) AND {UNIFIED} AS solo_regex FROM ({LOG_SQL})""")
def f14(t):
    flags = report.log_flags()
    return v_log(t).select("ord", *[flags[n].alias(n) for n in ("sin_web", "con_url", "llm_ok", "email_admin", "solo_regex")])


@query("f15_enriched", with_cust("SELECT ord FROM v WHERE coalesce(email, '') <> '' OR coalesce(telefono, '') <> '' OR coalesce(latitud, 0) <> 0"))
def f15(t):
    return enrich.mark_enriched(v_cust(t)).filter("enriched").select("ord")


@query("f16_critical", with_cust("SELECT ord, coalesce(email, '') <> '' OR coalesce(telefono, '') <> '' OR coalesce(sitio_web, '') <> '' AS critico FROM v"))
def f16(t):
    return v_cust(t).select("ord", Q.has_critical_contact().alias("critico"))


@query("f17_named_contacts", "SELECT doc_id AS ord, CASE WHEN toxic = 1 THEN 0 ELSE 1 END::BIGINT AS n FROM documents JOIN labels USING (doc_id) WHERE lang = 'en' AND quality = 1")
def f17(t):
    return v_log(t).filter("tiene_datos_contacto_llm").select("ord", F.size(X.named_contacts("contactos_llm")).cast("long").alias("n"))


@query("f18_distributor_flag", "SELECT p_partkey, contains(upper(p_name), 'DROGUER') OR contains(upper(tipo), 'DROGUER') AS es_distribuidor FROM (SELECT *, CASE WHEN p_type = 'PROMO' THEN 'Droguería y ' || 'drogueria' ELSE p_type END AS tipo FROM part)")
def f18(t):
    tipo = F.when(F.col("p_type") == "PROMO", F.lit("Droguería y drogueria")).otherwise(F.col("p_type"))
    return t.part.select("p_partkey", discover.is_distributor(tipo, "p_name").alias("es_distribuidor"))


VERTICAL_EVENTS_SQL = f"""SELECT {V.VERTICAL_OF_NATION} AS vertical, o_orderdate AS ts, o_orderkey,
  CASE WHEN (o_orderstatus = 'F' AND o_totalprice > 400000 OR n_nationkey % 15 IN (4, 9) AND o_orderdate >= TIMESTAMP '2000-01-01') AND n_nationkey % 15 <> 0 THEN 'desactivar' ELSE 'activar' END AS accion
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey"""


def vertical_events(t):
    """Activations told by orders; large finished orders deactivate, and all late ones of two verticals (never the base vertical)."""
    base = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(
        t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    off = "(o_orderstatus = 'F' AND o_totalprice > 400000 OR n_nationkey % 15 IN (4, 9) AND o_orderdate >= TIMESTAMP '2000-01-01') AND n_nationkey % 15 <> 0"
    # The order key in microseconds keeps the times unique.
    ts = F.timestamp_micros(F.unix_micros(F.col("o_orderdate").cast("timestamp")) + F.col("o_orderkey"))
    return base.select(
        F.expr(V.VERTICAL_OF_NATION).alias("vertical"), F.when(F.expr(off), "desactivar").otherwise("activar").alias("accion"),
        ts.alias("ts"), F.concat(F.lit("p"), "o_orderkey").alias("prompt_path"), F.concat(F.lit("s"), "o_orderkey").alias("schema_path"))


LIVE_SQL = f"""e AS (SELECT vertical, accion, ts + to_microseconds(o_orderkey) AS ts, o_orderkey FROM ({VERTICAL_EVENTS_SQL})),
  off AS (SELECT vertical, max(ts) AS off_ts FROM e WHERE accion = 'desactivar' GROUP BY 1),
  live AS (SELECT e.vertical, min(ts) AS activado_en, 'p' || max_by(o_orderkey, ts)::STRING AS prompt_path
    FROM e LEFT JOIN off ON off.vertical = e.vertical WHERE accion = 'activar' AND (off_ts IS NULL OR ts > off_ts) GROUP BY 1)"""


@query("f19_is_active", f"WITH {LIVE_SQL} SELECT vertical, vertical IN (SELECT vertical FROM live) OR vertical = 'barrios_privados' AS active FROM (SELECT DISTINCT vertical FROM e)")
def f19(t):
    events = vertical_events(t)
    return ledger.are_active(events.select("vertical").distinct(), ledger.active_verticals(events))


@query("f20_upload_gate", with_cust(f"SELECT vertical, avg({V.score()}) >= 40 AND count(*) >= 5 AS upload_ready FROM v GROUP BY vertical"))
def f20(t):
    from ..operators import quality

    return quality.upload_ready(quality.field_metrics(v_cust(t), ["vertical"])).select("vertical", "upload_ready")


