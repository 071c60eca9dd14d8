"""Joins, aggregates, windows, sorts and set operations (J, A, W, T, U)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import extract as X
from ..functions import html as H
from ..functions import text as X1
from ..operators import crawlplan, dedup, discover, enrich, quality, report
from ..operators.grouping import first_per_group, global_row_number
from ..schemas import VERTICALS, vertical_dimension
from ..sources import lead_csv, ledger
from . import views as V
from .registry import query
from .scans import (
    LIVE_SQL, LOG_SQL, LOTS_SQL, PAGE_TEXT, UNIFIED, typed_leads, v_log, v_lots, vertical_events,
)
from .views import v_cust, v_part, v_title, with_cust

# ---------------------------------------------------------------- J


@query("j1_resume", "SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def j1(t):
    return enrich.resume(t.documents.select("doc_id", "lang"), t.labels, "doc_id")


#: A new batch (customers) against production (suppliers): both named after their number.
NEW_SQL = "SELECT c_custkey AS ord, 'Planta ' || (c_custkey % 997)::STRING || ' ' || c_mktsegment AS nombre, n_name AS partido FROM customer JOIN nation ON c_nationkey = n_nationkey"
PROD_SQL = "SELECT s_suppkey AS ord, 'planta  ' || (s_suppkey * 7 % 997)::STRING || ' Machinery' AS nombre, upper(n_name) AS partido FROM supplier JOIN nation ON s_nationkey = n_nationkey"


def new_batch(t):
    nation = t.nation.select("n_nationkey", F.col("n_name").alias("partido"))
    return t.customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).selectExpr(
        "c_custkey AS ord", "'Planta ' || CAST(c_custkey % 997 AS STRING) || ' ' || c_mktsegment AS nombre", "partido")


def production(t):
    nation = t.nation.select("n_nationkey", F.upper("n_name").alias("partido"))
    return t.supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).selectExpr(
        "s_suppkey AS ord", "'planta  ' || CAST(s_suppkey * 7 % 997 AS STRING) || ' Machinery' AS nombre", "partido")


@query("j2_exact_new", f"""SELECT ord, nombre FROM ({NEW_SQL}) WHERE {V.dedup_key()} NOT IN (SELECT {V.dedup_key()} FROM ({PROD_SQL}))""")
def j2(t):
    return dedup.exact_new(new_batch(t), production(t)).select("ord", "nombre")


def pairs_sql(rows: str, threshold: int) -> str:
    return f"""k AS (SELECT ord, {V.sort_tokens('nombre')} AS s, {V.norm('partido')} AS d FROM ({rows})),
  g AS (SELECT s, d, count(*) AS n FROM k GROUP BY 1, 2),
  m AS (SELECT s, count(*) AS n, min(ord) AS first FROM k GROUP BY 1),
  own AS (SELECT s, sum(n * (n - 1) / 2) FILTER (WHERE d <> '') AS own FROM g GROUP BY 1),
  e AS (SELECT a.s AS sa, b.s AS sb, CASE WHEN {V.likely('a.s', 'b.s', threshold)} THEN {V.ratio('a.s', 'b.s')} END AS score, a.n * b.n AS pairs, a.first AS fa, b.first AS fb
    FROM m a JOIN m b ON a.first < b.first),
  both_d AS (SELECT a.s AS sa, b.s AS sb, sum(a.n * b.n) AS same FROM g a JOIN g b ON a.d = b.d AND a.d <> '' GROUP BY 1, 2)"""


def name_pairs_sql(rows: str, threshold: int) -> str:
    return f"""WITH {pairs_sql(rows, threshold)}
  SELECT fa AS first_a, fb AS first_b, round(score, 6) AS score, pairs::BIGINT AS pairs, coalesce(same, 0)::BIGINT AS pairs_same_district
  FROM e LEFT JOIN both_d USING (sa, sb) WHERE score >= {threshold}
  UNION ALL SELECT first, first, 100.0, (n * (n - 1) / 2)::BIGINT, coalesce(own, 0)::BIGINT FROM m JOIN own USING (s) WHERE n > 1"""


@query("j3_name_pairs", name_pairs_sql(V.PART_SQL, 70))
def j3(t):
    return dedup.name_pairs(v_part(t), threshold=70).withColumn("score", F.round("score", 6))


TITLE_SQL = V.TITLE_SQL.format(V.node_text(r"regexp_extract(html, '(?is)<h1\b[^>]*>(.*?)</h1\s*>', 1)", ""))
#: Ratio from which titles count as alike.
TITLE_THRESHOLD = 75


@query("j3_page_titles", name_pairs_sql(TITLE_SQL, TITLE_THRESHOLD))
def j3_titles(t):
    return dedup.name_pairs(v_title(t), threshold=TITLE_THRESHOLD).withColumn("score", F.round("score", 6))


J4_SQL = f"""WITH n AS (SELECT *, {V.sort_tokens('nombre')} AS s, {V.norm('partido')} AS d FROM ({NEW_SQL})
    WHERE {V.dedup_key()} NOT IN (SELECT {V.dedup_key()} FROM ({PROD_SQL}))),
  p AS (SELECT *, {V.sort_tokens('nombre')} AS s, {V.norm('partido')} AS d FROM ({PROD_SQL})),
  ns AS (SELECT DISTINCT s FROM n), ps AS (SELECT s, min(ord) AS ord FROM p GROUP BY 1),
  sc AS (SELECT ns.s, ps.ord, {V.ratio('ns.s', 'ps.s')} AS score FROM ns JOIN ps ON true),
  best AS (SELECT s, ord, score FROM sc WHERE score >= 85 QUALIFY row_number() OVER (PARTITION BY s ORDER BY score DESC, ord) = 1)
  SELECT n.ord AS ord_a, p.ord AS ord_b, round(score, 6) AS score FROM n JOIN best USING (s) JOIN p ON p.ord = best.ord WHERE n.d = p.d OR n.d = '' OR p.d = ''"""


@query("j4_vs_production", J4_SQL)
def j4(t):
    _, matches = dedup.dedup_vs_production(new_batch(t), production(t))
    return matches.select("ord_a", "ord_b", F.round("score", 6).alias("score"))


DOMAIN_PAGE = f"SELECT page_id, 'https://' || {V.domain('url')} AS url, text FROM ({PAGE_TEXT})"


@query("j5_page_text", f"""WITH last AS (SELECT url, max_by(text, page_id) AS text FROM ({DOMAIN_PAGE}) WHERE length(text) >= 300 GROUP BY 1)
  SELECT page_id AS ord, md5(last.text) AS texto FROM (SELECT page_id, CASE WHEN contains(url, '?') THEN NULL ELSE 'https://' || {V.domain('url')} END AS url FROM pages) c LEFT JOIN last USING (url)""")
def j5(t):
    site = F.concat(F.lit("https://"), X1.url_domain("url"))
    texts = t.pages.select("page_id", site.alias("url"), H.html_text("html").alias("text"))
    cand = t.pages.select(F.col("page_id").alias("ord"), F.when(~F.col("url").contains("?"), site).alias("sitio_web"))
    return enrich.page_text_by_url(cand, texts).select("ord", F.md5("text").alias("texto"))


NEW_EMAILS = f"""SELECT barrio_nombre, unnest(er) AS email, coalesce(llm, false) AS confirmado FROM ({LOG_SQL}) WHERE coalesce(llm, false) OR lang <> 'fr'"""
KNOWN_EMAILS = f"SELECT DISTINCT lower(unnest({V.hits('text', V.EMAIL_RE)})) AS email FROM documents WHERE source IN ('src1', 'src13')"


def known_emails(t):
    return t.documents.filter("source IN ('src1', 'src13')").select(F.explode(X.emails_in("text")).alias("email"))


@query("j6_new_emails", f"SELECT barrio_nombre, email, confirmado FROM ({NEW_EMAILS}) WHERE lower(email) NOT IN (SELECT email FROM ({KNOWN_EMAILS}))")
def j6(t):
    return report.new_emails(v_log(t), known_emails(t)).select("barrio_nombre", "email", "confirmado")


@query("j7_new_sites", f"""SELECT page_id, sitio FROM (SELECT page_id, CASE WHEN contains(url, '?') THEN NULL ELSE {V.domain('url')} END AS sitio FROM pages)
  WHERE sitio IS NULL OR sitio NOT IN (SELECT {V.domain('url')} FROM pages WHERE contains(url, '/fr/'))""")
def j7(t):
    site = X1.url_domain("url")
    base = t.pages.filter(F.col("url").contains("/fr/")).select(site.alias("sitio_web"), F.lit(1).alias("origen"))
    extra = t.pages.select("page_id", F.when(~F.col("url").contains("?"), site).alias("sitio_web"))
    out = discover.supplement(base, extra)
    return out.filter("origen is null").select("page_id", F.col("sitio_web").alias("sitio"))


VERIF = """SELECT 'info' || c_custkey::STRING || '@example.com' AS email, CASE c_mktsegment WHEN 'BUILDING' THEN 'valid' WHEN 'HOUSEHOLD' THEN 'accept_all' ELSE 'invalid' END AS status,
  (c_nationkey * 4)::INT AS score, CASE WHEN c_acctbal < 0 THEN 'rate_limit' END AS error FROM customer WHERE c_nationkey < 20"""


def verifications(t):
    return t.customer.filter("c_nationkey < 20").selectExpr(
        "'info' || CAST(c_custkey AS STRING) || '@example.com' AS email",
        "CASE c_mktsegment WHEN 'BUILDING' THEN 'valid' WHEN 'HOUSEHOLD' THEN 'accept_all' ELSE 'invalid' END AS status",
        "CAST(c_nationkey * 4 AS INT) AS score", "CASE WHEN c_acctbal < 0 THEN 'rate_limit' END AS error")


@query("j8_verifications", with_cust(f"""SELECT ord, CASE WHEN r.status IS NOT NULL AND r.error IS NULL THEN r.status IN ('valid', 'accept_all') ELSE email_validado END AS email_validado,
  CASE WHEN r.status IS NOT NULL AND r.error IS NULL THEN r.score ELSE email_score END AS email_score, coalesce(v.email, '') <> '' AS verified, r.status IS NOT NULL AND r.error IS NULL AS verified_ok
  FROM v LEFT JOIN ({VERIF}) r ON r.email = v.email"""))
def j8(t):
    return enrich.apply_verifications(v_cust(t), verifications(t)).select("ord", "email_validado", "email_score", "verified", "verified_ok")


GEO_Q = "concat_ws(', ', direccion, nullif(localidad, ''), partido, CASE WHEN coalesce(provincia, '') = '' THEN 'Buenos Aires' ELSE provincia END, 'Argentina')"


def gazetteer(t, regions, shift):
    """Gazetteer of the query texts of some regions."""
    rows = enrich.with_geo_query(v_cust(t).filter(F.col("provincia").isin(*regions)))
    return rows.select(F.col("geo_query").alias("query"), F.when(F.col("ord") > 10, F.col("ord") + F.lit(float(shift))).alias("lat"),
                       (F.col("ord") * 2.0).alias("lon"), F.lit(f"g{shift}").alias("provider"))


@query("j9_geocodes", with_cust(f""", q AS (SELECT ord, latitud, longitud, provincia, {GEO_Q} AS query FROM v),
  g1 AS (SELECT query, ord + 0.0 AS lat, ord * 2.0 AS lon FROM q WHERE provincia IN ('AFRICA', 'ASIA') AND ord > 10),
  g2 AS (SELECT query, ord + 1000.0 AS lat, ord * 2.0 AS lon FROM q WHERE provincia IN ('ASIA', 'EUROPE') AND ord > 10)
  SELECT ord, coalesce(g1.lat, g2.lat, latitud)::DOUBLE AS latitud, coalesce(g1.lon, g2.lon, longitud)::DOUBLE AS longitud, coalesce(g1.lat, g2.lat) IS NOT NULL AS geo_found
  FROM q LEFT JOIN (SELECT query, min(lat) AS lat, min(lon) AS lon FROM g1 GROUP BY 1) g1 USING (query) LEFT JOIN (SELECT query, min(lat) AS lat, min(lon) AS lon FROM g2 GROUP BY 1) g2 USING (query)"""))
def j9(t):
    out = enrich.apply_geocodes(v_cust(t), gazetteer(t, ["AFRICA", "ASIA"], 0), gazetteer(t, ["ASIA", "EUROPE"], 1000))
    return out.select("ord", "latitud", "longitud", "geo_found")


RULES_SQL = f"""SELECT DISTINCT {V.domain('url')} AS domain, 1 AS seq, true AS allow, '/en/1' AS path FROM pages
  UNION ALL SELECT DISTINCT {V.domain('url')}, 2, false, '/en/' FROM pages WHERE NOT contains(url, '.org')
  UNION ALL SELECT DISTINCT {V.domain('url')}, 3, false, '/' FROM pages WHERE contains(url, 'spam')"""


def robots_rules(t):
    """Robots rules of the domains in the pages table."""
    d = X1.url_domain("url").alias("domain")

    def rule(df, seq, allow, path):
        return df.select(d, F.lit(seq).alias("seq"), F.lit(allow).alias("allow"), F.lit(path).alias("path")).distinct()

    return rule(t.pages, 1, True, "/en/1").unionByName(rule(t.pages.filter(~F.col("url").contains(".org")), 2, False, "/en/")).unionByName(
        rule(t.pages.filter(F.col("url").contains("spam")), 3, False, "/"))


@query("j10_crawl_permission", f"""WITH r AS ({RULES_SQL}),
  u AS (SELECT page_id, url, {V.domain('url')} AS domain, regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) AS path FROM pages),
  f AS (SELECT page_id, arg_min(allow, seq) AS allow FROM u JOIN r ON r.domain = u.domain AND starts_with(u.path, r.path) GROUP BY 1)
  SELECT page_id, coalesce(allow, true) AS allowed FROM u LEFT JOIN f USING (page_id)""")
def j10(t):
    return crawlplan.crawl_permission(t.pages.select("page_id", "url"), robots_rules(t)).select("page_id", "allowed")


@query("j11_vertical_dimension", with_cust("""SELECT ord, CASE vertical WHEN 'hoteles' THEN 'Google Places API' WHEN 'clinicas' THEN 'SSSALUD (buscador prestadores)'
  WHEN 'droguerias' THEN 'ANMAT (registro oficial)' WHEN 'barrios_privados' THEN 'Zonaprop + Argenprop' WHEN 'parques_industriales' THEN 'CAIP (caip.org.ar)'
  WHEN 'logisticas' THEN 'ARLOG + Google Dorks' ELSE 'Google Dorks' END AS source,
  CASE vertical WHEN 'hoteles' THEN 'categoria_estrellas' WHEN 'consulados' THEN 'pais_representado' END AS primero FROM v"""))
def j11(t):
    dim = F.broadcast(vertical_dimension(t.spark))  # 15 rows
    first = F.when(F.col("vertical").isin("hoteles", "consulados"), F.try_element_at("metadata_fields", F.lit(1)))
    return v_cust(t).join(dim, "vertical").select("ord", "source", first.alias("primero"))


STATUS_SQL = f"""WITH {LIVE_SQL}, a AS (SELECT vertical FROM live UNION SELECT 'barrios_privados'),
  p AS (SELECT vertical, count(*) AS lotes, sum(leads_count)::BIGINT AS leads FROM ({LOTS_SQL}) WHERE estado = 'pendiente' GROUP BY 1)
  SELECT vertical, coalesce(lotes, 0) AS lotes, coalesce(leads, 0)::BIGINT AS leads FROM a LEFT JOIN p USING (vertical)"""


@query("j12_status_table", STATUS_SQL)
def j12(t):
    return ledger.status_table(ledger.active_verticals(vertical_events(t)), v_lots(t)).select("vertical", "lotes", "leads")


@query("j13_inactive", f"WITH {LIVE_SQL} SELECT v AS vertical FROM (SELECT unnest({VERTICALS}) AS v) WHERE v NOT IN (SELECT vertical FROM live) AND v <> 'barrios_privados'")
def j13(t):
    return ledger.inactive_verticals(ledger.active_verticals(vertical_events(t)), vertical_dimension(t.spark)).select("vertical")


# ---------------------------------------------------------------- A


@query("a1_count_duplicates", f"SELECT count(*) - count(DISTINCT {V.dedup_key()}) AS duplicates FROM ({V.PART_SQL})")
def a1(t):
    return dedup.count_duplicates(v_part(t))


@query("a2_duplicate_groups", f"SELECT * FROM (SELECT ord, {V.dedup_key()} AS group_key, count(*) OVER (PARTITION BY {V.dedup_key()}) AS group_size FROM ({V.PART_SQL})) WHERE group_size > 1")
def a2(t):
    return dedup.duplicate_groups(v_part(t)).select("ord", "group_key", "group_size")


def pct(cond: str) -> str:
    return f"count(*) FILTER (WHERE {cond}) * 100.0::DOUBLE / count(*)"


METRICS_SQL = f"""SELECT vertical, count(*) AS total, avg(s) AS avg_score, {pct("coalesce(email, '') <> ''")} AS pct_with_email,
  {pct("coalesce(telefono, '') <> ''")} AS pct_with_phone, {pct("coalesce(sitio_web, '') <> ''")} AS pct_with_website,
  {pct('latitud IS NOT NULL')} AS pct_with_coords, {pct('email_validado')} AS pct_email_validated,
  count(*) FILTER (WHERE s >= 70) AS high_quality, count(*) FILTER (WHERE s >= 40 AND s < 70) AS medium_quality,
  count(*) FILTER (WHERE s < 40) AS low_quality FROM (SELECT *, {V.score()} AS s FROM v) GROUP BY vertical"""


@query("a3_field_metrics", with_cust(METRICS_SQL))
def a3(t):
    return quality.field_metrics(v_cust(t), ["vertical"])


CUST_GROUPS = f"SELECT vertical AS g, ord, nombre, partido FROM ({V.CUST_SQL})"
SUMMARY_SQL = f"""WITH RECURSIVE {V.greedy(CUST_GROUPS, 85)}, v AS ({V.CUST_SQL})
  SELECT vertical, count(*) AS total, count(*) - count(DISTINCT {V.dedup_key()}) AS exact_duplicates,
    count(DISTINCT {V.dedup_key()}) - count(kept.ord) AS fuzzy_duplicates, avg({V.score('v.')}) >= 40 AND count(*) >= 5 AS upload_ready
  FROM v LEFT JOIN kept ON kept.ord = v.ord GROUP BY vertical"""


@query("a3_summarize_batches", SUMMARY_SQL)
def a3_full(t):
    return quality.summarize_batches(v_cust(t)).select("vertical", "total", "exact_duplicates", "fuzzy_duplicates", "upload_ready")


def floor_pct(c: str) -> str:
    return f"(({c}) * 100 // greatest(count(*), 1))::BIGINT"


_E, _V = "count(*) FILTER (WHERE coalesce(email, '') <> '')", "count(*) FILTER (WHERE email_validado)"


@query("a4_floor_percents", with_cust(f"SELECT vertical, count(*) AS total, {_E} AS con_email, {floor_pct(_E)} AS pct_con_email, {_V} AS validados, {floor_pct(_V)} AS pct_validados FROM v GROUP BY vertical"))
def a4(t):
    return quality.floor_percent_summary(v_cust(t), ["vertical"]).select("vertical", "total", "con_email", "pct_con_email", "validados", "pct_validados")


@query("a5_high_quality_share", with_cust(f"SELECT vertical, count(*) FILTER (WHERE {V.score()} >= 70) * 100.0::DOUBLE / count(*) AS pct_high_quality FROM v GROUP BY vertical"))
def a5(t):
    return quality.high_quality_share(quality.field_metrics(v_cust(t), ["vertical"])).select("vertical", "pct_high_quality")


@query("a6_pending_leads", f"SELECT vertical, count(*) FILTER (WHERE estado = 'pendiente') AS lotes, coalesce(sum(leads_count) FILTER (WHERE estado = 'pendiente'), 0)::BIGINT AS leads FROM ({LOTS_SQL}) GROUP BY 1")
def a6(t):
    return ledger.pending_leads(v_lots(t))


@query("a7_lot_summary", f"""SELECT vertical, count(*) FILTER (WHERE estado = 'pendiente') AS pendientes, count(*) FILTER (WHERE estado = 'consolidado') AS consolidados,
  count(*) FILTER (WHERE estado = 'subido') AS subidos, count(*) FILTER (WHERE estado <> 'descartado') AS total FROM ({LOTS_SQL}) GROUP BY 1""")
def a7(t):
    return ledger.lot_summary(v_lots(t))


OUTCOME = "CASE WHEN error IS NOT NULL THEN 'error' WHEN coalesce(llm, false) OR len(er) > 0 OR len(pr) > 0 THEN 'exito' ELSE 'vacio' END"


@query("a8_chunk_stats", f"""SELECT chunk_id, n, exitos, vacios, errores, CASE WHEN vacios > n * 0.4 THEN 'muchos_vacios' WHEN vacios > 0 THEN 'algunos_vacios' ELSE 'ok' END AS diagnostico FROM (
  SELECT chunk_id, count(*) AS n, count(*) FILTER (WHERE o = 'exito') AS exitos, count(*) FILTER (WHERE o = 'vacio') AS vacios, count(*) FILTER (WHERE o = 'error') AS errores
  FROM (SELECT {OUTCOME} AS o, ((row_number() OVER (ORDER BY ord) - 1) // 50)::BIGINT AS chunk_id FROM ({LOG_SQL})) GROUP BY 1)""")
def a8(t):
    return report.chunk_stats(report.with_chunks(v_log(t), "ord", 50))


@query("a9_run_report", f"""SELECT total, sin_web, con_url, llm_ok, email_admin, solo_regex, (sin_web * 100 // total)::BIGINT AS pct_sin_web, (con_url * 100 // total)::BIGINT AS pct_con_url FROM (
  SELECT count(*) AS total, count(error) AS sin_web, count(*) FILTER (WHERE url_usada <> '') AS con_url, count(*) FILTER (WHERE llm) AS llm_ok,
  count(*) FILTER (WHERE coalesce(llm, false) AND {UNIFIED}) AS email_admin, count(*) FILTER (WHERE NOT coalesce(llm, false) AND {UNIFIED}) AS solo_regex FROM ({LOG_SQL}))""")
def a9(t):
    return report.run_report(v_log(t)).drop("solo_regex_real")


@query("a10_time_span", "SELECT strftime(min_by(ts, event_id), '%Y-%m-%dT%H:%M:%S') AS primero, strftime(max_by(ts, event_id), '%Y-%m-%dT%H:%M:%S') AS ultimo FROM events")
def a10(t):
    return report.time_span(t.events.select("event_id", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp")), "event_id")


@query("a11_run_metrics", with_cust(f""", q AS (SELECT ord, provincia, {GEO_Q} AS query FROM v),
  g AS (SELECT DISTINCT query FROM q WHERE provincia IN ('AFRICA', 'ASIA', 'EUROPE') AND ord > 10), f AS (SELECT ord FROM q JOIN g USING (query))
  SELECT count(*) AS discovered, count(*) FILTER (WHERE sitio_web IS NOT NULL) AS fetched, count(*) FILTER (WHERE sitio_web IS NOT NULL AND telefono IS NOT NULL) AS fetched_ok,
  count(*) FILTER (WHERE {V.truthy('v.email')} OR {V.truthy('telefono')} OR coalesce(latitud, 0) <> 0) AS enriched, count(*) FILTER (WHERE v.email IS NOT NULL) AS validated,
  count(*) FILTER (WHERE r.status IS NOT NULL AND r.error IS NULL) AS verified_ok, count(f.ord) AS geocoded, count(*) AS saved,
  count(*) FILTER (WHERE sitio_web IS NOT NULL AND telefono IS NULL) AS errors FROM v LEFT JOIN ({VERIF}) r ON r.email = v.email LEFT JOIN f ON f.ord = v.ord"""))
def a11(t):
    leads = v_cust(t).withColumns({"had_url": F.col("sitio_web").isNotNull(), "had_text": F.col("sitio_web").isNotNull() & F.col("telefono").isNotNull()})
    leads = enrich.apply_verifications(enrich.mark_enriched(leads), verifications(t))
    leads = enrich.apply_geocodes(leads, gazetteer(t, ["AFRICA", "ASIA"], 0), gazetteer(t, ["ASIA", "EUROPE"], 1000))
    return enrich.run_metrics(leads)


@query("a12_lot_totals", f"SELECT vertical, count(*) AS lotes, sum(leads_count)::BIGINT AS leads FROM ({LOTS_SQL}) GROUP BY ROLLUP (vertical)")
def a12(t):
    return ledger.lot_totals(v_lots(t))


@query("a13_discovery_totals", with_cust("SELECT count(*) AS total, count(sitio_web) AS with_website, count(*) - count(sitio_web) AS without_website FROM v"))
def a13(t):
    return discover.discovery_totals(v_cust(t))


@query("a14_processed_ids", "SELECT DISTINCT o_custkey::STRING AS barrio_id FROM orders")
def a14(t):
    from ..sources.jsonl import processed_ids

    return processed_ids(t.orders.select(F.col("o_custkey").cast("string").alias("barrio_id")))


@query("a15_new_email_counts", f"SELECT confirmado, count(*) AS n, count(DISTINCT email) AS distintos FROM ({NEW_EMAILS}) WHERE lower(email) NOT IN (SELECT email FROM ({KNOWN_EMAILS})) GROUP BY 1")
def a15(t):
    return report.new_email_counts(report.new_emails(v_log(t), known_emails(t)))


@query("a16_contact_details", f"""SELECT l.ord, barrio_nombre, url_usada AS url, CASE WHEN llm AND toxic = 0 THEN 'Persona ' || l.ord::STRING || ' (Intendente)' WHEN llm THEN '' END AS personas,
  CASE WHEN coalesce(llm, false) THEN '' ELSE array_to_string(er, ', ') END AS regex_only FROM ({LOG_SQL}) l LEFT JOIN labels ON doc_id = l.ord WHERE coalesce(llm, false) OR ({UNIFIED})""")
def a16(t):
    return report.contact_details(v_log(t)).select("ord", "barrio_nombre", "url", "personas", "regex_only")


# ---------------------------------------------------------------- W


@query("w1_dedup_exact", f"SELECT ord, nombre, partido FROM ({V.PART_SQL}) QUALIFY row_number() OVER (PARTITION BY {V.dedup_key()} ORDER BY ord) = 1")
def w1(t):
    return dedup.dedup_exact(v_part(t))


PART_GROUPS = f"SELECT '' AS g, ord, nombre, partido FROM ({V.PART_SQL})"


@query("w2_dedup_fuzzy", f"WITH RECURSIVE {V.greedy(PART_GROUPS, 70)} SELECT p.* FROM kept JOIN ({V.PART_SQL}) p USING (ord)")
def w2(t):
    return dedup.dedup_fuzzy(v_part(t), threshold=70)


@query("w2_dedup_fuzzy_titles", f"WITH RECURSIVE {V.greedy(f'SELECT \'\' AS g, ord, nombre, partido FROM ({TITLE_SQL})', TITLE_THRESHOLD)} SELECT p.* FROM kept JOIN ({TITLE_SQL}) p USING (ord)")
def w2_titles(t):
    return dedup.dedup_fuzzy(v_title(t), threshold=TITLE_THRESHOLD)


@query("w3_dedup_by_name", f"SELECT doc_id AS ord, md5(text) AS texto FROM documents QUALIFY row_number() OVER (PARTITION BY {V.squash('text')} ORDER BY doc_id) = 1")
def w3(t):
    rows = t.documents.select(F.col("doc_id").alias("ord"), F.col("text").alias("nombre"))
    return dedup.dedup_by_name(rows).select("ord", F.md5("nombre").alias("texto"))


@query("w4_dedup_by_url", f"SELECT page_id, url FROM (SELECT page_id, CASE WHEN contains(url, '?') THEN NULL ELSE {V.domain('url')} END AS url FROM pages) QUALIFY row_number() OVER (PARTITION BY coalesce(url, '') ORDER BY page_id) = 1")
def w4(t):
    rows = t.pages.select("page_id", F.when(~F.col("url").contains("?"), X1.url_domain("url")).alias("url"))
    return dedup.dedup_by_url(rows, "page_id", "url")


@query("w5_dedup_by_place_id", "SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P' QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) = 1")
def w5(t):
    place = F.when(F.col("o_orderstatus") != "P", F.col("o_custkey").cast("string")).otherwise("")
    rows = t.orders.select("o_orderkey", F.create_map(F.lit("place_id"), place).alias("raw_data"))
    return dedup.dedup_by_place_id(rows, "o_orderkey").select("o_orderkey")


@query("w6_chunks", "SELECT o_orderkey, ((row_number() OVER (ORDER BY o_orderkey) - 1) // 100)::BIGINT AS chunk_id FROM orders")
def w6(t):
    return report.with_chunks(t.orders.select("o_orderkey"), "o_orderkey", 100)


@query("w7_latest_run", "SELECT user_id, max_by(event_id, (ts, event_id)) AS event_id FROM events GROUP BY 1")
def w7(t):
    rows = t.events.select(F.col("user_id").alias("vertical"), F.col("ts").alias("inicio"), F.col("event_id").alias("run_id"))
    return ledger.latest_runs(rows).select(F.col("vertical").alias("user_id"), F.col("run_id").alias("event_id"))


SUB = "SELECT page_id, 'site' || (page_id // 10)::STRING AS site, url, '/' || split_part(regexp_extract(url, '^[a-z]+://[^/]*/([a-z]+)', 1), '/', 1) AS path, text FROM ({})"
SUB_PRIORITY = "CASE path WHEN '/es' THEN 0 WHEN '/fr' THEN 1 WHEN '/de' THEN 2 WHEN '/en' THEN 3 END"


@query("w8_contact_page", f"SELECT site, page_id FROM ({SUB.format(PAGE_TEXT)}) WHERE length(text) >= 300 AND {SUB_PRIORITY} IS NOT NULL QUALIFY row_number() OVER (PARTITION BY site ORDER BY {SUB_PRIORITY}, page_id) = 1")
def w8(t):
    pages = t.pages.select(
        "page_id", F.concat(F.lit("site"), F.floor(F.col("page_id") / 10).cast("string")).alias("site"), "url", F.lit("https://home/").alias("home_url"),
        F.concat(F.lit("/"), F.regexp_extract("url", "^[a-z]+://[^/]*/([a-z]+)", 1)).alias("path"), H.html_text("html").alias("text"))
    # Two pages of a site can share a path here: the earlier one stands for it.
    one = first_per_group(pages.filter(F.length("text") >= 300), ["site", "path"], ["page_id"])
    return discover.pick_contact_page(one, discover.subpage_priority(t.spark, ["/es", "/fr", "/de", "/en"])).select("site", "page_id")


RESULTS = "SELECT page_id // 7 AS lead, page_id % 3 AS query_no, page_id AS rank, CASE WHEN contains(url, '.org') THEN replace(url, '.org', '.com.ar') ELSE url END AS url FROM pages"


def search_results(t):
    url = F.when(F.col("url").contains(".org"), F.replace("url", F.lit(".org"), F.lit(".com.ar"))).otherwise(F.col("url"))
    return t.pages.select(F.floor(F.col("page_id") / 7).alias("lead"), (F.col("page_id") % 3).alias("query_no"), F.col("page_id").alias("rank"), url.alias("url"))


@query("w9_search_pick", f"""SELECT lead, url FROM ({RESULTS}) WHERE NOT {V.any_contains(V.netloc('url'), discover.SEARCH_BANNED)}
  QUALIFY row_number() OVER (PARTITION BY lead ORDER BY query_no, CASE WHEN contains(url, '.com.ar') OR contains(url, '.org.ar') THEN 0 ELSE 1 END, rank) = 1""")
def w9(t):
    return discover.pick_search_result(search_results(t), ["lead"]).select("lead", "url")


def answers(t):
    """Provider answers per conversation: failed turns carry an error."""
    fails = F.when(F.col("role") == "user", "timeout")
    return t.conversations.select(F.col("conv_id").alias("id"), F.col("turn").alias("priority"), F.concat(F.lit("p"), "turn").alias("provider"),
                                  F.col("text").alias("reply"), fails.alias("error"))


@query("w10_answer_waterfall", """WITH ok AS (SELECT conv_id, 'p' || min(turn)::STRING AS provider, md5(arg_min(text, turn)) AS reply FROM conversations WHERE role <> 'user' AND text <> '' GROUP BY 1)
  SELECT conv_id AS id, coalesce(provider, 'regex_only') AS provider, reply, CASE WHEN reply IS NULL THEN 'Todos los LLM fallaron' END AS error FROM (SELECT DISTINCT conv_id FROM conversations) LEFT JOIN ok USING (conv_id)""")
def w10(t):
    out = discover.answer_or_regex_only(t.conversations.select(F.col("conv_id").alias("id")).distinct(), answers(t))
    return out.select("id", "provider", F.md5("reply").alias("reply"), "error")


LISTING_SQL = """SELECT o_custkey AS portal, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS page, CASE WHEN o_totalprice > 250000 THEN 5 ELSE 0 END AS n FROM orders"""


@query("w11_listing_cut", f"""WITH p AS ({LISTING_SQL}), g AS (SELECT *, sum(CASE WHEN n > 0 THEN 1 ELSE 0 END) OVER (PARTITION BY portal ORDER BY page) AS island FROM p),
  e AS (SELECT *, sum(CASE WHEN n = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY portal, island ORDER BY page) AS empties FROM g),
  c AS (SELECT portal, min(page) AS cut FROM e WHERE empties = 2 GROUP BY 1)
  SELECT portal, page FROM p LEFT JOIN c USING (portal) WHERE cut IS NULL OR page < cut""")
def w11(t):
    from pyspark.sql.window import Window as W

    page = F.row_number().over(W.partitionBy("o_custkey").orderBy("o_orderkey")).cast("long")
    pages = t.orders.select(F.col("o_custkey").alias("portal"), page.alias("page"), F.when(F.col("o_totalprice") > 250000, 5).otherwise(0).alias("rows"))
    return discover.cut_listing(pages, ["portal"], bucket_pages=3).select("portal", "page")


@query("w12_failure_streaks", """WITH g AS (SELECT *, sum(CASE WHEN event_type <> 'error' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS island FROM events)
  SELECT event_id, (sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) OVER w)::BIGINT AS streak, sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) OVER w >= 3 AS open
  FROM g WINDOW w AS (PARTITION BY user_id, island ORDER BY ts, event_id)""")
def w12(t):
    attempts = t.events.select("event_id", "user_id", "ts", (F.col("event_type") == "error").alias("fail"))
    return crawlplan.failure_streaks(attempts, "user_id", ["ts", "event_id"]).select("event_id", "streak", "open")


@query("w13_pacing_plan", """WITH r AS (SELECT event_id, user_id, epoch_us(ts) // 60000000 AS arrival FROM events),
  n AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY arrival, event_id) - 1 AS k FROM r)
  SELECT event_id, (max(arrival - k * 90) OVER (PARTITION BY user_id ORDER BY arrival, event_id) + k * 90)::DOUBLE AS slot FROM n""")
def w13(t):
    minutes = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 60_000_000)
    requests = t.events.select("event_id", "user_id", minutes.alias("arrival"))
    plan = crawlplan.pacing_plan(requests, 90, "user_id", "arrival", "event_id")
    return plan.select("event_id", F.col("slot").cast("double").alias("slot"))


SOURCES_SQL = "SELECT s_suppkey AS ord, s_name AS nombre, 0 AS prioridad FROM supplier UNION ALL SELECT c_custkey, replace(c_name, 'Customer', 'Supplier'), 1 FROM customer"


def source_tables(t):
    return (t.supplier.select(F.col("s_suppkey").alias("ord"), F.col("s_name").alias("nombre")),
            t.customer.select(F.col("c_custkey").alias("ord"), F.replace("c_name", F.lit("Customer"), F.lit("Supplier")).alias("nombre")))


@query("w14_source_quota", f"SELECT ord, nombre, prioridad FROM ({SOURCES_SQL}) ORDER BY prioridad, ord LIMIT 150")
def w14(t):
    return discover.take_quota(discover.union_sources(*source_tables(t)), 150, ["prioridad", "ord"])


@query("w15_source_fallback", """SELECT ord, c_nationkey, prioridad FROM (SELECT s_suppkey AS ord, s_nationkey AS c_nationkey, 0 AS prioridad FROM supplier WHERE s_acctbal > 5000
  UNION ALL SELECT c_custkey, c_nationkey, 1 FROM customer) QUALIFY prioridad = min(prioridad) OVER (PARTITION BY c_nationkey)""")
def w15(t):
    first = t.supplier.filter("s_acctbal > 5000").select(F.col("s_suppkey").alias("ord"), F.col("s_nationkey").alias("c_nationkey"))
    second = t.customer.select(F.col("c_custkey").alias("ord"), "c_nationkey")
    return discover.primary_or_fallback(discover.union_sources(first, second), ["c_nationkey"])


# ---------------------------------------------------------------- T


@query("t1_order_positions", "SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS n FROM orders")
def t1_positions(t):
    rows = t.orders.select("o_orderkey", (-F.col("o_totalprice")).alias("lowest"))
    return global_row_number(rows, "lowest", "n", ties=("o_orderkey",)).select("o_orderkey", "n")


@query("t1_match_order", J4_SQL.replace("SELECT n.ord AS ord_a", "SELECT row_number() OVER (ORDER BY score DESC, n.ord, p.ord) AS n, n.ord AS ord_a"))
def t1(t):
    _, matches = dedup.dedup_vs_production(new_batch(t), production(t))
    return dedup.match_positions(matches).select("ord_a", "ord_b", F.round("score", 6).alias("score"), "n")


@query("t2_top_pairs", f"""WITH k AS (SELECT ord, {V.sort_tokens('nombre')} AS s, {V.norm('partido')} AS d FROM ({V.PART_SQL}))
  SELECT a.ord AS ord_a, b.ord AS ord_b, 100.0::DOUBLE AS score, CASE WHEN a.d = b.d THEN 'nombre+partido' ELSE 'nombre' END AS match_type
  FROM k a JOIN k b ON a.s = b.s AND a.ord < b.ord ORDER BY a.ord, b.ord LIMIT 20""")
def t2(t):
    return dedup.top_matches(v_part(t), 20).select("ord_a", "ord_b", "score", "match_type")


@query("t3_lots_newest_first", f"SELECT lote_id, row_number() OVER (ORDER BY creado_en DESC, lote_id) AS n FROM ({LOTS_SQL})")
def t3(t):
    return ledger.newest_first(v_lots(t)).select("lote_id", "n")


@query("t4_head_limit", "SELECT doc_id FROM documents ORDER BY doc_id LIMIT 100")
def t4(t):
    return discover.take_quota(t.documents.select("doc_id"), 100, ["doc_id"])


@query("t5_prefer_ar", f"SELECT rank, row_number() OVER (ORDER BY CASE WHEN contains(url, '.com.ar') OR contains(url, '.org.ar') THEN 0 ELSE 1 END, rank) AS n FROM ({RESULTS})")
def t5(t):
    place = discover.prefer_ar_order("url").cast("long") * F.lit(1 << 40) + F.col("rank")
    return global_row_number(search_results(t).select("rank", place.alias("place")), "place", "n").select("rank", "n")


# ---------------------------------------------------------------- U


@query("u1_merge_sources", f"SELECT ord, nombre, prioridad FROM (SELECT * FROM ({SOURCES_SQL}) QUALIFY row_number() OVER (PARTITION BY {V.squash('nombre')} ORDER BY prioridad, ord) = 1) ORDER BY prioridad, ord LIMIT 1000")
def u1(t):
    return discover.merge_sources(list(source_tables(t)), 1000)


@query("u2_consolidate", with_cust("SELECT nombre, vertical, coalesce(email, '') AS email, CASE WHEN provincia = 'ASIA' THEN '' ELSE provincia END AS provincia FROM v"))
def u2(t):
    rows = lead_csv.export_row(typed_leads(t))
    parts = [rows.filter("provincia = 'ASIA'").drop("provincia"), rows.filter("provincia <> 'ASIA'").withColumn("sobra", F.lit(1))]
    return lead_csv.consolidate(parts).select("nombre", "vertical", "email", "provincia")


@query("u3_supplement", f"""WITH b AS (SELECT page_id, {V.domain('url')} AS sitio_web FROM pages WHERE contains(url, '/fr/')), x AS (SELECT page_id, {V.domain('url')} AS sitio_web FROM pages WHERE NOT contains(url, '/fr/'))
  SELECT * FROM b UNION ALL SELECT * FROM x WHERE sitio_web NOT IN (SELECT sitio_web FROM b)""")
def u3(t):
    rows = t.pages.select("page_id", X1.url_domain("url").alias("sitio_web"), "url")
    base, extra = rows.filter(F.col("url").contains("/fr/")).drop("url"), rows.filter(~F.col("url").contains("/fr/")).drop("url")
    return discover.supplement(base, extra)


@query("u4_union_emails", f"SELECT doc_id, array_to_string(list_sort(list_distinct({V.hits('text', V.EMAIL_RE)} || ['admin' || doc_id::STRING || '@example.com'] || CASE WHEN lang = 'en' THEN ['info@example.com'] ELSE [] END)), ',') AS emails FROM documents")
def u4(t):
    contact = F.array(F.struct(F.lit("x").alias("nombre_completo"), F.lit(None).cast("string").alias("cargo"),
                               F.concat(F.lit("admin"), "doc_id", F.lit("@example.com")).alias("email"), F.lit(None).cast("string").alias("telefono")))
    general = F.when(F.col("lang") == "en", F.array(F.lit("info@example.com")))
    return t.documents.select("doc_id", F.array_join(X.union_emails(X.emails_in("text"), contact, general), ",").alias("emails"))


@query("u5_inactive_by_difference", f"WITH {LIVE_SQL} SELECT unnest({VERTICALS}) AS vertical EXCEPT SELECT vertical FROM live")
def u5(t):
    live = ledger.active_verticals(vertical_events(t), with_default=False).select("vertical")
    return vertical_dimension(t.spark).select("vertical").exceptAll(live)


@query("u6_ban_table", f"SELECT DISTINCT domain FROM (SELECT unnest({discover.SECTOR_BANNED}) AS domain UNION ALL SELECT {V.domain('url')} FROM pages WHERE contains(url, 'spam') OR contains(url, 'pills'))")
def u6(t):
    bad = t.pages.filter("url LIKE '%spam%' OR url LIKE '%pills%'").select(X1.url_domain("url").alias("domain"))
    return discover.ban_table(t.spark, discover.SECTOR_BANNED).unionByName(bad).distinct()


