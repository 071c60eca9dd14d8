"""Ledger, streams, extension points and whole jobs (L, ST, E, Q)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import extract as X
from ..functions import pii
from ..functions import replies
from ..functions import text as T
from ..functions.scoring import quality_score
from ..operators import dedup, discover, enrich
from ..plans import jobs
from ..schemas import METADATA_FIELDS, metadata_schema
from ..sources import lead_csv, ledger
from ..streaming import incremental, streak_state
from . import views as V
from .functions import REPLY, registry_pages
from .registry import query
from .relational import (
    KNOWN_EMAILS, NEW_EMAILS, NEW_SQL, PROD_SQL, SUMMARY_SQL, VERIF, known_emails, new_batch, production, verifications,
)
from .scans import LIVE_SQL, LOG_SQL, LOTS_SQL, UNIFIED, lot_events, typed_leads, v_log, v_lots, vertical_events
from .views import v_cust, v_part, with_cust

# ---------------------------------------------------------------- flagship


@query("contact_quality_by_language", f"""WITH d AS (SELECT doc_id AS ord, lang, source, {V.hits('text', V.EMAIL_RE)} AS e, {V.hits('text', V.PHONE_RE)} AS p, text FROM documents),
  l AS (SELECT ord, lang, sha256({V.norm('text')}) AS nombre, source AS partido, len(e) > 0 AS con_email, len(p) > 0 AS con_tel FROM d),
  u AS (SELECT * FROM l QUALIFY row_number() OVER (PARTITION BY lang, {V.dedup_key()} ORDER BY ord) = 1)
  SELECT lang, count(*) AS total, avg((CASE WHEN con_email THEN 25 ELSE 0 END + CASE WHEN con_tel THEN 20 ELSE 0 END + 10)::DOUBLE) AS avg_score,
    count(*) FILTER (WHERE con_email) AS con_email, count(*) FILTER (WHERE con_tel) AS con_tel FROM u GROUP BY lang""")
def flagship(t):
    """Documents -> contacts -> redacted leads -> first per text and source -> quality by language.

    The whole normalised text is the name; its digest stands for it in the shuffle.
    """
    found = t.documents.select(
        F.col("doc_id").alias("ord"), "lang", F.sha2(T.normalize_name("text"), 256).alias("nombre"), F.col("source").alias("partido"),
        F.try_element_at(X.emails_in("text"), F.lit(1)).alias("email"), F.try_element_at(X.phones_in("text"), F.lit(1)).alias("telefono"))
    none = F.lit(None).cast("string")
    leads = found.select(
        "ord", "lang", "nombre", "partido", pii.pseudonymize_email("email").alias("email"),
        F.when(F.col("telefono").isNotNull(), pii.mask_phone("telefono")).alias("telefono"),
        none.alias("sitio_web"), none.alias("localidad"), F.lit(None).cast("double").alias("latitud"),
        F.lit(None).cast("double").alias("longitud"), F.lit(False).alias("email_validado"))
    unique = dedup.dedup_exact(leads, "ord", ["lang"])
    return unique.groupBy("lang").agg(
        F.count(F.lit(1)).alias("total"), F.avg(quality_score()).alias("avg_score"),
        F.count("email").alias("con_email"), F.count("telefono").alias("con_tel"))


# ---------------------------------------------------------------- L


@query("l1_activate", f"WITH {LIVE_SQL} SELECT vertical, strftime(activado_en, '%Y-%m-%d %H:%M:%S') AS activado_en, prompt_path FROM live")
def l1(t):
    view = ledger.active_verticals(vertical_events(t), with_default=False)
    return view.select("vertical", F.date_format("activado_en", "yyyy-MM-dd HH:mm:ss").alias("activado_en"), "prompt_path")


@query("l2_deactivate", f"WITH {LIVE_SQL} SELECT DISTINCT vertical FROM e WHERE accion = 'desactivar' AND vertical NOT IN (SELECT vertical FROM live)")
def l2(t):
    events = vertical_events(t)
    off = events.filter("accion = 'desactivar'").select("vertical").distinct()
    return off.join(ledger.active_verticals(events).select("vertical"), "vertical", "left_anti")


@query("l3_create_lot", f"SELECT o_orderkey::STRING AS lote_id, {V.VERTICAL_OF_NATION} AS vertical, 'pendiente' AS estado, 0::BIGINT AS leads_count FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey")
def l3(t):
    root = t.scratch("l3")
    book = ledger.Ledger(t.spark, root)
    book.append_frame("lots", lot_events(t).filter("vertical is not null"))
    return book.lots().select("lote_id", "vertical", "estado", "leads_count")


@query("l4_lot_states", f"SELECT lote_id, vertical, estado, leads_count, strftime(creado_en, '%Y-%m-%d') AS creado, estado = 'subido' AS con_fecha FROM ({LOTS_SQL})")
def l4(t):
    return v_lots(t).select("lote_id", "vertical", "estado", "leads_count", F.date_format("creado_en", "yyyy-MM-dd").alias("creado"),
                            F.col("subido_en").isNotNull().alias("con_fecha"))


@query("l5_runs", """SELECT o_orderkey::STRING AS run_id, o_custkey::STRING AS vertical, CASE WHEN n IS NULL THEN false ELSE true END AS terminado,
  coalesce(n, 0)::BIGINT AS discovered, coalesce(q, 0)::BIGINT AS errors FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n, count(*) FILTER (WHERE l_returnflag = 'R') AS q FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey""")
def l5(t):
    at = F.col("o_orderdate").cast("timestamp")
    null = F.lit(None).cast("long")
    start = t.orders.select(F.col("o_orderkey").cast("string").alias("run_id"), F.col("o_custkey").cast("string").alias("vertical"), F.lit("inicio").alias("tipo"),
                            at.alias("ts"), *[null.alias(c) for c in ("discovered", "scraped", "enriched", "validated", "errors")])
    done = t.lineitem.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("l_returnflag") == "R").alias("q"), F.max("l_shipdate").alias("d"))
    end = done.select(F.col("l_orderkey").cast("string").alias("run_id"), F.lit(None).cast("string").alias("vertical"), F.lit("fin").alias("tipo"),
                      F.col("d").cast("timestamp").alias("ts"), F.col("n").alias("discovered"), F.lit(0).cast("long").alias("scraped"),
                      F.lit(0).cast("long").alias("enriched"), F.lit(0).cast("long").alias("validated"), F.col("q").alias("errors"))
    return ledger.run_states(start.unionByName(end)).select("run_id", "vertical", F.col("fin").isNotNull().alias("terminado"), "discovered", "errors")


@query("l6_list_active", f"WITH {LIVE_SQL} SELECT vertical FROM live UNION SELECT 'barrios_privados'")
def l6(t):
    return ledger.list_active(vertical_events(t)).select("vertical")


# ---------------------------------------------------------------- ST


@query("st1_incremental", f"SELECT doc_id::STRING AS barrio_id, array_to_string({V.hits('text', V.EMAIL_RE)}, ',') AS emails FROM documents")
def st1(t):
    """The documents arrive as files, half of them twice; every id is extracted once."""
    root = t.scratch("st1")
    pages = t.documents.select(F.col("doc_id").alias("id"), F.col("source").alias("nombre"), F.lit("").alias("url"), "text")
    pages.filter("nombre < 'src5'").write.mode("append").parquet(f"{root}/in")
    for _ in range(2):
        stream = incremental.page_stream(t.spark, f"{root}/in", pages.schema, files_per_trigger=1)
        incremental.incremental_extraction(stream, f"{root}/out", f"{root}/state").awaitTermination()
        pages.write.mode("append").parquet(f"{root}/in")
    return t.spark.read.parquet(f"{root}/out").select("barrio_id", F.array_join("emails_regex", ",").alias("emails"))


STREAKS_SQL = """WITH g AS (SELECT *, sum(CASE WHEN event_type <> 'error' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY event_id) AS island FROM events)
  SELECT user_id::STRING AS source, event_id AS ts, (sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) OVER w)::BIGINT AS streak, sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) OVER w >= 3 AS open
  FROM g WINDOW w AS (PARTITION BY user_id, island ORDER BY event_id)"""


@query("st2_streaming_streaks", STREAKS_SQL)
def st2(t):
    root = t.scratch("st2")
    attempts = t.events.select(F.col("user_id").cast("string").alias("source"), F.col("event_id").alias("ts"), (F.col("event_type") == "error").alias("fail"))
    middle = attempts.agg(F.floor(F.avg("ts")).alias("m")).scalar()
    for later in (False, True):  # the attempts arrive in two parts, in order
        part = attempts.filter((F.col("ts") > middle) == later)
        part.write.mode("append").parquet(f"{root}/in")
        stream = incremental.page_stream(t.spark, f"{root}/in", attempts.schema)
        incremental.streak_stream(stream, f"{root}/out", f"{root}/state", f"{root}/checkpoint").awaitTermination()
    return t.spark.read.parquet(f"{root}/out").select("source", "ts", "streak", "open")


@query("st2_streaks_out_of_order", STREAKS_SQL)
def st2_out_of_order(t):
    """The attempts arrive in three files that mix all times; a last row far ahead closes the feed."""
    root = t.scratch("st2o")
    attempts = t.events.select(F.col("user_id").cast("string").alias("source"), F.col("ts").cast("timestamp").alias("ts"),
                               F.col("event_id").alias("ord"), (F.col("event_type") == "error").alias("fail"))
    for part in (2, 0, 1):
        attempts.filter(F.col("ord") % 3 == part).write.mode("append").parquet(f"{root}/in")
    end = attempts.agg((F.max("ts") + F.expr("INTERVAL 80 DAYS")).alias("ts")).select(
        F.lit(None).cast("string").alias("source"), "ts", F.lit(0).cast("long").alias("ord"), F.lit(False).alias("fail"))
    end.write.mode("append").parquet(f"{root}/in")
    stream = incremental.page_stream(t.spark, f"{root}/in", attempts.schema, files_per_trigger=4)
    streak_state.streak_state_stream(stream, f"{root}/out", f"{root}/checkpoint", "40 days").awaitTermination()
    return t.spark.read.parquet(f"{root}/out").select("source", F.col("ord").alias("ts"), "streak", "open")


# ---------------------------------------------------------------- E


@query("e1_source_plugin", with_cust("SELECT ord AS page_id, nombre FROM v"))
def e1(t):
    """A user's own source: registry tables with the name in the first cell."""
    own = {"prueba": lambda p: discover.parse_table(p, "propia", {"nombre": 0}, header_cells=False)}
    return discover.discovery_source("prueba", own)(registry_pages(t)).select("page_id", "nombre")


@query("e2_page_parser", "SELECT page_id, count(*) AS n FROM (SELECT page_id, unnest(regexp_extract_all(html, '<li>')) FROM pages) GROUP BY 1")
def e2(t):
    """A user's own page parser: any pages -> rows function."""
    def items(pages):
        return pages.select("page_id", F.explode(F.regexp_extract_all("html", F.lit("<li>"), F.lit(0))).alias("item"))

    return discover.discovery_source("items", {"items": items})(t.pages).groupBy("page_id").agg(F.count(F.lit(1)).alias("n"))


@query("e3_answer_provider", "SELECT conv_id AS id, 'p' || min(turn)::STRING AS provider FROM conversations WHERE text <> '' GROUP BY 1")
def e3(t):
    """A provider is any function text -> reply that gives an answers table."""
    def shout(df):
        return df.select(F.col("conv_id").alias("id"), F.col("turn").alias("priority"), F.concat(F.lit("p"), "turn").alias("provider"),
                         F.upper("text").alias("reply"), F.lit(None).cast("string").alias("error"))

    return discover.first_good_answer(shout(t.conversations)).select("id", "provider")


@query("e4_metadata_registry", "SELECT doc_id, CASE WHEN lang <> 'de' AND source <> 'src7' AND n_chars % 7 BETWEEN 1 AND 5 THEN (n_chars % 7)::BIGINT END AS estrellas FROM documents")
def e4(t):
    """Typed view of validated metadata by the registered schema."""
    rows = t.documents.select("doc_id", replies.parse_reply(F.expr(REPLY)).alias("v"))
    typed = F.from_json(replies.metadata_json("v", "hoteles"), metadata_schema("hoteles"))
    assert [f.name for f in METADATA_FIELDS["hoteles"]] == metadata_schema("hoteles").names
    return rows.select("doc_id", typed["categoria_estrellas"].alias("estrellas"))


# ---------------------------------------------------------------- Q


def run_inputs(t):
    """Candidates, page texts and answers of the enrichment run over customers."""
    leads = v_cust(t)
    cand = leads.select("ord", "nombre", "sitio_web", "partido", "provincia", "localidad", F.col("fuente_contacto").alias("fuente"))
    texts = leads.filter("sitio_web is not null and telefono is not null").select(
        F.col("sitio_web").alias("url"), F.repeat(F.concat("nombre", F.lit(" ")), F.lit(20)).alias("text"), F.col("ord").alias("page_id"))
    reply = F.to_json(F.struct(F.col("nombre"), F.col("email"), F.when(F.col("estado_comercial") == "CLIENTE", F.lit("")).otherwise(F.col("localidad")).alias("partido"),
                               F.col("telefono"), F.col("direccion")))
    reply = F.when(F.col("provincia") == "ASIA", "no sé").otherwise(reply)
    return {"candidates": cand, "page_text": texts, "answers": leads.filter("sitio_web is not null").select(F.col("sitio_web").alias("url"), reply.alias("reply")),
            "verifications": verifications(t), "gazetteer": None}


Q1_BODY = f""", c AS (SELECT *, sitio_web IS NOT NULL AND telefono IS NOT NULL AS con_texto FROM v),
  x AS (SELECT *, con_texto AND provincia <> 'ASIA' AS ok FROM c),
  l AS (SELECT ord, nombre, sitio_web AS url, CASE WHEN ok THEN email END AS email, CASE WHEN ok THEN telefono END AS telefono,
    CASE WHEN ok AND estado_comercial <> 'CLIENTE' AND localidad IS NOT NULL THEN localidad ELSE partido END AS partido, ok, con_texto FROM x)"""


@query("q1_enrichment_run", with_cust(Q1_BODY + f"""SELECT ord, nombre, l.email, telefono, partido, CASE WHEN ok THEN url ELSE 'customer' END AS fuente_contacto,
  CASE WHEN r.status IS NOT NULL AND r.error IS NULL THEN r.status IN ('valid', 'accept_all') ELSE false END AS email_validado, ok AS extracted FROM l LEFT JOIN ({VERIF}) r ON r.email = l.email"""))
def q1(t):
    out = jobs.enrichment_plan(options=jobs.RunOptions("hoteles", limit=None), **run_inputs(t))
    return out.select("ord", "nombre", "email", "telefono", "partido", "fuente_contacto", "email_validado", "extracted")


@query("q1_run_metrics", with_cust(Q1_BODY + f"""SELECT count(*) AS discovered, count(url) AS fetched, count(*) FILTER (WHERE con_texto) AS fetched_ok,
  count(*) FILTER (WHERE {V.truthy('l.email')} OR {V.truthy('telefono')}) AS enriched, count(l.email) AS validated, count(*) FILTER (WHERE url IS NOT NULL AND NOT con_texto) AS errors FROM l"""))
def q1_metrics(t):
    out = jobs.enrichment_plan(options=jobs.RunOptions("hoteles", limit=None), **run_inputs(t))
    return enrich.run_metrics(out).select("discovered", "fetched", "fetched_ok", "enriched", "validated", "errors")


def extraction_inputs(leads):
    """Search results by customer (``id``) and the home and contact pages of customers with a site."""
    results = leads.filter("provincia <> 'ASIA'").select(F.col("ord").cast("string").alias("id"), F.lit(0).alias("query_no"), F.explode(F.array(F.lit(0), F.lit(1))).alias("rank"),
                                                         F.concat(F.lit("https://hallado.example.com.ar/"), "ord").alias("url"))
    results = results.withColumn("url", F.when(F.col("rank") == 0, "https://www.facebook.com/x").otherwise(F.col("url")))
    sites = leads.filter("sitio_web is not null")
    home = sites.select(F.col("sitio_web").alias("url"), F.lit("").alias("path"), F.col("sitio_web").alias("site"), F.lit("portada").alias("text"))
    contact = sites.select(F.concat("sitio_web", F.lit("/contacto")).alias("url"), F.lit("/contacto").alias("path"), F.col("sitio_web").alias("site"),
                           F.concat_ws(" ", F.lit("escribir a"), "email").alias("text"))
    return results, home.unionByName(contact)


@query("q2_extraction_job", with_cust("""SELECT ord::STRING AS barrio_id, coalesce(sitio_web, CASE WHEN provincia <> 'ASIA' THEN 'https://hallado.example.com.ar/' || ord::STRING END, '') AS url_usada,
  CASE WHEN sitio_web IS NULL THEN 'Sin web / Texto vacío' END AS error, CASE WHEN sitio_web IS NOT NULL THEN coalesce(email, '') END AS emails FROM v WHERE provincia <> 'AFRICA'"""))
def q2(t):
    leads = v_cust(t)
    source = leads.select(F.col("ord").cast("string").alias("row_id"), "nombre", "partido", "sitio_web")
    log = leads.filter("provincia = 'AFRICA'").select(F.col("ord").cast("string").alias("barrio_id"))
    results, pages = extraction_inputs(leads)
    results = results.withColumnRenamed("id", "row_id")
    out = jobs.extraction_job(source, log, results, pages, discover.subpage_priority(t.spark, discover.CONTACT_PAGES_V1))
    return out.select("barrio_id", "url_usada", "error", F.array_join("emails_regex", ",").alias("emails"))


@query("q3_quality_view", SUMMARY_SQL)
def q3(t):
    rows = lead_csv.export_row(typed_leads(t)).withColumn("ord", F.regexp_extract("nombre", r"(\d+)$", 1).cast("long"))
    runs = ledger.run_states(t.spark.createDataFrame([], ledger.RUN_EVENT_SCHEMA))
    return jobs.quality_view(rows, runs)[0].select("vertical", "total", "exact_duplicates", "fuzzy_duplicates", "upload_ready")


@query("q4_production_summary", f"""WITH n AS (SELECT *, {V.sort_tokens('nombre')} AS s, {V.norm('partido')} AS d, {V.dedup_key()} AS k FROM ({NEW_SQL})),
  p AS (SELECT *, {V.sort_tokens('nombre')} AS s, {V.norm('partido')} AS d, {V.dedup_key()} AS k FROM ({PROD_SQL})),
  c AS (SELECT * FROM n WHERE k NOT IN (SELECT k FROM p)), ns AS (SELECT DISTINCT s FROM c), ps AS (SELECT s, min(ord) AS ord FROM p GROUP BY 1),
  sc AS (SELECT ns.s, ps.ord, {V.ratio('ns.s', 'ps.s')} AS score FROM ns JOIN ps ON true),
  best AS (SELECT s, ord, score FROM sc WHERE score >= 85 QUALIFY row_number() OVER (PARTITION BY s ORDER BY score DESC, ord) = 1),
  m AS (SELECT c.ord FROM c JOIN best USING (s) JOIN p ON p.ord = best.ord WHERE c.d = p.d)
  SELECT (SELECT count(*) FROM c) - (SELECT count(*) FROM m) AS total_new, (SELECT count(*) FROM m) AS already_in_production, (SELECT count(*) FROM n) AS total_checked,
    round(((SELECT count(*) FROM c) - (SELECT count(*) FROM m)) * 100.0 / (SELECT count(*) FROM n), 6)::DOUBLE AS pct_new""")
def q4(t):
    rows = production(t).withColumn("vertical", F.lit("hoteles"))
    return jobs.production_job(new_batch(t), rows)[2].select("total_new", "already_in_production", "total_checked", F.round("pct_new", 6).alias("pct_new"))


@query("q5_duplicate_review", f"""WITH k AS (SELECT ord, nombre, partido, {V.sort_tokens('nombre')} AS s, {V.norm('partido')} AS d FROM ({V.PART_SQL}))
  SELECT a.ord AS ord_a, b.ord AS ord_b, a.nombre AS lead_a, b.nombre AS lead_b, 100 AS score, a.partido || ' / ' || b.partido AS partidos,
  CASE WHEN a.d = b.d THEN 'nombre+partido' ELSE 'nombre' END AS match_type FROM k a JOIN k b ON a.s = b.s AND a.ord < b.ord ORDER BY a.ord, b.ord LIMIT 20""")
def q5(t):
    empty = F.lit("")
    rows = v_part(t).select("ord", "nombre", "partido", *[empty.alias(c) for c in (
        "vertical", "email", "telefono", "sitio_web", "localidad", "latitud", "longitud", "email_validado")])
    return jobs.duplicate_review(rows)


@query("q6_extraction_report", f"""SELECT total, llm_ok, email_admin, nuevos, confirmados FROM (SELECT count(*) AS total, count(*) FILTER (WHERE llm) AS llm_ok,
    count(*) FILTER (WHERE coalesce(llm, false) AND {UNIFIED}) AS email_admin FROM ({LOG_SQL})),
  (SELECT count(*) AS nuevos, count(*) FILTER (WHERE confirmado) AS confirmados FROM ({NEW_EMAILS}) WHERE lower(email) NOT IN (SELECT email FROM ({KNOWN_EMAILS})))""")
def q6(t):
    out = jobs.extraction_report(v_log(t), known_emails(t))
    fresh = out["new_emails"].agg(F.count(F.lit(1)).alias("nuevos"), F.count_if("confirmado").alias("confirmados"))
    # Two one-row tables.
    both = out["totals"].withColumn("k", F.lit(1)).join(fresh.withColumn("k", F.lit(1)), "k")
    return both.select("total", "llm_ok", "email_admin", "nuevos", "confirmados")
