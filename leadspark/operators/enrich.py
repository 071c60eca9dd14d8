"""From candidates and pages to enriched leads: lookups, merges, run metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.extract import (
    ALL_FAILED_ERROR, EMPTY_TEXT_ERROR, EXTRACTION_BUDGET, NO_PAGE_ERROR, REGEX_ONLY, clean_contact,
    contact_reject_reason, cut_text, emails_in, is_blank, phones_in, union_emails,
)
from ..functions.html import has_content
from ..functions.replies import lead_from_reply, parse_reply
from ..functions.scoring import is_enriched
from ..functions.text import blank_to_null, geocode_query, truthy
from ..schemas import COMMERCIAL_STATES, CONTACT_SCHEMA, DEFAULT_COUNTRY, LEAD_SCHEMA
from .grouping import first_per_group, first_row_of_key, frequent_lookup, left_lookup

# --- fixed values: verification states that count as valid ---
VALID_STATUSES = ["valid", "accept_all"]
_CONTACTS = CONTACT_SCHEMA.simpleString()


def resume(pages: DataFrame, done: DataFrame, key: str = "id") -> DataFrame:
    """Rows whose id is not in the result log yet."""
    return pages.join(done.select(key).distinct(), key, "left_anti")


def page_text_by_url(candidates: DataFrame, page_text: DataFrame, order_col: str = "page_id", url: str = "sitio_web") -> DataFrame:
    """Candidates with the ``text`` of their site: the last page per URL with enough text."""
    usable = page_text.filter(has_content("text"))
    latest = first_row_of_key(usable.select("url", "text", order_col), ["url"], order_col, last=True)
    lookup = latest.select(F.col("url").alias(url), "text")
    return left_lookup(candidates, lookup, [url])


def minimal_lead(vertical: Column, enriched_at: Column, prefix: str = "") -> Column:
    """Lead struct of a candidate without page or with a refused reply."""
    values = {
        "nombre": F.col(f"{prefix}nombre"), "vertical": vertical, "estado_comercial": F.lit(COMMERCIAL_STATES[0]),
        "email_validado": F.lit(False), "sitio_web": F.col(f"{prefix}sitio_web"),
        "fuente_contacto": F.col(f"{prefix}fuente"), "fecha_enriquecimiento": enriched_at,
        "partido": F.col(f"{prefix}partido"), "pais": F.lit(DEFAULT_COUNTRY), "metadata": F.lit("{}"),
    }
    return F.struct(*[values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in LEAD_SCHEMA.fields])


def fill_missing(lead: Column, **candidates: Column) -> Column:
    """Empty lead fields taken from the candidate."""
    for name, value in candidates.items():
        lead = lead.withField(name, F.coalesce(blank_to_null(lead[name]), value))
    return lead


def leads_from_answers(candidates: DataFrame, vertical: str, enriched_at: Column, reply: str = "reply",
                       keep: tuple = ("ord",)) -> DataFrame:
    """Candidates with page text and model reply to leads.

    No text, no reply or a refused reply gives the minimal lead; otherwise
    empty district and site come from the candidate.
    """
    v = F.lit(vertical)
    df = candidates.withColumn("__v", parse_reply(reply))
    extracted = F.when(
        truthy("text") & truthy(reply),
        lead_from_reply(F.col("__v"), v, F.col("sitio_web"), enriched_at, [vertical]),
    )
    df = df.withColumn("__lead", extracted)
    lead = F.when(F.col("__lead").isNull(), minimal_lead(v, enriched_at)).otherwise(
        fill_missing(F.col("__lead"), partido=F.col("partido"), sitio_web=F.col("sitio_web")))
    # A generator: later joins and filters on a lead's columns do not repeat the reading of its reply.
    return df.select(*keep, F.col("__lead").isNotNull().alias("extracted"), F.inline(F.array(lead)))


def apply_verifications(leads: DataFrame, verifications: DataFrame) -> DataFrame:
    """Validity and score per e-mail; lookups with an error leave the lead alone.

    Adds ``verified`` (a lookup was made) and ``verified_ok`` (without error).
    """
    one = first_per_group(verifications.select("email", "status", "score", "error"), ["email"], ["status", "score"])
    looked = left_lookup(leads, one.select(
        "email", F.col("status").alias("__status"), F.col("score").alias("__score"), F.col("error").alias("__error"),
        F.lit(True).alias("__hit")), ["email"])
    ok = F.coalesce(F.col("__hit"), F.lit(False)) & F.col("__error").isNull()
    return looked.withColumns({
        "email_validado": F.when(ok, F.coalesce(F.col("__status").isin(*VALID_STATUSES), F.lit(False))).otherwise(F.col("email_validado")),
        "email_score": F.when(ok, F.col("__score")).otherwise(F.col("email_score")),
        "verified": truthy("email"), "verified_ok": ok,
    }).drop("__status", "__score", "__error", "__hit")


def with_geo_query(leads: DataFrame) -> DataFrame:
    """``geo_query`` of a lead: province defaults to Buenos Aires."""
    province = F.when(truthy("provincia"), F.col("provincia")).otherwise("Buenos Aires")
    return leads.withColumn("geo_query", geocode_query("direccion", "localidad", "partido", province))


def geocode_lookup(queries: DataFrame, primary: DataFrame, secondary: DataFrame | None) -> DataFrame:
    """(query, lat, lon, provider) of distinct queries: the second gazetteer where the first has no hit."""
    distinct = queries.select("query").distinct()

    def one(g: DataFrame, tag: str) -> DataFrame:
        found = g.filter(F.col("lat").isNotNull() & F.col("lon").isNotNull())
        return first_per_group(found.select("query", "lat", "lon", "provider"), ["query"], ["provider", "lat", "lon"]).select(
            "query", F.struct("lat", "lon", "provider").alias(tag))

    out = distinct.join(one(primary, "g1"), "query", "left")
    if secondary is None:
        return out.filter("g1 is not null").select("query", "g1.*")
    out = out.join(one(secondary, "g2"), "query", "left").withColumn("g", F.coalesce("g1", "g2"))
    return out.filter("g is not null").select("query", "g.*")


def apply_geocodes(leads: DataFrame, primary: DataFrame, secondary: DataFrame | None = None) -> DataFrame:
    """Coordinates by query text; leads without a hit keep theirs. Adds ``geo_found``."""
    asked = with_geo_query(leads)
    hits = geocode_lookup(asked.select(F.col("geo_query").alias("query")), primary, secondary).select(
        F.col("query").alias("geo_query"), F.col("lat").alias("__lat"), F.col("lon").alias("__lon"))
    # Leads without an address share one query text.
    return frequent_lookup(asked, hits, "geo_query").withColumns({
        "latitud": F.coalesce("__lat", "latitud"), "longitud": F.coalesce("__lon", "longitud"),
        "geo_found": F.col("__lat").isNotNull(),
    }).drop("__lat", "__lon", "geo_query")


def metric_columns() -> list[Column]:
    """Counters of an enrichment result, for ``agg`` or for ``observe`` while writing."""
    return [
        F.count(F.lit(1)).alias("discovered"), F.count_if(F.col("had_url")).alias("fetched"),
        F.count_if(F.col("had_text")).alias("fetched_ok"), F.count_if(F.col("enriched")).alias("enriched"),
        F.count_if(F.col("verified")).alias("validated"), F.count_if(F.col("verified_ok")).alias("verified_ok"),
        F.count_if(F.col("geo_found")).alias("geocoded"), F.count(F.lit(1)).alias("saved"),
        F.count_if(F.col("had_url") & ~F.col("had_text")).alias("errors"),
    ]


def run_metrics(leads: DataFrame) -> DataFrame:
    """One row of counters of an enrichment result."""
    return leads.agg(*metric_columns())


def mark_enriched(leads: DataFrame) -> DataFrame:
    return leads.withColumn("enriched", is_enriched())


# ---------------------------------------------------------------- extraction records (v1)


def extraction_records(pages: DataFrame, answers: DataFrame | None = None, at: Column | None = None,
                       keep: tuple[str, ...] = ()) -> DataFrame:
    """Extraction record per page ``(id, nombre, url, text)``.

    ``answers`` ``(id, provider, contactos, emails_generales, telefono_general, tiene_datos_contacto)``
    is what the answer waterfall gave; pages without one are regex only.
    Contacts that break the rules make the whole answer a failure. Addresses, phones and emptiness
    are those of the whole text; ``keep`` names page columns to carry along.
    """
    none = F.lit(None)
    if answers is None:
        df = pages.select("*", none.cast("string").alias("provider"), F.array().cast(f"array<{_CONTACTS}>").alias("contactos"),
                          F.array().cast("array<string>").alias("emails_generales"), none.cast("string").alias("telefono_general"),
                          none.cast("boolean").alias("tiene_datos_contacto"))
    else:
        valid = answers.filter(~F.exists(F.coalesce("contactos", F.array().cast(f"array<{_CONTACTS}>")),
                                         lambda c: contact_reject_reason(c).isNotNull()))
        df = left_lookup(pages, valid.withColumn("contactos", F.transform("contactos", clean_contact)), ["id"])
    blank = is_blank("text")
    answered = ~blank & F.col("provider").isNotNull()
    empty = F.array().cast("array<string>")
    return df.select(
        F.col("id").cast("string").alias("barrio_id"), F.col("nombre").alias("barrio_nombre"), F.col("url").alias("url_usada"),
        F.when(answered, F.coalesce("contactos", F.array().cast(f"array<{_CONTACTS}>"))).otherwise(F.array().cast(f"array<{_CONTACTS}>")).alias("contactos_llm"),
        F.when(answered, F.coalesce("emails_generales", empty)).otherwise(empty).alias("emails_generales_llm"),
        F.when(answered, F.col("telefono_general")).alias("telefono_general_llm"),
        emails_in("text").alias("emails_regex"), phones_in("text").alias("phones_regex"),
        F.when(answered, F.col("provider")).otherwise(REGEX_ONLY).alias("modelo_usado"),
        F.when(blank, EMPTY_TEXT_ERROR).when(~answered, F.lit(ALL_FAILED_ERROR) if answers is not None else none).alias("error"),
        F.date_format(F.current_timestamp() if at is None else at, "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"),
        F.when(answered, F.col("tiene_datos_contacto")).alias("tiene_datos_contacto_llm"),
        F.when(answered, union_emails(emails_in("text"), "contactos", "emails_generales")).alias("todos_los_emails_unificados"),
        *keep,
    )


def mark_missing_pages(records: DataFrame, text_present: Column) -> DataFrame:
    """Records of pages without any text: only id, name, URL and the error remain."""
    no = ~text_present
    keep = {"barrio_id", "barrio_nombre", "url_usada"}
    out = records
    for f in records.schema.fields:
        if f.name in keep:
            continue
        value = F.lit(NO_PAGE_ERROR) if f.name == "error" else (
            F.array().cast("array<string>") if f.name == "todos_los_emails_unificados" else F.lit(None).cast(f.dataType))
        out = out.withColumn(f.name, F.when(no, value).otherwise(F.col(f.name)))
    return out
