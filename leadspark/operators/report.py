"""Reports over the extraction log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.extract import NO_PAGE_ERROR, named_contacts
from ..functions.text import truthy
from .grouping import global_row_number


def _has(array: str) -> Column:
    return F.coalesce(F.size(array), F.lit(0)) > 0


def _answered() -> Column:
    return F.coalesce("tiene_datos_contacto_llm", F.lit(False))


def log_flags() -> dict[str, Column]:
    """The report predicates of one log record."""
    return {
        "sin_web": F.coalesce("error", F.lit("")) == NO_PAGE_ERROR,
        "con_url": F.trim(F.coalesce("url_usada", F.lit(""))) != "",
        "llm_ok": _answered(),
        "email_admin": _answered() & _has("todos_los_emails_unificados"),
        "solo_regex": ~_answered() & _has("todos_los_emails_unificados"),
        "solo_regex_real": ~_answered() & (_has("todos_los_emails_unificados") | _has("emails_regex")),
    }


def run_report(log: DataFrame) -> DataFrame:
    """Counts and whole percentages (rounded down; 0 for an empty log)."""
    flags = log_flags()
    out = log.agg(F.count(F.lit(1)).alias("total"), *[F.count_if(c).alias(n) for n, c in flags.items()])
    for name in ("sin_web", "con_url"):
        out = out.withColumn(f"pct_{name}", F.when(F.col("total") > 0, F.floor(F.col(name) * 100 / F.col("total"))).otherwise(0))
    return out


def time_span(log: DataFrame, order_col: str = "ord", ts: str = "timestamp") -> DataFrame:
    """First and last timestamp in log order."""
    some = log.filter(truthy(ts))
    return some.agg(F.min_by(ts, order_col).alias("primero"), F.max_by(ts, order_col).alias("ultimo"))


def new_emails(log: DataFrame, known: DataFrame) -> DataFrame:
    """Result addresses that the source table does not have (case-blind; repeats stay)."""
    found = log.select("barrio_nombre", "modelo_usado", _answered().alias("confirmado"),
                       F.explode("todos_los_emails_unificados").alias("email"))
    have = known.filter(F.col("email").isNotNull()).select(F.lower("email").alias("__e")).distinct()
    return found.withColumn("__e", F.lower("email")).join(have, "__e", "left_anti").drop("__e")


def new_email_counts(fresh: DataFrame) -> DataFrame:
    """Confirmed and unconfirmed new addresses: rows, distinct addresses."""
    return fresh.groupBy("confirmado").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("email").alias("distintos"))


def contact_details(log: DataFrame) -> DataFrame:
    """One row per record with any contact data."""
    people = F.array_join(F.transform(
        named_contacts("contactos_llm"),
        lambda c: F.concat(c["nombre_completo"], F.lit(" ("), F.coalesce(c["cargo"], F.lit("")), F.lit(")"))), "; ")
    keep = [c for c in ("ord",) if c in log.columns]
    return log.filter(_answered() | _has("todos_los_emails_unificados")).select(
        *keep, "barrio_nombre", F.coalesce("url_usada", F.lit("")).alias("url"), people.alias("personas"),
        F.array_join(F.coalesce("emails_generales_llm", F.array().cast("array<string>")), ", ").alias("emails_generales"),
        F.col("telefono_general_llm").alias("telefono"),
        F.when(~_answered(), F.array_join("emails_regex", ", ")).otherwise("").alias("regex_only"),
    )


def with_chunks(df: DataFrame, order_col: str = "ord", rows: int = 100) -> DataFrame:
    """0-based chunk number of ``rows`` consecutive rows each."""
    numbered = global_row_number(df, order_col, "__n")
    return numbered.withColumn("chunk_id", F.floor((F.col("__n") - 1) / rows)).drop("__n")


def record_outcome() -> Column:
    useful = _answered() | _has("emails_regex") | _has("phones_regex")
    return F.when(truthy("error"), "error").when(useful, "exito").otherwise("vacio")


def chunk_stats(log: DataFrame, chunk: str = "chunk_id") -> DataFrame:
    """Outcomes per chunk; ``diagnostico`` marks chunks with over 40 % empty records."""
    out = log.withColumn("__o", record_outcome()).groupBy(chunk).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("__o") == "exito").alias("exitos"),
        F.count_if(F.col("__o") == "vacio").alias("vacios"), F.count_if(F.col("__o") == "error").alias("errores"))
    return out.withColumn("diagnostico", F.when(F.col("vacios") > F.col("n") * 0.4, "muchos_vacios").when(
        F.col("vacios") > 0, "algunos_vacios").otherwise("ok"))


def ranked(df: DataFrame, order_col: str, name: str = "n") -> DataFrame:
    """1-based display position."""
    return global_row_number(df, order_col, name)
