"""Batch quality: scores per lead, summaries per batch, comparison with production."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scoring import (
    completeness, has_critical_contact, missing_fields, percent_band, percent_flag, quality_band, quality_score,
)
from ..functions.text import dedup_key, truthy
from ..session import cut_lineage
from .dedup import DEFAULT_THRESHOLD, dedup_vs_production, fuzzy_survivors, with_name_keys
from .grouping import shuffled

UPLOAD_MIN_SCORE, UPLOAD_MIN_ROWS = 40, 5


def score_leads(df: DataFrame) -> DataFrame:
    return df.select(
        "*", quality_score().alias("score"), has_critical_contact().alias("has_critical"),
        missing_fields().alias("missing_fields"), completeness(df.columns).alias("completeness"),
    )


def _share(cond) -> "F.Column":
    return F.coalesce(F.count_if(cond) * 100.0 / F.nullif(F.count(F.lit(1)), F.lit(0)), F.lit(0.0))


def field_metrics(df: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Totals, mean score, percentages and score bands; zeros for an empty table."""
    scored = df.withColumn("score", quality_score())
    return scored.groupBy(*(by or [])).agg(
        F.count(F.lit(1)).alias("total"),
        F.coalesce(F.avg("score"), F.lit(0.0)).alias("avg_score"),
        _share(truthy("email")).alias("pct_with_email"),
        _share(truthy("telefono")).alias("pct_with_phone"),
        _share(truthy("sitio_web")).alias("pct_with_website"),
        _share(F.col("latitud").isNotNull()).alias("pct_with_coords"),
        _share(F.coalesce("email_validado", F.lit(False))).alias("pct_email_validated"),
        F.count_if(F.col("score") >= 70).alias("high_quality"),
        F.count_if((F.col("score") >= 40) & (F.col("score") < 70)).alias("medium_quality"),
        F.count_if(F.col("score") < 40).alias("low_quality"),
    )


def upload_ready(summary: DataFrame) -> DataFrame:
    ready = (F.col("avg_score") >= UPLOAD_MIN_SCORE) & (F.col("total") >= UPLOAD_MIN_ROWS)
    return summary.withColumn("upload_ready", ready)


def high_quality_share(summary: DataFrame) -> DataFrame:
    pct = F.when(F.col("total") > 0, F.col("high_quality") * 100.0 / F.col("total")).otherwise(0.0)
    return summary.withColumn("pct_high_quality", pct)


def summarize_batches(df: DataFrame, by: str = "vertical", order_col: str = "ord",
                      threshold: float = DEFAULT_THRESHOLD) -> DataFrame:
    """Quality summary per batch with exact and fuzzy duplicate counts.

    Fuzzy duplicates are the rows the greedy scan drops after the exact pass.
    """
    # One row per exact key: its first order stands for it, its name and district are those of the key.
    rows = with_name_keys(df.select(by, "nombre", "partido", order_col)).withColumn("__k", dedup_key())
    keys = cut_lineage(rows.groupBy(by, "__k").agg(F.count(F.lit(1)).alias("__n"), F.min(order_col).alias("id"), F.min_by(F.struct("__s", "__d"), order_col).alias("of"))).select("*", "of.*").drop("of")
    exact_n = keys.groupBy(by).agg((F.sum("__n") - F.count(F.lit(1))).alias("exact_duplicates"), F.count(F.lit(1)).alias("__exact"))
    nodes = keys.groupBy(by, "__s", "__d").agg(F.min("id").alias("id"))
    fuzzy_n = nodes.join(shuffled(fuzzy_survivors(nodes, threshold, [by])), "id", "left_semi").groupBy(by).agg(F.count(F.lit(1)).alias("__fuzzy"))
    out = (
        field_metrics(df, [by]).join(exact_n, by).join(fuzzy_n, by)
        .withColumn("fuzzy_duplicates", F.col("__exact") - F.col("__fuzzy")).drop("__exact", "__fuzzy")
    )
    return high_quality_share(upload_ready(out))


def summarize_batch(df: DataFrame, vertical: str, order_col: str = "ord", threshold: float = DEFAULT_THRESHOLD) -> DataFrame:
    """One summary row of one batch; an empty batch gives a row of zeros."""
    empty = field_metrics(df.filter(F.lit(False))).select(
        F.lit(vertical).alias("vertical"), "*", F.lit(0).cast("long").alias("exact_duplicates"),
        F.lit(0).cast("long").alias("fuzzy_duplicates"))
    empty = high_quality_share(upload_ready(empty))
    full = summarize_batches(df.withColumn("vertical", F.lit(vertical)), "vertical", order_col, threshold)
    return full.unionByName(empty.join(full.select("vertical"), "vertical", "left_anti"))


def floor_percent_summary(df: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Field counts with whole percentages (rounded down; empty divides by one)."""
    counts = df.groupBy(*(by or [])).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(truthy("email")).alias("con_email"),
        F.count_if(F.coalesce("email_validado", F.lit(False))).alias("validados"),
        F.count_if(truthy("telefono")).alias("con_tel"),
        F.count_if(F.col("latitud").isNotNull()).alias("geocoded"),
        F.count_if(truthy("sitio_web")).alias("con_sitio"),
    )
    for name in ("con_email", "validados", "con_tel", "geocoded", "con_sitio"):
        counts = counts.withColumn(f"pct_{name}", F.floor(F.col(name) * 100 / F.greatest("total", F.lit(1))))
    return counts


def summary_bands(summary: DataFrame) -> DataFrame:
    """Band labels for the percentages of a summary."""
    return summary.withColumns({
        "band_email": percent_band("pct_with_email"),
        "band_coords": percent_band("pct_with_coords", 20, 50),
        "band_validated": percent_band("pct_email_validated", 10, 30),
        "ok_email": percent_flag("pct_with_email"),
    })


def with_band(df: DataFrame) -> DataFrame:
    return df.withColumn("score", quality_score()).withColumn("band", quality_band("score"))


def compare_with_production(new: DataFrame, production: DataFrame | None, order_col: str = "ord",
                            threshold: float = DEFAULT_THRESHOLD) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(unique rows, matches, one-row summary); no production means everything is new.

    ``production`` has ``nombre, partido`` and ``order_col``.
    """
    if production is None:
        production = new.select("nombre", "partido", order_col).filter(F.lit(False))
    unique, matches = dedup_vs_production(new, production, order_col, threshold)
    return unique, matches, comparison_summary(new, unique, matches)


def comparison_summary(new: DataFrame, unique: DataFrame, matches: DataFrame) -> DataFrame:
    def n(df: DataFrame, tag: str) -> DataFrame:
        return df.select(F.lit(tag).alias("t"))

    tags = n(new, "c").unionByName(n(unique, "u")).unionByName(n(matches, "m"))
    out = tags.agg(
        F.count_if(F.col("t") == "u").alias("total_new"), F.count_if(F.col("t") == "m").alias("already_in_production"),
        F.count_if(F.col("t") == "c").alias("total_checked"),
    )
    pct = F.when(F.col("total_checked") > 0, F.col("total_new") * 100.0 / F.col("total_checked")).otherwise(0.0)
    return out.withColumn("pct_new", pct)
