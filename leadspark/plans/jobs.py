"""Whole jobs: enrichment run, resumable extraction, quality view, comparisons, reports."""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.html import FETCH_DROP, html_text
from ..functions.text import join_texts, truthy, url_base
from ..operators import dedup, quality, report
from ..operators.discover import pick_contact_page, pick_search_result, take_quota
from ..operators.enrich import (
    apply_geocodes, apply_verifications, extraction_records, leads_from_answers, mark_enriched, mark_missing_pages, metric_columns,
    page_text_by_url, resume, run_metrics,
)
from ..operators.grouping import left_lookup
from ..sources.ledger import Ledger
from ..sources.lead_csv import minimal_lead, production_lead
from ..sources.lots import commit_lot, stage_lot


@dataclass
class RunOptions:
    vertical: str
    limit: int | None = None
    skip_geocoding: bool = False
    skip_email_validation: bool = False
    dry_run: bool = False


def pages_to_text(pages: DataFrame, drop: list[str] = FETCH_DROP) -> DataFrame:
    """Raw pages (``page_id, url, html``) to page texts."""
    return pages.withColumn("text", html_text("html", drop)).drop("html")


def enrichment_plan(candidates: DataFrame, page_text: DataFrame, answers: DataFrame, verifications: DataFrame | None,
                    gazetteer: DataFrame | None, options: RunOptions, gazetteer_2: DataFrame | None = None,
                    enriched_at: Column | None = None) -> DataFrame:
    """One lazy plan: candidates, page text, answers, verification, geocodes -> leads.

    ``answers`` is ``(url, reply)``. Carries the flags that ``run_metrics`` counts.
    """
    at = F.current_timestamp() if enriched_at is None else enriched_at
    chosen = take_quota(candidates, options.limit, ["ord"]) if options.limit else candidates
    with_text = page_text_by_url(chosen, page_text)
    with_reply = left_lookup(with_text, answers.select(F.col("url").alias("sitio_web"), "reply"), ["sitio_web"])
    flagged = with_reply.withColumns({"had_url": truthy("sitio_web"), "had_text": truthy("text")})
    leads = mark_enriched(leads_from_answers(flagged, options.vertical, at, keep=("ord", "had_url", "had_text")))
    if verifications is None or options.skip_email_validation:
        leads = leads.withColumns({"verified": F.lit(False), "verified_ok": F.lit(False)})
    else:
        leads = apply_verifications(leads, verifications)
    if gazetteer is None or options.skip_geocoding:
        return leads.withColumn("geo_found", F.lit(False))
    return apply_geocodes(leads, gazetteer, gazetteer_2)


def run_enrichment(ledger: Ledger, lots_root: str, options: RunOptions, **inputs: DataFrame) -> dict:
    """Run the plan, save the lot, keep start and finish in the ledger; returns the counters.

    The counters are observed while the lot is written, so the plan runs once.
    """
    run_id = str(uuid.uuid4())
    ledger.start_run(run_id, options.vertical, datetime.now(timezone.utc))
    counters, failure = {}, None
    try:
        leads = enrichment_plan(options=options, **inputs)
        flags = ["ord", "had_url", "had_text", "extracted", "enriched", "verified", "verified_ok", "geo_found"]
        if options.dry_run:
            counters = {**run_metrics(leads).first().asDict(), "saved": 0, "lote_id": None}
        else:
            seen, lot_id = Observation(), str(uuid.uuid4())
            attempt = stage_lot(leads.observe(seen, *metric_columns()).drop(*flags), lots_root, options.vertical, lot_id)
            counters = {**seen.get, "lote_id": None}
            if counters["discovered"]:
                done = commit_lot(ledger.spark, lots_root, options.vertical, lot_id, attempt, counters["saved"])
                ledger.create_lot(lot_id, options.vertical, done.ts, done.filas)
                counters["lote_id"] = lot_id
    except Exception as error:  # recorded in the ledger, then raised
        failure = error
    ledger.finish_run(
        run_id, datetime.now(timezone.utc), counters.get("discovered", 0), counters.get("fetched", 0),
        counters.get("enriched", 0), counters.get("validated", 0), counters.get("errors", 0) + (failure is not None))
    if failure:
        raise failure
    return {"run_id": run_id, **counters}


def extraction_job(source: DataFrame, log: DataFrame | None, search_results: DataFrame, pages: DataFrame,
                   priority: DataFrame, answers: DataFrame | None = None, at: Column | None = None) -> DataFrame:
    """Records for source rows not in the log yet.

    ``source`` is ``(row_id, nombre, partido, sitio_web)``, ``search_results``
    ``(row_id, query_no, rank, url)``, ``pages`` ``(url, path, site, text)``.
    """
    todo = source if log is None else resume(source, log.select(F.col("barrio_id").alias("row_id")), "row_id")
    found = pick_search_result(search_results, ["row_id"]).select("row_id", F.col("url").alias("__found"))
    todo = todo.join(found, "row_id", "left").withColumn(
        "url", F.coalesce(F.when(truthy(F.trim("sitio_web")), F.col("sitio_web")), F.col("__found"), F.lit(""))).drop("__found")
    main = pages.select("url", F.col("text").alias("main_text"))
    sites = todo.select(url_base("url").alias("site"), F.col("url").alias("home_url")).filter("site <> ''").distinct()
    subs = pick_contact_page(pages.join(sites, "site"), priority, 1).select("site", F.col("text").alias("sub_text"))
    looked = left_lookup(todo.withColumn("url", F.nullif("url", F.lit(""))), main, ["url"]).withColumn(
        "site", F.nullif(url_base("url"), F.lit("")))
    looked = left_lookup(looked, subs, ["site"])
    text = join_texts("main_text", "sub_text")
    ready = looked.select(F.col("row_id").alias("id"), "nombre", F.coalesce("url", F.lit("")).alias("url"), text.alias("text"))
    records = extraction_records(ready.withColumn("__has", F.col("text") != ""), answers, at, keep=("__has",))
    return mark_missing_pages(records, F.col("__has")).drop("__has")


def quality_view(rows: DataFrame, runs: DataFrame, order_col: str = "ord") -> tuple[DataFrame, DataFrame]:
    """(quality summary per vertical, latest run per vertical) of consolidated export rows."""
    from ..sources.ledger import latest_runs

    return quality.summarize_batches(minimal_lead(rows), "vertical", order_col), latest_runs(runs)


def production_job(new: DataFrame, production_rows: DataFrame | None, order_col: str = "ord", threshold: float = 85):
    """New leads against the raw production export."""
    prod = None if production_rows is None else production_lead(production_rows)
    return quality.compare_with_production(new, prod, order_col, threshold)


def duplicate_review(rows: DataFrame, order_col: str = "ord", k: int = 20) -> DataFrame:
    """The k best duplicate candidates of an export."""
    top = dedup.top_matches(minimal_lead(rows).select(order_col, "nombre", "partido"), k, order_col)
    return top.select(
        "ord_a", "ord_b", F.col("nombre_a").alias("lead_a"), F.col("nombre_b").alias("lead_b"),
        F.round("score", 0).cast("int").alias("score"),
        F.concat(F.when(truthy("partido_a"), F.col("partido_a")).otherwise("—"), F.lit(" / "),
                 F.when(truthy("partido_b"), F.col("partido_b")).otherwise("—")).alias("partidos"), "match_type")


def extraction_report(log: DataFrame, known: DataFrame, order_col: str = "ord") -> dict[str, DataFrame]:
    fresh = report.new_emails(log, known)
    return {
        "totals": report.run_report(log), "span": report.time_span(log, order_col), "new_emails": fresh,
        "new_email_counts": report.new_email_counts(fresh), "details": report.contact_details(log),
    }


