"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "contact_quality_by_language",
    "x1_normalize_name",
    "x5_emails",
    "x18_html_text",
    "x25_redact_text",
    "x29_strict_metadata",
    "x31_extraction_record",
    "p1_export_row",
    "w1_dedup_exact",
    "w3_dedup_by_name",
    "w2_dedup_fuzzy",
    "w2_dedup_fuzzy_titles",
    "j3_page_titles",
    "j4_vs_production",
    "a3_summarize_batches",
    "a6_pending_leads",
    "a8_chunk_stats",
    "w12_failure_streaks",
    "w13_pacing_plan",
    "q1_enrichment_run",
    "q3_quality_view",
    "q4_production_summary",
    "q5_duplicate_review",
    "x3_token_sort_ratio",
    "st1_incremental",
    "st2_streaming_streaks",
]


def main() -> None:
    from leadspark.catalog import QUERIES
    from leadspark.session import build_session

    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus,
        "spark.ui.enabled": "false",
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
        "spark.checkpoint.dir": os.environ.get("BENCH_CHECKPOINT_DIR") or tempfile.mkdtemp(prefix="spark-"),
    })
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{folder}/nation.parquet").count()  # session start is not part of the figures
    times = {}
    for name in names:
        started = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - started, 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    sf = os.path.basename(folder.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
