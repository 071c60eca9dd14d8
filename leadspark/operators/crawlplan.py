"""Crawl plans as tables: permissions, pacing slots, failure streaks, outcomes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..functions.html import has_content
from ..functions.text import _col, has_http_scheme, url_base, url_domain, url_path
from .discover import CONTACT_PAGES
from .grouping import in_ranges, null_safe_join, streaks

# --- fixed values: outcome texts ---
BAD_URL = "URL inválida"
BLOCKED = "bloqueado por robots.txt"
THIN = "página sin contenido suficiente"
FAILURE_LIMIT = 3


def fetch_error(url, text, allowed) -> Column:
    """Why a page is of no use: bad address, blocked, too little text; NULL when fine."""
    return (
        F.when(~has_http_scheme(url), BAD_URL)
        .when(~F.coalesce(_col(allowed), F.lit(True)), BLOCKED)
        .when(~has_content(text), THIN)
    )


def crawl_permission(urls: DataFrame, rules: DataFrame, key: str = "url") -> DataFrame:
    """``allowed`` per URL: first matching rule of its domain in file order, else allowed.

    Rules are ``(domain, seq, allow, path)``. A path is cut at the lengths that rules of its domain have
    and looked up by (domain, beginning), of which there is one rule at most: the work of an address grows
    with its path, not with the rules.
    """
    wanted = urls.select(key).distinct().select(key, url_domain(key).alias("domain"), F.concat(
        F.when(url_path(key) == "", "/").otherwise(url_path(key)),
        F.regexp_extract(key, r"(\?[^#]*)", 1)).alias("__path"))
    rules = rules.filter(F.col("path").isNotNull()).groupBy("domain", F.col("path").alias("__start")).agg(
        F.min(F.struct("seq", "allow")).alias("__rule"))
    lengths = rules.groupBy("domain").agg(F.collect_set(F.length("__start")).alias("__lengths"))
    fitting = F.filter("__lengths", lambda n: n <= F.length("__path"))
    starts = wanted.join(lengths, "domain").select(
        key, "domain", F.explode(F.transform(fitting, lambda n: F.substring("__path", F.lit(1), n))).alias("__start"))
    hits = starts.join(rules, ["domain", "__start"]).select(key, "__rule.*")
    first = hits.groupBy(key).agg(F.min_by("allow", "seq").alias("__allow"))
    return urls.join(first, key, "left").withColumn("allowed", F.coalesce("__allow", F.lit(True))).drop("__allow")


def pacing_plan(requests: DataFrame, rate: float = 3.0, domain: str = "domain", arrival: str = "arrival",
                order_col: str = "ord") -> DataFrame:
    """Earliest ``slot`` (seconds) per request so that a domain gets one per ``rate`` seconds.

    slot_k = max over i<=k of (arrival_i + (k-i)*rate). Ranges of (domain, arrival, order) are
    solved apart and their maxima carried over, so one domain with a third
    of all requests spreads, also if they arrive at once.
    """
    rows = in_ranges(requests, [domain, arrival, order_col], "__b")
    local = W.partitionBy(domain, "__b").orderBy(arrival, order_col)
    upto = local.rowsBetween(W.unboundedPreceding, W.currentRow)
    rows = rows.withColumn("__rn", F.row_number().over(local) - 1)
    lead = F.col(arrival) - F.col("__rn") * rate
    rows = rows.withColumn("__m", F.max(lead).over(upto))
    buckets = rows.groupBy(domain, "__b").agg(F.count(F.lit(1)).alias("__n"), F.max("__m").alias("__peak"))
    before = W.partitionBy(domain).orderBy("__b").rowsBetween(W.unboundedPreceding, -1)
    buckets = buckets.withColumn("__off", F.coalesce(F.sum("__n").over(before), F.lit(0)))
    buckets = buckets.withColumn("__carry", F.max(F.col("__peak") - F.col("__off") * rate).over(before))
    joined = null_safe_join(rows, buckets.select(domain, "__b", "__off", "__carry"), [domain, "__b"])
    best = F.greatest(F.col("__m") - F.col("__off") * rate, F.col("__carry"))
    slot = best + (F.col("__off") + F.col("__rn")) * rate
    return joined.withColumn("slot", slot).drop("__b", "__rn", "__m", "__off", "__carry")


def failure_streaks(attempts: DataFrame, source: str = "source", order_cols: list[str] | None = None,
                    failed: str = "fail", bucket: Column | None = None, limit: int = FAILURE_LIMIT) -> DataFrame:
    """Failures since the last success per source; the breaker is open from ``limit`` on.

    Without a ``bucket`` the attempts are dealt by ranges of (source, order), so a busy source spreads
    over tasks however close its attempts lie.
    """
    order_cols = order_cols or ["ts"]
    if bucket is None:
        attempts, bucket = in_ranges(attempts, [source, *order_cols], "__slice"), F.col("__slice")
    f = F.coalesce(failed, F.lit(False))
    out = streaks(attempts, [source], order_cols, f, ~f, bucket, "streak")
    return out.withColumn("open", F.col("streak") >= limit).drop("__slice")


def subpage_urls(urls: DataFrame, url: str = "url", paths: list[str] = CONTACT_PAGES) -> DataFrame:
    """Contact sub-page addresses of every URL, without the URL itself."""
    grid = urls.select("*", F.posexplode(F.array(*[F.lit(p) for p in paths])).alias("priority", "path"))
    full = grid.withColumn("sub_url", F.concat(url_base(url), F.col("path")))
    return full.filter(F.regexp_replace("sub_url", "/+$", "") != F.regexp_replace(url, "/+$", ""))


def page_outcomes(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """Pages (``url, text``) with permission and outcome."""
    return crawl_permission(pages, rules).withColumn("error", fetch_error("url", "text", "allowed"))
