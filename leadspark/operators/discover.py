"""Candidates from listing pages, registries and search results."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.html import cards, first_class_text, first_element_text, first_href, links, table_rows
from ..functions.text import (
    _col, absolute_url, blank_to_null, domain_name_text, prefers_ar, split_location, truthy, url_domain, url_netloc,
)
from .dedup import dedup_by_name
from .grouping import first_per_group, streaks

# --- fixed values: domains that are never an organisation's own site ---
SEARCH_BANNED = [
    "facebook.com", "instagram.com", "zonaprop.com.ar", "argenprop.com",
    "mercadolibre.com.ar", "twitter.com", "x.com", "linkedin.com",
    "tiktok.com", "youtube.com", "pinterest.com", "google.com",
    "properati.com.ar", "remax.com.ar", "mudafy.com.ar", "foursquare.com",
    "tripadvisor.com", "navent.com", "infocasas.com", "lamudi.com",
    "bnpropiedades.com", "sidomus.com", "roomix.ai", "urbannext.net",
    "todosnegocios.com", "eldia.com", "infobae.com", "clarin.com",
    "lanacion.com.ar", "wikipedia.org", "wikidata.org", "yellowpages",
    "grupobaigun.com", "realestate.com",
]
SECTOR_BANNED = [
    "zonaprop.com.ar", "argenprop.com", "mercadolibre.com.ar",
    "infocasas.com.uy", "properati.com.ar", "remax.com.ar",
    "navent.com", "clasificados.clarin.com", "olx.com.ar",
    "facebook.com", "instagram.com", "twitter.com", "x.com",
    "linkedin.com", "youtube.com", "tiktok.com", "pinterest.com",
    "mx.pinterest.com",
    "wikipedia.org", "wikidata.org", "wikimedia.org",
    "slideserve.com", "slideshare.net", "scribd.com", "issuu.com",
    "academia.edu", "researchgate.net",
    "paginas-amarillas.com.ar", "guialocal.com.ar", "yell.com",
    "yelp.com", "tripadvisor.com",
]
# --- fixed values: contact sub-pages in order of preference ---
CONTACT_PAGES = [
    "/contacto", "/administracion", "/contactenos", "/contact",
    "/contacto/", "/administracion/", "/quienes-somos",
    "/la-administracion", "/consorcio", "/propietarios",
    "/contacto.html", "/administracion.html",
]
CONTACT_PAGES_V1 = [
    "/contacto", "/administracion", "/contactenos", "/contact",
    "/contacto/", "/administracion/", "/contactenos/", "/contact/",
    "/contacto.html", "/administracion.html", "/quienes-somos",
    "/la-administracion", "/consorcio", "/propietarios",
]
# --- fixed values: labels of registry header rows ---
REGISTRY_HEADERS = ["nombre", "prestador", "establecimiento"]
MEMBER_HEADERS = ["empresa"]
DISTRIBUTOR_WORDS = ["DROGUERIA", "DROGUER", "DISTRIBUIDORA FARMACEUT"]
# --- fixed values: search texts ---
SITE_QUERIES = [
    '"{nombre}" administracion contacto site:com.ar',
    '"{nombre}" {partido} administracion email contacto',
    '"{nombre}" barrio privado intendencia email Argentina',
    '"{nombre}" barrio cerrado contacto',
]
SECTOR_QUERIES = [
    'site:.ar "{name}" "seguridad" "contacto"',
    '"{name}" {country} "sistema de seguridad" "contacto"',
    'inurl:{sector} site:.ar "administracion" OR "contacto"',
]
SECTOR_TERM_QUERY = '"{name}" "{term}" {country} "seguridad"'
GENERIC_QUERY = 'site:.ar "{name}" "seguridad" "contacto"'
VERTICAL_QUERIES = {
    "universidades": [
        'site:.ar "universidad privada" "seguridad" "contacto"',
        '"universidad" Argentina "sistema de seguridad" OR "CCTV" site:.ar',
    ],
    "entes_estatales": [
        'site:gob.ar "seguridad" "contacto" "infraestructura"',
        '"organismo estatal" Argentina "seguridad electronica" "contacto"',
    ],
    "consulados": [
        '"consulado" Argentina "seguridad" "contacto" site:.ar OR site:.com',
        '"consulado general" Buenos Aires "seguridad" "contacto"',
    ],
    "embajadas": [
        '"embajada" Buenos Aires "seguridad" "contacto"',
        '"embajada" Argentina "sistema de seguridad" "contacto"',
    ],
    "depositos_fiscales": [
        'site:.ar "deposito fiscal" "seguridad" "contacto"',
        '"zona franca" OR "deposito fiscal" Argentina "seguridad electronica"',
    ],
    "empresas": [
        'site:.ar "empresa" "seguridad electronica" "contacto" Argentina',
        '"empresa manufacturera" Argentina "CCTV" OR "camara de seguridad" "contacto"',
    ],
    "plantas_industriales": [
        'site:.ar "planta industrial" "seguridad" "contacto"',
        '"planta de produccion" Argentina "sistema de seguridad" "contacto"',
    ],
    "terminales_portuarias": [
        'site:.ar "terminal portuaria" "seguridad" "contacto"',
        '"puerto" Argentina "seguridad" "terminal" "contacto" site:.ar',
    ],
    "aeronauticas": [
        'site:.ar "empresa aeronautica" "seguridad" "contacto"',
        '"aviacion" OR "aeronautica" Argentina "seguridad" "hangar" "contacto"',
    ],
}


# ---------------------------------------------------------------- filters


def has_website(df: DataFrame, col: str = "sitio_web") -> DataFrame:
    return df.filter(truthy(col))


def not_social(df: DataFrame, col: str = "sitio_web", word: str = "facebook") -> DataFrame:
    return df.filter(~F.lower(F.coalesce(col, F.lit(""))).contains(word))


def url_allowed(url, banned: list[str] = SEARCH_BANNED) -> Column:
    """No banned text anywhere in the network location."""
    netloc = url_netloc(url)
    hit = F.lit(False)
    for text in banned:
        hit = hit | netloc.contains(text)
    return ~hit


def ban_table(spark: SparkSession, *lists: list[str]) -> DataFrame:
    """Union of ban lists as a table of distinct domains."""
    return spark.createDataFrame([(d,) for lst in lists for d in lst], "domain string").distinct()


def drop_banned_domains(df: DataFrame, banned: DataFrame | list[str], col: str = "sitio_web") -> DataFrame:
    """Rows whose exact domain is not banned (lists inline, tables by anti-join)."""
    if isinstance(banned, list):
        return df.filter(~url_domain(col).isin(*banned))
    keyed = df.withColumn("__domain", url_domain(col))
    return keyed.join(banned.withColumnRenamed("domain", "__domain"), "__domain", "left_anti").drop("__domain")


def name_ok(nombre="nombre", longer_than: int = 3, containing: str | None = None) -> Column:
    n = F.coalesce(_col(nombre), F.lit(""))
    cond = F.length(n) > longer_than
    return cond & F.lower(n).contains(containing) if containing else cond


def not_header(nombre="nombre", labels: list[str] = REGISTRY_HEADERS) -> Column:
    return ~F.lower(_col(nombre)).isin(*labels)


def is_distributor(*texts) -> Column:
    words = "|".join(DISTRIBUTOR_WORDS)
    flag = F.lit(False)
    for t in texts:
        flag = flag | F.upper(F.coalesce(_col(t), F.lit(""))).rlike(words)
    return flag


# ---------------------------------------------------------------- parsers: pages -> candidates


def _candidates(df: DataFrame, keep: list[str], fuente: str, **cols: Column) -> DataFrame:
    null = F.lit(None).cast("string")
    raw = cols.pop("raw_data", F.lit(None).cast("map<string,string>"))
    extra = {k: v for k, v in cols.items() if k not in ("nombre", "sitio_web", "partido", "provincia", "localidad")}
    return df.select(
        *keep,
        *[cols.get(c, null).alias(c) for c in ("nombre", "sitio_web", "partido", "provincia", "localidad")],
        F.lit(fuente).alias("fuente"), raw.alias("raw_data"), *[v.alias(k) for k, v in extra.items()],
    )


def parse_cards(pages: DataFrame, fuente: str = "cards", block: str = "article", title_tags: tuple = ("h2", "h3"),
                title_words: tuple = ("title", "name"), place_words: tuple = ("location", "address", "partido"),
                longer_than: int = 2) -> DataFrame:
    """Listing cards: title, location text split into district and province, web link."""
    keep = [c for c in pages.columns if c != "html"]
    one = pages.select(*keep, F.posexplode(cards("html", block)).alias("pos", "card"))
    title = first_element_text("card", list(title_tags))
    title = F.when(title != "", title).otherwise(first_class_text("card", list(title_words))) if title_words else title
    one = one.select(
        *keep, "pos", title.alias("nombre"),
        (first_class_text("card", list(place_words)) if place_words else F.lit("")).alias("place"),
        first_href("card").alias("href"),
    ).filter(name_ok("nombre", longer_than))
    where = split_location("place")
    return _candidates(
        one, [*keep, "pos"], fuente, nombre=F.col("nombre"),
        sitio_web=F.when(F.col("href").startswith("http"), F.col("href")),
        partido=where["partido"], provincia=where["provincia"],
        raw_data=F.create_map(F.lit("location_raw"), F.col("place")),
    )


def parse_table(pages: DataFrame, fuente: str, layout: dict[str, int], header_cells: bool = True, min_cells: int = 2,
                headers: list[str] | None = None, longer_than: int = 3, base_url: str | None = None,
                default_province: str | None = None) -> DataFrame:
    """Registry tables: ``layout`` maps a candidate column to its cell (0-based, -1 the last).

    A ``tipo`` entry is read for the distributor flag, which marks rows and
    rejects none.
    """
    keep = [c for c in pages.columns if c != "html"]
    rows = pages.select(*keep, F.posexplode(table_rows("html", header_cells)).alias("pos", "row"))
    rows = rows.filter(F.size("row.cells") >= min_cells)

    def cell(i: int) -> Column:
        at = F.lit(i) if i < 0 else F.lit(i + 1)
        return F.coalesce(F.try_element_at("row.cells", at), F.lit(""))

    named = rows.withColumn("nombre", cell(layout["nombre"])).filter(name_ok("nombre", longer_than))
    if headers:
        named = named.filter(not_header("nombre", headers))
    cols = {k: blank_to_null(cell(i)) for k, i in layout.items() if k not in ("nombre", "tipo")}
    if default_province:
        cols["provincia"] = F.coalesce(cols.get("provincia", F.lit(None)), F.lit(default_province))
    if base_url is not None:
        cols["sitio_web"] = blank_to_null(absolute_url("row.link", base_url))
    else:
        cols["sitio_web"] = F.when(F.col("row.link").startswith("http"), F.col("row.link"))
    if "tipo" in layout:
        cols["es_distribuidor"] = is_distributor(cell(layout["tipo"]), "nombre")
    return _candidates(named, [*keep, "pos"], fuente, nombre=F.col("nombre"), **cols)


def parse_links(pages: DataFrame, fuente: str, containing: str | None = None, longer_than: int = 5,
                base_url: str = "", default_province: str | None = None) -> DataFrame:
    """Anchors with a long enough text (optionally with a word in it)."""
    keep = [c for c in pages.columns if c != "html"]
    one = pages.select(*keep, F.posexplode(links("html")).alias("pos", "link"))
    one = one.filter(name_ok("link.text", longer_than, containing))
    return _candidates(
        one, [*keep, "pos"], fuente, nombre=F.col("link.text"),
        sitio_web=blank_to_null(absolute_url("link.href", base_url)), provincia=F.lit(default_province).cast("string"),
    )


def with_fallback(primary: DataFrame, secondary: DataFrame, group: list[str]) -> DataFrame:
    """Rows of the second parser only for groups the first gave nothing for."""
    return primary.unionByName(secondary.join(primary.select(*group).distinct(), group, "left_anti"), allowMissingColumns=True)


Parser = Callable[[DataFrame], DataFrame]
_REGISTRY: dict[str, Parser] = {}


def register_source(vertical: str, parser: Parser) -> None:
    """Plug in (or replace) the page parser of a vertical."""
    _REGISTRY[vertical] = parser


def _parks(pages: DataFrame) -> DataFrame:
    base = "https://www.caip.org.ar"
    table = parse_table(pages, "caip", {"nombre": 0, "provincia": 1}, base_url=base, default_province="Buenos Aires")
    anchors = parse_links(pages, "caip", containing="parque", base_url=base, default_province="Buenos Aires")
    return with_fallback(table, anchors, ["page_id"])


def _members(pages: DataFrame) -> DataFrame:
    found = parse_cards(pages, "arlog", title_tags=("h2", "h3", "h4", "strong", "b"), title_words=(), place_words=(), longer_than=3)
    table = parse_table(pages, "arlog", {"nombre": 0}, header_cells=False, min_cells=1, headers=MEMBER_HEADERS)
    return with_fallback(found, table, ["page_id"])


register_source("barrios_privados", lambda p: parse_cards(p, "zonaprop"))
register_source("parques_industriales", _parks)
register_source("logisticas", _members)
register_source("droguerias", lambda p: parse_table(
    p, "anmat", {"nombre": 0, "localidad": 1, "provincia": 2, "tipo": -1}, header_cells=False, min_cells=3))
register_source("clinicas", lambda p: parse_table(
    p, "sssalud", {"nombre": 0, "provincia": 1, "localidad": 2}, headers=REGISTRY_HEADERS))


def discovery_source(vertical: str, parsers: Mapping[str, Parser] | None = None) -> Parser:
    """Page parser of a vertical; verticals without one read search results.

    ``parsers`` come before the registered ones, for this call only.
    """
    if parsers and vertical in parsers:
        return parsers[vertical]
    return _REGISTRY.get(vertical, lambda p: search_candidates(p.select("*", F.lit("google_dorks").alias("fuente"))))


def search_candidates(results: DataFrame, banned: list[str] = SECTOR_BANNED) -> DataFrame:
    """Search results (``url``, ``fuente``) to candidates named after their domain."""
    ok = drop_banned_domains(results.filter(truthy("url")), banned, "url")
    null = F.lit(None).cast("string")
    keep = [c for c in results.columns if c not in ("url", "fuente", "html")]
    return ok.select(
        *keep, domain_name_text(url_domain("url")).alias("nombre"), F.col("url").alias("sitio_web"),
        null.alias("partido"), null.alias("provincia"), null.alias("localidad"), "fuente",
        F.lit(None).cast("map<string,string>").alias("raw_data"),
    )


# ---------------------------------------------------------------- combining sources


def union_sources(*sources: DataFrame) -> DataFrame:
    """Sources in order of preference with their ``prioridad``."""
    tagged = [s.withColumn("prioridad", F.lit(i)) for i, s in enumerate(sources)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def take_quota(df: DataFrame, limit: int, order_cols: list[str]) -> DataFrame:
    """The first ``limit`` rows: later sources fill what earlier ones leave."""
    return df.orderBy(*order_cols).limit(limit)


def merge_sources(sources: list[DataFrame], limit: int, order_col: str = "ord") -> DataFrame:
    """Union, first row per name in source order, cut at the limit."""
    both = union_sources(*sources)
    unique = dedup_by_name(both.withColumn("__o", F.struct("prioridad", order_col)), "__o").drop("__o")
    return take_quota(unique, limit, ["prioridad", order_col])


def primary_or_fallback(df: DataFrame, group: list[str]) -> DataFrame:
    """Per group only the rows of the best source (lowest ``prioridad``) that has any."""
    best = df.groupBy(*group).agg(F.min("prioridad").alias("__best"))
    return df.join(best, group).filter(F.col("prioridad") == F.col("__best")).drop("__best")


def supplement(base: DataFrame, extra: DataFrame, limit: int | None = None) -> DataFrame:
    """The base and extra candidates with new sites.

    With a ``limit``, extras come only if the base has fewer than ``limit/2`` rows. Extra rows without a site always pass; extras are not compared among themselves.
    """
    known = base.filter(truthy("sitio_web")).select("sitio_web").distinct()
    fresh = extra.join(known, "sitio_web", "left_anti")
    if limit is not None:
        fresh = fresh.filter(base.agg(F.count(F.lit(1)) < limit // 2).scalar())
    return base.unionByName(fresh, allowMissingColumns=True)


def discovery_totals(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("total"), F.count_if(truthy("sitio_web")).alias("with_website"),
        F.count_if(~truthy("sitio_web")).alias("without_website"),
    )


# ---------------------------------------------------------------- choosing pages


def prefer_ar_order(url="url") -> Column:
    """0 for Argentine addresses, 1 for the others: stable when followed by the rank."""
    return F.when(prefers_ar(url), 0).otherwise(1)


def pick_search_result(results: DataFrame, key: list[str]) -> DataFrame:
    """Best site per lead: first query with results, Argentine first, then rank."""
    ok = results.filter(url_allowed("url"))
    return first_per_group(ok, key, ["query_no", prefer_ar_order("url"), "rank"])


def subpage_priority(spark: SparkSession, paths: list[str] = CONTACT_PAGES) -> DataFrame:
    return spark.createDataFrame(list(enumerate(paths)), "priority int, path string")


def pick_contact_page(pages: DataFrame, priority: DataFrame, min_chars: int = 300) -> DataFrame:
    """Per site the first contact sub-page (by priority) with enough text.

    ``pages`` has ``site, home_url, path, url, text``.
    """
    ok = pages.filter(F.length("text") >= min_chars).filter(
        F.regexp_replace("url", "/+$", "") != F.regexp_replace(F.coalesce("home_url", F.lit("")), "/+$", ""))
    return first_per_group(ok.join(priority, "path"), ["site"], ["priority"])


def cut_listing(pages: DataFrame, portal: list[str], page_col: str = "page", rows_col: str = "rows",
                bucket_pages: int = 1024) -> DataFrame:
    """Pages before a portal's end: the second empty page since the last full one."""
    marked = streaks(
        pages, portal, [page_col], F.coalesce(rows_col, F.lit(0)) == 0, F.coalesce(rows_col, F.lit(0)) > 0,
        F.floor(F.col(page_col) / bucket_pages), "__empty",
    )
    cut = marked.filter("__empty = 2").groupBy(*portal).agg(F.min(page_col).alias("__cut"))
    return marked.join(cut, portal, "left").filter(
        F.col("__cut").isNull() | (F.col(page_col) < F.col("__cut"))).drop("__cut", "__empty")


def first_good_answer(answers: DataFrame, key: str = "id") -> DataFrame:
    """Per key the answer of the first provider that succeeded."""
    good = answers.filter(F.col("error").isNull() & truthy("reply"))
    return first_per_group(good, [key], ["priority", "provider"])


def answer_or_regex_only(ids: DataFrame, answers: DataFrame, key: str = "id") -> DataFrame:
    """Every id with its waterfall answer; without one the mode is ``regex_only``."""
    best = first_good_answer(answers, key).select(key, "provider", "reply")
    return ids.join(best, key, "left").withColumn("provider", F.coalesce("provider", F.lit("regex_only"))).withColumn(
        "error", F.when(F.col("reply").isNull(), F.lit("Todos los LLM fallaron")))


# ---------------------------------------------------------------- search texts


def site_queries(leads: DataFrame, key: list[str]) -> DataFrame:
    """Progressive site queries, four per lead."""
    texts = F.array(*[
        F.replace(F.replace(F.lit(q), F.lit("{nombre}"), F.coalesce("nombre", F.lit(""))), F.lit("{partido}"), F.coalesce("partido", F.lit("")))
        for q in SITE_QUERIES
    ])
    return leads.select(*key, F.posexplode(texts).alias("query_no", "query"))


def sector_queries(names: DataFrame, country: str = "Argentina") -> DataFrame:
    """Sector queries of rows ``(name, sector, terms array)``."""
    def fill(q: str, **values: Column) -> Column:
        out = F.lit(q)
        for k, v in values.items():
            out = F.replace(out, F.lit("{%s}" % k), v)
        return out

    base = F.array(*[fill(q, name=F.col("name"), sector=F.col("sector"), country=F.lit(country)) for q in SECTOR_QUERIES])
    extra = F.transform(F.coalesce("terms", F.array().cast("array<string>")), lambda t: fill(
        SECTOR_TERM_QUERY, name=F.col("name"), term=t, country=F.lit(country)))
    return names.select("name", F.posexplode(F.concat(base, extra)).alias("query_no", "query"))


def vertical_queries(verticals: DataFrame) -> DataFrame:
    """Fixed queries of a vertical column; verticals without any get the generic one."""
    table = F.create_map(*[x for v, qs in VERTICAL_QUERIES.items() for x in (F.lit(v), F.array(*[F.lit(q) for q in qs]))])
    generic = F.array(F.replace(F.lit(GENERIC_QUERY), F.lit("{name}"), F.replace("vertical", F.lit("_"), F.lit(" "))))
    return verticals.select("*", F.posexplode(F.coalesce(F.try_element_at(table, F.col("vertical")), generic)).alias("query_no", "query"))
