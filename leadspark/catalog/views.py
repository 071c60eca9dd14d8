"""Lead-shaped views over the benchmark tables, with the same expressions on both sides.

Expressions are written in the common part of Spark SQL and the checking SQL,
so each view is stated once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.html import first_element_text
from ..schemas import VERTICALS
from .registry import Tables

VERTICAL_OF_NATION = "CASE n_nationkey % 15 " + " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(VERTICALS)) + " END"

CUST = {
    "ord": "c_custkey",
    "nombre": "c_name",
    "vertical": VERTICAL_OF_NATION,
    "estado_comercial": "CASE c_mktsegment WHEN 'BUILDING' THEN 'CLIENTE' ELSE 'SIN_CONTACTAR' END",
    "email": "CASE WHEN c_mktsegment IN ('MACHINERY', 'FURNITURE') THEN NULL ELSE 'info' || CAST(c_custkey AS STRING) || '@example.com' END",
    "email_2": "CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 'casa' || CAST(c_custkey AS STRING) || '@example.com' END",
    "email_3": "CAST(NULL AS STRING)",
    "email_validado": "c_acctbal > 5000",
    "email_score": "CASE WHEN c_acctbal > 5000 THEN CAST(c_custkey % 101 AS INT) END",
    "telefono": "CASE WHEN c_acctbal < 1000 THEN NULL WHEN c_acctbal < 1500 THEN '' ELSE '011-4' || lpad(CAST(c_custkey AS STRING), 7, '0') END",
    "sitio_web": "CASE WHEN n_nationkey >= 12 THEN NULL ELSE 'https://www.c' || CAST(c_custkey AS STRING) || '.com.ar' END",
    "fuente_contacto": "'customer'",
    "notas": "CAST(NULL AS STRING)",
    "direccion": "CASE WHEN c_acctbal > 9000 THEN NULL ELSE 'Calle ' || CAST(c_custkey AS STRING) END",
    "localidad": "CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN NULL ELSE c_mktsegment END",
    "partido": "CASE WHEN r_name = 'ASIA' THEN NULL ELSE n_name END",
    "provincia": "r_name",
    "pais": "CASE WHEN r_name = 'EUROPE' THEN '' ELSE 'Argentina' END",
    "cp": "CASE WHEN r_name = 'AFRICA' THEN 'C' || CAST(n_nationkey AS STRING) END",
    "latitud": "CASE WHEN c_acctbal < 0 THEN NULL ELSE -c_acctbal / 100 END",
    "longitud": "CASE WHEN c_acctbal < 500 THEN NULL ELSE -c_acctbal / 50 END",
    "metadata": "CASE WHEN r_name = 'AFRICA' THEN '{}' ELSE '{\"nivel\":' || CAST(n_nationkey AS STRING) || '}' END",
}
CUST_SQL = (
    "SELECT " + ", ".join(f"{e} AS {n}" for n, e in CUST.items())
    + " FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"
)
PART_SQL = "SELECT p_partkey AS ord, p_name AS nombre, p_brand AS partido FROM part"

#: Lot state told by the order status; open orders keep the state they were created with.
STATE_OF_ORDER = "CASE o_orderstatus WHEN 'F' THEN 'subido' WHEN 'P' THEN 'consolidado' END"


def v_cust(t: Tables) -> DataFrame:
    joined = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).join(
        t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    return joined.selectExpr(*[f"{e} AS {n}" for n, e in CUST.items()])


def v_part(t: Tables) -> DataFrame:
    return t.part.selectExpr("p_partkey AS ord", "p_name AS nombre", "p_brand AS partido")


def v_title(t: Tables) -> DataFrame:
    """Pages named by their whole title, the language in the address as district."""
    lang = F.regexp_extract("url", r"^[a-z]+://[^/]*/([a-z]+)", 1)
    return t.pages.select(F.col("page_id").alias("ord"), first_element_text("html", ["h1"]).alias("nombre"), lang.alias("partido"))


TITLE_SQL = (
    r"SELECT page_id AS ord, {} AS nombre, regexp_extract(url, '^[a-z]+://[^/]*/([a-z]+)', 1) AS partido FROM pages")


def with_cust(body: str) -> str:
    return f"WITH v AS ({CUST_SQL}) {body}"


# ---------------------------------------------------------------- SQL fragments of the checking side


def norm(x: str) -> str:
    return rf"trim(regexp_replace(strip_accents(lower(coalesce({x}, ''))), '[\s\p{{Z}}]+', ' ', 'g'))"


def squash(x: str) -> str:
    return rf"trim(regexp_replace(lower({x}), '[\s\p{{Z}}]+', ' ', 'g'))"


def dedup_key(n: str = "nombre", p: str = "partido") -> str:
    return f"{norm(n)} || '|' || {norm(p)}"


def sort_tokens(x: str) -> str:
    return f"array_to_string(list_sort(string_split({norm(x)}, ' ')), ' ')"


def ratio(a: str, b: str) -> str:
    """Token-sort ratio of two sorted-token columns by a folded LCS table."""
    return f"""(CASE WHEN length({a}) + length({b}) = 0 THEN 100.0 WHEN length({a}) * length({b}) = 0 THEN 0.0 ELSE
    200.0 * list_extract(list_reduce(
      list_prepend(list_transform(range(length({b}) + 1), lambda i: 0), list_transform(string_split({a}, ''), lambda c: [unicode(c)::INT])),
      lambda acc, ch: list_reduce(
        list_prepend([0], list_transform(range(1, length({b}) + 1), lambda j: [j::INT])),
        lambda nr, j: list_append(nr, CASE WHEN unicode({b}[j[1]]) = ch[1] THEN acc[j[1]] + 1 ELSE greatest(acc[j[1] + 1], nr[j[1]]) END))), -1)
    / (length({a}) + length({b})) END)"""


def likely(a: str, b: str, threshold: int) -> str:
    """Whether the letters that two texts share, in any order, could reach the ratio at all."""
    common = f"coalesce(list_sum(list_transform(list_distinct(string_split({a}, '')), lambda c: least(length({a}) - length(replace({a}, c, '')), length({b}) - length(replace({b}, c, ''))))), 0)"
    return f"(CASE WHEN length({a}) + length({b}) = 0 THEN true WHEN 200 * least(length({a}), length({b})) < {threshold} * (length({a}) + length({b})) THEN false ELSE 200 * {common} >= {threshold} * (length({a}) + length({b})) END)"


def truthy(c: str) -> str:
    return f"coalesce({c}, '') <> ''"


def netloc(u: str) -> str:
    return rf"lower(regexp_extract(coalesce({u}, ''), '^(?:[a-zA-Z][\w+.-]*:)?//([^/?#]*)', 1))"


def domain(u: str) -> str:
    return rf"regexp_replace({netloc(u)}, '^www\.', '')"


def any_contains(x: str, words: list[str]) -> str:
    return "(" + " OR ".join(f"contains({x}, '{w}')" for w in words) + ")"


def in_list(words: list[str]) -> str:
    return "(" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + ")"


EMAIL_RE = r"[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}"
PHONE_RE = r"(?:\+?54[\s-]?)?(?:11|[2368]\d)[\s-]?\d{4}[\s-]?\d{4}"


def hits(x: str, pattern: str) -> str:
    return f"list_sort(list_distinct(regexp_extract_all(coalesce({x}, ''), '{pattern}')))"


def node_text(x: str, sep: str = " ") -> str:
    bare = rf"regexp_replace({x}, '(?s)<!--.*?-->', '', 'g')"
    decoded = "replace(replace(replace(replace(n, '&copy;', '©'), '&middot;', '·'), '&quot;', '\"'), '&amp;', '&')"
    return (
        rf"array_to_string(list_filter(list_transform(string_split_regex({bare}, '<[a-zA-Z/!?][^>]*>'), "
        rf"lambda n: regexp_replace({decoded}, '^[\s\p{{Z}}]+|[\s\p{{Z}}]+$', '', 'g')), lambda n: n <> ''), '{sep}')"
    )


def html_text(x: str, drop: list[str]) -> str:
    out = rf"regexp_replace({x}, '(?s)<!--.*?-->', '', 'g')"
    for tag in drop:
        out = rf"regexp_replace({out}, '(?is)<{tag}\b[^>]*>.*?</{tag}\s*>', '<br>', 'g')"
    return node_text(out)


def score(prefix: str = "") -> str:
    p = prefix
    return (
        f"(CASE WHEN {truthy(p + 'email')} THEN 25 ELSE 0 END + CASE WHEN {truthy(p + 'telefono')} THEN 20 ELSE 0 END"
        f" + CASE WHEN {truthy(p + 'sitio_web')} THEN 15 ELSE 0 END + CASE WHEN {truthy(p + 'partido')} THEN 10 ELSE 0 END"
        f" + CASE WHEN {truthy(p + 'localidad')} THEN 10 ELSE 0 END"
        f" + CASE WHEN {p}latitud IS NOT NULL AND {p}longitud IS NOT NULL THEN 10 ELSE 0 END"
        f" + CASE WHEN coalesce({p}email_validado, false) THEN 10 ELSE 0 END)::DOUBLE"
    )


def greedy(rows: str, threshold: int) -> str:
    """CTEs of the in-order greedy scan over ``rows`` (g, ord, nombre, partido); ``kept`` has (g, ord)."""
    return f"""nd AS (SELECT g, s, d, min(ord) AS ord FROM (SELECT g, ord, {sort_tokens('nombre')} AS s, {norm('partido')} AS d FROM ({rows})) GROUP BY ALL),
  u AS (SELECT DISTINCT g, s FROM nd), us AS (SELECT DISTINCT a.s AS sa, b.s AS sb FROM u a JOIN u b ON a.g = b.g AND a.s < b.s),
  sp AS (SELECT sa, sb FROM us WHERE CASE WHEN {likely('sa', 'sb', threshold)} THEN {ratio('sa', 'sb')} >= {threshold} ELSE false END),
  sym AS (SELECT sa, sb FROM sp UNION ALL SELECT sb, sa FROM sp UNION ALL SELECT DISTINCT s, s FROM u),
  nb AS (SELECT x.g, x.ord, list(y.ord) AS lower FROM nd x JOIN sym ON sym.sa = x.s JOIN nd y ON y.g = x.g AND y.s = sym.sb
    WHERE y.ord < x.ord AND (x.d = y.d OR x.d = '' OR y.d = '') GROUP BY ALL),
  q AS (SELECT nd.g, nd.ord, coalesce(nb.lower, []) AS lower, row_number() OVER (PARTITION BY nd.g ORDER BY nd.ord) AS rk
    FROM nd LEFT JOIN nb ON nb.g = nd.g AND nb.ord = nd.ord),
  r AS (SELECT DISTINCT g, 0::BIGINT AS rk, []::BIGINT[] AS kept FROM q UNION ALL
    SELECT r.g, r.rk + 1, CASE WHEN len(list_intersect(r.kept, q.lower)) > 0 THEN r.kept ELSE list_append(r.kept, q.ord) END
    FROM r JOIN q ON q.g = r.g AND q.rk = r.rk + 1),
  kept AS (SELECT g, unnest(kept) AS ord FROM (SELECT g, arg_max(kept, rk) AS kept FROM r GROUP BY g))"""
