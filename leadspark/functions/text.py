"""Column expressions for names, URLs, places and times. All run inside the JVM."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Whitespace as Unicode knows it plus the four ASCII separators.
SPACES = r"(?U)[\s\x1c-\x1f]+"

# --- fixed values: top-level domains dropped from a domain before it is shown as a name ---
NAME_TLDS = [".com.ar", ".org.ar", ".net.ar", ".gob.ar", ".com", ".org", ".net"]
# --- fixed values: provinces known to the location splitter ---
KNOWN_PROVINCES = [
    "Buenos Aires", "Córdoba", "Santa Fe", "Mendoza", "Tucumán", "Salta", "Misiones", "Entre Ríos",
]


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def truthy(c) -> Column:
    """Text is present: neither NULL nor empty."""
    return F.coalesce(_col(c), F.lit("")) != ""


def blank_to_null(c) -> Column:
    return F.nullif(_col(c), F.lit(""))


@lru_cache(maxsize=1)
def accent_folding() -> tuple[str, str]:
    """(from, to) for ``translate``: every lower-case letter with a one-letter base."""
    source, target = [], []
    for code in range(0xC0, 0x30000):
        if 0xD800 <= code <= 0xDFFF:
            continue
        ch = chr(code)
        base = "".join(c for c in unicodedata.normalize("NFD", ch) if unicodedata.category(c) != "Mn")
        if ch.lower() == ch and len(base) == 1 and base != ch:
            source.append(ch)
            target.append(base)
    return "".join(source), "".join(target)


def collapse_spaces(c) -> Column:
    return F.trim(F.regexp_replace(_col(c), SPACES, " "))


def normalize_name(c) -> Column:
    """Lower case, no accents, single spaces (NULL counts as empty)."""
    source, target = accent_folding()
    lowered = F.lower(F.coalesce(_col(c), F.lit("")))
    folded = F.regexp_replace(F.translate(lowered, source, target), r"\p{Mn}", "")
    return collapse_spaces(folded)


def squash_name(c) -> Column:
    """Lower case and single spaces; accents stay."""
    return collapse_spaces(F.lower(_col(c)))


def dedup_key(nombre="nombre", partido="partido") -> Column:
    return F.concat(normalize_name(nombre), F.lit("|"), normalize_name(partido))


def sort_tokens(normalized) -> Column:
    """Words of a normalised name in code-point order."""
    return F.array_join(F.sort_array(F.split(_col(normalized), " ")), " ")


def same_district(a, b) -> Column:
    """District rule: equal, or at least one side unknown (inputs normalised)."""
    a, b = _col(a), _col(b)
    return (a == "") | (b == "") | (a == b)


def let(value: Column, body) -> Column:
    """``body`` of a value that is evaluated once (expressions inside a lambda are evaluated a step)."""
    return F.get(F.transform(F.array(value), body), 0)


def characters(c) -> Column:
    """The characters of a text; none of an empty one."""
    c = _col(c)
    return F.when(F.length(c) == 0, F.array().cast("array<string>")).otherwise(F.split(c, ""))


#: Bits of a word of the longest-common-subsequence row: sums of two stay below the sign bit.
LCS_BITS = 62


def lcs_length(a, b) -> Column:
    """Longest common subsequence by bit vectors: one step a character of the longer text.

    A row of bits stands for the characters of the shorter text, ``LCS_BITS`` to a word; a bit turns 0 where
    the common subsequence grows. Carries go from word to word. All of it runs inside the JVM.
    """
    full = F.lit((1 << LCS_BITS) - 1)

    def bits(part: Column, ch: Column) -> Column:
        """Where ``part`` (last character first) holds the character."""
        return F.aggregate(part, F.lit(0).cast("long"), lambda m, x: F.shiftleft(m, 1) + F.when(x == ch, 1).otherwise(0))

    def masks(of_char, none: Column, t: Column) -> Column:
        """What ``of_char`` gives for every character of the longer text, computed once a different one."""
        known = F.array_distinct(t["short"])
        return let(F.map_from_arrays(known, F.transform(known, of_char)),
                   lambda m: F.transform(t["long"], lambda ch: F.coalesce(F.element_at(m, ch), none)))

    def narrow(t: Column) -> Column:
        zero = F.lit(0).cast("long")
        rows = let(F.reverse(t["short"]), lambda part: masks(lambda ch: bits(part, ch), zero, t))
        last = F.aggregate(rows, full, lambda row, m: (row + row.bitwiseAND(m)).bitwiseAND(full).bitwiseOR(row.bitwiseAND(F.bitwise_not(m))))
        return LCS_BITS - F.bit_count(last)

    def wide(t: Column) -> Column:
        words = F.sequence(F.lit(0), F.floor((F.size(t["short"]) - 1) / LCS_BITS).cast("int"))
        parts = F.transform(words, lambda w: F.reverse(F.slice(t["short"], w * LCS_BITS + 1, LCS_BITS)))
        none = F.array().cast("array<long>")
        rows = let(parts, lambda ps: masks(lambda ch: F.transform(ps, lambda part: bits(part, ch)), none, t))

        def step(state: Column, word: Column) -> Column:
            total = word["row"] + word["row"].bitwiseAND(word["m"]) + state["carry"]
            new = total.bitwiseAND(full).bitwiseOR(word["row"].bitwiseAND(F.bitwise_not(word["m"])))
            return F.struct(F.array_append(state["row"], new).alias("row"), F.shiftright(total, LCS_BITS).alias("carry"))

        def advance(row: Column, m: Column) -> Column:
            pairs = F.zip_with(row, m, lambda r, k: F.struct(r.alias("row"), k.alias("m")))
            start = F.struct(none.alias("row"), F.lit(0).cast("long").alias("carry"))
            return F.when(F.size(m) == 0, row).otherwise(F.aggregate(pairs, start, step, lambda state: state["row"]))

        last = F.aggregate(rows, F.transform(words, lambda w: full), advance)
        return F.aggregate(last, F.lit(0), lambda n, row: n + (LCS_BITS - F.bit_count(row)))

    def of(t: Column) -> Column:
        size = F.size(t["short"])
        return F.when(size == 0, 0).when(size <= LCS_BITS, narrow(t)).otherwise(wide(t))

    def sides(p: Column) -> Column:
        a_short = F.size(p["a"]) <= F.size(p["b"])
        return let(F.struct(F.when(a_short, p["a"]).otherwise(p["b"]).alias("short"), F.when(a_short, p["b"]).otherwise(p["a"]).alias("long")), of)

    return let(F.struct(characters(a).alias("a"), characters(b).alias("b")), sides)


def indel_ratio(a, b) -> Column:
    """0..100 similarity ``200*LCS/(len a + len b)``; two empty texts are equal."""
    def score(p: Column) -> Column:
        total = F.length(p["a"]) + F.length(p["b"])
        return F.when(total == 0, F.lit(100.0)).otherwise(F.lit(200.0) * lcs_length(p["a"], p["b"]) / total)

    return let(F.struct(_col(a).alias("a"), _col(b).alias("b")), score)


def token_sort_ratio(a, b) -> Column:
    """Similarity of two names regardless of word order."""
    return indel_ratio(sort_tokens(normalize_name(a)), sort_tokens(normalize_name(b)))


# ---------------------------------------------------------------- URLs


def url_netloc(url) -> Column:
    """Network location, lower case; ``''`` when the text has none."""
    return F.lower(F.regexp_extract(F.coalesce(_col(url), F.lit("")), r"^(?:[a-zA-Z][\w+.-]*:)?//([^/?#]*)", 1))


def url_domain(url) -> Column:
    """Network location without one leading ``www.``."""
    return F.regexp_replace(url_netloc(url), r"^www\.", "")


def url_base(url) -> Column:
    """Scheme and network location."""
    return F.regexp_extract(F.coalesce(_col(url), F.lit("")), r"^([a-zA-Z][\w+.-]*://[^/?#]*)", 1)


def url_path(url) -> Column:
    return F.regexp_extract(F.coalesce(_col(url), F.lit("")), r"^[a-zA-Z][\w+.-]*://[^/?#]*([^?#]*)", 1)


def has_http_scheme(url) -> Column:
    return F.coalesce(_col(url), F.lit("")).startswith("http")


def absolute_url(url, base: str) -> Column:
    """Absolute links stay, rooted links get ``base``, anything else is ``''``."""
    u = F.coalesce(_col(url), F.lit(""))
    return (
        F.when(u.startswith("http"), u)
        .when(u.startswith("/"), F.concat(F.lit(base), u))
        .otherwise("")
    )


def valid_site(url) -> Column:
    """Web address with an http(s) scheme and a host."""
    return F.coalesce(_col(url), F.lit("")).rlike(r"^(?i:https?)://[^/?#\s@]+(?:[/?#]\S*)?$")


def canonical_site(url) -> Column:
    """Lower-case scheme and host; an empty path becomes ``/``; invalid is NULL."""
    u = _col(url)
    head = F.lower(F.regexp_extract(u, r"^((?i:https?)://[^/?#]*)", 1))
    rest = F.regexp_extract(u, r"^(?i:https?)://[^/?#]*(.*)$", 1)
    return F.when(
        valid_site(u), F.concat(head, F.when(rest.startswith("/"), rest).otherwise(F.concat(F.lit("/"), rest)))
    )


def domain_name_text(domain) -> Column:
    """Readable name of a domain: ending dropped, separators to spaces, capitals."""
    endings = "|".join(t.replace(".", r"\.") for t in NAME_TLDS)
    stem = F.regexp_replace(_col(domain), f"(?:{endings})$", "")
    return F.initcap(F.trim(F.regexp_replace(stem, r"[-.\s]+", " ")))


def prefers_ar(url) -> Column:
    """Argentine commercial or organisation address (anywhere in the URL)."""
    u = F.coalesce(_col(url), F.lit(""))
    return u.contains(".com.ar") | u.contains(".org.ar")


# ---------------------------------------------------------------- places


def _trimmed_parts(text, pattern: str) -> Column:
    parts = F.split(F.coalesce(_col(text), F.lit("")), pattern)
    return F.filter(F.transform(parts, lambda p: F.trim(p)), lambda p: p != "")


def split_location(text) -> Column:
    """``struct(partido, provincia)`` of a free location text.

    The part before the first known province is the district; without one the
    first part is. Either is NULL when absent.
    """
    parts = _trimmed_parts(text, r"[,·|]")
    known = F.array(*[F.lit(p) for p in KNOWN_PROVINCES])
    flags = F.transform(parts, lambda p: F.array_contains(known, p))
    at = F.array_position(flags, F.lit(True)).cast("int")  # 1-based, 0 when absent
    province = F.when(at > 0, F.try_element_at(parts, at))
    district = F.when(at > 1, F.try_element_at(parts, at - 1)).when(
        F.size(parts) > 0, F.try_element_at(parts, F.lit(1))
    )
    return F.struct(district.alias("partido"), province.alias("provincia"))


def province_from_address(address) -> Column:
    """Next-to-last part of a postal address that ends with the country, else ``''``."""
    parts = F.transform(F.split(F.coalesce(_col(address), F.lit("")), ","), lambda p: F.trim(p))
    ok = (F.size(parts) >= 3) & F.coalesce(F.try_element_at(parts, F.lit(-1)).contains("Argentina"), F.lit(False))
    return F.when(ok, F.try_element_at(parts, F.lit(-2))).otherwise("")


def geocode_query(direccion, localidad, partido, provincia, pais=None) -> Column:
    """Non-empty parts joined by ``", "``."""
    country = F.lit("Argentina") if pais is None else _col(pais)
    return F.concat_ws(
        ", ", *[blank_to_null(c) for c in (direccion, localidad, partido, provincia, country)]
    )


def join_texts(main, sub, limit: int | None = None) -> Column:
    """Home text and sub-page text as one text, cut to a budget if one is given."""
    both = F.concat_ws(" | ", blank_to_null(main), blank_to_null(sub))
    return both if limit is None else F.substring(both, 1, limit)


# ---------------------------------------------------------------- time


def iso_utc(ts) -> Column:
    return F.date_format(_col(ts), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def parse_iso(text) -> Column:
    """ISO text to timestamp; NULL when it is not one."""
    return F.expr("try_cast({} as timestamp)".format(text)) if isinstance(text, str) else text.try_cast("timestamp")


def estimate_minutes(n) -> Column:
    """Nine seconds per lead, at least one minute."""
    return F.greatest(F.lit(1).cast("long"), F.floor(_col(n) * 9 / 60))
