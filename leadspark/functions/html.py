"""HTML to text, table rows, cards and links as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _col

# --- fixed values: page limits, markers of script-only pages, blocked statuses ---
MIN_TEXT_CHARS = 300
SPA_MARKERS = [
    "__NEXT_DATA__",
    'id="__NEXT_DATA__"',
    "window.__NUXT__",
    '<div id="app"></div>',
    '<div id="root"></div>',
    "ReactDOM.render",
    "ng-version=",
]
RENDER_STATUSES = [403, 429, 503]
# --- fixed values: page parts that never reach the text, per reader ---
FETCH_DROP = ["script", "style", "nav", "footer", "header", "noscript"]
LISTING_DROP = ["script", "style", "nav", "footer", "header"]
BULK_DROP = ["script", "style", "nav", "footer"]
# --- fixed values: named character references read in text ---
NAMED_ENTITIES = {
    "amp": "&", "lt": "<", "gt": ">", "quot": '"', "apos": "'", "nbsp": " ",
    "aacute": "á", "eacute": "é", "iacute": "í", "oacute": "ó", "uacute": "ú", "ntilde": "ñ", "uuml": "ü",
    "Aacute": "Á", "Eacute": "É", "Iacute": "Í", "Oacute": "Ó", "Uacute": "Ú", "Ntilde": "Ñ", "Uuml": "Ü",
    "iexcl": "¡", "iquest": "¿", "ordm": "º", "ordf": "ª", "deg": "°", "middot": "·", "laquo": "«", "raquo": "»",
    "ndash": "–", "mdash": "—", "hellip": "…", "copy": "©", "reg": "®", "euro": "€", "bull": "•",
}
_ENTITY = r"&(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[a-zA-Z]+);"
_EDGE_SPACES = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"


def decode_entities(text) -> Column:
    """Character references of a text node to characters; unknown ones stay."""
    t = _col(text)
    names = F.create_map(*[F.lit(x) for kv in NAMED_ENTITIES.items() for x in kv])

    def decode(ref: Column) -> Column:
        body = F.substring(ref, F.lit(2), F.length(ref) - 2)
        number = F.when(
            body.rlike("^#[xX]"), F.conv(F.substring(body, F.lit(3), F.length(body)), 16, 10)
        ).otherwise(F.substring(body, F.lit(2), F.length(body))).try_cast("bigint")
        char = F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")
        usable = number.between(1, 0xD7FF) | number.between(0xE000, 0x10FFFF)
        return F.when(body.startswith("#"), F.when(usable, char).otherwise(ref)).otherwise(
            F.coalesce(F.try_element_at(names, body), ref)
        )

    hits = F.transform(F.regexp_extract_all(t, F.lit(_ENTITY), F.lit(0)), decode)
    joined = F.array_join(
        F.zip_with(
            F.split(t, _ENTITY, -1), hits, lambda a, b: F.concat(F.coalesce(a, F.lit("")), F.coalesce(b, F.lit("")))
        ),
        "",
    )
    return F.when(F.instr(t, "&") > 0, joined).otherwise(t)


def strip_spaces(text) -> Column:
    return F.regexp_replace(_col(text), _EDGE_SPACES, "")


def node_text(html, separator: str = " ") -> Column:
    """Text nodes of a fragment, each stripped, empty ones dropped, joined."""
    bare = F.regexp_replace(F.coalesce(_col(html), F.lit("")), r"(?s)<!--.*?-->", "")
    nodes = F.transform(F.split(bare, r"<[a-zA-Z/!?][^>]*>", -1), lambda n: strip_spaces(decode_entities(n)))
    return F.array_join(F.filter(nodes, lambda n: n != ""), separator)


def html_text(html, drop: list[str] = FETCH_DROP, separator: str = " ") -> Column:
    """Readable text of a page: the ``drop`` elements vanish with their content.

    The page is cut at the start and end tags of these elements and folded from left to right: a
    dropped element lasts to its own end tag, elements of its name within it included, or to the
    end of the page. Scripts and styles hold no elements.
    """
    bare = F.regexp_replace(F.coalesce(_col(html), F.lit("")), r"(?s)<!--.*?-->", "")
    tag = rf"(?is)</?(?:{'|'.join(drop)})(?![\w-])[^>]*>"
    steps = F.arrays_zip(F.split(bare, tag, -1).alias("text"), F.concat(F.array(F.lit("")), F.regexp_extract_all(bare, F.lit(tag), F.lit(0))).alias("tag"))
    start = F.struct(F.lit("").alias("within"), F.lit(0).alias("depth"), F.array().cast("array<string>").alias("kept"))

    def fold(state: Column, step: Column) -> Column:
        name = F.lower(F.regexp_extract(step["tag"], r"^</?(\w+)", 1))
        ends, inside = step["tag"].startswith("</"), state["depth"] > 0
        own = name == state["within"]
        nests = own & ~name.isin("script", "style")
        depth = F.when(step["tag"] == "", state["depth"]).when(
            inside, state["depth"] + F.when(own & ends, -1).when(nests, 1).otherwise(0)).when(ends, 0).otherwise(1)
        return F.struct(
            F.when(inside, state["within"]).otherwise(name).alias("within"), depth.alias("depth"),
            F.when(depth > 0, state["kept"]).otherwise(F.concat(state["kept"], F.array(step["text"]))).alias("kept"))

    kept = F.aggregate(steps, start, fold, lambda state: F.array_join(state["kept"], "<br>"))
    return node_text(F.when(bare.rlike(tag), kept).otherwise(bare), separator)


def has_content(text) -> Column:
    return F.length(F.coalesce(_col(text), F.lit(""))) >= MIN_TEXT_CHARS


def looks_unrendered(html, text) -> Column:
    """Script-only page: short text, or a marker of a client-side framework."""
    h = F.coalesce(_col(html), F.lit(""))
    marked = F.lit(False)
    for marker in SPA_MARKERS:
        marked = marked | h.contains(marker)
    return ~has_content(text) | marked


def needs_render(html, text, status) -> Column:
    """Blocked status, empty body or script-only page."""
    return (
        F.coalesce(_col(status).isin(*RENDER_STATUSES), F.lit(False))
        | (F.coalesce(_col(html), F.lit("")) == "")
        | looks_unrendered(html, text)
    )


# ---------------------------------------------------------------- parts


def _blocks(html, pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all(F.coalesce(_col(html), F.lit("")), F.lit(pattern), F.lit(group))


def table_rows(html, header_cells: bool = True) -> Column:
    """``array<struct<cells: array<string>, link: string>>`` of all table rows."""
    cell = r"t[dh]" if header_cells else r"td"
    rows = _blocks(html, r"(?is)<tr\b[^>]*>.*?</tr\s*>")

    def parse(row: Column) -> Column:
        cells = F.regexp_extract_all(row, F.lit(rf"(?is)<{cell}\b[^>]*>(.*?)</{cell}\s*>"), F.lit(1))
        return F.struct(
            F.transform(cells, lambda c: node_text(c, "")).alias("cells"),
            F.regexp_extract(row, r"""(?is)<a\b[^>]*?\bhref\s*=\s*["']?([^"'\s>]*)""", 1).alias("link"),
        )

    return F.transform(rows, parse)


def first_element_text(html, tags: list[str]) -> Column:
    """Text of the first element with one of the tags, ``''`` when none."""
    inner = F.regexp_extract(_col(html), rf"(?is)<({'|'.join(tags)})\b[^>]*>(.*?)</\1\s*>", 2)
    return node_text(inner, "")


def first_class_text(html, words: list[str]) -> Column:
    """Text of the first element whose class holds one of the words."""
    inner = F.regexp_extract(
        _col(html), rf"""(?is)<(\w+)\b[^>]*\bclass\s*=\s*["'][^"']*(?:{'|'.join(words)})[^"']*["'][^>]*>(.*?)</\1\s*>""", 2
    )
    return node_text(inner, "")


def first_href(html) -> Column:
    return F.regexp_extract(_col(html), r"""(?is)<a\b[^>]*?\bhref\s*=\s*["']?([^"'\s>]*)""", 1)


def cards(html, block: str = "article") -> Column:
    """HTML of every card block."""
    return _blocks(html, rf"(?is)<{block}\b[^>]*>.*?</{block}\s*>")


def links(html) -> Column:
    """``array<struct<href, text>>`` of all anchors with a target."""
    pattern = r"""(?is)<a\b[^>]*?\bhref\s*=\s*["']([^"']*)["'][^>]*>(.*?)</a\s*>"""
    return F.zip_with(
        _blocks(html, pattern, 1),
        _blocks(html, pattern, 2),
        lambda href, inner: F.struct(href.alias("href"), node_text(inner, "").alias("text")),
    )
