"""Main text of a web page by text density.

``html.parser`` streams the events of a page. The text between two block borders is a line; it
knows its length, its tags, and how much of it stands in links. The text-to-tag ratio of the
lines, smoothed with a Gaussian and split by a two-means threshold, gives the content regions.
Names of the blocks around a line rule it out first where they say what it is: nothing below
navigation, headers, footers, forms, notices, adverts, teasers or comments is content, nor what is
hidden. A class or id does not rule out what holds the only marked article or, without one, most of
the dense text. The mark of an article is a prior: it is believed if its dense regions weigh at least half of those
outside, and then every line of a marked article with a dense region counts.

Reading is linear in the page: open elements are kept by tag, blocks as links to the block around,
and a comment or tag that never ends reaches to the end of the page, as in a browser.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from dataclasses import dataclass, field
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, pick

#: Standard deviation (lines) of the smoothing.
SIGMA = 1.0

#: Elements whose text is never shown.
UNSEEN = frozenset("script style noscript template iframe canvas head title desc metadata annotation annotation-xml".split())
#: Elements that a head may hold; any other ends it.
IN_HEAD = frozenset("title script style meta link base basefont bgsound noscript noframes template".split())
#: Elements that are not the main text.
ASIDE = frozenset("nav header footer aside form button select option textarea dialog menu".split())
#: Elements that mark the main text.
ARTICLE = frozenset("article main".split())
#: Elements that group lines.
GROUPS = frozenset("body div section article main td".split())
#: Elements that do not end a line.
INLINE = frozenset("math mi mn mo ms mtext mrow mfrac msqrt mroot mstyle mpadded msub msup msubsup munder mover munderover mmultiscripts semantics g path tspan a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Text-to-tag ratio (characters a tag) that is content wherever the clusters part.
DENSE = 12.0
#: Elements without end tag.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Roles that say the same as elements.
ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
#: Words that mark what is not the main text, as a class or id or all of its parts ...
ASIDE_WORDS = re.compile(
    r"ads?|advert(?:s|isements?|ising)?|banner|sponsor(?:ed|s)?|promo(?:tions?)?|nav(?:bar|igation)?|menu|sidebars?|aside|footer|header|masthead|breadcrumbs?|cookies?|consent|"
    r"notices?|popup|modal|overlay|comments?|disqus|repl(?:y|ies)|share|sharing|social|related|recommend(?:ed|ations)?|newsletter|subscribe|login|signup|widgets?|toolbar|pagination|pager|skip|hidden",
    re.IGNORECASE)
#: ... but for these, which say where a block is or what it is made of.
PLACE_WORDS = re.compile(
    r"\d+(?:x\d+)?|site|global|top|bottom|left|right|main|primary|secondary|inner|outer|wrap(?:per)?|container|box|block|bar|lists?|area|section|links?|icons?|buttons?|form|posts?|items?|group|slot|unit|column|row|"
    r"mobile|desktop|sticky|fixed|respond|thread", re.IGNORECASE)
#: Words that say so as the last part of a class or id, whatever stands before ...
STRONG_WORDS = re.compile(
    r"(?:adverts?|advertisements?|advertising|ads?|sponsor(?:ed|s)|promos?|comments?|sidebars?|breadcrumbs?|cookies?|newsletter|navbar|disqus|popup|masthead)(?:lists?|box|block|area|section|wrap(?:per)?|container|bar|slot|form|notice)?",
    re.IGNORECASE)
#: ... but for these, which say that a page has, or has not, such a part.
HAS_WORDS = frozenset("has have no not non with without is hide show layout page before after above below".split())
#: Words that together name teasers of other articles.
OTHER_WORDS = re.compile(r"more|other|latest|popular|trending|recent|further|next|most|also|you|may|might|like|read", re.IGNORECASE)
STORY_WORDS = re.compile(r"stories|story|articles?|posts?|news|reads?|reading|headlines?|like", re.IGNORECASE)
#: A style that hides an element.
HIDING = re.compile(r"(?:^|[;\s])(?:display\s*:\s*none|visibility\s*:\s*hidden)", re.IGNORECASE)
#: A notice of rights.
RIGHTS = re.compile(r"(?:©|\(c\)|copyright\b)|.*\ball rights reserved\W*$", re.IGNORECASE)
#: End of a comment.
COMMENT_END = re.compile("--!?>")
#: Beginning of markup.
MARKUP = re.compile("<[A-Za-z/!?]")
#: Words for the head of a block, which within an article belongs to it.
HEAD_WORDS = frozenset(("header", "masthead", "banner"))
PARTS = re.compile(r"(?:posts?|items?|sections?|block|box|lists?|group|thread)$", re.IGNORECASE)
#: End tags that the opening of these elements leaves out.
CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())


def named_aside(label: str, article: bool) -> int:
    """Whether a class or id among the names of an element says that it is not the main text: 2 surely, 1 likely, 0 not."""
    likely = 0
    for name in label.split():
        parts = [x for x in re.split("[-_]+|(?<=[a-z0-9])(?=[A-Z])", name) if x]
        if not parts:
            continue
        if STRONG_WORDS.fullmatch(parts[-1]) and not any(x.lower() in HAS_WORDS for x in parts) and parts[-1].lower() not in HEAD_WORDS:
            return 2
        if len(parts) > 1 and OTHER_WORDS.fullmatch(parts[0]) and any(STORY_WORDS.fullmatch(x) for x in parts[1:]) and all(
                OTHER_WORDS.fullmatch(x) or STORY_WORDS.fullmatch(x) or PLACE_WORDS.fullmatch(x) for x in parts):
            likely = 1
        words = [x for x in parts if ASIDE_WORDS.fullmatch(x)]
        head = all(x.lower() in HEAD_WORDS for x in words)
        # post-header is the head of a post, site-header that of the site.
        if words and all(x in words or PLACE_WORDS.fullmatch(x) for x in parts) and not (head and (article or PARTS.match(parts[0]))):
            likely = 1
    return likely


@dataclass(slots=True)
class Block:
    """An open element. ``around`` is the number of the block around it, always a smaller one."""

    around: int
    #: Ruled out by what it is, itself or around it.
    aside: bool = False
    #: Number of the marked article it belongs to, 0 for none.
    article: int = 0
    #: Ruled out by a class or id of its own (see ``named_aside``).
    named: int = 0
    #: An ``article`` element stands around it.
    in_article: bool = False
    #: The innermost block that groups lines, itself or around it.
    group: int = 0


@dataclass(slots=True)
class Line:
    block: int = 0
    parts: list[str] = field(default_factory=list)
    tags: int = 0
    link_chars: int = 0
    aside: bool = False
    article: int = 0
    heading: bool = False

    def text(self) -> str:
        return " ".join("".join(self.parts).split())


class LineReader(HTMLParser):
    """Lines of a page, in page order, and the blocks they stand in. Takes the whole page at once."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        self.blocks = [Block(0)]
        #: Open elements (tag, number of the block), and the places of each tag among them.
        self.stack: list[tuple[str, int]] = []
        self.places: dict[str, list[int]] = defaultdict(list)
        self.unseen = 0
        self.articles = 0
        self.line = Line()

    def read(self, html: str) -> list[Line]:
        # A tag without end is dropped with all after it.
        tail = html.rfind(">") + 1
        if begun := MARKUP.search(html, tail):
            html = html[:begun.start()]
        self.feed(html)
        self.close()
        self._end_line()
        return [line for line in self.lines if line.text()]

    def parse_comment(self, i: int, report: bool = True) -> int:
        end = COMMENT_END.search(self.rawdata, i + 2)
        return end.end() if end else len(self.rawdata)

    def parse_html_declaration(self, i: int) -> int:
        return self.rawdata.find(">", i) + 1 or len(self.rawdata)

    def _around(self) -> int:
        return self.stack[-1][1] if self.stack else 0

    def _place_line(self) -> None:
        """Put the line that begins here into the block open here."""
        number = self._around()
        self.line.block, self.line.aside, self.line.article = number, self.blocks[number].aside, self.blocks[number].article

    def _end_line(self) -> None:
        if self.line.parts:
            self.lines.append(self.line)
        self.line = Line()
        self._place_line()

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag == "body" and not self.places["body"]:
            begun = [self.places[name][0] for name in UNSEEN if self.places[name]]
            if begun:
                self._close_from(min(begun))
        elif self.stack and self.stack[-1][0] == "head" and tag not in IN_HEAD:
            self._pop_to("head")
        if self.unseen:
            # Elements in there are kept too, so that their end tags are told from those of elements around.
            if tag not in VOID:
                self._push(tag, attrs)
            return
        if tag in CLOSES_P and self.places["p"]:
            self._pop_to("p", CLOSES_P - {"p"})
        elif tag in ("li", "dt", "dd", "tr", "td", "th", "option"):
            same = {"dt": ("dt", "dd"), "dd": ("dt", "dd"), "td": ("td", "th"), "th": ("td", "th")}.get(tag, (tag,))
            for name in same:
                self._pop_to(name, {"ul", "ol", "dl", "table", "select", "menu"} - {name})
        if tag not in INLINE:
            self._end_line()
        self.line.tags += 1
        if tag not in VOID:
            self._push(tag, attrs)
            if tag not in INLINE:
                self._place_line()
                self.line.heading = tag in HEADINGS

    def _push(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        around = self._around()
        outer = self.blocks[around]
        named = dict(attrs)
        role = (named.get("role") or "").strip().lower()
        label = f"{named.get('class') or ''} {named.get('id') or ''}".strip()
        off = (tag in ASIDE and not (tag == "header" and outer.article) or role in ASIDE_ROLES or "hidden" in named
               or named.get("aria-hidden") == "true" or bool(HIDING.search(named.get("style") or "")))
        by_name = named_aside(label, bool(outer.article)) if label and not off and tag not in ("html", "body", "article", "main") else 0
        article = outer.article
        if (tag in ARTICLE or role in ("main", "article")) and not article and not outer.aside and not off:
            self.articles += 1
            article = self.articles
        group = len(self.blocks) if tag in GROUPS else outer.group
        self.blocks.append(Block(around, outer.aside or off, article, by_name, bool(self.places["article"]), group))
        self.places[tag].append(len(self.stack))
        self.stack.append((tag, len(self.blocks) - 1))
        self.unseen += tag in UNSEEN

    def _close_from(self, place: int) -> None:
        for name, _ in self.stack[place:]:
            self.places[name].pop()
            self.unseen -= name in UNSEEN
        del self.stack[place:]

    def _pop_to(self, tag: str, barriers: frozenset | set = frozenset()) -> None:
        """Closes the innermost ``tag`` and all within it, unless a barrier stands in between."""
        if self.places[tag]:
            place = self.places[tag][-1]
            if all(not self.places[name] or self.places[name][-1] < place for name in barriers):
                self._close_from(place)

    def handle_endtag(self, tag: str) -> None:
        # An end tag of an inline element does not close blocks around it.
        barriers = ARTICLE | ASIDE | {"body", "div", "section"} if tag in INLINE or tag == "p" else frozenset()
        hidden = self.unseen
        if hidden:
            # That of an element around what is unseen ends both.
            self._pop_to(tag, barriers)
            if self.unseen:
                return
        if tag not in INLINE:
            self._end_line()
        self.line.tags += 1
        if not hidden:
            self._pop_to(tag, barriers)
        if hidden or tag not in INLINE:
            self._place_line()

    def handle_data(self, data: str) -> None:
        if self.stack and self.stack[-1][0] == "head" and data.strip():
            self._pop_to("head")
            self._end_line()
        if self.unseen:
            return
        self.line.parts.append(data)
        if self.places["a"]:
            self.line.link_chars += len("".join(data.split()))


def smoothed(values: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """Gaussian smoothing, the edges extended by their own values."""
    reach = max(1, int(np.ceil(2 * sigma)))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    padded = np.concatenate([np.full(reach, values[0]), values, np.full(reach, values[-1])])
    return np.convolve(padded, kernel / kernel.sum(), mode="valid")


def threshold(values: np.ndarray) -> float:
    """The border between two clusters of the values (two-means from their extremes)."""
    low, high = float(values.min()), float(values.max())
    for _ in range(50):
        cut = (low + high) / 2
        above = values > cut
        if above.all() or not above.any():
            return cut
        new = float(values[~above].mean()), float(values[above].mean())
        if new == (low, high):
            break
        low, high = new
    return (low + high) / 2


def densities(lines: list[Line]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """(text, text-to-tag ratio, whether it is in a dense region, whether most of it is links) of each line."""
    texts = [line.text() for line in lines]
    chars = [len(t.replace(" ", "")) for t in texts]
    ratio = np.array([max(0, n - line.link_chars) / max(1, line.tags) for n, line in zip(chars, lines, strict=True)], dtype=np.float64)
    level = smoothed(np.log1p(ratio))
    linked = np.array([2 * line.link_chars > n for n, line in zip(chars, lines, strict=True)])
    return texts, ratio, level >= min(threshold(level), np.log1p(DENSE)), linked


def not_ruled_out(lines: list[Line], blocks: list[Block]) -> list[Line]:
    """The lines that no class or id around them rules out.

    It does not where it holds the only article of the page or, not within an article and not surely
    an advert, comment or the like, most of the dense text and over eight times as much as the articles free of such names hold; if nothing is
    left otherwise, it never does.
    """
    if not any(block.named for block in blocks):
        return lines
    texts, _, dense, linked = densities(lines)
    held, articles = [0] * len(blocks), [0] * len(blocks)
    free = [not block.named for block in blocks]
    only = len({line.article for line in lines if line.article}) == 1
    for i, block in enumerate(blocks[1:], 1):
        free[i] = free[i] and free[block.around]
    total, marked = 0, 0
    for line, text, good, link in zip(lines, texts, dense & ~linked, linked, strict=True):
        if good:
            total += len(text)
            held[line.block] += len(text)
        if line.article and free[line.block] and not link:
            marked += len(text)
        articles[line.block] += bool(line.article)
    # Every block comes after the one around it.
    for i in range(len(blocks) - 1, 0, -1):
        held[blocks[i].around] += held[i]
        articles[blocks[i].around] += articles[i]
    out = [False] * len(blocks)
    for i, block in enumerate(blocks[1:], 1):
        spared = 2 * held[i] > total and held[i] > 8 * marked and block.named < 2 and not block.in_article or only and articles[i] and not block.article
        out[i] = out[block.around] or block.named > 0 and not spared
    return [line for line in lines if not out[line.block]] or lines


def content_lines(lines: list[Line], blocks: list[Block]) -> list[str]:
    """Texts of the lines that are content.

    A marked article is believed if the dense lines of all articles weigh at least half of those
    outside, or there are no dense lines: then every line counts that no block around it rules out, of the article with the most
    clustered text and of all others with a line in a content region. Otherwise the lines of the content
    regions do, if less than half of them stands in links, and those short lines that lie between
    two of them or around them in the same block, and a heading before them; a notice of rights at their
    end does not.
    """
    kept = not_ruled_out([line for line in lines if not line.aside], blocks)
    if not kept:
        return []
    texts, ratio, dense, linked = densities(kept)
    weight = Counter({line.article: 0.0 for line in kept})
    for line, r, d in zip(kept, ratio, dense & ~linked, strict=True):
        weight[line.article] += r * d
    outside = weight.pop(0, 0.0)
    if weight and 2 * sum(weight.values()) >= outside:
        best = max(sorted(weight), key=lambda a: weight[a])
        chosen = {a for a in weight if a == best or weight[a] > 0}
        return [t for t, line in zip(texts, kept, strict=True) if line.article in chosen]
    good = dense & ~linked
    if not good.any():
        good = ~linked
    where = np.flatnonzero(good)
    rights = [len(t) < 200 and bool(RIGHTS.match(t)) for t in texts]
    while len(where) > 1 and rights[where[-1]]:
        where = where[:-1]
    if not len(where):
        return []
    inside = np.zeros(len(kept), dtype=bool)
    inside[where] = True
    groups = np.array([blocks[line.block].group for line in kept])
    for a, b in zip(where, where[1:], strict=False):
        inside[a:b] |= ((b - a <= 4) | (groups[a:b] == groups[a]) & (groups[a] == groups[b])) & ~linked[a:b]
    first, last = where[0], where[-1]
    while first and groups[first - 1] == groups[where[0]] and not linked[first - 1]:
        first -= 1
    while last + 1 < len(kept) and groups[last + 1] == groups[where[-1]] and not linked[last + 1] and not rights[last + 1]:
        last += 1
    if first and kept[first - 1].heading and not linked[first - 1]:
        first -= 1
    inside[first:where[0]] = inside[where[-1]:last + 1] = True
    return [t for t, i in zip(texts, inside, strict=True) if i]


def main_text(html: str) -> str:
    """The main text of a page; lines in page order, joined by one space."""
    reader = LineReader()
    lines = reader.read(html)
    return " ".join(content_lines(lines, reader.blocks))


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every row of ``pages``, from the whole html.

    NULL and empty pages, and pages without main text, have the empty text. Repeated rows and NULL
    ids come back as they are; extra columns are ignored; an empty table gives no rows. Very long
    pages are read whole, in time linear in their length.
    """
    source = pick(pages, page_id=id_col, url=url_col, html=html_col).select("page_id", "url", F.col("html").cast("string"))

    def start():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = [main_text(h) if h else "" for h in batch.column(2).to_pylist()]
            return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

        return step

    types = {f.name: f.dataType.simpleString() for f in source.schema.fields}
    return map_batches(source, start, f"page_id {types['page_id']}, url {types['url']}, text string, n_chars long")
