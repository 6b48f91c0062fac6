"""Main text of web pages, by differencing with the nearest page of the same host.

Pages of a host are sorted by URL path; each page is set against the neighbour
whose path has more in common with its own. The lines of both are aligned by a
longest common subsequence, and shared lines, which belong to the site and not
to the page, are deleted.

Sharing alone is wrong both ways: copies of an article share all lines, and
adverts differ from page to page. So shared lines inside an article element
stay, and so do those of a page without one that is a copy of its neighbour;
lines inside elements that are no article text go even if unshared.
"""

from __future__ import annotations

import bisect
import html
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.llm.neighbours import in_ranges, neighbours
from wordloom.llm.texts import NULL_ID

TOGETHER = 64
RANGE_BYTES = 64 * 1024 * 1024  # of pages in one range
TABLE_BITS = 1 << 27  # of an alignment's table, which is parted beyond that

SCHEMA = "page_id bigint, url string, text string, n_chars bigint"

# Element names of HTML by their part in a page.
MAIN = {"article", "main"}
ASIDE = {
    "nav", "footer", "aside", "form", "menu", "dialog", "button", "select", "textarea",
    "noscript", "template", "iframe", "object", "svg", "math", "canvas", "head", "title",
}
HEADER = "header"
LOOSE = {HEADER, "form"}  # may stand around a whole page
WHOLE = {"html", "body"}
RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "template", "xmp"}
CONTAINERS = ASIDE | MAIN | {
    HEADER, "body", "html", "div", "section", "ul", "ol", "dl", "table", "figure", "blockquote",
    "details", "fieldset", "center",
}
BLOCKS = CONTAINERS | {
    "p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "dt", "dd", "tr", "td", "th", "caption", "br",
    "hr", "pre", "address", "figcaption", "summary", "legend", "option",
}
VOID = {"br", "hr", "img", "input", "meta", "link", "area", "base", "col", "embed", "wbr", "source"}

# Tokens of class, id and role that mark text beside the article. Some names do so whatever
# follows them in the token; others only alone or before a word for a box. Names further inside, as in
# with-sidebar, and other words behind, as in related-work, mark nothing.
ASIDE_NAMES = re.compile(
    r"(?:(?:site|global|post|page|article|entry|reader|user)[_-])?"
    r"(?:(?:comments?|newsletters?|advert(?:s|ising|isements?)?|sponsored|cookies?|disqus|breadcrumbs?)"
    r"(?:[_-]\S*)?"
    r"|(?:ads?|sponsors?|promo(?:s|tions?|ted)?|banners?|consent|notices?|alerts?|popup|modal|subscribe"
    r"|signup|login|search|share|sharing|social|related|recommend(?:ed|ations?)|sidebar|side-bar|widget"
    r"|menu|nav(?:bar|igation)?|pagination|footer|replies|complementary|contentinfo|masthead|topbar"
    r"|skip(?:-?links?)?|toolbar)"
    r"(?:[_-](?:slot|box|unit|banner|bar|buttons?|links?|icons?|list|posts|articles|stories|form|popup|modal"
    r"|widget|menu|nav|notice|container|content|section|wrap(?:per)?|block|thread|area|panel|tools?|inner"
    r"|holder|items?|group|feed|overlay|dialog|prompt))?)",
    re.I,
)

# A tag up to its attributes; these end at the first > that is in no quotes.
OPENING = re.compile(r"<(/?)([A-Za-z][^\s/>]*)")
ATTRIBUTES = re.compile(r"(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+")
STOPS = re.compile(r"[>\"']")
ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
NAMING = {"class", "id", "role"}
NOT_SHOWN = re.compile(r"(?:^|;)\s*display\s*:\s*none\b", re.I)

# Share of the characters from which two pages without a main element are copies of each other.
COPY = 0.9

URL_PARTS = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://([^/?#]*))?([^?#]*)"


def _marks(attributes: str) -> tuple[bool, bool]:
    """Whether the attributes of an element hide it, and name it as beside the article."""
    hidden = named = False
    for found in ATTRIBUTE.finditer(attributes):
        name, value = found[1].lower(), found[2] or found[3] or found[4] or ""
        if name == "hidden":
            hidden = hidden or value.lower() in ("", "hidden", "true")
        elif name == "style":
            hidden = hidden or bool(NOT_SHOWN.search(value))
        elif name in NAMING:
            named = named or any(ASIDE_NAMES.fullmatch(x) for x in value.split())
    return hidden, named


class TagEnds:
    """Where a tag ends, for any place in a page, in time linear in the page.

    As long as tags end, each is read once. After one that does not, the places of
    all quotes and > are listed, and what follows from each is remembered, so
    that tags that never end cost nothing more.
    """

    def __init__(self, page: str):
        self.page = page
        self.stops: list[int] | None = None
        self.known: dict[int, int] = {}

    def of(self, at: int) -> int:
        """The place of the > that ends the tag whose attributes begin at ``at``, or -1."""
        if self.stops is None:
            end = ATTRIBUTES.match(self.page, at).end()
            if self.page[end : end + 1] == ">":
                return end
            self.stops = [found.start() for found in STOPS.finditer(self.page)]
            self.last = {quote: self.page.rfind(quote) for quote in "\"'"}
        passed, end = [], -1
        while True:
            place = bisect.bisect_left(self.stops, at)
            if place == len(self.stops):
                break
            stop = self.stops[place]
            if stop in self.known:
                end = self.known[stop]
                break
            passed.append(stop)
            if self.page[stop] == ">":
                end = stop
                break
            if stop >= self.last[self.page[stop]]:
                break
            at = self.page.index(self.page[stop], stop + 1) + 1
        self.known.update(dict.fromkeys(passed, end))
        return end


def lines_of(page: str) -> list[tuple[str, bool, bool]]:
    """(text, in an article, beside the article) of each block of a page, in time linear in it."""
    out: list[tuple[str, bool, bool]] = []
    text: list[str] = []
    # Of each open element its name, whether it is in main text and in an article, and whether it
    # is beside the article: for good, or until an article or main begins inside it.
    stack: list[tuple[str, bool, bool, bool, bool]] = [("", False, False, False, False)]
    open_names: Counter[str] = Counter()

    def flush() -> None:
        line = " ".join("".join(text).split())
        if line:
            _, main, _, aside, until = stack[-1]
            out.append((line, main, aside or until))
        text.clear()

    at, size = 0, len(page)
    ends, last = TagEnds(page), page.rfind(">")
    while at < size:
        if page[at] != "<":
            end = page.find("<", at)
            end = size if end < 0 else end
            text.append(html.unescape(page[at:end]))
            at = end
            continue
        if page.startswith("<!--", at):
            end = page.find("-->", at + 4)
            at = size if end < 0 else end + 3
            continue
        if page.startswith(("<!", "<?"), at) and at < last:
            at = page.index(">", at) + 1
            continue
        found = OPENING.match(page, at)
        end = ends.of(found.end()) if found and at < last else -1
        if end < 0:  # no tag, or one that never ends
            text.append("<")
            at += 1
            continue
        (closing, name), attributes = found.groups(), page[found.end() : end]
        at, name = end + 1, name.lower()
        if name in BLOCKS:
            flush()
        if closing:
            if name in CONTAINERS and open_names[name]:
                while (gone := stack.pop()[0]) != name:
                    open_names[gone] -= 1
                open_names[name] -= 1
            continue
        if name in RAW:
            found = re.compile(rf"</{name}\b[^>]*>?", re.I).search(page, at)
            at = found.end() if found else size
            continue
        if name in CONTAINERS and name not in VOID and not attributes.endswith("/"):
            _, main, article, aside, until = stack[-1]
            hidden, named = _marks(attributes)
            if name in MAIN:
                until = until and article
            elif name in LOOSE:
                until = until or name != HEADER or not main
            if name not in MAIN and name not in WHOLE:
                until = until or named
            aside = aside or (name in ASIDE and name not in LOOSE) or (hidden and name not in WHOLE)
            stack.append((name, main or name in MAIN, article or name == "article", aside, until))
            open_names[name] += 1
    flush()
    return out


def shared(a: list[str], b: list[str]) -> list[bool]:
    """Which lines of ``a`` a longest common subsequence with ``b`` holds.

    Lines that both begin or end with belong to one, and lines that only one has to
    none; the others are aligned in parts whose tables fit a bound.
    """
    out = [False] * len(a)
    first, last, last_b = 0, len(a), len(b)
    while first < min(last, last_b) and a[first] == b[first]:
        out[first] = True
        first += 1
    while min(last, last_b) > first and a[last - 1] == b[last_b - 1]:
        last, last_b = last - 1, last_b - 1
        out[last] = True
    both = set(a[first:last]) & set(b[first:last_b])
    places = [i for i in range(first, last) if a[i] in both]
    own, other = [a[i] for i in places], [line for line in b[first:last_b] if line in both]
    for i, hit in zip(places, _aligned(own, other)):
        out[i] = hit
    return out


def _rows(a: list[str], b: list[str]) -> Iterator[int]:
    """After each line of ``a``, bits that are 0 where the common length grows at line j of ``b``."""
    where: dict[str, list[int]] = {}
    for j, line in enumerate(b):
        where.setdefault(line, []).append(j)
    masks = {line: _bits(places) for line, places in where.items()}
    full = (1 << len(b)) - 1
    row = full
    for line in a:
        both = row & masks.get(line, 0)
        row = ((row + both) | (row - both)) & full
        yield row


def _bits(places: list[int]) -> int:
    raw = bytearray(places[-1] // 8 + 1)
    for j in places:
        raw[j >> 3] |= 1 << (j & 7)
    return int.from_bytes(raw, "little")


def _lengths(a: list[str], b: list[str]) -> np.ndarray:
    """The common length of ``a`` with the first 0, 1, ... lines of ``b``."""
    row = (1 << len(b)) - 1
    for row in _rows(a, b):
        pass
    raw = np.frombuffer(row.to_bytes(len(b) // 8 + 1, "little"), np.uint8)
    grows = 1 - np.unpackbits(raw, bitorder="little")[: len(b)].astype(np.int64)
    return np.concatenate([[0], np.cumsum(grows)])


def _aligned(a: list[str], b: list[str]) -> list[bool]:
    """``shared`` by bit-parallel rows; a table beyond the bound is parted where halves of ``a`` meet."""
    out, todo = [False] * len(a), [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        if a0 == a1 or b0 == b1:
            continue
        if a1 - a0 > 1 and (a1 - a0) * (b1 - b0) > TABLE_BITS:
            middle = (a0 + a1) // 2
            before = _lengths(a[a0:middle], b[b0:b1])
            behind = _lengths(a[middle:a1][::-1], b[b0:b1][::-1])[::-1]
            cut = b0 + int((before + behind).argmax())
            todo += [(a0, middle, b0, cut), (middle, a1, cut, b1)]
            continue
        rows = list(_rows(a[a0:a1], b[b0:b1]))
        i, j = a1, b1
        while i > a0 and j > b0:
            if a[i - 1] == b[j - 1]:
                out[i - 1] = True
                i, j = i - 1, j - 1
            elif rows[i - 1 - a0] >> (j - 1 - b0) & 1:
                j -= 1
            else:
                i -= 1
    return out


def _common(a: str, b: str) -> int:
    for n, (x, y) in enumerate(zip(a, b)):
        if x != y:
            return n
    return min(len(a), len(b))


def main_text(
    own: list[tuple[str, bool, bool]], other: list[tuple[str, bool, bool]] | None
) -> str:
    """The lines of a page that are its own, set against those of its neighbour.

    Of two pages without a main element that share nearly all text, one is a copy
    of the other, and what they share tells nothing: then shared lines stay.
    """
    texts = [line for line, _, _ in own]
    common = shared(texts, [line for line, _, _ in other]) if other else [False] * len(own)
    has_main = any(main and not aside for _, main, aside in own)
    if other and not has_main:
        size, size_other, both = (
            sum(len(line) for line, _, aside in page if not aside)
            for page in (own, other, [x for x, c in zip(own, common) if c])
        )
        if both >= COPY * max(size, size_other):
            common = [False] * len(own)
    kept = []
    for (line, main, aside), both in zip(own, common):
        if aside or (has_main and not main) or (both and not main):
            continue
        kept.append(line)
    return "\n".join(kept)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in neighbours(batches, TOGETHER):
        texts = []
        for before, row, after in rows:
            beside = [x for x in (before, after) if x is not None and x["_host"] == row["_host"]]
            nearest = max(beside, key=lambda x: _common(x["_path"], row["_path"]), default=None)
            for page in (row, nearest):
                if page is not None and "lines" not in page:
                    page["lines"] = lines_of(page["html"] or "")
            texts.append(main_text(row["lines"], nearest and nearest["lines"]))
        yield pa.record_batch(
            [
                pa.array([row["page_id"] for _, row, _ in rows], pa.int64()),
                pa.array([row["url"] for _, row, _ in rows], pa.string()),
                pa.array(texts, pa.string()),
                pa.array([len(text) for text in texts], pa.int64()),
            ],
            names=["page_id", "url", "text", "n_chars"],
        )


def extract_main_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars), one row per row of ``pages``.

    Null html counts as empty and gives the empty text. A null url is a host of
    its own without a name; a page alone in its host has no neighbour, and
    nothing of it counts as shared. Ids may be null or repeated. Other columns
    are not read. The text does not depend on how rows are partitioned.
    """
    url = F.coalesce(F.col("url").cast("string"), F.lit(""))
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"),
        "url",
        "html",
        F.lower(F.regexp_extract(url, URL_PARTS, 1)).alias("_host"),
        F.regexp_extract(url, URL_PARTS, 2).alias("_path"),
        F.xxhash64(url, F.coalesce("html", F.lit(""))).alias("_tie"),
    )
    number = F.hex(F.coalesce("page_id", F.lit(NULL_ID)))
    key = F.concat_ws("\x01", "_host", "_path", F.lpad(number, 16, "0"))
    size = F.coalesce(F.octet_length("html"), F.lit(0))
    bytes_ = pages.agg(F.sum(size.cast("bigint"))).first()[0] or 0
    rows = in_ranges(rows.withColumn("_key", key), "_key", "_tie", least=-(-bytes_ // RANGE_BYTES))
    return rows.mapInArrow(_extract, SCHEMA)
