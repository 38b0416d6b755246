"""Main text of web pages by structure and by differencing each page against its nearest neighbour on the same host.

1. A page is read into lines, one for each block that has text; elements that never hold the article (menus, headers,
   footers, sidebars, notices, adverts, forms, scripts, styles, reader comments) are left out.
2. Pages are ordered by host and URL path, in ranges, so that a host of any size is dealt over many tasks. A page's
   partner is the neighbour in that order, on the same host, whose path agrees longest.
3. The lines of both are aligned by a longest common subsequence. Lines that both have are the host's template and
   are deleted. Where a page names its article (`article` elements, else `main`), the lines that are left tell which of these
   elements are the page's own: those keep all their lines, since two articles may quote the same passage, and an element that
   the neighbour has too is template like any other line. Outside them nothing stays. A page whose elements are all shared keeps them.

Defined results: null, empty or text-free html gives an empty text; a null or hostless URL, a host with one page, or the
only page of a host in its range has no partner, and then structure alone decides; a neighbour with exactly the same
lines is a copy and no partner: the page before it is, if it differs; repeated pages are rows of their own; other columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import shuffle_width

_TAG = re.compile(r"<!--.*?(?:-->|$)|<!\[CDATA\[(.*?)\]\]>|<([/!?]?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?/][^>]*>", re.S)
_NAMED = re.compile(r"""\b(class|id|role|hidden|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_RAW = frozenset("script style noscript template textarea title svg math iframe object canvas select".split())
_NEVER = frozenset("head nav footer aside form button menu dialog figure-menu".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
#: Words in class, id or role that name something other than the article.
_OTHER = frozenset(
    "ad ads adv advert advertisement advertising adsense banner sponsor sponsored promo promotion promoted nav navbar navigation menu menubar "
    "breadcrumb breadcrumbs sidebar aside complementary contentinfo footer header masthead topbar toolbar cookie cookies consent gdpr notice "
    "notification alert popup modal overlay subscribe newsletter signup login search form share sharing social comment comments disqus "
    "respond replies related recommended recommendations pagination pager skip widget copyright".split())
_WORD = re.compile(r"[a-z]+")
_SPACE = re.compile(r"\s+")

Line = tuple[str, bool]


def _is_other(name: str, attributes: str, in_article: bool) -> bool:
    """Whether an element holds something else than the article."""
    if name in _NEVER or name == "header" and not in_article:
        return True
    if not attributes or name in ("html", "body", "article", "main"):
        return False
    for key, value in _NAMED.findall(attributes):
        key = key.lower()
        if key == "hidden" or key == "aria-hidden" and value.strip("\"'").lower() == "true":
            return True
        if key in ("class", "id", "role"):
            words = _WORD.findall(value.lower())
            if any(w in _OTHER and not (in_article and w in ("header", "alert", "notice") and name in ("h1", "h2", "p")) for w in words):
                return True
    return False


def lines_of(page: str | None) -> tuple[list[str], list[int] | None]:
    """All lines of a page that aren't structurally something else, and the number of the outermost article that each lies in (0: in none; None: the page names none)."""
    if not page:
        return [], None
    lines: list[tuple[str, int, int]] = []
    now: list[str] = []
    article = main = 0
    named = {"article": 0, "main": 0}
    skip, depth, at = "", 0, 0

    def end_line():
        if now:
            text = _SPACE.sub(" ", html.unescape("".join(now))).strip()
            now.clear()
            if text:
                lines.append((text, named["article"] if article else 0, named["main"] if main else 0))

    n = len(page)
    while at < n:
        m = _TAG.search(page, at)
        if m is None:
            if not skip:
                now.append(page[at:])
            break
        if not skip and m.start() > at:
            now.append(page[at:m.start()])
        at = m.end()
        if m[1] is not None and not skip:
            now.append(html.escape(m[1], False))
        if not m[3]:
            continue
        name, closing, attributes = m[3].lower(), m[2] == "/", m[4]
        if m[2] in ("!", "?"):
            continue
        if skip:
            if name == skip:
                depth += -1 if closing else 0 if attributes.endswith("/") else 1
                if depth == 0:
                    skip = ""
                continue
            # an element that was never closed ends where the article or the page's end begins
            if not (name in ("article", "main") and not closing or name in ("body", "html") and closing or name == "body" and skip == "head"):
                continue
            skip = ""
        if closing:
            if name not in _INLINE:
                end_line()
            if name == "article":
                article = max(0, article - 1)
            elif name == "main":
                main = max(0, main - 1)
            continue
        if name in _RAW:
            close = re.compile(rf"</{name}\s*>", re.I).search(page, at)
            at = close.end() if close else n if name in ("script", "style") else at
            continue
        if name not in _VOID and not attributes.endswith("/") and _is_other(name, attributes, article > 0 or main > 0):
            end_line()
            skip, depth = name, 1
            continue
        if name == "br":
            now.append(" ")
        elif name not in _INLINE:
            end_line()
        if name == "article":
            article, named["article"] = article + 1, named["article"] + (article == 0)
        elif name == "main":
            main, named["main"] = main + 1, named["main"] + (main == 0)
    end_line()
    texts = [t for t, _, _ in lines]
    if any(a for _, a, _ in lines):
        return texts, [a for _, a, _ in lines]
    if any(x for _, _, x in lines):
        return texts, [x for _, _, x in lines]
    return texts, None


def _row(a: list[int], where: dict[int, int], width: int) -> Iterator[int]:
    """After each of a's items, a bit row of the common-subsequence table: zero bits stand where it grows."""
    full = (1 << width) - 1
    v = full
    for x in a:
        u = v & where.get(x, 0)
        v = ((v + u) | (v - u)) & full
        yield v


def _places(b: list[int]) -> dict[int, int]:
    where: dict[int, int] = {}
    for k, x in enumerate(b):
        where[x] = where.get(x, 0) | 1 << k
    return where


def _grown(row: int, width: int) -> np.ndarray:
    """Lengths of the longest common subsequence with each beginning of b, from its bit row."""
    bits = np.unpackbits(np.frombuffer(row.to_bytes((width + 7) // 8, "little"), np.uint8), bitorder="little")[:width]
    return np.concatenate([[0], np.cumsum(bits == 0)])


def common(a: list[int], b: list[int], most_bits: int = 1 << 27) -> list[int]:
    """Places in a of a longest common subsequence of a and b, with rows of bits; halves a where they'd take much memory."""
    head = 0
    while head < len(a) and head < len(b) and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < len(a) - head and tail < len(b) - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    x, y = a[head:len(a) - tail], b[head:len(b) - tail]
    middle: list[int] = []
    if x and y:
        if len(x) * len(y) > most_bits and len(x) > 1:
            half = len(x) // 2
            *_, up = _row(x[:half], _places(y), len(y))
            *_, down = _row(x[half:][::-1], _places(y[::-1]), len(y))
            cut = int(np.argmax(_grown(up, len(y)) + _grown(down, len(y))[::-1]))
            middle = common(x[:half], y[:cut], most_bits) + [half + k for k in common(x[half:], y[cut:], most_bits)]
        else:
            rows = list(_row(x, _places(y), len(y)))
            i, j = len(x) - 1, len(y) - 1
            while i >= 0 and j >= 0:
                if x[i] == y[j]:
                    middle.append(i)
                    i, j = i - 1, j - 1
                elif i > 0 and not rows[i - 1] >> j & 1 or i > 0 and _count(rows[i - 1], j) == _count(rows[i], j):
                    i -= 1
                else:
                    j -= 1
            middle.reverse()
    return [*range(head), *(head + k for k in middle), *range(len(a) - tail, len(a))]


def _count(row: int, j: int) -> int:
    """Length for beginnings up to place j: zero bits among the lowest j + 1."""
    return j + 1 - (row & (1 << j + 1) - 1).bit_count()


class Page:
    def __init__(self, number, url, host: str, path: str, source: str | None):
        self.number, self.url, self.host, self.path = number, url, host, path
        self.lines, self.article = lines_of(source)
        self.before: Page | None = None  # the last page before it in order whose lines differ

    def agreement(self, other: Page | None) -> int:
        """Path steps that two pages of a host share from the start; -1 without a common host."""
        if other is None or not self.host or other.host != self.host:
            return -1
        n = 0
        for a, b in zip(self.path.split("/"), other.path.split("/")):
            if a != b:
                break
            n += 1
        return n

    def text(self, after: Page | None) -> str:
        """Lines that the nearest differing neighbour doesn't share; of a page that names articles, all of those that hold such lines."""
        near = sorted((p for p in (self.before, after) if self.agreement(p) >= 0), key=lambda p: -self.agreement(p))
        partner = next((p for p in near if p.lines != self.lines), None)
        shared: set[int] = set()
        if partner is not None:
            numbers: dict[str, int] = {}
            code = [[numbers.setdefault(x, len(numbers)) for x in p.lines] for p in (self, partner)]
            shared = set(common(*code))
        if self.article is None:
            return "\n".join(x for k, x in enumerate(self.lines) if k not in shared)
        own = {e for k, e in enumerate(self.article) if e and k not in shared} or set(self.article) - {0}
        return "\n".join(x for x, e in zip(self.lines, self.article) if e in own)


def _extract(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pages in order of host and path; at any time three of them are held, or four next to copies."""
    def rows():
        for batch in batches:
            for r in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "_host", "_path", "html"))):
                yield Page(*r)
        yield None

    page = None
    out: list[tuple] = []
    size = 0
    for after in rows():
        if page is not None:
            out.append((page.number, page.url, page.text(after)))
            size += len(out[-1][2])
        if out and (after is None or len(out) >= 2000 or size > 4_000_000):
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in out], pa.int64()), pa.array([r[1] for r in out], pa.string()), pa.array([r[2] for r in out], pa.string())],
                ["page_id", "url", "text"])
            out, size = [], 0
        if page is not None and after is not None:
            differ = after.lines != page.lines
            after.before = page if differ else page.before
            if differ:
                page.before = None  # no longer chain than one
        page = after


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url and main text of every page."""
    url = F.coalesce(F.col("url"), F.lit(""))
    keyed = pages.select(
        F.col("page_id").cast("long").alias("page_id"), "url", "html",
        F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)).alias("_host"),
        F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1).alias("_path"))
    ordered = keyed.repartitionByRange(shuffle_width(pages.sparkSession), "_host", "_path", "url", "page_id") \
        .sortWithinPartitions("_host", "_path", "url", "page_id")
    return ordered.mapInArrow(_extract, "page_id long, url string, text string")
