"""Main text of web pages by line-block distribution.

Markup is stripped so that each block is a line; scripts, styles, menus,
headers, footers, sidebars, notices, adverts, forms and reader comments (by
element, or by a class, id or role that names nothing else) become runs of
empty lines, and lines that are mostly links count as empty.  A name alone
drops no element that holds an ``article`` or ``main`` or over ``MOST`` of the
page's text.  Text lengths are summed over sliding windows of ``WINDOW`` lines.
Where the sum rises from nothing is a surge point, where it falls back a dive
point, and the text between them is kept: inside ``article`` or ``main``
elements, or on pages without such text everywhere.  A block inside ``article``
or ``main`` of ``WINDOW`` or more lines that are all mostly links is a menu and
is dropped, unless all that text is such lines.

Character references are decoded, white space inside a line becomes one space,
and lines are joined by one line feed; nothing is cut.

Defined results: null, empty and text-free pages give the empty text; a
paragraph ends where the next block begins, and a dropped element that is never
closed where the next block or like-named element does, or else with the page; a page that ends inside a tag loses that tag; repeated rows are extracted
one by one.
"""

from __future__ import annotations

import html
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tessera.llm.blocks import bound_tables, bounded_batches

WINDOW = 3
MOST = 0.5
LINK_SHARE = 0.6

_RAW = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|textarea|title|iframe|svg|math"
                  r"|object|select|button|canvas)\b[^>]*+>.*?(?:</\1\s*+>|\Z)|<[!?][^>]*+(?:>|\Z)",
                  re.I | re.S)
_TAG = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+)>"
                  r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)([^>]*+)(?:>|\Z)|</?\Z", re.S)
_BLOCK = frozenset("address article aside blockquote body br center dd details dialog div dl dt "
                   "fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html "
                   "legend li main menu nav ol option p pre section summary table tbody td tfoot "
                   "th thead tr ul".split())
_DROP = frozenset("nav header footer aside form menu dialog head fieldset".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_MAIN = frozenset(("article", "main"))
_NAMED = re.compile(r"\b(?:class|id|role|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
#: words in names of what is not the article (this library's own list)
_JUNK = frozenset("ad ads advert adverts advertisement adbox banner sponsor sponsored promo promotion "
                  "nav navigation navbar menu breadcrumb breadcrumbs sidebar aside widget footer header "
                  "masthead cookie cookies consent notice notices gdpr popup modal overlay newsletter "
                  "subscribe subscription signup login comment comments disqus respond reply replies "
                  "share sharing social related recommended recommendations pagination pager toolbar "
                  "search copyright complementary contentinfo alert toc".split())


#: words that may stand beside those in a name without changing what it names (own list)
_PLACE = frozenset("left right top bottom upper lower main site page global primary secondary inner outer "
                   "first last box bar block area section container wrapper wrap list item items links "
                   "link button buttons form content icons icon menu group row col column text title "
                   "the js ui sticky fixed mobile desktop small large".split())
_LISTED = frozenset("li dt dd tr td th option".split())


def _names_junk(attributes: str) -> bool:
    """Whether a class, id, role or label consists of junk words, but for such as tell its place."""
    if "=" not in attributes:
        return False
    for m in _NAMED.finditer(re.sub(r"([a-z])([A-Z])", r"\1-\2", attributes)):
        for name in next(filter(None, m.groups()), "").lower().split():
            words = [w for w in re.split(r"[^a-z]+", name) if w]
            if not _JUNK.isdisjoint(words) and all(w in _JUNK or w in _PLACE or len(w) == 1 for w in words):
                return True
    return False


def _lines(page: str) -> list[tuple[str, int, bool]]:
    """(text, its length outside links, inside article or main) of each line."""
    page = _RAW.sub(lambda m: "" if m.group().startswith("<!--") else "\n", page)
    tags = []
    for m in _TAG.finditer(page):
        close, name, attributes = (m.group(1), m.group(2), m.group(3)) if m.group(2) else (
            m.group(4) or "", m.group(5) or "", m.group(6) or "")
        tags.append((m.start(), m.end(), bool(close), name.lower(), attributes))
    # where each dropped element ends: its own closing tag, counting like-named ones
    lines: list[tuple[str, int, bool]] = []
    parts: list[str] = []
    linked = 0
    links = main = 0

    def flush() -> None:
        nonlocal linked
        text = " ".join(html.unescape("".join(parts)).split())
        free = max(0, len(text) - linked)
        lines.append((text, free if free >= (1 - LINK_SHARE) * len(text) else 0, main > 0))
        parts.clear()
        linked = 0

    # the tag before which each element's content ends
    ends: dict[int, int] = {}
    open_by_name: dict[str, list[int]] = {}
    for k, (_, _, close, name, attributes) in enumerate(tags):
        if name in _VOID or attributes.endswith("/"):
            continue
        if (name in _BLOCK or name == "p") and open_by_name.get("p") and not (close and name == "p"):
            ends[open_by_name["p"].pop()] = k      # a paragraph holds no block
        if not close:
            open_by_name.setdefault(name, []).append(k)
        elif open_by_name.get(name):
            ends[open_by_name[name].pop()] = k
    # one walk back: the next block, and the next element of each name, behind each left open
    left = {k for rest in open_by_name.values() for k in rest}
    block, same = len(tags), {}
    for k in range(len(tags) - 1, -1, -1):
        name = tags[k][3]
        if k in left:
            ends[k] = same.get(name, len(tags)) if name in _LISTED else block
        block = k if name in _BLOCK else block
        same[name] = k
    # text before each tag, and main text's beginnings, summed
    size = np.cumsum([0, *(b[0] - a[1] for a, b in zip([(0, 0), *tags], tags)),
                      len(page) - (tags[-1][1] if tags else 0)])
    opens_main = np.cumsum([0, *(not t[2] and t[3] in _MAIN for t in tags)])

    def dropped(k: int) -> bool:
        _, _, close, name, attributes = tags[k]
        if close or name in _VOID:
            return False
        if name in _DROP:
            return True
        if name in ("html", "body", "article", "main") or not _names_junk(attributes):
            return False
        to = ends.get(k, len(tags))
        return bool(opens_main[to] == opens_main[k]
                    and size[min(to, len(tags)) + 1] - size[k + 1] <= MOST * size[-1])

    at, k = 0, 0
    while k < len(tags):
        start, end, close, name, attributes = tags[k]
        if start > at:
            piece = page[at:start]
            parts.append(piece)
            if links:
                linked += len(html.unescape(piece).strip())
        at = end
        if dropped(k):
            flush()
            lines += [("", 0, False)] * WINDOW
            k = ends.get(k, len(tags))
            at = tags[k][0] if k < len(tags) else len(page)
            continue
        if name in _BLOCK:
            flush()
            if name in _MAIN:
                if close:
                    lines += [("", 0, False)] * WINDOW
                main = max(0, main + (-1 if close else 1))
        elif name == "a":
            links = max(0, links + (-1 if close else 1))
        k += 1
    parts.append(page[at:])
    flush()
    return lines


def main_text(page: str | None) -> str:
    if not page:
        return ""
    lines = _lines(page)
    inside = any(m and t for t, _, m in lines)
    weight = np.array([len(t) if m else 0 for t, _, m in lines] if inside
                      else [n for _, n, _ in lines], np.int64)
    if not weight.any():
        return ""
    # sums over windows that begin at each line; a block runs from surge to dive
    total = np.concatenate((np.zeros(WINDOW, np.int64), np.cumsum(weight)))
    over = np.concatenate(([False], total[WINDOW:] - total[:-WINDOW] > 0, [False]))
    surge = np.flatnonzero(~over[:-1] & over[1:])
    dive = np.flatnonzero(over[:-1] & ~over[1:])
    found = list(zip(surge, dive))
    free = np.array([n if m else 0 for _, n, m in lines], np.int64)
    if inside and free.any():
        # a block of WINDOW or more lines that are all mostly links is a menu
        found = [(a, b) for a, b in found if free[a:b].any() or np.count_nonzero(weight[a:b]) < WINDOW]
    return "\n".join(lines[i][0] for a, b in found for i in range(a, b)
                     if lines[i][0] and (weight[i] or not inside))


def main_texts(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every row of ``pages`` (page_id, url, html)."""
    bounded_batches(pages.sparkSession)

    def run(batches):
        for batch in batches:
            texts = [main_text(p) for p in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"])

    return bound_tables(pages, "page_id", "url", "html").mapInArrow(
        run, "page_id bigint, url string, text string, n_chars bigint")
