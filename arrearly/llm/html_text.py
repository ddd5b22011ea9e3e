"""Main text of web pages by line-block distribution.

The markup of a page is stripped into lines, one per block element, in page
order. A line's length is its characters outside links, without spaces. What is known to be
furniture (menus, headers and footers of the page, sidebars, notices, adverts, forms,
scripts, styles, reader comments; by element, role or words in class and id)
leaves ``WINDOW`` empty lines in its place, and so does everything outside
the article where the page marks one (article, main, articleBody; all of an article's text counts,
links too).

Lengths are summed over sliding windows of ``WINDOW`` lines. The text begins at a
surge point, where the sum rises from nothing, and ends at a dive point, where it
falls back to nothing; between them lies a stretch. In a marked article every
stretch is kept. Elsewhere a stretch is kept if its highest sum reaches
``SURGE`` characters or half of the page's highest, whichever is less. All
lines of a kept stretch belong to the text, short ones too.

Character references are decoded as in HTML (after the markup is stripped, so
that ``&lt;b&gt;`` stays text), white space inside a block becomes one
space, blocks are trimmed and joined by two newlines; ``br`` is white space.

Markup may be broken: unclosed elements end with their parent, stray end tags
are ignored, a tag, comment, script or style cut off by the page's end hides the
rest, as in a browser; a quote that is never closed ends with its tag. If no text is left (a page whose whole body bears a
word of furniture), the page is read again by elements alone, without class and id, and then with forms as text
(a page that is one form).

Defined results: null and empty html, and pages without text, give an empty
text. Every row is read by itself, so repeated pages, and null or repeated
page_ids, repeat; an empty table gives no rows. Other columns pass through,
also where their names are the operator's (``extract`` asks for the names of its output).
Memory follows the longest page.
"""

from __future__ import annotations

import html as references
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_rows

WINDOW = 3
SURGE = 80
BATCH_BYTES = 4 << 20

_MARKUP = re.compile(r"""<!--.*?(?:--!?>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:=\s*"[^"]*"|=\s*'[^']*'|[^>])*)(?:>|\Z)""", re.S)
_ATTRIBUTE = re.compile(r"""(?:^|\s)(class|id|role|itemprop|hidden|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?(?=\s|/|$)""", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp template svg math".split())
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
                  "form h1 h2 h3 h4 h5 h6 head header hgroup hr html li main menu nav ol option p pre search section summary table tbody td tfoot th "
                  "thead tr ul".split())
FURNITURE = frozenset("head nav menu aside footer form fieldset button select dialog object applet canvas audio video map search".split())
ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
# Words of class and id that mark furniture, and those that mark reader comments.
HINTS = frozenset("ad ads adv advert adverts advertisement advertisements advertising adsense sponsor sponsored promo promos promotion banner banners "
                  "cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe subscription signup login "
                  "search nav navbar navigation navi menu menus topbar topnav breadcrumb breadcrumbs crumbs sidebar sidebars aside widget widgets "
                  "related recommended recommendations share sharing social footer foot header masthead copyright disclaimer legal pagination pager "
                  "toolbar skip teaser teasers outbrain taboola".split())
COMMENTS = frozenset("comment comments commentlist disqus respond replies reply".split())
MAIN = frozenset("articlebody".split())
NOT_A_HINT = frozenset("has with no without is not".split())
# Elements that end an open one of the key's kind, and where the search for it stops.
_CLOSES = {"li": (("li",), frozenset(("ul", "ol", "menu", "dir"))), "option": (("option",), frozenset(("select",))),
           "tr": (("tr",), frozenset(("table",))), "td": (("td", "th"), frozenset(("table", "tr"))), "th": (("td", "th"), frozenset(("table", "tr"))),
           "dt": (("dt", "dd"), frozenset(("dl",))), "dd": (("dt", "dd"), frozenset(("dl",)))}
_BUT_P = BLOCK - {"p"}
_TABLE, _CELLS, _ALL = frozenset(("table",)), frozenset(("table", "div", "li", "td", "th")), frozenset()


def words_of(value: str) -> list[str]:
    """Lower-case words of a class or id, without those negated or owned ("has-sidebar")."""
    out = []
    for name in value.split():
        parts = [w.lower() for w in _WORD.findall(name)]
        out += [w for i, w in enumerate(parts) if not (i and parts[i - 1] in NOT_A_HINT)]
    return out


def _kind(tag: str, attributes: str, in_article: bool, hints: bool, forms: bool) -> str:
    """"furniture", "comments", "main" or "" for an element."""
    words: list[str] = []
    role = item = ""
    if attributes:
        for name, value in _ATTRIBUTE.findall(attributes):
            value = references.unescape(value.strip("\"'"))
            name = name.lower()
            if name in ("class", "id"):
                words += words_of(value)
            elif name == "role":
                role = value.strip().lower()
            elif name == "itemprop":
                item = value.strip().lower()
            elif name == "hidden" or (name == "aria-hidden" and value.strip().lower() == "true"):
                return "furniture"
    if tag in FURNITURE and (forms or tag != "form") or role in ROLES and (forms or role != "form"):
        return "furniture"
    if tag == "header" and not in_article:
        return "furniture"
    if hints and tag not in ("html", "body", "main"):
        known = set(words)
        if known & COMMENTS:
            return "comments"
        # the head of an article holds its title
        if known & (HINTS - {"header", "banner", "masthead"} if in_article else HINTS):
            return "furniture"
    if tag in ("article", "main") or role in ("main", "article") or item in MAIN:
        return "main"
    return ""


def lines(page: str, hints: bool = True, forms: bool = True) -> tuple[list[tuple[str, int, bool]], bool]:
    """The page's lines as (text, characters outside links, inside the article),
    empty ones where furniture was, and whether an article is marked. ``hints``:
    class and id tell furniture; ``forms``: forms are furniture."""
    out: list[tuple[str, int, bool]] = []
    marked = False
    stack: list[tuple[str, str]] = []  # (element, its kind)
    hidden = articles = links = 0
    block: list[str] = []
    linked = 0
    gap = False

    def flush():
        nonlocal linked, gap
        text = " ".join(references.unescape("".join(block)).split())
        block.clear()
        if text:
            if gap:
                out.extend([("", 0, False)] * WINDOW)
                gap = False
            out.append((text, max(len(text) - text.count(" ") - linked, 0), articles > 0))
        linked = 0

    def put(piece: str):
        nonlocal linked
        if hidden or not piece:
            return
        block.append(piece)
        if links:
            linked += len("".join(references.unescape(piece).split()))

    def leave(n: int):
        nonlocal hidden, articles, links
        while len(stack) > n:
            tag, kind = stack.pop()
            if tag in BLOCK:
                flush()
            if kind in ("furniture", "comments"):
                hidden -= 1
            elif kind == "main":
                articles -= 1
            if tag == "a":
                links -= 1

    def found(tag: str, stops: frozenset) -> int:
        """Place of the innermost open ``tag`` inside the innermost of ``stops``, or -1."""
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] == tag:
                return i
            if stack[i][0] in stops:
                return -1
        return -1

    def end(tag: str, stops: frozenset):
        i = found(tag, stops)
        if i >= 0:
            leave(i)

    at, size = 0, len(page)
    while at < size:
        lt = page.find("<", at)
        if lt < 0:
            put(page[at:])
            break
        put(page[at:lt])
        m = _MARKUP.match(page, lt)
        if not m:  # a lone "<" is text
            put("<")
            at = lt + 1
            continue
        at = m.end()
        tag = (m.group(2) or "").lower()
        if not tag:
            continue
        if m.group(1):
            if tag == "p":
                flush()  # also without an open one, where it stands for an empty paragraph
            end(tag, _ALL if tag in ("table", "html", "body") else _TABLE)
            continue
        attributes = m.group(3)
        if tag in RAW:
            if not (tag in ("svg", "math") and attributes.rstrip().endswith("/")):
                close = re.compile(rf"</{tag}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(page, at)
                at = close.end() if close else size
            if tag not in ("script", "style", "template"):
                put(" ")
            continue
        if tag in BLOCK:
            end("p", _BUT_P)
            flush()
        if tag in _CLOSES:
            for same in _CLOSES[tag][0]:
                end(same, _CLOSES[tag][1])
        if tag in ("br", "hr", "img"):
            put(" ")
        if tag in VOID:
            continue
        if tag == "a":
            end("a", _CELLS)  # links do not nest
            links += 1
        kind = _kind(tag, attributes, articles > 0, hints, forms)
        if kind in ("furniture", "comments"):
            put(" ")
            hidden += 1
            gap = gap or (tag in BLOCK and bool(out))
        elif kind == "main":
            articles += 1
            if hidden and not any(k == "comments" or k and t in FURNITURE for t, k in stack):
                # An article inside an element that only its class calls furniture: a wrapper.
                stack[:] = [(t, "" if k == "furniture" else k) for t, k in stack]
                hidden = 0
            marked = marked or not hidden
        # Inline elements matter where they hide something or another of their name does.
        if tag in BLOCK or tag == "a" or kind or any(t == tag for t, _ in stack[-64:]):
            stack.append((tag, kind))
    leave(0)
    flush()
    return out, marked


def stretches(lengths: np.ndarray, window: int = WINDOW) -> list[tuple[int, int, int]]:
    """(surge point, dive point, highest window sum) of each stretch of lines: the
    sums of windows that begin at a line rise from 0 and fall back to it."""
    total = np.concatenate(([0], np.cumsum(lengths)))
    ends = np.minimum(np.arange(len(lengths)) + window, len(lengths))
    sums = total[ends] - total[:-1]
    filled = lengths > 0
    # The surge is the first line with text of a run of windows with text.
    up = np.flatnonzero(np.diff(np.concatenate(([0], (sums > 0).astype(np.int8), [0]))) == 1)
    down = np.flatnonzero(np.diff(np.concatenate(([0], (sums > 0).astype(np.int8), [0]))) == -1)
    out = []
    for a, b in zip(up.tolist(), down.tolist()):
        own = a + np.flatnonzero(filled[a:b])
        out.append((int(own[0]), int(own[-1]) + 1, int(sums[a:b].max())))
    return out


def main_text(page: str | None, window: int = WINDOW, surge: int = SURGE) -> str:
    """The main text of one page."""
    for hints, forms in ((True, True), (False, True), (False, False)):
        found, marked = lines(page or "", hints, forms)
        # In a marked article links are text too, and what is outside has no length.
        lengths = np.array([(len(text) if inside else 0) if marked else plain for text, plain, inside in found], np.int64)
        runs = stretches(lengths, window)
        if runs:
            least = 1 if marked else min(surge, max(r[2] for r in runs) / 2)
            return "\n\n".join(x[0] for a, b, high in runs if high >= least for x in found[a:b] if x[0] and (x[2] or not marked))
    return ""


def extract(pages: DataFrame, html: str = "html", text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """``pages`` without its html, with the main text in ``text`` and its code points in
    ``n_chars``; other columns of these names are replaced."""
    others = [f for f in pages.schema.fields if f.name not in (html, text, n_chars)]
    schema = T.StructType([*others, T.StructField(text, T.StringType()), T.StructField(n_chars, T.LongType())])

    def run(batches):
        for b in batches:
            column = b.column(len(others))
            lo, size, out = 0, 0, []
            for i in range(b.num_rows):
                page = column[i].as_py()
                out.append(main_text(page))
                size += len(page or "")
                if size > BATCH_BYTES or i + 1 == b.num_rows:
                    part = b.slice(lo, i + 1 - lo)
                    yield pa.RecordBatch.from_arrays(
                        [part.column(i) for i in range(len(others))] + [pa.array(out, pa.string()), pa.array([len(t) for t in out], pa.int64())],
                        names=[*part.schema.names[: len(others)], text, n_chars])
                    lo, size, out = i + 1, 0, []

    quoted = lambda name: F.col("`" + name.replace("`", "``") + "`")
    return map_rows(pages.select(*[quoted(f.name) for f in others], quoted(html)), run, schema)


def contract(pages: DataFrame) -> DataFrame:
    return extract(pages.select("page_id", "url", "html"))
