"""Operator 5: main text of web pages from flat text blocks and a decision tree.

A page becomes a flat list of text blocks.  A block is described by its words and link density, those of its
neighbours, whether it is a heading, and how many of the elements around it are main-content or boilerplate elements
by name, class or id (an article's own header is not boilerplate).  A decision tree trained on the small labelled table
below keeps or drops it.  Tags end as in HTML: values in quotes may hold any sign.  A link around several blocks counts
in each of them.

Edge cases: null and empty pages give an empty text; unclosed elements end with their parent, and an unclosed
script, style or comment runs to the end; broken markup is text; a page with no block that is kept gives an empty
text; repeated rows are extracted each; an empty table gives an empty result.
"""

from __future__ import annotations

import html as html_lib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm._spark import columns

# Elements whose content is never text of the page.
SILENT = "script|style|noscript|template|svg|iframe|object|textarea|select|button|title|canvas|math|datalist"
# The inside of a tag: values in quotes may hold any sign; a quote that is never closed is a sign like others.
INSIDE = r"""(?:=\s*"[^"]*"|=\s*'[^']*'|[^>])*+"""
TOKEN = re.compile(rf"""<!--.*?(?:-->|\Z)|<({SILENT})(?![^\s/>]){INSIDE}>.*?(?:</\1(?![^\s/>])[^>]*>|\Z)|<(/?)([a-z][a-z0-9:-]*)((?![^\s/>]){INSIDE})>|<[!?][^>]*>|</?[a-z][^<>]*>""", re.I | re.S)
NEXT_LINK = re.compile(r"<(/?)a(?![^\s/>])", re.I)
NAMED = re.compile(r"""\b(class|id|role|aria-label)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
INLINE = set("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q ruby rb rp rt s samp small span strike strong sub sup time tt u var wbr input".split())
EMPTY = set("area base br col embed hr img input link meta param source track wbr".split())
PARTS = {"p", "li", "dt", "dd", "td", "th", "tr", "option", "h1", "h2", "h3", "h4", "h5", "h6"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
MAIN = {"article", "main"}
BESIDE = {"nav", "footer", "aside", "form", "menu", "dialog", "fieldset"}
WORDS = re.compile(r"[a-z]+")
BESIDE_WORDS = set(
    "ad ads advert advertisement advertorial banner breadcrumb breadcrumbs comment comments cookie cookies consent disqus footer header login masthead menu modal nav navbar navigation newsletter notice alert pagination popup promo promoted "
    "recommended related reply replies respond share sharing sidebar signup skip social sponsor sponsored subscribe teaser toolbar topbar widget copyright complementary contentinfo search".split()
)
COMMENT_WORDS = {"comment", "comments", "disqus", "reply", "replies", "respond"}
#: Words of names that tell how a page is laid out (with-sidebar, header-fixed) and not what the element is.
LAYOUT_WORDS = {"with", "without", "has", "no", "fixed", "required", "enabled"}
HEAD_WORDS = {"header", "masthead", "banner"}
MAIN_WORDS = set("article content entry main post story body text".split())


def beside_words(value: str) -> set[str]:
    """The words of an attribute's names that say that an element stands beside the text: of names that are made up of such
    words by half at least (site-footer, cookie-consent, not share-price-analysis), and not of names of a layout."""
    out = set()
    for name in value.lower().split():
        words = WORDS.findall(name)
        hits = BESIDE_WORDS.intersection(words)
        if 2 * len(hits) >= len(words) and not LAYOUT_WORDS.intersection(words):
            out |= hits
    return out


@dataclass
class Block:
    text: str
    words: int
    linked: int
    heading: bool
    main: int
    beside: int


def blocks_of(page: str) -> list[Block]:
    """The flat text blocks of a page, in page order."""
    out: list[Block] = []
    outer: list[int] = []  # each block's elements beside the text, wrappers too
    # Element; elements so far that are main, boilerplate, boilerplate only by their names, and these from the last article on.
    stack: list[tuple[str, int, int, int, int]] = []
    main = beside = named_beside = inner = 0
    link = -1  # the depth of elements at which an open link began; -1: none
    wide = False  # whether that link goes on over the ends of blocks
    heading = False
    text: list[str] = []
    linked: list[str] = []

    def close() -> None:
        if text:
            body = " ".join(html_lib.unescape("".join(text)).split())
            if body:
                words = len(body.split())
                n = min(words, len(html_lib.unescape(" ".join(linked)).split()))
                card = int(wide and link >= 0 and n == words)  # a link around whole blocks leads to another page
                outer.append(beside + named_beside + card)
                out.append(Block(body, words, n, heading, main, beside + inner + card))
            text.clear()
        linked.clear()

    at = 0
    for m in TOKEN.finditer(page):
        if m.start() > at:
            piece = page[at : m.start()]
            text.append(piece)
            if link >= 0:
                linked.append(piece)
        at = m.end()
        if (name := m[3]) is None:
            continue
        name, ends = name.lower(), bool(m[2])
        if name in INLINE:
            if name == "a":
                link = -1 if ends else len(stack)
                # A link that another opening follows before its end is an unclosed one: it ends with its block.
                wide = not ends and (then := NEXT_LINK.search(page, at)) is not None and then[1] == "/"
            elif name == "br":
                text.append(" ")
            continue
        close()
        if not wide:
            link = -1
        if ends:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    del stack[i:]
                    break
                if name in PARTS and stack[i][0] not in PARTS:
                    break
        elif name not in EMPTY:
            if name in PARTS:  # ends an open part of the same kind
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] not in PARTS:
                        break
                    if stack[i][0] == name or stack[i][0] == "p" or stack[i][0] in HEADINGS:
                        del stack[i:]
                        break
            main, beside, named_beside, inner = stack[-1][1:] if stack else (0, 0, 0, 0)
            values = [a[2] or a[3] or a[4] or "" for a in NAMED.finditer(m[4])] if m[4] else []
            named = {w for v in values for w in WORDS.findall(v.lower())}
            said = {w for v in values for w in beside_words(v)}
            if main or named & MAIN_WORDS:  # an article's own header is of the article
                said -= HEAD_WORDS
            if name in BESIDE or (name == "header" and not main) or (said & COMMENT_WORDS and name not in ("body", "html")):
                beside += 1
            elif name in MAIN:
                main += 1
                inner = 0
            elif said and name not in ("body", "html"):
                named_beside += 1
                inner += 1
            elif named & MAIN_WORDS:
                main += 1
            if not m[4].endswith("/"):
                stack.append((name, main, beside, named_beside, inner))
        if link > len(stack):
            link = -1
        main, beside, named_beside, inner = stack[-1][1:] if stack else (0, 0, 0, 0)
        heading = any(s[0] in HEADINGS for s in stack[-2:])
    if at < len(page):
        text.append(page[at:])
    close()
    # What holds the page's only articles is a wrapper, whatever its name; where others stand free, it is not.
    if any(b.main and not n for b, n in zip(out, outer)):
        for b, n in zip(out, outer):
            b.beside = n
    return out


FEATURES = ("words", "link_density", "words_before", "link_density_before", "words_after", "link_density_after", "heading", "main", "beside")


def describe(blocks: list[Block]) -> list[tuple[float, ...]]:
    pairs = [(b.words, b.linked / b.words) for b in blocks]
    none = (0, 0.0)
    return [
        (*pairs[i], *(pairs[i - 1] if i else none), *(pairs[i + 1] if i + 1 < len(pairs) else none), float(b.heading), float(min(b.main, 3)), float(min(b.beside, 3)))
        for i, b in enumerate(blocks)
    ]


#: The labelled table: (features in the order above, 1 if the block is main text).  Written by hand after common layouts.
TABLE = [
    # article or main element: text of any length, headings, lists
    ((40, 0.0, 9, 0.0, 55, 0.0, 0, 1, 0), 1), ((3, 0.0, 40, 0.0, 60, 0.0, 0, 1, 0), 1), ((9, 0.0, 12, 0.0, 80, 0.0, 1, 1, 0), 1), ((2, 0.0, 1, 1.0, 70, 0.0, 1, 1, 0), 1),
    ((120, 0.05, 30, 0.0, 2, 0.0, 0, 1, 0), 1), ((6, 0.0, 7, 0.0, 6, 0.0, 0, 2, 0), 1), ((25, 0.3, 60, 0.0, 30, 0.0, 0, 2, 0), 1), ((1, 0.0, 50, 0.0, 50, 0.0, 0, 1, 0), 1),
    ((80, 0.0, 8, 0.0, 0, 0.0, 0, 1, 0), 1), ((15, 0.0, 0, 0.0, 0, 0.0, 0, 1, 0), 1), ((5, 0.0, 90, 0.0, 1, 1.0, 1, 1, 0), 1), ((12, 0.1, 80, 0.0, 12, 0.0, 0, 3, 0), 1),
    ((4, 0.0, 1, 1.0, 1, 1.0, 0, 1, 0), 1), ((60, 0.0, 1, 1.0, 12, 0.0, 0, 1, 0), 1), ((10, 0.0, 3, 1.0, 14, 0.2, 1, 1, 0), 1), ((200, 0.0, 5, 0.0, 150, 0.0, 0, 2, 0), 1),
    # measured on pages of a menu, an advert, an article and a footer
    ((1, 1.0, 0, 0.0, 1, 1.0, 0, 0, 1), 0), ((1, 1.0, 1, 1.0, 8, 0.0, 0, 0, 1), 0), ((8, 0.0, 1, 1.0, 12, 0.0, 0, 0, 1), 0), ((12, 0.0, 1, 1.0, 7, 0.0, 0, 0, 1), 0),
    ((7, 0.0, 8, 0.0, 9, 0.0, 1, 1, 0), 1), ((12, 0.0, 8, 0.0, 31, 0.0, 1, 1, 0), 1), ((9, 0.0, 7, 0.0, 24, 0.0, 0, 1, 0), 1), ((1, 0.0, 88, 0.0, 59, 0.0, 0, 1, 0), 1),
    ((64, 0.0, 5, 0.0, 9, 0.0, 0, 1, 0), 1), ((5, 0.0, 42, 0.0, 9, 0.0, 0, 1, 0), 1), ((9, 0.0, 64, 0.0, 0, 0.0, 0, 0, 1), 0), ((11, 0.0, 1, 0.0, 0, 0.0, 0, 0, 1), 0),
    # links within the article: bylines, lists of sources, and what stands next to them
    ((4, 1.0, 60, 0.0, 4, 1.0, 0, 1, 0), 1), ((2, 1.0, 2, 1.0, 2, 1.0, 0, 1, 0), 1), ((6, 1.0, 5, 1.0, 0, 0.0, 0, 2, 0), 1), ((3, 0.9, 30, 0.0, 3, 1.0, 0, 1, 0), 1),
    ((1, 1.0, 60, 0.0, 40, 0.0, 0, 1, 0), 0), ((1, 1.0, 1, 1.0, 1, 1.0, 0, 1, 0), 0), ((1, 1.0, 0, 0.0, 50, 0.0, 0, 1, 0), 0), ((1, 1.0, 90, 0.0, 0, 0.0, 0, 2, 0), 0),  # one-word links: print, share
    ((3, 0.7, 3, 0.0, 40, 0.0, 0, 1, 0), 1), ((40, 0.0, 3, 0.7, 30, 0.0, 0, 1, 0), 1), ((3, 0.0, 2, 1.0, 4, 0.0, 1, 1, 0), 1), ((3, 0.0, 9, 0.9, 20, 0.0, 1, 1, 0), 1),
    # headings and short blocks of an article after a menu of several words
    ((3, 0.0, 2, 1.0, 3, 0.0, 1, 1, 0), 1), ((4, 0.0, 3, 1.0, 2, 0.5, 1, 1, 0), 1), ((3, 0.0, 3, 1.0, 0, 0.0, 0, 1, 0), 1), ((2, 0.0, 4, 1.0, 1, 0.0, 1, 2, 0), 1), ((6, 0.0, 3, 1.0, 0, 0.0, 0, 1, 0), 1), ((4, 0.0, 2, 1.0, 2, 1.0, 0, 1, 0), 1),
    # menus, sidebars, adverts, notices, forms, footers, comments: inside or outside of the article
    ((1, 1.0, 0, 0.0, 1, 1.0, 0, 0, 1), 0), ((1, 1.0, 1, 1.0, 1, 1.0, 0, 0, 1), 0), ((8, 0.0, 1, 1.0, 9, 0.0, 0, 0, 1), 0), ((30, 0.0, 80, 0.0, 0, 0.0, 0, 0, 1), 0),
    ((70, 0.0, 6, 0.0, 60, 0.0, 0, 0, 1), 0), ((45, 0.0, 50, 0.0, 40, 0.0, 0, 0, 2), 0), ((90, 0.0, 90, 0.0, 3, 0.0, 0, 1, 1), 0), ((12, 0.0, 100, 0.0, 80, 0.0, 0, 1, 1), 0),
    ((5, 0.0, 12, 0.0, 40, 0.0, 1, 1, 1), 0), ((3, 0.0, 1, 1.0, 30, 0.0, 1, 0, 1), 0), ((55, 0.1, 4, 0.0, 60, 0.0, 0, 1, 2), 0), ((150, 0.0, 9, 0.0, 20, 0.0, 0, 0, 1), 0),
    ((6, 0.5, 90, 0.0, 0, 0.0, 0, 0, 1), 0), ((20, 0.2, 30, 0.0, 5, 0.0, 0, 0, 3), 0), ((25, 0.0, 0, 0.0, 1, 1.0, 0, 2, 1), 0), ((2, 0.0, 3, 0.0, 2, 0.0, 0, 2, 1), 0),
    # pages without such elements: long plain blocks and what stands among them
    ((60, 0.0, 50, 0.0, 70, 0.0, 0, 0, 0), 1), ((35, 0.05, 2, 1.0, 60, 0.0, 0, 0, 0), 1), ((18, 0.0, 60, 0.0, 55, 0.0, 0, 0, 0), 1), ((90, 0.1, 10, 0.0, 3, 1.0, 0, 0, 0), 1),
    ((8, 0.0, 2, 1.0, 60, 0.0, 1, 0, 0), 1), ((6, 0.0, 70, 0.0, 80, 0.0, 1, 0, 0), 1), ((7, 0.0, 50, 0.0, 40, 0.0, 0, 0, 0), 1), ((30, 0.0, 0, 0.0, 0, 0.0, 0, 0, 0), 1),
    ((40, 0.0, 12, 0.0, 0, 0.0, 0, 0, 0), 1), ((12, 0.0, 0, 0.0, 40, 0.0, 0, 0, 0), 1), ((25, 0.0, 40, 0.0, 6, 0.4, 0, 0, 0), 1), ((5, 0.0, 0, 0.0, 0, 0.0, 0, 0, 0), 1),
    ((3, 1.0, 3, 1.0, 3, 1.0, 0, 0, 0), 0), ((2, 1.0, 60, 0.0, 2, 1.0, 0, 0, 0), 0), ((5, 0.6, 40, 0.0, 4, 1.0, 0, 0, 0), 0), ((12, 0.8, 2, 1.0, 15, 0.9, 0, 0, 0), 0),
    ((40, 0.9, 3, 1.0, 5, 0.0, 0, 0, 0), 0), ((4, 0.0, 2, 1.0, 2, 1.0, 0, 0, 0), 0), ((3, 0.0, 3, 1.0, 2, 1.0, 1, 0, 0), 0), ((6, 0.0, 3, 1.0, 0, 0.0, 0, 0, 0), 0),
]


def grow(rows: list[tuple[tuple[float, ...], int]], deepest: int = 7) -> tuple:
    """A decision tree by least Gini impurity: (feature, limit, tree up to it, tree beyond) or (label,)."""
    ones = sum(y for _, y in rows)
    if not deepest or ones in (0, len(rows)):
        return (int(2 * ones >= len(rows)),)

    def impurity(part: list) -> float:
        p = sum(y for _, y in part) / len(part)
        return len(part) * p * (1 - p)

    best = None
    for k in range(len(rows[0][0])):
        values = sorted({x[k] for x, _ in rows})
        for lo, hi in zip(values, values[1:]):
            limit = (lo + hi) / 2
            left, right = [r for r in rows if r[0][k] <= limit], [r for r in rows if r[0][k] > limit]
            cost = impurity(left) + impurity(right)
            if best is None or cost < best[0] - 1e-12:
                best = (cost, k, limit, left, right)
    if best is None:
        return (int(2 * ones >= len(rows)),)
    return (best[1], best[2], grow(best[3], deepest - 1), grow(best[4], deepest - 1))


def classify(tree: tuple, x: tuple[float, ...]) -> int:
    while len(tree) > 1:
        tree = tree[2] if x[tree[0]] <= tree[1] else tree[3]
    return tree[0]


@lru_cache(maxsize=1)
def default_tree() -> tuple:
    return grow(TABLE)


def main_text(page: str | None, tree: tuple | None = None) -> str:
    blocks = blocks_of(page) if page else []
    tree = tree or default_tree()
    return "\n".join(b.text for b, x in zip(blocks, describe(blocks)) if classify(tree, x))


def extract_main_text(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", tree: tuple | None = None) -> DataFrame:
    """(page_id, url, text, n_chars) for each row of pages.  No shuffle."""
    tree = tree or default_tree()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, urls, pages_ = columns(batch, "page_id", "url", "html")
            texts = [main_text(x.as_py(), tree) for x in pages_]
            yield pa.RecordBatch.from_arrays([ids.cast(pa.int64()), urls.cast(pa.string()), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], ["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
