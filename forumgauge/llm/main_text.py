"""Main text of web pages by line-block distribution.

Markup is stripped line by line: block elements end a line, and elements that are
not part of an article (menus, headers, footers, sidebars, notices, adverts, forms,
scripts, styles, reader comments), by name, role or the words of their class and id,
leave an empty line behind.  The lengths of the lines, without link text, are summed over
sliding windows of ``WINDOW`` lines.  Where article elements hold the page's largest sum, or a main
element has text, all text outside such elements leaves empty lines too and every line inside surges;
articles without it, such as cards of other stories, are lines like others.  Text begins at the
nearest empty window before a window's sum first surges to ``SURGE`` and ends where it dives to
nothing after the last surge; the lines between are kept, but for runs of ``WINDOW`` and more
lines that are all links.

Cases: null and empty pages, and pages of markup alone, give the empty text; a page
without markup is one block; unclosed and stray tags are read as far as they go; where
no window surges, all lines that are left are the text.  Repeated rows are extracted
each.  Nothing is cut short.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from forumgauge.llm.tables import map_batches

WINDOW = 3
SURGE = 40

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody tfoot "
    "thead tr ul".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
OUTSIDE = frozenset(
    "head nav footer aside form script style noscript template button select option textarea input label fieldset "
    "iframe object canvas audio video svg menu dialog title noembed noframes".split())
HEADER = frozenset(["header", "masthead"])
ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion menu nav "
    "navbar navigation breadcrumb breadcrumbs sidebar aside widget footer cookie cookies consent gdpr notice notices "
    "alert popup modal overlay newsletter subscribe subscription signup share sharing social related recommended "
    "comment comments commentlist disqus reply replies respond login search form toolbar pagination pager skip "
    "copyright".split())
NEVER_NAMED = frozenset(["html", "body", "main"])
# What an article element's own class or id has to say for it to be no article.
NO_ARTICLE = frozenset("ad ads advert advertisement sponsored promo comment comments reply replies widget related".split())
HEADINGS = frozenset(["h1", "h2", "h3", "h4", "h5", "h6"])

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>?", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/\"'<>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


def _unwanted(tag: str, attributes: str) -> tuple[bool, bool]:
    """Whether an element is no part of an article, and whether it is a header."""
    header = tag in HEADER
    if tag in OUTSIDE:
        return True, False
    if not attributes.strip() or tag in NEVER_NAMED:
        return header, header
    found = {k.lower(): (v or "").strip("\"'") for k, v in _ATTRIBUTE.findall(attributes)}
    names = {x.lower() for k in ("class", "id") for x in _NAME.findall(html.unescape(found.get(k, "")))}
    if tag == "article":
        names &= NO_ARTICLE
    header = header or (bool(names & HEADER) and tag not in HEADINGS)
    role = found.get("role", "").lower()
    hidden = "hidden" in found or re.search(r"display\s*:\s*none", found.get("style", ""), re.I)
    return bool(header or names & NAMES or role in ROLES or hidden), header


class _Lines:
    """Lines of one page: text, characters outside links, whether in an article (1) or the main element (2)."""

    def __init__(self):
        self.lines: list[tuple[str, int, int]] = []
        self.parts: list[str] = []
        self.linked = 0

    def end(self, inside: int) -> None:
        if self.parts:
            text = " ".join(html.unescape("".join(self.parts)).split())
            if text:
                self.lines.append((text, max(0, len(text) - self.linked), inside))
        self.parts, self.linked = [], 0

    def gap(self) -> None:
        self.lines.append(("", 0, 0))


def lines_of(page: str) -> tuple[list[tuple[str, int, int]], bool]:
    """The page's lines, and whether it marks an article."""
    out, stack, marked = _Lines(), [], False
    article = mains = dropped = links = headers = headings = at = 0

    def inside() -> int:
        return 2 if mains else 1 if article else 0

    def leave(entry: tuple[str, bool, bool]) -> None:
        nonlocal article, mains, dropped, links, headers, headings
        tag, drop, header = entry
        if tag in BLOCK or drop:
            out.end(inside())
        if drop and header:
            headers -= 1
        elif drop:
            dropped -= 1
        if drop and not article:
            out.gap()
        article -= tag in ("article", "main")
        mains -= tag == "main"
        links -= tag == "a"
        headings -= tag in HEADINGS

    def text(piece: str) -> None:
        if piece and not dropped and (not headers or article and headings):
            out.parts.append(piece)
            out.linked += len(piece) if links else 0

    while True:
        found = _TOKEN.search(page, at)
        text(page[at:found.start()] if found else page[at:])
        if not found:
            break
        at = found.end()
        closing, tag, attributes = (found[1], found[2], found[3]) if found[2] else (found[4], found[5], found[6])
        if not tag:
            continue
        tag = tag.lower()
        if closing:
            if any(entry[0] == tag for entry in stack):
                while True:
                    entry = stack.pop()
                    leave(entry)
                    if entry[0] == tag:
                        break
            elif tag in BLOCK:
                out.end(inside())
            continue
        if tag in ("br", "td", "th", "wbr"):
            if tag != "wbr":
                text(" ")
            if tag in ("br", "wbr"):
                continue
        if tag in ("p", "li", "tr", "dt", "dd") and stack and stack[-1][0] == tag:
            leave(stack.pop())
        if tag in BLOCK:
            out.end(inside())
        drop, header = _unwanted(tag, attributes)
        if tag in VOID:
            continue
        if tag in RAW:
            close = re.compile(rf"</{tag}\s*[^>]*>?", re.I).search(page, at)
            at = close.end() if close else len(page)
            continue
        if attributes.rstrip().endswith("/") and tag not in BLOCK:
            continue
        if drop:
            out.end(inside())
        stack.append((tag, drop, header))
        if drop and header:
            headers += 1
        elif drop:
            dropped += 1
        elif tag in ("article", "main") and not dropped:
            marked = True
        article += tag in ("article", "main")
        mains += tag == "main"
        links += tag == "a"
        headings += tag in HEADINGS
    out.end(inside())
    return out.lines, marked


def _sums(lengths: list[int]) -> list[int]:
    return [sum(lengths[i:i + WINDOW]) for i in range(len(lengths))]


def _holds_most(lines: list[tuple[str, int, int]]) -> bool:
    """Whether the main text is in the marked elements: a main element with text, or the articles with the largest surge."""
    if any(text and inside == 2 for text, _, inside in lines):
        return True
    within, without = (max(_sums([own if bool(inside) == side else 0 for _, own, inside in lines]), default=0)
                       for side in (True, False))
    return within >= without and any(text and inside for text, _, inside in lines)


def extract(page: str) -> str:
    """The main text of one page, one line for each block."""
    lines, marked = lines_of(page)
    marked = marked and _holds_most(lines)
    if marked:
        lines = [line if line[2] else ("", 0, 0) for line in lines]
    lengths = [len(text) if marked else own for text, own, _ in lines]
    sums = _sums(lengths)
    surges = [i for i, total in enumerate(sums) if total >= (1 if marked else SURGE)]
    if not surges:
        return "\n".join(text for text, _, _ in lines if text)
    begin, dive = surges[0], surges[-1]
    while begin and any(lengths[max(0, begin - WINDOW):begin]):
        begin -= 1
    while dive < len(sums) and sums[dive]:
        dive += 1
    links = [not any(lengths[max(0, i - WINDOW + 1):i + WINDOW]) for i in range(len(lengths))]
    return "\n".join(text for (text, _, _), link in zip(lines[begin:dive], links[begin:dive]) if text and not link)


def main_text(pages: DataFrame, page: str = "html", keys: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The keys and ``text``, one row per row."""
    schema = T.StructType([*(pages.schema[k] for k in keys), T.StructField("text", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extract(x) if x else "" for x in batch.column(len(keys)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(keys)], pa.array(texts, pa.string())],
                                             names=[*keys, "text"])

    return map_batches(pages.select(*keys, page), run, schema)
