"""HTML extraction by the line-block distribution: main text of raw pages.

Markup is stripped into lines, one for each block (paragraph, heading, item, cell, ``<br>``).
A line counts with its number of characters; lines of menus, page headers, footers, sidebars,
notices, adverts, forms and reader comments count as empty, known by tag, role, or the words
of class and id, and so do lines that are mostly links. Summed over a sliding window of lines, the
lengths surge where a text begins and dive to nothing where it ends; the lines between a surge
and its dive are text, short ones included, around the highest window and around every other whose
highest window is ``LONG``, so an advert in mid-text does not end it. Lines without visible text are
left out before the lengths are taken.

Articles that the page marks are evidence: each of their lines counts ``LONG`` more, links too, and
no window reaches over an article's edge. So sibling articles and long text outside of them stay,
and short lines outside go. An article in an element that a class or id names as around it counts as empty if an article
that stands in none is longer.

Each page is worked on by itself: nothing is shuffled, and a lost task is simply run again.

Defined cases: null or empty HTML, and a page without text, give an empty text. Markup that is
cut off or not closed ends with the page. Unknown references stay as they are. Ties between
windows go to the first. Repeated pages give the same rows each. Only the columns
named are read, so other columns cannot clash.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field
from html import unescape
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from wickwork.llm.common import map_batches

WINDOW = 3
# Characters of a window that is text although another window is higher: a short sentence.
LONG = 60

# Elements whose content is not text, elements that part blocks, and elements without an end.
_RAW = "script|style|title|noscript|template|textarea|svg|math|iframe|object|canvas|audio|video|select|button"
_BLOCKS = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead"
    " tr ul".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# An open element of these ends where one of the listed elements begins.
_ENDED_BY = {
    "p": _BLOCKS - {"br"},
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "td": {"td", "th", "tr"},
    "th": {"td", "th", "tr"},
    "tr": {"tr"},
}
# What stands around an article.
_AROUND_TAGS = frozenset("nav footer aside form menu dialog".split())
_AROUND_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar status".split())
_AROUND_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising adslot adsense banner breadcrumb breadcrumbs comment comments"
    " consent cookie cookies disclaimer disqus footer gdpr header login masthead menu modal nav navbar navigation newsletter notice"
    " notices notification pager pagination popup promo promoted promotion recommended related replies respond search share sharing"
    " sidebar signup skip social sponsor sponsored subscribe subscription teaser toolbar topbar widget".split()
)
_COMMENT_WORDS = frozenset("comment comments disqus replies respond".split())
_LAYOUT = frozenset("has is no with without".split())

_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?P<raw>{_RAW})\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-z][a-z0-9:-]*)(?P<more>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|</?[a-z!?][^>]*(?:>|\Z)",
    re.IGNORECASE | re.DOTALL,
)
_ATTRIBUTE = re.compile(r"(class|id|role|hidden|style|itemprop|aria-hidden)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.IGNORECASE)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


@dataclass
class Element:
    tag: str
    around: str = ""  # why its lines are not text: "", "tag", "class" or "comment"
    article: int = 0  # its number if it is an article
    cleared: bool = False  # whether an article in it has shown its class to be no reason
    within: tuple[bool, int, bool, bool] = (False, 0, False, False)  # what lines in it are: around, article, cleared, doubtful


@dataclass
class Line:
    parts: list[str] = field(default_factory=list)
    link: int = 0
    around: bool = False
    article: int = 0
    doubtful: bool = False  # its article is in an element whose class named it as around


def _attributes(more: str) -> dict[str, str]:
    return {m[1].lower(): unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(more)}


def _around(tag: str, attributes: dict[str, str], in_article: bool) -> str:
    if tag in _AROUND_TAGS or (tag == "header" and not in_article):
        return "tag"
    if "hidden" in attributes or attributes.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none", attributes.get("style", "")):
        return "tag"
    if attributes.get("role", "").lower() in _AROUND_ROLES:
        return "tag"
    if tag in ("html", "body", "main"):
        return ""
    reason = ""
    for name in f"{attributes.get('class', '')} {attributes.get('id', '')}".split():
        words = [w.lower() for w in _WORDS.findall(name)]
        if not words or words[0] in _LAYOUT:
            continue
        if not _COMMENT_WORDS.isdisjoint(words):
            return "comment"
        words = [w for w in words if not (w == "header" and (in_article or tag == "article"))]
        if not _AROUND_WORDS.isdisjoint(words):
            reason = "class"
    return "" if tag == "article" else reason


def _step(outside: tuple[bool, int, bool, bool], e: Element) -> tuple[bool, int, bool, bool]:
    """What lines in an element are, from what they are outside of it."""
    around, article, cleared, doubtful = outside
    cleared = cleared or e.cleared
    if e.article and (cleared > doubtful or not article):
        article, doubtful = e.article, cleared
    return around or bool(e.around), article, cleared, doubtful


def lines_of(html: str) -> list[Line]:
    """The page's lines in order, with what is known of each."""
    open_elements: list[Element] = []
    open_tags: Counter[str] = Counter()
    by_class: list[int] = []  # places of open elements that their class names as around
    lines = [Line()]
    articles = 0
    links = 0
    at = 0

    def within() -> tuple[bool, int, bool, bool]:
        return open_elements[-1].within if open_elements else (False, 0, False, False)

    def refold(first: int) -> None:
        for k in range(first, len(open_elements)):
            open_elements[k].within = _step(open_elements[k - 1].within if k else (False, 0, False, False), open_elements[k])

    def close(first: int) -> None:
        for e in open_elements[first:]:
            open_tags[e.tag] -= 1
        while by_class and by_class[-1] >= first:
            by_class.pop()
        del open_elements[first:]

    def put(text: str) -> None:
        line = lines[-1]
        line.parts.append(text)
        if links:
            line.link += len(text.strip())

    def new_line() -> None:
        if lines[-1].parts:
            lines.append(Line())
        lines[-1].around, lines[-1].article, _, lines[-1].doubtful = within()

    for m in _TOKEN.finditer(html):
        if m.start() > at:
            put(html[at : m.start()])
        at = m.end()
        tag = (m["tag"] or "").lower()
        if not tag:
            continue
        if tag == "a":
            links = max(0, links - 1) if m["end"] else links + 1
            continue
        known = len(open_elements)
        changed = False
        if m["end"]:
            for k in range(known - 1, -1, -1) if open_tags[tag] else ():
                if open_elements[k].tag == tag:
                    changed = any(e.around or e.article for e in open_elements[k:])
                    close(k)
                    break
        else:
            attributes = _attributes(m["more"]) if m["more"].strip(" /") else {}
            if open_elements and tag in _ENDED_BY.get(open_elements[-1].tag, ()):
                changed = bool(open_elements[-1].around)
                close(len(open_elements) - 1)
            in_article = within()[1] > 0
            around = _around(tag, attributes, in_article)
            is_article = not around and (
                tag in ("article", "main") or attributes.get("role") in ("main", "article") or attributes.get("itemprop") == "articleBody"
            )
            if is_article:
                for k in by_class:
                    open_elements[k].around, open_elements[k].cleared = "", True
                if by_class:
                    refold(by_class[0])
                    by_class.clear()
                if not within()[0]:
                    articles += 1
                changed = True
            if tag not in _VOID:
                if around == "class":
                    by_class.append(len(open_elements))
                open_elements.append(Element(tag, around, articles if is_article else 0))
                open_tags[tag] += 1
                refold(len(open_elements) - 1)
                changed = changed or bool(around)
        if tag in _BLOCKS or changed:
            if tag == "body" or tag in _BLOCKS:
                links = 0
            new_line()
    if at < len(html):
        put(html[at:])
    return lines


def main_text(html: str | None, window: int = WINDOW) -> str:
    """The text of a page, its blocks joined by line ends."""
    if not html:
        return ""
    lines, texts = [], []
    for line in lines_of(html):
        text = " ".join(unescape("".join(line.parts)).split())
        if text:
            lines.append(line)
            texts.append(text)
    sizes: dict[tuple[bool, int], int] = {}
    for line, text in zip(lines, texts):
        if line.article and not line.around:
            sizes[line.doubtful, line.article] = sizes.get((line.doubtful, line.article), 0) + len(text)
    longest = max((n for (doubtful, _), n in sizes.items() if not doubtful), default=0)
    usable, lengths = [], []
    for line, text in zip(lines, texts):
        outdone = line.doubtful and sizes.get((True, line.article), 0) < longest
        usable.append(not line.around and not outdone)
        if usable[-1] and line.article:
            lengths.append(LONG + len(text))
        else:
            lengths.append(len(text) if usable[-1] and 2 * line.link <= len(text) else 0)
    found = []
    for _, part in groupby(range(len(lines)), key=lambda k: lines[k].article > 0):
        part = list(part)
        found += [(part[0] + first, part[0] + last, highest) for first, last, highest in surges(lengths[part[0] : part[-1] + 1], window)]
    highest = max((f[2] for f in found), default=0)
    first_highest = next((f for f in found if f[2] == highest), None)
    kept = [f for f in found if f[2] >= LONG or f is first_highest]
    return "\n".join(texts[k] for first, last, _ in kept for k in range(first, last) if usable[k])


def surges(lengths: list[int], window: int) -> list[tuple[int, int, int]]:
    """The lines from each surge to its dive, where a whole window is empty: first, end exclusive, highest window."""
    found: list[tuple[int, int, int]] = []
    for k, length in enumerate(lengths):
        if not length:
            continue
        first, last, highest = found.pop() if found and k - found[-1][1] < window else (k, k, 0)
        found.append((first, k + 1, max(highest, sum(lengths[max(first, k + 1 - window) : k + 1]))))
    return found


def between_surge_and_dive(lengths: list[int], window: int) -> tuple[int, int]:
    """The lines around the highest window up to where a whole window is empty; end exclusive."""
    first, last, _ = max(surges(lengths, window), key=lambda f: f[2], default=(0, 0, 0))
    return first, last


def extract(pages: DataFrame, *carry: str, html: str = "html") -> DataFrame:
    """The columns of ``carry``, ``text`` and ``n_chars`` (code points)."""
    keep = len(carry)
    pages = pages.select(*[F.col(c) for c in carry], F.col(html).alias("__html"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [main_text(h) for h in batch.column(keep).to_pylist()]
        arrays = [batch.column(k) for k in range(keep)]
        arrays += [pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
        return pa.RecordBatch.from_arrays(arrays, [*carry, "text", "n_chars"])

    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in pages.schema.fields[:keep])
    return map_batches(pages, run, schema + "text string, n_chars bigint")
