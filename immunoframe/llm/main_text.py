"""Main text of a web page by its maximum-scoring subsequence.

A page becomes a sequence of words and tags. Words score positive and tags negative; one linear scan finds the
contiguous run of best total score, and the words of that run are the main text. What a word or tag scores is learned from labelled
pages (pages that name their article, see :func:`learn`): for every structural element, class, id and role, how many
words inside it belong to the content and how many do not. The log-odds are

* of a word: those of its most content-like ancestor (1 where nothing is known); 0, and left out of the text, where an ancestor is
  known as something else (menu, header, footer, side bar, notice, advert, form, reader comments);
* of a tag: the border of a content element costs ``EDGE``; other tags the log-odds of standing outside the content.

Names that the labelled pages do not show are judged by a fixed list of naming customs, which enters as pseudo-counts and
is outvoted by evidence.

Scripts, styles, comments and hidden elements are no text. Character references are decoded, white space (as ``str.split``
has it) becomes one space within a block, and blocks are joined by one space in page order. Every pattern reads a page in linear time.

Defined cases: null or empty html and pages without words give ''; a page cut off inside a tag, comment or script ends
there; end tags that match nothing are passed over and missing ones are implied; of runs of equal score the first counts; repeated
rows give equal results; an empty table gives an empty one; whatever its length, a page is read whole; columns besides
key, url and html are not looked at.
"""

from __future__ import annotations

import html as references
import math
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, frugal

#: Labelled pages that the weights are learned from, about: a share of the table chosen by a hash of key and url.
LABELLED_PAGES = 2000
#: Words' worth that the border of a content element costs.
EDGE = 50.0
#: Most that the tags of page parts and of all other elements cost.
PART_COST, TAG_COST = 12.0, 1.0
#: What a tag costs that labelled pages say nothing of; links and list items are what menus are made of.
UNKNOWN = {"a": 1.5, "li": 0.5, "ul": 0.5, "ol": 0.5, "td": 0.3, "tr": 0.3, "div": 0.3, "option": 1.0}
LEAST_COST = 0.05
#: Words that a naming custom weighs as much as, and that an element name does.
CUSTOM, NAME = 20, 1000

# Element names of the HTML standard and customary names of page parts.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = "script|style|noscript|template|svg|math|iframe|object|select|textarea|title|canvas|audio|video"
BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split())
HEAD = frozenset("head meta link base basefont bgsound title style script noscript template".split())
CONTENT_NAMES = frozenset(["article", "main", "@main", "@article", "*articlebody"])
PART_NAMES = frozenset(["nav", "aside", "header", "footer", "form", "dialog", "menu", "button", "@navigation", "@banner", "@contentinfo", "@complementary", "@search", "@dialog", "@alert"])
PAGE_PARTS = frozenset(["nav", "aside", "header", "footer"])
PART_WORDS = frozenset(
    "nav navbar navigation navi menu breadcrumb breadcrumbs footer sidebar aside widget widgets ad ads adv advert adverts advertisement sponsor sponsored "
    "promo promotion cookie cookies consent gdpr popup modal overlay newsletter subscribe signup login search share sharing social related recommended "
    "comment comments disqus respond replies reply pagination pager toolbar copyright disclaimer skip form".split())
#: These give way to a content word beside them ("article-header").
WEAK_WORDS = frozenset("header masthead banner notice alert message tags meta".split())
CONTENT_WORDS = frozenset("article content post entry story body text prose".split())
NEGATIONS = frozenset("no has with without".split())
CLOSES = {"p": frozenset(["p"]), "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "tr": frozenset(["tr", "td", "th"]), "td": frozenset(["td", "th"]), "th": frozenset(["td", "th"]), "option": frozenset(["option"])}

_TOKEN = re.compile(
    rf"""<!--.*?(?:-->|\Z)|<(?P<raw>{RAW})(?=[\s/>])[^>]*+(?:>.*?(?:</(?P=raw)(?=[\s/>])[^>]*+>|\Z)|\Z)"""
    r"""|<(?P<name>[a-z][^\s/>]*+)(?P<attr>(?:[^>=]++|=\s*+(?:"[^"]*+(?:"|\Z)|'[^']*+(?:'|\Z))?+)*+)(?:>|\Z)|</(?P<close>[a-z][^\s/>]*+)[^>]*+(?:>|\Z)|<[!?/][^>]*+(?:>|\Z)""",
    re.S | re.I)
_ATTR = re.compile(r"""(?<![^\s"'/])(class|id|role|itemprop|hidden|style|aria-hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"']+)))?(?=[\s/"']|\Z)""", re.I)
_PIECE = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


class Element(NamedTuple):
    name: str
    keys: tuple[str, ...]
    hidden: bool


def element(name: str, attr: str) -> Element:
    """An element with the names that tell what it is: its own, .class, #id, @role and *itemprop."""
    keys = [name] if name in CONTENT_NAMES or name in PART_NAMES else []
    hidden = False
    for m in _ATTR.finditer(attr) if attr.strip() else ():
        what, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if what == "class":
            keys += ["." + v for v in value.split()]
        elif what == "id":
            keys += ["#" + v for v in value.split()]
        elif what in ("role", "itemprop"):
            keys += [("@" if what == "role" else "*") + v for v in value.lower().split()]
        else:
            hidden |= what == "hidden" or (what == "aria-hidden" and value.lower() == "true") or (what == "style" and bool(re.search(r"display\s*:\s*none", value, re.I)))
    return Element(name, tuple(keys), hidden)


def custom(key: str) -> int:
    """What naming customs say of a key: content words above 0, others below, 0 if nothing."""
    if key in CONTENT_NAMES:
        return NAME
    if key in PART_NAMES:
        return -NAME
    pieces = {p.lower() for p in _PIECE.findall(key)} if key[0] in ".#" else set()
    if not pieces or pieces & NEGATIONS:
        return 0
    if pieces & PART_WORDS:
        return -CUSTOM
    if pieces & CONTENT_WORDS:
        return CUSTOM
    return -CUSTOM if pieces & WEAK_WORDS else 0


def walk(page: str) -> Iterator[tuple[str, object]]:
    """("open", Element), ("close", Element), ("void", name) and ("text", str); each open has its close."""
    stack: list[Element] = []
    open_names: Counter = Counter()

    def pop() -> tuple[str, object]:
        e = stack.pop()
        open_names[e.name] -= 1
        return "close", e

    at = 0
    for m in _TOKEN.finditer(page):
        if m.start() > at:
            yield "text", page[at : m.start()]
        at = m.end()
        if m["name"]:
            name = m["name"].lower()
            if name in VOID:
                yield "void", name
                continue
            while stack and (stack[-1].name in CLOSES.get(name, ()) or (stack[-1].name == "head" and name not in HEAD) or (stack[-1].name == "p" and name in BLOCK)):
                yield pop()
            e = element(name, m["attr"] or "")
            stack.append(e)
            open_names[name] += 1
            yield "open", e
        elif m["close"]:
            name = m["close"].lower()
            if open_names[name]:
                while stack[-1].name != name:
                    yield pop()
                yield pop()
    if at < len(page):
        yield "text", page[at:]
    while stack:
        yield pop()


class Weights(NamedTuple):
    """Log-odds by key (of the words inside an element) and costs by tag name."""

    words: dict[str, float]
    tags: dict[str, float]

    def of(self, key: str) -> float:
        """Log-odds of content within an element of that key; 0 where nothing is known."""
        w = self.words.get(key)
        if w is None:
            c = custom(key)
            w = math.copysign(math.log(1 + abs(c)), c) if c else 0.0
        return w


def tally(page: str) -> Counter:
    """(kind, key, inside) counts of a page that names its article: words by key, tags by name.

    Parts of the article that custom names something else (comments, adverts) count as outside it.
    """
    found: Counter = Counter()
    stack: list[list] = []  # element, inside, words inside and outside the content, a page part
    for kind, x in walk(page):
        inside = bool(stack) and stack[-1][1]
        part = bool(stack) and stack[-1][4]
        if kind == "text":
            if stack:
                stack[-1][2 if inside and not part else 3] += len(references.unescape(x).split())
        elif kind == "open":
            if not part:
                found["tag", x.name, inside] += 1
            stack.append([x, inside or x.name == "article", 0, 0, part or any(custom(k) < 0 for k in x.keys)])
        elif kind == "close":
            e, _, own, other, is_part = stack.pop()
            for k in e.keys:
                found["word", k, True] += own
                found["word", k, False] += other
            if stack and not (is_part and stack[-1][1] and not stack[-1][4]):  # words of a part say nothing of the article around it
                stack[-1][2] += own
                stack[-1][3] += other
    return found


def weights_of(counts: dict[tuple[str, str, bool], int]) -> Weights:
    """Log-odds with naming customs as pseudo-counts."""
    words, tags = {}, {}
    for kind, key in {(kind, key) for kind, key, _ in counts}:
        own, other = counts.get((kind, key, True), 0), counts.get((kind, key, False), 0)
        if kind == "word":
            c = custom(key)
            words[key] = math.log((1 + own + max(c, 0)) / (1 + other + max(-c, 0)))
        elif own + other >= 10:
            tags[key] = max(LEAST_COST, min(TAG_COST, math.log((1 + other) / (1 + own))))
    return Weights(words, tags)


def learn(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", about: int = LABELLED_PAGES) -> Weights:
    """Weights from pages with exactly one article element; about as many as ``about``, by a hash of key and url."""
    bounded_batches(pages.sparkSession)
    rows = max(pages.count(), 1)
    some = pages.where(F.pmod(F.xxhash64(F.col(key), F.col(url)), F.lit(rows)) < about).select(F.col(html).cast("string").alias("h")).where(F.lower("h").contains("<article"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for b in batches:
            for page in b.column(0).to_pylist():
                own = tally(page)
                if own["tag", "article", False] == 1 and not own["tag", "article", True]:
                    found.update(own)
        kinds, keys, inside = zip(*found, strict=True) if found else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.string()), pa.array(keys, pa.string()), pa.array(inside, pa.bool_()), pa.array(found.values(), pa.int64())], names=["kind", "key", "inside", "n"])

    counts = some.mapInArrow(frugal(run), "kind string, key string, inside boolean, n long").groupBy("kind", "key", "inside").agg(F.sum("n").alias("n"))
    return weights_of({(r.kind, r.key, r.inside): r.n for r in counts.collect()})


def _cost(e: Element, w: Weights, within: bool) -> float:
    """What a tag of the element takes off the score; a page part within a content element parts it no more than an advert does."""
    if any(k in CONTENT_NAMES for k in e.keys):
        return EDGE
    told = [-w.of(k) for k in e.keys]
    if told and max(told) > 0:
        return min(max(told), PART_COST if e.name in PAGE_PARTS and not within else TAG_COST)
    return w.tags.get(e.name, UNKNOWN.get(e.name, LEAST_COST))


class Open(NamedTuple):
    """An open element: what its words weigh, whether they are left out (for good), whether it stands in the content."""

    element: Element
    weight: float
    out: bool
    for_good: bool
    within: bool


def sequence(page: str, w: Weights) -> Iterator[tuple[float, str | None]]:
    """(score, text) in page order: the words of a block less its inline tags (score, block); other tags (-cost, None)."""
    root = Open(Element("", (), False), 1.0, False, False, False)
    stack = [root]
    held: list[str] = []
    gone = 0.0  # costs of the tags since the last item

    def block(weight: float) -> Iterator[tuple[float, str | None]]:
        nonlocal gone
        words = "".join(held).split()
        held.clear()
        if words or gone:
            yield len(words) * weight - gone, " ".join(words) if words else None
        gone = 0.0

    for kind, x in walk(page):
        now = stack[-1]
        if kind == "text":
            if not now.out:
                held.append(references.unescape(x))
            continue
        if kind == "void":
            if x in BLOCK:
                yield from block(now.weight)
            gone += 0.0 if now.out else w.tags.get(x, LEAST_COST)
            continue
        odds = [w.of(k) for k in x.keys]
        breaks = x.name in BLOCK or any(odds)
        if breaks:
            yield from block(now.weight)
        if kind == "close":
            stack.pop()
        around = stack[-1]
        gone += 0.0 if around.out else _cost(x, w, around.within)
        if breaks:
            yield from block(around.weight)
        if kind == "open":
            content = x.name in CONTENT_NAMES and not any(v < 0 for v in odds)
            part = bool(odds) and min(odds) < 0 and x.name not in ("html", "body")
            if x.name == "header" and around.within:  # the head of the article, not of the page
                part = any(v < 0 for k, v in zip(x.keys, odds, strict=True) if k != "header")
            for_good = around.for_good or x.hidden or (part and any(k in PART_NAMES and k != "form" for k in x.keys))
            out = for_good or part or (around.out and not content)  # an article within a wrongly named wrapper is one
            stack.append(Open(x, max([around.weight, *odds]), out, for_good, around.within or content))
    yield from block(root.weight)


def best_run(scores: list[float]) -> tuple[int, int]:
    """Begin and end of the contiguous run of best positive total, (0, 0) if there is none; the first of equal ones."""
    best, total, begin, found = 0.0, 0.0, 0, (0, 0)
    for i, s in enumerate(scores):
        if total <= 0:
            total, begin = 0.0, i
        total += s
        if total > best:
            best, found = total, (begin, i + 1)
    return found


def extract(page: str | None, w: Weights) -> str:
    """The main text of a page."""
    items = list(sequence(page or "", w))
    begin, end = best_run([s for s, _ in items])
    return " ".join(t for _, t in items[begin:end] if t)


def main_texts(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", weights: Weights | None = None) -> DataFrame:
    """key, url, text and n_chars of every page, by weights learned from the table's labelled pages unless given."""
    bounded_batches(pages.sparkSession)
    w = weights or learn(pages, key, url, html)
    own = pages.select(F.col(key), F.col(url), F.col(html).cast("string").alias("_h"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [extract(x, w) for x in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=[key, url, "text", "n_chars"])

    kinds = dict(own.dtypes)
    return own.mapInArrow(frugal(run), f"`{key}` {kinds[key]}, `{url}` {kinds[url]}, text string, n_chars long")
