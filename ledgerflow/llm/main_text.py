"""Main text of web pages as the maximum-scoring run of words and tags (operator 11).

A page becomes a sequence of words and tags. Words score by the place they
stand in, tags score negative, and one linear scan finds the contiguous run of
the greatest sum: the content region. Its texts, block by block, are the result.

Weights come from labelled pages, all those of the table that mark their own
article (``article``, ``main``, role=main, itemprop=articleBody). A place is the
block's tag, whether it is a link, and the classes around it; its words' weight
is the smoothed log odds of lying inside. A tag weighs the more, the more it is
met outside or at the border. On a page with such marks the weights of their
inside and outside are used; for the others the same counts are kept with the
marks struck out. Places never seen fall back to ``PRIOR``.

What is never article leaves before the scan, so that a long advert cannot cut
an article in two: menus, page headers, footers, sidebars, adverts, notices,
forms, reader comments, share bars, hidden elements, scripts, styles and other
raw text, told by element, role attribute or a class or id of ``NAMES``. A header
inside an article is the article's own and stays. An article inside a form,
notice, header or advert counts as article, as such elements are often left open.

Character references are decoded, white space (Unicode) inside a block becomes
one space, blocks are joined by one space; inline elements break no word.

Bounds: counting sends one row a place and task; the model keeps the ``MAX_KEYS``
places met most, and only it is broadcast. Pages are read in slices, one page
at least.

Defined cases: a null or empty page has the empty text and 0 characters; a page
without a positive word too; pages of any length are read whole, open elements,
comments and quotes end with the page; the earlier of equal regions is taken;
repeated rows give a result each; an empty table gives no rows; null ids and
urls stay null; columns other than page_id, url and html are not read.
"""
from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.common import pieces, small_batches

MAX_KEYS = 20_000
FLUSH_KEYS = 200_000
SLICE_BYTES = 4 << 20
SMOOTH = 20.0
WORD_SCALE, WORD_MOST, WORD_LEAST = 3.0, 1.0, -1.5
TAG_LEAST, TAG_MOST = 0.05, 8.0

# Fixed values of HTML: elements without content, raw text, inline elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd mark nobr q rp rt ruby s samp small "
                   "span strike strong sub sup time tt u var wbr".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
IN_HEAD = frozenset("base link meta noscript script style template title".split())
# An element that ends open ones of its kind, unless a list or table of its own begins between.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
        "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"})}

# What is never article, by element, by role attribute and by parts of class and id names.
ELEMENTS = {"nav": "menu", "header": "header", "footer": "footer", "aside": "side", "form": "form", "button": "form", "select": "form",
            "option": "form", "fieldset": "form", "dialog": "notice", "noscript": "hidden", "template": "hidden", "svg": "hidden",
            "math": "hidden", "object": "hidden", "canvas": "hidden", "audio": "hidden", "video": "hidden", "menu": "menu"}
ROLES = {"navigation": "menu", "menu": "menu", "menubar": "menu", "banner": "header", "contentinfo": "footer", "complementary": "side",
         "search": "form", "form": "form", "dialog": "notice", "alert": "notice", "alertdialog": "notice"}
NAMES = {name: role for role, names in {
    "menu": "nav navbar navigation topnav subnav sitenav menu submenu mainmenu breadcrumb breadcrumbs pagination pager toolbar share sharing social",
    "header": "header masthead topbar siteheader pageheader",
    "footer": "footer sitefooter pagefooter copyright colophon imprint",
    "side": "sidebar sidepanel aside rail related recommended recommendations trending popular widget widgets",
    "ad": "ad ads adv advert adverts advertisement advertisements advertising adbox adsense banner promo promotion sponsor sponsors sponsored",
    "form": "form search searchbox newsletter subscribe subscription login signin signup register",
    "notice": "cookie cookies consent gdpr notice notices notification notifications announcement disclaimer alert toast overlay popup modal paywall",
    "comments": "comment comments commentlist reply replies respond responses discussion disqus",
    "hidden": "hidden",
}.items() for name in names.split()}
NEGATIONS = frozenset("no has with without".split())
OPEN_ENDED = frozenset("header form notice ad".split())          # an article inside one is article all the same
# Odds of content before any page is seen, by block; a link divides them by LINK.
PRIOR = {"p": 6.0, "h": 3.0, "": 2.0, "li": 1.5, "td": 1.2, "pre": 4.0, "blockquote": 4.0, "figcaption": 4.0, "dd": 2.0, "dt": 1.5, "th": 1.2}
LINK = 8.0
INSIDE, OUTSIDE = 8.0, 1 / 8.0
# What a tag costs before any page is seen, beside TAG_LEAST.
BORDERS = frozenset(("article", "main"))
BORDER_COST, BOX_COST = 4.0, 0.55

_TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"'=]|=\s*(?:\"[^\"]*\"|'[^']*')|[=\"'])*+)(?:>|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"(?<![^\s\"'/])(class|id|role|hidden|style|itemprop)(?![^\s=/])(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_PARTS = re.compile(r"[a-z]+|[A-Z][a-z]*|[A-Z]+(?![a-z])")
_DIGITS = re.compile(r"\d+")
_UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in RAW}


def _named(name: str) -> str | None:
    """The role that a class or id name tells, by its first or last part."""
    parts = [p.lower() for p in _PARTS.findall(name)]
    if not parts or NEGATIONS.intersection(parts):
        return None
    return NAMES.get(parts[0]) or NAMES.get(parts[-1])


class _Known(dict):
    """Role and class key of an element by its name and attributes, kept for those met before."""

    def __missing__(self, key: tuple[str, str]):
        name, attrs = key
        found = {}
        for m in _ATTRIBUTE.finditer(attrs):
            found.setdefault(m[1].lower(), html.unescape(m[2] or m[3] or m[4] or ""))
        names = [*found.get("class", "").split(), *found.get("id", "").split()]
        role, marked = None, False
        if name not in ("html", "body"):
            marked = name in BORDERS or found.get("role", "").lower() == "main" or found.get("itemprop", "") == "articleBody"
            told = [r for r in map(_named, names) if r]
            role = "hidden" if "hidden" in found or _UNSEEN.search(found.get("style", "")) else ELEMENTS.get(name) or ROLES.get(found.get("role", "").lower())
            role = role or next((r for r in told if r == "comments"), None) or (told[0] if told else None)
            if name in INLINE and role not in ("ad", "hidden", "form"):
                role = None
            if marked and role != "comments" and role != "hidden":
                role = None
        out = (role, marked and role is None, _DIGITS.sub("0", " ".join(names[:3]).lower())[:60] if name not in INLINE else "")
        if len(self) < 100_000:
            self[key] = out
        return out


_KNOWN = _Known()


class Page:
    """Events of a page in order: ("r", place, text, words) for a block's text and ("t", name) for a tag.

    A place is (marked: inside a marked article, block, link, class key). What
    is never article leaves no event.
    """

    def __init__(self, source: str):
        self.events: list[tuple] = []
        self.marked = False
        self._parts: list[tuple[str, bool]] = []
        # open elements: name, role, inside a marked article, class key, block
        self._open: list[tuple[str, str | None, bool, str, str]] = [("", None, False, "", "")]
        self._read(source)

    def _flush(self) -> None:
        if not self._parts:
            return
        parts, self._parts = self._parts, []
        words = "".join(p for p, _ in parts).split()
        if not words:
            return
        linked = sum(len(p.strip()) for p, link in parts if link)
        _, role, inside, cls, block = self._place
        if role is None:
            self.events.append(("r", (inside, block, 2 * linked > sum(map(len, words)), cls), " ".join(words), len(words)))

    def _tag(self, name: str) -> None:
        if self._open[-1][1] is None:
            self.events.append(("t", name))

    def _pop_to(self, at: int) -> None:
        while len(self._open) > at:
            name, role = self._open[-1][:2]
            self._open.pop()
            if role is None and name not in INLINE:
                self._tag(name)

    def _last(self, names, stops=frozenset()) -> int | None:
        for i in range(len(self._open) - 1, 0, -1):
            if self._open[i][0] in names:
                return i
            if self._open[i][0] in stops:
                return None
        return None

    def _opened(self, name: str, attrs: str) -> None:
        if self._open[-1][0] == "head":
            if name in IN_HEAD:
                return
            self._pop_to(len(self._open) - 1)
        if name == "br" or name == "hr":
            self._parts.append((" ", False))
            return
        inline = name in INLINE
        if name in VOID:
            return
        role, marked, cls = _KNOWN[name, attrs]
        if inline and role is None:
            return
        if not inline:
            if self._open[-1][0] == "p" or self._open[-1][0] in HEADINGS and name in HEADINGS:
                self._pop_to(len(self._open) - 1)
            if name in ENDS and (at := self._last(*ENDS[name])):
                self._pop_to(at)
        above = self._open[-1]
        inside = above[2] or marked
        if marked and above[1] in OPEN_ENDED:
            above = (above[0], None, *above[2:])
        if role == "header" and inside:
            role = None
        block = "h" if name in HEADINGS else name if name in PRIOR else above[4] if inline else ""
        self.marked |= marked and above[1] is None
        now = (name, "head" if name == "head" else above[1] or role, inside, cls or above[3], block)
        if now[1] is None:
            self._tag(name)
        self._open.append(now)

    def _closed(self, name: str) -> None:
        if name == "p" and self._open[-1][0] != "p":
            return
        if at := self._last((name,), ENDS[name][1] if name in ENDS else ()):
            self._pop_to(at)

    def _read(self, source: str) -> None:
        at, link, size = 0, False, len(source)
        self._place = self._open[-1]
        while at < size:
            m = _TOKEN.search(source, at)
            end = m.start() if m else size
            if end > at:
                if not self._parts:
                    self._place = self._open[-1]
                if self._open[-1][1] is None:
                    text = source[at:end]
                    self._parts.append((html.unescape(text) if "&" in text else text, link))
            if not m:
                break
            at = m.end()
            if m[2] is None:
                continue
            name = m[2].lower()
            if name == "a":
                link = not m[1]
            if m[1]:
                if name not in INLINE:
                    self._flush()
                    self._closed(name)
                elif len(self._open) > 1 and self._open[-1][0] == name:
                    self._pop_to(len(self._open) - 1)
                continue
            if name not in INLINE and name != "br":
                self._flush()
            if name in RAW:
                stop = _RAW_END[name].search(source, at)
                at = stop.start() if stop else size
                continue
            self._opened(name, m[3])
        self._flush()


# --- weights -----------------------------------------------------------------------------------------------------

def _prior(where: str, block: str, link: bool) -> float:
    """Odds of content of a place before any page is seen."""
    odds = INSIDE if where == "in" else OUTSIDE if where == "out" else PRIOR[block]
    return odds / LINK if link and where != "in" else odds


def word_key(where: str, place: tuple, cls: str) -> str:
    return f"r\t{where}\t{place[1]}\t{int(place[2])}\t{cls}"


def tag_key(where: str, name: str) -> str:
    return f"t\t{where}\t{name}"


def page_counts(page: Page, into: Counter) -> None:
    """Words and tags of a labelled page by key and by whether they lie inside the article."""
    inside = False
    for i, e in enumerate(page.events):
        if e[0] == "r":
            inside = e[1][0]
            where = "in" if inside else "out"
            for w in (where, "none"):
                into[word_key(w, e[1], ""), inside] += e[3]
                if e[1][3]:
                    into[word_key(w, e[1], e[1][3]), inside] += e[3]
        else:
            # a tag lies inside if the texts before and after it do
            after = next((x[1][0] for x in page.events[i + 1:i + 9] if x[0] == "r"), False)
            both = inside and after and e[1] not in BORDERS
            for w in ("in" if both else "out", "none") if e[1] not in BORDERS else ("in",):
                into[tag_key(w, e[1]), both] += 1


def count_rows(pages: DataFrame) -> DataFrame:
    """key, n_in and n_out over all labelled pages."""
    def count(batches):
        held: Counter = Counter()

        def rows():
            keys = sorted({k for k, _ in held})
            out = pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array([held[k, True] for k in keys], pa.int64()),
                                              pa.array([held[k, False] for k in keys], pa.int64())], ["key", "n_in", "n_out"])
            held.clear()
            return out

        for b in pieces(batches, SLICE_BYTES):
            for source in b.column(0).to_pylist():
                if source:
                    page = Page(source)
                    if page.marked:
                        page_counts(page, held)
            if len(held) > FLUSH_KEYS:
                yield rows()
        if held:
            yield rows()

    return (pages.select(F.col("html").cast("string").alias("html")).mapInArrow(count, "key string, n_in long, n_out long")
            .groupBy("key").agg(F.sum("n_in").alias("n_in"), F.sum("n_out").alias("n_out")))


class Weights:
    """Weights of words by place and of tags by name, from counts; unseen ones from the priors."""

    def __init__(self, counts: dict[str, tuple[int, int]]):
        self.counts = counts
        self._words: dict[tuple, float] = {}
        self._tags: dict[tuple, float] = {}

    def word(self, where: str, place: tuple) -> float:
        at = (where, place[1:])
        w = self._words.get(at)
        if w is None:
            odds = _prior(where, place[1], place[2])
            share = odds / (1 + odds)
            for cls in ("", place[3]) if place[3] else ("",):
                n_in, n_out = self.counts.get(word_key(where, place, cls), (0, 0))
                share = (n_in + SMOOTH * share) / (n_in + n_out + SMOOTH)
            w = math.log(max(share, 1e-9) / max(1 - share, 1e-9)) / WORD_SCALE
            w = self._words[at] = min(WORD_MOST, max(WORD_LEAST, w))
        return w

    def tag(self, where: str, name: str) -> float:
        w = self._tags.get((where, name))
        if w is None:
            n_in, n_out = self.counts.get(tag_key(where, name), (0, 0))
            cost = BORDER_COST if name in BORDERS else 0.0 if name in PRIOR or name in HEADINGS else BOX_COST
            w = math.log((n_out + 2 * math.exp(cost)) / (n_in + 2))
            w = self._tags[where, name] = -TAG_LEAST - min(TAG_MOST, max(0.0, w))
        return w


def best_region(scores: Iterable[float]) -> tuple[int, int]:
    """First and one past the last of the contiguous scores with the greatest positive sum; (0, 0) if none is positive."""
    best, best_at, total, begin = 0.0, (0, 0), 0.0, 0
    for i, s in enumerate(scores):
        if total <= 0:
            total, begin = 0.0, i
        total += s
        if total > best:
            best, best_at = total, (begin, i + 1)
    return best_at


def page_text(source: str | None, weights: Weights) -> str:
    """The main text of one page."""
    if not source:
        return ""
    page = Page(source)
    scores = []
    inside = False
    for e in page.events:
        if e[0] == "r":
            inside = e[1][0]
            where = ("in" if inside else "out") if page.marked else "none"
            scores.append(e[3] * weights.word(where, e[1]))
        else:
            scores.append(weights.tag("in" if page.marked and (inside or e[1] in BORDERS) else "none", e[1]))
    first, last = best_region(scores)
    return " ".join(e[2] for e in page.events[first:last] if e[0] == "r" and (e[1][0] or not page.marked))


def learn(pages: DataFrame, max_keys: int = MAX_KEYS) -> dict[str, tuple[int, int]]:
    """Counts by key from all labelled pages: the ``max_keys`` keys met most."""
    total = F.col("n_in") + F.col("n_out")
    return {r["key"]: (r["n_in"], r["n_out"]) for r in count_rows(pages).orderBy(total.desc(), "key").limit(max_keys).collect()}


def extract(pages: DataFrame, counts: dict[str, tuple[int, int]] | None = None) -> DataFrame:
    """page_id, url, text and n_chars of every page; ``counts`` of another table in place of its own."""
    spark = pages.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(learn(pages) if counts is None else counts)

    def read(batches):
        weights = Weights(shared.value)
        for b in pieces(batches, SLICE_BYTES):
            texts = [page_text(source, weights) for source in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                                             ["page_id", "url", "text", "n_chars"])

    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.col("html").cast("string").alias("html")).mapInArrow(read, "page_id long, url string, text string, n_chars long")
