"""Main text of web pages by a maximum-scoring subsequence.

A page is read as a row of words and tags. A word scores positive, a tag
negative: both are log odds of lying in the main text, counted on labelled
pages (the share of words, or of this tag, among all words and tags inside,
against the share outside). A linear scan over the blocks, with the tags
between them, finds the contiguous region of greatest sum; its blocks are the
text. The sign is the method's and nothing else is bounded: where labelled
pages say otherwise, a word scores ``LEAST_WORD`` and a tag ``-LEAST_TAG``.

Elements that are no part of an article whatever they score are left out
before the scan: navigation, headers, footers, sidebars, forms, notices,
adverts, reader comments, scripts and styles, named by their tag or by a word
of class, id or role. A word is a name only where no other part of its token
qualifies it (``has-sidebar``, ``comments-open``), and never of a heading, a
cell or the main element (``main``, ``article``, role main). Names of comments
and related pages hold for all but what holds ``main``; other names, and
forms, do not hold for what holds the main element.

Labelled pages are the rows of the table whose markup names its main element
(``article`` or ``main``), at most ``LABELLED_PAGES`` of them (those of least
hash; a documented bound). That element is used for the labels, and to
overrule the names of what holds it; it is never a feature of the weights.

Null, empty and text-free pages give an empty text. Unclosed and truncated
markup is read to its end. Rows are judged one by one (ties, repeated rows; of
regions with equal sums the one that ends first counts, and of those the
shortest); an empty table
gives an empty result; without labelled pages words and tags have the least
weights; other columns are ignored.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LABELLED_PAGES = 2_000
LEAST_WORD, LEAST_TAG = 0.1, 0.05

# Element names of the HTML standard by their role.
HIDDEN = frozenset("head script style noscript template svg math iframe object canvas audio video select option datalist textarea button title".split())
FURNITURE_TAGS = frozenset("nav header footer aside menu dialog".split())
FORMS = frozenset("form fieldset".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img input ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe textarea title svg math".split())
MAIN = frozenset(("article", "main"))
UNNAMED = frozenset("html body main h1 h2 h3 h4 h5 h6 td th tr tbody thead tfoot".split())
# Words of class, id and role that name what is no part of an article.
FURNITURE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion nav navbar navigation menu breadcrumb breadcrumbs masthead header footer sidebar aside widget "
    "share sharing social cookie cookies consent notice notices alert popup modal overlay newsletter subscribe subscription signup login "
    "search form pagination pager toolbar copyright legal disclaimer complementary contentinfo".split()
)
BESIDE_WORDS = frozenset("comment comments reply replies respond disqus related recommended".split())
QUALIFIERS = frozenset("has have with without no not is open opened closed enabled disabled page layout".split())
# Elements that an opening tag ends if they are still open.
_ENDS = {"p": ("p",), "li": ("li", "p"), "tr": ("tr", "td", "th", "p"), "td": ("td", "th", "p"), "th": ("td", "th", "p"), "dt": ("dt", "dd", "p"), "dd": ("dt", "dd", "p")}
_CONTAINERS = frozenset("article main section div body table ul ol dl blockquote nav header footer aside form".split())

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)|</?\Z""", re.S)
_ATTR = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
_NAME = re.compile(r"[a-z]+")


@dataclass
class Block:
    """Text between two block tags, and the tags before it (since the block before) and inside it."""

    before: list[str] = field(default_factory=list)
    inside: list[str] = field(default_factory=list)
    text: str = ""


@dataclass
class Token:
    """A tag, a stretch of text or (an empty tag) the end of a block, and what it lies in."""

    tag: str | None
    raw: str
    firm: bool  # in an element that its tag names
    named: tuple[int, ...]  # elements around it that a class, id or role names, or forms
    main: bool


class Named:
    """An element that is furniture unless it holds the main element."""

    def __init__(self, beside: bool):
        self.beside, self.holds_main, self.holds_article = beside, False, False

    @property
    def gone(self) -> bool:
        return not self.holds_main and (self.beside or not self.holds_article)


def _names(name: str, attrs: str) -> tuple[bool, bool, bool]:
    """Of an element: whether its words name furniture, name what stands beside an article, and give it the role main."""
    furniture = beside = role = False
    for m in _ATTR.finditer(attrs) if attrs else ():
        for token in m[2].strip("\"'").lower().split():
            words = _NAME.findall(token)
            role = role or (m[1].lower() == "role" and token == "main")
            if not QUALIFIERS.intersection(words):
                furniture = furniture or not FURNITURE_WORDS.isdisjoint(words)
                beside = beside or not BESIDE_WORDS.isdisjoint(words)
    if name in UNNAMED or role:
        furniture = beside = False
    if name == "article":
        furniture = False
    return furniture, beside, role


def tokens_of(page: str | None) -> tuple[list[Token], list[Named]]:
    """The page as a row of tags and texts (hidden elements left out), and its elements that may be furniture."""
    page = page or ""
    out: list[Token] = []
    named_elements: list[Named] = []
    stack: list[tuple[str, bool, bool, bool, tuple[int, ...]]] = []  # name, firm, hidden, main, named
    outside = ("", False, False, False, ())

    def put(tag: str | None, raw: str = "") -> None:
        _, firm, hidden, main, named = stack[-1] if stack else outside
        if not hidden and (raw or tag is not None):
            out.append(Token(tag, raw, firm, named, main))

    at, end = 0, len(page)
    while at < end:
        m = _TOKEN.search(page, at)
        if m is None:
            put(None, page[at:])
            break
        put(None, page[at : m.start()])
        at = m.end()
        slash, name, attrs = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not name:
            continue
        name = name.lower()
        if m[2] is None and not m[0].endswith(">"):  # a tag cut off by the page's end
            break
        if slash:
            put(name)
            if name not in INLINE:
                put("")
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    del stack[i:]
                    break
                if name in INLINE and stack[i][0] not in INLINE:
                    break
            continue
        if name not in INLINE:
            put("")
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] in _ENDS.get(name, ()):
                    del stack[i:]
                    break
                if stack[i][0] in _CONTAINERS:
                    break
        if name in RAW:
            past = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at)
            at = past.end() if past else end
            continue
        if name in VOID or attrs.rstrip().endswith("/"):
            put(name)
            if name in ("br", "hr"):
                put(None, " ")
            continue
        _, firm, hidden, main, named = stack[-1] if stack else outside
        firm, hidden = firm or name in FURNITURE_TAGS, hidden or name in HIDDEN
        furniture, beside, role = _names(name, attrs)
        if not (firm or hidden):
            if name == "main" or role:
                for i in named:
                    named_elements[i].holds_main = True
            elif name == "article" and not beside and not any(named_elements[i].beside for i in named):
                for i in named:
                    named_elements[i].holds_article = True
            if furniture or beside or name in FORMS:
                named = (*named, len(named_elements))
                named_elements.append(Named(beside))
        stack.append((name, firm, hidden, main or name in MAIN or role, named))
        put(name)
    put("")
    return out, named_elements


def _kept(page: str | None) -> list[tuple[Token, bool]]:
    """Tokens, and whether each is part of an element that leaves the page."""
    row, elements = tokens_of(page)
    gone = {i for i, e in enumerate(elements) if e.gone}
    return [(t, t.firm or not gone.isdisjoint(t.named)) for t in row]


def blocks_of(page: str | None) -> list[Block]:
    """The blocks with text, in order, without the elements that leave the page."""
    out: list[Block] = []
    now, parts = Block(), []
    for t, gone in _kept(page):
        if gone:
            continue
        if t.tag is None:
            parts.append(entities.unescape(t.raw))
        elif t.tag:
            now.inside.append(t.tag)
        else:
            now.text = " ".join("".join(parts).split())
            parts.clear()
            if now.text:
                out.append(now)
                now = Block()
            else:  # no text yet: its tags stand before the next block's
                now.before += now.inside
                now.inside = []
    return out


def count(pages: Iterable[str | None]) -> dict[tuple[str, str], list[int]]:
    """Of labelled pages: words (under one name) and tags, to counts outside and inside the main text."""
    out: dict[tuple[str, str], list[int]] = {}
    for page in pages:
        for t, gone in _kept(page):
            if t.tag is None:
                out.setdefault(("word", ""), [0, 0])[t.main and not gone] += len(entities.unescape(t.raw).split())
            elif t.tag and t.tag not in MAIN:
                out.setdefault(("tag", t.tag), [0, 0])[t.main and not gone] += 1
    return out


@dataclass(frozen=True)
class Weights:
    word: float = LEAST_WORD
    tag: dict[str, float] = field(default_factory=dict)
    other_tag: float = -LEAST_TAG

    @classmethod
    def of(cls, counts: dict[tuple[str, str], list[int]]) -> Weights:
        outside, inside = (sum(c[i] for c in counts.values()) + 1 for i in (0, 1))

        def odds(c: list[int]) -> float:
            return math.log((c[1] + 0.5) / inside) - math.log((c[0] + 0.5) / outside)

        if not counts:
            return cls()
        word = max(odds(counts.get(("word", ""), [0, 0])), LEAST_WORD)
        tag = {t: min(odds(c), -LEAST_TAG) for (kind, t), c in counts.items() if kind == "tag"}
        return cls(word, tag, min(odds([0, 0]), -LEAST_TAG))

    def of_tags(self, names: Iterable[str]) -> float:
        return sum(self.tag.get(t, self.other_tag) for t in names)

    def of_block(self, b: Block) -> float:
        return self.word * len(b.text.split()) + self.of_tags(b.inside)


def best_region(scores: list[float], gaps: list[float]) -> tuple[int, int]:
    """First and end of the contiguous blocks of greatest positive sum, with the gaps between them; (0, 0) if there is none."""
    best, region = 0.0, (0, 0)
    total, start = 0.0, 0
    for i, score in enumerate(scores):
        total += gaps[i]
        if i == start or total <= 0:  # tags before the region's first word are no part of it
            total, start = 0.0, i
        total += score
        if total > best:
            best, region = total, (start, i + 1)
        if total <= 0:
            total, start = 0.0, i + 1
    return region


def main_text(page: str | None, weights: Weights) -> str:
    blocks = blocks_of(page)
    a, e = best_region([weights.of_block(b) for b in blocks], [weights.of_tags(b.before) for b in blocks])
    return "\n".join(b.text for b in blocks[a:e])


def labelled(pages: DataFrame, key: str, html: str, bound: int) -> DataFrame:
    """Pages whose markup names the main element: at most ``bound``, of least hash."""
    named = pages.where(F.lower(html).rlike(r"<(article|main)[\s>]")).select(F.col(html).alias("html"), F.xxhash64(key, html).alias("h"))
    # only hashes are ordered; at most ``bound`` of them are broadcast
    chosen = named.select("h").distinct().orderBy("h").limit(bound)
    return named.join(F.broadcast(chosen), "h")


def _counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        got = count(b.column("html").to_pylist())
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in got], pa.string()), pa.array([k[1] for k in got], pa.string()), *(pa.array([v[i] for v in got.values()], pa.int64()) for i in (0, 1))],
            names=["kind", "feature", "outside", "inside"],
        )


def fit(pages: DataFrame, key: str = "page_id", html: str = "html", bound: int = LABELLED_PAGES) -> Weights:
    rows = labelled(pages, key, html, bound).select("html").repartition(16)
    sums = rows.mapInArrow(_counted, "kind string, feature string, outside long, inside long").groupBy("kind", "feature").agg(F.sum("outside").alias("outside"), F.sum("inside").alias("inside"))
    return Weights.of({(r["kind"], r["feature"]): [r["outside"], r["inside"]] for r in sums.collect()})  # features of ``bound`` pages


def extract(pages: DataFrame, key: str = "page_id", html: str = "html", weights: Weights | None = None, keep: tuple[str, ...] = ("url",)) -> DataFrame:
    """Per page: key, the columns to keep, ``text`` and ``n_chars`` (its code points). One pass, no shuffle."""
    weights = fit(pages, key, html) if weights is None else weights
    rows = pages.select(F.col(key).cast("long").alias(key), *keep, F.col(html).cast("string").alias("__html"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [main_text(p, weights) for p in b.column("__html").to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())], names=[*b.schema.names[:-1], "text", "n_chars"])

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    schema = ", ".join([f"`{key}` long", *(f"`{c}` {kinds[c]}" for c in keep), "text string", "n_chars long"])
    return rows.mapInArrow(run, schema)
