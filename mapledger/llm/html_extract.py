"""Main text of web pages, with site templates removed.

A task parses each page once, in time that grows with its length, into blocks of text and the hashes of the element
subtrees that hold them, each made of its children's. Spark counts on how many pages of a host, of distinct main texts, each subtree occurs; subtrees on several are the
site's template, and blocks inside them are taken out, on every page and inside and outside its article alike. What
markup itself names as no part of an article (menus, headers, footers, asides, notices, adverts, forms,
comments, scripts) is left out while parsing. Inside an article or main element only containers are counted,
as its paragraphs, headings and rows may well recur on other pages, and no subtree around the whole of such
an element is template.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from html import unescape
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mapledger.operators.joins import split_join
from mapledger.session import written

from .common import text_or_empty

# HTML's elements by how they are read.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript template svg math".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q ruby rb rt rp s samp small "
    "span strike strong sub sup time tt u var wbr".split()
)
OPENED_BY_BLOCK = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 "
    "h6 header hr main menu nav ol p pre section table ul".split()
)
CLOSED_BY_SAME = {
    "li": ("li", "ul ol menu"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "tr": ("tr td th", "table"),
    "td": ("td th", "tr table"), "th": ("td th", "tr table"), "option": ("option", "select"),
}
# Elements and words in class, id or role that are no part of an article.
ASIDE_TAGS = RAW | frozenset("nav footer aside form button select dialog menu head object audio video canvas".split())
ASIDE_WORDS = frozenset(
    "ad ads adv advert advertisement advertising sponsor sponsored promo promotion banner breadcrumb breadcrumbs comment "
    "comments disqus cookie cookies consent gdpr footer header masthead menu nav navbar navigation newsletter notice notices "
    "pagination pager popup modal overlay related recommended share sharing sidebar social subscribe subscription toolbar "
    "widget complementary contentinfo navigation search alert reply replies respond".split()
)

# Names that, as the id of an element in an article, are not likely to be made from a heading's words.
ASIDE_IDS = frozenset(
    "ad ads adv advert breadcrumb breadcrumbs comment comments contentinfo cookie cookies disqus footer gdpr masthead nav navbar "
    "pager pagination respond sidebar".split()
)

# Elements that, inside an article, are its own text and not a container that a site puts there.
OWN_TEXT = frozenset(
    "p h1 h2 h3 h4 h5 h6 pre blockquote li dt dd caption thead tbody tfoot tr td th figure figcaption details summary address "
    "center".split()
)

# An article element may be a reader's comment.
_MARKED_ARTICLE = frozenset("comment comments reply replies".split())

# Markup at a "<". Quantifiers are possessive, so a look at a place takes one pass; after a tag whose quotes never close,
# quotes mean nothing any more, so such a look is taken once.
_COMMENT = re.compile(r"<!--(?:.*?--!?>|.*+)", re.S)
_DATA = re.compile(r"<!\[CDATA\[(.*?)\]\]>", re.S)
_DECLARATION = re.compile(r"<[!?][^>]*+>")
_TAG_START = re.compile(r"</?[A-Za-z]")
_TAG = re.compile(r"<(?P<end>/?)(?P<tag>[A-Za-z][^\s/>]*+)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>")
_LOOSE_TAG = re.compile(r"<(?P<end>/?)(?P<tag>[A-Za-z][^\s/>]*+)(?P<rest>[^>]*+)>")
_NAMES = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_HIDDEN = re.compile(r"(?:^|\s)(?:hidden(?:\s|=|$)|aria-hidden\s*=\s*[\"']?true)", re.I)
_SPACE = re.compile(r"\s+")
_MAIN = frozenset(("article", "main"))


def _aside(tag: str, rest: str, in_main: bool) -> bool:
    """Whether an element is by its markup no part of an article.

    Names such as ``has-sidebar`` tell of something else inside the element. The header of an article holds its title.
    Inside an article, an element of its own text is never left out for its names, and a container only for a whole name, as
    ``search-results`` or ``related-work`` may well be what the article is about.
    """
    if tag in ASIDE_TAGS or (tag == "header" and not in_main):
        return True
    if not rest.strip(" /"):
        return False
    root = tag in ("html", "body", "article", "main")
    if not root and _HIDDEN.search(rest):
        return True
    if in_main and tag in OWN_TEXT:
        return False
    words = _MARKED_ARTICLE if root else ASIDE_WORDS
    for kind, *names in _NAMES.findall(rest):
        for name in "".join(names).lower().split():
            if in_main and not root:
                if name in (ASIDE_IDS if kind.lower() == "id" else ASIDE_WORDS - {"header"}):
                    return True
                continue
            parts = re.split(r"[^a-z0-9]+", name)
            if parts[0] not in ("has", "with", "no") and not words.isdisjoint(parts):
                return True
    return False


class _Page:
    """What is open while a page is read: (tag, is left out, in main, first block)."""

    def __init__(self, html: str):
        self.open: list[tuple[str, bool, bool, int]] = []
        self.count: dict[str, int] = {}  # open elements by tag
        self.parts: list[str] = []
        self.inner: list[list[str]] = [[]]  # blocks and subtrees in turn, of the page and of open elements that are not inline
        self.blocks: list[tuple[str, bool]] = []  # text, in main
        self.subtrees: list[tuple[int, int, int]] = []  # hash, first block, block behind the last
        self.mains: list[tuple[int, int]] = []  # first block of an article or main element, block behind its last
        self.read(html)

    def first_skipped(self) -> int:
        return next(i for i, entry in enumerate(self.open) if entry[1])

    def flush(self) -> None:
        text = _SPACE.sub(" ", "".join(self.parts)).strip()
        self.parts = []
        if text:
            self.blocks.append((text, bool(self.open) and self.open[-1][2]))
            self.inner[-1].append(text)

    def text(self, raw: str) -> None:
        if raw and not (self.open and self.open[-1][1]):
            self.parts.append(unescape(raw) if "&" in raw else raw)

    def begin(self, tag: str, rest: str) -> None:
        if tag in OPENED_BY_BLOCK:
            self.close_until(("p",), OPENED_BY_BLOCK - {"p"} | {"td", "th", "li"})
        if tag in CLOSED_BY_SAME:
            ends, walls = CLOSED_BY_SAME[tag]
            self.close_until(ends.split(), walls.split())
        if tag not in INLINE:
            self.flush()
        elif tag == "br":
            self.text(" ")
        if tag in VOID:
            return
        skipped, in_main = (self.open[-1][1], self.open[-1][2]) if self.open else (False, False)
        # Some sites put the whole page into one form: an article in it counts.
        if skipped and tag in _MAIN and not in_main:
            skipped = any(left_out and name != "form" for name, left_out, *_ in self.open[: self.first_skipped() + 1])
        skipped = skipped or _aside(tag, rest, in_main)
        self.open.append((tag, skipped, in_main or (tag in _MAIN and not skipped), len(self.blocks)))
        self.count[tag] = self.count.get(tag, 0) + 1
        if tag not in INLINE:
            self.inner.append([])

    def pop(self) -> None:
        inline = self.open[-1][0] in INLINE
        if not inline:
            self.flush()
        tag, skipped, in_main, first = self.open.pop()
        self.count[tag] -= 1
        if inline:
            return
        own = self.inner.pop()
        if not own:
            return
        digest = _digest([tag, *own])
        self.inner[-1].append(f"\0{digest}")
        if tag in _MAIN:
            self.mains.append((first, len(self.blocks)))
        elif not skipped and (not in_main or tag not in OWN_TEXT):
            self.subtrees.append((digest, first, len(self.blocks)))

    def close_until(self, ends, walls) -> None:
        """Close the innermost of some elements, if no wall is around it sooner."""
        if not any(self.count.get(tag) for tag in ends):
            return
        for at in range(len(self.open) - 1, -1, -1):
            if self.open[at][0] in ends:
                while len(self.open) > at:
                    self.pop()
                return
            if self.open[at][0] in walls:
                return

    def read(self, html: str) -> None:
        at, place = 0, html.find("<")
        last, last_data, tags = html.rfind(">"), html.rfind("]]>"), _TAG
        while place >= 0:
            if html.startswith("<!--", place):
                found = _COMMENT.match(html, place)
            elif place > last:
                break  # no more markup ends
            elif html.startswith("<![CDATA[", place) and place < last_data:
                found = _DATA.match(html, place)
            elif html.startswith(("<!", "<?"), place):
                found = _DECLARATION.match(html, place)
            else:
                found = tags.match(html, place)
                if not found and _TAG_START.match(html, place):
                    tags = _LOOSE_TAG
                    found = tags.match(html, place)
            if not found:
                place = html.find("<", place + 1)
                continue
            self.text(html[at:place])
            at = found.end()
            if found.re is _DATA:
                self.text(found[1])
            elif found.re in (_TAG, _LOOSE_TAG):
                at = self.markup(html, found)
            place = html.find("<", at)
        self.text(html[at:])
        while self.open:
            self.pop()
        self.flush()

    def markup(self, html: str, found: re.Match) -> int:
        """Take a tag, with all that it holds if that is raw text; where to read on."""
        end, tag, rest = found["end"], found["tag"].lower(), found["rest"]
        if end:
            self.close_until((tag,), ())
            return found.end()
        self.begin(tag, rest)
        if tag not in RAW or rest.endswith("/"):
            return found.end()
        end = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(html, found.end())
        self.pop()
        return end.end() if end else len(html)


def _digest(parts: list[str]) -> int:
    digest = hashlib.blake2b("\n".join(parts).encode("utf-8", "replace"), digest_size=8).digest()
    return int.from_bytes(digest, "big", signed=True)


def parse(html: str) -> tuple[list[tuple[str, bool]], int, list[tuple[int, int, int]]]:
    """The blocks of a page in order with whether they are in an article or main element, a hash of its content, which is
    the text of these elements or all text if it has none, and the subtrees that may be template: hash, first block, and
    the block behind the last."""
    page = _Page(html)
    content = _digest([text for text, in_main in page.blocks if in_main or not page.mains])
    # A page without such an element is as a whole no template either.
    page.mains = page.mains or [(0, len(page.blocks))]
    # For each block the least end of an article or main element that begins there or later.
    least = [len(page.blocks) + 1] * (len(page.blocks) + 1)
    for start, stop in page.mains:
        least[start] = min(least[start], stop)
    for at in range(len(page.blocks) - 1, -1, -1):
        least[at] = min(least[at], least[at + 1])
    return page.blocks, content, [found for found in page.subtrees if least[found[1]] > found[2]]


def without_subtrees(blocks: list[str], subtrees: list[dict], drop: set[int]) -> list[str]:
    """The blocks that lie in none of the dropped subtrees."""
    begun = [0] * (len(blocks) + 1)
    for found in subtrees:
        if found["subtree"] in drop:
            begun[found["first"]] += 1
            begun[found["behind"]] -= 1
    return [text for text, depth in zip(blocks, accumulate(begun)) if not depth]


_SUBTREES = pa.list_(pa.struct([("subtree", pa.int64()), ("first", pa.int32()), ("behind", pa.int32())]))
_PARSED = pa.struct([("content", pa.int64()), ("blocks", pa.list_(pa.string())), ("subtrees", _SUBTREES)])


def _parsed_pages(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    names = ("subtree", "first", "behind")
    for batch in batches:
        rows = []
        for blocks, content, subtrees in map(parse, batch.to_pylist()):
            found = [dict(zip(names, x, strict=True)) for x in subtrees]
            rows.append({"content": content, "blocks": [text for text, _ in blocks], "subtrees": found})
        yield pa.array(rows, _PARSED)


def _cleaned_pages(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
    for batch in batches:
        rows = zip(*(column.to_pylist() for column in batch), strict=True)
        yield pa.array([without_subtrees(b, s, set(d)) if d else b for b, s, d in rows], pa.list_(pa.string()))


def main_text(pages: DataFrame, html: str = "html", url: str = "url", least_pages: int = 3) -> DataFrame:
    """``pages`` with ``text``, the main text, in place of ``html``.

    A subtree is template if it occurs on ``least_pages`` pages of its host that differ in their content, the
    text of their article and main elements or else their whole text, however many pages the host has. What
    holds a page's whole content is never template.
    Text outside an article or main element stays unless it is template or named as no part of an article.
    Blocks are joined by an empty line, white space inside a block is one space, character references are
    decoded. Null and empty pages, and pages of markup alone, have the empty text. Pages with a null url, or
    one without a host, count as one host. Repeated rows stay, each with its text; copies of a page
    count once. An input column called ``text`` is replaced.
    """
    kept = [c for c in pages.columns if c not in (html, "text")]
    whole = F.struct(*(F.col(f"`{c}`") for c in kept), F.lit(0).alias("engine_pad")).alias("row")
    host = F.coalesce(F.lower(F.regexp_extract(F.col(f"`{url}`"), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#]*)", 1)), F.lit(""))
    parsed_page = F.arrow_udf(_parsed_pages, "struct<content:bigint,blocks:array<string>,subtrees:array<struct<subtree:bigint,first:int,behind:int>>>")
    cleaned_page = F.arrow_udf(_cleaned_pages, "array<string>")
    parsed = pages.select(whole, host.alias("host"), parsed_page(text_or_empty(F.col(f"`{html}`"))).alias("parsed"))
    parsed = parsed.select("row", "host", "parsed.content", "parsed.blocks", "parsed.subtrees")
    rows = written(parsed.withColumn("page", F.monotonically_increasing_id()), "blocks")
    seen = rows.select("page", "host", "content", F.explode(F.array_distinct("subtrees.subtree")).alias("subtree"))
    distinct = seen.select("host", "subtree", "content").distinct()
    counted = distinct.groupBy("host", "subtree").agg(F.count("*").alias("n"))
    template = counted.where(F.col("n") >= least_pages).select("host", "subtree")
    drop = split_join(seen, template, ["host", "subtree"], "left_semi").groupBy("page").agg(F.collect_set("subtree").alias("drop"))
    # Pages without a subtree in question, such as those of plain paragraphs in an article element, stay where they are.
    rest = F.size("subtrees") > 0
    cleaned = split_join(rows.where(rest), drop, ["page"], "left")
    cleaned = cleaned.select("row", cleaned_page("blocks", "subtrees", "drop").alias("blocks"))
    cleaned = cleaned.unionByName(rows.where(~rest).select("row", "blocks"))
    return cleaned.select(*(F.col("row").getField(c).alias(c) for c in kept), F.array_join("blocks", "\n\n").alias("text"))


def text_report(pages: DataFrame) -> DataFrame:
    """The main text of all ``pages``."""
    texts = main_text(pages.select("page_id", "url", "html"))
    return texts.withColumn("n_chars", F.length("text").cast("long"))
