"""Main text of web pages: elements that a site repeats are its template, and go; what is left of the article stays.

A page becomes its blocks of text and the elements around them, each a run of blocks with a hash of its subtree: tag, text
and children. Spark counts every subtree over the pages of its host. One that recurs on many pages with different content is
part of the template and is deleted with all below it. Pages that copy each other's article count once, by a key that near
copies share: else a much copied article would look like a template. Paragraphs, headings and lists of an article proper are
text, however often they recur.

What varies from page to page no count can show: elements that say what they are, by tag, role or class (menus, footers,
forms, adverts, comments and the like), and lists of links outside the article, are deleted by that.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from itertools import accumulate
from typing import NamedTuple

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from tidemark.llm.common import saved, whole

LEAST_PAGES = 5  # pages of different content on which a template recurs
LEAST_SHARE = 0.25  # of the pages that hold it are of different content

# Fixed values of the language.
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option optgroup p pre search section select "
    "summary table tbody td tfoot th thead title tr ul button label template noscript svg canvas object video audio".split())
CLOSES_P = BLOCKS - frozenset("option optgroup button label template noscript svg canvas object video audio title".split())
NOT_P = BLOCKS - {"p"}
NOTHING: frozenset[str] = frozenset()
#: An opening tag ends open elements of these tags, up to one of the second group.
ENDS = {
    "li": ("li", "ul ol menu"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "option": ("option", "select"),
    "tr": ("tr td th caption", "table"), "td": ("td th", "tr table"), "th": ("td th", "tr table"),
    "tbody": ("caption tbody thead tfoot tr td th", "table"), "thead": ("caption tbody thead tfoot tr td th", "table"),
    "tfoot": ("caption tbody thead tfoot tr td th", "table"), "body": ("head", "html")}
ENDS = {tag: (frozenset(a.split()), frozenset(b.split())) for tag, (a, b) in ENDS.items()}
OUTER = frozenset("html body article main table".split())  # a stray end tag ends nothing outside of these
P, HEADER = frozenset(("p",)), frozenset(("header",))
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
PROSE = HEADINGS | frozenset("p li dt dd pre blockquote figure figcaption ul ol dl table thead tbody tfoot tr td th caption".split())
UNSEEN = frozenset("head template noscript svg canvas object video audio".split())
#: What holds an article is no menu, whatever its name, but for these.
FIRM = UNSEEN | frozenset("nav menu footer aside dialog search select button".split())
MARKED = FIRM | frozenset("header form fieldset".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
#: Words of a class or id that say what an element is.
NAMES = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner sidebar aside menu nav "
    "navbar navigation breadcrumb breadcrumbs footer header masthead topbar toolbar cookie cookies consent gdpr notice "
    "notices notification alert popup modal overlay newsletter subscribe subscription signup login share sharing social "
    "related recommended recommendations comment comments reply replies disqus respond widget pagination pager skip".split())
OF_ARTICLES = frozenset("article entry post story content title".split())
COMMENT = frozenset("comment comments reply replies ad ads advert promo sponsored related teaser recommended widget".split())
FIRM_NAMES = frozenset("comment comments reply replies disqus respond related recommended recommendations".split())

ATTRIBUTES = re.compile(r"([^\s=>\"'/]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
TAG_END = re.compile(r"(?:[^>=]++|=\s*+(?:\"[^\"]*\"|'[^']*'|))*+>")
NAME = re.compile(r"[a-zA-Z][^\s/>]*")
WORDS = re.compile(r"[A-Za-z][a-z]+|[A-Z]+")


class Parsed(NamedTuple):
    """Blocks of text; flags of blocks deleted by name; elements ``(hash, first block, end block)``; key of the content."""

    blocks: list[str]
    marked: list[bool]
    elements: list[tuple[int, int, int]]
    key: int


class _Element:
    __slots__ = ("tag", "first", "hasher", "named", "firm", "links", "link_chars", "chars", "articles", "scoped")

    def __init__(self, tag: str, first: int, named: bool = False, firm: bool = False, scoped: bool = False):
        self.tag, self.first, self.named, self.firm, self.scoped = tag, first, named, firm, scoped
        self.hasher = xxhash.xxh64(tag)
        self.links = self.link_chars = self.chars = self.articles = 0


def _tokens(source: str):
    """``(kind, name or text, attributes)``; kinds are text, open and end. Time is linear in the source."""
    at, end, shut = 0, len(source), {}
    while at < end:
        left = source.find("<", at)
        if left < 0:
            yield "text", source[at:], ""
            return
        if left > at:
            yield "text", source[at:left], ""
        follows = source[left + 1:left + 2]
        if source.startswith("<!--", left):
            close = source.find("-->", left + 2)
            at = end if close < 0 else close + 3
        elif follows in ("!", "?") or (follows == "/" and not source[left + 2:left + 3].isalpha()):
            close = source.find(">", left)
            at = end if close < 0 else close + 1
        elif follows.isascii() and follows.isalpha() or follows == "/":
            found = TAG_END.match(source, left + 1)
            if not found:
                return  # a tag that never ends
            close = found.end()
            name = NAME.match(source, left + 1 + (follows == "/"))
            at, tag = close, name.group().lower()
            if follows == "/":
                yield "end", tag, ""
                continue
            yield "open", tag, source[name.end():close - 1]
            if tag in RAW:
                stop = shut.get(tag, 0)
                if stop >= 0 and (not stop or stop < at):
                    hit = re.compile(f"</{tag}[\\s/>]", re.IGNORECASE).search(source, at)
                    stop = shut[tag] = hit.start() if hit else -1
                if stop < 0:
                    return  # the rest is inside
                at = stop
        else:
            yield "text", "<", ""
            at = left + 1


def _names(attributes: str) -> tuple[bool, frozenset[str]]:
    """Whether the attributes hide an element or give it a role of no article, and the words of its class and id."""
    hidden, words = False, set()
    for name, value in ATTRIBUTES.findall(attributes):
        name, value = name.lower(), html.unescape(value.strip("\"'"))
        if name in ("class", "id"):
            words.update(w.lower() for w in WORDS.findall(value))
        elif name == "role":
            hidden |= value.lower() in ROLES
        elif name == "style":
            hidden |= "display:none" in value.replace(" ", "").lower()
        else:
            hidden |= name == "hidden" or (name == "aria-hidden" and value.lower() == "true")
    return hidden, frozenset(words)


def _covered(size: int, runs: list[tuple[int, int]]) -> list[bool]:
    """Which places lie in one of the runs."""
    steps = [0] * (size + 1)
    for a, b in runs:
        steps[a] += 1
        steps[b] -= 1
    return [depth > 0 for depth in accumulate(steps[:size])]


def _outermost(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans, key=lambda s: (s[0], -s[1])):
        if not out or a >= out[-1][1]:
            out.append((a, b))
    return out


class _Page:
    """The open elements of a page, and what is known of those that are closed."""

    def __init__(self):
        self.blocks, self.elements, self.texts, self.stack = [], [], [], [_Element("html", 0)]
        self.open = Counter(html=1)
        self.runs, self.articles, self.headlines = [], [], set()  # runs go by name; headlines are places of blocks

    def flush(self) -> None:
        if self.texts:
            text = " ".join("".join(self.texts).split())
            self.texts.clear()
            if text:
                one = self.stack[-1]
                if one.tag in HEADINGS:
                    self.headlines.add(len(self.blocks))
                self.blocks.append(text)
                one.hasher.update(b"\0" + text.encode("utf-8", "surrogatepass"))
                one.chars += len(text)

    def close(self) -> None:
        """End the innermost open element."""
        self.flush()
        one = self.stack.pop()
        above, first, end = self.stack[-1], one.first, len(self.blocks)
        self.open[one.tag] -= 1
        if first == end:
            return
        above.hasher.update(b"\1" + one.hasher.digest())
        above.chars += one.chars
        above.links += one.links
        above.link_chars += one.link_chars
        if one.named and (one.firm or not one.articles):
            if one.tag == "header" and one.scoped:  # the headline of an article may stand in a header
                self.runs += [(i, i + 1) for i in range(first, end) if i not in self.headlines]
            else:
                self.runs.append((first, end))
        else:
            above.articles += one.articles
            if one.tag in ("article", "main"):
                self.articles.append((one.tag, first, end))
                above.articles += 1
            elif not one.scoped and one.links >= 3 and one.link_chars * 5 >= one.chars * 4:
                self.runs.append((first, end))
        if one.tag not in ("html", "body", "article", "main") and not (one.scoped and one.tag in PROSE):
            self.elements.append((one.hasher.intdigest(), first, end))

    def end(self, tags: frozenset[str], limit: frozenset[str], every: bool = False) -> None:
        """End the innermost open element of these tags, or every one, inside the innermost of the limit."""
        while any(self.open[t] for t in tags):
            at = next((i for i in range(len(self.stack) - 1, 0, -1) if self.stack[i].tag in tags or self.stack[i].tag in limit), 0)
            if not at or self.stack[at].tag not in tags:
                return
            while len(self.stack) > at:
                self.close()
            if not every:
                return

    def start(self, tag: str, attributes: str) -> None:
        if tag in CLOSES_P:
            self.end(P, NOT_P)
        if tag in ENDS:
            self.end(*ENDS[tag], every=True)
        if tag in VOID or (tag in ("html", "body") and self.open[tag]):
            return
        hidden, words = _names(attributes) if attributes else (False, NOTHING)
        article = tag in ("article", "main")
        by_name = words & (COMMENT if article else NAMES)
        if by_name == HEADER and words & OF_ARTICLES:
            by_name = NOTHING  # an article's own header
        named = tag not in ("html", "body") and (hidden or tag in MARKED or bool(by_name))
        firm = hidden or tag in FIRM or bool(words & FIRM_NAMES) or article
        self.open[tag] += 1
        self.stack.append(_Element(tag, len(self.blocks), named, firm, self.stack[-1].scoped or (article and not named)))


def parse(source: str) -> Parsed:
    page, linked = _Page(), False
    for kind, value, attributes in _tokens(source):
        if kind == "text":
            page.texts.append(html.unescape(value) if "&" in value else value)
            if linked:
                page.stack[-1].link_chars += len(value)
        elif value == "a":
            linked = kind == "open"
            page.stack[-1].links += linked
        elif value == "br":
            page.texts.append(" ")
        elif value in BLOCKS:
            page.flush()
            if kind == "open":
                page.start(value, attributes)
            elif page.open[value]:
                page.end(frozenset((value,)), NOTHING if value in OUTER else OUTER)
    page.flush()
    while len(page.stack) > 1:
        page.close()

    flags = _covered(len(page.blocks), page.runs)
    for kind in ("article", "main"):  # a page with one article, or else one main part, is that
        outer = _outermost([(a, b) for k, a, b in page.articles if k == kind and not all(flags[a:b])])
        if len(outer) == 1:
            (a, b), = outer
            flags = [f or not a <= i < b for i, f in enumerate(flags)]
            break
    best, key = 0.0, 0
    for text, flag in zip(page.blocks, flags):
        if not flag:  # the block of least weighted hash: near copies mostly share it
            h = xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass"))
            if len(text) / (h + 1.0) > best:
                best, key = len(text) / (h + 1.0), h
    return Parsed(page.blocks, flags, page.elements, key)


def host(url: Column) -> Column:
    """The host of an address, in lower case; null where there is none."""
    name = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1))
    return F.when(name != "", name)


def _signed(h: int) -> int:
    return h - (1 << 64) if h >> 63 else h


def page_texts(pages: DataFrame, *, least_pages: int = LEAST_PAGES, least_share: float = LEAST_SHARE,
               columns: list[str] | None = None) -> DataFrame:
    """``row, text, n_blocks, n_template, n_marked`` for each page: its main text, blocks joined by line ends.

    ``n_template`` blocks were deleted as the site's template, ``n_marked`` others by what their elements say they are.
    A null page is an empty one, with an empty text. Pages without a host are of no site: nothing of them counts as
    template. Repeated rows are rows of their own, but identical pages of a host count as one of it, and copies of one
    article as one content. ``row`` has the columns named, or all.

    Pages are parsed twice: for the elements that are counted, which are stored, and for the texts. Storing the texts
    would take as much disk as moving them to the elements found.
    """
    @pandas_udf("struct<elements: array<struct<h: long, first: int, end: int>>, key: long>")
    def counted_parts(sources: pd.Series) -> pd.DataFrame:
        found = [parse(source) for source in sources]
        return pd.DataFrame({"elements": [[(_signed(h), a, b) for h, a, b in page.elements] for page in found],
                             "key": [_signed(page.key) for page in found]})

    @pandas_udf("struct<blocks: binary, marked: array<boolean>>")
    def text_parts(sources: pd.Series) -> pd.DataFrame:
        out = []
        for source in sources:
            page = parse(source)
            data = "\n".join(page.blocks).encode("utf-8", "replace")
            out.append((len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True), page.marked))
        return pd.DataFrame(out, columns=["blocks", "marked"])

    site, source = host(pages["url"]), whole(pages["html"])
    page_key = F.unhex(F.md5(F.concat(F.coalesce(site, F.lit("")), F.lit("\n"), source))).alias("page")
    parts = saved(pages.where(site.isNotNull()).select(page_key, site.alias("host"), counted_parts(source).alias("p")).select(
        "page", "host", "p.*"), "page-elements")
    seen = parts.select("page", "host", "key", F.inline("elements"))
    seen = seen.select("page", F.xxhash64("host", "h").alias("subtree"), "key", "first", "end")
    per_key = seen.select("page", "subtree", "key").distinct().groupBy("subtree", "key").agg(F.count(F.lit(1)).alias("pages"))
    counted = per_key.groupBy("subtree").agg(F.count(F.lit(1)).alias("contents"), F.sum("pages").alias("pages"))
    template = counted.where((F.col("contents") >= least_pages) & (F.col("contents") >= least_share * F.col("pages")))
    hits = seen.join(template.select("subtree"), "subtree").groupBy("page").agg(
        F.collect_set(F.struct("first", "end")).alias("hits"))

    @pandas_udf("struct<text: string, n_blocks: long, n_template: long, n_marked: long>")
    def kept(blocks: pd.Series, marked: pd.Series, first: pd.Series, end: pd.Series) -> pd.DataFrame:
        out = []
        for data, flags, starts, ends in zip(blocks, marked, first, end):
            size = int.from_bytes(data[:8], "little")
            text = pa.decompress(data[8:], decompressed_size=size, codec="zstd", asbytes=True).decode() if size else ""
            lines = text.split("\n") if len(flags) else []
            gone = _covered(len(flags), [] if starts is None else list(zip(starts, ends)))
            out.append(("\n".join(t for t, m, g in zip(lines, flags, gone) if not m and not g), len(flags), sum(gone),
                        sum(bool(m) and not g for m, g in zip(flags, gone))))
        return pd.DataFrame(out, columns=["text", "n_blocks", "n_template", "n_marked"])

    row = F.struct(*[pages[f"`{c}`"] for c in (columns or pages.columns)]).alias("row")
    rows = pages.select(row, page_key, text_parts(source).alias("p")).join(hits, "page", "left")
    return rows.select("row", kept("p.blocks", "p.marked", "hits.first", "hits.end").alias("k")).select("row", "k.*")
