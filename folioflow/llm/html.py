"""Main text of web pages by equivalence-class template deduction.

A page is read as a sequence of tokens: the start and end of every block element, and the text of every block, each known
by the path of open elements above it. Over all different pages of a host:

* the occurrence vector of a token says how often each page holds it. Tokens with the same vector form an equivalence
  class. Vectors are compared by two 64-bit sums over the pages, so a host of any size is one group and never one task;
* a class is valid if its tokens stand in one order, repeated as often as the vector says. That is checked by the rank of
  a token within its class, which has to be the same on the pages;
* valid classes are nested: tokens carry their path, so a class lies within the same element of its parent everywhere.
  Start and end of an element that is once on its pages are a node of the template, and what lies between is a slot of it.
  Block texts in a class with tags, or alone on most pages, are constants of the template.

The article is the innermost node whose slots hold most of the words that are neither linked nor constant. Its text is what
is left there when constants are taken away. Names of elements and classes are asked only for what vectors cannot tell:
parts inside the article (comments, forms), a marked article inside a larger node, and pages without any such node (the
only page of a host).
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import staged, table

#: A tag belongs to the template if this share of the host's pages holds it; so a host may have several layouts, and the
#: template of a host is at most 1 / LAYOUT times as long as its mean page. At least two pages in any case.
LAYOUT = 0.1
#: A text that shares its vector with no tag is a constant of the template on so many pages and this share of them.
CONSTANT_PAGES = 4
CONSTANT_SHARE = 0.8
#: Share of the pages on which a token's rank in its class has to be the usual one.
ORDERED = 0.95
#: Share of the words that a node has to hold to be the article.
REGION = 0.75
#: Templates of all hosts are broadcast up to so many tokens (8 bytes each), and joined by host and salt beyond.
BROADCAST_TOKENS = 500_000
SALT_PAGES = 2000

# Elements of HTML by what they are for, and words in class names.
RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "svg", "object", "xmp"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
BLOCK = {
    "address", "article", "aside", "blockquote", "body", "br", "button", "caption", "center", "dd", "details", "dialog", "div", "dl", "dt",
    "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hr", "html", "label", "legend",
    "li", "main", "menu", "nav", "ol", "option", "p", "pre", "section", "select", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
PROSE = HEADINGS | {"p", "li", "blockquote", "pre", "td", "th", "dd", "dt", "figcaption"}
ASIDE = {"nav", "footer", "aside", "form", "button", "select", "option", "input", "label", "menu", "head", "dialog", "fieldset"}
ASIDE_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "menu", "menubar", "form"}
ASIDE_WORDS = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored", "promo", "promotion", "banner", "cookie", "cookies",
    "consent", "gdpr", "notice", "notices", "notification", "alert", "newsletter", "subscribe", "subscription", "sidebar", "aside", "widget", "widgets",
    "menu", "nav", "navbar", "navigation", "breadcrumb", "breadcrumbs", "pagination", "pager", "footer", "foot", "masthead", "toolbar",
    "topbar", "comment", "comments", "disqus", "reply", "replies", "discussion", "share", "sharing", "social", "related", "recommended", "popup",
    "modal", "overlay", "login", "signup", "signin", "search", "copyright", "legal", "disclaimer",
}
#: A start tag of the key closes an open element of the value's names.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
LISTS = {"ul", "ol", "dl", "table", "select"}

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)", re.S)
_ATTR = re.compile(r"(class|id|role|aria-hidden|hidden|style)\s*+(?:=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'>]++)))?", re.I)
_CLASS = re.compile(r"\bclass\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'>]++))", re.I)
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")

# A token is 61 bits of hash and three of kind.
END, TEXT, LEAF = 1, 2, 4  # LEAF: of an element that holds running text and is no container
_KIND = 7


class Block(NamedTuple):
    """The text of a block; places are places in the page's tokens, -1 for none."""

    at: int  # its own
    text: str
    aside: int  # the innermost part above it that is not an article by its name
    header: int  # the innermost header outside an article
    main: int  # the innermost article or main element
    heading: bool
    prose: bool
    linked: bool  # most of it is in links
    words: int


class Page(NamedTuple):
    keys: list[int]
    blocks: list[Block]


def _by_attributes(name: str, attrs: str) -> tuple[bool, bool]:
    """Whether names say that an element is no article, and that it is a header."""
    if name in ASIDE or name == "header":
        return name != "header", name == "header"
    header = False
    if name not in ("html", "body", "article", "main") and attrs:
        for m in _ATTR.finditer(attrs):
            kind, value = m[1].lower(), html.unescape(m[2] or m[3] or m[4] or "")
            if kind == "role" and value.lower() in ASIDE_ROLES or kind == "aria-hidden" and value.lower() == "true" or kind == "hidden":
                return True, False
            if kind == "style" and re.search(r"display\s*:\s*none", value, re.I):
                return True, False
            if kind in ("class", "id"):
                names = {w.lower() for w in _NAME.findall(value)}
                if ASIDE_WORDS & names:
                    return True, False
                header |= "header" in names
    return False, header


class _Open(NamedTuple):
    name: str
    block: bool
    path: int
    aside: int
    header: int
    main: int


def parse(page: str) -> Page:
    """Tokens and block texts of a page in order. Elements are closed where HTML would close them, and at the end of the page,
    so every start has an end; a page may stop anywhere."""
    keys: list[int] = []
    blocks: list[Block] = []
    root = _Open("", True, 0, -1, -1, -1)
    stack: list[_Open] = [root]
    inner = root  # innermost open block element
    buf: list[str] = []
    size = linked = links = 0

    def flush() -> None:
        nonlocal size, linked
        if buf:
            words = html.unescape("".join(buf)).split()
            buf.clear()
            if words:
                text, top = " ".join(words), stack[-1]
                prose = any(s.name in PROSE for s in stack[-4:])
                blocks.append(Block(len(keys), text, top.aside, top.header, top.main, inner.name in HEADINGS, prose, linked > 0 and linked >= 0.8 * size, len(words)))
                keys.append(xxhash.xxh3_64_intdigest(text.encode("utf-8", "replace"), inner.path) & ~_KIND | TEXT)
        size = linked = 0

    def close(to: int) -> None:
        nonlocal links, inner
        while len(stack) > to:
            s = stack.pop()
            links -= s.name == "a"
            if s.block:
                keys.append(s.path | END)
        inner = next(s for s in reversed(stack) if s.block)

    pos, n = 0, len(page)
    while pos < n:
        lt = page.find("<", pos)
        if lt < 0:
            lt = n
        if lt > pos:
            piece = page[pos:lt]
            buf.append(piece)
            k = len(piece.strip())
            size += k
            linked += k if links else 0
        if lt == n:
            break
        m = _TOKEN.match(page, lt)
        if m is None:  # a bare <
            buf.append("<")
            pos = lt + 1
            continue
        pos = m.end()
        name = (m[2] or m[5] or "").lower()
        if not name:
            continue
        attrs = m[3] or m[6] or ""
        block = name in BLOCK
        if block:
            flush()
        if m[1] or m[4]:
            at = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].name == name), 0)
            if at and (block or all(not s.block for s in stack[at + 1 :])):
                close(at)
            elif at:  # an inline element that blocks have been opened in
                links -= name == "a"
                del stack[at]
            continue
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}\b[^>]*+>", re.I).search(page, pos)
            pos = end.end() if end else n
            continue
        if block and name not in ("br", "hr"):
            at = next((i for i in range(len(stack) - 1, max(0, len(stack) - 9), -1) if stack[i].name == "p"), 0)
            if at and all(not s.block for s in stack[at + 1 :]):
                close(at)
        for _ in range(2 if name in CLOSES else 0):
            at = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].name in CLOSES[name] or stack[i].name in LISTS), 0)
            if at and stack[at].name in CLOSES[name]:
                close(at)
        above = stack[-1]
        path = inner.path
        if block:
            label = name
            if attrs and (c := _CLASS.search(attrs)):
                label += "." + ".".join(sorted({w.lower() for w in _NAME.findall(html.unescape(c[1] or c[2] or c[3] or "")) if not w.isdigit()}))
            path = xxhash.xxh3_64_intdigest(label.encode("utf-8", "replace"), inner.path) & ~_KIND | (LEAF if name in PROSE else 0)
        here = len(keys)
        if name in VOID or attrs.endswith("/") and not block:
            if block:
                keys.append(path)
            continue
        aside, header = _by_attributes(name, attrs)
        if block:
            keys.append(path)
        main = here if name in ("article", "main") else above.main
        o = _Open(name, block, path, here if aside else above.aside, here if header and main < 0 else above.header, main)
        stack.append(o)
        if block:
            inner = o
        links += name == "a"
    flush()
    close(1)
    return Page(keys, blocks)


class Template(NamedTuple):
    regions: frozenset[int]  # start tokens of nodes that may be the article
    constants: frozenset[int]  # texts


def region(page: Page, template: Template) -> tuple[int, int] | None:
    """Places of start and end of the innermost node of the template that may be the article and is once on the page."""
    at = [i for i, k in enumerate(page.keys) if k in template.regions]
    once = [i for i in at if sum(page.keys[j] == page.keys[i] for j in at) == 1]
    if not once:
        return None
    start = once[-1]
    end = page.keys[start] | END
    return start, next(i for i in range(start + 1, len(page.keys)) if page.keys[i] == end)


def main_text(page: Page, template: Template) -> str | None:
    """The slots of the article's node, without constants; null if the template has no such node on this page.

    A title before the node belongs to it. Where everything in the node is constant the page is a copy, and it stays.
    """
    found = region(page, template)
    if found is None:
        return None
    start, end = found
    inside = [b for b in page.blocks if start < b.at < end]
    if any(b.main > start for b in inside):
        inside = [b for b in inside if b.main > start]
    inside = [b for b in inside if b.aside <= start and (b.prose or not b.linked or b.words > 12)]
    own = [b for b in inside if page.keys[b.at] not in template.constants]
    inside = own or inside
    if not any(b.heading for b in inside):
        title = [b for b in page.blocks if b.at < start and b.heading and b.aside < 0 and page.keys[b.at] not in template.constants]
        inside = title[-1:] + inside
    return " ".join(b.text for b in inside)


def by_names(page: Page) -> str:
    """The text of a page without a template: a marked article, or all, without parts that are no article by their names."""
    shown = [b for b in page.blocks if b.aside < 0 and b.header < 0]
    marked = [b for b in shown if b.main >= 0]
    return " ".join(b.text for b in marked or [b for b in shown if not b.linked or b.words > 12])


# --- deduction over the pages of a host -----------------------------------------------------------------------------


def _ints(keys: list[int]) -> np.ndarray:
    return np.array(keys, np.uint64).view(np.int64)


def _lists(column: pa.Array) -> list[np.ndarray]:
    values, off = column.flatten().to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    off = off - off[0]
    return [values[a:b] for a, b in zip(off[:-1], off[1:], strict=True)]


def host_of(url: str | Column = "url") -> Column:
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def page_tokens(pages: DataFrame) -> DataFrame:
    """(host, page, keys, words, n) for every page with html; page is a hash of the html, keys its tokens. words are the unlinked
    words of a token, and n stands at a token's first place: how often the page holds it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.int64())
        for batch in batches:
            for lo in range(0, len(batch), 256):
                part = batch.slice(lo, 256)
                keys, words, counts, page = [], [], [], []
                for h in part.column("html").to_pylist():
                    p = parse(h)
                    w = np.zeros(len(p.keys), np.int64)
                    for b in p.blocks:
                        w[b.at] = 0 if b.linked else b.words
                    keys.append(_ints(p.keys))
                    _, first, often = np.unique(keys[-1], return_index=True, return_counts=True)
                    counts.append(np.zeros(len(p.keys), np.int64))
                    counts[-1][first] = often
                    words.append(w)
                    page.append(xxhash.xxh3_64_intdigest(h.encode("utf-8", "replace")))
                yield pa.RecordBatch.from_arrays([part.column("host"), pa.array(_ints(page)), *(pa.array(c, kind) for c in (keys, words, counts))], ["host", "page", "keys", "words", "n"])

    d = pages.where("html is not null and html <> ''").select(host_of().alias("host"), "html")
    return d.mapInArrow(run, "host string, page long, keys array<long>, words array<long>, n array<long>")


def _flag(token: str, bit: int) -> Column:
    return F.col(token).bitwiseAND(F.lit(bit)) != 0


def classes(tokens: DataFrame) -> DataFrame:
    """(host, token, pages, most, vector): tokens of the template's classes, from the tokens of different pages.

    Tokens with the same vector are one class. Sums of a token are combined before the shuffle, so neither a large host nor
    a token that all its pages hold comes to one task as rows.
    """
    each = tokens.select("host", "page", F.explode(F.arrays_zip(F.col("keys").alias("token"), "n")).alias("x")).select("host", "page", "x.token", "x.n").where("n > 0")
    mark = lambda seed: F.bit_xor(F.xxhash64(F.lit(seed), "page", "n"))
    seen = each.groupBy("host", "token").agg(F.count(F.lit(1)).alias("pages"), F.max("n").alias("most"), F.struct(mark(1).alias("a"), mark(2).alias("b")).alias("vector")).where("pages >= 2")
    hosts = tokens.groupBy("host").agg(F.count(F.lit(1)).alias("of"))
    seen = staged(seen.join(hosts, "host").where((F.col("pages") >= LAYOUT * F.col("of")) | (F.col("pages") >= CONSTANT_SHARE * F.col("of"))), "vectors")
    tags, texts = seen.where(~_flag("token", TEXT)), seen.where(_flag("token", TEXT))
    texts = texts.where(F.col("pages") >= CONSTANT_PAGES).join(tags.select("host", "vector", F.lit(True).alias("tagged")).distinct(), ["host", "vector"], "left")
    texts = texts.where(F.coalesce("tagged", F.lit(False)) | (F.col("pages") >= CONSTANT_SHARE * F.col("of")))
    names = ["host", "token", "pages", "most", "vector"]
    return tags.select(names).unionByName(texts.select(names))


def with_templates(pages: DataFrame, templates: DataFrame, size: int, name: str) -> DataFrame:
    """pages (host, salt source `page`) joined to one row per host; small tables are broadcast, others meet by host and salt."""
    if size <= BROADCAST_TOKENS:
        return pages.join(F.broadcast(templates.drop("of")), "host", "left")
    salts = F.ceil(F.col("of") / SALT_PAGES).cast("int")
    spread = templates.select("*", F.explode(F.sequence(F.lit(0), salts - 1)).alias("salt")).drop("of")
    counts = templates.select("host", salts.alias("salts"))
    d = pages.join(counts, "host", "left").withColumn("salt", F.coalesce(F.pmod("page", F.col("salts")).cast("int"), F.lit(0))).drop("salts")
    return d.join(spread, ["host", "salt"], "left").drop("salt")


def _ranks(tokens: DataFrame) -> DataFrame:
    """(host, token, lo, hi, inside, total) for each page and template token on it: its least and greatest rank in its class; for a
    start that is once on the page, the words between it and its end, and all words of the page that are not constants."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["host", "token", "lo", "hi", "inside", "total"]
        for batch in batches:
            cols: list[list] = [[] for _ in names[1:]]
            rows = []
            host = batch.column("host").to_pylist()
            for i, (keys, words, known, of) in enumerate(zip(*(_lists(batch.column(c)) for c in ("keys", "words", "known", "class")), strict=True)):
                at = np.searchsorted(known, keys)
                hit = known[np.minimum(at, len(known) - 1)] == keys
                place = np.flatnonzero(hit)
                token = at[place]
                cls = of[token]
                order = np.argsort(cls, kind="stable")
                first = np.searchsorted(cls[order], cls[order], "left")
                here = np.unique(token)
                size = np.bincount(np.searchsorted(np.unique(cls), of[here]))
                rank = np.empty(len(place), np.int64)
                rank[order] = (np.arange(len(place)) - first) % size[np.searchsorted(np.unique(cls), cls[order])]
                lo, hi = np.full(len(known), 1 << 40), np.full(len(known), -1)
                np.minimum.at(lo, token, rank)
                np.maximum.at(hi, token, rank)
                words = np.where(hit & ((keys & TEXT) != 0), 0, words)
                upto = np.concatenate([[0], np.cumsum(words)])
                start = dict(zip(known[token].tolist(), place.tolist(), strict=True))
                count = np.bincount(token, minlength=len(known))
                inside = np.full(len(known), -1)
                for t in here[(count[here] == 1) & ((known[here] & (END | TEXT)) == 0)].tolist():
                    end = start.get(int(known[t]) | END)
                    inside[t] = upto[end] - upto[start[int(known[t])]] if end is not None else -1
                for c, v in zip(cols, (known[here], lo[here], hi[here], inside[here], np.full(len(here), upto[-1])), strict=True):
                    c.append(v)
                rows += [host[i]] * len(here)
            arrays = [np.concatenate(c) if c else np.zeros(0, np.int64) for c in cols]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.string()), *(pa.array(a.astype(np.int64)) for a in arrays)], names)

    return tokens.select("host", "keys", "words", "known", "class").where("known is not null").mapInArrow(run, "host string, token long, lo long, hi long, inside long, total long")


def templates(tokens: DataFrame) -> tuple[DataFrame, int]:
    """(host, of, regions, constants) with a row for each host that has a template, and the tokens in all of them."""
    tokens = staged(tokens.dropDuplicates(["host", "page"]), "tokens")
    found = staged(classes(tokens), "classes")
    of = tokens.groupBy("host").agg(F.count(F.lit(1)).alias("of"))
    numbered = F.xxhash64("vector.a", "vector.b")
    known = found.groupBy("host").agg(F.array_sort(F.collect_list(F.struct("token", numbered.alias("class")))).alias("x"))
    known = known.join(of, "host").select("host", "of", F.transform("x", lambda x: x["token"]).alias("known"), F.transform("x", lambda x: x["class"]).alias("class"))
    ranks = _ranks(with_templates(tokens, known, 2 * found.count(), "known"))
    usual = ranks.groupBy("host", "token", "lo", "hi").agg(F.count(F.lit(1)).alias("n"), F.sum("inside").alias("inside"), F.sum("total").alias("total"), F.min("inside").alias("least"))
    usual = usual.groupBy("host", "token").agg(F.sum("n").alias("n"), F.max(F.when(F.col("lo") == F.col("hi"), F.col("n"))).alias("same"), F.sum("inside").alias("inside"), F.sum("total").alias("total"), F.min("least").alias("least"))
    wide = usual.withColumn("valid", F.coalesce(F.col("same") >= ORDERED * F.col("n"), F.lit(False))).where("valid")
    ends = wide.where(_flag("token", END)).select("host", F.col("token").bitwiseXOR(F.lit(END)).alias("token"))
    starts = wide.where(~_flag("token", END) & ~_flag("token", TEXT) & ~_flag("token", LEAF) & (F.col("least") >= 0) & (F.col("total") > 0))
    regions = starts.where(F.col("inside") >= REGION * F.col("total")).join(ends, ["host", "token"], "left_semi").select("host", "token")
    d = regions.unionByName(wide.where(_flag("token", TEXT)).select("host", "token"))
    pick = lambda c: F.array_sort(F.collect_list(F.when(c, F.col("token"))))
    d = staged(d.groupBy("host").agg(pick(~_flag("token", TEXT)).alias("regions"), pick(_flag("token", TEXT)).alias("constants")).join(of, "host"), "templates")
    return d, d.agg(F.coalesce(F.sum(F.size("regions") + F.size("constants")), F.lit(0))).first()[0]


def extract(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text, n_chars, deduced (whether the text came through the host's template).

    A null or empty html gives an empty text; pages without a url form one host. Repeated rows are pages of their own, but
    equal pages count once in the template. Where the host's pages single out no node, names decide. An empty table gives
    no rows; other columns of pages are not read.
    """
    found, size = templates(page_tokens(pages))
    d = pages.select("page_id", "url", "html", host_of().alias("host"), F.xxhash64("html").alias("page"))
    d = with_templates(d, found, size, "templates").select("page_id", "url", "html", "host", "regions", "constants")
    schema = pages.select("page_id", "url").schema.add("text", "string").add("n_chars", "long").add("deduced", "boolean")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, len(batch), 256):
                part = batch.slice(lo, 256)
                text, deduced = [], []
                by_host: dict[str, Template] = {}
                given = [part.column(c) for c in ("regions", "constants")]
                for i, (h, name) in enumerate(zip(part.column("html").to_pylist(), part.column("host").to_pylist(), strict=True)):
                    if name not in by_host:
                        by_host[name] = Template(*(frozenset(np.array(c[i].as_py() or [], np.int64).view(np.uint64).tolist()) for c in given))
                    page = parse(h or "")
                    got = main_text(page, by_host[name])
                    deduced.append(got is not None)
                    text.append(by_names(page) if got is None else got)
                yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), pa.array(text, pa.string()), pa.array([len(t) for t in text], pa.int64()), pa.array(deduced)], schema.names)

    return d.mapInArrow(run, schema)


def op5_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
