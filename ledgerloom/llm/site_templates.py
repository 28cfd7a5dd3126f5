"""Main text of web pages by removal of site templates.

Every page is parsed to elements, and each element's subtree gets a hash of its
tags and texts, on the whole page: menus, adverts, footers and wrappers too, also
where they mark themselves. Three rules then remove text, in this order:

1. Recurrence. Spark counts on how many pages of a host each hash occurs; subtrees
   that recur on many pages of their host are its template and are deleted. Pages
   with the same main text count once, so copies never make it a template. Inside
   an article or main element only enclosing sections count as template; paragraphs
   and headings there are kept however often other pages repeat them.
2. Marks. What marks itself as no main text by its tag, role or class - menus, page
   headers and footers, sidebars, notices, adverts, forms, scripts, reader comments -
   is deleted: recurrence alone cannot remove what differs from page to page. A
   class or id never hides an element that contains an article or main element,
   nor a notice inside one, and a paragraph there only as an advert.
3. Main part. Where text is left in an article or main element, text outside of
   such elements is left out.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from .common import BROADCAST_BYTES, Scratch, small

# a subtree is template if it occurs on this many pages of the host, and on this share of them or on many pages
TEMPLATE_PAGES, TEMPLATE_SHARE, MANY_PAGES = 4, 0.3, 20

# fixed values: element names of the HTML standard, and customary names of page parts
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template xmp noembed noframes svg math".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong "
    "sub sup time tt u var wbr".split()
)
HIDDEN_TAGS = frozenset(
    "head script style noscript template iframe title textarea xmp noembed noframes svg math nav footer aside form button select input "
    "object embed dialog menu".split()
)
HIDDEN_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
HIDDEN_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notification "
    "alert popup modal overlay newsletter subscribe signup sidebar menu nav navbar navigation breadcrumb breadcrumbs footer masthead "
    "comment comments respond replies disqus share sharing social related recommended pagination pager skip".split()
)
# customary parts of compound names around these: after one ("ad-slot", "related-posts"), and in front where they deny it ("no-sidebar")
NAME_ENDS = frozenset(
    "area bar block body box btn button buttons card column container content section slot unit widget wrap wrapper panel list links link item "
    "items icons inner outer form header title text message dialog overlay popup window posts articles stories left right top bottom primary "
    "secondary main mobile desktop sticky fixed".split()
)
DENIED = frozenset("no non not without has have with is hide hides hidden off disable disabled enable enabled show shows".split())
# names that by themselves hide no part of an article: callouts are text there
CALLOUTS = frozenset("notice notification alert".split())
# the names that hide paragraphs and the like inside an article; its containers go by all names
ADVERTS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo cookie cookies consent gdpr newsletter subscribe signup share sharing "
    "breadcrumb breadcrumbs pagination pager".split()
)
_BOXES = frozenset("div section ul ol dl table figure details span a center header".split())
# elements that may be template inside an article
SECTIONS = frozenset("div section nav aside footer form menu".split())
# elements that end an open paragraph
_ENDS_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
    "hgroup hr main menu nav ol p pre search section table ul".split()
)
# an open element of the first kind ends where one of the second begins
_SIBLINGS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
_SCOPES = frozenset("html body article main section div table ul ol dl td th blockquote aside nav header footer form figure details".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<![^>]*>|<\?[^>]*>"
    r"|<(?P<close>/)?(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>",
    re.S,
)
_ATTR = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_SPACE = re.compile(r"\s+")


def _marks(name: str, names: frozenset) -> bool:
    """Whether a class or id is one of ``names``, ends in one, or is one followed by customary ends alone."""
    if name in names:
        return True
    parts = [p for p in re.split(r"[-_]+", name) if p]
    if len(parts) < 2 or DENIED.intersection(parts):
        return False
    return parts[-1] in names or (parts[0] in names and all(p in NAME_ENDS or p in names or p.isdigit() for p in parts[1:]))


def _hidden(tag: str, attrs: str, in_article: bool) -> tuple[bool, bool]:
    """Whether an element is hidden by its tag or attributes, and whether by its class or id."""
    if tag in HIDDEN_TAGS or (tag == "header" and not in_article):
        return True, False
    if not attrs or attrs.isspace():
        return False, False
    found = {m[0].lower(): html.unescape(m[1] or m[2] or m[3]).lower() for m in _ATTR.findall(attrs)}
    if "hidden" in found or found.get("aria-hidden") == "true" or found.get("role", "") in HIDDEN_ROLES:
        return True, False
    if tag in ("html", "body", "article", "main"):
        return False, False
    names = ADVERTS if in_article and tag not in _BOXES else HIDDEN_NAMES
    own = [n for n in f"{found.get('class', '')} {found.get('id', '')}".split() if _marks(n, names)]
    if in_article:
        own = [n for n in own if (HIDDEN_NAMES - CALLOUTS).intersection(re.split(r"[-_]+", n))]
    return False, bool(own)


class _Page:
    """Blocks of text of one page and the hashes of the subtrees they lie in."""

    def __init__(self, source: str, host: str | None = None):
        self.host = host
        self.parent, self.tags, self.hidden, self.article = [-1], ["#"], [False], [False]
        self.named, self.around = [False], [False]  # hidden by name unless around an article
        self.digest = [xxhash.xxh64()]
        self.open = [0]
        self.blocks: list[tuple[int, list[str]]] = []
        self.fresh = True  # the next text begins a block
        at = 0
        while at < len(source):
            m = _TOKEN.search(source, at)
            self._text(source[at : m.start() if m else len(source)])
            if not m:
                break
            at = m.end()
            tag = (m["tag"] or "").lower()
            if not tag:
                continue
            if m["close"]:
                self._close(tag)
            else:
                self._open(tag, m["attrs"] or "")
                if tag in RAW and not (m["attrs"] or "").rstrip().endswith("/"):
                    end = re.compile(rf"</{re.escape(tag)}\b[^>]*>|\Z", re.I).search(source, at)
                    self.digest[self.open[-1]].update(source[at : end.start()].encode("utf-8", "surrogatepass"))
                    self._close(tag)
                    at = end.end()
        while len(self.open) > 1:
            self._pop()
        # parents come before their children
        for node in range(1, len(self.tags)):
            self.hidden[node] |= self.hidden[self.parent[node]] or (self.named[node] and not self.around[node])

    def _text(self, text: str) -> None:
        if not text:
            return
        text = html.unescape(text)
        node = self.open[-1]
        if not text.isspace():
            self.digest[node].update(_SPACE.sub(" ", text).strip().encode("utf-8", "surrogatepass"))
        if self.fresh or not self.blocks:
            if text.isspace():
                return
            self.blocks.append((self._block_of(node), []))
            self.fresh = False
        self.blocks[-1][1].append((node, text))

    def _block_of(self, node: int) -> int:
        while self.tags[node] in INLINE and self.parent[node] >= 0:
            node = self.parent[node]
        return node

    def _open(self, tag: str, attrs: str) -> None:
        if tag in _ENDS_P:
            self._end_open(("p",))
        if tag in _SIBLINGS:
            self._end_open(_SIBLINGS[tag])
        if tag == "br":
            self._text(" ")
        if tag not in INLINE:
            self.fresh = True
        if tag in VOID:
            return
        up = self.open[-1]
        self.parent.append(up)
        self.tags.append(tag)
        inside = self.article[up]
        self.article.append(inside or tag in ("article", "main"))
        hidden, named = _hidden(tag, attrs, inside)
        self.hidden.append(hidden)
        self.named.append(named)
        self.around.append(False)
        if tag in ("article", "main"):
            for node in self.open:
                self.around[node] = True
        self.digest.append(xxhash.xxh64(tag))
        self.open.append(len(self.tags) - 1)

    def _end_open(self, tags: tuple) -> None:
        """Close an open element of these names unless another scope was opened in it."""
        for k in range(len(self.open) - 1, 0, -1):
            name = self.tags[self.open[k]]
            if name in tags:
                while len(self.open) > k:
                    self._pop()
                return
            if name in _SCOPES:
                return

    def _close(self, tag: str) -> None:
        if tag not in INLINE:
            self.fresh = True
        if tag in VOID:
            return
        for k in range(len(self.open) - 1, 0, -1):
            if self.tags[self.open[k]] == tag:
                while len(self.open) > k:
                    self._pop()
                return
            if tag in INLINE and self.tags[self.open[k]] not in INLINE:
                return

    def _pop(self) -> None:
        node = self.open.pop()
        if self.tags[node] not in INLINE:
            self.fresh = True
        self.digest[self.parent[node]].update(self.digest[node].digest())

    def result(self) -> list[tuple[str | None, bool, list[int]]]:
        """(text, whether it lies in an article, hashes of the subtrees that may be template) for each block; the text is null where marks hide it."""
        found = []
        for node, pieces in self.blocks:
            text = _SPACE.sub(" ", "".join(t for at, t in pieces if not self.hidden[at])).strip() or None
            found.append((text, self.article[node], self._hashes(node)))
        return found

    def _hashes(self, node: int) -> list[int]:
        """Hashes, by host, of the subtrees around a block; in an article, paragraphs and headings are content, and an article or body is never template as a whole."""
        hashes = []
        while node > 0 and self.host is not None:
            tag = self.tags[node]
            if tag in SECTIONS or not (self.article[node] or tag in ("html", "body", "article", "main")):
                hashes.append(xxhash.xxh64_intdigest(self.host.encode("utf-8", "surrogatepass") + self.digest[node].digest()) - (1 << 63))
            node = self.parent[node]
        return hashes


def _main_digest(blocks: list[tuple[str | None, bool, list[int]]]) -> int:
    """A hash of the visible text of a page's articles, or of the page where they have none."""
    shown = [(text, article) for text, article, _ in blocks if text]
    main = any(article for _, article in shown)
    return xxhash.xxh64_intdigest("\n".join(text for text, article in shown if article or not main).encode("utf-8", "surrogatepass")) - (1 << 63)


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    block = pa.struct([("text", pa.string()), ("article", pa.bool_()), ("hashes", pa.list_(pa.int64()))])
    for batch in batches:
        for start in range(0, batch.num_rows, 64):
            part = batch.slice(start, 64)
            given = zip(part.column(2).to_pylist(), part.column(3).to_pylist())
            found = [_Page(x, host).result() if x else [] for host, x in given]
            pages = [[{"text": t, "article": a, "hashes": h} for t, a, h in blocks] for blocks in found]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), part.column(2), pa.array(map(_main_digest, found), pa.int64()), pa.array(pages, pa.list_(block))],
                names=["id", "url", "host", "content", "blocks"],
            )


def _without_templates(templates: np.ndarray):
    """Batches of (id, url, blocks) to (id, url, texts of the blocks that stay), for sorted template hashes."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pc.list_value_length(batch.column(2)).to_numpy(zero_copy_only=False)
            text, article, hashes = batch.column(2).flatten().flatten()
            own = hashes.flatten().to_numpy(zero_copy_only=False)
            at = np.searchsorted(templates, own)
            hit = templates[np.minimum(at, len(templates) - 1)] == own if len(templates) else np.zeros(len(own), bool)
            block = np.repeat(np.arange(len(text)), pc.list_value_length(hashes).to_numpy(zero_copy_only=False))
            left = text.is_valid().to_numpy(zero_copy_only=False) & (np.bincount(block[hit], minlength=len(text)) == 0)
            article = article.to_numpy(zero_copy_only=False).astype(bool)
            row = np.repeat(np.arange(len(sizes)), sizes)
            main = np.bincount(row[left & article], minlength=len(sizes)) > 0
            left &= article | ~main[row]
            ends = np.concatenate(([0], np.cumsum(np.bincount(row[left], minlength=len(sizes)))))
            texts = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), text.filter(pa.array(left)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), texts], names=["id", "url", "texts"])

    return rows


def host_of(url: Column) -> Column:
    """The host of a URL in lower case, without a port; null where there is none."""
    host = F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    return F.when(host != "", host)


def extract_main_text(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html") -> DataFrame:
    """``(id, url, text, n_chars)`` for every row of ``pages``.

    White space inside a block becomes one space, blocks are trimmed and joined in
    page order by a line feed; character references are decoded. A line break
    element is white space. Null and empty pages, and pages without main text, give
    an empty text. Pages whose URL is null or has no host have no site, so nothing
    is template there. Equal rows are pages each. Other columns are ignored.
    """
    spark = pages.sparkSession
    scratch = Scratch(spark, "site-templates")
    given = pages.select(F.col(id_column).alias("id"), F.col(url_column).alias("url"), host_of(F.col(url_column)).alias("host"), F.col(html_column).alias("html"))
    kind = given.schema["id"].dataType.simpleString()
    parsed = given.mapInArrow(_parse, f"id {kind}, url string, host string, content bigint, blocks array<struct<text:string,article:boolean,hashes:array<bigint>>>")
    # rows are numbered in the table that all later steps read
    parsed = scratch.save(parsed.withColumn("row", F.monotonically_increasing_id()), "parsed")
    # pages of equal content count once
    sizes = parsed.filter("host is not null").select("host", "content").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    sizes, n_hosts = scratch.save_counted(sizes.filter(F.col("pages") >= TEMPLATE_PAGES), "hosts")
    # hashes hold the host
    hashes = F.array_distinct(F.flatten(F.transform("blocks", lambda b: b["hashes"])))
    each = parsed.filter("host is not null").select("row", "host", "content", F.explode(hashes).alias("hash"))
    counts = each.select("hash", "content", "host").groupBy("hash", "content").agg(F.min("host").alias("host"))
    counts = counts.groupBy("hash").agg(F.count(F.lit(1)).alias("on"), F.min("host").alias("host")).filter(F.col("on") >= TEMPLATE_PAGES)
    enough = F.least(TEMPLATE_SHARE * F.col("pages"), F.lit(MANY_PAGES))
    templates = counts.join(small(sizes, n_hosts["n"], 64), "host").filter(F.col("on") >= enough).select("hash")
    templates, seen = scratch.save_counted(templates, "templates")
    # hashes of few templates travel to the pages, else their marks are joined with them
    if 32 * seen["n"] <= BROADCAST_BYTES:
        hashes = np.array(sorted(r["hash"] for r in templates.collect()), np.int64)
        marked = parsed.select("id", "url", "blocks").mapInArrow(_without_templates(hashes), f"id {kind}, url string, texts array<string>")
    else:
        marks = each.select("row", "hash").join(templates, "hash").groupBy("row").agg(F.collect_list("hash").alias("template"))
        marked = parsed.join(marks, "row", "left")
        plain = F.col("template").isNull()
        left = F.filter("blocks", lambda b: b["text"].isNotNull() & (plain | ~F.arrays_overlap(b["hashes"], F.col("template"))))
        # a column of its own, evaluated once
        marked = marked.withColumn("blocks", F.explode(F.array(left)))
        main = F.exists("blocks", lambda b: b["article"])
        marked = marked.withColumn("texts", F.transform(F.filter("blocks", lambda b: ~main | b["article"]), lambda b: b["text"]))
    text = F.array_join("texts", "\n")
    return marked.select(F.col("id").alias(id_column), F.col("url").alias(url_column), text.alias("text")).withColumn("n_chars", F.length("text").cast("bigint"))
