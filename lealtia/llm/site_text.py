"""Main text of web pages, without what a site repeats.

Every element outside the running text is hashed with all it holds. Spark counts on how many pages of a
host each hash stands; subtrees on many of them are template and are deleted, and so are the elements
that are menus, forms or the like by their tag, role, class or id. What is left of the article is the text.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lealtia.llm.common import SMALL_ROWS, stored

#: A subtree is template if it is on at least so many pages of its host, however large the host is.
MIN_PAGES = 3
#: Inside an article it is template only on so many pages and on at least half of its host's pages.
MIN_ARTICLE_PAGES = 10
#: Templates travel as one list per host up to so many on a host; beyond, every page gets those that it holds.
LIST_ROWS = 1_000

# Names of elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe svg template".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 head header hr html legend li main nav ol option p pre section summary table tbody td tfoot th"
    " thead tr ul".split()
)
DROPPED = frozenset("head nav footer aside form script style textarea title noscript iframe svg template button select dialog".split())
RUNNING = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre figcaption dt dd td th tr tbody thead li".split())
CLOSED_BY_SELF = frozenset("p li dt dd td th tr option".split())
# Words in class, id and role that mark what is not article.
MARKS = frozenset(
    "ad ads adbox advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie"
    " cookies disqus footer gdpr masthead menu menubar modal nav navbar navigation newsletter notice notices overlay"
    " paywall popup promo promoted related replies reply share sharing sidebar sidenav signup social sponsor sponsored"
    " subscribe toolbar topbar widget contentinfo complementary search".split()
)

NAME = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)")
RAW_END = {name: re.compile(rf"</{name}(?=[\s/>]|\Z)", re.I) for name in RAW}
MARKED = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)
WORD = re.compile(r"[a-z0-9]+")


class Tags:
    """The tags and comments of a source in order, in time that grows with its length.

    A quoted value may hold any sign. A sign that opens a tag which never ends is text.
    """

    def __init__(self, source: str) -> None:
        self.source = source
        self._ahead: dict[str, int] = {}
        self._hopeless: set[int] = set()

    def _next(self, sign: str, at: int) -> int:
        """Place of the next ``sign`` from ``at`` on, else the length; the last answer serves while it is ahead."""
        place = self._ahead.get(sign, -1)
        if place < at:
            place = self.source.find(sign, at)
            self._ahead[sign] = place = len(self.source) if place < 0 else place
        return place

    def _end(self, at: int) -> int:
        """Place behind the sign that ends the tag whose name ends at ``at``, or -1."""
        passed = []
        while True:
            close, quote = self._next(">", at), min(self._next('"', at), self._next("'", at))
            if close < quote:
                return close + 1
            # What begins before a mark from which no way led to an end does not end either.
            if quote == len(self.source) or quote in self._hopeless:
                break
            passed.append(quote)
            at = self.source.find(self.source[quote], quote + 1) + 1
            if not at:
                break
        self._hopeless.update(passed)
        return -1

    def __iter__(self) -> Iterator[tuple[int, int, bool, str | None, str]]:
        """First and end place, whether it closes, lower-case name (None for a comment), attributes."""
        source, at = self.source, 0
        while True:
            start = source.find("<", at)
            if start < 0:
                return
            at = start + 1
            if source.startswith("<!--", start):
                end = source.find("-->", start + 4)
                at = len(source) if end < 0 else end + 3
                yield start, at, False, None, ""
            elif source[at : at + 1] in ("!", "?"):
                end = self._next(">", at)
                if end < len(source):
                    at = end + 1
                    yield start, at, False, None, ""
            elif match := NAME.match(source, start):
                end = self._end(match.end())
                if end < 0:
                    continue
                at, name = end, match.group(2).lower()
                attributes = source[match.end() : end - 1]
                yield start, end, bool(match.group(1)), name, attributes
                if name in RAW and not match.group(1) and not attributes.endswith("/"):
                    # Nothing is markup inside until its own end tag, or the end of the page.
                    close = RAW_END[name].search(source, end)
                    at = close.start() if close else len(source)


class Page:
    """The elements of a page, and its texts in order, each with its element and its block."""

    def __init__(self, source: str) -> None:
        self.tags, self.parents, self.dropped, self.hashes = ["html"], [-1], [False], [0]
        self.texts: list[tuple[int, int, str]] = []
        self._content: list[list[str]] = [[]]
        self._wrappers: set[int] = set()
        self._stack, self._block = [0], 0
        self._parse(source)
        while len(self._stack) > 1:
            self._close()
        self._keep_wrappers()

    def _keep_wrappers(self) -> None:
        """A form, or an element marked by a word, stays if it is around the article, else around the main part,
        else around the first heading."""
        for tag in ("article", "main", "h1"):
            first = next((i for i, t in enumerate(self.tags) if t == tag and not self.dropped[i]), None)
            if first is not None:
                node = self.parents[first]
                while node > 0:
                    if node in self._wrappers:
                        self.dropped[node] = False
                    node = self.parents[node]
                return

    def _parse(self, source: str) -> None:
        at, raw = 0, False
        for start, end, closes, name, attributes in Tags(source):
            if start > at and not raw:
                self._text(source[at:start])
            at, raw = end, False
            if name is None:
                continue
            if closes:
                self._end(name)
            else:
                self._start(name, attributes)
                raw = name in RAW and not attributes.endswith("/")
        if not raw and at < len(source):
            self._text(source[at:])

    def _text(self, text: str) -> None:
        if text and not (text.isspace() and not self.texts):
            self.texts.append((self._stack[-1], self._block, text))
            if not text.isspace():
                self._content[self._stack[-1]].append(" ".join(text.split()))

    def _start(self, name: str, attributes: str) -> None:
        if name in BLOCK:
            self._block += 1
            if name in CLOSED_BY_SELF:
                self._end(name, inside=CLOSED_BY_SELF)
            elif self.tags[self._stack[-1]] == "p" or "p" in [self.tags[i] for i in self._stack[-4:]]:
                self._end("p", inside=CLOSED_BY_SELF)
        elif name == "br":
            self.texts.append((self._stack[-1], self._block, " "))
        if name in VOID or name in ("html", "body"):
            return
        dropped = name in DROPPED or name == "header" and not self.inside(self._stack[-1], "article")
        wrapper = name == "form"
        if attributes and not dropped and name not in ("article", "main"):
            dropped = bool(HIDDEN.search(attributes))
            if not dropped:
                dropped = wrapper = any(
                    not MARKS.isdisjoint(WORD.findall((a or b or c).lower())) for a, b, c in MARKED.findall(attributes)
                )
        elif attributes and name == "article":
            dropped = any(
                not {"comment", "comments", "reply", "related"}.isdisjoint(WORD.findall((a or b or c).lower()))
                for a, b, c in MARKED.findall(attributes)
            )
        self.tags.append(name)
        self.parents.append(self._stack[-1])
        self.dropped.append(dropped)
        if dropped and wrapper:
            self._wrappers.add(len(self.tags) - 1)
        self.hashes.append(0)
        self._content.append([])
        self._stack.append(len(self.tags) - 1)

    def _end(self, name: str, inside: frozenset[str] | None = None) -> None:
        """Close the innermost open element of that name; an inline one, or ``inside``, only up to the next block."""
        for depth in range(len(self._stack) - 1, 0, -1):
            tag = self.tags[self._stack[depth]]
            if tag == name:
                while len(self._stack) > depth:
                    self._close()
                break
            if tag in BLOCK and (name not in BLOCK or inside and tag not in inside or inside and tag in ("td", "th")):
                break
        if name in BLOCK:
            self._block += 1

    def _close(self) -> None:
        node = self._stack.pop()
        content = self._content[node]
        if any(content):
            key = xxhash.xxh64_intdigest(f"{self.tags[node]}\x1f" + "\x1f".join(content)) >> 1
            self.hashes[node] = key
            self._content[self._stack[-1]].append(f"{key:x}")
        self._content[node] = []

    def inside(self, node: int, tag: str) -> bool:
        while node > 0:
            if self.tags[node] == tag:
                return True
            node = self.parents[node]
        return False

    def areas(self) -> tuple[list[bool], list[bool]]:
        """Per element: whether it is in the article (or main part), and whether it holds one or a main heading."""
        name = next((t for t in ("article", "main") if any(
            tag == t and not self.dropped[i] for i, tag in enumerate(self.tags))), None)
        within, holds = [False] * len(self.tags), [False] * len(self.tags)
        for i, tag in enumerate(self.tags):
            within[i] = name is not None and (tag == name and not self.dropped[i] or i > 0 and within[self.parents[i]])
        for i in range(len(self.tags) - 1, -1, -1):
            if self.tags[i] in ("article", "main", "h1") or holds[i]:
                holds[i] = True
                if i:
                    holds[self.parents[i]] = True
        self.whole = name is None
        return within, holds

    def subtrees(self) -> dict[int, int]:
        """Hash of every element that could be template, by its number; odd for one inside the article."""
        within, holds = self.areas()
        return {
            i: self.hashes[i] & ~1 | within[i]
            for i in range(1, len(self.tags))
            if self.hashes[i] and not holds[i] and self.tags[i] in BLOCK and not (within[i] and self.tags[i] in RUNNING)
        }

    def main_text(self, template: frozenset[int]) -> str:
        """The blocks that are article and not template."""
        subtrees = self.subtrees()
        within, _ = self.areas()
        gone = [False] * len(self.tags)
        for i in range(len(self.tags)):
            gone[i] = self.dropped[i] or i in subtrees and subtrees[i] in template or i > 0 and gone[self.parents[i]]
        blocks: dict[int, list[str]] = {}
        for node, block, text in self.texts:
            if not gone[node] and (self.whole or within[node]):
                blocks.setdefault(block, []).append(text)
        joined = (" ".join(html.unescape("".join(parts)).split()) for parts in blocks.values())
        return "\n\n".join(b for b in joined if b)


def host_of(url: Column) -> Column:
    pattern = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), pattern, 1))


def page_subtrees(pages: DataFrame) -> DataFrame:
    """``host``, ``page`` (a hash of the text before any template is deleted), ``source`` (of the html) and the ``subtree`` hashes of every page."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pages, found = [], []
            for source in batch.column(1).to_pylist():
                page = Page(source or "")
                pages.append(xxhash.xxh64_intdigest(page.main_text(frozenset())) >> 1)
                found.append(sorted(set(page.subtrees().values())))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(pages, pa.int64()), batch.column(2), pa.array(found, pa.list_(pa.int64()))],
                names=["host", "page", "source", "subtrees"],
            )

    source = F.col("html").cast("string")
    return pages.select(
        host_of(F.col("url")).alias("host"), source.alias("html"), F.xxhash64(source).alias("source")
    ).mapInArrow(rows, "host string, page long, source long, subtrees array<long>")


def site_templates(found: DataFrame, min_pages: int = MIN_PAGES) -> DataFrame:
    """``host`` and ``subtree`` of what stands on many of a host's pages, from its ``page_subtrees``.

    Pages with the same text count once, whatever their addresses, menus in marked elements or scripts. What stands
    inside articles, such as the same body under the parts of a serial, has to be on half of the host's pages.
    """
    counts = found.select("host", "page").distinct().groupBy("host").agg(F.count("*").alias("pages"))
    single = found.select("host", "page", F.explode("subtrees").alias("subtree")).distinct()
    counted = single.groupBy("host", "subtree").agg(F.count("*").alias("n")).where(F.col("n") >= min_pages)
    inside = F.col("subtree") % 2 == 1
    often = (F.col("n") >= MIN_ARTICLE_PAGES) & (2 * F.col("n") >= F.col("pages"))
    return counted.join(counts, "host").where(~inside | often).select("host", "subtree")


def extract_main_text(pages: DataFrame, min_pages: int = MIN_PAGES, list_rows: int = LIST_ROWS) -> DataFrame:
    """``page_id``, ``url`` and the main ``text`` of every page.

    A null or empty source, or a page of template alone, gives an empty text. Pages without an address
    share one nameless host; repeated rows each give a row; extra columns are left out. An empty table
    gives no rows. Texts are never cut; an element that holds an article or a main heading is no template, and
    neither its class nor being a form deletes it. Very long sources take time in proportion to their length.
    """
    found = stored(page_subtrees(pages), "page-subtrees")
    templates = stored(site_templates(found, min_pages), "site-templates")
    few = templates.limit(SMALL_ROWS + 1).count() <= SMALL_ROWS
    if few and not templates.groupBy("host").count().where(F.col("count") > list_rows).limit(1).count():
        keys = ["host"]
        held = F.broadcast(templates.groupBy("host").agg(F.sort_array(F.collect_list("subtree")).alias("template")))
    else:
        keys = ["host", "source"]
        single = found.select("host", "source", F.explode("subtrees").alias("subtree")).distinct()
        held = (
            single.join(F.broadcast(templates) if few else templates, ["host", "subtree"])
            .groupBy(keys)
            .agg(F.sort_array(F.collect_list("subtree")).alias("template"))
        )

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [
                Page(source or "").main_text(frozenset(template or ()))
                for template, source in zip(*(batch.column(i).to_pylist() for i in (2, 3)))
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"]
            )

    named = pages.select(
        F.col("page_id").cast("long"),
        F.col("url").cast("string"),
        host_of(F.col("url")).alias("host"),
        F.xxhash64(F.col("html").cast("string")).alias("source"),
        F.col("html").cast("string").alias("html"),
    )
    return (
        named.join(held, keys, "left")
        .select("page_id", "url", "template", "html")
        .mapInArrow(rows, "page_id long, url string, text string")
    )
