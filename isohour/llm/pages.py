"""Main text of web pages: differencing against the page with the nearest URL, where structure does not say what is text.

A page is cut into lines, one per block element, each marked by where it stands: inside an article,
inside a main element, elsewhere, or in boilerplate (menus, headers, footers, sidebars, notices, adverts,
forms, scripts, reader comments). Every page is compared with a page of the same host: pages are sorted by host and path,
and of its two neighbours the one whose path agrees with its own the longer is the nearest (of equals the one before).
All lines of both, boilerplate too, are aligned by a longest common subsequence, and shared lines are deleted as template.

Boilerplate goes. Where a page has an article (or else a main element), only its lines are text. Shared lines
inside an article stay: copies of an article and passages that many articles
share are text, and its own mark-up says so. A pair that shares more than ``copy_share`` of its
characters is two copies, not one template, and deletes nothing; the other neighbour is compared instead.

Sorting is by range, so a host of any size is spread over tasks; at a border between tasks a page's
neighbour is the one on its own side.

Defined results: null and empty pages have an empty text. A null URL has an empty host and path. Repeated
rows keep a row each. Cut-off pages keep what is there. Extra columns are ignored.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain, islice
from os.path import commonprefix
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from isohour.llm.common import slices
from isohour.llm.urls import host_of, path_of

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attributes>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)(?:>|\Z)"
    r"|<(?P<close2>/?)(?P<name2>[a-zA-Z][^\s/>]*)(?P<attributes2>[^>]*)(?:>|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))")
RAW = frozenset("script style textarea title noscript template iframe xmp noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike "
    "strong sub sup time tt u var wbr img".split()
)
BOILERPLATE = frozenset("head nav footer aside form button select option dialog menu svg canvas object audio video map datalist".split())
#: Words of class, id and role that mark boilerplate; the second set only outside articles.
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo cookie cookies consent gdpr notice sidebar menu nav "
    "navbar navigation breadcrumb breadcrumbs footer comment comments disqus replies share sharing social newsletter subscribe "
    "related popup modal toolbar pagination login signup search contentinfo complementary".split()
)
OUTER_MARKS = frozenset("header banner masthead topbar widget".split())
BOILER, OPEN, MAIN, ARTICLE = 0, 1, 2, 3
RESULTS = 256  # rows of a result batch


def marks(attributes: str) -> set[str]:
    found: set[str] = set()
    for name, *values in ATTRIBUTE.findall(attributes):
        if name.lower() in ("class", "id", "role"):
            found.update(re.split(r"[^a-z]+", "".join(values).lower()))
    return found


def lines_of(page: str | None) -> list[tuple[str, int]]:
    """All lines and where each stands."""
    page = page or ""
    found: list[tuple[str, int]] = []
    text: list[str] = []
    stack: list[tuple[str, int]] = []  # element, place inside it
    place, at, size = OPEN, 0, len(page)

    def end_line() -> None:
        if text:
            line = " ".join(html.unescape("".join(text)).split())
            if line:
                found.append((line, place))
            text.clear()

    while at < size:
        m = TOKEN.search(page, at)
        if m is None:
            text.append(page[at:])
            break
        if m.start() > at:
            text.append(page[at : m.start()])
        at = m.end()
        name = (m["name"] or m["name2"] or "").lower()
        if not name:
            continue
        if m["close"] or m["close2"]:
            if name not in INLINE:
                end_line()
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == name:
                    if place == BOILER:
                        end_line()
                    del stack[depth:]
                    place = stack[-1][1] if stack else OPEN
                    break
            continue
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at)
            at = end.end() if end else size
            continue
        if name not in INLINE:
            end_line()
        if name in VOID:
            continue
        inner = place
        if place:
            said = marks(m["attributes"] or m["attributes2"] or "")
            outer = place != ARTICLE and (name == "header" or not said.isdisjoint(OUTER_MARKS))
            if name in BOILERPLATE or outer or not said.isdisjoint(MARKS):
                inner = BOILER
            elif name == "article":
                inner = ARTICLE
            elif name == "main" or "main" in said:
                inner = max(place, MAIN)
        if name not in INLINE or inner != place:
            if name in INLINE:
                end_line()
            stack.append((name, inner))
            place = inner
    end_line()
    return found


def common(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Index pairs of a longest common subsequence: for each line of ``a`` its places in ``b`` from the last
    to the first extend the longest rising run."""
    places = defaultdict(list)
    for j, line in enumerate(b):
        places[line].append(j)
    tops: list[int] = []
    links: list[tuple | None] = []
    for i, line in enumerate(a):
        for j in reversed(places.get(line, ())):
            k = bisect_left(tops, j)
            link = (i, j, links[k - 1] if k else None)
            if k == len(tops):
                tops.append(j)
                links.append(link)
            else:
                tops[k], links[k] = j, link
    found, link = [], links[-1] if links else None
    while link:
        found.append(link[:2])
        link = link[2]
    return found[::-1]


class Page(NamedTuple):
    page_id: int | None
    url: str | None
    host: str
    path: str
    lines: list[str]
    places: list[int]

    def template(self, neighbours: list[Page], copy_share: float) -> set[int]:
        """Which lines the nearest neighbour by path that is no copy holds in the same order."""
        for other in sorted(neighbours, key=lambda page: -len(commonprefix((self.path, page.path)))):
            shared = {i for i, _ in common(self.lines, other.lines)}
            weight = sum(len(self.lines[i]) for i in shared)
            if 2 * weight <= copy_share * (sum(map(len, self.lines)) + sum(map(len, other.lines))):
                return shared
        return set()

    def text(self, template: set[int]) -> str:
        """The lines of the innermost place that has any; those of the template only inside an article."""
        best = max(self.places, default=BOILER)
        if best == BOILER:
            return ""
        lines = zip(self.lines, self.places)
        return " ".join([line for i, (line, place) in enumerate(lines) if place == best and (place == ARTICLE or i not in template)])


def pages_of(batches: Iterator[pa.RecordBatch], batch_bytes: int) -> Iterator[Page]:
    for batch in slices(batches, "html", batch_bytes):
        for page_id, url, host, path, page in zip(*batch.columns):
            found = lines_of(page.as_py())
            lines, places = [line for line, _ in found], [place for _, place in found]
            yield Page(page_id.as_py(), url.as_py(), host.as_py(), path.as_py(), lines, places)


def extract(pages: DataFrame, copy_share: float = 0.6, batch_bytes: int = 8 << 20) -> DataFrame:
    """page_id, url, text and n_chars of every page."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made() -> Iterator[tuple[int | None, str | None, str]]:
            before = current = None
            for after in chain(pages_of(batches, batch_bytes), [None]):
                if current:
                    near = [page for page in (before, after) if page and page.host == current.host]
                    yield current.page_id, current.url, current.text(current.template(near, copy_share))
                before, current = current, after

        results = made()
        while some := list(islice(results, RESULTS)):
            types = pa.int64(), pa.string(), pa.string()
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*some), types)], ["page_id", "url", "text"])

    order = "host", "path", "page_id"
    placed = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"),
        F.col("url").alias("url"),
        host_of(F.col("url")).alias("host"),
        path_of(F.col("url")).alias("path"),
        F.coalesce(F.col("html"), F.lit("")).alias("html"),
    )
    sorted_pages = placed.repartitionByRange(*order).sortWithinPartitions(*order)
    found = sorted_pages.mapInArrow(rows, "page_id bigint, url string, text string")
    return found.withColumn("n_chars", F.length("text").cast("long"))
