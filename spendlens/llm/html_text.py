"""Main text of web pages by differencing pages that are near by URL.

The pages of a host are ordered by URL path; each is paired with the nearest page before and after it
whose lines differ from its own: copies (a recrawl, a mirror path) say nothing about what is frame. The text lines (blocks) of the two are aligned by their longest common subsequence, and lines
that a page shares with a neighbour are deleted. Elements that are never article text (menus,
headers, footers, sidebars, notices, adverts, forms, scripts, styles, comments) are left out first,
and where a page marks its article (``article`` or ``main``) only what lies inside is text and what
lies inside is safe from the deletion: neighbours may quote the same passage. So differencing
decides for all lines of a page that marks no article.

Neighbours exchange hashes of lines only. The order is made in ranges, so a host with a third of
all pages is split; a range hands on its first and last row and what differs from them. Pages of one host and path are ordered
by page_id. Null html or url counts as empty; rows that repeat page_id and url have the same
neighbours. Malformed markup never fails: what cannot be read as a tag is text. Extra columns are
ignored.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator
from html import unescape
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..functions.staging import staged
from .shipping import ship
from .words import slices

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:\s(?:[^>\"']|\"[^\"]*\"|'[^']*')*|/)?)>"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)(?:>|\Z)", re.S)
_MARK = re.compile(r"""(?:^|\s)(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_RAW = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_OUT = {"head", "nav", "header", "footer", "aside", "form", "noscript", "template", "object", "svg", "math", "canvas",
        "audio", "video", "select", "button", "dialog", "menu", "fieldset", "label"} | _RAW
_MAIN = {"article", "main"}
_BLOCK = {"address", "article", "blockquote", "body", "caption", "center", "dd", "details", "div", "dl", "dt", "figcaption",
          "figure", "h1", "h2", "h3", "h4", "h5", "h6", "hr", "html", "li", "main", "ol", "p", "pre", "section", "summary",
          "table", "tbody", "tfoot", "thead", "tr", "ul"} | _OUT
_FRAME = {"ad", "ads", "advert", "advertisement", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "consent",
          "cookie", "cookies", "disqus", "footer", "header", "login", "masthead", "menu", "modal", "nav", "navbar",
          "navigation", "newsletter", "notice", "notices", "pager", "pagination", "popup", "promo", "related", "respond",
          "share", "sharing", "sidebar", "social", "sponsor", "sponsored", "subscribe", "toolbar", "widget"}
_SAFE = {"html", "body"} | _MAIN
#: A block tag that ends an open paragraph.
_ENDS_P = _BLOCK - {"html", "body"}


def _framed(name: str, attributes: str) -> bool:
    if name in _SAFE or not attributes:
        return False
    for found in _MARK.findall(attributes):
        if _FRAME & set(re.split(r"[\s_-]+", "".join(found).lower())):
            return True
    return False


def lines_of(html: str) -> list[tuple[str, bool]]:
    """The text blocks of a page in order, each with whether it lies in a marked article."""
    lines: list[tuple[str, bool]] = []
    held: list[str] = []
    stack: list[tuple[str, bool, bool]] = []  # name, left out, in the article
    out = main = False
    at, size = 0, len(html)

    def flush() -> None:
        text = " ".join("".join(held).split())
        held.clear()
        if text:
            lines.append((text, main))

    while at < size:
        found = _TAG.search(html, at)
        if not out:
            text = html[at:found.start() if found else size]
            if text:
                held.append(unescape(text) if "&" in text else text)
        if not found:
            break
        at = found.end()
        closing, name, attributes = found.group(1, 2, 3) if found.group(2) else found.group(4, 5, 6)
        if not name:
            continue
        name = name.lower()
        if name in _BLOCK:
            flush()
        elif not out and name in ("br", "td", "th"):
            held.append(" ")
        if closing:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    del stack[i:]
                    break
        elif name in _RAW:
            end = re.compile(rf"</{name}[\s/>]", re.I).search(html, at)
            close = html.find(">", end.start()) if end else -1
            at = close + 1 if close >= 0 else size
        elif name not in _VOID and not (attributes or "").endswith("/"):
            if name in _ENDS_P:
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] == "p":
                        del stack[i:]
                        break
                    if stack[i][0] in _BLOCK:
                        break
            was_out, was_main = stack[-1][1:] if stack else (False, False)
            stack.append((name, was_out or name in _OUT or _framed(name, attributes), was_main or name in _MAIN))
        out, main = stack[-1][1:] if stack else (False, False)
    flush()
    return lines


def common_lines(own: list[int], other: list[int]) -> set[int]:
    """Positions in ``own`` of a longest common subsequence with ``other``."""
    begin = 0
    while begin < min(len(own), len(other)) and own[begin] == other[begin]:
        begin += 1
    tail = 0
    while tail < min(len(own), len(other)) - begin and own[-1 - tail] == other[-1 - tail]:
        tail += 1
    shared = set(range(begin)) | set(range(len(own) - tail, len(own)))
    places: dict[int, list[int]] = {}
    for j in range(len(other) - tail - 1, begin - 1, -1):
        places.setdefault(other[j], []).append(j)
    ends: list[int] = []  # the smallest end in other of a common subsequence of each length
    last: list[tuple | None] = []  # the chain behind it
    for i in range(begin, len(own) - tail):
        for j in places.get(own[i], ()):
            k = bisect_left(ends, j)
            chain = (i, last[k - 1] if k else None)
            if k == len(ends):
                ends.append(j)
                last.append(chain)
            elif j < ends[k]:
                ends[k], last[k] = j, chain
    chain = last[-1] if last else None
    while chain:
        shared.add(chain[0])
        chain = chain[1]
    return shared


def _hash(line: str) -> int:
    return int.from_bytes(hashlib.blake2b(line.encode("utf-8", "replace"), digest_size=8).digest(), "little", signed=True)


def _address(url: str) -> tuple[str, str]:
    try:
        parts = urlsplit(url)
        return parts.netloc.lower().rpartition("@")[2], parts.path + ("?" + parts.query if parts.query else "")
    except ValueError:
        return "", url


_KEYED = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("host", pa.string()), ("path", pa.string()),
                    ("hashes", pa.list_(pa.int64()))])


def _outlines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "html"):
            addresses = [_address(u or "") for u in part.column("url").to_pylist()]
            hashes = [[_hash(t) for t, main in lines_of(h or "") if not main] for h in part.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column("page_id"), part.column("url"), pa.array([a for a, _ in addresses], pa.string()),
                 pa.array([b for _, b in addresses], pa.string()), pa.array(hashes, pa.list_(pa.int64()))], schema=_KEYED)


_TEXT = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.large_string()), ("n_chars", pa.int64())])


def _difference(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "html"):
            texts = []
            for html, *beside in zip(*(part.column(c).to_pylist() for c in ("html", "before", "after"))):
                lines = lines_of(html or "")
                if any(main for _, main in lines):
                    lines = [x for x in lines if x[1]]
                free = [i for i, (_, main) in enumerate(lines) if not main]
                own = [_hash(lines[i][0]) for i in free]
                shared = set().union(*(common_lines(own, other) for other in beside if other)) if own else set()
                gone = {free[k] for k in shared}
                texts.append("\n".join(t for i, (t, _) in enumerate(lines) if i not in gone))
            yield pa.RecordBatch.from_arrays(
                [part.column("page_id"), part.column("url"), pa.array(texts, pa.large_string()),
                 pa.array([len(t) for t in texts], pa.int64())], schema=_TEXT)


def neighbours(pages: DataFrame) -> DataFrame:
    """page_id, url, and the line hashes of the nearest pages before and after on the same host that
    differ from its own (null: none)."""
    order = ["host", "path", "page_id", "url"]
    keyed = pages.mapInArrow(_outlines, "page_id long, url string, host string, path string, hashes array<bigint>")
    ranged = staged(keyed.dropDuplicates(["page_id", "url"]).repartitionByRange(*order)
                    .withColumn("range", F.spark_partition_id()), "page-order")
    row, key = F.struct("host", "hashes"), F.struct(*order)
    placed = _differing(ranged, Window.partitionBy("range"), order, row, "b", "a")
    # a run of equal pages may begin and end ranges away: at most four rows of each range tell
    edges = placed.groupBy("range").agg(F.min_by(F.struct(row.alias("row"), "a"), key).alias("first"),
                                        F.max_by(F.struct(row.alias("row"), "b"), key).alias("last"))
    ends = (edges.select("range", F.posexplode(F.array("first.row", "first.a", "last.b", "last.row")).alias("at", "row"))
            .filter("row IS NOT NULL"))
    ends = _differing(ends, Window.partitionBy(), ["range", "at"], F.col("row"), "b", "a").groupBy("range").agg(
        F.min_by("b", "at").alias("first_before"), F.max_by("a", "at").alias("last_after"))
    placed = placed.join(ends, "range")

    def beside(own: str, edge: str):
        other = F.coalesce(own, edge)
        return F.when(other["host"] == F.col("host"), other["hashes"])

    return placed.select("page_id", "url", beside("b", "first_before").alias("before"), beside("a", "last_after").alias("after"))


def _differing(rows: DataFrame, part: WindowSpec, order: list[str], value: Column, before: str, after: str) -> DataFrame:
    """Adds the nearest value before and after each row that differs from its own."""
    for name, by in ((before, [F.col(c).asc() for c in order]), (after, [F.col(c).desc() for c in order])):
        window = part.orderBy(*by)
        rows = rows.withColumn(name, F.lag(value).over(window))
        other = F.when(~F.col(name).eqNullSafe(value), F.col(name))
        rows = rows.withColumn(name, F.last(other, ignorenulls=True).over(window.rowsBetween(Window.unboundedPreceding, 0)))
    return rows


def main_text(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text (blocks joined by line feeds, empty if none), n_chars."""
    ship(pages.sparkSession)
    pages = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    near = neighbours(pages).withColumnsRenamed({"page_id": "near_id", "url": "near_url"})
    both = pages.join(near, F.col("page_id").eqNullSafe(F.col("near_id")) & F.col("url").eqNullSafe(F.col("near_url")), "left")
    return both.select("page_id", "url", "html", "before", "after").mapInArrow(
        _difference, "page_id long, url string, text string, n_chars long")
