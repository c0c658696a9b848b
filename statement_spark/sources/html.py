"""HTML pages to segments: the prose before a table, and the table's cells.

One row per page goes in and one row per page comes out, so nothing is shuffled here. The only
Python in the extraction path is the tag scan below, which runs over Arrow batches; captions,
headings, classes and numbers are Column expressions on its output.
"""
from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..functions import patterns as P, text as T

SEGMENT_TYPE = ("array<struct<nodes:array<string>,heading:array<string>,rows:array<array<string>>,links:array<array<string>>,"
                "cols:array<array<int>>>>")

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:_-]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*+|[^>]*)>",
    re.S,
)
_HREF = re.compile(r"""href\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_COLSPAN = re.compile(r"""colspan\s*=\s*["']?(\d{1,3})""", re.I)
_SPACE = re.compile(r"\s+")
_NOISE = frozenset(P.NOISE_TAGS)
_VOID = frozenset(P.VOID_TAGS)
_BLOCKS = frozenset(P.BLOCK_TAGS)
_NOISE_TAG = re.compile(rf"<(/?)({'|'.join(sorted(_NOISE))})\b[^<>]*>", re.I)


def _noise_ends(html: str) -> dict[int, int]:
    """Where each closed noise element ends, by the place where it opens; one pass for all tags."""
    ends: dict[int, int] = {}
    opened: dict[str, list[int]] = {}
    for m in _NOISE_TAG.finditer(html):
        stack = opened.setdefault(m.group(2).lower(), [])
        if m.group(1):
            if stack:
                ends[stack.pop()] = m.end()
        elif not m.group(0).endswith("/>"):
            stack.append(m.start())
    return ends


class _Open:
    """An open element: its name, the first text node inside it, and its children so far as intervals of text nodes.

    Both count from the last table; ``since`` brings an element up to date when it is met again behind one.
    """

    __slots__ = ("name", "start", "children", "table")

    def __init__(self, name: str, start: int, table: int):
        self.name, self.start, self.children, self.table = name, start, [], table

    def since(self, table: int) -> "_Open":
        if self.table != table:
            self.start, self.children, self.table = 0, [], table
        return self


def _is_heading(line: str) -> bool:
    """Whether text beside the parent of a table may be its heading: short, begun or worded like one, no disclaimer."""
    low = line.lower()
    return (len(line) < P.HEADING_CHARS and (line[0].isupper() or any(w in low for w in P.HEADING_WORDS))
            and not any(w in low for w in P.NO_HEADING_WORDS))


def _nearest(lines: Iterator[str]) -> list[str]:
    """Lines, given from the nearest on, until they reach CONTEXT_CHARS together; in reading order."""
    found, chars = [], 0
    for line in lines:
        found.append(line)
        chars += len(line)
        if chars >= P.CONTEXT_CHARS:
            break
    return found[::-1]


def heading(nodes: list[str], path: list[_Open], table: int) -> list[str]:
    """Text nodes that may head a table which opens now.

    The tree is kept as nested intervals: an element is the text nodes since its start. The table's own siblings are the
    nodes since its parent opened; if there are none, the heading-like siblings of the parent. Nothing further off
    heads a table.
    """
    start = path[-1].since(table).start
    if len(nodes) > start:
        return _nearest(nodes[i] for i in range(len(nodes) - 1, start - 1, -1))
    if len(path) < 2:
        return []
    beside = (" ".join(nodes[a:b]) for a, b in reversed(path[-2].since(table).children))
    return _nearest(line for line in beside if _is_heading(line))


def scan(html: str | None) -> list[dict]:
    """Segments of one page, in reading order. Tags need not be balanced."""
    segments: list[dict] = []
    nodes: list[str] = []
    rows: list[list[list[str]]] = []
    links: list[list[str]] = []
    cols: list[list[int]] = []  # first column of each cell, and behind the last one the end
    depth = 0
    in_cell = False
    tables = 0
    path = [_Open("", 0, 0)]
    names: Counter = Counter()
    above: list[str] = []

    def flush(with_table: bool) -> None:
        nonlocal nodes, rows, links, cols, in_cell, tables
        tables += 1
        if with_table or nodes:
            segments.append({
                "nodes": nodes,
                "heading": above if with_table else None,
                "rows": [[" ".join(c) for c in r] for r in rows if r] if with_table else None,
                "links": [ln for r, ln in zip(rows, links) if r] if with_table else None,
                "cols": [c for r, c in zip(rows, cols) if r] if with_table else None,
            })
        nodes, rows, links, cols, in_cell = [], [], [], [], False

    def text(raw: str) -> None:
        clean = _SPACE.sub(" ", unescape(raw)).strip()
        if not clean:
            return
        if depth and in_cell:
            rows[-1][-1].append(clean)
        else:
            path[-1].since(tables).children.append((len(nodes), len(nodes) + 1))
            nodes.append(clean)

    def close() -> None:
        element = path.pop().since(tables)
        names[element.name] -= 1
        if len(nodes) > element.start:
            path[-1].since(tables).children.append((element.start, len(nodes)))

    html = html or ""
    ends = _noise_ends(html)
    last = html.rfind(">") + 1  # no tag ends behind it
    at = 0
    while (m := _TAG.search(html, at, last)) is not None:
        if m.start() > at:
            text(html[at:m.start()])
        at = m.end()
        name = (m.group(2) or "").lower()
        closing = bool(m.group(1))
        if name in _NOISE and not closing and not m.group(0).endswith("/>"):
            at = max(at, ends.get(m.start(), at))
        elif name == "table":
            if not closing:
                if not depth:
                    if path[-1].name == "p":
                        close()
                    above = heading(nodes, path, tables)
                depth += 1
            elif depth:
                depth -= 1
                if depth == 0:
                    flush(True)
        elif not depth:
            if not name or name in _VOID or m.group(0).endswith("/>"):
                continue
            if not closing:
                if name in _BLOCKS and path[-1].name == "p":
                    close()
                path.append(_Open(name, len(nodes), tables))
                names[name] += 1
            elif names[name]:
                while path[-1].name != name:
                    close()
                close()
        elif name == "tr":
            in_cell = False
            if not closing:
                rows.append([])
                links.append([])
                cols.append([0])
        elif name in ("td", "th"):
            in_cell = not closing
            if not closing:
                if not rows:
                    rows.append([])
                    links.append([])
                    cols.append([0])
                rows[-1].append([])
                links[-1].append("")
                span = _COLSPAN.search(m.group(3) or "")
                cols[-1].append(cols[-1][-1] + (max(int(span.group(1)), 1) if span else 1))
        elif name == "a" and not closing and in_cell:
            h = _HREF.search(m.group(3) or "")
            if h and not links[-1][-1]:
                links[-1][-1] = unescape(next(g for g in h.groups() if g is not None))
    if at < len(html):
        text(html[at:])
    flush(depth > 0)
    return segments


def page_segments(pages: DataFrame, html: str = "html") -> DataFrame:
    """All columns but the page text, plus ``segments``."""
    keep = [c for c in pages.columns if c != html]
    out = ", ".join(f"`{c}` {pages.schema[c].dataType.simpleString()}" for c in keep)
    seg = pa.list_(pa.struct([
        ("nodes", pa.list_(pa.string())),
        ("heading", pa.list_(pa.string())),
        ("rows", pa.list_(pa.list_(pa.string()))),
        ("links", pa.list_(pa.list_(pa.string()))),
        ("cols", pa.list_(pa.list_(pa.int32()))),
    ]))

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cells = pa.array([scan(h) for h in b.column(b.num_columns - 1).to_pylist()], seg)
            yield pa.RecordBatch.from_arrays(
                [b.column(i) for i in range(b.num_columns - 1)] + [cells], keep + ["segments"]
            )

    ready = pages.select(*keep, T.strip_envelope(F.col(html)).alias(html))
    return ready.mapInArrow(parse, f"{out}, segments {SEGMENT_TYPE}")


def prose(segments: Column) -> Column:
    """Text outside tables, one node per line."""
    return F.array_join(F.flatten(F.transform(segments, lambda s: s["nodes"])), "\n")


def full_text(segments: Column) -> Column:
    """All text of a page, tables included."""
    parts = F.transform(
        segments,
        lambda s: F.concat(
            s["nodes"], F.coalesce(F.flatten(s["rows"]), F.array().cast("array<string>"))
        ),
    )
    return F.array_join(F.flatten(parts), " ")


def document_type(url: Column) -> Column:
    """A page without an address cannot be read; anything else is HTML."""
    return F.when(url.isNull() | (url == ""), "failed").otherwise("html")


def exhibit_links(pages: DataFrame, key: str, base: str = "https://www.sec.gov") -> DataFrame:
    """Exhibits listed by filing-index pages: (key, exhibit_no, url), first is the main one."""
    rows = F.flatten(F.transform(
        F.filter("segments", lambda s: s["rows"].isNotNull()),
        lambda s: F.zip_with(
            s["rows"], s["links"],
            lambda c, h: F.struct(F.upper(F.trim(F.get(c, F.lit(3)))).alias("type"),
                                  F.get(h, F.lit(2)).alias("href"), F.size(c).alias("n")),
        ),
    ))
    listed = F.filter(
        rows, lambda x: (x["n"] >= 4) & x["type"].isin(*P.EXHIBIT_TYPES) & (x["href"] != "")
    )
    href = F.col("x.href")
    return page_segments(pages).select(key, F.posexplode(listed).alias("i", "x")).select(
        key,
        (F.col("i") + 1).alias("exhibit_no"),
        F.when(href.startswith("/"), F.concat(F.lit(base), href)).otherwise(href).alias("url"),
    )
