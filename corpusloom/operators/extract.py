"""Blocks and tables from HTML, and plain text made even: parsing is a small helper inside Arrow functions."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from html import unescape
from html.parser import HTMLParser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.sliced import each_text

BLOCK = "array<struct<type:string,level:int,text:string>>"
TABLE = "array<struct<table:int,r:int,c:int,rowspan:int,colspan:int,text:string>>"
#: Fixed sets of tags.
SILENT = {"script", "style", "noscript", "template", "svg", "head"}
HEADING = {f"h{n}": n for n in range(1, 7)}
ITEM = {"li", "dt", "dd"}
BREAKING = {"p", "div", "section", "article", "main", "header", "footer", "aside", "nav", "ul", "ol", "dl", "table", "tr", "td", "th", "blockquote", "pre", "br", "hr", "figure", "figcaption", "form", "body"}
_INVISIBLE = re.compile("[\u00ad\u200b\ufeff]")


def clean(text: str) -> str:
    """Entities decoded, NFKC, no invisible characters, white space as single blanks."""
    text = unescape(text)
    # Plain letters are as they should be.
    return " ".join((text if text.isascii() else _INVISIBLE.sub("", unicodedata.normalize("NFKC", text))).split())


class _Events(HTMLParser):
    """What a page consists of, in order: (+1, tag) and (-1, tag) for tags, (0, text) for text."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.seen: list[tuple[int, str]] = []
        self.handle_starttag = lambda tag, attrs: self.seen.append((1, tag))
        self.handle_endtag = lambda tag: self.seen.append((-1, tag))
        self.handle_data = lambda data: self.seen.append((0, data))


def _audible(events: list[tuple[int, str]]) -> Iterator[tuple[int, str]]:
    """The events outside of silent tags."""
    inside = 0
    for sign, what in events:
        if sign and what in SILENT:
            inside = max(0, inside + sign)
        elif not inside:
            yield sign, what


def _kind(sign: int, tag: str) -> tuple[str, int | None]:
    """What the text after a tag is: an opened heading or item, and else a paragraph."""
    if sign > 0 and tag in HEADING:
        return "heading", HEADING[tag]
    return ("list_item" if sign > 0 and tag in ITEM else "paragraph"), None


def html_blocks_of(html: str | None) -> list[tuple[str, int | None, str]]:
    """(type, level, text) of each stretch of text between two tags that break it."""
    page = _Events()
    page.feed(html or "")
    page.close()
    events = [e for e in _audible(page.seen) if not e[0] or e[1] in HEADING or e[1] in ITEM or e[1] in BREAKING]
    # Each stretch is known by the tag before it.
    edges = [k for k, (sign, _) in enumerate(events) if sign]
    stretches = zip([-1, *edges], [*edges, len(events)], strict=True)
    texts = ((_kind(*events[a]) if a >= 0 else ("paragraph", None), clean(" ".join(t for _, t in events[a + 1 : b] if t.strip()))) for a, b in stretches)
    return [(kind, level, text) for (kind, level), text in texts if text]


class _Tables(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.cells: list[tuple[int, int, int, int, int, str]] = []
        self.table, self.row, self.taken = -1, -1, set()
        self.open: list | None = None

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag == "table":
            self.table, self.row, self.taken = self.table + 1, -1, set()
        elif tag == "tr" and self.table >= 0:
            self.row += 1
        elif tag in ("td", "th") and self.row >= 0:
            self.finish()
            span = {k: int(v) for k, v in attrs if k in ("rowspan", "colspan") and v and v.isdigit() and int(v)}
            rows, cols = span.get("rowspan", 1), span.get("colspan", 1)
            c = 0
            while (self.row, c) in self.taken:
                c += 1
            self.taken |= {(self.row + i, c + j) for i in range(rows) for j in range(cols)}
            self.open = [self.table, self.row, c, rows, cols, []]

    def finish(self) -> None:
        if self.open:
            *place, words = self.open
            self.cells.append((*place, clean(" ".join(words))))
        self.open = None

    def handle_endtag(self, tag: str) -> None:
        if tag in ("td", "th", "tr", "table"):
            self.finish()

    def handle_data(self, data: str) -> None:
        if self.open and data.strip():
            self.open[-1].append(data)


def tables_of(html: str | None) -> list[tuple]:
    page = _Tables()
    page.feed(html or "")
    page.finish()
    return page.cells


def _html(html: str | None) -> list[dict]:
    return [{"type": t, "level": n, "text": x} for t, n, x in html_blocks_of(html)]


def _tables(html: str | None) -> list[dict]:
    return [dict(zip(("table", "r", "c", "rowspan", "colspan", "text"), cell, strict=True)) for cell in tables_of(html)]


def normalised(text: Column) -> Column:
    return each_text(text, lambda t: None if t is None else clean(t), "string")


def html_blocks(pages: DataFrame, id_col: str, html_col: str) -> DataFrame:
    """(doc_id, reading_order, type, level, text) of each page; null or empty HTML gives no rows."""
    return pages.select(F.col(id_col).alias("doc_id"), F.posexplode(each_text(F.col(html_col), _html, BLOCK)).alias("reading_order", "b")).select("doc_id", "reading_order", "b.*")


def table_cells(pages: DataFrame, id_col: str, html_col: str) -> DataFrame:
    """One row per cell with its place in the grid; spans keep what they cover free."""
    return pages.select(F.col(id_col).alias("doc_id"), F.explode(each_text(F.col(html_col), _tables, TABLE)).alias("x")).select("doc_id", "x.*")


def table_grid(cells: DataFrame) -> DataFrame:
    """Each table as a Markdown grid: a cell's text stands at its origin, bars are escaped."""
    text = F.regexp_replace(F.regexp_replace("text", r"\|", r"\\|"), r"\n", " ")
    # A table goes to one task in the end; its rows go there at once.
    rows = cells.repartition("doc_id", "table").groupBy("doc_id", "table", "r").agg(F.collect_list(F.struct("c", text.alias("t"))).alias("row"), F.max(F.col("c") + F.col("colspan")).alias("n_cols"), F.max(F.col("r") + F.col("rowspan")).alias("n_rows"))
    tables = rows.groupBy("doc_id", "table").agg(F.max("n_rows").alias("n_rows"), F.max("n_cols").alias("n_cols"), F.sort_array(F.collect_list(F.struct("r", "row"))).alias("rows"))

    def line(row: Column) -> Column:
        held = F.map_from_entries(row)
        return F.concat(F.lit("| "), F.array_join(F.transform(F.sequence(F.lit(0), F.col("n_cols") - 1), lambda c: F.coalesce(F.try_element_at(held, c), F.lit(""))), " | "), F.lit(" |"))

    return tables.select("doc_id", "table", "n_rows", "n_cols", F.array_join(F.transform("rows", lambda x: line(x["row"])), "\n").alias("grid"))


#: Fixed order of English months.
MONTHS = "january february march april may june july august september october november december".split()


def iso_date(text: Column) -> Column:
    """'March 5, 1998' as '1998-03-05'; null for what is no date."""
    pattern = r"(?i)\b(" + "|".join(MONTHS) + r")\s+(\d{1,2}),?\s+(\d{4})\b"
    month = F.array_position(F.array(*[F.lit(m) for m in MONTHS]), F.lower(F.regexp_extract(text, pattern, 1))).cast("int")
    day, year = F.regexp_extract(text, pattern, 2), F.regexp_extract(text, pattern, 3)
    return F.when(month > 0, F.try_to_date(F.format_string("%s-%02d-%s", year, month, F.lpad(day, 2, "0")), "yyyy-MM-dd").cast("string"))
