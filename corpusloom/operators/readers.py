"""Readers by type of text and chunkers by name."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.operators import blocks, chunking, extract, markup_chunks, unit_chunks, xml

COLUMNS = ("doc_id", "reading_order", "type", "level", "text")


def read(docs: DataFrame, id_col: str, mime_col: str, text_col: str, *, dialect: xml.Dialect | None = None) -> DataFrame:
    """doc_id, reading_order, type, level and text of documents of several types, each by the reader of its type.

    Types: text/plain, text/markdown, text/html, and with a dialect application/xml and text/xml. A
    document of another type, and one that gives no block, has one block of type error with the reason.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.lower(mime_col).alias("mime"), F.col(text_col).alias("text"))
    of = lambda *mimes: rows.where(F.col("mime").isin(*mimes))
    parts = [
        blocks.plain(of("text/plain"), "doc_id", "text").withColumn("level", F.lit(None).cast("int")),
        blocks.markdown(of("text/markdown"), "doc_id", "text"),
        extract.html_blocks(of("text/html"), "doc_id", "text"),
    ]
    known = ["text/plain", "text/markdown", "text/html"]
    if dialect is not None:
        parts.append(xml.blocks(of("application/xml", "text/xml"), dialect, "doc_id", "text"))
        known += ["application/xml", "text/xml"]
    made = reduce(DataFrame.unionByName, [p.select(*COLUMNS) for p in parts])
    silent = rows.join(made.select("doc_id").distinct(), "doc_id", "left_anti")
    why = F.when(F.coalesce(F.col("mime").isin(*known), F.lit(False)), "no text").otherwise(F.concat(F.lit("no reader of "), F.coalesce("mime", F.lit("an unknown type"))))
    errors = silent.select("doc_id", F.lit(0).alias("reading_order"), F.lit("error").alias("type"), F.lit(None).cast("int").alias("level"), why.alias("text"))
    return made.unionByName(errors)


#: Chunkers by name and version; a result names the one it comes from.
CHUNKERS: dict[str, Callable[..., DataFrame]] = {
    "token@1": lambda rows, max_tokens=400: chunking.by_tokens(rows, max_tokens),
    "heading@1": lambda rows, max_tokens=400, max_level=9: chunking.by_heading(rows, max_tokens, max_level),
    "unit@1": lambda rows, **settings: unit_chunks.chunks(rows, unit_chunks.Chunking(**settings)),
    "markup@1": lambda rows, max_tokens=512, **naming: markup_chunks.chunks(rows, markup_chunks.Naming(**naming), max_tokens=max_tokens),
}


def chunk(rows: DataFrame, name: str, settings: Mapping[str, Any] | None = None) -> DataFrame:
    """Chunks by the chunker of this name, with the column chunker; a name without a version is its newest."""
    newest = max((n for n in CHUNKERS if n.partition("@")[0] == name), key=lambda n: int(n.partition("@")[2]), default=name)
    if newest not in CHUNKERS:
        raise LookupError(f"no chunker {name!r}; there are {', '.join(sorted(CHUNKERS))}")
    return CHUNKERS[newest](rows, **(settings or {})).withColumn("chunker", F.lit(newest))


def agreement(rows: DataFrame, key: list[str], said: str, stated: str) -> DataFrame:
    """By key: rows whose two readings of one fact agree, differ, or are there on one side or none, and the share that agree of those with both."""
    a, b = F.nullif(F.trim(said), F.lit("")), F.nullif(F.trim(stated), F.lit(""))
    both = a.isNotNull() & b.isNotNull()
    same = both & (F.lower(a) == F.lower(b))
    counts = {"agree": same, "differ": both & ~same, "only_said": a.isNotNull() & b.isNull(), "only_stated": a.isNull() & b.isNotNull(), "neither": a.isNull() & b.isNull()}
    out = rows.groupBy(*key).agg(*[F.count_if(c).alias(n) for n, c in counts.items()])
    return out.withColumn("share", F.round(F.col("agree") / F.nullif(F.col("agree") + F.col("differ"), F.lit(0)), 6))
