"""Structural units: segments, labels in force, marker chains, orphan headings, typography of lines."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.operators.carry import carried


def segments(blocks: DataFrame, split_levels: tuple[int, ...]) -> DataFrame:
    """Add segment: it begins anew at a heading of a splitting level, or at or above the level that opened it.

    Other blocks take the segment of the heading before them; 0 before the first. A heading without
    a level opens a segment only where it is the first.
    """

    def step(state: tuple[int | None, int], row: tuple) -> tuple[tuple[int | None, int], int]:
        (opened, n), (heading, level) = state, row
        if heading and (opened is None or (level is not None and (level in split_levels or level <= opened))):
            return (level, n + 1), n + 1
        return state, n

    values = {"heading": F.coalesce(F.col("type") == "heading", F.lit(False)), "level": F.col("level")}
    return carried(blocks, ["doc_id"], ["reading_order"], values, (None, 0), step, "segment")


def labels_in_force(blocks: DataFrame) -> DataFrame:
    """Add region, chapter and article: the last heading of each level; a region ends the chapter before it.

    A chapter that none is in force for reads N/A.
    """
    upto = Window.partitionBy("doc_id").orderBy("reading_order")
    last = lambda n: F.last(F.when((F.col("type") == "heading") & (F.col("level") == n), F.struct("reading_order", "text")), ignorenulls=True).over(upto)
    out = blocks.withColumns({"_r": last(1), "_c": last(2), "_a": last(3)})
    region_at = F.coalesce(F.col("_r.reading_order"), F.lit(-1))
    chapter = F.when(F.col("_c.reading_order") > region_at, F.col("_c.text"))
    article = F.when(F.col("_a.reading_order") > region_at, F.col("_a.text"))
    return out.withColumn("region", F.col("_r.text")).withColumn("chapter", F.coalesce(chapter, F.lit("N/A"))).withColumn("article", article).drop("_r", "_c", "_a")


def path_segments(blocks: DataFrame) -> DataFrame:
    """Add segment: it changes where the materialised heading path does."""
    order = Window.partitionBy("doc_id").orderBy("reading_order")
    new = ~F.lag("heading_path").over(order).eqNullSafe(F.col("heading_path"))
    return blocks.withColumn("_n", F.coalesce(new.cast("int"), F.lit(1))).withColumn("segment", F.sum("_n").over(order)).drop("_n")


def orphan_headings(blocks: DataFrame) -> DataFrame:
    """Headings without a body of their own whose words no heading path over a body holds."""
    squash = lambda c: F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}]+", "")
    after = F.lead("type").over(Window.partitionBy("doc_id").orderBy("reading_order"))
    bare = blocks.withColumn("_after", after).where((F.col("type") == "heading") & ((F.col("_after") == "heading") | F.col("_after").isNull()))
    held = blocks.where("type <> 'heading'").select("doc_id", F.explode("heading_path").alias("h")).select("doc_id", squash(F.col("h")).alias("head")).distinct()
    return bare.withColumn("head", squash(F.col("text"))).join(held, ["doc_id", "head"], "left_anti").select("doc_id", "reading_order", "text")


_MARK = re.compile(r"^\(?(?:(?P<number>\d+)|(?P<letter>[a-z]))[.)]\s")


def marker_chain(texts: list[str]) -> list[str]:
    """The markers each line stands under: a marker closes the last of its kind and all opened since."""
    stack: list[tuple[str, str]] = []
    out = []
    for t in texts:
        if m := _MARK.match(t or ""):
            kind = m.lastgroup or ""
            at = next((i for i, (k, _) in enumerate(stack) if k == kind), len(stack))
            stack = [*stack[:at], (kind, m[kind])]
        out.append(" ".join(f"{k} {v}" for k, v in stack))
    return out


def marker_chains(lines: DataFrame) -> DataFrame:
    """(doc_id, line, chain) of lines (doc_id, line, text); one document's lines are held at a time."""

    def read(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        doc, held = None, []

        def done() -> list[tuple]:
            return [(doc, n, c) for (n, _), c in zip(held, marker_chain([t for _, t in held]), strict=True)]

        for part in parts:
            out: list[tuple] = []
            for new, n, t in zip(part.doc_id, part.line, part.text, strict=True):
                if held and new != doc:
                    out += done()
                    held = []
                doc = new
                held.append((n, t))
            yield pd.DataFrame(out, columns=["doc_id", "line", "chain"])
        yield pd.DataFrame(done() if held else [], columns=["doc_id", "line", "chain"])

    ordered = lines.select("doc_id", "line", "text").repartition("doc_id").sortWithinPartitions("doc_id", "line")
    return ordered.mapInPandas(read, "doc_id long, line int, chain string")


def line_roles(lines: DataFrame, *, ratio: float = 1.12, most_chars: int = 120, share: float = 0.5) -> DataFrame:
    """Lines (doc_id, page, line, text, size, bold, band) with role and level by typography.

    The body's size is a document's commonest, rounded to half a point. A text that stands in the
    same band on at least half of three or more pages is a running head or foot. Larger or short
    bold lines are headings; the larger the size, the higher the level.
    """
    size = F.bround(F.col("size") * 2, 0) / 2
    rows = lines.withColumn("size", size)
    common = rows.groupBy("doc_id", "size").agg(F.sum(F.length("text")).alias("n"))
    body = common.groupBy("doc_id").agg(F.max_by("size", F.struct("n", (-F.col("size")).alias("s"))).alias("body"))
    pages = rows.groupBy("doc_id").agg(F.countDistinct("page").alias("pages"))
    running = rows.where("band <> 'body'").groupBy("doc_id", "band", "text").agg(F.countDistinct("page").alias("on")).join(pages, "doc_id").where((F.col("pages") >= 3) & (F.col("on") >= F.col("pages") * share)).select("doc_id", "band", "text", F.lit(True).alias("runs"))
    all_ = rows.join(body, "doc_id").join(running, ["doc_id", "band", "text"], "left")
    large = (F.col("size") / F.col("body") > ratio) | (F.col("bold") & (F.length("text") <= most_chars))
    role = F.when(F.col("runs"), F.concat(F.lit("page_"), F.col("band"))).when(large, "heading").otherwise("paragraph")
    out = all_.withColumn("role", role)
    rank = F.dense_rank().over(Window.partitionBy("doc_id", "role").orderBy(F.desc("size")))
    return out.withColumn("level", F.when(F.col("role") == "heading", F.least(rank, F.lit(9)))).select("doc_id", "page", "line", "role", "level")


def centred(left: Column, right: Column, width: Column, tolerance: float = 0.08) -> Column:
    """Whether a line's centre lies near its page's."""
    return F.abs((left + right) / 2 - width / 2) <= width * tolerance
