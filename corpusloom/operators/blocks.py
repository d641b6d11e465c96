"""Documents as ordered blocks: parsing lines, heading paths, rendering, validation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.operators.graph import dealt

MAX_LEVEL = 9
#: Fixed forms of the block dialect.
AMBIGUOUS = r"^(?:\\|#{1,9}\s|-\s|\$\$|<!--)"
ANNOTATED = ("caption", "footnote", "page_header", "page_footer")


def squeezed(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, "[ \t ]+", " "))


def lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("doc_id"), F.posexplode(F.split(text_col, "\n")).alias("line", "text"))


def numbered(rows: DataFrame, order: str = "line") -> DataFrame:
    """Blocks numbered from 0 in the order of their lines."""
    return rows.withColumn("reading_order", F.row_number().over(Window.partitionBy("doc_id").orderBy(order)) - 1)


def plain(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One paragraph per line that is not empty."""
    rows = lines(docs, id_col, text_col).withColumn("text", squeezed(F.col("text"))).where("text <> ''")
    return numbered(rows).select("doc_id", "reading_order", F.lit("paragraph").alias("type"), "text")


def markdown(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Headings, list items and paragraphs line by line; a fence's lines are paragraphs.

    An underline of = or - makes the paragraph before it a heading; a bullet is dropped, a number kept.
    """
    by_line = Window.partitionBy("doc_id").orderBy("line")
    rows = lines(docs, id_col, text_col).withColumn("fence", F.ltrim("text").startswith("```"))
    rows = rows.withColumn("open", F.sum(F.col("fence").cast("int")).over(by_line) % 2 == 1).where(~F.col("fence"))
    rows = rows.withColumn("text", F.when(F.col("open"), F.rtrim("text")).otherwise(squeezed(F.col("text")))).where("text <> ''")
    under = ~F.col("open") & F.col("text").rlike(r"^(?:=+|-+)$") & (F.row_number().over(by_line) > 1)
    rows = rows.withColumn("under", under).withColumn("next", F.lead(F.when(F.col("under"), F.col("text"))).over(by_line)).where(~F.col("under"))
    hashes = F.regexp_extract("text", r"^(#{1,6})\s+(.*)$", 1)
    item = r"^(?:[-*+]|(\d+[.)]))\s+(.*)$"
    kind = F.when(F.col("open"), "paragraph").when(hashes != "", "heading").when(F.col("text").rlike(item), "list_item").when(F.col("next").isNotNull(), "heading").otherwise("paragraph")
    set_level = F.when(F.col("next").startswith("="), 1).otherwise(2)
    level = F.when(F.col("open"), None).when(hashes != "", F.length(hashes)).when(kind == "heading", set_level)
    body = F.when(F.col("open"), F.col("text")).when(hashes != "", F.regexp_extract("text", r"^(#{1,6})\s+(.*)$", 2)).when(kind == "list_item", F.ltrim(F.concat_ws(" ", F.regexp_extract("text", item, 1), F.regexp_extract("text", item, 2)))).otherwise(F.col("text"))
    return numbered(rows.withColumn("type", kind).withColumn("level", level).withColumn("text", body)).select("doc_id", "reading_order", "type", "level", "text")


def heading_paths(blocks: DataFrame) -> DataFrame:
    """Add heading_path: the headings in force, each closed by the next of its level or above.

    Of every level the last heading so far is kept where it stands later than all shallower ones.
    """
    upto = Window.partitionBy("doc_id").orderBy("reading_order").rowsBetween(Window.unboundedPreceding, 0)
    heads = [F.max(F.when((F.col("type") == "heading") & (F.col("level") == n), F.struct("reading_order", "text"))).over(upto) for n in range(1, MAX_LEVEL + 1)]
    out = blocks.withColumns({f"_h{n}": h for n, h in enumerate(heads, 1)})
    held = []
    for n in range(1, MAX_LEVEL + 1):
        mine = F.col(f"_h{n}")
        above = [F.coalesce(F.col(f"_h{m}.reading_order"), F.lit(-1)) < mine["reading_order"] for m in range(1, n)]
        fit = mine.isNotNull()
        for a in above:
            fit = fit & a
        held.append(F.when(fit, mine["text"]))
    return out.withColumn("heading_path", F.array_compact(F.array(*held))).drop(*[f"_h{n}" for n in range(1, MAX_LEVEL + 1)])


def promote(blocks: DataFrame, units: Sequence[tuple[str, str, int]]) -> DataFrame:
    """Lines that a unit's pattern fits become headings of its level; the first unit that fits counts."""
    unit, level = F.lit(None).cast("string"), F.lit(None).cast("int")
    for name, pattern, n in reversed(units):
        fit = F.col("text").rlike(pattern)
        unit, level = F.when(fit, name).otherwise(unit), F.when(fit, n).otherwise(level)
    out = blocks.withColumn("unit", unit)
    return out.withColumn("type", F.when(F.col("unit").isNotNull(), "heading").otherwise(F.col("type"))).withColumn("level", F.when(F.col("unit").isNotNull(), level))


def render(type_: Column, text: Column, level: Column, ref: Column) -> Column:
    """A block in the dialect; a paragraph that opens like another type is escaped."""
    mark = lambda kind, rest: F.concat(F.lit("<!-- block:"), kind, rest)
    return (
        F.when(type_ == "heading", F.concat(F.repeat(F.lit("#"), F.coalesce(level, F.lit(1))), F.lit(" "), text))
        .when(type_ == "paragraph", F.when(text.rlike(AMBIGUOUS), F.concat(F.lit("\\"), text)).otherwise(text))
        .when(type_ == "list_item", F.concat(F.lit("- "), text))
        .when(type_ == "formula", F.concat(F.lit("$$ "), text, F.lit(" $$")))
        .when(type_ == "table_ref", F.concat(F.lit("<!-- block:table "), ref, F.lit(" -->")))
        .when(type_ == "figure_ref", F.concat(F.lit("<!-- block:figure "), ref, F.lit(" -->")))
        .otherwise(mark(type_, F.concat(F.lit(" -->"), text)))
    )


def parse(raw: Column) -> dict[str, Column]:
    """type, text, level and ref of a rendered block; what nothing fits is a paragraph."""
    t = F.regexp_replace(raw, r"^\s+|\s+$", "")
    ref, note = r"^<!--\s*block:(table|figure)\s+(\S+)\s*-->$", r"(?s)^<!--\s*block:([a-z_]+)\s*-->\s*(.*)$"
    head, item, formula = r"(?s)^(#{1,9})\s+(.*)$", r"(?s)^-\s+(.*)$", r"(?s)^\$\$\s*(.*?)\s*\$\$$"
    escaped, kind = t.startswith("\\"), F.regexp_extract(t, note, 1)
    is_ref, is_note = t.rlike(ref), kind.isin(*ANNOTATED)
    type_ = F.when(escaped, "paragraph").when(is_ref, F.concat(F.regexp_extract(t, ref, 1), F.lit("_ref"))).when(is_note, kind).when(t.rlike(head), "heading").when(t.rlike(formula), "formula").when(t.rlike(item), "list_item").otherwise("paragraph")
    text = F.when(escaped, F.substring(t, F.lit(2), F.length(t))).when(is_ref, "").when(is_note, F.trim(F.regexp_extract(t, note, 2))).when(t.rlike(head), F.trim(F.regexp_extract(t, head, 2))).when(t.rlike(formula), F.trim(F.regexp_extract(t, formula, 1))).when(t.rlike(item), F.trim(F.regexp_extract(t, item, 1))).otherwise(t)
    level = F.when(~escaped & ~is_ref & ~is_note & t.rlike(head), F.length(F.regexp_extract(t, head, 1)))
    return {"type": type_, "text": text, "level": level, "ref": F.when(~escaped & is_ref, F.regexp_extract(t, ref, 2))}


def render_documents(blocks: DataFrame) -> DataFrame:
    """Each document's blocks in order, rendered and parted by blank lines."""
    rows = blocks.select("doc_id", "reading_order", render(F.col("type"), F.col("text"), F.col("level"), F.lit(None).cast("string")).alias("raw"))
    return rows.groupBy("doc_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("reading_order", "raw"))), lambda x: x["raw"]), "\n\n").alias("markdown"))


def parse_documents(rendered: DataFrame) -> DataFrame:
    """The blocks of rendered documents, numbered from 0."""
    parts = rendered.select("doc_id", F.posexplode(F.split("markdown", "\n\n")).alias("line", "raw")).where(F.regexp_replace("raw", r"\s", "") != "")
    return numbered(parts).select("doc_id", "reading_order", *[c.alias(n) for n, c in parse(F.col("raw")).items()])


def order_issues(blocks: DataFrame) -> DataFrame:
    """Documents whose reading order is not 0 to n-1 without gaps."""
    x = blocks.groupBy("doc_id").agg(F.count("*").alias("n"), F.min("reading_order").alias("low"), F.max("reading_order").alias("high"), F.countDistinct("reading_order").alias("kinds"))
    return x.where((F.col("low") != 0) | (F.col("high") != F.col("n") - 1) | (F.col("kinds") != F.col("n"))).select("doc_id", F.lit("reading_order").alias("rule"))


def round_trip_issues(blocks: DataFrame) -> DataFrame:
    """Blocks that do not come back as they were after rendering and parsing."""
    again = parse(render(F.col("type"), F.col("text"), F.col("level"), F.lit(None).cast("string")))
    same = again["type"].eqNullSafe(F.col("type")) & again["text"].eqNullSafe(F.trim("text")) & again["level"].eqNullSafe(F.col("level"))
    return blocks.where(~same).select("doc_id", "reading_order", F.lit("round_trip").alias("rule"))


def text_ratio(blocks: DataFrame, least: float = 0.30) -> DataFrame:
    """Share of text-bearing blocks with text, per document, and whether it is enough."""
    bearing = F.col("type").isin("heading", "paragraph", "list_item", *ANNOTATED)
    share = F.avg(F.when(bearing, (F.trim("text") != "").cast("double")))
    return blocks.groupBy("doc_id").agg(F.round(share, 6).alias("ratio"), F.coalesce(share >= least, F.lit(False)).alias("ok"))


def repeated_ids(rows: DataFrame, id_col: str) -> DataFrame:
    """(id, count) of ids that several rows have."""
    return dealt(rows, id_col).groupBy(id_col).count().where("count > 1")


def path_issues(blocks: DataFrame) -> DataFrame:
    """Blocks whose heading_path differs from the one that their levels give."""
    again = heading_paths(blocks.withColumnRenamed("heading_path", "declared"))
    return again.where(~F.col("declared").eqNullSafe(F.col("heading_path"))).select("doc_id", "reading_order", F.lit("heading_path").alias("rule"))
