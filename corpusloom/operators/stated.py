"""What markup and labels state: declared headings, labels, regions of relations, context and seed questions."""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Fixed kinds of question by shape.
QUESTION_TYPES = {
    "conceptual": "conceptual",
    "authority": "factual",
    "numeric": "factual",
    "sanction": "factual",
    "exception": "factual",
    "obligation": "factual",
    "procedural": "factual",
    "underspecified": "factual",
    "hard_negative": "factual",
    "exact_ref": "exact_citation",
    "multi_tier": "cross_reference",
    "out_of_domain": "negative",
}
#: Fixed grade of a clause that answers a question.
ANSWERS = 3


def _lookup(pairs: Mapping[str, object]) -> Column:
    return F.create_map(*[F.lit(x) for pair in pairs.items() for x in pair])


def declared_headings(blocks: DataFrame, units: Mapping[str, int]) -> DataFrame:
    """(doc_id, headings, undeclared, mismatched): headings of a unit that is not declared, or not at its level. None is altered."""
    level = F.try_element_at(_lookup(units), F.coalesce("unit", F.lit("")))
    rows = blocks.where("type = 'heading'").select("doc_id", level.alias("declared"), "level")
    wrong = F.col("declared").isNotNull() & ~F.col("declared").eqNullSafe(F.col("level"))
    return rows.groupBy("doc_id").agg(F.count("*").alias("headings"), F.count_if(F.col("declared").isNull()).alias("undeclared"), F.count_if(wrong).alias("mismatched"))


def extractor_for(mime: Column, supported: Sequence[tuple[str, Sequence[str]]]) -> Column:
    """The first extractor, in the order given, that supports a type; null without one."""
    return F.coalesce(*[F.when(mime.isin(*types), name) for name, types in supported], F.lit(None).cast("string"))


def merged_labels(blocks: DataFrame, label: str) -> DataFrame:
    """Paragraphs that are only a label ('Authority:') joined with the paragraph after them.

    A label before anything but a paragraph, before another label, or at a document's end stays by itself.
    """
    order = Window.partitionBy("doc_id").orderBy("reading_order")
    only = F.coalesce((F.col("type") == "paragraph") & F.col("text").rlike(label), F.lit(False))
    rows = blocks.withColumn("_label", only)
    joins = lambda mine, kind, other: mine & F.coalesce((kind == "paragraph") & ~other, F.lit(False))
    # A paragraph takes the label before it; that label's own block is gone.
    rows = rows.withColumns({"_gone": joins(F.col("_label"), F.lead("type").over(order), F.lead("_label").over(order)), "_before": F.lag("text").over(order), "_labelled": F.lag("_label").over(order)})
    takes = joins(F.coalesce("_labelled", F.lit(False)), F.col("type"), F.col("_label"))
    text = F.when(takes, F.concat(F.trim("_before"), F.lit(" "), F.coalesce("text", F.lit("")))).otherwise(F.col("text"))
    return rows.withColumn("text", text).where(~F.col("_gone")).drop("_label", "_gone", "_before", "_labelled")


def context_groups(fields: Mapping[str, Column], patterns: Mapping[str, str]) -> Column:
    """A map ctx_name: value of the named groups that hold something; a field without a match adds none."""
    found = []
    for name, pattern in patterns.items():
        groups = re.compile(pattern).groupindex
        java = re.sub(r"\(\?P<[A-Za-z_]\w*>", "(", pattern)
        found += [F.struct(F.lit(f"ctx_{g}").alias("key"), F.regexp_extract(fields[name].cast("string"), java, at).alias("value")) for g, at in groups.items()]
    return F.map_from_entries(F.filter(F.array(*found), lambda x: F.length(x["value"]) > 0))


def seed_queries(cases: DataFrame, abbreviations: Mapping[str, str]) -> DataFrame:
    """(qid, query, type, relevant, notes) of questions that were labelled in another form; an unknown shape or type of instrument is refused.

    cases: id, question, shape, difficulty, source, articles (regulation_type, regulation_number, year, article),
    expect_empty. What the form has no field for goes into the notes.
    """
    kind = F.try_element_at(_lookup(QUESTION_TYPES), F.coalesce("shape", F.lit("")))
    known = F.coalesce(kind, F.raise_error(F.concat(F.lit("a shape that is not known: "), F.coalesce("shape", F.lit("none")))).cast("string"))

    def judged(a: Column) -> Column:
        named = F.upper(F.trim(a["regulation_type"]))
        short = F.coalesce(F.try_element_at(_lookup(abbreviations), named), F.raise_error(F.concat(F.lit("no short form of "), named)).cast("string"))
        doc = F.concat(short, F.lit(" "), a["regulation_number"].cast("string"), F.lit("/"), a["year"].cast("string"))
        return F.struct(doc.alias("doc"), F.coalesce(a["article"].cast("string"), F.lit("")).alias("locator"), F.lit(ANSWERS).alias("grade"))

    none = F.array().cast("array<struct<doc:string,locator:string,grade:int>>")
    relevant = F.when(F.col("type") == "negative", none).otherwise(F.coalesce(F.transform("articles", judged), none))
    said = F.concat_ws(" · ", F.concat(F.lit("shape="), "shape"), F.concat(F.lit("difficulty="), F.coalesce("difficulty", F.lit("?"))), F.concat(F.lit("read="), "source"), F.when(F.col("expect_empty"), "expect_empty: the correct result is no result"))
    return cases.withColumn("type", known).select(F.col("id").alias("qid"), F.col("question").alias("query"), "type", relevant.alias("relevant"), said.alias("notes"))


def sampling_note(chunks: DataFrame, scored: Column) -> DataFrame:
    """One row: chunks, those scored, whether that is a sample, and its share."""
    n = chunks.agg(F.count("*").alias("chunks"), F.count_if(scored).alias("scored"))
    return n.select("chunks", "scored", (F.col("scored") < F.col("chunks")).alias("sampled"), F.when(F.col("chunks") > 0, F.round(F.col("scored") / F.col("chunks"), 6)).otherwise(0.0).alias("share"))


def hit(same_document: Column, coverage: Column, *, strict: bool = False) -> Column:
    """Whether a chunk answers a judgement; if strict, a chunk that is narrower than the label does not."""
    return F.coalesce(same_document & ~coverage.isin("none", *(["within"] if strict else [])), F.lit(False))


def region_marks(paragraphs: DataFrame, regions: Mapping[str, tuple[str, str]]) -> DataFrame:
    """(doc_id, seq, at, relation, opens): where a paragraph opens a region, and where one closes after that."""
    read = {name: (re.compile(begin, re.I), re.compile(end, re.I)) for name, (begin, end) in regions.items()}

    def marks(text: str | None) -> Iterator[tuple[int, str, bool]]:
        for name, (begin, end) in read.items():
            start = begin.search(text or "")
            if start:
                yield start.start(), name, True
            stop = end.search(text or "", start.end() if start else 0)
            if stop:
                yield stop.start(), name, False

    def find(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows = [(d, s, *m) for d, s, t in zip(part.doc_id, part.seq, part.text, strict=True) for m in marks(t)]
            yield pd.DataFrame(rows, columns=["doc_id", "seq", "at", "relation", "opens"])

    return paragraphs.select("doc_id", "seq", "text").mapInPandas(find, f"doc_id {dict(paragraphs.dtypes)['doc_id']}, seq long, at int, relation string, opens boolean")


def in_regions(citations: DataFrame, marks: DataFrame, regions: Sequence[str]) -> DataFrame:
    """Add region: the first of `regions` that is open where a citation starts, over paragraphs of its document; else null.

    citations: doc_id, seq, start. A region holds from its own opening on, and no longer where it is closed.
    """
    kept = citations.withColumns({"_at": F.col("start"), "_cited": F.lit(True)})
    events = marks.select("doc_id", "seq", F.col("at").alias("_at"), F.lit(False).alias("_cited"), F.col("relation").alias("_relation"), F.col("opens").alias("_opens"))
    # At one place a region closes after it opens, and citations come last.
    order = Window.partitionBy("doc_id").orderBy("seq", "_at", "_cited", F.desc("_opens")).rowsBetween(Window.unboundedPreceding, 0)
    state = {f"_in_{i}": F.last(F.when(F.col("_relation") == name, F.col("_opens")), ignorenulls=True).over(order) for i, name in enumerate(regions)}
    rows = kept.unionByName(events, allowMissingColumns=True).withColumns(state).where("_cited")
    region = F.coalesce(*[F.when(F.col(f"_in_{i}"), name) for i, name in enumerate(regions)], F.lit(None).cast("string"))
    return rows.withColumn("region", region).select(*citations.columns, "region")
