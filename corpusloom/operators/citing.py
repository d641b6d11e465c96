"""Citations and relations read from text: spans by pattern, the cue that governs each, and merging."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.operators.stated import in_regions, region_marks

SPAN = "array<struct<kind:string,start:int,end:int,text:string,type:string,number:string,year:int>>"


@dataclass(frozen=True)
class Reading:
    """Patterns of one kind of text: citations with groups type, number, year; inner pointers; cues by relation.

    `demote`, in the `reach` characters before a citation, makes it a plain reference. After `title` the words
    that follow a citation are its title, and a cue among them says nothing of the next citation. `regions`
    gives the patterns that open and close a part of a document in which one relation holds. `item` begins an
    item of a list, which takes the cue of the paragraph that opened the list. Chapters that begin with one of
    `skip` are not read and end a list. `preamble`: regions hold only in chunks of this article of at most so
    many characters.
    """

    citation: str
    pointer: str
    cues: dict[str, str]
    sentence_end: str = r"(?<=[.;])(?<!\b[Nn]o\.)\s+"
    negation: str = r"\bnot\b"
    partial: str = r"\b(?:in part|article)\b"
    window: int = 120
    demote: str | None = None
    reach: int = 160
    title: str | None = None
    regions: dict[str, tuple[str, str]] = field(default_factory=dict)
    item: str = r"^\s*\(?(?:[a-z]|\d{1,3}|[ivxlc]+)[.)]\s"
    skip: tuple[str, ...] = ()
    preamble: tuple[str, int] | None = None


def spans_of(text: str | None, reading: Reading) -> list[dict]:
    """Citations and pointers in order, without those that an earlier or longer one holds."""
    text, out = text or "", []
    for m in re.finditer(reading.citation, text, re.I):
        g = m.groupdict()
        out.append({"kind": "regulation", "start": m.start(), "end": m.end(), "text": m.group().strip(), "type": g["type"].upper(), "number": g["number"], "year": int(g["year"])})
    out += [{"kind": "internal", "start": m.start(), "end": m.end(), "text": m.group().strip(), "type": None, "number": None, "year": None} for m in re.finditer(reading.pointer, text, re.I)]
    kept, reach = [], -1
    for s in sorted(out, key=lambda s: (s["start"], -s["end"], s["kind"])):
        if s["end"] > reach:
            kept.append(s)
            reach = s["end"]
    return kept


def sentences_of(text: str, end: str) -> Iterator[tuple[int, str]]:
    """Sentences and where they start."""
    at = 0
    for gap in re.finditer(end, text):
        yield at, text[at : gap.start()]
        at = gap.end()
    yield at, text[at:]


def relations_of(text: str | None, reading: Reading, inherited: str | None = None) -> list[dict]:
    """Each citation with the relation of its nearest cue before it in the statement, or 'references'.

    A negated cue does not act. A list item without a cue takes the one of the statement that opened the list
    in its paragraph, or else `inherited`, the one of the paragraph that did.
    """
    out, carried = [], inherited
    if not text or not re.search(reading.citation, text, re.I):
        return out
    for offset, sentence in sentences_of(text, reading.sentence_end):
        item = re.match(r"\s*(?:[a-z]|\d+)[.)]\s", sentence)
        cues = sorted((m.start(), m.end(), name) for name, p in reading.cues.items() for m in re.finditer(p, sentence, re.I))
        acting = [c for c in cues if not re.search(reading.negation, sentence[max(0, c[0] - 12) : c[0]], re.I)]
        if not item and not inherited:
            carried = acting[-1][2] if acting and sentence.rstrip().endswith(":") else None
        named = 0
        for m in re.finditer(reading.citation, sentence, re.I):
            near = [c for c in acting if 0 <= m.start() - c[1] <= reading.window]
            relation = near[-1][2] if near else carried if (item or inherited) and carried else "references"
            g = m.groupdict()
            entitled = bool(reading.title and named and near and re.search(reading.title, sentence[named : near[-1][0]], re.I))
            lowered = bool(reading.demote and re.search(reading.demote, sentence[max(0, m.start() - reading.reach) : m.start()], re.I))
            relation, named = "references" if entitled else relation, m.end()
            before = sentence[near[-1][1] if near else 0 : m.start()]
            out.append({"relation": relation, "type": g["type"].upper(), "number": g["number"], "year": int(g["year"]), "partial": re.search(reading.partial, before, re.I) is not None, "quote": sentence.strip(), "start": offset + m.start(), "lowered": lowered, "inherited": bool(inherited and not near and relation == inherited)})
    return out


def paragraphs(chunks: DataFrame, reading: Reading, id_col: str, seq_col: str, text_col: str, *, chapter_col: str | None = None, article_col: str | None = None) -> DataFrame:
    """doc_id, seq (chunk), place (order in the document), text, preamble and inherited of every paragraph that is read.

    A paragraph ends at a blank line; white space in it is made even. inherited: the cue of the last
    paragraph that opened a list (a cue in it, a colon at its end), for the items that follow it in the
    document, in whatever chunk; any other paragraph ends the list, and so does a chapter that is skipped.
    """
    chapter = F.coalesce(F.col(chapter_col).cast("string"), F.lit("")) if chapter_col else F.lit("")
    skipped = F.lit(False)
    for prefix in reading.skip:
        skipped = skipped | chapter.startswith(prefix)
    preamble = F.lit(True)
    if reading.preamble:
        article = F.col(article_col) if article_col else F.lit(None)
        preamble = F.coalesce((article == reading.preamble[0]) & (F.length(text_col) <= reading.preamble[1]), F.lit(False))
    pieces = F.posexplode(F.split(F.coalesce(F.col(text_col), F.lit("")), r"\n\s*\n")).alias("_n", "_text")
    rows = chunks.select(F.col(id_col).alias("doc_id"), F.col(seq_col).cast("long").alias("seq"), skipped.alias("_skipped"), preamble.alias("preamble"), pieces)
    rows = rows.withColumn("text", F.trim(F.regexp_replace("_text", r"\s+", " "))).where("text <> '' OR _skipped")
    said = F.transform(F.split("text", reading.sentence_end), lambda t: F.coalesce(*[F.when(t.rlike("(?i)" + p), name) for name, p in reading.cues.items()]))
    cue = F.get(F.filter(said, lambda c: c.isNotNull()), 0)
    item = F.col("text").rlike(reading.item)
    # What a paragraph leaves to those after it: a cue, nothing ('') or what was there before (null).
    leaves = F.when(F.col("_skipped"), "").when(F.col("text").endswith(":") & cue.isNotNull(), cue).when(~item, "")
    before = Window.partitionBy("doc_id").orderBy("seq", "_n").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_leaves", leaves).withColumn("_held", F.last("_leaves", ignorenulls=True).over(before))
    inherited = F.when(item & (F.col("_held") != ""), F.col("_held"))
    # A chunk has fewer than two to the twentieth paragraphs, or its order would run into the next one's.
    place = F.shiftleft("seq", 20) + F.col("_n")
    return rows.where("NOT _skipped").select("doc_id", "seq", place.alias("place"), "text", "preamble", inherited.alias("inherited"))


def references(chunks: DataFrame, reading: Reading, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, kind, start, end, text, type, number, year) of every reference."""

    def read(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows = [(d, *s.values()) for d, t in zip(part.doc_id, part.text, strict=True) for s in spans_of(t, reading)]
            out = pd.DataFrame(rows, columns=["doc_id", "kind", "start", "end", "text", "type", "number", "year"])
            out["year"] = out["year"].astype("Int32")
            yield out

    return chunks.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInPandas(read, "doc_id long, kind string, start int, end int, text string, type string, number string, year int")


def relations(chunks: DataFrame, reading: Reading, id_col: str, seq_col: str, text_col: str, *, chapter_col: str | None = None, article_col: str | None = None, own: DataFrame | None = None) -> DataFrame:
    """Relations of each document, equal ones merged: mentions add up, partial only if all are; quote and seq are those of the first.

    In a region its relation holds, whatever cues are near; what is demoted is a reference there as well.
    own: doc_id, type, number and year of documents, whose citations of themselves are left out. quote is
    the whole statement. Null texts have no relations.
    """

    def read(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            given = zip(part.doc_id, part.seq, part.place, part.preamble, part.text, part.inherited, strict=True)
            rows = [(d, s, at, p, *r.values()) for d, s, at, p, t, cue in given for r in relations_of(t, reading, cue)]
            yield pd.DataFrame(rows, columns=["doc_id", "chunk", "seq", "preamble", "relation", "type", "number", "year", "partial", "quote", "start", "lowered", "inherited"])

    texts = paragraphs(chunks, reading, id_col, seq_col, text_col, chapter_col=chapter_col, article_col=article_col)
    rows = texts.mapInPandas(read, f"doc_id {dict(texts.dtypes)['doc_id']}, chunk long, seq long, preamble boolean, relation string, type string, number string, year int, partial boolean, quote string, start int, lowered boolean, inherited boolean")
    if own is not None:
        rows = rows.join(own.select("doc_id", F.upper("type").alias("type"), F.col("number").cast("string").alias("number"), F.col("year").cast("int").alias("year")).distinct(), ["doc_id", "type", "number", "year"], "left_anti")
    if reading.regions:
        marks = region_marks(texts.where("preamble").select("doc_id", F.col("place").alias("seq"), "text"), reading.regions)
        rows = in_regions(rows, marks, list(reading.regions)).withColumn("relation", F.coalesce(F.when(F.col("preamble"), F.col("region")), F.col("relation")))
    rows = rows.withColumn("relation", F.when(F.col("lowered"), "references").otherwise(F.col("relation")))
    # A place begins with its chunk, and numbers alone are added up without sorting where quotes are not asked for.
    first = F.struct("seq", "start")
    return rows.groupBy("doc_id", "relation", "type", "number", "year").agg(F.count("*").alias("mentions"), F.bool_and("partial").alias("partial"), F.min_by("quote", first).alias("quote"), F.shiftright(F.min("seq"), 20).alias("seq"), F.sum(F.col("inherited").cast("long")).alias("inherited"))
