"""Relations of whole documents against a plain reading, paragraph after paragraph."""

import random
import re
from dataclasses import replace

from pyspark.sql import functions as F

from corpusloom.operators import citing, relations, signals
from corpusloom.queries.reading import READING

HEADS = ("The act revokes these:", "It amends:", "Under which:", "Revokes and amends:")
BODIES = ("a. Act 1 of 1990;", "(b) Act 2 of 1991 and Rule 3 of 1992;", "ii) not revokes Act 4 of 1993", "See Act 5 of 1994.", "9) amends in part Act 6 of 1995.", "nothing", "c) revokes the two:", "It repeals Act 7 of 1996. d) Act 8 of 1997.")


def plain(doc, reading):
    """(relation, type, number, year) with mentions, partial, first chunk and how many took their cue from a list's head."""
    found, held = {}, None
    for seq, chapter, text in doc:
        if any((chapter or "").startswith(p) for p in reading.skip):
            held = None
            continue
        for par in re.split(r"\n\s*\n", text or ""):
            par = re.sub(r"\s+", " ", par).strip()
            if not par:
                continue
            item = re.match(reading.item, par) is not None
            for r in citing.relations_of(par, reading, held if item else None):
                key = (r["relation"], r["type"], r["number"], r["year"])
                n, part, first, inherited = found.get(key, (0, True, seq, 0))
                found[key] = (n + 1, part and r["partial"], first, inherited + r["inherited"])
            head = next((name for t in re.split(reading.sentence_end, par) for name, p in reading.cues.items() if re.search(p, t, re.I)), None)
            if head and par.endswith(":"):
                held = head
            elif not item:
                held = None
    return found


def test_items_take_the_cue_of_an_earlier_paragraph(spark):
    rng = random.Random(1)
    reading = replace(READING, skip=("ANNEX", "NOTE"))
    docs = {d: [(s, rng.choice((None, "I", "ANNEX A")) if rng.random() < 0.3 else "I", "\n \n".join(rng.choice(HEADS + BODIES) for _ in range(rng.randint(0, 4))) or None) for s in range(rng.randint(1, 8))] for d in range(120)}
    rows = [(d, s, c, t, "x") for d, doc in docs.items() for s, c, t in doc]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, seq int, chapter string, text string, place string").repartition(4)
    got = {(r.doc_id, r.relation, r.type, r.number, r.year): (r.mentions, r.partial, r.seq, r.inherited) for r in citing.relations(df, reading, "doc_id", "seq", "text", chapter_col="chapter").collect()}
    want = {(d, *k): v for d, doc in docs.items() for k, v in plain(doc, reading).items()}
    assert got == want and sum(v[3] for v in want.values()) > 100


def test_own_citations_are_left_out_and_quotes_are_whole(spark):
    long = "It amends " + "very " * 100 + "much Act 1 of 1990 and Act 2 of 1991."
    df = spark.createDataFrame([("a", 1, long), ("b", 1, "It amends Act 1 of 1990.")], "doc_id string, seq int, text string")
    own = spark.createDataFrame([("a", "Act", "2", 1991), ("b", "act", "1", 1991)], "doc_id string, type string, number string, year int")
    got = {(r.doc_id, r.number): r.quote for r in citing.relations(df, READING, "doc_id", "seq", "text", own=own).collect()}
    assert set(got) == {("a", "1"), ("b", "1")} and got["a", "1"] == long


def test_regions_hold_in_the_preamble_alone(spark):
    reading = replace(READING, regions={"based_on": (r"\bhaving regard to\b", r"\bdecides\b")}, preamble=("Preamble", 200))
    rows = [(1, 1, "Preamble", "Having regard to\n\n1. Act 1 of 1990;\n\n2. Act 2 of 1991. It decides: amends Act 3 of 1992."), (1, 2, "2", "Having regard to Act 4 of 1993."), (2, 1, "Preamble", "Having regard to Act 1 of 1990." + " word" * 60), (3, 1, None, "Having regard to Act 1 of 1990.")]
    df = spark.createDataFrame(rows, "doc_id long, seq int, article string, text string")
    got = {(r.doc_id, r.number): r.relation for r in citing.relations(df, reading, "doc_id", "seq", "text", article_col="article").collect()}
    assert got == {(1, "1"): "based_on", (1, "2"): "based_on", (1, "3"): "amends", (1, "4"): "references", (2, "1"): "references", (3, "1"): "references"}


def test_status_is_found_once_for_all_copies(spark):
    """200 copies revoked by 300 others: one row with its list, not 60,000 rows on the way."""
    ids = spark.range(500).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 200, "ACT").otherwise("ORDER").alias("type"), F.lit("").alias("body"), F.lit("1").alias("number"), F.when(F.col("id") < 200, 2000).otherwise(F.col("id").cast("int")).alias("year"))
    edges = spark.range(200, 500).select(F.concat(F.lit("e"), "id").alias("edge_id"), F.col("id").alias("source"), F.lit("revokes").alias("relation"), F.lit("ACT").alias("target_type"), F.lit(None).cast("string").alias("target_body"), F.lit("1").alias("target_number"), F.lit(2000).alias("target_year"), F.lit("q").alias("quote"), F.lit(False).alias("partial"))
    resolved = relations.resolve(edges.unionByName(edges.limit(1).withColumns({"edge_id": F.lit("own"), "source": F.lit(5).cast("long")})), ids)
    assert {(r.target, r.resolution) for r in resolved.collect()} == {(0, "resolved")}
    found = relations.instrument_status(resolved, ids).collect()
    assert [(r.type, r.year, r.status, r.revoked_by, r.amended_by) for r in found] == [("ACT", 2000, "revoked", list(range(200, 500)), [])]
    got = {r.doc_id: (r.status, len(r.revoked_by)) for r in relations.derive_status(resolved, ids).collect()}
    assert got == {i: ("revoked", 300) if i < 200 else ("none_known", 0) for i in range(500)}


def test_scopes_are_looked_through_beside_a_row(spark):
    rows = spark.createDataFrame([(1, 1, [0, 4, 2]), (1, 2, [1, 1]), (1, 3, []), (1, 1, [0, 4, 2]), (2, 4, [7]), (3, 5, [1])], "doc_id int, row_id int, path array<int>")
    scopes = spark.createDataFrame([(1, 9, [0]), (1, 8, [0, 4]), (1, 6, [0, 4]), (1, 3, [2]), (2, 5, []), (2, 4, [8])], "doc_id int, scope int, scope_path array<int>")
    got = signals.nearest_scope(rows, scopes)
    assert {(r.doc_id, r.row_id, r.scope) for r in got.collect()} == {(1, 1, 6), (1, 2, 3), (1, 3, 3), (2, 4, 5)} and got.count() == 4
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join") < plan.index("Aggregate")  # rows are not multiplied by scopes and grouped again


def test_numbers_of_relations_are_added_up_without_sorting(spark):
    from corpusloom.operators import citing
    from corpusloom.queries.reading import READING

    chunks = spark.createDataFrame([(1, 7, "none here"), (1, 9, "See act 3 of 1999.\n\nSee act 3 of 1999."), (1, 8, "first\n\nSee act 3 of 1999.")], "d long, s int, t string")
    got = citing.relations(chunks, READING, "d", "s", "t").drop("quote")
    assert "SortAggregate" not in got._jdf.queryExecution().executedPlan().toString()
    assert [(r.seq, r.mentions) for r in got.collect()] == [(8, 3)]
