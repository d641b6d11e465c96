"""Units, listings and exports against plain Python."""

import pytest

from corpusloom.operators import mirror, units


def test_marker_chain_closes_its_kind():
    lines = ["3. x", "a. y", "b. z", "4. w", "a. v", "plain"]
    assert units.marker_chain(lines) == ["number 3", "number 3 letter a", "number 3 letter b", "number 4", "number 4 letter a", "number 4 letter a"]


def test_marker_chains_of_documents(spark):
    df = spark.createDataFrame([(1, 0, "1. x"), (1, 1, "a. y"), (2, 0, "b. z"), (2, 1, None)], "doc_id long, line int, text string")
    got = {(r.doc_id, r.line): r.chain for r in units.marker_chains(df).collect()}
    assert got == {(1, 0): "number 1", (1, 1): "number 1 letter a", (2, 0): "letter b", (2, 1): "letter b"}
    assert units.marker_chains(df.limit(0)).count() == 0


def test_segments_break_at_siblings_and_units(spark):
    rows = [(1, 0, "paragraph", None), (1, 1, "heading", 1), (1, 2, "heading", 3), (1, 3, "heading", 2), (1, 4, "paragraph", None), (1, 5, "heading", 1)]
    df = spark.createDataFrame(rows, "doc_id long, reading_order int, type string, level int")
    got = [r.segment for r in units.segments(df, (2,)).orderBy("reading_order").collect()]
    assert got == [0, 1, 1, 2, 2, 3]


def test_export_refuses_losses(spark):
    chunks = spark.createDataFrame([(1, "a"), (2, "b")], "id long, body string")
    signals = spark.createDataFrame([(1, "x")], "id long, seen string")
    with pytest.raises(ValueError, match="body"):
        mirror.export(chunks, chunks, "id")
    with pytest.raises(Exception, match="no signals"):
        mirror.export(chunks, signals, "id").collect()
    assert mirror.export(chunks.where("id = 1"), signals, "id").columns == ["id", "body", "seen"]
