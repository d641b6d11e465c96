"""Word lists and measures of chunks: common words are looked up where rows lie, others by sorting."""

from corpusloom.operators import lexicon


def measured(spark, rows, words, **settings):
    chunks = spark.createDataFrame(rows, "doc string, chunk int, text string")
    listed = spark.createDataFrame(words, "word string, documents long")
    return lexicon.chunk_measures(chunks, listed, doc_col="doc", chunk_col="chunk", text_col="text", **settings)


WORDS = [("alpha", 9), ("beta", 5), ("gamma", 3)]
ROWS = [("a", 0, "Alpha beta delta"), ("a", 1, ""), ("a", 2, None), ("b", 0, "gamma epsilon epsilon ABC of\n| beta |"), ("c", 0, "alpha"), ("c", 0, "delta delta")]


def test_measures_whatever_is_common(spark):
    want = sorted([("a", 0, 3, 1, 16), ("a", 1, 0, 0, 0), ("b", 0, 3, 2, 37), ("c", 0, 3, 2, 5), ("c", 0, 3, 2, 11)])
    for common in (0, 1, 2, 100):
        got = measured(spark, ROWS, WORDS, common=common).where("chars IS NOT NULL").collect()
        assert sorted((r.doc, r.chunk, r.judged, r.unknown, r.chars) for r in got) == want, common
    (blank,) = measured(spark, ROWS, WORDS).where("chars IS NULL").collect()
    assert (blank.doc, blank.judged, blank.unknown) == ("a", 0, 0)


def test_words_that_are_common_are_not_dealt_out(spark):
    plan = measured(spark, ROWS, WORDS)._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin [word" in plan and "LeftAnti" in plan


def test_rows_of_an_id_are_one_document(spark):
    rows = [("a", "one two"), ("a", "one two"), ("b", "one two"), ("c", "one"), (None, "two"), (None, "two")]
    docs = spark.createDataFrame(rows, "id string, text string")
    # Pairs of one id count once; an id that is null counts in the first pass alone, as in SQL.
    got = {r.word: r.documents for r in lexicon.build(docs, "id", "text", min_documents=2).collect()}
    assert got == {"one": 3, "two": 2}
