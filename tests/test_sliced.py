"""Texts of a batch are read in slices, in order and without loss."""

import pyarrow as pa
from pyspark.sql import functions as F

from corpusloom.functions.sliced import each_text, slices
from corpusloom.operators import extract, records


def test_slices_hold_bounded_texts():
    texts = pa.array(["x" * 300, None, "", "y" * 5000, "z" * 10, *["w" * 90] * 50])
    cut = list(slices(texts, 1000))
    assert [t for part in cut for t in part.to_pylist()] == texts.to_pylist() and len(cut) > 3
    assert all(len(part) == 1 or sum(len(t or "") for t in part.to_pylist()) <= 1000 for part in cut)
    assert list(slices(texts.slice(0, 0), 10)) == []


def test_no_more_texts_than_a_slice_are_python_objects(spark):
    live = spark.range(64).coalesce(1).select("id", F.repeat(F.lit("ab"), 100_000).alias("text"))

    def held(t):
        import gc
        import sys

        # Texts of one slice stand in one list.
        return max((len(x) for x in gc.get_objects() if isinstance(x, list) and x and all(isinstance(y, str) and sys.getsizeof(y) > 100_000 for y in x)), default=0)

    assert live.select(each_text(F.col("text"), held, "int").alias("n")).agg(F.max("n")).first()[0] <= 6


def test_same_by_any_slice(spark):
    rows = [(1, "<h1>A</h1><p>b&amp;c"), (2, None), (3, ""), (4, "<p>" + "d " * 1_200_000)]
    got = extract.html_blocks(spark.createDataFrame(rows, "id long, html string"), "id", "html").collect()
    assert [(r.doc_id, r.reading_order, r.type, r.level, len(r.text)) for r in sorted(got, key=lambda r: (r.doc_id, r.reading_order))] == [(1, 0, "heading", 1, 1), (1, 1, "paragraph", None, 3), (4, 0, "paragraph", None, 2_399_999)]
    texts = spark.createDataFrame([(1, "é\x07"), (2, None), (3, "")], "id long, t string")
    assert [r[0] for r in texts.orderBy("id").select(records.repaired(F.col("t"))).collect()] == ["\xe9", None, ""]
