"""Bundles, positions, stored BM25, fetch plans and packing over odd rows."""

import re

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from corpusloom.operators import bm25, embedding, evaluate, kmeans, ledger, stated, xml
from corpusloom.plans import specs
from corpusloom.sources import plans, tables


def test_seal_writes_the_manifest_last_and_once(spark, tmp_path):
    root = str(tmp_path / "bundle")
    chunks = spark.range(10).withColumnRenamed("id", "chunk_id")
    with pytest.raises(ValueError, match="10 rows and vectors has 9"):
        tables.seal(spark, root, {"chunks": chunks, "vectors": chunks.where("chunk_id > 0")}, {"k": 1}, equal=[("chunks", "vectors")])
    assert not (tmp_path / "bundle" / "manifest").exists()
    sealed = tables.seal(spark, root, {"chunks": chunks, "vectors": chunks}, {"k": 1}, equal=[("chunks", "vectors")], canary=chunks.where("chunk_id = 3"))
    assert sealed.counts == {"chunks": 10, "vectors": 10} and {"chunks", "vectors"} <= set(sealed.checksums)
    assert (tmp_path / "bundle" / "failed").is_dir() and tables.damaged(spark, root).count() == 0
    with pytest.raises(ValueError, match="sealed already"):
        tables.seal(spark, root, {"chunks": chunks}, {})
    part = next((tmp_path / "bundle" / "chunks").glob("*.parquet"))
    (part.parent / f".{part.name}.crc").unlink(missing_ok=True)
    part.write_bytes(part.read_bytes() + b"x")
    assert [r.problem for r in tables.damaged(spark, root).collect()] == ["altered"]


def test_sidecars_are_typed(spark, tmp_path):
    rows = spark.createDataFrame([(1, 2, 3, "x")], "source long, target long, weight long, more string")
    tables.write_sidecar(rows, "edges", str(tmp_path / "e"))
    assert [tuple(r) for r in tables.read_sidecar(spark, "edges", str(tmp_path / "e")).collect()] == [("1", "2", 3)]
    with pytest.raises(ValueError, match="edges lacks weight"):
        tables.typed(rows.drop("weight"), "edges")
    with pytest.raises(ValueError, match="no table is named"):
        tables.typed(rows, "others")


@pytest.mark.parametrize("values", [[], [5], [None, 3, 1, 2], list(range(500, 0, -1))])
def test_positions(spark, values):
    rows = spark.createDataFrame([(v,) for v in values], "o long")
    got = {r.o: r.position for r in tables.positions(rows, "o", parts=8).collect()}
    assert got == {v: i for i, v in enumerate(sorted(values, key=lambda v: -1 if v is None else v))}


def test_promotions(spark, tmp_path):
    log, schema = str(tmp_path / "log"), "run string, gain double"
    assert tables.promotions(spark, log, schema).count() == 0
    for i in (1, 2):
        tables.promote(spark, log, spark.createDataFrame([(f"r{i}", 0.5)], schema))
    assert sorted(r.run for r in tables.promotions(spark, log, schema).collect()) == ["r1", "r2"]


def test_bm25_is_stored_and_refused_when_tokens_drift(spark, tmp_path, monkeypatch):
    docs = spark.createDataFrame([(1, "alpha beta"), (2, "beta gamma gamma"), (3, None)], "id long, text string")
    stats = bm25.statistics(docs, "id", "text")
    vocab = bm25.vocabulary(bm25.term_counts(docs, "id", "text"), stats)
    bm25.save(vocab, stats, str(tmp_path / "fit"))
    again, then = bm25.load(spark, str(tmp_path / "fit"))
    assert sorted(again.collect()) == sorted(vocab.collect()) and then.collect() == stats.collect()
    left = bm25.weights_left(docs, docs.where("id = 1"), again, then, id_col="id", text_col="text")
    assert {(r.id, r.term) for r in left.collect()} <= {(2, "beta"), (2, "gamma")}
    monkeypatch.setattr(bm25, "TOKEN", "other")
    with pytest.raises(ValueError, match="would not match"):
        bm25.load(spark, str(tmp_path / "fit"))


@pytest.mark.parametrize("glob,path,held", [("a/*.xml", "a/b/c.xml", True), ("a/?.xml", "a/bc.xml", False), ("[!x]*", "xa", False), ("[ab].x+", "a.x+", True), ("[ab].x+", "a.xx", False), ("[", "[", True)])
def test_globs(glob, path, held):
    assert (re.search(plans.glob_pattern(glob), path) is not None) is held


def test_a_tree_is_whole_and_stays_inside(spark):
    listing = spark.createDataFrame([("a/../b.xml", "blob", 1)], "path string, type string, size long")
    with pytest.raises(ValueError, match="truncated"):
        plans.tree(listing, "https://example.org", "c", ["*"], truncated=True)
    with pytest.raises(PySparkException, match="leaves the root"):
        plans.tree(listing, "https://example.org", "c", ["*"]).collect()


def test_shards_at_their_bounds(spark):
    rows = spark.createDataFrame([("a", i, s, 1) for i, s in enumerate([5, None, 20, 3, 7, 1, 1, 1, 1])] + [(None, 1, 1, 1)], "g string, o long, s long, u int")
    got = ledger.shards(rows, "g", "o", "s", 10, units="u", max_units=3, max_rows=0).orderBy("g", "o").collect()
    # 20 passes the bound and is alone; 3 and 7 reach it; then three units a shard.
    assert [r.shard for r in got if r.g == "a"] == [0, 0, 1, 2, 2, 3, 3, 3, 4] and [r.shard for r in got if r.g is None] == [0]


def test_payloads_by_bytes_items_and_squares(spark):
    rows = spark.createDataFrame([(1, i, t) for i, t in enumerate(["é" * 3, "a" * 5, None, "", "b" * 50, "c" * 9, "c"])], "k int, o int, t string")
    by = lambda **bound: [r.batch for r in embedding.payloads(rows, "k", "o", "t", **bound).orderBy("o").collect()]
    assert by(max_bytes=11, max_items=9) == [0, 0, 0, 0, 1, 2, 2]
    assert by(max_bytes=1000, max_items=3) == [0, 0, 0, 1, 1, 1, 2]
    assert by(max_bytes=1000, max_items=9, max_square=100) == [0, 0, 1, 1, 2, 3, 4]


def test_no_cluster_without_a_direction():
    x = np.vstack([np.zeros((3, 4)), np.eye(4), np.eye(4)])
    assert (np.linalg.norm(kmeans.fit_matrix(x, 4).centroids, axis=1) > 0.5).sum() >= 3


def test_regions_open_and_close_over_paragraphs(spark):
    rows = spark.createDataFrame([(1, 0, "x"), (1, 1, "having regard to: x"), (1, 2, None), (1, 3, "x hereby x"), (2, 0, "hereby x having regard to x")], "doc_id long, seq int, text string")
    regions = {"based_on": ("having regard to", "hereby")}
    cites = rows.where("text is not null").select("doc_id", "seq", F.explode(F.array(F.lit(0), F.length("text") - 1)).alias("start")).distinct()
    got = {(r.doc_id, r.seq, r.start): r.region for r in stated.in_regions(cites, stated.region_marks(rows, regions), list(regions)).collect()}
    assert {k for k, v in got.items() if v} == {(1, 1, 0), (1, 1, 18), (1, 3, 0), (2, 0, 26)}


def test_labels_without_a_paragraph_stay(spark):
    rows = spark.createDataFrame([(1, 0, "paragraph", "Source:"), (1, 1, "heading", "A"), (1, 2, "paragraph", "Source:"), (1, 3, "paragraph", "Source:"), (1, 4, "paragraph", "b"), (1, 5, "paragraph", None), (1, 6, "paragraph", "Source:")], "doc_id int, reading_order int, type string, text string")
    assert [r.text for r in stated.merged_labels(rows, r"^Source:$").orderBy("reading_order").collect()] == ["Source:", "A", "Source:", "Source: b", None, "Source:"]
    assert stated.merged_labels(rows.limit(0), "^x$").count() == 0


def test_an_unknown_shape_is_refused(spark):
    cases = spark.createDataFrame([("1", "q", "riddle", None, None, None, None)], "id string, question string, shape string, difficulty string, source string, articles array<struct<regulation_type:string,regulation_number:string,year:int,article:string>>, expect_empty boolean")
    with pytest.raises(PySparkException, match="not known: riddle"):
        stated.seed_queries(cases, {"ACT": "A"}).collect()


def test_split_holds_null_ids_and_strata(spark):
    rows = spark.createDataFrame([(i, None if i % 2 else "a") for i in range(40)] + [(None, "a")], "id int, s string")
    got = evaluate.stratified_split(rows, "s", "id", 0.25, "7").groupBy("s").agg(F.count("*").alias("n"), F.count_if("held").alias("held")).collect()
    assert {(r.s, r.n, r.held) for r in got} == {("a", 21, 5), (None, 20, 5)}


def test_settings_that_clash_are_refused():
    with pytest.raises(ValueError, match="<p> is skipped and a leaf"):
        xml.Dialect(units={"s": ("section", 1)}, skip=frozenset({"p"}))
    with pytest.raises(ValueError, match="level 0"):
        xml.Dialect(units={"s": ("section", 0)})
    with pytest.raises(ValueError, match="another length"):
        kmeans.Clustering(np.ones((2, 2)), True).digest()
    assert kmeans.Clustering(np.eye(2), True).digest() != kmeans.Clustering(np.eye(2), False).digest()
    profile = specs.Profile("a", "1", units=(specs.Unit("part", "p", 1), specs.Unit("s", "s", 2), specs.Unit("t", "t", 2)), types={"ACT": "A", "RULE": "R"}, authority={"ACT": 3})
    assert profile.deepest_units() == ("s", "t") and '"rank":null' in profile.scoring() and '"top":3' in profile.scoring()
    assert specs.generation("/x/", "chunk", {"a": 1}) != specs.generation("/x", "chunk", {"a": 2})
