"""Operators that SQL cannot express, against plain Python and by what must hold of them."""

import json
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions import text as tx
from corpusloom.functions import vectors as vx
from corpusloom.operators import bm25, bundle, chunking, citing, embedding, evaluate, extract, factors, graph, kmeans, knn, ledger, mirror, relations, signals, units
from corpusloom.operators import blocks as bl
from corpusloom.plans import specs
from corpusloom.queries.reading import READING
from corpusloom.sources import files
from corpusloom.streaming import events


def test_text_layer_verdicts(spark):
    cases = {"short": "absent", "word " * 60: "clean", "x" * 30 + " word" * 60: "damaged", "word \x01" * 60: "damaged", "word �" * 60: "damaged"}
    df = spark.createDataFrame(list(cases.items()), "text string, want string")
    for r in df.select("want", tx.text_layer(F.col("text"))["layer"].alias("got")).collect():
        assert r.got == r.want


def test_bm25_score_is_inner_product(spark):
    docs = spark.createDataFrame([(1, "cat dog dog"), (2, "dog bird"), (3, ""), (4, None)], "doc_id int, text string")
    asked = spark.createDataFrame([(7, "dog dog cat")], "qid int, text string")
    got = {r.doc_id: r.score for r in bm25.top_documents(docs, asked, 5, doc_id="doc_id", query_id="qid").collect()}
    idf = lambda df: math.log(1 + (2 - df + 0.5) / (df + 0.5))
    weight = lambda df, tf, dl: idf(df) * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * dl / 2.5))
    assert got == pytest.approx({1: weight(2, 2, 3) + weight(1, 1, 3), 2: weight(2, 1, 2)}, abs=1e-5)


def test_factors_are_null_where_unknown(spark):
    df = spark.createDataFrame([(1995, "", ""), (1700, "Annex 1", "Art 2"), (None, None, "Annex")], "y int, c string, a string")
    got = df.select(factors.temporal(F.col("y"), 2000).alias("t"), factors.structural(F.col("c"), F.col("a"), ["annex"], ["art"]).alias("s")).collect()
    assert [r.t for r in got] == [round(25 / 30, 6), None, None]
    assert [r.s for r in got] == [None, 1.0, 0.3]
    assert df.select(factors.structural(F.col("c"), F.col("a"), [], []).alias("s")).where("s is not null").count() == 0
    body = spark.createDataFrame([("must not",), ("must " * 100,)], "b string").select(factors.completeness(F.col("b"), ["must"])[0].alias("c")).collect()
    assert [r.c for r in body] == [0.0, 1.0]


def test_knn_and_ties(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(60, 8))
    x[7] = x[3]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, v array<double>")
    got = knn.top_k(df, df.where("id % 20 = 0"), 5, id_col="id", vec_col="v").collect()
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    for q in (0, 20, 40):
        score = np.round(u @ u[q], 6)
        want = sorted((i for i in range(60) if i != q), key=lambda i: (-score[i], i))[:5]
        assert [r.id for r in sorted((r for r in got if r.qid == q), key=lambda r: r.rank)] == want


def test_kmeans_parts_blobs_and_repairs_empty_clusters():
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.normal(c, 0.02, size=(50, 4)) for c in np.eye(4)])
    c = kmeans.fit_matrix(x, 4)
    at, far = c.nearest(x)
    assert sorted(np.bincount(at)) == [50] * 4 and far.max() < 0.1
    assert np.allclose(np.linalg.norm(c.centroids, axis=1), 1)
    same = kmeans.fit_matrix(np.ones((5, 3)), 3, spherical=False)
    assert same.centroids.shape == (3, 3)
    with pytest.raises(ValueError):
        kmeans.fit_matrix(x[:2], 3)


def test_pagerank_sums_to_one_and_has_no_leak(spark):
    nodes = spark.createDataFrame([(i,) for i in range(5)], "doc_id long")
    edges = spark.createDataFrame([(0, 1), (1, 2), (3, 2)], "src long, dst long")
    rank = {r.doc_id: r["rank"] for r in graph.pagerank(nodes, edges, rounds=60).collect()}
    assert sum(rank.values()) == pytest.approx(1)
    assert rank[2] == max(rank.values())
    none = graph.pagerank(nodes, edges.limit(0)).collect()
    assert {r["rank"] for r in none} == {0.2}


def test_graph_drops_loops_and_counts_dangling(spark):
    ids = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (4, "c")], "doc_id long, identifier string")
    cites = spark.createDataFrame([(1, "a"), (1, "b"), (1, "b"), (2, "c"), (2, "z"), (9, "a")], "doc_id long, identifier string")
    g = graph.build(ids, cites)
    assert [tuple(r) for r in g["edges"].collect()] == [(1, 2)]
    assert {(r.target, r.citations) for r in g["dangling"].collect()} == {("c", 1), ("z", 1)}


def test_relations_follow_cues():
    got = citing.relations_of("This act revokes in part Act No. 5 of 1999. It does not amend Act 6 of 2001. See Rule 7 of 2002 only.", READING)
    assert [(r["relation"], r["number"], r["partial"]) for r in got] == [("revokes", "5", True), ("references", "6", False), ("references", "7", False)]
    listed = citing.relations_of("The following are repealed by this, which repeals: a. Act 1 of 1990; b. Act 2 of 1991.", READING)
    assert {r["number"] for r in listed} == {"1", "2"}
    assert citing.relations_of(None, READING) == []


def test_status_of_copies(spark):
    ids = spark.createDataFrame([(1, "ACT", "", "5", 1999), (2, "ACT", "", "5", 1999), (3, "ACT", "", "9", 2001)], "doc_id long, type string, body string, number string, year int")
    edges = spark.createDataFrame([(3, "revokes", 1, False), (1, "revokes", 2, False), (2, "amends", 3, False)], "source long, relation string, target long, partial boolean")
    got = {r.doc_id: (r.status, r.revoked_by) for r in relations.derive_status(edges, ids).collect()}
    assert got == {1: ("revoked", [3]), 2: ("revoked", [3]), 3: ("amended", [])}


@pytest.mark.parametrize(
    ("texts", "want"),
    [
        (["(a) x", "(1) y", "(i) z", "(ii) w", "(2) v", "(b) u"], ["(a)", "(a)(1)", "(a)(1)(i)", "(a)(1)(ii)", "(a)(2)", "(b)"]),
        (["(a)(1) x", "(2) y", "plain", "(b) z"], ["(a)(1)", "(a)(2)", None, "(b)"]),
        (["(h) x", "(i) y", "(j) z"], ["(h)", "(i)", "(j)"]),
        (["(h)(1) x", "(i) y", "(ii) z"], ["(h)(1)", "(h)(1)(i)", "(h)(1)(ii)"]),
        (["(h)(1) x", "(i) y", "(j) z"], ["(h)(1)", "(i)", "(j)"]),
        ([], []),
    ],
)
def test_outline_designations(texts, want):
    assert signals.designations(texts) == want


def test_html_and_tables():
    html = "<head><title>t</title></head><h1>A&amp;B</h1><p>one <b>two</b></p><script>no()</script><ul><li>x</li></ul>"
    assert extract.html_blocks_of(html) == [("heading", 1, "A&B"), ("paragraph", None, "one two"), ("list_item", None, "x")]
    assert extract.html_blocks_of(None) == []
    cells = extract.tables_of("<table><tr><th colspan=2>h</th></tr><tr><td rowspan=2>a</td><td>b</td></tr><tr><td>c</td></tr></table>")
    assert [(c[1], c[2], c[5]) for c in cells] == [(0, 0, "h"), (1, 0, "a"), (1, 1, "b"), (2, 1, "c")]


def test_heading_paths_against_a_stack(spark):
    rng = random.Random(4)
    rows = []
    for doc in range(20):
        for i in range(30):
            level = rng.choice([None, 1, 2, 3, 4])
            rows.append((doc, i, "heading" if level else "paragraph", level, f"t{i}"))
    got = {(r.doc_id, r.reading_order): r.heading_path for r in bl.heading_paths(spark.createDataFrame(rows, "doc_id int, reading_order int, type string, level int, text string")).collect()}
    for doc in range(20):
        stack = []
        for d, i, _, level, text in (r for r in rows if r[0] == doc):
            if level:
                stack = [*[s for s in stack if s[0] < level], (level, text)]
            assert got[(d, i)] == [t for _, t in stack]


def test_blocks_round_trip(spark):
    rows = [(1, 0, "paragraph", None, "- not a list"), (1, 1, "heading", 2, "x"), (1, 2, "list_item", None, "y"), (1, 3, "formula", None, "a+b"), (1, 4, "footnote", None, "f"), (1, 5, "paragraph", None, "# no heading")]
    df = spark.createDataFrame(rows, "doc_id int, reading_order int, type string, level int, text string")
    assert bl.round_trip_issues(df).count() == 0
    back = bl.parse_documents(bl.render_documents(df)).orderBy("reading_order").collect()
    assert [(r.type, r.level, r.text) for r in back] == [(t, n, x) for _, _, t, n, x in rows]


def test_pack_keeps_large_blocks_alone(spark):
    rows = [(1, i, "paragraph", "w " * n) for i, n in enumerate([10, 10, 50, 3, 3])]
    got = chunking.pack(spark.createDataFrame(rows, "doc_id int, reading_order int, type string, text string"), ["doc_id"], 30).orderBy("reading_order").collect()
    assert [r.part for r in got] == [0, 0, 1, 2, 2]


def test_overlap_takes_the_tail(spark):
    df = spark.createDataFrame([([(5, "a"), (4, "b"), (3, "c")],)], "rows array<struct<cost:int,text:string>>")
    assert [x.text for x in df.select(chunking.overlap(F.col("rows"), 8).alias("o")).first().o] == ["b", "c"]


def test_bundle_deltas(spark):
    old = spark.createDataFrame([(1, "u1"), (2, "u2"), (3, "u3")], "doc long, url string")
    new = spark.createDataFrame([(1, "u1"), (4, "u2")], "doc long, url string")
    assert {tuple(r) for r in bundle.delta(old, new, "doc", "url").collect()} == {(1, "same"), (2, "replaced"), (3, "removed"), (4, "added")}
    chunks = spark.createDataFrame([(1, True, 5), (2, True, 6), (3, False, 5)], "id long, indexable boolean, cluster_id int")
    layout = spark.createDataFrame([(1, 5), (2, 5), (3, 5)], "id long, cluster_id int")
    assert tuple(bundle.layout_problems(chunks, layout).first()) == (0, 1, 1)
    assert tuple(bundle.layout_problems(chunks, bundle.sync_layout(chunks, layout, 2)).first()) == (0, 0, 0)


def test_ledger_state_and_shards(spark):
    log = spark.createDataFrame([("a", 1, "failed", 7), ("a", 2, "done", None), ("b", 1, "failed", 8)], "key string, event_id int, status string, doc_id int").withColumn("updated_at", F.timestamp_seconds("event_id"))
    got = {r.key: (r.status, r.doc_id, r.attempts) for r in ledger.state(log).collect()}
    assert got == {"a": ("done", 7, 2), "b": ("failed", 8, 1)}
    assert [r.key for r in ledger.left_to_do(log.select("key").distinct(), log).collect()] == ["b"]
    rows = spark.createDataFrame([(0, i, s) for i, s in enumerate([6, 5, 4, 20, 1])], "g int, o long, s long")
    assert [r.shard for r in ledger.shards(rows, "g", "o", "s", 10).orderBy("o").collect()] == [0, 1, 1, 2, 3]


def test_measures_count_judgements_once(spark):
    ranked = spark.createDataFrame([(1, 1, "x"), (1, 2, "x"), (1, 3, "y"), (2, 1, "z")], "qid int, rank long, doc string")
    judged = spark.createDataFrame([(1, "x", 2), (1, "q", 1), (3, "y", 1)], "qid int, doc string, grade int")
    got = {r.qid: r for r in evaluate.measures(ranked, judged).collect()}
    assert got[1].recall == 1.0 and got[1].recall_distinct == 0.5 and got[1].mrr == 1.0
    assert got[2].recall is None and got[2].empty_as_due is False
    assert got[3].recall == 0.0 and got[3].ndcg == 0.0


def test_hash_vectors_have_length_one(spark):
    v = spark.createDataFrame([("a",), ("b",)], "t string").select(embedding.hash_vector(F.col("t"), 40).alias("v"))
    assert all(abs(n - 1) < 1e-9 for (n,) in v.select(vx.norm(F.col("v"))).collect())
    assert v.distinct().count() == 2


def test_specs_hash_what_matters():
    p = specs.Profile("p", "1", (specs.Unit("a", "x", 1),), {"ACT": "A", "NEW ACT": "NA"})
    assert p.structure_hash() == specs.Profile("p", "2", p.units).structure_hash() and p.config_hash() != specs.Profile("p", "2", p.units, p.types).config_hash()
    assert p.document_type("the new act of 5") == "NEW ACT" and p.cite("ACT", "5/1999", 1999) == "A 5/1999" and p.cite("ACT", "5", 1999) == "A 5/1999"
    base = specs.Variant("v", (("extract", {"a": 1}), ("chunk", {"b": 1})))
    grid = specs.matrix(base, {("chunk", "b"): [1, 2, 3]})
    assert specs.reuse(grid) == {"extract": 1, "chunk": 3} and grid[0].shares_with(base) == ["extract", "chunk"]
    with pytest.raises(ValueError):
        specs.Variant("v", (("extract", {"a": None}),))
    m = specs.Manifest({"model": "x"}, {"chunks": 3}, {})
    assert m.fingerprint() == specs.Manifest({"model": "x"}, {"chunks": 3}, {"f": "1"}, {"run": 2}).fingerprint()
    assert m.differences(specs.Manifest({"model": "y"}, {}, {})) == ["model"] and json.loads(m.to_json())["counts"] == {"chunks": 3}
    assert specs.ChunkConfig().over({"max_tokens": 9, "overlap_tokens": None}).max_tokens == 9


def test_created_tables_hold_rows(spark):
    spark.sql("DROP TABLE IF EXISTS odd_name")
    spark.sql(specs.create_table("odd_name", T.StructType([T.StructField("a`b", T.LongType()), T.StructField("v", T.ArrayType(T.FloatType()))])))
    assert spark.table("odd_name").columns == ["a`b", "v"]
    spark.sql("DROP TABLE odd_name")


def test_file_scan(spark, tmp_path):
    for name, text in (("a.md", "x"), ("b.HTML", "x"), ("sub/c.txt", "y"), (".hidden", "z")):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text(text)
    (tmp_path / "sub" / "list.lst").write_text("# all\na.md\nnone.md # gone\n\n")
    found = files.scan(spark, str(tmp_path))
    assert {(r.rel, r.mime) for r in found.collect()} == {("a.md", "text/markdown"), ("b.HTML", "text/html"), ("sub/c.txt", "text/plain"), ("sub/list.lst", "application/octet-stream")}
    listed = files.read_list(spark, str(tmp_path / "sub/list.lst"))
    assert [r.rel for r in files.missing(listed, found).collect()] == ["none.md"]
    assert files.scan(spark, str(tmp_path), only=listed).count() == 1
    assert files.report(found).agg(F.sum("copies")).first()[0] == 0
    files.write_manifest(found, str(tmp_path / "m"))
    assert files.read_manifest(spark, str(tmp_path / "m")).count() == 4


@pytest.mark.parametrize("form", ["lines", "array", "object"])
def test_query_sets(spark, tmp_path, form):
    q = [{"qid": str(i), "query": "x", "type": "t", "relevant": [{"doc": "d", "locator": "l", "grade": 1}]} for i in range(3)]
    text = "\n".join(json.dumps(x) for x in q) if form == "lines" else json.dumps(q) if form == "array" else json.dumps({"queries": q})
    (tmp_path / "q.json").write_text(text)
    assert {r.qid for r in files.load_queries(spark, str(tmp_path / "q.json")).collect()} == {"0", "1", "2"}


def test_vector_width_is_checked(spark, tmp_path):
    df = spark.createDataFrame([("a", [1.0, 2.0])], "chunk_id string, embedding array<double>")
    files.write_vectors(df, str(tmp_path / "v"), 2)
    with pytest.raises(Exception, match="width"):
        files.write_vectors(df, str(tmp_path / "w"), 3)


def test_stream_of_events(spark, tmp_path):
    rows = [(i, 1_000_000_000 + 600 * i, i % 3, "k", 1.0, "{}") for i in range(300)]
    df = spark.createDataFrame(rows, "event_id long, s long, user_id long, event_type string, value double, props string").select("event_id", F.timestamp_seconds("s").alias("ts"), "user_id", "event_type", "value", "props")
    df.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = events.windowed(events.read(spark, str(tmp_path / "in")), late="100 days")
    q = stream.writeStream.outputMode("complete").format("memory").queryName("daily").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "c")).start()
    q.awaitTermination(120)
    want = df.groupBy(F.window("ts", "1 day")).agg(F.count("*").alias("n")).agg(F.count("*"), F.sum("n")).first()
    assert tuple(spark.table("daily").agg(F.count("*"), F.sum("n")).first()) == tuple(want)
    log = events.read(spark, str(tmp_path / "in")).select(F.col("user_id").alias("key"), "event_id", F.col("ts").alias("updated_at"), F.lit("done").alias("status"), F.col("event_id").alias("doc_id"))
    events.append_ledger(log, str(tmp_path / "log"), str(tmp_path / "c2")).awaitTermination(120)
    assert events.ledger_state(spark, str(tmp_path / "log")).count() == 3


def test_top_k_uses_group_limits(spark):
    docs = spark.createDataFrame([(1, "cat dog")], "doc_id int, text string")
    plan = bm25.top_documents(docs, docs.withColumnRenamed("doc_id", "qid"), 3, doc_id="doc_id", query_id="qid")._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


@pytest.mark.parametrize(
    ("texts", "last"),
    [
        (["(b) x", "(c) x", "(d) x"], "(d)"),
        (["(h) x", "(i) x"], "(i)"),
        (["(h) x", "(1) x", "(i) x", "(j) x"], "(j)"),
        (["(h) x", "(1) x", "(i) x", "(ii) x"], "(h)(1)(ii)"),
        (["(b)(2)(iv) x", "(A) x", "( 1 ) x", "(i) x"], "(b)(2)(iv)(A)(1)(i)"),
        (["(y) x", "(z) x", "(aa) x"], "(aa)"),
        (["(c) x", "(d) Terms. (1) One.", "(i) x", "(v) x"], "(d)(1)(v)"),
        (["(a) x", "(3) Uses (see 1 of 2)\u2014(i) First.", "(A) x"], "(a)(3)(i)(A)"),
        (["(1) x", "(i) x", "(ii) x", "(2) x"], "(2)"),
        (["(a) x", "no marker"], None),
        (["(a) x", "(§) x", None, ""], None),
    ],
)
def test_outline_by_what_comes_before_and_after(texts, last):
    assert signals.designations(texts)[-1] == last


def test_outline_settles_backwards():
    assert signals.designations(["(h) x", "(1) x", "(i) x", "(j) x"])[2] == "(i)"
    assert signals.designations(["(h) x", "(1) x", "(i) x", "(ii) x"])[2] == "(h)(1)(i)"
    assert signals.designations([f"({chr(97 + k % 26)}) x" for k in range(3000)])[-1] == "(j)"


def test_html_silent_nested_and_unclosed():
    html = "a<div>b <b>c</b><script>x<p>y</script> d<ul><li>e<p>f</ul><h2>g<p>h<style>i"
    assert extract.html_blocks_of(html) == [("paragraph", None, "a"), ("paragraph", None, "b c d"), ("list_item", None, "e"), ("paragraph", None, "f"), ("heading", 2, "g"), ("paragraph", None, "h")]


def test_sparse_literal_has_six_figures_and_rising_places(spark):
    from corpusloom.operators import records

    w = spark.createDataFrame([(1, "b", 0.123456789), (1, "a", 12.5), (1, "z", 1.0), (2, "a", 1e-7)], "id long, term string, weight double")
    v = spark.createDataFrame([("a", 9), ("b", 0)], "term string, idx long")
    assert {r.id: r.literal for r in records.sparse_literal(w, v, 10).collect()} == {1: "{1:0.123457,10:12.5}/10", 2: "{10:1e-07}/10"}
    assert records.alternation(["act", "act of law", "a+"]) == r"(?:act of law|act|a\+)"


def test_folds_carry_over_batches_and_null_keys(spark):
    """Greedy packing, joining of small rows and segments against plain loops, over more rows than a batch of Arrow holds."""
    rng = random.Random(3)
    rows = [(d, i, "heading" if rng.random() < 0.2 else "paragraph", rng.choice([1, 2, 3, None]), None if rng.random() < 0.05 else "word " * rng.randrange(12)) for d, n in ((1, 12_000), (2, 1), (None, 40)) for i in range(n)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id int, reading_order int, type string, level int, text string")
    costs = {(r.doc_id, r.reading_order): r.c or 0 for r in df.withColumn("c", tx.estimated_tokens(F.col("text"))).collect()}
    part, group, segment = {}, {}, {}
    for d in (1, 2, None):
        used = at = held = g = n = 0
        level, first = None, True
        for _, i, kind, lv, _ in sorted((r for r in rows if r[0] == d), key=lambda r: r[1]):
            c = costs[d, i]
            if not first and used + c > 30:
                used, at = 0, at + 1
            used, first = used + c, False
            part[d, i] = at
            group[d, i] = g
            held += c
            if held >= 20:
                held, g = 0, g + 1
            if kind == "heading" and (level is None or (lv is not None and (lv == 2 or lv <= level))):
                level, n = lv, n + 1
            segment[d, i] = n
        if held and g:
            group |= {k: g - 1 for k, v in group.items() if k[0] == d and v == g}
    assert {(r.doc_id, r.reading_order): r.part for r in chunking.pack(df, ["doc_id"], 30).collect()} == part
    sized = df.withColumn("size", tx.estimated_tokens(F.col("text")))
    assert {(r.doc_id, r.reading_order): r.group for r in chunking.coalesce_small(sized, "doc_id", "reading_order", "size", 20).collect()} == group
    assert {(r.doc_id, r.reading_order): r.segment for r in units.segments(df, (2,)).collect()} == segment
    assert chunking.pack(df.limit(0), ["doc_id"], 30).count() == 0


def test_no_task_gets_all_rows_of_a_common_term(spark):
    docs = spark.range(40).select(F.col("id").alias("doc_id"), F.concat(F.lit("the of w"), "id").alias("text"))
    asked = spark.createDataFrame([(1, "the w3"), (2, "of w4 w5")], "item_id long, text string")
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        stats = bm25.statistics(docs, "doc_id", "text")
        counts = bm25.term_counts(docs, "doc_id", "text")
        made = bm25.weights(counts, bm25.vocabulary(counts, stats, 500), stats)
        best = bm25.top_documents(docs, asked, 2, doc_id="doc_id", query_id="item_id")
        for df in (made, best):
            assert "SortMergeJoin" not in df._jdf.queryExecution().executedPlan().toString()
        assert {(r.item_id, r.rank, r.doc_id) for r in best.collect()} == {(1, 1, 3), (1, 2, 0), (2, 1, 4), (2, 2, 5)}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)


def test_reference_issues_are_dealt_out_by_their_number(spark, monkeypatch):
    monkeypatch.setattr(graph, "ROWS_PER_TASK", 50)
    blocks = spark.createDataFrame([(d, r) for d in range(60) for r in ("a", "a", "x", None)] + [(None, "a")], "doc_id long, ref string")
    tables = spark.createDataFrame([(d, t) for d in range(60) for t in ("a", "b", "b")] + [(None, "a")], "doc_id long, table_id string")
    got = mirror.reference_issues(blocks, tables)
    want = [(d, r, rule) for d in range(60) for r, rule in (("a", "multiple"), ("b", "orphan"), ("x", "dangling"))]
    assert sorted(((r.doc_id, r.ref, r.rule) for r in got.where("doc_id IS NOT NULL").collect())) == want
    assert sorted((r.ref, r.rule) for r in got.where("doc_id IS NULL").collect()) == [("a", "dangling"), ("a", "orphan")]
    # However few bytes 363 rows have, no task is given all of them.
    assert got.rdd.getNumPartitions() == 8


def test_repeated_ids_are_dealt_out_by_their_number(spark, monkeypatch):
    monkeypatch.setattr(graph, "ROWS_PER_TASK", 50)
    got = bl.repeated_ids(spark.createDataFrame([(n % 300,) for n in range(303)], "k long"), "k")
    assert sorted((r.k, r["count"]) for r in got.collect()) == [(0, 2), (1, 2), (2, 2)]
    assert got.rdd.getNumPartitions() == 7
