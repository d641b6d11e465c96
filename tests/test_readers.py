"""Readers by type, chunkers by name, files found, snapshots, and second readings of queries that SQL cannot express."""

import hashlib
import re
import unicodedata
from html import unescape
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import bm25, readers, xml
from corpusloom.queries import queries
from corpusloom.sources import files

D = "/root/testdata/sf0.001"


def test_each_type_has_its_reader(spark):
    rows = [(1, "text/plain", "a\n\nb"), (2, "TEXT/markdown", "# H\nx"), (3, "text/html", "<h2>T</h2><p>y</p>"), (4, "text/xml", "<d><s><head>Z</head>z</s></d>"), (5, "image/png", "?"), (6, None, "q"), (7, "text/plain", " \n"), (8, "text/xml", "<d")]
    docs = spark.createDataFrame(rows, "id long, mime string, body string")
    dialect = xml.Dialect(units={"s": ("section", 2)})
    got = sorted(tuple(r) for r in readers.read(docs, "id", "mime", "body", dialect=dialect).where("doc_id < 8").collect())
    assert got == [(1, 0, "paragraph", None, "a"), (1, 1, "paragraph", None, "b"), (2, 0, "heading", 1, "H"), (2, 1, "paragraph", None, "x"), (3, 0, "heading", 2, "T"), (3, 1, "paragraph", None, "y"), (4, 0, "heading", 2, "Z"), (4, 1, "paragraph", None, "z"), (5, 0, "error", None, "no reader of image/png"), (6, 0, "error", None, "no reader of an unknown type"), (7, 0, "error", None, "no text")]
    assert [r.type for r in readers.read(docs, "id", "mime", "body", dialect=dialect).where("doc_id = 8").collect()] == ["error"]
    assert readers.read(docs.where("id = 4"), "id", "mime", "body").first().text == "no reader of text/xml"


def test_chunkers_by_name(spark):
    blocks = spark.createDataFrame([(1, 0, "paragraph", None, None, "a b c"), (1, 1, "paragraph", None, None, "d e f")], "doc_id long, reading_order int, type string, level int, unit string, text string")
    assert {r.chunker for r in readers.chunk(blocks, "token", {"max_tokens": 4}).collect()} == {"token@1"}
    assert readers.chunk(blocks, "unit@1", {"min_tokens": 0}).count() == 1
    with pytest.raises(LookupError, match="heading@1, markup@1, token@1, unit@1"):
        readers.chunk(blocks, "page")


def test_files_in_either_case(spark, tmp_path):
    for name in ("a.xml", "b.XML", "c.Xml", "d.txt", ".e.xml", "sub/f.xml", "xml"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text("x")
    found = files.find(spark, [str(tmp_path), str(tmp_path / "sub")], ["*.xml", "a.*"])
    assert [r.path.rsplit("/", 1)[1] for r in found.collect()] == ["a.xml", "b.XML", "c.Xml", "f.xml"]
    assert files.either_case("*") == "*" and files.either_case("v1.0/x") == "v1.0/x"


def test_snapshot_only_when_complete(spark, tmp_path):
    wanted = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "rel string, size long")
    there = spark.createDataFrame([("a", 1), ("b", 5), ("x", 9)], "rel string, size long")
    with pytest.raises(ValueError, match="2 files are not as listed: b conflict, c missing"):
        files.write_snapshot(wanted, there, str(tmp_path / "s"))
    assert not (tmp_path / "s").exists()
    assert files.write_snapshot(wanted, wanted, str(tmp_path / "s")) == 3 and sorted(r.rel for r in files.read_list(spark, str(tmp_path / "s")).collect()) == ["a", "b", "c"]


# ---- second readings over whole tables


def cleaned(text):
    text = unicodedata.normalize("NFKC", unescape(text))
    return re.sub(r"\s+", " ", re.sub("[­​﻿]", "", text)).strip()


def test_normalised_text(spark):
    want = {r.doc_id: hashlib.sha256(cleaned(r.text).encode()).hexdigest() for r in spark.read.parquet(f"{D}/documents.parquet").collect()}
    assert {r.doc_id: r.text_hash for r in queries()["normalised_text"](spark, D).collect()} == want


def test_table_grids(spark):
    want = {}
    for r in spark.read.parquet(f"{D}/pages.parquet").collect():
        lines = ["| head |  |  |"]
        # A cell of two rows stands in the second column and in the third by turns.
        for k, line in enumerate(r.html.split("\n")):
            text = cleaned(unescape(re.sub("<[^>]*>", " ", line))).replace("|", "\\|")
            lines.append(f"| {text} | x |  |" if k % 2 == 0 else f"| {text} |  | x |")
        want[r.page_id] = "\n".join(lines)
    got = {r.doc_id: r.grid for r in queries()["table_grids"](spark, D).collect()}
    assert set(got) == set(want)
    assert {k for k in want if re.sub(r"\s+", " ", got[k]) != re.sub(r"\s+", " ", want[k])} == set()


def test_all_terms_are_counted_where_texts_are_cut(spark):
    """Texts are shuffled by id, terms are not; rows of one id and length are counted together as before."""
    docs = spark.createDataFrame([(1, "aa bb aa"), (1, "aa cc cc"), (1, "aa"), (2, None), (None, "bb bb")], "id long, text string")
    counts = bm25.term_counts(docs, "id", "text")
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "REPARTITION_BY_COL" in plan
    got = {(r.id, r.term, r.tf, r.dl) for r in counts.collect()}
    assert got == {(1, "aa", 3, 3), (1, "bb", 1, 3), (1, "cc", 2, 3), (1, "aa", 1, 1), (None, "bb", 2, 2)}


def test_sparse_literals_count_terms_of_the_vocabulary_alone(spark, monkeypatch):
    asked, plain = [], bm25.term_counts
    monkeypatch.setattr(bm25, "term_counts", lambda *a, **k: asked.append("only" in k) or plain(*a, **k))
    assert queries()["sparse_literals"](spark, D).count() > 0 and asked == [False, True]


def test_sparse_literals(spark):
    weights = queries()["bm25_doc_vectors"](spark, D)
    place = {t: k + 1 for k, t in enumerate(sorted(r.term for r in weights.select("term").distinct().collect()))}
    want = {}
    for r in weights.collect():
        want.setdefault(r.doc_id, []).append((place[r.term], r.weight))
    got = {r.id: r.literal for r in queries()["sparse_literals"](spark, D).collect()}
    assert set(got) == set(want)
    for doc, literal in got.items():
        body, size = literal[1:].split("}/")
        pairs = [x.split(":") for x in body.split(",")]
        assert size == "500" and [int(a) for a, _ in pairs] == sorted(a for a, _ in want[doc]), doc
        assert all(abs(float(b) - w) <= 1e-5 * max(1, w) for (_, b), (_, w) in zip(pairs, sorted(want[doc]), strict=True))


class Text(HTMLParser):
    """All text of a page outside of silent tags, as words."""

    def __init__(self):
        super().__init__()
        self.depth, self.words = 0, []

    def handle_starttag(self, tag, attrs):
        self.depth += tag in {"script", "style", "noscript", "template", "svg", "head"}

    def handle_endtag(self, tag):
        self.depth -= self.depth > 0 and tag in {"script", "style", "noscript", "template", "svg", "head"}

    def handle_data(self, data):
        if not self.depth:
            self.words += cleaned(data).split()


def test_html_blocks_hold_every_word_and_headings_their_level(spark):
    blocks = {}
    for r in sorted(queries()["html_blocks"](spark, D).collect(), key=lambda r: (r.doc_id, r.reading_order)):
        blocks.setdefault(r.doc_id, []).append(r)
    for page in spark.read.parquet(f"{D}/pages.parquet").collect():
        reader = Text()
        reader.feed(page.html)
        reader.close()
        held = blocks.get(page.page_id, [])
        assert "".join(w for b in held for w in b.text.split()) == "".join(reader.words), page.page_id
        heads = [(int(n), cleaned(re.sub("<[^>]*>", " ", t))) for n, t in re.findall(r"(?is)<h([1-6])[^>]*>(.*?)</h\1>", re.sub(r"(?is)<(script|style|head)\b.*?</\1>", "", page.html))]
        assert [(b.level, b.text) for b in held if b.type == "heading"] == [h for h in heads if h[1]], page.page_id


def test_marker_chains(spark):
    lines = {}
    for r in queries()["subunit_markers"](spark, D).collect():
        lines.setdefault(r.doc_id, {})[r.line] = (r.kind, r.marker)
    for r in sorted(queries()["marker_chains"](spark, D).where(F.col("doc_id") % 7 == 0).collect(), key=lambda r: (r.doc_id, r.line)):
        marks = [lines.get(r.doc_id, {}).get(n) for n in range(r.line + 1)]
        last = {}
        for n, mark in enumerate(m for m in marks):
            if mark:
                last = {k: v for k, v in last.items() if k != mark[0] and v[0] < last.get(mark[0], (n,))[0]}
                last[mark[0]] = (n, mark[1])
        assert r.chain == " ".join(f"{k} {v[1]}" for k, v in sorted(last.items(), key=lambda kv: kv[1][0])), (r.doc_id, r.line)
