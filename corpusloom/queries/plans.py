"""Queries over fetch plans, tables with fixed schemas, positions, and what markup and labels state."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.operators import bm25, citing, stated
from corpusloom.operators import evaluate as ev
from corpusloom.queries.base import ORACLES, query, table
from corpusloom.queries.evaluate import locator_coverage
from corpusloom.queries.reading import READING
from corpusloom.sources import plans, tables


@query("plan_titles", """SELECT 'title-' || s_suppkey AS "group", edition, 'https://example.org/full/' || edition || '/title-' || s_suppkey || '.xml' AS url FROM (SELECT s_suppkey, '2020-01-' || lpad(CAST(1 + s_nationkey AS VARCHAR), 2, '0') AS edition FROM supplier WHERE s_suppkey % 11 = 0 OR s_suppkey % 7 <> 0)""")
def plan_titles(spark: SparkSession, d: str) -> DataFrame:
    """Suppliers as titles: every seventh is reserved, of every eleventh that is not known."""
    k = F.col("s_suppkey")
    date = F.format_string("2020-01-%02d", F.col("s_nationkey") + 1)
    listing = table(spark, d, "supplier").select(k.alias("number"), F.when(k % 11 != 0, k % 7 == 0).alias("reserved"), date.alias("up_to_date_as_of"))
    return plans.titles(listing, "https://example.org/full/")


@query("plan_tree", """SELECT 'c0ffee/' || p AS path, 'https://example.org/raw/c0ffee/' || replace(p, ' ', '%20') AS url, size, regexp_replace(p, '/[^/]*$', '') AS "group" FROM (SELECT p_partkey, CAST(p_size AS BIGINT) AS size, CASE p_partkey % 3 WHEN 0 THEN 'eng/acts' WHEN 1 THEN 'fra/x-lois/sub' ELSE 'fra/lois/sub' END || '/a ' || p_partkey || ' (1).' || CASE WHEN p_partkey % 4 = 0 THEN 'XML' ELSE 'xml' END AS p FROM part WHERE p_partkey % 10 <> 0) WHERE p_partkey % 3 <> 1 AND p_partkey % 4 <> 0""")
def plan_tree(spark: SparkSession, d: str) -> DataFrame:
    """Parts as files and folders of a commit; names count in their case."""
    k = F.col("p_partkey")
    folder = F.when(k % 3 == 0, "eng/acts").when(k % 3 == 1, "fra/x-lois/sub").otherwise("fra/lois/sub")
    path = F.concat(folder, F.lit("/a "), k.cast("string"), F.lit(" (1)."), F.when(k % 4 == 0, "XML").otherwise("xml"))
    listing = table(spark, d, "part").select(path.alias("path"), F.when(k % 10 == 0, "tree").otherwise("blob").alias("type"), F.col("p_size").alias("size"))
    return plans.tree(listing, "https://example.org/raw", "c0ffee", ["eng/acts/*.xml", "fra/[!x]*.xml"])


@query("typed_edges", "SELECT CAST(l_orderkey AS VARCHAR) AS source, CAST(l_partkey AS VARCHAR) AS target, CAST(count(*) AS INTEGER) AS weight FROM lineitem GROUP BY ALL")
def typed_edges(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("source"), F.col("l_partkey").alias("target")).agg(F.count("*").alias("weight"))
    return tables.typed(rows.withColumn("more", F.lit(1)), "edges")


@query("typed_signals", """SELECT CAST(doc_id AS VARCHAR) AS chunk_id, '{' || CASE WHEN lang IS NULL THEN '' ELSE '"lang":"' || lang || '",' END || '"n_chars":' || n_chars || '}' AS signals FROM documents""")
def typed_signals(spark: SparkSession, d: str) -> DataFrame:
    return tables.typed(table(spark, d, "documents").select(F.col("doc_id").alias("chunk_id"), "n_chars", "lang"), "signals")


@query("row_range", "SELECT o_orderkey, position FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS position FROM orders) WHERE position >= 100 AND position < 1300")
def row_range(spark: SparkSession, d: str) -> DataFrame:
    return tables.row_range(tables.positions(table(spark, d, "orders").select("o_orderkey"), "o_orderkey", parts=64), 100, 1300)


@query("vector_alignment", """SELECT doc_id AS position, CASE WHEN vec_id IS NULL THEN 'no vector' WHEN vec_id % 9 = 0 THEN 'another chunk' WHEN vec_id % 5 = 0 THEN 'another width' END AS problem FROM documents LEFT JOIN embeddings ON vec_id = doc_id WHERE vec_id IS NULL OR vec_id % 9 = 0 OR vec_id % 5 = 0
UNION ALL SELECT vec_id, 'no chunk' FROM embeddings WHERE vec_id NOT IN (SELECT doc_id FROM documents)""")
def vector_alignment(spark: SparkSession, d: str) -> DataFrame:
    """Vectors at the places of documents: every ninth names another chunk, every fifth lost a number."""
    k = F.col("vec_id")
    chunks = table(spark, d, "documents").select(F.col("doc_id").alias("position"), F.col("doc_id").alias("chunk_id"))
    vectors = table(spark, d, "embeddings").select(k.alias("position"), F.when(k % 9 == 0, -1).otherwise(k).alias("chunk_id"), F.when(k % 5 == 0, F.slice("embedding", 2, 1000)).otherwise(F.col("embedding")).alias("embedding"))
    return tables.aligned(vectors, chunks, 64)


@query("declared_headings", "SELECT l_orderkey AS doc_id, count(*) AS headings, count(*) FILTER (WHERE l_partkey % 3 = 2) AS undeclared, count(*) FILTER (WHERE l_partkey % 3 < 2 AND l_partkey % 3 <> l_linenumber % 3) AS mismatched FROM lineitem WHERE l_linenumber % 2 = 1 GROUP BY 1")
def declared_headings(spark: SparkSession, d: str) -> DataFrame:
    unit = F.when(F.col("l_partkey") % 3 == 0, "part").when(F.col("l_partkey") % 3 == 1, "chapter").otherwise("annex")
    kind = F.when(F.col("l_linenumber") % 2 == 1, "heading").otherwise("paragraph")
    blocks = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("doc_id"), kind.alias("type"), unit.alias("unit"), (F.col("l_linenumber") % 3 + 1).alias("level"))
    return stated.declared_headings(blocks, {"part": 1, "chapter": 2})


@query("extractor_choice", "SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN 'markup' WHEN 1 THEN 'text' WHEN 2 THEN 'markup' END AS extractor FROM part")
def extractor_choice(spark: SparkSession, d: str) -> DataFrame:
    mime = F.when(F.col("p_size") % 4 == 0, "application/xml").when(F.col("p_size") % 4 == 1, "text/plain").when(F.col("p_size") % 4 == 2, "text/html")
    choice = stated.extractor_for(mime, [("markup", ["application/xml", "text/html"]), ("text", ["text/plain", "text/html"])])
    return table(spark, d, "part").select("p_partkey", choice.alias("extractor"))


@query("merged_labels", """WITH b AS (SELECT p_partkey // 5 AS doc_id, p_partkey % 5 AS reading_order, p_partkey % 7 = 0 AS h, p_partkey % 7 <> 0 AND p_size % 3 = 0 AS lab, CASE WHEN p_size % 3 = 0 THEN 'Authority:' ELSE p_name END AS text FROM part),
w AS (SELECT *, lag(lab) OVER o AS plab, lead(lab) OVER o AS nlab, lead(h) OVER o AS nh FROM b WINDOW o AS (PARTITION BY doc_id ORDER BY reading_order))
SELECT doc_id, reading_order, CASE WHEN plab AND NOT h AND NOT lab THEN 'Authority: ' || text ELSE text END AS text FROM w WHERE NOT coalesce(lab AND NOT nlab AND NOT nh, false)""")
def merged_labels(spark: SparkSession, d: str) -> DataFrame:
    """Part names as paragraphs, some of which are only a label, between headings."""
    k = F.col("p_partkey")
    text = F.when(F.col("p_size") % 3 == 0, "Authority:").otherwise(F.col("p_name"))
    blocks = table(spark, d, "part").select(F.floor(k / 5).alias("doc_id"), (k % 5).alias("reading_order"), F.when(k % 7 == 0, "heading").otherwise("paragraph").alias("type"), text.alias("text"))
    return stated.merged_labels(blocks, r"^(?:Authority|Source):\s*$").drop("type")


@query("context_groups", "SELECT p_partkey, nullif(regexp_extract(p_brand, '#([1-3])(\\d)', 1), '') AS maker, nullif(regexp_extract(p_brand, '#([1-3])(\\d)', 2), '') AS line, nullif(regexp_extract(p_type, '^([A-Z]+) ', 1), '') AS size FROM part")
def context_groups(spark: SparkSession, d: str) -> DataFrame:
    found = stated.context_groups({"brand": F.col("p_brand"), "type": F.col("p_type")}, {"brand": r"#(?P<maker>[1-3])(?P<line>\d)", "type": "^(?P<size>[A-Z]+) "})
    return table(spark, d, "part").select("p_partkey", *[F.try_element_at(found, F.lit(f"ctx_{g}")).alias(g) for g in ("maker", "line", "size")])


SHAPES = list(stated.QUESTION_TYPES)


@query("seed_queries", f"""WITH c AS (SELECT p_partkey AS qid, p_name AS query, ({SHAPES})[1 + p_partkey % 12] AS shape, ({list(stated.QUESTION_TYPES.values())})[1 + p_partkey % 12] AS type, p_partkey % 2 = 0 AS act, p_size, p_type FROM part)
SELECT qid, query, type, CASE WHEN type <> 'negative' AND qid % 5 <> 0 THEN CASE WHEN act THEN 'A ' ELSE 'O ' END || p_size || '/' || (2000 + qid % 20) || '#' || CASE WHEN act THEN '' ELSE '7' END || '#3' ELSE '' END AS relevant, 'shape=' || shape || ' · difficulty=' || CASE WHEN act THEN '?' ELSE 'hard' END || CASE WHEN qid % 3 = 0 THEN '' ELSE ' · read=' || p_type END || CASE WHEN type = 'negative' THEN ' · expect_empty: the correct result is no result' ELSE '' END AS notes FROM c""")
def seed_queries(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("p_partkey")
    act = k % 2 == 0
    article = F.struct(F.when(act, "act ").otherwise("Order").alias("regulation_type"), F.col("p_size").alias("regulation_number"), (2000 + k % 20).alias("year"), F.when(~act, "7").alias("article"))
    shape = F.element_at(F.array(*[F.lit(s) for s in SHAPES]), (k % 12 + 1).cast("int"))
    cases = table(spark, d, "part").select(k.alias("id"), F.col("p_name").alias("question"), shape.alias("shape"), F.when(~act, "hard").alias("difficulty"), F.when(k % 3 != 0, F.col("p_type")).alias("source"), F.when(k % 5 != 0, F.array(article)).alias("articles"), (shape == "out_of_domain").alias("expect_empty"))
    out = stated.seed_queries(cases, {"ACT": "A", "ORDER": "O"})
    return out.withColumn("relevant", F.array_join(F.transform("relevant", lambda r: F.concat(r["doc"], F.lit("#"), r["locator"], F.lit("#"), r["grade"].cast("string"))), ","))


@query("sampling_note", "SELECT count(*) AS chunks, count(*) FILTER (WHERE doc_id % 20 = 0) AS scored, count(*) FILTER (WHERE doc_id % 20 = 0) < count(*) AS sampled, round(count(*) FILTER (WHERE doc_id % 20 = 0) / count(*), 6) AS share FROM documents")
def sampling_note(spark: SparkSession, d: str) -> DataFrame:
    return stated.sampling_note(table(spark, d, "documents"), F.col("doc_id") % 20 == 0)


@query("strict_hits", f"SELECT p_partkey, p_partkey % 2 = 0 AND coverage <> 'none' AS hit, p_partkey % 2 = 0 AND coverage NOT IN ('none', 'within') AS strict FROM ({ORACLES['locator_coverage']})")
def strict_hits(spark: SparkSession, d: str) -> DataFrame:
    """Candidates of the same instrument for even keys, by how their locators cover the label."""
    k = F.col("p_partkey")
    same = ev.normal_identifier(F.lit("Act No. 3/2001")) == ev.normal_identifier(F.when(k % 2 == 0, "act 3 / 2001").otherwise("act 4/2001"))
    return locator_coverage(spark, d).select("p_partkey", stated.hit(same, F.col("coverage")).alias("hit"), stated.hit(same, F.col("coverage"), strict=True).alias("strict"))


@query("citation_regions", """SELECT p_partkey, CAST(p_size AS VARCHAR) AS number, CASE WHEN p_partkey % 10 BETWEEN 2 AND 6 THEN 'based_on' END AS region FROM part UNION ALL SELECT p_partkey, '7', NULL FROM part WHERE p_partkey % 10 = 6""")
def citation_regions(spark: SparkSession, d: str) -> DataFrame:
    """Ten paragraphs a document: the third opens the legal basis, the seventh closes it between two citations."""
    k = F.col("p_partkey")
    cited = F.concat(F.col("p_size").cast("string"), F.lit(" of 1995."))
    text = F.when(k % 10 == 2, F.concat(F.lit("Having regard to Act No. "), cited)).when(k % 10 == 6, F.concat(F.lit("Rule No. "), cited, F.lit(" Hereby decides that Act No. 7 of 1999 stands."))).otherwise(F.concat(F.lit("This amends Act No. "), cited))
    rows = table(spark, d, "part").select("p_partkey", F.floor(k / 10).alias("doc_id"), (k % 10).cast("int").alias("seq"), text.alias("text"))
    marks = stated.region_marks(rows, {"based_on": (r"\bhaving regard to\b", r"\bhereby decides\b")})
    found = citing.references(rows, READING, "p_partkey", "text").where("kind = 'regulation'").select(F.col("doc_id").alias("p_partkey"), "start", "number")
    placed = found.select(F.floor(F.col("p_partkey") / 10).alias("doc_id"), (F.col("p_partkey") % 10).cast("int").alias("seq"), "start", "number", "p_partkey")
    return stated.in_regions(placed, marks, ["based_on"]).select("p_partkey", "number", "region")


@query("relations_in_regions", """WITH r AS (SELECT p_partkey // 10 AS doc_id, CASE WHEN p_partkey % 10 = 4 THEN 'references' WHEN p_partkey % 10 BETWEEN 2 AND 6 THEN 'based_on' WHEN p_partkey % 10 = 9 THEN 'references' ELSE 'amends' END AS relation, CASE WHEN p_partkey % 10 = 6 THEN 'RULE' ELSE 'ACT' END AS type, CAST(p_size AS VARCHAR) AS number, 1995 AS year FROM part
UNION ALL SELECT p_partkey // 10, 'references', 'ACT', '7', 1999 FROM part WHERE p_partkey % 10 = 6 UNION ALL SELECT p_partkey // 10, 'references', 'ORDER', '8', 1998 FROM part WHERE p_partkey % 10 = 9)
SELECT doc_id, relation, type, number, CAST(year AS INTEGER) AS year, count(*) AS mentions FROM r GROUP BY ALL""")
def relations_in_regions(spark: SparkSession, d: str) -> DataFrame:
    """Ten paragraphs a document: a legal basis from the third to the seventh, one citation demoted, one cue in a title."""
    k = F.col("p_partkey")
    cited = F.concat(F.col("p_size").cast("string"), F.lit(" of 1995"))
    forms = {2: ("Having regard to Act No. ", "."), 4: ("It amends, in the form as amended by Act No. ", "."), 6: ("Rule No. ", ". Hereby decides that Act No. 7 of 1999 stands."), 9: ("Under review: Act No. ", " concerning a bill that amends Order No. 8 of 1998.")}
    text = F.concat(F.lit("This amends Act No. "), cited, F.lit("."))
    for at, (before, after) in forms.items():
        text = F.when(k % 10 == at, F.concat(F.lit(before), cited, F.lit(after))).otherwise(text)
    rows = table(spark, d, "part").select(F.floor(k / 10).alias("doc_id"), (k % 10).cast("int").alias("seq"), text.alias("text"))
    cues = {"revokes": READING.cues["revokes"], "amends": READING.cues["amends"]}
    reading = replace(READING, cues=cues, demote=r"\bas amended by\b", title=r"\bconcerning\b", regions={"based_on": (r"\bhaving regard to\b", r"\bhereby decides\b")})
    return citing.relations(rows, reading, "doc_id", "seq", "text").select("doc_id", "relation", "type", "number", "year", "mentions")


@query("bm25_weights_left", f"SELECT * FROM ({ORACLES['bm25_doc_vectors']}) WHERE doc_id % 3 = 0")
def bm25_weights_left(spark: SparkSession, d: str) -> DataFrame:
    """Vectors of the documents that a run before left out, by the statistics of all."""
    docs = table(spark, d, "documents")
    stats = bm25.statistics(docs, "doc_id", "text")
    vocab = bm25.vocabulary(bm25.term_counts(docs, "doc_id", "text"), stats, 500)
    left = bm25.weights_left(docs, docs.where("doc_id % 3 <> 0").select(F.col("doc_id").alias("id")), vocab, stats, id_col="doc_id", text_col="text")
    return left.select(F.col("id").alias("doc_id"), "term", F.round("weight", 6).alias("weight"))
