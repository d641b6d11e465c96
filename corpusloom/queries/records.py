"""Queries over tables as chunks, provenance, sparse literals, signals by scope and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.functions.text import estimated_tokens
from corpusloom.operators import bm25, records
from corpusloom.operators.graph import scratch
from corpusloom.queries import blocks as block_queries
from corpusloom.queries import structure as structure_queries
from corpusloom.queries.base import ORACLES, query, table

#: A table per customer of the first orders: a head row for even keys, a caption for every third.
TABLES = "o AS (SELECT o_custkey AS doc_id, o_orderkey, o_orderstatus, o_orderpriority, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS INTEGER) AS r FROM orders), tb AS (SELECT doc_id, CAST(count(*) + 1 AS INTEGER) AS n_rows, CAST(CASE WHEN doc_id % 2 = 0 THEN 1 ELSE 0 END AS INTEGER) AS header_rows, CASE WHEN doc_id % 3 = 0 THEN 'Orders of ' || doc_id END AS caption FROM o GROUP BY doc_id)"
GRIDS = f"""{TABLES}, ln AS (SELECT doc_id, r, '| ' || o_orderkey || ' | ' || o_orderstatus || ' \\| ' || o_orderpriority || ' |  |' AS line FROM o UNION ALL SELECT doc_id, 0, '| order | state |  |' FROM tb),
bod AS (SELECT doc_id, string_agg(line, chr(10) ORDER BY r) FILTER (WHERE r >= header_rows) AS body, string_agg(line, chr(10) ORDER BY r) FILTER (WHERE r < header_rows) AS head FROM ln JOIN tb USING (doc_id) GROUP BY doc_id),
g AS (SELECT doc_id, 't' || doc_id AS table_id, coalesce('**' || caption || '**' || chr(10), '') || coalesce(head || chr(10), '') || '| --- | --- | --- |' || chr(10) || body AS grid FROM bod JOIN tb USING (doc_id))"""


def _tables(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Cells and tables: key, state and priority of each order under a head row; the third column has no cells."""
    at = F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderkey"))
    orders = table(spark, d, "orders").select(F.col("o_custkey").alias("doc_id"), F.concat(F.lit("t"), F.col("o_custkey")).alias("table_id"), "o_orderkey", "o_orderstatus", "o_orderpriority", at.alias("r"))
    texts = F.array(F.col("o_orderkey").cast("string"), F.concat("o_orderstatus", F.lit(" | "), "o_orderpriority"))
    body = orders.select("doc_id", "table_id", "r", F.posexplode(texts).alias("c", "text"))
    size = orders.groupBy("doc_id", "table_id").agg((F.count("*") + 1).cast("int").alias("n_rows"))
    head = size.select("doc_id", "table_id", F.lit(0).alias("r"), F.posexplode(F.array(F.lit("order"), F.lit("state"))).alias("c", "text"))
    tables = size.select("doc_id", "table_id", "n_rows", F.lit(3).alias("n_cols"), (F.col("doc_id") % 2 == 0).cast("int").alias("header_rows"), F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("Orders of "), "doc_id")).alias("caption"))
    return body.unionByName(head), tables


@query("table_rendered", f"WITH {GRIDS} SELECT doc_id, table_id, grid FROM g")
def table_rendered(spark: SparkSession, d: str) -> DataFrame:
    return records.render_tables(*_tables(spark, d))


@query("table_chunks", f"WITH {GRIDS} SELECT g.doc_id, g.table_id, grid AS body, CASE WHEN caption IS NOT NULL THEN caption WHEN g.doc_id % 5 = 0 THEN 'Part > ' || g.doc_id ELSE g.table_id END AS locator, CAST(CASE WHEN g.doc_id % 5 = 0 THEN 3 END AS INTEGER) AS reading_order FROM g JOIN tb USING (doc_id)")
def table_chunks(spark: SparkSession, d: str) -> DataFrame:
    """Every fifth table is referred to by two blocks, of which the first is its anchor."""
    cells, tables = _tables(spark, d)
    refs = tables.where("doc_id % 5 = 0").select("doc_id", F.explode(F.array(F.lit(7), F.lit(3))).alias("reading_order"), F.col("table_id").alias("ref"), F.array(F.lit("Part"), F.col("doc_id").cast("string")).alias("heading_path"))
    return records.table_chunks(records.render_tables(cells, tables), tables, refs)


@query("provenance_split", "SELECT page_id, line, CASE WHEN page_id % 7 <> 0 THEN url END AS source_url, page_id % 7 = 0 AS refused FROM (SELECT page_id, url, generate_subscripts(p, 1) - 1 AS line FROM (SELECT page_id, url, string_split(html, chr(10)) AS p FROM pages))")
def provenance_split(spark: SparkSession, d: str) -> DataFrame:
    """Lines of pages as chunks; the address of every seventh page is blank, and its chunks are set aside."""
    pages = table(spark, d, "pages")
    chunks = pages.select("page_id", F.posexplode(F.split("html", "\n")).alias("line", "text")).select("page_id", F.col("line").cast("long").alias("line"))
    known, refused = records.with_provenance(chunks, pages.withColumn("url", F.when(F.col("page_id") % 7 == 0, " ").otherwise(F.col("url"))), "page_id", "url")
    return known.withColumn("refused", F.lit(False)).unionByName(refused.withColumn("refused", F.lit(True)).withColumn("source_url", F.lit(None).cast("string")))


@query("chunk_identifiers", "SELECT p_partkey, CASE WHEN p_partkey % 4 <> 0 THEN p_brand || CASE WHEN p_partkey % 3 <> 0 THEN ', art. ' || p_size ELSE '' END END AS identifier, CASE WHEN p_partkey % 4 <> 0 THEN p_brand || ' (' || p_size || ')' END AS markup, regexp_extract(p_type, '^([A-Z]+ )', 1) AS m, trim(regexp_replace(p_type, '^[A-Z]+ ', '')) AS rest FROM part")
def chunk_identifiers(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("p_partkey")
    citation = F.when(k % 4 != 0, F.col("p_brand"))
    locator = F.when(k % 3 != 0, F.concat(F.lit("art. "), "p_size")).otherwise("")
    marker, rest = records.split_marker(F.col("p_type"), "[A-Z]+ ")
    return table(spark, d, "part").select("p_partkey", records.identifier(citation, locator).alias("identifier"), records.filled([citation, " (", F.col("p_size"), ")"]).alias("markup"), F.coalesce(F.concat(marker, F.lit(" ")), F.lit("")).alias("m"), rest.alias("rest"))


@query("sparse_literals")
def sparse_literals(spark: SparkSession, d: str) -> DataFrame:
    """The sparse vectors of documents over the vocabulary's 500 terms as literals."""
    docs = table(spark, d, "documents")
    stats = scratch(bm25.statistics(docs, "doc_id", "text"), "stats")
    # One fit, written once and small; then only its terms are counted.
    vocab = F.broadcast(scratch(bm25.vocabulary(bm25.term_counts(docs, "doc_id", "text"), stats, 500), "vocab"))
    return records.sparse_literal(bm25.weights(bm25.term_counts(docs, "doc_id", "text", only=vocab), vocab, stats), vocab, 500)


@query("gathered_blocks", "WITH f AS (SELECT conv_id, trim(text) AS t, min(turn) AS o FROM conversations WHERE role = 'user' AND trim(text) <> '' GROUP BY ALL) SELECT conv_id, count(*) AS texts, string_agg(t, chr(10) ORDER BY o, t) AS joined FROM f GROUP BY conv_id")
def gathered_blocks(spark: SparkSession, d: str) -> DataFrame:
    return records.gathered(table(spark, d, "conversations").where("role = 'user'"), "conv_id", "turn", "text")


TERMS = r"list_filter(m, lambda x, i: list_position(m, x) = i) AS terms FROM (SELECT doc_id, text, regexp_extract_all(text, '([A-Z][a-z]{3,}) (?:is|was|the|de|la|und)', 1) AS m FROM documents)"


@query("defined_terms", f"SELECT doc_id, array_to_string(terms, ',') AS terms, array_to_string(list_filter(terms, lambda x: length(x) % 2 = 0), ',') AS emphasised FROM (SELECT doc_id, {TERMS})")
def defined_terms(spark: SparkSession, d: str) -> DataFrame:
    pattern = "([A-Z][a-z]{3,}) (?:is|was|the|de|la|und)"
    even = F.filter(F.regexp_extract_all("text", F.lit(pattern), F.lit(1)), lambda x: F.length(x) % 2 == 0)
    return table(spark, d, "documents").select("doc_id", F.array_join(records.defined_terms(F.col("text"), pattern), ",").alias("terms"), F.array_join(records.defined_terms(F.col("text"), pattern, even), ",").alias("emphasised"))


@query("signal_presence", f"""SELECT 'terms' AS "column", count(*) FILTER (WHERE len(terms) > 0) AS present FROM (SELECT doc_id, {TERMS}) UNION ALL SELECT 'lang', count(*) FILTER (WHERE length(lang) > 0) FROM documents""")
def signal_presence(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents").select("lang", records.defined_terms(F.col("text"), "([A-Z][a-z]{3,}) (?:is|was|the|de|la|und)").alias("terms"))
    return records.presence(rows, ["terms", "lang"])


LINE = "l AS (SELECT doc_id % 16 AS grp, t, CAST(floor(len(regexp_extract_all(t, '[\\p{L}\\p{N}_]+|[^\\p{L}\\p{N}_\\s]')) * 1.35) AS BIGINT) AS n FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS t FROM documents))"


@query("chunk_report", f"WITH {LINE}, q AS (SELECT grp, list_sort(list(n)) AS ns, count(*) AS c, count(DISTINCT t) AS u FROM l WHERE trim(t, ' ') <> '' GROUP BY 1), a AS (SELECT grp, count(*) AS chunks FROM l GROUP BY 1) SELECT a.grp, chunks, chunks - coalesce(c, 0) AS empty, coalesce(c - u, 0) AS repeated, ns[len(ns) // 2 + 1] AS median_tokens FROM a LEFT JOIN q ON q.grp = a.grp")
def chunk_report(spark: SparkSession, d: str) -> DataFrame:
    """Lines as chunks, reported by groups of documents."""
    rows = table(spark, d, "documents").select("doc_id", F.explode(F.split("text", "\n")).alias("t")).withColumn("n", estimated_tokens(F.col("t")))
    return records.chunk_report(rows, [(F.col("doc_id") % 16).alias("grp")], "n", "t")


@query("index_alignment", "WITH c AS (SELECT doc_id AS key, count(*) AS c FROM documents WHERE doc_id % 5 <> 0 GROUP BY 1), v AS (SELECT vec_id - vec_id % 2 AS key, count(*) AS v FROM embeddings GROUP BY 1) SELECT key, CASE WHEN v IS NULL THEN 'no vector' WHEN c IS NULL THEN 'no chunk' ELSE 'repeated' END AS problem FROM c FULL JOIN v USING (key) WHERE v IS NULL OR c IS NULL OR c > 1 OR v > 1")
def index_alignment(spark: SparkSession, d: str) -> DataFrame:
    vectors = table(spark, d, "embeddings").select((F.col("vec_id") - F.col("vec_id") % 2).alias("vec_id"))
    return records.alignment(table(spark, d, "documents").where("doc_id % 5 <> 0"), vectors, "doc_id", "vec_id")


@query("relabel_reproduced", "WITH c AS (SELECT vec_id, list_cosine_similarity(CAST(embedding AS DOUBLE[]), list_transform(CAST(embedding AS DOUBLE[]), lambda x: round(x, 2))) AS c FROM embeddings WHERE vec_id % 53 = 0) SELECT count(*) AS compared, round(min(c), 5) AS worst, round(avg(c), 5) AS mean, arg_min(vec_id, (round(c, 9), vec_id)) AS worst_key, min(c) >= 0.999 AS same FROM c")
def relabel_reproduced(spark: SparkSession, d: str) -> DataFrame:
    """A sample of vectors against a coarser copy of them, as one backend against another."""
    old = table(spark, d, "embeddings").where("vec_id % 53 = 0")
    coarse = old.select("vec_id", F.transform(F.col("embedding").cast("array<double>"), lambda x: F.round(x, 2)).alias("embedding"))
    return records.reproduced(old, coarse, "vec_id", 0.999)


@query("repaired_text", r"SELECT doc_id, sha256(regexp_replace(nfc_normalize(replace(text, 'e', 'e' || chr(769)) || chr(7)), '[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]', '', 'g')) AS text_hash FROM documents")
def repaired_text(spark: SparkSession, d: str) -> DataFrame:
    """Texts with letters taken apart and a control character put in, composed and cleaned again."""
    broken = F.concat(F.replace("text", F.lit("e"), F.lit("é")), F.lit("\x07"))
    return table(spark, d, "documents").select("doc_id", F.sha2(records.repaired(broken), 256).alias("text_hash"))


@query("lexicon_load", "SELECT DISTINCT lower(p_brand) AS word FROM part WHERE p_partkey % 3 <> 0")
def lexicon_load(spark: SparkSession, d: str) -> DataFrame:
    """Brands as a word list with both kinds of line ends, comments and blank lines."""
    k = F.col("p_partkey") % 3
    line = F.when(k == 0, F.concat(F.lit("# "), "p_brand")).when(k == 1, F.concat("p_brand", F.lit("\r"))).otherwise(F.concat(F.lit(" "), "p_brand", F.lit("\n")))
    return records.lexicon_words(table(spark, d, "part").select(F.explode(F.array(line, F.lit(""))).alias("line")), "line")


#: Every rule with its severity and the query that finds what breaks it.
RULES = {"reading_order": "error", "round_trip": "error", "heading_path": "error", "invariants": "error", "repeated_ids": "error", "table_refs": "error", "text_ratio": "warning"}


def _breaking(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    """What breaks each rule: blocks of documents, and orders whose lines stand for blocks with ids and references."""
    return {
        "reading_order": block_queries.reading_order_issues(spark, d), "round_trip": block_queries.round_trip_issues(spark, d), "heading_path": block_queries.heading_path_issues(spark, d),
        "invariants": structure_queries.block_invariants(spark, d), "repeated_ids": structure_queries.repeated_block_ids(spark, d).withColumnRenamed("l_orderkey", "doc_id"),
        "table_refs": structure_queries.table_ref_issues(spark, d), "text_ratio": block_queries.text_ratio(spark, d).where("NOT ok"),
    }


def _issue_sql(rule: str, rows: str, where: str = "", doc: str = "doc_id") -> str:
    return f"SELECT CAST({doc} AS BIGINT) AS doc_id, '{rule}' AS rule, '{RULES[rule]}' AS severity, count(*) AS issues FROM ({ORACLES[rows]}) {where} GROUP BY 1"


@query("all_issues", " UNION ALL ".join([_issue_sql("reading_order", "reading_order_issues"), _issue_sql("round_trip", "round_trip_issues"), _issue_sql("heading_path", "heading_path_issues"), _issue_sql("invariants", "block_invariants"), _issue_sql("repeated_ids", "repeated_block_ids", doc="l_orderkey"), _issue_sql("table_refs", "table_ref_issues"), _issue_sql("text_ratio", "text_ratio", "WHERE NOT ok")]))
def all_issues(spark: SparkSession, d: str) -> DataFrame:
    return records.all_issues({rule: (RULES[rule], rows) for rule, rows in _breaking(spark, d).items()})


@query("valid_documents", f"SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM ({ORACLES['all_issues']}) WHERE severity = 'error')")
def valid_documents(spark: SparkSession, d: str) -> DataFrame:
    return records.valid_documents(table(spark, d, "documents"), all_issues(spark, d)).select("doc_id")


@query("shard_filter", "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')")
def shard_filter(spark: SparkSession, d: str) -> DataFrame:
    keys = table(spark, d, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("l_orderkey"))
    return records.keep_keys(table(spark, d, "lineitem"), keys, "l_orderkey").select("l_orderkey", "l_linenumber")
