"""Queries that read structure out of HTML, XML and sentences, and that embed by hash."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.text import estimated_tokens
from corpusloom.operators import blocks, citing, embedding, extract, signals
from corpusloom.queries.base import query, table

READING = citing.Reading(
    citation=r"\b(?P<type>act|order|rule)\s+(?:no\.?\s*)?(?P<number>\d+)\s+of\s+(?P<year>(?:19|20)\d\d)",
    pointer=r"\barticle\s+\d+",
    cues={"revokes": r"\b(?:revokes?|repeals?)\b", "amends": r"\bamends?\b", "based_on": r"\b(?:under|pursuant to)\b"},
)


@query("html_blocks")
def html_blocks(spark: SparkSession, d: str) -> DataFrame:
    return extract.html_blocks(table(spark, d, "pages"), "page_id", "html")


@query("html_heading_paths")
def html_heading_paths(spark: SparkSession, d: str) -> DataFrame:
    return blocks.heading_paths(html_blocks(spark, d)).select("doc_id", "reading_order", F.array_join("heading_path", " > ").alias("path"))


@query("table_grids")
def table_grids(spark: SparkSession, d: str) -> DataFrame:
    """Lines of pages as rows of a table with a spanning head, read back as grids."""
    pages = table(spark, d, "pages")
    rows = F.array_join(F.transform(F.split("html", "\n"), lambda x: F.concat(F.lit("<tr><td>"), F.regexp_replace(x, "<[^>]*>", " "), F.lit("</td><td rowspan=2>x</td></tr>"))), "")
    html = F.concat(F.lit("<table><tr><th colspan=3>head</th></tr>"), rows, F.lit("</table>"))
    return extract.table_grid(extract.table_cells(pages.select("page_id", html.alias("html")), "page_id", "html"))


@query("normalised_text")
def normalised_text(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", F.sha2(extract.normalised(F.col("text")), 256).alias("text_hash"))


def _instrument_texts(spark: SparkSession, d: str) -> DataFrame:
    """A sentence or two per order line that cites an act, in the shapes that the readers know."""
    verb = F.element_at(F.array(*[F.lit(v) for v in ("revokes", "amends in part", "does not amend", "under", "mentions")]), (F.col("l_partkey") % 5 + 1).cast("int"))
    text = F.concat(F.lit("This order "), verb, F.lit(" Act No. "), F.col("l_partkey").cast("string"), F.lit(" of "), (1990 + F.col("l_suppkey") % 9).cast("string"), F.lit(". See article "), F.col("l_linenumber").cast("string"), F.lit("."))
    return table(spark, d, "lineitem").select(F.col("l_orderkey").alias("doc_id"), F.col("l_linenumber").alias("seq"), text.alias("text"))


@query("references_extracted", r"""WITH t AS (SELECT l_orderkey AS doc_id, length('This order ' || ['revokes','amends in part','does not amend','under','mentions'][1 + l_partkey % 5] || ' ') AS a, 'Act No. ' || CAST(l_partkey AS VARCHAR) || ' of ' || CAST(1990 + l_suppkey % 9 AS VARCHAR) AS cite, 'article ' || CAST(l_linenumber AS VARCHAR) AS ptr FROM lineitem)
SELECT doc_id, 'regulation' AS kind, CAST(a AS INTEGER) AS start, CAST(a + length(cite) AS INTEGER) AS "end", cite AS text FROM t UNION ALL SELECT doc_id, 'internal', CAST(a + length(cite) + 6 AS INTEGER), CAST(a + length(cite) + 6 + length(ptr) AS INTEGER), ptr FROM t""")
def references_extracted(spark: SparkSession, d: str) -> DataFrame:
    return citing.references(_instrument_texts(spark, d), READING, "doc_id", "text").select("doc_id", "kind", "start", "end", "text")


@query("relations_extracted", r"""WITH t AS (SELECT l_orderkey AS doc_id, ['revokes','amends','references','based_on','references'][1 + l_partkey % 5] AS relation, l_partkey % 5 = 1 AS p, CAST(l_partkey AS VARCHAR) AS number, CAST(1990 + l_suppkey % 9 AS INTEGER) AS year FROM lineitem)
SELECT doc_id, relation, 'ACT' AS type, number, year, count(*) AS mentions, bool_and(p) AS partial FROM t GROUP BY ALL""")
def relations_extracted(spark: SparkSession, d: str) -> DataFrame:
    return citing.relations(_instrument_texts(spark, d), READING, "doc_id", "seq", "text").drop("quote", "seq", "inherited")


#: What a paragraph says, by its number modulo seven; {} stands for the instrument.
_FORMS = ("This act revokes the following:", "They are amended; this amends:", "a) {};", "(2) {} in the end;", "iv. under {} only;", "See {}.", "x) it revokes in part {}.")


@query("relations_across_paragraphs", r"""WITH i AS (SELECT l_orderkey AS doc_id, l_linenumber AS n, min(l_partkey) AS k, min(l_suppkey) AS s FROM lineitem GROUP BY 1, 2),
p AS (SELECT doc_id, n, 0 AS m, k % 7 AS f, k AS number, 1990 + k % 9 AS year, s % 11 = 0 AS skipped FROM i UNION ALL SELECT doc_id, n, 1, s % 7, s, 1990 + s % 9, s % 11 = 0 FROM i),
h AS (SELECT *, last_value(CASE WHEN skipped THEN '' WHEN f = 0 THEN 'revokes' WHEN f = 1 THEN 'amends' WHEN f = 5 THEN '' END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY n, m ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS held FROM p),
r AS (SELECT doc_id, n, m, CAST(number AS VARCHAR) AS number, CAST(year AS INTEGER) AS year, CASE f WHEN 4 THEN 'based_on' WHEN 5 THEN 'references' WHEN 6 THEN 'revokes' ELSE coalesce(nullif(held, ''), 'references') END AS relation, f = 6 AS part, f IN (2, 3) AND coalesce(held, '') <> '' AS inherited FROM h WHERE f >= 2 AND NOT skipped)
SELECT doc_id, relation, 'ACT' AS type, number, year, count(*) AS mentions, bool_and(part) AS partial, arg_min(n, n * 2 + m) AS seq, CAST(sum(CAST(inherited AS INTEGER)) AS BIGINT) AS inherited FROM r GROUP BY doc_id, relation, number, year""")
def relations_across_paragraphs(spark: SparkSession, d: str) -> DataFrame:
    """Lines of an order as chunks of two paragraphs: heads of lists, items that take their cue, and what ends a list."""
    items = table(spark, d, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_partkey").alias("k"), F.min("l_suppkey").alias("s"))

    def said(n: Column) -> Column:
        act = F.concat(F.lit("Act No. "), n.cast("string"), F.lit(" of "), (1990 + n % 9).cast("string"))
        return F.element_at(F.array(*[F.concat(*[x for k, part in enumerate(f.split("{}")) for x in ([act] * bool(k) + [F.lit(part)])]) for f in _FORMS]), (n % 7 + 1).cast("int"))

    chunks = items.select(F.col("l_orderkey").alias("doc_id"), F.col("l_linenumber").alias("seq"), F.concat(said(F.col("k")), F.lit("\n \n"), said(F.col("s"))).alias("text"), F.when(F.col("s") % 11 == 0, "ANNEX II").otherwise("I").alias("chapter"))
    reading = replace(READING, skip=("ANNEX",))
    return citing.relations(chunks, reading, "doc_id", "seq", "text", chapter_col="chapter").drop("quote")


@query("outline_designations", """WITH i AS (SELECT DISTINCT l_orderkey AS scope, l_linenumber AS seq FROM lineitem), w AS (SELECT *, max(CASE WHEN seq % 2 = 1 THEN seq END) OVER o AS last, bool_or(seq = 1) OVER o AS a, bool_or(seq IN (3, 7)) OVER (PARTITION BY scope) AS letters, bool_or(seq = 6) OVER (PARTITION BY scope) AS more, bool_or(seq IN (2, 4)) OVER o AS figure FROM i WINDOW o AS (PARTITION BY scope ORDER BY seq)),
r AS (SELECT *, last = 5 AND figure AND NOT letters AND NOT (a AND more) AS roman FROM w)
SELECT scope, seq, CASE WHEN roman THEN CASE WHEN a THEN '(a)' ELSE '' END || '(1)(c)' ELSE coalesce('(' || chr(CAST(96 + (last + 1) / 2 AS INTEGER)) || ')', '') END || CASE WHEN seq % 2 = 0 THEN '(1)' ELSE '' END AS designation FROM r""")
def outline_designations(spark: SparkSession, d: str) -> DataFrame:
    """Line items of an order as paragraphs that are numbered by letter and figure in turn.

    A (c) after a figure, with neither (b) nor (d) beside it, is the Roman numeral under that figure,
    unless (a) stands before and a figure after it, as under a letter.
    """
    rows = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("scope"), F.col("l_linenumber").alias("seq"), F.when(F.col("l_linenumber") % 2 == 1, F.format_string("(%s) text", F.chr(96 + (F.col("l_linenumber") + 1) / 2))).otherwise("(1) text").alias("text"))
    return signals.outline(rows.dropDuplicates(["scope", "seq"]))


@query("iso_dates", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS iso FROM orders")
def iso_dates(spark: SparkSession, d: str) -> DataFrame:
    """Dates written in words, read back."""
    return table(spark, d, "orders").select("o_orderkey", extract.iso_date(F.concat(F.lit("Done on "), F.date_format("o_orderdate", "MMMM d, yyyy"))).alias("iso"))


@query("latest_dates", "SELECT o_custkey, strftime(max(o_orderdate), '%Y-%m-%d') AS latest FROM orders GROUP BY 1")
def latest_dates(spark: SparkSession, d: str) -> DataFrame:
    written = table(spark, d, "orders").select("o_custkey", extract.iso_date(F.date_format("o_orderdate", "MMMM d, yyyy")).alias("iso"))
    return written.groupBy("o_custkey").agg(F.max("iso").alias("latest"))


@query("signal_lists", r"SELECT doc_id, array_to_string(list_distinct_ordered, ',') AS found FROM (SELECT doc_id, list_filter(m, lambda x, i: list_position(m, x) = i) AS list_distinct_ordered FROM (SELECT doc_id, list_concat(regexp_extract_all(text, '[0-9]{4,}'), regexp_extract_all(text, '[a-z]+@[a-z.]+')) AS m FROM documents))")
def signal_lists(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", F.array_join(signals.found(F.col("text"), ["[0-9]{4,}", "[a-z]+@[a-z.]+"]), ",").alias("found"))


@query("nearest_scope", """WITH r AS (SELECT p_size AS doc_id, p_partkey AS row_id, [p_partkey % 3, p_partkey % 5, p_partkey % 7] AS path FROM part), s AS (SELECT DISTINCT p_size AS doc_id, (p_partkey % 3) * 10 + CASE WHEN p_partkey % 2 = 0 THEN p_partkey % 5 ELSE 9 END AS scope, CASE WHEN p_partkey % 2 = 0 THEN [p_partkey % 3, p_partkey % 5] ELSE [p_partkey % 3] END AS scope_path FROM part WHERE p_partkey % 3 <> 2),
m AS (SELECT doc_id, row_id, scope, len(scope_path) AS n, path[1:len(scope_path)] = scope_path AS holds FROM r JOIN s USING (doc_id)) SELECT doc_id, row_id, coalesce(arg_max(scope, (n, -scope)) FILTER (WHERE holds), arg_min(scope, (n, scope))) AS scope FROM m GROUP BY ALL""")
def nearest_scope(spark: SparkSession, d: str) -> DataFrame:
    p, k = table(spark, d, "part"), F.col("p_partkey")
    rows = p.select(F.col("p_size").alias("doc_id"), k.alias("row_id"), F.array(k % 3, k % 5, k % 7).alias("path"))
    even = k % 2 == 0
    scopes = p.where("p_partkey % 3 <> 2").select(F.col("p_size").alias("doc_id"), ((k % 3) * 10 + F.when(even, k % 5).otherwise(9)).alias("scope"), F.when(even, F.array(k % 3, k % 5)).otherwise(F.array(k % 3)).alias("scope_path")).distinct()
    return signals.nearest_scope(rows, scopes)


@query("hash_embedding", "WITH h AS (SELECT item_id, sha256(text || '#0') || sha256(text || '#1') AS h FROM benchmark), v AS (SELECT item_id, list_transform(range(64), lambda i: (CAST('0x' || substr(h, i * 2 + 1, 2) AS INTEGER) - 127.5) / 127.5) AS v FROM h) SELECT item_id, CAST(pos AS INTEGER) AS pos, round(v[pos + 1] / sqrt(list_inner_product(v, v)), 6) AS value FROM v, range(64) r(pos)")
def hash_embedding(spark: SparkSession, d: str) -> DataFrame:
    v = embedding.hash_vector(F.col("text"), 64)
    return table(spark, d, "benchmark").select("item_id", F.posexplode(v).alias("pos", "value")).withColumn("value", F.round("value", 6))


@query("rendered_queries", "SELECT item_id, 'Instruct: find' || chr(10) || 'Query: ' || text AS prefix, '<system>find.</system><user>' || text || '</user>' AS chat FROM benchmark")
def rendered_queries(spark: SparkSession, d: str) -> DataFrame:
    t = F.col("text")
    return table(spark, d, "benchmark").select("item_id", embedding.render_query(t, "find", "prefix").alias("prefix"), embedding.render_query(t, "find", "chat").alias("chat"))


@query("token_batches", r"""WITH RECURSIVE t AS (SELECT CAST(floor(doc_id / 100) AS BIGINT) AS win, doc_id, CAST(floor(len(regexp_extract_all(text, '[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s]')) * 1.35) AS BIGINT) AS s FROM documents), o AS (SELECT *, row_number() OVER (PARTITION BY win ORDER BY s DESC, doc_id) AS i FROM t),
w AS (SELECT win, doc_id, i, 1 AS n, s AS top, 0 AS b FROM o WHERE i = 1 UNION ALL SELECT o.win, o.doc_id, o.i, CASE WHEN w.n + 1 > 16 OR (w.n + 1) * w.top > 8000 THEN 1 ELSE w.n + 1 END, CASE WHEN w.n + 1 > 16 OR (w.n + 1) * w.top > 8000 THEN o.s ELSE w.top END, CASE WHEN w.n + 1 > 16 OR (w.n + 1) * w.top > 8000 THEN w.b + 1 ELSE w.b END FROM w JOIN o ON o.win = w.win AND o.i = w.i + 1)
SELECT win, doc_id, CAST(b AS INTEGER) AS batch FROM w""")
def token_batches(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents").select(F.floor(F.col("doc_id") / 100).alias("win"), "doc_id", estimated_tokens(F.col("text")).alias("size"))
    return embedding.batches(rows, "win", "doc_id", "size", max_items=16, max_padded=8000)


@query("payload_batches", """WITH RECURSIVE o AS (SELECT doc_id % 40 AS win, doc_id, strlen(text) AS s, row_number() OVER (PARTITION BY doc_id % 40 ORDER BY doc_id) AS i FROM documents),
w AS (SELECT win, doc_id, i, 1 AS n, s AS used, s AS top, 0 AS b FROM o WHERE i = 1 UNION ALL SELECT win, doc_id, i, CASE WHEN cut THEN 1 ELSE n + 1 END, CASE WHEN cut THEN s ELSE used + s END, CASE WHEN cut THEN s ELSE greatest(top, s) END, b + CAST(cut AS INTEGER) FROM (SELECT o.*, w.n, w.used, w.top, w.b, w.n = 12 OR w.used + o.s > 12000 OR (w.n + 1) * greatest(w.top, o.s) * greatest(w.top, o.s) > 20000000 AS cut FROM w JOIN o ON o.win = w.win AND o.i = w.i + 1))
SELECT win, doc_id, CAST(b AS INTEGER) AS batch FROM w""")
def payload_batches(spark: SparkSession, d: str) -> DataFrame:
    """Texts in batches by bytes, items and items times the longest squared."""
    rows = table(spark, d, "documents").select((F.col("doc_id") % 40).alias("win"), "doc_id", "text")
    return embedding.payloads(rows, "win", "doc_id", "text", max_bytes=12_000, max_items=12, max_square=20_000_000)
