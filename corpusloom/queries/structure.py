"""Queries over units, labels, typography, listings and facts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.operators import blocks as bl
from corpusloom.operators import chunking, factors, kmeans, mirror, relations, unit_chunks, units
from corpusloom.queries.base import query, table
from corpusloom.queries.blocks import BLOCKS, PATHS, _blocks, _marked


@query("unit_segments", f"""WITH RECURSIVE {BLOCKS}, hd AS (SELECT doc_id, reading_order, level, row_number() OVER (PARTITION BY doc_id ORDER BY reading_order) AS i FROM blocks WHERE type = 'heading'),
w AS (SELECT doc_id, reading_order, i, level AS cur, 1 AS n FROM hd WHERE i = 1 UNION ALL SELECT hd.doc_id, hd.reading_order, hd.i, CASE WHEN hd.level = 2 OR hd.level <= w.cur THEN hd.level ELSE w.cur END, CASE WHEN hd.level = 2 OR hd.level <= w.cur THEN w.n + 1 ELSE w.n END FROM w JOIN hd ON hd.doc_id = w.doc_id AND hd.i = w.i + 1)
SELECT b.doc_id, b.reading_order, CAST(coalesce(max(w.n) OVER (PARTITION BY b.doc_id ORDER BY b.reading_order ROWS UNBOUNDED PRECEDING), 0) AS INTEGER) AS segment FROM blocks b LEFT JOIN w ON w.doc_id = b.doc_id AND w.reading_order = b.reading_order""")
def unit_segments(spark: SparkSession, d: str) -> DataFrame:
    return units.segments(_blocks(spark, d), (2,)).select("doc_id", "reading_order", "segment")


@query("labels_in_force", f"""WITH {BLOCKS}, h AS (SELECT *, max(CASE WHEN level = 1 THEN reading_order END) OVER w AS a, max(CASE WHEN level = 2 THEN reading_order END) OVER w AS b, max(CASE WHEN level = 3 THEN reading_order END) OVER w AS c FROM blocks WINDOW w AS (PARTITION BY doc_id ORDER BY reading_order ROWS UNBOUNDED PRECEDING))
SELECT h.doc_id, h.reading_order, x.text AS region, CASE WHEN b > coalesce(a, -1) THEN y.text ELSE 'N/A' END AS chapter, CASE WHEN c > coalesce(a, -1) THEN z.text END AS article FROM h LEFT JOIN blocks x ON x.doc_id = h.doc_id AND x.reading_order = a LEFT JOIN blocks y ON y.doc_id = h.doc_id AND y.reading_order = b LEFT JOIN blocks z ON z.doc_id = h.doc_id AND z.reading_order = c""")
def labels_in_force(spark: SparkSession, d: str) -> DataFrame:
    return units.labels_in_force(_blocks(spark, d)).select("doc_id", "reading_order", "region", "chapter", "article")


@query("markup_segments", f"WITH {PATHS}, s AS (SELECT doc_id, reading_order, CASE WHEN path IS DISTINCT FROM lag(path) OVER w OR row_number() OVER w = 1 THEN 1 ELSE 0 END AS n FROM p WINDOW w AS (PARTITION BY doc_id ORDER BY reading_order)) SELECT doc_id, reading_order, CAST(sum(n) OVER (PARTITION BY doc_id ORDER BY reading_order ROWS UNBOUNDED PRECEDING) AS BIGINT) AS segment FROM s")
def markup_segments(spark: SparkSession, d: str) -> DataFrame:
    return units.path_segments(bl.heading_paths(_blocks(spark, d))).select("doc_id", "reading_order", "segment")


@query("orphan_headings", f"""WITH {PATHS}, f AS (SELECT *, lead(type) OVER (PARTITION BY doc_id ORDER BY reading_order) AS nx FROM p), held AS (SELECT DISTINCT doc_id, regexp_replace(lower(h), '[^\\p{{L}}\\p{{N}}]+', '', 'g') AS head FROM (SELECT doc_id, unnest(string_split(path, ' > ')) AS h FROM p WHERE type <> 'heading' AND path <> ''))
SELECT doc_id, reading_order, text FROM f WHERE type = 'heading' AND (nx = 'heading' OR nx IS NULL) AND NOT EXISTS (SELECT 1 FROM held WHERE held.doc_id = f.doc_id AND held.head = regexp_replace(lower(f.text), '[^\\p{{L}}\\p{{N}}]+', '', 'g'))""")
def orphan_headings(spark: SparkSession, d: str) -> DataFrame:
    return units.orphan_headings(bl.heading_paths(_blocks(spark, d)))


@query("marker_chains")
def marker_chains(spark: SparkSession, d: str) -> DataFrame:
    return units.marker_chains(bl.lines(_marked(spark, d), "doc_id", "text"))


TYPE = """ln AS (SELECT doc_id, CAST(floor((line) / 5) AS BIGINT) AS page, line, t AS text, round_even((10 + (length(t) % 3) * 1.3) * 2, 0) / 2 AS size, length(t) % 11 = 0 AS bold, CASE WHEN line % 5 = 0 THEN 'header' WHEN line % 5 = 4 THEN 'footer' ELSE 'body' END AS band FROM (SELECT doc_id, generate_subscripts(p, 1) - 1 AS line, unnest(p) AS t FROM (SELECT doc_id, list_transform(string_split(text, chr(10)), lambda x, i: CASE WHEN (i - 1) % 5 = 0 THEN left(string_split(text, chr(10))[1], 30) ELSE x END) AS p FROM documents)))"""


@query("line_roles", f"""WITH {TYPE}, cm AS (SELECT doc_id, size, sum(length(text)) AS n FROM ln GROUP BY ALL), bd AS (SELECT doc_id, arg_max(size, (n, -size)) AS body FROM cm GROUP BY 1), pg AS (SELECT doc_id, count(DISTINCT page) AS pages FROM ln GROUP BY 1),
rn AS (SELECT doc_id, band, text FROM ln JOIN pg USING (doc_id) WHERE band <> 'body' GROUP BY doc_id, band, text HAVING any_value(pages) >= 3 AND count(DISTINCT page) >= any_value(pages) * 0.5),
rl AS (SELECT ln.*, CASE WHEN rn.text IS NOT NULL THEN 'page_' || ln.band WHEN size / body > 1.12 OR (bold AND length(ln.text) <= 120) THEN 'heading' ELSE 'paragraph' END AS role FROM ln JOIN bd USING (doc_id) LEFT JOIN rn ON rn.doc_id = ln.doc_id AND rn.band = ln.band AND rn.text = ln.text)
SELECT doc_id, page, CAST(line AS INTEGER) AS line, role, CAST(CASE WHEN role = 'heading' THEN least(dense_rank() OVER (PARTITION BY doc_id, role ORDER BY size DESC), 9) END AS INTEGER) AS level FROM rl""")
def line_roles(spark: SparkSession, d: str) -> DataFrame:
    """Document lines as lines of pages: five to a page, with sizes by length and a head that recurs."""
    rows = table(spark, d, "documents").select("doc_id", F.substring(F.split("text", "\n")[0], 1, 30).alias("head"), F.posexplode(F.split("text", "\n")).alias("line", "raw"))
    text = F.when(F.col("line") % 5 == 0, F.col("head")).otherwise(F.col("raw"))
    rows = rows.withColumn("text", text)
    band = F.when(F.col("line") % 5 == 0, "header").when(F.col("line") % 5 == 4, "footer").otherwise("body")
    lines = rows.select("doc_id", F.floor(F.col("line") / 5).alias("page"), "line", "text", (10 + (F.length("text") % 3) * 1.3).alias("size"), (F.length("text") % 11 == 0).alias("bold"), band.alias("band"))
    return units.line_roles(lines)


@query("centred_lines", "SELECT p_partkey, abs((p_size + p_retailprice / 2) / 2 - p_retailprice / 4) <= p_retailprice / 2 * 0.08 AS centred FROM part")
def centred_lines(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select("p_partkey", units.centred(F.col("p_size"), F.col("p_retailprice") / 2, F.col("p_retailprice") / 2).alias("centred"))


@query("fetch_states", "WITH w AS (SELECT url AS rel, length(html) AS size FROM pages WHERE page_id % 5 <> 0), g AS (SELECT url AS rel, length(html) + CASE WHEN page_id % 7 = 0 THEN 1 ELSE 0 END AS size FROM pages WHERE page_id % 4 <> 0) SELECT coalesce(w.rel, g.rel) AS rel, CASE WHEN w.rel IS NULL THEN 'unwanted' WHEN g.rel IS NULL THEN 'missing' WHEN w.size = g.size THEN 'present' ELSE 'conflict' END AS state FROM w FULL JOIN g ON w.rel = g.rel")
def fetch_states(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "pages")
    wanted = p.where("page_id % 5 <> 0").select(F.col("url").alias("rel"), F.length("html").alias("size"))
    present = p.where("page_id % 4 <> 0").select(F.col("url").alias("rel"), (F.length("html") + (F.col("page_id") % 7 == 0).cast("int")).alias("size"))
    return mirror.fetch_states(wanted, present)


@query("mirror_push", "WITH g AS (SELECT url AS rel, length(html) + CASE WHEN page_id % 7 = 0 THEN 1 ELSE 0 END AS size FROM pages WHERE page_id % 4 <> 0) SELECT url AS rel, CAST(length(html) AS INTEGER) AS size FROM pages p WHERE NOT EXISTS (SELECT 1 FROM g WHERE g.rel = p.url AND g.size = length(p.html))")
def mirror_push(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "pages")
    target = p.where("page_id % 4 <> 0").select(F.col("url").alias("rel"), (F.length("html") + (F.col("page_id") % 7 == 0).cast("int")).alias("size"))
    return mirror.to_copy(p.select(F.col("url").alias("rel"), F.length("html").alias("size")), target)


@query("dataset_export", "SELECT doc_id, source, length(text) AS chars, CASE WHEN length(text) > 1000 THEN 'long' ELSE 'short' END AS size FROM documents")
def dataset_export(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    signals = docs.select("doc_id", F.length("text").cast("long").alias("chars"), F.when(F.length("text") > 1000, "long").otherwise("short").alias("size"))
    return mirror.export(docs.select("doc_id", "source"), signals, "doc_id")


@query("table_ref_issues", "WITH b AS (SELECT l_orderkey AS doc_id, CAST(l_partkey % 4 AS VARCHAR) AS ref, count(*) AS n FROM lineitem GROUP BY ALL), t AS (SELECT DISTINCT o_orderkey AS doc_id, CAST(k AS VARCHAR) AS ref FROM orders, range(3) r(k)) SELECT coalesce(b.doc_id, t.doc_id) AS doc_id, coalesce(b.ref, t.ref) AS ref, CASE WHEN t.ref IS NULL THEN 'dangling' WHEN b.ref IS NULL THEN 'orphan' ELSE 'multiple' END AS rule FROM b FULL JOIN t ON b.doc_id = t.doc_id AND b.ref = t.ref WHERE t.ref IS NULL OR b.ref IS NULL OR n > 1")
def table_ref_issues(spark: SparkSession, d: str) -> DataFrame:
    blocks = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("doc_id"), (F.col("l_partkey") % 4).cast("string").alias("ref"))
    tables = table(spark, d, "orders").select(F.col("o_orderkey").alias("doc_id"), F.explode(F.array(*[F.lit(str(k)) for k in range(3)])).alias("table_id"))
    return mirror.reference_issues(blocks, tables)


@query("block_invariants", f"WITH {BLOCKS} SELECT doc_id, reading_order, 'level' AS rule FROM blocks WHERE reading_order % 17 = 3 AND type = 'heading' UNION ALL SELECT doc_id, reading_order, 'blank line' FROM blocks WHERE reading_order % 19 = 5")
def block_invariants(spark: SparkSession, d: str) -> DataFrame:
    """Levels and blank lines are put out of order in some blocks, which the rules must find."""
    b = _blocks(spark, d).withColumn("ref", F.lit(None).cast("string"))
    b = b.withColumn("level", F.when((F.col("reading_order") % 17 == 3) & (F.col("type") == "heading"), None).otherwise(F.col("level")))
    return mirror.invariant_issues(b.withColumn("text", F.when(F.col("reading_order") % 19 == 5, F.concat("text", F.lit("\n\nx"))).otherwise(F.col("text"))))


@query("repeated_block_ids", "SELECT l_orderkey, l_linenumber, count(*) AS count FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def repeated_block_ids(spark: SparkSession, d: str) -> DataFrame:
    key = F.struct("l_orderkey", "l_linenumber")
    return bl.repeated_ids(table(spark, d, "lineitem").select(key.alias("k")), "k").select("k.l_orderkey", "k.l_linenumber", "count")


@query("factor_json", "SELECT p_partkey, CASE WHEN p_size > 25 THEN '{\"authority\":' || CAST(p_size / 100.0 AS DOUBLE) || ',\"topical\":1.0}' ELSE '{\"topical\":1.0}' END AS factors FROM part")
def factor_json(spark: SparkSession, d: str) -> DataFrame:
    """Factors as JSON: those that are unknown are left out."""
    f = F.struct(F.when(F.col("p_size") > 25, factors.authority(F.col("p_size"), 100)).alias("authority"), factors.topical(F.col("p_name")).alias("topical"))
    return table(spark, d, "part").select("p_partkey", F.to_json(f).alias("factors"))


@query("document_types", "SELECT p_partkey, CASE WHEN contains(upper(p_type), 'ECONOMY STEEL') THEN 'ECONOMY STEEL' WHEN contains(upper(p_type), 'STANDARD') THEN 'STANDARD' WHEN contains(upper(p_type), 'ECONOMY') THEN 'ECONOMY' WHEN contains(upper(p_type), 'STEEL') THEN 'STEEL' END AS document_type FROM part")
def document_types(spark: SparkSession, d: str) -> DataFrame:
    """The longest of the known types that a title contains."""
    names = sorted(("STEEL", "ECONOMY", "STANDARD", "ECONOMY STEEL"), key=lambda n: (-len(n), n))
    title = F.upper("p_type")
    return table(spark, d, "part").select("p_partkey", F.coalesce(*[F.when(F.contains(title, F.lit(n)), n) for n in names]).alias("document_type"))


@query("short_citations", "SELECT o_orderkey, left(o_orderpriority, 1) || ' ' || CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_custkey AS VARCHAR) || '/' || CAST(year(o_orderdate) AS VARCHAR) ELSE CAST(o_custkey AS VARCHAR) || '/' || CAST(year(o_orderdate) AS VARCHAR) END AS citation FROM orders")
def short_citations(spark: SparkSession, d: str) -> DataFrame:
    """Type, number and year; a number that ends in its year is not given it again."""
    year = F.year("o_orderdate").cast("string")
    number = F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.col("o_custkey").cast("string"), F.lit("/"), year)).otherwise(F.col("o_custkey").cast("string"))
    cited = F.when(number.endswith(F.concat(F.lit("/"), year)), number).otherwise(F.concat(number, F.lit("/"), year))
    return table(spark, d, "orders").select("o_orderkey", F.concat(F.left("o_orderpriority", F.lit(1)), F.lit(" "), cited).alias("citation"))


@query("stated_facts", "SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS number, CAST(year(o_orderdate) AS INTEGER) AS year, strftime(o_orderdate, '%Y-%m-%d') AS date FROM orders")
def stated_facts(spark: SparkSession, d: str) -> DataFrame:
    """Number, year and date read back from an order's title in words."""
    from corpusloom.operators.extract import iso_date

    title = F.concat(F.lit("ORDER NUMBER "), F.col("o_custkey").cast("string"), F.lit(" OF "), F.year("o_orderdate").cast("string"), F.lit(" enacted on "), F.date_format("o_orderdate", "MMMM d, yyyy"))
    pattern = r"NUMBER\s+(\S+)\s+OF\s+(\d{4})"
    return table(spark, d, "orders").select("o_orderkey", title.alias("t")).select("o_orderkey", relations.number(F.regexp_extract("t", pattern, 1)).alias("number"), F.regexp_extract("t", pattern, 2).cast("int").alias("year"), iso_date(F.col("t")).alias("date"))


@query("boilerplate_filter", r"SELECT doc_id, count(*) AS lines, count(*) FILTER (WHERE regexp_matches(t, '^(?:Licensed|Released|This )')) AS boilerplate FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS t FROM documents) GROUP BY 1")
def boilerplate_filter(spark: SparkSession, d: str) -> DataFrame:
    lines = bl.lines(table(spark, d, "documents"), "doc_id", "text")
    return lines.groupBy("doc_id").agg(F.count("*").alias("lines"), F.count_if(F.col("text").rlike("^(?:Licensed|Released|This )")).alias("boilerplate"))


@query("chunk_overlap", "SELECT doc_id, array_to_string(list_transform(list_filter(list_zip(s, range(len(s))), lambda x: list_sum(s[x[2] + 1:]) <= 60 AND len(list_filter(range(x[2], len(s)), lambda j: list_sum(s[j + 1:]) > 60)) = 0), lambda x: x[1]), ',') AS carried FROM (SELECT doc_id, list_transform(string_split(text, chr(10)), lambda t: length(t)) AS s FROM documents)")
def chunk_overlap(spark: SparkSession, d: str) -> DataFrame:
    """Lengths of the trailing lines that fit sixty characters together."""
    costs = F.transform(F.split("text", "\n"), lambda t: F.struct(F.length(t).alias("cost")))
    return table(spark, d, "documents").select("doc_id", F.array_join(F.transform(chunking.overlap(costs, 60), lambda x: x["cost"].cast("string")), ",").alias("carried"))


@query("suggested_clusters", "SELECT lang, count(*) AS rows, CAST(greatest(1, round_even(count(*) / 100.0, 0)) AS BIGINT) AS k FROM documents GROUP BY lang")
def suggested_clusters(spark: SparkSession, d: str) -> DataFrame:
    """How many clusters a language's documents call for, at a hundred to a cluster."""
    n = table(spark, d, "documents").groupBy("lang").agg(F.count("*").alias("rows"))
    return n.withColumn("k", F.greatest(F.lit(1), F.bround(F.col("rows") / 100.0, 0)).cast("long"))


@query("query_set_merge", "SELECT item_id, count(*) AS copies FROM (SELECT item_id FROM benchmark UNION ALL SELECT item_id FROM benchmark WHERE item_id % 3 = 0) GROUP BY 1 HAVING count(*) > 1")
def query_set_merge(spark: SparkSession, d: str) -> DataFrame:
    """Ids that two query sets share, for which a merge is refused."""
    b = table(spark, d, "benchmark").select("item_id")
    return b.unionByName(b.where("item_id % 3 = 0")).groupBy("item_id").agg(F.count("*").alias("copies")).where("copies > 1")


@query("cluster_sample")
def cluster_sample(spark: SparkSession, d: str) -> DataFrame:
    """The rows that a fit of two clusters learns from: the first by a hash, the same on every run."""
    e = table(spark, d, "embeddings")
    n = kmeans.SAMPLE_PER_CLUSTER * 2
    return e.select(F.xxhash64(F.lit(42), "vec_id").alias("h"), "vec_id").orderBy("h", "vec_id").limit(n).select("vec_id")


@query("sequence_gaps", "WITH s AS (SELECT l_orderkey, l_linenumber, lag(l_linenumber) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS p FROM lineitem) SELECT l_orderkey, count(*) AS n, count(*) FILTER (WHERE l_linenumber = p) AS repeats, count(*) FILTER (WHERE l_linenumber > p + 1) AS gaps, min(l_linenumber) = 1 AND count(*) FILTER (WHERE p IS NOT NULL AND l_linenumber <> p + 1) = 0 AS clean FROM s GROUP BY 1")
def sequence_gaps(spark: SparkSession, d: str) -> DataFrame:
    """Gaps and repeats in numbered items, and whether they run from one without either."""
    before = F.lag("l_linenumber").over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey"))
    s = table(spark, d, "lineitem").withColumn("p", before)
    n = F.col("l_linenumber")
    return s.groupBy("l_orderkey").agg(F.count("*").alias("n"), F.count_if(n == F.col("p")).alias("repeats"), F.count_if(n > F.col("p") + 1).alias("gaps"), ((F.min(n) == 1) & (F.count_if(F.col("p").isNotNull() & (n != F.col("p") + 1)) == 0)).alias("clean"))


#: What a line of an order is, by its part modulo six: a heading, a marker of one of two kinds, or more text.
UNITS = unit_chunks.Chunking(split_on=("article",), min_tokens=24, max_tokens=10_000, lead=16)


def _unit_blocks(spark: SparkSession, d: str) -> DataFrame:
    items = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("doc_id"), F.col("l_linenumber").cast("int").alias("reading_order")).agg(F.min("l_partkey").alias("k"), F.min("l_suppkey").alias("s"))
    n, words = F.col("reading_order").cast("string"), F.repeat(F.lit(" word"), (F.col("s") % 30).cast("int"))
    kind = F.col("k") % 6
    text = F.when(kind == 0, F.concat(F.lit("Article "), n)).when(kind == 1, F.concat(F.lit("("), n, F.lit(") said"), words)).when(kind == 2, F.concat(F.chr(96 + F.col("reading_order")), F.lit(". said"), words)).otherwise(F.concat(F.lit("so"), words))
    return items.select("doc_id", "reading_order", F.when(kind == 0, "heading").otherwise("paragraph").alias("type"), F.when(kind == 0, 2).alias("level"), F.when(kind == 0, "article").alias("unit"), text.alias("text"), F.col("k").cast("int").alias("page"), F.concat(F.lit("Act "), F.col("doc_id").cast("string")).alias("citation"))


UNIT_SQL = r"""i AS (SELECT l_orderkey AS doc_id, l_linenumber AS n, min(l_partkey) AS k, min(l_suppkey) AS s FROM lineitem GROUP BY 1, 2),
b AS (SELECT doc_id, n, k, k % 6 AS f, CASE k % 6 WHEN 0 THEN 'Article ' || n WHEN 1 THEN '(' || n || ') said' || repeat(' word', CAST(s % 30 AS INTEGER)) WHEN 2 THEN chr(CAST(96 + n AS INTEGER)) || '. said' || repeat(' word', CAST(s % 30 AS INTEGER)) ELSE 'so' || repeat(' word', CAST(s % 30 AS INTEGER)) END AS text, CASE k % 6 WHEN 1 THEN 4 WHEN 2 THEN 3 ELSE 1 END + s % 30 AS w FROM i),
g AS (SELECT *, count(*) FILTER (WHERE f = 0) OVER o AS seg, max(CASE WHEN f = 0 THEN n END) OVER o AS head FROM b WINDOW o AS (PARTITION BY doc_id ORDER BY n)),
m AS (SELECT *, count(*) FILTER (WHERE f IN (1, 2)) OVER o AS grp, max(CASE WHEN f = 1 THEN n END) OVER o AS num, max(CASE WHEN f = 2 THEN n END) OVER o AS let, min(CASE WHEN f = 1 THEN n END) OVER o AS num1, min(CASE WHEN f = 2 THEN n END) OVER o AS let1 FROM g WINDOW o AS (PARTITION BY doc_id, seg ORDER BY n)),
c AS (SELECT *, CASE WHEN num IS NULL AND let IS NULL THEN '' WHEN let IS NULL THEN 'number ' || num WHEN num IS NULL THEN 'letter ' || chr(CAST(96 + let AS INTEGER)) WHEN num1 < let1 THEN 'number ' || num || CASE WHEN let > num THEN ' letter ' || chr(CAST(96 + let AS INTEGER)) ELSE '' END ELSE 'letter ' || chr(CAST(96 + let AS INTEGER)) || CASE WHEN num > let THEN ' number ' || num ELSE '' END END AS marker FROM m WHERE f <> 0),
z AS (SELECT doc_id, seg, grp, min(head) AS head, min(marker) AS marker, sum(w) AS w, string_agg(text, chr(10) || chr(10) ORDER BY n) AS body, min(n) AS first_n, min(k) AS page, list(n ORDER BY n) AS ids FROM c GROUP BY 1, 2, 3),
y AS (SELECT *, count(*) OVER s > 1 AND first(marker) OVER o = '' AND floor(first(w) OVER o * 1.35) <= 16 AS led, first(w) OVER o AS lw, first(body) OVER o AS lbody, first(ids) OVER o AS lids FROM z WINDOW s AS (PARTITION BY doc_id, seg), o AS (PARTITION BY doc_id, seg ORDER BY grp)),
x AS (SELECT *, CAST(floor((w + CASE WHEN led THEN lw ELSE 0 END) * 1.35) >= 24 AS INTEGER) AS enough FROM y WHERE NOT (led AND marker = '')),
v AS (SELECT *, least(coalesce(sum(enough) OVER (PARTITION BY doc_id, seg ORDER BY grp ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0), greatest(sum(enough) OVER (PARTITION BY doc_id, seg) - 1, 0)) AS plan FROM x),
u AS (SELECT doc_id, seg, plan, min(first_n) AS first_n, min(head) AS head, arg_min(marker, grp) AS marker, count(*) AS merged, bool_or(led) AS led, min(lbody) AS lbody, min(lids) AS lids, string_agg(body, chr(10) || chr(10) ORDER BY grp) AS body, flatten(list(ids ORDER BY grp)) AS ids, min(page) AS page FROM v GROUP BY 1, 2, 3),
t AS (SELECT *, array_to_string(list_filter([CASE WHEN head IS NOT NULL THEN 'Article ' || head END, nullif(marker, '')], lambda x: x IS NOT NULL), ' ') AS locator FROM u)"""


@query("unit_chunks", f"""WITH {UNIT_SQL} SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY first_n) - 1 AS INTEGER) AS seq, locator, trim('Act ' || doc_id || ' ' || locator) AS identifier, CASE WHEN head IS NOT NULL THEN 'article' END AS unit, CASE WHEN marker <> '' THEN string_split(marker, ' ')[-2] END AS subunit, merged, sha256(CASE WHEN led THEN lbody || chr(10) || chr(10) ELSE '' END || body) AS body_hash, array_to_string(CASE WHEN led THEN lids ELSE [] END || ids, ',') AS blocks, CAST(page AS INTEGER) AS page FROM t""")
def unit_chunks_query(spark: SparkSession, d: str) -> DataFrame:
    """Lines of an order as articles, numbers and letters: chunks with locators, leads and what is joined."""
    got = unit_chunks.chunks(_unit_blocks(spark, d), UNITS)
    return got.select("doc_id", "seq", "locator", "identifier", "unit", "subunit", "merged", F.sha2("body", 256).alias("body_hash"), F.array_join(F.col("block_ids").cast("array<string>"), ",").alias("blocks"), "page")


@query("unit_words_missing", f"WITH {UNIT_SQL} SELECT doc_id, CAST(sum(CASE f WHEN 1 THEN 2 WHEN 2 THEN 2 ELSE 1 END + w - CASE f WHEN 1 THEN 4 WHEN 2 THEN 3 ELSE 1 END) AS BIGINT) AS n_words, CAST(0 AS BIGINT) AS missing FROM c GROUP BY doc_id")
def unit_words_missing(spark: SparkSession, d: str) -> DataFrame:
    """Words of the blocks against words of their chunks: none is missing."""
    blocks = _unit_blocks(spark, d)
    return unit_chunks.words_missing(blocks, unit_chunks.chunks(blocks, UNITS), UNITS)
