"""Queries over document lines as blocks, and over conversation turns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.functions import text as tx
from corpusloom.operators import blocks as bl
from corpusloom.operators import chunking as ch
from corpusloom.queries.base import query, table

SQUEEZED = r"trim(regexp_replace(t, '[ \t]+', ' ', 'g'))"
LINES = f"raw AS (SELECT doc_id, generate_subscripts(p, 1) - 1 AS line, unnest(p) AS t FROM (SELECT doc_id, string_split(text, chr(10)) AS p FROM documents)), plain AS (SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY line) - 1 AS INTEGER) AS reading_order, s AS text FROM (SELECT doc_id, line, {SQUEEZED} AS s FROM raw) WHERE s <> '')"
#: Lines of one to three words are headings; the fewer, the higher.
UNITS = [("title", r"^[^ ]+$", 1), ("section", r"^[^ ]+ [^ ]+$", 2), ("point", r"^[^ ]+ [^ ]+ [^ ]+$", 3)]
N_WORDS = "len(string_split(text, ' '))"
BLOCKS = f"{LINES}, blocks AS (SELECT doc_id, reading_order, CASE WHEN {N_WORDS} <= 3 THEN 'heading' ELSE 'paragraph' END AS type, CASE WHEN {N_WORDS} <= 3 THEN CAST({N_WORDS} AS INTEGER) END AS level, text FROM plain)"
TOK = r"CAST(floor(len(regexp_extract_all({0}, '[\p{{L}}\p{{N}}_]+|[^\p{{L}}\p{{N}}_\s]')) * 1.35) AS BIGINT)"


def _plain(spark: SparkSession, d: str) -> DataFrame:
    return bl.plain(table(spark, d, "documents"))


def _blocks(spark: SparkSession, d: str) -> DataFrame:
    return bl.promote(_plain(spark, d), UNITS)


@query("plain_blocks", f"WITH {LINES} SELECT doc_id, reading_order, text FROM plain")
def plain_blocks(spark: SparkSession, d: str) -> DataFrame:
    return _plain(spark, d).drop("type")


@query("structure_units", f"WITH {BLOCKS} SELECT doc_id, reading_order, type, level FROM blocks")
def structure_units(spark: SparkSession, d: str) -> DataFrame:
    return _blocks(spark, d).select("doc_id", "reading_order", "type", "level")


MARKS = """md AS (SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN '# ' || replace(text, chr(10), chr(10) || '- ') WHEN 1 THEN replace(text, chr(10), chr(10) || '===' || chr(10)) WHEN 2 THEN '```' || chr(10) || replace(text, chr(10), chr(10) || '```' || chr(10) || '2) ') ELSE replace(text, chr(10), chr(10) || '### ') END AS text FROM documents)"""


def _marked(spark: SparkSession, d: str) -> DataFrame:
    """Documents with Markdown marks put between their lines."""
    put = lambda by: F.regexp_replace("text", "\n", "\n" + by)
    kind = F.col("doc_id") % 4
    text = F.when(kind == 0, F.concat(F.lit("# "), put("- "))).when(kind == 1, put("===\n")).when(kind == 2, F.concat(F.lit("```\n"), put("```\n2) "))).otherwise(put("### "))
    return table(spark, d, "documents").select("doc_id", text.alias("text"))


@query("md_blocks", f"""WITH {MARKS}, r AS (SELECT doc_id, generate_subscripts(p, 1) - 1 AS line, unnest(p) AS t FROM (SELECT doc_id, string_split(text, chr(10)) AS p FROM md)),
f AS (SELECT *, starts_with(ltrim(t), '```') AS fence, sum(CASE WHEN starts_with(ltrim(t), '```') THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY line) % 2 = 1 AS op FROM r),
x AS (SELECT doc_id, line, op, CASE WHEN op THEN rtrim(t) ELSE {SQUEEZED} END AS s FROM f WHERE NOT fence), y AS (SELECT *, NOT op AND regexp_matches(s, '^(?:=+|-+)$') AND row_number() OVER (PARTITION BY doc_id ORDER BY line) > 1 AS under FROM x WHERE s <> ''),
z AS (SELECT *, lead(CASE WHEN under THEN s END) OVER (PARTITION BY doc_id ORDER BY line) AS nx FROM y), w AS (SELECT *, CASE WHEN op THEN 'paragraph' WHEN regexp_matches(s, '^#{{1,6}}\\s+') THEN 'heading' WHEN regexp_matches(s, '^(?:[-*+]|\\d+[.)])\\s+') THEN 'list_item' WHEN nx IS NOT NULL THEN 'heading' ELSE 'paragraph' END AS type FROM z WHERE NOT under)
SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY line) - 1 AS INTEGER) AS reading_order, type, CAST(CASE WHEN op THEN NULL WHEN regexp_matches(s, '^#{{1,6}}\\s+') THEN length(regexp_extract(s, '^(#{{1,6}})', 1)) WHEN type = 'heading' THEN CASE WHEN starts_with(nx, '=') THEN 1 ELSE 2 END END AS INTEGER) AS level,
CASE WHEN op THEN s WHEN regexp_matches(s, '^#{{1,6}}\\s+') THEN regexp_extract(s, '^#{{1,6}}\\s+(.*)$', 1) WHEN type = 'list_item' THEN ltrim(regexp_extract(s, '^(?:[-*+]|(\\d+[.)]))\\s+(.*)$', 1) || ' ' || regexp_extract(s, '^(?:[-*+]|(\\d+[.)]))\\s+(.*)$', 2)) ELSE s END AS text FROM w""")
def md_blocks(spark: SparkSession, d: str) -> DataFrame:
    return bl.markdown(_marked(spark, d))


PATHS = f"""{BLOCKS}, h AS (SELECT *, max(CASE WHEN level = 1 THEN reading_order END) OVER w AS a, max(CASE WHEN level = 2 THEN reading_order END) OVER w AS b, max(CASE WHEN level = 3 THEN reading_order END) OVER w AS c FROM blocks WINDOW w AS (PARTITION BY doc_id ORDER BY reading_order ROWS UNBOUNDED PRECEDING)),
p AS (SELECT h.doc_id, h.reading_order, h.type, h.text, array_to_string(list_filter([x.text, CASE WHEN b > coalesce(a, -1) THEN y.text END, CASE WHEN c > coalesce(a, -1) AND c > coalesce(b, -1) THEN z.text END], lambda q: q IS NOT NULL), ' > ') AS path FROM h LEFT JOIN blocks x ON x.doc_id = h.doc_id AND x.reading_order = a LEFT JOIN blocks y ON y.doc_id = h.doc_id AND y.reading_order = b LEFT JOIN blocks z ON z.doc_id = h.doc_id AND z.reading_order = c)"""


@query("heading_paths", f"WITH {PATHS} SELECT doc_id, reading_order, path FROM p")
def heading_paths(spark: SparkSession, d: str) -> DataFrame:
    return bl.heading_paths(_blocks(spark, d)).select("doc_id", "reading_order", F.array_join("heading_path", " > ").alias("path"))


@query("heading_path_issues", "SELECT doc_id, CAST(0 AS INTEGER) AS reading_order, 'heading_path' AS rule FROM documents WHERE false")
def heading_path_issues(spark: SparkSession, d: str) -> DataFrame:
    return bl.path_issues(bl.heading_paths(_blocks(spark, d)))


RENDERED = r"CASE WHEN type = 'heading' THEN repeat('#', level) || ' ' || text WHEN regexp_matches(text, '^(?:\\|#{1,9}\s|-\s|\$\$|<!--)') THEN '\' || text ELSE text END"


@query("canon_render", f"WITH {BLOCKS} SELECT doc_id, string_agg({RENDERED}, chr(10) || chr(10) ORDER BY reading_order) AS markdown FROM blocks GROUP BY doc_id")
def canon_render(spark: SparkSession, d: str) -> DataFrame:
    return bl.render_documents(_blocks(spark, d))


@query("canon_parse", f"WITH {BLOCKS} SELECT doc_id, reading_order, type, text, level FROM blocks")
def canon_parse(spark: SparkSession, d: str) -> DataFrame:
    """Parsing what was rendered gives the blocks back."""
    return bl.parse_documents(bl.render_documents(_blocks(spark, d))).drop("ref")


@query("round_trip_issues", "SELECT doc_id, CAST(0 AS INTEGER) AS reading_order, 'round_trip' AS rule FROM documents WHERE false")
def round_trip_issues(spark: SparkSession, d: str) -> DataFrame:
    return bl.round_trip_issues(_blocks(spark, d))


@query("reading_order_issues", f"WITH {LINES}, r AS (SELECT * FROM plain WHERE NOT (doc_id % 10 = 0 AND reading_order = 1)) SELECT doc_id, 'reading_order' AS rule FROM r GROUP BY doc_id HAVING min(reading_order) <> 0 OR max(reading_order) <> count(*) - 1 OR count(DISTINCT reading_order) <> count(*)")
def reading_order_issues(spark: SparkSession, d: str) -> DataFrame:
    """One block of every tenth document is taken out, which the rule must find."""
    return bl.order_issues(_plain(spark, d).where("NOT (doc_id % 10 = 0 AND reading_order = 1)"))


@query("text_ratio", "WITH r AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS t FROM documents) SELECT doc_id, round(avg(CASE WHEN trim(t) <> '' THEN 1.0 ELSE 0.0 END), 6) AS ratio, avg(CASE WHEN trim(t) <> '' THEN 1.0 ELSE 0.0 END) >= 0.3 AS ok FROM r GROUP BY doc_id")
def text_ratio(spark: SparkSession, d: str) -> DataFrame:
    rows = bl.lines(table(spark, d, "documents"), "doc_id", "text").withColumn("type", F.lit("paragraph"))
    return bl.text_ratio(rows)


PACKED = f"""{BLOCKS}, body AS (SELECT *, {TOK.format("text")} AS cost, row_number() OVER (PARTITION BY doc_id ORDER BY reading_order) AS i FROM blocks WHERE type <> 'heading'),
walk AS (SELECT doc_id, reading_order, text, i, cost AS used, 0 AS part FROM body WHERE i = 1 UNION ALL SELECT b.doc_id, b.reading_order, b.text, b.i, CASE WHEN w.used + b.cost > 400 THEN b.cost ELSE w.used + b.cost END, CASE WHEN w.used + b.cost > 400 THEN w.part + 1 ELSE w.part END FROM walk w JOIN body b ON b.doc_id = w.doc_id AND b.i = w.i + 1)"""


@query("budget_split", f"WITH RECURSIVE {PACKED} SELECT doc_id, reading_order, CAST(part AS INTEGER) AS part FROM walk")
def budget_split(spark: SparkSession, d: str) -> DataFrame:
    return ch.pack(_blocks(spark, d).where("type <> 'heading'"), ["doc_id"], 400).select("doc_id", "reading_order", "part")


@query("token_chunks", f"WITH RECURSIVE {PACKED}, c AS (SELECT doc_id, part, string_agg(text, chr(10) || chr(10) ORDER BY reading_order) AS body, min(reading_order) AS first_block, count(*) AS blocks FROM walk GROUP BY ALL) SELECT doc_id, CAST(part AS INTEGER) AS part, first_block, blocks, {TOK.format('body')} AS tokens, sha256(body) AS body_hash FROM c")
def token_chunks(spark: SparkSession, d: str) -> DataFrame:
    return ch.by_tokens(_blocks(spark, d), 400).select("doc_id", "part", "first_block", "blocks", "tokens", F.sha2("body", 256).alias("body_hash"))


SEGMENTS = f"""{BLOCKS}, seg AS (SELECT *, CAST(sum(CASE WHEN type = 'heading' THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY reading_order ROWS UNBOUNDED PRECEDING) AS BIGINT) AS segment FROM blocks),
body AS (SELECT *, {TOK.format("text")} AS cost, row_number() OVER (PARTITION BY doc_id, segment ORDER BY reading_order) AS i FROM seg WHERE type <> 'heading'),
walk AS (SELECT doc_id, segment, reading_order, text, i, cost AS used, 0 AS part FROM body WHERE i = 1 UNION ALL SELECT b.doc_id, b.segment, b.reading_order, b.text, b.i, CASE WHEN w.used + b.cost > 400 THEN b.cost ELSE w.used + b.cost END, CASE WHEN w.used + b.cost > 400 THEN w.part + 1 ELSE w.part END FROM walk w JOIN body b ON b.doc_id = w.doc_id AND b.segment = w.segment AND b.i = w.i + 1),
c AS (SELECT doc_id, segment, part, string_agg(text, chr(10) || chr(10) ORDER BY reading_order) AS body, min(reading_order) AS first_block, max(reading_order) AS last_block FROM walk GROUP BY ALL)"""


@query("heading_chunks", f"WITH RECURSIVE {SEGMENTS} SELECT doc_id, segment, CAST(part AS INTEGER) AS part, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY first_block) - 1 AS INTEGER) AS seq, count(*) OVER (PARTITION BY doc_id, segment) AS part_of, {TOK.format('body')} AS tokens, sha256(body) AS body_hash FROM c")
def heading_chunks(spark: SparkSession, d: str) -> DataFrame:
    return ch.by_heading(_blocks(spark, d), 400).select("doc_id", "segment", "part", "seq", "part_of", "tokens", F.sha2("body", 256).alias("body_hash"))


@query("chunk_ids", f"WITH RECURSIVE {SEGMENTS} SELECT doc_id, first_block, left(sha256(CAST(doc_id AS VARCHAR) || chr(0) || CAST(first_block AS VARCHAR) || chr(0) || CAST(last_block AS VARCHAR) || chr(0) || body), 32) AS chunk_id FROM c")
def chunk_ids(spark: SparkSession, d: str) -> DataFrame:
    return ch.by_heading(_blocks(spark, d), 400).select("doc_id", "first_block", "chunk_id")


@query("expect_floors", f"WITH {BLOCKS} SELECT 'level' AS field, round(avg(CASE WHEN level IS NOT NULL THEN 1.0 ELSE 0.0 END), 6) AS share, CAST(0.9 AS DOUBLE) AS floor FROM blocks HAVING avg(CASE WHEN level IS NOT NULL THEN 1.0 ELSE 0.0 END) < 0.9 UNION ALL SELECT 'oversize', round(avg(CASE WHEN {TOK.format('text')} > 100 THEN 1.0 ELSE 0.0 END), 6), CAST(0.01 AS DOUBLE) FROM blocks HAVING avg(CASE WHEN {TOK.format('text')} > 100 THEN 1.0 ELSE 0.0 END) > 0.01")
def expect_floors(spark: SparkSession, d: str) -> DataFrame:
    rows = _blocks(spark, d).withColumn("tokens", tx.estimated_tokens(F.col("text")))
    return ch.expectations(rows, {"level": 0.9, "text": 0.9}, 100, 0.01)


@query("embed_text", "SELECT doc_id, CASE WHEN lang = 'en' THEN '' ELSE lang || chr(10) END || source || chr(10) || text AS embed_text FROM documents")
def embed_text(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", ch.embed_text(F.col("text"), [F.col("lang"), F.col("source")], skip=("en", "")).alias("embed_text"))


@query("search_text", r"SELECT doc_id, sha256(regexp_replace(regexp_replace(text, '[*#$%&]+', '', 'g'), '\s+', ' ', 'g')) AS search_hash FROM documents")
def search_text(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", F.sha2(ch.search_text(F.col("text"), [("[*#$%&]+", ""), (r"\s+", " ")]), 256).alias("search_hash"))


@query("truncated_duplicates", f"""WITH {LINES}, cut AS (SELECT doc_id, reading_order * 2 AS reading_order, left(text, 12) || '...' AS text FROM plain WHERE length(text) > 20 AND doc_id % 5 = 0 UNION ALL SELECT doc_id, reading_order * 2 + 1, text FROM plain),
s AS (SELECT doc_id, reading_order, text, regexp_replace(lower(text), '[^\\p{{L}}\\p{{N}}]+', '', 'g') AS h, lead(regexp_replace(lower(text), '[^\\p{{L}}\\p{{N}}]+', '', 'g')) OVER (PARTITION BY doc_id ORDER BY reading_order) AS n FROM cut) SELECT doc_id, CAST(reading_order AS INTEGER) AS reading_order FROM s WHERE regexp_matches(text, '(?:\\.\\.\\.|…)\\s*$') AND length(h) > 2 AND starts_with(n, h)""")
def truncated_duplicates(spark: SparkSession, d: str) -> DataFrame:
    """A cut copy is put before lines of every fifth document, which the rule must find."""
    p = _plain(spark, d)
    cut = p.where("length(text) > 20 AND doc_id % 5 = 0").select("doc_id", (F.col("reading_order") * 2).alias("reading_order"), F.concat(F.substring("text", 1, 12), F.lit("...")).alias("text"))
    return ch.truncated_duplicates(cut.unionByName(p.select("doc_id", (F.col("reading_order") * 2 + 1).alias("reading_order"), "text")))


@query("block_accounting", f"WITH {BLOCKS} SELECT CASE WHEN text = '' THEN 'empty' WHEN type = 'heading' THEN 'heading' WHEN {TOK.format('text')} < 5 THEN 'short' ELSE 'body' END AS bucket, count(*) AS blocks, CAST(sum(length(text)) AS BIGINT) AS chars FROM blocks GROUP BY 1")
def block_accounting(spark: SparkSession, d: str) -> DataFrame:
    bucket = F.when(F.col("text") == "", "empty").when(F.col("type") == "heading", "heading").when(tx.estimated_tokens(F.col("text")) < 5, "short").otherwise("body")
    return _blocks(spark, d).groupBy(bucket.alias("bucket")).agg(F.count("*").alias("blocks"), F.sum(F.length("text")).cast("long").alias("chars"))


@query("word_recall", rf"""WITH {BLOCKS}, a AS (SELECT doc_id, w, count(*) AS n FROM (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}_]{{2,}}')) AS w FROM documents) GROUP BY ALL), b AS (SELECT doc_id, w, count(*) AS n FROM (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}_]{{2,}}')) AS w FROM blocks WHERE type <> 'heading') GROUP BY ALL)
SELECT a.doc_id, CAST(sum(a.n) AS BIGINT) AS words, CAST(sum(greatest(a.n - coalesce(b.n, 0), 0)) AS BIGINT) AS lost FROM a LEFT JOIN b ON a.doc_id = b.doc_id AND a.w = b.w GROUP BY 1""")
def word_recall(spark: SparkSession, d: str) -> DataFrame:
    """Words of a document that its body blocks lack, as multisets."""
    count = lambda t, name: t.select("doc_id", F.explode(tx.tokens(F.col("text"))).alias("w")).groupBy("doc_id", "w").agg(F.count("*").alias(name))
    both = count(table(spark, d, "documents"), "a").join(count(_blocks(spark, d).where("type <> 'heading'"), "b"), ["doc_id", "w"], "left")
    return both.groupBy("doc_id").agg(F.sum("a").alias("words"), F.sum(F.greatest(F.col("a") - F.coalesce("b", F.lit(0)), F.lit(0))).alias("lost"))


@query("subunit_markers", rf"WITH {MARKS}, r AS (SELECT doc_id, generate_subscripts(p, 1) - 1 AS line, unnest(p) AS t FROM (SELECT doc_id, string_split(text, chr(10)) AS p FROM md)), x AS (SELECT doc_id, line, {SQUEEZED} AS s FROM r) SELECT doc_id, CAST(line AS INTEGER) AS line, CASE WHEN regexp_matches(s, '^[0-9]') THEN 'number' ELSE 'letter' END AS kind, regexp_extract(s, '^\(?([a-z]|[0-9]+)[.)]\s', 1) AS marker FROM x WHERE regexp_matches(s, '^\(?([a-z]|[0-9]+)[.)]\s')")
def subunit_markers(spark: SparkSession, d: str) -> DataFrame:
    """Lines that open with a letter or number and a mark: its kind and value."""
    rows = bl.lines(_marked(spark, d), "doc_id", "text").withColumn("s", bl.squeezed(F.col("text")))
    marker = r"^\(?([a-z]|[0-9]+)[.)]\s"
    return rows.where(F.col("s").rlike(marker)).select("doc_id", "line", F.when(F.col("s").rlike("^[0-9]"), "number").otherwise("letter").alias("kind"), F.regexp_extract("s", marker, 1).alias("marker"))


@query("shape_counts", r"SELECT regexp_replace(regexp_replace(regexp_replace(t, '[0-9]+', 'N', 'g'), '[A-Z]{2,}', 'C', 'g'), '[a-z]+', 'x', 'g') AS shape, count(*) AS n FROM (SELECT unnest(regexp_extract_all(text, '[^ \n]+')) AS t FROM documents) GROUP BY 1 ORDER BY n DESC, shape LIMIT 50")
def shape_counts(spark: SparkSession, d: str) -> DataFrame:
    """The commonest shapes of words: digits as N, capitals as C, small letters as x."""
    words = table(spark, d, "documents").select(F.explode(F.regexp_extract_all("text", F.lit(r"[^ \n]+"), F.lit(0))).alias("t"))
    shape = F.regexp_replace(F.regexp_replace(F.regexp_replace("t", "[0-9]+", "N"), "[A-Z]{2,}", "C"), "[a-z]+", "x")
    return words.groupBy(shape.alias("shape")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "shape").limit(50)


@query("structure_runs", f"WITH {BLOCKS}, s AS (SELECT doc_id, reading_order, level, CASE WHEN level < lag(level) OVER w THEN 1 ELSE 0 END AS back FROM blocks WHERE type = 'heading' WINDOW w AS (PARTITION BY doc_id ORDER BY reading_order)), r AS (SELECT *, sum(back) OVER (PARTITION BY doc_id ORDER BY reading_order ROWS UNBOUNDED PRECEDING) AS run FROM s) SELECT doc_id, count(DISTINCT run) AS runs, count(*) AS headings FROM r GROUP BY 1")
def structure_runs(spark: SparkSession, d: str) -> DataFrame:
    """Runs of headings whose level does not step back."""
    w = Window.partitionBy("doc_id").orderBy("reading_order")
    heads = _blocks(spark, d).where("type = 'heading'").withColumn("back", F.coalesce((F.col("level") < F.lag("level").over(w)).cast("int"), F.lit(0)))
    return heads.withColumn("run", F.sum("back").over(w)).groupBy("doc_id").agg(F.countDistinct("run").alias("runs"), F.count("*").alias("headings"))


@query("turn_segments", "WITH s AS (SELECT conv_id, turn, role, sum(CASE WHEN role = 'user' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn) AS segment FROM conversations) SELECT conv_id, CAST(segment AS BIGINT) AS segment, count(*) AS turns, min(turn) AS first_turn FROM s GROUP BY ALL")
def turn_segments(spark: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("conv_id").orderBy("turn")
    rows = table(spark, d, "conversations").withColumn("segment", F.sum((F.col("role") == "user").cast("int")).over(w))
    return rows.groupBy("conv_id", "segment").agg(F.count("*").alias("turns"), F.min("turn").alias("first_turn"))


@query("lead_carry", f"WITH l AS (SELECT conv_id, arg_min(text, turn) AS lead, count(*) AS n FROM conversations GROUP BY 1) SELECT conv_id, turn, CASE WHEN n >= 2 AND {TOK.format('lead')} <= 60 THEN sha256(lead || chr(10) || chr(10) || text) ELSE sha256(text) END AS body_hash FROM conversations JOIN l USING (conv_id) WHERE turn > 0")
def lead_carry(spark: SparkSession, d: str) -> DataFrame:
    """A conversation's first turn goes before each later one, if it is short enough."""
    c = table(spark, d, "conversations")
    lead = c.groupBy("conv_id").agg(F.min_by("text", "turn").alias("lead"), F.count("*").alias("n"))
    short = (F.col("n") >= 2) & (tx.estimated_tokens(F.col("lead")) <= 60)
    return c.where("turn > 0").join(lead, "conv_id").select("conv_id", "turn", F.sha2(F.when(short, F.concat("lead", F.lit("\n\n"), "text")).otherwise(F.col("text")), 256).alias("body_hash"))


@query("coalesce_small", f"""WITH RECURSIVE t AS (SELECT conv_id, turn, {TOK.format("text")} AS s, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS i FROM conversations),
w AS (SELECT conv_id, turn, i, 0 AS g, CASE WHEN s >= 80 THEN 0 ELSE s END AS used, s >= 80 AS full FROM t WHERE i = 1 UNION ALL SELECT t.conv_id, t.turn, t.i, CASE WHEN w.full THEN w.g + 1 ELSE w.g END, CASE WHEN w.used + t.s >= 80 THEN 0 ELSE w.used + t.s END, w.used + t.s >= 80 FROM w JOIN t ON t.conv_id = w.conv_id AND t.i = w.i + 1),
e AS (SELECT conv_id, arg_max(g, i) AS lastg, arg_max(used, i) AS rest FROM w GROUP BY 1) SELECT conv_id, turn, CAST(CASE WHEN rest > 0 AND lastg > 0 THEN least(g, lastg - 1) ELSE g END AS INTEGER) AS "group" FROM w JOIN e USING (conv_id)""")
def coalesce_small(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "conversations").withColumn("size", tx.estimated_tokens(F.col("text")))
    return ch.coalesce_small(rows, "conv_id", "turn", "size", 80)
