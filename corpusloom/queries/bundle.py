"""Queries over two cuts of orders and line items as bundles, and over events as a ledger."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.operators import bundle, ledger
from corpusloom.queries.base import query, table

OLD, NEW = "1997-01-01", "1996-01-01"


@query("id_set_check", """SELECT 'repeated chunk' AS "check", CAST(count(*) - count(DISTINCT doc_id) AS BIGINT) AS problems FROM documents UNION ALL SELECT 'repeated vector', CAST(count(*) - count(DISTINCT vec_id) AS BIGINT) FROM embeddings
UNION ALL SELECT 'chunk without vector', count(DISTINCT doc_id) FROM documents WHERE doc_id NOT IN (SELECT vec_id FROM embeddings) UNION ALL SELECT 'vector without chunk', count(DISTINCT vec_id) FROM embeddings WHERE vec_id NOT IN (SELECT doc_id FROM documents)""")
def id_set_check(spark: SparkSession, d: str) -> DataFrame:
    return bundle.id_checks(table(spark, d, "documents").select(F.col("doc_id").alias("id")), table(spark, d, "embeddings").select(F.col("vec_id").alias("id")))


@query("source_hash", "WITH i AS (SELECT DISTINCT doc_id FROM documents), k AS (SELECT CAST(greatest(ceil(ln(count(*) / 4096.0) / ln(16)), 0) AS INTEGER) AS k FROM i), l AS (SELECT left(sha256(CAST(doc_id AS VARCHAR)), k) AS a, sha256(string_agg(CAST(doc_id AS VARCHAR), ',' ORDER BY doc_id)) AS h FROM i, k GROUP BY 1) SELECT sha256(string_agg(h, ',' ORDER BY a)) AS source_hash, count(*) AS buckets FROM l")
def source_hash(spark: SparkSession, d: str) -> DataFrame:
    return bundle.source_hash(table(spark, d, "documents").select(F.col("doc_id").alias("id")))


def _old(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").where(F.col("o_orderdate") < OLD)


def _new(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").where(F.col("o_orderdate") >= NEW)


CUTS = f"old AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '{OLD}'), new AS (SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '{NEW}')"


@query("sidecar_keep", f"WITH {CUTS} SELECT l_orderkey, l_partkey, l_suppkey, l_extendedprice FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS r FROM lineitem SEMI JOIN old ON l_orderkey = o_orderkey) WHERE r = 1")
def sidecar_keep(spark: SparkSession, d: str) -> DataFrame:
    held = _old(spark, d).select(F.col("o_orderkey").alias("l_orderkey"))
    order = [F.col(c) for c in ("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")]
    return bundle.keep_sidecar(table(spark, d, "lineitem"), held, "l_orderkey", order).select("l_orderkey", "l_partkey", "l_suppkey", "l_extendedprice")


@query("delta_docs", f"""WITH {CUTS}, a AS (SELECT o_orderkey, o_custkey AS u FROM old), b AS (SELECT o_orderkey, o_custkey AS u FROM new), f AS (SELECT coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey, a.u AS ou, b.u AS nu FROM a FULL JOIN b USING (o_orderkey))
SELECT o_orderkey, CASE WHEN ou IS NULL THEN 'added' WHEN nu IS NOT NULL THEN 'same' WHEN ou IN (SELECT nu FROM f WHERE ou IS NULL) THEN 'replaced' ELSE 'removed' END AS change FROM f""")
def delta_docs(spark: SparkSession, d: str) -> DataFrame:
    return bundle.delta(_old(spark, d), _new(spark, d), "o_orderkey", "o_custkey")


@query("delta_sidecars", """WITH o AS (SELECT l_orderkey, l_partkey, l_suppkey, count(*) AS n FROM lineitem WHERE l_shipdate < TIMESTAMP '1997-01-01' GROUP BY ALL), w AS (SELECT l_orderkey, l_partkey, l_suppkey, count(*) AS n FROM lineitem WHERE l_shipdate >= TIMESTAMP '1996-01-01' GROUP BY ALL)
SELECT coalesce(o.l_orderkey, w.l_orderkey) AS l_orderkey, CAST(coalesce(sum(o.n), 0) AS BIGINT) AS old_rows, CAST(coalesce(sum(w.n), 0) AS BIGINT) AS new_rows FROM o FULL JOIN w ON o.l_orderkey = w.l_orderkey AND o.l_partkey = w.l_partkey AND o.l_suppkey = w.l_suppkey WHERE o.n IS DISTINCT FROM w.n GROUP BY 1""")
def delta_sidecars(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem")
    return bundle.sidecar_changes(rows.where("l_shipdate < '1997-01-01'"), rows.where("l_shipdate >= '1996-01-01'"), "l_orderkey", ["l_partkey", "l_suppkey"])


@query("relabel_plan", "SELECT p_partkey, p_brand AS old_chapter, 'STANDARD / ' || p_brand AS new_chapter FROM part WHERE regexp_matches(p_type, '^(?:ECONOMY|SMALL)') AND NOT starts_with(p_brand, 'STANDARD') AND regexp_matches(p_name, '^(?:[a-mA-M])')")
def relabel_plan(spark: SparkSession, d: str) -> DataFrame:
    out = bundle.relabel(table(spark, d, "part"), F.col("p_brand"), F.col("p_type"), F.col("p_name"), region="STANDARD", article_like="ECONOMY|SMALL", opens="[a-mA-M]")
    return out.select("p_partkey", "old_chapter", "new_chapter")


@query("merge_load", "SELECT doc_id, lang, label, quality, toxic FROM documents JOIN embeddings ON vec_id = doc_id LEFT JOIN labels USING (doc_id)")
def merge_load(spark: SparkSession, d: str) -> DataFrame:
    vectors = table(spark, d, "embeddings").select(F.col("vec_id").alias("doc_id"), "label")
    return bundle.merge(table(spark, d, "documents").select("doc_id", "lang"), vectors, [table(spark, d, "labels")], "doc_id")


@query("verify_join", "SELECT count(*) AS staged, count(vec_id) AS merged, count(*) - count(vec_id) AS lost FROM documents LEFT JOIN embeddings ON vec_id = doc_id")
def verify_join(spark: SparkSession, d: str) -> DataFrame:
    vectors = table(spark, d, "embeddings").select(F.col("vec_id").alias("doc_id"), F.lit(1).alias("hit"))
    return table(spark, d, "documents").join(vectors, "doc_id", "left").agg(F.count("*").alias("staged"), F.count("hit").alias("merged"), (F.count("*") - F.count("hit")).alias("lost"))


@query("verify_ready", "SELECT count(*) AS rows, count(*) FILTER (WHERE text IS NULL OR text = '') AS empty, count(*) FILTER (WHERE source IS NULL) AS no_source, count(*) FILTER (WHERE n_chars <> length(text)) AS wrong_length, count(DISTINCT lang) AS languages FROM documents")
def verify_ready(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").agg(F.count("*").alias("rows"), F.count_if(F.col("text").isNull() | (F.col("text") == "")).alias("empty"), F.count_if(F.col("source").isNull()).alias("no_source"), F.count_if(F.col("n_chars") != F.length("text")).alias("wrong_length"), F.countDistinct("lang").alias("languages"))


@query("provenance_share", "SELECT source, count(*) AS rows, round(count(*) FILTER (WHERE n_chars >= 200) / count(*), 6) AS share, count(*) FILTER (WHERE n_chars >= 200) / count(*) >= 0.9 AS ok FROM documents GROUP BY source")
def provenance_share(spark: SparkSession, d: str) -> DataFrame:
    share = F.count_if(F.col("n_chars") >= 200) / F.count("*")
    return table(spark, d, "documents").groupBy("source").agg(F.count("*").alias("rows"), F.round(share, 6).alias("share"), (share >= 0.9).alias("ok"))


def _served(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    chunks = table(spark, d, "embeddings").join(table(spark, d, "labels").withColumnRenamed("doc_id", "vec_id"), "vec_id", "left").select(F.col("vec_id").alias("id"), (F.coalesce("quality", F.lit(1)) == 1).alias("indexable"), F.col("label").alias("cluster_id"))
    layout = table(spark, d, "embeddings").where("vec_id % 7 <> 0").select(F.col("vec_id").alias("id"), F.when(F.col("vec_id") % 11 == 0, -1).otherwise(F.col("label")).alias("cluster_id"))
    return chunks, layout


SERVED = "chunks AS (SELECT vec_id AS id, coalesce(quality, 1) = 1 AS indexable, label AS cluster_id FROM embeddings LEFT JOIN labels ON doc_id = vec_id), layout AS (SELECT vec_id AS id, CASE WHEN vec_id % 11 = 0 THEN -1 ELSE label END AS cluster_id FROM embeddings WHERE vec_id % 7 <> 0), fit AS (SELECT id, cluster_id FROM chunks WHERE indexable AND cluster_id IS NOT NULL)"


@query("layout_problems", f"WITH {SERVED} SELECT count(*) FILTER (WHERE l.id IS NULL) AS missing, count(*) FILTER (WHERE f.id IS NULL) AS stale, count(*) FILTER (WHERE f.cluster_id <> l.cluster_id) AS moved FROM fit f FULL JOIN layout l ON f.id = l.id")
def layout_problems(spark: SparkSession, d: str) -> DataFrame:
    return bundle.layout_problems(*_served(spark, d))


@query("sync_layout", f"WITH {SERVED} SELECT id, CAST(cluster_id AS INTEGER) AS cluster_id FROM fit")
def sync_layout(spark: SparkSession, d: str) -> DataFrame:
    return bundle.sync_layout(*_served(spark, d), 8)


@query("recount_clusters", f"WITH {SERVED} SELECT CAST(cluster_id AS INTEGER) AS cluster_id, count(*) AS rows FROM fit GROUP BY 1")
def recount_clusters(spark: SparkSession, d: str) -> DataFrame:
    return _served(spark, d)[0].where("indexable").groupBy("cluster_id").agg(F.count("*").alias("rows"))


@query("apply_quality", "SELECT d.doc_id, lang, coalesce(quality, 1) = 1 AS indexable FROM documents d LEFT JOIN labels USING (doc_id)")
def apply_quality(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left").select("doc_id", "lang", (F.coalesce("quality", F.lit(1)) == 1).alias("indexable"))


@query("region_counts", "SELECT n_name AS region, count(*) AS rows FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE NOT regexp_matches(n_name, '^(?:UNITED)') GROUP BY 1")
def region_counts(spark: SparkSession, d: str) -> DataFrame:
    c, n = table(spark, d, "customer"), table(spark, d, "nation")
    return c.join(n, c.c_nationkey == n.n_nationkey).where(~F.col("n_name").rlike("^(?:UNITED)")).groupBy(F.col("n_name").alias("region")).agg(F.count("*").alias("rows"))


@query("delta_removals", f"WITH {CUTS} SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM old WHERE o_orderkey NOT IN (SELECT o_orderkey FROM new))")
def delta_removals(spark: SparkSession, d: str) -> DataFrame:
    """Line items after those of removed orders are gone."""
    gone = _old(spark, d).join(_new(spark, d), "o_orderkey", "left_anti").select(F.col("o_orderkey").alias("l_orderkey"))
    return table(spark, d, "lineitem").join(gone, "l_orderkey", "left_anti").select("l_orderkey", "l_linenumber", "l_partkey")


@query("checksum_problems", "WITH r AS (SELECT url AS path, sha256(html) AS s FROM pages WHERE page_id % 9 <> 0), f AS (SELECT url AS path, sha256(CASE WHEN page_id % 10 = 0 THEN html || '!' ELSE html END) AS s FROM pages WHERE page_id % 8 <> 0) SELECT coalesce(r.path, f.path) AS path, CASE WHEN f.path IS NULL THEN 'missing' WHEN r.path IS NULL THEN 'untracked' ELSE 'altered' END AS status FROM r FULL JOIN f ON r.path = f.path WHERE r.s IS DISTINCT FROM f.s")
def checksum_problems(spark: SparkSession, d: str) -> DataFrame:
    pages = table(spark, d, "pages")
    recorded = pages.where("page_id % 9 <> 0").select(F.col("url").alias("path"), F.sha2("html", 256).alias("sha256"))
    found = pages.where("page_id % 8 <> 0").select(F.col("url").alias("path"), F.sha2(F.when(F.col("page_id") % 10 == 0, F.concat("html", F.lit("!"))).otherwise(F.col("html")), 256).alias("sha256"))
    return bundle.checksums(recorded, found)


# Events as a ledger: the user is the key, the event's kind its status.
LOG = "log AS (SELECT user_id AS key, event_id, ts AS updated_at, CASE WHEN event_id % 5 = 0 THEN 'failed' WHEN event_id % 5 = 1 THEN 'deferred' ELSE 'done' END AS status, CASE WHEN event_id % 3 = 0 THEN NULL ELSE event_id END AS doc_id FROM events), state AS (SELECT key, arg_max(status, (updated_at, event_id)) AS status, arg_max(doc_id, (updated_at, event_id)) FILTER (WHERE doc_id IS NOT NULL) AS doc_id, count(*) AS attempts, max(updated_at) AS updated_at FROM log GROUP BY key)"


def _log(spark: SparkSession, d: str) -> DataFrame:
    status = F.when(F.col("event_id") % 5 == 0, "failed").when(F.col("event_id") % 5 == 1, "deferred").otherwise("done")
    return table(spark, d, "events").select(F.col("user_id").alias("key"), "event_id", F.col("ts").alias("updated_at"), status.alias("status"), F.when(F.col("event_id") % 3 != 0, F.col("event_id")).alias("doc_id"))


@query("ledger_upsert", f"WITH {LOG} SELECT key, status, doc_id, attempts FROM state")
def ledger_upsert(spark: SparkSession, d: str) -> DataFrame:
    return ledger.state(_log(spark, d)).drop("updated_at")


@query("ledger_counts", f"WITH {LOG} SELECT status, count(*) AS keys FROM state GROUP BY 1")
def ledger_counts(spark: SparkSession, d: str) -> DataFrame:
    return ledger.counts(_log(spark, d))


@query("ledger_failures", f"WITH {LOG} SELECT key, attempts FROM state WHERE status = 'failed' ORDER BY updated_at DESC, key LIMIT 20")
def ledger_failures(spark: SparkSession, d: str) -> DataFrame:
    return ledger.failures(_log(spark, d), 20).select("key", "attempts")


@query("stage_resume", f"WITH {LOG} SELECT DISTINCT key FROM log WHERE key NOT IN (SELECT key FROM state WHERE status = 'done')")
def stage_resume(spark: SparkSession, d: str) -> DataFrame:
    log = _log(spark, d)
    return ledger.left_to_do(log.select("key").distinct(), log)


@query("window_ownership", 'SELECT event_id AS "key", CAST(floor(event_id / 64) AS BIGINT) AS "window", CAST(floor(event_id / 64) % 4 AS BIGINT) AS worker FROM events')
def window_ownership(spark: SparkSession, d: str) -> DataFrame:
    return ledger.ownership(table(spark, d, "events").select(F.col("event_id").alias("key")), 4, 64)


@query("shard_assignment", """WITH RECURSIVE o AS (SELECT source, doc_id, n_chars AS s, doc_id % 7 AS u, CAST(floor(doc_id / 200) AS BIGINT) AS win, row_number() OVER (PARTITION BY source, floor(doc_id / 200) ORDER BY doc_id) AS i FROM documents),
w AS (SELECT source, win, doc_id, i, s AS used, u AS units, 1 AS n, 0 AS shard FROM o WHERE i = 1 UNION ALL SELECT source, win, doc_id, i, CASE WHEN cut THEN s ELSE used + s END, CASE WHEN cut THEN u ELSE units + u END, CASE WHEN cut THEN 1 ELSE n + 1 END, shard + CAST(cut AS INTEGER) FROM (SELECT o.*, w.used, w.units, w.n, w.shard, w.used >= 20000 OR w.used + o.s > 20000 OR w.units >= 25 OR w.units + o.u > 25 OR w.n >= 9 AS cut FROM w JOIN o ON o.source = w.source AND o.win = w.win AND o.i = w.i + 1))
SELECT source, win AS "window", doc_id, CAST(shard AS BIGINT) AS shard FROM w""")
def shard_assignment(spark: SparkSession, d: str) -> DataFrame:
    """Documents of a source into shards bounded by characters, units and documents."""
    rows = table(spark, d, "documents").withColumn("units", F.col("doc_id") % 7)
    return ledger.shards(rows, "source", "doc_id", "n_chars", 20_000, window=200, units="units", max_units=25, max_rows=9)


@query("rolling_rate", "SELECT event_id, round(count(*) OVER (PARTITION BY user_id ORDER BY epoch(ts) RANGE BETWEEN 3600 PRECEDING AND CURRENT ROW) / 3600.0, 6) AS rate FROM events")
def rolling_rate(spark: SparkSession, d: str) -> DataFrame:
    return ledger.rolling_rate(table(spark, d, "events"), "user_id", 3600).select("event_id", "rate")


@query("tumbling_counts", "SELECT time_bucket(INTERVAL 1 DAY, ts) AS day, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL")
def tumbling_counts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").groupBy(F.window("ts", "1 day").alias("w"), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total")).select(F.col("w.start").alias("day"), "event_type", "n", "total")


@query("session_windows", """WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS new, event_id FROM events), s AS (SELECT user_id, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS sess FROM g) SELECT user_id, count(DISTINCT sess) AS sessions, count(*) AS events FROM s GROUP BY 1""")
def session_windows(spark: SparkSession, d: str) -> DataFrame:
    one = table(spark, d, "events").groupBy("user_id", F.session_window("ts", "30 minutes")).agg(F.count("*").alias("n"))
    return one.groupBy("user_id").agg(F.count("*").alias("sessions"), F.sum("n").alias("events"))


@query("edition_pick", """WITH v AS (SELECT p_type AS title, 2000 + p_size % 8 AS edition, p_partkey % 6 AS volume FROM part), sets AS (SELECT title, edition, list(DISTINCT volume) AS vols FROM v GROUP BY ALL),
p AS (SELECT *, lead(vols) OVER (PARTITION BY title ORDER BY edition DESC) AS prior, row_number() OVER (PARTITION BY title ORDER BY edition DESC) AS r FROM sets), c AS (SELECT *, prior IS NOT NULL AND len(list_filter(prior, lambda x: NOT list_contains(vols, x))) > 0 AS held FROM p)
SELECT title, CAST(coalesce(max(edition) FILTER (WHERE r = 1 AND NOT held), max(edition) FILTER (WHERE r = 2), max(edition) FILTER (WHERE r = 1)) AS BIGINT) AS edition, bool_or(r = 1 AND held) AS held_back, CAST(coalesce(max(len(list_filter(prior, lambda x: NOT list_contains(vols, x)))) FILTER (WHERE r = 1 AND prior IS NOT NULL), 0) AS BIGINT) AS missing FROM c GROUP BY title""")
def edition_pick(spark: SparkSession, d: str) -> DataFrame:
    """The newest edition of each title, held back if it lacks a volume that the one before had."""
    v = table(spark, d, "part").select(F.col("p_type").alias("title"), (2000 + F.col("p_size") % 8).cast("long").alias("edition"), (F.col("p_partkey") % 6).alias("volume"))
    newest = Window.partitionBy("title").orderBy(F.desc("edition"))
    sets = v.groupBy("title", "edition").agg(F.collect_set("volume").alias("vols")).withColumn("prior", F.lead("vols").over(newest)).withColumn("r", F.row_number().over(newest)).where("r <= 2")
    lacks = F.size(F.array_except("prior", "vols"))
    held = (F.col("r") == 1) & F.col("prior").isNotNull() & (lacks > 0)
    picked = sets.groupBy("title").agg(F.max(F.when((F.col("r") == 1) & ~held, F.col("edition"))).alias("a"), F.max(F.when(F.col("r") == 2, F.col("edition"))).alias("b"), F.max("edition").alias("c"), F.bool_or(held).alias("held_back"), F.coalesce(F.max(F.when((F.col("r") == 1) & F.col("prior").isNotNull(), lacks)), F.lit(0)).cast("long").alias("missing"))
    return picked.select("title", F.coalesce("a", "b", "c").alias("edition"), "held_back", "missing")


@query("missing_volumes", "WITH v AS (SELECT DISTINCT n_regionkey AS t, n_nationkey % 4 AS old FROM nation), w AS (SELECT DISTINCT n_regionkey AS t, n_nationkey % 3 AS new FROM nation) SELECT CAST(t AS INTEGER) AS title, CAST(old AS INTEGER) AS volume FROM v WHERE NOT EXISTS (SELECT 1 FROM w WHERE w.t = v.t AND w.new = v.old)")
def missing_volumes(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "nation")
    old = n.select(F.col("n_regionkey").alias("title"), (F.col("n_nationkey") % 4).alias("volume")).distinct()
    new = n.select(F.col("n_regionkey").alias("title"), (F.col("n_nationkey") % 3).alias("volume")).distinct()
    return old.join(new, ["title", "volume"], "left_anti")


@query("scan_duplicates", "SELECT count(*) AS files, count(DISTINCT sha256(text)) AS contents, count(*) - count(DISTINCT sha256(text)) AS duplicates, CAST(sum(strlen(text)) AS BIGINT) AS bytes FROM documents")
def scan_duplicates(spark: SparkSession, d: str) -> DataFrame:
    h = F.sha2("text", 256)
    return table(spark, d, "documents").agg(F.count("*").alias("files"), F.countDistinct(h).alias("contents"), (F.count("*") - F.countDistinct(h)).alias("duplicates"), F.sum(F.octet_length("text")).cast("long").alias("bytes"))


@query("mime_counts", r"SELECT CASE WHEN regexp_matches(url, '(?i)\.html?$') THEN 'text/html' WHEN regexp_matches(url, '(?i)\.pdf$') THEN 'application/pdf' ELSE 'application/octet-stream' END AS mime, count(*) AS files FROM pages GROUP BY 1")
def mime_counts(spark: SparkSession, d: str) -> DataFrame:
    mime = F.when(F.col("url").rlike(r"(?i)\.html?$"), "text/html").when(F.col("url").rlike(r"(?i)\.pdf$"), "application/pdf").otherwise("application/octet-stream")
    return table(spark, d, "pages").groupBy(mime.alias("mime")).agg(F.count("*").alias("files"))


@query("profile_route", r"""WITH s AS (SELECT p_partkey, CASE WHEN hs >= 1 THEN 10 * hs + 1 END AS a, CASE WHEN he >= 2 THEN 10 * he + 5 END AS b FROM (SELECT p_partkey, CAST(regexp_matches(p_type, 'STANDARD') AS INTEGER) + CAST(regexp_matches(p_type, 'STEEL') AS INTEGER) + CAST(regexp_matches(p_name, 'a') AS INTEGER) AS hs, CAST(regexp_matches(p_type, 'ECONOMY') AS INTEGER) + CAST(regexp_matches(p_type, 'BRASS') AS INTEGER) + CAST(regexp_matches(p_name, 'e') AS INTEGER) AS he FROM part))
SELECT p_partkey, CASE WHEN a IS NULL AND b IS NULL THEN 'generic' WHEN b IS NULL OR a >= b THEN 'standard' ELSE 'economy' END AS profile FROM s""")
def profile_route(spark: SparkSession, d: str) -> DataFrame:
    """The profile of most pattern hits: ten each and its priority, none under its least hits."""
    hits = lambda ps: sum((F.col(c).rlike(p).cast("int") for c, p in ps), F.lit(0))
    profiles = [("standard", 1, 1, [("p_type", "STANDARD"), ("p_type", "STEEL"), ("p_name", "a")]), ("economy", 2, 5, [("p_type", "ECONOMY"), ("p_type", "BRASS"), ("p_name", "e")])]
    scores = [F.struct(F.when(hits(ps) >= least, 10 * hits(ps) + priority).alias("score"), F.lit(-i).alias("order"), F.lit(name).alias("name")) for i, (name, least, priority, ps) in enumerate(profiles)]
    fit = F.filter(F.array(*scores), lambda s: s["score"].isNotNull())
    return table(spark, d, "part").select("p_partkey", F.coalesce(F.array_max(fit)["name"], F.lit("generic")).alias("profile"))


@query("type_abbrev", "SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'URG' WHEN '2-HIGH' THEN 'HI' WHEN '3-MEDIUM' THEN 'MED' ELSE o_orderpriority END AS short FROM orders")
def type_abbrev(spark: SparkSession, d: str) -> DataFrame:
    names = F.create_map(*[F.lit(x) for pair in (("1-URGENT", "URG"), ("2-HIGH", "HI"), ("3-MEDIUM", "MED")) for x in pair])
    return table(spark, d, "orders").select("o_orderkey", F.coalesce(F.try_element_at(names, F.col("o_orderpriority")), F.col("o_orderpriority")).alias("short"))


@query("variant_matrix", """WITH m AS (SELECT r_name AS extract, n_name AS chunk FROM region, nation), k AS (SELECT *, left(sha256('extract:' || extract), 16) AS k1 FROM m), x AS (SELECT *, left(sha256(k1 || '|chunk:' || chunk), 16) AS k2 FROM k) SELECT extract, chunk, k1 AS extract_key, k2 AS chunk_key, count(*) OVER (PARTITION BY k1) AS shares_extract FROM x""")
def variant_matrix(spark: SparkSession, d: str) -> DataFrame:
    """Every combination of two stages' settings with chained keys: equal prefixes share their work."""
    m = table(spark, d, "region").select(F.col("r_name").alias("extract")).crossJoin(F.broadcast(table(spark, d, "nation").select(F.col("n_name").alias("chunk"))))
    k = m.withColumn("extract_key", F.left(F.sha2(F.concat(F.lit("extract:"), "extract"), 256), F.lit(16)))
    k = k.withColumn("chunk_key", F.left(F.sha2(F.concat("extract_key", F.lit("|chunk:"), "chunk"), 256), F.lit(16)))
    return k.withColumn("shares_extract", F.count("*").over(Window.partitionBy("extract_key")))


@query("reuse_plan", "SELECT count(*) AS variants, count(DISTINCT r_name) AS extract_runs, count(DISTINCT r_name || n_name) AS chunk_runs FROM region, nation")
def reuse_plan(spark: SparkSession, d: str) -> DataFrame:
    return variant_matrix(spark, d).agg(F.count("*").alias("variants"), F.countDistinct("extract_key").alias("extract_runs"), F.countDistinct("chunk_key").alias("chunk_runs"))


@query("cube_counts", "SELECT l_returnflag, l_linestatus, count(*) AS n, round(sum(l_quantity), 2) AS quantity FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)")
def cube_counts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").cube("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), F.round(F.sum("l_quantity"), 2).alias("quantity"))
