"""Queries that score retrieval: benchmark texts as queries, documents that hold them as answers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.operators import evaluate as ev
from corpusloom.queries.base import query, table
from corpusloom.queries.text import TOPK, bm25_topk

JUDGED = "judged AS (SELECT item_id AS qid, doc_id AS doc, 1 AS grade FROM documents d JOIN benchmark b ON contains(d.text, b.text))"
SCORED = f"""WITH {TOPK}, r AS (SELECT item_id AS qid, doc_id AS doc, rank FROM ranked WHERE rank <= 10), {JUDGED},
want AS (SELECT qid, count(DISTINCT doc) AS relevant FROM judged GROUP BY 1), h AS (SELECT r.*, coalesce(grade, 0) AS grade FROM r LEFT JOIN judged USING (qid, doc)), o AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY grade DESC, rank) AS place FROM h),
p AS (SELECT qid, count(*) FILTER (WHERE grade > 0) AS found, min(rank) FILTER (WHERE grade > 0) AS first, sum(CASE WHEN grade > 0 THEN grade / log2(rank + 1.0) ELSE 0 END) AS dcg, sum(CASE WHEN grade > 0 THEN grade / log2(place + 1.0) ELSE 0 END) AS best, count(*) AS returned FROM o GROUP BY qid),
m AS (SELECT qid, coalesce(relevant, 0) AS relevant, CASE WHEN coalesce(relevant, 0) > 0 THEN round(least(coalesce(found, 0), relevant) / relevant, 6) END AS recall, CASE WHEN coalesce(relevant, 0) > 0 THEN round(coalesce(1.0 / first, 0.0), 6) END AS mrr, CASE WHEN coalesce(relevant, 0) > 0 THEN round(coalesce(dcg / nullif(best, 0), 0.0), 6) END AS ndcg, coalesce(relevant, 0) = 0 AND coalesce(returned, 0) = 0 AS empty_as_due FROM p FULL JOIN want USING (qid))"""


SPACE = r"[\x20\x09-\x0D]+"
RUN = 3


def _runs(text: Column) -> Column:
    """Hashes of all runs of three neighbouring words, from the words beside themselves moved by one and two."""
    words = F.split(text, SPACE)
    moved = [F.slice(words, F.lit(k), F.size(words)) for k in (2, 3)]
    return F.transform(F.arrays_zip(words.alias("a"), moved[0].alias("b"), moved[1].alias("c")), lambda x: F.xxhash64(x["a"], x["b"], x["c"]))


def judgements(spark: SparkSession, d: str) -> DataFrame:
    """Documents that hold a benchmark text, first and last word in part.

    The second to fourth words of a text stand whole in every document that holds it: they are
    joined by hash, then the text is sought. A text of under five words is sought in all documents.
    """
    docs = table(spark, d, "documents").select("doc_id", "text")
    items = table(spark, d, "benchmark").select("item_id", F.col("text").alias("want"), F.split("text", SPACE).alias("w"))
    keyed = items.where(F.size("w") >= RUN + 2).select("item_id", F.xxhash64(*[F.get("w", F.lit(k)) for k in (1, 2, 3)]).alias("run"))
    likely = docs.select("doc_id", F.explode(_runs(F.col("text"))).alias("run")).join(keyed, "run").select("doc_id", "item_id").distinct()
    hashed = likely.join(items.select("item_id", "want"), "item_id").join(docs, "doc_id")
    short = docs.join(items.where(F.size("w") < RUN + 2).select("item_id", "want"), F.contains("text", "want"))
    met = hashed.where(F.contains("text", "want")).select("item_id", "doc_id").unionByName(short.select("item_id", "doc_id"))
    return met.select(F.col("item_id").alias("qid"), F.col("doc_id").alias("doc"), F.lit(1).alias("grade"))


def _measures(spark: SparkSession, d: str) -> DataFrame:
    ranked = bm25_topk(spark, d).select(F.col("item_id").alias("qid"), F.col("doc_id").alias("doc"), "rank")
    return ev.measures(ranked, judgements(spark, d))


query("judgements", f"WITH {JUDGED} SELECT * FROM judged")(judgements)


@query("recall_mrr_ndcg", f"{SCORED} SELECT qid, relevant, recall, recall AS recall_distinct, mrr, ndcg, empty_as_due FROM m")
def recall_mrr_ndcg(spark: SparkSession, d: str) -> DataFrame:
    return _measures(spark, d)


@query("eval_report", f"{SCORED} SELECT CASE WHEN relevant = 0 THEN 'negative' ELSE 'positive' END AS kind, count(*) AS queries, round(avg(recall), 6) AS recall, round(avg(mrr), 6) AS mrr, round(avg(ndcg), 6) AS ndcg, count(*) FILTER (WHERE empty_as_due) AS empty_as_due FROM m GROUP BY 1")
def eval_report(spark: SparkSession, d: str) -> DataFrame:
    kind = F.when(F.col("relevant") == 0, "negative").otherwise("positive")
    return _measures(spark, d).groupBy(kind.alias("kind")).agg(F.count("*").alias("queries"), *[F.round(F.avg(c), 6).alias(c) for c in ("recall", "mrr", "ndcg")], F.count_if("empty_as_due").alias("empty_as_due"))


DRAWN = "b AS (SELECT row_number() OVER (ORDER BY item_id) - 1 AS pos, round(length(text) / 100.0, 6) AS v FROM benchmark), n AS (SELECT count(*) AS n FROM b), dr AS (SELECT i, (i * 7919 + j * 104729 + i * j * 31) % n AS pos FROM range(1000) t(i), range((SELECT n FROM n)) u(j), n), mm AS (SELECT i, round(avg(v), 6) AS m FROM dr JOIN b USING (pos) GROUP BY i), s AS (SELECT list(m ORDER BY m) AS l FROM mm)"


@query("bootstrap_ci", f"WITH {DRAWN} SELECT l[25] AS low, l[976] AS high FROM s")
def bootstrap_ci(spark: SparkSession, d: str) -> DataFrame:
    per = table(spark, d, "benchmark").select(F.col("item_id").alias("qid"), F.round(F.length("text") / 100.0, 6).alias("v"))
    return ev.bootstrap(per, "v")


@query("routing_loss", f"{SCORED}, a AS (SELECT avg(recall) AS whole FROM m), b AS (SELECT avg(CASE WHEN relevant > 0 THEN least(coalesce(f, 0), relevant) / relevant END) AS routed FROM m LEFT JOIN (SELECT qid, count(*) AS f FROM h WHERE grade > 0 AND rank <= 3 GROUP BY 1) USING (qid)) SELECT round(whole, 6) AS whole, round(routed, 6) AS routed, round(whole - routed, 6) AS loss FROM a, b")
def routing_loss(spark: SparkSession, d: str) -> DataFrame:
    """What a narrower search loses: recall of ten results against that of the first three."""
    ranked = bm25_topk(spark, d).select(F.col("item_id").alias("qid"), F.col("doc_id").alias("doc"), "rank")
    judged = judgements(spark, d)
    whole = ev.measures(ranked, judged).agg(F.avg("recall").alias("w"))
    routed = ev.measures(ranked, judged, k=3).agg(F.avg("recall").alias("r"))
    return whole.crossJoin(routed).select(F.round("w", 6).alias("whole"), F.round("r", 6).alias("routed"), F.round(F.col("w") - F.col("r"), 6).alias("loss"))


@query("beats", f"WITH {DRAWN} SELECT l[25] AS low, l[976] AS high, (SELECT avg(v) FROM b) > 1.5 AND l[25] > 1.2 AS beats FROM s")
def beats(spark: SparkSession, d: str) -> DataFrame:
    """Whether a mean is past a margin and its interval clear of the other arm's upper bound."""
    per = table(spark, d, "benchmark").select(F.col("item_id").alias("qid"), F.round(F.length("text") / 100.0, 6).alias("v"))
    mean = per.agg(F.avg("v").alias("mean"))
    return ev.bootstrap(per, "v").crossJoin(mean).select("low", "high", ((F.col("mean") > 1.5) & (F.col("low") > 1.2)).alias("beats"))


@query("label_composition", "SELECT lang, quality, toxic, count(*) AS rows, round(count(*) / sum(count(*)) OVER (PARTITION BY lang), 6) AS share FROM labels JOIN documents USING (doc_id) GROUP BY lang, quality, toxic")
def label_composition(spark: SparkSession, d: str) -> DataFrame:
    from pyspark.sql import Window

    n = table(spark, d, "labels").join(table(spark, d, "documents").select("doc_id", "lang"), "doc_id").groupBy("lang", "quality", "toxic").agg(F.count("*").alias("rows"))
    return n.withColumn("share", F.round(F.col("rows") / F.sum("rows").over(Window.partitionBy("lang")), 6))


@query("stratified_split", "SELECT doc_id, quality, row_number() OVER (PARTITION BY quality ORDER BY md5('7' || CAST(doc_id AS VARCHAR)), doc_id) <= round_even(count(*) OVER (PARTITION BY quality) * 0.2, 0) AS held FROM labels")
def stratified_split(spark: SparkSession, d: str) -> DataFrame:
    return ev.stratified_split(table(spark, d, "labels"), "quality", "doc_id", 0.2, "7").select("doc_id", "quality", "held")


@query("label_contradictions", f"WITH {JUDGED}, r AS (SELECT qid, count(*) AS n FROM judged GROUP BY 1), q AS (SELECT item_id AS qid, CASE WHEN item_id % 2 = 0 THEN 'negative' ELSE 'positive' END AS kind, coalesce(n, 0) AS n FROM benchmark LEFT JOIN r ON qid = item_id) SELECT qid, 'kind' AS problem FROM q WHERE (kind = 'negative') = (n > 0)")
def label_contradictions(spark: SparkSession, d: str) -> DataFrame:
    n = judgements(spark, d).groupBy("qid").agg(F.count("*").alias("n"))
    q = table(spark, d, "benchmark").select(F.col("item_id").alias("qid"), F.when(F.col("item_id") % 2 == 0, "negative").otherwise("positive").alias("kind")).join(n, "qid", "left").na.fill(0, ["n"])
    return ev.contradictions(q, "qid", "kind", "n")


LOC = r"""loc AS (SELECT p_partkey, 'Chapter ' || CAST(p_size % 5 AS VARCHAR) || ' > Article ' || CAST(p_partkey % 7 AS VARCHAR) || CASE WHEN p_partkey % 3 = 0 THEN ' para (2)' ELSE '' END AS chunk, CASE p_partkey % 4 WHEN 0 THEN '' WHEN 1 THEN 'chapter ' || CAST(p_size % 4 AS VARCHAR) ELSE 'Chapter ' || CAST(p_size % 5 AS VARCHAR) || ' article ' || CAST(p_partkey % 6 AS VARCHAR) || ' para 2' END AS label FROM part),
pth AS (SELECT p_partkey, list_transform(regexp_extract_all(lower(chunk), '\b(?:chapter|article|para)\b\s*\(?\s*(?:[0-9]+[a-z]?)'), lambda x: regexp_replace(x, '[\s(]+', ' ', 'g')) AS c, list_transform(regexp_extract_all(lower(label), '\b(?:chapter|article|para)\b\s*\(?\s*(?:[0-9]+[a-z]?)'), lambda x: regexp_replace(x, '[\s(]+', ' ', 'g')) AS l FROM loc)"""


@query("locator_coverage", f"WITH {LOC} SELECT p_partkey, array_to_string(c, '/') AS chunk_path, array_to_string(l, '/') AS label_path, CASE WHEN len(l) = 0 THEN 'contains' WHEN len(c) = 0 THEN 'none' WHEN c = l THEN 'exact' WHEN len(c) < len(l) AND l[1:len(c)] = c THEN 'contains' WHEN len(l) < len(c) AND c[1:len(l)] = l THEN 'within' ELSE 'none' END AS coverage FROM pth")
def locator_coverage(spark: SparkSession, d: str) -> DataFrame:
    """How a chunk's locator relates to a label's: the same, broader, narrower or apart."""
    p, size = F.col("p_partkey"), F.col("p_size").cast("string")
    s = lambda c, n: (F.col(c) % n).cast("string")
    chunk = F.concat(F.lit("Chapter "), s("p_size", 5), F.lit(" > Article "), s("p_partkey", 7), F.when(p % 3 == 0, " para (2)").otherwise(""))
    label = F.when(p % 4 == 0, "").when(p % 4 == 1, F.concat(F.lit("chapter "), s("p_size", 4))).otherwise(F.concat(F.lit("Chapter "), s("p_size", 5), F.lit(" article "), s("p_partkey", 6), F.lit(" para 2")))
    names = ["chapter", "article", "para"]
    paths = table(spark, d, "part").select("p_partkey", ev.locator_path(chunk, names).alias("c"), ev.locator_path(label, names).alias("l"))
    return paths.select("p_partkey", F.array_join("c", "/").alias("chunk_path"), F.array_join("l", "/").alias("label_path"), ev.coverage(F.col("c"), F.col("l")).alias("coverage"))


@query("identifier_normal", r"SELECT o_orderkey, lower(regexp_replace(regexp_replace(x, '(?i)\bno(?:mor)?\b\.?', ' ', 'g'), '[\s.]+', '', 'g')) AS identifier FROM (SELECT o_orderkey, o_orderpriority || CASE WHEN o_orderkey % 2 = 0 THEN ' No. ' ELSE ' Nomor ' END || CAST(o_custkey AS VARCHAR) || ' / ' || CAST(year(o_orderdate) AS VARCHAR) AS x FROM orders)")
def identifier_normal(spark: SparkSession, d: str) -> DataFrame:
    x = F.concat("o_orderpriority", F.when(F.col("o_orderkey") % 2 == 0, " No. ").otherwise(" Nomor "), F.col("o_custkey").cast("string"), F.lit(" / "), F.year("o_orderdate").cast("string"))
    return table(spark, d, "orders").select("o_orderkey", ev.normal_identifier(x).alias("identifier"))
