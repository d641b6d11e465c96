"""Queries over orders as instruments and line items as their citations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.operators import factors, graph, relations
from corpusloom.queries.base import query, table

# An order is an instrument: type, issuing body, number and year. A line item cites one.
INST = """inst AS (SELECT o_orderkey AS doc_id, upper(o_orderpriority) AS type, CASE WHEN lower(c_mktsegment) = 'machinery' THEN '' ELSE regexp_replace(lower(c_mktsegment), '[^0-9a-z]+', '', 'g') END AS body, CAST(o_custkey % 50 AS VARCHAR) AS number, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders JOIN customer ON o_custkey = c_custkey)"""


def instruments(spark: SparkSession, d: str) -> DataFrame:
    o, c = table(spark, d, "orders"), table(spark, d, "customer")
    rows = o.join(c, o.o_custkey == c.c_custkey).select(F.col("o_orderkey").alias("doc_id"), F.lit(0).alias("seq"), F.col("o_orderpriority").alias("type"), F.col("c_mktsegment").alias("body"), (F.col("o_custkey") % 50).cast("string").alias("number"), F.year("o_orderdate").alias("year"))
    return relations.identities(rows, ("machinery",))


@query("identity_index", f"WITH {INST} SELECT type, body, number, year, min(doc_id) AS representative, count(*) AS copies FROM inst GROUP BY ALL")
def identity_index(spark: SparkSession, d: str) -> DataFrame:
    return relations.index(instruments(spark, d))


EDGES = """edges AS (SELECT DISTINCT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, l_linestatus) AS edge_id, l_orderkey AS source, CASE l_returnflag WHEN 'R' THEN 'revokes' WHEN 'A' THEN 'amends' ELSE 'based_on' END AS relation,
['1-URGENT','2-HIGH','3-MEDIUM','4-NOT SPECIFIED','5-LOW'][1 + l_partkey % 5] AS target_type, CASE WHEN l_suppkey % 3 = 0 THEN NULL ELSE ['building','household','auto','furniture'][1 + l_suppkey % 4] END AS target_body, CAST(l_partkey % 50 AS VARCHAR) AS target_number, CAST(1992 + l_suppkey % 7 AS INTEGER) AS target_year,
CASE WHEN l_linenumber % 2 = 0 THEN 'on the household side' ELSE 'on either side' END AS quote, l_linestatus = 'O' AS partial FROM lineitem)"""


def edges(spark: SparkSession, d: str) -> DataFrame:
    types = F.array(*[F.lit(t) for t in ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")])
    bodies = F.array(*[F.lit(t) for t in ("building", "household", "auto", "furniture")])
    # Rows are told apart by the columns that an edge is made of, dealt out by order, as resolving needs them.
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus").repartition("l_orderkey").distinct()
    return lines.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus").alias("edge_id"), F.col("l_orderkey").alias("source"), F.when(F.col("l_returnflag") == "R", "revokes").when(F.col("l_returnflag") == "A", "amends").otherwise("based_on").alias("relation"),
        F.get(types, (F.col("l_partkey") % 5).cast("int")).alias("target_type"), F.when(F.col("l_suppkey") % 3 != 0, F.get(bodies, (F.col("l_suppkey") % 4).cast("int"))).alias("target_body"), (F.col("l_partkey") % 50).cast("string").alias("target_number"), (1992 + F.col("l_suppkey") % 7).cast("int").alias("target_year"),
        F.when(F.col("l_linenumber") % 2 == 0, "on the household side").otherwise("on either side").alias("quote"), (F.col("l_linestatus") == "O").alias("partial"),
    )


RESOLVED = f"""{INST}, {EDGES},
idx AS (SELECT type, body, number, year, min(doc_id) AS rep FROM inst GROUP BY ALL),
cand AS (SELECT e.edge_id, e.target_body, e.quote, i.body, i.rep, o.body AS own FROM edges e JOIN idx i ON i.number = e.target_number AND i.year = e.target_year AND (i.type = e.target_type OR starts_with(i.type, e.target_type || ' ')) LEFT JOIN inst o ON o.doc_id = e.source),
flag AS (SELECT *, target_body IS NOT NULL AND contains(body, target_body) AS named, body <> '' AND contains(regexp_replace(lower(quote), '[^0-9a-z]+', '', 'g'), body) AS quoted FROM cand),
agg AS (SELECT edge_id, any_value(target_body) AS tb, any_value(own) AS own, count(*) AS n, count(*) FILTER (WHERE named AND body = target_body) AS ne, max(length(body)) FILTER (WHERE named) AS ml,
count(*) FILTER (WHERE body = '') AS nn, min(rep) FILTER (WHERE body = '') AS ni, count(*) FILTER (WHERE own <> '' AND body = own) AS nl, min(rep) FILTER (WHERE own <> '' AND body = own) AS li, count(*) FILTER (WHERE quoted) AS nq, min(rep) FILTER (WHERE quoted) AS qi FROM flag GROUP BY edge_id),
best AS (SELECT edge_id, count(*) AS nb, min(rep) AS bi, count(*) FILTER (WHERE quoted) AS nbq, min(rep) FILTER (WHERE quoted) AS bqi FROM flag JOIN agg USING (edge_id) WHERE named AND CASE WHEN ne > 0 THEN body = target_body ELSE length(body) = ml END GROUP BY edge_id),
pick AS (SELECT edge_id, CASE WHEN tb IS NOT NULL THEN CASE WHEN coalesce(nb, 0) = 1 THEN 'best' WHEN coalesce(nb, 0) > 1 THEN CASE WHEN nbq = 1 THEN 'bq' ELSE 'amb' END ELSE 'none' END WHEN nn = 1 THEN 'nat' WHEN coalesce(own, '') <> '' AND nl = 1 THEN 'loc' WHEN coalesce(own, '') <> '' AND nl = 0 THEN 'none' WHEN n > 1 THEN CASE WHEN nq = 1 THEN 'q' ELSE 'amb' END ELSE 'none' END AS how, bi, bqi, ni, li, qi FROM agg LEFT JOIN best USING (edge_id)),
res AS (SELECT e.edge_id, e.source, e.relation, e.partial, CASE how WHEN 'best' THEN bi WHEN 'bq' THEN bqi WHEN 'nat' THEN ni WHEN 'loc' THEN li WHEN 'q' THEN qi END AS target, CASE WHEN how IN ('best', 'nat') THEN 'resolved' WHEN how IN ('bq', 'loc', 'q') THEN 'inferred' WHEN how = 'amb' THEN 'ambiguous' ELSE 'unresolved' END AS resolution, CASE WHEN how IN ('best', 'nat') THEN 1.0 WHEN how = 'loc' THEN 0.7 WHEN how IN ('bq', 'q') THEN 0.6 ELSE 0.0 END AS confidence FROM edges e LEFT JOIN pick USING (edge_id))"""


@query("resolve_edges", f"WITH {RESOLVED} SELECT edge_id, target, resolution, CAST(confidence AS DOUBLE) AS confidence FROM res")
def resolve_edges(spark: SparkSession, d: str) -> DataFrame:
    return relations.resolve(edges(spark, d), instruments(spark, d)).select("edge_id", "target", "resolution", "confidence")


STATUS = f"""{RESOLVED},
spread AS (SELECT r.source, r.relation, r.partial, t2.doc_id AS target FROM res r JOIN inst t ON t.doc_id = r.target JOIN inst t2 USING (type, body, number, year) LEFT JOIN inst s ON s.doc_id = r.source WHERE s.doc_id IS NULL OR NOT (s.type = t.type AND s.body = t.body AND s.number = t.number AND s.year = t.year)),
st AS (SELECT target AS doc_id, bool_or(relation = 'revokes' AND NOT partial) AS f, bool_or(relation = 'revokes' AND partial) AS p, count(DISTINCT source) FILTER (WHERE relation = 'revokes') AS revokers, count(DISTINCT source) FILTER (WHERE relation = 'amends') AS amenders FROM spread GROUP BY target)"""


@query("derive_status", f"WITH {STATUS} SELECT i.doc_id, CASE WHEN f THEN 'revoked' WHEN p THEN 'partially_revoked' WHEN amenders > 0 THEN 'amended' ELSE 'none_known' END AS status, coalesce(revokers, 0) AS revokers, coalesce(amenders, 0) AS amenders FROM inst i LEFT JOIN st USING (doc_id)")
def derive_status(spark: SparkSession, d: str) -> DataFrame:
    ids = instruments(spark, d)
    found = relations.instrument_status(relations.resolve(edges(spark, d), ids), ids)
    # Lists are counted where there is one for all copies.
    counted = found.select(*relations.INSTRUMENT, "status", F.size("revoked_by").cast("long").alias("revokers"), F.size("amended_by").cast("long").alias("amenders"))
    return relations.of_copies(ids, counted).na.fill(0, ["revokers", "amenders"])


@query("mention_merge", f"WITH {EDGES} SELECT source, relation, target_type, target_number, count(*) AS mentions, bool_and(partial) AS partial, arg_min(quote, edge_id) AS quote FROM edges GROUP BY ALL")
def mention_merge(spark: SparkSession, d: str) -> DataFrame:
    rows = edges(spark, d).withColumn("mentions", F.lit(1)).withColumn("seq", F.col("edge_id"))
    return relations.merge_mentions(rows, ["source", "relation", "target_type", "target_number"])


# The graph has an order's first line to name it, so that some identifiers are shared and some free.
GRAPH = """ids AS (SELECT o_orderkey AS doc_id, o_orderpriority || ' ' || CAST(o_custkey AS VARCHAR) || '/' || CAST(year(o_orderdate) AS VARCHAR) AS identifier FROM orders),
cites AS (SELECT l_orderkey AS doc_id, ['1-URGENT','2-HIGH','3-MEDIUM','4-NOT SPECIFIED','5-LOW'][1 + l_suppkey % 5] || ' ' || CAST(l_partkey AS VARCHAR) || '/' || CAST(1992 + l_linenumber % 7 AS VARCHAR) AS identifier FROM lineitem),
held AS (SELECT identifier, count(*) AS holders, min(doc_id) AS dst FROM ids GROUP BY 1),
found AS (SELECT c.doc_id AS src, c.identifier, holders, dst FROM cites c SEMI JOIN ids USING (doc_id) LEFT JOIN held USING (identifier)),
edges AS (SELECT DISTINCT src, dst FROM found WHERE holders = 1 AND src <> dst)"""


def _graph(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    types = F.array(*[F.lit(t) for t in ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")])
    ids = table(spark, d, "orders").select(F.col("o_orderkey").alias("doc_id"), F.concat_ws("", "o_orderpriority", F.lit(" "), "o_custkey", F.lit("/"), F.year("o_orderdate")).alias("identifier"))
    cites = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("doc_id"), F.concat_ws("", F.get(types, (F.col("l_suppkey") % 5).cast("int")), F.lit(" "), "l_partkey", F.lit("/"), 1992 + F.col("l_linenumber") % 7).alias("identifier"))
    return graph.build(ids, cites)


@query("citation_graph", f"WITH {GRAPH} SELECT src, dst FROM edges")
def citation_graph(spark: SparkSession, d: str) -> DataFrame:
    return _graph(spark, d)["edges"]


@query("graph_dangling", f"WITH {GRAPH} SELECT identifier AS target, count(*) AS citations FROM found WHERE coalesce(holders, 0) <> 1 GROUP BY 1")
def graph_dangling(spark: SparkSession, d: str) -> DataFrame:
    return _graph(spark, d)["dangling"]


@query("graph_ambiguous", f"WITH {GRAPH} SELECT identifier AS target, holders FROM held WHERE holders > 1")
def graph_ambiguous(spark: SparkSession, d: str) -> DataFrame:
    return _graph(spark, d)["ambiguous"]


@query("graph_degrees", f"WITH {GRAPH}, i AS (SELECT dst AS doc_id, count(*) AS n FROM edges GROUP BY 1), o AS (SELECT src AS doc_id, count(*) AS n FROM edges GROUP BY 1) SELECT doc_id, coalesce(i.n, 0) AS in_degree, coalesce(o.n, 0) AS out_degree, round((coalesce(i.n, 0) + coalesce(o.n, 0)) / (SELECT greatest(count(*) - 1, 1) FROM ids), 8) AS degree_centrality FROM ids LEFT JOIN i USING (doc_id) LEFT JOIN o USING (doc_id)")
def graph_degrees(spark: SparkSession, d: str) -> DataFrame:
    g = _graph(spark, d)
    return graph.degrees(g["nodes"], g["edges"])


@query("graph_report", f"WITH {GRAPH}, x AS (SELECT (SELECT count(*) FROM ids) AS documents, (SELECT count(*) FROM edges) AS edges, (SELECT count(*) FROM found WHERE coalesce(holders, 0) <> 1) AS dangling_citations, (SELECT count(DISTINCT identifier) FROM found WHERE coalesce(holders, 0) <> 1) AS distinct_dangling_targets, (SELECT count(*) FROM held WHERE holders > 1) AS ambiguous_identifiers) SELECT *, coalesce(round(edges / nullif(edges + dangling_citations, 0), 6), 0.0) AS coverage FROM x")
def graph_report(spark: SparkSession, d: str) -> DataFrame:
    return graph.report(_graph(spark, d))


def _pagerank_sql(rounds: int) -> str:
    out = [GRAPH, "n AS (SELECT count(*) AS n FROM ids)", "od AS (SELECT src, count(*) AS outs FROM edges GROUP BY 1)", "r0 AS MATERIALIZED (SELECT doc_id, 1.0::DOUBLE / n AS r FROM ids, n)"]
    for k in range(rounds):
        out.append(f"r{k + 1} AS MATERIALIZED (SELECT i.doc_id, (1 - 0.85) / n + 0.85 * (coalesce(g.got, 0) + lost.v / n) AS r FROM ids i LEFT JOIN (SELECT dst, sum(r / outs) AS got FROM edges JOIN od USING (src) JOIN r{k} ON doc_id = src GROUP BY dst) g ON g.dst = i.doc_id, n, (SELECT coalesce(sum(r), 0) AS v FROM r{k} WHERE doc_id NOT IN (SELECT src FROM od)) lost)")
    return "WITH " + ", ".join(out) + f" SELECT doc_id, round(r * 1000, 6) AS rank_per_mille FROM r{rounds}"


@query("pagerank", _pagerank_sql(8))
def pagerank(spark: SparkSession, d: str) -> DataFrame:
    g = _graph(spark, d)
    nodes, links = graph.scratch(g["nodes"], "nodes"), graph.scratch(g["edges"], "edges")
    return graph.pagerank(nodes, links, rounds=8).select("doc_id", F.round(F.col("rank") * 1000, 6).alias("rank_per_mille"))


@query("authority_factor", "SELECT o_orderkey AS doc_id, CASE WHEN regexp_matches(o_orderpriority, '^[1-4]') THEN (10 - CAST(left(o_orderpriority, 1) AS INTEGER)) / 10.0 END AS authority FROM orders")
def authority_factor(spark: SparkSession, d: str) -> DataFrame:
    rank = F.when(F.col("o_orderpriority").rlike("^[1-4]"), 10 - F.left("o_orderpriority", F.lit(1)).cast("int"))
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("doc_id"), factors.authority(rank).alias("authority"))


@query("temporal_factor", "SELECT o_orderkey AS doc_id, CASE WHEN year(o_orderdate) BETWEEN 1800 AND 1996 THEN round(25.0 / (25 + greatest(1995 - year(o_orderdate), 0)), 6) END AS temporal FROM orders")
def temporal_factor(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("doc_id"), factors.temporal(F.year("o_orderdate"), 1995).alias("temporal"))


@query("structural_factor", r"SELECT p_partkey AS chunk_id, CAST(CASE WHEN regexp_matches(p_type, '(?i)^\s*(?:STANDARD|SMALL)') THEN 0.3 WHEN regexp_matches(p_type, '(?i)^\s*(?:ECONOMY)') THEN 1.0 WHEN regexp_matches(p_brand, '(?i)^\s*(?:STANDARD|SMALL)') THEN 0.3 WHEN regexp_matches(p_brand, '(?i)^\s*(?:ECONOMY)') THEN 1.0 WHEN p_type <> '' OR p_brand <> '' THEN 0.6 END AS DOUBLE) AS structural FROM part")
def structural_factor(spark: SparkSession, d: str) -> DataFrame:
    score = factors.structural(F.col("p_brand"), F.col("p_type"), ["STANDARD", "SMALL"], ["ECONOMY"])
    return table(spark, d, "part").select(F.col("p_partkey").alias("chunk_id"), score.alias("structural"))


SPANS = "spans AS (SELECT l_orderkey AS doc_id, l_linenumber AS kind, CAST(l_partkey % 40 AS INTEGER) AS start, CAST(l_partkey % 40 + 1 + l_quantity AS INTEGER) AS \"end\" FROM lineitem)"


def _spans(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").select(F.col("l_orderkey").alias("doc_id"), F.col("l_linenumber").alias("kind"), (F.col("l_partkey") % 40).cast("int").alias("start"), (F.col("l_partkey") % 40 + 1 + F.col("l_quantity")).cast("int").alias("end"))


KEPT = f"{SPANS}, o AS (SELECT *, max(\"end\") OVER (PARTITION BY doc_id ORDER BY start, \"end\" DESC, kind ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS held FROM spans), kept AS (SELECT doc_id, kind, start, \"end\" FROM o WHERE held IS NULL OR \"end\" > held)"


@query("span_dedupe", f"WITH {KEPT} SELECT * FROM kept")
def span_dedupe(spark: SparkSession, d: str) -> DataFrame:
    return relations.drop_contained(_spans(spark, d), ["doc_id"])


@query("reference_counts", f"WITH {KEPT} SELECT doc_id, count(*) AS total, count(*) FILTER (WHERE kind % 2 = 0) AS regulation, count(*) FILTER (WHERE kind % 2 = 1) AS internal, count(DISTINCT start) FILTER (WHERE kind % 2 = 0) AS distinct_regulations FROM kept GROUP BY doc_id")
def reference_counts(spark: SparkSession, d: str) -> DataFrame:
    even = F.col("kind") % 2 == 0
    return relations.drop_contained(_spans(spark, d), ["doc_id"]).groupBy("doc_id").agg(F.count("*").alias("total"), F.count_if(even).alias("regulation"), F.count_if(~even).alias("internal"), F.countDistinct(F.when(even, F.col("start"))).alias("distinct_regulations"))


@query("nearest_cue", """WITH p AS (SELECT l_orderkey AS doc_id, l_linenumber AS point_id, CAST(l_partkey % 1000 AS INTEGER) AS pos FROM lineitem WHERE l_linenumber % 2 = 1), c AS (SELECT l_orderkey AS doc_id, l_linenumber AS cue_id, CAST(l_partkey % 1000 AS INTEGER) AS cue_pos FROM lineitem WHERE l_linenumber % 2 = 0),
m AS (SELECT *, abs(pos - cue_pos) AS gap, row_number() OVER (PARTITION BY doc_id, point_id, pos ORDER BY abs(pos - cue_pos), cue_pos, cue_id) AS r FROM p JOIN c USING (doc_id) WHERE abs(pos - cue_pos) <= 120) SELECT doc_id, point_id, pos, cue_id, cue_pos, gap FROM m WHERE r = 1""")
def nearest_cue(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("doc_id"), "l_linenumber", (F.col("l_partkey") % 1000).cast("int").alias("pos"))
    points = rows.where("l_linenumber % 2 = 1").select("doc_id", F.col("l_linenumber").alias("point_id"), "pos")
    cues = rows.where("l_linenumber % 2 = 0").select("doc_id", F.col("l_linenumber").alias("cue_id"), F.col("pos").alias("cue_pos"))
    return relations.nearest(points, cues, ["doc_id"], window=120)
