"""Queries over embeddings: checks, cosines, neighbours, clusters, gates."""

from __future__ import annotations

import uuid
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.functions import vectors as vx
from corpusloom.operators import clusters, kmeans, knn
from corpusloom.operators.graph import scratch_folder
from corpusloom.queries.base import query, table

D = "CAST(embedding AS DOUBLE[])"


def _vectors(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "embeddings")


@query("vector_checks", f"SELECT count(*) AS rows, count(*) FILTER (WHERE len(embedding) <> 64) AS wrong_width, count(*) FILTER (WHERE len(list_filter({D}, lambda x: NOT isfinite(x))) > 0) AS not_finite, count(*) FILTER (WHERE abs(sqrt(list_inner_product({D}, {D})) - 1) > 0.01) AS not_unit FROM embeddings")
def vector_checks(spark: SparkSession, d: str) -> DataFrame:
    v = F.col("embedding")
    return _vectors(spark, d).agg(F.count("*").alias("rows"), F.count_if(F.size(v) != 64).alias("wrong_width"), F.count_if(~vx.finite(v)).alias("not_finite"), F.count_if(F.abs(vx.norm(v) - 1) > 0.01).alias("not_unit"))


@query("cosine_pairs", "SELECT a.vec_id AS vec_id, b.vec_id AS next_id, round(list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 5) AS cosine FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1")
def cosine_pairs(spark: SparkSession, d: str) -> DataFrame:
    a = _vectors(spark, d).select("vec_id", F.col("embedding").alias("a"))
    b = _vectors(spark, d).select((F.col("vec_id") - 1).alias("vec_id"), F.col("vec_id").alias("next_id"), F.col("embedding").alias("b"))
    return a.join(b, "vec_id").select("vec_id", "next_id", F.round(vx.cosine(F.col("a"), F.col("b")), 5).alias("cosine"))


@query("round_trip_cosine", "SELECT label, count(*) AS pairs, round(min(c), 5) AS worst, round(avg(c), 5) AS mean, arg_min(vec_id, (round(c, 6), vec_id)) AS worst_id FROM (SELECT a.vec_id, a.label, list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), list_transform(CAST(a.embedding AS DOUBLE[]), lambda x: round(x, 2))) AS c FROM embeddings a) GROUP BY label")
def round_trip_cosine(spark: SparkSession, d: str) -> DataFrame:
    """How far a coarser copy of each vector is from it: the worst and mean cosine of a label."""
    v = F.col("embedding").cast("array<double>")
    c = _vectors(spark, d).select("vec_id", "label", vx.cosine(v, F.transform(v, lambda x: F.round(x, 2))).alias("c"))
    return c.groupBy("label").agg(F.count("*").alias("pairs"), F.round(F.min("c"), 5).alias("worst"), F.round(F.avg("c"), 5).alias("mean"), F.min_by("vec_id", F.struct(F.round("c", 6), "vec_id")).alias("worst_id"))


@query("knn_topk", """WITH s AS (SELECT q.vec_id AS qid, r.vec_id AS vec_id, round(list_cosine_similarity(CAST(q.embedding AS DOUBLE[]), CAST(r.embedding AS DOUBLE[])), 6) AS score FROM embeddings q JOIN embeddings r ON q.vec_id <> r.vec_id WHERE q.vec_id % 20 = 0)
SELECT qid, vec_id, rank, score FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 10""")
def knn_topk(spark: SparkSession, d: str) -> DataFrame:
    rows = _vectors(spark, d)
    found = knn.top_k(rows, rows.where(F.col("vec_id") % 20 == 0), 10, id_col="vec_id", vec_col="embedding")
    return found.select("qid", F.col("id").alias("vec_id"), "rank", "score")


CENTROIDS = f"""el AS (SELECT vec_id, label, generate_subscripts({D}, 1) AS pos, unnest({D}) AS x FROM embeddings),
mean AS (SELECT label, pos, avg(x) AS m FROM el GROUP BY ALL),
cent AS (SELECT label AS cid, list(m ORDER BY pos) AS c FROM mean GROUP BY label),
dist AS (SELECT vec_id, label, cid, round(greatest(1 - list_cosine_similarity({D}, c), 0), 6) AS distance FROM embeddings, cent),
near AS (SELECT vec_id, label, cid AS cluster_id, distance FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY distance, cid) AS r FROM dist) WHERE r = 1)"""


def _label_centroids(spark: SparkSession, d: str) -> tuple[np.ndarray, kmeans.Clustering]:
    """The labels' mean vectors, as centroids; their number is that of the labels."""
    means = kmeans.mean_vectors(_vectors(spark, d), F.col("label"), "embedding").groupBy("key").agg(F.sort_array(F.collect_list(F.struct("at", "value"))).alias("m")).orderBy("key").collect()
    x = np.array([[p.value for p in r.m] for r in means])
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
    return np.array([r.key for r in means]), kmeans.Clustering(x, True)


def _near(spark: SparkSession, d: str) -> tuple[DataFrame, int]:
    labels, c = _label_centroids(spark, d)
    out = kmeans.assign(_vectors(spark, d), c, id_col="vec_id", vec_col="embedding")
    return out, len(labels)


@query("nearest_centroid", f"WITH {CENTROIDS} SELECT vec_id, CAST(dense_rank() OVER (ORDER BY cluster_id) - 1 AS BIGINT) AS cluster_id, distance FROM near")
def nearest_centroid(spark: SparkSession, d: str) -> DataFrame:
    return _near(spark, d)[0].select(F.col("id").alias("vec_id"), "cluster_id", F.round("distance", 6).alias("distance"))


STATS = """sz AS (SELECT cid, count(near.vec_id) AS n, sum(distance) AS d, max(distance) AS m FROM cent LEFT JOIN near ON cluster_id = cid GROUP BY cid),
st AS (SELECT CAST(sum(n) AS BIGINT) AS rows, count(*) FILTER (WHERE n = 0) AS empty, max(n) AS largest, round(max(n) / sum(n), 6) AS largest_share, quantile_cont(n, 0.5) AS median, round(sum(d) / sum(n), 5) AS mean_distance, round(max(m), 5) AS max_distance FROM sz)"""


@query("cluster_stats", f"WITH {CENTROIDS}, {STATS} SELECT * FROM st")
def cluster_stats(spark: SparkSession, d: str) -> DataFrame:
    near, k = _near(spark, d)
    return kmeans.statistics(near, k)


@query("cluster_balance", f"WITH {CENTROIDS}, {STATS} SELECT *, array_to_string(list_filter([CASE WHEN rows = 0 THEN 'no rows' END, CASE WHEN empty > 0 THEN 'empty' END, CASE WHEN largest_share > 0.10 THEN 'share' END, CASE WHEN largest > 40000 THEN 'size' END], lambda x: x IS NOT NULL), ',') AS problems, NOT (rows = 0 OR empty > 0 OR largest_share > 0.10 OR largest > 40000) AS ok FROM st")
def cluster_balance(spark: SparkSession, d: str) -> DataFrame:
    near, k = _near(spark, d)
    return kmeans.balance(kmeans.statistics(near, k))


@query("cluster_drift", f"WITH {CENTROIDS} SELECT round(avg(distance) FILTER (WHERE vec_id % 2 = 0), 5) AS baseline, round(avg(distance) FILTER (WHERE vec_id % 2 = 1), 5) AS mean_distance, round(avg(distance) FILTER (WHERE vec_id % 2 = 1) / avg(distance) FILTER (WHERE vec_id % 2 = 0) - 1, 4) AS relative_drift FROM near")
def cluster_drift(spark: SparkSession, d: str) -> DataFrame:
    """Even ids stand for the rows that were clustered, odd ids for those that came later."""
    near = _near(spark, d)[0]
    base, now = F.avg(F.when(F.col("id") % 2 == 0, F.col("distance"))), F.avg(F.when(F.col("id") % 2 == 1, F.col("distance")))
    return near.agg(F.round(base, 5).alias("baseline"), F.round(now, 5).alias("mean_distance"), F.round(now / base - 1, 4).alias("relative_drift"))


@query("corpus_centroid", f"SELECT CAST(pos - 1 AS INTEGER) AS pos, round(avg(x), 6) AS value FROM (SELECT generate_subscripts({D}, 1) AS pos, unnest({D}) AS x FROM embeddings) GROUP BY pos")
def corpus_centroid(spark: SparkSession, d: str) -> DataFrame:
    return kmeans.mean_vectors(_vectors(spark, d), F.lit(0), "embedding").select(F.col("at").alias("pos"), F.round("value", 6).alias("value"))


SIMS = f"{CENTROIDS}, sim AS (SELECT vec_id, label, round(list_cosine_similarity({D}, c), 6) AS s FROM embeddings, cent WHERE cid = (SELECT min(label) FROM embeddings))"


def _sims(spark: SparkSession, d: str) -> DataFrame:
    """Each vector's cosine with the anchor of the lowest label, and whether it belongs there."""
    labels, c = _label_centroids(spark, d)
    anchor = F.array(*[F.lit(float(x)) for x in c.centroids[0]])
    return _vectors(spark, d).select("vec_id", F.round(vx.cosine(F.col("embedding").cast("array<double>"), anchor), 6).alias("s"), (F.col("label") == int(labels[0])).alias("inside"))


@query("anchor_similarity", f"WITH {SIMS} SELECT vec_id, s AS similarity FROM sim")
def anchor_similarity(spark: SparkSession, d: str) -> DataFrame:
    return _sims(spark, d).select("vec_id", F.col("s").alias("similarity"))


@query("threshold_calibration", f"WITH {SIMS}, t AS (SELECT quantile_cont(s, 0.05) AS t FROM sim WHERE label = (SELECT min(label) FROM embeddings)) SELECT round(any_value(t), 5) AS threshold, round(count(*) FILTER (WHERE label = (SELECT min(label) FROM embeddings) AND s < t) / count(*) FILTER (WHERE label = (SELECT min(label) FROM embeddings)), 6) AS false_reject, round(count(*) FILTER (WHERE label <> (SELECT min(label) FROM embeddings) AND s >= t) / count(*) FILTER (WHERE label <> (SELECT min(label) FROM embeddings)), 6) AS false_accept FROM sim, t")
def threshold_calibration(spark: SparkSession, d: str) -> DataFrame:
    """The quantile of the inside similarities that keeps 95 % of them, and what it lets in."""
    sims = _sims(spark, d)
    cut = sims.where("inside").agg(F.expr("percentile(s, 0.05)").alias("t"))
    rate = lambda hit, of: F.round(F.count_if(hit) / F.count_if(of), 6)
    inside, s, t = F.col("inside"), F.col("s"), F.col("t")
    return sims.crossJoin(F.broadcast(cut)).agg(F.round(F.first("t"), 5).alias("threshold"), rate(inside & (s < t), inside).alias("false_reject"), rate(~inside & (s >= t), ~inside).alias("false_accept"))


@query("gate_auc", f"""WITH {SIMS}, r AS (SELECT label = (SELECT min(label) FROM embeddings) AS inside, s, rank() OVER (ORDER BY s) + (count(*) OVER (PARTITION BY s) - 1) / 2.0 AS rk FROM sim),
n AS (SELECT count(*) FILTER (WHERE inside) AS p, count(*) FILTER (WHERE NOT inside) AS q, sum(rk) FILTER (WHERE inside) AS sr, min(s) FILTER (WHERE inside) AS low FROM r)
SELECT p AS inside, q AS outside, round((sr - p * (p + 1) / 2.0) / (p * q), 4) AS auc, round(floor((low - 0.02) * 100) / 100, 2) AS floor, (SELECT count(*) FROM r WHERE NOT inside AND s < floor((low - 0.02) * 100) / 100) AS refused FROM n""")
def gate_auc(spark: SparkSession, d: str) -> DataFrame:
    """How well the similarity parts inside from outside: pairs won, counted per distinct value."""
    counts = _sims(spark, d).groupBy("s").agg(F.count_if("inside").alias("p"), F.count_if(~F.col("inside")).alias("q"))
    # Values are rounded, so that there are at most two million of them whatever the rows.
    below = Window.orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    won = counts.withColumn("w", F.col("p") * (F.coalesce(F.sum("q").over(below), F.lit(0)) + F.col("q") / 2))
    low = F.min(F.when(F.col("p") > 0, F.col("s")))
    out = won.agg(F.sum("p").alias("inside"), F.sum("q").alias("outside"), F.round(F.sum("w") / (F.sum("p") * F.sum("q")), 4).alias("auc"), (F.floor((low - 0.02) * 100) / 100).alias("floor"))
    refused = counts.crossJoin(F.broadcast(out.select(F.col("floor").alias("f")))).agg(F.coalesce(F.sum(F.when(F.col("s") < F.col("f"), F.col("q"))), F.lit(0)).alias("refused"))
    return out.crossJoin(refused).withColumn("floor", F.round("floor", 2))


@query("kmeans_round", f"WITH {CENTROIDS}, e AS (SELECT cluster_id, generate_subscripts({D}, 1) AS pos, unnest({D}) / norm AS x FROM (SELECT cluster_id, embedding, sqrt(list_inner_product({D}, {D})) AS norm FROM near JOIN embeddings USING (vec_id))), m AS (SELECT cluster_id, pos, avg(x) AS m FROM e GROUP BY ALL), n AS (SELECT cluster_id, sqrt(sum(m * m)) AS n FROM m GROUP BY 1) SELECT dense_rank() OVER (ORDER BY cluster_id) - 1 AS cluster_id, CAST(pos - 1 AS INTEGER) AS pos, round(m / n, 6) AS value FROM m JOIN n USING (cluster_id)")
def kmeans_round(spark: SparkSession, d: str) -> DataFrame:
    """The centroids after one round of all rows from the labels' means."""
    _, c = _label_centroids(spark, d)
    start = spark.createDataFrame(list(enumerate(c.centroids.tolist())), "cluster_id long, center array<double>")
    rows = clusters.vectors(_vectors(spark, d), "vec_id", "embedding")
    new = clusters.recentred(clusters.nearest(rows, start), start)
    return new.select("cluster_id", F.posexplode("center").alias("pos", "value")).withColumn("value", F.round("value", 6))


def _fitted(rows: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
    """Centroids of k clusters and every row with its cluster."""
    centers = clusters.fit(rows, k, id_col="vec_id", vec_col="embedding")
    return centers, clusters.nearest(clusters.vectors(rows, "vec_id", "embedding"), centers)


@query("kmeans_fit")
def kmeans_fit(spark: SparkSession, d: str) -> DataFrame:
    """Cluster and distance of each vector after a fit with as many clusters as labels."""
    rows = _vectors(spark, d)
    found = _fitted(rows, rows.select("label").distinct().count())[1]
    return found.select(F.col("id").alias("vec_id"), "cluster_id", F.round("distance", 6).alias("distance"))


@query("placement")
def placement(spark: SparkSession, d: str) -> DataFrame:
    """Rows and mean distance of each cluster, placed without the vectors that are not to be indexed."""
    rows = _vectors(spark, d)
    barred = table(spark, d, "labels").where("quality = 0").select(F.col("doc_id").alias("vec_id"))
    kept = rows.join(barred, "vec_id", "left_anti")
    found = _fitted(kept, max(2, kmeans.suggested_k(kept.count())))[1]
    return found.groupBy("cluster_id").agg(F.count("*").alias("rows"), F.round(F.avg("distance"), 6).alias("mean_distance"))


def _parents(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    leaves = clusters.fit(_vectors(spark, d), 64, id_col="vec_id", vec_col="embedding")
    return clusters.parents_of(leaves, least=2)


@query("parent_level")
def parent_level(spark: SparkSession, d: str) -> DataFrame:
    """Clusters of clusters: leaf, parent and distance, with the root of the leaves as their number."""
    return _parents(spark, d)[1].withColumn("distance", F.round("distance", 6))


@query("parent_problems", "SELECT CAST(NULL AS VARCHAR) AS problem, CAST(NULL AS BIGINT) AS id WHERE false")
def parent_problems(spark: SparkSession, d: str) -> DataFrame:
    """Parents without a leaf, and leaves without a parent; none if the level is sound."""
    top, level = _parents(spark, d)
    lone = top.join(level, top.cluster_id == level.parent, "left_anti").select(F.lit("empty parent").alias("problem"), F.col("cluster_id").alias("id"))
    return lone.unionByName(level.where("parent is null").select(F.lit("orphan leaf").alias("problem"), F.col("leaf").alias("id")))


@query("probe_recall")
def probe_recall(spark: SparkSession, d: str) -> DataFrame:
    """Share of the ten nearest neighbours found in 8, 24 and 48 of 64 clusters, over one level and over two.

    Queries are the rows whose id is divisible by 20, against all rows, which are laid out by cluster.
    """
    rows = _vectors(spark, d)
    centers, placed = _fitted(rows, 64)
    path = f"{scratch_folder(spark)}/layout-{uuid.uuid4().hex}"
    clusters.layout(placed.select("id", "v", "cluster_id"), path, folders=16)
    laid, asked = spark.read.parquet(path), clusters.vectors(rows.where(F.col("vec_id") % 20 == 0), "vec_id", "embedding")
    exact = knn.top_k(rows, rows.where(F.col("vec_id") % 20 == 0), 10, id_col="vec_id", vec_col="embedding")
    parents, out = clusters.parents_of(centers, least=2), []
    for probes in (8, 24, 48):
        for levels in (1, 2):
            found = clusters.probe(laid, asked, centers, 10, probes=probes, folders=16, parents=parents if levels == 2 else None, parent_probes=probes // 8 + 2)
            out.append(clusters.recall(found, exact).select(F.lit(levels).alias("levels"), F.lit(probes).alias("probes"), "recall"))
    return reduce(DataFrame.unionByName, out)
