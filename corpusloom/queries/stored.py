"""Queries over tables in versions, generations of stages and shards that are resumed."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.operators import bm25, clusters
from corpusloom.operators.graph import scratch, scratch_folder
from corpusloom.queries.base import ORACLES, query, table
from corpusloom.queries.vectors import CENTROIDS, _label_centroids
from corpusloom.sources import generations, preflight, snapshots, tables


def _root(spark: SparkSession, name: str) -> str:
    return f"{scratch_folder(spark)}/{name}-{uuid.uuid4().hex}"


@query("delta_apply_revert", f"""WITH {CENTROIDS}, c AS (SELECT vec_id, dense_rank() OVER (ORDER BY cluster_id) - 1 AS c FROM near), v1 AS (SELECT vec_id AS id, c FROM c), v2 AS (SELECT * FROM v1 WHERE id % 7 <> 0 UNION ALL SELECT vec_id + 1000000, c FROM c WHERE vec_id % 11 = 0)
SELECT CAST(version AS INTEGER) AS version, count(*) AS rows, CAST(sum(id) AS BIGINT) AS id_sum, CAST(sum(c * id) AS BIGINT) AS place_sum FROM (SELECT 1 AS version, * FROM v1 UNION ALL SELECT 2, * FROM v2 UNION ALL SELECT 3, * FROM v1) GROUP BY version""")
def delta_apply_revert(spark: SparkSession, d: str) -> DataFrame:
    """Vectors laid out by cluster; a seventh is taken out and others put in, placed on the same centroids; then all is put back."""
    _, c = _label_centroids(spark, d)
    centers = spark.createDataFrame(list(enumerate(c.centroids.tolist())), "cluster_id long, center array<double>")
    rows, root = clusters.vectors(table(spark, d, "embeddings"), "vec_id", "embedding"), _root(spark, "served")
    snapshots.create(clusters.nearest(rows, centers).drop("distance"), root, F.pmod("cluster_id", F.lit(4)))
    more = rows.where("id % 11 = 0").withColumn("id", F.col("id") + 1_000_000)
    snapshots.apply_delta(spark, root, 1, rows.where("id % 7 = 0").select("id"), more, centers, folders=4)
    snapshots.revert(spark, root, 1)
    each = [snapshots.read(spark, root, n).agg(F.lit(n).alias("version"), F.count("*").alias("rows"), F.sum("id").alias("id_sum"), F.sum(F.col("cluster_id") * F.col("id")).alias("place_sum")) for n in (1, 2, 3)]
    return each[0].unionByName(each[1]).unionByName(each[2])


@query("relabel_rewrite", "SELECT CASE WHEN lang = 'en' AND doc_id % 16 IN (3, 8) THEN 'english' ELSE lang END AS lang, count(*) AS rows, (SELECT count(DISTINCT doc_id % 16) FROM documents WHERE lang = 'en' AND doc_id % 16 IN (3, 8)) AS rewritten, (SELECT count(DISTINCT doc_id % 16) FROM documents) - (SELECT count(DISTINCT doc_id % 16) FROM documents WHERE lang = 'en' AND doc_id % 16 IN (3, 8)) AS carried FROM documents GROUP BY 1")
def relabel_rewrite(spark: SparkSession, d: str) -> DataFrame:
    """A new label for some documents: the files that hold one are written anew, the others carried."""
    rows, root = table(spark, d, "documents").select("doc_id", "lang", "text"), _root(spark, "labels")
    snapshots.create(rows, root, F.col("doc_id") % 16)
    some = rows.where("lang = 'en' AND doc_id % 16 IN (3, 8)").select("doc_id", F.col("lang").alias("old"), F.lit("english").alias("new"))
    made = snapshots.relabel(spark, root, 1, some, "lang", id_col="doc_id")
    return snapshots.read(spark, root).groupBy("lang").agg(F.count("*").alias("rows")).withColumns({"rewritten": F.lit(made.rewritten).cast("long"), "carried": F.lit(made.carried).cast("long")})


@query("bm25_by_shard", ORACLES["bm25_doc_vectors"])
def bm25_by_shard(spark: SparkSession, d: str) -> DataFrame:
    """Vectors of documents shard by shard by one fit: the first run makes a third of the shards, the second the rest."""
    docs, path = table(spark, d, "documents").withColumn("shard", F.col("doc_id") % 9), _root(spark, "sparse")
    stats = scratch(bm25.statistics(docs, "doc_id", "text"), "stats")
    # One fit for all runs: written once, and small.
    vocab = F.broadcast(scratch(bm25.vocabulary(bm25.term_counts(docs, "doc_id", "text"), stats, 500), "vocab"))

    def transform(rows: DataFrame) -> DataFrame:
        return bm25.weights(bm25.term_counts(rows, "doc_id", "text", only=vocab), vocab, stats).join(rows.select(F.col("doc_id").alias("id"), "shard"), "id")

    generations.transform_shards(docs.where("shard < 3"), "shard", transform, path)
    generations.transform_shards(docs, "shard", transform, path)
    return generations.read_shards(spark, path).select(F.col("id").alias("doc_id"), "term", F.round("weight", 6).alias("weight"))


@query("newest_generation", "SELECT doc_id, length(text) AS n FROM documents WHERE doc_id % 2 = 0")
def newest_generation(spark: SparkSession, d: str) -> DataFrame:
    """Documents of the newest complete run of a stage; older settings and an unfinished run lie beside it."""
    docs, root = table(spark, d, "documents").select("doc_id", F.length("text").cast("long").alias("n")), _root(spark, "stages")
    generations.write(docs.where("doc_id % 3 = 0"), root, "extract", {"v": 1}, order=1)
    generations.write(docs, root, "extract", {"v": 2}, order=2)
    docs.limit(1).write.parquet(f"{root}/extract/unfinished/rows")
    held = generations.newest(spark, root, "extract")
    generations.clear(spark, root, "extract")
    return generations.read(spark, held, keys=docs.where("doc_id % 2 = 0").select("doc_id"))


@query("preflight_checks", """WITH n AS (SELECT (SELECT count(*) FROM documents) AS docs, (SELECT count(*) FROM embeddings) AS vectors, (SELECT count(*) FROM labels WHERE quality = 0) AS failed, (SELECT count(*) FROM documents WHERE source IS NULL OR doc_id % 50 = 0) AS bare, (SELECT max(len(embedding)) FROM embeddings) AS dim)
SELECT 'manifest' AS "check", 'ok' AS status, 'ok' AS strict FROM n UNION ALL SELECT 'dimension', CASE WHEN dim = 64 THEN 'ok' ELSE 'fail' END, CASE WHEN dim = 65 THEN 'ok' ELSE 'fail' END FROM n UNION ALL SELECT 'recipe', 'skipped', 'fail' FROM n UNION ALL SELECT 'canary', 'ok', 'fail' FROM n
UNION ALL SELECT 'completeness', CASE WHEN failed / (failed + docs) > 0.5 THEN 'fail' ELSE 'ok' END, CASE WHEN docs <> vectors OR failed > 0 THEN 'fail' ELSE 'ok' END FROM n UNION ALL SELECT 'files', 'ok', 'fail' FROM n UNION ALL SELECT 'room', 'skipped', 'ok' FROM n UNION ALL SELECT 'provenance', CASE WHEN bare > 0 THEN 'skipped' ELSE 'ok' END, CASE WHEN bare > 0 THEN 'fail' ELSE 'ok' END FROM n""")
def preflight_checks(spark: SparkSession, d: str) -> DataFrame:
    """A bundle of documents and vectors, looked at leniently and, with a stray file in it, strictly."""
    docs, vectors = table(spark, d, "documents"), table(spark, d, "embeddings")
    root = _root(spark, "bundle")
    source = F.when(F.col("doc_id") % 50 != 0, F.col("source"))
    failed = table(spark, d, "labels").where("quality = 0").select(F.col("doc_id").cast("string").alias("key"), F.lit("bad").alias("reason"))
    first = vectors.orderBy("vec_id").limit(1)
    dim = vectors.agg(F.max(F.size("embedding"))).first()[0]
    tables.seal(spark, root, {"documents": docs.select("doc_id", "text", source.alias("source_url")), "vectors": vectors}, {"dim": dim, "model": "m"}, failed=failed, canary=first)
    asked = first.first().embedding
    kind = preflight.preflight(spark, root, target_dim=64, vector=asked, documents="documents", tolerance=0.5, sourced="documents", allow_no_source=True)
    first.write.mode("append").parquet(f"{root}/stray")
    strict = preflight.preflight(spark, root, target_dim=65, deployed={"dim": dim, "model": "n"}, vector=[-x for x in asked], free_bytes=1 << 50, equal=[("documents", "vectors")], documents="documents", sourced="documents")
    return kind.select("check", "status").join(strict.select("check", F.col("status").alias("strict")), "check")
