"""Distributed k-means against the one in memory, the parents, and what probing finds."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.operators import clusters, kmeans, knn
from corpusloom.queries import queries


def blobs(n, k, dim, seed=1):
    rng = np.random.default_rng(seed)
    means = rng.normal(size=(k, dim)) * 4
    at = np.arange(n) % k
    return means[at] + rng.normal(size=(n, dim)) * 0.3, at


def table(spark, x):
    return spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vid long, vec array<double>").repartition(4)


def start_of(spark, c):
    return spark.createDataFrame(list(enumerate(c.tolist())), "cluster_id long, center array<double>")


def centers_of(df):
    return np.array([r.center for r in df.orderBy("cluster_id").collect()])


@pytest.mark.parametrize("spherical", [True, False])
@pytest.mark.parametrize("block_bytes", [1 << 20, 100])
def test_rounds_equal_those_in_memory(spark, spherical, block_bytes):
    x, _ = blobs(300, 5, 6)
    x[7] = 0
    unit = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12) if spherical else x
    start = unit[[3, 4, 8, 9, 10]]
    want = kmeans.fit_matrix(x, 5, spherical=spherical, start=start, rounds=4, tolerance=0)
    got = clusters.lloyd(clusters.vectors(table(spark, x), "vid", "vec", spherical=spherical), start_of(spark, start), spherical=spherical, rounds=4, tolerance=-1, block_bytes=block_bytes)
    assert np.allclose(centers_of(got), want.centroids, atol=1e-9)
    near = clusters.nearest(clusters.vectors(table(spark, x), "vid", "vec", spherical=spherical), got, spherical=spherical, block_bytes=block_bytes).orderBy("id").collect()
    at, far = want.nearest(x)
    assert [r.cluster_id for r in near] == at.tolist() and np.allclose([r.distance for r in near], far, atol=1e-7)


def test_clusters_without_rows_get_what_fits_worst(spark):
    x = np.array([[1.0, 0], [0.99, 0.01], [0, 1.0], [0, 0.98], [-1.0, 0], [0, 0]])
    start = start_of(spark, np.array([[1.0, 0], [1.0, 0], [0, 1.0]]))
    rows = clusters.vectors(table(spark, x), "vid", "vec")
    got = centers_of(clusters.recentred(clusters.nearest(rows, start), start))
    assert np.allclose(got[1], [-1, 0]) and got[0][0] > 0.99 and got[2][1] > 0.85


def test_fit_finds_the_blobs(spark):
    x, at = blobs(600, 6, 8)
    for per_cluster in (0, 40):
        centers = clusters.fit(table(spark, x), 6, id_col="vid", vec_col="vec", spherical=False, per_cluster=per_cluster)
        found = {r.id: r.cluster_id for r in clusters.nearest(clusters.vectors(table(spark, x), "vid", "vec", spherical=False), centers, spherical=False).collect()}
        assert len({(found[i], int(b)) for i, b in enumerate(at)}) == 6


def test_many_candidates_race_by_weight_and_too_few_rows_are_refused(spark):
    x, _ = blobs(200, 4, 3)
    rows = clusters.vectors(table(spark, x), "vid", "vec")
    got = clusters.seeds(rows, 10, block_bytes=300).collect()
    assert sorted(r.cluster_id for r in got) == list(range(10)) and len({tuple(r.center) for r in got}) == 10
    with pytest.raises(ValueError, match="4 clusters of 3 rows"):
        clusters.seeds(clusters.vectors(table(spark, x[:3]), "vid", "vec"), 4)
    assert len(clusters.seeds(clusters.vectors(table(spark, np.ones((6, 2))), "vid", "vec"), 4).collect()) == 4


def test_probing_all_clusters_is_exact_and_parents_cover_leaves(spark, tmp_path):
    x, _ = blobs(400, 8, 6)
    df = table(spark, x)
    centers = clusters.fit(df, 16, id_col="vid", vec_col="vec")
    placed = clusters.nearest(clusters.vectors(df, "vid", "vec"), centers)
    clusters.layout(placed.select("id", "v", "cluster_id"), str(tmp_path / "l"), folders=5)
    asked = clusters.vectors(df.where("vid % 20 = 0"), "vid", "vec")
    exact = knn.top_k(df, df.where("vid % 20 = 0"), 5, id_col="vid", vec_col="vec")
    level = clusters.parents_of(centers, least=2)
    assert clusters.parents_of(centers) is None and level[1].count() == 16
    laid = spark.read.parquet(str(tmp_path / "l"))
    plain = {(r.qid, r.rank): (r.id, r.score) for r in exact.collect()}
    for parents in (None, level):
        got = clusters.probe(laid, asked, centers, 5, probes=16, folders=5, parents=parents, parent_probes=4, block_bytes=2000)
        assert {(r.qid, r.rank): (r.id, r.score) for r in got.collect()} == plain
    assert clusters.recall(clusters.probe(laid, asked, centers, 5, probes=4, folders=5), exact).first().recall >= 0.9


def test_queries_over_the_whole_table(spark):
    d = "/root/testdata/sf0.001"
    rows = {r.vec_id: np.array(r.embedding, dtype=float) for r in spark.read.parquet(f"{d}/embeddings.parquet").collect()}
    got = queries()["kmeans_fit"](spark, d).collect()
    held = {}
    for r in got:
        held.setdefault(r.cluster_id, []).append(rows[r.vec_id] / np.linalg.norm(rows[r.vec_id]))
    # At rest every row is nearest to the mean of its own cluster.
    means = {c: np.mean(v, axis=0) / np.linalg.norm(np.mean(v, axis=0)) for c, v in held.items()}
    wrong = sum(max(means, key=lambda c: rows[r.vec_id] @ means[c]) != r.cluster_id for r in got)
    assert len(got) == len(rows) and wrong <= len(rows) * 0.02
    placed = queries()["placement"](spark, d).agg(F.sum("rows")).first()[0]
    bad = {r.doc_id for r in spark.read.parquet(f"{d}/labels.parquet").where("quality = 0").collect()}
    assert placed == sum(i not in bad for i in rows)
    level = queries()["parent_level"](spark, d).collect()
    assert sorted(r.leaf for r in level) == list(range(64)) and len({r.parent for r in level}) == 8
    found = {(r.levels, r.probes): r.recall for r in queries()["probe_recall"](spark, d).collect()}
    assert found[1, 48] >= 0.9 and found[2, 48] >= 0.9 and found[1, 8] <= found[1, 24] <= found[1, 48]
