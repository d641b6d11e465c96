"""Clusterings that fit in memory, and what is said of any: assignment, statistics, balance. `clusters` fits large ones as jobs."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE_PER_CLUSTER = 256
ROWS_PER_CLUSTER = 10_000


def suggested_k(rows: int) -> int:
    return max(1, round(rows / ROWS_PER_CLUSTER))


@dataclass(frozen=True)
class Clustering:
    centroids: np.ndarray
    spherical: bool

    def digest(self) -> str:
        """Of the centroids as floats and of how distance is taken; spherical centroids must have length one."""
        if self.spherical and np.any(np.abs(np.linalg.norm(self.centroids, axis=1) - 1) > 0.01):
            raise ValueError("a spherical centroid has another length than one")
        return hashlib.sha256(repr((self.spherical, self.centroids.shape)).encode() + self.centroids.astype("<f4").tobytes()).hexdigest()

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest centroid (the lowest of equal ones) and the distance to it, never below zero."""
        if self.spherical:
            x = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
            far = np.maximum(1 - x @ self.centroids.T, 0)
        else:
            far = np.sqrt(np.maximum((x**2).sum(1)[:, None] - 2 * x @ self.centroids.T + (self.centroids**2).sum(1), 0))
        at = far.argmin(axis=1)
        return at, far[np.arange(len(x)), at]


def _start(x: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """Each next seed is drawn in proportion to the squared distance from those before."""
    seeds = [int(rng.integers(len(x)))]
    far = ((x - x[seeds[0]]) ** 2).sum(1)
    while len(seeds) < k:
        total = far.sum()
        seeds.append(int(rng.choice(len(x), p=far / total)) if total > 0 else int(rng.integers(len(x))))
        far = np.minimum(far, ((x - x[seeds[-1]]) ** 2).sum(1))
    return x[seeds]


def fit_matrix(x: np.ndarray, k: int, *, spherical: bool = True, seed: int = 42, rounds: int = 30, tolerance: float = 1e-4, start: np.ndarray | None = None) -> Clustering:
    """For tables that fit in memory, as `clusters.fit` for all others: Lloyd rounds until the centroids rest; an empty cluster gets the row that fits worst, never one without a direction if there are others."""
    if k > len(x):
        raise ValueError(f"{k} clusters of {len(x)} rows")
    rng = np.random.default_rng(seed)
    if spherical:
        x = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
    centroids = _start(x, k, rng) if start is None else start
    for _ in range(rounds):
        at, far = Clustering(centroids, spherical).nearest(x)
        new = np.zeros_like(centroids)
        np.add.at(new, at, x)
        count = np.bincount(at, minlength=k)
        new /= np.maximum(count, 1)[:, None]
        if spherical:
            length = np.linalg.norm(new, axis=1)
            count = np.where(length > 1e-12, count, 0)
            new /= np.maximum(length, 1e-12)[:, None]
        aims = (np.linalg.norm(x, axis=1) > 1e-12) if spherical else np.ones(len(x), dtype=bool)
        worst = np.lexsort((np.arange(len(x)), -far, ~aims))
        empty = np.flatnonzero(count == 0)
        new[empty] = x[worst[: len(empty)]]
        moved = float(np.linalg.norm(new - centroids, axis=1).mean())
        centroids = new
        if moved <= tolerance:
            break
    return Clustering(centroids, spherical)


def assign(rows: DataFrame, clustering: Clustering, *, id_col: str, vec_col: str) -> DataFrame:
    """(id, cluster_id, distance) of every row. The centroids' size is k by the dimension."""
    sent = rows.sparkSession.sparkContext.broadcast(clustering)

    def assigned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1).astype(np.float64)
                at, far = sent.value.nearest(x)
                yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(at.astype(np.int64)), pa.array(far)], names=["id", "cluster_id", "distance"])

    return rows.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("v")).mapInArrow(assigned, "id long, cluster_id long, distance double")


def statistics(assigned: DataFrame, k: int) -> DataFrame:
    """One row: rows, empty clusters, the largest one and its share, median size, mean and greatest distance."""
    sizes = assigned.groupBy("cluster_id").agg(F.count("*").alias("n"), F.sum("distance").alias("d"), F.max("distance").alias("m"))
    every = assigned.sparkSession.range(k).withColumnRenamed("id", "cluster_id").join(sizes, "cluster_id", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    rows = F.sum("n")
    return every.agg(rows.cast("long").alias("rows"), F.count_if(F.col("n") == 0).alias("empty"), F.max("n").alias("largest"), F.round(F.max("n") / rows, 6).alias("largest_share"), F.expr("percentile(n, 0.5)").alias("median"), F.round(F.sum("d") / rows, 5).alias("mean_distance"), F.round(F.max("m"), 5).alias("max_distance"))


def balance(stats: DataFrame, *, max_share: float = 0.10, ceiling: int = ROWS_PER_CLUSTER * 4) -> DataFrame:
    """The statistics with `ok` and the reasons against: empty, share, size."""
    why = F.array_compact(F.array(F.when(F.col("rows") == 0, "no rows"), F.when(F.col("empty") > 0, "empty"), F.when(F.col("largest_share") > max_share, "share"), F.when(F.col("largest") > ceiling, "size")))
    return stats.withColumn("problems", F.array_join(why, ",")).withColumn("ok", F.size(why) == 0)


def mean_vectors(rows: DataFrame, key: Column, vec_col: str) -> DataFrame:
    """(key, at, value): the mean of each group, element by element."""
    return rows.select(key.alias("key"), F.posexplode(vec_col).alias("at", "x")).groupBy("key", "at").agg(F.avg(F.col("x").cast("double")).alias("value"))
