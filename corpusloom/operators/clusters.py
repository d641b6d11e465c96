"""k-means whose rounds are jobs over all rows, a level of parents over the leaves, and probing of what is laid out by leaf.

Centroids are a table (cluster_id, center). A pass over the rows gets them in blocks of at most
BLOCK_BYTES, one after the other, so that neither a task nor the driver holds more of them at once.
Each task adds up what it has seen of a cluster, and the sums meet by cluster. Ids of rows have to be
distinct.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions.vectors import norm, unit
from corpusloom.operators.graph import scratch
from corpusloom.operators.kmeans import Clustering

BLOCK_BYTES = 64 << 20
#: Rows a task offers for clusters that have none.
SPARE = 64
#: Rounds of seeding; in each about twice the clusters are drawn over all rounds together.
SEED_ROUNDS = 5
PER_CLUSTER = 250
#: Under so many leaves a level of parents saves nothing.
LEAST_LEAVES = 256


def _matrix(column: pa.Array, rows: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(rows, -1).astype(np.float64)


def _lists(x: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), pa.array(x.reshape(-1)))


def _blocks(centers: DataFrame, block_bytes: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids and centroids in order of id, a block at a time."""
    n, width = centers.agg(F.count("*"), F.max(F.size("center"))).first()
    count = max(1, -(-n * 8 * (width or 1) // block_bytes))
    for b in range(count):
        got = centers.where(F.pmod("cluster_id", F.lit(count)) == b).orderBy("cluster_id").toArrow().combine_chunks()
        if got.num_rows:
            yield got.column("cluster_id").to_numpy(), _matrix(got.column("center").combine_chunks(), got.num_rows)


def vectors(rows: DataFrame, id_col: str, vec_col: str, *, spherical: bool = True) -> DataFrame:
    """id and v (of length one if spherical)."""
    v = F.col(vec_col).cast("array<double>")
    return rows.select(F.col(id_col).cast("long").alias("id"), (unit(v) if spherical else v).alias("v"))


def nearest(rows: DataFrame, centers: DataFrame, *, spherical: bool = True, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """id, v, cluster_id and distance of every row (id, v); of equally near centroids the one of the lowest id."""

    def against(ids: np.ndarray, matrix: np.ndarray) -> DataFrame:
        sent = rows.sparkSession.sparkContext.broadcast((ids, Clustering(matrix, spherical)))

        def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    names, clustering = sent.value
                    at, far = clustering.nearest(_matrix(batch.column("v"), batch.num_rows))
                    yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("v"), pa.array(names[at]), pa.array(far)], names=["id", "v", "cluster_id", "distance"])

        return rows.select("id", "v").mapInArrow(find, "id long, v array<double>, cluster_id long, distance double")

    passes = [against(*block) for block in _blocks(centers, block_bytes)]
    if len(passes) == 1:
        return passes[0]
    each = reduce(DataFrame.unionByName, [p.drop("v") for p in passes])
    best = each.groupBy("id").agg(F.min(F.struct("distance", "cluster_id")).alias("b")).select("id", "b.cluster_id", "b.distance")
    return rows.select("id", "v").join(best, "id")


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts and sums by cluster (kind 0), and the rows that fit worst (kind 1); zero vectors are no such rows."""
    held: dict[int, list] = {}
    spare: list[tuple[float, int, np.ndarray]] = []

    def sent(kind: int, keys: list, numbers: list, values: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([kind] * len(keys), pa.int32()), pa.array(keys, pa.int64()), pa.array(numbers, pa.float64()), _lists(np.array(values))], names=["kind", "key", "number", "v"])

    def flush() -> Iterator[pa.RecordBatch]:
        if held:
            yield sent(0, list(held), [n for n, _ in held.values()], [v for _, v in held.values()])
            held.clear()

    for batch in batches:
        if not batch.num_rows:
            continue
        x, at, far, ids = _matrix(batch.column("v"), batch.num_rows), batch.column("cluster_id").to_numpy(), batch.column("distance").to_numpy(), batch.column("id").to_numpy()
        keys, inverse = np.unique(at, return_inverse=True)
        total = np.zeros((len(keys), x.shape[1]))
        np.add.at(total, inverse, x)
        for key, n, v in zip(keys.tolist(), np.bincount(inverse).tolist(), total, strict=True):
            old = held.get(key)
            held[key] = [n, v] if old is None else [old[0] + n, old[1] + v]
        aims = np.flatnonzero(np.linalg.norm(x, axis=1) > 1e-12)
        worst = aims[np.lexsort((ids[aims], -far[aims]))[:SPARE]]
        spare = sorted([*spare, *((-far[i], int(ids[i]), x[i]) for i in worst)], key=lambda s: s[:2])[:SPARE]
        if len(held) * x.shape[1] * 8 > BLOCK_BYTES:
            yield from flush()
    yield from flush()
    if spare:
        yield sent(1, [i for _, i, _ in spare], [-f for f, _, _ in spare], [v for *_, v in spare])


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sums of each cluster added up, from rows sorted by cluster."""
    key, n, total = None, 0.0, None
    for batch in batches:
        done = []
        if not batch.num_rows:
            continue
        for k, more, v in zip(batch.column("key").to_pylist(), batch.column("number").to_pylist(), _matrix(batch.column("v"), batch.num_rows), strict=True):
            if k != key:
                done += [(key, n, total)] if total is not None else []
                key, n, total = k, 0.0, np.zeros(len(v))
            n, total = n + more, total + v
        if done:
            yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done]), _lists(np.array([d[2] / d[1] for d in done]))], names=["cluster_id", "center"])
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array([key]), _lists((total / n)[None, :])], names=["cluster_id", "center"])


def recentred(assigned: DataFrame, centers: DataFrame, *, spherical: bool = True) -> DataFrame:
    """The next centroids: means of the rows of each; one without rows or direction gets a row that fits worst.

    If there are more of those than rows on offer (SPARE a task), the others stay where they are.
    """
    parts = scratch(assigned.mapInArrow(_sums, "kind int, key long, number double, v array<double>"), "sums")
    means = parts.where("kind = 0").repartition("key").sortWithinPartitions("key").mapInArrow(_met, "cluster_id long, center array<double>")
    if spherical:
        means = means.where(norm(F.col("center")) > 1e-12).select("cluster_id", unit(F.col("center")).alias("center"))
    means = scratch(means, "means")
    bare = centers.join(means, "cluster_id", "left_anti")
    if bare.isEmpty():
        return means
    # As many rows as there are clusters without any: far fewer than clusters.
    spare = parts.where("kind = 1").select(F.col("v").alias("center"), F.row_number().over(Window.orderBy(F.desc("number"), "key")).alias("_n"))
    numbered = bare.select("cluster_id", F.col("center").alias("_old"), F.row_number().over(Window.orderBy("cluster_id")).alias("_n"))
    return means.unionByName(numbered.join(spare, "_n", "left").select("cluster_id", F.coalesce("center", "_old").alias("center")))


def lloyd(rows: DataFrame, centers: DataFrame, *, spherical: bool = True, rounds: int = 30, tolerance: float = 1e-4, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Rounds from the given centroids until they rest; rows are read once a round."""
    for _ in range(rounds):
        new = scratch(recentred(nearest(rows, centers, spherical=spherical, block_bytes=block_bytes), centers, spherical=spherical), "centers")
        gap = F.zip_with("center", "_old", lambda a, b: a - b)
        moved = new.join(centers.withColumnRenamed("center", "_old"), "cluster_id").agg(F.avg(norm(gap))).first()[0]
        centers = new
        if moved <= tolerance:
            break
    return centers


def _draw(*key) -> F.Column:
    """A number in (0, 1) for each key, the same on every run."""
    return (F.pmod(F.xxhash64(*key), F.lit(1 << 52)).cast("double") + 0.5) / float(1 << 52)


def _weighted_start(x: np.ndarray, weight: np.ndarray, k: int, seed: int, spherical: bool) -> np.ndarray:
    """k of the candidates, each next one in proportion to its weight and squared distance from those before."""
    rng = np.random.default_rng(seed)
    chosen = [int(rng.choice(len(x), p=weight / weight.sum()))]
    far = Clustering(x[chosen], spherical).nearest(x)[1] ** 2
    while len(chosen) < k:
        mass = weight * far
        if mass.sum() <= 0:
            left = np.setdiff1d(np.arange(len(x)), chosen)
            chosen += left[np.argsort(-weight[left], kind="stable")][: k - len(chosen)].tolist()
            break
        chosen.append(int(rng.choice(len(x), p=mass / mass.sum())))
        far = np.minimum(far, Clustering(x[chosen[-1:]], spherical).nearest(x)[1] ** 2)
    return x[chosen]


def seeds(rows: DataFrame, k: int, *, spherical: bool = True, seed: int = 42, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """k first centroids: candidates drawn in a few rounds by squared distance, then k of them by weight.

    Candidates that fit a block are chosen from by squared distance on the driver; more of them by a
    race of their weights alone, as jobs. Fewer distinct rows than k are an error.
    """
    first = rows.select("id", "v").orderBy(F.xxhash64(F.lit(seed), "id"), "id").limit(1)
    held = scratch(first.select(F.col("id").alias("cluster_id"), F.col("v").alias("center")), "seeds")
    for turn in range(SEED_ROUNDS):
        far = scratch(nearest(rows, held, spherical=spherical, block_bytes=block_bytes).select("id", "v", "distance"), "far")
        total = far.agg(F.sum(F.col("distance") ** 2)).first()[0] or 0.0
        if total <= 0:
            break
        rate = 2 * k * F.col("distance") ** 2 / total
        more = far.where(_draw(F.lit(seed), F.lit(turn), F.col("id")) < rate).select(F.col("id").alias("cluster_id"), F.col("v").alias("center"))
        held = scratch(held.unionByName(more.join(held, "cluster_id", "left_anti")), "seeds")
    if held.count() < k:
        # Rows that lie close together are drawn seldom: the rest is filled up by hash.
        rest = rows.join(held, rows.id == held.cluster_id, "left_anti").orderBy(F.xxhash64(F.lit(seed), "id"), "id").limit(k - held.count())
        held = scratch(held.unionByName(rest.select(F.col("id").alias("cluster_id"), F.col("v").alias("center"))), "seeds")
    n, width = held.agg(F.count("*"), F.max(F.size("center"))).first()
    if n < k:
        raise ValueError(f"{k} clusters of {n} rows")
    weights = nearest(rows, held, spherical=spherical, block_bytes=block_bytes).groupBy("cluster_id").agg(F.count("*").alias("weight"))
    both = scratch(held.join(weights, "cluster_id", "left").withColumn("weight", F.coalesce("weight", F.lit(0)).cast("double")), "weights")
    if n * width * 8 <= block_bytes:
        got = both.orderBy("cluster_id").toArrow().combine_chunks()
        start = _weighted_start(_matrix(got.column("center").combine_chunks(), got.num_rows), got.column("weight").to_numpy() + 1e-9, k, seed, spherical)
        return rows.sparkSession.createDataFrame(list(enumerate(start.tolist())), "cluster_id long, center array<double>")
    race = both.select("cluster_id", (-F.log(_draw(F.lit(seed), F.lit(-1), F.col("cluster_id"))) / (F.col("weight") + 1e-9)).alias("key")).orderBy("key", "cluster_id").limit(k)
    numbered = race.select("cluster_id", (F.row_number().over(Window.orderBy("key", "cluster_id")) - 1).cast("long").alias("_n"))
    return scratch(both.join(numbered, "cluster_id").select(F.col("_n").alias("cluster_id"), "center"), "seeds")


def fit(rows: DataFrame, k: int, *, id_col: str, vec_col: str, spherical: bool = True, seed: int = 42, rounds: int = 30, per_cluster: int = PER_CLUSTER, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """cluster_id and center of k clusters, fitted on about `per_cluster` rows a cluster (0: on all), chosen by a hash of the id.

    The sample is a table, and grows with k; all rows are placed on what comes of it.
    """
    x = vectors(rows, id_col, vec_col, spherical=spherical)
    if per_cluster:
        total = x.count()
        if total > per_cluster * k:
            x = x.where(_draw(F.lit(seed), F.lit("sample"), F.col("id")) < per_cluster * k / total)
    x = scratch(x, "sample")
    return lloyd(x, seeds(x, k, spherical=spherical, seed=seed, block_bytes=block_bytes), spherical=spherical, rounds=rounds, block_bytes=block_bytes)


def parents_of(centers: DataFrame, *, least: int = LEAST_LEAVES, seed: int = 42, block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, DataFrame] | None:
    """Centroids of the root of the leaves as many parents, and (leaf, parent, distance); none under `least` leaves."""
    n = centers.count()
    if n < least:
        return None
    top = fit(centers, max(2, round(n**0.5)), id_col="cluster_id", vec_col="center", seed=seed, per_cluster=0, block_bytes=block_bytes)
    placed = nearest(vectors(centers, "cluster_id", "center"), top, block_bytes=block_bytes)
    return top, scratch(placed.select(F.col("id").alias("leaf"), F.col("cluster_id").alias("parent"), "distance"), "parents")


def _closest(queries: DataFrame, centers: DataFrame, probes: int, block_bytes: int) -> DataFrame:
    """qid, v and cluster_id of the `probes` nearest centroids of each query (id, v)."""
    found = []
    for ids, matrix in _blocks(centers, block_bytes):
        sent = queries.sparkSession.sparkContext.broadcast((ids, matrix))

        def near(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    names, m = sent.value
                    score = _matrix(batch.column("v"), batch.num_rows) @ m.T
                    order = np.argsort(-score, axis=1, kind="stable")[:, :probes]
                    at = np.repeat(np.arange(batch.num_rows), order.shape[1])
                    yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(at)), pa.array(names[order.reshape(-1)]), pa.array(score[at, order.reshape(-1)])], names=["id", "cluster_id", "score"])

        found.append(queries.select("id", "v").mapInArrow(near, "id long, cluster_id long, score double"))
    best = Window.partitionBy("id").orderBy(F.desc("score"), "cluster_id")
    each = reduce(DataFrame.unionByName, found).withColumn("_n", F.row_number().over(best)).where(F.col("_n") <= probes)
    return each.select("id", "cluster_id")


#: Folders that rows lie in by cluster.
FOLDERS = 64


def layout(assigned: DataFrame, path: str, *, folders: int = FOLDERS) -> None:
    """Write rows so that a query's clusters are few folders: by cluster_id modulo `folders`, sorted by cluster in each."""
    rows = assigned.withColumn("folder", F.pmod("cluster_id", F.lit(folders)).cast("int"))
    rows.repartition("folder", "cluster_id").sortWithinPartitions("folder", "cluster_id").write.partitionBy("folder").parquet(path)


def probe(laid: DataFrame, queries: DataFrame, centers: DataFrame, k: int, *, probes: int, parents: tuple[DataFrame, DataFrame] | None = None, parent_probes: int | None = None, block_bytes: int = BLOCK_BYTES, folders: int = FOLDERS, without_self: bool = True) -> DataFrame:
    """(qid, id, rank, score): the k rows of highest cosine in the `probes` clusters nearest to each query (id, v).

    With parents, leaves are looked for under the `parent_probes` nearest parents alone. Of the rows (id,
    v, cluster_id, folder) only the folders of those clusters are read; a task keeps k rows a query.
    """
    if parents is None:
        asked = _closest(queries, centers, probes, block_bytes)
    else:
        top, level = parents
        under = _closest(queries, top, parent_probes or probes, block_bytes).withColumnRenamed("cluster_id", "parent").join(F.broadcast(level) if level.count() * 32 <= block_bytes else level, "parent")
        leaves = under.select("id", F.col("leaf").alias("cluster_id")).join(queries.select("id", "v"), "id").join(centers, "cluster_id")
        score = F.aggregate(F.zip_with("v", "center", lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x)
        best = Window.partitionBy("id").orderBy(F.desc("score"), "cluster_id")
        asked = leaves.select("id", "cluster_id", score.alias("score")).withColumn("_n", F.row_number().over(best)).where(F.col("_n") <= probes).select("id", "cluster_id")
    asked = scratch(asked, "asked")
    wanted = asked.select(F.pmod("cluster_id", F.lit(folders)).cast("int").alias("folder")).distinct().collect()
    read = laid.where(F.col("folder").isin([r.folder for r in wanted])).join(asked.select("cluster_id").distinct(), "cluster_id", "left_semi")
    full = queries.select("id", "v").join(asked.groupBy("id").agg(F.collect_list("cluster_id").alias("clusters")), "id")
    width = queries.agg(F.max(F.size("v"))).first()[0] or 1
    count = max(1, -(-full.count() * 8 * (width + probes) // block_bytes))
    found = []
    for b in range(count):
        got = full.where(F.pmod(F.xxhash64("id"), F.lit(count)) == b).orderBy("id").toArrow().combine_chunks()
        if got.num_rows:
            found.append(_best_of(read, got, k, without_self))
    best = Window.partitionBy("qid").orderBy(F.desc("score"), "id")
    return reduce(DataFrame.unionByName, found).withColumn("rank", F.row_number().over(best).cast("long")).where(F.col("rank") <= k)


def _best_of(read: DataFrame, queries: pa.Table, k: int, without_self: bool) -> DataFrame:
    matrix, qids = _matrix(queries.column("v").combine_chunks(), queries.num_rows), queries.column("id").to_numpy()
    by_cluster: dict[int, list[int]] = {}
    for at, clusters in enumerate(queries.column("clusters").to_pylist()):
        for c in clusters:
            by_cluster.setdefault(c, []).append(at)
    sent = read.sparkSession.sparkContext.broadcast((matrix, qids, by_cluster))

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, names, asked = sent.value
        top: dict[int, list[tuple[float, int]]] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            x, ids, at = _matrix(batch.column("v"), batch.num_rows), batch.column("id").to_numpy(), batch.column("cluster_id").to_numpy()
            for c in np.unique(at).tolist():
                rows = np.flatnonzero(at == c)
                for q in asked.get(c, ()):
                    score = np.round(x[rows] @ m[q], 6)
                    keep = rows if not without_self else rows[ids[rows] != names[q]]
                    score = score if not without_self else score[ids[rows] != names[q]]
                    order = np.lexsort((ids[keep], -score))[:k]
                    top[q] = sorted([*top.get(q, ()), *zip((-score[order]).tolist(), ids[keep][order].tolist(), strict=True)])[:k]
        out = [(int(names[q]), i, -s) for q, held in top.items() for s, i in held]
        yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.int64()), pa.array([o[2] for o in out], pa.float64())], names=["qid", "id", "score"])

    return read.select("id", "v", "cluster_id").mapInArrow(best, "qid long, id long, score double")


def recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """One row: how many of the exact neighbours (qid, id) were found, as a share."""
    return exact.select("qid", "id").join(found.select("qid", "id", F.lit(1).alias("hit")), ["qid", "id"], "left").agg(F.round(F.avg(F.coalesce("hit", F.lit(0))), 4).alias("recall"))
