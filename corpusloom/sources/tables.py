"""Tables of a bundle with fixed schemas, rows by position, and bundles that are sealed by their manifest."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.plans.specs import Manifest
from corpusloom.sources.files import scan, write_shards

#: Fixed columns of the tables that stand beside the chunks.
SIDECARS = {
    "domains": "chunk_id string, domain string, similarity float",
    "clusters": "chunk_id string, cluster int, distance float",
    "edges": "source string, target string, weight int",
    "relations": "doc_id string, relation string, target string, partial boolean, mentions int, evidence string",
    "doc_status": "doc_id string, status string, by string",
    "doc_quality": "doc_id string, verdict string, damaged_share float, reasons array<string>",
    "signals": "chunk_id string, signals string",
}


def typed(rows: DataFrame, kind: str) -> DataFrame:
    """The columns of a kind in their order and types. A missing column, or a value of another type, is refused.

    Of signals all columns but chunk_id become one JSON text. Other extra columns are left out.
    """
    if kind not in SIDECARS:
        raise ValueError(f"no table is named {kind}; there are {', '.join(sorted(SIDECARS))}")
    if kind == "signals" and "signals" not in rows.columns:
        rows = rows.select("chunk_id", F.to_json(F.struct(*[c for c in sorted(rows.columns) if c != "chunk_id"])).alias("signals"))
    schema = T.StructType.fromDDL(SIDECARS[kind])
    lacking = [f.name for f in schema if f.name not in rows.columns]
    if lacking:
        raise ValueError(f"{kind} lacks {', '.join(lacking)}")
    return rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def write_sidecar(rows: DataFrame, kind: str, path: str) -> None:
    write_shards(typed(rows, kind), path)


def read_sidecar(spark: SparkSession, kind: str, path: str) -> DataFrame:
    return spark.read.schema(SIDECARS[kind]).parquet(path)


def positions(rows: DataFrame, order: str, *, parts: int = 1024) -> DataFrame:
    """Add position, the row's place from 0 by a number that is distinct: counted in parts, which are then added up.

    The cuts between parts are quantiles; where they fall changes no position. Null orders come first.
    """
    # At most parts - 1 numbers.
    cuts = rows.agg(F.percentile_approx(order, [i / parts for i in range(1, parts)], 10 * parts).alias("cuts")).first()["cuts"] or []
    below = F.array(*[F.lit(c) for c in sorted(set(cuts))])
    placed = rows.withColumn("_part", F.coalesce(F.size(F.filter(below, lambda c: c <= F.col(order))), F.lit(-1)))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # At most parts + 1 rows.
    starts = placed.groupBy("_part").agg(F.count("*").alias("_n")).select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    at = F.row_number().over(Window.partitionBy("_part").orderBy(F.col(order).asc_nulls_first()))
    return placed.join(F.broadcast(starts), "_part").withColumn("position", F.col("_start") + at - 1).drop("_part", "_start")


def row_range(stored: DataFrame, start: int, stop: int) -> DataFrame:
    """Rows from position start up to stop, which the reader can push down to the files."""
    return stored.where((F.col("position") >= start) & (F.col("position") < stop))


def aligned(vectors: DataFrame, chunks: DataFrame, dimension: int) -> DataFrame:
    """(position, problem) where a stored vector is not the one of the chunk at its place, or has another width."""
    both = chunks.select("position", F.col("chunk_id").alias("_chunk")).join(vectors.select("position", "chunk_id", "embedding"), "position", "full_outer")
    problem = (
        F.when(F.col("_chunk").isNull(), "no chunk")
        .when(F.col("chunk_id").isNull(), "no vector")
        .when(F.col("_chunk") != F.col("chunk_id"), "another chunk")
        .when(F.coalesce(F.size("embedding"), F.lit(-1)) != dimension, "another width")
    )
    return both.select("position", problem.alias("problem")).where("problem is not null")


def _exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.text(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def checksums(spark: SparkSession, path: str) -> DataFrame:
    """(rel, sha256, bytes) of the stored files of a bundle, hashed where they are read."""
    return scan(spark, path, "*.{parquet,json}").select("rel", "sha256", "bytes")


def seal(spark: SparkSession, path: str, parts: Mapping[str, DataFrame], recipe: Mapping[str, Any], *, equal: Sequence[tuple[str, str]] = (), failed: DataFrame | None = None, canary: DataFrame | None = None) -> Manifest:
    """Write a bundle: its parts, the failed rows (also if there are none), a reference row, and the manifest last.

    A path with a manifest is refused; without one, what lies there is from a run that did not end and is
    written anew. `equal` names parts that must have as many rows as each other.
    """
    root = path.rstrip("/")
    if _exists(spark, f"{root}/manifest"):
        raise ValueError(f"{root} is sealed already")
    counts = {}
    for name, rows in parts.items():
        write_shards(rows, f"{root}/{name}")
        counts[name] = spark.read.parquet(f"{root}/{name}").count()
    for a, b in equal:
        if counts[a] != counts[b]:
            raise ValueError(f"{a} has {counts[a]} rows and {b} has {counts[b]}")
    none = spark.createDataFrame([], "key string, reason string")
    (none if failed is None else failed).write.mode("overwrite").json(f"{root}/failed")
    if canary is not None:
        canary.limit(1).write.mode("overwrite").json(f"{root}/reference")
    # One row a file, gathered after the files are hashed in as many tasks as they fill; the manifest
    # holds what the files' hashes give together, the table each of them.
    checksums(spark, root).repartition(1).write.mode("overwrite").parquet(f"{root}/_checksums")
    sums = spark.read.parquet(f"{root}/_checksums")
    together = lambda c: F.sha2(F.array_join(F.array_sort(F.collect_list(c)), ","), 256)
    # In two steps, so that no group holds all files of a part.
    some = sums.groupBy(F.substring_index("rel", "/", 1).alias("part"), F.substring("sha256", 1, 3).alias("cell")).agg(together("sha256").alias("sum"))
    whole = some.groupBy("part").agg(together("sum").alias("sum"))
    manifest = Manifest(recipe=dict(recipe), counts=counts, checksums={r.part: r["sum"] for r in whole.collect()})
    spark.createDataFrame([(manifest.to_json(),)], "value string").coalesce(1).write.text(f"{root}/manifest")
    return manifest


def damaged(spark: SparkSession, path: str) -> DataFrame:
    """(rel, problem) of files of a sealed bundle that are gone, new or altered."""
    root = path.rstrip("/")
    said = spark.read.parquet(f"{root}/_checksums").select("rel", F.col("sha256").alias("_said"))
    there = checksums(spark, root)
    both = said.join(there.select("rel", "sha256"), "rel", "full_outer").where(~F.col("rel").startswith("manifest/"))
    problem = F.when(F.col("sha256").isNull(), "gone").when(F.col("_said").isNull(), "new").when(F.col("_said") != F.col("sha256"), "altered")
    return both.select("rel", problem.alias("problem")).where("problem is not null")


def promote(spark: SparkSession, path: str, entries: DataFrame) -> None:
    """Append entries to a log of what was promoted."""
    entries.write.mode("append").json(path)


def promotions(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The log's entries; none if nothing was promoted yet."""
    return spark.read.schema(schema).json(path) if _exists(spark, path) else spark.createDataFrame([], schema)
