"""Results of stages under their settings: complete generations, the newest of them, and shards that are done already."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.plans.specs import canonical, generation


@dataclass(frozen=True)
class Generation:
    """A complete run of a stage. order: newer ones are larger."""

    path: str
    stage: str
    settings: str
    rows: int
    order: int


def write(rows: DataFrame, root: str, stage: str, settings: Mapping[str, Any], *, order: int | None = None) -> Generation:
    """Write a stage's rows under its settings, and the marker last; what an unfinished run left is written anew.

    A complete generation of the same settings is kept as it is and returned.
    """
    spark, path = rows.sparkSession, generation(root, stage, settings)
    for held in complete(spark, root, stage):
        if held.settings == canonical(dict(settings)):
            return held
    rows.write.mode("overwrite").parquet(f"{path}/rows")
    done = Generation(path, stage, canonical(dict(settings)), spark.read.parquet(f"{path}/rows").count(), time.time_ns() if order is None else order)
    spark.createDataFrame([(json.dumps(done.__dict__),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/done")
    return done


def _text(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.schema("value string").text(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def complete(spark: SparkSession, root: str, stage: str) -> list[Generation]:
    """The generations of a stage that have their marker, newest first."""
    marks = _text(spark, f"{root.rstrip('/')}/{stage}/*/done")
    found = [Generation(**json.loads(r.value)) for r in marks.collect()] if marks is not None else []
    return sorted(found, key=lambda g: (-g.order, g.path))


def newest(spark: SparkSession, root: str, stage: str, settings: Mapping[str, Any] | None = None) -> Generation:
    """The newest complete generation, of these settings if they are named; none is an error."""
    found = [g for g in complete(spark, root, stage) if settings is None or g.settings == canonical(dict(settings))]
    if not found:
        raise LookupError(f"no complete generation of {stage} under {root}")
    return found[0]


def read(spark: SparkSession, held: Generation, *, keys: DataFrame | None = None) -> DataFrame:
    """The rows of a generation, those of some keys alone if given; refused if their number is not what the marker says."""
    rows = spark.read.parquet(f"{held.path}/rows")
    there = rows.count()
    if there != held.rows:
        raise ValueError(f"{held.path} holds {there} rows, its marker says {held.rows}: files of runs are mixed")
    return rows if keys is None else rows.join(keys, keys.columns, "left_semi")


def clear(spark: SparkSession, root: str, stage: str, keep: int = 1) -> list[str]:
    """Delete all but the newest complete generations of a stage, unfinished ones too; the paths that are gone."""
    kept = {g.path for g in complete(spark, root, stage)[:keep]}
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{stage}")
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    gone = []
    for state in files.listStatus(folder) if files.exists(folder) else ():
        path = f"{root.rstrip('/')}/{stage}/{state.getPath().getName()}"
        if path not in kept and state.isDirectory():
            files.delete(state.getPath(), True)
            gone.append(path)
    return sorted(gone)


def done_shards(spark: SparkSession, path: str) -> DataFrame:
    """shard, attempt and rows of the shards that are complete."""
    marks = _text(spark, f"{path}/marks")
    schema = "shard string, attempt string, rows long"
    if marks is None:
        return spark.createDataFrame([], schema)
    # A shard that two runs made counts once.
    return marks.select(F.from_json("value", schema).alias("m")).select("m.*").groupBy("shard").agg(F.min(F.struct("attempt", "rows")).alias("m")).select("shard", "m.*")


def transform_shards(rows: DataFrame, shard_col: str, transform: Callable[[DataFrame], DataFrame], path: str) -> int:
    """Transform the shards that are not done yet and mark them; how many there were.

    transform keeps the column of the shard. A run writes to a folder of its own and its marks come
    last, so what a run that was lost has written is never read. A shard may give no rows.
    """
    spark, attempt = rows.sparkSession, uuid.uuid4().hex
    named = F.col(shard_col).cast("string")
    left = rows.join(done_shards(spark, path).select(F.col("shard").alias("_shard")), named == F.col("_shard"), "left_anti")
    shards = left.select(named.alias("shard")).distinct()
    count = shards.count()
    if not count:
        return 0
    made = transform(left).withColumn("_shard", named)
    made.write.parquet(f"{path}/data/attempt={attempt}")
    sizes = spark.read.parquet(f"{path}/data/attempt={attempt}").groupBy(F.col("_shard").alias("shard")).agg(F.count("*").alias("rows"))
    marks = shards.join(sizes, "shard", "left").select(F.to_json(F.struct("shard", F.lit(attempt).alias("attempt"), F.coalesce("rows", F.lit(0)).alias("rows"))).alias("value"))
    marks.coalesce(1).write.mode("append").text(f"{path}/marks")
    return count


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """The rows of all shards that are done."""
    marks = done_shards(spark, path)
    held = [r.attempt for r in marks.select("attempt").distinct().collect()]
    if not held:
        raise LookupError(f"no shard under {path} is done")
    rows = spark.read.option("basePath", f"{path}/data").parquet(*[f"{path}/data/attempt={a}" for a in held])
    return rows.join(marks.select(F.col("shard").alias("_shard"), "attempt"), ["_shard", "attempt"], "left_semi").drop("_shard", "attempt")
