"""Tables in versions: a version is a list of files, new ones are written beside the old and the list last.

What reads a version sees all of it or, before its list is there, nothing; files that a change does
not touch are carried over by name. A change names the version it was made from and is refused
where another has come in between, so that running it again after a failure is safe.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.operators import clusters
from corpusloom.operators.graph import scratch

FOLDERS = 64


class Refused(ValueError):
    """A change that does not fit what is there."""


@dataclass(frozen=True)
class Version:
    number: int
    parent: int
    lineage: str
    rows: int
    rewritten: int
    carried: int
    note: str


def versions(spark: SparkSession, root: str) -> list[Version]:
    """The versions that are complete, oldest first; one short row each."""
    try:
        rows = spark.read.schema("value string").text(f"{root}/versions/*/done").collect()
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return []
        raise
    return sorted((Version(**json.loads(r.value)) for r in rows), key=lambda v: v.number)


def _version(spark: SparkSession, root: str, number: int | None) -> Version:
    held = {v.number: v for v in versions(spark, root)}
    if not held or (number is not None and number not in held):
        raise Refused(f"{root} has no version {number}")
    return held[max(held) if number is None else number]


def files(spark: SparkSession, root: str, number: int | None = None) -> DataFrame:
    """path of each file of a version (the last one if none is named)."""
    return spark.read.schema("path string").parquet(f"{root}/versions/{_version(spark, root, number).number}/files")


def _rows(spark: SparkSession, root: str, paths: list[str]) -> DataFrame:
    return spark.read.option("basePath", f"{root}/data").parquet(*paths)


def read(spark: SparkSession, root: str, number: int | None = None, *, folders: list[int] | None = None) -> DataFrame:
    """The rows of a version, of some of its folders alone if they are named. The driver holds the names of files."""
    listed = files(spark, root, number)
    if folders is not None:
        listed = listed.where(F.regexp_extract("path", r"/folder=(\d+)/", 1).cast("int").isin(folders))
    paths = [r.path for r in listed.collect()]
    if not paths:
        whole = [r.path for r in files(spark, root, number).limit(1).collect()] or [f"{root}/data"]
        return _rows(spark, root, whole).limit(0).drop("write")
    return _rows(spark, root, paths).drop("write")


def _commit(spark: SparkSession, root: str, parent: Version | None, kept: DataFrame | None, new: DataFrame, *, note: str) -> Version:
    """Write new rows (with folder) and then the list of a version that holds them and the files kept."""
    write, number = uuid.uuid4().hex, parent.number + 1 if parent else 1
    new.repartition("folder").write.partitionBy("folder").parquet(f"{root}/data/write={write}")
    try:
        written = spark.read.option("basePath", f"{root}/data").parquet(f"{root}/data/write={write}")
        named = written.select(F.col("_metadata.file_path").alias("path")).distinct()
        plain = [c for c in written.columns if c != "write"]
        rows, sums = written.agg(F.count("*"), F.expr(f"bit_xor(xxhash64({', '.join(f'`{c}`' for c in plain)}))")).first()
    except AnalysisException:
        # No row was left to write.
        named, rows, sums = spark.createDataFrame([], "path string"), 0, 0
    listed = scratch(named.unionByName(kept) if kept is not None else named, "files")
    carried = kept.count() if kept is not None else 0
    paths = [r.path for r in listed.collect()]
    total = _rows(spark, root, paths).count() if paths else 0
    lineage = hashlib.sha256(f"{parent.lineage if parent else ''}:{rows}:{sums}:{note}".encode()).hexdigest()
    version = Version(number, parent.number if parent else 0, lineage, total, len(paths) - carried, carried, note)
    # A folder that is there already is another writer's version: that is an error.
    listed.coalesce(1).write.parquet(f"{root}/versions/{number}/files")
    spark.createDataFrame([(json.dumps(version.__dict__),)], "value string").coalesce(1).write.text(f"{root}/versions/{number}/done")
    return version


def create(rows: DataFrame, root: str, folder: F.Column, *, note: str = "created") -> Version:
    """The first version: rows in folders by `folder`, an int column."""
    spark = rows.sparkSession
    if versions(spark, root):
        raise Refused(f"{root} has versions already")
    return _commit(spark, root, None, None, rows.withColumn("folder", folder.cast("int")), note=note)


def _current(spark: SparkSession, root: str, parent: int) -> Version:
    now = _version(spark, root, None)
    if now.number != parent:
        raise Refused(f"made from version {parent}, but {root} is at {now.number}")
    return now


def _holding(spark: SparkSession, root: str, keys: DataFrame, id_col: str) -> tuple[DataFrame, DataFrame]:
    """The files that hold a row of these keys, and the others."""
    listed = files(spark, root)
    paths = [r.path for r in listed.collect()]
    rows = _rows(spark, root, paths).select(F.col(id_col), F.col("_metadata.file_path").alias("path"))
    touched = scratch(rows.join(keys.select(id_col).distinct(), id_col, "left_semi").select("path").distinct(), "touched")
    return touched, listed.join(touched, "path", "left_anti")


def apply_delta(spark: SparkSession, root: str, parent: int, removed: DataFrame, added: DataFrame, centers: DataFrame | None = None, *, id_col: str = "id", vec_col: str = "v", folders: int = FOLDERS) -> tuple[Version, float | None]:
    """Take rows out and put rows in; what is added is placed on the centroids there are. Also gives its mean distance to them.

    removed: ids; each has to be there. added: rows of the table's columns (cluster_id and folder are
    set here if centroids are given, folder also where it is not there); no id may be there already unless it is removed. Only files
    with a removed row are written anew.
    """
    now = _current(spark, root, parent)
    gone = removed.select(id_col).distinct()
    there = read(spark, root)
    lost = gone.join(there, id_col, "left_anti").count()
    if lost:
        raise Refused(f"{lost} rows to remove are not in version {parent}")
    if added.groupBy(id_col).count().where("count > 1").count() or there.join(gone, id_col, "left_anti").join(added.select(id_col), id_col, "left_semi").count():
        raise Refused("rows to add are there already")
    far = None
    if centers is not None:
        placed = clusters.nearest(clusters.vectors(added, id_col, vec_col), centers).select(F.col("id").alias(id_col), "cluster_id", "distance")
        placed = scratch(placed, "placed")
        far = placed.agg(F.avg("distance")).first()[0]
        added = added.drop("cluster_id", "folder").join(placed.drop("distance"), id_col).withColumn("folder", F.pmod("cluster_id", F.lit(folders)).cast("int"))
    elif "folder" not in added.columns:
        added = added.withColumn("folder", F.pmod("cluster_id", F.lit(folders)).cast("int") if "cluster_id" in added.columns else F.lit(0))
    touched, kept = _holding(spark, root, gone, id_col)
    paths = [r.path for r in touched.collect()]
    stay = _rows(spark, root, paths).drop("write").join(gone, id_col, "left_anti") if paths else there.limit(0)
    new = stay.unionByName(added.select(*[F.col(c).cast(there.schema[c].dataType).alias(c) for c in there.columns]))
    return _commit(spark, root, now, kept, new, note="delta"), far


def relabel(spark: SparkSession, root: str, parent: int, changes: DataFrame, column: str, *, id_col: str = "id") -> Version:
    """Put new values into a column of some rows. changes: id, old, new; every row must still read its old value.

    Only files that hold a changed row are written anew, the others are carried.
    """
    now = _current(spark, root, parent)
    there = read(spark, root)
    met = changes.select(id_col, "old", "new").join(there.select(id_col, F.col(column).alias("_now")), id_col, "left")
    wrong = met.where(~F.col("_now").eqNullSafe(F.col("old"))).count()
    if wrong:
        raise Refused(f"{wrong} rows do not read their old {column}")
    touched, kept = _holding(spark, root, changes, id_col)
    paths = [r.path for r in touched.collect()]
    if not paths:
        return _commit(spark, root, now, kept, there.limit(0), note=f"relabel {column}")
    put = changes.select(id_col, F.col("new").alias("_new"), F.lit(True).alias("_hit"))
    rows = _rows(spark, root, paths).drop("write").join(put, id_col, "left")
    value = F.when(F.col("_hit"), F.col("_new").cast(there.schema[column].dataType)).otherwise(F.col(column))
    return _commit(spark, root, now, kept, rows.withColumn(column, value).select(*there.columns), note=f"relabel {column}")


def revert(spark: SparkSession, root: str, to: int) -> Version:
    """A new version that holds what version `to` held; no row is written."""
    now, old = _version(spark, root, None), files(spark, root, to)
    return _commit(spark, root, now, old, read(spark, root, to).limit(0), note=f"revert to {to}")
