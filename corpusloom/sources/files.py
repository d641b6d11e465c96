"""Files as tables: scans with hashes, manifests, shards and generations of stored rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.operators.mirror import fetch_states

#: Fixed types by name.
MIME = {"html": "text/html", "htm": "text/html", "md": "text/markdown", "txt": "text/plain", "xml": "application/xml", "json": "application/json", "pdf": "application/pdf", "parquet": "application/vnd.apache.parquet"}


def mime_of(path):
    """A file's type by its suffix, in either case."""
    known = F.create_map(*[F.lit(x) for pair in MIME.items() for x in pair])
    return F.coalesce(F.try_element_at(known, F.lower(F.regexp_extract(path, r"\.([^./]+)$", 1))), F.lit("application/octet-stream"))


def scan(spark: SparkSession, root: str, pattern: str = "*", *, only: DataFrame | None = None) -> DataFrame:
    """(path, rel, sha256, bytes, mime, modified) of files under root, hidden ones left out.

    The paths are as Spark names them, so root may be in any store that Spark reads. With `only`
    (rel), files that are listed alone.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(root)
    base = root.rstrip("/").split(":", 1)[-1].lstrip("/")
    rel = F.regexp_replace(F.col("path"), "^.*?" + base.replace(".", r"\.") + "/+", "")
    out = files.select("path", rel.alias("rel"), F.sha2("content", 256).alias("sha256"), F.col("length").alias("bytes"), mime_of(F.col("path")).alias("mime"), F.col("modificationTime").alias("modified"))
    out = out.where(~F.col("rel").rlike(r"(?:^|/)[._]"))
    return out if only is None else out.join(only.select("rel").distinct(), "rel", "left_semi")


def either_case(glob: str) -> str:
    """A glob whose suffix is met in either case: `*.xml` also finds `A.XML`."""
    stem, dot, suffix = glob.rpartition(".")
    if not dot or "/" in suffix:
        return glob
    return f"{stem}." + "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in suffix)


def find(spark: SparkSession, roots: Sequence[str], globs: Sequence[str]) -> DataFrame:
    """(path, bytes, modified) of files under any of the roots that a glob names, each once, in order of path.

    Roots may be in any store that Spark reads. Suffixes count in either case; hidden files are left out.
    Nothing but the listing is read. Roots that lie in each other give a file once.
    """
    found = None
    for root in roots:
        for glob in globs:
            one = spark.read.format("binaryFile").option("pathGlobFilter", either_case(glob)).option("recursiveFileLookup", "true").load(root).select("path", F.col("length").alias("bytes"), F.col("modificationTime").alias("modified"))
            found = one if found is None else found.unionByName(one)
    if found is None:
        raise ValueError("no root or no glob is named")
    return found.where(~F.regexp_extract("path", r"([^/]*)$", 1).rlike(r"^[._]")).dropDuplicates(["path"]).orderBy("path")


def write_snapshot(wanted: DataFrame, present: DataFrame, path: str) -> int:
    """Write the list of what was wanted, once all of it is there in the right size; how many files it has.

    wanted and present: rel, size. What is missing or of another size is an error that names some of it.
    """
    states = fetch_states(wanted, present).where("state IN ('missing', 'conflict')")
    some = states.orderBy("state", "rel").limit(5).collect()
    if some:
        raise ValueError(f"{states.count()} files are not as listed: " + ", ".join(f"{r.rel} {r.state}" for r in some))
    listed = wanted.select("rel").distinct()
    listed.orderBy("rel").coalesce(1).select(F.col("rel").alias("value")).write.text(path)
    return listed.count()


def missing(listed: DataFrame, files: DataFrame) -> DataFrame:
    """Listed files that were not found."""
    return listed.select("rel").distinct().join(files, "rel", "left_anti")


def read_list(spark: SparkSession, path: str) -> DataFrame:
    """(rel) of a list of paths: blank lines and what follows # are left out."""
    return spark.read.text(path).select(F.trim(F.regexp_replace("value", "#.*$", "")).alias("rel")).where("rel <> ''")


def report(files: DataFrame) -> DataFrame:
    """Files, distinct contents, copies and bytes by type."""
    return files.groupBy("mime").agg(F.count("*").alias("files"), F.countDistinct("sha256").alias("contents"), (F.count("*") - F.countDistinct("sha256")).alias("copies"), F.sum("bytes").alias("bytes"))


def write_manifest(files: DataFrame, path: str) -> None:
    files.write.mode("overwrite").json(path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("path string, rel string, sha256 string, bytes long, mime string, modified timestamp").json(path)


def write_shards(rows: DataFrame, path: str, *, sort: Sequence[str] = (), per_file: int = 100_000) -> None:
    """One generation of rows as compressed files of bounded length; a run again replaces it."""
    ordered = rows.sortWithinPartitions(*sort) if sort else rows
    ordered.write.mode("overwrite").option("compression", "zstd").option("maxRecordsPerFile", per_file).parquet(path)


def write_vectors(rows: DataFrame, path: str, dimension: int) -> None:
    """Vectors as arrays of float, refused if one has another width."""
    checked = rows.withColumn("embedding", F.when(F.size("embedding") == dimension, F.col("embedding").cast("array<float>")).otherwise(F.raise_error(F.lit("a vector has another width")).cast("array<float>")))
    write_shards(checked, path)


def load_queries(spark: SparkSession, path: str) -> DataFrame:
    """(qid, query, type, relevant) from a JSON array, an object with `queries`, or one object a line."""
    kind = "struct<qid:string,query:string,type:string,relevant:array<struct<doc:string,locator:string,grade:int>>>"
    whole = spark.read.text(path, wholetext=True)
    listed = F.from_json("value", f"array<{kind}>", {"mode": "PERMISSIVE"})
    inside = F.from_json("value", f"struct<queries:array<{kind}>>")["queries"]
    lines = F.transform(F.filter(F.split("value", "\n"), lambda x: F.trim(x) != ""), lambda x: F.from_json(x, kind))
    start = F.left(F.ltrim("value"), F.lit(1))
    rows = F.when(start == "[", listed).when(F.col("value").rlike(r'^\s*\{\s*"queries"'), inside).otherwise(lines)
    return whole.select(F.explode(rows).alias("q")).select("q.*")
