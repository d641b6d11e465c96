"""Preflight reports over sealed bundles, and digests of ids in levels."""

import hashlib

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import bundle, records
from corpusloom.sources import preflight, tables


@pytest.fixture(scope="module")
def sealed(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("b") / "bundle")
    chunks = spark.range(20).select("id", F.when(F.col("id") > 0, "https://a/b").alias("source_url"))
    vectors = spark.range(20).select("id", F.array(F.lit(0.6), F.lit(0.8)).alias("embedding"))
    failed = spark.createDataFrame([("a", "empty"), ("b", "empty")], "key string, reason string")
    tables.seal(spark, root, {"chunks": chunks, "vectors": vectors}, {"dim": 2, "model": "m"}, failed=failed, canary=vectors.limit(1))
    return root


def states(df):
    return {r.check: r.status for r in df.collect()}


FULL = {"target_dim": 2, "deployed": {"dim": 2, "model": "m"}, "vector": [0.6, 0.8], "free_bytes": 1 << 40, "equal": [("chunks", "vectors")], "documents": "chunks", "tolerance": 0.1, "sourced": "vectors", "source_column": "id"}


def test_all_that_is_given_is_checked(spark, sealed):
    got = preflight.preflight(spark, sealed, **FULL)
    assert set(states(got).values()) == {"ok"} and preflight.passed(got)


def test_what_is_not_given_is_skipped_and_no_pass(spark, sealed):
    got = preflight.preflight(spark, sealed, tolerance=1)
    assert states(got) == {"manifest": "ok", "dimension": "skipped", "recipe": "skipped", "canary": "skipped", "completeness": "ok", "files": "ok", "room": "skipped", "provenance": "skipped"}
    assert not preflight.passed(got) and preflight.passed(got, allow_skipped=True)


@pytest.mark.parametrize(
    "change,check,status",
    [
        ({"target_dim": 3}, "dimension", "fail"),
        ({"deployed": {"model": "n"}}, "recipe", "fail"),
        ({"vector": [0.8, -0.6]}, "canary", "fail"),
        ({"vector": [0.6, 0.8, 0.0]}, "canary", "fail"),
        ({"vector": [0.0, 0.0]}, "canary", "fail"),
        ({"tolerance": 0.09}, "completeness", "fail"),
        ({"free_bytes": 10}, "room", "fail"),
        ({"sourced": "chunks", "source_column": "source_url"}, "provenance", "fail"),
        ({"sourced": "chunks", "source_column": "source_url", "allow_no_source": True}, "provenance", "skipped"),
    ],
)
def test_one_thing_wrong(spark, sealed, change, check, status):
    got = states(preflight.preflight(spark, sealed, **FULL | change))
    assert got.pop(check) == status and set(got.values()) == {"ok"}


def test_files_that_are_new_or_altered(spark, tmp_path):
    root = str(tmp_path / "x")
    assert states(preflight.preflight(spark, root)) == {"manifest": "fail"}
    tables.seal(spark, root, {"chunks": spark.range(3)}, {"dim": 1})
    spark.range(1).coalesce(1).write.mode("append").parquet(f"{root}/chunks")
    got = {r.check: (r.status, r.detail) for r in preflight.preflight(spark, root).collect()}
    assert got["files"][0] == "fail" and got["files"][1].startswith("1 new: chunks/") and got["completeness"] == ("fail", "chunks: 4 rows, 3 by the manifest") and got["canary"][0] == "fail"


def test_files_are_hashed_in_many_tasks(spark, tmp_path, monkeypatch):
    plain, root = tables.checksums, str(tmp_path / "x")
    # The task stands where a file's size would be.
    monkeypatch.setattr(tables, "checksums", lambda *a: plain(*a).withColumn("bytes", F.spark_partition_id().cast("long")))
    held = tables.seal(spark, root, {"chunks": spark.range(80).repartition(8)}, {"dim": 1})
    sums = spark.read.parquet(f"{root}/_checksums").collect()
    assert len({r.bytes for r in sums}) > 1 and len(list(tmp_path.glob("x/_checksums/*.parquet"))) == 1
    by = {}
    for r in sums:
        by.setdefault(r.rel.split("/")[0], {}).setdefault(r.sha256[:3], []).append(r.sha256)
    digest = lambda x: hashlib.sha256(",".join(sorted(x)).encode()).hexdigest()
    assert held.checksums == {part: digest([digest(v) for v in cells.values()]) for part, cells in by.items()}


def test_source_hash_in_levels(spark):
    ids = [*(f"id-{k}" for k in range(300)), None]
    df = spark.createDataFrame([(i,) for i in [*ids, "id-1"]], "id string").repartition(5)

    def digest(parts):
        return hashlib.sha256(",".join(parts).encode()).hexdigest()

    for bucket, digits in ((1000, 0), (20, 1), (1, 3), (0.05, 4)):
        cells = {}
        for i in sorted(x or "" for x in ids):
            cells.setdefault(hashlib.sha256(i.encode()).hexdigest()[:digits], []).append(i)
        level, n = {a: digest(v) for a, v in cells.items()}, len(cells)
        if digits > 3:
            up = {}
            for a in sorted(level):
                up.setdefault(a[: digits - 3], []).append(level[a])
            level = {a: digest(v) for a, v in up.items()}
        (got,) = bundle.source_hash(df, bucket=bucket).collect()
        assert (got.source_hash, got.buckets) == (digest([level[a] for a in sorted(level)]), n), bucket
    assert bundle.source_hash(df.limit(0)).first().buckets == 0


def test_chunk_report_of_a_hot_group(spark):
    rows = [("a", n % 7, f"t{n % 9}") for n in range(1000)] + [("b", 1, " "), ("b", None, None), (None, 5, "x"), (None, 9, "x"), (None, 7, "y")]
    got = {r.g: (r.chunks, r.empty, r.repeated, r.median_tokens) for r in records.chunk_report(spark.createDataFrame(rows, "g string, n int, t string"), [F.col("g")], "n", "t").collect()}
    sizes = sorted(n % 7 for n in range(1000))
    assert got == {"a": (1000, 0, 991, sizes[500]), "b": (2, 2, 0, None), None: (3, 0, 1, 7)}
