"""Tables in versions, generations and shards: what is refused, what a lost run leaves, what is carried."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.operators import clusters
from corpusloom.sources import generations, snapshots


def ids(df):
    return sorted(r.id for r in df.select("id").collect())


@pytest.fixture
def served(spark, tmp_path):
    rows = spark.range(40).select("id", F.array(F.cos("id"), F.sin("id")).alias("v"), (F.col("id") % 5).alias("cluster_id"), F.lit("old").alias("tag"))
    root = str(tmp_path / "served")
    snapshots.create(rows, root, F.pmod("cluster_id", F.lit(4)))
    return root, rows


def test_delta_and_revert(spark, served):
    root, rows = served
    none = rows.limit(0)
    version, far = snapshots.apply_delta(spark, root, 1, rows.where("id IN (1, 6, 11)").select("id"), none)
    assert (version.number, version.rows, far) == (2, 37, None) and version.rewritten == 1 and version.carried == 3
    assert ids(snapshots.read(spark, root)) == [i for i in range(40) if i not in (1, 6, 11)] and len(ids(snapshots.read(spark, root, 1))) == 40
    centers = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [-1.0, 0.0])], "cluster_id long, center array<double>")
    more = spark.createDataFrame([(100, [0.9, 0.1], None, "new"), (101, [-2.0, 0.1], None, "new")], "id long, v array<double>, cluster_id long, tag string")
    version, far = snapshots.apply_delta(spark, root, 2, none.select("id"), more, centers, folders=4)
    got = {r.id: (r.cluster_id, r.folder, r.tag) for r in snapshots.read(spark, root).where("id >= 100").collect()}
    assert got == {100: (0, 0, "new"), 101: (2, 2, "new")} and version.rows == 39 and 0 <= far < 0.1
    back = snapshots.revert(spark, root, 1)
    assert back.rows == 40 and back.rewritten == 0 and ids(snapshots.read(spark, root)) == list(range(40))
    assert [v.parent for v in snapshots.versions(spark, root)] == [0, 1, 2, 3] and len({v.lineage for v in snapshots.versions(spark, root)}) == 4
    assert ids(snapshots.read(spark, root, folders=[1])) == [i for i in range(40) if i % 5 == 1]


def test_changes_that_do_not_fit_are_refused(spark, served):
    root, rows = served
    none = rows.limit(0)
    with pytest.raises(snapshots.Refused, match="made from version 7"):
        snapshots.apply_delta(spark, root, 7, none.select("id"), none)
    with pytest.raises(snapshots.Refused, match="1 rows to remove"):
        snapshots.apply_delta(spark, root, 1, spark.createDataFrame([(3,), (99,)], "id long"), none)
    with pytest.raises(snapshots.Refused, match="there already"):
        snapshots.apply_delta(spark, root, 1, none.select("id"), snapshots.read(spark, root).where("id = 3"))
    with pytest.raises(snapshots.Refused, match="versions already"):
        snapshots.create(rows, root, F.lit(0))
    with pytest.raises(snapshots.Refused, match="no version 9"):
        snapshots.read(spark, root, 9)
    again = snapshots.apply_delta(spark, root, 1, rows.where("id = 3").select("id"), snapshots.read(spark, root).where("id = 3").withColumn("tag", F.lit("again")))
    assert again[0].rows == 40 and snapshots.read(spark, root).where("tag = 'again'").count() == 1


def test_a_run_that_was_lost_leaves_nothing_to_read(spark, served):
    root, rows = served
    # Files without a list, and a list without its marker.
    rows.withColumn("folder", F.lit(1)).write.partitionBy("folder").parquet(f"{root}/data/write=lost")
    assert len(ids(snapshots.read(spark, root))) == 40 and len(snapshots.versions(spark, root)) == 1


def test_relabel_carries_other_files(spark, served):
    root, rows = served
    changes = rows.where("id IN (0, 5, 4)").select("id", F.col("tag").alias("old"), F.lit("put").alias("new"))
    version = snapshots.relabel(spark, root, 1, changes, "tag")
    assert (version.rewritten, version.carried, version.rows) == (1, 3, 40)
    assert ids(snapshots.read(spark, root).where("tag = 'put'")) == [0, 4, 5]
    with pytest.raises(snapshots.Refused, match="3 rows do not read"):
        snapshots.relabel(spark, root, 2, changes, "tag")
    assert snapshots.relabel(spark, root, 2, changes.limit(0), "tag").rewritten == 0


def test_all_rows_can_go(spark, served):
    root, rows = served
    version, _ = snapshots.apply_delta(spark, root, 1, rows.select("id"), rows.limit(0))
    assert version.rows == 0 and snapshots.read(spark, root).count() == 0


def test_generations(spark, tmp_path):
    root = str(tmp_path / "g")
    with pytest.raises(LookupError):
        generations.newest(spark, root, "chunk")
    a = generations.write(spark.range(3), root, "chunk", {"size": 1})
    b = generations.write(spark.range(5), root, "chunk", {"size": 2})
    assert generations.newest(spark, root, "chunk") == b and generations.newest(spark, root, "chunk", {"size": 1}) == a
    # The same settings again give what is there.
    assert generations.write(spark.range(9), root, "chunk", {"size": 1}) == a and generations.read(spark, a).count() == 3
    spark.range(7).write.parquet(f"{root}/chunk/half/rows")
    assert generations.clear(spark, root, "chunk", keep=1) == sorted([a.path, f"{root}/chunk/half"])
    assert generations.complete(spark, root, "chunk") == [b]
    spark.range(1).write.mode("append").parquet(f"{b.path}/rows")
    with pytest.raises(ValueError, match="mixed"):
        generations.read(spark, b)


def test_shards_are_transformed_once(spark, tmp_path):
    path, rows, seen = str(tmp_path / "s"), spark.range(30).withColumn("part", F.col("id") % 6), []

    def double(df):
        seen.append(df.select("part").distinct().count())
        return df.where("part <> 5").withColumn("twice", F.col("id") * 2)

    with pytest.raises(LookupError):
        generations.read_shards(spark, path)
    assert generations.transform_shards(rows.where("part < 2"), "part", double, path) == 2
    # What a lost run wrote has no mark and is not read.
    rows.withColumn("twice", F.lit(-1)).withColumn("_shard", F.lit("3")).write.parquet(f"{path}/data/attempt=lost")
    assert generations.transform_shards(rows, "part", double, path) == 4
    assert generations.transform_shards(rows, "part", double, path) == 0 and seen == [2, 4]
    got = generations.read_shards(spark, path)
    assert sorted((r.id, r.twice) for r in got.collect()) == [(i, 2 * i) for i in range(30) if i % 6 != 5]
    assert {r.shard: r.rows for r in generations.done_shards(spark, path).collect()} == {str(s): 5 * (s != 5) for s in range(6)}


def test_placing_follows_the_centroids(spark, served):
    root, rows = served
    centers = clusters.fit(rows, 3, id_col="id", vec_col="v")
    more = rows.where("id < 6").withColumn("id", F.col("id") + 500)
    snapshots.apply_delta(spark, root, 1, rows.limit(0).select("id"), more, centers, folders=4)
    c = np.array([r.center for r in centers.orderBy("cluster_id").collect()])
    for r in snapshots.read(spark, root).where("id >= 500").collect():
        assert r.cluster_id == int((c @ np.array(r.v)).argmax())
