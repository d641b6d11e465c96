"""Corpus bundles as tables: checks of id sets, deltas, relabelling, loading and verification."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: So many ids, or digests of the level below, are digested together.
BUCKET = 4096


def id_checks(chunks: DataFrame, vectors: DataFrame) -> DataFrame:
    """Rows (check, problems) over two tables with a column id: repeated ids, and ids of one only."""
    repeated = lambda t, name: t.groupBy("id").count().agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("problems")).select(F.lit(name).alias("check"), "problems")
    lone = lambda a, b, name: a.select("id").distinct().join(b.select("id"), "id", "left_anti").agg(F.count("*").alias("problems")).select(F.lit(name).alias("check"), "problems")
    parts = [repeated(chunks, "repeated chunk"), repeated(vectors, "repeated vector"), lone(chunks, vectors, "chunk without vector"), lone(vectors, chunks, "vector without chunk")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


def source_hash(ids: DataFrame, *, bucket: int = BUCKET) -> DataFrame:
    """One digest of all distinct ids, in levels, and how many cells they lie in at first.

    A cell are the ids whose SHA-256 begins alike, by as many digits as leave about `bucket` ids in
    each, whatever the ids are; three digits fewer are a cell of the next level, of 4096 digests at most.
    """

    def together(order: str, text: Column) -> Column:
        return F.sha2(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(F.col(order).alias("o"), text.alias("t")))), lambda x: x["t"]), ","), 256)

    text = F.coalesce(F.col("id").cast("string"), F.lit(""))
    some = ids.select("id").distinct().withColumn("_sha", F.sha2(text, 256))
    cells, digits = some.count() / bucket, 0
    while 16**digits < cells:
        digits += 1
    level = some.groupBy(F.substring("_sha", 1, digits).alias("a")).agg(together("id", text).alias("h"), F.lit(1).cast("long").alias("n"))
    while digits > 3:
        digits -= 3
        level = level.groupBy(F.substring("a", 1, digits).alias("a")).agg(together("a", F.col("h")).alias("h"), F.sum("n").alias("n"))
    return level.agg(together("a", F.col("h")).alias("source_hash"), F.coalesce(F.sum("n"), F.lit(0)).alias("buckets"))


def keep_sidecar(rows: DataFrame, held: DataFrame, key: str, order: list[Column], *, unique: bool = True) -> DataFrame:
    """Sidecar rows of documents that the bundle holds; of each document the first, if unique."""
    kept = rows.join(held.select(key).distinct(), key, "left_semi")
    if not unique:
        return kept
    return kept.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where("_n = 1").drop("_n")


def delta(old: DataFrame, new: DataFrame, key: str, url: str) -> DataFrame:
    """(key, change) of two document lists: added, removed, replaced (removed, its URL is added again) or same."""
    a, b = old.select(key, F.col(url).alias("old_url")), new.select(key, F.col(url).alias("new_url"))
    both = a.join(b, key, "full_outer")
    back = both.where("old_url is null").select(F.col("new_url").alias("old_url"), F.lit(True).alias("again")).distinct()
    change = F.when(F.col("old_url").isNull(), "added").when(F.col("new_url").isNotNull(), "same").when(F.col("again"), "replaced").otherwise("removed")
    return both.join(back, "old_url", "left").select(key, change.alias("change"))


def sidecar_changes(old: DataFrame, new: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Keys whose rows differ as multisets: those with different counts of some distinct row."""
    count = lambda t, name: t.groupBy(key, *columns).agg(F.count("*").alias(name))
    both = count(old, "was").join(count(new, "is"), [key, *columns], "full_outer")
    return both.where(~F.col("was").eqNullSafe(F.col("is"))).groupBy(key).agg(F.coalesce(F.sum("was"), F.lit(0)).alias("old_rows"), F.coalesce(F.sum("is"), F.lit(0)).alias("new_rows"))


def relabel(rows: DataFrame, chapter: Column, article: Column, body: Column, *, region: str, article_like: str, opens: str) -> DataFrame:
    """Rows whose chapter becomes the explanation region: old and new label of those that change."""
    moved = article.rlike(f"^(?:{article_like})") & ~F.coalesce(chapter.startswith(region), F.lit(False)) & body.rlike(f"^(?:{opens})")
    return rows.withColumn("old_chapter", chapter).withColumn("new_chapter", F.when(moved, F.concat_ws(" / ", F.lit(region), chapter))).where("new_chapter is not null")


def merge(stage: DataFrame, vectors: DataFrame, optional: list[DataFrame], key: str) -> DataFrame:
    """The load: staged rows with their vectors, and what else there is of them."""
    out = stage.join(vectors, key)
    for extra in optional:
        out = out.join(extra, key, "left")
    return out


def layout_problems(chunks: DataFrame, layout: DataFrame) -> DataFrame:
    """Servable rows that the layout lacks, rows it holds in vain, and rows in another cluster."""
    fit = chunks.where("indexable and cluster_id is not null").select("id", F.col("cluster_id").alias("want"))
    both = fit.join(layout.select("id", F.col("cluster_id").alias("got")), "id", "full_outer")
    return both.agg(F.count_if(F.col("got").isNull()).alias("missing"), F.count_if(F.col("want").isNull()).alias("stale"), F.count_if(F.col("want") != F.col("got")).alias("moved"))


def sync_layout(chunks: DataFrame, layout: DataFrame, partitions: int) -> DataFrame:
    """The layout that serves the chunks: rows laid out by cluster, in order inside it."""
    fit = chunks.where("indexable and cluster_id is not null").select("id", "cluster_id")
    kept = layout.join(fit, ["id", "cluster_id"], "left_semi").select("id", "cluster_id")
    new = fit.join(kept, ["id", "cluster_id"], "left_anti")
    return kept.unionByName(new).repartitionByRange(partitions, "cluster_id").sortWithinPartitions("cluster_id", "id")


def checksums(recorded: DataFrame, found: DataFrame) -> DataFrame:
    """(path, status) of files that are altered, missing or untracked; sound files give no row."""
    both = recorded.select("path", F.col("sha256").alias("want")).join(found.select("path", F.col("sha256").alias("got")), "path", "full_outer")
    status = F.when(F.col("got").isNull(), "missing").when(F.col("want").isNull(), "untracked").when(F.col("want") != F.col("got"), "altered")
    return both.select("path", status.alias("status")).where("status is not null")
