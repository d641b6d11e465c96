"""Retrieval measures against labelled queries, with intervals, splits and comparisons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def locator_path(text: Column, names: list[str]) -> Column:
    """(name, value) pairs of a locator in reading order, in lower case; longer names first."""
    which = "|".join(sorted(names, key=lambda n: (-len(n), n)))
    pattern = rf"(?i)\b({which})\b\s*\(?\s*([0-9]+[a-z]?|[ivxlcdm]+|[a-z])\s*\)?"
    pair = F.arrays_zip(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)).alias("name"), F.regexp_extract_all(text, F.lit(pattern), F.lit(2)).alias("value"))
    return F.transform(pair, lambda p: F.concat_ws(" ", F.lower(p["name"]), F.lower(p["value"])))


def coverage(chunk: Column, label: Column) -> Column:
    """exact, contains (the chunk is broader), within (it is narrower) or none; no label: contains."""
    c, n = F.size(chunk), F.size(label)
    begins = lambda long, short, k: F.slice(long, F.lit(1), F.greatest(k, F.lit(1))) == short
    return F.when(n == 0, "contains").when(c == 0, "none").when(chunk == label, "exact").when((c < n) & begins(label, chunk, c), "contains").when((n < c) & begins(chunk, label, n), "within").otherwise("none")


def normal_identifier(text: Column) -> Column:
    return F.lower(F.regexp_replace(F.regexp_replace(F.coalesce(text, F.lit("")), r"(?i)\bno(?:mor)?\b\.?", " "), r"[\s.]+", ""))


def measures(ranked: DataFrame, judged: DataFrame, *, k: int = 10) -> DataFrame:
    """Per query: recall@k by hits and by distinct judgements, reciprocal rank and nDCG@10.

    ranked: qid, rank, doc. judged: qid, doc, grade. A query without results scores zero; one
    without judgements is right if nothing is returned.
    """
    best = judged.groupBy("qid", "doc").agg(F.max("grade").alias("grade"))
    want = judged.groupBy("qid").agg(F.countDistinct("doc").alias("relevant"))
    hits = ranked.join(best, ["qid", "doc"], "left").withColumn("grade", F.coalesce("grade", F.lit(0)))
    ideal = Window.partitionBy("qid").orderBy(F.desc("grade"), "rank")
    hits = hits.withColumn("place", F.row_number().over(ideal))
    gain = lambda at: F.when((F.col(at) <= 10) & (F.col("grade") > 0), F.col("grade") / F.log2(F.col(at) + 1.0)).otherwise(0.0)
    per = hits.groupBy("qid").agg(
        F.count_if((F.col("rank") <= k) & (F.col("grade") > 0)).alias("found"), F.countDistinct(F.when((F.col("rank") <= k) & (F.col("grade") > 0), F.col("doc"))).alias("distinct_found"),
        F.min(F.when(F.col("grade") > 0, F.col("rank"))).alias("first"), F.sum(gain("rank")).alias("dcg"), F.sum(gain("place")).alias("best"), F.count("*").alias("returned"),
    )
    all_ = per.join(want, "qid", "full_outer").na.fill(0)
    negative = F.col("relevant") == 0
    share = lambda n: F.round(F.least(F.col(n), F.col("relevant")) / F.nullif(F.col("relevant"), F.lit(0)), 6)
    return all_.select(
        "qid", "relevant", F.when(negative, None).otherwise(share("found")).alias("recall"), F.when(negative, None).otherwise(share("distinct_found")).alias("recall_distinct"),
        F.when(negative, None).otherwise(F.round(F.coalesce(1 / F.nullif(F.col("first"), F.lit(0)), F.lit(0.0)), 6)).alias("mrr"), F.when(negative, None).otherwise(F.round(F.coalesce(F.col("dcg") / F.nullif(F.col("best"), F.lit(0)), F.lit(0.0)), 6)).alias("ndcg"), (negative & (F.col("returned") == 0)).alias("empty_as_due"),
    )


def bootstrap(per_query: DataFrame, value: str, *, samples: int = 1000) -> DataFrame:
    """Bounds of the mean over resampled queries: the query set is numbered and drawn from by rule.

    Sample i, draw j takes query (i * 7919 + j * 104729 + i * j * 31) mod n. The query set is small
    by nature; the draws are `samples` times its size.
    """
    rows = per_query.where(F.col(value).isNotNull()).select((F.row_number().over(Window.orderBy("qid")) - 1).alias("at"), F.col(value).alias("v"))
    n = rows.count()
    i, j = F.col("i"), F.col("j")
    draws = rows.sparkSession.range(samples).withColumnRenamed("id", "i").withColumn("j", F.explode(F.sequence(F.lit(0), F.lit(max(n - 1, 0))))).withColumn("at", ((i * 7919 + j * 104729 + i * j * 31) % F.lit(max(n, 1))).cast("int"))
    means = draws.join(rows, "at").groupBy("i").agg(F.round(F.avg("v"), 6).alias("m"))
    order = F.sort_array(F.collect_list("m"))
    return means.agg(order.alias("m")).select(F.element_at("m", max(1, int(samples * 0.025))).alias("low"), F.element_at("m", min(samples, int(samples * 0.975) + 1)).alias("high"))


def stratified_split(rows: DataFrame, stratum: str, id_col: str, share: float, seed: str) -> DataFrame:
    """Mark the first `share` of each stratum, by a hash of seed and id, as held out."""
    key = F.md5(F.concat(F.lit(seed), F.coalesce(F.col(id_col).cast("string"), F.lit(""))))
    keyed = rows.withColumns({"_key": key, "_cell": F.substring(key, 1, 3)})
    # A stratum is ranked in 4096 cells, whose counts are then added up: no task ranks a whole one.
    cells = keyed.groupBy(F.col(stratum).alias("_stratum"), F.col("_cell").alias("_of")).agg(F.count("*").alias("_n"))
    before = Window.partitionBy("_stratum").orderBy("_of").rowsBetween(Window.unboundedPreceding, -1)
    sums = cells.select("_stratum", "_of", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"), F.sum("_n").over(Window.partitionBy("_stratum")).alias("_all"))
    placed = keyed.join(sums, (F.col("_cell") == F.col("_of")) & F.col(stratum).eqNullSafe(F.col("_stratum")))
    at = F.col("_start") + F.row_number().over(Window.partitionBy(stratum, "_cell").orderBy("_key", id_col))
    return placed.withColumn("held", at <= F.bround(F.col("_all") * share, 0)).select(*rows.columns, "held")


def contradictions(rows: DataFrame, id_col: str, kind: str, relevant: str) -> DataFrame:
    """Queries that say they have no answer and have one, or the other way round; and repeated ids."""
    wrong = rows.where((F.col(kind) == "negative") == (F.col(relevant) > 0)).select(id_col, F.lit("kind").alias("problem"))
    return wrong.unionByName(rows.groupBy(id_col).count().where("count > 1").select(id_col, F.lit("repeated").alias("problem")))
