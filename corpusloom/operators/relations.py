"""Relations between documents: identities, resolution of citations, and the status they give."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SUPERSEDING = ("revokes", "replaces")
INSTRUMENT = ["type", "body", "number", "year"]
QUESTION = ["target_type", "target_body", "target_number", "target_year", "quote", "own_body"]


def squash(text: Column) -> Column:
    return F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), "[^0-9a-z]+", "")


def words(text: Column) -> Column:
    return F.upper(F.regexp_replace(F.trim(F.coalesce(text, F.lit(""))), r"\s+", " "))


def number(text: Column) -> Column:
    """Upper case without white space and leading zeros."""
    return F.regexp_replace(F.upper(F.regexp_replace(text, r"\s+", "")), r"^0+(?=\d)", "")


def identities(chunks: DataFrame, national: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, type, body, number, year) from each document's first chunk that names all of them."""
    named = chunks.where((F.coalesce("type", F.lit("")) != "") & (F.coalesce("number", F.lit("")) != "") & F.col("year").isNotNull())
    first = named.groupBy("doc_id").agg(F.min_by(F.struct("type", "body", "number", "year"), "seq").alias("x")).select("doc_id", "x.*")
    body = squash(F.col("body"))
    plain = F.when(body.isin([n.lower() for n in national]), "").otherwise(body) if national else body
    return first.select("doc_id", words(F.col("type")).alias("type"), plain.alias("body"), number(F.col("number")).alias("number"), "year")


def index(ids: DataFrame) -> DataFrame:
    """One row per instrument: its copies' smallest doc_id, and how many copies there are."""
    return ids.groupBy("type", "body", "number", "year").agg(F.min("doc_id").alias("representative"), F.count("*").alias("copies"))


def resolve(edges: DataFrame, ids: DataFrame) -> DataFrame:
    """edges (edge_id, source, relation, target_type, target_body, target_number, target_year, quote, partial)
    with target, resolution and confidence.

    Candidates have the number and year and a compatible type. A named body must be contained in
    theirs, an equal or else the longest one winning; without one, the single national instrument,
    then the citing document's own body; several are told apart by a body that the quote names.
    """
    cand = index(ids).select(F.col("type").alias("c_type"), F.col("body").alias("c_body"), F.col("number").alias("target_number"), F.col("year").alias("target_year"), F.col("representative").alias("c_id"))
    own = ids.select(F.col("doc_id").alias("source"), F.col("body").alias("own_body"))
    # Edges that ask for the same from the same body have one answer, so candidates are met once for each question.
    asked = edges.join(own, "source", "left").withColumn("ask", F.struct(*QUESTION))
    joined = asked.select("ask").distinct().select("ask", "ask.*").join(cand, ["target_number", "target_year"]).where((F.col("c_type") == F.col("target_type")) | F.col("c_type").startswith(F.concat("target_type", F.lit(" "))))
    named = (F.coalesce("target_body", F.lit("")) != "") & F.contains("c_body", "target_body")
    equal = named & (F.col("c_body") == F.col("target_body"))
    quoted = (F.col("c_body") != "") & F.contains(squash(F.col("quote")), F.col("c_body"))
    local = (F.coalesce("own_body", F.lit("")) != "") & (F.col("c_body") == F.col("own_body"))
    sized = joined.withColumns({"named": named, "equal": equal, "quoted": quoted, "local": local, "size": F.length("c_body")})
    per = sized.groupBy("ask").agg(
        F.count("*").alias("n"), F.first("own_body").alias("own_body"), F.first("target_body").alias("body"),
        F.count_if("equal").alias("n_equal"), F.min(F.when(F.col("equal"), F.col("c_id"))).alias("equal_id"),
        F.max(F.when(F.col("named"), F.col("size"))).alias("longest"),
        F.count_if(F.col("c_body") == "").alias("n_national"), F.min(F.when(F.col("c_body") == "", F.col("c_id"))).alias("national_id"),
        F.count_if("local").alias("n_local"), F.min(F.when(F.col("local"), F.col("c_id"))).alias("local_id"),
        F.count_if("quoted").alias("n_quoted"), F.min(F.when(F.col("quoted"), F.col("c_id"))).alias("quoted_id"),
    )
    long = sized.join(per.select("ask", "longest", "n_equal"), "ask").where(F.col("named") & F.when(F.col("n_equal") > 0, F.col("equal")).otherwise(F.col("size") == F.col("longest")))
    best = long.groupBy("ask").agg(F.count("*").alias("n_best"), F.min("c_id").alias("best_id"), F.count_if("quoted").alias("n_best_quoted"), F.min(F.when(F.col("quoted"), F.col("c_id"))).alias("best_quoted_id"))
    x = per.join(best, "ask", "left").na.fill(0, ["n_best", "n_best_quoted"])
    answer = lambda i, how, c: F.struct(i.alias("target"), F.lit(how).alias("resolution"), F.lit(float(c)).alias("confidence"))
    none = F.lit(None).cast(dict(ids.dtypes)["doc_id"])
    has_body = F.coalesce("body", F.lit("")) != ""
    hinted = lambda n, i: F.when(n == 1, answer(i, "inferred", 0.6)).otherwise(answer(none, "ambiguous", 0))
    lone = F.coalesce("own_body", F.lit("")) != ""
    chosen = (
        F.when(has_body & (F.col("n_best") == 1), answer(F.col("best_id"), "resolved", 1))
        .when(has_body & (F.col("n_best") > 1), hinted(F.col("n_best_quoted"), F.col("best_quoted_id")))
        .when(has_body, answer(none, "unresolved", 0))
        .when(F.col("n_national") == 1, answer(F.col("national_id"), "resolved", 1))
        .when(lone & (F.col("n_local") == 1), answer(F.col("local_id"), "inferred", 0.7))
        .when(lone & (F.col("n_local") == 0), answer(none, "unresolved", 0))
        .when(F.col("n") > 1, hinted(F.col("n_quoted"), F.col("quoted_id")))
        .otherwise(answer(none, "unresolved", 0))
    )
    got = x.select("ask", chosen.alias("a")).select("ask", "a.*")
    given = ["edge_id", *(c for c in edges.columns if c != "edge_id")]
    return asked.join(got, "ask", "left").select(*given, "target", "resolution", "confidence").na.fill({"resolution": "unresolved", "confidence": 0.0})


def instrument_status(edges: DataFrame, ids: DataFrame) -> DataFrame:
    """(type, body, number, year, status, revoked_by, amended_by) of the instruments that resolved edges of others reach."""
    of = ids.select("doc_id", *INSTRUMENT)
    hit = edges.where(F.col("target").isNotNull()).select("source", "relation", "target", "partial")
    met = hit.join(of.withColumnRenamed("doc_id", "target"), "target")
    mine = of.select(F.col("doc_id").alias("source"), F.struct(*INSTRUMENT).alias("own"))
    other = met.join(mine, "source", "left").where(F.col("own").isNull() | ~F.col("own").eqNullSafe(F.struct(*INSTRUMENT)))
    over = F.col("relation").isin(*SUPERSEDING)
    marks = other.groupBy(*INSTRUMENT).agg(
        F.sort_array(F.collect_set(F.when(over, F.col("source")))).alias("revoked_by"), F.sort_array(F.collect_set(F.when(F.col("relation") == "amends", F.col("source")))).alias("amended_by"),
        F.bool_or(over & ~F.col("partial")).alias("full"), F.bool_or(over & F.col("partial")).alias("part"),
    )
    status = F.when(F.col("full"), "revoked").when(F.col("part"), "partially_revoked").when(F.size("amended_by") > 0, "amended").otherwise("none_known")
    return marks.select(*INSTRUMENT, status.alias("status"), "revoked_by", "amended_by")


def of_copies(ids: DataFrame, found: DataFrame) -> DataFrame:
    """doc_id and what is found of its instrument; all copies share it."""
    return ids.join(found, INSTRUMENT, "left").select("doc_id", *(c for c in found.columns if c not in INSTRUMENT)).na.fill({"status": "none_known"})


def derive_status(edges: DataFrame, ids: DataFrame) -> DataFrame:
    """(doc_id, status, revoked_by, amended_by) of every document from resolved edges; copies share it."""
    every = of_copies(ids, instrument_status(edges, ids))
    empty = F.array().cast(f"array<{dict(ids.dtypes)['doc_id']}>")
    return every.select("doc_id", "status", F.coalesce("revoked_by", empty).alias("revoked_by"), F.coalesce("amended_by", empty).alias("amended_by"))


def merge_mentions(edges: DataFrame, keys: list[str]) -> DataFrame:
    """Equal relations as one: mentions add up, partial only if all are, the first quote stays."""
    return edges.groupBy(*keys).agg(F.sum("mentions").alias("mentions"), F.bool_and("partial").alias("partial"), F.min_by("quote", "seq").alias("quote"))


def drop_contained(spans: DataFrame, group: list[str]) -> DataFrame:
    """Spans (start, end) that no earlier or equal longer span of their group holds."""
    from pyspark.sql import Window

    order = Window.partitionBy(*group).orderBy("start", F.desc("end"), "kind")
    held = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    return spans.withColumn("_held", held).where(F.col("_held").isNull() | (F.col("end") > F.col("_held"))).drop("_held")


def nearest(points: DataFrame, cues: DataFrame, group: list[str], *, window: int) -> DataFrame:
    """For each point the nearest cue of its group within `window`; the earlier of equal ones.

    Cues are met per bucket of `window` positions and its two neighbours, an equi-join.
    """
    bucket = lambda c: F.floor(F.col(c) / F.lit(window))
    left = points.withColumn("_b", F.explode(F.array(bucket("pos") - 1, bucket("pos"), bucket("pos") + 1)))
    right = cues.withColumn("_b", bucket("cue_pos"))
    gap = F.abs(F.col("pos") - F.col("cue_pos"))
    met = left.join(right, [*group, "_b"]).withColumn("gap", gap).where(F.col("gap") <= window)
    return met.groupBy(*group, "point_id", "pos").agg(F.min_by(F.struct("cue_id", "cue_pos", "gap"), F.struct("gap", "cue_pos", "cue_id")).alias("c")).select(*group, "point_id", "pos", "c.cue_id", "c.cue_pos", "c.gap")
