"""Connected components by alternating large-star and small-star steps, each a join over the links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import materialise


def _large_star(links: DataFrame) -> DataFrame:
    """Each node's larger neighbours are linked to the smallest of its neighbourhood."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("m").alias("a"), "b").where("a <> b").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are linked to the smallest of them."""
    least = links.groupBy("b").agg(F.min("a").alias("m"))
    moved = links.join(least, "b").select(F.col("m"), F.col("a").alias("x")).unionByName(least.select("m", F.col("b").alias("x")))
    return moved.select(F.col("m").alias("a"), F.col("x").alias("b")).where("a <> b").distinct()


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))")).first())


def connected_components(links: DataFrame, *, rounds: int = 60) -> DataFrame:
    """node and component (its smallest node) for every node of links (a, b) with a < b."""
    state = None
    for _ in range(rounds):
        links = materialise(_small_star(_large_star(links)), "stars")
        now = _state(links)
        if now == state or now[0] == 0:
            break
        state = now
    else:
        raise RuntimeError("components did not settle")
    return links.select(F.col("b").alias("node"), F.col("a").alias("component")).unionByName(links.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())
