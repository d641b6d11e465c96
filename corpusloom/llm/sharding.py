"""Sharding by rendezvous hashing: every record goes to the shard that scores it best."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.common import materialise

SHARDS = 24
#: Parts of a shard that are numbered apart, so that no task holds a whole shard.
SLOT_PARTS = 1024
#: Equal rows are spread over so many of them.
SPREAD = 256


def score(key: Column, shard: int, weight: float) -> Column:
    """Lower is better: an exponential variate of rate `weight`, drawn by the hash of key and shard."""
    unit = (F.shiftrightunsigned(F.xxhash64(F.lit(shard), key), 12).cast("double") + 0.5) / float(1 << 52)
    return -F.log(unit) / F.lit(float(weight))


def shard_of(key: Column, weights: Sequence[float]) -> tuple[Column, Column]:
    """The chosen shard and its score; of equal scores the lower shard wins."""
    best = F.array_min(F.array(*[F.struct(score(key, i, w).alias("score"), F.lit(i).alias("shard")) for i, w in enumerate(weights)]))
    return best["shard"], best["score"]


def assign(records: DataFrame, weights: Sequence[float] = (1.0,) * SHARDS, *, id_col: str = "doc_id", text_col: str = "text", parts: int = SLOT_PARTS, new_weight: float = 1.0) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard of every record.

    The id and the weights alone decide the shard. With one more shard a record either stays or
    moves to the new one, as the other scores stay what they are. slot counts each shard's records
    from 0 without gaps: the parts of a shard are numbered apart, each after those before it.

    Null id: hashed like a fixed key, so such records share a shard. Null text: size 8 and the
    crc32 of no bytes. Records with equal ids share a shard and have slots of their own, equal records
    too, in an order of no meaning. An empty table gives no rows. Other columns are ignored.
    """
    key = F.coalesce(F.xxhash64(F.col(id_col).cast("long"), F.col(id_col).isNull()), F.lit(0))
    raw = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    chosen, best = shard_of(F.col("_key"), weights)
    keyed = records.select(F.col(id_col).cast("long").alias("doc_id"), (F.octet_length(raw) + 8).cast("long").alias("size"), F.crc32(raw).alias("text_crc32"), key.alias("_key"))
    placed = keyed.withColumn("shard", chosen).withColumn("_best", best)
    placed = placed.withColumn("grown_shard", F.when(score(F.col("_key"), len(weights), new_weight) < F.col("_best"), len(weights)).otherwise(F.col("shard")))
    # Equal rows are dealt out by where they stand, so that no part has all of them; written once, a row keeps its part.
    part = F.pmod(F.xxhash64("_key", "text_crc32", F.monotonically_increasing_id() % SPREAD), F.lit(parts)).cast("int")
    placed = materialise(placed.withColumn("_part", part).drop("_best", "_key"), "placed")
    counts = placed.groupBy("shard", "_part").count()
    upto = Window.partitionBy("shard").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    begins = counts.withColumn("_begin", F.coalesce(F.sum("count").over(upto), F.lit(0))).select("shard", "_part", "_begin")
    within = Window.partitionBy("shard", "_part").orderBy("doc_id", "text_crc32", "size")
    out = placed.withColumn("_at", F.row_number().over(within)).join(begins, ["shard", "_part"])
    return out.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", (F.col("_begin") + F.col("_at") - 1).cast("long").alias("slot"), "grown_shard")
