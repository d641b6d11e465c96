"""A ledger as an append-only log: the state of each key, what is left to do, shards and rates."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.operators.carry import carried


def state(log: DataFrame) -> DataFrame:
    """One row per key: the newest status, the newest doc_id that is not null, and the attempts."""
    order = F.struct("updated_at", "event_id")
    return log.groupBy("key").agg(F.max_by("status", order).alias("status"), F.max_by("doc_id", F.when(F.col("doc_id").isNotNull(), order)).alias("doc_id"), F.count("*").alias("attempts"), F.max("updated_at").alias("updated_at"))


def counts(log: DataFrame) -> DataFrame:
    return state(log).groupBy("status").agg(F.count("*").alias("keys"))


def failures(log: DataFrame, limit: int) -> DataFrame:
    """The newest failed keys first."""
    return state(log).where("status = 'failed'").orderBy(F.desc("updated_at"), "key").limit(limit)


def left_to_do(wanted: DataFrame, log: DataFrame) -> DataFrame:
    """Keys without a done entry."""
    done = state(log).where("status = 'done'").select("key")
    return wanted.join(done, "key", "left_anti")


def forget(log: DataFrame, keys: DataFrame) -> DataFrame:
    return log.join(keys.select("key").distinct(), "key", "left_anti")


def ownership(keys: DataFrame, workers: int, window: int) -> DataFrame:
    """(key, window, worker): windows of consecutive keys go round the workers."""
    return keys.withColumn("window", F.floor(F.col("key") / window)).withColumn("worker", F.pmod("window", F.lit(workers)))


def shards(rows: DataFrame, group: str, order: str, size: str, limit: int, *, window: int = 1000, units: str | None = None, max_units: int = 0, max_rows: int = 0) -> DataFrame:
    """(group, window, order, shard): a shard begins where the next row would pass `limit`, or once a bound is reached.

    Bounds: `limit` of size, `max_units` and `max_rows` (0: none). A row beyond a bound is a shard alone. As a
    run's workers own windows of consecutive order values, each window of a group is packed by itself, so that
    the largest group is shared out too. Null sizes count as nothing.
    """

    def step(state: tuple[int, int, int, int], row: tuple) -> tuple[tuple[int, int, int, int], int]:
        (used, parts, held, shard), (more, part) = state, row
        passed = used + more > limit or (max_units > 0 and parts + part > max_units)
        reached = used >= limit or (max_units > 0 and parts >= max_units) or (max_rows > 0 and held >= max_rows)
        if held and (passed or reached):
            return (more, part, 1, shard + 1), shard + 1
        return (used + more, parts + part, held + 1, shard), shard

    amount = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long") if c else F.lit(0).cast("long")
    keyed = rows.withColumns({"window": F.floor(F.col(order) / window), "_size": amount(size), "_units": amount(units)}).select(group, "window", order, "_size", "_units")
    packed = carried(keyed, [group, "window"], [order], {"size": F.col("_size"), "units": F.col("_units")}, (0, 0, 0, 0), step, "shard")
    return packed.select(group, "window", order, F.col("shard").cast("long").alias("shard"))


def rolling_rate(events: DataFrame, group: str, seconds: int) -> DataFrame:
    """For each event the rate per second of its group over the seconds before it."""
    at = F.col("ts").cast("timestamp").cast("double")
    back = Window.partitionBy(group).orderBy(at).rangeBetween(-seconds, 0)
    return events.withColumn("rate", F.round(F.count("*").over(back) / F.lit(float(seconds)), 6))
