"""Events as a stream: counts by window with a bound on lateness, and a ledger that is brought up to date."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from corpusloom.operators import ledger

SCHEMA = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"


def read(spark: SparkSession, path: str, *, files_per_trigger: int = 4) -> DataFrame:
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def windowed(events: DataFrame, *, size: str = "1 day", slide: str | None = None, late: str = "2 days") -> DataFrame:
    """Counts and totals of each window and type; events later than `late` are left out."""
    w = F.window("ts", size, slide) if slide else F.window("ts", size)
    out = events.withWatermark("ts", late).groupBy(w.alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return out.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), "event_type", "n", "total")


def sessions(events: DataFrame, *, gap: str = "30 minutes", late: str = "2 days") -> DataFrame:
    out = events.withWatermark("ts", late).groupBy("user_id", F.session_window("ts", gap).alias("w")).agg(F.count("*").alias("n"))
    return out.select("user_id", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def append_ledger(events: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append each batch to the ledger's log; a batch that comes again replaces its own folder."""

    def put(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={epoch}")

    return events.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def ledger_state(spark: SparkSession, path: str) -> DataFrame:
    return ledger.state(spark.read.parquet(path))
