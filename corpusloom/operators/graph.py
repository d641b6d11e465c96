"""Citation graphs: links from citations, degrees, a report, PageRank by joins."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DAMPING = 0.85
#: So many rows of a few numbers are grouped by one task; they take some hundred bytes each there.
ROWS_PER_TASK = 1_000_000


def scratch_folder(spark: SparkSession) -> str:
    """The folder that the cluster shares; one of our own only where none is set and all runs on one machine."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root is None:
        import tempfile

        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="corpusloom-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch(df: DataFrame, name: str) -> DataFrame:
    """Write df where the cluster shares files and read it back, which cuts its lineage."""
    path = f"{scratch_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dealt(rows: DataFrame, *keys: str) -> DataFrame:
    """Deal rows out by keys to as many tasks as their number fills.

    Spark fits tasks to the bytes that are shuffled. Numbers that rise take a few bits each there, so
    that one task would be given millions of rows and hold fifty times those bytes to group them.
    """
    fill = -(-rows.count() // ROWS_PER_TASK)
    return rows.repartition(max(fill, rows.sparkSession.sparkContext.defaultParallelism), *keys)


def build(identifiers: DataFrame, citations: DataFrame) -> dict[str, DataFrame]:
    """nodes (doc_id), edges (src, dst), dangling (target, citations) and ambiguous (target, holders).

    identifiers: doc_id, identifier. citations: doc_id, identifier that is cited. An identifier
    that several documents hold resolves to none of them. Edges are distinct and never loops.
    """
    nodes = identifiers.select("doc_id").distinct()
    held = identifiers.where(F.coalesce("identifier", F.lit("")) != "").groupBy("identifier").agg(F.countDistinct("doc_id").alias("holders"), F.min("doc_id").alias("dst"))
    cited = citations.select(F.col("doc_id").alias("src"), "identifier").join(nodes.select(F.col("doc_id").alias("src")), "src", "left_semi")
    found = cited.join(held, "identifier", "left")
    edges = found.where((F.col("holders") == 1) & (F.col("src") != F.col("dst"))).select("src", "dst").distinct()
    dangling = found.where(F.coalesce("holders", F.lit(0)) != 1).groupBy(F.col("identifier").alias("target")).agg(F.count("*").alias("citations"))
    return {"nodes": nodes, "edges": edges, "dangling": dangling, "ambiguous": held.where("holders > 1").select(F.col("identifier").alias("target"), "holders")}


def degrees(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """In-degree, out-degree and their sum over what is possible."""
    into = edges.groupBy(F.col("dst").alias("doc_id")).agg(F.count("*").alias("in_degree"))
    out = edges.groupBy(F.col("src").alias("doc_id")).agg(F.count("*").alias("out_degree"))
    size = nodes.agg(F.greatest(F.count("*") - 1, F.lit(1)).alias("n"))
    all_ = nodes.join(into, "doc_id", "left").join(out, "doc_id", "left").na.fill(0, ["in_degree", "out_degree"]).crossJoin(F.broadcast(size))
    return all_.select("doc_id", "in_degree", "out_degree", F.round((F.col("in_degree") + F.col("out_degree")) / F.col("n"), 8).alias("degree_centrality"))


def report(graph: dict[str, DataFrame]) -> DataFrame:
    n = graph["nodes"].agg(F.count("*").alias("documents"))
    e = graph["edges"].agg(F.count("*").alias("edges"))
    d = graph["dangling"].agg(F.coalesce(F.sum("citations"), F.lit(0)).alias("dangling_citations"), F.count("*").alias("distinct_dangling_targets"))
    a = graph["ambiguous"].agg(F.count("*").alias("ambiguous_identifiers"))
    all_ = n.crossJoin(e).crossJoin(d).crossJoin(a)
    total = F.col("edges") + F.col("dangling_citations")
    return all_.withColumn("coverage", F.coalesce(F.round(F.col("edges") / F.nullif(total, F.lit(0)), 6), F.lit(0.0)))


def pagerank(nodes: DataFrame, edges: DataFrame, *, damping: float = DAMPING, tolerance: float = 1e-10, rounds: int = 200) -> DataFrame:
    """(doc_id, rank) after power iteration; the rank of nodes without links goes to all alike."""
    n = nodes.count()
    if n == 0:
        return nodes.withColumn("rank", F.lit(0.0))
    out = edges.groupBy("src").agg(F.count("*").alias("outs"))
    links = scratch(edges.join(out, "src"), "links")
    rank = scratch(nodes.join(out.withColumnRenamed("src", "doc_id"), "doc_id", "left").withColumn("rank", F.lit(1.0 / n)), "rank")
    if links.isEmpty():
        return rank.select("doc_id", "rank")
    held = F.coalesce(F.sum(F.when(F.col("outs").isNull(), F.col("rank"))), F.lit(0.0)).alias("lost")
    lost = rank.agg(held).first().lost
    for _ in range(rounds):
        share = links.join(rank.select(F.col("doc_id").alias("src"), "rank"), "src").groupBy(F.col("dst").alias("doc_id")).agg(F.sum(F.col("rank") / F.col("outs")).alias("got"))
        base = (1 - damping) / n + damping * lost / n
        new = scratch(rank.join(share, "doc_id", "left").select("doc_id", "outs", F.col("rank").alias("old"), (F.lit(base) + damping * F.coalesce("got", F.lit(0.0))).alias("rank")), "rank")
        # One look at what was written gives how far it moved and what the next round hands out.
        moved, lost = new.agg(F.sum(F.abs(F.col("rank") - F.col("old"))), held).first()
        rank = new.drop("old")
        if moved < tolerance:
            break
    return rank.select("doc_id", "rank")
