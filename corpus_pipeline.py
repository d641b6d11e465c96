"""A corpus pipeline of five stages; each stage's table is the next one's input."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from corpusloom.llm import bpe, decontaminate, quality_rules, registry, secrets, simhash
from corpusloom.llm.common import scratch_root


#: Rows that a task hands to Python at a time: texts are long, and batches of them lie in memory on both sides.
ARROW_ROWS = 2000


def _small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules, without the lines that are common to their host."""
    _small_batches(spark)
    return quality_rules.remove_lines(docs)


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    _small_batches(spark)
    return simhash.one_of_each_group(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    _small_batches(spark)
    return decontaminate.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their secrets replaced by a mark."""
    return secrets.redact(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, and the digests of ids and of the text decoded from them."""
    _small_batches(spark)
    coded = bpe.round_trip(docs, registry.vocabulary_path())
    return bpe.digests(coded, keep_ids=True)


STAGES = [("quality rules", rules), ("near duplicates", dedup), ("decontamination", decontamination), ("secret scan", secret_scan), ("tokens", tokens)]

#: Stages decode and hash text in Python, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if k + 1 == len(STAGES):
            return out
        path = f"{scratch_root(spark)}/pipeline-{k}-{uuid.uuid4().hex}"
        out.write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
