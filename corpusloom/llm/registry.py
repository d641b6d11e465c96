"""The queries of this subpackage, each over its whole table, and SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from corpusloom.llm import bpe, conversation_repair, decontaminate, language_id, oracles, packing, quality_classifier, quality_rules, secrets, sharding, simhash, suffix_dedup, toxicity, variants


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(documents(spark, sf_dir))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digests(suffix_dedup.remove_repeats(documents(spark, sf_dir)))


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digests(secrets.secret_spans(documents(spark, sf_dir)))


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(bpe.round_trip(documents(spark, sf_dir), vocabulary_path()))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(documents(spark, sf_dir))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contaminated(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.drop("text_hash")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return quality_classifier.classify(docs, quality_classifier.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return toxicity.classify(docs, toxicity.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return language_id.identify(docs, *language_id.learn(docs))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), vocabulary_path("word_bpe_49k.json"))


def op13_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.group_variants(documents(spark, sf_dir))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_quality_rules, op2_simhash, op3_suffix_dedup, op4_secrets, op5_bpe, op6_sharding, op7_decontaminate, op8_quality, op9_toxicity, op10_language, op11_conversation_repair, op12_packing, op13_variants)}


def oracle_sql() -> dict[str, str]:
    return oracles.oracle_sql()
