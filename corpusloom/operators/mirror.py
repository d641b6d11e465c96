"""Listings against what is there: what to fetch, what to copy, and exports that refuse to lose rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.operators.graph import dealt


def fetch_states(wanted: DataFrame, present: DataFrame) -> DataFrame:
    """(rel, state) of wanted files: present, conflict (another size) or missing; and files nobody wants."""
    both = wanted.select("rel", F.col("size").alias("want")).join(present.select("rel", F.col("size").alias("got")), "rel", "full_outer")
    state = F.when(F.col("want").isNull(), "unwanted").when(F.col("got").isNull(), "missing").when(F.col("want") == F.col("got"), "present").otherwise("conflict")
    return both.select("rel", state.alias("state"))


def to_copy(source: DataFrame, target: DataFrame) -> DataFrame:
    """Files that the target lacks or has in another size."""
    return source.join(target.select("rel", "size"), ["rel", "size"], "left_anti")


def export(chunks: DataFrame, signals: DataFrame, key: str) -> DataFrame:
    """Chunks with their signals. Columns of one name are refused; a chunk without signals ends the job."""
    shared = (set(chunks.columns) & set(signals.columns)) - {key}
    if shared:
        raise ValueError(f"both sides have {', '.join(sorted(shared))}")
    out = chunks.join(signals.withColumn("_there", F.lit(True)), key, "left")
    checked = F.when(F.col("_there"), F.col(key)).otherwise(F.raise_error(F.lit("a chunk has no signals")).cast(dict(chunks.dtypes)[key]))
    return out.withColumn(key, checked).drop("_there")


def reference_issues(blocks: DataFrame, tables: DataFrame) -> DataFrame:
    """(doc_id, ref, rule): references to no table, tables that no block or several blocks refer to.

    Both are counted in one grouping, without sorting either. Nulls refer to nothing.
    """
    used = blocks.where(F.col("ref").isNotNull()).select("doc_id", "ref", F.lit(1).alias("n"), F.lit(0).alias("there"))
    known = tables.select("doc_id", F.col("table_id").alias("ref"), F.lit(0).alias("n"), F.lit(1).alias("there"))
    apart = F.when(F.col("doc_id").isNull() | F.col("ref").isNull(), F.col("there"))
    both = dealt(used.unionByName(known), "doc_id", "ref").groupBy("doc_id", "ref", apart.alias("_apart")).agg(F.sum("n").alias("n"), F.max("there").alias("there"))
    rule = F.when(F.col("there") == 0, "dangling").when(F.col("n") == 0, "orphan").when(F.col("n") > 1, "multiple")
    return both.select("doc_id", "ref", rule.alias("rule")).where("rule is not null")


def invariant_issues(blocks: DataFrame) -> DataFrame:
    """(doc_id, reading_order, rule) of blocks that break what a block must be."""
    broken = F.array_compact(F.array(
        F.when(F.col("text").contains("\n\n"), "blank line"), F.when((F.col("type") == "heading") != F.col("level").isNotNull(), "level"), F.when(~F.col("level").between(1, 9), "range"),
        F.when(F.col("type").isin("table_ref", "figure_ref") & F.col("ref").isNull(), "ref"),
    ))
    return blocks.select("doc_id", "reading_order", F.explode(broken).alias("rule"))
