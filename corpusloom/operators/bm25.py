"""BM25: vocabulary, document vectors, query scores; each a grouping or an equi-join on terms."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.functions.text import TOKEN, tokens
from corpusloom.operators.graph import scratch

K1, B = 1.5, 0.75
#: Tables of terms with so many rows at most are sent to the tasks, so that no task gets all rows of a common term.
FEW_TERMS = 100_000


def term_counts(docs: DataFrame, id_col: str, text_col: str, *, only: DataFrame | None = None) -> DataFrame:
    """(id, term, tf, dl): how often each document has a term, and its length in tokens.

    With `only`, a table of terms, no other term is counted or shuffled; lengths are of all tokens.
    """
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    if only is None:
        # All terms weigh more than the texts, which are dealt out by id instead; terms are counted where they are cut.
        texts = texts.repartition("id")
    words = texts.select("id", tokens(F.col("text")).alias("words"))
    terms = words.select("id", F.size("words").alias("dl"), F.explode("words").alias("term"))
    if only is not None:
        terms = terms.join(only.select("term"), "term", "left_semi")
    return terms.groupBy("id", "dl", "term").agg(F.count("*").alias("tf"))


def statistics(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row: documents with a token, and their average length."""
    size = docs.select(F.size(tokens(F.col(text_col))).alias("dl")).where("dl > 0")
    return size.agg(F.count("*").alias("n_docs"), F.avg("dl").alias("avgdl"))


def vocabulary(counts: DataFrame, stats: DataFrame, max_features: int | None = None) -> DataFrame:
    """(term, df, idf, idx): the terms of most documents, numbered by name."""
    df = counts.groupBy("term").agg(F.count("*").alias("df"))
    if max_features is not None:
        # A top-k report: the ranking is over the whole vocabulary, cut by a total order.
        df = df.orderBy(F.desc("df"), "term").limit(max_features)
        df = df.withColumn("idx", (F.row_number().over(Window.orderBy("term")) - 1).cast("long"))
    n, d = F.col("n_docs"), F.col("df")
    out = df.crossJoin(F.broadcast(stats)).withColumn("idf", F.log(1 + (n - d + 0.5) / (d + 0.5))).drop("n_docs", "avgdl")
    return F.broadcast(out) if max_features is not None and max_features <= FEW_TERMS else out


def weights(counts: DataFrame, vocab: DataFrame, stats: DataFrame, *, k1: float = K1, b: float = B, keep: tuple[str, ...] = ()) -> DataFrame:
    """(id, term, weight) of each document's terms that are in the vocabulary, with the columns of it to keep."""
    joined = counts.join(vocab.select("term", "idf", *keep), "term").crossJoin(F.broadcast(stats.select("avgdl")))
    tf = F.col("tf")
    weight = F.col("idf") * tf * (k1 + 1) / (tf + k1 * (1 - b + b * F.col("dl") / F.col("avgdl")))
    return joined.withColumn("weight", weight).where("weight > 0").select("id", "term", "weight", *keep)


def top_documents(docs: DataFrame, queries: DataFrame, k: int, *, doc_id: str, query_id: str, text_col: str = "text") -> DataFrame:
    """The k best documents of each query: an inverted index joined with the query's distinct terms."""
    asked = queries.select(F.col(query_id).alias("qid"), F.explode(F.array_distinct(tokens(F.col(text_col)))).alias("term"))
    # Only terms that a query asks for are counted, and once; a term's documents are all among these rows.
    counts = scratch(term_counts(docs, doc_id, text_col, only=asked.select("term").distinct()), "counts").hint("merge")
    stats = scratch(statistics(docs, doc_id, text_col), "stats")
    wanted = scratch(asked.join(vocabulary(counts, stats), "term").select("qid", "term", "idf"), "wanted")
    wanted = F.broadcast(wanted) if wanted.count() <= FEW_TERMS else wanted.hint("merge")
    # Dealt out by document before queries multiply them, so that scores are added up where they are.
    index = weights(counts.repartition("id"), wanted, stats, keep=("qid",))
    score = index.groupBy("qid", "id").agg(F.round(F.sum("weight"), 6).alias("score"))
    best = Window.partitionBy("qid").orderBy(F.desc("score"), "id")
    return score.withColumn("rank", F.row_number().over(best).cast("long")).where(F.col("rank") <= k).select(F.col("qid").alias(query_id), F.col("id").alias(doc_id), "rank", "score")


def save(vocab: DataFrame, stats: DataFrame, path: str) -> None:
    """Store a fitted vocabulary and its statistics beside the pattern that its tokens were read by."""
    vocab.write.mode("overwrite").parquet(f"{path}/vocab")
    stats.withColumns({"pattern": F.lit(TOKEN), "k1": F.lit(K1), "b": F.lit(B)}).coalesce(1).write.mode("overwrite").parquet(f"{path}/stats")


def load(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """The stored vocabulary and statistics; refused if tokens are read by another pattern now."""
    stats = spark.read.parquet(f"{path}/stats")
    then = stats.first()
    if then["pattern"] != TOKEN:
        raise ValueError(f"tokens were read by {then['pattern']!r} and are read by {TOKEN!r} now: vectors would not match")
    return spark.read.parquet(f"{path}/vocab"), stats.select("n_docs", "avgdl")


def weights_left(docs: DataFrame, done: DataFrame, vocab: DataFrame, stats: DataFrame, *, id_col: str, text_col: str) -> DataFrame:
    """Weights of the documents that have none yet, by the statistics of the fit."""
    left = docs.join(done.select(F.col("id").alias(id_col)).distinct(), id_col, "left_anti")
    return weights(term_counts(left, id_col, text_col), vocab, stats)
