"""Queries over readers by type, chunkers by name, files that are found, and readings that agree."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.operators import bundle, embedding, readers
from corpusloom.operators.graph import scratch_folder
from corpusloom.queries.base import ORACLES, query, table
from corpusloom.queries.blocks import _blocks
from corpusloom.sources import files

_MIME = "CASE doc_id % 5 WHEN 0 THEN 'application/pdf' ELSE 'text/plain' END"


@query("blocks_by_type", f"WITH p AS ({ORACLES['plain_blocks']}), d AS (SELECT doc_id, {_MIME} AS mime FROM documents) SELECT p.doc_id, CAST(reading_order AS INTEGER) AS reading_order, 'paragraph' AS type, text FROM p JOIN d USING (doc_id) WHERE mime = 'text/plain' UNION ALL SELECT doc_id, 0, 'error', 'no reader of application/pdf' FROM d WHERE mime <> 'text/plain' UNION ALL SELECT doc_id, 0, 'error', 'no text' FROM d WHERE mime = 'text/plain' AND doc_id NOT IN (SELECT doc_id FROM p)")
def blocks_by_type(spark: SparkSession, d: str) -> DataFrame:
    """Documents as plain text and as files that nothing reads: blocks, and an error row where there are none."""
    docs = table(spark, d, "documents").select("doc_id", "text", F.when(F.col("doc_id") % 5 == 0, "application/pdf").otherwise("Text/Plain").alias("mime"))
    return readers.read(docs, "doc_id", "mime", "text").select("doc_id", "reading_order", "type", "text")


@query("chunker_by_name", f"SELECT *, 'token@1' AS chunker FROM ({ORACLES['token_chunks']})")
def chunker_by_name(spark: SparkSession, d: str) -> DataFrame:
    """Chunks by the newest chunker of a name, which they bear."""
    got = readers.chunk(_blocks(spark, d), "token", {"max_tokens": 400})
    return got.select("doc_id", "part", "first_block", "blocks", "tokens", F.sha2("body", 256).alias("body_hash"), "chunker")


@query("files_found", "SELECT lang, count(*) AS texts, CAST(sum(strlen(text) + 1) AS BIGINT) AS bytes FROM documents GROUP BY lang")
def files_found(spark: SparkSession, d: str) -> DataFrame:
    """Texts written as files by language and found again by their suffix."""
    docs, root = table(spark, d, "documents"), f"{scratch_folder(spark)}/files-{uuid.uuid4().hex}"
    docs.select("text", "lang").write.partitionBy("lang").text(root)
    found = files.find(spark, [root, f"{root}/"], ["*.txt", "*.TXT", "*.csv"])
    sizes = found.groupBy(F.regexp_extract("path", "/lang=([^/]*)/", 1).alias("lang")).agg(F.sum("bytes").alias("bytes"))
    return sizes.join(docs.groupBy("lang").agg(F.count("*").alias("texts")), "lang").select("lang", "texts", "bytes")


@query("lexicon_hash", f"SELECT sha256(sha256(string_agg(word, ',' ORDER BY word))) AS lexicon_hash, count(*) AS words FROM ({ORACLES['lexicon_load']})")
def lexicon_hash(spark: SparkSession, d: str) -> DataFrame:
    """The digest of a word list, the same for either kind of line end and any order."""
    from corpusloom.queries.records import lexicon_load

    words = lexicon_load(spark, d)
    return bundle.source_hash(words.withColumnRenamed("word", "id")).select(F.col("source_hash").alias("lexicon_hash")).crossJoin(words.agg(F.count("*").alias("words")))


@query("citation_agreement", "WITH r AS (SELECT l_linenumber AS line, CASE WHEN l_partkey % 5 > 0 THEN CAST(l_partkey % 3 AS VARCHAR) END AS a, CASE WHEN l_suppkey % 4 > 0 THEN CAST(l_suppkey % 3 AS VARCHAR) END AS b FROM lineitem) SELECT line, count(*) FILTER (WHERE a = b) AS agree, count(*) FILTER (WHERE a <> b) AS differ, count(*) FILTER (WHERE b IS NULL AND a IS NOT NULL) AS only_said, count(*) FILTER (WHERE a IS NULL AND b IS NOT NULL) AS only_stated, count(*) FILTER (WHERE a IS NULL AND b IS NULL) AS neither, round(count(*) FILTER (WHERE a = b) / nullif(count(*) FILTER (WHERE a IS NOT NULL AND b IS NOT NULL), 0), 6) AS share FROM r GROUP BY 1")
def citation_agreement(spark: SparkSession, d: str) -> DataFrame:
    """What a text says its number is, against what its name says, by line number."""
    k, s = F.col("l_partkey"), F.col("l_suppkey")
    text = F.when(k % 5 > 0, F.concat(F.lit("Act No. "), (k % 3).cast("string"), F.lit(" of it"))).otherwise("no number")
    name = F.when(s % 4 > 0, F.concat(F.lit("act-"), (s % 3).cast("string"), F.lit(".xml"))).otherwise("act.xml")
    rows = table(spark, d, "lineitem").select(F.col("l_linenumber").alias("line"), F.regexp_extract(text, r"No\. (\d+)", 1).alias("said"), F.regexp_extract(name, r"-(\d+)\.", 1).alias("stated"))
    return readers.agreement(rows, ["line"], "said", "stated")


@query("omni_embedding", "WITH h AS (SELECT page_id, url || chr(10) || sha256(html) AS t FROM pages), g AS (SELECT page_id, sha256(t || '#0') AS h FROM h), v AS (SELECT page_id, list_transform(range(32), lambda i: (CAST('0x' || substr(h, i * 2 + 1, 2) AS INTEGER) - 127.5) / 127.5) AS v FROM g) SELECT page_id, CAST(pos AS INTEGER) AS pos, round(v[pos + 1] / sqrt(list_inner_product(v, v)), 6) AS value FROM v, range(32) r(pos)")
def omni_embedding(spark: SparkSession, d: str) -> DataFrame:
    """One vector of a page's address and of the digest of what it shows."""
    v = embedding.hash_items(F.col("url"), F.sha2("html", 256), 32)
    return table(spark, d, "pages").select("page_id", F.posexplode(v).alias("pos", "value")).withColumn("value", F.round("value", 6))
