"""Queries over document texts: tokens, BM25, lexicon, quality verdicts and factors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import text as tx
from corpusloom.operators import bm25, factors, lexicon
from corpusloom.queries.base import query, table

WORDS = r"regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}')"
COUNTS = f"""words AS (SELECT doc_id, {WORDS} AS w FROM documents),
long AS (SELECT doc_id, len(w) AS dl, unnest(w) AS term FROM words),
counts AS (SELECT doc_id, dl, term, count(*) AS tf FROM long GROUP BY ALL),
stats AS (SELECT count(*) AS n_docs, avg(len(w)) AS avgdl FROM words WHERE len(w) > 0),
vocab AS (SELECT term, df, ln(1 + (n_docs - df + 0.5) / (df + 0.5)) AS idf FROM (SELECT term, count(*) AS df FROM counts GROUP BY term), stats)"""
WEIGHT = "idf * tf * 2.5 / (tf + 1.5 * (1 - 0.75 + 0.75 * dl / avgdl))"
TERMS = ("the", "of", "and", "die", "les", "que")


@query("token_estimate", r"SELECT doc_id, CAST(floor(len(regexp_extract_all(text, '[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s]')) * 1.35) AS BIGINT) AS tokens FROM documents")
def token_estimate(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", tx.estimated_tokens(F.col("text")).alias("tokens"))


LAYER = r"""m AS (SELECT doc_id, text, CAST(length(regexp_replace(text, '^\s+|\s+$', '', 'g')) AS BIGINT) AS chars,
CAST(len(regexp_extract_all(text, '[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]')) AS BIGINT) AS control_chars, CAST(length(text) - length(replace(text, chr(65533), '')) AS BIGINT) AS replacement_chars,
CAST(coalesce(list_max(list_transform(regexp_extract_all(text, '\p{L}+'), lambda x: length(x))), 0) AS BIGINT) AS longest_run FROM documents)"""


@query("text_layer_verdict", f"WITH {LAYER} SELECT doc_id, chars, control_chars, replacement_chars, longest_run, CASE WHEN chars < 200 THEN 'absent' WHEN control_chars > 0 OR replacement_chars > 0 OR longest_run > 24 THEN 'damaged' ELSE 'clean' END AS layer FROM m")
def text_layer_verdict(spark: SparkSession, d: str) -> DataFrame:
    m = tx.text_layer(F.col("text"))
    return table(spark, d, "documents").select("doc_id", *[c.alias(n) for n, c in m.items() if n != "reasons"])


@query("text_layer_counts", f"WITH {LAYER} SELECT CASE WHEN chars < 200 THEN 'absent' WHEN control_chars > 0 OR replacement_chars > 0 OR longest_run > 24 THEN 'damaged' ELSE 'clean' END AS layer, count(*) AS documents FROM m GROUP BY 1")
def text_layer_counts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select(tx.text_layer(F.col("text"))["layer"].alias("layer")).groupBy("layer").agg(F.count("*").alias("documents"))


@query("longest_run", r"SELECT doc_id, CAST(coalesce(list_max(list_transform(regexp_extract_all(text, '\p{L}+'), lambda x: length(x))), 0) AS BIGINT) AS longest_run FROM documents")
def longest_run(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", tx.longest_letter_run(F.col("text")).alias("longest_run"))


@query("token_freq_topk", f"SELECT term, count(*) AS n FROM (SELECT unnest({WORDS}) AS term FROM documents) GROUP BY term ORDER BY n DESC, term LIMIT 100")
def token_freq_topk(spark: SparkSession, d: str) -> DataFrame:
    words = table(spark, d, "documents").select(F.explode(tx.tokens(F.col("text"))).alias("term"))
    return words.groupBy("term").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "term").limit(100)


@query("bm25_vocab", f"WITH {COUNTS}, top AS (SELECT * FROM vocab ORDER BY df DESC, term LIMIT 5000) SELECT term, df, round(idf, 6) AS idf, row_number() OVER (ORDER BY term) - 1 AS idx FROM top")
def bm25_vocab(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    v = bm25.vocabulary(bm25.term_counts(docs, "doc_id", "text"), bm25.statistics(docs, "doc_id", "text"), 5000)
    return v.select("term", "df", F.round("idf", 6).alias("idf"), "idx")


@query("bm25_doc_vectors", f"WITH {COUNTS}, top AS (SELECT * FROM vocab ORDER BY df DESC, term LIMIT 500) SELECT doc_id, term, round({WEIGHT}, 6) AS weight FROM counts JOIN top USING (term), stats WHERE {WEIGHT} > 0")
def bm25_doc_vectors(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    stats = bm25.statistics(docs, "doc_id", "text")
    vocab = bm25.vocabulary(bm25.term_counts(docs, "doc_id", "text"), stats, 500)
    w = bm25.weights(bm25.term_counts(docs, "doc_id", "text", only=vocab), vocab, stats)
    return w.select(F.col("id").alias("doc_id"), "term", F.round("weight", 6).alias("weight"))


@query("vocab_coverage", f"WITH {COUNTS} SELECT count(*) AS total_docs, count(*) FILTER (WHERE len(w) > 0) AS fit_docs, round(count(*) FILTER (WHERE len(w) > 0) / count(*), 6) AS coverage, count(*) FILTER (WHERE len(w) > 0) / count(*) >= 0.5 AS ok FROM words")
def vocab_coverage(spark: SparkSession, d: str) -> DataFrame:
    words = table(spark, d, "documents").select(F.size(tx.tokens(F.col("text"))).alias("n"))
    share = F.count_if(F.col("n") > 0) / F.count("*")
    return words.agg(F.count("*").alias("total_docs"), F.count_if(F.col("n") > 0).alias("fit_docs"), F.round(share, 6).alias("coverage"), (share >= 0.5).alias("ok"))


TOPK = f"""{COUNTS}, asked AS (SELECT DISTINCT item_id, unnest({WORDS}) AS term FROM benchmark),
scores AS (SELECT item_id, doc_id, round(sum({WEIGHT}), 6) AS score FROM counts JOIN vocab USING (term) JOIN asked USING (term), stats GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores)"""


@query("bm25_topk", f"WITH {TOPK} SELECT item_id, doc_id, rank, score FROM ranked WHERE rank <= 10")
def bm25_topk(spark: SparkSession, d: str) -> DataFrame:
    return bm25.top_documents(table(spark, d, "documents"), table(spark, d, "benchmark"), 10, doc_id="doc_id", query_id="item_id")


LEX = r"""judged AS (SELECT doc_id, lower(w) AS word FROM (SELECT doc_id, unnest(regexp_extract_all(array_to_string(list_filter(string_split(text, chr(10)), lambda x: NOT starts_with(ltrim(x), '|')), chr(10)), '\p{L}+')) AS w FROM documents) WHERE length(w) >= 3 AND NOT (length(w) <= 5 AND w = upper(w))),
once AS (SELECT doc_id, word, count(*) AS n FROM judged GROUP BY ALL),
pass1 AS (SELECT word FROM once GROUP BY word HAVING count(*) >= 3),
good AS (SELECT doc_id FROM once LEFT JOIN (SELECT word, 1 AS known FROM pass1) USING (word) GROUP BY doc_id HAVING sum(CASE WHEN known IS NULL THEN n ELSE 0 END) / sum(n) < 0.3),
lexicon AS (SELECT word, count(*) AS documents FROM once WHERE doc_id IN (SELECT doc_id FROM good) GROUP BY word HAVING count(*) >= 3)"""
CHUNKS = r"""parts AS (SELECT doc_id, generate_subscripts(p, 1) - 1 AS part, unnest(p) AS body FROM (SELECT doc_id, string_split(text, chr(10)) AS p FROM documents)),
pw AS (SELECT doc_id, part, w FROM (SELECT doc_id, part, unnest(regexp_extract_all(CASE WHEN starts_with(ltrim(body), '|') THEN '' ELSE body END, '\p{L}+')) AS w FROM parts) WHERE length(w) >= 3 AND NOT (length(w) <= 5 AND w = upper(w))),
pc AS (SELECT doc_id, part, count(*) AS judged, count(*) FILTER (WHERE lower(w) NOT IN (SELECT word FROM lexicon)) AS unknown FROM pw GROUP BY ALL),
cm AS (SELECT doc_id, part, length(body) AS chars, length(body) - length(replace(body, chr(65533), '')) AS replaced, coalesce(judged, 0) AS judged, coalesce(unknown, 0) AS unknown FROM parts LEFT JOIN pc USING (doc_id, part)),
cd AS (SELECT *, (1000 * replaced >= 5.0 * greatest(chars, 1)) OR (judged >= 20 AND unknown >= 0.4 * judged) AS damaged FROM cm)"""


def _lexicon(spark: SparkSession, d: str) -> DataFrame:
    return lexicon.build(table(spark, d, "documents"), "doc_id", "text")


def _measures(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("part", "body"))
    return lexicon.chunk_measures(lines, _lexicon(spark, d), doc_col="doc_id", chunk_col="part", text_col="body")


@query("lexicon_two_pass", f"WITH {LEX} SELECT word, documents FROM lexicon")
def lexicon_two_pass(spark: SparkSession, d: str) -> DataFrame:
    return _lexicon(spark, d)


@query("chunk_damage", f"WITH {LEX}, {CHUNKS} SELECT doc_id, CAST(part AS INTEGER) AS part, CAST(judged AS BIGINT) AS judged, CAST(unknown AS BIGINT) AS unknown, damaged FROM cd")
def chunk_damage(spark: SparkSession, d: str) -> DataFrame:
    return _measures(spark, d).select(F.col("doc").alias("doc_id"), F.col("chunk").alias("part"), "judged", "unknown", "damaged")


VERDICTS = """s AS (SELECT doc_id, count(*) AS chunks, count(*) FILTER (WHERE damaged) AS damaged_chunks, sum(judged) AS words, sum(unknown) AS unk, coalesce(sum(judged) FILTER (WHERE damaged), 0) AS dw, sum(chars) AS chars, sum(replaced) AS repl FROM cd GROUP BY doc_id),
r AS (SELECT *, round(coalesce(unk / nullif(words, 0), 0), 6) AS unknown_share, round(coalesce(dw / nullif(words, 0), 0), 6) AS damaged_share, round(coalesce(1000 * repl / nullif(chars, 0), 0), 6) AS replacement_per_1000 FROM s),
v AS (SELECT *, CASE WHEN words < 5 THEN 'absent' WHEN damaged_share >= 0.5 THEN 'unusable' WHEN damaged_chunks > 0 OR unknown_share >= 0.15 OR replacement_per_1000 >= 1.0 THEN 'degraded' ELSE 'clean' END AS verdict FROM r)"""


@query("doc_quality_verdict", f"WITH {LEX}, {CHUNKS}, {VERDICTS} SELECT doc_id, verdict, verdict NOT IN ('absent', 'unusable') AS indexable, chunks, CAST(damaged_chunks AS BIGINT) AS damaged_chunks, CAST(words AS BIGINT) AS words, unknown_share, damaged_share, replacement_per_1000 FROM v")
def doc_quality_verdict(spark: SparkSession, d: str) -> DataFrame:
    return lexicon.document_verdicts(_measures(spark, d))


@query("quality_vs_label", f"WITH {LEX}, {CHUNKS}, {VERDICTS} SELECT verdict, quality, count(*) AS documents FROM v JOIN labels USING (doc_id) GROUP BY ALL")
def quality_vs_label(spark: SparkSession, d: str) -> DataFrame:
    return lexicon.document_verdicts(_measures(spark, d)).join(table(spark, d, "labels"), "doc_id").groupBy("verdict", "quality").agg(F.count("*").alias("documents"))


_TERMS = "[" + ", ".join(f"'{t}'" for t in TERMS) + "]"


@query("completeness_factor", rf"""WITH w AS (SELECT doc_id, length(regexp_replace(text, '^\s+|\s+$', '', 'g')) AS chars, {WORDS} AS w FROM documents),
x AS (SELECT *, coalesce(len(list_filter(w, lambda t: list_contains({_TERMS}, t))) / nullif(len(w), 0), 0.0) AS density FROM w)
SELECT doc_id, CASE WHEN chars < 40 THEN 0.0 ELSE round(0.7 * least((chars - 40) / 360.0, 1.0) + 0.3 * least(density * 4, 1.0), 6) END AS completeness, round(density, 6) AS density FROM x""")
def completeness_factor(spark: SparkSession, d: str) -> DataFrame:
    score, density = factors.completeness(F.col("text"), TERMS)
    return table(spark, d, "documents").select("doc_id", score.alias("completeness"), density.alias("density"))


@query("topical_factor", rf"""WITH a AS (SELECT doc_id, CASE WHEN strpos(text, chr(10)) > 0 THEN string_split(text, chr(10))[1] END AS about FROM documents)
SELECT doc_id, CAST(CASE WHEN about IS NULL THEN NULL WHEN regexp_replace(about, '^\s+|\s+$', '', 'g') = '' THEN 0.0 WHEN len({WORDS.replace('text', 'about')}) < 2 THEN 0.2 ELSE 1.0 END AS DOUBLE) AS topical FROM a""")
def topical_factor(spark: SparkSession, d: str) -> DataFrame:
    about = F.when(F.instr("text", "\n") > 0, F.split("text", "\n")[0])
    return table(spark, d, "documents").select("doc_id", factors.topical(about).cast("double").alias("topical"))
