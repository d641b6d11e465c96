"""Tables as chunks, provenance, sparse literals, gathered signals and reports over chunk records."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from corpusloom.functions.sliced import each_text
from corpusloom.functions.text import CONTROL


def render_tables(cells: DataFrame, tables: DataFrame) -> DataFrame:
    """(doc_id, table_id, grid): each table as a Markdown grid; a table without rows or columns gives none.

    cells: doc_id, table_id, r, c, text. tables: doc_id, table_id, n_rows, n_cols, header_rows,
    caption. A spanning cell's text stands at its origin alone. Without header rows the rule comes first.
    """
    said = F.trim(F.replace(F.replace(F.coalesce("text", F.lit("")), F.lit("|"), F.lit("\\|")), F.lit("\n"), F.lit(" ")))
    rows = cells.groupBy("doc_id", "table_id", "r").agg(F.map_from_entries(F.collect_list(F.struct("c", said.alias("t")))).alias("row"))
    held = rows.groupBy("doc_id", "table_id").agg(F.map_from_entries(F.collect_list(F.struct("r", "row"))).alias("rows"))
    both = tables.where("n_rows > 0 AND n_cols > 0").join(held, ["doc_id", "table_id"], "left")
    columns = F.sequence(F.lit(0), F.col("n_cols") - 1)

    def line(r: Column) -> Column:
        row = F.try_element_at("rows", r)
        return F.concat(F.lit("| "), F.array_join(F.transform(columns, lambda c: F.coalesce(F.try_element_at(row, c), F.lit(""))), " | "), F.lit(" |"))

    lines = F.transform(F.sequence(F.lit(0), F.col("n_rows") - 1), line)
    head = F.least("header_rows", "n_rows")
    rule = F.concat(F.lit("| "), F.array_join(F.array_repeat(F.lit("---"), F.col("n_cols")), " | "), F.lit(" |"))
    caption = F.when(F.length("caption") > 0, F.array(F.concat(F.lit("**"), "caption", F.lit("**")))).otherwise(F.array().cast("array<string>"))
    grid = F.concat(caption, F.slice(lines, F.lit(1), head), F.array(rule), F.slice(lines, head + 1, F.col("n_rows")))
    return both.select("doc_id", "table_id", F.array_join(grid, "\n").alias("grid"))


def table_chunks(grids: DataFrame, tables: DataFrame, blocks: DataFrame) -> DataFrame:
    """(doc_id, table_id, body, locator, reading_order): a chunk per table, located by caption, else the heading above its anchor, else its id.

    blocks: doc_id, reading_order, ref, heading_path. The anchor is the first block that refers to the table.
    """
    anchor = blocks.where(F.col("ref").isNotNull()).groupBy("doc_id", F.col("ref").alias("table_id")).agg(F.min(F.struct("reading_order", "heading_path")).alias("a"))
    found = grids.join(tables.select("doc_id", "table_id", "caption"), ["doc_id", "table_id"]).join(anchor, ["doc_id", "table_id"], "left")
    heading = F.array_join("a.heading_path", " > ")
    blank = lambda c: F.when(F.length(c) > 0, c)
    return found.select("doc_id", "table_id", F.col("grid").alias("body"), F.coalesce(blank(F.col("caption")), blank(heading), F.col("table_id")).alias("locator"), F.col("a.reading_order").alias("reading_order"))


def with_provenance(chunks: DataFrame, sources: DataFrame, key: str, url: str) -> tuple[DataFrame, DataFrame]:
    """Chunks with the address of their source, and the chunks whose source has none: an address is never made up."""
    both = chunks.join(sources.select(key, F.col(url).alias("source_url")), key, "left")
    there = F.coalesce(F.length(F.trim("source_url")) > 0, F.lit(False))
    return both.where(there), both.where(~there).drop("source_url")


def identifier(citation: Column, locator: Column) -> Column:
    """Citation and locator joined by a comma; null without a citation, the citation alone without a locator."""
    return F.when(F.length(citation) > 0, F.concat_ws(", ", citation, F.when(F.length(locator) > 0, locator)))


def filled(template: list[str | Column]) -> Column:
    """The parts of a template in turn; null as soon as one of its values is null."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in template])


def split_marker(text: Column, pattern: str) -> tuple[Column, Column]:
    """The marker a text opens with (null without one) and what follows it."""
    marker = F.regexp_extract(text, f"^({pattern})", 1)
    return F.when(F.length(marker) > 0, F.trim(marker)), F.trim(F.substring(text, F.length(marker) + 1, F.length(text)))


def alternation(names: list[str]) -> str:
    """Names as one group of a pattern, longest first so that none hides a longer one."""
    special = set(r"\.^$*+?{}[]|()")
    quoted = ["".join("\\" + c if c in special else c for c in n) for n in sorted(set(names), key=lambda n: (-len(n), n))]
    return "(?:" + "|".join(quoted) + ")"


def _six_figures(values: pd.Series) -> pd.Series:
    return values.map(lambda row: [f"{x:.6g}" for x in row])


def sparse_literal(weights: DataFrame, vocab: DataFrame, dimension: int) -> DataFrame:
    """(id, literal) such as {1:0.5,9:1.25}/dimension: places count from 1 and rise, values have six figures."""
    rows = weights.join(vocab.select("term", "idx"), "term").groupBy("id").agg(F.sort_array(F.collect_list(F.struct((F.col("idx") + 1).alias("i"), "weight"))).alias("x"))
    figures = pandas_udf(_six_figures, "array<string>")(F.transform("x", lambda x: x["weight"].cast("double")))
    rows = rows.withColumn("v", figures)
    pairs = F.zip_with("x", "v", lambda x, v: F.concat(x["i"].cast("string"), F.lit(":"), v))
    return rows.select("id", F.concat(F.lit("{"), F.array_join(pairs, ","), F.lit("}/" + str(dimension))).alias("literal"))


def gathered(blocks: DataFrame, scope: str, order: str, text: str, separator: str = "\n") -> DataFrame:
    """(scope, texts, joined): a scope's texts, each once, in the order in which they first stand."""
    once = blocks.where(F.length(F.trim(text)) > 0).groupBy(scope, F.trim(text).alias("t")).agg(F.min(order).alias("o"))
    rows = once.groupBy(scope).agg(F.transform(F.sort_array(F.collect_list(F.struct("o", "t"))), lambda x: x["t"]).alias("texts"))
    return rows.select(scope, F.size("texts").cast("long").alias("texts"), F.array_join("texts", separator).alias("joined"))


def defined_terms(text: Column, pattern: str, emphasised: Column | None = None) -> Column:
    """What the pattern's group holds, each once; only those that are emphasised, if emphasis is given."""
    terms = F.array_distinct(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)))
    return terms if emphasised is None else F.filter(terms, lambda t: F.array_contains(emphasised, t))


def presence(rows: DataFrame, columns: list[str]) -> DataFrame:
    """(column, present): in how many rows a list has members or a text has characters."""
    kinds = dict(rows.dtypes)
    there = lambda c: F.size(c) > 0 if kinds[c].startswith("array") else F.length(c) > 0
    counted = rows.agg(F.array(*[F.struct(F.lit(c).alias("column"), F.count_if(there(c)).alias("present")) for c in columns]).alias("x"))
    return counted.select(F.explode("x").alias("x")).select("x.*")


def chunk_report(chunks: DataFrame, group: list[Column], tokens: str, body: str) -> DataFrame:
    """Per group: chunks, empty ones (set aside), repeated bodies and the upper median of the tokens of the rest."""
    empty = F.length(F.trim(body)) == 0
    rows = chunks.select(*group, F.col(tokens).alias("_n"), F.coalesce(empty, F.lit(True)).alias("_empty"), F.xxhash64(body).alias("_body"))
    names = rows.columns[: len(group)]
    counts = rows.groupBy(*names).agg(F.count("*").alias("chunks"), F.count_if("_empty").alias("empty"))
    full = rows.where("NOT _empty")
    bodies = full.groupBy(*names, "_body").count().groupBy(*names).agg(F.sum(F.col("count") - 1).alias("repeated"))
    # Of an even number the upper of the two middle ones: the place n / 2 counted from 0, sought among
    # the sizes that occur, of which a group has few however many chunks.
    sizes = full.groupBy(*names, "_n").count()
    upto = F.sum("count").over(Window.partitionBy(*names).orderBy("_n"))
    whole = F.sum("count").over(Window.partitionBy(*names))
    middle = sizes.withColumns({"_upto": upto, "_of": whole}).where(F.col("_upto") > F.floor(F.col("_of") / 2)).groupBy(*names).agg(F.min("_n").alias("median_tokens"))
    same = [F.col(f"a.{n}").eqNullSafe(F.col(f"b.{n}")) for n in names]
    out = counts.alias("a").join(bodies.alias("b"), same, "left").select("a.*", F.coalesce("repeated", F.lit(0)).alias("repeated"))
    return out.alias("a").join(middle.alias("b"), same, "left").select("a.*", "median_tokens")


def alignment(chunks: DataFrame, vectors: DataFrame, chunk_key: str, vector_key: str) -> DataFrame:
    """(key, problem) of chunks without a vector, vectors without a chunk, and keys with several of either."""
    left = chunks.groupBy(F.col(chunk_key).alias("key")).agg(F.count("*").alias("c"))
    right = vectors.groupBy(F.col(vector_key).alias("key")).agg(F.count("*").alias("v"))
    both = left.join(right, "key", "full_outer").fillna(0, ["c", "v"])
    problem = F.when(F.col("v") == 0, "no vector").when(F.col("c") == 0, "no chunk").when((F.col("c") > 1) | (F.col("v") > 1), "repeated")
    return both.select("key", problem.alias("problem")).where("problem is not null")


def reproduced(old: DataFrame, new: DataFrame, key: str, least: float) -> DataFrame:
    """One row: vectors compared, worst and mean cosine, the key of the worst, and whether all reach `least`."""
    cosine = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y), F.lit(0.0), lambda s, x: s + x)
    both = old.select(key, F.col("embedding").alias("a")).join(new.select(key, F.col("embedding").alias("b")), key)
    norm = F.sqrt(cosine("a", "a")) * F.sqrt(cosine("b", "b"))
    c = both.select(key, F.when(norm == 0, 0.0).otherwise(cosine("a", "b") / norm).alias("c"))
    return c.agg(F.count("*").alias("compared"), F.round(F.min("c"), 5).alias("worst"), F.round(F.avg("c"), 5).alias("mean"), F.min_by(key, F.struct(F.round("c", 9), key)).alias("worst_key"), (F.min("c") >= least).alias("same"))


def repaired(text: Column) -> Column:
    """Composed characters (NFC) without control characters."""
    return F.regexp_replace(each_text(text, lambda t: None if t is None else unicodedata.normalize("NFC", t), "string"), CONTROL, "")


def lexicon_words(lines: DataFrame, line: str) -> DataFrame:
    """The words of a list: one to a line, either kind of line end, in lower case; blank lines and # comments left out."""
    word = F.lower(F.trim(F.regexp_replace(line, r"[\r\n]+$", "")))
    return lines.select(word.alias("word")).where((F.length("word") > 0) & ~F.col("word").startswith("#")).distinct()


def all_issues(parts: dict[str, tuple[str, DataFrame]]) -> DataFrame:
    """(doc_id, rule, severity, issues): all rules as one table. parts: rule to its severity and the rows that break it."""
    out = None
    for rule, (severity, rows) in parts.items():
        one = rows.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.count("*").alias("issues")).select("doc_id", F.lit(rule).alias("rule"), F.lit(severity).alias("severity"), "issues")
        out = one if out is None else out.unionByName(one)
    return out


def valid_documents(documents: DataFrame, issues: DataFrame) -> DataFrame:
    """Documents that break no rule of severity error."""
    return documents.join(issues.where("severity = 'error'").select("doc_id").distinct(), "doc_id", "left_anti")


def keep_keys(shards: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows of shards whose key is in the set; the rows' order and columns stay."""
    return shards.join(keys.select(key).distinct(), key, "left_semi")
