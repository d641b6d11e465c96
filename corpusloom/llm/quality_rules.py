"""Quality rules: counts of each text, and the frequency of its lines across documents."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import Block, blocks, few, materialise, mix, signed

MIN_WORDS = 10
REPEAT_PERCENT = 20
WINDOW = 5
#: A line is removed where more distinct documents of one host hold it than both limits allow.
LINE_MIN_DOCUMENTS = 20
LINE_HOST_SHARE = 0.05
#: So many documents of a host are enough whatever their share, as in a large host no line has the share.
LINE_ENOUGH_DOCUMENTS = 1000
#: A document is depleted when fewer words than MIN_WORDS or than this share of its words are left.
LEFT_SHARE = 0.2

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _repeats(block: Block, hashes: np.ndarray, row: np.ndarray) -> np.ndarray:
    """For each word, whether a window of five words around it is found twice or more in its text."""
    n = len(hashes) - WINDOW + 1
    covered = np.zeros(len(hashes), dtype=bool)
    if n <= 0:
        return covered
    key = np.zeros(n, dtype=np.uint64)
    for k in range(WINDOW):
        key = key * np.uint64(0xD6E8FEB86659FD93) + hashes[k : k + n]
    at = np.flatnonzero(row[:n] == row[WINDOW - 1 :])
    key = mix(key[at] + row[at].astype(np.uint64) * np.uint64(0xA0761D6478BD642F))
    order = np.argsort(key)
    same = key[order[1:]] == key[order[:-1]]
    twice = np.zeros(len(at), dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    step = np.zeros(len(hashes) + 1, dtype=np.int32)
    np.add.at(step, at[twice], 1)
    np.add.at(step, at[twice] + WINDOW, -1)
    return np.cumsum(step[:-1]) > 0


def measure(block: Block) -> dict[str, np.ndarray]:
    """The counts of each row, and its lines: hash (normalised), words, row."""
    buf, rows = block.buf, block.rows
    inside = block.inside()
    starts, ends, row = block.words(inside)
    prefix = block.prefix_hash()
    hashes = block.span_hash(prefix, starts, ends)
    covered = _repeats(block, hashes, row)
    out = {
        "n_words": np.bincount(row, minlength=rows),
        "word_chars": block.per_row(inside & ((buf & 0xC0) != 0x80)),
        "n_symbols": block.per_row(_SYMBOL[buf]),
        "n_repeat_words": np.bincount(row[covered], minlength=rows),
    }
    breaks = np.flatnonzero(buf == 10)
    line_start = np.union1d(block.offsets[:-1], breaks + 1)
    line_start = line_start[line_start < len(buf)]
    line_row = block.row_of(line_start)
    line_end = np.minimum(np.append(line_start[1:], len(buf)), block.offsets[1:][line_row])
    line_end = line_end - ((line_end > line_start) & (buf[line_end - 1] == 10))
    seen = np.searchsorted(starts, line_start)
    line_words = np.searchsorted(starts, line_end) - seen
    keep = line_words > 0
    line_start, line_end, line_row, line_words, seen = (x[keep] for x in (line_start, line_end, line_row, line_words, seen))
    exact = mix(block.span_hash(prefix, line_start, line_end) + line_row.astype(np.uint64) * np.uint64(0xA0761D6478BD642F))
    distinct = np.unique(exact, return_index=True)[1]
    out["n_dup_lines"] = np.bincount(line_row, minlength=rows) - np.bincount(line_row[distinct], minlength=rows)
    # A normalised line is its words in lower case, whatever white space lies between them.
    low = Block(_LOWER[buf], block.offsets)
    folded = low.span_hash(low.prefix_hash(), starts, ends)
    place = (np.arange(len(starts)) - np.repeat(seen, line_words)).astype(np.uint64)
    parts = mix(folded + place * np.uint64(0x9E3779B97F4A7C15))
    out["line_hash"] = mix(np.add.reduceat(parts, seen)) if len(seen) else np.zeros(0, dtype=np.uint64)
    out["line_words"], out["line_row"] = line_words, line_row
    return out


def _lists(values: np.ndarray, row: np.ndarray, rows: int, kind: pa.DataType) -> pa.Array:
    offsets = np.zeros(rows + 1, dtype=np.int32)
    np.cumsum(np.bincount(row, minlength=rows), out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, type=kind))


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        text = batch.column("text")
        for lo, hi, block in blocks(text):
            m = measure(block)
            cols = [pc.cast(batch.column(c), pa.int64()).slice(lo, hi - lo) for c in ("doc_id", "text_hash")]
            cols.append(batch.column("host").slice(lo, hi - lo).cast(pa.string()))
            cols += [pa.array(m[c], type=pa.int64()) for c in _COUNTS]
            cols.append(_lists(signed(m["line_hash"]), m["line_row"], hi - lo, pa.int64()))
            cols.append(_lists(m["line_words"], m["line_row"], hi - lo, pa.int32()))
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "text_hash", "host", *_COUNTS, "line_hash", "line_words"])


def line_measures(documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """One row per document with its counts and its lines' hashes, kept as a table; row_id tells repeated rows apart."""
    rows = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.col(host_col).cast("string").alias("host"), F.xxhash64(F.col(text_col)).alias("text_hash"))
    schema = "doc_id long, text_hash long, host string, " + ", ".join(f"{c} long" for c in _COUNTS) + ", line_hash array<long>, line_words array<int>"
    return materialise(rows.mapInArrow(_measured, schema).withColumn("row_id", F.monotonically_increasing_id()), "lines")


def frequent_lines(measured: DataFrame, *, min_documents: int = LINE_MIN_DOCUMENTS, host_share: float = LINE_HOST_SHARE, enough_documents: int = LINE_ENOUGH_DOCUMENTS) -> DataFrame:
    """Lines (host, line) that more distinct documents of a host hold than allowed; equal rows are one document."""
    # The rows of one document (id and text) fall together first, then its lines are counted once.
    document = measured.groupBy("host", "doc_id", "text_hash").agg(F.first("line_hash").alias("line_hash"))
    lines = document.select("host", F.explode(F.array_distinct("line_hash")).alias("line"))
    common = lines.groupBy("host", "line").agg(F.count("*").alias("holders")).where(F.col("holders") > min_documents)
    hosts = document.groupBy("host").agg(F.count("*").alias("documents")).withColumnRenamed("host", "of_host")
    return common.join(hosts, F.col("host").eqNullSafe(F.col("of_host"))).where((F.col("holders") > F.col("documents") * host_share) | (F.col("holders") > enough_documents)).select("host", "line", "holders")


def verdicts(measured: DataFrame, frequent: DataFrame, *, left_share: float = LEFT_SHARE) -> DataFrame:
    """Add base_failed, kept, removed_words and removed_lines (hashes) to the measured rows."""
    lines = measured.select("row_id", F.col("host").alias("line_host"), F.explode(F.arrays_zip("line_hash", "line_words")).alias("x")).select("row_id", "line_host", F.col("x.line_hash").alias("hash"), F.col("x.line_words").alias("words"))
    hit = lines.join(frequent, F.col("line_host").eqNullSafe(F.col("host")) & (F.col("hash") == F.col("line")))
    removed = hit.groupBy("row_id").agg(F.sum("words").cast("long").alias("removed_words"), F.collect_set("hash").alias("removed_lines"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    left = F.col("n_words") - F.col("removed_words")
    out = measured.drop("line_hash", "line_words").join(removed, "row_id", "left")
    out = out.withColumn("removed_words", F.coalesce("removed_words", F.lit(0).cast("long"))).withColumn("base_failed", failed)
    depleted = (F.col("removed_words") > 0) & ((left < MIN_WORDS) | (left < F.col("n_words") * left_share))
    return out.withColumn("kept", ~F.col("base_failed") & ~depleted)


def quality_rules(documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", min_documents: int = LINE_MIN_DOCUMENTS, host_share: float = LINE_HOST_SHARE, enough_documents: int = LINE_ENOUGH_DOCUMENTS, left_share: float = LEFT_SHARE) -> DataFrame:
    """Judge every document by its own counts and by how much of it are lines common to its host.

    Lines are hashed in lower case with white space folded; per host the distinct documents that
    hold a line are counted, lines above min_documents and host_share, or above enough_documents
    whatever their share, are removed, and a document of which fewer
    than MIN_WORDS words or less than left_share is left is rejected.

    Null text: like empty text, so it fails for too few words. Null host: a host of its own. Null
    ids are returned as they are. A document is an id with its text: copies under other ids are
    holders of a line as well, equal rows count once, are judged alike and all returned. An empty table gives no rows. Other columns are ignored.
    """
    measured = line_measures(documents, id_col=id_col, text_col=text_col, host_col=host_col)
    frequent = frequent_lines(measured, min_documents=min_documents, host_share=host_share, enough_documents=enough_documents)
    judged = verdicts(measured, frequent, left_share=left_share)
    return judged.select("doc_id", "n_words", *_COUNTS[1:], "base_failed", "kept", "removed_words")


def remove_lines(documents: DataFrame, *, host_col: str = "source", **limits) -> DataFrame:
    """The documents that are kept, without the removed lines; the columns stay those of documents.

    Null and empty texts fail. A document is its id, text and host: rows equal in these share a
    verdict, and all that are kept stay. n_chars follows the text if there is such a column. Other
    columns stay as they are, whatever their names. An empty table gives no rows.
    """
    measured = line_measures(documents, host_col=host_col)
    judged = verdicts(measured, frequent_lines(measured, **limits)).where(~F.col("kept") | F.col("removed_lines").isNotNull())
    place = [F.coalesce("doc_id", F.lit(0)).alias("m_id"), F.col("doc_id").isNull().alias("m_null"), F.coalesce("text_hash", F.lit(0)).alias("m_hash"), F.coalesce("host", F.lit("")).alias("m_host"), F.col("host").isNull().alias("m_free")]
    names = ["m_id", "m_null", "m_hash", "m_host", "m_free"]
    marks = materialise(judged.select(*place, "kept", "removed_lines").groupBy(*names).agg(F.first("kept").alias("kept"), F.first("removed_lines").alias("lines")), "marks")
    sent = few(marks.select(*names), extra="length(m_host)")
    carried = documents.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), F.col(host_col).cast("string").alias("host")).select("row", *place)
    # Most rows are left as they are and need not be looked into.
    whole = carried.join(sent, names, "left_anti").select("row.*")
    lines = few(marks.where("kept").select(*names, "lines"), extra="length(m_host) + 8 * size(lines)")
    return whole.unionByName(carried.join(lines, names).select("row", "lines").mapInArrow(_without_lines, documents.schema))


def _without_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows, marks = batch.column("row"), batch.column("lines").to_pylist()
        names = [f.name for f in rows.type]
        cols = dict(zip(names, rows.flatten(), strict=True))
        if any(marks):
            texts = cols["text"].to_pylist()
            sizes = cols["n_chars"].to_pylist() if "n_chars" in cols else None
            for i, gone in enumerate(marks):
                if gone:
                    texts[i] = "\n".join(_kept_lines(texts[i], set(gone)))
                    if sizes is not None:
                        sizes[i] = len(texts[i])
            cols["text"] = pa.array(texts, type=cols["text"].type)
            if sizes is not None:
                cols["n_chars"] = pa.array(sizes, type=cols["n_chars"].type)
        yield pa.RecordBatch.from_arrays([cols[n] for n in names], names=names)


def _kept_lines(text: str, gone: set[int]) -> list[str]:
    lines = text.split("\n")
    _, _, block = next(blocks(pa.array([text])))
    hashes = iter(signed(measure(block)["line_hash"]).tolist())
    return [line for line in lines if not line.encode().split() or next(hashes) not in gone]
