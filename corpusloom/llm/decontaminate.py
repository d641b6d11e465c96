"""Benchmark decontamination by template windows, so that re-parameterised questions match too."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import few, materialise, mix, signed
from corpusloom.llm.lexicon import Lexicon, cuts

WINDOW = 8
#: Items with fewer words than this are matched as whole lines, as anywhere in a line they are ordinary text.
LEAST_WORDS = 5
#: Of a window's words so many must be literal, or all but one of a shorter window.
LITERALS = 4
COVERAGE = 0.5
#: So many words of an item in a row are a leak, whatever their share of the item.
LITERAL_RUN = 13
#: Up to so many bytes of window hashes are sent to the tasks to sift with; without them all windows are joined by shuffle.
BROADCAST_BYTES = 16 << 20

_NUMBER = re.compile(rb"[+-]?[$]?\d[\d.,:/]*(?:%|[a-z]{1,3})?")
#: Units that follow a number.
UNITS = frozenset("mm cm m km inch inches foot feet yard yards mile miles g kg mg lb lbs ounce ounces ton tons ml l litre litres liter liters gallon gallons second seconds minute minutes hour hours day days week weeks month months year years dollar dollars cent cents euro euros pound pounds percent degree degrees mph kmh".encode().split())
_EDGE = b".,!?;:\"'()[]{}*&%$#|<>"
_KIND = np.dtype([("hash", np.uint64), ("number", bool), ("unit", bool), ("title", bool), ("stop", bool)])


def _describe(word: bytes) -> tuple:
    core = word.strip(_EDGE)
    text = core.decode("utf-8", "replace")
    low = text.lower().encode()
    number = _NUMBER.fullmatch(low) is not None
    title = len(text) > 1 and text[0].isupper() and text[1:].islower()
    return xxhash.xxh64_intdigest(low), number, low in UNITS, title, word[-1:] in b".!?:;"


def _template(lexicon: Lexicon, texts: list[str | None]):
    """Per word: hash of its template token, whether it is a placeholder, its own hash, its text's index; and the words."""
    said, row, words = lexicon.words_of(texts)
    n = len(row)
    first = np.ones(n, dtype=bool)
    first[1:] = (row[1:] != row[:-1]) | said["stop"][:-1]
    number = said["number"]
    unit = np.zeros(n, dtype=bool)
    unit[1:] = said["unit"][1:] & number[:-1] & (row[1:] == row[:-1])
    name = said["title"] & ~first
    token = said["hash"].copy()
    for k, mask in enumerate((number, unit, name)):
        token[mask] = k + 1
    return token, number | unit | name, said["hash"], row, words


def _window_hashes(token: np.ndarray, slot: np.ndarray, row: np.ndarray, width: int, exact: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """First word and hash of each window that lies in one text and has enough literal words, or of all if exact."""
    n = len(token) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    upto = np.zeros(len(token) + 1, dtype=np.int64)
    np.cumsum(~slot, out=upto[1:])
    good = (row[:n] == row[width - 1 :]) & (exact | (upto[width:] - upto[:n] >= min(LITERALS, width - 1)))
    key = np.full(n, width + (WINDOW if exact else 0), dtype=np.uint64)
    for k in range(width):
        key = key * np.uint64(0xD6E8FEB86659FD93) + token[k : k + n]
    at = np.flatnonzero(good)
    return at, mix(key[at])


_lexicon: list[Lexicon] = []


def _words(texts: list[str | None]):
    if not _lexicon:
        _lexicon.append(Lexicon(_describe, _KIND))
    return _template(_lexicon[0], texts)


def _is_line(text: str, at: int, width: int) -> bool:
    """Whether the words from `at` on are the whole of one line."""
    seen = 0
    for line in text.encode().split(b"\n"):
        if seen >= at:
            size = len(line.split())
            if size:
                return seen == at and size == width
        else:
            seen += len(line.split())
    return False


def _window_rows(ids: pa.Array, texts: list[str | None], hashes: pa.Array, widths: list[int] | None, sift) -> Iterator[pa.RecordBatch]:
    """Windows of the widths; of a negative width, windows of exact words. Without widths: those of benchmark items."""
    token, slot, plain, row, words = _words(texts)
    base = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(w) for w in words], out=base[1:])
    out: dict[str, list] = {k: [] for k in ("row", "at", "width", "hash", "template", "slots")}
    longest = int(max(np.diff(base), default=0))
    lone = np.ones(len(texts), dtype=bool)
    for width in [*range(LEAST_WORDS, WINDOW + 1), *range(-WINDOW, 0)] if widths is None else sorted(widths, reverse=True):
        exact, size = width < 0, abs(width)
        at, key = _window_hashes(plain if exact else token, slot, row, size, exact)
        if widths is None and size < WINDOW and longest:
            # Of a benchmark item shorter than the window, the whole text is the window.
            whole = np.diff(base)[row[at]] == size
            at, key = at[whole], key[whole]
        if widths is None:
            # An item none of whose windows has enough literal words is held by its exact words.
            if exact:
                at, key = at[lone[row[at]]], key[lone[row[at]]]
            else:
                lone[row[at]] = False
        if sift is not None:
            near = sift(key)
            at, key = at[near], key[near]
        for i, h in zip(at.tolist(), signed(key).tolist(), strict=True):
            r = int(row[i])
            if exact and size < LEAST_WORDS and widths is not None and not _is_line(texts[r], i - int(base[r]), size):
                continue
            part = words[r][i - base[r] : i - base[r] + size]
            low = [w.strip(_EDGE).decode("utf-8", "replace").lower() for w in part]
            mark = slot[i : i + size] & (not exact)
            tag = token[i : i + size]
            out["row"].append(r)
            out["at"].append(int(i - base[r]))
            out["width"].append(width)
            out["hash"].append(h)
            out["template"].append(("= " if exact else "") + " ".join(f"<{int(t)}>" if m else w for w, m, t in zip(low, mark, tag, strict=True)))
            out["slots"].append([w for w, m in zip(low, mark, strict=True) if m])
    at_rows = pa.array(out["row"], type=pa.int64())
    yield pa.RecordBatch.from_arrays([ids.take(at_rows), hashes.take(at_rows), pa.array(out["at"], type=pa.int32()), pa.array(out["width"], type=pa.int32()), pa.array(out["hash"], type=pa.int64()), pa.array(out["template"], type=pa.string()), pa.array(out["slots"], type=pa.list_(pa.string()))], names=["id", "text_hash", "at", "width", "hash", "template", "slots"])


_SCHEMA = "id long, text_hash long, at int, width int, hash long, template string, slots array<string>"


def template_windows(rows: DataFrame, widths: list[int] | None, known: np.ndarray | None) -> DataFrame:
    """Template windows of rows (id, text): those whose hash is in `known`, or all of them."""
    sent = rows.sparkSession.sparkContext.broadcast(known)

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sift, keys = None, sent.value
        if keys is not None:
            bits = max(16, int(len(keys)).bit_length() + 4)
            table = np.zeros(1 << bits, dtype=bool)
            table[keys & np.uint64((1 << bits) - 1)] = True

            def sift(x: np.ndarray) -> np.ndarray:
                near = np.flatnonzero(table[x & np.uint64((1 << bits) - 1)])
                at = np.minimum(np.searchsorted(keys, x[near]), len(keys) - 1)
                return near[keys[at] == x[near]]

        for batch in batches:
            text = batch.column("text")
            for lo, hi in cuts(pc.binary_length(text).to_pylist()):
                yield from _window_rows(batch.column("id").slice(lo, hi - lo), text.slice(lo, hi - lo).to_pylist(), batch.column("text_hash").slice(lo, hi - lo), widths, sift)

    return rows.select(F.col("id").cast("long").alias("id"), F.col("text").cast("string").alias("text"), F.xxhash64("text").alias("text_hash")).mapInArrow(windows, _SCHEMA)


def _repeated(values: Column) -> Column:
    """Of sorted values those that equal their neighbour."""
    n = F.size(values)
    pairs = F.zip_with(F.slice(values, F.lit(1), F.greatest(n - 1, F.lit(0))), F.slice(values, F.lit(2), F.greatest(n - 1, F.lit(0))), lambda a, b: F.when(a == b, a))
    return F.filter(pairs, lambda x: x.isNotNull())


def contaminated(documents: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", coverage: float = COVERAGE, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """doc_id, text_hash, item_id, n_windows, n_matched, coverage, reparameterised of each leak.

    Numbers, units after numbers and capitalised words inside a sentence become placeholders.
    Windows of eight template words of document and item are joined by hash and compared as text.
    Windows with the item's own values always count. Along one offset a value of an item's slots
    that meets different values in the document, or one of the document's that stands for different
    values of the item, takes the altered windows that hold it out of the count. A document that has at least `coverage` of an item's windows, or LITERAL_RUN of
    its words in a row, is a leak; reparameterised tells whether a slot's value differs.

    An item none of whose windows has enough literal words must be met by all its exact words, and
    one of fewer than five words as a whole line. Null or empty texts match nothing. Rows with equal id and
    text give one result; null ids are kept. Equal items with different ids are all reported. An
    empty table gives no rows. Other columns are ignored.
    """
    items = benchmark.select(F.col(item_col).alias("id"), F.col("text"))
    asked = materialise(template_windows(items, None, None).withColumnRenamed("id", "item_id"), "asked")
    keys = asked.select("hash").distinct()
    bounded = 8 * keys.count() <= broadcast_bytes
    known = np.sort(keys.toArrow().column("hash").to_numpy().view(np.uint64)) if bounded else None
    widths = sorted(w.width for w in asked.select("width").distinct().collect())
    rows = documents.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    if not widths:
        rows, known = rows.limit(0), None
    held = template_windows(rows, widths, known)
    sizes = materialise(asked.groupBy("item_id").agg(F.countDistinct("at").alias("n_windows"), (F.max("width") < 0).alias("exact")), "sizes")
    right = materialise(asked.select("item_id", F.col("at").alias("item_at"), "hash", "template", F.col("slots").alias("item_slots")).distinct(), "templates")
    right, sizes = few(right, extra="length(template) + aggregate(item_slots, 0L, (a, x) -> a + 16 + length(x))"), few(sizes)
    met = held.join(right, ["hash", "template"])
    window = F.struct("item_at", F.abs("width").alias("width"), "item_slots", "slots")
    along = met.groupBy("id", "text_hash", "item_id", (F.col("at") - F.col("item_at")).alias("offset")).agg(F.array_sort(F.collect_set(window)).alias("windows"))
    pairs = F.array_distinct(F.flatten(F.transform("windows", lambda w: F.arrays_zip(w["item_slots"].alias("of"), w["slots"].alias("to")))))
    # A value that stands in more than one pair meets different values on the other side.
    torn = lambda side: F.array_distinct(_repeated(F.array_sort(F.transform(pairs, lambda p: p[side]))))
    along = along.withColumn("torn_of", torn("of")).withColumn("torn_to", torn("to"))
    same = lambda w: w["item_slots"] == w["slots"]
    whole = lambda w: ~F.arrays_overlap(w["item_slots"], F.col("torn_of")) & ~F.arrays_overlap(w["slots"], F.col("torn_to"))
    along = along.withColumn("good", F.filter("windows", lambda w: same(w) | whole(w)))

    def longer(state: Column, w: Column) -> Column:
        begin = F.when(w["item_at"] <= state["end"], state["begin"]).otherwise(w["item_at"])
        end = w["item_at"] + w["width"]
        return F.struct(begin.alias("begin"), end.alias("end"), F.greatest(state["best"], end - begin).alias("best"))

    none = F.struct(F.lit(-1).alias("begin"), F.lit(-1).alias("end"), F.lit(0).alias("best"))
    run = F.aggregate(F.filter("windows", same), none, longer, lambda x: x["best"])
    consistent = along.where(F.size("good") > 0).select("id", "text_hash", "item_id", F.transform("good", lambda w: w["item_at"]).alias("places"), F.exists("good", lambda w: ~same(w)).alias("differs"), run.alias("run"))
    found = consistent.groupBy("id", "text_hash", "item_id").agg(F.size(F.array_distinct(F.flatten(F.collect_list("places")))).cast("long").alias("n_matched"), F.max("differs").alias("reparameterised"), F.max("run").alias("run"))
    out = found.join(sizes, "item_id").withColumn("coverage", F.col("n_matched") / F.col("n_windows"))
    least = F.when(F.col("exact"), 1.0).otherwise(F.lit(coverage))
    return out.where((F.col("coverage") >= least) | (F.col("run") >= LITERAL_RUN)).select(F.col("id").alias("doc_id"), "text_hash", "item_id", F.col("n_windows").cast("long").alias("n_windows"), "n_matched", "coverage", "reparameterised")


def clean_documents(documents: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents without the leaks; the columns stay, whatever their names.

    A document is its id and text: rows equal in both are judged alike, and all clean ones stay.
    Null ids are values like any other; null and empty texts are clean. An empty table of either
    kind takes nothing out.
    """
    found = contaminated(documents, benchmark, **options)
    names = ["m_id", "m_null", "m_hash"]
    leaks = materialise(found.select(F.coalesce("doc_id", F.lit(0)).alias("m_id"), F.col("doc_id").isNull().alias("m_null"), F.col("text_hash").alias("m_hash")).distinct(), "leaks")
    carried = documents.select(F.struct("*").alias("row"), F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("m_id"), F.col("doc_id").isNull().alias("m_null"), F.xxhash64("text").alias("m_hash"))
    return carried.join(few(leaks), names, "left_anti").select("row.*")
