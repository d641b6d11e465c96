"""Language identification with hyperdimensional profiles of letter trigrams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import DRAWS, crc_of_id, drawn, few, materialise
from corpusloom.llm.lexicon import cuts

DIMENSION = 1024
#: A prototype is bundled from about so many documents of its language at most, chosen by a hash of id and text.
SAMPLE = 3000
FOLDS, HELD_OUT = 5, 0
UNDETERMINED = "und"

_alpha: list[np.ndarray] = []
_letters: dict[int, np.ndarray] = {}


def _is_letter(codes: np.ndarray) -> np.ndarray:
    if not _alpha:
        _alpha.append(np.array([chr(i).isalpha() for i in range(0x110000)]))
    return _alpha[0][codes]


def letter_vector(code: int) -> np.ndarray:
    """A random vector of -1 and 1 for each letter; 0 stands for what lies between words."""
    if code not in _letters:
        if len(_letters) > 20_000:
            _letters.clear()
        _letters[code] = (np.random.default_rng(9_000_000 + code).integers(0, 2, DIMENSION) * 2 - 1).astype(np.float32)
    return _letters[code]


def trigram_vectors(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Bind the letters' vectors, each permuted by its place."""
    codes, at = np.unique(np.concatenate([a, b, c]), return_inverse=True)
    table = np.stack([letter_vector(int(x)) for x in codes])
    n = len(a)
    return np.roll(table, 2, axis=1)[at[:n]] * np.roll(table, 1, axis=1)[at[n : 2 * n]] * table[at[2 * n :]]


def profiles(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """The bundle of each text's trigram vectors, scaled to length one, and whether it has a letter."""
    low = [(t or "").lower() for t in texts]
    out = np.zeros((len(texts), DIMENSION), dtype=np.float32)
    size = np.array([len(x) + 2 for x in low])
    codes = np.frombuffer("".join(f" {x} " for x in low).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    row = np.repeat(np.arange(len(texts)), size)
    letter = _is_letter(codes)
    has = np.bincount(row[letter], minlength=len(texts)) > 0
    codes = np.where(letter, codes, 0)
    keep = np.ones(len(codes), dtype=bool)
    keep[1:] = letter[1:] | letter[:-1] | (row[1:] != row[:-1])
    codes, row = codes[keep].astype(np.int64), row[keep]
    inner = np.flatnonzero((row[:-2] == row[2:]) & (codes[1:-1] + codes[:-2] + codes[2:] > 0)) if len(codes) > 2 else np.zeros(0, dtype=np.int64)
    if not len(inner):
        return out, has
    used, small = np.unique(codes, return_inverse=True)
    base = len(used)
    key = (small[inner] * base + small[inner + 1]) * base + small[inner + 2]
    if base**3 <= 1 << 24:
        seen = np.flatnonzero(np.bincount(key, minlength=base**3))
        place = np.zeros(base**3, dtype=np.int64)
        place[seen] = np.arange(len(seen))
        kind = place[key]
    else:
        seen, kind = np.unique(key, return_inverse=True)
    at, rows = row[inner], len(texts)
    for lo in range(0, len(seen), 2048):
        part = seen[lo : lo + 2048]
        vectors = trigram_vectors(used[part // (base * base)], used[part // base % base], used[part % base])
        mine = (kind >= lo) & (kind < lo + len(part)) if len(seen) > 2048 else slice(None)
        counts = np.bincount(at[mine] * len(part) + kind[mine] - lo, minlength=rows * len(part))
        out += counts.reshape(rows, len(part)).astype(np.float32) @ vectors
    out /= np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)
    return out, has


def learn(documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE) -> tuple[list[str], np.ndarray]:
    """Languages and their prototypes: the bundled profiles of each language's documents.

    Of each language about `sample` documents at most are bundled, all of a rarer one, so that no
    language is lost beside larger ones.
    """
    rows = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    rows = rows.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (F.pmod(crc_of_id(), F.lit(FOLDS)) != HELD_OUT))
    counts = few(materialise(rows.groupBy("lang").count(), "languages"), extra="length(lang)")
    share = F.lit(sample) / F.col("count") * DRAWS
    chosen = rows.join(counts, "lang").where(drawn(F.xxhash64("doc_id", "text")) < share)

    def bundled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            text, lang = batch.column("text"), np.array(batch.column("lang").to_pylist())
            for lo, hi in cuts(pc.binary_length(text).to_pylist()):
                vectors, has = profiles(text.slice(lo, hi - lo).to_pylist())
                for name in np.unique(lang[lo:hi][has]):
                    total[name] = total.get(name, 0) + vectors[(lang[lo:hi] == name) & has].sum(axis=0, dtype=np.float64)
        if total:
            at = np.tile(np.arange(DIMENSION), len(total))
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(list(total), DIMENSION)), pa.array(at, type=pa.int32()), pa.array(np.concatenate(list(total.values())))], names=["lang", "at", "value"])

    parts = chosen.select("text", "lang").mapInArrow(bundled, "lang string, at int, value double")
    # Sums of small integers over a norm: rounding keeps them alike in whatever order they arrive.
    sums = parts.groupBy("lang", "at").agg(F.round(F.sum("value"), 6).alias("value")).toArrow()
    names = sorted(set(sums.column("lang").to_pylist()))
    out = np.zeros((len(names), DIMENSION))
    out[np.searchsorted(names, sums.column("lang").to_pylist()) if names else [], sums.column("at").to_numpy()] = sums.column("value").to_numpy()
    out /= np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)
    return names, out.astype(np.float32)


def identify(documents: DataFrame, names: list[str], prototypes: np.ndarray, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, lang_pred and score (half of one plus the best cosine) of each document.

    Null texts and texts without a letter: 'und' and 0, as are all texts if nothing was learned. A
    tie goes to the language whose name is first. Null and repeated ids are returned as they are.
    Whole texts are read. An empty table gives no rows. Other columns are ignored.
    """
    sent = documents.sparkSession.sparkContext.broadcast((names, prototypes))

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, known = sent.value
        for batch in batches:
            text = batch.column("text")
            for lo, hi in cuts(pc.binary_length(text).to_pylist()):
                vectors, has = profiles(text.slice(lo, hi - lo).to_pylist())
                cosine = vectors @ known.T if langs else np.zeros((hi - lo, 1))
                best = cosine.argmax(axis=1)
                good = has & bool(langs)
                lang = [langs[k] if g else UNDETERMINED for k, g in zip(best, good, strict=True)]
                score = np.where(good, np.clip((1 + cosine[np.arange(hi - lo), best]) / 2, 0, 1), 0.0)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(lo, hi - lo), batch.column("held_out").slice(lo, hi - lo), pa.array(lang, type=pa.string()), pa.array(score.astype(np.float64))], names=["doc_id", "held_out", "lang_pred", "score"])

    rows = documents.select(F.col(id_col).cast("long").alias("doc_id"), (F.pmod(crc_of_id(F.col(id_col)), F.lit(FOLDS)) == HELD_OUT).alias("held_out"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(judged, "doc_id long, held_out boolean, lang_pred string, score double")
