"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams."""

from __future__ import annotations

import re
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import crc_of_id, labelled_sample, materialise, mix, release
from corpusloom.llm.lexicon import Lexicon, cuts

BITS = 20
ALPHA, BETA, L1, L2 = 0.3, 1.0, 25.0, 1.0
EPOCHS = 5
#: Toxic rows are rarer; they weigh so much more.
POSITIVE_WEIGHT = 6.0
SAMPLE = 8000
#: The cut is placed by scores of folds that were left out.
PARTS = 4
FOLDS, HELD_OUT = 3, 1
THRESHOLD = 0.7

_EDGE = ".,!?;:\"'()[]{}*&%$#|<>-_"
#: Besides whole words, their beginnings of these lengths count as words, so that inflected forms meet.
STEMS = (4, 5, 6, 7, 8)
_KIND = np.dtype([("hash", np.uint64), ("stems", np.uint64, len(STEMS))])
_lexicon: list[Lexicon] = []


def _describe(word: bytes) -> tuple:
    low = word.decode("utf-8", "replace").strip(_EDGE).lower()
    return xxhash.xxh64_intdigest(low), tuple(xxhash.xxh64_intdigest(low[:k], k) for k in STEMS)


def features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed words, their stems, neighbouring pairs and pairs one word apart; and the text each is in."""
    if not _lexicon:
        _lexicon.append(Lexicon(_describe, _KIND))
    said, row, _ = _lexicon[0].words_of(texts)
    h = said["hash"]
    parts, rows = [mix(h), said["stems"].reshape(-1)], [row, np.repeat(row, len(STEMS))]
    for gap, salt in ((1, 0x9E3779B97F4A7C15), (2, 0xC2B2AE3D27D4EB4F)):
        near = np.flatnonzero(row[gap:] == row[:-gap])
        parts.append(mix(h[near] * np.uint64(salt) + mix(h[near + gap] + np.uint64(gap))))
        rows.append(row[near])
    return (np.concatenate(parts) >> np.uint64(64 - BITS)).astype(np.int64), np.concatenate(rows)


@dataclass
class Weights:
    """The features that kept a weight, and the bias, moved so that the threshold fits."""

    at: np.ndarray
    value: np.ndarray
    bias: float

    def dense(self) -> np.ndarray:
        out = np.zeros(1 << BITS)
        out[self.at] = self.value
        return out


#: A longer text is read in windows of so many bytes, the last two words of one again at the start of the next.
WINDOW_BYTES = 1 << 20
_GAP = re.compile(rb"[\x20\x09-\x0D]")


def _windows(text: bytes, size: int) -> Iterator[str]:
    lo, tail = 0, b""
    while lo < len(text):
        gap = _GAP.search(text, min(lo + size, len(text)))
        stop = gap.start() if gap else len(text)
        part = tail + text[lo:stop]
        yield part.decode()
        tail, lo = b" ".join(part.rsplit(None, 2)[-2:]) + b" ", stop


def _distinct(text: bytes, dense: np.ndarray, size: int) -> np.ndarray:
    """The distinct features of a text that have a weight: no more than there are weights."""
    found = np.zeros(0, dtype=np.int64)
    for part in _windows(text, size):
        at, _ = features([part])
        found = np.union1d(found, at[dense[at] != 0])
    return found


def logits(texts: list[str | None], dense: np.ndarray, bias: float, *, window: int = WINDOW_BYTES) -> np.ndarray:
    """The sum of the weights of the distinct features of each text."""
    long = {k: raw for k, t in enumerate(texts) if t and len(t) * 4 > window and len(raw := t.encode()) > window}
    at, row = features([None if k in long else t for k, t in enumerate(texts)])
    live = dense[at] != 0
    pair = np.unique(row[live] << BITS | at[live])
    out = bias + np.bincount(pair >> BITS, weights=dense[pair & ((1 << BITS) - 1)], minlength=len(texts))
    for k, raw in long.items():
        out[k] += dense[_distinct(raw, dense, window)].sum()
    return out


def ftrl(examples: list[np.ndarray], labels: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, float]:
    """Per-coordinate steps; the last coordinate is the bias and has no L1."""
    size = 1 << BITS
    z, n = np.zeros(size + 1), np.zeros(size + 1)

    def weight(i: np.ndarray) -> np.ndarray:
        l1 = np.where(i == size, 0.0, L1)
        zi = z[i]
        return np.where(np.abs(zi) <= l1, 0.0, -(zi - np.sign(zi) * l1) / ((BETA + np.sqrt(n[i])) / ALPHA + L2))

    for _ in range(EPOCHS):
        for k in order:
            i = examples[k]
            w = weight(i)
            p = 1 / (1 + np.exp(-np.clip(w.sum(), -30, 30)))
            g = (p - labels[k]) * (POSITIVE_WEIGHT if labels[k] else 1.0)
            sigma = (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / ALPHA
            z[i] += g - sigma * w
            n[i] += g * g
    w = weight(np.arange(size + 1))
    return w[:size], float(w[size])


def _best_cut(score: np.ndarray, label: np.ndarray) -> float:
    """The logit that parts the labels with the best F1, in the middle of the gap it lies in."""
    order = np.argsort(-score, kind="stable")
    hit = np.cumsum(label[order])
    f1 = 2 * hit / (np.arange(1, len(order) + 1) + max(label.sum(), 1))
    k = int(np.argmax(f1))
    low = score[order[k + 1]] if k + 1 < len(order) else score[order[k]] - 1
    return float((score[order[k]] + low) / 2)


def _ordered(got: list[tuple]) -> list[tuple]:
    """Rows (doc_id, text_hash, label, features) by id; copies of a text once, with the label of the smallest id."""
    return sorted({r[1]: r for r in sorted(got, key=lambda r: -r[0])}.values(), key=lambda r: r[0])


def _fit(rows: list[tuple], part: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Weights learned from all folds but `part`, and scores and labels of that fold; PARTS: from all rows."""
    labels = np.array([r[2] for r in rows], dtype=np.float64)
    examples = [np.append(np.asarray(r[3], dtype=np.int32), np.int32(1 << BITS)) for r in rows]
    folds = np.array([xxhash.xxh64_intdigest(r[0].to_bytes(8, "little", signed=True)) % PARTS for r in rows])
    order = np.random.default_rng(5 + part).permutation(np.flatnonzero(folds != part))
    w, b = ftrl(examples, labels, order)
    full = np.append(w, b)
    held = np.flatnonzero(folds == part)
    at = np.append(np.flatnonzero(w), -1)
    return at, np.append(w[at[:-1]], b), np.array([full[examples[i]].sum() for i in held]), labels[held]


def learn(documents: DataFrame, labels: DataFrame, *, label_col: str = "toxic", id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> Weights | None:
    """Weights from about `sample` labelled ids at most, outside the held-out fold; None without any.

    Texts become features where they lie; the fits, four on three of four folds each and one on
    all, are jobs of one task, side by side. A fit takes its rows one after the other, as the method asks; their
    number is bounded by `sample` whatever the size of the corpus. Of an id's unlike labels the
    smallest holds.
    """
    learnable = F.pmod(crc_of_id("_id"), F.lit(FOLDS)) != HELD_OUT
    chosen = labelled_sample(documents, labels, label_col=label_col, id_col=id_col, text_col=text_col, learnable=learnable, bound=sample)

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column("text")
            for lo, hi in cuts(pc.binary_length(text).to_pylist()):
                at, row = features(text.slice(lo, hi - lo).to_pylist())
                pair = np.unique(row << BITS | at)
                ends = np.concatenate([[0], np.cumsum(np.bincount(pair >> BITS, minlength=hi - lo))]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array((pair & ((1 << BITS) - 1)).astype(np.int32)))
                yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(lo, hi - lo) for c in ("doc_id", "text_hash", "label")), lists], names=["doc_id", "text_hash", "label", "x"])
            release()

    def fitted(part: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got: list[tuple] = []
        for batch in batches:
            x = batch.column("x")
            got += [(*row, x[i].values.to_numpy()) for i, row in enumerate(zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text_hash", "label")), strict=True))]
        if got:
            at, value, score, label = _fit(_ordered(got), part)
            kind, a, v = (0, at, value) if part == PARTS else (1, label, score)
            # The examples go before the worker waits for its next task.
            got.clear()
            release()
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(a), kind), type=pa.int32()), pa.array(a, type=pa.int32()), pa.array(v, type=pa.float64())], names=["kind", "at", "value"])

    described_rows = materialise(chosen.withColumn("text_hash", F.xxhash64("text")).select("doc_id", "text_hash", "label", "text").mapInArrow(described, "doc_id long, text_hash long, label int, x array<int>"), "features")

    def fit(part: int) -> pa.Table:
        return described_rows.coalesce(1).mapInArrow(partial(fitted, part), "kind int, at int, value double").toArrow()

    # Each fit is a job of one task that reads the written rows itself. As one union of single partitions they would be one task.
    with ThreadPoolExecutor(PARTS + 1) as pool:
        table = pa.concat_tables(pool.map(fit, range(PARTS + 1)))
    kind, at, value = (table.column(c).to_numpy() for c in ("kind", "at", "value"))
    if not len(kind):
        return None
    w, score, label = kind == 0, value[kind == 1], at[kind == 1].astype(np.float64)
    order = np.argsort(score, kind="stable")
    move = float(np.log(THRESHOLD / (1 - THRESHOLD))) - _best_cut(score[order], label[order]) if 0 < label.sum() < len(label) else 0.0
    return Weights(at[w & (at >= 0)], value[w & (at >= 0)], float(value[w & (at < 0)][0]) + move)


def classify(documents: DataFrame, weights: Weights | None, *, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score (how likely the label is 1) and predicted of each document.

    Null text: like empty text, which gets the bias alone. Without labelled rows every score is 0.
    Null and repeated ids are returned as they are; a null id is in the fold of empty text. Whole
    texts are read. An empty table gives no rows. Other columns are ignored.
    """
    sent = documents.sparkSession.sparkContext.broadcast(weights)

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = sent.value
        dense = None if w is None else w.dense()
        for batch in batches:
            text = batch.column("text")
            for lo, hi in cuts(pc.binary_length(text).to_pylist()):
                part = text.slice(lo, hi - lo).to_pylist()
                score = np.zeros(hi - lo) if w is None else 1 / (1 + np.exp(-np.clip(logits(part, dense, w.bias), -30, 30)))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(lo, hi - lo), batch.column("held_out").slice(lo, hi - lo), pa.array(score), pa.array((score >= threshold).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])
            release()

    rows = documents.select(F.col(id_col).cast("long").alias("doc_id"), (F.pmod(crc_of_id(F.col(id_col)), F.lit(FOLDS)) == HELD_OUT).alias("held_out"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(judged, "doc_id long, held_out boolean, score double, predicted int")
