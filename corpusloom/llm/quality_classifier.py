"""Quality classifier: random-indexing word vectors pooled per document, and a two-layer network."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import crc_of_id, labelled_sample, materialise
from corpusloom.llm.lexicon import Lexicon, cuts

DIMENSION = 32
#: Words share so many vectors by hash, and shapes so many more; this bounds what is broadcast.
WORD_ROWS, SHAPE_ROWS = 8192, 1024
SAMPLE = 6000
FOLDS, HELD_OUT = 5, 0
THRESHOLD = 0.3
HIDDEN = 24
#: Mini-batches that a network learns from, and after how many it is looked at, whatever the number of rows.
STEPS, LOOK, BATCH = 4500, 300, 64
SEED = 11

_RUN = re.compile(r"(.)\1+", re.S)
_KIND = np.dtype([("word", np.int64), ("shape", np.int64), ("hash", np.uint64)])
_lexicon: list[Lexicon] = []


def shape_of(word: str) -> str:
    """Upper case X, lower case x, digits 9, other characters as they are; runs as one."""
    kinds = "".join("X" if c.isupper() else "x" if c.isalpha() else "9" if c.isdigit() else c for c in word)
    return _RUN.sub(r"\1", kinds)


def _describe(word: bytes) -> tuple:
    text = word.decode("utf-8", "replace")
    h = xxhash.xxh64_intdigest(text.lower())
    return h % WORD_ROWS, WORD_ROWS + xxhash.xxh64_intdigest(shape_of(text)) % SHAPE_ROWS, h


def _words(texts: list[str | None]):
    if not _lexicon:
        _lexicon.append(Lexicon(_describe, _KIND))
    said, row, _ = _lexicon[0].words_of(texts)
    return said, row


def index_vectors() -> np.ndarray:
    """Sparse random vectors of -1, 0 and 1, the same everywhere."""
    draw = np.random.default_rng(SEED).random((WORD_ROWS + SHAPE_ROWS, DIMENSION))
    return (draw > 0.9).astype(np.float32) - (draw < 0.1).astype(np.float32)


def _context(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """For each word and shape met: the sum of the index vectors of the words and shapes beside it."""
    said, row = _words(texts)
    index = index_vectors()
    both = index[said["word"]] + index[said["shape"]]
    around = np.zeros_like(both)
    for gap in (1, 2):
        near = (row[gap:] == row[:-gap])[:, None]
        around[gap:] += both[:-gap] * near
        around[:-gap] += both[gap:] * near
    rows, at = np.unique(np.concatenate([said["word"], said["shape"]]), return_inverse=True)
    total = np.zeros((len(rows), DIMENSION))
    order = np.argsort(at, kind="stable")
    twice = np.concatenate([around, around])[order]
    if len(rows):
        total = np.add.reduceat(twice.astype(np.float64), np.searchsorted(at[order], np.arange(len(rows))), axis=0)
    return rows, total


def pooled(texts: list[str | None], vectors: np.ndarray) -> np.ndarray:
    """Per text: mean word and shape vectors over all words and over distinct ones, and their sizes."""
    said, row = _words(texts)
    n = len(texts)
    out = np.zeros((n, 4 * DIMENSION + 5), dtype=np.float32)
    count = np.bincount(row, minlength=n)
    if not len(row):
        return out
    some = np.flatnonzero(count)
    # The row stands above 40 bits of the hash, so that one sort brings the equal words of a text together.
    key = row.astype(np.uint64) << np.uint64(40) | said["hash"] >> np.uint64(24)
    order = np.argsort(key)
    new = np.ones(len(order), dtype=bool)
    new[1:] = key[order[1:]] != key[order[:-1]]
    one = order[new]
    distinct = np.bincount(row[one], minlength=n)
    begin = np.concatenate([[0], np.cumsum(distinct)[:-1]])[some]
    times = np.diff(np.append(np.flatnonzero(new), len(order))).astype(np.float32)[:, None]
    word, shape = vectors[said["word"][one]], vectors[said["shape"][one]]
    for k, (part, size) in enumerate(((word * times, count), (shape * times, count), (word, distinct), (shape, distinct))):
        out[some, k * DIMENSION : (k + 1) * DIMENSION] = np.add.reduceat(part, begin, axis=0) / size[some, None]
    # Repetition shows in few distinct words, few distinct pairs, and words that stand twice.
    inside = row[:-1] == row[1:]
    pair = (said["hash"][:-1] * np.uint64(0x9E3779B97F4A7C15) + said["hash"][1:])[inside]
    pair = np.sort(row[:-1][inside].astype(np.uint64) << np.uint64(40) | pair >> np.uint64(24))
    first = np.ones(len(pair), dtype=bool)
    first[1:] = pair[1:] != pair[:-1]
    pairs = np.bincount((pair[first] >> np.uint64(40)).astype(np.int64), minlength=n)
    again = row[1:][inside & (said["hash"][1:] == said["hash"][:-1])]
    out[:, -5] = np.bincount(again, minlength=n) / np.maximum(count - 1, 1)
    out[:, -4] = np.log1p(count) / 5
    out[:, -3] = distinct / np.maximum(count, 1)
    out[:, -2] = pairs / np.maximum(count - 1, 1)
    out[:, -1] = count == 0
    return out


@dataclass
class Network:
    """Two layers over standardised features, and a temperature for its logit."""

    vectors: np.ndarray
    mean: np.ndarray
    spread: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logit(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.spread, -6, 6)
        return np.maximum(z @ self.w1 + self.b1, 0) @ self.w2 + self.b2

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(x) / self.temperature, -30, 30)))


def train(x: np.ndarray, y: np.ndarray, vectors: np.ndarray) -> Network:
    """Adam over mini-batches of four fifths; the temperature is fitted on the other fifth."""
    rng = np.random.default_rng(SEED)
    n, width = x.shape
    order = rng.permutation(n)
    fit, check = order[n // 5 :], order[: n // 5]
    mean, spread = x[fit].mean(axis=0), x[fit].std(axis=0) + 1e-3
    net = Network(vectors, mean, spread, (rng.normal(size=(width, HIDDEN)) * np.sqrt(2 / width)).astype(np.float32), np.zeros(HIDDEN, np.float32), (rng.normal(size=HIDDEN) * np.sqrt(1 / HIDDEN)).astype(np.float32), 0.0)
    z = np.clip((x - mean) / spread, -6, 6).astype(np.float32)
    state = {k: [np.zeros_like(np.asarray(getattr(net, k), dtype=np.float32)) for _ in range(2)] for k in ("w1", "b1", "w2", "b2")}
    step = 0
    best, kept = np.inf, None

    def loss(rows: np.ndarray, t: float = 1.0) -> float:
        v = np.clip(net.logit(x[rows]) / t, -30, 30)
        return float(np.mean(np.logaddexp(0, v) - y[rows] * v)) if len(rows) else 0.0

    while step < STEPS and len(fit):
        rng.shuffle(fit)
        for lo in range(0, len(fit), BATCH):
            at = fit[lo : lo + BATCH]
            hidden = np.maximum(z[at] @ net.w1 + net.b1, 0)
            p = 1 / (1 + np.exp(-np.clip(hidden @ net.w2 + net.b2, -30, 30)))
            d = ((p - y[at]) / len(at)).astype(np.float32)
            back = np.outer(d, net.w2) * (hidden > 0)
            grad = {"w2": hidden.T @ d + 1e-4 * net.w2, "b2": d.sum(), "w1": z[at].T @ back + 1e-4 * net.w1, "b1": back.sum(axis=0)}
            step += 1
            for k, g in grad.items():
                m, v = state[k]
                m[...] = 0.9 * m + 0.1 * g
                v[...] = 0.999 * v + 0.001 * g * g
                setattr(net, k, getattr(net, k) - 0.003 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8))
            if step % LOOK == 0 and len(check) and (now := loss(check)) < best:
                best, kept = now, (net.w1.copy(), net.b1.copy(), net.w2.copy(), net.b2)
            if step == STEPS:
                break
    if kept is not None:
        net.w1, net.b1, net.w2, net.b2 = kept
    grid = np.exp(np.linspace(-1.5, 1.5, 61))
    net.temperature = float(grid[int(np.argmin([loss(check, t) for t in grid]))]) if len(check) else 1.0
    return net


def learn(documents: DataFrame, labels: DataFrame, *, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> Network | None:
    """Word vectors and network from a bounded sample; None if no labelled row may be learned from."""
    spark = documents.sparkSession
    learnable = F.pmod(crc_of_id("_id"), F.lit(FOLDS)) != HELD_OUT
    chosen = materialise(labelled_sample(documents, labels, label_col=label_col, id_col=id_col, text_col=text_col, learnable=learnable, bound=sample), "sample")

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column("text")
            for lo, hi in cuts(pc.binary_length(text).to_pylist(), 8 << 20):
                rows, total = _context(text.slice(lo, hi - lo).to_pylist())
                yield pa.RecordBatch.from_arrays([pa.array(rows, type=pa.int32()), pa.FixedSizeListArray.from_arrays(pa.array(total.reshape(-1)), DIMENSION).cast(pa.list_(pa.float64()))], names=["at", "vector"])

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((WORD_ROWS + SHAPE_ROWS, DIMENSION))
        met = np.zeros(len(total), dtype=bool)
        for batch in batches:
            at = batch.column("at").to_numpy()
            np.add.at(total, at, batch.column("vector").flatten().to_numpy().reshape(-1, DIMENSION))
            met[at] = True
        rows = np.flatnonzero(met)
        yield pa.RecordBatch.from_arrays([pa.array(rows, type=pa.int32()), pa.FixedSizeListArray.from_arrays(pa.array(total[rows].reshape(-1)), DIMENSION).cast(pa.list_(pa.float64()))], names=["at", "vector"])

    kind = "at int, vector array<double>"
    table = chosen.select("text").mapInArrow(contexts, kind).repartition(8, "at").mapInArrow(summed, kind).toArrow()
    if not table.num_rows:
        return None
    vectors = np.zeros((WORD_ROWS + SHAPE_ROWS, DIMENSION), dtype=np.float32)
    value = table.column("vector").combine_chunks().flatten().to_numpy().reshape(-1, DIMENSION)
    vectors[table.column("at").to_numpy()] = value / np.maximum(np.linalg.norm(value, axis=1, keepdims=True), 1e-9)
    sent = spark.sparkContext.broadcast(vectors)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column("text")
            for lo, hi in cuts(pc.binary_length(text).to_pylist()):
                x = pooled(text.slice(lo, hi - lo).to_pylist(), sent.value)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(lo, hi - lo), batch.column("label").slice(lo, hi - lo), pa.FixedSizeListArray.from_arrays(pa.array(x.reshape(-1)), x.shape[1]).cast(pa.list_(pa.float32()))], names=["doc_id", "label", "x"])

    rows = chosen.mapInArrow(features, "doc_id long, label int, x array<float>").toArrow().sort_by("doc_id")
    y = rows.column("label").to_numpy()
    x = rows.column("x").combine_chunks().flatten().to_numpy().reshape(len(y), -1)
    return train(x, y.astype(np.float32), vectors)


def classify(documents: DataFrame, network: Network | None, *, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score (how likely the label is 1) and predicted of each document.

    Null text: like empty text, which is scored as well. Without labelled rows every score is 0.5.
    Null and repeated ids are returned as they are; a null id is in the fold of empty text. Whole
    texts are read. An empty table gives no rows. Other columns are ignored.
    """
    sent = documents.sparkSession.sparkContext.broadcast(network)

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = sent.value
        for batch in batches:
            text = batch.column("text")
            for lo, hi in cuts(pc.binary_length(text).to_pylist()):
                part = text.slice(lo, hi - lo).to_pylist()
                score = np.full(hi - lo, 0.5) if net is None else net.probability(pooled(part, net.vectors)).astype(np.float64)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(lo, hi - lo), batch.column("held_out").slice(lo, hi - lo), pa.array(score), pa.array((score >= threshold).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    rows = documents.select(F.col(id_col).cast("long").alias("doc_id"), (F.pmod(crc_of_id(F.col(id_col)), F.lit(FOLDS)) == HELD_OUT).alias("held_out"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(judged, "doc_id long, held_out boolean, score double, predicted int")
