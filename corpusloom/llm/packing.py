"""Best-fit packing by minimum bin slack: documents as token pieces into as few fixed-size sequences as can be.

A bin takes the longest piece that is left, and then the combination of the available lengths that
fills it best, found by subset sums as bits of one integer. Only how often each length occurs
matters for this, so the whole corpus is packed over the counts of at most `capacity` lengths: a
combination is removed as many times as the counts allow, which is what bin after bin would do.
Pieces are then numbered within their length and take the places of that length in their order.
"""

from __future__ import annotations

import json
import os
import re
import uuid
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.common import materialise, release, rows_of

CAPACITY = 2048
#: The id after each document.
CLOSE = 0
#: Words kept with their ids in a Python worker; longer ones are not kept.
STORE_WORDS, SHORT = 400_000, 64
WINDOW_BYTES = 1 << 22
_PLAIN = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+").fullmatch


def fullest(counts: dict[int, int], room: int) -> dict[int, int]:
    """How many of each length fill `room` best, none more often than it is there.

    Bit s of `sums` is set if some choice adds up to s. Lengths are taken from the longest, each in
    steps of 1, 2, 4 ... copies, until the room can be filled to the last place.
    """
    sums, whole, steps = 1, (1 << (room + 1)) - 1, []
    for length in sorted(counts, reverse=True):
        left, step = min(counts[length], room // length), 1
        while left > 0 and not sums >> room & 1:
            step = min(step, left)
            steps.append((length, step, sums))
            sums |= sums << (length * step) & whole
            left, step = left - step, step * 2
    best, chosen = sums.bit_length() - 1, {}
    for length, step, before in reversed(steps):
        if not before >> best & 1:
            best -= length * step
            chosen[length] = chosen.get(length, 0) + step
    return chosen


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first, span, sequence, offset, each): the pieces of a length numbered from first on, span of them.

    `each` of them lie side by side from offset on in every sequence, from sequence on. A removed
    combination at least halves what is left of a length, so the plan's rows are bounded by
    capacity and the logarithm of the counts, whatever the number of pieces.
    """
    left, used, out, sequence = dict(counts), dict.fromkeys(counts, 0), [], 0
    while left:
        longest = max(left)
        rest = left | {longest: left[longest] - 1}
        chosen = fullest({n: c for n, c in rest.items() if c}, capacity - longest)
        chosen[longest] = chosen.get(longest, 0) + 1
        times, offset = min(left[n] // k for n, k in chosen.items()), 0
        for length, each in sorted(chosen.items(), reverse=True):
            out.append((length, used[length], each * times, sequence, offset, each))
            used[length] += each * times
            left[length] -= each * times
            offset += each * length
            if not left[length]:
                del left[length]
        sequence += times
    return out


@dataclass
class Coder:
    """The tokenizer and a store of words with their ids.

    White space separates words for good (the vocabulary drops it, and its normaliser joins nothing
    across it), so a text's ids are those of its words one after the other.
    """

    tokenizer: object
    #: Which ids end a word.
    ends: np.ndarray
    store: dict[str, bytes] = field(default_factory=dict)

    @classmethod
    def load(cls, spec: str) -> Coder:
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        tokenizer = Tokenizer.from_str(spec)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        vocabulary = tokenizer.get_vocab()
        ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        return cls(tokenizer, ends)

    def learn(self, words: list[str]) -> None:
        """Put the ids of these words into the store. Words of letters alone are one word each to the tokenizer, so many go as one text."""
        plain = [w for w in words if _PLAIN(w)]
        for lo in range(0, len(plain), 20_000):
            part = plain[lo : lo + 20_000]
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, dtype=np.uint32)
            raw, stops = ids.tobytes(), ((np.flatnonzero(self.ends[ids]) + 1) * 4).tolist()
            self.store.update((w, raw[a:b]) for w, a, b in zip(part, [0, *stops[:-1]], stops, strict=True))
        others = [w for w in words if not _PLAIN(w)]
        found = self.tokenizer.encode_batch_fast(others, add_special_tokens=False)
        self.store.update((w, array("I", e.ids).tobytes()) for w, e in zip(others, found, strict=True))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, and where those of each text end."""
        split = pc.ascii_split_whitespace(_parted(texts))
        coded = split.flatten().dictionary_encode()
        words = coded.dictionary.to_pylist()
        if len(self.store) > STORE_WORDS:
            self.store.clear()
        new = [w for w in words if w not in self.store]
        self.learn(new)
        raw = [self.store[w] for w in words]
        for w in new:
            if len(w) > SHORT:
                del self.store[w]
        sizes = np.fromiter(map(len, raw), dtype=np.int64, count=len(raw)) // 4
        begins, at = np.cumsum(sizes) - sizes, coded.indices.to_numpy()
        each = sizes[at]
        ends = np.concatenate([[0], np.cumsum(each)])
        places = np.arange(ends[-1]) + np.repeat(begins[at] - ends[:-1], each)
        offsets = np.frombuffer(split.offsets.buffers()[1], dtype=split.offsets.type.to_pandas_dtype())[split.offsets.offset :][: len(split) + 1]
        return np.frombuffer(b"".join(raw), dtype=np.uint32)[places], ends[offsets[1:] - offsets[0]]


_CODES = np.arange(256)
_ALPHA = ((_CODES | 32) >= 97) & ((_CODES | 32) <= 122)
_DIGIT = (_CODES >= 48) & (_CODES <= 57)
_MARK = (_CODES > 32) & (_CODES < 127) & ~_ALPHA & ~_DIGIT


def _parted(texts: pa.Array) -> pa.Array:
    """The texts with blanks where their words end for the tokenizer anyway, in lower case.

    That is after a letter (ASCII or Latin-1) before an ASCII mark, and around a digit: no piece of
    its pattern holds a letter and then a mark, or a digit and something else. Few words remain, so
    that most are in the store. Texts with special strings or combining marks are left as they are.
    """
    texts = texts.cast(pa.large_string())
    n = len(texts)
    _, raw, data = texts.buffers()
    offsets = np.frombuffer(raw, dtype=np.int64)[texts.offset : texts.offset + n + 1]
    if data is None or offsets[-1] == offsets[0]:
        return texts
    buf = np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    held = buf.tobytes()
    if b"<|" in held or b"\xcc" in held or b"\xcd" in held:
        return texts
    letter, digit = _ALPHA[buf], _DIGIT[buf]
    latin = np.zeros(len(buf), dtype=bool)
    latin[1:] = (buf[:-1] == 0xC3) & (buf[1:] != 0x97) & (buf[1:] != 0xB7)
    cut = np.zeros(len(buf), dtype=bool)
    cut[1:] = (letter | latin)[:-1] & _MARK[buf[1:]] | digit[:-1] | digit[1:]
    cut[offsets[:-1][offsets[:-1] < len(buf)]] = False
    places = np.flatnonzero(cut)
    wide = np.insert(np.where((buf >= 65) & (buf <= 90), buf | 32, buf).astype(np.uint8), places, 32)
    moved = offsets + np.searchsorted(places, offsets, side="left")
    return pa.Array.from_buffers(pa.large_string(), n, [None, pa.py_buffer(moved.astype(np.int64)), pa.py_buffer(wide)])


def _windows(text: bytes) -> Iterator[bytes]:
    """A text cut at white space into windows of about WINDOW_BYTES."""
    lo = 0
    while len(text) - lo > WINDOW_BYTES:
        cut = lo + WINDOW_BYTES
        while cut < len(text) and text[cut] not in b" \t\n\v\f\r":
            cut += 1
        yield text[lo:cut]
        lo = cut
    yield text[lo:]


def _runs(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Row ranges of about WINDOW_BYTES, or one longer row."""
    sizes = pc.binary_length(texts).to_pylist()
    lo = total = 0
    for i, n in enumerate(sizes):
        if total and total + n > WINDOW_BYTES:
            yield lo, i
            lo, total = i, 0
        total += n
    if lo < len(sizes):
        yield lo, len(sizes)


def _documents_ids(coder: Coder, texts: pa.Array) -> Iterator[tuple[int, np.ndarray, bool]]:
    """(row, some of its ids in order, whether they are its last)."""
    for lo, hi in _runs(texts):
        if hi - lo == 1 and len(raw := texts[lo].as_py().encode()) > WINDOW_BYTES:
            for window in _windows(raw):
                yield lo, coder.encode(pa.array([window.decode()], type=pa.large_string()))[0], False
            yield lo, np.zeros(0, dtype=np.uint32), True
        else:
            ids, ends = coder.encode(texts.slice(lo, hi - lo))
            for k, (a, b) in enumerate(zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)):
                yield lo + k, ids[a:b], True


#: The tokenizer that a Python worker holds, by the run it belongs to.
_held: dict[str, Coder] = {}
_COLUMNS = {"doc_id": pa.int64(), "piece": pa.int32(), "start": pa.int64(), "length": pa.int64(), "ids_crc32": pa.int64(), "part": pa.int64(), "at": pa.int64()}


def pieces(documents: DataFrame, vocabulary_path: str, *, capacity: int = CAPACITY, close: int = CLOSE, keep_ids: bool = False, **cols) -> DataFrame:
    """doc_id, piece, start, length and ids_crc32 of every piece; at: its number among those of its length in its part.

    A document's tokens are its ids and the closing one; what is longer than capacity is cut. The
    vocabulary file is read on the driver and sent to the workers. Null text: the closing id alone.
    """
    with open(vocabulary_path, encoding="utf-8") as f:
        sent = documents.sparkSession.sparkContext.broadcast(json.dumps(json.load(f)))
    key = uuid.uuid4().hex
    schema = pa.schema([*_COLUMNS.items(), *[("ids", pa.list_(pa.int32()))] * keep_ids])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key not in _held:
            _held.clear()
            _held[key] = Coder.load(sent.value)
        part, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, dtype=np.int64)
        out: dict[str, list] = {n: [] for n in schema.names}

        def add(doc_id: int | None, piece: int, ids: np.ndarray) -> None:
            n = len(ids)
            values = [doc_id, piece, piece * capacity, n, zlib.crc32(ids.astype("<u4").tobytes()), part, seen[n], *[ids.astype(np.int32)] * keep_ids]
            for kept, value in zip(out.values(), values, strict=True):
                kept.append(value)
            seen[n] += 1

        for batch in batches:
            ids_of = batch.column("doc_id").to_pylist()
            texts = pc.fill_null(batch.column("text").cast(pa.large_string()), "")
            held, piece = np.zeros(0, dtype=np.uint32), 0
            for row, ids, last in _documents_ids(_held[key], texts):
                held = np.concatenate([held, ids, np.full(int(last), close, dtype=np.uint32)])
                while len(held) > capacity:
                    add(ids_of[row], piece, held[:capacity])
                    held, piece = held[capacity:], piece + 1
                if last:
                    add(ids_of[row], piece, held)
                    held, piece = held[:0], 0
                if len(out["doc_id"]) >= 4096:
                    yield pa.RecordBatch.from_pydict(out, schema=schema)
                    for kept in out.values():
                        kept.clear()
            release()
        yield pa.RecordBatch.from_pydict(out, schema=schema)

    ddl = "doc_id long, piece int, start long, length long, ids_crc32 long, part long, at long" + ", ids array<int>" * keep_ids
    return rows_of(documents, **cols).mapInArrow(cut, ddl)


def pack(documents: DataFrame, vocabulary_path: str, *, capacity: int = CAPACITY, close: int = CLOSE, keep_ids: bool = False, **cols) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id and offset of every piece (and its ids, if asked for).

    What the driver holds are the counts of at most `capacity` lengths and the plan over them.
    Null text: a piece of the closing id. Null and repeated ids and equal rows are packed like any
    others. An empty table gives no rows. Other columns are ignored.
    """
    cut = materialise(pieces(documents, vocabulary_path, capacity=capacity, close=close, keep_ids=keep_ids, **cols), "pieces")
    parts = materialise(cut.groupBy("length", "part").agg(F.count("*").alias("n")), "lengths")
    counts = {r.length: r.n for r in parts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    schema = "length long, first long, span long, sequence long, offset long, each long"
    places = F.broadcast(cut.sparkSession.createDataFrame(plan(counts, capacity), schema))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    begins = parts.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("begin"))
    numbered = cut.join(begins, ["length", "part"]).withColumn("number", F.col("begin") + F.col("at"))
    place = F.col("number") - F.col("first")
    held = numbered.join(places, "length").where((place >= 0) & (place < F.col("span")))
    sequence = F.col("sequence") + F.floor(place / F.col("each"))
    offset = F.col("offset") + place % F.col("each") * F.col("length")
    return held.select("doc_id", "piece", "start", "length", "ids_crc32", sequence.cast("long").alias("sequence_id"), offset.cast("long").alias("offset"), *["ids"] * keep_ids)


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id and ids of each sequence of what `pack` gives with keep_ids: no more than the capacity each."""
    ordered = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(ordered, lambda x: x["ids"])).alias("ids"))
