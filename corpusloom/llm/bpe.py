"""Byte-pair encoding with a segment tree over the ranks of adjacent pairs, and decoding."""

from __future__ import annotations

import json
import re
import uuid
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import release, rows_of

#: Fixed values of byte-level BPE: how text is cut into words.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Words of up to SHORT bytes kept with their ids in a Python worker; the store is emptied when full.
CACHE_WORDS = 120_000
#: Longer words are merged one by one, shorter ones side by side.
SHORT = 64
_NONE = np.int64(1 << 60)
_SLICE_CHARS = 1 << 19


def _byte_of_char() -> dict[str, int]:
    """Byte-level vocabularies write each byte as one printable character."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


@dataclass
class Vocabulary:
    """Merges as sorted pair keys with rank and result; bytes of each token; special strings."""

    keys: np.ndarray
    ranks: np.ndarray
    merged: np.ndarray
    first: np.ndarray
    token_bytes: list[bytes]
    special: dict[str, int]
    rank_of: dict[tuple[int, int], int] = field(default_factory=dict)
    words: dict[str, bytes] = field(default_factory=dict)

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, chars = spec["model"]["vocab"], _byte_of_char()
        special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        size = max([*vocab.values(), *special.values()]) + 1
        token_bytes = [b""] * size
        for token, i in vocab.items():
            token_bytes[i] = bytes(chars[c] for c in token)
        for token, i in special.items():
            token_bytes[i] = token.encode()
        pairs = [tuple(x.split(" ")) if isinstance(x, str) else tuple(x) for x in spec["model"]["merges"]]
        key = np.array([vocab[a] << 32 | vocab[b] for a, b in pairs], dtype=np.int64)
        merged = np.array([vocab[a + b] for a, b in pairs], dtype=np.int32)
        order = np.argsort(key, kind="stable")
        first = np.zeros(256, dtype=np.int32)
        for c, b in chars.items():
            first[b] = vocab[c]
        return cls(key[order], order.astype(np.int64), merged, first, token_bytes, special)

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair, or -1."""
        key = a.astype(np.int64) << 32 | b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], -1)


def _merge_side_by_side(vocab: Vocabulary, words: list[bytes], width: int) -> list[np.ndarray]:
    """Merge many short words at once: every word has its own tree, one row of `tree`.

    A leaf holds rank * width + position of the pair that begins there, so that the root is the
    lowest rank and, of equal ranks, the leftmost. Each round takes every root and mends the three
    leaves that its merge touches up to the root.
    """
    count = len(words)
    length = np.array([len(w) for w in words])
    ids = np.zeros((count, width), dtype=np.int32)
    there = np.arange(width) < length[:, None]
    ids[there] = vocab.first[np.frombuffer(b"".join(words), dtype=np.uint8)]
    after = np.where(np.arange(1, width + 1) < length[:, None], np.arange(1, width + 1), width)
    before = np.broadcast_to(np.arange(-1, width - 1), (count, width)).copy()
    tree = np.full((count, 2 * width), _NONE)
    row, pos = np.nonzero(after[:, :-1] < width)
    rank = vocab.rank(ids[row, pos], ids[row, pos + 1])
    tree[row, width + pos] = np.where(rank >= 0, rank * width + pos, _NONE)
    step = width
    while step > 1:
        np.minimum(tree[:, step : 2 * step : 2], tree[:, step + 1 : 2 * step : 2], out=tree[:, step // 2 : step])
        step //= 2

    def leaf(at: np.ndarray, left: np.ndarray, right: np.ndarray, real: np.ndarray) -> None:
        """Set the leaf of the pair (left, right); without a right or left part it holds no pair."""
        a, lo, hi = at[real], left[real], right[real]
        found = vocab.rank(ids[a, lo], ids[a, hi])
        tree[a, width + lo] = np.where(found >= 0, found * width + lo, _NONE)

    active = np.arange(count)
    while len(active):
        root = tree[active, 1]
        going = root < _NONE
        active, root = active[going], root[going]
        if not len(active):
            break
        at, rank = root % width, root // width
        gone = after[active, at]
        follow = after[active, gone]
        ids[active, at] = vocab.merged[rank]
        after[active, at] = follow
        more = follow < width
        before[active[more], follow[more]] = at[more]
        tree[active, width + gone] = _NONE
        tree[active, width + at] = _NONE
        leaf(active, at, follow, more)
        prior = before[active, at]
        leaf(active, prior, at, prior >= 0)
        nodes = [width + at, width + gone, width + np.maximum(prior, 0)]
        for _ in range(width.bit_length() - 1):
            nodes = [x >> 1 for x in nodes]
            for x in nodes:
                tree[active, x] = np.minimum(tree[active, 2 * x], tree[active, 2 * x + 1])
        there[active, gone] = False
    flat, ends = ids[there], np.cumsum(there.sum(axis=1))
    return np.split(flat, ends[:-1])


def _merge_one(vocab: Vocabulary, word: bytes) -> np.ndarray:
    """The same for one long word, with a tree in one array of integers: some 30 bytes a byte of the word."""
    if not vocab.rank_of:
        vocab.rank_of.update(zip(((int(k) >> 32, int(k) & 0xFFFFFFFF) for k in vocab.keys), vocab.ranks.tolist(), strict=True))
    n = len(word)
    width = 1 << max(1, (n - 1).bit_length())
    none = int(_NONE)
    ids = array("i", vocab.first[np.frombuffer(word, dtype=np.uint8)].tobytes())
    after, before = array("i", range(1, n + 1)), array("i", range(-1, n - 1))
    rank_of = vocab.rank_of

    def value(i: int) -> int:
        r = rank_of.get((ids[i], ids[after[i]])) if after[i] < n else None
        return none if r is None else r * width + i

    tree = array("q", [none]) * (2 * width)
    for i in range(n):
        tree[width + i] = value(i)
    for x in range(width - 1, 0, -1):
        tree[x] = min(tree[2 * x], tree[2 * x + 1])

    def put(i: int, v: int) -> None:
        x = width + i
        tree[x] = v
        while x > 1:
            x >>= 1
            tree[x] = min(tree[2 * x], tree[2 * x + 1])

    live = bytearray(b"\1") * n
    while tree[1] < none:
        rank, at = divmod(tree[1], width)
        gone = after[at]
        ids[at] = int(vocab.merged[rank])
        after[at] = after[gone]
        if after[gone] < n:
            before[after[gone]] = at
        live[gone] = 0
        put(gone, none)
        put(at, value(at))
        if before[at] >= 0:
            put(before[at], value(before[at]))
    return np.frombuffer(ids, dtype=np.int32)[np.frombuffer(live, dtype=np.uint8) > 0]


def encode_words(vocab: Vocabulary, words: list[str]) -> None:
    """Put the ids (as int32 bytes) of these words into the worker's store."""
    by_width: dict[int, list[str]] = {}
    for w in words:
        n = len(w.encode())
        by_width.setdefault(1 << max(1, (n - 1).bit_length()) if n <= SHORT else 0, []).append(w)
    for width, group in by_width.items():
        for lo in range(0, len(group), 20_000):
            part = group[lo : lo + 20_000]
            raw = [w.encode() for w in part]
            found = _merge_side_by_side(vocab, raw, width) if width else [_merge_one(vocab, w) for w in raw]
            vocab.words.update((w, x.tobytes()) for w, x in zip(part, found, strict=True))


_CUT = regex.compile(PATTERN)
#: The same cut for texts in which the standard library's classes mean the same, at half the cost.
_PLAIN_CUT = re.compile(r" ?[^\W\d_]+|'s|'t|'re|'ve|'m|'ll|'d| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")
_NOT_PLAIN = re.compile(r"[\x1c-\x1f\xb2\xb3\xb9\xbc-\xbe]|[^\x00-\u024f]")


def cut_words(text: str) -> list[str]:
    return (_CUT if _NOT_PLAIN.search(text) else _PLAIN_CUT).findall(text)


def encode_batch(vocab: Vocabulary, texts: list[str]) -> list[bytes]:
    """The ids of each text as int32 bytes. Special strings in a text become their own ids."""
    special = regex.compile("(" + "|".join(map(regex.escape, vocab.special)) + ")") if vocab.special else None
    cut: list[list[str]] = []
    for text in texts:
        parts = special.split(text) if special and any(s in text for s in vocab.special) else [text]
        words: list[str] = []
        for k, part in enumerate(parts):
            words += [part] if k % 2 else cut_words(part)
        cut.append(words)
    if len(vocab.words) > CACHE_WORDS:
        vocab.words.clear()
    for s, i in vocab.special.items():
        vocab.words[s] = np.array([i], dtype=np.int32).tobytes()
    new = {w for words in cut for w in set(words) if w not in vocab.words}
    encode_words(vocab, list(new))
    get = vocab.words.__getitem__
    out = [b"".join(map(get, words)) for words in cut]
    for w in new:
        # Long words are not kept, so that their number bounds the bytes of the store.
        if len(w) > SHORT:
            del vocab.words[w]
    return out


def decode(vocab: Vocabulary, ids: np.ndarray) -> str:
    """The text of the ids, special tokens included; bytes that are not UTF-8 become U+FFFD."""
    return b"".join(map(vocab.token_bytes.__getitem__, ids.tolist())).decode("utf-8", "replace")


def _cuts(sizes: list[int]) -> Iterator[tuple[int, int]]:
    """Row ranges of about _SLICE_CHARS characters."""
    lo = size = 0
    for i, n in enumerate(sizes):
        size += n
        if size >= _SLICE_CHARS:
            yield lo, i + 1
            lo, size = i + 1, 0
    if lo < len(sizes):
        yield lo, len(sizes)


#: The vocabulary a Python worker holds, with its store of words, by the run it belongs to.
_held: dict[str, Vocabulary] = {}


def round_trip(documents: DataFrame, vocabulary_path: str, *, decoded: bool = True, **cols) -> DataFrame:
    """doc_id, ids (array of int) and, if asked for, decoded: the text that the ids give back.

    The vocabulary file is read on the driver and sent to the workers; its size does not depend on
    the data. Null text: no ids and an empty text. Null and repeated ids are returned as they are.
    An empty table gives no rows. Other columns are ignored.
    """
    spark = documents.sparkSession
    sent = spark.sparkContext.broadcast(Vocabulary.load(vocabulary_path))
    schema = "doc_id long, ids array<int>" + ", decoded string" * decoded
    key = uuid.uuid4().hex

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = _held.get(key)
        if vocab is None:
            _held.clear()
            vocab = _held[key] = sent.value
        for batch in batches:
            texts = batch.column("text")
            for lo, hi in _cuts(pc.fill_null(pc.binary_length(texts), 0).to_pylist()):
                part = [x or "" for x in texts.slice(lo, hi - lo).to_pylist()]
                raw = encode_batch(vocab, part)
                ids = [np.frombuffer(x, dtype=np.int32) for x in raw]
                ends = np.zeros(len(ids) + 1, dtype=np.int32)
                np.cumsum([len(x) for x in ids], out=ends[1:])
                flat = np.frombuffer(b"".join(raw), dtype=np.int32)
                out = [batch.column("doc_id").slice(lo, hi - lo), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))]
                if decoded:
                    out.append(pa.array([decode(vocab, x) for x in ids], type=pa.string()))
                yield pa.RecordBatch.from_arrays(out, names=["doc_id", "ids", "decoded"][: len(out)])
            release()

    return rows_of(documents, **cols).mapInArrow(encoded, schema)


def digests(encoded: DataFrame, *, keep_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens and the SHA-256 of the ids (decimal, comma-joined) and of the decoded text."""
    joined = F.array_join(F.col("ids").cast("array<string>"), ",")
    return encoded.select("doc_id", *["ids"] * keep_ids, F.size("ids").cast("long").alias("n_tokens"), F.sha2(joined.cast("binary"), 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
