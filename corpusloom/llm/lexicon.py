"""A worker's store of words: each distinct word is described once, and texts become arrays of ids."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

LIMIT = 100_000


class Lexicon(dict):
    """Word (bytes) to id; `rows` holds what `describe` says of each. It is emptied when full."""

    def __init__(self, describe: Callable[[bytes], tuple], kind: np.dtype):
        super().__init__()
        self._describe = describe
        self.rows = np.zeros(1 << 12, dtype=kind)

    def __missing__(self, word: bytes) -> int:
        i = len(self)
        if i == len(self.rows):
            self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
        self.rows[i] = self._describe(word)
        self[word] = i
        return i

    def words_of(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, list[list[bytes]]]:
        """What is said of each word, the text it is in, and the words; white space is ASCII's."""
        if len(self) > LIMIT:
            self.clear()
        words = [(t or "").encode().split() for t in texts]
        count = np.array([len(w) for w in words], dtype=np.int64)
        ids = np.fromiter((i for w in words for i in map(self.__getitem__, w)), dtype=np.int64, count=int(count.sum()))
        return self.rows[ids], np.repeat(np.arange(len(texts)), count), words


def cuts(sizes: list[int], limit: int = 1 << 19) -> list[tuple[int, int]]:
    """Row ranges of about `limit` bytes."""
    out, lo, size = [], 0, 0
    for i, n in enumerate(sizes):
        size += n or 0
        if size >= limit:
            out.append((lo, i + 1))
            lo, size = i + 1, 0
    return out + [(lo, len(sizes))] * (lo < len(sizes))
