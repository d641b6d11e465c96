"""Burrows-Wheeler transforms of shards, merged by refining their interleave."""

from __future__ import annotations

import numpy as np

SHARD_BYTES = 1 << 16


def _shard_order(text: np.ndarray, depth: int = 128) -> np.ndarray:
    """The order of all suffixes of one shard by their first `depth` symbols or more.

    Seven symbols of nine bits are sorted as one number; then the length doubles, and only
    suffixes that still share their rank are sorted again, by the rank of what follows.
    """
    n = len(text)
    padded = np.concatenate([text, np.zeros(8, dtype=text.dtype)]).astype(np.int64)
    key = np.zeros(n, dtype=np.int64)
    for k in range(7):
        key = key << 9 | padded[k : k + n]
    order = np.argsort(key)
    rank = np.zeros(n + 1, dtype=np.int64)
    slots, width = np.arange(n), 7
    key = key[order]
    while len(slots):
        new = np.ones(len(slots) + 1, dtype=bool)
        new[1:-1] = key[1:] != key[:-1]
        head = np.maximum.accumulate(np.where(new[:-1], slots, 0))
        rank[order[slots]] = head + 1
        tied = ~(new[:-1] & new[1:])
        slots = slots[tied]
        if width >= depth or not len(slots):
            break
        held = order[slots]
        key = rank[held] * (n + 2) + rank[np.minimum(held + width, n)]
        sort = np.argsort(key)
        order[slots] = held[sort]
        key = key[sort]
        width *= 2
    return order


def shard_transform(text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of one shard: its transform, its last-to-first mapping, and the position of each suffix."""
    order = _shard_order(text)
    last = text[order - 1]
    place = np.empty(len(order), dtype=np.int64)
    place[order] = np.arange(len(order))
    return last, place[order - 1], order


def repeated_intervals(shards: list[np.ndarray], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes whose first `depth` symbols recur, and the interval that each lies in.

    The merged order begins as shard after shard. Each round maps it through the transforms: a
    stable sort by the transform's symbol puts the preceding suffixes in the order of one symbol
    more. Where two neighbours come from different intervals or symbols, their common prefix ends
    in this round. A suffix alone in its interval, and one that reaches its string's end, is left
    out from then on: its predecessors cannot recur either. What is left after `depth` rounds are
    the intervals of common prefix `depth`. Positions count through the shards as one text.
    """
    last, first, suffix, at = [], [], [], 0
    for text in shards:
        b, lf, order = shard_transform(text)
        last.append(b)
        first.append(lf + at)
        suffix.append(order + at)
        at += len(text)
    if not at:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    last = np.concatenate(last)
    first, suffix = (np.concatenate(x).astype(np.int32) for x in (first, suffix))
    merged = np.arange(at, dtype=np.int32)
    interval = np.zeros(at, dtype=np.int32)
    for _ in range(depth):
        symbol = last[merged]
        # Suffixes at a string's end sort first and are cut off.
        order = np.argsort(symbol, kind="stable")[np.count_nonzero(symbol == 0) :]
        interval, symbol = interval[order], symbol[order]
        n = len(order)
        new = np.ones(n + 1, dtype=bool)
        new[1:n] = (interval[1:] != interval[:-1]) | (symbol[1:] != symbol[:-1])
        keep = np.flatnonzero(~(new[:-1] & new[1:]))
        interval = np.cumsum(new[:-1], dtype=np.int32)[keep]
        merged = first[merged[order[keep]]]
        if not len(merged):
            break
    return suffix[merged], interval
