"""Packing against the tokenizers library and, where tables are small, against the best packing there is."""

import functools
import itertools
import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from corpusloom.llm import packing, registry

PATH = registry.vocabulary_path("word_bpe_49k.json")


def plain_pieces(rows, capacity):
    tok, out = Tokenizer.from_file(PATH), []
    for doc, text, *_ in rows:
        ids = [*tok.encode(text or "", add_special_tokens=False).ids, 0]
        for k in range(0, len(ids), capacity):
            part = ids[k : k + capacity]
            out.append((doc, k // capacity, k, len(part), zlib.crc32(np.array(part, dtype="<u4").tobytes())))
    return sorted(out, key=str)


def check_placed(got, capacity):
    placed = {}
    for r in got:
        placed.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for runs in placed.values():
        at = 0
        for offset, length in sorted(runs):
            assert offset == at
            at += length
        assert at <= capacity
    return len(placed)


@pytest.mark.parametrize("capacity", [2048, 40])
def test_pieces_and_places(spark, docs, rows, capacity):
    odd = [(700, "<|endoftext|> a<|startoftext|>b", None, None), (701, "é ́ x y z ΣΑΣ İ", None, None), (702, "x" * 5000 + "\x1c\x85 42's", None, None)]
    df = docs.select("doc_id", "text").unionByName(spark.createDataFrame([r[:2] for r in odd], "doc_id long, text string")).selectExpr("*", "1 AS length", "2 AS part", "3 AS at", "4 AS first", "5 AS number").repartition(3)
    got = packing.pack(df, PATH, capacity=capacity).collect()
    assert sorted((tuple(r)[:5] for r in got), key=str) == plain_pieces([*rows, *odd], capacity)
    used, tokens = check_placed(got, capacity), sum(r.length for r in got)
    assert used <= -(-tokens // capacity) + 1


def test_long_text_is_read_in_windows(spark, monkeypatch):
    rng = random.Random(2)
    text = " ".join("".join(rng.choice("abcdéß.") for _ in range(rng.randint(1, 9))) for _ in range(1_000_000))
    rows = [(1, text), (2, "short"), (3, "\n" * 4_500_000 + "end"), (4, "yz " * 1_500_000 + "y" * 200_000)]
    got = packing.pack(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), PATH).collect()
    assert sorted((tuple(r)[:5] for r in got), key=str) == plain_pieces(rows, 2048)


def best_possible(lengths, capacity):
    @functools.cache
    def fewest(left):
        if not left:
            return 0
        first, rest, best = left[0], left[1:], len(left)
        for k in range(len(rest) + 1):
            for chosen in itertools.combinations(range(len(rest)), k):
                if first + sum(rest[i] for i in chosen) <= capacity:
                    best = min(best, 1 + fewest(tuple(x for i, x in enumerate(rest) if i not in chosen)))
        return best

    return fewest(tuple(sorted(lengths, reverse=True)))


def test_fullest_is_the_best_sum():
    rng = random.Random(5)
    for _ in range(200):
        counts = {n: rng.randint(1, 4) for n in rng.sample(range(1, 30), 4)}
        room = rng.randint(0, 60)
        chosen = packing.fullest(counts, room)
        sums = {sum(n * k for n, k in zip(counts, ks, strict=True)) for ks in itertools.product(*(range(c + 1) for c in counts.values()))}
        assert all(k <= counts[n] for n, k in chosen.items())
        assert sum(n * k for n, k in chosen.items()) == max(s for s in sums if s <= room)


def test_plan_is_near_the_best():
    rng = random.Random(7)
    for _ in range(40):
        lengths = [rng.randint(1, 20) for _ in range(8)]
        counts = {n: lengths.count(n) for n in set(lengths)}
        rows = packing.plan(counts, 20)
        assert sorted((n, f + i) for n, f, span, *_ in rows for i in range(span)) == sorted((n, i) for n, c in counts.items() for i in range(c))
        assert len({s + i // each for _, _, span, s, _, each in rows for i in range(span)}) <= best_possible(lengths, 20) + 1


def test_plan_of_many_pieces_stays_small():
    rng = random.Random(3)
    counts = {n: rng.randint(1, 10**9) for n in range(1, 301)}
    rows = packing.plan(counts, 300)
    total = sum(n * c for n, c in counts.items())
    assert len(rows) < 300 * 64 and max(s + span // each for _, _, span, s, _, each in rows) <= -(-total // 300) * 1.01 + 1


def test_sequences_hold_the_ids(spark):
    rows = [(i, "one two three " * (i % 7), None) for i in range(60)]
    packed = packing.pack(spark.createDataFrame(rows, "doc_id long, text string, s string"), PATH, capacity=32, keep_ids=True)
    made = {r.sequence_id: list(r.ids) for r in packing.sequences(packed).collect()}
    assert all(len(x) <= 32 for x in made.values())
    assert all(made[r.sequence_id][r.offset : r.offset + r.length] == list(r.ids) for r in packed.collect())


def test_empty_table(spark):
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0
