"""Spelling variants against a plain comparison of all pairs of words."""

import collections
import random
import re
import zlib

import pytest

from corpusloom.llm import variants


def plain(rows, often):
    count = collections.Counter()
    for doc, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            count[run if h % 97 else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    n = {w: c for w, c in count.items() if len(w) >= 5 and c >= often}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) == 1
        short, long = sorted((a, b), key=len)
        return len(long) - len(short) == 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))

    nears = {a: [b for b in n if near(a, b)] for a in n}
    form = {a: min(bs, key=lambda b: (-n[b], b)) for a, bs in nears.items() if bs and max(n[b] for b in bs) >= 2 * n[a]}

    def root(w):
        return root(form[w]) if w in form else w

    return sorted((w, form.get(w), root(w), n[w], len(nears[w]), n[form[w]] if w in form else None) for w in n)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(6)
    base = ["lettre", "letter", "letters", "lattre", "aaaaa", "aaaaaa", "aaaaaaa", "élève", "eleve", "élèves", "stone", "stones", "stony", "notes", "onset", "tones", "×××××", "Straße", "strasse"]
    words = base + ["".join(rng.choice("abc") for _ in range(rng.randint(4, 7))) for _ in range(250)]
    weight = [rng.choice((1, 1, 2, 5, 20, 60)) for _ in words]
    rows = [(i, " ".join(w.upper() if rng.random() < 0.1 else w for w in rng.choices(words, weight, k=rng.randint(0, 120))), "x") for i in range(150)]
    return [*rows, (None, "lettre letter", "x"), (None, "lettre letter", "x"), (3, None, "x"), (4, "", "x"), (5, "zu" * 40_000 + " " + "zu" * 40_000 + "! " + "zu" * 40_000, "x")]


@pytest.mark.parametrize("crowded", [64, 2])
def test_same_as_all_pairs(spark, texts, crowded):
    df = spark.createDataFrame(texts, "doc_id long, text string, word string").selectExpr("*", "1 AS n", "'k' AS key", "2 AS form", "3 AS run").repartition(4)
    assert sorted(tuple(r) for r in variants.group_variants(df, crowded=crowded).collect()) == plain(texts, 3)


def test_far_roots(spark):
    rows = [(i, ("worda " * 3 + "wordab " * 6 + "wordabc " * 12 + "wordabcd " * 24 + "wordabcde " * 48) * 2, "x") for i in range(1)]
    assert {r.root for r in variants.group_variants(spark.createDataFrame(rows, "doc_id long, text string, s string")).collect()} == {"wordabcde"}


def test_empty_table(spark):
    assert variants.group_variants(spark.createDataFrame([], "doc_id long, text string")).count() == 0
