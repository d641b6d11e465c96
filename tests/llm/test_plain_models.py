"""Operators whose results SQL cannot express, against plain versions that go word by word and number by number."""

import math
import random
import re
import struct

import numpy as np
import pytest
import xxhash

from corpusloom.llm import language_id, quality_classifier, sharding, toxicity
from corpusloom.llm.common import mix

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TEXTS = ["Élan vital, 'tis so: so it is.", "", None, "a", "aa aa aa", "x1y2 Z\tÜber-alles\n\nß", " ".join(f"word{k % 7}" for k in range(60)), "日本語 テスト", "!!! ... 12"]


# ---- sharding


def spark_long(value, seed=42):
    return xxhash.xxh64_intdigest(struct.pack("<q", value), seed)


def spark_int(value, seed=42):
    return xxhash.xxh64_intdigest(struct.pack("<i", value), seed)


def signed(x):
    return x - (1 << 64) if x >= 1 << 63 else x


@pytest.mark.parametrize("weights", [(1.0,) * 24, (1.0, 2.0, 0.5)])
def test_shards_by_recomputed_scores(spark, weights):
    ids = [*range(300), -5, 2**62, None]
    df = spark.createDataFrame([(i, f"t{i}") for i in ids], "doc_id long, text string")
    got = {r.doc_id: (r.shard, r.grown_shard) for r in sharding.assign(df, weights).collect()}
    for i in ids:
        # Spark's hash of several values seeds each with the one before; a null leaves the seed as it is.
        h = 42 if i is None else spark_long(i)
        key = signed(spark_int(int(i is None), h))
        score = [-math.log(((spark_long(key, spark_int(k)) >> 12) + 0.5) / 2**52) / w for k, w in enumerate((*weights, 1.0))]
        best = min(range(len(weights)), key=lambda k: (score[k], k))
        assert got[i] == (best, len(weights) if score[-1] < score[best] else best), i


# ---- toxicity


def plain_features(text):
    out, words = set(), WORD.findall(text or "")
    low = [w.strip(toxicity._EDGE).lower() for w in words]
    h = [xxhash.xxh64_intdigest(w) for w in low]
    m = lambda x: int(mix(np.array([x & (2**64 - 1)], dtype=np.uint64))[0])
    for k, w in enumerate(low):
        out.add(m(h[k]))
        out |= {xxhash.xxh64_intdigest(w[:n], n) for n in toxicity.STEMS}
        for gap, salt in ((1, 0x9E3779B97F4A7C15), (2, 0xC2B2AE3D27D4EB4F)):
            if k + gap < len(low):
                out.add(m(h[k] * salt + m(h[k + gap] + gap)))
    return {x >> (64 - toxicity.BITS) for x in out}


def test_features_word_by_word():
    at, row = toxicity.features(TEXTS)
    for k, text in enumerate(TEXTS):
        assert set(at[row == k].tolist()) == plain_features(text)


def test_ftrl_number_by_number():
    rng = random.Random(4)
    size = 1 << toxicity.BITS
    examples = [np.array([*sorted(rng.sample(range(40), 6)), size]) for _ in range(120)]
    labels = np.array([float(3 in e) for e in examples])
    order = np.arange(120)
    z, n = {}, {}

    def weight(i):
        l1, zi = (0.0 if i == size else toxicity.L1), z.get(i, 0.0)
        return 0.0 if abs(zi) <= l1 else -(zi - math.copysign(l1, zi)) / ((toxicity.BETA + math.sqrt(n.get(i, 0.0))) / toxicity.ALPHA + toxicity.L2)

    for _ in range(toxicity.EPOCHS):
        for k in order:
            w = {i: weight(i) for i in examples[k].tolist()}
            p = 1 / (1 + math.exp(-max(-30, min(30, sum(w.values())))))
            g = (p - labels[k]) * (toxicity.POSITIVE_WEIGHT if labels[k] else 1)
            for i, wi in w.items():
                s = (math.sqrt(n.get(i, 0.0) + g * g) - math.sqrt(n.get(i, 0.0))) / toxicity.ALPHA
                z[i] = z.get(i, 0.0) + g - s * wi
                n[i] = n.get(i, 0.0) + g * g
    got, bias = toxicity.ftrl(examples, labels, order)
    assert np.allclose([got[i] for i in range(40)], [weight(i) for i in range(40)], atol=1e-12) and abs(bias - weight(size)) < 1e-12
    assert got[3] > 0 and (got[40:] == 0).all()


# ---- language


def plain_profile(text):
    low, total = (text or "").lower(), np.zeros(language_id.DIMENSION)
    codes = [0]
    for c in low:
        code = ord(c) if c.isalpha() else 0
        if code or codes[-1]:
            codes.append(code)
    if codes[-1]:
        codes.append(0)
    for a, b, c in zip(codes, codes[1:], codes[2:], strict=False):
        if a or b or c:
            total += np.roll(language_id.letter_vector(a), 2) * np.roll(language_id.letter_vector(b), 1) * language_id.letter_vector(c)
    length = np.linalg.norm(total)
    return total / length if length > 1e-9 else total


def test_profiles_letter_by_letter():
    got, has = language_id.profiles(TEXTS)
    assert has.tolist() == [any(c.isalpha() for c in t or "") for t in TEXTS]
    for k, text in enumerate(TEXTS):
        if has[k]:
            assert np.allclose(got[k], plain_profile(text), atol=1e-5), text


# ---- quality


def test_contexts_word_by_word():
    index, want = quality_classifier.index_vectors(), {}
    for text in TEXTS:
        words = [w for w in WORD.findall(text or "")]
        keys = [(xxhash.xxh64_intdigest(w.lower()) % quality_classifier.WORD_ROWS, quality_classifier.WORD_ROWS + xxhash.xxh64_intdigest(quality_classifier.shape_of(w)) % quality_classifier.SHAPE_ROWS) for w in words]
        for k, pair in enumerate(keys):
            near = [index[a] + index[b] for j, (a, b) in enumerate(keys) if j != k and abs(j - k) <= 2]
            for at in pair:
                want[at] = want.get(at, 0) + sum(near, np.zeros(quality_classifier.DIMENSION))
    rows, total = quality_classifier._context(TEXTS)
    assert sorted(want) == rows.tolist() and np.allclose(total, [want[r] for r in rows.tolist()])
