"""Texts of many megabytes: the same results in windows, in a worker of bounded memory."""

import random
import subprocess
import sys
from pathlib import Path

import numpy as np
import pytest
from tokenizers import Tokenizer

from corpusloom.llm import bpe, registry, toxicity

ROOT = str(Path(__file__).resolve().parents[2])


def words(n, seed=3):
    rng = random.Random(seed)
    return "".join(rng.choice(("lamp", "Über", "no.", "x1", "river,", "\u2003é")) + rng.choice((" ", "\n", "  ", "\t")) for _ in range(n))


@pytest.mark.parametrize("text", [words(3000), words(3000) + "z" * 5000, "y" * 9000 + " end", " " * 4000 + "a b"])
def test_windows_find_the_same_features(text):
    dense = np.random.default_rng(1).normal(size=1 << toxicity.BITS)
    whole = toxicity.logits([text, "short one", None], dense, 0.5, window=1 << 30)
    for window in (64, 700, 4096):
        assert np.allclose(toxicity.logits([text, "short one", None], dense, 0.5, window=window), whole)


def test_one_long_run_is_merged_as_the_library_does():
    rng = random.Random(8)
    text = "".join(rng.choice("abcdeé") for _ in range(30_000))
    vocab = bpe.Vocabulary.load(registry.vocabulary_path())
    want = Tokenizer.from_file(registry.vocabulary_path()).encode(text, add_special_tokens=False).ids
    assert np.frombuffer(bpe.encode_batch(vocab, [text])[0], dtype=np.int32).tolist() == want


@pytest.mark.parametrize(
    "code,mb",
    [
        ("from corpusloom.llm import toxicity; import numpy as np; t = 'lamp river, stone no. Über ' * 4_000_000; toxicity.logits([t], np.ones(1 << 20), 0.0)", 1300),
        ("from corpusloom.llm import bpe, registry; v = bpe.Vocabulary.load(registry.vocabulary_path()); bpe.encode_batch(v, ['abcd' * 500_000])", 700),
    ],
)
def test_memory_is_bounded(code, mb):
    """100 MB of words, and a run of letters of 2 MB, in a process of its own."""
    said = subprocess.run([sys.executable, "-c", f"import resource, sys; sys.path.insert(0, {ROOT!r})\n{code}\nprint(resource.getrusage(resource.RUSAGE_SELF).ru_maxrss // 1024)"], capture_output=True, text=True, timeout=600)
    assert said.returncode == 0, said.stderr[-800:]
    assert int(said.stdout.split()[-1]) < mb


def test_many_equal_rows_are_dealt_out(spark):
    from corpusloom.llm import sharding, suffix_dedup

    long = " ".join(f"w{k}" for k in range(60))
    rows = [(7, long)] * 400 + [(8, "short")] * 5 + [(None, long)] * 3 + [(None, None)] * 4 + [(9, long + " more"), (7, "other of seven")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    got = sorted((tuple(r)[:4] for r in suffix_dedup.remove_repeats(df).collect()), key=str)
    n = len(long)
    want = [(7, n, 0, 0)] + [(7, n, n, 1)] * 399 + [(7, 14, 0, 0)] + [(8, 5, 0, 0)] * 5 + [(None, n, n, 1)] * 3 + [(None, 0, 0, 0)] * 4 + [(9, n + 5, n, 1)]
    assert got == sorted(want, key=str)
    slots = {}
    for r in sharding.assign(df).collect():
        slots.setdefault(r.shard, []).append(r.slot)
    assert sum(map(len, slots.values())) == len(rows) and all(sorted(s) == list(range(len(s))) for s in slots.values())
