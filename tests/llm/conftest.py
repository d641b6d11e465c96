import random

import pytest
from pyspark.sql import functions as F

WORDS = "the of and to in that was with from only lamp river stone cloud seven über façade niño".split()


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + (rng.choice([".", ",", ""]) if rng.random() < 0.2 else "") for _ in range(n))


@pytest.fixture(scope="session")
def rows():
    """Documents with nulls, empties, copies, near copies, a long one, ties and equal rows."""
    rng = random.Random(8)
    base = [prose(rng, rng.randint(1, 120)) for _ in range(40)]
    shared = "\n" + prose(rng, 30) + "\n"
    out = [(i, t if i % 3 else t + shared, "en" if i % 2 else "de", f"s{i % 3}") for i, t in enumerate(base)]
    out += [(100 + i, base[i % 5], "en", "s0") for i in range(10)]
    out += [(200 + i, base[7] + " " + WORDS[i], "en", "s1") for i in range(8)]
    out += [(300, None, None, None), (301, "", "en", "s0"), (302, " \n\t ", "en", "s0"), (303, prose(rng, 30_000), "en", "s2"), (304, "é" * 90, "fr", "s1"), (304, "é" * 90, "fr", "s1")]
    return [*out, (None, base[3], "en", "s0"), (None, base[3], "en", "s0"), (305, "a\nb\na\n\n \na", "en", None)]


CLASH = ("host", "line", "hash", "row_id", "print", "component", "component_id", "kept", "kind", "value", "tie", "shard", "slot", "spans", "owner", "secret", "ids", "score", "label", "held_out", "id", "_id", "_hash")


@pytest.fixture(scope="session")
def docs(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumn("n_chars", F.length("text").cast("long"))
    return df.withColumns({c: F.lit(c) for c in CLASH}).repartition(3)


@pytest.fixture(scope="session")
def empty(docs):
    return docs.limit(0)
