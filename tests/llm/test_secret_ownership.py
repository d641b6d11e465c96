"""Which candidates count as owned: planted credentials and copied examples in a corpus of clean prose."""

import random
import string

import pytest

from corpusloom.llm import secrets

OWNERS = 12


def token(rng):
    body = "".join(rng.choice(string.ascii_letters + string.digits) for _ in range(rng.randint(24, 40)))
    return rng.choice(("ghp_", "sk-live-", "xox", "")) + body + "a1b2c3"


def corpus(rng):
    """Rows, and tokens by the kind of holding: (owners, texts) of each."""
    rows, planted, doc = [], {}, 0
    holdings = {"own, one text": (1, 1), "own, many texts": (1, 9), "two owners, two texts": (2, 2), "two owners, three texts": (2, 3), "two owners, four texts": (2, 4), "three owners": (3, 3), "example": (9, 20)}
    for kind, (owners, texts) in holdings.items():
        for _ in range(20):
            t, who = token(rng), rng.sample(range(OWNERS), owners)
            planted[t] = kind
            for n in range(texts):
                rows.append((doc, f"{' '.join(rng.choice(('lamp', 'river', 'stone')) for _ in range(8))} {n} {t} end {doc}.", f"s{who[n % owners]}"))
                doc += 1
    words = ("internationalisation", "2024-11-05T10:20:30", "https://host/a/path", "0x12", "counterrevolutionaries")
    rows += [(doc + k, " ".join(rng.choice(words) for _ in range(30)), f"s{k % OWNERS}") for k in range(100)]
    # An equal row is no further text.
    rows += [r for r in rows[:40]]
    rng.shuffle(rows)
    return rows, planted


def found(df, **settings):
    return {s.value for r in secrets.secret_spans(df, **settings).collect() for s in r.owned}


@pytest.fixture(scope="module")
def planted(spark):
    rows, tokens = corpus(random.Random(21))
    return spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4).cache(), tokens


def test_recall_and_false_positives(planted):
    df, tokens = planted
    got = found(df)
    live = {t for t, kind in tokens.items() if kind in ("own, one text", "own, many texts", "two owners, two texts", "two owners, three texts")}
    # Recall 1 of 80 planted credentials, no one of 60 examples and nothing of the prose taken for one.
    assert got == live and len(live) == 80


def test_either_count_changes_the_verdict(planted):
    df, tokens = planted
    by = lambda got: {tokens[t] for t in got}
    assert by(found(df, max_owners=1)) == {"own, one text", "own, many texts"}
    assert "two owners, four texts" in by(found(df, max_repositories=4)) and "two owners, three texts" not in by(found(df, max_repositories=2))
    assert "three owners" in by(found(df, max_owners=3)) and "example" not in by(found(df, max_owners=3))
