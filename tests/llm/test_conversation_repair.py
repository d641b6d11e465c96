"""Conversation repair against a plain reading of the rules, over odd rows and conversations of many pieces."""

import functools
import hashlib
import random
import re
import zlib

import pytest

from corpusloom.llm import conversation_repair as cr

SHAPE = "conv_id long, turn long, role string, text string"


def plain(rows):
    """Report of each conversation, row by row and by trying every edit."""
    ids = {r[0] for r in rows}
    kept = {i: [] for i in ids}
    for conv, turn, role, text in rows:
        draw = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = (" " if x is None else x for x in (role, text))
        if draw:
            text = "" if draw == 1 else re.sub("[.!?]", "", text) if draw == 2 else text
            kept[conv] += [(turn, "user" if draw == 4 else role, text)] * (1 + (draw == 3))
    return sorted(((i, *report(kept[i])) for i in ids), key=str)


def report(rows):
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    turns = {r[0] for r in rows} - {None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    faults, seen = [], set()
    for _, role, text in rows:
        last = re.findall(r"[^\x20\x09-\x0D]", text)[-1:]
        faults.append("blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last[0] not in ".!?" else "")
        seen.add((role, text))
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))

    def follows(so_far, initial):
        """so_far: what the roles are so far, as the grammar sees it: '', s, u or a."""
        return {"s": so_far == "", "u": so_far in ("", "s", "a"), "a": so_far == "u"}.get(initial, False)

    @functools.cache
    def best(i, so_far, inserted):
        ways = []
        if i == len(rows) and so_far in ("", "a"):
            ways.append((0, "", ()))
        if inserted < 3:
            for role in ("user", "assistant"):
                if follows(so_far, role[0]) and (after := best(i, role[0], inserted + 1)):
                    ways.append((5 + after[0], "I" + after[1], (role + ":", *after[2])))
        if i < len(rows):
            _, role, text = rows[i]
            extra = 5 * (faults[i] == "truncated")
            if after := best(i + 1, so_far, 0):
                ways.append((2 + after[0], "D" + after[1], after[2]))
            if faults[i] not in ("blank", "duplicate"):
                for cost, letter, name in ((0, "K", role), (1, "R", "user"), (1, "R", "assistant")):
                    if follows(so_far, name[:1]) and (after := best(i + 1, name[:1], 0)):
                        ways.append((cost + extra + after[0], letter + after[1], (f"{name}:{text}", *after[2])))
        return min(ways, default=None)

    cost, audit, lines = best(0, "", 0)
    return gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()


def talk(rng, conv, n):
    roles = ["system", "user", "assistant", "tool", "", None, "user", "assistant", "user", "assistant"]
    texts = ["Yes.", "No!", "cut off", " \n", "", None, "Why? ", "é end. ", "a\nb."]
    return [(conv, t if rng.random() < 0.95 else None, ("user", "assistant")[t % 2] if rng.random() < 0.6 else rng.choice(roles), rng.choice(texts) if rng.random() < 0.5 else f"{rng.random()}.") for t in range(n)]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    out = [r for c in range(400) for r in talk(rng, c, rng.randint(1, 9))]
    out += [(500, 3, "user", "The same.")] * 7 + [(501, None, None, None)] * 3 + [(None, 1, "user", "Hello."), (None, 2, "assistant", "Yes.")]
    gone = next(k for k in range(10**6) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    return [*out, (gone, 0, "user", "It goes.")]


def test_same_as_plain_reading(spark, rows):
    df = spark.createDataFrame(rows, SHAPE).selectExpr("*", "'x' AS conv", "1 AS at", "2 AS block", "3 AS audit", "role AS kind").repartition(5)
    assert sorted((tuple(r) for r in cr.repair(df).collect()), key=str) == plain(rows)


def test_long_conversations_are_joined_from_pieces(spark):
    rng = random.Random(9)
    rows = [r for c, n in ((1, 150), (2, 90), (3, 2), (4, 61)) for r in talk(rng, c, n)]
    got = cr.repair(spark.createDataFrame(rows, SHAPE).repartition(3), block=8)
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain(rows)


def test_repaired_turns_follow_the_grammar(spark, rows):
    placed = cr.ordered(cr.damage(spark.createDataFrame(rows, SHAPE)))
    said = {}
    for r in sorted(cr.repaired_turns(placed, cr.repairs(placed)).collect(), key=lambda r: (r.conv, r["at"], r.step)):
        said[r.conv] = said.get(r.conv, "") + r.role[0]
    assert said and all(re.fullmatch("s?(ua)+", x) for x in said.values())


def test_empty_table(spark):
    assert cr.repair(spark.createDataFrame([], SHAPE)).count() == 0
