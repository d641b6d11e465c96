"""Conversation repair: the cheapest edits that make a conversation's roles follow the grammar (s?(ua)+)?.

A conversation's rows are a path through four grammar states: 0 nothing yet, 1 after a system turn,
2 after a user turn, 3 after an assistant turn; 0 and 3 may end it. A recursive query in DuckDB takes
all conversations of a batch one turn further at a time and keeps, for every state, the least cost
and of equal costs the least audit. Rows stand in one order over the whole table and are cut into
blocks of BLOCK rows, so that a conversation of any length is many bounded pieces: a piece that may
continue one is walked from all four states, and the pieces of a conversation are joined in order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import materialise

#: Rows of a block, a power of two; a piece is a conversation's part of a block.
BLOCK = 512
#: Rows that a task hands to DuckDB at a time.
BATCH_ROWS = 40_000
SPACE = r"\x20\x09-\x0D"
DELETE, REROLE, INSERT, CUT_OFF = 2, 1, 5, 5
#: The state that a role's initial leads to, by the state before.
NEXT = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}
#: The user or assistant turn that each state admits.
ADMITS = {0: "u", 1: "u", 2: "a", 3: "u"}
#: What completes a conversation that stops in a state: cost, audit, turns made.
ENDS = {0: (0, "", ""), 1: (2 * INSERT, "II", "UA"), 2: (INSERT, "I", "A"), 3: (0, "", "")}


def moves() -> list[tuple[int, str, int, int, str, str]]:
    """(state, kind of row, next state, cost, audit, made) of each way to take one row.

    A kind is the role's initial (x: another), in upper case if the row is cut off, or d for a row
    that has to go. made: inserted turns as U or A, then K kept, D deleted, u or a given that role.
    More than two turns inserted at a place never pay.
    """
    out = []
    for state in range(4):
        at, made = state, ""
        for n in range(3):
            for kind in "suaxSUAXd":
                base = INSERT * n + CUT_OFF * kind.isupper()
                out.append((state, kind, at, INSERT * n + DELETE, "I" * n + "D", made + "D"))
                if kind != "d":
                    turn = ADMITS[at]
                    out.append((state, kind, NEXT[turn, at], base + REROLE, "I" * n + "R", made + turn))
                    if (kind.lower(), at) in NEXT:
                        out.append((state, kind, NEXT[kind.lower(), at], base, "I" * n + "K", made + "K"))
            made += ADMITS[at].upper()
            at = NEXT[ADMITS[at], at]
    return out


def damage(conversations: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv_id, turn, role and text of the rows as damaged by crc32(`conv_id:turn`) % 20.

    Nulls of role, text and in the hashed key count as one space. 0: the row goes, 1: its text is
    emptied, 2: it loses its [.!?], 3: it is there twice, 4: its role is user.
    """
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    draw = F.crc32(F.concat_ws(":", space(conv_col), space(turn_col)).cast("binary")) % 20
    rows = conversations.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"), space(role_col).alias("role"), space(text_col).alias("text"), draw.alias("_draw")).where("_draw <> 0")
    text = F.when(F.col("_draw") == 1, "").when(F.col("_draw") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("_draw") == 4, "user").otherwise(F.col("role"))
    times = F.explode(F.array_repeat(F.lit(0), F.when(F.col("_draw") == 3, 2).otherwise(1)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), times.alias("_time")).drop("_time")


def ordered(rows: DataFrame) -> DataFrame:
    """Rows in one order over the whole table: conv (a key without nulls), at, turn, role, text, blank, cut_off, digest.

    at counts the rows of a range partition, so at div BLOCK is a block of neighbours. Rows of one
    turn stand by role, text (its first 64 characters, then its digest), and equal rows side by
    side; a number of the row comes last in the order, so that no run of equal rows is too long for
    a partition to be cut in it.
    """
    keyed = rows.select(F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("conv"), "turn", "role", "text", F.md5("text").alias("digest"))
    keyed = keyed.withColumn("_row", F.monotonically_increasing_id())
    by = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("role"), F.substring("text", 1, 64), F.col("digest"), F.col("_row")]
    placed = keyed.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("at", F.monotonically_increasing_id())
    blank = ~F.col("text").rlike(f"[^{SPACE}]")
    cut_off = ~F.col("text").rlike(rf"[.!?][{SPACE}]*\z")
    return materialise(placed.select("conv", "at", "turn", "role", "text", blank.alias("blank"), cut_off.alias("cut_off"), "digest"), "turns")


def _kinds(placed: DataFrame, size: int) -> DataFrame:
    """conv, block, at, turn, initial and fault (blank, duplicate, truncated or none) of each row."""
    content = ["conv", "role", "digest"]
    again = placed.where("NOT blank").groupBy(*content).agg(F.min("at").alias("_first"), F.count("*").alias("_n")).where("_n > 1").drop("_n")
    slim = placed.select(*content, "at", "turn", "blank", "cut_off").join(again, content, "left")
    fault = F.when(F.col("blank"), "blank").when(F.col("at") > F.col("_first"), "duplicate").when(F.col("cut_off"), "truncated").otherwise("none")
    return slim.select("conv", block_of(F.col("at"), size).alias("block"), "at", "turn", F.substring("role", 1, 1).alias("initial"), fault.alias("fault"))


def block_of(at: Column, size: int) -> Column:
    return F.shiftright(at, size.bit_length() - 1)


def whole_groups(batches: Iterator[pa.RecordBatch], key: list[str], least: int) -> Iterator[pa.Table]:
    """Tables of about `least` rows or more that hold whole groups of sorted rows."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) < least:
            continue
        table = pa.Table.from_batches(held)
        same = np.ones(table.num_rows, dtype=bool)
        for k in key:
            same &= pc.equal(table.column(k), table.column(k)[-1]).to_numpy()
        other = np.flatnonzero(~same)
        cut = int(other[-1]) + 1 if len(other) else 0
        if cut:
            yield table.slice(0, cut)
            held = table.slice(cut).to_batches()
    if held and sum(b.num_rows for b in held):
        yield pa.Table.from_batches(held)


#: One row a piece: what its rows add up to, and the best walk from each start to each state.
_PIECES = """WITH RECURSIVE shapes AS (
 SELECT conv, block, min("at") AS first_at, string_agg(CASE WHEN fault IN ('blank', 'duplicate') THEN 'd' WHEN fault = 'truncated' THEN upper(role) ELSE role END, '' ORDER BY "at") AS shape
 FROM (SELECT *, CASE WHEN initial IN ('s', 'u', 'a') THEN initial ELSE 'x' END AS role FROM turns) GROUP BY ALL),
asked AS (SELECT DISTINCT shape, start FROM shapes, (VALUES (0), (1), (2), (3)) s(start) WHERE start = 0 OR first_at % {block} = 0),
walk AS (
 SELECT shape, start, 0 AS pos, start AS state, 0 AS cost, '' AS audit, '' AS made FROM asked
 UNION ALL
 SELECT shape, start, pos + 1, state, best.cost, best.audit, best.made FROM (
  SELECT w.shape, w.start, w.pos, m.after AS state, min({{'cost': w.cost + m.cost, 'audit': w.audit || m.audit, 'made': w.made || m.made}}) AS best
  FROM walk w JOIN moves m ON m.before = w.state AND m.kind = substring(w.shape, w.pos + 1, 1) GROUP BY ALL)),
done AS (SELECT shape, list({{'start': start, 'state': state, 'cost': cost, 'audit': audit, 'made': made}}) AS walks FROM walk WHERE pos = length(shape) GROUP BY shape),
near AS (SELECT *, lag(initial) OVER (PARTITION BY conv, block ORDER BY "at") AS before FROM turns),
sums AS (SELECT conv, block, min(turn) AS low, max(turn) AS high, count(DISTINCT turn) AS turns, arg_min(turn, "at") AS first_turn, arg_max(turn, "at") AS last_turn, arg_min(initial, "at") AS first_role, arg_max(initial, "at") AS last_role,
 count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate, count(*) FILTER (WHERE fault = 'truncated') AS truncated, count(*) FILTER (WHERE before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal FROM near GROUP BY ALL)
SELECT conv, block, first_at, sums.* EXCLUDE (conv, block), walks FROM shapes JOIN sums USING (conv, block) JOIN done USING (shape)"""

_SUMS = "low long, high long, turns long, first_turn long, last_turn long, first_role string, last_role string, blank long, duplicate long, truncated long, illegal long"
_PIECE = f"conv string, block long, first_at long, {_SUMS}, walks array<struct<start:int,state:int,cost:long,audit:string,made:string>>"
_PIECE_TYPE = pa.schema([("conv", pa.string()), ("block", pa.int64()), ("first_at", pa.int64()), *((x.split()[0], pa.string() if x.endswith("string") else pa.int64()) for x in _SUMS.split(", ")), ("walks", pa.list_(pa.struct([("start", pa.int32()), ("state", pa.int32()), ("cost", pa.int64()), ("audit", pa.string()), ("made", pa.string())])))])


def _walked(size: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    with duckdb.connect(config={"threads": 1, "memory_limit": "512MB"}) as con:
        con.execute('CREATE TABLE moves(before INT, kind VARCHAR, "after" INT, cost BIGINT, audit VARCHAR, made VARCHAR)')
        con.executemany("INSERT INTO moves VALUES (?, ?, ?, ?, ?, ?)", moves())
        for table in whole_groups(batches, ["conv", "block"], BATCH_ROWS):
            con.register("turns", table)
            found = con.sql(_PIECES.format(block=size)).to_arrow_table().cast(_PIECE_TYPE)
            con.unregister("turns")
            yield from found.to_batches()


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Join the pieces of each conversation: which walk of each piece is taken, and the sums with the last.

    Of two walks to different states none is the other's beginning (both end in the edit of one
    row), so that their order is settled for good and a rank stands for the audit so far. What is
    kept of a piece is one byte a state.
    """
    conv, best, back, total = None, {}, [], {}
    out: dict[str, list] = {n: [] for n in _TAKEN_TYPE.names}

    def close() -> None:
        end = min(best, key=lambda s: (best[s][0] + ENDS[s][0], best[s][1]))
        state, taken = end, []
        for block, froms in reversed(back):
            taken.append((block, froms[state], state))
            state = froms[state]
        spread = total["high"] - total["low"] + 1 - total["turns"] if total["high"] is not None else 0
        for k, (block, start, state) in enumerate(reversed(taken)):
            last = k + 1 == len(taken)
            row = {"conv": conv, "block": block, "start": start, "state": state, "last": last, "cost": best[end][0] + ENDS[end][0], "gaps": spread, **{n: total[n] for n in ("blank", "duplicate", "truncated", "illegal")}}
            for n, kept in out.items():
                kept.append(row[n] if last or n in ("conv", "block", "start", "state", "last") else None)

    def sent() -> pa.RecordBatch:
        batch = pa.RecordBatch.from_pydict(out, schema=_TAKEN_TYPE)
        for kept in out.values():
            kept.clear()
        return batch

    for batch in batches:
        for p in batch.to_pylist():
            if p["conv"] != conv:
                if conv is not None:
                    close()
                conv, best, back, total = p["conv"], {0: (0, 0)}, [], p
            else:
                total |= {
                    "low": min((x for x in (total["low"], p["low"]) if x is not None), default=None),
                    "high": max((x for x in (total["high"], p["high"]) if x is not None), default=None),
                    "turns": total["turns"] + p["turns"] - (p["first_turn"] is not None and p["first_turn"] == total["last_turn"]),
                    "illegal": total["illegal"] + p["illegal"] + (total["last_role"] + p["first_role"] not in ("su", "ua", "au")),
                    "last_turn": p["last_turn"], "last_role": p["last_role"],
                } | {n: total[n] + p[n] for n in ("blank", "duplicate", "truncated")}
            ways: dict[int, tuple] = {}
            for w in p["walks"]:
                if w["start"] in best:
                    cost, rank = best[w["start"]]
                    ways[w["state"]] = min(ways.get(w["state"], (float("inf"),)), (cost + w["cost"], rank, w["audit"], w["start"]))
            rank_of = {s: r for r, s in enumerate(sorted(ways, key=lambda s: ways[s][1:3]))}
            best = {s: (way[0], rank_of[s]) for s, way in ways.items()}
            back.append((p["block"], bytes(ways[s][3] if s in ways else 0 for s in range(4))))
        if len(out["conv"]) > BATCH_ROWS:
            yield sent()
    if conv is not None:
        close()
    yield sent()


_TAKEN = "conv string, block long, start int, state int, last boolean, cost long, gaps long, blank long, duplicate long, truncated long, illegal long"
_TAKEN_TYPE = pa.schema([(n, {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_()}[t]) for n, t in (x.split() for x in _TAKEN.split(", "))])


def repairs(placed: DataFrame, *, block: int = BLOCK) -> DataFrame:
    """One row a piece of `ordered` rows: conv, block, first_at, audit, made; with the last piece of a conversation also its cost, gaps and counts of faults."""
    pieces = materialise(_kinds(placed, block).repartition("block").sortWithinPartitions("conv", "block", "at").mapInArrow(partial(_walked, block), _PIECE), "pieces")
    taken = pieces.repartition("conv").sortWithinPartitions("conv", "block").mapInArrow(_joined, _TAKEN)
    met = taken.join(pieces.select("conv", "block", "first_at", "walks"), ["conv", "block"])
    walk = F.filter("walks", lambda w: (w["start"] == F.col("start")) & (w["state"] == F.col("state")))[0]
    end = F.create_map(*[F.lit(x) for s, (_, audit, made) in ENDS.items() for x in (s, f"{audit}:{made}")])[F.col("state")]
    tail = F.split(F.when(F.col("last"), end).otherwise(":"), ":")
    return materialise(met.select("conv", "block", "first_at", F.concat(walk["audit"], tail[0]).alias("audit"), F.concat(walk["made"], tail[1]).alias("made"), "last", "cost", "gaps", "blank", "duplicate", "truncated", "illegal"), "repairs")


def repaired_turns(placed: DataFrame, plan: DataFrame) -> DataFrame:
    """The repaired rows: conv, at, step (their order), role and text."""
    token = F.posexplode(F.regexp_extract_all("made", F.lit("([UA]*[KDua]|[UA]+$)"), 1)).alias("_k", "token")
    tokens = plan.select("conv", "first_at", token).select("conv", (F.col("first_at") + F.col("_k")).alias("at"), "token")
    # Turns inserted after the last row have no row of their own: their place may be another conversation's.
    rows = tokens.join(placed.select("conv", "at", "role", "text"), ["conv", "at"], "left")
    steps = rows.select("conv", "at", "role", "text", F.posexplode(F.split("token", "")).alias("step", "edit")).where("edit NOT IN ('D', '')")
    role = F.when(F.col("edit") == "K", F.col("role")).when(F.lower("edit") == "u", "user").otherwise("assistant")
    return steps.select("conv", "at", "step", role.alias("role"), F.when(F.col("edit").isin("U", "A"), "").otherwise(F.col("text")).alias("text"))


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    conv, sha = None, None
    for batch in batches:
        done = []
        for key, line in zip(batch.column("conv").to_pylist(), batch.column("line").to_pylist(), strict=True):
            if key != conv:
                done += [(conv, sha.hexdigest())] if sha else []
                conv, sha = key, hashlib.sha256(line.encode())
            else:
                sha.update(b"\n" + line.encode())
        yield pa.RecordBatch.from_arrays([pa.array(c, type=pa.string()) for c in ([d[0] for d in done], [d[1] for d in done])], names=["conv", "repaired_sha256"])
    if sha:
        yield pa.RecordBatch.from_arrays([pa.array([conv]), pa.array([sha.hexdigest()])], names=["conv", "repaired_sha256"])


def repair(conversations: DataFrame, *, block: int = BLOCK, **cols) -> DataFrame:
    """Damage, then report on every conversation: conv_id, gaps, faults, illegal pairs, cost, audit, repaired_sha256.

    A null conv_id is a conversation of its own; null turns come first and take no part in gaps;
    null roles and texts are one space. Rows of one turn stand as `ordered` says, so equal rows
    are side by side and the result does not depend on the order of the table. A conversation that
    lost all rows has zeros, an empty audit and the digest of nothing. An empty table gives no rows.
    Other columns are ignored. Long conversations are walked in pieces by many tasks; only the
    digest of the repaired text, which has one order by its nature, is read row by row by one task.
    """
    rows = damage(conversations, **cols)
    placed = ordered(rows)
    plan = repairs(placed, block=block)
    ids = conversations.select(F.col(cols.get("conv_col", "conv_id")).cast("long").alias("conv_id")).groupBy("conv_id").agg(F.lit(1).alias("_")).select("conv_id", F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("conv"))
    whole = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "audit"))), lambda x: x["audit"]), "")
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    report = plan.groupBy("conv").agg(*[F.max(n).alias(n) for n in numbers], whole.alias("audit"))
    lines = repaired_turns(placed, plan).select("conv", "at", "step", F.concat_ws(":", "role", "text").alias("line"))
    digest = lines.repartition("conv").sortWithinPartitions("conv", "at", "step").mapInArrow(_hashed, "conv string, repaired_sha256 string")
    out = ids.join(report, "conv", "left").join(digest, "conv", "left")
    return out.select("conv_id", *[F.coalesce(n, F.lit(0)).cast("long").alias(n) for n in numbers], F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))
