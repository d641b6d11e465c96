"""Removal of repeated byte strings, found by merging the Burrows-Wheeler transforms of shards.

Every string of LENGTH bytes has a least hash among its GRAM-byte parts. A fragment is a run of
string starts with the same least hash; equal strings lie in fragments of the same hash, so the
hash deals fragments out to tasks. Fragments whose hash no other fragment has cannot repeat.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.bwt import SHARD_BYTES, repeated_intervals
from corpusloom.llm.common import Block, blocks, few, materialise, mix, signed

LENGTH = 100
GRAM = 48
SPAN = LENGTH - GRAM + 1
#: Fragments are merged in groups of about so many bytes, cut where the hash changes. A hash with
#: more bytes than a group is dealt out by the strings themselves.
GROUP_BYTES = 1 << 19
#: What a task has sent is kept in so many slots, and of one hash so many fragments stand for it.
SLOTS = 1 << 18
WITNESSES = 2
DEALS = 64
#: Of crowded hashes a task holds fragments of so many bytes before it merges them.
HELD_BYTES = 1 << 21


def _sliding(x: np.ndarray, width: int, pick) -> np.ndarray:
    """pick (minimum or maximum) of each run of `width` values, by doubling."""
    size = 1
    while size * 2 <= width:
        x = pick(x[: len(x) - size], x[size:])
        size *= 2
    rest = width - size
    return pick(x[: len(x) - rest], x[rest:]) if rest else x


#: Strings are hashed as sums over mixed windows of so many bytes.
WIDTH = 8


def _windows(buf: np.ndarray) -> np.ndarray:
    """A mixed number for the WIDTH bytes from each byte on. Sums of plain bytes would hash some regular strings alike."""
    w = buf.astype(np.uint64)
    for k in (1, 2, 4):
        w = np.concatenate([w[:-k] | w[k:] << np.uint64(8 * k), w[-k:]])
    return mix(w)


def fragments(block: Block) -> dict[str, np.ndarray]:
    """Row, start in the row, starts counted, least hash and content hash of each fragment; and
    whether the least hash occurs in it more than once, so that it can repeat within itself."""
    n = len(block.buf)
    none = {k: np.zeros(0, dtype=np.int64) for k in ("row", "start", "count", "value", "content", "own")}
    if n < LENGTH:
        return none
    prefix = block.prefix_hash(_windows(block.buf))
    at = np.arange(n - GRAM + 1)
    gram = block.span_hash(prefix, at, at + GRAM - WIDTH + 1)
    least = _sliding(gram, SPAN, np.minimum)
    first, last = block.offsets[:-1], block.offsets[1:]
    good = np.zeros(n + 1, dtype=np.int32)
    long = last - first >= LENGTH
    np.add.at(good, first[long], 1)
    np.add.at(good, last[long] - LENGTH + 1, -1)
    good = np.cumsum(good[: len(least)]) > 0
    new = np.ones(len(least), dtype=bool)
    new[1:] = (least[1:] != least[:-1]) | ~good[:-1]
    opens = np.zeros(n, dtype=bool)
    opens[first[first < n]] = True
    start = np.flatnonzero(good & (new | opens[: len(least)]))
    if not len(start):
        return none
    mark = np.zeros(len(least) + 1, dtype=np.int64)
    mark[start] = 1
    ident = np.cumsum(mark[:-1]) - 1
    count = np.bincount(ident[good], minlength=len(start))
    # A gram is chosen if it is the least of some string; two equal chosen ones close by lie in one fragment.
    padded = np.concatenate([np.zeros(SPAN - 1, dtype=np.uint64), np.where(good, least, np.uint64(0)), np.zeros(SPAN - 1, dtype=np.uint64)])
    chosen = np.flatnonzero(_sliding(padded, SPAN, np.maximum) == gram)
    near = (gram[chosen[1:]] == gram[chosen[:-1]]) & (chosen[1:] - chosen[:-1] < SPAN)
    begin = np.clip(chosen[1:][near] - SPAN + 1, 0, len(least) - 1)
    value = gram[chosen[1:][near]]
    # The strings that hold both grams begin between these two places; either end will do.
    own = np.zeros(len(start), dtype=bool)
    for place in (begin, np.minimum(chosen[:-1][near], len(least) - 1)):
        fit = good[place] & (least[place] == value)
        own[ident[place[fit]]] = True
    own |= count > SPAN
    row = block.row_of(start)
    return {"row": row, "start": start - first[row], "count": count, "value": least[start], "content": block.span_hash(prefix, start, start + count + LENGTH - WIDTH), "own": own}


class _Sent:
    """What a task has sent so far, in slots that newer fragments take over: memory does not grow with the task."""

    FIELDS = ("value", "content", "count", "null", "doc_id", "tie", "start")

    def __init__(self):
        self.last = {k: np.zeros(SLOTS, dtype=bool if k == "null" else np.int64) for k in self.FIELDS}
        self.last["count"][:] = -1
        self.of, self.times = np.zeros(SLOTS, dtype=np.int64), np.zeros(SLOTS, dtype=np.int64)

    def sort_out(self, f: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Per fragment, in an order of its own: where it is dealt (-1: an equal one starts earlier, -2: the same place again)."""
        order = np.lexsort([f[k] for k in reversed(self.FIELDS)])
        c = {k: f[k][order] for k in self.FIELDS}
        same = np.zeros(len(order), dtype=bool)
        same[1:] = np.all([c[k][1:] == c[k][:-1] for k in self.FIELDS[:3]], axis=0)
        copy = same.copy()
        copy[1:] &= np.all([c[k][1:] == c[k][:-1] for k in self.FIELDS[3:]], axis=0)
        deal = np.where(copy, -2, np.where(same, -1, 0))
        lead = np.flatnonzero(~same)
        slot = (c["content"][lead] & (SLOTS - 1)).astype(np.int64)
        met = np.all([self.last[k][slot] == c[k][lead] for k in self.FIELDS[:3]], axis=0)
        earlier, equal = np.zeros(len(lead), dtype=bool), met
        for k in self.FIELDS[3:]:
            earlier |= equal & (self.last[k][slot] < c[k][lead])
            equal = equal & (self.last[k][slot] == c[k][lead])
        deal[lead[earlier]], deal[lead[equal]] = -1, -2
        new = ~(earlier | equal)
        lead, slot = lead[new], slot[new]
        for k in self.FIELDS:
            self.last[k][slot] = c[k][lead]
        # A few fragments of a hash show that it recurs; the others are dealt out by their content.
        value = c["value"][lead]
        if len(lead):
            begin = np.concatenate([[True], value[1:] != value[:-1]])
            run = np.cumsum(begin) - 1
            nth = np.arange(len(lead)) - np.flatnonzero(begin)[run]
            place = (value & (SLOTS - 1)).astype(np.int64)
            nth += np.where(self.of[place] == value, self.times[place], 0)
            self.of[place], self.times[place] = value, nth + 1
            deal[lead] = np.where(nth < WITNESSES, 0, 1 + (c["content"][lead] >> 20) % (DEALS - 1))
        return order, deal


_FRAGMENT = "value long, deal int, content long, doc_id long, tie long, start int, count int, own boolean"


def _fragment_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The fragments of a task; of equal ones only the earliest is dealt out by its hash."""
    sent = _Sent()
    for batch in batches:
        for lo, hi, block in blocks(batch.column("text")):
            f = fragments(block)
            f = f | {"value": signed(f["value"]), "content": signed(f["content"])}
            doc, tie = batch.column("doc_id").slice(lo, hi - lo), batch.column("tie").slice(lo, hi - lo).to_numpy(zero_copy_only=False)
            null = doc.is_null().to_numpy(zero_copy_only=False)
            at = f["row"]
            f |= {"null": null[at], "doc_id": doc.fill_null(0).to_numpy(zero_copy_only=False)[at], "tie": tie[at]}
            order, deal = sent.sort_out(f)
            order, deal = order[deal > -2], deal[deal > -2]
            c = {k: v[order] for k, v in f.items() if k != "row"}
            # Those that are settled may lie anywhere: their place deals them out.
            value = np.where(deal < 0, signed(mix(c["doc_id"].view(np.uint64) + c["start"].astype(np.uint64))), c["value"])
            ids = pa.array(c["doc_id"], mask=c["null"], type=pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(value), pa.array(deal.astype(np.int32)), pa.array(c["content"]), ids, pa.array(c["tie"]), pa.array(c["start"].astype(np.int32)), pa.array(c["count"].astype(np.int32)), pa.array(c["own"].astype(bool))],
                names=["value", "deal", "content", "doc_id", "tie", "start", "count", "own"],
            )


_ORDER = ("value", "deal", "content", "count", "isnull(doc_id)", "doc_id", "tie", "start")


def _columns(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
    out = {}
    for name in ("value", "deal", "content", "tie", "start", "count", "own"):
        out[name] = batch.column(name).to_numpy(zero_copy_only=False)
    doc = batch.column("doc_id")
    out["null"] = doc.is_null().to_numpy(zero_copy_only=False)
    out["doc_id"] = doc.fill_null(0).to_numpy(zero_copy_only=False)
    return out


_REPEATED = "value long, doc_id long, tie long, start int, count int, first boolean, own boolean"


def _repeated_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of fragments in _ORDER: those that can repeat, and whether each is the first of its content.

    A row is decided by its neighbours alone, so one row is carried from batch to batch.
    """
    key, equal_by, place_by = ("value", "deal"), ("value", "deal", "content", "count"), ("null", "doc_id", "tie", "start")
    before = held = None

    def alike(c: dict[str, np.ndarray], prior: dict | None, names: tuple[str, ...]) -> np.ndarray:
        """Whether each row agrees with the row before it."""
        first = prior is not None and all(prior[k] == c[k][0] for k in names)
        return np.concatenate([[first], np.all([c[k][1:] == c[k][:-1] for k in names], axis=0)])

    def decided(c: dict[str, np.ndarray], prior: dict | None, more: bool) -> pa.RecordBatch:
        n = len(c["value"]) - more
        left = alike(c, prior, key)
        near = (left | np.append(left[1:], False))[:n]
        again = alike(c, prior, equal_by)
        # Rows that are the same place of equal table rows count once.
        copy = (again & alike(c, prior, place_by))[:n]
        settled = c["deal"][:n] < 0
        keep = np.flatnonzero((near | c["own"][:n].astype(bool) | (c["deal"][:n] != 0)) & ~copy)
        doc = pa.array(c["doc_id"][keep], mask=c["null"][keep], type=pa.int64())
        first = ~(again[:n] | settled)[keep]
        return pa.RecordBatch.from_arrays([pa.array(c["value"][keep]), doc, pa.array(c["tie"][keep]), pa.array(c["start"][keep]), pa.array(c["count"][keep]), pa.array(first), pa.array(c["own"][keep].astype(bool))], names=["value", "doc_id", "tie", "start", "count", "first", "own"])

    for batch in batches:
        if not batch.num_rows:
            continue
        c = _columns(batch)
        if held is not None:
            c = {k: np.concatenate([held[k], v]) for k, v in c.items()}
        if len(c["value"]) > 1:
            yield decided(c, before, True)
            before = {k: v[-2] for k, v in c.items()}
        held = {k: v[-1:] for k, v in c.items()}
    if held is not None:
        yield decided(held, before, False)


def _tie(text: Column, salt: int) -> Column:
    """Tells texts of one id apart: nothing at first, then 64 bits of a salted SHA-256."""
    if not salt:
        return F.lit(0).cast("long")
    return F.conv(F.substring(F.sha2(F.concat(F.lit(f"{salt} "), text).cast("binary"), 256), 1, 15), 16, 10).cast("long")


def _keyed(documents: DataFrame, id_col: str, text_col: str, tie=_tie) -> DataFrame:
    """doc_id, text, and a tie such that rows of one (doc_id, tie) have one text."""
    return _told_apart(documents, id_col, text_col, tie)[0]


def _told_apart(documents: DataFrame, id_col: str, text_col: str, tie=_tie) -> tuple[DataFrame, DataFrame]:
    """The rows with their tie, salts being tried until it holds; and each (doc_id, tie) that several rows have."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = documents.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
    for salt in range(8):
        digest = F.sha2(F.col("text").cast("binary"), 256)
        held = rows.groupBy("doc_id", tie(F.col("text"), salt).alias("tie")).agg(F.min(digest).alias("a"), F.max(digest).alias("b"), F.count("*").alias("n"))
        held = materialise(held.where("a <> b OR n > 1"), "held")
        if held.where("a <> b").isEmpty():
            return rows.withColumn("tie", tie(F.col("text"), salt)), held.select("doc_id", "tie")
    raise RuntimeError("texts of one id could not be told apart")


def _without_equal(texts: DataFrame, several: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One row of each (doc_id, tie), and the results of the others, which are copies, made where they lie.

    So no task gets all of many equal rows.
    """
    same = F.col("t.doc_id").eqNullSafe(F.col("s.doc_id")) & F.col("t.tie").eqNullSafe(F.col("s.tie"))
    kept = few(several)
    # Written once, so that a row keeps its number.
    equal = materialise(texts.alias("t").join(kept.alias("s"), same, "left_semi").withColumn("_row", F.monotonically_increasing_id()), "equal")
    first = few(materialise(equal.groupBy("doc_id", "tie").agg(F.min("_row").alias("_row")).select("_row"), "first"))
    ones = texts.alias("t").join(kept.alias("s"), same, "left_anti").unionByName(equal.join(first, "_row", "left_semi").drop("_row"))
    copies = equal.join(first, "_row", "left_anti")
    size = F.octet_length("text").cast("long")
    long = size >= LENGTH
    gone = copies.select("doc_id", size.alias("n_bytes"), F.when(long, size).otherwise(0).alias("n_removed"), long.cast("long").alias("n_spans"), F.when(long, F.lit("")).otherwise(F.col("text")).cast("binary").alias("kept"))
    return ones, gone


def _by_document(texts: DataFrame, marks: DataFrame, fields: list[str]) -> DataFrame:
    """Each document's marks, then its text, in one task: a union that is dealt out by document."""
    kinds = {f.name: f.dataType for f in marks.schema.fields}
    left = marks.select("doc_id", "tie", F.lit(0).alias("kind"), *fields, F.lit(None).cast("string").alias("text"))
    right = texts.select("doc_id", "tie", F.lit(1).alias("kind"), *[F.lit(None).cast(kinds[f]).alias(f) for f in fields], "text")
    return left.unionByName(right).repartition("doc_id", "tie").sortWithinPartitions("doc_id", "tie", "kind", *fields)


def _cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of each marked fragment; of crowded hashes, what is left of them after a merge in this task."""
    key, marks, held, size = None, [], [], 0
    for batch in batches:
        out: list[tuple] = []
        cols = [batch.column(c).to_pylist() for c in ("doc_id", "tie", "kind", "value", "start", "count", "crowded")]
        texts = batch.column("text")
        for i, (doc, tie, kind, value, start, count, crowded) in enumerate(zip(*cols, strict=True)):
            if (doc, tie) != key:
                key, marks = (doc, tie), []
            if kind == 0:
                marks.append((value, start, count, crowded))
            elif marks:
                raw = texts[i].as_py().encode()
                for value, start, count, crowded in marks:
                    part = raw[start : start + count - 1 + LENGTH]
                    if not crowded:
                        out.append((value, -1, doc, tie, start, None, part))
                        continue
                    # A long fragment is held in pieces, so that what is held stays bounded.
                    for lo in range(0, count, HELD_BYTES):
                        held.append((value, doc, tie, start + lo, part[lo : lo + HELD_BYTES + LENGTH - 1]))
                        size += len(held[-1][4])
                        if size >= HELD_BYTES:
                            yield from _settled(held)
                            held, size = [], 0
                marks = []
        yield _record(out, _CUT_NAMES, _CUT_TYPES)
    if held:
        yield from _settled(held)


def _settled(held: list[tuple]) -> Iterator[pa.RecordBatch]:
    """Of fragments (value, doc_id, tie, start, raw): the spans that start earlier among them, and one row for each other string.

    Spans have no bytes and may be dealt to any task. However many fragments hold a string, one row of it goes on.
    """
    rows = [h[1:] for h in held]
    docs, cover, first = _repeats(rows)
    out = [(hash((doc, tie)), -1, doc, tie, begin, end, None) for doc, tie, begin, end in _runs(docs, cover)]
    seen: set[int] = set()
    sizes = np.array([len(r[3]) - LENGTH + 1 for r in rows], dtype=np.int64)
    begin, end = np.searchsorted(cover, first), np.searchsorted(cover, first + sizes)
    for i, (value, doc, tie, start, raw) in enumerate(held):
        key = int(first[i])
        free = np.ones(sizes[i], dtype=bool)
        free[cover[begin[i] : end[i]] - key] = False
        for k in np.flatnonzero(free).tolist():
            if key + k in seen:
                continue
            seen.add(key + k)
            part = raw[k : k + LENGTH]
            out.append((value, int.from_bytes(hashlib.blake2b(part, digest_size=3).digest(), "big"), doc, tie, start + k, None, part))
            if len(out) >= 20_000:
                yield _record(out, _CUT_NAMES, _CUT_TYPES)
                out = []
    yield _record(out, _CUT_NAMES, _CUT_TYPES)


def _sifted(rows: list[tuple]) -> list[tuple]:
    """The runs of strings whose hash recurs among these rows: no other string can be equal to one of them."""
    raw = [r[3] for r in rows]
    offsets = np.cumsum([0, *map(len, raw)])
    block = Block(np.frombuffer(b"".join(raw), dtype=np.uint8), offsets)
    if len(block.buf) < LENGTH:
        return []
    at = np.arange(len(block.buf) - LENGTH + 1)
    row = block.row_of(at)
    at = at[at + LENGTH <= offsets[row + 1]]
    hashes = block.span_hash(block.prefix_hash(), at, at + LENGTH)
    order = np.argsort(hashes)
    same = hashes[order[1:]] == hashes[order[:-1]]
    again = np.zeros(len(at), dtype=bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    at = at[again]
    if not len(at):
        return []
    row = block.row_of(at)
    new = np.ones(len(at) + 1, dtype=bool)
    new[1:-1] = (np.diff(at) != 1) | (row[1:] != row[:-1])
    edge = np.flatnonzero(new)
    out = []
    for a, b in zip(edge[:-1], edge[1:], strict=True):
        doc, tie, start, text = rows[row[a]]
        lo = int(at[a] - offsets[row[a]])
        out.append((doc, tie, start + lo, text[lo : lo + int(b - a) - 1 + LENGTH]))
    return out


def _repeats(rows: list[tuple]) -> tuple[list[tuple], np.ndarray, np.ndarray]:
    """The documents in order; the places of strings that also start earlier; each row's first place.

    rows: doc_id, tie, start and bytes of distinct fragments. The shards of what can recur in them
    are transformed and merged; in each repeated interval the earliest suffix stays.
    """
    docs = sorted({(r[0] is None, r[0] or 0, r[1]) for r in rows})
    rank_of = {d: i for i, d in enumerate(docs)}

    def places(some: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
        rank = np.array([rank_of[(r[0] is None, r[0] or 0, r[1])] for r in some], dtype=np.int64)
        return rank, np.array([r[2] for r in some], dtype=np.int64)

    rank, starts = places(rows)
    whole = rank << 32 | starts
    rows = _sifted(rows)
    if not rows:
        return docs, np.zeros(0, dtype=np.int64), whole
    rank, starts = places(rows)
    shards, part, size = [], [], 0
    for r in rows:
        part.append(r[3])
        size += len(r[3]) + 1
        if size >= SHARD_BYTES:
            shards.append(part)
            part, size = [], 0
    shards += [part] if part else []
    coded = []
    for s in shards:
        # Bytes of UTF-8 stay below 0xff, so that one more than each fits and 0 ends a string.
        coded.append(np.frombuffer(b"".join(x + b"\xff" for x in s), dtype=np.uint8) + np.uint8(1))
    suffix, interval = repeated_intervals(coded, LENGTH)
    begins = np.cumsum([0, *[len(r[3]) + 1 for r in rows[:-1]]])
    owner = np.searchsorted(begins, suffix, side="right") - 1
    key = rank[owner] << 32 | starts[owner] + suffix - begins[owner]
    order = np.lexsort((key, interval))
    key, interval = key[order], interval[order]
    new = np.ones(len(order), dtype=bool)
    new[1:] = interval[1:] != interval[:-1]
    # One place may come twice, from equal rows of the table: it is not later than itself.
    least = key[np.flatnonzero(new)][np.cumsum(new) - 1]
    return docs, np.unique(key[key != least]), whole


def _runs(docs: list[tuple], cover: np.ndarray) -> list[tuple]:
    """(doc_id, tie, begin, end) of the bytes that covered starts take up, neighbours as one."""
    if not len(cover):
        return []
    cut = np.flatnonzero(np.diff(cover) != 1) + 1
    out = []
    for a, b in zip(np.append(0, cut), np.append(cut, len(cover)), strict=True):
        null, doc, tie = docs[int(cover[a] >> 32)]
        out.append((None if null else doc, tie, int(cover[a] & 0xFFFFFFFF), int(cover[b - 1] & 0xFFFFFFFF) + LENGTH))
    return out


def _covered(rows: list[tuple]) -> tuple[list[tuple], list[tuple]]:
    """The covered spans of these rows, and the rows that begin with no covered start."""
    docs, cover, places = _repeats(rows)
    return _runs(docs, cover), [rows[i] for i in np.flatnonzero(~np.isin(places, cover))]


_CUT = "value long, part int, doc_id long, tie long, start int, end int, raw binary"
_CUT_TYPES = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
_CUT_NAMES = ["value", "part", "doc_id", "tie", "start", "end", "raw"]
_SPAN_NAMES = ["doc_id", "tie", "begin", "end"]


def _record(rows: list[tuple], names: list[str], types: tuple) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(list(c), type=t) for c, t in zip(columns, types, strict=True)], names=names)


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[tuple], list[tuple]]]:
    """Covered spans, and rows (value, part, doc_id, tie, start, raw) that stay, of groups of whole keys.

    A group ends where (value, part) changes. Within a crowded hash, whose rows are one string
    each, a full group is merged at once and the earliest row of each string alone goes on.
    """
    group: list[tuple] = []
    keys: list[tuple] = []
    size, limit, key = 0, GROUP_BYTES, None

    def kept(rows: list[tuple]) -> list[tuple]:
        # Rows of one place may lie in a group under one key only, so a place tells its key.
        held = {(r[0], r[1], r[2]) for r in rows}
        return [(*k, *r) for k, r in zip(keys, group, strict=True) if (r[0], r[1], r[2]) in held]

    for batch in batches:
        cols = [batch.column(c).to_pylist() for c in ("value", "part", "doc_id", "tie", "start", "raw")]
        for value, part, doc, tie, start, raw in zip(*cols, strict=True):
            if size >= limit and ((value, part) != key or part >= 0):
                cover, rows = _covered(group)
                if (value, part) != key:
                    yield cover, kept(rows)
                    group, keys, size, limit = [], [], 0, GROUP_BYTES
                else:
                    stay = kept(rows)
                    yield cover, [r for r in stay if r[:2] != key]
                    stay = [r for r in stay if r[:2] == key]
                    keys, group = [r[:2] for r in stay], [r[2:] for r in stay]
                    size = sum(len(r[3]) for r in group)
                    # If most strings differ, the next merge waits until the group has doubled.
                    limit = max(GROUP_BYTES, 2 * size)
            key = (value, part)
            keys.append(key)
            group.append((doc, tie, start, raw))
            size += len(raw)
        yield [], []  # lets the caller pass on what it has set aside of the batch
    if group:
        cover, rows = _covered(group)
        yield cover, kept(rows)


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Groups of whole hashes, each merged apart; batches come sorted by hash. Rows without bytes are covered spans already."""

    def open_ones() -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = batch.column("raw").is_null()
            through.append(batch.filter(done).select(["doc_id", "tie", "start", "end"]).rename_columns(_SPAN_NAMES))
            yield batch.filter(pc.invert(done))

    through: list[pa.RecordBatch] = []
    for cover, _ in _groups(open_ones()):
        yield from through
        through.clear()
        if cover:
            yield _record(cover, _SPAN_NAMES, (pa.int64(), pa.int64(), pa.int32(), pa.int32()))
    yield from through


def _kept_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each document's text without its covered spans. Of equal rows all but one go whole."""
    key, marks, seen = None, [], False
    for batch in batches:
        out: list[tuple] = []
        cols = [batch.column(c).to_pylist() for c in ("doc_id", "tie", "kind", "begin", "end")]
        texts = batch.column("text")
        for i, (doc, tie, kind, begin, end) in enumerate(zip(*cols, strict=True)):
            if (doc, tie) != key:
                key, marks, seen = (doc, tie), [], False
            if kind == 0:
                if marks and begin <= marks[-1][1]:
                    marks[-1][1] = max(marks[-1][1], end)
                else:
                    marks.append([begin, end])
                continue
            raw = texts[i].as_py().encode()
            spans = [[0, len(raw)]] if seen and len(raw) >= LENGTH else marks
            seen = True
            kept, at = [], 0
            for a, b in spans:
                kept.append(raw[at:a])
                at = b
            kept.append(raw[at:])
            left = b"".join(kept)
            out.append((doc, len(raw), len(raw) - len(left), len(spans), left))
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
        columns = zip(*out, strict=True) if out else [[]] * 5
        yield pa.RecordBatch.from_arrays([pa.array(list(c), type=t) for c, t in zip(columns, kinds, strict=True)], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])


def remove_repeats(documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", group_bytes: int = GROUP_BYTES) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept (bytes) of each document.

    A byte is removed if a string of LENGTH bytes that covers it also starts earlier: in a smaller
    id, or before in the same document. Null text: no bytes. Null ids come after all others. Rows
    of equal id are ordered by a digest of their text; of rows equal in both, all but one are copies
    and go whole if they have LENGTH bytes. Texts shorter than LENGTH stay. An empty table gives
    no rows. Other columns are ignored.

    Whole fragments are taken as equal if two 64-bit hashes and their lengths agree; all other
    strings are compared by the merged transforms.
    """
    texts, several = _told_apart(documents, id_col, text_col)
    copies = None
    if not several.isEmpty():
        texts, copies = _without_equal(texts, several)
    found = texts.select("doc_id", "tie", "text").mapInArrow(_fragment_rows, _FRAGMENT)
    ordered = found.repartition("value", "deal").sortWithinPartitions(*[F.expr(x) for x in _ORDER])
    repeated = materialise(ordered.mapInArrow(_repeated_rows, _REPEATED), "fragments")
    first = repeated.where("first")
    # A hash that one content alone has gives its copies nothing to be merged with.
    # As a table of its own it leaves the join below free to split a hash that many fragments have.
    size = F.sum(F.col("count") + LENGTH - 1).alias("size")
    varied = materialise(first.groupBy("value").agg(F.count("*").alias("contents"), F.bool_or("own").alias("own"), size).where("contents > 1 or own"), "varied")
    marks = first.drop("own").join(varied.select("value", (F.col("size") > group_bytes).alias("crowded")), "value")
    cut = _by_document(texts, marks, ["value", "start", "count", "crowded"]).mapInArrow(_cut_out, _CUT)
    # A crowded hash is merged first where its documents lie, then its earliest strings of all tasks.
    covered = cut.repartition("value", "part").sortWithinPartitions("value", "part").mapInArrow(_merged, "doc_id long, tie long, begin int, end int")
    again = repeated.where("not first").select("doc_id", "tie", F.col("start").alias("begin"), (F.col("start") + F.col("count") - 1 + LENGTH).cast("int").alias("end"))
    spans = materialise(covered.unionByName(again), "covered")
    out = _by_document(texts, spans, ["begin", "end"]).mapInArrow(_kept_bytes, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
    return out if copies is None else out.unionByName(copies)


def digests(removed: DataFrame) -> DataFrame:
    return removed.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
