"""SimHash near-duplicates: fingerprints, pigeonhole blocks, verified links and their components."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import few, materialise, rows_of
from corpusloom.llm.components import connected_components

SEED = 42
SHINGLE = 3
DISTANCE = 3
#: Six blocks: two fingerprints within three bits agree on at least three blocks.
BLOCK_BITS = (11, 11, 11, 11, 10, 10)
#: More fingerprints than this in a bucket are split again by a quarter of the bits that are left.
BUCKET = 4096
SPLITS = 3

_FOLD = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def fingerprint(text: str | None) -> int:
    """A bit is 1 if it is set in over half the hashes of the text's shingles."""
    words = (text or "").encode().translate(_FOLD).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends[:-1]]
    spans = zip(starts, ends[SHINGLE - 1 :], strict=False) if len(words) >= SHINGLE else [(0, len(joined) + 1)]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a : b - 1], SEED) for a, b in spans], dtype=">u8").view(np.uint8).reshape(-1, 8)
    ones = np.zeros(64, dtype=np.int64)
    for lo in range(0, len(hashes), 1 << 14):
        ones += np.unpackbits(hashes[lo : lo + (1 << 14)], axis=1).sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = np.array([fingerprint(x.as_py()) for x in batch.column("text")], dtype=np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_hash"), pa.array(prints)], names=["doc_id", "text_hash", "print"])


def fingerprints(documents: DataFrame, **cols) -> DataFrame:
    """doc_id, text_hash and print (the 64 bits as a signed long) of each row."""
    return rows_of(documents, **cols).withColumn("text_hash", F.xxhash64("text")).mapInArrow(_fingerprints, "doc_id long, text_hash long, print long")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def first_masks() -> list[int]:
    """Each choice of three of the six blocks, as a mask."""
    blocks, at = [], 0
    for bits in BLOCK_BITS:
        blocks.append(((1 << bits) - 1) << at)
        at += bits
    half = len(BLOCK_BITS) - DISTANCE
    return [sum(x) for x in combinations(blocks, half)]


def finer_masks(mask: int) -> list[int]:
    """The mask with each quarter of the free bits added: a pair within three bits agrees on one quarter."""
    free = [i for i in range(64) if not mask >> i & 1]
    parts = DISTANCE + 1
    return [mask | sum(1 << i for i in free[k::parts]) for k in range(parts)]


def _keyed(prints: DataFrame, masks: list[int]) -> DataFrame:
    keys = F.array(*[F.struct(F.lit(i).alias("mask_id"), F.col("print").bitwiseAND(F.lit(_signed(m))).alias("key")) for i, m in enumerate(masks)])
    return prints.select("print", F.explode(keys).alias("k")).select("k.mask_id", "k.key", "print")


def links_of_bucket(values: np.ndarray) -> list[tuple[int, int]]:
    """Links that join all fingerprints of a bucket that reach each other: fewer links than members."""
    out, left = [], values
    while len(left) > 1:
        frontier, left = [left[0]], left[1:]
        while frontier and len(left):
            x = frontier.pop()
            near = np.bitwise_count(left ^ x) <= DISTANCE
            if near.any():
                found = left[near]
                out += [(x, y) for y in found]
                frontier += list(found)
                left = left[~near]
    return out


def _bucket_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches come sorted by mask and key; a bucket that goes on in the next batch waits for it."""
    rest = None
    for batch in batches:
        part = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("mask_id", "key", "print")]
        if rest is not None:
            part = [np.concatenate(x) for x in zip(rest, part, strict=True)]
        cuts = np.flatnonzero((part[0][1:] != part[0][:-1]) | (part[1][1:] != part[1][:-1])) + 1
        last = cuts[-1] if len(cuts) else 0
        rest = [x[last:] for x in part]
        yield _links([x[:last] for x in part])
    if rest is not None:
        yield _links(rest)


def _links(part: list[np.ndarray]) -> pa.RecordBatch:
    mask, key, prints = part
    prints = prints.view(np.uint64)
    pairs: list[tuple[int, int]] = []
    if len(prints):
        cuts = np.flatnonzero((mask[1:] != mask[:-1]) | (key[1:] != key[:-1])) + 1
        starts, ends = np.append(0, cuts), np.append(cuts, len(prints))
        size = ends - starts
        two = starts[size == 2]
        two = two[np.bitwise_count(prints[two] ^ prints[two + 1]) <= DISTANCE]
        pairs = list(zip(prints[two], prints[two + 1], strict=True))
        for k in np.flatnonzero(size > 2):
            pairs += links_of_bucket(prints[starts[k] : ends[k]])
    both = np.array(pairs, dtype=np.uint64).reshape(-1, 2).view(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], names=["a", "b"])


def print_links(prints: DataFrame, *, bucket: int = BUCKET) -> DataFrame:
    """Links (a, b) between distinct fingerprints, enough that linked ones lie in one component.

    A bucket is all fingerprints that agree under a mask. Buckets above `bucket` members are split
    again under finer masks, which loses no pair within DISTANCE bits; after the last split a
    bucket has at most 2**14 members, as only 14 bits are free.
    """
    masks, found = first_masks(), []
    for level in range(SPLITS + 1):
        keyed = _keyed(prints, masks)
        if level < SPLITS:
            large = materialise(keyed.groupBy("mask_id", "key").count().where(F.col("count") > bucket).select("mask_id", "key"), "buckets")
            crowded = not large.isEmpty()
            small = keyed.join(large, ["mask_id", "key"], "left_anti") if crowded else keyed
        else:
            small, crowded = keyed, False
        ordered = small.repartition("mask_id", "key").sortWithinPartitions("mask_id", "key")
        found.append(ordered.mapInArrow(_bucket_links, "a long, b long"))
        if not crowded:
            break
        # Only the members of large buckets are keyed again.
        finer = [m for mask in masks for m in finer_masks(mask)]
        of = keyed.join(large, ["mask_id", "key"], "left_semi").select("print").distinct()
        prints, masks = materialise(of, "crowded"), list(dict.fromkeys(finer))
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return materialise(out.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")


def hex_of(print_col: Column | str) -> Column:
    c = F.col(print_col) if isinstance(print_col, str) else print_col
    return F.lower(F.lpad(F.hex(c), 16, "0"))


def near_duplicates(documents: DataFrame, **cols) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id: the smallest id that links lead to.

    Fingerprints link at three or fewer differing bits; documents of one fingerprint are linked.
    Null, empty and word-free texts have fingerprint zero and link like any other. Rows with equal
    ids are all returned. A component whose ids are all null has a null component_id; null ids are
    otherwise ignored in the minimum. An empty table gives no rows. Other columns are ignored.
    """
    marked = materialise(fingerprints(documents, **cols), "prints")
    grouped = _components(marked)
    smallest = grouped.groupBy("component").agg(F.min("first_id").alias("component_id"))
    of_print = grouped.select("print", "component").join(smallest, "component").select("print", "component_id")
    return marked.join(of_print, "print").select("doc_id", hex_of("print").alias("fingerprint"), "component_id")


def _components(marked: DataFrame) -> DataFrame:
    """print, first_id (its smallest id) and component of each distinct fingerprint."""
    distinct = materialise(marked.groupBy("print").agg(F.min("doc_id").alias("first_id")), "distinct")
    component = connected_components(print_links(distinct.select("print"))).withColumnRenamed("node", "print")
    return distinct.join(component, "print", "left").withColumn("component", F.coalesce("component", "print"))


def one_of_each_group(documents: DataFrame) -> DataFrame:
    """One row of each component: the smallest id (null last), then the smallest hash of the text.

    Texts are told apart within an id, so rows of one id with unlike texts are judged apart. Equal
    rows count as one, of which one stays. Null and empty texts are one group. Other columns stay
    as they are, whatever their names. An empty table gives no rows.
    """
    marked = materialise(fingerprints(documents), "prints")
    place = F.struct(F.col("doc_id").isNull().alias("null"), "doc_id", F.coalesce("text_hash", F.lit(0)).alias("hash"))
    rows = marked.join(_components(marked).select("print", "component"), "print").select("component", place.alias("place"))
    first = rows.groupBy("component").agg(F.min("place").alias("place"))
    key = [F.coalesce("place.doc_id", F.lit(0)).alias("m_id"), F.col("place.null").alias("m_null"), F.col("place.hash").alias("m_hash")]
    gone = materialise(rows.select("place").distinct().join(first.select("place"), "place", "left_anti").select(*key), "gone")
    again = materialise(rows.groupBy("place").count().where("count > 1").select(*key), "again")
    carried = documents.select(F.struct("*").alias("row"), F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("m_id"), F.col("doc_id").isNull().alias("m_null"), F.coalesce(F.xxhash64("text"), F.lit(0)).alias("m_hash"))
    names = ["m_id", "m_null", "m_hash"]
    kept = carried.join(few(gone), names, "left_anti")
    repeated = few(again)
    # Only rows that repeat are brought together to keep one of them.
    single = kept.join(repeated, names, "left_anti").select("row")
    one = kept.join(repeated, names, "left_semi").groupBy(*names).agg(F.first("row").alias("row")).select("row")
    return single.unionByName(one).select("row.*")
