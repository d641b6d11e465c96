"""Helpers that the operators share: scratch tables, row batches and vectorised word hashing."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Texts are worked on in slices of about so many bytes; arrays over a slice take some hundred times that.
SLICE_BYTES = 1 << 19


def scratch_root(spark: SparkSession) -> str:
    """The shared folder the cluster names; a temporary one only where none is set and all runs on one machine."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="corpusloom-")
        spark.sparkContext.setCheckpointDir(root)
    return root


def materialise(df: DataFrame, name: str = "step") -> DataFrame:
    """Write df as a table in the shared folder and read it back.

    This cuts lineage: an executor that is lost later costs no recomputation of what lies before.
    """
    spark = df.sparkSession
    path = f"{scratch_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Marks of so many bytes at most are sent to every task; more are joined by shuffle.
MARK_BYTES = 32 << 20


def few(marks: DataFrame, *, each: int = 64, extra: str = "0") -> DataFrame:
    """Marks (a table already written) with a broadcast hint if they are small: `each` bytes a row and those that `extra` counts."""
    n, more = marks.agg(F.count("*"), F.coalesce(F.sum(F.expr(extra)), F.lit(0))).first()
    return F.broadcast(marks) if n * each + more <= MARK_BYTES else marks


def rows_of(documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and text under their fixed names, whatever other columns the table has."""
    return documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def crc_of_id(doc_id: Column | str = "doc_id") -> Column:
    """crc32 of the id's decimal text; a null id counts as empty text."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary"))


def bounded_sample(df: DataFrame, key: Column, bound: int) -> DataFrame:
    """About `bound` rows at most, chosen by a hash of the key: all rows where there are fewer.

    The choice depends on the key alone, so that it is the same after a task is run again.
    """
    total = df.count()
    return df if total <= bound else df.where(drawn(key) < int(bound / total * DRAWS))


DRAWS = 1 << 24


def drawn(key: Column) -> Column:
    """A number below DRAWS for each key, evenly spread."""
    return F.pmod(F.xxhash64(F.lit(7), key), F.lit(DRAWS))


def labelled_sample(documents: DataFrame, labels: DataFrame, *, label_col: str, id_col: str, text_col: str, learnable: Column, bound: int) -> DataFrame:
    """doc_id, text and label of about `bound` labelled ids that `learnable` (over _id) admits.

    Of an id's unlike labels the smallest holds, and of its unlike texts the one of the smallest
    hash, so that no more rows than ids are learned from and every run learns from the same.
    """
    marked = labels.select(F.col("doc_id").cast("long").alias("_id"), F.col(label_col).cast("int").alias("label")).where(F.col("label").isNotNull() & F.col("_id").isNotNull() & learnable)
    marked = materialise(bounded_sample(marked.groupBy("_id").agg(F.min("label").alias("label")), F.col("_id"), bound), "labels")
    rows = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    # About `bound` ids at most are sent to the tasks.
    met = rows.join(F.broadcast(marked), F.col("doc_id") == F.col("_id"))
    return met.groupBy("doc_id", "label").agg(F.min_by("text", F.xxhash64("text")).alias("text")).select("doc_id", "text", "label")


# ---- vectorised words ---------------------------------------------------------------------

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_RNG = np.random.default_rng(20240229)
_BYTE_VALUE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[str, np.ndarray] = {}


def _powers_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the odd base and of its inverse, modulo 2**64."""
    have = _powers.get("up")
    if have is None or len(have) < n:
        size = max(n, SLICE_BYTES + 1024)
        for name, base in (("up", _BASE), ("down", _BASE_INVERSE)):
            out = np.full(size, base, dtype=np.uint64)
            out[0] = 1
            _powers[name] = np.multiply.accumulate(out)
    return _powers["up"], _powers["down"]


def mix(x: np.ndarray) -> np.ndarray:
    """A finaliser that spreads 64-bit values evenly."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Block:
    """Rows of text as one byte buffer. offsets: where each row begins, and the end of the last."""

    buf: np.ndarray
    offsets: np.ndarray

    @property
    def rows(self) -> int:
        return len(self.offsets) - 1

    def inside(self) -> np.ndarray:
        return ~_SPACE[self.buf]

    def prefix_hash(self, values: np.ndarray | None = None) -> np.ndarray:
        up, _ = _powers_to(len(self.buf) + 1)
        out = np.zeros(len(self.buf) + 1, dtype=np.uint64)
        np.cumsum((_BYTE_VALUE[self.buf] if values is None else values) * up[: len(self.buf)], out=out[1:])
        return out

    def span_hash(self, prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """A 64-bit hash of each byte span, alike wherever the span lies."""
        _, down = _powers_to(len(self.buf) + 1)
        return mix((prefix[ends] - prefix[starts]) * down[starts])

    def row_of(self, positions: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.offsets[1:], positions, side="right")

    def words(self, inside: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, end and row of each word [^\\x20\\x09-\\x0D]+; words never cross rows."""
        inside = self.inside() if inside is None else inside
        n = len(self.buf)
        first = np.zeros(n + 1, dtype=bool)
        first[self.offsets] = True
        before = np.empty(n, dtype=bool)
        if n:
            before[0] = False
            before[1:] = inside[:-1]
        starts = np.flatnonzero(inside & (~before | first[:n]))
        after = np.empty(n, dtype=bool)
        if n:
            after[-1] = False
            after[:-1] = inside[1:]
        ends = np.flatnonzero(inside & (~after | first[1:])) + 1
        return starts, ends, self.row_of(starts)

    def per_row(self, flags: np.ndarray) -> np.ndarray:
        """How many bytes of each row are flagged."""
        total = np.zeros(len(flags) + 1, dtype=np.int64)
        np.cumsum(flags, out=total[1:])
        return total[self.offsets[1:]] - total[self.offsets[:-1]]


def blocks(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, Block]]:
    """Cut a string column into row ranges of about `limit` bytes (or one longer row); null: empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    n = len(column)
    if not n:
        return
    _, raw, data = column.buffers()
    offsets = np.frombuffer(raw, dtype=np.int64)[column.offset : column.offset + n + 1]
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    lo = 0
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi, Block(whole[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
        lo = hi
    release()


def release() -> None:
    """Give back what a worker no longer uses, as it lives on beside those of later stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)
