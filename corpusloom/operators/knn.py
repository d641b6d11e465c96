"""Nearest neighbours by brute force: blocks of queries meet blocks of rows, each pair one product."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

QUERY_BLOCK, ROW_BLOCK = 256, 2048


def _parted(rows: pa.ListScalar, prefix: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors of length one of a block of rows, without a Python object for each number."""
    held = rows.values
    m = held.field(f"{prefix}vec").flatten().to_numpy(zero_copy_only=False).reshape(len(held), -1).astype(np.float64)
    return held.field(f"{prefix}id").to_numpy(), m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-12)


def _blocks(rows: DataFrame, size: int, prefix: str) -> DataFrame:
    """Rows in groups of about `size`, dealt out by a hash of the id."""
    count = max(1, -(-rows.count() // size))
    block = F.pmod(F.xxhash64(f"{prefix}id"), F.lit(count))
    return rows.groupBy(block.alias(f"{prefix}block")).agg(F.collect_list(F.struct(f"{prefix}id", f"{prefix}vec")).alias(f"{prefix}rows"))


def top_k(rows: DataFrame, queries: DataFrame, k: int, *, id_col: str, vec_col: str, without_self: bool = True) -> DataFrame:
    """(qid, id, rank, score): the k rows of highest cosine for each query; ties by id."""
    left = _blocks(queries.select(F.col(id_col).alias("q_id"), F.col(vec_col).alias("q_vec")), QUERY_BLOCK, "q_")
    right = _blocks(rows.select(F.col(id_col).alias("r_id"), F.col(vec_col).alias("r_vec")), ROW_BLOCK, "r_")

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for asked, held in zip(batch.column("q_rows"), batch.column("r_rows"), strict=True):
                (qid, left), (ids, right) = _parted(asked, "q_"), _parted(held, "r_")
                score = np.round(left @ right.T, 6)
                if without_self:
                    score[qid[:, None] == ids[None, :]] = -np.inf
                order = np.lexsort((np.broadcast_to(ids, score.shape), -score), axis=1)[:, :k]
                at = np.repeat(np.arange(len(qid)), order.shape[1])
                value = score[at, order.reshape(-1)]
                keep = value > -np.inf
                yield pa.RecordBatch.from_arrays([pa.array(qid[at][keep]), pa.array(ids[order.reshape(-1)][keep]), pa.array(value[keep])], names=["qid", "id", "score"])

    pairs = right.crossJoin(F.broadcast(left)) if queries.count() <= QUERY_BLOCK else right.crossJoin(left)
    found = pairs.select("q_rows", "r_rows").mapInArrow(best, "qid long, id long, score double")
    order = Window.partitionBy("qid").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= k)
