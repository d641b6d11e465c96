"""What is checked of a sealed bundle before it is used: a row a check, in which skipped is not passed."""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping, Sequence
from typing import Any

import numpy as np
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.plans.specs import Manifest
from corpusloom.sources.tables import checksums, damaged

OK, FAIL, SKIPPED = "ok", "fail", "skipped"
MIN_COSINE = 0.999
#: What files of this kind come to when they are loaded and indexed.
EXPANSION = 3.0
#: Of files or fields that are wrong so many are named; all are counted.
NAMED = 5


def manifest_of(spark: SparkSession, path: str) -> Manifest | None:
    """The manifest of a bundle; None where there is none."""
    try:
        row = spark.read.text(f"{path.rstrip('/')}/manifest").first()
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return Manifest(**json.loads(row.value)) if row else None


def _dimension(held: Manifest, target: int | None) -> tuple[str, str]:
    dim = held.recipe.get("dim")
    if target is None:
        return SKIPPED, f"vectors have {dim} numbers; no width to compare with is given"
    return (OK, f"{dim}") if dim == target else (FAIL, f"vectors have {dim} numbers, the target has {target}")


def _recipe(held: Manifest, deployed: Mapping[str, Any] | None) -> tuple[str, str]:
    if deployed is None:
        return SKIPPED, "nothing deployed is given"
    differ = [f"{k}: bundle {held.recipe.get(k)!r}, deployed {deployed[k]!r}" for k in sorted(deployed) if held.recipe.get(k) != deployed[k]]
    return (FAIL, f"{len(differ)} fields: " + "; ".join(differ[:NAMED])) if differ else (OK, f"{len(deployed)} fields")


def _canary(spark: SparkSession, root: str, vector: Sequence[float] | None) -> tuple[str, str]:
    try:
        row = spark.read.json(f"{root}/reference").first()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        row = None
    if row is None or "embedding" not in row:
        return FAIL, "there is no reference row"
    if vector is None:
        return SKIPPED, "no vector of the reference text is given"
    old, new = np.array(row.embedding, dtype=float), np.array(vector, dtype=float)
    if old.shape != new.shape:
        return FAIL, f"{len(new)} numbers against {len(old)}"
    scale = float(np.linalg.norm(old) * np.linalg.norm(new))
    cosine = float(old @ new) / scale if scale else 0.0
    return (OK if cosine >= MIN_COSINE else FAIL), f"cosine {cosine:.6f}"


def _complete(spark: SparkSession, root: str, held: Manifest, equal: Sequence[tuple[str, str]], failed_of: str | None, tolerance: float) -> tuple[str, str]:
    there = {name: spark.read.parquet(f"{root}/{name}").count() for name in held.counts}
    wrong = [f"{n}: {there[n]} rows, {held.counts[n]} by the manifest" for n in sorted(there) if there[n] != held.counts[n]]
    wrong += [f"{a} has {there[a]} rows, {b} has {there[b]}" for a, b in equal if there[a] != there[b]]
    if wrong:
        return FAIL, "; ".join(wrong[:NAMED])
    failed = spark.read.schema("key string, reason string").json(f"{root}/failed").count()
    # What failed is counted in documents, so its share is one of documents.
    total = failed + (there[failed_of] if failed_of else sum(there.values()))
    share = failed / total if total else 0.0
    return (FAIL if share > tolerance else OK), f"{failed} of {total} failed"


def _files(spark: SparkSession, root: str) -> tuple[str, str]:
    wrong = damaged(spark, root).groupBy("problem").agg(F.count("*").alias("n"), F.array_join(F.slice(F.array_sort(F.collect_list("rel")), 1, NAMED), ", ").alias("some")).orderBy("problem").collect()
    if wrong:
        return FAIL, "; ".join(f"{r.n} {r.problem}: {r.some}" for r in wrong)
    return OK, f"{spark.read.parquet(f'{root}/_checksums').count()} files"


def _room(spark: SparkSession, root: str, free: int | None) -> tuple[str, str]:
    need = int((checksums(spark, root).agg(F.sum("bytes")).first()[0] or 0) * EXPANSION)
    if free is None:
        return SKIPPED, f"{need} bytes are needed; what is free is not given"
    return (OK if free >= need else FAIL), f"{need} bytes are needed, {free} are free"


def _provenance(spark: SparkSession, root: str, part: str | None, column: str, allow: bool) -> tuple[str, str]:
    if part is None:
        return SKIPPED, "no part with sources is named"
    total, none = spark.read.parquet(f"{root}/{part}").agg(F.count("*"), F.count_if(F.coalesce(F.trim(column), F.lit("")) == "")).first()
    if not none:
        return OK, f"{total} rows"
    return (SKIPPED if allow else FAIL), f"{none} of {total} rows name no source"


def preflight(spark: SparkSession, path: str, *, target_dim: int | None = None, deployed: Mapping[str, Any] | None = None, vector: Sequence[float] | None = None, free_bytes: int | None = None, equal: Sequence[tuple[str, str]] = (), documents: str | None = None, tolerance: float = 0.0, sourced: str | None = None, source_column: str = "source_url", allow_no_source: bool = False) -> DataFrame:
    """(check, status, detail): manifest, dimension, recipe, canary, completeness, files, room, provenance.

    What is not given to compare with is skipped. Without a manifest that is the one row, and it fails.
    equal names parts that must have as many rows; documents the part that counts documents; sourced
    the part whose rows must name a source, which `allow_no_source` makes a skip, never a pass.
    """
    root = path.rstrip("/")
    held = manifest_of(spark, root)

    def rows() -> Iterator[tuple[str, str, str]]:
        if held is None:
            yield "manifest", FAIL, "not sealed"
            return
        yield "manifest", OK, held.fingerprint()
        yield "dimension", *_dimension(held, target_dim)
        yield "recipe", *_recipe(held, deployed)
        yield "canary", *_canary(spark, root, vector)
        yield "completeness", *_complete(spark, root, held, equal, documents, tolerance)
        yield "files", *_files(spark, root)
        yield "room", *_room(spark, root, free_bytes)
        yield "provenance", *_provenance(spark, root, sourced, source_column, allow_no_source)

    return spark.createDataFrame(list(rows()), "check string, status string, detail string")


def passed(report: DataFrame, *, allow_skipped: bool = False) -> bool:
    return report.where(F.col("status").isin(FAIL, *([] if allow_skipped else [SKIPPED]))).isEmpty()
