"""Folds over ordered rows that carry a small state, in time linear in the rows and without arrays of a group."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import types as T

Step = Callable[[Any, tuple], tuple[Any, int]]


def carried(rows: DataFrame, key: list[str], order: list[str], values: dict[str, Column], start: Any, step: Step, name: str, *, dealt: bool = False) -> DataFrame:
    """Add the int column `name`: step(state, values of the row) gives the next state and the row's number.

    Rows of a key are read in their order from sorted partitions, batch by batch; only the state is
    held. Null keys are one key. Helper columns carry a prefix and are gone from the result.
    dealt: the rows of a key are in one partition already, as they are right after a window over it.
    """
    taken = {f"_carry_{c}": v for c, v in values.items()}
    wide = rows.withColumns(taken)
    wide = (wide if dealt else wide.repartition(*key)).sortWithinPartitions(*key, *order)
    keep = rows.columns
    schema = T.StructType([*wide.select(*keep).schema.fields, T.StructField(name, T.IntegerType(), False)])
    return wide.mapInArrow(partial(_read, key, list(taken), keep, start, step, name), schema)


def _read(key: list[str], taken: list[str], keep: list[str], start: Any, step: Step, name: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    last, state = None, start
    for batch in batches:
        keys = zip(*(batch.column(c).to_pylist() for c in key), strict=True)
        given = zip(*(batch.column(c).to_pylist() for c in taken), strict=True)
        out = []
        for k, v in zip(keys, given, strict=True):
            if k != last:
                last, state = k, start
            state, n = step(state, v)
            out.append(n)
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(out, type=pa.int32())], names=[*keep, name])


Fold = Callable[[Any, tuple], tuple[Any, tuple]]


def folded(rows: DataFrame, key: list[str], order: list[str], values: dict[str, Column], start: Any, step: Fold, columns: str) -> DataFrame:
    """Like carried, with several columns: step gives the next state and a tuple of the columns (`a int, b string`)."""
    taken = {f"_carry_{c}": v for c, v in values.items()}
    wide = rows.withColumns(taken).repartition(*key).sortWithinPartitions(*key, *order)
    names, keep, types = list(taken), rows.columns, {"int": pa.int32(), "string": pa.string(), "boolean": pa.bool_(), "long": pa.int64()}
    made = [(c.split()[0], types[c.split()[1]]) for c in columns.split(", ")]
    schema = T.StructType([*wide.select(*keep).schema.fields, *T._parse_datatype_string(columns).fields])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, state = None, start
        for batch in batches:
            keys = zip(*(batch.column(c).to_pylist() for c in key), strict=True)
            given = zip(*(batch.column(c).to_pylist() for c in names), strict=True)
            out = []
            for k, v in zip(keys, given, strict=True):
                if k != last:
                    last, state = k, start
                state, new = step(state, v)
                out.append(new)
            more = [pa.array(x, type=t) for (_, t), x in zip(made, zip(*out, strict=True) if out else [[] for _ in made], strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), *more], names=[*keep, *(n for n, _ in made)])

    return wide.mapInArrow(read, schema)
