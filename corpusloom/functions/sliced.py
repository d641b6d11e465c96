"""Arrow functions that read a column of texts slice by slice, so that Python objects of a whole batch are never held."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf
from pyspark.sql.pandas.types import to_arrow_type

#: Slices have about so many bytes of text, or one longer text.
SLICE_BYTES = 1 << 20


def slices(texts: pa.Array, size: int = SLICE_BYTES) -> Iterator[pa.Array]:
    """The array in runs of whole texts."""
    start, held = 0, 0
    for k, n in enumerate(pc.binary_length(texts).to_pylist()):
        if k > start and held + (n or 0) > size:
            yield texts.slice(start, k - start)
            start, held = k, 0
        # A null or empty text has some weight too.
        held += (n or 0) + 64
    if start < len(texts):
        yield texts.slice(start)


def each_text(text: Column, read: Callable[[str | None], Any], kind: str) -> Column:
    """read of every text, as a column of the type `kind`."""
    made = to_arrow_type(T.DataType.fromDDL(kind))

    def by_slice(texts: pa.Array) -> pa.Array:
        out = [pa.array([read(t) for t in part.to_pylist()], type=made) for part in slices(texts)]
        pa.default_memory_pool().release_unused()
        return pa.concat_arrays(out) if out else pa.array([], type=made)

    return arrow_udf(by_slice, kind)(text)
