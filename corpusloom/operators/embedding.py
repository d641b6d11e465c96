"""Embedding without a model: rendered texts, hashed vectors, and batches by size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.operators.carry import carried


def render_query(text: Column, instruction: str, style: str) -> Column:
    """none: the text; prefix: instruction before it; chat: turns with the instruction as system."""
    if style == "none" or (style == "prefix" and not instruction):
        return text
    if style == "prefix":
        return F.concat(F.lit(f"Instruct: {instruction}\nQuery: "), text)
    said = instruction if instruction.endswith((".", "!", "?")) else instruction + "."
    return F.concat(F.lit(f"<system>{said}</system><user>"), text, F.lit("</user>"))


def hash_vector(text: Column, dimension: int) -> Column:
    """A unit vector from the SHA-256 of text and counter: each byte b gives (b - 127.5) / 127.5."""
    digests = F.concat_ws("", *[F.sha2(F.concat(text, F.lit(f"#{k}")), 256) for k in range(-(-dimension // 32))])
    raw = F.transform(F.sequence(F.lit(0), F.lit(dimension - 1)), lambda i: (F.conv(F.substring(digests, i * 2 + 1, F.lit(2)), 16, 10).cast("double") - 127.5) / 127.5)
    norm = F.sqrt(F.aggregate(raw, F.lit(0.0), lambda s, x: s + x * x))
    return F.transform(raw, lambda x: x / norm)


def hash_items(text: Column, image_digest: Column, dimension: int) -> Column:
    """A unit vector of a text and of the digest of the picture beside it; either may be null, not both."""
    return hash_vector(F.concat_ws("\n", text, image_digest), dimension)


def batches(rows: DataFrame, key: str, order: str, size: str, *, max_items: int, max_padded: int) -> DataFrame:
    """(key, order, batch): longest first, a batch holds max_items and max_padded (items by the longest) at most.

    Rows are batched within each key, which is a window of bounded size.
    """

    def step(state: tuple[int, int, int], row: tuple) -> tuple[tuple[int, int, int], int]:
        (held, top, batch), (more,) = state, row
        if held and (held == max_items or (held + 1) * max(top, more) > max_padded):
            return (1, more, batch + 1), batch + 1
        return (held + 1, max(top, more), batch), batch

    sized = rows.withColumn("_first", -F.col(size))
    return carried(sized, [key], ["_first", order], {"size": F.col(size).cast("long")}, (0, 0, 0), step, "batch").select(key, order, "batch")


def payloads(rows: DataFrame, key: str, order: str, text: str, *, max_bytes: int, max_items: int, max_square: int = 0) -> DataFrame:
    """(key, order, batch): rows in their order, bounded by bytes, items and, unless 0, items times the longest squared.

    A text beyond a bound goes alone, whole. A null text has no bytes.
    """

    def step(state: tuple[int, int, int, int], row: tuple) -> tuple[tuple[int, int, int, int], int]:
        (held, used, top, batch), (more,) = state, row
        square = max_square > 0 and (held + 1) * max(top, more) ** 2 > max_square
        if held and (held == max_items or used + more > max_bytes or square):
            return (1, more, more, batch + 1), batch + 1
        return (held + 1, used + more, max(top, more), batch), batch

    sized = rows.select(key, order, F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("_bytes"))
    return carried(sized, [key], [order], {"bytes": F.col("_bytes")}, (0, 0, 0, 0), step, "batch").select(key, order, "batch")
