"""Column expressions over text: tokens, estimates and the verdict on a text layer."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed values that results depend on.
TOKEN = r"[\p{L}\p{N}_]{2,}"
PIECE = r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s]"
TOKENS_PER_PIECE = 1.35
MIN_CHARS_PER_PAGE = 200
MAX_LETTER_RUN = 24
CONTROL = r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]"
REPLACEMENT = "�"


def tokens(text: Column) -> Column:
    """Lower-case words of two characters or more."""
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0))


def estimated_tokens(text: Column) -> Column:
    """Words and marks, times a constant, rounded down."""
    return F.floor(F.regexp_count(text, F.lit(PIECE)) * F.lit(TOKENS_PER_PIECE)).cast("long")


def longest_letter_run(text: Column) -> Column:
    runs = F.regexp_extract_all(text, F.lit(r"\p{L}+"), F.lit(0))
    return F.coalesce(F.array_max(F.transform(runs, F.length)), F.lit(0)).cast("long")


def trimmed(text: Column) -> Column:
    return F.regexp_replace(text, r"^[\s]+|[\s]+$", "")


def text_layer(text: Column, pages: Column | None = None, *, min_chars: int = MIN_CHARS_PER_PAGE, max_run: int = MAX_LETTER_RUN) -> dict[str, Column]:
    """The measures of a text layer, and its verdict: absent, damaged or clean."""
    chars = F.length(trimmed(text)).cast("long")
    per_page = chars / F.greatest(F.coalesce(pages, F.lit(1)) if pages is not None else F.lit(1), F.lit(1))
    control = F.regexp_count(text, F.lit(CONTROL)).cast("long")
    replaced = (F.length(text) - F.length(F.replace(text, F.lit(REPLACEMENT), F.lit("")))).cast("long")
    run = longest_letter_run(text)
    damaged = (control > 0) | (replaced > 0) | (run > max_run)
    verdict = F.when(per_page < min_chars, "absent").when(damaged, "damaged").otherwise("clean")
    reasons = F.array_compact(F.array(F.when(control > 0, "control"), F.when(replaced > 0, "replacement"), F.when(run > max_run, "run")))
    return {"chars": chars, "control_chars": control, "replacement_chars": replaced, "longest_run": run, "layer": verdict, "reasons": F.when(per_page < min_chars, F.array(F.lit("short"))).otherwise(reasons)}
