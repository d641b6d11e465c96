"""Ranking factors that no query is needed for; a factor that cannot be told is null, never zero."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom.functions.text import tokens, trimmed

AUTHORITY_SCALE = 10
HALF_LIFE = 25
MIN_CHARS, FULL_AT = 40, 400


def authority(rank: Column, scale: int = AUTHORITY_SCALE) -> Column:
    return rank / F.lit(float(scale))


def temporal(year: Column, now: int, half_life: int = HALF_LIFE) -> Column:
    """half_life / (half_life + age); null outside 1800 to next year. `now` is given, never the clock."""
    age = F.greatest(F.lit(now) - year, F.lit(0))
    return F.when((year >= 1800) & (year <= now + 1), F.round(F.lit(float(half_life)) / (half_life + age), 6))


def structural(chapter: Column, article: Column, annex: Sequence[str], operative: Sequence[str], scores: tuple[float, float, float] = (0.3, 1.0, 0.6)) -> Column:
    """Article before chapter, annex before operative; a labelled rest scores between, no label is null."""
    if not annex and not operative:
        return F.lit(None).cast("double")
    one = lambda ps: "|".join(rf"(?i)^\s*(?:{p})" for p in ps) or r"$^"
    out = F.when(F.lit(False), 0.0)
    for value in (article, chapter):
        out = out.when(value.rlike(one(annex)), scores[0]).when(value.rlike(one(operative)), scores[1])
    return out.when((F.coalesce(chapter, F.lit("")) != "") | (F.coalesce(article, F.lit("")) != ""), scores[2])


def topical(about: Column) -> Column:
    n = F.size(tokens(about))
    return F.when(about.isNull(), None).when(trimmed(about) == "", 0.0).when(n < 2, 0.2).otherwise(1.0)


def completeness(body: Column, terms: Sequence[str], *, min_chars: int = MIN_CHARS, full_at: int = FULL_AT) -> tuple[Column, Column]:
    """Length and term density together, and the density; zero below min_chars whatever the density."""
    words = tokens(trimmed(body))
    known = F.array(*[F.lit(t.lower()) for t in terms])
    density = F.coalesce(F.size(F.filter(words, lambda w: F.array_contains(known, w))) / F.nullif(F.size(words), F.lit(0)), F.lit(0.0))
    chars = F.length(trimmed(body))
    length = F.least((chars - min_chars) / F.lit(float(full_at - min_chars)), F.lit(1.0))
    score = F.when(chars < min_chars, 0.0).otherwise(F.round(0.7 * length + 0.3 * F.least(density * 4, F.lit(1.0)), 6))
    return score, F.round(density, 6)
