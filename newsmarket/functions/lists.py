"""List and number cleaning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip


def clean_tickers(x: Column) -> Column:
    """Trimmed, upper case, distinct in order; null if nothing is left."""
    kept = F.array_distinct(F.filter(F.transform(x, lambda t: F.upper(strip(t))), lambda t: t.isNotNull() & (t != "")))
    return F.when(F.size(kept) > 0, kept)


def clean_entities(x: Column) -> Column:
    """Trimmed, distinct whatever the case, the first spelling kept; null if nothing is left."""
    filled = F.filter(F.transform(x, strip), lambda t: t.isNotNull() & (t != ""))
    kept = F.aggregate(
        filled,
        F.array().cast("array<string>"),
        lambda acc, t: F.when(F.exists(acc, lambda a: F.lower(a) == F.lower(t)), acc).otherwise(F.concat(acc, F.array(t))),
    )
    return F.when(F.size(kept) > 0, kept)


def clean_texts(x: Column, longest: int = 128, most: int = 32) -> Column:
    """Model lists: trimmed, not blank, cut to ``longest`` characters, distinct in order, the first ``most``."""
    kept = F.filter(F.transform(x, strip), lambda t: t.isNotNull() & (t != ""))
    return F.slice(F.array_distinct(F.transform(kept, lambda t: F.left(t, F.lit(longest)))), 1, most)


def clamp01(x: Column) -> Column:
    """A number moved into 0..1; null for what is no number."""
    n = x.try_cast("double")
    return F.when(n.isNotNull() & ~F.isnan(n), F.least(F.greatest(n, F.lit(0.0)), F.lit(1.0)))


def nan_to_null(x: Column) -> Column:
    return F.when(~F.isnan(x), x)


def within(x: Column, allowed: list[str]) -> Column:
    """Items of a closed vocabulary, in their own order."""
    return F.array_intersect(F.coalesce(x, F.array().cast("array<string>")), F.array(*map(F.lit, allowed)))
