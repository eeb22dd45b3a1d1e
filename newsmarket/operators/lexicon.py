"""Tagging with word lexicons; lexicons are arguments."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsmarket.functions.text import terms_present, with_terms


def labels_present(text: Column, aliases: dict[str, list[str]]) -> Column:
    """Sorted labels with an alias that occurs as a whole word; no row is multiplied."""
    terms = [t for of in aliases.values() for t in of]
    return with_terms(text, terms, lambda has: F.array_sort(F.array_compact(F.array(*[F.when(has(of), F.lit(label)) for label, of in aliases.items()]))))


def first_label(text: Column, ordered: list[tuple[str, list[str]]]) -> Column:
    """The first label, in the lexicon's order, with a term in the text."""
    terms = [t for _, of in ordered for t in of]
    return with_terms(text, terms, lambda has: F.coalesce(*[F.when(has(of), F.lit(label)) for label, of in ordered]))


def macro_terms(text: Column, terms: list[str]) -> Column:
    return terms_present(text, terms)


def macro_bypass(text: Column, source: Column, terms: list[str], trusted: list[str]) -> Column:
    """Two distinct terms, or one from a trusted source, let a text pass without an entity."""
    return F.size(macro_terms(text, terms)) >= F.when(source.isin(trusted), 1).otherwise(2)
