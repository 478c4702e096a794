"""Text normalisation and lexical matching."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalise(text) -> Column:
    """camelCase, underscores and hyphens become spaces; lower case; runs of white space become one space."""
    spaced = F.regexp_replace(F.regexp_replace(text, "([a-z0-9])([A-Z])", "$1 $2"), "[_-]", " ")
    return F.trim(F.regexp_replace(F.lower(spaced), r"\s+", " "))


def mentions(text, words: list[str]) -> Column:
    """Whether a word stands in the text between ASCII word boundaries."""
    return F.rlike(text, F.lit("(^|[^a-z0-9])(" + "|".join(words) + ")([^a-z0-9]|$)"))


def labels(text, patterns: dict[str, list[str]]) -> Column:
    """Sorted names of the patterns that the text mentions."""
    return F.array_sort(F.array_compact(F.array(*[F.when(mentions(text, w), F.lit(name)) for name, w in patterns.items()])))
