"""Leakage-safe partitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def split_group(*ladder: tuple[str, Column]) -> tuple[Column, Column]:
    """(group, its source): the first identity that is present, as "source:value"."""
    group, source = F.coalesce(*[F.when(c.isNotNull() & (c != ""), F.concat(F.lit(f"{n}:"), c)) for n, c in ladder]), None
    for n, c in ladder:
        present = c.isNotNull() & (c != "")
        source = F.when(present, n) if source is None else source.when(present, n)
    return group, source


def quarantine(train: DataFrame, held: DataFrame, group: str) -> DataFrame:
    """train with quarantined: its group also stands in held. Distinct groups of held are joined, so rows don't multiply."""
    marks = held.select(group).filter(F.col(group).isNotNull()).distinct().withColumn("_held", F.lit(True))
    return train.join(marks, group, "left").withColumn("quarantined", F.coalesce("_held", F.lit(False))).drop("_held")


def leaks(df: DataFrame, identity: str, split: str) -> DataFrame:
    """identity, splits: identities that stand in more than one split."""
    found = df.filter(F.col(identity).isNotNull()).groupBy(identity).agg(F.array_sort(F.collect_set(split)).alias("splits"))
    return found.filter(F.size("splits") > 1)
