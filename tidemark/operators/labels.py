"""Labels of different authority, weights and tiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .ranking import quantiles


def precedence(sources: list[tuple[str, Column, Column]]) -> Column:
    """struct(source, value, weight) of the first source that has a value; all null if none has."""
    steps = [F.when(v.isNotNull(), F.struct(F.lit(n).alias("source"), v.cast("double").alias("value"), w.cast("double").alias("weight"))) for n, v, w in sources]
    return F.coalesce(*steps)


def bands(p: Column, strong_positive: float, strong_negative: float) -> Column:
    return F.when(p >= strong_positive, "strong_positive").when(p <= strong_negative, "strong_negative").otherwise("soft")


def sampling_weights(df: DataFrame, group: str, low: float = 0.25, high: float = 4.0) -> DataFrame:
    """df with weight: one over the root of the group's size, scaled to mean 1 over rows, then clamped."""
    sizes = df.groupBy(group).agg(F.count(F.lit(1)).alias("_n")).withColumn("_raw", 1.0 / F.sqrt("_n"))
    mean = sizes.agg((F.sum(F.col("_raw") * F.col("_n")) / F.sum("_n")).alias("_mean"))
    sizes = sizes.crossJoin(F.broadcast(mean)).select(group, F.greatest(F.lit(low), F.least(F.lit(high), F.col("_raw") / F.col("_mean"))).alias("weight"))
    return df.join(sizes, group)


def quantile_tiers(df: DataFrame, score: str, passing: str, clean: float = 0.67, hard: float = 0.2) -> DataFrame:
    """df with tier: blocked if it doesn't pass, else by the score's quantiles over passing rows."""
    high, low = (F.lit(q).cast("double") for q in quantiles(df.filter(passing), F.col(score), [clean, hard]))
    tier = F.when(~F.col(passing), "blocked").when(F.col(score) >= high, "clean").when(F.col(score) <= low, "hard_negative").otherwise("review")
    return df.withColumn("tier", tier)


def latest(df: DataFrame, key: str, *order) -> DataFrame:
    """The last row of each key: an aggregation with partial results, not a window."""
    return df.groupBy(key).agg(F.max_by(F.struct(*df.columns), F.struct(*order)).alias("_row")).select("_row.*")


def ordered(df: DataFrame, key: str, *order) -> DataFrame:
    return df.withColumn("n", F.row_number().over(W.partitionBy(key).orderBy(*order)))
