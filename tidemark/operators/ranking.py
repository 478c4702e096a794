"""Deterministic sampling and ordering: top-k, representatives, round robin, balanced and binned choice."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import hashing
from ..sources.shared import cut


def top_k(df: DataFrame, strata: list[str], k: int, *order) -> DataFrame:
    """The first k rows of each stratum in the given order. Spark keeps k rows a task (WindowGroupLimit) before it shuffles."""
    return df.withColumn("_n", F.row_number().over(W.partitionBy(*strata).orderBy(*order))).filter(F.col("_n") <= k).drop("_n")


def representatives(df: DataFrame, group: str, identity: str, seed) -> DataFrame:
    """The row of least rank of each group: an aggregation, which combines before it shuffles."""
    ranked = df.withColumn("_r", hashing.rank(F.col(identity), seed))
    return ranked.groupBy(group).agg(F.min_by(F.struct(*df.columns), F.struct("_r", identity)).alias("_row")).select("_row.*")


def round_robin(df: DataFrame, stratum: str, identity: str, seed, limit: int) -> DataFrame:
    """limit rows, one of each stratum a round, with position. Only the limit best of each stratum can be chosen."""
    w = W.partitionBy(stratum).orderBy(hashing.rank(F.col(identity), seed), identity)
    dealt = df.withColumn("round", F.row_number().over(w)).filter(F.col("round") <= limit)
    best = dealt.orderBy("round", stratum).limit(limit)
    return best.withColumn("position", F.row_number().over(W.orderBy("round", stratum)))


def balanced(df: DataFrame, flag: str, identity: str, seed, n: int) -> DataFrame:
    """n rows, half with the flag; what one side lacks is filled from the other."""
    w = W.partitionBy(flag).orderBy(hashing.rank(F.col(identity), seed), identity)
    ranked = df.withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= n)
    ranked = ranked.withColumn("_late", (F.col("_n") > F.when(F.col(flag), n // 2).otherwise(n - n // 2)).cast("int"))
    return ranked.orderBy("_late", "_n", F.col(flag).desc()).limit(n).drop("_n", "_late")


def running_sums(df: DataFrame, sums: dict[str, str], *order) -> DataFrame:
    """df with running sums (new name -> column) in the total order of rows, and their totals as <name>_total.

    Sums within range partitions plus those of the partitions before: a total order without a task that holds all rows.
    The rows are written with the number of their range, so that the sums within ranges and those of whole ranges speak of
    the same ranges, whatever partitions Spark reads them in. The table of ranges has a row a partition.
    """
    parted = cut(df.repartitionByRange(*order).withColumn("_p", F.spark_partition_id()), "ranges")
    w = W.partitionBy("_p").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    local = parted.withColumns({name: F.sum(c).over(w) for name, c in sums.items()})
    parts = parted.groupBy("_p").agg(*[F.sum(c).alias(f"_{name}") for name, c in sums.items()])
    before, everything = W.orderBy("_p").rowsBetween(W.unboundedPreceding, -1), W.partitionBy()
    parts = parts.select("_p", *[F.coalesce(F.sum(f"_{n}").over(before), F.lit(0)).alias(f"_{n}") for n in sums], *[F.sum(f"_{n}").over(everything).alias(f"{n}_total") for n in sums])
    return local.join(F.broadcast(parts), "_p").withColumns({n: F.col(n) + F.col(f"_{n}") for n in sums}).drop("_p", *[f"_{n}" for n in sums])


def global_rank(df: DataFrame, *order) -> DataFrame:
    """df with place (from 1) in the total order, and total: the number of rows."""
    return running_sums(df.withColumn("_one", F.lit(1).cast("bigint")), {"place": "_one"}, *order).withColumnRenamed("place_total", "total").drop("_one")


#: Values of a slice that the driver takes to find a place among them.
SLICE = 10_000


def quantiles(df: DataFrame, value: Column, qs: list[float]) -> list[float | None]:
    """Exact percentiles of value with linear interpolation, as F.percentile gives them; nulls don't count, None without values.

    F.percentile collects a count for each distinct value in one task. Here two pivots of a bounded sketch close in on a place:
    a pass counts what lies below, at and between them, so the sketch decides how many passes there are, never the result.
    """
    values = df.select(value.cast("double").alias("v")).filter("v IS NOT NULL")
    total, found = values.count(), []
    for q in qs:
        if not total:
            found.append(None)
            continue
        place = (total - 1) * q
        low, high = math.floor(place), math.ceil(place)
        a, upto = _at_place(values, low)
        b = a if high < upto else values.filter(F.col("v") > a).agg(F.min("v")).first()[0]
        found.append(a if a == b or low == high else (high - place) * a + (place - low) * b)
    return found


def _at_place(values: DataFrame, place: int) -> tuple[float, int]:
    """(the value at a place from 0 in the order of v, how many values are not above it)."""
    below, left = 0, values
    n = None
    while True:
        if n is None:
            n = left.count()
        if n <= SLICE:
            own = sorted((r[0] for r in left.collect()), key=lambda x: (math.isnan(x), x))
            x = own[place - below]
            return x, below + sum(y <= x or math.isnan(x) for y in own)
        q = (place - below) / (n - 1)
        lo, hi = left.agg(F.percentile_approx("v", F.array(F.lit(max(0.0, q - 2e-4)), F.lit(min(1.0, q + 2e-4))), F.lit(10_000))).first()[0]
        v, x, y = F.col("v"), F.lit(lo), F.lit(hi)
        parts = [(v < x, None), (v == x, lo), ((v > x) & (v < y), None), ((v == y) & (x < y), hi), (v > y, None)]
        for (part, pivot), count in zip(parts, left.agg(*[F.count_if(c) for c, _ in parts]).first(), strict=True):
            if place < below + count:
                break
            below += count
        if pivot is not None:
            return pivot, below + count
        left, n = left.filter(part), count
