"""Runs of equal flags along ordered frames: islands and gaps by differences of row numbers, never by loops."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def runs(frames: DataFrame, by: str, order: str, flag: str, extra: dict | None = None) -> DataFrame:
    """by, flag, first, last (inclusive values of order), n: maximal runs of equal flag. extra: more aggregates of a run."""
    w = W.partitionBy(by).orderBy(order)
    marked = frames.withColumn("_new", F.when(F.lag(flag).over(w).eqNullSafe(F.col(flag)), 0).otherwise(1))
    marked = marked.withColumn("_run", F.sum("_new").over(w.rowsBetween(W.unboundedPreceding, 0)))
    more = [c.alias(name) for name, c in (extra or {}).items()]
    return marked.groupBy(by, "_run", flag).agg(F.min(order).alias("first"), F.max(order).alias("last"), F.count(F.lit(1)).alias("n"), *more).drop("_run")


def internal_gaps(found: DataFrame, by: str, flag: str, most: int | None = None) -> DataFrame:
    """False runs with a true run on both sides, of at most `most` frames."""
    w = W.partitionBy(by)
    seen = found.withColumn("_lo", F.min(F.when(F.col(flag), F.col("first"))).over(w)).withColumn("_hi", F.max(F.when(F.col(flag), F.col("last"))).over(w))
    inside = seen.filter(~F.col(flag) & (F.col("first") > F.col("_lo")) & (F.col("last") < F.col("_hi")))
    return (inside.filter(F.col("n") <= most) if most is not None else inside).drop("_lo", "_hi")


def bridged(frames: DataFrame, by: str, order: str, flag: str, most: int) -> DataFrame:
    """frames with flag set in internal gaps of at most `most` frames."""
    w = W.partitionBy(by).orderBy(order)
    back = F.last(F.when(F.col(flag), F.col(order)), ignorenulls=True).over(w.rowsBetween(W.unboundedPreceding, 0))
    ahead = F.first(F.when(F.col(flag), F.col(order)), ignorenulls=True).over(w.rowsBetween(0, W.unboundedFollowing))
    return frames.withColumn("_b", back).withColumn("_a", ahead).withColumn(flag, F.col(flag) | F.coalesce(F.col("_a") - F.col("_b") - 1 <= most, F.lit(False))).drop("_a", "_b")


def longest(found: DataFrame, by: str, flag: str) -> DataFrame:
    """by, longest_true, longest_false: frames of the longest runs, 0 where there is none."""
    pick = lambda c: F.coalesce(F.max(F.when(c, F.col("n"))), F.lit(0))
    return found.groupBy(by).agg(pick(F.col(flag)).alias("longest_true"), pick(~F.col(flag)).alias("longest_false"))


def fold(df: DataFrame, by: str, order: str, value: str, out: str, kind: str, step) -> DataFrame:
    """by, order, out: step(state, value) -> (state, out) along each entity in order; the state starts as None.

    For recursions that no window can express. Partitions hold whole entities in sorted order and are streamed: one state
    is kept, whatever an entity's length.
    """
    rows = df.select(by, order, value).repartition(by).sortWithinPartitions(by, order)
    types = dict(df.dtypes)

    def run(batches):
        import pandas as pd

        entity = state = None
        for frame in batches:
            made = []
            for e, v in zip(frame[by].tolist(), frame[value].tolist(), strict=True):
                if e != entity:
                    entity, state = e, None
                state, x = step(state, v)
                made.append(x)
            yield pd.DataFrame({by: frame[by], order: frame[order], out: made})

    return rows.mapInPandas(run, f"{by} {types[by]}, {order} {types[order]}, {out} {kind}")


def greedy_clusters(events: DataFrame, by: str, order: str, gap: int, span: int) -> DataFrame:
    """by, order, cluster (from 0): a new one begins where the gap to the last event is above gap, or the distance to the
    cluster's first event is above span. The second rule depends on earlier choices, hence a fold.
    """

    def step(state, p):
        if state is None:
            return (p, p, 0), 0
        first, last, k = state
        if p - last > gap or p - first > span:
            first, k = p, k + 1
        return (first, p, k), k

    return fold(events.withColumn("_at", F.col(order)), by, order, "_at", "cluster", "int", step)
