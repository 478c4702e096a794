"""Interval operators on (by, start, end) rows; end is exclusive."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def merge(spans: DataFrame, by: str, start: str = "start", end: str = "end") -> DataFrame:
    """Union of overlapping or touching spans: by, start, end, n (spans merged)."""
    w = W.partitionBy(by).orderBy(start, end)
    reach = F.max(end).over(w.rowsBetween(W.unboundedPreceding, -1))
    marked = spans.withColumn("_new", F.when(F.col(start) <= reach, 0).otherwise(1))
    marked = marked.withColumn("_g", F.sum("_new").over(w.rowsBetween(W.unboundedPreceding, 0)))
    return marked.groupBy(by, "_g").agg(F.min(start).alias("start"), F.max(end).alias("end"), F.count(F.lit(1)).alias("n")).drop("_g")


def gaps(merged: DataFrame, by: str) -> DataFrame:
    """The spans between merged ones: by, start, end."""
    w = W.partitionBy(by).orderBy("start")
    return merged.select(by, F.col("end").alias("start"), F.lead("start").over(w).alias("end")).filter(F.col("end").isNotNull())


def adjacent_overlaps(spans: DataFrame, by: str, order: list[str], start: str = "start", end: str = "end") -> DataFrame:
    """spans with overlaps: whether one overlaps its neighbour before or after it in sorted order."""
    w = W.partitionBy(by).orderBy(*order)
    before = F.coalesce(F.lag(end).over(w) > F.col(start), F.lit(False))
    after = F.coalesce(F.col(end) > F.lead(start).over(w), F.lit(False))
    return spans.withColumn("overlaps", before | after)


def asof(left: DataFrame, right: DataFrame, by: str, at: str, value: str, direction: str = "backward") -> DataFrame:
    """left with the value of the last row of right at or before (backward) or the first at or after (forward) its place.

    One union, one shuffle and one ordered window instead of a range join. Ties on the right: the greatest value backward,
    the least forward.
    """
    sign = 1 if direction == "backward" else -1
    cols = left.columns
    a = left.select(*cols, F.lit(1).alias("_side"), F.lit(None).cast(right.schema[value].dataType).alias("_v"))
    b = right.select(*[F.col(c) if c in (by, at) else F.lit(None).cast(left.schema[c].dataType).alias(c) for c in cols], F.lit(0).alias("_side"), F.col(value).alias("_v"))
    keys = [F.col(at), F.col("_side"), F.col("_v")] if sign > 0 else [F.col(at).desc(), F.col("_side"), F.col("_v").desc()]
    w = W.partitionBy(by).orderBy(*keys).rowsBetween(W.unboundedPreceding, 0)
    both = a.unionByName(b).withColumn(value, F.last("_v", ignorenulls=True).over(w))
    return both.filter("_side = 1").drop("_side", "_v")


def contained(points: DataFrame, spans: DataFrame, by: str, at: str, cell: int) -> DataFrame:
    """points joined with the spans of their key that contain them: an equi-join on (by, cell) after spans are dealt to the
    cells that they touch, so no cross join is made.
    """
    dealt = spans.withColumn("_cell", F.explode(F.sequence(F.floor(F.col("start") / cell), F.floor((F.col("end") - 1) / cell))))
    placed = points.withColumn("_cell", F.floor(F.col(at) / cell))
    return placed.join(dealt, [by, "_cell"]).filter((F.col(at) >= F.col("start")) & (F.col(at) < F.col("end"))).drop("_cell")


def nearest(left: DataFrame, right: DataFrame, by: str, at: str, value: str) -> DataFrame:
    """left with the value of the row of right that is nearest to its place; of two equally near the later one.

    One exchange: both neighbours come from windows over the same union, the one before strictly (its last row), the one at or
    after (its first). Rows of equal place on the right go in ascending order of value.
    """
    cols = left.columns
    a = left.select(*cols, F.lit(0).alias("_side"), F.lit(None).cast(right.schema[value].dataType).alias("_v"), F.lit(None).cast(right.schema[at].dataType).alias("_t"))
    b = right.select(*[F.col(c) if c in (by, at) else F.lit(None).cast(left.schema[c].dataType).alias(c) for c in cols], F.lit(1).alias("_side"), F.col(value).alias("_v"), F.col(at).alias("_t"))
    here = F.when(F.col("_side") == 1, F.struct("_t", "_v"))
    up = W.partitionBy(by).orderBy(F.col(at), "_side", "_v").rowsBetween(W.unboundedPreceding, 0)
    down = W.partitionBy(by).orderBy(F.col(at).desc(), F.col("_side").desc(), F.col("_v").desc()).rowsBetween(W.unboundedPreceding, 0)
    both = a.unionByName(b).withColumn("_b", F.last(here, ignorenulls=True).over(up)).withColumn("_a", F.last(here, ignorenulls=True).over(down)).filter("_side = 0")
    before = F.col("_a").isNull() | (F.abs(F.col(at) - F.col("_b._t")) < F.abs(F.col("_a._t") - F.col(at)))
    return both.withColumn(value, F.when(before, F.col("_b._v")).otherwise(F.col("_a._v"))).drop("_side", "_v", "_t", "_a", "_b")


def at_fixed_rate(clips: DataFrame, frames: DataFrame, by: str, at: str, frame: str, clip: str = "clip", start: str = "start", window_s: str = "window_s", fps: str = "decode_fps", second: float = 1.0, tolerance: float = 1e-6) -> DataFrame:
    """clip, k, target, frame, repeated: for each of a clip's places on its grid the first frame at or after it.

    A clip has max(1, window_s * fps, rounded half to even) places, 1 / fps seconds apart from start on; second: units of `at`
    in a second; a frame may be `tolerance` units early. Places without a frame repeat that of the place before; places
    before any have null (a clip that can't be decoded). Frames of equal time: the smallest. Grids and frames meet in one
    sorted pass over one exchange on the entity; a clip's places are bounded by its window, whatever the number of frames.
    """
    n = F.greatest(F.lit(1), F.bround(F.col(window_s) * F.col(fps), 0).cast("int"))
    grid = clips.select(by, clip, start, fps, F.explode(F.sequence(F.lit(0), n - 1)).alias("k"))
    grid = grid.select(by, clip, "k", (F.col(start) + F.col("k") * F.lit(float(second)) / F.col(fps)).alias("target"))
    none = lambda df, c: F.lit(None).cast(df.schema[c].dataType).alias(c)
    places = grid.select(by, clip, "k", "target", (F.col("target") - tolerance).alias("_at"), F.lit(0).alias("_side"), none(frames, frame))
    shots = frames.select(by, none(grid, clip), none(grid, "k"), none(grid, "target"), F.col(at).cast("double").alias("_at"), F.lit(1).alias("_side"), frame)
    w = W.partitionBy(by).orderBy(F.col("_at").desc(), F.col("_side").desc(), F.col(frame).desc()).rowsBetween(W.unboundedPreceding, 0)
    met = places.unionByName(shots).withColumn("_next", F.last(frame, ignorenulls=True).over(w)).filter("_side = 0")
    filled = F.last("_next", ignorenulls=True).over(W.partitionBy(by, clip).orderBy("k").rowsBetween(W.unboundedPreceding, 0))
    return met.withColumn(frame, filled).select(by, clip, "k", "target", frame, (F.col("_next").isNull() & F.col(frame).isNotNull()).alias("repeated"))
