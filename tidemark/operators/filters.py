"""Recursive filters and other per-entity work that windows can't express; entities stream through tasks in order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import repair
from .ranking import global_rank


def one_euro(df: DataFrame, by: str, order: str, value: str, fps: float, min_cutoff: float = 1.0, beta: float = 0.1, derivative_cutoff: float = 1.0) -> DataFrame:
    """by, order, smooth: a low-pass filter whose cutoff rises with the filtered speed of the input. Nulls end a run."""
    out = repair.smoothed(df.select(by, order, value), by, order, value, "vector", 1, fps, min_cutoff=min_cutoff, beta=beta, derivative_cutoff=derivative_cutoff)
    return out.select(by, order, "smooth")


def one_euro_rotations(df: DataFrame, by: str, order: str, matrix: str, fps: float, **options) -> DataFrame:
    """by, order, smooth (row-major array of nine): the same on rotations, where angular speed sets the cutoff."""
    return repair.smoothed(df.select(by, order, matrix), by, order, matrix, "rotation", 9, fps, **options).select(by, order, "smooth")


def nms(samples: DataFrame, boxes: str, confidence: float, overlap: float) -> DataFrame:
    """samples with kept: boxes (x1, y1, x2, y2, confidence) left after greedy suppression, a count for each row.

    A row's boxes fold inside the JVM: sorted by confidence, each stays unless it overlaps one that stayed.
    """

    def iou(a, b):
        side = lambda lo, hi: F.greatest(F.lit(0.0), F.least(a[hi], b[hi]) - F.greatest(a[lo], b[lo]))
        inter = side("x1", "x2") * side("y1", "y2")
        area = lambda c: (c["x2"] - c["x1"]) * (c["y2"] - c["y1"])
        whole = area(a) + area(b) - inter
        return F.when(whole > 0, inter / whole).otherwise(0.0)

    sure = F.filter(boxes, lambda b: b["confidence"] >= confidence)
    ranked = F.transform(F.sort_array(F.transform(sure, lambda b: F.struct(b["confidence"].alias("c"), b.alias("b"))), asc=False), lambda x: x["b"])
    kept = F.aggregate(ranked, F.slice(F.col(boxes), 1, 0), lambda done, b: F.when(F.exists(done, lambda k: iou(k, b) > overlap), done).otherwise(F.concat(done, F.array(b))))
    return samples.withColumn("kept", F.size(kept))


def balanced_groups(sizes: DataFrame, item: str, load: str, workers: int) -> DataFrame:
    """item, worker: the largest loads are dealt first, to and fro over the workers (0 1 2 2 1 0 ...), which keeps the sums
    close without a serial heap; places come from a range-partitioned sort.
    """
    placed = global_rank(sizes.withColumn("_desc", -F.col(load)), "_desc", item)
    k = (F.col("place") - 1) % (2 * workers)
    return placed.select(item, load, F.when(k < workers, k).otherwise(2 * workers - 1 - k).cast("int").alias("worker"))


def sample_frames(frames: DataFrame, by: str, order: str, score: str, flag: str, most: int = 12) -> DataFrame:
    """by, order, reason: up to `most` frames of each entity: flips of flag (2), greatest scores (3), then quantile places."""
    from pyspark.sql import Window as W

    w = W.partitionBy(by)
    f = frames.withColumn("_n", F.count(F.lit(1)).over(w)).withColumn("_k", F.row_number().over(w.orderBy(order)))
    f = f.withColumn("_flip", F.coalesce(F.lag(flag).over(w.orderBy(order)) != F.col(flag), F.lit(False)))
    f = f.withColumn("_fk", F.row_number().over(w.orderBy(F.col("_flip").desc(), order))).withColumn("_sk", F.row_number().over(w.orderBy(F.col(score).desc_nulls_last(), order)))
    step = F.greatest(F.lit(1), F.floor(F.col("_n") / most))
    reason = F.when(F.col("_flip") & (F.col("_fk") <= 2), "flip").when(F.col("_sk") <= 3, "score").when((F.col("_k") - 1) % step == 0, "quantile")
    f = f.withColumn("reason", reason).filter("reason IS NOT NULL")
    first = F.when(F.col("reason") == "flip", 0).when(F.col("reason") == "score", 1).otherwise(2)
    return f.withColumn("_p", F.row_number().over(w.orderBy(first, order))).filter(F.col("_p") <= most).select(by, order, "reason")
