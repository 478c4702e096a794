"""Evaluation of scored predictions: (p, label) rows, label 0 or 1."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.stats import ratio, wilson
from ..sources.shared import cut
from .ranking import global_rank, running_sums


def confusion(p: Column, label: Column, threshold) -> dict[str, Column]:
    hit, yes = p >= threshold, label == 1
    cases = {"tp": hit & yes, "fp": hit & ~yes, "fn": ~hit & yes, "tn": ~hit & ~yes}
    return {name: F.coalesce(F.sum(c.cast("bigint")), F.lit(0)).alias(name) for name, c in cases.items()}


def with_metrics(counts: DataFrame) -> DataFrame:
    """Precision, recall, specificity, FPR, F1 and the Wilson interval of precision; null where a denominator is 0."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    low, high = wilson(tp, tp + fp)
    return counts.withColumns({
        "precision": ratio(tp, tp + fp), "recall": ratio(tp, tp + fn), "specificity": ratio(tn, tn + fp), "fpr": ratio(fp, fp + tn),
        "f1": ratio(2 * tp, 2 * tp + fp + fn), "precision_low": low, "precision_high": high,
    })


def by_score(scored: DataFrame, keys: list[str], p: str = "p", label: str = "label") -> DataFrame:
    """keys, p, n, pos: one row a distinct score. All ranking metrics start here, so later windows see scores, not rows."""
    return scored.groupBy(*keys, p).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(label).cast("bigint")).alias("pos"))


def ranking_metrics(scored: DataFrame, keys: list[str], p: str = "p", label: str = "label") -> DataFrame:
    """keys, auroc (ties half), average_precision (equal scores enter together).

    Running counts go through one total order of (keys, score), in range partitions, less what came before a key's first
    score: a few keys with many scores still spread over all tasks.
    """
    s = by_score(scored, keys, p, label).withColumn("_down", -F.col(p))
    s = running_sums(s, {"_n": "n", "_tp": "pos"}, *keys, "_down").drop("_n_total", "_tp_total")
    neg = F.col("n") - F.col("pos")
    per = s.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(F.min(F.col("_n") - F.col("n")).alias("_n0"), F.min(F.col("_tp") - F.col("pos")).alias("_tp0"), F.sum(neg).alias("_neg"))
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    s = s.join(per, reduce(Column.__and__, same)) if keys else s.crossJoin(F.broadcast(per))
    s = s.withColumn("_n", F.col("_n") - F.col("_n0")).withColumn("_tp", F.col("_tp") - F.col("_tp0"))
    below = F.col("_neg") - (F.col("_n") - F.col("_tp"))
    return s.groupBy(*keys).agg(
        ratio(F.sum(F.col("pos") * (below + neg / 2.0)), F.sum("pos") * F.sum(neg)).alias("auroc"),
        ratio(F.sum(F.col("pos") * F.col("_tp") / F.col("_n")), F.sum("pos")).alias("average_precision"),
    )


def calibration(scored: DataFrame, bins: int, p: str = "p", label: str = "label") -> DataFrame:
    """One row: brier and the expected calibration error over equal bins."""
    binned = scored.groupBy(F.least(F.floor(F.col(p) * bins), F.lit(bins - 1)).alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.avg(p).alias("confidence"), F.avg(label).alias("accuracy"), F.sum((F.col(p) - F.col(label)) * (F.col(p) - F.col(label))).alias("squares")
    )
    return binned.agg(F.sum("n").alias("n"), (F.sum("squares") / F.sum("n")).alias("brier"), (F.sum(F.abs(F.col("confidence") - F.col("accuracy")) * F.col("n")) / F.sum("n")).alias("ece"))


def select_threshold(scored: DataFrame, target: float, p: str = "p", label: str = "label") -> DataFrame:
    """One row at most: the observed score whose precision has its lower bound at target or above, with most recall, then
    the best bound, then the least threshold."""
    s = by_score(scored, [], p, label).withColumn("_down", -F.col(p))
    s = running_sums(s, {"selected": "n", "tp": "pos"}, "_down").withColumnRenamed("tp_total", "positives")
    s = s.withColumn("lower", wilson(F.col("tp"), F.col("selected"))[0]).withColumn("recall", ratio(F.col("tp"), F.col("positives")))
    return s.filter(F.col("lower") >= target).orderBy(F.col("recall").desc(), F.col("lower").desc(), F.col(p)).limit(1).select(F.col(p).alias("threshold"), "selected", "tp", "recall", "lower")


def identity_group(*fields: str) -> Column:
    """"field:value" of the first field that has a value, else "unknown"."""
    named = [F.when(F.col(f).isNotNull() & (F.col(f).cast("string") != ""), F.concat(F.lit(f"{f}:"), F.col(f).cast("string"))) for f in fields]
    return F.coalesce(*named, F.lit("unknown"))


def bootstrap_draws(groups: DataFrame, n: int, replicates: int, seed) -> DataFrame:
    """replicate and the columns of groups: n draws of the n groups a replicate, with replacement.

    groups: with place, from 1 to n. A draw is a digest of (seed, replicate, number of the draw), so it needs no collection of
    groups and is the same at every partitioning; only as many rows as are drawn are ever made, and they meet the groups by place.
    """
    spark = groups.sparkSession
    drawn = spark.range(replicates * n).select(F.floor(F.col("id") / n).cast("int").alias("replicate"), (F.col("id") % n).alias("_k"))
    digest = F.sha2(F.concat_ws(":", F.lit(str(seed)), F.col("replicate").cast("string"), F.col("_k").cast("string")), 256)
    drawn = drawn.select("replicate", (F.conv(F.substring(digest, 1, 13), 16, 10).cast("bigint") % n + 1).alias("place"))
    return drawn.join(groups, "place")


def cluster_bootstrap(scored: DataFrame, group: str | Column, threshold: float, replicates: int, seed, p: str = "p", label: str = "label") -> DataFrame:
    """One row: 2.5 and 97.5 percentiles of precision, recall and F1 over replicates that draw as many groups as there are,
    with replacement. Replicates without a denominator don't count; all is null with fewer than two groups or no replicate.

    Groups are summed first and numbered by a range-partitioned sort; a draw is a row of four sums.
    """
    sums = scored.groupBy((F.col(group) if isinstance(group, str) else group).alias("_group")).agg(*confusion(F.col(p), F.col(label), threshold).values())
    placed = cut(global_rank(sums, "_group").select("place", "tp", "fp", "fn", "tn"), "groups")
    n = placed.count()
    if n < 2:
        replicates = 0
    rep = bootstrap_draws(placed, n, replicates, seed) if n else placed.withColumn("replicate", F.lit(0))
    rep = with_metrics(rep.groupBy("replicate").agg(*[F.sum(c).alias(c) for c in ("tp", "fp", "fn", "tn")]))
    return rep.agg(*[F.percentile(c, F.lit(q)).alias(f"{c}_{name}") for c in ("precision", "recall", "f1") for q, name in ((0.025, "low"), (0.975, "high"))])
