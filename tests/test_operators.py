"""Analytic expectations of the operators."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.functions import hashing, ladders, linalg, quaternion, stats, text
from tidemark.operators import control, evaluation, filters, intervals, labels, ranking, runs, splits, validation
from tidemark.sources import tables


def one(spark, expr):
    return spark.range(1).select(expr.alias("x")).first()["x"]


def mask(spark, n, on):
    rows = [(1, i, any(a <= i < b for a, b in on)) for i in range(n)]
    return spark.createDataFrame(rows, "e int, i int, ok boolean")


def test_visibility_of_a_left_hand(spark):
    r = runs.runs(mask(spark, 300, [(15, 195), (240, 285)]), "e", "i", "ok")
    assert [(x["first"], x["last"], x["n"]) for x in r.filter("ok").orderBy("first").collect()] == [(15, 194, 180), (240, 284, 45)]
    gaps = runs.internal_gaps(r, "e", "ok").collect()
    assert [(g["first"], g["last"], g["n"]) for g in gaps] == [(195, 239, 45)]
    assert runs.longest(r, "e", "ok").first()[1:] == (180, 45)


def test_flicker_leaves_out_the_edges(spark):
    r = runs.runs(mask(spark, 120, [(2, 40), (42, 118)]), "e", "i", "ok")
    assert [(g["first"], g["last"]) for g in runs.internal_gaps(r, "e", "ok", 3).collect()] == [(40, 41)]


def test_bridging_keeps_leading_gaps(spark):
    b = runs.bridged(mask(spark, 10, [(2, 4), (5, 7), (9, 10)]), "e", "i", "ok", 1)
    assert [r["i"] for r in b.filter("ok").orderBy("i").collect()] == [2, 3, 4, 5, 6, 9]


def test_clusters_respect_gap_and_span(spark):
    df = spark.createDataFrame([(1, p) for p in (0, 3, 6, 9, 12, 30)], "e int, p long")
    got = [(r["p"], r["cluster"]) for r in runs.greedy_clusters(df, "e", "p", 4, 9).orderBy("p").collect()]
    assert got == [(0, 0), (3, 0), (6, 0), (9, 0), (12, 1), (30, 2)]


def test_intervals(spark):
    s = spark.createDataFrame([(1, 0, 5), (1, 5, 7), (1, 9, 12), (1, 10, 11), (2, 1, 2)], "k int, start long, end long")
    m = intervals.merge(s, "k")
    assert sorted(map(tuple, m.collect())) == [(1, 0, 7, 2), (1, 9, 12, 2), (2, 1, 2, 1)]
    assert [tuple(r) for r in intervals.gaps(m, "k").collect()] == [(1, 7, 9)]
    over = intervals.adjacent_overlaps(s, "k", ["start", "end"]).filter("overlaps").orderBy("start").collect()
    assert [(r["start"], r["end"]) for r in over] == [(9, 12), (10, 11)]
    pts = spark.createDataFrame([(1, 4), (1, 5), (1, 8), (1, 10)], "k int, at long")
    assert sorted((r["at"], r["start"]) for r in intervals.contained(pts, s, "k", "at", 3).collect()) == [(4, 0), (5, 5), (10, 9), (10, 10)]


def test_asof_both_ways(spark):
    a = spark.createDataFrame([(1, 5), (1, 1), (2, 9)], "k int, t long")
    b = spark.createDataFrame([(1, 2, 20), (1, 5, 50), (1, 7, 70)], "k int, t long, v int")
    back = {(r["k"], r["t"]): r["v"] for r in intervals.asof(a, b, "k", "t", "v").collect()}
    ahead = {(r["k"], r["t"]): r["v"] for r in intervals.asof(a, b, "k", "t", "v", "forward").collect()}
    assert back == {(1, 5): 50, (1, 1): None, (2, 9): None}
    assert ahead == {(1, 5): 50, (1, 1): 20, (2, 9): None}


def test_rotations(spark):
    e = [F.lit(x) for x in (0.3, -0.7, 1.1)]
    m = linalg.euler_to_matrix(e)
    assert one(spark, linalg.orthogonality_error(m)) < 1e-12
    assert abs(one(spark, linalg.determinant(m)) - 1) < 1e-12
    back = [one(spark, x) for x in linalg.matrix_to_euler(m)]
    assert np.allclose(back, (0.3, -0.7, 1.1))
    z = linalg.axis_angle_to_matrix([F.lit(0.0), F.lit(0.0), F.lit(math.pi / 2)])
    assert abs(one(spark, linalg.geodesic_degrees([F.lit(float(i in (0, 4, 8))) for i in range(9)], z)) - 90) < 1e-9


def test_quaternions_and_projection():
    rng = np.random.default_rng(1)
    r = quaternion.project(rng.normal(size=(50, 3, 3)))
    assert np.allclose(np.linalg.det(r), 1) and np.allclose(r @ r.transpose(0, 2, 1), np.eye(3))
    assert np.allclose(quaternion.to_matrix(quaternion.from_matrix(r)), r)


def test_one_euro_follows_a_constant_and_restarts(spark):
    df = spark.createDataFrame([(1, i, None if i == 3 else 2.0) for i in range(6)], "e int, i int, v double")
    assert [r["smooth"] for r in filters.one_euro(df, "e", "i", "v", 30.0).orderBy("i").collect()] == [2.0, 2.0, 2.0, None, 2.0, 2.0]


def test_folds_dont_depend_on_partitions(spark):
    df = spark.createDataFrame([(e, i, float((e * 7 + i * 13) % 11)) for e in range(9) for i in range(50)], "e int, i int, v double")
    a = {(r["e"], r["i"]): r["smooth"] for r in filters.one_euro(df.repartition(7), "e", "i", "v", 30.0).collect()}
    b = {(r["e"], r["i"]): r["smooth"] for r in filters.one_euro(df.coalesce(1), "e", "i", "v", 30.0).collect()}
    assert a == b


def test_nms(spark):
    boxes = [(0.0, 0.0, 1.0, 1.0, 0.9), (0.05, 0.0, 1.0, 1.0, 0.8), (3.0, 3.0, 4.0, 4.0, 0.7), (5.0, 5.0, 6.0, 6.0, 0.1)]
    df = spark.createDataFrame([(1, boxes), (2, [])], "id int, boxes array<struct<x1:double,y1:double,x2:double,y2:double,confidence:double>>")
    assert {r["id"]: r["kept"] for r in filters.nms(df, "boxes", 0.5, 0.5).collect()} == {1: 2, 2: 0}


def test_balanced_groups(spark):
    df = spark.createDataFrame([(i, float(i)) for i in range(1, 17)], "item int, load double")
    sums = {r["worker"]: r["s"] for r in filters.balanced_groups(df, "item", "load", 4).groupBy("worker").agg(F.sum("load").alias("s")).collect()}
    assert set(sums.values()) == {34.0}


def test_ladders(spark):
    assert one(spark, ladders.severity(F.lit(float("nan")), 1, 2)) == "error"
    assert one(spark, ladders.severity(F.lit(float("nan")), 1, 2, missing="info")) == "info"
    assert one(spark, ladders.severity(F.lit(1.5), 1, 2)) == "warning"
    assert one(spark, ladders.reasons(a=F.lit(True), b=F.lit(False), c=F.lit(True))) == ["a", "c"]


@pytest.mark.parametrize("codes, tier, decision", [([], "gold", "accept"), ([("position_jitter", "warning")], "silver", "review"), ([("beta_drift", "error")], "bronze", "reject"), ([("missing_columns", "error")], "quarantine", "quarantine"), ([("data_read_failed", "error")], "bronze", "retry")])
def test_decisions(spark, codes, tier, decision):
    e = spark.createDataFrame([(1,)], "e int")
    found = spark.createDataFrame([(1, c, s) for c, s in codes], "e int, code string, severity string")
    r = validation.decide(e, found, "e", ["position_jitter"]).first()
    assert (r["tier"], r["decision"]) == (tier, decision)


def test_threshold_needs_enough_positives(spark):
    many = spark.createDataFrame([(0.9, 1)] * 500 + [(0.1, 0)] * 2000, "p double, label int")
    t = evaluation.select_threshold(many, 0.99).first()
    assert t["threshold"] == 0.9 and t["lower"] >= 0.99
    few = spark.createDataFrame([(0.9, 1)] * 60 + [(0.1, 0)] * 100, "p double, label int")
    assert evaluation.select_threshold(few, 0.99).count() == 0


def test_auroc_of_ties_and_order(spark):
    df = spark.createDataFrame([(0, 0.5, 1), (0, 0.5, 0), (1, 0.9, 1), (1, 0.1, 0)], "g int, p double, label int")
    got = {r["g"]: r["auroc"] for r in evaluation.ranking_metrics(df, ["g"]).collect()}
    assert got == {0: 0.5, 1: 1.0}


def test_metrics_without_denominator_are_null(spark):
    c = spark.createDataFrame([(0, 0, 0, 5)], "tp long, fp long, fn long, tn long")
    r = evaluation.with_metrics(c).first()
    assert r["precision"] is None and r["recall"] is None and r["specificity"] == 1.0


def test_weights_are_bounded_and_favour_the_rare(spark):
    df = spark.createDataFrame([(i, "a") for i in range(8)] + [(8, "b")], "i int, g string")
    w = {r["g"]: r["weight"] for r in labels.sampling_weights(df, "g").collect()}
    assert w["b"] > w["a"] and all(0.25 <= x <= 4 for x in w.values())


def test_round_robin_alternates(spark):
    df = spark.createDataFrame([(i, "ab"[i % 2]) for i in range(40)], "i int, s string")
    got = ranking.round_robin(df, "s", "i", 3, 8).orderBy("position").collect()
    assert [r["s"] for r in got] == ["a", "b"] * 4
    assert ranking.balanced(df.withColumn("f", F.col("i") < 2), "f", "i", 1, 10).filter("f").count() == 2


def test_splits(spark):
    tr = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "i int, g string")
    held = spark.createDataFrame([(9, "a"), (8, "a")], "i int, g string")
    assert {r["i"]: r["quarantined"] for r in splits.quarantine(tr, held, "g").collect()} == {1: True, 2: False, 3: False}
    names = {one(spark, hashing.split(F.lit(f"v{k}"), [(800, "train"), (900, "validation")], "test", 1000)) for k in range(60)}
    assert names == {"train", "validation", "test"}


def test_planning(spark):
    files = spark.createDataFrame([(1, "a", 3), (1, "b", 4)], "d int, f string, n int")
    sig = control.signature(files, "d", ["f", "n"]).first()["signature"]
    assert control.signature(files.orderBy(F.desc("f")), "d", ["f", "n"]).first()["signature"] == sig
    assert control.signature(files.withColumn("n", F.lit(9)), "d", ["f", "n"]).first()["signature"] != sig
    done = spark.createDataFrame([(1, sig)], "d int, signature string")
    assert control.plan(control.signature(files, "d", ["f", "n"]), done, ["d", "signature"]).count() == 0
    up = control.upsert(files.select("d", "n").limit(1), spark.createDataFrame([(1, 7), (2, 8)], "d int, n int"), "d")
    assert sorted(map(tuple, up.collect())) == [(1, 7), (2, 8)]


def test_text(spark):
    assert one(spark, text.normalise(F.lit("pickUp_the-Red  Cup"))) == "pick up the red cup"
    assert one(spark, text.mentions(F.lit("a cup"), ["cup"])) and not one(spark, text.mentions(F.lit("cupboard"), ["cup"]))


def test_wilson(spark):
    low, high = stats.wilson(F.lit(500), F.lit(500))
    assert 0.99 < one(spark, low) < 1 and one(spark, high) == 1.0


def test_protected_roots(spark, tmp_path):
    with pytest.raises(ValueError, match="protected"):
        tables.write_derived(spark.range(1), str(tmp_path / "raw" / "x"), [str(tmp_path / "raw")])
    tables.write_derived(spark.range(3), str(tmp_path / "derived"), [str(tmp_path / "raw")])
    assert spark.read.parquet(str(tmp_path / "derived")).count() == 3


def test_places_when_partitions_coalesce(spark):
    """Adaptive coalescing reads ranges in other partitions than it writes them; every row keeps its place."""
    n = 400_000
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        df = spark.range(n).select("id", (F.xxhash64("id") % 1000).alias("k"))
        placed = ranking.global_rank(df, "k", "id")
        for _ in range(2):
            r = placed.agg(F.count(F.lit(1)), F.count_distinct("place"), F.min("place"), F.max("place"), F.max("total"), F.sum("id")).first()
            assert tuple(r) == (n, n, 1, n, n, n * (n - 1) // 2)
        wrong = placed.join(placed.select((F.col("place") - 1).alias("place"), F.col("k").alias("k2"), F.col("id").alias("id2")), "place").filter("k > k2 OR (k = k2 AND id >= id2)")
        assert wrong.count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")


def test_values_that_dont_fit(spark):
    df = spark.createDataFrame([(1, 1.0, "7", [1]), (None, 1.5, "x", [1, 2])], "a long, b double, c string, d array<int>")
    got = {r["column"]: (r["nulls"], r["unfit"]) for r in validation.value_conformance(df, {"a": "int", "b": "int", "c": "int", "d": "array<int>", "e": "int"}, {"d": 2}).collect()}
    assert got == {"a": (1, 0), "b": (0, 1), "c": (0, 1), "d": (0, 1), "e": (None, None)}


def test_ranking_metrics_of_several_keys(spark):
    import random

    rng = random.Random(4)
    rows = [(k, rng.randint(0, 20) / 20, rng.randint(0, 1)) for k in (None, "a", "b") for _ in range(80)]
    for r in evaluation.ranking_metrics(spark.createDataFrame(rows, "k string, p double, label int"), ["k"]).collect():
        own = [(p, y) for k, p, y in rows if k == r["k"]]
        pos, neg = [p for p, y in own if y], [p for p, y in own if not y]
        assert r["auroc"] == pytest.approx(sum((a > b) + (a == b) / 2 for a in pos for b in neg) / len(pos) / len(neg))
        hits = [sum(q >= p and y for q, y in own) / sum(q >= p for q, _ in own) for p in pos]
        assert r["average_precision"] == pytest.approx(sum(hits) / len(hits))
