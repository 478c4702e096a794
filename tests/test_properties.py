"""Operators against plain Python on generated inputs; each example is one Spark job over many groups."""

import random

from pyspark.sql import functions as F

from tidemark.operators import evaluation, filters, intervals, ranking, runs


def groups(seed, n=60, most=30):
    rng = random.Random(seed)
    return rng, {g: rng.randint(1, most) for g in range(n)}


def test_runs_and_bridges(spark):
    rng, sizes = groups(1)
    flags = {g: [rng.random() < 0.5 for _ in range(n)] for g, n in sizes.items()}
    df = spark.createDataFrame([(g, i, x) for g, f in flags.items() for i, x in enumerate(f)], "g int, i int, ok boolean").repartition(5)

    def plain(f):
        out, start = [], 0
        for i in range(1, len(f) + 1):
            if i == len(f) or f[i] != f[start]:
                out.append((f[start], start, i - 1))
                start = i
        return out

    got = {}
    for r in runs.runs(df, "g", "i", "ok").collect():
        got.setdefault(r["g"], []).append((r["ok"], r["first"], r["last"]))
    assert {g: sorted(v, key=lambda x: x[1]) for g, v in got.items()} == {g: plain(f) for g, f in flags.items()}

    def bridge(f, most):
        f = f[:]
        for ok, a, b in plain(f):
            if not ok and a > 0 and b < len(f) - 1 and b - a + 1 <= most:
                f[a : b + 1] = [True] * (b - a + 1)
        return f

    got = {}
    for r in runs.bridged(df, "g", "i", "ok", 2).orderBy("g", "i").collect():
        got.setdefault(r["g"], []).append(r["ok"])
    assert got == {g: bridge(f, 2) for g, f in flags.items()}


def test_merge_and_gaps(spark):
    rng, sizes = groups(2, most=12)
    spans = {g: [(s := rng.randint(0, 60), s + rng.randint(1, 9)) for _ in range(n)] for g, n in sizes.items()}
    df = spark.createDataFrame([(g, a, b) for g, v in spans.items() for a, b in v], "g int, start long, end long").repartition(5)
    merged = intervals.merge(df, "g")
    covered = {g: {x for a, b in v for x in range(a, b)} for g, v in spans.items()}
    got = {}
    for r in merged.collect():
        got.setdefault(r["g"], set()).update(range(r["start"], r["end"]))
    assert got == covered
    for r in intervals.gaps(merged, "g").collect():
        gap = set(range(r["start"], r["end"]))
        assert gap and not gap & covered[r["g"]] and {r["start"] - 1, r["end"]} <= covered[r["g"]]


def test_asof(spark):
    rng, sizes = groups(3)
    left = [(g, rng.randint(0, 50)) for g, n in sizes.items() for _ in range(n)]
    right = [(g, t, t * 10) for g, t in {(g, rng.randint(0, 50)) for g, n in sizes.items() for _ in range(n)}]
    a, b = spark.createDataFrame(left, "g int, t long"), spark.createDataFrame(right, "g int, t long, v long")
    for direction, pick in (("backward", lambda g, t: max((v for h, u, v in right if h == g and u <= t), default=None)), ("forward", lambda g, t: min((v for h, u, v in right if h == g and u >= t), default=None))):
        got = sorted(((r["g"], r["t"], r["v"]) for r in intervals.asof(a, b, "g", "t", "v", direction).collect()), key=str)
        assert got == sorted(((g, t, pick(g, t)) for g, t in left), key=str)


def test_containment(spark):
    rng, sizes = groups(4, n=20)
    spans = [(g, s := rng.randint(0, 90), s + rng.randint(1, 40)) for g, n in sizes.items() for _ in range(n)]
    points = [(g, rng.randint(0, 120)) for g, n in sizes.items() for _ in range(n)]
    got = intervals.contained(spark.createDataFrame(points, "g int, at long"), spark.createDataFrame(spans, "g int, start long, end long"), "g", "at", 7)
    assert sorted(map(tuple, got.select("g", "at", "start", "end").collect())) == sorted((g, p, a, b) for g, p in points for h, a, b in spans if g == h and a <= p < b)


def test_total_order_sums(spark):
    rng = random.Random(5)
    rows = [(i, rng.randint(0, 20), rng.randint(1, 5)) for i in range(500)]
    df = spark.createDataFrame(rows, "id int, k int, v long").repartition(7)
    got = {r["id"]: (r["s"], r["s_total"]) for r in ranking.running_sums(df, {"s": "v"}, "k", "id").collect()}
    total, want, everything = 0, {}, sum(r[2] for r in rows)
    for i, _, v in sorted(rows, key=lambda r: (r[1], r[0])):
        total += v
        want[i] = total, everything
    assert got == want
    places = [r["id"] for r in ranking.global_rank(df, "k", "id").orderBy("place").collect()]
    assert places == [r[0] for r in sorted(rows, key=lambda r: (r[1], r[0]))]


def test_auroc_and_precision(spark):
    rng = random.Random(6)
    rows = [(g, rng.randint(0, 9) / 10, rng.randint(0, 1)) for g in range(8) for _ in range(40)]
    got = {r["g"]: r for r in evaluation.ranking_metrics(spark.createDataFrame(rows, "g int, p double, label int"), ["g"]).collect()}
    for g in range(8):
        pos, neg = ([p for h, p, y in rows if h == g and y == k] for k in (1, 0))
        wins = sum((a > b) + (a == b) / 2 for a in pos for b in neg)
        assert abs(got[g]["auroc"] - wins / (len(pos) * len(neg))) < 1e-9
        precision = lambda t: sum(p >= t for p in pos) / (sum(p >= t for p in pos) + sum(p >= t for p in neg))  # noqa: B023, E731
        assert abs(got[g]["average_precision"] - sum(map(precision, pos)) / len(pos)) < 1e-9


def test_results_dont_depend_on_partitions(spark):
    rng = random.Random(7)
    df = spark.createDataFrame([(i, rng.choice("abc"), rng.random(), rng.random() < 0.4) for i in range(300)], "i int, s string, x double, ok boolean")
    for f in (
        lambda d: ranking.round_robin(d, "s", "i", 3, 40), lambda d: ranking.balanced(d, "ok", "i", 3, 50), lambda d: ranking.top_k(d, ["s"], 4, "x"),
        lambda d: ranking.representatives(d, "s", "i", 3), lambda d: runs.greedy_clusters(d.withColumn("at", F.col("i").cast("long")), "s", "at", 4, 9), lambda d: filters.sample_frames(d, "s", "i", "x", "ok"),
    ):
        a, b = (sorted(map(str, f(d).collect())) for d in (df.repartition(9), df.coalesce(1)))
        assert a == b and a
