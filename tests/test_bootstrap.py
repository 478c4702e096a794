"""The cluster bootstrap against draws made one by one."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import evaluation

SCHEMA = "p double, label int, person string, camera string"


def rows(n, groups, seed=1):
    rng = np.random.default_rng(seed)
    return [(float(rng.random()), int(rng.random() < 0.4), rng.choice([None, ""]) if i % 11 == 0 else f"p{rng.integers(groups)}", None if i % 5 == 0 else "c1") for i in range(n)]


def group_of(r):
    return f"person:{r[2]}" if r[2] else f"camera:{r[3]}" if r[3] else "unknown"


def plain(data, threshold, replicates, seed):
    sums = defaultdict(Counter)
    for r in data:
        sums[group_of(r)][("t" if (r[0] >= threshold) == (r[1] == 1) else "f") + ("p" if r[0] >= threshold else "n")] += 1
    groups = [sums[k] for k in sorted(sums)]
    found = defaultdict(list)
    for rep in range(replicates if len(groups) > 1 else 0):
        total = Counter()
        for k in range(len(groups)):
            total.update(groups[int(hashlib.sha256(f"{seed}:{rep}:{k}".encode()).hexdigest()[:13], 16) % len(groups)])
        for name, top, bottom in (("precision", total["tp"], total["tp"] + total["fp"]), ("recall", total["tp"], total["tp"] + total["fn"]), ("f1", 2 * total["tp"], 2 * total["tp"] + total["fp"] + total["fn"])):
            if bottom:
                found[name].append(top / bottom)
    return {f"{name}_{end}": np.quantile(found[name], q) if found[name] else None for name in ("precision", "recall", "f1") for q, end in ((0.025, "low"), (0.975, "high"))}


@pytest.mark.parametrize(("n", "groups", "threshold", "replicates"), [(400, 30, 0.5, 60), (40, 3, 0.97, 40), (50, 10, 1.5, 10), (30, 6, 0.5, 0)])
def test_bootstrap(spark, n, groups, threshold, replicates):
    data = rows(n, groups)
    df = spark.createDataFrame(data, SCHEMA).repartition(5)
    (got,) = evaluation.cluster_bootstrap(df, evaluation.identity_group("person", "camera"), threshold, replicates, 9).collect()
    want = plain(data, threshold, replicates, 9)
    assert set(want) == set(got.asDict())
    for name, value in want.items():
        assert got[name] == (value if value is None else pytest.approx(value, rel=1e-12)), name


def test_one_group_or_none_has_no_interval(spark):
    df = spark.createDataFrame([(0.9, 1, "a", None)] * 5, SCHEMA)
    for some in (df, df.limit(0)):
        (got,) = evaluation.cluster_bootstrap(some, evaluation.identity_group("person"), 0.5, 20, 1).collect()
        assert set(got) == {None}


def test_every_replicate_draws_as_many_groups_as_there_are(spark):
    groups = spark.range(1, 24).select(F.col("id").alias("place"))
    drawn = evaluation.bootstrap_draws(groups, 23, 50, 4)
    assert {(r["replicate"], r["count"]) for r in drawn.groupBy("replicate").count().collect()} == {(k, 23) for k in range(50)}
    times = [r["count"] for r in drawn.groupBy("replicate", "place").count().collect()]
    assert max(times) > 3 and abs(len(times) / (50 * 23) - (1 - (1 - 1 / 23) ** 23)) < 0.05
    assert "Generate" not in drawn._jdf.queryExecution().executedPlan().toString()
