"""Exact percentiles in bounded memory (F2)."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import ranking

RNG = random.Random(2)
CASES = {
    "distinct": [RNG.lognormvariate(0, 3) for _ in range(40_000)],
    "few": [float(RNG.randrange(3)) for _ in range(30_000)],
    "two": [1.0] * 15_000 + [2.0] * 15_000,
    "outliers": [1e300, -1e300, *[RNG.random() for _ in range(25_000)], *[math.nan] * 3],
    "infinite": [math.inf] * 12_000 + [-math.inf] * 12_000 + [0.5],
    "nulls": [None, 3.0, None, 4.0],
    "one": [7.0],
    "none": [None, None],
}


@pytest.mark.parametrize("case", sorted(CASES))
def test_quantiles_are_exact(spark, case):
    df = spark.createDataFrame([(v,) for v in CASES[case]], "v double")
    qs = [0.0, 0.2, 0.5, 0.67, 1.0]
    want = list(df.agg(*[F.percentile("v", F.lit(q)) for q in qs]).first())
    assert str(ranking.quantiles(df, F.col("v"), qs)) == str(want)


@pytest.mark.parametrize("name", ["eta_estimate", "quantile_tiers"])
def test_no_task_counts_all_values(spark, name):
    from tidemark import catalog

    plan = catalog.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "percentile(" not in plan
