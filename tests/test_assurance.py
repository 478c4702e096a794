"""Digests, guards, dealing of work, boundaries and sources against plain Python."""

import hashlib
import heapq
import json
import random
import uuid
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tidemark.functions import digests
from tidemark.operators import balance, guards
from tidemark.sources.shared import fresh_path

# ---- digests ----


def test_uuid5_and_fingerprints_equal_known_vectors(spark):
    names = ["", "a", "http://example.org/ü", "漢字", *map(str, range(60))]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = {r["n"]: (r["u"], r["s"]) for r in df.select("n", digests.uuid5(F.col("n")).alias("u"), digests.stable_uuid("p", "video", F.col("n")).alias("s")).collect()}
    assert got == {n: (str(uuid.uuid5(uuid.NAMESPACE_URL, n)), str(uuid.uuid5(uuid.NAMESPACE_URL, f"p:video:{n}"))) for n in names}

    contents = [b"", b"x", bytes(range(256)), b"ab" * 8, b"ab" * 8 + b"c", random.Random(1).randbytes(5000)]
    df = spark.createDataFrame([(c,) for c in contents], "c binary")
    for block in (16, 256, 1 << 20):
        plain = lambda c: hashlib.sha256(c[:block] + (c[-block:] if len(c) > block else b"") + str(len(c)).encode()).hexdigest()  # noqa: B023, E731
        assert {r["f"] for r in df.select(digests.fingerprint(F.col("c"), block).alias("f")).collect()} == {plain(c) for c in contents}


def test_canonical_json(spark):
    values = [{"b": 1, "a": {"d": [1, 2.50, True, None], "c": "ü\n\""}}, [], "x", 1.0, 1e300, {"": {"é": 0, "z": 0, "😀": 0, "￿": 0}}]
    texts = [json.dumps(v, indent=k, ensure_ascii=bool(k)) for v in values for k in (None, 2)]
    broken = [None, "", "{", "NaN", '{"a": Infinity}', "[1] 2"]
    df = spark.createDataFrame([(t,) for t in texts + broken], "t string")
    got = {r["t"]: r["c"] for r in df.select("t", digests.canonical_json(F.col("t")).alias("c")).collect()}
    for i, v in enumerate(values):
        one, other = got[texts[2 * i]], got[texts[2 * i + 1]]
        assert one == other and json.loads(one) == v and " " not in one.replace(json.dumps(" "), "")
    assert got[texts[0]].startswith('{"a":{"c":"ü\\n\\"","d":[1,2.5,true,null]},"b":1}') and all(got[t] is None for t in broken)


def test_multisets_know_repeats_but_no_order(spark):
    groups = {1: ["a", "b", "b"], 2: ["b", "a", "b"], 3: ["a", "b"], 4: ["a", "a", "b"], 5: ["a", "b", "b", None], 6: ["ab", "b", ""]}
    rows = [(k, r) for k, rs in groups.items() for r in rs]
    random.Random(2).shuffle(rows)
    got = {r["k"]: r["d"] for r in spark.createDataFrame(rows, "k int, r string").repartition(7).groupBy("k").agg(digests.multiset(F.col("r")).alias("d")).collect()}
    assert got[1] == got[2] == got[5] and len(set(got.values())) == 4


# ---- guards ----

PLAN = "k string, size long, print string"


def frames(spark):
    planned = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y"), ("c", 3, None), ("d", 4, "z"), (None, 5, "n")], PLAN)
    current = spark.createDataFrame([("a", 1, "x"), ("b", 7, "q"), ("c", 3, None), ("d", None, "z"), ("e", 5, "n")], PLAN)
    return planned, current


def test_drift_says_what_changed(spark):
    planned, current = frames(spark)
    got = {(r["k"], r["reason"]) for r in guards.drift(planned, current, "k", ["size", "print"]).collect()}
    assert got == {("b", "changed:size,print"), ("d", "changed:size"), ("e", "added"), (None, "missing")}
    assert guards.drift(current, current, "k", ["size", "print"]).collect() == []
    rows = spark.createDataFrame([("a",), ("b",), ("z",)], "k string")
    assert {tuple(r) for r in guards.flagged(rows, guards.drift(planned, current, "k", ["size", "print"]), "k").collect()} == {("a", None), ("b", "changed:size,print"), ("z", None)}


def test_a_stale_plan_writes_nothing(spark):
    import os

    planned, current = frames(spark)
    rows = spark.range(1000).repartition(8)
    path = fresh_path(spark, "guarded")
    with pytest.raises(Exception, match="the source has changed.*4 faults, the first b changed"):
        guards.guarded(rows, guards.drift(planned.na.drop(subset="k"), current, "k", ["size", "print"]).union(spark.createDataFrame([("x", "y")], "k string, reason string"))).write.parquet(path)
    assert not os.path.exists(path) or not [f for f in os.listdir(path) if not f.startswith(("_temporary", "."))]
    ok = guards.drift(current, current, "k", ["size"])
    guards.guarded(rows, ok, ok).write.parquet(path + "-ok")
    assert spark.read.parquet(path + "-ok").count() == 1000


def test_headers_of_plans(spark):
    header = lambda v, d: spark.createDataFrame([(v, d)], "plan_version string, dataset string")
    faults = lambda v, d: [r["reason"] for r in guards.header_faults(header(v, d), ["v1", "v2"], "set").collect()]
    assert faults("v2", "set") == [] and faults("v3", "set") == ["version"] and faults("v1", "other") == ["dataset"] and faults(None, None) == ["version", "dataset"]
    with pytest.raises(Exception, match="1 faults, the first other dataset"):
        guards.guarded(spark.range(3), guards.header_faults(header("v1", "other"), ["v1"], "set")).collect()


# ---- balance ----


@pytest.mark.parametrize("had", [None, "had"])
def test_assignment_is_the_greedy_one(spark, had):
    rng = random.Random(4)
    items = [(f"p{rng.randrange(6)}", i, rng.choice([None, 1.0, 2.5, float(rng.randrange(100))])) for i in range(400)]
    workers = [(f"p{p}", f"w{k}", rng.choice([0.5, 1.0, 3.0]), rng.choice([None, 0.0, 40.0])) for p in range(5) for k in range(rng.randrange(1, 5))] + [("empty", "w0", 1.0, 0.0)]
    want = {}
    for pool in {p for p, _, _ in items}:
        loads = {w: (h or 0.0) if had else 0.0 for p, w, _, h in workers if p == pool}
        weights = {w: x for p, w, x, _ in workers if p == pool}
        for _, i, load in sorted((r for r in items if r[0] == pool), key=lambda r: (-(r[2] or 0.0), r[1])):
            if not loads:
                want[i] = (pool, None, None)
                continue
            w = min(loads, key=lambda w: (loads[w] / weights[w], w))
            loads[w] += load or 0.0
            want[i] = (pool, w, loads[w])
    df = spark.createDataFrame(items, "pool string, item long, seconds double").repartition(5)
    who = spark.createDataFrame(workers, "pool string, worker string, weight double, had double")
    got = balance.assign(df, who, "pool", "item", "seconds", had=had).collect()
    assert {r["item"]: (r["pool"], r["worker"], r["total"]) for r in got} == want and len(got) == len(items)
    assert balance.assign(df.limit(0), who, "pool", "item", "seconds").collect() == []


def test_longest_first_beats_dealing_in_turn(spark):
    loads = [float(x) for x in (9, 8, 7, 6, 5, 4, 3, 2, 1, 1, 1, 1)]
    items = spark.createDataFrame([(0, i, x) for i, x in enumerate(loads)], "pool int, item int, load double")
    who = spark.createDataFrame([(0, k, 1.0) for k in range(3)], "pool int, worker int, weight double")
    sums = defaultdict(float)
    for r in balance.assign(items, who, "pool", "item", "load").collect():
        sums[r["worker"]] += loads[r["item"]]
    heap = [(0.0, k) for k in range(3)]
    for x in loads:
        total, k = heapq.heappop(heap)
        heapq.heappush(heap, (total + x, k))
    assert dict(sums) == {k: s for s, k in heap} == {0: 16.0, 1: 16.0, 2: 16.0}


def test_guarded_plan_deals_by_the_session_s_partitions(spark):
    """No fixed number of tasks holds the table (F4)."""
    import re

    from tidemark import catalog

    plan = catalog.queries()["guarded_plan"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    dealt = re.findall(r"hashpartitioning\(l_partkey#\d+L?, (\d+)\)", plan)
    assert dealt and set(dealt) == {spark.conf.get("spark.sql.shuffle.partitions")}
