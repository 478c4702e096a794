"""Provisional and final results: late rows, closing periods, a job stopped between batches and resumed."""

import datetime as dt
import random
import time
from collections import defaultdict

import pytest

from tidemark.sources.shared import fresh_path
from tidemark.streaming import results

UTC = dt.timezone.utc
DAY = 86_400
SCHEMA = "e string, at timestamp, id long, value double, is_final boolean, arrival int"


def rows(seed, n=300, files=6):
    """Rows of 12 days over six files; one in ten comes a file late, and one row of the first day comes with the last file."""
    rng = random.Random(seed)
    found = []
    for i in range(n):
        at = rng.randrange(12 * DAY)
        found.append([f"e{rng.randrange(5)}", dt.datetime.fromtimestamp(at, UTC), i, float(rng.randrange(100)), rng.random() < 0.1, min(files - 1, at // (2 * DAY) + (rng.random() < 0.1))])
    found += [["e0", dt.datetime.fromtimestamp(12 * DAY - 1, UTC), n, 1.0, False, files - 1], ["e1", dt.datetime.fromtimestamp(5, UTC), n + 1, 1000.0, True, files - 1]]
    return found


def plain(data, late_days):
    """The last row is beyond the watermark; all others count."""
    mark = max(r[1].timestamp() for r in data) - late_days * DAY
    groups = defaultdict(list)
    for e, at, i, value, is_final, _ in data[:-1]:
        groups[e, int(at.timestamp()) // DAY * DAY].append((at, i, value, is_final))
    want = {}
    for (e, start), own in groups.items():
        final = max((r for r in own if r[3]), default=None)
        want[e, start] = (len(own), final[2] if final else sum(r[2] for r in own), "final" if final else "closed" if start + DAY <= mark else "provisional")
    return want


def seen(spark, path):
    return {(r["e"], r["start"]): (r["n"], r["value"], r["status"]) for r in results.last_versions(spark.read.parquet(path), "e").collect()}


@pytest.mark.parametrize("stop", [False, True])
def test_final_results_replace_provisional_ones(spark, stop):
    data = rows(3)
    df = spark.createDataFrame(data, SCHEMA)
    source, path, checkpoint = fresh_path(spark, "in"), fresh_path(spark, "log"), fresh_path(spark, "offsets")
    results.arrivals(df, source, "arrival")
    log = lambda: results.versions(results.files(spark, source, df.drop("arrival").schema), "e", "at", "3 days", DAY)
    query = results.start(log(), path, checkpoint)
    if stop:
        while query.isActive and (query.lastProgress is None or query.lastProgress["batchId"] < 1):
            time.sleep(0.05)
        query.stop()
        done = query.lastProgress["batchId"]
        assert done < 5 and len(seen(spark, path)) < len(plain(data, 3))  # results of the first files can be read meanwhile
        query = results.start(log(), path, checkpoint)
    query.awaitTermination()
    assert query.lastProgress["batchId"] >= 5 and seen(spark, path) == plain(data, 3)
    whole = spark.read.parquet(path)
    assert whole.groupBy("e", "start", "version").count().filter("count > 1").count() == 0  # nothing is written twice
    assert whole.filter("status = 'provisional'").count() > len(plain(data, 3)) / 2
    before = whole.count()
    results.start(log(), path, checkpoint).awaitTermination()  # nothing new
    assert spark.read.parquet(path).count() == before


def test_versions_are_kept_without_python(spark):
    """A key costs no call to a Python worker (F3), and each closed result is written once, with its last value."""
    data = rows(4)
    df = spark.createDataFrame(data, SCHEMA)
    source, path = fresh_path(spark, "in"), fresh_path(spark, "log")
    results.arrivals(df, source, "arrival")
    log = results.versions(results.files(spark, source, df.drop("arrival").schema), "e", "at", "3 days", DAY)
    plan = log._jdf.queryExecution().analyzed().toString()
    assert "Python" not in plan and "TransformWithState" not in plan
    results.start(log, path, fresh_path(spark, "offsets")).awaitTermination()
    closed = spark.read.parquet(path).filter("version % 2 = 0").collect()
    mark = max(r[1].timestamp() for r in data) - 3 * DAY
    want = {k: v for k, v in plain(data, 3).items() if k[1] + DAY <= mark}
    assert len(closed) == len(want) and {(r["e"], r["start"]): (r["n"], r["value"], r["status"]) for r in closed} == want
