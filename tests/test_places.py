"""Boundaries, inventories, archives and relational sources."""

import io
import os
import tarfile

import pytest
from pyspark.sql import functions as F

from tidemark.sources import archives, boundary, relational

# ---- the raw boundary ----


@pytest.fixture
def tree(tmp_path):
    for d in ("raw/a", "work", "data/oss", "shadow/oss"):
        (tmp_path / d).mkdir(parents=True)
    (tmp_path / "alias").symlink_to(tmp_path / "raw", target_is_directory=True)
    return tmp_path


def test_raw_roots_are_refused_under_every_name(spark, tree):
    raw = str(tree / "raw")
    for path in (f"{raw}/x", raw, f"{raw}/", f"{tree}/work/../raw/y", f"file:{raw}/y", f"file://{raw}/a/b/c", f"{tree}/alias/new", f"{tree}/alias", f"{tree}/./raw//z"):
        with pytest.raises(ValueError, match="protected root"):
            boundary.derived_path(spark, path, [raw])
        with pytest.raises(ValueError, match="protected root"):
            boundary.derived_path(spark, path, [f"{tree}/alias"])
    for path in (f"{tree}/work/x", f"{raw}2/x", f"{tree}/raw/../work"):
        assert boundary.derived_path(spark, path, [raw]).startswith("file:/")
    with pytest.raises(ValueError, match="protected root"):
        boundary.write_derived(spark.range(3), f"{tree}/work/../alias/out", [raw])
    assert os.listdir(tree / "raw") == ["a"]
    boundary.write_derived(spark.range(3), f"{tree}/raw/../work/out", [raw])
    assert spark.read.parquet(f"{tree}/work/out").count() == 3


def test_mount_aliases(spark, tree):
    raw, group = f"{tree}/data/oss", (f"{tree}/data", f"{tree}/shadow")
    boundary.derived_path(spark, f"{tree}/shadow/oss/x", [raw])
    with pytest.raises(ValueError, match="protected root"):
        boundary.derived_path(spark, f"{tree}/shadow/oss/x", [raw], [group])
    assert boundary.derived_path(spark, f"{tree}/shadow/other", [raw], [group])


def test_output_stays_out_of_its_source(spark, tree):
    with pytest.raises(ValueError, match="its own source"):
        boundary.source_boundary(spark, f"{tree}/raw", f"{tree}/alias/a/out")
    with pytest.raises(ValueError, match="raw mount"):
        boundary.source_boundary(spark, f"{tree}/data/oss", f"{tree}/data/out", [f"{tree}/data"])
    assert boundary.source_boundary(spark, f"{tree}/data/oss", f"{tree}/work/out", [f"{tree}/data"]).endswith("/work/out")


# ---- inventories ----


def test_inventory(spark, tmp_path):
    for p in ("train/t1/a.h5", "train/t1/b.h5", "train/t1/c.mp4", "train/t2/d.x.h5", "test/t1/e.h5", "test/top.h5", "train/t2/deep/f.h5"):
        (tmp_path / "set" / p).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "set" / p).write_bytes(b"x" * len(p))
    root, cache = str(tmp_path / "set"), str(tmp_path / "cache")
    rows = boundary.inventory(spark, root, "*.h5", cache)
    assert {(r["partition"], r["task"], r["item"], r["length"]) for r in rows.collect()} == {("train", "t1", "train/t1/a", 13), ("train", "t1", "train/t1/b", 13), ("train", "t2", "train/t2/d.x", 15), ("test", "t1", "test/t1/e", 12)}
    (tmp_path / "set" / "train/t1/new.h5").write_bytes(b"new")
    assert boundary.inventory(spark, root, "*.h5", cache).count() == 4 and boundary.inventory(spark, root, "*.h5", cache, refresh=True).count() == 5
    (tmp_path / "other").mkdir()
    with pytest.raises(ValueError, match="is of"):
        boundary.inventory(spark, str(tmp_path / "other"), "*.h5", cache)
    picks = [{r["item"] for r in boundary.balanced_pick(boundary.inventory(spark, root, "*.h5", cache), 2, 17, ["train"]).collect()} for _ in range(2)]
    assert picks[0] == picks[1] and len(picks[0]) == 3


# ---- archives ----


def tar(path, files, form=tarfile.PAX_FORMAT):
    with tarfile.open(path, "w", format=form) as t:
        for name, data in files:
            info = tarfile.TarInfo(name)
            info.size = len(data)
            t.addfile(info, io.BytesIO(data))


def test_members_without_payloads(spark, tmp_path):
    long, umlaut = "d/" * 80 + "x.mp4", "ü/é.mp4"
    tar(tmp_path / "a.tar", [("v1.mp4", b"1" * 700), (long, b"22"), (umlaut, b"")])
    tar(tmp_path / "b.tar", [("in/v1.mp4", b"9" * 10), ("v2.mp4", b"3" * 512)], tarfile.GNU_FORMAT)
    (tmp_path / "c.tar").write_bytes(b"no archive")
    (tmp_path / "d.tar").write_bytes((tmp_path / "a.tar").read_bytes()[:900])
    df = archives.tar_members(spark, str(tmp_path))
    rows = {(os.path.basename(r["archive"]), r["member"]): r for r in df.collect()}
    assert set(rows) >= {("a.tar", "v1.mp4"), ("a.tar", long), ("a.tar", umlaut), ("b.tar", "in/v1.mp4"), ("b.tar", "v2.mp4")} and not [k for k in rows if k[0] == "c.tar"]
    for (name, member), data in {("a.tar", "v1.mp4"): b"1" * 700, ("a.tar", long): b"22", ("b.tar", "v2.mp4"): b"3" * 512}.items():
        r = rows[name, member]
        assert (tmp_path / name).read_bytes()[r["offset"] : r["offset"] + r["size"]] == data and r["basename"] == os.path.basename(member)
    one = df.filter("basename = 'v1.mp4'")
    assert {r["member"] for r in one.collect()} == {"v1.mp4", "in/v1.mp4"}
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "basename" not in plan.split("BatchScan")[0].replace("basename#", "")  # no filter above the scan but that names aren't null
    wanted = spark.createDataFrame([(1, "v1.mp4"), (2, "v2.mp4"), (3, "none"), (4, None)], "i int, expected string")
    assert {r["i"]: r["member"] for r in archives.located(wanted, df).collect()} == {1: "v1.mp4", 2: "v2.mp4", 3: None, 4: None}


def test_headers_alone_are_read(tmp_path):
    class Counted(io.FileIO):
        taken = 0

        def read(self, n=-1):
            data = super().read(n)
            Counted.taken += len(data)
            return data

    tar(tmp_path / "big.tar", [(f"m{i}", b"x" * 2_000_000) for i in range(5)])
    with Counted(tmp_path / "big.tar") as f:
        assert [(n, s) for n, s, _ in archives.members(f)] == [(f"m{i}", 2_000_000) for i in range(5)]
    assert Counted.taken < 20_000


def test_archives_round_trip(spark, tmp_path):
    rows = [(f"n{i}", "ü" * i if i else None) for i in range(40)]
    archives.write_tars(spark.createDataFrame(rows, "name string, text string").repartition(5), str(tmp_path / "out"), "name", "text", 6)
    found = archives.tar_members(spark, str(tmp_path / "out")).collect()
    assert {(r["member"], r["size"]) for r in found} == {(n, 2 * len(t or "")) for n, t in rows} and len({r["archive"] for r in found}) == 6


# ---- relational ----


def test_relational_reads(spark, tmp_path):
    url = f"jdbc:derby:{tmp_path}/registry;create=true"
    runs = spark.createDataFrame([(i, f"d{i % 7}", i * 10, "failed" if i % 5 == 0 else "done") for i in range(1, 2001)], "run_id int, dataset string, finished_at long, state string")
    runs.coalesce(1).write.format("jdbc").option("url", url).option("dbtable", "runs").option("createTableColumnTypes", "dataset VARCHAR(64), state VARCHAR(16)").save()
    read = relational.read_table(spark, url, "runs", "run_id", rows_a_partition=300)
    assert read.rdd.getNumPartitions() == 7 and sorted(map(tuple, read.collect())) == sorted(map(tuple, runs.collect()))
    per = [r["n"] for r in read.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    assert max(per) < 2 * min(per)
    key = lambda df: sorted(map(tuple, relational.run_status(df).collect()))
    assert key(read) == key(runs)
    plan = read.filter("dataset = 'd3' AND finished_at > 500").select("run_id")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(dataset,d3)" in plan and "GreaterThan(finished_at,500)" in plan and "ReadSchema: struct<run_id:int>" in plan
    assert relational.read_table(spark, url, "runs").rdd.getNumPartitions() == 1
    runs.limit(0).write.format("jdbc").option("url", url).option("dbtable", "no_runs").option("createTableColumnTypes", "dataset VARCHAR(64), state VARCHAR(16)").save()
    assert relational.read_table(spark, url, "no_runs", "run_id").count() == 0
