"""The line between raw data and what is derived from it: paths are resolved before they are compared, and writers refuse raw roots."""

from __future__ import annotations

import os
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import ranking
from .shared import fresh_path


def resolved(spark: SparkSession, path: str) -> str:
    """The path with scheme and authority, without "." and "..", and with links followed as far as the path exists.

    The file system of the path does the work, so /x/../raw, file:/raw and a mount of another store come out alike.
    """
    jvm = spark._jvm
    there = jvm.org.apache.hadoop.fs.Path(path)
    files = there.getFileSystem(spark._jsc.hadoopConfiguration())
    there, rest = files.makeQualified(there), []
    while not files.exists(there) and there.getParent() is not None:
        rest.append(there.getName())
        there = there.getParent()
    if files.exists(there):
        there = files.resolvePath(there)
    uri = there.toUri().toString()
    if urlparse(uri).scheme == "file":  # the local file system follows links of the last name only
        uri = "file:" + os.path.realpath(urlparse(uri).path)
    return "/".join([uri.rstrip("/"), *reversed(rest)])


def _identity(uri: str) -> tuple[int, int] | None:
    parts = urlparse(uri)
    if parts.scheme == "file" and os.path.exists(parts.path or "/"):
        stat = os.stat(parts.path or "/")
        return stat.st_dev, stat.st_ino
    return None


def inside(path: str, root: str) -> bool:
    """Whether a resolved path is the resolved root or lies in it; local folders are also told by their identity on the disk."""
    if path.rstrip("/") == root.rstrip("/") or path.startswith(root.rstrip("/") + "/"):
        return True
    own, at = _identity(root), urlparse(path).path
    while own and at not in ("", "/"):
        if _identity("file:" + at) == own:
            return True
        at = os.path.dirname(at)
    return False


def shadows(path: str, aliases: list[tuple[str, ...]]) -> list[str]:
    """The path under all names that its mount has: aliases are groups of roots that show the same tree."""
    names = [path]
    for group in aliases:
        for root in group:
            if path == root or path.startswith(root.rstrip("/") + "/"):
                names += [other.rstrip("/") + path[len(root.rstrip("/")) :] for other in group if other != root]
    return names


def derived_path(spark: SparkSession, path: str, protected: list[str], aliases: list[tuple[str, ...]] = ()) -> str:
    """The resolved path, or an error if it lies in a protected root under any of its names."""
    out = resolved(spark, path)
    groups = [tuple(resolved(spark, r) for r in g) for g in aliases]
    for root in [r for p in protected for r in shadows(resolved(spark, p), groups)]:
        if any(inside(name, root) for name in shadows(out, groups)):
            raise ValueError(f"{path} is in the protected root {root}")
    return out


def source_boundary(spark: SparkSession, source: str, output: str, mounts: list[str] = ()) -> str:
    """The resolved output, or an error if it lies in the source, or if both lie in the same raw mount."""
    inner, out = resolved(spark, source), resolved(spark, output)
    if inside(out, inner):
        raise ValueError(f"{output} is in its own source {source}")
    for mount in (resolved(spark, m) for m in mounts):
        if inside(inner, mount) and inside(out, mount):
            raise ValueError(f"{output} is in the raw mount {mount} of its source")
    return out


def write_derived(df: DataFrame, path: str, protected: list[str], aliases: list[tuple[str, ...]] = (), **options) -> None:
    """Write Parquet (zstd) to the resolved path unless it lies in a protected root."""
    out = derived_path(df.sparkSession, path, protected, aliases)
    df.write.mode("overwrite").option("compression", "zstd").options(**options).parquet(out)


# ---- inventories ----

INVENTORY = "dataset string, partition string, task string, item string, path string, length long, modified timestamp"


def listed(spark: SparkSession, dataset: str, pattern: str = "*") -> DataFrame:
    """dataset, partition, task, item, path, length, modified of files <dataset>/<partition>/<task>/<item>. Spark lists folders in
    parallel jobs once there are many; no file is opened, as only columns of the listing are read.
    Empty files are not listed, as Spark's reader skips them."""
    root = resolved(spark, dataset)
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(root)
    inner = F.substring_index("path", root.split(":", 1)[-1].rstrip("/") + "/", -1)
    parts = F.split(inner, "/")
    rows = files.select(F.lit(root).alias("dataset"), parts[0].alias("partition"), F.get(parts, F.lit(1)).alias("task"), F.regexp_replace(inner, r"\.[^./]*$", "").alias("item"), "path", "length", F.col("modificationTime").alias("modified"), F.size(parts).alias("_n"))
    return rows.filter("_n = 3").drop("_n")


def inventory(spark: SparkSession, dataset: str, pattern: str = "*", cache: str | None = None, refresh: bool = False) -> DataFrame:
    """The listing, kept as JSON lines in cache: read from there if it is there, and refused if it is another dataset's."""
    if cache is None:
        return listed(spark, dataset, pattern)
    there = spark._jvm.org.apache.hadoop.fs.Path(cache)
    if refresh or not there.getFileSystem(spark._jsc.hadoopConfiguration()).exists(there):
        listed(spark, dataset, pattern).write.mode("overwrite").json(cache)
    rows, root = spark.read.schema(INVENTORY).json(cache), resolved(spark, dataset)
    others = [r["dataset"] for r in rows.filter(~F.col("dataset").eqNullSafe(root)).select("dataset").distinct().limit(3).collect()]
    if others:
        raise ValueError(f"the inventory at {cache} is of {others}, not of {root}")
    return rows


def balanced_pick(rows: DataFrame, each: int, seed: int, partitions: list[str] | None = None) -> DataFrame:
    """Of each partition and task the `each` items of least rank, a digest of seed and item."""
    from ..functions import hashing

    kept = rows.filter(F.col("partition").isin(partitions)) if partitions is not None else rows
    return ranking.top_k(kept, ["partition", "task"], each, hashing.rank(F.col("item"), seed), "item")


def as_files(df: DataFrame, partition: str, task: str) -> str:
    """df as a file a (partition, task) in a fresh folder: a dataset to list."""
    path = fresh_path(df.sparkSession, "dataset")
    keys = [F.col(partition).alias("_partition"), F.col(task).alias("_task")]
    df.select("*", *keys).repartition("_partition", "_task").write.partitionBy("_partition", "_task").parquet(path)
    return path
