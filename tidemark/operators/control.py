"""Planning and control tables: signatures, incremental plans, upserts and leases as joins over snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def signature(files: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """key, signature: digest of the key's file records in sorted order."""
    record = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in fields])
    return files.groupBy(key).agg(F.sha2(F.concat_ws("\n", F.array_sort(F.collect_list(record))), 256).alias("signature"))


def plan(current: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of current without a finished run of the same keys (signature and configuration among them)."""
    return current.join(done.select(*keys).distinct(), keys, "left_anti")


def upsert(base: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """base with the rows of changes put in the place of rows of equal key, or added."""
    old = base.withColumn("_new", F.lit(0)).unionByName(changes.withColumn("_new", F.lit(1)))
    return old.groupBy(key).agg(F.max_by(F.struct(*base.columns), F.col("_new")).alias("_row")).select("_row.*")


def lease_state(events: DataFrame, key: str, at: str, kind: str, now, seconds: int) -> DataFrame:
    """key, state, last: done once an event says so, else busy while the last claim or heartbeat is younger than seconds,
    else expired; free without a claim."""
    held = F.col(kind).isin("claim", "heartbeat")
    s = events.groupBy(key).agg(F.max(F.when(F.col(kind) == "done", 1)).alias("_done"), F.max(F.when(held, F.col(at))).alias("last"))
    state = F.when(F.col("_done") == 1, "done").when(F.col("last").isNull(), "free").when(F.col("last") + seconds > now, "busy").otherwise("expired")
    return s.withColumn("state", state).drop("_done")
