"""Guards of plans against sources that have changed since: as rows that say what changed, or as part of the plan that stops it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def drift(planned: DataFrame, current: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """key, reason: what isn't as planned. "missing" now, "added" since, or "changed:" with the fields that differ.

    One full outer join on the key; rows in agreement give nothing.
    """
    both = planned.select(key, F.struct(*fields).alias("_p")).join(current.select(key, F.struct(*fields).alias("_c")), key, "full_outer")
    changed = F.filter(F.array(*[F.when(~F.col(f"_p.{f}").eqNullSafe(F.col(f"_c.{f}")), F.lit(f)) for f in fields]), lambda x: x.isNotNull())
    reason = F.when(F.col("_c").isNull(), "missing").when(F.col("_p").isNull(), "added").when(F.size(changed) > 0, F.concat(F.lit("changed:"), F.array_join(changed, ",")))
    return both.select(key, reason.alias("reason")).filter(F.col("reason").isNotNull())


def header_faults(header: DataFrame, versions: list[str], dataset: str, version: str = "plan_version", source: str = "dataset") -> DataFrame:
    """key, reason of plans of another version ("version") or another dataset ("dataset"); a null is another one."""
    faults = F.array(F.when(~F.coalesce(F.col(version).isin(versions), F.lit(False)), F.lit("version")), F.when(~F.col(source).eqNullSafe(F.lit(dataset)), F.lit("dataset")))
    named = header.select(F.col(source).cast("string").alias("key"), F.explode(F.filter(faults, lambda x: x.isNotNull())).alias("reason"))
    return named


def flagged(rows: DataFrame, faults: DataFrame, key: str, out: str = "stale") -> DataFrame:
    """rows with the reason of their key's fault, or null: for jobs that go on without the faulty part."""
    return rows.join(faults.select(key, F.col("reason").alias(out)), key, "left")


def _check(faults: DataFrame, message: str) -> Column:
    """One boolean row of faults' count: true, or an error with the count and an example."""
    key, reason = faults.columns[:2]
    said = F.concat(F.lit(f"{message}: "), F.col("n").cast("string"), F.lit(" faults, the first "), F.col("first"))
    one = faults.agg(F.count(F.lit(1)).alias("n"), F.min(F.concat_ws(" ", F.coalesce(F.col(key).cast("string"), F.lit("null")), reason)).alias("first"))
    return one.select(F.when(F.col("n") == 0, F.lit(True)).otherwise(F.raise_error(said).cast("boolean")).alias("_ok"))


def guarded(rows: DataFrame, *faults: DataFrame, message: str = "the source has changed since the plan was made") -> DataFrame:
    """rows, which can only be computed when there are no faults: the check is a table of one row that every task needs, so a
    write fails before any task has written, and nothing is committed."""
    return reduce(lambda df, f: df.join(F.broadcast(_check(f, message)), F.col("_ok")).drop("_ok"), faults, rows)
