"""Rules as Issue rows, tiers and decisions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import ladders


def issues(measured: DataFrame, key: str, rules: list[tuple[str, Column, Column | str]]) -> DataFrame:
    """key, code, severity: a row for each rule whose condition holds. One pass: rules become an array that is exploded."""
    found = F.array_compact(F.array(*[F.when(c, F.struct(F.lit(code).alias("code"), (s if isinstance(s, Column) else F.lit(s)).alias("severity"))) for code, c, s in rules]))
    return measured.select(key, F.explode(found).alias("_i")).select(key, "_i.code", "_i.severity")


def decide(entities: DataFrame, found: DataFrame, key: str, motion: list[str], policy: str = "review") -> DataFrame:
    """key, codes, tier, decision for every entity, with or without issues."""
    per = found.groupBy(key).agg(F.array_sort(F.collect_set("code")).alias("codes"), F.collect_set("severity").alias("_s"), F.collect_set(F.when(F.col("severity") == "error", F.col("code"))).alias("_e"))
    none = F.array().cast("array<string>")
    full = entities.select(key).distinct().join(per, key, "left").withColumn("codes", F.coalesce("codes", none)).withColumn("_s", F.coalesce("_s", none)).withColumn("_e", F.coalesce("_e", none))
    any_of = lambda names, c="codes": F.arrays_overlap(F.col(c), F.array(*map(F.lit, names)))
    chosen = ladders.decision(any_of(ladders.OPERATIONAL), any_of(ladders.HARD), F.size("_e") > 0, any_of(motion), policy)
    return full.select(key, "codes", ladders.tier(F.col("codes"), F.col("_s")).alias("tier"), chosen.alias("decision"))


def conformance(df: DataFrame, name: str, declared: dict[str, str]) -> DataFrame:
    """table, column, declared, actual, status of each declared or present column; from schemas, no data is read."""
    have = dict(df.dtypes)
    rows = [(name, c, declared.get(c), have.get(c), "missing" if c not in have else "undeclared" if c not in declared else "ok" if declared[c] == have[c] else "mismatch") for c in sorted({*have, *declared})]
    return df.sparkSession.createDataFrame(rows, "table string, column string, declared string, actual string, status string")


def value_conformance(df: DataFrame, declared: dict[str, str], widths: dict[str, int] | None = None) -> DataFrame:
    """column, declared, nulls, unfit: rows of each declared column that are null, and that don't fit its type without loss
    (or, of an array column in widths, have another length). Both are null for a column that isn't there. One scan, one
    aggregation."""
    widths = widths or {}
    sums, rows = [], []
    for k, (name, kind) in enumerate(declared.items()):
        if name not in df.columns:
            rows.append(F.struct(F.lit(name).alias("column"), F.lit(kind).alias("declared"), F.lit(None).cast("bigint").alias("nulls"), F.lit(None).cast("bigint").alias("unfit")))
            continue
        c = F.col(name)
        have = df.schema[name].dataType.simpleString()
        lossless = F.lit(True) if have == kind or kind == "string" else F.coalesce(c.try_cast(kind).try_cast(have).eqNullSafe(c), F.lit(False))
        fits = lossless & (F.size(c) == widths[name]) if name in widths else lossless
        sums += [F.count_if(c.isNull()).alias(f"n{k}"), F.count_if(c.isNotNull() & ~fits).alias(f"u{k}")]
        rows.append(F.struct(F.lit(name).alias("column"), F.lit(kind).alias("declared"), F.col(f"n{k}").alias("nulls"), F.col(f"u{k}").alias("unfit")))
    counted = df.agg(*sums) if sums else df.sparkSession.range(1)
    return counted.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
