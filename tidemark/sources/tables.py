"""Readers and writers: projected Parquet scans, strict JSON lines, frames of the event table, guarded outputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .boundary import write_derived  # noqa: F401  (with the other writers)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def projected(spark: SparkSession, path: str, required: list[str]) -> tuple[DataFrame, list[str]]:
    """(required columns that are there, names of those that are not)."""
    df = spark.read.parquet(path)
    return df.select(*[c for c in required if c in df.columns]), [c for c in required if c not in df.columns]


def json_lines(spark: SparkSession, path: str, schema: StructType | str, strict: bool = True) -> DataFrame:
    """JSON lines with a declared schema; strict stops at a broken line, else broken lines come as _corrupt_record."""
    return spark.read.schema(schema).option("mode", "FAILFAST" if strict else "PERMISSIVE").json(path)


def micros(ts):
    """Microseconds since 1970 of a TIMESTAMP_NTZ, without time zones."""
    seconds = F.unix_date(ts.cast("date")).cast("bigint") * 86400 + F.hour(ts).cast("bigint") * 3600 + F.minute(ts).cast("bigint") * 60
    return seconds * 1000000 + (F.extract(F.lit("SECOND"), ts) * 1000000).cast("bigint")


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """episode, frame, t (seconds), us, value, event_id, event_type, props, valid (no error), seen (view or click)."""
    e = table(spark, sf_dir, "events")
    w = W.partitionBy("user_id").orderBy("ts", "event_id")
    us = micros(F.col("ts"))
    return e.select(
        F.col("user_id").alias("episode"), (F.row_number().over(w) - 1).cast("bigint").alias("frame"), us.alias("us"), (us / 1e6).alias("t"), "value", "event_id", "event_type", "props",
        (F.col("event_type") != "error").alias("valid"), F.col("event_type").isin("view", "click").alias("seen"),
    )


def write_partitioned(df: DataFrame, path: str, by: str) -> None:
    """One folder a value of by, as for manifests of decisions."""
    df.write.mode("overwrite").partitionBy(by).json(path)
