"""The folder that all executors and the driver share, and tables in it."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir. Where that is unset, a session on one machine gets a folder of its own; on a cluster, where no
    machine's temporary folder is shared, it is an error."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="tidemark-")
        spark.conf.set("spark.checkpoint.dir", path)
        spark.sparkContext.setCheckpointDir(path)
    return path.rstrip("/")


def fresh_path(spark: SparkSession, kind: str) -> str:
    return f"{shared_dir(spark)}/tidemark/{kind}-{uuid.uuid4().hex}"


def cut(df: DataFrame, kind: str = "table") -> DataFrame:
    """Write df as a table in the shared folder and read it back: short lineage that survives lost executors, and rows (with
    their partition numbers) that stay the same however often they are read."""
    path = fresh_path(df.sparkSession, kind)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
