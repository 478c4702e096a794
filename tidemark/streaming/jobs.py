"""The rules as streams: the same functions on readStream, run to the end of what is there (availableNow) or for ever.

State and output live in the shared folder, so a job resumes from its checkpoint after executors or the driver are lost.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..sources.shared import fresh_path


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Files called name in folder as a stream, with the schema of what is there."""
    schema = spark.read.parquet(f"{folder}/{name}").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", name).option("maxFilesPerTrigger", 64).parquet(folder)


def run(df: DataFrame, mode: str = "append", sink: Callable | None = None) -> DataFrame:
    """Run the stream over all available input, and return what it wrote.

    mode complete: each batch replaces the table. append: each batch adds a file, once (the sink's log makes it exactly once).
    sink: foreachBatch function (batch, id, path) for anything else.
    """
    spark = df.sparkSession
    path, checkpoint = fresh_path(spark, "stream"), fresh_path(spark, "offsets")
    writer = df.writeStream.trigger(availableNow=True).option("checkpointLocation", checkpoint)
    if sink is not None:
        writer = writer.outputMode("update").foreachBatch(lambda batch, k: sink(batch, k, path))
    elif mode == "complete":
        writer = writer.outputMode("complete").foreachBatch(lambda batch, k: batch.write.mode("overwrite").parquet(path))
    else:
        writer = writer.outputMode("append").format("parquet").option("path", path)
    query = writer.start()
    query.awaitTermination()
    return spark.read.parquet(path)


def tumbling(events: DataFrame, at: str, size: str, keys: list[str], late: str) -> DataFrame:
    """Counts and sums in fixed windows; events later than `late` are dropped by the watermark in append mode."""
    w = events.withWatermark(at, late).groupBy(F.window(at, size).alias("w"), *keys)
    return w.agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("start"), *keys, "n", "total")


def sessions(events: DataFrame, at: str, gap: str, key: str, late: str) -> DataFrame:
    s = events.withWatermark(at, late).groupBy(F.session_window(at, gap).alias("s"), key)
    return s.agg(F.count(F.lit(1)).alias("n")).select(key, F.col("s.start").alias("start"), F.col("s.end").alias("end"), "n")


def ordered_fold(events: DataFrame, key: str, at: str) -> DataFrame:
    """key, n, late, last for each key and batch: events that come before one already seen are counted as late."""

    def step(k: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        n, late, last = state.get if state.exists else (0, 0, -(2**62))
        for frame in frames:
            for us in frame["us"].tolist():
                n += 1
                late += us < last
                last = max(last, us)
        state.update((n, late, last))
        yield pd.DataFrame({key: [k[0]], "n": [n], "late": [late], "last": [last]})

    kind = dict(events.dtypes)[key]
    rows = events.select(key, F.unix_micros(F.col(at).cast("timestamp")).alias("us"))
    return rows.groupBy(key).applyInPandasWithState(step, f"{key} {kind}, n long, late long, last long", "n long, late long, last long", "update", GroupStateTimeout.NoTimeout)
