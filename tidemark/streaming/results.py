"""Provisional results that final ones replace: a keyed state with an event-time end, written as an append-only log.

Rows of a key (an entity and a period) come as they are found, some of them late, some final. Each batch appends a new
version of the results it changed; readers take the last version of a key. When the watermark passes the end of the period,
the result is closed and its state goes, so state holds open periods alone; rows later than that are dropped. The state is
that of a streaming aggregation in update mode, so no row or key passes through Python. What it drops it doesn't report:
closed results are the last versions in the log of the periods that end with the batch, which are read that once. The state,
the offsets and the log live in folders that a restarted job finds again: it goes on after the last finished batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def versions(rows: DataFrame, entity: str, at: str, late: str, period_s: int) -> DataFrame:
    """What start() writes as the log: entity, start (of the period, seconds), n, value, status, version. rows: entity, at, id,
    value, is_final.

    value is the total of the rows, or the value of the final row with the greatest time and id. Here status knows no closed
    ones, and instead of the version come end (of the period, seconds) and mark, the watermark that the rows ask for.
    """
    final = F.when(F.coalesce("is_final", F.lit(False)), F.struct(F.unix_micros(at).alias("us"), "id", F.coalesce("value", F.lit(0.0)).alias("value")))
    kept = rows.withWatermark(at, late).groupBy(F.window(at, f"{period_s} seconds").alias("w"), entity)
    kept = kept.agg(F.count(F.lit(1)).alias("n"), F.sum(F.coalesce("value", F.lit(0.0))).alias("total"), F.max(final).alias("final"), F.max(at).alias("last"))
    second = lambda c: F.unix_seconds(F.col(c))
    status = F.when(F.col("final").isNull(), "provisional").otherwise("final")
    return kept.select(entity, second("w.start").alias("start"), "n", F.coalesce("final.value", "total").alias("value"), status.alias("status"), second("w.end").alias("end"), (F.col("last") - F.expr(f"INTERVAL {late}")).alias("mark"))


def last_versions(log: DataFrame, entity: str) -> DataFrame:
    """What readers see: the last version of each key."""
    return log.groupBy(entity, "start").agg(F.max_by(F.struct("n", "value", "status"), "version").alias("_last")).select(entity, "start", "_last.*")


def _append(batch: DataFrame, k: int, path: str) -> None:
    """The versions of batch k, below batch=k: kind=new has what the batch changed, kind=closed the results that end with it. A
    batch that runs again replaces what it wrote. The folders below are those of the periods' ends, so that closing a period
    reads that period alone. _marks has the watermark after each batch, by which the next one closes.
    """
    spark, entity, own = batch.sparkSession, batch.columns[0], f"{path}/batch={k}/kind=new"
    batch.withColumn("version", F.lit(2 * k + 1).cast("long")).write.mode("overwrite").partitionBy("end").parquet(own)
    mark = lambda b: spark.read.parquet(f"{path}/_marks/batch={b}").first()["us"] if b >= 0 else None
    now, before = mark(k - 1), mark(k - 2)
    fields = batch.withColumn("version", F.lit(0).cast("long")).schema
    log = spark.read.schema(fields).option("basePath", path).parquet(f"{path}/batch=*/kind=new")
    after = log.filter(F.col("batch") == k).agg(F.greatest(F.max(F.unix_micros("mark")), F.lit(now).cast("long")).alias("us"))
    if now is not None and now != before:
        due = log.filter((F.col("end") <= now // 1_000_000) & (F.lit(before is None) | (F.col("end") > (before or 0) // 1_000_000)) & (F.col("batch") <= k))
        last = due.groupBy(entity, "start", "end").agg(F.max_by(F.struct("n", "value", "status", "mark"), "version").alias("_last"))
        status = F.when(F.col("_last.status") == "final", "final").otherwise("closed").alias("status")
        closed = last.select(entity, "start", "_last.n", "_last.value", status, "end", "_last.mark", F.lit(2 * k + 2).cast("long").alias("version"))
        closed.write.mode("overwrite").partitionBy("end").parquet(f"{path}/batch={k}/kind=closed")
    after.coalesce(1).write.mode("overwrite").parquet(f"{path}/_marks/batch={k}")


def start(log: DataFrame, path: str, checkpoint: str):
    """Append the versions to path, resuming from checkpoint if that has been used before."""
    spark = log.sparkSession
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass", None)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    try:
        return log.writeStream.trigger(availableNow=True).outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(lambda batch, k: _append(batch, k, path)).start()
    finally:
        if before is None:
            spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
        else:
            spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)


def arrivals(events: DataFrame, path: str, arrival: str) -> None:
    """events as files in order of arrival: a file for each value of the column (small whole numbers), the later the younger.

    The stream reads files by age, so each is written after the one before. Tasks share the search for its rows; one writes it.
    """
    for (k,) in sorted(tuple(r) for r in events.select(arrival).distinct().collect()):
        events.filter(F.col(arrival) == k).drop(arrival).repartition(1).write.mode("append").parquet(path)


def files(spark: SparkSession, path: str, schema) -> DataFrame:
    """The files of a folder as a stream, one a batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)
