"""Streams over the event table, each with the batch result as its reference."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.stats import r6
from ..sources.shared import fresh_path
from ..streaming import jobs, results
from .registry import query


def _events(spark, sf):
    return jobs.read(spark, sf, "events.parquet")


@query("SELECT time_bucket(INTERVAL '1 day', ts) AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2")
def stream_tumbling_windows(spark, sf):
    out = jobs.run(jobs.tumbling(_utc(_events(spark, sf)), "at", "1 day", ["event_type"], "7 days"), "complete")
    return out.select(_clock("start").alias("start"), "event_type", "n", F.round("total", 4).alias("total"))


def _utc(e):
    """at: the clock time as an instant, through seconds and so whatever the session's zone."""
    from ..sources.tables import micros

    return e.withColumn("at", F.timestamp_micros(micros(F.col("ts"))))


def _clock(column):
    """The instant's UTC clock time as TIMESTAMP_NTZ."""
    return (F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (F.unix_micros(column) / 1000000).cast("decimal(18,6)")))


@query("""WITH d AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL '6 hours' THEN 0 ELSE 1 END AS b FROM events), g AS (SELECT *, sum(b) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS g FROM d)
SELECT user_id, min(ts) AS start, max(ts) + INTERVAL '6 hours' AS "end", count(*) AS n FROM g GROUP BY user_id, g""")
def stream_sessions(spark, sf):
    out = jobs.run(jobs.sessions(_utc(_events(spark, sf)), "at", "6 hours", "user_id", "7 days"), "complete")
    return out.select("user_id", _clock("start").alias("start"), _clock("end").alias("end"), "n")


@query("SELECT user_id, round(arg_max(value, (ts, event_id)), 6) AS value, arg_max(event_type, (ts, event_id)) AS event_type, count(*) AS n FROM events GROUP BY user_id")
def stream_live_view(spark, sf):
    e = _events(spark, sf).groupBy("user_id").agg(F.max_by(F.struct("value", "event_type"), F.struct("ts", "event_id")).alias("l"), F.count(F.lit(1)).alias("n"))
    return jobs.run(e, "complete").select("user_id", r6(F.col("l.value")).alias("value"), F.col("l.event_type").alias("event_type"), "n")


@query("SELECT event_id, user_id, CASE WHEN event_type = 'error' THEN 'error' WHEN value > 95 THEN 'warning' ELSE 'info' END AS severity FROM events WHERE event_type = 'error' OR value > 95")
def stream_issue_rows(spark, sf):
    e = _events(spark, sf).filter("event_type = 'error' OR value > 95").dropDuplicates(["event_id"])
    severity = F.when(F.col("event_type") == "error", "error").when(F.col("value") > 95, "warning").otherwise("info")
    return jobs.run(e.select("event_id", "user_id", severity.alias("severity")))


@query("SELECT event_id, round(value, 6) AS value FROM events ORDER BY events.value DESC, event_id LIMIT 20")
def stream_bounded_topk(spark, sf):
    """Each batch keeps its 20 best; the 20 best of those are the result, whatever the number of batches."""

    def sink(batch, k, path):
        batch.select("event_id", "value").orderBy(F.col("value").desc(), "event_id").limit(20).write.mode("overwrite").parquet(f"{path}/batch={k}")

    out = jobs.run(_events(spark, sf), sink=sink)
    return out.orderBy(F.col("value").desc(), "event_id").limit(20).select("event_id", r6(F.col("value")).alias("value"))


@query("""SELECT user_id, count(*) AS n, epoch_us(max(ts)) AS last FROM events GROUP BY user_id""")
def stream_ordered_fold(spark, sf):
    e = _utc(_events(spark, sf)).select("user_id", "at")
    out = jobs.run(jobs.ordered_fold(e, "user_id", "at"), sink=lambda batch, k, path: batch.write.mode("append").parquet(path))
    return out.groupBy("user_id").agg(F.max("n").alias("n"), F.max("last").alias("last"))


def arriving(spark, sf):
    """The events as six files, five days each, where one event in ten comes a file late; as a stream of a file a batch."""
    e = _utc(spark.read.parquet(f"{sf}/events.parquet"))
    day = F.floor((F.unix_micros("at") - F.unix_micros(F.lit("2024-01-01 00:00:00").cast("timestamp"))) / 86_400_000_000)
    e = e.select("user_id", "at", F.col("event_id").alias("id"), "value", (F.col("event_type") == "signup").alias("is_final"), (F.floor(day / 5) + F.when(F.col("event_id") % 10 == 3, 1).otherwise(0)).cast("int").alias("arrival"))
    path = fresh_path(spark, "arrivals")
    results.arrivals(e, path, "arrival")
    return results.files(spark, path, e.drop("arrival").schema)


@query("""WITH d AS (SELECT user_id, date_trunc('day', ts) AS day, ts, event_id, value, event_type = 'signup' AS final, max(ts) OVER () - INTERVAL '6 days' AS mark FROM events)
SELECT user_id, CAST(epoch(day) AS BIGINT) AS start, count(*) AS n, round(CASE WHEN bool_or(final) THEN arg_max(value, (ts, event_id)) FILTER (final) ELSE sum(value) END, 6) AS value,
CASE WHEN bool_or(final) THEN 'final' WHEN day + INTERVAL '1 day' <= any_value(mark) THEN 'closed' ELSE 'provisional' END AS status FROM d GROUP BY user_id, day""")
def stream_final_results(spark, sf):
    path, checkpoint = fresh_path(spark, "log"), fresh_path(spark, "offsets")
    results.start(results.versions(arriving(spark, sf), "user_id", "at", "6 days", 86_400), path, checkpoint).awaitTermination()
    return results.last_versions(spark.read.parquet(path), "user_id").withColumn("value", r6(F.col("value")))


@query("""WITH m AS (SELECT max(ts) - INTERVAL '6 days' AS mark FROM events) SELECT CAST(epoch(time_bucket(INTERVAL '1 day', ts)) AS BIGINT) AS start, user_id, count(*) AS n, round(sum(value), 4) AS total FROM events, m
GROUP BY 1, 2 HAVING time_bucket(INTERVAL '1 day', any_value(ts)) + INTERVAL '1 day' <= any_value(mark)""")
def stream_closed_windows(spark, sf):
    """Days in append mode over several files: each day is written once, when the watermark has passed it."""
    out = jobs.run(jobs.tumbling(arriving(spark, sf), "at", "1 day", ["user_id"], "6 days"))
    return out.select(F.floor(F.unix_micros("start") / 1_000_000).alias("start"), "user_id", "n", F.round("total", 4).alias("total"))
