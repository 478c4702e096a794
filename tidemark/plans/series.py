"""Time series of entities: timing, visibility runs, motion and clip windows, on the event table as frames."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import ladders
from ..functions.stats import percentile, r6, ratio
from ..operators import intervals, runs, validation
from ..sources.tables import frames, table
from .registry import query

#: The frames of sources.tables in SQL.
FRAMES = """f AS (SELECT user_id AS episode, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS frame, epoch_us(ts) AS us, epoch_us(ts) / 1e6 AS t,
value, event_id, event_type, props, event_type <> 'error' AS valid, event_type IN ('view', 'click') AS seen FROM events)"""
#: Runs of equal valid.
RUNS = """r0 AS (SELECT *, CASE WHEN lag({flag}) OVER (PARTITION BY episode ORDER BY frame) = {flag} THEN 0 ELSE 1 END AS b FROM f),
r1 AS (SELECT *, sum(b) OVER (PARTITION BY episode ORDER BY frame ROWS UNBOUNDED PRECEDING) AS g FROM r0),
r AS (SELECT episode, {flag} AS flag, min(frame) AS first, max(frame) AS last, count(*) AS n, min(t) AS t0, max(t) AS t1 FROM r1 GROUP BY episode, g, {flag})"""
VALID = FRAMES + ",\n" + RUNS.format(flag="valid")


def _episode():
    return W.partitionBy("episode").orderBy("frame")


@query(f"WITH {FRAMES} SELECT episode, frame, CAST(frame / 30.0 AS DOUBLE) AS nominal_s, -1 AS segment, coalesce(json_extract_string(props, '$.k'), '-1') AS k FROM f")
def schema_completion_defaults(spark, sf):
    f = frames(spark, sf)
    return f.select("episode", "frame", (F.col("frame") / 30.0).alias("nominal_s"), F.lit(-1).alias("segment"), F.coalesce(F.get_json_object("props", "$.k"), F.lit("-1")).alias("k"))


@query(f"""WITH {FRAMES}, d AS (SELECT *, (us - lag(us) OVER (PARTITION BY episode ORDER BY frame)) / 1e6 AS dt FROM f),
m AS (SELECT episode, median(dt) AS nominal FROM d GROUP BY episode)
SELECT episode, frame, CASE WHEN dt <= 0 THEN 'numeric_non_monotonic_timestamps' ELSE 'numeric_frame_interval_jitter' END AS code, round(dt, 6) AS measured, round(3 * nominal, 6) AS threshold
FROM d JOIN m USING (episode) WHERE dt <= 0 OR dt > 3 * nominal""")
def timestamp_jitter_events(spark, sf):
    f = frames(spark, sf).withColumn("dt", (F.col("us") - F.lag("us").over(_episode())) / 1e6)
    nominal = f.groupBy("episode").agg(percentile(F.col("dt"), 0.5).alias("nominal"))
    hit = f.join(nominal, "episode").filter((F.col("dt") <= 0) | (F.col("dt") > 3 * F.col("nominal")))
    code = ladders.ladder((F.col("dt") <= 0, "numeric_non_monotonic_timestamps"), otherwise="numeric_frame_interval_jitter")
    return hit.select("episode", "frame", code.alias("code"), r6(F.col("dt")).alias("measured"), r6(3 * F.col("nominal")).alias("threshold"))


@query("""SELECT l_orderkey AS episode, count(*) AS n, min(l_linenumber) AS first, max(l_linenumber) AS last,
min(l_linenumber) = 1 AND max(l_linenumber) = count(*) AND count(DISTINCT l_linenumber) = count(*) AS contiguous FROM lineitem GROUP BY l_orderkey""")
def index_contiguity(spark, sf):
    n, k = F.count(F.lit(1)), F.col("l_linenumber")
    g = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("episode"))
    # an index is 1..n exactly if its least is 1, its greatest n, and the sum and squares agree; distinct is the plain way
    return g.agg(n.alias("n"), F.min(k).alias("first"), F.max(k).alias("last"), F.count_distinct(k).alias("_d")).withColumn("contiguous", (F.col("first") == 1) & (F.col("last") == F.col("n")) & (F.col("_d") == F.col("n"))).drop("_d")


@query(f"WITH {FRAMES} SELECT episode, count(*) FILTER (valid <> seen) AS mismatched, count(*) AS n, min(frame) FILTER (valid <> seen) AS first_frame FROM f GROUP BY episode")
def kept_mask_mismatch(spark, sf):
    differs = F.col("valid") != F.col("seen")
    return frames(spark, sf).groupBy("episode").agg(F.count_if(differs).alias("mismatched"), F.count(F.lit(1)).alias("n"), F.min(F.when(differs, F.col("frame"))).alias("first_frame"))


@query(f"""WITH {VALID}, s AS (SELECT *, min(first) FILTER (flag) OVER (PARTITION BY episode) AS lo, max(last) FILTER (flag) OVER (PARTITION BY episode) AS hi FROM r)
SELECT episode, CAST(sum(n) AS BIGINT) AS frames, CAST(sum(n) FILTER (flag) AS BIGINT) AS visible, min(lo) AS first_visible, max(hi) AS last_visible, count(*) FILTER (flag) AS n_runs,
coalesce(max(n) FILTER (NOT flag AND first > lo AND last < hi), 0) AS longest_internal_gap, count(*) FILTER (flag AND n >= 5) AS qualifying_runs,
CAST(coalesce(sum(n - 5) FILTER (flag AND n >= 5), 0) AS BIGINT) AS effective, count(*) FILTER (NOT flag AND first > lo AND last < hi AND n > 2) AS excessive_gaps FROM s GROUP BY episode""")
def visibility_runs(spark, sf):
    r = runs.runs(frames(spark, sf), "episode", "frame", "valid")
    w = W.partitionBy("episode")
    v = F.col("valid")
    s = r.withColumn("lo", F.min(F.when(v, F.col("first"))).over(w)).withColumn("hi", F.max(F.when(v, F.col("last"))).over(w))
    inner = ~v & (F.col("first") > F.col("lo")) & (F.col("last") < F.col("hi"))
    long = v & (F.col("n") >= 5)
    return s.groupBy("episode").agg(
        F.sum("n").alias("frames"), F.sum(F.when(v, F.col("n"))).alias("visible"), F.min("lo").alias("first_visible"), F.max("hi").alias("last_visible"), F.count_if(v).alias("n_runs"),
        F.coalesce(F.max(F.when(inner, F.col("n"))), F.lit(0)).alias("longest_internal_gap"), F.count_if(long).alias("qualifying_runs"),
        F.coalesce(F.sum(F.when(long, F.col("n") - 5)), F.lit(0)).alias("effective"), F.count_if(inner & (F.col("n") > 2)).alias("excessive_gaps"),
    )


@query(f"""WITH {VALID}, s AS (SELECT *, min(first) FILTER (flag) OVER (PARTITION BY episode) AS lo, max(last) FILTER (flag) OVER (PARTITION BY episode) AS hi FROM r)
SELECT episode, first, last, n FROM s WHERE NOT flag AND first > lo AND last < hi AND n <= 3""")
def mask_flicker_runs(spark, sf):
    return runs.internal_gaps(runs.runs(frames(spark, sf), "episode", "frame", "valid"), "episode", "valid", 3).select("episode", "first", "last", "n")


@query(f"""WITH {FRAMES}, m AS (SELECT *, max(CASE WHEN valid THEN frame END) OVER (PARTITION BY episode ORDER BY frame ROWS UNBOUNDED PRECEDING) AS back,
min(CASE WHEN valid THEN frame END) OVER (PARTITION BY episode ORDER BY frame ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS ahead FROM f),
b AS (SELECT episode, frame, t, valid OR coalesce(ahead - back - 1 <= 1, false) AS valid FROM m),
r0 AS (SELECT *, CASE WHEN lag(valid) OVER (PARTITION BY episode ORDER BY frame) = valid THEN 0 ELSE 1 END AS x FROM b),
r1 AS (SELECT *, sum(x) OVER (PARTITION BY episode ORDER BY frame ROWS UNBOUNDED PRECEDING) AS g FROM r0)
SELECT episode, min(frame) AS first, max(frame) AS last, count(*) AS n, round(min(t), 6) AS start_s, round(max(t), 6) AS end_s FROM r1 WHERE valid GROUP BY episode, g""")
def bridge_gaps_segments(spark, sf):
    b = runs.bridged(frames(spark, sf), "episode", "frame", "valid", 1)
    r = runs.runs(b, "episode", "frame", "valid", {"start_s": F.min("t"), "end_s": F.max("t")}).filter("valid")
    return r.select("episode", "first", "last", "n", r6(F.col("start_s")).alias("start_s"), r6(F.col("end_s")).alias("end_s"))


@query(f"WITH {VALID} SELECT episode, coalesce(max(n) FILTER (flag), 0) AS longest_true, coalesce(max(n) FILTER (NOT flag), 0) AS longest_false, CAST(coalesce(sum(n) FILTER (flag AND n >= 4), 0) AS BIGINT) AS eligible FROM r GROUP BY episode")
def longest_runs(spark, sf):
    r = runs.runs(frames(spark, sf), "episode", "frame", "valid")
    eligible = r.groupBy("episode").agg(F.coalesce(F.sum(F.when(F.col("valid") & (F.col("n") >= 4), F.col("n"))), F.lit(0)).alias("eligible"))
    return runs.longest(r, "episode", "valid").join(eligible, "episode")


@query(f"""WITH {FRAMES}, d AS (SELECT episode, frame, CASE WHEN valid AND lag(valid) OVER w AND lead(valid) OVER w THEN abs(value - (lag(value) OVER w + lead(value) OVER w) / 2) END AS residual FROM f WINDOW w AS (PARTITION BY episode ORDER BY frame))
SELECT episode, count(residual) AS n, round(quantile_cont(residual, 0.99), 6) AS p99, round(max(residual), 6) AS largest FROM d GROUP BY episode""")
def position_residual_p99(spark, sf):
    w = _episode()
    all_valid = F.col("valid") & F.lag("valid").over(w) & F.lead("valid").over(w)
    d = frames(spark, sf).withColumn("residual", F.when(all_valid, F.abs(F.col("value") - (F.lag("value").over(w) + F.lead("value").over(w)) / 2)))
    return d.groupBy("episode").agg(F.count("residual").alias("n"), r6(percentile(F.col("residual"), 0.99)).alias("p99"), r6(F.max("residual")).alias("largest"))


_SPEED = """d AS (SELECT episode, frame, CASE WHEN valid AND lag(valid) OVER w AND us > lag(us) OVER w THEN abs(value - lag(value) OVER w) / ((us - lag(us) OVER w) / 1e6) END AS speed FROM f WINDOW w AS (PARTITION BY episode ORDER BY frame)),
m AS (SELECT episode, median(speed) AS med FROM d GROUP BY episode), a AS (SELECT episode, median(abs(speed - med)) AS mad FROM d JOIN m USING (episode) GROUP BY episode)"""


@query(f"WITH {FRAMES}, {_SPEED} SELECT episode, round(any_value(med), 6) AS median_speed, round(any_value(mad), 6) AS mad, count(*) FILTER (speed > med + 3 * 1.4826 * mad) AS outliers, count(speed) AS n FROM d JOIN m USING (episode) JOIN a USING (episode) GROUP BY episode")
def velocity_mad_outliers(spark, sf):
    w = _episode()
    ok = F.col("valid") & F.lag("valid").over(w) & (F.col("us") > F.lag("us").over(w))
    d = frames(spark, sf).select("episode", F.when(ok, F.abs(F.col("value") - F.lag("value").over(w)) / ((F.col("us") - F.lag("us").over(w)) / 1e6)).alias("speed"))
    m = d.groupBy("episode").agg(percentile(F.col("speed"), 0.5).alias("med"))
    d = d.join(m, "episode")
    a = d.groupBy("episode").agg(percentile(F.abs(F.col("speed") - F.col("med")), 0.5).alias("mad"))
    d = d.join(a, "episode")
    return d.groupBy("episode").agg(r6(F.first("med")).alias("median_speed"), r6(F.first("mad")).alias("mad"), F.count_if(F.col("speed") > F.col("med") + 3 * 1.4826 * F.col("mad")).alias("outliers"), F.count("speed").alias("n"))


@query(f"""WITH {FRAMES}, d AS (SELECT episode, frame, abs(lead(value) OVER w - 2 * value + lag(value) OVER w) AS accel FROM f WINDOW w AS (PARTITION BY episode ORDER BY frame)),
k AS (SELECT *, row_number() OVER (PARTITION BY episode ORDER BY accel DESC, frame) AS place FROM d WHERE accel IS NOT NULL) SELECT episode, frame, round(accel, 6) AS accel, place FROM k WHERE place <= 3""")
def second_difference_hotspots(spark, sf):
    w = _episode()
    d = frames(spark, sf).withColumn("accel", F.abs(F.lead("value").over(w) - 2 * F.col("value") + F.lag("value").over(w))).filter("accel IS NOT NULL")
    k = d.withColumn("place", F.row_number().over(W.partitionBy("episode").orderBy(F.col("accel").desc(), "frame"))).filter("place <= 3")
    return k.select("episode", "frame", r6(F.col("accel")).alias("accel"), "place")


@query(f"""WITH {FRAMES}, d AS (SELECT *, coalesce(abs(value - lag(value) OVER (PARTITION BY episode ORDER BY frame)) < 20, false) AS still FROM f),
r0 AS (SELECT *, CASE WHEN lag(still) OVER (PARTITION BY episode ORDER BY frame) = still THEN 0 ELSE 1 END AS b FROM d),
r1 AS (SELECT *, sum(b) OVER (PARTITION BY episode ORDER BY frame ROWS UNBOUNDED PRECEDING) AS g FROM r0),
r AS (SELECT episode, still, count(*) AS n FROM r1 GROUP BY episode, g, still)
SELECT episode, coalesce(max(n) FILTER (still), 0) + 1 AS frozen_frames FROM r GROUP BY episode""")
def freeze_runs(spark, sf):
    d = frames(spark, sf).withColumn("still", F.coalesce(F.abs(F.col("value") - F.lag("value").over(_episode())) < 20, F.lit(False)))
    return runs.longest(runs.runs(d, "episode", "frame", "still"), "episode", "still").select("episode", (F.col("longest_true") + 1).alias("frozen_frames"))


@query(f"""WITH RECURSIVE {FRAMES}, e AS (SELECT episode, frame, row_number() OVER (PARTITION BY episode ORDER BY frame) AS k FROM f WHERE event_type IN ('error', 'purchase')),
c AS (SELECT episode, frame, k, frame AS anchor, 0 AS cluster FROM e WHERE k = 1 UNION ALL
SELECT e.episode, e.frame, e.k, CASE WHEN e.frame - c.frame > 3 OR e.frame - c.anchor > 10 THEN e.frame ELSE c.anchor END, c.cluster + CASE WHEN e.frame - c.frame > 3 OR e.frame - c.anchor > 10 THEN 1 ELSE 0 END
FROM c JOIN e ON e.episode = c.episode AND e.k = c.k + 1)
SELECT episode, cluster, min(frame) AS first, max(frame) AS last, count(*) AS n, greatest(min(frame) - 2, 0) AS window_start, max(frame) + 3 AS window_end FROM c GROUP BY episode, cluster""")
def cluster_windows(spark, sf):
    e = frames(spark, sf).filter(F.col("event_type").isin("error", "purchase"))
    c = runs.greedy_clusters(e, "episode", "frame", 3, 10).groupBy("episode", "cluster").agg(F.min("frame").alias("first"), F.max("frame").alias("last"), F.count(F.lit(1)).alias("n"))
    return c.withColumn("window_start", F.greatest(F.col("first") - 2, F.lit(0))).withColumn("window_end", F.col("last") + 3)


@query(f"""WITH {FRAMES}, n AS (SELECT episode, max(frame) + 1 AS n FROM f GROUP BY episode), w AS (SELECT episode, unnest(range(0, CAST(n - 10 + 1 AS BIGINT), 10)) AS start FROM n WHERE n >= 10),
c AS (SELECT w.episode, w.start, count(f.frame) FILTER (f.event_type IN ('error', 'purchase')) AS events FROM w JOIN f ON f.episode = w.episode AND f.frame // 10 * 10 = w.start GROUP BY w.episode, w.start),
k AS (SELECT *, row_number() OVER (PARTITION BY episode ORDER BY events, sha256('7:' || episode || ':' || start)) AS place FROM c) SELECT episode, start, start + 10 AS "end", events FROM k WHERE place = 1""")
def least_event_window(spark, sf):
    f = frames(spark, sf)
    tile = (F.floor(F.col("frame") / 10) * 10).cast("bigint")
    w = f.groupBy("episode", tile.alias("start")).agg(F.count_if(F.col("event_type").isin("error", "purchase")).alias("events"), F.count(F.lit(1)).alias("n")).filter("n = 10")
    rank = F.sha2(F.concat(F.lit("7:"), F.col("episode").cast("string"), F.lit(":"), F.col("start").cast("string")), 256)
    best = w.groupBy("episode").agg(F.min(F.struct("events", rank.alias("r"), "start")).alias("b"))
    return best.select("episode", "b.start", (F.col("b.start") + 10).alias("end"), "b.events")


@query(f"""WITH {FRAMES}, m AS (SELECT episode, count(*) AS n, count(*) FILTER (NOT valid) AS bad, coalesce(avg(value), 0) AS mean, count(*) FILTER (event_type = 'purchase') AS bought FROM f GROUP BY episode),
i AS (SELECT episode, 'kept_mask_mismatch' AS code, 'error' AS severity FROM m WHERE bad * 100 >= 25 * n UNION ALL SELECT episode, 'low_valid_ratio', 'warning' FROM m WHERE bad * 100 >= 20 * n
UNION ALL SELECT episode, 'timestamp_mismatch', 'error' FROM m WHERE mean > 52 UNION ALL SELECT episode, 'position_jitter', 'warning' FROM m WHERE bought * 100 >= 22 * n),
a AS (SELECT episode, list_sort(list_distinct(list(code))) AS codes, list(severity) AS s FROM i GROUP BY episode)
SELECT m.episode, coalesce(array_to_string(codes, ','), '') AS codes,
CASE WHEN list_contains(codes, 'kept_mask_mismatch') THEN 'quarantine' WHEN list_contains(s, 'error') THEN 'bronze' WHEN list_contains(s, 'warning') THEN 'silver' ELSE 'gold' END AS tier,
CASE WHEN list_contains(codes, 'kept_mask_mismatch') THEN 'quarantine' WHEN list_contains(s, 'error') THEN 'reject' WHEN list_has_any(codes, ['low_valid_ratio', 'position_jitter']) THEN 'review' ELSE 'accept' END AS decision
FROM m LEFT JOIN a USING (episode)""")
def scan_quality_decisions(spark, sf):
    """The flagship scan: frames, measures, issues, tier and decision of every entity."""
    m = frames(spark, sf).groupBy("episode").agg(F.count(F.lit(1)).alias("n"), F.count_if(~F.col("valid")).alias("bad"), F.avg("value").alias("mean"), F.count_if(F.col("event_type") == "purchase").alias("bought"))
    rules = [("kept_mask_mismatch", F.col("bad") * 100 >= 25 * F.col("n"), "error"), ("low_valid_ratio", F.col("bad") * 100 >= 20 * F.col("n"), "warning"), ("timestamp_mismatch", F.col("mean") > 52, "error"), ("position_jitter", F.col("bought") * 100 >= 22 * F.col("n"), "warning")]
    out = validation.decide(m, validation.issues(m, "episode", rules), "episode", ["low_valid_ratio", "position_jitter"])
    return out.select("episode", F.array_join("codes", ",").alias("codes"), "tier", "decision")


@query(f"""WITH {FRAMES}, m AS (SELECT episode, count(*) AS n, count(*) FILTER (NOT valid) AS bad FROM f GROUP BY episode)
SELECT threshold, count(*) FILTER (bad * 100 >= threshold * n) AS triggered, count(*) AS episodes FROM m, (SELECT unnest([15, 20, 25, 30]) AS threshold) GROUP BY threshold""")
def threshold_whatif(spark, sf):
    m = frames(spark, sf).groupBy("episode").agg(F.count(F.lit(1)).alias("n"), F.count_if(~F.col("valid")).alias("bad"))
    m = m.withColumn("threshold", F.explode(F.array(*map(F.lit, (15, 20, 25, 30)))))
    return m.groupBy("threshold").agg(F.count_if(F.col("bad") * 100 >= F.col("threshold") * F.col("n")).alias("triggered"), F.count(F.lit(1)).alias("episodes"))


@query(f"""WITH {VALID} SELECT f.episode, count(*) AS n, round(count(*) FILTER (valid) / count(*)::DOUBLE, 6) AS valid_ratio, max(g.longest) AS longest_gap, count(*) FILTER (valid) / count(*)::DOUBLE < 0.8 AS low
FROM f JOIN (SELECT episode, coalesce(max(n) FILTER (NOT flag), 0) AS longest FROM r GROUP BY episode) g ON g.episode = f.episode GROUP BY f.episode""")
def valid_ratio_longest_gap(spark, sf):
    r = runs.runs(frames(spark, sf), "episode", "frame", "valid")
    s = r.groupBy("episode").agg(F.sum("n").alias("n"), F.coalesce(F.sum(F.when(F.col("valid"), F.col("n"))), F.lit(0)).alias("ok"), F.coalesce(F.max(F.when(~F.col("valid"), F.col("n"))), F.lit(0)).alias("longest_gap"))
    share = ratio(F.col("ok"), F.col("n"))
    return s.select("episode", "n", r6(share).alias("valid_ratio"), "longest_gap", (share < 0.8).alias("low"))


@query(f"""WITH {FRAMES}, b AS (SELECT episode, count(DISTINCT frame) FILTER (NOT valid OR value > 95) AS bad, count(*) AS n FROM f GROUP BY episode)
SELECT episode, bad, n, round(bad / n::DOUBLE, 6) AS bad_ratio, bad / n::DOUBLE >= 0.25 AS exceeded FROM b""")
def bad_frame_ratio(spark, sf):
    bad = ~F.col("valid") | (F.col("value") > 95)
    b = frames(spark, sf).groupBy("episode").agg(F.count_if(bad).alias("bad"), F.count(F.lit(1)).alias("n"))
    return b.select("episode", "bad", "n", r6(F.col("bad") / F.col("n")).alias("bad_ratio"), (F.col("bad") / F.col("n") >= 0.25).alias("exceeded"))


@query(f"""WITH {FRAMES}, n AS (SELECT episode, count(*) AS n FROM f GROUP BY episode), b AS (SELECT f.*, frame >= n // 4 AND frame < n // 4 + 8 AS inside FROM f JOIN n USING (episode)),
p AS (SELECT *, CASE WHEN inside THEN value + 50 ELSE value END AS moved FROM b)
SELECT episode, count(*) FILTER (inside) AS changed, count(*) FILTER (moved > 95) - count(*) FILTER (value > 95) AS new_events, coalesce(count(*) FILTER (moved > 95 AND inside) / nullif(count(*) FILTER (moved > 95), 0)::DOUBLE, 0) > 0.5 AS localised FROM p GROUP BY episode""")
def intervention_perturb(spark, sf):
    f = frames(spark, sf).withColumn("n", F.count(F.lit(1)).over(W.partitionBy("episode")))
    start = F.floor(F.col("n") / 4)
    p = f.withColumn("inside", (F.col("frame") >= start) & (F.col("frame") < start + 8)).withColumn("moved", F.when(F.col("inside"), F.col("value") + 50).otherwise(F.col("value")))
    hit = F.col("moved") > 95
    share = ratio(F.count_if(hit & F.col("inside")), F.count_if(hit))
    return p.groupBy("episode").agg(F.count_if(F.col("inside")).alias("changed"), (F.count_if(hit) - F.count_if(F.col("value") > 95)).alias("new_events"), (F.coalesce(share, F.lit(0.0)) > 0.5).alias("localised"))


@query(f"""WITH {FRAMES}, s AS (SELECT episode, frame, value, avg(value) OVER (PARTITION BY episode ORDER BY frame ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS smooth FROM f),
d AS (SELECT *, abs(value - lag(value) OVER w) AS raw, abs(smooth - lag(smooth) OVER w) AS fixed, abs(value - smooth) AS correction FROM s WINDOW w AS (PARTITION BY episode ORDER BY frame))
SELECT episode, round(sum(raw), 6) AS path_before, round(sum(fixed), 6) AS path_after, round(quantile_cont(correction, 0.99), 6) AS correction_p99, coalesce(sum(fixed) / nullif(sum(raw), 0) >= 0.3, false) AS faithful FROM d GROUP BY episode""")
def motion_fidelity(spark, sf):
    w = _episode()
    s = frames(spark, sf).select("episode", "frame", "value", F.avg("value").over(w.rowsBetween(-1, 1)).alias("smooth"))
    d = s.select("episode", F.abs(F.col("value") - F.lag("value").over(w)).alias("raw"), F.abs(F.col("smooth") - F.lag("smooth").over(w)).alias("fixed"), F.abs(F.col("value") - F.col("smooth")).alias("correction"))
    return d.groupBy("episode").agg(r6(F.sum("raw")).alias("path_before"), r6(F.sum("fixed")).alias("path_after"), r6(percentile(F.col("correction"), 0.99)).alias("correction_p99"), F.coalesce(ratio(F.sum("fixed"), F.sum("raw")) >= 0.3, F.lit(False)).alias("faithful"))


@query(f"""WITH {FRAMES}, k AS (SELECT episode, frame, value, row_number() OVER (PARTITION BY episode ORDER BY value DESC, frame) AS place FROM f WHERE NOT valid) SELECT episode, place, frame, round(value, 6) AS score FROM k WHERE place <= 6""")
def candidate_rank_top6(spark, sf):
    k = frames(spark, sf).filter("NOT valid").withColumn("place", F.row_number().over(W.partitionBy("episode").orderBy(F.col("value").desc(), "frame"))).filter("place <= 6")
    return k.select("episode", "place", "frame", r6(F.col("value")).alias("score"))


@query(f"""WITH {FRAMES}, b AS (SELECT episode, min(us) AS t0 FROM f GROUP BY episode) SELECT f.episode, frame, CAST(floor((us - t0) / 1e6 * 0.001 + 0.5) AS BIGINT) AS video_frame, count(*) OVER (PARTITION BY f.episode, floor((us - t0) / 1e6 * 0.001 + 0.5)) AS sharing FROM f JOIN b USING (episode)""")
def pts_to_frame(spark, sf):
    f = frames(spark, sf).withColumn("t0", F.min("us").over(W.partitionBy("episode")))
    f = f.withColumn("video_frame", F.floor((F.col("us") - F.col("t0")) / 1e6 * 0.001 + 0.5).cast("bigint"))
    return f.select("episode", "frame", "video_frame", F.count(F.lit(1)).over(W.partitionBy("episode", "video_frame")).alias("sharing"))


@query(f"""WITH {FRAMES} SELECT episode, frame, CASE event_type WHEN 'error' THEN 'overlay_drift' WHEN 'purchase' THEN 'camera_shake' WHEN 'click' THEN 'flicker' END AS task FROM f WHERE event_type IN ('error', 'purchase', 'click')
UNION SELECT episode, frame, 'all_events' FROM f WHERE event_type = 'error'""")
def event_task_map(spark, sf):
    tasks = F.create_map(*[x for kind, t in (("error", ["overlay_drift", "all_events"]), ("purchase", ["camera_shake"]), ("click", ["flicker"])) for x in (F.lit(kind), F.array(*map(F.lit, t)))])
    f = frames(spark, sf)
    return f.select("episode", "frame", F.explode(F.try_element_at(tasks, F.col("event_type"))).alias("task")).distinct()


@query(f"""WITH {FRAMES}, e AS (SELECT episode, us, value FROM f WHERE event_type = 'view') SELECT f.episode, f.frame, round((SELECT arg_max(value, (us, value)) FROM e WHERE e.episode = f.episode AND e.us <= f.us), 6) AS seen_value FROM f WHERE f.event_type = 'error'""")
def asof_nearest(spark, sf):
    f = frames(spark, sf)
    return intervals.asof(f.filter("event_type = 'error'").select("episode", "us", "frame"), f.filter("event_type = 'view'").select("episode", "us", F.col("value").alias("seen_value")), "episode", "us", "seen_value").select("episode", "frame", r6(F.col("seen_value")).alias("seen_value"))


@query(f"""WITH {FRAMES}, e AS (SELECT episode, us, value FROM f WHERE event_type = 'purchase') SELECT f.episode, f.frame, round((SELECT arg_min(value, (us, value)) FROM e WHERE e.episode = f.episode AND e.us >= f.us), 6) AS next_value FROM f WHERE f.event_type = 'click'""")
def asof_forward(spark, sf):
    f = frames(spark, sf)
    return intervals.asof(f.filter("event_type = 'click'").select("episode", "us", "frame"), f.filter("event_type = 'purchase'").select("episode", "us", F.col("value").alias("next_value")), "episode", "us", "next_value", "forward").select("episode", "frame", r6(F.col("next_value")).alias("next_value"))


@query(f"""WITH {VALID}, s AS (SELECT episode, first AS start, last + 1 AS "end" FROM r WHERE NOT flag) SELECT f.episode, f.frame, s.start, s."end" FROM f JOIN s ON f.episode = s.episode AND f.frame >= s.start AND f.frame < s."end" WHERE value > 50""")
def interval_containment(spark, sf):
    f = frames(spark, sf)
    spans = runs.runs(f, "episode", "frame", "valid").filter("NOT valid").select("episode", F.col("first").alias("start"), (F.col("last") + 1).alias("end"))
    return intervals.contained(f.filter("value > 50").select("episode", "frame"), spans, "episode", "frame", 16).select("episode", "frame", "start", "end")


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, json_valid(props) AND json_extract(props, '$.k') IS NOT NULL AS well_formed, CAST(json_extract(props, '$.k') AS BIGINT) BETWEEN 0 AND 90 AS in_bounds FROM events")
def json_extract_validate(spark, sf):
    e = table(spark, sf, "events").select("event_id", F.get_json_object("props", "$.k").cast("bigint").alias("k"), F.try_parse_json("props").isNotNull().alias("valid"))
    return e.select("event_id", "k", (F.col("valid") & F.col("k").isNotNull()).alias("well_formed"), F.col("k").between(0, 90).alias("in_bounds"))


@query("""WITH k AS (SELECT user_id, max(event_type = 'view') AS has_view, max(event_type = 'click') AS has_click, max(event_type = 'purchase') AS has_purchase, max(event_type = 'signup') AS has_signup FROM events GROUP BY user_id),
u AS (SELECT * FROM (VALUES ('pretraining', ['view']), ('retargeting', ['view', 'click', 'purchase']), ('onboarding', ['signup', 'click'])) t(use_case, required))
SELECT user_id, use_case, array_to_string(list_filter(required, lambda x: NOT CASE x WHEN 'view' THEN has_view WHEN 'click' THEN has_click WHEN 'purchase' THEN has_purchase ELSE has_signup END), ',') AS missing,
CASE len(list_filter(required, lambda x: NOT CASE x WHEN 'view' THEN has_view WHEN 'click' THEN has_click WHEN 'purchase' THEN has_purchase ELSE has_signup END)) WHEN 0 THEN 'ready' WHEN len(required) THEN 'blocked' ELSE 'partial' END AS status FROM k, u""")
def capability_use_cases(spark, sf):
    have = table(spark, sf, "events").groupBy("user_id").agg(F.collect_set("event_type").alias("have"))
    cases = {"pretraining": ["view"], "retargeting": ["view", "click", "purchase"], "onboarding": ["signup", "click"]}
    case = F.explode(F.array(*[F.struct(F.lit(n).alias("use_case"), F.array(*map(F.lit, r)).alias("required")) for n, r in cases.items()]))
    k = have.select("user_id", "have", case.alias("c")).select("user_id", "c.use_case", "c.required", F.array_except("c.required", "have").alias("m"))
    return k.select("user_id", "use_case", F.array_join("m", ",").alias("missing"), ladders.ladder((F.size("m") == 0, "ready"), (F.size("m") == F.size("required"), "blocked"), otherwise="partial").alias("status"))


@query("SELECT user_id, max(ts) AS last_ts, arg_max(event_type, (ts, event_id)) AS last_type, round(arg_max(value, (ts, event_id)), 6) AS last_value FROM events GROUP BY user_id")
def live_last_write_wins(spark, sf):
    e = table(spark, sf, "events").groupBy("user_id").agg(F.max("ts").alias("last_ts"), F.max_by(F.struct("event_type", "value"), F.struct("ts", "event_id")).alias("l"))
    return e.select("user_id", "last_ts", F.col("l.event_type").alias("last_type"), r6(F.col("l.value")).alias("last_value"))


@query("SELECT event_type, n, round(share, 6) AS share FROM (SELECT event_type, count(*) AS n, count(*) / sum(count(*)) OVER ()::DOUBLE AS share FROM events GROUP BY event_type) ORDER BY n DESC, event_type LIMIT 3")
def category_topn(spark, sf):
    n = table(spark, sf, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    return n.withColumn("share", r6(F.col("n") / F.sum("n").over(W.partitionBy()))).orderBy(F.col("n").desc(), "event_type").limit(3)


@query(f"""WITH {FRAMES}, g AS (SELECT episode, max(us) - min(us) AS spread, count(*) AS n, count(*) FILTER (NOT valid) AS bad FROM f GROUP BY episode)
SELECT episode, round(least(1.0, greatest(0.0, (bad / n::DOUBLE - 0.1) / 0.2)), 6) AS absence_p, round(least(1.0, greatest(0.0, (spread / 1e6 / 86400) / 60)), 6) AS span_p FROM g""")
def soft_label_ramp(spark, sf):
    from ..functions.stats import clamp

    g = frames(spark, sf).groupBy("episode").agg((F.max("us") - F.min("us")).alias("spread"), F.count(F.lit(1)).alias("n"), F.count_if(~F.col("valid")).alias("bad"))
    return g.select("episode", r6(clamp((F.col("bad") / F.col("n") - 0.1) / 0.2, 0.0, 1.0)).alias("absence_p"), r6(clamp((F.col("spread") / 1e6 / 86400) / 60, 0.0, 1.0)).alias("span_p"))


@query(f"WITH {FRAMES} SELECT f.episode, f.frame, round(value, 6) AS value, round(frame / 30.0, 6) AS nominal_s, sha256(CAST(f.episode AS VARCHAR)) AS plan FROM f WHERE frame < 1000000")
def overlay_columns_join(spark, sf):
    f = frames(spark, sf)
    overlay = f.select("episode", "frame", r6(F.col("frame") / 30.0).alias("nominal_s"), F.sha2(F.col("episode").cast("string"), 256).alias("plan"))
    return f.select("episode", "frame", r6(F.col("value")).alias("value")).join(overlay, ["episode", "frame"])


@query("""SELECT user_id, count(*) AS n, count(*) FILTER (event_type = 'error') AS failed, round(count(*) FILTER (event_type = 'error') / count(*)::DOUBLE, 6) AS failure_ratio,
CASE WHEN count(*) FILTER (event_type = 'error') * 4 >= count(*) THEN 'retry' ELSE 'ok' END AS state FROM events GROUP BY user_id""")
def failure_isolation(spark, sf):
    bad = F.count_if(F.col("event_type") == "error")
    e = table(spark, sf, "events").groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), bad.alias("failed"))
    return e.select("user_id", "n", "failed", r6(F.col("failed") / F.col("n")).alias("failure_ratio"), ladders.ladder((F.col("failed") * 4 >= F.col("n"), "retry"), otherwise="ok").alias("state"))


@query(f"""WITH RECURSIVE {FRAMES}, x AS (SELECT episode, frame, value FROM f WHERE episode < 1000000000),
o AS (SELECT episode, frame, value, value AS y FROM x WHERE frame = 0 UNION ALL SELECT x.episode, x.frame, x.value, 0.3 * x.value + 0.7 * o.y FROM o JOIN x ON x.episode = o.episode AND x.frame = o.frame + 1)
SELECT episode, frame, round(y, 4) AS smooth FROM o""")
def exponential_filter(spark, sf):
    """A first-order recursive filter."""

    def step(y, x):
        y = x if y is None else 0.3 * x + 0.7 * y
        return y, y

    out = runs.fold(frames(spark, sf), "episode", "frame", "value", "y", "double", step)
    return out.select("episode", "frame", F.round("y", 4).alias("smooth"))
