"""As-of at fixed rates, and interventions replayed through the rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.stats import r6
from ..operators import interventions, intervals
from ..sources.shared import cut
from ..sources.tables import frames
from .registry import query
from .series import FRAMES


@query(f"""WITH {FRAMES}, q AS (SELECT episode, frame, us FROM f WHERE event_type = 'error'), v AS (SELECT episode, us, value FROM f WHERE event_type = 'view'),
b AS (SELECT q.*, v.us AS bu, v.value AS bv FROM q ASOF LEFT JOIN v ON q.episode = v.episode AND q.us > v.us), a AS (SELECT b.*, v.us AS au, v.value AS av FROM b ASOF LEFT JOIN v ON b.episode = v.episode AND b.us <= v.us)
SELECT episode, frame, round(CASE WHEN au IS NULL OR abs(us - bu) < abs(au - us) THEN bv ELSE av END, 6) AS seen_value FROM a""")
def nearest_sample(spark, sf):
    f = frames(spark, sf)
    out = intervals.nearest(f.filter("event_type = 'error'").select("episode", "us", "frame"), f.filter("event_type = 'view'").select("episode", "us", F.col("value").alias("seen_value")), "episode", "us", "seen_value")
    return out.select("episode", "frame", r6(F.col("seen_value")).alias("seen_value"))


@query(f"""WITH {FRAMES}, g AS (SELECT episode, frame AS clip, unnest(range(CAST(greatest(1, CASE frame % 3 WHEN 0 THEN 4 WHEN 1 THEN 2 ELSE 0 END) AS BIGINT))) AS k, us FROM f WHERE event_type = 'purchase'),
t AS (SELECT episode, clip, k, us + k * 21600000000 AS target FROM g), m AS (SELECT t.*, f.frame FROM t ASOF LEFT JOIN (SELECT * FROM f WHERE valid) f ON t.episode = f.episode AND t.target - 1 <= f.us)
SELECT episode, clip, k, CAST(target AS DOUBLE) AS target, last_value(frame IGNORE NULLS) OVER w AS frame, frame IS NULL AND last_value(frame IGNORE NULLS) OVER w IS NOT NULL AS repeated FROM m WINDOW w AS (PARTITION BY episode, clip ORDER BY k)""")
def fixed_rate_frames(spark, sf):
    """Clips at purchases, a frame for every six hours of a day, half a day (2.5 places, rounded to 2) or an hour (one place)."""
    f = frames(spark, sf)
    window = F.when(F.col("frame") % 3 == 0, 86_400.0).when(F.col("frame") % 3 == 1, 54_000.0).otherwise(3_600.0)
    clips = f.filter("event_type = 'purchase'").select("episode", F.col("frame").alias("clip"), F.col("us").alias("start"), window.alias("window_s"), F.lit(1 / 21_600).alias("decode_fps"))
    return intervals.at_fixed_rate(clips, f.filter("valid").select("episode", "us", "frame"), "episode", "us", "frame", second=1e6, tolerance=1.0)


#: What interventions do to a value, and the experts that should notice.
FAMILIES = {"spike": ["bad_frame:high", "max_value"], "freeze": ["bad_frame:low"], "noise": ["mean_value"]}


def _experts():
    high, low = F.col("value") > 95, F.col("value") < 5
    return {"bad_frame:high": F.count_if(high), "bad_frame:low": F.count_if(low), "issue:many_high": (F.count_if(high) * 4 > F.count(F.lit(1))).cast("int"), "max_value": F.max("value"), "mean_value": F.avg("value")}


def _replay(spark, sf):
    f = frames(spark, sf).select("episode", "frame", "value")
    n = f.groupBy("episode").agg(F.count(F.lit(1)).alias("n"))
    plan = n.select("episode", "n", F.explode(F.array(*[F.struct(F.lit(x).alias("family"), F.lit(d).alias("level"), F.array(*map(F.lit, e)).alias("expected")) for x, e in FAMILIES.items() for d in ("low", "high")])).alias("i")).select("episode", "i.*", F.floor(F.col("n") / 4).alias("start_frame"), (F.floor(F.col("n") / 4) + 8).alias("end_frame"))
    plan = cut(plan.withColumn("intervention_id", F.concat_ws("/", F.col("episode").cast("string"), "family", "level")), "plan")
    dose = lambda level: F.when(level == "high", 2.0).otherwise(1.0)
    change = lambda v, family, level: F.when(family == "spike", v + 40 * dose(level)).when(family == "freeze", v / (1 + 9 * dose(level))).otherwise(v + 2 * dose(level))
    moved = interventions.virtual_frames(f, plan, "episode", "frame", "value", change)
    found = interventions.deltas(plan, interventions.evidence(f, ["episode"], _experts()), interventions.evidence(moved, ["intervention_id"], _experts()), "episode")
    events = moved.filter(((F.col("family") == "spike") & (F.col("value") > 95)) | ((F.col("family") == "freeze") & (F.col("value") < 5)))
    return found, events


_EXPERTS = "count(*) FILTER (value > 95) AS a, count(*) FILTER (value < 5) AS b, CAST(count(*) FILTER (value > 95) * 4 > count(*) AS INT) AS c, max(value) AS d, avg(value) AS e"
_LONG = "(SELECT {key}, unnest(['bad_frame:high', 'bad_frame:low', 'issue:many_high', 'max_value', 'mean_value']) AS expert, unnest([a, b, c, d, e]::DOUBLE[]) AS score FROM {t})"
REPLAY = f"""{FRAMES}, n AS (SELECT episode, count(*) AS n FROM f GROUP BY episode),
i AS (SELECT episode, n // 4 AS s, n // 4 + 8 AS u, family, level, dose FROM n, (VALUES ('spike'), ('freeze'), ('noise')) AS x(family), (VALUES ('low', 1.0), ('high', 2.0)) AS y(level, dose)),
m AS (SELECT i.episode, family, level, s, u, frame, CASE WHEN frame < s OR frame >= u THEN value WHEN family = 'spike' THEN value + 40 * dose WHEN family = 'freeze' THEN value / (1 + 9 * dose) ELSE value + 2 * dose END AS value FROM i JOIN f ON f.episode = i.episode),
p AS (SELECT episode, {_EXPERTS} FROM f GROUP BY episode), q AS (SELECT episode, family, level, {_EXPERTS} FROM m GROUP BY episode, family, level),
d AS (SELECT l.episode, l.family, l.level, l.expert, r.score AS baseline, l.score AS intervened, l.score - r.score AS delta, abs(l.score - r.score) > 1e-12 AS changed,
  (l.family = 'spike' AND l.expert IN ('bad_frame:high', 'max_value')) OR (l.family = 'freeze' AND l.expert = 'bad_frame:low') OR (l.family = 'noise' AND l.expert = 'mean_value') AS target
  FROM {_LONG.format(key='episode, family, level', t='q')} l JOIN {_LONG.format(key='episode', t='p')} r USING (episode, expert))"""


@query(f"WITH {REPLAY} SELECT episode, family, level, expert, round(baseline, 6) AS baseline, round(intervened, 6) AS intervened, round(delta, 6) AS delta, changed, target FROM d")
def intervention_deltas(spark, sf):
    found, _ = _replay(spark, sf)
    return found.select("episode", "family", "level", "expert", *[r6(F.col(c)).alias(c) for c in ("baseline", "intervened", "delta")], "changed", "target")


@query(f"""WITH {REPLAY}, r AS (SELECT episode, family, level, count(*) FILTER (changed AND target) AS hits, coalesce(sum(abs(delta) / (1 + abs(baseline))) FILTER (changed AND target), 0) AS response FROM d GROUP BY episode, family, level),
o AS (SELECT family, avg(CAST(h.response + 1e-12 >= l.response AS DOUBLE)) AS rate FROM r h JOIN r l USING (episode, family) WHERE h.level = 'high' AND l.level = 'low' GROUP BY family),
e AS (SELECT episode, family, level, count(*) FILTER (frame >= s AND frame < u) / count(*)::DOUBLE AS precision FROM m WHERE (family = 'spike' AND value > 95) OR (family = 'freeze' AND value < 5) GROUP BY episode, family, level)
SELECT family, count(*) AS interventions, round(avg(CAST(hits > 0 AS DOUBLE)), 6) AS target_hit_rate, round(avg(hits), 6) AS mean_target_changed, round(avg(precision), 6) AS mean_precision, round(any_value(rate), 6) AS monotonic_rate
FROM r LEFT JOIN e USING (episode, family, level) JOIN o USING (family) GROUP BY family""")
def intervention_replay(spark, sf):
    found, events = _replay(spark, sf)
    answered = cut(interventions.responses(found, "episode"), "responses")
    out = interventions.by_family(answered, interventions.monotonic(answered, "episode"), interventions.localisation(events))
    return out.select("family", "interventions", *[r6(F.col(c)).alias(c) for c in ("target_hit_rate", "mean_target_changed", "mean_precision", "monotonic_rate")])
