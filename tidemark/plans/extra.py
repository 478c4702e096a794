"""Filters, strict readers and further decisions."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import ladders, linalg
from ..functions.stats import r6
from ..operators import filters, repair, validation
from ..sources.shared import cut, fresh_path
from ..sources.tables import frames, json_lines, table
from ..streaming import jobs
from .registry import query
from .series import FRAMES


#: The One-Euro step in SQL: the smoothing factor of a cutoff at 30 frames a second.
_A = "(1 / (1 + 30.0::DOUBLE / (2 * pi() * greatest({}, 1e-9))))"


@query(f"""WITH RECURSIVE {FRAMES}, v AS MATERIALIZED (SELECT episode, frame, CASE WHEN valid THEN value END AS x FROM f),
s(episode, frame, x, y, d) AS (SELECT episode, frame, x, x, 0::DOUBLE FROM v WHERE frame = 0
UNION ALL SELECT v.episode, v.frame, v.x, CASE WHEN v.x IS NULL OR s.x IS NULL THEN v.x ELSE s.y + {_A.format(f"1.0 + 0.1 * abs(s.d + {_A.format('1.0')} * ((v.x - s.x) * 30 - s.d))")} * (v.x - s.y) END,
  CASE WHEN v.x IS NULL OR s.x IS NULL THEN 0 ELSE s.d + {_A.format('1.0')} * ((v.x - s.x) * 30 - s.d) END FROM s JOIN v ON v.episode = s.episode AND v.frame = s.frame + 1)
SELECT episode, frame, round(y, 4) AS smooth FROM s""")
def one_euro_filter(spark, sf):
    f = frames(spark, sf).withColumn("v", F.when(F.col("valid"), F.col("value")))
    return filters.one_euro(f, "episode", "frame", "v", 30.0).select("episode", "frame", F.round("smooth", 4).alias("smooth"))


@query()
def rotation_filter(spark, sf):
    e = table(spark, sf, "embeddings").select("label", "vec_id", F.array(*linalg.euler_to_matrix(linalg.part("embedding", 12, 3))).alias("m"))
    out = filters.one_euro_rotations(e, "label", "vec_id", "m", 30.0)
    return out.select("label", "vec_id", F.round(linalg.orthogonality_error(linalg.part("smooth", 0, 9)), 6).alias("error"), F.round(F.get("smooth", F.lit(0)), 5).alias("m00"))


def motion(spark, sf):
    """Vectors as frames of a body: 64 of them an episode, drifting, with two sides, a mask, a camera and a state."""
    fr, e = F.col("vec_id") % 64, "embedding"
    drift = lambda first, n: [c * 0.05 + fr * 0.01 for c in linalg.part(e, first, n)]
    flat = lambda columns: F.array(*columns)
    angle = lambda k: F.get(F.col(e), k).cast("double") * 0.05 + fr * 0.01
    joints = lambda first: F.flatten(F.transform(F.sequence(F.lit(first), F.lit(first + 14)), lambda j: flat(linalg.euler_to_matrix([angle(j), angle(j + 1), angle(j + 2)]))))
    turn = linalg.euler_to_matrix(drift(57, 3))
    camera = [*turn[0:3], *linalg.part(e, 60, 1), *turn[3:6], *linalg.part(e, 61, 1), *turn[6:9], *linalg.part(e, 62, 1), *map(F.lit, (0.0, 0.0, 0.0, 1.0))]
    sides = {f"{s}_{name}": c for s, k in (("left", 0), ("right", 20)) for name, c in (("transl_world", flat(drift(k, 3))), ("orient_world", flat(linalg.euler_to_matrix(drift(k + 3, 3)))), ("hand_pose", joints(k + 6)))}
    mask = F.array(*[c > -0.15 for c in linalg.part(e, 30, 2)])
    return table(spark, sf, "embeddings").select(
        F.floor(F.col("vec_id") / 64).alias("episode_index"), fr.alias("frame_index"), mask.alias("state_mask"), flat(camera).alias("extrinsics_w2c"),
        F.transform(F.sequence(F.lit(0), F.lit(121)), lambda k: k.cast("double")).alias("observation.state"), *[c.alias(n) for n, c in sides.items()],
    )


_P = [f"CAST(embedding[{k + 1}] AS DOUBLE) * 0.05 + (vec_id % 64) * 0.01" for k in range(3)]
_D = [f"(s.d{k} + {_A.format('1.0')} * ((v.x{k} - s.x{k}) * 30 - s.d{k}))" for k in range(3)]
_Y = _A.format(f"2.0 + 0.7 * sqrt({' + '.join(f'{d} * {d}' for d in _D)})")


@query(f"""WITH RECURSIVE v AS MATERIALIZED (SELECT vec_id // 64 AS e, vec_id % 64 AS fr, row_number() OVER (PARTITION BY vec_id // 64 ORDER BY vec_id) AS k, embedding[31] > -0.15 AS ok, {', '.join(f'{p} AS x{k}' for k, p in enumerate(_P))} FROM embeddings),
s AS (SELECT *, {', '.join(f'x{k} AS y{k}, 0::DOUBLE AS d{k}' for k in range(3))} FROM v WHERE k = 1
UNION ALL SELECT v.*, {', '.join(f'CASE WHEN v.ok AND s.ok THEN s.y{k} + {_Y} * (v.x{k} - s.y{k}) ELSE v.x{k} END, CASE WHEN v.ok AND s.ok THEN {_D[k]} ELSE 0 END' for k in range(3))} FROM s JOIN v ON v.e = s.e AND v.k = s.k + 1)
SELECT e AS episode_index, fr AS frame_index, {', '.join(f'round(y{k}, 6) + 0.0 AS {n}' for k, n in enumerate('xyz'))}, NOT ok AS gap FROM s""")
def repaired_translation(spark, sf):
    out = repair.repaired(motion(spark, sf))
    return out.select("episode_index", "frame_index", *[r6(c).alias(n) for c, n in zip(linalg.part("left_transl_world", 0, 3), "xyz", strict=True)], (~F.get("state_mask", F.lit(0))).alias("gap"))


@query()
def episode_repair(spark, sf):
    """Frames repaired, held against what they were, and taken back where the gate fails."""
    before = cut(motion(spark, sf))
    after = cut(repair.repaired(before))
    out = repair.gated(before, after, repair.fidelity(before, after, retention=0.5, translation_mm=100.0, rotation_deg=20.0))
    places = {"wrist_x": 3, "joint_x": 6, "right_point_z": 63, "shape": 51}
    return out.select("episode_index", "frame_index", "repair_kept", *[r6(F.get("`observation.state`", F.lit(k))).alias(n) for n, k in places.items()])


@query()
def repair_fidelity(spark, sf):
    before = cut(motion(spark, sf))
    found = repair.fidelity(before, repair.repaired(before), retention=0.5, translation_mm=100.0, rotation_deg=20.0)
    return found.select(*[r6(F.col(n)).alias(n) if t == "double" else F.col(n) for n, t in found.dtypes])


@query()
def nms_counts(spark, sf):
    box = lambda k: F.struct(*[x.alias(n) for x, n in zip((linalg.part("embedding", k, 1)[0], linalg.part("embedding", k + 1, 1)[0], linalg.part("embedding", k, 1)[0] + 0.2, linalg.part("embedding", k + 1, 1)[0] + 0.2, F.abs(linalg.part("embedding", k + 2, 1)[0])), ("x1", "y1", "x2", "y2", "confidence"), strict=True)])
    e = table(spark, sf, "embeddings").select("vec_id", F.array(*[box(3 * k) for k in range(6)]).alias("boxes"))
    return filters.nms(e, "boxes", 0.05, 0.5).select("vec_id", "kept")


@query("""WITH p AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) - 1 AS k FROM orders) SELECT o_orderkey, CAST(CASE WHEN k % 16 < 8 THEN k % 16 ELSE 15 - k % 16 END AS INT) AS worker FROM p""")
def balanced_load(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return filters.balanced_groups(o, "o_orderkey", "o_totalprice", 8).select("o_orderkey", "worker")


@query()
def sample_frame_selection(spark, sf):
    return filters.sample_frames(frames(spark, sf), "episode", "frame", "value", "valid")


@query(f"""WITH {FRAMES}, m AS (SELECT episode, count(*) AS n, count(*) FILTER (event_type = 'click') AS c, count(*) FILTER (event_type = 'signup') AS s FROM f GROUP BY episode)
SELECT tier, decision, count(*) AS episodes FROM (SELECT CASE WHEN c * 100 >= 30 * n THEN 'bronze' WHEN s * 100 >= 20 * n THEN 'silver' ELSE 'gold' END AS tier, CASE WHEN c * 100 >= 30 * n THEN 'reject' WHEN s * 100 >= 20 * n THEN 'rework' ELSE 'accept' END AS decision FROM m) GROUP BY tier, decision""")
def tier_and_decision(spark, sf):
    kind = F.col("event_type")
    m = frames(spark, sf).groupBy("episode").agg(F.count(F.lit(1)).alias("n"), F.count_if(kind == "click").alias("c"), F.count_if(kind == "signup").alias("s"))
    found = validation.issues(m, "episode", [("beta_drift", F.col("c") * 100 >= 30 * F.col("n"), "error"), ("mask_flicker", F.col("s") * 100 >= 20 * F.col("n"), "warning")])
    return validation.decide(m, found, "episode", ["mask_flicker"], "rework").groupBy("tier", "decision").agg(F.count(F.lit(1)).alias("episodes"))


@query("SELECT user_id, count(*) AS n, CAST(sum(CAST(json_extract(props, '$.k') AS BIGINT)) AS BIGINT) AS k FROM events GROUP BY user_id")
def jsonl_failfast_reader(spark, sf):
    """Events written as JSON lines in the shared folder and read back with a declared schema that stops at a broken line."""
    path = fresh_path(spark, "lines")
    table(spark, sf, "events").select("user_id", F.from_json("props", "k long").alias("props")).write.json(path)
    lines = json_lines(spark, path, "user_id long, props struct<k: long>")
    return lines.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.sum("props.k").alias("k"))


@query("""WITH w AS (SELECT event_type, time_bucket(INTERVAL '1 day', ts) AS d, value FROM events), s AS (SELECT event_type, d AS start, value FROM w UNION ALL SELECT event_type, d - INTERVAL '1 day', value FROM w) SELECT event_type, start, count(*) AS n FROM s GROUP BY event_type, start""")
def stream_sliding_windows(spark, sf):
    from .streams import _clock, _utc

    e = _utc(jobs.read(spark, sf, "events.parquet")).groupBy(F.window("at", "2 days", "1 day").alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"))
    return jobs.run(e, "complete").select("event_type", _clock("w.start").alias("start"), "n")


@query(f"""WITH {FRAMES}, h AS (SELECT episode, count(*) AS n, round(avg(value), 6) AS mean FROM f GROUP BY episode), r AS (SELECT *, row_number() OVER (ORDER BY mean DESC, episode) AS place FROM h) SELECT episode, n, mean, place FROM r WHERE place <= 15""")
def slowest_shards(spark, sf):
    h = frames(spark, sf).groupBy("episode").agg(F.count(F.lit(1)).alias("n"), r6(F.avg("value")).alias("mean"))
    top = h.orderBy(F.col("mean").desc(), "episode").limit(15)
    return top.withColumn("place", F.row_number().over(W.orderBy(F.col("mean").desc(), "episode")))


@query("""SELECT page_id, CASE WHEN regexp_matches(url, '^https://') THEN 'secure' WHEN regexp_matches(url, '[?]') THEN 'dynamic' WHEN regexp_matches(url, '#') THEN 'anchored' ELSE 'plain' END AS adapter FROM pages""")
def adapter_detection(spark, sf):
    u = F.col("url")
    return table(spark, sf, "pages").select("page_id", ladders.ladder((u.startswith("https://"), "secure"), (u.contains("?"), "dynamic"), (u.contains("#"), "anchored"), otherwise="plain").alias("adapter"))
