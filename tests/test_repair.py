"""One-Euro filters, episode repair and its gate against step-by-step versions."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.functions import quaternion
from tidemark.operators import filters, repair
from tidemark.plans import extra

SF = "/root/testdata/sf0.001"


def alpha(cutoff, dt):
    return 1 / (1 + 1 / (2 * math.pi * max(cutoff, 1e-9)) / dt)


def plain_vectors(x, fps, min_cutoff=2.0, beta=0.7, derivative_cutoff=1.0):
    """A run, row by row."""
    dt, out = 1 / fps, [np.array(x[0], float)]
    rate, before = np.zeros(len(x[0])), np.array(x[0], float)
    for v in x[1:]:
        v = np.array(v, float)
        rate = rate + alpha(derivative_cutoff, dt) * ((v - before) / dt - rate)
        out.append(out[-1] + alpha(min_cutoff + beta * math.sqrt((rate**2).sum()), dt) * (v - out[-1]))
        before = v
    return np.array(out)


def angle_between(a, b):
    return math.acos(max(-1.0, min(1.0, (np.trace(a.T @ b) - 1) / 2)))


def turned(a, b, share):
    """Rotation a turned towards b by a share of the angle between them, through the axis of a'b."""
    m = a.T @ b
    angle = angle_between(a, b)
    if angle < 1e-12:
        return a
    axis = np.array([m[2, 1] - m[1, 2], m[0, 2] - m[2, 0], m[1, 0] - m[0, 1]]) / (2 * math.sin(angle))
    k = np.array([[0, -axis[2], axis[1]], [axis[2], 0, -axis[0]], [-axis[1], axis[0], 0]])
    return a @ (np.eye(3) + math.sin(share * angle) * k + (1 - math.cos(share * angle)) * k @ k)


def plain_rotations(x, fps, min_cutoff=2.0, beta=0.7, derivative_cutoff=1.0):
    dt, out, rate = 1 / fps, [x[0]], 0.0
    for before, m in zip(x, x[1:], strict=False):
        rate += alpha(derivative_cutoff, dt) * (angle_between(before, m) / dt - rate)
        out.append(turned(out[-1], m, alpha(min_cutoff + beta * abs(rate), dt)))
    return np.array(out)


def rotations(rng, n, size=0.3):
    angles = np.cumsum(rng.normal(0, size, (n, 3)), axis=0)
    q = np.concatenate([np.ones((n, 1)), np.tan(np.clip(angles, -1.2, 1.2) / 2)], axis=1)
    return quaternion.to_matrix(q / np.linalg.norm(q, axis=1, keepdims=True))


def runs_of(mask):
    found, start = [], None
    for i, m in enumerate([*mask, False]):
        if m and start is None:
            start = i
        if not m and start is not None:
            found.append((start, i))
            start = None
    return found


@pytest.mark.parametrize("batch", [3, 10_000])
def test_scalars_of_many_entities_follow_the_rows(spark, batch):
    """Runs go on across Arrow batches, and each entity has its own frame rate."""
    rng = np.random.default_rng(5)
    rows, want = [], {}
    for e in range(9):
        x = [None if rng.random() < 0.2 else float(v) for v in np.cumsum(rng.normal(0, 3, 40 + e))]
        x[7] = float("nan")
        rows += [(e, i, v, 20.0 + e) for i, v in enumerate(x)]
        for a, b in runs_of([v is not None and v == v for v in x]):
            want |= {(e, a + i): y for i, (y,) in enumerate(plain_vectors([[v] for v in x[a:b]], 20.0 + e, 1.0, 0.1))}
    df = spark.createDataFrame(rows, "e int, i int, v double, fps double").repartition(7)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    try:
        got = repair.smoothed(df, "e", "i", "v", "vector", 1, "fps", min_cutoff=1.0, beta=0.1).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(got) == len(rows) and {(r["e"], r["i"]) for r in got if r["smooth"] is not None} == set(want)
    assert all(abs(r["smooth"] - want[r["e"], r["i"]]) < 1e-9 for r in got if r["smooth"] is not None)


def test_rotations_stay_rotations_and_follow_the_rows(spark):
    rng = np.random.default_rng(6)
    rows, want = [], {}
    for e in range(4):
        m = rotations(rng, 30, 0.1 + 0.3 * e)
        mask = rng.random(30) > 0.15
        rows += [(e, i, m[i].reshape(-1).tolist() if mask[i] else None) for i in range(30)]
        for a, b in runs_of(mask):
            want |= {(e, a + i): y for i, y in enumerate(plain_rotations(m[a:b], 30.0))}
    df = spark.createDataFrame(rows, "e int, i int, m array<double>").repartition(3)
    got = {(r["e"], r["i"]): r["smooth"] for r in filters.one_euro_rotations(df, "e", "i", "m", 30.0).collect()}
    assert len(got) == len(rows)
    for key, m in got.items():
        assert (m is None) == (key not in want)
        if m:
            m = np.reshape(m, (3, 3))
            assert abs(m - want[key]).max() < 1e-6 and abs(m.T @ m - np.eye(3)).max() < 1e-10 and abs(np.linalg.det(m) - 1) < 1e-10


SCHEMA = "episode_index long, frame_index int, state_mask array<boolean>, extrinsics_w2c array<double>, `observation.state` array<double>, note string, left_kept boolean, " + ", ".join(f"{s}_{n} array<double>" for s in ("left", "right") for n in repair.STREAMS)


def episode(rng, e, n, broken=()):
    """Rows of an episode; broken frames have a translation of two entries, one that is not finite, or no state."""
    at = np.cumsum(rng.normal(0, 0.05, (2, n, 3)), axis=1)
    wrist = [rotations(rng, n, 0.05) for _ in range(2)]
    joints = [np.stack([rotations(rng, n, 0.05) for _ in range(15)], axis=1) for _ in range(2)]
    camera = np.tile(np.eye(4), (n, 1, 1))
    camera[:, :3, :3], camera[:, :3, 3] = rotations(rng, n), rng.normal(0, 1, (n, 3))
    mask = rng.random((n, 2)) > 0.2
    rows = []
    for i in range(n):
        sides = [x for s in range(2) for x in (at[s, i].tolist(), wrist[s][i].reshape(-1).tolist(), joints[s][i].reshape(-1).tolist())]
        row = [e, i, mask[i].tolist(), camera[i].reshape(-1).tolist(), [float(k) for k in range(122)], f"n{i}", bool(i % 9), *sides]
        if i in broken:
            row[7] = [row[7][:2], [1.0, math.inf, 0.0], None][i % 3]
            mask[i, 0] = False
        rows.append(row)
    mask[:, 0] &= [bool(r[6]) for r in rows]
    return rows, mask, at, wrist, joints, camera


def test_repair_changes_runs_alone(spark):
    rng = np.random.default_rng(8)
    episodes = [episode(rng, e, 24, broken=(4, 5, 15) if e == 1 else ()) for e in range(3)]
    rows = [r for x in episodes for r in x[0]]
    rows[2][2], rows[3][2], rows[6][4], rows[10][3] = None, [True], None, [1.0]  # no mask, half a mask, no state, no camera
    episodes[0][1][2], episodes[0][1][3] = False, (episodes[0][1][3][0] or rows[3][6], False)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = {(r["episode_index"], r["frame_index"]): r.asDict() for r in repair.repaired(df, fps=25.0, position={"beta": 0.3}).collect()}
    assert len(got) == len(rows)
    names = [f.name for f in df.schema]
    for e, (own, mask, at, wrist, joints, camera) in enumerate(episodes):
        want = {i: dict(zip(names, r, strict=True)) for i, r in enumerate(own)}
        for s, (side, first) in enumerate(repair.PLACES.items()):
            for a, b in runs_of(mask[:, s]):
                p, w = plain_vectors(at[s, a:b], 25.0, beta=0.3), plain_rotations(wrist[s][a:b], 25.0)
                j = np.stack([plain_rotations(joints[s][a:b, k], 25.0) for k in range(15)], axis=1)
                for i in range(a, b):
                    row = want[i]
                    row |= {f"{side}_transl_world": p[i - a], f"{side}_orient_world": w[i - a].reshape(-1), f"{side}_hand_pose": j[i - a].reshape(-1)}
                    if row["observation.state"] is not None and len(row["extrinsics_w2c"]) == 16:
                        state, turn = np.array(row["observation.state"], float), camera[i, :3, :3]
                        state[first : first + 3] = turn @ p[i - a] + camera[i, :3, 3]
                        state[first + 3 : first + 6] = quaternion.matrix_to_euler(turn @ w[i - a])
                        state[first + 6 : first + 51] = quaternion.matrix_to_euler(j[i - a]).reshape(-1)
                        row["observation.state"] = state
        for i, row in want.items():
            for name, value in row.items():
                found = got[e, i][name]
                if isinstance(value, np.ndarray):
                    assert np.abs(np.array(found) - value).max() < 1e-6, (e, i, name)
                else:
                    assert found == value, (e, i, name)


def test_fidelity_and_gate(spark):
    rng = np.random.default_rng(9)
    episodes = [episode(rng, e, 30) for e in range(4)]
    before = spark.createDataFrame([r for x in episodes for r in x[0]], SCHEMA).drop("left_kept")
    after = repair.repaired(before)
    verdict = {r["episode_index"]: r.asDict() for r in repair.fidelity(before, after, translation_mm=80.0, rotation_deg=9.0).collect()}
    new = {(r["episode_index"], r["frame_index"]): r for r in after.collect()}
    for e, (own, _, at, wrist, joints, _) in enumerate(episodes):
        shares, near = [], True
        for s, side in enumerate(("left", "right")):
            mask = [r[2][s] for r in own]
            p = np.array([new[e, i][f"{side}_transl_world"] for i in range(30)])
            w = np.array([new[e, i][f"{side}_orient_world"] for i in range(30)]).reshape(-1, 3, 3)
            j = np.array([new[e, i][f"{side}_hand_pose"] for i in range(30)]).reshape(-1, 15, 3, 3)
            pairs = [i for i in range(29) if mask[i] and mask[i + 1]]
            path = lambda x: sum(np.linalg.norm(x[i + 1] - x[i]) for i in pairs)  # noqa: B023, E731
            turn = lambda x: sum(angle_between(x[i], x[i + 1]) for i in pairs)  # noqa: B023, E731
            share = [path(p) / path(at[s]), turn(w) / turn(wrist[s]), sum(turn(j[:, k]) for k in range(15)) / sum(turn(joints[s][:, k]) for k in range(15))]
            valid = [i for i in range(30) if mask[i]]
            off = [[1000 * np.linalg.norm(p[i] - at[s][i]) for i in valid], [math.degrees(angle_between(wrist[s][i], w[i])) for i in valid], [math.degrees(max(angle_between(joints[s][i, k], j[i, k]) for k in range(15))) for i in valid]]
            for name, value in zip(("translation_path_retention", "wrist_motion_retention", "joint_motion_retention"), share, strict=True):
                assert verdict[e][f"{side}_{name}"] == pytest.approx(value, rel=1e-5)
            for name, value, most in zip(("translation_correction_p99_mm", "wrist_correction_p99_deg", "joint_correction_p99_deg"), off, (80.0, 9.0, 9.0), strict=True):
                q = np.percentile(value, 99)
                assert verdict[e][f"{side}_{name}"] == pytest.approx(q, abs=1e-4)
                near &= q <= most
            shares += share
        assert verdict[e]["passes_motion_retention_gate"] == (min(shares) >= 0.65) and verdict[e]["passes_correction_gate"] == near
    schema = "episode_index long, passes_fidelity_gate boolean"
    kept = {(r["episode_index"], r["frame_index"]): r for r in repair.gated(before, after, spark.createDataFrame([(0, True), (1, False), (3, True)], schema)).collect()}
    assert len(kept) == 120
    for (e, i), r in kept.items():
        assert r["repair_kept"] == (e in (0, 3)) and r["left_hand_pose"] == (new[e, i]["left_hand_pose"] if e in (0, 3) else episodes[e][0][i][9])


def test_nothing_moves_or_is_there(spark):
    still = [r[:] for r in episode(np.random.default_rng(1), 0, 5)[0]]
    for r in still:
        r[2], r[7:] = [True, False], [still[0][7], np.eye(3).reshape(-1).tolist(), np.tile(np.eye(3).reshape(-1), 15).tolist()] * 2
    before = spark.createDataFrame(still, SCHEMA)
    (v,) = repair.fidelity(before, repair.repaired(before)).collect()
    assert v["left_translation_path_retention"] is None and not v["passes_motion_retention_gate"] and v["right_wrist_correction_p99_deg"] is None and not v["passes_fidelity_gate"]
    assert repair.repaired(before.limit(0)).collect() == []


def test_whole_plan_moves_frames_once(spark):
    plan = repair.repaired(extra.motion(spark, SF))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert filters.one_euro(extra.frames(spark, SF), "episode", "frame", "value", 30.0).filter(F.col("smooth").isNull()).count() == 0


def test_filters_take_few_rows_at_once(spark):
    """Whatever Arrow batches the session has, a filter holds STEP_ROWS of them (F5), and runs go on from slice to slice."""
    import pyarrow as pa

    df = spark.range(3 * repair.STEP_ROWS + 5).coalesce(1).selectExpr("1 as e", "id as fr")

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([b.num_rows] * b.num_rows, pa.int64())], [*b.schema.names, "rows"])

    got = repair._streamed(df, "e", "fr", run, ("rows", "long"))
    assert got.agg({"rows": "max"}).first()[0] == repair.STEP_ROWS and got.count() == 3 * repair.STEP_ROWS + 5
