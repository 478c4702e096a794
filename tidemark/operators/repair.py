"""Repair of entities' motion: adaptive low-pass filters that restart in every valid run, and the gate that keeps or rejects them.

The recursion needs order, not a Python call per row: entities stream through tasks in sorted order, and within an Arrow
batch all runs advance together, a step for the next row of each. The state of the run that a batch breaks off is carried
into the next batch, so memory doesn't grow with an entity. Rows outside runs, and rows whose values are null, not finite
or of another length, end a run and stay as they are.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import linalg, quaternion

#: Options of a filter: cutoff at rest, gain of the cutoff with speed, cutoff of the speed itself (all in hertz).
OPTIONS = {"min_cutoff": 2.0, "beta": 0.7, "derivative_cutoff": 1.0}


def alpha(cutoff, dt):
    """Smoothing factor of a first-order low-pass filter."""
    return 1.0 / (1.0 + 1.0 / (2 * math.pi * np.maximum(cutoff, 1e-9) * dt))


def vector_step(state: tuple, x: np.ndarray, dt: np.ndarray, o: dict) -> tuple:
    """(input, output, rate) of runs [n, k, d] after the next inputs; one cutoff a vector, from its filtered input rate."""
    before, out, rate = state
    dt = dt[:, None]
    rate = rate + alpha(o["derivative_cutoff"], dt)[..., None] * ((x - before) / dt[..., None] - rate)
    speed = np.linalg.norm(rate, axis=-1)
    return x, out + alpha(o["min_cutoff"] + o["beta"] * speed, dt)[..., None] * (x - out), rate


def rotation_step(state: tuple, q: np.ndarray, dt: np.ndarray, o: dict) -> tuple:
    """The same on unit quaternions [n, k, 4]: the rate is angular speed, and the output is drawn along the shorter arc."""
    before, out, rate = state
    dt = dt[:, None]
    dot = (before * q).sum(-1)
    q = np.where(dot[..., None] < 0, -q, q)
    speed = 2.0 * np.arccos(np.minimum(1.0, np.abs(dot))) / dt
    rate = rate + alpha(o["derivative_cutoff"], dt)[..., None] * (speed[..., None] - rate)
    return q, quaternion.slerps(out, q, alpha(o["min_cutoff"] + o["beta"] * rate[..., 0], dt)), rate


STEPS = {"vector": vector_step, "rotation": rotation_step}
#: Rows that a filter takes at once, whatever the session's Arrow batches are: what Python holds is in proportion to them.
STEP_ROWS = 1024


def along(kind: str, x: np.ndarray, starts: np.ndarray, lengths: np.ndarray, dt: np.ndarray, options: dict, carried: tuple | None) -> tuple[np.ndarray, tuple | None]:
    """(x with its runs filtered, state of the last run): all runs take their steps together, the longest ones last.

    dt: seconds between rows, for each run. carried: the state in which the first run goes on, if it does.
    """
    step, o, out = STEPS[kind], OPTIONS | options, x.copy()
    if not len(starts):
        return out, None
    order = np.argsort(-lengths, kind="stable")
    at, n, dt = starts[order], lengths[order], dt[order]
    zero = np.zeros_like(x[at]) if kind == "vector" else np.zeros((*x[at].shape[:2], 1))
    state = (x[at], x[at], zero)
    if carried is not None:
        first = np.flatnonzero(order == 0)
        for part, value in zip(state, step(carried, x[at[first]], dt[first], o), strict=True):
            part[first] = value
    state = tuple(np.array(p) for p in state)
    last = tuple(p.copy() for p in state)
    out[at] = state[1]
    for t in range(1, int(n[0])):
        m = int(np.searchsorted(-n, -t, side="left"))  # runs longer than t
        for kept, part in zip(last, state, strict=True):
            kept[m : len(part)] = part[m:]
        state = step(tuple(p[:m] for p in state), x[at[:m] + t], dt[:m], o)
        out[at[:m] + t] = state[1]
    for kept, part in zip(last, state, strict=True):
        kept[: len(part)] = part
    end = np.flatnonzero(order == len(starts) - 1)
    return out, tuple(p[end] for p in last)


def _numbers(column, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(values [rows, width] of an Arrow list or number column, whether a row has that many, all finite)."""
    import pyarrow as pa
    import pyarrow.compute as pc

    if not pa.types.is_list(column.type):
        x = column.cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(-1, 1)
        return x.copy(), np.isfinite(x[:, 0])
    there = pc.fill_null(pc.equal(pc.list_value_length(column), width), False).to_numpy(zero_copy_only=False)
    x = np.full((len(column), width), np.nan)
    x[there] = column.filter(pa.array(there)).flatten().cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(-1, width)
    return x, np.isfinite(x).all(1)


def _replaced(column, changed: np.ndarray, x: np.ndarray):
    """The Arrow column with the changed rows taken from x."""
    import pyarrow as pa

    if not pa.types.is_list(column.type):
        new = pa.array(x[changed, 0]).cast(column.type)
    else:
        flat = pa.array(x[changed].reshape(-1)).cast(column.type.value_type)
        new = pa.ListArray.from_arrays(pa.array(np.arange(int(changed.sum()) + 1, dtype=np.int32) * x.shape[1]), flat).cast(column.type)
    place = np.arange(len(column))
    place[changed] = len(column) + np.arange(int(changed.sum()))
    return pa.concat_arrays([column, new]).take(pa.array(place))


class Track:
    """Runs of one mask over the batches of a partition, with the filters that follow them."""

    def __init__(self, streams: list[tuple[str, int, dict]]):
        self.streams = streams  # (kind, entries a row, options)
        self.entity, self.open, self.carried = None, False, [None] * len(streams)

    def __call__(self, entity: list, valid: np.ndarray, dt: np.ndarray, values: list[np.ndarray]) -> list[np.ndarray]:
        """values [rows, k, d] of each stream, filtered in the runs of valid rows of one entity."""
        if not len(valid):
            return values
        change = np.ones(len(valid), bool)
        change[1:] = [a != b for a, b in zip(entity[1:], entity, strict=False)]
        goes_on = bool(valid[0] and self.open and entity[0] == self.entity)
        begins = valid & (change | ~np.concatenate([[False], valid[:-1]]))
        ends = valid & np.concatenate([change[1:] | ~valid[1:], [True]])
        starts, stops = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        out = []
        for k, ((kind, _, options), x) in enumerate(zip(self.streams, values, strict=True)):
            y, state = along(kind, x, starts, stops - starts, dt[starts], options, self.carried[k] if goes_on else None)
            out.append(y)
            self.carried[k] = state
        self.entity, self.open = entity[-1], bool(valid[-1])
        return out


def _ordered(df: DataFrame, by: str, order: str) -> DataFrame:
    """Whole entities in partitions, in order: what a recursion along entities needs, and the only exchange of it."""
    return df.repartition(by).sortWithinPartitions(by, order)


def _streamed(df: DataFrame, by: str, order: str, run, more: tuple[str, str] | None = None) -> DataFrame:
    """df through run (batches of all its columns under their names, in order), perhaps with one more column (name, type).

    Columns travel under numbers, as functions over batches take no names with dots.
    """
    import pyarrow as pa

    names = [*df.columns, *([more[0]] if more else [])]
    types = [*[f.dataType.simpleString() for f in df.schema], *([more[1]] if more else [])]
    plain = [f"_{i}" for i in range(len(names))]

    def renamed(batches):
        sliced = (b.slice(i, STEP_ROWS) for b in batches for i in range(0, b.num_rows, STEP_ROWS))
        for b in run(pa.RecordBatch.from_arrays(b.columns, names[: b.num_columns]) for b in sliced):
            yield pa.RecordBatch.from_arrays(b.columns, plain)

    ordered = _ordered(df, by, order).toDF(*plain[: len(df.columns)])
    return ordered.mapInArrow(renamed, ", ".join(map(" ".join, zip(plain, types, strict=True)))).toDF(*names)


def _seconds(batch, fps: float | str) -> np.ndarray:
    if isinstance(fps, str):
        return 1.0 / batch.column(fps).to_numpy(zero_copy_only=False).astype(float)
    return np.full(batch.num_rows, 1.0 / float(fps))


def smoothed(df: DataFrame, by: str, order: str, value: str, kind: str, width: int, fps: float | str, **options) -> DataFrame:
    """df with smooth, the filtered value: a number or an array of width (kind vector), or a row-major matrix of nine (rotation).

    fps: frames a second, or the column that has them. Values that are null or not finite come back as null and end a run.
    """
    import pyarrow as pa

    def run(batches):
        track = Track([(kind, 1, options)])
        for b in batches:
            x, valid = _numbers(b.column(value), width)
            shaped = quaternion.from_matrix(np.where(valid[:, None], x, np.eye(3).reshape(-1)))[:, None, :] if kind == "rotation" else np.where(valid[:, None], x, 0.0)[:, None, :]
            (y,) = track(b.column(by).to_pylist(), valid, _seconds(b, fps), [shaped])
            y = quaternion.to_matrix(y[:, 0]).reshape(-1, 9) if kind == "rotation" else y[:, 0]
            column = _replaced(pa.nulls(b.num_rows, b.column(value).type if pa.types.is_list(b.column(value).type) else pa.float64()), valid, y)
            yield pa.RecordBatch.from_arrays([*b.columns, column], [*b.schema.names, "smooth"])

    out = dict(df.dtypes)[value] if dict(df.dtypes)[value].startswith("array") else "double"
    return _streamed(df, by, order, run, ("smooth", out))


#: The streams of a side, as columns behind its name: kind, entries, width of the array.
STREAMS = {"transl_world": ("vector", 1, 3), "orient_world": ("rotation", 1, 9), "hand_pose": ("rotation", 15, 135)}
#: Places of a side's translation, wrist angles and joint angles in the state, from its first place on.
STATE_WIDTH, PLACES = 122, {"left": 0, "right": 61}


def repaired(frames: DataFrame, by: str = "episode_index", order: str = "frame_index", fps: float | str = 30.0, position: dict | None = None, rotation: dict | None = None) -> DataFrame:
    """frames with every column, and the streams of both sides filtered within their valid runs.

    A side is valid where its entry of state_mask (left, right) is true, and <side>_kept too if there is such a column. There
    the translation is filtered as a vector, wrist and joints as rotations, and the entries of observation.state that are
    drawn from them are computed anew with extrinsics_w2c: point and wrist angles in the camera, joint angles. Everything
    else, masks, gaps and shape parameters among them, stays as it is.
    """
    import pyarrow as pa
    import pyarrow.compute as pc

    options = {"vector": position or {}, "rotation": rotation or {}}

    def run(batches):
        tracks = {side: Track([(kind, k, options[kind]) for kind, k, _ in STREAMS.values()]) for side in PLACES}
        for b in batches:
            names, columns = b.schema.names, dict(zip(b.schema.names, b.columns, strict=True))
            entity, dt = b.column(by).to_pylist(), _seconds(b, fps)
            state, has_state = _numbers(b.column("observation.state"), STATE_WIDTH)
            camera, has_camera = _numbers(b.column("extrinsics_w2c"), 16)
            camera = camera.reshape(-1, 4, 4)
            written = np.zeros(b.num_rows, bool)
            for i, (side, first) in enumerate(PLACES.items()):
                mask = b.column("state_mask")
                two = pc.fill_null(pc.greater(pc.list_value_length(mask), i), False).to_numpy(zero_copy_only=False)
                valid = two.copy()
                valid[two] = pc.fill_null(pc.list_element(mask.filter(pa.array(two)), i), False).to_numpy(zero_copy_only=False)
                if f"{side}_kept" in columns:
                    valid &= pc.fill_null(columns[f"{side}_kept"], False).to_numpy(zero_copy_only=False)
                raw = {}
                for name, (_, _, width) in STREAMS.items():
                    raw[name], there = _numbers(columns[f"{side}_{name}"], width)
                    valid &= there
                shaped = []
                for name, (kind, k, width) in STREAMS.items():
                    x = np.where(valid[:, None], raw[name], 0.0)
                    shaped.append(quaternion.from_matrix(np.where(valid[:, None], x, np.tile(np.eye(3).reshape(-1), k)).reshape(-1, 3, 3)).reshape(-1, k, 4) if kind == "rotation" else x.reshape(-1, k, width // k))
                at, wrist, joints = tracks[side](entity, valid, dt, shaped)
                at, wrist, joints = at[:, 0], quaternion.to_matrix(wrist[:, 0]), quaternion.to_matrix(joints)
                for name, new in zip(STREAMS, (at, wrist.reshape(-1, 9), joints.reshape(-1, 135)), strict=True):
                    columns[f"{side}_{name}"] = _replaced(columns[f"{side}_{name}"], valid, new)
                rows = np.flatnonzero(valid & has_state & has_camera)
                turn = camera[rows, :3, :3]
                state[rows, first : first + 3] = np.einsum("nij,nj->ni", turn, at[rows]) + camera[rows, :3, 3]
                state[rows, first + 3 : first + 6] = quaternion.matrix_to_euler(turn @ wrist[rows])
                state[rows, first + 6 : first + 51] = quaternion.matrix_to_euler(joints[rows]).reshape(-1, 45)
                written[rows] = True
            columns["observation.state"] = _replaced(columns["observation.state"], written, state)
            yield pa.RecordBatch.from_arrays([columns[n] for n in names], names)

    return _streamed(frames, by, order, run)


# ---- motion fidelity ----


def fidelity(before: DataFrame, after: DataFrame, by: str = "episode_index", order: str = "frame_index", retention: float = 0.65, translation_mm: float = 30.0, rotation_deg: float = 8.0) -> DataFrame:
    """by, for each side the share of motion that is left and the 99th percentile of corrections, and the gates' verdicts.

    Motion: path of the translation, of the wrist and mean path of the joints over pairs of neighbouring valid frames. A share
    is null where there was no motion. The motion gate asks for one share at least, and all of them at least retention; the
    correction gate for all percentiles within bounds on both sides.
    """
    keep = [by, order]
    sides = list(PLACES)
    names = [f"{s}_{n}" for s in sides for n in STREAMS]
    left = before.select(*keep, "state_mask", *[F.col(c).alias(f"_o_{c}") for c in names])
    right = after.select(*keep, *[F.col(c).alias(f"_n_{c}") for c in names])
    rows = left.join(right, keep)
    w = W.partitionBy(by).orderBy(order)

    def joints(a: str, b: str) -> Column:
        """Degrees between the joints of two poses: the trace of a'b is the sum of the products of their entries."""
        products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
        trace = lambda j: F.aggregate(F.slice(products, j * 9 + 1, 9), F.lit(0.0), lambda s, x: s + x)
        return F.transform(F.sequence(F.lit(0), F.lit(14)), lambda j: F.degrees(F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), (trace(j) - 1) / 2)))))

    def gap(a, b) -> Column:
        return linalg.norm([x - y for x, y in zip(linalg.part(a, 0, 3), linalg.part(b, 0, 3), strict=True)])

    def turn(a, b) -> Column:
        return linalg.geodesic_degrees(linalg.part(a, 0, 9), linalg.part(b, 0, 9))

    lagged = {f"_l{c}": F.lag(c).over(w) for s in sides for v in ("_o", "_n") for c in (f"{v}_{s}_{n}" for n in STREAMS)}
    rows = rows.withColumns({"_lmask": F.lag("state_mask").over(w), **lagged})
    sums = []
    for i, s in enumerate(sides):
        valid = F.coalesce(F.get("state_mask", F.lit(i)), F.lit(False))
        pair = valid & F.coalesce(F.get("_lmask", F.lit(i)), F.lit(False))
        for v in ("_o", "_n"):
            p, o, h = (f"{v}_{s}_{n}" for n in STREAMS)
            moved = {"path": gap(f"_l{p}", p), "wrist": turn(f"_l{o}", o), "joint": F.aggregate(joints(f"_l{h}", h), F.lit(0.0), lambda total, x: total + x / 15.0)}
            sums += [F.sum(F.when(pair, c)).alias(f"{v}_{s}_{name}") for name, c in moved.items()]
        p, o, h = STREAMS
        corrected = {"translation_correction_p99_mm": gap(f"_o_{s}_{p}", f"_n_{s}_{p}") * 1000.0, "wrist_correction_p99_deg": turn(f"_o_{s}_{o}", f"_n_{s}_{o}"), "joint_correction_p99_deg": F.array_max(joints(f"_o_{s}_{h}", f"_n_{s}_{h}"))}
        sums += [F.percentile(F.when(valid, c), F.lit(0.99)).alias(f"{s}_{name}") for name, c in corrected.items()]
    found = rows.groupBy(by).agg(*sums)
    shares = {f"{s}_{name}": F.when(F.col(f"_o_{s}_{c}") > 1e-12, F.col(f"_n_{s}_{c}") / F.col(f"_o_{s}_{c}")) for s in sides for c, name in (("path", "translation_path_retention"), ("wrist", "wrist_motion_retention"), ("joint", "joint_motion_retention"))}
    found = found.withColumns(shares)
    moves = F.coalesce(F.least(*[F.col(c) for c in shares]) >= retention, F.lit(False))
    bounds = {"translation_correction_p99_mm": translation_mm, "wrist_correction_p99_deg": rotation_deg, "joint_correction_p99_deg": rotation_deg}
    near = F.lit(True)
    for s in sides:
        for name, most in bounds.items():
            near = near & F.coalesce(F.col(f"{s}_{name}") <= most, F.lit(False))
    found = found.withColumns({"passes_motion_retention_gate": moves, "passes_correction_gate": near}).withColumn("passes_fidelity_gate", F.col("passes_motion_retention_gate") & F.col("passes_correction_gate"))
    return found.drop(*[f"{v}_{s}_{c}" for v in ("_o", "_n") for s in sides for c in ("path", "wrist", "joint")])


def gated(before: DataFrame, after: DataFrame, verdict: DataFrame, by: str = "episode_index") -> DataFrame:
    """The rows of after for entities that pass the fidelity gate, those of before for the others, with repair_kept."""
    passed = verdict.filter("passes_fidelity_gate").select(by)
    kept = after.join(passed, by, "left_semi").withColumn("repair_kept", F.lit(True))
    return kept.unionByName(before.join(passed, by, "left_anti").withColumn("repair_kept", F.lit(False)))

