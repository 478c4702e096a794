"""Geometry of poses on the embedding table: places 0-2 position, 3-11 a matrix, 12-14 Euler angles; episodes are labels."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import ladders, linalg
from ..functions.stats import percentile, r6
from ..sources.tables import table
from .registry import query

#: The vector's first places in SQL, as doubles.
E = "e AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings)"


def _m(first):
    """Elements of a row-major 3x3 matrix in SQL (lists count from 1)."""
    return [f"v[{first + 1 + k}]" for k in range(9)]


def _mul(a, b):
    return [f"({a[3 * i]} * {b[j]} + {a[3 * i + 1]} * {b[3 + j]} + {a[3 * i + 2]} * {b[6 + j]})" for i in range(3) for j in range(3)]


def _t(a):
    return [a[3 * j + i] for i in range(3) for j in range(3)]


def _euler(e):
    sx, sy, sz, cx, cy, cz = (f"{f}({x})" for f in ("sin", "cos") for x in e)
    return [f"({cz} * {cy})", f"({cz} * {sy} * {sx} - {sz} * {cx})", f"({cz} * {sy} * {cx} + {sz} * {sx})", f"({sz} * {cy})", f"({sz} * {sy} * {sx} + {cz} * {cx})", f"({sz} * {sy} * {cx} - {cz} * {sx})", f"(-{sy})", f"({cy} * {sx})", f"({cy} * {cx})"]


def _geodesic(a, b):
    m = _mul(_t(a), b)
    return f"degrees(acos(greatest(-1.0, least(1.0, ({m[0]} + {m[4]} + {m[8]} - 1) / 2))))"


_A = _m(3)
_ATA = _mul(_t(_A), _A)
_ORTHO = "sqrt(" + " + ".join(f"pow({_ATA[3 * i + j]} - {1 if i == j else 0}, 2)" for i in range(3) for j in range(3)) + ")"
_DET = f"({_A[0]} * ({_A[4]} * {_A[8]} - {_A[5]} * {_A[7]}) - {_A[1]} * ({_A[3]} * {_A[8]} - {_A[5]} * {_A[6]}) + {_A[2]} * ({_A[3]} * {_A[7]} - {_A[4]} * {_A[6]}))"
_EULER = [f"v[{13 + k}]" for k in range(3)]


def _vectors(spark, sf):
    return table(spark, sf, "embeddings").select("vec_id", "label", "embedding")


@query(f"WITH {E} SELECT vec_id, round({_ORTHO}, 5) AS orthogonality, round(abs({_DET} - 1), 5) AS determinant_error FROM e")
def so3_errors(spark, sf):
    a = linalg.part("embedding", 3, 9)
    return _vectors(spark, sf).select("vec_id", F.round(linalg.orthogonality_error(a), 5).alias("orthogonality"), F.round(F.abs(linalg.determinant(a) - 1), 5).alias("determinant_error"))


def _next_euler():
    return [f"lead(v[{13 + k}]) OVER w" for k in range(3)]


@query(f"""WITH {E}, n AS (SELECT *, {', '.join(f'lead(v[{13 + k}]) OVER (PARTITION BY label ORDER BY vec_id) AS n{k}' for k in range(3))} FROM e)
SELECT vec_id, round({_geodesic(_euler(_EULER), _euler(['n0', 'n1', 'n2']))}, 3) AS degrees FROM n WHERE n0 IS NOT NULL""")
def euler_roundtrip_geodesic(spark, sf):
    w = W.partitionBy("label").orderBy("vec_id")
    e = _vectors(spark, sf).withColumn("after", F.lead("embedding").over(w)).filter("after IS NOT NULL")
    here, there = linalg.euler_to_matrix(linalg.part("embedding", 12, 3)), linalg.euler_to_matrix(linalg.part("after", 12, 3))
    # through the angles and back, so that the inverse is used too
    return e.select("vec_id", F.round(linalg.geodesic_degrees(linalg.euler_to_matrix(linalg.matrix_to_euler(here)), there), 3).alias("degrees"))


_T = [f"({_A[3 * i]} * v[16] + {_A[3 * i + 1]} * v[17] + {_A[3 * i + 2]} * v[18] + v[{19 + i}])" for i in range(3)]


@query(f"""WITH {E}, d AS (SELECT label, sqrt({' + '.join(f'pow({_T[i]} - v[{1 + i}], 2)' for i in range(3))}) AS err FROM e)
SELECT label, round(quantile_cont(err, 0.95), 6) AS p95, CASE WHEN quantile_cont(err, 0.95) >= 1.2 THEN 'error' WHEN quantile_cont(err, 0.95) >= 0.8 THEN 'warning' ELSE 'info' END AS severity FROM d GROUP BY label""")
def rigid_transform_error(spark, sf):
    x = linalg.transform_point(linalg.part("embedding", 3, 9), linalg.part("embedding", 15, 3), linalg.part("embedding", 18, 3))
    err = linalg.norm([a - b for a, b in zip(x, linalg.part("embedding", 0, 3), strict=True)])
    g = _vectors(spark, sf).groupBy("label").agg(percentile(err, 0.95).alias("p"))
    return g.select("label", r6(F.col("p")).alias("p95"), ladders.severity(F.col("p"), 0.8, 1.2).alias("severity"))


@query(f"WITH {E} SELECT label, round(greatest({', '.join(f'stddev_pop(v[{21 + k}])' for k in range(10))}), 6) AS drift, count(*) AS n FROM e GROUP BY label")
def beta_drift_std(spark, sf):
    stds = [F.stddev_pop(F.get("embedding", F.lit(20 + k)).cast("double")) for k in range(10)]
    return _vectors(spark, sf).groupBy("label").agg(r6(F.greatest(*stds)).alias("drift"), F.count(F.lit(1)).alias("n"))


@query(f"WITH {E} SELECT vec_id, len(list_filter(v, lambda x: NOT isfinite(x))) AS non_finite, len(v) AS width, len(list_filter(v, lambda x: NOT isfinite(x))) = 0 AS passed FROM e")
def nonfinite_gate(spark, sf):
    bad = F.size(F.filter("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))
    return _vectors(spark, sf).select("vec_id", bad.alias("non_finite"), F.size("embedding").alias("width"), (bad == 0).alias("passed"))




@query(f"""WITH {E}, n AS (SELECT *, {', '.join(f'lag(v[{13 + k}]) OVER w AS p{k}, lead(v[{13 + k}]) OVER w AS n{k}' for k in range(3))} FROM e WINDOW w AS (PARTITION BY label ORDER BY vec_id))
SELECT label, round(quantile_cont(d, 0.99), 2) AS p99, count(d) AS n FROM (SELECT label, {_geodesic(_euler(['p0', 'p1', 'p2']), _euler(['n0', 'n1', 'n2']))} / 2 AS d FROM n WHERE p0 IS NOT NULL AND n0 IS NOT NULL) GROUP BY label""")
def rotation_residual(spark, sf):
    """Half the turn between the neighbours of each frame: the residual to their midpoint on the geodesic."""
    w = W.partitionBy("label").orderBy("vec_id")
    e = _vectors(spark, sf).withColumn("b", F.lag("embedding").over(w)).withColumn("a", F.lead("embedding").over(w)).filter("a IS NOT NULL AND b IS NOT NULL")
    d = linalg.geodesic_degrees(linalg.euler_to_matrix(linalg.part("b", 12, 3)), linalg.euler_to_matrix(linalg.part("a", 12, 3))) / 2
    return e.groupBy("label").agg(F.round(percentile(d, 0.99), 2).alias("p99"), F.count(F.lit(1)).alias("n"))


def _axis(e):
    n = f"sqrt({' + '.join(f'{x} * {x}' for x in e)})"
    x, y, z = (f"({c} / {n})" for c in e)
    s, c = f"sin({n})", f"cos({n})"
    k = f"(1 - {c})"
    return [f"({c} + {x} * {x} * {k})", f"({x} * {y} * {k} - {z} * {s})", f"({x} * {z} * {k} + {y} * {s})", f"({y} * {x} * {k} + {z} * {s})", f"({c} + {y} * {y} * {k})", f"({y} * {z} * {k} - {x} * {s})", f"({z} * {x} * {k} - {y} * {s})", f"({z} * {y} * {k} + {x} * {s})", f"({c} + {z} * {z} * {k})"]


_R = _axis(_EULER)


@query(f"WITH {E} SELECT vec_id, round({_R[0]} + {_R[4]} + {_R[8]}, 5) AS trace, round(v[1] - v[16], 6) AS dx, v[1] > 0 AS present FROM e")
def legacy_row_adapter(spark, sf):
    m = linalg.axis_angle_to_matrix(linalg.part("embedding", 12, 3))
    x, y = linalg.part("embedding", 0, 1)[0], linalg.part("embedding", 15, 1)[0]
    return _vectors(spark, sf).select("vec_id", F.round(m[0] + m[4] + m[8], 5).alias("trace"), r6(x - y).alias("dx"), (x > 0).alias("present"))




@query(f"""WITH {E}, b AS (SELECT vec_id, label, v[1] AS x1, v[2] AS y1, v[1] + abs(v[3]) + 0.1 AS x2, v[2] + abs(v[4]) + 0.1 AS y2 FROM e), p AS (SELECT *, lag(x1) OVER w AS px1, lag(y1) OVER w AS py1, lag(x2) OVER w AS px2, lag(y2) OVER w AS py2 FROM b WINDOW w AS (PARTITION BY label ORDER BY vec_id)),
i AS (SELECT vec_id, greatest(0, least(x2, px2) - greatest(x1, px1)) * greatest(0, least(y2, py2) - greatest(y1, py1)) AS inter, (x2 - x1) * (y2 - y1) + (px2 - px1) * (py2 - py1) AS areas FROM p WHERE px1 IS NOT NULL)
SELECT vec_id, round(inter / (areas - inter), 6) AS iou FROM i""")
def box_iou_nms(spark, sf):
    x, y, w_, h = linalg.part("embedding", 0, 4)
    b = _vectors(spark, sf).select("vec_id", "label", x.alias("x1"), y.alias("y1"), (x + F.abs(w_) + 0.1).alias("x2"), (y + F.abs(h) + 0.1).alias("y2"))
    w = W.partitionBy("label").orderBy("vec_id")
    p = b.withColumns({f"p{c}": F.lag(c).over(w) for c in ("x1", "y1", "x2", "y2")}).filter("px1 IS NOT NULL")
    side = lambda a: F.greatest(F.lit(0.0), F.least(f"{a}2", f"p{a}2") - F.greatest(f"{a}1", f"p{a}1"))
    inter = side("x") * side("y")
    areas = (F.col("x2") - F.col("x1")) * (F.col("y2") - F.col("y1")) + (F.col("px2") - F.col("px1")) * (F.col("py2") - F.col("py1"))
    return p.select("vec_id", r6(inter / (areas - inter)).alias("iou"))


@query(f"""WITH {E}, m AS (SELECT label, vec_id, greatest({', '.join(f'abs(v[{k + 1}] - v[{k + 17}])' for k in range(15))}) AS worst FROM e)
SELECT label, round(quantile_cont(worst, 0.95), 6) AS p95, round(max(worst), 6) AS largest, arg_max(vec_id, (worst, vec_id)) AS at FROM m GROUP BY label""")
def pose_max_joint_error(spark, sf):
    a, b = linalg.part("embedding", 0, 15), linalg.part("embedding", 16, 15)
    m = _vectors(spark, sf).select("label", "vec_id", F.greatest(*[F.abs(x - y) for x, y in zip(a, b, strict=True)]).alias("worst"))
    return m.groupBy("label").agg(r6(percentile(F.col("worst"), 0.95)).alias("p95"), r6(F.max("worst")).alias("largest"), F.max_by("vec_id", F.struct("worst", "vec_id")).alias("at"))


@query(f"""WITH {E}, c AS (SELECT label, abs(v[1]) AS root, (abs(v[1]) + abs(v[2]) + abs(v[3]) + abs(v[4])) / 4 AS mean4, least(abs(v[1]), abs(v[2]), abs(v[3]), abs(v[4])) AS least4 FROM e)
SELECT label, round(count(*) FILTER (root >= 0.05) / count(*)::DOUBLE, 6) AS valid_ratio, round(avg(mean4), 6) AS mean_confidence, round(quantile_cont(mean4, 0.05), 6) AS p05, round(count(*) FILTER (least4 >= 0.02) / count(*)::DOUBLE, 6) AS all_ratio FROM c GROUP BY label""")
def hand_track_summary(spark, sf):
    v = [F.abs(x) for x in linalg.part("embedding", 0, 4)]
    c = _vectors(spark, sf).select("label", v[0].alias("root"), ((v[0] + v[1] + v[2] + v[3]) / 4).alias("mean4"), F.least(*v).alias("least4"))
    n = F.count(F.lit(1))
    return c.groupBy("label").agg(r6(F.count_if(F.col("root") >= 0.05) / n).alias("valid_ratio"), r6(F.avg("mean4")).alias("mean_confidence"), r6(percentile(F.col("mean4"), 0.05)).alias("p05"), r6(F.count_if(F.col("least4") >= 0.02) / n).alias("all_ratio"))


@query(f"""WITH {E}, p AS (SELECT vec_id, v[1] AS x, v[2] AS y, abs(v[3]) AS z FROM e) SELECT vec_id, CASE WHEN z > 0.01 THEN round(500 * x / z + 320, 3) END AS u, CASE WHEN z > 0.01 THEN round(500 * y / z + 240, 3) END AS v, z > 0.01 AND 500 * x / z + 320 BETWEEN 0 AND 640 AND 500 * y / z + 240 BETWEEN 0 AND 480 AS inside FROM p""")
def pinhole_projection(spark, sf):
    x, y, z = linalg.part("embedding", 0, 3)
    z = F.abs(z)
    p = _vectors(spark, sf).select("vec_id", (z > 0.01).alias("front"), (500 * x / z + 320).alias("u"), (500 * y / z + 240).alias("v"))
    return p.select("vec_id", F.when(F.col("front"), F.round("u", 3)).alias("u"), F.when(F.col("front"), F.round("v", 3)).alias("v"), (F.col("front") & F.col("u").between(0, 640) & F.col("v").between(0, 480)).alias("inside"))


@query(f"""WITH {E}, s AS (SELECT label, vec_id, v[1] < -0.15 OR v[2] < -0.15 OR v[3] > 0.15 OR v[4] > 0.15 AS edge, len(list_filter(v[1:8], lambda x: x > 0.1)) AS boxes FROM e)
SELECT label, count(*) FILTER (edge) AS edge_samples, CAST(sum(boxes) AS BIGINT) AS boxes, max(boxes) AS most FROM s GROUP BY label""")
def edge_touch_recompute(spark, sf):
    a, b, c, d = linalg.part("embedding", 0, 4)
    edge = (a < -0.15) | (b < -0.15) | (c > 0.15) | (d > 0.15)
    boxes = F.size(F.filter(F.slice("embedding", 1, 8), lambda x: x.cast("double") > 0.1))
    return _vectors(spark, sf).select("label", edge.alias("edge"), boxes.alias("b")).groupBy("label").agg(F.count_if(F.col("edge")).alias("edge_samples"), F.sum("b").alias("boxes"), F.max("b").alias("most"))
