"""Three-dimensional geometry on arrays of doubles: matrices are row-major arrays of nine. All of it stays in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PI = 3.141592653589793


def part(array, first: int, n: int) -> list[Column]:
    """n elements of an array from index first on (from 0), as doubles."""
    return [F.get(array, F.lit(first + k)).cast("double") for k in range(n)]


def matmul(a: list, b: list) -> list[Column]:
    return [a[3 * i] * b[j] + a[3 * i + 1] * b[3 + j] + a[3 * i + 2] * b[6 + j] for i in range(3) for j in range(3)]


def transpose(a: list) -> list:
    return [a[3 * j + i] for i in range(3) for j in range(3)]


def determinant(a: list) -> Column:
    return a[0] * (a[4] * a[8] - a[5] * a[7]) - a[1] * (a[3] * a[8] - a[5] * a[6]) + a[2] * (a[3] * a[7] - a[4] * a[6])


def orthogonality_error(a: list) -> Column:
    """Frobenius norm of A'A - I."""
    m = matmul(transpose(a), a)
    return F.sqrt(sum((m[3 * i + j] - (1.0 if i == j else 0.0)) * (m[3 * i + j] - (1.0 if i == j else 0.0)) for i in range(3) for j in range(3)))


def transform_point(a: list, x: list, t: list) -> list[Column]:
    return [a[3 * i] * x[0] + a[3 * i + 1] * x[1] + a[3 * i + 2] * x[2] + t[i] for i in range(3)]


def euler_to_matrix(e: list) -> list[Column]:
    """Rz Ry Rx of extrinsic x, y, z angles."""
    sx, sy, sz = (F.sin(v) for v in e)
    cx, cy, cz = (F.cos(v) for v in e)
    return [cz * cy, cz * sy * sx - sz * cx, cz * sy * cx + sz * sx, sz * cy, sz * sy * sx + cz * cx, sz * sy * cx - cz * sx, -sy, cy * sx, cy * cx]


def matrix_to_euler(m: list, limit: float = 1e-6) -> list[Column]:
    cy = F.sqrt(m[0] * m[0] + m[3] * m[3])
    plain = cy > limit
    return [F.when(plain, F.atan2(m[7], m[8])).otherwise(F.atan2(-m[5], m[4])), F.atan2(-m[6], cy), F.when(plain, F.atan2(m[3], m[0])).otherwise(F.lit(0.0))]


def axis_angle_to_matrix(v: list) -> list[Column]:
    """Rodrigues' formula; the identity for no rotation."""
    n = F.sqrt(v[0] * v[0] + v[1] * v[1] + v[2] * v[2])
    x, y, z = (F.when(n > 1e-12, c / n).otherwise(0.0) for c in v)
    s, c = F.sin(n), F.cos(n)
    k = 1 - c
    return [c + x * x * k, x * y * k - z * s, x * z * k + y * s, y * x * k + z * s, c + y * y * k, y * z * k - x * s, z * x * k - y * s, z * y * k + x * s, c + z * z * k]


def geodesic_degrees(a: list, b: list) -> Column:
    m = matmul(transpose(a), b)
    return F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), (m[0] + m[4] + m[8] - 1) / 2))) * (180 / PI)


def norm(v: list) -> Column:
    return F.sqrt(sum(c * c for c in v))
