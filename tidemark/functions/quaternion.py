"""Quaternions (w, x, y, z) in numpy, for filters that run over an entity's frames inside a task."""

from __future__ import annotations

import numpy as np


def from_matrix(m: np.ndarray) -> np.ndarray:
    """Unit quaternions of rotations [n, 3, 3], by the largest of the four squared components."""
    m = np.asarray(m, float).reshape(-1, 3, 3)
    xx, yy, zz = m[:, 0, 0], m[:, 1, 1], m[:, 2, 2]
    squares = np.stack([1 + xx + yy + zz, 1 + xx - yy - zz, 1 - xx + yy - zz, 1 - xx - yy + zz], axis=1)
    q = np.empty((len(m), 4))
    pairs = {0: (m[:, 2, 1] - m[:, 1, 2], m[:, 0, 2] - m[:, 2, 0], m[:, 1, 0] - m[:, 0, 1]), 1: (m[:, 2, 1] - m[:, 1, 2], m[:, 1, 0] + m[:, 0, 1], m[:, 0, 2] + m[:, 2, 0]), 2: (m[:, 0, 2] - m[:, 2, 0], m[:, 1, 0] + m[:, 0, 1], m[:, 2, 1] + m[:, 1, 2]), 3: (m[:, 1, 0] - m[:, 0, 1], m[:, 0, 2] + m[:, 2, 0], m[:, 2, 1] + m[:, 1, 2])}
    best = squares.argmax(axis=1)
    for k in range(4):
        at = best == k
        q[at, k] = squares[at, k]
        for j, values in zip([i for i in range(4) if i != k], pairs[k], strict=True):
            q[at, j] = values[at]
    return q / np.linalg.norm(q, axis=1, keepdims=True)


def to_matrix(q: np.ndarray) -> np.ndarray:
    w, x, y, z = np.moveaxis(np.asarray(q, float), -1, 0)
    return np.stack([1 - 2 * (y * y + z * z), 2 * (x * y - z * w), 2 * (x * z + y * w), 2 * (x * y + z * w), 1 - 2 * (x * x + z * z), 2 * (y * z - x * w), 2 * (x * z - y * w), 2 * (y * z + x * w), 1 - 2 * (x * x + y * y)], axis=-1).reshape(*w.shape, 3, 3)


def slerps(a: np.ndarray, b: np.ndarray, t: np.ndarray) -> np.ndarray:
    """From each a towards its b on the shorter way, by the share t; arrays [..., 4] and [...]."""
    d = (a * b).sum(-1, keepdims=True)
    b, d = np.where(d < 0, -b, b), np.minimum(1.0, np.abs(d))
    angle, t = np.arccos(d), t[..., None]
    sine = np.sin(angle)
    flat = sine < 1e-6  # so near that the chord is the arc
    whole = np.where(flat, 1.0, sine)
    q = np.where(flat, a + t * (b - a), (np.sin((1 - t) * angle) * a + np.sin(t * angle) * b) / whole)
    return q / np.linalg.norm(q, axis=-1, keepdims=True)


def slerp(a: np.ndarray, b: np.ndarray, t: float) -> np.ndarray:
    return slerps(np.asarray(a), np.asarray(b), np.asarray(t))


def matrix_to_euler(m: np.ndarray, limit: float = 1e-6) -> np.ndarray:
    """Extrinsic x, y, z angles of rotations [..., 3, 3]; z is 0 where the y angle hides it."""
    cy = np.hypot(m[..., 0, 0], m[..., 1, 0])
    plain = cy > limit
    x = np.where(plain, np.arctan2(m[..., 2, 1], m[..., 2, 2]), np.arctan2(-m[..., 1, 2], m[..., 1, 1]))
    return np.stack([x, np.arctan2(-m[..., 2, 0], cy), np.where(plain, np.arctan2(m[..., 1, 0], m[..., 0, 0]), 0.0)], axis=-1)


def project(m: np.ndarray) -> np.ndarray:
    """Nearest rotations of matrices [n, 3, 3]."""
    u, _, v = np.linalg.svd(m)
    sign = np.sign(np.linalg.det(u @ v))
    u[:, :, 2] *= sign[:, None]
    return u @ v
