"""Centroid clustering of vectors through a vector approximation file.

Components become integers, floor(scale * x). Every dimension is cut into 2**bits cells, and a vector's approximation is the
packed numbers of its cells, beside the full vector in the same row. A round scans the approximations: lookup tables give
the bounds of each cell, these bound the distance to each centroid from below and above (as the excess over the distance to
the centroid nearest to the cells' middles, in which what both distances share cancels), and a centroid whose lower bound is
beyond the least upper bound is out. Where one centroid is left the vector is assigned unseen; where intervals overlap, the
full vector is opened and measured against the centroids that are left. Centroids move by exact sums, kept from round to round:
a round opens, besides those, only vectors that changed their centroid. The centroids before and after are all that a round
passes on, so a lost task is just run again; no round writes a row per vector and nothing is shuffled but a row per task and centroid.

Cell bounds are quantiles of a bounded sample (the `sample` vectors with the smallest hashes, of which the first k are the
first centroids) between the extremes over all vectors; they decide how many vectors are opened, never a result.

Vectors are left out if null, of another length, or with a component that is null, not finite or not below 2**20 in size once
scaled. With fewer than k vectors each is a centroid. Ties go to the smaller centroid; equal vectors, however often they
occur, each have a row. Null ids pass through and start no cluster unless the others don't suffice. Empty tables give no
rows. Extra columns are left out.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut

#: Scaled components stay below this, so that all bounds are whole numbers that a double holds exactly (up to 2048 dimensions).
LIMIT = 1 << 20


def fixed_point(df: DataFrame, id_col: str, vector_col: str, dims: int, scale: int) -> DataFrame:
    """vec_id, vector: array of whole numbers."""
    x = F.col(vector_col)
    fits = F.forall(x, lambda v: F.coalesce(F.abs(v.cast("double") * scale) < LIMIT, F.lit(False)))
    whole = F.transform(x, lambda v: F.floor(v.cast("double") * scale).cast("int"))
    return df.filter((F.size(x) == dims) & fits).select(F.col(id_col).alias("vec_id"), whole.alias("vector"))


class Cells:
    """Bounds of the cells: low and high, dims x 2**bits whole numbers, both inclusive."""

    def __init__(self, sample: np.ndarray, least: np.ndarray, most: np.ndarray, bits: int):
        n = 1 << bits
        marks = np.sort(sample, axis=0)[(np.arange(1, n) * len(sample)) // n].T  # dims x (n - 1), ascending
        self.bits, self.marks = bits, marks
        self.low = np.hstack([least[:, None], marks]).astype(np.float64)
        self.high = np.hstack([marks - 1, most[:, None]]).astype(np.float64)
        self.width = (len(marks) * bits + 7) // 8

    def pack(self, x: np.ndarray) -> np.ndarray:
        """Cells of the rows of x, as bytes."""
        cells = np.stack([np.searchsorted(m, x[:, d], side="right") for d, m in enumerate(self.marks)], axis=1).astype(np.uint8)
        return np.packbits(np.unpackbits(cells[:, :, None], axis=2)[:, :, 8 - self.bits :].reshape(len(x), -1), axis=1)

    def bounds(self, packed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        dims = len(self.marks)
        each = np.unpackbits(packed, axis=1)[:, : dims * self.bits].reshape(len(packed), dims, self.bits)
        cells = each @ (1 << np.arange(self.bits)[::-1])
        d = np.arange(dims)
        return self.low[d, cells], self.high[d, cells]


def candidates(low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """rows x centroids: whether the centroid may be the nearest, by the intervals of its distance less that to a near centroid.

    |x - c|^2 - |x - r|^2 = |c|^2 - |r|^2 - 2 x (c - r): at the cell's middle that is exact, and x is at most half a cell away.
    """
    middle, across = low + high, high - low  # both doubled
    at_middle = (centroids * centroids).sum(1) - middle @ centroids.T
    near = at_middle.argmin(1)
    open_to = np.zeros(at_middle.shape, dtype=bool)
    for r in np.unique(near):
        rows = np.flatnonzero(near == r)
        excess = at_middle[rows] - at_middle[rows, r][:, None]
        apart = across[rows] @ np.abs(centroids - centroids[r]).T
        open_to[rows] = excess - apart <= (excess + apart).min(1)[:, None]
    return open_to


def nearest(packed: np.ndarray, vectors: np.ndarray, cells: Cells, centroids: np.ndarray, block: int = 2048) -> tuple[np.ndarray, np.ndarray]:
    """(nearest centroid, whether the full vector was opened) of each row."""
    best, opened = np.zeros(len(packed), dtype=np.int64), np.zeros(len(packed), dtype=bool)
    exact = centroids.astype(np.int64)
    for at in range(0, len(packed), block):
        open_to = candidates(*cells.bounds(packed[at : at + block]), centroids)
        best[at : at + block] = open_to.argmax(1)
        rows = np.flatnonzero(open_to.sum(1) > 1)
        if len(rows):
            opened[at + rows] = True
            i, c = np.nonzero(open_to[rows])
            gap = vectors[at + rows].astype(np.int64)[i] - exact[c]
            distance = np.full((len(rows), len(exact)), np.iinfo(np.int64).max)
            distance[i, c] = np.einsum("nd,nd->n", gap, gap)
            best[at + rows] = distance.argmin(1)
    return best, opened


def _bytes(column, width: int) -> np.ndarray:
    """The values of an Arrow binary column, all of that width, as rows of bytes without a copy."""
    if not len(column):
        return np.zeros((0, width), np.uint8)
    _, offsets, data = column.buffers()
    start = int(np.frombuffer(offsets, np.int32, 1, 4 * column.offset)[0])
    return np.frombuffer(data, np.uint8, len(column) * width, start).reshape(len(column), width)


def _views(batch, cells: Cells, dims: int):
    return _bytes(batch.column("cells"), cells.width), _bytes(batch.column("vector"), 4 * dims).view("<i4")


def _packed(vectors: DataFrame, cells: Cells, dims: int) -> DataFrame:
    import pyarrow as pa

    kind = vectors.schema["vec_id"].dataType.simpleString()

    def pack(batches):
        for b in batches:
            x = b.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
            raw = [pa.array([r.tobytes() for r in rows], pa.binary()) for rows in (cells.pack(x), x.astype("<i4"))]
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), *raw], ["vec_id", "cells", "vector"])

    return vectors.mapInArrow(pack, f"vec_id {kind}, cells binary, vector binary")


def _moved(table: DataFrame, cells: Cells, before: np.ndarray | None, now: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What the clusters' sizes and sums gain when centroids before are replaced by now (all vectors if there are none before)."""
    import pyarrow as pa

    k, dims = now.shape

    def count(batches):
        sizes, sums = np.zeros(k, np.int64), np.zeros((k, dims), np.int64)
        for b in batches:
            packed, vectors = _views(b, cells, dims)
            new, _ = nearest(packed, vectors, cells, now)
            if before is None:
                rows, signs = np.arange(len(new)), [(1, new)]
            else:
                old, _ = nearest(packed, vectors, cells, before)
                rows = np.flatnonzero(old != new)
                signs = [(1, new[rows]), (-1, old[rows])]
            x = vectors[rows].astype(np.float64)
            for sign, of in signs:
                sizes += sign * np.bincount(of, minlength=k)
                sums += sign * ((np.arange(k)[:, None] == of) @ x).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(k)), pa.array(sizes), pa.array(list(sums), pa.list_(pa.int64()))], ["cluster", "n", "sums"])

    found = table.select("cells", "vector").mapInArrow(count, "cluster long, n long, sums array<long>")
    found = found.groupBy("cluster").agg(F.sum("n").alias("n"), F.array(*[F.sum(F.col("sums")[d]) for d in range(dims)]).alias("sums"))
    sizes, sums = np.zeros(k, np.int64), np.zeros((k, dims), np.int64)
    for r in found.collect():  # a row a centroid
        sizes[r["cluster"]], sums[r["cluster"]] = r["n"], r["sums"]
    return sizes, sums


def cluster(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", dims: int = 64, k: int = 40, rounds: int = 5, seed: int = 2, scale: int = 256, bits: int = 6, sample: int = 4096) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of each vector after so many rounds."""
    import pyarrow as pa

    spark = df.sparkSession
    vectors = cut(fixed_point(df, id_col, vector_col, dims, scale))
    kind = vectors.schema["vec_id"].dataType.simpleString()
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = np.array([r["vector"] for r in vectors.orderBy(order.asc_nulls_last(), "vector").limit(max(sample, k)).collect()], dtype=np.int64)
    schema = f"vec_id {kind}, cluster int, distance long"
    if not len(first):
        return spark.createDataFrame([], f"{schema}, cluster_inertia long, inertia long, centroid_sha256 string")
    extremes = vectors.agg(*[f(F.col("vector")[d]) for f in (F.min, F.max) for d in range(dims)]).first()
    cells = Cells(first, np.array(extremes[:dims]), np.array(extremes[dims:]), bits)
    table = cut(_packed(vectors, cells, dims))

    before, now = None, first[:k].astype(np.float64)
    sizes, sums = np.zeros(len(now), np.int64), np.zeros(now.shape, np.int64)
    for _ in range(rounds):
        more = _moved(table, cells, before, now)
        sizes, sums = sizes + more[0], sums + more[1]
        before, now = now, np.where(sizes[:, None] > 0, sums // np.maximum(sizes, 1)[:, None], now)

    def assign(batches):
        for b in batches:
            packed, x = _views(b, cells, dims)
            best, _ = nearest(packed, x, cells, now)
            gap = x.astype(np.int64) - now.astype(np.int64)[best]
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), pa.array(best.astype(np.int32)), pa.array(np.einsum("nd,nd->n", gap, gap))], ["vec_id", "cluster", "distance"])

    assigned = cut(table.mapInArrow(assign, schema))
    inertia = {r["cluster"]: r["d"] for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()}  # a row a centroid
    digest = lambda c: hashlib.sha256(",".join(str(int(x)) for x in now[c]).encode()).hexdigest()
    about = spark.createDataFrame([(c, d, sum(inertia.values()), digest(c)) for c, d in inertia.items()], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(about), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
