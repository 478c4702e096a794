"""Helpers that the operators share: tables in the shared folder, and words and hashes of whole Arrow batches."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.shared import cut, shared_dir  # noqa: F401  (the operators take them from here)

#: White space of the word rules, as characters and as a Java pattern.
SPACE = "\t\n\x0b\x0c\r "
SPACE_PATTERN = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(c):
    """A-Z lower-cased, nothing else; in a string of single bytes that is what lower() does, at a fraction of the cost."""
    return F.when(F.octet_length(c) == F.length(c), F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


def partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


# ---- numpy, for use inside tasks ----

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)
_BYTE = np.random.default_rng(20240229).integers(1, 2**64, 256, dtype=np.uint64)
_POWERS: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        have = np.full(size, base, dtype=np.uint64)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        _POWERS[base] = have
    return have[:n]


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """P with P[j] - P[i] = sum of value(data[k]) * base**k over i <= k < j."""
    p = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[data] * powers(_BASE, len(data)), out=p[1:])
    return p


def span_hash(p: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of data[start:end], the same wherever the bytes stand."""
    return mix((p[end] - p[start]) * powers(_INVERSE, len(p))[start] + (end - start).astype(np.uint64))


class Batch:
    """The texts of an Arrow string column as one byte array, with ASCII letters lower-cased.

    offsets: len(texts) + 1 places in data; a null text has no bytes.
    """

    def __init__(self, column):
        import pyarrow as pa

        column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
        column = column.cast(pa.large_string()).fill_null("")
        _, offsets, data = column.buffers()
        self.offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
        raw = np.frombuffer(data, dtype=np.uint8) if data is not None and len(data) else np.zeros(0, np.uint8)
        self.raw = raw[self.offsets[0] : self.offsets[-1]]
        self.offsets = self.offsets - self.offsets[0]

    @property
    def data(self) -> np.ndarray:
        return _FOLD[self.raw]

    def words(self, is_gap: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of the words in data, and bounds: the words of text i are bounds[i]:bounds[i+1].

        is_gap: 256 flags of the bytes outside words; white space if not given.
        """
        gap = np.ones(len(self.raw) + 2, dtype=bool)
        gap[1:-1] = (_IS_SPACE if is_gap is None else is_gap)[self.raw]
        start = gap[:-1] & ~gap[1:]
        end = ~gap[:-1] & gap[1:]
        cuts = self.offsets[1:-1]
        cuts = cuts[(cuts > 0) & (cuts < len(self.raw))]
        inside = cuts[~gap[cuts] & ~gap[cuts + 1]]  # a text ends in a word and the next begins with one
        start[inside] = True
        end[inside] = True
        starts, ends = np.flatnonzero(start), np.flatnonzero(end)
        return starts, ends, np.searchsorted(starts, self.offsets)


def ngram_hash(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the n consecutive word hashes from each place on; len(words) - n + 1 of them."""
    m = len(words) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    h = words[:m].copy()
    for k in range(1, n):
        h = mix(h * np.uint64(0x9DDFEA08EB382D69) + words[k : k + m])
    return h


def parts(batch, column: str = "text", limit: int = 1 << 21):
    """Slices of an Arrow batch with at most limit bytes of text each (a longer text stands alone), which bounds numpy's memory."""
    if batch.num_rows == 0:
        return
    ends = Batch(batch.column(column)).offsets[1:]
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def word_hashes(texts: Batch, is_gap: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, bounds of each text)."""
    starts, ends, bounds = texts.words(is_gap)
    return span_hash(prefix_hash(texts.data), starts, ends), bounds
