"""Exact dedup: static filters of immutable snapshots screen incoming digests.

A snapshot is a set of texts that no longer changes. Its index has a row for each of its digests (64 bits of the text, with
the number of copies and the largest doc_id) and, for each bucket of digests (a fixed share of the digest's range, so that a
bucket has a bounded number of digests at any size), a binary-fuse filter: a table of one-byte fingerprints that is built once
by peeling and answers "not there" without an error, and "there" wrongly for one digest in 256.

An incoming batch is grouped by digest first, so that copies within the batch combine before anything moves. Each of its
digests meets the filters of its bucket, those of all snapshots at once. Digests that no filter knows are new. Those that one
knows join the exact buckets of that snapshot; only digests that are there, or that several rows of the batch share, have
their texts read, and bytes decide: texts of equal digests are grouped by the bytes, and a batch's text joins a snapshot's only
if the bytes are equal. Then the batch itself becomes a snapshot.

Null texts count as empty. Of equal texts the row with the largest doc_id stays (rows that share doc_id and text can't be told
apart and share their result); a null doc_id stays only if no copy has an id. Rows come back as often as they came. Long texts
are compared whole. Empty tables give no rows. Extra columns are left out.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, mix

#: Keys whose groups hold more than one row in so many are few enough to broadcast: there are less than this number of them.
HOT = 1000
#: Digests a bucket has on average at most, and digests that are broadcast at most (8 bytes each, and as much for the hash table).
BUCKET, MOST = 1 << 13, 1 << 20


class Fuse:
    """A 3-wise binary-fuse filter of distinct 64-bit keys, with fingerprints of 8 bits."""

    def __init__(self, seed: int, segment: int, segments: int, table: np.ndarray):
        self.seed, self.segment, self.segments, self.table = seed, segment, segments, table

    @staticmethod
    def places(keys: np.ndarray, seed: int, segment: int, segments: int) -> tuple[np.ndarray, np.ndarray]:
        """(three places of each key, in neighbouring segments; its fingerprint)."""
        h = mix(keys.view(np.uint64) ^ mix(np.full(1, seed + 1, np.uint64)))
        first = ((h >> np.uint64(32)) * np.uint64(segments * segment)) >> np.uint64(32)
        mask, step = np.uint64(segment - 1), np.uint64(segment)
        at = np.stack([first, (first + step) ^ ((h >> np.uint64(18)) & mask), (first + step + step) ^ (h & mask)])
        return at.astype(np.int64), (h ^ (h >> np.uint64(32))).astype(np.uint8)

    @classmethod
    def build(cls, keys: np.ndarray) -> "Fuse":
        """Peel keys that stand alone at a place, round by round, then fill the places in reverse order."""
        n = max(len(keys), 2)
        segment = 1 << min(18, max(2, int(math.log(n) / math.log(3.33) + 2.25)))
        room = n * max(1.125, 0.875 + 0.25 * math.log(1e6) / math.log(n))
        segments = max(1, math.ceil(room / segment) - 2)
        for seed in range(100):
            at, print_ = cls.places(keys, seed, segment, segments)
            size = (segments + 2) * segment
            count = np.bincount(at.ravel(), minlength=size)
            owner = np.zeros(size, np.int64)  # exclusive or of the keys at the place: the key itself where there is one
            for p in at:
                np.bitwise_xor.at(owner, p, np.arange(len(keys)))
            peeled, front, left = [], np.flatnonzero(count == 1), len(keys)
            while len(front):
                keys_, first = np.unique(owner[front], return_index=True)
                peeled.append((keys_, front[first]))
                left -= len(keys_)
                touched = at[:, keys_].ravel()
                np.subtract.at(count, touched, 1)
                np.bitwise_xor.at(owner, touched, np.tile(keys_, 3))
                touched = np.unique(touched)
                front = touched[count[touched] == 1]
            if left == 0:
                table = np.zeros(size, np.uint8)
                for k, place in reversed(peeled):
                    rest = table[at[0, k]] ^ table[at[1, k]] ^ table[at[2, k]] ^ table[place]
                    table[place] = print_[k] ^ rest
                return cls(seed, segment, segments, table)
        raise ValueError("no seed peels these keys; are they distinct?")

    def knows(self, keys: np.ndarray) -> np.ndarray:
        at, print_ = self.places(keys, self.seed, self.segment, self.segments)
        return self.table[at[0]] ^ self.table[at[1]] ^ self.table[at[2]] == print_


def digests(docs: DataFrame, bits: int = 64) -> DataFrame:
    """doc_id, digest of each row, with its text. bits: of the digest, fewer only in tests of collisions."""
    text = F.coalesce("text", F.lit(""))
    return docs.select("doc_id", F.shiftrightunsigned(F.xxhash64(text), 64 - bits).alias("digest"), text.alias("text"))


def bucket(buckets: int):
    return F.pmod(F.shiftright("digest", 7), F.lit(buckets)).cast("int")


def build_filters(index: DataFrame, name: int, buckets: int) -> DataFrame:
    """snapshot, bucket, seed, segment, segments, table: a filter a bucket."""
    import pyarrow as pa

    schema = "snapshot int, bucket int, seed int, segment int, segments int, prints binary"

    def build(key, table):
        f = Fuse.build(table.column("digest").to_numpy())
        return pa.table({"snapshot": pa.array([name], pa.int32()), "bucket": pa.array([key[0].as_py()], pa.int32()), "seed": pa.array([f.seed], pa.int32()), "segment": pa.array([f.segment], pa.int32()), "segments": pa.array([f.segments], pa.int32()), "prints": pa.array([f.table.tobytes()], pa.binary())})

    return index.select("digest", bucket(buckets).alias("bucket")).groupBy("bucket").applyInArrow(build, schema)


def screen(index: DataFrame, filters: DataFrame, buckets: int) -> DataFrame:
    """digest, snapshot: digests of the index that the filter of a snapshot knows."""
    import pyarrow as pa

    def look(digests, filters):
        keys, found = digests.column("digest").to_numpy(), []
        for f in filters.to_pylist():  # one a snapshot
            known = keys[Fuse(f["seed"], f["segment"], f["segments"], np.frombuffer(f["prints"], np.uint8)).knows(keys)] if len(keys) else keys
            found.append(pa.table({"digest": pa.array(known, pa.int64()), "snapshot": pa.array(np.full(len(known), f["snapshot"]), pa.int32())}))
        return pa.concat_tables(found) if found else pa.table({"digest": pa.array([], pa.int64()), "snapshot": pa.array([], pa.int32())})

    digests_ = index.select("digest", bucket(buckets).alias("bucket"))
    return digests_.groupBy("bucket").cogroup(filters.groupBy("bucket")).applyInArrow(look, "digest long, snapshot int")


def _only(rows: DataFrame, digests_: DataFrame) -> DataFrame:
    """Rows with one of the digests: by a broadcast of their table while it is small, by a join of both sides beyond."""
    return rows.join(F.broadcast(digests_) if digests_.count() <= MOST else digests_, "digest", "left_semi")


def dedup(docs: DataFrame, snapshots: int = 3, bits: int = 64, buckets: int | None = None) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of each row of docs.

    The rows are dealt by their ids to so many snapshots, and a batch that comes last; each is screened by those before.
    """
    rows = digests(docs, bits).withColumn("batch", F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(snapshots + 1)).cast("int"))
    slim = cut(rows.select("doc_id", "batch", "digest", F.unhex(F.sha2("text", 256)).alias("sha")))
    index = cut(slim.groupBy("batch", "digest").agg(F.max("doc_id").alias("keep"), F.count("*").alias("n")))
    total = slim.count()
    buckets = buckets or 1 << max(0, math.ceil(math.log2(max(1, total) / BUCKET)))

    # Each batch in turn: screened by the filters of all before it, then a snapshot itself.
    known, filters = None, None
    for b in range(snapshots + 1):
        own = index.filter(F.col("batch") == b)
        if b:
            seen = screen(own, filters, buckets).withColumn("batch", F.lit(b))
            known = seen if known is None else known.unionByName(seen)
        if b < snapshots:
            made = cut(build_filters(own, b, buckets), "filters")
            filters = made if filters is None else filters.unionByName(made)

    # Exact buckets: of what the filters know, what is there.
    base = index.select(F.col("batch").alias("snapshot"), "digest")
    links = cut(known.join(base, ["snapshot", "digest"], "left_semi")) if known is not None else None
    shared = index.filter("n > 1").select("digest")
    if links is not None:
        shared = shared.union(links.select("digest"))
    shared = cut(shared.distinct())

    # Bytes: texts with these digests only. A batch's copies combine as they are read; then batches meet, a row a text and batch.
    texts = _only(rows, shared).groupBy("batch", "digest", "text").agg(F.max("doc_id").alias("keep"), F.count("*").alias("n"))
    texts = cut(texts.withColumn("sha", F.unhex(F.sha2("text", 256))), "texts")
    if links is not None:
        earlier = texts.select(F.col("batch").alias("snapshot"), "digest", F.col("text").alias("_text"), F.col("sha").alias("_sha"))
        same = texts.select("batch", "digest", "text").join(links, ["batch", "digest"]).join(earlier, ["snapshot", "digest"]).filter(F.col("text") == F.col("_text"))
        first = same.groupBy("batch", "digest", F.col("_sha").alias("sha")).agg(F.min("snapshot").alias("snapshot"))
        texts = texts.select("batch", "digest", "sha", "keep", "n").join(first, ["batch", "digest", "sha"], "left")
    else:
        texts = texts.select("batch", "digest", "sha", "keep", "n", F.lit(None).cast("int").alias("snapshot"))
    classes = texts.groupBy(F.coalesce("snapshot", "batch").alias("snapshot"), "digest", "sha").agg(F.max("keep").alias("keep"), F.sum("n").alias("n"))
    classes = cut(classes.filter("n > 1").select("digest", "sha", "keep", "n"), "classes")

    # Back to rows. Classes with a large share of all rows are few; they are met where the rows are, the rest by a join.
    hot = classes.filter(F.col("n") * HOT > total).select("digest", "sha", F.col("keep").alias("_keep"), F.col("n").alias("_n"))
    met = slim.join(F.broadcast(hot), ["digest", "sha"], "left")
    met = met.withColumns({"_digest": F.when(F.col("_n").isNull(), F.col("digest")).otherwise(F.xxhash64("doc_id", "batch")), "_sha": F.when(F.col("_n").isNull(), F.col("sha"))})
    cold = classes.filter(F.col("n") * HOT <= total).select(F.col("digest").alias("_digest"), F.col("sha").alias("_sha"), "keep", "n")
    out = met.join(cold, ["_digest", "_sha"], "left")
    keep = F.when(F.coalesce("_n", "n").isNull(), F.col("doc_id")).otherwise(F.coalesce("_keep", "keep"))
    return out.select("doc_id", keep.alias("keep_id"), F.coalesce("_n", "n", F.lit(1)).cast("long").alias("group_size"), F.col("doc_id").eqNullSafe(keep).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"))
