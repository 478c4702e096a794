"""Cross-tokenizer alignment by lockstep merging.

Both tokenizers cover the same bytes (a space and the text), so their tokens' ends are two ascending lists a text. One state
vector holds a pointer into each list for every text of a batch. In a step each text links the two tokens it points at, then
moves the pointer whose token ends first, or both where they end together, which cuts a group; texts that are through leave
the vector. Long texts take several lanes, each from a place where both tokenizers end, so that steps don't follow the
longest text. Links of a text are kept as its distinct id pairs with their numbers.

Counts of id pairs over the corpus are summed in tasks, then by pair. The most frequent pairs (a fixed number) are known in
every task and settle most links where they are; the rest, each of them rare, join the table of counts.

Tokens: A encodes space + text, B encodes text and adds the space itself. Neither merges across a single space between
a character and a word, so texts are split there and a worker encodes the pieces that it meets first (a bounded number) only once. Token bytes are checked against the text; texts that are null or empty, or that a tokenizer changes, have no tokens:
zeros and an empty string. Special tokens in a text are plain text. Rows that repeat a doc_id each have a row and count each;
null doc_ids pass through. Extra columns are left out; empty tables give no rows.
"""

from __future__ import annotations

import hashlib
import os
import re
from functools import lru_cache
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, parts

#: A pair is b * SHIFT + a in one number.
SHIFT = 1 << 20
#: Where neither tokenizer merges: a single space between a character that is none and a character that is no white space.
SPLIT = re.compile(r"(?<=[^ ]) (?=\S)")


def default_models() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def byte_of() -> dict[str, int]:
    """Characters of byte-level vocabularies: printable bytes stand for themselves, the others for code points from 256 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Side:
    """A tokenizer with the bytes of each id, and the ids of pieces one after another."""

    def __init__(self, own: list[bytes], encode):
        self.own, self.encode = own, encode
        self.size = np.array([len(x) for x in own], dtype=np.int64)
        self.flat, self.used, self.start, self.count = np.zeros(1 << 16, np.int32), 0, np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, pieces: list[str]) -> list[bool]:
        """Encode the pieces; whether each one's bytes are kept."""
        found = self.encode(pieces)
        n = np.fromiter(map(len, found), np.int64, len(found))
        end = self.used + np.cumsum(n)
        while self.used + int(n.sum()) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.flat[self.used : self.used + int(n.sum())] = np.fromiter(chain.from_iterable(found), np.int32)
        self.start, self.count, self.used = np.concatenate([self.start, end - n]), np.concatenate([self.count, n]), self.used + int(n.sum())
        return [b"".join(map(self.own.__getitem__, ids)) == b" " + p.encode() for ids, p in zip(found, pieces, strict=True)]

    def keep(self, n: int):
        """Forget all pieces but the first n."""
        self.used = int(self.start[n]) if n < len(self.start) else self.used
        self.start, self.count = self.start[:n], self.count[:n]

    def ids(self, slots: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all pieces in turn, number of ids of each text), given the pieces' places and the texts' bounds among them."""
        n = self.count[slots]
        ends = np.concatenate([[0], np.cumsum(n)])
        return self.flat[np.arange(ends[-1]) + np.repeat(self.start[slots] - ends[:-1], n)], np.diff(ends[bounds])


class Pieces:
    """Both tokenizers behind one table of the pieces met so far, which holds the first `most` of them."""

    def __init__(self, a: Side, b: Side, most: int = 400_000):
        self.a, self.b, self.most, self.known, self.kept = a, b, most, {}, np.zeros(0, bool)

    def encode(self, texts: list[str | None]):
        """(ids, number of ids of each text) for A and for B; no ids where a tokenizer changes the bytes."""
        split = [SPLIT.split(t) if t else [] for t in texts]
        pieces = list(chain.from_iterable(split))
        bounds = np.concatenate([[0], np.cumsum([len(t) for t in split], dtype=np.int64)]).astype(np.int64)
        held, new = len(self.known), list(set(pieces).difference(self.known))
        for at in range(0, len(new), 20_000):
            some = new[at : at + 20_000]
            self.known.update(zip(some, range(len(self.known), len(self.known) + len(some)), strict=True))
            self.kept = np.concatenate([self.kept, np.logical_and(self.a.add(some), self.b.add(some))])
        slots = np.fromiter(map(self.known.__getitem__, pieces), np.int64, len(pieces))
        (ids_a, n_a), (ids_b, n_b) = self.a.ids(slots, bounds), self.b.ids(slots, bounds)
        fits = np.ones(len(texts), bool)
        for k in np.unique(np.searchsorted(bounds, np.flatnonzero(~self.kept[slots]), side="right") - 1):  # what pieces change, a text may still have
            for side, ids, n in ((self.a, ids_a, n_a), (self.b, ids_b, n_b)):
                end = int(n[: k + 1].sum())
                fits[k] &= b"".join(map(side.own.__getitem__, ids[end - n[k] : end].tolist())) == b" " + texts[k].encode()
        if len(self.known) > self.most:
            for p in new[max(0, self.most - held) :]:
                del self.known[p]
            n = len(self.known)
            self.a.keep(n), self.b.keep(n)
            self.kept = self.kept[:n]
        return [(ids[np.repeat(fits, n)], np.where(fits, n, 0)) for ids, n in ((ids_a, n_a), (ids_b, n_b))]


@lru_cache(maxsize=1)
def tokenizers_of(a_path: str, b_path: str) -> Pieces:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(a_path)
    a.encode_special_tokens = True
    of = byte_of()
    own_a = [b""] * a.get_vocab_size()
    for token, i in a.get_vocab().items():
        own_a[i] = bytes(of[c] for c in token) if all(c in of for c in token) else token.encode()

    b = sentencepiece.SentencePieceProcessor(model_file=b_path)
    own_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in range(b.get_piece_size())]
    encode_a = lambda pieces: [e.ids for e in a.encode_batch_fast([" " + p for p in pieces], add_special_tokens=False)]
    return Pieces(Side(own_a, encode_a), Side(own_b, lambda pieces: b.encode(pieces, num_threads=1)))


def lanes(ends_a: np.ndarray, first_a: np.ndarray, ends_b: np.ndarray, first_b: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Where lanes begin in A and in B: at each text, and in long texts every width tokens of A, at the next place where a
    token of B ends too (among the next 64 tokens; else that lane goes on)."""
    starts_a, starts_b = [first_a[:-1]], [first_b[:-1]]
    for k in np.flatnonzero(np.diff(first_a) > 2 * width):
        b = ends_b[first_b[k] : first_b[k + 1]]
        for at in range(first_a[k] + width, first_a[k + 1] - 64, width):
            place = np.searchsorted(b, ends_a[at : at + 64])
            both = np.flatnonzero(b[np.minimum(place, len(b) - 1)] == ends_a[at : at + 64])
            if len(both):
                starts_a.append([at + both[0] + 1])
                starts_b.append([first_b[k] + place[both[0]] + 1])
    return np.unique(np.concatenate(starts_a)), np.unique(np.concatenate(starts_b))  # they ascend together


def lockstep(ends_a: np.ndarray, ends_b: np.ndarray, start_a: np.ndarray, start_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(A and B token of each link, whether each A token and each B token ends a group), over all lanes at once.

    Tokens are numbered through the batch, lane after lane; ends are bytes from the start of a text. A lane has tokens of both.
    """
    stop_a = np.concatenate([start_a[1:], [len(ends_a)]])
    cut_a, cut_b = np.zeros(len(ends_a), bool), np.zeros(len(ends_b), bool)
    i, j, stop = start_a.copy(), start_b.copy(), stop_a
    links_a, links_b = [], []
    while len(i):
        links_a.append(i)
        links_b.append(j)
        a, b = ends_a[i], ends_b[j]
        both = a == b
        cut_a[i[both]] = True
        cut_b[j[both]] = True
        i, j = i + (a <= b), j + (b <= a)
        going = i < stop
        if not going.all():
            i, j, stop = i[going], j[going], stop[going]
    empty = np.zeros(0, np.int64)
    return np.concatenate(links_a or [empty]), np.concatenate(links_b or [empty]), cut_a, cut_b


@lru_cache(maxsize=2)
def _decimals(n: int) -> list[str]:
    """Ids below n followed by a comma, then by a bar, then by a semicolon."""
    return [f"{i}{mark}" for mark in ",|;" for i in range(n)]


def _written(ids_a, cut_a, ids_b, cut_b, first_a, first_b, n: int) -> list[str]:
    """Digest of each text's groups `a1,a2|b1;a3|b2`; an empty string without tokens."""
    group_a, group_b = np.cumsum(cut_a) - cut_a, np.cumsum(cut_b) - cut_b
    per_a, per_b = np.bincount(group_a), np.bincount(group_b)
    before_a, before_b = np.cumsum(per_a), np.concatenate([[0], np.cumsum(per_b)])
    codes = np.zeros(len(ids_a) + len(ids_b), np.int64)
    codes[np.arange(len(ids_a)) + before_b[group_a]] = ids_a + n * cut_a
    codes[np.arange(len(ids_b)) + before_a[group_b]] = ids_b + 2 * n * cut_b
    decimal = _decimals(n)
    first = (first_a + first_b).tolist()
    return [hashlib.sha256("".join(map(decimal.__getitem__, codes[s:e].tolist()))[:-1].encode()).hexdigest() if e > s else "" for s, e in zip(first, first[1:], strict=False)]


def align(texts: list[str | None], paths: tuple[str, str], width: int = 1024):
    """n_a, n_b, n_groups, n_links, groups_sha256 of each text, with its distinct pairs, their numbers and the pairs' bounds."""
    models = tokenizers_of(*paths)
    a, b = models.a, models.b
    (ids_a, n_a), (ids_b, n_b) = models.encode(texts)
    first_a, first_b = np.concatenate([[0], np.cumsum(n_a)]), np.concatenate([[0], np.cumsum(n_b)])
    ends = []
    for side, ids, n, first in ((a, ids_a, n_a, first_a), (b, ids_b, n_b, first_b)):
        total = np.concatenate([[0], np.cumsum(side.size[ids])])
        ends.append(total[1:] - np.repeat(total[first[:-1]], n))
    full = np.flatnonzero(n_a > 0)
    start_a, start_b = lanes(ends[0], np.append(first_a[full], first_a[-1]), ends[1], np.append(first_b[full], first_b[-1]), width)
    link_a, link_b, cut_a, cut_b = lockstep(ends[0], ends[1], start_a, start_b)
    text = np.repeat(np.arange(len(texts)), n_a)[link_a]
    order = lambda where, weights: np.bincount(where, weights, minlength=len(texts)).astype(np.int64)
    n_links, n_groups = order(text, None), order(np.repeat(np.arange(len(texts)), n_a), cut_a)
    in_a, in_b = len(a.own).bit_length(), len(b.own).bit_length()  # a text of the batch, an id of B and one of A fit one number
    packed = np.sort(((text << in_b) | ids_b[link_b]) << in_a | ids_a[link_a])
    new = np.ones(len(packed), bool)
    new[1:] = packed[1:] != packed[:-1]
    at = np.flatnonzero(new)
    times = np.diff(np.append(at, len(packed)))
    text, pairs = packed[at] >> (in_a + in_b), (packed[at] >> in_a & ((1 << in_b) - 1)) * SHIFT + (packed[at] & ((1 << in_a) - 1))
    bounds = np.searchsorted(text, np.arange(len(texts) + 1))
    return n_a, n_b, n_groups, n_links, _written(ids_a, cut_a, ids_b, cut_b, first_a, first_b, max(len(a.own), len(b.own))), pairs, times, bounds


def aligned(docs: DataFrame, paths: tuple[str, str] | None = None, width: int = 1024, batch_bytes: int = 1 << 21) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, groups_sha256, pairs and times (distinct id pairs of the text's links, their numbers)."""
    import pyarrow as pa

    paths = paths or default_models()
    docs = docs.select("doc_id", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"]

    def run(batches):
        for b in batches:
            for p in parts(b, limit=batch_bytes):
                n_a, n_b, n_groups, n_links, written, pairs, times, bounds = align(p.column("text").to_pylist(), paths, width)
                lists = [pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(x, t)) for x, t in ((pairs, pa.int64()), (times, pa.int32()))]
                numbers = [pa.array(x, pa.int64()) for x in (n_a, n_b, n_groups, n_links)]
                yield pa.RecordBatch.from_arrays([p.column("doc_id"), *numbers, pa.array(written, pa.string()), *lists], names)

    schema = f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<int>"
    return docs.mapInArrow(run, schema)


def _lists(batch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(pairs, times, number of pairs of each row)."""
    pairs, times = batch.column("pairs"), batch.column("times")
    return pairs.flatten().to_numpy(), times.flatten().to_numpy().astype(np.int64), np.diff(pairs.offsets.to_numpy())


def pair_counts(texts: DataFrame, most: int = 1 << 20) -> DataFrame:
    """pair, n: links over all texts. Tasks add up what they read, at most so many pairs at a time."""
    import pyarrow as pa

    def add(batches):
        held, size = [], 0

        def flush():
            pairs, n = np.concatenate([x for x, _ in held]), np.concatenate([x for _, x in held])
            keys, at = np.unique(pairs, return_inverse=True)
            return keys, np.bincount(at, n).astype(np.int64)

        for b in batches:
            pairs, times, _ = _lists(b)
            held.append((pairs, times))
            size += len(pairs)
            if size > most:
                keys, n = flush()
                held, size = [(keys, n)], len(keys)
                if size > most // 2:
                    yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n)], ["pair", "n"])
                    held, size = [], 0
        if held:
            keys, n = flush()
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n)], ["pair", "n"])

    return texts.select("pairs", "times").mapInArrow(add, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def link_table(docs: DataFrame, paths: tuple[str, str] | None = None, known: int = 1 << 17) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of each row of docs.

    known: the most frequent pairs that every task has (17 bytes each); all others join the table of counts.
    """
    import pyarrow as pa

    texts = cut(aligned(docs, paths).withColumn("_row", F.monotonically_increasing_id()), "aligned")
    counts = cut(pair_counts(texts), "pairs")
    b_id = F.shiftright("pair", 20)
    best = counts.groupBy(b_id.alias("b")).agg(F.max("n").alias("most"))  # a row an id of B: no more than its vocabulary
    counts = cut(counts.withColumn("b", b_id).join(F.broadcast(best), "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "counts")
    top = counts.orderBy(F.desc("n"), "pair").limit(known).toPandas().sort_values("pair")
    keys, ns, bests = top["pair"].to_numpy(np.int64), top["n"].to_numpy(np.int64), top["best"].to_numpy(np.int64)

    def looked_up(batch):
        pairs, times, per = _lists(batch)
        at = np.minimum(np.searchsorted(keys, pairs), max(len(keys) - 1, 0))
        return pairs, times, np.repeat(np.arange(len(per)), per), at, keys[at] == pairs if len(keys) else np.zeros(len(pairs), bool)

    def settled(batches):
        for b in batches:
            _, times, row, at, there = looked_up(b)
            sums = [np.zeros(b.num_rows, np.int64) for _ in range(2)]
            for to, value in zip(sums, (bests, ns), strict=True):
                np.add.at(to, row[there], times[there] * value[at[there]])
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in b.schema.names[:-2]], *map(pa.array, sums)], [*b.schema.names[:-2], "_best", "_sum"])

    def rare(batches):
        for b in batches:
            pairs, times, row, _, there = looked_up(b)
            rows = b.column("_row").to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array(rows[row[~there]]), pa.array(pairs[~there]), pa.array(times[~there])], ["_row", "pair", "times"])

    columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "_row"]
    kept = texts.select(*columns, "pairs", "times")
    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept.select(*columns).schema)
    near = kept.mapInArrow(settled, f"{types}, _best long, _sum long")
    far = kept.select("_row", "pairs", "times").mapInArrow(rare, "_row long, pair long, times long").join(counts, "pair")
    far = far.groupBy("_row").agg(F.sum(F.col("times") * F.col("best").cast("long")).alias("b"), F.sum(F.col("times") * F.col("n")).alias("s"))
    out = near.join(far, "_row", "left")
    none = F.lit(0).cast("long")
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", (F.col("_best") + F.coalesce("b", none)).alias("n_best"), (F.col("_sum") + F.coalesce("s", none)).alias("count_sum"), "groups_sha256")
