"""Exact repeats of `width` bytes by a sparse suffix array, sorted deep-shallow.

Anchors. In every window of width bytes the GRAM-byte string with the least hash (the leftmost of equal ones) is its
anchor, so equal windows have their anchor at the same place. An anchor serves a run of windows; the bytes under that run
are its context. A corpus has one anchor for about 39 bytes, and only anchors are shuffled: their hash, the hash of their
context, and their place, spread by anchor and sorted by (anchor, context, document, start).

One pass over the sorted rows settles most of them. Rows with the same anchor and context repeat the first of them, so all
windows of the later ones go. First rows whose anchor has no other context are new text. What remains are anchors with
several contexts: the edges of repeats. Their contexts' bytes are fetched once and ordered as suffixes: from the places where
contexts part to the left, multikey quicksort parts the suffixes to a shallow depth, and blind tries order the groups that
still share it. Neighbours' common prefixes of width bytes or more with an earlier suffix are repeats; the prefix says how
far.

Texts are judged on the input; offsets are of UTF-8 bytes. Null text counts as empty. Order of documents is doc_id; null
doc_ids come first, and rows that repeat a doc_id are ordered by their text's hash; repeated rows with equal text are one
document and get the result of the first. Very long texts are read in segments. Empty tables give empty results; extra
columns are ignored. Places of equal hash are taken as equal: 64 bits for the anchor and 64 for the context.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Batch, cut, mix, parts, partitions, prefix_hash, span_hash

#: Contexts of one anchor up to which its suffixes are sorted in one task; more are dealt out by window.
MOST = 20_000

GRAM = 24
SHALLOW = 16
_PLACE = np.uint64((1 << 24) - 1)
SEGMENT = 1 << 22


def anchors(data: np.ndarray, offsets: np.ndarray, width: int):
    """text, first (window), last (window), place, gram hash and context hash of each anchor's run of windows.

    data: bytes of all texts (fewer than 2 ** 24); windows lie within texts.
    """
    none = (np.zeros(0, np.int64),) * 4 + (np.zeros(0, np.uint64),) * 2
    n = len(data) - width + 1
    if n <= 0:
        return none
    p = prefix_hash(data)
    at = np.arange(len(data) - GRAM + 1)
    gram = span_hash(p, at, at + GRAM)
    low = (gram & ~_PLACE) | at.astype(np.uint64)
    span, size = 1, width - GRAM + 1
    while span * 2 <= size:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    if span < size:
        low = np.minimum(low[: len(low) - (size - span)], low[size - span :])
    place = (low & _PLACE).astype(np.int64)
    ends = np.repeat(offsets[1:], np.diff(offsets))[:n]
    start = np.flatnonzero(np.arange(n) + width <= ends)
    if not len(start):
        return none
    own = place[start]
    text = np.searchsorted(offsets, start, side="right") - 1
    new = np.flatnonzero(np.concatenate([[True], (own[1:] != own[:-1]) | (text[1:] != text[:-1])]))
    first, last = start[new], start[np.concatenate([new[1:], [len(start)]]) - 1]
    own, text = own[new], text[new]
    return text, first, last, own, gram[own], mix(span_hash(p, first, last + width) + (own - first).astype(np.uint64))


def merged(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of intervals as sorted, disjoint intervals that don't touch."""
    if not len(start):
        return start, end
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum.accumulate(end[order])
    new = np.concatenate([[True], start[1:] > end[:-1]])
    last = np.concatenate([np.flatnonzero(new)[1:], [len(start)]]) - 1
    return start[new], end[last]


def anchor_rows(docs: DataFrame, width: int) -> DataFrame:
    """gram, context, doc_id, version, at (first window), shape ((place - at) << 16 | windows - 1; of what a text repeats
    of itself: -length, to be removed from at on)."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def rows(texts: Batch, base: int):
        text, first, last, place, gram, context = anchors(texts.raw, texts.offsets, width)
        at = first - texts.offsets[text]
        order = np.lexsort((at, context, text))
        again = np.zeros(len(text), bool)
        if len(text):
            again[order[1:]] = (text[order[1:]] == text[order[:-1]]) & (context[order[1:]] == context[order[:-1]])
        keep = ~again
        out = [(text[keep], gram[keep], context[keep], at[keep] + base, (place - first)[keep] << 16 | (last - first)[keep])]
        if again.any():
            flat = first[again]
            s, e = merged(flat, last[again] + width)
            own = np.searchsorted(texts.offsets, s, side="right") - 1
            cuts = [(int(o), int(a), int(b)) for o, a, b in zip(own, s, e, strict=True)]
            fixed = []
            for o, a, b in cuts:  # touching intervals of neighbouring texts
                while b > texts.offsets[o + 1]:
                    fixed.append((o, a, int(texts.offsets[o + 1])))
                    a, o = int(texts.offsets[o + 1]), int(np.searchsorted(texts.offsets, texts.offsets[o + 1], side="right")) - 1
                fixed.append((o, a, b))
            o, a, b = (np.array(x, np.int64) for x in zip(*fixed, strict=True))
            out.append((o, mix((a * 7919 + o).astype(np.uint64)), np.zeros(len(o), np.uint64), a - texts.offsets[o] + base, a - b))
        return [np.concatenate(x) for x in zip(*out, strict=True)]

    def run(batches):
        import pyarrow as pa

        for b in (p for batch in batches for p in parts(batch, "text", SEGMENT // 2)):
            whole = Batch(b.column("text"))
            n = len(whole.raw)
            pieces = [(whole, 0)]
            if n > SEGMENT:  # one long text
                pieces = []
                for s in range(0, max(1, n - width + 1), SEGMENT):
                    piece = Batch.__new__(Batch)
                    piece.raw = whole.raw[s : s + SEGMENT + width - 1]
                    piece.offsets = np.array([0, len(piece.raw)], np.int64)
                    pieces.append((piece, s))
            for piece, base in pieces:
                text, gram, context, at, shape = rows(piece, base)
                own = pa.array(text)
                yield pa.RecordBatch.from_arrays([pa.array(gram.view(np.int64)), pa.array(context.view(np.int64)), b.column("doc_id").take(own), b.column("version").take(own), pa.array(at), pa.array(shape)], ["gram", "context", "doc_id", "version", "at", "shape"])

    return docs.select("doc_id", "version", "text").mapInArrow(run, f"gram long, context long, doc_id {kind}, version long, at long, shape long")


# ---- the pass over sorted anchors ----


def settle(rows: DataFrame, width: int) -> DataFrame:
    """doc_id, version, start, end, gram, shape: bytes to remove (gram null), or contexts to compare (end null)."""
    kind = rows.schema["doc_id"].dataType.simpleString()
    order = ("gram", "context", "doc_id", "version", "at")
    dealt = rows.repartition(partitions(rows), "gram").sortWithinPartitions(*order)

    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        names = ["doc_id", "version", "start", "end", "gram", "shape"]
        held, before = None, False  # the last first row, not yet given out, and whether the one before has its anchor

        def numbers(t, *columns):
            return (t.column(c).to_numpy() for c in columns)

        def remove(t, mask, size):
            t = t.filter(pa.array(mask))
            start = t.column("at").to_numpy()
            none = pa.nulls(t.num_rows, pa.int64())
            return pa.RecordBatch.from_arrays([t.column("doc_id"), t.column("version"), pa.array(start), pa.array(start + size), none, none], names)

        def compare(t):
            return pa.RecordBatch.from_arrays([t.column("doc_id"), t.column("version"), t.column("at"), pa.nulls(t.num_rows, pa.int64()), t.column("gram"), t.column("shape")], names)

        for b in batches:
            (shape,) = numbers(b, "shape")
            own = shape < 0
            if own.any():
                yield remove(b, own, -shape[own])
                b = b.filter(pa.array(~own))
            if not b.num_rows:
                continue
            carried = 0
            if held is not None:
                b = pa.Table.from_batches([held, b]).combine_chunks().to_batches()[0]
                carried = 1
            gram, context, version, at, shape = numbers(b, "gram", "context", "version", "at", "shape")
            new = np.concatenate([[True], (gram[1:] != gram[:-1]) | (context[1:] != context[:-1])])
            first = np.flatnonzero(new)
            of = first[np.cumsum(new) - 1]
            doc = b.column("doc_id")
            lead = doc.take(pa.array(of))
            same = pc.equal(lead, doc).fill_null(False).to_numpy(zero_copy_only=False) | (lead.is_null().to_numpy(zero_copy_only=False) & doc.is_null().to_numpy(zero_copy_only=False))
            gone = ~new & ~(same & (version[of] == version) & (at[of] == at))
            if gone.any():
                yield remove(b, gone, (shape[gone] & 0xFFFF) + width)
            g = gram[first]
            next_same = g[:-1] == g[1:]
            several = np.concatenate([next_same, [False]]) | np.concatenate([[before if carried else False], next_same])
            out = first[:-1][several[:-1]]
            if len(out):
                yield compare(b.take(pa.array(out)))
            held, before = b.slice(int(first[-1]), 1), bool(several[-1])
        if held is not None and before:
            yield compare(held)

    return dealt.mapInArrow(run, f"doc_id {kind}, version long, start long, end long, gram long, shape long")


# ---- contexts of one anchor ----


def common_prefix(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    a, b = a[:n], b[:n]
    if a == b:
        return n
    x = int.from_bytes(a, "big") ^ int.from_bytes(b, "big")
    return n - (x.bit_length() + 7) // 8


class BlindTrie:
    """Strings by the places where they part. Nodes: [place, {byte: node}, a string below]; leaves are strings; the byte
    after a string's end counts as -1, so that a string stands before those that it begins."""

    def __init__(self, first: bytes):
        self.root = first
        self.times = {first: 1}

    def insert(self, text: bytes) -> int:
        """Add text; the longest common prefix with a string that was there."""
        node = self.root
        while type(node) is list:  # blind: only the bytes where strings part are looked at
            at = node[0]
            node = node[1].get(text[at] if at < len(text) else -1) or node[2]
        lcp = common_prefix(node, text)
        self.times[text] = self.times.get(text, 0) + 1
        if lcp == len(text) == len(node):
            return lcp
        up, key, node = None, 0, self.root
        while type(node) is list and node[0] < lcp:
            up, key = node, text[node[0]]
            node = node[1][key]
        own = text[lcp] if lcp < len(text) else -1
        if type(node) is list and node[0] == lcp:
            node[1][own] = text
            return lcp
        other = node[2] if type(node) is list else node
        made = [lcp, {own: text, (other[lcp] if lcp < len(other) else -1): node}, text]
        if up is None:
            self.root = made
        else:
            up[1][key] = made
        return lcp

    def ordered(self) -> list[tuple[bytes, int]]:
        """(string, common prefix with the string before) of the distinct strings in order; the first has 0."""
        out: list[tuple[bytes, int]] = []
        todo: list[tuple] = [(self.root, 0)]
        while todo:
            node, shared = todo.pop()
            if type(node) is list:
                keys = sorted(node[1])
                todo += [(node[1][k], node[0] if k != keys[0] else shared) for k in reversed(keys)]
            else:
                out.append((node, shared))
        return out


def earlier_prefixes(texts: list[bytes]) -> list[int]:
    """For each string, the longest common prefix with one before it in the list (0 for the first).

    A blind trie puts the strings in order, so that common prefixes are those of neighbours. Strings are taken out again from
    the last of the list on: what then stands beside a string came before it, and the gap closes to the lesser prefix.
    """
    trie = BlindTrie(texts[0])
    for t in texts[1:]:
        trie.insert(t)
    order = trie.ordered()
    place = {t: k for k, (t, _) in enumerate(order)}
    before, after = list(range(-1, len(order) - 1)), list(range(1, len(order) + 1))
    shared = [lcp for _, lcp in order] + [0]  # with the string before, among those left
    left, out = dict(trie.times), [0] * len(texts)
    for i in range(len(texts) - 1, -1, -1):
        t = texts[i]
        left[t] -= 1
        if left[t]:
            out[i] = len(t)
            continue
        k = place[t]
        a, z = before[k], after[k]
        out[i] = max(shared[k] if a >= 0 else 0, shared[z] if z < len(order) else 0)
        if z < len(order):
            shared[z] = min(shared[k], shared[z])
            before[z] = a
        if a >= 0:
            after[a] = z
    return out


def left_breaks(left: list[bytes]) -> list[set[int]]:
    """For each reversed left part, the lengths it has in common with others (its own length included)."""
    order = sorted(range(len(left)), key=left.__getitem__)
    shared = [common_prefix(left[i], left[j]) for i, j in zip(order, order[1:], strict=False)]
    out = [{len(x)} for x in left]
    for direction in (1, -1):
        seq, lcps = (order, shared) if direction == 1 else (order[::-1], shared[::-1])
        depths: list[int] = []  # increasing: least common length with some string before
        for k, i in enumerate(seq):
            if k:
                d = lcps[k - 1]
                while depths and depths[-1] >= d:
                    depths.pop()
                depths.append(d)
            out[i].update(depths)
    return out


def compare(groups: list[list[tuple[int, int, bytes]]], width: int) -> list[list[tuple[int, int]]]:
    """Repeated windows of contexts: groups of (place of the anchor in the bytes, windows, bytes) of one anchor, earliest
    first. Per context of all groups in turn: (first, last) windows that stand in an earlier context, counted from its start.
    """
    suffixes = []  # group, start against the anchor, number, next start, bytes
    number = 0
    for g, contexts in enumerate(groups):
        for (place, _, data), breaks in zip(contexts, left_breaks([c[2][: c[0]][::-1] for c in contexts]), strict=True):
            starts = sorted(-d for d in breaks)
            for s, after in zip(starts, [*starts[1:], 1], strict=True):
                suffixes.append((g, s, number, after, data[place + s :]))
            number += 1
    found: list[list[tuple[int, int]]] = [[] for _ in range(number)]
    places = {}
    k = 0
    for contexts in groups:
        for place, windows, _ in contexts:
            places[k] = place, windows
            k += 1
    for tied in shallow(suffixes):
        for (_, s, c, after, _), lcp in zip(tied, earlier_prefixes([x[4] for x in tied]), strict=True):
            if lcp >= width:
                place, windows = places[c]
                a = place + s
                z = min(a + lcp - width, place + after - 1, windows - 1)
                if z >= a:
                    found[c].append((a, z))
    return found


def shallow(suffixes: list[tuple]) -> list[list[tuple]]:
    """Multikey quicksort to SHALLOW bytes, eight bytes a character: the groups of two or more suffixes of one anchor and start
    that still share them, earliest context first.

    Every round parts all open groups at once in three, below, equal to and above the character of the group's middle
    suffix; the equal part goes on with the next character. Suffixes alone in their part are done.
    """
    if not suffixes:
        return []
    characters = np.frombuffer(b"".join(x[4][:SHALLOW].ljust(SHALLOW, b"\0") for x in suffixes), dtype=">u8").reshape(len(suffixes), -1).astype(np.uint64)
    group = np.array([x[0] for x in suffixes], np.int64) * 4096 - np.array([x[1] for x in suffixes], np.int64)
    live = np.argsort(group, kind="stable")
    part = np.cumsum(np.concatenate([[0], (np.diff(group[live]) != 0).astype(np.int64)]))
    depth = np.zeros(len(suffixes), np.int64)
    tied: list[np.ndarray] = []
    while len(live):
        size = np.bincount(part)
        many = size[part] > 1
        live, part = live[many], np.unique(part[many], return_inverse=True)[1]
        if not len(live):
            break
        size = np.bincount(part)
        first = np.cumsum(size) - size
        own = characters[live, depth[live]]
        pivot = own[first + size // 2][part]
        side = np.where(own < pivot, 0, np.where(own == pivot, 1, 2))
        depth[live[side == 1]] += 1
        order = np.argsort(part * 3 + side, kind="stable")
        live, part = live[order], (part * 3 + side)[order]
        deep = depth[live] == characters.shape[1]
        if deep.any():
            cuts = np.flatnonzero(np.diff(part[deep])) + 1
            tied += [x for x in np.split(live[deep], cuts) if len(x) > 1]
            live, part = live[~deep], part[~deep]
    return [[suffixes[i] for i in np.sort(x)] for x in tied]


def fetched(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """wanted (doc, ver, start, gram, shape, many) with the bytes of its contexts."""
    per_doc = wanted.groupBy("doc", "ver").agg(F.collect_set(F.struct("start", "gram", "shape", "many")).alias("wanted"))
    joined = docs.join(per_doc, docs["doc_id"].eqNullSafe(per_doc["doc"]) & (docs["version"] == per_doc["ver"]))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        import pyarrow as pa

        for b in batches:
            text, wanted = b.column("text").to_pylist(), b.column("wanted")
            for i in range(b.num_rows):
                data = (text[i] or "").encode()
                w = wanted.slice(i, 1).flatten()
                start, gram, shape = (w.field(k).to_numpy() for k in range(3))
                bits = [data[s : s + (h & 0xFFFF) + width] for s, h in zip(start.tolist(), shape.tolist(), strict=True)]
                at = pa.array(np.full(len(start), i, np.int64))
                yield pa.RecordBatch.from_arrays([b.column("doc_id").take(at), b.column("version").take(at), w.field(0), w.field(1), w.field(2), w.field(3), pa.array(bits, pa.binary())], ["doc_id", "version", "start", "gram", "shape", "many", "bytes"])

    return joined.select("doc_id", "version", "text", "wanted").mapInArrow(run, f"doc_id {kind}, version long, start long, gram long, shape long, many boolean, bytes binary")


def edges(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """doc_id, version, start, end of the repeats in contexts that share their anchor with others."""
    wanted = wanted.select(F.col("doc_id").alias("doc"), F.col("version").alias("ver"), "start", "gram", "shape")
    crowded = wanted.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > MOST).select("gram")
    wanted = wanted.join(crowded.withColumn("many", F.lit(True)), "gram", "left").withColumn("many", F.col("many").isNotNull())
    with_bytes = cut(fetched(docs, wanted, width))
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, version long, start long, end long"
    order = ("gram", "doc_id", "version", "start")
    usual = with_bytes.filter("NOT many").drop("many").repartition(partitions(docs), "gram").sortWithinPartitions(*order)

    def run(batches):
        import pyarrow as pa

        def done(t):
            gram, start, shape = (t.column(c).to_numpy() for c in ("gram", "start", "shape"))
            bits = t.column("bytes").to_pylist()
            cuts = [0, *(np.flatnonzero(np.diff(gram)) + 1).tolist(), len(gram)]
            groups = [[(int(shape[i]) >> 16, (int(shape[i]) & 0xFFFF) + 1, bits[i]) for i in range(a, z)] for a, z in zip(cuts, cuts[1:], strict=False)]
            hits = [(i, a, z) for i, found in enumerate(compare(groups, width)) for a, z in found]
            own = np.array([h[0] for h in hits], np.int64)
            at = pa.array(own)
            a, z = (np.array([h[k] for h in hits], np.int64) for k in (1, 2))
            return pa.RecordBatch.from_arrays([t.column("doc_id").take(at), t.column("version").take(at), pa.array(start[own] + a), pa.array(start[own] + z + width)], ["doc_id", "version", "start", "end"])

        held = None
        for b in batches:
            if not b.num_rows:
                continue
            b = b if held is None else pa.Table.from_batches([held, b]).combine_chunks().to_batches()[0]
            gram = b.column("gram").to_numpy()
            last = int(np.searchsorted(gram, gram[-1]))
            if last:
                yield done(b.slice(0, last))
            held = b.slice(last)
        if held is not None:
            yield done(held)

    # an anchor with too many contexts for a task: its windows one by one, the earliest of equal ones by aggregation
    size = F.col("shape").bitwiseAND(F.lit(0xFFFF))
    each = with_bytes.filter("many").select("doc_id", "version", "start", "bytes", F.explode(F.sequence(F.lit(0).cast("long"), size)).alias("k"))
    each = each.select(F.substring("bytes", F.col("k").cast("int") + 1, F.lit(width)).alias("bytes"), F.struct("doc_id", "version", (F.col("start") + F.col("k")).alias("start")).alias("place"))
    first = each.groupBy("bytes").agg(F.min("place").alias("first"))
    rest = each.join(first, "bytes").filter(~F.col("place").eqNullSafe(F.col("first")))
    rest = rest.select("place.doc_id", "place.version", "place.start", (F.col("place.start") + width).alias("end"))
    return usual.mapInArrow(run, schema).unionByName(rest)


def repeats(docs: DataFrame, width: int = 100) -> tuple[DataFrame, DataFrame]:
    """docs with version; and doc_id, version, start, end of repeated bytes, not yet merged."""
    docs = docs.select("doc_id", "text", F.xxhash64("text").alias("version"))
    settled = cut(settle(anchor_rows(docs, width), width))
    simple = settled.filter("gram IS NULL").select("doc_id", "version", "start", "end")
    return docs, simple.unionByName(edges(docs, settled.filter("gram IS NOT NULL"), width))


def remove_repeats(docs: DataFrame, width: int = 100) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans (starts and ends of the removed runs) of each row of docs."""
    docs, found = repeats(docs, width)
    found = found.groupBy(F.col("doc_id").alias("doc"), F.col("version").alias("ver")).agg(F.collect_list(F.struct("start", "end")).alias("found"))
    joined = docs.join(found, docs["doc_id"].eqNullSafe(found["doc"]) & (docs["version"] == found["ver"]), "left")
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        import pyarrow as pa

        for b in batches:
            rows, found = [], b.column("found")
            for i, text in enumerate(b.column("text").to_pylist()):
                data = (text or "").encode()
                f = found.slice(i, 1).flatten()
                start, end = merged(f.field(0).to_numpy(), f.field(1).to_numpy())
                sha, at = hashlib.sha256(), 0
                for a, z in zip(start.tolist(), end.tolist(), strict=True):
                    sha.update(data[at:a])
                    at = z
                sha.update(data[at:])
                spans = np.stack([start, end], axis=1).reshape(-1).tolist()
                rows.append((len(data), int((end - start).sum()), len(start), sha.hexdigest(), spans))
            c = list(zip(*rows, strict=True)) if rows else [()] * 5
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(pa.array(x, pa.int64()) for x in c[:3]), pa.array(c[3], pa.string()), pa.array(c[4], pa.list_(pa.int64()))], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"])

    return joined.select("doc_id", "text", "found").mapInArrow(run, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<long>")
