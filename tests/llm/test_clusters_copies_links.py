"""Centroid clustering, exact dedup and cross-tokenizer alignment against brute force."""

import hashlib
import math
import os
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import op11_centroids, op12_exact, op13_align, queries

SCHEMA = "doc_id long, text string, digest string, batch int, n long, _row int"


def documents(spark, rows):
    """Rows of (doc_id, text) beside columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, "x", 1, 2, 3) for i, t in rows], SCHEMA).repartition(3)


def records(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


# ---- 11 ----


def plain_clusters(rows, dims, k, rounds, seed=2, scale=256):
    kept = []
    for i, x in rows:
        if x is not None and len(x) == dims and all(v is not None and math.isfinite(v) for v in x):
            kept.append((i, [math.floor(scale * v) for v in x]))
    ranked = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest(), r[1]))
    centroids = [r[1] for r in ranked[:k]]
    gap = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    assign = lambda: [min(range(len(centroids)), key=lambda c: (gap(v, centroids[c]), c)) for _, v in kept]
    for _ in range(rounds):
        of = defaultdict(list)
        for c, (_, v) in zip(assign(), kept, strict=True):
            of[c].append(v)
        for c, members in of.items():
            centroids[c] = [sum(x) // len(members) for x in zip(*members, strict=True)]
    found = [(i, c, gap(v, centroids[c])) for c, (i, v) in zip(assign(), kept, strict=True)]
    per = Counter()
    for _, c, d in found:
        per[c] += d
    return sorted(((i, c, d, per[c], sum(per.values()), hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest()) for i, c, d in found), key=str)


def vectors(seed, n, dims, spread=1.0):
    rng = random.Random(seed)
    middles = [[rng.gauss(0, spread) for _ in range(dims)] for _ in range(5)]
    rows = [(i, [m + rng.gauss(0, 0.1) for m in rng.choice(middles)]) for i in range(n)]
    rows += [(n + i, rows[0][1]) for i in range(5)] + [(2, rows[2][1]), (None, rows[1][1])]  # copies, a repeated row, a null id
    return rows + [(n + 10, None), (n + 11, rows[0][1][:-1]), (n + 12, [float("nan")] * dims), (n + 13, [None] * dims), (n + 14, [math.inf] + [0.0] * (dims - 1)), (n + 15, [])]


@pytest.mark.parametrize(("n", "dims", "k", "bits"), [(60, 4, 7, 2), (200, 6, 12, 6), (3, 3, 40, 1)])
def test_clusters(spark, n, dims, k, bits):
    rows = vectors(n, n, dims)
    df = spark.createDataFrame([(i, x, "c") for i, x in rows], "vec_id long, embedding array<double>, cluster string").repartition(3)
    got = op11_centroids.cluster(df, dims=dims, k=k, rounds=3, bits=bits, sample=30)
    assert records(got) == plain_clusters(rows, dims, k, 3)


def test_clusters_of_equal_vectors_and_none(spark):
    schema = "vec_id int, embedding array<float>"
    df = spark.createDataFrame([(i, [0.5, -0.5]) for i in range(9)], schema)
    assert {tuple(r)[1:5] for r in op11_centroids.cluster(df, dims=2, k=4).collect()} == {(0, 0, 0, 0)}
    assert op11_centroids.cluster(spark.createDataFrame([], schema), dims=2).collect() == []


def test_intervals_hold_the_nearest_and_spare_vectors():
    rng = np.random.default_rng(7)
    x = np.floor(rng.normal(0, 32, (3000, 16)) + 200 * rng.integers(-1, 2, (3000, 1))).astype(np.int64)
    centroids = x[:9].astype(float)
    exact = ((x[:, None, :] - centroids[None]) ** 2).sum(2)
    for bits in (1, 3, 6, 8):
        cells = op11_centroids.Cells(x[:500], x.min(0), x.max(0), bits)
        packed = cells.pack(x)
        low, high = cells.bounds(packed)
        assert packed.shape[1] == (16 * bits + 7) // 8 and (low <= x).all() and (x <= high).all()
        open_to = op11_centroids.candidates(low, high, centroids)
        assert open_to[exact == exact.min(1)[:, None]].all()
        best, opened = op11_centroids.nearest(packed, x, cells, centroids)
        assert (best == exact.argmin(1)).all()
    assert opened.mean() < 0.1


# ---- 12 ----


def plain_copies(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    keep = {t: max((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    return sorted(((i, keep[t or ""], len(groups[t or ""]), i == keep[t or ""], hashlib.sha256((t or "").encode()).hexdigest()) for i, t in rows), key=str)


def copies(seed, n=300):
    rng = random.Random(seed)
    texts = [None, "", " ", "a", "A", "é", "é", "x" * 200_000, "x" * 199_999 + "y"] + [f"text {i % 40}\n" for i in range(40)]
    rows = [(i * 7 % 1000, rng.choice(texts)) for i in range(n)]
    return rows + [(None, "a"), (None, "only without an id"), (None, "only without an id"), rows[5], (5000, "alone")]


@pytest.mark.parametrize(("bits", "snapshots", "buckets"), [(64, 3, 8), (3, 3, 1), (8, 1, 2), (64, 0, 1), (1, 5, 1)])
def test_copies(spark, bits, snapshots, buckets):
    """Also with digests of few bits, where most digests stand for several texts."""
    rows = copies(bits)
    assert records(op12_exact.dedup(documents(spark, rows), snapshots, bits, buckets)) == plain_copies(rows)


def test_hot_copies_and_joins_beyond_the_broadcast(spark, monkeypatch):
    monkeypatch.setattr(op12_exact, "MOST", 2)
    rows = [(i, "hot" if i % 3 else f"t{i // 2}") for i in range(3000)]
    assert records(op12_exact.dedup(documents(spark, rows), buckets=4)) == plain_copies(rows)
    assert op12_exact.dedup(documents(spark, rows).limit(0)).collect() == []


@pytest.mark.parametrize("n", [0, 1, 2, 3, 10, 1000, 70_000])
def test_fuse_filters_know_their_keys(n):
    rng = np.random.default_rng(n)
    keys = np.unique(rng.integers(-(2**63), 2**63 - 1, n))
    f = op12_exact.Fuse.build(keys)
    assert f.knows(keys).all()
    others = rng.integers(-(2**63), 2**63 - 1, 100_000)
    assert f.knows(np.setdiff1d(others, keys)).mean() < 0.006
    assert n < 1000 or len(f.table) < 1.5 * n


# ---- 13 ----


def plain_links(rows):
    import sentencepiece
    from tokenizers import Tokenizer

    paths = op13_align.default_models()
    a, b = Tokenizer.from_file(paths[0]), sentencepiece.SentencePieceProcessor(model_file=paths[1])
    a.encode_special_tokens = True
    of = op13_align.byte_of()
    bytes_a = lambda i: bytes(of[c] for c in a.id_to_token(i))
    bytes_b = lambda i: bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
    found, counts = [], Counter()
    for doc_id, t in rows:
        ids_a, ids_b = (a.encode(" " + t, add_special_tokens=False).ids, b.encode(t)) if t else ([], [])
        side = []
        for ids, own in ((ids_a, bytes_a), (ids_b, bytes_b)):
            raw, at, spans = b"", 0, []
            for i in ids:
                raw += own(i)
                spans.append((i, at, len(raw)))
                at = len(raw)
            side.append((raw, spans))
        if not t or any(raw != b" " + t.encode() for raw, _ in side):
            side = [(b"", []), (b"", [])]
        (_, sa), (_, sb) = side
        links = []
        for i, s, e in sa:
            links += [(i, j) for j, s2, e2 in sb if s < e2 and s2 < e]
        cuts = sorted({e for _, _, e in sa} & {e for _, _, e in sb})
        groups = []
        for s, e in zip([0, *cuts], cuts, strict=False):
            inside = lambda spans: ",".join(str(i) for i, s2, e2 in spans if s <= s2 and e2 <= e)  # noqa: E731, B023
            groups.append(inside(sa) + "|" + inside(sb))
        counts.update(links)
        found.append((doc_id, len(sa), len(sb), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""))
    best = defaultdict(int)
    for (_, j), n in counts.items():
        best[j] = max(best[j], n)
    return sorted(((d, na, nb, ng, len(ls), sum(counts[x] == best[x[1]] for x in ls), sum(counts[x] for x in ls), h) for d, na, nb, ng, ls, h in found), key=str)


def texts(seed, n=80):
    rng = random.Random(seed)
    parts = ["a", "Be", " ", "  ", "\n", "\t", "é", "漢字", "▁", " ", "<s>", "<|endoftext|>", "<0x41>", "12", "345", "!", "'s", "\r\n", "\x00", "é", "😀", " the", " Haus", "ción "]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.randint(1, 40)))) for i in range(n)]
    return rows + [(n, None), (n, ""), (None, "the end"), (2, rows[2][1]), (n + 1, " "), (n + 2, "▁"), (n + 3, "x" * 500), (n + 4, "Straße und Haus, " * 300)]


@pytest.fixture(scope="module")
def linked():
    rows = texts(1)
    return rows, plain_links(rows)


@pytest.mark.parametrize("known", [1 << 17, 5, 1])
def test_links(spark, linked, known):
    rows, want = linked
    assert records(op13_align.link_table(documents(spark, rows), known=known)) == want
    assert op13_align.link_table(documents(spark, rows).limit(0)).collect() == []


def test_links_with_lanes_and_a_small_table_of_pieces(linked, monkeypatch):
    rows, want = linked
    paths = op13_align.default_models()
    models = op13_align.tokenizers_of(*paths)
    monkeypatch.setattr(models, "most", 50)
    for width in (1024, 8, 1):
        for _ in range(2):
            got = op13_align.align([t for _, t in rows], paths, width)
            assert sorted(zip([i for i, _ in rows], *[x.tolist() for x in got[:4]], got[4], strict=True), key=str) == sorted(((*r[:5], r[7]) for r in want), key=str)
    assert len(models.known) <= max(50, len(models.a.start)) and len(models.kept) == len(models.known)


# ---- registered SQL ----


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="needs the driver's tables")
@pytest.mark.parametrize("name", ["op11_centroid_clustering", "op12_exact_dedup"])
def test_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '/root/testdata/sf0.001/{t}.parquet'")
    got = queries.queries()[name](spark, "/root/testdata/sf0.001")
    want = con.execute(queries.oracle_sql()[name])
    at = [[d[0] for d in want.description].index(c) for c in got.columns]
    assert records(got) == sorted((tuple(r[i] for i in at) for r in want.fetchall()), key=str)
