"""Byte-level BPE of whole texts, long ones in overlapping chunks.

A text of at most chunk_chars characters is one piece. A longer one is dealt out as chunks, each with the first overlap
characters of the next, and every chunk is split into pre-tokens from its own start. Pre-tokens depend on nothing to
their left, so once two neighbours have a boundary in common they agree from there on: the first common boundary in the
overlap is where the text is cut. Only boundaries after an ASCII character that is no white space count, as white space
looks ahead, and none at a chunk's ragged end. Cuts are found from the boundaries alone, without the texts. The pieces
between the cuts are encoded in parallel; their ids then stream by in order through one running digest a text, so no task
holds more of a text than a piece. Decoding joins the tokens' raw bytes. Where two chunks find no common boundary (a run of
letters longer than the overlap), these two stay one piece, and the rest of the text is cut as before.

Null text counts as empty: no tokens, the digests of no bytes. Rows with the same doc_id and text have equal results, each
row its own. Null doc_ids pass through. Empty tables give empty results. Extra columns are left out of the digests.
"""

from __future__ import annotations

import base64
import hashlib
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut

DIGEST = "n_tokens long, ids_sha256 string, decoded_sha256 string"


def default_ranks() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


@lru_cache(maxsize=2)
def tables(path: str):
    """(encoder of a piece, bytes of each id, decimal of each id) for the rank file at path; a few MB in each worker."""
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    own = [b""] * (max(ranks.values()) + 1)
    for token, i in ranks.items():
        own[i] = token
    encoder = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return encoder.encode_ordinary, own, [str(i) for i in range(len(own))]


@lru_cache(maxsize=1)
def pattern():
    import public_tokenizers
    import regex

    return regex.compile(public_tokenizers.PATTERN)


def encode(text: str, path: str) -> list[int]:
    return tables(path)[0](text)


def decode(ids, path: str) -> bytes:
    """Raw bytes; a token need not be whole characters, so only the joined bytes are text."""
    return b"".join(map(tables(path)[1].__getitem__, ids))


def digest(ids, path: str) -> tuple[int, str, str]:
    decimal = tables(path)[2]
    return len(ids), hashlib.sha256(" ".join(map(decimal.__getitem__, ids)).encode()).hexdigest(), hashlib.sha256(decode(ids, path)).hexdigest()


def boundaries(view: str, offset: int, last: bool) -> list[int]:
    """Places in the text where a pre-token of the view ends and a cut is safe; the view starts at offset in the text."""
    found = []
    for m in pattern().finditer(view):
        end = m.end()
        if end >= len(view) - 1 and not last:
            break
        if view[end - 1] < "\x7f" and not view[end - 1].isspace():
            found.append(offset + end)
    return found


def _ends(view: str, at: int, chunk: int, overlap: int, last: bool) -> tuple[list[int], list[int]]:
    """Boundaries in the first overlap characters of the view at place at, and in its last (shared with the next chunk)."""
    found = boundaries(view, at, last)
    return [x for x in found if x <= at + overlap], [x for x in found if x >= at + chunk]


def encode_digests(docs: DataFrame, ranks: str | None = None, chunk_chars: int = 1 << 15, overlap: int = 512) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 for each row of docs."""
    path = ranks or default_ranks()
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def whole(batches):
        import pyarrow as pa

        for b in batches:
            rows = [digest(encode(t, path), path) for t in b.column("text").to_pylist()]
            n, ids, raw = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(raw, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    short = docs.filter(F.length("text") <= chunk_chars).mapInArrow(whole, f"doc_id {kind}, {DIGEST}")

    long = docs.filter(F.length("text") > chunk_chars).withColumn("version", F.sha2("text", 256))
    pieces = encode_long(long, path, chunk_chars, overlap)

    def digests(batches):
        import pyarrow as pa

        decimal, own = tables(path)[2], tables(path)[1]
        version, n, text, raw = None, 0, None, None

        def done():
            return pa.RecordBatch.from_arrays([pa.array([version]), pa.array([n], pa.int64()), pa.array([text.hexdigest()]), pa.array([raw.hexdigest()])], ["version", "n_tokens", "ids_sha256", "decoded_sha256"])

        for b in batches:
            for v, ids in zip(b.column("version").to_pylist(), b.column("ids"), strict=True):
                if v != version:
                    if version is not None:
                        yield done()
                    version, n, text, raw = v, 0, hashlib.sha256(), hashlib.sha256()
                ids = ids.as_py()
                if ids:
                    text.update(((" " if n else "") + " ".join(map(decimal.__getitem__, ids))).encode())
                    raw.update(b"".join(map(own.__getitem__, ids)))
                    n += len(ids)
        if version is not None:
            yield done()

    done = pieces.repartition("version").sortWithinPartitions("version", "start").mapInArrow(digests, f"version string, {DIGEST}")
    return short.unionByName(long.select("doc_id", "version").join(done, "version").drop("version"))


def cuts(frame: pd.DataFrame) -> pd.DataFrame:
    """For the chunks of one text (at, size, last, head, tail): version, at, start, low, high: chunk at gives its characters
    low to high to the piece that starts at start."""
    frame = frame.sort_values("at")
    rows = frame.to_dict("records")
    starts = [0]
    for one, two in zip(rows, rows[1:], strict=False):
        common = set(one["tail"]).intersection(two["head"])
        starts.append(min(common) if common else None)
    out, start = [], 0
    for k, row in enumerate(rows):
        start = row["at"] if starts[k] is None else starts[k]
        after = starts[k + 1] if k + 1 < len(rows) else row["at"] + row["size"]
        end = rows[k + 1]["at"] if after is None else after
        own = next(starts[j] for j in range(k, -1, -1) if starts[j] is not None)
        out.append((row["version"], row["at"], own, start - row["at"], end - row["at"]))
    return pd.DataFrame(out, columns=["version", "at", "start", "low", "high"])


def encode_long(long: DataFrame, path: str, chunk_chars: int, overlap: int) -> DataFrame:
    """version, start, ids of the pieces of each distinct text (version: its digest)."""

    def chunks(batches):
        import pyarrow as pa

        schema = pa.schema([("version", pa.string()), ("at", pa.int64()), ("last", pa.bool_()), ("view", pa.string())])
        for b in batches:
            for version, text in zip(b.column("version").to_pylist(), b.column("text").to_pylist(), strict=True):
                for at in range(0, len(text), chunk_chars):
                    yield pa.RecordBatch.from_pylist([{"version": version, "at": at, "last": at + chunk_chars >= len(text), "view": text[at : at + chunk_chars + overlap]}], schema)

    dealt = long.select("version", "text").mapInArrow(chunks, "version string, at long, last boolean, view string")
    dealt = dealt.dropDuplicates(["version", "at"])

    def ends(batches):
        import pyarrow as pa

        for b in batches:
            view = b.column("view").to_pylist()
            both = [_ends(v, at, chunk_chars, overlap, last) for v, at, last in zip(view, b.column("at").to_pylist(), b.column("last").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(map(len, view), pa.int64()), pa.array([x[0] for x in both], pa.list_(pa.int64())), pa.array([x[1] for x in both], pa.list_(pa.int64()))], ["version", "at", "last", "view", "size", "head", "tail"])

    dealt = cut(dealt.mapInArrow(ends, "version string, at long, last boolean, view string, size long, head array<long>, tail array<long>"))
    placed = dealt.select("version", "at", "size", "head", "tail").groupBy("version").applyInPandas(cuts, "version string, at long, start long, low long, high long")
    parted = dealt.select("version", "at", "view").join(placed, ["version", "at"])
    parted = parted.select("version", "start", "at", F.expr("substring(view, CAST(low + 1 AS INT), CAST(high - low AS INT))").alias("part"))
    # a piece is one chunk's part; of chunks without a common boundary it is all their parts
    pieces = parted.groupBy("version", "start").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "part"))), lambda x: x["part"]), "").alias("piece"))

    def encoded(batches):
        import pyarrow as pa

        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("version"), b.column("start"), pa.array([encode(t, path) for t in b.column("piece").to_pylist()], pa.list_(pa.int32()))], ["version", "start", "ids"])

    return pieces.mapInArrow(encoded, "version string, start long, ids array<int>")


def encode_documents(docs: DataFrame, ranks: str | None = None) -> DataFrame:
    """docs with tokens (array<int>) beside its columns: the general form for texts of ordinary length."""
    path = ranks or default_ranks()

    @F.pandas_udf("array<int>")
    def ids(text: pd.Series) -> pd.Series:
        return text.fillna("").map(lambda t: encode(t, path))

    return docs.withColumn("tokens", ids("text"))
