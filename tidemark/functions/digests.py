"""Stable digests: canonical JSON, name-based identifiers, fingerprints of files, and digests of sets of records."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: The namespace of names that are URLs, as the standard of such identifiers fixes it.
NAMESPACE_URL = "6ba7b811-9dad-11d1-80b4-00c04fd430c8"


def uuid5(name: Column, namespace: str = NAMESPACE_URL) -> Column:
    """The version 5 identifier of a name: the first 16 bytes of a SHA-1 with six bits set for version and variant."""
    digest = F.sha1(F.concat(F.unhex(F.lit(namespace.replace("-", ""))), F.encode(name.cast("string"), "UTF-8")))
    variant = F.substring(F.lit("89ab"), (F.conv(F.substring(digest, 17, 1), 16, 10).cast("int") % 4) + 1, F.lit(1))
    hexes = F.concat(F.substring(digest, 1, 12), F.lit("5"), F.substring(digest, 14, 3), variant, F.substring(digest, 18, 15))
    return F.concat_ws("-", *[F.substring(hexes, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])


def stable_uuid(prefix: str, namespace: str, value: Column) -> Column:
    return uuid5(F.concat(F.lit(f"{prefix}:{namespace}:"), value.cast("string")))


def canonical_json(text: Column) -> Column:
    """JSON text with keys in order of code points at every depth, no white space, numbers in shortest form, text as it is.

    Null for what is no JSON, and for numbers that are not finite. Arrow batches go through the JSON module of the workers: a
    JSON text has no fixed depth, and no expression walks it.
    """
    def one(t):
        try:
            return json.dumps(json.loads(t), ensure_ascii=False, sort_keys=True, separators=(",", ":"), allow_nan=False)
        except (TypeError, ValueError):
            return None

    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(one)

    return run(text)


def config_hash(text: Column) -> Column:
    """SHA-256 of the canonical JSON: equal for texts that say the same."""
    return F.sha2(canonical_json(text), 256)


def fingerprint(content: Column, block: int = 1 << 20) -> Column:
    """SHA-256 of a file's first block, its last block if it is longer than one, and its length in decimal.

    content: bytes, as the binaryFile source gives them.
    """
    n = F.octet_length(content)
    tail = F.when(n > block, content.substr(F.greatest(n - block, F.lit(0)) + 1, F.lit(block))).otherwise(F.lit(b""))
    return F.sha2(F.concat(content.substr(F.lit(1), F.lit(block)), tail, F.encode(n.cast("string"), "UTF-8")), 256)


def stat_fingerprint(length: Column, modified_ns: Column) -> Column:
    return F.concat_ws(":", length.cast("string"), modified_ns.cast("string"))


def multiset(record: Column) -> Column:
    """Aggregate: a digest of a group's records in any order, repeats counted. It is drawn from sums of three 60-bit parts of the
    records' digests, so tasks combine it before they shuffle and no group is collected."""
    digest = F.sha2(record, 256)
    sums = [F.sum(F.conv(F.substring(digest, at, 15), 16, 10).cast("decimal(20,0)")) for at in (1, 16, 31)]
    return F.sha2(F.concat_ws(":", F.count(record).cast("string"), *[s.cast("string") for s in sums]), 256)
