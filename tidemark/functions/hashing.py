"""Deterministic ranks, buckets and identifiers: pure functions of a seed and an identity."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rank(identity, seed) -> Column:
    """The deterministic shuffle: SHA-256 of "seed:identity", to be sorted ascending."""
    return F.sha2(F.concat(F.lit(f"{seed}:"), identity.cast("string")), 256)


def bucket(identity, modulus: int, salt: str = "") -> Column:
    """First eight hex digits of the salted digest, modulo modulus."""
    digest = F.sha2(F.concat(F.lit(salt), identity.cast("string")), 256)
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % modulus


def split(identity, cuts: list[tuple[int, str]], last: str, modulus: int, salt: str = "") -> Column:
    """Name of the first (bound, name) whose bound is above the identity's bucket."""
    b = bucket(identity, modulus, salt)
    chosen = F.when(b < cuts[0][0], cuts[0][1])
    for bound, name in cuts[1:]:
        chosen = chosen.when(b < bound, name)
    return chosen.otherwise(last)


def short_id(prefix: str, length: int, *parts) -> Column:
    """prefix and the first digits of the digest of the parts joined by "|"."""
    return F.concat(F.lit(prefix), F.substring(F.sha2(F.concat_ws("|", *[p.cast("string") for p in parts]), 256), 1, length))
