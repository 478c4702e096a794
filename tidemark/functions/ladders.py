"""Ordered decisions as single CASE expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ladder(*steps: tuple, otherwise=None) -> Column:
    """Value of the first (condition, value) that holds; a null condition doesn't."""
    chosen = None
    for condition, value in steps:
        value = value if isinstance(value, Column) else F.lit(value)
        chosen = F.when(condition, value) if chosen is None else chosen.when(condition, value)
    return chosen.otherwise(otherwise if isinstance(otherwise, Column) else F.lit(otherwise))


def severity(value, warning: float, error: float, missing: str = "error") -> Column:
    """info, warning or error; missing names what a null or NaN is worth."""
    return ladder((value.isNull() | F.isnan(value), missing), (value >= error, "error"), (value >= warning, "warning"), otherwise="info")


def reasons(**checks: Column) -> Column:
    """Names of the checks that hold, in the order given."""
    return F.array_compact(F.array(*[F.when(c, F.lit(name)) for name, c in checks.items()]))


#: Issue codes by the family that decides about them.
OPERATIONAL = ["data_read_failed", "episode_validation_failed", "video_open_failed", "video_probe_unavailable", "metadata_read_failed"]
HARD = ["missing_columns", "episode_length_mismatch", "frame_index_not_contiguous", "non_finite_values", "invalid_rotation_matrix", "kept_mask_mismatch"]


def tier(codes, severities) -> Column:
    """quarantine for a hard code, bronze for an error, silver for a warning, else gold."""
    hard = F.arrays_overlap(codes, F.array(*map(F.lit, HARD)))
    return ladder((hard, "quarantine"), (F.array_contains(severities, "error"), "bronze"), (F.array_contains(severities, "warning"), "silver"), otherwise="gold")


def decision(operational, formal, numeric, motion, motion_policy: str = "review") -> Column:
    """retry > quarantine > reject > motion_policy > accept."""
    return ladder((operational, "retry"), (formal, "quarantine"), (numeric, "reject"), (motion, motion_policy), otherwise="accept")
