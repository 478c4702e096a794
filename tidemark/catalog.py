"""All registered queries of the library with their reference SQL."""

from __future__ import annotations

from .plans import assurance, extra, geometry, places, planning, replay, sampling, series, streams, training  # noqa: F401  (they register their queries)
from .plans.registry import QUERIES, SQL

FLAGSHIP = "scan_quality_decisions"


def queries():
    return dict(QUERIES)


def oracle_sql():
    return dict(SQL)
