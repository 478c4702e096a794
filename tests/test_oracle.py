"""Every query beside its reference SQL, on the smallest tables."""

import math
import os

import duckdb
import pytest

from tidemark import catalog

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}") + 0.0
    return float(f"{float(v):.9g}") if type(v).__name__ == "Decimal" else v


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.mark.skipif(not os.path.isdir(SF), reason="needs the driver's tables")
@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_matches_sql(spark, con, name):
    df = catalog.queries()[name](spark, SF)
    columns = sorted(df.columns)
    got = ordered([tuple(norm(r[c]) for c in columns) for r in df.collect()])
    result = con.execute(catalog.oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    assert got == ordered([tuple(norm(r[i]) for i in at) for r in result.fetchall()])


def test_registry():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert catalog.FLAGSHIP in entry.queries()
