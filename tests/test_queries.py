"""Every registered query of the engine against its SQL, on the driver's smallest tables."""

import glob
import os

import duckdb
import pytest

from tarnlab.plans import catalog

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="the driver's tables aren't here")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.sql("SET TimeZone = 'UTC'")
    for p in glob.glob(f"{DATA}/*.parquet"):
        c.sql(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}{'/*.parquet' if os.path.isdir(p) else ''}'")
    return c


def plain(v):
    if isinstance(v, float):
        return float(f"{v:.9g}")
    return v


def rows(found):
    return sorted((tuple(plain(v) for v in r) for r in found), key=repr)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, con, name):
    df = catalog.QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    got = rows(tuple(r) for r in df.select(*columns).collect())
    if name not in catalog.SQL:
        assert got
        return
    expected = con.sql(catalog.SQL[name])
    assert sorted(expected.columns) == columns
    assert got == rows(expected.select(*[f'"{c}"' for c in columns]).fetchall())
