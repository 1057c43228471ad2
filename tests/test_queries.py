"""Every registered query against its SQL twin on the smallest tables."""

import math
import os
from pathlib import Path

import duckdb
import pytest

import catalog

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
ENTRIES = catalog.load()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for f in Path(SF).glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    yield con
    con.close()


def shown(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return repr(value)


@pytest.mark.parametrize("name", ENTRIES)
def test_query(spark, duck, name):
    fn, sql = ENTRIES[name]
    df = fn(spark, SF)
    cols = sorted(df.columns)
    got = sorted(tuple(shown(r[c]) for c in cols) for r in df.collect())
    if sql is None:
        assert got
        return
    cur = duck.execute(sql)
    names = [d[0] for d in cur.description]
    assert sorted(names) == cols
    at = [names.index(c) for c in cols]
    assert got == sorted(tuple(shown(r[i]) for i in at) for r in cur.fetchall())


def test_entry_points():
    import __spark_entry__ as driver

    found = set(driver.queries())
    assert set(driver.oracle_sql()) <= found and set(ENTRIES) <= found
    assert all(name.startswith("op") or name == "pipeline" for name in found - set(ENTRIES))
