"""Every registered query against its SQL on the smallest tables."""

import collections
import glob
import os

import duckdb
import pytest

from contiglink.plans import queries as core


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for p in glob.glob(f"{sf}/*.parquet"):
        con.execute(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    return con


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return sorted(columns), collections.Counter(tuple(round(r[k], 9) if isinstance(r[k], float) else r[k] for k in order) for r in rows)


@pytest.mark.parametrize("name", sorted(core.oracle_sql()))
def test_query(spark, sf, duck, name):
    df = core.queries()[name](spark, sf)
    got = table(df.columns, map(tuple, df.collect()))
    want = duck.execute(core.oracle_sql()[name])
    assert got == table([d[0] for d in want.description], want.fetchall())


def test_entry_points(spark, sf):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert e.entry(spark).count() == 7
