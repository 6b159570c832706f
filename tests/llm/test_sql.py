"""Queries against their SQL on the smallest tables."""

import collections
import glob
import os

import duckdb
import pytest

from contiglink.llm import queries as llm


@pytest.mark.parametrize("name", sorted(llm.oracle_sql()))
def test_query(spark, sf, name):
    con = duckdb.connect()
    for p in glob.glob(f"{sf}/*.parquet"):
        con.execute(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    df = llm.queries()[name](spark, sf)
    want = con.execute(llm.oracle_sql()[name])
    names = sorted(d[0] for d in want.description)
    at = [[d[0] for d in want.description].index(n) for n in names]
    assert sorted(df.columns) == names
    expected = collections.Counter(tuple(r[k] for k in at) for r in want.fetchall())
    assert collections.Counter(map(tuple, df.select(*names).collect())) == expected
