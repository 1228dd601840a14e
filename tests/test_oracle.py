"""Every registered query against its DuckDB SQL on the smallest tables."""

import datetime as dt
import math
import os

import duckdb
import pytest

from helpers import SF_TINY

TABLES = "region nation customer supplier part orders lineitem".split()


def _norm(v):
    if isinstance(v, float) and math.isnan(v):
        return "NaN"
    if isinstance(v, dt.datetime):
        return v.isoformat()
    return v


def _key(row):
    return tuple((x is None, str(type(x)), x if x is not None else 0) for x in row)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_TINY}/{t}.parquet')")
    return con


import __spark_entry__ as entry  # noqa: E402
from waybatch.plans.oracle_sql import build  # noqa: E402

KEYS = sorted(build())


@pytest.mark.skipif(not os.path.isdir(SF_TINY), reason="driver tables missing")
@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, duck, key):
    df = entry.queries()[key](spark, SF_TINY)
    got = sorted((tuple(_norm(x) for x in r) for r in df.collect()), key=_key)
    rel = duck.sql(entry.oracle_sql()[key])
    assert sorted(rel.columns) == sorted(df.columns)
    order = [rel.columns.index(c) for c in df.columns]
    want = sorted((tuple(_norm(r[i]) for i in order) for r in rel.fetchall()), key=_key)
    assert got == want


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() >= 0 and "geometry" in df.columns
