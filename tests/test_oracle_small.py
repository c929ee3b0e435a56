"""Registered queries against their DuckDB SQL on the smallest generated tables."""

import datetime as dt
import math
import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
from ampere.oracle import ORACLE
from ampere.plans.queries import QUERIES
from tests.conftest import SF_SMALL

TABLES = "region nation customer supplier part orders lineitem events".split()
CHECKED = sorted(QUERIES)  # every query of the library itself


def norm(v):
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else round(v, 9)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.skipif(not os.path.exists(SF_SMALL), reason="generated tables not present")
@pytest.mark.parametrize("name", CHECKED)
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF_SMALL)
    cur = duck.execute(entry.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(dcols)
    order = sorted(df.columns)
    s = Counter(tuple(norm(r[c]) for c in order) for r in df.collect())
    d = Counter(tuple(norm(r[dcols.index(c)]) for c in order) for r in cur.fetchall())
    assert s == d


def test_every_query_has_oracle_or_is_documented():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "z_score" in df.columns
