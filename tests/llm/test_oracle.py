"""The operators' queries against their DuckDB SQL on the smallest tables."""

import duckdb
import pytest

from ampere.llm.queries import ORACLE, QUERIES

DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, name):
    con = duckdb.connect()
    for t in "documents embeddings pages benchmark labels conversations".split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DIR}/{t}.parquet')")
    cur = con.execute(ORACLE[name])
    columns = [d[0] for d in cur.description]
    got = QUERIES[name](spark, DIR)
    assert sorted(got.columns) == sorted(columns)
    assert sorted(map(tuple, got.select(*columns).collect()), key=repr) == sorted(cur.fetchall(), key=repr)


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
