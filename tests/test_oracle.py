"""Every registered query against its DuckDB oracle on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from tessera.plans import queries as registry
from tests.conftest import SMALL
from tools.check_oracle import TABLES, normalize

# The models, checks and sources; tests/llm has the training-data operators.
QUERIES = registry.queries()
ORACLE = registry.oracle()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SMALL}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SMALL)
    got = normalize(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(ORACLE[name])
    want = normalize([d[0] for d in cur.description], cur.fetchall())
    assert got[0] == want[0]
    assert len(got[1]) == len(want[1])
    assert got[1] == want[1]


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["month_year", "itemname", "order_count", "popularity_label"]
    assert df.count() > 0
