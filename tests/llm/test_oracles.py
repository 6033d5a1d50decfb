"""The registered queries against their DuckDB SQL on the smallest tables."""

import duckdb
import pytest

from tessera.llm import registry
from tests.conftest import SMALL
from tools.check_oracle import normalize


@pytest.mark.parametrize("name", sorted(registry.oracle()))
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "conversations", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    df = registry.queries()[name](spark, SMALL)
    got = normalize(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(registry.oracle()[name])
    assert got == normalize([d[0] for d in cur.description], cur.fetchall())
