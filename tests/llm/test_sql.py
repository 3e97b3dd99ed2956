"""The queries against their SQL in DuckDB, on the smallest tables."""

import duckdb
import pytest

from skyledger.llm import queries


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_matches_sql(spark, sf, name):
    db = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings"):
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    got = queries.queries()[name](spark, sf)
    want = db.execute(queries.oracle_sql()[name])
    names = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(names)
    assert sorted(map(tuple, got.select(names).collect())) == sorted(want.fetchall())
