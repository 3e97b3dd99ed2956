"""Every catalog query against its SQL in DuckDB, on the smallest tables."""

import math
from datetime import date, datetime

import duckdb
import pytest

import __spark_entry__ as entry
from skyledger.plans import catalog

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, float):
        return round(v, 5) + 0.0
    if isinstance(v, datetime):
        return v.replace(tzinfo=None).isoformat()
    return v.isoformat() if isinstance(v, date) else v


def rows(names, found):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in found), key=repr)


@pytest.fixture(scope="module")
def db(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query_matches_sql(spark, sf, db, name):
    got = catalog.queries()[name](spark, sf)
    want = db.execute(catalog.oracle_sql()[name])
    names = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(names)
    assert rows(got.columns, map(tuple, got.collect())) == rows(names, want.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_day_source_index_reads_every_day(spark, sf, db):
    """All rows count, and each station has its own period."""
    got = catalog.queries()["sampled_station_index"](spark, sf).collect()
    assert sum(r.n_obs for r in got) == db.execute("SELECT count(*) FROM events").fetchone()[0]
    want = db.execute("SELECT event_type, CAST(user_id AS VARCHAR), min(CAST(ts AS DATE)), max(CAST(ts AS DATE)) FROM events GROUP BY ALL").fetchall()
    assert sorted((r.source, r.source_station_id, r.first_day, r.last_day) for r in got) == sorted(want)
