"""Facts from footers against those of a scan."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from skyledger.operators import crosswalk, footers, release


@pytest.fixture(scope="module")
def days(spark, tmp_path_factory):
    """A file a day for eight days, times with statistics and, in the old kind, without; one broken file."""
    out = {}
    for kind in ("TIMESTAMP_MICROS", "INT96"):
        root = tmp_path_factory.mktemp(kind.lower())
        spark.conf.set("spark.sql.parquet.outputTimestampType", kind)
        for d in range(1, 9):
            rows = [(f"madis:{s}", "madis", s, 40.0 + d, -100.0, None, datetime(2024, 1, d, h), "fail" if h == 9 else None if h == 10 else "pass") for s in "ab" for h in range(8, 12)]
            rows += [("madis:a", "madis", "a", 40.0, -100.0, None, None, "pass")]
            df = spark.createDataFrame(rows, "station_key string, source string, source_station_id string, lat double, lon double, elev_m double, datetime_utc timestamp, qc_state string")
            df.coalesce(1).write.parquet(str(root / f"2024010{d}"))
        spark.conf.unset("spark.sql.parquet.outputTimestampType")
        out[kind] = str(root)
    return out


@pytest.mark.parametrize("kind,reads", [("TIMESTAMP_MICROS", False), ("INT96", True)])
def test_statistics(spark, days, kind, reads):
    """No page is read where there are statistics; without them that column is."""
    got = footers.file_statistics(spark, days[kind], "datetime_utc").collect()
    want = spark.read.option("recursiveFileLookup", "true").parquet(days[kind]).groupBy(F.col("_metadata.file_path").alias("path")).agg(F.count(F.lit(1)), F.min("datetime_utc"), F.max("datetime_utc")).collect()
    assert sorted((r.path, r.n_rows, r.low, r.high) for r in got) == sorted(map(tuple, want)) and {r.pages_read for r in got} == {reads}
    none = footers.file_statistics(spark, days[kind], "no_such_column").first()
    assert (none.n_rows, none.low, none.pages_read) == (9, None, False)


def test_broken_and_empty_files(spark, tmp_path):
    (tmp_path / "a.parquet").write_bytes(b"broken")
    spark.createDataFrame([], "date date").coalesce(1).write.parquet(str(tmp_path / "b"))
    assert [(r.n_rows, r.low) for r in footers.file_statistics(spark, str(tmp_path), "date").collect()] == [(0, None)]


def test_release_facts(spark, days):
    got = {r.path: (r.row_count, str(r.date_min), str(r.date_max), json.loads(r.qc_summary)) for r in release.file_facts(spark, days["TIMESTAMP_MICROS"]).collect()}
    assert len(got) == 8 and {v[0] for v in got.values()} == {9} and all(v[3] == {"fail": 2, "missing": 2, "pass": 5} and v[1] == v[2] for v in got.values())
    assert all(f"/{v[1].replace('-', '')}/" in p and p.startswith("/") for p, v in got.items())


def test_index_of_day_files(spark, days):
    """Coordinates and counts of a sample of files, and one period for all, from the first file's first to the last file's last time."""
    root = days["TIMESTAMP_MICROS"]
    got = {r.source_station_id: r for r in crosswalk.index_of_day_files(spark, root, sample_files=3).collect()}
    assert set(got) == {"a", "b"} and (got["b"].obs_count, got["b"].lat, got["b"].temporal_res) == (12, 44.0, "hourly")
    assert {(r.por_start, r.por_end) for r in got.values()} == {(datetime(2024, 1, 1, 8), datetime(2024, 1, 8, 11))}
    rows = spark.read.option("recursiveFileLookup", "true").parquet(root).where("datetime_utc is not null")
    same = crosswalk.index_per_day_source(rows, sample_days=3).where("source_station_id = 'b'").first()
    assert (same.obs_count, same.lat, same.por_start, same.por_end) == (12, 44.0, datetime(2024, 1, 1, 8), datetime(2024, 1, 8, 11))
    with pytest.raises(ValueError):
        crosswalk.index_of_day_files(spark, f"{root}/20240101/_SUCCESS")
