"""Late cycles as a stream against the batch form."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from skyledger.operators.temporal import prepare_gdas
from skyledger.streaming.daily import run_available
from skyledger.streaming.stitch import stitched_days_stream, stitched_stream

KIND = "station_key string, datetime_utc timestamp, cycle int, tair double, psfc double, q double, u double, v double"


def cycles(seed=4):
    """Six hourly times of three stations over five days, each in one to three cycles with gaps; equal rows; empty columns."""
    r = random.Random(seed)
    rows = []
    for s in "abc":
        for k in range(20):
            at = datetime(2024, 1, 1) + timedelta(hours=6 * k)
            for c in r.sample((0, 6, 12, 18), r.randint(1, 3)):
                maybe = lambda x: x if r.random() < 0.7 else None
                rows.append((s, at, c, maybe(r.uniform(-9, 9)), maybe(90000.0), maybe(0.004), maybe(r.uniform(-3, 3)), maybe(r.uniform(-3, 3))))
    return rows + rows[:5]


@pytest.mark.parametrize("seed", [1, 2])
def test_any_order_of_arrival(spark, tmp_path, seed):
    rows = cycles()
    batch = prepare_gdas(spark.createDataFrame(rows, KIND))
    days = batch.groupBy("station_key", F.to_date("datetime_utc").alias("date")).agg(F.max("tair").alias("tmax"), F.count("tair").alias("n"))
    random.Random(seed).shuffle(rows)
    for k in range(4):  # files of mixed days, one a step; the last moves the watermark on
        part = rows[k::4] + ([("z", datetime(2024, 3, 1), 0, 0.0, None, None, None, None)] if k == 3 else [])
        spark.createDataFrame(part, KIND).coalesce(1).write.parquet(str(tmp_path / f"in/{k}"))
    schema = spark.createDataFrame([], KIND).schema
    go = lambda f, n: run_available(spark, str(tmp_path / "in/*"), schema, f, str(tmp_path / n), str(tmp_path / f"{n}-cp"), files=1)
    go(lambda df: stitched_stream(df, late="10 days"), "rows")
    cols = ["station_key", "datetime_utc", "cycle", "tair", "td", "wind", "wind_dir"]
    got = spark.read.parquet(str(tmp_path / "rows")).where("station_key <> 'z'").select(cols)
    assert sorted(map(str, got.collect())) == sorted(map(str, batch.select(cols).collect())) and got.count() == 60
    go(lambda df: stitched_days_stream(df, late="10 days"), "days")
    out = spark.read.parquet(str(tmp_path / "days")).where("station_key <> 'z'")
    assert {(r.station_key, r.date, r.tmax) for r in out.collect()} == {(r.station_key, r.date, r.tmax) for r in days.collect()}


def test_late_cycles_after_the_watermark(spark, tmp_path):
    """A time is given out once; a cycle that comes after that changes nothing; a restart goes on from the checkpoint."""
    schema = spark.createDataFrame([], KIND).schema
    put = lambda rows, k: spark.createDataFrame([(*r, None, None, None, None) for r in rows], KIND).coalesce(1).write.parquet(str(tmp_path / f"in/{k}"))
    go = lambda: run_available(spark, str(tmp_path / "in/*"), schema, lambda df: stitched_stream(df, late="1 day"), str(tmp_path / "out"), str(tmp_path / "cp"))
    read = lambda: sorted((r.station_key, r.datetime_utc.day, r.cycle, r.tair) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    t = lambda d: datetime(2024, 1, d)
    put([("a", t(1), 6, 6.0), ("a", t(1) + timedelta(hours=12), 12, 2.0)], 0)
    go()
    put([("a", t(1), 0, 1.0), ("a", t(5), 0, 5.0)], 1)  # an earlier cycle of an open time
    go()
    assert read() == [("a", 1, 0, 1.0), ("a", 1, 12, 2.0)]
    put([("a", t(1), 0, 99.0), ("a", t(9), 0, 9.0)], 2)  # its time is closed
    go()
    assert read() == [("a", 1, 0, 1.0), ("a", 1, 12, 2.0), ("a", 5, 0, 5.0)]
