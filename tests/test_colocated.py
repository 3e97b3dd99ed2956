"""Tables that lie by station: plans without exchanges, the same rows, sound buckets, and another session."""

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from skyledger import schema
from skyledger.operators import fabric, por, tables

B = 7


@pytest.fixture(scope="module")
def made(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("colocated")
    days = [date(2024, 1, 1) + timedelta(k) for k in range(20)]
    rows = [(f"{s}:{k}", s, d, float(k + i), None if i % 5 == 0 else float(i), "fail" if i % 7 == 0 else "pass", 40.0 + k, -100.0, 5.0) for s in ("ghcnd", "madis") for k in range(30) for i, d in enumerate(days)]
    series = spark.createDataFrame(rows, "station_key string, source string, date date, tmax double, tmin double, qc_state string, lat double, lon double, elev_m double")
    cross = [(f"{s}:{k}", s, 40.0 + k, -100.0, 5.0, f"ghcn:{k // 2}", float(k % 2)) for s in ("ghcnd", "madis") for k in range(30)]
    crosswalk = spark.createDataFrame(cross, "source_station_key string, source string, lat double, lon double, elev_m double, canonical_station_id string, distance_m double")
    tables.write(crosswalk, "cross", str(root / "cross"), "canonical_station_id", buckets=B)
    fabric.colocate(series, crosswalk, "named", str(root / "named"), buckets=B)
    por.write_station_por(series, str(root / "por"), buckets=B, table="por")
    tables.write(crosswalk, "cross_by_station", str(root / "cross2"), "source_station_key", buckets=B)
    yield root, series, crosswalk
    for t in ("cross", "named", "por", "cross_by_station", "fabric"):
        spark.sql(f"DROP TABLE IF EXISTS {t}")


@pytest.fixture
def no_broadcast(spark):
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)


def plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


@pytest.mark.parametrize("bbox", [None, (-101.0, 45.0, -99.0, 52.0)])
def test_fabric_where_the_rows_lie(spark, made, no_broadcast, bbox):
    root, series, crosswalk = made
    order = schema.PRECEDENCE["daily"]
    how = {"precedence": order, "bbox": bbox, "start": date(2024, 1, 3), "end": date(2024, 1, 15)}
    got = fabric.build_fabric(spark.table("named"), spark.table("cross"), **how)
    want = fabric.build_fabric(series, crosswalk, **how)
    assert got.columns == want.columns and sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.count() > 0
    assert "Exchange" not in plan(got) and "Exchange" in plan(want)


def test_products_meet_where_they_lie(spark, made, no_broadcast):
    """Series with the crosswalk by station; two fabrics by canonical station."""
    root, series, crosswalk = made
    ids = spark.table("cross_by_station").select(F.col("source_station_key").alias("station_key"), "canonical_station_id")
    joined = spark.table("por").join(ids, "station_key")
    assert joined.count() == series.count() and "Exchange" not in plan(joined.select("station_key", "date", "canonical_station_id"))
    made_fabric = fabric.build_fabric(spark.table("named"), spark.table("cross"), precedence=schema.PRECEDENCE["daily"])
    fabric.write_fabric(made_fabric, str(root / "fabric"), table="fabric", buckets=B)
    counts = spark.table("named").groupBy("canonical_station_id", "date").agg(F.count("tmax").alias("n"))
    both = spark.table("fabric").join(counts, ["canonical_station_id", "date"]).select("canonical_station_id", "date", "tmax", "n")
    assert both.count() == 15 * 20 and "Exchange" not in plan(both)


def test_buckets_are_sound(spark, made):
    """What lies in a bucket's file is what its key says, and all of it is there."""
    root, series, _ = made
    for name, key, n in (("por", "station_key", series.count()), ("named", "canonical_station_id", series.count())):
        assert tables.misplaced(spark, str(root / name), key, buckets=B).isEmpty() and spark.read.parquet(str(root / name)).count() == n
        files = spark.read.parquet(str(root / name)).select(F.col("_metadata.file_name").alias("f"), key).distinct()
        assert files.groupBy(key).count().where("count > 1").isEmpty() and files.select("f").distinct().count() <= B
    assert not tables.misplaced(spark, str(root / "por"), "station_key", buckets=B + 1).isEmpty()


def test_attached_by_another_session(spark, made, no_broadcast):
    root, series, _ = made
    other = spark.newSession()
    other.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    t = tables.attach(other, "por_again", str(root / "por"), "station_key", sort=("date",), buckets=B)
    grouped = t.groupBy("station_key").agg(F.max("tmax").alias("tmax"))
    assert "Exchange" not in plan(grouped)
    assert sorted(map(tuple, grouped.collect())) == sorted(map(tuple, series.groupBy("station_key").agg(F.max("tmax")).collect()))
    other.sql("DROP TABLE por_again")
    assert spark.read.parquet(str(root / "por")).count() == series.count()  # dropping the name leaves the files
