"""Operators on small frames: rules, daily aggregation, series checks, identity, fabric, state, releases, sources."""

from datetime import UTC, date, datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyledger import schema
from skyledger.functions import columns as C
from skyledger.functions import units
from skyledger.functions.humidity import compile_humidity
from skyledger.operators import corrections, crosswalk, daily, fabric, manifest, por, release, rules, temporal
from skyledger.sources import acquire, readers, registry
from skyledger.streaming.daily import daily_stream, run_available

T0 = datetime(2024, 1, 2, tzinfo=UTC)


def hours(spark, values, name="tair", key="t:1", **more):
    data = [(key, T0 + timedelta(hours=i), None if v is None else float(v), *more.values()) for i, v in enumerate(values)]
    return spark.createDataFrame(data, f"station_key string, datetime_utc timestamp, {name} double" + "".join(f", {k} string" for k in more))


def test_daily_extremes_and_coverage(spark):
    r = daily.aggregate_daily_wide(hours(spark, range(24)), source="madis").first()
    assert (r.tmax, r.tmin, r.tmean, r.obs_count) == (23, 0, 11.5, 24)
    assert r.coverage_flags == "n=24,thresh=Y,am=Y,pm=Y" and r.day_basis == "utc" and r.qc_state == "pass"
    r = daily.aggregate_daily_wide(hours(spark, [1, None, 3]), source="madis").first()
    assert (r.tmean, r.obs_count, r.coverage_flags) == (2, 3, "n=3,thresh=N,am=N,pm=N")
    assert daily.aggregate_daily_wide(spark.createDataFrame([(1,)], "x int")).count() == 0


def test_accumulated_precipitation_resets(spark):
    r = daily.aggregate_daily_wide(hours(spark, [0, 2, 5, None, 1, 4], "prcp"), source="madis").first()
    assert r.prcp == 8  # 2 + 3, then 3 after the reset


def test_wind_wraps(spark):
    r = daily.aggregate_daily_wide(hours(spark, [350, 10], "wind_dir")).first()
    assert min(r.wind_dir, 360 - r.wind_dir) < 1e-6


def test_failed_values_leave(spark):
    df = hours(spark, [10, 50], qc_state="fail").withColumn("tair_qc_state", F.when(F.col("tair") == 50, "fail").otherwise("pass"))
    assert daily.drop_failed(df).count() == 1
    assert daily.aggregate_daily_wide(daily.drop_failed(df)).first().tmax == 10


def test_pipeline_folds_and_seeds(spark):
    df = spark.createDataFrame([(70.0, 5.0, "suspect", "old"), (10.0, 11.0, None, None), (None, None, "fail", "x")], "tair double, td double, tair_qc_state string, tair_qc_reason_codes string")
    a, b, c = rules.apply_pipeline(df, rules.default_pipeline("ndbc"), ["tair", "td"]).collect()
    assert (a.tair_qc_state, a.tair_qc_reason_codes, a.qc_reason_codes) == ("fail", "old,out_of_bounds", "tair:out_of_bounds")
    assert (b.td_qc_state, b.qc_state, b.qc_reason_codes) == ("fail", "fail", "td:td_exceeds_tair")
    assert (c.tair_qc_state, c.qc_state) == ("fail", "pass")


def test_native_rules(spark):
    df = spark.createDataFrame([("V", 0.0), (None, 2.0), ("Z", 115.0)], "temperatureDD string, temperatureQCR double").withColumn("tair", F.lit(1.0))
    got = rules.apply_pipeline(df, rules.default_pipeline("madis"), ["tair"]).collect()
    assert [r.tair_qc_state for r in got] == ["pass", "fail", "fail"]
    assert got[2].tair_qc_reason_codes == "dd_rejected_z,qcr_reject"
    raw = spark.createDataFrame([(300.0, "V", 0.0), (300.0, None, 0.0), (400.0, "V", 0.0)], "temperature double, temperatureDD string, temperatureQCR double")
    assert [r.qc_passed for r in rules.madis_extract_qc(raw).collect()] == [True, False, False]


def test_units_and_columns(spark):
    one = spark.range(1)
    reg = units.default_registry()
    r = one.select(reg.convert(F.lit(212.0), "tair", "degF").alias("c"), reg.convert(F.lit(5.0), "tair", "degC").alias("same"), C.haversine(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(1.0)).alias("m"), C.parse_dms(F.lit("40 30'0\" W")).alias("w"), C.num(F.lit("x")).alias("bad"), C.offset_minutes(F.lit("NL"), F.lit(-52.0)).alias("nl")).first()
    assert r.c == pytest.approx(100) and r.same == 5 and r.m == pytest.approx(111194.9, abs=1) and r.w == -40.5 and r.bad is None and r.nl == -210
    with pytest.raises(KeyError):
        reg.convert(F.lit(1.0), "nothing", "x")


def test_humidity_priority(spark):
    df = spark.createDataFrame([(20.0, 10.0, None, 50.0), (20.0, 10.0, 9.0, 50.0)], "tmax double, tmin double, td double, rh double")
    a, b = compile_humidity(df).collect()
    assert b.td_compiled == 9.0 and 0.8 < a.ea_compiled < 1.0 and a.tavg == 15


def daily_series(spark, n=1461, key="s:1", start=date(2019, 1, 1), **values):
    rng = np.random.default_rng(42)
    rows = [(key, start + timedelta(i), *(float(f(i, rng)) for f in values.values())) for i in range(n)]
    return spark.createDataFrame(rows, "station_key string, date date, " + ", ".join(f"{k} double" for k in values))


def test_zscore_and_tier2(spark):
    df = daily_series(spark, td=lambda i, r: 100 if i == 700 else r.normal(5, 1), prcp=lambda i, r: {10: 80, 11: 700}.get(i, 0))
    out = {r.date: r for r in temporal.tier2(df, ["td", "prcp"]).where("qc_state <> 'pass' or date = '2019-01-11'").collect()}
    assert out[date(2019, 1, 1) + timedelta(700)].qc_reason_codes == "zscore_td"
    assert out[date(2019, 1, 12)].qc_reason_codes == "prcp_exceeds_daily_max" and out[date(2019, 1, 11)].qc_state == "pass"


def test_humidity_drift(spark):
    df = daily_series(spark, n=730, rhmax=lambda i, r: 80 - (i % 10))
    assert temporal.rh_drift(df, "rhmax", keys=["station_key"]).first().state == "fail"
    assert temporal.rh_drift(daily_series(spark, n=100, rhmax=lambda i, r: 80), "rhmax", keys=["station_key"]).first().state == "pass"


def test_radiation_ratio(spark):
    sky = lambda i: 20 + 18 * np.sin(i / 58)
    df = daily_series(spark, n=180, rsds=lambda i, r: sky(i) * (2.5 if i < 60 else 0.99), rso=lambda i, r: sky(i))
    out = temporal.rs_period_ratio(df, key="station_key").orderBy("date").collect()
    # Values beyond twice the highest clear sky go first and are not judged.
    assert all(r.rs_state == ("fail" if 2.5 * sky(i) <= 76 else "pass") for i, r in enumerate(out[:60]) if abs(2.5 * sky(i) - 76) > 1)
    assert sum(r.rs_state == "fail" for r in out[:60]) > 30 and all(r.rs_state == "pass" for r in out[60:])
    short = temporal.rs_period_ratio(daily_series(spark, n=59, rsds=lambda i, r: 90, rso=lambda i, r: 20), key="station_key")
    assert {r.rs_state for r in short.collect()} == {"pass"}


def test_clear_sky(spark):
    s = spark.createDataFrame([("a", 45.0, 300.0), ("b", None, 1.0), ("c", 95.0, 1.0)], "station_key string, lat double, elev_m double")
    top = temporal.clear_sky_table(s.where("station_key = 'a'")).agg(F.max("rso")).first()[0]
    assert 20 < top < 45
    assert {r.station_key: r.reason for r in temporal.resolve_rso(s).collect()} == {"a": None, "b": "missing_lat_or_elev", "c": "invalid_lat"}


def test_gdas_stitching(spark):
    rows = [("g:1", T0 + timedelta(hours=i), 3.0, 4.0, 0.005, 100000.0, "00") for i in range(6)] + [("g:1", T0, 3.0, 4.0, 0.005, 100000.0, "06"), ("g:1", T0 + timedelta(days=1), 3.0, 4.0, 0.005, 1e5, "00")]
    df = spark.createDataFrame(rows, "station_key string, datetime_utc timestamp, u double, v double, q double, psfc double, cycle string")
    out = por.build_station_por(df, source="gdas").series.orderBy("date").collect()
    assert [r.obs_count for r in out] == [6, 1] and out[0].wind == pytest.approx(5.0)


def test_least_record(spark):
    done = por.build_station_por(hours(spark, range(48)).withColumn("rh", F.lit(50.0)), source="ndbc", min_por_days=30)
    assert done.series.count() == 0 and done.skipped.first().reason == "insufficient_por_days" and done.qc_skipped.count() == 0


def test_crosswalk(spark):
    rows = [("ghcnh", "A1", 40.0, -100.0), ("ghcnd", "A1", 40.0, -100.0), ("madis", "X", 40.0005, -100.0), ("madis", "Y", 41.5, -100.0), ("madis", "Z", None, None)]
    index = spark.createDataFrame(rows, "source string, source_station_id string, lat double, lon double").withColumn("elev_m", F.lit(1.0))
    got = {r.source_station_key: (r.canonical_station_id, r.confidence) for r in crosswalk.build_crosswalk(index).collect()}
    assert got == {"ghcnh:A1": ("ghcn:A1", "exact_match"), "ghcnd:A1": ("ghcn:A1", "exact_match"), "madis:X": ("ghcn:A1", "probable_match"), "madis:Y": ("madis:Y", "no_match"), "madis:Z": ("madis:Z", "no_match")}


def test_closest_pairs(spark):
    """Filters on distance, elevation (pairs of unknown elevation go) and days in common, then the closest."""
    walk = spark.createDataFrame(
        [("a:1", 40.0, -100.0, 10.0, "x"), ("b:1", 40.001, -100.0, 20.0, "x"), ("b:2", 40.0004, -100.0, 15.0, "x"), ("b:3", 40.0, -100.0, None, "x"), ("b:4", 40.0, -100.0, 99.0, "x"), ("b:5", 40.0, -100.0, 10.0, "y")],
        "source_station_key string, lat double, lon double, elev_m double, canonical_station_id string",
    )
    spans = spark.sql("SELECT k AS station_key, DATE'2020-01-01' AS por_start, CASE WHEN k = 'b:1' THEN DATE'2020-04-09' ELSE DATE'2021-12-31' END AS por_end FROM VALUES ('a:1'), ('b:1'), ('b:2'), ('b:3'), ('b:4'), ('b:5') t(k)")
    found = lambda **how: [(r.source_station_key_a, r.source_station_key_b, r.overlap_days) for r in crosswalk.candidate_pairs(walk, spans, most_m=500.0, most_elev=50.0, **{"limit": 9, **how}).collect()]
    assert found(least_days=99) == [("a:1", "b:2", 730), ("b:1", "b:2", 99), ("a:1", "b:1", 99)]
    assert found(least_days=365) == [("a:1", "b:2", 730)] and len(found(least_days=1, limit=2)) == 2


def test_medians(spark):
    """Of groups of any size, with equal values, signs, nulls, infinities and not-numbers, as Spark's own; a month's rows never meet in a window."""
    x = F.when(F.col("id") % 13 == 0, None).when(F.col("id") % 5 == 0, 3.0).otherwise(F.hash("id") % 1000 / 7.0)
    y = F.when(F.col("id") % 3 == 0, float("nan")).when(F.col("id") % 3 == 1, float("inf")).otherwise(F.col("id") * -1.0)
    g = F.when(F.col("id") < 1, 0).when(F.col("id") < 3, 1).when(F.col("id") < 6, 2).when(F.col("id") < 1000, 3).when(F.col("id") < 30000, 4)
    df = spark.range(60000).select("id", g.alias("g"), x.alias("x"), y.alias("y"), F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 700).cast("int")).alias("date"))
    want = {(r.g, v): (r[f"n_{v}"], r[f"m_{v}"]) for r in df.groupBy("g").agg(*(f(v).alias(f"{k}_{v}") for v in ("x", "y") for f, k in ((F.count, "n"), (F.median, "m")))).collect() for v in ("x", "y") if r[f"n_{v}"]}
    got = {(r.g, r["__value"]): (r.n, r["median"]) for r in temporal.medians(df, ["g"], ["x", "y"]).collect()}
    assert repr(sorted(got.items(), key=repr)) == repr(sorted(want.items(), key=repr)) and len(got) > 9
    plan = temporal.monthly_zscore(df, "x", keys=["g"])._jdf.queryExecution().optimizedPlan().toString()
    assert not [line for line in plan.splitlines() if "Window [" in line and "median" in line]


def test_ratio_of_a_long_series_in_groups(spark, monkeypatch):
    """Unevenly spaced dates, missing ones and null stations: numbered by blocks and looked at by groups as all at once, and no
    group has a whole series."""
    i = F.col("id")
    day = F.when(i % 97 != 5, F.date_add(F.lit("1990-01-01").cast("date"), (i * i / 700).cast("int") + (i / 2000).cast("int") * 4000))
    df = spark.range(5000).select("id", F.when(i % 3 != 0, i % 3).alias("station_key"), day.alias("date"), F.when(i % 40 != 0, F.hash("id") % 90 + 100.0).otherwise(0.0).alias("rsds"), F.when(i % 41 != 0, 150.0 + i % 7).alias("rso"))
    df = df.where("date is not null or id in (102, 103, 104)").dropDuplicates(["station_key", "date"])
    seen = []
    for block, periods in ((10**9, 10**9), (50, 2), (7, 1)):
        monkeypatch.setattr(temporal, "BLOCK", block, raising=False)
        monkeypatch.setattr(temporal, "PERIODS", periods, raising=False)
        out = temporal.rs_period_ratio(df.repartition(7), key="station_key", change=0.5, most_excess=1e9)
        seen.append(sorted((str(tuple(r)) for r in out.drop("id").collect())))
    assert seen[0] == seen[1] == seen[2] and len({r.split(", ")[-3] for r in seen[0]}) > 20
    groups = [x for x in out._jdf.queryExecution().optimizedPlan().toString().splitlines() if "FlatMapGroupsInPandas" in x]
    assert groups and all("__group" in x for x in groups)


def test_nearest_by_places(spark, monkeypatch):
    """Stations that share a place are not paired with one another, and have the answer of all pairs."""
    made = []

    def counted(*a, **k):
        made.append(near_pairs(*a, **k))
        return made[-1]

    near_pairs = crosswalk.near_pairs
    left = spark.range(300).select(F.col("id").alias("lid"), (40 + F.col("id") % 3 * 0.004).alias("lat"), F.when(F.col("id") % 50 != 7, -100 + F.col("id") % 2 * 0.004).alias("lon"))
    right = spark.range(400).select((1000 - F.col("id")).alias("rid"), (40 + F.col("id") % 2 * 0.005).alias("lat"), F.lit(-100.001).alias("lon"))
    want = sorted(map(tuple, crosswalk.nearest(near_pairs(left, right)).collect()))
    monkeypatch.setattr(crosswalk, "near_pairs", counted)
    assert sorted(map(tuple, crosswalk.nearest_within(left, right).collect())) == want and len(want) == 294
    index = left.select(F.lit("madis").alias("source"), "lid", "lat", "lon").union(right.select(F.lit("ghcnd"), "rid", "lat", "lon")).withColumnRenamed("lid", "source_station_id").withColumn("elev_m", F.lit(1.0))
    assert crosswalk.build_crosswalk(index).where("confidence = 'probable_match'").count() == 294
    assert len(made) == 2 and all(m.count() <= 6 * 2 for m in made)


@pytest.mark.parametrize("limit", [None, 1, 7, 40])
def test_pairs_in_parts(spark, monkeypatch, limit):
    """An id's stations in parts, many of them alike: the pairs of brute force; no pair is joined with a period."""
    monkeypatch.setattr(crosswalk, "PART", 4, raising=False)
    rows = [(f"s:{k}", 40 + k % 3 * 0.001, -100.0, 10.0 * (k % 2) if k % 11 else None, f"c{k % 4}", date(2020, 1, 1 + k % 5), date(2020, 3, 1)) for k in range(90)]
    walk = spark.createDataFrame([r[:5] for r in rows], "source_station_key string, lat double, lon double, elev_m double, canonical_station_id string")
    spans = spark.createDataFrame([(r[0], *r[5:]) for r in rows], "station_key string, por_start date, por_end date")
    out = crosswalk.candidate_pairs(walk, spans, most_m=150.0, most_elev=5.0, least_days=57, limit=limit)
    got = sorted((round(r.distance_m, 6), r.source_station_key_a, r.source_station_key_b, r.elev_diff, r.overlap_days) for r in out.collect())
    want = []
    for a in rows:
        for b in rows:
            if a[0] < b[0] and a[4] == b[4] and None not in (a[3], b[3]) and a[3] == b[3] and abs(a[1] - b[1]) < 0.0012:
                days = (date(2020, 3, 1) - max(a[5], b[5])).days
                if days >= 57:
                    want.append((a[0], b[0], days, abs(a[1] - b[1]) > 1e-9))
    order = sorted((far, a, b, days) for a, b, days, far in want)[:limit]
    assert sorted((a, b, d) for _, a, b, _, d in got) == sorted((a, b, d) for _, a, b, d in order) and len(want) > 100
    first = next(x for x in out._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join " in x)
    assert first.count("canonical_station_id") == 2


def test_fabric_precedence(spark):
    d = [date(2024, 1, k) for k in (1, 2, 3)]
    rows = [("ghcnd", d[0], 25.0, "pass"), ("ghcnd", d[1], 99.0, "fail"), ("ghcnd", d[2], 27.0, "pass"), ("snotel", d[1], 25.5, "pass"), ("snotel", d[0], 1.0, "pass")]
    df = spark.createDataFrame(rows, "source string, date date, tmax double, qc_state string").withColumn("c", F.lit("x"))
    out = fabric.apply_precedence(df, schema.PRECEDENCE["daily"], keys=["c", "date"]).orderBy("date").collect()
    assert [(r.tmax, r.tmax_source) for r in out] == [(25.0, "ghcnd"), (25.5, "snotel"), (27.0, "ghcnd")]


def test_corrections(spark):
    a = daily_series(spark, n=60, v=lambda i, r: 6)
    b = daily_series(spark, n=60, v=lambda i, r: 3)
    assert {r.factor for r in corrections.monthly_factors(a, b, variable="v", keys=["station_key"]).collect()} == {2.0}
    with pytest.raises(ValueError):
        corrections.monthly_factors(a, b, variable="v", keys=["station_key"], method="x")


def test_contracts(spark):
    with pytest.raises(ValueError):
        schema.conform(spark.range(1), schema.DAILY_CORE)


def test_manifest(spark, tmp_path):
    m = manifest.Manifest(spark, str(tmp_path / "m"))
    m.update([("madis", "a", "failed", ""), ("madis", "b", "done", "")])
    m.update([("madis", "a", "done", "")])
    assert m.get_state("madis", "a") == "done"
    keys = spark.createDataFrame([("madis", k) for k in "abc"], "source string, key string")
    assert [r.key for r in manifest.pending(keys, m.log()).collect()] == ["c"]
    m.compact()
    assert m.log().count() == 2
    with pytest.raises(ValueError):
        m.update([("madis", "a", "bad", "")])


def test_release(spark, tmp_path):
    daily_series(spark, n=5, tair=lambda i, r: i).withColumn("qc_state", F.lit("pass")).coalesce(1).write.parquet(str(tmp_path / "por"))
    release.build_release(spark, str(tmp_path / "rel"), "v1", "dev", {"por": str(tmp_path / "por")})
    assert release.validate_release(spark, str(tmp_path / "rel"), "v1") == []
    release.promote_release(spark, str(tmp_path / "rel"), "v1", "stable")
    f = next((tmp_path / "rel/v1/por").rglob("*.parquet"))
    data = f.read_bytes()
    f.unlink()
    f.write_bytes(data[:-1] + bytes([data[-1] ^ 1]))
    assert release.validate_release(spark, str(tmp_path / "rel"), "v1")[0].startswith("mismatch")
    with pytest.raises(ValueError):
        release.promote_release(spark, str(tmp_path / "rel"), "v1", "stable")


def test_text_sources(spark, tmp_path):
    line = list(" " * 105)
    for at, s in ((4, "72565003017"), (15, "202401021500"), (28, "+40167-105167"), (46, "+1541"), (60, "1701"), (65, "00521"), (87, "+00311"), (93, "-00581"), (99, "831501")):
        line[at : at + len(s)] = s
    (tmp_path / "isd").write_text("".join(line) + "\nshort\n")
    r = readers.read_isd(spark, str(tmp_path / "isd")).first()
    assert (r.lat, r.lon, r.elev_m, r.wind_dir, r.wind, r.tair, r.td) == (40.167, -105.167, 1541, 170, 5.2, 3.1, -5.8) and r.station_key == "isd:725650-03017"
    files = [("x/41001h1998.txt.gz", "#YY MM DD hh mm WDIR ATMP PRES\n#yr mo dy hr mn deg degC hPa\n98 01 02 03 04 180 MM 1010.0\n2024 01 02 03 04 999 5.5 1011\nbad line\n2024 13 01 00 00 1 1 1"),
             ("x/41001_latest.txt", "2024 01 02 03 04 90 5.0 99.0 1.0 MM MM MM 1012.0 7.5 MM 3.0 MM MM\n"), ("x/b1.txt", "YYYY MM DD hh WD BAR\n1999 05 06 07 270 1000.5\n")]
    got = readers.normalize_ndbc(readers.parse_stdmet(spark.createDataFrame(files, "path string, text string"))).orderBy("source_station_id", "datetime_utc").collect()
    assert [(r.source_station_id, r.datetime_utc.year, r.wind_dir, r.tair, r.slp) for r in got] == [("41001", 1998, 180, None, 101000), ("41001", 2024, None, 5.5, 101100), ("B1", 1999, 270, None, 100050)]
    (tmp_path / "41002.txt").write_text(files[0][1])
    assert readers.read_ndbc_text(spark, str(tmp_path / "41002.txt")).count() == 2
    (tmp_path / "US1.csv").write_text('STATION,DATE,LATITUDE,LONGITUDE,ELEVATION,TMAX,TMAX_ATTRIBUTES\nUS1,2024-01-01,40,-100,5,250,",,S"\nUS1,2024-01-02,40,-100,5,900,",X,S"\n')
    a, b = readers.read_ghcnd(spark, str(tmp_path / "US1.csv")).orderBy("date").collect()
    assert (a.tmax, a.qc_state, b.tmax, b.qc_state, b.qc_reason_codes) == (25.0, "pass", 90.0, "fail", "tmax:qflag_X")
    page = spark.createDataFrame([("ABC", "<pre>\n01/02/2024 2024 2 1 1.5 2 180 5 10 15 5 50 90 20 -9999\n01/02/2024 x\n</pre>"), ("BAD", "Improper program call")], "source_station_id string, html string")
    rows = readers.normalize_raws(readers.parse_raws_html(page)).collect()
    assert len(rows) == 1 and rows[0].tmax == 15 and rows[0].prcp is None and rows[0].rsds == 1.5


def classic(dims, variables, records=None):
    """A classic netCDF file: dims {name: size or None}, variables {name: (dims, kind, array)}."""
    import struct

    pad = lambda b: b + b"\0" * (-len(b) % 4)
    name = lambda s: struct.pack(">i", len(s)) + pad(s.encode())
    kinds = {"S1": 2, ">i4": 4, ">f4": 5, ">f8": 6}
    index = list(dims)
    head = b"CDF\x01" + struct.pack(">i", records or 0) + struct.pack(">ii", 10, len(dims)) + b"".join(name(d) + struct.pack(">i", n or 0) for d, n in dims.items()) + struct.pack(">ii", 0, 0)

    def listing(begins):
        out = struct.pack(">ii", 11, len(variables))
        for (v, (on, kind, x)), begin in zip(variables.items(), begins):
            fill = struct.pack(">ii", 12, 1) + name("_FillValue") + struct.pack(">ii", 6, 1) + struct.pack(">d", -9999.0) if kind == ">f8" else struct.pack(">ii", 0, 0)
            size = len(pad(x[:1].tobytes())) if dims[on[0]] is None else len(pad(x.tobytes()))
            out += name(v) + struct.pack(">i", len(on)) + b"".join(struct.pack(">i", index.index(d)) for d in on) + fill + struct.pack(">iIi", kinds[kind], size, begin)
        return out

    arrays = {v: np.array(x, kind) for v, (_, kind, x) in variables.items()}
    variables = {v: (on, kind, arrays[v]) for v, (on, kind, _) in variables.items()}
    at = len(head) + len(listing([0] * len(variables)))
    begins, body = [], b""
    fixed = [v for v, (on, *_) in variables.items() if dims[on[0]] is not None]
    moving = [v for v in variables if v not in fixed]
    place = {}
    for v in fixed:
        place[v] = at + len(body)
        body += pad(arrays[v].tobytes())
    for k in range(records or 0):
        for v in moving:
            place.setdefault(v, at + len(body))
            body += pad(arrays[v][k : k + 1].tobytes()) if len(moving) > 1 else arrays[v][k : k + 1].tobytes()
    begins = [place[v] for v in variables]
    return head + listing(begins) + body


def madis_file(n=3):
    text = lambda *s: [list(x.ljust(6, "\0").encode()[i : i + 1] for i in range(6)) for x in s]
    one = lambda *s: [x.encode() for x in s]
    return classic({"recNum": None, "len": 6}, {
        "stationId": (("recNum", "len"), "S1", text("A1", "B2 ", "")), "latitude": (("recNum",), ">f4", [40.0, 50.0, 41.0]), "longitude": (("recNum",), ">f4", [-100.0, -90.0, -99.0]),
        "elevation": (("recNum",), ">f4", [10, 20, 30]), "observationTime": (("recNum",), ">f8", [1704067200.0, 1704070800.0, 1704067200.0]), "temperature": (("recNum",), ">f8", [280.0, -9999.0, 300.0]),
        "temperatureDD": (("recNum",), "S1", one("V", "Q", "S")), "temperatureQCR": (("recNum",), ">i4", [0, 2, 0]), "windSpeed": (("recNum",), ">f4", [5.0, 6.0, 50.0]), "windSpeedDD": (("recNum",), "S1", one("V", "V", "V")),
    }, records=n)


def test_madis_files(spark, tmp_path):
    """Hourly files decoded without a library: absent variables, fill values, texts; the half-open box; a broken file is reported."""
    import gzip

    (tmp_path / "20240101_0000.gz").write_bytes(gzip.compress(madis_file()))
    (tmp_path / "20240101_0100.gz").write_bytes(b"broken")
    scanned = readers.scan_madis(spark, str(tmp_path))
    raw = {r.stationId: r for r in scanned.where("error is null").collect()}
    assert set(raw) == {"A1", "B2", ""} and raw["B2"].temperature is None and raw["A1"].dewpoint is None and raw["A1"].dataProvider == "" and raw["A1"].temperatureDD == "V"
    rows = {r.source_station_id: r for r in readers.read_madis(spark, str(tmp_path)).collect()}
    assert rows["A1"].tair == pytest.approx(6.85) and rows["A1"].wind == 5 and rows["A1"].datetime_utc.year == 2024 and rows["B2"].tair is None and "" not in rows
    assert [r.source_station_id for r in readers.read_madis(spark, str(tmp_path), bounds=(-100, 40, -90, 50)).collect()] == ["A1"]
    bad = readers.decode_failures(scanned, "madis").collect()
    assert [(r.source, r.phase, r.error_type, r.input_file.endswith("0100.gz")) for r in bad] == [("madis", "decode", "ValueError", True)]


def test_netcdf_layouts():
    from skyledger.sources import netcdf

    x = np.arange(6.0).reshape(2, 3)
    got = netcdf.variables(classic({"t": None, "k": 3}, {"x": (("t", "k"), ">f8", x), "fixed": (("k",), ">i4", [7, 8, 9])}, records=2))
    assert (got["x"] == x).all() and got["fixed"].tolist() == [7, 8, 9]
    alone = netcdf.variables(classic({"t": None}, {"c": (("t",), "S1", [b"a", b"b", b"c"])}, records=3))
    assert alone["c"].tolist() == [b"a", b"b", b"c"]
    with pytest.raises(ValueError):
        netcdf.variables(b"\x89HDF")


def test_gdas_archive(spark, tmp_path):
    """Flat and nested members through a decoder that is given; broken archives are reported."""
    import io
    import tarfile

    def tar(path, members):
        with tarfile.open(path, "w") as t:
            for n, data in members:
                info = tarfile.TarInfo(n)
                info.size = len(data)
                t.addfile(info, io.BytesIO(data))

    inner = tmp_path / "inner.tar"
    tar(inner, [("x.t00z", b"BUFRin")])
    (tmp_path / "in").mkdir()
    tar(tmp_path / "in/20240101.tar", [("gdas.t06z.prepbufr", b"BUFR06"), ("prepbufr.gdas.2024010112.nr", b"BUFR12"), ("prepbufr.gdas.2024010118.wo40", inner.read_bytes())])
    (tmp_path / "in/20240102.tar").write_bytes(b"no archive")

    def decode(data, hour):
        return [{"station_id": f"s{hour}", "latitude": 1.0, "longitude": 350.0, "msg_type": "ADPSFC", "datetime_utc": datetime(2024, 1, 1, hour), "temperature": 5.0, "pressure": 1e11}]

    fields = "station_id string, latitude double, longitude double, msg_type string, datetime_utc timestamp, temperature double, pressure double"
    rows = readers.read_gdas_archive(spark, str(tmp_path / "in"), decode, fields).collect()
    assert sorted(r.station_key for r in rows) == ["gdas_adpsfc:s12", "gdas_adpsfc:s18", "gdas_adpsfc:s6"] and {(r.lon, r.tair, r.psfc) for r in rows} == {(-10.0, 5.0, None)}
    assert readers.decode_failures(readers.scan_gdas_archive(spark, str(tmp_path / "in"), decode, fields), "gdas").count() == 1


def test_unreadable_parquet_is_reported(spark, tmp_path):
    spark.range(3).coalesce(1).write.parquet(str(tmp_path / "a"))
    (tmp_path / "a/zz.parquet").write_bytes(b"nothing")
    good, bad = readers.readable_parquet(spark, str(tmp_path / "a"), "x")
    assert len(good) == 1 and spark.read.parquet(*good).count() == 3
    assert [(r.source, r.phase, r.input_file.endswith("zz.parquet")) for r in bad.collect()] == [("x", "read", True)]


def test_delimited_sources(spark, tmp_path):
    (tmp_path / "GH1.psv").write_text("Station_ID|Year|Month|Day|Hour|Minute|Latitude|Longitude|Elevation|temperature|temperature_Quality_Code|sea_level_pressure|sea_level_pressure_Quality_Code\nGH1|2024|1|2|3|4|40|-100|5|7.5|1|1010|3\nGH1|2024|x|2|3|4|40|-100|5|7.5|1|1010|1\n")
    r = readers.read_ghcnh(spark, str(tmp_path / "GH1.psv")).collect()
    assert [(x.tair, x.slp, x.slp_qc_state, x.qc_state, x.qc_reason_codes) for x in r] == [(7.5, None, "fail", "fail", "slp:qc_3")]
    (tmp_path / "US2.csv").write_text('STATION,DATE,TMAX,TMAX_ATTRIBUTES\nUS2,2024-01-01,250,",G,S"\nUS2,2024-01-02,250,",K,S"\nUS2,bad,1,\n')
    assert [(x.tmax, x.qc_state) for x in readers.read_ghcnd(spark, str(tmp_path / "US2.csv")).orderBy("date").collect()] == [(25.0, "pass"), (25.0, "fail")]
    (tmp_path / "100_Bear_Mountain_ID.csv").write_text("date,swe,prec,tavg\n2024-01-01,1,10,\n2024-01-02,2,12,3\n2024-01-03,,,\n2024-01-04,2,5,1\n")
    got = readers.read_snotel_daily(spark, str(tmp_path / "100_Bear_Mountain_ID.csv")).orderBy("date").collect()
    assert [(x.source_station_id, x.prcp, x.tmean) for x in got] == [("100", None, None), ("100", 2.0, 3.0), ("100", None, 1.0)]
    head = '"Longitude (x)","Latitude (y)","Climate ID","Date/Time (LST)","Temp (°C)","Temp Flag","Precip. Amount (mm)","Precip. Amount Flag","Wind Spd (km/h)","Wind Spd Flag"'
    (tmp_path / "en_climate_hourly_BC_1011500_2024.csv").write_bytes((head + '\n"-123","49","1011500","2024-01-01 00:00","5.5","","","T","36","E"\n"-123","49","1011500","2024-01-01 01:00","5.5","M","1","","36",""\n').encode("latin-1"))
    a, b = readers.read_eccc(spark, str(tmp_path / "en_climate_hourly_BC_1011500_2024.csv"), province="BC").orderBy("datetime_utc").collect()
    assert (a.source_station_id, a.datetime_utc.hour, a.tair, a.prcp, a.wind, a.wind_qc_state) == ("BC_1011500", 8, 5.5, 0.0, pytest.approx(10.0), "suspect") and b.tair is None and b.qc_state == "fail"


def test_registry(tmp_path):
    assert len(registry.list_sources()) == 9
    with pytest.raises(KeyError):
        registry.get_source("nope")
    assert registry.discover_keys("madis", ".", date(2024, 1, 1), date(2024, 1, 3)) == ["20240101", "20240102", "20240103"]
    (tmp_path / "b.csv").write_text("")
    assert registry.discover_keys("ghcnd", str(tmp_path)) == ["b"]
    assert acquire.year_chunks(2000, 2011) == [(2000, 2004), (2005, 2009), (2010, 2011)]


def test_stream_equals_batch(spark, tmp_path):
    df = hours(spark, range(72)).withColumnRenamed("tair", "value")
    df.repartition(3).write.parquet(str(tmp_path / "in"))
    run_available(spark, str(tmp_path / "in"), df.schema, daily_stream, "stream_days", str(tmp_path / "cp"), mode="complete")
    got = {(r.date, r.tmax, r.obs_count, r.coverage_flags) for r in spark.table("stream_days").collect()}
    want = {(r.date, r.tmax, r.obs_count, r.coverage_flags) for r in daily.aggregate_daily_wide(hours(spark, range(72)), source="madis").collect()}
    assert got == want
