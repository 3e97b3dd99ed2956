"""Commands, update, downloads and reports, end to end on small files."""

import gzip
import json
import io
import urllib.error
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from skyledger import cli, schema
from skyledger.operators import crosswalk, daily, manifest, por, update, validation
from skyledger.sources import acquire, readers, registry
from skyledger.streaming.daily import daily_stream, run_available
from tests.test_engine import madis_file


def ghcnh(path, station, hours, value=5.0, day="2"):
    head = "Station_ID|Year|Month|Day|Hour|Minute|Latitude|Longitude|Elevation|temperature|temperature_Quality_Code"
    path.write_text("\n".join([head, *(f"{station}|2024|1|{day}|{h}|0|40|-100|5|{value + h}|1" for h in hours)]))


def test_update_runs_again(spark, tmp_path):
    """New files only; a key that is done again replaces its rows; a run that was not committed is not read."""
    raw, out, days, state = (str(tmp_path / n) for n in ("raw", "out", "days", "state"))
    (tmp_path / "raw").mkdir()
    ghcnh(tmp_path / "raw/A.psv", "A", range(6))
    first = update.update(spark, {"ghcnh": raw}, out, state, days_out=days)
    assert (first[0].todo, first[0].failed) == (1, 0)
    assert update.update(spark, {"ghcnh": raw}, out, state, days_out=days)[0].todo == 0
    ghcnh(tmp_path / "raw/B.psv", "B", range(3), value=20.0)
    assert update.update(spark, {"ghcnh": raw}, out, state, days_out=days, dry_run=True)[0].todo == 1
    assert update.update(spark, {"ghcnh": raw}, out, state, days_out=days)[0].todo == 1
    found = {r.station_key: (r.tmax, r.obs_count) for r in spark.read.parquet(days).collect()}
    assert found == {"ghcnh:A": (10.0, 6), "ghcnh:B": (22.0, 3)}
    ghcnh(tmp_path / "raw/A.psv", "A", range(2))
    log = manifest.Manifest(spark, state)
    assert update.normalize_pending(spark, "ghcnh", raw, out, log, again=True).todo == 2
    assert update.committed(spark, out, log.log()).where("station_key = 'ghcnh:A'").count() == 2
    spark.read.parquet(out).limit(1).withColumn("run", F.lit("lost")).write.mode("append").partitionBy("raw_source", "run").parquet(out)
    assert update.committed(spark, out, log.log()).where("station_key = 'ghcnh:A'").count() == 2


def test_update_of_days_with_a_broken_file(spark, tmp_path):
    """A file that cannot be decoded is reported, its key fails and is tried again."""
    raw, out, state = (str(tmp_path / n) for n in ("raw", "out", "state"))
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw/20240101_0000.gz").write_bytes(madis_file())
    (tmp_path / "raw/20240102_0000.gz").write_bytes(b"broken")
    done = update.update(spark, {"madis": raw}, out, state)[0]
    assert (done.todo, done.failed) == (2, 1)
    log = manifest.Manifest(spark, state)
    assert log.get_state("madis", "20240101") == "done" and log.get_state("madis", "20240102") == "failed" and update.latest_day(log.log(), "madis") == date(2024, 1, 1)
    report = spark.read.json(f"{out}_failures").collect()
    assert [(r.source, r.phase, r.error_type) for r in report] == [("madis", "decode", "ValueError")]
    (tmp_path / "raw/20240102_0000.gz").write_bytes(madis_file())
    assert update.update(spark, {"madis": raw}, out, state)[0].todo == 1 and log.get_state("madis", "20240102") == "done"


def test_keys_of_files(spark):
    names = {"madis": ("/a/20240101_0000.gz", "20240101"), "isd": ("/a/2024/72-1-2024.gz", "2024/72-1-2024.gz"), "ndbc": ("/a/41001h1999.txt.gz", "41001"), "snotel": ("/a/100_Bear_ID.csv", "100"),
             "eccc": ("/a/en_climate_hourly_BC_1011500_2024.csv", "BC_1011500"), "ghcnd": ("/a/USC0.csv", "USC0")}
    one = spark.range(1)
    assert {s: one.select(update.key_of(s, F.lit(p))).first()[0] for s, (p, _) in names.items()} == {s: k for s, (_, k) in names.items()}


def test_commands(spark, tmp_path, capsys):
    """Every command once, from raw text to a release."""
    at = lambda n: str(tmp_path / n)
    (tmp_path / "raw").mkdir()
    for s in "AB":
        ghcnh(tmp_path / f"raw/{s}.psv", s, range(24), value=0.0 if s == "A" else 1.0)
    run = lambda *a: cli.main(list(a))
    assert run("sources") == 0 and "madis" in capsys.readouterr().out
    run("normalize", "ghcnh", "--raw", at("raw"), "--out", at("n"), "--manifest", at("m"))
    run("update", "--raw", f"ghcnh={at('raw')}", "--out", at("n"), "--manifest", at("m"), "--daily", at("d0"))
    run("qaqc", "ghcnh", "--rows", at("n"), "--out", at("q"))
    run("build-hourly", "ghcnh", "--rows", at("q"), "--out", at("h"))
    assert spark.read.parquet(at("h")).columns == schema.HOURLY_LONG.names and spark.read.parquet(at("h")).count() == 48
    run("build-daily", "ghcnh", "--rows", at("q"), "--out", at("d"), "--keep-extra")
    assert {(r.station_key, r.tmax) for r in spark.read.parquet(at("d")).collect()} == {("ghcnh:A", 23.0), ("ghcnh:B", 24.0)}
    run("build-station-por", "ghcnh", "--rows", at("q"), "--out", at("p"))
    assert por.load_station_por(spark, at("p"), ["ghcnh:A"]).count() == 1 and por.load_station_por(spark, at("p")).count() == 2
    run("inventory", "--rows", at("p"), "--out", at("i"))
    run("crosswalk-index", "--rows", at("q"), "--out", at("x"))
    run("crosswalk-build", "--index", at("x"), "--out", at("w"))
    assert spark.read.parquet(at("w")).count() == 2
    spark.read.parquet(at("d")).withColumn("source", F.lit("ghcnd")).write.parquet(at("d1"))
    run("build-fabric", "--rows", at("d1"), "--crosswalk", at("w"), "--out", at("f"))
    assert spark.read.parquet(at("f")).count() == 2
    run("precedence-study", "--a", at("d"), "--b", at("d"), "--keys", "station_key,date", "--variables", "tmax,tmin", "--out", at("s"))
    assert {(r.variable, r.n, r.bias) for r in spark.read.parquet(at("s")).collect()} == {("tmax", 2, 0.0), ("tmin", 2, 0.0)}
    run("corrections", "--obs", at("d"), "--baseline", at("d"), "--variable", "tmax", "--out", at("c"))
    for report in ("coverage", "latency", "qc"):
        run("diagnostics", report, "--rows", at("q"), "--by", "source")
    assert "pass_rate" in capsys.readouterr().out
    run("release-build", "--root", at("r"), "--version", "v1", "--channel", "dev", "--products", f"por={at('p')}")
    assert run("release-validate", "--root", at("r"), "--version", "v1") == 0
    run("release-promote", "--root", at("r"), "--version", "v1", "--channel", "stable")
    run("pending", "ghcnh", "--manifest", at("m"), "--root", at("raw"))
    assert run("ingest", "gdas", "--root", at("g"), "--start", "2024-01-01", "--end", "2024-01-02", "--dry-run") == 0 and "20240102" in capsys.readouterr().out
    pairs = spark.createDataFrame([("s1", "ghcnh:A")], "station string, station_key string")
    pairs.write.parquet(at("pairs"))
    spark.read.parquet(at("d")).where("station_key = 'ghcnh:A'").select(F.lit("s1").alias("station"), "date", "tmax").write.parquet(at("theirs"))
    (tmp_path / "log.txt").write_text("Now correcting Tmax and Tmin \n3 outliers were removed on variable TMax\n")
    run("validate", "--pairs", at("pairs"), "--ours", at("p"), "--theirs", at("theirs"), "--logs", at("log.txt"), "--variables", "tmax", "--out", at("v"))
    said = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert (said["status"], said["pairs_compared"], said["total_rows"]) == ("ok", 1, 1)
    assert spark.read.csv(at("v/flag_agreement_by_rule"), header=True).count() > 0 and spark.read.parquet(at("v/log_summary")).first().zscore_tmax == 3


def test_validation_of_nothing(spark, tmp_path):
    none = spark.createDataFrame([], "station string, station_key string")
    ours = spark.createDataFrame([], "station_key string, date date, tmax double, qc_reason_codes string")
    theirs = spark.createDataFrame([], "station string, date date, tmax double")
    assert validation.run_validation(none, ours, theirs, str(tmp_path / "v"), variables=["tmax"]) == {"status": "empty"}


class Answers:
    """An opener that answers from a table and counts."""

    def __init__(self, table, failures=0):
        self.table, self.failures, self.asked = table, failures, []

    def __call__(self, url, timeout=None):
        url = url if isinstance(url, str) else url.full_url
        self.asked.append(url)
        if self.failures:
            self.failures -= 1
            raise OSError("no connection")
        if url not in self.table:
            raise urllib.error.HTTPError(url, 404, "none", {}, None)
        return io.BytesIO(self.table[url])


def test_downloads(tmp_path):
    """Retries, absent files, the second form of an archive, files that are there already."""
    a, b = acquire.gdas_jobs(date(2024, 1, 1), date(2024, 1, 2), str(tmp_path))
    answers = Answers({a.urls[1]: b"x"}, failures=1)
    done = registry.get_source("gdas").fetch_raw([a, b], threads=1, opener=answers, pause=lambda s: None)
    assert [(k, s) for k, s, _ in done] == [("20240101", "done"), ("20240102", "missing")] and (tmp_path / "2024/prepbufr.20240101.tar.gz").read_bytes() == b"x"
    n = len(answers.asked)
    assert acquire.run_jobs([a], opener=answers)[0][1] == "done" and len(answers.asked) == n
    assert acquire.run_jobs([b], threads=1, tries=2, opener=Answers({}, failures=9), pause=lambda s: None)[0][1] == "failed"


def test_addresses():
    jobs = acquire.madis_jobs(date(2024, 1, 1), date(2024, 1, 2), "/r")
    assert len(jobs) == 48 and jobs[0].urls[0].endswith("/archive/2024/01/01/LDAD/mesonet/netCDF/20240101_0000.gz") and jobs[0].to == "/r/2024/20240101_0000.gz"
    assert acquire.basic_auth(jobs[0].urls[0], "u", "p").get_header("Authorization") == "Basic dTpw"
    assert acquire.isd_keys("<Key>data/2024/1-2-2024.gz</Key><IsTruncated>true</IsTruncated>") == (["data/2024/1-2-2024.gz"], True) and acquire.isd_jobs(["data/2024/1-2-2024.gz"], "/r")[0].to == "/r/2024/1-2-2024.gz"
    assert "start-after=k" in acquire.isd_listing(2024, "k")
    assert acquire.ghcnh_files('<a href="A1.psv">x</a><a href="B.csv">') == ["A1.psv"] and acquire.ghcnh_jobs(["A1.psv"], "/r")[0].key == "A1"
    table = "# ID | OWNER | TTYPE | HULL | NAME | PAYLOAD | LOCATION | TZ\n41001|N|b|h|EAST|p|34.700 N 72.700 W (34 42'0\" N)|E\n13001|N|b|h|S|p|12.0 S 23.0 E|E\nbad|line\nxx|a|b|c|d|e|nowhere|f"
    assert [(s["source_station_id"], s["lat"], s["lon"]) for s in acquire.ndbc_stations(table)] == [("41001", 34.7, -72.7), ("13001", -12.0, 23.0), ("XX", None, None)]
    lat, lon = acquire.ndbc_location("42 30'36\" S 70 15'0\" W")
    assert (round(lat, 6), round(lon, 6)) == (-42.51, -70.25) and acquire.ndbc_location("42 30'36\" S") == (None, None)
    assert [j.key for j in acquire.ndbc_jobs(["41001"], (2020, 2021), "/r")] == ["41001/2020", "41001/2021", "41001/latest"]
    assert acquire.raws_stations("rawMAIN.pl?idIABC rawMAIN.pl?idIABD rawMAIN.pl?idIABC") == ["idIABC", "idIABD"]
    posts = acquire.raws_jobs("idIABC", date(2010, 5, 1), date(2020, 2, 1), "/r")
    assert [j.key for j in posts] == ["idIABC/20100501", "idIABC/20160101"] and b"stn=iabc" in posts[0].urls[0].data and b"eyea=15" in posts[0].urls[0].data
    chunks = acquire.snotel_jobs("100:ID:SNTL", date(2000, 2, 29), date(2012, 1, 1), "/r")
    assert [j.key.split("/")[1] for j in chunks] == ["20000229", "20050228", "20100228"] and "stationTriplets=100%3AID%3ASNTL" in chunks[0].urls[0] and "networkCds=SNTL" in acquire.snotel_inventory()
    answer = [{"stationTriplet": "100:ID:SNTL", "data": [{"stationElement": {"elementCode": "TOBS"}, "values": [{"date": "2024-01-01 00:00", "value": 20.0}, {"date": "x"}]}]}]
    assert acquire.snotel_rows(json.dumps(answer)) == [{"triplet": "100:ID:SNTL", "datetime_local": "2024-01-01 00:00", "element": "TOBS", "value": 20.0}, {"triplet": "100:ID:SNTL", "datetime_local": "x", "element": "TOBS", "value": None}]


def test_contract_tables(spark):
    assert schema.STATION.names[8:10] == ["network", "provider"] and "raw_file_hash" in schema.HOURLY_LONG.names and not schema.HOURLY_LONG["unit"].nullable and schema.HOURLY_LONG["value"].nullable
    assert {"soil_temp_5cm", "wave_height", "rsds_corrected"} <= set(schema.DAILY_METRICS) and schema.PRECEDENCE["daily"]["rh"] == ["raws_wrcc", "snotel"]
    with pytest.raises(ValueError):
        schema.conform_hourly(spark.range(1))
    with pytest.raises(ValueError):
        schema.conform_daily(spark.range(1))


def test_even_sample():
    assert crosswalk.sampled(list("gfedcba"), 3) == ["a", "d", "g"] and crosswalk.sampled(["b", "a"], 5) == ["a", "b"] and crosswalk.sampled(list("abc"), 1) == ["a"]


def test_equal_times_give_one_sum(spark):
    """Accumulated precipitation at equal times does not depend on the order of the rows."""
    t = datetime(2024, 1, 1)
    rows = [("s", t, 1.0), ("s", t, 4.0), ("s", t, 2.0), ("s", t + timedelta(hours=1), 5.0)]
    found = {daily.aggregate_daily_wide(spark.createDataFrame(r, "station_key string, datetime_utc timestamp, prcp double").repartition(k), source="madis").first().prcp for k, r in ((1, rows), (3, rows[::-1]), (2, [rows[2], rows[0], rows[3], rows[1]]))}
    assert found == {4.0}


def test_late_rows_in_append_mode(spark, tmp_path):
    """Closed days come out once, and rows later than the watermark change nothing."""
    at = lambda d, h: datetime(2024, 1, d, h)
    kind = "station_key string, datetime_utc timestamp, value double"
    put = lambda rows, name: spark.createDataFrame(rows, kind).coalesce(1).write.parquet(str(tmp_path / "in" / name))
    sink, cp = str(tmp_path / "out"), str(tmp_path / "cp")
    read = lambda: {(r.date.day, r.tmax, r.obs_count) for r in spark.read.parquet(sink).collect()}
    put([("s", at(1, h), float(h)) for h in range(24)] + [("s", at(9, 0), 1.0)], "a")
    schema_ = spark.createDataFrame([], kind).schema
    go = lambda: run_available(spark, str(tmp_path / "in/*"), schema_, lambda df: daily_stream(df), sink, cp)
    go()
    put([("s", at(1, 5), 99.0), ("s", at(9, 1), 2.0)], "b")
    go()
    assert read() == {(1, 23.0, 24)}


def test_update_counts_rows_by_their_file(spark, tmp_path):
    """Rows whose station is not the file's name: year and name of a record file, a name with more than the station."""
    line = "0000" + "010010" + "99999" + "202401020600" + "4" + "+40167" + "-105167" + "FM-15" + "+1541" + " " * 9 + "170" + "1" + "N" + "0052" + "1" + " " * 17 + "+0031" + "1" + "-0058" + "1" + "10010" + "1"
    (tmp_path / "isd/2024").mkdir(parents=True)
    (tmp_path / "isd/2024/010010-99999-2024.gz").write_bytes(gzip.compress(line.encode()))
    (tmp_path / "isd/2024/010020-99999-2024.gz").write_bytes(gzip.compress(line.encode())[:-9])  # cut short
    (tmp_path / "ghcnh").mkdir()
    ghcnh(tmp_path / "ghcnh/GHCNh_USW00024153_por.psv", "USW00024153", range(3))
    for source, failed in (("isd", 1), ("ghcnh", 0)):
        out, state = str(tmp_path / f"{source}-out"), manifest.Manifest(spark, str(tmp_path / f"{source}-state"))
        done = update.normalize_pending(spark, source, str(tmp_path / source), out, state)
        rows = update.committed(spark, out, state.log())
        assert (done.failed, rows.count(), rows.select("raw_source_uri").distinct().count()) == (failed, {"isd": 1, "ghcnh": 3}[source], 1)
    report = spark.read.json(str(tmp_path / "isd-out_failures")).collect()
    assert [(r.phase, r.input_file.rsplit("/", 1)[1]) for r in report] == [("decode", "010020-99999-2024.gz")]


def test_update_keeps_evening_rows(spark, tmp_path):
    """Rows of 21:30 stand in the next day's file and count with it; an unreadable Parquet file is reported."""
    raw, out, days = (str(tmp_path / n) for n in ("raw", "out", "days"))
    kind = "station_id string, latitude double, longitude double, elevation double, msg_type string, datetime_utc timestamp, cycle int, pressure double, temperature double, u_wind double, v_wind double"

    def put(day, *times):
        rows = [("72", 40.0, -100.0, 5.0, "ADPSFC", t, 0, 900.0, 5.0 + t.hour, 1.0, 1.0) for t in times]
        spark.createDataFrame(rows, kind).toPandas().to_parquet(str(tmp_path / "raw" / f"{day}.parquet"), coerce_timestamps="us")

    (tmp_path / "raw").mkdir()
    put("20240102", datetime(2024, 1, 1, 21, 30), datetime(2024, 1, 2, 3))
    state = str(tmp_path / "state")
    update.update(spark, {"gdas": raw}, out, state, days_out=days)
    put("20240103", datetime(2024, 1, 2, 21, 30), datetime(2024, 1, 3, 3))
    (tmp_path / "raw/20240104.parquet").write_bytes(b"PAR1 no footer")
    done = update.update(spark, {"gdas": raw}, out, state, days_out=days)[0]
    assert (done.todo, done.failed) == (2, 1)
    log = manifest.Manifest(spark, state)
    assert update.committed(spark, out, log.log()).count() == 4
    assert {(r.date.day, r.obs_count) for r in spark.read.parquet(days).collect()} == {(1, 1), (2, 2), (3, 1)}
    assert log.get_state("gdas", "20240104") == "failed" and spark.read.json(f"{out}_failures").count() == 1


def test_update_tries_failed_days_again(spark, tmp_path):
    """A day that failed below the high-water mark, once it is repaired; a day whose file changed; some files at a time."""
    raw, out, state = tmp_path / "raw", str(tmp_path / "out"), str(tmp_path / "state")
    raw.mkdir()
    (raw / "20240101_0000.gz").write_bytes(b"broken")
    for d in (2, 3):
        (raw / f"2024010{d}_0000.gz").write_bytes(madis_file())
    go = lambda **how: update.update(spark, {"madis": str(raw)}, out, state, **how)[0]
    assert (lambda d: (d.todo, d.failed))(go()) == (3, 1)
    assert (lambda d: (d.todo, d.failed))(go()) == (1, 1)  # still broken, and still tried
    (raw / "20240101_0000.gz").write_bytes(madis_file())
    assert (lambda d: (d.todo, d.failed))(go()) == (1, 0)
    log = manifest.Manifest(spark, state)
    before = update.committed(spark, out, log.log()).count()
    assert before == 3 * update.committed(spark, out, log.log()).where("raw_key = '20240101'").count() > 0
    assert go().todo == 0
    (raw / "20240102_0100.gz").write_bytes(madis_file())  # one more hour of a day below the mark
    assert go().todo == 1 and update.committed(spark, out, log.log()).count() == before * 4 // 3
    done = update.normalize_pending(spark, "madis", str(raw), out, log, again=True, files_at_once=1)
    assert (done.todo, done.failed) == (3, 0) and update.committed(spark, out, log.log()).count() == before * 4 // 3
    runs = manifest.latest(log.log()).select("run_id").distinct().count()
    assert runs > 1  # each part was committed by itself
    (raw / "20240103_0000.gz").write_bytes(b"broken later")
    assert go().failed == 1 and update.committed(spark, out, log.log()).count() == before * 4 // 3  # what was had stays


def test_days_that_lose_their_rows(spark, tmp_path):
    """A day is removed when the file that had it is replaced by one without it."""
    raw, out, days, state = (str(tmp_path / n) for n in ("raw", "out", "days", "state"))
    (tmp_path / "raw").mkdir()
    ghcnh(tmp_path / "raw/A.psv", "A", range(3), day="2")
    update.update(spark, {"ghcnh": raw}, out, state, days_out=days)
    ghcnh(tmp_path / "raw/A.psv", "A", range(4), day="5")
    update.update(spark, {"ghcnh": raw}, out, state, days_out=days)
    assert {(r.date.day, r.obs_count) for r in spark.read.parquet(days).collect()} == {(5, 4)}


def test_files_are_decoded_once(spark, tmp_path, monkeypatch):
    """Good rows and failures come from one pass."""
    count = spark.sparkContext.accumulator(0)
    decode = readers.decode_madis

    def counting(path, content):
        count.add(1)
        return decode(path, content)

    monkeypatch.setattr(readers, "decode_madis", counting)
    (tmp_path / "raw").mkdir()
    for k in range(4):
        (tmp_path / f"raw/20240101_0{k}00.gz").write_bytes(madis_file() if k else b"broken")
    log = manifest.Manifest(spark, str(tmp_path / "state"))
    assert update.normalize_pending(spark, "madis", str(tmp_path / "raw"), str(tmp_path / "out"), log).failed == 1
    assert count.value == 4


RAWS_PAGE = "<PRE>\n" + "\n".join(f" 01/{d:02d}/2024  2024  {d}  {d}  2.5  3.0  180  9.0  {d}.5  9.0  -1.0  50  80  20  1.5" for d in (1, 2, 3)) + "\n</PRE>"


def test_downloads_become_rows(spark, tmp_path, capsys):
    """ingest lists the stations itself, and normalize reads what it had; the manifest has downloads and keys; asked again, nothing is."""
    at = lambda n: str(tmp_path / n)
    raws = Answers({f"{acquire.RAWS_URL}/wraws/ncalst.html": b"<a href='rawMAIN.pl?caCABC'>x</a>", acquire.RAWS_DATA_URL: RAWS_PAGE.encode()})
    ask = ["ingest", "raws", "--root", at("raws"), "--regions", "nca", "--start", "2024-01-01", "--end", "2024-01-03", "--manifest", at("m")]
    assert cli.main(ask, raws) == 0
    cli.main(["normalize", "raws", "--raw", at("raws"), "--out", at("r"), "--manifest", at("m")])
    log = manifest.Manifest(spark, at("m"))
    rows = update.committed(spark, at("r"), log.log()).orderBy("date").collect()
    assert [(r.station_key, r.date.day, r.tmean, r.prcp) for r in rows] == [("raws_wrcc:caCABC", d, d + 0.5, 1.5) for d in (1, 2, 3)]
    assert log.get_state("raws_files", "caCABC/20240101") == "done" and log.get_state("raws", "caCABC") == "done"
    n = len(raws.asked)
    cli.main(ask, raws)
    assert len(raws.asked) == n + 1  # the list alone

    inventory = [{"stationTriplet": "100:ID:SNTL", "networkCode": "SNTL", "latitude": 44.0, "longitude": -115.0, "elevation": 1000.0, "dataTimeZone": -8.0}, {"stationTriplet": "7:ID:COOP", "networkCode": "COOP"}]
    series = lambda code, unit, *v: {"stationElement": {"elementCode": code, "storedUnitCode": unit}, "values": [{"date": f"2024-01-01 0{h}:00", "value": x} for h, x in enumerate(v)]}
    answer = [{"stationTriplet": "100:ID:SNTL", "data": [series("TOBS", "degF", 32.0, 50.0, None), series("WTEQ", "in", 1.0, 2.0, 3.0)]}]
    job = acquire.snotel_jobs("100:ID:SNTL", date(2024, 1, 1), date(2024, 1, 1), at("snotel"))[0]
    snotel = Answers({acquire.snotel_inventory(): json.dumps(inventory).encode(), job.urls[0]: json.dumps(answer).encode()})
    assert cli.main(["ingest", "snotel", "--root", at("snotel"), "--start", "2024-01-01", "--end", "2024-01-01", "--manifest", at("m")], snotel) == 0
    cli.main(["normalize", "snotel", "--raw", at("snotel"), "--out", at("s"), "--manifest", at("m")])
    rows = update.committed(spark, at("s"), log.log()).orderBy("datetime_utc").collect()
    assert [(r.station_key, r.datetime_utc, r.tair, r.swe) for r in rows] == [("snotel:100", datetime(2024, 1, 1, 8 + h), t, s) for h, t, s in ((0, 0.0, 25.4), (1, 10.0, 50.8), (2, None, 25.4 * 3))]
    assert (rows[0].lat, round(rows[0].elev_m, 2)) == (44.0, 304.8) and log.get_state("snotel", "100") == "done"
    capsys.readouterr()


def test_crawling(tmp_path):
    """Pages after a cursor; a server that asks to wait; a pace for each host."""
    page = lambda keys, more: (f"<IsTruncated>{str(more).lower()}</IsTruncated>" + "".join(f"<Key>{k}</Key>" for k in keys)).encode()
    pages = Answers({acquire.isd_listing(2024): page(["data/2024/a.gz", "data/2024/b.gz"], True), acquire.isd_listing(2024, "data/2024/b.gz"): page(["data/2024/c.gz"], False)})
    assert acquire.isd_archive([2024], pages) == ["data/2024/a.gz", "data/2024/b.gz", "data/2024/c.gz"] and len(pages.asked) == 2
    waits, busy = [], iter([urllib.error.HTTPError("u", 429, "busy", {"Retry-After": "30"}, None)])

    def opener(url, timeout=None):
        for e in busy:
            raise e
        return io.BytesIO(b"x")

    assert acquire.fetch("u", str(tmp_path / "f"), opener=opener, pause=waits.append) and waits == [30.0]
    now, slept = [0.0], []
    paced = acquire.Pace(5.0, lambda url, timeout=None: url, clock=lambda: now[0], pause=slept.append)
    for url in ("https://a/1", "https://a/2", "https://b/1", "https://a/3"):
        paced(url)
    assert slept == [5.0, 10.0]
    table = Answers({acquire.NDBC_TABLE_URL: b"41001|N|b|h|EAST|p|34.7 N 72.7 W|E", f"{acquire.GHCNH_URL}/": b'<a href="A1.psv">'})
    assert acquire.listed_stations("ndbc", table) == ["41001"] and acquire.listed_stations("ghcnh", table) == ["A1.psv"]
    cell = lambda k, v: f"<b>{k} </b></td>\n<td> {v} \n"
    facts = acquire.raws_facts(cell("Location", "Hill, CA") + cell("Latitude", "39° 30' 36\"") + cell("Longitude", "120 15 0") + cell("Elevation", "1000 ft.") + cell("NESS ID", "3248A"))
    assert (facts["location"], round(facts["lat"], 4), facts["lon"], round(facts["elev_m"], 1), facts["ness_id"]) == ("Hill, CA", 39.51, -120.25, 304.8, "3248A")


def test_compaction_loses_nothing(spark, tmp_path, monkeypatch):
    """What counts, what is pending and what failed are the same after it; a key that was done and failed later keeps its rows."""
    raw, out, state = tmp_path / "raw", str(tmp_path / "out"), str(tmp_path / "state")
    raw.mkdir()
    monkeypatch.setattr(update, "LOG_FILES", 3)
    go = lambda: update.update(spark, {"madis": str(raw)}, out, state)[0]
    log, sizes = manifest.Manifest(spark, state), []
    for k, data in enumerate((madis_file(), b"broken", madis_file(), b"broken", b"broken, longer")):
        (raw / "20240101_0000.gz").write_bytes(data)
        (raw / f"2024010{k + 2}_0000.gz").write_bytes(madis_file())
        go()
        sizes.append(len(log.log().inputFiles()))
    assert sizes == [1, 2, 3, 1, 2] and log.get_state("madis", "20240101") == "failed"
    rows = lambda: sorted((r.raw_key, r.run) for r in update.committed(spark, out, log.log()).select("raw_key", "run").collect())
    before, pending = rows(), go().todo
    assert {k for k, _ in before} == {f"2024010{d}" for d in range(1, 7)} and pending == 1  # the broken day, tried again
    assert log.compact() and len(log.log().inputFiles()) == 1 and len(log.files().inputFiles()) == 1
    assert rows() == before and not log.compact()
    assert update.update(spark, {"madis": str(raw)}, out, state, dry_run=True)[0].todo == 1
