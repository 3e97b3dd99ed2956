"""Archives as data sources: which files are opened, which rows leave the decoder, and what is reported."""

import gzip
import io
import tarfile
from datetime import datetime

import numpy as np
import pytest

from skyledger.sources import archives, readers
from tests.test_engine import classic

FIELDS = "station_id string, latitude double, longitude double, elevation double, msg_type string, datetime_utc timestamp, cycle int, temperature double"


def hour(times, lats, lons):
    n = len(times)
    text = [list(f"S{k}".ljust(6, "\0").encode()[i : i + 1] for i in range(6)) for k in range(n)]
    return gzip.compress(classic({"recNum": None, "len": 6}, {
        "stationId": (("recNum", "len"), "S1", text), "latitude": (("recNum",), ">f4", lats), "longitude": (("recNum",), ">f4", lons), "elevation": (("recNum",), ">f4", [1] * n),
        "observationTime": (("recNum",), ">f8", times), "temperature": (("recNum",), ">f8", [280.0 + k for k in range(n)]),
    }, records=n))


@pytest.fixture(scope="module")
def archive(tmp_path_factory):
    """Two days of hours; hours 20 to 23 of the second cannot be decoded."""
    root = tmp_path_factory.mktemp("madis")
    for d in (1, 2):
        (root / f"2024010{d}").mkdir()
        for h in range(24):
            at = datetime(2024, 1, d, h).timestamp()
            broken = d == 2 and h >= 20
            data = b"broken" if broken else hour([at, at + 600, at + 1200], [40.0, 45.0, np.nan if h == 3 else 50.0], [-100.0, -95.0, -90.0])
            (root / f"2024010{d}/2024010{d}_{h:02d}00.gz").write_bytes(data)
    (root / "notes.txt").write_text("no archive")
    return str(root)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_files_outside_are_not_opened(spark, archive):
    scan = lambda **how: archives.scan_archive(spark, "madis_archive", archive, partitionBytes="1", **how)
    everything = scan()
    assert everything.rdd.getNumPartitions() == 48 and everything.count() == 44 * 3 + 4
    assert sorted(r.path[-7:-5] for r in everything.where("error is not null").select("path").collect()) == ["20", "21", "22", "23"]
    part = scan(start=datetime(2024, 1, 1, 22), end=datetime(2024, 1, 2, 1))
    assert part.rdd.getNumPartitions() == 4  # one file each; the rest is not even planned
    assert part.where("error is not null").count() == 0 and {r.file_key for r in part.collect()} == {"20240101_2200", "20240101_2300", "20240102_0000", "20240102_0100"}
    assert "Filter (" not in plan(part)  # nothing is left for Spark to filter
    bundled = archives.scan_archive(spark, "madis_archive", archive)
    assert bundled.rdd.getNumPartitions() == 1 and bundled.count() == everything.count()


def test_rows_outside_do_not_leave_the_decoder(spark, archive):
    box = (-101.0, 40.0, -90.0, 50.0)
    got = archives.scan_archive(spark, "madis_archive", archive, bounds=box, end=datetime(2024, 1, 1, 23))
    assert {(r.latitude, r.longitude) for r in got.collect()} == {(40.0, -100.0), (45.0, -95.0)} and got.count() == 48
    assert "Filter (" not in plan(got)
    seen = []
    readers.madis_columns("x.gz", hour([0.0, 1.0], [40.0, 60.0], [0.0, 0.0]), lambda v, n: seen.append(sorted(v)) or v["latitude"] > 50)
    table = readers.madis_columns("x.gz", hour([0.0, 1.0], [40.0, 60.0], [0.0, 0.0]), lambda v, n: v["latitude"] > 50)
    assert "latitude" in seen[0] and table["stationId"].to_pylist() == ["S1"]


def test_the_same_rows_as_filters_after_the_scan(spark, archive):
    """Comparisons of every kind, missing numbers, and filters that only Spark can do."""
    base = readers.scan_madis(spark, f"{archive}/*/*.gz")
    both = ["stationId", "latitude", "observationTime"]
    for condition in (
        "latitude > 45", "latitude >= 45 and longitude < -90", "latitude <= 45 or longitude = -90", "latitude = 45.0", "latitude is null", "latitude is not null", "stationId = 'S1'", "error is null and temperature > 280",
        f"observationTime >= {datetime(2024, 1, 2, 5).timestamp()} and latitude in (40.0, 50.0)", "not (latitude > 45)",
    ):
        got = archives.register(spark).read.format("madis_archive").load(archive).where(condition).select(both).collect()
        assert sorted(map(str, got)) == sorted(map(str, base.where(condition).select(both).collect())), condition


def test_canonical_rows(spark, archive):
    how = {"bounds": (-101.0, 40.0, -90.0, 50.0), "start": datetime(2024, 1, 1), "end": datetime(2024, 1, 1, 23)}
    got = archives.read_madis_archive(spark, archive, **how)
    want = readers.read_madis(spark, f"{archive}/20240101/*.gz", bounds=how["bounds"])
    cols = ["source_station_id", "datetime_utc", "lat", "lon", "tair", "qc_passed"]
    assert sorted(got.select(cols).collect()) == sorted(want.select(cols).collect()) and got.count() == 48


def decode(data, cycle):
    return [{"station_id": s, "latitude": float(s), "longitude": 250.0, "elevation": 1.0, "msg_type": "ADPSFC", "datetime_utc": datetime(2024, 1, 2, cycle), "cycle": cycle, "temperature": 1.5} for s in data.decode().split()]


def test_day_archives(spark, tmp_path):
    for d in (1, 2, 3):
        with tarfile.open(tmp_path / f"prepbufr.2024010{d}.tar.gz", "w:gz") as tar:
            for h in (0, 6):
                data = b"40 50 60"
                info = tarfile.TarInfo(f"gdas.t{h:02d}z.prepbufr.nr")
                info.size = len(data)
                tar.addfile(info, io.BytesIO(data))
    (tmp_path / "prepbufr.20240104.tar.gz").write_bytes(b"broken")
    how = {"decoder": "tests.test_archives:decode", "fields": FIELDS}
    scan = lambda **more: archives.scan_archive(spark, "gdas_archive", str(tmp_path), partitionBytes="1", **how, **more)
    assert scan().rdd.getNumPartitions() == 4 and scan().where("error is not null").count() == 1
    part = scan(start=datetime(2024, 1, 2), end=datetime(2024, 1, 3), bounds=(0.0, 45.0, 360.0, 60.0))
    assert part.rdd.getNumPartitions() == 2 and [(r.station_id, r.cycle) for r in part.orderBy("file_key", "cycle").collect()] == [("50", 0), ("50", 6)] * 2
    rows = archives.read_gdas_archives(spark, str(tmp_path), **how, end=datetime(2024, 1, 1)).collect()
    assert {(r.source, r.source_station_id, r.lon) for r in rows} == {("gdas_adpsfc", s, -110.0) for s in ("40", "50", "60")}
