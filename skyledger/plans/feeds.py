"""Queries over the readers: native rows and texts are made from ``events`` and read back by each feed's parser.

k is the number in ``props``, t ten times a temperature.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.functions import columns as C
from skyledger.operators import por, rules, temporal
from skyledger.plans.registry import query, r6, read
from skyledger.sources import readers

_B = "b AS (SELECT *, user_id AS u, event_id AS e, value AS v, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, CAST(floor(value * 10) AS BIGINT) % 700 - 300 AS t FROM events)"
_AT = "strftime({0}, '%Y-%m-%d %H:%M')"


def base(spark: SparkSession, d: str) -> DataFrame:
    t = F.floor(F.col("value") * 10).cast("long") % 700 - 300
    return read(spark, d, "events").select(
        F.col("user_id").alias("u"), F.col("event_id").alias("e"), F.col("value").alias("v"), F.get_json_object("props", "$.k").cast("int").alias("k"), t.alias("t"), F.col("ts").cast("timestamp").alias("ts"), F.col("event_type").alias("type")
    )


def at(c: Column | str) -> Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm")


def text(form: str, *cols: Column) -> Column:
    return F.format_string(form, *cols)


def cols() -> tuple[Column, ...]:
    return tuple(F.col(c) for c in "uektv")


@query(f"""WITH {_B}
SELECT lpad(CAST(u AS VARCHAR), 6, '0') || '-' || lpad(CAST(e % 100000 AS VARCHAR), 5, '0') AS station, {_AT.format('ts')} AS at, ((u % 90) * 1000 + e % 1000) / 1000.0 AS lat, CAST(-(u % 180) AS DOUBLE) AS lon,
  CASE WHEN u % 13 <> 0 THEN CAST(u % 3000 AS DOUBLE) END AS elev_m, CASE WHEN e % 17 <> 0 AND e % 6 IN (1, 5) THEN CAST(e % 360 AS DOUBLE) END AS wind_dir, e % 400 / 10.0 AS wind,
  CASE WHEN e % 11 <> 0 AND e % 10 IN (1, 5) THEN t / 10.0 END AS tair, (t - 50) / 10.0 AS td, CAST(NULL AS DOUBLE) AS slp FROM b""")
def isd_records(spark: SparkSession, d: str) -> DataFrame:
    """Fixed-width records: offsets, scales, missing values, quality codes, invalid and short lines."""
    u, e, k, t, v = cols()
    b = base(spark, d)
    line = F.concat(
        F.lit("0000"), text("%06d", u), text("%05d", e % 100000), F.date_format("ts", "yyyyMMddHHmm"), F.lit("4"), text("%+06d", (u % 90) * 1000 + e % 1000), text("%+07d", -(u % 180) * 1000),
        F.lit("FM-15"), text("%+05d", F.when(u % 13 == 0, 9999).otherwise(u % 3000)), F.lit(" " * 9), text("%03d", F.when(e % 17 == 0, 999).otherwise(e % 360)), (e % 6).cast("string"), F.lit("N"),
        text("%04d", e % 400), F.lit("1"), F.lit(" " * 17), text("%+05d", F.when(e % 11 == 0, 9999).otherwise(t)), (e % 10).cast("string"), text("%+05d", t - 50), F.lit("5"), text("%05d", 9500 + e % 1000), F.lit("9"),
    )
    lines = b.select(line.alias("value")).select(F.explode(F.array("value", F.substring("value", 1, 104), F.regexp_replace("value", r"^(.{15}).{12}", "$1202499010000"))).alias("value"))
    out = readers.parse_isd(lines)
    return out.select(F.col("source_station_id").alias("station"), at("datetime_utc").alias("at"), "lat", "lon", "elev_m", "wind_dir", "wind", "tair", "td", "slp")


@query(f"""WITH {_B}, q AS (SELECT *, CAST(k % 10 AS VARCHAR) AS c FROM b)
SELECT 'G' || u AS station, {_AT.format("date_trunc('minute', ts)")} AS at, CASE WHEN c NOT IN ('3', '6', '7') THEN t / 10.0 END AS tair, CASE WHEN c IN ('3', '6', '7') THEN 'fail' ELSE 'pass' END AS tair_qc_state,
  CASE WHEN e % 5 <> 0 THEN CAST((9500 + e % 1000) * 10 AS DOUBLE) END AS slp, CASE WHEN c IN ('3', '6', '7') THEN 'fail' ELSE 'pass' END AS qc_state, CASE WHEN c IN ('3', '6', '7') THEN 'tair:qc_' || c ELSE '' END AS qc_reason_codes FROM q""")
def ghcnh_records(spark: SparkSession, d: str) -> DataFrame:
    """Pipe-separated hourly rows: parts of times, quality codes, pressures, unreadable cells and times."""
    u, e, k, t, v = cols()
    s = lambda c: c.cast("string")
    b = base(spark, d)
    native = dict(
        Station_ID=F.concat(F.lit("G"), s(u)), Year=F.date_format("ts", "yyyy"), Month=F.date_format("ts", "M"), Day=F.date_format("ts", "d"), Hour=F.date_format("ts", "H"), Minute=F.date_format("ts", "m"),
        Latitude=F.lit("40"), Longitude=F.lit("-100"), Elevation=F.lit("5"), temperature=s(t / 10), temperature_Quality_Code=s(k % 10), sea_level_pressure=F.when(e % 5 == 0, "n/a").otherwise(s((9500 + e % 1000) / 10)), sea_level_pressure_Quality_Code=F.lit("1"),
    )
    raw = b.select(*(c.alias(n) for n, c in native.items()))
    out = readers.normalize_ghcnh(raw.union(raw.withColumn("Month", F.lit("13"))))
    return out.select(F.col("source_station_id").alias("station"), at("datetime_utc").alias("at"), "tair", "tair_qc_state", F.round("slp", 3).alias("slp"), "qc_state", "qc_reason_codes")


_FLAGS = "DGIKLMNORSTWXZ "


@query(f"""WITH {_B}, q AS (SELECT *, substr('{_FLAGS}', k % 15 + 1, 1) AS f FROM b)
SELECT 'US' || e AS station, CAST(ts AS DATE) AS date, t / 10.0 AS tmax, CAST(k AS DOUBLE) AS snow, CASE WHEN f IN ('D', 'I', 'K', 'L', 'N', 'O', 'R', 'S', 'T', 'W', 'X') THEN 'fail' ELSE 'pass' END AS qc_state,
  CASE WHEN f IN ('D', 'I', 'K', 'L', 'N', 'O', 'R', 'S', 'T', 'W', 'X') THEN 'tmax:qflag_' || f ELSE '' END AS qc_reason_codes, 'local' AS day_basis FROM q""")
def ghcnd_records(spark: SparkSession, d: str) -> DataFrame:
    """Daily rows with attributes: scales, the quality flag, values that stay."""
    u, e, k, t, v = cols()
    flag = F.substring(F.lit(_FLAGS), k % 15 + 1, F.lit(1))
    raw = base(spark, d).select(
        F.concat(F.lit("US"), e.cast("string")).alias("STATION"), F.date_format("ts", "yyyy-MM-dd").alias("DATE"), text("%5d", t).alias("TMAX"), F.concat(F.lit(","), flag, F.lit(",S")).alias("TMAX_ATTRIBUTES"), k.cast("string").alias("SNOW"), F.lit(",,7").alias("SNOW_ATTRIBUTES")
    )
    out = readers.normalize_ghcnd(raw.union(raw.withColumn("DATE", F.lit("no date"))))
    return out.select(F.col("source_station_id").alias("station"), "date", F.round("tmax", 6).alias("tmax"), "snow", "qc_state", "qc_reason_codes", "day_basis")


@query(f"""WITH {_B}, f AS (SELECT *, row_number() OVER (PARTITION BY u, date_trunc('minute', ts) ORDER BY ts, e) AS n FROM b)
SELECT 'ST' || u AS station, {_AT.format("date_trunc('minute', ts)")} AS at, CASE WHEN e % 7 <> 0 AND e % 360 <> 99 THEN CAST(e % 360 AS DOUBLE) END AS wind_dir, CASE WHEN e % 9 <> 0 THEN t / 10.0 END AS tair, CASE WHEN e % 1000 <> 490 THEN CAST((9500 + e % 1000) * 10 AS DOUBLE) END AS slp FROM f WHERE n = 1""")
def ndbc_texts(spark: SparkSession, d: str) -> DataFrame:
    """Whole files of a station: heading and units lines, missing values, two-digit years in every third file, the first row
    of a time, which history has before the latest file."""
    u, e, k, t, v = cols()
    b = base(spark, d)
    year = F.when(u % 3 == 0, F.date_format("ts", "yy")).otherwise(F.date_format("ts", "yyyy"))
    line = F.concat_ws(" ", year, F.date_format("ts", "MM dd HH mm"), F.when(e % 7 == 0, "MM").otherwise((e % 360).cast("string")), F.when(e % 9 == 0, "999.0").otherwise((t / 10).cast("string")), ((9500 + e % 1000) / 10).cast("string"))
    rows = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ts", "e", line.alias("line")))), lambda x: x["line"]), "\n")
    whole = b.groupBy("u").agg(rows.alias("rows"))
    head = F.lit("#YY  MM DD hh mm WDIR ATMP PRES\n#yr  mo dy hr mn degT degC hPa\n")
    history = whole.select(F.concat(F.lit("d/st"), u.cast("string"), F.lit("h2024.txt.gz")).alias("path"), F.concat(head, "rows").alias("text"))
    latest = whole.select(F.concat(F.lit("d/st"), u.cast("string"), F.lit("_latest.txt")).alias("path"), F.concat(head, F.regexp_replace("rows", r" [0-9.]+(\n|$)", " 900.0$1")).alias("text"))
    out = readers.normalize_ndbc(readers.parse_stdmet(history.union(latest)))
    return out.select(F.col("source_station_id").alias("station"), at("datetime_utc").alias("at"), "wind_dir", "tair", F.round("slp", 3).alias("slp"))


@query(f"""WITH {_B}, f AS (SELECT u, CAST(ts AS DATE) AS date, count(*) AS n, CAST(floor(max(v)) AS BIGINT) AS hi, CAST(floor(min(v)) AS BIGINT) AS lo FROM b GROUP BY ALL)
SELECT 'raws_wrcc:R' || u AS station_key, date, CAST(hi AS DOUBLE) AS tmax, CAST(lo AS DOUBLE) AS tmin, CASE WHEN n % 3 <> 0 AND n % 5 <> 0 THEN CAST(n AS DOUBLE) END AS prcp, round(n / 10.0 * 3.6, 6) AS rsds, 1 AS obs_count, 'n=1,thresh=Y,am=N,pm=N' AS coverage_flags FROM f""")
def raws_pages(spark: SparkSession, d: str) -> DataFrame:
    """Daily tables within pages: missing values, short lines, repeated dates, answers that are errors; then the daily contract."""
    u, e, k, t, v = cols()
    day = base(spark, d).groupBy("u", F.to_date("ts").alias("date")).agg(F.count(F.lit(1)).alias("n"), F.floor(F.max("v")).cast("long").alias("hi"), F.floor(F.min("v")).cast("long").alias("lo"))
    n, hi, lo = F.col("n"), F.col("hi"), F.col("lo")
    s = lambda c: c.cast("string")
    first = F.concat_ws(" ", F.date_format("date", "MM/dd/yyyy"), F.lit("2024"), s(F.dayofyear("date")), F.lit("1"), s(n / 10), F.lit("2.5 180 6.1"), s((hi + lo) / 2), s(hi), s(lo))
    line = F.when(n % 5 == 0, first).otherwise(F.concat_ws(" ", first, F.lit("50 90 20"), F.when(n % 3 == 0, "-9999").otherwise(s(n))))
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("date", line.alias("line")))), lambda x: F.concat(x["line"], F.lit("\r\n"), F.substring_index(x["line"], " ", 1), F.lit(" again"))), "\n")
    pages = day.groupBy("u").agg(body.alias("body")).select(F.concat(F.lit("R"), s(u)).alias("source_station_id"), F.concat(F.lit("<html><pre>\n"), "body", F.lit("\n</pre>")).alias("html"))
    pages = pages.union(pages.select("source_station_id", F.lit("Improper program call 01/02/2024 1")))
    out = por.daily_passthrough(readers.normalize_raws(readers.parse_raws_html(pages)))
    return out.select("station_key", "date", "tmax", "tmin", "prcp", r6("rsds").alias("rsds"), "obs_count", "coverage_flags")


@query(f"""WITH {_B}, f AS (SELECT u, CAST(ts AS DATE) AS date, count(*) AS n, sum(k) AS p FROM b GROUP BY ALL), g AS (SELECT * FROM f WHERE n % 7 <> 6),
s AS (SELECT *, p - lag(p) OVER (PARTITION BY u ORDER BY date) AS step FROM g)
SELECT CAST(u AS VARCHAR) AS station, date, CASE WHEN n % 4 <> 0 THEN CAST(n AS DOUBLE) END AS swe, CASE WHEN step >= 0 THEN CAST(step AS DOUBLE) END AS prcp FROM s""")
def snotel_daily(spark: SparkSession, d: str) -> DataFrame:
    """Legacy daily rows: the station's number in the file name, rows without any measure, cumulative precipitation."""
    u, e, k, t, v = cols()
    f = base(spark, d).groupBy("u", F.to_date("ts").alias("date")).agg(F.count(F.lit(1)).alias("n"), F.sum("k").alias("p"))
    n = F.col("n")
    keep = n % 7 != 6
    raw = f.select(F.date_format("date", "yyyy-MM-dd").alias("date"), F.when(keep & (n % 4 != 0), n.cast("string")).alias("swe"), F.when(keep, F.col("p").cast("string")).alias("prec"), F.concat(F.lit("/raw/"), u.cast("string"), F.lit("_Some_Place_ID.csv")).alias("__file"))
    return readers.normalize_snotel_daily(raw).select(F.col("source_station_id").alias("station"), "date", "swe", "prcp")


@query(f"""WITH {_B}, s AS (SELECT *, k - lag(k) OVER (PARTITION BY u ORDER BY ts) AS step FROM b)
SELECT CAST(u AS VARCHAR) AS station, {_AT.format('ts + INTERVAL 8 HOUR')} AS at, t / 10.0 AS tair, CASE WHEN step >= 0 THEN CAST(step AS DOUBLE) END AS prcp, round(CAST((u % 90) * 100 AS DOUBLE) * 0.3048, 6) AS elev_m, e FROM s""")
def snotel_hourly(spark: SparkSession, d: str) -> DataFrame:
    """Hourly rows in local time of a fixed offset: triplets, feet, cumulative precipitation."""
    u, e, k, t, v = cols()
    raw = base(spark, d).select(F.concat(u.cast("string"), F.lit(":ID:SNTL")).alias("triplet"), F.col("ts").alias("datetime"), (t / 10).alias("TOBS"), k.cast("double").alias("PREC"), ((u % 90) * 100).cast("double").alias("elev_ft"), F.lit(-8).alias("tz_offset"), e.cast("double").alias("SNWD"))
    out = readers.normalize_snotel_hourly(raw, F.lit("file"))
    return out.select(F.col("source_station_id").alias("station"), at("datetime_utc").alias("at"), "tair", "prcp", r6("elev_m").alias("elev_m"), F.col("snow_depth").cast("long").alias("e"))


_PROVINCES = ("NL", "NS", "QC", "ON", "MB", "SK", "AB", "BC", "YT", "NU")
_MINUTES = "CASE p WHEN 'NL' THEN -210 WHEN 'NS' THEN -240 WHEN 'QC' THEN -300 WHEN 'ON' THEN CASE WHEN lon < -85 THEN -360 ELSE -300 END WHEN 'MB' THEN -360 WHEN 'SK' THEN -360 WHEN 'AB' THEN -420 WHEN 'BC' THEN -480 WHEN 'YT' THEN -420 WHEN 'NU' THEN CASE WHEN lon < -102 THEN -420 WHEN lon < -85 THEN -360 ELSE -300 END END"


@query(f"""WITH {_B}, p AS (SELECT *, CAST(-(60 + u % 60) AS DOUBLE) AS lon, {list(_PROVINCES)!r}[u % 10 + 1] AS p, ['', 'M', 'E', 'T', 'x'][k % 5 + 1] AS f FROM b),
o AS (SELECT *, date_trunc('minute', ts) - to_minutes(CAST({_MINUTES} AS INTEGER)) AS utc FROM p),
n AS (SELECT *, row_number() OVER (PARTITION BY u, utc ORDER BY e) AS n FROM o)
SELECT p || '_' || u AS station, {_AT.format('utc')} AS at, CASE WHEN f <> 'M' THEN t / 10.0 END AS tair, CASE f WHEN 'M' THEN 'fail' WHEN 'E' THEN 'suspect' WHEN 'x' THEN 'suspect' ELSE 'pass' END AS tair_qc_state,
  CASE WHEN f = 'T' THEN 0.0 WHEN f <> 'M' THEN CAST(k AS DOUBLE) END AS prcp, round(u % 50 / 3.6, 6) AS wind, CASE WHEN f IN ('M', 'E', 'x') THEN 'tair:' || f || ',prcp:' || f ELSE '' END AS qc_reason_codes FROM n WHERE n = 1""")
def eccc_hourly(spark: SparkSession, d: str) -> DataFrame:
    """Hourly rows in standard time of a province: offsets by province and longitude, flags, trace precipitation, units, the
    first file's row of a time."""
    u, e, k, t, v = cols()
    prov = F.element_at(F.array(*map(F.lit, _PROVINCES)), (u % 10 + 1).cast("int"))
    flag = F.element_at(F.array(*map(F.lit, ["", "M", "E", "T", "x"])), (k % 5 + 1).cast("int"))
    s = lambda c: c.cast("string")
    raw = base(spark, d).select(
        s(-(60 + u % 60)).alias("Longitude (x)"), F.lit("49").alias("Latitude (y)"), s(u).alias("Climate ID"), F.date_format("ts", "yyyy-MM-dd HH:mm").alias("Date/Time (LST)"), s(t / 10).alias("Temp (\u00b0C)"), flag.alias("Temp Flag"),
        s(k).alias("Precip. Amount (mm)"), flag.alias("Precip. Amount Flag"), s(u % 50).alias("Wind Spd (km/h)"), F.lit("").alias("Wind Spd Flag"), F.concat(F.lit("/d/en_climate_hourly_"), prov, F.lit("_"), s(u), F.lit("_"), text("%012d", e), F.lit(".csv")).alias("__file"),
    )
    out = readers.normalize_eccc(raw)
    return out.select(F.col("source_station_id").alias("station"), at("datetime_utc").alias("at"), "tair", "tair_qc_state", "prcp", r6("wind").alias("wind"), "qc_reason_codes")


@query(f"""WITH {_B}, g AS (SELECT *, CASE WHEN e % 2 = 0 THEN 'gdas_adpsfc' ELSE 'gdas_sfcshp' END AS s, CASE WHEN (u * 3) % 360 > 180 THEN (u * 3) % 360 - 360 ELSE (u * 3) % 360 END AS lon, 95000.0 + e % 1000 AS p, 0.002 + k / 10000.0 AS q, (k - 50) / 5.0 AS uw, (k % 7 - 3) / 1.0 AS vw FROM b),
x AS (SELECT *, q * (p / 1000) / (0.622 + 0.378 * q) AS ea FROM g), y AS (SELECT *, ln(ea / 0.6108) AS l FROM x)
SELECT s || ':' || u AS station_key, e, CAST(lon AS DOUBLE) AS lon, CASE WHEN e % 10 <> 0 THEN t / 10.0 END AS tair, round(237.3 * l / (17.27 - l), 6) AS td, round(sqrt(uw * uw + vw * vw), 6) AS wind, round(((degrees(atan2(-uw, -vw)) % 360) + 360) % 360, 5) AS wind_dir, k % 8 AS temperature_qm FROM y""")
def gdas_observations(spark: SparkSession, d: str) -> DataFrame:
    """Decoded rows: sources by message type, longitudes, huge values as missing, markers carried; dew point and wind derived."""
    u, e, k, t, v = cols()
    raw = base(spark, d).select(
        F.concat(F.lit(" "), u.cast("string"), F.lit(" ")).alias("station_id"), ((u * 3) % 360).alias("longitude"), F.lit(40.0).alias("latitude"), F.when(e % 2 == 0, "ADPSFC").otherwise("SFCSHP").alias("msg_type"), F.col("ts").alias("datetime"), e.alias("cycle"),
        F.when(e % 10 == 0, 1e11).otherwise(t / 10).alias("temperature"), (95000.0 + e % 1000).alias("pressure"), (0.002 + k / 10000).alias("specific_humidity"), ((k - 50) / 5).alias("u_wind"), ((k % 7 - 3) / 1.0).alias("v_wind"), (k % 8).alias("temperature_qm"),
    )
    out = temporal.prepare_gdas(readers.normalize_gdas(raw))
    return out.select("station_key", F.col("cycle").alias("e"), "lon", "tair", r6("td").alias("td"), r6("wind").alias("wind"), F.round("wind_dir", 5).alias("wind_dir"), "temperature_qm")


@query(f"""WITH {_B}, m AS (SELECT *, CASE WHEN k % 4 <> 0 AND e % 9 <> 0 AND 250 + k BETWEEN 223.15 AND 333.15 THEN CAST(250 + k AS DOUBLE) - CAST(273.15 AS DOUBLE) END AS tair, CASE WHEN v / 10 BETWEEN 0 AND 35 THEN v / 10 END AS wind FROM b WHERE u % 90 >= 20 AND u % 90 < 60 AND k - 100 >= -90 AND k - 100 < -20)
SELECT 'madis:M' || u AS station_key, e, round(tair, 6) AS tair, wind, tair IS NOT NULL OR wind IS NOT NULL AS qc_passed, CASE WHEN k % 4 = 0 THEN 'X' ELSE 'S' END AS "temperatureDD" FROM m""")
def madis_observations(spark: SparkSession, d: str) -> DataFrame:
    """Native rows: the half-open box, descriptor, check bits and bounds of the extract, canonical columns, rows without station or time."""
    u, e, k, t, v = cols()
    raw = base(spark, d).select(
        F.concat(F.lit("M"), u.cast("string"), F.lit(" ")).alias("stationId"), F.lit("x").alias("dataProvider"), (u % 90).cast("double").alias("latitude"), (k - 100).cast("double").alias("longitude"), e.cast("double").alias("elevation"), F.unix_timestamp("ts").cast("double").alias("observationTime"),
        (250.0 + k).alias("temperature"), F.when(k % 4 == 0, "X").otherwise("S").alias("temperatureDD"), F.when(e % 9 == 0, 2.0).otherwise(4.0).alias("temperatureQCR"), (v / 10).alias("windSpeed"), F.lit(None).cast("string").alias("error"),
    )
    rows = raw.union(raw.withColumn("stationId", F.lit(" "))).union(raw.withColumn("observationTime", F.lit(None).cast("double"))).union(raw.withColumn("error", F.lit("ValueError: x")))
    out = readers.extract_madis(rows, bounds=(-90, 20, -20, 60))
    return out.select("station_key", F.col("elev_m").cast("long").alias("e"), r6("tair").alias("tair"), "wind", "qc_passed", "temperatureDD")


@query("""SELECT 'madis:' || user_id AS station_key, max(ts) AS last, arg_max(value, (ts, value)) AS lat FROM events GROUP BY user_id""")
def station_metadata(spark: SparkSession, d: str) -> DataFrame:
    """One row for each station: its latest place."""
    u, e, k, t, v = cols()
    rows = base(spark, d).select(F.concat(F.lit("madis:"), u.cast("string")).alias("station_key"), F.col("ts").alias("datetime_utc"), F.lit("madis").alias("source"), v.alias("lat"))
    last = rows.groupBy("station_key").agg(F.max("datetime_utc").cast("timestamp_ntz").alias("last"))
    return readers.station_metadata(rows).select("station_key", "lat").join(last, "station_key")


@query("""SELECT event_id, CASE WHEN user_id % 3 = 0 THEN 'madis' ELSE 'ndbc' END AS source, 'decode' AS phase, 'f' || event_id AS input_file, 'ValueError' AS error_type, 'bad ' || event_id AS error FROM events WHERE user_id % 5 = 0 AND user_id % 3 = 0""")
def decode_failures(spark: SparkSession, d: str) -> DataFrame:
    """The failure report of decoded files."""
    u, e, k, t, v = cols()
    rows = base(spark, d).select(e.alias("event_id"), F.concat(F.lit("f"), e.cast("string")).alias("path"), F.when((u % 5 == 0) & (u % 3 == 0), F.concat(F.lit("ValueError: bad "), e.cast("string"))).alias("error"))
    return readers.decode_failures(rows, "madis").withColumn("event_id", F.substring("input_file", 2, 20).cast("long"))


@query("""WITH x AS (SELECT event_id AS e, user_id % 60 AS m, user_id % 90 AS g FROM events)
SELECT e, CASE WHEN e % 2 = 0 THEN 1 ELSE -1 END * (g + m / 60.0 + (e % 60) / 3600.0) AS degrees, 'ST' || e AS stem, CASE WHEN e % 3 = 0 THEN CAST(e AS VARCHAR) ELSE 'place_' || e END AS snotel FROM x""")
def names_and_places(spark: SparkSession, d: str) -> DataFrame:
    """Degrees, minutes and seconds; stations in file names."""
    u, e, k, t, v = cols()
    m, g = u % 60, u % 90
    place = F.concat(g.cast("string"), F.lit("\u00b0 "), m.cast("string"), F.lit("' "), (e % 60).cast("string"), F.lit('" '), F.when(e % 2 == 0, "N").otherwise("S"))
    file = F.concat(F.lit("/a/b.d/ST"), e.cast("string"), F.lit(".csv.gz"))
    site = F.when(e % 3 == 0, F.concat(e.cast("string"), F.lit("_Bear_Creek_ID.csv"))).otherwise(F.concat(F.lit("place_"), e.cast("string"), F.lit(".csv")))
    return base(spark, d).select("e", C.parse_dms(place).alias("degrees"), readers.stem(file).alias("stem"), readers.snotel_station(site).alias("snotel"))


@query("""WITH x AS (SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events), b AS (SELECT *, ['master', 'validity', 'reserved', 'internal_consistency', 'temporal_consistency', 'statistical_spatial', 'spatial_buddy'] AS n FROM x)
SELECT event_id, array_to_string([n[i] FOR i IN range(1, 8) IF (k & 115 & (1 << (i - 1))) <> 0], ',') AS strict, array_to_string([n[i] FOR i IN range(1, 8) IF (k & 2 & (1 << (i - 1))) <> 0], ',') AS permissive,
  CASE WHEN (k & 2) <> 0 THEN 'fail' ELSE 'pass' END AS tair_qc_state FROM b""")
def quality_profiles(spark: SparkSession, d: str) -> DataFrame:
    """The check bits that fail under each profile, by name, and the pipeline of the permissive one."""
    u, e, k, t, v = cols()
    rows = base(spark, d).select(e.alias("event_id"), k, F.lit(1.0).alias("tair"), k.alias("temperatureQCR"), F.lit("V").alias("temperatureDD"))
    out = rules.apply_pipeline(rows, rules.default_pipeline("madis", qcr_mask=rules.QCR_PROFILES["permissive"]), ["tair"])
    return out.select("event_id", rules.qcr_detail(k).alias("strict"), rules.qcr_detail(k, rules.QCR_PROFILES["permissive"]).alias("permissive"), "tair_qc_state")
