"""One reader for each feed.  Text is read as text and cast with try_cast, so unreadable cells become null."""

from __future__ import annotations

import gzip
import io
import re
import tarfile
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from skyledger import schema
from skyledger.functions import columns as C
from skyledger.functions import units
from skyledger.operators.temporal import keep_first
from skyledger.sources import netcdf


Paths = str | list[str]  # what every reader takes: a path or a list of them
RAW = "raw_source_uri"  # the column that names a row's raw file, in every reader's rows


def of_file(df: DataFrame) -> DataFrame:
    """Rows just read, with their file's name as __file."""
    return df.withColumn("__file", F.col("_metadata.file_path"))


def _raw(df: DataFrame) -> dict[str, Column]:
    return {RAW: F.col("__file")} if "__file" in df.columns else {}


def _parquet(spark: SparkSession, path: Paths) -> DataFrame:
    return spark.read.parquet(*([path] if isinstance(path, str) else path))


def provenance(df: DataFrame, source: str, run_id: str | None = None) -> DataFrame:
    have = set(df.columns)
    new = {"source": F.lit(source), "transform_version": F.lit(schema.VERSION), "qc_rules_version": F.lit(schema.VERSION), "ingest_run_id": F.lit(run_id).cast("string")}
    df = df.withColumns({k: v for k, v in new.items() if k not in have or k != "source"})
    if "station_key" not in have:
        df = df.withColumn("station_key", F.concat_ws(":", "source", "source_station_id"))
    return df.withColumns({k: F.lit(v) for k, v in {"qc_state": "pass", "qc_reason_codes": ""}.items() if k not in have})


def stem(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]+?)(?:\.(?:parquet|csv|psv|txt|html|gz|dat|nc))*$", 1)


def _ts(*parts: Column) -> Column:
    y, m, d, h, mi = (F.lpad(p, 4 if k == 0 else 2, "0") for k, p in enumerate(parts))
    return F.try_to_timestamp(F.concat_ws("", y, m, d, h, mi), F.lit("yyyyMMddHHmm"))


# -- ISD ---------------------------------------------------------------------------------------------------------
def read_isd(spark: SparkSession, path: Paths, *, apply_qc: bool = True, run_id: str | None = None) -> DataFrame:
    """Fixed-width records (plain or gz) of 105 characters at least."""
    return parse_isd(of_file(spark.read.text(path)), apply_qc=apply_qc, run_id=run_id)


def parse_isd(lines: DataFrame, *, apply_qc: bool = True, run_id: str | None = None) -> DataFrame:
    """The same from rows (value)."""
    at = lambda a, b: F.substring("value", a + 1, b - a)

    def number(a: int, b: int, scale: float, missing: str) -> Column:
        return F.when(at(a, b) != missing, at(a, b).try_cast("double") / scale)

    df = lines.where(F.length("value") >= 105).select(
        F.concat_ws("-", at(4, 10), at(10, 15)).alias("source_station_id"), _ts(at(15, 19), at(19, 21), at(21, 23), at(23, 25), at(25, 27)).alias("datetime_utc"),
        number(28, 34, 1000, "+99999").alias("lat"), number(34, 41, 1000, "+999999").alias("lon"), number(46, 51, 1, "+9999").alias("elev_m"),
        number(60, 63, 1, "999").alias("wind_dir"), at(63, 64).alias("wind_dir_qc"), number(65, 69, 10, "9999").alias("wind"), at(69, 70).alias("wind_qc"),
        number(87, 92, 10, "+9999").alias("tair"), at(92, 93).alias("tair_qc"), number(93, 98, 10, "+9999").alias("td"), at(98, 99).alias("td_qc"),
        (number(99, 104, 10, "99999") * 100).alias("slp"), at(104, 105).alias("slp_qc"), *(c.alias(k) for k, c in _raw(lines).items()),
    ).where("datetime_utc is not null")
    if apply_qc:
        from skyledger.operators.rules import isd_mask

        df = isd_mask(df, ["wind_dir", "wind", "tair", "td", "slp"])
    return provenance(df, "isd", run_id)


# -- GHCNh -------------------------------------------------------------------------------------------------------
# Native names of the variables.
GHCNH = {
    "temperature": "tair", "dew_point_temperature": "td", "wind_speed": "wind", "wind_direction": "wind_dir", "wind_gust": "wind_gust", "sea_level_pressure": "slp",
    "station_level_pressure": "psfc", "precipitation": "prcp", "relative_humidity": "rh", "wet_bulb_temperature": "tw",
}
GHCNH_BAD = ("3", "6", "7")


def read_ghcnh(spark: SparkSession, path: Paths, run_id: str | None = None) -> DataFrame:
    """Pipe-separated station files; values of codes 3, 6, 7 are nulled and fail; pressures from hPa to Pa."""
    raw = spark.read.csv(path, sep="|", header=True)
    return normalize_ghcnh(of_file(raw), run_id)


def normalize_ghcnh(raw: DataFrame, run_id: str | None = None) -> DataFrame:
    """The same from rows of text columns (any case; of about 190 those are read that are named), with __file where no
    column names the station."""
    col = {c.lower(): F.col(f"`{c}`") for c in raw.columns}
    text = lambda n: F.trim(col[n]) if n in col else F.lit(None).cast("string")
    station = next((text(n) for n in ("station_id", "station") if n in col), stem(F.col("__file")) if "__file" in col else F.lit(None))
    out: dict[str, Column] = {
        "source_station_id": station, "datetime_utc": _ts(text("year"), text("month"), text("day"), F.coalesce(text("hour"), F.lit("00")), F.coalesce(text("minute"), F.lit("00"))),
        "lat": C.num(text("latitude")), "lon": C.num(text("longitude")), "elev_m": C.num(text("elevation")), **_raw(raw),
    }
    reasons, failed = [], []
    for native, v in GHCNH.items():
        if native not in col:
            continue
        value = C.num(text(native)) * (100.0 if v in ("slp", "psfc") else 1.0)
        code = text(f"{native}_quality_code")
        bad = F.coalesce(code.isin(*GHCNH_BAD), F.lit(False))
        out |= {v: F.when(~bad, value), f"{v}_qc_state": F.when(bad, "fail").otherwise("pass"), f"{v}_qc_reason_codes": F.when(bad, F.concat(F.lit("qc_"), code)).otherwise("")}
        reasons.append(F.when(bad, F.concat(F.lit(f"{v}:qc_"), code)))
        failed.append(F.when(bad, 2).otherwise(0))
    out["qc_state"] = C.state_of(F.greatest(F.lit(0), F.lit(0), *failed))
    out["qc_reason_codes"] = C.join_reasons(*reasons) if reasons else F.lit("")
    return provenance(raw.select(*(c.alias(k) for k, c in out.items())).where("datetime_utc is not null"), "ghcnh", run_id)


# -- GHCN-Daily --------------------------------------------------------------------------------------------------
# Native name, variable and scale; quality flags of bad values.
GHCND = {"TMAX": ("tmax", 0.1), "TMIN": ("tmin", 0.1), "TAVG": ("tmean", 0.1), "PRCP": ("prcp", 0.1), "SNOW": ("snow", 1.0), "SNWD": ("snow_depth", 1.0), "AWND": ("wind", 0.1), "WESD": ("swe", 0.1)}
GHCND_FLAGS = ("D", "I", "K", "L", "N", "O", "R", "S", "T", "W", "X")


def read_ghcnd(spark: SparkSession, path: Paths, run_id: str | None = None) -> DataFrame:
    """Daily CSV with VALUE and VALUE_ATTRIBUTES columns; the second attribute is the quality flag: the value is
    kept, its own state and the row's fail."""
    return normalize_ghcnd(of_file(spark.read.csv(path, header=True, quote='"', escape='"')), run_id)


def normalize_ghcnd(raw: DataFrame, run_id: str | None = None) -> DataFrame:
    """The same from rows of text columns."""
    has = lambda c: c in raw.columns
    opt = lambda c: C.num(F.col(c)) if has(c) else F.lit(None).cast("double")
    out: dict[str, Column] = {
        "source_station_id": F.trim("STATION"), "date": F.col("DATE").try_cast("date"), "lat": opt("LATITUDE"), "lon": opt("LONGITUDE"), "elev_m": opt("ELEVATION"),
        "day_basis": F.lit("local"), "obs_count": F.lit(1), **_raw(raw),
    }
    reasons, failed = [], []
    for native, (v, scale) in GHCND.items():
        if not has(native):
            continue
        flag = F.trim(F.get(F.split(F.col(f"{native}_ATTRIBUTES"), ","), F.lit(1))) if has(f"{native}_ATTRIBUTES") else F.lit("")
        bad = F.coalesce(flag.isin(*GHCND_FLAGS), F.lit(False))
        out |= {v: C.num(F.trim(native)) * scale, f"{v}_qc_state": F.when(bad, "fail").otherwise("pass")}
        reasons.append(F.when(bad, F.concat(F.lit(f"{v}:qflag_"), flag)))
        failed.append(F.when(bad, 2).otherwise(0))
    out |= {"qc_state": C.state_of(F.greatest(F.lit(0), F.lit(0), *failed)), "qc_reason_codes": C.join_reasons(*reasons) if reasons else F.lit("")}
    return provenance(raw.select(*(c.alias(k) for k, c in out.items())).where("date is not null"), "ghcnd", run_id)


# -- NDBC --------------------------------------------------------------------------------------------------------
# Columns of a file without a heading, native names, missing values.
NDBC_COLUMNS = ("YY", "MM", "DD", "hh", "mm", "WDIR", "WSPD", "GST", "WVHT", "DPD", "APD", "MWD", "PRES", "ATMP", "WTMP", "DEWP", "VIS", "TIDE")
NDBC = {
    "WDIR": "wind_dir", "WD": "wind_dir", "WSPD": "wind", "GST": "wind_gust", "WVHT": "wave_height", "DPD": "dominant_wave_period", "APD": "average_wave_period", "MWD": "mean_wave_dir",
    "PRES": "slp", "BAR": "slp", "ATMP": "tair", "WTMP": "water_temp", "DEWP": "td", "VIS": "vis", "TIDE": "tide",
}
NDBC_MISSING = ("MM", "99.0", "99.00", "999", "999.0", "9999", "9999.0", "99")
NDBC_VARS = tuple(dict.fromkeys(NDBC.values()))


def parse_stdmet(files: DataFrame) -> DataFrame:
    """Rows (path, text) of standard meteorological files to (path, datetime_utc, variables): the file's heading, with or
    without a sign before it, else the usual columns; a units line; two-digit years; missing minutes.  Column functions only."""
    # Headings, few in a file, are found in the array of lines with what stands where in them; each line then takes the last one
    # above it, so that no line leaves its task.
    lines = F.split("text", r"\r?\n")
    maybe = F.filter(F.transform(lines, lambda x, i: F.named_struct(F.lit("i"), i, F.lit("line"), x)), lambda h: h["line"].rlike(r"(?i)^ *#*YY(YY)?(\s|$)"))
    fields = F.transform(maybe, lambda h: F.named_struct(F.lit("i"), h["i"], F.lit("f"), F.split(F.trim(h["line"]), r"\s+")))
    heads = F.filter(fields, lambda h: F.array_contains(h["f"], "MM"))
    wanted = {n: k for k, n in enumerate((*NDBC_COLUMNS[:5], *NDBC))}
    names = F.array(*map(F.lit, wanted))

    def places_in(h: Column) -> Column:
        heading = F.concat(F.array(F.lit("YY")), F.slice(h["f"], 2, F.size(h["f"])))
        return F.named_struct(F.lit("i"), h["i"], F.lit("places"), F.transform(names, lambda n: F.array_position(heading, n).cast("int")))

    usual = F.array(*(F.lit(NDBC_COLUMNS.index(n) + 1 if n in NDBC_COLUMNS else 0) for n in wanted))
    whole = files.select("path", F.transform(heads, places_in).alias("heads"), lines.alias("lines"))  # once a file, before its lines
    lines = whole.select("path", "heads", F.posexplode("lines").alias("line_no", "line")).withColumn("f", F.split(F.trim("line"), r"\s+"))
    lines = lines.where(F.col("f")[0].rlike(r"^\d{2,4}$"))
    above = F.filter("heads", lambda h: h["i"] < F.col("line_no"))
    lines = lines.withColumn("places", F.when(F.size(above) > 0, F.element_at(above, -1)["places"]).otherwise(usual))

    def field(*names: str) -> Column:
        return F.coalesce(*(F.get("f", F.col("places")[wanted[n]] - 1) for n in names))

    y = field("YY").try_cast("int")
    year = F.when(y > 99, y).when(y >= 70, y + 1900).otherwise(y + 2000)
    part = lambda n: F.coalesce(field(n), F.lit("0")).try_cast("int")
    ts = F.try_make_timestamp(year, field("MM").try_cast("int"), field("DD").try_cast("int"), part("hh"), part("mm"), F.lit(0).cast("decimal(8,6)"), F.lit("UTC"))
    cols = {}
    for v in NDBC_VARS:
        raw = field(*(n for n, to in NDBC.items() if to == v))
        cols[v] = F.when(~raw.isin(*NDBC_MISSING), raw.try_cast("double")) * (100.0 if v == "slp" else 1.0)
    return lines.select("path", "line_no", ts.alias("datetime_utc"), *(c.alias(v) for v, c in cols.items())).where("datetime_utc is not null")


def _decode(spark: SparkSession, path: Paths, decode, fields: str) -> DataFrame:
    """Whole files through a Python decoder (to a table or to rows as dicts), one at a time on executors; rows carry the
    file's path.  A file that
    cannot be decoded gives one row with its error, so that it is reported and the rest goes on."""
    schema_ = T._parse_datatype_string(f"{fields}, path string, error string")
    kinds = to_arrow_schema(schema_)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path_, content in zip(*(batch.column(k).to_pylist() for k in (0, 1))):
                try:
                    out = decode(path_, content)
                    out = out if isinstance(out, pa.Table) else pa.Table.from_pylist(list(out), pa.schema(list(kinds)[:-2]))
                    same = (pa.array([x] * len(out), pa.string()) for x in (path_, None))
                    out = pa.Table.from_arrays([*(out.column(k.name).cast(k.type) for k in list(kinds)[:-2]), *same], schema=kinds)
                except Exception as e:  # noqa: BLE001
                    out = pa.Table.from_pylist([{"path": path_, "error": f"{type(e).__name__}: {e}"}], kinds)
                yield from out.to_batches()

    files = spark.read.format("binaryFile").load(path).select(F.col("_metadata.file_path").alias("path"), "content")
    return files.mapInArrow(run, schema_)


def decode_failures(decoded: DataFrame, source: str) -> DataFrame:
    """The failure report of decoded files: (source, phase, input_file, error_type, error)."""
    kind = F.regexp_extract("error", r"^(\w+): ", 1)
    return decoded.where("error is not null").select(F.lit(source).alias("source"), F.lit("decode").alias("phase"), F.col("path").alias("input_file"), kind.alias("error_type"), F.regexp_replace("error", r"^\w+: ", "").alias("error"))


def unzip(path: str, content: bytes) -> bytes:
    return gzip.decompress(content) if content[:2] == b"\x1f\x8b" else bytes(content)


def scan_text(spark: SparkSession, path: Paths) -> DataFrame:
    """Whole text files, plain or gz, as (text, path, error): a file that cannot be unpacked gives its error."""
    return _decode(spark, path, lambda p, c: [{"text": unzip(p, c).decode("utf-8", "replace")}], "text string")


def isd_of_text(files: DataFrame, run_id: str | None = None) -> DataFrame:
    """Fixed-width records of whole files (text, path)."""
    lines = files.select(F.col("path").alias("__file"), F.explode(F.split("text", r"\r?\n")).alias("value"))
    return parse_isd(lines, run_id=run_id)


def read_ndbc_text(spark: SparkSession, path: Paths, run_id: str | None = None) -> DataFrame:
    """Standard meteorological files (plain or gz); of a station's rows of one time the first file's stays, history before latest."""
    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))
    return normalize_ndbc(parse_stdmet(files), run_id)


def normalize_ndbc(rows: DataFrame, run_id: str | None = None) -> DataFrame:
    """Parsed rows with the station of their path, one of each time."""
    sid = F.upper(F.regexp_extract("path", r"([^/]+?)(?:_latest|h\d{4})?\.txt(?:\.gz)?$", 1))
    df = rows.withColumns({"source_station_id": sid, "__late": F.col("path").contains("_latest")})
    return provenance(keep_first(df, ["source_station_id", "datetime_utc"], ["__late", "path", "line_no"]).drop("__late", "line_no").withColumnRenamed("path", RAW), "ndbc", run_id)


def read_ndbc_parquet(spark: SparkSession, path: Paths, run_id: str | None = None) -> DataFrame:
    """Parsed files: the first column whose name has date or time in it is the time, else the first."""
    df = _parquet(spark, path)
    return normalize_ndbc_parsed(df.select("*", F.col("_metadata.file_path").alias(RAW)), F.upper(stem(F.col(RAW))), run_id)


def normalize_ndbc_parsed(df: DataFrame, station: Column, run_id: str | None = None) -> DataFrame:
    names = {"air_temp": "tair", "dewpoint": "td", "wind_speed": "wind", "pressure": "slp", "visibility": "vis"}
    ts = next((c for c in df.columns if re.search("date|time", c.lower()) and c != RAW), df.columns[0])
    df = df.withColumnRenamed(ts, "datetime_utc").withColumn("source_station_id", station)
    df = df.withColumnsRenamed({k: v for k, v in names.items() if k in df.columns})
    if "slp" in df.columns:
        df = df.withColumn("slp", F.col("slp") * 100.0)
    return provenance(df.withColumn("datetime_utc", F.col("datetime_utc").cast("timestamp")), "ndbc", run_id)


# -- RAWS --------------------------------------------------------------------------------------------------------
# Columns of the daily table, and native names.
RAWS_COLUMNS = (
    "date", "year", "doy", "day_of_run", "srad_total_kwh_m2", "wspd_ave_ms", "wdir_vec_deg", "wspd_gust_ms", "tair_ave_c", "tair_max_c", "tair_min_c",
    "rh_ave_pct", "rh_max_pct", "rh_min_pct", "prcp_total_mm",
)
RAWS = {
    "tair_ave_c": "tmean", "tair_max_c": "tmax", "tair_min_c": "tmin", "wspd_ave_ms": "wind", "wdir_vec_deg": "wind_dir", "wspd_gust_ms": "wind_gust", "rh_ave_pct": "rh", "rh_max_pct": "rh_max",
    "rh_min_pct": "rh_min", "prcp_total_mm": "prcp", "srad_total_kwh_m2": "rsds",
}


def parse_raws_html(pages: DataFrame, *, html: str = "html", keys: tuple[str, ...] = ("source_station_id",)) -> DataFrame:
    """Daily tables within answer pages: lines that begin with a date, short ones filled with missing values.  Error
    pages give no rows; of a date's rows the first stays."""
    good = F.col(html).isNotNull() & ~F.col(html).contains("Improper program call") & ~F.col(html).contains("Access to WRCC")
    lines = pages.where(good).select(*keys, F.posexplode(F.split(html, r"\r?\n")).alias("line_no", "line"))
    f = F.split(F.trim("line"), r"\s+")
    rows = lines.where(F.trim("line").rlike(r"^\d{2}/\d{2}/\d{4}"))
    cols = {"date": F.try_to_timestamp(f[0], F.lit("MM/dd/yyyy")).cast("date")} | {n: C.or_null(F.get(f, F.lit(k)).try_cast("double"), -9999.0) for k, n in enumerate(RAWS_COLUMNS) if k}
    out = rows.select(*keys, "line_no", *(c.alias(n) for n, c in cols.items())).where("date is not null")
    return keep_first(out, [*keys, "date"], ["line_no"]).drop("line_no")


def normalize_raws(df: DataFrame, run_id: str | None = None) -> DataFrame:
    df = df.select(*(c for c in df.columns if c not in RAWS and c not in RAWS_COLUMNS), "date", *(F.col(a).cast("double").alias(b) for a, b in RAWS.items() if a in df.columns))
    return provenance(df.withColumns({"day_basis": F.lit("local"), "obs_count": F.lit(1)}), "raws_wrcc", run_id)


def read_raws_html(spark: SparkSession, path: Paths, run_id: str | None = None) -> DataFrame:
    """Answer pages as they were downloaded, named by station and first day."""
    pages = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias(RAW), F.col("value").alias("html"))
    pages = pages.withColumn("source_station_id", F.regexp_replace(stem(F.col(RAW)), r"_\d{8}$", ""))
    return normalize_raws(parse_raws_html(pages, keys=("source_station_id", RAW)), run_id)


def read_raws(spark: SparkSession, path: Paths, run_id: str | None = None) -> DataFrame:
    """CSV or Parquet of daily measures; the station is the file's name."""
    first = path if isinstance(path, str) else path[0]
    df = _parquet(spark, path) if first.endswith("parquet") else spark.read.csv(path, header=True)
    df = df.select("*", F.col("_metadata.file_path").alias(RAW)).withColumns({"source_station_id": stem(F.col(RAW)), "date": F.col("date").try_cast("date")})
    return normalize_raws(df, run_id)


# -- SNOTEL ------------------------------------------------------------------------------------------------------
# Native names.
SNOTEL_DAILY = {"swe": "swe", "tmin": "tmin", "tmax": "tmax", "tavg": "tmean", "prec": "prcp", "rh": "rh", "ws": "wind"}
SNOTEL_HOURLY = {"WTEQ": "swe", "SNWD": "snow_depth", "PREC": "prcp", "TOBS": "tair"}


def read_snotel_daily(spark: SparkSession, path: Paths, run_id: str | None = None) -> DataFrame:
    """Legacy daily CSV; precipitation is cumulative."""
    return normalize_snotel_daily(of_file(spark.read.csv(path, header=True)), run_id)


def snotel_station(file: Column) -> Column:
    """The leading number of a file name such as 100_Some_Place_ID.csv, else the whole name."""
    return F.coalesce(F.nullif(F.regexp_extract(file, r"([0-9]+)_[^/]*$", 1), F.lit("")), stem(file))


def normalize_snotel_daily(raw: DataFrame, run_id: str | None = None) -> DataFrame:
    """The same from rows of text columns with the file's name as __file; rows without any measure go."""
    from skyledger.operators.temporal import increments

    raw = raw.withColumn("source_station_id", snotel_station(F.regexp_extract("__file", r"([^/]*)$", 1)))
    raw = raw.toDF(*(c.lower() for c in raw.columns))
    met = [c for c in SNOTEL_DAILY if c in raw.columns]
    df = raw.withColumns({c: C.num(c) for c in met}).withColumn("date", F.col("date").try_cast("date")).dropna(how="all", subset=met)
    df = df.select("source_station_id", "date", F.col("__file").alias(RAW), *(F.col(c).alias(SNOTEL_DAILY[c]) for c in met))
    if "prcp" in df.columns:
        df = increments(df, "prcp", keys=["source_station_id"], order=["date"])
    return provenance(df.withColumns({"day_basis": F.lit("local"), "obs_count": F.lit(1)}), "snotel", run_id)


def read_snotel_hourly(spark: SparkSession, path: Paths, run_id: str | None = None) -> DataFrame:
    """Hourly Parquet in UTC; elevation in feet; the id is the triplet's first part, else the file's name."""
    df = of_file(_parquet(spark, path))
    return normalize_snotel_hourly(df, stem(F.col("__file")), run_id)


# The shape of the service's answers.
SNOTEL_ANSWER = "array<struct<stationTriplet:string,data:array<struct<stationElement:struct<elementCode:string,storedUnitCode:string>,values:array<struct<date:string,value:double>>>>>>"
SNOTEL_STATIONS = "array<struct<stationTriplet:string,networkCode:string,name:string,latitude:double,longitude:double,elevation:double,dataTimeZone:double>>"
INVENTORY = "station_inventory.json"


def read_snotel_json(spark: SparkSession, path: Paths, run_id: str | None = None) -> DataFrame:
    """Hourly answers as they were downloaded, with the inventory beside them for places and time zones: inches and degrees
    Fahrenheit become millimetres and degrees Celsius, local times UTC.  Stations without a time zone give no rows."""
    first = path if isinstance(path, str) else path[0]
    folder = re.sub(r"[^/]*$", "", first) if first.endswith(".json") else f"{first}/"
    places = spark.read.text(f"{folder}{INVENTORY}", wholetext=True).select(F.inline(F.from_json("value", SNOTEL_STATIONS))).where("dataTimeZone is not null")
    places = places.groupBy(F.col("stationTriplet").alias("triplet")).agg(*(F.first(a).alias(b) for a, b in (("dataTimeZone", "tz_offset"), ("latitude", "lat"), ("longitude", "lon"), ("elevation", "elev_ft"))))
    whole = of_file(spark.read.text(path, wholetext=True)).where(~F.col("__file").endswith(INVENTORY))
    series = whole.select("__file", F.inline(F.from_json("value", SNOTEL_ANSWER))).select("__file", F.col("stationTriplet").alias("triplet"), F.inline("data"))
    values = series.select("__file", "triplet", F.col("stationElement.elementCode").alias("code"), F.col("stationElement.storedUnitCode").alias("unit"), F.inline("values"))
    metric = F.when(F.col("unit") == "in", F.col("value") * 25.4).when(F.col("unit") == "degF", units.f_to_c(F.col("value"))).otherwise(F.col("value"))
    wide = values.groupBy("__file", "triplet", F.try_to_timestamp("date").alias("datetime_local")).agg(*(F.max(F.when(F.col("code") == c, metric)).alias(c) for c in SNOTEL_HOURLY))
    rows = wide.where("datetime_local is not null").join(F.broadcast(places), "triplet")  # a row a station
    return normalize_snotel_hourly(rows, stem(F.col("__file")), run_id)


def normalize_snotel_hourly(df: DataFrame, station: Column, run_id: str | None = None) -> DataFrame:
    """The same from rows; station: the id where there is no triplet.  Times with a column tz_offset (hours) are local."""
    from skyledger.operators.temporal import increments

    own = F.split("triplet", ":")[0] if "triplet" in df.columns else F.lit(None).cast("string")
    met = [c for c in SNOTEL_HOURLY if c in df.columns]
    ts = "datetime_utc" if "datetime_utc" in df.columns else next(c for c in df.columns if re.search("date|time", c.lower()))
    opt = {"lat": "lat", "lon": "lon"}
    at = F.col(ts).cast("timestamp")
    if "tz_offset" in df.columns:
        at = C.to_utc(at, F.col("tz_offset") * 60)
    out = df.select(
        F.coalesce(own, station).alias("source_station_id"), at.alias("datetime_utc"), *(F.col(c).cast("double").alias(SNOTEL_HOURLY[c]) for c in met),
        *(F.col(k).cast("double").alias(v) for k, v in opt.items() if k in df.columns), *([(F.col("elev_ft") * 0.3048).alias("elev_m")] if "elev_ft" in df.columns else []), *(c.alias(k) for k, c in _raw(df).items()),
    )
    if "prcp" in out.columns:
        out = increments(out, "prcp", keys=["source_station_id"], order=["datetime_utc"])
    return provenance(out, "snotel", run_id)


# -- ECCC --------------------------------------------------------------------------------------------------------
# Beginnings of native names, variables and scales; flags.
ECCC = {"Temp": ("tair", 1.0), "Dew Point Temp": ("td", 1.0), "Rel Hum": ("rh", 1.0), "Precip. Amount": ("prcp", 1.0), "Wind Dir": ("wind_dir", 10.0), "Wind Spd": ("wind", 1 / 3.6), "Stn Press": ("psfc", 1000.0)}
ECCC_FAIL, ECCC_SUSPECT, ECCC_PASS = ("M", "N", "Y"), ("E", "A", "C", "L", "B", "F", "^", "D"), ("", "S", "T", "†")


def read_eccc(spark: SparkSession, path: Paths, *, province: str | None = None, run_id: str | None = None) -> DataFrame:
    """Hourly CSV in Latin-1 and local standard time.  Flags give states; a failed value is nulled, trace precipitation
    is 0; of rows of one time the first file's stays."""
    return normalize_eccc(of_file(spark.read.csv(path, header=True, encoding="ISO-8859-1")), province=province, run_id=run_id)


def normalize_eccc(raw: DataFrame, *, province: str | None = None, run_id: str | None = None) -> DataFrame:
    """The same from rows of text columns with the file's name as __file."""
    find = lambda start: next((c for c in raw.columns if c.lower().startswith(start.lower()) and "flag" not in c.lower()), None)
    flag_of = lambda start: next((c for c in raw.columns if c.lower().startswith(f"{start.lower()} flag")), None)
    file = F.col("__file")
    # The province stands in the file's name: a column of its own, as it is compared with many others.
    named_by_file = F.lit(province) if province else F.upper(F.regexp_extract(file, r"_([A-Za-z]{2})_[0-9A-Za-z]+_[^/]*$", 1))
    raw = raw.withColumn("__province", named_by_file)
    prov = F.col("__province")
    named = lambda s: next((F.col(f"`{c}`") for c in raw.columns if s in c.lower()), F.lit(None).cast("string"))
    lon, lat = C.num(named("longitude")), C.num(named("latitude"))
    local = F.coalesce(F.try_to_timestamp(named("date/time"), F.lit("yyyy-MM-dd HH:mm")), F.try_to_timestamp(named("date/time")))
    out: dict[str, Column] = {"source_station_id": F.concat_ws("_", prov, F.trim(named("climate id"))), "datetime_utc": C.to_utc(local, C.offset_minutes(prov, lon)), "lat": lat, "lon": lon, "__file": file}
    ranks, reasons = [], []
    for start, (v, scale) in ECCC.items():
        c = find(start)
        if c is None:
            continue
        fc = flag_of(start)
        flag = F.coalesce(F.trim(F.col(f"`{fc}`")), F.lit("")) if fc else F.lit("")
        rank = F.when(flag.isin(*ECCC_FAIL), 2).when(flag.isin(*ECCC_PASS), 0).otherwise(1)
        value = C.num(F.col(f"`{c}`")) * scale
        if v == "prcp":
            value = F.when(flag == "T", 0.0).otherwise(value)
        out |= {v: F.when(rank < 2, value), f"{v}_qc_state": C.state_of(rank), f"{v}_qc_reason_codes": F.when(rank > 0, flag).otherwise("")}
        ranks.append(rank)
        reasons.append(F.when(rank > 0, F.concat(F.lit(f"{v}:"), flag)))
    out |= {"qc_state": C.state_of(F.greatest(F.lit(0), F.lit(0), *ranks)), "qc_reason_codes": C.join_reasons(*reasons) if reasons else F.lit("")}
    df = raw.select(*(c.alias(k) for k, c in out.items())).where("datetime_utc is not null")
    return provenance(keep_first(df, ["source_station_id", "datetime_utc"], ["__file"]).withColumnRenamed("__file", RAW), "eccc", run_id)


# -- MADIS -------------------------------------------------------------------------------------------------------
# Native names, variables and conversions.
MADIS = {
    "temperature": ("tair", units.k_to_c), "dewpoint": ("td", units.k_to_c), "relHumidity": ("rh", units.same), "windSpeed": ("wind", units.same), "windDir": ("wind_dir", units.same),
    "precipAccum": ("prcp", units.same), "solarRadiation": ("rsds_hourly", units.same),
}
MADIS_CORE = ("temperature", "dewpoint", "relHumidity", "windSpeed", "windDir")
MADIS_IDS = ("stationId", "dataProvider")


def madis_columns(path: str, content: bytes, wanted: Callable[[dict[str, np.ndarray], int], np.ndarray] | None = None) -> dict[str, pa.Array]:
    """The columns of an hourly netCDF file: absent measures are null, absent ids empty, texts stripped; of the rows only
    that are wanted, by a mask over the numbers (NaN where missing)."""
    f = netcdf.variables(unzip(path, content))
    names = [*MADIS_IDS, "latitude", "longitude", "elevation", "observationTime", *MADIS, *(f"{v}{s}" for v in MADIS_CORE for s in ("DD", "QCR"))]
    n = len(f["latitude"])
    numbers = {k: np.where(np.isfinite(x := f[k].astype(float)), x, np.nan) for k in names if k in f and f[k].dtype.kind != "S"}
    at = np.flatnonzero(wanted(numbers, n)) if wanted else np.arange(n)
    cols = {}
    for name in names:
        if name in numbers:
            cols[name] = pa.array(numbers[name][at], pa.float64(), from_pandas=True)
        elif name in f:
            cols[name] = pa.array([x.split(b"\0")[0].decode("utf-8", "replace").strip() for x in f[name][at].tolist()], pa.string())
        elif name in MADIS_IDS:
            cols[name] = pa.array([""] * len(at), pa.string())
        else:
            cols[name] = pa.nulls(len(at), pa.string() if name.endswith("DD") else pa.float64())
    return cols


def decode_madis(path: str, content: bytes) -> pa.Table:
    """Rows of an hourly netCDF file."""
    return pa.table(madis_columns(path, content))


MADIS_FIELDS = (
    "stationId string, dataProvider string, latitude double, longitude double, elevation double, observationTime double, " + ", ".join(f"{v} double" for v in MADIS)
    + ", " + ", ".join(f"{v}DD string, {v}QCR double" for v in MADIS_CORE)
)


def scan_madis(spark: SparkSession, path: Paths) -> DataFrame:
    """Native rows of hourly netCDF files, and a row with its error for each file that cannot be read."""
    return _decode(spark, path, decode_madis, MADIS_FIELDS)


def read_madis(spark: SparkSession, path: Paths, *, bounds: tuple[float, float, float, float] | None = None, qcr_mask: int = 115, run_id: str | None = None) -> DataFrame:
    """Hourly netCDF files; bounds west, south, east, north, half open; then the extract checks and canonical columns.
    Files that cannot be read are in decode_failures(scan_madis(...))."""
    return extract_madis(scan_madis(spark, path), bounds=bounds, qcr_mask=qcr_mask, run_id=run_id)


def extract_madis(decoded: DataFrame, *, bounds: tuple[float, float, float, float] | None = None, qcr_mask: int = 115, run_id: str | None = None) -> DataFrame:
    from skyledger.operators.rules import madis_extract_qc

    df = decoded.where("error is null")
    df = df.withColumn("observationTime", F.timestamp_seconds("observationTime"))
    if bounds:
        df = in_bounds(df, *bounds)
    return normalize_madis(madis_extract_qc(df, qcr_mask), run_id)


def in_bounds(df: DataFrame, west: float, south: float, east: float, north: float, *, lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """The half-open box."""
    return df.where((F.col(lat) >= south) & (F.col(lat) < north) & (F.col(lon) >= west) & (F.col(lon) < east))


def normalize_madis(df: DataFrame, run_id: str | None = None) -> DataFrame:
    """Native to canonical wide columns; descriptors and check results are carried."""
    keep = [c for c in df.columns if c.endswith(("DD", "QCR")) or c == "qc_passed"]
    keep += [F.col("path").alias(RAW)] if "path" in df.columns else []
    out = df.select(
        F.trim("stationId").alias("source_station_id"), F.col("observationTime").cast("timestamp").alias("datetime_utc"), F.col("latitude").alias("lat"), F.col("longitude").alias("lon"),
        F.col("elevation").alias("elev_m"), *(fn(C.num(n)).alias(v) for n, (v, fn) in MADIS.items() if n in df.columns), *keep,
    )
    return provenance(out.where("source_station_id <> '' and datetime_utc is not null"), "madis", run_id)


def to_long(wide: DataFrame, variables: list[str], *, flags: dict[str, list[str]] | None = None) -> DataFrame:
    """Wide to long: a row for each value that is present, with unit, native flags as JSON and state."""
    state = F.when(~F.col("qc_passed"), "fail").otherwise("pass") if "qc_passed" in wide.columns else F.coalesce("qc_state", F.lit("pass")) if "qc_state" in wide.columns else F.lit("pass")
    cells = []
    for v in variables:
        if v in wide.columns:
            native = [c for c in (flags or {}).get(v, []) if c in wide.columns]
            cells.append(F.struct(F.lit(v).alias("variable"), F.col(v).cast("double").alias("value"), F.lit(units.CANONICAL.get(v)).alias("unit"), (F.to_json(F.struct(*native)) if native else F.lit("{}")).alias("qc_flags_native")))
    keys = [c for c in ("station_key", "source", "source_station_id", "datetime_utc", RAW, "transform_version", "qc_rules_version", "ingest_run_id") if c in wide.columns]
    return wide.select(*keys, state.alias("qc_state"), F.inline(F.array(*cells))).where("value is not null and station_key is not null and datetime_utc is not null")


# -- GDAS --------------------------------------------------------------------------------------------------------
# Native names.
GDAS = {"temperature": "tair", "pressure": "psfc", "specific_humidity": "q", "u_wind": "u", "v_wind": "v", "sst": "sst"}


def normalize_gdas(df: DataFrame, run_id: str | None = None) -> DataFrame:
    """Decoded PrepBUFR rows to canonical columns: the source by message type; longitudes to -180..180; markers carried."""
    lon = F.when(F.col("longitude") > 180, F.col("longitude") - 360).otherwise(F.col("longitude"))
    marks = [c for c in df.columns if c.endswith("_qm")]
    ts = next(c for c in ("datetime_utc", "datetime") if c in df.columns)
    out = df.select(
        F.concat(F.lit("gdas_"), F.lower("msg_type")).alias("source"), F.trim(F.col("station_id").cast("string")).alias("source_station_id"), F.col(ts).cast("timestamp").alias("datetime_utc"), *([c for c in ("cycle", "msg_type") if c in df.columns]),
        F.col("latitude").cast("double").alias("lat"), lon.cast("double").alias("lon"), *([F.col("elevation").cast("double").alias("elev_m")] if "elevation" in df.columns else []),
        *(F.when(F.abs(C.num(n)) <= 1e10, C.num(n)).alias(v) for n, v in GDAS.items() if n in df.columns), *marks, *(c.alias(k) for k, c in _raw(df).items()),
    )
    new = {"transform_version": F.lit(schema.VERSION), "qc_rules_version": F.lit(schema.VERSION), "ingest_run_id": F.lit(run_id).cast("string"), "qc_state": F.lit("pass"), "qc_reason_codes": F.lit("")}
    return out.withColumns({"station_key": F.concat_ws(":", "source", "source_station_id"), **new})


def read_gdas_parquet(spark: SparkSession, path: Paths, run_id: str | None = None) -> DataFrame:
    return normalize_gdas(of_file(_parquet(spark, path)), run_id)


def archive_members(path: str, content: bytes) -> list[tuple[str, int, bytes]]:
    """(name, cycle hour, bytes) of the messages in a day's tar: flat members named t<HH>z, or nested archives whose
    names end with the cycle as ten digits."""
    out = []
    with tarfile.open(fileobj=io.BytesIO(content)) as tar:
        for m in tar:
            if not m.isfile():
                continue
            data = tar.extractfile(m).read()
            if hit := re.search(r"t(\d{2})z", m.name):
                out.append((m.name, int(hit[1]), data))
            elif hit := re.search(r"prepbufr\.gdas\.(\d{10})\.?", m.name):
                if data[:4] == b"BUFR" or not tarfile.is_tarfile(io.BytesIO(data)):
                    out.append((m.name, int(hit[1][-2:]), data))
                else:
                    out += [(n, int(hit[1][-2:]), b) for n, _, b in archive_members(m.name, data)] or [(m.name, int(hit[1][-2:]), data)]
    return out


def scan_gdas_archive(spark: SparkSession, path: str, decode, fields: str) -> DataFrame:
    """Native rows of day archives through a BUFR decoder given by the caller: decode(bytes, cycle hour) -> rows as dicts;
    and a row with its error for each archive that cannot be read."""
    return _decode(spark, path, lambda p, c: [r for _, h, b in archive_members(p, c) for r in decode(b, h)], fields)


def read_gdas_archive(spark: SparkSession, path: str, decode, fields: str, run_id: str | None = None) -> DataFrame:
    """The same in canonical columns; failures are in decode_failures(scan_gdas_archive(...))."""
    return normalize_gdas(scan_gdas_archive(spark, path, decode, fields).where("error is null"), run_id)


# -- all ---------------------------------------------------------------------------------------------------------
def probed(spark: SparkSession, path: Paths) -> DataFrame:
    """(path, error) of files that are opened as their names say: Parquet footers, gz to its end; error is null if all is well."""

    def probe(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import pyarrow.parquet as pq

        for frame in frames:
            errors = []
            for name, content in zip(frame["path"], frame["content"]):
                try:
                    if name.endswith(".parquet"):
                        pq.ParquetFile(io.BytesIO(content)).schema_arrow  # noqa: B018
                    elif name.endswith(".gz"):
                        gzip.decompress(content)
                    errors.append(None)
                except Exception as e:  # noqa: BLE001
                    errors.append(f"{type(e).__name__}: {(str(e).splitlines() or [''])[0][:200]}")
            yield pd.DataFrame({"path": frame["path"], "error": errors})

    files = spark.read.format("binaryFile").load(path).select(F.col("_metadata.file_path").alias("path"), "content")
    return files.mapInPandas(probe, "path string, error string")


def readable_parquet(spark: SparkSession, path: str, source: str = "") -> tuple[list[str], DataFrame]:
    """The Parquet files under a path that can be opened, and a failure report of the others.

    A scan without columns reads footers only and passes over files that it cannot open; only the files that it did not
    see (broken, or without rows) are looked at as bytes.  Names come to the driver, which needs them to scan."""

    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    names = {r.path for r in listed.load(path).select("path").collect()}  # names of files
    opened = spark.read.schema("`none` string").option("ignoreCorruptFiles", "true").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    plain = lambda p: re.sub("^file:/+", "/", p)
    seen = {plain(r[0]) for r in opened.parquet(path).select(F.input_file_name()).distinct().collect()}  # names of files
    odd = sorted(p for p in names if plain(p) not in seen)
    if not odd:
        return sorted(names), spark.createDataFrame([], schema.FAILURE)
    broken = [tuple(r) for r in probed(spark, odd).where("error is not null").collect()]  # names of files
    bad = {plain(p) for p, _ in broken}
    report = spark.createDataFrame(broken, "path string, error string")
    return sorted(p for p in names if plain(p) not in bad), decode_failures(report, source).withColumn("phase", F.lit("read"))


def station_metadata(df: DataFrame) -> DataFrame:
    """One row for each station: the latest place, by an aggregate that merges on the map side."""
    cols = [c for c in ("source", "source_station_id", "lat", "lon", "elev_m") if c in df.columns]
    last = F.max_by(F.struct(*cols), F.struct("datetime_utc", *cols)).alias("x")
    return df.groupBy("station_key").agg(last).select("station_key", "x.*")
