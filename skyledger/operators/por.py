"""Station periods of record: normalised hourly or daily rows to checked daily series for each station."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skyledger import schema
from skyledger.operators import daily as D
from skyledger.operators import tables
from skyledger.operators import temporal as T
from skyledger.operators.tables import BUCKETS

DAILY_NATIVE = ("ghcnd", "raws", "raws_wrcc", "snotel_daily")


# Sources by which files are named, longer names before those that they begin with.
NAMED_SOURCES = ("raws_wrcc", "gdas_adpsfc", "gdas_sfcshp", "snotel", "ghcnd", "ghcnh", "madis", "ndbc", "eccc", "gdas", "raws", "isd")


def in_dates(df: DataFrame, ts: str, start: date | None, end: date | None) -> DataFrame:
    """Rows of whole UTC days from start to end, both included, as a range on the time column so that it is pushed down."""
    if start:
        df = df.where(F.col(ts) >= F.lit(start).cast("timestamp"))
    if end:
        df = df.where(F.col(ts) < F.date_add(F.lit(end).cast("date"), 1).cast("timestamp"))
    return df


def daily_passthrough(df: DataFrame, *, file_col: str | None = None, sources: tuple[str, ...] = NAMED_SOURCES) -> DataFrame:
    """Fills the daily contract of sources that are daily already; RAWS names and kWh to MJ.  Where a file has no
    station key at all, the key comes from its name."""
    cols = set(df.columns)
    rename = {"rh_max": "rhmax", "rh_min": "rhmin"}
    for a, b in rename.items():
        if a in cols and b not in cols:
            df = df.withColumnRenamed(a, b)
    if "source" in cols and "rsds" in cols:
        df = df.withColumn("rsds", F.when(F.col("source").isin("raws", "raws_wrcc"), F.col("rsds") * 3.6).otherwise(F.col("rsds")))
    fill = {"obs_count": F.lit(1), "qc_state": F.lit("pass"), "day_basis": F.lit("local"), "coverage_flags": F.lit("n=1,thresh=Y,am=N,pm=N"), "transform_version": F.lit(schema.VERSION), "qc_rules_version": F.lit(schema.VERSION)}
    df = df.withColumns({c: F.coalesce(F.col(c), v) if c in cols else v for c, v in fill.items()})
    if file_col and file_col in cols:
        stem = F.regexp_extract(file_col, r"([^/]+?)(?:\.[^./]*)?$", 1)
        known = F.count("station_key").over(Window.partitionBy(file_col)) > 0
        df = df.withColumn("station_key", F.when(known, F.col("station_key")).otherwise(F.regexp_replace(stem, f"^({'|'.join(sources)})_", "$1:")))
    return df.withColumn("obs_count", F.col("obs_count").cast("int"))


@dataclass
class StationPor:
    """Checked series, and the stations that were left out or not fully checked, with reasons."""

    series: DataFrame
    skipped: DataFrame
    qc_skipped: DataFrame


def build_station_por(
    rows: DataFrame, *, source: str, start: date | None = None, end: date | None = None, min_por_days: int = 0, raster: DataFrame | None = None, index: DataFrame | None = None, extra: bool = False, already_daily: bool = False
) -> StationPor:
    """Scan to series: date filter, failed values out, daily aggregation, least record, clear sky, tier 2.

    Days are aggregated over all files at once, so a station day split over files is one row.  After the aggregation
    everything is partitioned by station alone.
    """
    if already_daily:
        days = daily_passthrough(rows)
        if start:
            days = days.where(F.col("date") >= F.lit(start))
        if end:
            days = days.where(F.col("date") <= F.lit(end))
    else:
        rows = in_dates(rows, "datetime_utc", start, end)
        if source == "gdas":
            rows = T.prepare_gdas(rows)
        days = D.aggregate_daily_wide(D.drop_failed(rows), source=source)
    days = T.keep_first(days, ["station_key", "date"], [F.col("obs_count").desc()])
    need = schema.required_hours(source) if not already_daily else 1
    enough = F.count(F.when(F.col("obs_count") >= need, 1)).over(Window.partitionBy("station_key"))
    days = days.withColumn("__days", enough)
    skipped = days.where(F.col("__days") < min_por_days).groupBy("station_key").agg(F.max("__days").alias("days"), F.count(F.lit(1)).alias("rows")).withColumn("reason", F.lit("insufficient_por_days"))
    kept = days.where(F.col("__days") >= min_por_days).drop("__days")
    has = set(kept.columns)
    if index is not None:
        kept = with_coordinates(kept, index)
        has |= {"lat", "lon", "elev_m"}
    if {"lat", "elev_m"} <= has:
        stations = kept.groupBy("station_key").agg(F.min_by("lat", F.when(F.col("lat").isNotNull(), F.col("date"))).alias("lat"), F.min_by("elev_m", F.when(F.col("elev_m").isNotNull(), F.col("date"))).alias("elev_m"))
    else:
        stations = kept.select("station_key").distinct().withColumns({"lat": F.lit(None).cast("double"), "elev_m": F.lit(None).cast("double")})
    how = T.resolve_rso(stations, raster, listed=index)
    formula = T.clear_sky_table(stations.join(how.where("method = 'asce'"), "station_key", "left_semi"))
    rso = formula if raster is None else formula.unionByName(raster.select("station_key", "doy", "rso"))
    variables = [v for v in schema.SERIES_COLUMNS.get(source, schema.QC_COLUMNS.get(source, ())) if v in has]
    series = T.tier2(kept, variables, rso=rso if "rsds" in has else None, extra=extra)
    return StationPor(series, skipped, how.where("reason is not null").select("station_key", "reason"))


def write_failure_report(done: StationPor, path: str, source: str) -> None:
    """Beside the series: the stations that were left out, and the checks that were, with reasons, as JSON lines."""
    hours = schema.required_hours(source)
    details = F.concat(F.lit("sufficient_days="), F.col("days").cast("string"), F.lit(f",required_hours={hours}"))
    out = done.skipped.select(F.lit(source).alias("source"), F.lit("min_por_days").alias("phase"), "station_key", "reason", details.alias("details"))
    checks = done.qc_skipped.select(F.lit(source).alias("source"), F.lit("rs_period_ratio").alias("phase"), "station_key", "reason", F.lit("").alias("details"))
    out.unionByName(checks).write.mode("overwrite").json(f"{path}_failures_{source}")


def inventory(series: DataFrame) -> DataFrame:
    """Days, first and last date and states of each station."""
    return series.groupBy("station_key").agg(
        F.count(F.lit(1)).alias("days"), F.min("date").alias("first_date"), F.max("date").alias("last_date"), F.count(F.when(F.col("qc_state") == "fail", 1)).alias("failed_days")
    )


def with_coordinates(days: DataFrame, index: DataFrame) -> DataFrame:
    """days with coordinates from the station index (station_key, lat, lon, elev_m) where they have none."""
    own = {c: F.col(c) if c in days.columns else F.lit(None).cast("double") for c in ("lat", "lon", "elev_m")}
    places = index.select("station_key", *(F.col(c).cast("double").alias(f"__{c}") for c in own)).dropDuplicates(["station_key"])
    joined = days.join(places, "station_key", "left")
    return joined.withColumns({c: F.coalesce(v, F.col(f"__{c}")) for c, v in own.items()}).drop(*(f"__{c}" for c in own))


def bucket(key: Column, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def safe_name(station_key: str) -> str:
    return station_key.replace(":", "_").replace("/", "_")


def write_station_por(series: DataFrame, path: str, *, buckets: int = BUCKETS, table: str | None = None) -> None:
    """One folder for each hash bucket of stations, sorted by station and date, so that a station is found in one folder
    by the statistics of its files; or, with a name, a table that lies by station (``tables``)."""
    if table:
        tables.write(series, table, path, "station_key", sort=("date",), buckets=buckets)
        return
    rows = series.withColumn("bucket", bucket(F.col("station_key"), buckets))
    rows.repartition("bucket").sortWithinPartitions("bucket", "station_key", "date").write.mode("overwrite").partitionBy("bucket").parquet(path)


def load_station_por(spark: SparkSession, path: str, stations: list[str] | None = None, *, buckets: int = BUCKETS) -> DataFrame:
    """Series that write_station_por wrote, one row for each station and date; for some stations only their buckets are read."""
    df = spark.read.parquet(path)
    if stations is not None:
        wanted = spark.createDataFrame([(s,) for s in stations], "station_key string").select(bucket(F.col("station_key"), buckets).alias("b")).distinct().collect()  # one row a bucket
        df = df.where(F.col("bucket").isin([r.b for r in wanted])).where(F.col("station_key").isin(stations))
    return T.keep_first(df.drop("bucket"), ["station_key", "date"], [F.col("obs_count").desc(), F.xxhash64(*sorted(c for c in df.columns if c != "bucket"))])
