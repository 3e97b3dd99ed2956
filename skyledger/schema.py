"""Fixed table contracts, enumerations and constant tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

S, D, I, B, DT, TS = T.StringType(), T.DoubleType(), T.IntegerType(), T.BooleanType(), T.DateType(), T.TimestampType()


def _struct(required: tuple[str, ...], **kinds: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(k, v, k not in required) for k, v in kinds.items()])


# Columns of the tables, and which must be there.
STATION = _struct(
    ("station_key", "source", "source_station_id"), station_key=S, source=S, source_station_id=S, lat=D, lon=D, elev_m=D, country=S, state=S, network=S, provider=S,
    por_start=DT, por_end=DT, active_flag=B, metadata_version=S,
)
HOURLY_LONG = _struct(
    ("station_key", "source", "source_station_id", "datetime_utc", "variable", "unit"), station_key=S, source=S, source_station_id=S, datetime_utc=TS, variable=S, value=D, unit=S,
    qc_state=S, qc_flags_native=S, qc_rules_version=S, transform_version=S, raw_source_uri=S, raw_file_hash=S, ingest_run_id=S,
)
DAILY_CORE = _struct(
    ("station_key", "date", "day_basis"), station_key=S, date=DT, day_basis=S, obs_count=I, coverage_flags=S, qc_state=S, qc_rules_version=S, transform_version=S, ingest_run_id=S,
)
# Daily measures besides the core.
DAILY_METRICS = (
    "tmax", "tmin", "tmean", "ea", "vpd", "u2", "rsds", "rsds_corrected", "prcp",
    "rhmax", "rhmin", "rh_corrected", "rhmax_corrected", "rhmin_corrected",
    "swe", "snow_depth", "snow",
    "soil_temp_5cm", "soil_temp_20cm", "soil_temp_50cm", "soil_temp_100cm",
    "soil_moisture_5cm", "soil_moisture_20cm", "soil_moisture_50cm", "soil_moisture_100cm",
    "sst", "wave_height", "sunshine_dur",
)
MANIFEST = _struct(("source", "key", "state"), source=S, key=S, state=S, updated_utc=TS, run_id=S, message=S)
RAW_FILE = _struct(("source", "key", "uri"), source=S, key=S, uri=S, length=T.LongType(), modified=TS, run_id=S)
RELEASE = _struct(("product", "path", "sha256"), product=S, path=S, sha256=S, row_count=T.LongType(), date_min=DT, date_max=DT, qc_summary=S)
CROSSWALK_MATCH = _struct(("source_station_key", "canonical_station_id"), source_station_key=S, canonical_station_id=S, confidence=S, match_method=S, distance_m=D)
FAILURE = _struct(("source", "phase"), source=S, phase=S, input_file=S, error_type=S, error=S)

QC_STATES = ("pass", "suspect", "fail", "missing")
MANIFEST_STATES = ("done", "missing", "suspect", "failed", "skipped")
CONFIDENCE = ("exact_match", "probable_match", "manual_match", "no_match")
TIERS = {"native": 0, "physical": 1, "temporal": 2, "spatial": 3}
VERSION = "0.2.0"

# Closed physical bounds of each variable.
BOUNDS = {
    "tair": (-90, 60), "tmin": (-90, 60), "tmax": (-90, 60), "tmean": (-90, 60), "td": (-100, 50), "rh": (0, 100), "ea": (0, 10), "vpd": (0, 15), "wind": (0, 120), "u2": (0, 120),
    "u": (-120, 120), "v": (-120, 120), "wind_dir": (0, 360), "psfc": (30000, 110000), "slp": (85000, 110000), "rsds": (0, 50), "rsds_hourly": (0, 1400), "prcp": (0, 1000),
}
# Variables under quality control, by source.
QC_COLUMNS = {
    "madis": ("tair", "td", "rh", "wind", "wind_dir", "prcp", "rsds_hourly"),
    "isd": ("tair", "td", "wind", "wind_dir", "slp", "prcp"),
    "ghcnh": ("tair", "td", "wind", "wind_dir", "slp", "psfc", "prcp", "rh"),
    "ghcnd": ("tmax", "tmin", "tmean", "prcp", "snow", "snow_depth", "wind", "swe"),
    "gdas": ("tair", "td", "wind", "wind_dir", "psfc", "prcp"),
    "raws": ("tmean", "tmax", "tmin", "wind", "wind_dir", "rh", "prcp", "rsds"),
    "ndbc": ("tair", "td", "wind", "wind_dir", "slp"),
    "snotel": ("tair", "prcp", "swe", "snow_depth"),
    "eccc": ("tair", "td", "rh", "wind", "wind_dir", "prcp", "psfc"),
}
# Daily variables that the series checks look at, by source; other sources: those of QC_COLUMNS.
SERIES_COLUMNS = {
    "madis": ("tmax", "tmin", "tmean", "td", "rh", "wind", "wind_dir", "prcp", "rsds"),
    "ghcnh": ("tmax", "tmin", "tmean", "td", "wind", "wind_dir", "slp", "psfc", "prcp", "rh"),
    "gdas": ("tmean", "td", "psfc"),
    "ndbc": ("tmax", "tmin", "tmean", "td", "wind", "wind_dir", "slp"),
    "snotel": ("tmax", "tmin", "tmean", "prcp", "swe", "snow_depth"),
    "eccc": ("tmax", "tmin", "tmean", "td", "rh", "wind", "wind_dir", "prcp", "psfc"),
}
# Distinct hours a day needs, by source.
REQUIRED_HOURS = {"madis": 18, "ghcnh": 4, "gdas": 4, "ndbc": 18, "raws": 1, "snotel": 4, "eccc": 4}
DEFAULT_REQUIRED_HOURS = 18
# Which source's value comes first, by variable.
PRECEDENCE = {
    "hourly": {
        "tair": ["ghcnh", "madis", "gdas", "eccc", "ndbc"],
        "td": ["ghcnh", "madis", "gdas", "eccc", "ndbc"],
        "rh": ["ghcnh", "madis", "eccc"],
        "wind": ["ghcnh", "madis", "gdas", "eccc", "ndbc"],
        "wind_dir": ["ghcnh", "madis", "gdas", "eccc", "ndbc"],
        "wind_gust": ["ghcnh", "ndbc"],
        "slp": ["ghcnh", "gdas", "ndbc"],
        "psfc": ["ghcnh", "gdas"],
        "prcp": ["ghcnh", "madis"],
        "tw": ["ghcnh"],
    },
    "daily": {
        "tmax": ["ghcnd", "snotel", "raws_wrcc", "ndbc"],
        "tmin": ["ghcnd", "snotel", "raws_wrcc", "ndbc"],
        "tmean": ["ghcnd", "snotel", "raws_wrcc", "ndbc"],
        "prcp": ["ghcnd", "snotel", "raws_wrcc"],
        "swe": ["snotel"],
        "snow": ["ghcnd"],
        "snow_depth": ["ghcnd"],
        "wind": ["ghcnd", "raws_wrcc", "snotel", "ndbc"],
        "rh": ["raws_wrcc", "snotel"],
        "td": ["eccc", "ndbc"],
        "slp": ["ndbc"],
        "psfc": ["eccc"],
    },
}
# Names under which a source's rows go elsewhere.
SOURCE_ALIASES = {"gdas_adpsfc": "gdas", "gdas_sfcshp": "gdas", "raws": "raws_wrcc"}


def required_hours(source: str | None) -> int:
    return REQUIRED_HOURS.get(source or "", DEFAULT_REQUIRED_HOURS)


def conform(df: DataFrame, schema: T.StructType, *, extra: list[str] | None = None) -> DataFrame:
    """df cast to the contract; ValueError if a required column is missing.  ``extra`` names columns kept besides."""
    missing = [f.name for f in schema if not f.nullable and f.name not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {', '.join(missing)}")
    own = [(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema]
    return df.select(*own, *(F.col(c) for c in extra or [] if c in df.columns and c not in schema.names))


def conform_hourly(df: DataFrame) -> DataFrame:
    """The hourly contract: ValueError unless every column is there."""
    if missing := [f.name for f in HOURLY_LONG if f.name not in df.columns]:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return conform(df, HOURLY_LONG)


def conform_daily(df: DataFrame, *, keep_extra: bool = False) -> DataFrame:
    """The daily contract: the core and the measures that there are; ``keep_extra`` keeps other columns, too."""
    if missing := [f.name for f in DAILY_CORE if f.name not in df.columns]:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return conform(df, DAILY_CORE, extra=df.columns if keep_extra else list(DAILY_METRICS))
