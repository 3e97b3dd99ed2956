"""Column builders used by several operators.  No Python runs on the data."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

EARTH_M = 6_371_000.0


def num(c: Column | str) -> Column:
    """A number or null: unreadable text and NaN become null."""
    c = F.col(c) if isinstance(c, str) else c
    return F.nullif(c.try_cast("double"), F.lit(float("nan")))


def or_null(c: Column, *missing: float) -> Column:
    return F.when(~c.isin(*missing), c)


# -- states ------------------------------------------------------------------------------------------------------
def state_rank(c: Column) -> Column:
    """0 pass (and missing or unknown), 1 suspect, 2 fail."""
    return F.when(c == "fail", 2).when(c == "suspect", 1).otherwise(0)


def state_of(rank: Column) -> Column:
    return F.when(rank == 2, "fail").when(rank == 1, "suspect").otherwise("pass")


def worst(*states: Column) -> Column:
    return state_of(F.greatest(F.lit(0), *(state_rank(s) for s in states)))


def join_reasons(*reasons: Column) -> Column:
    """Reasons in order, comma-joined, without empty ones."""
    return F.array_join(F.filter(F.array(*(F.coalesce(r, F.lit("")) for r in reasons)), lambda x: x != ""), ",")


def distinct_reasons(lists: Column) -> Column:
    """From an array of comma-joined lists: the distinct reasons in order of first sight."""
    parts = F.flatten(F.transform(lists, lambda s: F.split(F.coalesce(s, F.lit("")), ",")))
    return F.array_join(F.array_distinct(F.filter(F.transform(parts, lambda x: F.trim(x)), lambda x: x != "")), ",")


# -- statistics --------------------------------------------------------------------------------------------------
def circular_mean(degrees: Column) -> Column:
    """Mean direction in [0, 360); null without values."""
    r = F.radians(degrees)
    return F.pmod(F.degrees(F.atan2(F.avg(F.sin(r)), F.avg(F.cos(r)))), F.lit(360.0))


def haversine(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Metres on a sphere of 6,371 km."""
    a, b = F.radians(lat1), F.radians(lat2)
    h = F.pow(F.sin((b - a) / 2), 2) + F.cos(a) * F.cos(b) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return F.lit(2 * EARTH_M) * F.asin(F.sqrt(F.least(h, F.lit(1.0))))


def clip(c: Column, lo: float, hi: float) -> Column:
    return F.when(c.isNotNull(), F.least(F.greatest(c, F.lit(lo)), F.lit(hi)))


# -- meteorology -------------------------------------------------------------------------------------------------
def saturation(t: Column) -> Column:
    """Saturation vapour pressure, kPa."""
    return F.lit(0.6108) * F.exp(F.lit(17.27) * t / (t + 237.3))


def dewpoint(ea: Column) -> Column:
    """Dew point of a vapour pressure in kPa."""
    return F.when(ea > 0, (F.lit(116.91) + F.lit(237.3) * F.ln(ea)) / (F.lit(16.78) - F.ln(ea)))


def vapour_pressure(q: Column, p_pa: Column) -> Column:
    """From specific humidity (kg/kg) and pressure (Pa), kPa."""
    return q * (p_pa / 1000.0) / (F.lit(0.622) + F.lit(0.378) * q)


def dewpoint_from_humidity(q: Column, p_pa: Column) -> Column:
    """Inverse Magnus of the vapour pressure."""
    e = vapour_pressure(q, p_pa)
    x = F.ln(e / 0.6108)
    return F.when(e > 0, F.lit(237.3) * x / (F.lit(17.27) - x))


def wind_speed(u: Column, v: Column) -> Column:
    return F.sqrt(u * u + v * v)


def wind_direction(u: Column, v: Column) -> Column:
    return F.pmod(F.degrees(F.atan2(-u, -v)), F.lit(360.0))


def extraterrestrial(lat: Column, doy: Column) -> Column:
    """Daily radiation above the atmosphere, MJ/m2 (ASCE 2005)."""
    phi, day = F.radians(lat), F.lit(2 * math.pi / 365) * doy
    dr, delta = F.lit(1.0) + F.lit(0.033) * F.cos(day), F.lit(0.409) * F.sin(day - 1.39)
    x = -F.tan(phi) * F.tan(delta)
    ws = F.acos(F.least(F.greatest(x, F.lit(-1.0)), F.lit(1.0)))
    return F.lit(24 / math.pi * 4.92) * dr * (ws * F.sin(phi) * F.sin(delta) + F.cos(phi) * F.cos(delta) * F.sin(ws))


def clear_sky(lat: Column, elev_m: Column, doy: Column) -> Column:
    """Clear-sky radiation, MJ/m2: (0.75 + 2e-5 z) Ra."""
    return (F.lit(0.75) + F.lit(2e-5) * elev_m) * extraterrestrial(lat, doy)


def dms(degrees: Column, minutes: Column, seconds: Column, hemisphere: Column) -> Column:
    """Degrees, minutes and seconds with N/S/E/W to signed degrees."""
    v = degrees + F.coalesce(minutes, F.lit(0.0)) / 60 + F.coalesce(seconds, F.lit(0.0)) / 3600
    return F.when(F.upper(hemisphere).isin("S", "W"), -v).otherwise(v)


def parse_dms(text: Column) -> Column:
    """Text such as 40 10'30" N."""
    part = lambda k: F.nullif(F.regexp_extract(text, r"(\d+(?:\.\d+)?)\D+?(?:(\d+(?:\.\d+)?)\D+?)?(?:(\d+(?:\.\d+)?)\D*?)?\s*([NSEWnsew])", k), F.lit(""))
    return dms(part(1).try_cast("double"), part(2).try_cast("double"), part(3).try_cast("double"), part(4))


def offset_minutes(province: Column, lon: Column) -> Column:
    """Standard-time offset of a Canadian province in minutes; longitude decides where a province has several."""
    # Hours from UTC.
    hours = {"NL": -3.5, "NS": -4, "NB": -4, "PE": -4, "QC": -5, "ON": -5, "NU": -5, "MB": -6, "SK": -6, "AB": -7, "YT": -7, "NT": -7, "BC": -8}
    table = F.create_map(*(F.lit(x) for p, h in hours.items() for x in (p, int(h * 60))))
    out = F.coalesce(F.try_element_at(table, province), F.lit(-360))
    north = F.when(lon < -102, -420).when(lon < -85, -360).otherwise(-300)
    return F.when((province == "ON") & (lon < -85), -360).when(province.isin("NT", "NU") & lon.isNotNull(), north).otherwise(out)


def to_utc(local: Column, offset: Column) -> Column:
    """Local standard time to UTC, for an offset in minutes."""
    return local - F.make_dt_interval(F.lit(0), F.lit(0), offset.cast("int"), F.lit(0))


def ensure_utc(df: DataFrame, *names: str) -> DataFrame:
    """df, if the named columns are instants; ValueError for a time without a zone."""
    kinds = {f.name: f.dataType for f in df.schema}
    for n in names:
        if not isinstance(kinds[n], T.TimestampType):
            raise ValueError(f"{n} is {kinds[n].simpleString()}: a time without a zone is not accepted, attach UTC first")
    return df


def attach_utc(df: DataFrame, *names: str) -> DataFrame:
    """df with times without a zone taken as UTC, which is the zone of our sessions."""
    return df.withColumns({n: F.col(n).cast("timestamp") for n in names})


def utc_date(ts: Column) -> Column:
    return F.to_date(ts)
