"""Vapour pressure and dew point from whatever humidity columns a table has."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.functions import columns as C


def _measures(df: DataFrame) -> dict[str, tuple[tuple[str, ...], Column]]:
    """Ways to a vapour pressure by priority: the columns that they need, and the formula."""
    c = {n: F.col(n) for n in ("ea", "td", "tmax", "tmin", "rhmax", "rhmin", "rh") if n in df.columns}
    high = C.saturation(c["tmax"]) if "tmax" in c else None
    low = C.saturation(c["tmin"]) if "tmin" in c else None
    ways: dict[str, tuple[tuple[str, ...], Column]] = {}
    if "ea" in c:
        ways["ea"] = (("ea",), c["ea"])
    if "td" in c:
        ways["td"] = (("td",), C.saturation(c["td"]))
    if {"rhmax", "rhmin", "tmax", "tmin"} <= set(c):
        ways["rhmax"] = (("rhmax", "rhmin"), (low * c["rhmax"] + high * c["rhmin"]) / 200)
    if {"rh", "tmax", "tmin"} <= set(c):
        ways["rh"] = (("rh",), c["rh"] / 100 * (high + low) / 2)
    if "tmin" in c:
        ways["tmin"] = (("tmin",), low)
    return ways


def compile_humidity(df: DataFrame, *, keys: list[str] | None = None) -> DataFrame:
    """Adds ea_compiled and td_compiled by priority: ea, td, rhmax and rhmin, rh, and last tmin as the dew point.

    The first measure whose columns are not wholly null decides for the whole table, or for each series named by ``keys``
    (first pass); where it is null, the next ones fill the gap (second pass).  A measured td stays where there is one.  tavg
    defaults to the mean of tmax and tmin.  Without ``keys`` the table is one series, and as the ways are tried in one
    order, a row's first measure that is present decides in both passes, so no pass over the table is needed.
    """
    ways = _measures(df)
    ea = F.coalesce(*(w for _, w in ways.values())) if ways else F.lit(None).cast("double")
    td = F.coalesce(F.col("td"), C.dewpoint(ea)) if "td" in df.columns else C.dewpoint(ea)
    out = df.withColumns({"ea_compiled": ea, "td_compiled": td})
    if {"tmax", "tmin"} <= set(df.columns) and "tavg" not in df.columns:
        out = out.withColumn("tavg", (F.col("tmax") + F.col("tmin")) / 2)
    return out
