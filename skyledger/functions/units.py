"""Unit conversions and the registry of (variable, unit) rules."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Canonical unit of each variable.
CANONICAL = {
    "tair": "degC", "tmin": "degC", "tmax": "degC", "tmean": "degC", "td": "degC",
    "rh": "percent", "ea": "kPa", "vpd": "kPa", "q": "kg kg-1",
    "u": "m s-1", "v": "m s-1", "wind": "m s-1", "u2": "m s-1", "wind_dir": "deg",
    "psfc": "Pa", "slp": "Pa", "rsds_hourly": "W m-2", "rsds": "MJ m-2 day-1", "prcp": "mm",
}
# Further variables of our own readers.
CANONICAL |= {"tw": "degC", "sst": "degC", "wind_gust": "m s-1"}


def linear(scale: float, shift: float = 0.0) -> Callable[[Column], Column]:
    return lambda c: c * F.lit(scale) + F.lit(shift) if shift else c * F.lit(scale)


def f_to_c(c: Column) -> Column:
    return (c - 32.0) * (5.0 / 9.0)


def k_to_c(c: Column) -> Column:
    return c - 273.15


kt_to_ms, mph_to_ms, hpa_to_pa, inhg_to_pa, in_to_mm = (linear(k) for k in (0.514444, 0.44704, 100.0, 3386.389, 25.4))


def same(c: Column) -> Column:
    return c


class UnitRegistry:
    """Conversions by variable and source unit; version of each rule."""

    def __init__(self) -> None:
        self._rules: dict[tuple[str, str], tuple[Callable[[Column], Column], str]] = {}

    def register(self, variable: str, unit: str, rule: Callable[[Column], Column], version: str = "1") -> None:
        self._rules[variable, unit] = (rule, version)

    def _rule(self, variable: str, unit: str) -> tuple[Callable[[Column], Column], str]:
        if variable not in CANONICAL:
            raise KeyError(f"unknown variable {variable!r}")
        if unit == CANONICAL[variable] and (variable, unit) not in self._rules:
            return same, "identity"
        if (variable, unit) not in self._rules:
            raise KeyError(f"no rule for {variable!r} in {unit!r}")
        return self._rules[variable, unit]

    def convert(self, c: Column, variable: str, unit: str) -> Column:
        return self._rule(variable, unit)[0](c)

    def get_version(self, variable: str, unit: str) -> str:
        return self._rule(variable, unit)[1]

    def convert_long(self, value: Column, variable: Column, unit: Column) -> Column:
        """For long tables of mixed variables and units; an unknown pair raises when it is met."""
        out = F.raise_error(F.concat_ws(" ", F.lit("no unit rule for"), variable, unit)).cast("double")
        for v, u in CANONICAL.items():
            out = F.when((variable == v) & (unit == u), value).otherwise(out)
        for (v, u), (rule, _) in self._rules.items():
            out = F.when((variable == v) & (unit == u), rule(value)).otherwise(out)
        return F.when(value.isNotNull(), out)


def default_registry() -> UnitRegistry:
    r = UnitRegistry()
    for v in "tair tmax tmin tmean td tw sst".split():
        r.register(v, "degF", f_to_c)
        r.register(v, "K", k_to_c)
    for v in "wind u v u2 wind_gust".split():
        r.register(v, "kt", kt_to_ms)
        r.register(v, "mph", mph_to_ms)
    for v in "slp psfc".split():
        r.register(v, "hPa", hpa_to_pa)
        r.register(v, "mb", hpa_to_pa)
        r.register(v, "inHg", inhg_to_pa)
    r.register("prcp", "in", in_to_mm)
    return r
