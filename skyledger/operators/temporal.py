"""Checks along a station's series: window functions over one partitioning by station, and one grouped map."""

from __future__ import annotations

from functools import reduce
from operator import and_

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.functions import columns as C


def medians(df: DataFrame, groups: list[str], values: list[str], *, near: float = 0.002, accuracy: int = 10_000) -> DataFrame:
    """(groups, __value, n, median): how many values each group has of each column, and their exact median, for groups of any size.

    Sketches of a group give bounds ``near`` the middle on both sides, which hold it as their error is at most 1/accuracy; values below are
    counted and those between are ranked, so no task holds a group.
    """
    long = df.select(*groups, F.explode(F.array(*(F.struct(F.lit(v).alias("__value"), F.col(v).cast("double").alias("x")) for v in values))).alias("e"))
    long = long.select(*groups, "e.*").where("x is not null")
    keys = [*groups, "__value"]
    sketched = F.percentile_approx(F.when(F.isnan("x"), F.lit(float("inf"))).otherwise(F.col("x")), [0.5 - near, 0.5 + near], accuracy)
    bounds = long.groupBy(*keys).agg(sketched.alias("__b"), F.count(F.lit(1)).alias("n"))
    # Few groups are small beside the rows of theirs; in a session that broadcasts nothing, many rows of a group would meet in a task.
    rows = joined(long, bounds, keys)
    low, high = F.col("__b")[0], F.when(F.col("__b")[1] == float("inf"), float("nan")).otherwise(F.col("__b")[1])
    at = F.when(F.col("x") >= low, F.col("x"))  # null: below
    counts = rows.where(F.col("x") <= high).groupBy(*keys, at.alias("x")).agg(F.count(F.lit(1)).alias("c"), F.first("n").alias("n"))
    order = Window.partitionBy(*keys).orderBy(F.asc_nulls_first("x"))
    upto = counts.withColumn("upto", F.sum("c").over(order))
    first, second = F.floor((F.col("n") - 1) / 2), F.ceil((F.col("n") - 1) / 2)
    held = lambda k: (F.col("upto") - F.col("c") <= k) & (k < F.col("upto"))
    out = upto.groupBy(*keys).agg(F.first("n").alias("n"), F.max(F.when(held(first), F.col("x"))).alias("a"), F.max(F.when(held(second), F.col("x"))).alias("b"))
    return out.select(*keys, "n", F.when(F.col("a") == F.col("b"), F.col("a")).otherwise(0.5 * F.col("a") + 0.5 * F.col("b")).alias("median"))


def joined(df: DataFrame, facts: DataFrame, keys: list[str]) -> DataFrame:
    """df with the columns of facts, a row of which there is for each different keys, null being a key like others."""
    facts = facts.withColumnsRenamed({k: f"__k_{k}" for k in keys})
    return df.join(facts, reduce(and_, (F.col(k).eqNullSafe(F.col(f"__k_{k}")) for k in keys)), "left").drop(*(f"__k_{k}" for k in keys))


def monthly_zscores(df: DataFrame, names: dict[str, str], *, keys: list[str], date: str = "date", least: int = 90, suspect: float = 3.5, fail: float = 7.0) -> DataFrame:
    """Adds {out}_z and {out}_state for each value: out of ``names``, by the modified z-score within each calendar month
    across years.  Medians of all values are found together and joined to the rows, so no task holds a month or a series.

    Series of fewer than ``least`` values, and months of fewer, pass; where the median deviation is 0 all pass.
    """
    df = df.withColumn("__month", F.month(date))
    groups = [*keys, "__month"]

    def with_medians(df: DataFrame, columns: dict[str, str], n: str | None, median: str) -> DataFrame:
        found = medians(df, groups, list(columns))
        wide = found.groupBy(*groups).agg(*(F.max(F.when(F.col("__value") == c, F.col(x))).alias(f"__{k}_{o}") for c, o in columns.items() for k, x in ((n, "n"), (median, "median")) if k))
        if n:  # a row a month of a series
            wide = wide.withColumns({f"__total_{o}": F.sum(f"__{n}_{o}").over(Window.partitionBy(*keys)) for o in columns.values()})
        return joined(df, wide, groups)

    df = with_medians(df, names, "n", "med")
    df = df.withColumns({f"__dev_{o}": F.abs(F.col(v) - F.col(f"__med_{o}")) for v, o in names.items()})
    df = with_medians(df, {f"__dev_{o}": o for o in names.values()}, None, "mad")
    z = {o: F.when((F.col(f"__n_{o}") >= least) & (F.col(f"__total_{o}") >= least) & (F.col(f"__mad_{o}") > 0), F.lit(0.6745) * F.col(f"__dev_{o}") / F.col(f"__mad_{o}")) for o in names.values()}
    df = df.withColumns({f"{o}_z": c for o, c in z.items()})
    df = df.withColumns({f"{o}_state": F.when(F.col(f"{o}_z") > fail, "fail").when(F.col(f"{o}_z") > suspect, "suspect").otherwise("pass") for o in z})
    return df.drop("__month", *(f"__{k}_{o}" for k in ("n", "total", "med", "dev", "mad") for o in z))


def monthly_zscore(df: DataFrame, value: str, *, out: str | None = None, **how) -> DataFrame:
    """The same for one value."""
    return monthly_zscores(df, {value: out or value}, **how)


def isolated(df: DataFrame, *, keys: list[str], ts: str, hours: float = 6.0, tie: list[str] | None = None, out: str = "isolated") -> DataFrame:
    """Adds a flag: gaps to both neighbours (at the ends: the one there is) exceed ``hours``; single rows pass."""
    w = Window.partitionBy(*keys).orderBy(ts, *(tie or []))
    micros = lambda c: F.unix_micros(c.cast("timestamp"))
    limit = int(hours * 3_600_000_000)
    before = micros(F.col(ts)) - micros(F.lag(ts).over(w))
    after = micros(F.lead(ts).over(w)) - micros(F.col(ts))
    return df.withColumn(out, F.coalesce(F.coalesce(before > limit, F.lit(True)) & F.coalesce(after > limit, F.lit(True)) & (before.isNotNull() | after.isNotNull()), F.lit(False)))


def stuck(df: DataFrame, value: str, *, keys: list[str], order: list[str], least: int = 12, out: str = "run_length") -> DataFrame:
    """Adds the length of the run of equal values a row is in (null for null and zero rows, which part no run), and
    {out}_state: suspect from ``least`` on."""
    live = F.col(value).isNotNull() & (F.col(value) != 0) if dict(df.dtypes)[value] != "string" else F.col(value).isNotNull()
    w = Window.partitionBy(*keys, "__live").orderBy(*order)
    df = df.withColumn("__live", live)
    df = df.withColumn("__new", F.when(F.col(value).eqNullSafe(F.lag(value).over(w)) & (F.row_number().over(w) > 1), 0).otherwise(1))
    df = df.withColumn("__run", F.sum("__new").over(w))
    n = F.when(F.col("__live"), F.count(F.lit(1)).over(Window.partitionBy(*keys, "__live", "__run")))
    df = df.withColumn(out, n).drop("__live", "__new", "__run")
    return df.withColumn(f"{out}_state", F.when(F.col(out) >= least, "suspect").otherwise("pass"))


def dewpoint_daily(td: Column, tmin: Column, tolerance: float = 3.0) -> Column:
    return F.when(td > tmin + tolerance, "fail").otherwise("pass")


def increments(df: DataFrame, value: str, *, keys: list[str], order: list[str]) -> DataFrame:
    """A cumulative amount to its steps: negative steps and the first are null."""
    step = F.col(value) - F.lag(value).over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn(value, F.when(step >= 0, step))


def keep_first(df: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """One row for each key: the first in the given order."""
    return df.withColumn("__n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("__n = 1").drop("__n")


def rh_correction(df: DataFrame, value: str, *, keys: list[str], date: str = "date", top: float = 0.01, least: int = 365, out: str | None = None) -> DataFrame:
    """Adds {out}_corrected: each year scaled so that the mean of its highest percent reaches 100, clipped to 0..100.
    Series of fewer rows than ``least`` stay as they are."""
    out = out or value
    year = Window.partitionBy(*keys, F.year(date))
    df = df.withColumns({"__rows": F.count(F.lit(1)).over(Window.partitionBy(*keys)), "__n": F.count(value).over(year)})
    df = df.withColumn("__rank", F.row_number().over(year.orderBy(F.desc_nulls_last(value), date)))
    best = F.when(F.col("__rank") <= F.greatest(F.lit(1), F.ceil(F.col("__n") * top)), F.col(value))
    df = df.withColumn("__top", F.avg(best).over(year))
    fixed = F.when((F.col("__rows") >= least) & (F.col("__top") > 0), C.clip(F.col(value) * 100 / F.col("__top"), 0, 100)).otherwise(F.col(value))
    return df.withColumn(f"{out}_corrected", fixed).drop("__rows", "__n", "__rank", "__top")


def rh_drift(df: DataFrame, value: str, *, keys: list[str], date: str = "date", least: int = 365) -> DataFrame:
    """(keys, factor, state): mean correction of the series; from 5 % suspect, from 15 % fail."""
    df = rh_correction(df, value, keys=keys, date=date, least=least, out="__rh")
    ratio = F.when(F.col(value) > 0, F.col("__rh_corrected") / F.col(value))
    out = df.groupBy(*keys).agg(F.avg(ratio).alias("factor"), F.count(F.lit(1)).alias("n"))
    off = F.greatest("factor", 1 / F.col("factor"))
    return out.select(*keys, "factor", F.when(F.col("n") < least, "pass").when(off >= 1.15, "fail").when(off >= 1.05, "suspect").otherwise("pass").alias("state"))


def _despike(ratio: np.ndarray, excess: np.ndarray, change: float, most: float) -> np.ndarray:
    """Of the largest ratios, those that stay: one goes while leaving it out moves their mean by more than ``change``
    or while the mean excess over clear sky is ``most`` or more."""
    keep = np.argsort(-ratio, kind="stable")
    while len(keep) > 1:
        now, then = ratio[keep].mean(), ratio[keep[1:]].mean()
        if abs(now - then) / max(abs(now), 1e-12) <= change and excess[keep].mean() < most:
            break
        keep = keep[1:]
    return keep


BLOCK = 6000  # rows of a series that are numbered together
PERIODS = 100  # periods of a series that are looked at together


def rs_period_ratio(df: DataFrame, *, key: str, date: str = "date", rs: str = "rsds", rso: str = "rso", period: int = 60, largest: int = 6, change: float = 0.02, most_excess: float = 75.0) -> DataFrame:
    """Adds rs_period_factor, rs_corrected and rs_state to a daily series with clear-sky radiation.

    In each period of 60 rows the largest ratios of measured to clear-sky radiation, without spikes, give a factor;
    outside 0.5..1.5 the period is removed, within 0.97..1.03 it is left alone.  Values beyond twice the largest clear sky
    and zeros are removed first, and are not judged.  A value that its period removes and that exceeds the clear sky fails.
    Series of fewer than 60 rows pass.  Rows are numbered along their series in blocks of its span, and a group of the map is
    PERIODS periods, so a series may have any number of rows.
    """
    names = df.columns
    order = F.col(date).cast("double") if dict(df.dtypes)[date] not in ("date", "timestamp", "timestamp_ntz") else F.col(date).cast("timestamp").cast("double")
    number = F.when(~F.isnan(F.col(rso).cast("double")), F.col(rso).cast("double"))
    finite = F.max(F.abs(number) < float("inf"))
    facts = df.groupBy(key).agg(F.count(F.lit(1)).alias("__rows"), F.min(order).alias("__from"), F.max(order).alias("__to"), F.max(number).alias("__most"), F.coalesce(finite, F.lit(False)).alias("__any"))
    rows = joined(df, F.broadcast(facts), [key])  # a row a station
    blocks = F.greatest(F.col("__rows") / BLOCK, F.lit(1)).cast("long")
    at = F.floor((order - F.col("__from")) / (F.col("__to") - F.col("__from")) * blocks)
    rows = rows.withColumn("__block", F.least(F.coalesce(at, F.when(order.isNull(), blocks - 1), F.lit(0)), blocks - 1).cast("long")).drop("__from", "__to")
    held = rows.groupBy(key, "__block").agg(F.count(F.lit(1)).alias("__c"))
    before = held.withColumn("__before", F.sum("__c").over(Window.partitionBy(key).orderBy("__block")) - F.col("__c")).drop("__c")  # a row a block
    within = F.row_number().over(Window.partitionBy(key, "__block").orderBy(F.asc_nulls_last(date))) - 1
    rows = joined(rows.withColumn("__in", within), before, [key, "__block"]).withColumn("__i", F.col("__before") + F.col("__in")).drop("__block", "__before", "__in")

    def fix(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("__i").reset_index(drop=True)
        x, top, part_of = pdf[rs].to_numpy(float).copy(), pdf[rso].to_numpy(float), pdf["__i"].to_numpy() // period
        factor, fixed = np.full(len(x), np.nan), x.copy()
        if pdf["__rows"].iloc[0] >= period and pdf["__any"].iloc[0]:
            clean = np.where((x > 2 * pdf["__most"].iloc[0]) | (x == 0), np.nan, x)
            fixed = clean.copy()
            cut = np.flatnonzero(np.diff(part_of, prepend=-1, append=-1))
            for part in map(slice, cut[:-1].tolist(), cut[1:].tolist()):
                with np.errstate(invalid="ignore", divide="ignore"):
                    ratio = clean[part] / top[part]
                some = np.flatnonzero(np.isfinite(ratio))
                if not len(some):
                    continue
                best = some[np.argsort(-ratio[some], kind="stable")[:largest]]
                stay = best[_despike(ratio[best], (clean[part] - top[part])[best], change, most_excess)]
                f = 1 / ratio[stay].mean()
                factor[part] = f
                if 0.97 <= f <= 1.03:
                    continue
                if 0.5 <= f <= 1.5:
                    fixed[part] = clean[part] * f
                else:
                    fixed[part] = np.nan
            state = np.where(np.isfinite(clean) & np.isnan(fixed) & (clean > top), "fail", "pass")
        else:
            state = np.full(len(x), "pass")
        return pdf[names].assign(rs_period_factor=factor, rs_corrected=fixed, rs_state=state)

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    return rows.groupBy(key, F.floor(F.col("__i") / (period * PERIODS)).alias("__group")).applyInPandas(fix, f"{kinds}, rs_period_factor double, rs_corrected double, rs_state string")


def clear_sky_table(stations: DataFrame) -> DataFrame:
    """(station_key, doy, rso) for 365 days from station latitude and elevation."""
    days = stations.select("station_key", "lat", "elev_m", F.explode(F.sequence(F.lit(1), F.lit(365))).alias("doy"))
    return days.select("station_key", "doy", C.clear_sky(F.col("lat"), F.col("elev_m"), F.col("doy")).alias("rso"))


def with_clear_sky(daily: DataFrame, rso: DataFrame) -> DataFrame:
    """Joins clear-sky radiation by station and day of year; day 366 takes day 1."""
    key = (F.pmod(F.dayofyear("date") - 1, F.lit(365)) + 1).alias("doy")
    return daily.withColumn("doy", key).join(rso.select("station_key", "doy", "rso"), ["station_key", "doy"], "left").drop("doy")


def resolve_rso(stations: DataFrame, raster: DataFrame | None = None, *, listed: DataFrame | None = None, formula: bool = True) -> DataFrame:
    """(station_key, method, reason): whether clear-sky radiation comes from an extracted raster table, the formula, or
    nowhere, and then why.  A raster that has a station without any value is no source.  listed: the station index
    (station_key, lat, lon), in which a station must have a place if a raster is asked for; formula: False leaves it out."""
    base = stations.select("station_key", F.col("lat").cast("double").alias("lat"), F.col("elev_m").cast("double").alias("elev_m"))
    no = F.lit(False)
    if raster is not None:
        base = base.join(raster.groupBy("station_key").agg((F.count("rso") > 0).alias("has")).withColumn("asked", F.lit(True)), "station_key", "left")
    else:
        base = base.withColumns({"has": no, "asked": no})
    if listed is not None:
        base = base.join(listed.select("station_key", (F.col("lat").isNotNull() & F.col("lon").isNotNull()).alias("placed")), "station_key", "left")
    else:
        base = base.withColumn("placed", F.lit(True))
    has, asked, placed = (F.coalesce(F.col(c), no) for c in ("has", "asked", "placed"))
    place = (
        F.when(F.col("lat").isNull() | F.col("elev_m").isNull(), F.when(~placed, "station_index_missing_coords").otherwise("missing_lat_or_elev"))
        .when(~F.col("lat").between(-90, 90), "invalid_lat").when(~F.col("elev_m").between(-500, 9000), "invalid_elev_m")
    )
    rso = C.clear_sky(F.col("lat"), F.col("elev_m"), F.lit(172))
    failed = F.when(rso.isNull() | F.isnan(rso), F.when(asked, "rsun_and_asce_failed").otherwise("asce_failed"))
    why = F.coalesce(place, failed) if formula else F.lit("rso_unavailable")
    reason = F.when(has, None).otherwise(why)
    method = F.when(has, "raster").when(reason.isNull(), "asce")
    return base.select("station_key", method.alias("method"), reason.alias("reason"))


def raster_table(samples: DataFrame) -> DataFrame:
    """(station_key, doy, rso) in MJ/m2 from raster samples (station_key, doy, value) in Wh/m2: negative ones are 0."""
    return samples.select("station_key", "doy", F.greatest(F.col("value") * WH_TO_MJ, F.lit(0.0)).alias("rso"), F.col("value").alias("given")).where("given is not null").drop("given")


WH_TO_MJ = 0.0036  # fixed value
# Variables that the z-score leaves out, and the daily cap on precipitation in mm.
ZSCORE_SKIP = {"prcp", "wind", "wind_dir", "tair"}
PRCP_CAP = 610.0


def tier2(daily: DataFrame, variables: list[str], *, rso: DataFrame | None = None, extra: bool = False, propagate: bool = False) -> DataFrame:
    """Tier-2 checks of daily series: z-scores, the precipitation cap, humidity correction and the radiation ratio.

    Row states only get worse and reasons are appended.  ``extra`` adds the dew point and stuck-sensor checks,
    ``propagate`` writes fails to the variables' own states.
    """
    own = daily.columns
    df, ranks, reasons = daily, [], []
    per_variable: dict[str, list[Column]] = {}

    def note(variable: str, state: Column, reason: str) -> None:
        ranks.append(C.state_rank(state))
        reasons.append(F.when(C.state_rank(state) > 0, reason))
        per_variable.setdefault(variable, []).append(state)

    temporary = []
    scored = {v: f"__z_{v}" for v in variables if v in own and v not in ZSCORE_SKIP}
    if scored:
        df = monthly_zscores(df, scored, keys=["station_key"])
    for v, z in scored.items():
        note(v, F.col(f"{z}_state"), f"zscore_{v}")
        temporary += [f"{z}_state", f"{z}_z"]
    if "prcp" in own:
        note("prcp", F.when(F.col("prcp") > PRCP_CAP, "fail").otherwise("pass"), "prcp_exceeds_daily_max")
    if "rh" in own:
        high = "rhmax" if "rhmax" in own else "rh"
        df = rh_correction(df, high, keys=["station_key"], out="__h")
        scale = F.when(F.col(high) > 0, F.col("__h_corrected") / F.col(high)).otherwise(1.0)
        df = df.withColumns({f"{c}_corrected": C.clip(F.col(c) * F.coalesce(scale, F.lit(1.0)), 0, 100) for c in ("rh", "rhmax", "rhmin") if c in own})
        temporary.append("__h_corrected")
    if rso is not None and "rsds" in own:
        df = rs_period_ratio(with_clear_sky(df, rso), key="station_key")
        note("rsds", F.col("rs_state"), "rs_period_ratio")
        temporary += ["rs_state", "rs_corrected", "rso"]
    if extra:
        if {"td", "tmin"} <= set(own):
            note("td", dewpoint_daily(F.col("td"), F.col("tmin")), "td_exceeds_tmin_daily")
        for v in variables:
            if v in own:
                df = stuck(df, v, keys=["station_key"], order=["date"], out=f"__s_{v}")
                note(v, F.col(f"__s_{v}_state"), "stuck_sensor")
                temporary += [f"__s_{v}_state", f"__s_{v}"]
    seed = F.col("qc_state") if "qc_state" in own else F.lit("pass")
    why = F.col("qc_reason_codes") if "qc_reason_codes" in own else F.lit("")
    new = {"qc_state": C.state_of(F.greatest(C.state_rank(seed), F.lit(0), *ranks)), "qc_reason_codes": C.distinct_reasons(F.array(why, C.join_reasons(*reasons) if reasons else F.lit("")))}
    if propagate:
        new |= {f"{v}_qc_state": C.worst(*([F.col(f"{v}_qc_state")] if f"{v}_qc_state" in own else []), *s) for v, s in per_variable.items()}
    return df.withColumns(new).drop(*temporary)


def prepare_gdas(df: DataFrame) -> DataFrame:
    """Dew point and wind from humidity and components where they are missing, and one row for each station and time:
    of each column the first value that is present, by cycle."""
    cols = set(df.columns)
    new: dict[str, Column] = {}
    old = lambda c: F.col(c) if c in cols else F.lit(None).cast("double")
    if {"q", "psfc"} <= cols:
        new["td"] = F.coalesce(old("td"), C.dewpoint_from_humidity(F.col("q"), F.col("psfc")))
    if {"u", "v"} <= cols:
        new |= {"wind": F.coalesce(old("wind"), C.wind_speed(F.col("u"), F.col("v"))), "wind_dir": F.coalesce(old("wind_dir"), C.wind_direction(F.col("u"), F.col("v")))}
    df = df.withColumns(new)
    order = F.col("cycle") if "cycle" in cols else F.lit(0)
    rest = [c for c in df.columns if c not in ("station_key", "datetime_utc")]
    return df.groupBy("station_key", "datetime_utc").agg(*(F.min_by(c, F.when(F.col(c).isNotNull(), F.struct(order, F.col(c).cast("string")))).alias(c) for c in rest))


