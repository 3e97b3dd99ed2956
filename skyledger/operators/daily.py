"""Daily aggregation: station days from hourly rows, in one shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger import schema
from skyledger.functions import columns as C

# How each variable is aggregated.
AGG_MAP = {"tair": "mean", "td": "mean", "rh": "mean", "wind": "mean", "slp": "mean", "psfc": "mean", "swe": "mean", "snow_depth": "mean", "prcp": "sum", "wind_dir": "circular_mean"}
DERIVED = {"tmax": "tair", "tmin": "tair", "tmean": "tair", "rhmax": "rh", "rhmin": "rh", "rsds": "rsds_hourly"}
AGGREGATABLE = [*AGG_MAP, "rsds_hourly"]


def drop_failed(df: DataFrame) -> DataFrame:
    """Nulls each failed variable and drops rows without any value left; without per-variable states, drops failed rows.
    A missing state passes; a table without qc_state stays as it is."""
    if "qc_state" not in df.columns:
        return df
    states = [c for c in df.columns if c.endswith("_qc_state") and c.removesuffix("_qc_state") in df.columns]
    if not states:
        return df.where(F.coalesce(F.col("qc_state"), F.lit("pass")) != "fail")
    df = df.withColumns({c.removesuffix("_qc_state"): F.when(F.coalesce(F.col(c), F.lit("pass")) != "fail", F.col(c.removesuffix("_qc_state"))) for c in states})
    left = [F.col(c).cast("double") for c in AGGREGATABLE if c in df.columns]
    return df.where(F.coalesce(*left).isNotNull()) if left else df


def coverage(ts: Column, required: Column | int) -> dict[str, Column]:
    """Row count and the coverage string of a group: n, enough hours, mornings and afternoons covered.  Hours are bits of
    a mask, so the aggregate merges on the map side in one pass, and streams, which know no distinct counts, can use it."""
    mask = F.bit_or(F.call_function("shiftleft", F.lit(1), F.hour(ts)))
    bits = lambda lo, hi: F.bit_count(mask.bitwiseAND(F.lit(sum(1 << h for h in range(lo, hi + 1)))))
    required = F.lit(required) if isinstance(required, int) else required
    yes = lambda c: F.when(c, "Y").otherwise("N")
    return {
        "obs_count": F.count(F.lit(1)).cast("int"),
        "coverage_flags": F.concat(
            F.lit("n="), F.count(F.lit(1)).cast("string"), F.lit(",thresh="), yes(bits(0, 23) >= required), F.lit(",am="), yes(bits(6, 11) >= 4), F.lit(",pm="), yes(bits(12, 17) >= 4)
        ),
    }


def accumulate_increments(df: DataFrame, value: str, keys: list[str], order: list[str]) -> DataFrame:
    """Replaces an accumulated amount by its positive increments within each group (first: 0); null stays null."""
    w = Window.partitionBy(*keys, F.col(value).isNotNull()).orderBy(*order)
    step = F.col(value) - F.lag(value).over(w)
    return df.withColumn(value, F.when(F.col(value).isNotNull(), F.greatest(F.coalesce(step, F.lit(0.0)), F.lit(0.0))))


def aggregate_daily_wide(
    df: DataFrame, *, source: str | None = None, agg_map: dict[str, str] | None = None, required_hours: int | None = None, run_id: str | None = None
) -> DataFrame:
    """One row per station and UTC day.  Failed values should be nulled first (drop_failed)."""
    if not {"datetime_utc", "station_key"} <= set(df.columns):
        spark = df.sparkSession
        return spark.createDataFrame([], schema.DAILY_CORE)
    how = AGG_MAP if agg_map is None else agg_map
    cols = set(df.columns)
    df = df.withColumn("date", F.to_date("datetime_utc"))
    if source == "madis" and "prcp" in cols and how.get("prcp") == "sum":
        df = accumulate_increments(df, "prcp", ["station_key", "date"], ["datetime_utc", "prcp"])
    aggs: dict[str, Column] = {}
    for v, kind in how.items():
        if v in cols:
            c = F.col(v).cast("double")
            aggs[v] = {"mean": F.avg, "sum": F.sum, "circular_mean": C.circular_mean, "max": F.max, "min": F.min}[kind](c)
    if "tair" in cols:
        aggs |= {"tmax": F.max("tair"), "tmin": F.min("tair"), "tmean": F.avg("tair")}
    if "rh" in cols:
        aggs |= {"rhmax": F.max("rh"), "rhmin": F.min("rh")}
    if "rsds_hourly" in cols:
        aggs["rsds"] = F.avg("rsds_hourly") * 86400 / 1e6
    need: Column | int = required_hours if required_hours is not None else schema.required_hours(source)
    if required_hours is None and source is None and "source" in cols:  # each source by its own rule
        need = F.lit(schema.DEFAULT_REQUIRED_HOURS)
        for s, h in schema.REQUIRED_HOURS.items():
            need = F.when(F.first("source", ignorenulls=True) == s, h).otherwise(need)
    aggs |= coverage(F.col("datetime_utc"), need)
    aggs["qc_state"] = C.state_of(F.max(C.state_rank(F.col("qc_state")))) if "qc_state" in cols else F.lit("pass")
    if "qc_reason_codes" in cols:
        pairs = F.sort_array(F.collect_list(F.when(F.coalesce("qc_reason_codes", F.lit("")) != "", F.struct("datetime_utc", "qc_reason_codes"))))
        aggs["qc_reason_codes"] = C.distinct_reasons(F.transform(pairs, lambda p: p["qc_reason_codes"]))
    for v in sorted({*how, *DERIVED.values()} & cols):
        if f"{v}_qc_state" in cols:
            aggs[f"{v}_qc_state"] = C.state_of(F.coalesce(F.max(F.when(F.col(v).isNotNull(), C.state_rank(F.col(f"{v}_qc_state")))), F.lit(0)))
    for c in ("lat", "lon", "elev_m"):
        if c in cols:
            aggs[c] = F.min_by(c, F.when(F.col(c).isNotNull(), F.col("datetime_utc")))
    for c in ("source", "source_station_id"):
        if c in cols:
            aggs[c] = F.min(c)
    out = df.groupBy("station_key", "date").agg(*(e.alias(n) for n, e in aggs.items()))
    for d, base in DERIVED.items():
        if d in aggs and f"{base}_qc_state" in aggs:
            out = out.withColumn(f"{d}_qc_state", F.col(f"{base}_qc_state"))
    return out.withColumns({"day_basis": F.lit("utc"), "qc_rules_version": F.lit(schema.VERSION), "transform_version": F.lit(schema.VERSION), "ingest_run_id": F.lit(run_id).cast("string")})


def aggregate_daily_long(df: DataFrame, *, day_basis: str = "utc") -> DataFrame:
    """Rows (station_key, variable, datetime_utc, value) to daily values and counts of values."""
    if day_basis != "utc":
        raise NotImplementedError("only UTC days are aggregated")
    v = F.col("variable")
    value = F.when(v == "tmax", F.max("value")).when(v == "tmin", F.min("value")).when(v == "prcp", F.sum("value")).when(v == "rsds", F.avg("value") * 0.0864)
    value = value.when(v == "wind_dir", C.circular_mean(F.col("value"))).otherwise(F.avg("value"))
    return df.groupBy("station_key", "variable", F.to_date("datetime_utc").alias("date")).agg(value.alias("value"), F.count("value").alias("obs_count"))
