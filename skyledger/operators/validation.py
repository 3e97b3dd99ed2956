"""Validation against an independently checked data set: pair comparison, agreement of flags, logs."""

from __future__ import annotations

import io
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skyledger.operators.temporal import keep_first

# Variables that each rule's flag concerns.
RULE_VARIABLES = {
    "zscore_td": ["td"], "zscore_rh": ["rh", "rhmax", "rhmin"], "zscore_prcp": ["prcp"], "zscore_wind": ["wind"], "td_exceeds_tmin_daily": ["td", "tmin"],
    "stuck_sensor": ["tmax", "tmin", "td", "rh", "wind", "prcp", "rsds"], "rs_period_ratio": ["rsds"],
}
W_M2_TO_MJ = 0.0864
CORRECTED = {"rsds": "rsds_corrected"}


def compare(ours: DataFrame, theirs: DataFrame, *, keys: list[str], variables: list[str]) -> DataFrame:
    """Long rows (keys, variable, ours, theirs, reasons, flagged, removed) of keys in both tables.  reasons: those of our
    row that concern the variable; removed: their value is missing where ours is not."""
    rules = F.create_map(*(x for v in variables for x in (F.lit(v), F.array(*(F.lit(r) for r, vs in RULE_VARIABLES.items() if v in vs)).cast("array<string>"))))
    a = ours.select(*keys, F.coalesce("qc_reason_codes", F.lit("")).alias("all_reasons"), *(F.col(v).alias(f"__a_{v}") for v in variables))
    b = theirs.select(*keys, *(F.col(v).alias(f"__b_{v}") for v in variables))
    cells = F.array(*(F.struct(F.lit(v).alias("variable"), F.col(f"__a_{v}").cast("double").alias("ours"), F.col(f"__b_{v}").cast("double").alias("theirs")) for v in variables))
    both = a.join(b, keys).select(*keys, "all_reasons", F.inline(cells))  # joined wide, then made long
    mine = F.filter(F.split("all_reasons", ","), lambda r: F.array_contains(rules[F.col("variable")], r))
    return both.select(*keys, "variable", "ours", "theirs", F.array_join(mine, ",").alias("reasons"), (F.size(mine) > 0).alias("flagged"), (F.col("ours").isNotNull() & F.col("theirs").isNull()).alias("removed"))


def flag_agreement(compared: DataFrame) -> DataFrame:
    """Confusion counts of each rule and variable, our flag against their removal, and their shares: fp_rate of our flags,
    fn_rate of their removals."""
    pairs = [(r, v) for r, vs in RULE_VARIABLES.items() for v in vs]
    rules = compared.sparkSession.createDataFrame(pairs, "rule string, variable string")
    rows = compared.join(F.broadcast(rules), "variable")  # a fixed table of a few rows
    hit = F.array_contains(F.split("reasons", ","), F.col("rule"))
    count = lambda c: F.sum(F.when(c, 1).otherwise(0)).cast("long")
    out = rows.groupBy("rule", "variable").agg(count(hit & F.col("removed")).alias("tp"), count(hit & ~F.col("removed")).alias("fp"), count(~hit & F.col("removed")).alias("fn"), count(~hit & ~F.col("removed")).alias("tn"))
    div = lambda a, b: F.try_divide(a.cast("double"), b.cast("double"))
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    out = out.withColumns({"precision": div(tp, tp + fp), "recall": div(tp, tp + fn), "fp_rate": div(fp, tp + fp), "fn_rate": div(fn, tp + fn)})
    return out


def correction_agreement(compared: DataFrame, *, keys: list[str], corrected: dict[str, str] = CORRECTED, most: float = 100.0) -> DataFrame:
    """Of rows where both sides have a raw and a corrected value (ours within ``most``): how far our corrections are from
    theirs.  (variable, n, mean_their_correction, mean_our_correction, correction_bias, correction_mae, correction_corr)."""
    raw = F.col("variable")
    pick = lambda v, c: F.max(F.when(raw == v, F.col(c)))
    parts = []
    for v, fixed in corrected.items():
        wide = compared.where(raw.isin(v, fixed) & (F.abs("ours") <= most)).groupBy(*keys)
        wide = wide.agg(pick(v, "ours").alias("a"), pick(fixed, "ours").alias("b"), pick(v, "theirs").alias("c"), pick(fixed, "theirs").alias("d")).where("a is not null and b is not null and c is not null and d is not null")
        mine, other = F.col("b") - F.col("a"), F.col("d") - F.col("c")
        parts.append(wide.groupBy().agg(
            F.count(F.lit(1)).alias("n"), F.avg(other).alias("mean_their_correction"), F.avg(mine).alias("mean_our_correction"), F.avg(mine - other).alias("correction_bias"),
            F.avg(F.abs(mine - other)).alias("correction_mae"), F.corr(other, mine).alias("correction_corr"),
        ).where("n > 0").select(F.lit(v).alias("variable"), "*"))
    return reduce(DataFrame.unionByName, parts)


def normalize_checked(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """A checked station's daily rows under our names: dates, radiation from W/m2 to MJ/m2, the first row of each date in
    the file's order (row_no)."""
    names = {a.lower(): b for a, b in columns.items()}
    kept = {names[c.lower()]: F.col(f"`{c}`").cast("double") for c in df.columns if c.lower() in names}
    rows = df.select("station", "row_no", F.to_date("date").alias("date"), *(c * W_M2_TO_MJ if v in ("rsds", "rsds_corrected") else c for v, c in ((v, c.alias(v)) for v, c in kept.items())))
    rows = rows.toDF("station", "row_no", "date", *kept)
    return keep_first(rows.where("date is not null"), ["station", "date"], ["row_no"]).drop("row_no")


def load_excel(spark: SparkSession, path: str, columns: dict[str, str]) -> DataFrame:
    """Checked workbooks under a path (decoder: pandas with an Excel engine, optional), one file at a time on executors."""
    names = sorted(columns)
    fields = "station string, row_no long, date timestamp, " + ", ".join(f"`{n}` double" for n in names)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for at, content in zip(frame["path"], frame["content"]):
                book = pd.read_excel(io.BytesIO(content), parse_dates=["Date"]).rename(columns={"Date": "date"})
                station = at.rsplit("/", 1)[-1].removesuffix(".xlsx").removesuffix("_data")
                yield book.reindex(columns=["date", *names]).assign(station=station, row_no=range(len(book)))[["station", "row_no", "date", *names]]

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.xlsx").load(path).select("path", "content")
    return normalize_checked(files.mapInPandas(run, fields), columns)


# What the lines of a correction log say.
LOG_SECTION = r"(?i)Now correcting (.+?) (?:and|at) "
LOG_ZSCORE = r"(\d+) outliers were removed on variable (\w+)"
LOG_INTERVAL = r"Selected correction interval started at (\d+) and ended at (\d+)"
LOG_NULLED = r"Observations within the interval were set to nan"
LOG_PERIOD = r"period length was (\d+), and correction sample size was (\d+)"
LOG_DESPIKED = r"(\d+) data points were removed as part of the despiking process"
LOG_CLIPPED = r"(\d+) Rs data points were clipped to"
LOG_HUMIDITY = r"(?i)Year-based RH correction.*RHMax had (\d+) points exceed 100.*RHMin had (\d+) points"
LOG_MISSING = r"had (\d+) missing date entries"


def parse_log(lines: DataFrame) -> DataFrame:
    """Rows (path, line_no, line) of correction logs to events (path, line_no, kind, section, variable, a, b).

    A line is of the first kind that it matches; a section heading holds for the lines below it.  Selected intervals count
    as ``nulled`` where the next heading or notice after them is that observations were set to nan.
    """
    kinds = {"section": LOG_SECTION, "zscore": LOG_ZSCORE, "interval": LOG_INTERVAL, "null": LOG_NULLED, "period": LOG_PERIOD, "despiked": LOG_DESPIKED, "clipped": LOG_CLIPPED, "humidity": LOG_HUMIDITY}
    kind = F.lit(None).cast("string")
    for k, pattern in reversed(kinds.items()):
        kind = F.when(F.col("line").rlike(pattern), k).otherwise(kind)
    rows = lines.withColumns({"kind": kind, "missing": F.nullif(F.regexp_extract("line", LOG_MISSING, 1), F.lit(""))}).where("kind is not null or missing is not null")
    order = Window.partitionBy("path").orderBy("line_no")
    before, after = order.rowsBetween(Window.unboundedPreceding, Window.currentRow), order.rowsBetween(1, Window.unboundedFollowing)
    head = F.when(F.col("kind") == "section", F.trim(F.regexp_extract("line", LOG_SECTION, 1)))
    then = F.first(F.when(F.col("kind").isin("section", "null"), F.col("kind")), ignorenulls=True).over(after)
    rows = rows.withColumns({"section": F.coalesce(F.last(head, ignorenulls=True).over(before), F.lit("unknown")), "then": then})

    def part(k: int) -> Column:
        found = F.lit(None).cast("long")
        for name, pattern in kinds.items():
            if name in ("section", "null") or (k == 2 and name in ("zscore", "despiked", "clipped")):
                continue
            found = F.when(F.col("kind") == name, F.regexp_extract("line", pattern, k).try_cast("long")).otherwise(found)
        return found

    variable = F.when(F.col("kind") == "zscore", F.regexp_extract("line", LOG_ZSCORE, 2)).when(F.col("kind") == "interval", F.col("section"))
    events = rows.select("path", "line_no", F.when((F.col("kind") == "interval") & F.col("then").eqNullSafe(F.lit("null")), "nulled").otherwise(F.col("kind")).alias("kind"), "section", variable.alias("variable"), part(1).alias("a"), part(2).alias("b"))
    missing = rows.where("missing is not null").select("path", "line_no", F.lit("missing").alias("kind"), "section", F.lit(None).cast("string").alias("variable"), F.col("missing").cast("long").alias("a"), F.lit(None).cast("long").alias("b"))
    return events.where("kind is not null").unionByName(missing)


def flatten_log(events: DataFrame, variables: list[str]) -> DataFrame:
    """One row per log: counts (0 where there are none), the last period and sample size, and zscore_{variable}."""
    kind = F.col("kind")
    total = lambda k, c: F.coalesce(F.sum(F.when(kind == k, F.col(c))), F.lit(0)).cast("long")
    last = lambda c: F.coalesce(F.max_by(c, F.when(kind == "period", F.col("line_no"))), F.lit(0)).cast("long")
    removed = lambda v: F.coalesce(F.sum(F.when((kind == "zscore") & (F.lower("variable") == v.lower()), F.col("a"))), F.lit(0)).cast("long")
    return events.groupBy("path").agg(
        F.coalesce(F.min_by("a", F.when(kind == "missing", F.col("line_no"))), F.lit(0)).cast("long").alias("missing_dates"), last("a").alias("rs_period"), last("b").alias("rs_sample_size"),
        total("despiked", "a").alias("rs_despiked"), total("clipped", "a").alias("rs_clipped"), total("humidity", "a").alias("rh_rhmax_exceed_100"), total("humidity", "b").alias("rh_rhmin_exceed_100"),
        F.count(F.when(kind == "nulled", 1)).alias("manual_nulled_count"), *(removed(v).alias(f"zscore_{v.lower()}") for v in variables),
    )


def comparison_set(pairs: DataFrame, ours: DataFrame, theirs: DataFrame, *, variables: list[str]) -> DataFrame:
    """The compared cells of all pairs (station, station_key): theirs (station, date, variables) against ours
    (station_key, date, variables, qc_state, qc_reason_codes) on common dates.  One join, no loop over pairs."""
    named = pairs.select("station", "station_key").distinct()
    mine = ours.join(named, "station_key")
    other = theirs.join(named, "station")
    for t, df in (("ours", ours), ("theirs", theirs)):
        if missing := [v for v in variables if v not in df.columns]:
            add = {v: F.lit(None).cast("double") for v in missing}
            mine, other = (mine.withColumns(add), other) if t == "ours" else (mine, other.withColumns(add))
    return compare(mine, other, keys=["station", "station_key", "date"], variables=variables)


def run_validation(pairs: DataFrame, ours: DataFrame, theirs: DataFrame, out: str, *, variables: list[str], logs: DataFrame | None = None) -> dict[str, int | str]:
    """Writes the comparison set (Parquet), the flag agreement and the correction comparison (CSV) and the log summary
    (Parquet) under ``out``; says how much there is, or that there is nothing."""
    spark = pairs.sparkSession
    comparison_set(pairs, ours, theirs, variables=variables).write.mode("overwrite").parquet(f"{out}/comparison_dataset")
    compared = spark.read.parquet(f"{out}/comparison_dataset")
    rows, stations = compared.agg(F.count(F.lit(1)), F.count_distinct("station", "station_key")).first()
    if not rows:
        return {"status": "empty"}
    agreement = flag_agreement(compared).orderBy(F.desc_nulls_last("fp_rate"), "rule", "variable")
    agreement.coalesce(1).write.mode("overwrite").csv(f"{out}/flag_agreement_by_rule", header=True)  # a row for each rule and variable
    corrections = correction_agreement(compared, keys=["station", "station_key", "date"])
    corrections.coalesce(1).write.mode("overwrite").csv(f"{out}/correction_comparison", header=True)
    if logs is not None:
        flatten_log(parse_log(logs), variables).write.mode("overwrite").parquet(f"{out}/log_summary")
    return {"status": "ok", "pairs_compared": stations, "total_rows": rows, "flag_agreement_rows": agreement.count(), "correction_rows": corrections.count(), "outputs": out}
