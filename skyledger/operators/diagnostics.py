"""Coverage, latency and quality reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.operators.corrections import paired


def coverage(rows: DataFrame, variables: list[str]) -> DataFrame:
    """(variable, source, n, stations) with totals (null source).  Stations are merged before they are counted, so that
    no task holds all of a source's."""
    long = rows.select("source", "station_key", *variables).unpivot(["source", "station_key"], variables, "variable", "value").where("value is not null")
    each = long.groupBy("variable", "source", "station_key").agg(F.count(F.lit(1)).alias("n"))
    sums = [F.sum("n").alias("n"), F.count(F.lit(1)).alias("stations")]
    total = each.groupBy("variable", "station_key").agg(F.sum("n").alias("n")).groupBy("variable").agg(*sums)
    return each.groupBy("variable", "source").agg(*sums).unionByName(total.withColumn("source", F.lit(None).cast("string")))


def latency(rows: DataFrame, *, now: str | None = None) -> DataFrame:
    """Hours since each source's last observation."""
    at = F.lit(now).cast("timestamp") if now else F.current_timestamp()
    return rows.groupBy("source").agg(F.max("datetime_utc").alias("last_utc"), ((F.unix_seconds(at) - F.unix_seconds(F.max("datetime_utc").cast("timestamp"))) / 3600).alias("hours"))


def qc_rates(rows: DataFrame, by: list[str]) -> DataFrame:
    """Rows and shares of pass, suspect and fail."""
    share = lambda s: F.avg(F.when(F.col("qc_state") == s, 1.0).otherwise(0.0)).alias(f"{s}_rate")
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), share("pass"), share("suspect"), share("fail"))


def precedence_study(a: DataFrame, b: DataFrame, *, keys: list[str], variables: list[str]) -> DataFrame:
    """How two sources differ where both have a value: n, mean difference, mean absolute difference, correlation."""
    both = paired(a, b, keys, variables, "a", "b")
    d = F.col("a") - F.col("b")
    return both.groupBy("variable").agg(F.count(F.lit(1)).alias("n"), F.avg(d).alias("bias"), F.avg(F.abs(d)).alias("mae"), F.corr("a", "b").alias("corr"))
