"""Monthly correction factors and comparison statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def monthly_factors(obs: DataFrame, baseline: DataFrame, *, variable: str, keys: list[str], date: str = "date", method: str = "ratio", match: list[str] | None = None) -> DataFrame:
    """(keys, month, factor, n): of days in both tables, mean over mean ("ratio", null where the base is 0) or mean
    less mean ("difference"), by calendar month.  ``match`` names further columns by which rows are paired."""
    if method not in ("ratio", "difference"):
        raise ValueError(f"unknown method {method!r}")
    on = list(dict.fromkeys([*keys, date, *(match or [])]))
    both = obs.select(*on, F.col(variable).alias("o")).join(baseline.select(*on, F.col(variable).alias("b")), on)
    o, b = F.avg("o"), F.avg("b")
    factor = F.try_divide(o, b) if method == "ratio" else o - b
    return both.groupBy(*keys, F.month(date).alias("month")).agg(factor.alias("factor"), F.count(F.lit(1)).alias("n"))


def paired(a: DataFrame, b: DataFrame, keys: list[str], variables: list[str], left: str, right: str) -> DataFrame:
    """(keys, variable, left, right) of the cells that both tables have: joined wide on the keys, then made long."""
    x, y = (t.select(*keys, *(F.col(v).cast("double").alias(f"__{n}_{v}") for v in variables)) for t, n in ((a, "a"), (b, "b")))
    cells = F.array(*(F.struct(F.lit(v).alias("variable"), F.col(f"__a_{v}").alias(left), F.col(f"__b_{v}").alias(right)) for v in variables))
    return x.join(y, keys).select(*keys, F.inline(cells)).where(F.col(left).isNotNull() & F.col(right).isNotNull())


def correction_comparison(raw: DataFrame, fixed: DataFrame, *, keys: list[str], variables: list[str], most_rsds: float = 100.0) -> DataFrame:
    """(variable, n, mean_raw, mean_fixed, bias, mae, corr) over rows in both tables; radiation beyond the cap is left out."""
    both = paired(raw, fixed, keys, variables, "raw", "fixed")
    both = both.where((F.col("variable") != "rsds") | ((F.abs("raw") <= most_rsds) & (F.abs("fixed") <= most_rsds)))
    d = F.col("fixed") - F.col("raw")
    return both.groupBy("variable").agg(
        F.count(F.lit(1)).alias("n"), F.avg("raw").alias("mean_raw"), F.avg("fixed").alias("mean_fixed"), F.avg(d).alias("bias"), F.avg(F.abs(d)).alias("mae"), F.corr("raw", "fixed").alias("corr")
    )
