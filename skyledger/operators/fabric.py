"""Observation fabric: cell-by-cell merge of sources under an order of precedence, with each cell's source."""

from __future__ import annotations

import tomllib
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger import schema
from skyledger.operators import tables
from skyledger.operators.por import bucket
from skyledger.operators.tables import BUCKETS


def load_precedence(path: str | None = None) -> dict[str, dict[str, list[str]]]:
    """The default order, or a TOML file's tables ``hourly`` and ``daily``, by which named variables are replaced."""
    out = {k: dict(v) for k, v in schema.PRECEDENCE.items()}
    if path:
        with open(path, "rb") as f:
            for kind, table in tomllib.load(f).items():
                out.setdefault(kind, {}).update({v: list(s) for v, s in table.items()})
    return out


def canonical_source(c: Column) -> Column:
    out = c
    for a, b in schema.SOURCE_ALIASES.items():
        out = F.when(c == a, b).otherwise(out)
    return out


def _usable(df: DataFrame, v: str) -> Column:
    state = f"{v}_qc_state" if f"{v}_qc_state" in df.columns else "qc_state" if "qc_state" in df.columns else None
    return F.when(F.coalesce(F.col(state), F.lit("pass")) != "fail", F.col(v)) if state else F.col(v)


def apply_precedence(rows: DataFrame, precedence: dict[str, list[str]], *, keys: list[str], tie: list[Column] | None = None) -> DataFrame:
    """Long rows (keys, source, variables, states) to one row per key: each variable's value from the first source
    that has one which did not fail, {var}_source ("" if none), and n_sources.

    One shuffle whatever the number of sources: for each cell the least (rank, tie) of the values present.  ``tie``
    orders rows of one source, such as several stations of it; the value itself is last, so results never vary.
    """
    variables = sorted(v for v in precedence if v in rows.columns)
    aggs = []
    source = canonical_source(F.col("source"))
    for v in variables:
        rank = F.lit(None).cast("int")
        for k, s in reversed(list(enumerate(precedence[v]))):
            rank = F.when(source == s, k).otherwise(rank)
        value = _usable(rows, v).cast("double")
        order = F.struct(rank.alias("r"), *((t.alias(f"t{i}")) for i, t in enumerate(tie or [])), value.alias("v"), source.alias("s"))
        aggs.append(F.min(F.when(value.isNotNull() & rank.isNotNull(), order)).alias(v))
    out = rows.groupBy(*keys).agg(*aggs) if aggs else rows.select(*keys).distinct()
    cells = [c for v in variables for c in (F.col(f"{v}.v").alias(v), F.coalesce(F.col(f"{v}.s"), F.lit("")).alias(f"{v}_source"))]
    used = sum((F.when(F.col(f"{v}.s").isNotNull(), 1).otherwise(0) for v in variables), F.lit(0))
    return out.select(*keys, *cells, used.cast("int").alias("n_sources"))


def name_rows(rows: DataFrame, crosswalk: DataFrame) -> DataFrame:
    """Source rows with their canonical station and their distance from it."""
    ids = crosswalk.select(F.col("source_station_key").alias("station_key"), "canonical_station_id", "distance_m")
    return rows.drop("lat", "lon", "elev_m").join(ids, "station_key")


def colocate(rows: DataFrame, crosswalk: DataFrame, table: str, path: str, *, time: str = "date", buckets: int = BUCKETS) -> DataFrame:
    """Named rows as a table that lies by canonical station, so that fabrics of it, of whatever box, dates and order of
    precedence, are built and joined where the rows lie.  One shuffle, once."""
    return tables.write(name_rows(rows, crosswalk), table, path, "canonical_station_id", sort=(time,), buckets=buckets)


def build_fabric(
    rows: DataFrame, crosswalk: DataFrame, *, precedence: dict[str, list[str]], time: str = "date", bbox: tuple[float, float, float, float] | None = None, start: date | None = None, end: date | None = None
) -> DataFrame:
    """Source rows (station_key, source, time, variables) merged by canonical station.  bbox: west, south, east, north,
    closed.  Of several stations of one source, the one with the least crosswalk distance, then id, comes first.  rows
    may be named already (``colocate``)."""
    x = crosswalk
    if bbox:
        w, s, e, n = bbox
        x = x.where(F.col("lat").between(s, n) & F.col("lon").between(w, e))
    if start:
        rows = rows.where(F.col(time) >= F.lit(start))
    if end:
        rows = rows.where(F.col(time) < F.date_add(F.lit(end).cast("date"), 1))
    place = x.groupBy("canonical_station_id").agg(F.median("lat").alias("lat"), F.median("lon").alias("lon"), F.median("elev_m").alias("elev_m"))
    if "canonical_station_id" in rows.columns:
        named = rows
        if bbox:  # by the canonical station alone, as the rows lie by it; it has few stations
            inside = x.groupBy("canonical_station_id").agg(F.collect_set("source_station_key").alias("__inside"))
            named = rows.join(inside, "canonical_station_id").where(F.array_contains("__inside", F.col("station_key"))).drop("__inside")
    else:
        named = name_rows(rows, x)
    tie = [F.coalesce(F.col("distance_m"), F.lit(1e12)), F.col("station_key")]
    return apply_precedence(named, precedence, keys=["canonical_station_id", time], tie=tie).join(place, "canonical_station_id")


def precedence_audit(fabric: DataFrame) -> DataFrame:
    """(variable, source, n): how often each source gave a cell."""
    names = [c for c in fabric.columns if c.endswith("_source")]
    long = fabric.select(F.explode(F.array(*(F.struct(F.lit(c.removesuffix("_source")).alias("variable"), F.col(c).alias("source")) for c in names))).alias("x")).select("x.*")
    return long.groupBy("variable", "source").agg(F.count(F.lit(1)).alias("n"))


def write_fabric(fabric: DataFrame, path: str, *, table: str | None = None, time: str = "date", buckets: int = BUCKETS) -> None:
    """One folder for each hash bucket of stations, sorted by station; or, with a name, a table that lies by station."""
    if table:
        tables.write(fabric, table, path, "canonical_station_id", sort=(time,), buckets=buckets)
        return
    rows = fabric.withColumn("bucket", bucket(F.col("canonical_station_id"), buckets))
    rows.repartition("bucket").sortWithinPartitions("bucket", "canonical_station_id").write.mode("overwrite").partitionBy("bucket").parquet(path)
