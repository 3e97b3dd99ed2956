"""Station index and identity across networks."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skyledger.functions import columns as C
from skyledger.operators.footers import file_statistics

GHCN = ("ghcnh", "ghcnd")


# Sources of daily and of hourly rows.
RESOLUTION = {"daily": ("ghcnd", "raws_wrcc"), "hourly": ("ghcnh", "isd", "snotel", "eccc", "ndbc", "madis", "gdas")}


def temporal_res(source: Column, default: str = "unknown") -> Column:
    known = [F.when(source.isin(*names), kind) for kind, names in RESOLUTION.items()]
    return F.coalesce(*known, F.lit(default))


def station_index(rows: DataFrame, *, ts: str = "datetime_utc", resolution: str = "unknown") -> DataFrame:
    """One row per source and station: median coordinates, first and last time, row count, resolution (for sources that
    are not known: as given)."""
    out = rows.groupBy("source", "source_station_id").agg(
        F.min("station_key").alias("canonical_id"), F.median("lat").alias("lat"), F.median("lon").alias("lon"), F.median("elev_m").alias("elev_m"),
        F.min(ts).alias("por_start"), F.max(ts).alias("por_end"), F.count(F.lit(1)).alias("obs_count"),
    )
    return out.withColumn("temporal_res", temporal_res(F.col("source"), resolution))


def build_station_index(tables: dict[str, DataFrame], *, exclude: tuple[str, ...] = ("isd",)) -> DataFrame:
    parts = [station_index(df if "source" in df.columns else df.withColumn("source", F.lit(s)), ts="datetime_utc" if "datetime_utc" in df.columns else "date") for s, df in tables.items() if s not in exclude]
    parts = [p.withColumns({"por_start": F.col("por_start").cast("timestamp"), "por_end": F.col("por_end").cast("timestamp")}) for p in parts]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def cell(c: Column, degrees: float) -> Column:
    return F.floor(c / degrees).cast("long")


def near_pairs(left: DataFrame, right: DataFrame, *, degrees: float = 0.02, most_m: float = 1000.0, by_latitude: bool = False) -> DataFrame:
    """Pairs (lid, rid, distance_m) within a box of ``degrees`` and within ``most_m`` metres.

    left (lid, lat, lon) and right (rid, lat, lon) meet on grid cells: the left side looks into its own and the eight
    cells around, so the join is an equi-join whatever the sizes, instead of a comparison of all with all.
    ``by_latitude`` widens the box in longitude as meridians converge.
    """
    l = left.where("lat is not null and lon is not null").select("lid", F.col("lat").alias("la"), F.col("lon").alias("lo"))
    r = right.where("lat is not null and lon is not null").select("rid", F.col("lat").alias("ra"), F.col("lon").alias("ro"))
    wide = F.lit(degrees) / F.greatest(F.cos(F.radians(F.col("la"))), F.lit(0.01)) if by_latitude else F.lit(degrees)
    reach = F.ceil(wide / degrees).cast("int") if by_latitude else F.lit(1)
    l = l.withColumn("gy", F.explode(F.sequence(cell(F.col("la"), degrees) - 1, cell(F.col("la"), degrees) + 1)))
    l = l.withColumn("gx", F.explode(F.sequence(cell(F.col("lo"), degrees) - reach, cell(F.col("lo"), degrees) + reach)))
    r = r.withColumns({"gy": cell(F.col("ra"), degrees), "gx": cell(F.col("ro"), degrees)})
    d = C.haversine(F.col("la"), F.col("lo"), F.col("ra"), F.col("ro"))
    box = (F.abs(F.col("la") - F.col("ra")) < degrees) & (F.abs(F.col("lo") - F.col("ro")) < wide)
    return l.join(r, ["gy", "gx"]).where(box).withColumn("distance_m", d).where(F.col("distance_m") <= most_m).select("lid", "rid", "distance_m")


def nearest(pairs: DataFrame) -> DataFrame:
    """The nearest right of each left; ties go to the smaller right."""
    best = F.min(F.struct("distance_m", "rid")).alias("b")
    return pairs.groupBy("lid").agg(best).select("lid", F.col("b.rid").alias("rid"), F.col("b.distance_m").alias("distance_m"))


def nearest_within(left: DataFrame, right: DataFrame, **how) -> DataFrame:
    """``nearest`` of ``near_pairs``, by places: stations of one place have one answer, and of the right stations of a place
    only the smallest can be it, so no join grows with the stations that share a place or a cell."""
    at = left.where("lat is not null and lon is not null").select("lid", "lat", "lon")
    spots = right.where("lat is not null and lon is not null").groupBy("lat", "lon").agg(F.min("rid").alias("rid"))
    places = at.select("lat", "lon").distinct().select(F.struct("lat", "lon").alias("lid"), "lat", "lon")
    best = nearest(near_pairs(places, spots, **how)).select("lid.lat", "lid.lon", "rid", "distance_m")
    return nearest(at.join(best, ["lat", "lon"]))


def build_crosswalk(index: DataFrame, *, degrees: float = 0.02, most_m: float = 1000.0) -> DataFrame:
    """Canonical ids: stations of the two GHCN sources share theirs by id, others take the nearest GHCN station's
    within reach, and the rest keep their own."""
    base = index.select(F.concat_ws(":", "source", "source_station_id").alias("source_station_key"), "source", "source_station_id", "lat", "lon", "elev_m")
    ghcn = base.where(F.col("source").isin(*GHCN)).withColumn("canonical_station_id", F.concat(F.lit("ghcn:"), F.element_at(F.split("source_station_id", ":"), -1)))
    exact = ghcn.withColumns({"confidence": F.lit("exact_match"), "match_method": F.lit("ghcn_id"), "distance_m": F.lit(0.0)})
    places = ghcn.groupBy(F.col("canonical_station_id").alias("rid")).agg(F.median("lat").alias("lat"), F.median("lon").alias("lon"))
    others = base.where(~F.col("source").isin(*GHCN))
    found = nearest_within(others.select(F.col("source_station_key").alias("lid"), "lat", "lon"), places, degrees=degrees, most_m=most_m)
    rest = others.join(found, others.source_station_key == found.lid, "left").drop("lid")
    hit = F.col("rid").isNotNull()
    rest = rest.withColumns({
        "canonical_station_id": F.coalesce("rid", "source_station_key"), "confidence": F.when(hit, "probable_match").otherwise("no_match"),
        "match_method": F.when(hit, "proximity").otherwise("none"),
    }).drop("rid")
    cols = ["source_station_key", "source", "source_station_id", "lat", "lon", "elev_m", "canonical_station_id", "confidence", "match_method", "distance_m"]
    return exact.select(cols).unionByName(rest.select(cols))


PART = 1000  # stations of one canonical id that one task holds against all of that id


def candidate_pairs(crosswalk: DataFrame, overlap: DataFrame, *, most_m: float, most_elev: float, least_days: int, limit: int | None = None, digits: int = 6) -> DataFrame:
    """Pairs of stations of one canonical id by distance, elevation (known of both) and days in common; the ``limit`` closest.

    Periods are joined to stations, never to pairs.  Pairs are made where an id's stations meet, in parts of some PART by all,
    and no shuffle or sort sees a pair but those that stay and, under a limit, not even these.
    """
    spark = crosswalk.sparkSession
    o = overlap.select(F.col("station_key").alias("source_station_key"), F.col("por_start").alias("from"), F.col("por_end").alias("to"))
    stations = crosswalk.select("source_station_key", "lat", "lon", "elev_m", "canonical_station_id").where("elev_m is not null").join(o, "source_station_key")
    if limit is not None:
        # Stations alike in all but the key pair alike, so of these only the limit + 1 smallest keys can be in the closest pairs: were
        # the greater key of a pair behind them, limit smaller ones at least would pair with the other station in its stead.
        alike = Window.partitionBy("canonical_station_id", "lat", "lon", "elev_m", "from", "to").orderBy("source_station_key")
        stations = stations.withColumn("__n", F.dense_rank().over(alike)).where(F.col("__n") <= limit + 1).drop("__n")
    parts = stations.groupBy("canonical_station_id").agg(F.ceil(F.count(F.lit(1)) / PART).cast("int").alias("__parts"))
    stations = stations.join(parts, "canonical_station_id")
    part = {"a": F.pmod(F.xxhash64("source_station_key"), F.col("__parts")).cast("int"), "b": F.explode(F.sequence(F.lit(0), F.col("__parts") - 1))}
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))  # a number of them, as their work follows the pairs and not the bytes
    a, b = (
        stations.select(*(F.col(c).alias(f"{c}_{s}") for c in ("source_station_key", "lat", "lon", "elev_m", "from", "to")), "canonical_station_id", part[s].alias("__part")).repartition(tasks, "canonical_station_id", "__part")
        for s in ("a", "b")
    )
    distance, elev = C.haversine(F.col("lat_a"), F.col("lon_a"), F.col("lat_b"), F.col("lon_b")), F.abs(F.col("elev_m_a") - F.col("elev_m_b"))
    days = F.greatest(F.datediff(F.least("to_a", "to_b"), F.greatest("from_a", "from_b")), F.lit(0))
    pairs = a.join(b, ["canonical_station_id", "__part"]).where((F.col("source_station_key_a") < F.col("source_station_key_b")) & (elev <= most_elev) & (days >= least_days) & (distance <= most_m))
    out = pairs.drop("__part").withColumns({"distance_m": distance, "elev_diff": elev, "overlap_days": days})
    if limit is None:
        return out
    # Equal distances differ in their last bits: ties go by the keys from ``digits`` places on.
    return out.orderBy(F.round("distance_m", digits), "source_station_key_a", "source_station_key_b").limit(limit)


def sampled(names: list[str], most: int) -> list[str]:
    """At most so many of the sorted names, evenly spread from the first to the last."""
    names = sorted(names)
    return [names[k] for k in sampled_places(len(names), most)]


def sampled_places(n: int, most: int) -> list[int]:
    return list(range(n)) if n <= most else [k * (n - 1) // (most - 1) if most > 1 else 0 for k in range(most)]


def sampled_days(rows: DataFrame, most: int, *, ts: str = "datetime_utc") -> DataFrame:
    """Rows of at most so many UTC days, evenly spread from the first to the last, as in ``sampled``."""
    day = F.to_date(ts)
    days = rows.select(day.alias("__day")).distinct()
    days = days.withColumns({"__n": F.row_number().over(Window.orderBy("__day")) - 1, "__all": F.count(F.lit(1)).over(Window.partitionBy())})  # one row a day
    # The k-th of the sample is the floor(k*(n-1)/(most-1))-th day.
    k = F.ceil(F.col("__n") * (most - 1) / (F.col("__all") - 1))
    hit = (F.col("__all") <= most) | (F.floor(k * (F.col("__all") - 1) / (most - 1)) == F.col("__n"))
    return rows.withColumn("__day", day).join(F.broadcast(days.where(hit).select("__day")), "__day", "left_semi").drop("__day")  # at most ``most`` rows


def index_per_day_source(rows: DataFrame, *, sample_days: int | None = None) -> DataFrame:
    """The index of a source with one file a day, over all its days, each station with its own period.  sample_days: coordinates
    and counts from so many days, and one period for all stations, from the first to the last time of the first and the last day."""
    if sample_days is None:
        return station_index(rows, resolution="hourly")
    some = sampled_days(rows, sample_days)
    first, last = some.agg(F.min("datetime_utc"), F.max("datetime_utc")).first()
    return _of_period(station_index(some, resolution="hourly"), first, last)


def _of_period(index: DataFrame, first: datetime | None, last: datetime | None) -> DataFrame:
    return index.withColumns({"por_start": F.lit(first).cast("timestamp"), "por_end": F.lit(last).cast("timestamp")})


def index_of_day_files(spark: SparkSession, root: str, *, sample_files: int = 30) -> DataFrame:
    """The same from the Parquet files themselves: names are listed, ``sample_files`` of them are read, and the period comes from
    the statistics in the first and the last file's footer."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(root).select("path")
    ranks = listed.where("path not like '%/manifest.parquet'").withColumn("n", F.row_number().over(Window.orderBy("path")) - 1)  # a name a day
    n = ranks.count()
    if not n:
        raise ValueError(f"no files under {root}")
    places = sampled_places(n, sample_files)
    names = {r.n: r.path for r in ranks.where(F.col("n").isin(places)).collect()}
    ends = [file_statistics(spark, names[k], "datetime_utc").first() for k in (0, n - 1)]
    rows = spark.read.parquet(*names.values())
    return _of_period(station_index(rows, resolution="hourly"), ends[0] and ends[0].low, ends[1] and ends[1].high)
