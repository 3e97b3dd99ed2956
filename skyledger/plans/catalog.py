"""The engine's queries over the stand-in tables, each with the SQL that gives the same rows.

``events`` stands for hourly observations (user_id: station, ts: time, value: reading, event_type: variable or source,
props: native flags), ``orders`` and ``lineitem`` for daily series, ``customer`` and ``supplier`` for two networks whose
places follow from their keys.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.functions import columns as C
from skyledger.functions import units
from skyledger.functions.humidity import compile_humidity
from skyledger.operators import corrections, crosswalk, daily, diagnostics, fabric, manifest, por, rules, temporal, validation
from skyledger.plans import registry
from skyledger.plans.registry import query, r6, read
from skyledger.sources import readers

def hourly(spark: SparkSession, d: str, *, temperature: bool = True) -> DataFrame:
    """events as wide hourly rows; the reading becomes a temperature of -40..~58."""
    e = read(spark, d, "events")
    return e.select(
        F.concat(F.lit("ev:"), F.col("user_id").cast("string")).alias("station_key"), F.col("ts").cast("timestamp").alias("datetime_utc"), F.col("event_type").alias("source"),
        "user_id", "event_id", "value", (F.col("value") / 5 - 40).alias("tair"), F.get_json_object("props", "$.k").cast("int").alias("k"),
    )


_YN = "CASE WHEN {0} THEN 'Y' ELSE 'N' END"
_COVER = (
    "concat('n=', count(*), ',thresh=', " + _YN.format("count(DISTINCT hour(ts)) >= 18") + ", ',am=', " + _YN.format("count(DISTINCT CASE WHEN hour(ts) BETWEEN 6 AND 11 THEN hour(ts) END) >= 4")
    + ", ',pm=', " + _YN.format("count(DISTINCT CASE WHEN hour(ts) BETWEEN 12 AND 17 THEN hour(ts) END) >= 4") + ")"
)


@query(f"""SELECT 'ev:' || user_id AS station_key, CAST(ts AS DATE) AS date, CAST(count(*) AS INTEGER) AS obs_count, {_COVER} AS coverage_flags,
  round(max(value / 5 - 40), 6) AS tmax, round(min(value / 5 - 40), 6) AS tmin, round(avg(value / 5 - 40), 6) AS tmean FROM events GROUP BY user_id, CAST(ts AS DATE)""")
def daily_coverage(spark: SparkSession, d: str) -> DataFrame:
    out = daily.aggregate_daily_wide(hourly(spark, d).drop("source"), source="madis")
    return out.select("station_key", "date", "obs_count", "coverage_flags", *(r6(c).alias(c) for c in ("tmax", "tmin", "tmean")))


@query("""SELECT 'ev:' || user_id AS station_key, CAST(ts AS DATE) AS date,
  round(((degrees(atan2(avg(sin(radians(value % 360))), avg(cos(radians(value % 360))))) % 360) + 360) % 360, 5) AS wind_dir FROM events GROUP BY ALL""")
def circular_mean(spark: SparkSession, d: str) -> DataFrame:
    rows = hourly(spark, d).select("station_key", "datetime_utc", (F.col("value") % 360).alias("wind_dir"))
    return daily.aggregate_daily_wide(rows, source="madis").select("station_key", "date", F.round("wind_dir", 5).alias("wind_dir"))


@query("""WITH s AS (SELECT user_id, ts, value - lag(value) OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_id) AS step FROM events)
SELECT 'ev:' || user_id AS station_key, CAST(ts AS DATE) AS date, round(sum(CASE WHEN step > 0 THEN step ELSE 0 END), 6) AS prcp FROM s GROUP BY ALL""")
def precipitation_increments(spark: SparkSession, d: str) -> DataFrame:
    rows = hourly(spark, d).withColumn("date", F.to_date("datetime_utc"))
    steps = daily.accumulate_increments(rows, "value", ["station_key", "date"], ["datetime_utc", "event_id"])
    return steps.groupBy("station_key", "date").agg(r6(F.sum("value")).alias("prcp"))


@query("""SELECT event_type AS variable, CAST(ts AS DATE) AS date, round(CASE event_type WHEN 'click' THEN max(value) WHEN 'view' THEN min(value) WHEN 'purchase' THEN sum(value) ELSE avg(value) END, 6) AS value,
  count(*) AS obs_count FROM events GROUP BY event_type, CAST(ts AS DATE)""")
def daily_long(spark: SparkSession, d: str) -> DataFrame:
    names = {"click": "tmax", "view": "tmin", "purchase": "prcp"}
    v = F.col("source")
    named = F.coalesce(*(F.when(v == a, b) for a, b in names.items()), v)
    out = daily.aggregate_daily_long(hourly(spark, d).select(F.lit("all").alias("station_key"), named.alias("variable"), "datetime_utc", "value"))
    back = F.coalesce(*(F.when(F.col("variable") == b, a) for a, b in names.items()), F.col("variable"))
    return out.select(back.alias("variable"), "date", r6("value").alias("value"), "obs_count")


@query("""WITH q AS (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events),
s AS (SELECT *, CASE WHEN k % 7 = 0 THEN 2 WHEN k % 5 = 0 THEN 1 ELSE 0 END AS rk, CASE WHEN k % 7 = 0 THEN 'k7' WHEN k % 5 = 0 THEN 'k5' END AS reason FROM q),
o AS (SELECT user_id, CAST(ts AS DATE) AS date, reason, min(ts) AS first FROM s WHERE reason IS NOT NULL GROUP BY ALL), l AS (SELECT user_id, date, string_agg(reason, ',' ORDER BY first) AS reasons FROM o GROUP BY ALL),
f AS (SELECT user_id, CAST(ts AS DATE) AS date, max(rk) AS rk FROM s GROUP BY ALL)
SELECT 'ev:' || f.user_id AS station_key, f.date, CASE rk WHEN 2 THEN 'fail' WHEN 1 THEN 'suspect' ELSE 'pass' END AS qc_state, coalesce(reasons, '') AS qc_reasons FROM f LEFT JOIN l ON l.user_id = f.user_id AND l.date = f.date""")
def daily_qc_rollup(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("k")
    rows = hourly(spark, d).withColumns({"qc_state": F.when(k % 7 == 0, "fail").when(k % 5 == 0, "suspect").otherwise("pass"), "qc_reason_codes": F.when(k % 7 == 0, "k7").when(k % 5 == 0, "k5").otherwise("")})
    out = daily.aggregate_daily_wide(rows.drop("source"), source="madis")
    return out.select("station_key", "date", "qc_state", F.col("qc_reason_codes").alias("qc_reasons"))


@query("""WITH m AS (SELECT *, median(value) OVER (PARTITION BY event_type, month(ts)) AS med, count(*) OVER (PARTITION BY event_type, month(ts)) AS n FROM events),
a AS (SELECT *, median(abs(value - med)) OVER (PARTITION BY event_type, month(ts)) AS mad FROM m),
z AS (SELECT *, CASE WHEN n >= 90 AND mad > 0 THEN 0.6745 * abs(value - med) / mad END AS z FROM a)
SELECT event_id, round(z, 6) AS value_z, CASE WHEN z > 7 THEN 'fail' WHEN z > 3.5 THEN 'suspect' ELSE 'pass' END AS value_state FROM z""")
def monthly_zscore(spark: SparkSession, d: str) -> DataFrame:
    out = temporal.monthly_zscore(hourly(spark, d), "value", keys=["source"], date="datetime_utc")
    return out.select("event_id", r6("value_z").alias("value_z"), "value_state")


@query("""WITH l AS (SELECT *, epoch_us(ts) - epoch_us(lag(ts) OVER w) AS b, epoch_us(lead(ts) OVER w) - epoch_us(ts) AS a FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT event_id, coalesce(coalesce(b > 21600000000, true) AND coalesce(a > 21600000000, true) AND (a IS NOT NULL OR b IS NOT NULL), false) AS isolated FROM l""")
def isolated_observations(spark: SparkSession, d: str) -> DataFrame:
    return temporal.isolated(hourly(spark, d), keys=["station_key"], ts="datetime_utc", tie=["event_id"]).select("event_id", "isolated")


@query("""WITH v AS (SELECT event_id, user_id, ts, CAST(floor(value / 60) AS BIGINT) AS x FROM events), l AS (SELECT * FROM v WHERE x <> 0),
c AS (SELECT *, CASE WHEN x = lag(x) OVER w THEN 0 ELSE 1 END AS new FROM l WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
r AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS run FROM c),
n AS (SELECT event_id, count(*) OVER (PARTITION BY user_id, run) AS n FROM r)
SELECT v.event_id, n.n AS run_length, CASE WHEN n.n >= 4 THEN 'suspect' ELSE 'pass' END AS run_length_state FROM v LEFT JOIN n USING (event_id)""")
def stuck_sensor(spark: SparkSession, d: str) -> DataFrame:
    rows = hourly(spark, d).withColumn("x", F.floor(F.col("value") / 60))
    return temporal.stuck(rows, "x", keys=["station_key"], order=["datetime_utc", "event_id"], least=4).select("event_id", "run_length", "run_length_state")


@query("""WITH s AS (SELECT event_id, value - lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS v FROM events)
SELECT event_id, round(CASE WHEN v >= 0 THEN v END, 6) AS step FROM s""")
def cumulative_steps(spark: SparkSession, d: str) -> DataFrame:
    return temporal.increments(hourly(spark, d), "value", keys=["station_key"], order=["datetime_utc", "event_id"]).select("event_id", r6("value").alias("step"))


@query("""SELECT event_id, user_id, ts FROM (SELECT *, row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_id) AS n FROM events) WHERE n = 1""")
def keep_first(spark: SparkSession, d: str) -> DataFrame:
    rows = read(spark, d, "events").withColumn("day", F.to_date("ts"))
    return temporal.keep_first(rows, ["user_id", "day"], ["ts", "event_id"]).select("event_id", "user_id", "ts")


@query("""WITH x AS (SELECT o_custkey AS station, CAST(o_orderdate AS DATE) AS date, o_orderkey, year(o_orderdate) AS y, (o_totalprice / 5000) AS rh FROM orders),
a AS (SELECT *, count(*) OVER (PARTITION BY station) AS total, count(*) OVER (PARTITION BY station, y) AS n, row_number() OVER (PARTITION BY station, y ORDER BY rh DESC, o_orderkey) AS rk FROM x),
t AS (SELECT *, avg(CASE WHEN rk <= greatest(1, ceil(n * 0.01)) THEN rh END) OVER (PARTITION BY station, y) AS top FROM a)
SELECT o_orderkey, round(CASE WHEN total >= 5 AND top > 0 THEN least(greatest(rh * 100 / top, 0), 100) ELSE rh END, 6) AS rh_corrected FROM t""")
def humidity_correction(spark: SparkSession, d: str) -> DataFrame:
    o = read(spark, d, "orders").select(F.col("o_custkey").alias("station_key"), F.col("o_orderdate").alias("date"), "o_orderkey", (F.col("o_totalprice") / 5000).alias("rh"))
    return temporal.rh_correction(o, "rh", keys=["station_key"], least=5).select("o_orderkey", r6("rh_corrected").alias("rh_corrected"))


@query("""WITH b AS (SELECT event_id, user_id, value / 5 - 40 AS tair, value / 4 - 50 AS td, value / 3 - 10 AS rh FROM events),
c AS (SELECT *, (user_id & 115) <> 0 AS bad, tair < -90 OR tair > 60 AS t1, td < -100 OR td > 50 AS d1, td > tair + 0.5 AS d2, rh < 0 OR rh > 100 AS h1 FROM b)
SELECT event_id, CASE WHEN bad OR t1 THEN 'fail' ELSE 'pass' END AS tair_qc_state, CASE WHEN d1 OR d2 THEN 'fail' ELSE 'pass' END AS td_qc_state, CASE WHEN h1 THEN 'fail' ELSE 'pass' END AS rh_qc_state,
  CASE WHEN bad OR t1 OR d1 OR d2 OR h1 THEN 'fail' ELSE 'pass' END AS qc_state,
  array_to_string(list_filter([CASE WHEN bad THEN 'tair:qcr_reject' END, CASE WHEN t1 THEN 'tair:out_of_bounds' END, CASE WHEN d1 THEN 'td:out_of_bounds' END, CASE WHEN d2 THEN 'td:td_exceeds_tair' END, CASE WHEN h1 THEN 'rh:out_of_bounds' END], lambda x: x IS NOT NULL), ',') AS qc_reason_codes FROM c""")
def qc_pipeline(spark: SparkSession, d: str) -> DataFrame:
    v = F.col("value")
    rows = hourly(spark, d).select("event_id", (v / 5 - 40).alias("tair"), (v / 4 - 50).alias("td"), (v / 3 - 10).alias("rh"), F.lit("V").alias("temperatureDD"), F.lit("S").alias("dewpointDD"), F.lit("C").alias("relHumidityDD"), F.col("user_id").alias("temperatureQCR"))
    out = rules.apply_pipeline(rows, rules.default_pipeline("madis"), source="madis")
    return out.select("event_id", "tair_qc_state", "td_qc_state", "rh_qc_state", "qc_state", "qc_reason_codes")


@query("""WITH q AS (SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) % 8 AS c, event_type AS dd FROM events)
SELECT event_id, CASE WHEN c <= 2 THEN 'pass' WHEN c = 3 THEN 'suspect' ELSE 'fail' END AS gdas_state, CASE WHEN c = 3 THEN 'qm_suspect' WHEN c >= 4 THEN 'qm_rejected_reject_level' || (c - 3) END AS gdas_reason,
  CASE WHEN c IN (1, 5) THEN 'pass' ELSE 'fail' END AS isd_state, CASE WHEN dd IN ('click', 'view') THEN 'pass' ELSE 'fail' END AS dd_state FROM q""")
def native_flags(spark: SparkSession, d: str) -> DataFrame:
    rows = hourly(spark, d).select("event_id", "value", (F.col("k") % 8).alias("c"), "source")
    v = F.col("value")
    g = rules.gdas_marker().check(v, "tair", {"temperature_qm": F.col("c")})
    i = rules.isd_quality().check(v, "tair", {"tair_qc": F.col("c")})
    m = rules.madis_descriptor(("click", "view")).check(v, "tair", {"temperatureDD": F.col("source")})
    return rows.select("event_id", C.state_of(g[0]).alias("gdas_state"), g[1].alias("gdas_reason"), C.state_of(i[0]).alias("isd_state"), C.state_of(m[0]).alias("dd_state"))


@query("""WITH b AS (SELECT event_id, value / 5 - 40 AS t, value / 3 AS rh, 'p' AS s FROM events)
SELECT event_id, 'tair' AS variable, round(t, 6) AS value, 'degC' AS unit FROM b UNION ALL SELECT event_id, 'rh', round(rh, 6), 'percent' FROM b""")
def wide_to_long(spark: SparkSession, d: str) -> DataFrame:
    rows = hourly(spark, d).withColumns({"rh": F.col("value") / 3, "ingest_run_id": F.col("event_id")})
    long = readers.to_long(rows, ["tair", "rh"])
    return long.select(F.col("ingest_run_id").alias("event_id"), "variable", r6("value").alias("value"), "unit")


@query("""SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, round((value - 32.0) * (5.0 / 9.0), 6) AS f_to_c, round(value * 0.44704, 6) AS mph_to_ms, round(value * 3386.389, 6) AS inhg_to_pa FROM events""")
def unit_conversion(spark: SparkSession, d: str) -> DataFrame:
    r, v = units.default_registry(), F.col("value")
    e = read(spark, d, "events")
    return e.select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"), r6(r.convert(v, "tair", "degF")).alias("f_to_c"), r6(r.convert(v, "wind", "mph")).alias("mph_to_ms"), r6(r.convert(v, "psfc", "inHg")).alias("inhg_to_pa"))


_ES = "0.6108 * exp(17.27 * {0} / ({0} + 237.3))"


@query(f"""WITH b AS (SELECT event_id, value / 10 AS tmax, value / 20 AS tmin, CASE WHEN user_id % 3 = 0 THEN value / 5 END AS rh FROM events),
e AS (SELECT event_id, coalesce(rh / 100 * ({_ES.format('tmax')} + {_ES.format('tmin')}) / 2, {_ES.format('tmin')}) AS ea FROM b)
SELECT event_id, round(ea, 6) AS ea, round((116.91 + 237.3 * ln(ea)) / (16.78 - ln(ea)), 5) AS td FROM e""")
def humidity(spark: SparkSession, d: str) -> DataFrame:
    v = F.col("value")
    rows = read(spark, d, "events").select("event_id", (v / 10).alias("tmax"), (v / 20).alias("tmin"), F.when(F.col("user_id") % 3 == 0, v / 5).alias("rh"))
    return compile_humidity(rows).select("event_id", r6("ea_compiled").alias("ea"), F.round("td_compiled", 5).alias("td"))


@query("""WITH s AS (SELECT s_suppkey, s_suppkey % 65 AS lat, 10.0 * (s_suppkey % 30) AS z FROM supplier), d AS (SELECT *, unnest(range(1, 366)) AS j FROM s),
p AS (SELECT *, radians(lat) AS phi, 1 + 0.033 * cos(2 * pi() / 365 * j) AS dr, 0.409 * sin(2 * pi() / 365 * j - 1.39) AS dl FROM d),
w AS (SELECT *, acos(least(greatest(-tan(phi) * tan(dl), -1), 1)) AS ws FROM p)
SELECT 'sup:' || s_suppkey AS station_key, CAST(j AS INTEGER) AS doy, round((0.75 + 2e-5 * z) * 24 / pi() * 4.92 * dr * (ws * sin(phi) * sin(dl) + cos(phi) * cos(dl) * sin(ws)), 5) AS rso FROM w""")
def clear_sky_radiation(spark: SparkSession, d: str) -> DataFrame:
    s = read(spark, d, "supplier").select(F.concat(F.lit("sup:"), F.col("s_suppkey").cast("string")).alias("station_key"), (F.col("s_suppkey") % 65).cast("double").alias("lat"), (F.lit(10.0) * (F.col("s_suppkey") % 30)).alias("elev_m"))
    return temporal.clear_sky_table(s).select("station_key", "doy", F.round("rso", 5).alias("rso"))


_PLACES = {"customer": ("c_custkey", 37, 53), "supplier": ("s_suppkey", 41, 59)}


def network(spark: SparkSession, d: str, name: str, *, gap: float = 0.011) -> DataFrame:
    key, a, b = _PLACES[name]
    k = F.col(key)
    return read(spark, d, name).select(k.alias("id"), (F.lit(40.0) + (k % a) * gap).alias("lat"), (F.lit(-100.0) + (k % b) * gap).alias("lon"))


_NETS = """c AS (SELECT c_custkey AS id, 40.0 + (c_custkey % 37) * 0.011 AS lat, -100.0 + (c_custkey % 53) * 0.011 AS lon FROM customer),
s AS (SELECT s_suppkey AS id, 40.0 + (s_suppkey % 41) * 0.011 AS lat, -100.0 + (s_suppkey % 59) * 0.011 AS lon FROM supplier)"""
_HAV = "2 * 6371000.0 * asin(sqrt(least(power(sin((radians(s.lat) - radians(c.lat)) / 2), 2) + cos(radians(c.lat)) * cos(radians(s.lat)) * power(sin(radians(s.lon - c.lon) / 2), 2), 1.0)))"


@query(f"""WITH {_NETS}, p AS (SELECT c.id AS lid, s.id AS rid, {_HAV} AS m FROM c JOIN s ON abs(c.lat - s.lat) < 0.02 AND abs(c.lon - s.lon) < 0.02),
n AS (SELECT *, row_number() OVER (PARTITION BY lid ORDER BY m, rid) AS k FROM p WHERE m <= 1000)
SELECT lid, rid, round(m, 4) AS distance_m FROM n WHERE k = 1""")
def nearest_station(spark: SparkSession, d: str) -> DataFrame:
    left, right = network(spark, d, "customer").withColumnRenamed("id", "lid"), network(spark, d, "supplier").withColumnRenamed("id", "rid")
    return crosswalk.nearest_within(left, right).select("lid", "rid", F.round("distance_m", 4).alias("distance_m"))


@query(f"""WITH {_NETS}, g AS (SELECT 'ghcnh' AS source, CAST(id AS VARCHAR) AS sid, lat, lon FROM s UNION ALL SELECT 'ghcnd', CAST(id AS VARCHAR), lat, lon FROM s WHERE id % 2 = 0),
p AS (SELECT 'ghcn:' || sid AS rid, median(lat) AS lat, median(lon) AS lon FROM g GROUP BY sid),
d AS (SELECT 'madis:' || c.id AS k, s.rid, {_HAV} AS m FROM c JOIN p s ON abs(c.lat - s.lat) < 0.02 AND abs(c.lon - s.lon) < 0.02),
n AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY m, rid) AS i FROM d WHERE m <= 1000) WHERE i = 1)
SELECT source || ':' || sid AS source_station_key, 'ghcn:' || sid AS canonical_station_id, 'exact_match' AS confidence, 0.0 AS distance_m FROM g
UNION ALL SELECT 'madis:' || c.id, coalesce(n.rid, 'madis:' || c.id), CASE WHEN n.rid IS NULL THEN 'no_match' ELSE 'probable_match' END, round(n.m, 4) FROM c LEFT JOIN n ON n.k = 'madis:' || c.id""")
def station_crosswalk(spark: SparkSession, d: str) -> DataFrame:
    s, c = (network(spark, d, n).withColumns({"source_station_id": F.col("id").cast("string"), "elev_m": F.lit(None).cast("double")}) for n in ("supplier", "customer"))
    index = s.withColumn("source", F.lit("ghcnh")).union(s.where("id % 2 = 0").withColumn("source", F.lit("ghcnd"))).union(c.withColumn("source", F.lit("madis")))
    return crosswalk.build_crosswalk(index).select("source_station_key", "canonical_station_id", "confidence", F.round("distance_m", 4).alias("distance_m"))


@query("""SELECT event_type AS source, CAST(user_id AS VARCHAR) AS source_station_id, median(value) AS lat, count(*) AS n_obs, min(ts) AS por_start, max(ts) AS por_end FROM events GROUP BY ALL""")
def station_index(spark: SparkSession, d: str) -> DataFrame:
    e = read(spark, d, "events")
    rows = e.select(F.col("event_type").alias("source"), F.col("user_id").cast("string").alias("source_station_id"), F.lit("k").alias("station_key"), F.col("value").alias("lat"), F.lit(0.0).alias("lon"), F.lit(0.0).alias("elev_m"), F.col("ts").alias("datetime_utc"))
    return crosswalk.station_index(rows).select("source", "source_station_id", "lat", F.col("obs_count").alias("n_obs"), "por_start", "por_end")


@query("""WITH b AS (SELECT user_id, CAST(ts AS DATE) AS date, value, CASE event_type WHEN 'view' THEN 0 WHEN 'purchase' THEN 1 WHEN 'click' THEN 2 END AS r, event_type AS s, user_id % 11 = 0 AND event_type = 'view' AS bad FROM events),
x AS (SELECT *, row_number() OVER (PARTITION BY user_id, date ORDER BY r, value) AS n FROM b WHERE r IS NOT NULL AND NOT bad), k AS (SELECT DISTINCT user_id, date FROM b)
SELECT k.user_id, k.date, round(x.value, 6) AS tmax, coalesce(x.s, '') AS tmax_source, CAST(CASE WHEN x.s IS NULL THEN 0 ELSE 1 END AS INTEGER) AS n_sources FROM k LEFT JOIN x ON x.user_id = k.user_id AND x.date = k.date AND x.n = 1""")
def precedence_fabric(spark: SparkSession, d: str) -> DataFrame:
    rows = hourly(spark, d).select("user_id", F.to_date("datetime_utc").alias("date"), "source", F.col("value").alias("tmax"), F.when((F.col("user_id") % 11 == 0) & (F.col("source") == "view"), "fail").otherwise("pass").alias("tmax_qc_state"))
    out = fabric.apply_precedence(rows, {"tmax": ["view", "purchase", "click"]}, keys=["user_id", "date"])
    return out.select("user_id", "date", r6("tmax").alias("tmax"), "tmax_source", "n_sources")


@query("""SELECT l_suppkey AS station_key, CAST(month(l_shipdate) AS INTEGER) AS month, round(avg(l_extendedprice) / nullif(avg(l_quantity), 0), 6) AS factor, count(*) AS n FROM lineitem GROUP BY ALL""")
def correction_factors(spark: SparkSession, d: str) -> DataFrame:
    rows = read(spark, d, "lineitem")
    key = ["station_key", "row"]
    obs = rows.select(F.col("l_suppkey").alias("station_key"), F.struct("l_orderkey", "l_linenumber", F.col("l_shipdate").alias("at")).alias("row"), F.col("l_extendedprice").alias("v"), F.col("l_shipdate").alias("date"))
    base = rows.select(F.col("l_suppkey").alias("station_key"), F.struct("l_orderkey", "l_linenumber", F.col("l_shipdate").alias("at")).alias("row"), F.col("l_quantity").alias("v"), F.col("l_shipdate").alias("date"))
    out = corrections.monthly_factors(obs, base, variable="v", keys=["station_key"], match=key)
    return out.select("station_key", "month", r6("factor").alias("factor"), "n")


@query("""WITH x AS (SELECT value AS a, value * (1 - (user_id % 10) / 100.0) AS b FROM events)
SELECT 'tmax' AS variable, count(*) AS n, round(avg(a), 4) AS mean_raw, round(avg(b), 4) AS mean_fixed, round(avg(b - a), 4) AS bias, round(avg(abs(b - a)), 4) AS mae, round(corr(a, b), 6) AS corr FROM x""")
def correction_statistics(spark: SparkSession, d: str) -> DataFrame:
    rows = read(spark, d, "events")
    a = rows.select("event_id", F.col("value").alias("tmax"))
    b = rows.select("event_id", (F.col("value") * (1 - (F.col("user_id") % 10) / 100.0)).alias("tmax"))
    out = corrections.correction_comparison(a, b, keys=["event_id"], variables=["tmax"])
    return out.select("variable", "n", *(F.round(c, 4).alias(c) for c in ("mean_raw", "mean_fixed", "bias", "mae")), r6("corr").alias("corr"))


@query("""WITH b AS (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events), f AS (SELECT user_id % 13 = 0 AS removed, k % 4 = 0 AS a, k % 6 = 0 AS t FROM b),
c AS (SELECT 'zscore_td' AS rule, 'td' AS variable, a AS hit, removed FROM f UNION ALL SELECT 'td_exceeds_tmin_daily', 'td', t, removed FROM f UNION ALL SELECT 'stuck_sensor', 'td', false, removed FROM f),
n AS (SELECT rule, variable, CAST(sum(CASE WHEN hit AND removed THEN 1 ELSE 0 END) AS BIGINT) AS tp, CAST(sum(CASE WHEN hit AND NOT removed THEN 1 ELSE 0 END) AS BIGINT) AS fp, CAST(sum(CASE WHEN NOT hit AND removed THEN 1 ELSE 0 END) AS BIGINT) AS fn, CAST(sum(CASE WHEN NOT hit AND NOT removed THEN 1 ELSE 0 END) AS BIGINT) AS tn FROM c GROUP BY ALL)
SELECT *, round(tp / nullif(tp + fp, 0), 6) AS "precision", round(tp / nullif(tp + fn, 0), 6) AS recall, round(fp / nullif(tp + fp, 0), 6) AS fp_rate, round(fn / nullif(fn + tp, 0), 6) AS fn_rate FROM n""")
def flag_agreement(spark: SparkSession, d: str) -> DataFrame:
    rows = hourly(spark, d)
    why = C.join_reasons(F.when(F.col("k") % 4 == 0, "zscore_td"), F.when(F.col("k") % 6 == 0, "td_exceeds_tmin_daily"), F.lit("zscore_wind"))
    ours = rows.select("event_id", F.col("value").alias("td"), why.alias("qc_reason_codes"))
    theirs = rows.select("event_id", F.when(F.col("user_id") % 13 != 0, F.col("value")).alias("td"))
    out = validation.flag_agreement(validation.compare(ours, theirs, keys=["event_id"], variables=["td"]))
    return out.select("rule", "variable", "tp", "fp", "fn", "tn", *(r6(c).alias(c) for c in ("precision", "recall", "fp_rate", "fn_rate")))


_STATE = "CASE event_type WHEN 'view' THEN 'done' WHEN 'click' THEN 'failed' ELSE 'skipped' END"


def _log(spark: SparkSession, d: str) -> DataFrame:
    t = F.col("event_type")
    return read(spark, d, "events").select(F.lit("madis").alias("source"), F.col("user_id").cast("string").alias("key"), F.when(t == "view", "done").when(t == "click", "failed").otherwise("skipped").alias("state"), F.col("ts").alias("updated_utc"), F.col("event_id").cast("string").alias("run_id"))


@query(f"""WITH x AS (SELECT user_id, {_STATE} AS state, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, {_STATE} DESC, CAST(event_id AS VARCHAR) DESC) AS n FROM events)
SELECT state, count(*) AS n FROM x WHERE n = 1 GROUP BY state""")
def manifest_summary(spark: SparkSession, d: str) -> DataFrame:
    return manifest.summary(_log(spark, d)).select("state", "n")


@query(f"""WITH x AS (SELECT user_id, {_STATE} AS state, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, {_STATE} DESC, CAST(event_id AS VARCHAR) DESC) AS n FROM events)
SELECT CAST(c_custkey AS VARCHAR) AS key FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM x WHERE n = 1 AND state = 'done')""")
def manifest_pending(spark: SparkSession, d: str) -> DataFrame:
    keys = read(spark, d, "customer").select(F.lit("madis").alias("source"), F.col("c_custkey").cast("string").alias("key"))
    return manifest.pending(keys, _log(spark, d)).select("key")


@query("""SELECT event_id FROM events WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-11' AND value >= 100 AND value < 300""")
def box_and_dates(spark: SparkSession, d: str) -> DataFrame:
    from datetime import date

    rows = read(spark, d, "events").withColumn("lon", F.lit(0.0))
    rows = por.in_dates(rows, "ts", date(2024, 1, 5), date(2024, 1, 10))
    return readers.in_bounds(rows, -1, 100, 1, 300, lat="value", lon="lon").select("event_id")


@query("""SELECT event_type AS variable, CAST(user_id % 7 AS VARCHAR) AS source, count(*) AS n, count(DISTINCT user_id) AS stations FROM events GROUP BY ROLLUP (event_type, CAST(user_id % 7 AS VARCHAR)) HAVING event_type IS NOT NULL""")
def coverage_rollup(spark: SparkSession, d: str) -> DataFrame:
    e = read(spark, d, "events")
    kinds = [r[0] for r in e.select("event_type").distinct().orderBy("event_type").collect()]  # a handful of variables
    rows = e.select((F.col("user_id") % 7).cast("string").alias("source"), F.col("user_id").alias("station_key"), *(F.when(F.col("event_type") == k, F.col("value")).alias(k) for k in kinds))
    return diagnostics.coverage(rows, kinds).select("variable", "source", "n", "stations")


@query("""SELECT event_type AS source, count(*) AS n, round(avg(CASE WHEN user_id % 5 > 1 THEN 1.0 ELSE 0.0 END), 6) AS pass_rate, round(avg(CASE WHEN user_id % 5 = 1 THEN 1.0 ELSE 0.0 END), 6) AS suspect_rate, round(avg(CASE WHEN user_id % 5 = 0 THEN 1.0 ELSE 0.0 END), 6) AS fail_rate FROM events GROUP BY event_type""")
def qc_rates(spark: SparkSession, d: str) -> DataFrame:
    m = F.col("user_id") % 5
    out = diagnostics.qc_rates(hourly(spark, d).withColumn("qc_state", F.when(m == 0, "fail").when(m == 1, "suspect").otherwise("pass")), ["source"])
    return out.select("source", "n", *(r6(c).alias(c) for c in ("pass_rate", "suspect_rate", "fail_rate")))


@query(f"""WITH {_NETS}, m AS (SELECT c.id, s.id AS rid, {_HAV} AS m FROM c JOIN s ON abs(c.lat - s.lat) < 0.02 AND abs(c.lon - s.lon) < 0.02),
n AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY m, 'ghcn:' || rid) AS i FROM m WHERE m <= 1000) WHERE i = 1),
k AS (SELECT 'ghcnh:' || id AS k, id AS canonical, id, lat, lon FROM s UNION ALL SELECT 'madis:' || c.id, n.rid, c.id, c.lat, c.lon FROM c JOIN n USING (id)),
v AS (SELECT *, (id % 7) * 20.0 AS z, DATE '2020-01-01' + CAST(id % 400 AS INTEGER) AS f FROM k),
p AS (SELECT c.k AS a, s.k AS b, {_HAV} AS m, CAST(abs(c.z - s.z) AS DOUBLE) AS elev_diff, 500 - abs(date_diff('day', c.f, s.f)) AS days FROM v AS c JOIN v AS s ON c.canonical = s.canonical AND c.k < s.k)
SELECT a AS source_station_key_a, b AS source_station_key_b, round(m, 4) AS distance_m, elev_diff, CAST(days AS INTEGER) AS overlap_days FROM p WHERE m <= 900 AND elev_diff <= 50 AND days >= 365""")
def closest_station_pairs(spark: SparkSession, d: str) -> DataFrame:
    s, c = (network(spark, d, n).withColumns({"source_station_id": F.col("id").cast("string"), "elev_m": F.col("id") % 7 * F.lit(20.0)}) for n in ("supplier", "customer"))
    index = s.withColumn("source", F.lit("ghcnh")).union(c.withColumn("source", F.lit("madis")))
    start = F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 400).cast("int"))
    spans = index.select(F.concat_ws(":", "source", "source_station_id").alias("station_key"), start.alias("por_start"), F.date_add(start, 500).alias("por_end"))
    pairs = crosswalk.candidate_pairs(crosswalk.build_crosswalk(index), spans, most_m=900.0, most_elev=50.0, least_days=365)
    return pairs.select("source_station_key_a", "source_station_key_b", F.round("distance_m", 4).alias("distance_m"), "elev_diff", "overlap_days")


@query("""WITH b AS (SELECT user_id, ts, value / 5 - 40 AS tair, CASE WHEN user_id % 17 = 0 AND value > 300 THEN 'fail' ELSE 'pass' END AS q FROM events),
k AS (SELECT user_id, CAST(ts AS DATE) AS date, tair FROM b WHERE q <> 'fail'),
d AS (SELECT user_id, date, count(*) AS n, avg(tair) AS t FROM k GROUP BY ALL), s AS (SELECT *, count(CASE WHEN n >= 4 THEN 1 END) OVER (PARTITION BY user_id) AS days FROM d)
SELECT 'ev:' || user_id AS station_key, date, CAST(n AS INTEGER) AS obs_count, round(t, 6) AS tmean FROM s WHERE days >= 2""")
def station_por(spark: SparkSession, d: str) -> DataFrame:
    rows = hourly(spark, d).select("station_key", "datetime_utc", "tair", F.lit("pass").alias("qc_state"), F.when((F.col("user_id") % 17 == 0) & (F.col("value") > 300), "fail").otherwise("pass").alias("tair_qc_state"))
    done = por.build_station_por(rows, source="eccc", min_por_days=2)
    return done.series.select("station_key", "date", "obs_count", r6("tmean").alias("tmean"))


@query("""WITH b AS (SELECT *, CASE user_id % 4 WHEN 0 THEN 999 WHEN 1 THEN NULL ELSE value END AS v FROM events)
SELECT event_id, CASE WHEN v IS NULL OR v IN (99, 999, 9999) THEN 'fail' ELSE 'pass' END AS state, CASE WHEN v IS NULL THEN 'value_none' WHEN v IN (99, 999, 9999) THEN 'sentinel_detected' END AS reason FROM b""")
def sentinel_values(spark: SparkSession, d: str) -> DataFrame:
    m = F.col("user_id") % 4
    rows = read(spark, d, "events").select("event_id", F.when(m == 0, 999.0).when(m == 1, None).otherwise(F.col("value")).alias("v"))
    rank, reason = rules.sentinel().check(F.col("v"), "v", {})
    return rows.select("event_id", C.state_of(rank).alias("state"), reason.alias("reason"))


@query("""SELECT event_id, CASE WHEN value / 4 > value / 5 + 5 + 3.0 THEN 'fail' ELSE 'pass' END AS td_state FROM events""")
def dewpoint_against_minimum(spark: SparkSession, d: str) -> DataFrame:
    v = F.col("value")
    return read(spark, d, "events").select("event_id", temporal.dewpoint_daily(v / 4, v / 5 + 5).alias("td_state"))


@query("""WITH b AS (SELECT event_id, CASE WHEN value + 200 BETWEEN 223.15 AND 333.15 AND event_type <> 'view' AND (user_id & 115) = 0 THEN value + 200 END AS t,
  CASE WHEN value / 10 BETWEEN 0 AND 35 THEN value / 10 END AS w FROM events)
SELECT event_id, round(t, 6) AS temperature, round(w, 6) AS wind_speed, t IS NOT NULL OR w IS NOT NULL AS qc_passed FROM b""")
def extract_qc(spark: SparkSession, d: str) -> DataFrame:
    e, v = read(spark, d, "events"), F.col("value")
    flag = F.when(F.col("event_type") == "view", "Q").otherwise("V")
    rows = e.select("event_id", (v + 200).alias("temperature"), flag.alias("temperatureDD"), F.col("user_id").alias("temperatureQCR"), (v / 10).alias("windSpeed"))
    return rules.madis_extract_qc(rows).select("event_id", r6("temperature").alias("temperature"), r6("windSpeed").alias("wind_speed"), "qc_passed")


@query("""SELECT event_id, CASE WHEN CAST(json_extract_string(props, '$.k') AS INTEGER) % 8 IN (1, 5) THEN value END AS tair FROM events""")
def quality_code_mask(spark: SparkSession, d: str) -> DataFrame:
    rows = hourly(spark, d).select("event_id", F.col("value").alias("tair"), (F.col("k") % 8).alias("tair_qc"))
    return rules.isd_mask(rows, ["tair"]).select("event_id", "tair")


@query("""WITH x AS (SELECT o_custkey AS station_key, year(o_orderdate) AS y, o_orderkey, o_totalprice / 5000 AS rh FROM orders),
a AS (SELECT *, count(*) OVER (PARTITION BY station_key) AS total, count(*) OVER (PARTITION BY station_key, y) AS n, row_number() OVER (PARTITION BY station_key, y ORDER BY rh DESC, o_orderkey) AS rk FROM x),
t AS (SELECT *, avg(CASE WHEN rk <= greatest(1, ceil(n * 0.01)) THEN rh END) OVER (PARTITION BY station_key, y) AS top FROM a),
f AS (SELECT station_key, count(*) AS n, avg(CASE WHEN total >= 5 AND top > 0 THEN least(greatest(rh * 100 / top, 0), 100) ELSE rh END / rh) AS factor FROM t GROUP BY station_key)
SELECT station_key, round(factor, 6) AS factor, CASE WHEN n < 5 THEN 'pass' WHEN greatest(factor, 1 / factor) >= 1.15 THEN 'fail' WHEN greatest(factor, 1 / factor) >= 1.05 THEN 'suspect' ELSE 'pass' END AS state FROM f""")
def humidity_drift(spark: SparkSession, d: str) -> DataFrame:
    o = read(spark, d, "orders").select(F.col("o_custkey").alias("station_key"), F.col("o_orderdate").alias("date"), (F.col("o_totalprice") / 5000).alias("rh"))
    return temporal.rh_drift(o, "rh", keys=["station_key"], least=5).select("station_key", r6("factor").alias("factor"), "state")


@query("""SELECT user_id % 50 AS station_key, CAST(ts AS DATE) AS date, arg_min(value, event_id) FILTER (WHERE event_type = 'view') AS tair, arg_min(value, event_id) FILTER (WHERE event_type = 'click') AS td FROM events GROUP BY ALL""")
def stitch_cycles(spark: SparkSession, d: str) -> DataFrame:
    t, v = F.col("event_type"), F.col("value")
    rows = read(spark, d, "events").select((F.col("user_id") % 50).alias("station_key"), F.date_trunc("day", "ts").alias("datetime_utc"), F.col("event_id").alias("cycle"), F.when(t == "view", v).alias("tair"), F.when(t == "click", v).alias("td"))
    return temporal.prepare_gdas(rows).select("station_key", F.to_date("datetime_utc").alias("date"), "tair", "td")


@query("""WITH s AS (SELECT 'sup:' || s_suppkey AS station_key, s_suppkey % 3 = 0 AS has, CAST(s_suppkey % 120 AS DOUBLE) AS lat, CASE WHEN s_suppkey % 7 <> 0 THEN 2000.0 * (s_suppkey % 6) END AS z FROM supplier),
r AS (SELECT *, CASE WHEN has THEN NULL WHEN z IS NULL THEN 'missing_lat_or_elev' WHEN lat > 90 THEN 'invalid_lat' WHEN z > 9000 THEN 'invalid_elev_m' END AS reason FROM s)
SELECT station_key, CASE WHEN has THEN 'raster' WHEN reason IS NULL THEN 'asce' END AS method, reason FROM r""")
def radiation_source(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("s_suppkey")
    s = read(spark, d, "supplier").select(k, F.concat(F.lit("sup:"), k.cast("string")).alias("station_key"), (k % 120).alias("lat"), F.when(k % 7 != 0, 2000.0 * (k % 6)).alias("elev_m"))
    return temporal.resolve_rso(s, temporal.raster_table(s.where("s_suppkey % 3 = 0").select("station_key", F.lit(1).alias("doy"), F.lit(5000.0).alias("value"))))


@query("""WITH b AS (SELECT o_orderkey, month(o_orderdate) AS m, o_custkey % 2 AS k, o_totalprice / 500 AS prcp, (o_totalprice / 100000) * (o_totalprice / 100000) AS td FROM orders),
m AS (SELECT *, median(td) OVER (PARTITION BY k, m) AS med, count(*) OVER (PARTITION BY k, m) AS n FROM b), a AS (SELECT *, median(abs(td - med)) OVER (PARTITION BY k, m) AS mad FROM m),
z AS (SELECT *, coalesce(CASE WHEN n >= 90 AND mad > 0 THEN 0.6745 * abs(td - med) / mad END, 0) AS z FROM a)
SELECT o_orderkey, CASE WHEN z > 7 OR prcp > 610 THEN 'fail' WHEN z > 3.5 THEN 'suspect' ELSE 'pass' END AS qc_state,
  array_to_string(list_filter([CASE WHEN z > 3.5 THEN 'zscore_td' END, CASE WHEN prcp > 610 THEN 'prcp_exceeds_daily_max' END], lambda x: x IS NOT NULL), ',') AS qc_reason_codes FROM z""")
def tier2_checks(spark: SparkSession, d: str) -> DataFrame:
    x = F.col("o_totalprice") / 100000
    rows = read(spark, d, "orders").select("o_orderkey", (F.col("o_custkey") % 2).alias("station_key"), F.col("o_orderdate").alias("date"), (F.col("o_totalprice") / 500).alias("prcp"), (x * x).alias("td"))
    return temporal.tier2(rows, ["td", "prcp"]).select("o_orderkey", "qc_state", "qc_reason_codes")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from skyledger.plans import feeds, products  # noqa: F401  they register their queries

    return dict(registry.QUERIES)


def oracle_sql() -> dict[str, str]:
    queries()
    return dict(registry.SQL)
