"""Queries over products: merged fabrics, period-of-record series, identity, reports, contracts, validation."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger import schema
from skyledger.functions import columns as C
from skyledger.functions import units
from skyledger.functions.humidity import compile_humidity
from skyledger.operators import corrections, crosswalk, daily, diagnostics, fabric, por, temporal, update, validation
from skyledger.plans.feeds import _AT, _B, at, base, cols
from skyledger.plans.registry import query, r6, read
from skyledger.sources import readers


@query(f"""WITH {_B}, s AS (SELECT u, date_trunc('hour', ts) AS h, v, e, CASE type WHEN 'view' THEN 1 WHEN 'purchase' THEN 2 WHEN 'click' THEN 0 ELSE 3 END AS r, CASE type WHEN 'view' THEN 'madis' WHEN 'purchase' THEN 'gdas' WHEN 'click' THEN 'ghcnh' ELSE 'eccc' END AS s, k % 9 = 0 AS bad FROM (SELECT *, event_type AS type FROM b)),
x AS (SELECT *, row_number() OVER (PARTITION BY u, h ORDER BY r, v) AS n FROM s WHERE NOT bad), g AS (SELECT DISTINCT u, h FROM s)
SELECT g.u AS station, {_AT.format('g.h')} AS at, x.v AS tair, coalesce(x.s, '') AS tair_source, CAST(CASE WHEN x.s IS NULL THEN 0 ELSE 1 END AS INTEGER) AS n_sources FROM g LEFT JOIN x ON x.u = g.u AND x.h = g.h AND x.n = 1""")
def hourly_precedence(spark: SparkSession, d: str) -> DataFrame:
    """The hourly merge by the default order, with an aliased source and row states."""
    u, e, k, t, v = cols()
    name = F.col("type")
    source = F.when(name == "view", "madis").when(name == "purchase", "gdas_adpsfc").when(name == "click", "ghcnh").otherwise("eccc")
    rows = base(spark, d).select(u.alias("station"), F.date_trunc("hour", "ts").alias("datetime_utc"), source.alias("source"), v.alias("tair"), F.when(k % 9 == 0, "fail").otherwise("pass").alias("qc_state"))
    out = fabric.apply_precedence(rows, fabric.load_precedence()["hourly"], keys=["station", "datetime_utc"])
    return out.select("station", at("datetime_utc").alias("at"), "tair", "tair_source", "n_sources")


@query("""WITH x AS (SELECT 'ghcnd:' || s_suppkey AS key, 'c' || (s_suppkey % 20) AS can, 30.0 + s_suppkey % 20 AS lat, 1.0 * (s_suppkey // 20) AS m FROM supplier UNION ALL SELECT 'snotel:' || s_suppkey, 'c' || (s_suppkey % 20), 30.0 + s_suppkey % 20, 500.0 FROM supplier WHERE s_suppkey % 3 = 0),
r AS (SELECT CASE WHEN event_type = 'view' THEN 'snotel:' ELSE 'ghcnd:' END || (user_id % 100) AS key, CASE WHEN event_type = 'view' THEN 'snotel' ELSE 'ghcnd' END AS source, CAST(ts AS DATE) AS date, max(value) AS tmax FROM events WHERE ts >= TIMESTAMP '2024-01-04' AND ts < TIMESTAMP '2024-01-20' GROUP BY ALL),
j AS (SELECT can, date, tmax, source, key, m FROM r JOIN x USING (key) WHERE lat BETWEEN 33 AND 45),
n AS (SELECT *, row_number() OVER (PARTITION BY can, date ORDER BY CASE source WHEN 'ghcnd' THEN 0 ELSE 1 END, m, key) AS i FROM j)
SELECT can AS canonical_station_id, date, tmax, source AS tmax_source, CAST(30 + CAST(substr(can, 2) AS INTEGER) AS DOUBLE) AS lat FROM n WHERE i = 1""")
def fabric_in_box(spark: SparkSession, d: str) -> DataFrame:
    """The fabric driver: crosswalk, closed box, whole days, several stations of one source, median places."""
    u, e, k, t, v = cols()
    s = F.col("s_suppkey")
    can, lat = F.concat(F.lit("c"), (s % 20).cast("string")), (F.lit(30.0) + s % 20).alias("lat")
    place = lambda n, m: (F.concat(F.lit(f"{n}:"), s.cast("string")).alias("source_station_key"), can.alias("canonical_station_id"), lat, F.lit(5.0).alias("lon"), F.lit(0.0).alias("elev_m"), m.cast("double").alias("distance_m"))
    sup = read(spark, d, "supplier")
    walk = sup.select(*place("ghcnd", F.floor(s / 20))).union(sup.where(s % 3 == 0).select(*place("snotel", F.lit(500))))
    source = F.when(F.col("type") == "view", "snotel").otherwise("ghcnd")
    rows = base(spark, d).select(F.concat_ws(":", source, (u % 100).cast("string")).alias("station_key"), source.alias("source"), F.to_date("ts").alias("date"), v.alias("tmax")).groupBy("station_key", "source", "date").agg(F.max("tmax").alias("tmax"))
    out = fabric.build_fabric(rows, walk, precedence=fabric.load_precedence()["daily"], bbox=(0, 33, 10, 45), start=date(2024, 1, 4), end=date(2024, 1, 19))
    return out.select("canonical_station_id", "date", "tmax", "tmax_source", "lat")


@query("""WITH f AS (SELECT 'view' AS s, count(*) AS n FROM events WHERE event_type = 'view' UNION ALL SELECT 'click', count(*) FROM events WHERE event_type = 'click' AND (user_id, CAST(ts AS DATE)) NOT IN (SELECT user_id, CAST(ts AS DATE) FROM events WHERE event_type = 'view'))
SELECT 'tmax' AS variable, source, count(*) AS n FROM (SELECT user_id, CAST(ts AS DATE) AS d, CASE WHEN bool_or(event_type = 'view') THEN 'view' WHEN bool_or(event_type = 'click') THEN 'click' ELSE '' END AS source FROM events GROUP BY ALL) GROUP BY source""")
def fabric_sources(spark: SparkSession, d: str) -> DataFrame:
    """How often each source gave a cell."""
    u, e, k, t, v = cols()
    rows = base(spark, d).select(u, F.to_date("ts").alias("date"), F.col("type").alias("source"), v.alias("tmax"))
    return fabric.precedence_audit(fabric.apply_precedence(rows, {"tmax": ["view", "click"]}, keys=["u", "date"]))


@query("""SELECT event_type AS source, 'u' || user_id AS key, 'r' || event_id % 3 AS run, count(*) AS n, min(event_id) AS first_id FROM events
WHERE event_id % 3 = CASE WHEN user_id % 4 = 0 THEN 2 WHEN user_id % 3 <> 0 THEN 1 WHEN user_id % 5 <> 0 THEN 0 END GROUP BY ALL""")
def committed_rows(spark: SparkSession, d: str) -> DataFrame:
    """Rows of three runs over each key, of which those of the last run that did it count: later runs failed, or all did."""
    u, e, k, t, v = cols()
    rows = base(spark, d).select(F.col("type").alias("raw_source"), F.concat(F.lit("u"), u.cast("string")).alias("raw_key"), F.concat(F.lit("r"), (e % 3).cast("string")).alias("run"), "e", "u")
    states = F.array(*(F.struct(F.lit(f"r{n}").alias("run_id"), F.lit(n).alias("n"), F.when(good, "done").otherwise("failed").alias("state")) for n, good in enumerate((u % 5 != 0, u % 3 != 0, u % 4 == 0))))
    log = rows.select(F.col("raw_source").alias("source"), F.col("raw_key").alias("key"), "u").distinct().select("source", "key", F.inline(states))
    log = log.select("source", "key", "state", F.timestamp_seconds("n").alias("updated_utc"), "run_id", F.lit("").alias("message"))
    return update.counted(rows, log).groupBy(F.col("raw_source").alias("source"), F.col("raw_key").alias("key"), "run").agg(F.count(F.lit(1)).alias("n"), F.min("e").alias("first_id"))


@query("""SELECT event_type AS source, max(ts) AS last_utc, round((epoch(TIMESTAMP '2024-03-01') - floor(epoch(max(ts)))) / 3600, 6) AS hours FROM events GROUP BY event_type""")
def latency(spark: SparkSession, d: str) -> DataFrame:
    out = diagnostics.latency(base(spark, d).select(F.col("type").alias("source"), F.col("ts").alias("datetime_utc")), now="2024-03-01 00:00:00")
    return out.select("source", F.col("last_utc").cast("timestamp_ntz").alias("last_utc"), r6("hours").alias("hours"))


@query("""WITH a AS (SELECT user_id AS u, CAST(ts AS DATE) AS d, avg(value) AS x, max(value) AS y FROM events WHERE event_type = 'view' GROUP BY ALL), b AS (SELECT user_id AS u, CAST(ts AS DATE) AS d, avg(value) AS x, max(value) AS y FROM events WHERE event_type = 'click' GROUP BY ALL),
j AS (SELECT 'tmean' AS variable, a.x AS p, b.x AS q FROM a JOIN b USING (u, d) UNION ALL SELECT 'tmax', a.y, b.y FROM a JOIN b USING (u, d))
SELECT variable, count(*) AS n, round(avg(p - q), 5) AS bias, round(avg(abs(p - q)), 5) AS mae, round(corr(p, q), 5) AS corr FROM j GROUP BY variable""")
def precedence_study(spark: SparkSession, d: str) -> DataFrame:
    u, e, k, t, v = cols()
    side = lambda s: base(spark, d).where(F.col("type") == s).groupBy("u", F.to_date("ts").alias("date")).agg(F.avg("v").alias("tmean"), F.max("v").alias("tmax"))
    out = diagnostics.precedence_study(side("view"), side("click"), keys=["u", "date"], variables=["tmean", "tmax"])
    return out.select("variable", "n", *(F.round(c, 5).alias(c) for c in ("bias", "mae", "corr")))


@query("""WITH s AS (SELECT user_id % 3 AS s, event_id AS e, CASE WHEN event_id % 40 = 0 THEN 0.0 ELSE value / 25 END AS rs, 8.0 + event_id % 7 AS rso FROM events), o AS (SELECT *, row_number() OVER (PARTITION BY s ORDER BY e) - 1 AS i, max(rso) OVER (PARTITION BY s) AS top, count(*) OVER (PARTITION BY s) AS n FROM s),
c AS (SELECT *, i // 60 AS part, CASE WHEN rs <> 0 AND rs <= 2 * top THEN rs END AS x FROM o), r AS (SELECT *, row_number() OVER (PARTITION BY s, part ORDER BY x / rso DESC NULLS LAST, i) AS k FROM c),
f AS (SELECT *, 1 / avg(CASE WHEN k <= 6 THEN x / rso END) OVER (PARTITION BY s, part) AS f FROM r)
SELECT e, round(f, 6) AS factor, round(CASE WHEN n < 60 THEN rs WHEN f BETWEEN 0.97 AND 1.03 THEN x WHEN f BETWEEN 0.5 AND 1.5 THEN x * f END, 6) AS rs_corrected, CASE WHEN n >= 60 AND x IS NOT NULL AND NOT f BETWEEN 0.5 AND 1.5 AND x > rso THEN 'fail' ELSE 'pass' END AS rs_state FROM f""")
def radiation_period_ratio(spark: SparkSession, d: str) -> DataFrame:
    """Periods of 60 rows with the six largest ratios and limits of the despiking out of reach, so that SQL can say it."""
    u, e, k, t, v = cols()
    rows = base(spark, d).select((u % 3).alias("station_key"), "e", F.when(e % 40 == 0, 0.0).otherwise(v / 25).alias("rsds"), (F.lit(8.0) + e % 7).alias("rso"))
    out = temporal.rs_period_ratio(rows, key="station_key", date="e", change=1e9, most_excess=1e9)
    return out.select("e", r6(F.nullif("rs_period_factor", F.lit(float("nan")))).alias("factor"), r6(F.nullif("rs_corrected", F.lit(float("nan")))).alias("rs_corrected"), "rs_state")


# Series of tier 2 in SQL.  The largest ratios of a period that stay are always the last of their order, so the despiking is the first
# of them from which on their means meet the limits.
_SCORED = ("td", "tmax", "rsds", "rh")
_RUNS = ("td", "tmax", "prcp", "rsds", "rh")
_each = lambda names, text: ", ".join(text.replace("#", n) for n in names)
_SERIES = """d AS (SELECT o_custkey % 2 AS s, CAST(o_orderdate AS DATE) AS date, max(o_totalprice) AS p, max(o_orderkey) AS k FROM orders GROUP BY ALL),
v AS (SELECT s, date, k, (p / 100000) * (p / 100000) + CASE WHEN k % 100 = 0 THEN 40 ELSE 0 END AS td, p / 50000 + 4 AS tmin, CASE WHEN day(date) <= 14 THEN 7.0 WHEN day(date) = 20 THEN 0.0 WHEN day(date) = 21 THEN NULL ELSE day(date) END AS tmax, p / 500 AS prcp,
  20.0 + k % 60 AS rh, 25.0 + k % 60 AS rhmax, CASE WHEN k % 40 = 0 THEN 0.0 ELSE p / CASE year(date) % 4 WHEN 1 THEN 2100 WHEN 2 THEN 900 ELSE 1500 END END AS rsds, 200.0 + 10 * (((dayofyear(date) - 1) % 365 + 1) % 7) AS rso FROM d)"""
_DESPIKED = """o AS (SELECT *, row_number() OVER (PARTITION BY s ORDER BY date) - 1 AS i, max(rso) OVER (PARTITION BY s) AS most, count(*) OVER (PARTITION BY s) AS days FROM v),
c AS (SELECT *, i // 60 AS part, CASE WHEN rsds <> 0 AND rsds <= 2 * most THEN rsds END AS x FROM o), r AS (SELECT *, row_number() OVER (PARTITION BY s, part ORDER BY x / rso DESC NULLS LAST, i) AS place FROM c),
g AS (SELECT s, part, place, avg(x / rso) OVER w AS ratio, avg(x - rso) OVER w AS excess FROM r WHERE place <= 6 AND x IS NOT NULL WINDOW w AS (PARTITION BY s, part ORDER BY place DESC)),
h AS (SELECT *, lead(ratio) OVER (PARTITION BY s, part ORDER BY place) AS after FROM g),
f AS (SELECT s, part, 1 / arg_min(ratio, place) AS f FROM h WHERE after IS NULL OR abs(ratio - after) / greatest(abs(ratio), 1e-12) <= 0.02 AND excess < 75 GROUP BY ALL),
rs AS (SELECT r.*, CASE WHEN days >= 60 THEN f END AS factor, CASE WHEN days < 60 THEN rsds WHEN f IS NULL OR f BETWEEN 0.97 AND 1.03 THEN x WHEN f BETWEEN 0.5 AND 1.5 THEN x * f END AS rs_corrected,
  CASE WHEN days >= 60 AND x IS NOT NULL AND NOT f BETWEEN 0.5 AND 1.5 AND x > rso THEN 2 ELSE 0 END AS bad_rs FROM r LEFT JOIN f USING (s, part))"""


def _series(spark: SparkSession, d: str) -> DataFrame:
    """Daily series of two stations in all the variables that tier 2 looks at."""
    p, k, day = F.col("p"), F.col("k"), F.dayofmonth("date")
    rows = read(spark, d, "orders").groupBy((F.col("o_custkey") % 2).alias("station_key"), F.to_date("o_orderdate").alias("date")).agg(F.max("o_totalprice").alias("p"), F.max("o_orderkey").alias("k"))
    tmax = F.when(day <= 14, 7.0).when(day == 20, 0.0).when(day != 21, day.cast("double"))
    return rows.select(
        "station_key", "date", "k", (p / 100000 * (p / 100000) + F.when(k % 100 == 0, 40).otherwise(0)).alias("td"), (p / 50000 + 4).alias("tmin"), tmax.alias("tmax"), (p / 500).alias("prcp"), (20.0 + k % 60).alias("rh"), (25.0 + k % 60).alias("rhmax"),
        F.when(k % 40 == 0, 0.0).otherwise(p / F.when(F.year("date") % 4 == 1, 2100).when(F.year("date") % 4 == 2, 900).otherwise(1500)).alias("rsds"),
    )


def _sky(spark: SparkSession) -> DataFrame:
    return spark.range(2).select(F.col("id").alias("station_key"), F.explode(F.sequence(F.lit(1), F.lit(365))).alias("doy")).withColumn("rso", F.lit(200.0) + 10 * (F.col("doy") % 7))


@query(f"WITH {_SERIES}, {_DESPIKED} SELECT s AS station_key, date, round(factor, 6) AS factor, round(rs_corrected, 6) AS rs_corrected, CASE bad_rs WHEN 2 THEN 'fail' ELSE 'pass' END AS rs_state FROM rs")
def radiation_despiked(spark: SparkSession, d: str) -> DataFrame:
    """Clear sky joined by day of year, and the ratio by period under the limits that are its defaults, despiking included."""
    out = temporal.rs_period_ratio(temporal.with_clear_sky(_series(spark, d), _sky(spark)), key="station_key")
    number = lambda c: r6(F.nullif(c, F.lit(float("nan"))))
    return out.select("station_key", "date", number("rs_period_factor").alias("factor"), number("rs_corrected").alias("rs_corrected"), "rs_state")


@query(f"""WITH {_SERIES}, {_DESPIKED},
m AS (SELECT *, {_each(_SCORED, "median(#) OVER w AS med_#, count(#) OVER w AS n_#, count(#) OVER (PARTITION BY s) AS all_#")} FROM rs WINDOW w AS (PARTITION BY s, month(date))),
a AS (SELECT *, {_each(_SCORED, "median(abs(# - med_#)) OVER (PARTITION BY s, month(date)) AS mad_#")} FROM m),
z AS (SELECT *, {_each(_SCORED, "coalesce(CASE WHEN n_# >= 90 AND all_# >= 90 AND mad_# > 0 THEN 0.6745 * abs(# - med_#) / mad_# END, 0) AS z_#")} FROM a),
zr AS (SELECT *, {_each(_SCORED, "CASE WHEN z_# > 7 THEN 2 WHEN z_# > 3.5 THEN 1 ELSE 0 END AS bad_#")}, {_each(_RUNS, "# IS NOT NULL AND # <> 0 AS live_#")} FROM z),
nw AS (SELECT *, {_each(_RUNS, "CASE WHEN # IS NOT DISTINCT FROM lag(#) OVER (PARTITION BY s, live_# ORDER BY date) AND row_number() OVER (PARTITION BY s, live_# ORDER BY date) > 1 THEN 0 ELSE 1 END AS new_#")} FROM zr),
ru AS (SELECT *, {_each(_RUNS, "sum(new_#) OVER (PARTITION BY s, live_# ORDER BY date ROWS UNBOUNDED PRECEDING) AS run_#")} FROM nw),
st AS (SELECT *, {_each(_RUNS, "CASE WHEN live_# AND count(*) OVER (PARTITION BY s, live_#, run_#) >= 12 THEN 1 ELSE 0 END AS stuck_#")}, CASE WHEN prcp > 610 THEN 2 ELSE 0 END AS wet, CASE WHEN td > tmin + 3 THEN 2 ELSE 0 END AS moist,
  row_number() OVER (PARTITION BY s, year(date) ORDER BY rhmax DESC NULLS LAST, date) AS rank_rh, count(rhmax) OVER (PARTITION BY s, year(date)) AS n_year FROM ru),
tp AS (SELECT *, avg(CASE WHEN rank_rh <= greatest(1, ceil(n_year * 0.01)) THEN rhmax END) OVER (PARTITION BY s, year(date)) AS top_rh FROM st),
sc AS (SELECT *, CASE WHEN days >= 365 AND top_rh > 0 THEN least(greatest(rhmax * 100 / top_rh, 0), 100) ELSE rhmax END / rhmax AS scale, CASE WHEN k % 50 = 0 THEN 1 ELSE 0 END AS seed FROM tp),
names AS (SELECT ['pass', 'suspect', 'fail'] AS q)
SELECT s AS station_key, date, q[1 + greatest(seed, bad_td, bad_tmax, bad_rsds, bad_rh, wet, bad_rs, moist, stuck_td, stuck_tmax, stuck_prcp, stuck_rsds, stuck_rh)] AS qc_state,
  array_to_string(list_filter([CASE seed WHEN 1 THEN 'given' END, {_each(_SCORED, "CASE WHEN bad_# > 0 THEN 'zscore_#' END")}, CASE WHEN wet > 0 THEN 'prcp_exceeds_daily_max' END, CASE WHEN bad_rs > 0 THEN 'rs_period_ratio' END,
    CASE WHEN moist > 0 THEN 'td_exceeds_tmin_daily' END, CASE WHEN greatest(stuck_td, stuck_tmax, stuck_prcp, stuck_rsds, stuck_rh) > 0 THEN 'stuck_sensor' END], lambda x: x IS NOT NULL), ',') AS qc_reason_codes,
  q[1 + greatest(CASE WHEN k % 30 = 0 THEN 1 ELSE 0 END, bad_td, moist, stuck_td)] AS td_qc_state, q[1 + greatest(bad_tmax, stuck_tmax)] AS tmax_qc_state, q[1 + greatest(wet, stuck_prcp)] AS prcp_qc_state,
  q[1 + greatest(bad_rsds, bad_rs, stuck_rsds)] AS rsds_qc_state, q[1 + greatest(bad_rh, stuck_rh)] AS rh_qc_state, round(factor, 6) AS rs_period_factor,
  round(least(greatest(rh * scale, 0), 100), 6) AS rh_corrected, round(least(greatest(rhmax * scale, 0), 100), 6) AS rhmax_corrected FROM sc, names""")
def tier2_whole(spark: SparkSession, d: str) -> DataFrame:
    """All checks of tier 2 under the limits that are its defaults, with the further ones, reasons given before, and fails
    written to the variables' own states."""
    rows = _series(spark, d).withColumns({"qc_state": F.when(F.col("k") % 50 == 0, "suspect").otherwise("pass"), "qc_reason_codes": F.when(F.col("k") % 50 == 0, "given"), "td_qc_state": F.when(F.col("k") % 30 == 0, "suspect").otherwise("pass")})
    out = temporal.tier2(rows, list(_RUNS), rso=_sky(spark), extra=True, propagate=True)
    states = [f"{v}_qc_state" for v in _RUNS]
    return out.select("station_key", "date", "qc_state", "qc_reason_codes", *states, r6(F.nullif("rs_period_factor", F.lit(float("nan")))).alias("rs_period_factor"), r6("rh_corrected").alias("rh_corrected"), r6("rhmax_corrected").alias("rhmax_corrected"))


@query("""WITH c AS (SELECT 'a:' || c_custkey AS key, 40.0 + c_custkey % 37 * 0.001 AS lat, c_custkey % 50 AS can, c_custkey % 7 * 10.0 AS z FROM customer WHERE c_custkey % 3 = 0),
p AS (SELECT a.key AS ka, b.key AS kb, 2 * 6371000.0 * asin(sqrt(least(power(sin((radians(b.lat) - radians(a.lat)) / 2), 2), 1.0))) AS m, abs(a.z - b.z) AS dz FROM c a JOIN c b ON a.can = b.can AND a.key < b.key)
SELECT ka AS source_station_key_a, kb AS source_station_key_b, round(m, 4) AS distance_m FROM p WHERE dz <= 20 AND m <= 3000 ORDER BY round(m, 4), ka, kb LIMIT 25""")
def closest_pairs_topk(spark: SparkSession, d: str) -> DataFrame:
    """The 25 closest pairs of stations of one identity within limits of distance and elevation."""
    c = F.col("c_custkey")
    walk = read(spark, d, "customer").where(c % 3 == 0).select(F.concat(F.lit("a:"), c.cast("string")).alias("source_station_key"), F.round(F.lit(40.0) + c % 37 * F.lit(0.001), 6).alias("lat"), F.lit(-100.0).alias("lon"), (c % 7 * F.lit(10.0)).alias("elev_m"), (c % 50).alias("canonical_station_id"))
    spans = walk.select(F.col("source_station_key").alias("station_key"), F.lit("2020-01-01").cast("date").alias("por_start"), F.lit("2022-01-01").cast("date").alias("por_end"))
    pairs = crosswalk.candidate_pairs(walk, spans, most_m=3000.0, most_elev=20.0, least_days=365, limit=25, digits=4)
    return pairs.select("source_station_key_a", "source_station_key_b", F.round("distance_m", 4).alias("distance_m"))


@query("""SELECT 'ev:' || user_id AS station_key, CAST(ts AS DATE) AS date, arg_min(value, ts) FILTER (WHERE event_id % 3 = 0) AS lat, 'madis' AS source, 'ev' || user_id AS source_station_id FROM events GROUP BY user_id, CAST(ts AS DATE)""")
def daily_metadata(spark: SparkSession, d: str) -> DataFrame:
    """A station day's place: the first that is given."""
    u, e, k, t, v = cols()
    rows = base(spark, d).select(F.concat(F.lit("ev:"), u.cast("string")).alias("station_key"), F.col("ts").alias("datetime_utc"), F.when(e % 3 == 0, v).alias("lat"), F.lit("madis").alias("source"), F.concat(F.lit("ev"), u.cast("string")).alias("source_station_id"), v.alias("tair"))
    return daily.aggregate_daily_wide(rows, source="madis").select("station_key", "date", "lat", "source", "source_station_id")


@query("""WITH a AS (SELECT 'madis' AS source, CAST(user_id AS VARCHAR) AS id, median(value) AS lat, count(*) AS n, CAST(min(ts) AS DATE) AS f, CAST(max(ts) AS DATE) AS l FROM events WHERE event_type = 'view' GROUP BY ALL UNION ALL
  SELECT 'ghcnd', CAST(o_custkey AS VARCHAR), median(o_totalprice), count(*), CAST(min(o_orderdate) AS DATE), CAST(max(o_orderdate) AS DATE) FROM orders GROUP BY ALL)
SELECT source, id AS source_station_id, lat, n AS n_obs, f AS por_start, l AS por_end FROM a""")
def station_index_of_all(spark: SparkSession, d: str) -> DataFrame:
    """The index over several sources, hourly and daily; one that is left out."""
    u, e, k, t, v = cols()
    place = lambda key, lat: (key.cast("string").alias("source_station_id"), key.cast("string").alias("station_key"), lat.alias("lat"), F.lit(0.0).alias("lon"), F.lit(0.0).alias("elev_m"))
    hourly = base(spark, d).where(F.col("type") == "view").select(*place(u, v), F.col("ts").alias("datetime_utc"))
    days = read(spark, d, "orders").select(*place(F.col("o_custkey"), F.col("o_totalprice")), F.to_date("o_orderdate").alias("date"))
    out = crosswalk.build_station_index({"madis": hourly, "ghcnd": days, "isd": hourly})
    return out.select("source", "source_station_id", "lat", F.col("obs_count").alias("n_obs"), F.to_date("por_start").alias("por_start"), F.to_date("por_end").alias("por_end"))


@query("""SELECT event_type AS source, CAST(user_id AS VARCHAR) AS source_station_id, median(value) AS lat, count(*) AS n_obs, 'hourly' AS temporal_res, min(CAST(ts AS DATE)) AS first_day, max(CAST(ts AS DATE)) AS last_day FROM events GROUP BY event_type, user_id""")
def sampled_station_index(spark: SparkSession, d: str) -> DataFrame:
    """The index of a source with one file a day, from all its days."""
    u, e, k, t, v = cols()
    rows = base(spark, d).select(F.col("type").alias("source"), u.cast("string").alias("source_station_id"), u.cast("string").alias("station_key"), v.alias("lat"), F.lit(0.0).alias("lon"), F.lit(0.0).alias("elev_m"), F.col("ts").alias("datetime_utc"))
    out = crosswalk.index_per_day_source(rows)
    return out.select("source", "source_station_id", "lat", F.col("obs_count").alias("n_obs"), "temporal_res", F.to_date("por_start").alias("first_day"), F.to_date("por_end").alias("last_day"))


@query("""WITH x AS (SELECT user_id, ts, event_id, user_id % 5 AS m, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)
SELECT 'log' || user_id AS path, coalesce(arg_min(k, (ts, event_id)) FILTER (WHERE k % 8 = 0), 0)::BIGINT AS missing_dates, coalesce(arg_max(k, (ts, event_id)) FILTER (WHERE k % 8 = 1), 0)::BIGINT AS rs_period, coalesce(sum(k) FILTER (WHERE k % 8 = 2), 0)::BIGINT AS rs_despiked,
  coalesce(sum(k) FILTER (WHERE k % 8 = 3), 0)::BIGINT AS rs_clipped, coalesce(sum(k + 1) FILTER (WHERE k % 8 = 4), 0)::BIGINT AS rh_rhmin_exceed_100, coalesce(sum(k) FILTER (WHERE k % 8 = 5 AND k % 3 = 0), 0)::BIGINT AS zscore_td, coalesce(sum(k) FILTER (WHERE k % 8 = 5 AND k % 3 <> 0), 0)::BIGINT AS zscore_tmax,
  (2 * count(*) FILTER (WHERE k % 8 = 6))::BIGINT AS manual_nulled_count FROM x GROUP BY user_id""")
def log_summary(spark: SparkSession, d: str) -> DataFrame:
    """Correction logs: all kinds of lines, sections, intervals that are nulled or not, summed for each log."""
    u, e, k, t, v = cols()
    s = k.cast("string")
    m = k % 8
    text = (
        F.when(m == 0, F.concat(F.lit("The data had "), s, F.lit(" missing date entries"))).when(m == 1, F.concat(F.lit("the period length was "), s, F.lit(", and correction sample size was 6")))
        .when(m == 2, F.concat(s, F.lit(" data points were removed as part of the despiking process"))).when(m == 3, F.concat(s, F.lit(" Rs data points were clipped to 5")))
        .when(m == 4, F.concat(F.lit("Year-based RH correction done. RHMax had "), s, F.lit(" points exceed 100, RHMin had "), (k + 1).cast("string"), F.lit(" points")))
        .when(m == 5, F.concat(s, F.lit(" outliers were removed on variable "), F.when(k % 3 == 0, "TD").otherwise("TMax")))
        .when(m == 6, F.concat(F.lit("Now correcting wind and humidity\nSelected correction interval started at 1 and ended at 5\nSelected correction interval started at 7 and ended at 9\nObservations within the interval were set to nan")))
        .otherwise("Selected correction interval started at 1 and ended at 5\nNow correcting Rs at once\nObservations within the interval were set to nan")
    )
    lines = base(spark, d).select(F.concat(F.lit("log"), u.cast("string")).alias("path"), "ts", "e", F.posexplode(F.split(text, "\n")).alias("n", "line"))
    lines = lines.select("path", F.struct("ts", "e", "n").alias("line_no"), "line")
    out = validation.flatten_log(validation.parse_log(lines), ["TD", "TMax"])
    return out.select("path", "missing_dates", "rs_period", "rs_despiked", "rs_clipped", "rh_rhmin_exceed_100", "zscore_td", "zscore_tmax", "manual_nulled_count")


@query("""WITH s AS (SELECT 's' || s_suppkey AS station_key, s_suppkey % 65 AS lat, s_suppkey % 4 AS m, CAST(unnest(range(1, 366, 7)) AS INTEGER) AS doy FROM supplier)
SELECT station_key, doy, round(greatest((doy * 10 - 500) * 0.0036, 0), 6)::DOUBLE AS rso FROM s WHERE m <> 0""")
def raster_radiation(spark: SparkSession, d: str) -> DataFrame:
    """Raster samples in Wh to MJ: negative ones are 0, missing ones are none."""
    s = F.col("s_suppkey")
    samples = read(spark, d, "supplier").select(F.concat(F.lit("s"), s.cast("string")).alias("station_key"), F.explode(F.sequence(F.lit(1), F.lit(365), F.lit(7))).alias("doy"), (s % 4).alias("m"))
    out = temporal.raster_table(samples.select("station_key", "doy", F.when(F.col("m") != 0, (F.col("doy") * 10 - 500).cast("double")).alias("value")))
    return out.select("station_key", "doy", r6("rso").alias("rso"))


@query("""WITH o AS (SELECT o_orderkey, 's' || (o_custkey % 100) AS k, CAST(o_orderdate AS DATE) AS date FROM orders)
SELECT o_orderkey, CASE WHEN CAST(substr(k, 2) AS INTEGER) < 80 THEN CAST(CAST(substr(k, 2) AS INTEGER) + (dayofyear(date) - 1) % 365 + 1 AS DOUBLE) END AS rso FROM o""")
def clear_sky_by_day(spark: SparkSession, d: str) -> DataFrame:
    """Clear-sky radiation by station and day of year: day 366 takes day 1; stations without any have none."""
    c = F.col("o_custkey") % 100
    days = read(spark, d, "orders").select("o_orderkey", F.concat(F.lit("s"), c.cast("string")).alias("station_key"), F.to_date("o_orderdate").alias("date"))
    n = spark.range(80).select("id", F.explode(F.sequence(F.lit(1), F.lit(365))).alias("doy"))
    return temporal.with_clear_sky(days, n.select(F.concat(F.lit("s"), F.col("id").cast("string")).alias("station_key"), "doy", (F.col("id") + F.col("doy")).cast("double").alias("rso"))).select("o_orderkey", "rso")


@query("""SELECT o_orderkey, CASE WHEN o_custkey % 3 = 0 THEN o_totalprice ELSE CASE WHEN o_custkey % 10 < 7 THEN CAST(o_custkey % 10 * 2 AS DOUBLE) END END AS lat, CASE WHEN o_custkey % 10 < 7 THEN 5.0::DOUBLE END AS elev_m FROM orders""")
def index_coordinates(spark: SparkSession, d: str) -> DataFrame:
    """Places from the station index where a series has none."""
    c = F.col("o_custkey")
    days = read(spark, d, "orders").select("o_orderkey", (c % 10).cast("string").alias("station_key"), F.when(c % 3 == 0, F.col("o_totalprice")).alias("lat"))
    index = spark.range(7).select(F.col("id").cast("string").alias("station_key"), (F.col("id") * 2).cast("double").alias("lat"), F.lit(1.0).alias("lon"), F.lit(5.0).alias("elev_m"))
    return por.with_coordinates(days, index).select("o_orderkey", "lat", "elev_m")


@query("""WITH s AS (SELECT 's' || s_suppkey AS k, s_suppkey AS i FROM supplier)
SELECT k AS station_key, CASE WHEN i % 5 = 0 THEN 'raster' WHEN i % 4 <> 1 AND i % 11 < 9 AND i % 13 <> 0 THEN 'asce' END AS method,
  CASE WHEN i % 5 = 0 THEN NULL WHEN i % 4 = 1 AND i % 7 = 0 THEN 'station_index_missing_coords' WHEN i % 4 = 1 THEN 'missing_lat_or_elev' WHEN i % 11 >= 9 THEN 'invalid_lat' WHEN i % 13 = 0 THEN 'invalid_elev_m' END AS reason FROM s""")
def radiation_reasons(spark: SparkSession, d: str) -> DataFrame:
    """Why a station has no clear-sky radiation: no place in the index or its rows, a place that cannot be, a formula or a raster without result."""
    i = F.col("s_suppkey")
    s = read(spark, d, "supplier").select(i, F.concat(F.lit("s"), i.cast("string")).alias("station_key"), F.when(i % 4 != 1, F.when(i % 11 >= 9, 95.0).otherwise(45.0)).alias("lat"), F.when(i % 13 == 0, 9500.0).otherwise(10.0).alias("elev_m"))
    raster = s.where((i % 5 == 0) | (i % 3 == 0)).select("station_key", F.lit(1).alias("doy"), F.when(i % 5 == 0, 7.0).alias("rso"))
    listed = s.select("station_key", F.when(i % 7 != 0, 1.0).alias("lat"), F.lit(1.0).alias("lon"))
    return temporal.resolve_rso(s, raster, listed=listed)


@query("""WITH b AS (SELECT CAST(o_orderdate AS DATE) AS date, o_custkey % 40 AS c, max(o_totalprice) AS p, count(*) AS n FROM orders GROUP BY ALL)
SELECT CASE WHEN c % 4 = 0 THEN 'raws_wrcc:' || c ELSE 'ghcnd:' || c END AS station_key, date, CASE WHEN c % 2 = 0 THEN CAST(n AS INTEGER) ELSE 1 END AS obs_count, round(CASE WHEN c % 4 = 0 THEN p * 3.6 ELSE p END, 4) AS rsds, CASE WHEN c % 3 = 0 THEN 'suspect' ELSE 'pass' END AS qc_state, 'local' AS day_basis, 'n=1,thresh=Y,am=N,pm=N' AS coverage_flags FROM b""")
def daily_passthrough(spark: SparkSession, d: str) -> DataFrame:
    """Sources that are daily already: defaults, units, station keys from the names of files that have none."""
    c = F.col("c")
    days = read(spark, d, "orders").groupBy(F.to_date("o_orderdate").alias("date"), (F.col("o_custkey") % 40).alias("c")).agg(F.max("o_totalprice").alias("rsds"), F.count(F.lit(1)).alias("n"))
    source = F.when(c % 4 == 0, "raws_wrcc").otherwise("ghcnd")
    rows = days.select("date", "rsds", source.alias("source"), F.when(c % 2 == 0, F.col("n")).alias("obs_count"), F.when(c % 3 == 0, "suspect").alias("qc_state"), F.when(c % 2 == 0, F.concat_ws(":", source, c.cast("string"))).alias("station_key"), F.concat(F.lit("/x/"), source, F.lit("_"), c.cast("string"), F.lit(".parquet")).alias("file"))
    out = por.daily_passthrough(rows, file_col="file")
    return out.select("station_key", "date", "obs_count", F.round("rsds", 4).alias("rsds"), "qc_state", "day_basis", "coverage_flags")


@query(f"""WITH {_B}, w AS (SELECT 'madis:' || u AS station_key, 'madis' AS source, CAST(u AS VARCHAR) AS source_station_id, ts, t / 10.0 AS tair, CAST(k AS DOUBLE) AS rh FROM b),
l AS (SELECT *, 'tair' AS variable, tair AS value, 'degC' AS unit FROM w UNION ALL SELECT *, 'rh', rh, 'percent' FROM w)
SELECT station_key, source, source_station_id, {_AT.format('ts')} AS at, variable, value, unit, 'pass' AS qc_state, '{{}}' AS qc_flags_native, CAST(NULL AS VARCHAR) AS raw_file_hash FROM l""")
def hourly_contract(spark: SparkSession, d: str) -> DataFrame:
    """Long rows under the hourly contract."""
    u, e, k, t, v = cols()
    wide = base(spark, d).select(F.concat(F.lit("madis:"), u.cast("string")).alias("station_key"), F.lit("madis").alias("source"), u.cast("string").alias("source_station_id"), F.col("ts").alias("datetime_utc"), (t / 10).alias("tair"), k.cast("double").alias("rh"), F.lit("pass").alias("qc_state"), F.lit("extra").alias("extra"))
    long = readers.to_long(readers.provenance(wide, "madis"), ["tair", "rh"]).withColumns({"raw_source_uri": F.lit(None).cast("string"), "raw_file_hash": F.lit(None).cast("string")})
    out = schema.conform_hourly(long)
    return out.select("station_key", "source", "source_station_id", at("datetime_utc").alias("at"), "variable", "value", "unit", "qc_state", "qc_flags_native", "raw_file_hash")


@query("""SELECT 'ev:' || user_id AS station_key, CAST(ts AS DATE) AS date, 'utc' AS day_basis, CAST(count(*) AS INTEGER) AS obs_count, round(max(value), 6) AS tmax, 12 AS n_columns FROM events GROUP BY user_id, CAST(ts AS DATE)""")
def daily_contract(spark: SparkSession, d: str) -> DataFrame:
    """Station days under the daily contract: the core and the measures, nothing else."""
    u, e, k, t, v = cols()
    rows = base(spark, d).select(F.concat(F.lit("ev:"), u.cast("string")).alias("station_key"), F.col("ts").alias("datetime_utc"), v.alias("tair"), F.lit("x").alias("qc_reason_codes"))
    out = schema.conform_daily(daily.aggregate_daily_wide(rows, source="madis"))
    return out.select("station_key", "date", "day_basis", "obs_count", r6("tmax").alias("tmax"), F.lit(len(out.columns)).alias("n_columns"))


@query("""SELECT 'st:' || user_id AS station_key, count(*) AS n, round(sum(value), 4) AS total, 1::BIGINT AS buckets FROM events GROUP BY user_id""")
def hash_buckets(spark: SparkSession, d: str) -> DataFrame:
    """The contents of the hundred buckets, each by itself, and in how many of them a station's rows are."""
    rows = base(spark, d).select(F.concat(F.lit("st:"), F.col("u").cast("string")).alias("station_key"), F.col("v"))
    held = rows.groupBy(por.bucket(F.col("station_key")).alias("bucket"), "station_key").agg(F.count(F.lit(1)).alias("n"), F.sum("v").alias("total"))
    held = held.where(F.col("bucket").between(0, 99))
    return held.groupBy("station_key").agg(F.sum("n").alias("n"), F.round(F.sum("total"), 4).alias("total"), F.count_distinct("bucket").alias("buckets"))


@query("""SELECT 'ev:' || user_id AS station_key, count(DISTINCT CAST(ts AS DATE)) AS days, min(CAST(ts AS DATE)) AS first_date, max(CAST(ts AS DATE)) AS last_date, 0::BIGINT AS failed_days FROM events GROUP BY user_id""")
def por_inventory(spark: SparkSession, d: str) -> DataFrame:
    """Days and dates of each station's series."""
    u, e, k, t, v = cols()
    rows = base(spark, d).select(F.concat(F.lit("ev:"), u.cast("string")).alias("station_key"), F.col("ts").alias("datetime_utc"), v.alias("tair"))
    return por.inventory(daily.aggregate_daily_wide(rows, source="madis"))


@query("""WITH o AS (SELECT 'st' || (o_custkey % 20) AS station, 'madis:' || (o_custkey % 20) AS k, CAST(o_orderdate AS DATE) AS date, max(o_totalprice) AS tmax, max(o_custkey) AS c FROM orders GROUP BY ALL),
p AS (SELECT station, k, date, tmax AS ours, CASE WHEN c % 5 <> 0 THEN tmax + 1 END AS theirs, CASE c % 3 WHEN 0 THEN 'stuck_sensor' WHEN 1 THEN 'zscore_td' ELSE '' END AS why, c FROM o WHERE CAST(substr(station, 3) AS INTEGER) < 12 AND c % 7 <> 0)
SELECT station, k AS station_key, date, 'tmax' AS variable, ours, theirs, CASE WHEN why = 'stuck_sensor' THEN why ELSE '' END AS reasons, why = 'stuck_sensor' AS flagged, theirs IS NULL AS removed FROM p""")
def validation_set(spark: SparkSession, d: str) -> DataFrame:
    """All pairs against their series in one join."""
    c = F.col("c")
    days = read(spark, d, "orders").groupBy((F.col("o_custkey") % 20).alias("i"), F.to_date("o_orderdate").alias("date")).agg(F.max("o_totalprice").alias("tmax"), F.max("o_custkey").alias("c"))
    s = F.col("i").cast("string")
    ours = days.select(F.concat(F.lit("madis:"), s).alias("station_key"), "date", "tmax", F.when(c % 3 == 0, "stuck_sensor").when(c % 3 == 1, "zscore_td").alias("qc_reason_codes"))
    theirs = days.where(c % 7 != 0).select(F.concat(F.lit("st"), s).alias("station"), "date", F.when(c % 5 != 0, F.col("tmax") + 1).alias("tmax"))
    pairs = spark.range(12).select(F.concat(F.lit("st"), F.col("id").cast("string")).alias("station"), F.concat(F.lit("madis:"), F.col("id").cast("string")).alias("station_key"))
    return validation.comparison_set(pairs, ours, theirs, variables=["tmax"])


@query("""WITH x AS (SELECT event_id, value / 10 AS a, value / 10 * (1 + (user_id % 5) / 100.0) AS b, value / 10 + 1 AS c, value / 10 + 1 + (user_id % 3) AS d FROM events WHERE user_id % 4 <> 0)
SELECT 'rsds' AS variable, count(*) AS n, round(avg(d - c), 5) AS mean_their_correction, round(avg(b - a), 5) AS mean_our_correction, round(avg(b - a - (d - c)), 5) AS correction_bias, round(avg(abs(b - a - (d - c))), 5) AS correction_mae, round(corr(d - c, b - a), 5) AS correction_corr FROM x""")
def correction_agreement(spark: SparkSession, d: str) -> DataFrame:
    """How far our corrections of radiation are from another's."""
    u, e, k, t, v = cols()
    x = v / 10
    b = base(spark, d)
    cell = lambda name, ours, theirs: b.select(e, F.lit(name).alias("variable"), ours.alias("ours"), theirs.alias("theirs"))
    rows = cell("rsds", x, x + 1).union(cell("rsds_corrected", x * (1 + (u % 5) / 100), F.when(u % 4 != 0, x + 1 + u % 3)))
    out = validation.correction_agreement(rows, keys=["e"])
    return out.select("variable", "n", *(F.round(c, 5).alias(c) for c in out.columns[2:]))


@query("""WITH o AS (SELECT 'S' || (o_custkey % 30) AS station, o_orderkey, CAST(o_orderdate AS DATE) AS date, o_totalprice AS x FROM orders), n AS (SELECT *, row_number() OVER (PARTITION BY station, date ORDER BY o_orderkey) AS i FROM o)
SELECT station, date, x AS tmax, round(x * 0.0864, 6) AS rsds FROM n WHERE i = 1""")
def checked_workbook(spark: SparkSession, d: str) -> DataFrame:
    """A checked station's rows: names, radiation from W/m2, the first row of a date."""
    rows = read(spark, d, "orders").select(F.concat(F.lit("S"), (F.col("o_custkey") % 30).cast("string")).alias("station"), F.col("o_orderkey").alias("row_no"), F.col("o_orderdate").alias("date"), F.col("o_totalprice").alias("TMax (C)"), F.col("o_totalprice").alias("Rs (w/m2)"))
    return validation.normalize_checked(rows, {"TMax (C)": "tmax", "Rs (w/m2)": "rsds"}).select("station", "date", "tmax", r6("rsds").alias("rsds"))


_ES = "(0.6108 * exp(17.27 * {0} / ({0} + 237.3)))"


@query(f"""WITH x AS (SELECT event_id AS e, value / 10 AS hi, value / 20 AS lo, CASE WHEN event_id % 2 = 0 THEN value / 30 END AS td, CASE WHEN event_id % 3 = 0 THEN value / 5 END AS rx, CASE WHEN event_id % 3 = 0 THEN value / 9 END AS rn FROM events)
SELECT e, round(CASE WHEN td IS NOT NULL THEN {_ES.format('td')} WHEN rx IS NOT NULL THEN ({_ES.format('lo')} * rx + {_ES.format('hi')} * rn) / 200 ELSE {_ES.format('lo')} END, 6) AS ea, round((hi + lo) / 2, 6) AS tavg FROM x""")
def humidity_gaps(spark: SparkSession, d: str) -> DataFrame:
    """Vapour pressure by priority, gaps filled by the next way; a measure that is wholly null counts as absent."""
    u, e, k, t, v = cols()
    none = F.lit(None).cast("double")
    rows = base(spark, d).select("e", none.alias("ea"), (v / 10).alias("tmax"), (v / 20).alias("tmin"), F.when(e % 2 == 0, v / 30).alias("td"), F.when(e % 3 == 0, v / 5).alias("rhmax"), F.when(e % 3 == 0, v / 9).alias("rhmin"))
    return compile_humidity(rows).select("e", r6("ea_compiled").alias("ea"), r6("tavg").alias("tavg"))


@query("""SELECT event_id, round(value * 0.514444, 6) AS kt, round(value - 273.15, 6) AS kelvin, round(value * 100.0, 6) AS hpa, round(value * 25.4, 6) AS inches, value AS own, round(CASE user_id % 3 WHEN 0 THEN value - 273.15 WHEN 1 THEN value * 25.4 ELSE value END, 6) AS mixed FROM events""")
def unit_registry(spark: SparkSession, d: str) -> DataFrame:
    """Every rule of the registry, the identity, and a long table of mixed variables and units."""
    u, e, k, t, v = cols()
    r = units.default_registry()
    variable = F.when(u % 3 == 0, "tair").when(u % 3 == 1, "prcp").otherwise("q")
    unit = F.when(u % 3 == 0, "K").when(u % 3 == 1, "in").otherwise("kg kg-1")
    return base(spark, d).select(
        e.alias("event_id"), r6(r.convert(v, "wind", "kt")).alias("kt"), r6(r.convert(v, "td", "K")).alias("kelvin"), r6(r.convert(v, "slp", "hPa")).alias("hpa"), r6(r.convert(v, "prcp", "in")).alias("inches"), r.convert(v, "vpd", "kPa").alias("own"),
        r6(r.convert_long(v, variable, unit)).alias("mixed"),
    )


@query("""WITH o AS (SELECT l_suppkey AS k, month(l_shipdate) AS m, l_extendedprice AS a, l_quantity AS b FROM lineitem)
SELECT k AS station_key, CAST(m AS INTEGER) AS month, round(avg(a) - avg(b), 3) AS factor, count(*) AS n FROM o GROUP BY ALL""")
def correction_differences(spark: SparkSession, d: str) -> DataFrame:
    """Monthly factors as differences of means."""
    rows = read(spark, d, "lineitem").select(F.col("l_suppkey").alias("station_key"), F.struct("l_orderkey", "l_linenumber").alias("row"), F.col("l_shipdate").alias("date"), F.col("l_extendedprice").alias("a"), F.col("l_quantity").alias("b"))
    side = lambda c: rows.select("station_key", "row", "date", F.col(c).alias("v"))
    out = corrections.monthly_factors(side("a"), side("b"), variable="v", keys=["station_key"], method="difference", match=["row"])
    return out.select("station_key", "month", F.round("factor", 3).alias("factor"), "n")


@query(f"""WITH {_B}, h AS (SELECT 'gdas_adpsfc:' || (u % 40) AS k, date_trunc('hour', ts) AS h, arg_min(t / 10.0, e) AS tair, arg_min(95000.0 + e % 1000, e) AS psfc, arg_min(0.002 + k / 10000.0, e) AS q, arg_min(CAST(k % 9 AS DOUBLE), e) AS uw, arg_min(CAST(k % 7 AS DOUBLE), e) AS vw FROM b GROUP BY ALL),
p AS (SELECT *, q * (psfc / 1000) / (0.622 + 0.378 * q) AS ea FROM h), d AS (SELECT *, 237.3 * ln(ea / 0.6108) / (17.27 - ln(ea / 0.6108)) AS td FROM p)
SELECT k AS station_key, CAST(h AS DATE) AS date, CAST(count(*) AS INTEGER) AS obs_count, round(avg(tair), 5) AS tmean, round(avg(td), 5) AS td, round(avg(sqrt(uw * uw + vw * vw)), 5) AS wind, round(avg(psfc), 4) AS psfc FROM d GROUP BY k, CAST(h AS DATE)""")
def gdas_station_por(spark: SparkSession, d: str) -> DataFrame:
    """Cycles collapsed, dew point and wind derived, then days and the series checks."""
    u, e, k, t, v = cols()
    rows = base(spark, d).select(
        F.concat(F.lit("gdas_adpsfc:"), (u % 40).cast("string")).alias("station_key"), F.date_trunc("hour", "ts").alias("datetime_utc"), e.alias("cycle"), (t / 10).alias("tair"), (F.lit(95000.0) + e % 1000).alias("psfc"), (F.lit(0.002) + k / 10000).alias("q"), (k % 9).cast("double").alias("u"), (k % 7).cast("double").alias("v"),
    )
    done = por.build_station_por(rows, source="gdas")
    return done.series.select("station_key", "date", "obs_count", *(F.round(c, 5).alias(c) for c in ("tmean", "td", "wind")), F.round("psfc", 4).alias("psfc"))


@query("""SELECT event_id, strftime(ts + INTERVAL 480 MINUTE, '%Y-%m-%d %H:%M:%S') AS utc, CAST(ts + INTERVAL 480 MINUTE AS DATE) AS utc_date FROM events""")
def times_to_utc(spark: SparkSession, d: str) -> DataFrame:
    """Times without a zone are made instants before they are accepted; standard time to UTC."""
    rows = C.ensure_utc(C.attach_utc(read(spark, d, "events"), "ts"), "ts")
    utc = C.to_utc(F.col("ts"), F.lit(-480))
    return rows.select("event_id", F.date_format(utc, "yyyy-MM-dd HH:mm:ss").alias("utc"), C.utc_date(utc).alias("utc_date"))
