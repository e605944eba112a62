"""Queries of the station operators over the driver's tables, each with its SQL.

The driver's ``events`` stand in for an observation table: ``dtm`` is the time, ``value`` the measured value, ``f`` its flag
(by event type), ``k`` a second quantity, ``state`` an instrument state, ``direction`` and ``speed`` a wind. Times come
out as whole seconds or microseconds since the epoch.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from aerolake.functions import numeric, timeparse
from aerolake.operators import aggregate, availability, columns, flags, joins, merge, profiles, stats, validity, windows
from aerolake.operators.buckets import bucket
from aerolake.session import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

OBS = """obs AS (
    SELECT event_id, CAST(ts AS TIMESTAMP) AS dtm, epoch_us(CAST(ts AS TIMESTAMP)) AS us, user_id, event_type, value,
           CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k,
           CASE event_type WHEN 'error' THEN 1 WHEN 'view' THEN NULL ELSE 0 END AS f,
           value % 360 AS direction, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS speed,
           CAST(json_extract_string(props, '$.k') AS INTEGER) % 7 AS state
    FROM events)"""


def obs(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    k = F.get_json_object("props", "$.k").cast("double")
    return e.select("event_id", F.col("ts").alias("dtm"), F.unix_micros("ts").alias("us"), "user_id", "event_type", "value", k.alias("k"), F.when(F.col("event_type") == "error", 1).when(F.col("event_type") == "view", None).otherwise(0).alias("f"), (F.col("value") % 360).alias("direction"), k.alias("speed"), (k.cast("int") % 7).alias("state"))


def query(name: str, sql: str | None = None, with_obs: bool = True):
    """Register a query, and its SQL behind the common table expression of the observations."""

    def add(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = f
        if sql is not None:
            SQL[name] = (f"WITH {OBS}" + (", " if sql.lstrip().startswith("+") else " ") + sql.lstrip().lstrip("+")) if with_obs else sql
        return f

    return add


def r6(c: Column | str) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def sec(c: Column | str) -> Column:
    return F.unix_seconds(F.col(c) if isinstance(c, str) else c)


# --- Level 2 aggregates ---------------------------------------------------------------------------------------------------
def _level2(every: str, method: str = "mean", accept: bool = True, keys: tuple[str, ...] = ("event_type",), value: str = "value", **kw) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, d: str) -> DataFrame:
        rows = obs(spark, d).withColumn("f_value", F.col("f")).withColumnRenamed("value", "VALUE") if value == "value" else obs(spark, d)
        out = aggregate.level2(rows, aggregate.Level2([value], default=method, accept_null_flag=accept, keys=keys, **kw), every)
        return out.select(*keys, sec("dtm").alias("start"), r6(value).alias("value"), F.col(f"n_{value}").alias("n"))

    return run


_GOOD = "CASE WHEN f IS NULL OR f = 0 THEN value END"
for _name, _every, _trunc in (("A01_level2_hourly", "1h", "hour"), ("A01_level2_daily", "1d", "day"), ("A01_level2_monthly", "1mo", "month")):
    query(_name, f"SELECT event_type, epoch(date_trunc('{_trunc}', dtm))::BIGINT AS start, round(avg({_GOOD}), 6) AS value, count({_GOOD}) AS n FROM obs GROUP BY 1, 2")(_level2(_every))
query("P02_level2_strict", "SELECT event_type, epoch(date_trunc('hour', dtm))::BIGINT AS start, round(avg(CASE WHEN f = 0 THEN value END), 6) AS value, count(CASE WHEN f = 0 THEN value END) AS n FROM obs GROUP BY 1, 2")(_level2("1h", accept=False))
for _method, _sql in (
    ("sum", f"sum({_GOOD})"), ("median", f"median({_GOOD})"), ("min", f"min({_GOOD})"), ("max", f"max({_GOOD})"),
    ("first", f"arg_min({_GOOD}, us) FILTER (WHERE {_GOOD} IS NOT NULL)"), ("last", f"arg_max({_GOOD}, us) FILTER (WHERE {_GOOD} IS NOT NULL)"),
):
    query(f"A02_daily_{_method}", f"SELECT event_type, epoch(date_trunc('day', dtm))::BIGINT AS start, round({_sql}, 6) AS value, count({_GOOD}) AS n FROM obs GROUP BY 1, 2")(_level2("1d", _method))
query("A03_circular_mean", "SELECT event_type, epoch(date_trunc('day', dtm))::BIGINT AS start, round(((degrees(atan2(avg(sin(radians(direction))), avg(cos(radians(direction))))) % 360) + 360) % 360, 6) AS value, count(direction) AS n FROM obs GROUP BY 1, 2")(_level2("1d", "circular_mean", value="direction"))
query("W02_right_closed_right_label", f"SELECT event_type, epoch(time_bucket(INTERVAL 1 HOUR, dtm - INTERVAL 1 MICROSECOND))::BIGINT + 3600 AS start, round(avg({_GOOD}), 6) AS value, count({_GOOD}) AS n FROM obs GROUP BY 1, 2")(_level2("1h", closed="right", label="right"))
query("W02_both_closed", f"+spread AS (SELECT *, unnest(CASE WHEN us % 600000000 = 0 THEN [us - 600000000, us] ELSE [us // 600000000 * 600000000] END) AS w FROM obs) SELECT event_type, w // 1000000 AS start, round(avg({_GOOD}), 6) AS value, count({_GOOD}) AS n FROM spread GROUP BY 1, 2")(_level2("10min", closed="both"))
query("W02_open", f"SELECT event_type, us // 600000000 * 600 AS start, round(avg({_GOOD}), 6) AS value, count({_GOOD}) AS n FROM obs WHERE us % 600000000 <> 0 GROUP BY 1, 2")(_level2("10min", closed="none"))
query("W02_datapoint_label", f"SELECT event_type, epoch_us(min(dtm)) // 1000000 AS start, round(avg({_GOOD}), 6) AS value, count({_GOOD}) AS n FROM obs GROUP BY event_type, date_trunc('hour', dtm)")(_level2("1h", label="datapoint"))
query("W02_weekly", f"SELECT event_type, epoch(date_trunc('week', dtm))::BIGINT AS start, round(avg({_GOOD}), 6) AS value, count({_GOOD}) AS n FROM obs GROUP BY 1, 2")(_level2("1w"))


@query("F02_local_days", "SELECT event_type, ((us + 3 * 3600000000) // 86400000000 * 86400 - 3 * 3600) AS start, count(*) AS n FROM obs GROUP BY 1, 2")
def f02(spark, d):
    return obs(spark, d).groupBy("event_type", sec(bucket(F.col("dtm"), "1d", zone="Africa/Nairobi")).alias("start")).agg(F.count("*").alias("n"))


@query("A04_wind_vector", "+w AS (SELECT event_type, date_trunc('day', dtm) AS t, avg(-speed * sin(radians(direction))) AS u, avg(-speed * cos(radians(direction))) AS v, count(speed + direction) AS n FROM obs GROUP BY 1, 2) SELECT event_type, epoch(t)::BIGINT AS start, round(sqrt(u * u + v * v), 6) AS speed, round((degrees(atan2(u, v)) + 180) % 360, 6) AS direction, n FROM w")
def a04(spark, d):
    out = aggregate.wind_mean(obs(spark, d), ["event_type", F.date_trunc("day", "dtm").alias("t")], F.col("speed"), F.col("direction"))
    return out.select("event_type", sec("t").alias("start"), r6("speed").alias("speed"), r6("direction").alias("direction"), "n")


@query("A05_meteo_hourly", "SELECT epoch(date_trunc('hour', dtm))::BIGINT AS start, arg_min(user_id, us) AS iii, round(sum(CASE WHEN f = 0 THEN value END), 6) AS rre, round(avg(k), 6) AS tre FROM obs GROUP BY 1")
def a05(spark, d):
    rows = obs(spark, d).select("dtm", F.col("user_id").alias("iii"), F.col("value").alias("rre"), F.col("f").alias("f_rre"), F.col("k").alias("tre"))
    return aggregate.meteo_hourly(rows, precipitation=["rre"]).select(sec("dtm").alias("start"), "iii", r6("rre").alias("rre"), r6("tre").alias("tre"))


@query("A07_daily_median", "SELECT event_type, epoch(date_trunc('day', dtm))::BIGINT AS start, round(median(value), 6) AS value FROM obs WHERE f = 0 OR f IS NULL GROUP BY 1, 2")
def a07(spark, d):
    return validity.rows_all_valid(obs(spark, d), ["f"]).groupBy("event_type", sec(bucket(F.col("dtm"), "1d")).alias("start")).agg(r6(F.median("value")).alias("value"))


@query("A11_hour_end_coverage", "+h AS (SELECT event_type, epoch(date_trunc('hour', dtm))::BIGINT + 3600 AS hour_end, avg(value) AS value FROM obs GROUP BY 1, 2) SELECT event_type, count(*) AS hours, round(count(*) * 3600.0 / (max(hour_end) - min(hour_end) + 3600), 6) AS coverage, round(avg(value), 6) AS value FROM h GROUP BY 1")
def a11(spark, d):
    h = obs(spark, d).groupBy("event_type", (sec(F.date_trunc("hour", "dtm")) + 3600).alias("hour_end")).agg(F.avg("value").alias("value"))
    return h.groupBy("event_type").agg(F.count("*").alias("hours"), r6(F.count("*") * 3600.0 / (F.max("hour_end") - F.min("hour_end") + 3600)).alias("coverage"), r6(F.avg("value")).alias("value"))


@query("A12_daily_from_hourly", "+h AS (SELECT date_trunc('hour', dtm) AS t, avg(value) AS value, count(value) AS n FROM obs GROUP BY 1) SELECT epoch(date_trunc('day', t))::BIGINT AS start, round(avg(value), 6) AS value, sum(n)::BIGINT AS n FROM h GROUP BY 1")
def a12(spark, d):
    h = obs(spark, d).groupBy(F.date_trunc("hour", "dtm").alias("dtm")).agg(F.avg("value").alias("value"), F.count("value").alias("n_value"))
    return aggregate.daily_from_hourly(h, ["value"]).select(sec("dtm").alias("start"), r6("value").alias("value"), F.col("n_value").alias("n"))


@query("A13_pivot_latest_rank", "+r AS (SELECT us // 3600000000 AS hour, event_type, arg_max(value, us) AS value FROM obs GROUP BY 1, 2) SELECT hour, max(value) FILTER (WHERE event_type = 'click') AS click, max(value) FILTER (WHERE event_type = 'view') AS view FROM r GROUP BY 1 HAVING count(*) FILTER (WHERE event_type IN ('click', 'view')) > 0")
def a13(spark, d):
    r = obs(spark, d).filter(F.col("event_type").isin("click", "view")).groupBy(F.floor(F.col("us") / 3_600_000_000).alias("hour"), "event_type").agg(F.max_by("value", "us").alias("value"))
    return r.groupBy("hour").pivot("event_type", ["click", "view"]).agg(F.first("value"))


@query("A14_coverage_pivot", "SELECT CAST(CAST(dtm AS DATE) AS VARCHAR) AS date, count(*) FILTER (WHERE event_type = 'click') AS click, count(*) FILTER (WHERE event_type = 'view') AS view, count(*) FILTER (WHERE event_type = 'error') AS error FROM obs GROUP BY 1")
def a14(spark, d):
    return availability.coverage_pivot(obs(spark, d), "dtm", "event_type", ["click", "view", "error"]).withColumn("date", F.col("date").cast("string"))


@query("A15_modal_interval", "+g AS (SELECT event_type, us - lag(us) OVER (PARTITION BY event_type ORDER BY us) AS gap FROM (SELECT event_type, us // 60000000 * 60000000 AS us FROM obs)), n AS (SELECT event_type, gap / 1e6 AS seconds, count(*) AS n FROM g WHERE gap > 0 GROUP BY 1, 2) SELECT event_type, arg_max(seconds, n * 1e9 - seconds) AS seconds, max(n) AS n FROM n GROUP BY 1")
def a15(spark, d):
    return availability.modal_interval(obs(spark, d).withColumn("dtm", F.date_trunc("minute", "dtm")), "dtm", ["event_type"])


@query("A16_median_interval", "+r AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY us DESC) AS r FROM obs), g AS (SELECT event_type, (us - lag(us) OVER (PARTITION BY event_type ORDER BY us)) / 1e6 AS gap FROM r WHERE r <= 1000) SELECT event_type, round(quantile_cont(gap, 0.5), 6) AS seconds FROM g WHERE gap > 0 GROUP BY 1")
def a16(spark, d):
    return availability.median_interval(obs(spark, d), "dtm", ["event_type"], 1000).select("event_type", r6("seconds").alias("seconds"))


@query("A17_availability", "+b AS (SELECT min(us) // 86400000000 * 86400000000 AS a, max(us) AS z FROM obs) SELECT event_type, count(DISTINCT (us - a) // 600000000) AS observed, ((z - a) // 600000000 + 1)::BIGINT AS expected, round(100.0 * count(DISTINCT (us - a) // 600000000) / ((z - a) // 600000000 + 1), 3) AS percent FROM obs, b GROUP BY event_type, a, z")
def a17(spark, d):
    rows = obs(spark, d)
    span = rows.agg(F.date_trunc("day", F.min("dtm")).alias("_a"), F.max("dtm").alias("_z"))
    rows = joins.with_scalars(rows, span)
    return availability.availability(rows, "dtm", F.col("_a"), F.col("_z"), 600, ["event_type", "_a", "_z"]).drop("_a", "_z")


@query("A18_time_profile", "SELECT event_type, count(*) AS rows, count(*) FILTER (WHERE h IS NULL) AS null_times, count(DISTINCT h) AS unique_times, epoch(max(h))::BIGINT AS latest, count(h) - count(DISTINCT h) AS duplicates FROM (SELECT event_type, date_trunc('hour', dtm) AS h FROM obs) GROUP BY 1")
def a18(spark, d):
    out = availability.time_profile(obs(spark, d).withColumn("dtm", F.date_trunc("hour", "dtm")), "dtm", ["event_type"])
    return out.withColumn("latest", sec("latest"))


def _pt(rows: DataFrame) -> DataFrame:
    return rows.withColumns({"p": F.lit(900.0) + F.col("k"), "t": F.col("value") / 10 - 5})


_PT = "+pt AS (SELECT *, 900.0 + k AS p, value / 10 - 5 AS t FROM obs) "


@query("M01_reporting_condition", _PT + "SELECT event_id, round(CASE WHEN abs(p - 1013.25) <= 0.5 AND abs(t - 20) <= 0.01 THEN value ELSE value * (1013.25 / p) * ((t + 273.15) / 293.15) END, 6) AS value, 1013.25::DOUBLE AS p, 20.0::DOUBLE AS t FROM pt")
def m01(spark, d):
    return aggregate.correct_to_reporting_condition(_pt(obs(spark, d)), ["value"], "p", "t", 1013.25, 20.0).select("event_id", r6("value").alias("value"), "p", "t")


@query("A19_correction_audit", _PT + "SELECT count(*) FILTER (WHERE abs(p - 950) <= 0.5 AND abs(t - 5) <= 0.01) AS n_at_target, count(*) FILTER (WHERE NOT (abs(p - 950) <= 0.5 AND abs(t - 5) <= 0.01)) AS n_corrected, 0::BIGINT AS n_invalid, min(p) AS min_p, max(p) AS max_p, round(min(t), 6) AS min_t, round(max(t), 6) AS max_t, round(min(950 / p * (t + 273.15) / 278.15), 6) AS min_factor, round(max(950 / p * (t + 273.15) / 278.15), 6) AS max_factor FROM pt")
def a19(spark, d):
    out = aggregate.correction_audit(_pt(obs(spark, d)), "p", "t", 950, 5)
    return out.withColumns({c: r6(c) for c in ("min_t", "max_t", "min_factor", "max_factor")})


@query("A20_available_valid", f"SELECT 'value' AS variable, count(value) AS available, count({_GOOD}) AS valid FROM obs UNION ALL SELECT 'k', count(k), count(k) FROM obs")
def a20(spark, d):
    return aggregate.available_and_valid(obs(spark, d).withColumn("f_value", F.col("f")), ["value", "k"])


@query("A22_diurnal_climatology", "SELECT hour(dtm)::INTEGER AS period, round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS std, count(value) AS n FROM obs GROUP BY 1")
def a22(spark, d):
    return stats.climatology(obs(spark, d), "value", F.hour("dtm")).withColumns({"mean": r6("mean"), "std": r6("std")})


@query("A22_day_of_year_climatology", "SELECT event_type, dayofyear(dtm)::INTEGER AS period, round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS std, count(value) AS n FROM obs GROUP BY 1, 2")
def a22d(spark, d):
    return stats.climatology(obs(spark, d), "value", F.dayofyear("dtm"), ["event_type"]).withColumns({"mean": r6("mean"), "std": r6("std")})


@query("A23_mean_of_sums", "+s AS (SELECT event_type, CAST(dtm AS DATE) AS day, sum(value) AS x FROM obs GROUP BY 1, 2) SELECT event_type, round(avg(x), 6) AS value, count(x) AS n FROM s GROUP BY 1")
def a23(spark, d):
    return stats.two_stage(obs(spark, d), ["event_type", F.to_date("dtm").alias("day")], ["event_type"], "value").withColumn("value", r6("value"))


@query("A24_least_count", "SELECT event_type, epoch(date_trunc('day', dtm))::BIGINT AS start, CASE WHEN count(value) >= 70 THEN round(avg(value), 6) END AS value, count(value) AS n FROM obs GROUP BY 1, 2")
def a24(spark, d):
    out = aggregate.with_coverage(obs(spark, d), ["event_type", F.date_trunc("day", "dtm").alias("t")], F.col("value"), 70)
    return out.select("event_type", sec("t").alias("start"), r6("value").alias("value"), "n")


@query("A25_box_widths", "+g AS (SELECT event_type, count(value) AS n, quantile_cont(value, 0.25) AS p25, quantile_cont(value, 0.5) AS p50, quantile_cont(value, 0.75) AS p75 FROM obs GROUP BY 1) SELECT event_type, n, round(p25, 6) AS p25, round(p50, 6) AS p50, round(p75, 6) AS p75, round(n / (SELECT max(n) FROM g) * 0.8, 6) AS width FROM g")
def a25(spark, d):
    return stats.box_widths(obs(spark, d), "event_type", "value").withColumns({c: r6(c) for c in ("p25", "p50", "p75", "width")})


@query("A26_daily_max_of_running_sum", "+c AS (SELECT event_type, CAST(dtm AS DATE) AS day, sum(k) OVER (PARTITION BY event_type, CAST(dtm AS DATE) ORDER BY us, event_id ROWS UNBOUNDED PRECEDING) AS s FROM obs) SELECT event_type, CAST(day AS VARCHAR) AS day, round(max(s), 6) AS top FROM c GROUP BY 1, 2")
def a26(spark, d):
    rows = obs(spark, d).withColumn("day", F.to_date("dtm"))
    w = windows.ordered(["event_type", "day"], "us", "event_id")
    return rows.withColumn("s", windows.running_sum(F.col("k"), w)).groupBy("event_type", F.col("day").cast("string").alias("day")).agg(r6(F.max("s")).alias("top"))


@query("A27_nearest_quantile", "+r AS (SELECT event_type, value, row_number() OVER (PARTITION BY event_type ORDER BY value) - 1 AS i, count(*) OVER (PARTITION BY event_type) AS n FROM obs) SELECT event_type, max(value) AS quantile FROM r WHERE i = round(0.995 * (n - 1)) GROUP BY 1")
def a27(spark, d):
    return stats.nearest_quantile(obs(spark, d), "value", 0.995, ["event_type"])


@query("A28_regression", "SELECT event_type, count(*) AS n, round(regr_slope(value, k), 6) AS slope, round(regr_intercept(value, k), 6) AS intercept, round(corr(value, k), 6) AS r, round(corr(value, k) * corr(value, k), 6) AS r2, round(sqrt((1 - corr(value, k) * corr(value, k)) * var_pop(value) / var_pop(k) / (count(*) - 2)), 6) AS stderr FROM obs GROUP BY 1")
def a28(spark, d):
    return stats.regression(obs(spark, d), "k", "value", ["event_type"]).withColumns({c: r6(c) for c in ("slope", "intercept", "r", "r2", "stderr")})


@query("A29_regression_by_hour", "SELECT hour(dtm)::INTEGER AS hour, count(*) AS n, round(regr_slope(value, k), 6) AS slope, round(corr(value, k), 6) AS r FROM obs GROUP BY 1")
def a29(spark, d):
    return stats.regression(obs(spark, d).withColumn("hour", F.hour("dtm")), "k", "value", ["hour"]).select("hour", "n", r6("slope").alias("slope"), r6("r").alias("r"))


@query("A30_orthogonal_regression", "+m AS (SELECT event_type, count(*) AS n, avg(k) AS mx, avg(value) AS my, var_pop(k) AS vx, var_pop(value) AS vy, covar_pop(k, value) AS c FROM obs GROUP BY 1), s AS (SELECT *, (vy - vx + sqrt((vy - vx) * (vy - vx) + 4 * c * c)) / (2 * c) AS slope FROM m) SELECT event_type, n, round(slope, 3) AS slope, round((my - slope * mx) / 1000, 3) AS intercept FROM s")
def a30(spark, d):
    out = stats.orthogonal_regression(obs(spark, d), "k", "value", ["event_type"])
    return out.select("event_type", "n", F.round("slope", 3).alias("slope"), F.round(F.col("intercept") / 1000, 3).alias("intercept"))


@query("A31_spearman", "+r AS (SELECT event_type, rank() OVER (PARTITION BY event_type ORDER BY value) + (count(*) OVER (PARTITION BY event_type, value) - 1) / 2 AS x, rank() OVER (PARTITION BY event_type ORDER BY k) + (count(*) OVER (PARTITION BY event_type, k) - 1) / 2 AS y FROM obs) SELECT event_type, round(corr(x, y), 6) AS rho, count(*) AS n FROM r GROUP BY 1")
def a31(spark, d):
    return stats.spearman(obs(spark, d), "value", "k", ["event_type"]).withColumn("rho", r6("rho"))


@query("A32_model_errors", "SELECT event_type, round(sqrt(avg((value - k) * (value - k))), 6) AS rmse, round(avg(value) - avg(k), 6) AS bias, count(value + k) AS n FROM obs GROUP BY 1")
def a32(spark, d):
    return stats.model_errors(obs(spark, d), "value", "k", ["event_type"]).withColumns({"rmse": r6("rmse"), "bias": r6("bias")})


@query("A33_coarse_grid", "SELECT event_type, floor(value / 25) * 25 AS lat_bin, floor(k / 25) * 25 AS lon_bin, round(sum(value), 6) AS value FROM obs GROUP BY 1, 2, 3")
def a33(spark, d):
    rows = obs(spark, d).withColumns({"lat": F.col("value"), "lon": F.col("k")})
    return stats.coarsen_grid(rows, "value", 25.0, ["event_type"]).select("event_type", F.col("lat_bin").cast("double").alias("lat_bin"), F.col("lon_bin").cast("double").alias("lon_bin"), r6("value").alias("value"))


@query("A34_mean_of_duplicates", "SELECT epoch(date_trunc('hour', dtm))::BIGINT AS start, round(avg(value), 6) AS value, arg_min(event_type, event_id) AS event_type FROM obs GROUP BY 1")
def a34(spark, d):
    rows = obs(spark, d).select(F.date_trunc("hour", "dtm").alias("t"), "value", "event_type", "event_id")
    return merge.mean_of_duplicates(rows, "t", "event_id").select(sec("t").alias("start"), r6("value").alias("value"), "event_type")


@query("A35_summary", "SELECT count(value) AS n, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std, min(value) AS low, max(value) AS high FROM obs")
def a35(spark, d):
    return obs(spark, d).agg(F.count("value").alias("n"), r6(F.avg("value")).alias("mean"), r6(F.stddev_samp("value")).alias("std"), F.min("value").alias("low"), F.max("value").alias("high"))


@query("A36_similarity", "SELECT event_type, count(*) AS rows, epoch_us(min(dtm)) // 1000000 AS first, epoch_us(max(dtm)) // 1000000 AS last, min(value) AS min, max(value) AS max, round(avg(value), 6) AS mean FROM obs GROUP BY 1")
def a36(spark, d):
    out = availability.similarity(obs(spark, d), "event_type", "dtm", "value").drop("content")
    return out.withColumns({"first": sec("first"), "last": sec("last"), "mean": r6("mean")})


@query("A37_files_per_day", "SELECT substr(file_name, 1, 6) AS instrument, CAST(strptime(substr(file_name, 8, 8), '%Y%m%d')::DATE AS VARCHAR) AS date, count(*) AS files FROM (SELECT DISTINCT file_name FROM thermo_lines) GROUP BY 1, 2", with_obs=False)
def a37(spark, d):
    names = table(spark, d, "thermo_lines").select("file_name").distinct()
    return availability.files_per_day(names, "file_name", F.substring("file_name", 1, 6), timeparse.file_name_date(F.col("file_name"))).withColumn("date", F.col("date").cast("string"))


@query("A38_temporal_coverage", "+h AS (SELECT event_type, CAST(date_trunc('hour', dtm) AS DATE) AS d, count(DISTINCT date_trunc('hour', dtm)) AS bins FROM obs GROUP BY 1, 2), l AS (SELECT event_type, max(d) AS last FROM h GROUP BY 1) SELECT event_type, round(count(*) / 10, 6) AS share, sum(bins)::BIGINT AS bins FROM h JOIN l USING (event_type) WHERE d > last - 10 GROUP BY 1")
def a38(spark, d):
    return availability.temporal_coverage(obs(spark, d), "dtm", "hour", 10, ["event_type"]).withColumn("share", r6("share"))


@query("A39_extremes", "SELECT event_type, min(value) AS low, min(us) FILTER (WHERE value = lo) AS low_at, max(value) AS high, min(us) FILTER (WHERE value = hi) AS high_at FROM (SELECT *, min(value) OVER (PARTITION BY event_type) AS lo, max(value) OVER (PARTITION BY event_type) AS hi FROM obs) GROUP BY 1")
def a39(spark, d):
    out = stats.extremes(obs(spark, d), "value", "dtm", ["event_type"])
    return out.withColumns({"low_at": F.unix_micros("low_at"), "high_at": F.unix_micros("high_at")})


_HOURLY = "+h AS (SELECT us // 3600000000 AS hour, avg(value) FILTER (WHERE event_type = 'click') AS a, avg(value) FILTER (WHERE event_type = 'view') AS b, avg(value) FILTER (WHERE event_type = 'error') AS c FROM obs GROUP BY 1) "


def _hourly(spark: SparkSession, d: str) -> DataFrame:
    on = lambda kind: F.avg(F.when(F.col("event_type") == kind, F.col("value")))
    return obs(spark, d).groupBy(F.floor(F.col("us") / 3_600_000_000).alias("hour")).agg(on("click").alias("a"), on("view").alias("b"), on("error").alias("c"))


@query("A40_apportion", _HOURLY + "SELECT hour, round(a, 6) AS stacked_a, round(a + b, 6) AS stacked_b, round(a + b + 1, 6) AS modelled, round(c - a - b - 1, 6) AS residual FROM h")
def a40(spark, d):
    out = stats.apportion(_hourly(spark, d).withColumn("base", F.lit(1.0)), ["a", "b"], "base", "c")
    return out.select("hour", r6("stacked_a").alias("stacked_a"), r6("stacked_b").alias("stacked_b"), r6("modelled").alias("modelled"), r6("residual").alias("residual"))


@query("A41_category_groups", "SELECT us // 86400000000 AS day, CASE WHEN event_type IN ('click', 'view') THEN 'use' ELSE 'trouble' END AS \"group\", round(sum(value), 6) AS value FROM obs WHERE event_type IN ('click', 'view', 'error') GROUP BY 1, 2")
def a41(spark, d):
    rows = obs(spark, d).withColumn("day", F.floor(F.col("us") / 86_400_000_000))
    return stats.group_categories(rows, "event_type", "value", {"use": ["click", "view"], "trouble": ["error"]}, ["day"]).withColumn("value", r6("value"))


@query("A42_ratio_by_day", "+x AS (SELECT us // 86400000000 AS day, avg(value) AS v, avg(k) AS k FROM obs GROUP BY 1) SELECT day, round(v / k, 6) AS ratio FROM x WHERE v > 0 AND k > 0")
def a42(spark, d):
    x = obs(spark, d).groupBy(F.floor(F.col("us") / 86_400_000_000).alias("day")).agg(F.avg("value").alias("v"), F.avg("k").alias("k"))
    return x.filter((F.col("v") > 0) & (F.col("k") > 0)).select("day", r6(F.col("v") / F.col("k")).alias("ratio"))


# --- predicates and projections --------------------------------------------------------------------------------------------
@query("P01_valid", f"SELECT event_id, {_GOOD} AS value FROM obs")
def p01(spark, d):
    return obs(spark, d).select("event_id", validity.only_valid(F.col("value"), F.col("f")).alias("value"))


@query("P05_discovered_column", "SELECT event_id, value * 2 AS scaled FROM obs")
def p05(spark, d):
    rows = obs(spark, d).withColumnRenamed("value", "PM2.5 Conc")
    found = columns.discover(["pm25_conc"], rows.columns)
    return rows.select("event_id", (F.col(f"`{found}`") * 2).alias("scaled"))


@query("P06_mask_range", "SELECT event_id, CASE WHEN NOT (dtm BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-12') THEN value END AS value FROM obs")
def p06(spark, d):
    return obs(spark, d).select("event_id", validity.mask_range(F.col("value"), F.col("dtm"), "2024-01-05", "2024-01-12").alias("value"))


@query("P07_mask_negative", "SELECT event_id, CASE WHEN value - 100 >= 0 THEN value - 100 END AS value FROM obs")
def p07(spark, d):
    return obs(spark, d).select("event_id", validity.mask_negative(F.col("value") - 100).alias("value"))


@query("P08_drop_empty_columns", "SELECT event_id, k FROM obs")
def p08(spark, d):
    return validity.drop_empty_columns(obs(spark, d).select("event_id", "k", F.lit(None).cast("double").alias("gone")))


@query("P09_rename_suffixes", "SELECT event_id, value AS treh0, k AS fa10h0 FROM obs")
def p09(spark, d):
    return validity.rename_suffixes(obs(spark, d).select("event_id", F.col("value").alias("tres0"), F.col("k").alias("fa10z0")))


@query("P11_any_flagged", "SELECT event_id, f FROM obs WHERE coalesce(f > 0, false) OR coalesce(state > 3, false)")
def p11(spark, d):
    rows = obs(spark, d).withColumns({"f_value": F.col("f"), "f_k": F.when(F.col("state") > 3, F.col("state"))})
    return rows.filter(validity.any_flagged(rows)).select("event_id", "f")


@query("P12_recode", "SELECT event_id, CASE state WHEN 0 THEN 1.0 WHEN 1 THEN 0.0 WHEN 2 THEN 0.5 ELSE state END::DOUBLE AS share FROM obs")
def p12(spark, d):
    return obs(spark, d).select("event_id", validity.recode(F.col("state").cast("double"), {0.0: 1.0, 1.0: 0.0, 2.0: 0.5}).alias("share"))


@query("P13_pressure_window", "SELECT event_id, value FROM obs WHERE value > 100 - 5 AND value < 100 + 5")
def p13(spark, d):
    return profiles.pressure_window(obs(spark, d), "value", 100, 5).select("event_id", "value")


@query("P14_night_hours", "SELECT event_id, hour(dtm)::INTEGER AS hour FROM obs WHERE hour(dtm) IN (21, 22, 23, 0, 1, 2, 3, 4)")
def p14(spark, d):
    return obs(spark, d).withColumn("hour", F.hour("dtm")).filter(F.col("hour").isin(21, 22, 23, 0, 1, 2, 3, 4)).select("event_id", "hour")


@query("P15_without_events", "+e AS (SELECT DISTINCT us // 3600000000 AS hour FROM obs WHERE value > 300), h AS (SELECT us // 3600000000 AS hour, avg(value) AS value FROM obs GROUP BY 1) SELECT h.hour, CASE WHEN e.hour IS NULL THEN round(h.value, 6) END AS value FROM h LEFT JOIN e USING (hour)")
def p15(spark, d):
    rows = obs(spark, d).withColumn("hour", F.floor(F.col("us") / 3_600_000_000))
    h = rows.groupBy("hour").agg(F.avg("value").alias("value"))
    return joins.without_events(h, rows.filter("value > 300"), "hour", ["value"]).select("hour", r6("value").alias("value"))


@query("P16_box", "SELECT event_id FROM obs WHERE dtm > TIMESTAMP '2024-01-05' AND dtm < TIMESTAMP '2024-01-12' AND value > 20 AND value < 90")
def p16(spark, d):
    return obs(spark, d).filter(validity.box(F.col("dtm"), F.col("value"), "2024-01-05", "2024-01-12", 20, 90)).select("event_id")


# --- joins ---------------------------------------------------------------------------------------------------------------
def _of(spark: SparkSession, d: str, kind: str, name: str) -> DataFrame:
    return obs(spark, d).filter(F.col("event_type") == kind).groupBy(F.floor(F.col("us") / 3_600_000_000).alias("hour")).agg(r6(F.avg("value")).alias(name))


def _cte(kind: str, name: str) -> str:
    return f"{name}_t AS (SELECT us // 3600000000 AS hour, round(avg(value), 6) AS {name} FROM obs WHERE event_type = '{kind}' GROUP BY 1)"


_ABC = "+" + ", ".join([_cte("click", "a"), _cte("view", "b"), _cte("error", "c")])


@query("J01_outer_chain", _ABC + " SELECT coalesce(coalesce(a_t.hour, b_t.hour), c_t.hour) AS hour, a, b, c FROM a_t FULL JOIN b_t ON a_t.hour = b_t.hour FULL JOIN c_t ON coalesce(a_t.hour, b_t.hour) = c_t.hour")
def j01(spark, d):
    return joins.outer_chain([_of(spark, d, "click", "a"), _of(spark, d, "view", "b"), _of(spark, d, "error", "c")], ["hour"])


@query("J02_inner", _ABC + " SELECT hour, a, b FROM a_t JOIN b_t USING (hour)")
def j02(spark, d):
    return joins.align([_of(spark, d, "click", "a"), _of(spark, d, "view", "b")], "inner")


@query("J03_fill_gaps", _ABC + ", g AS (SELECT unnest(generate_series((SELECT min(hour) FROM a_t), (SELECT max(hour) FROM a_t))) AS hour) SELECT hour * 3600 AS start, a FROM g LEFT JOIN a_t USING (hour)")
def j03(spark, d):
    a = _of(spark, d, "click", "a").select(F.timestamp_seconds(F.col("hour") * 3600).alias("t"), "a")
    return joins.fill_gaps(a, "t", "1 HOUR").select(sec("t").alias("start"), "a")


@query("J04_align", _ABC + " SELECT hour, a, b FROM a_t FULL JOIN b_t USING (hour)")
def j04(spark, d):
    return joins.align([_of(spark, d, "click", "a"), _of(spark, d, "view", "b")])


@query("J05_back_to_detail", "SELECT event_id, min(us) OVER (PARTITION BY user_id) AS first_us FROM obs")
def j05(spark, d):
    return obs(spark, d).select("event_id", F.min("us").over(Window.partitionBy("user_id")).alias("first_us"))


@query("J07_common_keys", _ABC + " SELECT hour, a FROM a_t WHERE hour IN (SELECT hour FROM c_t)")
def j07(spark, d):
    return joins.common_keys(_of(spark, d, "click", "a"), _of(spark, d, "error", "c"), ["hour"])[0]


@query("J08_look_up", "SELECT s_suppkey, s_name, n_name FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey", with_obs=False)
def j08(spark, d):
    names = table(spark, d, "nation").select("n_nationkey", "n_name")
    return joins.look_up(table(spark, d, "supplier").select("s_suppkey", "s_name", "s_nationkey"), names, "s_nationkey", "n_nationkey").drop("s_nationkey")


@query("J09_nearest_grid_point", "+g AS (SELECT *, floor(value / 10) * 10 AS lat, floor(k / 10) * 10 AS lon FROM obs) SELECT event_id, lat, lon FROM g WHERE lat = (SELECT lat FROM g ORDER BY abs(lat - 37.2), lat LIMIT 1) AND lon = (SELECT lon FROM g ORDER BY abs(lon - 52.9), lon LIMIT 1)")
def j09(spark, d):
    g = obs(spark, d).select("event_id", (F.floor(F.col("value") / 10) * 10).cast("double").alias("lat"), (F.floor(F.col("k") / 10) * 10).cast("double").alias("lon"))
    return joins.nearest_grid_point(g, 37.2, 52.9)


_COARSE = """+h AS (SELECT epoch(date_trunc('hour', dtm))::BIGINT AS t, avg(value) AS value FROM obs GROUP BY 1),
c AS (SELECT epoch(date_trunc('day', dtm))::BIGINT AS t, quantile_cont(value, 0.1) AS b FROM obs GROUP BY 1),
j AS (SELECT coalesce(h.t, c.t) AS t, value, b, h.t IS NOT NULL AS fine FROM h FULL JOIN c ON h.t = c.t),
n AS (SELECT *, last_value(b IGNORE NULLS) OVER p AS x0, last_value(CASE WHEN b IS NOT NULL THEN t END IGNORE NULLS) OVER p AS p0,
             first_value(b IGNORE NULLS) OVER q AS x1, first_value(CASE WHEN b IS NOT NULL THEN t END IGNORE NULLS) OVER q AS p1
      FROM j WINDOW p AS (ORDER BY t ROWS UNBOUNDED PRECEDING), q AS (ORDER BY t ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
i AS (SELECT t, value, coalesce(b, x0 + (x1 - x0) * (t - p0)::DOUBLE / nullif(p1 - p0, 0)) AS background FROM n WHERE fine)
SELECT t AS start, round(value, 6) AS value, round(background, 6) AS background, round(value - background, 6) AS delta FROM i"""


@query("J10_over_background", _COARSE)
def j10(spark, d):
    rows = obs(spark, d)
    fine = rows.groupBy(F.date_trunc("hour", "dtm").alias("t")).agg(F.avg("value").alias("value"))
    coarse = rows.groupBy(F.date_trunc("day", "dtm").alias("t")).agg(F.percentile("value", 0.1).alias("background"))
    return joins.over_background(fine, coarse, "t", "value", "background").select(sec("t").alias("start"), r6("value").alias("value"), r6("background").alias("background"), r6("delta").alias("delta"))


@query("J11_outer_suffix", _ABC + " SELECT coalesce(x.hour, y.hour) AS hour, x.a AS v, y.b AS v_right FROM a_t x FULL JOIN b_t y ON x.hour = y.hour")
def j11(spark, d):
    return joins.outer_with_suffix(_of(spark, d, "click", "v"), _of(spark, d, "view", "v"), ["hour"])


@query("J12_as_of", "SELECT l.event_id, r.value AS before FROM (SELECT * FROM obs WHERE event_type = 'click') l ASOF LEFT JOIN (SELECT * FROM obs WHERE event_type = 'error') r ON l.user_id = r.user_id AND l.us >= r.us")
def j12(spark, d):
    rows = obs(spark, d)
    left = rows.filter("event_type = 'click'").select("user_id", "us", "event_id")
    right = rows.filter("event_type = 'error'").select("user_id", "us", F.col("value").alias("before"))
    return joins.as_of(left, right, "us", ["user_id"], ["before"]).select("event_id", "before")


@query("R28_mean_of_available", _ABC + " SELECT hour, round((coalesce(a, 0) + coalesce(b, 0)) / ((a IS NOT NULL)::INTEGER + (b IS NOT NULL)::INTEGER), 9) AS mean FROM a_t FULL JOIN b_t USING (hour)")
def r28(spark, d):
    both = joins.align([_of(spark, d, "click", "a"), _of(spark, d, "view", "b")])
    return both.select("hour", F.round(joins.mean_of_available(F.col("a"), F.col("b")), 9).alias("mean"))
