"""Queries of the row-order, flag, merge, time and physics operators over the driver's tables, each with its SQL."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from aerolake.functions import numeric, timeparse
from aerolake.operators import flags, merge, profiles, stats, windows
from aerolake.operators.joins import with_scalars
from aerolake.operators.validity import only_valid
from aerolake.plans.reference import _GOOD, obs, query, r6, sec
from aerolake.session import table

_BY_USER = "OVER (PARTITION BY user_id ORDER BY us, event_id)"
_BY_TYPE = "OVER (PARTITION BY event_type ORDER BY us, event_id)"


def by_user():
    return windows.ordered(["user_id"], "us", "event_id")


def by_type():
    return windows.ordered(["event_type"], "us", "event_id")


# --- windows ---------------------------------------------------------------------------------------------------------------
@query("W01_difference_and_change", f"SELECT event_id, round(value - lag(value) {_BY_USER}, 6) AS diff, coalesce(state <> lag(state) {_BY_USER}, false) AS changed FROM obs")
def w01(spark, d):
    w = by_user()
    return obs(spark, d).select("event_id", r6(F.col("value") - F.lag("value").over(w)).alias("diff"), F.coalesce(F.col("state") != F.lag("state").over(w), F.lit(False)).alias("changed"))


@query("W03_after_return", f"+p AS (SELECT *, lag(state) {_BY_USER} AS was FROM obs), r AS (SELECT *, CASE WHEN state = 0 AND was <> 0 THEN us END AS ret FROM p), l AS (SELECT *, last_value(ret IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY us, event_id ROWS UNBOUNDED PRECEDING) AS since FROM r) SELECT event_id, CASE WHEN state = 0 AND us - since <= 36000000000 THEN 2 END AS flag FROM l")
def w03(spark, d):
    return obs(spark, d).select("event_id", windows.after_return(F.col("state"), F.col("dtm"), by_user(), minutes=600).alias("flag"))


@query("W04_after_any_change", f"+p AS (SELECT *, lag(state) {_BY_USER} AS was, row_number() {_BY_USER} AS n FROM obs), r AS (SELECT *, CASE WHEN n > 1 AND state IS DISTINCT FROM was THEN us END AS ch FROM p), l AS (SELECT *, last_value(ch IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY us, event_id ROWS UNBOUNDED PRECEDING) AS since FROM r) SELECT event_id, coalesce(us - since <= 36000000000, false) AS unsettled FROM l")
def w04(spark, d):
    return obs(spark, d).select("event_id", windows.after_any_change(F.col("state"), F.col("dtm"), by_user(), minutes=600).alias("unsettled"))


@query("W05_forward_fill", f"SELECT event_id, last_value({_GOOD} IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY us, event_id ROWS UNBOUNDED PRECEDING) AS value FROM obs")
def w05(spark, d):
    return obs(spark, d).withColumn("v", only_valid(F.col("value"), F.col("f"))).select("event_id", windows.forward_fill(F.col("v"), by_user()).alias("value"))


@query("W06_rolling_median", f"SELECT event_id, round(quantile_cont(value, 0.5) OVER (PARTITION BY event_type ORDER BY us, event_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 6) AS value FROM obs")
def w06(spark, d):
    return obs(spark, d).select("event_id", r6(windows.rolling_median(F.col("value"), by_type())).alias("value"))


@query("W07_running_sum", "SELECT event_id, round(sum(k) OVER (PARTITION BY event_type, CAST(dtm AS DATE) ORDER BY us, event_id ROWS UNBOUNDED PRECEDING), 6) AS total FROM obs")
def w07(spark, d):
    rows = obs(spark, d).withColumn("day", F.to_date("dtm"))
    return rows.select("event_id", r6(windows.running_sum(F.col("k"), windows.ordered(["event_type", "day"], "us", "event_id"))).alias("total"))


@query("W08_centred_mean", "SELECT event_id, CASE WHEN count(value) OVER w >= 5 THEN round(avg(value) OVER w, 6) END AS value FROM obs WINDOW w AS (PARTITION BY event_type ORDER BY us, event_id ROWS BETWEEN 4 PRECEDING AND 3 FOLLOWING)")
def w08(spark, d):
    return obs(spark, d).select("event_id", r6(windows.rolling_mean_centred(F.col("value"), by_type(), 8, 5)).alias("value"))


@query("W09_interpolate", f"+g AS (SELECT *, {_GOOD} AS v FROM obs), n AS (SELECT *, last_value(v IGNORE NULLS) OVER a AS x0, last_value(CASE WHEN v IS NOT NULL THEN us END IGNORE NULLS) OVER a AS p0, first_value(v IGNORE NULLS) OVER b AS x1, first_value(CASE WHEN v IS NOT NULL THEN us END IGNORE NULLS) OVER b AS p1 FROM g WINDOW a AS (PARTITION BY user_id ORDER BY us, event_id ROWS UNBOUNDED PRECEDING), b AS (PARTITION BY user_id ORDER BY us, event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) SELECT event_id, round(coalesce(v, x0 + (x1 - x0) * (us - p0)::DOUBLE / nullif(p1 - p0, 0)), 5) AS value FROM n")
def w09(spark, d):
    rows = obs(spark, d).withColumn("v", only_valid(F.col("value"), F.col("f")))
    return rows.select("event_id", F.round(windows.interpolate(F.col("v"), F.col("us").cast("double"), by_user()), 5).alias("value"))


@query("W10_background_quantile", "SELECT event_id, round(quantile_cont(value, 0.1) OVER (PARTITION BY event_type ORDER BY us, event_id ROWS BETWEEN 540 PRECEDING AND 539 FOLLOWING), 6) AS background FROM obs")
def w10(spark, d):
    """1080 rows: 45 days of hours."""
    return windows.rolling_quantile(obs(spark, d).select("event_id", "event_type", "dtm", "value"), ["event_type"], "dtm", "event_id", "value", 1080, 0.1, "background").select("event_id", r6("background").alias("background"))


STEPS = """+m AS (SELECT *, quantile_cont(COLUMN, 0.5) OVER (PARTITION BY event_type ORDER BY us, event_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS md FROM obs),
d AS (SELECT *, md - lag(md) OVER (PARTITION BY event_type ORDER BY us, event_id) AS df FROM m),
a AS (SELECT event_type, abs(df) AS a FROM d WHERE df IS NOT NULL),
r AS (SELECT event_type, a, row_number() OVER (PARTITION BY event_type ORDER BY a) - 1 AS i, count(*) OVER (PARTITION BY event_type) AS n FROM a),
q AS (SELECT event_type, max(a) AS q FROM r WHERE i = round(QUANTILE * (n - 1)) GROUP BY 1),
c AS (SELECT event_type, median(a) AS c FROM a GROUP BY 1),
mad AS (SELECT event_type, median(abs(a - c)) AS mad FROM a JOIN c USING (event_type) GROUP BY 1),
e AS (SELECT event_id, event_type, us, CASE WHEN df > greatest(q, 6 * mad, 1e-12) THEN 1 WHEN df < -greatest(q, 6 * mad, 1e-12) THEN -1 ELSE 0 END AS event FROM d JOIN q USING (event_type) JOIN mad USING (event_type)),
s AS (SELECT event_id, event, coalesce(last_value(nullif(event, 0) IGNORE NULLS) OVER (PARTITION BY event_type ORDER BY us, event_id ROWS UNBOUNDED PRECEDING), 0) AS state FROM e) """


@query("W11_step_events", STEPS.replace("COLUMN", "value").replace("QUANTILE", "0.9") + "SELECT event_id, event, state FROM s")
def w11(spark, d):
    return windows.step_events(obs(spark, d), ["event_type"], ["us", "event_id"], "value", 0.9).select("event_id", "event", "state")


@query("W12_meter_clock")
def w12(spark, d):
    rows = obs(spark, d).select("user_id", "event_id", F.date_trunc("hour", "dtm").alias("t"))
    return windows.repair_meter_clock(rows, ["user_id"], "t", "event_id").withColumn("t", sec("t"))


@query("W13_first_of_group", f"SELECT user_id, event_id FROM (SELECT *, row_number() {_BY_USER} AS r FROM obs) WHERE r = 1")
def w13(spark, d):
    return merge.keep_one(obs(spark, d), ["user_id"], F.asc("us"), F.asc("event_id")).select("user_id", "event_id")


@query("W14_stride_sample", "+r AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY us, event_id) AS i, count(*) OVER (PARTITION BY event_type) AS n FROM obs) SELECT event_type, event_id FROM r WHERE (i - 1) % greatest(1, ceil(n / 300))::BIGINT = 0 OR i = n")
def w14(spark, d):
    return windows.stride_sample(obs(spark, d), ["event_type"], ["us", "event_id"], 300).select("event_type", "event_id")


@query("W15_attenuation", f"+t AS (SELECT *, CASE WHEN value + 1 > 0 THEN -100 * ln((value + 1) / (k + 1)) END AS raw FROM obs), c AS (SELECT *, CASE WHEN row_number() {_BY_USER} = 1 THEN 0 ELSE (state IS DISTINCT FROM lag(state) {_BY_USER})::INTEGER END AS ch FROM t), s AS (SELECT *, sum(ch) OVER (PARTITION BY user_id ORDER BY us, event_id ROWS UNBOUNDED PRECEDING) AS spot FROM c) SELECT event_id, round(raw - first_value(raw) OVER (PARTITION BY user_id, spot ORDER BY us, event_id), 6) AS atn FROM s")
def w15(spark, d):
    rows = obs(spark, d).withColumns({"sens": F.col("value") + 1, "ref": F.col("k") + 1})
    return windows.attenuation(rows, ["user_id"], ["us", "event_id"], "sens", "ref", "state").select("event_id", r6("atn").alias("atn"))


@query("W16_trapezoid", f"+p AS (SELECT *, (value + lag(value) {_BY_USER}) / 2 * (us - lag(us) {_BY_USER})::DOUBLE / 3.6e9 AS piece FROM obs) SELECT event_id, round(coalesce(sum(piece) OVER (PARTITION BY user_id ORDER BY us, event_id ROWS UNBOUNDED PRECEDING), 0), 4) AS integral FROM p")
def w16(spark, d):
    rows = obs(spark, d).withColumn("hours", F.col("us") / 3.6e9)
    return windows.trapezoid_sum(rows, ["user_id"], ["us", "event_id"], "value", "hours").select("event_id", F.round("integral", 4).alias("integral"))


_PASSES = "".join(f", s{i} AS (SELECT event_id, event_type, us, CASE WHEN lag(y) OVER w IS NULL OR lead(y) OVER w IS NULL THEN y ELSE (lag(y) OVER w + 2 * y + lead(y) OVER w) / 4 END AS y FROM s{i - 1} WINDOW w AS (PARTITION BY event_type ORDER BY us, event_id))" for i in range(1, 11))


@query("W18_smooth_kernel", f"+s0 AS (SELECT event_id, event_type, us, value AS y FROM obs){_PASSES} SELECT event_id, round(y, 6) AS smooth FROM s10")
def w18(spark, d):
    rows = obs(spark, d).select("event_type", "dtm", "event_id", "value")
    return windows.smooth_kernel(rows, ["event_type"], "dtm", "event_id", "value").select("event_id", r6("smooth").alias("smooth"))


# --- order and limits --------------------------------------------------------------------------------------------------------
@query("T02_mixed_order", "SELECT event_id, row_number() OVER (PARTITION BY event_type ORDER BY f DESC NULLS FIRST, us, event_id) AS place FROM obs")
def t02(spark, d):
    w = Window.partitionBy("event_type").orderBy(F.desc_nulls_first("f"), "us", "event_id")
    return obs(spark, d).select("event_id", F.row_number().over(w).cast("long").alias("place"))


@query("T03_top_by_count", "SELECT user_id, count(*) AS n FROM obs GROUP BY 1 ORDER BY n DESC, user_id LIMIT 1")
def t03(spark, d):
    return obs(spark, d).groupBy("user_id").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "user_id").limit(1)


@query("T04_newest_rows", "SELECT event_id, us FROM obs ORDER BY us DESC, event_id DESC LIMIT 100")
def t04(spark, d):
    return obs(spark, d).select("event_id", "us").orderBy(F.desc("us"), F.desc("event_id")).limit(100)


# --- unions, duplicates, merges -------------------------------------------------------------------------------------------------
@query("U01_union_by_name", "SELECT event_id, value, NULL::BIGINT AS user_id FROM obs WHERE event_type = 'click' UNION ALL SELECT event_id, NULL, user_id FROM obs WHERE event_type = 'view'")
def u01(spark, d):
    rows = obs(spark, d)
    return merge.relaxed_union(rows.filter("event_type = 'click'").select("event_id", "value"), rows.filter("event_type = 'view'").select("event_id", "user_id"))


@query("U02_relaxed_union", "SELECT event_id, CAST(state AS DOUBLE) AS x, CAST(user_id AS VARCHAR) AS y FROM obs UNION ALL SELECT event_id, value, event_type FROM obs")
def u02(spark, d):
    rows = obs(spark, d)
    return merge.relaxed_union(rows.select("event_id", F.col("state").alias("x"), F.col("user_id").alias("y")), rows.select("event_id", F.col("value").alias("X"), F.col("event_type").alias("Y")))


@query("U03_common_keys", "SELECT user_id FROM obs WHERE event_type = 'click' INTERSECT SELECT user_id FROM obs WHERE event_type = 'error'")
def u03(spark, d):
    rows = obs(spark, d)
    return rows.filter("event_type = 'click'").select("user_id").intersect(rows.filter("event_type = 'error'").select("user_id"))


@query("D01_distinct_rows", "SELECT DISTINCT user_id, event_type FROM obs")
def d01(spark, d):
    return obs(spark, d).select("user_id", "event_type").dropDuplicates()


@query("D02_keep_last", "SELECT user_id, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id, us // 3600000000 ORDER BY us DESC, event_id DESC) AS r FROM obs) WHERE r = 1")
def d02(spark, d):
    rows = obs(spark, d).withColumn("hour", F.floor(F.col("us") / 3_600_000_000))
    return merge.keep_last(rows, ["user_id", "hour"], ["us", "event_id"]).select("user_id", "event_id")


_DUP = "+x AS (SELECT CAST(l_shipdate AS TIMESTAMP) AS dtm, l_orderkey AS id, l_linenumber AS line, CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE l_returnflag END AS flag, l_linestatus AS status FROM lineitem) "


def _dup(spark, d):
    li = table(spark, d, "lineitem")
    return li.select(F.col("l_shipdate").cast("timestamp").alias("dtm"), F.col("l_orderkey").alias("id"), F.col("l_linenumber").alias("line"), F.when(F.col("l_linenumber") % 3 != 0, F.col("l_returnflag")).alias("flag"), F.col("l_linestatus").alias("status"))


@query("D03_classify_duplicates", _DUP + ", g AS (SELECT dtm, count(*) AS n, count(DISTINCT flag) AS df, count(flag) AS cf, count(DISTINCT status) AS ds FROM x GROUP BY 1 HAVING count(*) > 1) SELECT epoch(dtm)::BIGINT AS t, n, CASE WHEN df > 1 OR ds > 1 THEN 'conflict' WHEN cf > 0 AND cf < n THEN 'mergeable' ELSE 'exact' END AS kind, concat_ws(',', CASE WHEN df > 1 THEN 'flag' END, CASE WHEN ds > 1 THEN 'status' END) AS conflicting_columns FROM g")
def d03(spark, d):
    return merge.classify_duplicates(_dup(spark, d).drop("id", "line")).select(sec("dtm").alias("t"), "n", "kind", "conflicting_columns")


@query("D04_resolve_duplicates", _DUP + ", g AS (SELECT *, count(*) OVER w AS n, coalesce(min(flag) OVER w <> max(flag) OVER w, false) OR coalesce(min(status) OVER w <> max(status) OVER w, false) AS conflict, min(flag) OVER w AS lo, max(flag) OVER w AS hi, row_number() OVER (PARTITION BY dtm ORDER BY id, line) AS r FROM x WINDOW w AS (PARTITION BY dtm)) SELECT epoch(dtm)::BIGINT AS t, id, line, CASE WHEN n = 1 OR conflict THEN flag ELSE coalesce(flag, CASE WHEN lo = hi THEN lo END) END AS flag, status FROM g WHERE n = 1 OR conflict OR r = 1")
def d04(spark, d):
    out = merge.resolve_duplicates(_dup(spark, d), ["id", "line"])
    return out.select(sec("dtm").alias("t"), "id", "line", "flag", "status")


def _sides(spark, d):
    rows = obs(spark, d).withColumn("hour", F.floor(F.col("us") / 3_600_000_000))
    pick = lambda kind: merge.keep_one(rows.filter(F.col("event_type") == kind), ["hour"], F.asc("us")).select("hour", "value", "f", F.col("k").alias("mrid"))
    return pick("click"), pick("error")


_SIDES = "+x AS (SELECT event_type, us // 3600000000 AS hour, value, f, k AS mrid, row_number() OVER (PARTITION BY event_type, us // 3600000000 ORDER BY us) AS r FROM obs), a AS (SELECT * FROM x WHERE event_type = 'click' AND r = 1), b AS (SELECT * FROM x WHERE event_type = 'error' AND r = 1) "


@query("D05_merge_by_rank", _SIDES + "SELECT coalesce(a.hour, b.hour) AS hour, CASE WHEN b.hour IS NULL OR a.mrid >= b.mrid THEN a.value ELSE b.value END AS value, greatest(a.mrid, b.mrid) AS mrid FROM a FULL JOIN b ON a.hour = b.hour")
def d05(spark, d):
    a, b = _sides(spark, d)
    return merge.merge_keyed(a, b, ["hour"], "existing", "mrid").select("hour", "value", "mrid")


@query("D06_existing_wins", _SIDES + "SELECT coalesce(a.hour, b.hour) AS hour, CASE WHEN a.hour IS NOT NULL THEN a.value ELSE b.value END AS value FROM a FULL JOIN b ON a.hour = b.hour")
def d06(spark, d):
    a, b = _sides(spark, d)
    return merge.merge_keyed(a, b, ["hour"]).select("hour", "value")


@query("D07_append_new", "+x AS (SELECT event_id, us FROM obs WHERE dtm < TIMESTAMP '2024-01-15') SELECT * FROM x UNION ALL SELECT event_id, us FROM obs WHERE us > (SELECT max(us) FROM x)")
def d07(spark, d):
    rows = obs(spark, d).select("event_id", "us")
    cut = F.unix_micros(F.lit("2024-01-15").cast("timestamp"))
    return merge.append_new(rows.filter(F.col("us") < cut), rows, "us")


@query("D08_backfill", _SIDES + "SELECT coalesce(a.hour, b.hour) AS hour, CASE WHEN a.hour IS NULL THEN b.value ELSE a.value END AS value, CASE WHEN a.hour IS NULL THEN b.f WHEN a.f IS NULL AND b.f IS NOT NULL AND false THEN b.f ELSE a.f END AS f_value, a.hour IS NULL AS is_new FROM a FULL JOIN b ON a.hour = b.hour")
def d08(spark, d):
    a, b = (x.withColumnRenamed("f", "f_value") for x in _sides(spark, d))
    return merge.backfill(a, b, ["hour"]).select("hour", "value", "f_value", "is_new")


@query("D09_first_file_wins", "+m AS (SELECT *, min(l_orderkey) OVER (PARTITION BY l_shipdate) AS first FROM lineitem) SELECT l_orderkey, l_linenumber FROM m WHERE l_orderkey = first")
def d09(spark, d):
    return merge.first_file_wins(table(spark, d, "lineitem"), ["l_shipdate"], "l_orderkey").select("l_orderkey", "l_linenumber")


# --- time functions ----------------------------------------------------------------------------------------------------------------
@query("F01_parse_timestamps", "SELECT row_id, epoch(coalesce(try_strptime(datetime_1, '%Y-%m-%d %H:%M:%S'), try_strptime(datetime_1, '%m/%d/%Y %I:%M:%S %p')))::BIGINT AS t FROM ae33", with_obs=False)
def f01(spark, d):
    return table(spark, d, "ae33").select("row_id", sec(timeparse.parse_timestamp(F.col("datetime_1"))).alias("t"))


@query("F03_truncate", "SELECT event_id, epoch(date_trunc('hour', dtm))::BIGINT AS hour, CAST(CAST(dtm AS DATE) AS VARCHAR) AS day FROM obs")
def f03(spark, d):
    return obs(spark, d).select("event_id", sec(F.date_trunc("hour", "dtm")).alias("hour"), F.to_date("dtm").cast("string").alias("day"))


@query("F04_parts", "SELECT event_id, year(dtm)::INTEGER AS y, month(dtm)::INTEGER AS m, day(dtm)::INTEGER AS d, hour(dtm)::INTEGER AS h, minute(dtm)::INTEGER AS mi, isodow(dtm)::INTEGER - 1 AS wd, dayofyear(dtm)::INTEGER AS yd FROM obs")
def f04(spark, d):
    t = F.col("dtm")
    return obs(spark, d).select("event_id", F.year(t).alias("y"), F.month(t).alias("m"), F.dayofmonth(t).alias("d"), F.hour(t).alias("h"), F.minute(t).alias("mi"), F.weekday(t).alias("wd"), F.dayofyear(t).alias("yd"))


@query("F05_offsets", "SELECT event_id, epoch_us(dtm + INTERVAL 90 MINUTE) // 1000000 AS later FROM obs")
def f05(spark, d):
    return obs(spark, d).select("event_id", sec(F.col("dtm") + F.expr("INTERVAL 90 MINUTES")).alias("later"))


@query("F06_epoch", "SELECT event_id, us // 1000000 AS t FROM obs")
def f06(spark, d):
    return obs(spark, d).select("event_id", sec(F.timestamp_seconds(F.unix_seconds("dtm"))).alias("t"))


@query("F07_format", "SELECT event_id, strftime(dtm, '%Y-%m-%d %H:%M:%S') AS t FROM obs")
def f07(spark, d):
    return obs(spark, d).select("event_id", F.date_format("dtm", "yyyy-MM-dd HH:mm:ss").alias("t"))


@query("F08_offset_to_utc", "SELECT event_id, us // 1000000 - (3 * 60 + 30) * 60 AS t FROM obs")
def f08(spark, d):
    return obs(spark, d).select("event_id", sec(timeparse.offset_to_utc(F.col("dtm"), F.lit("UTC+03:30"))).alias("t"))


@query("F09_decimal_year_whole", "+y AS (SELECT event_id, us, year(dtm) AS y, epoch_us(date_trunc('year', dtm)) AS a, epoch_us(date_trunc('year', dtm) + INTERVAL 1 YEAR) AS b FROM obs), x AS (SELECT *, y + (us - a)::DOUBLE / (b - a)::DOUBLE AS x FROM y) SELECT event_id, round(x, 9) AS x, round((a // 1000000)::DOUBLE + (x - floor(x)) * ((b - a) // 1000000)::DOUBLE)::BIGINT AS back FROM x")
def f09_whole(spark, d):
    x = timeparse.decimal_year(F.col("dtm"))
    return obs(spark, d).select("event_id", F.round(x, 9).alias("x"), sec(timeparse.from_decimal_year(x)).alias("back"))


@query("F10_days_since_new_year", "SELECT event_id, round((us - epoch_us(TIMESTAMP '2024-01-01'))::DOUBLE / 86400e6, 6) AS days FROM obs")
def f10(spark, d):
    return obs(spark, d).select("event_id", timeparse.days_since_new_year(F.col("dtm"), F.lit(2024)).alias("days"))


@query("F11_file_dates", "SELECT fragment_id, CAST(strptime(regexp_extract(path, '([0-9]{8})[0-9]{6}-[^/]*$', 1), '%Y%m%d')::DATE AS VARCHAR) AS day FROM level1_fragments", with_obs=False)
def f11(spark, d):
    return table(spark, d, "level1_fragments").select("fragment_id", timeparse.file_name_date(F.col("path")).cast("string").alias("day"))


@query("F12_three_hourly", "+x AS (SELECT CAST(dtm AS DATE) AS day, round(avg(value), 6) AS v FROM obs GROUP BY 1), e AS (SELECT day, v, unnest(range(8)) AS i FROM x) SELECT epoch(day)::BIGINT + i * 10800 AS t, round(v * i, 6) AS value FROM e")
def f12(spark, d):
    x = obs(spark, d).groupBy(F.to_date("dtm").alias("day")).agg(r6(F.avg("value")).alias("v"))
    x = x.withColumn("axis", timeparse.three_hourly(F.col("day"), F.array(*[r6(F.col("v") * i) for i in range(8)])))
    return x.select(F.explode("axis").alias("a")).select(sec("a.dtm").alias("t"), "a.value")


# --- physics -----------------------------------------------------------------------------------------------------------------------
@query("M02_absorption", "SELECT row_id, round(bc6 * 7.77 / 1.76 / 1000, 9) AS b6_abs, f_bc6 AS f_b6_abs FROM ae33", with_obs=False)
def m02(spark, d):
    return table(spark, d, "ae33").select("row_id", F.round(numeric.absorption(F.col("bc6"), numeric.AE33_SIGMA["BC6"]), 9).alias("b6_abs"), F.col("f_bc6").alias("f_b6_abs"))


@query("M03_angstrom_exponent", "SELECT row_id, round(CASE WHEN bc1 > 0 AND bc7 > 0 THEN -ln(bc1 / bc7) / ln(370.0 / 950.0) END, 6) AS aae FROM ae33", with_obs=False)
def m03(spark, d):
    return table(spark, d, "ae33").select("row_id", r6(numeric.angstrom_exponent(F.col("bc1"), F.col("bc7"), 370, 950)).alias("aae"))


@query("M04_single_scattering_albedo", "SELECT event_id, round((value + 10) / ((value + 10) + k * pow(550.0 / 637.0, -1.2)), 6) AS ssa FROM obs")
def m04(spark, d):
    return obs(spark, d).select("event_id", r6(numeric.single_scattering_albedo(F.col("value") + 10, F.col("k"), F.lit(1.2), 550, 637)).alias("ssa"))


@query("M05_mixing_ratio", "SELECT event_id, round(value * 1e-9 * (28.97 / 48.0) * 1e9, 8) AS ppb FROM obs")
def m05(spark, d):
    return obs(spark, d).select("event_id", F.round(numeric.mass_to_volume(F.col("value") * 1e-9, numeric.M_O3), 8).alias("ppb"))


@query("M06_column_ozone", "+x AS (SELECT user_id, event_id, value + 1 + event_id / 1e6 AS p, k AS o3 FROM obs), t AS (SELECT *, o3 * 1e-3 / (p * 100) AS r FROM x), d AS (SELECT event_id, user_id, p, (r + lag(r) OVER w) / 2 * (lag(p) OVER w - p) * 100 * (6.02214076e23 / 0.0289652 / 9.80665 / 2.69e20) AS piece FROM t WINDOW w AS (PARTITION BY user_id ORDER BY p DESC)) SELECT event_id, round(coalesce(sum(piece) OVER (PARTITION BY user_id ORDER BY p DESC ROWS UNBOUNDED PRECEDING), 0), 4) AS column_du FROM d")
def m06(spark, d):
    rows = obs(spark, d).select("user_id", "event_id", (F.col("value") + 1 + F.col("event_id") / 1e6).alias("p"), F.col("k").alias("o3"))
    return profiles.column_ozone(rows, ["user_id"], "p", "o3").select("event_id", F.round("column_du", 4).alias("column_du"))


@query("M08_anomalies", "+c AS (SELECT event_type, month(dtm) AS m, avg(value) AS mean, stddev_pop(value) AS std FROM obs GROUP BY 1, 2) SELECT event_id, round(value - mean, 6) AS anomaly, round(100 * (value - mean) / mean, 6) AS percent, round((value - mean) / std, 6) AS standardised FROM obs JOIN c ON obs.event_type = c.event_type AND month(dtm) = c.m")
def m08(spark, d):
    return stats.anomalies(obs(spark, d), "value", "dtm", ["event_type"]).select("event_id", r6("anomaly").alias("anomaly"), r6("percent").alias("percent"), r6("standardised").alias("standardised"))


@query("M09_outliers", "+a AS (SELECT *, avg(k) OVER (PARTITION BY event_type) AS ms FROM obs), b AS (SELECT * FROM a WHERE k <= 1.8 * ms), c AS (SELECT *, (value - avg(value) OVER w) / stddev_pop(value) OVER w AS z FROM b WINDOW w AS (PARTITION BY event_type)) SELECT event_id, value FROM c WHERE abs(z) < 2")
def m09(spark, d):
    return stats.drop_outliers(obs(spark, d), "value", "k", ["event_type"], 1.8, 2).select("event_id", "value")


@query("M10_clip_quantiles", "SELECT event_id, CASE WHEN value BETWEEN quantile_cont(value, 0.05) OVER w AND quantile_cont(value, 0.95) OVER w THEN value END AS value FROM obs WINDOW w AS (PARTITION BY event_type)")
def m10(spark, d):
    return stats.clip_quantiles(obs(spark, d), "value", 0.05, ["event_type"]).select("event_id", "value")


@query("M11_log_interpolation")
def m11(spark, d):
    rows = obs(spark, d).select("event_type", (F.col("value") + 1).alias("x"), "k")
    return profiles.interpolate_log(rows, ["event_type"], "x", "k", [1.5, 2.0, 5.0, 10.0, 50.0, 100.0], "linear")


@query("M12_pump_whole", "+b AS (SELECT p0, f0, lead(p0) OVER w AS p1, lead(f0) OVER w AS f1 FROM (VALUES (3, 1.24::DOUBLE), (5, 1.124), (7, 1.087), (10, 1.066), (15, 1.048), (20, 1.041), (30, 1.029), (50, 1.018), (70, 1.013), (100, 1.007), (150, 1.002), (200, 1), (1000, 1)) t(p0, f0) WINDOW w AS (ORDER BY p0)) SELECT event_id, round(k * CASE WHEN value + 1 <= 0 THEN NULL WHEN value + 1 <= 3 THEN 1.24 WHEN value + 1 > 1000 THEN 1 ELSE f0 + (ln(value + 1) - ln(p0)) * (f1 - f0) / (ln(p1) - ln(p0)) END, 5) AS corrected FROM obs LEFT JOIN b ON value + 1 > p0 AND value + 1 <= p1")
def m12_pump_whole(spark, d):
    return obs(spark, d).select("event_id", F.round(profiles.pump_corrected(F.col("k"), F.col("value") + 1), 5).alias("corrected"))


def _profiles(spark, d):
    return obs(spark, d).select("user_id", (F.col("value") + 1 + F.col("event_id") / 1e6).alias("p"), F.col("k").alias("o3"))


@query("M12_integral", "+x AS (SELECT user_id, value + 1 + event_id / 1e6 AS p, k AS o3 FROM obs), d AS (SELECT user_id, (o3 + lag(o3) OVER w) / 2 * (ln(lag(p) OVER w) - ln(p)) AS piece FROM x WINDOW w AS (PARTITION BY user_id ORDER BY p DESC)) SELECT user_id, round(0.79 * coalesce(sum(piece), 0), 6) AS integral FROM d GROUP BY 1")
def m12_integral(spark, d):
    return profiles.ozone_integral(_profiles(spark, d), ["user_id"], "p", "o3").select("user_id", r6("integral").alias("integral"))


@query("M12_residual", "+x AS (SELECT user_id, value + 1 + event_id / 1e6 AS p, k AS o3 FROM obs), t AS (SELECT *, min(p) OVER (PARTITION BY user_id) AS top FROM x) SELECT user_id, round(0.79 * avg(o3 / p) * min(top), 6) AS residual FROM t WHERE p < top + 2 GROUP BY 1")
def m12_residual(spark, d):
    return profiles.residual_ozone(_profiles(spark, d), ["user_id"], "p", "o3").select("user_id", r6("residual").alias("residual"))


@query("M13_late_correction", "+l AS (SELECT max(us) FILTER (WHERE value > 200) AS last FROM obs) SELECT event_id, CASE WHEN us <= last THEN value * 1.5 ELSE value END AS value FROM obs, l")
def m13(spark, d):
    rows = obs(spark, d)
    last = rows.agg(F.max(F.when(F.col("value") > 200, F.col("us"))).alias("last"))
    return with_scalars(rows, last).select("event_id", F.when(F.col("us") <= F.col("last"), F.col("value") * 1.5).otherwise(F.col("value")).alias("value"))


@query("M14_curve_fit")
def m14(spark, d):
    rows = obs(spark, d).select("event_type", timeparse.decimal_year(F.col("dtm")).alias("t"), "value")
    return profiles.fit_series(rows, ["event_type"], "t", "value", degree=1, harmonics=2)


@query("W17_seasonal_extremes")
def w17(spark, d):
    return profiles.seasonal_extremes(m14(spark, d), ["event_type"])


@query("M15_clean_numbers", "SELECT event_id, CASE WHEN value > 1 THEN round(ln(value), 9) END AS x, state AS flag FROM obs")
def m15(spark, d):
    x = F.when(F.col("value") > 1, F.ln("value")).otherwise(F.lit(float("nan")))
    return obs(spark, d).select("event_id", F.round(numeric.clean_number(x), 9).alias("x"), numeric.clean_flag(F.col("state").cast("string")).alias("flag"))


@query("M16_mass_concentration", "SELECT event_id, round(value * 1e-9 * (900.0 * 100 / ((k + 250) * 287.052874)) * 1e9, 6) AS c FROM obs")
def m16(spark, d):
    return obs(spark, d).select("event_id", r6(numeric.mass_concentration(F.col("value") * 1e-9, F.lit(900.0), F.col("k") + 250)).alias("c"))


@query("M17_emission_flux", "SELECT event_id, round(value / 3600.0 / nullif(k, 0) * 1000, 6) AS flux FROM obs")
def m17(spark, d):
    return obs(spark, d).select("event_id", r6(numeric.emission_flux(F.col("value"), F.col("k"), F.lit(3600.0)) * 1000).alias("flux"))


# --- text and casts ------------------------------------------------------------------------------------------------------------------
@query("C01_text", "SELECT event_id, upper(event_type[1]) || lower(event_type[2:]) AS title, regexp_replace(props, '[^0-9]', '', 'g') AS digits, concat_ws('-', event_type, user_id) AS joined FROM obs JOIN (SELECT event_id, props FROM events) USING (event_id)")
def c01(spark, d):
    e = table(spark, d, "events")
    return e.select("event_id", F.initcap("event_type").alias("title"), F.regexp_replace("props", "[^0-9]", "").alias("digits"), F.concat_ws("-", "event_type", F.col("user_id").cast("string")).alias("joined"))


@query("C02_tolerant_cast_whole", r"WITH f AS (SELECT line_id, regexp_replace(split_part(line, ',', 4), '^[\x00-\x20]+|[\x00-\x20]+$', '', 'g') AS v FROM thermo_lines) SELECT line_id, CASE WHEN regexp_matches(v, '^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?[dDfF]?$') THEN TRY_CAST(rtrim(v, 'dDfF') AS DOUBLE) WHEN lower(v) = 'nan' THEN 'NaN'::DOUBLE WHEN regexp_matches(lower(v), '^[+]?inf(inity)?$') THEN 'Infinity'::DOUBLE WHEN regexp_matches(lower(v), '^-inf(inity)?$') THEN '-Infinity'::DOUBLE END AS x FROM f", with_obs=False)
def c02_whole(spark, d):
    return table(spark, d, "thermo_lines").select("line_id", F.split_part("line", F.lit(","), F.lit(4)).try_cast("double").alias("x"))


@query("C03_coalesce", "SELECT row_id, coalesce(CASE WHEN NOT isnan(value) THEN value END, CASE WHEN NOT isnan(aux) THEN aux END, -1) AS v, flag IS NOT DISTINCT FROM NULL AS unflagged FROM level1_rows", with_obs=False)
def c03(spark, d):
    rows = table(spark, d, "level1_rows")
    return rows.select("row_id", F.coalesce(numeric.clean_number(F.col("value")), numeric.clean_number(F.col("aux")), F.lit(-1.0)).alias("v"), F.col("flag").eqNullSafe(F.lit(None)).alias("unflagged"))


@query("C05_hex", "SELECT row_id, ('0x' || flags)::BIGINT AS bits FROM thermo WHERE flags IS NOT NULL", with_obs=False)
def c05(spark, d):
    return table(spark, d, "thermo").filter("flags is not null").select("row_id", numeric.nearest_hex(F.col("flags")).alias("bits"))


@query("C07_unpivot", "SELECT row_id, 'flowa' AS name, flowa AS value FROM thermo UNION ALL SELECT row_id, 'flowb', flowb FROM thermo", with_obs=False)
def c07(spark, d):
    return table(spark, d, "thermo").select("row_id", "flowa", "flowb").unpivot("row_id", ["flowa", "flowb"], "name", "value")


@query("C08_hashes", "SELECT event_id, md5(concat_ws(',', event_id, event_type)) AS h FROM obs")
def c08(spark, d):
    from aerolake.operators.availability import text_fingerprint

    rows = obs(spark, d)
    return rows.select("event_id", text_fingerprint(rows, ["event_id", "event_type"]).alias("h"))


@query("C09_json", "SELECT event_id, '{\"event_id\":' || event_id || ',\"event_type\":\"' || event_type || '\"}' AS j FROM obs")
def c09(spark, d):
    return obs(spark, d).select("event_id", F.to_json(F.struct("event_id", "event_type")).alias("j"))


# --- flags ---------------------------------------------------------------------------------------------------------------------------
@query("Q01_set_flag_at", "SELECT event_id, CASE WHEN value > 300 THEN 1 ELSE f END AS f_a, CASE WHEN value > 300 THEN 1 END AS f_b FROM obs")
def q01(spark, d):
    rows = obs(spark, d).withColumns({"f_a": F.col("f").cast("tinyint"), "f_b": F.lit(None).cast("tinyint")})
    return flags.set_flag_at(rows, rows.filter("value > 300").select("us"), ["f_a", "f_b"], 1, time="us").select("event_id", F.col("f_a").cast("int").alias("f_a"), F.col("f_b").cast("int").alias("f_b"))


@query("Q03_synchronise", "SELECT event_id, f AS f_a, f AS f_b FROM obs")
def q03(spark, d):
    rows = obs(spark, d).withColumns({"f_a": F.col("f"), "f_b": F.col("state")})
    return flags.synchronise(rows, ["f_a", "f_b"], "f_a").select("event_id", "f_a", "f_b")


@query("Q04_reconcile", "SELECT event_id, coalesce(f, CASE WHEN state = 3 THEN 2 END)::INTEGER AS f_a FROM obs WHERE f IS NULL OR state <> 3")
def q04(spark, d):
    rows = obs(spark, d).filter("f is null or state <> 3").withColumns({"f_a": F.col("f").cast("tinyint"), "f_b": F.when(F.col("state") == 3, 2).cast("tinyint")})
    return flags.reconcile(rows, ["f_a", "f_b"]).select("event_id", F.col("f_a").cast("int").alias("f_a"))


_NE = "CASE state WHEN 0 THEN 0 WHEN 1 THEN 2 WHEN 2 THEN 2 WHEN 3 THEN 3 WHEN 4 THEN 5 WHEN 5 THEN 4 WHEN 6 THEN 6 END"


@query("Q05_auto_flag_nephelometer", f"+p AS (SELECT *, lag(state) {_BY_USER} AS was FROM obs), r AS (SELECT *, CASE WHEN state = 0 AND was <> 0 THEN us END AS ret FROM p), l AS (SELECT *, last_value(ret IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY us, event_id ROWS UNBOUNDED PRECEDING) AS since FROM r) SELECT event_id, coalesce(f, CASE WHEN state = 0 AND us - since <= 600000000 THEN 2 ELSE {_NE} END) AS f_value FROM l")
def q05(spark, d):
    rows = obs(spark, d).withColumn("f_value", F.col("f").cast("tinyint"))
    return flags.auto_flag_ne300(rows, "state", ["value"], ["user_id"], ["us", "event_id"]).select("event_id", F.col("f_value").cast("int").alias("f_value"))


@query("Q06_auto_flag_aurora", f"+p AS (SELECT *, lag(state) {_BY_USER} AS was, row_number() {_BY_USER} AS n FROM obs), r AS (SELECT *, CASE WHEN n > 1 AND state IS DISTINCT FROM was THEN us END AS ch FROM p), l AS (SELECT *, last_value(ch IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY us, event_id ROWS UNBOUNDED PRECEDING) AS since FROM r) SELECT event_id, CASE WHEN us - since <= 600000000 THEN 2 ELSE CASE state WHEN 0 THEN 0 WHEN 1 THEN 4 WHEN 3 THEN 4 WHEN 2 THEN 3 WHEN 5 THEN 3 END END AS f_value FROM l")
def q06(spark, d):
    return flags.auto_flag_aurora(obs(spark, d), "state", ["value"], ["user_id"], ["us", "event_id"]).select("event_id", F.col("f_value").cast("int").alias("f_value"))


@query("Q07_auto_flag_valve", "SELECT event_id, CASE WHEN state - 1 = 0 THEN 0 WHEN state - 1 = 1 THEN 4 WHEN state - 1 > 1 THEN 2 END AS f_value FROM obs")
def q07(spark, d):
    rows = obs(spark, d).select("event_id", "value", (F.col("state") - 1).alias("solenoid_valves"))
    return flags.auto_flag_g2401(rows).select("event_id", F.col("f_value").cast("int").alias("f_value"))


@query("Q08_additive", "SELECT event_id, coalesce(f, state) AS kept, coalesce(state, f) AS overwritten FROM obs")
def q08(spark, d):
    return obs(spark, d).select("event_id", flags.additive(F.col("f"), F.col("state")).alias("kept"), flags.additive(F.col("f"), F.col("state"), True).alias("overwritten"))


@query("Q09_propagate", "SELECT event_id, CASE WHEN state IN (2, 3, 4) AND f IS NULL THEN state ELSE f END AS f_value FROM obs")
def q09(spark, d):
    rows = obs(spark, d).withColumns({"f_value": F.col("f").cast("tinyint"), "src": F.col("state").cast("tinyint")})
    return flags.propagate(rows, "src", ["f_value"]).select("event_id", F.col("f_value").cast("int").alias("f_value"))


@query("Q11_reflag_history", f"SELECT event_id, CASE WHEN state BETWEEN 1 AND 6 AND (f IS NULL OR f IN (0, 2)) THEN {_NE} ELSE f END AS f_value, (CASE WHEN state BETWEEN 1 AND 6 AND (f IS NULL OR f IN (0, 2)) THEN {_NE} ELSE f END) IS DISTINCT FROM f AS changed FROM obs")
def q11(spark, d):
    rows = obs(spark, d).withColumn("f_value", F.col("f").cast("tinyint"))
    return flags.reflag_history(rows, "state", "f_value").select("event_id", F.col("f_value").cast("int").alias("f_value"), "changed")


@query("Q12_ingest_flags", "SELECT row_id, CASE WHEN bc6 IS NULL OR coalesce(status <> 0, false) THEN 1 ELSE 0 END AS f_bc6 FROM ae33", with_obs=False)
def q12(spark, d):
    rows = table(spark, d, "ae33").select("row_id", "bc6", "status")
    return flags.ingest_flags(rows, ["bc6"], "status").select("row_id", F.col("f_bc6").cast("int").alias("f_bc6"))


@query("Q13_flag_shares", "+w AS (SELECT event_id, CASE f WHEN 0 THEN 1.0 WHEN 1 THEN 0.0 WHEN 2 THEN 0.5 ELSE f END::DOUBLE AS p FROM obs) SELECT event_id, 'f_value' AS variable, p AS probability FROM w WHERE p < 1")
def q13(spark, d):
    return flags.flag_shares(obs(spark, d).withColumn("f_value", F.col("f")), ["event_id"], ["f_value"])


@query("Q14_good_records", "SELECT row_id FROM thermo WHERE upper(trim(flags)) IN ('0C100400', '0C100000') AND o3 < 50", with_obs=False)
def q14(spark, d):
    return table(spark, d, "thermo").filter(flags.good_records(F.col("flags"), F.col("o3"), 50, ("0C100400", "0C100000"))).select("row_id")
