"""Further queries: scans over drifting files, resolvers, casts, comparisons of instruments, raw-file readers and writers."""

from __future__ import annotations

import os
from dataclasses import replace

from pyspark.sql import Window
from pyspark.sql import functions as F

from aerolake.functions import numeric
from aerolake.operators import aggregate, columns, flags, joins, merge, stats, validity, windows
from aerolake.operators.buckets import bucket
from aerolake.plans.reference import _GOOD, obs, query, r6, sec
from aerolake.plans.reference_rows import STEPS
from aerolake.session import scratch_path, table
from aerolake.sources import tahmo
from aerolake.sources.files import read_format
from aerolake.sources.formats import AE33_COLUMNS, FORMATS, TAHMO_UNITS
from aerolake.sources.sinks import ebas_columns, ebas_level0, merge_into, wdcgg_lines


@query("S05_scan_of_drifting_files", "SELECT row_id, source, CAST(NULL AS DOUBLE) AS o3, value FROM level1_rows UNION ALL SELECT row_id, source, o3, NULL FROM thermo", with_obs=False)
def s05(spark, d):
    return merge.relaxed_scan(spark, [os.path.join(d, f"{t}.parquet") for t in ("level1_rows", "thermo")]).select("row_id", "source", "o3", "value")


@query("A08_interval_median", "SELECT us // 600000000 * 600 AS start, round(median(value), 6) AS value, round(median(k), 6) AS k FROM obs GROUP BY 1")
def a08(spark, d):
    return obs(spark, d).groupBy(sec(bucket(F.col("dtm"), "10min")).alias("start")).agg(r6(F.median("value")).alias("value"), r6(F.median("k")).alias("k"))


_CMP = "+a AS (SELECT us // 3600000000 AS hour, avg(value) AS x FROM obs WHERE event_type = 'click' AND f = 0 GROUP BY 1), b AS (SELECT us // 3600000000 AS hour, avg(value * 1.1) AS y FROM obs WHERE event_type = 'signup' AND f = 0 GROUP BY 1) "


@query("E3_instrument_comparison", _CMP + "SELECT count(*) AS n, round(regr_slope(y, x), 6) AS slope, round(regr_intercept(y, x), 6) AS intercept, round(corr(x, y), 6) AS r FROM a JOIN b USING (hour)")
def e3(spark, d):
    rows = obs(spark, d).withColumn("hour", F.floor(F.col("us") / 3_600_000_000))
    side = lambda kind, scale, name: rows.filter((F.col("event_type") == kind) & validity.strictly_valid(F.col("value"), F.col("f"))).groupBy("hour").agg(F.avg(F.col("value") * scale).alias(name))
    return stats.regression(joins.outer_chain([side("click", 1.0, "x"), side("signup", 1.1, "y")], ["hour"]), "x", "y").select("n", r6("slope").alias("slope"), r6("intercept").alias("intercept"), r6("r").alias("r"))


@query("A09_hourly_scaled", "SELECT us // 3600000000 AS hour, round(avg(CASE WHEN f = 0 THEN value * 0.001 END), 9) AS value FROM obs GROUP BY 1")
def a09(spark, d):
    clean = F.when(validity.strictly_valid(F.col("value"), F.col("f")), F.col("value") * 0.001)
    return obs(spark, d).groupBy(F.floor(F.col("us") / 3_600_000_000).alias("hour")).agg(F.round(F.avg(clean), 9).alias("value"))


@query("A10_right_closed_hours", "SELECT (us - 1) // 3600000000 * 3600 + 3600 AS hour_end, round(avg(value), 6) AS value FROM obs GROUP BY 1")
def a10(spark, d):
    return obs(spark, d).groupBy((sec(bucket(F.col("dtm"), "1h", closed="right")) + 3600).alias("hour_end")).agg(r6(F.avg("value")).alias("value"))


@query("A21_constant_after_correction", "SELECT 1013.25::DOUBLE AS low, 1013.25::DOUBLE AS high, count(*) AS n FROM obs")
def a21(spark, d):
    rows = obs(spark, d).withColumns({"p": F.lit(900.0) + F.col("k"), "t": F.lit(5.0)})
    fixed = aggregate.correct_to_reporting_condition(rows, ["value"], "p", "t", 1013.25, 20.0)
    aggregate.verify_constant(fixed, {"p": 1013.25, "t": 20.0})
    return fixed.agg(F.min("p").alias("low"), F.max("p").alias("high"), F.count("*").alias("n"))


@query("P03_rows_all_valid", "SELECT event_id FROM obs WHERE (f = 0 OR f IS NULL) AND state = 0")
def p03(spark, d):
    return validity.rows_all_valid(obs(spark, d), ["f", "state"]).select("event_id")


@query("P04_resolved_flag", "SELECT event_id, f AS flag FROM obs")
def p04(spark, d):
    rows = obs(spark, d).withColumnRenamed("f", "F_Value")
    return rows.select("event_id", F.col(columns.resolve_flag("value", rows.columns)).alias("flag"))


@query("P10_columns_by_pattern", "SELECT row_id, bc1, bc2, bc3, bc4, bc5, bc6, bc7 FROM ae33", with_obs=False)
def p10(spark, d):
    rows = table(spark, d, "ae33")
    return rows.select("row_id", rows.colRegex("`bc[1-7]`"))


@query("M07_math", "SELECT event_id, round(sin(radians(direction)), 6) AS s, round(degrees(atan2(value, k + 1)), 6) AS a, round(exp(k / 50), 6) AS e, ((-direction % 360) + 360) % 360 AS m FROM obs")
def m07(spark, d):
    return obs(spark, d).select("event_id", r6(F.sin(F.radians("direction"))).alias("s"), r6(F.degrees(F.atan2(F.col("value"), F.col("k") + 1))).alias("a"), r6(F.exp(F.col("k") / 50)).alias("e"), F.pmod(-F.col("direction"), F.lit(360.0)).alias("m"))


@query("C04_membership", "SELECT event_id, event_type IN ('click', 'view') AS inside, value BETWEEN 10 AND 20 AS ten, f IS NULL OR state = 0 AS either FROM obs")
def c04(spark, d):
    return obs(spark, d).select("event_id", F.col("event_type").isin("click", "view").alias("inside"), F.col("value").between(10, 20).alias("ten"), (F.col("f").isNull() | (F.col("state") == 0)).alias("either"))


@query("C06_bytes", "SELECT event_id, hex(encode(event_type))[1:4] AS h, ('0x' || hex(encode(event_type))[1:4])::BIGINT AS n FROM obs")
def c06(spark, d):
    h = F.substring(F.hex(F.encode("event_type", "UTF-8")), 1, 4)
    return obs(spark, d).select("event_id", h.alias("h"), numeric.nearest_hex(h).alias("n"))


@query("Q02_linked_display", "SELECT event_id, coalesce(f, state) AS shown FROM obs")
def q02(spark, d):
    groups = columns.linked_groups({"g": ["a", "b"]})
    rows = obs(spark, d).withColumns({"f_a": F.col("f"), "f_b": F.col("state")})
    return rows.select("event_id", F.coalesce(*[F.col(c) for c in columns.linked_flags("a", groups, rows.columns)]).alias("shown"))


@query("Q10_steps_to_flags", STEPS.replace("COLUMN", "k").replace("QUANTILE", "0.8") + "SELECT event_id, CASE WHEN state > 0 THEN 4 WHEN state < 0 THEN 3 ELSE 0 END AS flag FROM s")
def q10(spark, d):
    out = windows.step_events(obs(spark, d), ["event_type"], ["us", "event_id"], "k", 0.8)
    return out.select("event_id", F.when(F.col("state") > 0, 4).when(F.col("state") < 0, 3).otherwise(0).alias("flag"))


@query("T05_row_order", "SELECT event_id, row_number() OVER (PARTITION BY event_type ORDER BY us, event_id) - 1 AS place FROM obs")
def t05(spark, d):
    w = Window.partitionBy("event_type").orderBy("us", "event_id")
    return obs(spark, d).select("event_id", (F.row_number().over(w) - 1).cast("long").alias("place"))


@query("D10_time_column", "SELECT row_id, epoch_us(\"timestamp\") AS us FROM level1_rows", with_obs=False)
def d10(spark, d):
    rows = table(spark, d, "level1_rows")
    return rows.select("row_id", F.unix_micros(columns.find_time_column(rows)).alias("us"))


@query("K01_keyed_merge", "SELECT row_id, CASE WHEN NOT isnan(value) THEN value END AS value FROM level1_rows WHERE \"timestamp\" IS NOT NULL", with_obs=False)
def k01(spark, d):
    rows = table(spark, d, "level1_rows").filter("timestamp is not null").select("row_id", "timestamp", "value")
    target = scratch_path(spark, "level1")
    merge_into(rows.filter("row_id % 2 = 0"), target, ["row_id"], time="timestamp", split="day")
    return merge_into(rows, target, ["row_id"], time="timestamp", split="day", prefer="existing").select("row_id", "value")


@query("K04_merge_counts", "SELECT count(*) AS rows, count(*) FILTER (WHERE user_id % 2 = 0) AS old_rows, count(*) FILTER (WHERE user_id % 2 = 1) AS new_rows FROM obs")
def k04(spark, d):
    """Half of the users' rows are there; all come again: what a monthly merge reports."""
    rows = obs(spark, d).select("event_id", "dtm", "user_id", "value")
    target, report = scratch_path(spark, "tahmo"), {}
    merge_into(rows.filter("user_id % 2 = 0"), target, ["event_id"])
    merge_into(rows, target, ["event_id"], report=report)
    return spark.createDataFrame([(report["rows"], report["old_rows"], report["new_rows"])], "rows long, old_rows long, new_rows long")


@query("K08_submission_lines", "SELECT us, 'MKN ' || year(dtm) || ' ' || month(dtm) || ' ' || day(dtm) || ' ' || hour(dtm) || ' ' || minute(dtm) || ' ' || second(dtm) || ' ' || printf('%g', CASE WHEN k * 4 = 360 THEN 0 ELSE k * 4 END) || ' ' || printf('%g', value / 7) || ' ' || printf('%g', coalesce(CASE WHEN f = 0 THEN k END, -99.9)) || ' ' || printf('%g', value * 1e4) || ' ' || printf('%g', value * 1e-6) || ' -99.9 ' || printf('%g', -value) || ' -0.0621999986 37.2971992493 3688 3678' AS line FROM obs")
def k08(spark, d):
    rows = obs(spark, d).select("us", "dtm", F.lit(187).alias("iii"), (F.col("k") * 4).alias("dkl010h0"), (F.col("value") / 7).alias("fkl010h0"), F.when(F.col("f") == 0, F.col("k")).alias("uor200h0"), (F.col("value") * 1e4).alias("prestah0"), (F.col("value") * 1e-6).alias("tre200h0"), F.lit(float("nan")).alias("rre150h0"), (-F.col("value")).alias("gor000h0"))
    return wdcgg_lines(rows, "dtm", "iii").select(F.unix_micros("dtm").alias("us"), "line")


@query("K09_submission_level0", "+y AS (SELECT CAST(min(dtm) AS DATE) AS first FROM obs) SELECT us, round((us - epoch_us(date_trunc('year', first))) / 86400e6, 6) AS start_time, round((us + 60000000 - epoch_us(date_trunc('year', first))) / 86400e6, 6) AS end_time, round(value / 100, 6) AS pressure, round(k + 273.15, 6) AS case_temperature, round(value / 1000, 6) AS bc61, CAST(NULL AS DOUBLE) AS k7, f::DOUBLE AS numflag FROM obs, y")
def k09(spark, d):
    rows = obs(spark, d).select("dtm", F.col("value").alias("Pressure"), F.col("k").alias("ContTemp"), F.col("value").alias("BC61"), F.col("f"), F.lit(float("inf")).alias("K7x"))
    out = ebas_level0(rows, "dtm", 60, "f")
    return out.select(F.unix_micros("dtm").alias("us"), "start_time", "end_time", r6("Pressure").alias("pressure"), r6("ContTemp").alias("case_temperature"), r6("BC61").alias("bc61"), F.col("K7").alias("k7"), "numflag")


@query("K09_submission_units", "SELECT row_id, round(pressure / 100, 6) AS pressure, round(temperature + 273.15, 6) AS temperature, flow1 / 1000 AS flow1, bc6 / 1000 AS bc6 FROM ae33", with_obs=False)
def k09u(spark, d):
    return ebas_columns(table(spark, d, "ae33").select("row_id", "pressure", "temperature", "flow1", "bc6")).withColumns({"pressure": r6("pressure"), "temperature": r6("temperature")})


@query("A01_many_variables", "SELECT inst_sn, epoch_us(date_trunc('hour', dtm)) // 1000000 AS start, " + ", ".join(f"round(avg(bc{i}), 6) AS bc{i}, count(bc{i}) AS n_bc{i}" for i in range(1, 8)) + " FROM ae33 WHERE dtm IS NOT NULL GROUP BY 1, 2", with_obs=False)
def a01m(spark, d):
    spec = aggregate.Level2([f"bc{i}" for i in range(1, 8)], keys=["inst_sn"])
    rows = table(spark, d, "ae33").drop("f_bc6")
    out = aggregate.level2(rows, spec, "1h")
    return out.select("inst_sn", sec("dtm").alias("start"), *[x for i in range(1, 8) for x in (r6(f"bc{i}").alias(f"bc{i}"), f"n_bc{i}")])


@query("Q01_flag_counts", f"SELECT 'f' AS flag, f::INTEGER AS code, count(*) AS count FROM obs GROUP BY 2 UNION ALL SELECT 'state', state, count(*) FROM obs GROUP BY 2")
def q01c(spark, d):
    return flags.flag_counts(obs(spark, d), ["f", "state"])


@query("O01_station_summary", f"SELECT event_type AS instrument, count(*) AS rows, count(value) AS available, count({_GOOD}) AS valid FROM obs GROUP BY 1")
def o01(spark, d):
    rows = obs(spark, d).withColumn("f_value", F.col("f"))
    return aggregate.available_and_valid(rows, ["value"], keys=["event_type"]).select(F.col("event_type").alias("instrument"), F.col("available").alias("rows"), "available", "valid")


# --- raw files: lines are written as text files in the instrument's layout and read back by its parser ------------------------------
def _read_back(spark, lines, name):
    """Lines (column ``line``) as text files, read by a format's parser."""
    folder = scratch_path(spark, f"raw-{name}")
    lines.select("line").write.text(folder)
    return read_format(spark, folder, replace(FORMATS[name], accept=r"\.txt$", members=r".*"))[0]


@query("R01_ae33_files", "SELECT row_id, inst_sn, epoch_us(dtm) // 1000000 AS t, bc6, bb, flow1 FROM ae33 WHERE dtm IS NOT NULL", with_obs=False)
def r01(spark, d):
    own = {"Inst_SN": F.col("inst_sn"), "row_id": F.col("row_id"), "dtm": F.date_format("dtm", "MM/dd/yyyy hh:mm:ss a"), "BC6": F.col("bc6"), "BB": F.col("bb"), "Flow1": F.col("flow1")}
    rows = table(spark, d, "ae33").filter("dtm is not null")
    line = F.concat_ws("|", *[F.coalesce(own[c].cast("string"), F.lit("")) if c in own else F.lit("") for c in AE33_COLUMNS])
    return _read_back(spark, rows.select(line.alias("line")), "ae33").select("row_id", F.col("Inst_SN").alias("inst_sn"), sec("dtm").alias("t"), F.col("BC6").alias("bc6"), F.col("BB").alias("bb"), F.col("Flow1").alias("flow1"))


@query("R04_thermo_files", "SELECT epoch_us(dtm) // 1000000 AS t, flags, round(o3, 6) AS o3, cellai, pres FROM thermo WHERE dtm IS NOT NULL", with_obs=False)
def r04(spark, d):
    rows = table(spark, d, "thermo").filter("dtm is not null")
    cells = [F.date_format("dtm", "yyyy-MM-dd'T'HH:mm:ss'Z'"), F.lit("a"), F.lit("b"), *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("o3", "flags", "hio3", "cellai", "cellbi", "bncht", "lmpt", "o3lt", "flowa", "flowb", "pres")]]
    return _read_back(spark, rows.select(F.concat_ws(",", *cells).alias("line")), "thermo").select(sec("dtm").alias("t"), "flags", r6("o3").alias("o3"), "cellai", "pres")


@query("R10_tahmo_files", "+r AS (SELECT us // 1000000 AS t, CASE event_type WHEN 'click' THEN 'temp' ELSE 'wind' END AS v, value, event_id, f FROM obs WHERE event_type IN ('click', 'error')), b AS (SELECT t // 600 * 600 AS t, v, max(event_id) AS mrid, arg_max(value, event_id) AS value, arg_max(coalesce(f, 0), event_id) AS f FROM r GROUP BY 1, 2) SELECT t, max(mrid) AS mrid, max(value) FILTER (WHERE v = 'temp') AS temp, coalesce(max(f) FILTER (WHERE v = 'wind'), 1)::INTEGER AS f_wind FROM b GROUP BY 1")
def r10(spark, d):
    names = {"click": "Air Temperature", "error": "Wind Speed"}
    rows = obs(spark, d).filter(F.col("event_type").isin(*names))
    kind = F.when(F.col("event_type") == "click", names["click"]).otherwise(names["error"])
    unit = F.when(F.col("event_type") == "click", TAHMO_UNITS[names["click"]]).otherwise(TAHMO_UNITS[names["error"]])
    cells = F.concat_ws(",", kind, F.lit("D1"), (F.floor(F.col("us") / 600_000_000) * 600).cast("string"), F.col("value").cast("string"), F.col("event_id").cast("string"), F.when(F.col("f") == 1, "true").otherwise("false"), unit)
    folder = scratch_path(spark, "raw-tahmo")
    rows.select(cells.alias("x")).selectExpr("split(x, ',') a").selectExpr("a[0] measurement", "a[1] device_sn", "a[2] timestamp_utc", "a[3] value", "a[4] mrid", "a[5] error_flag", "a[6] units").write.option("header", True).option("maxRecordsPerFile", 100_000).csv(folder)
    readings = read_format(spark, folder, FORMATS["tahmo"])[0]
    out = tahmo.wide(readings, {"Air Temperature": "temp", "Wind Speed": "wind"})
    return out.select(sec("dtm").alias("t"), "mrid", "temp", F.col("f_wind").cast("int").alias("f_wind"))
