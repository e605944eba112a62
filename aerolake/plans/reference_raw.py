"""Queries of the raw readers: the observations are written in each instrument's layout, as files in a table, and read back by its parser."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolake.operators.joins import with_scalars
from aerolake.plans.reference import obs, query, r6, sec
from aerolake.session import table
from aerolake.sources import formats, tahmo
from aerolake.sources.files import accepted, parse_files
from aerolake.sources.formats import FORMATS


def _text(*cells: Column | str, sep: str = ",") -> Column:
    return F.concat_ws(sep, *[F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("")) for c in cells])


def _files(rows: DataFrame, line: Column, head: str = "", foot: str = "", path: Column | None = None, charset: str = "UTF-8") -> DataFrame:
    """One file a day: ``path``, ``content``; lines in order of event_id between a head and a foot."""
    day = path if path is not None else F.date_format("dtm", "yyyyMMdd")
    body = F.transform(F.array_sort(F.collect_list(F.struct(F.col("event_id").alias("i"), line.alias("x")))), lambda s: s["x"])
    whole = F.concat(F.lit(head), F.array_join(body, "\n"), F.lit("\n" + foot))
    return rows.groupBy(day.alias("path")).agg(F.encode(whole, charset).alias("content"))


def _read(rows: DataFrame, name: str) -> DataFrame:
    return parse_files(rows, replace(FORMATS[name], members=r".*"))[0]


ISO = "yyyy-MM-dd HH:mm:ss"


@query("R02_ae31", "SELECT CASE WHEN event_id % 2 = 0 THEN us // 1000000 ELSE us // 60000000 * 60 END AS t, CASE WHEN event_id % 2 = 0 THEN CAST(event_id AS VARCHAR) END AS id, value AS uv370, k AS b470 FROM obs")
def r02(spark, d):
    """Every other line has neither time nor id, so its fields stand to the left and date and time make the time."""
    slot = [F.concat(F.lit('"'), F.date_format("dtm", "dd-MMM-yy"), F.lit('"')), F.concat(F.lit('"'), F.date_format("dtm", "HH:mm"), F.lit('"')), "value", "k", *[F.lit("1")] * 48]
    line = F.when(F.col("event_id") % 2 == 0, _text(F.date_format("dtm", ISO), "event_id", *slot)).otherwise(_text(*slot))
    return _read(_files(obs(spark, d), line), "ae31").select(sec("dtm").alias("t"), "id", F.col("UV370").alias("uv370"), F.col("B470").alias("b470"))


@query("R03_vrxa00", "SELECT us // 60000000 * 60 AS t, 187 AS iii, value AS tre200s0, CASE WHEN f = 0 THEN k END AS uor200s0 FROM obs")
def r03(spark, d):
    line = _text(F.lit("187"), F.date_format("dtm", "yyyyMMddHHmm"), "value", F.when(F.col("f") == 0, F.col("k").cast("string")).otherwise("/"), sep=" ")
    return _read(_files(obs(spark, d), line, "15834\nVRXA00 LSSW 190000\n\niii zzzztttt tre200s0 uor200s0\n"), "vrxa00").select(sec("dtm").alias("t"), "iii", "tre200s0", "uor200s0")


@query("R05_ne300", "SELECT us // 1000000 AS t, value AS \"4035\", k AS \"2002\", event_id::DOUBLE AS last FROM obs")
def r05(spark, d):
    """The header names only the first columns, as old loggers wrote it."""
    n = len(formats.NE300_COLUMNS)
    out = _read(_files(obs(spark, d), _text(F.date_format("dtm", ISO), "value", "k", *[F.lit("0")] * (n - 4), "event_id"), "dtm,4035,2002\n"), "ne300")
    return out.select(sec("dtm").alias("t"), "4035", "2002", F.col(formats.NE300_COLUMNS[-1]).alias("last"))


@query("R05_aurora", "SELECT us // 1000000 AS t, value AS ssp1, CAST(state AS DOUBLE) AS major_state FROM obs")
def r05a(spark, d):
    cells = {"dtm": F.date_format("dtm", ISO), "ssp1": F.col("value"), "major_state": F.col("state")}
    line = _text(*[cells.get(c, F.lit("1")) for c in formats.AURORA_COLUMNS])
    return _read(_files(obs(spark, d), line), "aurora3000").select(sec("dtm").alias("t"), "ssp1", "major_state")


@query("R06_g2401", "SELECT us // 1000000 AS t, value AS co2, CAST(state AS DOUBLE) AS valve FROM obs")
def r06(spark, d):
    line = _text(F.date_format("dtm", "yyyy-MM-dd"), F.date_format("dtm", "HH:mm:ss.SSS"), "value", "state", sep="      ")
    out = _read(_files(obs(spark, d), line, "DATE      TIME      CO2_dry_sync    solenoid_valves\n"), "g2401")
    return out.select(sec("dtm").alias("t"), F.col("CO2_dry_sync").alias("co2"), F.col("solenoid_valves").alias("valve"))


@query("R07_fidas", "SELECT us // 1000000 AS t, value AS \"60\", 'x' || event_id AS id FROM obs")
def r07(spark, d):
    return _read(_files(obs(spark, d), _text(F.date_format("dtm", ISO), "value", F.concat(F.lit("x"), "event_id")), "dtm,60,id\n"), "fidas").select(sec("dtm").alias("t"), "60", "id")


@query("R08_hmp110", "SELECT us // 1000000 AS t, value AS T_, k AS rh, CAST(NULL AS DOUBLE) AS td FROM obs")
def r08(spark, d):
    """Without a header, and with one cell too few."""
    return _read(_files(obs(spark, d), _text(F.date_format("dtm", ISO), "value", "k")), "hmp110").select(sec("dtm").alias("t"), F.col("T").alias("T_"), F.col("RH").alias("rh"), F.col("Td").alias("td"))


@query("R09_avo", "SELECT us // 1000000 AS t, value AS pm25_conc, round(k / 1000, 9) AS pnc, event_type AS source FROM obs")
def r09(spark, d):
    line = _text(F.date_format("dtm", ISO), "value", "k", "event_type", F.lit(""), F.lit(""))
    out = formats.clean_avo(_read(_files(obs(spark, d), line, "Timestamp,PM2.5 (ug/m3),Particle Count,Source,slot.1,\n"), "avo"))
    return out.select(sec("dtm").alias("t"), "pm25_conc", F.round("pnc", 9).alias("pnc"), "source")


@query("R26_split_by_source", "SELECT event_type AS source, count(*) AS n, round(sum(value), 2) AS total FROM obs GROUP BY 1")
def r26(spark, d):
    """A file that holds several sources, split into a frame per source."""
    line = _text(F.date_format("dtm", ISO), "value", "event_type")
    frames = formats.by_source(_read(_files(obs(spark, d), line, "Timestamp,PM2.5 (ug/m3),Source\n"), "avo"))
    parts = [f.agg(F.lit(s).alias("source"), F.count("*").alias("n"), F.round(F.sum("pm25_conc"), 2).alias("total")) for s, f in sorted(frames.items())]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionAll(p)
    return out


@query("R12_eaton", "+s AS (SELECT us // 1000000 AS t, max(event_id) AS i FROM obs GROUP BY 1) SELECT s.t, o.value AS battery_voltage, CAST(o.k AS BIGINT) AS input_voltage, 1 AS f_output_load FROM s JOIN obs o ON o.event_id = s.i")
def r12(spark, d):
    """A file per hour, named after it; times are unique in it."""
    rows = obs(spark, d).groupBy(sec("dtm").alias("t")).agg(F.max_by(F.struct("event_id", "dtm", "value", "k"), "event_id").alias("r")).select("r.*")
    names = ("dtm", *formats.EATON_TEXT, *formats.EATON_DECIMAL, *formats.EATON_WHOLE)
    own = {"dtm": F.date_format("dtm", ISO), "battery_voltage": F.col("value"), "input_voltage": F.col("k").cast("int")}
    files = _files(rows, _text(*[own.get(c, F.lit("")) for c in names]), ",".join(names) + "\n", path=F.concat(F.lit("eaton-"), F.date_format("dtm", "yyyyMMddHH"), F.lit(".csv")))
    return _read(accepted(files, FORMATS["eaton"]), "eaton").select(sec("dtm").alias("t"), "battery_voltage", "input_voltage", F.col("f_output_load").cast("int").alias("f_output_load"))


@query("R13_cpd2", "SELECT us // 1000000 AS t, 'S11a' AS record, value AS x, NULL::DOUBLE AS y FROM obs WHERE state < 3 UNION ALL SELECT us // 1000000, 'S11k', value, k FROM obs WHERE state IN (3, 4) UNION ALL SELECT us // 1000000, 'A11a', value, k FROM obs WHERE state IN (5, 6)")
def r13(spark, d):
    """Three record types in one file, each with its own number of fields."""
    stamp = [F.lit("MKN"), "event_id", F.date_format("dtm", "yyyy-MM-dd'T'HH:mm:ss'Z'")]
    fill = lambda record: [F.lit("0")] * (len(formats.CPD2_TABLES[record]) - 2)
    line = F.when(F.col("state") < 3, _text(F.lit("S11a"), *stamp, F.lit("F"), F.lit("0007"), "value")).when(F.col("state") < 5, _text(F.lit("S11k"), *stamp, "value", *fill("S11k"), "k")).otherwise(_text(F.lit("A11a"), *stamp, "value", *fill("A11a"), "k"))
    part = F.concat_ws("-", F.date_format("dtm", "yyyyMMdd"), F.floor(F.col("event_id") / 20_000))  # a day of any length is files of at most so many lines
    rows = _read(_files(obs(spark, d).filter("state is not null"), line, "!note\n", path=part), "cpd2")
    of = lambda record, x, y: formats.cpd2_table(rows, record).select(sec("dtm").alias("t"), F.lit(record).alias("record"), F.col(x).alias("x"), (F.col(y) if y else F.lit(None).cast("double")).alias("y"))
    return of("S11a", "BsB_S11", None).unionAll(of("S11k", "P1_S11", "PCTbsR_S11")).unionAll(of("A11a", "Q_A11", "If7_A11"))


@query("R14_dobson", "+h AS (SELECT max(event_id) AS i FROM obs GROUP BY us // 3600000000) SELECT us // 1000000 AS t, 'ACA' AS sequence, k AS sza, value AS xad, round(value + 1, 6) AS x1 FROM obs JOIN h ON event_id = i")
def r14(spark, d):
    rows = obs(spark, d).groupBy(F.date_trunc("hour", "dtm").alias("h")).agg(F.max_by(F.struct("event_id", "dtm", "value", "k"), "event_id").alias("r")).select("r.*")
    at = F.date_format("dtm", "HH:mm:ss")
    line = F.concat_ws("\n", F.lit("Dobson 18"), F.dayofmonth("dtm").cast("string"), F.month("dtm").cast("string"), F.year("dtm").cast("string"), F.lit("Nairobi\n\nDS\n000\nACA\nXA"), at, F.lit("1\n2\n3"), F.round(F.col("value") + 1, 6).cast("string"), F.lit("XAD"), at, F.lit("1.199"), F.col("k").cast("string"), F.col("value").cast("string"), F.lit("comment hazy"))
    return _read(_files(rows, line), "d018").select(sec("dtm").alias("t"), "sequence", "sza", F.col("XAD").alias("xad"), F.col("X1").alias("x1"))


@query("R15_ecc", "SELECT strftime(dtm, '%Y%m%d') AS launch, event_id::DOUBLE AS time_s, value AS ecc_nbar, CASE WHEN f = 0 THEN k END AS tp_k FROM obs")
def r15(spark, d):
    """Missing cells and the footer carry the same code; what follows the footer is no data."""
    line = _text("event_id", F.lit("1"), F.when(F.col("f") == 0, F.col("k").cast("string")).otherwise(formats.ECC_MISSING), F.lit("2"), F.lit("3"), F.lit("4"), "value", sep="  ")
    foot = " ".join([formats.ECC_MISSING] * 7) + "\n" + " ".join(["9"] * 7)
    out = _read(_files(obs(spark, d), line, "Date: x\nSonde: 7\n" + "x\n" * 8, foot, path=F.concat(F.date_format("dtm", "yyyyMMddHH"), F.lit(".txt"))), "ecc_asap")
    return out.select("launch", "time_s", "ecc_nbar", "tp_k")


@query("R16_shadoz", "SELECT us // 3600000000 * 3600 AS t, variable, CASE WHEN variable = 'O3' THEN CASE WHEN f = 0 THEN value END ELSE k END AS value FROM obs, (VALUES ('O3'), ('Press')) v(variable)")
def r16(spark, d):
    line = _text("k", F.when(F.col("f") == 0, F.col("value").cast("string")).otherwise("9000"), sep="  ")
    files = _files(obs(spark, d), line, "6\nStation: Nairobi\nMissing or bad values: 9000\nx\nPress O3\nhPa mPa\n", path=F.date_format("dtm", "'shadoz_'yyyyMMdd'T'HH'_x.dat'"))
    return _read(accepted(files, FORMATS["shadoz"]), "shadoz").select(sec("dtm").alias("t"), "variable", "value")


@query("R17_nasa_ames", "SELECT us // 60000000 * 60 AS t, variable, CASE WHEN variable = 'flag' THEN state ELSE CASE WHEN f = 0 THEN value END END::DOUBLE AS value FROM obs, (VALUES ('flag'), ('o3')) v(variable)")
def r17(spark, d):
    minutes = F.floor(F.col("us") / 60_000_000) - F.floor(F.unix_micros(F.lit("2024-01-01").cast("timestamp")) / 60_000_000)
    line = _text(F.format_string("%.6f", minutes / 1440.0), F.when(F.col("f") == 0, F.col("value").cast("string")).otherwise("9999.99"), "state", sep=" ")
    head = "15 1001\nA\nB\nC\nD\n1 1\n2024 01 01 2024 01 02\n0\ndays\n2\n1 1\n9999.99 99\no3\nflag\nstart o3 flag\n"
    return _read(_files(obs(spark, d), line, head), "nasa_ames").select(sec("dtm").alias("t"), "variable", "value")


@query("R18_wdcgg", "SELECT us // 1000000 AS t, us // 1000000 AS u, CASE WHEN f = 0 THEN value END AS value, k AS nvalue, 'ppb' AS unit FROM obs")
def r18(spark, d):
    when = [F.date_part(F.lit(p), F.col("dtm")).cast("int") for p in ("year", "month", "day", "hour", "minute", "second")]
    line = _text(F.lit("MKN"), *when, *when, F.when(F.col("f") == 0, F.col("value").cast("string")).otherwise("-999.999"), F.lit("1"), "k", *[F.lit("0")] * 5, F.lit("x"), F.lit("1"), F.lit("1"), F.lit("a"), F.lit("b"), F.lit("c"), sep=" ")
    out = _read(_files(obs(spark, d), line, "# head\n# value:units : ppb\n# VARIABLE ORDER\n# x\n"), "wdcgg")
    return out.select(sec("start").alias("t"), sec("end").alias("u"), "value", "nvalue", "unit")


@query("R20_omi", "SELECT us // 1000000 AS t, CASE WHEN f = 0 THEN value END AS ozone, k AS soi FROM obs")
def r20(spark, d):
    cells = {"Datetime": F.date_format("dtm", "yyyyMMdd'T'HHmmss'123Z'"), "Ozone": F.when(F.col("f") == 0, F.col("value").cast("string")).otherwise("-90000"), "SOI": F.col("k")}
    line = _text(*[cells.get(c, F.lit("1")) for c in formats.OMI_COLUMNS], sep=" ")
    return _read(_files(obs(spark, d), line, "Station: x\nRead format (FORTRAN/IDL)\nx\nh\n"), "omi").select(sec("dtm").alias("t"), F.col("Ozone").alias("ozone"), F.col("SOI").alias("soi"))


@query("R24_climate_index", "SELECT epoch(make_date(1900 + (event_id // 12)::INTEGER % 300, 1 + (event_id % 12)::INTEGER, 1))::BIGINT AS t, value FROM obs WHERE f IS NULL OR f = 0")
def r24(spark, d):
    """Twelve observations make a year's line; a missing month has the code."""
    cell = F.when(F.coalesce("f", F.lit(0)) == 0, F.col("value")).otherwise(-999.0)
    years = obs(spark, d).groupBy(F.floor(F.col("event_id") / 12).alias("event_id")).agg(F.min("dtm").alias("dtm"), *[F.coalesce(F.max(F.when(F.col("event_id") % 12 == m, cell)), F.lit(-999.0)).alias(f"m{m}") for m in range(12)])
    line = _text((F.col("event_id") % 300 + 1900), *[f"m{m}" for m in range(12)], sep=" ")
    return _read(_files(years, line, "1900 2199\n"), "climate_index").select(sec("dtm").alias("t"), "value")


@query("R25_noaa_mbl", "SELECT us // 86400000000 * 86400 AS t, value FROM obs")
def r25(spark, d):
    line = _text(F.year("dtm"), F.month("dtm"), F.dayofmonth("dtm"), "value", F.lit("0.1"))
    return _read(_files(obs(spark, d), line, "# note\n"), "noaa_mbl").select(sec("dtm").alias("t"), "value")


@query("S01_bad_files_lose_only_themselves", "+h AS (SELECT event_type, us // 86400000000 AS h, count(*) AS n FROM obs GROUP BY 1, 2) SELECT count(*) FILTER (WHERE event_type = 'error') AS failed, sum(n) FILTER (WHERE event_type <> 'error') AS rows FROM h")
def s01(spark, d):
    rows = obs(spark, d)
    stamp = F.when(F.col("event_type") == "error", "never").otherwise(F.date_format("dtm", "MM/dd/yyyy HH:mm:ss"))
    own = {"dtm": stamp, "BC6": F.col("event_id")}
    files = _files(rows, _text(*[own.get(c, F.lit("")) for c in formats.AE33_COLUMNS]), path=F.concat_ws("-", "event_type", F.date_format("dtm", "yyyyMMdd")))
    good, bad = parse_files(files, replace(FORMATS["ae33"], members=r".*"))
    return with_scalars(bad.agg(F.count("*").alias("failed")), good.agg(F.count("*").alias("rows")))


@query("S02_accepted_names", "SELECT fragment_id, regexp_matches(split_part(path, '/', -1), '(?i)ae33.*\\.(csv|dat|zip)$') AS ae33, regexp_matches(split_part(path, '/', -1), '(?i)(49c|49i).*\\.(csv|dat|txt|zip)$') AS thermo FROM level1_fragments", with_obs=False)
def s02(spark, d):
    files = table(spark, d, "level1_fragments").select("fragment_id", "path")
    yes = lambda n: accepted(files, FORMATS[n]).select("fragment_id", F.lit(True).alias(n))
    out = files.join(yes("ae33"), "fragment_id", "left").join(yes("thermo"), "fragment_id", "left")
    return out.select("fragment_id", F.coalesce("ae33", F.lit(False)).alias("ae33"), F.coalesce("thermo", F.lit(False)).alias("thermo"))


@query("S03_encodings", "SELECT us // 1000000 AS t, event_type, 'é' || event_id AS id FROM obs")
def s03(spark, d):
    """One text in three encodings: UTF-8, UTF-16 with a mark, and a single-byte one."""
    rows = obs(spark, d)
    line = _text(F.date_format("dtm", ISO), F.concat(F.lit("é"), "event_id"), "event_type")
    kinds = {"click": "UTF-16", "view": "ISO-8859-1"}
    of = lambda keep, charset: _files(rows.filter(keep), line, "dtm,id,checksum\n", charset=charset)
    files = of(~F.col("event_type").isin(*kinds), "UTF-8")
    for kind, charset in kinds.items():
        files = files.unionAll(of(F.col("event_type") == kind, charset))
    return _read(files, "fidas").select(sec("dtm").alias("t"), F.col("checksum").alias("event_type"), "id")


@query("S04_headers_by_known_tokens", "SELECT us // 1000000 AS t, value AS o3, '0C' AS flags FROM obs")
def s04(spark, d):
    """Blank-separated files with a header of their own order, and comma-separated ones without any."""
    rows = obs(spark, d)
    old = _files(rows.filter("event_type = 'click'"), _text(F.date_format("dtm", "yyyy-MM-dd"), F.date_format("dtm", "HH:mm:ss"), F.lit("0C"), "value", sep=" "), "pcdate pctime flags o3\n")
    own = {"dtm": F.date_format("dtm", "yyyy-MM-dd'T'HH:mm:ss'Z'"), "o3": F.col("value"), "flags": F.lit("0C")}
    new = _files(rows.filter("event_type <> 'click'"), _text(*[own.get(c, F.lit("1")) for c in formats.THERMO_MODERN]))
    return _read(old.unionAll(new), "thermo").select(sec("dtm").alias("t"), r6("o3").alias("o3"), "flags")


@query("R29_registry", "SELECT device, CASE instrument WHEN 'tei49i' THEN 'thermo' WHEN 'tei49c' THEN 'thermo' WHEN 'ae31' THEN 'ae31' WHEN 'ae33' THEN 'ae33' WHEN 'fidas' THEN 'fidas' WHEN 'avo' THEN 'avo' WHEN 'hmp110' THEN 'hmp110' WHEN 'ne300' THEN 'ne300' END AS reader FROM devices", with_obs=False)
def r29(spark: SparkSession, d: str) -> DataFrame:
    known = F.create_map(*[F.lit(x) for pair in formats.readers().items() for x in pair])
    return table(spark, d, "devices").select("device", known[F.col("instrument")].alias("reader"))


@query("R11_tahmo_export", "SELECT us // 1000000 - 10800 AS t, event_id AS device_rid, measurement, CASE WHEN measurement = 'Wind Speed' THEN k ELSE CASE WHEN f = 0 THEN value END END AS value, CASE WHEN measurement <> 'Wind Speed' AND coalesce(f, 1) <> 0 THEN 1 ELSE 0 END AS flag FROM obs, (VALUES ('Wind Speed'), ('Air Temperature')) v(measurement)")
def r11(spark, d):
    """Pairs of a calibrated and a raw file per hour, in local time; every other hour's raw file leaves the offset unset."""
    rows = obs(spark, d)
    hour, stamp = F.date_format("dtm", "yyyyMMddHH"), F.date_format("dtm", "yyyy/MM/dd HH:mm:ss")
    named = lambda kind: F.concat(F.lit("z-" + kind + "Configuration 1-"), hour, F.lit(".csv"))
    cal = _files(rows, _text(stamp, F.when(F.col("f") == 0, F.col("value")), "k"), "D1\nmy logger\nTimestamps,degree_C Air Temperature,m/s Wind Speed\n", path=named(""))
    raw = _files(rows, _text(stamp, "event_id", F.when(F.hour("dtm") % 2 == 0, "UTC+03:00").otherwise("Not Set")), "D1\nmy logger\nTimestamps,Device RID,UTC Offset\n", path=named("Raw-"))
    out = tahmo.export_readings(_read(cal.unionAll(raw), "tahmo_export"), "UTC+03:00")
    return out.select(sec("dtm").alias("t"), "device_rid", "measurement", "value", F.col("flag").cast("int").alias("flag"))
