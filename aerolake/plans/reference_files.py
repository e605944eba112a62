"""Queries of the writers and of what finds files: datasets are written to the shared folder and read back."""

from __future__ import annotations

import os

from pyspark.sql import Window
from pyspark.sql import functions as F

from aerolake.functions.timeparse import cadence_seconds, month_days_of_year
from aerolake.operators import aggregate, columns, joins, merge, validity
from aerolake.plans.reference import _GOOD, obs, query, r6, sec
from aerolake.plans.reference_raw import ISO, _files, _read, _text
from aerolake.session import filesystem, scratch_path, table
from aerolake.sources.files import avo_files, level1_root
from aerolake.sources.sinks import lost_flags, merge_into, time_range_filter, with_partitions, write_level2


@query("S06_partition_pruning", "SELECT event_id, year(dtm)::INTEGER AS year, month(dtm)::INTEGER AS month FROM obs WHERE dtm >= TIMESTAMP '2024-01-10' AND dtm < TIMESTAMP '2024-01-21'")
def s06(spark, d):
    """Days of a dataset that is partitioned by day: only their folders are read."""
    rows, parts = with_partitions(obs(spark, d).select("event_id", "dtm"), "dtm", "day")
    path = scratch_path(spark, "by-day")
    rows.repartition(*parts).write.partitionBy(*parts).parquet(path)
    days = time_range_filter(spark.read.parquet(path), "2024-01-10", "2024-01-20").filter(F.col("day").between(10, 20))
    return days.select("event_id", "year", "month")


@query("S07_data_root", "SELECT * FROM (VALUES ('root', true), ('level1', true), ('station', true), ('elsewhere', false)) v(form, found)", with_obs=False)
def s07(spark, d):
    root = scratch_path(spark, "root")
    fs, _ = filesystem(spark, root)
    for folder in ("level1/mkn", "other"):
        fs.mkdirs(filesystem(spark, f"{root}/{folder}")[1])

    def found(path: str) -> bool:
        try:
            return level1_root(spark, path, "mkn") == root
        except FileNotFoundError:
            return False

    forms = {"root": root, "level1": f"{root}/level1", "station": f"{root}/level1/mkn/", "elsewhere": f"{root}/other"}
    return spark.createDataFrame([(k, found(p)) for k, p in forms.items()], "form string, found boolean")


@query("S08_collection", "SELECT row_id, source FROM ae33 UNION ALL SELECT row_id, source FROM thermo UNION ALL SELECT row_id, source FROM level1_rows", with_obs=False)
def s08(spark, d):
    return merge.relaxed_scan(spark, [os.path.join(d, f"{t}.parquet") for t in ("ae33", "thermo", "level1_rows")]).select("row_id", "source")


@query("S09_avo_files", "SELECT device, lower(station) AS station, cadence_s || 's' AS cadence FROM devices", with_obs=False)
def s09(spark, d):
    named = table(spark, d, "devices").select("device", F.concat(F.lit("data/avo-"), "station", F.lit("-"), "cadence_s", F.lit("s.parquet")).alias("path"))
    other = named.withColumn("path", F.concat("path", F.lit(".old")))
    return avo_files(named.unionAll(other)).select("device", "station", "cadence")


@query("K02_staged_writes", "SELECT us // 1000000 AS t, event_type AS source, value AS pm25_conc, event_id FROM obs")
def k02(spark, d):
    """All files of a run are grouped by target, and each target is written once."""
    line = _text(F.date_format("dtm", ISO), "value", "event_id", "event_type")
    rows = _read(_files(obs(spark, d), line, "Timestamp,PM2.5 (ug/m3),Particle Count,Source\n"), "avo")
    out = merge_into(rows.select("dtm", "source", "pm25_conc", F.round(F.col("pnc") * 1000).cast("long").alias("event_id")), scratch_path(spark, "avo"), ["dtm", "source", "event_id"])
    return out.select(sec("dtm").alias("t"), "source", "pm25_conc", "event_id")


@query("K05_level2_files", f"SELECT epoch(date_trunc('hour', dtm))::BIGINT AS start, round(avg({_GOOD}), 6) AS value, count({_GOOD}) AS n, 'MKN' AS station, 'a-b' AS instrument, year(dtm)::INTEGER AS year FROM obs GROUP BY date_trunc('hour', dtm), year(dtm)")
def k05(spark, d):
    out = aggregate.level2(obs(spark, d).withColumn("f_value", F.col("f")), aggregate.Level2(["value"]), "1h")
    path = write_level2(out, scratch_path(spark, "level2"), "MKN", "a/b", "1h", simplify=False)
    return spark.read.parquet(path).select(sec("dtm").alias("start"), r6("value").alias("value"), F.col("n_value").alias("n"), "station", "instrument", "year")


@query("K06_dry_run", "SELECT event_id, value, false AS written FROM obs")
def k06(spark, d):
    target = scratch_path(spark, "dry")
    rows = merge_into(obs(spark, d).select("event_id", "dtm", "value"), target, ["event_id"], dry_run=True)
    fs, path = filesystem(spark, target)
    return rows.select("event_id", "value", F.lit(bool(fs.exists(path))).alias("written"))


@query("K07_lost_flags", "SELECT 'f_o3' AS flag", with_obs=False)
def k07(spark, d):
    rows = table(spark, d, "thermo").select("row_id", "dtm", "o3", "f_o3")
    target = scratch_path(spark, "flagged")
    merge_into(rows, target, ["row_id"])
    return spark.createDataFrame([(f,) for f in lost_flags(spark, target, rows.drop("f_o3"))], "flag string")


@query("K11_split_by_year", "SELECT year(dtm)::INTEGER AS year, count(*) AS n, round(sum(value), 2) AS total FROM obs GROUP BY 1")
def k11(spark, d):
    path = write_level2(obs(spark, d).select("dtm", "value"), scratch_path(spark, "yearly"), "MKN", "meteo", "1h", simplify=False)
    return spark.read.parquet(path).groupBy("year").agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"))


@query("K13_harvest_rewrite", "SELECT DISTINCT device, epoch_us(dtm) AS us, o3, flowa FROM thermo WHERE dtm IS NOT NULL", with_obs=False)
def k13(spark, d):
    """Same-named files united, distinct rows only, written again; what comes twice adds nothing."""
    rows = table(spark, d, "thermo").select("device", "dtm", "o3", "flowa").filter("dtm is not null")
    target = scratch_path(spark, "harvested")
    for part in (rows.filter("o3 is null"), rows):
        merge_into(part.distinct(), target, ["device", "dtm", "o3", "flowa"])
    return spark.read.parquet(target).distinct().select("device", F.unix_micros("dtm").alias("us"), "o3", "flowa")


@query("T01_sorted_files", "SELECT count(*) FILTER (WHERE us < 0) AS inversions, count(*) AS rows FROM obs")
def t01(spark, d):
    """Rows of a written file stand in order of time."""
    target = scratch_path(spark, "sorted")
    merge_into(obs(spark, d).select("event_id", "dtm"), target, ["event_id"])
    read = spark.read.parquet(target).select("dtm", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("i"))
    before = F.lag("dtm").over(Window.partitionBy("file").orderBy("i"))
    return read.withColumn("back", F.col("dtm") < before).agg(F.count_if("back").alias("inversions"), F.count("*").alias("rows"))


@query("U04_column_difference", "SELECT 'missing' AS kind, 'humidity' AS name UNION ALL SELECT 'unexpected', column_name FROM (DESCRIBE SELECT * FROM thermo) WHERE column_name NOT IN ('row_id', 'o3', 'hio3')", with_obs=False)
def u04(spark, d):
    missing, unexpected = columns.columns_missing(table(spark, d, "thermo"), ["row_id", "o3", "hio3", "humidity"])
    return spark.createDataFrame([("missing", c) for c in missing] + [("unexpected", c) for c in unexpected], "kind string, name string")


@query("J06_positional", "+a AS (SELECT event_type, value, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS place FROM obs), b AS (SELECT event_type, k, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS place FROM obs WHERE f IS NULL OR f = 0 OR value > 100) SELECT event_type, place, value, k FROM a LEFT JOIN b USING (event_type, place)")
def j06(spark, d):
    rows = obs(spark, d)
    left = rows.select("event_type", "event_id", "value")
    right = rows.filter("f is null or f = 0 or value > 100").select("event_type", "event_id", "k")
    return joins.positional(left, right, ["event_type"], "event_id").withColumn("place", F.col("place").cast("long"))


@query("A06_hours_over_files", "SELECT epoch(date_trunc('hour', dtm))::BIGINT AS start, round(sum(CASE WHEN f = 0 THEN value END), 6) AS rre, round(avg(k), 6) AS tre FROM obs GROUP BY 1")
def a06(spark, d):
    """Hours that lie in several files are aggregated once, over the rows of all of them."""
    rows = obs(spark, d).select("event_type", "dtm", F.col("value").alias("rre"), F.col("f").alias("f_rre"), F.col("k").alias("tre"))
    files = [rows.filter(F.col("event_type") == "click").drop("event_type"), rows.filter(F.col("event_type") != "click").drop("event_type")]
    out = aggregate.meteo_hourly(merge.relaxed_union(*files), precipitation=["rre"], identity=())
    return out.select(sec("dtm").alias("start"), r6("rre").alias("rre"), r6("tre").alias("tre"))


@query("F13_cadences_and_months", "SELECT 'month ' || m AS text, dayofyear(make_date(2024, m::INTEGER, 1))::BIGINT AS first, dayofyear(last_day(make_date(2024, m::INTEGER, 1)))::BIGINT AS last FROM range(1, 13) r(m) UNION ALL SELECT text, s, s FROM (VALUES ('10s', 10), ('5min', 300), ('1mn', 60), ('1h', 3600), ('1d', 86400)) v(text, s)", with_obs=False)
def f13(spark, d):
    months = [(f"month {m}", *month_days_of_year(2024, m)) for m in range(1, 13)]
    return spark.createDataFrame(months + [(t, cadence_seconds(t), cadence_seconds(t)) for t in ("10s", "5min", "1mn", "1h", "1d")], "text string, first long, last long")


@query("R22_drop_empty_rows", "SELECT row_id FROM level1_rows WHERE coalesce(NOT isnan(value), false) OR coalesce(NOT isnan(aux), false) OR flag IS NOT NULL OR note IS NOT NULL", with_obs=False)
def r22(spark, d):
    return validity.drop_empty_rows(table(spark, d, "level1_rows"), ["value", "aux", "flag", "note"]).select("row_id")


@query("R27_cleaned_files", "SELECT us // 1000000 AS t, value AS bc6, k AS ssp1 FROM obs WHERE f IS NULL OR f = 0")
def r27(spark, d):
    """Two instruments' cleaned tables with two header lines each, joined where both have the time."""
    rows = obs(spark, d)
    stamp = F.date_format("dtm", ISO)
    bc = _read(_files(rows, _text(stamp, "value", "event_id"), "time,BC6,BC1\n,ng/m3,\n"), "cleaned").select("dtm", F.col("BC6").alias("bc6"), F.col("BC1").alias("id"))
    sc = _read(_files(rows.filter("f is null or f = 0"), _text(stamp, "k", "event_id"), "time,ssp1,ssp2\n,1/Mm,\n"), "cleaned").select("dtm", "ssp1", F.col("ssp2").alias("id"))
    return bc.join(sc, ["dtm", "id"]).select(sec("dtm").alias("t"), "bc6", "ssp1")
