"""TAHMO stations: long readings to a wide table, and pairs of calibrated and raw exports."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolake.functions.timeparse import offset_to_utc


def conflicting_readings(readings: DataFrame) -> DataFrame:
    """Measurements that have differing readings at their highest mrid."""
    top = readings.groupBy("device_sn", "dtm", "measurement").agg(F.max("mrid").alias("mrid"))
    at_top = readings.join(top, ["device_sn", "dtm", "measurement", "mrid"])
    return at_top.groupBy("device_sn", "dtm", "measurement").agg(F.count_distinct(F.struct(F.col("value"), F.col("error_flag"))).alias("n"), F.count_distinct(F.hash("value", "error_flag")).alias("m")).filter("greatest(n, m) > 1").select("device_sn", "dtm", "measurement")


def wide(readings: DataFrame, variables: Mapping[str, str]) -> DataFrame:
    """One row per time: the reading of the highest mrid of each variable, its flag and its source error.

    ``variables``: measurement -> column. The flag is 1 for a missing value or an error; a variable without a reading has
    flag 1 and no error. The row's mrid is the highest of its readings. The pivot's columns are given, so it is one shuffle.
    """
    best = readings.filter(F.col("measurement").isin(list(variables))).groupBy("device_sn", "dtm", "measurement").agg(F.max_by(F.struct("value", "error_flag"), F.struct("mrid", "value")).alias("r"), F.max("mrid").alias("mrid"))
    w = best.groupBy("device_sn", "dtm").agg(F.max("mrid").alias("mrid"), *[F.max_by("r", F.when(F.col("measurement") == m, 1)).alias(f"_{c}") for m, c in variables.items()], *[F.count_if(F.col("measurement") == m).alias(f"_n_{c}") for m, c in variables.items()])
    cols = []
    for c in variables.values():
        has = F.col(f"_n_{c}") > 0
        value, error = F.when(has, F.col(f"_{c}.value")), F.when(has, F.col(f"_{c}.error_flag"))
        cols += [value.alias(c), F.when(value.isNull() | (error == 1), 1).otherwise(0).cast("tinyint").alias(f"f_{c}"), error.cast("tinyint").alias(f"{c}_err")]
    return w.select("dtm", "device_sn", "mrid", *cols)


def calibrated_batch(calibrated: DataFrame, raw: DataFrame, fallback_offset: str | None = None) -> DataFrame:
    """Calibrated values with the raw export's record id and UTC time, joined line by line.

    Both have ``file``, ``line`` and ``stamp`` (local time); raw also ``rid`` and ``offset``. A pair whose stamps differ, or
    a record without an offset where no fallback is given, is an error.
    """
    c, r = calibrated.alias("c"), raw.alias("r")
    j = c.join(r, (F.col("c.file") == F.col("r.file")) & (F.col("c.line") == F.col("r.line")), "full")
    offset = F.coalesce(F.when(F.trim("r.offset") != "", F.col("r.offset")), F.lit(fallback_offset))
    same = F.coalesce(F.col("c.stamp") == F.col("r.stamp"), F.lit(False))
    dtm = F.when(~same, F.raise_error(F.concat(F.lit("stamps differ in "), F.coalesce("c.file", "r.file"))).cast("timestamp")).when(offset.isNull(), F.raise_error(F.lit("a record has no UTC offset")).cast("timestamp")).otherwise(offset_to_utc(F.col("c.stamp"), offset))
    values = [F.col(f"c.{x}") for x in calibrated.columns if x not in ("file", "line", "stamp")]
    return j.select(dtm.alias("dtm"), F.col("r.rid").alias("mrid"), *values)


def export_readings(rows: DataFrame, fallback_offset: str | None = None, start: str | None = None) -> DataFrame:
    """Readings of logger exports in UTC: ``device_sn, dtm, device_rid, measurement, value, flag``.

    rows: as read by the ``tahmo_export`` format. Calibrated records are joined with the raw file's by file and line; a
    pair whose stamps or devices differ, a record that only one of them has, an unset offset without a fallback, or an offset other than
    the fallback, is an error. Without any raw file the fallback offset holds. ``flag`` is 1 for a missing value. ``start``: the
    first day, in UTC. Many files are one shuffle by file and line; readings stay long, for :func:`wide`'s pivot.
    """
    raw = rows.filter("raw = 1").select(*[F.col(c).alias(f"r_{c}") for c in ("file", "line", "device_sn", "stamp", "rid", "offset")])
    cal = rows.filter("raw = 0").drop("rid", "offset")
    files = raw.select(F.col("r_file").alias("f")).distinct().withColumn("paired", F.lit(True))
    j = cal.join(raw, (F.col("file") == F.col("r_file")) & (F.col("line") == F.col("r_line")), "full").join(files, F.coalesce("file", "r_file") == F.col("f"), "left")
    paired = F.coalesce("paired", F.lit(False))
    offset = F.coalesce(F.when(F.col("r_offset") != "", F.col("r_offset")), F.lit(fallback_offset))
    where = lambda text: F.raise_error(F.concat(F.lit(text), F.coalesce("file", "r_file"), F.lit(", record "), F.coalesce("line", "r_line").cast("string"))).cast("string")
    same = F.coalesce((F.col("stamp") == F.col("r_stamp")) & (F.col("device_sn") == F.col("r_device_sn")), F.lit(False))
    checked = (
        F.when(paired & ~same, where("stamps or devices differ in "))
        .when(offset.isNull(), where("no UTC offset in "))
        .when(F.lit(fallback_offset).isNotNull() & (offset != F.lit(fallback_offset)), where("another UTC offset than the given one in "))
        .otherwise(offset)
    )
    dtm = offset_to_utc(F.to_timestamp("stamp", "yyyy/MM/dd HH:mm:ss"), checked)
    out = j.select("device_sn", dtm.alias("dtm"), F.col("r_rid").alias("device_rid"), "measurement", "value", F.col("value").isNull().cast("tinyint").alias("flag"))
    return out.filter(F.col("dtm") >= F.lit(start).cast("timestamp")) if start else out
