"""Coverage, cadence and availability of observation tables, and their fingerprints."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerolake.operators.joins import with_scalars


def coverage_pivot(df: DataFrame, time: str, by: str, values: Sequence[str]) -> DataFrame:
    """Rows by day and instrument, 0 where there are none. The instruments are given, so the pivot needs no extra scan."""
    wide = df.groupBy(F.to_date(time).alias("date")).pivot(by, list(values)).agg(F.count(F.lit(1)))
    return wide.fillna(0, list(values))


def modal_interval(df: DataFrame, time: str, keys: Sequence[str]) -> DataFrame:
    """The most frequent positive difference of successive times in seconds; the smallest among equals."""
    w = Window.partitionBy(*keys).orderBy(time)
    d = df.select(*keys, (F.unix_micros(time) - F.lag(F.unix_micros(time)).over(w)).alias("_us")).filter("_us > 0").withColumn("seconds", F.col("_us") / 1e6)
    n = d.groupBy(*keys, "seconds").agg(F.count("*").alias("n"))
    return n.groupBy(*keys).agg(F.max_by("seconds", F.struct("n", -F.col("seconds"))).alias("seconds"), F.max("n").alias("n"))


def median_interval(df: DataFrame, time: str, keys: Sequence[str], last: int = 10_000) -> DataFrame:
    """The median positive difference of the newest ``last`` times, in seconds."""
    w = Window.partitionBy(*keys)
    newest = df.filter(F.col(time).isNotNull()).withColumn("_r", F.row_number().over(w.orderBy(F.desc(time)))).filter(F.col("_r") <= last)
    d = newest.withColumn("_d", (F.unix_micros(time) - F.lag(F.unix_micros(time)).over(w.orderBy(time))) / 1e6).filter("_d > 0")
    return d.groupBy(*keys).agg(F.percentile("_d", 0.5).alias("seconds"))


def availability(df: DataFrame, time: str, start: Column, now: Column, cadence_s: int, keys: Sequence[str] = ()) -> DataFrame:
    """Occupied and expected cadence slots from ``start`` to ``now`` and their percentage; never over 100."""
    expected = F.floor((F.unix_micros(now) - F.unix_micros(start)) / F.lit(cadence_s * 1_000_000)) + 1
    slot = F.floor((F.unix_micros(time) - F.unix_micros(start)) / F.lit(cadence_s * 1_000_000))
    inside = F.when((slot >= 0) & (slot < expected), slot)
    out = df.groupBy(*keys).agg(F.count_distinct(inside).alias("observed")).withColumn("expected", expected.cast("long"))
    return out.withColumn("percent", F.round(100 * F.col("observed") / F.col("expected"), 3))


def time_profile(df: DataFrame, time: str, keys: Sequence[str] = ()) -> DataFrame:
    """Rows, null times, distinct times, duplicates and the latest time."""
    t = F.col(time)
    out = df.groupBy(*keys).agg(F.count("*").alias("rows"), F.count_if(t.isNull()).alias("null_times"), F.count_distinct(t).alias("unique_times"), F.max(t).alias("latest"))
    return out.withColumn("duplicates", F.col("rows") - F.col("null_times") - F.col("unique_times"))


def row_hash(df: DataFrame) -> Column:
    return F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])


def similarity(df: DataFrame, by: str, time: str, value: str) -> DataFrame:
    """Per file: span, least, greatest and mean value and a hash of the content that disregards order."""
    rest = df.drop(by)
    return df.groupBy(by).agg(F.count("*").alias("rows"), F.min(time).alias("first"), F.max(time).alias("last"), F.min(value).alias("min"), F.max(value).alias("max"), F.avg(value).alias("mean"), F.bit_xor(row_hash(rest)).alias("content"))


def files_per_day(paths: DataFrame, path: str, instrument: Column, day: Column, last_days: int | None = None) -> DataFrame:
    """Files by instrument and day of their names, the last days only if asked."""
    out = paths.select(instrument.alias("instrument"), day.alias("date"), F.col(path)).filter("date is not null")
    if last_days:
        newest = out.agg(F.date_sub(F.max("date"), last_days - 1).alias("_from"))
        out = out.join(F.broadcast(newest), F.col("date") >= F.col("_from")).drop("_from")  # one row
    return out.groupBy("instrument", "date").agg(F.count("*").alias("files"))


def temporal_coverage(df: DataFrame, time: str, base: str, days: int, keys: Sequence[str] = ()) -> DataFrame:
    """The share of the last ``days`` days with data, from counts per base period."""
    per_day = df.groupBy(*keys, F.date_trunc(base, time).alias("_b")).agg(F.count("*").alias("_n")).groupBy(*keys, F.to_date("_b").alias("_d")).agg(F.count("*").alias("_bins"))
    newest = per_day.groupBy(*keys).agg(F.max("_d").alias("_last"))
    inside = per_day.join(newest, list(keys)) if keys else with_scalars(per_day, newest)
    return inside.filter(F.col("_d") > F.date_sub("_last", days)).groupBy(*keys).agg((F.count("*") / days).alias("share"), F.sum("_bins").alias("bins"))


def text_fingerprint(df: DataFrame, columns: Sequence[str]) -> Column:
    """MD5 of a row's columns as separated text."""
    return F.md5(F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]))
