"""Time expressions: tolerant parsing, zones, periods, cadences, decimal years."""

from __future__ import annotations

import re
from calendar import monthrange
from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The spellings of timestamps in raw instrument files, tried in this order.
TIMESTAMP_FORMATS = (
    "yyyy-MM-dd HH:mm:ss[.SSSSSS]", "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][XXX]", "yyyy-MM-dd HH:mm", "yyyy/MM/dd HH:mm:ss", "dd-MMM-yy HH:mm",
    "dd-MMM-yyyy HH:mm:ss", "MM/dd/yyyy hh:mm:ss a", "MM/dd/yyyy HH:mm:ss", "dd.MM.yyyy HH:mm:ss", "dd.MM.yyyy HH:mm", "yyyyMMddHHmm", "yyyyMMddHHmmss", "yyyy-MM-dd",
)
_UNIT_SECONDS = {"s": 1, "sec": 1, "min": 60, "mn": 60, "m": 60, "h": 3600, "hr": 3600, "d": 86_400, "w": 604_800}


def parse_timestamp(text: Column, formats: tuple[str, ...] = TIMESTAMP_FORMATS) -> Column:
    """The first format that fits, else null."""
    t = F.trim(text)
    return F.coalesce(*[F.try_to_timestamp(t, F.lit(f)) for f in formats])


def as_utc(ts: Column, zone: str | None = None) -> Column:
    """A wall-clock time of ``zone`` as UTC; without a zone it is UTC already."""
    return F.to_utc_timestamp(ts, zone) if zone else ts.cast("timestamp")


def offset_to_utc(ts: Column, offset: Column) -> Column:
    """Local time with an offset text such as ``UTC+03:00`` (at most 14 h) to UTC; null for any other offset."""
    sign = F.when(F.regexp_extract(offset, r"([+-])", 1) == "-", -1).otherwise(1)
    hours = F.regexp_extract(offset, r"^UTC[+-](\d{2}):\d{2}$", 1).try_cast("int")
    minutes = F.regexp_extract(offset, r"^UTC[+-]\d{2}:(\d{2})$", 1).try_cast("int")
    shift = sign * (hours * 60 + minutes)
    ok = (minutes < 60) & (F.abs(shift) <= 14 * 60)
    return F.when(ok, ts - F.make_dt_interval(F.lit(0), F.lit(0), shift, F.lit(0)))


def cadence_seconds(text: str) -> int:
    """Seconds of a cadence such as ``10s``, ``5min``, ``1mn``, ``1h`` or ``1d``."""
    m = re.fullmatch(r"\s*(\d+)\s*([a-z]+)\s*", text.lower())
    if not m or m[2] not in _UNIT_SECONDS or int(m[1]) == 0:
        raise ValueError(f"not a cadence: {text!r}")
    return int(m[1]) * _UNIT_SECONDS[m[2]]


def month_days_of_year(year: int, month: int) -> tuple[int, int]:
    """First and last day of the year of a month."""
    first = date(year, month, 1).timetuple().tm_yday
    return first, first + monthrange(year, month)[1] - 1


def decimal_year(ts: Column) -> Column:
    """Year and the passed share of it."""
    start = F.date_trunc("year", ts)
    end = start + F.expr("INTERVAL 1 YEAR")
    return F.year(ts) + (F.unix_micros(ts) - F.unix_micros(start)) / (F.unix_micros(end) - F.unix_micros(start))


def from_decimal_year(x: Column) -> Column:
    """The instant of a decimal year, to the second."""
    start = F.make_timestamp(F.floor(x).cast("int"), F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0))
    end = start + F.expr("INTERVAL 1 YEAR")
    return F.timestamp_seconds(F.round(F.unix_seconds(start) + (x - F.floor(x)) * (F.unix_seconds(end) - F.unix_seconds(start))))


def days_since_new_year(ts: Column, year: Column) -> Column:
    """Days since 1 January of ``year``, to 6 digits."""
    start = F.make_timestamp(year, F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0))
    return F.round((F.unix_micros(ts) - F.unix_micros(start)) / 86_400e6, 6)


def file_name_date(path: Column) -> Column:
    """The date in a file name: eight digits year-month-day, else seven digits day-of-year and year."""
    name = F.element_at(F.split(path, "/"), -1)
    ymd = F.try_to_timestamp(F.nullif(F.regexp_extract(name, r"(?<!\d)((?:19|20)\d{6})", 1), F.lit("")), F.lit("yyyyMMdd"))
    yday = F.try_to_timestamp(F.nullif(F.regexp_extract(name, r"(?<!\d)(\d{3}(?:19|20)\d{2})(?!\d)", 1), F.lit("")), F.lit("DDDyyyy"))
    return F.coalesce(ymd, yday).cast("date")


def three_hourly(day: Column, values: Column, names: tuple[str, str] = ("dtm", "value")) -> Column:
    """A day's list of n values as an array of structs on an even time axis of 24/n hours."""
    step = F.lit(86_400) / F.size(values)
    return F.transform(values, lambda v, i: F.struct(F.timestamp_seconds(F.unix_seconds(day.cast("timestamp")) + (i * step).cast("long")).alias(names[0]), v.alias(names[1])))
