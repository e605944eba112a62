"""Calendar windows: fixed and calendar periods, closed and labelled as asked, in any zone."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_CALENDAR = {"mo": "month", "month": "month", "monthly": "month", "q": "quarter", "y": "year", "yearly": "year"}
_NAMED = {"hour": 3600, "hourly": 3600, "day": 86_400, "daily": 86_400}
_UNITS = {"s": 1, "m": 60, "min": 60, "h": 3600, "d": 86_400, "w": 604_800}
_WEEK_SHIFT = 4 * 86_400  # 1970-01-05 was a Monday


def period(text: str) -> tuple[str, int]:
    """("fixed", seconds) or (calendar unit, 1) of a period such as hourly, 1h, 10min, 1d, 1w, 1mo, monthly or 1y."""
    t = text.strip().lower()
    if t in _NAMED:
        return "fixed", _NAMED[t]
    m = re.fullmatch(r"(\d*)([a-z]+)", t)
    if m and m[2] in _CALENDAR and m[1] in ("", "1"):
        return _CALENDAR[m[2]], 1
    if m and m[2] in _UNITS and m[1] and int(m[1]) > 0:
        return "fixed", int(m[1]) * _UNITS[m[2]]
    raise ValueError(f"not a period: {text!r}")


def _start(ts: Column, kind: str, seconds: int) -> Column:
    if kind != "fixed":
        return F.date_trunc(kind, ts)
    shift = _WEEK_SHIFT if seconds % 604_800 == 0 else 0
    us = F.unix_micros(ts) - shift * 1_000_000
    return F.timestamp_micros((F.floor(us / F.lit(seconds * 1_000_000)) * seconds * 1_000_000 + shift * 1_000_000).cast("long"))


def _next(start: Column, kind: str, seconds: int) -> Column:
    return start + F.expr(f"INTERVAL 1 {kind.upper()}" if kind not in ("fixed", "quarter") else ("INTERVAL 3 MONTH" if kind == "quarter" else f"INTERVAL {seconds} SECOND"))


def _previous(start: Column, kind: str, seconds: int) -> Column:
    return start - F.expr(f"INTERVAL 1 {kind.upper()}" if kind not in ("fixed", "quarter") else ("INTERVAL 3 MONTH" if kind == "quarter" else f"INTERVAL {seconds} SECOND"))


def bucket(ts: Column, every: str, closed: str = "left", zone: str | None = None) -> Column:
    """The window's start, an array of starts for closed=both or none (two, one or no window holds a boundary).

    closed: ``left`` [a, b), ``right`` (a, b], ``both`` [a, b], ``none`` (a, b). With a zone, windows follow its calendar.
    """
    kind, seconds = period(every)
    local = F.from_utc_timestamp(ts, zone) if zone else ts
    start = _start(local, kind, seconds)
    on_edge = start == local
    back = _previous(start, kind, seconds)
    utc = (lambda c: F.to_utc_timestamp(c, zone)) if zone else (lambda c: c)
    if closed == "left":
        return utc(start)
    if closed == "right":
        return utc(F.when(on_edge, back).otherwise(start))
    if closed == "both":
        return F.when(on_edge, F.array(utc(back), utc(start))).otherwise(F.array(utc(start)))
    if closed == "none":
        return F.when(~on_edge, F.array(utc(start))).otherwise(F.array().cast("array<timestamp>"))
    raise ValueError(f"closed must be left, right, both or none, not {closed!r}")


def window_end(start: Column, every: str) -> Column:
    """The end of a window that starts at ``start``."""
    kind, seconds = period(every)
    return _next(start, kind, seconds)
