"""Vectorised parsing of numbers and instants on Arrow arrays."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: A decimal number, exponents allowed.
NUMBER_RE = r"^[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?$"
_TIME = r"(?P<H>\d{1,2}):(?P<M>\d{2})(?::(?P<S>\d{2})(?P<f>\.\d+)?)?\s*(?P<ap>[AaPp][Mm])?\s*(?P<z>[Zz]|[+-]\d{2}:?\d{2})?$"
_YMD = r"^(?P<y>\d{4})(?P<s>[-/.])(?P<m>\d{1,2})[-/.](?P<d>\d{1,2})(?:[Tt]|\s+)" + _TIME
_MDY = r"^(?P<m>\d{1,2})/(?P<d>\d{1,2})/(?P<y>\d{4})(?:[Tt]|\s+)" + _TIME
_MONTH_DAYS = np.array([31, 28, 31, 30, 31, 30, 31, 31, 30, 31, 30, 31])


def slice_strings(buf: np.ndarray, begin: np.ndarray, end: np.ndarray) -> pa.StringArray:
    """The byte ranges ``[begin, end)`` of a UTF-8 buffer as a string array, by one gather."""
    length = np.maximum(end - begin, 0)
    offs = np.concatenate([[0], np.cumsum(length)])
    at = np.repeat(begin - offs[:-1], length) + np.arange(offs[-1])
    return pa.StringArray.from_buffers(len(length), pa.py_buffer(offs.astype(np.int32).tobytes()), pa.py_buffer(buf[at].tobytes()))


def parse_instants(text: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
    """Microseconds since the epoch (UTC where no offset is written), and which entries are real instants.

    Accepted: year-month-day or month/day/year, then a time of day with hours and minutes, seconds, fraction, AM or PM
    and an offset optional.
    """
    n = len(text)
    us, good = np.zeros(n, np.int64), np.zeros(n, bool)
    for pattern in (_YMD, _MDY):
        got = pc.extract_regex(text, pattern)
        hit = np.flatnonzero(np.asarray(got.is_valid()) & ~good)
        if not len(hit):
            continue
        rows = got.take(pa.array(hit))

        def part(name: str, rows=rows) -> pa.StringArray:
            return rows.field(name)

        def num(name: str, part=part) -> np.ndarray:
            x = part(name)
            return np.asarray(pc.cast(pc.if_else(pc.equal(x, ""), "0", x), pa.int64()))

        y, m, d, hh, mi, ss = (num(k) for k in ("y", "m", "d", "H", "M", "S"))
        frac = part("f")
        fus = np.round(np.asarray(pc.cast(pc.if_else(pc.equal(frac, ""), ".0", frac), pa.float64())) * 1e6).astype(np.int64)
        ap = np.asarray(pc.utf8_lower(part("ap")).to_pylist(), object)
        has_ap = ap != ""
        ok = (y >= 1) & (m >= 1) & (m <= 12) & (d >= 1) & (mi < 60) & (ss < 60) & np.where(has_ap, (hh >= 1) & (hh <= 12), hh < 24)
        leap = ((y % 4 == 0) & (y % 100 != 0)) | (y % 400 == 0)
        ok &= d <= _MONTH_DAYS[np.clip(m, 1, 12) - 1] + (leap & (m == 2))
        hh = np.where(has_ap, hh % 12 + 12 * (ap == "pm"), hh)
        zone = part("z").to_pylist()
        shift = np.array([0 if z in ("", "Z", "z") else (1 if z[0] == "+" else -1) * (int(z[1:3]) * 60 + int(z[-2:])) for z in zone], np.int64)
        mm = np.clip(m, 1, 12)
        day = ((y - 1970) * 12 + (mm - 1)).astype("datetime64[M]").astype("datetime64[D]").astype(np.int64) + d - 1
        value = ((day * 24 + hh) * 60 + mi - shift) * 60_000_000 + ss * 1_000_000 + fus
        us[hit[ok]] = value[ok]
        good[hit[ok]] = True
    return us, good
