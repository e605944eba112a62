"""Quantities recorded in different units, brought to common units.

A small grammar reads numbers and unit expressions. A unit is a vector of exponents over the base dimensions with a
scale and an offset to SI; two units can be converted if their vectors are equal. Readings without a stated unit take
the unit in which they agree with the other readings of their source.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolake.session import materialize

# --- fixed values: base dimensions (mass, length, time, temperature, amount), units and prefixes -----------------------
DIMENSIONS = ("mass", "length", "time", "temperature", "amount")
#: symbol -> (exponents, scale to SI, offset to SI)
UNITS = {
    "g": ((1, 0, 0, 0, 0), 1e-3, 0.0), "m": ((0, 1, 0, 0, 0), 1.0, 0.0), "l": ((0, 3, 0, 0, 0), 1e-3, 0.0),
    "s": ((0, 0, 1, 0, 0), 1.0, 0.0), "min": ((0, 0, 1, 0, 0), 60.0, 0.0), "h": ((0, 0, 1, 0, 0), 3600.0, 0.0),
    "K": ((0, 0, 0, 1, 0), 1.0, 0.0), "degC": ((0, 0, 0, 1, 0), 1.0, 273.15), "degF": ((0, 0, 0, 1, 0), 5 / 9, 459.67 * 5 / 9),
    "mol": ((0, 0, 0, 0, 1), 1.0, 0.0), "Pa": ((1, -1, -2, 0, 0), 1.0, 0.0), "bar": ((1, -1, -2, 0, 0), 1e5, 0.0),
    "mmHg": ((1, -1, -2, 0, 0), 133.322387415, 0.0), "atm": ((1, -1, -2, 0, 0), 101325.0, 0.0),
}
PREFIXES = {"n": 1e-9, "u": 1e-6, "m": 1e-3, "c": 1e-2, "d": 1e-1, "h": 1e2, "k": 1e3}
PREFIX_WORDS = {"nano": "n", "micro": "u", "milli": "m", "centi": "c", "hecto": "h", "kilo": "k"}
WORDS = {
    "gram": "g", "gramme": "g", "metre": "m", "meter": "m", "litre": "l", "liter": "l", "second": "s", "minute": "min",
    "hour": "h", "kelvin": "K", "celsius": "degC", "fahrenheit": "degF", "mole": "mol", "pascal": "Pa",
}
SUPERSCRIPTS = str.maketrans("⁰¹²³⁴⁵⁶⁷⁸⁹⁻⁺", "0123456789-+")
# ---------------------------------------------------------------------------------------------------------------------

_NUMBER = re.compile(r"(?<![\w.])[+-]?(?:\d+(?:[.,]\d+)*|\.\d+)(?:[eE][+-]?\d+)?")
_SYMBOL = re.compile(r"°\s?[CFcf]|[A-Za-zµμ]+")
_EXPONENT = re.compile(r"\s?(?:\*\*|\^)?\s?([+-]?\d)(?!\d|\.\d)|([⁻⁺]?[⁰¹²³⁴⁵⁶⁷⁸⁹])")
_JOIN = re.compile(r"\s*(?:(/)|\b(per)\b|([·*.⋅])(?!\*)|(\s))\s*")


@dataclass(frozen=True)
class Unit:
    """A parsed unit: its exponent vector, scale and offset to SI, and its factors in one spelling (``ug/m3``)."""

    dims: tuple[int, ...]
    scale: float
    offset: float
    code: str


def _symbol(text: str, loose: bool) -> tuple[str, str] | None:
    """(prefix, unit) of one symbol or word."""
    t = text.replace("µ", "u").replace("μ", "u").replace("°", "deg").replace(" ", "")
    if t.lower() in ("degc", "degf"):
        return "", "deg" + t[-1].upper()
    low = t.lower()
    for word in (low, low.removesuffix("s")):
        for long, short in ({"": ""} | PREFIX_WORDS).items():
            if word.startswith(long) and word[len(long) :] in WORDS:
                return short, WORDS[word[len(long) :]]
    names = {u.lower(): u for u in UNITS} if loose else {u: u for u in UNITS} | {"L": "l"}
    t = low if loose else t
    if t in names:
        return "", names[t]
    if t.startswith("mcg"):
        return "u", "g"
    if t[:1] in PREFIXES and t[1:] in names:
        return t[0], names[t[1:]]
    return None


def _parse_at(text: str, at: int, loose: bool) -> tuple[Unit, int] | None:
    """The longest unit expression that starts at ``at``, and its end.

    expression := factor {("/" | "per" | "·" | "*" | blank) factor};  factor := ["cubic" | "square"] symbol [exponent]
    """
    factors: dict[tuple[str, str], int] = {}
    sign, end, first = 1, at, True
    while True:
        pos = end
        if not first:
            j = _JOIN.match(text, pos)
            if not j:
                break
            sign = -1 if (j[1] or j[2]) else 1
            pos = j.end()
        m = _SYMBOL.match(text, pos)
        power = 1
        if m and m[0].lower() in ("cubic", "square"):
            power = 3 if m[0].lower() == "cubic" else 2
            gap = re.compile(r"\s+").match(text, m.end())
            m = _SYMBOL.match(text, gap.end()) if gap else None
        got = _symbol(m[0], loose) if m else None
        if not got:
            break
        end = m.end()
        e = _EXPONENT.match(text, end)
        if e and power == 1:
            power = int((e[1] or e[2]).translate(SUPERSCRIPTS))
            end = e.end()
        factors[got] = factors.get(got, 0) + sign * power
        first = False
    if first or (end < len(text) and (text[end].isalpha() or text[end] == "_")):
        return None
    dims, scale, offset = [0] * len(DIMENSIONS), 1.0, 0.0
    for (prefix, unit), power in factors.items():
        vec, s, off = UNITS[unit]
        dims = [a + b * power for a, b in zip(dims, vec, strict=True)]
        scale *= (PREFIXES.get(prefix, 1.0) * s) ** power
        offset = off if len(factors) == 1 and power == 1 else 0.0
    up = [p + u + (str(n) if n > 1 else "") for (p, u), n in factors.items() if n > 0]
    down = [p + u + (str(-n) if n < -1 else "") for (p, u), n in factors.items() if n < 0]
    return Unit(tuple(dims), scale, offset, " ".join(up) + "".join("/" + d for d in down)), end


def _find(text: str, dims: tuple[int, ...] | None, bare: bool) -> tuple[Unit, int, int] | None:
    """The first unit expression in running text (of the given dimension), with its place.

    ``bare``: only one without a number before it; "0.02 mg/m3" in a remark is another quantity, not this reading's unit.
    """
    loose = not re.search(r"[a-z]", re.sub(r"\b(?:per|cubic|square)\b", "", text))
    numbers = [m.end() for m in _NUMBER.finditer(text)]
    for m in re.finditer(r"(?<![A-Za-zµμ_])[A-Za-zµμ°]", text):
        for case in (loose, True):
            got = _parse_at(text, m.start(), case)
            if got and (dims is None or got[0].dims == dims) and not (dims is None and set(got[0].dims) == {0}):
                if bare and any(not text[e : m.start()].strip() for e in numbers if e <= m.start()):
                    break
                return got[0], m.start(), got[1]
    return None


@lru_cache(100_000)
def parse_unit(text: str, dims: tuple[int, ...] | None = None) -> Unit | None:
    """The unit that ``text`` as a whole spells, brackets aside; null if it is none (or of another dimension)."""
    t = re.sub(r"[\[\](){}]", " ", text).strip()
    if not t:
        return None
    for loose in (not re.search(r"[a-z]", t), True):
        got = _parse_at(t, 0, loose)
        if got and got[1] == len(t) and (dims is None or got[0].dims == dims):
            return got[0]
    return None


@lru_cache(100_000)
def unit_in_remark(text: str, dims: tuple[int, ...]) -> Unit | None:
    """The unit that a remark states for the reading, by a bare unit expression of the right dimension."""
    got = _find(text, dims, bare=True)
    return got[0] if got else None


@lru_cache(100_000)
def parse_quantity(text: str, dims: tuple[int, ...]) -> tuple[float | None, Unit | None]:
    """Number and unit of a text such as ``12.5 ug/m3``, ``[ng/m3] 80`` or ``ca. 7,5 mg m-3``."""
    got = _find(text, dims, bare=False)
    rest = text[: got[1]] + " " + text[got[2] :] if got else text
    m = _NUMBER.search(rest)
    if not m:
        return None, got[0] if got else None
    n = m[0]
    n = n.replace(",", "") if "." in n or n.count(",") > 1 else n.replace(",", ".")
    try:
        return float(n), got[0] if got else None
    except ValueError:
        return None, got[0] if got else None


@dataclass(frozen=True)
class Quantity:
    """A measured quantity: its column, the instruments that report it, and its common unit.

    ``guess``: the unit codes that a reading without a stated unit may have.
    """

    column: str
    instruments: tuple[str, ...]
    common: str
    guess: tuple[str, ...] = ("ug/m3", "mg/m3", "ng/m3")


PARTICLE_QUANTITIES = (
    Quantity("pm25_conc", ("avo", "fidas"), "ug/m3"),
    Quantity("ir880", ("ae31",), "ng/m3"),
    Quantity("bc6", ("ae33",), "ng/m3"),
)


def harmonize(readings: DataFrame, quantities: tuple[Quantity, ...] = PARTICLE_QUANTITIES, keep_unreadable: bool = False) -> DataFrame:
    """All readings in common units.

    readings: ``reading_id, source, instrument, value_text, unit, note`` and the quantities' columns; ``dtm`` is passed on
    if it is there, others are ignored.
    Output: ``reading_id, source, quantity, raw_value, unit_code, unit_from, value``; ``value`` is in the quantity's common
    unit. The unit is taken from ``unit``, else from ``value_text``, else from a bare unit expression in ``note``
    (``unit_from`` says which); a text that spells no unit of the quantity's dimension states nothing. Without a stated unit
    the candidate is chosen whose logarithm lies nearest to the median of the source's readings with a stated unit, else
    of all readings of the quantity with one (``inferred``), ties and zero readings going to the common unit.

    A unit's scale and offset to SI both count, so 20 degC are 293.15 K.

    Null and NaN readings without a readable text give no row (with ``keep_unreadable``, a text that holds no number gives
    a row with null values), nor does a row of an unknown instrument without a number in
    any of the columns; repeated rows are converted each; null sources form one source; an empty table gives an empty one.

    Scale: texts are parsed once per distinct spelling and worker (Arrow batches, a memory of 100 000 spellings), into a table in the shared folder; one aggregation to a median per source with
    map-side sketches; the medians (a row per source) are joined back, which AQE broadcasts only while they are small.
    """
    by_name = {q.column: q for q in quantities}
    number = F.coalesce(*[F.when(~F.isnan(F.col(q.column).cast("double")), F.col(q.column).cast("double")) for q in quantities])
    name = F.coalesce(*[F.when(F.col(q.column).isNotNull() & ~F.isnan(F.col(q.column).cast("double")), F.lit(q.column)) for q in quantities], *[F.when(F.lower("instrument").isin(*q.instruments), F.lit(q.column)) for q in quantities])
    src = readings.select(F.col("reading_id").cast("long"), F.col("source").cast("string"), name.alias("quantity"), number.alias("number"), F.when(number.isNull(), F.col("value_text").cast("string")).alias("value_text"), F.col("value_text").cast("string").alias("any_text"), F.col("unit").cast("string"), F.col("note").cast("string"), *([F.col("dtm")] if "dtm" in readings.columns else []))
    src = src.filter(F.col("quantity").isNotNull() & (F.col("number").isNotNull() | F.col("value_text").isNotNull()))

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            codes, origins, numbers, scales, shifts = [], [], [], [], []
            for q, n, text, spoken, unit, note in zip(pdf["quantity"], pdf["number"], pdf["value_text"], pdf["any_text"], pdf["unit"], pdf["note"], strict=True):
                want = parse_unit(by_name[q].common)
                got, origin = (parse_unit(unit, want.dims), "unit") if unit else (None, None)
                if spoken and (got is None or text):
                    value, of_text = parse_quantity(spoken, want.dims)
                    n = value if text else n
                    if got is None and of_text is not None:
                        got, origin = of_text, "value_text"
                if got is None and note:
                    got, origin = unit_in_remark(note, want.dims), "note"
                codes.append(got.code if got else None)
                origins.append(origin if got else None)
                scales.append(got.scale / want.scale if got else None)
                shifts.append((got.offset - want.offset) / want.scale if got else None)
                numbers.append(n)
            yield pd.DataFrame({**({"dtm": pdf["dtm"]} if "dtm" in pdf else {}), "reading_id": pdf["reading_id"], "source": pdf["source"], "quantity": pdf["quantity"], "raw_value": pd.array(numbers, dtype="Float64"), "unit_code": codes, "unit_from": origins, "scale": pd.array(scales, dtype="Float64"), "shift": pd.array(shifts, dtype="Float64")})

    time = "dtm timestamp, " if "dtm" in src.columns else ""
    parsed = src.mapInPandas(parse, time + "reading_id long, source string, quantity string, raw_value double, unit_code string, unit_from string, scale double, shift double")
    if not keep_unreadable:
        parsed = parsed.filter(F.col("raw_value").isNotNull() & ~F.isnan("raw_value"))
    parsed = materialize(parsed, "units")  # parsed once, though read for the medians and for the result
    level = F.log10(F.abs(F.nullif(F.col("raw_value") * F.col("scale") + F.col("shift"), F.lit(0.0))))
    stated = parsed.filter(F.col("scale").isNotNull() & (F.col("raw_value") != 0) & ~F.isnan("raw_value"))
    own = stated.groupBy("source", "quantity").agg(F.percentile_approx(level, 0.5, 10_000).alias("own_level"))
    whole = own.groupBy("quantity").agg(F.percentile_approx("own_level", 0.5, 10_000).alias("all_level"))
    joined = parsed.alias("p").join(own.alias("o"), F.col("p.source").eqNullSafe(F.col("o.source")) & (F.col("p.quantity") == F.col("o.quantity")), "left").select("p.*", "own_level").join(whole, "quantity", "left")
    target = F.coalesce("own_level", "all_level")
    pick = None
    for q in quantities:
        common = parse_unit(q.common)
        units = [(c, parse_unit(c)) for c in dict.fromkeys((q.common, *q.guess))]
        options = [(c, u.scale / common.scale, (u.offset - common.offset) / common.scale) for c, u in units]
        away = lambda s, o: F.abs(F.log10(F.abs(F.nullif(F.col("raw_value") * F.lit(s) + F.lit(o), F.lit(0.0)))) - target)
        ranked = F.array(*[F.struct(F.coalesce(away(s, o), F.lit(float("inf"))).alias("d"), F.lit(int(c != q.common)).alias("k"), F.lit(c).alias("code"), F.lit(s).alias("s"), F.lit(o).alias("o")) for c, s, o in options])
        best = F.when((F.col("raw_value") == 0) | target.isNull(), F.struct(F.lit(0.0).alias("d"), F.lit(0).alias("k"), F.lit(q.common).alias("code"), F.lit(1.0).alias("s"), F.lit(0.0).alias("o"))).otherwise(F.array_min(ranked))
        is_q = F.col("quantity") == q.column
        pick = F.when(is_q, best) if pick is None else pick.when(is_q, best)
    guess = pick
    out = joined.withColumn("guess", guess)
    value = F.col("raw_value") * F.coalesce("scale", F.col("guess.s")) + F.coalesce("shift", F.col("guess.o"))
    return out.select(*(["dtm"] if time else []), "reading_id", "source", "quantity", "raw_value", F.coalesce("unit_code", F.col("guess.code")).alias("unit_code"), F.coalesce("unit_from", F.lit("inferred")).alias("unit_from"), value.alias("value"))


def in_other_unit(readings: DataFrame, quantities: tuple[Quantity, ...] = PARTICLE_QUANTITIES) -> DataFrame:
    """Readings recorded in another unit than the common one: ``reading_id, unit_code``."""
    common = F.create_map(*[x for q in quantities for x in (F.lit(q.column), F.lit(q.common))])
    return harmonize(readings, quantities).filter(F.col("unit_code") != common[F.col("quantity")]).select("reading_id", "unit_code")
