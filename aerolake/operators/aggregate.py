"""Windowed aggregates with valid counts: Level 1 to Level 2, wind vectors, meteo hours, coverage rules."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerolake.functions import numeric
from aerolake.operators.buckets import bucket, window_end
from aerolake.operators.columns import resolve_variables
from aerolake.operators.validity import only_valid, strictly_valid

METHODS = ("mean", "sum", "median", "min", "max", "first", "last", "circular_mean", "std", "count")


def circular_mean(x: Column) -> Column:
    """The mean direction in degrees, 0 up to 360."""
    return F.pmod(F.degrees(F.atan2(F.avg(F.sin(F.radians(x))), F.avg(F.cos(F.radians(x))))), F.lit(360.0))


def aggregate_of(method: str, x: Column, time: Column) -> Column:
    """An aggregate by name over a column that is null where it doesn't count."""
    simple = {"mean": F.avg, "sum": F.sum, "median": F.median, "min": F.min, "max": F.max, "circular_mean": circular_mean, "std": F.stddev_pop, "count": F.count}
    if method in simple:
        return simple[method](x)
    if method in ("first", "last"):
        return (F.min_by if method == "first" else F.max_by)(x, F.when(x.isNotNull(), time))
    raise ValueError(f"unknown method {method!r}; one of {METHODS}")


@dataclass(frozen=True)
class Level2:
    """What to aggregate: variables, methods per variable (and frequency), flag policy, windows.

    methods: variable -> method, or (variable, every) -> method; ``default`` for the rest.
    """

    variables: Sequence[str]
    default: str = "mean"
    methods: Mapping = field(default_factory=dict)
    accept_null_flag: bool = True
    keys: Sequence[str] = ()
    time: str = "dtm"
    closed: str = "left"
    label: str = "left"
    zone: str | None = None

    def method(self, variable: str, every: str) -> str:
        return self.methods.get((variable, every), self.methods.get(variable, self.default))


def level2(df: DataFrame, spec: Level2, every: str) -> DataFrame:
    """One row per window (and key) that has any row: each variable's aggregate over its valid values, and their count.

    Names are resolved whatever their case and come out as configured; a variable that the table lacks is left out. A
    value is null where no valid one is in the window, its count then 0. Every frequency comes directly from ``df``. Rows
    without a time are dropped. One shuffle by window and keys, partial aggregates on the map side for all methods but the
    median.
    """
    variables = resolve_variables(spec.variables, df.columns)
    ts = F.col(spec.time).cast("timestamp")
    cleaned = [only_valid(F.col(v.column), F.col(v.flag) if v.flag else None, spec.accept_null_flag).alias(f"_v{i}") for i, v in enumerate(variables)]
    start = bucket(ts, every, spec.closed, spec.zone)
    rows = df.filter(ts.isNotNull()).select(*spec.keys, ts.alias("_t"), start.alias("_w"), *cleaned)
    if spec.closed in ("both", "none"):
        rows = rows.withColumn("_w", F.explode("_w"))
    aggs: list[Column] = []
    for i, v in enumerate(variables):
        x = F.col(f"_v{i}")
        aggs += [aggregate_of(spec.method(v.name, every), x, F.col("_t")).alias(v.name), F.count(x).alias(v.count)]
    if spec.label == "datapoint":
        aggs.append(F.min("_t").alias("_label"))
    out = rows.groupBy(*spec.keys, "_w").agg(*aggs)
    label = {"left": F.col("_w"), "right": window_end(F.col("_w"), every), "datapoint": F.col("_label") if spec.label == "datapoint" else F.col("_w")}[spec.label]
    return out.select(*spec.keys, label.alias(spec.time), *[c for v in variables for c in (F.when(F.col(v.count) > 0, F.col(v.name)).alias(v.name), v.count)])


def level2_all(df: DataFrame, spec: Level2, frequencies: Sequence[str] = ("1h", "1d", "1mo")) -> dict[str, DataFrame]:
    """Several frequencies of one cleaned table, each directly from Level 1."""
    return {every: level2(df, spec, every) for every in frequencies}


def correct_to_reporting_condition(df: DataFrame, variables: Sequence[str], pressure: str, temperature: str, target_p: float, target_t: float) -> DataFrame:
    """The variables at the reporting condition, and pressure and temperature replaced by it; null where they are invalid.

    All expressions see the original pressure and temperature.
    """
    p, t = F.col(pressure).cast("double"), F.col(temperature).cast("double")
    state = numeric.condition_state(p, t, target_p, target_t)
    new = {v: F.when(state == "at_target", F.col(v).cast("double")).otherwise(numeric.reporting_condition(F.col(v).cast("double"), p, t, target_p, target_t)) for v in variables}
    ok = state != "invalid"
    return df.withColumns(new | {pressure: F.when(ok, F.lit(float(target_p))), temperature: F.when(ok, F.lit(float(target_t)))})


def correction_audit(df: DataFrame, pressure: str, temperature: str, target_p: float, target_t: float) -> DataFrame:
    """Counts of rows by state, and ranges of pressure, temperature and factor; one row."""
    p, t = F.col(pressure).cast("double"), F.col(temperature).cast("double")
    state = numeric.condition_state(p, t, target_p, target_t)
    ok = state != "invalid"
    factor = numeric.reporting_condition(F.lit(1.0), p, t, target_p, target_t)
    return df.agg(*[F.count_if(state == s).alias(f"n_{s}") for s in ("at_target", "corrected", "invalid")], *[f(F.when(ok, x)).alias(f"{n}_{x_name}") for x_name, x in (("p", p), ("t", t), ("factor", factor)) for n, f in (("min", F.min), ("max", F.max))])


def verify_constant(df: DataFrame, expected: Mapping[str, float], tolerance: float = 1e-9) -> None:
    """Raise if a column isn't the same value throughout (null aside)."""
    got = df.agg(*[f(c).alias(f"{n}_{c}") for c in expected for n, f in (("min", F.min), ("max", F.max))]).first()
    for c, value in expected.items():
        for n in ("min", "max"):
            if got[f"{n}_{c}"] is not None and abs(got[f"{n}_{c}"] - value) > tolerance:
                raise ValueError(f"{c}: {n} is {got[f'{n}_{c}']}, not {value}")


def available_and_valid(df: DataFrame, variables: Sequence[str], accept_null_flag: bool = True, keys: Sequence[str] = ()) -> DataFrame:
    """Per group (``keys``, or all rows) and variable the values there are and those that count."""
    found = resolve_variables(variables, df.columns)
    stats = df.groupBy(*keys).agg(*[a for v in found for a in (F.count(F.col(v.column)).alias(f"a_{v.name}"), F.count(only_valid(F.col(v.column), F.col(v.flag) if v.flag else None, accept_null_flag)).alias(f"v_{v.name}"))])
    return stats.select(*keys, F.explode(F.array(*[F.struct(F.lit(v.name).alias("variable"), F.col(f"a_{v.name}").alias("available"), F.col(f"v_{v.name}").alias("valid")) for v in found])).alias("s")).select(*keys, "s.*")


def wind_mean(df: DataFrame, keys: Sequence[Column], speed: Column, direction: Column) -> DataFrame:
    """Vector mean of wind over rows in which speed and direction count: ``speed, direction, n``."""
    both = speed.isNotNull() & direction.isNotNull()
    u = F.when(both, -speed * F.sin(F.radians(direction)))
    v = F.when(both, -speed * F.cos(F.radians(direction)))
    out = df.groupBy(*keys).agg(F.avg(u).alias("_u"), F.avg(v).alias("_v"), F.count(u).alias("n"))
    return out.withColumns({"speed": F.sqrt(F.col("_u") ** 2 + F.col("_v") ** 2), "direction": F.pmod(F.degrees(F.atan2("_u", "_v")) + 180, F.lit(360.0))}).drop("_u", "_v")


def meteo_hourly(df: DataFrame, time: str = "dtm", precipitation: Sequence[str] = (), identity: Sequence[str] = ("iii",), wind: Sequence[tuple[str, str]] = (), empty_sum: float | None = None) -> DataFrame:
    """Hourly meteo: means, sums of precipitation, the first identity, vector means of (speed, direction) pairs.

    Only flag 0 counts where a flag column is there. ``empty_sum``: the sum of an hour without a valid value (null).
    """
    numeric_types = T.NumericType
    paired = {c for pair in wind for c in pair}
    flags = {c: f"f_{c}" for c in df.columns if f"f_{c}" in df.columns}
    cols = [f.name for f in df.schema.fields if isinstance(f.dataType, numeric_types) and f.name != time and not f.name.startswith("f_") and f.name not in identity]

    def x(c: str) -> Column:
        v = F.col(c).cast("double")
        return F.when(strictly_valid(v, F.col(flags[c])), v) if c in flags else v

    aggs = [F.min_by(c, F.when(F.col(c).isNotNull(), F.col(time))).alias(c) for c in identity if c in df.columns]
    aggs += [(F.coalesce(F.sum(x(c)), F.lit(empty_sum).cast("double")) if c in precipitation else F.avg(x(c))).alias(c) for c in cols if c not in paired]
    for s, d in wind:
        both = x(s).isNotNull() & x(d).isNotNull()
        aggs += [F.avg(F.when(both, -x(s) * F.sin(F.radians(x(d))))).alias(f"_u_{s}"), F.avg(F.when(both, -x(s) * F.cos(F.radians(x(d))))).alias(f"_v_{s}")]
    out = df.filter(F.col(time).isNotNull()).groupBy(F.date_trunc("hour", time).alias(time)).agg(*aggs)
    for s, d in wind:
        out = out.withColumns({s: F.sqrt(F.col(f"_u_{s}") ** 2 + F.col(f"_v_{s}") ** 2), d: F.pmod(F.degrees(F.atan2(f"_u_{s}", f"_v_{s}")) + 180, F.lit(360.0))}).drop(f"_u_{s}", f"_v_{s}")
    return out


def with_coverage(df: DataFrame, keys: Sequence[Column], value: Column, least: int, how: str = "mean") -> DataFrame:
    """An aggregate kept only where at least ``least`` values are there."""
    a = F.avg(value) if how == "mean" else F.sum(value)
    return df.groupBy(*keys).agg(F.when(F.count(value) >= least, a).alias("value"), F.count(value).alias("n"))


def daily_from_hourly(hourly: DataFrame, variables: Sequence[str], time: str = "dtm") -> DataFrame:
    """Days as means of hourly means, the counts summed."""
    return hourly.groupBy(F.date_trunc("day", time).alias(time)).agg(*[a for v in variables for a in (F.avg(v).alias(v), F.sum(f"n_{v}").alias(f"n_{v}"))])


