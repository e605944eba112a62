"""Which values count: predicates over values and flags. A predicate is never null; unknown counts as invalid."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolake.functions.numeric import finite


def valid(value: Column, flag: Column | None = None, accept_null: bool = True, valid_flag: float = 0.0) -> Column:
    """A value with a valid flag; a null flag counts as valid unless ``accept_null`` is off, one that isn't a number never."""
    has = value.isNotNull()
    if flag is None:
        return F.coalesce(has, F.lit(False))
    ok = F.coalesce(flag.try_cast("double") == valid_flag, F.lit(False))
    return has & (ok | flag.isNull()) if accept_null else has & ok


def strictly_valid(value: Column, flag: Column | None) -> Column:
    """Only flag 0 counts."""
    return valid(value, flag, accept_null=False)


def only_valid(value: Column, flag: Column | None = None, accept_null: bool = True) -> Column:
    """The value where it is valid, else null; NaN becomes null."""
    v = value.cast("double")
    return F.when(valid(value, flag, accept_null) & ~F.isnan(F.coalesce(v, F.lit(0.0))), v)


def rows_all_valid(df: DataFrame, flags: list[str]) -> DataFrame:
    """Rows in which every flag is 0, NaN or null."""
    ok = [F.coalesce((F.col(f).cast("double") == 0) | F.isnan(F.col(f).cast("double")), F.lit(True)) for f in flags]
    return df.filter(reduce(Column.__and__, ok)) if ok else df


def any_flagged(df: DataFrame, prefix: str = "f_") -> Column:
    """Whether any flag column of the row is over 0."""
    flags = [F.coalesce(F.col(c) > 0, F.lit(False)) for c in df.columns if c.startswith(prefix)]
    return reduce(Column.__or__, flags) if flags else F.lit(False)


def mask_range(value: Column, time: Column, start: str, end: str) -> Column:
    """Null within a closed range of time."""
    return F.when(~F.coalesce(time.between(F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")), F.lit(False)), value)


def mask_negative(value: Column) -> Column:
    """Null for negative values; NaN, which Spark holds greater than all numbers, becomes null as well."""
    return F.when(finite(value) & (value >= 0), value)


def recode(value: Column, mapping: dict) -> Column:
    """Other codes by a mapping; unmapped ones pass."""
    out = reduce(lambda w, kv: w.when(value == kv[0], F.lit(kv[1])), list(mapping.items())[1:], F.when(value == next(iter(mapping)), F.lit(next(iter(mapping.values())))))
    return out.otherwise(value)


def drop_empty_columns(df: DataFrame) -> DataFrame:
    """Without the columns that are null in every row (one aggregation over all columns)."""
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns]).first()
    return df.select(*[c for c in df.columns if counts[c]])


def drop_empty_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Without the rows in which all of ``columns`` are null or NaN."""
    return df.dropna(how="all", subset=list(columns))


def rename_suffixes(df: DataFrame, suffixes: tuple[str, ...] = ("s0", "z0"), to: str = "h0") -> DataFrame:
    """Columns that end with one of the suffixes, renamed."""
    return df.withColumnsRenamed({c: c[: -len(s)] + to for c in df.columns for s in suffixes if c.endswith(s)})


def box(time: Column, value: Column, t0: str, t1: str, low: float, high: float) -> Column:
    """Strictly inside a box of time and value."""
    return (time > F.lit(t0).cast("timestamp")) & (time < F.lit(t1).cast("timestamp")) & (value > low) & (value < high)
