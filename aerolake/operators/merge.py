"""Unions of differing tables, keyed merges with stated precedence, and duplicate timestamps."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_ORDER = ("tinyint", "smallint", "int", "bigint", "float", "double")


def supertype(kinds: Sequence[T.DataType]) -> T.DataType:
    """The narrowest type that holds all: numbers widen, times to timestamp, any other mixture is text."""
    known = [k for k in kinds if not isinstance(k, T.NullType)]
    if not known:
        return T.StringType()
    names = {k.simpleString() for k in known}
    if len(names) == 1:
        return known[0]
    if names <= set(_ORDER):
        top = max(names, key=_ORDER.index)
        # whole numbers beside a float need a double
        return T._parse_datatype_string("double" if top == "float" and names & {"int", "bigint"} else top)
    if names <= {"timestamp", "timestamp_ntz", "date"}:
        return T.TimestampType()
    return T.StringType()


def relaxed_union(*frames: DataFrame) -> DataFrame:
    """Union by name (whatever the case), missing columns null, differing types cast to their supertype on the driver."""
    kinds: dict[str, list[T.DataType]] = {}
    spelled: dict[str, str] = {}
    for df in frames:
        for f in df.schema.fields:
            spelled.setdefault(f.name.casefold(), f.name)
            kinds.setdefault(f.name.casefold(), []).append(f.dataType)
    target = {k: supertype(v) for k, v in kinds.items()}

    def cast(df: DataFrame) -> DataFrame:
        own = {f.name.casefold(): f.name for f in df.schema.fields}
        return df.select(*[(F.col(f"`{own[k]}`") if k in own else F.lit(None)).cast(t).alias(spelled[k]) for k, t in target.items()])

    return reduce(DataFrame.unionAll, [cast(df) for df in frames])


def relaxed_scan(spark, paths: Sequence[str]) -> DataFrame:
    """Parquet files of drifting types as one table: files of one schema are scanned together, then widened and united."""
    by_schema: dict[str, list[str]] = {}
    for p in paths:
        by_schema.setdefault(spark.read.parquet(p).schema.json(), []).append(p)
    return relaxed_union(*[spark.read.parquet(*ps) for ps in by_schema.values()])


def keep_one(df: DataFrame, keys: Sequence[str], *order: Column) -> DataFrame:
    """The first row of each key by a total order; rows with a null in a key are all kept."""
    null = reduce(Column.__or__, [F.col(k).isNull() for k in keys])
    ranked = df.filter(~null).withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter("_rank = 1").drop("_rank").unionByName(df.filter(null))


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of each key."""
    return keep_one(df, keys, *[F.desc_nulls_last(c) for c in order])


def merge_keyed(existing: DataFrame, incoming: DataFrame, keys: Sequence[str], prefer: str = "existing", rank: str | None = None) -> DataFrame:
    """One row per key from two tables. With ``rank`` the highest rank wins (nulls lowest); ties and the rest by ``prefer``."""
    if prefer not in ("existing", "incoming"):
        raise ValueError(prefer)
    both = relaxed_union(existing.withColumn("_side", F.lit(0 if prefer == "existing" else 1)), incoming.withColumn("_side", F.lit(1 if prefer == "existing" else 0)))
    order = ([F.desc_nulls_last(rank)] if rank else []) + [F.asc("_side")]
    rest = F.asc(F.xxhash64(*[c for c in both.columns if c != "_side"]))  # a total order, so that a retry gives the same row
    return keep_one(both, keys, *order, rest).drop("_side")


def append_new(existing: DataFrame, incoming: DataFrame, time: str) -> DataFrame:
    """Existing rows and the distinct incoming ones after the latest existing time."""
    latest = existing.agg(F.max(time).alias("_latest"))
    fresh = incoming.join(F.broadcast(latest), F.col("_latest").isNull() | (F.col(time) > F.col("_latest")), "left_semi")  # one row
    return existing.unionByName(fresh.distinct(), allowMissingColumns=True)


def _norm(c: str, kind: str) -> Column:
    return F.to_json(F.col(c)) if kind.startswith("map") else F.col(c)


def classify_duplicates(df: DataFrame, time: str = "dtm", keys: Sequence[str] = ()) -> DataFrame:
    """Per duplicated time: ``n`` rows and ``kind`` exact, mergeable or conflict. Null times never group.

    exact: all rows alike, nulls included; conflict: some column has two different values; mergeable: the rest. NaN equals
    NaN. One aggregation of min, max and counts per column, so nothing is collected.
    """
    others = [(c, k) for c, k in df.dtypes if c != time and c not in keys]
    aggs = [F.count("*").alias("n")]
    for i, (c, k) in enumerate(others):
        x = _norm(c, k)
        aggs += [F.min(x).alias(f"_lo{i}"), F.max(x).alias(f"_hi{i}"), F.count(x).alias(f"_n{i}")]
    groups = df.filter(F.col(time).isNotNull()).groupBy(*keys, time).agg(*aggs).filter("n > 1")
    differs = [F.coalesce(F.col(f"_lo{i}") != F.col(f"_hi{i}"), F.lit(False)) for i in range(len(others))]
    partial = [(F.col(f"_n{i}") > 0) & (F.col(f"_n{i}") < F.col("n")) for i in range(len(others))]
    none = F.lit(False)
    kind = F.when(reduce(Column.__or__, differs, none), "conflict").when(reduce(Column.__or__, partial, none), "mergeable").otherwise("exact")
    conflicting = F.array_join(F.array_compact(F.array(*[F.when(d, F.lit(c)) for d, (c, _) in zip(differs, others, strict=True)])), ",") if others else F.lit("")
    return groups.select(*keys, time, "n", kind.alias("kind"), conflicting.alias("conflicting_columns"))


def resolve_duplicates(df: DataFrame, order: Sequence[str], time: str = "dtm", keys: Sequence[str] = (), base: Column | None = None) -> DataFrame:
    """One row per duplicated time: exact groups keep the first, mergeable ones fill its nulls by the only value there is.

    A conflict is left alone unless ``base`` picks a row (the first for which it holds), whose values win and whose nulls
    are filled where the group has one value. Null times are left alone, and stay out of the windows, which share one shuffle.
    """
    w = Window.partitionBy(*keys, time)
    others = [(c, k) for c, k in df.dtypes if c != time and c not in keys and c not in order]
    picked = F.coalesce(base, F.lit(False)) if base is not None else F.lit(False)
    bounds = {f"_lo_{c}": F.min(_norm(c, k)).over(w) for c, k in others} | {f"_hi_{c}": F.max(_norm(c, k)).over(w) for c, k in others}
    rows = df.filter(F.col(time).isNotNull()).withColumn("_pick", picked.cast("int"))
    rows = rows.withColumns(bounds | {"_any": F.max("_pick").over(w), "_i": F.row_number().over(Window.partitionBy(*keys, time).orderBy(F.desc("_pick"), *order))})
    conflict = reduce(Column.__or__, [F.coalesce(F.col(f"_lo_{c}") != F.col(f"_hi_{c}"), F.lit(False)) for c, _ in others], F.lit(False))
    left_alone = conflict & (F.col("_any") == 0)
    filled = {c: F.coalesce(F.col(c), F.when(F.col(f"_lo_{c}") == F.col(f"_hi_{c}"), F.col(f"_lo_{c}") if not k.startswith("map") else F.col(c))) for c, k in others}
    kept = rows.filter(left_alone | (F.col("_i") == 1)).withColumn("_alone", left_alone)
    kept = kept.withColumns({c: F.when(F.col("_alone"), F.col(c)).otherwise(x) for c, x in filled.items()})
    return kept.select(*df.columns).unionByName(df.filter(F.col(time).isNull()))


def backfill(existing: DataFrame, incoming: DataFrame, keys: Sequence[str], replace_values: bool = False) -> DataFrame:
    """New keys added, null cells filled; other values replaced only on request, flags and errors never.

    ``cells_filled`` and ``cells_replaced`` count what changed in the row, ``is_new`` marks added rows.
    """
    shared = [c for c in existing.columns if c in incoming.columns and c not in keys]
    right = incoming.select(*[F.col(k).alias(f"_k_{k}") for k in keys], *[F.col(c).alias(f"_in_{c}") for c in shared], F.lit(True).alias("_in"))
    left = existing.withColumn("_ex", F.lit(True))
    on = reduce(Column.__and__, [F.col(k) == F.col(f"_k_{k}") for k in keys])
    j = left.join(right, on, "full")
    new = F.col("_ex").isNull()
    guarded = {c: c.startswith("f_") or c.endswith("_err") for c in shared}
    fills = {c: F.col("_ex").isNotNull() & F.col(c).isNull() & F.col(f"_in_{c}").isNotNull() & F.lit(not guarded[c]) for c in shared}
    swaps = {c: F.col("_ex").isNotNull() & F.col(c).isNotNull() & F.coalesce(F.col(f"_in_{c}") != F.col(c), F.lit(False)) & F.lit(replace_values and not guarded[c]) for c in shared}
    value = {c: F.when(new | fills[c] | swaps[c], F.col(f"_in_{c}")).otherwise(F.col(c)) for c in shared}
    count = lambda flags: reduce(Column.__add__, [x.cast("int") for x in flags.values()], F.lit(0))
    keep = [F.coalesce(k, f"_k_{k}").alias(k) for k in keys] + [value[c].alias(c) if c in value else F.col(c) for c in existing.columns if c not in keys]
    return j.select(*keep, new.alias("is_new"), count(fills).alias("cells_filled"), count(swaps).alias("cells_replaced"))


def first_file_wins(df: DataFrame, keys: Sequence[str], file_order: str) -> DataFrame:
    """Rows of the earliest file for each key (several rows of that file stay)."""
    w = Window.partitionBy(*keys)
    return df.withColumn("_first", F.min(file_order).over(w)).filter(F.col(file_order) == F.col("_first")).drop("_first")


def mean_of_duplicates(df: DataFrame, time: str, order: str) -> DataFrame:
    """One row per time: numbers averaged, other columns from the first row."""
    kinds = dict(df.dtypes)
    numeric = ("double", "float", "int", "bigint", "tinyint", "smallint")
    return df.groupBy(time).agg(*[(F.avg(c) if kinds[c] in numeric else F.min_by(c, order)).alias(c) for c in df.columns if c not in (time, order)])


def simplify_types(df: DataFrame, skip: Sequence[str] = ()) -> DataFrame:
    """Storage types: bigint to int and double to float, except times, skipped columns and names that hold 'termin'."""
    small = {"bigint": "int", "double": "float"}
    return df.select(*[F.col(c).cast(small[k]).alias(c) if k in small and c not in skip and "termin" not in c.lower() else F.col(c) for c, k in df.dtypes])
