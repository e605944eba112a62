"""Joins on time: outer chains, gap filling, nearest points, as-of, coarse background series."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerolake.operators.windows import interpolate_series, ordered


def with_scalars(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """``df`` with the columns of a one-row aggregate, by an equi-join on a constant; the single row is broadcast.

    ``one_row`` must be a total aggregate, which has one row by construction.
    """
    one = one_row.withColumn("_one_right", F.lit(1))
    return df.withColumn("_one", F.lit(1)).join(F.broadcast(one), F.col("_one") == F.col("_one_right")).drop("_one", "_one_right")


def outer_chain(frames: Sequence[DataFrame], on: Sequence[str]) -> DataFrame:
    """Full outer join of all frames, keys coalesced. Frames that share the join's partitioning aren't shuffled again."""
    return reduce(lambda a, b: a.join(b, list(on), "full"), frames)


def align(frames: Sequence[DataFrame], how: str = "full") -> DataFrame:
    """Join on the columns that all frames share."""
    common = [c for c in frames[0].columns if all(c in f.columns for f in frames)]
    return reduce(lambda a, b: a.join(b, common, how), frames)


def outer_with_suffix(a: DataFrame, b: DataFrame, on: Sequence[str], suffix: str = "_right") -> DataFrame:
    """Full outer join; the right frame's clashing columns get a suffix."""
    return a.join(b.withColumnsRenamed({c: c + suffix for c in b.columns if c in a.columns and c not in on}), list(on), "full")


def fill_gaps(df: DataFrame, time: str, step: str, keys: Sequence[str] = ()) -> DataFrame:
    """All times from the first to the last of each key, in steps, with nulls where there is no row."""
    span = df.groupBy(*keys).agg(F.min(time).alias("_a"), F.max(time).alias("_b"))
    grid = span.select(*keys, F.explode(F.sequence("_a", "_b", F.expr(f"INTERVAL {step}"))).alias(time))
    return grid.join(df, [*keys, time], "left")


def common_keys(a: DataFrame, b: DataFrame, on: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Both frames without the keys that the other lacks."""
    return a.join(b.select(*on).distinct(), list(on), "left_semi"), b.join(a.select(*on).distinct(), list(on), "left_semi")


def without_events(df: DataFrame, events: DataFrame, time: str, values: Sequence[str]) -> DataFrame:
    """Values null at the times of events; the times stay."""
    listed = events.select(F.col(time).alias("_e")).distinct()
    out = df.join(listed, F.col(time) == F.col("_e"), "left")
    return out.withColumns({v: F.when(F.col("_e").isNull(), F.col(v)) for v in values}).drop("_e")


def nearest_grid_point(grid: DataFrame, lat: float, lon: float) -> DataFrame:
    """Rows of the grid at the latitude and the longitude nearest to a point, each axis by itself; ties to the smaller."""
    pick = grid.agg(F.min_by("lat", F.struct(F.abs(F.col("lat") - lat), F.col("lat"))).alias("_lat"), F.min_by("lon", F.struct(F.abs(F.col("lon") - lon), F.col("lon"))).alias("_lon"))
    return grid.join(F.broadcast(pick), (F.col("lat") == F.col("_lat")) & (F.col("lon") == F.col("_lon"))).drop("_lat", "_lon")  # one row


def as_of(left: DataFrame, right: DataFrame, time: str, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Each left row with the right one at or before its time, by a union and a window instead of a range join."""
    r = right.select(*keys, F.col(time), F.struct(*values).alias("_r"), F.lit(None).cast(left.select(F.struct("*")).schema.fields[0].dataType).alias("_l"), F.lit(0).alias("_side"))
    l_rows = left.select(*keys, F.col(time), F.lit(None).cast(right.select(F.struct(*values)).schema.fields[0].dataType).alias("_r"), F.struct("*").alias("_l"), F.lit(1).alias("_side"))
    w = Window.partitionBy(*keys).orderBy(time, "_side").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    both = l_rows.unionByName(r).withColumn("_r", F.last("_r", ignorenulls=True).over(w)).filter("_side = 1")
    return both.select("_l.*", *[F.col(f"_r.{v}").alias(v) for v in values])


def over_background(fine: DataFrame, coarse: DataFrame, time: str, value: str, background: str, keys: Sequence[str] = ()) -> DataFrame:
    """A fine series minus a coarser one interpolated to its times: adds ``background`` and ``delta``."""
    coarse = coarse.select(*keys, F.col(time), F.col(background))
    both = fine.withColumn("_fine", F.lit(True)).join(coarse, [*keys, time], "full")
    if background in fine.columns:
        raise ValueError(f"{background!r} is in both tables")
    both = interpolate_series(both, keys, time, background, "_b")
    return both.filter("_fine").withColumn(background, F.col("_b")).withColumn("delta", F.col(value) - F.col("_b")).drop("_fine", "_b")


def look_up(df: DataFrame, mapping: DataFrame, key: str, at: str) -> DataFrame:
    """Names for ids by a mapping table."""
    return df.join(mapping.withColumnRenamed(at, "_at"), F.col(key) == F.col("_at"), "left").drop("_at")


def mean_of_available(*cols: Column) -> Column:
    """Mean of the values that aren't null in a row."""
    n = reduce(Column.__add__, [c.isNotNull().cast("int") for c in cols])
    return F.when(n > 0, reduce(Column.__add__, [F.coalesce(c, F.lit(0.0)) for c in cols]) / n)


def positional(left: DataFrame, right: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """Rows of two blocks of one file put side by side by their place in it: the n-th with the n-th, the longer block's rest alone.

    ``keys`` name the file; places are counted per file in ``order``, which both have and which stays out. A column that both
    have beside the keys is an error.
    """
    shared = set(left.columns) & set(right.columns) - {*keys, order}
    if shared:
        raise ValueError(f"in both blocks: {sorted(shared)}")
    place = lambda df: df.withColumn("_place", F.row_number().over(ordered(keys, order))).drop(order)
    a, b = place(left), place(right)
    on = F.col("l._place") == F.col("r._place")
    for k in keys:
        on &= F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}"))
    both = a.alias("l").join(b.alias("r"), on, "full")
    rest = [F.col(f"l.{c}") for c in left.columns if c not in (*keys, order)] + [F.col(f"r.{c}") for c in right.columns if c not in (*keys, order)]
    return both.select(*[F.coalesce(f"l.{k}", f"r.{k}").alias(k) for k in keys], F.coalesce("l._place", "r._place").alias("place"), *rest)
