"""Operators over rows in time order. Every window is partitioned by the caller's keys and ordered by time and a unique id."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from aerolake.operators.chunks import chunked

CHUNK = 20_000  # rows of a chunk


def ordered(keys: Sequence[str], *order: str) -> WindowSpec:
    return Window.partitionBy(*keys).orderBy(*order)


def up_to_here(w: WindowSpec) -> WindowSpec:
    return w.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def forward_fill(x: Column, w: WindowSpec) -> Column:
    """The last value that isn't null."""
    return F.last(x, ignorenulls=True).over(up_to_here(w))


def after_return(state: Column, time: Column, w: WindowSpec, minutes: int = 10, flag: int = 2) -> Column:
    """``flag`` for rows of state 0 within ``minutes`` (inclusive) of a return to 0 from another state, else null.

    A null state before doesn't start the window.
    """
    returned = F.when((state == 0) & (F.lag(state).over(w) != 0), time)
    since = F.last(returned, ignorenulls=True).over(up_to_here(w))
    return F.when((state == 0) & since.isNotNull() & (time - since <= F.expr(f"INTERVAL {minutes} MINUTES")), F.lit(flag))


def after_any_change(state: Column, time: Column, w: WindowSpec, minutes: int = 10) -> Column:
    """Whether a row lies within ``minutes`` (inclusive) of a change of the rounded state; the first row is none."""
    s = F.round(state)
    changed = F.when(~s.eqNullSafe(F.lag(s).over(w)) & (F.row_number().over(w) > 1), time)
    since = F.last(changed, ignorenulls=True).over(up_to_here(w))
    return F.coalesce(time - since <= F.expr(f"INTERVAL {minutes} MINUTES"), F.lit(False))


def rolling_median(x: Column, w: WindowSpec, rows: int = 3) -> Column:
    return F.percentile(x, 0.5).over(w.rowsBetween(-(rows - 1), 0))


def rolling_mean_centred(x: Column, w: WindowSpec, rows: int, least: int = 1) -> Column:
    """Mean of ``rows`` rows around each (an even number reaches one further back), null under ``least`` values."""
    frame = w.rowsBetween(-(rows // 2), rows - rows // 2 - 1)
    return F.when(F.count(x).over(frame) >= least, F.avg(x).over(frame))


def rolling_quantile(df: DataFrame, keys: Sequence[str], time: str, order: str, x: str, rows: int, q: float, out: str) -> DataFrame:
    """Adds the quantile of ``rows`` rows around each in order of time and a unique id; partial windows at the ends, nulls skipped.

    Series are cut into chunks with the rows around them, so a series with much of all rows is spread over tasks, and a
    window of thousands of rows is a partition of an array instead of a new sort per row. Rows without a time drop out.
    """
    names, half, after = df.columns, rows // 2, rows - rows // 2 - 1
    typed = df.withColumns({"_us": F.unix_micros(time), "_x": F.col(x).cast("double")})
    chunks = chunked(typed, list(keys), "_us", CHUNK, rows)
    schema = chunks.select(*df.columns, F.lit(0.0).alias(out)).schema

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["_us", order], kind="stable")
        core = np.flatnonzero(pdf["core"].to_numpy(bool))
        padded = np.concatenate([np.full(half, np.nan), pdf["_x"].to_numpy(float), np.full(after, np.nan)])
        frames = np.lib.stride_tricks.sliding_window_view(padded, rows)
        got = np.full(len(core), np.nan)
        step = max(1, 4_000_000 // rows)
        for a in range(0, len(core), step):
            # sorted rows put NaN last, so the quantile's place follows from the count of numbers
            part = np.sort(frames[core[a : a + step]], axis=1)
            n = np.count_nonzero(~np.isnan(part), axis=1)
            place = q * np.maximum(n - 1, 0)
            low = np.floor(place).astype(int)
            at = np.arange(len(part))
            lo, hi = part[at, low], part[at, np.minimum(low + 1, np.maximum(n - 1, 0))]
            got[a : a + step] = np.where(n > 0, lo + (hi - lo) * (place - low), np.nan)
        kept = pdf.iloc[core]
        return kept[names].assign(**{out: pd.arrays.FloatingArray(np.nan_to_num(got), np.isnan(got))})

    return chunks.groupBy(*keys, "chunk").applyInPandas(run, schema)


def interpolate_series(df: DataFrame, keys: Sequence[str], time: str, x: str, out: str) -> DataFrame:
    """Adds ``x`` with its nulls interpolated along time; the ends stay null. As :func:`interpolate`, for series of any length.

    A series is cut into chunks in order of time; each chunk's first and last known values are carried to the chunks around
    it over one row per chunk, so no task holds a whole series. Rows without a time keep what they have.
    """
    keyed = df.withColumns({"_us": F.unix_micros(time)} | ({} if keys else {"_all": F.lit(0)}))
    keys = list(keys) or ["_all"]
    rows = chunked(keyed, keys, "_us", CHUNK, 0).drop("core", "n_total")
    known = F.when(F.col(x).isNotNull(), F.struct(F.col("_us").alias("p"), F.col(x).alias("v")))
    ends = rows.groupBy(*keys, "chunk").agg(F.min_by(known, F.when(F.col(x).isNotNull(), F.col("_us"))).alias("_first"), F.max_by(known, F.when(F.col(x).isNotNull(), F.col("_us"))).alias("_last"))
    w = ordered(keys, "chunk")
    before = F.last("_last", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    behind = F.first("_first", ignorenulls=True).over(w.rowsBetween(1, Window.unboundedFollowing))
    carried = ends.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col("chunk").alias("_kc"), before.alias("_before"), behind.alias("_behind"))
    on = F.col("chunk") == F.col("_kc")
    for k in keys:
        on &= F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    own = ordered([*keys, "chunk"], "_us")
    left = F.coalesce(F.last(known, ignorenulls=True).over(own.rowsBetween(Window.unboundedPreceding, 0)), F.col("_before"))
    right = F.coalesce(F.first(known, ignorenulls=True).over(own.rowsBetween(0, Window.unboundedFollowing)), F.col("_behind"))
    both = rows.join(carried, on, "left").withColumns({"_l": left, "_r": right})
    share = (F.col("_us") - F.col("_l.p")) / F.nullif((F.col("_r.p") - F.col("_l.p")).cast("double"), F.lit(0.0))
    filled = both.withColumn(out, F.coalesce(F.col(x), F.col("_l.v") + (F.col("_r.v") - F.col("_l.v")) * share)).select(*df.columns, out)
    return filled.unionByName(df.filter(F.col(time).isNull()).withColumn(out, F.col(x).cast("double")))


def running_sum(x: Column, w: WindowSpec) -> Column:
    return F.sum(x).over(up_to_here(w))


def interpolate(x: Column, place: Column, w: WindowSpec) -> Column:
    """Linear interpolation of nulls along ``place`` (a row number or seconds); the ends stay null."""
    known = F.when(x.isNotNull(), place)
    after = w.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    x0, p0 = F.last(x, ignorenulls=True).over(up_to_here(w)), F.last(known, ignorenulls=True).over(up_to_here(w))
    x1, p1 = F.first(x, ignorenulls=True).over(after), F.first(known, ignorenulls=True).over(after)
    return F.coalesce(x, x0 + (x1 - x0) * (place - p0) / F.nullif(p1 - p0, F.lit(0).cast("double")))


def trapezoid(y: Column, x: Column, w: WindowSpec) -> Column:
    """The trapezoid between a row and the one before it."""
    return (y + F.lag(y).over(w)) / 2 * (x - F.lag(x).over(w))


def trapezoid_sum(df: DataFrame, keys: Sequence[str], order: Sequence[str], y: str, x: str, out: str = "integral") -> DataFrame:
    """``df`` with the running trapezoid integral of ``y`` over ``x`` in linear time; 0 at the first row."""
    w = ordered(keys, *order)
    return df.withColumn("_piece", trapezoid(F.col(y), F.col(x), w)).withColumn(out, F.coalesce(running_sum(F.col("_piece"), w), F.lit(0.0))).drop("_piece")


def islands(df: DataFrame, keys: Sequence[str], order: Sequence[str], state: str, out: str = "island") -> DataFrame:
    """``df`` with the number of the stretch of equal successive states."""
    w = ordered(keys, *order)
    changed = F.when(F.row_number().over(w) == 1, 0).otherwise((~F.col(state).eqNullSafe(F.lag(state).over(w))).cast("int"))
    return df.withColumn("_changed", changed).withColumn(out, running_sum(F.col("_changed"), w)).drop("_changed")


def attenuation(df: DataFrame, keys: Sequence[str], order: Sequence[str], sensing: str, reference: str, tape: str, out: str = "atn", carried: DataFrame | None = None) -> DataFrame:
    """Attenuation -100 ln(sensing/reference) minus that of the first row of the tape spot.

    A spot lasts while the tape counter stays; a null counter gives null and doesn't end the spot. ``carried`` (keys, tape,
    baseline) continues the first spot of a key from an earlier run.
    """
    raw = F.when((F.col(sensing) > 0) & (F.col(reference) > 0), -100 * F.ln(F.col(sensing) / F.col(reference)))
    known = islands(df.withColumn("_raw", raw).filter(F.col(tape).isNotNull()), keys, order, tape, "_spot")
    first = F.first("_raw").over(Window.partitionBy(*keys, "_spot").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    if carried is not None:
        old = carried.select(*[F.col(k).alias(f"_c_{k}") for k in keys], F.col(tape).alias("_c_tape"), F.col("baseline").alias("_c_base"))
        on = (F.col("_spot") == 0) & (F.col(tape) == F.col("_c_tape"))
        for k in keys:
            on &= F.col(k).eqNullSafe(F.col(f"_c_{k}"))
        known = known.join(old, on, "left")
        first = F.coalesce("_c_base", first)
    known = known.withColumn(out, F.col("_raw") - first)
    unknown = df.filter(F.col(tape).isNull()).withColumn(out, F.lit(None).cast("double"))
    return known.select(*df.columns, out).unionByName(unknown)


def stride_sample(df: DataFrame, keys: Sequence[str], order: Sequence[str], most: int) -> DataFrame:
    """Every n-th row so that about ``most`` are left per key, the newest always among them."""
    w = Window.partitionBy(*keys)
    rows = df.withColumns({"_n": F.count("*").over(w), "_i": F.row_number().over(w.orderBy(*order))})
    step = F.greatest(F.lit(1), F.ceil(F.col("_n") / most))
    return rows.filter((F.pmod(F.col("_i") - 1, step) == 0) | (F.col("_i") == F.col("_n"))).drop("_n", "_i")


def step_events(df: DataFrame, keys: Sequence[str], order: Sequence[str], x: str, quantile: float = 0.995) -> DataFrame:
    """Steps of a smoothed signal as persistent states: ``event`` +1, -1 or 0, ``state`` the last event.

    A step is a difference over the greatest of its quantile (nearest), six times its median absolute deviation, 1e-12.
    Thresholds are aggregated per key and joined back.
    """
    w = ordered(keys, *order)
    smooth = df.withColumn("_m", rolling_median(F.col(x), w)).withColumn("_d", F.col("_m") - F.lag("_m").over(w))
    size = F.abs("_d")
    n = smooth.filter("_d is not null").select(*keys, size.alias("_a"))
    ranked = n.withColumns({"_i": F.row_number().over(ordered(keys, "_a")) - 1, "_n": F.count("*").over(Window.partitionBy(*keys))})
    q = ranked.filter(F.col("_i") == F.round(F.lit(quantile) * (F.col("_n") - 1))).groupBy(*keys).agg(F.max("_a").alias("_q"))
    mid = n.groupBy(*keys).agg(F.median("_a").alias("_mid"))
    mad = n.join(mid, list(keys)).groupBy(*keys).agg(F.median(F.abs(F.col("_a") - F.col("_mid"))).alias("_mad"))
    limits = q.join(mad, list(keys)).select(*keys, F.greatest("_q", 6 * F.col("_mad"), F.lit(1e-12)).alias("_limit"))
    out = smooth.join(limits, list(keys), "left")
    event = F.when(F.col("_d") > F.col("_limit"), 1).when(F.col("_d") < -F.col("_limit"), -1).otherwise(0)
    out = out.withColumn("event", event)
    return out.withColumn("state", F.coalesce(F.last(F.when(F.col("event") != 0, F.col("event")), ignorenulls=True).over(up_to_here(w)), F.lit(0))).drop("_m", "_d", "_limit")


def smooth_kernel(df: DataFrame, keys: Sequence[str], time: str, order: str, x: str, passes: int = 10) -> DataFrame:
    """Adds ``smooth``: repeated smoothing by the kernel 1/4, 1/2, 1/4 per series in order of time and a unique id, ends kept.

    A series is cut into chunks with as many rows around them as there are passes, which is as far as a value reaches.
    """
    names = df.columns
    chunks = chunked(df.withColumn("_us", F.unix_micros(time)), list(keys), "_us", CHUNK, passes)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["_us", order], kind="stable")
        y = pdf[x].to_numpy(float)
        for _ in range(passes if len(y) > 2 else 0):
            y = np.concatenate([y[:1], (y[:-2] + 2 * y[1:-1] + y[2:]) / 4, y[-1:]])
        return pdf[names].assign(smooth=y)[pdf["core"].to_numpy(bool)]

    return chunks.groupBy(*keys, "chunk").applyInPandas(run, df.select("*", F.lit(0.0).alias("smooth")).schema)


def repair_meter_clock(df: DataFrame, keys: Sequence[str], time: str, order: str) -> DataFrame:
    """Clock repair per meter, in reading order: 12 h back after a jump of 25 h, 12 h on for a repeated time.

    Repeated until the times don't fall or nothing changes.
    """

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order, kind="stable").reset_index(drop=True)
        t = pdf[time].copy()
        for _ in range(len(t) + 1):
            d = t.diff()
            jump, again = d == pd.Timedelta(hours=25), d == pd.Timedelta(0)
            if not (jump | again).any():
                break
            t = t.mask(jump, t - pd.Timedelta(hours=12)).mask(again & ~jump, t + pd.Timedelta(hours=12))
            if (t.diff().dropna() > pd.Timedelta(0)).all():
                break
        return pdf.assign(**{time: t})

    return df.groupBy(*keys).applyInPandas(run, df.schema)
