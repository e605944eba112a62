"""Statistics over series and groups: regression, ranks, errors, climatologies, extremes, outliers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerolake.operators.joins import with_scalars


def regression(df: DataFrame, x: str, y: str, keys: Sequence[str] = ()) -> DataFrame:
    """Least squares of y on x and Pearson's r per group: ``n, slope, intercept, r, r2, stderr``; null for n < 2."""
    xd, yd = F.col(x).cast("double"), F.col(y).cast("double")
    both = df.filter(xd.isNotNull() & yd.isNotNull() & ~F.isnan(xd) & ~F.isnan(yd))
    out = both.groupBy(*keys).agg(F.count("*").alias("n"), F.regr_slope(yd, xd).alias("slope"), F.regr_intercept(yd, xd).alias("intercept"), F.corr(xd, yd).alias("r"), F.var_pop(xd).alias("_vx"), F.var_pop(yd).alias("_vy"))
    return out.withColumns({"r2": F.col("r") ** 2, "stderr": F.when(F.col("n") > 2, F.sqrt(F.greatest((1 - F.col("r") ** 2) * F.col("_vy") / F.nullif(F.col("_vx"), F.lit(0.0)) / (F.col("n") - 2), F.lit(0.0))))}).drop("_vx", "_vy")


def student_p(r: Column, n: Column) -> Column:
    """Two-sided p-value of a correlation, by numerical integration of the t density (Arrow batches)."""

    @F.pandas_udf("double")
    def p(rs: pd.Series, ns: pd.Series) -> pd.Series:
        def one(r: float, n: float) -> float | None:
            if r is None or n is None or np.isnan(r) or n < 3:
                return None
            df = n - 2
            if abs(r) >= 1:
                return 0.0
            # with t = sqrt(df) tan(a) the tail is an integral of cos(a)^(df-1) over a finite range
            a = np.arctan(abs(r) / np.sqrt(1 - r * r))
            grid = np.linspace(0, np.pi / 2, 20_001)
            f = np.cos(grid) ** (df - 1)
            tail = np.linspace(a, np.pi / 2, 20_001)
            return float(np.clip(np.trapezoid(np.cos(tail) ** (df - 1), tail) / np.trapezoid(f, grid), 0, 1))

        return pd.Series([one(a, b) for a, b in zip(rs, ns, strict=True)])

    return p(r, n)


def orthogonal_regression(df: DataFrame, x: str, y: str, keys: Sequence[str] = ()) -> DataFrame:
    """Orthogonal distance regression in closed form from the second moments: ``slope, intercept, n``."""
    both = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    m = both.groupBy(*keys).agg(F.count("*").alias("n"), F.avg(x).alias("_mx"), F.avg(y).alias("_my"), F.var_pop(x).alias("_vx"), F.var_pop(y).alias("_vy"), F.covar_pop(x, y).alias("_c"))
    d = F.col("_vy") - F.col("_vx")
    slope = (d + F.sqrt(d**2 + 4 * F.col("_c") ** 2)) / F.nullif(2 * F.col("_c"), F.lit(0.0))
    return m.withColumn("slope", slope).withColumn("intercept", F.col("_my") - F.col("slope") * F.col("_mx")).drop("_mx", "_my", "_vx", "_vy", "_c")


def weighted_orthogonal_regression(df: DataFrame, x: str, y: str, sx: str, keys: Sequence[str], rounds: int = 50) -> DataFrame:
    """Orthogonal regression with the errors ``sx`` of x and unit errors of y, iterated per group (effective variance)."""

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        d = pdf[[x, y, sx]].dropna().to_numpy(float)
        slope = intercept = np.nan
        if len(d) > 1:
            slope, intercept = np.polyfit(d[:, 0], d[:, 1], 1)
            for _ in range(rounds):
                w = 1 / (1 + (slope * d[:, 2]) ** 2)
                xm, ym = np.average(d[:, 0], weights=w), np.average(d[:, 1], weights=w)
                u, v = d[:, 0] - xm, d[:, 1] - ym
                beta = w * (u + slope * d[:, 2] ** 2 * v)
                new = (w * beta * v).sum() / (w * beta * u).sum()
                done = abs(new - slope) < 1e-12
                slope, intercept = new, ym - new * xm
                if done:
                    break
        return pd.DataFrame([[*key, slope, intercept, len(d)]])

    kinds = dict(df.dtypes)
    return df.groupBy(*keys).applyInPandas(run, ", ".join([*(f"{k} {kinds[k]}" for k in keys), "slope double", "intercept double", "n long"]))


def average_rank(x: str, keys: Sequence[str]) -> Column:
    """Rank with ties at their mean."""
    w = Window.partitionBy(*keys)
    return F.rank().over(w.orderBy(x)) + (F.count("*").over(Window.partitionBy(*keys, x)) - 1) / 2


def spearman(df: DataFrame, x: str, y: str, keys: Sequence[str]) -> DataFrame:
    """Rank correlation per group over rows where both are known: ``rho, n``."""
    both = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    ranked = both.select(*keys, average_rank(x, keys).alias("_x"), average_rank(y, keys).alias("_y"))
    return ranked.groupBy(*keys).agg(F.corr("_x", "_y").alias("rho"), F.count("*").alias("n"))


def best_grid_point(grid: DataFrame, station: DataFrame, time: str, value: str, reference: str) -> DataFrame:
    """The grid cell whose series correlates best in rank with the station's; ties to the smallest lat, lon. One row."""
    rho = spearman(grid.join(station, time), value, reference, ["lat", "lon"])
    return rho.filter(F.col("rho").isNotNull() & ~F.isnan("rho")).orderBy(F.desc("rho"), "lat", "lon").limit(1)


def model_errors(df: DataFrame, model: str, observed: str, keys: Sequence[str] = ()) -> DataFrame:
    """RMSE over pairs, and the bias of the separate means (so unpaired values count in it)."""
    return df.groupBy(*keys).agg(F.sqrt(F.avg((F.col(model) - F.col(observed)) ** 2)).alias("rmse"), (F.avg(model) - F.avg(observed)).alias("bias"), F.count(F.col(model) + F.col(observed)).alias("n"))


def climatology(df: DataFrame, value: str, by: Column, keys: Sequence[str] = (), name: str = "period") -> DataFrame:
    """Mean and population deviation by hour, month or day of the year."""
    return df.groupBy(*keys, by.alias(name)).agg(F.avg(value).alias("mean"), F.stddev_pop(value).alias("std"), F.count(value).alias("n"))


def anomalies(df: DataFrame, value: str, time: str, keys: Sequence[str] = (), reference: tuple[str, str] | None = None) -> DataFrame:
    """Against the monthly climatology (of a reference period): ``anomaly``, ``percent`` of its mean, ``standardised``."""
    inside = F.col(time).between(F.lit(reference[0]).cast("timestamp"), F.lit(reference[1]).cast("timestamp")) if reference else F.lit(True)
    clim = df.groupBy(*keys, F.month(time).alias("_m")).agg(F.avg(F.when(inside, F.col(value))).alias("_mean"), F.stddev_pop(F.when(inside, F.col(value))).alias("_std"))
    out = df.withColumn("_m", F.month(time)).join(clim, [*keys, "_m"], "left")
    d = F.col(value) - F.col("_mean")
    return out.withColumns({"anomaly": d, "percent": 100 * d / F.nullif("_mean", F.lit(0.0)), "standardised": d / F.nullif("_std", F.lit(0.0))}).drop("_m", "_mean", "_std")


def drop_outliers(df: DataFrame, value: str, sd: str, keys: Sequence[str], sd_factor: float = 10, z: float = 4) -> DataFrame:
    """Rows whose deviation is over ``sd_factor`` times the mean deviation, then rows of a z-score of ``z`` or more, dropped.

    A null deviation stays; z uses mean and population deviation of what is left after the first step.
    """
    first = with_group(df, keys, {"_s": F.avg(sd)}).filter(F.col(sd).isNull() | (F.col(sd) <= sd_factor * F.col("_s"))).drop("_s")
    scored = with_group(first, keys, {"_m": F.avg(value), "_d": F.stddev_pop(value)}).withColumn("_z", (F.col(value) - F.col("_m")) / F.nullif("_d", F.lit(0.0)))
    return scored.filter(F.col("_z").isNull() | (F.abs("_z") < z)).drop("_z", "_m", "_d")


def with_group(df: DataFrame, keys: Sequence[str], aggregates: dict[str, Column]) -> DataFrame:
    """Rows with aggregates of their group: one row per group is made with partial aggregation and joined back, so a group with
    much of all rows isn't one task's. Null keys are a group.
    """
    if not keys:
        return with_scalars(df, df.agg(*[a.alias(n) for n, a in aggregates.items()]))
    groups = df.groupBy(*[F.col(k).alias(f"_g_{k}") for k in keys]).agg(*[a.alias(n) for n, a in aggregates.items()])
    on = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_g_{k}")) for k in keys])
    return df.join(groups, on).drop(*[f"_g_{k}" for k in keys])


def clip_quantiles(df: DataFrame, value: str, q: float, keys: Sequence[str] = ()) -> DataFrame:
    """Values outside the quantiles q and 1 - q (linear) become null."""
    v = F.col(value)
    return with_group(df, keys, {"_lo": F.percentile(v, q), "_hi": F.percentile(v, 1 - q)}).withColumn(value, F.when(v.between(F.col("_lo"), F.col("_hi")), v)).drop("_lo", "_hi")


def nearest_quantile(df: DataFrame, value: str, q: float, keys: Sequence[str] = ()) -> DataFrame:
    """The value at the nearest rank of a quantile."""
    known = df.filter(F.col(value).isNotNull())
    w = Window.partitionBy(*keys)
    ranked = known.withColumns({"_i": F.row_number().over(w.orderBy(value)) - 1, "_n": F.count("*").over(w)})
    return ranked.filter(F.col("_i") == F.round(F.lit(q) * (F.col("_n") - 1))).groupBy(*keys).agg(F.max(value).alias("quantile"))


def extremes(df: DataFrame, value: str, time: str, keys: Sequence[str] = ()) -> DataFrame:
    """Least and greatest value with their times; the earliest among equals."""
    v = F.col(value)
    late = F.struct(v, -F.unix_micros(time))
    return df.filter(v.isNotNull()).groupBy(*keys).agg(F.min(v).alias("low"), F.min_by(time, F.struct(v, F.unix_micros(time))).alias("low_at"), F.max(v).alias("high"), F.max_by(time, late).alias("high_at"))


def coarsen_grid(df: DataFrame, value: str, step: float, keys: Sequence[str] = ()) -> DataFrame:
    """Sums in cells of ``step`` degrees, named by their lower edges."""
    cell = lambda c: (F.floor(F.col(c) / step) * step).alias(f"{c}_bin")
    return df.groupBy(*keys, cell("lat"), cell("lon")).agg(F.sum(value).alias(value))


def group_categories(df: DataFrame, category: str, value: str, groups: Mapping[str, Sequence[str]], keys: Sequence[str] = ()) -> DataFrame:
    """Sums of source categories by group; categories of no group are left out."""
    mapped = F.create_map(*[F.lit(x) for g, members in groups.items() for m in members for x in (m, g)])
    return df.withColumn("group", mapped[F.col(category)]).filter("group is not null").groupBy(*keys, "group").agg(F.sum(value).alias(value))


def apportion(df: DataFrame, contributions: Sequence[str], background: str, observed: str) -> DataFrame:
    """Modelled sum and what it leaves unexplained; a row without one of the contributions has neither. Adds the stacked sums."""
    total = sum((F.col(c) for c in contributions[1:]), F.col(contributions[0]))
    stacked = {f"stacked_{c}": sum((F.col(p) for p in contributions[1 : i + 1]), F.col(contributions[0])) for i, c in enumerate(contributions)}
    return df.withColumns(stacked | {"modelled": total + F.col(background), "residual": F.col(observed) - (total + F.col(background))})


def box_widths(df: DataFrame, group: str, value: str, width: float = 0.8) -> DataFrame:
    """Counts and box widths in proportion to the largest group, with the quartiles."""
    g = df.groupBy(group).agg(F.count(value).alias("n"), *[F.percentile(value, q).alias(f"p{int(q * 100)}") for q in (0.25, 0.5, 0.75)])
    top = g.agg(F.max("n").alias("_top"))
    return with_scalars(g, top).withColumn("width", F.col("n") / F.col("_top") * width).drop("_top")


def two_stage(df: DataFrame, inner: Sequence[Column], outer: Sequence[str], value: str, first: str = "sum", second: str = "mean") -> DataFrame:
    """An aggregate of aggregates, such as the mean over years of monthly sums."""
    f = {"sum": F.sum, "mean": F.avg, "max": F.max, "min": F.min, "count": F.count}
    return df.groupBy(*inner).agg(f[first](value).alias("_x")).groupBy(*outer).agg(f[second]("_x").alias("value"), F.count("_x").alias("n"))
