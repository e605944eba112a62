"""Profiles and long series by NumPy in grouped pandas functions: curve fit and filter, log interpolation, column ozone."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerolake.functions.frames import typed_frame
from aerolake.functions.numeric import linear_table
from aerolake.operators.windows import interpolate, ordered, up_to_here

# --- fixed values -------------------------------------------------------------------------------------------------------
#: pressure (hPa) -> pump correction factor of an electrochemical ozone sonde
PUMP_TABLE = [(1000, 1), (200, 1), (150, 1.002), (100, 1.007), (70, 1.013), (50, 1.018), (30, 1.029), (20, 1.041), (15, 1.048), (10, 1.066), (7, 1.087), (5, 1.124), (3, 1.240)]
LN_P_FACTOR = 0.79
N_A, M_DRY, GRAVITY, DU_MOLECULES = 6.02214076e23, 0.0289652, 9.80665, 2.69e20
SHORT_TERM_DAYS, LONG_TERM_DAYS = 80, 667
# ---------------------------------------------------------------------------------------------------------------------


def _kinds(df: DataFrame, keys: Sequence[str]) -> str:
    kinds = dict(df.dtypes)
    return ", ".join(f"{k} {kinds[k]}" for k in keys)


def low_pass(y: np.ndarray, step_days: float, cutoff_days: float) -> np.ndarray:
    """A low-pass filter in the frequency domain with the response 2^-min((f/fc)^6, 20)."""
    n = 1 << int(np.ceil(np.log2(max(2 * len(y), 2))))
    spectrum = np.fft.rfft(y, n)
    f = np.fft.rfftfreq(n, step_days)
    return np.fft.irfft(spectrum * 2.0 ** -np.minimum((f * cutoff_days) ** 6, 20), n)[: len(y)]


def curve_fit(t: np.ndarray, y: np.ndarray, degree: int = 2, harmonics: int = 4, step_days: float = 1.0) -> dict[str, np.ndarray]:
    """Polynomial and harmonics by least squares; residuals resampled, tilted to end at 0, filtered twice, and put back.

    t in decimal years. Results on an even axis: time, function, smooth, trend, seasonal and growth (per year).
    """
    t0 = t.min()

    def design(x: np.ndarray) -> np.ndarray:
        cols = [(x - t0) ** k for k in range(degree + 1)]
        cols += [f(2 * np.pi * h * x) for h in range(1, harmonics + 1) for f in (np.sin, np.cos)]
        return np.column_stack(cols)

    beta = np.linalg.lstsq(design(t), y, rcond=None)[0]
    grid = np.arange(t0, t.max() + 1e-9, step_days / 365.25)
    resid = np.interp(grid, t, y - design(t) @ beta)
    tilt = np.interp(grid, [grid[0], grid[-1]], [resid[: max(1, len(resid) // 20)].mean(), resid[-max(1, len(resid) // 20) :].mean()])
    short, long = (low_pass(resid - tilt, step_days, c) + tilt for c in (SHORT_TERM_DAYS, LONG_TERM_DAYS))
    poly = design(grid)[:, : degree + 1] @ beta[: degree + 1]
    fit = design(grid) @ beta
    trend = poly + long
    return {"time": grid, "function": fit, "smooth": fit + short, "trend": trend, "seasonal": fit + short - trend, "growth": np.gradient(trend, grid) if len(grid) > 1 else np.zeros(len(grid))}


def fit_series(df: DataFrame, keys: Sequence[str], time: str, value: str, degree: int = 2, harmonics: int = 4) -> DataFrame:
    """The curve fit per series; ``time`` in decimal years. A series with fewer values than parameters has no rows."""
    columns = ("time", "function", "smooth", "trend", "seasonal", "growth")
    ddl = _kinds(df, keys) + "".join(f", {c} double" for c in columns)

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        d = pdf[[time, value]].dropna().sort_values([time, value])
        names = [*keys, *columns]
        if len(d) <= degree + 1 + 2 * harmonics:
            return typed_frame([], ddl)
        out = pd.DataFrame(curve_fit(d[time].to_numpy(float), d[value].to_numpy(float), degree, harmonics))
        for k, v in zip(keys, key, strict=True):
            out[k] = np.full(len(out), v, object)
        return out[names]

    return df.groupBy(*keys).applyInPandas(run, ddl)


def seasonal_extremes(fitted: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per year (the last one too) the seasonal maximum and minimum, their times and the amplitude."""
    year = F.floor("time").cast("int").alias("year")
    return fitted.groupBy(*keys, year).agg(F.max("seasonal").alias("high"), F.max_by("time", "seasonal").alias("high_at"), F.min("seasonal").alias("low"), F.min_by("time", "seasonal").alias("low_at"), (F.max("seasonal") - F.min("seasonal")).alias("amplitude"))


def _spline(x: np.ndarray, y: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Natural cubic spline."""
    n, h = len(x), np.diff(x)
    a = np.eye(n)
    b = np.zeros(n)
    for i in range(1, n - 1):
        a[i, i - 1 : i + 2] = h[i - 1], 2 * (h[i - 1] + h[i]), h[i]
        b[i] = 6 * ((y[i + 1] - y[i]) / h[i] - (y[i] - y[i - 1]) / h[i - 1])
    m = np.linalg.solve(a, b)
    k = np.clip(np.searchsorted(x, at) - 1, 0, n - 2)
    u, w = x[k + 1] - at, at - x[k]
    return (m[k] * u**3 + m[k + 1] * w**3) / (6 * h[k]) + (y[k] / h[k] - m[k] * h[k] / 6) * u + (y[k + 1] / h[k] - m[k + 1] * h[k] / 6) * w


def interpolate_log(df: DataFrame, keys: Sequence[str], x: str, y: str, points: Sequence[float], method: str = "linear") -> DataFrame:
    """Each profile at given x, interpolated over ln x, linear or by a cubic spline; outside its range null."""
    if method not in ("linear", "cubic"):
        raise ValueError(method)

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        d = pdf[[x, y]].dropna()
        d = d[d[x] > 0].groupby(x, as_index=False)[y].mean().sort_values(x)
        at, lx = np.log(np.asarray(points, float)), np.log(d[x].to_numpy(float))
        out = np.full(len(at), np.nan)
        if len(d) > 1:
            ok = (at >= lx[0]) & (at <= lx[-1])
            values = d[y].to_numpy(float)
            out[ok] = np.interp(at[ok], lx, values) if method == "linear" or len(d) < 3 else _spline(lx, values, at[ok])
        return pd.DataFrame({**{k: [v] * len(at) for k, v in zip(keys, key, strict=True)}, "x": points, "y": pd.arrays.FloatingArray(np.nan_to_num(out), np.isnan(out))})

    return df.groupBy(*keys).applyInPandas(run, _kinds(df, keys) + ", x double, y double")


def pump_corrected(ozone: Column, pressure: Column) -> Column:
    """Ozone partial pressure corrected by the pump table, interpolated in ln p."""
    return ozone * linear_table(F.ln(pressure), [(float(np.log(p)), f) for p, f in PUMP_TABLE])


def column_ozone(df: DataFrame, keys: Sequence[str], pressure: str, ozone_mpa: str) -> DataFrame:
    """Running column ozone in Dobson units from the ground up, by the trapezoid of the mixing ratio over pressure.

    Missing ozone is interpolated along the rows of the profile, in order of falling pressure.
    """
    w = ordered(keys, F.desc(pressure))
    rows = df.withColumn("_i", F.row_number().over(w).cast("double"))
    rows = rows.withColumn("_o", interpolate(F.col(ozone_mpa).cast("double"), F.col("_i"), ordered(keys, "_i")))
    rows = rows.withColumn("_r", F.col("_o") * 1e-3 / (F.col(pressure) * 100))
    factor = N_A / M_DRY / GRAVITY / DU_MOLECULES
    piece = (F.col("_r") + F.lag("_r").over(w)) / 2 * (F.lag(pressure).over(w) - F.col(pressure)) * 100 * factor
    return rows.withColumn("_p", piece).withColumn("column_du", F.coalesce(F.sum("_p").over(up_to_here(w)), F.lit(0.0))).drop("_p", "_r", "_o", "_i")


def ozone_integral(df: DataFrame, keys: Sequence[str], pressure: str, ozone: str) -> DataFrame:
    """0.79 times the integral of ozone over ln p per profile; a missing value adds nothing on either side."""
    w = ordered(keys, F.desc(pressure))
    piece = (F.col(ozone) + F.lag(ozone).over(w)) / 2 * (F.ln(F.lag(pressure).over(w)) - F.ln(pressure))
    return df.select(*keys, piece.alias("_p")).groupBy(*keys).agg((LN_P_FACTOR * F.coalesce(F.sum("_p"), F.lit(0.0))).alias("integral"))


def residual_ozone(df: DataFrame, keys: Sequence[str], pressure: str, ozone: str, above_hpa: float = 2) -> DataFrame:
    """The ozone over the profile's top: 0.79 times the mean mixing ratio of the top ``above_hpa`` times the top's pressure."""
    top = Window.partitionBy(*keys)
    rows = df.withColumn("_top", F.min(pressure).over(top)).filter(F.col(pressure) < F.col("_top") + above_hpa)
    return rows.groupBy(*keys).agg((LN_P_FACTOR * F.avg(F.col(ozone) / F.col(pressure)) * F.first("_top")).alias("residual"))


def ozone_uncertainty(current: Column, background: Column, pump_temperature: Column) -> Column:
    """Relative uncertainty of a sonde's ozone from the uncertainties of current, background, conversion, flow and pump."""
    a = (0.05**2 + 0.015**2) / (current - background) ** 2
    return F.sqrt(a + 0.0013 + 0.05**2 + (F.lit(0.2) / pump_temperature) ** 2)


def pressure_window(df: DataFrame, pressure: str, at: float, half: float) -> DataFrame:
    """Rows strictly within a window of pressure."""
    return df.filter((F.col(pressure) > at - half) & (F.col(pressure) < at + half))
