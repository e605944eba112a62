"""Numeric and physical column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: physical constants and instrument parameters ---------------------------------------------------------
M_AIR = 28.97  # g/mol
M_O3 = 48.0
R_DRY = 287.052874  # J/(kg K)
OZONE_UGM3_PER_PPB = 1.99534
DU_PER_MOL_M2 = 2241.15
#: mass absorption cross sections of the seven channels, as attenuation coefficients in m2/g
AE33_SIGMA = {"BC1": 18.47, "BC2": 14.54, "BC3": 13.14, "BC4": 11.58, "BC5": 10.35, "BC6": 7.77, "BC7": 7.19}
AE33_H_STAR = 1.76
# ---------------------------------------------------------------------------------------------------------------------


def finite(x: Column) -> Column:
    """Neither null, NaN nor infinite; never null itself."""
    d = x.cast("double")
    return F.coalesce(d.isNotNull() & ~F.isnan(d) & (F.abs(d) < float("inf")), F.lit(False))


def clean_number(x: Column) -> Column:
    """Null instead of NaN and infinity."""
    return F.when(finite(x), x.cast("double"))


def clean_flag(x: Column) -> Column:
    """A flag as a whole number; null if it isn't one."""
    d = x.try_cast("double")
    return F.when(finite(d) & (d == F.floor(d)), d.cast("int"))


def nearest_hex(x: Column) -> Column:
    """A hexadecimal text as an integer; null if it isn't one."""
    t = F.regexp_replace(F.trim(x), "^0[xX]", "")
    return F.when(t.rlike("^[0-9A-Fa-f]{1,15}$"), F.conv(t, 16, 10).cast("long"))


def reporting_condition(v: Column, p: Column, t: Column, target_p: float, target_t: float) -> Column:
    """A concentration at pressure p (hPa) and temperature t (degC), at the reporting condition; null for invalid p or t."""
    ok = finite(p) & finite(t) & (p > 0) & (t > -273.15)
    return F.when(ok, v * (F.lit(target_p) / p) * ((t + 273.15) / (target_t + 273.15)))


def condition_state(p: Column, t: Column, target_p: float, target_t: float) -> Column:
    """invalid, at_target (within 0.5 hPa and 0.01 K) or corrected."""
    ok = finite(p) & finite(t) & (p > 0) & (t > -273.15)
    same = (F.abs(p - target_p) <= 0.5) & (F.abs(t - target_t) <= 0.01)
    return F.when(~ok, "invalid").when(same, "at_target").otherwise("corrected")


def absorption(bc: Column, sigma: float, h_star: float = AE33_H_STAR) -> Column:
    """Absorption coefficient in 1/Mm from equivalent black carbon in ng/m3."""
    if h_star <= 0:
        raise ValueError("h_star must be positive")
    return bc * F.lit(sigma) / F.lit(h_star) / 1000


def angstrom_exponent(a: Column, b: Column, wavelength_a: float, wavelength_b: float) -> Column:
    """-ln(a/b) / ln(wavelength_a/wavelength_b); null where it isn't finite."""
    return F.when((a > 0) & (b > 0), -F.ln(a / b) / math.log(wavelength_a / wavelength_b))


def single_scattering_albedo(scattering: Column, absorbed: Column, exponent: Column, at: float, measured_at: float) -> Column:
    """Scattering over extinction, the absorption carried to the wavelength of the scattering by its exponent."""
    adjusted = absorbed * F.pow(F.lit(at / measured_at), -exponent)
    return scattering / F.nullif(scattering + adjusted, F.lit(0.0))


def mass_to_volume(x: Column, molar_mass: float, per: float = 1e9) -> Column:
    """Mass mixing ratio (kg/kg) to volume mixing ratio (1/per)."""
    return x * (M_AIR / molar_mass) * per


def mass_concentration(ratio: Column, pressure_hpa: Column, temperature_k: Column) -> Column:
    """Mass mixing ratio to ug/m3 by the density of dry air."""
    return ratio * (pressure_hpa * 100 / (temperature_k * R_DRY)) * 1e9


def emission_flux(amount: Column, cell_area: Column, seconds: Column) -> Column:
    """kg per cell and period to kg/(m2 s)."""
    return amount / seconds / F.nullif(cell_area, F.lit(0.0))


def ozone_partial_pressure_mpa(mass_ratio: Column, pressure_hpa: Column) -> Column:
    """Partial pressure of ozone in mPa from its mass mixing ratio."""
    return mass_ratio * (M_AIR / M_O3) * pressure_hpa * 1e5


def linear_table(x: Column, table: list[tuple[float, float]]) -> Column:
    """Piecewise-linear interpolation in a literal table; constant beyond its ends."""
    points = sorted(table)
    out = F.when(x <= points[0][0], F.lit(float(points[0][1])))
    for (x0, y0), (x1, y1) in zip(points, points[1:], strict=False):
        out = out.when(x <= x1, F.lit(float(y0)) + (x - x0) * ((y1 - y0) / (x1 - x0)))
    return F.when(x.isNotNull(), out.otherwise(float(points[-1][1])))
