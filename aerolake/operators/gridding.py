"""Irregular readings onto a regular grid, with the missing slots marked and filled.

Readings are averaged into slots of the device's cadence. Missing slots are filled by iterative singular-spectrum
imputation: the series is embedded as a Hankel matrix of lagged windows, projected on its leading singular vectors,
averaged back along the anti-diagonals, and the missing entries are replaced until they settle.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolake.functions.frames import typed_frame
from aerolake.operators.units import harmonize

WINDOW = 24  # lags of the embedding; half the series where that is shorter
RANK = 4  # singular vectors kept
TOLERANCE = 1e-3  # of the scatter: the replacements have settled when none changes by more
ROUNDS = 1000  # at most; the steps shrink every round, but may shrink slowly in a gap far longer than the window
SLOTS = 4096  # slots of a chunk
HALO = 1024  # slots on either side that a chunk is imputed with

GRID = "device string, slot_epoch long, cadence_s int, n long, value double, missing boolean, filled boolean"


def ssa_impute(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The series with its NaN entries imputed, and which entries were.

    Without a known entry nothing is filled; a single one, or a level that never varies, is carried on. Stretches before the
    first and behind the last known entry start from that entry's value. Each round can only lower the squared distance
    between the series and its projection, so the replacements settle: rounds end when none changes by more than TOLERANCE of
    the scatter, or after ROUNDS, with what they have come to.

    The projection of the trajectories and the average along their anti-diagonals are filters with the leading vectors, and
    the trajectories' Gram matrix follows from its first row, so no trajectory is stored.
    """
    gaps = np.isnan(x)
    known = np.flatnonzero(~gaps)
    if not gaps.any() or not len(known):
        return x, np.zeros(len(x), bool)
    y = np.interp(np.arange(len(x)), known, x[known])
    level, spread = x[known].mean(), x[known].std()
    window = min(WINDOW, len(x) // 2)
    rank = min(RANK, window // 2)
    if spread == 0 or rank == 0:
        return y, gaps
    z = (y - level) / spread
    rows = len(z) - window + 1
    count = np.minimum(np.minimum(np.arange(1, len(z) + 1), np.arange(len(z), 0, -1)), min(window, rows)).astype(float)
    gram = np.zeros((window, window))
    for _ in range(ROUNDS):
        gram[0] = [z[:rows] @ z[lag : lag + rows] for lag in range(window)]
        for i in range(1, window):
            gram[i, i:] = gram[i - 1, i - 1 : -1] - z[i - 1] * z[i - 1 : window - 1] + z[rows + i - 1] * z[rows + i - 1 : rows + window - 1]
        _, vectors = np.linalg.eigh(gram, UPLO="U")
        new = sum(np.convolve(np.correlate(z, v), v) for v in vectors[:, -rank:].T)[gaps] / count[gaps]
        change = np.abs(new - z[gaps]).max()
        z[gaps] = new
        if change < TOLERANCE:
            break
    return np.where(gaps, z * spread + level, x), gaps


def regularize(readings: DataFrame, devices: DataFrame) -> DataFrame:
    """One row per slot and device from the first to the last usable reading.

    readings: ``device, dtm, value``, one row per *usable* reading; ``value`` may be null where a usable reading has no
    number, which makes its slot present but without a value. devices: ``device, cadence_s``. Output: ``device``,
    ``slot_epoch`` (start of the slot, a multiple of cadence_s since the epoch, in seconds), ``n`` readings, their mean
    ``value``, ``missing`` (no usable reading) and ``filled`` (the value is imputed).

    Repeated readings of a slot count once each in the mean; rows without a time or a device, and devices without a
    positive cadence, have no series; two rows of one device in ``devices`` with different cadences use the smallest; a
    device with one reading has one slot; a chunk with no reading within its halo stays missing and unfilled; an empty
    table gives an empty one; NaN is no value.

    Scale: readings are aggregated to slots before anything else, with partial aggregation; a series is cut into chunks
    of 4096 slots, so neither a device with much of all rows nor a gap of years is one task. A chunk is imputed together with
    the 1024 slots before and behind it, as far as the series has them, and keeps its own.
    """
    cadence = devices.filter(F.col("device").isNotNull() & (F.col("cadence_s") > 0)).groupBy("device").agg(F.min(F.col("cadence_s").cast("int")).alias("cadence_s"))
    value = F.col("value").cast("double")
    keyed = readings.filter(F.col("device").isNotNull() & F.col("dtm").isNotNull()).select(F.col("device").cast("string"), F.floor(F.unix_micros("dtm") / 1_000_000).alias("s"), F.when(~F.isnan(value), value).alias("value")).join(cadence, "device")
    slots = keyed.groupBy("device", "cadence_s", F.floor(F.col("s") / F.col("cadence_s")).alias("slot")).agg(F.avg("value").alias("value"), F.count("*").alias("n"))
    chunk = F.explode(F.sequence(F.floor((F.col("slot") - HALO) / SLOTS), F.floor((F.col("slot") + HALO) / SLOTS)))
    slots = slots.select("device", "cadence_s", "slot", chunk.alias("chunk"), "value", "n")
    spans = slots.filter(F.col("chunk") == F.floor(F.col("slot") / SLOTS)).groupBy(F.col("device").alias("dev"), F.col("cadence_s").alias("cad")).agg(F.min("slot").alias("first"), F.max("slot").alias("last"))
    spans = spans.select("dev", "cad", "first", "last", F.explode(F.sequence(F.floor(F.col("first") / SLOTS), F.floor(F.col("last") / SLOTS))).alias("piece"))

    def fill(key: tuple, span: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        if not len(span):
            return typed_frame([], GRID)
        s = span.iloc[0]
        low, high = max(int(s["first"]), int(s["piece"]) * SLOTS), min(int(s["last"]), (int(s["piece"]) + 1) * SLOTS - 1)
        start, end = max(int(s["first"]), low - HALO), min(int(s["last"]), high + HALO)
        x, n = np.full(end - start + 1, np.nan), np.zeros(end - start + 1, np.int64)
        at = own["slot"].to_numpy(np.int64) - start
        x[at] = own["value"].to_numpy(float)
        n[at] = own["n"].to_numpy(np.int64)
        core = slice(low - start, high - start + 1)
        out, done = ssa_impute(x) if np.isnan(x[core]).any() else (x, np.zeros(len(x), bool))
        out, done, n = out[core], done[core], n[core]
        return pd.DataFrame({"device": key[0], "slot_epoch": np.arange(low, high + 1) * int(s["cad"]), "cadence_s": int(s["cad"]), "n": n, "value": pd.arrays.FloatingArray(np.nan_to_num(out), np.isnan(out)), "missing": n == 0, "filled": done})

    return spans.groupBy("dev", "piece").cogroup(slots.groupBy("device", "chunk")).applyInPandas(fill, GRID)


def station_series(ae33: DataFrame, avo: DataFrame) -> DataFrame:
    """Usable readings of ae33 (bc6) and of the particle instruments (any number or value text), in common units."""
    a = ae33.filter(F.col("bc6").isNotNull() & ~F.isnan(F.col("bc6").cast("double"))).select(F.col("inst_sn").alias("device"), "dtm", F.col("bc6").cast("double").alias("value"))
    b = harmonize(avo, keep_unreadable=True).select(F.col("source").alias("device"), "dtm", "value")
    return a.unionByName(b)


def missing_slots(ae33: DataFrame, avo: DataFrame, devices: DataFrame) -> DataFrame:
    """Slots without a usable reading: ``device, slot_epoch``."""
    return regularize(station_series(ae33, avo), devices).filter("missing").select("device", "slot_epoch")
