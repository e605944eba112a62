"""Quality flags: manual, automatic and linked; all updates are projections."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolake.operators.validity import recode
from aerolake.operators.windows import after_any_change, after_return, ordered

# --- fixed values: states of the instruments and the flags they mean -----------------------------------------------------
NE300_STATES = {0: 0, 1: 2, 2: 2, 3: 3, 4: 5, 5: 4, 6: 6}
AURORA_STATES = {0: 0, 1: 4, 2: 3, 3: 4, 5: 3}
G2401_NOT_FLAGGED = ("dtm", "source", "DATE", "TIME", "FRAC_DAYS_SINCE_JAN1", "FRAC_HRS_SINCE_JAN1", "JULIAN_DAYS", "EPOCH_TIME")
#: (state, flag) pairs known to be wrong in the history
NE300_WRONG = ((1, 3), (1, 5), (2, 4), (2, 6), (3, 5), (4, 3), (5, 5), (6, 4))
FLAG_SHARE = {0: 1.0, 1: 0.0, 2: 0.5}
CPD2_GOOD = ("0007", "00AB", "0093")
# ---------------------------------------------------------------------------------------------------------------------


def additive(old: Column, new: Column, overwrite: bool = False) -> Column:
    """Fill null flags only; with ``overwrite`` the new one wins, but never a null over a flag."""
    return F.coalesce(new, old) if overwrite else F.coalesce(old, new)


def _old(df: DataFrame, flag: str) -> Column:
    return F.col(flag).cast("tinyint") if flag in df.columns else F.lit(None).cast("tinyint")


def set_flag_at(df: DataFrame, times: DataFrame, flags: Sequence[str], code: int, time: str = "dtm") -> DataFrame:
    """``code`` in all ``flags`` (a variable's linked flags) at the listed times; ``times`` has one column of that name."""
    listed = times.select(F.col(time).alias("_at")).distinct().withColumn("_hit", F.lit(True))
    out = df.join(listed, F.col(time) == F.col("_at"), "left")
    hit = F.coalesce("_hit", F.lit(False))
    return out.withColumns({f: F.when(hit, F.lit(code).cast("tinyint")).otherwise(_old(df, f)) for f in flags}).drop("_at", "_hit")


def synchronise(df: DataFrame, flags: Sequence[str], source: str) -> DataFrame:
    """Every flag of a linked group as in the authoritative one, nulls too."""
    return df.withColumns({f: F.col(source) for f in flags if f != source})


def reconcile(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    """A linked group's flags made equal by their only value in the row; a row with two different values is an error."""
    present = [f for f in flags if f in df.columns]
    least, most = F.least(*present) if len(present) > 1 else F.col(present[0]), F.greatest(*present) if len(present) > 1 else F.col(present[0])
    agreed = F.when(least != most, F.raise_error(F.concat(F.lit("linked flags differ: "), least.cast("string"), F.lit(" and "), most.cast("string"))).cast("tinyint")).otherwise(F.coalesce(*present))
    return df.withColumn("_agreed", agreed.cast("tinyint")).withColumns({f: F.col("_agreed") for f in flags}).drop("_agreed")


def group_conflicts(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    """Rows whose linked flags differ."""
    return df.filter(F.coalesce(F.least(*flags) != F.greatest(*flags), F.lit(False)))


def ne300_flag(state: Column) -> Column:
    """The flag of an operation state, null for unknown ones; a negative state is an error."""
    s = state.cast("int")
    mapped = F.create_map(*[F.lit(x).cast("int") for kv in NE300_STATES.items() for x in kv])
    return F.when(s < 0, F.raise_error(F.lit("negative operation state")).cast("int")).otherwise(F.when(s.isin(*NE300_STATES), mapped[s]))


def auto_flag_ne300(df: DataFrame, state: str, channels: Sequence[str], keys: Sequence[str], order: Sequence[str], time: str = "dtm", overwrite: bool = False) -> DataFrame:
    """Flags of the nephelometer's channels from its state; 10 minutes after a return to measuring are uncertain."""
    w = ordered(keys, *order)
    flag = F.coalesce(after_return(F.col(state), F.col(time), w), ne300_flag(F.col(state))).cast("tinyint")
    return df.withColumn("_new", flag).withColumns({f"f_{c}": additive(_old(df, f"f_{c}"), F.col("_new"), overwrite) for c in channels}).drop("_new")


def auto_flag_aurora(df: DataFrame, state: str, channels: Sequence[str], keys: Sequence[str], order: Sequence[str], time: str = "dtm", overwrite: bool = False) -> DataFrame:
    """Flags from the Aurora's major state; 10 minutes after any change are uncertain whatever the state."""
    w = ordered(keys, *order)
    s = F.round(state).cast("int")
    mapped = F.create_map(*[F.lit(x).cast("int") for kv in AURORA_STATES.items() for x in kv])
    flag = F.when(after_any_change(F.col(state), F.col(time), w), 2).otherwise(F.when(s.isin(*AURORA_STATES), mapped[s])).cast("tinyint")
    return df.withColumn("_new", flag).withColumns({f"f_{c}": additive(_old(df, f"f_{c}"), F.col("_new"), overwrite) for c in channels}).drop("_new")


def valve_flag(valve: Column) -> Column:
    """0 measuring, 1 span, more uncertain; negative, NaN and null unknown."""
    v = valve.cast("double")
    return F.when(F.isnan(v), None).when(v == 0, 0).when(v == 1, 4).when(v > 1, 2)


def auto_flag_g2401(df: DataFrame, valve: str = "solenoid_valves", overwrite: bool = False) -> DataFrame:
    """Flags of all numeric columns but the housekeeping ones from the valve."""
    numeric = [n for n, kind in df.dtypes if kind in ("double", "float", "int", "bigint") and n not in (*G2401_NOT_FLAGGED, valve) and not n.startswith("f_")]
    return df.withColumn("_new", valve_flag(F.col(valve)).cast("tinyint")).withColumns({f"f_{c}": additive(_old(df, f"f_{c}"), F.col("_new"), overwrite) for c in numeric}).drop("_new")


def propagate(df: DataFrame, source: str, targets: Sequence[str], codes: Sequence[int] = (2, 3, 4)) -> DataFrame:
    """Some codes of one flag into other flags where they are null."""
    return df.withColumns({t: F.when(F.col(source).isin(*codes) & _old(df, t).isNull(), F.col(source)).otherwise(_old(df, t)) for t in targets})


def reflag_history(df: DataFrame, state: str, flag: str, overwrite_all: bool = False) -> DataFrame:
    """Old flags by state: null, 0, 2 and known-wrong ones are replaced for states 1 to 6; others stay. Adds ``changed``."""
    new = ne300_flag(F.col(state)).cast("tinyint")
    wrong = reduce(Column.__or__, [(F.col(state) == s) & (F.col(flag) == f) for s, f in NE300_WRONG])
    replace = F.col(state).between(1, 6) & (F.lit(overwrite_all) | F.col(flag).isNull() | F.col(flag).isin(0, 2) | F.coalesce(wrong, F.lit(False)))
    out = F.when(F.coalesce(replace, F.lit(False)), new).otherwise(F.col(flag))
    return df.withColumn("_new", out).withColumn("changed", ~F.col("_new").eqNullSafe(F.col(flag))).withColumn(flag, F.col("_new")).drop("_new")


def ingest_flags(df: DataFrame, variables: Sequence[str], error: str | None = None) -> DataFrame:
    """First flags: 1 where the value is missing or the source reports an error (kept apart in ``<variable>_err``), else 0.

    Without a source error column the flag is 1 for missing values and 0 otherwise.
    """
    out = {}
    for v in variables:
        bad = F.col(v).isNull()
        if error:
            out[f"{v}_err"] = F.col(error).cast("tinyint")
            bad = bad | F.coalesce(F.col(error) != 0, F.lit(False))
        out[f"f_{v}"] = F.when(bad, 1).otherwise(0).cast("tinyint")
    return df.withColumns(out)


def flag_shares(df: DataFrame, keys: Sequence[str], flags: Sequence[str]) -> DataFrame:
    """Flags as probabilities in long form, only those under 1: keys, ``variable``, ``probability``."""
    wide = df.select(*keys, *[recode(F.col(f).cast("double"), {float(k): v for k, v in FLAG_SHARE.items()}).alias(f) for f in flags])
    return wide.unpivot(list(keys), list(flags), "variable", "probability").filter(F.col("probability") < 1)


def good_records(flags: Column, value: Column, most: float, good: Sequence[str] = CPD2_GOOD) -> Column:
    """Whitelisted flag texts and a value under its upper limit."""
    return F.upper(F.trim(flags)).isin(*good) & (value < most)


def flag_counts(df: DataFrame, flags: Mapping[str, str] | Sequence[str]) -> DataFrame:
    """Rows by flag column and code."""
    names = list(flags)
    return df.select(F.explode(F.array(*[F.struct(F.lit(f).alias("flag"), F.col(f).cast("int").alias("code")) for f in names])).alias("x")).groupBy("x.flag", "x.code").count()
