"""Names: values, flags, counts and errors belong together by prefix; resolution on the driver, on schemas only."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T

FLAG_PREFIX, COUNT_PREFIX, ERROR_SUFFIX = "f_", "n_", "_err"
#: The flag codes.
FLAG_CODES = {0: "valid", 1: "invalid", 2: "uncertain", 3: "zero", 4: "span", 5: "zero check", 6: "span check"}
TIME_NAMES = ("dtm", "timestamp", "time", "datetime", "date")


@dataclass(frozen=True)
class Variable:
    """A variable of a table: the configured name, the column it resolves to and its flag column."""

    name: str
    column: str
    flag: str | None = None

    @property
    def count(self) -> str:
        return COUNT_PREFIX + self.name


def resolve(name: str, columns: Sequence[str]) -> str | None:
    """The column of that name whatever its case; the exact spelling first."""
    if name in columns:
        return name
    return next((c for c in columns if c.casefold() == name.casefold()), None)


def resolve_flag(name: str, columns: Sequence[str], flag: str | None = None, mode: str = "auto") -> str | None:
    """The flag column: the named one, else prefix and name, else none. mode: auto, none or required."""
    if mode not in ("auto", "none", "required"):
        raise ValueError(f"unknown flag mode: {mode!r}")
    if mode == "none":
        return None
    found = resolve(flag, columns) if flag else resolve(FLAG_PREFIX + name, columns)
    if found is None and (mode == "required" or flag):
        raise ValueError(f"no flag column for {name!r}")
    return found


def resolve_variables(names: Iterable[str], columns: Sequence[str]) -> list[Variable]:
    """The variables that the columns have; others are left out."""
    return [Variable(n, c, resolve_flag(n, columns)) for n in names if (c := resolve(n, columns))]


def squeeze(name: str) -> str:
    return re.sub(r"[^a-z0-9]", "", name.lower())


def discover(candidates: Sequence[str], columns: Sequence[str], pattern: str | None = None) -> str | None:
    """The best column for a list of candidate names: same letters and digits first, then the pattern, then containment.

    Flag, count and error columns aren't values; the shortest name wins among equals.
    """
    values = [c for c in columns if not c.lower().startswith((FLAG_PREFIX, COUNT_PREFIX)) and not c.lower().endswith(ERROR_SUFFIX)]
    scored = []
    for c in values:
        s = squeeze(c)
        for rank, want in enumerate(map(squeeze, candidates)):
            score = 0 if s == want else 2 if want in s else None
            if score is not None:
                scored.append((score, rank, len(c), c))
        if pattern and re.search(pattern, c, re.I):
            scored.append((1, 0, len(c), c))
    return min(scored)[3] if scored else None


def find_time_column(df: DataFrame, requested: str | None = None) -> str:
    """The requested time column, else a usual name, else the only column of a time type."""
    if requested:
        found = resolve(requested, df.columns)
        if found is None:
            raise ValueError(f"no column {requested!r}")
        return found
    for n in TIME_NAMES:
        if found := resolve(n, df.columns):
            return found
    times = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampType | T.TimestampNTZType)]
    if len(times) != 1:
        raise ValueError(f"can't choose a time column among {times}")
    return times[0]


def linked_groups(groups: dict[str, Sequence[str]]) -> dict[str, tuple[str, ...]]:
    """Check groups of variables that share their flags: at least two members, none in two groups. Member -> its group."""
    out: dict[str, tuple[str, ...]] = {}
    for name, members in groups.items():
        if len(set(members)) < 2:
            raise ValueError(f"group {name!r} needs two members")
        for m in members:
            if m in out:
                raise ValueError(f"{m!r} is in two groups")
            out[m] = tuple(members)
    return out


def linked_flags(variable: str, groups: dict[str, tuple[str, ...]], columns: Sequence[str]) -> list[str]:
    """Flag columns that change with the variable's: those of its group's members that the table has."""
    members = groups.get(variable, (variable,))
    return [FLAG_PREFIX + m for m in members if resolve(m, columns) or resolve(FLAG_PREFIX + m, columns)]


def columns_missing(df: DataFrame, expected: Iterable[str]) -> tuple[list[str], list[str]]:
    """Expected columns that are missing, and columns that weren't expected."""
    want = list(expected)
    return [c for c in want if c not in df.columns], [c for c in df.columns if c not in want]
