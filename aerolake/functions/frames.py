"""Small helpers for the pandas side of grouped functions."""

from __future__ import annotations

import pandas as pd

_DTYPES = {"string": object, "binary": object, "long": "int64", "bigint": "int64", "int": "int32", "double": "float64", "boolean": bool, "timestamp": "datetime64[ns]"}


def typed_frame(rows: list[tuple], ddl: str) -> pd.DataFrame:
    """Rows without nulls in whole numbers as a frame of the schema's types, which an empty list keeps too."""
    columns = dict(c.split() for c in ddl.split(", "))
    df = pd.DataFrame(rows, columns=list(columns)) if rows else pd.DataFrame({c: [] for c in columns})
    return df.astype({c: _DTYPES.get(k, object) for c, k in columns.items()})
