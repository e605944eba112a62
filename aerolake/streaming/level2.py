"""The windowed aggregates as streams: late rows within a watermark, duplicates dropped, states carried per key."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolake.operators.aggregate import circular_mean
from aerolake.operators.validity import only_valid

STREAM_METHODS = {"mean": F.avg, "sum": F.sum, "min": F.min, "max": F.max, "circular_mean": circular_mean}


def stream_level2(rows: DataFrame, variables: Sequence[str], every: str = "1 hour", late: str = "2 days", method: str = "mean", keys: Sequence[str] = (), identity: Sequence[str] = (), time: str = "dtm", slide: str | None = None) -> DataFrame:
    """Level 2 windows of a stream (or a batch): each variable's aggregate over valid values, and their count.

    ``identity`` columns drop repeated rows within the watermark. The methods are those whose state has a fixed size.
    """
    if method not in STREAM_METHODS:
        raise ValueError(f"{method!r} has no bounded state; one of {sorted(STREAM_METHODS)}")
    rows = rows.withWatermark(time, late)
    if identity:
        rows = rows.dropDuplicatesWithinWatermark([*identity, time]) if rows.isStreaming else rows.dropDuplicates([*identity, time])
    window = F.window(time, every, slide) if slide else F.window(time, every)
    clean = {v: only_valid(F.col(v), F.col(f"f_{v}") if f"f_{v}" in rows.columns else None) for v in variables}
    aggs = [a for v in variables for a in (STREAM_METHODS[method](clean[v]).alias(v), F.count(clean[v]).alias(f"n_{v}"))]
    out = rows.groupBy(window.alias("_w"), *keys).agg(*aggs)
    return out.select(F.col("_w.start").alias(time), *keys, *[c for v in variables for c in (v, f"n_{v}")])


def stream_transitions(rows: DataFrame, key: str, state: str, time: str = "dtm", minutes: int = 10) -> DataFrame:
    """Flags after a return to state 0, with each key's last state and return carried from batch to batch.

    Output: ``key, dtm, state, unsettled``. Rows of one key must come in time order from batch to batch.
    """

    def run(k: tuple, batches: Iterator[pd.DataFrame], memory) -> Iterator[pd.DataFrame]:
        last, back = memory.get if memory.exists else (None, None)
        for pdf in batches:
            out = []
            for t, s in pdf.sort_values(time)[[time, state]].itertuples(index=False):
                us = int(pd.Timestamp(t).value // 1000)
                s = None if pd.isna(s) else int(s)
                if s == 0 and last not in (None, 0):
                    back = us
                out.append((k[0], t, s, bool(s == 0 and back is not None and us - back <= minutes * 60_000_000)))
                last = s
            yield pd.DataFrame(out, columns=["key", "dtm", "state", "unsettled"])
        memory.update((last, back))

    kind = dict(rows.dtypes)[key]
    return rows.groupBy(key).applyInPandasWithState(run, f"key {kind}, dtm timestamp, state int, unsettled boolean", "last int, back long", "append", "NoTimeout")
