"""Schemas that drift between files: one consistent table, and a report of every change.

Rows are loaded as maps from path (column name) to raw text. Statistics of types and levels are aggregated per file and
path; a fold over each device's files in time order compares neighbours, tells renamed columns from added and removed
ones by what they hold, and keeps the class of a column while it is empty. The links between names then give every
column its quantity, and the typed table is a projection with a count of the casts that failed.
"""

from __future__ import annotations

import re
from difflib import SequenceMatcher

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolake.functions.frames import typed_frame
from aerolake.operators.chunks import chunked

CHUNK, LOOK_BACK = 2_000, 64
#: A removed and an added column hold the same quantity if their distance (see :func:`distance`) is under this.
SAME = 2.5
NAMES_ALIKE = 0.6

# --- fixed values: the quantities of the ozone table and their types ----------------------------------------------------
QUANTITIES = {
    "flags": "string", "o3": "double", "hio3": "double", "cellai": "double", "cellbi": "double", "bncht": "double", "lmpt": "double",
    "o3lt": "double", "flowa": "double", "flowb": "double", "pres": "double",
}
TIME_QUANTITIES = ("dtm", "pcdate", "pctime")
_MONTHS = "jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec"
# ---------------------------------------------------------------------------------------------------------------------

_NUM = r"^[+-]?(?:\d+(?:\.\d*)?|\.\d+)(?:[eE][+-]?\d+)?"
_DATE = r"(?:\d{4}[-/.]\d{1,2}[-/.]\d{1,2})"
_TIME = r"(?:\d{1,2}:\d{2}(?::\d{2}(?:\.\d+)?)?)"
_WORD_DATE = rf"(?:\d{{1,2}}[ -](?i:{_MONTHS})[a-z]*[ -]\d{{4}})"
_ZONE = r"(?:[zZ]|[+-]\d{2}:?\d{2})?"


def entry_class(v: Column) -> Column:
    """The class of a filled entry: whole, decimal, date or text."""
    return (
        F.when(v.rlike(r"^[+-]?\d+$"), "whole")
        .when(v.rlike(_NUM + "$"), "decimal")
        .when(v.rlike(rf"^{_DATE}(?:[T ]\s*{_TIME}{_ZONE})?$"), "date")
        .otherwise("text")
    )


def entry_kind(v: Column) -> Column:
    """What an entry can measure, whatever its class: datetime, date, time, number or text."""
    return (
        F.when(v.rlike(rf"^(?:{_DATE}|{_WORD_DATE}|\d{{1,2}}/\d{{1,2}}/\d{{4}})[T ]\s*{_TIME}{_ZONE}$"), "datetime")
        .when(v.rlike(rf"^(?:{_DATE}|{_WORD_DATE}|\d{{1,2}}/\d{{1,2}}/\d{{4}})$") | v.rlike(r"^(?:19|20)\d{2}(?:0[1-9]|1[0-2])(?:0[1-9]|[12]\d|3[01])$"), "date")
        .when(v.rlike(rf"^{_TIME}$"), "time")
        .when(v.rlike(r"^1?\d{9}(?:\.\d+)?$") & (F.substring_index(v, ".", 1).try_cast("long") > 300_000_000), "datetime")
        .when(v.rlike(_NUM + r"(?:\s+[^\d\s]\S*)?$"), "number")
        .otherwise("text")
    )


def path_values(files: DataFrame) -> DataFrame:
    """Rows as path-value maps: ``file_id, device, period_us, names, line_no, cells`` (name -> raw text, empty ones left out)."""
    names = F.transform(F.split(F.regexp_replace("header", "^﻿", ""), ","), lambda x: F.lower(F.trim(x)))
    base = files.select(F.col("file_id").cast("long"), F.col("device").cast("string"), F.unix_micros("period_start").alias("period_us"), names.alias("names"), F.split(F.coalesce("body", F.lit("")), "\r\n|\n|\r").alias("lines"))
    rows = base.select("file_id", "device", "period_us", "names", F.posexplode("lines").alias("line_no", "line")).filter(F.trim("line") != "")
    cells = F.filter(F.zip_with("names", F.split("line", ",", -1), lambda n, v: F.struct(n.alias("name"), F.trim(v).alias("value"))), lambda c: c["name"].isNotNull() & (c["name"] != "") & c["value"].isNotNull() & (c["value"] != ""))
    return rows.select("file_id", "device", "period_us", "names", "line_no", cells.alias("cells"))


def path_statistics(files: DataFrame) -> DataFrame:
    """Per file and column: counts by class and kind, level and scatter of its numbers, the shape of its texts.

    Cells are first counted by form (the whole entry, its digits alike), so that patterns are matched once per form and not
    per cell: class, kind and suffix depend on the form alone, but for numbers that may be dates or epochs, whose kind is told per cell.
    """
    one = path_values(files).select("file_id", F.explode("cells").alias("c")).select("file_id", F.col("c.name").alias("name"), F.col("c.value").alias("value"))
    letters = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"
    form = F.translate("value", "0123456789", "9" * 10)
    stamp = F.when((F.length("value") >= 8) & form.rlike(r"^9{8,10}(?:\.9+)?$"), entry_kind(F.col("value")))
    shape = F.translate("form", letters, "a" * len(letters))
    plain = F.col("value").try_cast("double")
    number = F.when(plain.isNotNull() & ~F.isnan(plain), plain).otherwise(F.regexp_extract("value", _NUM, 0).try_cast("double"))
    by_form = one.select("file_id", "name", form.alias("form"), stamp.alias("stamp"), "value", number.alias("x")).groupBy("file_id", "name", "form", "stamp").agg(F.count("*").alias("n"), F.count("x").alias("nx"), F.sum("x").alias("sx"), F.sum(F.col("x") * F.col("x")).alias("sxx"), F.min("value").alias("value"))
    suffix = F.regexp_extract("value", _NUM + r"\s*([A-Za-z%°µμ][^\d]*)$", 1)
    judged = by_form.select("*", shape.alias("shape"), entry_class(F.col("value")).alias("cls"), entry_kind(F.col("value")).alias("kind"), suffix.alias("suffix"))
    kinds = [F.sum(F.when(F.col("kind") == k, F.col("n")).otherwise(0)).alias(f"k_{k}") for k in ("datetime", "date", "time", "number", "text")]
    classes = [F.sum(F.when(F.col("cls") == k, F.col("n")).otherwise(0)).alias(f"c_{k}") for k in ("whole", "decimal", "date", "text")]
    total = F.sum("nx")
    mean = F.sum("sx") / F.nullif(total, F.lit(0))
    spread = F.sqrt(F.greatest(F.sum("sxx") / F.nullif(total, F.lit(0)) - mean * mean, F.lit(0.0)))
    return judged.groupBy("file_id", "name").agg(F.sum("n").alias("n"), *classes, *kinds, mean.alias("mean"), F.coalesce(spread, F.lit(0.0)).alias("std"), F.min("shape").alias("shape"), F.max("suffix").alias("suffix"))


def file_profiles(files: DataFrame) -> DataFrame:
    """One row per file: its columns in the header's order and the statistics of those with entries."""
    names = F.transform(F.split(F.regexp_replace("header", "^﻿", ""), ","), lambda x: F.lower(F.trim(x)))
    head = files.filter(F.col("header").isNotNull()).select(F.col("file_id").cast("long"), F.col("device").cast("string"), F.unix_micros("period_start").alias("us"), F.array_distinct(F.filter(names, lambda x: x != "")).alias("names"))
    # the sum of numbers is enough to name the winning class: numbers count together, decimal if any is
    numbers = F.col("c_whole") + F.col("c_decimal")
    cls = F.when((numbers >= F.col("c_date")) & (numbers >= F.col("c_text")), F.when(F.col("c_decimal") > 0, "decimal").otherwise("whole")).when(F.col("c_date") >= F.col("c_text"), "date").otherwise("text")
    most = F.greatest(*[f"k_{k}" for k in ("datetime", "date", "time", "number", "text")])
    kind = F.when(F.col("k_datetime") == most, "datetime").when(F.col("k_date") == most, "date").when(F.col("k_time") == most, "time").when(F.col("k_number") == most, "number").otherwise("text")
    stats = path_statistics(files).groupBy("file_id").agg(F.collect_list(F.struct("name", cls.alias("cls"), kind.alias("kind"), "mean", "std", "shape", "suffix")).alias("stats"))
    return head.join(stats, "file_id", "left")


# --- the fold -------------------------------------------------------------------------------------------------------------
def distance(a: dict, b: dict) -> float:
    """How far two columns' contents are apart; infinite for different kinds. Numbers: level and scatter."""
    if a["kind"] != b["kind"]:
        return np.inf
    if a["kind"] in ("datetime", "date", "time"):
        return 0.0
    if a["kind"] == "text":
        return 0.0 if a["shape"] == b["shape"] else np.inf
    if a["suffix"] and b["suffix"] and a["suffix"] != b["suffix"]:
        return np.inf
    if a["mean"] is None or b["mean"] is None:
        return np.inf
    mixed = 0.5 * ({a["cls"], b["cls"]} == {"whole", "decimal"})
    eps = 0.002 * max(abs(a["mean"]), abs(b["mean"])) + 1e-12
    return mixed + abs(a["mean"] - b["mean"]) / max(a["std"], b["std"], eps) + abs(np.log((a["std"] + eps) / (b["std"] + eps)))


def _alike(a: str, b: str) -> float:
    a, b = re.sub(r"[^a-z0-9]", "", a), re.sub(r"[^a-z0-9]", "", b)
    return SequenceMatcher(None, "".join(sorted(a)), "".join(sorted(b))).ratio() if a and b else 0.0


def compare(before: dict[str, dict | None], now: dict[str, dict | None]) -> tuple[list[tuple[str, str, str | None]], dict[str, dict | None]]:
    """Changes between two files of a device, and the state to carry: the last known statistics of each column.

    ``before``: column -> last known statistics or None; ``now``: column -> statistics, None for a wholly empty column.
    """
    gone, new = [c for c in before if c not in now], [c for c in now if c not in before]
    pairs = []
    for r in gone:
        for a in new:
            if before[r] is not None and now[a] is not None:
                d = distance(before[r], now[a])
                if d < SAME:
                    pairs.append((d, -_alike(r, a), r, a))
            elif _alike(r, a) >= NAMES_ALIKE:
                pairs.append((SAME, -_alike(r, a), r, a))
    origin: dict[str, str] = {}
    for _, _, r, a in sorted(pairs):
        if r not in origin.values() and a not in origin:
            origin[a] = r
    changes: list[tuple[str, str, str | None]] = []
    state: dict[str, dict | None] = {}
    for c, stats in now.items():
        source = c if c in before else origin.get(c)
        known = before[source] if source is not None else None
        if source is None:
            changes.append(("added", c, None))
        elif source != c:
            changes.append(("renamed", c, source))
        if known is not None and stats is not None and known["cls"] != stats["cls"]:
            changes.append(("retyped", c, f"{known['cls']} to {stats['cls']}"))
        state[c] = stats if stats is not None else known
    changes += [("removed", r, None) for r in gone if r not in origin.values()]
    return changes, state


CHANGES = "device string, file_id long, change string, column_name string, was string"


def schema_changes(files: DataFrame) -> DataFrame:
    """Every change of a file's columns against the device's file before it: ``device, file_id, change, column_name, was``.

    files: ``file_id, device, period_start, header, body``; others are ignored. Order is ``period_start``, then file_id.
    Names are compared in lower case without outer blanks, order is disregarded. ``change`` is added, removed, renamed
    (``was``: the old name) or retyped (``was``: the classes). A column that holds no entry keeps the class it had; while
    it is empty for more than 64 files on end across a chunk's border, its class counts as unknown. A file without a
    header or a period has no row and is skipped in the comparison; a null device forms one device; a name that stands
    twice in a header counts once, with the entries of both; empty tables give empty ones.

    Scale: bodies are reduced to a row of statistics per file where they are read; the fold sees those rows only, in chunks
    of about 2000 files of one device with 64 files of look-back.
    """
    profiles = chunked(file_profiles(files), ["device"], "us", CHUNK, LOOK_BACK, bucket_s=86_400)

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["us", "file_id"], kind="stable")
        out, state = [], None
        for device, file_id, names, stats, core in zip(pdf["device"], pdf["file_id"], pdf["names"], pdf["stats"], pdf["core"], strict=True):
            held = {s["name"]: s for s in stats} if stats is not None else {}
            now = {c: held.get(c) for c in names}
            if state is None:
                state = now
                continue
            changes, state = compare(state, now)
            if core:
                out += [(device, file_id, *c) for c in changes]
        return typed_frame(out, CHANGES)

    return profiles.groupBy("device", "chunk").applyInPandas(fold, CHANGES)


def quantity_names(changes: DataFrame) -> DataFrame:
    """``column_name, quantity``: names linked by renames, each group under the table's own name among them.

    Only the distinct pairs of names and their counts (a few per quantity, whatever the number of files) are gathered.
    """
    links = changes.filter("change = 'renamed'").groupBy("column_name", "was").count()
    spark = changes.sparkSession
    weight: dict[tuple[str, str], int] = {}
    for r in links.toLocalIterator():
        k = tuple(sorted((r["column_name"], r["was"])))
        weight[k] = weight.get(k, 0) + r["count"]
    own = (*QUANTITIES, *TIME_QUANTITIES)
    group = {n: n for k in weight for n in k} | {q: q for q in own}

    def root(n: str) -> str:
        while group[n] != n:
            n = group[n]
        return n

    for (a, b), _ in sorted(weight.items(), key=lambda x: (-x[1], x[0])):
        ra, rb = root(a), root(b)
        if ra != rb and not (ra in own and rb in own):  # a weaker link never joins two known quantities
            keep, other = (ra, rb) if ra in own or (rb not in own and ra < rb) else (rb, ra)
            group[other] = keep
    rows = [(n, root(n)) for n in group]
    return spark.createDataFrame(rows, "column_name string, quantity string")


def unify_files(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One consistent table of all files, and the casts that failed.

    The table: ``file_id, device, line_no, dtm`` and the ozone quantities, typed; units written behind numbers are dropped
    and epoch or worded times are read. A column that is no quantity of the table stays out of it. The report:
    ``file_id, column_name, quantity, failed, entries``, one row per column with failed casts.
    """
    names = quantity_names(schema_changes(files))
    cells = path_values(files).select("file_id", "device", "line_no", F.explode("cells").alias("c")).select("file_id", "device", "line_no", F.col("c.name").alias("column_name"), F.col("c.value").alias("value"))
    cells = cells.join(names, "column_name", "left").withColumn("quantity", F.coalesce("quantity", "column_name"))
    v = F.col("value")
    number = F.regexp_extract("value", _NUM + r"(?=\s*(?:[^\d\s]\S*)?$)", 0).try_cast("double")
    worded = F.coalesce(*[F.try_to_timestamp(v, F.lit(f)) for f in ("d MMM yyyy H:mm:ss", "d MMM yyyy", "yyyyMMdd", "MM/dd/yyyy H:mm:ss", "MM/dd/yyyy")])
    stamp = F.when(v.rlike(r"^1?\d{9}(\.\d+)?$"), F.timestamp_seconds(v.try_cast("double"))).otherwise(F.coalesce(v.try_cast("timestamp"), worded))
    own = [*QUANTITIES, *TIME_QUANTITIES]
    typed = cells.filter(F.col("quantity").isin(own)).withColumns({"x": number, "t": F.when(F.col("quantity").isin("dtm", "pcdate"), stamp)})
    double = [q for q, kind in QUANTITIES.items() if kind == "double"]
    failed = (F.col("quantity").isin(double) & F.col("x").isNull()) | (F.col("quantity").isin("dtm", "pcdate") & F.col("t").isNull())
    report = typed.groupBy("file_id", "column_name", "quantity").agg(F.count_if(failed).alias("failed"), F.count("*").alias("entries")).filter("failed > 0")
    pick = [F.max(F.when(F.col("quantity") == q, F.col("x"))).alias(q) for q in double] + [F.max(F.when(F.col("quantity") == "flags", v)).alias("flags")]
    day, clock = F.max(F.when(F.col("quantity") == "pcdate", F.col("t"))), F.max(F.when(F.col("quantity") == "pctime", v))
    apart = F.concat_ws(" ", F.date_format(day, "yyyy-MM-dd"), clock).try_cast("timestamp")
    table = typed.groupBy("file_id", "device", "line_no").agg(F.coalesce(F.max(F.when(F.col("quantity") == "dtm", F.col("t"))), F.when(day.isNotNull() & clock.isNotNull(), apart)).alias("dtm"), *pick)
    return table, report


def found_changes(files: DataFrame) -> DataFrame:
    """``file_id, change, column_name`` of all changes."""
    return schema_changes(files).select("file_id", "change", "column_name")
