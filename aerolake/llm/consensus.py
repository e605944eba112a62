"""The best representative of each duplicate group, field by field, by token-level consensus.

Per group and column the distinct usable values are aligned progressively, token by token; weighted tokens vote in each
column of the alignment; and the existing value closest to the consensus survives. With the weights by trust each value
outweighs all less trusted ones together, so the most trusted and recent entry wins every column of the alignment; with the
weights by votes the rows decide, token by token. Either way all steps are taken.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolake.session import materialize

#: Texts that stand for a missing entry (in lower case), besides numbers of three or more nines before the point and only nines behind it.
PLACEHOLDERS = ("", "-", "--", "?", ".", "none", "null", "nan", "na", "n/a", "n.a.", "nil", "missing", "unknown")
CELLS = 16_000_000  # steps of an alignment held at once
BLOCK = 1000  # distinct values aligned at once; larger groups are merged in a tree
SHORT = 32  # up to so many tokens plain numbers are faster than arrays
COLUMNS = ("value", "aux", "flag", "note")
GAP = ""

_TOKEN = re.compile(r"\d|[^\W\d_]+|[^\w\s]|_")


def tokens(text: str) -> list[str]:
    """Digits one by one, words and signs."""
    return _TOKEN.findall(text)


def _weights(col: dict[str, int], places: dict[str, np.ndarray], m: int) -> np.ndarray:
    out = np.zeros(m)
    for t, w in col.items():
        if t in places:
            out[places[t]] = w
    return out


def _places(seq: list[str]) -> dict[str, np.ndarray]:
    at: dict[str, list[int]] = {}
    for j, t in enumerate(seq):
        at.setdefault(t, []).append(j)
    return {t: np.array(j) for t, j in at.items()}


def _score_short(profile: list[dict[str, int]], seq: list[str], total: int) -> Iterator[tuple[list[int], list[int]]]:
    row = [-total * j for j in range(len(seq) + 1)]
    for col in profile:
        held = total - col.get(GAP, 0)
        scores, steps, before = [row[0] - held], [1], row[0]
        for t, above in zip(seq, row[1:], strict=True):
            best, step = before + 2 * col.get(t, 0), 0
            if above - held > best:
                best, step = above - held, 1
            if scores[-1] - total > best:
                best, step = scores[-1] - total, 2
            scores.append(best)
            steps.append(step)
            before = above
        row = scores
        yield scores, steps


def _score_rows(profile: list[dict[str, int]], seq: list[str], total: int) -> Iterator[tuple[Sequence, Sequence]]:
    """Score and step of every prefix of ``seq`` after each column: 0 a match or mismatch, 1 a gap in seq, 2 a gap in the profile."""
    if len(seq) <= SHORT:
        yield from _score_short(profile, seq, total)
        return
    m, places = len(seq), _places(seq)
    run = np.arange(m + 1) * float(total)
    row = -run
    for col in profile:
        held = total - col.get(GAP, 0)
        up = row - held
        diagonal = np.concatenate([[-np.inf], row[:-1] + 2 * _weights(col, places, m)])
        row = np.maximum.accumulate(np.maximum(diagonal, up) + run) - run  # gaps in the profile run to the right
        yield row, np.where(row == diagonal, 0, np.where(row == up, 1, 2)).astype(np.int8)


def align(profile: list[dict[str, int]], seq: list[str], weight: int, total: int) -> list[dict[str, int]]:
    """Add one sequence to a profile of columns (token -> weight; GAP for gaps) by global alignment.

    A token scores twice the weight of its equals in the column, a mismatch nothing, a gap minus the weight it stands against.
    Where the table of steps would have over CELLS entries, the profile is halved where its halves' scores meet, so memory
    stays bounded whatever the length (ties may then fall otherwise).
    """
    n, m = len(profile), len(seq)
    if not n:
        return [{GAP: total, t: weight} if total else {t: weight} for t in seq]
    if n > 1 and n * m > CELLS:
        mid = n // 2
        for ahead, _ in _score_rows(profile[:mid], seq, total):
            pass
        for behind, _ in _score_rows(profile[:mid - 1 : -1], seq[::-1], total):
            pass
        cut = max(range(m + 1), key=lambda j: ahead[j] + behind[m - j])
        return align(profile[:mid], seq[:cut], weight, total) + align(profile[mid:], seq[cut:], weight, total)
    back = [step for _, step in _score_rows(profile, seq, total)]
    out, i, j = [], n, m
    while i or j:
        step = 2 if not i else 1 if not j else int(back[i - 1][j])
        if step == 0:
            i, j = i - 1, j - 1
            out.append(profile[i] | {seq[j]: profile[i].get(seq[j], 0) + weight})
        elif step == 1:
            i -= 1
            out.append(profile[i] | {GAP: profile[i].get(GAP, 0) + weight})
        else:
            j -= 1
            out.append({GAP: total, seq[j]: weight})
    return out[::-1]


def distance(a: list[str], b: list[str]) -> int:
    """Edit distance of two token sequences."""
    if len(b) <= SHORT:
        near = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            before, near[0] = near[0], i
            for j, y in enumerate(b, 1):
                before, near[j] = near[j], min(near[j] + 1, near[j - 1] + 1, before + (x != y))
        return near[-1]
    m, places = len(b), _places(b)
    run = np.arange(m + 1)
    row = run
    for x in a:
        same = np.zeros(m, np.int64)
        if x in places:
            same[places[x]] = 1
        best = np.minimum(row + 1, np.concatenate([[row[0] + 1], row[:-1] + 1 - same]))
        row = np.minimum.accumulate(best - run) + run
    return int(row[-1])


def representative(values: list[str], weights: list[int]) -> int:
    """The place of the value closest to the weighted consensus; ties go to the first. Values in order of alignment."""
    if len(values) == 1:
        return 0
    profile: list[dict[str, int]] = []
    split, total = [tokens(v) for v in values], 0
    for seq, w in zip(split, weights, strict=True):
        profile = align(profile, seq, w, total)
        total += w
    # equal votes go to the token that came first
    agreed = [t for t in (max(col, key=col.get) for col in profile) if t != GAP]
    return min(range(len(values)), key=lambda k: (distance(split[k], agreed), k))


def _usable(column: str, kind: str) -> Column:
    c = F.col(column)
    if kind == "string":
        return c.isNotNull() & ~F.lower(F.regexp_replace(c, r"^\s+|\s+$", "")).isin(*PLACEHOLDERS)
    x = c.cast("double")
    # three or more nines before the point, and nothing but nines behind it: 999, -9999 and 9999.9, but not 9.99 or 99.9
    nines = F.abs(x).cast("decimal(38,6)").cast("string").rlike(r"^9{3,}\.9*0*$")
    return c.isNotNull() & ~F.isnan(x) & ~F.coalesce(nines, F.lit(False))


def group_key(source: Column) -> Column:
    """The source in lower case without anything but letters and digits."""
    return F.regexp_replace(F.lower(source), r"[^\p{L}\p{N}]", "")


def survivors(rows: DataFrame, origins: DataFrame, columns: tuple[str, ...] = COLUMNS, weights: str = "trust") -> DataFrame:
    """The surviving entry of every conflicting or incomplete column of every duplicate group.

    rows: ``row_id, source, timestamp, origin, received_at`` and ``columns``; origins: ``origin, trust_rank``; other
    columns are ignored. Duplicates have the same source, by letters and digits, and the same whole second. Output:
    ``group_row_id`` (the group's smallest), ``column_name``, ``keep_row_id``, ``entry`` (as text) and ``conflict`` (more
    than one usable value); only columns with a usable entry whose entries aren't all alike.

    Null timestamps and null sources are never duplicates. NaN, null, empty and placeholder entries (also numbers of three
    or more nines before the point and only nines behind it) are missing. Rows of an unknown or null origin come after all known ones, a null received_at after all
    others; among rows with the surviving value the one of the smallest trust_rank, the latest received_at, then the
    largest row_id stays. Repeated rows are members like others; an empty table gives an empty one.

    weights: ``trust`` (each value outweighs all after it together) or ``votes`` (each row one vote, trust breaking ties).

    Scale: rows that share their group with no other leave first, by counts of a hash of the group (aggregated on the map
    side). The rest is reduced to distinct values per group and column, with partial aggregation, so a
    group of many copies is small at once. Groups of more than 1000 distinct values are aligned in blocks, block winners are
    aligned again until one is left (exact for ``trust``; for ``votes`` a tree of consensus votes). ``origins`` is joined
    as any table, so AQE broadcasts it while it is small.
    """
    kinds = dict(rows.dtypes)
    ranks = origins.groupBy(F.col("origin").alias("o")).agg(F.min("trust_rank").alias("trust_rank"))
    dated = rows.select("row_id", "source", "timestamp", "origin", "received_at", *columns).filter(F.col("timestamp").isNotNull() & F.col("source").isNotNull())
    dated = dated.withColumn("hash", F.xxhash64(group_key(F.col("source")), F.unix_seconds("timestamp")))
    # only rows that share the hash of their group with another row go on; a collision is dropped by the counts below
    shared = dated.groupBy("hash").agg(F.count("*").alias("rows")).filter("rows > 1").select("hash")
    base = dated.join(shared, "hash", "left_semi").join(ranks, F.col("origin") == F.col("o"), "left")
    far = 2**31 - 1
    # the greater, the better
    standing = F.struct((-F.coalesce(F.col("trust_rank").cast("long"), F.lit(far))).alias("trust"), F.coalesce(F.unix_micros("received_at"), F.lit(-(2**62))).alias("at"), F.col("row_id").cast("long").alias("keep"))
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.when(_usable(c, kinds[c]), F.col(c).cast("string")).alias("entry")) for c in columns])
    # beside a generator a new struct would lose its field names, so it is built first
    long = base.withColumns({"standing": standing, "cells": cells}).select(group_key(F.col("source")).alias("g"), F.unix_seconds("timestamp").alias("s"), F.col("row_id").cast("long").alias("row_id"), "standing", F.explode("cells").alias("c")).select("g", "s", "row_id", "standing", "c.column_name", "c.entry")
    key = ["g", "s", "column_name"]
    values = long.groupBy(*key, "entry").agg(F.count("*").alias("n"), F.max("standing").alias("standing"), F.min("row_id").alias("first_id"))
    values = materialize(values, "values")
    stats = values.groupBy(*key).agg(F.min("first_id").alias("group_row_id"), F.sum("n").alias("rows"), F.count("entry").alias("distinct"), F.count("*").alias("kinds"))
    stats = stats.filter((F.col("rows") > 1) & (F.col("distinct") > 0) & (F.col("kinds") > 1))
    live = values.filter("entry is not null").join(stats.select(*key, "group_row_id", "distinct"), key)
    level = live.select(*key, "group_row_id", F.col("distinct"), "entry", "n", "standing", F.col("n").alias("votes"))

    def pick(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            won = []
            for members in pdf["members"]:
                ordered = members[::-1]  # sorted upwards by standing
                w = [1 << (len(ordered) - 1 - k) for k in range(len(ordered))] if weights == "trust" else [int(m["votes"]) for m in ordered]
                won.append(ordered[representative([m["entry"] for m in ordered], w)])
            yield pd.DataFrame(
                {c: pdf[c] for c in ("g", "s", "column_name", "group_row_id", "distinct")}
                | {"entry": [m["entry"] for m in won], "keep": [m["keep"] for m in won], "trust": [m["trust"] for m in won], "at": [m["at"] for m in won]}
                | {"votes": [sum(int(x["votes"]) for x in m) for m in pdf["members"]]}
            )

    out_schema = "g string, s long, column_name string, group_row_id long, distinct long, entry string, keep long, trust long, at long, votes long"
    count = "distinct"
    while True:
        blocks = F.ceil(F.col(count) / (BLOCK // 2)).cast("long")
        block = F.when(F.col(count) > BLOCK, F.pmod(F.xxhash64("entry"), blocks)).otherwise(F.lit(0).cast("long"))
        grouped = level.groupBy(*key, "group_row_id", "distinct", block.alias("block")).agg(F.sort_array(F.collect_list(F.struct(F.col("standing.trust").alias("trust"), F.col("standing.at").alias("at"), F.col("standing.keep").alias("keep"), "entry", "votes"))).alias("members"))
        # a value alone in its block needs no alignment
        won = grouped.select("g", "s", "column_name", "group_row_id", "distinct", "members").mapInPandas(pick, out_schema)
        won = materialize(won, "winners")
        left = won.groupBy(*key).agg(F.count("*").alias("left"))
        most = left.agg(F.max("left").alias("m")).first()["m"] or 0
        if most <= 1:
            break
        level = won.join(left, key).select(*key, "group_row_id", "distinct", "entry", F.struct("trust", "at", "keep").alias("standing"), "votes", "left")
        count = "left"
    return won.select("group_row_id", "column_name", F.col("keep").alias("keep_row_id"), "entry", (F.col("distinct") > 1).alias("conflict"))


def surviving_entries(rows: DataFrame, origins: DataFrame) -> DataFrame:
    """``group_row_id, column_name, keep_row_id`` by trust."""
    return survivors(rows, origins).select("group_row_id", "column_name", "keep_row_id")


def consensus_entries(rows: DataFrame, origins: DataFrame) -> DataFrame:
    """``group_row_id, column_name, keep_row_id, entry`` by votes: each row of a group votes, token by token."""
    return survivors(rows, origins, weights="votes").select("group_row_id", "column_name", "keep_row_id", "entry")


def conflicting_columns(rows: DataFrame, origins: DataFrame) -> DataFrame:
    """Per duplicate group the columns with contradicting usable entries: ``group_row_id, conflicting_columns``."""
    named = survivors(rows, origins).filter("conflict").groupBy("group_row_id").agg(F.collect_set("column_name").alias("found"))
    return named.select("group_row_id", F.array_join(F.filter(F.array(*[F.lit(c) for c in COLUMNS]), lambda c: F.array_contains("found", c)), ",").alias("conflicting_columns"))
