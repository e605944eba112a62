"""Far too many small files: harvest tiny csv fragments into few well-sized files, each record once.

The steps are those of a table compaction: a frozen manifest, first-fit-decreasing bins, one rewrite per bin,
verification of counts and checksums against the manifest, and a commit that is a single rename.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolake.session import discard, filesystem, scratch_path, write_scratch

TARGET_BYTES = 128 << 20
BLOCK_BINS = 64  # bins that one block of first-fit decreasing fills
BLOCK_FILES = 1_000_000  # files of a block at most, which bounds a task's list
MOST_BINS = 100_000  # tasks of the rewrite; beyond that the files are made larger
COLUMNS = 400  # names that become typed columns, the most frequent first; cells under other names stay in ``rest``

_LINE_END = re.compile(r"\r\n|\n|\r")
_QUOTED_LINE = re.compile(r'(?:\s*"(?:[^"]|"")*"\s*|[^",]*)(?:,(?:\s*"(?:[^"]|"")*"\s*|[^",]*))*')


@dataclass(frozen=True)
class Compacted:
    """Paths of a committed harvest: ``data`` (records by bin) and ``manifest`` (one row per fragment)."""

    path: str
    n_fragments: int
    n_records: int
    n_bins: int

    def records(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.path}/data")

    def manifest(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.path}/manifest")


def _instant_us(text: Column) -> Column:
    """Microseconds of an ISO-like instant; without an offset it is UTC. Null if it isn't an instant."""
    t = F.trim(text)
    zoned = F.when(t.rlike(r"([zZ]|[+-]\d{2}:?\d{2})$") & t.rlike(r"\d:\d{2}"), t).otherwise(F.concat(t, F.lit("Z")))
    return F.unix_micros(zoned.try_cast("timestamp"))


def quoted_rows(content: str) -> list[list[str]]:
    """Fields of every line of a text with quotes; a quoted field may hold commas, line ends and doubled quotes.

    Line ends between an odd number of quotes and the next odd one are inside. A line whose quotes don't stand at field
    borders, or aren't closed, is taken as it is.
    """
    lines = _LINE_END.split(content)
    closes, after = [0] * len(lines), None
    for k in range(len(lines) - 1, -1, -1):
        odd = lines[k].count('"') % 2 == 1
        closes[k] = after if odd else k
        after = k if odd else after
    out: list[list[str]] = []
    at = 0
    while at < len(lines):
        end = closes[at]
        text = "\n".join(lines[at : end + 1]) if end is not None else ""
        if '"' in text and _QUOTED_LINE.fullmatch(text):
            out.append(next(csv.reader([text], skipinitialspace=True)))
        else:
            end = at
            out.append(lines[at].split(","))
        at = end + 1
    return out


def _column_names(header: Column) -> Column:
    """Names of a header's fields: lower case, without outer blanks, a repeated name or an empty one with its place."""
    clean = F.transform(header, lambda x: F.lower(F.trim(x)))
    named = F.transform(clean, lambda x, i: F.when((x == "") | (F.array_position(clean, x) != i + 1), F.concat(x, F.lit("#"), (i + 1).cast("string"))).otherwise(x))
    return F.when(F.size(F.array_distinct(clean)) < F.size(clean), named).when(F.array_contains(clean, ""), named).otherwise(clean)


def parse_fragments(fragments: DataFrame, quotes: bool = True) -> DataFrame:
    """One row per record line: ``fragment_id, line_no, device, instrument, content_hash, us, stamp, cells, h1, h2``.

    ``cells`` is the sorted array of (name, value, number) of all filled columns but dtm: column names in lower case
    without outer blanks, numbers in one spelling, so records written in another style or column order compare equal; an
    absent column is the same as an empty cell. Nothing that is filled is dropped: a name that stands twice, an empty name
    and a cell beyond the header have their place in the name (``o3#4``, ``#4``), and digits beyond a double's precision
    make a text. ``stamp`` holds the text of a dtm that is no instant (``us`` is then null). ``h1``, ``h2`` are two hashes
    of the record. ``quotes``: whether any text may hold quotes, which are then read by :func:`quoted_rows`.
    """
    content = F.regexp_replace("content", "^\ufeff", "")
    base = fragments.select(F.col("fragment_id").cast("long"), F.col("device").cast("string"), F.col("instrument").cast("string"), F.xxhash64("content").alias("content_hash"), content.alias("content"))

    def plain(df: DataFrame) -> DataFrame:
        lines = df.withColumn("lines", F.split("content", "\r\n|\n|\r")).filter(F.size("lines") > 1)
        lines = lines.withColumn("names", _column_names(F.split(F.element_at("lines", 1), ",")))
        rows = lines.select("fragment_id", "device", "instrument", "content_hash", "names", F.posexplode("lines").alias("line_no", "line"))
        return rows.filter((F.col("line_no") > 0) & (F.trim("line") != "")).select("fragment_id", "device", "instrument", "content_hash", "names", "line_no", F.split("line", ",", -1).alias("parts"))

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf.drop(columns="content").assign(fields=[quoted_rows(t) for t in pdf["content"]])

    def quoted(df: DataFrame) -> DataFrame:
        read = df.mapInPandas(parse, "fragment_id long, device string, instrument string, content_hash long, fields array<array<string>>")
        read = read.withColumn("names", _column_names(F.element_at("fields", 1)))
        rows = read.select("fragment_id", "device", "instrument", "content_hash", "names", F.posexplode("fields").alias("line_no", "parts"))
        return rows.filter((F.col("line_no") > 0) & F.exists("parts", lambda x: F.trim(x) != ""))

    has_quote = F.contains("content", F.lit('"'))
    rows = plain(base.filter(~has_quote)).unionByName(quoted(base.filter(has_quote))) if quotes else plain(base)
    at = F.array_position("names", "dtm").cast("int")
    stamp = F.when(at > 0, F.trim(F.get("parts", at - 1)))

    # names and texts, then numbers, then one spelling: each step works on what the one before has left
    places = F.sequence(F.lit(0), F.greatest(F.size("parts"), F.lit(1)) - 1)
    named = F.transform(places, lambda i: F.struct(F.coalesce(F.get("names", i), F.concat(F.lit("#"), (i + 1).cast("string"))).alias("name"), F.trim(F.get("parts", i)).alias("text")))
    filled = F.filter(named, lambda c: (c["name"] != "dtm") & c["text"].isNotNull() & (c["text"] != "") & (F.lower(c["text"]) != "nan"))
    read = F.transform(filled, lambda c: F.struct(c["name"].alias("name"), c["text"].alias("text"), F.when(c["text"].rlike(r"^[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d{1,3})?$"), c["text"].try_cast("double")).alias("x")))

    def spelled(c: Column) -> Column:
        text, x = c["text"], c["x"]
        # within 15 digits a double holds every digit; longer numbers stay texts without idle zeros
        exact = x.isNotNull() & ((F.length(text) <= 15) | (F.length(F.regexp_replace(text, r"^[+-]?[0.]*|[eE].*$|\.", "")) <= 15)) & (F.abs(x) < float("inf"))
        long_one = F.regexp_replace(F.regexp_replace(F.regexp_replace(text, r"^\+?(-?)0*(?=\d)", "$1"), r"(\.\d*?)0+$", "$1"), r"\.$", "")
        value = F.when(exact, (x + F.lit(0.0)).cast("string")).when(x.isNotNull() & ~F.contains(F.lower(text), F.lit("e")), long_one).otherwise(text)
        return F.struct(c["name"].alias("name"), value.alias("value"), F.coalesce(exact, F.lit(False)).alias("number"))

    cells = F.transform(read, spelled)
    us = _instant_us(stamp)
    out = rows.select("fragment_id", "line_no", "device", "instrument", "content_hash", us.alias("us"), F.when(us.isNull(), F.coalesce(stamp, F.lit(""))).alias("stamp"), F.array_sort(cells).alias("cells"))
    return out.withColumns(_record_hashes(F.col("us"), F.col("cells")))


def _record_hashes(us: Column, cells: Column) -> dict[str, Column]:
    """Two independent hashes of a record. Equal ones are one record: 128 bits don't collide by chance."""
    pairs = F.transform(cells, lambda c: F.struct(c["name"], c["value"]))
    known = F.coalesce("device", F.lit("")), F.col("device").isNull(), us, F.coalesce("stamp", F.lit("")), pairs
    return {"h1": F.xxhash64(*known), "h2": F.xxhash64(F.lit("second"), *known)}


def first_fit_decreasing(sizes: np.ndarray, capacity: float) -> np.ndarray:
    """The bin of each item; an item over the capacity gets a bin of its own."""
    bins = np.zeros(len(sizes), np.int64)
    left = np.zeros(max(len(sizes), 1))
    used = 0
    for i in np.argsort(-sizes, kind="stable"):
        fits = left[:used] >= sizes[i]
        b = int(fits.argmax()) if used and fits.any() else used
        if b == used:
            used += 1
            left[b] = max(capacity, sizes[i])
        left[b] -= sizes[i]
        bins[i] = b
    return bins


def plan_bins(manifest: DataFrame, target_bytes: int, block_files: int = BLOCK_FILES) -> DataFrame:
    """``fragment_id, bin``: bins by first-fit decreasing within blocks of one instrument's files.

    A block holds about 64 bins' worth of bytes, so that few bins stay part-filled, and at most about ``block_files`` files, so
    that no task holds an unbounded list. Bins are numbered from 0 over all blocks.
    """
    live = manifest.filter(F.col("n_new") > 0)
    need = F.greatest(F.count("*") / block_files, F.sum("live_bytes") / (BLOCK_BINS * target_bytes))
    blocks = live.groupBy(F.col("instrument").alias("kind")).agg(F.greatest(F.lit(1), F.ceil(need)).cast("int").alias("n_blocks"))
    keyed = live.join(blocks, F.col("instrument").eqNullSafe(F.col("kind"))).select("instrument", "fragment_id", "live_bytes", F.pmod(F.xxhash64("fragment_id"), "n_blocks").cast("int").alias("block"))

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("fragment_id")
        return pd.DataFrame({"fragment_id": pdf["fragment_id"], "instrument": pdf["instrument"], "block": pdf["block"], "local": first_fit_decreasing(pdf["live_bytes"].to_numpy(float), target_bytes)})

    return keyed.groupBy("instrument", "block").applyInPandas(pack, "fragment_id long, instrument string, block int, local int")


def _numbered(packed: DataFrame) -> tuple[DataFrame, int]:
    """Bins of all blocks numbered from 0; there are a few bins per block, and a block is 8 GB, so the list of blocks is short."""
    spark = packed.sparkSession
    counts = packed.groupBy("instrument", "block").agg((F.max("local") + 1).alias("n")).collect()
    rows, first = [], 0
    for r in sorted(counts, key=lambda r: (r["instrument"] or "", r["instrument"] is None, r["block"])):
        rows.append((r["instrument"], r["block"], first))
        first += r["n"]
    offsets = spark.createDataFrame(rows, "kind string, part int, first int")
    joined = packed.join(offsets, F.col("instrument").eqNullSafe(F.col("kind")) & (F.col("block") == F.col("part")))
    return joined.select("fragment_id", (F.col("first") + F.col("local")).alias("bin")), first


def differing_bins(expected: DataFrame, data: DataFrame, names: list[str]) -> tuple[int, int]:
    """How many bins of the written ``data`` differ from ``expected`` (``bin, n, x``), and how many records were read back."""
    typed = [F.when(F.col(f"cells.`{n}`").isNotNull(), F.struct(F.lit(n).alias("name"), F.col(f"cells.`{n}`").cast("string").alias("value"), F.lit(True).alias("number"))) for n in names]
    rest = F.transform(F.map_entries("rest"), lambda e: F.struct(e["key"].alias("name"), e["value"].alias("value"), F.lit(True).alias("number")))
    cells = F.array_sort(F.concat(F.filter(F.array(*typed), lambda c: c.isNotNull()), rest)) if typed else F.array_sort(rest)
    back = data.select("bin", _record_hashes(F.unix_micros("dtm"), cells)["h1"].alias("h1"))
    seen = back.groupBy(F.col("bin").alias("b")).agg(F.count("*").alias("n2"), F.bit_xor("h1").alias("x2"))
    wrong = ~(F.col("n").eqNullSafe(F.col("n2")) & F.col("x").eqNullSafe(F.col("x2")))
    verdict = expected.join(seen, F.col("bin") == F.col("b"), "full").agg(F.count_if(wrong).alias("bad"), F.coalesce(F.sum("n2"), F.lit(0)).alias("n")).first()
    return verdict["bad"], verdict["n"]


def compact(fragments: DataFrame, target: str | None = None, target_bytes: int = TARGET_BYTES, block_files: int = BLOCK_FILES) -> Compacted:
    """Write every distinct record of ``fragments`` exactly once into few files and commit them.

    fragments: ``fragment_id`` (unique, order of arrival), ``device``, ``instrument``, ``path``, ``n_bytes``, ``content``;
    other columns are ignored. Two records are the same if device, instant and each named column agree; the record stays
    with the smallest fragment_id. Null or empty content, a header without records and blank lines give no record; a line
    whose dtm isn't an instant is kept under its text; null devices form one group; surplus cells, repeated and empty
    column names and quoted fields are kept (:func:`parse_fragments`). An empty table commits an empty table and an
    empty manifest. The committed manifest has, per fragment, ``n_records``, ``n_new`` (records that no fragment of the device with
    a smaller id holds) and its ``bin``.

    Data: ``bin, device, instrument, dtm, stamp, cells, rest``. ``cells`` is a struct with a field per column name, double
    where all its entries are numbers, else string; names beyond the 400 most frequent are in the map ``rest``.

    Steps: (1) the manifest (id, path, size, checksum) is frozen as a written table; what is read must have its checksums;
    (2) bins by first-fit decreasing on the bytes that survive, as they are in zstd Parquet (measured on the parsed
    records); (3) one file per bin; (4) counts and order-free checksums of the written files are held against those of the
    source; (5) one rename commits data and manifest together, else the staging folder is removed and nothing changes. On
    an object store a rename copies and is not atomic; there, commit to a file system that renames, or by a pointer.

    Scale: record hashes, 32 bytes each, shuffle with partial aggregation, so a device with a third of all files is spread
    over all tasks; whole records shuffle twice, to their verdict and to their bin. A bin is bounded by ``target_bytes``, a
    block of the packing by its bytes and ``block_files``; over 100 000 bins the files get larger instead.
    """
    spark = fragments.sparkSession
    target = target or scratch_path(spark, "harvest")
    staging = f"{target}.staging"
    fs, final = filesystem(spark, target)
    _, stage_path = filesystem(spark, staging)
    if fs.exists(final):
        raise FileExistsError(target)
    size = F.coalesce(F.col("n_bytes").cast("long"), F.octet_length("content").cast("long"), F.lit(0).cast("long"))
    frozen, frozen_path = write_scratch(fragments.select(F.col("fragment_id").cast("long"), F.col("path").cast("string"), F.col("device").cast("string"), F.col("instrument").cast("string"), size.alias("n_bytes"), F.xxhash64("content").alias("content_hash"), F.contains("content", F.lit('"')).alias("quoted")), "manifest")
    parsed, parsed_path = write_scratch(parse_fragments(fragments, quotes=bool(frozen.filter("quoted").head(1))), "records")
    scratch = [frozen_path, parsed_path]
    try:
        firsts = parsed.groupBy("h1", "h2").agg(F.min(F.struct("fragment_id", "line_no")).alias("at")).select("h1", "at.*")
        firsts, path = write_scratch(firsts, "firsts")
        scratch.append(path)
        # one shuffle brings a file's manifest row, its records and its first records together
        long, text = F.lit(None).cast("long"), F.lit(None).cast("string")
        parts = frozen.select("fragment_id", "path", "device", "instrument", "n_bytes", "content_hash", long.alias("read_hash"), F.lit(0).alias("r"), F.lit(0).alias("w"), F.lit(1).alias("f"))
        empty = [text.alias("path"), text.alias("device"), text.alias("instrument"), long.alias("n_bytes"), long.alias("content_hash")]
        parts = parts.union(parsed.select("fragment_id", *empty, F.col("content_hash").alias("read_hash"), F.lit(1), F.lit(0), F.lit(0))).union(firsts.select("fragment_id", *empty, long, F.lit(0), F.lit(1), F.lit(0)))
        manifest = parts.groupBy("fragment_id").agg(*[F.max(c).alias(c) for c in ("path", "device", "instrument", "n_bytes", "content_hash", "read_hash", "f")], F.sum("r").alias("n_records"), F.sum("w").alias("n_new"))
        # what was read must be what the manifest froze
        changed = (F.col("f") == 0) | (F.col("read_hash").isNotNull() & ~F.col("read_hash").eqNullSafe(F.col("content_hash")))
        manifest = manifest.withColumn("content_hash", F.when(changed, F.raise_error(F.concat(F.lit("changed since the manifest: "), F.coalesce("path", F.col("fragment_id").cast("string")))).cast("long")).otherwise(F.col("content_hash")))
        # a csv byte's share of the parsed table tells what it takes in Parquet
        written = fs.getContentSummary(filesystem(spark, parsed_path)[1]).getLength()
        csv_bytes = frozen.agg(F.sum("n_bytes").alias("b")).first()["b"] or 0
        ratio = min(1.0, written / csv_bytes) if csv_bytes else 1.0
        live = F.when(F.col("n_records") > 0, F.col("n_bytes") * F.col("n_new") / F.col("n_records") * F.lit(ratio)).otherwise(F.lit(0.0))
        manifest, path = write_scratch(manifest.drop("read_hash", "f").withColumn("live_bytes", live), "manifest-counts")
        scratch.append(path)
        total = manifest.agg(F.count("*").alias("files"), F.coalesce(F.sum("n_new"), F.lit(0)).alias("records"), F.coalesce(F.sum("live_bytes"), F.lit(0.0)).alias("bytes")).first()
        packed, path = write_scratch(plan_bins(manifest, max(target_bytes, int(total["bytes"] / MOST_BINS)), block_files), "bins")
        scratch.append(path)
        bins, n_bins = _numbered(packed)

        shapes = parsed.select(F.transform("cells", lambda c: F.struct(c["name"].alias("name"), c["number"].alias("number"))).alias("s")).groupBy("s").count()
        kinds = shapes.select(F.explode("s").alias("c"), "count").groupBy("c.name").agg(F.min("c.number").alias("number"), F.sum("count").alias("n")).orderBy(F.desc("n"), "name").limit(COLUMNS).collect()
        names = sorted(r["name"] for r in kinds)
        numeric = {r["name"] for r in kinds if r["number"]}
        held = F.map_from_entries(F.transform("cells", lambda c: F.struct(c["name"], c["value"])))
        typed = F.struct(*[F.element_at("held", F.lit(n)).cast("double" if n in numeric else "string").alias(n) for n in names]) if names else F.struct(F.lit(None).cast("string").alias("none"))
        placed = firsts.join(bins, "fragment_id").select("fragment_id", "line_no", "bin", "h1")
        rest = F.map_filter("held", lambda k, v: ~k.isin(names)) if names else F.col("held")
        # rows take their written form before they are shuffled: doubles are shorter than names and texts
        rows = parsed.withColumn("held", held).select("fragment_id", "line_no", "device", "instrument", F.timestamp_micros("us").alias("dtm"), "stamp", typed.alias("cells"), rest.alias("rest"))
        out = rows.join(placed.drop("h1"), ["fragment_id", "line_no"]).select("bin", "device", "instrument", "dtm", "stamp", "cells", "rest")
        if n_bins:
            out = out.repartitionById(n_bins, "bin").sortWithinPartitions("device", "dtm")
        out.write.option("compression", "zstd").parquet(f"{staging}/data")
        manifest.join(bins, "fragment_id", "left").write.parquet(f"{staging}/manifest")
        if total["records"]:
            expected = placed.groupBy("bin").agg(F.count("*").alias("n"), F.bit_xor("h1").alias("x"))
            bad, n = differing_bins(expected, spark.read.parquet(f"{staging}/data"), names)
            if bad or n != total["records"]:
                raise ValueError(f"{bad} bins differ from the manifest; {n} of {total['records']} records written")
        if not fs.rename(stage_path, final):
            raise OSError(f"{staging} can't be renamed to {target}")
    except BaseException:
        fs.delete(stage_path, True)
        raise
    finally:
        discard(spark, *scratch)
    return Compacted(target, total["files"], total["records"], n_bins)


def redundant_fragments(fragments: DataFrame) -> DataFrame:
    """Fragments that add nothing, from the manifest of a committed harvest: ``fragment_id``."""
    done = compact(fragments)
    return done.manifest(fragments.sparkSession).filter(F.col("n_new") == 0).select("fragment_id")
