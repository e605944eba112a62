"""Writing: keyed partition merges through staging, exports, station files. Plans can be asked for without writing."""

from __future__ import annotations

import csv
import io
import json
import math
import zipfile
from collections.abc import Mapping, Sequence
from pathlib import Path

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from aerolake.operators.joins import with_scalars
from aerolake.operators.merge import merge_keyed, simplify_types
from aerolake.session import filesystem

# --- fixed values -------------------------------------------------------------------------------------------------------
PIECES = 8  # tasks that write one month's or year's partition
WDCGG_STATIONS = {187: "MKN"}
WDCGG_MISSING = -99.9
WDCGG_VALUES = {
    "dkl010h0": "wind_direction", "fkl010h0": "wind_speed", "uor200h0": "relative_humidity", "prestah0": "air_pressure", "tre200h0": "air_temperature",
    "rre150h0": "precipitation_amount", "gor000h0": "global_solar_radiation",
}
WDCGG_PLACE = {"latitude": -0.0621999986, "longitude": 37.2971992493, "altitude": 3688, "elevation": 3678}
# ---------------------------------------------------------------------------------------------------------------------


def _exists(spark: SparkSession, path: str) -> bool:
    fs, p = filesystem(spark, path)
    return fs.exists(p)


def with_partitions(df: DataFrame, time: str, split: str = "month") -> tuple[DataFrame, list[str]]:
    """Partition columns of a time: none, year, month or day."""
    parts = {"none": [], "year": ["year"], "month": ["year", "month"], "day": ["year", "month", "day"]}[split]
    f = {"year": F.year, "month": F.month, "day": F.dayofmonth}
    return df.withColumns({p: f[p](time) for p in parts}), parts


def time_range_filter(df: DataFrame, start: str, end: str) -> DataFrame:
    """A closed range of days as partition predicates, which Spark doesn't infer from the time column."""
    lo, hi = (F.lit(x).cast("date") for x in (start, end))
    out = df
    if "year" in df.columns:
        out = out.filter(F.col("year").between(F.year(lo), F.year(hi)))
        if "month" in df.columns:
            months = F.col("year") * 12 + F.col("month")
            out = out.filter(months.between(F.year(lo) * 12 + F.month(lo), F.year(hi) * 12 + F.month(hi)))
    return out


def merge_into(incoming: DataFrame, target: str, keys: Sequence[str], time: str = "dtm", split: str = "month", prefer: str = "incoming", rank: str | None = None, dry_run: bool = False, report: dict[str, int] | None = None) -> DataFrame:
    """Merge rows by key into a partitioned dataset; only partitions that get rows are rewritten.

    The merged partitions are written beside the dataset, verified (the schema, and the rows of every partition against
    those the merge made), then swapped in together: a failure before the swap changes nothing, and one during it puts back
    what was moved. Returns the merged rows (with ``dry_run`` nothing is written); ``report`` gets ``rows`` written,
    ``old_rows`` of the rewritten partitions and ``new_rows``. NaN is no value and becomes null. Null times go to the
    partition of a null year. A month or year of many rows is written by several tasks, cut by the hash of the key.
    """
    spark = incoming.sparkSession
    fractional = [c for c, k in incoming.dtypes if k in ("double", "float")]
    incoming = incoming.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in fractional})
    new, parts = with_partitions(incoming, time, split)
    old_rows = 0
    if _exists(spark, target):
        old = spark.read.parquet(target)
        touched = new.select(*parts).distinct()
        if parts:
            on = [F.col(f"o.{p}").eqNullSafe(F.col(f"t.{p}")) for p in parts]
            old = old.alias("o").join(touched.alias("t"), on, "left_semi")  # partition columns: pruned at run time
        old_rows = old.count() if report is not None and not dry_run else 0
        merged = merge_keyed(old, new, keys, prefer, rank)
    else:
        merged = merge_keyed(new.limit(0), new, keys, prefer, rank)
    if dry_run:
        return merged
    staging = f"{target.rstrip('/')}.staging"
    seen = Observation()
    piece = F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(PIECES))
    out = merged.observe(seen, F.count("*").alias("rows"))
    out = out.repartition(*[F.col(p) for p in parts], piece) if parts else out
    out = out.sortWithinPartitions(*parts, time)
    out.write.mode("overwrite").partitionBy(*parts).option("compression", "zstd").parquet(staging)
    try:
        verify_staged(spark, staging, merged, seen.get["rows"])
    except BaseException:
        fs, stage = filesystem(spark, staging)
        fs.delete(stage, True)
        raise
    swap_in(spark, staging, target, len(parts))
    if report is not None:
        report |= {"rows": seen.get["rows"], "old_rows": old_rows, "new_rows": seen.get["rows"] - old_rows}
    return spark.read.parquet(target)


def verify_staged(spark: SparkSession, staging: str, expected: DataFrame, rows: int) -> None:
    """Raise unless a staged dataset has the expected columns and types and as many rows as were sent to it."""
    if not rows:
        return
    staged = spark.read.parquet(staging)
    folders = {f.name for f in staged.schema} & {"year", "month", "day"}  # their types are read from names
    want, have = ({c: k for c, k in df.dtypes if c not in folders} for df in (expected, staged))
    if want != have:
        raise ValueError(f"the staged columns differ: {sorted(set(want.items()) ^ set(have.items()))}")
    n = staged.count()
    if n != rows:
        raise ValueError(f"{n} rows staged of {rows}")


def swap_in(spark: SparkSession, staging: str, target: str, depth: int) -> None:
    """Move every partition folder of a staged dataset to its place. The old ones stay aside until all have moved; if a move fails, all are put back."""
    fs, stage = filesystem(spark, staging)
    _, final = filesystem(spark, target)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path

    def walk(folder, left: int):
        for s in fs.listStatus(folder):
            if s.isDirectory():
                yield from walk(s.getPath(), left - 1) if left > 1 else [s.getPath()]

    base = str(stage.toUri().getPath()).rstrip("/")
    if depth == 0 or not fs.exists(final):
        moves = [(stage, final)]
    else:
        moves = [(p, path(target.rstrip("/") + str(p.toUri().getPath())[len(base) :])) for p in walk(stage, depth)]
    done: list[tuple] = []
    try:
        for p, place in moves:
            aside = path(place.getParent(), f"_{place.getName()}.old")  # hidden from readers
            held = fs.exists(place)
            if fs.exists(aside):
                raise OSError(f"{aside} is left of a swap that broke off and can't be moved over")
            if held and not fs.rename(place, aside):
                raise OSError(f"{place} can't be moved aside")
            done.append((p, place, aside, held, False))
            fs.mkdirs(place.getParent())
            if not fs.rename(p, place):
                raise OSError(f"{p} can't be moved")
            done[-1] = (p, place, aside, held, True)
    except BaseException:
        for p, place, aside, held, moved in reversed(done):
            if moved:
                fs.rename(place, p)
            if held:
                fs.rename(aside, place)
        raise
    for _, _, aside, held, _ in done:
        if held:
            fs.delete(aside, True)
    fs.delete(stage, True)


def write_level2(df: DataFrame, target: str, station: str, instrument: str, every: str, time: str = "dtm", simplify: bool = True) -> str:
    """Level 2 rows below ``target`` by frequency, partitioned by station, instrument and year."""
    path = f"{target.rstrip('/')}/{every}"
    out = df.withColumns({"station": F.lit(station), "instrument": F.lit(instrument.replace("/", "-")), "year": F.year(time)})
    out = simplify_types(out) if simplify else out
    out.repartition("year", F.month(time)).sortWithinPartitions("year", time).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("station", "instrument", "year").option("compression", "zstd").parquet(path)
    return path


def export_csv(df: DataFrame, path: str, order: Sequence[str], zipped: bool = False) -> str:
    """A small table as one csv file, or one csv in a zip; rows come to the driver one partition at a time."""
    text = io.StringIO()
    out = csv.writer(text)
    out.writerow(df.columns)
    for r in df.orderBy(*order).toLocalIterator():
        out.writerow(["" if v is None else v for v in r])
    if zipped:
        with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
            z.writestr(Path(path).stem + ".csv", text.getvalue())
    else:
        Path(path).write_text(text.getvalue())
    return path


def lost_flags(spark: SparkSession, target: str, df: DataFrame) -> list[str]:
    """Flag columns that an existing target has and a rewrite would lose."""
    if not _exists(spark, target):
        return []
    return sorted(c for c in spark.read.parquet(target).columns if c.startswith("f_") and c not in df.columns)


def general(c: Column) -> Column:
    """A number in six significant digits without idle zeros, in powers of ten under 1e-4 and from 1e6 on (as %g)."""
    x = c.cast("double")
    form = F.format_string("%.5e", x)  # rounded to six digits: d.ddddde±xx
    tens = F.regexp_extract(form, r"e([+-]\d+)$", 1).cast("int")
    plain = lambda t: F.regexp_replace(F.regexp_replace(t, r"(\.\d*?)0+$", "$1"), r"\.$", "")
    rounded = form.cast("decimal(38,12)").cast("string")
    return F.when((x == 0) | ((tens >= -4) & (tens < 6)), plain(rounded)).otherwise(F.concat(plain(F.substring_index(form, "e", 1)), F.lit("e"), F.regexp_extract(form, r"e([+-]\d+)$", 1)))


def wdcgg_lines(df: DataFrame, time: str, station: str, values: Mapping[str, str] = WDCGG_VALUES, place: Mapping[str, float] = WDCGG_PLACE) -> DataFrame:
    """Lines of a meteorological WDCGG submission, without the header: ``time``, ``line``.

    A line holds the station's name, year, month, day, hour, minute and second, the seven values in six significant digits
    (-99.9 where missing or NaN; a wind direction of 360 is 0), latitude and longitude with ten decimals, altitude and elevation.
    ``values``: column -> name in the header. Rows of unknown stations have no line; a column that isn't there is missing.
    """
    names = F.create_map(*[F.lit(x) for kv in WDCGG_STATIONS.items() for x in kv])

    def cell(column: str, name: str) -> Column:
        x = F.col(column).try_cast("double") if column in df.columns else F.lit(None).cast("double")
        x = F.when(~F.isnan(x), x)
        return general(F.coalesce(F.when(x == 360, 0.0).otherwise(x) if name == "wind_direction" else x, F.lit(WDCGG_MISSING)))

    clock = [F.date_part(F.lit(p), F.col(time)).cast("int").cast("string") for p in ("year", "month", "day", "hour", "minute", "second")]
    spot = [F.lit(f"{place[k]:.10f}") for k in ("latitude", "longitude")] + [F.lit(str(int(place[k]))) for k in ("altitude", "elevation")]
    site = names[F.col(station).cast("int")]
    return df.filter(site.isNotNull()).select(F.col(time), F.concat_ws(" ", site, *clock, *[cell(c, n) for c, n in values.items()], *spot).alias("line"))


def wdcgg_header(values: Mapping[str, str] = WDCGG_VALUES) -> str:
    return " ".join(["site_gaw_id", "year", "month", "day", "hour", "minute", "second", *values.values(), "latitude", "longitude", "altitude", "elevation"])


def write_wdcgg(df: DataFrame, path: str, time: str, station: str, values: Mapping[str, str] = WDCGG_VALUES) -> str:
    """One station's year as a text file with its header; more than one station or year is an error."""
    span = df.agg(F.count_distinct(station).alias("s"), F.count_distinct(F.year(time)).alias("y")).first()
    if span["s"] != 1 or span["y"] != 1:
        raise ValueError(f"{span['s']} stations and {span['y']} years instead of one")
    with open(path, "w", encoding="utf-8") as f:
        f.write(wdcgg_header(values) + "\n")
        for r in wdcgg_lines(df, time, station, values).orderBy(time).toLocalIterator():
            f.write(r["line"] + "\n")
    return path


def ebas_columns(df: DataFrame) -> DataFrame:
    """Aethalometer columns in the units of a NASA-Ames submission.

    Pressure from Pa to hPa; the sample's and the case's temperatures from degC to K; flows from ml/min to l/min; black
    carbon of both spots and combined from ng to ug. What isn't finite is null. Other columns, as the attenuations
    (:func:`aerolake.operators.windows.attenuation`), pass through.
    """

    def finite(c: str) -> Column:
        x = F.col(c).try_cast("double")
        return F.when(~F.isnan(x) & (F.abs(x) < float("inf")), x)

    out = {}
    for c in df.columns:
        low = c.lower()
        if low == "pressure":
            out[c] = finite(c) / 100
        elif low in ("temperature", "conttemp", "supplytemp", "ledtemp"):
            out[c] = finite(c) + 273.15
        elif low in ("flow1", "flow2", "flowc") or (low.startswith("bc") and low[2:].isdigit()):
            out[c] = finite(c) / 1000
    return df.withColumns(out)


#: Order of a level 0 submission's variables.
EBAS_ORDER = (
    "Pressure", "Temperature", "Flow1", "Flow2", "FlowC", "ContTemp", "SupplyTemp", "LedTemp", "Status", "ContStatus", "DetectStatus", "LedStatus", "ValveStatus", "TapeAdvCount", "BB",
    *(n.format(i) for i in range(1, 8) for n in ("RefCh{}", "Sen1Ch{}", "Sen2Ch{}", "BC{}1", "BC{}2", "BC{}", "K{}", "w{}_sp1", "w{}_sp2")),
)


def ebas_level0(df: DataFrame, time: str, cadence_s: int, flag: str | None = None, humidity: str | None = None) -> DataFrame:
    """Rows of a level 0 submission: start and end in days since 1 January of the first row's year, the variables in order, the flag.

    A column that isn't there is missing; without a flag column the flag is 0. The first row's year is one aggregate, joined as a value.
    """
    year = df.agg(F.year(F.min(time)).alias("_y"))
    rows = with_scalars(ebas_columns(df), year)
    start = F.unix_micros(F.make_timestamp("_y", F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0)))
    days = lambda us: F.round((us - start) / 86_400e6, 6)
    order = [humidity] * (humidity is not None) + list(EBAS_ORDER)
    have = {c.lower(): c for c in df.columns}
    cells = [(F.col(have[c.lower()]) if c.lower() in have else F.lit(None)).cast("double").alias(c) for c in order]
    return rows.select(F.col(time), days(F.unix_micros(time)).alias("start_time"), days(F.unix_micros(time) + cadence_s * 1_000_000).alias("end_time"), *cells, (F.col(flag).cast("double") if flag else F.lit(0.0)).alias("numflag"))


def nasa_ames_text(df: DataFrame, time: str, values: Mapping[str, float], header: Mapping[str, str]) -> str:
    """A NASA-Ames 1001 file: ``values`` maps columns to their missing codes; time is days since 1 January."""
    year = df.agg(F.year(F.min(time)).alias("y")).first()["y"]
    start = F.make_timestamp(F.lit(year), F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0))
    days = F.round((F.unix_micros(time) - F.unix_micros(start)) / 86_400e6, 6)
    names = " ".join(["starttime", *values])
    normal = [*(f"{k}: {v}" for k, v in header.items()), names]
    top = [header.get("Originator", "unknown"), header.get("Organisation", "unknown"), header.get("Submitter", "unknown"), header.get("Project", "unknown"), "1 1"]
    top += [f"{year} 01 01 {year} 01 01", "0", "days from the file reference point", str(len(values)), " ".join("1" for _ in values), " ".join(f"{m:g}" for m in values.values()), *values, "0", str(len(normal)), *normal]
    lines = [f"{len(top) + 1} 1001", *top]
    rows = df.select(days.alias("_d"), *[F.coalesce(F.col(c).cast("double"), F.lit(float(m))).alias(c) for c, m in values.items()]).orderBy("_d")
    lines += [" ".join([f"{r['_d']:.6f}", *(f"{r[c]:g}" for c in values)]) for r in rows.toLocalIterator()]
    return "\n".join(lines) + "\n"


def plain_json(value) -> object:
    """A value for JSON: NaN and infinities are null, times are text."""
    if isinstance(value, float) and not math.isfinite(value):
        return None
    if isinstance(value, dict):
        return {k: plain_json(v) for k, v in value.items()}
    if isinstance(value, list | tuple):
        return [plain_json(v) for v in value]
    return value.isoformat() if hasattr(value, "isoformat") else value


def write_dashboard(folder: str, stations: Mapping[str, Mapping]) -> list[str]:
    """An index and one file per station."""
    out = Path(folder)
    out.mkdir(parents=True, exist_ok=True)
    index = {"stations": sorted(stations)}
    names = [(out / "index.json", index), *[(out / f"{s}.json", data) for s, data in stations.items()]]
    for path, data in names:
        path.write_text(json.dumps(plain_json(data), allow_nan=False, indent=1))
    return [str(p) for p, _ in names]


def organise_files(folder: str, split: str = "month") -> dict[str, str]:
    """Move files of a local folder into buckets by the date in their names; equal ones (CRC32) are dropped, others renamed.

    A duplicate name with other content gets ``_dup`` and a number. Files without a date stay. Returns old -> new.
    """
    import re
    import zlib

    moved = {}
    for f in sorted(Path(folder).iterdir()):
        m = re.search(r"(?<!\d)((?:19|20)\d{2})(\d{2})(\d{2})", f.name) if f.is_file() else None
        if not m:
            continue
        parts = {"year": [m[1]], "month": [m[1], m[2]], "day": [m[1], m[2], m[3]]}[split]
        place = Path(folder, *parts, f.name)
        place.parent.mkdir(parents=True, exist_ok=True)
        n = 0
        while place.exists():
            if zlib.crc32(place.read_bytes()) == zlib.crc32(f.read_bytes()):
                f.unlink()
                break
            n += 1
            place = place.with_name(f"{f.stem}_dup{n}{f.suffix}")
        if f.exists():
            f.rename(place)
        moved[str(f)] = str(place)
    return moved
