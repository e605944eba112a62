"""Station runs: raw files to Level 1, Level 1 to Level 2, the dashboard; errors of one part don't stop the others.

    python -m aerolake.pipeline level2 --config station.json --level1 DIR --target DIR [--write]

Without ``--write`` everything is computed and nothing is written.
"""

from __future__ import annotations

import argparse
import json
import sys
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolake.operators import aggregate, availability, windows
from aerolake.operators.columns import find_time_column
from aerolake.operators.merge import relaxed_scan
from aerolake.session import filesystem
from aerolake.sources.files import read_format
from aerolake.sources.formats import FORMATS
from aerolake.sources.sinks import merge_into, write_dashboard, write_level2


@dataclass(frozen=True)
class InstrumentConfig:
    """An instrument of a station: its files, variables, methods, frequencies and reporting condition."""

    name: str
    variables: Sequence[str]
    frequencies: Sequence[str] = ("1h", "1d", "1mo")
    methods: Mapping[str, str] = field(default_factory=dict)
    accept_null_flag: bool = True
    zone: str | None = None
    condition: Mapping[str, float | str] | None = None

    @classmethod
    def of(cls, raw: Mapping) -> InstrumentConfig:
        unknown = set(raw) - set(cls.__dataclass_fields__)
        if unknown or not raw.get("name") or not raw.get("variables"):
            raise ValueError(f"instrument needs name and variables; unknown entries {sorted(unknown)}")
        return cls(**raw)


@dataclass
class RunReport:
    """What a run did: rows by instrument and frequency, and errors by part."""

    rows: dict[str, int] = field(default_factory=dict)
    errors: dict[str, str] = field(default_factory=dict)

    def summary(self) -> str:
        return "\n".join([*(f"{k}: {n} rows" for k, n in self.rows.items()), *(f"{k}: failed: {e}" for k, e in self.errors.items())])


def discover(spark: SparkSession, level1: str, instrument: str) -> list[str]:
    """Parquet files or folders of an instrument below a Level 1 folder: itself, a sub-folder, or the last part of a name.

    The folder may lie on any file system that Spark reads. A found folder is one entry; what is below it isn't searched.
    """
    names = dict.fromkeys([instrument, instrument.replace("/", "-"), instrument.rsplit("/", 1)[-1]])
    fs, root = filesystem(spark, level1)
    direct = [f"{level1.rstrip('/')}/{n}" for n in names]
    found = {p for p in direct if fs.exists(filesystem(spark, p)[1])}
    wanted = {f"{n.rsplit('/', 1)[-1]}.parquet" for n in names}
    folders = [root] if fs.exists(root) else []
    while folders:
        for s in fs.listStatus(folders.pop()):
            if s.getPath().getName() in wanted:
                found.add(s.getPath().toUri().getPath() if "://" not in level1 else str(s.getPath()))
            elif s.isDirectory():
                folders.append(s.getPath())
    return sorted(found)


def run_station(spark: SparkSession, station: str, instruments: Sequence[InstrumentConfig], level1: str, target: str, write: bool = False) -> RunReport:
    """Level 2 of every instrument and frequency, each directly from Level 1; one job per frequency over all years."""
    report = RunReport()
    for ins in instruments:
        try:
            paths = discover(spark, level1, ins.name)
            if not paths:
                raise FileNotFoundError(f"no files of {ins.name} in {level1}")
            rows = relaxed_scan(spark, paths)
            time = find_time_column(rows)
            if ins.condition:
                c = ins.condition
                rows = aggregate.correct_to_reporting_condition(rows, list(c["variables"]), c["pressure"], c["temperature"], c["target_p"], c["target_t"])
            spec = aggregate.Level2(ins.variables, methods=ins.methods, accept_null_flag=ins.accept_null_flag, time=time, zone=ins.zone)
            for every, df in aggregate.level2_all(rows, spec, ins.frequencies).items():
                if write:
                    path = write_level2(df, target, station, ins.name, every, time)
                    df = spark.read.parquet(path).filter((F.col("station") == station) & (F.col("instrument") == ins.name.replace("/", "-")))
                report.rows[f"{ins.name} {every}"] = df.count()
        except Exception as e:  # noqa: BLE001  (recorded; the other instruments go on)
            report.errors[ins.name] = f"{type(e).__name__}: {e}"
    return report


def ingest(spark: SparkSession, source: str, target: str, formats: Sequence[str], keys: Sequence[str] = ("dtm",), split: str = "month", write: bool = False) -> tuple[RunReport, dict[str, DataFrame]]:
    """Raw files of several formats into Level 1 datasets, one write per dataset; files that fail are in the errors."""
    report, failed = RunReport(), {}
    for name in formats:
        try:
            rows, errors = read_format(spark, source, FORMATS[name])
            merged = merge_into(rows.drop("member", "ordinal"), f"{target.rstrip('/')}/{name}", keys, split=split, dry_run=not write)
            report.rows[name] = merged.count()
            failed[name] = errors
        except Exception as e:  # noqa: BLE001
            report.errors[name] = f"{type(e).__name__}: {e}"
    return report, failed


def station_status(df: DataFrame, time: str, now: str, cadence_s: int, plot: Sequence[str], most_points: int = 3000) -> dict:
    """A source's entry of the dashboard: time profile, availability of the month, and thinned points of its variables."""
    t = F.lit(now).cast("timestamp")
    start = F.date_trunc("month", t)
    month = df.filter((F.col(time) >= start) & (F.col(time) <= t))
    profile = availability.time_profile(month, time).first().asDict()
    share = availability.availability(month, time, start, t, cadence_s).first().asDict()
    points = windows.stride_sample(month.filter(F.col(time).isNotNull()).withColumn("_all", F.lit(0)), ["_all"], [time], most_points).select(time, *plot).orderBy(time)
    return {"profile": profile, "availability": share, "points": [r.asDict() for r in points.limit(most_points + 1).collect()]}


def build_dashboard(spark: SparkSession, folder: str, sources: Mapping[str, Mapping[str, Mapping]], now: str) -> RunReport:
    """station -> source -> settings (path, cadence_s, plot): one JSON file per station and an index; errors are isolated."""
    report, stations = RunReport(), {}
    for station, own in sources.items():
        entry = {}
        for name, s in own.items():
            try:
                df = spark.read.parquet(s["path"])
                entry[name] = station_status(df, find_time_column(df, s.get("time")), now, s["cadence_s"], s["plot"])
                report.rows[f"{station}/{name}"] = entry[name]["profile"]["rows"]
            except Exception as e:  # noqa: BLE001
                entry[name] = {"error": f"{type(e).__name__}: {e}"[:300]}
                report.errors[f"{station}/{name}"] = entry[name]["error"]
        stations[station] = entry
    write_dashboard(folder, stations)
    return report


def main(argv: Sequence[str] | None = None) -> int:
    ap = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    sub = ap.add_subparsers(dest="what", required=True)
    level2 = sub.add_parser("level2", help="aggregate Level 1 to Level 2")
    level2.add_argument("--config", required=True, help="JSON: station and its instruments")
    level2.add_argument("--level1", required=True)
    level2.add_argument("--target", required=True)
    level2.add_argument("--write", action="store_true")
    raw = sub.add_parser("ingest", help="raw files to Level 1")
    raw.add_argument("--source", required=True)
    raw.add_argument("--target", required=True)
    raw.add_argument("--formats", nargs="+", required=True, choices=sorted(FORMATS))
    raw.add_argument("--write", action="store_true")
    args = ap.parse_args(argv)
    spark = SparkSession.builder.appName("aerolake").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    if args.what == "level2":
        config = json.loads(Path(args.config).read_text())
        report = run_station(spark, config["station"], [InstrumentConfig.of(i) for i in config["instruments"]], args.level1, args.target, args.write)
    else:
        report, _ = ingest(spark, args.source, args.target, args.formats, write=args.write)
    print(report.summary())
    return 2 if report.errors else 0


if __name__ == "__main__":
    sys.exit(main())
