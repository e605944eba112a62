import json
import zipfile

import pytest
from pyspark.sql import functions as F

from aerolake.pipeline import InstrumentConfig, build_dashboard, discover, ingest, main, run_station
from aerolake.sources import sinks
from aerolake.streaming.level2 import stream_level2, stream_transitions

ROW = "dtm timestamp, v double, f_v tinyint"


def test_merge_into_touches_only_its_partitions(spark, tmp_path, at):
    target = str(tmp_path / "l1")
    first = spark.createDataFrame([(at("2026-01-05"), 1.0, 0), (at("2026-02-05"), 2.0, 0)], ROW)
    planned = sinks.merge_into(first, target, ["dtm"], dry_run=True)
    assert planned.count() == 2 and not (tmp_path / "l1").exists()
    sinks.merge_into(first, target, ["dtm"])
    before = {p.name for p in (tmp_path / "l1/year=2026/month=1").glob("*.parquet")}
    out = sinks.merge_into(spark.createDataFrame([(at("2026-02-05"), 9.0, 1), (at("2026-02-06"), 3.0, 0)], ROW), target, ["dtm"])
    assert [(str(r.dtm)[:10], r.v) for r in out.orderBy("dtm").collect()] == [("2026-01-05", 1.0), ("2026-02-05", 9.0), ("2026-02-06", 3.0)]
    assert {p.name for p in (tmp_path / "l1/year=2026/month=1").glob("*.parquet")} == before
    kept = sinks.merge_into(spark.createDataFrame([(at("2026-02-05"), 7.0, 1)], ROW), target, ["dtm"], prefer="existing")
    assert kept.filter(F.col("dtm") == at("2026-02-05")).first().v == 9.0
    assert sinks.time_range_filter(spark.read.parquet(target), "2026-02-01", "2026-02-28").count() == 2


def test_exports(spark, tmp_path, at):
    df = spark.createDataFrame([(at("2026-01-01 01:00:00"), 187, 360.5, None), (at("2026-01-01 00:00:00"), 187, 1.0, 2.5)], "dtm timestamp, iii int, a double, b double")
    sinks.export_csv(df, str(tmp_path / "x.zip"), ["dtm"], zipped=True)
    assert zipfile.ZipFile(tmp_path / "x.zip").read("x.csv").decode().splitlines()[1].endswith("187,1.0,2.5")
    values = {"a": "wind_direction", "b": "wind_speed"}
    lines = open(sinks.write_wdcgg(df, str(tmp_path / "x.dat"), "dtm", "iii", values)).read().splitlines()
    assert lines[0] == "site_gaw_id year month day hour minute second wind_direction wind_speed latitude longitude altitude elevation"
    spot = "-0.0621999986 37.2971992493 3688 3678"
    assert lines[1:] == [f"MKN 2026 1 1 0 0 0 1 2.5 {spot}", f"MKN 2026 1 1 1 0 0 360.5 -99.9 {spot}"]
    with pytest.raises(ValueError):
        sinks.write_wdcgg(df.union(df.withColumn("dtm", F.lit(at("2025-01-01")))), str(tmp_path / "y.dat"), "dtm", "iii", values)
    from aerolake.sources.formats import nasa_ames

    text = sinks.nasa_ames_text(df, "dtm", {"a": 9999.9, "b": 99.99}, {"Station": "MKN"})
    back = nasa_ames("x", text.encode())
    assert [(str(t)[:16], v, None if x != x else x) for t, v, x in zip(back.dtm, back.variable, back.value, strict=True)] == [("2026-01-01 00:00", "a", 1.0), ("2026-01-01 01:00", "a", 360.5), ("2026-01-01 00:00", "b", 2.5), ("2026-01-01 01:00", "b", None)]
    units = sinks.ebas_columns(spark.createDataFrame([(101300.0, 20.0, 2000, 512)], "pressure double, temperature double, flow1 long, bc6 long")).first()
    assert tuple(units) == (1013.0, 293.15, 2.0, 0.512)
    case = sinks.ebas_columns(spark.createDataFrame([(30.0, float("nan"), 25.0, 1024.0, 7, float("inf"))], "ContTemp double, SupplyTemp double, LedTemp double, BC61 double, BB int, FlowC double")).first()
    assert tuple(case) == (303.15, None, 298.15, 1.024, 7, None)
    row = sinks.ebas_level0(spark.createDataFrame([(at("2026-01-02"), 100.0, 5.0)], "dtm timestamp, Pressure double, w6_sp2 double"), "dtm", 60).first()
    assert (row.start_time, row.end_time, row.Pressure, row.w6_sp2, row.BB, row.numflag) == (1.0, 1.000694, 1.0, 5.0, None, 0.0)


def test_numbers_of_six_digits(spark):
    values = [0.0, 1.0, -2.5, 123456.7, 999999.5, 1234567.0, 1e-4, 1.5e-5, -99.9, 1e15, 0.1 + 0.2]
    got = [r.g for r in spark.createDataFrame([(v,) for v in values], "v double").select(sinks.general(F.col("v")).alias("g")).collect()]
    assert got == [f"{v:g}" for v in values]


def test_a_merge_that_fails_changes_nothing(spark, tmp_path, at, monkeypatch):
    target = str(tmp_path / "d")
    rows = [(at("2026-01-05"), 1.0, 0), (at("2026-02-05"), 2.0, 0)]
    report = {}
    sinks.merge_into(spark.createDataFrame(rows, ROW), target, ["dtm"], report=report)
    assert report == {"rows": 2, "old_rows": 0, "new_rows": 2}
    more = spark.createDataFrame([(at("2026-01-05"), float("nan"), 1), (at("2026-01-06"), 5.0, 1), (at("2026-02-05"), 8.0, 1)], ROW)
    before = sorted(map(str, spark.read.parquet(target).collect()))
    monkeypatch.setattr(sinks, "verify_staged", lambda *a: (_ for _ in ()).throw(ValueError("differs")))
    with pytest.raises(ValueError, match="differs"):
        sinks.merge_into(more, target, ["dtm"])
    monkeypatch.undo()
    assert sorted(map(str, spark.read.parquet(target).collect())) == before and not (tmp_path / "d.staging").exists()
    # the second move fails: what the first one moved is put back
    staging = tmp_path / "s"
    for month in (1, 2):
        (staging / "year=2026" / f"month={month}").mkdir(parents=True)
        (staging / "year=2026" / f"month={month}" / "x.parquet").write_bytes(b"x")
    (tmp_path / "d" / "year=2026" / "_month=2.old").mkdir()  # in the way of the old partition
    (tmp_path / "d" / "year=2026" / "_month=2.old" / "month=2").mkdir()
    with pytest.raises(Exception, match="moved"):
        sinks.swap_in(spark, str(staging), target, 2)
    assert sorted(map(str, spark.read.parquet(target).collect())) == before
    import shutil

    shutil.rmtree(tmp_path / "d" / "year=2026" / "_month=2.old")
    sinks.merge_into(more, target, ["dtm"], report=report)
    assert report == {"rows": 3, "old_rows": 2, "new_rows": 1}
    assert {str(r.dtm)[:10]: r.v for r in spark.read.parquet(target).collect()} == {"2026-01-05": None, "2026-01-06": 5.0, "2026-02-05": 8.0}


def test_staged_rows_are_verified(spark, tmp_path):
    path = str(tmp_path / "s")
    spark.range(5).write.parquet(path)
    sinks.verify_staged(spark, path, spark.range(1), 5)
    with pytest.raises(ValueError, match="5 rows staged of 6"):
        sinks.verify_staged(spark, path, spark.range(1), 6)
    with pytest.raises(ValueError, match="columns differ"):
        sinks.verify_staged(spark, path, spark.range(1).selectExpr("cast(id as int) as id"), 5)


def test_organise_files(tmp_path):
    for n, c in (("a-20260105.dat", "1"), ("note.txt", "x")):
        (tmp_path / n).write_text(c)
    sinks.organise_files(str(tmp_path))
    (tmp_path / "a-20260105.dat").write_text("2")
    sinks.organise_files(str(tmp_path))
    (tmp_path / "a-20260105.dat").write_text("1")
    sinks.organise_files(str(tmp_path))
    assert sorted(str(p.relative_to(tmp_path)) for p in tmp_path.rglob("*") if p.is_file()) == ["2026/01/a-20260105.dat", "2026/01/a-20260105_dup1.dat", "note.txt"]


def test_station_run(spark, tmp_path, at):
    (tmp_path / "l1/mkn").mkdir(parents=True)
    spark.createDataFrame([(at("2026-01-01 00:00:00"), 10.0, 0), (at("2026-01-01 00:30:00"), 20.0, 1)], "dtm timestamp, o3 double, f_o3 int").write.parquet(str(tmp_path / "l1/mkn/49i.parquet"))
    ins = [InstrumentConfig("tei/49i", ["O3"], ("1h",)), InstrumentConfig("gone", ["x"])]
    assert discover(spark, str(tmp_path / "l1"), "tei/49i") and not discover(spark, str(tmp_path / "l1"), "ae33")
    dry = run_station(spark, "mkn", ins, str(tmp_path / "l1"), str(tmp_path / "l2"))
    assert dry.rows == {"tei/49i 1h": 1} and list(dry.errors) == ["gone"] and not (tmp_path / "l2").exists()
    run_station(spark, "mkn", ins, str(tmp_path / "l1"), str(tmp_path / "l2"), write=True)
    got = spark.read.parquet(str(tmp_path / "l2/1h")).first()
    assert (got.O3, got.n_O3, got.station, got.instrument, got.year) == (10.0, 1, "mkn", "tei-49i", 2026)
    assert sinks.lost_flags(spark, str(tmp_path / "l1/mkn/49i.parquet"), spark.createDataFrame([(1,)], "o3 int")) == ["f_o3"]
    with pytest.raises(ValueError):
        InstrumentConfig.of({"name": "x", "variables": ["a"], "what": 1})
    config = tmp_path / "c.json"
    config.write_text(json.dumps({"station": "mkn", "instruments": [{"name": "gone", "variables": ["x"]}]}))
    assert main(["level2", "--config", str(config), "--level1", str(tmp_path / "l1"), "--target", str(tmp_path / "l3")]) == 2


def test_ingest_and_dashboard(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    for m in (1, 2):
        (raw / f"hmp110-{m}.csv").write_text(f"dtm,T,RH,Td\n2026-08-0{m} 00:00:00,2{m}.5,35,10\n2026-08-01 00:01:00,2{m}.0,35,10\n")
    (raw / "hmp110-bad.zip").write_bytes(b"no zip")
    report, failed = ingest(spark, str(raw), str(tmp_path / "l1"), ["hmp110"], write=True)
    assert report.rows == {"hmp110": 3} and failed["hmp110"].count() == 1
    again, _ = ingest(spark, str(raw), str(tmp_path / "l1"), ["hmp110"], write=True)
    assert again.rows == {"hmp110": 3}
    r = build_dashboard(spark, str(tmp_path / "site"), {"mkn": {"hmp": {"path": str(tmp_path / "l1/hmp110"), "cadence_s": 60, "plot": ["T"]}, "gone": {"path": str(tmp_path / "none"), "cadence_s": 60, "plot": []}}}, "2026-08-01 00:04:00")
    site = json.loads((tmp_path / "site/mkn.json").read_text())
    assert site["hmp"]["availability"]["observed"] == 2 and site["hmp"]["availability"]["expected"] == 5 and "error" in site["gone"]
    assert list(r.errors) == ["mkn/gone"] and json.loads((tmp_path / "site/index.json").read_text()) == {"stations": ["mkn"]}


def test_streams_equal_batches(spark, tmp_path, at):
    rows = [(at(f"2026-01-01 0{h}:{m:02d}:00"), "a", float(h * 10 + m), 1 if m == 30 else 0, s) for h in range(4) for m, s in ((0, 0), (20, 1), (30, 0), (35, 0), (50, 0))]
    df = spark.createDataFrame(rows, "dtm timestamp, k string, v double, f_v tinyint, state int")
    src = tmp_path / "in"
    for h in range(4):
        df.filter(F.hour("dtm") == h).coalesce(1).write.parquet(str(src / f"h{h}"))
    stream = spark.readStream.schema(df.schema).option("recursiveFileLookup", True).option("maxFilesPerTrigger", 1).parquet(str(src))
    q = stream_level2(stream, ["v"], keys=["k"], identity=["k"]).writeStream.outputMode("complete").format("memory").queryName("hours").start()
    q.processAllAvailable()
    q.stop()
    batch = stream_level2(df.union(df), ["v"], keys=["k"], identity=["k"])
    assert sorted(map(tuple, spark.table("hours").collect())) == sorted(map(tuple, batch.collect()))
    with pytest.raises(ValueError):
        stream_level2(df, ["v"], method="median")
    q = stream_transitions(stream, "k", "state").writeStream.outputMode("append").format("memory").queryName("moves").start()
    q.processAllAvailable()
    q.stop()
    got = {str(r.dtm)[11:16]: r.unsettled for r in spark.table("moves").collect()}
    assert len(got) == 20 and [t for t, u in got.items() if u] and all(u == (t[3:] in ("30", "35")) for t, u in got.items())
