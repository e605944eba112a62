import io
import tarfile
import zipfile
from dataclasses import replace

import pytest

from aerolake.sources.files import decode, read_format
from aerolake.sources.formats import AE33_COLUMNS, EATON_DECIMAL, EATON_TEXT, EATON_WHOLE, FORMATS, NE300_COLUMNS
from aerolake.sources.tahmo import calibrated_batch, conflicting_readings, wide


def zipped(**files):
    b = io.BytesIO()
    with zipfile.ZipFile(b, "w") as z:
        for n, text in files.items():
            z.writestr(n.replace("__", "."), text)
    return b.getvalue()


def read(spark, tmp_path, name, files):
    for n, content in files.items():
        p = tmp_path / n
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_bytes(content if isinstance(content, bytes) else content.encode())
    rows, errors = read_format(spark, str(tmp_path), FORMATS[name])
    return sorted((r.asDict() for r in rows.collect()), key=lambda r: (r["path"], r["ordinal"])), {e.path.rsplit("/", 1)[-1]: e.error for e in errors.collect()}


def test_decode():
    assert decode("é".encode()) == decode("é".encode("utf-16")) == decode("﻿é".encode()) == decode("é".encode("cp1252")) == "é"


def test_vrxa00(spark, tmp_path):
    head = "15834\nVRXA00 LSSW 190000\n\niii zzzztttt tre200s0 uor200s0 da1010z0\n"
    rows, errors = read(spark, tmp_path, "vrxa00", {"VRXA00.202310190000": head + "187 202310190000 005.1 / 190.4\n", "VRXA00.bad": "x\n", "VRXA00.empty": "", "other.txt": "x"})
    assert [(r["iii"], str(r["dtm"]), r["tre200s0"], r["uor200s0"], r["da1010z0"]) for r in rows] == [(187, "2023-10-19 00:00:00", 5.1, None, 190.4)]
    assert list(errors) == ["VRXA00.bad"]


def test_ae33(spark, tmp_path):
    names = list(AE33_COLUMNS)
    cells = {"Inst_SN": "AE33-1", "row_id": "7", "dtm": "2024-01-01 00:00:00", "BC6": "512", "BB": "12.5", "Flow1": "1990"}
    line = ",".join(cells.get(n, "") for n in names)
    piped = line.replace(",", "|").replace("2024-01-01 00:00:00", "01/01/2024 12:01:00 AM")
    old = "Inst_SN,dtm,unclear_2,BB\nAE33-1,2024-01-01 00:02:00,5,5\n"
    rows, errors = read(spark, tmp_path, "ae33", {"a_ae33.dat": "# note\n" + line + "\n", "b_ae33.csv": piped, "c_ae33.csv": old, "d_ae33.csv": line.replace("2024-01-01", "never"), "e_ae33.csv": old.replace("5,5", "5,6")})
    assert [(r["BC6"], r["BB"], str(r["dtm"])[11:]) for r in rows] == [(512, 12.5, "00:00:00"), (512, 12.5, "00:01:00"), (None, 5.0, "00:02:00")]
    assert sorted(errors) == ["d_ae33.csv", "e_ae33.csv"]


def test_ae31_shift(spark, tmp_path):
    full = '2024-09-08T18:04:00, 1144,"08-sep-24","18:00", 2206' + ", 1" * 49
    short = '"08-sep-24","18:05", 2207' + ", 1" * 49  # neither dtm nor id
    rows, _ = read(spark, tmp_path, "ae31", {"AE31_x.csv": full + "\n" + short + "\n"})
    assert [(str(r["dtm"]), r["id"], r["date"], r["UV370"]) for r in rows] == [("2024-09-08 18:04:00", "1144", "08-sep-24", 2206.0), ("2024-09-08 18:05:00", None, "08-sep-24", 2207.0)]


def test_thermo(spark, tmp_path):
    c = "pcdate pctime time date o3 flags cellai cellbi bncht lmpt o3lt flowa flowb pres\n2023-10-20 01:30:00 01:29 10-20 2261E-2 1c 93474 61039 29.0 55.6 99.9 0.539 0.582 492.6\nshort line\n"
    i = "dtm,time,date,o3,flags,hio3,cellai,cellbi,bncht,lmpt,o3lt,flowa,flowb,pres\n2023-10-20T01:31:00Z,a,b,31.1,0C,,1,2,3,4,5,6,7,8\n"
    rows, errors = read(spark, tmp_path, "thermo", {"tei49c-1.dat": c, "tei49i-2.zip": zipped(tei49i_2__csv=i)})
    assert [(str(r["dtm"]), r["o3"], r["flags"], r["cellai"], r["hio3"]) for r in rows] == [("2023-10-20 01:30:00", 22.61, "1c", 93474, None), ("2023-10-20 01:31:00", 31.1, "0C", 1, None)]
    assert not errors


def test_nephelometers(spark, tmp_path):
    data = "2024-07-16 11:48:00," + ",".join(str(i) for i in range(2, len(NE300_COLUMNS) + 1))
    rows, _ = read(spark, tmp_path, "ne300", {"ne300-1.dat": "dtm,4035,2002\n" + data})  # a header cut short
    assert (rows[0]["4035"], rows[0]["6450090"]) == (2.0, float(len(NE300_COLUMNS)))
    rows, _ = read(spark, tmp_path / "a", "aurora3000", {"aurora3000-1.csv": "2024-07-16T11:48:00,1,2,3,4,5,6,7,8,9,10,0,1"})
    assert (rows[0]["ssp1"], rows[0]["major_state"]) == (1.0, 0.0)


def test_small_formats(spark, tmp_path):
    g = "DATE                      TIME                      CO2_dry_sync  solenoid_valves\n2024-01-01                01:02:03.500              400.5         0.0\n"
    rows, _ = read(spark, tmp_path / "g", "g2401", {"x-DataLog_User_Sync.dat": g})
    assert (str(rows[0]["dtm"]), rows[0]["CO2_dry_sync"]) == ("2024-01-01 01:02:03", 400.5)
    rows, _ = read(spark, tmp_path / "h", "hmp110", {"hmp110-1.csv": "2025-12-17 17:59:01,26.58,35.37\n"})
    assert (rows[0]["T"], rows[0]["RH"], rows[0]["Td"]) == (26.58, 35.37, None)
    rows, errors = read(spark, tmp_path / "f", "fidas", {"fidas-1.csv": "dtm,60,id\n2025-12-17 17:59:01,5.5,x\n", "fidas-2.csv": "60\n1\n"})
    assert rows[0]["60"] == 5.5 and rows[0]["id"] == "x" and list(errors) == ["fidas-2.csv"]
    rows, _ = read(spark, tmp_path / "a", "avo", {"avo_hourly-1.zip": zipped(a__csv="Timestamp,PM2.5 (ug/m3),Particle Count\n2025-01-01 00:00:00,7.5,2000\n", b__csv="DateTime,CO2\n2025-01-01 01:00:00,410\n")})
    assert [(r["pm25_conc"], r["pnc"], r["co2"]) for r in sorted(rows, key=lambda r: r["dtm"])] == [(7.5, 2.0, None), (None, None, 410.0)]
    rows, _ = read(spark, tmp_path / "c", "climate_index", {"mei.data": "1979 1979\n1979" + " 0.5" * 11 + " -999.00\n"})
    assert len(rows) == 11 and str(rows[0]["dtm"]) == "1979-01-01 00:00:00"
    rows, _ = read(spark, tmp_path / "m", "noaa_mbl", {"mbl.csv": "# note\n2001,1,7,370.5,0.1\n"})
    assert (str(rows[0]["dtm"]), rows[0]["value"]) == ("2001-01-07 00:00:00", 370.5)


def test_eaton_rejects_whole_files(spark, tmp_path):
    names = ["dtm", *EATON_TEXT, *EATON_DECIMAL, *EATON_WHOLE]
    good = ",".join(names) + "\n2026-01-01 05:00:00" + "," * 2 + ",1.5" * 3 + ",3" * 9 + ",\n"
    rows, errors = read(spark, tmp_path, "eaton", {"eaton-2026010105.csv": good, "eaton-2026010106.csv": good, "eaton-2026010107.csv": good.replace("05:00", "07:00").replace(",3,", ",3.5,", 1)})
    assert (rows[0]["battery_voltage"], rows[0]["f_active_alarms"], rows[0]["f_input_voltage"]) == (1.5, 1, 0)
    assert sorted(errors) == ["eaton-2026010106.csv", "eaton-2026010107.csv"]


def test_texts(spark, tmp_path):
    ames = "21 1001\nA\nB\nC\nD\n1 1\n2020 01 01 2021 01 01\n0\ndays\n2\n1 1\n9.99 99.9\nfirst\nsecond\n0\n5\na\nb\nc\nd\nstarttime o3 flag\n0.500000 9.99 1.5\n1.000000 2.5 99.9\n"
    rows, _ = read(spark, tmp_path / "n", "nasa_ames", {"x.nas": ames})
    assert sorted((str(r["dtm"]), r["variable"], r["value"]) for r in rows) == [("2020-01-01 12:00:00", "flag", 1.5), ("2020-01-01 12:00:00", "o3", None), ("2020-01-02 00:00:00", "flag", None), ("2020-01-02 00:00:00", "o3", 2.5)]
    ecc = "\n".join(["Date: x", "Sonde: 123", *["x"] * 8, "0 1 2 3 4 5 999999.000", "1 1 2 3 4 5 6", " ".join(["999999.000"] * 7), "9 9 9 9 9 9 9"])
    rows, _ = read(spark, tmp_path / "e", "ecc_asap", {"20230101.txt": ecc})
    assert [(r["time_s"], r["ecc_nbar"], r["sonde"], r["launch"]) for r in rows] == [(0.0, None, "123", "20230101"), (1.0, 6.0, "123", "20230101")]
    wdc = "# header\n# value:units : ppb\n# VARIABLE ORDER\n# x\nMKN 2020 1 2 3 4 5 2020 1 2 4 4 5 -999.999 1 5 0 0 0 0 0 x 1 1 a b c\n"
    rows, _ = read(spark, tmp_path / "w", "wdcgg", {"x_hourly.txt": wdc})
    assert (str(rows[0]["start"]), str(rows[0]["end"]), rows[0]["value"], rows[0]["nvalue"], rows[0]["unit"]) == ("2020-01-02 03:04:05", "2020-01-02 04:04:05", None, 5.0, "ppb")
    omi = "Station: x\nRead format (FORTRAN/IDL)\nx\nh\n20041001T110530123Z 1 2004 275 5 6 7 8 9 10 11 -90000 13 14 15 16 17 18 19\n"
    rows, _ = read(spark, tmp_path / "o", "omi", {"omi.txt": omi})
    assert (str(rows[0]["dtm"]), rows[0]["Ozone"], rows[0]["SOI"]) == ("2004-10-01 11:05:30", None, 19.0)
    dobson = "Dobson18\n12\n1\n2000\nNairobi\n\nDS\n000\nACA\nXA\n07:51:00\n1\n2\n3\n259.3\nXC\n07:51:00\n1\n2\n3\n263.7\nXA\n07:52:00\n1\n2\n3\n260.1\nXAD\n07:51:00\n1.199\n33.7\n260.1\ncomment hazy\n"
    rows, _ = read(spark, tmp_path / "d", "d018", {"D0122000.018": dobson})
    assert [(str(r["dtm"]), r["sequence"], r["mu"], r["sza"], r["XAD"], r["X1"], r["X3"], r["comments"]) for r in rows] == [("2000-01-12 07:51:00", "ACA", 1.199, 33.7, 260.1, 259.3, 260.1, "hazy")]
    shadoz = "6\nStation: Nairobi\nMissing or bad values: 9000\nx\nTime Press O3\nsec hPa mPa\n0 820.5 9000\n1 810.0 3.5\n"
    rows, _ = read(spark, tmp_path / "s", "shadoz", {"shadoz_x.zip": zipped(shadoz_20200101T08_x__dat=shadoz)})
    assert sorted((r["level"], r["value"]) for r in rows if r["variable"] == "O3") == [(0, None), (1, 3.5)] and str(rows[0]["dtm"]) == "2020-01-01 08:00:00"


def test_cpd2_archive(spark, tmp_path):
    text = "!note\nS11a,MKN,1,2020-01-01T00:00:00Z,F1,0007,1.5,2\nS11s,MKN,1,2020-01-01T00:00:00Z,2000\nX,1,2,3\n"
    b = io.BytesIO()
    with tarfile.open(fileobj=b, mode="w:gz") as t:
        info = tarfile.TarInfo("x/S11.dat")
        info.size = len(text)
        t.addfile(info, io.BytesIO(text.encode()))
    rows, _ = read(spark, tmp_path, "cpd2", {"cpd2.tar.gz": b.getvalue()})
    assert [(r["record"], r["F2_S11"], r["BsB_S11"]) for r in rows] == [("S11a", "0007", 1.5), ("S11s", "2000", None)]


def test_long_files_are_taken_apart_in_blocks(spark, monkeypatch):
    from aerolake.sources import files, formats

    monkeypatch.setattr(formats, "BLOCK", 2)
    text = "!note\n" + "".join(f"S11a,MKN,{i},2020-01-01T00:00:00Z,,0007,{i}.5, x ,nan,inf\n" if i % 2 else f"S11k,MKN,{i},2020-01-01T00:00:00Z,{i},\n" for i in range(5)) + "S11s,MKN,5,2020-01-01T00:00:00Z,\"7\n8\",9\nS11m,MKN,6,x\n"
    sizes, own = [], files._typed
    monkeypatch.setattr(files, "_typed", lambda rows, *a: sizes.append(len(rows)) or own(rows, *a))
    blocks = files._blocks(FORMATS["cpd2"], "p", "m", text.encode())
    assert sizes == [2, 2, 2, 1] and [i for b in blocks for i in b["ordinal"]] == list(range(7))
    table = spark.createDataFrame([("whole", bytearray(text.encode())), ("note", bytearray(b"!note\n"))], "path string, content binary")
    rows, errors = files.parse_files(table, replace(FORMATS["cpd2"], members=".*"))
    got = [(r.epoch, r.F1_S11, r.F2_S11, r.BsB_S11, r.BsG_S11, r.BsR_S11, r.BbsB_S11, r.P1_S11, r.n_fields) for r in rows.orderBy("ordinal").collect()]
    inf, nothing = float("inf"), (None,) * 7
    assert got[:5] == [(i, None, "0007", i + 0.5, None, None, inf, None, 10) if i % 2 else (i, *nothing[:6], float(i), 6) for i in range(5)]
    assert got[5:] == [(5, None, "7\n8", *nothing[:5], 6), (6, *nothing, 4)] and errors.count() == 0
    assert rows.columns == ["path", "member", "ordinal", *formats.CPD2_FORMAT_COLUMNS]
    assert [k for c, k in rows.dtypes if c in ("F1_S11", "BsB_S11", "P1_S11")] == ["string", "double", "double"]


def test_tahmo(spark, tmp_path):
    h = "measurement,device_sn,timestamp_utc,value,mrid,error_flag,units\n"
    body = "Air Temperature,D1,1700000000,20.5,1,false,°C\nAir Temperature,D1,1700000000,21.5,2,false,°C\nWind Speed,D1,1700000000,,2,true,m/s\nAir Temperature,D1,1700000300,22,3,true,°C\n"
    rows, errors = read_format(spark, str(_write(tmp_path, {"a.zip": zipped(a__csv=h + body), "b.csv": h + "Air Temperature,D1,1,2,3,false,K\n"})), FORMATS["tahmo"])
    assert errors.count() == 1
    got = [(r.temp, r.f_temp, r.temp_err, r.wind, r.f_wind, r.wind_err, r.mrid) for r in wide(rows, {"Air Temperature": "temp", "Wind Speed": "wind"}).orderBy("dtm").collect()]
    assert got == [(21.5, 0, 0, None, 1, 1, 2), (22.0, 1, 1, None, 1, None, 3)]
    assert conflicting_readings(rows).count() == 0
    clash = rows.unionByName(rows.filter("value = 21.5").withColumn("value", rows.value + 1))
    assert conflicting_readings(clash).count() == 1


def test_files_of_a_header_alone_have_no_rows(spark, tmp_path):
    h = "measurement,device_sn,timestamp_utc,value,mrid,error_flag,units\n"
    files = {"a.csv": h, "b.csv": h + "Air Temperature,D1,1700000000,20.5,1,false,°C\n", "c.csv": "x\n"}
    rows, errors = read(spark, tmp_path / "tahmo", "tahmo", files)
    assert [r["value"] for r in rows] == [20.5] and list(errors) == ["c.csv"] and "missing columns" in errors["c.csv"]
    rows, errors = read(spark, tmp_path / "fidas", "fidas", {"fidas.csv": "dtm,60,id\n", "fidas2.csv": "dtm,60,id\n2024-01-01 00:00:00,1,x\n"})
    assert [r["60"] for r in rows] == [1.0] and not errors


def test_a_file_that_fails_in_a_later_block_has_no_rows(spark, tmp_path, monkeypatch):
    from aerolake.sources import files, formats

    h = "measurement,device_sn,timestamp_utc,value,mrid,error_flag,units\n"
    line = "Air Temperature,D1,{},20.5,1,false,{}\n"
    monkeypatch.setattr(formats, "BLOCK", 2)
    good, bad = h + "".join(line.format(i, "°C") for i in range(5)), h + "".join(line.format(i, "K" if i == 4 else "°C") for i in range(5))
    assert [len(b) for b in files._blocks(FORMATS["tahmo"], "p", "m", good.encode())] == [2, 2, 1]
    with pytest.raises(ValueError, match="unit"):
        files._blocks(FORMATS["tahmo"], "p", "m", bad.encode())


def test_tahmo_query_without_readings(spark, tmp_path):
    """The first task writes a file of a header alone, as it does wherever it gets no reading."""
    from aerolake.plans import registry

    events = spark.createDataFrame([(1, 5, "view", 2.5, "{}")], "event_id long, user_id long, event_type string, value double, props string")
    events.selectExpr("*", "timestamp'2024-01-01 00:00:00' AS ts").write.parquet(str(tmp_path / "events.parquet"))
    assert registry.QUERIES["R10_tahmo_files"](spark, str(tmp_path)).collect() == []


def _write(folder, files):
    for n, c in files.items():
        (folder / n).write_bytes(c if isinstance(c, bytes) else c.encode())
    return folder


def test_calibrated_batch(spark, at):
    cal = spark.createDataFrame([("f", 1, at("2020-01-01 03:00:00"), 5.0)], "file string, line int, stamp timestamp, temp double")
    raw = lambda stamp, off: spark.createDataFrame([("f", 1, at(stamp), 77, off)], "file string, line int, stamp timestamp, rid long, offset string")
    r = calibrated_batch(cal, raw("2020-01-01 03:00:00", "UTC+03:00")).first()
    assert (str(r.dtm), r.mrid, r.temp) == ("2020-01-01 00:00:00", 77, 5.0)
    assert str(calibrated_batch(cal, raw("2020-01-01 03:00:00", ""), "UTC+00:00").first().dtm) == "2020-01-01 03:00:00"
    for bad in (raw("2020-01-01 03:00:01", "UTC+03:00"), raw("2020-01-01 03:00:00", "")):
        with pytest.raises(Exception, match="differ|offset"):
            calibrated_batch(cal, bad).collect()


def test_files_are_settled(spark, tmp_path):
    import json

    from aerolake.sources.files import settle_files

    src, archive, quarantine = (tmp_path / n for n in ("in", "archive", "bad"))
    src.mkdir()
    archive.mkdir()
    (archive / "hmp110-1.csv").write_text("older")
    _write(src, {"hmp110-1.csv": "2025-12-17 17:59:01,26.58,35.37\n", "fidas-1.csv": "60\n1\n", "other.txt": "x"})
    rows, errors = read_format(spark, str(src), FORMATS["hmp110"])
    bad_rows, bad = read_format(spark, str(src), FORMATS["fidas"])
    settle_files(spark, rows, errors, str(archive), str(quarantine))
    settle_files(spark, bad_rows, bad, str(archive), str(quarantine))
    assert sorted(p.name for p in src.iterdir() if not p.name.startswith(".")) == ["other.txt"]
    assert (archive / "1_hmp110-1.csv").exists() and (archive / "hmp110-1.csv").read_text() == "older"
    assert "no column dtm" in json.loads((quarantine / "fidas-1.csv.errors.json").read_text())[0]["error"]


def test_two_headers_and_avo_parquet(spark, tmp_path, at):
    from aerolake.sources.formats import avo_parquet, by_source, cpd2_table, CPD2_TABLES

    rows, errors = read(spark, tmp_path, "cleaned", {"clean_a.csv": "time,BC6,ssp1\n,ng/m3,1/Mm\n2024-01-01 00:00:00,5.5,\n", "clean_b.csv": "time,BC6\n2024-01-01 00:00:00,5.5\n"})
    assert [(r["BC6"], r["ssp1"]) for r in rows] == [(5.5, None)] and list(errors) == ["clean_b.csv"]
    old = spark.createDataFrame([(at("2024-01-01"), "s1", "7.5", 2.0, None, 1.0), (at("2024-01-02"), "s2", "x", None, None, None)], "`Timestamp` timestamp, Source string, `PM2.5 (ug/m3)` string, pnc double, co2 double, `slot.1` double")
    new = avo_parquet(old)
    assert sorted(new.columns) == ["dtm", "pm25_conc", "pnc", "source"]
    assert [(r.pm25_conc, r.pnc) for r in new.orderBy("dtm").collect()] == [(7.5, 2.0), (None, None)]
    assert {k: v.count() for k, v in by_source(new).items()} == {"s1": 1, "s2": 1}
    assert (len(CPD2_TABLES["S11k"]), len(CPD2_TABLES["S11m"]), len(CPD2_TABLES["A11a"])) == (74, 85, 44)
    one = spark.createDataFrame([("A11a", "MKN", 1, at("2024-01-01"), *[1.0] * 44)], "record string, station string, epoch long, dtm timestamp, " + ", ".join(f"{c} double" for c in CPD2_TABLES["A11a"]))
    assert cpd2_table(one, "A11a").columns[3:] == list(CPD2_TABLES["A11a"])


def test_tahmo_exports(spark, tmp_path):
    from aerolake.sources.tahmo import export_readings

    head = "D1\nlogger # Records: 2\n"
    cal = head + "Timestamps,degree_C Air Temperature,W/m2 Solar Radiation\n2020/01/01 03:00:00,20.5,\n2020/01/01 03:05:00,21,5\n"
    raw = lambda offset, second="2020/01/01 03:05:00": head + f"Timestamps,Device RID,UTC Offset,x\n2020/01/01 03:00:00,7,UTC+03:00,a\n{second},8,{offset},b\n"

    def of(name, **files):
        folder = tmp_path / name
        folder.mkdir()
        return read_format(spark, str(_write(folder, {"a.zip": zipped(**files)})), FORMATS["tahmo_export"])

    pair = {"z-Configuration 1-17__csv": cal, "z-Raw-Configuration 1-17__csv": raw("UTC+03:00")}
    rows, errors = of("ok", **pair)
    got = sorted((str(r.dtm), r.device_rid, r.measurement, r.value, r.flag) for r in export_readings(rows).collect())
    assert errors.count() == 0 and got == [
        ("2020-01-01 00:00:00", 7, "Air Temperature", 20.5, 0), ("2020-01-01 00:00:00", 7, "Solar Radiation", None, 1),
        ("2020-01-01 00:05:00", 8, "Air Temperature", 21.0, 0), ("2020-01-01 00:05:00", 8, "Solar Radiation", 5.0, 0),
    ]
    unset, _ = of("unset", **(pair | {"z-Raw-Configuration 1-17__csv": raw("Not Set")}))
    assert export_readings(unset, "UTC+03:00").count() == 4 and export_readings(unset, "UTC+03:00", start="2020-01-02").count() == 0
    apart, _ = of("apart", **(pair | {"z-Raw-Configuration 1-17__csv": raw("UTC+03:00", "2020/01/01 03:06:00")}))
    alone, _ = of("alone", **{"z-Configuration 1-17__csv": cal})
    for bad, offset, text in ((unset, None, "no UTC offset"), (apart, None, "differ"), (rows, "UTC+02:00", "another UTC offset"), (alone, None, "no UTC offset")):
        with pytest.raises(Exception, match=text):
            export_readings(bad, offset).collect()
    assert export_readings(alone, "UTC+03:00").count() == 4
    _, short = of("short", **{"z-Configuration 1-17__csv": cal.replace("Records: 2", "Records: 3")})
    assert "3 records claimed, 2 there" in short.first().error
