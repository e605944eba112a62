from aerolake.operators import drift
from aerolake.operators.drift import compare, schema_changes, unify_files

SCHEMA = "file_id long, device string, period_start timestamp, header string, body string, n_records int, names string, chunk string"


def frame(spark, at, rows):
    return spark.createDataFrame([(i, d, None if t is None else at(t), h, b, 1, "clash", "clash") for i, d, t, h, b in rows], SCHEMA)


def body(*rows):
    return "\n".join(rows)


def test_changes(spark, at):
    rows = [
        (1, "a", "2008-01-01", "dtm,o3,cellai,cellbi", body("2008-01-01 00:00:00,40.1,72010,71003", "2008-01-01 00:01:00,40.9,71950,71100")),
        (5, "a", "2008-01-02", " DTM ,Ozone,cellbi,cellai,hio3", body("2008-01-02 00:00:00,40.5,71050,72000,", "2008-01-02 00:01:00,41.0,71010,71940,")),
        (2, "a", "2008-01-03", "dtm,ozone,intb,hio3", body("2008-01-03 00:00:00,40.0 ppb,71020,", "2008-01-03 00:01:00,40.7 ppb,71060,")),
        (3, "a", "2008-01-04", "dtm,ozone,intb,hio3", body("2008-01-04 00:00:00,,71020,0.4", "2008-01-04 00:01:00,,71060,0.5")),
        (4, "a", "2008-01-05", "dtm,o3,intb,hio3", body("2008-01-05 00:00:00,40.6,71020,0.4", "2008-01-05 00:01:00,40.2,71060,0.5")),
        (6, "b", "2008-01-01", "pcdate,pctime,o3", body("2008-01-01,00:00:00,1.5")),
        (7, "b", "2008-01-02", "dtm,o3", body("2008-01-02 00:00:00,1.5")),
        (8, "b", "2008-01-03", "time_utc,o3", body("2 Jan 2008 00:00:00,1.5")),
        (9, None, "2008-01-03", "dtm", ""),
        (10, None, "2008-01-04", "dtm,dtm,x", "\n"),
        (11, "c", None, "dtm", "x"),
        (12, "c", "2008-01-01", None, "x"),
        (13, "c", "2008-01-02", "dtm,o3", None),
    ]
    got = {(r.file_id, r.change, r.column_name) for r in schema_changes(frame(spark, at, rows)).collect()}
    assert got == {
        (5, "renamed", "ozone"), (5, "added", "hio3"),
        (2, "renamed", "intb"), (2, "removed", "cellai"), (2, "retyped", "ozone"),
        (4, "renamed", "o3"), (4, "retyped", "o3"),
        (7, "added", "dtm"), (7, "removed", "pcdate"), (7, "removed", "pctime"),
        (8, "renamed", "time_utc"), (8, "retyped", "time_utc"),
        (10, "added", "x"),
    }
    assert schema_changes(frame(spark, at, [])).count() == 0


def test_empty_column_keeps_its_class():
    number = {"name": "x", "cls": "decimal", "kind": "number", "mean": 1.0, "std": 0.1, "shape": "9.9", "suffix": ""}
    changes, state = compare({"x": number}, {"x": None})
    assert changes == [] and state["x"] is number
    changes, _ = compare(state, {"x": number | {"cls": "whole"}})
    assert changes == [("retyped", "x", "decimal to whole")]


def test_one_table(spark, at):
    rows = [
        (1, "a", "2008-01-01", "dtm,o3,flags", body("2008-01-01 00:00:00,40.1,F", "2008-01-01 00:01:00,40.9,F")),
        (2, "a", "2008-01-02", "datetime,ozone,flags,extra", body("1199232000,40.5 ppb,F,1", "1199232060,bad x y,F,1", "1199232120,40.2 ppb,F,1")),
        (3, "b", "2008-01-02", "pcdate,pctime,o3", body("20080103,00:05:00,3.5")),
    ]
    table, report = unify_files(frame(spark, at, rows))
    got = {(r.file_id, r.line_no): (str(r.dtm), r.o3, r.flags) for r in table.collect()}
    assert got == {(1, 0): ("2008-01-01 00:00:00", 40.1, "F"), (1, 1): ("2008-01-01 00:01:00", 40.9, "F"), (2, 0): ("2008-01-02 00:00:00", 40.5, "F"), (2, 1): ("2008-01-02 00:01:00", None, "F"), (2, 2): ("2008-01-02 00:02:00", 40.2, "F"), (3, 0): ("2008-01-03 00:05:00", 3.5, None)}
    assert [(r.file_id, r.column_name, r.quantity, r.failed) for r in report.collect()] == [(2, "ozone", "o3", 1)]


def test_chunks_change_nothing(spark, at, monkeypatch):
    names = ["o3", "ozone", "o3_ppb"]
    rows = [(i, "a", f"2008-{1 + i // 28:02d}-{1 + i % 28:02d}", f"dtm,{names[(i // 7) % 3]},v" + (",extra" if i % 11 == 0 else ""), body(f"2008-01-01 00:00:00,{40 + i % 3}.5,{i % 5}" + (",x" if i % 11 == 0 else ""))) for i in range(300)]
    df = frame(spark, at, rows)
    whole = sorted(map(str, schema_changes(df).collect()))
    monkeypatch.setattr(drift, "CHUNK", 20)
    assert sorted(map(str, schema_changes(df).collect())) == whole and len(whole) > 50


def test_entries_of_one_shape_are_judged_each(spark, at):
    word = "x" * 40
    first = ["0C100400,12 Jan 2008,20080101,1.5 ppb," + word + "1"] * 3
    later = ["0E100400,12 Foo 2008,20081301,1.5 abc," + word + "1"] + ["1C000000,12 Jan 2008,20080102,1.5 ppb," + word + "1"] * 3
    rows = [(1, "a", "2008-01-01", "flags,day,number,o3,long", body(*first)), (2, "a", "2008-01-02", "flags,day,number,o3,long", body(*later))]
    stats = {(r.file_id, r["name"]): r for r in drift.path_statistics(frame(spark, at, rows)).collect()}
    assert (stats[2, "flags"].c_decimal, stats[2, "flags"].c_text) == (1, 3)
    assert (stats[2, "day"].k_date, stats[2, "day"].k_text) == (3, 1)
    assert (stats[2, "number"].k_date, stats[2, "number"].k_number) == (3, 1)
    assert stats[2, "o3"].suffix == "ppb"
    assert schema_changes(frame(spark, at, rows)).count() == 0
