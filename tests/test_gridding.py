import numpy as np

from aerolake.operators import gridding
from aerolake.operators.gridding import missing_slots, regularize, ssa_impute


def frames(spark, at, readings, devices):
    r = spark.createDataFrame([(d, None if t is None else at(t), v, "clash") for d, t, v in readings], "device string, dtm timestamp, value double, slot string")
    return r, spark.createDataFrame(devices, "device string, cadence_s int, chunk string")


def test_grid(spark, at):
    nan = float("nan")
    readings = [("a", "2008-01-01 00:00:10", 1.0), ("a", "2008-01-01 00:00:50", 3.0), ("a", "2008-01-01 00:03:00", 5.0), ("a", "2008-01-01 00:03:00", 5.0), ("b", "2008-01-01 00:00:00", nan), ("c", "2008-01-01 00:00:00", 1.0), (None, "2008-01-01 00:00:00", 1.0), ("a", None, 1.0), ("d", "2008-01-01 00:00:00", 1.0)]
    r, dev = frames(spark, at, readings, [("a", 60, "x"), ("a", 90, "x"), ("b", 60, "x"), ("c", 0, "x"), ("e", 60, "x"), (None, 60, "x")])
    got = {(x.device, x.slot_epoch - 1199145600): (x.n, x.value, x.missing, x.filled) for x in regularize(r, dev).collect()}
    assert got == {("a", 0): (2, 2.0, False, False), ("a", 60): (0, 3.0, True, True), ("a", 120): (0, 4.0, True, True), ("a", 180): (2, 5.0, False, False), ("b", 0): (1, None, False, False)}
    r, dev = frames(spark, at, [], [])
    assert regularize(r, dev).count() == 0


def test_chunks_cover_the_series(spark, at, monkeypatch):
    r, dev = frames(spark, at, [("a", "2008-01-01 00:00:00", 1.0), ("a", "2008-01-01 05:00:00", 1.0)], [("a", 60, "x")])
    monkeypatch.setattr(gridding, "SLOTS", 64)
    got = regularize(r, dev).collect()
    assert sorted(x.slot_epoch for x in got) == [1199145600 + 60 * i for i in range(301)]
    assert sum(x.missing for x in got) == 299


def test_imputation_beats_interpolation():
    t = np.arange(2000)
    clean = 10 + np.sin(t / 7) + 0.5 * np.sin(t / 23)
    x = clean + np.random.default_rng(0).normal(0, 0.02, len(t))
    for at_ in range(100, 1900, 150):
        x[at_ : at_ + 12] = np.nan
    gaps = np.isnan(x)
    filled, done = ssa_impute(x)
    linear = np.interp(t, t[~gaps], x[~gaps])
    assert (done == gaps).all() and not np.isnan(filled).any()
    assert np.abs(filled - clean)[gaps].mean() < 0.5 * np.abs(linear - clean)[gaps].mean()
    short, done = ssa_impute(np.array([1.0, np.nan, 2.0]))
    assert short[1] == 1.5 and done.tolist() == [False, True, False]
    few, done = ssa_impute(np.r_[np.nan, np.sin(np.arange(20) / 3), np.nan])
    assert done.sum() == 2 and np.isfinite(few).all()
    none, done = ssa_impute(np.full(5, np.nan))
    assert np.isnan(none).all() and not done.any()
    flat = np.r_[np.ones(100), np.nan, np.ones(100)]
    assert ssa_impute(flat)[0][100] == 1


def test_usable_readings(spark, at):
    ae33 = spark.createDataFrame([("x", at("2008-01-01 00:00:00"), 5), ("x", at("2008-01-01 00:01:00"), None), ("x", at("2008-01-01 00:02:00"), 6)], "inst_sn string, dtm timestamp, bc6 long")
    avo = spark.createDataFrame(
        [(1, "y", "avo", at("2008-01-01 00:00:00"), 1.0, None, None, None, None, None), (2, "y", "avo", at("2008-01-01 00:01:00"), None, None, None, None, "ug/m3", None), (3, "y", "avo", at("2008-01-01 00:02:00"), None, None, None, "unreadable", None, None)],
        "reading_id long, source string, instrument string, dtm timestamp, pm25_conc double, ir880 double, bc6 double, value_text string, unit string, note string",
    )
    dev = spark.createDataFrame([("x", 60), ("y", 60)], "device string, cadence_s int")
    assert {tuple(r) for r in missing_slots(ae33, avo, dev).collect()} == {("x", 1199145660), ("y", 1199145660)}


def test_chunks_are_filled_from_their_neighbours(spark):
    # the last chunk has ten slots, one of them missing; another gap lies at the border
    first, last = 10 * gridding.SLOTS - 300, 10 * gridding.SLOTS + 9
    gaps = {10 * gridding.SLOTS - 1, 10 * gridding.SLOTS, last - 3}
    rows = [("a", 60 * i, float(np.sin(i / 7))) for i in range(first, last + 1) if i not in gaps]
    r = spark.createDataFrame(rows, "device string, s long, value double").selectExpr("device", "timestamp_seconds(s) AS dtm", "value")
    got = {x.slot_epoch // 60: x for x in regularize(r, spark.createDataFrame([("a", 60)], "device string, cadence_s int")).collect()}
    assert sorted(got) == list(range(first, last + 1))
    assert {i for i, x in got.items() if x.missing} == gaps == {i for i, x in got.items() if x.filled}
    assert all(abs(got[i].value - np.sin(i / 7)) < 0.05 for i in gaps)
