import math

import pytest
from pyspark.sql import functions as F

from aerolake.functions import numeric, timeparse
from aerolake.operators import aggregate, availability, columns, flags, joins, merge, profiles, stats, validity, windows
from aerolake.operators.buckets import bucket, period

L2 = [("00:00:00", 10.0, 0), ("00:20:00", 30.0, None), ("00:40:00", 90.0, 1), ("01:00:00", 100.0, 0), ("2", 50.0, 0), ("3", 70.0, 0), ("4", None, 0)]


def level1(spark, at):
    when = {"2": "2026-01-02 00:00:00", "3": "2026-02-01 00:00:00", "4": "2026-02-01 00:20:00"}
    return spark.createDataFrame([(at(when.get(t, f"2026-01-01 {t}")), v, f) for t, v, f in L2], "dtm timestamp, o3 double, f_o3 tinyint")


def test_level2_directly_from_level1(spark, at):
    df = level1(spark, at)
    by = {e: {str(r.dtm): (r.O3, r.n_O3) for r in aggregate.level2(df, aggregate.Level2(["O3"]), e).collect()} for e in ("hourly", "1d", "1mo")}
    assert by["hourly"]["2026-01-01 00:00:00"] == (20.0, 2)
    assert by["1d"]["2026-01-01 00:00:00"] == (pytest.approx(140 / 3), 3)
    assert by["1mo"] == {"2026-01-01 00:00:00": (47.5, 4), "2026-02-01 00:00:00": (70.0, 1)}
    strict = aggregate.level2(df, aggregate.Level2(["O3"], accept_null_flag=False), "1h").filter(F.col("dtm") == at("2026-01-01 00:00:00")).first()
    assert (strict.O3, strict.n_O3) == (10.0, 1)


def test_level2_without_valid_values(spark, at):
    df = spark.createDataFrame([(at("2026-01-01 00:00:00"), 5.0, 1), (None, 5.0, 0)], "dtm timestamp, O3 double, f_O3 int")
    rows = aggregate.level2(df, aggregate.Level2(["O3", "absent"], default="sum", accept_null_flag=False), "1h").collect()
    assert [(r.O3, r.n_O3) for r in rows] == [(None, 0)]
    plain = spark.createDataFrame([(at("2026-01-01"), 1.0), (at("2026-01-01"), None), (at("2026-01-01"), 3.0), (at("2026-01-01"), float("nan"))], "dtm timestamp, O3 double")
    assert [(r.O3, r.n_O3) for r in aggregate.level2(plain, aggregate.Level2(["o3"]), "1h").select(F.col("o3").alias("O3"), F.col("n_o3").alias("n_O3")).collect()] == [(2.0, 2)]
    with pytest.raises(ValueError):
        aggregate.aggregate_of("mode", F.col("x"), F.col("t"))


def test_windows_closed_and_labelled(spark, at):
    df = spark.createDataFrame([(at("2026-01-01 01:00:00"), 1.0), (at("2026-01-01 01:30:00"), 3.0)], "dtm timestamp, x double")
    got = {c: sorted((str(r.dtm)[11:13], r.x) for r in aggregate.level2(df, aggregate.Level2(["x"], closed=c), "1h").collect()) for c in ("left", "right", "both", "none")}
    assert got == {"left": [("01", 2.0)], "right": [("00", 1.0), ("01", 3.0)], "both": [("00", 1.0), ("01", 2.0)], "none": [("01", 3.0)]}
    assert str(aggregate.level2(df, aggregate.Level2(["x"], label="right"), "1mo").first().dtm) == "2026-02-01 00:00:00"
    assert period("10min") == ("fixed", 600) and period("monthly") == ("month", 1)
    for bad in ("", "0h", "2mo", "x"):
        with pytest.raises(ValueError):
            period(bad)
    week = df.select(bucket(F.col("dtm"), "1w").alias("w")).first()
    assert str(week.w) == "2025-12-29 00:00:00"


def test_operation_flags(spark, at):
    states = [(0, 0), (1, 1), (2, 4), (3, 0), (13, 0), (14, 0), (15, 6)]
    df = spark.createDataFrame([(at(f"2026-01-01 00:{m:02d}:00"), s, 0) for m, s in states], "dtm timestamp, state int, k int")
    out = flags.auto_flag_ne300(df, "state", ["1"], ["k"], ["dtm"]).orderBy("dtm")
    assert [r.f_1 for r in out.collect()] == [0, 2, 5, 2, 2, 0, 6]
    mapped = spark.createDataFrame([(i,) for i in [*range(8), None]], "s int").select(flags.ne300_flag(F.col("s")).alias("f"))
    assert [r.f for r in mapped.collect()] == [0, 2, 2, 3, 5, 4, 6, None, None]
    with pytest.raises(Exception, match="negative"):
        spark.createDataFrame([(-1,)], "s int").select(flags.ne300_flag(F.col("s"))).collect()


def test_valve_flags(spark):
    df = spark.createDataFrame([(0, 1.0, 1), (1, 1.0, None), (2, 1.0, 0), (7, 1.0, 3), (None, 1.0, None), (-1, 1.0, 3)], "solenoid_valves int, CO2 double, f_CO2 tinyint")
    assert [r.f_CO2 for r in flags.auto_flag_g2401(df).collect()] == [1, 4, 0, 3, None, 3]
    assert [r.f_CO2 for r in flags.auto_flag_g2401(df, overwrite=True).collect()] == [0, 4, 2, 2, None, 3]


def test_linked_flags(spark):
    groups = columns.linked_groups({"g": ["BC1", "b1_abs"]})
    assert columns.linked_flags("BC1", groups, ["BC1", "b1_abs", "o3"]) == ["f_BC1", "f_b1_abs"] and columns.linked_flags("o3", groups, ["o3"]) == ["f_o3"]
    for bad in ({"g": ["a"]}, {"g": ["a", "b"], "h": ["b", "c"]}):
        with pytest.raises(ValueError):
            columns.linked_groups(bad)
    df = spark.createDataFrame([(2, None), (None, 1), (None, None)], "f_a tinyint, f_c tinyint")
    once = flags.reconcile(df, ["f_a", "f_b", "f_c"])
    assert [(r.f_a, r.f_b, r.f_c) for r in once.collect()] == [(2, 2, 2), (1, 1, 1), (None, None, None)]
    assert flags.reconcile(once, ["f_a", "f_b", "f_c"]).collect() == once.collect()
    with pytest.raises(Exception, match="differ"):
        flags.reconcile(spark.createDataFrame([(1, 2)], "f_a tinyint, f_c tinyint"), ["f_a", "f_c"]).collect()


def test_duplicates(spark, at):
    t1, t2 = at("2026-01-01 00:00:00"), at("2026-01-01 00:01:00")
    rows = [(t1, 1.0, 1, "a", 1), (t1, 1.0, 1, "a", 2), (t2, 2.0, None, None, 3), (t2, None, 3, "b", 4), (None, 9.0, 9, "z", 5), (None, 9.0, 9, "z", 6)]
    df = spark.createDataFrame(rows, "dtm timestamp, value double, flag int, note string, i int")
    kinds = {r.dtm: r.kind for r in merge.classify_duplicates(df.drop("i")).collect()}
    assert sorted(kinds.values()) == ["exact", "mergeable"]
    once = merge.resolve_duplicates(df, ["i"])
    assert once.count() == 4 and (once.filter("i = 3").first().value, once.filter("i = 3").first().flag, once.filter("i = 3").first().note) == (2.0, 3, "b")
    assert sorted(map(str, merge.resolve_duplicates(once, ["i"]).collect())) == sorted(map(str, once.collect()))
    clash = spark.createDataFrame([(t1, 1.0, 5.0, 1), (t1, 2.0, None, 2)], "dtm timestamp, value double, aux double, i int")
    assert merge.classify_duplicates(clash.drop("i")).first().conflicting_columns == "value"
    assert merge.resolve_duplicates(clash, ["i"]).count() == 2
    chosen = merge.resolve_duplicates(clash, ["i"], base=F.col("i") == 2).collect()
    assert [(r.value, r.aux) for r in chosen] == [(2.0, 5.0)]


def test_unions_and_merges(spark):
    a, b = spark.createDataFrame([(1, 2)], "k int, x int"), spark.createDataFrame([(2, "7.5", 1.0)], "k bigint, X string, y float")
    out = merge.relaxed_union(a, b)
    assert dict(out.dtypes) == {"k": "bigint", "x": "string", "y": "float"} and [tuple(r) for r in out.orderBy("k").collect()] == [(1, "2", None), (2, "7.5", 1.0)]
    old = spark.createDataFrame([(1, 5.0, 3), (2, None, 1)], "k int, v double, mrid int")
    new = spark.createDataFrame([(1, 6.0, 3), (2, 7.0, 2), (3, 8.0, None)], "k int, v double, mrid int")
    assert [r.v for r in merge.merge_keyed(old, new, ["k"], "existing", "mrid").orderBy("k").collect()] == [5.0, 7.0, 8.0]
    assert [r.v for r in merge.merge_keyed(old, new, ["k"]).orderBy("k").collect()] == [5.0, None, 8.0]
    e = spark.createDataFrame([(1, 5.0, 0), (2, None, None)], "k int, v double, f_v int")
    n = spark.createDataFrame([(1, 6.0, 1), (2, 7.0, 1), (3, 8.0, 1)], "k int, v double, f_v int")
    assert [tuple(r) for r in merge.backfill(e, n, ["k"]).orderBy("k").collect()] == [(1, 5.0, 0, False, 0, 0), (2, 7.0, None, False, 1, 0), (3, 8.0, 1, True, 0, 0)]
    assert merge.backfill(e, n, ["k"], replace_values=True).filter("k = 1").first().v == 6.0
    assert dict(merge.simplify_types(spark.createDataFrame([(1, 2.0, 3)], "a bigint, b double, termin bigint")).dtypes) == {"a": "int", "b": "float", "termin": "bigint"}


def test_drifting_files_in_one_scan(spark, tmp_path):
    spark.createDataFrame([(1, 1.5)], "k int, x float").write.parquet(str(tmp_path / "a"))
    spark.createDataFrame([(2, 2.5, "n")], "k bigint, x double, note string").write.parquet(str(tmp_path / "b"))
    out = merge.relaxed_scan(spark, [str(tmp_path / "a"), str(tmp_path / "b")])
    assert dict(out.dtypes) == {"k": "bigint", "x": "double", "note": "string"} and out.count() == 2


def test_names(spark):
    cols = ["dtm", "PM2.5 (ug/m3)", "f_PM2.5 (ug/m3)", "O3", "f_o3"]
    assert columns.resolve("o3", cols) == "O3" and columns.resolve("x", cols) is None
    assert columns.resolve_flag("O3", cols) == "f_o3" and columns.resolve_flag("O3", cols, mode="none") is None
    with pytest.raises(ValueError):
        columns.resolve_flag("x", cols, mode="required")
    assert columns.discover(["pm25"], cols) == "PM2.5 (ug/m3)" and columns.discover(["so2"], cols) is None
    df = spark.createDataFrame([(None, None)], "a timestamp, b timestamp")
    with pytest.raises(ValueError):
        columns.find_time_column(df)
    assert columns.find_time_column(df.withColumnRenamed("a", "DTM")) == "DTM"


def test_physics(spark):
    one = spark.range(1)
    v = lambda c: one.select(c.alias("x")).first().x
    assert v(numeric.absorption(F.lit(1000.0), 7.77)) == pytest.approx(7.77 / 1.76)
    with pytest.raises(ValueError):
        numeric.absorption(F.lit(1.0), 1.0, 0)
    assert v(numeric.reporting_condition(F.lit(10.0), F.lit(0.0), F.lit(1.0), 1013.25, 20)) is None
    assert v(numeric.reporting_condition(F.lit(10.0), F.lit(1013.25), F.lit(20.0), 1013.25, 20)) == pytest.approx(10)
    assert v(numeric.condition_state(F.lit(float("nan")), F.lit(1.0), 1000, 0)) == "invalid"
    assert v(numeric.angstrom_exponent(F.lit(2.0), F.lit(1.0), 370, 950)) == pytest.approx(-math.log(2) / math.log(370 / 950))
    assert v(numeric.nearest_hex(F.lit("0x2000"))) == 8192 and v(numeric.nearest_hex(F.lit("zz"))) is None
    assert v(profiles.pump_corrected(F.lit(2.0), F.lit(1.0))) == pytest.approx(2.48)


def test_time_functions(spark, at):
    v = lambda c: spark.range(1).select(c.alias("x")).first().x
    assert str(v(timeparse.parse_timestamp(F.lit("20-oct-24 05:06")))) == "2024-10-20 05:06:00"
    assert v(timeparse.parse_timestamp(F.lit("nonsense"))) is None
    assert str(v(timeparse.parse_timestamp(F.lit("01/02/2024 01:00:00 PM")))) == "2024-01-02 13:00:00"
    assert v(timeparse.offset_to_utc(F.lit(at("2020-01-01")), F.lit("UTC+15:00"))) is None
    assert timeparse.cadence_seconds("5min") == 300 and timeparse.month_days_of_year(2024, 2) == (32, 60)
    assert v(timeparse.decimal_year(F.lit(at("2024-07-02")))) == pytest.approx(2024.5)
    assert str(v(timeparse.file_name_date(F.lit("a/ne300-202407161200.dat")))) == "2024-07-16" and str(v(timeparse.file_name_date(F.lit("D0122000.018")))) == "2000-01-12"


def test_expected_slots(spark, at):
    df = spark.createDataFrame([(at(f"2026-08-01 00:0{m}:00"),) for m in (0, 1, 2, 3, 4, 4, 4)], "dtm timestamp")
    r = availability.availability(df, "dtm", F.lit(at("2026-08-01")), F.lit(at("2026-08-01 00:04:00")), 60).first()
    assert (r.observed, r.expected, r.percent) == (5, 5, 100.0)


def test_windows_and_profiles(spark, at):
    df = spark.createDataFrame([("a", i, v, t) for i, (v, t) in enumerate([(100.0, 1), (50.0, 1), (None, None), (50.0, 1), (80.0, 2), (40.0, 2)])], "k string, i int, v double, tape int").withColumn("ref", F.lit(100.0))
    atn = [(r.i, None if r.atn is None else round(r.atn, 3)) for r in windows.attenuation(df, ["k"], ["i"], "v", "ref", "tape").orderBy("i").collect()]
    ln2 = round(100 * math.log(2), 3)
    assert atn == [(0, 0.0), (1, ln2), (2, None), (3, ln2), (4, 0.0), (5, ln2)]
    state = spark.createDataFrame([("a", 1, 10.0)], "k string, tape int, baseline double")
    assert round(windows.attenuation(df, ["k"], ["i"], "v", "ref", "tape", carried=state).filter("i = 0").first().atn, 3) == -10.0
    t = [at("2020-01-01 00:00:00"), at("2020-01-02 01:00:00"), at("2020-01-02 02:00:00")]
    fixed = windows.repair_meter_clock(spark.createDataFrame([("m", i, x) for i, x in enumerate(t)], "k string, i int, t timestamp"), ["k"], "t", "i").orderBy("i").collect()
    assert str(fixed[1].t) == "2020-01-01 13:00:00"
    x = spark.createDataFrame([("a", i, float(v)) for i, v in enumerate([0, 0, 4, 0, 0])], "k string, i int, v double").withColumn("t", F.timestamp_seconds("i"))
    assert [r.smooth for r in windows.smooth_kernel(x, ["k"], "t", "i", "v", 1).orderBy("i").collect()] == [0, 1, 2, 1, 0]


def test_curve_fit_finds_trend_and_season(spark):
    rows = [("s", 2000 + i / 365.25, 350 + 2 * (i / 365.25) + 3 * math.sin(2 * math.pi * i / 365.25)) for i in range(0, 365 * 8)]
    fit = profiles.fit_series(spark.createDataFrame(rows, "k string, t double, v double"), ["k"], "t", "v")
    mid = fit.filter("time between 2003 and 2005").agg(F.avg("growth").alias("g"), F.max("seasonal").alias("s")).first()
    assert mid.g == pytest.approx(2, abs=0.05) and mid.s == pytest.approx(3, abs=0.1)
    years = profiles.seasonal_extremes(fit, ["k"]).filter("year between 2001 and 2006").collect()
    assert all(y.amplitude == pytest.approx(6, abs=0.3) for y in years)
    few = spark.createDataFrame([("s", 2000.0, 1.0)], "k string, t double, v double")
    assert profiles.fit_series(few, ["k"], "t", "v").count() == 0
    log = profiles.interpolate_log(spark.createDataFrame([("p", 1.0, 0.0), ("p", math.e, 1.0), ("p", math.e**2, 4.0)], "k string, x double, y double"), ["k"], "x", "y", [1.0, math.e, 100.0], "cubic").collect()
    assert [None if r.y is None else round(r.y, 6) for r in log] == [0.0, 1.0, None]


def test_statistics(spark):
    df = spark.createDataFrame([("g", float(i), 2.0 * i + 1) for i in range(10)], "k string, x double, y double")
    r = stats.regression(df, "x", "y", ["k"]).withColumn("p", stats.student_p(F.col("r"), F.col("n"))).first()
    assert (r.n, round(r.slope, 9), round(r.intercept, 9), round(r.r2, 9)) == (10, 2.0, 1.0, 1.0) and r.p == pytest.approx(0, abs=1e-6)
    p = spark.createDataFrame([(0.5, 20)], "r double, n long").select(stats.student_p(F.col("r"), F.col("n")).alias("p")).first().p
    assert p == pytest.approx(0.02477, abs=2e-4)
    o = stats.weighted_orthogonal_regression(df.withColumn("s", F.lit(0.5)), "x", "y", "s", ["k"]).first()
    assert (round(o.slope, 6), round(o.intercept, 6)) == (2.0, 1.0)
    best = stats.best_grid_point(spark.createDataFrame([(i, lat, 0.0, (1.0 if lat else -1.0) * i) for i in range(5) for lat in (0.0, 1.0)], "t int, lat double, lon double, v double"), spark.createDataFrame([(i, float(i)) for i in range(5)], "t int, ref double"), "t", "v", "ref").first()
    assert (best.lat, best.rho) == (1.0, 1.0)


def test_joins_and_predicates(spark, at):
    fine = spark.createDataFrame([(at(f"2026-01-01 {h:02d}:00:00"), float(h)) for h in range(5)], "t timestamp, v double")
    coarse = spark.createDataFrame([(at("2026-01-01 00:00:00"), 0.0), (at("2026-01-01 04:00:00"), 8.0)], "t timestamp, b double")
    assert [r.delta for r in joins.over_background(fine, coarse, "t", "v", "b").orderBy("t").collect()] == [0, -1, -2, -3, -4]
    assert joins.fill_gaps(fine.filter("v in (0, 3)"), "t", "1 HOUR").count() == 4
    df = spark.createDataFrame([(1.0, 1), (2.0, None), (float("nan"), 0), (None, 0)], "v double, f int")
    assert [r.x for r in df.select(validity.only_valid(F.col("v"), F.col("f")).alias("x")).collect()] == [None, 2.0, None, None]
    assert [r.x for r in df.select(validity.mask_negative(F.col("v") - 1.5).alias("x")).collect()] == [None, 0.5, None, None]
    text = spark.createDataFrame([(1.0, "bad")], "v double, f string").select(validity.valid(F.col("v"), F.col("f")).alias("x")).first().x
    assert text is False


def whole_query(name, spark, tmp_path, table, rows, schema):
    """The rows of a registered query over one small table."""
    from aerolake.plans import registry

    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / f"{table}.parquet"))
    return registry.QUERIES[name](spark, str(tmp_path)).collect()


EVENTS = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"


def test_decimal_year_of_every_event(spark, at, tmp_path):
    parts = ["00", "05", "25", "45", "55", "75", "999999"]  # in both halves of a second; the old query left out most
    times = [at(f"{y}-12-31 23:59:{s:02d}.{f:0<6}") for y in (2023, 2024) for s in (0, 58, 59) for f in parts]
    rows = [(i, t, 1, "view", 1.0, '{"k": 1}') for i, t in enumerate(times)]
    got = {r.event_id: r.back for r in whole_query("F09_decimal_year_whole", spark, tmp_path, "events", rows, EVENTS)}
    assert got == {i: int(t.timestamp()) + (t.microsecond > 500_000) for i, t in enumerate(times)}


def test_pump_integral_and_residual_over_all_pressures(spark, at, tmp_path):
    pressures = [1.0, 3.0, 5.0, 7.0, 10.0, 15.0, 20.0, 30.0, 50.0, 70.0, 100.0, 150.0, 200.0, 1000.0, 2000.0]
    rows = [(i, at("2024-01-01 00:00:00"), 7, "view", p - 1, '{"k": 2}') for i, p in enumerate(pressures)]
    got = {r.event_id: r.corrected for r in whole_query("M12_pump_whole", spark, tmp_path, "events", rows, EVENTS)}
    factors = [1.24, 1.24, 1.124, 1.087, 1.066, 1.048, 1.041, 1.029, 1.018, 1.013, 1.007, 1.002, 1, 1, 1]
    assert got == {i: pytest.approx(2 * f) for i, f in enumerate(factors)}

    from aerolake.plans import registry

    integral, = registry.QUERIES["M12_integral"](spark, str(tmp_path)).collect()
    assert tuple(integral) == (7, pytest.approx(0.79 * 2 * math.log(2000), abs=1e-4))
    residual, = registry.QUERIES["M12_residual"](spark, str(tmp_path)).collect()
    assert tuple(residual) == (7, pytest.approx(0.79 * 2, abs=1e-4))  # 3 hPa and a millionth lie outside the top 2 hPa


def test_tolerant_cast_of_every_line(spark, tmp_path):
    cells = {"10.2": 10.2, "": None, "ERR": None, "#N/A": None, "1114E-2": 11.14, "-3.5": -3.5, "+31": 31.0, "+-31": None, " 3.1 ": 3.1, "2.6.1": None, "2261E": None, "0x1F": None, "1 2.5": None}
    rows = [(i, f"00:00,01-01-08,0C100000,{c},1") for i, c in enumerate(cells)] + [(98, "cut,off"), (99, None)]
    got = {r.line_id: r.x for r in whole_query("C02_tolerant_cast_whole", spark, tmp_path, "thermo_lines", rows, "line_id long, line string")}
    assert got == dict(enumerate(cells.values())) | {98: None, 99: None}


def test_submission_lines_of_every_event(spark, at, tmp_path):
    from aerolake.sources.sinks import wdcgg_lines

    rows = [(i, at(f"2024-01-01 00:0{i}:00"), 1, "view", None if i == 4 else i + 0.5, '{"k": 90}') for i in range(6)]
    got = [r.line for r in whole_query("K08_submission_lines", spark, tmp_path, "events", rows, EVENTS)]
    spot = "-0.0621999986 37.2971992493 3688 3678"
    g = lambda i, k: "-99.9" if i == 4 else f"{(i + 0.5) * k:g}"
    assert sorted(got) == [f"MKN 2024 1 1 0 {i} 0 0 {g(i, 1 / 7)} -99.9 {g(i, 1e4)} {g(i, 1e-6)} -99.9 {g(i, -1)} {spot}" for i in range(6)]
    df = spark.createDataFrame([(at("2024-01-01"), 187, 1.0), (at("2024-01-02"), 999, 2.0), (at("2024-01-03"), None, 3.0)], "dtm timestamp, iii int, v double")
    assert [r.line for r in wdcgg_lines(df, "dtm", "iii", {"v": "wind_speed"}).collect()] == [f"MKN 2024 1 1 0 0 0 1 {spot}"]  # no unmapped station


def test_chunks_hold_their_neighbours(spark):
    import random

    from aerolake.operators.chunks import chunked

    rng = random.Random(3)
    rows, us = [], 0
    for i in range(3000):
        us += rng.choice([0, 0, 1, 1, 1, 2, 400])  # buckets of one row and of many
        us += 0 if 1000 < i < 1150 else 1  # and a giant one
        rows.append((i, us * 1_000_000, "k" if i % 11 else None))
    df = spark.createDataFrame(rows, "i long, us long, key string")
    for size, halo in ((40, 10), (100, 3), (12, 9)):  # the second way, and the one for chunks that are short against the halo
        got = chunked(df, ["key"], "us", size, halo, bucket_s=3).toPandas()
        assert len(got[got.core]) == 3000 and got[got.core].i.is_unique
        for _, series in got.groupby("key", dropna=False):
            order = series[series.core].sort_values(["us", "i"]).i.tolist()
            place = {x: n for n, x in enumerate(order)}
            for _, chunk in series.groupby("chunk"):
                core = sorted(place[x] for x in chunk.i[chunk.core])
                if core:
                    held = {place[x] for x in chunk.i}
                    assert held >= set(range(max(0, core[0] - halo), min(len(order), core[-1] + 1 + halo)))
                    assert core == list(range(core[0], core[-1] + 1))


def test_positional_join(spark):
    a = spark.createDataFrame([("f", 5, 1), ("f", 7, 2), ("g", 1, 3), (None, 1, 9)], "file string, line int, x int")
    b = spark.createDataFrame([("f", 1, "a"), ("f", 2, "b"), ("f", 3, "c"), (None, 4, "n")], "file string, line int, v string")
    from aerolake.operators import joins

    assert sorted(joins.positional(a, b, ["file"], "line").collect(), key=str) == sorted([("f", 1, 1, "a"), ("f", 2, 2, "b"), ("f", 3, None, "c"), ("g", 1, 3, None), (None, 1, 9, "n")], key=str)
    with pytest.raises(ValueError):
        joins.positional(a, a, ["file"], "line")


def test_series_in_chunks_equal_whole_ones(spark, monkeypatch):
    import numpy as np

    from aerolake.operators import windows

    monkeypatch.setattr(windows, "CHUNK", 50)
    rng = np.random.default_rng(1)
    x = rng.normal(size=400)
    x[rng.random(400) < 0.3] = np.nan
    x[:3] = np.nan
    rows = [(i, None if np.isnan(v) else float(v)) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "i int, v double").selectExpr("i", "timestamp_seconds(i * 1000) as t", "v")
    got = windows.rolling_quantile(df.selectExpr("'a' as k", "*"), ["k"], "t", "i", "v", 12, 0.25, "q")
    want = [np.nanquantile(w, 0.25) if (~np.isnan(w := x[max(0, i - 6) : i + 6])).any() else None for i in range(400)]
    assert np.allclose([np.nan if r.q is None else r.q for r in got.orderBy("i").collect()], [np.nan if w is None else w for w in want], equal_nan=True)
    known = np.flatnonzero(~np.isnan(x))
    line = [np.interp(i, known, x[known]) if known[0] <= i <= known[-1] else np.nan for i in range(400)]
    out = windows.interpolate_series(df, [], "t", "v", "y").orderBy("i").collect()
    assert np.allclose([np.nan if r.y is None else r.y for r in out], line, equal_nan=True)
    y = np.arange(400.0) % 7
    series = spark.createDataFrame([(i, float(v)) for i, v in enumerate(y)], "i int, v double").selectExpr("'a' as k", "i", "timestamp_seconds(i * 1000) as t", "v")
    for _ in range(10):
        y = np.concatenate([y[:1], (y[:-2] + 2 * y[1:-1] + y[2:]) / 4, y[-1:]])
    assert np.allclose([r.smooth for r in windows.smooth_kernel(series, ["k"], "t", "i", "v").orderBy("i").collect()], y)
