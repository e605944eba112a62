from aerolake.operators.rejects import load_lines, rejected

SCHEMA = "line_id long, file_name string, line_no int, line string, reason string, header string"
H = "dtm,time,date,o3,flags,hio3"
B = "pcdate pctime time date o3 flags cellai"
CASES = [
    ("c", "# note", "skip"),
    ("c", H, "skip"),
    ("c", H.upper(), "skip"),
    ("c", "", "skip"),
    ("c", "   ", "skip"),
    ("c", None, "skip"),
    ("c", "2008-01-01 00:00:00,a,b,1.5,F,0", None),
    ("c", '2008-01-01T00:00:00Z,"a","b",2261E-2,"F, ""x""",', None),
    ("c", "01/31/2008 11:59:00 PM,a,b,+.5,F,0,,", None),
    ("c", "2008-01-01 00:00:00,a,b,1.5,F,0 ", None),
    ("c", '2008-01-01 00:00:00,"a,"b",1.5,F,0', "quoting"),
    ("c", '2008-01-01 00:00:00,"a"7,b,1.5,F,0', "quoting"),
    ("c", '2008-01-01 00:00:00,a,b,1.5,F,0"', "quoting"),
    ("c", 'x,a"b', "quoting"),
    ("c", "2008-01-01 00:00:00,a,b,1.5,F", "column_count"),
    ("c", "2008-01-01 00:00:00,a,b,1.5,F,0,9", "column_count"),
    ("c", "2008-01-01 00:00:00;a;b;1.5;F;0", "column_count"),
    ("c", "2008-02-30 00:00:00,a,b,x,F,0", "bad_dtm"),
    ("c", "2008-01-01 25:00:00,a,b,1,F,0", "bad_dtm"),
    ("c", "31-01-2008 00:00:00,a,b,1,F,0", "bad_dtm"),
    ("c", "2008-01-01,a,b,1,F,0", "bad_dtm"),
    ("c", ",a,b,1,F,0", "bad_dtm"),
    ("c", "2008-01-01 00:00:00,a,b,0x1F,F,0", "bad_o3"),
    ("c", "2008-01-01 00:00:00,a,b,,F,0", "bad_o3"),
    ("c", "2008-01-01 00:00:00,a,b,NaN,F,0", "bad_o3"),
    ("b", B, "skip"),
    ("b", "2008-01-01  00:00:00 00:00   01-01 2261E-2 1c 70000 ", None),
    ("b", "2008-01-01 00:00:00 00:00 01-01 2261E-2 1c", "column_count"),
    ("b", "2008-13-01 00:00:00 00:00 01-01 2261E-2 1c 7", "bad_dtm"),
    ("none", "2008-01-01 00:00:00,a,b,1.5,F,0", "column_count"),
    (None, "2008-01-01 00:00:00,a,b,1.5,F,0", "column_count"),
    ("c", "é" * 50_000, "column_count"),
]


def frame(spark, cases):
    return spark.createDataFrame([(i, f, i, line, "clash", "clash") for i, (f, line, _) in enumerate(cases)], SCHEMA)


def test_reasons(spark):
    got = {r.line_id: r.reason for r in load_lines(frame(spark, CASES)).collect()}
    want = {i: reason for i, (_, _, reason) in enumerate(CASES) if reason != "skip"}
    assert got == want
    assert {(r.line_id, r.reason) for r in rejected(frame(spark, CASES)).collect()} == {(i, r) for i, r in want.items() if r}


def test_typed_values(spark):
    rows = {r.line_id: r for r in load_lines(frame(spark, CASES)).filter("reason is null").collect()}
    a = rows[7]
    assert (a.o3, a.flags, a.hio3, str(a.dtm)) == (22.61, 'F, "x"', None, "2008-01-01 00:00:00")
    assert str(rows[8].dtm) == "2008-01-31 23:59:00" and rows[8].o3 == 0.5
    b = rows[26]
    assert (b.o3, b.flags, b.cellai) == (22.61, "1c", 70000)


def test_empty(spark):
    assert load_lines(frame(spark, [])).count() == 0
