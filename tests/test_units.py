import pytest

from aerolake.operators import units
from aerolake.operators.units import harmonize, in_other_unit, parse_quantity, parse_unit, unit_in_remark

MASS = parse_unit("ug/m3").dims
SCHEMA = "reading_id long, source string, instrument string, pm25_conc double, ir880 double, bc6 double, value_text string, unit string, note string, quantity string, scale int"


@pytest.mark.parametrize(("text", "code"), [("UG/M3", "ug/m3"), ("nanograms per m3", "ng/m3"), ("μg m-3", "ug/m3"), ("ug m**-3", "ug/m3"), ("µg/m³", "ug/m3"), ("ug l-1", "ug/l"), ("milligrams per cubic metre", "mg/m3"), ("[mg/m^3]", "mg/m3"), ("hPa", "hPa"), ("l/min", "l/min")])
def test_unit_grammar(text, code):
    assert parse_unit(text).code == code


def test_dimensions_and_offsets():
    assert parse_unit("degC").offset == 273.15 and parse_unit("°F").dims == parse_unit("K").dims
    assert parse_unit("mmHg").dims == parse_unit("hPa").dims == parse_unit("kg m-1 s-2").dims
    assert parse_unit("ug/l").scale == pytest.approx(parse_unit("mg/m3").scale)
    for text in ("", "?", "ug/m3 or so", "m3/ug/x"):
        assert parse_unit(text, MASS) is None


def test_quantities_and_remarks():
    assert parse_quantity("ca. 0.010376 ug l-1", MASS)[0] == 0.010376
    number, unit = parse_quantity("f64(14.59)ug/m3", MASS)
    assert (number, unit.code) == (14.59, "ug/m3")
    assert parse_quantity("ng m-3: 1,002.5", MASS)[0] == 1002.5 and parse_quantity("12,5 µg/m³", MASS)[0] == 12.5
    assert parse_quantity("no number", MASS) == (None, None)
    assert unit_in_remark("logger set to MG/M3", MASS).code == "mg/m3"
    assert unit_in_remark("guide value is 15 µg/m³", MASS) is None and unit_in_remark("windy", MASS) is None


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA)


def test_harmonize(spark):
    nan = float("nan")
    rows = [(i, "s", "avo", 10.0 + i / 10, None, None, None, "ug/m3", None) for i in range(20)] + [
        (100, "s", "avo", 0.0105, None, None, None, None, None),  # agrees in mg/m3
        (101, "s", "avo", 10.5, None, None, None, "", "guide value is 15 mg/m3"),  # agrees in ug/m3
        (102, "s", "avo", 0.0105, None, None, None, None, "display in ug/L since service"),
        (103, "s", "avo", None, None, None, "0.012 mg/m3", None, None),
        (104, "s", "avo", nan, None, None, None, "ug/m3", None),
        (105, "s", "avo", None, None, None, None, "ug/m3", None),
        (106, "t", "ae33", None, None, 900.0, None, "ng/m3", None),
        (107, "t", "ae33", None, None, 0.9, None, "?", None),
        (108, "t", "ae33", None, None, 0.0, None, None, None),
        (109, None, "ae31", None, 1.2, None, None, "µg/m³", None),
        (110, None, "ae31", None, 1100.0, None, None, None, None),
        (111, "u", "other", None, None, None, "5 ug/m3", None, None),
        (112, "s", "avo", 10.0, None, None, None, "ng/m3", None),  # a stated unit is right
        (113, "s", "avo", None, None, None, "x" * 100_000, None, None),
    ]
    got = {r.reading_id: r for r in harmonize(frame(spark, rows + rows[:1])).collect()}
    assert got[100].unit_code == "mg/m3" and got[100].value == pytest.approx(10.5) and got[100].unit_from == "inferred"
    assert got[101].unit_code == "ug/m3" and got[102].unit_code == "ug/l" and got[102].value == pytest.approx(10.5)
    assert got[103].value == pytest.approx(12) and got[103].unit_from == "value_text"
    assert {104, 105, 111, 113}.isdisjoint(got)
    assert got[107].value == pytest.approx(900) and got[108].unit_code == "ng/m3"
    assert got[109].value == pytest.approx(1200) and got[110].unit_code == "ng/m3" and got[112].unit_code == "ng/m3"
    found = dict(in_other_unit(frame(spark, rows)).collect())
    assert found == {100: "mg/m3", 102: "ug/l", 103: "mg/m3", 107: "ug/m3", 109: "ug/m3", 112: "ng/m3"}
    assert harmonize(frame(spark, [])).count() == 0


def test_offsets_count(spark):
    kelvin = (units.Quantity("pm25_conc", ("avo",), "K", guess=("degC", "degF")),)
    rows = [(1, "s", "avo", 20.0, None, None, None, "degC", None), (2, "s", "avo", 68.0, None, None, None, "°F", None), (3, "s", "avo", 293.15, None, None, None, "kelvin", None), (4, "s", "avo", 20.5, None, None, None, None, None), (5, "s", "avo", 69.0, None, None, None, None, None), (6, "s", "avo", -300.0, None, None, None, None, None)]
    got = {r.reading_id: r for r in harmonize(frame(spark, rows), kelvin).collect()}
    assert [round(got[i].value, 6) for i in (1, 2, 3, 4)] == [293.15, 293.15, 293.15, 293.65]
    assert (got[4].unit_code, got[5].unit_code) == ("degC", "degF") and got[5].value == pytest.approx(293.705556)
    assert got[6].unit_code == "K"
    celsius = (units.Quantity("pm25_conc", ("avo",), "degC", guess=("K",)),)
    assert harmonize(frame(spark, rows[:3]), celsius).agg({"value": "max"}).first()[0] == pytest.approx(20)
