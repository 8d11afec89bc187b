"""Hand-computed cases of scalar conversion and coordinates."""

import datetime as dt

import pytest
from hypothesis import Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gridspark.functions import coords as C
from gridspark.functions import formula_text as T
from gridspark.functions import scalars as S
from gridspark.operators import filters as L
from gridspark.operators import reshape as M


@pytest.fixture
def on(spark):
    """Apply a column function to Python values."""

    def run(values, kind, fn):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
        return [r[0] for r in df.orderBy("i").select(fn(F.col("v")).alias("x")).collect()]

    return run


def test_serial_to_timestamp(on):
    got = on([1.0, 59.0, 60.0, 61.0, 0.5, 0.9999999999, -1.0, 2958466.0], "double", S.from_serial)
    day = [r["ts"] and r["ts"].date().isoformat() for r in got]
    assert day == ["1900-01-01", "1900-02-28", "1900-02-28", "1900-03-01", None, "1900-01-01", "1899-12-29", None]
    assert got[4]["time_ms"] == 12 * 3600 * 1000 and got[7]["err"] == "#VALUE!"
    assert on([1.0], "double", lambda c: S.from_serial(c, 1904))[0]["ts"] == dt.datetime(1904, 1, 2)


def test_serial_round_trip(on):
    days = [dt.datetime(1900, 1, 1), dt.datetime(1900, 2, 28), dt.datetime(1900, 3, 1, 6), dt.datetime(2024, 2, 29, 23, 59, 59, 999000)]
    for epoch in (1900, 1904):
        back = on(days, "timestamp_ntz", lambda c: S.from_serial(S.to_serial(c, epoch), epoch)["ts"])
        assert back == days


def test_durations_and_iso(on):
    assert on([1.5, 1 / 86400 * 0.0015], "double", S.duration_from_serial) == [129600000, 2]
    got = on(["2024-05-06", "10:11", "2024-05-06T10:11:12.5Z", "PT1H30M0.25S", "what", ""], "string", S.from_iso)
    assert got[0]["date"] == dt.date(2024, 5, 6) and got[1]["time_us"] == (10 * 3600 + 11 * 60) * 10**6
    assert got[2]["ts"] == dt.datetime(2024, 5, 6, 10, 11, 12, 500000) and got[3]["duration_us"] == 5400250000
    assert got[4]["err"] and got[5]["err"] is None


def test_formats(on):
    codes = ["yyyy-mm-dd", "[h]:mm:ss", "0.00", '"day" 0', "h:mm", "m/d/yy h:mm", "[Red]0.0", "General", None, "0_d", "[$-409]d-mmm"]
    assert on(codes, "string", S.classify_format) == [
        "date", "timedelta", "number", "number", "time", "datetime", "number", "number", "number", "number", "date"]
    assert on([14, 46, 30], "int", S.format_code) == ["mm-dd-yy", "[h]:mm:ss", None]


def test_inference(on):
    assert on(["12.5%", "-3%", "%x", "%"], "string", S.infer_percent) == [0.125, -0.03, None, None]
    assert on(["10:30", "10:30:15", "30:15.5", "99:10", "24:00"], "string", S.infer_time) == [37800 * 10**6, 37815 * 10**6, 1815500000, None, None]
    got = on(["5", "-7", "1.5", "2e3", "05", "abc"], "string", S.infer_numeric)
    assert [(r["i"], r["d"]) for r in got] == [(5, None), (-7, None), (None, 1.5), (None, 2000.0), (None, None), (None, None)]


def test_escaping(on):
    assert on(["a\nb", "plain"], "string", S.escape_ctl) == ["a_x000a_b", "plain"]
    assert on(["a_x000a_b", "_x005F_x000a_", "_x00E9_", "_xD83D_"], "string", S.unescape_ctl) == ["a\nb", "_x000a_", "é", "_xD83D_"]


@settings(max_examples=2, deadline=None, phases=[Phase.generate])
@given(xs=st.lists(st.floats(1e-6, 1e16, allow_nan=False), min_size=50, max_size=200))
def test_safe_string_is_sixteen_digits(xs, spark):
    df = spark.createDataFrame([(x,) for x in xs], "v double")
    for v, text in df.select("v", S.safe_string(F.col("v"))).collect():
        assert text == f"{v:.16g}"


def test_safe_string_edges(on):
    xs = [0.0, -1.5, 8752.13, 0.1 + 0.2, float("nan"), float("inf"), None, 123456.0, 1e-5, 5e15 + 0.5]
    assert on(xs, "double", S.safe_string) == ["0", "-1.5", "8752.129999999999", "0.3", "", "", "none", "123456", "1e-05", f"{5e15 + 0.5:.16g}"]


def test_normalise(on):
    assert on([" 7am – 10am ", "Non - Work"], "string", S.normalise) == ["7am-10am", "Non-Work"]
    assert on(["Discount rate (health)"], "string", S.sanitise_id) == ["Discount_rate_health"]


def test_column_letters(on):
    n = [1, 26, 27, 52, 702, 703, 18278, 0, 18279]
    text = ["A", "Z", "AA", "AZ", "ZZ", "AAA", "ZZZ", None, None]
    assert on(n, "int", C.col_letter) == text
    assert on(["a", "Z", "AA", "AZ", "ZZ", "AAA", "ZZZ", "A1", ""], "string", C.col_index) == [1, 26, 27, 52, 702, 703, 18278, None, None]


def test_every_column_round_trips(spark):
    n = spark.range(1, 18279)
    assert n.filter(C.col_index(C.col_letter(F.col("id"))) != F.col("id")).count() == 0


def test_range_text(on):
    got = on(["B2:D4", "A:C", "3:4", "B2:D", "$B$2", "", "A1:B2:C3"], "string", C.range_bounds)
    assert [r and tuple(r) for r in got] == [(2, 2, 4, 4), (1, None, 3, None), (None, 3, None, 4), None, (2, 2, 2, 2), None, None]
    assert on(["B12:C3", "B12", "A:$C", "x y"], "string", C.absolute) == ["$B$12:$C$3", "$B$12", "$A:$C", None]
    assert on(["$B$12", "A0", "1A"], "string", C.parse_coord) == [("B", 2, 12), None, None]
    got = on(["'My ''x'''!A1:B2", "Data!C3", "A1"], "string", C.qualified_range)
    assert got[0]["sheet"] == "My ''x''" and tuple(got[1]["bounds"]) == (3, 3, 3, 3) and got[2] is None


def test_bands(on):
    got = on(["0-30", "76-125", "301 and over", "0-50km", "200+km"], "string", M.parse_bands)
    assert [tuple(r) for r in got] == [(0, 30), (76, 125), (301, 999999), (0, 50), (200, 999999)]


def test_wildcards(on):
    xs = ["abc", "a*c", "axxc", "AbC", None]
    assert on(xs, "string", lambda c: L.text_test(c, "wildcard", "a?c")) == [True, True, False, True, False]
    assert on(xs, "string", lambda c: L.text_test(c, "wildcard", "a~*c")) == [False, True, False, False, False]


def test_filter_specs(spark):
    specs = spark.createDataFrame([("equal", "*a*"), ("notEqual", "a*"), ("equal", "*a"), ("equal", "a?b"), ("greaterThan", "1e3"), ("equal", " "), ("equal", "a~*")], "operator string, val string")
    got = [tuple(r) for r in L.classify_filter(specs).select("kind", "test", "term", "exclude").collect()]
    assert got == [("text", "contains", "a", False), ("text", "startswith", "a", True), ("text", "endswith", "a", False), ("text", "wildcard", "a?b", False),
                   ("number", "greaterThan", "1e3", False), ("blank", "notEqual", " ", False), ("text", "wildcard", "a~*", False)]


def test_formula_tokens():
    assert [t[0] for t in T.tokens('=SUM(A1,"x ""y""")')] == ["SUM(", "A1", ",", '"x ""y"""', ")"]
    assert T.tokens("=1E+5")[0] == ("1E+5", "OPERAND", "NUMBER")
    assert [t[1] for t in T.tokens("=-A1+-B1%")] == ["OPERATOR-PREFIX", "OPERAND", "OPERATOR-INFIX", "OPERATOR-PREFIX", "OPERAND", "OPERATOR-POSTFIX"]
    assert T.tokens("=Sheet1!#REF!")[0] == ("Sheet1!#REF!", "OPERAND", "RANGE")
    assert T.tokens("=(A1")[-1][1] == "OPERAND" and T.tokens("=A1)")[0][1] == "INVALID"
    assert T.tokens("") == [] and T.tokens("x") == [("x", "LITERAL", "")]


def test_formula_translation():
    move = T.shift_formula
    assert move("=A1+$B$2", 1, 1) == "=B2+$B$2"
    assert move("=SUM('My Sheet'!A:B,3:$4)", 2, 1) == "=SUM('My Sheet'!B:C,5:$4)"
    assert move("=rate*Data!first", 5, 5) == "=rate*Data!first"
    assert move("=A1", -1, 0) is None and move("=A1", 0, -1) is None
    assert move('="A1"&LOG10(Z9)', 1, 1) == '="A1"&LOG10(AA10)'
