"""Declared items evaluated from rows against the forms that take Python arguments, and their edge cases."""

import datetime as dt
import zipfile

import pytest
from pyspark.sql import functions as F

from gridspark.operators import declared as D
from gridspark.operators import filters, quality, rules
from gridspark.sources import ooxml
from gridspark.sources import workbook as W

TODAY = dt.date(2024, 5, 15)
VALUES = [5, 3.5, 3.5, -2, 100, 7, 0, 12, 55, 41, -8, 9]
WORDS = ["alpha", "Beta", "alpha", None, "gamma ray", "#N/A", "beta~x", "x*y", "delta", "b?", "zz", "Alphabet"]
DAYS = [dt.datetime(2024, 5, 15) + dt.timedelta(days=d) for d in (0, 1, -1, -6, 40, 400, -40, 3, -100, 7, 10, -200)]


def book(folder, name, tail):
    with open(f"{folder}/{name}.xlsx", "wb") as out:
        sheet = ooxml.SheetWriter(out, "s")
        sheet.append(["n", "w", "d"])
        for row in zip(VALUES, WORDS, DAYS, strict=True):
            sheet.append(row)
        sheet.close(tail)


RULES = {
    "between": ('<cfRule type="cellIs" priority="1" operator="notBetween"><formula>12</formula><formula>0</formula></cfRule>', lambda d: rules.rule_cell_is(F.col("n"), "notBetween", 12, 0)),
    "text": ('<cfRule type="cellIs" priority="1" operator="equal"><formula>"x"</formula></cfRule>', lambda d: F.lit(False)),
    "top": ('<cfRule type="top10" priority="1" rank="3"/>', lambda d: rules.rule_top10(d, "n", 3)),
    "low": ('<cfRule type="top10" priority="1" rank="30" percent="1" bottom="1"/>', lambda d: rules.rule_top10(d, "n", 30, True, True)),
    "above": ('<cfRule type="aboveAverage" priority="1"/>', lambda d: rules.rule_average(d, "n")),
    "below": ('<cfRule type="aboveAverage" priority="1" aboveAverage="0" equalAverage="1" stdDev="1"/>', lambda d: rules.rule_average(d, "n", False, True, 1)),
    "twice": ('<cfRule type="duplicateValues" priority="1"/>', lambda d: F.col("n") == 3.5),
    "once": ('<cfRule type="uniqueValues" priority="1"/>', lambda d: F.col("n") != 3.5),
}


def test_rules_equal_those_with_arguments(spark, tmp_path):
    for name, (xml, _) in RULES.items():
        book(tmp_path, name, f'<conditionalFormatting sqref="A2:A5 A4:A40">{xml}</conditionalFormatting>')
    judged = D.evaluate_rules(W.scan_workbooks(spark, str(tmp_path)), W.scan_declared(spark, str(tmp_path)), TODAY).collect()
    df = spark.createDataFrame([(i + 2, float(v)) for i, v in enumerate(VALUES)], "row int, n double")
    for name, (_, test) in RULES.items():
        got = sorted((r.row, r.hit) for r in judged if r.book == f"{name}.xlsx")
        assert got == sorted(map(tuple, df.select("row", F.coalesce(test(df), F.lit(False))).collect())), name


TEXTS = {
    "containsText": "ALPHA", "notContainsText": "a", "beginsWith": "b", "endsWith": "y", "containsBlanks": None, "notContainsBlanks": None, "containsErrors": None, "notContainsErrors": None,
}


def test_texts_spans_and_what_is_not_evaluated(spark, tmp_path):
    for name, term in TEXTS.items():
        told = f' text="{term}"' if term else ""
        book(tmp_path, name, f'<conditionalFormatting sqref="B2:B13"><cfRule type="{name}" priority="1"{told}/></conditionalFormatting>')
    for name in ("last7Days", "thisMonth", "nextWeek"):
        book(tmp_path, name, f'<conditionalFormatting sqref="C2:C13"><cfRule type="timePeriod" priority="1" timePeriod="{name}"/></conditionalFormatting>')
    book(tmp_path, "formula", '<conditionalFormatting sqref="A2:A13"><cfRule type="cellIs" operator="lessThan" priority="1"><formula>$B$1</formula></cfRule></conditionalFormatting>')
    judged = D.evaluate_rules(W.scan_workbooks(spark, str(tmp_path)), W.scan_declared(spark, str(tmp_path)), TODAY).collect()
    df = spark.createDataFrame([(i + 2, w, d) for i, (w, d) in enumerate(zip(WORDS, DAYS, strict=True))], "row int, w string, d timestamp_ntz")
    words = df.filter("w is not null")
    for name, term in TEXTS.items():
        kind = "notContains" if name == "notContainsText" else name
        test = rules.rule_text(F.col("w"), kind, term) if term else rules.rule_blank_error(F.col("w"), name)
        assert sorted((r.row, r.hit) for r in judged if r.book == f"{name}.xlsx") == sorted(map(tuple, words.select("row", test).collect())), name
    for name in ("last7Days", "thisMonth", "nextWeek"):
        want = df.select("row", filters.relative_date(F.col("d"), name, TODAY)).collect()
        assert sorted((r.row, r.hit) for r in judged if r.book == f"{name}.xlsx") == sorted(map(tuple, want))
    assert {r.hit for r in judged if r.book == "formula.xlsx"} == {None}


def test_scales_equal_those_with_arguments(spark, tmp_path):
    book(tmp_path, "two", '<conditionalFormatting sqref="A2:A13"><cfRule type="colorScale" priority="1"><colorScale><cfvo type="num" val="0"/><cfvo type="percentile" val="90"/><color rgb="FFFF0000"/><color rgb="FF00FF10"/></colorScale></cfRule></conditionalFormatting>')
    book(tmp_path, "icons", '<conditionalFormatting sqref="A2:A13"><cfRule type="iconSet" priority="1"><iconSet reverse="1"><cfvo type="percent" val="0"/><cfvo type="percentile" val="40"/><cfvo type="num" val="41" gte="0"/><cfvo type="percent" val="90"/></iconSet></cfRule></conditionalFormatting>')
    book(tmp_path, "bar", '<conditionalFormatting sqref="A2:A13"><cfRule type="dataBar" priority="1"><dataBar minLength="5" maxLength="80"><cfvo type="min"/><cfvo type="percent" val="50"/><color rgb="FF638EC6"/></dataBar></cfRule></conditionalFormatting>')
    judged = D.evaluate_rules(W.scan_workbooks(spark, str(tmp_path)), W.scan_declared(spark, str(tmp_path)), TODAY).collect()
    df = spark.createDataFrame([(i + 2, float(v)) for i, v in enumerate(VALUES)], "row int, n double")
    want = {r.row: (r.position, r.rgb) for r in rules.color_scale(df, "n", [("num", 0, "FF0000"), ("percentile", 90, "00FF10")]).collect()}
    for r in (r for r in judged if r.book == "two.xlsx"):
        assert r.position == pytest.approx(want[r.row][0]) and r.rgb == want[r.row][1]
    stops = [("percent", 0, True), ("percentile", 40, True), ("num", 41, False), ("percent", 90, True)]
    assert {r.row: r.bucket for r in judged if r.book == "icons.xlsx"} == dict(df.select("row", rules.icon_bucket(df, "n", stops, True)).collect())
    bars = dict(df.select("row", rules.data_bar(df, "n", ("min", None), ("percent", 50), 5, 80)).collect())
    assert {r.row: r.bar for r in judged if r.book == "bar.xlsx"} == pytest.approx(bars)


def test_priorities_and_stops(spark, tmp_path):
    book(tmp_path, "b", '<conditionalFormatting sqref="A2:A13"><cfRule type="cellIs" priority="3" operator="greaterThan"><formula>0</formula></cfRule><cfRule type="top10" priority="2" rank="2" stopIfTrue="1"/><cfRule type="uniqueValues" priority="1"/></conditionalFormatting>')
    judged = D.evaluate_rules(W.scan_workbooks(spark, str(tmp_path)), W.scan_declared(spark, str(tmp_path)), TODAY)
    got = {r.row: r.applied for r in D.resolve_declared(judged).collect()}
    top, n = {100, 55}, dict(enumerate(VALUES, 2))
    assert got == {row: [t for t, on in (("uniqueValues", v != 3.5), ("top10", v in top), ("cellIs", v > 0 and v not in top)) if on] for row, v in n.items()}


def test_validations(spark, tmp_path):
    v = lambda sqref, more, *f: f'<dataValidation sqref="{sqref}" {more}>' + "".join(f"<formula{i}>{x}</formula{i}>" for i, x in enumerate(f, 1)) + "</dataValidation>"
    book(tmp_path, "v", "<dataValidations>" + v("A2:A13", 'type="whole" operator="greaterThanOrEqual"', 0) + v("B2:B13", 'type="textLength" operator="lessThan"', 5) + v("B2:B13", 'type="list"', '"alpha, Beta"')
         + v("B2:B13", 'type="list"', "$B$2:$B$3") + v("C2:C13", 'type="date" operator="lessThan"', 45427) + v("A2:A13", 'type="custom"', "A2&gt;1") + "</dataValidations>")
    judged = D.evaluate_validations(W.scan_workbooks(spark, str(tmp_path)), W.scan_declared(spark, str(tmp_path)))
    rows = judged.collect()
    of = lambda kind, col: sorted((r.row, r.valid) for r in rows if r.type == kind and r.col == col)
    df = spark.createDataFrame([(i + 2, float(n), w) for i, (n, w) in enumerate(zip(VALUES, WORDS, strict=True))], "row int, n double, w string")
    assert of("whole", 1) == sorted(map(tuple, df.select("row", quality.validate_bounds(F.col("n"), "whole", "greaterThanOrEqual", 0)).collect()))
    words = df.filter("w is not null")
    assert of("textLength", 2) == sorted(map(tuple, words.select("row", quality.validate_length(F.col("w"), "lessThan", 5)).collect()))
    inline = [(i + 2, w in ("alpha", "Beta")) for i, w in enumerate(WORDS) if w]
    assert of("list", 2) == sorted(inline * 2)
    assert of("date", 3) == [(i + 2, d < dt.datetime(2024, 5, 15)) for i, d in enumerate(DAYS)]
    assert {r.valid for r in rows if r.type == "custom"} == {None}
    told = {(r.type, r.checked, r.violations, r.first_row) for r in D.report(judged).collect()}
    assert ("whole", 12, 4, 3) in told and ("custom", 0, 0, None) in told


FILTERED = {
    "blank": ('<filterColumn colId="1"><filters blank="1"><filter val="alpha"/></filters></filterColumn>', lambda n, w, d: w in (None, "alpha")),
    "group": ('<filterColumn colId="2"><filters><dateGroupItem year="2024" month="5" dateTimeGrouping="month"/></filters></filterColumn>', lambda n, w, d: (d.year, d.month) == (2024, 5)),
    "star": ('<filterColumn colId="1"><customFilters><customFilter val="b*"/><customFilter val="x~*?"/></customFilters></filterColumn>', lambda n, w, d: bool(w) and (w.lower().startswith("b") or w == "x*y")),
    "not": ('<filterColumn colId="1"><customFilters><customFilter operator="notEqual" val=" "/></customFilters></filterColumn>', lambda n, w, d: w is not None),
    "top": ('<filterColumn colId="0"><top10 val="2"/></filterColumn>', lambda n, w, d: n in (100, 55)),
    "low": ('<filterColumn colId="0"><top10 val="25" percent="1" top="0"/></filterColumn>', lambda n, w, d: n in (-8, -2, 0)),
    "mean": ('<filterColumn colId="0"><dynamicFilter type="belowAverage"/></filterColumn><filterColumn colId="2"><dynamicFilter type="Q2"/></filterColumn>', lambda n, w, d: n < sum(VALUES) / 12 and d.month in (4, 5, 6)),
    "two": ('<filterColumn colId="0"><customFilters and="1"><customFilter operator="greaterThanOrEqual" val="0"/><customFilter operator="notEqual" val="7"/></customFilters></filterColumn>', lambda n, w, d: n >= 0 and n != 7),
    "icon": ('<filterColumn colId="0"><iconFilter iconSet="3Arrows" iconId="1"/></filterColumn>', lambda n, w, d: True),
}


def test_filters(spark, tmp_path):
    for name, (xml, _) in FILTERED.items():
        book(tmp_path, name, f'<autoFilter ref="A1:C13">{xml}</autoFilter>')
    got = D.evaluate_filters(W.scan_workbooks(spark, str(tmp_path)), W.scan_declared(spark, str(tmp_path)), TODAY).collect()
    for name, (_, test) in FILTERED.items():
        want = [(i + 2, test(*row)) for i, row in enumerate(zip(VALUES, WORDS, DAYS, strict=True))]
        assert sorted((r.row, r.visible) for r in got if r.book == f"{name}.xlsx") == want, name


def test_nothing_declared(spark, tmp_path):
    book(tmp_path, "plain", "")
    with zipfile.ZipFile(tmp_path / "plain.xlsx") as z:
        assert b"cfRule" not in z.read("xl/worksheets/sheet1.xml")
    cells, items = W.scan_workbooks(spark, str(tmp_path)), W.scan_declared(spark, str(tmp_path))
    assert D.evaluate_rules(cells, items, TODAY).count() == D.evaluate_validations(cells, items).count() == D.evaluate_filters(cells, items, TODAY).count() == 0
