"""Inputs that once went wrong: long series, clashing names, gaps between bands, whole columns."""

import pytest
from pyspark.sql import functions as F

from gridspark.operators import grid as G
from gridspark.operators import ranges as R
from gridspark.operators import reshape as M
from gridspark.operators import series as K
from gridspark.operators import structure as D
from gridspark.operators import typing as T
from gridspark.plans import costs as X
from gridspark.scale import block_of


@pytest.mark.parametrize("size,period", [(5, 3), (2, 7), (1000, 4)])
def test_moving_average_over_pieces(spark, size, period):
    ys = [(i * 37) % 11 for i in range(40)]
    points = spark.createDataFrame([("s", i, float(y)) for i, y in enumerate(ys)], "series string, x long, y double")
    got = {r.x: r.ma for r in K.moving_avg(points, ["series"], period, block_of("x", 6), size).collect()}
    assert len(got) == 40
    for i in range(40):
        want = sum(ys[i - period + 1 : i + 1]) / period if i >= period - 1 else None
        assert got[i] == pytest.approx(want) if want is not None else got[i] is None


def test_span_reaches_over_tiles(spark):
    points = spark.createDataFrame([("s", 0, 0.0), ("s", 10_000, 100.0)], "series string, x long, y double")
    got = {r.x: r.y for r in K.fill_blanks(points, ["series"], "span", 5).collect()}
    assert sorted(got) == list(range(0, 10_001, 5)) and got[5_000] == pytest.approx(50)


def test_titles_are_unique(spark):
    names = ["Sheet", "Sheet1", "SHEET", "sheet", "Sheet1", "a", "a", "A9", "a9", "1", "1"]
    df = spark.createDataFrame([("b", i, n) for i, n in enumerate(names)], "book string, i int, name string")
    got = [r.title for r in T.dedupe_names(df, ["book"], "name", ["i"], block_of("i", 3)).orderBy("i").collect()]
    assert got == ["Sheet", "Sheet1", "SHEET2", "sheet3", "Sheet4", "a", "a10", "A9", "a11", "1", "2"]


def test_bands_keep_what_fits_none(spark):
    bands = spark.createDataFrame([("0-10",), ("11 and over",)], "band string").select("band", M.parse_bands(F.col("band")).alias("b")).select("band", "b.*")
    facts = spark.createDataFrame([(v,) for v in (0.0, 10.0, 10.5, 11.0, 2e6, -1.0)] + [(None,)], "v double")
    got = {r.v: r.band for r in M.band_join(facts, "v", bands).collect()}
    assert got == {0.0: "0-10", 10.0: "0-10", 10.5: None, 11.0: "11 and over", 2e6: "11 and over", -1.0: None, None: None}
    assert M.band_join(facts, "v", bands, how="inner").count() == 4


def test_whole_columns_and_rows(spark, make_cells):
    refs = spark.createDataFrame([("A:A",), ("2:2",)], "ref string")
    got = {(r.ref, r.cell) for r in R.expand_ranges(refs, "ref", max_row=3, max_col=2).collect()}
    assert got == {("A:A", c) for c in ("A1", "A2", "A3")} | {("2:2", c) for c in ("A2", "B2")}
    cells = make_cells({("s", "A1"): 1, ("s", "A3"): 2, ("s", "B2"): 3})
    notes = spark.createDataFrame([("b", "s", "A:A", "link", "u")], "book string, sheet string, ref string, kind string, text string")
    merges = spark.createDataFrame([], "book string, sheet string, min_col int, min_row int, max_col int, max_row int")
    assert {(r.row, r.col) for r in G.bind_annotations(cells, notes, merges).collect()} == {(1, 1), (3, 1)}


def test_unknown_merge_fails(spark, make_cells):
    cells = make_cells({("s", "A1"): 1, ("s", "A2"): 2})
    place = "book string, sheet string, min_col int, min_row int, max_col int, max_row int"
    one, other = spark.createDataFrame([("b", "s", 1, 1, 1, 2)], place), spark.createDataFrame([("b", "s", 1, 1, 2, 2)], place)
    assert D.unmerge_cells(cells, one, one).count() == 1
    with pytest.raises(Exception, match="not merged: s!A1:B2"):
        D.unmerge_cells(cells, other, one).count()


def test_text_stays_text_in_appended_rows(spark, make_cells):
    cells = make_cells({("s", "A1"): 1})
    rows = spark.createDataFrame([("b", "s", 1, "007", 7)], "book string, sheet string, i int, t string, n int")
    rows = rows.select("book", "sheet", "i", G.list_row(F.col("t"), F.col("n")).alias("values"))
    got = {r.col: (r.dtype, r.v_str, r.v_num) for r in G.append_rows(cells, rows, ["i"], block_of("i")).filter("row = 2").collect()}
    assert got == {1: ("s", "007", None), 2: ("n", None, 7.0)}


def test_series_keep_text_categories(spark, make_cells):
    cells = make_cells({("s", "A1"): "when", ("s", "B1"): "v", ("s", "A2"): "jan", ("s", "B2"): 5, ("s", "A3"): 2024, ("s", "B3"): 6})
    got = [(r.idx, r.x, r.x_text, r.y) for r in K.extract_series(cells, x=1).orderBy("idx").collect()]
    assert got == [(0, None, "jan", 5.0), (1, 2024.0, "2024", 6.0)]


def test_modes_of_every_scenario(spark):
    names = ["Param_a", "Param_b", "Param_c", "Param_d", "Param_a1", "Param_b1"]
    interim = spark.createDataFrame([(s, "CB", *[float(i)] * 6) for i, s in enumerate(("x", "y"))], "scenario string, AUC string, " + ", ".join(f"{n} double" for n in names))
    modes = spark.createDataFrame([(1, "CB"), (2, "BUS")], "id int, CODE string")
    got = sorted((r.id, r.scenario, r.Param_a) for r in X.mode_attributes(modes, interim).collect())
    assert [(i, s) for i, s, _ in got] == [(1, "x"), (1, "y"), (2, "x"), (2, "y")] and [a for _, _, a in got] == [0.0, 1.0, None, None]


def test_views_fill_gaps_without_a_grid(make_cells):
    cells = make_cells({("s", "B2"): "b2", ("s", "E2"): 5.0, ("s", "C5"): "c5", ("s", "A1"): None})
    rows = {r["row"]: r["values"] for r in D.iter_rows(cells).collect()}
    assert rows == {1: [None] * 5, 2: [None, "b2", None, None, "5"], 3: [None] * 5, 4: [None] * 5, 5: [None, None, "c5", None, None]}
    cols = {(r["col"], r["part"]): r["values"] for r in D.iter_cols(cells, chunk=3).collect()}
    assert len(cols) == 10 and cols[(2, 0)] == [None, "b2"] and cols[(3, 1)] == [None, None, "c5"] and cols[(4, 0)] == [None, None]
    area = cells.select("book", "sheet").distinct().select("book", "sheet", *[F.lit(v).alias(n) for n, v in (("min_col", 2), ("min_row", 2), ("max_col", 3), ("max_row", 4))])
    assert {r["row"]: r["values"] for r in D.iter_rows(cells, area).collect()} == {2: ["b2", None], 3: [None, None], 4: [None, None]}
    assert {r["col"]: r["values"] for r in D.iter_cols(cells, area).collect()} == {2: ["b2", None, None], 3: [None, None, None]}
