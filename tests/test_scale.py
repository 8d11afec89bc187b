"""Blocked scans, salted joins and tiles against brute force, with one key holding a third of the rows."""

import random

import pytest
from pyspark.sql import functions as F

from gridspark import scale
from gridspark.operators import series, stats


@pytest.fixture(scope="module")
def skewed(spark):
    r = random.Random(7)
    rows = [(i, "hot" if r.random() < 0.35 else f"k{r.randrange(40)}", float(r.randrange(100)) if r.random() < 0.7 else None) for i in range(4000)]
    return rows, spark.createDataFrame(rows, "i long, k string, v double")


@pytest.mark.parametrize("size", [1, 16, 100000])
def test_running_matches_a_plain_loop(skewed, size):
    rows, df = skewed
    out = scale.running(
        df, ["k"], ["i"],
        {"n": ("row_number", None), "s": ("sum", F.col("v")), "last": ("last", F.col("v")), "up": ("lag", F.col("v"))},
        scale.block_of("i", size),
    )
    got = {r["i"]: (r["n"], r["s"], r["last"], r["up"]) for r in out.collect()}
    state = {}
    for i, k, v in rows:
        n, s, last, up = state.get(k, (0, 0.0, None, None))
        n, s, last = n + 1, s + (v or 0.0), v if v is not None else last
        assert got[i] == (n, s, last, up)
        state[k] = (n, s, last, v)


def test_running_without_keys(skewed):
    rows, df = skewed
    out = scale.running(df, [], ["i"], {"n": ("row_number", None)}, scale.block_of("i", 64))
    assert {r["i"]: r["n"] for r in out.collect()} == {i: i + 1 for i, _, _ in rows}


def test_running_keeps_null_keys_and_places(spark):
    rows = [(k, x, float(x or 0)) for k in ("a", None) for x in (None, None, 1, 2, 70, 71, 200)]
    df = spark.createDataFrame(rows, "k string, x long, v double")
    out = scale.running(df, ["k"], ["x"], {"n": ("row_number", None), "s": ("sum", F.col("v")), "up": ("lag", F.col("v"))}, scale.block_of("x", 64))
    got = sorted(((r["k"] or "", r["n"], r["x"], r["s"], r["up"]) for r in out.collect()), key=lambda r: r[:2])
    want = [(1, None, 0.0, None), (2, None, 0.0, 0.0), (3, 1, 1.0, 0.0), (4, 2, 3.0, 1.0), (5, 70, 73.0, 2.0), (6, 71, 144.0, 70.0), (7, 200, 344.0, 71.0)]
    assert got == [(k, *w) for k in ("", "a") for w in want]


def test_series_without_a_name_or_place(spark):
    rows = [(k, x, float(i)) for k in ("a", None) for i, x in enumerate((None, 1, 2, 4, 8))]
    points = spark.createDataFrame(rows, "series string, x long, y double")
    got = series.moving_avg(points, ["series"], 2, scale.block_of("x", 2), 2).collect()
    want = [(k, x, ma) for k in ("", "a") for x, ma in ((-1, None), (1, 0.5), (2, 1.5), (4, 2.5), (8, 3.5))]
    assert sorted(((r["series"] or "", -1 if r["x"] is None else r["x"], r["ma"]) for r in got), key=lambda r: r[:2]) == want
    for how, third in (("gap", None), ("zero", 0.0), ("span", 2.5)):
        got = series.fill_blanks(points, ["series"], how).filter("x <= 4").collect()
        assert sorted((r["series"] or "", r["x"], r["y"]) for r in got) == [(k, x, y) for k in ("", "a") for x, y in ((1, 1.0), (2, 2.0), (3, third), (4, 3.0))]


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
@pytest.mark.parametrize("hot", [False, True])
def test_salted_join_is_the_plain_join(skewed, spark, how, hot):
    _, df = skewed
    keyed = spark.createDataFrame([("hot", 1), ("k1", 2), ("k2", 3)], "k string, w int")
    keys = scale.hot_keys(df, ["k"], 500) if hot else None
    if hot:
        assert [r["k"] for r in keys.collect()] == ["hot"]
    got = sorted(map(str, scale.salted_join(df, keyed, ["k"], how, hot=keys).select(*df.columns).collect()))
    want = sorted(map(str, df.join(keyed, ["k"], how).select(*df.columns).collect()))
    assert got == want


def test_tiles_match_a_theta_join(spark):
    cells = spark.range(0, 3000).select(F.lit("b").alias("book"), F.lit("s").alias("sheet"), (F.col("id") + 1).cast("int").alias("row"), (F.col("id") % 7 + 1).cast("int").alias("col"))
    ranges = spark.createDataFrame([("b", "s", i % 5 + 1, 37 * i + 1, i % 5 + 3, 37 * i + 400, i) for i in range(40)], "book string, sheet string, min_col int, min_row int, max_col int, max_row int, id int")
    got = {(r["row"], r["r_id"]) for r in scale.tile_join(cells, ranges, tile=64).collect()}
    want = {
        (row, i) for row in range(1, 3001) for i in range(40)
        if 37 * i + 1 <= row <= 37 * i + 400 and i % 5 + 1 <= (row - 1) % 7 + 1 <= i % 5 + 3
    }
    assert got == want


def test_order_statistics(skewed):
    rows, df = skewed
    xs = sorted(v for _, _, v in rows if v is not None)
    p = df.limit(1).select(stats.percentiles(df, F.col("v"), [0.0, 0.25, 0.5, 0.9, 1.0]).alias("p")).first()["p"]
    for got, f in zip(p, (0.0, 0.25, 0.5, 0.9, 1.0)):
        at = f * (len(xs) - 1)
        lo = int(at)
        hi = min(lo + 1, len(xs) - 1)
        assert got == pytest.approx(xs[lo] + (xs[hi] - xs[lo]) * (at - lo))
    for n in (1, 10, len(xs)):
        assert df.limit(1).select(stats.nth_value(stats.value_blocks(df, F.col("v")), F.lit(n))).first()[0] == xs[n - 1]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_reach_the_scan(spark):
    from gridspark.operators import filters as L
    import datetime as dt

    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    o = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    text = plan(L.custom_filter(o, "o_totalprice", [("greaterThan", 1000.0)]).filter(L.relative_date(F.col("o_orderdate"), "thisYear", dt.date(1997, 5, 1))).select("o_orderkey"))
    assert "GreaterThan(o_totalprice,1000.0)" in text and "GreaterThanOrEqual(o_orderdate" in text
    assert "o_orderpriority" not in text
