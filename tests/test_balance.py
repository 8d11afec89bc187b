"""Blocks cut by counted rows, order statistics over them, item order, moving averages, degrees without edges."""

import random

import pytest
from pyspark.sql import functions as F

from gridspark.operators import formulas as E
from gridspark.operators import pivot, series, stats
from gridspark.scale import balanced, running


def sizes(df, name="__part"):
    return [r.n for r in df.groupBy(name).agg(F.count(F.lit(1)).alias("n")).collect()]


FAR = "CASE WHEN id = 0 THEN -1e9 ELSE (id * 7919 % 1000003) / 1000.0 END"


@pytest.mark.parametrize("value", [FAR, "pow(1.00002D, id) ", "cast(id as double)", "CASE WHEN id < 500000 THEN id * 1e-12 ELSE id * 1e6 END"])
def test_no_block_is_twice_the_mean(spark, value):
    values = spark.range(1_000_000).select(F.expr(value).cast("double").alias("v")).filter("v is not null")
    held = sizes(stats.value_blocks(values, F.col("v")))
    assert max(held) < 2 * sum(held) / len(held) and len(held) == 8


def test_order_statistics_beside_a_far_value(spark):
    df = spark.range(100_001).select(F.when(F.col("id") == 0, -1e9).otherwise(F.col("id") % 1000).cast("double").alias("v"))
    values = sorted([-1e9] + [float(i % 1000) for i in range(1, 100_001)])
    got = spark.range(1).select(stats.percentiles(df, F.col("v"), [0, 0.25, 0.5, 0.901, 1]).alias("p")).first().p
    for g, p in zip(got, [0, 0.25, 0.5, 0.901, 1], strict=True):
        at = p * (len(values) - 1)
        low = int(at)
        high = min(low + 1, len(values) - 1)
        assert abs(g - (values[low] + (values[high] - values[low]) * (at - low))) < 1e-6
    edge = spark.range(1).select(stats.top_threshold(df, "v", 10, percent=True).alias("e")).first().e
    assert edge == values[len(values) - len(values) // 10]


def test_scans_without_keys_have_no_bare_window(spark):
    df = spark.createDataFrame([(i, 5 - i % 3, None if i % 4 == 0 else i) for i in range(200)], "id int, g int, v int")
    out = running(balanced(df, F.col("id")), [], ["id"], {"n": ("row_number", None), "s": ("sum", F.col("v"))}, F.col("__part"))
    got = {r.id: (r.n, r.s) for r in out.collect()}
    total = 0
    for i in range(200):
        total += 0 if i % 4 == 0 else i
        assert got[i] == (i + 1, total)
    assert running(balanced(df.limit(0), F.col("id")), [], ["id"], {"n": ("row_number", None)}, F.col("__part")).count() == 0


def bare_windows(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.split("\n") if "Window" in line and "SinglePartition" in line] + [line for line in plan.split("\n") if "Exchange SinglePartition" in line and "rank" in line]


def test_a_million_items_in_order(spark):
    items = spark.range(1_000_000).select(F.concat(F.lit("k"), F.pmod(F.xxhash64("id"), F.lit(10**9)), F.lit("-"), "id").alias("item"), (F.col("id") % 10).alias("total"))
    by_label = pivot.sort_items(items, "item")
    plan = by_label._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" in plan and "windowspecdefinition(item" not in plan  # every window has its block as partition
    assert by_label.agg(F.count_distinct("place"), F.max("place")).first()[:] == (1_000_000, 1_000_000)
    top = [r.item for r in by_label.filter("place <= 50").orderBy("place").collect()]
    assert top == [r.item for r in items.orderBy("item").limit(50).collect()]
    by_field = pivot.sort_items(items, "item", "descending", by="total").filter("place <= 100000")
    assert by_field.agg(F.min("total"), F.count(F.lit(1))).first()[:] == (9, 100_000)
    named = spark.createDataFrame([("b", 1), ("a", 1), (None, 3), ("c", 2)], "item string, total int")
    assert [r.item for r in pivot.sort_items(named, "item", "manual", manual=["c", "b"]).orderBy("place").collect()] == ["c", "b", None, "a"]


@pytest.mark.parametrize("x", ["id * 1000000 + 1700000000000000", "7", "CASE WHEN id < 10 THEN id ELSE 1000000000 + id % 100 END"])
def test_moving_average_blocks_do_not_follow_x(spark, x):
    points = spark.range(200_000).select(F.lit("s").alias("series"), F.expr(x).cast("long").alias("x"), (F.col("id") % 100).cast("double").alias("y"))
    tied = points.withColumn("__tie", F.xxhash64(*points.columns, F.monotonically_increasing_id()))
    held = sizes(balanced(tied, F.col("series"), F.col("x"), F.col("__tie")))
    assert max(held) < 2 * sum(held) / len(held)
    out = series.moving_avg(points, ["series"], 3)
    assert out.columns == ["series", "x", "y", "ma"] and out.count() == 200_000 and out.filter("ma is null").count() == 2


def formulas(spark, rows):
    return spark.createDataFrame([("b", s, r, c, f) for s, r, c, f in rows], "book string, sheet string, row int, col int, formula string")


def test_degrees_equal_those_of_the_edges(spark):
    rnd = random.Random(5)
    place = lambda: ("s" + str(rnd.randint(1, 2)), rnd.randint(1, 40), rnd.randint(1, 30))
    cells = spark.createDataFrame([("b", *p) for p in {place() for _ in range(300)}], "book string, sheet string, row int, col int")
    letter = lambda c: ("" if c < 27 else chr(64 + (c - 1) // 26)) + chr(65 + (c - 1) % 26)

    def reference():
        kind = rnd.randint(0, 5)
        a, b = sorted(rnd.randint(1, 30) for _ in range(2))
        r, q = sorted(rnd.randint(1, 40) for _ in range(2))
        if kind == 0:
            return f"{letter(a)}:{letter(b)}"
        if kind == 1:
            return f"{r}:{q}"
        if kind == 2:
            return f"{letter(a)}{r}"
        return ("s2!" if kind == 3 else "") + f"{letter(a)}{r}:{letter(b)}{q}"

    rows = [("s1", 100 + i, 1, "=" + "+".join(f"SUM({reference()})" for _ in range(rnd.randint(1, 4)))) for i in range(80)]
    rows += [("s1", 500, 1, "=1+2"), ("s1", 501, 1, "=ZZZ9999"), ("s1", 502, 1, "=A1+A1+A1")]
    tokens = E.formula_tokens(formulas(spark, rows))
    slow = sorted(map(tuple, E.degrees(E.formula_edges(cells, tokens)).collect()))
    fast = E.cell_degrees(cells, tokens)
    assert sorted(map(tuple, fast.select("book", "sheet", "row", "col", "out_degree", "in_degree").collect())) == slow
    assert E.cell_degrees(cells.limit(0), tokens).count() == 0


def test_many_formulas_over_a_whole_column(spark):
    n = 100_000
    cells = spark.range(1, 1001).select(F.lit("b").alias("book"), F.lit("s").alias("sheet"), F.col("id").cast("int").alias("row"), F.lit(1).alias("col"))
    rows = spark.range(n).select(F.lit("b").alias("book"), F.lit("s").alias("sheet"), F.col("id").cast("int").alias("row"), F.lit(2).alias("col"), F.lit("=SUM(A:A)").alias("formula"))
    got = E.cell_degrees(cells, E.formula_tokens(rows)).groupBy("col").agg(F.count(F.lit(1)).alias("k"), F.min("out_degree"), F.max("out_degree"), F.min("in_degree"), F.max("in_degree"))
    assert sorted(map(tuple, got.collect())) == [(1, 1000, 0, 0, n, n), (2, n, 1000, 1000, 0, 0)]


def test_rectangles_apart_and_strips():
    rnd = random.Random(1)
    for _ in range(200):
        boxes = []
        for _ in range(rnd.randint(1, 5)):
            c, r = sorted(rnd.randint(1, 12) for _ in range(2)), sorted(rnd.randint(1, 12) for _ in range(2))
            boxes.append((c[0], r[0], c[1], r[1]))
        want = {(c, r) for a, b, x, y in boxes for c in range(a, x + 1) for r in range(b, y + 1)}
        got = [(c, r) for a, b, x, y in E.apart(boxes) for c in range(a, x + 1) for r in range(b, y + 1)]
        assert len(got) == len(set(got)) and set(got) == want
    for first, last in [(1, 1), (1, 18278), (17, 40), (4096, 8191)]:
        cols = [c for k, i in E.strips(first, last) for c in range(i << k, (i + 1) << k)]
        assert cols == list(range(first, last + 1))
