"""Work and memory that must not outgrow the input: ranges, slices, merges, pivot caches, workbooks."""

import random
from contextlib import contextmanager

from pyspark.sql import functions as F

from gridspark import scale
from gridspark.operators import grid, ranges, structure


@contextmanager
def settings(spark, **values):
    """Session settings for a while; names without ``spark.sql.``."""
    names = {f"spark.sql.{n}": v for n, v in values.items()}
    before = {n: spark.conf.get(n, None) for n in names}
    try:
        for n, v in names.items():
            spark.conf.set(n, v)
        yield
    finally:
        for n, v in before.items():
            spark.conf.unset(n) if v is None else spark.conf.set(n, v)


def plan_of(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_running_max(spark):
    rows = [("a", i, v) for i, v in enumerate((None, 3, 1, None, 7, 2))] + [(None, 0, 5), (None, 9, 4)]
    out = scale.running(spark.createDataFrame(rows, "k string, i long, v long"), ["k"], ["i"], {"m": ("max", F.col("v"))}, scale.block_of("i", 2))
    assert {(r["k"], r["i"]): r["m"] for r in out.collect()} == {
        ("a", 0): None, ("a", 1): 3, ("a", 2): 3, ("a", 3): 3, ("a", 4): 7, ("a", 5): 7, (None, 0): 5, (None, 9): 5}


def test_range_set_compares_no_two_ranges(spark):
    r = random.Random(3)
    rows = []
    for i in range(900):
        c, low = r.randrange(1, 13), r.randrange(1, 700)
        rows.append(("b", f"s{i % 2}", c, low, c + r.randrange(5), low + r.randrange(60)))
    rows += rows[:20] + [("b", "wide", 1, 1, 16384, 9), ("b", "wide", 5, 2, 16384, 9), ("b", "wide", 2, 1, 16383, 10), ("b", "one", 4, 4, 4, 4)]
    rows += [("b", None, 1, 1, 9, 9), ("b", None, 2, 2, 3, 3), ("b", "s0", 1, None, 9, 9), ("b", "s0", 1, None, 9, 9)]
    known = {x for x in rows if None not in x}
    covers = lambda q, p: q != p and q[:2] == p[:2] and q[2] <= p[2] and q[3] <= p[3] and q[4] >= p[4] and q[5] >= p[5]
    want = {p for p in known if not any(covers(q, p) for q in known)} | {x for x in rows if None in x}
    made = spark.createDataFrame(rows, "book string, sheet string, min_col int, min_row int, max_col int, max_row int")
    for tile in (16, 256):
        out = ranges.range_set(made, tile)
        got = [tuple(x)[:6] for x in out.collect()]
        assert set(got) == want and len(got) == len(want)
    assert not [line for line in plan_of(out).splitlines() if "Join" in line and ("<=" in line or ">=" in line)]


def test_records_of_one_popular_item_are_dealt(spark):
    records = spark.range(4000).select(
        F.when(F.col("id") % 2000 == 0, None).otherwise(F.lit("c")).alias("cache"), F.col("id").alias("rec"),
        F.array(F.struct(F.when(F.col("id") % 100 == 1, "n").when(F.col("id") % 100 == 2, "m").otherwise("x").alias("kind"),
                         F.when(F.col("id") % 100 == 3, "9").otherwise("0").alias("v"))).alias("items"))
    items = spark.createDataFrame([("c", 0, 0, "zero"), ("c", 0, 1, "one"), ("c", 1, 9, "other")], "cache string, field int, idx int, v string")
    with settings(spark, **{"adaptive.enabled": "false", "autoBroadcastJoinThreshold": "-1", "shuffle.partitions": "8"}):
        out = grid.decode_pivot_cache(records, items, {0: "name"})
        assert out.columns == ["cache", "rec", "name"]
        got = out.withColumn("at", F.spark_partition_id()).collect()
    want = {i: "0" if i % 100 == 1 else None if i % 100 in (2, 3) or i % 2000 == 0 else "zero" for i in range(4000)}
    assert len(got) == 4000 and {r["rec"]: r["name"] for r in got} == want
    sizes = [sum(r["at"] == p for r in got) for p in range(8)]
    assert max(sizes) < 1000, sizes


def test_slices_read_their_key_once(spark, make_cells):
    cells = make_cells({("s", "A1"): 1, ("s", "B2"): 2, ("s", "D5"): 3, ("s", "E1"): 4})
    for key, want in {"A2:C5": {2}, "B:D": {2, 3}, "4:10": {3}, "E1": {4}, "b2": {2}, "$B$2": {2}, "no key": set()}.items():
        out = structure.slice_cells(cells, key)
        assert {r["v_num"] for r in out.collect()} == want, key
        assert "lambda" not in plan_of(out)


def nodes(plan):
    yield plan
    for i in range(plan.children().size()):
        yield from nodes(plan.children().apply(i))


def test_merges_meet_only_the_anchors_that_are_there(spark, make_cells):
    cells = make_cells({("s", "A1"): 1, ("s", "B1"): 2, ("s", "C1"): 3, ("s", "C3"): 4, ("t", "A1"): 5})
    bounds = "book string, sheet string, min_col int, min_row int, max_col int, max_row int"
    merges = spark.createDataFrame([("b", "s", 1, 1, 2, 1), ("b", "s", 2, 3, 3, 4), ("b", "s", 2, 3, 3, 4), ("b", "u", 1, 1, 2, 2)], bounds)
    out = structure.merge_cells(cells, merges)
    got = sorted((r["sheet"], r["row"], r["col"], r["v_num"]) for r in out.collect())
    assert got == [("s", 1, 1, 1.0), ("s", 1, 3, 3.0), ("s", 3, 2, None), ("t", 1, 1, 5.0), ("u", 1, 1, None)]
    anti = [n for n in nodes(out._jdf.queryExecution().optimizedPlan()) if n.nodeName() == "Join" and n.joinType().toString() == "LeftAnti"]
    assert [n.right().nodeName() for n in anti] == ["Aggregate"]

def test_ranges_are_expanded_without_regrouping_their_cells(spark):
    texts = ["B2:C4 C4", "C4 B2:C4", "A1:B2 B1:C3 b2 A1:B2", "A1", "D2 ? D2", None, "A1", "B3:A1 A2"]
    df = spark.createDataFrame([(i // 2, x) for i, x in enumerate(texts)] + [(0, texts[0])], "id int, ref string")
    from gridspark.sources.ooxml import place

    for by in ("row", "col"):
        want = {}
        for i, text in enumerate(texts):
            for part in (text or "?").split():
                if part == "?":
                    continue
                (r1, c1), (r2, c2) = (place(p) for p in (part.split(":") * 2)[:2])
                wide, high = c2 - c1 + 1, r2 - r1 + 1
                for r in range(min(r1, r2), max(r1, r2) + 1):
                    for c in range(min(c1, c2), max(c1, c2) + 1):
                        at = (r - r1) * wide + c - c1 if by == "row" else (c - c1) * high + r - r1
                        key = (i // 2, text, r, c)
                        want[key] = min(want.get(key, at), at)
        out = ranges.expand_ranges(df, "ref", by)
        assert out.columns == ["id", "ref", "row", "col", "cell", "at"]
        got = [((r["id"], r["ref"], r["row"], r["col"]), r["at"]) for r in out.collect()]
        assert dict(got) == want and len(got) == len(want)
        kinds = [n.nodeName() for n in nodes(out._jdf.queryExecution().optimizedPlan())]
        assert "Aggregate" not in kinds[: len(kinds) - kinds[::-1].index("Generate")]

def test_sheets_are_written_many_rows_at_once():
    import io

    from gridspark.sources import ooxml

    held = io.BytesIO()
    sheet, calls = ooxml.SheetWriter(held, "s"), []
    write = sheet.out.write
    sheet.out.write = lambda data: calls.append(len(data)) or write(data)
    for i in range(1000):
        sheet.append([i, None, f"t{i}"] if i % 7 else [None])
    sheet.close()
    assert len(calls) < 10
    book = ooxml.Workbook(held)
    got = [x[:4] for x in book.raw_cells(next(book.worksheets(None))[1], [])]
    assert got == [x for i in range(1000) if i % 7 for x in ((i + 1, 1, "n", str(i)), (i + 1, 3, "inlineStr", f"t{i}"))]

def test_scans_pass_on_the_wanted_columns_only(spark, tmp_path):
    from gridspark.sources import ooxml, workbook

    with open(tmp_path / "a.xlsx", "wb") as out:
        sheet = ooxml.SheetWriter(out, "s")
        sheet.append([1, "two", {"formula": "=A1*2", "value": 2}])
        sheet.append([4, None, None, 5])
        sheet.close()
    (tmp_path / "broken.xlsx").write_bytes(b"no archive")
    got = {(r["book"], r["row"], r["col"], r["v"]) for r in workbook.scan_raw(spark, str(tmp_path), cols=[2, 4]).collect()}
    assert {x for x in got if x[0] == "a.xlsx"} == {("a.xlsx", 1, 2, "two"), ("a.xlsx", 2, 4, "5")}
    assert [x[1:3] for x in got if x[0] == "broken.xlsx"] == [(None, None)]
    typed = workbook.scan_workbooks(spark, str(tmp_path), cols=[3]).filter("book = 'a.xlsx'").collect()
    assert [(r["col"], r["v_str"], r["dtype"]) for r in typed] == [(3, "=A1*2", "f")]
