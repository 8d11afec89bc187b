"""Ranges and coordinates over tables: expand, collapse, range sets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridspark.functions import coords as C
from gridspark.scale import running, split_join

# rows of a block of the scans over a range set
SET_TILE = 256


def expand_ranges(df: DataFrame, column: str, by: str = "row", max_row: int = C.MAX_SHEET_ROW, max_col: int = C.MAX_COLUMN) -> DataFrame:
    """Range text (several ranges split by blanks) to its distinct cells with their place in the walk.

    ``by`` walks rows or columns first; ``at`` is the position within the range. Whole columns and
    rows reach to ``max_row`` and ``max_col``.
    """
    ends = {"min_col": 1, "min_row": 1, "max_col": max_col, "max_row": max_row}
    told = F.filter(F.transform(F.split(F.trim(F.col(column)), r"\s+"), C.range_bounds), lambda b: b.isNotNull())
    ready = F.transform(told, lambda b: F.struct(*[F.coalesce(b[k], F.lit(v)).alias(k) for k, v in ends.items()]))
    r, spot = F.col("__b"), F.col("__i")

    def at(b: Column) -> Column:
        down, right = F.col("row") - b["min_row"], F.col("col") - b["min_col"]
        return down * (b["max_col"] - b["min_col"] + 1) + right if by == "row" else right * (b["max_row"] - b["min_row"] + 1) + down

    span = lambda b, axis: (F.least(b[f"min_{axis}"], b[f"max_{axis}"]), F.greatest(b[f"min_{axis}"], b[f"max_{axis}"]))

    def meets(b: Column, axis: str) -> Column:
        (low, high), (first, last) = span(b, axis), span(r, axis)
        return (low <= last) & (high >= first)

    def nearer(other: Column) -> Column:
        b = other["b"]
        inside = F.col("row").between(*span(b, "row")) & F.col("col").between(*span(b, "col"))
        return inside & ((at(b) < F.col("at")) | ((at(b) == F.col("at")) & (other["i"] < spot)))

    # equal rows are one before they are expanded; a cell of several ranges of its row stays with the one that has it first
    parts = df.distinct().withColumn("__all", ready).select("*", F.posexplode("__all").alias("__i", "__b"))
    numbered = F.transform("__all", lambda b, i: F.struct(i.alias("i"), b.alias("b")))
    others = F.filter(numbered, lambda o: (o["i"] != spot) & meets(o["b"], "row") & meets(o["b"], "col"))
    rows = parts.withColumn("__others", others).drop("__all").withColumn("row", F.explode(F.sequence(r["min_row"], r["max_row"])))
    cells = rows.withColumn("col", F.explode(F.sequence(r["min_col"], r["max_col"]))).withColumn("at", at(r))
    kept = cells.filter((F.size("__others") == 0) | ~F.exists("__others", nearer))
    return kept.select(*df.columns, "row", "col", C.coord(F.col("col"), F.col("row")).alias("cell"), "at")


def collapse_cells(cells: DataFrame, keys: list[str]) -> DataFrame:
    """Cells to one vertical range per column, from its first to its last row even across gaps."""
    spans = cells.groupBy(*keys, "col").agg(
        F.min("row").alias("min_row"), F.max("row").alias("max_row"), F.count(F.lit(1)).alias("n")
    )
    first, last = C.coord(F.col("col"), F.col("min_row")), C.coord(F.col("col"), F.col("max_row"))
    text = F.when(F.col("n") == 1, first).otherwise(F.concat(first, F.lit(":"), last))
    return spans.select(*keys, "col", text.alias("range"))


def _holding(x: Column, levels: Column) -> Column:
    """The nodes that hold place ``x`` in a binary tree over places: one per level."""
    return F.transform(F.sequence(F.lit(0), levels), lambda k: F.call_function("shiftright", x, k) * 64 + k)


def _below(m: Column, levels: Column) -> Column:
    """The nodes that together hold the places below ``m``, each place once."""
    held = F.filter(F.sequence(F.lit(0), levels), lambda k: F.getbit(m, k) == 1)
    return F.transform(held, lambda k: (F.call_function("shiftright", m, k) - 1) * 64 + k)


def range_set(ranges: DataFrame, tile: int = SET_TILE) -> DataFrame:
    """Ranges of each sheet without those another range already covers.

    ranges(book, sheet, min_col, min_row, max_col, max_row). Equal ranges are
    kept once. No two ranges are compared: each stands at the few nodes of a tree over left and of one over
    right edges, and asks those nodes that hold the wider ranges how far down one of them reaches that
    starts no lower. This is one ordered scan per pair of nodes, in blocks of ``tile`` rows.
    """
    bounds = ["min_col", "min_row", "max_col", "max_row"]
    place = ["book", "sheet", *bounds]
    distinct = ranges.select(*place).distinct()
    known = F.lit(True)
    for c in place:
        known = known & F.col(c).isNotNull()
    # of ranges with the same edges on three sides, the longest covers the others
    longest = distinct.filter(known).groupBy("book", "sheet", "min_col", "max_col", "min_row").agg(F.max("max_row").alias("max_row"))
    widths = longest.groupBy("book", "sheet").agg(
        F.min("min_col").alias("__lo"), F.max("max_col").alias("__hi"),
        F.length(F.bin(F.greatest(F.max("min_col") - F.min("min_col"), F.max("max_col") - F.min("max_col")).cast("bigint"))).alias("__levels"),
    )
    edges = split_join(longest, widths, ["book", "sheet"], "inner").withColumns(
        {"__left": (F.col("min_col") - F.col("__lo")).cast("bigint"), "__right": (F.col("__hi") - F.col("max_col")).cast("bigint")}
    )
    left, right, levels = F.col("__left"), F.col("__right"), F.col("__levels")
    held = edges.select("book", "sheet", "min_row", "max_row", F.explode(_holding(left, levels)).alias("x"), right.alias("__right"), levels.alias("__levels"))
    posts = held.select("book", "sheet", "x", F.explode(_holding(right, levels)).alias("y"), "min_row", "max_row").groupBy(
        "book", "sheet", "x", "y", F.col("min_row").alias("row")).agg(F.max("max_row").alias("far"))
    # wider to the left, or as far left and wider to the right, or as wide and higher: ``late`` places a question before or after the posts of its row
    ask = lambda x, y, late: F.struct(x.alias("x"), y.alias("y"), F.lit(late).alias("late"))
    wider = F.flatten(F.transform(_below(left, levels), lambda x: F.transform(_below(right + 1, levels), lambda y: ask(x, y, 2))))
    longer = F.transform(_below(right, levels), lambda y: ask(left * 64, y, 2))
    asked = edges.select(*place, F.explode(F.concat(wider, longer, F.array(ask(left * 64, right * 64, 0)))).alias("__q"))
    questions = asked.select(*place, "__q.*").withColumn("row", F.col("min_row"))
    lines = posts.withColumn("late", F.lit(1)).unionByName(questions, allowMissingColumns=True)
    seen = running(lines, ["book", "sheet", "x", "y"], ["row", "late"], {"__reach": ("max", F.col("far"))}, F.floor(F.col("row") / tile))
    covered = seen.filter(F.col("min_col").isNotNull() & (F.col("__reach") >= F.col("max_row"))).select(*place)
    kept = longest.select(*place).join(covered, place, "left_anti").unionByName(distinct.filter(~known))
    return kept.withColumn("range", C.range_text(C.make_range(*[F.col(c) for c in bounds])))


def bounding_range(df: DataFrame, keys: list[str], column: str) -> DataFrame:
    """Union of many ranges: the bounding rectangle per key."""
    c = F.col(column)
    agg: list[Column] = [
        F.min(c["min_col"]).alias("min_col"),
        F.min(c["min_row"]).alias("min_row"),
        F.max(c["max_col"]).alias("max_col"),
        F.max(c["max_row"]).alias("max_row"),
    ]
    return df.groupBy(*keys).agg(*agg)
