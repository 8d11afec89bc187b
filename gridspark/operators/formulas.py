"""Formula analytics over all formula cells: tokens, audit, translation, shared formulas, edges."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridspark.functions import coords as C
from gridspark.functions import formula_text
from gridspark.operators.grid import SHEET
from gridspark.scale import block_of, hot_keys, running, salted_join, split_join, tile_join
from gridspark.session import cut_lineage

ROW_BLOCK = 1 << 14
_TOKEN = "array<struct<value:string,type:string,subtype:string>>"


def tokenize(c: Column) -> Column:
    """Array of (value, type, subtype), worked out in Arrow batches."""

    @F.arrow_udf(_TOKEN)
    def run(formulas: pa.Array) -> pa.Array:
        values, types, subtypes, ends = [], [], [], [0]
        known: dict[str, list] = {}
        for f in formulas.to_pylist():
            found = known.get(f)
            if found is None:
                found = known[f] = formula_text.tokens(f)
            for v, t, s in found:
                values.append(v)
                types.append(t)
                subtypes.append(s)
            ends.append(len(values))
        text = lambda xs: pa.array(xs, pa.string())
        items = pa.StructArray.from_arrays([text(values), text(types), text(subtypes)], ["value", "type", "subtype"])
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), items)

    return run(c)


def formula_tokens(df: DataFrame, column: str = "formula") -> DataFrame:
    """One row per token with its place ``pos``; other columns are kept."""
    toks = df.withColumn("__t", tokenize(F.col(column)))
    return toks.select(*df.columns, F.posexplode("__t").alias("pos", "__tok")).select(*df.columns, "pos", "__tok.*")


def formula_audit(tokens: DataFrame, known: DataFrame) -> DataFrame:
    """Function calls whose name is not in ``known(name)``; ``_xlfn.`` names are exempt."""
    calls = tokens.filter((F.col("type") == "FUNC") & (F.col("subtype") == "OPEN"))
    named = calls.withColumn("name", F.expr("left(value, length(value) - 1)")).filter(~F.col("name").startswith("_xlfn."))
    return salted_join(named, known.select("name").distinct(), ["name"], "left_anti")


def translate(formula: Column, rows: Column, cols: Column) -> Column:
    """Formula moved by rows and columns; NULL when a reference leaves the sheet."""

    @F.arrow_udf("string")
    def run(f: pa.Array, r: pa.Array, c: pa.Array) -> pa.Array:
        moves = zip(f.to_pylist(), r.to_pylist(), c.to_pylist())
        return pa.array([None if x is None else formula_text.shift_formula(x, a, b) for x, a, b in moves], pa.string())

    return run(formula, rows.cast("int"), cols.cast("int"))


def translate_formulas(df: DataFrame, column: str, rows: Column, cols: Column) -> DataFrame:
    return df.withColumn(column, translate(F.col(column), rows, cols))


def expand_shared(cells: DataFrame) -> DataFrame:
    """Dependents of a shared formula (``si`` set, no text) get the master's text, moved to them."""
    masters = cells.filter(F.col("si").isNotNull() & F.col("formula").isNotNull()).groupBy(*SHEET, "si").agg(
        F.min_by(F.struct("formula", "row", "col"), F.struct("row", "col")).alias("__m")
    )
    open_cell = F.col("si").isNotNull() & F.col("formula").isNull()
    plain = cells.filter(~open_cell)
    linked = split_join(cells.filter(open_cell), masters, [*SHEET, "si"], "inner")
    moved = linked.withColumn(
        "formula", translate(F.col("__m.formula"), F.col("row") - F.col("__m.row"), F.col("col") - F.col("__m.col"))
    )
    return plain.unionByName(moved.select(*cells.columns))


def spread_arrays(cells: DataFrame, arrays: DataFrame) -> DataFrame:
    """Cells of array formulas: each with the text and the range of its array, keeping its own cached value.

    arrays(book, sheet, ref, formula, at), as ``scan_arrays`` gives them: ``at`` is the anchor, the one cell that stores the
    formula. Adds ``array_formula``, ``array_ref`` and ``anchor``; NULL outside arrays. Of overlapping arrays
    the one anchored first by row and column counts.
    """
    b = C.range_bounds(F.col("ref"))
    anchor = C.parse_coord(F.col("at"))
    placed = arrays.withColumns({"__b": b, "__a": anchor}).filter("__b is not null").select(
        *SHEET, *[F.col(f"__b.{c}").alias(c) for c in ("min_col", "min_row", "max_col", "max_row")], "ref", "formula", F.struct("__a.row", "__a.col").alias("at"))
    met = tile_join(cells.select(*SHEET, "row", "col"), placed).groupBy(*SHEET, "row", "col").agg(F.min_by(F.struct("r_formula", "r_ref", "r_at"), "r_at").alias("__f"))
    out = cells.join(met, [*SHEET, "row", "col"], "left")
    return out.select(
        *cells.columns, F.col("__f.r_formula").alias("array_formula"), F.col("__f.r_ref").alias("array_ref"),
        F.when(F.col("__f").isNotNull(), (F.col("__f.r_at.row") == F.col("row")) & (F.col("__f.r_at.col") == F.col("col"))).alias("anchor"),
    )


def formula_ranges(tokens: DataFrame) -> DataFrame:
    """Range operands with their bounds; a reference without a sheet means its own sheet."""
    ranges = tokens.filter(F.col("subtype") == "RANGE")
    q = C.qualified_range(F.col("value"))
    local = C.range_bounds(F.col("value"))
    placed = ranges.withColumns({"__q": q, "__b": local})
    b = F.coalesce(F.col("__q.bounds"), F.col("__b"))
    return placed.withColumn("__r", b).filter(F.col("__r").isNotNull()).select(
        F.col("book"),
        F.coalesce("__q.sheet", "sheet").alias("sheet"),
        F.col("sheet").alias("from_sheet"),
        F.col("row").alias("from_row"),
        F.col("col").alias("from_col"),
        F.coalesce("__r.min_col", F.lit(1)).alias("min_col"),
        F.coalesce("__r.min_row", F.lit(1)).alias("min_row"),
        F.coalesce("__r.max_col", F.lit(C.MAX_COLUMN)).alias("max_col"),
        F.coalesce("__r.max_row", F.lit(C.MAX_SHEET_ROW)).alias("max_row"),
    )


def formula_edges(cells: DataFrame, tokens: DataFrame) -> DataFrame:
    """Edges from formula cells to the existing cells they read."""
    hit = tile_join(cells.select(*SHEET, "row", "col"), formula_ranges(tokens))
    return hit.select(
        "book", F.col("r_from_sheet").alias("from_sheet"), F.col("r_from_row").alias("from_row"), F.col("r_from_col").alias("from_col"), "sheet", "row", "col"
    ).distinct()


def degrees(edges: DataFrame) -> DataFrame:
    """Out-degree (cells read) and in-degree (formulas reading) per cell."""
    out = edges.select("book", F.col("from_sheet").alias("sheet"), F.col("from_row").alias("row"), F.col("from_col").alias("col"), F.lit(1).alias("o"), F.lit(0).alias("i"))
    into = edges.select(*SHEET, "row", "col", F.lit(0).alias("o"), F.lit(1).alias("i"))
    return out.unionByName(into).groupBy(*SHEET, "row", "col").agg(F.sum("o").alias("out_degree"), F.sum("i").alias("in_degree"))


# --- degrees without edges -----------------------------------------------------------

_LEVELS = (0, 4, 8, 12)  # column strips of 1, 16, 256 and 4096 columns


def apart(rectangles: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
    """The same cells as rectangles that do not overlap; neighbours with the same rows are one."""
    edges = sorted({x for a, _, c, _ in rectangles for x in (a, c + 1)})
    out: list[tuple[int, int, int, int]] = []
    open_: dict[tuple[int, int], int] = {}  # rows that the strip on the left has -> its first column
    for left, right in zip(edges, [*edges[1:], None], strict=True):
        rows: list[list[int]] = []
        if right is not None:
            for _, r1, _, r2 in sorted((r for r in rectangles if r[0] <= left and r[2] >= right - 1), key=lambda r: r[1]):
                if rows and r1 <= rows[-1][1] + 1:
                    rows[-1][1] = max(rows[-1][1], r2)
                else:
                    rows.append([r1, r2])
        here = {tuple(r) for r in rows}
        for gone in [r for r in open_ if r not in here]:
            out.append((open_.pop(gone), gone[0], left - 1, gone[1]))
        for r in here:
            open_.setdefault(r, left)
    return out


def strips(first: int, last: int) -> list[tuple[int, int]]:
    """Columns ``first`` to ``last`` as few aligned strips ``(level, index)``, counted from column 0."""
    out = []
    while first <= last:
        level = max(k for k in _LEVELS if first % (1 << k) == 0 and first + (1 << k) - 1 <= last)
        out.append((level, first >> level))
        first += 1 << level
    return out


def _pieces(ranges: Column) -> Column:
    """The cells of one formula's ranges on one sheet as disjoint (level, index, min_row, max_row), in Arrow batches."""

    @F.arrow_udf("array<struct<level:int,strip:int,min_row:int,max_row:int>>")
    def run(lists: pa.Array) -> pa.Array:
        out = []
        for items in lists.to_pylist():
            whole = apart([(r["min_col"], r["min_row"], r["max_col"], r["max_row"]) for r in items])
            out.append([{"level": k, "strip": i, "min_row": r1, "max_row": r2} for c1, r1, c2, r2 in whole for k, i in strips(c1, c2)])
        kind = pa.list_(pa.struct([(n, pa.int32()) for n in ("level", "strip", "min_row", "max_row")]))
        return pa.array(out, kind)

    return run(ranges)


def cell_degrees(cells: DataFrame, tokens: DataFrame) -> DataFrame:
    """Out-degree (existing cells read) and in-degree (formulas reading) per cell, without an edge per pair.

    The ranges of a formula are made disjoint and cut into column strips. Along the rows of each strip a range is +1
    where it starts and -1 behind its end; the running sum at a cell counts the formulas that read it. The running
    count of cells at a range's two ends tells how many it reads. Equal events and equal questions are put
    together before they are scanned, so work and output grow with cells and formulas. Cells and formulas with
    neither degree are left out.
    """
    strip = [*SHEET, "level", "strip"]
    ranges = formula_ranges(tokens)
    reader = ["book", "from_sheet", "from_row", "from_col"]
    box = F.struct("min_col", "min_row", "max_col", "max_row")
    read = ranges.groupBy(*reader, "sheet").agg(F.collect_set(box).alias("__boxes"))  # a formula's own, bounded by its text
    pieces = cut_lineage(read.select(*reader, "sheet", F.explode(_pieces(F.col("__boxes"))).alias("__p")).select(*reader, "sheet", "__p.*"))

    place = F.explode(F.array(*[F.struct(F.lit(k).alias("level"), F.shiftright("col", k).alias("strip")) for k in _LEVELS])).alias("__s")
    marks = cells.select(*SHEET, "row", "col").distinct().select(*SHEET, "row", "col", place).select(*SHEET, "__s.*", "row", "col")
    asked = pieces.select(*strip).distinct()
    marks = cut_lineage(salted_join(marks, asked, strip, "left_semi", hot=hot_keys(marks, strip)))

    starts = pieces.select(*strip, F.col("min_row").alias("row"), F.lit(1).alias("d"))
    ends = pieces.select(*strip, (F.col("max_row") + 1).alias("row"), F.lit(-1).alias("d"))
    events = starts.unionByName(ends).groupBy(*strip, "row").agg(F.sum("d").alias("d"))
    scan = events.withColumns({"kind": F.lit(0), "col": F.lit(0)}).unionByName(marks.withColumns({"kind": F.lit(1), "d": F.lit(0).cast("long")}))
    block = block_of("row", ROW_BLOCK)
    over = running(scan, strip, ["row", "kind", "col"], {"now": ("sum", F.col("d"))}, block).filter("kind = 1 and now > 0")
    into = over.groupBy(*SHEET, "row", "col").agg(F.sum("now").alias("in_degree"))

    before = pieces.withColumns({"row": F.col("min_row") - 1, "d": F.lit(-1)})
    upto = pieces.withColumns({"row": F.col("max_row"), "d": F.lit(1)})
    asks = before.unionByName(upto).select(*strip, "row", "d", *reader[1:])
    held = marks.groupBy(*strip, "row").agg(F.count(F.lit(1)).alias("c"))
    points = held.withColumn("kind", F.lit(0)).unionByName(asks.select(*strip, "row").distinct().withColumns({"c": F.lit(0).cast("long"), "kind": F.lit(1)}))
    counted = running(points, strip, ["row", "kind"], {"below": ("sum", F.col("c"))}, block).filter("kind = 1").select(*strip, "row", "below")
    answered = salted_join(asks, counted, [*strip, "row"], "inner", hot=hot_keys(asks, [*strip, "row"]))
    out = answered.groupBy("book", F.col("from_sheet").alias("sheet"), F.col("from_row").alias("row"), F.col("from_col").alias("col")).agg(F.sum(F.col("d") * F.col("below")).alias("out_degree"))
    zero = F.lit(0).cast("long")
    both = out.withColumn("in_degree", zero).unionByName(into.withColumn("out_degree", zero))
    return both.groupBy(*SHEET, "row", "col").agg(F.sum("out_degree").alias("out_degree"), F.sum("in_degree").alias("in_degree")).filter("out_degree > 0 or in_degree > 0")
