"""Structural operations on cells: insert, delete, move, merge, fill, slice, view."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridspark.functions import coords as C
from gridspark.operators.grid import SHEET, VALUES, from_a1, sheet_rows, text_of
from gridspark.scale import running, tile_join

ROW_BLOCK = 65536


def row_block() -> Column:
    """Order block of sheet rows."""
    return F.floor(F.col("row") / ROW_BLOCK)


def _insert(cells: DataFrame, axis: str, before: int, n: int) -> DataFrame:
    return cells.withColumn(axis, F.when(F.col(axis) >= before, F.col(axis) + n).otherwise(F.col(axis)))


def _delete(cells: DataFrame, axis: str, first: int, n: int) -> DataFrame:
    kept = cells.filter((F.col(axis) < first) | (F.col(axis) >= first + n))
    return kept.withColumn(axis, F.when(F.col(axis) >= first + n, F.col(axis) - n).otherwise(F.col(axis)))


def insert_rows(cells: DataFrame, before: int, n: int = 1) -> DataFrame:
    return _insert(cells, "row", before, n)


def insert_cols(cells: DataFrame, before: int, n: int = 1) -> DataFrame:
    return _insert(cells, "col", before, n)


def delete_rows(cells: DataFrame, first: int, n: int = 1) -> DataFrame:
    return _delete(cells, "row", first, n)


def delete_cols(cells: DataFrame, first: int, n: int = 1) -> DataFrame:
    return _delete(cells, "col", first, n)


def _within(bounds: tuple[int, int, int, int]) -> Column:
    c1, r1, c2, r2 = bounds
    return F.col("row").between(r1, r2) & F.col("col").between(c1, c2)


def move_range(
    cells: DataFrame, bounds: tuple[int, int, int, int], rows: int, cols: int, translate: bool = False
) -> DataFrame:
    """Move a rectangle on every sheet; moved cells replace what lies at their target.

    Only cells of the source and target rectangles are regrouped by position;
    all others pass by untouched.
    """
    c1, r1, c2, r2 = bounds
    source, target = _within(bounds), _within((c1 + cols, r1 + rows, c2 + cols, r2 + rows))
    near = cells.filter(source | target)
    moved = near.withColumn("__in", source)
    if translate:
        from gridspark.operators.formulas import translate_formulas

        moved = translate_formulas(
            moved, "formula", F.when(F.col("__in"), F.lit(rows)).otherwise(0), F.when(F.col("__in"), F.lit(cols)).otherwise(0)
        )
    by = lambda d: F.when(F.col("__in"), F.lit(d)).otherwise(0)
    best = moved.groupBy(*SHEET, (F.col("row") + by(rows)).alias("row"), (F.col("col") + by(cols)).alias("col")).agg(
        F.max_by(F.struct(*VALUES), F.col("__in").cast("int")).alias("__v")
    )
    return cells.filter(~(source | target)).unionByName(best.select(*SHEET, "row", "col", "__v.*"))


def merge_cells(cells: DataFrame, merges: DataFrame) -> DataFrame:
    """Merged ranges keep only their top-left value; a missing anchor is created empty."""
    kept = tile_join(cells, merges, "left").filter(
        F.col("r_min_row").isNull() | ((F.col("row") == F.col("r_min_row")) & (F.col("col") == F.col("r_min_col")))
    ).select(*cells.columns)
    anchors = merges.select(*SHEET, F.col("min_row").alias("row"), F.col("min_col").alias("col"))
    # the anchors that are there, not all cells, meet the anchors
    there = tile_join(cells.select(*SHEET, "row", "col"), merges).filter(
        (F.col("row") == F.col("r_min_row")) & (F.col("col") == F.col("r_min_col"))
    ).select(*SHEET, "row", "col").distinct()
    missing = anchors.join(there, [*SHEET, "row", "col"], "left_anti").distinct()
    return kept.unionByName(missing, allowMissingColumns=True)


def unmerge_cells(cells: DataFrame, merges: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Drop the covered cells of merged ranges, keep their anchors.

    With the ranges merged so far as ``known``, a range that is not among them fails the job.
    """
    if known is not None:
        place = [*SHEET, "min_col", "min_row", "max_col", "max_row"]
        checked = merges.join(known.select(*place, F.lit(True).alias("__known")).distinct(), place, "left")
        text = F.concat(F.lit("not merged: "), F.col("sheet"), F.lit("!"), C.coord(F.col("min_col"), F.col("min_row")), F.lit(":"), C.coord(F.col("max_col"), F.col("max_row")))
        merges = checked.withColumn("min_row", F.when(F.col("__known"), F.col("min_row")).otherwise(F.raise_error(text).cast("int"))).drop("__known")
    covered = tile_join(cells, merges).filter(
        (F.col("row") != F.col("r_min_row")) | (F.col("col") != F.col("r_min_col"))
    )
    return cells.join(covered.select(*SHEET, "row", "col").distinct(), [*SHEET, "row", "col"], "left_anti")


def fill_down(df: DataFrame, keys: list[str], cols: list[str], order: list[str], block: Column) -> DataFrame:
    """Blank labels take the label above."""
    outputs = {f"__f_{c}": ("last", F.col(c)) for c in cols}
    filled = running(df, keys, order, outputs, block)
    return filled.withColumns({c: F.col(f"__f_{c}") for c in cols}).drop(*outputs)


def suppress_repeats(df: DataFrame, keys: list[str], levels: list[str], order: list[str], block: Column) -> DataFrame:
    """A label shows only where it or a label left of it changed from the row above."""
    seen = running(df, keys, order, {"__up": ("lag", F.struct(*levels))}, block)
    changed = F.col("__up").isNull()
    shown = {}
    for c in levels:
        changed = changed | ~F.col(c).eqNullSafe(F.col(f"__up.{c}"))
        shown[c] = F.when(changed, F.col(c))
    return seen.withColumns(shown).drop("__up")


def slice_test(key: str) -> Column:
    """Whether a cell lies in ``A1``, ``A2:C5``, ``A:D`` or ``4:10``; the key is read once, at plan time."""
    # the optimizer would leave the parsing of a constant to every cell
    b = SparkSession.active().range(1).select(C.range_bounds(F.lit(key)).alias("b")).first()["b"]
    if b is None:
        return F.lit(False)
    within = lambda axis: F.coalesce(F.col(axis).between(b[f"min_{axis}"], b[f"max_{axis}"]), F.lit(True))
    return within("row") & within("col")


def slice_cells(cells: DataFrame, key: str) -> DataFrame:
    """The cells of a key, from every sheet."""
    return cells.filter(slice_test(key))


def iter_rows(cells: DataFrame, bounds: DataFrame | None = None) -> DataFrame:
    """One array of texts per row, NULL for blanks, left to right."""
    return _views(cells, sheet_rows(from_a1(cells) if bounds is None else bounds), "row", "col", None)


def iter_cols(cells: DataFrame, bounds: DataFrame | None = None, chunk: int = ROW_BLOCK) -> DataFrame:
    """One array of texts per column, top to bottom, in chunks of at most ``chunk`` rows."""
    bounds = from_a1(cells) if bounds is None else bounds
    return _views(cells, bounds.withColumn("col", F.explode(F.sequence("min_col", "max_col"))), "col", "row", chunk)


def _views(cells: DataFrame, lines: DataFrame, by: str, along: str, chunk: int | None) -> DataFrame:
    """The cells of every line in order; the gaps between them are filled in the line's own array."""
    first, last = F.col(f"min_{along}"), F.col(f"max_{along}")
    part, parts = F.lit(0), F.array(F.lit(0))
    if chunk:
        part = F.floor(F.col(along) / chunk).cast("int")
        parts = F.sequence(F.floor(first / chunk).cast("int"), F.floor(last / chunk).cast("int"))
        first, last = F.greatest(first, F.col("part") * chunk), F.least(last, (F.col("part") + 1) * chunk - 1)
    frame = lines.withColumn("part", F.explode(parts)).select(*SHEET, by, "part", first.alias("__first"), last.alias("__last"))
    item = F.struct(F.col(along).alias("at"), text_of().alias("text"))
    found = cells.groupBy(*SHEET, by, part.alias("part")).agg(F.array_sort(F.collect_list(item)).alias("__all"))
    inside = F.filter(F.coalesce("__all", F.array()), lambda x: x["at"].between(F.col("__first"), F.col("__last")))
    views = frame.join(found, [*SHEET, by, "part"], "left").withColumn("__v", inside)
    blanks = lambda n: F.array_repeat(F.lit(None).cast("string"), n.cast("int"))
    before = F.col("__first") - 1
    filled = F.transform("__v", lambda x, i: F.concat(blanks(x["at"] - F.coalesce(F.get("__v", i - 1)["at"], before) - 1), F.array(x["text"])))
    rest = blanks(F.col("__last") - F.coalesce(F.try_element_at("__v", F.lit(-1))["at"], before))
    return views.select(*SHEET, by, "part", F.concat(F.flatten(filled), rest).alias("values"))


def copy_sheet(cells: DataFrame, which: Column, title: Column | None = None) -> DataFrame:
    """Cells plus a copy of the chosen sheets, titled ``<title> Copy``."""
    name = title if title is not None else F.concat("sheet", F.lit(" Copy"))
    return cells.unionByName(cells.filter(which).withColumn("sheet", name))


def outline(cells: DataFrame, groups: DataFrame, axis: str = "row") -> DataFrame:
    """Outline level and hidden flag per cell from groups(book, sheet, start, end, level, hidden)."""
    span = {"row": ("min_row", "max_row", "min_col", "max_col"), "col": ("min_col", "max_col", "min_row", "max_row")}[axis]
    wide = C.MAX_COLUMN if axis == "row" else C.MAX_SHEET_ROW
    ranges = groups.select(
        *SHEET, "level", "hidden",
        F.col("start").alias(span[0]), F.col("end").alias(span[1]), F.lit(1).alias(span[2]), F.lit(wide).alias(span[3]),
    )
    # levels belong to lines, of which there are far fewer than cells
    lines = cells.select(*SHEET, axis).distinct().withColumn("col" if axis == "row" else "row", F.lit(1))
    found = tile_join(lines, ranges).groupBy(*SHEET, axis).agg(F.max("r_level").alias("level"), F.max("r_hidden").alias("hidden"))
    placed = cells.join(found, [*SHEET, axis], "left").select(*cells.columns, "level", "hidden")
    return placed.withColumns({"level": F.coalesce("level", F.lit(0)), "hidden": F.coalesce("hidden", F.lit(False))})
