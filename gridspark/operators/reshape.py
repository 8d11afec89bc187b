"""Reshaping ragged sheets into tidy tables, recoding, and parameter lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridspark.functions.scalars import normalise
from gridspark.operators.grid import SHEET, has_value, text_of
from gridspark.scale import hot_keys, salted_join, split_join

OPEN_TOP = 999999


# --- headers -------------------------------------------------------------------


def compose_header(cells: DataFrame, rows: list[int], overrides: dict[int, str] | None = None, sep: str = " ", strip: str = "both") -> DataFrame:
    """Label per column from stacked header rows joined by ``sep``; blanks count as empty text.

    ``overrides`` renames by place (0-based) among the header's columns.
    """
    head = cells.filter(F.col("row").isin(rows))
    joined = F.concat_ws(sep, *[F.coalesce(F.max(F.when(F.col("row") == r, text_of())), F.lit("")) for r in sorted(rows)])
    label = F.rtrim(joined) if strip == "right" else F.trim(joined)
    out = head.groupBy(*SHEET, "col").agg(label.alias("label"))
    if overrides:
        # places count columns of a sheet, at most 18,278 of them
        at = F.row_number().over(Window.partitionBy(*SHEET).orderBy("col")) - 1
        made = F.col("label")
        for place, name in overrides.items():
            made = F.when(F.col("__at") == place, F.lit(name)).otherwise(made)
        out = out.withColumn("__at", at).withColumn("label", made).drop("__at")
    return out


def flatten_header(cells: DataFrame, rows: list[int], first_col: int = 1, sep: str = ",", special: dict[str, tuple[str, str]] | None = None) -> DataFrame:
    """Label per column from a multi-row header.

    A blank takes the label to its left as long as no level above starts a new
    label in between; what stays blank becomes ``Unnamed: <place>_level_<k>``.
    ``special`` maps a final name to ``(text, "any level equals" | "last contains")``.
    """
    rows = sorted(rows)
    head = cells.filter(F.col("row").isin(rows) & (F.col("col") >= first_col))
    wide = cells.filter(F.col("col") >= first_col).groupBy(*SHEET, "col").agg(
        *[F.max(F.when(F.col("row") == r, text_of())).alias(f"__l{k}") for k, r in enumerate(rows)]
    )
    # windows here run over the columns of one sheet, at most 18,278 of them
    across = Window.partitionBy(*SHEET).orderBy("col").rowsBetween(Window.unboundedPreceding, 0)
    place = (F.col("col") - first_col).cast("string")
    started = F.lit(False)
    for k in range(len(rows)):
        c = F.col(f"__l{k}")
        if k == 0:
            filled = F.last(c, ignorenulls=True).over(across)
        else:
            wide = wide.withColumn(f"__s{k}", F.coalesce(F.max(F.when(started, F.col("col"))).over(across), F.lit(0)))
            inside = Window.partitionBy(*SHEET, f"__s{k}").orderBy("col").rowsBetween(Window.unboundedPreceding, 0)
            filled = F.last(c, ignorenulls=True).over(inside)
        blank = F.concat(F.lit("Unnamed: "), place, F.lit(f"_level_{k}"))
        wide = wide.withColumn(f"__f{k}", F.coalesce(filled, blank))
        started = started | c.isNotNull()
    levels = [F.col(f"__f{k}") for k in range(len(rows))]
    label = F.trim(F.concat_ws(sep, *levels))
    for name, (text, how) in (special or {}).items():
        if how == "any level equals":
            hit = F.lit(False)
            for c in levels:
                hit = hit | (c == text)
        else:
            hit = levels[-1].contains(text)
        label = F.when(hit, F.lit(name)).otherwise(label)
    return wide.select(*SHEET, "col", label.alias("label"))


def drop_dup_cols(header: DataFrame) -> DataFrame:
    """Of columns with one label, keep the leftmost."""
    return header.groupBy(*SHEET, "label").agg(F.min("col").alias("col"))


def label_cells(cells: DataFrame, header: DataFrame) -> DataFrame:
    """Body cells with the label of their column; columns without a label drop out."""
    return split_join(cells, header, [*SHEET, "col"], "inner")


def drop_ragged_cols(cells: DataFrame) -> DataFrame:
    """Cells of the columns that are filled in every row their sheet uses."""
    per_col = cells.groupBy(*SHEET, "col").agg(F.count_if(has_value()).alias("__n"))
    rows = cells.groupBy(*SHEET, "row").agg(F.lit(1).alias("__one")).groupBy(*SHEET).agg(F.count(F.lit(1)).alias("__rows"))
    full = per_col.join(rows, SHEET).filter("__n = __rows").select(*SHEET, "col")
    return split_join(cells, full, [*SHEET, "col"], "left_semi")


# --- columns and rows -----------------------------------------------------------


def drop_null_cols(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """Drop columns that hold any NULL. One aggregate row of flags decides the schema."""
    names = subset or df.columns
    flags = df.agg(*[(F.count_if(F.col(c).isNull()) > 0).alias(c) for c in names]).first()
    return df.select(*[c for c in df.columns if c not in names or not flags[c]])


def drop_null_rows(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    return df.dropna("any", subset=subset)


def melt(df: DataFrame, ids: list[str], values: list[str], variable: str, value: str) -> DataFrame:
    return df.unpivot(ids, values, variable, value)


def split_label(df: DataFrame, column: str, names: list[str], sep: str) -> DataFrame:
    """Packed label into columns; missing parts are NULL."""
    import re

    parts = F.split(F.col(column), re.escape(sep))
    return df.withColumns({n: F.get(parts, F.lit(i)) for i, n in enumerate(names)})


def pivot_mean(df: DataFrame, index: list[str], column: str, items: list[str], value: str) -> DataFrame:
    """Long to wide with the mean; rows whose values are all missing drop out."""
    kept = df.filter(F.col(value).isNotNull())
    return kept.groupBy(*index).pivot(column, items).agg(F.avg(value))


# --- joins ----------------------------------------------------------------------


def _null_safe(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    shared = [c for c in left.columns if c in right.columns]
    r = right.select(*[F.col(c).alias(f"__r_{c}") for c in right.columns])
    same = F.lit(True)
    for c in shared:
        same = same & F.col(c).eqNullSafe(F.col(f"__r_{c}"))
    joined = left.join(r, same, how)
    keys = [F.coalesce(F.col(c), F.col(f"__r_{c}")).alias(c) for c in shared]
    return joined.select(
        *keys,
        *[c for c in left.columns if c not in shared],
        *[F.col(f"__r_{c}").alias(c) for c in right.columns if c not in shared],
    )


def natural_join(left: DataFrame, right: DataFrame) -> DataFrame:
    """Inner join on every shared column; NULL keys match each other."""
    return _null_safe(left, right, "inner")


def natural_outer(tables: list[DataFrame], measures: list[str]) -> DataFrame:
    """Chain of full outer natural joins; missing measures become 0."""
    out = tables[0]
    for t in tables[1:]:
        out = _null_safe(out, t, "full")
    return out.fillna(0, subset=measures)


def concat_fill(parts: list[DataFrame]) -> DataFrame:
    """Union by name; missing numbers become 0."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out.fillna(0)


def recode(c: Column, mapping: dict[str, str], fallback: bool = True) -> Column:
    """Dictionary recode; unmapped values stay, or become NULL without ``fallback``."""
    pairs = [F.lit(x) for kv in mapping.items() for x in kv]
    mapped = F.try_element_at(F.create_map(*pairs), c)
    return F.coalesce(mapped, c) if fallback else mapped


def where_chain(cases: list[tuple[Column, Column | str]], otherwise: Column | str) -> Column:
    """First case that holds gives the value."""
    lit = lambda v: v if isinstance(v, Column) else F.lit(v)
    out = None
    for test, value in cases:
        out = F.when(test, lit(value)) if out is None else out.when(test, lit(value))
    return out.otherwise(lit(otherwise))


def strip_label(text: Column, part: Column) -> Column:
    """Text without every occurrence of another column's text, trimmed."""
    return F.trim(F.replace(text, part, F.lit("")))


def parse_bands(c: Column) -> Column:
    """``0-30``, ``301 and over``, ``0-50km``, ``200+km`` -> struct(lower, upper); open top 999999."""
    pattern = r"^\s*(\d+)\s*(?:-\s*(\d+))?"
    upper = F.regexp_extract(c, pattern, 2).try_cast("int")
    return F.struct(
        F.regexp_extract(c, pattern, 1).try_cast("int").alias("lower"), F.coalesce(upper, F.lit(OPEN_TOP)).alias("upper")
    )


def band_join(facts: DataFrame, value: str, bands: DataFrame, keys: list[str] | None = None, width: int = 1000, how: str = "left") -> DataFrame:
    """Facts with the band their value falls in: bands(<keys>, lower, upper, …), bounds inclusive.

    An upper bound of 999999 is open. Bands are cut to tiles of ``width``, so this is an equi join however many
    bands there are; the bands that reach one tile travel together. Facts without a band have NULLs, or drop
    out of an ``inner`` join.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"band join cannot be {how!r}")
    keys = keys or []
    tiled = bands.withColumn(
        "__tile", F.explode(F.sequence(F.floor(F.col("lower") / width), F.floor(F.col("upper") / width)))
    )
    others = [c for c in bands.columns if c not in keys]
    together = tiled.groupBy(*keys, "__tile").agg(F.collect_list(F.struct(*others)).alias("__bands"))
    placed = facts.withColumn("__tile", F.floor(F.least(F.col(value), F.lit(OPEN_TOP)) / width))
    hit = salted_join(placed, together, [*keys, "__tile"], how)
    v = F.col(value)
    fits = F.filter("__bands", lambda b: (v >= b["lower"]) & ((v <= b["upper"]) | (b["upper"] >= OPEN_TOP)))
    return hit.select(*facts.columns, (F.explode_outer if how == "left" else F.explode)(fits).alias("__band")).select(*facts.columns, "__band.*")


def populate(df: DataFrame, lists: dict[str, list]) -> DataFrame:
    """Every row with every combination of the listed values."""
    out = df
    for name, values in lists.items():
        out = out.withColumn(name, F.explode(F.array(*[F.lit(v) for v in values])))
    return out


def lookup_first(df: DataFrame, table: DataFrame, on: dict[str, str], values: list[str], order: str = "row_no", bounded: DataFrame | None = None) -> DataFrame:
    """First matching row's values by ``order``, NULL without a match.

    ``on`` maps a column of df to a column of the table. The table is reduced to
    one row per key first; text keys are normalised on both sides.

    When df is small by construction (class rows, not facts) pass the rows its
    keys come from as ``bounded``: the table is then cut to the keys asked for,
    and both ways are broadcast.
    """
    kinds = dict(table.dtypes)
    clean = lambda name, k: normalise(F.col(name)) if kinds[k] == "string" else F.col(name)
    keyed = table.select(
        *[clean(k, k).alias(f"__k{i}") for i, k in enumerate(on.values())], F.col(order).alias("__o"), *values
    )
    keys = [f"__k{i}" for i in range(len(on))]
    asking = {f"__k{i}": clean(c, k) for i, (c, k) in enumerate(on.items())}
    asked = df.withColumns(asking)
    if bounded is not None:
        keyed = keyed.join(F.broadcast(bounded.withColumns(asking).select(*keys)), keys, "left_semi")
    first = keyed.groupBy(*keys).agg(F.min_by(F.struct(*values), "__o").alias("__v"))
    joined = asked.join(F.broadcast(first), keys, "left") if bounded is not None else salted_join(asked, first, keys, "left", hot=hot_keys(asked, keys))
    return joined.select(*df.columns, *[F.col(f"__v.{v}").alias(v) for v in values])
