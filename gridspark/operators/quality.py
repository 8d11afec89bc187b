"""Data validation and table features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridspark.operators.rules import rule_cell_is
from gridspark.scale import hot_keys, salted_join


def validate_bounds(c: Column, kind: str, operator: str, first, second=None, allow_blank: bool = True) -> Column:
    """True when valid. Kinds whole, decimal, date, time; whole numbers must be whole."""
    ok = rule_cell_is(c, operator, first, second)
    if kind == "whole":
        ok = ok & (c == F.floor(c))
    return F.coalesce(ok, F.lit(allow_blank))


def validate_list(c: Column, allowed: str, allow_blank: bool = True) -> Column:
    """Inline comma list such as ``"a,b, c"``."""
    values = [v.strip() for v in allowed.strip('"').split(",")]
    return F.coalesce(c.cast("string").isin(values), F.lit(allow_blank))


def violations_of_list(df: DataFrame, column: str, allowed: DataFrame, values: str, allow_blank: bool = True) -> DataFrame:
    """Rows whose value is not in the column of allowed values."""
    keys = allowed.select(F.col(values).alias(column)).filter(F.col(column).isNotNull()).distinct()
    rows = df.filter(F.col(column).isNotNull()) if allow_blank else df
    return salted_join(rows, keys, [column], "left_anti", hot=hot_keys(rows, [column]))


def validate_length(c: Column, operator: str, first: int, second: int | None = None, allow_blank: bool = True) -> Column:
    return F.coalesce(rule_cell_is(F.length(c), operator, first, second), F.lit(allow_blank))


def validate_custom(sql: str, allow_blank: bool = True) -> Column:
    return F.coalesce(F.expr(sql), F.lit(allow_blank))


def validation_report(df: DataFrame, rules: list[dict], key: Column) -> DataFrame:
    """Rules ``{id, valid, severity}`` in one pass: rows checked, violations, first offending key."""
    made = [
        F.struct(
            F.lit(r["id"]).alias("rule"),
            F.lit(r.get("severity", "stop")).alias("severity"),
            F.count(F.lit(1)).alias("checked"),
            F.count_if(~r["valid"]).alias("violations"),
            F.min(F.when(~r["valid"], key)).alias("first"),
        )
        for r in rules
    ]
    return df.agg(F.array(*made).alias("__all")).select(F.inline("__all"))


# Totals-row functions.
TOTALS = {
    "sum": F.sum,
    "min": F.min,
    "max": F.max,
    "average": F.avg,
    "count": F.count,
    "countNums": lambda c: F.count(c.try_cast("double")),
    "stdDev": F.stddev_samp,
    "var": F.var_samp,
}


def totals_row(df: DataFrame, spec: dict[str, str], label: tuple[str, str] | None = None, visible: Column | None = None) -> DataFrame:
    """One row of totals over the visible rows.

    ``spec`` maps a column to a function name, or to ``custom:<sql aggregate>``.
    """
    rows = df.filter(visible) if visible is not None else df
    aggs = []
    for column, fn in spec.items():
        made = F.expr(fn[7:]) if fn.startswith("custom:") else TOTALS[fn](F.col(column))
        aggs.append(made.alias(column))
    if label:
        aggs.append(F.lit(label[1]).alias(label[0]))
    return rows.agg(*aggs)


def with_totals(df: DataFrame, spec: dict[str, str], label: tuple[str, str] | None = None, visible: Column | None = None) -> DataFrame:
    """Visible rows followed by their totals row."""
    rows = df.filter(visible) if visible is not None else df
    return rows.unionByName(totals_row(df, spec, label, visible), allowMissingColumns=True)


def calculated_column(df: DataFrame, name: str, sql: str) -> DataFrame:
    return df.withColumn(name, F.expr(sql))


def init_columns(cells: DataFrame, tables: DataFrame) -> DataFrame:
    """Column names of table objects: header text, or ``Column<sheet column>`` where it is missing.

    tables(book, sheet, name, min_col, min_row, max_col, …); the header is its first row.
    """
    from gridspark.operators.grid import text_of

    wanted = tables.select(
        "book", "sheet", "name", F.col("min_row").alias("row"), F.explode(F.sequence("min_col", "max_col")).alias("col")
    )
    heads = cells.select("book", "sheet", "row", "col", text_of().alias("__head"))
    named = wanted.join(heads, ["book", "sheet", "row", "col"], "left")
    text = F.coalesce(F.col("__head"), F.concat(F.lit("Column"), F.col("col")))
    return named.select("book", "sheet", "name", "col", text.alias("header"))
