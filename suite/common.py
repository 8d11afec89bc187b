"""Cells derived from the given tables, and the same grid as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridspark.operators import grid
from gridspark.scale import block_of

# name -> kind; n number, s text, d timestamp
SUPPLIER = {"s_suppkey": "n", "s_name": "s", "s_nationkey": "n", "s_acctbal": "n"}
CUSTOMER = {"c_custkey": "n", "c_name": "s", "c_nationkey": "n", "c_acctbal": "n", "c_mktsegment": "s"}
ORDERS = {"o_orderkey": "n", "o_custkey": "n", "o_totalprice": "n", "o_orderdate": "d", "o_orderpriority": "s"}
PART = {"p_partkey": "n", "p_name": "s", "p_type": "s", "p_size": "n", "p_retailprice": "n"}


def supplier_cells(t, header: bool = True) -> DataFrame:
    """One sheet per nation."""
    return grid.to_cells(
        t.supplier, F.lit("sup"), F.concat(F.lit("n"), F.col("s_nationkey")),
        list(SUPPLIER), ["s_suppkey"], block_of("s_suppkey"), header,
    )


def customer_cells(t) -> DataFrame:
    """One sheet per market segment."""
    return grid.to_cells(
        t.customer, F.lit("crm"), F.col("c_mktsegment"), list(CUSTOMER), ["c_custkey"], block_of("c_custkey")
    )


def orders_cells(t) -> DataFrame:
    """One book per order year, one sheet per status."""
    return grid.to_cells(
        t.orders, F.concat(F.lit("y"), F.year("o_orderdate")), F.col("o_orderstatus"),
        list(ORDERS), ["o_orderkey"], block_of("o_orderkey"),
    )


def part_cells(t) -> DataFrame:
    """One sheet per brand."""
    return grid.to_cells(t.part, F.lit("cat"), F.col("p_brand"), list(PART), ["p_partkey"], block_of("p_partkey"))


def cells_sql(table: str, book: str, sheet: str, key: str, cols: dict[str, str], header: bool = True) -> str:
    """CTEs ``src`` and ``cells(book, sheet, row, col, dtype, v_num, v_str, v_ts)``."""
    lead = 1 if header else 0
    parts = []
    for i, (c, kind) in enumerate(cols.items(), 1):
        num = f"{c}::DOUBLE" if kind == "n" else "NULL::DOUBLE"
        text = c if kind == "s" else "NULL::VARCHAR"
        stamp = c if kind == "d" else "NULL::TIMESTAMP"
        parts.append(
            f'SELECT book, sheet, r AS "row", {i} AS col, \'{kind}\' AS dtype, '
            f"{num} AS v_num, {text} AS v_str, {stamp} AS v_ts FROM src WHERE {c} IS NOT NULL"
        )
        if header:
            parts.append(
                f"SELECT DISTINCT book, sheet, 1, {i}, 's', NULL::DOUBLE, '{c}', NULL::TIMESTAMP FROM src"
            )
    union = " UNION ALL ".join(parts)
    return (
        f"WITH src AS (SELECT *, {book} AS book, {sheet} AS sheet, "
        f"{lead} + row_number() OVER (PARTITION BY {book}, {sheet} ORDER BY {key}) AS r FROM {table}), "
        f"cells AS ({union})"
    )


SUPPLIER_SQL = cells_sql("supplier", "'sup'", "'n' || s_nationkey", "s_suppkey", SUPPLIER)
SUPPLIER_BODY_SQL = cells_sql("supplier", "'sup'", "'n' || s_nationkey", "s_suppkey", SUPPLIER, header=False)
CUSTOMER_SQL = cells_sql("customer", "'crm'", "c_mktsegment", "c_custkey", CUSTOMER)
ORDERS_SQL = cells_sql("orders", "'y' || year(o_orderdate)", "o_orderstatus", "o_orderkey", ORDERS)
PART_SQL = cells_sql("part", "'cat'", "p_brand", "p_partkey", PART)

# text of a cell, as ``grid.text_of`` writes it
TEXT = (
    "coalesce(v_str, CASE WHEN v_num = floor(v_num) THEN v_num::BIGINT::VARCHAR ELSE v_num::VARCHAR END, "
    "strftime(v_ts, '%Y-%m-%dT%H:%M:%S'))"
)


def texts(cells: DataFrame, *more: str) -> DataFrame:
    """Cells as (book, sheet, row, col, text) for comparing."""
    return cells.select("book", "sheet", "row", "col", grid.text_of().alias("text"), *more)
