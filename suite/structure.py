"""D: structural grid operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridspark.operators import structure as D
from gridspark.scale import block_of
from suite.common import (
    CUSTOMER_SQL, ORDERS_SQL, PART_SQL, SUPPLIER_SQL, TEXT, customer_cells, orders_cells, part_cells, supplier_cells, texts,
)
from suite.registry import query


@query(
    "d1_insert_rows",
    SUPPLIER_SQL + f"""SELECT book, sheet, CASE WHEN "row" >= 3 THEN "row" + 2 ELSE "row" END::INT AS "row", CASE WHEN col >= 2 THEN col + 1 ELSE col END::INT AS col, {TEXT} AS text FROM cells""",
)
def _(t):
    return texts(D.insert_cols(D.insert_rows(supplier_cells(t), 3, 2), 2))


@query(
    "d2_delete_rows",
    SUPPLIER_SQL + f"""SELECT book, sheet, CASE WHEN "row" >= 4 THEN "row" - 2 ELSE "row" END::INT AS "row", CASE WHEN col >= 3 THEN col - 1 ELSE col END::INT AS col, {TEXT} AS text FROM cells WHERE "row" NOT IN (2, 3) AND col <> 2""",
)
def _(t):
    return texts(D.delete_cols(D.delete_rows(supplier_cells(t), 2, 2), 2))


@query(
    "d3_move_range",
    CUSTOMER_SQL + f""", m AS (SELECT book, sheet, "row" + 5 AS r2, col + 1 AS c2, {TEXT} AS text FROM cells WHERE "row" BETWEEN 2 AND 9 AND col BETWEEN 1 AND 2)
       SELECT book, sheet, r2::INT AS "row", c2::INT AS col, text FROM m UNION ALL SELECT book, sheet, "row"::INT, col::INT, {TEXT} FROM cells c
       WHERE NOT ("row" BETWEEN 2 AND 9 AND col BETWEEN 1 AND 2) AND NOT EXISTS (SELECT 1 FROM m WHERE m.sheet = c.sheet AND m.r2 = c."row" AND m.c2 = c.col)""",
)
def _(t):
    return texts(D.move_range(customer_cells(t), (1, 2, 2, 9), 5, 1))


def _merges(cells):
    return cells.select("book", "sheet").distinct().select(
        "book", "sheet", F.explode(F.array(
            F.struct(F.lit(1).alias("min_col"), F.lit(2).alias("min_row"), F.lit(2).alias("max_col"), F.lit(3).alias("max_row")),
            F.struct(F.lit(4).alias("min_col"), F.lit(4).alias("min_row"), F.lit(6).alias("max_col"), F.lit(9).alias("max_row")),
        )).alias("m")).select("book", "sheet", "m.*")


_COVERED = """(("row" BETWEEN 2 AND 3 AND col BETWEEN 1 AND 2 AND NOT ("row" = 2 AND col = 1)) OR ("row" BETWEEN 4 AND 9 AND col BETWEEN 4 AND 6 AND NOT ("row" = 4 AND col = 4)))"""


@query(
    "d4_merge_cells",
    PART_SQL + f""", c AS (SELECT * FROM cells WHERE NOT ("row" = 4 AND col = 4))
       SELECT book, sheet, "row"::INT AS "row", col::INT AS col, {TEXT} AS text FROM c WHERE NOT {_COVERED} UNION ALL SELECT DISTINCT book, sheet, 4, 4, NULL FROM cells""",
)
def _(t):
    cells = part_cells(t).filter(~((F.col("row") == 4) & (F.col("col") == 4)))
    return texts(D.merge_cells(cells, _merges(cells)))


@query(
    "d5_unmerge_cells",
    PART_SQL + f"""SELECT book, sheet, "row"::INT AS "row", col::INT AS col, {TEXT} AS text FROM cells WHERE NOT {_COVERED}""",
)
def _(t):
    cells = part_cells(t)
    return texts(D.unmerge_cells(cells, _merges(cells), _merges(cells)))


@query(
    "d6_fill_down",
    """SELECT o_orderkey, last_value(CASE WHEN o_orderkey % 5 = 0 THEN o_orderpriority END IGNORE NULLS) OVER w AS priority, last_value(CASE WHEN o_orderkey % 3 = 0 THEN o_custkey END IGNORE NULLS) OVER w AS cust
       FROM orders WINDOW w AS (PARTITION BY o_orderstatus ORDER BY o_orderkey)""",
)
def _(t):
    ragged = t.orders.select("o_orderstatus", "o_orderkey", F.when(F.col("o_orderkey") % 5 == 0, F.col("o_orderpriority")).alias("priority"), F.when(F.col("o_orderkey") % 3 == 0, F.col("o_custkey")).alias("cust"))
    return D.fill_down(ragged, ["o_orderstatus"], ["priority", "cust"], ["o_orderkey"], block_of("o_orderkey", 2048)).drop("o_orderstatus")


@query(
    "d7_suppress_repeats",
    """WITH l AS (SELECT *, o_orderkey // 40 AS a, o_orderkey // 8 AS b, lag(o_orderkey // 40) OVER w AS pa, lag(o_orderkey // 8) OVER w AS pb, lag(o_orderkey) OVER w AS po FROM orders WINDOW w AS (PARTITION BY o_orderstatus ORDER BY o_orderkey))
       SELECT o_orderkey, CASE WHEN po IS NULL OR a <> pa THEN a END AS a, CASE WHEN po IS NULL OR a <> pa OR b <> pb THEN b END AS b FROM l""",
)
def _(t):
    o = F.col("o_orderkey")
    rows = t.orders.select("o_orderstatus", "o_orderkey", F.floor(o / 40).alias("a"), F.floor(o / 8).alias("b"))
    return D.suppress_repeats(rows, ["o_orderstatus"], ["a", "b"], ["o_orderkey"], block_of("o_orderkey", 2048)).drop("o_orderstatus")


@query(
    "d8_slice",
    ORDERS_SQL + f"""SELECT 'A2:C5' AS key, book, sheet, "row"::INT AS "row", col::INT AS col, {TEXT} AS text FROM cells WHERE "row" BETWEEN 2 AND 5 AND col <= 3
       UNION ALL SELECT 'B:D', book, sheet, "row"::INT, col::INT, {TEXT} FROM cells WHERE col BETWEEN 2 AND 4 UNION ALL SELECT '4:10', book, sheet, "row"::INT, col::INT, {TEXT} FROM cells WHERE "row" BETWEEN 4 AND 10
       UNION ALL SELECT 'E1', book, sheet, "row"::INT, col::INT, {TEXT} FROM cells WHERE "row" = 1 AND col = 5""",
)
def _(t):
    keys = ("A2:C5", "B:D", "4:10", "E1")
    hits = F.inline(F.array(*[F.struct(F.lit(k).alias("key"), D.slice_test(k).alias("hit")) for k in keys]))
    marked = orders_cells(t).select("*", hits).filter("hit")
    return texts(marked, "key")


@query(
    "d9_iter_rows",
    SUPPLIER_SQL + f""", t AS (SELECT *, {TEXT} AS text FROM cells WHERE NOT ("row" % 3 = 0 AND col = 2))
      , g AS (SELECT s.book, s.sheet, r."row", c.col, t.text FROM (SELECT book, sheet FROM cells GROUP BY ALL) s JOIN (SELECT DISTINCT sheet, "row" FROM cells) r ON r.sheet = s.sheet, (VALUES (1), (2), (3), (4)) c(col)
        LEFT JOIN t ON t.sheet = s.sheet AND t."row" = r."row" AND t.col = c.col)
      SELECT 'row' AS view, sheet, "row"::INT AS at, string_agg(coalesce(text, '-'), '|' ORDER BY col) AS line FROM g GROUP BY sheet, "row"
      UNION ALL SELECT 'col', sheet, col::INT, string_agg(coalesce(text, '-'), '|' ORDER BY "row") FROM g GROUP BY sheet, col""",
)
def _(t):
    cells = supplier_cells(t).filter(~((F.col("row") % 3 == 0) & (F.col("col") == 2)))
    line = F.array_join("values", "|", "-").alias("line")
    rows = D.iter_rows(cells).select(F.lit("row").alias("view"), "sheet", F.col("row").alias("at"), line)
    cols = D.iter_cols(cells).select(F.lit("col").alias("view"), "sheet", F.col("col").alias("at"), line)
    return rows.unionByName(cols)


@query(
    "d10_copy_sheet",
    CUSTOMER_SQL + f"""SELECT book, sheet, "row"::INT AS "row", col::INT AS col, {TEXT} AS text FROM cells UNION ALL SELECT book, sheet || ' Copy', "row"::INT, col::INT, {TEXT} FROM cells WHERE sheet LIKE 'B%'""",
)
def _(t):
    return texts(D.copy_sheet(customer_cells(t), F.col("sheet").startswith("B")))


@query(
    "d11_outline",
    CUSTOMER_SQL + """SELECT sheet, "row"::INT AS "row", col::INT AS col, CASE WHEN "row" BETWEEN 5 AND 8 THEN 2 WHEN "row" BETWEEN 3 AND 40 THEN 1 ELSE 0 END AS level FROM cells WHERE NOT ("row" BETWEEN 5 AND 8)""",
)
def _(t):
    cells = customer_cells(t)
    one = lambda a, b, n, h: F.struct(F.lit(a).alias("start"), F.lit(b).alias("end"), F.lit(n).alias("level"), F.lit(h).alias("hidden"))
    groups = cells.select("book", "sheet").distinct().select("book", "sheet", F.explode(F.array(one(3, 40, 1, False), one(5, 8, 2, True))).alias("g")).select("book", "sheet", "g.*")
    return D.outline(cells, groups).filter(~F.col("hidden")).select("sheet", "row", "col", "level")
