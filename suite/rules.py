"""G, H, I: rules, validation, table features."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from gridspark.operators import grid as G
from gridspark.operators import quality as Q
from gridspark.operators import rules as R
from suite.common import SUPPLIER_SQL, TEXT, customer_cells, supplier_cells, texts
from suite.registry import query


def rows():
    return F.count(F.lit(1)).alias("n")


_CELL_IS = {
    "lt": ("lessThan", 10, None, "l_quantity < 10"), "le": ("<=", 10, None, "l_quantity <= 10"), "eq": ("==", 10, None, "l_quantity = 10"),
    "ne": ("!=", 10, None, "l_quantity <> 10"), "ge": (">=", 10, None, "l_quantity >= 10"), "gt": ("greaterThan", 10, None, "l_quantity > 10"),
    "bt": ("between", 20, 10, "l_quantity BETWEEN 10 AND 20"), "nb": ("notBetween", 10, 20, "l_quantity NOT BETWEEN 10 AND 20"),
}


@query("g1_rule_cell_is", "SELECT l_orderkey, l_linenumber, l_extendedprice, " + ", ".join(f"{s} AS {k}" for k, (_, _, _, s) in _CELL_IS.items()) + " FROM lineitem")
def _(t):
    c = F.col("l_quantity")
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice", *[R.rule_cell_is(c, op, a, b).alias(k) for k, (op, a, b, _) in _CELL_IS.items()])


@query(
    "g2_rule_expression",
    "SELECT l_returnflag, l_linestatus, (l_quantity * l_discount > 2 AND l_returnflag <> 'N') AS hit, count(*) AS n FROM lineitem GROUP BY ALL",
)
def _(t):
    hit = R.rule_expression("l_quantity * l_discount > 2 AND l_returnflag <> 'N'").alias("hit")
    return t.lineitem.groupBy("l_returnflag", "l_linestatus", hit).agg(rows())


@query(
    "g3_rule_text",
    """SELECT p_partkey, lower(p_name) LIKE '%ring%' AS a, NOT lower(p_name) LIKE '%ring%' AS b, lower(p_name) LIKE 'blue%' AS c, lower(p_name) LIKE '%t' AS d FROM part""",
)
def _(t):
    c = F.col("p_name")
    return t.part.select("p_partkey", R.rule_text(c, "containsText", "RING").alias("a"), R.rule_text(c, "notContains", "ring").alias("b"),
                         R.rule_text(c, "beginsWith", "Blue").alias("c"), R.rule_text(c, "endsWith", "t").alias("d"))


@query(
    "g4_rule_blank_error",
    """SELECT c_custkey, s IS NULL AS blank, s IS NOT NULL AS filled, s IS NOT NULL AND s = '#N/A' AS error, NOT (s IS NOT NULL AND s = '#N/A') AS fine FROM customer
       LEFT JOIN (SELECT o_custkey, max(CASE WHEN o_orderkey % 9 = 0 THEN '#N/A' ELSE o_orderstatus END) AS s FROM orders WHERE o_orderkey % 4 = 0 GROUP BY 1) ON c_custkey = o_custkey""",
)
def _(t):
    code = F.when(F.col("o_orderkey") % 9 == 0, "#N/A").otherwise(F.col("o_orderstatus"))
    last = t.orders.filter("o_orderkey % 4 = 0").groupBy("o_custkey").agg(F.max(code).alias("s"))
    j, s = t.customer.join(last, F.col("c_custkey") == F.col("o_custkey"), "left"), F.col("s")
    return j.select("c_custkey", R.rule_blank_error(s, "containsBlanks").alias("blank"), R.rule_blank_error(s, "notContainsBlanks").alias("filled"),
                    R.rule_blank_error(s, "containsErrors").alias("error"), R.rule_blank_error(s, "notContainsErrors").alias("fine"))


@query(
    "g5_rule_unique",
    "SELECT o_orderkey, count(*) OVER (PARTITION BY o_custkey) > 1 AS duplicate, count(*) OVER (PARTITION BY o_custkey) = 1 AS uniq FROM orders",
)
def _(t):
    flagged = R.rule_unique(t.orders, "o_custkey")
    return flagged.select("o_orderkey", "duplicate", (~F.col("duplicate")).alias("uniq"))


@query(
    "g6_rule_top10",
    """WITH r AS (SELECT l_extendedprice AS v, row_number() OVER (ORDER BY l_extendedprice DESC) AS d, row_number() OVER (ORDER BY l_extendedprice) AS u, count(*) OVER () AS c FROM lineitem)
       SELECT l_orderkey, l_linenumber, l_extendedprice, l_extendedprice >= (SELECT v FROM r WHERE d = 25) AS top25, l_extendedprice <= (SELECT v FROM r WHERE u = greatest(1, c * 10 // 100)) AS low10 FROM lineitem""",
)
def _(t):
    li = t.lineitem
    return li.select("l_orderkey", "l_linenumber", "l_extendedprice", R.rule_top10(li, "l_extendedprice", 25).alias("top25"),
                     R.rule_top10(li, "l_extendedprice", 10, percent=True, bottom=True).alias("low10"))


@query(
    "g7_rule_average",
    """WITH s AS (SELECT avg(l_quantity) AS m, stddev_samp(l_quantity) AS d, avg(l_extendedprice) AS pm, stddev_samp(l_extendedprice) AS pd FROM lineitem)
       SELECT l_returnflag, l_quantity > m AS above, l_quantity <= m AS below_eq, l_extendedprice > pm + pd AS high1, l_extendedprice < pm - 2 * pd AS low2, count(*) AS n FROM lineitem, s GROUP BY ALL""",
)
def _(t):
    li = t.lineitem
    return li.select(
        "l_returnflag", R.rule_average(li, "l_quantity").alias("above"), R.rule_average(li, "l_quantity", above=False, equal=True).alias("below_eq"),
        R.rule_average(li, "l_extendedprice", std_dev=1).alias("high1"), R.rule_average(li, "l_extendedprice", above=False, std_dev=2).alias("low2"),
    ).groupBy("l_returnflag", "above", "below_eq", "high1", "low2").agg(rows())


_DAY = "DATE '2024-01-17'"
_WK = f"({_DAY} - dayofweek({_DAY})::INT)"
_PERIODS = {
    "today": f"ts::DATE = {_DAY}", "yesterday": f"ts::DATE = {_DAY} - 1", "tomorrow": f"ts::DATE = {_DAY} + 1",
    "last7Days": f"ts::DATE BETWEEN {_DAY} - 6 AND {_DAY}", "thisWeek": f"ts::DATE BETWEEN {_WK} AND {_WK} + 6",
    "lastWeek": f"ts::DATE BETWEEN {_WK} - 7 AND {_WK} - 1", "nextWeek": f"ts::DATE BETWEEN {_WK} + 7 AND {_WK} + 13",
    "thisMonth": "date_trunc('month', ts) = '2024-01-01'", "lastMonth": "date_trunc('month', ts) = '2023-12-01'", "nextMonth": "date_trunc('month', ts) = '2024-02-01'",
}


@query("g8_rule_time_period", "SELECT event_id, " + ", ".join(f"{s} AS {k}" for k, s in _PERIODS.items()) + " FROM events")
def _(t):
    day = dt.date(2024, 1, 17)
    return t.events.select("event_id", *[R.rule_time_period(F.col("ts"), k, day).alias(k) for k in _PERIODS])


@query(
    "g9_color_scale",
    """WITH s AS (SELECT min(l_extendedprice) AS lo, quantile_cont(l_extendedprice, 0.5) AS mid, max(l_extendedprice) AS hi, max(l_quantity) AS qhi FROM lineitem),
       p AS (SELECT l_orderkey, l_linenumber, l_extendedprice, CASE WHEN l_extendedprice >= mid THEN 1 + (l_extendedprice - mid) / (hi - mid) ELSE (l_extendedprice - lo) / (mid - lo) END AS p,
         CASE WHEN l_quantity >= qhi THEN 1 WHEN l_quantity >= 10 THEN (l_quantity - 10) / (qhi - 10) ELSE 0 END AS q FROM lineitem, s)
       SELECT l_orderkey, l_linenumber, l_extendedprice, round(p, 9) AS position, round(q, 9) AS q_position,
         printf('%02X%02X%02X', round(CASE WHEN p < 1 THEN 248 + p * (255 - 248) ELSE 255 + (p - 1) * (99 - 255) END)::INT, round(CASE WHEN p < 1 THEN 105 + p * (235 - 105) ELSE 235 + (p - 1) * (190 - 235) END)::INT,
           round(CASE WHEN p < 1 THEN 107 + p * (132 - 107) ELSE 132 + (p - 1) * (123 - 132) END)::INT) AS rgb FROM p""",
)
def _(t):
    three = R.color_scale(t.lineitem, "l_extendedprice", [("min", None, "F8696B"), ("percentile", 50, "FFEB84"), ("max", None, "63BE7B")])
    kept = three.withColumnsRenamed({"position": "p3", "rgb": "rgb3"})
    two = R.color_scale(kept, "l_quantity", [("num", 10, "FFFFFF"), ("max", None, "00FF00")])
    return two.select("l_orderkey", "l_linenumber", "l_extendedprice", F.round("p3", 9).alias("position"), F.round("position", 9).alias("q_position"), F.col("rgb3").alias("rgb"))


@query(
    "g10_icon_set",
    """WITH s AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi, quantile_cont(l_extendedprice, [0.2, 0.4, 0.6, 0.8]) AS q FROM lineitem)
       SELECT CASE WHEN l_extendedprice > lo + (hi - lo) * 0.67 THEN 2 WHEN l_extendedprice >= lo + (hi - lo) * 0.33 THEN 1 ELSE 0 END AS icon3,
         3 - CASE WHEN l_quantity >= 40 THEN 3 WHEN l_quantity > 25 THEN 2 WHEN l_quantity >= 5 THEN 1 ELSE 0 END AS icon4,
         CASE WHEN l_extendedprice >= q[4] THEN 4 WHEN l_extendedprice >= q[3] THEN 3 WHEN l_extendedprice >= q[2] THEN 2 WHEN l_extendedprice >= q[1] THEN 1 ELSE 0 END AS icon5, count(*) AS n FROM lineitem, s GROUP BY ALL""",
)
def _(t):
    li = t.lineitem
    i3 = R.icon_bucket(li, "l_extendedprice", [("percent", 0, True), ("percent", 33, True), ("percent", 67, False)])
    i4 = R.icon_bucket(li, "l_quantity", [("num", 0, True), ("num", 5, True), ("num", 25, False), ("num", 40, True)], reverse=True)
    i5 = R.icon_bucket(li, "l_extendedprice", [("percentile", 0, True)] + [("percentile", p, True) for p in (20, 40, 60, 80)])
    return li.select(i3.alias("icon3"), i4.alias("icon4"), i5.alias("icon5")).groupBy("icon3", "icon4", "icon5").agg(rows())


@query(
    "g11_data_bar",
    """WITH s AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem)
       SELECT l_orderkey, l_linenumber, l_extendedprice, round(10 + (l_extendedprice - lo) / (hi - lo) * 80, 6) AS bar, round(greatest(0, least(100, (l_quantity - 10) / 30 * 100)), 6) AS clamped FROM lineitem, s""",
)
def _(t):
    li = t.lineitem
    return li.select("l_orderkey", "l_linenumber", "l_extendedprice", F.round(R.data_bar(li, "l_extendedprice"), 6).alias("bar"),
                     F.round(R.data_bar(li, "l_quantity", ("num", 10), ("num", 40), 0, 100), 6).alias("clamped"))


@query(
    "g12_resolve_rules",
    """WITH h AS (SELECT *, l_quantity > 40 AS r1, l_discount >= 0.08 AS r2, l_returnflag = 'R' AS r3, l_tax > 0.05 AS r4 FROM lineitem),
       a AS (SELECT *, r3 AS a3, r1 AS a1, r2 AND NOT r1 AS a2, r4 AND NOT r1 AS a4 FROM h)
       SELECT CASE WHEN a3 THEN 3 WHEN a1 THEN 1 WHEN a2 THEN 2 WHEN a4 THEN 4 END AS winner, concat_ws(',', CASE WHEN a3 THEN '3' END, CASE WHEN a1 THEN '1' END, CASE WHEN a2 THEN '2' END, CASE WHEN a4 THEN '4' END) AS applied, count(*) AS n FROM a GROUP BY ALL""",
)
def _(t):
    rules = [
        {"id": 1, "test": F.col("l_quantity") > 40, "stop": True}, {"id": 2, "test": F.col("l_discount") >= 0.08},
        {"id": 3, "test": F.col("l_returnflag") == "R", "priority": 1}, {"id": 4, "test": F.col("l_tax") > 0.05},
    ]
    rules[0]["priority"], rules[1]["priority"] = 2, 3  # rule 4 takes its place of insertion
    out = R.resolve_rules(t.lineitem, rules)
    return out.select("winner", F.array_join("applied", ",").alias("applied")).groupBy("winner", "applied").agg(rows())


@query(
    "g13_dedupe_formats",
    "SELECT o_custkey AS field, min_by(o_orderpriority, o_orderkey) AS fmt, min(o_orderkey) AS priority FROM orders GROUP BY 1",
)
def _(t):
    f = t.orders.select(F.col("o_custkey").alias("field"), F.col("o_orderpriority").alias("fmt"), F.col("o_orderkey").alias("priority"))
    return R.dedupe_formats(f, ["field"])


@query(
    "g14_rules_for_cells",
    SUPPLIER_SQL + f"""SELECT 1 AS rule_id, sheet, "row"::INT AS "row", col::INT AS col, {TEXT} AS text FROM cells WHERE "row" >= 2 AND col = 4 UNION ALL SELECT 2, sheet, "row"::INT, col::INT, {TEXT} FROM cells WHERE "row" BETWEEN 1 AND 3 AND col BETWEEN 2 AND 4""",
)
def _(t):
    cells = supplier_cells(t)
    one = lambda i, a, b, c, d: F.struct(F.lit(i).alias("rule_id"), F.lit(a).alias("min_col"), F.lit(b).alias("min_row"), F.lit(c).alias("max_col"), F.lit(d).alias("max_row"))
    ranges = cells.select("book", "sheet").distinct().select("book", "sheet", F.explode(F.array(one(1, 4, 2, 4, 1048576), one(2, 2, 1, 4, 3))).alias("r")).select("book", "sheet", "r.*")
    return texts(R.rules_for_cells(cells, ranges), "rule_id").drop("book")


@query(
    "h1_validate_bounds",
    """SELECT l_returnflag, l_quantity BETWEEN 5 AND 45 AS q, (l_extendedprice >= 1000 AND l_extendedprice = floor(l_extendedprice)) AS w, l_tax < 0.07 AS x,
       l_shipdate >= '1996-01-01' AS d, count(*) AS n FROM lineitem GROUP BY ALL""",
)
def _(t):
    f = F.col
    return t.lineitem.select(
        "l_returnflag", Q.validate_bounds(f("l_quantity"), "decimal", "between", 5, 45).alias("q"), Q.validate_bounds(f("l_extendedprice"), "whole", "greaterThanOrEqual", 1000).alias("w"),
        Q.validate_bounds(f("l_tax"), "decimal", "lessThan", 0.07).alias("x"), Q.validate_bounds(f("l_shipdate"), "date", "greaterThanOrEqual", dt.date(1996, 1, 1)).alias("d"),
    ).groupBy("l_returnflag", "q", "w", "x", "d").agg(rows())


@query(
    "h2_validate_list",
    """SELECT 'inline' AS k, o_orderkey AS id FROM orders WHERE o_orderstatus NOT IN ('O', 'F') UNION ALL SELECT 'column', o_orderkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'BUILDING')""",
)
def _(t):
    a = t.orders.filter(~Q.validate_list(F.col("o_orderstatus"), '"O, F"')).select(F.lit("inline").alias("k"), F.col("o_orderkey").alias("id"))
    b = Q.violations_of_list(t.orders, "o_custkey", t.customer.filter("c_mktsegment <> 'BUILDING'"), "c_custkey")
    return a.unionByName(b.select(F.lit("column").alias("k"), F.col("o_orderkey").alias("id")))


@query("h3_validate_length", "SELECT doc_id, length(text) <= 2000 AS ok, length(text) BETWEEN 300 AND 900 AS mid FROM documents")
def _(t):
    c = F.col("text")
    return t.documents.select("doc_id", Q.validate_length(c, "lessThanOrEqual", 2000).alias("ok"), Q.validate_length(c, "between", 300, 900).alias("mid"))


@query("h4_validate_custom", "SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem WHERE NOT (l_extendedprice * (1 - l_discount) > 5000 OR l_quantity < 3)")
def _(t):
    return t.lineitem.filter(~Q.validate_custom("l_extendedprice * (1 - l_discount) > 5000 OR l_quantity < 3")).select("l_orderkey", "l_linenumber", "l_extendedprice")


@query(
    "h5_validation_report",
    """SELECT 1 AS rule, 'stop' AS severity, count(*) AS checked, count_if(NOT l_quantity BETWEEN 5 AND 45)::BIGINT AS violations, min(CASE WHEN NOT l_quantity BETWEEN 5 AND 45 THEN l_orderkey END) AS first FROM lineitem
       UNION ALL SELECT 2, 'warning', count(*), count_if(l_discount > 0.09)::BIGINT, min(CASE WHEN l_discount > 0.09 THEN l_orderkey END) FROM lineitem
       UNION ALL SELECT 3, 'information', count(*), count_if(l_returnflag = 'N')::BIGINT, min(CASE WHEN l_returnflag = 'N' THEN l_orderkey END) FROM lineitem""",
)
def _(t):
    rules = [
        {"id": 1, "valid": Q.validate_bounds(F.col("l_quantity"), "whole", "between", 5, 45)},
        {"id": 2, "valid": Q.validate_bounds(F.col("l_discount"), "decimal", "lessThanOrEqual", 0.09), "severity": "warning"},
        {"id": 3, "valid": Q.validate_list(F.col("l_returnflag"), "A,R"), "severity": "information"},
    ]
    return Q.validation_report(t.lineitem, rules, F.col("l_orderkey"))


@query(
    "i1_totals_row",
    """SELECT c_name, c_custkey, round(c_acctbal, 2) AS c_acctbal, c_nationkey::DOUBLE AS c_nationkey, c_mktsegment FROM customer WHERE c_acctbal > 0
       UNION ALL SELECT 'Total', count(c_custkey), round(avg(c_acctbal), 2), round(var_samp(c_nationkey), 6), max(c_mktsegment) FROM customer WHERE c_acctbal > 0
       UNION ALL SELECT 'lines', max(l_partkey), round(sum(l_extendedprice * (1 - l_discount)), 2), round(stddev_samp(l_quantity), 6), min(l_returnflag) FROM lineitem""",
)
def _(t):
    c = t.customer.withColumn("c_nationkey", F.col("c_nationkey").cast("double"))
    shown = Q.with_totals(c, {"c_custkey": "count", "c_acctbal": "average", "c_nationkey": "var", "c_mktsegment": "max"}, ("c_name", "Total"), F.col("c_acctbal") > 0)
    lines = Q.totals_row(t.lineitem, {"l_partkey": "max", "l_extendedprice": "custom:sum(l_extendedprice * (1 - l_discount))", "l_quantity": "stdDev", "l_returnflag": "min"}, ("c_name", "lines"))
    lines = lines.select("c_name", F.col("l_partkey").alias("c_custkey"), F.col("l_extendedprice").alias("c_acctbal"), F.col("l_quantity").alias("c_nationkey"), F.col("l_returnflag").alias("c_mktsegment"))
    both = shown.unionByName(lines)
    return both.withColumns({"c_acctbal": F.round("c_acctbal", 2), "c_nationkey": F.round("c_nationkey", 6)})


@query("i2_calculated_column", "SELECT l_orderkey, l_linenumber, l_extendedprice * (1 - l_discount) * (1 + l_tax) AS charge FROM lineitem")
def _(t):
    return Q.calculated_column(t.lineitem, "charge", "l_extendedprice * (1 - l_discount) * (1 + l_tax)").select("l_orderkey", "l_linenumber", "charge")


@query(
    "i3_init_columns",
    """SELECT DISTINCT c_mktsegment AS sheet, 'clients' AS name, col, header FROM customer, (VALUES (1, 'c_custkey'), (2, 'Column2'), (3, 'c_nationkey'), (4, 'c_acctbal'), (5, 'c_mktsegment'), (6, 'Column6')) v(col, header)""",
)
def _(t):
    cells = customer_cells(t).filter(~((F.col("row") == 1) & (F.col("col") == 2)))
    tables = G.dimensions(cells).select("book", "sheet", F.lit("clients").alias("name"), "min_col", "min_row", (F.col("max_col") + 1).alias("max_col"), "max_row")
    return Q.init_columns(cells, tables).select("sheet", "name", "col", "header")
