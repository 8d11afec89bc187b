"""J: pivots."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from gridspark.operators import pivot as P
from suite.registry import query


def rows():
    return F.count(F.lit(1)).alias("n")


def total(c: str, name: str):
    return F.sum(c).alias(name)


@query(
    "j1_pivot",
    """SELECT l_returnflag, round(sum(CASE WHEN l_linestatus = 'F' THEN l_extendedprice END), 2) AS F_price, count(CASE WHEN l_linestatus = 'F' THEN 1 END) AS F_lines,
       round(sum(CASE WHEN l_linestatus = 'O' THEN l_extendedprice END), 2) AS O_price, count(CASE WHEN l_linestatus = 'O' THEN 1 END) AS O_lines FROM lineitem GROUP BY 1""",
)
def _(t):
    data = [F.round(F.sum("l_extendedprice"), 2).alias("price"), F.count(F.lit(1)).alias("lines")]
    return P.pivot(t.lineitem, ["l_returnflag"], "l_linestatus", ["F", "O"], data)


@query(
    "j2_data_field",
    """SELECT l_orderkey, round(avg(l_quantity), 6) AS average, count(l_quantity) AS count, count(l_quantity) AS "countNums", max(l_quantity) AS max, min(l_quantity) AS min, product(l_linenumber) AS product,
       round(stddev_samp(l_quantity), 6) AS "stdDev", round(stddev_pop(l_quantity), 6) AS "stdDevp", sum(l_quantity) AS sum, round(var_samp(l_quantity), 6) AS var, round(var_pop(l_quantity), 6) AS varp FROM lineitem GROUP BY 1""",
)
def _(t):
    made = []
    for fn in P.FUNCTIONS:
        c = P.data_field(fn, "l_linenumber" if fn == "product" else "l_quantity", fn)
        made.append(F.round(c, 6).alias(fn) if fn in ("average", "stdDev", "stdDevp", "var", "varp") else c)
    return t.lineitem.groupBy("l_orderkey").agg(*made)


@query(
    "j3_pivot_subtotals",
    """WITH b AS (SELECT l_returnflag, l_linestatus, l_linenumber, l_quantity AS q FROM lineitem)
       SELECT l_returnflag, l_linestatus, l_linenumber, 3 AS level, 'sum' AS fn, round(sum(q), 4) AS value FROM b GROUP BY 1, 2, 3
       UNION ALL SELECT l_returnflag, l_linestatus, NULL, 2, 'average', round(avg(q), 4) FROM b GROUP BY 1, 2 UNION ALL SELECT l_returnflag, l_linestatus, NULL, 2, 'max', max(q) FROM b GROUP BY 1, 2
       UNION ALL SELECT l_returnflag, NULL, NULL, 1, 'sum', sum(q) FROM b GROUP BY 1 UNION ALL SELECT NULL, NULL, NULL, 0, 'sum', sum(q) FROM b""",
)
def _(t):
    out = P.pivot_subtotals(t.lineitem, ["l_returnflag", "l_linestatus", "l_linenumber"], "l_quantity", "sum", {"l_linestatus": ["average", "max"]})
    return out.withColumn("value", F.round("value", 4))


@query(
    "j4_pivot_grand",
    """SELECT l_returnflag, l_shipmode, ['body', 'column', 'row', 'grand'][(g + 1)::INT] AS part, q, n FROM (SELECT l_returnflag, l_linestatus AS l_shipmode, 2 * grouping(l_linestatus) + grouping(l_returnflag) AS g, sum(l_quantity) AS q, count(*) AS n
       FROM lineitem GROUP BY GROUPING SETS ((l_returnflag, l_linestatus), (l_returnflag), (l_linestatus), ()))""",
)
def _(t):
    return P.pivot_grand(t.lineitem, "l_returnflag", "l_linestatus", [total("l_quantity", "q"), rows()]).withColumnRenamed("l_linestatus", "l_shipmode")


@query(
    "j5_page_filter",
    """SELECT 'page' AS k, o_orderstatus AS item, count(*) AS n, false AS is_total FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderstatus <> 'P' GROUP BY 2
       UNION ALL SELECT 'all', o_orderpriority, count(*), false FROM orders WHERE o_orderpriority NOT IN ('5-LOW') GROUP BY 2 UNION ALL SELECT 'all', NULL, count(*), true FROM orders
       UNION ALL SELECT 'visual', o_orderpriority, count(*), false FROM orders WHERE o_orderpriority NOT IN ('5-LOW') GROUP BY 2 UNION ALL SELECT 'visual', NULL, count(*), true FROM orders WHERE o_orderpriority NOT IN ('5-LOW')""",
)
def _(t):
    o = t.orders
    page = P.page_filter(o, {"o_orderpriority": ["1-URGENT", "2-HIGH"]}, {"o_orderstatus": ["P"]}).groupBy(F.col("o_orderstatus").alias("item")).agg(rows()).withColumn("is_total", F.lit(False)).withColumn("k", F.lit("page"))
    both = [P.with_hidden(o, "o_orderpriority", ["5-LOW"], rows(), v).withColumnRenamed("o_orderpriority", "item").withColumn("k", F.lit(k)) for k, v in (("all", False), ("visual", True))]
    return page.unionByName(both[0]).unionByName(both[1])


def _by_year(t):
    return t.lineitem.groupBy("l_returnflag", F.year("l_shipdate").alias("y")).agg(total("l_quantity", "q"))


_YEAR = "WITH a AS (SELECT l_returnflag, year(l_shipdate)::INT AS y, sum(l_quantity) AS q FROM lineitem GROUP BY ALL) "


@query(
    "j6_show_vs_base",
    _YEAR + """SELECT l_returnflag, y, q, q - max(CASE WHEN y = 1997 THEN q END) OVER p AS diff, round(q / max(CASE WHEN y = 1997 THEN q END) OVER p, 9) AS pct, round((q - lag(q) OVER w) / lag(q) OVER w, 9) AS pct_prev, q - lead(q) OVER w AS diff_next
       FROM a WINDOW p AS (PARTITION BY l_returnflag), w AS (PARTITION BY l_returnflag ORDER BY y)""",
)
def _(t):
    a = _by_year(t)
    for base, mode, name in ((1997, "difference", "diff"), (1997, "percent", "pct"), ("previous", "percentDiff", "pct_prev"), ("next", "difference", "diff_next")):
        a = P.show_vs_base(a, "y", "q", base, mode, ["l_returnflag"], name)
    return a.withColumns({"pct": F.round("pct", 9), "pct_prev": F.round("pct_prev", 9)})


@query(
    "j7_show_running",
    """SELECT o_orderstatus, strftime(m, '%Y-%m') AS m, n, sum(n) OVER (PARTITION BY o_orderstatus ORDER BY m)::BIGINT AS running FROM (SELECT o_orderstatus, date_trunc('month', o_orderdate) AS m, count(*) AS n FROM orders GROUP BY ALL)""",
)
def _(t):
    a = t.orders.groupBy("o_orderstatus", F.date_format("o_orderdate", "yyyy-MM").alias("m")).agg(rows())
    return P.show_running(a, "m", "n", ["o_orderstatus"])


@query(
    "j8_show_share",
    _YEAR + """SELECT l_returnflag, y, round(q / sum(q) OVER (PARTITION BY l_returnflag), 9) AS of_row, round(q / sum(q) OVER (PARTITION BY y), 9) AS of_column, round(q / sum(q) OVER (), 9) AS of_total FROM a""",
)
def _(t):
    a = P.show_share(_by_year(t), "l_returnflag", "y", "q")
    return a.select("l_returnflag", "y", *[F.round(c, 9).alias(c) for c in ("of_row", "of_column", "of_total")])


@query(
    "j9_show_index",
    _YEAR + "SELECT l_returnflag, y, round(q * sum(q) OVER () / (sum(q) OVER (PARTITION BY l_returnflag) * sum(q) OVER (PARTITION BY y)), 9) AS index FROM a",
)
def _(t):
    return P.show_index(_by_year(t), "l_returnflag", "y", "q").select("l_returnflag", "y", F.round("index", 9).alias("index"))


@query(
    "j10_group_range",
    """SELECT place::INT AS place, label, count(*) AS n, sum(l_quantity) AS q FROM (SELECT *, CASE WHEN l_quantity < 5 THEN 0 WHEN l_quantity > 42 THEN 5 ELSE least(floor((l_quantity - 5) / 10) + 1, 4) END AS place,
       CASE WHEN l_quantity < 5 THEN '<5' WHEN l_quantity > 42 THEN '>42' WHEN l_quantity < 15 THEN '5-15' WHEN l_quantity < 25 THEN '15-25' WHEN l_quantity < 35 THEN '25-35' ELSE '35-42' END AS label FROM lineitem) GROUP BY 1, 2""",
)
def _(t):
    g = t.lineitem.select(P.group_range(F.col("l_quantity"), 5, 42, 10).alias("g"), "l_quantity").select("g.*", "l_quantity")
    return g.groupBy("place", "label").agg(rows(), total("l_quantity", "q"))


_GRAINS = ("seconds", "minutes", "hours", "days", "months", "quarters", "years")


@query(
    "j11_group_date",
    " UNION ALL ".join(f"SELECT '{g}' AS grain, strftime(date_trunc('{g[:-1]}', ts), '%Y-%m-%d %H:%M:%S') AS at, count(*) AS n FROM events GROUP BY 2" for g in _GRAINS)
    + " UNION ALL SELECT '7days', strftime(DATE '1995-01-01' + ((date_diff('day', DATE '1995-01-01', o_orderdate::DATE) // 7) * 7)::INT, '%Y-%m-%d 00:00:00'), count(*) FROM orders GROUP BY 2",
)
def _(t):
    shown = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias("at")
    grains = F.inline(F.array(*[F.struct(F.lit(g).alias("grain"), shown(P.group_date(F.col("ts"), g))) for g in _GRAINS]))
    e = t.events.select(grains).groupBy("grain", "at").agg(rows())
    o = t.orders.groupBy(F.lit("7days").alias("grain"), shown(P.group_date(F.col("o_orderdate"), "days", 7, dt.date(1995, 1, 1)))).agg(rows())
    return e.unionByName(o)


@query(
    "j12_group_discrete",
    """SELECT CASE WHEN p_type IN ('ECONOMY', 'SMALL') THEN 'basic' WHEN p_type IN ('PROMO') THEN 'offer' ELSE p_type END AS g, count(*) AS n, round(sum(p_retailprice), 2) AS v FROM part GROUP BY 1""",
)
def _(t):
    g = P.group_discrete(F.col("p_type"), {"basic": ["ECONOMY", "SMALL"], "offer": ["PROMO"]})
    return t.part.groupBy(g.alias("g")).agg(rows(), F.round(F.sum("p_retailprice"), 2).alias("v"))


_LABELS = {
    "captionEqual": (("red ring",), "x = 'red ring'"), "captionNotEqual": (("red ring",), "x <> 'red ring'"), "captionContains": (("ol",), "x LIKE '%ol%'"),
    "captionNotContains": (("ol",), "NOT x LIKE '%ol%'"), "captionBeginsWith": (("Blue",), "x LIKE 'blue%'"), "captionNotEndsWith": (("ring",), "NOT x LIKE '%ring'"),
    "captionGreaterThan": (("m",), "x > 'm'"), "captionLessThanOrEqual": (("m",), "x <= 'm'"), "captionBetween": (("b", "h"), "x BETWEEN 'b' AND 'h'"), "captionNotBetween": (("b", "h"), "NOT x BETWEEN 'b' AND 'h'"),
}


@query(
    "j13_label_filter",
    " UNION ALL ".join(f"SELECT '{k}' AS kind, p_brand, count(*) AS n FROM (SELECT *, lower(p_name) AS x FROM part) WHERE {sql} GROUP BY 2" for k, (_, sql) in _LABELS.items()),
)
def _(t):
    marks = F.inline(F.array(*[F.struct(F.lit(k).alias("kind"), P.label_filter(F.col("p_name"), k, *terms).alias("hit")) for k, (terms, _) in _LABELS.items()]))
    return t.part.select("p_brand", marks).filter("hit").groupBy("kind", "p_brand").agg(rows())


@query(
    "j14_value_filter_pivot",
    """WITH a AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) SELECT 'ge' AS k, o_custkey, n FROM a WHERE n >= 15 UNION ALL SELECT 'between', o_custkey, n FROM a WHERE n BETWEEN 3 AND 5
       UNION ALL SELECT 'not', o_custkey, n FROM a WHERE NOT n BETWEEN 5 AND 14 UNION ALL SELECT 'ne', o_custkey, n FROM a WHERE n <> 10""",
)
def _(t):
    a = t.orders.groupBy("o_custkey").agg(rows())
    parts = [("ge", "valueGreaterThanOrEqual", (15,)), ("between", "valueBetween", (3, 5)), ("not", "valueNotBetween", (5, 14)), ("ne", "valueNotEqual", (10,))]
    out = None
    for k, kind, terms in parts:
        p = P.value_filter(a, "n", kind, *terms).select(F.lit(k).alias("k"), "o_custkey", "n")
        out = p if out is None else out.unionByName(p)
    return out


_DAY = dt.date(1997, 6, 10)
_DATES = {
    "dateEqual": ((_DAY,), "d = DATE '1997-06-10'"), "dateNotEqual": ((_DAY,), "d <> DATE '1997-06-10'"), "dateOlderThan": ((_DAY,), "d < DATE '1997-06-10'"), "dateNewerThanOrEqual": ((_DAY,), "d >= DATE '1997-06-10'"),
    "dateBetween": ((dt.date(1996, 1, 1), _DAY), "d BETWEEN DATE '1996-01-01' AND DATE '1997-06-10'"), "dateNotBetween": ((dt.date(1996, 1, 1), _DAY), "d NOT BETWEEN DATE '1996-01-01' AND DATE '1997-06-10'"),
    "lastMonth": ((), "date_trunc('month', d) = DATE '1997-05-01'"), "Q3": ((), "quarter(d) = 3"), "M11": ((), "month(d) = 11"),
}


@query("j15_date_filter", "SELECT o_orderstatus, " + ", ".join(f"count_if({s})::BIGINT AS {k}" for k, (_, s) in _DATES.items()) + " FROM (SELECT *, o_orderdate::DATE AS d FROM orders) GROUP BY 1")
def _(t):
    c = F.col("o_orderdate")
    return t.orders.groupBy("o_orderstatus").agg(*[F.count_if(P.date_filter(c, k, *terms, today=_DAY)).alias(k) for k, (terms, _) in _DATES.items()])


@query(
    "j16_top_by_measure",
    """WITH a AS (SELECT o_custkey, round(sum(o_totalprice)) AS v FROM orders GROUP BY 1), r AS (SELECT *, sum(v) OVER (ORDER BY v DESC) AS cum, sum(v) OVER (ORDER BY v) AS up, sum(v) OVER () AS s, rank() OVER (ORDER BY v DESC) AS k FROM a),
       e AS (SELECT max(CASE WHEN cum >= s * 0.2 THEN v END) AS pct, max(CASE WHEN cum >= 50000000 THEN v END) AS amt, min(CASE WHEN up >= 1000000 THEN v END) AS low FROM r)
       SELECT 'count' AS kind, o_custkey, v FROM r WHERE k <= 12 UNION ALL SELECT 'percent', o_custkey, v FROM r, e WHERE v >= pct UNION ALL SELECT 'sum', o_custkey, v FROM r, e WHERE v >= amt UNION ALL SELECT 'bottom', o_custkey, v FROM r, e WHERE v <= low""",
)
def _(t):
    a = t.orders.groupBy("o_custkey").agg(F.round(F.sum("o_totalprice")).alias("v"))
    parts = [("count", "count", 12, False), ("percent", "percent", 20, False), ("sum", "sum", 50000000, False), ("bottom", "sum", 1000000, True)]
    out = None
    for k, kind, amount, bottom in parts:
        p = P.top_by_measure(a, "v", kind, amount, bottom).select(F.lit(k).alias("kind"), "o_custkey", "v")
        out = p if out is None else out.unionByName(p)
    return out


@query(
    "j17_sort_items",
    """WITH a AS (SELECT p_brand, count(*) AS n FROM part GROUP BY 1) SELECT 'asc' AS k, p_brand, row_number() OVER (ORDER BY p_brand)::INT AS place FROM a UNION ALL SELECT 'desc', p_brand, row_number() OVER (ORDER BY p_brand DESC)::INT FROM a
       UNION ALL SELECT 'data', p_brand, row_number() OVER (ORDER BY n DESC, p_brand)::INT FROM a UNION ALL SELECT 'manual', p_brand, row_number() OVER (ORDER BY CASE p_brand WHEN 'Brand#9' THEN 1 WHEN 'Brand#3' THEN 2 ELSE 3 END, p_brand)::INT FROM a""",
)
def _(t):
    a = t.part.groupBy("p_brand").agg(rows())
    parts = [("asc", {}), ("desc", {"how": "descending"}), ("data", {"how": "descending", "by": "n"}), ("manual", {"how": "manual", "manual": ["Brand#9", "Brand#3"]})]
    out = None
    for k, how in parts:
        p = P.sort_items(a, "p_brand", **how).select(F.lit(k).alias("k"), "p_brand", "place")
        out = p if out is None else out.unionByName(p)
    return out


@query(
    "j18_calc_field",
    """WITH a AS (SELECT l_returnflag, l_linestatus, sum(l_quantity) AS q, count(*) AS n FROM lineitem GROUP BY ALL), u AS (SELECT l_returnflag, l_linestatus, q FROM a UNION ALL SELECT 'A-R', l_linestatus, sum(CASE l_returnflag WHEN 'A' THEN q WHEN 'R' THEN -0.5 * q END) FROM a WHERE l_returnflag IN ('A', 'R') GROUP BY 2)
       SELECT 'item' AS k, l_returnflag, l_linestatus, q AS v FROM u UNION ALL SELECT 'field', l_returnflag, l_linestatus, round(q / n, 9) FROM a""",
)
def _(t):
    a = t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(total("l_quantity", "q"), rows())
    field = P.calc_field(a, "v", "round(q / n, 9)").select(F.lit("field").alias("k"), "l_returnflag", "l_linestatus", "v")
    item = P.calc_item(a.drop("n"), "l_returnflag", "A-R", {"A": 1, "R": -0.5}, "q", ["l_linestatus"]).select(F.lit("item").alias("k"), "l_returnflag", "l_linestatus", F.col("q").alias("v"))
    return field.unionByName(item)


@query(
    "j19_show_empty",
    """SELECT s AS o_orderstatus, p AS o_orderpriority, coalesce(n, 0)::BIGINT AS n FROM (VALUES ('F'), ('O'), ('P'), ('X')) a(s), (VALUES ('1-URGENT'), ('2-HIGH'), ('3-MEDIUM'), ('4-NOT SPECIFIED'), ('5-LOW')) b(p)
       LEFT JOIN (SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY ALL) ON s = o_orderstatus AND p = o_orderpriority""",
)
def _(t):
    a = t.orders.groupBy("o_orderstatus", "o_orderpriority").agg(rows())
    return P.show_empty(a, {"o_orderstatus": ["F", "O", "P", "X"], "o_orderpriority": ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]}, {"n": 0})


@query(
    "j20_consolidate",
    """SELECT 'orders' AS page1, o_orderpriority AS page2, year(o_orderdate)::INT AS y, count(*) AS n, round(sum(o_totalprice), 2) AS v FROM orders GROUP BY ALL
       UNION ALL SELECT 'lines', NULL, year(l_shipdate)::INT, count(*), round(sum(l_extendedprice), 2) FROM lineitem GROUP BY ALL""",
)
def _(t):
    o = t.orders.select(F.year("o_orderdate").alias("y"), F.col("o_totalprice").alias("v"), F.col("o_orderpriority").alias("page2"))
    li = t.lineitem.select(F.year("l_shipdate").alias("y"), F.col("l_extendedprice").alias("v"))
    both = P.consolidate([(o, ["orders"]), (li, ["lines"])])
    return both.groupBy("page1", "page2", "y").agg(rows(), F.round(F.sum("v"), 2).alias("v"))
