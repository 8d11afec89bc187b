"""K: series analytics, mostly on daily event values by type."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridspark.operators import series as K
from suite.common import SUPPLIER_SQL, supplier_cells
from suite.registry import query

_EV = "WITH p AS (SELECT event_type AS series, date_diff('day', DATE '2023-12-31', ts::DATE)::BIGINT AS x, round(sum(value), 2) AS y FROM events GROUP BY ALL) "


def daily(t):
    """(series, x, y): value per event type and day number."""
    x = F.datediff(F.col("ts").cast("date"), F.lit("2023-12-31").cast("date")).cast("bigint")
    return t.events.groupBy(F.col("event_type").alias("series"), x.alias("x")).agg(F.round(F.sum("value"), 2).alias("y"))


def rounded(df, n, *cols):
    return df.withColumns({c: F.round(c, n) for c in cols})


@query(
    "k1_extract_series",
    SUPPLIER_SQL + """, v AS (SELECT * FROM cells WHERE "row" >= 2 AND v_num IS NOT NULL), h AS (SELECT * FROM cells WHERE "row" = 1)
       SELECT 'col' AS walk, v.sheet, v.col::INT AS series, h.v_str AS title, (v."row" - 2)::INT AS idx, x.v_num AS x, x.t AS x_text, v.v_num AS y FROM v JOIN h ON h.sheet = v.sheet AND h.col = v.col
         LEFT JOIN (SELECT *, coalesce(v_str, v_num::BIGINT::VARCHAR) AS t FROM cells WHERE "row" >= 2 AND col = 2) x ON x.sheet = v.sheet AND x."row" = v."row" WHERE v.col <> 2
       UNION ALL SELECT 'row', sheet, "row"::INT, 'Series' || "row", (col - 1)::INT, col::DOUBLE, col::VARCHAR, v_num FROM v""",
)
def _(t):
    cells = supplier_cells(t)
    a = K.extract_series(cells, "col", titles=True, x=2).withColumn("walk", F.lit("col"))
    b = K.extract_series(cells, "row", titles=False).withColumn("walk", F.lit("row"))
    return a.unionByName(b).drop("book")


@query("k2_stack_series", _EV + "SELECT series, x, y, round(sum(y) OVER (PARTITION BY x ORDER BY series), 4) AS top FROM p")
def _(t):
    return rounded(K.stack_series(daily(t)), 4, "top")


@query("k3_percent_stack", _EV + "SELECT series, x, round(100 * y / sum(y) OVER (PARTITION BY x), 6) AS y, round(100 * sum(y) OVER (PARTITION BY x ORDER BY series) / sum(y) OVER (PARTITION BY x), 6) AS top FROM p")
def _(t):
    return rounded(K.percent_stack(daily(t)), 6, "y", "top")


@query(
    "k4_trend_linear",
    _EV + """SELECT series, 'free' AS k, round(regr_intercept(y, x), 6) AS a, round(regr_slope(y, x), 6) AS b, round(regr_r2(y, x), 6) AS r2 FROM p GROUP BY 1
       UNION ALL SELECT series, 'fixed', 100, round(b, 6), round(1 - sse / sst, 6) FROM (SELECT series, sum(x * (y - 100)) / sum(x * x) AS b, sum((y - 100) * (y - 100)) - sum(x * (y - 100)) * sum(x * (y - 100)) / sum(x * x) AS sse, var_pop(y) * count(*) AS sst FROM p GROUP BY 1)""",
)
def _(t):
    free = K.trend_linear(daily(t), ["series"]).withColumn("k", F.lit("free"))
    fixed = K.trend_linear(daily(t), ["series"], 100).withColumn("k", F.lit("fixed"))
    return rounded(free.unionByName(fixed), 6, "a", "b", "r2")


@query(
    "k5_trend_exp",
    _EV + """SELECT series, 'exp' AS k, round(exp(regr_intercept(ln(y), x)), 6) AS a, round(regr_slope(ln(y), x), 6) AS b, round(regr_r2(ln(y), x), 6) AS r2 FROM p GROUP BY 1
       UNION ALL SELECT series, 'log', round(regr_intercept(y, ln(x)), 6), round(regr_slope(y, ln(x)), 6), round(regr_r2(y, ln(x)), 6) FROM p GROUP BY 1
       UNION ALL SELECT series, 'power', round(exp(regr_intercept(ln(y), ln(x))), 6), round(regr_slope(ln(y), ln(x)), 6), round(regr_r2(ln(y), ln(x)), 6) FROM p GROUP BY 1""",
)
def _(t):
    p = daily(t)
    out = None
    for k, fit in (("exp", K.trend_exp), ("log", K.trend_log), ("power", K.trend_power)):
        part = fit(p, ["series"]).withColumn("k", F.lit(k))
        out = part if out is None else out.unionByName(part)
    return rounded(out, 6, "a", "b", "r2")


_S = {f"s{i}": f"sum(power(x, {i})::DOUBLE)" for i in range(5)} | {f"t{i}": f"sum(power(x, {i})::DOUBLE * y)" for i in range(3)}


@query(
    "k6_trend_poly",
    _EV + ", m AS (SELECT series, " + ", ".join(f"{v} AS {k}" for k, v in _S.items()) + """ FROM p GROUP BY 1),
       d AS (SELECT *, s0 * (s2 * s4 - s3 * s3) - s1 * (s1 * s4 - s3 * s2) + s2 * (s1 * s3 - s2 * s2) AS det FROM m)
       SELECT series, round((t0 * (s2 * s4 - s3 * s3) - s1 * (t1 * s4 - s3 * t2) + s2 * (t1 * s3 - s2 * t2)) / det, 4) AS c0, round((s0 * (t1 * s4 - s3 * t2) - t0 * (s1 * s4 - s3 * s2) + s2 * (s1 * t2 - t1 * s2)) / det, 4) AS c1,
       round((s0 * (s2 * t2 - t1 * s3) - s1 * (s1 * t2 - t1 * s2) + t0 * (s1 * s3 - s2 * s2)) / det, 4) AS c2 FROM d""",
)
def _(t):
    fit = K.trend_poly(daily(t), ["series"], 2)
    return fit.select("series", *[F.round(F.get("coef", F.lit(i)), 4).alias(f"c{i}") for i in range(3)])


@query("k7_moving_avg", _EV + "SELECT series, x, CASE WHEN count(*) OVER w = 7 THEN round(avg(y) OVER w, 6) END AS ma FROM p WINDOW w AS (PARTITION BY series ORDER BY x ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)")
def _(t):
    return rounded(K.moving_avg(daily(t), ["series"], 7).drop("y"), 6, "ma")


@query(
    "k8_trend_extend",
    _EV + """, f AS (SELECT series, regr_intercept(y, x) AS a, regr_slope(y, x) AS b, min(x) AS lo, max(x) AS hi FROM p GROUP BY 1)
       SELECT series, (hi + d)::DOUBLE AS x, round(a + b * (hi + d), 6) AS y FROM f, (VALUES (1), (2), (3)) v(d) UNION ALL SELECT series, (lo - d)::DOUBLE, round(a + b * (lo - d), 6) FROM f, (VALUES (1), (2)) v(d)
       UNION ALL SELECT series || ' fine', round(hi + d, 6), round(a + b * (hi + d), 6) FROM f, (VALUES (0.1), (0.2), (0.3)) v(d)""",
)
def _(t):
    coarse = K.trend_extend(daily(t), ["series"], forward=3, backward=2)
    fine = K.trend_extend(daily(t), ["series"], forward=0.3, step=0.1).withColumn("series", F.concat("series", F.lit(" fine")))
    return rounded(coarse.unionByName(fine), 6, "x", "y")


@query(
    "k9_error_bars",
    """WITH s AS (SELECT l_returnflag AS f, avg(l_quantity) AS m, stddev_samp(l_quantity) AS d, count(*) AS n FROM lineitem GROUP BY 1)
       SELECT l_returnflag AS series, l_quantity AS y, l_quantity - 5 AS fixed_low, round(l_quantity * 1.1, 6) AS pct_high, round(m - 2 * d, 6) AS sd_low, round(l_quantity + d / sqrt(n), 6) AS se_high, l_quantity - l_linenumber AS cust_low, count(*) AS k
       FROM lineitem JOIN s ON f = l_returnflag GROUP BY ALL""",
)
def _(t):
    p = t.lineitem.select(F.col("l_returnflag").alias("series"), F.col("l_quantity").alias("y"), "l_linenumber", F.col("l_orderkey").alias("x"))
    steps = [("fixedVal", 5, "fixed_low", "low", {}), ("percentage", 10, "pct_high", "high", {}), ("stdDev", 2, "sd_low", "low", {}), ("stdErr", None, "se_high", "high", {}),
             ("cust", None, "cust_low", "low", {"plus": F.lit(0.0), "minus": F.col("l_linenumber")})]
    for kind, amount, name, side, more in steps:
        p = K.error_bars(p, ["series"], kind, amount, **more).withColumn(name, F.col(side)).drop("low", "high")
    p = rounded(p, 6, "pct_high", "sd_low", "se_high")
    return p.groupBy("series", "y", "fixed_low", "pct_high", "sd_low", "se_high", "cust_low").agg(F.count(F.lit(1)).alias("k"))


_HOURLY = """WITH p AS (SELECT event_type AS series, (epoch(date_trunc('hour', ts)) // 3600)::BIGINT AS x, round(sum(value), 2) AS y FROM events GROUP BY ALL),
  g AS (SELECT series, unnest(range(lo, hi + 1)) AS x FROM (SELECT series, min(x) AS lo, max(x) AS hi FROM p GROUP BY 1)), f AS (SELECT g.series, g.x, p.y FROM g LEFT JOIN p ON p.series = g.series AND p.x = g.x) """


@query(
    "k10_fill_blanks",
    _HOURLY + """, w AS (SELECT *, last_value(CASE WHEN y IS NOT NULL THEN x END IGNORE NULLS) OVER a AS lx, last_value(y IGNORE NULLS) OVER a AS ly, first_value(CASE WHEN y IS NOT NULL THEN x END IGNORE NULLS) OVER b AS rx, first_value(y IGNORE NULLS) OVER b AS ry FROM f
       WINDOW a AS (PARTITION BY series ORDER BY x ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), b AS (PARTITION BY series ORDER BY x ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
       SELECT series, x, y AS gap, coalesce(y, 0) AS zero, round(coalesce(y, ly + (x - lx) * (ry - ly) / (rx - lx)), 6) AS span FROM w""",
)
def _(t):
    # hours since 1970 from the wall clock, whatever the session's zone
    hour = (F.datediff(F.col("ts").cast("date"), F.lit("1970-01-01").cast("date")) * 24 + F.hour("ts")).cast("bigint")
    p = t.events.groupBy(F.col("event_type").alias("series"), hour.alias("x")).agg(F.round(F.sum("value"), 2).alias("y"))
    span = K.fill_blanks(p, ["series"], "span").withColumnRenamed("y", "span")
    zero = K.fill_blanks(p, ["series"], "zero").withColumnRenamed("y", "zero")
    gap = K.fill_blanks(p, ["series"], "gap").withColumnRenamed("y", "gap")
    return rounded(gap.join(zero, ["series", "x"]).join(span, ["series", "x"]), 6, "span")


@query(
    "k11_project_pie",
    """WITH a AS (SELECT c_nationkey, count(*) AS n FROM customer GROUP BY 1), f AS (SELECT *, row_number() OVER (ORDER BY c_nationkey DESC) <= 4 AS pos, n < 60 AS val, n * 100 < sum(n) OVER () * 4 AS pct, c_nationkey IN (3, 7) AS cust FROM a)
       SELECT 'pos' AS k, CASE WHEN pos THEN 'Other' ELSE c_nationkey::VARCHAR END AS item, sum(n)::BIGINT AS n FROM f GROUP BY 2 UNION ALL SELECT 'val', CASE WHEN val THEN 'Other' ELSE c_nationkey::VARCHAR END, sum(n)::BIGINT FROM f GROUP BY 2
       UNION ALL SELECT 'percent', CASE WHEN pct THEN 'Other' ELSE c_nationkey::VARCHAR END, sum(n)::BIGINT FROM f GROUP BY 2 UNION ALL SELECT 'cust', CASE WHEN cust THEN 'Other' ELSE c_nationkey::VARCHAR END, sum(n)::BIGINT FROM f GROUP BY 2""",
)
def _(t):
    a = t.customer.groupBy(F.col("c_nationkey").alias("item")).agg(F.count(F.lit(1)).alias("n"))
    out = None
    for kind, split in (("pos", 4), ("val", 60), ("percent", 4), ("cust", [3, 7])):
        part = K.pie_groups(K.project_pie(a, "n", kind, split, order="item", item="item"), "item", "n").withColumn("k", F.lit(kind))
        out = part if out is None else out.unionByName(part)
    return out


@query(
    "k12_hilo",
    _EV + "SELECT x, min(y) AS low, max(y) AS high, min_by(y, series) AS first, max_by(y, series) AS last, max_by(y, series) > min_by(y, series) AS up FROM p GROUP BY x",
)
def _(t):
    return K.hilo(daily(t))
