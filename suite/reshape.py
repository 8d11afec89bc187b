"""M1–M20: reshaping, recoding, lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridspark.operators import grid as G
from gridspark.operators import reshape as M
from gridspark.plans import costs as X
from suite.common import SUPPLIER_SQL, customer_cells, supplier_cells
from suite.registry import query


def rows():
    return F.count(F.lit(1)).alias("n")


@query(
    "m1_compose_header",
    SUPPLIER_SQL + """, h AS (SELECT sheet, col, coalesce(max(CASE WHEN "row" = 1 THEN coalesce(v_str, v_num::BIGINT::VARCHAR) END), '') || ' ' || coalesce(max(CASE WHEN "row" = 2 AND col <> 4 THEN coalesce(v_str, v_num::BIGINT::VARCHAR) END), '') AS label FROM cells GROUP BY ALL)
       SELECT sheet, col::INT AS col, CASE WHEN col = 1 THEN 'Year' ELSE trim(label) END AS label FROM h""",
)
def _(t):
    cells = supplier_cells(t).filter(~((F.col("row") == 2) & (F.col("col") == 4)))
    return M.compose_header(cells, [1, 2], {0: "Year"}).drop("book")


# header of three levels: a group over every two columns, a name, a unit that is often blank
def _tall(t):
    cells = customer_cells(t)
    at = lambda r: F.col("row") == r
    text = (
        F.when(at(1) & F.col("col").isin(1, 3), F.concat(F.lit("g"), "col"))
        .when(at(2) & (F.col("col") != 4), F.col("v_str"))
        .when(at(3) & F.col("col").isin(2, 3), F.concat(F.lit("u"), "col"))
    )
    lifted = cells.withColumn("row", F.when(at(1), 2).otherwise(F.col("row") + 2))
    top = cells.filter(at(1)).withColumn("row", F.explode(F.array(F.lit(1), F.lit(3))))
    grid = lifted.unionByName(top)
    return grid.withColumn("v_str", F.when(F.col("row") <= 3, text).otherwise(F.col("v_str")))


@query(
    "m2_flatten_header",
    """SELECT DISTINCT c_mktsegment AS sheet, col, label FROM customer, (VALUES (1, 'Year'), (2, 'g1,c_name,u2'), (3, 'g3,c_nationkey,u3'), (4, 'g3,c_nationkey,u3'), (5, 'g3,c_mktsegment,Unnamed: 4_level_2')) v(col, label)""",
)
def _(t):
    flat = M.flatten_header(_tall(t), [1, 2, 3], sep=",", special={"Year": ("c_custkey", "any level equals")})
    return flat.select("sheet", "col", "label")


@query(
    "m3_drop_null_cols",
    """SELECT 'cols' AS k, c_custkey, c_name, c_mktsegment FROM customer UNION ALL SELECT 'rows', c_custkey, c_name, c_mktsegment FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderkey % 3 = 0)""",
)
def _(t):
    some = t.orders.filter("o_orderkey % 3 = 0").groupBy("o_custkey").agg(F.max("o_totalprice").alias("top"))
    j = t.customer.join(some, F.col("c_custkey") == F.col("o_custkey"), "left").select("c_custkey", "c_name", "c_mktsegment", "top", "o_custkey")
    a = M.drop_null_cols(j).withColumn("k", F.lit("cols"))
    return a.unionByName(M.drop_null_rows(j).drop("top", "o_custkey").withColumn("k", F.lit("rows")))


@query("m4_drop_dup_cols", "SELECT DISTINCT c_mktsegment AS sheet, col, label FROM customer, (VALUES (1, 'c_custkey'), (2, 'c_name'), (3, 'c_nationkey'), (5, 'c_mktsegment')) v(col, label)")
def _(t):
    head = customer_cells(t).filter("row = 1")
    named = head.select("book", "sheet", "col", F.when(F.col("col") == 4, "c_nationkey").otherwise(F.col("v_str")).alias("label"))
    return M.drop_dup_cols(named).drop("book")


@query(
    "m5_melt",
    "SELECT l_orderkey, l_linenumber, measure, value, count(*) AS n FROM (UNPIVOT (SELECT l_orderkey, l_linenumber, l_quantity, l_discount, l_tax FROM lineitem) ON l_quantity, l_discount, l_tax INTO NAME measure VALUE value) GROUP BY ALL",
)
def _(t):
    m = M.melt(t.lineitem, ["l_orderkey", "l_linenumber"], ["l_quantity", "l_discount", "l_tax"], "measure", "value")
    return m.groupBy("l_orderkey", "l_linenumber", "measure", "value").agg(rows())


@query(
    "m6_split_label",
    "SELECT o_orderkey, split_part(o_orderpriority, '-', 1) AS rank, nullif(split_part(o_orderpriority, '-', 2), '') AS word, NULL::VARCHAR AS more FROM orders",
)
def _(t):
    return M.split_label(t.orders, "o_orderpriority", ["rank", "word", "more"], "-").select("o_orderkey", "rank", "word", "more")


@query(
    "m7_pivot_mean",
    """SELECT year(l_shipdate)::INT AS y, l_returnflag, round(avg(CASE WHEN l_linenumber = 1 THEN l_quantity END), 6) AS p1, round(avg(CASE WHEN l_linenumber = 2 THEN l_quantity END), 6) AS p2, round(avg(CASE WHEN l_linenumber = 3 THEN l_quantity END), 6) AS p3, round(avg(CASE WHEN l_linenumber = 4 THEN l_quantity END), 6) AS p4,
       round(avg(CASE WHEN l_linenumber = 5 THEN l_quantity END), 6) AS p5, round(avg(CASE WHEN l_linenumber = 6 THEN l_quantity END), 6) AS p6, round(avg(CASE WHEN l_linenumber = 7 THEN l_quantity END), 6) AS p7 FROM lineitem GROUP BY ALL""",
)
def _(t):
    long = t.lineitem.select(F.year("l_shipdate").alias("y"), "l_returnflag", F.concat(F.lit("p"), "l_linenumber").alias("p"), "l_quantity")
    wide = M.pivot_mean(long, ["y", "l_returnflag"], "p", [f"p{i}" for i in range(1, 8)], "l_quantity")
    return wide.select("y", "l_returnflag", *[F.round(f"p{i}", 6).alias(f"p{i}") for i in range(1, 8)])


_KEYS = "nullif(l_returnflag, 'N') AS flag, l_linestatus AS status"


def _keyed(t):
    return t.lineitem.select(F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).alias("flag"), F.col("l_linestatus").alias("status"), "l_quantity", "l_tax", "l_linenumber")


@query(
    "m8_natural_join",
    f"""WITH a AS (SELECT {_KEYS}, sum(l_quantity) AS q FROM lineitem GROUP BY ALL), b AS (SELECT {_KEYS}, count(*) AS n FROM lineitem WHERE l_linenumber > 2 GROUP BY ALL)
       SELECT a.flag, a.status, q, n FROM a JOIN b ON a.flag IS NOT DISTINCT FROM b.flag AND a.status = b.status""",
)
def _(t):
    k = _keyed(t)
    a = k.groupBy("flag", "status").agg(F.sum("l_quantity").alias("q"))
    return M.natural_join(a, k.filter("l_linenumber > 2").groupBy("flag", "status").agg(rows()))


@query(
    "m9_natural_outer",
    """SELECT k, coalesce(a, 0)::BIGINT AS a, coalesce(b, 0)::BIGINT AS b, coalesce(c, 0)::BIGINT AS c, coalesce(d, 0)::DOUBLE AS d FROM (SELECT DISTINCT o_custkey AS k FROM orders)
       LEFT JOIN (SELECT o_custkey AS k, count(*) AS a FROM orders WHERE o_orderkey % 5 = 0 GROUP BY 1) USING (k) LEFT JOIN (SELECT o_custkey AS k, count(*) AS b FROM orders WHERE o_orderkey % 5 = 1 GROUP BY 1) USING (k)
       LEFT JOIN (SELECT o_custkey AS k, count(*) AS c FROM orders WHERE o_orderkey % 5 = 2 GROUP BY 1) USING (k) LEFT JOIN (SELECT o_custkey AS k, max(o_totalprice) AS d FROM orders WHERE o_orderkey % 5 > 2 GROUP BY 1) USING (k)""",
)
def _(t):
    o = t.orders.withColumn("k", F.col("o_custkey"))
    part = lambda i, agg: o.filter(F.least(F.col("o_orderkey") % 5, F.lit(3)) == i).groupBy("k").agg(agg)
    n = F.count(F.lit(1))
    return M.natural_outer([part(0, n.alias("a")), part(1, n.alias("b")), part(2, n.alias("c")), part(3, F.max("o_totalprice").alias("d"))], ["a", "b", "c", "d"])


@query(
    "m10_concat_fill",
    "SELECT c_name AS name, c_nationkey AS nation, c_acctbal AS balance, 0::BIGINT AS suppkey FROM customer UNION ALL SELECT s_name, s_nationkey, 0, s_suppkey FROM supplier",
)
def _(t):
    c = t.customer.select(F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("balance"))
    s = t.supplier.select(F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation"), F.col("s_suppkey").alias("suppkey"))
    return M.concat_fill([c, s])


@query(
    "m11_recode",
    """SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 'CB' WHEN 'MACHINERY' THEN 'CC' END AS auc, CASE c_mktsegment WHEN 'BUILDING' THEN 'CB' WHEN 'MACHINERY' THEN 'CC' ELSE c_mktsegment END AS kept FROM customer""",
)
def _(t):
    m = {"BUILDING": "CB", "MACHINERY": "CC"}
    return t.customer.select("c_custkey", M.recode(F.col("c_mktsegment"), m, fallback=False).alias("auc"), M.recode(F.col("c_mktsegment"), m).alias("kept"))


@query(
    "m12_where_chain",
    "SELECT p_partkey, CASE WHEN p_type = 'PROMO' THEN 'promo' WHEN p_name LIKE '%ring%' THEN p_brand WHEN p_size > 40 THEN 'big' ELSE p_type END AS kind FROM part",
)
def _(t):
    kind = M.where_chain([(F.col("p_type") == "PROMO", "promo"), (F.col("p_name").contains("ring"), F.col("p_brand")), (F.col("p_size") > 40, "big")], F.col("p_type"))
    return t.part.select("p_partkey", kind.alias("kind"))


@query("m13_strip_label", "SELECT p_partkey, trim(replace(p_brand || ' ' || p_name || ' ' || p_type, p_name, '')) AS label FROM part")
def _(t):
    return t.part.select("p_partkey", M.strip_label(F.concat_ws(" ", "p_brand", "p_name", "p_type"), F.col("p_name")).alias("label"))


@query(
    "m14_parse_bands",
    """SELECT p_partkey, p_size AS lower, CASE p_partkey % 4 WHEN 0 THEN p_size + 30 WHEN 1 THEN 999999 WHEN 2 THEN p_size + 50 ELSE 999999 END::INT AS upper FROM part""",
)
def _(t):
    z, k = F.col("p_size"), F.col("p_partkey") % 4
    text = (F.when(k == 0, F.concat(z, F.lit("-"), z + 30)).when(k == 1, F.concat(z, F.lit(" and over"))).when(k == 2, F.concat(z, F.lit("-"), z + 50, F.lit("km"))).otherwise(F.concat(z, F.lit("+km"))))
    return t.part.select("p_partkey", M.parse_bands(text).alias("b")).select("p_partkey", "b.*")


_BANDS = ["0-10", "11-25", "26-40", "41 and over"]


@query(
    "m15_band_join",
    """SELECT l_returnflag, CASE WHEN q <= 10 THEN '0-10' WHEN q BETWEEN 11 AND 25 THEN '11-25' WHEN q BETWEEN 26 AND 40 THEN '26-40' WHEN q >= 41 THEN '41 and over' END AS band, count(*) AS n, sum(q) AS q
       FROM (SELECT l_returnflag, CASE l_linenumber WHEN 1 THEN l_quantity + 0.5 WHEN 2 THEN l_quantity * 100000 ELSE l_quantity END AS q FROM lineitem) GROUP BY ALL""",
)
def _(t):
    bands = t.spark.range(1).select(F.explode(F.array(*[F.lit(b) for b in _BANDS])).alias("band")).select("band", M.parse_bands(F.col("band")).alias("b")).select("band", "b.*")
    n, v = F.col("l_linenumber"), F.col("l_quantity")
    q = F.when(n == 1, v + 0.5).when(n == 2, v * 100_000).otherwise(v)  # some between two bands, some beyond the last bound
    return M.band_join(t.lineitem.select("l_returnflag", q.alias("q")), "q", bands).groupBy("l_returnflag", "band").agg(rows(), F.sum("q").alias("q"))


@query(
    "m16_discount_factor",
    """SELECT o_orderkey, CASE WHEN n >= 0 THEN round(o_totalprice * pow(1.035, -least(n, 3)) * pow(1.03, -greatest(n - 3, 0)), 4) END AS present, CASE WHEN n >= 0 THEN round(pow(1.015, -least(n, 3)) * pow(1.0129, -greatest(n - 3, 0)), 9) END AS health FROM (SELECT *, year(o_orderdate) - 1997 AS n FROM orders)""",
)
def _(t):
    one = lambda a, b, r, h: F.struct(F.lit(a).alias("Lower_Bound"), F.lit(b).alias("Upper_Bound"), F.lit(r).alias("std"), F.lit(h).alias("health"))
    schedule = t.spark.range(1).select(F.inline(F.array(one(0, 3, 0.035, 0.015), one(4, M.OPEN_TOP, 0.03, 0.0129))))
    last = t.orders.agg(F.max(F.year("o_orderdate"))).first()[0] or 1997
    factors = X.discount_factor(schedule, ["std", "health"], max(0, last - 1997), 1997)
    joined = t.orders.withColumn("year", F.year("o_orderdate")).join(F.broadcast(factors), "year", "left")  # a year before the base has no factor
    return joined.select("o_orderkey", F.round(F.col("o_totalprice") * F.col("factor_0"), 4).alias("present"), F.round("factor_1", 9).alias("health"))


@query("m17_project", "SELECT l_orderkey AS order_id, 'GBP' AS unit, l_quantity AS qty, l_linenumber AS line FROM lineitem")
def _(t):
    return t.lineitem.withColumnsRenamed({"l_orderkey": "order_id", "l_quantity": "qty", "l_linenumber": "line"}).withColumn("unit", F.lit("GBP")).select("line", "order_id", "unit", "qty")


@query(
    "m18_populate",
    "SELECT seg, nation, period, term, n FROM (SELECT c_mktsegment AS seg, c_nationkey AS nation, count(*) AS n FROM customer GROUP BY ALL), (VALUES ('7am-10am'), ('10am-4pm'), ('4pm-7pm')) p(period), (VALUES ('DIST'), ('TIME'), ('TOLL')) q(term)",
)
def _(t):
    base = t.customer.groupBy(F.col("c_mktsegment").alias("seg"), F.col("c_nationkey").alias("nation")).agg(rows())
    return M.populate(base, {"period": X.PERIODS[:3], "term": X.TERMS})


@query(
    "m19_lookup_first",
    """WITH f AS (SELECT s_nationkey, min_by(s_name, s_suppkey) AS s_name, min_by(s_acctbal, s_suppkey) AS s_acctbal FROM supplier WHERE s_nationkey <> 7 GROUP BY 1)
       SELECT l_orderkey, l_linenumber, l_extendedprice, s_name, s_acctbal FROM lineitem LEFT JOIN f ON l_partkey % 30 = s_nationkey""",
)
def _(t):
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice", (F.col("l_partkey") % 30).cast("int").alias("key"))
    return M.lookup_first(li, t.supplier.filter("s_nationkey <> 7"), {"key": "s_nationkey"}, ["s_name", "s_acctbal"], order="s_suppkey").drop("key")


@query(
    "m20_params",
    "SELECT l_returnflag, round(sum(l_quantity * 0.4), 4) AS a, round(sum(l_quantity * 0.7), 4) AS b, round(sum(l_quantity * 2.5), 4) AS f, count_if(year(l_shipdate) = 1999)::BIGINT AS in_year FROM lineitem GROUP BY 1",
)
def _(t):
    p = X.params(t.spark, {"model_year": 1999, "ogv2": 0.7})
    one = p.select(F.struct("*").alias("p")).scalar()
    q = F.col("l_quantity")
    return t.lineitem.groupBy("l_returnflag").agg(
        F.round(F.sum(q * one["ogv1"]), 4).alias("a"), F.round(F.sum(q * one["ogv2"]), 4).alias("b"), F.round(F.sum(q * one["hgv_vot_factor"]), 4).alias("f"),
        F.count_if(F.year("l_shipdate") == one["model_year"]).alias("in_year"))


def _sheets(t):
    """Two parameter sheets per return flag, their numbers averages over the fact table."""
    li = t.lineitem.withColumns({"y": F.year("l_shipdate"), "book": F.col("l_returnflag")})
    num, text = F.lit(None).cast("double"), F.lit(None).cast("string")
    one = lambda c, v, s: F.struct(F.lit(c).alias("col"), v.alias("v_num"), s.alias("v_str"))
    per_year = li.groupBy("book", "y").agg(*[F.round(F.avg(F.when(F.least("l_linenumber", F.lit(6)) == i, F.col("l_quantity"))), 6).alias(f"q{i}") for i in range(1, 7)])
    at = (F.col("y") - 1995).cast("int")
    costs = per_year.select("book", F.lit("A1.3.15").alias("sheet"), (at + 26).alias("row"), F.inline(F.array(one(2, F.col("y").cast("double"), text), *[one(3 + i, F.col(f"q{i}"), text) for i in range(1, 7)])))
    shares = per_year.select("book", F.lit("A1.3.9").alias("sheet"), (at + 26).alias("row"), F.inline(F.array(one(2, F.col("y").cast("double"), text), *[one(2 + i, F.col(f"q{i}"), text) for i in range(1, 4)])))
    heads = li.select("book").distinct()
    top = heads.select("book", F.lit("A1.3.9").alias("sheet"), F.lit(24).alias("row"), F.inline(F.array(one(3, num, F.lit("Cars")), one(5, num, F.lit("LGV")))))
    low = heads.select("book", F.lit("A1.3.9").alias("sheet"), F.lit(25).alias("row"), F.inline(F.array(one(2, num, F.lit("Year")), one(3, num, F.lit("Petrol")), one(4, num, F.lit("Diesel")), one(5, num, F.lit("Electric")))))
    cells = costs.unionByName(shares).unionByName(top).unionByName(low).withColumn("dtype", F.lit(None).cast("string"))
    return G.as_cells(cells)


_PER_YEAR = "WITH p AS (SELECT l_returnflag AS book, year(l_shipdate)::INT AS y, " + ", ".join(f"round(avg(CASE WHEN least(l_linenumber, 6) = {i} THEN l_quantity END), 6) AS q{i}" for i in range(1, 7)) + " FROM lineitem GROUP BY ALL) "


@query(
    "m34_run_sheet_spec",
    _PER_YEAR + """, u AS (SELECT book, y, 'Work' AS a, 'Car' AS b, q1 AS v1, q2 AS v2, 3 AS k FROM p UNION ALL SELECT book, y, 'Non-work', 'Car', q3, q4, 2 FROM p UNION ALL SELECT book, y, 'Average', 'Car', q5, q6, 1 FROM p),
       f AS (SELECT book, y, 'Cars' AS a, 'Petrol' AS b, q1 AS v, 1 AS k FROM p UNION ALL SELECT book, y, 'Cars', 'Diesel', q2, 2 FROM p UNION ALL SELECT book, y, 'LGV', 'Electric', q3, 3 FROM p)
       SELECT 'nonfuel_cost_forecast' AS spec, book, row_number() OVER (PARTITION BY book ORDER BY k, y) AS row_no, y, a, b, v1, v2 FROM u UNION ALL SELECT 'fleet_share', book, row_number() OVER (PARTITION BY book ORDER BY k, y), y, a, b, v, NULL FROM f""",
)
def _(t):
    from gridspark.plans.sheet_specs import run_sheet_spec

    cells = _sheets(t)
    c = run_sheet_spec(cells, "nonfuel_cost_forecast").select(F.lit("nonfuel_cost_forecast").alias("spec"), "book", "row_no", F.col("Year").alias("y"), F.col("Trip_Purpose").alias("a"), F.col("Vehicle_Type").alias("b"), F.col("Param_a1").alias("v1"), F.col("Param_b1").alias("v2"))
    s = run_sheet_spec(cells, "fleet_share").select(F.lit("fleet_share").alias("spec"), "book", "row_no", F.col("Year").alias("y"), F.col("Mode").alias("a"), F.col("Fuel_Type").alias("b"), F.col("Value").alias("v1"), F.lit(None).cast("double").alias("v2"))
    return c.unionByName(s)
