"""F: auto-filters and sorts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from gridspark.operators import filters as L
from gridspark.operators import rules as R
from suite.registry import query


def C():
    return F.count(F.lit(1)).alias("n")


@query(
    "f1_value_filter",
    """SELECT 'orders' AS t, o_orderkey AS id FROM orders WHERE o_orderpriority IN ('1-URGENT', '5-LOW')
       UNION ALL SELECT 'joined', c_custkey FROM customer LEFT JOIN (SELECT o_custkey, max(o_orderstatus) AS s FROM orders GROUP BY 1) ON c_custkey = o_custkey WHERE s IN ('P') OR s IS NULL""",
)
def _(t):
    a = L.value_filter(t.orders, "o_orderpriority", ["1-URGENT", "5-LOW"]).select(F.lit("orders").alias("t"), F.col("o_orderkey").alias("id"))
    last = t.orders.groupBy("o_custkey").agg(F.max("o_orderstatus").alias("s"))
    joined = t.customer.join(last, F.col("c_custkey") == F.col("o_custkey"), "left")
    return a.unionByName(L.value_filter(joined, "s", ["P"], blank=True).select(F.lit("joined").alias("t"), F.col("c_custkey").alias("id")))


@query(
    "f2_date_group_filter",
    """SELECT 'o' AS t, o_orderkey AS id FROM orders WHERE year(o_orderdate) = 1996 OR (year(o_orderdate) = 1997 AND month(o_orderdate) = 5) OR o_orderdate = '1998-02-03'
       UNION ALL SELECT 'e', event_id FROM events WHERE date_trunc('hour', ts) = '2024-01-05 07:00:00' OR date_trunc('minute', ts) = '2024-01-06 08:10:00' OR date_trunc('second', ts) = '2024-01-01 00:00:07'""",
)
def _(t):
    o = L.date_group_filter(t.orders, "o_orderdate", [{"year": 1996}, {"year": 1997, "month": 5}, {"year": 1998, "month": 2, "day": 3}])
    e = L.date_group_filter(t.events, "ts", [
        {"year": 2024, "month": 1, "day": 5, "hour": 7}, {"year": 2024, "month": 1, "day": 6, "hour": 8, "minute": 10},
        {"year": 2024, "month": 1, "day": 1, "hour": 0, "minute": 0, "second": 7}])
    return o.select(F.lit("o").alias("t"), F.col("o_orderkey").alias("id")).unionByName(e.select(F.lit("e").alias("t"), F.col("event_id").alias("id")))


@query(
    "f3_custom_filter",
    """SELECT 'and' AS k, l_returnflag, count(*) AS n FROM lineitem WHERE l_quantity > 10 AND l_quantity <= 20 GROUP BY 2
       UNION ALL SELECT 'or', l_returnflag, count(*) FROM lineitem WHERE l_quantity < 5 OR l_quantity >= 45 GROUP BY 2
       UNION ALL SELECT 'eq', l_returnflag, count(*) FROM lineitem WHERE l_quantity = 7 GROUP BY 2 UNION ALL SELECT 'ne', l_returnflag, count(*) FROM lineitem WHERE l_quantity <> 7 GROUP BY 2""",
)
def _(t):
    specs = {
        "and": ([("greaterThan", 10), ("lessThanOrEqual", 20)], True), "or": ([("lessThan", 5), ("greaterThanOrEqual", 45)], False),
        "eq": ([("equal", 7)], False), "ne": ([("notEqual", 7)], False),
    }
    out = None
    for k, (tests, both) in specs.items():
        part = L.custom_filter(t.lineitem, "l_quantity", tests, both).groupBy("l_returnflag").agg(C()).withColumn("k", F.lit(k))
        out = part if out is None else out.unionByName(part)
    return out


@query(
    "f4_text_filter",
    """SELECT 'contains' AS k, p_partkey AS id FROM part WHERE lower(p_name) LIKE '%in%' UNION ALL SELECT 'starts', p_partkey FROM part WHERE lower(p_name) LIKE 'red%'
       UNION ALL SELECT 'ends', p_partkey FROM part WHERE lower(p_name) LIKE '%bolt' UNION ALL SELECT 'wild', p_partkey FROM part WHERE regexp_full_match(lower(p_name), '.*l.e .*')
       UNION ALL SELECT 'not', p_partkey FROM part WHERE NOT lower(p_name) LIKE '%in%' UNION ALL SELECT 'tilde', c_custkey FROM customer WHERE c_name LIKE '%000000_9' AND false
       UNION ALL SELECT 'cust', c_custkey FROM customer WHERE c_name LIKE '%#%7'""",
)
def _(t):
    p = lambda k, *a, **kw: L.text_filter(t.part, "p_name", *a, **kw).select(F.lit(k).alias("k"), F.col("p_partkey").alias("id"))
    c = lambda k, *a: L.text_filter(t.customer, "c_name", *a).select(F.lit(k).alias("k"), F.col("c_custkey").alias("id"))
    return (p("contains", "contains", "IN").unionByName(p("starts", "startswith", "Red")).unionByName(p("ends", "endswith", "bolt"))
            .unionByName(p("wild", "wildcard", "*l?e *")).unionByName(p("not", "contains", "in", exclude=True))
            .unionByName(c("tilde", "wildcard", "*~*9")).unionByName(c("cust", "wildcard", "CUSTOMER#*7")))


@query(
    "f5_classify_filter",
    """SELECT kind, test, exclude, count(*) AS n, min(term) AS lo, max(term) AS hi FROM (SELECT
       CASE p_partkey % 8 WHEN 0 THEN 'blank' WHEN 1 THEN 'number' ELSE 'text' END AS kind,
       CASE p_partkey % 8 WHEN 0 THEN 'notEqual' WHEN 1 THEN op WHEN 2 THEN 'contains' WHEN 3 THEN 'startswith' WHEN 4 THEN 'endswith' ELSE 'wildcard' END AS test,
       p_partkey % 8 > 1 AND op = 'notEqual' AS exclude,
       CASE p_partkey % 8 WHEN 0 THEN ' ' WHEN 1 THEN p_size || '' WHEN 5 THEN '*' || p_name || '*x' WHEN 6 THEN p_name WHEN 7 THEN p_name || '~*' ELSE p_name END AS term
       FROM (SELECT *, CASE WHEN p_size % 2 = 0 THEN 'equal' ELSE 'notEqual' END AS op FROM part)) GROUP BY 1, 2, 3""",
)
def _(t):
    k, n = F.col("p_partkey") % 8, F.col("p_name")
    val = (F.when(k == 0, " ").when(k == 1, F.col("p_size").cast("string")).when(k == 2, F.concat(F.lit("*"), n, F.lit("*")))
           .when(k == 3, F.concat(n, F.lit("*"))).when(k == 4, F.concat(F.lit("*"), n)).when(k == 5, F.concat(F.lit("*"), n, F.lit("*x")))
           .when(k == 6, n).otherwise(F.concat(n, F.lit("~*"))))
    specs = t.part.select(F.when(F.col("p_size") % 2 == 0, "equal").otherwise("notEqual").alias("operator"), val.alias("val"))
    return L.classify_filter(specs).groupBy("kind", "test", "exclude").agg(C(), F.min("term").alias("lo"), F.max("term").alias("hi"))


@query(
    "f6_nonblank_filter",
    "SELECT c_custkey, n FROM customer JOIN (SELECT o_custkey, count(*)::VARCHAR AS n FROM orders WHERE o_orderkey % 3 = 0 GROUP BY 1) ON c_custkey = o_custkey",
)
def _(t):
    some = t.orders.filter(F.col("o_orderkey") % 3 == 0).groupBy("o_custkey").agg(F.count(F.lit(1)).cast("string").alias("n"))
    joined = t.customer.join(some, F.col("c_custkey") == F.col("o_custkey"), "left")
    return L.nonblank_filter(joined, "n").select("c_custkey", "n")


@query(
    "f7_top_n",
    """WITH n AS (SELECT count(*) AS c FROM lineitem), a AS (SELECT l_extendedprice AS v FROM lineitem ORDER BY v DESC LIMIT 10), b AS (SELECT o_totalprice AS v FROM orders ORDER BY v LIMIT 7),
       r AS (SELECT l_orderkey, l_quantity, row_number() OVER (ORDER BY l_quantity DESC) AS d, row_number() OVER (ORDER BY l_quantity) AS u FROM lineitem)
       SELECT 'top' AS k, l_orderkey AS id FROM lineitem WHERE l_extendedprice >= (SELECT min(v) FROM a) UNION ALL SELECT 'bottom', o_orderkey FROM orders WHERE o_totalprice <= (SELECT max(v) FROM b)
       UNION ALL SELECT 'top%', l_orderkey FROM lineitem WHERE l_quantity >= (SELECT l_quantity FROM r, n WHERE d = greatest(1, c * 3 // 100))
       UNION ALL SELECT 'bottom%', l_orderkey FROM lineitem WHERE l_quantity <= (SELECT l_quantity FROM r, n WHERE u = greatest(1, c * 5 // 100))""",
)
def _(t):
    li = t.lineitem
    pick = lambda k, df, c: df.select(F.lit(k).alias("k"), F.col(c).alias("id"))
    return (pick("top", L.top_n(li, "l_extendedprice", 10), "l_orderkey").unionByName(pick("bottom", L.top_n(t.orders, "o_totalprice", 7, bottom=True), "o_orderkey"))
            .unionByName(pick("top%", L.top_n(li, "l_quantity", 3, percent=True), "l_orderkey")).unionByName(pick("bottom%", L.top_n(li, "l_quantity", 5, percent=True, bottom=True), "l_orderkey")))


@query(
    "f8_dynamic_average",
    """SELECT 'above' AS k, l_returnflag, count(*) AS n, sum(l_quantity) AS q FROM lineitem WHERE l_extendedprice > (SELECT avg(l_extendedprice) FROM lineitem) GROUP BY 2
       UNION ALL SELECT 'below', l_returnflag, count(*), sum(l_quantity) FROM lineitem WHERE l_extendedprice < (SELECT avg(l_extendedprice) FROM lineitem) GROUP BY 2""",
)
def _(t):
    agg = lambda k, df: df.groupBy("l_returnflag").agg(C(), F.sum("l_quantity").alias("q")).withColumn("k", F.lit(k))
    return agg("above", L.dynamic_average(t.lineitem, "l_extendedprice")).unionByName(agg("below", L.dynamic_average(t.lineitem, "l_extendedprice", False)))


_KINDS = ["today", "yesterday", "tomorrow", "thisWeek", "lastWeek", "nextWeek", "thisMonth", "lastMonth", "nextMonth", "thisQuarter", "lastQuarter", "nextQuarter", "thisYear", "lastYear", "nextYear", "yearToDate"]
_TODAY = dt.date(1998, 5, 14)
_D = "o_orderdate::DATE"
_A = "DATE '1998-05-14'"
_W = f"({_A} - dayofweek({_A})::INT)"
_SPANS = {
    "today": f"{_D} = {_A}", "yesterday": f"{_D} = {_A} - 1", "tomorrow": f"{_D} = {_A} + 1",
    "thisWeek": f"{_D} BETWEEN {_W} AND {_W} + 6", "lastWeek": f"{_D} BETWEEN {_W} - 7 AND {_W} - 1", "nextWeek": f"{_D} BETWEEN {_W} + 7 AND {_W} + 13",
    **{f"{w}{u.capitalize()}": f"date_trunc('{u}', o_orderdate) = date_trunc('{u}', {_A}) + INTERVAL ({n}) {iv}"
       for u, iv in (("month", "MONTH"), ("quarter", "QUARTER"), ("year", "YEAR")) for w, n in (("this", 0), ("last", -1), ("next", 1))},
    "yearToDate": f"year(o_orderdate) = 1998 AND {_D} <= {_A}",
}


@query(
    "f9_relative_date",
    "SELECT o_orderpriority, " + ", ".join(f"count_if({_SPANS[k]})::BIGINT AS {k}" for k in _KINDS) + " FROM orders GROUP BY 1",
)
def _(t):
    c = F.col("o_orderdate")
    return t.orders.groupBy("o_orderpriority").agg(*[F.count_if(L.relative_date(c, k, _TODAY)).alias(k) for k in _KINDS])


@query(
    "f10_period_of_year",
    "SELECT o_orderstatus, " + ", ".join(f"count_if(quarter(o_orderdate) = {q})::BIGINT AS Q{q}" for q in range(1, 5)) + ", "
    + ", ".join(f"count_if(month(o_orderdate) = {m})::BIGINT AS M{m}" for m in range(1, 13)) + " FROM orders GROUP BY 1",
)
def _(t):
    names = [f"Q{q}" for q in range(1, 5)] + [f"M{m}" for m in range(1, 13)]
    return t.orders.groupBy("o_orderstatus").agg(*[F.count_if(L.period_of_year(F.col("o_orderdate"), n)).alias(n) for n in names])


@query(
    "f11_icon_filter",
    """WITH s AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem)
       SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem, s WHERE l_extendedprice >= lo + (hi - lo) * 0.67""",
)
def _(t):
    li = t.lineitem
    icon = R.icon_bucket(li, "l_extendedprice", [("percent", 0, True), ("percent", 33, True), ("percent", 67, True)])
    return L.icon_filter(li, icon, 2).select("l_orderkey", "l_linenumber", "l_extendedprice")


_LIST = ["5-LOW", "1-URGENT", "3-MEDIUM"]


@query(
    "f12_sort_state",
    """SELECT o_orderkey, row_number() OVER (ORDER BY CASE o_orderpriority WHEN '5-LOW' THEN 1 WHEN '1-URGENT' THEN 2 WHEN '3-MEDIUM' THEN 3 ELSE 4 END, CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE o_totalprice END DESC NULLS LAST, o_orderkey) AS rank FROM orders
       UNION ALL SELECT c_custkey, -row_number() OVER (ORDER BY lower(s) DESC NULLS LAST, n, c_custkey) FROM
         (SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN lower(c_mktsegment) WHEN 1 THEN c_mktsegment END AS s, CASE WHEN c_custkey % 2 = 0 THEN lower(c_name) ELSE c_name END AS n FROM customer)""",
)
def _(t):
    o = t.orders.select("o_orderkey", "o_orderpriority", F.when(F.col("o_orderkey") % 9 != 0, F.col("o_totalprice")).alias("price"))
    keys = [{"column": "o_orderpriority", "custom": _LIST}, {"column": "price", "descending": True}, {"column": "o_orderkey"}]
    price = F.col("__k1")
    # unpriced orders come last and are told apart by their key alone, so the key blocks them
    blocks = [F.col("__k0"), F.coalesce(F.floor(-price / 1000), F.lit(1 << 60)), F.when(price.isNotNull(), 0).otherwise(F.floor(F.col("__k2") / (1 << 18)))]
    numbers = L.sort_rank(o, keys, blocks).select("o_orderkey", "rank")
    kind, even = F.col("c_custkey") % 3, F.col("c_custkey") % 2 == 0
    people = t.customer.select(
        "c_custkey", F.when(kind == 0, F.lower("c_mktsegment")).when(kind == 1, F.col("c_mktsegment")).alias("s"),
        F.when(even, F.lower("c_name")).otherwise(F.col("c_name")).alias("n"),
    )
    words = [{"column": "s", "text": True, "descending": True}, {"column": "n", "text": True, "case_sensitive": True}, {"column": "c_custkey"}]
    blocks = [F.coalesce(-F.ascii("__k0"), F.lit(0)), F.ascii("__k1")]
    texts = L.sort_rank(people, words, blocks).select(F.col("c_custkey").alias("o_orderkey"), (-F.col("rank")).alias("rank"))
    return numbers.unionByName(texts)


@query(
    "f13_auto_filter",
    """SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders WHERE o_orderstatus IN ('F', 'O') AND o_totalprice > 100000 AND lower(o_orderpriority) LIKE '%i%' AND quarter(o_orderdate) = 2 ORDER BY o_totalprice DESC""",
)
def _(t):
    tests = [F.col("o_orderstatus").isin("F", "O"), L.custom("o_totalprice", [("greaterThan", 100000)]),
             L.text_test(F.col("o_orderpriority"), "contains", "I"), L.period_of_year(F.col("o_orderdate"), "Q2")]
    return L.auto_filter(t.orders, tests, [{"column": "o_totalprice", "descending": True}]).select("o_orderkey", "o_totalprice", "o_orderpriority")
