"""C: coordinates and ranges, over tables of coordinates."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridspark.functions import coords as C
from gridspark.operators import ranges as R
from suite.registry import query

_LETTER = """CASE WHEN {n} < 1 OR {n} > 18278 THEN NULL WHEN {n} <= 26 THEN chr((64 + {n})::INT)
  WHEN {n} <= 702 THEN chr((64 + ({n} - 1) // 26)::INT) || chr((65 + ({n} - 1) % 26)::INT)
  ELSE chr((64 + ({n} - 27) // 676)::INT) || chr((65 + (({n} - 27) // 26) % 26)::INT) || chr((65 + ({n} - 1) % 26)::INT) END"""


def letter(n: str) -> str:
    return _LETTER.replace("{n}", f"({n})")


@query(
    "c1_col_letter",
    f"""SELECT n, {letter('n')} AS letters, CASE WHEN n BETWEEN 1 AND 18278 THEN n::INT END AS back, count(*) AS rows
        FROM (SELECT (l_orderkey * 7 + l_partkey) % 18300 AS n FROM lineitem) GROUP BY n""",
)
def _(t):
    n = t.lineitem.select(((F.col("l_orderkey") * 7 + F.col("l_partkey")) % 18300).alias("n"))
    out = n.withColumn("letters", C.col_letter(F.col("n"))).withColumn("back", C.col_index(F.lower("letters")))
    return out.groupBy("n", "letters", "back").agg(F.count(F.lit(1)).alias("rows"))


@query(
    "c2_parse_coord",
    f"""SELECT o_orderkey, CASE WHEN o_orderkey % 50 <> 0 THEN {letter('o_custkey % 18278 + 1')} END AS col_name, CASE WHEN o_orderkey % 50 <> 0 THEN (o_custkey % 18278 + 1)::INT END AS col,
        CASE WHEN o_orderkey % 50 <> 0 THEN (o_orderkey % 50)::INT END AS "row" FROM orders""",
)
def _(t):
    text = F.concat(F.lit("$"), C.col_letter(F.col("o_custkey") % 18278 + 1), F.lit("$"), F.col("o_orderkey") % 50)
    return t.orders.select("o_orderkey", C.parse_coord(text).alias("x")).select("o_orderkey", "x.*")


@query(
    "c3_absolute",
    f"""SELECT o_orderkey, '$' || {letter('o_custkey % 700 + 1')} || '$' || (o_orderkey % 99 + 1) || CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE ':$' || {letter('o_custkey % 700 + 3')} || '$' || (o_orderkey % 99 + 5) END AS pinned FROM orders""",
)
def _(t):
    o, c = F.col("o_orderkey"), F.col("o_custkey")
    text = F.concat(C.col_letter(c % 700 + 1), o % 99 + 1, F.when(o % 3 == 0, "").otherwise(F.concat(F.lit(":"), C.col_letter(c % 700 + 3), F.lit("$"), o % 99 + 5)))
    return t.orders.select("o_orderkey", C.absolute(text).alias("pinned"))


@query(
    "c4_range_bounds",
    """SELECT o_orderkey, CASE WHEN k IN (0, 1) THEN a END AS min_col, CASE WHEN k IN (0, 2) THEN r END AS min_row, CASE WHEN k IN (0, 1) THEN a + 2 END AS max_col, CASE WHEN k IN (0, 2) THEN r + 4 END AS max_row
       FROM (SELECT o_orderkey, (o_orderkey % 4)::INT AS k, (o_custkey % 700 + 1)::INT AS a, (o_orderkey % 99 + 1)::INT AS r FROM orders)""",
)
def _(t):
    o = F.col("o_orderkey")
    a, b, r, k = C.col_letter(F.col("o_custkey") % 700 + 1), C.col_letter(F.col("o_custkey") % 700 + 3), o % 99 + 1, o % 4
    text = (F.when(k == 0, F.concat(a, r, F.lit(":"), b, r + 4)).when(k == 1, F.concat(a, F.lit(":"), b))
            .when(k == 2, F.concat(r, F.lit(":"), r + 4)).otherwise(F.concat(a, r, F.lit(":"), b)))
    return t.orders.select("o_orderkey", C.range_bounds(text).alias("x")).select("o_orderkey", "x.*")


@query(
    "c5_qualified_range",
    """SELECT c_custkey, c_name || CASE WHEN c_custkey % 2 = 0 THEN ' x''''s' ELSE '' END AS sheet, 1 AS min_col, (c_nationkey + 1)::INT AS min_row, 3 AS max_col, (c_nationkey + 9)::INT AS max_row,
       '''' || c_name || CASE WHEN c_custkey % 2 = 0 THEN ' x''''s' ELSE '' END || '''' AS quoted FROM customer""",
)
def _(t):
    title = F.concat("c_name", F.when(F.col("c_custkey") % 2 == 0, " x's").otherwise(""))
    cells = F.concat(F.lit("!$A$"), F.col("c_nationkey") + 1, F.lit(":C"), F.col("c_nationkey") + 9)
    text = F.concat(F.when(F.col("c_custkey") % 2 == 0, C.quote_sheet(title)).otherwise(title), cells)
    return t.customer.select("c_custkey", C.qualified_range(text).alias("x"), C.quote_sheet(title).alias("quoted")).select(
        "c_custkey", "x.sheet", "x.bounds.*", "quoted")


@query(
    "c6_col_interval",
    f"""SELECT p_partkey, count(*) AS n, min({letter('i')}) AS lo, string_agg({letter('i')}, ',' ORDER BY i) AS letters FROM
        (SELECT p_partkey, unnest(range(p_size, p_size + p_partkey % 40 + 1)) AS i FROM part) GROUP BY p_partkey""",
)
def _(t):
    letters = C.col_interval(F.col("p_size"), (F.col("p_size") + F.col("p_partkey") % 40).cast("int"))
    return t.part.select("p_partkey", F.size(letters).cast("bigint").alias("n"), F.array_min(letters).alias("lo"), F.array_join(letters, ",").alias("letters"))


@query(
    "c7_expand_ranges",
    f"""SELECT p_partkey, 'row' AS walk, {letter('c')} || r AS cell, ((r - p_size) * 2 + c - 2)::INT AS at FROM (SELECT p_partkey, p_size, unnest(range(p_size, p_size + 3)) AS r FROM part), (VALUES (2), (3)) v(c)
        UNION ALL SELECT p_partkey, 'col', {letter('c')} || r, ((c - 2) * 3 + r - p_size)::INT FROM (SELECT p_partkey, p_size, unnest(range(p_size, p_size + 3)) AS r FROM part), (VALUES (2), (3)) v(c)""",
)
def _(t):
    ranges = t.part.select("p_partkey", F.concat(F.lit("B"), F.col("p_size"), F.lit(":C"), F.col("p_size") + 2, F.lit(" C"), F.col("p_size") + 2).alias("sqref"))
    parts = []
    for by in ("row", "col"):
        e = R.expand_ranges(ranges, "sqref", by)
        # the repeated corner cell stands at place 0 of its own range
        parts.append(e.select("p_partkey", F.lit(by).alias("walk"), "cell",
                              F.when(F.split("sqref", " ")[1] == F.col("cell"), 5).otherwise(F.col("at")).cast("int").alias("at")))
    return parts[0].unionByName(parts[1])


@query(
    "c8_collapse_cells",
    f"""SELECT l_returnflag AS sheet, col, CASE WHEN n = 1 THEN {letter('col')} || lo ELSE {letter('col')} || lo || ':' || {letter('col')} || hi END AS range
        FROM (SELECT l_returnflag, l_suppkey % 90 + 1 AS col, min(l_orderkey + 1) AS lo, max(l_orderkey + 1) AS hi, count(*) AS n FROM lineitem GROUP BY ALL)""",
)
def _(t):
    cells = t.lineitem.select(F.col("l_returnflag").alias("sheet"), (F.col("l_orderkey") + 1).alias("row"), (F.col("l_suppkey") % 90 + 1).alias("col"))
    return R.collapse_cells(cells, ["sheet"])


# one range from the part, one from the supplier, paired by the lines that hold both
_PAIRS = """WITH d AS (SELECT l_orderkey, l_linenumber, l_extendedprice, l_partkey, l_suppkey,
  (l_partkey % 20 + 1)::INT AS a1, (l_partkey % 30 + 1)::INT AS a2, (l_partkey % 20 + 1 + l_partkey % 5)::INT AS a3, (l_partkey % 30 + 1 + l_partkey % 7)::INT AS a4,
  (l_suppkey % 15 + 1)::INT AS b1, (l_suppkey % 25 + 1)::INT AS b2, (l_suppkey % 15 + 1 + l_suppkey % 9)::INT AS b3, (l_suppkey % 25 + 1 + l_suppkey % 11)::INT AS b4 FROM lineitem),
  p AS (SELECT *, (a3 < b1 OR b3 < a1 OR a4 < b2 OR b4 < a2) AS apart FROM d) """
_ID = ["l_orderkey", "l_linenumber", "l_extendedprice"]


def _pairs(t):
    p, s = F.col("l_partkey"), F.col("l_suppkey")
    return t.lineitem.select(
        *_ID, "l_partkey", "l_suppkey",
        C.make_range(p % 20 + 1, p % 30 + 1, p % 20 + 1 + p % 5, p % 30 + 1 + p % 7).alias("a"),
        C.make_range(s % 15 + 1, s % 25 + 1, s % 15 + 1 + s % 9, s % 25 + 1 + s % 11).alias("b"),
    )


@query(
    "c9_range_intersect",
    _PAIRS + """SELECT l_orderkey, l_linenumber, l_extendedprice, CASE WHEN NOT apart THEN greatest(a1, b1) END AS min_col, CASE WHEN NOT apart THEN greatest(a2, b2) END AS min_row,
      CASE WHEN NOT apart THEN least(a3, b3) END AS max_col, CASE WHEN NOT apart THEN least(a4, b4) END AS max_row FROM p""",
)
def _(t):
    return _pairs(t).select(*_ID, C.range_intersect(F.col("a"), F.col("b")).alias("x")).select(*_ID, "x.*")


@query(
    "c10_range_union",
    _PAIRS + """SELECT 'pair' AS kind, l_orderkey AS id, l_linenumber AS n, l_extendedprice AS price, least(a1, b1) AS min_col, least(a2, b2) AS min_row, greatest(a3, b3) AS max_col, greatest(a4, b4) AS max_row FROM p
      UNION ALL SELECT 'all', l_suppkey, 0, 0, min(a1), min(a2), max(a3), max(a4) FROM p GROUP BY l_suppkey""",
)
def _(t):
    two = _pairs(t).select(F.lit("pair").alias("kind"), F.col("l_orderkey").alias("id"), F.col("l_linenumber").alias("n"), F.col("l_extendedprice").alias("price"), C.range_union(F.col("a"), F.col("b")).alias("x")).select("kind", "id", "n", "price", "x.*")
    many = R.bounding_range(_pairs(t), ["l_suppkey"], "a").select(F.lit("all").alias("kind"), F.col("l_suppkey").alias("id"), F.lit(0).alias("n"), F.lit(0.0).alias("price"), "min_col", "min_row", "max_col", "max_row")
    return two.unionByName(many)


@query(
    "c11_range_rel",
    _PAIRS + """, q AS (SELECT *, l_partkey % 2 = l_suppkey % 2 AS ok, (a1 >= b1 AND a3 <= b3 AND a2 >= b2 AND a4 <= b4) AS sub, (b1 >= a1 AND b3 <= a3 AND b2 >= a2 AND b4 <= a4) AS sup FROM p)
      SELECT CASE WHEN ok THEN sub END AS subset, CASE WHEN ok THEN sup END AS superset, CASE WHEN ok THEN sub AND NOT sup END AS strict_subset, CASE WHEN ok THEN sup AND NOT sub END AS strict_superset,
      CASE WHEN ok THEN apart END AS disjoint, CASE WHEN ok THEN sub AND sup END AS equal, (a1 <= 4 AND a3 >= 4 AND a2 <= 6 AND a4 >= 6) AS has_d6, count(*) AS n FROM q GROUP BY ALL""",
)
def _(t):
    rel = C.range_rel(F.col("a"), F.col("b"), F.col("l_partkey") % 2, F.col("l_suppkey") % 2)
    has = C.range_contains(F.col("a"), F.lit(4), F.lit(6))
    return _pairs(t).select(rel.alias("x"), has.alias("has_d6")).select("x.*", "has_d6").groupBy(
        "subset", "superset", "strict_subset", "strict_superset", "disjoint", "equal", "has_d6").agg(F.count(F.lit(1)).alias("n"))


@query(
    "c12_range_shift",
    f"""WITH p AS (SELECT p_partkey, (p_size % 9 + 1)::INT AS c1, (p_partkey % 13 + 1)::INT AS r1, (p_size % 9 + 4)::INT AS c2, (p_partkey % 13 + 3)::INT AS r2 FROM part)
      SELECT p_partkey, CASE WHEN c1 > 3 AND r1 > 2 THEN {letter('c1 - 3')} || (r1 - 2) || ':' || {letter('c2 - 3')} || (r2 - 2) END AS shifted, {letter('c1')} || r1 || ':' || {letter('c2 + 1')} || (r2 + 2) AS grown,
      {letter('c1 + 1')} || r1 || ':' || {letter('c2')} || r2 AS shrunk, c2 - c1 + 1 AS columns, r2 - r1 + 1 AS rows, {letter('c1')} || r1 || ',' || {letter('c1 + 1')} || r1 || ',' || {letter('c1 + 2')} || r1 || ',' || {letter('c1 + 3')} || r1 AS top,
      {letter('c2')} || r1 || ',' || {letter('c2')} || (r1 + 1) || ',' || {letter('c2')} || (r1 + 2) AS "right" FROM p""",
)
def _(t):
    p, z = F.col("p_partkey"), F.col("p_size")
    made = t.part.select("p_partkey", C.make_range(z % 9 + 1, p % 13 + 1, z % 9 + 4, p % 13 + 3).alias("r"))
    r = F.col("r")
    return made.select(
        "p_partkey", C.range_text(C.range_shift(r, F.lit(-3), F.lit(-2))).alias("shifted"), C.range_text(C.range_expand(r, right=1, down=2)).alias("grown"),
        C.range_text(C.range_shrink(r, left=1)).alias("shrunk"), C.range_size(r)["columns"].alias("columns"), C.range_size(r)["rows"].alias("rows"),
        F.array_join(C.range_edge(r, "top"), ",").alias("top"), F.array_join(C.range_edge(r, "right"), ",").alias("right"))


@query(
    "c13_range_set",
    f"""WITH p AS (SELECT DISTINCT p_brand AS sheet, (p_size % 9 + 1)::INT AS c1, (p_partkey % 600 + 1)::INT AS r1, (p_size % 9 + 1 + p_partkey % 4)::INT AS c2, (p_partkey % 600 + 1 + p_partkey % 300)::INT AS r2 FROM part)
      SELECT 'cat' AS book, sheet, CASE WHEN c1 = c2 AND r1 = r2 THEN {letter('c1')} || r1 ELSE {letter('c1')} || r1 || ':' || {letter('c2')} || r2 END AS range FROM p
      WHERE NOT EXISTS (SELECT 1 FROM p q WHERE q.sheet = p.sheet AND q.c1 <= p.c1 AND q.r1 <= p.r1 AND q.c2 >= p.c2 AND q.r2 >= p.r2 AND (q.c1, q.r1, q.c2, q.r2) <> (p.c1, p.r1, p.c2, p.r2))""",
)
def _(t):
    p, z = F.col("p_partkey"), F.col("p_size")
    made = t.part.select(F.lit("cat").alias("book"), F.col("p_brand").alias("sheet"), C.make_range(z % 9 + 1, p % 600 + 1, z % 9 + 1 + p % 4, p % 600 + 1 + p % 300).alias("r")).select("book", "sheet", "r.*")
    return R.range_set(made).select("book", "sheet", "range")
