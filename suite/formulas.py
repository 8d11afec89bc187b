"""E: formulas made from the tables, one per row."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridspark.functions import coords as C
from gridspark.operators import formulas as E
from suite.common import SUPPLIER_SQL, supplier_cells
from suite.ranges import letter
from suite.registry import query


def rows():
    return F.count(F.lit(1)).alias("n")


_TOKENS = [
    # template 0: =SUM(A1:B<n>)*-2.5E+3
    [("SUM(", "FUNC", "OPEN"), ("A1:B{n}", "OPERAND", "RANGE"), (")", "FUNC", "CLOSE"), ("*", "OPERATOR-INFIX", ""), ("-", "OPERATOR-PREFIX", ""), ("2.5E+3", "OPERAND", "NUMBER")],
    # template 1: =IF(C{n}>=5,"x, ""y""",#N/A)%
    [("IF(", "FUNC", "OPEN"), ("C{n}", "OPERAND", "RANGE"), (">=", "OPERATOR-INFIX", ""), ("5", "OPERAND", "NUMBER"), (",", "SEP", "ARG"), ('"x, ""y"""', "OPERAND", "TEXT"), (",", "SEP", "ARG"),
     ("#N/A", "OPERAND", "ERROR"), (")", "FUNC", "CLOSE"), ("%", "OPERATOR-POSTFIX", "")],
    # template 2: ={1,TRUE;3} &('My Sheet'!$A${n},T[[#All],[b c]])
    [("{", "ARRAY", "OPEN"), ("1", "OPERAND", "NUMBER"), (",", "SEP", "ARG"), ("TRUE", "OPERAND", "LOGICAL"), (";", "SEP", "ROW"), ("3", "OPERAND", "NUMBER"), ("}", "ARRAY", "CLOSE"), (" ", "WHITE-SPACE", ""),
     ("&", "OPERATOR-INFIX", ""), ("(", "PAREN", "OPEN"), ("'My Sheet'!$A${n}", "OPERAND", "RANGE"), (",", "OPERATOR-INFIX", ""), ("T[[#All],[b c]]", "OPERAND", "RANGE"), (")", "PAREN", "CLOSE")],
    # template 3: text
    [("plain {n}", "LITERAL", "")],
]
_TEXT = ["".join(v for v, _, _ in ts) if i == 3 else "=" + "".join(v for v, _, _ in ts) for i, ts in enumerate(_TOKENS)]


def made(t):
    n = F.col("l_linenumber").cast("string")
    text = None
    for i, f in enumerate(_TEXT):
        parts = f.split("{n}")
        c = F.concat(*[x for p in parts[:-1] for x in (F.lit(p), n)], F.lit(parts[-1]))
        hit = F.col("l_orderkey") % 4 == i
        text = F.when(hit, c) if text is None else text.when(hit, c)
    return t.lineitem.select((F.col("l_orderkey") % 4).alias("k"), "l_linenumber", text.alias("formula"))


def _sql(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


@query(
    "e1_formula_tokens",
    "WITH k AS (SELECT l_orderkey % 4 AS k, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL), v AS (SELECT * FROM (VALUES "
    + ", ".join(f"({i}, {p}, {_sql(v)}, '{ty}', '{st}')" for i, ts in enumerate(_TOKENS) for p, (v, ty, st) in enumerate(ts))
    + ") t(k, pos, value, type, subtype)) SELECT k.k, k.l_linenumber, pos, replace(value, '{n}', l_linenumber::VARCHAR) AS value, type, subtype, n FROM k JOIN v ON k.k = v.k",
)
def _(t):
    return E.formula_tokens(made(t)).groupBy("k", "l_linenumber", "pos", "value", "type", "subtype").agg(rows())


@query(
    "e2_formula_audit",
    "SELECT ['MYFN', 'odd.fn'][(l_partkey % 5 + 1)::INT] AS name, count(*) AS n FROM lineitem WHERE l_partkey % 5 < 2 GROUP BY 1",
)
def _(t):
    k = F.col("l_partkey") % 5
    call = F.when(k == 0, "MYFN(").when(k == 1, "odd.fn(").when(k == 2, "SUM(").when(k == 3, "_xlfn.STDEV.S(").otherwise("VLOOKUP(")
    f = t.lineitem.select(F.concat(F.lit("="), call, F.lit("A"), "l_linenumber", F.lit(")+MAX(1,2)")).alias("formula"))
    known = t.spark.range(1).select(F.explode(F.array(*[F.lit(x) for x in ("SUM", "VLOOKUP", "MAX")])).alias("name"))
    return E.formula_audit(E.formula_tokens(f), known).groupBy("name").agg(rows())


@query(
    "e3_translate_formulas",
    f"""SELECT p_partkey, CASE WHEN p_size + dr >= 1 THEN '=' || {letter('p_size + k')} || (p_size + dr) || '+$B$2*SUM(' || {letter('3 + k')} || '$1:' || {letter('4 + k')} || (10 + dr) || ')-rate&Data!' || (7 + dr) || ':' || (9 + dr) END AS moved
        FROM (SELECT *, p_partkey % 3 AS k, CASE WHEN p_partkey % 3 = 0 THEN -3 ELSE 5 END AS dr FROM part)""",
)
def _(t):
    z = F.col("p_size")
    f = F.concat(F.lit("="), C.col_letter(z), z, F.lit("+$B$2*SUM(C$1:D10)-rate&Data!7:9"))
    dr = F.when(F.col("p_partkey") % 3 == 0, -3).otherwise(5)
    moved = E.translate_formulas(t.part.select("p_partkey", f.alias("moved"), dr.alias("dr")), "moved", F.col("dr"), F.col("p_partkey") % 3)
    return moved.select("p_partkey", "moved")


@query(
    "e4_expand_shared",
    """SELECT p_brand AS sheet, r::INT AS "row", si, '=D' || r || '*$F$1+A' || (r + 1) AS formula FROM (SELECT p_brand, p_size % 3 AS si, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS r FROM part)""",
)
def _(t):
    from gridspark.scale import block_of, running

    rows_ = running(t.part.select(F.col("p_brand").alias("sheet"), "p_partkey", (F.col("p_size") % 3).alias("si")), ["sheet"], ["p_partkey"], {"row": ("row_number", None)}, block_of("p_partkey"))
    first = rows_.groupBy("sheet", "si").agg(F.min("row").alias("top"))
    cells = rows_.join(first, ["sheet", "si"]).select(
        F.lit("cat").alias("book"), "sheet", F.col("row").cast("int").alias("row"), F.lit(5).alias("col"), "si",
        F.when(F.col("row") == F.col("top"), F.concat(F.lit("=D"), F.col("row"), F.lit("*$F$1+A"), F.col("row") + 1)).alias("formula"))
    return E.expand_shared(cells).select("sheet", "row", "si", "formula")


@query(
    "e5_formula_edges",
    SUPPLIER_SQL + """, f AS (SELECT sheet, max("row") AS m FROM cells GROUP BY sheet), e AS (SELECT DISTINCT f.sheet, c."row", c.col FROM f JOIN cells c ON c.sheet = f.sheet AND ((c.col = 4 AND c."row" >= 2) OR (c."row" = 2 AND c.col <= 2)))
       SELECT sheet, "row"::INT AS "row", col::INT AS col, 0::BIGINT AS out_degree, 1::BIGINT AS in_degree FROM e UNION ALL SELECT sheet, (max("row") + 1000)::INT, 1, count(*), 0 FROM (SELECT e.sheet, f.m AS "row" FROM e JOIN f ON f.sheet = e.sheet) GROUP BY sheet""",
)
def _(t):
    cells = supplier_cells(t)
    last = cells.groupBy("book", "sheet").agg(F.max("row").alias("m"))
    formulas = last.select("book", "sheet", (F.col("m") + 1000).alias("row"), F.lit(1).alias("col"), F.concat(F.lit("=SUM(D2:D"), "m", F.lit(")+COUNT("), C.quote_sheet(F.col("sheet")), F.lit("!A2:B2)+D2")).alias("formula"))
    edges = E.formula_edges(cells, E.formula_tokens(formulas))
    return E.degrees(edges).drop("book")


@query(
    "e5_cell_degrees",
    SUPPLIER_SQL + """, m AS (SELECT sheet, max("row") AS m FROM cells GROUP BY sheet),
       f AS (SELECT 'n' || s_nationkey AS sheet, m + 10 + s_suppkey AS fr, 2 + s_suppkey % 5 AS k, s_suppkey % 3 AS kind FROM supplier JOIN m ON m.sheet = 'n' || s_nationkey),
       r AS (SELECT sheet, fr, 1 AS c1, 2 AS r1, 3 AS c2, k AS r2 FROM f UNION ALL SELECT sheet, fr, 2, 1, 2, 1048576 FROM f UNION ALL SELECT sheet, fr, 1, 2, 18278, 3 FROM f WHERE kind = 0
             UNION ALL SELECT 'n' || (CAST(substr(sheet, 2) AS INT) + 1) % 25, fr, 4, 1, 4, 1048576 FROM f WHERE kind = 1),
       q AS (SELECT f.sheet AS home, r.* FROM (SELECT DISTINCT sheet, fr, kind FROM f) f JOIN r ON r.fr = f.fr AND (r.sheet = f.sheet OR r.sheet = 'n' || (CAST(substr(f.sheet, 2) AS INT) + 1) % 25 AND f.kind = 1 AND r.c1 = 4)),
       e AS (SELECT DISTINCT q.home, q.fr, c.sheet, c."row", c.col FROM q JOIN cells c ON c.sheet = q.sheet AND c.col BETWEEN c1 AND c2 AND c."row" BETWEEN r1 AND r2)
       SELECT sheet, "row"::INT AS "row", col::INT AS col, 0::BIGINT AS out_degree, count(*) AS in_degree FROM e GROUP BY ALL UNION ALL SELECT home, fr::INT, 1, count(*), 0 FROM e GROUP BY home, fr""",
)
def _(t):
    """A formula per supplier below its sheet: overlapping ranges, whole columns, whole rows, a column of the next sheet."""
    cells = supplier_cells(t)
    last = cells.groupBy("book", "sheet").agg(F.max("row").alias("m"))
    k = F.col("s_suppkey") % 3
    text = F.concat(
        F.lit("=SUM(A2:C"), 2 + F.col("s_suppkey") % 5, F.lit(")+COUNT(B:B)"), F.when(k == 0, F.lit("+MAX(2:3)")).otherwise(""),
        F.when(k == 1, F.concat(F.lit("+SUM('n"), (F.col("s_nationkey") + 1) % 25, F.lit("'!D:D)"))).otherwise(""),
    )
    own = t.supplier.select(F.lit("sup").alias("book"), F.concat(F.lit("n"), "s_nationkey").alias("sheet"), "s_suppkey", text.alias("formula"))
    formulas = own.join(last, ["book", "sheet"]).select("book", "sheet", (F.col("m") + 10 + F.col("s_suppkey")).cast("int").alias("row"), F.lit(1).alias("col"), "formula")
    return E.cell_degrees(cells, E.formula_tokens(formulas)).drop("book")
