"""A: scans and sinks at cell grain (workbook files are in ``suite.workbooks``)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from gridspark.operators import grid as G
from gridspark.session import shared_folder
from gridspark.scale import block_of
from suite.common import (
    CUSTOMER_SQL, ORDERS_SQL, SUPPLIER_SQL, TEXT, customer_cells, orders_cells, supplier_cells, texts,
)
from suite.registry import query


@query(
    "a3_decode_strings",
    """SELECT p_partkey::BIGINT AS p_partkey, replace(p_name, 'x005F_', '') AS v_str, NULL::DOUBLE AS v_num FROM part
       UNION ALL SELECT p_partkey, NULL, p_retailprice FROM part""",
)
def _(t):
    sst = t.part.groupBy("p_name").agg(F.min("p_partkey").alias("idx")).select(
        F.lit("cat").alias("book"), "idx", F.col("p_name").alias("text")
    )
    coded = t.part.join(sst, F.col("p_name") == F.col("text"))
    shared = coded.select("p_partkey", F.lit("cat").alias("book"), F.lit("s").alias("dtype"),
                          F.col("idx").cast("double").alias("v_num"), F.lit(None).cast("string").alias("v_str"))
    plain = t.part.select("p_partkey", F.lit("cat").alias("book"), F.lit("n").alias("dtype"),
                          F.col("p_retailprice").alias("v_num"), F.lit(None).cast("string").alias("v_str"))
    return G.decode_strings(shared.unionByName(plain), sst).select("p_partkey", "v_str", "v_num")


@query(
    "a4_densify",
    SUPPLIER_SQL
    + f""", gappy AS (SELECT * FROM cells WHERE (("row" * 7 + col * 3) % 5) <> 0),
    b AS (SELECT book, sheet, max("row") AS mr, max(col) AS mc FROM gappy GROUP BY ALL),
    g AS (SELECT book, sheet, r AS "row", unnest(range(1, mc + 1)) AS col
          FROM (SELECT *, unnest(range(1, mr + 1)) AS r FROM b))
    SELECT g.book, g.sheet, g."row"::INT AS "row", g.col::INT AS col, {TEXT} AS text
    FROM g LEFT JOIN gappy c ON g.book = c.book AND g.sheet = c.sheet AND g."row" = c."row" AND g.col = c.col""",
)
def _(t):
    gappy = supplier_cells(t).filter((F.col("row") * 7 + F.col("col") * 3) % 5 != 0)
    return texts(G.densify(gappy))


@query(
    "a5_read_range",
    SUPPLIER_SQL
    + """SELECT book, sheet, r::INT AS "row", s_suppkey::VARCHAR AS id, CASE WHEN s_acctbal = floor(s_acctbal) THEN s_acctbal::BIGINT::VARCHAR ELSE s_acctbal::VARCHAR END AS balance, 'named' AS mode
         FROM src WHERE r BETWEEN 3 AND 5
    UNION ALL SELECT book, sheet, r::INT, s_suppkey::VARCHAR, CASE WHEN s_acctbal = floor(s_acctbal) THEN s_acctbal::BIGINT::VARCHAR ELSE s_acctbal::VARCHAR END, 'bare'
         FROM src WHERE r BETWEEN 2 AND 4""",
)
def _(t):
    cells = supplier_cells(t)
    eaten = G.read_range(cells, None, "A, D:D", skip=1, nrows=3, header=True, names=["id", "balance"])
    bare = G.read_range(cells, None, "A, D:D", skip=1, nrows=3, header=False, names=["id", "balance"])
    return eaten.withColumn("mode", F.lit("named")).unionByName(bare.withColumn("mode", F.lit("bare")))


@query(
    "a6_decode_pivot_cache",
    """SELECT l_orderkey * 8 + l_linenumber AS rec, l_returnflag AS flag, l_linestatus AS status,
       printf('%.16g', l_quantity) AS quantity, count(*) AS n FROM lineitem GROUP BY ALL""",
)
def _(t):
    li = t.lineitem
    code = lambda c, vals: F.array_position(F.array(*[F.lit(v) for v in vals]), F.col(c)) - 1
    flags, states = ["A", "N", "R"], ["F", "O"]
    item = lambda k, v: F.struct(F.lit(k).alias("kind"), v.cast("string").alias("v"))
    from gridspark.functions.scalars import safe_string

    records = li.select(
        F.lit(1).alias("cache"),
        F.struct("l_orderkey", "l_linenumber", F.xxhash64(*li.columns).alias("h")).alias("rec"),
        F.array(
            item("x", code("l_returnflag", flags)), item("x", code("l_linestatus", states)),
            item("n", safe_string(F.col("l_quantity"))),
        ).alias("items"),
    )
    # shared items as the data holds them: one row per distinct value of a field
    f0 = li.select("l_returnflag").distinct().select(F.lit(0).alias("field"), code("l_returnflag", flags).alias("idx"), F.col("l_returnflag").alias("v"))
    f1 = li.select("l_linestatus").distinct().select(F.lit(1).alias("field"), code("l_linestatus", states).alias("idx"), F.col("l_linestatus").alias("v"))
    items = f0.unionByName(f1).select(F.lit(1).alias("cache"), "field", F.col("idx").cast("int").alias("idx"), "v")
    out = G.decode_pivot_cache(records, items, {0: "flag", 1: "status", 2: "quantity"})
    return out.select((F.col("rec.l_orderkey") * 8 + F.col("rec.l_linenumber")).alias("rec"), "flag", "status", "quantity").groupBy(
        "rec", "flag", "status", "quantity").agg(F.count(F.lit(1)).alias("n"))


@query(
    "a7_dimensions",
    """SELECT 'y' || year(o_orderdate) AS book, o_orderstatus AS sheet, 1 AS min_col, 1 AS min_row, 5 AS max_col,
       (count(*) + 1)::INT AS max_row, 'A1:E' || (count(*) + 1) AS dimension FROM orders GROUP BY ALL""",
)
def _(t):
    return G.dimensions(orders_cells(t))


@query(
    "a9_read_table",
    """WITH r AS (SELECT *, row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_custkey) AS i,
              count(*) OVER (PARTITION BY c_mktsegment) AS n FROM customer)
       SELECT 'crm' AS book, c_mktsegment AS sheet, (i + 1)::INT AS "row", c_custkey::VARCHAR AS id, c_name AS name,
              c_nationkey::VARCHAR AS nation FROM r WHERE i <= n - 1""",
)
def _(t):
    cells = customer_cells(t)
    used = G.dimensions(cells)
    tables = used.select(
        "book", "sheet", F.lit("clients").alias("name"), F.lit(1).alias("min_col"), F.lit(1).alias("min_row"),
        F.lit(3).alias("max_col"), "max_row", F.lit(1).alias("header_rows"), F.lit(1).alias("totals_rows"),
    )
    return G.read_table(cells, tables, "clients", ["id", "name", "nation"])


@query(
    "a10_resolve_names",
    ORDERS_SQL
    + f"""SELECT 'head' AS name, book, sheet, "row"::INT AS "row", col::INT AS col, {TEXT} AS text FROM cells
          WHERE sheet = 'O' AND col <= 2 AND "row" <= 3
          UNION ALL SELECT 'prices', book, sheet, "row"::INT, col::INT, {TEXT} FROM cells
          WHERE (sheet = 'F' AND col = 3) OR (sheet = 'P' AND col = 5 AND "row" BETWEEN 2 AND 9)""",
)
def _(t):
    cells = orders_cells(t)
    one = lambda n, s, x: F.struct(F.lit(n).alias("name"), F.lit(s).cast("string").alias("scope"), F.lit(x).alias("target"))
    names = cells.select("book").distinct().select(
        "book",
        F.explode(F.array(
            one("head", None, "F!$A$1:$B$2"),
            one("head", "O", "O!$A$1:$B$3"),
            one("prices", None, "'F'!$C:$C,'P'!E2:E9"),
            one("_xlnm.Print_Area", None, "F!$A$1:$B$2"),
            one("head", "P", "P!A1"),
        )).alias("n"),
    ).select("book", "n.*")
    return texts(G.resolve_names(cells, names, "O"), "name")


@query(
    "a11_bind_annotations",
    SUPPLIER_SQL
    + f""", hits AS (SELECT *, 'link' AS kind, 'https://example.com/' || sheet AS note FROM cells WHERE "row" = 2 AND col IN (1, 4)
          UNION ALL SELECT *, 'link', 'whole column' FROM cells WHERE (col = 3 AND "row" <> 2) OR (col = 1 AND "row" = 2)
          UNION ALL SELECT *, 'comment', 'top of ' || sheet FROM cells WHERE "row" = 1 AND col = 1)
       SELECT book, sheet, "row"::INT AS "row", col::INT AS col, kind, note, {TEXT} AS text FROM hits""",
)
def _(t):
    cells = supplier_cells(t)
    sheets = cells.select("book", "sheet").distinct()
    notes = sheets.select("book", "sheet", F.explode(F.array(
        F.struct(F.lit("B2:D2").alias("ref"), F.lit("link").alias("kind"), F.concat(F.lit("https://example.com/"), "sheet").alias("text")),
        F.struct(F.lit("C:C").alias("ref"), F.lit("link").alias("kind"), F.lit("whole column").alias("text")),
        F.struct(F.lit("A1").alias("ref"), F.lit("comment").alias("kind"), F.concat(F.lit("top of "), "sheet").alias("text")),
    )).alias("a")).select("book", "sheet", "a.*")
    merges = sheets.select("book", "sheet", F.lit(1).alias("min_col"), F.lit(2).alias("min_row"),
                           F.lit(3).alias("max_col"), F.lit(2).alias("max_row"))
    bound = G.bind_annotations(cells, notes, merges)
    return texts(bound, "kind", "note")


@query(
    "a13_to_cells",
    CUSTOMER_SQL + f"""SELECT book, sheet, "row"::INT AS "row", col::INT AS col, dtype, {TEXT} AS text FROM cells
    UNION ALL SELECT 'idx', 'n' || c_nationkey, 1, col, 's', txt FROM (SELECT DISTINCT c_nationkey FROM customer), (VALUES (2, 'c_name'), (3, 'c_acctbal')) v(col, txt)
    UNION ALL SELECT 'idx', 'n' || c_nationkey, 2, 1, 's', 'c_custkey' FROM (SELECT DISTINCT c_nationkey FROM customer)
    UNION ALL SELECT 'idx', 'n' || c_nationkey, (2 + i)::INT, col, CASE col WHEN 2 THEN 's' ELSE 'n' END,
      CASE col WHEN 1 THEN c_custkey::VARCHAR WHEN 2 THEN c_name ELSE CASE WHEN c_acctbal = floor(c_acctbal) THEN c_acctbal::BIGINT::VARCHAR ELSE c_acctbal::VARCHAR END END
      FROM (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS i FROM customer), (VALUES (1), (2), (3)) v(col)""",
)
def _(t):
    indexed = G.to_cells(t.customer, F.lit("idx"), F.concat(F.lit("n"), F.col("c_nationkey")), ["c_name", "c_acctbal"],
                         ["c_custkey"], block_of("c_custkey"), header=True, index=["c_custkey"])
    return texts(customer_cells(t).unionByName(indexed), "dtype")


@query(
    "a14_append_rows",
    SUPPLIER_SQL
    + f""", n AS (SELECT 'n' || c_nationkey AS sheet, c_custkey, c_name, c_acctbal,
              row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS i FROM customer),
         last AS (SELECT sheet, max("row") AS m FROM cells GROUP BY sheet)
       SELECT 'sup' AS book, sheet, "row"::INT AS "row", col::INT AS col, {TEXT} AS text, dtype FROM cells
       UNION ALL SELECT 'sup', n.sheet, (coalesce(m, 0) + i)::INT, 3, lpad(c_custkey::VARCHAR, 7, '0'), 's' FROM n LEFT JOIN last ON n.sheet = last.sheet WHERE c_custkey % 2 = 1
       UNION ALL SELECT 'sup', n.sheet, (coalesce(m, 0) + i)::INT, 1, c_custkey::VARCHAR, 'n' FROM n LEFT JOIN last ON n.sheet = last.sheet
       UNION ALL SELECT 'sup', n.sheet, (coalesce(m, 0) + i)::INT, 2, c_name, 's' FROM n LEFT JOIN last ON n.sheet = last.sheet
       UNION ALL SELECT 'sup', n.sheet, (coalesce(m, 0) + i)::INT, 4, CASE WHEN c_acctbal = floor(c_acctbal) THEN c_acctbal::BIGINT::VARCHAR ELSE c_acctbal::VARCHAR END, 'n' FROM n LEFT JOIN last ON n.sheet = last.sheet""",
)
def _(t):
    c = t.customer
    rows = c.select(
        F.lit("sup").alias("book"), F.concat(F.lit("n"), F.col("c_nationkey")).alias("sheet"), "c_custkey",
        F.when(F.col("c_custkey") % 2 == 0, G.dict_row({"A": F.col("c_custkey"), 2: F.col("c_name"), "D": F.col("c_acctbal")}))
        .otherwise(G.list_row(F.col("c_custkey"), F.col("c_name"), F.lpad(F.col("c_custkey").cast("string"), 7, "0"), F.col("c_acctbal"))).alias("values"),
    )
    return texts(G.append_rows(supplier_cells(t), rows, ["c_custkey"], block_of("c_custkey")), "dtype")


@query(
    "a15_save_param_table",
    """SELECT (row_number() OVER (ORDER BY p_partkey))::INT AS row_no, p_partkey AS Part_Key, replace(trim(p_name), ' - ', '-') AS Part_Name,
       p_size::BIGINT AS Size_cm, p_retailprice AS Retail_Price FROM part""",
)
def _(t):
    named = t.part.select(
        F.col("p_partkey").alias("Part Key"), F.concat(F.lit(" "), "p_name").alias("Part Name"),
        F.col("p_size").alias("Size (cm)"), F.col("p_retailprice").alias("Retail Price"),
    )
    made = G.param_table(named, ["Part Key"], block_of("Part Key"))
    own = uuid.uuid4().hex
    return G.save_param_table(made, f"gridspark_parts_{own}", "parts by key", f"{shared_folder(t.spark)}/parts-{own}")


@query(
    "a16_provenance",
    CUSTOMER_SQL + f"""SELECT book, max(CASE WHEN sheet = 'BUILDING' AND "row" = 1 AND col = 2 THEN {TEXT} END) AS version,
       max(CASE WHEN sheet = 'MACHINERY' AND "row" = 2 AND col = 4 THEN {TEXT} END) AS tax_correction,
       max(CASE WHEN sheet = 'FURNITURE' AND "row" = 2 AND col = 1 THEN {TEXT} END) AS price_year, 'lake/crm' AS path, '2024.1' AS reader, true AS signed FROM cells GROUP BY book""",
)
def _(t):
    spots = {"version_": ("BUILDING", 1, 2), "tax_correction": ("MACHINERY", 2, 4), "price_year": ("FURNITURE", 2, 1)}
    told = G.provenance(customer_cells(t), spots, "lake/crm", "2024.1")
    signed = (F.col("loaded_by") != "") & F.col("loaded_at").isNotNull()
    return told.select("book", F.col("version_").alias("version"), "tax_correction", "price_year", "path", F.col("version").alias("reader"), signed.alias("signed"))
