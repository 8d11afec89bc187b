"""A1, A2, A8, A12, A17: workbook files, written from the tables into the shared folder and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from gridspark.scale import block_of
from gridspark.session import shared_folder
from gridspark.sources import workbook as W
from gridspark.operators import grid as G
from suite.common import TEXT, cells_sql
from suite.registry import query

_BOOK_SQL = cells_sql(
    "(SELECT o_orderkey, o_custkey, o_orderpriority, o_totalprice, o_orderdate, o_custkey % 40 AS part, CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE o_totalprice END AS price, '=B2*' || o_orderkey AS twice FROM orders)",
    "part || '.xlsx'", "'data'", "o_orderkey", {"o_orderkey": "n", "price": "n", "o_orderpriority": "s", "o_orderdate": "d", "twice": "s"},
)
# how long an order has waited, as a duration cell beyond the other columns
_WAIT = "lpad((o_custkey % 90)::VARCHAR, 2, '0') || ':' || lpad((o_orderkey % 60)::VARCHAR, 2, '0') || ':00'"


def written(t) -> str:
    """One workbook per customer group, some blanks, a date and a formula column."""
    folder = f"{shared_folder(t.spark)}/books-{uuid.uuid4().hex}"
    o = t.orders
    rows = o.select(
        "o_orderkey", F.when(F.col("o_orderkey") % 10 != 0, F.col("o_totalprice")).alias("price"), "o_orderpriority", "o_orderdate",
        F.struct(F.concat(F.lit("=B2*"), "o_orderkey").alias("formula"), F.when(F.col("o_orderkey") % 10 != 0, F.col("o_totalprice") * 2).alias("value")).alias("twice"),
        F.make_dt_interval(F.lit(0), (F.col("o_custkey") % 90).cast("int"), (F.col("o_orderkey") % 60).cast("int")).alias("waited"), (F.col("o_custkey") % 40).alias("part"),
    )
    W.write_workbooks(rows, folder, "part", ["o_orderkey"], block_of("o_orderkey"), sheet="data")
    return folder


@query("a1_scan_workbooks", _BOOK_SQL + f"""SELECT book, sheet, "row"::INT AS "row", col::INT AS col, dtype, {TEXT} AS text FROM cells WHERE col < 5
    UNION ALL SELECT book, sheet, r, 6, 'n', {_WAIT} FROM src UNION ALL SELECT DISTINCT book, sheet, 1, 6, 's', 'waited' FROM src""")
def _(t):
    cells = W.scan_workbooks(t.spark, written(t), cols=[1, 2, 3, 4, 6])
    return cells.filter("col <> 5 and col < 7").select("book", "sheet", "row", "col", "dtype", G.text_of().alias("text"))


@query("a1_pushed_scan", _BOOK_SQL + """SELECT book, sheet, "row"::INT AS "row", v_num FROM cells WHERE col = 2 AND "row" > 1 AND dtype = 'n' AND v_num IS NOT NULL""")
def _(t):
    """The reader of the format itself: the filters on sheet, row and column are pushed into it."""
    W.register(t.spark, push=True)
    read = t.spark.read.format("workbook").option("push", "true").load(written(t))
    stored = read.filter((F.col("sheet") == "data") & (F.col("row") > 1) & (F.col("col") == 2))
    return stored.select("book", "sheet", "row", F.col("v").try_cast("double").alias("v_num"))


@query(
    "a2_value_mode",
    _BOOK_SQL + """SELECT 'formula' AS mode, book, count(*) AS n, max(v_str) AS top, NULL::DOUBLE AS total FROM cells WHERE col = 5 GROUP BY book
       UNION ALL SELECT 'value', part || '.xlsx', 1 + count(price), 'twice', round(sum(price * 2), 2) FROM src GROUP BY part""",
)
def _(t):
    folder = written(t)
    out = None
    for mode, only in (("formula", False), ("value", True)):
        cells = W.scan_workbooks(t.spark, folder, data_only=only, cols=[5]).filter((F.col("col") == 5) & G.has_value())
        part = cells.groupBy("book").agg(F.count(F.lit(1)).alias("n"), F.max("v_str").alias("top"), F.round(F.sum("v_num"), 2).alias("total")).withColumn("mode", F.lit(mode))
        out = part if out is None else out.unionByName(part)
    return out


@query(
    "a8_scan_catalogue",
    "SELECT DISTINCT (o_custkey % 40) || '.xlsx' AS book, kind, name, value, idx FROM orders, (VALUES ('sheet', 'data', 'visible', 0), ('core', 'title', 'data', NULL)) v(kind, name, value, idx)",
)
def _(t):
    folder = written(t)
    sheets = W.scan_catalogue(t.spark, folder).select("book", F.lit("sheet").alias("kind"), F.col("sheet").alias("name"), F.col("state").alias("value"), "idx")
    props = W.scan_properties(t.spark, folder).withColumn("idx", F.lit(None).cast("int"))
    return sheets.unionByName(props)


@query(
    "a12_write_workbooks",
    "SELECT o_orderkey::VARCHAR AS id, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS day, o_orderpriority AS priority, (o_custkey % 40) || CASE WHEN rn > 99 THEN '~' || ((rn - 1) // 99 + 1) ELSE '' END || '.xlsx' AS book FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey % 40 ORDER BY o_orderkey) AS rn FROM orders)",
)
def _(t):
    folder = f"{shared_folder(t.spark)}/split-{uuid.uuid4().hex}"
    rows = t.orders.select("o_orderkey", "o_orderdate", "o_orderpriority", (F.col("o_custkey") % 40).alias("part"))
    W.write_workbooks(rows, folder, "part", ["o_orderkey"], block_of("o_orderkey"), max_rows=100)
    cells = W.scan_workbooks(t.spark, folder, data_only=True)
    return G.read_range(cells, "Sheet1", "A:C", skip=0, header=True, names=["id", "day", "priority"]).select("id", "day", "priority", "book")


def linked(t) -> str:
    """Workbooks that cache cells of another file: up to 500 suppliers of a nation each."""
    folder = f"{shared_folder(t.spark)}/links-{uuid.uuid4().hex}"

    def write(pdf):
        import zipfile

        import pandas as pd

        from gridspark.sources import files

        fs, base = files.filesystem(folder)
        fs.create_dir(base, recursive=True)
        nation, chunk = int(pdf["s_nationkey"].iloc[0]), int(pdf["chunk"].iloc[0])
        rows = "".join(
            f'<row r="{k + 1}"><cell r="A{k + 1}"><v>{b!r}</v></cell><cell r="B{k + 1}" t="str"><v>{n}</v></cell></row>'
            for k, b, n in zip(pdf["s_suppkey"], pdf["s_acctbal"], pdf["s_name"])
        )
        office = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
        package = "http://schemas.openxmlformats.org/package/2006/relationships"
        main = f'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="{office}"'
        parts = {
            "_rels/.rels": f'<Relationships xmlns="{package}"><Relationship Id="rId1" Type="{office}/officeDocument" Target="xl/workbook.xml"/></Relationships>',
            "xl/workbook.xml": f"<workbook {main}><sheets/><externalReferences><externalReference r:id=\"rId1\"/></externalReferences></workbook>",
            "xl/_rels/workbook.xml.rels": f'<Relationships xmlns="{package}"><Relationship Id="rId1" Type="{office}/externalLink" Target="externalLinks/externalLink1.xml"/></Relationships>',
            "xl/externalLinks/_rels/externalLink1.xml.rels": f'<Relationships xmlns="{package}"><Relationship Id="rId1" Type="{office}/externalLinkPath" Target="nation{nation}.xlsx" TargetMode="External"/></Relationships>',
            "xl/externalLinks/externalLink1.xml": f'<externalLink {main}><externalBook r:id="rId1"><sheetNames><sheetName val="suppliers"/></sheetNames><sheetDataSet><sheetData sheetId="0">{rows}</sheetData></sheetDataSet></externalBook></externalLink>',
        }
        name = f"link{nation}_{chunk}.xlsx"
        with fs.open_output_stream(f"{base}/{name}") as out, zipfile.ZipFile(out, "w") as z:
            for member, body in parts.items():
                z.writestr(member, body)
        return pd.DataFrame({"name": [name]})

    chunks = t.supplier.withColumn("chunk", F.floor(F.col("s_suppkey") / 500))
    chunks.groupBy("s_nationkey", "chunk").applyInPandas(write, "name string").write.format("noop").mode("overwrite").save()
    return folder


@query(
    "a17_scan_external",
    """SELECT 'nation' || s_nationkey || '.xlsx' AS book, 'link' || s_nationkey || '_' || (s_suppkey // 500) || '.xlsx' AS linked_from, (s_suppkey + 1)::INT AS "row", 1 AS col, s_acctbal AS v_num, NULL AS v_str FROM supplier
       UNION ALL SELECT 'nation' || s_nationkey || '.xlsx', 'link' || s_nationkey || '_' || (s_suppkey // 500) || '.xlsx', (s_suppkey + 1)::INT, 2, NULL, s_name FROM supplier""",
)
def _(t):
    return W.scan_external(t.spark, linked(t)).select("book", "linked_from", "row", "col", "v_num", "v_str")


def _books(t, rows, key: str, order: str, prefix: str, write_one) -> str:
    """A file per key and ten thousand rows; ``write_one(handle, pdf)`` writes it."""
    folder = f"{shared_folder(t.spark)}/{prefix}-{uuid.uuid4().hex}"

    def write(pdf):
        import pandas as pd

        from gridspark.sources import files

        fs, base = files.filesystem(folder)
        fs.create_dir(base, recursive=True)
        name = f"{prefix}{pdf[key].iloc[0]}_{pdf['chunk'].iloc[0]}.xlsx"
        with fs.open_output_stream(f"{base}/{name}") as out:
            write_one(out, pdf.sort_values(order))
        return pd.DataFrame({"name": [name]})

    rows.groupBy(key, "chunk").applyInPandas(write, "name string").write.format("noop").mode("overwrite").save()
    return folder


def _array_book(out, pdf):
    from gridspark.sources import ooxml

    sheet, n = ooxml.SheetWriter(out, "data"), len(pdf)
    for i, (key, total) in enumerate(zip(pdf["o_orderkey"].tolist(), pdf["o_totalprice"].tolist(), strict=True)):
        twice = total * 2
        sheet.append([key, total, {"formula": f"=B1:B{n}*2", "value": twice, "ref": f"C1:C{n}"} if i == 0 else twice])
    sheet.close()


@query(
    "e4_spread_arrays",
    """SELECT 'a' || k || '_' || c || '.xlsx' AS book, r::INT AS "row", '=B1:B' || n || '*2' AS array_formula, r = 1 AS anchor, round(o_totalprice * 2, 2) AS v_num
       FROM (SELECT *, o_custkey % 40 AS k, o_orderkey // 400000 AS c, count(*) OVER (PARTITION BY o_custkey % 40, o_orderkey // 400000) AS n, row_number() OVER (PARTITION BY o_custkey % 40, o_orderkey // 400000 ORDER BY o_orderkey) AS r FROM orders)""",
)
def _(t):
    """Array formulas of written books over their range, with the cached value of every cell."""
    from gridspark.operators import formulas as E

    rows = t.orders.select("o_orderkey", "o_totalprice", (F.col("o_custkey") % 40).alias("k"), F.floor(F.col("o_orderkey") / 400_000).alias("chunk"))
    folder = _books(t, rows, "k", "o_orderkey", "a", _array_book)
    cells = W.scan_workbooks(t.spark, folder, data_only=True)
    out = E.spread_arrays(cells, W.scan_arrays(W.scan_declared(t.spark, folder)))
    return out.filter("array_formula is not null").select("book", "row", "array_formula", "anchor", F.round("v_num", 2).alias("v_num"))


def _rich_book(out, pdf):
    from gridspark.sources import ooxml

    sheet = ooxml.SheetWriter(out, "talk")
    for conv, turn, role, text in zip(pdf["conv_id"].tolist(), pdf["turn"].tolist(), pdf["role"], pdf["text"], strict=True):
        sheet.append([conv, turn, [(("b", 'sz val="12"'), role), (("i",), ": "), (("i",), (text or "").replace("\r", " ")[:30000])]])
    sheet.close()


@query(
    "b19_rich_text",
    """SELECT 't' || (conv_id % 20) || '_' || (conv_id // 100000) || '.xlsx' AS book, conv_id, turn, role || ': ' || replace(coalesce(text, ''), chr(13), ' ')[:30000] AS flat, 2::BIGINT AS runs, 'b=1;sz=12' AS font FROM conversations""",
)
def _(t):
    """Formatted text of written books: flattened, and its neighbouring runs of one font merged."""
    from gridspark.functions import scalars as S
    from gridspark.operators import typing as T

    rows = t.conversations.select("conv_id", "turn", "role", "text", (F.col("conv_id") % 20).alias("k"), F.floor(F.col("conv_id") / 100_000).alias("chunk"), (F.col("conv_id") * 1000 + F.col("turn")).alias("o"))
    folder = _books(t, rows, "k", "o", "t", _rich_book)
    rich = W.scan_rich(t.spark, folder)
    place = ["book", "sheet", "row", "col"]
    pieces = rich.select(*place, F.posexplode("runs").alias("pos", "r")).select(*place, "pos", "r.font", "r.text")
    merged = T.merge_runs(pieces, place, "pos", block_of("pos", 4096)).groupBy(*place).agg(F.count(F.lit(1)).alias("runs"), F.min_by("font", "run").alias("font"))
    ids = W.scan_workbooks(t.spark, folder, data_only=True).filter("col < 3").groupBy("book", "sheet", "row").agg(
        F.max(F.when(F.col("col") == 1, F.col("v_num"))).cast("long").alias("conv_id"), F.max(F.when(F.col("col") == 2, F.col("v_num"))).cast("long").alias("turn"))
    flat = rich.select(*place, S.flatten_runs(F.col("runs")).alias("flat"))
    return flat.join(merged, place).join(ids, ["book", "sheet", "row"]).select("book", "conv_id", "turn", "flat", "runs", "font")


def _pivot_book(out, pdf):
    import zipfile

    main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    office = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    rel = lambda i, kind, target: f'<Relationship Id="rId{i}" Type="{office}/{kind}" Target="{target}"/>'
    rels = lambda *r: '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">' + "".join(r) + "</Relationships>"
    flags, states = sorted(set(pdf["l_returnflag"])), sorted(set(pdf["l_linestatus"]))
    shared = lambda vs: "<sharedItems>" + "".join(f'<s v="{v}"/>' for v in vs) + "</sharedItems>"
    records = "".join(
        f'<r><x v="{flags.index(f)}"/><x v="{states.index(s)}"/><n v="{q:g}"/><n v="{k}"/></r>'
        for f, s, q, k in zip(pdf["l_returnflag"], pdf["l_linestatus"], pdf["l_quantity"], pdf["rec"], strict=True)
    )
    fields = f'<cacheField name="flag">{shared(flags)}</cacheField><cacheField name="status">{shared(states)}</cacheField><cacheField name="quantity"><sharedItems containsNumber="1"/></cacheField><cacheField name="key"><sharedItems/></cacheField>'
    parts = {
        "_rels/.rels": rels(rel(1, "officeDocument", "xl/workbook.xml")),
        "xl/workbook.xml": f"<workbook {main}><sheets/></workbook>",
        "xl/_rels/workbook.xml.rels": rels(rel(1, "pivotCacheDefinition", "pivotCache/def1.xml")),
        "xl/pivotCache/def1.xml": f"<pivotCacheDefinition {main}><cacheFields>{fields}</cacheFields></pivotCacheDefinition>",
        "xl/pivotCache/_rels/def1.xml.rels": rels(rel(1, "pivotCacheRecords", "records1.xml")),
        "xl/pivotCache/records1.xml": f"<pivotCacheRecords {main}>{records}</pivotCacheRecords>",
    }
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for member, body in parts.items():
            z.writestr(member, body)


@query(
    "a6_pivot_caches",
    "SELECT l_orderkey * 8 + l_linenumber AS key, l_returnflag AS flag, l_linestatus AS status, l_quantity AS quantity, count(*) AS n FROM lineitem GROUP BY ALL",
)
def _(t):
    """Pivot caches written to books, read back and decoded through their shared items."""
    rec = F.col("l_orderkey") * 8 + F.col("l_linenumber")
    rows = t.lineitem.select("l_returnflag", "l_linestatus", "l_quantity", rec.alias("rec"), (F.col("l_orderkey") % 32).alias("k"), F.floor(F.col("l_orderkey") / 100_000).alias("chunk"))
    records, items, fields = W.scan_pivot_caches(t.spark, _books(t, rows, "k", "rec", "p", _pivot_book))
    out = G.decode_pivot_cache(records, items, {0: "flag", 1: "status", 2: "quantity", 3: "key"})
    return out.groupBy(F.col("key").cast("long").alias("key"), "flag", "status", F.col("quantity").cast("double").alias("quantity")).agg(F.count(F.lit(1)).alias("n"))
