"""F13, G12, G14, H5: rules, validations and filters declared in books that are written from the customers."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from gridspark.operators import declared as D
from gridspark.session import shared_folder
from gridspark.sources import workbook as W
from suite.registry import query

CHUNK = 10_000
TODAY = dt.date(1996, 6, 15)
_MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"

# what the sheets of nation % 5 declare about their balances (B) and segments (C)
RULES = [
    '<conditionalFormatting sqref="B2:B1048576"><cfRule type="cellIs" priority="1" operator="greaterThan" stopIfTrue="1"><formula>5000</formula></cfRule>'
    '<cfRule type="aboveAverage" priority="2" stdDev="1"/></conditionalFormatting>',
    '<conditionalFormatting sqref="B2:B1048576"><cfRule type="top10" priority="1" rank="10" percent="1" bottom="1"/></conditionalFormatting>',
    '<conditionalFormatting sqref="B2:B1048576"><cfRule type="colorScale" priority="1"><colorScale><cfvo type="min"/><cfvo type="percentile" val="50"/><cfvo type="max"/>'
    '<color rgb="FFF8696B"/><color rgb="FFFFEB84"/><color rgb="FF63BE7B"/></colorScale></cfRule></conditionalFormatting>',
    '<conditionalFormatting sqref="C2:C1048576"><cfRule type="containsText" priority="2" operator="containsText" text="build"><formula>x</formula></cfRule>'
    '<cfRule type="duplicateValues" priority="1"/></conditionalFormatting><conditionalFormatting sqref="A2:A9"><cfRule type="expression" priority="3"><formula>$A2&gt;3</formula></cfRule></conditionalFormatting>',
    '<conditionalFormatting sqref="B2:B1048576"><cfRule type="iconSet" priority="1"><iconSet iconSet="3Arrows"><cfvo type="percent" val="0"/><cfvo type="percent" val="33"/><cfvo type="percent" val="67" gte="0"/></iconSet></cfRule></conditionalFormatting>',
]
CHECKS = (
    '<dataValidations><dataValidation type="decimal" operator="between" sqref="B2:B1048576"><formula1>9000</formula1><formula2>0</formula2></dataValidation>'
    '<dataValidation type="list" sqref="C2:C1048576"><formula1>"AUTOMOBILE, BUILDING"</formula1></dataValidation>'
    '<dataValidation type="list" sqref="A2:A1048576"><formula1>$A$2:$A$11</formula1></dataValidation></dataValidations>'
)
FILTERS = [
    '<filterColumn colId="1"><customFilters and="1"><customFilter operator="greaterThan" val="0"/><customFilter operator="lessThan" val="5000"/></customFilters></filterColumn>',
    '<filterColumn colId="2"><filters><filter val="BUILDING"/><filter val="MACHINERY"/></filters></filterColumn><filterColumn colId="1"><dynamicFilter type="aboveAverage"/></filterColumn>',
    '<filterColumn colId="1"><top10 val="20" percent="1"/></filterColumn><filterColumn colId="2"><customFilters><customFilter operator="notEqual" val="*IL?ING"/></customFilters></filterColumn>',
]


def written(t) -> str:
    """A book per nation and ten thousand customers, each with the items of its nation."""
    folder = f"{shared_folder(t.spark)}/declared-{uuid.uuid4().hex}"

    def write(pdf):
        import pandas as pd

        from gridspark.sources import files, ooxml

        fs, base = files.filesystem(folder)
        fs.create_dir(base, recursive=True)
        pdf = pdf.sort_values("c_custkey")
        nation, name = int(pdf["c_nationkey"].iloc[0]), f"n{pdf['c_nationkey'].iloc[0]}_{pdf['chunk'].iloc[0]}.xlsx"
        with fs.open_output_stream(f"{base}/{name}") as out:
            sheet = ooxml.SheetWriter(out, "data")
            sheet.append(["id", "balance", "segment"])
            for row in zip(pdf["c_custkey"].tolist(), pdf["c_acctbal"].tolist(), pdf["c_mktsegment"], strict=True):
                sheet.append(row)
            area = f'<autoFilter ref="A1:C{len(pdf) + 1}">{FILTERS[nation % 3]}</autoFilter>'
            sheet.close(area + RULES[nation % 5] + CHECKS)
        return pd.DataFrame({"name": [name]})

    made = t.customer.select("c_custkey", "c_acctbal", "c_mktsegment", "c_nationkey", F.floor(F.col("c_custkey") / CHUNK).alias("chunk"))
    made.groupBy("c_nationkey", "chunk").applyInPandas(write, "name string").write.format("noop").mode("overwrite").save()
    return folder


def scanned(t):
    folder = written(t)
    return W.scan_workbooks(t.spark, folder, data_only=True), W.scan_declared(t.spark, folder)


_SQL = """WITH c AS (SELECT 'n' || c_nationkey || '_' || (c_custkey // 10000) || '.xlsx' AS book, c_nationkey AS nation, c_custkey AS id, c_acctbal AS bal, c_mktsegment AS seg,
            1 + row_number() OVER (PARTITION BY c_nationkey, c_custkey // 10000 ORDER BY c_custkey) AS r FROM customer),
     w AS (SELECT *, count(*) OVER b AS n, avg(bal) OVER b AS m, stddev_samp(bal) OVER b AS d, min(bal) OVER b AS lo, max(bal) OVER b AS hi, quantile_cont(bal, 0.5) OVER b AS mid,
            row_number() OVER (PARTITION BY book ORDER BY bal) AS up, row_number() OVER (PARTITION BY book ORDER BY bal DESC) AS down, count(*) OVER (PARTITION BY book, seg) AS same FROM c WINDOW b AS (PARTITION BY book)),
     e AS (SELECT *, max(CASE WHEN up = greatest(1, n * 10 // 100) THEN bal END) OVER b AS low_edge, max(CASE WHEN down = greatest(1, n * 20 // 100) THEN bal END) OVER b AS top_edge FROM w WINDOW b AS (PARTITION BY book))
"""

_RULES_SQL = _SQL + """, j AS (
       SELECT book, r, 2 AS col, 'cellIs' AS type, bal > 5000 AS hit, NULL::DOUBLE AS position, NULL::INT AS bucket, 1 AS priority FROM e WHERE nation % 5 = 0
       UNION ALL SELECT book, r, 2, 'aboveAverage', coalesce(bal > m + coalesce(d, 0), false), NULL, NULL, 2 FROM e WHERE nation % 5 = 0
       UNION ALL SELECT book, r, 2, 'top10', bal <= low_edge, NULL, NULL, 1 FROM e WHERE nation % 5 = 1
       UNION ALL SELECT book, r, 2, 'colorScale', true, CASE WHEN bal >= hi THEN 2 WHEN bal >= mid THEN 1 + (bal - mid) / (hi - mid) ELSE (bal - lo) / (mid - lo) END, NULL, 1 FROM e WHERE nation % 5 = 2
       UNION ALL SELECT book, r, 3, 'containsText', seg = 'BUILDING', NULL, NULL, 2 FROM e WHERE nation % 5 = 3 UNION ALL SELECT book, r, 3, 'duplicateValues', same > 1, NULL, NULL, 1 FROM e WHERE nation % 5 = 3
       UNION ALL SELECT book, r, 1, 'expression', NULL, NULL, NULL, 3 FROM e WHERE nation % 5 = 3 AND r <= 9
       UNION ALL SELECT book, r, 2, 'iconSet', true, NULL, CASE WHEN bal > lo + (hi - lo) * 67 / 100 THEN 2 WHEN bal >= lo + (hi - lo) * 33 / 100 THEN 1 ELSE 0 END, 1 FROM e WHERE nation % 5 = 4)
"""


@query("g14_declared_rules", _RULES_SQL + "SELECT book, r::INT AS \"row\", col, type, hit, round(position, 6) AS position, bucket FROM j")
def _(t):
    judged = D.evaluate_rules(*scanned(t), TODAY)
    return judged.select("book", "row", "col", "type", "hit", F.round("position", 6).alias("position"), "bucket")


@query("g12_resolve_declared", _RULES_SQL + """, s AS (SELECT *, bool_or(hit AND type = 'cellIs') OVER (PARTITION BY book, r, col) AS stopped FROM j)
       SELECT book, r::INT AS "row", col, coalesce(string_agg(type, '+' ORDER BY priority) FILTER (hit AND (priority = 1 OR NOT stopped)), '') AS applied FROM s GROUP BY ALL""")
def _(t):
    resolved = D.resolve_declared(D.evaluate_rules(*scanned(t), TODAY))
    return resolved.select("book", "row", "col", F.array_join("applied", "+").alias("applied"))


@query("h5_declared_validations", _SQL + """, v AS (SELECT book, r, 2 AS col, 'decimal' AS type, bal BETWEEN 0 AND 9000 AS valid FROM c UNION ALL SELECT book, r, 3, 'list', seg IN ('AUTOMOBILE', 'BUILDING') FROM c UNION ALL SELECT book, r, 1, 'list', r <= 11 FROM c)
       SELECT book, type, col, count(*) AS checked, count_if(NOT valid)::BIGINT AS violations, min(CASE WHEN NOT valid THEN r END)::INT AS first_row FROM v GROUP BY book, type, col""")
def _(t):
    judged = D.evaluate_validations(*scanned(t))
    column = judged.groupBy("book", "rule_id").agg(F.first("col").alias("col"))  # each of these covers one column
    return D.report(judged).join(column, ["book", "rule_id"]).select("book", "type", "col", "checked", "violations", "first_row")


@query("f13_declared_filters", _SQL + """SELECT book, r::INT AS "row", CASE nation % 3 WHEN 0 THEN bal > 0 AND bal < 5000 WHEN 1 THEN seg IN ('BUILDING', 'MACHINERY') AND bal > m ELSE bal >= top_edge AND seg <> 'BUILDING' END AS visible FROM e""")
def _(t):
    return D.evaluate_filters(*scanned(t), TODAY).select("book", "row", "visible")
