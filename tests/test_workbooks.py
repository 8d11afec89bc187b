"""Workbook files: round trips, hand-made archives, sink rules."""

import datetime as dt
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from gridspark.operators import grid as G
from gridspark.scale import block_of
from gridspark.sources import workbook as W

MAIN = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
OFFICE = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
RELS = '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'


@pytest.fixture
def archive(tmp_path):
    sheet = """<sheetData>
      <row><c t="s"><v>1</v></c><c t="inlineStr"><is><r><t>ri</t></r><r><t>ch</t></r></is></c><c><v>1.5</v></c></row>
      <row r="4"><c r="B4" s="1"><v>1462</v></c><c t="b"><v>1</v></c><c t="e"><v>#N/A</v></c><c s="2"><v>1.25</v></c></row>
      <row><c r="A5"><f t="shared" si="0" ref="A5:A7">B1*$C$1</f><v>3</v></c></row>
      <row r="7"><c r="A7"><f t="shared" si="0"/><v>4</v></c><c><v> </v></c><c t="d"><v>2024-01-02T03:04:05</v></c></row>
    </sheetData><mergeCells><mergeCell ref="A1:B2"/></mergeCells><hyperlinks><hyperlink ref="A1:B1" r:id="rId1"/></hyperlinks>"""
    parts = {
        "_rels/.rels": f'{RELS}<Relationship Id="rId1" Type="{OFFICE}/officeDocument" Target="xl/workbook.xml"/><Relationship Id="rId2" Type="{OFFICE}/custom-properties" Target="docProps/custom.xml"/></Relationships>',
        "docProps/custom.xml": '<Properties><property name="version"><lpwstr>v9</lpwstr></property></Properties>',
        "xl/workbook.xml": f'<workbook {MAIN} xmlns:r="{OFFICE}"><workbookPr date1904="1"/><sheets><sheet name="one" sheetId="1" r:id="rId1"/><sheet name="gone" sheetId="2" state="veryHidden" r:id="rId1"/></sheets>'
        '<definedNames><definedName name="all">one!$A$1:$C$1</definedName><definedName name="all" localSheetId="0">one!$A$7</definedName></definedNames></workbook>',
        "xl/_rels/workbook.xml.rels": f'{RELS}<Relationship Id="rId1" Type="{OFFICE}/worksheet" Target="worksheets/sheet1.xml"/><Relationship Id="rId2" Type="{OFFICE}/sharedStrings" Target="/xl/sharedStrings.xml"/><Relationship Id="rId3" Type="{OFFICE}/styles" Target="styles.xml"/></Relationships>',
        "xl/sharedStrings.xml": f"<sst {MAIN}><si><t>zero</t></si><si><r><t>o</t></r><r><t>ne_x005F_</t></r><rPh><t>no</t></rPh></si></sst>",
        "xl/styles.xml": f'<styleSheet {MAIN}><numFmts><numFmt numFmtId="170" formatCode="yyyy-mm-dd"/></numFmts><cellXfs><xf numFmtId="0"/><xf numFmtId="170"/><xf numFmtId="46"/></cellXfs></styleSheet>',
        "xl/worksheets/sheet1.xml": f'<worksheet {MAIN} xmlns:r="{OFFICE}">{sheet}</worksheet>',
        "xl/worksheets/_rels/sheet1.xml.rels": f'{RELS}<Relationship Id="rId1" Type="{OFFICE}/hyperlink" Target="https://example.com/" TargetMode="External"/><Relationship Id="rId2" Type="{OFFICE}/comments" Target="../comments1.xml"/>'
        f'<Relationship Id="rId3" Type="{OFFICE}/table" Target="../tables/table1.xml"/></Relationships>',
        "xl/comments1.xml": f'<comments {MAIN}><commentList><comment ref="C1"><text><r><t>note</t></r></text></comment></commentList></comments>',
        "xl/tables/table1.xml": f'<table {MAIN} displayName="T1" ref="A1:C4" totalsRowCount="1"/>',
    }
    with zipfile.ZipFile(tmp_path / "book.xlsx", "w") as z:
        for name, body in parts.items():
            z.writestr(name, body)
    (tmp_path / "notes.txt").write_text("not a workbook")
    return str(tmp_path)


def at(cells, sheet="one"):
    return {(r["row"], r["col"]): r for r in cells.filter(F.col("sheet") == sheet).collect()}


def test_scan_values(spark, archive):
    c = at(W.scan_workbooks(spark, archive, data_only=True))
    assert c[1, 1]["v_str"] == "one_" and c[1, 2]["v_str"] == "rich" and c[1, 3]["v_num"] == 1.5
    assert c[4, 2]["v_ts"] == dt.datetime(1908, 1, 2) and c[4, 3]["v_bool"] is True and c[4, 4]["err"] == "#N/A"
    assert c[5, 1]["v_num"] == 3.0 and c[7, 3]["v_ts"] == dt.datetime(2024, 1, 2, 3, 4, 5)
    assert c[7, 2]["v_num"] is None


def test_scan_formulas(spark, archive):
    c = at(W.scan_workbooks(spark, archive))
    assert c[5, 1]["v_str"] == "=B1*$C$1" and c[7, 1]["formula"] == "=B3*$C$1" and c[7, 1]["v_num"] is None


def test_scan_prunes_sheets_and_rows(spark, archive):
    assert set(at(W.scan_workbooks(spark, archive, sheets=["one"], max_row=1))) == {(1, 1), (1, 2), (1, 3)}
    assert W.scan_workbooks(spark, archive, sheets=["none"]).count() == 0


def test_catalogue_properties_names_parts(spark, archive):
    assert [(r["sheet"], r["idx"], r["state"]) for r in W.scan_catalogue(spark, archive).orderBy("idx").collect()] == [("one", 0, "visible"), ("gone", 1, "veryHidden")]
    assert [tuple(r) for r in W.scan_properties(spark, archive).select("kind", "name", "value").collect()] == [("custom", "version", "v9")]
    names = W.scan_names(spark, archive)
    cells = W.scan_workbooks(spark, archive, data_only=True)
    assert {(r["row"], r["col"]) for r in G.resolve_names(cells, names, "one").collect()} == {(7, 1)}
    assert {(r["row"], r["col"]) for r in G.resolve_names(cells, names, "gone").collect()} == {(1, 1), (1, 2), (1, 3)}
    parts = {r["kind"]: r for r in W.scan_parts(spark, archive).filter("sheet = 'one'").collect()}
    assert parts["merge"]["ref"] == "A1:B2" and parts["link"]["text"] == "https://example.com/" and parts["comment"]["text"] == "note"
    assert (parts["table"]["name"], parts["table"]["header_rows"], parts["table"]["totals_rows"]) == ("T1", 1, 1)


def test_other_files_are_refused(spark, archive):
    with pytest.raises(ValueError, match="not a workbook"):
        W.scan_workbooks(spark, f"{archive}/notes.txt")


def test_write_splits_large_keys_and_reads_back(spark, tmp_path):
    rows = spark.range(250).select("id", F.when(F.col("id") < 200, "hot").otherwise("cold").alias("k"), (F.col("id") / 7).alias("x"), F.lit("a<b & 'c'").alias("t"), (F.col("id") % 2 == 0).alias("even"))
    W.write_workbooks(rows, str(tmp_path / "out"), "k", ["id"], block_of("id", 64), max_rows=101)
    cells = W.scan_workbooks(spark, str(tmp_path / "out"), data_only=True)
    back = G.read_range(cells, None, "A:E", header=True, names=["id", "k", "x", "t", "even"])
    assert {r["book"]: r["count"] for r in back.groupBy("book").count().collect()} == {"hot.xlsx": 100, "hot~2.xlsx": 100, "cold.xlsx": 50}
    got = {int(r["id"]): r for r in back.collect()}
    assert float(got[100]["x"]) == pytest.approx(100 / 7, rel=1e-15) and got[3]["t"] == "a<b & 'c'" and got[3]["even"] == "FALSE"
    assert got[99]["row"] == 101 and got[100]["row"] == 2
    assert not [p for p in (tmp_path / "out").iterdir() if p.suffix == ".part"]


def test_zoned_timestamps_and_odd_types_are_refused(spark, tmp_path):
    with pytest.raises(TypeError, match="time zones"):
        W.write_workbooks(spark.range(1).withColumn("t", F.current_timestamp()), str(tmp_path), "id", ["id"], block_of("id"))
    with pytest.raises(ValueError, match="cannot convert"):
        W.write_workbooks(spark.range(1).withColumn("t", F.array(F.lit(1))), str(tmp_path), "id", ["id"], block_of("id"))


def test_times_and_durations_are_kept(spark, archive, tmp_path):
    book = tmp_path / "book.xlsx"
    with zipfile.ZipFile(book) as z:
        parts = {n: z.read(n).decode() for n in z.namelist()}
    parts["xl/styles.xml"] = parts["xl/styles.xml"].replace('<xf numFmtId="46"/>', '<xf numFmtId="46"/><xf numFmtId="21"/>')
    parts["xl/worksheets/sheet1.xml"] = parts["xl/worksheets/sheet1.xml"].replace("<v>1.5</v>", "<v>1.5</v></c><c s=\"3\"><v>0.5</v>")
    with zipfile.ZipFile(book, "w") as z:
        for name, body in parts.items():
            z.writestr(name, body)
    cells = W.scan_workbooks(spark, archive, data_only=True)
    c = at(cells.withColumn("text", G.text_of()).filter(G.filled()))
    assert c[1, 4]["time_ms"] == 43_200_000 and c[1, 4]["text"] == "12:00:00"
    assert c[4, 5]["span_ms"] == 108_000_000 and c[4, 5]["text"] == "30:00:00"


def test_books_are_named_by_path_and_any_case_is_read(spark, archive, tmp_path):
    (tmp_path / "a b").mkdir()
    data = (tmp_path / "book.xlsx").read_bytes()
    (tmp_path / "a b" / "book.xlsx").write_bytes(data)
    (tmp_path / "UP.XLSX").write_bytes(data)
    (tmp_path / "torn.xlsx").write_bytes(data[: len(data) // 2])
    cells = W.scan_workbooks(spark, archive)
    n = {r["book"]: r["count"] for r in cells.groupBy("book").count().collect()}
    assert set(n) == {"book.xlsx", "a b/book.xlsx", "UP.XLSX", "torn.xlsx"} and n["a b/book.xlsx"] == n["UP.XLSX"] == n["book.xlsx"]
    assert n["torn.xlsx"] == 1 and cells.filter("book = 'torn.xlsx'").first()["err"].startswith("unreadable")
    assert W.scan_catalogue(spark, archive).filter("state = 'unreadable'").count() == 1


def test_keys_never_share_a_file_and_long_texts_are_refused(spark, tmp_path):
    rows = spark.createDataFrame([(i, k) for i, k in enumerate(["a"] * 5 + ["a~2"] * 2 + [None, "~null", "x/y"])], "id int, k string")
    W.write_workbooks(rows, str(tmp_path / "out"), "k", ["id"], block_of("id"), max_rows=4)
    names = sorted(p.name for p in (tmp_path / "out").iterdir())
    assert names == sorted(["a.xlsx", "a~2.xlsx", "a~~2.xlsx", "~null.xlsx", "~~null.xlsx", "x~sy.xlsx"])
    long = spark.range(1).select("id", F.repeat(F.lit("x"), 40_000).alias("t"))
    with pytest.raises(Exception, match="40000 characters"):
        W.write_workbooks(long, str(tmp_path / "no"), "id", ["id"], block_of("id"))
    assert not list((tmp_path / "no").iterdir())


DECLARED = """<cols><col min="2" max="3" outlineLevel="1" hidden="1"/></cols><sheetData>
  <row r="1"><c r="A1"><v>1</v></c><c r="B1"><v>2</v></c></row>
  <row r="2" outlineLevel="1"><c r="A2"><v>3</v></c></row><row r="3" outlineLevel="2" hidden="1"><c r="A3"><f t="array" ref="A3:A4">B1:B2*2</f><v>4</v></c></row>
  <row r="5"><c r="B5"><f t="dataTable" ref="B5:C6" dt2D="1" dtr="1" r1="A1" r2="B1"/><v>5</v></c></row></sheetData>
  <autoFilter ref="A1:B5"><filterColumn colId="0"><filters><filter val="x"/><dateGroupItem year="2024" month="5" dateTimeGrouping="month"/></filters></filterColumn>
  <filterColumn colId="1"><customFilters and="1"><customFilter operator="greaterThan" val="3"/><customFilter operator="lessThan" val="9"/></customFilters></filterColumn>
  <sortState ref="A2:B5"><sortCondition ref="B2:B5" descending="1"/></sortState></autoFilter>
  <scenarios><scenario name="high"><inputCells r="B1" val="20"/><inputCells r="A1" val="text"/></scenario></scenarios>
  <conditionalFormatting sqref="A1:A2 C:C"><cfRule type="cellIs" priority="1" operator="greaterThan" stopIfTrue="1"><formula>2</formula></cfRule></conditionalFormatting>
  <dataValidations><dataValidation type="whole" operator="between" allowBlank="1" sqref="A1:A9"><formula1>1</formula1><formula2>9</formula2></dataValidation></dataValidations>"""


def test_declared_specs_feed_the_operators(spark, archive, tmp_path):
    from gridspark.operators import rules as R
    from gridspark.operators import structure as D
    from gridspark.plans import costs as X

    book = tmp_path / "book.xlsx"
    with zipfile.ZipFile(book) as z:
        parts = {n: z.read(n).decode() for n in z.namelist()}
    parts["xl/worksheets/sheet1.xml"] = f'<worksheet {MAIN} xmlns:r="{OFFICE}">{DECLARED}</worksheet>'
    with zipfile.ZipFile(book, "w") as z:
        for name, body in parts.items():
            z.writestr(name, body)
    found = W.scan_declared(spark, archive).filter("sheet = 'one'").cache()
    cells = W.scan_workbooks(spark, archive, data_only=True, sheets=["one"])

    rows = D.outline(cells, W.scan_outlines(found))
    assert {(r.row, r.level, r.hidden) for r in rows.collect()} == {(1, 0, False), (2, 1, False), (3, 2, True), (5, 0, False)}
    assert [(r.start, r.end, r.hidden) for r in W.scan_outlines(found, "col").collect()] == [(2, 3, True)]

    changed = X.apply_scenarios(cells, ["base", "high"], W.scan_overrides(found)).filter("overridden").collect()
    assert {(r.scenario, r.row, r.col, r.v_num, r.v_str) for r in changed} == {("high", 1, 2, 20.0, None), ("high", 1, 1, None, "text")}

    hit = R.rules_for_cells(cells, W.scan_ranges(found, "rule").select("book", "sheet", "rule_id", "min_col", "min_row", "max_col", "max_row"))
    assert {(r.row, r.col) for r in hit.collect()} == {(1, 1), (2, 1)}
    check = W.scan_ranges(found, "validation").first()
    assert (check["name"], check["operator"], check["first"], check["second"], check["on"], check["max_row"]) == ("whole", "between", "1", "9", True, 9)

    filters = {(r["name"], r["operator"], r["first"], r["idx"], r["on"]) for r in found.filter("kind = 'filter'").collect()}
    assert filters == {("value", "equal", "x", 0, False), ("date", "month", "2024-5", 0, False), ("custom", "greaterThan", "3", 1, True), ("custom", "lessThan", "9", 1, True)}
    assert [(r["ref"], r["on"]) for r in found.filter("kind = 'sort'").collect()] == [("B2:B5", True)]
    made = {r["kind"]: r for r in found.filter("kind in ('array', 'data_table')").collect()}
    assert made["array"]["operator"] == "=B1:B2*2" and made["array"]["ref"] == "A3:A4"
    assert (made["data_table"]["first"], made["data_table"]["second"], made["data_table"]["on"]) == ("A1", "B1", True)


def _copy(source: str, target: str, changes: dict) -> None:
    with zipfile.ZipFile(source) as a, zipfile.ZipFile(target, "w") as b:
        for n in a.namelist():
            b.writestr(n, changes.get(n, a.read(n)))


@pytest.fixture
def damaged(archive):
    """A good book beside files that break in every way a reader may meet."""
    good = f"{archive}/book.xlsx"
    whole = open(good, "rb").read()
    sheet = "xl/worksheets/sheet1.xml"
    text = zipfile.ZipFile(good).read(sheet).decode()
    open(f"{archive}/empty.xlsx", "wb").close()
    open(f"{archive}/four.xlsx", "wb").write(b"PK\x03\x04")
    open(f"{archive}/half.xlsx", "wb").write(whole[: len(whole) // 2])
    _copy(good, f"{archive}/place.xlsx", {sheet: text.replace('r="A7"', 'r="??"')})
    _copy(good, f"{archive}/string.xlsx", {sheet: text.replace("<v>1</v></c><c t=\"inlineStr\"", "<v>99</v></c><c t=\"inlineStr\"")})
    _copy(good, f"{archive}/torn.xlsx", {sheet: text[: text.index('<row r="7">')]})
    secret = bytearray(whole)
    with zipfile.ZipFile(good) as z:
        at = z.getinfo("xl/workbook.xml").header_offset
    secret[at + 6] |= 1  # the member says it is encrypted
    where = whole.rindex(b"xl/workbook.xml") - 46
    secret[where + 8] |= 1
    open(f"{archive}/secret.xlsx", "wb").write(secret)
    corrupt = bytearray(whole)
    body = whole.index(b"<sst")
    corrupt[body : body + 4] = b"\0\1\2\3"  # the checksum no longer fits
    open(f"{archive}/sum.xlsx", "wb").write(corrupt)
    return archive


def test_every_scan_goes_on_beside_damaged_files(spark, damaged):
    cells = W.scan_workbooks(spark, damaged, data_only=True).collect()
    bad = {r.book: r.err for r in cells if r.row is None}
    unreadable = {"empty.xlsx", "four.xlsx", "half.xlsx", "secret.xlsx", "sum.xlsx"}
    torn = {"place.xlsx", "string.xlsx", "torn.xlsx"}
    assert set(bad) == unreadable | torn and all(e.startswith("unreadable: ") for e in bad.values())
    assert sum(r.book == "book.xlsx" and r.sheet == "one" for r in cells) == 11
    marked = W.mark_torn(W.scan_workbooks(spark, damaged, data_only=True)).filter("row is not null").collect()
    assert {r.book for r in marked if r.torn} == {"place.xlsx", "torn.xlsx"} and {r.book for r in marked if not r.torn} == {"book.xlsx"}
    closed = {"empty.xlsx", "four.xlsx", "half.xlsx", "secret.xlsx"}
    for scan, column in ((W.scan_catalogue, "state"), (W.scan_properties, "kind"), (W.scan_parts, "kind"), (W.scan_declared, "kind")):
        rows = scan(spark, damaged).collect()
        assert {r.book for r in rows if r[column] == "unreadable"} >= closed, scan
        assert any(r.book == "book.xlsx" and r[column] != "unreadable" for r in rows) or scan is W.scan_declared
    names = W.scan_names(spark, damaged).collect()
    assert {r.book for r in names if r.name is None} == closed and sum(r.name == "all" for r in names if r.book == "book.xlsx") == 2
    assert {r.linked_from for r in W.scan_external(spark, damaged).filter("err is not null").collect()} == closed


def formatted(df):
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


def test_typing_stays_in_generated_code(spark, archive):
    tree = formatted(W.scan_workbooks(spark, archive)).split("\n\n")[0].split("\n")[1:]
    assert all("* Project" in line or "BatchScan" in line for line in tree), tree


def test_filters_reach_the_reader(spark, archive):
    _copy(f"{archive}/book.xlsx", f"{archive}/other.xlsx", {})
    W.register(spark, push=True)
    read = spark.read.format("workbook").option("push", "true").load(archive)
    some = read.filter((F.col("book") == "book.xlsx") & (F.col("sheet") == "one") & (F.col("row") >= 4) & (F.col("row") < 7) & (F.col("col") > 1))
    plan = formatted(some)
    pushed = next(line for line in plan.split("\n") if line.startswith("PushedFilters"))
    assert all(f in pushed for f in ("EqualTo(book,book.xlsx)", "EqualTo(sheet,one)", "GreaterThanOrEqual(row,4)", "LessThan(row,7)", "GreaterThan(col,1)"))
    assert "Filter (" not in plan
    assert sorted((r.row, r.col) for r in some.collect()) == [(4, 2), (4, 3), (4, 4), (4, 5)]
    assert spark.read.format("workbook").options(part="names", push="true").load(archive).filter("book = 'other.xlsx'").count() == 2
    # scans do not push, so their DataFrames can be filtered in several ways
    cells = W.scan_workbooks(spark, archive)
    first = cells.filter("sheet = 'one' and row = 1 and book <> 'x'")
    assert sorted((r.book, r.col) for r in first.collect()) == [(b, c) for b in ("book.xlsx", "other.xlsx") for c in (1, 2, 3)]
    assert cells.filter("book = 'other.xlsx'").unionByName(first).count() == 22 + 6 and cells.count() == 44
    asked = W.scan_workbooks(spark, archive, sheets=["one"], books=["other.xlsx"], min_row=4, max_row=5)
    assert {(r.book, r.sheet, r.row) for r in asked.collect()} == {("other.xlsx", "one", 4), ("other.xlsx", "one", 5)}


def test_what_filters_rule_out_is_not_opened(archive, monkeypatch):
    from pyspark.sql import datasource as ds

    from gridspark.sources import files, ooxml

    for n in range(3):
        _copy(f"{archive}/book.xlsx", f"{archive}/b{n}.xlsx", {})
    opened, sheets, rows = [], [], []
    open_file, raw_cells = files.open_file, ooxml.Workbook.raw_cells
    monkeypatch.setattr(files, "open_file", lambda uri: opened.append(uri) or open_file(uri))

    def counted(self, member, strings, max_row=None):
        sheets.append(member)
        for r in raw_cells(self, member, strings, max_row):
            rows.append(r[0])
            yield r

    monkeypatch.setattr(ooxml.Workbook, "raw_cells", counted)
    reader = W.PushingReader({"path": archive})
    left = list(reader.pushFilters([ds.In(("book",), ("b1.xlsx", "b2.xlsx")), ds.EqualTo(("sheet",), "one"), ds.LessThanOrEqual(("row",), 1), ds.EqualTo(("t",), "n")]))
    assert left == [ds.EqualTo(("t",), "n")]
    got = [b for p in reader.partitions() for b in reader.read(p)]
    assert len(opened) == 2 and len(sheets) == 2 and set(rows) == {1} and sum(b.num_rows for b in got) == 6
    none = W.PushingReader({"path": archive})
    assert list(none.pushFilters([ds.EqualTo(("sheet",), "no such")])) == []
    assert [b for p in none.partitions() for b in none.read(p)] == [] and len(sheets) == 2


def test_files_are_dealt_by_size(tmp_path):
    from gridspark.sources import files

    for n in range(100):
        (tmp_path / f"f{n}.xlsx").write_bytes(b"x" * (n * 1000))
    (tmp_path / "_half.xlsx").write_bytes(b"x")
    (tmp_path / "sub dir").mkdir()
    (tmp_path / "sub dir" / "ä%20.XLSX").write_bytes(b"x")
    parts = W.WorkbookReader({"path": str(tmp_path)}).partitions()
    assert len(parts) == W.LEAST_PARTITIONS and sum(len(p.uris) for p in parts) == 101
    assert {W.book_name(u, str(tmp_path)) for p in parts for u in p.uris} >= {"f0.xlsx", "sub dir/ä%20.XLSX"}
    assert len(files.list_files(f"{tmp_path}/f?.xlsx")) == 10 and len(files.list_files(f"{tmp_path}/{{sub*,none}}")) == 1
    with pytest.raises(FileNotFoundError):
        files.list_files(f"{tmp_path}/none")


def test_format_classes_agree(spark):
    from gridspark.functions import scalars as S
    from gridspark.sources import ooxml

    codes = [None, "", "General", "0.00", "yyyy-mm-dd", "h:mm", "[h]:mm", "d/m/yy h:mm", '"day"0', '0"d', "[Red]0", "[Red]d", "\\d0", "_d0", "0;yyyy", "mmm", "[$-409]d", "[d", 'a"b"c"d', "ss.0", "AM/PM", *S.BUILTIN_FORMATS.values()]
    rows = spark.createDataFrame([(c,) for c in codes], "c string").select(S.classify_format(F.col("c")).alias("k")).collect()
    assert [r.k for r in rows] == [ooxml.format_class(c) for c in codes]


def test_a_failed_write_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "out")
    W.write_workbooks(spark.range(100).selectExpr("id", "id % 10 as k"), path, "k", ["id"], block_of("id"))
    before = {p.name: p.read_bytes() for p in (tmp_path / "out").iterdir()}
    assert set(before) == {f"{k}.xlsx" for k in range(10)}
    bad = spark.range(100).selectExpr("id", "id % 20 as k", "CASE WHEN id = 99 THEN char(1) ELSE 'x' END AS t")
    with pytest.raises(Exception, match="control characters"):
        W.write_workbooks(bad, path, "k", ["id"], block_of("id"))
    assert {p.name: p.read_bytes() for p in (tmp_path / "out").iterdir()} == before
    W.write_workbooks(bad.filter("id < 99"), path, "k", ["id"], block_of("id"))
    after = {p.name: p.read_bytes() for p in (tmp_path / "out").iterdir()}
    assert set(after) == {f"{k}.xlsx" for k in range(20)} and all(after[n] != before[n] for n in before)


def test_moves_go_on_where_they_stopped(spark, tmp_path):
    path = str(tmp_path)
    rows = spark.range(6).selectExpr("id", "concat('b', id) as __file")
    W.register(spark)
    rows.coalesce(1).write.format("workbook").mode("append").options(path=path, job="j", moves="job").save()
    assert [p.name for p in tmp_path.iterdir()] == ["_job-j"]
    assert spark.read.format("workbook").load(path).count() == 0  # staged files are not read
    from gridspark.sources import files

    lines = [json.loads(x) for x in (tmp_path / "_job-j" / "places.txt").read_text().split()]
    W.move_file(*files.filesystem(path), "j", lines[0])
    W.take_places(spark, path, "j")
    assert sorted(p.name for p in tmp_path.iterdir()) == [f"b{i}.xlsx" for i in range(6)]
    rows.write.format("workbook").mode("append").options(path=path).save()  # without a second job
    assert sorted(p.name for p in tmp_path.iterdir()) == [f"b{i}.xlsx" for i in range(6)]


def test_rich_text_arrays_and_pivot_caches(spark, archive, damaged):
    got = {(r.book, r.row, r.col): [tuple(x) for x in r.runs] for r in W.scan_rich(spark, damaged).filter("sheet = 'one' or row is null").collect()}
    assert got["book.xlsx", 1, 1] == [(None, "o"), (None, "ne_")] and got["book.xlsx", 1, 2] == [(None, "ri"), (None, "ch")]
    assert {k[0] for k, v in got.items() if k[1] is None and v[0][0] == "unreadable"} >= {"empty.xlsx", "four.xlsx", "secret.xlsx"}
    assert not any(k[2] == 3 for k in got)  # plain cells have no runs
    book = f"{archive}/caches.xlsx"
    defs = f'<pivotCacheDefinition {MAIN}><cacheFields><cacheField name="a"><sharedItems><s v="x"/><m/><n v="2"/></sharedItems></cacheField><cacheField name="b"/></cacheFields></pivotCacheDefinition>'
    link = lambda i, kind, at: f'<Relationship Id="rId{i}" Type="{OFFICE}/{kind}" Target="{at}"/>'
    parts = {
        "_rels/.rels": RELS + link(1, "officeDocument", "xl/workbook.xml") + "</Relationships>",
        "xl/workbook.xml": f"<workbook {MAIN}><sheets/></workbook>",
        "xl/_rels/workbook.xml.rels": RELS + link(1, "pivotCacheDefinition", "c/d1.xml") + link(2, "pivotCacheDefinition", "c/d2.xml") + "</Relationships>",
        "xl/c/d1.xml": defs, "xl/c/d2.xml": defs, "xl/c/_rels/d1.xml.rels": RELS + link(1, "pivotCacheRecords", "r1.xml") + "</Relationships>",
        "xl/c/r1.xml": f'<pivotCacheRecords {MAIN}><r><x v="0"/><s v="p"/></r><r><x v="1"/><m/></r><r><x v="2"/><n v="7"/></r><r><m/><b v="1"/></r></pivotCacheRecords>',
    }
    with zipfile.ZipFile(book, "w") as z:
        for name, body in parts.items():
            z.writestr(name, body)
    records, items, fields = W.scan_pivot_caches(spark, book)
    out = G.decode_pivot_cache(records, items, {0: "a", 1: "b"}).orderBy("rec").collect()
    assert [tuple(r) for r in out] == [("caches.xlsx/d1", 0, "x", "p"), ("caches.xlsx/d1", 1, None, None), ("caches.xlsx/d1", 2, "2", "7"), ("caches.xlsx/d1", 3, None, "1")]
    assert sorted(map(tuple, fields.collect())) == [(f"caches.xlsx/{d}", i, n) for d in ("d1", "d2") for i, n in ((0, "a"), (1, "b"))]


def test_array_formulas_cover_their_range(spark, tmp_path):
    from gridspark.operators import formulas as E
    from gridspark.sources import ooxml

    with open(tmp_path / "b.xlsx", "wb") as out:
        sheet = ooxml.SheetWriter(out, "s")
        sheet.append([1, {"formula": "=A1:A3*2", "value": 2, "ref": "B1:B3"}, "free"])
        sheet.append([2, 4])
        sheet.append([3, 6, {"formula": "=SUM(A1:A3)", "value": 6, "ref": "C3"}])
        sheet.close()
    cells = W.scan_workbooks(spark, str(tmp_path), data_only=True)
    got = E.spread_arrays(cells, W.scan_arrays(W.scan_declared(spark, str(tmp_path)))).collect()
    assert {(r.row, r.col): (r.array_formula, r.array_ref, r.anchor, r.v_num) for r in got if r.array_formula} == {
        (1, 2): ("=A1:A3*2", "B1:B3", True, 2.0), (2, 2): ("=A1:A3*2", "B1:B3", False, 4.0), (3, 2): ("=A1:A3*2", "B1:B3", False, 6.0), (3, 3): ("=SUM(A1:A3)", "C3", True, 6.0)}
    assert len(got) == 8
