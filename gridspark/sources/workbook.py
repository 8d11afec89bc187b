"""Workbooks as a source and a sink, format ``workbook``.

The reader lists files once, deals them by size to input partitions and never loads a file whole: a task opens its
files in place and streams the wanted members as Arrow batches. Files, sheets and rows that are not wanted are not
opened or not parsed. Whatever is wrong with a file ends as a row with its reason, never as the end of the job. Typing is
done on the JVM side.

``spark.read.format("workbook").option("push", "true")`` takes filters on ``book``, ``sheet``, ``row`` and ``col`` into the
reader once ``register(spark, push=True)`` has allowed it. Spark 4.1 keeps what was pushed with the loaded source, so two filters over one
loaded DataFrame would share the first one's rows: load once per filter. The ``scan_`` functions
therefore leave filters to Spark and take what is wanted as arguments.
"""

from __future__ import annotations

import heapq
import json
import re
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from urllib.parse import unquote

from pyarrow.fs import FileType
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import datasource as ds
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from gridspark.functions import coords as C
from gridspark.functions import formula_text
from gridspark.functions import scalars as S
from gridspark.operators import typing as typing_ops
from gridspark.operators.grid import CELLS, value_mode
from gridspark.scale import running, salted_join, spread
from gridspark.sources import files, ooxml

# File types that hold a readable workbook, and the row limit of a sheet.
EXTENSIONS = ("xlsx", "xlsm", "xltx", "xltm")
MAX_ROWS = 1048576
BATCH = 20000
PARTITION_BYTES, LEAST_PARTITIONS = 8 << 20, 32

_RAW = (
    "book string, sheet string, row int, col int, t string, v string, formula string, si int, "
    "style_id int, style_class string, epoch int"
)
_CATALOGUE = "book string, sheet string, idx int, state string, kind string"
_PROPERTIES = "book string, kind string, name string, value string"
_NAMES = "book string, name string, scope string, target string"
_PARTS = "book string, sheet string, kind string, ref string, name string, text string, header_rows int, totals_rows int"
_DECLARED = "book string, sheet string, kind string, ref string, name string, operator string, first string, second string, idx int, level int, flags string, on_ string"
_RICH = "book string, sheet string, row int, col int, runs string"
_PIVOT_ITEMS = "book string, cache string, field int, name string, idx int, kind string, v string"
_PIVOT_RECORDS = "book string, cache string, rec int, items string"
_EXTERNAL = "book string, sheet string, row int, col int, t string, v string, linked_from string"


def _arrow_schema(ddl: str):
    import pyarrow as pa

    kinds = {"string": pa.string(), "int": pa.int32()}
    fields = [f.strip().split(" ") for f in ddl.split(",")]
    return pa.schema([(n, kinds[t]) for n, t in fields])


def book_name(uri: str, root: str) -> str:
    """Path of a file below the folder that is scanned, so equal names in two folders are two books.

    ``root`` may hold wildcards: what follows its last folder without one counts.
    """
    bare = lambda u: re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "", u)
    steps = bare(root).rstrip("/").split("/")
    fixed = "/".join(steps[: next((i for i, s in enumerate(steps) if re.search(r"[*?\[{]", s)), len(steps))])
    path = unquote(bare(uri))
    inside = path[path.find(fixed) + len(fixed) :] if fixed and fixed in path else path
    return inside.lstrip("/") or path.rsplit("/", 1)[-1]


def refuse_others(path: str) -> None:
    """A single file of another type is a mistake of the caller."""
    last = path.rstrip("/").rsplit("/", 1)[-1]
    if "." in last and "*" not in last and last.rsplit(".", 1)[-1].lower() not in EXTENSIONS:
        raise ValueError(f"not a workbook: {path} (one of {', '.join(EXTENSIONS)})")


class Wanted:
    """Conditions on columns that a reader has taken over: allowed values, least and greatest ones, non-null columns."""

    def __init__(self):
        self.allowed: dict[str, set] = {}
        self.least: dict[str, int] = {}
        self.most: dict[str, int] = {}
        self.present: set[str] = set()

    def take(self, f: ds.Filter, columns: dict[str, str]) -> bool:
        """Take over one filter; False if Spark has to check it."""
        name = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
        if name not in columns:
            return False
        if isinstance(f, ds.IsNotNull):
            self.present.add(name)
        elif isinstance(f, (ds.EqualTo, ds.In)):
            values = {f.value} if isinstance(f, ds.EqualTo) else set(f.value)
            self.allowed[name] = self.allowed.get(name, values) & values
        elif columns[name] == "int" and isinstance(f, (ds.GreaterThan, ds.GreaterThanOrEqual)):
            low = f.value + isinstance(f, ds.GreaterThan)
            self.least[name] = max(self.least.get(name, low), low)
        elif columns[name] == "int" and isinstance(f, (ds.LessThan, ds.LessThanOrEqual)):
            high = f.value - isinstance(f, ds.LessThan)
            self.most[name] = min(self.most.get(name, high), high)
        else:
            return False
        return True

    def admits(self, name: str, value) -> bool:
        if value is None:
            return not (name in self.present or name in self.allowed or name in self.least or name in self.most)
        return (
            (name not in self.allowed or value in self.allowed[name])
            and (name not in self.least or value >= self.least[name])
            and (name not in self.most or value <= self.most[name])
        )

    def both(self, other: Wanted) -> Wanted:
        out = Wanted()
        for w in (self, other):
            out.present |= w.present
            for n, values in w.allowed.items():
                out.allowed[n] = out.allowed.get(n, values) & values
            for n, v in w.least.items():
                out.least[n] = max(out.least.get(n, v), v)
            for n, v in w.most.items():
                out.most[n] = min(out.most.get(n, v), v)
        return out

    def checks(self) -> list[str]:
        return sorted({*self.allowed, *self.least, *self.most, *self.present})


@dataclass
class Part:
    """A kind of rows that workbooks hold.

    ``rows(book, workbook, wanted)`` yields tuples in the order of ``ddl``, ``broken(book, reason)`` is the row of a file
    that cannot be read on.
    """

    ddl: str
    rows: Callable
    broken: Callable


def reason(e: Exception) -> str:
    return f"unreadable: {type(e).__name__}: {e}"


def _cell_rows(book: str, wb, wanted: Wanted) -> Iterator[tuple]:
    """Stored cells; what breaks off in a sheet is told in a row of its own and the next sheet is read."""
    sheets = [s for s in wb.worksheets(None) if wanted.admits("sheet", s[0])]
    strings = wb.strings() if sheets else []
    classes = [ooxml.format_class(c) for c in wb.style_codes()] if sheets else []
    low, high = wanted.least.get("row", 0), wanted.most.get("row")
    if "row" in wanted.allowed:
        low, high = max(low, min(wanted.allowed["row"], default=1)), min([*([high] if high is not None else []), max(wanted.allowed["row"], default=0)])
    cols = wanted.allowed.get("col")
    for sheet, member in sheets:
        masters: dict[int, tuple[str, int, int]] = {}
        try:
            for row, col, t, v, formula, si, style in wb.raw_cells(member, strings, high):
                if si is not None:
                    if formula is not None:
                        masters[si] = formula, row, col
                    elif si in masters:
                        text, top, left = masters[si]
                        formula = formula_text.shift_formula(text, row - top, col - left)
                if row >= low and (cols is None or col in cols):
                    yield book, sheet, row, col, t, v, formula, si, style, classes[style] if style < len(classes) else "number", wb.epoch
        except Exception as e:  # noqa: BLE001 a damaged sheet is data, not a fault of the job
            yield book, sheet, None, None, "e", reason(e), None, None, None, None, None


def _rich_rows(book: str, wb, wanted: Wanted) -> Iterator[tuple]:
    strings = wb.strings(ooxml.runs_of)
    for sheet, member in wb.worksheets(None):
        if wanted.admits("sheet", sheet):
            for r in wb.rich_cells(member, strings, wanted.most.get("row")):
                yield (book, sheet, *r)


def _sheet_rows(of: Callable) -> Callable:
    """Rows of the parts of every wanted sheet."""

    def rows(book: str, wb, wanted: Wanted) -> Iterator[tuple]:
        for sheet, member in wb.worksheets(None):
            if wanted.admits("sheet", sheet):
                for r in of(wb, member):
                    yield (book, sheet, *r)

    return rows


def _declared_rows(wb, member: str) -> Iterator[tuple]:
    for *item, on in wb.declared(member):
        yield (*item, str(on).lower())


def _book_rows(of: Callable) -> Callable:
    return lambda book, wb, wanted: ((book, *r) for r in of(wb))


PARTS = {
    "cells": Part(_RAW, _cell_rows, lambda book, why: (book, None, None, None, "e", why, None, None, None, None, None)),
    "catalogue": Part(_CATALOGUE, _book_rows(lambda wb: wb.catalogue()), lambda book, why: (book, None, None, "unreadable", why)),
    "properties": Part(_PROPERTIES, _book_rows(lambda wb: wb.properties()), lambda book, why: (book, "unreadable", None, why)),
    "names": Part(_NAMES, _book_rows(lambda wb: wb.names()), lambda book, why: (book, None, None, why)),
    "parts": Part(_PARTS, _sheet_rows(lambda wb, m: wb.sheet_parts(m)), lambda book, why: (book, None, "unreadable", None, None, why, None, None)),
    "declared": Part(_DECLARED, _sheet_rows(_declared_rows), lambda book, why: (book, None, "unreadable", None, None, None, why, None, None, None, None, "false")),
    "rich": Part(_RICH, _rich_rows, lambda book, why: (book, None, None, None, json.dumps([["unreadable", why]]))),
    "pivot_items": Part(_PIVOT_ITEMS, _book_rows(lambda wb: wb.pivot_items()), lambda book, why: (book, None, None, None, None, "unreadable", why)),
    "pivot_records": Part(_PIVOT_RECORDS, _book_rows(lambda wb: wb.pivot_records()), lambda book, why: (book, None, None, json.dumps([["unreadable", why]]))),
    "external": Part(_EXTERNAL, lambda book, wb, wanted: ((*r, book) for r in wb.external_cells()), lambda book, why: (None, None, None, None, "e", why, book)),
}


class Files(InputPartition):
    def __init__(self, uris: list[str]):
        super().__init__(len(uris))
        self.uris = uris


class WorkbookReader(DataSourceReader):
    """Options: ``path``, ``part`` (see ``PARTS``), ``books``, ``sheets`` and ``cols`` (one by line), ``min_row``, ``max_row``, ``push``.

    Unlike a filter, the options leave the rows of unreadable files in.
    """

    def __init__(self, options):
        self.root, self.part = options["path"], options.get("part", "cells")
        fields = [f.strip().split(" ") for f in PARTS[self.part].ddl.split(",")]
        self.columns = dict(fields)
        self.wanted = Wanted()  # by pushed filters: rows are checked against them
        self.asked = Wanted()  # by options
        for name, key in (("book", "books"), ("sheet", "sheets")):
            if options.get(key):
                self.asked.allowed[name] = set(options[key].split("\n"))
        if options.get("cols"):
            self.asked.allowed["col"] = {int(c) for c in options["cols"].split("\n")}
        if options.get("min_row"):
            self.asked.least["row"] = int(options["min_row"])
        if options.get("max_row"):
            self.asked.most["row"] = int(options["max_row"])

    def partitions(self):
        refuse_others(self.root)
        file_column = "linked_from" if self.part == "external" else "book"
        wanted = self.wanted.both(self.asked)
        found = [
            (uri, size) for uri, size in files.list_files(self.root)
            if uri.rsplit(".", 1)[-1].lower() in EXTENSIONS and wanted.admits(file_column, book_name(uri, self.root))
        ]
        total = sum(size for _, size in found)
        n = max(-(-total // PARTITION_BYTES), min(len(found), LEAST_PARTITIONS))
        bins: list[tuple[int, int, list[str]]] = [(0, i, []) for i in range(n)]
        for uri, size in sorted(found, key=lambda f: -f[1]):  # the largest first, each to the lightest partition
            held, i, uris = heapq.heappop(bins)
            uris.append(uri)
            heapq.heappush(bins, (held + size + 4096, i, uris))
        return [Files(sorted(uris)) for _, _, uris in bins if uris] or [Files([])]

    def rows_of(self, uri: str) -> Iterator[tuple]:
        part, name, wanted = PARTS[self.part], book_name(uri, self.root), self.wanted.both(self.asked)
        try:
            with files.open_file(uri) as handle:
                yield from part.rows(name, ooxml.Workbook(handle), wanted)
        except Exception as e:  # noqa: BLE001 whatever a file holds, the job goes on
            yield part.broken(name, reason(e))

    def read(self, partition):
        import pyarrow as pa

        schema = _arrow_schema(PARTS[self.part].ddl)
        checks = [(schema.get_field_index(c), c) for c in self.wanted.checks()]
        admits = self.wanted.admits

        def column(values: tuple, kind):
            # most columns say the same in every row of a batch
            if values.count(values[0]) == len(values):
                return pa.repeat(pa.scalar(values[0], kind), len(values))
            return pa.array(values, kind)

        def batch(rows: list):
            return pa.RecordBatch.from_arrays([column(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

        rows: list[tuple] = []
        for uri in partition.uris:
            for r in self.rows_of(uri):
                if checks and not all(admits(c, r[i]) for i, c in checks):
                    continue
                rows.append(r)
                if len(rows) >= BATCH:
                    yield batch(rows)
                    rows = []
        if rows:
            yield batch(rows)


class PushingReader(WorkbookReader):
    """Takes over filters on books, sheets and places; Spark lets such a reader in only where pushing is allowed."""

    def pushFilters(self, filters):
        pushable = {c: t for c, t in self.columns.items() if c in ("book", "sheet", "row", "col", "linked_from")}
        for f in filters:
            if not self.wanted.take(f, pushable):
                yield f


def register(spark: SparkSession, push: bool = False) -> None:
    """Make format ``workbook`` known to a session; ``push`` allows filters to be pushed into it."""
    spark.dataSource.register(WorkbookDataSource)
    if push:
        spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def scan_part(spark: SparkSession, path: str, part: str, **options: str) -> DataFrame:
    """Rows of one kind (see ``PARTS``) of every workbook under ``path``."""
    refuse_others(path)
    register(spark)
    return spark.read.format("workbook").options(part=part, **options).load(path)


def scan_raw(
    spark: SparkSession, path: str, sheets: list[str] | None = None, max_row: int | None = None, min_row: int | None = None, books: list[str] | None = None,
    cols: list[int] | None = None,
) -> DataFrame:
    """Stored cells of every workbook under ``path``; unwanted books, sheets and rows are never parsed, cells of other columns than ``cols`` not passed on."""
    asked = {"cols": cols and "\n".join(map(str, cols)), "sheets": sheets and "\n".join(sheets), "books": books and "\n".join(books), "min_row": min_row, "max_row": max_row}
    return scan_part(spark, path, "cells", **{k: str(v) for k, v in asked.items() if v})


def scan_workbooks(
    spark: SparkSession, path: str, data_only: bool = False, sheets: list[str] | None = None, max_row: int | None = None,
    min_row: int | None = None, books: list[str] | None = None, cols: list[int] | None = None,
) -> DataFrame:
    """A folder of workbooks as typed cells, with cached values or with formulas in their place.

    Shared formulas are spelled out while their sheet streams by, which saves reading the files again for a
    join. A file that cannot be read gives one row without a sheet, its reason in ``err``; a sheet that breaks off gives
    the cells before the break and a row of its own without a place (``mark_torn``).
    """
    typed = typing_ops.type_cells(scan_raw(spark, path, sheets, max_row, min_row, books, cols), epoch=F.col("epoch"))
    kept = value_mode(typed, data_only)
    return kept.select(*CELLS)


def mark_torn(cells: DataFrame) -> DataFrame:
    """``cells`` with ``torn``: whether their sheet could be read in part only."""
    torn = cells.filter(F.col("row").isNull() & F.col("sheet").isNotNull() & F.col("err").startswith("unreadable: ")).select("book", "sheet").distinct()
    met = salted_join(cells, torn.withColumn("torn", F.lit(True)), ["book", "sheet"])
    return met.withColumn("torn", F.coalesce("torn", F.lit(False))).select(*cells.columns, "torn")


def scan_catalogue(spark: SparkSession, path: str) -> DataFrame:
    """Sheets of every workbook in order, with their state; an unreadable file has state ``unreadable`` and its reason as kind."""
    return scan_part(spark, path, "catalogue")


def scan_properties(spark: SparkSession, path: str) -> DataFrame:
    """Document and custom properties of every workbook; kind ``unreadable`` with the reason as value."""
    return scan_part(spark, path, "properties")


def scan_names(spark: SparkSession, path: str) -> DataFrame:
    """Defined names with their scope, as ``resolve_names`` takes them; an unreadable file has no name, its reason as target."""
    return scan_part(spark, path, "names")


def scan_parts(spark: SparkSession, path: str) -> DataFrame:
    """Merges, links, tables and comments of every sheet; kind ``unreadable`` with the reason as text."""
    return scan_part(spark, path, "parts")


def scan_declared(spark: SparkSession, path: str) -> DataFrame:
    """What sheets declare: filters and sorts, validations, conditional rules, scenarios, outlines, array formulas.

    One row per item: (book, sheet, kind, ref, name, operator, first, second, idx, level, flags, on). ``scan_outlines``,
    ``scan_overrides`` and ``scan_ranges`` give them the shape that ``outline``, ``apply_scenarios`` and
    ``rules_for_cells`` take, ``operators.declared`` evaluates them. An unreadable file is of kind ``unreadable`` with its reason as ``first``.
    """
    return scan_part(spark, path, "declared").withColumn("on", F.col("on_").cast("boolean")).drop("on_")


def scan_outlines(declared: DataFrame, axis: str = "row") -> DataFrame:
    """Outline groups (book, sheet, start, end, level, hidden) of rows or columns."""
    lines = declared.filter(F.col("kind") == f"outline_{axis}")
    return lines.select("book", "sheet", F.col("first").cast("int").alias("start"), F.col("second").cast("int").alias("end"), "level", F.col("on").alias("hidden"))


def scan_overrides(declared: DataFrame) -> DataFrame:
    """Scenario inputs (scenario, book, sheet, row, col, val)."""
    at = C.range_bounds(F.col("ref"))
    return declared.filter((F.col("kind") == "scenario") & ~F.col("on")).select(
        F.col("name").alias("scenario"), "book", "sheet", at["min_row"].alias("row"), at["min_col"].alias("col"), F.col("first").alias("val")
    )


def scan_ranges(declared: DataFrame, kind: str) -> DataFrame:
    """Rules or validations per range: (book, sheet, rule_id, bounds, name, operator, first, second, on)."""
    items = declared.filter(F.col("kind") == kind).withColumn("rule_id", F.xxhash64("ref", "name", "operator", "first", "second", "idx"))
    one = items.withColumn("__b", F.explode(F.transform(F.split(F.trim("ref"), r"\s+"), C.range_bounds)))
    ends = {"min_col": 1, "min_row": 1, "max_col": C.MAX_COLUMN, "max_row": C.MAX_SHEET_ROW}
    bounds = [F.coalesce(F.col(f"__b.{k}"), F.lit(v)).alias(k) for k, v in ends.items()]
    return one.select("book", "sheet", "rule_id", *bounds, "name", "operator", "first", "second", "idx", "on")


def scan_arrays(declared: DataFrame) -> DataFrame:
    """Array formulas (book, sheet, ref, formula, at) as ``spread_arrays`` takes them."""
    return declared.filter("kind = 'array'").select("book", "sheet", "ref", F.col("operator").alias("formula"), F.col("name").alias("at"))


def scan_rich(spark: SparkSession, path: str) -> DataFrame:
    """Cells with formatted text: (book, sheet, row, col, runs), runs an array of (font, text) from shared and inline strings.

    A font is its properties as ``name=value``, joined by semicolons, NULL without any. An unreadable file gives a row without
    a place whose one run has the font ``unreadable``.
    """
    pairs = F.from_json("runs", "array<array<string>>")
    named = F.transform(pairs, lambda p: F.struct(F.get(p, F.lit(0)).alias("font"), F.get(p, F.lit(1)).alias("text")))
    return scan_part(spark, path, "rich").withColumn("runs", named)


def scan_pivot_caches(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Records, shared items and fields of every pivot cache, as ``decode_pivot_cache`` takes them.

    ``cache`` is book and cache; records (cache, rec, items array<struct(kind, v)>), items (cache, field, idx, v), fields
    (cache, field, name). Records are streamed from their part, in files of any number. An unreadable file has no cache.
    """
    cache = F.when(F.col("cache").isNotNull(), F.concat_ws("/", "book", "cache")).alias("cache")
    raw = scan_part(spark, path, "pivot_records")
    pairs = F.from_json("items", "array<array<string>>")
    records = raw.select(cache, "rec", F.transform(pairs, lambda p: F.struct(F.get(p, F.lit(0)).alias("kind"), F.get(p, F.lit(1)).alias("v"))).alias("items"))
    told = scan_part(spark, path, "pivot_items").select(cache, "field", "name", "idx", "kind", "v")
    items = told.filter("idx is not null and kind <> 'm'").select("cache", "field", "idx", "v")
    return records, items, told.filter("idx is null").select("cache", "field", "name")


def scan_external(spark: SparkSession, path: str) -> DataFrame:
    """Cells cached from linked workbooks; ``book`` is the linked file. An unreadable file gives a row with its reason in ``err``."""
    raw = scan_part(spark, path, "external")
    ready = raw.withColumns({"formula": F.lit(None).cast("string"), "style_class": F.lit("number"), "style_id": F.lit(0)})
    return typing_ops.type_cells(ready).select(*CELLS, "linked_from")


# --- sink ------------------------------------------------------------------------


class _Committed(WriterCommitMessage):
    """What one task attempt has staged: its folder and the names of its files."""

    def __init__(self, attempt: str, names: list[str]):
        self.attempt, self.names = attempt, names


class WorkbookWriter(DataSourceArrowWriter):
    """Files are staged below a folder of the job and take their places only once every task is done.

    Tasks write whole files to ``_job-<id>/<attempt>/`` below the path and report their names. The commit moves
    those of the attempts that count; with option ``moves=job`` it leaves a list of them for ``take_places``. An abort
    removes the folder of the job, so a failed write changes nothing under the path.
    """

    def __init__(self, options, schema):
        self.path = options["path"].rstrip("/")
        self.title = options.get("sheet", "Sheet1")
        self.header = options.get("header", "true") == "true"
        self.job = options.get("job") or uuid.uuid4().hex
        self.moves = options.get("moves", "driver")
        self.columns = [f.name for f in schema.fields if f.name != "__file"]

    def write(self, batches: Iterator):
        from pyspark import TaskContext

        fs, folder = files.filesystem(self.path)
        attempt = f"{TaskContext.get().taskAttemptId()}-{uuid.uuid4().hex}"
        staged, names, sheet, handle = f"{folder}/_job-{self.job}/{attempt}", [], None, None
        fs.create_dir(staged, recursive=True)

        def finish():
            if sheet is not None:
                sheet.close()
                handle.close()

        try:
            for b in batches:
                files_ = b.column(b.schema.get_field_index("__file")).to_pylist()
                columns = [b.column(b.schema.get_field_index(c)).to_pylist() for c in self.columns]
                for name, values in zip(files_, zip(*columns)):
                    if not names or name != names[-1]:
                        finish()
                        names.append(name)
                        handle = fs.open_output_stream(f"{staged}/{name}.xlsx")
                        sheet = ooxml.SheetWriter(handle, self.title)
                        if self.header:
                            sheet.append(self.columns)
                    sheet.append(values)
            finish()
        except BaseException:
            if handle is not None:
                handle.close()
            raise
        return _Committed(attempt, names)

    def commit(self, messages):
        fs, folder = files.filesystem(self.path)
        lines = (f"{m.attempt}/{n}" for m in messages if m is not None for n in m.names)
        if self.moves == "job":
            fs.create_dir(f"{folder}/_job-{self.job}", recursive=True)
            with fs.open_output_stream(f"{folder}/_job-{self.job}/places.txt") as out:
                for line in lines:
                    out.write(json.dumps(line).encode() + b"\n")
            return
        for line in lines:
            move_file(fs, folder, self.job, line)
        drop_job(fs, folder, self.job)

    def abort(self, messages):
        drop_job(*files.filesystem(self.path), self.job)


def move_file(fs, folder: str, job: str, line: str) -> None:
    """A staged file to its place; one that is there already was moved by an earlier attempt."""
    source, target = f"{folder}/_job-{job}/{line}.xlsx", f"{folder}/{line.split('/', 1)[1]}.xlsx"
    if fs.get_file_info(source).type == FileType.File:
        if fs.get_file_info(target).type == FileType.File:
            fs.delete_file(target)
        fs.move(source, target)


def drop_job(fs, folder: str, job: str) -> None:
    if fs.get_file_info(f"{folder}/_job-{job}").type == FileType.Directory:
        fs.delete_dir(f"{folder}/_job-{job}")


def take_places(spark: SparkSession, path: str, job: str) -> None:
    """Move what a job has staged, spread over tasks; run again, it moves what is left."""

    def run(batches: Iterator) -> Iterator:
        fs, folder = files.filesystem(path)
        for b in batches:
            for line in b.column(0).to_pylist():
                move_file(fs, folder, job, json.loads(line))
            yield b.slice(0, 0)

    staged = spark.read.text(f"{path}/_job-{job}/places.txt")
    spread(staged, "value").mapInArrow(run, "value string").write.format("noop").mode("overwrite").save()
    drop_job(*files.filesystem(path), job)


class WorkbookDataSource(DataSource):
    """Format ``workbook``: reads cells or other parts, writes a workbook per file name."""

    @classmethod
    def name(cls):
        return "workbook"

    def schema(self):
        return PARTS[self.options.get("part", "cells")].ddl

    def reader(self, schema):
        kind = PushingReader if self.options.get("push", "false") == "true" else WorkbookReader
        return kind(self.options)

    def writer(self, schema, overwrite):
        return WorkbookWriter(self.options, schema)


def write_workbooks(
    df: DataFrame, path: str, by: str, order: list[str], block: Column, sheet: str = "Sheet1", header: bool = True, max_rows: int = MAX_ROWS
) -> None:
    """One workbook per value of ``by``, rows in ``order``.

    A sheet holds 1,048,576 rows, so a larger key goes on in ``<key>~2``,
    ``<key>~3`` …: rows are numbered by a blocked scan and every file is a task
    of bounded size. In a key ``~`` is written ``~~`` and ``/`` is written ``~s``; NULL is ``~null``. So no
    two keys share a file. A struct of ``formula`` and ``value`` is written as a formula with its cached value. Zoned timestamps and texts a cell cannot hold are refused, blanks leave no cell. Nothing
    changes under ``path`` unless every file has been written.
    """
    for f in df.schema.fields:
        if isinstance(f.dataType, T.TimestampType):
            raise TypeError(f"column {f.name}: sheets hold no time zones")
        if isinstance(f.dataType, T.StructType) and f.dataType.names == ["formula", "value"]:
            continue
        if not isinstance(f.dataType, (T.NumericType, T.StringType, T.BooleanType, T.DateType, T.TimestampNTZType, T.DayTimeIntervalType)):
            raise ValueError(f"column {f.name}: cannot convert {f.dataType.simpleString()}")
    text = F.col(by).cast("string")
    key = F.coalesce(F.replace(F.replace(text, F.lit("~"), F.lit("~~")), F.lit("/"), F.lit("~s")), F.lit("~null"))
    numbered = running(df.withColumn("__key", key), ["__key"], order, {"__n": ("row_number", None)}, block)
    part = F.floor((F.col("__n") - 1) / (max_rows - int(header)))
    name = F.when(part == 0, F.col("__key")).otherwise(F.concat("__key", F.lit("~"), part + 1))
    named = numbered.withColumn("__file", name)
    placed = spread(named, "__file").sortWithinPartitions("__file", "__n").drop("__key", "__n")
    register(df.sparkSession)
    path, job = path.rstrip("/"), uuid.uuid4().hex
    placed.write.format("workbook").mode("append").options(path=path, sheet=sheet, header=str(header).lower(), job=job, moves="job").save()
    take_places(df.sparkSession, path, job)
