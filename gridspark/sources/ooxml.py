"""Reading one workbook file member by member, for use inside a task."""

from __future__ import annotations

import datetime as dt
import json
import posixpath
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree as ET

from gridspark.functions.scalars import BUILTIN_FORMATS, DATE_LETTERS, ELAPSED

REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"


def local(tag: str) -> str:
    return tag.rsplit("}", 1)[-1]


def child(el, name: str):
    return next((c for c in el if local(c.tag) == name), None)


def children(el, name: str) -> list:
    return [] if el is None else [c for c in el if local(c.tag) == name]


def attribute(el, name: str, default=None):
    """Attribute by local name, whatever its namespace."""
    for k, v in el.attrib.items():
        if local(k) == name:
            return v
    return default


def place(ref: str) -> tuple[int, int]:
    """``B12`` -> (row, col)."""
    col = 0
    for i, ch in enumerate(ref):
        if ch.isdigit():
            return int(ref[i:]), col
        col = col * 26 + ord(ch.upper()) - 64
    raise ValueError(f"not a cell reference: {ref}")


def text_of(el) -> str:
    """Plain text of a string item: its own text and that of its runs, not phonetic hints."""
    parts = [t.text or "" for t in children(el, "t")]
    for run in children(el, "r"):
        parts += [t.text or "" for t in children(run, "t")]
    return "".join(parts)


class Runs(str):
    """Runs of formatted text as JSON: a list of [font, text]."""


def font_of(run) -> str | None:
    """Properties of a run's font, ``name=value`` in order of their names; None without any."""
    pr = child(run, "rPr")
    told = sorted(f"{local(p.tag)}={p.get('val') or p.get('rgb') or p.get('theme') or '1'}" for p in pr) if pr is not None else []
    return ";".join(told) or None


def runs_of(el) -> Runs | None:
    """The runs of a string item; None for plain text."""
    runs = children(el, "r")
    if not runs:
        return None
    return Runs(json.dumps([[font_of(r), "".join(t.text or "" for t in children(r, "t"))] for r in runs]))


def format_class(code: str | None) -> str:
    """``classify_format`` for one code: date, time, datetime, timedelta or number."""
    first = (code or "").split(";", 1)[0].lower()
    if any(mark in first for mark in ELAPSED):
        return "timedelta"
    pieces = first.split('"')
    shown = "".join(p if i % 2 == 0 else '"' + p if i == len(pieces) - 1 else "" for i, p in enumerate(pieces))
    head, *rest = shown.split("[")
    shown = head + "".join(p.partition("]")[2] if "]" in p else "[" + p for p in rest)
    head, *rest = shown.replace("\\", "_").split("_")
    if not set(DATE_LETTERS) & set(head + "".join(p[1:] for p in rest)):
        return "number"
    has_date, has_time = set("dy") & set(code), set("hs") & set(code)
    return "datetime" if has_date and has_time else "date" if has_date else "time"


class Workbook:
    """Lazy view of an open workbook archive."""

    def __init__(self, handle):
        self.zip = zipfile.ZipFile(handle)
        self.members = set(self.zip.namelist())
        book = next(
            (t for kind, t in self.rels("").values() if kind == "officeDocument"), "xl/workbook.xml"
        )
        self.path = book
        self.book_rels = self.rels(book)
        self.root = self.xml(book)
        pr = child(self.root, "workbookPr")
        on = pr is not None and pr.get("date1904", "0") in ("1", "true", "on")
        self.epoch = 1904 if on else 1900
        self.sheets = []
        for s in children(child(self.root, "sheets"), "sheet"):
            kind, target = self.book_rels.get(s.get(REL + "id") or attribute(s, "id"), (None, None))
            self.sheets.append((s.get("name"), s.get("state", "visible"), kind, target))

    def xml(self, member: str):
        with self.zip.open(member) as f:
            return ET.parse(f).getroot()

    def rels(self, member: str) -> dict[str, tuple[str, str]]:
        """Relationship id -> (kind, target member or address)."""
        folder, name = posixpath.split(member)
        at = posixpath.join(folder, "_rels", f"{name}.rels")
        if at not in self.members:
            return {}
        out = {}
        for r in self.xml(at):
            target = r.get("Target")
            if r.get("TargetMode") != "External":
                target = target.lstrip("/") if target.startswith("/") else posixpath.normpath(posixpath.join(folder, target))
            out[r.get("Id")] = (r.get("Type").rsplit("/", 1)[-1], target)
        return out

    def part(self, kind: str) -> str | None:
        return next((t for k, t in self.book_rels.values() if k == kind and t in self.members), None)

    def strings(self, read=None) -> list:
        """Shared strings as text, or what ``read`` makes of each item."""
        member = self.part("sharedStrings")
        if member is None:
            return []
        out = []
        with self.zip.open(member) as f:
            for _, el in ET.iterparse(f):
                if local(el.tag) == "si":
                    item = (read or text_of)(el)
                    out.append(item and type(item)(item.replace("x005F_", "")))
                    el.clear()
        return out

    def style_codes(self) -> list[str | None]:
        """Number format code of every style; None for a built-in format that has none."""
        member = self.part("styles")
        if member is None:
            return []
        root = self.xml(member)
        custom = {int(n.get("numFmtId")): n.get("formatCode") for n in children(child(root, "numFmts"), "numFmt")}
        ids = [int(x.get("numFmtId", 0)) for x in children(child(root, "cellXfs"), "xf")]
        return [custom.get(i) or BUILTIN_FORMATS.get(i) for i in ids]

    def worksheets(self, wanted: set[str] | None) -> Iterator[tuple[str, str]]:
        for name, _, kind, target in self.sheets:
            if kind == "worksheet" and target in self.members and (wanted is None or name in wanted):
                yield name, target

    def raw_cells(self, member: str, strings: list[str], max_row: int | None = None, inline_text=text_of) -> Iterator[tuple]:
        """(row, col, t, v, formula, si, style) as stored; places may be implied."""
        row, holder, space = 0, None, None
        number: dict[str, int] = {}
        with self.zip.open(member) as f:
            for event, el in ET.iterparse(f, ("start", "end")):
                tag = el.tag
                if event == "start":
                    if space is None:
                        space = tag[: tag.index("}") + 1] if "}" in tag else ""
                        rows, data = space + "row", space + "sheetData"
                        cell, value, formula_tag, inline = (space + n for n in ("c", "v", "f", "is"))
                    elif tag == data:
                        holder = el
                    continue
                if tag == data:
                    return
                if tag != rows or holder is None:
                    continue
                row = int(float(el.get("r"))) if el.get("r") else row + 1
                if max_row is not None and row > max_row:
                    return
                col, at = 0, row
                for c in el:
                    if c.tag != cell:
                        continue
                    ref = c.get("r")
                    if ref:
                        name = ref.rstrip("0123456789")
                        col = number.get(name) or number.setdefault(name, place(ref)[1])
                        at = int(ref[len(name) :])
                    else:
                        col += 1
                    t = c.get("t", "n")
                    v = formula = si = None
                    for part in c:
                        if part.tag == value:
                            v = part.text
                        elif part.tag == inline:
                            v = inline_text(part)
                        elif part.tag == formula_tag:
                            if part.get("t") == "shared":
                                si = int(part.get("si"))
                            if part.text:
                                formula = "=" + part.text
                            elif si is None:
                                formula = "="
                    if t == "s" and v is not None:
                        t, v = "str", strings[int(v)]
                    if v is not None or formula is not None or si is not None:
                        yield at, col, t, v, formula, si, int(c.get("s") or 0)
                row = at
                holder.clear()

    def catalogue(self) -> Iterator[tuple]:
        for i, (name, state, kind, _) in enumerate(self.sheets):
            yield name, i, state, kind

    def properties(self) -> Iterator[tuple[str, str, str]]:
        """(kind, name, value) of document and custom properties."""
        for kind, target in self.rels("").values():
            if target not in self.members:
                continue
            if kind == "core-properties":
                for p in self.xml(target):
                    if p.text:
                        yield "core", local(p.tag), p.text
            elif kind == "custom-properties":
                for p in self.xml(target):
                    yield "custom", p.get("name"), "".join(x.text or "" for x in p)

    def names(self) -> Iterator[tuple]:
        """(name, scope sheet or None, target)."""
        for d in children(child(self.root, "definedNames"), "definedName"):
            at = d.get("localSheetId")
            yield d.get("name"), self.sheets[int(at)][0] if at is not None else None, d.text

    def sheet_parts(self, member: str) -> Iterator[tuple]:
        """(kind, ref, name, text, header rows, totals rows): merges, links, tables, comments."""
        rels = self.rels(member)
        wanted = ("mergeCell", "hyperlink")
        with self.zip.open(member) as f:
            for _, el in ET.iterparse(f):
                tag = local(el.tag)
                if tag in wanted:
                    link = rels.get(attribute(el, "id"), (None, None))[1]
                    kind = "merge" if tag == "mergeCell" else "link"
                    yield kind, el.get("ref"), None, link or el.get("location"), None, None
                elif tag == "row":
                    el.clear()
        for kind, target in rels.values():
            if target not in self.members:
                continue
            if kind == "table":
                t = self.xml(target)
                yield "table", t.get("ref"), t.get("displayName"), None, int(t.get("headerRowCount", 1)), int(t.get("totalsRowCount", 0))
            elif kind == "comments":
                for c in children(child(self.xml(target), "commentList"), "comment"):
                    yield "comment", c.get("ref"), None, text_of(child(c, "text")), None, None

    def declared(self, member: str) -> Iterator[tuple]:
        """(kind, ref, name, operator, first, second, idx, level, flags, on): what a sheet declares about its cells.

        Kinds: ``outline_row``, ``outline_col``, ``array``, ``data_table``, ``filter``, ``sort``, ``validation``,
        ``rule``, ``stop`` (a threshold of the rule with the same ref and idx, its place as level, its colour as second) and
        ``scenario``; the fields that a kind lacks are None.
        """
        for *item, on in self._declared(member):
            flags = item.pop() if len(item) == 9 else None
            yield (*item, flags, on)

    def _declared(self, member: str) -> Iterator[tuple]:
        yes = lambda el, name: el.get(name, "0") in ("1", "true", "on")
        row = 0
        with self.zip.open(member) as f:
            for _, el in ET.iterparse(f):
                tag = local(el.tag)
                if tag == "row":
                    row = int(float(el.get("r"))) if el.get("r") else row + 1
                    if el.get("outlineLevel") or yes(el, "hidden"):
                        yield "outline_row", None, None, None, str(row), str(row), None, int(el.get("outlineLevel") or 0), yes(el, "hidden")
                    for c in el:
                        formula = child(c, "f")
                        if formula is not None and formula.get("t") in ("array", "dataTable"):
                            kind = "array" if formula.get("t") == "array" else "data_table"
                            inputs = formula.get("r1"), formula.get("r2")
                            text = "=" + formula.text if formula.text else None
                            yield kind, formula.get("ref"), c.get("r"), text, *inputs, None, None, yes(formula, "dtr")
                    el.clear()
                elif tag == "col" and (el.get("outlineLevel") or yes(el, "hidden")):
                    yield "outline_col", None, None, None, el.get("min"), el.get("max"), None, int(el.get("outlineLevel") or 0), yes(el, "hidden")
                elif tag == "autoFilter":
                    yield from self._filters(el)
                elif tag == "dataValidation":
                    first, second = (child(el, n) for n in ("formula1", "formula2"))
                    texts = [None if x is None else x.text for x in (first, second)]
                    yield "validation", el.get("sqref"), el.get("type", "none"), el.get("operator", "between"), *texts, None, None, yes(el, "allowBlank")
                elif tag == "conditionalFormatting":
                    for r in children(el, "cfRule"):
                        yield from self._rule(el.get("sqref"), r)
                elif tag == "scenario":
                    for i, c in enumerate(children(el, "inputCells")):
                        yield "scenario", c.get("r"), el.get("name"), None, c.get("val"), None, i, None, yes(c, "deleted")

    @staticmethod
    def _rule(ref: str, r) -> Iterator[tuple]:
        """A conditional rule and its stops.

        Flags: bottom, percent, below, equal, reverse. ``level`` is the number of deviations, ``first`` the text, rank or period
        where the rule has one, else its first formula; of a data bar the shortest and longest length.
        """
        yes = lambda el, name, default="0": el.get(name, default) in ("1", "true", "on")
        kind, priority = r.get("type"), int(r.get("priority") or 0)
        told = [x.text for x in children(r, "formula")]
        told = [r.get("text") or r.get("rank") or r.get("timePeriod") or (told[0] if told else None), told[1] if len(told) > 1 else None]
        flags = [n for n, on in (("bottom", yes(r, "bottom")), ("percent", yes(r, "percent")), ("below", not yes(r, "aboveAverage", "1")), ("equal", yes(r, "equalAverage"))) if on]
        scale = next((c for c in r if local(c.tag) in ("colorScale", "iconSet", "dataBar")), None)
        if scale is not None:
            flags += ["reverse"] if yes(scale, "reverse") else []
            told = [scale.get("minLength"), scale.get("maxLength")]
            colours = [c.get("rgb") for c in children(scale, "color")]
            for i, stop in enumerate(children(scale, "cfvo")):
                colour = colours[i] if i < len(colours) else None
                yield "stop", ref, stop.get("type"), "gte" if yes(stop, "gte", "1") else "gt", stop.get("val"), colour, priority, i, False
        deviations = int(r.get("stdDev")) if r.get("stdDev") else None
        yield "rule", ref, kind, r.get("operator"), *told, priority, deviations, " ".join(flags) or None, yes(r, "stopIfTrue")

    @staticmethod
    def _filters(el) -> Iterator[tuple]:
        ref = el.get("ref")
        for column in children(el, "filterColumn"):
            at = int(column.get("colId"))
            for spec in column:
                kind = local(spec.tag)
                if kind == "filters":
                    if spec.get("blank") in ("1", "true"):
                        yield "filter", ref, "value", "equal", None, None, at, None, False
                    for v in spec:
                        if local(v.tag) == "filter":
                            yield "filter", ref, "value", "equal", v.get("val"), None, at, None, False
                        else:
                            parts = [v.get(n) for n in ("year", "month", "day", "hour", "minute", "second")]
                            yield "filter", ref, "date", v.get("dateTimeGrouping"), "-".join(p for p in parts if p), None, at, None, False
                elif kind == "customFilters":
                    both = spec.get("and", "0") in ("1", "true")
                    for v in spec:
                        yield "filter", ref, "custom", v.get("operator", "equal"), v.get("val"), None, at, None, both
                elif kind == "top10":
                    yield "filter", ref, "top10", "percent" if spec.get("percent") in ("1", "true") else "count", spec.get("val"), spec.get("filterVal"), at, None, spec.get("top", "1") in ("1", "true")
                elif kind == "dynamicFilter":
                    yield "filter", ref, "dynamic", spec.get("type"), spec.get("val"), spec.get("maxVal"), at, None, False
                elif kind == "iconFilter":
                    yield "filter", ref, "icon", spec.get("iconSet"), spec.get("iconId"), None, at, None, False
        sort = child(el, "sortState")
        if sort is not None:
            for i, c in enumerate(children(sort, "sortCondition")):
                yield "sort", c.get("ref"), c.get("sortBy", "value"), None, c.get("customList"), None, i, None, c.get("descending", "0") in ("1", "true")

    def rich_cells(self, member: str, strings: list, max_row: int | None = None) -> Iterator[tuple[int, int, str]]:
        """(row, col, runs) of the cells with formatted text; ``strings`` are ``strings(runs_of)``."""
        for row, col, _, v, *_ in self.raw_cells(member, strings, max_row, runs_of):
            if isinstance(v, Runs):
                yield row, col, str(v)

    def pivot_caches(self) -> Iterator[tuple[str, str, str | None]]:
        """(cache, definition member, records member) of every pivot cache; a cache is named by its definition."""
        for kind, target in self.book_rels.values():
            if kind == "pivotCacheDefinition" and target in self.members:
                records = next((t for k, t in self.rels(target).values() if k == "pivotCacheRecords" and t in self.members), None)
                yield posixpath.basename(target).rsplit(".", 1)[0], target, records

    def pivot_items(self) -> Iterator[tuple]:
        """(cache, field, name, idx, kind, v): the fields of every cache and their shared items; a field without any has idx None."""
        for cache, definition, _ in self.pivot_caches():
            field, idx, inside = -1, 0, False
            with self.zip.open(definition) as f:
                for event, el in ET.iterparse(f, ("start", "end")):
                    tag = local(el.tag)
                    if event == "start":
                        if tag == "cacheField":
                            field, idx, name = field + 1, 0, el.get("name")
                            yield cache, field, name, None, None, None
                        inside = tag == "sharedItems" or (inside and tag in "xnsdbem")
                    elif tag in ("s", "n", "d", "b", "e", "m") and inside:
                        yield cache, field, name, idx, tag, el.get("v")
                        idx += 1
                    elif tag == "sharedItems":
                        inside = False
                        el.clear()

    def pivot_records(self) -> Iterator[tuple[str, int, str]]:
        """(cache, rec, items as JSON) of every record, streamed."""
        for cache, _, records in self.pivot_caches():
            if records is None:
                continue
            n, root = 0, None
            with self.zip.open(records) as f:
                for event, el in ET.iterparse(f, ("start", "end")):
                    if event == "start":
                        root = el if root is None else root
                    elif local(el.tag) == "r":
                        yield cache, n, json.dumps([[local(c.tag), c.get("v")] for c in el])
                        n += 1
                        root.clear()

    def external_cells(self) -> Iterator[tuple]:
        """(book, sheet, row, col, t, v) cached from linked workbooks."""
        for kind, target in self.book_rels.values():
            if kind != "externalLink":
                continue
            book = child(self.xml(target), "externalBook")
            if book is None:
                continue
            link = self.rels(target).get(attribute(book, "id"), (None, None))[1]
            sheets = [s.get("val") for s in children(child(book, "sheetNames"), "sheetName")]
            for data in children(child(book, "sheetDataSet"), "sheetData"):
                for r in children(data, "row"):
                    for c in children(r, "cell"):
                        v = child(c, "v")
                        if v is not None and v.text is not None:
                            row, col = place(c.get("r"))
                            yield link, sheets[int(data.get("sheetId"))], row, col, c.get("t", "n"), v.text


# The parts of a minimal workbook.
_MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
_OFFICE = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_PACKAGE = "http://schemas.openxmlformats.org/package/2006"
_HEAD = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>\n'
_PARTS = {
    "[Content_Types].xml": f'<Types xmlns="{_PACKAGE}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
    '<Default Extension="xml" ContentType="application/xml"/>'
    '<Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>'
    '<Override PartName="/xl/worksheets/sheet1.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>'
    '<Override PartName="/xl/styles.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.styles+xml"/>'
    '<Override PartName="/docProps/core.xml" ContentType="application/vnd.openxmlformats-package.core-properties+xml"/></Types>',
    "_rels/.rels": f'<Relationships xmlns="{_PACKAGE}/relationships"><Relationship Id="rId1" Type="{_OFFICE}/officeDocument" Target="xl/workbook.xml"/>'
    f'<Relationship Id="rId2" Type="{_PACKAGE}/relationships/metadata/core-properties" Target="docProps/core.xml"/></Relationships>',
    "xl/_rels/workbook.xml.rels": f'<Relationships xmlns="{_PACKAGE}/relationships"><Relationship Id="rId1" Type="{_OFFICE}/worksheet" Target="worksheets/sheet1.xml"/>'
    f'<Relationship Id="rId2" Type="{_OFFICE}/styles" Target="styles.xml"/></Relationships>',
    "xl/styles.xml": f'<styleSheet xmlns="{_MAIN}"><numFmts count="1"><numFmt numFmtId="164" formatCode="yyyy-mm-dd h:mm:ss"/></numFmts><fonts count="1"><font/></fonts>'
    '<fills count="1"><fill/></fills><borders count="1"><border/></borders><cellStyleXfs count="1"><xf/></cellStyleXfs>'
    '<cellXfs count="3"><xf numFmtId="0"/><xf numFmtId="164" applyNumberFormat="1"/><xf numFmtId="46" applyNumberFormat="1"/></cellXfs></styleSheet>',
}


def _escape(text: str) -> str:
    return text.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;")


MAX_TEXT = 32767
_ILLEGAL = re.compile("[\x00-\x08\x0b\x0c\x0e-\x1f]")


def letters(col: int) -> str:
    out = ""
    while col:
        col, r = divmod(col - 1, 26)
        out = chr(65 + r) + out
    return out


def cell_xml(ref: str, value) -> str:
    """One stored cell; text in place, timestamps as serial numbers, formulas without ``=``.

    A dictionary of ``formula`` and ``value`` is a formula with the value it had last, with ``ref`` an array formula of that
    range; a list of (font, text) is formatted text, each font a tuple of property elements.
    """
    if isinstance(value, list):
        runs = "".join(f'<r><rPr>{"".join(f"<{p}/>" for p in font)}</rPr><t xml:space="preserve">{_escape(t)}</t></r>' for font, t in value)
        return f'<c r="{ref}" t="inlineStr"><is>{runs}</is></c>'
    if isinstance(value, dict):
        formula, cached = value["formula"], value["value"]
        array = f' t="array" ref="{value["ref"]}"' if value.get("ref") else ""
        if formula is None:
            return cell_xml(ref, cached) if cached is not None else ""
        kind = ' t="str"' if isinstance(cached, str) else ' t="b"' if isinstance(cached, bool) else ""
        shown = "" if cached is None else _escape(cached) if isinstance(cached, str) else f"{cached:.16g}" if isinstance(cached, float) else str(int(cached))
        return f'<c r="{ref}"{kind}><f{array}>{_escape(formula.removeprefix("="))}</f><v>{shown}</v></c>'

    if isinstance(value, bool):
        return f'<c r="{ref}" t="b"><v>{int(value)}</v></c>'
    if isinstance(value, (int, float)):
        if value != value or value in (float("inf"), float("-inf")):
            return f'<c r="{ref}" t="n"><v></v></c>'
        return f'<c r="{ref}" t="n"><v>{"%d" % value if isinstance(value, int) else "%.16g" % value}</v></c>'
    if isinstance(value, dt.date):
        if not isinstance(value, dt.datetime):
            value = dt.datetime(value.year, value.month, value.day)
        if value.tzinfo is not None:
            raise TypeError("sheets hold no time zones")
        gap = value - dt.datetime(1899, 12, 30)
        days = gap.days - 1 if 0 < gap.days <= 60 else gap.days
        serial = days + (gap.seconds + gap.microseconds / 1e6) / 86400
        return f'<c r="{ref}" s="1" t="n"><v>{serial:.16g}</v></c>'
    if isinstance(value, dt.timedelta):
        return f'<c r="{ref}" s="2" t="n"><v>{value / dt.timedelta(days=1):.16g}</v></c>'
    text = str(value)
    if len(text) > MAX_TEXT:
        raise ValueError(f"cell {ref} would hold {len(text)} characters, more than {MAX_TEXT}")
    if _ILLEGAL.search(text):
        raise ValueError(f"control characters in cell {ref}")
    if len(text) > 1 and text[0] == "=":
        return f'<c r="{ref}"><f>{_escape(text[1:])}</f><v></v></c>'
    if text in ("#NULL!", "#DIV/0!", "#VALUE!", "#REF!", "#NAME?", "#NUM!", "#N/A"):
        return f'<c r="{ref}" t="e"><v>{text}</v></c>'
    return f'<c r="{ref}" t="inlineStr"><is><t xml:space="preserve">{_escape(text)}</t></is></c>'


# Rows that are compressed in one go, and the effort of that: sheets shrink well at the least.
ROWS_AT_ONCE, EFFORT = 256, 1


class SheetWriter:
    """One-sheet workbook written row by row, so memory does not grow with the sheet."""

    def __init__(self, handle, title: str):
        self.zip = zipfile.ZipFile(handle, "w", zipfile.ZIP_DEFLATED, compresslevel=EFFORT)
        title = _escape(title).replace('"', "&quot;")
        book = f'<workbook xmlns="{_MAIN}" xmlns:r="{_OFFICE}"><sheets><sheet name="{title}" sheetId="1" r:id="rId1"/></sheets></workbook>'
        core = f'<cp:coreProperties xmlns:cp="{_PACKAGE}/metadata/core-properties" xmlns:dc="http://purl.org/dc/elements/1.1/"><dc:title>{title}</dc:title></cp:coreProperties>'
        for name, body in {**_PARTS, "xl/workbook.xml": book, "docProps/core.xml": core}.items():
            self.zip.writestr(name, _HEAD + body)
        self.out = self.zip.open("xl/worksheets/sheet1.xml", "w", force_zip64=True)
        self.out.write(f'{_HEAD}<worksheet xmlns="{_MAIN}"><sheetData>'.encode())
        self.row, self.names, self.held = 0, [], []

    def append(self, values) -> None:
        self.row += 1
        while len(self.names) < len(values):
            self.names.append(letters(len(self.names) + 1))
        cells = [cell_xml(f"{n}{self.row}", v) for n, v in zip(self.names, values) if v is not None and v != ""]
        if cells:
            self.held.append(f'<row r="{self.row}">{"".join(cells)}</row>')
            if len(self.held) >= ROWS_AT_ONCE:
                self.flush()

    def flush(self) -> None:
        self.out.write("".join(self.held).encode())
        self.held.clear()

    def close(self, declared: str = "") -> None:
        """``declared`` is what follows the cells: filters, rules, validations."""
        self.flush()
        self.out.write(f"</sheetData>{declared}</worksheet>".encode())
        self.out.close()
        self.zip.close()
