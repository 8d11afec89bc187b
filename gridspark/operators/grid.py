"""The cells table and everything that moves between it and ordinary tables.

cells(book, sheet, row, col, dtype, v_num, v_str, v_ts, v_bool, time_ms, span_ms, err, formula, style_id)

Times of day and durations are milliseconds.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridspark.functions import coords as C
from gridspark.functions import scalars as S
from gridspark.scale import TILE_ROWS, hot_keys, running, salted_join, split_join, spread, tile_join, whole

SHEET = ["book", "sheet"]
VALUES = ["dtype", "v_num", "v_str", "v_ts", "v_bool", "time_ms", "span_ms", "err", "formula", "style_id"]
CELLS = SHEET + ["row", "col"] + VALUES
# keys over which the records of a decoded field are dealt at least
ITEM_KEYS = 4096

_NULLS = {
    "dtype": "string",
    "v_num": "double",
    "v_str": "string",
    "v_ts": "timestamp_ntz",
    "v_bool": "boolean",
    "time_ms": "bigint",
    "span_ms": "bigint",
    "err": "string",
    "formula": "string",
    "style_id": "int",
}


def as_cells(df: DataFrame) -> DataFrame:
    """Add the value columns a partial cells table lacks, in canonical order."""
    return df.select(
        *SHEET,
        F.col("row").cast("int").alias("row"),
        F.col("col").cast("int").alias("col"),
        *[
            (F.col(n) if n in df.columns else F.lit(None)).cast(t).alias(n)
            for n, t in _NULLS.items()
        ],
    )


def _value(name: str, kind: T.DataType) -> Column:
    c = F.col(name)
    null = {n: F.lit(None).cast(t) for n, t in _NULLS.items()}
    if isinstance(kind, T.BooleanType):
        null["dtype"], null["v_bool"] = F.lit("b"), c
    elif isinstance(kind, (T.TimestampNTZType, T.DateType, T.TimestampType)):
        null["dtype"], null["v_ts"] = F.lit("d"), c.cast("timestamp_ntz")
    elif isinstance(kind, T.NumericType):
        null["dtype"], null["v_num"] = F.lit("n"), c.cast("double")
    elif isinstance(kind, T.StringType):
        null["dtype"], null["v_str"] = F.lit("s"), c
    else:
        raise ValueError(f"unsupported type {kind.simpleString()} in column {name}")
    return F.struct(*[null[n].alias(n) for n in VALUES])


def _header(text: str) -> Column:
    null = {n: F.lit(None).cast(t) for n, t in _NULLS.items()}
    null["dtype"], null["v_str"] = F.lit("s"), F.lit(text)
    return F.struct(*[null[n].alias(n) for n in VALUES])


def to_cells(
    df: DataFrame,
    book: Column,
    sheet: Column,
    columns: list[str],
    order: list[str],
    block: Column,
    header: bool = True,
    index: list[str] | None = None,
) -> DataFrame:
    """Table to sheet rows: header row, index-names row, then data rows.

    Index columns stand left of the data; their names get a row of their own
    below the header. Rows are numbered per sheet along ``order``; NULLs leave
    no cell.
    """
    index = index or []
    kinds = {f.name: f.dataType for f in df.schema.fields}
    lead = int(header) + int(bool(index))
    placed = df.withColumn("book", book).withColumn("sheet", sheet)
    numbered = running(placed, SHEET, order, {"__n": ("row_number", None)}, block)
    width = index + columns
    body = numbered.select(
        *SHEET,
        (F.col("__n") + lead).cast("int").alias("row"),
        F.posexplode(F.array(*[_value(c, kinds[c]) for c in width])).alias("__i", "__v"),
    )
    parts = [body.select(*SHEET, "row", (F.col("__i") + 1).alias("col"), "__v.*")]
    if lead:
        top = []
        if header:
            top += [(1, len(index) + i + 1, c) for i, c in enumerate(columns)]
        if index:
            top += [(lead, i + 1, c) for i, c in enumerate(index)]
        cell = F.explode(
            F.array(
                *[
                    F.struct(F.lit(r).alias("row"), F.lit(c).alias("col"), _header(t).alias("v"))
                    for r, c, t in top
                ]
            )
        )
        parts.append(
            placed.select(*SHEET).distinct().select(*SHEET, cell.alias("h")).select(*SHEET, "h.row", "h.col", "h.v.*")
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.filter(filled())


def filled() -> Column:
    """A cell that holds something."""
    return F.coalesce(
        F.col("v_num").isNotNull()
        | F.col("v_str").isNotNull()
        | F.col("v_ts").isNotNull()
        | F.col("v_bool").isNotNull()
        | F.col("time_ms").isNotNull()
        | F.col("span_ms").isNotNull()
        | F.col("err").isNotNull()
        | F.col("formula").isNotNull(),
        F.lit(False),
    )


def text_of(prefix: str = "") -> Column:
    """Any cell value as text."""
    c = lambda n: F.col(prefix + n)
    return F.coalesce(
        c("v_str"),
        S.short_text(c("v_num")),
        S.to_iso(c("v_ts")),
        F.when(c("v_bool"), F.lit("TRUE")).when(~c("v_bool"), F.lit("FALSE")),
        S.clock_text(c("time_ms")),
        S.clock_text(c("span_ms")),
        c("err"),
    )


def has_value(prefix: str = "") -> Column:
    """Whether a cell holds any value; far shorter than asking for its text."""
    held = [F.col(prefix + n).isNotNull() for n in ("v_str", "v_num", "v_ts", "v_bool", "time_ms", "span_ms", "err")]
    return reduce(Column.__or__, held)


def value_mode(cells: DataFrame, data_only: bool) -> DataFrame:
    """Cached values, or formula text in place of them."""
    if data_only:
        return cells.withColumn("formula", F.lit(None).cast("string"))
    has = F.col("formula").isNotNull()
    blank = {n: F.when(~has, F.col(n)) for n in ("v_num", "v_ts", "v_bool", "time_ms", "span_ms", "err")}
    return cells.withColumns(
        {
            **blank,
            "v_str": F.when(has, F.col("formula")).otherwise(F.col("v_str")),
            "dtype": F.when(has, F.lit("f")).otherwise(F.col("dtype")),
        }
    )


def decode_strings(cells: DataFrame, sst: DataFrame) -> DataFrame:
    """Shared-string cells (dtype ``s``, index in v_num) to text; ``x005F_`` marks are dropped.

    A popular string can be most of a lake, so the join is salted.
    """
    text = sst.select("book", F.col("idx").cast("bigint").alias("__idx"), F.replace("text", F.lit("x005F_"), F.lit("")).alias("__text"))
    keyed = cells.withColumn("__idx", F.when(F.col("dtype") == "s", F.col("v_num").cast("bigint")))
    # a book's strings grow with the data: salt the popular ones only
    hot = hot_keys(keyed.filter(F.col("__idx").isNotNull()), ["book", "__idx"])
    out = salted_join(keyed, text, ["book", "__idx"], "left", hot=hot)
    shared = F.col("__idx").isNotNull()
    return out.withColumns(
        {
            "v_str": F.when(shared, F.col("__text")).otherwise(F.col("v_str")),
            "v_num": F.when(~shared, F.col("v_num")),
        }
    ).drop("__idx", "__text")


def dimensions(cells: DataFrame) -> DataFrame:
    """Used range of every sheet, as bounds and as text."""
    used = cells.groupBy(*SHEET).agg(
        F.min("col").alias("min_col"),
        F.min("row").alias("min_row"),
        F.max("col").alias("max_col"),
        F.max("row").alias("max_row"),
    )
    text = F.concat(
        C.coord(F.col("min_col"), F.col("min_row")), F.lit(":"), C.coord(F.col("max_col"), F.col("max_row"))
    )
    return used.withColumn("dimension", text)


def densify(cells: DataFrame, bounds: DataFrame | None = None) -> DataFrame:
    """Sparse to dense: every position within the bounds of its sheet, empty where nothing is.

    ``bounds`` has one row per sheet; without it every sheet is filled from A1
    to its last used row and column.
    """
    rows = sheet_rows(from_a1(cells) if bounds is None else bounds)
    grid = rows.select(*SHEET, "row", F.explode(F.sequence("min_col", "max_col")).alias("col"))
    return grid.join(cells, [*SHEET, "row", "col"], "left")


def from_a1(cells: DataFrame) -> DataFrame:
    """Bounds of every sheet from A1 to its last used row and column."""
    return cells.groupBy(*SHEET).agg(
        F.lit(1).alias("min_row"), F.lit(1).alias("min_col"),
        F.max("row").alias("max_row"), F.max("col").alias("max_col"),
    )


def sheet_rows(bounds: DataFrame) -> DataFrame:
    """Every row within the bounds: first the row tiles of a sheet, spread over the tasks, then the rows of each tile."""
    low, high = F.floor(F.col("min_row") / TILE_ROWS), F.floor(F.col("max_row") / TILE_ROWS)
    tiles = spread(bounds.withColumn("__tile", F.explode(F.sequence(low, high))), *SHEET, "__tile")
    start = F.greatest(F.col("min_row"), (F.col("__tile") * TILE_ROWS).cast("int"))
    end = F.least(F.col("max_row"), ((F.col("__tile") + 1) * TILE_ROWS - 1).cast("int"))
    return tiles.withColumn("row", F.explode(F.sequence(start, end))).drop("__tile")


def column_spec(spec: str) -> list[int]:
    """``"B, D:Q"`` -> 1-based column numbers in sheet order."""
    number = lambda s: sum((ord(ch) - 64) * 26**i for i, ch in enumerate(reversed(s.strip().upper())))
    out: set[int] = set()
    for part in spec.split(","):
        ends = [number(p) for p in part.split(":")]
        out.update(range(ends[0], ends[-1] + 1))
    return sorted(out)


def read_range(
    cells: DataFrame,
    sheet: str | None,
    cols: str | list[int],
    skip: int = 0,
    nrows: int | None = None,
    header: bool = True,
    names: list[str] | None = None,
    drop_blank_rows: bool = True,
    value: Column | None = None,
) -> DataFrame:
    """Rectangle of a sheet as a wide table keyed by book, sheet and row.

    With ``header`` the first row below ``skip`` is taken as header and not
    returned, also when ``names`` replace it. Columns are ``names`` or ``c<n>``.
    The value defaults to the cell's text; pass another column to keep numbers.
    """
    idx = column_spec(cols) if isinstance(cols, str) else list(cols)
    first = skip + 1 + int(header)
    keep = F.col("col").isin(idx) & (F.col("row") >= first)
    if nrows is not None:
        keep = keep & (F.col("row") < first + nrows)
    if sheet is not None:
        keep = keep & (F.col("sheet") == sheet)
    names = names or [f"c{i}" for i in idx]
    picked = cells.filter(keep).withColumn("__v", value if value is not None else text_of())
    wide = picked.groupBy(*SHEET, "row").agg(
        *[F.max(F.when(F.col("col") == i, F.col("__v"))).alias(n) for i, n in zip(idx, names)]
    )
    if drop_blank_rows:
        wide = wide.filter(F.coalesce(*[F.col(n).cast("string") for n in names]).isNotNull())
    return wide


def decode_pivot_cache(records: DataFrame, items: DataFrame, fields: dict[int, str]) -> DataFrame:
    """Pivot-cache records to a table: items are inline or an index into the field's shared items.

    One join per decoded field keeps each record in place: records are never
    regrouped. The fewer items a field shares, the more records each of them has: so few items are repeated until
    they make ``ITEM_KEYS`` keys, over which a hash of the record deals the records. Inline items get keys of their own that meet nothing.
    records(cache, rec, items array<struct(kind, v)>), items(cache, field, idx, v).
    """
    out = records
    for i, name in fields.items():
        item = F.get("items", F.lit(i))
        shared = items.filter(F.col("field") == i).select("cache", F.col("idx").alias("__idx"), F.col("v").alias("__shared"))
        told = whole(shared, n=F.count_distinct("__idx"))["n"]
        copies = F.greatest(F.lit(1), F.floor(F.lit(ITEM_KEYS) / F.greatest(told, F.lit(1)))).cast("int")
        coded = item["kind"] == "x"
        dealt = F.pmod(F.xxhash64("rec", "items"), F.when(coded, copies).otherwise(ITEM_KEYS)).cast("int")
        keyed = out.withColumns({"__idx": F.when(coded, item["v"].cast("int")).otherwise(-1), "__copy": dealt})
        repeated = shared.withColumn("__copy", F.explode(F.sequence(F.lit(0), copies - 1)))
        text = F.when(item["kind"] == "x", F.col("__shared")).when(item["kind"] != "m", item["v"])
        out = split_join(keyed, repeated, ["cache", "__idx", "__copy"]).withColumn(name, text).drop("__idx", "__copy", "__shared")
    return out.drop("items")


def read_table(cells: DataFrame, tables: DataFrame, name: str, columns: list[str]) -> DataFrame:
    """Table object by name: its rows without header and totals rows, as text columns.

    tables(book, sheet, name, min_col, min_row, max_col, max_row, header_rows, totals_rows).
    """
    body = tables.filter(F.col("name") == name).select(
        *SHEET,
        "min_col",
        (F.col("min_row") + F.col("header_rows")).alias("min_row"),
        "max_col",
        (F.col("max_row") - F.col("totals_rows")).alias("max_row"),
    )
    hit = tile_join(cells, body.filter("max_row >= min_row"))
    place = F.col("col") - F.col("r_min_col")
    return hit.withColumn("__v", text_of()).groupBy(*SHEET, "row").agg(
        *[F.max(F.when(place == i, F.col("__v"))).alias(n) for i, n in enumerate(columns)]
    )


def resolve_names(cells: DataFrame, names: DataFrame, user_sheet: str) -> DataFrame:
    """Cells behind defined names as seen from ``user_sheet``.

    names(book, name, scope, target): ``scope`` NULL is book-wide; ``target`` is
    text such as ``a!$A$1:$B$2,b!C3``. A name scoped to the user's sheet wins
    over the book-wide one. Print areas and titles are not names book-wide.
    """
    local = F.col("scope") == user_sheet
    reserved = F.col("name").isin("_xlnm.Print_Area", "_xlnm.Print_Titles")
    seen = names.filter(F.coalesce(local, F.lit(False)) | (F.col("scope").isNull() & ~reserved))
    best = seen.groupBy("book", "name").agg(
        F.max_by("target", F.coalesce(local, F.lit(False)).cast("int")).alias("target")
    )
    parts = best.select("book", "name", F.explode(F.split("target", ",(?=(?:[^']*'[^']*')*[^']*$)")).alias("part"))
    q = C.qualified_range(F.col("part"))
    ranges = (
        parts.withColumn("q", q)
        .filter(F.col("q.bounds").isNotNull())
        .select(
            "book",
            F.col("q.sheet").alias("sheet"),
            "name",
            F.coalesce("q.bounds.min_col", F.lit(1)).alias("min_col"),
            F.coalesce("q.bounds.min_row", F.lit(1)).alias("min_row"),
            F.coalesce("q.bounds.max_col", F.lit(C.MAX_COLUMN)).alias("max_col"),
            F.coalesce("q.bounds.max_row", F.lit(C.MAX_SHEET_ROW)).alias("max_row"),
        )
    )
    return tile_join(cells, ranges).withColumnRenamed("r_name", "name")


def bind_annotations(cells: DataFrame, annotations: DataFrame, merges: DataFrame) -> DataFrame:
    """Comments and links bound to cells.

    annotations(book, sheet, ref, kind, text). A ranged link covers every cell of
    its range (of whole rows or columns: as far as the sheet is used); a link on a covered cell of a
    merge moves to the merge's anchor.
    """
    corners = cells.select(*SHEET, "row", "col").unionByName(merges.select(*SHEET, F.col("max_row").alias("row"), F.col("max_col").alias("col")))
    used = corners.groupBy(*SHEET).agg(F.max("row").alias("__rows"), F.max("col").alias("__cols"))
    b = lambda side, other: F.coalesce(F.col(f"b.{side}"), other).cast("int").alias(side)
    ranged = (
        annotations.withColumn("b", C.range_bounds(F.col("ref"))).filter("b is not null").join(used, SHEET)
        .select(
            *SHEET, "kind", "text", b("min_col", F.lit(1)), b("min_row", F.lit(1)), b("max_col", F.col("__cols")), b("max_row", F.col("__rows"))
        ).filter("max_row >= min_row and max_col >= min_col")
        .select(*SHEET, "kind", "text", F.explode(F.sequence("min_row", "max_row")).alias("row"), "min_col", "max_col")
        .select(*SHEET, "kind", "text", "row", F.explode(F.sequence("min_col", "max_col")).alias("col"))
    )
    anchored = (
        tile_join(ranged, merges, "left")
        .select(
            *SHEET,
            "kind",
            F.col("text").alias("note"),
            F.coalesce("r_min_row", "row").alias("row"),
            F.coalesce("r_min_col", "col").alias("col"),
        )
        .distinct()
    )
    return cells.join(anchored, [*SHEET, "row", "col"])


def append_rows(cells: DataFrame, rows: DataFrame, order: list[str], block: Column) -> DataFrame:
    """Rows appended below the last used row of their sheet.

    rows(book, sheet, <order columns>, values) where ``values`` is an array of
    structs (col INT, v_num, v_str): list rows number their columns themselves.
    """
    last = cells.groupBy(*SHEET).agg(F.max("row").alias("__last"))
    numbered = running(rows, SHEET, order, {"__n": ("row_number", None)}, block)
    new = (
        split_join(numbered, last, SHEET)
        .select(*SHEET, (F.coalesce("__last", F.lit(0)) + F.col("__n")).alias("row"), F.explode("values").alias("v"))
        .select(
            *SHEET,
            "row",
            F.col("v.col").alias("col"),
            F.when(F.col("v.v_num").isNotNull(), "n").otherwise("s").alias("dtype"),
            F.col("v.v_num").alias("v_num"),
            F.col("v.v_str").alias("v_str"),
        )
    )
    return cells.unionByName(as_cells(new).filter(filled()))


def list_row(*values: Column) -> Column:
    """Positional row for ``append_rows``."""
    return F.array(*[_row_item(F.lit(i + 1), v) for i, v in enumerate(values)])


def dict_row(values: dict[str | int, Column]) -> Column:
    """Row keyed by column letter or number for ``append_rows``."""
    return F.array(
        *[_row_item(F.lit(column_spec(k)[0] if isinstance(k, str) else k), v) for k, v in values.items()]
    )


def _row_item(col: Column, value: Column) -> Column:
    """Numbers stay numbers and texts stay texts, also those that read as a number (``007``)."""
    kind = F.typeof(value)
    numeric = kind.isin("tinyint", "smallint", "int", "bigint", "float", "double") | kind.startswith("decimal")
    number = F.when(numeric, value.cast("string").try_cast("double"))
    return F.struct(
        col.cast("int").alias("col"),
        number.alias("v_num"),
        F.when(number.isNull(), value.cast("string")).alias("v_str"),
    )


def param_table(df: DataFrame, order: list[str], block: Column) -> DataFrame:
    """Parameter-table form: ``row_no`` first, sanitised ids, normalised text, plain types only."""
    out, seen = [F.col("row_no").cast("int").alias("row_no")], set()
    for f in df.schema.fields:
        name = f.name.replace(" ", "_").replace("(", "").replace(")", "")
        if name in seen:
            raise ValueError(f"duplicate column id {name}")
        seen.add(name)
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.StringType):
            out.append(S.normalise(c).alias(name))
        elif isinstance(f.dataType, (T.ShortType, T.IntegerType, T.LongType)):
            out.append(c.cast("bigint").alias(name))
        elif isinstance(f.dataType, (T.FloatType, T.DoubleType)):
            out.append(c.cast("double").alias(name))
        else:
            raise ValueError(f"Unsupported type: {f.dataType.simpleString()}")
    return running(df, [], order, {"row_no": ("row_number", None)}, block).select(*out)


def save_param_table(df: DataFrame, name: str, comment: str, path: str | None = None) -> DataFrame:
    """Replace the saved table and return it. Pass the result of ``param_table``; with a path the files lie there."""
    place = {"path": path} if path else {}
    df.write.mode("overwrite").options(comment=comment, **place).saveAsTable(name)
    return df.sparkSession.table(name)


def provenance(cells: DataFrame, spots: dict[str, tuple[str, int, int]], path: str | None = None, version: str | None = None) -> DataFrame:
    """One row per book of single-cell values: name -> (sheet, row, col), as text.

    Also says where the books lie (``path``), what read them (``version``), who and when.
    """
    keep = None
    for sheet, row, col in spots.values():
        one = (F.col("sheet") == sheet) & (F.col("row") == row) & (F.col("col") == col)
        keep = one if keep is None else keep | one
    picks = []
    for name, (sheet, row, col) in spots.items():
        one = (F.col("sheet") == sheet) & (F.col("row") == row) & (F.col("col") == col)
        picks.append(F.max(F.when(one, text_of())).alias(name))
    return cells.filter(keep).groupBy("book").agg(*picks).withColumns({
        "path": F.lit(path).cast("string"), "version": F.lit(version).cast("string"),
        "loaded_by": F.current_user(), "loaded_at": F.current_timestamp(),
    })
