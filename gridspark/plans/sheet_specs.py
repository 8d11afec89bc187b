"""Declarative specs of the parameter sheets, and the interpreter that runs them over cells.

A spec is a list of steps. The first step reads a rectangle of a sheet, the rest
are ordinary DataFrame operations, so every version of a sheet in the lake is
reshaped by one plan, keyed by ``book``. Steps that read:

  range     a rectangle with given column names
  long      body cells as (ids, label, value), labels composed or flattened from header rows
  ranked    the columns of a rectangle that have no gaps, named by place

and that reshape: sql, split, where, pivot, select, drop_nulls, bands, join,
outer, concat, sort.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridspark.functions.scalars import normalise
from gridspark.operators import reshape as M
from gridspark.operators.grid import SHEET, column_spec, densify, read_range, text_of
from gridspark.operators.structure import fill_down, row_block
from gridspark.scale import running

# Period labels as they stand in the sheets.
DAY = ["7am – 10am", "10am – 4pm", "4pm – 7pm", "7pm – 7am"]
WEEK = ["Average Weekday", "Weekend Average", "All Week Average"]
FULL = DAY + WEEK
_PERIODS_34 = {6: WEEK[0], 7: WEEK[1], 8: WEEK[2]}
_IDS_34 = {0: "Mode", 1: "Journey Purpose"}


def _forecast(cols: str) -> list[dict]:
    return [
        {"step": "long", "header": [25, 26], "compose": "right", "cols": cols, "rows": (27, 106), "ids": {0: "Year"}, "label": "Label", "value": "Value"},
        {"step": "sql", "Year": "cast(Year as int)"},
        {"step": "select", "columns": ["Year", "Label", "Value"]},
    ]


def _share(cols: str, rows: tuple[int, int], value: str, shift: int = 0) -> list[dict]:
    return [
        {"step": "long", "header": [25], "compose": "both", "cols": cols, "rows": rows, "ids": _IDS_34, "names": _PERIODS_34, "shift": shift,
         "fill_down": ["Mode", "Journey Purpose"], "keep": FULL, "label": "Time Period", "value": value},
        {"step": "select", "columns": ["Mode", "Journey Purpose", "Time Period", value]},
    ]


def _occupancy(rows: tuple[int, int], value: str) -> list[dict]:
    return [
        {"step": "long", "header": [25], "compose": "both", "cols": "A,D:J", "rows": rows, "ids": {0: "Journey Purpose"}, "keep": FULL, "label": "Time Period", "value": value},
        {"step": "select", "columns": ["Journey Purpose", "Time Period", value]},
    ]


def _curves(header: list[int], rows: tuple[int, int], ids: list[str], after: list[dict]) -> list[dict]:
    order = [i for i in ids if i != "Year"]
    return [
        {"step": "long", "header": header, "flatten": ";", "rows": rows, "special": {"Year": ("Year", "last contains")}, "ids": {"Year": "Year"}, "first_of_label": True,
         "skip_label": "Unnamed: 0_level_0", "blank": 0.0, "label": "Variables", "value": "Value"},
        {"step": "split", "column": "Variables", "into": [*order, "Parameter"], "sep": ";"},
        {"step": "sql", "Year": "cast(Year as int)", "Parameter": "concat('Param_', Parameter)", order[-1]: f"replace(`{order[-1]}`, 'Car1', 'Car')"},
        {"step": "pivot", "index": ids, "column": "Parameter", "items": ["Param_a", "Param_b", "Param_c", "Param_d"], "value": "Value"},
        {"step": "sort", "by": [*order, "Year"]},
        *after,
        {"step": "select", "columns": [*ids, "Param_a", "Param_b", "Param_c", "Param_d"]},
    ]


_CARS = {"step": "sql", "Vehicle Type": "CASE WHEN `Vehicle Type` = 'Cars' THEN 'Car' ELSE `Vehicle Type` END"}
_STATUS = ["HH car ownership", "Trip Purpose", "Concessionary pass status"]
_AREAS = ["London Boroughs", "Metropolitan built-up areas", "Large and medium urban areas", "Small urban and rural (<10k popn)", "All areas (exc London)", "All areas (inc London)"]
_PRICES = ["Factor Cost", "Perceived Cost", "Market Price"]

# Where each table lies in its sheet and what it is made of.
SPECS: dict[str, tuple[str, list[dict]]] = {
    "discount_rates": ("A1.1.1", [
        {"step": "range", "cols": "B,D,F", "skip": 23, "header": True, "names": ["Years from current year", "Discount rate (standard)", "Discount rate (health)"], "numbers": [1, 2]},
        {"step": "drop_nulls"},
        {"step": "bands", "column": "Years from current year"},
        {"step": "select", "columns": ["Years from current year", "Lower Bound", "Upper Bound", "Discount rate (standard)", "Discount rate (health)"]},
    ]),
    "vot_mode": ("A1.3.1", [{"step": "range", "cols": "A,D:F", "skip": 26, "nrows": 14, "names": ["Mode", *_PRICES], "numbers": [1, 2, 3]}]),
    "vot_purpose": ("A1.3.1", [{"step": "range", "cols": "A,D:F", "skip": 44, "nrows": 2, "names": ["Trip Purpose", *_PRICES], "numbers": [1, 2, 3]}]),
    "vot_params": ("A1.3.1", [{"step": "range", "cols": "H:J", "skip": 38, "nrows": 8, "header": True, "names": ["H", "I", "J"]}]),
    "vot_banded": ("A1.3.1", [
        {"step": "range", "cols": "H:K", "skip": 51, "nrows": 8, "names": ["Mode", "Resource Cost", "Perceived Cost", "Market Price"], "numbers": [1, 2, 3]},
        {"step": "sql", "Distance Band": "element_at(split(Mode, ' '), -1)"},
        {"step": "sql", "Mode": "replace(Mode, concat(' ', `Distance Band`), '')"},
        {"step": "bands", "column": "Distance Band"},
        {"step": "select", "columns": ["Mode", "Distance Band", "Lower Bound", "Upper Bound", "Resource Cost", "Perceived Cost", "Market Price"]},
    ]),
    "vot_forecast_a": ("A1.3.2", _forecast("B,D:Q")),
    "vot_forecast_b": ("A1.3.2", _forecast("B,R:S")),
    "vot_forecast_c": ("A1.3.2", _forecast("B,T:AG")),
    "vot_forecast_d": ("A1.3.2", _forecast("B,AH:AI")),
    "vot_forecast_e": ("A1.3.2", _forecast("B,AJ:AW")),
    "vot_forecast_f": ("A1.3.2", _forecast("B,AX:AY")),
    "occupancy_car": ("A1.3.3", [
        *_occupancy((27, 30), "Occupancy Per VehKm"),
        {"step": "join", "with": _occupancy((32, 35), "Occupancy Per Trip")},
        {"step": "sql", "AUC": "CASE trim(`Journey Purpose`) WHEN 'Work' THEN 'CB' WHEN 'Commuting' THEN 'CC' WHEN 'Other' THEN 'CO' WHEN 'Average Car' THEN 'AVG' END"},
        {"step": "select", "columns": ["Journey Purpose", "Time Period", "Occupancy Per VehKm", "Occupancy Per Trip", "AUC"]},
    ]),
    "occupancy_vehicle": ("A1.3.3", [
        {"step": "long", "header": [37], "compose": "both", "cols": "A,B,H:J", "rows": (40, 46), "ids": {0: "Vehicle Type", 1: "Journey Purpose"}, "names": dict(zip((2, 3, 4), WEEK)),
         "fill_down": ["Vehicle Type", "Journey Purpose"], "keep": WEEK, "label": "Time Period", "value": "Occupancy Per VehKm"},
        {"step": "select", "columns": ["Vehicle Type", "Journey Purpose", "Time Period", "Occupancy Per VehKm"]},
    ]),
    "occupancy_change": ("A1.3.3", [
        {"step": "long", "header": [49], "compose": "both", "cols": "A,D:J", "rows": (50, 51), "ids": {0: "Journey Purpose"}, "keep": [*DAY, "Average", "Weekend", "All Week"], "label": "Time Period", "value": "Change in Car Passenger Occupancy"},
        {"step": "select", "columns": ["Journey Purpose", "Time Period", "Change in Car Passenger Occupancy"]},
    ]),
    "travel_share": ("A1.3.4", [
        *_share("A,B,D:J", (27, 33), "Percentage of Distance Travelled by Vehicles"),
        {"step": "outer", "with": [
            _share("A,B,D:J", (35, 46), "Percentage of Distance Travelled by Occupants"),
            _share("A,B,K:Q", (27, 33), "Percentage of Vehicle Trips", 7),
            _share("A,B,K:Q", (35, 46), "Percentage of Person Trips", 7),
        ], "measures": ["Percentage of Distance Travelled by Vehicles", "Percentage of Distance Travelled by Occupants", "Percentage of Vehicle Trips", "Percentage of Person Trips"]},
    ]),
    "vot_vehicle": ("A1.3.5", [
        {"step": "long", "header": [26], "compose": "both", "cols": "A,B,D:J", "rows": (27, 38), "ids": _IDS_34, "names": _PERIODS_34, "fill_down": ["Mode", "Journey Purpose"], "keep": FULL,
         "label": "Time Period", "value": "Market Price Value of Time Per Vehicle"},
        {"step": "sql", "Mode": "CASE WHEN Mode IN ('PSV ', '(Occupants)') THEN 'PSV (Occupants)' ELSE Mode END"},
        {"step": "select", "columns": ["Mode", "Journey Purpose", "Time Period", "Market Price Value of Time Per Vehicle"]},
    ]),
    "vot_vehicle_forecast": ("A1.3.6", [
        {"step": "long", "header": [24, 25, 26, 27], "flatten": ",", "rows": (28, 107), "special": {"Year": ("Year", "any level equals")}, "ids": {"Year": "Year"}, "full_columns": True, "label": "Variables", "value": "Market Price Value of Time Per Vehicle"},
        {"step": "split", "column": "Variables", "into": ["Day Type", "Time Period", "Mode", "Journey Purpose"], "sep": ","},
        {"step": "sql", "Year": "cast(Year as int)", "Time Period": "CASE WHEN `Time Period` LIKE '%Unnamed%' THEN 'All' ELSE `Time Period` END"},
        {"step": "select", "columns": ["Year", "Day Type", "Time Period", "Mode", "Journey Purpose", "Market Price Value of Time Per Vehicle"]},
    ]),
    "fuel_prices": ("A1.3.7", [
        {"step": "long", "header": [24, 25, 26, 27], "flatten": ",", "rows": (28, 118), "special": {"Year": ("Year", "any level equals")}, "ids": {"Year": "Year"}, "full_columns": True, "label": "Variables", "value": "Value"},
        {"step": "split", "column": "Variables", "into": ["Component", "Fuel Type", "Mode", "Unit"], "sep": ","},
        {"step": "sql", "Year": "cast(Year as int)", "Mode": "CASE WHEN Mode LIKE '%Unnamed%' THEN 'All' ELSE Mode END"},
        {"step": "select", "columns": ["Year", "Component", "Fuel Type", "Mode", "Unit", "Value"]},
    ]),
    "fuel_consumption": ("A1.3.8", [
        {"step": "ranked", "rows": (27, 33), "names": ["Vehicle Category", "Max speed kph", "Param_a", "Param_b", "Param_c", "Param_d"], "numbers": [1, 2, 3, 4, 5]},
        {"step": "concat", "with": [
            {"step": "range", "cols": "A,D:I", "skip": 35, "nrows": 4, "names": ["Vehicle Category", "Max speed kph", "Param_a", "Param_b", "Param_c", "Param_d", "__last"], "numbers": [1, 2, 3, 4, 5]},
            {"step": "select", "columns": ["Vehicle Category", "Max speed kph", "Param_a", "Param_b", "Param_c", "Param_d"]},
        ]},
    ]),
    "fleet_share": ("A1.3.9", [
        {"step": "long", "header": [24, 25], "flatten": ",", "rows": (26, 72), "special": {"Year": ("Year", "last contains")}, "ids": {"Year": "Year"}, "full_columns": True, "label": "Variables", "value": "Value"},
        {"step": "split", "column": "Variables", "into": ["Mode", "Fuel Type"], "sep": ","},
        {"step": "sql", "Year": "cast(Year as int)"},
        {"step": "select", "columns": ["Year", "Mode", "Fuel Type", "Value"]},
    ]),
    "efficiency": ("A1.3.10", [
        {"step": "long", "header": [25, 26, 27], "flatten": ";", "rows": (28, 71), "special": {"FromYear": ("From", "last contains"), "ToYear": ("Year", "last contains")}, "ids": {"FromYear": "FromYear", "ToYear": "ToYear"},
         "full_columns": True, "first_of_label": True, "label": "Variables", "value": "Value"},
        {"step": "split", "column": "Variables", "into": ["Change", "Mode", "Fuel Type"], "sep": ";"},
        {"step": "sql", "Change": "CASE WHEN Change LIKE '%Cumulative%' THEN 'Cumulative' ELSE 'Annual' END", "FromYear": "cast(trim(replace(FromYear, ' to', '')) as int)", "ToYear": "cast(ToYear as int)"},
        {"step": "select", "columns": ["FromYear", "ToYear", "Change", "Mode", "Fuel Type", "Value"]},
    ]),
    "consumption_forecast": ("A1.3.11", _curves([24, 25], (26, 105), ["Year", "Vehicle Type"], [])),
    "fuel_cost_work": ("A1.3.12", _curves([24, 25, 26], (27, 106), ["Year", "Vehicle Type", "Fuel Type"], [
        {"step": "sql", "Vehicle Type": "CASE WHEN `Vehicle Type` = 'OGV' THEN CASE WHEN `Fuel Type` LIKE '%OGV1%' THEN 'OGV1' ELSE 'OGV2' END ELSE `Vehicle Type` END"},
        _CARS,
        {"step": "sql", "Fuel Type": "trim(replace(`Fuel Type`, `Vehicle Type`, ''))"},
    ])),
    "fuel_cost_nonwork": ("A1.3.13", _curves([24, 25, 26], (27, 106), ["Year", "Vehicle Type", "Fuel Type"], [_CARS])),
    "nonfuel_cost": ("A1.3.14", [
        {"step": "ranked", "rows": (27, 39), "names": ["Vehicle Type", "Fuel Type", "Param_a1", "Param_b1"], "numbers": [2, 3], "fill_down": ["Vehicle Type", "Fuel Type"], "cover": ["Vehicle Type"]},
        {"step": "split", "column": "Fuel Type", "into": ["Trip Purpose", "Fuel Type"], "sep": " "},
        {"step": "sql", "Fuel Type": "replace(CASE WHEN `Fuel Type` IS NOT NULL THEN `Fuel Type` WHEN `Vehicle Type` = 'LGV' THEN 'Non-electric' ELSE 'All' END, 'Electic', 'Electric')"},
        {"step": "select", "columns": ["Vehicle Type", "Trip Purpose", "Fuel Type", "Param_a1", "Param_b1"]},
    ]),
    "nonfuel_cost_forecast": ("A1.3.15", [
        {"step": "long", "cols": "B,D:I", "rows": (26, 61), "ids": {0: "Year"}, "names": {1: "Work;Car;Param_a1", 2: "Work;Car;Param_b1", 3: "Non-work;Car;Param_a1", 4: "Non-work;Car;Param_b1", 5: "Average;Car;Param_a1", 6: "Average;Car;Param_b1"}, "label": "Variables", "value": "Value"},
        {"step": "split", "column": "Variables", "into": ["Trip Purpose", "Vehicle Type", "Parameter"], "sep": ";"},
        {"step": "sql", "Year": "cast(Year as int)"},
        {"step": "pivot", "index": ["Year", "Trip Purpose", "Vehicle Type"], "column": "Parameter", "items": ["Param_a1", "Param_b1"], "value": "Value"},
        {"step": "sort", "by": ["Trip Purpose", "Vehicle Type", "Year"]},
    ]),
    "bus_trip_share": ("A1.3.16", [
        {"step": "long", "cols": "A:I", "rows": (28, None), "ids": dict(enumerate(_STATUS)), "names": dict(enumerate(_AREAS, 3)), "label": "Area", "value": "Value"},
        {"step": "drop_nulls"},
        {"step": "select", "columns": [*_STATUS, "Area", "Value"]},
    ]),
    "bus_not_go": ("A1.3.17", [
        {"step": "range", "cols": "A:D", "skip": 27, "names": [*_STATUS, "Proportion not go"], "numbers": [3]},
        {"step": "drop_nulls"},
    ]),
    "bus_social_value": ("A1.3.18", [
        {"step": "range", "cols": "A,D", "skip": 27, "nrows": 2, "names": ["Concessionary travel pass status", "Value"], "numbers": [1]},
    ]),
}


def _number(name: str):
    return F.col(f"`{name}`").try_cast("double").alias(name)


def _range(cells: DataFrame, s: dict) -> DataFrame:
    wide = read_range(cells, None, s["cols"], s.get("skip", 0), s.get("nrows"), s.get("header", False), s["names"])
    numbers = {s["names"][i] for i in s.get("numbers", [])}
    return wide.select("book", F.array("row").alias("__o"), *[_number(n) if n in numbers else F.col(f"`{n}`") for n in s["names"]])


def _body(cells: DataFrame, rows: tuple[int, int | None]) -> DataFrame:
    first, last = rows
    return cells.filter((F.col("row") >= first) & (F.lit(True) if last is None else F.col("row") <= last))


def _header(cells: DataFrame, s: dict, cols: list[int] | None) -> DataFrame:
    """(book, sheet, col, label) of a long read."""
    if "flatten" in s:
        return M.flatten_header(cells, s["header"], sep=s["flatten"], special=s.get("special"))
    fixed = {cols[i]: n for i, n in {**s.get("names", {}), **s["ids"]}.items()}
    known = F.create_map(*[F.lit(x) for kv in fixed.items() for x in kv])
    sheets = cells.select(*SHEET).distinct()
    named = sheets.withColumn("col", F.explode(F.array(*[F.lit(c) for c in cols]))).withColumn("__fixed", F.try_element_at(known, F.col("col")))
    if "compose" in s:
        composed = M.compose_header(cells.filter(F.col("col").isin([c - s.get("shift", 0) for c in cols[len(s["ids"]):]])), s["header"], strip=s["compose"])
        shifted = composed.withColumn("col", F.col("col") + s.get("shift", 0)).withColumnRenamed("label", "__composed")
        named = named.join(shifted, [*SHEET, "col"], "left").withColumn("__fixed", F.coalesce("__fixed", "__composed"))
    return named.filter(F.col("__fixed").isNotNull()).select(*SHEET, "col", F.col("__fixed").alias("label"))


def _long(cells: DataFrame, s: dict) -> DataFrame:
    cols = column_spec(s["cols"]) if "cols" in s else None
    body = _body(cells, s["rows"])
    if cols:
        body = body.filter(F.col("col").isin(cols))
    header = _header(cells, s, cols)
    if s.get("full_columns"):
        body = M.drop_ragged_cols(body)
    if s.get("skip_label"):
        header = header.filter(~F.col("label").startswith(s["skip_label"]))
    if s.get("first_of_label"):
        kept = header.join(body.select(*SHEET, "col").distinct(), [*SHEET, "col"], "left_semi") if s.get("full_columns") else header
        header = M.drop_dup_cols(kept)
    if "blank" in s:
        wide = header.groupBy(*SHEET).agg(F.min("col").alias("min_col"), F.max("col").alias("max_col"))
        used = body.groupBy(*SHEET).agg(F.min("row").alias("min_row"), F.max("row").alias("max_row"))
        body = densify(body, wide.join(used, SHEET))
    ids = list(s["ids"].values())
    labelled = M.label_cells(body, header).withColumn("__t", text_of())
    # a sheet row has at most 18,278 cells
    item = F.struct(F.col("col").alias("col"), F.col("label").alias("label"), F.col("v_num").alias("v"))
    by_row = labelled.groupBy(*SHEET, "row").agg(
        *[F.max(F.when(F.col("label") == i, F.col("__t"))).alias(i) for i in ids],
        F.collect_list(F.when(~F.col("label").isin(ids), item)).alias("__items"),
    )
    if s.get("fill_down"):
        by_row = fill_down(by_row, SHEET, s["fill_down"], ["row"], row_block())
    quoted = [F.col(f"`{i}`") for i in ids]
    long = by_row.select("book", "row", *quoted, F.explode("__items").alias("__i"))
    if s.get("keep"):
        long = long.filter(normalise(F.col("__i.label")).isin([_plain(k) for k in s["keep"]]))
    value = F.col("__i.v") if "blank" not in s else F.coalesce("__i.v", F.lit(s["blank"]))
    return long.select("book", F.array("__i.col", "row").alias("__o"), *quoted, F.col("__i.label").alias(s["label"]), value.alias(s["value"]))


def _plain(text: str) -> str:
    return text.strip().replace("–", "-").replace(" - ", "-")


def _ranked(cells: DataFrame, s: dict) -> DataFrame:
    body = _body(cells, s["rows"])
    places = Window.partitionBy(*SHEET).orderBy("col")
    if s.get("cover"):
        # label columns are filled down first, so their gaps do not count
        marks = M.drop_ragged_cols(body.filter("col > 2")).unionByName(body.filter("col <= 2"))
    else:
        marks = M.drop_ragged_cols(body)
    at = marks.select(*SHEET, "col").distinct().withColumn("__at", F.row_number().over(places) - 1)
    placed = marks.join(at, [*SHEET, "col"])
    numbers = {s["names"][i] for i in s.get("numbers", [])}
    wide = placed.groupBy(*SHEET, "row").agg(
        *[F.max(F.when(F.col("__at") == i, F.col("v_num") if n in numbers else text_of())).alias(n) for i, n in enumerate(s["names"])]
    )
    if s.get("fill_down"):
        wide = fill_down(wide, SHEET, s["fill_down"], ["row"], row_block())
    return wide.select("book", F.array("row").alias("__o"), *[F.col(f"`{n}`") for n in s["names"]])


def _run(cells: DataFrame, steps: list[dict]) -> DataFrame:
    df = None
    for s in steps:
        kind = s["step"]
        if kind == "range":
            df = _range(cells, s)
        elif kind == "long":
            df = _long(cells, s)
        elif kind == "ranked":
            df = _ranked(cells, s)
        elif kind == "sql":
            df = df.withColumns({n: F.expr(e) for n, e in s.items() if n != "step"})
        elif kind == "split":
            df = M.split_label(df, s["column"], s["into"], s["sep"])
        elif kind == "bands":
            b = M.parse_bands(F.col(f"`{s['column']}`"))
            df = df.withColumn("__b", b).withColumns({"Lower Bound": F.col("__b.lower"), "Upper Bound": F.col("__b.upper")}).drop("__b")
        elif kind == "drop_nulls":
            df = df.dropna("any")
        elif kind == "pivot":
            df = M.pivot_mean(df, ["book", *s["index"]], s["column"], s["items"], s["value"])
        elif kind == "sort":
            df = df.withColumn("__o", F.struct(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(s["by"])]))
        elif kind == "select":
            df = df.select("book", "__o", *[F.col(f"`{c}`") for c in s["columns"]])
        elif kind == "join":
            right = _run(cells, s["with"]).drop("__o")
            df = M.natural_join(df, right)
        elif kind == "outer":
            # the order of the first table that holds a row is its order
            parts = [df, *[_run(cells, w) for w in s["with"]]]
            ranked = [p.withColumnRenamed("__o", f"__o{i}") for i, p in enumerate(parts)]
            df = M.natural_outer(ranked, s["measures"])
            place = F.coalesce(*[F.concat(F.array(F.lit(i)), F.col(f"__o{i}")) for i in range(len(parts))])
            df = df.withColumn("__o", place).drop(*[f"__o{i}" for i in range(len(parts))])
        elif kind == "concat":
            df = M.concat_fill([df, _run(cells, s["with"])])
        else:
            raise ValueError(f"unknown step {kind!r}")
    return df


def run_sheet_spec(cells: DataFrame, spec: str | tuple[str, list[dict]]) -> DataFrame:
    """One parameter table for every book: book, row_no and the spec's columns.

    Ids are sanitised and text is normalised; row_no follows the sheet's order.
    """
    sheet, steps = SPECS[spec] if isinstance(spec, str) else spec
    out = _run(cells.filter(F.col("sheet") == sheet), steps)
    # a book's table is at most one sheet long
    numbered = running(out, ["book"], ["__o"], {"row_no": ("row_number", None)}, F.lit(0)).drop("__o")
    columns = []
    for name, kind in numbered.dtypes:
        clean = name.replace(" ", "_").replace("(", "").replace(")", "")
        c = F.col(f"`{name}`")
        columns.append((normalise(c) if kind == "string" and name != "book" else c).alias(clean))
    return numbered.select(*columns)


def to_wide(long: DataFrame, labels: list[str]) -> DataFrame:
    """Wide form of a (Year, Label, Value) table for the labels asked for."""
    return long.groupBy("book", "Year").pivot("Label", labels).agg(F.max("Value"))
