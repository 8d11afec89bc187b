"""M34: all sheet specs over parameter sheets whose numbers are summed from the fact table, a book per return flag."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridspark.operators import grid as G
from gridspark.plans.sheet_specs import DAY, FULL, run_sheet_spec
from gridspark.session import cut_lineage
from suite.registry import query

FIRST_YEAR = 2010
ABCD = ["a", "b", "c", "d"]
PERIODS = ["7am-10am", "10am-4pm", "4pm-7pm", "7pm-7am", "Average Weekday", "Weekend Average", "All Week Average"]
AREAS = ["London Boroughs", "Metropolitan built-up areas", "Large and medium urban areas", "Small urban and rural (<10k popn)", "All areas (exc London)", "All areas (inc London)"]
FORECASTS = {"a": range(4, 18), "b": range(18, 20), "c": range(20, 34), "d": range(34, 36), "e": range(36, 50), "f": range(50, 52)}


class Layout:
    """Text cells and blocks of numbers of the sheets."""

    def __init__(self):
        self.texts: list[tuple[str, int, int, str]] = []
        self.blocks: list[tuple[str, int, int, int, int, bool]] = []

    def across(self, sheet, row, col, items):
        self.texts += [(sheet, row, col + i, s) for i, s in enumerate(items) if s is not None]

    def down(self, sheet, row, col, items):
        self.texts += [(sheet, row + i, col, s) for i, s in enumerate(items) if s is not None]

    def numbers(self, sheet, rows, cols):
        self.blocks.append((sheet, *rows, *cols, False))

    def years(self, sheet, rows, col):
        self.blocks.append((sheet, *rows, col, col, True))

    def cells(self, t):
        k = (F.col("row") * 31 + F.col("col")) % 50 + 1
        sums = t.lineitem.groupBy(F.col("l_returnflag").alias("book"), F.col("l_quantity").cast("int").alias("k")).agg(F.sum("l_linenumber").cast("double").alias("p"))
        books = sums.groupBy("book").agg(F.map_from_entries(F.collect_list(F.struct("k", "p"))).alias("m"))  # 50 quantities
        block = lambda s, r0, r1, c0, c1, y: F.struct(F.lit(s).alias("sheet"), F.lit(r0).alias("r0"), F.lit(r1).alias("r1"), F.lit(c0).alias("c0"), F.lit(c1).alias("c1"), F.lit(y).alias("year"))
        one = lambda s, r, c, x: F.struct(F.lit(s).alias("sheet"), F.lit(r).alias("row"), F.lit(c).alias("col"), F.lit(x).alias("v_str"))
        areas = books.select("book", "m", F.inline(F.array(*[block(*b) for b in self.blocks])))
        numbers = areas.withColumn("row", F.explode(F.sequence("r0", "r1"))).withColumn("col", F.explode(F.sequence("c0", "c1")))
        drawn = F.coalesce(F.try_element_at("m", k), F.lit(0.0)) * 100000 + F.col("row") * 100 + F.col("col")
        value = F.when(F.col("year"), (F.col("row") - F.col("r0") + FIRST_YEAR).cast("double")).otherwise(drawn)
        numbers = numbers.select("book", "sheet", "row", "col", value.alias("v_num"), F.lit(None).cast("string").alias("v_str"))
        texts = books.select("book", F.inline(F.array(*[one(*x) for x in self.texts])))
        texts = texts.select("book", "sheet", "row", "col", F.lit(None).cast("double").alias("v_num"), "v_str")
        return cut_lineage(G.as_cells(numbers.unionByName(texts).withColumn("dtype", F.lit(None).cast("string"))))


def tables(layout: Layout, specs: list[str]):
    """All tables of ``specs`` in one shape: texts packed in order, numbers in order."""

    def run(t):
        cells, out = layout.cells(t), None
        for spec in specs:
            df = run_sheet_spec(cells, spec)
            told = [n for n, kind in df.dtypes if n not in ("book", "row_no") and kind != "double"]
            numbers = [n for n, kind in df.dtypes if kind == "double"]
            values = [F.col(numbers[i]) if i < len(numbers) else F.lit(None).cast("double") for i in range(5)]
            part = df.select(
                F.lit(spec).alias("spec"), "book", F.col("row_no").cast("long").alias("row_no"),
                F.concat_ws("|", *[F.coalesce(F.col(f"`{n}`").cast("string"), F.lit("")) for n in told]).alias("texts"),
                *[v.alias(f"v{i}") for i, v in enumerate(values, 1)])
            out = part if out is None else out.unionByName(part)
        return out

    return run


_BASE = """WITH p AS (SELECT l_returnflag AS book, l_quantity::INT AS k, sum(l_linenumber)::DOUBLE AS p FROM lineitem GROUP BY ALL),
n AS (SELECT b.book, r, c, coalesce(p.p, 0) * 100000 + 100 * r + c AS v FROM (SELECT DISTINCT book FROM p) b CROSS JOIN range(24, 120) x(r) CROSS JOIN range(1, 53) y(c)
  LEFT JOIN p ON p.book = b.book AND p.k = (31 * r + c) % 50 + 1) """


def _quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def wanted(spec: str, *parts) -> str:
    """SQL of one table. A part is (rows, groups[, block]), told in the order block, group, row.

    rows: {row: text before the group's} or (first, last, SQL of that text in r); groups: (text, cells), a cell
    is a column, (column, rows further down), 0 where the table fills a zero.
    """
    out = []
    for rows, groups, *block in parts:
        if isinstance(rows, dict):
            lines = f"(VALUES {', '.join(f'({r}, {_quoted(s)})' for r, s in rows.items())}) s(r, lead)"
        else:
            lines = f"(SELECT r, {rows[2]} AS lead FROM range({rows[0]}, {rows[1] + 1}) z(r)) s"
        for k, (text, cells) in enumerate(groups):
            cells = [c if isinstance(c, tuple) else (c, 0) for c in cells]
            joins = "".join(f" JOIN n n{i} ON n{i}.book = b.book AND n{i}.r = s.r + {d} AND n{i}.c = {c}" for i, (c, d) in enumerate(cells) if c)
            values = ", ".join(f"n{i}.v AS v{i + 1}" if i < len(cells) and cells[i][0] else f"{'0' if i < len(cells) else 'NULL'}::DOUBLE AS v{i + 1}" for i in range(5))
            out.append(f"SELECT b.book, {block[0] if block else 0} AS block, {k} AS k, s.r, s.lead || {_quoted(text)} AS texts, {values} FROM (SELECT DISTINCT book FROM p) b CROSS JOIN {lines}{joins}")
    return (f"SELECT '{spec}' AS spec, book, row_number() OVER (PARTITION BY book ORDER BY block, k, r) AS row_no, texts, v1, v2, v3, v4, v5 FROM ({' UNION ALL '.join(out)})")


def _year(first: int) -> str:
    return f"(r + {FIRST_YEAR - first})::VARCHAR || '|'"


def register(name: str, layout: Layout, sql: dict[str, str]):
    query(name, _BASE + " UNION ALL ".join(sql.values()))(tables(layout, list(sql)))


# --- discount rates, values of time and their forecasts ---------------------------

_v, _sql = Layout(), {}
_bands = {25: "0-30", 26: "31-75", 27: "301 and over"}
_v.across("A1.1.1", 24, 2, ["Years", None, "standard", None, "health"])
_v.down("A1.1.1", 25, 2, [*_bands.values(), "a note"])
_v.numbers("A1.1.1", (25, 27), (4, 4))
_v.numbers("A1.1.1", (25, 27), (6, 6))
_sql["discount_rates"] = wanted("discount_rates", ({25: "0-30|0|30", 26: "31-75|31|75", 27: "301 and over|301|999999"}, [("", [4, 6])]))

_modes = {27 + i: f"mode {i}" for i in range(14)}
_v.down("A1.3.1", 27, 1, _modes.values())
_v.numbers("A1.3.1", (27, 40), (4, 6))
_sql["vot_mode"] = wanted("vot_mode", (_modes, [("", [4, 5, 6])]))
_v.down("A1.3.1", 45, 1, ["Commuting", "Other", "below"])
_v.numbers("A1.3.1", (45, 47), (4, 6))
_sql["vot_purpose"] = wanted("vot_purpose", ({45: "Commuting", 46: "Other"}, [("", [4, 5, 6])]))
_v.down("A1.3.1", 39, 8, ["Parameter", *[f"parameter {i}" for i in range(8)]])
_v.numbers("A1.3.1", (40, 47), (9, 10))
_sql["vot_params"] = (
    "SELECT spec, book, row_no, texts || '|' || v1::BIGINT || '|' || v2::BIGINT, NULL, NULL, NULL, NULL, NULL FROM ("
    + wanted("vot_params", ({40 + i: f"parameter {i}" for i in range(8)}, [("", [9, 10])])) + ")")
_by_band = [(m, *b) for m in ("Car driver", "Rail passenger") for b in (("0-50km", 0, 50), ("50-100km", 50, 100), ("100-200km", 100, 200), ("200+km", 200, 999999))]
_v.down("A1.3.1", 52, 8, [f"{m} {b}" for m, b, *_ in _by_band])
_v.numbers("A1.3.1", (52, 59), (9, 11))
_sql["vot_banded"] = wanted("vot_banded", ({52 + i: "|".join(map(str, b)) for i, b in enumerate(_by_band)}, [("", [9, 10, 11])]))

_v.years("A1.3.2", (27, 106), 2)
_v.numbers("A1.3.2", (27, 106), (4, 51))
_v.across("A1.3.2", 25, 4, [f"class {c}" for c in range(4, 52)])
_v.across("A1.3.2", 26, 4, ["driver" if c % 2 else None for c in range(4, 52)])
for _s, _cols in FORECASTS.items():
    _sql[f"vot_forecast_{_s}"] = wanted(f"vot_forecast_{_s}", ((27, 106, _year(27)), [(f"class {c}" + (" driver" if c % 2 else ""), [c]) for c in _cols]))
register("m34_specs_values", _v, _sql)

# --- occupancy, shares, values per vehicle, bus tables -----------------------------

_v, _sql = Layout(), {}
_purposes = {"Work": "CB", "Commuting": "CC", "Other": "CO", "Average Car": "AVG"}
_v.across("A1.3.3", 25, 4, FULL)
for _r in (27, 32):
    _v.down("A1.3.3", _r, 1, _purposes)
    _v.numbers("A1.3.3", (_r, _r + 3), (4, 10))
_sql["occupancy_car"] = wanted("occupancy_car", *[
    ({27 + i: f"{purpose}|"}, [(f"{period}|{auc}", [4 + k, (4 + k, 5)]) for k, period in enumerate(PERIODS)]) for i, (purpose, auc) in enumerate(_purposes.items())])
_v.down("A1.3.3", 40, 1, ["LGV", None, None, "OGV1", "OGV2", "PSV", None])
_v.down("A1.3.3", 40, 2, ["Work", "Non-work", "Average", "Work", None, "Driver", "Passenger"])
_v.numbers("A1.3.3", (40, 46), (8, 10))
_lead = ["LGV|Work", "LGV|Non-work", "LGV|Average", "OGV1|Work", "OGV2|Work", "PSV|Driver", "PSV|Passenger"]
_sql["occupancy_vehicle"] = wanted("occupancy_vehicle", ({40 + i: f"{s}|" for i, s in enumerate(_lead)}, [(period, [8 + k]) for k, period in enumerate(PERIODS[4:])]))
_v.across("A1.3.3", 49, 4, [*DAY, "Average", "Weekend", "All Week"])
_v.down("A1.3.3", 50, 1, ["Work", "Non-work"])
_v.numbers("A1.3.3", (50, 51), (4, 10))
_sql["occupancy_change"] = wanted("occupancy_change", ({50: "Work|", 51: "Non-work|"}, [(s, [4 + k]) for k, s in enumerate([*PERIODS[:4], "Average", "Weekend", "All Week"])]))

_v.across("A1.3.4", 25, 4, [*DAY, "Weekday", "Weekend", "All Week"])
_v.down("A1.3.4", 27, 1, ["LGV", None, "OGV1", "OGV2", "PSV", None, None])
_v.down("A1.3.4", 27, 2, ["Work", "Other", "Work", None, "Driver", "Work", "Other"])
_v.down("A1.3.4", 35, 1, ["LGV", None, "Rail", None, None, None, "Bus", None, None, None, "Tram", None])
_v.down("A1.3.4", 35, 2, ["Work", "Other"] * 2 + ["Commuting", "All"] + ["Work", "Other", "Commuting", "All", "Work", "Other"])
_v.numbers("A1.3.4", (27, 33), (4, 17))
_v.numbers("A1.3.4", (35, 46), (4, 17))
_first = {29: "OGV1|Work|", 30: "OGV2|Work|", 31: "PSV|Driver|", 32: "PSV|Work|", 33: "PSV|Other|"}
_second = ["Rail|Work", "Rail|Other", "Rail|Commuting", "Rail|All", "Bus|Work", "Bus|Other", "Bus|Commuting", "Bus|All", "Tram|Work", "Tram|Other"]
_columns = list(enumerate(PERIODS, 4))
_sql["travel_share"] = wanted(
    "travel_share",
    ({27: "LGV|Work|", 28: "LGV|Other|"}, [(s, [c, (c, 8), c + 7, (c + 7, 8)]) for c, s in _columns]),
    (_first, [(s, [c, 0, c + 7, 0]) for c, s in _columns]),
    ({37 + i: f"{s}|" for i, s in enumerate(_second)}, [(s, [0, c, 0, c + 7]) for c, s in _columns], 1))

_v.across("A1.3.5", 26, 4, [*DAY, "x", "y", "z"])
_v.down("A1.3.5", 27, 1, ["Car", None, None, None, "LGV", None, "OGV1", "OGV2", "PSV ", "(Occupants)", None, None])
_v.down("A1.3.5", 27, 2, ["Work", "Commuting", "Other", "Average Car", "Work", "Non – Work", "Working", None, "Work", "Commuting", "Other", "All"])
_v.numbers("A1.3.5", (27, 38), (4, 10))
_lead = ["Car|Work", "Car|Commuting", "Car|Other", "Car|Average Car", "LGV|Work", "LGV|Non-Work", "OGV1|Working", "OGV2|Working",
         "PSV (Occupants)|Work", "PSV (Occupants)|Commuting", "PSV (Occupants)|Other", "PSV (Occupants)|All"]
_sql["vot_vehicle"] = wanted("vot_vehicle", ({27 + i: f"{s}|" for i, s in enumerate(_lead)}, [(s, [c]) for c, s in _columns]))

_status = [("Car", "Work", "Pass"), ("Car", "Other", "No pass"), ("No car", "Work", "Pass"), ("No car", "Other", "No pass")]
for _sheet in ("A1.3.16", "A1.3.17"):
    for _i, _s in enumerate(_status):
        _v.across(_sheet, 28 + _i, 1, _s)
_v.numbers("A1.3.16", (28, 31), (4, 9))
_sql["bus_trip_share"] = wanted("bus_trip_share", ({28 + i: "|".join(s) + "|" for i, s in enumerate(_status)}, [(s, [4 + k]) for k, s in enumerate(AREAS)]))
_v.numbers("A1.3.17", (28, 31), (4, 4))
_v.down("A1.3.17", 33, 1, ["a note"])
_sql["bus_not_go"] = wanted("bus_not_go", ({28 + i: "|".join(s) for i, s in enumerate(_status)}, [("", [4])]))
_v.down("A1.3.18", 28, 1, ["Pass", "No pass", "below"])
_v.numbers("A1.3.18", (28, 30), (4, 4))
_sql["bus_social_value"] = wanted("bus_social_value", ({28: "Pass", 29: "No pass"}, [("", [4])]))
register("m34_specs_shares", _v, _sql)

# --- tables with a column per heading of several rows --------------------------------

_v, _sql = Layout(), {}
_v.across("A1.3.6", 24, 3, ["Weekday", None, None, "Weekend", None, None])
_v.across("A1.3.6", 25, 3, ["7am – 10am", "10am – 4pm", None, None, None, None])
_v.across("A1.3.6", 26, 3, ["Car", "Car", "LGV", "Car", None, "LGV"])
_v.across("A1.3.6", 27, 2, ["Year", "Work", "Work", "Work", "Work", "Other", "Other", "Gaps"])
_v.years("A1.3.6", (28, 107), 2)
_v.numbers("A1.3.6", (28, 107), (3, 8))
_v.numbers("A1.3.6", (30, 40), (9, 9))
_heads = ["Weekday|7am-10am|Car|Work", "Weekday|10am-4pm|Car|Work", "Weekday|10am-4pm|LGV|Work", "Weekend|All|Car|Work", "Weekend|All|Car|Other", "Weekend|All|LGV|Other"]
_sql["vot_vehicle_forecast"] = wanted("vot_vehicle_forecast", ((28, 107, _year(28)), [(s, [3 + k]) for k, s in enumerate(_heads)]))

_v.across("A1.3.7", 24, 3, ["Resource", None, "Duty", None])
_v.across("A1.3.7", 25, 3, ["Petrol", "Diesel", "Petrol", "Diesel"])
_v.across("A1.3.7", 26, 3, [None, "Car", "LGV", None])
_v.across("A1.3.7", 27, 2, ["Year", "p/l", "p/l", "p/l", "p/kWh"])
_v.years("A1.3.7", (28, 118), 2)
_v.numbers("A1.3.7", (28, 118), (3, 6))
_heads = ["Resource|Petrol|All|p/l", "Resource|Diesel|Car|p/l", "Duty|Petrol|LGV|p/l", "Duty|Diesel|All|p/kWh"]
_sql["fuel_prices"] = wanted("fuel_prices", ((28, 118, _year(28)), [(s, [3 + k]) for k, s in enumerate(_heads)]))

_v.across("A1.3.9", 24, 3, ["Cars", None, None, "LGV", None])
_v.across("A1.3.9", 25, 2, ["Year", "Petrol", "Diesel", "Electric", "Diesel", "Electric"])
_v.years("A1.3.9", (26, 72), 2)
_v.numbers("A1.3.9", (26, 72), (3, 7))
_heads = ["Cars|Petrol", "Cars|Diesel", "Cars|Electric", "LGV|Diesel", "LGV|Electric"]
_sql["fleet_share"] = wanted("fleet_share", ((26, 72, _year(26)), [(s, [3 + k]) for k, s in enumerate(_heads)]))

_v.across("A1.3.10", 25, 3, ["Cumulative change", None, None, "Annual", None])
_v.across("A1.3.10", 26, 3, ["Car", None, "LGV", "Car", "LGV"])
_v.across("A1.3.10", 27, 1, ["From", "To Year", "Petrol", "Petrol", "Diesel", "Petrol", "Diesel"])
_v.down("A1.3.10", 28, 1, [f"{FIRST_YEAR - 1 + i} to" for i in range(44)])
_v.years("A1.3.10", (28, 71), 2)
_v.numbers("A1.3.10", (28, 71), (3, 7))
_heads = [("Cumulative|Car|Petrol", [3]), ("Cumulative|LGV|Diesel", [5]), ("Annual|Car|Petrol", [6]), ("Annual|LGV|Diesel", [7])]
_sql["efficiency"] = wanted("efficiency", ((28, 71, f"(r + {FIRST_YEAR - 29})::VARCHAR || '|' || {_year(28)}"), _heads))

_v.years("A1.3.15", (26, 61), 2)
_v.numbers("A1.3.15", (26, 61), (4, 9))
_sql["nonfuel_cost_forecast"] = wanted("nonfuel_cost_forecast", ((26, 61, _year(26)), [("Average|Car", [8, 9]), ("Non-work|Car", [6, 7]), ("Work|Car", [4, 5])]))
register("m34_specs_yearly", _v, _sql)

# --- consumption and cost curves -------------------------------------------------------

_v, _sql = Layout(), {}
_kinds = {27 + i: f"type {i}" for i in range(7)}
_v.down("A1.3.8", 27, 1, _kinds.values())
_v.numbers("A1.3.8", (27, 33), (4, 8))
_v.numbers("A1.3.8", (28, 29), (9, 9))
_rail = {36 + i: f"rail {i}" for i in range(4)}
_v.down("A1.3.8", 36, 1, _rail.values())
_v.numbers("A1.3.8", (36, 39), (4, 7))
_sql["fuel_consumption"] = wanted("fuel_consumption", (_kinds, [("", [4, 5, 6, 7, 8])]), (_rail, [("", [4, 5, 6, 7, 0])], 1))

_v.across("A1.3.11", 24, 4, ["Cars", None, None, None, "LGV", None, None, None, "Average Car1"])
_v.across("A1.3.11", 25, 2, ["Year", None, *ABCD * 3])
_v.years("A1.3.11", (26, 105), 2)
_v.numbers("A1.3.11", (26, 105), (4, 6))
_v.numbers("A1.3.11", (26, 105), (8, 15))
_sql["consumption_forecast"] = wanted("consumption_forecast", ((26, 105, _year(26)), [("Average Car", [12, 13, 14, 15]), ("Cars", [4, 5, 6, 0]), ("LGV", [8, 9, 10, 11])]))

for _sheet, _top, _low in (
    ("A1.3.12", ["Cars", None, None, None, "OGV"], ["Average Car1", None, None, None, "OGV1 Diesel", None, None, None, "OGV2 Diesel"]),
    ("A1.3.13", ["Cars", None, None, None, None, None, None, None, "LGV"], ["Petrol", None, None, None, "Electric", None, None, None, "Diesel"]),
):
    _v.across(_sheet, 24, 4, _top)
    _v.across(_sheet, 25, 4, _low)
    _v.across(_sheet, 26, 2, ["Year", None, *ABCD * 3])
    _v.years(_sheet, (27, 106), 2)
    _v.numbers(_sheet, (27, 106), (4, 5))
    _v.numbers(_sheet, (27, 106), (7, 15))
_sql["fuel_cost_work"] = wanted("fuel_cost_work", ((27, 106, _year(27)), [("Car|Average", [4, 5, 0, 7]), ("OGV1|Diesel", [8, 9, 10, 11]), ("OGV2|Diesel", [12, 13, 14, 15])]))
_sql["fuel_cost_nonwork"] = wanted("fuel_cost_nonwork", ((27, 106, _year(27)), [("Car|Electric", [8, 9, 10, 11]), ("Car|Petrol", [4, 5, 0, 7]), ("LGV|Diesel", [12, 13, 14, 15])]))

_v.down("A1.3.14", 27, 1, ["Car", None, None, "LGV", None, None, None, "OGV1", "OGV2", "PSV", None, None, None])
_v.down("A1.3.14", 27, 2, ["Work Petrol", "Work Diesel", "Non-work Electic", "Work", "Work Electic", "Non-work", None, "Work", None, "Work", None, "Non-work", None])
_v.numbers("A1.3.14", (27, 39), (4, 5))
_lead = ["Car|Work|Petrol", "Car|Work|Diesel", "Car|Non-work|Electric", "LGV|Work|Non-electric", "LGV|Work|Electric", "LGV|Non-work|Non-electric", "LGV|Non-work|Non-electric",
         "OGV1|Work|All", "OGV2|Work|All", "PSV|Work|All", "PSV|Work|All", "PSV|Non-work|All", "PSV|Non-work|All"]
_sql["nonfuel_cost"] = wanted("nonfuel_cost", ({27 + i: s for i, s in enumerate(_lead)}, [("", [4, 5])]))
register("m34_specs_curves", _v, _sql)
