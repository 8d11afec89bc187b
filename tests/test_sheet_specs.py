"""The parameter-sheet specs on small hand-made sheets."""

import pytest

from gridspark.plans.sheet_specs import DAY, FULL, SPECS, run_sheet_spec, to_wide
from gridspark.sources.ooxml import letters


def put(values, sheet, first, row, items):
    """Write items rightwards from column number ``first``."""
    for i, v in enumerate(items):
        if v is not None:
            values[(sheet, f"{letters(first + i)}{row}")] = v


def got(df, *cols):
    return [tuple(r[c] for c in cols) for r in df.orderBy("row_no").collect()]


def test_discount_rates(make_cells):
    v = {}
    put(v, "A1.1.1", 2, 24, ["x", None, "standard", None, "health"])
    for row, (years, a, b) in enumerate([("0-30", 0.035, 0.015), ("31-75", 0.03, 0.0129), ("301 and over", 0.01, 0.007)], 25):
        put(v, "A1.1.1", 2, row, [years, None, a, None, b])
    put(v, "A1.1.1", 2, 28, ["a note"])
    out = run_sheet_spec(make_cells(v), "discount_rates")
    assert got(out, "row_no", "Years_from_current_year", "Lower_Bound", "Upper_Bound", "Discount_rate_standard") == [
        (1, "0-30", 0, 30, 0.035), (2, "31-75", 31, 75, 0.03), (3, "301 and over", 301, 999999, 0.01)]


def test_banded_values(make_cells):
    v = {}
    for row, label in enumerate(["Car driver 0-50km", "Car driver 50-100km", "Rail passenger 200+km"], 52):
        put(v, "A1.3.1", 8, row, [label, 1.5, 2, 3])
    out = run_sheet_spec(make_cells(v), "vot_banded")
    assert got(out, "Mode", "Distance_Band", "Lower_Bound", "Upper_Bound", "Market_Price") == [
        ("Car driver", "0-50km", 0, 50, 3.0), ("Car driver", "50-100km", 50, 100, 3.0), ("Rail passenger", "200+km", 200, 999999, 3.0)]


def test_forecast_header_of_two_rows(make_cells):
    v = {}
    put(v, "A1.3.2", 20, 25, ["Car", "LGV"])
    put(v, "A1.3.2", 20, 26, ["driver"])
    for i, year in enumerate((2010, 2011)):
        put(v, "A1.3.2", 2, 27 + i, [year])
        put(v, "A1.3.2", 20, 27 + i, [10.0 + i, 20.0 + i])
    out = run_sheet_spec(make_cells(v), "vot_forecast_c")
    assert got(out, "Year", "Label", "Value") == [(2010, "Car driver", 10.0), (2011, "Car driver", 11.0), (2010, "LGV", 20.0), (2011, "LGV", 21.0)]
    assert to_wide(out, ["Car driver"]).filter("Year = 2011").first()["Car driver"] == 11.0


def test_car_occupancy_joins_two_blocks(make_cells):
    v = {}
    put(v, "A1.3.3", 4, 25, FULL)
    for base in (27, 32):
        for i, purpose in enumerate(["Work", "Commuting", "Other", "Average Car"]):
            put(v, "A1.3.3", 1, base + i, [purpose])
            put(v, "A1.3.3", 4, base + i, [base + i + k / 10 for k in range(7)])
    out = run_sheet_spec(make_cells(v), "occupancy_car")
    rows = got(out, "row_no", "Journey_Purpose", "Time_Period", "Occupancy_Per_VehKm", "Occupancy_Per_Trip", "AUC")
    assert len(rows) == 28
    assert rows[0] == (1, "Work", "7am-10am", 27.0, 32.0, "CB")
    assert rows[5] == (6, "Commuting", "10am-4pm", 28.1, 33.1, "CC")


def test_travel_share_fills_down_and_joins_outer(make_cells):
    v = {}
    put(v, "A1.3.4", 4, 25, DAY + ["Weekday", "Weekend", "All Week"])
    put(v, "A1.3.4", 1, 27, ["LGV", "Work (freight)"])
    put(v, "A1.3.4", 1, 28, [None, "Non – Work"])
    put(v, "A1.3.4", 1, 35, ["LGV", "Work (freight)"])
    put(v, "A1.3.4", 1, 36, ["Rail", "Work"])
    for row in (27, 28, 35, 36):
        put(v, "A1.3.4", 4, row, [row + k for k in range(14)])
    out = run_sheet_spec(make_cells(v), "travel_share")
    rows = {(r["Mode"], r["Journey_Purpose"], r["Time_Period"]): r for r in out.collect()}
    assert len(rows) == 21
    r = rows[("LGV", "Non-Work", "Average Weekday")]
    assert (r["Percentage_of_Distance_Travelled_by_Vehicles"], r["Percentage_of_Vehicle_Trips"], r["Percentage_of_Person_Trips"]) == (32.0, 39.0, 0.0)
    assert rows[("Rail", "Work", "7am-10am")]["Percentage_of_Vehicle_Trips"] == 0.0


def test_time_values_per_vehicle(make_cells):
    v = {}
    put(v, "A1.3.5", 4, 26, DAY + ["x", "y", "z"])
    for row, (mode, purpose) in enumerate([("Car", "Work"), (None, "Commuting"), ("PSV ", "Work"), ("(Occupants)", "Other")], 27):
        put(v, "A1.3.5", 1, row, [mode, purpose])
        put(v, "A1.3.5", 4, row, [row + k for k in range(7)])
    out = run_sheet_spec(make_cells(v), "vot_vehicle")
    rows = got(out, "Mode", "Journey_Purpose", "Time_Period", "Market_Price_Value_of_Time_Per_Vehicle")
    assert rows[:4] == [("Car", "Work", "7am-10am", 27.0), ("Car", "Commuting", "7am-10am", 28.0), ("PSV (Occupants)", "Work", "7am-10am", 29.0), ("PSV (Occupants)", "Other", "7am-10am", 30.0)]
    assert rows[16][2] == "Average Weekday"


def test_header_of_four_rows(make_cells):
    v = {}
    put(v, "A1.3.6", 2, 24, [None, "Weekday", None, "Weekend"])
    put(v, "A1.3.6", 2, 25, [None, "7am – 10am"])
    put(v, "A1.3.6", 2, 26, [None, "Car", "LGV", "Car"])
    put(v, "A1.3.6", 2, 27, ["Year", "Work", "Work", "Other"])
    for i in range(80):
        put(v, "A1.3.6", 2, 28 + i, [2010 + i, i, i + 0.5, i + 0.25])
    put(v, "A1.3.6", 6, 30, ["stray"])
    out = run_sheet_spec(make_cells(v), "vot_vehicle_forecast")
    rows = got(out.filter("Year = 2012"), "Day_Type", "Time_Period", "Mode", "Journey_Purpose", "Market_Price_Value_of_Time_Per_Vehicle")
    assert rows == [("Weekday", "7am-10am", "Car", "Work", 2.0), ("Weekday", "7am-10am", "LGV", "Work", 2.5), ("Weekend", "All", "Car", "Other", 2.25)]
    assert out.count() == 240


def test_fuel_consumption_stacks_two_blocks(make_cells):
    v = {}
    put(v, "A1.3.8", 1, 25, ["Vehicle", None, None, "Max speed", "Parameters"])
    put(v, "A1.3.8", 1, 26, ["Vehicle Category", None, None, "kph", "a", "b", "c", "d"])
    for i in range(7):
        put(v, "A1.3.8", 1, 27 + i, [f"type {i}", None, None, 140 + i, 1, 2, 3, 4])
    put(v, "A1.3.8", 1, 36, ["rail", None, None, 200, 9])
    out = run_sheet_spec(make_cells(v), "fuel_consumption")
    rows = got(out, "Vehicle_Category", "Max_speed_kph", "Param_a", "Param_d")
    assert rows[0] == ("type 0", 140.0, 1.0, 4.0) and rows[-1] == ("rail", 200.0, 9.0, 0.0) and len(rows) == 8


def test_efficiency_keeps_first_of_equal_columns(make_cells):
    v = {}
    put(v, "A1.3.10", 1, 25, [None, None, "Cumulative change", None, "Annual"])
    put(v, "A1.3.10", 1, 26, [None, None, "Car", None, "Car"])
    put(v, "A1.3.10", 1, 27, ["From", "To Year", "Petrol", "Petrol", "Petrol"])
    for i in range(44):
        put(v, "A1.3.10", 1, 28 + i, [f"{2010 + i} to", 2011 + i, i, -1, i / 2])
    out = run_sheet_spec(make_cells(v), "efficiency")
    assert out.count() == 88
    assert got(out.filter("FromYear = 2014"), "FromYear", "ToYear", "Change", "Mode", "Fuel_Type", "Value") == [
        (2014, 2015, "Cumulative", "Car", "Petrol", 4.0), (2014, 2015, "Annual", "Car", "Petrol", 2.0)]


def test_fuel_cost_curves(make_cells):
    v = {}
    put(v, "A1.3.12", 2, 24, [None, None, "Cars", None, None, None, "OGV"])
    put(v, "A1.3.12", 2, 25, [None, None, "Average Car1", None, None, None, "OGV1 Diesel"])
    put(v, "A1.3.12", 2, 26, ["Year", "Year", "a", "b", "c", "d", "a", "b", "c", "d"])
    for i in range(80):
        put(v, "A1.3.12", 2, 27 + i, [2010 + i, "x", 1 + i, 2, None, 4, 5, 6, 7, 8])
    out = run_sheet_spec(make_cells(v), "fuel_cost_work")
    cols = ["Year", "Vehicle_Type", "Fuel_Type", "Param_a", "Param_b", "Param_c", "Param_d"]
    assert got(out.filter("Year = 2011"), *cols) == [(2011, "Car", "Average", 2.0, 2.0, 0.0, 4.0), (2011, "OGV1", "Diesel", 5.0, 6.0, 7.0, 8.0)]
    assert out.count() == 160


def test_nonfuel_cost(make_cells):
    v = {}
    put(v, "A1.3.14", 1, 26, ["Vehicle Category", "Purpose", None, "a1", "b1"])
    for i, (kind, label) in enumerate([("LGV", "Work"), (None, "Work Electic"), ("OGV1", "Work")]):
        put(v, "A1.3.14", 1, 27 + i, [kind, label, None, 1.5 + i, 2.5 + i])
    out = run_sheet_spec(make_cells(v), "nonfuel_cost")
    assert got(out, "Vehicle_Type", "Trip_Purpose", "Fuel_Type", "Param_a1", "Param_b1") == [
        ("LGV", "Work", "Non-electric", 1.5, 2.5), ("LGV", "Work", "Electric", 2.5, 3.5), ("OGV1", "Work", "All", 3.5, 4.5)]


def test_bus_tables(make_cells):
    v = {}
    put(v, "A1.3.16", 1, 28, ["Car", "Work", "Pass", 1, 2, 3, 4, 5, 6])
    put(v, "A1.3.16", 1, 29, ["No car", "Work", "No pass", 1])
    put(v, "A1.3.17", 1, 28, ["Car", "Work", "Pass", 0.4])
    put(v, "A1.3.17", 1, 29, ["note"])
    put(v, "A1.3.18", 1, 28, ["Pass", None, None, 3.5])
    cells = make_cells(v)
    assert len(got(run_sheet_spec(cells, "bus_trip_share"), "Area")) == 7
    assert got(run_sheet_spec(cells, "bus_not_go"), "HH_car_ownership", "Proportion_not_go") == [("Car", 0.4)]
    assert got(run_sheet_spec(cells, "bus_social_value"), "Concessionary_travel_pass_status", "Value") == [("Pass", 3.5)]


@pytest.mark.parametrize("name", sorted(SPECS))
def test_every_spec_plans_for_many_books(name, make_cells):
    a = make_cells({("none", "A1"): 1.0}, "one")
    out = run_sheet_spec(a.unionByName(make_cells({("none", "A1"): 1.0}, "two")), name)
    assert out.columns[:2] == ["book", "row_no"] or {"book", "row_no"} <= set(out.columns)
