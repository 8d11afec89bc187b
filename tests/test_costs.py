"""Derived parameters worked by hand on one small set of tables."""

import pytest
from pyspark.sql import functions as F

from gridspark.plans import costs as X


@pytest.fixture(scope="module")
def tables(spark):
    tp = "Average Weekday"
    vot = [(i, m, p, tp, v) for i, (m, p, v) in enumerate([("Car", "Work", 23.8), ("Car", "Commuting", 18.0), ("Car", "Other", 9.0), ("LGV", "Work (freight)", 20.0), ("LGV", "Commuting & Other", 10.0), ("OGV1", "Working", 12.0), ("OGV2", "Working", 15.0)])]
    return {
        "vot": spark.createDataFrame(vot, "row_no int, Mode string, Journey_Purpose string, Time_Period string, Market_Price_Value_of_Time_Per_Vehicle double"),
        "share": spark.createDataFrame([(1, "LGV", "Work (freight)", tp, 88.0), (2, "LGV", "Non-Work", tp, 12.0)], "row_no int, Mode string, Journey_Purpose string, Time_Period string, Percentage_of_Vehicle_Trips double"),
        "work": spark.createDataFrame([(i, 2021, v, "Average", 65.0, 1.0, 0.0, 0.0) for i, v in enumerate(["Car", "LGV", "OGV1", "OGV2"])], "row_no int, Year int, Vehicle_Type string, Fuel_Type string, Param_a double, Param_b double, Param_c double, Param_d double"),
        "nonwork": spark.createDataFrame([(9, 2021, "Car", "Petrol", 0.0, 99.0, 0.0, 0.0), (4, 2021, "Car", "Average", 54.0, 2.0, 0.0, 0.0), (5, 2021, "LGV", "Average", 54.0, 2.0, 0.0, 0.0)],
                                         "row_no int, Year int, Vehicle_Type string, Fuel_Type string, Param_a double, Param_b double, Param_c double, Param_d double"),
        "nonfuel": spark.createDataFrame([(1, v, "Work", f, 4.0, 65.0 if v != "LGV" else 54.0) for v, f in [("LGV", "Non-electric"), ("LGV", "Electric"), ("OGV1", "All"), ("OGV2", "All")]], "row_no int, Vehicle_Type string, Trip_Purpose string, Fuel_Type string, Param_a1 double, Param_b1 double"),
        "forecast": spark.createDataFrame([(1, 2021, "Work", "Car", 3.0, 130.0)], "row_no int, Year int, Trip_Purpose string, Vehicle_Type string, Param_a1 double, Param_b1 double"),
        "fleet": spark.createDataFrame([(1, 2021, "LGV", "Electric", 0.25)], "row_no int, Year int, Mode string, Fuel_Type string, Value double"),
    }


def derive(t, p):
    vot = X.vot_final(p, X.vot_interim(p, t["vot"]), t["share"])
    voci = X.voc_interim(X.voc_parameters(p, t["work"], t["nonwork"], t["nonfuel"], t["forecast"]))
    return vot, voci, X.voc_final(p, voci, t["share"], t["fleet"])


def test_value_of_time(spark, tables):
    vot, _, _ = derive(tables, X.params(spark))
    got = {r["AUC"]: r["Value_of_Time_Per_Vehicle"] for r in vot.filter("Time_Period = 'Average Weekday'").collect()}
    assert got == pytest.approx({"CB": 20.0, "CC": 18.0, "CO": 9.0, "LGV": 0.88 * 20 + 0.12 * 10, "HGV": 2.5 * (0.4 * 12 + 0.6 * 15)})
    assert vot.filter("AUC = 'CC' and Time_Period = 'Average Weekday'").first()["VOT_pence_per_sec"] == 0.5
    assert vot.filter("Time_Period = '7am-10am'").filter("Value_of_Time_Per_Vehicle is not null").count() == 0


def test_operating_cost(spark, tables):
    _, voci, voc = derive(tables, X.params(spark))
    rows = {(r["AUC"], r["Trip_Purpose"], r["Fuel_Type"], r["Vehicle_Type"]): r for r in voci.collect()}
    assert len(rows) == 9
    assert rows["CC", "Non-Work", "All", "Car"]["VOC_f"] == 3.0  # the first row by number, not by place
    got = {r["AUC"]: (r["VOC_f"], r["VOC_nf"]) for r in voc.collect()}
    assert got["CB"] == pytest.approx((2.0, 5.0)) and got["CC"] == pytest.approx((3.0, 0.0))
    lgv_work = 65 / 54 + 1
    assert got["LGV"] == pytest.approx((0.88 * lgv_work + 0.12 * 3.0, 0.88 * 5.0))
    assert got["HGV"] == pytest.approx((2.0, 5.0))


def test_impedance(spark, tables):
    vot, _, voc = derive(tables, X.params(spark))
    coef = X.impedance(vot, voc)
    cc = coef.filter("AUC = 'CC'").first()
    assert (cc["DIST"], cc["TIME"], cc["TOLL"]) == pytest.approx((0.003 / 0.5, 1.0, 2.0))
    wide = X.impedance_scalars(coef).first()
    assert wide["CC_IMP_TOLL"] == pytest.approx(2.0) and wide["HGV_IMP_TIME"] == 1.0


def test_network_speed_replaces_the_default(spark, tables):
    p = X.params(spark, {"override_speed": False})
    trips = spark.createDataFrame([("CB", 2, 100.0, 2.0), ("CB", 2, 30.0, 0.6), ("CB", 1, 5.0, 5.0)], "AUC string, iteration int, veh_km double, veh_hours double")
    pars = X.voc_parameters(p, tables["work"], tables["nonwork"], tables["nonfuel"], tables["forecast"])
    row = X.voc_interim(pars, X.avg_speed(trips, p, X.IMPEDANCE_CLASSES)).filter("AUC = 'CB'").first()
    assert row["Used_Avg_Speed"] == 50.0 and row["VOC_f"] == pytest.approx(65 / 50 + 1)


def test_fuel_polynomial(spark):
    c = [F.lit(x) for x in (10.0, 1.0, 0.1, 0.01, 10.0)]
    assert spark.range(1).select(X.fuel_cost(*c)).first()[0] == pytest.approx(4.0)


def test_parameters(spark):
    with pytest.raises(ValueError, match="unknown"):
        X.params(spark, {"colour": 1})
    r = X.params(spark, {"model_tp": "Average Weekend", "scenario": "s"}).first()
    assert r["model_tp"] == "Weekend Average" and r["scenario"] == "s" and r["ogv1"] == 0.4


def test_scenarios_share_one_plan(spark, tables):
    p = X.params(spark, {"scenario": "a"}, {"scenario": "b", "hgv_vot_factor": 5.0}, {"scenario": "c", "model_year": 1900})
    vot, _, voc = derive(tables, p)
    hgv = {r["scenario"]: r["Value_of_Time_Per_Vehicle"] for r in vot.filter("AUC = 'HGV' and Time_Period = 'Average Weekday'").collect()}
    assert hgv["b"] == pytest.approx(2 * hgv["a"])
    assert voc.filter("scenario = 'c' and VOC_f is not null").count() == 0
