"""Economic parameters: values of time, operating costs, impedance, applied to facts.

Every derivation takes its model parameters as a DataFrame with one row per
scenario, so one year or a thousand run through the same plan. Class rows come
from fixed lists, which bounds every derived table by scenarios x classes x
periods; only such tables are broadcast to the facts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridspark.functions.scalars import normalise
from gridspark.scale import whole
from gridspark.operators.reshape import band_join, lookup_first, recode

# Time periods, and the class rows of each derived table.
PERIODS = ["7am-10am", "10am-4pm", "4pm-7pm", "7pm-7am", "Average Weekday", "Weekend Average", "All Week Average"]
VOT_INTERIM_CLASSES = [
    ("CB", "Car", "Work"),
    ("CC", "Car", "Commuting"),
    ("CO", "Car", "Other"),
    ("LGV", "LGV", "Work (freight)"),
    ("LGV", "LGV", "Commuting & Other"),
    ("HGV", "OGV1", "Working"),
    ("HGV", "OGV2", "Working"),
]
VOT_FINAL_CLASSES = [
    ("CB", "Car", "Work"),
    ("CC", "Car", "Commuting"),
    ("CO", "Car", "Other"),
    ("LGV", "LGV", "Average LGV"),
    ("HGV", "HGV", "Working"),
]
VOC_INTERIM_CLASSES = [
    ("CB", "Car", "Work", "All", 65.0),
    ("CC", "Car", "Non-Work", "All", 54.0),
    ("CO", "Car", "Non-Work", "All", 54.0),
    ("LGV", "LGV", "Work", "Non-electric", 54.0),
    ("LGV", "LGV", "Work", "Electric", 54.0),
    ("LGV", "LGV", "Non-Work", "Non-electric", 54.0),
    ("LGV", "LGV", "Non-Work", "Electric", 54.0),
    ("HGV", "OGV1", "Work", "All", 65.0),
    ("HGV", "OGV2", "Work", "All", 65.0),
]
VOC_FINAL_CLASSES = [
    ("CB", "Car", "Work"),
    ("CC", "Car", "Non-Work"),
    ("CO", "Car", "Non-Work"),
    ("LGV", "LGV", "Average LGV"),
    ("HGV", "HGV", "Work"),
]
CAR_CLASSES = ["CB", "CC", "CO"]
IMPEDANCE_CLASSES = ["CB", "CC", "CO", "LGV", "HGV"]
TERMS = ["DIST", "TIME", "TOLL"]
# Model parameters and their defaults.
DEFAULTS = {
    "model_year": 2021,
    "model_tp": "Average Weekday",
    "conv_iter": 2,
    "ogv1": 0.4,
    "ogv2": 0.6,
    "hgv_vot_factor": 2.5,
    "override_speed": True,
    "tax_correction": 1.19,
}
PERIOD_ALIASES = {"Average Weekend": "Weekend Average"}


def params(spark: SparkSession, *scenarios: dict) -> DataFrame:
    """Parameter rows: the defaults overlaid with each scenario's overrides."""
    rows = []
    for i, over in enumerate(scenarios or ({},)):
        unknown = set(over) - set(DEFAULTS) - {"scenario"}
        if unknown:
            raise ValueError(f"unknown parameters {sorted(unknown)}")
        rows.append({"scenario": str(i), **DEFAULTS, **over})
    fields = [
        F.struct(*[F.lit(r[n]).alias(n) for n in ["scenario", *DEFAULTS]])
        for r in rows
    ]
    out = spark.range(1).select(F.inline(F.array(*fields)))
    return out.withColumn("model_tp", recode(normalise(F.col("model_tp")), PERIOD_ALIASES))


def class_rows(p: DataFrame, rows: list[tuple], names: list[str], periods: bool = False) -> DataFrame:
    """Each scenario with every class row, and with every period when asked."""
    items = F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(names, r)]) for r in rows])
    out = p.select("*", F.inline(items))
    if periods:
        out = out.withColumn("Time_Period", F.explode(F.array(*[F.lit(x) for x in PERIODS])))
    return out


def _complete_sum(value: Column) -> Column:
    """Sum that is NULL when any part is missing."""
    return F.when(F.count(value) == F.count(F.lit(1)), F.sum(value))


def discount_factor(schedule: DataFrame, rates: list[str], horizon: int, base_year: int) -> DataFrame:
    """Factor per year from ``base_year``: product of 1/(1 + rate) over the years so far.

    schedule(Lower_Bound, Upper_Bound, <rates>) gives the rate of the n-th year;
    one small row per year of the horizon.
    """
    from pyspark.sql import Window

    spine = schedule.sparkSession.range(0, horizon + 1).select(F.col("id").cast("int").alias("n"))
    bands = schedule.select(F.col("Lower_Bound").alias("lower"), F.least("Upper_Bound", F.lit(horizon)).alias("upper"), *rates).filter("lower <= upper")
    yearly = band_join(spine, "n", bands, width=100, how="inner")
    so_far = Window.partitionBy().orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    factors = [
        F.exp(-F.sum(F.when(F.col("n") > 0, F.log1p(F.col(r))).otherwise(0.0)).over(so_far)).alias(f"factor_{i}")
        for i, r in enumerate(rates)
    ]
    return yearly.select((F.col("n") + base_year).alias("year"), *factors)


def vot_interim(p: DataFrame, vot_vehicle: DataFrame) -> DataFrame:
    """Perceived value of time per class and period; work is reduced by the tax correction."""
    rows = class_rows(p, VOT_INTERIM_CLASSES, ["AUC", "Vehicle_Type", "Journey_Purpose"], periods=True)
    found = lookup_first(
        rows, vot_vehicle, {"Vehicle_Type": "Mode", "Journey_Purpose": "Journey_Purpose", "Time_Period": "Time_Period"},
        ["Market_Price_Value_of_Time_Per_Vehicle"], bounded=rows,
    )
    divisor = F.when(F.col("Journey_Purpose") == "Work", F.col("tax_correction")).otherwise(F.lit(1.0))
    return found.withColumn("Value_of_Time_Per_Vehicle", F.col("Market_Price_Value_of_Time_Per_Vehicle") / divisor).drop(
        "Market_Price_Value_of_Time_Per_Vehicle"
    )


def _shares(p: DataFrame, travel_share: DataFrame) -> DataFrame:
    """Per scenario the goods-van shares of work and non-work trips in its model period."""
    van = travel_share.filter(normalise(F.col("Mode")) == "LGV").withColumn("model_tp", normalise(F.col("Time_Period")))
    purpose = normalise(F.col("Journey_Purpose"))
    first = lambda name: F.min_by("Percentage_of_Vehicle_Trips", F.when(purpose == name, F.col("row_no")))
    asked = p.select("scenario", "model_tp")
    now = van.join(F.broadcast(asked.select("model_tp")), "model_tp", "left_semi").groupBy("model_tp").agg(
        first("Work (freight)").alias("work_share"), first("Non-Work").alias("nonwork_share")
    )
    # at most one row per period asked for
    return asked.join(F.broadcast(now), "model_tp", "left").drop("model_tp")


def vot_final(p: DataFrame, interim: DataFrame, travel_share: DataFrame) -> DataFrame:
    """Value of time per assignment class: vans weighted by share, heavy goods by class mix."""
    weighted = interim.join(F.broadcast(_shares(p, travel_share)), "scenario")
    purpose, kind = F.col("Journey_Purpose"), F.col("Vehicle_Type")
    weight = (
        F.when(purpose == "Work (freight)", F.col("work_share") / 100)
        .when(purpose == "Commuting & Other", F.col("nonwork_share") / 100)
        .when(kind == "OGV1", F.col("hgv_vot_factor") * F.col("ogv1"))
        .when(kind == "OGV2", F.col("hgv_vot_factor") * F.col("ogv2"))
        .otherwise(F.lit(1.0))
    )
    out = weighted.groupBy("scenario", "model_tp", "AUC", "Time_Period").agg(
        _complete_sum(weight * F.col("Value_of_Time_Per_Vehicle")).alias("Value_of_Time_Per_Vehicle")
    )
    return out.withColumn("VOT_pence_per_sec", F.col("Value_of_Time_Per_Vehicle") / 36)


def avg_speed(assignment: DataFrame, p: DataFrame, classes: list[str] | None = None) -> DataFrame:
    """Network speed per scenario and class: vehicle-km over vehicle-hours of the asked iteration.

    assignment(AUC, iteration, veh_km, veh_hours) may be of any size; it is
    reduced per class and iteration before it meets the parameters, and cut to
    the known classes and the iterations asked for.
    """
    known = assignment.filter(F.col("AUC").isin(classes)) if classes else assignment
    per = known.groupBy("AUC", "iteration").agg(F.sum("veh_km").alias("__km"), F.sum("veh_hours").alias("__h"))
    speed = per.join(F.broadcast(p.select("scenario", F.col("conv_iter").alias("iteration"))), "iteration")
    return speed.select("scenario", "AUC", F.try_divide("__km", "__h").alias("net_speed"))


def fuel_cost(a: Column, b: Column, c: Column, d: Column, v: Column) -> Column:
    return F.try_divide(a, v) + b + c * v + d * v * v


def nonfuel_cost(a1: Column, b1: Column, v: Column) -> Column:
    return a1 + F.try_divide(b1, v)


def voc_parameters(p: DataFrame, fuel_work: DataFrame, fuel_nonwork: DataFrame, nonfuel: DataFrame, nonfuel_forecast: DataFrame) -> DataFrame:
    """The nine operating-cost rows of every scenario with their fuel and non-fuel parameters."""
    rows = class_rows(p, VOC_INTERIM_CLASSES, ["AUC", "Vehicle_Type", "Trip_Purpose", "Fuel_Type", "Override_Avg_Net_Speed_kph"])
    rows = rows.withColumn("__avg", F.lit("Average"))
    work = F.col("Trip_Purpose") == "Work"
    four, two = ["Param_a", "Param_b", "Param_c", "Param_d"], ["Param_a1", "Param_b1"]

    def renamed(df: DataFrame, names: list[str], tag: str) -> DataFrame:
        return df.withColumnsRenamed({n: f"__{tag}_{n}" for n in names})

    out = lookup_first(rows, fuel_work, {"model_year": "Year", "Vehicle_Type": "Vehicle_Type", "__avg": "Fuel_Type"}, four, bounded=rows)
    out = renamed(out, four, "w")
    out = renamed(lookup_first(out, fuel_nonwork, {"model_year": "Year", "Vehicle_Type": "Vehicle_Type"}, four, bounded=rows), four, "n")
    out = renamed(lookup_first(out, nonfuel, {"Vehicle_Type": "Vehicle_Type", "Trip_Purpose": "Trip_Purpose", "Fuel_Type": "Fuel_Type"}, two, bounded=rows), two, "g")
    out = renamed(lookup_first(out, nonfuel_forecast, {"Vehicle_Type": "Vehicle_Type", "Trip_Purpose": "Trip_Purpose", "model_year": "Year"}, two, bounded=rows), two, "c")
    made = {n: F.when(work, F.col(f"__w_{n}")).otherwise(F.col(f"__n_{n}")) for n in four}
    made |= {
        n: F.when(F.col("Trip_Purpose") == "Non-Work", F.lit(0.0))
        .when(F.col("Vehicle_Type") == "Car", F.col(f"__c_{n}"))
        .otherwise(F.col(f"__g_{n}"))
        for n in two
    }
    helpers = [f"__{t}_{n}" for t in "wn" for n in four] + [f"__{t}_{n}" for t in "gc" for n in two]
    return out.withColumns(made).drop("__avg", *helpers)


def voc_interim(parameters: DataFrame, speeds: DataFrame | None = None) -> DataFrame:
    """Fuel and non-fuel cost per row at the override speed or the network's own."""
    own = F.lit(None).cast("double")
    rows = parameters
    if speeds is not None:
        rows, own = parameters.join(speeds, ["scenario", "AUC"], "left"), F.col("net_speed")
    used = F.when(F.col("override_speed"), F.col("Override_Avg_Net_Speed_kph")).otherwise(own)
    v = F.col("Used_Avg_Speed")
    return rows.withColumn("Used_Avg_Speed", used).withColumns(
        {
            "VOC_f": fuel_cost(*[F.col(f"Param_{x}") for x in "abcd"], v),
            "VOC_nf": nonfuel_cost(F.col("Param_a1"), F.col("Param_b1"), v),
        }
    )


def voc_final(p: DataFrame, interim: DataFrame, travel_share: DataFrame, fleet_share: DataFrame) -> DataFrame:
    """Operating cost per assignment class, vans by purpose and electric share, heavy goods by class mix."""
    asked = p.withColumns({"__m": F.lit("LGV"), "__f": F.lit("Electric")})
    electric = lookup_first(
        asked, fleet_share, {"model_year": "Year", "__m": "Mode", "__f": "Fuel_Type"}, ["Value"], bounded=asked
    ).select("scenario", F.col("Value").alias("electric"))
    rows = interim.join(F.broadcast(_shares(p, travel_share)), "scenario").join(F.broadcast(electric), "scenario")
    purpose = F.when(F.col("Trip_Purpose") == "Work", F.col("work_share")).otherwise(F.col("nonwork_share"))
    fuel = F.when(F.col("Fuel_Type") == "Electric", F.col("electric")).otherwise(1 - F.col("electric"))
    weight = (
        F.when(F.col("AUC") == "LGV", purpose * fuel / 100)
        .when(F.col("Vehicle_Type") == "OGV1", F.col("ogv1"))
        .when(F.col("Vehicle_Type") == "OGV2", F.col("ogv2"))
        .otherwise(F.lit(1.0))
    )
    out = rows.groupBy("scenario", "AUC").agg(
        _complete_sum(weight * F.col("VOC_f")).alias("VOC_f"), _complete_sum(weight * F.col("VOC_nf")).alias("VOC_nf")
    )
    return out.withColumn("VOC", F.col("VOC_f") + F.col("VOC_nf")).withColumn("VOC_pence_per_m", F.col("VOC") / 1000)


def impedance(vot: DataFrame, voc: DataFrame) -> DataFrame:
    """Coefficients per class: DIST, TIME and TOLL, as one row per scenario and class."""
    now = vot.filter(F.col("Time_Period") == F.col("model_tp"))
    both = now.join(F.broadcast(voc), ["scenario", "AUC"])
    vot_s = F.col("VOT_pence_per_sec")
    return both.select(
        "scenario", "AUC", F.try_divide(F.col("VOC_pence_per_m"), vot_s).alias("DIST"), F.lit(1.0).alias("TIME"),
        F.try_divide(F.lit(1.0), vot_s).alias("TOLL"),
    )


def impedance_long(coef: DataFrame) -> DataFrame:
    return coef.unpivot(["scenario", "AUC"], TERMS, "TERM", "Value")


def impedance_scalars(coef: DataFrame) -> DataFrame:
    """One row per scenario with ``<class>_IMP_<term>`` columns."""
    named = impedance_long(coef).withColumn("name", F.concat("AUC", F.lit("_IMP_"), "TERM"))
    return named.groupBy("scenario").pivot("name", [f"{a}_IMP_{t}" for t in TERMS for a in IMPEDANCE_CLASSES]).agg(F.max("Value"))


def generalised_cost(facts: DataFrame, coef: DataFrame, klass: str = "AUC", dist: str = "dist", time: str = "time", toll: str = "toll") -> DataFrame:
    """Facts with ``cost`` = dist * DIST + time * TIME + toll * TOLL of their class.

    The coefficients hold five rows per scenario, so they are broadcast.
    """
    small = coef.withColumnsRenamed({"AUC": klass, **{t: f"__{t}" for t in TERMS}})
    cost = F.col(dist) * F.col("__DIST") + F.col(time) * F.col("__TIME") + F.col(toll) * F.col("__TOLL")
    return facts.join(F.broadcast(small), klass).withColumn("cost", cost).drop(*[f"__{t}" for t in TERMS])


def total_cost(facts: DataFrame, coef: DataFrame, klass: str = "AUC", dist: str = "dist", time: str = "time", toll: str = "toll") -> DataFrame:
    """Total cost per scenario and class. Cost is linear, so facts are summed before they meet scenarios."""
    sums = facts.groupBy(F.col(klass).alias("AUC")).agg(
        F.sum(dist).alias("__d"), F.sum(time).alias("__t"), F.sum(toll).alias("__c")
    )
    cost = F.col("__d") * F.col("DIST") + F.col("__t") * F.col("TIME") + F.col("__c") * F.col("TOLL")
    return sums.join(F.broadcast(coef), "AUC").select("scenario", "AUC", cost.alias("cost"))


def pair_attributes(pairs: DataFrame, p: DataFrame, occupancy: DataFrame, vot_work: DataFrame, vot_other: DataFrame) -> DataFrame:
    """Occupancy (OCC) and value of time (VOT) per class, joined to pairs of any number.

    Classes without their own value take the leisure one, as a plain else.
    """
    asked = p.select("scenario", "model_year", "model_tp").withColumn(
        "AUC", F.explode(F.array(*[F.lit(c) for c in [*CAR_CLASSES, "AVG", "*"]]))
    )
    found = lookup_first(asked, occupancy, {"AUC": "AUC", "model_tp": "Time_Period"}, ["Occupancy_Per_Trip"], bounded=asked)
    found = lookup_first(found, vot_work, {"model_year": "Year"}, ["Car_driver"], bounded=asked)
    found = lookup_first(found, vot_other, {"model_year": "Year"}, ["Commuting", "Other"], bounded=asked)
    value = F.when(F.col("AUC") == "CB", F.col("Car_driver")).when(F.col("AUC") == "CC", F.col("Commuting")).otherwise(F.col("Other"))
    small = found.select("scenario", F.col("AUC").alias("__auc"), F.col("Occupancy_Per_Trip").alias("OCC"), value.alias("VOT"))
    known = F.coalesce(F.col("AUC").isin([*CAR_CLASSES, "AVG"]), F.lit(False))
    keyed = pairs.withColumn("__auc", F.when(known, F.col("AUC")).otherwise("*"))
    return keyed.join(F.broadcast(small), "__auc", "left").drop("__auc")


def mode_attributes(modes: DataFrame, interim: DataFrame, code: str = "CODE") -> DataFrame:
    """Cost parameters of the car classes in every scenario; other modes get NULL."""
    names = ["Param_a", "Param_b", "Param_c", "Param_d", "Param_a1", "Param_b1"]
    cars = interim.filter(F.col("AUC").isin(CAR_CLASSES)).select("scenario", F.col("AUC").alias(code), *names)
    scenarios = whole(interim, s=F.sort_array(F.collect_set("scenario")))["s"]
    return modes.withColumn("scenario", F.explode(scenarios)).join(F.broadcast(cars), ["scenario", code], "left")


def apply_scenarios(cells: DataFrame, scenarios: list[str], overrides: DataFrame) -> DataFrame:
    """Effective cells per scenario. overrides(scenario, book, sheet, row, col, val).

    Cells are spread over the named scenarios, then overridden by a keyed join.
    """
    named = cells.withColumn("scenario", F.explode(F.array(*[F.lit(s) for s in scenarios])))
    o = overrides.select("scenario", "book", "sheet", "row", "col", F.col("val").alias("__val"))
    hit = named.join(o, ["scenario", "book", "sheet", "row", "col"], "left")
    over = F.col("__val").isNotNull()
    number = F.col("__val").try_cast("double")
    return hit.withColumns(
        {
            "v_num": F.when(over, number).otherwise(F.col("v_num")),
            "v_str": F.when(over & number.isNull(), F.col("__val")).when(~over, F.col("v_str")),
            "overridden": over,
        }
    ).drop("__val")


def data_table(df: DataFrame, sql: str, xs: tuple[str, list], ys: tuple[str, list] | None = None, name: str = "result") -> DataFrame:
    """One- or two-variable what-if table: the expression at every listed input, per row of df."""
    out = df.withColumn(xs[0], F.explode(F.array(*[F.lit(v) for v in xs[1]])))
    if ys:
        out = out.withColumn(ys[0], F.explode(F.array(*[F.lit(v) for v in ys[1]])))
    return out.withColumn(name, F.expr(sql))
