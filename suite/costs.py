"""M21–M33: parameter derivations, over parameter tables derived from the fact table."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridspark.plans import costs as X
from gridspark.session import cut_lineage
from suite.common import SUPPLIER_SQL, supplier_cells, texts
from suite.registry import query

_VT = ["Car", "LGV", "OGV1", "OGV2"]
_FUEL = ["Average", "Petrol", "Diesel"]


def pick(values, index):
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


class Book:
    """Parameter tables with the published shapes, every value an average over the fact table.

    The facts are read once: sums at the finest grain any table needs (at most
    a few ten thousand groups) are checkpointed, and every table adds them up.
    """

    GRAIN = ["l_linenumber", "dow", "y", "l_linestatus", "s6", "p3"]

    def __init__(self, t):
        grouped = t.lineitem.groupBy(
            "l_linenumber", F.dayofweek("l_shipdate").alias("dow"), F.year("l_shipdate").alias("y"), "l_linestatus",
            (F.col("l_suppkey") % 6).alias("s6"), (F.col("l_partkey") % 3).alias("p3"),
        )
        sums = grouped.agg(
            F.sum("l_extendedprice").alias("price"), F.sum("l_quantity").alias("quantity"), F.sum("l_discount").alias("discount"),
            F.sum("l_tax").alias("tax"), F.count(F.lit(1)).alias("n"))
        self.li = cut_lineage(sums).withColumns({"vt": F.col("l_linenumber") % 4, "s3": F.col("s6") % 3})
        self.period = F.replace(pick(X.PERIODS, F.col("dow") - 1), F.lit("-"), F.lit(" – "))

    @staticmethod
    def avg(column):
        return F.sum(column) / F.sum("n")

    @staticmethod
    def share(test):
        return F.sum(F.when(test, F.col("n")).otherwise(0)) / F.sum("n")

    def vot_vehicle(self):
        a = self.li.groupBy("l_linenumber", "dow").agg(F.round(self.avg("price") / 1000, 6).alias("Market_Price_Value_of_Time_Per_Vehicle"))
        k = F.col("l_linenumber") - 1
        return a.select((F.col("l_linenumber") * 10 + F.col("dow")).alias("row_no"), pick([r[1] for r in X.VOT_INTERIM_CLASSES], k).alias("Mode"),
                        pick([r[2] for r in X.VOT_INTERIM_CLASSES], k).alias("Journey_Purpose"), self.period.alias("Time_Period"), "Market_Price_Value_of_Time_Per_Vehicle")

    def travel_share(self):
        percent = lambda s: F.round(self.share(F.col("l_linestatus") == s) * 100, 6)
        a = self.li.groupBy("dow").agg(percent("F").alias("w"), percent("O").alias("n"))
        one = lambda i, p, c: F.struct(F.lit(i).alias("row_no"), F.lit(p).alias("Journey_Purpose"), F.col(c).alias("Percentage_of_Vehicle_Trips"))
        return a.select(F.lit("LGV").alias("Mode"), self.period.alias("Time_Period"), F.inline(F.array(one(1, "Work (freight)", "w"), one(2, "Non - Work", "n"))))

    def fuel(self, key, factor):
        a = self.li.groupBy("y", "vt", key).agg(
            F.round(self.avg("price") / 1000 * factor, 6).alias("Param_a"), F.round(self.avg("quantity"), 6).alias("Param_b"),
            F.round(self.avg("discount"), 6).alias("Param_c"), F.round(self.avg("tax") / 100, 8).alias("Param_d"))
        return a.select((F.col("vt") * 10 + F.col(key)).alias("row_no"), F.col("y").alias("Year"), pick(_VT, F.col("vt")).alias("Vehicle_Type"),
                        pick(_FUEL, F.col(key)).alias("Fuel_Type"), "Param_a", "Param_b", "Param_c", "Param_d")

    def nonfuel(self):
        fuel = F.when(F.col("vt") != 1, "All").when(F.col("s6") % 2 == 0, "Non-electric").otherwise("Electric")
        a = self.li.groupBy(pick(_VT, F.col("vt")).alias("Vehicle_Type"), F.when(F.col("l_linestatus") == "F", "Work").otherwise("Non-Work").alias("Trip_Purpose"), fuel.alias("Fuel_Type"))
        return a.agg(F.lit(1).alias("row_no"), F.round(self.avg("quantity"), 6).alias("Param_a1"), F.round(self.avg("price") / 100, 6).alias("Param_b1"))

    def nonfuel_forecast(self):
        a = self.li.groupBy(F.col("y").alias("Year"), pick(["Work", "Non-work", "Average"], F.col("s3")).alias("Trip_Purpose"))
        return a.agg(F.lit(1).alias("row_no"), F.lit("Car").alias("Vehicle_Type"), F.round(self.avg("quantity") / 2, 6).alias("Param_a1"), F.round(self.avg("price") / 200, 6).alias("Param_b1"))

    def fleet_share(self):
        a = self.li.groupBy(F.col("y").alias("Year")).agg(F.round(self.share(F.col("s3") == 0), 6).alias("Value"))
        return a.select(F.lit(1).alias("row_no"), "Year", F.lit("LGV").alias("Mode"), F.lit("Electric").alias("Fuel_Type"), "Value")

    def occupancy(self):
        a = self.li.groupBy("vt", "dow").agg(F.round(1 + self.avg("discount"), 6).alias("Occupancy_Per_Trip"))
        return a.select(F.col("vt").alias("row_no"), pick(["CB", "CC", "CO", "AVG"], F.col("vt")).alias("AUC"), self.period.alias("Time_Period"), "Occupancy_Per_Trip")

    def vot_year(self):
        a = self.li.groupBy(F.col("y").alias("Year")).agg(F.round(self.avg("price") / 1000, 6).alias("Car_driver"), F.round(self.avg("quantity"), 6).alias("Commuting"), F.round(self.avg("tax") * 100, 6).alias("Other"))
        return a.withColumn("row_no", F.lit(1))

    def voc_parameters(self, p):
        return X.voc_parameters(p, self.fuel("s3", 1.0), self.fuel("p3", 1.1), self.nonfuel(), self.nonfuel_forecast())

    def vot(self, p):
        return X.vot_final(p, X.vot_interim(p, self.vot_vehicle()), self.travel_share())

    def voc(self, p, speeds=None):
        return X.voc_final(p, X.voc_interim(self.voc_parameters(p), speeds), self.travel_share(), self.fleet_share())

    def impedance(self, p):
        return X.impedance(self.vot(p), self.voc(p))


BASE = {"model_year": 1999, "model_tp": "Average Weekday"}
_ONE = "sc AS (SELECT '0' AS scenario, 1999 AS my, 5 AS tp)"
_SWEEP = "sc AS (SELECT y || '/' || tp AS scenario, y AS my, tp FROM (VALUES (1996), (1998), (2000)) a(y), (VALUES (1), (5), (6)) b(tp))"


def ctes(scenarios: str = _ONE) -> str:
    arr = lambda xs: "[" + ", ".join(f"'{x}'" for x in xs) + "]"
    periods = arr(X.PERIODS)
    voc_rows = ", ".join(f"('{a}', '{v}', '{p}', '{f}', {s}::DOUBLE)" for a, v, p, f, s in X.VOC_INTERIM_CLASSES)
    return f"""WITH {scenarios}, li AS (SELECT *, year(l_shipdate)::INT AS y, dayofweek(l_shipdate)::INT + 1 AS dow, (l_linenumber % 4)::INT AS vt, (l_suppkey % 3)::INT AS s3, (l_partkey % 3)::INT AS p3 FROM lineitem),
    vot AS (SELECT l_linenumber AS k, dow, round(avg(l_extendedprice) / 1000, 6) AS v FROM li GROUP BY ALL),
    vint AS (SELECT scenario, my, tp, {arr([r[0] for r in X.VOT_INTERIM_CLASSES])}[k] AS auc, {arr([r[1] for r in X.VOT_INTERIM_CLASSES])}[k] AS vtype, {arr([r[2] for r in X.VOT_INTERIM_CLASSES])}[k] AS purpose, {periods}[dow] AS period, dow, k,
      v / CASE WHEN k = 1 THEN 1.19 ELSE 1 END AS v FROM vot, sc),
    sh AS (SELECT scenario, round(100.0 * count_if(l_linestatus = 'F') / count(*), 6) AS w, round(100.0 * count_if(l_linestatus = 'O') / count(*), 6) AS n FROM li JOIN sc ON dow = tp GROUP BY scenario),
    vfin AS (SELECT scenario, tp, auc, period, dow, sum(v * CASE k WHEN 4 THEN w / 100 WHEN 5 THEN n / 100 WHEN 6 THEN 1.0::DOUBLE WHEN 7 THEN 1.5::DOUBLE ELSE 1 END) AS v FROM vint JOIN sh USING (scenario) GROUP BY ALL),
    fw AS (SELECT y, vt, round(avg(l_extendedprice) / 1000, 6) AS a, round(avg(l_quantity), 6) AS b, round(avg(l_discount), 6) AS c, round(avg(l_tax) / 100, 8) AS d FROM li WHERE s3 = 0 GROUP BY ALL),
    fn AS (SELECT y, vt, round(avg(l_extendedprice) / 1000 * 1.1, 6) AS a, round(avg(l_quantity), 6) AS b, round(avg(l_discount), 6) AS c, round(avg(l_tax) / 100, 8) AS d FROM li WHERE p3 = 0 GROUP BY ALL),
    nf AS (SELECT {arr(_VT)}[vt + 1] AS vtype, CASE WHEN l_linestatus = 'F' THEN 'Work' ELSE 'Non-Work' END AS purpose, CASE WHEN vt <> 1 THEN 'All' WHEN l_suppkey % 2 = 0 THEN 'Non-electric' ELSE 'Electric' END AS fuel, round(avg(l_quantity), 6) AS a1, round(avg(l_extendedprice) / 100, 6) AS b1 FROM li GROUP BY ALL),
    nc AS (SELECT y, round(avg(l_quantity) / 2, 6) AS a1, round(avg(l_extendedprice) / 200, 6) AS b1 FROM li WHERE s3 = 0 GROUP BY y),
    el AS (SELECT y, round(avg(CASE WHEN s3 = 0 THEN 1.0::DOUBLE ELSE 0 END), 6) AS e FROM li GROUP BY y),
    rws AS (SELECT * FROM (VALUES {voc_rows}) r(auc, vtype, purpose, fuel, spd)),
    par AS (SELECT scenario, my, tp, r.auc, r.vtype, r.purpose, r.fuel, r.spd, CASE WHEN r.purpose = 'Work' THEN fw.a ELSE fn.a END AS a, CASE WHEN r.purpose = 'Work' THEN fw.b ELSE fn.b END AS b, CASE WHEN r.purpose = 'Work' THEN fw.c ELSE fn.c END AS c,
      CASE WHEN r.purpose = 'Work' THEN fw.d ELSE fn.d END AS d, CASE WHEN r.purpose = 'Non-Work' THEN 0 WHEN r.vtype = 'Car' THEN nc.a1 ELSE nf.a1 END AS a1, CASE WHEN r.purpose = 'Non-Work' THEN 0 WHEN r.vtype = 'Car' THEN nc.b1 ELSE nf.b1 END AS b1
      FROM sc, rws r LEFT JOIN fw ON fw.y = my AND {arr(_VT)}[fw.vt + 1] = r.vtype LEFT JOIN fn ON fn.y = my AND {arr(_VT)}[fn.vt + 1] = r.vtype LEFT JOIN nf ON nf.vtype = r.vtype AND nf.purpose = r.purpose AND nf.fuel = r.fuel LEFT JOIN nc ON nc.y = my),
    voci AS (SELECT *, a / spd + b + c * spd + d * spd * spd AS f, a1 + b1 / spd AS nfc FROM par),
    vocf AS (SELECT scenario, auc, sum(wt * f) AS f, sum(wt * nfc) AS nfc FROM (SELECT v.*, CASE WHEN v.auc = 'LGV' THEN CASE WHEN purpose = 'Work' THEN w ELSE n END * CASE WHEN fuel = 'Electric' THEN e ELSE 1 - e END / 100 WHEN vtype = 'OGV1' THEN 0.4 WHEN vtype = 'OGV2' THEN 0.6 ELSE 1 END::DOUBLE AS wt
      FROM voci v JOIN sh USING (scenario) JOIN el ON el.y = my) GROUP BY ALL),
    imp AS (SELECT scenario, auc, (vocf.f + vocf.nfc) / 1000 / (vfin.v / 36) AS dist, 1.0::DOUBLE AS "time", 36 / vfin.v AS toll FROM vfin JOIN vocf USING (scenario, auc) WHERE dow = tp) """


def rounded(df, n, *cols):
    return df.withColumns({c: F.round(c, n) for c in cols})


@query("m21_vot_interim", ctes() + """SELECT auc AS "AUC", vtype AS "Vehicle_Type", purpose AS "Journey_Purpose", period AS "Time_Period", round(v, 6) AS "Value_of_Time_Per_Vehicle" FROM vint""")
def _(t):
    p = X.params(t.spark, BASE)
    out = X.vot_interim(p, Book(t).vot_vehicle())
    return rounded(out.select("AUC", "Vehicle_Type", "Journey_Purpose", "Time_Period", "Value_of_Time_Per_Vehicle"), 6, "Value_of_Time_Per_Vehicle")


@query("m22_vot_final", ctes() + """SELECT auc AS "AUC", period AS "Time_Period", round(v, 4) AS "Value_of_Time_Per_Vehicle", round(v / 36, 6) AS "VOT_pence_per_sec" FROM vfin""")
def _(t):
    out = Book(t).vot(X.params(t.spark, BASE)).select("AUC", "Time_Period", F.round("Value_of_Time_Per_Vehicle", 4).alias("Value_of_Time_Per_Vehicle"), F.round("VOT_pence_per_sec", 6).alias("VOT_pence_per_sec"))
    return out


@query(
    "m23_avg_speed",
    """SELECT event_type AS "AUC", scenario, round(sum(value) / nullif(sum(h), 0), 6) AS net_speed FROM (SELECT *, (user_id % 3)::INT AS it, (user_id % 7)::DOUBLE / 10 AS h FROM events) JOIN (VALUES ('0', 2), ('1', 1)) s(scenario, ci) ON it = ci GROUP BY ALL""",
)
def _(t):
    a = t.events.select(F.col("event_type").alias("AUC"), (F.col("user_id") % 3).cast("int").alias("iteration"), F.col("value").alias("veh_km"), ((F.col("user_id") % 7).cast("double") / 10).alias("veh_hours"))
    return rounded(X.avg_speed(a, X.params(t.spark, {}, {"conv_iter": 1})), 6, "net_speed")


_CLASS = ["CB", "CC", "CO", "HGV"]
_FACTS = "(SELECT *, ['CB', 'CC', 'CO', 'LGV', 'HGV'][(l_partkey % 5 + 1)::INT] AS auc FROM lineitem)"
_ID = ["l_orderkey", "l_linenumber", "l_extendedprice"]


def facts(t):
    return t.lineitem.select(*_ID, pick(X.IMPEDANCE_CLASSES, F.col("l_partkey") % 5).alias("AUC"), F.col("l_quantity").alias("v"), F.col("l_extendedprice").alias("dist"), F.col("l_quantity").alias("time"), F.col("l_tax").alias("toll"))


def first_rows(parameters):
    """One parameter row per class; the first of its vehicle and fuel types."""
    return F.broadcast(parameters.groupBy("AUC").agg(F.min_by(F.struct("Param_a", "Param_b", "Param_c", "Param_d", "Param_a1", "Param_b1"), F.struct("Vehicle_Type", F.col("Trip_Purpose"), "Fuel_Type")).alias("p")))


_FIRST = "one AS (SELECT auc, min_by({'a': a, 'b': b, 'c': c, 'd': d, 'a1': a1, 'b1': b1}, vtype || purpose || fuel) AS p FROM par GROUP BY auc) "


@query(
    "m24_voc_fuel",
    ctes()[:-1] + ", " + _FIRST + f"SELECT l_orderkey, l_linenumber, l_extendedprice, round(p.a / l_quantity + p.b + p.c * l_quantity + p.d * l_quantity * l_quantity, 6) AS fuel FROM {_FACTS} JOIN one USING (auc)",
)
def _(t):
    one = first_rows(Book(t).voc_parameters(X.params(t.spark, BASE)))
    p = F.col("p")
    return facts(t).join(one, "AUC").select(*_ID, F.round(X.fuel_cost(p["Param_a"], p["Param_b"], p["Param_c"], p["Param_d"], F.col("v")), 6).alias("fuel"))


@query(
    "m25_voc_nonfuel",
    ctes()[:-1] + ", " + _FIRST + f"SELECT l_orderkey, l_linenumber, l_extendedprice, round(p.a1 + p.b1 / l_quantity, 6) AS nonfuel FROM {_FACTS} JOIN one USING (auc)",
)
def _(t):
    one = first_rows(Book(t).voc_parameters(X.params(t.spark, BASE)))
    p = F.col("p")
    return facts(t).join(one, "AUC").select(*_ID, F.round(X.nonfuel_cost(p["Param_a1"], p["Param_b1"], F.col("v")), 6).alias("nonfuel"))


@query("m26_voc_final", ctes() + """SELECT auc AS "AUC", round(f, 6) AS "VOC_f", round(nfc, 6) AS "VOC_nf", round(f + nfc, 6) AS "VOC", round((f + nfc) / 1000, 8) AS "VOC_pence_per_m" FROM vocf""")
def _(t):
    out = Book(t).voc(X.params(t.spark, BASE)).drop("scenario")
    return rounded(rounded(out, 6, "VOC_f", "VOC_nf", "VOC"), 8, "VOC_pence_per_m")


@query(
    "m27_impedance",
    ctes() + "SELECT " + ", ".join(f"""round(max(CASE WHEN auc = '{a}' THEN "{x.lower()}" END), 8) AS "{a}_IMP_{x}" """ for x in X.TERMS for a in X.IMPEDANCE_CLASSES) + " FROM imp",
)
def _(t):
    wide = X.impedance_scalars(Book(t).impedance(X.params(t.spark, BASE))).drop("scenario")
    return rounded(wide, 8, *wide.columns)


@query(
    "m28_generalised_cost",
    ctes() + f"""SELECT auc AS "AUC", count(*) AS n, round(sum(l_extendedprice * dist + l_quantity * "time" + l_tax * toll), 2) AS cost, round(max(l_extendedprice * dist + l_quantity * "time" + l_tax * toll), 4) AS dearest FROM {_FACTS} JOIN imp USING (auc) GROUP BY auc""",
)
def _(t):
    priced = X.generalised_cost(facts(t), Book(t).impedance(X.params(t.spark, BASE)).drop("scenario"))
    return priced.groupBy("AUC").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("cost"), 2).alias("cost"), F.round(F.max("cost"), 4).alias("dearest"))


@query(
    "m29_pair_attributes",
    ctes() + """, occ AS (SELECT ['CB', 'CC', 'CO', 'AVG'][vt + 1] AS auc, round(1 + avg(l_discount), 6) AS occ FROM li WHERE dow = 5 GROUP BY 1), vy AS (SELECT round(avg(l_extendedprice) / 1000, 6) AS cb, round(avg(l_quantity), 6) AS cc, round(avg(l_tax) * 100, 6) AS co FROM li WHERE y = 1999),
       o AS (SELECT o_orderkey, ['CB', 'CC', 'CO', 'LGV', 'HGV'][(o_custkey % 5 + 1)::INT] AS auc FROM orders)
       SELECT o_orderkey, o.auc AS "AUC", occ AS "OCC", CASE o.auc WHEN 'CB' THEN cb WHEN 'CC' THEN cc ELSE co END AS "VOT" FROM o CROSS JOIN vy LEFT JOIN occ ON occ.auc = o.auc""",
)
def _(t):
    b = Book(t)
    pairs = t.orders.select("o_orderkey", pick(X.IMPEDANCE_CLASSES, F.col("o_custkey") % 5).alias("AUC"))
    return X.pair_attributes(pairs, X.params(t.spark, BASE), b.occupancy(), b.vot_year(), b.vot_year()).select("o_orderkey", "AUC", "OCC", "VOT")


@query(
    "m30_mode_attributes",
    ctes() + """, c AS (SELECT c_custkey, ['CB', 'CC', 'CO', 'LGV', 'BUS'][c_nationkey % 5 + 1] AS code FROM customer) SELECT c_custkey, code AS "CODE", round(a, 6) AS a, round(d, 8) AS d, round(a1, 6) AS a1, round(b1, 6) AS b1, sc FROM c CROSS JOIN (VALUES ('early'), ('late')) s(sc) LEFT JOIN (SELECT * FROM par WHERE auc IN ('CB', 'CC', 'CO')) ON auc = code""",
)
def _(t):
    modes = t.customer.select("c_custkey", pick(["CB", "CC", "CO", "LGV", "BUS"], F.col("c_nationkey") % 5).alias("CODE"))
    both = X.params(t.spark, {**BASE, "scenario": "early"}, {**BASE, "scenario": "late"})
    out = X.mode_attributes(modes, Book(t).voc_parameters(both)).withColumn("sc", F.col("scenario"))
    return out.select("c_custkey", "CODE", "sc", F.round("Param_a", 6).alias("a"), F.round("Param_d", 8).alias("d"), F.round("Param_a1", 6).alias("a1"), F.round("Param_b1", 6).alias("b1"))


@query(
    "m31_sweep",
    ctes(_SWEEP) + f"""SELECT scenario, auc AS "AUC", round(sum(l_extendedprice) * any_value(dist) + sum(l_quantity) + sum(l_tax) * any_value(toll), 2) AS cost FROM {_FACTS} JOIN imp USING (auc) GROUP BY scenario, auc""",
)
def _(t):
    scenarios = [{"scenario": f"{y}/{tp}", "model_year": y, "model_tp": X.PERIODS[tp - 1] if tp != 6 else "Average Weekend"} for y in (1996, 1998, 2000) for tp in (1, 5, 6)]
    return rounded(X.total_cost(facts(t), Book(t).impedance(X.params(t.spark, *scenarios))), 2, "cost")


@query(
    "m32_apply_scenarios",
    SUPPLIER_SQL + """SELECT s AS scenario, sheet, "row"::INT AS "row", col::INT AS col, CASE WHEN s = 'high' AND "row" = 2 AND col = 4 THEN '999.5' WHEN s = 'low' AND "row" = 3 AND col = 2 THEN 'closed'
       ELSE coalesce(v_str, CASE WHEN v_num = floor(v_num) THEN v_num::BIGINT::VARCHAR ELSE v_num::VARCHAR END) END AS text, (s = 'high' AND "row" = 2 AND col = 4) OR (s = 'low' AND "row" = 3 AND col = 2) AS overridden FROM cells, (VALUES ('base'), ('high'), ('low')) v(s)""",
)
def _(t):
    cells = supplier_cells(t)
    one = lambda s, r, c, v: F.struct(F.lit(s).alias("scenario"), F.lit(r).alias("row"), F.lit(c).alias("col"), F.lit(v).alias("val"))
    over = cells.select("book", "sheet").distinct().select("book", "sheet", F.inline(F.array(one("high", 2, 4, "999.5"), one("low", 3, 2, "closed"))))
    return texts(X.apply_scenarios(cells, ["base", "high", "low"], over), "scenario", "overridden").drop("book")


@query(
    "m33_data_table",
    "SELECT p_partkey, rate, years, round(p_retailprice * pow(1 + rate, years), 6) AS result FROM part, (VALUES (0.01), (0.035), (0.05)) a(rate), (VALUES (1), (5), (10)) b(years)",
)
def _(t):
    out = X.data_table(t.part, "round(p_retailprice * pow(1 + rate, years), 6)", ("rate", [0.01, 0.035, 0.05]), ("years", [1, 5, 10]))
    return out.select("p_partkey", "rate", "years", "result")
