"""Rules, validations and filters that workbooks declare, evaluated from their rows.

Nothing of them is an argument: declared items (``scan_declared``) meet the cells of their ranges by tiles, operators
and operands are columns, and thresholds come per range from one grouped aggregate and, where an order
statistic is asked for, from one scan of the counted values. So a folder of books may hold any number of items.

Operands may be numbers or quoted texts. Items that need a formula worked out are not evaluated: their flag is NULL.
Dates are compared as serial numbers of the 1900 epoch.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridspark.functions import coords as C
from gridspark.functions import scalars as S
from gridspark.operators import filters
from gridspark.operators.grid import SHEET, text_of
from gridspark.operators.rules import rule_blank_error
from gridspark.scale import balanced, hot_keys, running, salted_join, tile_join
from gridspark.session import cut_lineage

KEY = ["book", "sheet", "rule_id"]
_BOUNDS = ["min_col", "min_row", "max_col", "max_row"]
_CELL = ["row", "col", "text", "num", "v_ts", "err"]
# Names of relative date spans.
SPANS = [
    "today", "yesterday", "tomorrow", "last7Days", "thisWeek", "lastWeek", "nextWeek", "thisMonth", "lastMonth", "nextMonth",
    "thisQuarter", "lastQuarter", "nextQuarter", "thisYear", "lastYear", "nextYear", "yearToDate",
]


def _values(cells: DataFrame) -> DataFrame:
    """Cells with a text and a number, saved once: files are parsed a single time. Dates count as their serial number."""
    read = cells.select(*SHEET, "row", "col", text_of().alias("text"), F.coalesce("v_num", S.to_serial(F.col("v_ts"))).alias("num"), "v_ts", "err")
    return cut_lineage(read).filter("row is not null and text is not null")


def items_of(declared: DataFrame, kind: str) -> DataFrame:
    """Declared items of a kind, a row per range: ``rule_id``, bounds and the item's columns; a ``rule_id`` names one item."""
    items = declared.filter(F.col("kind") == kind).withColumn("rule_id", F.xxhash64("ref", "name", "operator", "first", "second", "idx", "flags"))
    one = items.withColumn("__b", F.explode(F.transform(F.split(F.trim("ref"), r"\s+"), C.range_bounds))).filter("__b is not null")
    ends = {"min_col": 1, "min_row": 1, "max_col": C.MAX_COLUMN, "max_row": C.MAX_SHEET_ROW}
    bounds = [F.coalesce(F.col(f"__b.{k}"), F.lit(v)).alias(k) for k, v in ends.items()]
    return one.select(*KEY, *bounds, "ref", "name", "operator", "first", "second", "idx", "level", "flags", "on")


def _has(flag: str) -> Column:
    return F.array_contains(F.split(F.coalesce("flags", F.lit("")), " "), flag)


def covered(values: DataFrame, items: DataFrame) -> DataFrame:
    """Every cell (see ``_values``) with every item that covers it, once per item; saved, as statistics and flags both read it."""
    met = tile_join(values, items)
    kept = [c for c in items.columns if c not in (*SHEET, *_BOUNDS)]
    return cut_lineage(met.select(*SHEET, *_CELL, *[F.col(f"r_{c}").alias(c) for c in kept]).dropDuplicates([*KEY, "row", "col"]))


def _statistics(met: DataFrame) -> DataFrame:
    """Per item over the numbers it covers; one pass."""
    n = F.col("num")
    return met.groupBy(*KEY).agg(
        F.count(n).alias("count"), F.min(n).alias("lo"), F.max(n).alias("hi"), F.avg(n).alias("mean"), F.stddev_samp(n).alias("dev")
    )


def thresholds(met: DataFrame, wanted: DataFrame) -> DataFrame:
    """Per item the edges asked for, in order of their slot, with the item's statistics.

    wanted(KEY, slot, kind, val, gte, colour): kinds are num, formula, min, max, percent (of the span), percentile, top, bottom,
    top% and bottom%.
    """
    stat = _statistics(met)
    asked = wanted.join(stat, KEY, "left")
    val, count = F.col("val"), F.col("count")
    take = F.when(F.col("kind").endswith("%"), F.greatest(F.lit(1), F.floor(count * val / 100))).otherwise(val.cast("long"))
    take = F.least(take, count)
    place = F.when(F.col("kind") == "percentile", (count - 1) * val / 100 + 1).when(F.col("kind").startswith("top"), count - take + 1).when(F.col("kind").startswith("bottom"), take)
    asked = asked.withColumn("__at", place.cast("double"))
    by_rank = asked.filter(F.col("__at").isNotNull())
    lists = by_rank.groupBy(*KEY).agg(F.collect_list(F.struct("slot", F.col("__at").alias("at"))).alias("__asks"))
    numbers = met.filter(F.col("num").isNotNull())
    hot = hot_keys(numbers, KEY)
    values = salted_join(numbers, lists.select(*KEY), KEY, "left_semi", hot=hot).groupBy(*KEY, "num").agg(F.count(F.lit(1)).alias("n"))
    ranked = running(balanced(values, *[F.col(c) for c in (*KEY, "num")]), KEY, ["num"], {"cum": ("sum", F.col("n"))}, F.col("__part"))
    near = salted_join(ranked, lists, KEY, "inner", hot=hot_keys(values, KEY)).select(*KEY, "num", "n", "cum", F.explode("__asks").alias("a")).select(*KEY, "num", "n", "cum", "a.*")
    holds = lambda at: (F.col("cum") >= at) & (F.col("cum") - F.col("n") < at)
    low, high = F.floor(F.col("at")), F.ceil(F.col("at"))
    found = near.filter(holds(low) | holds(high)).groupBy(*KEY, "slot", "at").agg(F.max(F.when(holds(low), F.col("num"))).alias("a"), F.max(F.when(holds(high), F.col("num"))).alias("b"))
    found = found.select(*KEY, "slot", (F.col("a") + (F.col("b") - F.col("a")) * (F.col("at") - low)).alias("ranked"))
    edge = (
        F.when(F.col("kind").isin("num", "formula"), val).when(F.col("kind") == "min", F.col("lo")).when(F.col("kind") == "max", F.col("hi"))
        .when(F.col("kind") == "percent", F.col("lo") + (F.col("hi") - F.col("lo")) * val / 100).otherwise(F.col("ranked"))
    )
    edged = asked.join(found, [*KEY, "slot"], "left").withColumn("edge", edge)
    edges = edged.groupBy(*KEY).agg(F.array_sort(F.collect_list(F.struct("slot", "edge", "gte", "colour"))).alias("edges"))
    return stat.join(edges, KEY, "left")


def _operand(c: str) -> tuple[Column, Column]:
    """An operand as a number and as a quoted text; both NULL for anything else."""
    raw = F.trim(F.col(c))
    quoted = (F.length(raw) > 1) & raw.startswith('"') & raw.endswith('"')
    inner = F.replace(F.substring(raw, F.lit(2), F.length(raw) - 2), F.lit('""'), F.lit('"'))
    return raw.try_cast("double"), F.when(quoted, inner)


def compared(value: Column, operator: Column, first: Column, second: Column) -> Column:
    """Comparison whose operator is a column; between takes its bounds in either order."""
    inside = value.between(F.least(first, second), F.greatest(first, second))
    out = F.when(operator == "between", inside).when(operator == "notBetween", ~inside)
    for name, test in filters._COMPARE.items():
        out = out.when(operator == name, test(value, first))
    return out


def _compare_cell() -> Column:
    """The cell against the operands of its item; NULL where an operand is neither number nor text."""
    (n1, t1), (n2, t2) = _operand("first"), _operand("second")
    two = F.col("operator").isin("between", "notBetween")
    numeric, texts = n1.isNotNull() & (~two | n2.isNotNull()), t1.isNotNull() & (~two | t2.isNotNull())
    by_text = F.when(F.col("num").isNull(), F.coalesce(compared(F.col("text"), F.col("operator"), t1, t2), F.lit(False))).otherwise(F.col("operator") == "notEqual")
    return F.when(numeric, F.coalesce(compared(F.col("num"), F.col("operator"), n1, n2), F.lit(False))).when(texts, by_text)


def _text_hit() -> Column:
    low, term = F.lower("text"), F.lower("first")
    kind = F.col("name")
    return (
        F.when(kind == "containsText", low.contains(term)).when(kind == "notContainsText", ~low.contains(term))
        .when(kind == "beginsWith", low.startswith(term)).when(kind == "endsWith", low.endswith(term))
    )


def _span_hit(kind: Column, today: dt.date) -> Column:
    out = F.lit(None).cast("boolean")
    for name in SPANS:
        out = F.when(kind == name, F.coalesce(filters.relative_date(F.col("v_ts"), name, today), F.lit(False))).otherwise(out)
    return out


def _edge(i: int) -> Column:
    return F.col("edges")[i]["edge"]


def _position() -> Column:
    """Where a number stands between the stops of its colour scale: 0 to stops - 1."""
    last = F.size("edges") - 1
    n = F.col("num")
    part = lambda i: F.coalesce(F.try_divide(n - _edge(i), _edge(i + 1) - _edge(i)), F.lit(0.0)) + i
    middle = F.when((last == 2) & (n >= _edge(1)), part(1)).when(n >= _edge(0), part(0)).otherwise(F.lit(0.0))
    return F.when(n.isNull(), F.lit(None).cast("double")).when(n >= F.element_at("edges", -1)["edge"], last.cast("double")).otherwise(middle)


def _colour() -> Column:
    """Colour at ``position``, each channel mixed on its own."""
    low = F.least(F.floor("position"), F.size("edges") - 2).cast("int")
    channel = lambda i, at: F.conv(F.substring(F.right(F.get("edges", i)["colour"], F.lit(6)), at, 2), 16, 10).cast("double")
    mixed = [F.lpad(F.hex(F.round(channel(low, at) + (F.col("position") - low) * (channel(low + 1, at) - channel(low, at))).cast("int")), 2, "0") for at in (1, 3, 5)]
    return F.when(F.col("position").isNotNull(), F.concat(*mixed))


def _bucket() -> Column:
    """Index of the highest icon whose threshold is met."""
    met = F.transform("edges", lambda e, i: F.when((i > 0) & F.when(e["gte"], F.col("num") >= e["edge"]).otherwise(F.col("num") > e["edge"]), i).otherwise(0))
    best = F.array_max(met)
    return F.when(F.col("num").isNotNull(), F.when(_has("reverse"), F.size("edges") - 1 - best).otherwise(best))


def evaluate_rules(cells: DataFrame, declared: DataFrame, today: dt.date) -> DataFrame:
    """Every covered cell under every declared rule: ``hit`` (NULL if it is not evaluated), and what scales show.

    Columns: book, sheet, row, col, rule_id, type, priority, stop, hit, position (0 to stops - 1 of a colour scale), rgb,
    bucket (of an icon set) and bar (percent of a data bar). Blank cells hold no row and are not judged.
    """
    declared = cut_lineage(declared)
    rules = items_of(declared, "rule")
    met = covered(_values(cells), rules.drop("ref"))
    stops = items_of(declared, "stop").select(*SHEET, "ref", "idx", F.col("level").alias("slot"), F.col("name").alias("kind"), F.col("first").try_cast("double").alias("val"), (F.col("operator") == "gte").alias("gte"), F.col("second").alias("colour")).distinct()
    scales = rules.select(*KEY, "ref", "idx").distinct().join(stops, [*SHEET, "ref", "idx"]).drop("ref", "idx")
    top = rules.filter("name = 'top10'").select(
        *KEY, F.lit(0).alias("slot"), F.concat(F.when(_has("bottom"), "bottom").otherwise("top"), F.when(_has("percent"), "%").otherwise("")).alias("kind"),
        F.col("first").try_cast("double").alias("val"), F.lit(True).alias("gte"), F.lit(None).cast("string").alias("colour"),
    ).distinct()
    edges = thresholds(met, scales.unionByName(top))
    known = salted_join(met, edges, KEY, "left", hot=hot_keys(met, KEY))

    n, kind = F.col("num"), F.col("name")
    spread_ = F.coalesce(F.col("dev"), F.lit(0.0)) * F.coalesce("level", F.lit(0))
    below = _has("below")
    mark = F.when(below, F.col("mean") - spread_).otherwise(F.col("mean") + spread_)
    average = F.when(below, F.when(_has("equal"), n <= mark).otherwise(n < mark)).otherwise(F.when(_has("equal"), n >= mark).otherwise(n > mark))
    top_hit = F.when(_has("bottom"), n <= _edge(0)).otherwise(n >= _edge(0))
    value = F.coalesce("err", "text")
    blank_error = F.lit(None).cast("boolean")
    for name in ("containsBlanks", "notContainsBlanks", "containsErrors", "notContainsErrors"):
        blank_error = F.when(kind == name, rule_blank_error(value, name)).otherwise(blank_error)
    alike = met.filter(kind.isin("duplicateValues", "uniqueValues")).groupBy(*KEY, "text").agg(F.count(F.lit(1)).alias("same"))
    known = salted_join(known, alike, [*KEY, "text"], "left", hot=hot_keys(met, [*KEY, "text"]))
    hit = (
        F.when(kind == "cellIs", _compare_cell()).when(kind == "top10", F.coalesce(top_hit, F.lit(False))).when(kind == "aboveAverage", F.coalesce(average, F.lit(False)))
        .when(kind == "duplicateValues", F.col("same") > 1).when(kind == "uniqueValues", F.col("same") == 1)
        .when(kind == "timePeriod", _span_hit(F.col("first"), today)).when(kind.isin("colorScale", "iconSet", "dataBar"), n.isNotNull())
        .otherwise(F.coalesce(blank_error, _text_hit()))
    )
    judged = known.withColumns({"hit": hit, "position": F.when(kind == "colorScale", _position()), "bucket": F.when(kind == "iconSet", _bucket())})
    short, long = (F.coalesce(F.col(c).try_cast("double"), F.lit(d)) for c, d in (("first", 10.0), ("second", 90.0)))
    length = short + F.coalesce(F.try_divide(n - _edge(0), _edge(1) - _edge(0)), F.lit(0.0)) * (long - short)
    bar = F.when((kind == "dataBar") & n.isNotNull(), F.greatest(short, F.least(long, length)))
    return judged.select(*SHEET, "row", "col", "rule_id", F.col("name").alias("type"), F.col("idx").alias("priority"), F.col("on").alias("stop"), "hit", "position", _colour().alias("rgb"), "bucket", bar.alias("bar"))


def resolve_declared(judged: DataFrame) -> DataFrame:
    """Per cell the rules that apply, in order of priority up to the first hit of a stop rule, and the first of them."""
    hits = F.array_sort(F.collect_list(F.when(F.col("hit"), F.struct("priority", "rule_id", "type", "stop"))))
    cells = judged.groupBy(*SHEET, "row", "col").agg(hits.alias("h"))
    last = F.array_min(F.transform(F.filter("h", lambda x: x["stop"]), lambda x: x["priority"]))
    cells = cells.withColumn("last", last)
    applied = F.filter("h", lambda x: F.col("last").isNull() | (x["priority"] <= F.col("last")))
    return cells.select(*SHEET, "row", "col", F.transform(applied, lambda x: x["type"]).alias("applied"), F.get(applied, F.lit(0))["rule_id"].alias("winner"))


def evaluate_validations(cells: DataFrame, declared: DataFrame) -> DataFrame:
    """Every covered cell under every declared validation: ``valid``, NULL if it is not evaluated.

    A list is written out or is a range of its own sheet or another one.
    """
    values, rules = _values(cells), items_of(cut_lineage(declared), "validation")
    met = covered(values, rules)
    kind, n = F.col("name"), F.col("num")
    inline = _operand("first")[1]
    listed = F.array_contains(F.transform(F.split(inline, ","), lambda x: F.trim(x)), F.col("text"))
    at = C.qualified_range(F.col("first"))
    sources = rules.filter((kind == "list") & ~F.col("first").startswith('"')).select(*KEY, F.coalesce(at["sheet"], F.col("sheet")).alias("from_sheet"), F.coalesce(at["bounds"], C.range_bounds(F.col("first"))).alias("b")).filter("b is not null").distinct()
    places = sources.select("book", F.col("from_sheet").alias("sheet"), *[F.col(f"b.{c}").alias(c) for c in _BOUNDS], F.col("sheet").alias("own"), "rule_id")
    allowed = tile_join(values.select(*SHEET, "row", "col", "text"), places).select("book", F.col("r_own").alias("sheet"), F.col("r_rule_id").alias("rule_id"), "text", F.lit(True).alias("allowed")).distinct()
    known = salted_join(met, allowed, [*KEY, "text"], "left", hot=hot_keys(met, [*KEY, "text"]))
    ranged = C.range_bounds(F.col("first")).isNotNull() | at.isNotNull()
    (n1, _), (n2, _) = _operand("first"), _operand("second")
    long = compared(F.length("text").cast("double"), F.col("operator"), n1, n2)
    number = F.when(n.isNull(), F.lit(False)).otherwise(_compare_cell())
    valid = (
        F.when(kind == "whole", number & F.coalesce(n == F.floor(n), F.lit(False))).when(kind.isin("decimal", "date", "time"), number)
        .when(kind == "textLength", long).when(kind == "list", F.when(inline.isNotNull(), listed).when(ranged, F.coalesce("allowed", F.lit(False))))
        .when(kind == "none", F.lit(True))
    )
    return known.select(*SHEET, "row", "col", "rule_id", F.col("name").alias("type"), valid.alias("valid"))


def report(judged: DataFrame) -> DataFrame:
    """Per validation: cells checked, violations, and the first offending place."""
    bad = ~F.col("valid")
    first = F.min(F.when(bad, F.struct("row", "col")))
    out = judged.groupBy(*KEY, "type").agg(F.count("valid").alias("checked"), F.count_if(bad).alias("violations"), first.alias("__f"))
    return out.select(*KEY, "type", "checked", "violations", F.col("__f.row").alias("first_row"), F.col("__f.col").alias("first_col"))


def _wildcard(pattern: Column) -> Column:
    """Pattern of a filter as a regular expression: ``*`` any text, ``?`` one character, ``~`` makes the next one literal."""
    marked = pattern
    for i, ch in enumerate("*?~", 1):
        marked = F.replace(marked, F.lit("~" + ch), F.lit(chr(i)))
    plain = F.regexp_replace(marked, r"([\\.\[\]{}()+^$|])", r"\\$1")
    open_ = F.replace(F.replace(plain, F.lit("*"), F.lit(".*")), F.lit("?"), F.lit("."))
    for i, ch in enumerate(("\\*", "\\?", "~"), 1):
        open_ = F.replace(open_, F.lit(chr(i)), F.lit(ch))
    return F.concat(F.lit("(?s)^"), open_, F.lit("$"))


def evaluate_filters(cells: DataFrame, declared: DataFrame, today: dt.date) -> DataFrame:
    """Rows below the header of every declared filter, with ``visible``: whether all filtered columns let them pass.

    A row that has no cell in a filtered column is blank there. Filters by colour or icon hold nothing that cells tell;
    they let every row pass.
    """
    values = _values(cells)
    specs = items_of(cut_lineage(declared), "filter").filter("max_row > min_row").withColumns({"min_row": F.col("min_row") + 1, "column": F.col("min_col") + F.col("idx")})
    ranked = specs.filter((F.col("name") == "top10") | ((F.col("name") == "dynamic") & F.col("operator").isin("aboveAverage", "belowAverage")))
    met = covered(values, ranked.withColumns({"min_col": F.col("column"), "max_col": F.col("column")}).drop("ref", "column"))
    top = ranked.filter("name = 'top10'").select(
        *KEY, F.lit(0).alias("slot"), F.concat(F.when(F.col("on"), "top").otherwise("bottom"), F.when(F.col("operator") == "percent", "%").otherwise("")).alias("kind"),
        F.col("first").try_cast("double").alias("val"), F.lit(True).alias("gte"), F.lit(None).cast("string").alias("colour"),
    )
    specs = specs.join(thresholds(met, top).select(*KEY, "mean", "edges"), KEY, "left")

    areas = specs.select(*SHEET, "ref", *_BOUNDS).distinct()
    rows = tile_join(values.select(*SHEET, "row", "col"), areas).select(*SHEET, F.col("r_ref").alias("ref"), "row").distinct()
    area = [*SHEET, "ref"]
    asked = salted_join(rows, specs.groupBy(*area).agg(F.collect_list(F.struct("column", "name", "operator", "first", "on", "mean", "edges")).alias("__s")), area, "inner", hot=hot_keys(rows, area))
    asked = asked.select(*area, "row", F.explode("__s").alias("s")).select(*area, "row", F.col("s.column").alias("col"), "s.name", "s.operator", "s.first", "s.on", "s.mean", "s.edges")
    held = asked.join(values, [*SHEET, "row", "col"], "left")

    n, kind, op = F.col("num"), F.col("name"), F.col("operator")
    blank = F.col("text").isNull() | (F.trim("text") == "")
    want = F.col("first").try_cast("double")
    grain = F.concat_ws("-", F.year("v_ts"), F.month("v_ts"), F.day("v_ts"), F.hour("v_ts"), F.minute("v_ts"), F.second("v_ts").cast("int"))
    like = F.coalesce(F.rlike(F.lower("text"), _wildcard(F.lower("first"))), F.lit(False))
    text_test = F.when(F.col("first") == " ", F.when(op == "notEqual", ~blank).otherwise(blank)).when(op == "notEqual", ~like).when(op == "equal", like).otherwise(F.coalesce(compared(F.lower("text"), op, F.lower("first"), F.lit(None)), F.lit(False)))
    by_number = F.coalesce(compared(n, op, want, F.lit(None).cast("double")), op == "notEqual")
    period = F.when(op.rlike("^Q[1-4]$"), F.quarter("v_ts") == F.substring(op, 2, 1).cast("int")).when(op.rlike("^M[0-9]+$"), F.month("v_ts") == F.substring(op, 2, 2).cast("int"))
    ok = (
        F.when(kind == "value", F.when(F.col("first").isNull(), blank).otherwise(F.col("text") == F.col("first")))
        .when(kind == "date", F.startswith(F.concat(grain, F.lit("-")), F.concat("first", F.lit("-"))))
        .when(kind == "custom", F.when(want.isNotNull(), by_number).otherwise(text_test))
        .when(kind == "top10", F.when(F.col("on"), n >= _edge(0)).otherwise(n <= _edge(0)))
        .when(kind == "dynamic", F.when(op == "aboveAverage", n > F.col("mean")).when(op == "belowAverage", n < F.col("mean")).otherwise(F.coalesce(period, _span_hit(op, today))))
        .otherwise(F.lit(True))
    )
    passed = held.withColumn("ok", F.coalesce(ok, F.lit(False)))
    both = F.max((kind == "custom") & F.col("on"))
    per_column = passed.groupBy(*area, "row", "col").agg(F.when(both, F.min("ok")).otherwise(F.max("ok")).alias("ok"))
    return per_column.groupBy(*area, "row").agg(F.min("ok").alias("visible"))
