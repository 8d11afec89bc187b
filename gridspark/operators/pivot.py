"""Pivot tables: aggregation over facts first, every "show as" on the small aggregate.

Windows here run over pivot items, never over facts; pivots that are shown have
at most a sheet's worth of items.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridspark.operators import filters
from gridspark.operators.stats import top_threshold
from gridspark.scale import balanced, running, whole

# Data functions.
FUNCTIONS = {
    "average": F.avg,
    "count": F.count,
    "countNums": lambda c: F.count(c.try_cast("double")),
    "max": F.max,
    "min": F.min,
    "product": F.product,
    "stdDev": F.stddev_samp,
    "stdDevp": F.stddev_pop,
    "sum": F.sum,
    "var": F.var_samp,
    "varp": F.var_pop,
}


def data_field(fn: str, column: str, name: str | None = None) -> Column:
    return FUNCTIONS[fn](F.col(column)).alias(name or f"{fn}_{column}")


def pivot(df: DataFrame, rows: list[str], column: str, items: list, data: list[Column]) -> DataFrame:
    """Row fields down, the listed items of one column field across, one or more data fields."""
    return df.groupBy(*rows).pivot(column, items).agg(*data)


def pivot_subtotals(df: DataFrame, rows: list[str], column: str, fn: str = "sum", subtotals: dict[str, list[str]] | None = None) -> DataFrame:
    """Detail rows plus subtotals of every row field and the grand total, in one rollup.

    ``subtotals`` gives the functions of a field's subtotal lines; the default
    is the data field's own. ``level`` counts the row fields a line still shows.
    """
    subtotals = subtotals or {}
    wanted = sorted({fn, *[f for fs in subtotals.values() for f in fs]})
    rolled = df.rollup(*rows).agg(F.grouping_id().alias("__g"), *[data_field(f, column, f"__{f}") for f in wanted])
    shown = F.lit(0)
    lines = None
    for level in range(len(rows) + 1):
        hidden = len(rows) - level
        fns = subtotals.get(rows[level - 1], [fn]) if 0 < level < len(rows) else [fn]
        pairs = F.array(*[F.struct(F.lit(f).alias("fn"), F.col(f"__{f}").cast("double").alias("value")) for f in fns])
        here = F.col("__g") == (1 << hidden) - 1
        shown = F.when(here, F.lit(level)).otherwise(shown)
        lines = F.when(here, pairs) if lines is None else lines.when(here, pairs)
    return rolled.select(*rows, shown.alias("level"), F.inline(lines))


def pivot_grand(df: DataFrame, row: str, column: str, data: list[Column], by_row: bool = True, by_column: bool = True) -> DataFrame:
    """Body with row totals, column totals and the grand total; ``part`` names the line's role."""
    sets = [[F.col(row), F.col(column)]]
    if by_row:
        sets.append([F.col(row)])
    if by_column:
        sets.append([F.col(column)])
    if by_row and by_column:
        sets.append([])
    g = df.groupingSets(sets, row, column).agg(F.grouping_id().alias("__g"), *data)
    part = F.element_at(F.array(*[F.lit(x) for x in ("body", "row", "column", "grand")]), (F.col("__g") + 1).cast("int"))
    return g.withColumn("part", part).drop("__g")


def page_filter(df: DataFrame, pages: dict[str, list], hidden: dict[str, list] | None = None) -> DataFrame:
    """Only the chosen page items, without hidden items."""
    keep = F.lit(True)
    for field, items in pages.items():
        keep = keep & F.col(field).isin(items)
    for field, items in (hidden or {}).items():
        keep = keep & ~F.coalesce(F.col(field).isin(items), F.lit(False))
    return df.filter(keep)


def with_hidden(df: DataFrame, field: str, hidden: list, data: Column, visual_totals: bool) -> DataFrame:
    """Visible items and a total that counts the hidden items unless ``visual_totals``."""
    seen = df if not visual_totals else df.filter(~F.col(field).isin(hidden))
    rolled = seen.rollup(field).agg(F.grouping(field).alias("__t"), data)
    kept = rolled.filter((F.col("__t") == 1) | ~F.col(field).isin(hidden))
    return kept.withColumn("is_total", F.col("__t") == 1).drop("__t")


def show_vs_base(agg: DataFrame, field: str, value: str, base, mode: str, within: list[str], name: str = "shown") -> DataFrame:
    """difference, percent or percentDiff against an item of ``field``, or "previous" / "next"."""
    w = Window.partitionBy(*within)
    if base == "previous":
        ref = F.lag(value).over(w.orderBy(field))
    elif base == "next":
        ref = F.lead(value).over(w.orderBy(field))
    else:
        ref = F.max(F.when(F.col(field) == base, F.col(value))).over(w)
    v = F.col(value)
    shown = {
        "difference": v - ref,
        "percent": F.try_divide(v, ref),
        "percentDiff": F.try_divide(v - ref, ref),
    }[mode]
    return agg.withColumn(name, shown)


def show_running(agg: DataFrame, field: str, value: str, within: list[str], name: str = "running") -> DataFrame:
    w = Window.partitionBy(*within).orderBy(field).rowsBetween(Window.unboundedPreceding, 0)
    return agg.withColumn(name, F.sum(value).over(w))


def _totals(agg: DataFrame, value: str, row: str, column: str) -> tuple[Column, Column, Column]:
    return (
        F.sum(value).over(Window.partitionBy(row)),
        F.sum(value).over(Window.partitionBy(column)),
        whole(agg, s=F.sum(value))["s"],
    )


def show_share(agg: DataFrame, row: str, column: str, value: str) -> DataFrame:
    """Share of the row, of the column and of the whole."""
    r, c, g = _totals(agg, value, row, column)
    v = F.col(value)
    return agg.withColumns({"of_row": F.try_divide(v, r), "of_column": F.try_divide(v, c), "of_total": F.try_divide(v, g)})


def show_index(agg: DataFrame, row: str, column: str, value: str, name: str = "index") -> DataFrame:
    """value * grand total / (row total * column total)."""
    r, c, g = _totals(agg, value, row, column)
    return agg.withColumn(name, F.try_divide(F.col(value) * g, r * c))


def group_range(c: Column, start: float, end: float, step: float) -> Column:
    """Bucket struct(place, label): below start is place 0, above end the last one.

    A span that the step does not divide ends in a shorter bucket; the end value
    itself belongs to the last regular bucket.
    """
    import math

    n = math.ceil((end - start) / step)
    place = F.when(c < start, 0).when(c > end, n + 1).otherwise(F.least(F.floor((c - start) / step) + 1, F.lit(n)))
    text = lambda x: f"{x:g}"
    labels = [f"<{text(start)}"] + [f"{text(start + i * step)}-{text(min(start + (i + 1) * step, end))}" for i in range(n)] + [f">{text(end)}"]
    label = F.element_at(F.array(*[F.lit(x) for x in labels]), (place + 1).cast("int"))
    return F.struct(place.cast("int").alias("place"), F.when(c.isNotNull(), label).alias("label"))


def group_date(c: Column, by: str, interval: int = 1, start: dt.date | None = None) -> Column:
    """Start of the period: seconds minutes hours days months quarters years; days may span ``interval``."""
    if by == "days" and interval > 1:
        origin = F.lit(start or dt.date(1970, 1, 1))
        n = F.floor(F.datediff(c.cast("date"), origin) / interval) * interval
        return F.date_add(origin, n.cast("int")).cast("timestamp_ntz")
    return F.date_trunc(by[:-1], c).cast("timestamp_ntz")


def group_discrete(c: Column, groups: dict[str, list[str]]) -> Column:
    """Items to named groups; an item in no group stays itself."""
    out = None
    for name, items in groups.items():
        hit = c.isin(items)
        out = F.when(hit, F.lit(name)) if out is None else out.when(hit, F.lit(name))
    return out.otherwise(c)


def label_filter(c: Column, kind: str, *terms) -> Column:
    """captionEqual, captionNotEqual, captionContains, captionBetween, captionGreaterThan, …"""
    low = F.lower(c)
    t = [str(x).lower() for x in terms]
    negate = "Not" in kind
    base = kind.replace("caption", "").replace("Not", "")
    tests = {
        "Equal": lambda: low == t[0],
        "Contains": lambda: low.contains(t[0]),
        "BeginsWith": lambda: low.startswith(t[0]),
        "EndsWith": lambda: low.endswith(t[0]),
        "GreaterThan": lambda: low > t[0],
        "GreaterThanOrEqual": lambda: low >= t[0],
        "LessThan": lambda: low < t[0],
        "LessThanOrEqual": lambda: low <= t[0],
        "Between": lambda: low.between(t[0], t[1]),
    }
    hit = tests[base]()
    return ~hit if negate else hit


def value_filter(agg: DataFrame, value: str, kind: str, *terms: float) -> DataFrame:
    """valueEqual, valueGreaterThan, valueBetween, valueNotBetween, … on an aggregate."""
    c, negate = F.col(value), "Not" in kind
    base = kind.replace("value", "").replace("Not", "")
    if base == "Between":
        hit = c.between(F.lit(terms[0]), F.lit(terms[1]))
    else:
        hit = filters.compare(c, base[0].lower() + base[1:], terms[0])
    return agg.filter(~hit if negate else hit)


def date_filter(c: Column, kind: str, *terms: dt.date, today: dt.date | None = None) -> Column:
    """dateEqual, dateOlderThan, dateNewerThan, dateBetween (and negations), relative kinds, Q1 … M12."""
    day = c.cast("date")
    t = [F.lit(x) for x in terms]
    tests = {
        "dateEqual": lambda: day == t[0],
        "dateNotEqual": lambda: day != t[0],
        "dateOlderThan": lambda: day < t[0],
        "dateOlderThanOrEqual": lambda: day <= t[0],
        "dateNewerThan": lambda: day > t[0],
        "dateNewerThanOrEqual": lambda: day >= t[0],
        "dateBetween": lambda: day.between(t[0], t[1]),
        "dateNotBetween": lambda: ~day.between(t[0], t[1]),
    }
    if kind in tests:
        return tests[kind]()
    if kind[0] in "QM" and kind[1:].isdigit():
        return filters.period_of_year(c, kind)
    return filters.relative_date(c, kind, today)


def top_by_measure(agg: DataFrame, value: str, kind: str, amount: float, bottom: bool = False) -> DataFrame:
    """Top (bottom) items by count, by percent of the sum, or until a sum is reached; ties are kept.

    The threshold value comes from a blocked scan over the distinct values, so
    the number of items may be as large as it likes.
    """
    c = F.col(value)
    if kind == "count":
        edge = top_threshold(agg, value, int(amount), bottom=bottom)
    else:
        target = F.lit(float(amount))
        if kind == "percent":
            target = whole(agg, s=F.sum(c))["s"] * (amount / 100)
        sign = F.lit(1 if bottom else -1)
        counts = agg.filter(c.isNotNull()).groupBy((c * sign).alias("v")).agg(F.sum(c).alias("s"))
        parts = balanced(counts, F.col("v"))
        scan = running(parts, [], ["v"], {"cum": ("sum", F.col("s"))}, F.col("__part"))
        # the first value, walking from the best, at which the target is reached; all when it never is
        reached = scan.filter(F.col("cum") >= target).agg(F.min("v")).scalar()
        edge = F.coalesce(reached, whole(parts, hi=F.max("v"))["hi"]) * sign
    return agg.filter(c <= edge if bottom else c >= edge)


def sort_items(agg: DataFrame, field: str, how: str = "ascending", manual: list | None = None, by: str | None = None) -> DataFrame:
    """Adds ``place`` of every item: manual list first, then by label or by a data field.

    Items are dealt to ranges of about equally many, counted, and numbered within each, so there may be any number.
    """
    if how == "manual":
        at = F.array_position(F.array(*[F.lit(v) for v in manual]), F.col(field))
        order = [F.when(at > 0, at).otherwise(len(manual) + 1), F.col(field)]
    else:
        lead = F.col(by or field)
        order = [lead.desc() if how == "descending" else lead.asc(), F.col(field)]
    placed = running(balanced(agg, *order), [], [field], {"place": ("row_number", None)}, F.col("__part"), by=order)
    return placed.withColumn("place", F.col("place").cast("int")).drop("__part")


def calc_field(agg: DataFrame, name: str, sql: str) -> DataFrame:
    """Formula over the summed data fields."""
    return agg.withColumn(name, F.expr(sql))


def calc_item(agg: DataFrame, field: str, name: str, weights: dict, value: str, within: list[str]) -> DataFrame:
    """A new item as a weighted sum of items, next to the existing ones."""
    weight = None
    for item, w in weights.items():
        weight = F.when(F.col(field) == item, F.lit(float(w))) if weight is None else weight.when(F.col(field) == item, F.lit(float(w)))
    made = agg.filter(F.col(field).isin(list(weights))).groupBy(*within).agg(F.sum(F.col(value) * weight).alias(value))
    return agg.unionByName(made.withColumn(field, F.lit(name)).select(agg.columns))


def show_empty(agg: DataFrame, items: dict[str, list], fill: dict) -> DataFrame:
    """Every combination of the listed items, with and without data."""
    spark = agg.sparkSession
    grid = spark.range(1).select()
    for field, values in items.items():
        grid = grid.withColumn(field, F.explode(F.array(*[F.lit(v) for v in values])))
    return grid.join(agg, list(items), "left").fillna(fill)


def consolidate(parts: list[tuple[DataFrame, list[str]]]) -> DataFrame:
    """Ranges stacked by column name, each tagged with up to four page items."""
    out = None
    for df, pages in parts:
        if len(pages) > 4:
            raise ValueError("at most four page fields")
        tagged = df.withColumns({f"page{i}": F.lit(p) for i, p in enumerate(pages, 1)})
        out = tagged if out is None else out.unionByName(tagged, allowMissingColumns=True)
    return out
