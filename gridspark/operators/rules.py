"""Conditional rules as row flags, positions and buckets."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridspark.functions.scalars import ERROR_CODES
from gridspark.operators import filters, stats
from gridspark.scale import HOT_ROWS, salted_join, tile_join, whole

# Operator aliases.
ALIASES = {
    ">": "greaterThan",
    ">=": "greaterThanOrEqual",
    "<": "lessThan",
    "<=": "lessThanOrEqual",
    "=": "equal",
    "==": "equal",
    "!=": "notEqual",
}


def rule_cell_is(c: Column, operator: str, first, second=None) -> Column:
    """Comparison rule; between bounds may come in either order."""
    op = ALIASES.get(operator, operator)
    if op in ("between", "notBetween"):
        a, b = F.lit(first), F.lit(second)
        hit = c.between(F.least(a, b), F.greatest(a, b))
        return hit if op == "between" else ~hit
    return filters.compare(c, op, first)


def rule_expression(sql: str) -> Column:
    return F.coalesce(F.expr(sql), F.lit(False))


def rule_text(c: Column, kind: str, term: str) -> Column:
    """containsText, notContains, beginsWith, endsWith; case is ignored."""
    tests = {
        "containsText": ("contains", False),
        "notContains": ("contains", True),
        "beginsWith": ("startswith", False),
        "endsWith": ("endswith", False),
    }
    test, negate = tests[kind]
    return filters.text_test(c, test, term, negate)


def rule_blank_error(c: Column, kind: str) -> Column:
    """containsBlanks, notContainsBlanks, containsErrors, notContainsErrors."""
    blank = F.coalesce(filters.is_blank(c), F.lit(True))
    error = F.coalesce(c.cast("string").isin(ERROR_CODES), F.lit(False))
    return {
        "containsBlanks": blank,
        "notContainsBlanks": ~blank,
        "containsErrors": error,
        "notContainsErrors": ~error,
    }[kind]


def rule_unique(df: DataFrame, column: str, name: str = "duplicate") -> DataFrame:
    """Flag rows whose value occurs more than once; blanks are never flagged.

    Only the repeated values travel back; those that repeat most are salted.
    """
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("__n")).filter("__n > 1")
    hot = counts.filter(F.col("__n") > HOT_ROWS).select(column)
    out = salted_join(df, counts, [column], "left", hot=hot)
    return out.withColumn(name, F.col("__n").isNotNull()).drop("__n")


def rule_top10(df: DataFrame, column: str, rank: int, percent: bool = False, bottom: bool = False) -> Column:
    edge = stats.top_threshold(df, column, rank, percent, bottom)
    return F.col(column) <= edge if bottom else F.col(column) >= edge


def rule_average(df: DataFrame, column: str, above: bool = True, equal: bool = False, std_dev: int = 0) -> Column:
    """Against the average, or the average plus (minus) k sample standard deviations."""
    s = whole(df, m=F.avg(column), d=F.stddev_samp(column))
    edge = s["m"] + s["d"] * (std_dev if above else -std_dev) if std_dev else s["m"]
    c = F.col(column)
    if above:
        return c >= edge if equal else c > edge
    return c <= edge if equal else c < edge


def rule_time_period(c: Column, kind: str, today: dt.date) -> Column:
    return filters.relative_date(c, kind, today)


def color_scale(df: DataFrame, column: str, stops: list[tuple[str, float | str | None, str]]) -> DataFrame:
    """Two or three stops ``(kind, value, RRGGBB)``: adds ``position`` (0 … stops-1) and ``rgb``."""
    edges = stats.thresholds(df, column, [(k, v) for k, v, _ in stops])
    c = F.col(column)
    last = len(stops) - 1
    position = F.when(c.isNull(), F.lit(None).cast("double")).when(c >= edges[last], F.lit(float(last)))
    for i in range(last - 1, -1, -1):
        part = F.coalesce(F.try_divide(c - edges[i], edges[i + 1] - edges[i]), F.lit(0.0))
        position = position.when(c >= edges[i], part + i)
    placed = df.withColumn("position", position.otherwise(F.lit(0.0)))

    def channel(at: int) -> Column:
        v = [int(rgb[at : at + 2], 16) for _, _, rgb in stops]
        p, mix = F.col("position"), F.lit(float(v[last]))
        for i in range(last - 1, -1, -1):
            mix = F.when(p < i + 1, F.lit(float(v[i])) + (p - i) * float(v[i + 1] - v[i])).otherwise(mix)
        return F.lpad(F.hex(F.round(mix).cast("int")), 2, "0")

    rgb = F.when(F.col("position").isNotNull(), F.concat(channel(0), channel(2), channel(4)))
    return placed.withColumn("rgb", rgb)


def icon_bucket(
    df: DataFrame, column: str, stops: list[tuple[str, float | str | None, bool]], reverse: bool = False
) -> Column:
    """Index of the highest threshold met; stops are ``(kind, value, gte)``, one per icon."""
    edges = stats.thresholds(df, column, [(k, v) for k, v, _ in stops])
    c, n = F.col(column), len(stops)
    bucket = F.when(c.isNull(), F.lit(None).cast("int"))
    for i in range(n - 1, 0, -1):
        bucket = bucket.when(c >= edges[i] if stops[i][2] else c > edges[i], F.lit(i))
    bucket = bucket.otherwise(F.lit(0))
    return F.lit(n - 1) - bucket if reverse else bucket


def data_bar(
    df: DataFrame, column: str, low: tuple = ("min", None), high: tuple = ("max", None), shortest: int = 10, longest: int = 90
) -> Column:
    """Bar length in percent, clamped to the shortest and longest bar."""
    lo, hi = stats.thresholds(df, column, [low, high])
    part = F.coalesce(F.try_divide(F.col(column) - lo, hi - lo), F.lit(0.0))
    length = F.lit(float(shortest)) + part * float(longest - shortest)
    return F.greatest(F.lit(float(shortest)), F.least(F.lit(float(longest)), length))


def assign_priorities(rules: list[dict]) -> list[dict]:
    """Unset priorities become the rule's place of insertion; lowest number first."""
    made = [{**r, "priority": r.get("priority") or i} for i, r in enumerate(rules, 1)]
    return sorted(made, key=lambda r: r["priority"])


def resolve_rules(df: DataFrame, rules: list[dict]) -> DataFrame:
    """Rules ``{id, test, priority, stop}``: adds ``winner`` and ``applied`` (ids in order).

    A hit on a stop rule keeps every later rule from applying.
    """
    blocked, applied, winner = F.lit(False), [], F.lit(None).cast("int")
    ordered = assign_priorities(rules)
    for r in ordered:
        hit = F.coalesce(r["test"], F.lit(False)) & ~blocked
        applied.append(F.when(hit, F.lit(r["id"])))
        if r.get("stop"):
            blocked = blocked | hit
    winner = F.coalesce(*applied)
    return df.withColumns({"winner": winner, "applied": F.array_compact(F.array(*applied))})


def dedupe_formats(formats: DataFrame, keys: list[str]) -> DataFrame:
    """Per key the format with the lowest priority number. formats(<keys>, fmt, priority)."""
    return formats.groupBy(*keys).agg(
        F.min_by("fmt", "priority").alias("fmt"), F.min("priority").alias("priority")
    )


def rules_for_cells(cells: DataFrame, ranges: DataFrame) -> DataFrame:
    """Cells with every rule that covers them. ranges(book, sheet, rule_id, bounds …)."""
    return tile_join(cells, ranges).withColumnRenamed("r_rule_id", "rule_id")
