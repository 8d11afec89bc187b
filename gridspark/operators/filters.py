"""Auto-filters and sorts. Predicates are columns, so they reach the scan where Spark can push them."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridspark.operators import stats
from gridspark.scale import running, whole

GRAINS = ["year", "month", "day", "hour", "minute", "second"]


def value_filter(df: DataFrame, column: str, values: list, blank: bool = False) -> DataFrame:
    """Rows whose value is listed; ``blank`` also keeps empty ones."""
    keep = F.col(column).isin(values)
    if blank:
        keep = keep | F.col(column).isNull()
    return df.filter(keep)


def date_group(column: str, items: list[dict[str, int]]) -> Column:
    """True when the date falls in any item, e.g. ``{"year": 1996, "month": 5}``."""
    any_item = F.lit(False)
    for item in items:
        parts = [item.get(g) for g in GRAINS]
        known = [p for p in parts if p is not None]
        if parts[: len(known)] != known:
            raise ValueError(f"date item must name every grain above its last: {item}")
        lo = dt.datetime(*(known + [1, 1])[:3] if len(known) < 3 else known)
        any_item = any_item | _from_to(F.col(column), lo, _next(lo, GRAINS[len(known) - 1]))
    return any_item


def _next(at: dt.datetime, grain: str) -> dt.datetime:
    if grain == "year":
        return at.replace(year=at.year + 1)
    if grain == "month":
        return _add_months(at, 1)
    return at + dt.timedelta(**{grain + "s": 1})


def _add_months(at: dt.datetime, n: int) -> dt.datetime:
    total = at.year * 12 + at.month - 1 + n
    return at.replace(year=total // 12, month=total % 12 + 1)


def _ntz(at: dt.datetime) -> Column:
    return F.lit(at.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")


def _from_to(c: Column, lo: dt.datetime, hi: dt.datetime) -> Column:
    return (c >= _ntz(lo)) & (c < _ntz(hi))


def date_group_filter(df: DataFrame, column: str, items: list[dict[str, int]]) -> DataFrame:
    return df.filter(date_group(column, items))


_COMPARE = {
    "equal": lambda c, v: c == v,
    "notEqual": lambda c, v: c != v,
    "lessThan": lambda c, v: c < v,
    "lessThanOrEqual": lambda c, v: c <= v,
    "greaterThan": lambda c, v: c > v,
    "greaterThanOrEqual": lambda c, v: c >= v,
}


def compare(c: Column, operator: str, value) -> Column:
    return _COMPARE[operator](c, F.lit(value) if not isinstance(value, Column) else value)


def custom(column: str, tests: list[tuple[str, float]], both: bool = False) -> Column:
    """One or two numeric tests, joined by AND when ``both``, else OR."""
    if not 1 <= len(tests) <= 2:
        raise ValueError("one or two tests")
    made = [compare(F.col(column), op, v) for op, v in tests]
    if len(made) == 1:
        return made[0]
    return made[0] & made[1] if both else made[0] | made[1]


def custom_filter(df: DataFrame, column: str, tests: list[tuple[str, float]], both: bool = False) -> DataFrame:
    return df.filter(custom(column, tests, both))


def wildcard_regex(pattern: str) -> str:
    """``*`` any text, ``?`` one character, ``~`` makes the next of ``* ? ~`` literal."""
    out, i = "", 0
    while i < len(pattern):
        ch = pattern[i]
        if ch == "~" and i + 1 < len(pattern) and pattern[i + 1] in "*?~":
            i += 1
            out += re.escape(pattern[i])
        elif ch == "*":
            out += ".*"
        elif ch == "?":
            out += "."
        else:
            out += re.escape(ch)
        i += 1
    return f"(?s)^{out}$"


def text_test(c: Column, kind: str, term: str, exclude: bool = False) -> Column:
    """contains, startswith, endswith or wildcard, ignoring case; blanks never match."""
    low, t = F.lower(c), term.lower()
    if kind == "contains":
        hit = low.contains(t)
    elif kind == "startswith":
        hit = low.startswith(t)
    elif kind == "endswith":
        hit = low.endswith(t)
    elif kind == "wildcard":
        hit = low.rlike(wildcard_regex(t))
    else:
        raise ValueError(f"unknown text test {kind!r}")
    hit = F.coalesce(hit, F.lit(False))
    return ~hit if exclude else hit


def text_filter(df: DataFrame, column: str, kind: str, term: str, exclude: bool = False) -> DataFrame:
    return df.filter(text_test(F.col(column), kind, term, exclude))


def classify_filter(specs: DataFrame) -> DataFrame:
    """Filter specs (operator, val) to kind, test, term and exclude.

    A single blank is the non-blank filter, text that reads as a float a number
    filter, the rest a text filter whose stars pick the test. Escaped wildcards
    stand for themselves.
    """
    v = F.col("val")
    plain = F.regexp_replace(v, r"~[~*?]", "_")
    stars = F.length(plain) - F.length(F.replace(plain, F.lit("*"), F.lit("")))
    only = ~plain.contains("?")
    ends = only & (stars == 1) & plain.startswith("*")
    starts = only & (stars == 1) & plain.endswith("*")
    contains = only & (stars == 2) & plain.startswith("*") & plain.endswith("*")
    number = v.try_cast("double").isNotNull()
    kind = F.when(v == " ", "blank").when(number, "number").otherwise("text")
    test = F.when(ends, "endswith").when(starts, "startswith").when(contains, "contains").otherwise("wildcard")
    n = F.length(v)
    cut = (
        F.when(ends, F.substring(v, F.lit(2), n))
        .when(starts, F.substring(v, F.lit(1), n - 1))
        .when(contains, F.substring(v, F.lit(2), n - 2))
    )
    literal = F.regexp_replace(cut, r"~([~*?])", "$1")
    text = F.col("kind") == "text"
    return specs.withColumn("kind", kind).withColumns(
        {
            "test": F.when(text, test).when(F.col("kind") == "blank", "notEqual").otherwise(F.col("operator")),
            "term": F.when(text, F.coalesce(literal, v)).otherwise(v),
            "exclude": text & (F.col("operator") == "notEqual"),
        }
    )


def is_blank(c: Column) -> Column:
    return c.isNull() | (F.trim(c.cast("string")) == "")


def nonblank_filter(df: DataFrame, column: str) -> DataFrame:
    return df.filter(~is_blank(F.col(column)))


def top_n(df: DataFrame, column: str, n: int, percent: bool = False, bottom: bool = False) -> DataFrame:
    """Top or bottom N (percent) rows, with all ties at the threshold."""
    edge = stats.top_threshold(df, column, n, percent, bottom)
    return df.filter(F.col(column) <= edge if bottom else F.col(column) >= edge)


def dynamic_average(df: DataFrame, column: str, above: bool = True) -> DataFrame:
    """Strictly above or below the average."""
    mean = whole(df, m=F.avg(column))["m"]
    return df.filter(F.col(column) > mean if above else F.col(column) < mean)


def relative_date(c: Column, kind: str, today: dt.date) -> Column:
    """Date test relative to ``today``; weeks start on Sunday."""
    day = dt.datetime(today.year, today.month, today.day)
    week = day - dt.timedelta(days=(day.weekday() + 1) % 7)
    month = day.replace(day=1)
    quarter = day.replace(day=1, month=(day.month - 1) // 3 * 3 + 1)
    year = day.replace(day=1, month=1)
    days = lambda n: dt.timedelta(days=n)
    spans = {
        "today": (day, day + days(1)),
        "yesterday": (day - days(1), day),
        "tomorrow": (day + days(1), day + days(2)),
        "last7Days": (day - days(6), day + days(1)),
        "thisWeek": (week, week + days(7)),
        "lastWeek": (week - days(7), week),
        "nextWeek": (week + days(7), week + days(14)),
        "thisMonth": (month, _add_months(month, 1)),
        "lastMonth": (_add_months(month, -1), month),
        "nextMonth": (_add_months(month, 1), _add_months(month, 2)),
        "thisQuarter": (quarter, _add_months(quarter, 3)),
        "lastQuarter": (_add_months(quarter, -3), quarter),
        "nextQuarter": (_add_months(quarter, 3), _add_months(quarter, 6)),
        "thisYear": (year, _add_months(year, 12)),
        "lastYear": (_add_months(year, -12), year),
        "nextYear": (_add_months(year, 12), _add_months(year, 24)),
        "yearToDate": (year, day + days(1)),
    }
    return _from_to(c, *spans[kind])


def period_of_year(c: Column, period: str) -> Column:
    """``Q1``–``Q4`` or ``M1``–``M12`` of any year."""
    n = int(period[1:])
    return F.quarter(c) == n if period[0] == "Q" else F.month(c) == n


def icon_filter(df: DataFrame, icon: Column, icon_id: int | None) -> DataFrame:
    """Rows that show the icon, or none when ``icon_id`` is None."""
    return df.filter(icon.isNull() if icon_id is None else icon == icon_id)


def _custom_place(c: Column, listed: list[str]) -> Column:
    place = F.array_position(F.array(*[F.lit(v) for v in listed]), c)
    return F.when(place > 0, place).when(c.isNotNull(), F.lit(len(listed) + 1))


def _key(k: dict) -> Column:
    c = F.col(k["column"])
    if k.get("custom"):
        return _custom_place(c, k["custom"])
    return F.lower(c) if k.get("text") and not k.get("case_sensitive") else c


def sort_keys(keys: list[dict]) -> list[Column]:
    """Sort keys ``{column, descending, custom, case_sensitive}``; blanks last either way."""
    out = []
    for k in keys:
        c = _key(k)
        out.append(c.desc_nulls_last() if k.get("descending") else c.asc_nulls_last())
    return out


def sort_state(df: DataFrame, keys: list[dict]) -> DataFrame:
    return df.orderBy(*sort_keys(keys))


def sort_rank(df: DataFrame, keys: list[dict], block: list[Column], name: str = "rank") -> DataFrame:
    """Position of every row under the keys of ``sort_keys``, each in its own type, without a global sort window.

    ``block`` lists coarse forms of the leading keys, over columns ``__k0``, ``__k1``, …, that ascend
    along the sort (so of a descending key the negative).
    """
    cols = {f"__k{i}": _key(k) for i, k in enumerate(keys)}
    by = [F.col(c).desc_nulls_last() if k.get("descending") else F.col(c).asc_nulls_last() for c, k in zip(cols, keys, strict=True)]
    blocks = F.struct(*[b.alias(f"b{i}") for i, b in enumerate(block)])
    return running(df.withColumns(cols), [], list(cols), {name: ("row_number", None)}, blocks, by).drop(*cols)


def auto_filter(df: DataFrame, tests: list[Column], sort: list[dict] | None = None) -> DataFrame:
    """All column filters together, then the sort."""
    kept = df
    for t in tests:
        kept = kept.filter(t)
    return sort_state(kept, sort) if sort else kept
