"""Chart-series analytics: facts are aggregated to series points first, then analysed per series.

Points are long tables (series, x, y). Trend fits are plain aggregates over any
number of points; ordered steps run over the aggregated points of one series.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridspark.operators.grid import SHEET, text_of
from gridspark.scale import balanced, block_of, running, salted_join, split_join, spread, whole

GRID_TILE = 4096


def extract_series(cells: DataFrame, by: str = "col", titles: bool = True, x: int | None = None, first: int = 1) -> DataFrame:
    """Series of every sheet: one per column (or row), as (book, sheet, series, title, idx, x, y).

    The first cell of a series may be its title; line ``x`` holds the x values, numbers or texts
    (``x_text`` has either as text).
    """
    along = "row" if by == "col" else "col"
    start = first + int(titles)
    points = cells.filter((F.col(along) >= start) & F.col("v_num").isNotNull())
    keys = [*SHEET, along]
    y = points if x is None else points.filter(F.col(by) != x)
    out = y.select(*SHEET, F.col(by).alias("series"), along, F.col("v_num").alias("y"))
    if x is not None:
        line = cells.filter((F.col(by) == x) & (F.col(along) >= start))
        xs = line.select(*keys, F.col("v_num").alias("x"), text_of().alias("x_text"))
        out = out.join(xs, keys, "left")
    else:
        place = F.col(along) - start + 1
        out = out.withColumns({"x": place.cast("double"), "x_text": place.cast("string")})
    if titles:
        heads = cells.filter(F.col(along) == first).select(*SHEET, F.col(by).alias("series"), text_of().alias("title"))
        out = split_join(out, heads, [*SHEET, "series"])
    else:
        out = out.withColumn("title", F.concat(F.lit("Series"), F.col("series")))
    return out.select(*SHEET, "series", "title", (F.col(along) - start).alias("idx"), "x", "x_text", "y")


def stack_series(points: DataFrame) -> DataFrame:
    """Cumulative y over the series at each x, in series order."""
    w = Window.partitionBy("x").orderBy("series").rowsBetween(Window.unboundedPreceding, 0)
    return points.withColumn("top", F.sum("y").over(w))


def percent_stack(points: DataFrame) -> DataFrame:
    """Each y as a share of its x, stacked to 100."""
    total = F.sum("y").over(Window.partitionBy("x"))
    return stack_series(points.withColumn("y", F.try_divide(F.col("y") * 100, total)))


def _linear(points: DataFrame, keys: list[str], x: Column, y: Column, intercept: float | None) -> DataFrame:
    """y = a + b x per series, with r2 against the mean of y."""
    p = points.select(*keys, x.cast("double").alias("__x"), y.cast("double").alias("__y")).filter(
        "__x is not null and __y is not null"
    )
    X, Y = F.col("__x"), F.col("__y")
    if intercept is None:
        return p.groupBy(*keys).agg(
            F.regr_intercept(Y, X).alias("a"), F.regr_slope(Y, X).alias("b"), F.regr_r2(Y, X).alias("r2")
        )
    c = F.lit(float(intercept))
    s = p.groupBy(*keys).agg(
        F.sum(X * X).alias("xx"), F.sum(X * (Y - c)).alias("xy"), F.sum((Y - c) * (Y - c)).alias("yy"),
        (F.var_pop(Y) * F.count(Y)).alias("sst"),
    )
    b = F.try_divide(F.col("xy"), F.col("xx"))
    sse = F.col("yy") - b * F.col("xy")
    return s.select(*keys, c.alias("a"), b.alias("b"), (1 - F.try_divide(sse, F.col("sst"))).alias("r2"))


def trend_linear(points: DataFrame, keys: list[str], intercept: float | None = None) -> DataFrame:
    return _linear(points, keys, F.col("x"), F.col("y"), intercept)


def _ln(c: Column) -> Column:
    return F.when(c > 0, F.ln(c))


def trend_exp(points: DataFrame, keys: list[str]) -> DataFrame:
    """y = a e^(b x)."""
    return _linear(points, keys, F.col("x"), _ln(F.col("y")), None).withColumn("a", F.exp("a"))


def trend_log(points: DataFrame, keys: list[str]) -> DataFrame:
    """y = a + b ln x."""
    return _linear(points, keys, _ln(F.col("x")), F.col("y"), None)


def trend_power(points: DataFrame, keys: list[str]) -> DataFrame:
    """y = a x^b."""
    return _linear(points, keys, _ln(F.col("x")), _ln(F.col("y")), None).withColumn("a", F.exp("a"))


def trend_poly(points: DataFrame, keys: list[str], order: int) -> DataFrame:
    """Polynomial of order 2 to 6: ``coef`` holds c0 … c_order.

    One aggregate gives the power sums of x scaled to [-1, 1]; the few normal
    equations of a series are then solved on its single row.
    """
    if not 2 <= order <= 6:
        raise ValueError("order must be 2 to 6")
    ends = points.groupBy(*keys).agg(
        ((F.max("x") + F.min("x")) / 2.0).alias("__mid"),
        F.greatest((F.max("x") - F.min("x")) / 2.0, F.lit(1e-300)).alias("__half"),
    )
    u = (F.col("x") - F.col("__mid")) / F.col("__half")
    power = lambda i: F.lit(1.0) if i == 0 else F.pow(u, F.lit(float(i)))
    scaled = salted_join(points.filter("x is not null and y is not null"), ends, keys, "inner")
    sums = scaled.groupBy(*keys, "__mid", "__half").agg(
        F.array(*[F.sum(power(i)) for i in range(2 * order + 1)]).alias("__s"),
        F.array(*[F.sum(power(i) * F.col("y")) for i in range(order + 1)]).alias("__t"),
    )

    @F.pandas_udf("array<double>")
    def solve(s: pd.Series, t: pd.Series, mid: pd.Series, half: pd.Series) -> pd.Series:
        import numpy as np
        from numpy.polynomial import polynomial as npp

        out = []
        for power_sums, moments, m, h in zip(s, t, mid, half):
            matrix = np.array([[power_sums[i + j] for j in range(order + 1)] for i in range(order + 1)])
            scaled_coef = np.linalg.lstsq(matrix, np.asarray(moments, float), rcond=None)[0]
            base, term, coef = np.array([-m / h, 1 / h]), np.array([1.0]), np.zeros(order + 1)
            for c in scaled_coef:
                coef[: len(term)] += c * term
                term = npp.polymul(term, base)
            out.append(coef.tolist())
        return pd.Series(out)

    return sums.select(*keys, solve("__s", "__t", "__mid", "__half").alias("coef"))


def poly_at(coef: Column, x: Column) -> Column:
    """Value of a fitted polynomial at x."""
    return F.aggregate(F.reverse(coef), F.lit(0.0), lambda acc, c: acc * x + c)


def moving_avg(points: DataFrame, keys: list[str], period: int, block: Column | None = None, size: int = 1 << 16) -> DataFrame:
    """Average of the last ``period`` points; undefined before there are that many.

    Points are numbered along ``x`` by a blocked scan and cut into pieces of ``size``; each piece also sees the
    ``period`` - 1 points before it, so a long series is many tasks. Unless ``block`` is given, blocks are cut by counted
    points, so ``x`` may be as fine, as coarse or as uneven as it likes; points at the same ``x`` follow a hash.
    """
    if block is None:
        tied = points.withColumn("__tie", F.xxhash64(*points.columns))
        tied = balanced(tied, *[F.col(c) for c in (*keys, "x", "__tie")])
        numbered = running(tied, keys, ["x", "__tie"], {"__n": ("row_number", None)}, F.col("__part")).drop("__part", "__tie")
    else:
        numbered = running(points, keys, ["x"], {"__n": ("row_number", None)}, block)
    own, ahead = F.floor((F.col("__n") - 1) / size), F.floor((F.col("__n") + period - 2) / size)
    cut = numbered.withColumn("__piece", F.explode(F.sequence(own, ahead))).withColumn("__own", F.col("__piece") == own)
    w = Window.partitionBy(*keys, "__piece").orderBy("__n").rowsBetween(-(period - 1), 0)
    seen = cut.withColumn("ma", F.when(F.col("__n") >= period, F.avg("y").over(w)))
    return seen.filter("__own").drop("__n", "__piece", "__own")


def trend_extend(points: DataFrame, keys: list[str], forward: float = 0, backward: float = 0, step: float = 1) -> DataFrame:
    """Linear trend drawn ``backward`` units before the first and ``forward`` units after the last x."""
    fit = trend_linear(points, keys)
    ends = points.groupBy(*keys).agg(F.min("x").cast("double").alias("lo"), F.max("x").cast("double").alias("hi"))

    def beyond(edge: Column, units: float, sign: int) -> Column:
        n = int(units / step + 1e-9)  # 0.3 holds three steps of 0.1
        return F.array(*[edge + F.lit(float(sign * i * step)) for i in range(1, n + 1)]).cast("array<double>")

    xs = F.explode(F.concat(beyond(F.col("lo"), backward, -1), beyond(F.col("hi"), forward, 1)))
    return ends.join(fit, keys).select(*keys, "a", "b", xs.alias("x")).select(*keys, "x", (F.col("a") + F.col("b") * F.col("x")).alias("y"))


def error_bars(points: DataFrame, keys: list[str], kind: str, amount: float | None = None, sides: str = "both",
               plus: Column | None = None, minus: Column | None = None) -> DataFrame:
    """fixedVal, percentage, stdDev, stdErr or cust; adds ``low`` and ``high``."""
    df = points
    if kind in ("stdDev", "stdErr"):
        s = points.groupBy(*keys).agg(F.avg("y").alias("__m"), F.stddev_samp("y").alias("__d"), F.count("y").alias("__n"))
        df = salted_join(points, s, keys, "inner")
    y = F.col("y")
    centre = y
    if kind == "fixedVal":
        up = down = F.lit(float(amount))
    elif kind == "percentage":
        up = down = F.abs(y) * float(amount) / 100
    elif kind == "stdDev":
        centre, up = F.col("__m"), F.col("__d") * float(amount)
        down = up
    elif kind == "stdErr":
        up = down = F.col("__d") / F.sqrt("__n")
    elif kind == "cust":
        up, down = plus, minus
    else:
        raise ValueError(f"unknown error bar {kind!r}")
    low = centre - down if sides in ("both", "minus") else F.lit(None).cast("double")
    high = centre + up if sides in ("both", "plus") else F.lit(None).cast("double")
    return df.withColumns({"low": low, "high": high}).drop("__m", "__d", "__n")


def fill_blanks(points: DataFrame, keys: list[str], how: str, step: int = 1) -> DataFrame:
    """Regular x grid per series between its first and last x; blanks as gap, zero or span.

    ``x`` is an integer (for times: an epoch divided to the grain). Span draws a
    straight line between the known neighbours.
    """
    ends = points.groupBy(*keys).agg(F.min("x").alias("__lo"), F.max("x").alias("__hi"))
    # first the tiles of a series, spread over the tasks, then the places of each tile
    tile = F.lit(GRID_TILE * step)
    count = F.floor((F.col("__hi") - F.col("__lo")) / tile)
    tiles = spread(ends.withColumn("__tile", F.explode(F.sequence(F.lit(0).cast("bigint"), count))), *keys, "__tile")
    first = F.col("__lo") + F.col("__tile") * tile
    places = F.sequence(first, F.least(F.col("__hi"), first + tile - step), F.lit(step).cast("bigint"))
    grid = tiles.select(*keys, F.explode(places).alias("x"))
    place = F.struct(*keys, "x").alias("__at")  # never null, so a null series meets its points
    full = grid.withColumn("__at", place).join(points.select(place, "y"), "__at", "left").drop("__at")
    if how == "gap":
        return full
    if how == "zero":
        return full.withColumn("y", F.coalesce("y", F.lit(0.0)))
    if how != "span":
        raise ValueError(f"unknown blank handling {how!r}")
    known = F.when(F.col("y").isNotNull(), F.struct(F.col("x").alias("x"), F.col("y").alias("y")))
    blocks = block_of("x", GRID_TILE * step)
    lefts = running(full, keys, ["x"], {"__l": ("last", known)}, blocks).withColumn("__back", -F.col("x"))
    both = running(lefts, keys, ["__back"], {"__r": ("last", known)}, -blocks).drop("__back")
    slope = (F.col("__r.y") - F.col("__l.y")) / (F.col("__r.x") - F.col("__l.x"))
    line = F.col("__l.y") + (F.col("x") - F.col("__l.x")) * slope
    return both.withColumn("y", F.coalesce("y", line)).drop("__l", "__r")


def project_pie(agg: DataFrame, value: str, kind: str, split=None, order: str | None = None, item: str | None = None) -> DataFrame:
    """Which slices move to the second plot: ``second`` flag by pos, val, percent or cust."""
    v = F.col(value)
    if kind == "pos":
        # the last ``split`` slices: from the least of the greatest positions on
        tail = agg.select(F.col(order).alias("__o")).orderBy(F.desc("__o")).limit(int(split))
        second = F.col(order) >= whole(tail, o=F.min("__o"))["o"]
    elif kind == "val":
        second = v < F.lit(split)
    elif kind == "percent":
        second = v * 100 < whole(agg, s=F.sum(v))["s"] * F.lit(split)
    elif kind == "cust":
        second = F.col(item).isin(split)
    else:
        raise ValueError(f"unknown split {kind!r}")
    return agg.withColumn("second", second)


def pie_groups(split: DataFrame, item: str, value: str) -> DataFrame:
    """First plot of a projected pie: the second plot's slices become ``Other``."""
    name = F.when(F.col("second"), F.lit("Other")).otherwise(F.col(item).cast("string"))
    return split.groupBy(name.alias(item)).agg(F.sum(value).alias(value))


def hilo(points: DataFrame) -> DataFrame:
    """Per x: lowest and highest y, first and last series' y, and whether the bar goes up."""
    out = points.groupBy("x").agg(
        F.min("y").alias("low"), F.max("y").alias("high"), F.min_by("y", "series").alias("first"), F.max_by("y", "series").alias("last")
    )
    return out.withColumn("up", F.col("last") > F.col("first"))
