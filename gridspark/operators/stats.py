"""Whole-table thresholds: order statistics and the threshold kinds rules are written in.

Everything is a scalar subquery, so nothing reaches the driver and nothing is
joined. Order statistics read the rows once to count the distinct values, which are dealt
to blocks of about equal size wherever they lie and then scanned: exact, and no task holds all values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridspark.scale import balanced, running, whole


def value_counts(df: DataFrame, value: Column) -> DataFrame:
    """Distinct values ``v`` with their count ``n``: one pass, from which all order statistics are taken."""
    rows = df.select(value.cast("double").alias("v")).filter("v is not null")
    return rows.groupBy("v").agg(F.count(F.lit(1)).alias("n"))


def value_blocks(df: DataFrame, value: Column) -> DataFrame:
    """``value_counts``, saved once in blocks of about equally many values; all that follows reads them instead of the rows."""
    return balanced(value_counts(df, value), F.col("v"))


def ranked_values(blocks: DataFrame) -> DataFrame:
    """``value_blocks`` with the rows up to and including each value, ``cum``."""
    return running(blocks, [], ["v"], {"cum": ("sum", F.col("n"))}, F.col("__part")).drop("__part")


def _at(position: Column) -> Column:
    """Value at a 1-based position, as an aggregate over ``ranked_values``."""
    return F.max(F.when((F.col("cum") >= position) & (F.col("cum") - F.col("n") < position), F.col("v")))


def nth_value(blocks: DataFrame, position: Column) -> Column:
    """Value at 1-based ``position`` in ascending order."""
    return ranked_values(blocks).agg(_at(position)).scalar()


def percentiles(df: DataFrame, value: Column, fractions: list[float]) -> Column:
    """Exact percentiles with linear interpolation, as a struct p0, p1, …"""
    return percentiles_of(value_blocks(df, value), fractions)


def percentiles_of(blocks: DataFrame, fractions: list[float]) -> Column:
    n = whole(blocks, n=F.sum("n"))["n"]
    fields = []
    for i, p in enumerate(fractions):
        position = (n - 1) * F.lit(float(p))
        low = F.floor(position)
        a, b = _at(low + 1), _at(F.ceil(position) + 1)
        fields.append((a + (b - a) * (position - low)).alias(f"p{i}"))
    return ranked_values(blocks).agg(F.struct(*fields)).scalar()


def thresholds(df: DataFrame, column: str, stops: list[tuple[str, float | str | None]]) -> list[Column]:
    """Columns for threshold stops ``(kind, value)``.

    Kinds: num, min, max, percent (of the span), percentile, formula (SQL text).
    """
    c = F.col(column)
    wanted = [float(v) / 100 for k, v in stops if k == "percentile"]
    blocks = value_blocks(df, c) if wanted else None
    exact = percentiles_of(blocks, wanted) if wanted else None
    ends = whole(blocks, lo=F.min("v"), hi=F.max("v")) if wanted else whole(df, lo=F.min(c).cast("double"), hi=F.max(c).cast("double"))
    out, i = [], 0
    for kind, v in stops:
        if kind == "num":
            out.append(F.lit(float(v)))
        elif kind == "min":
            out.append(ends["lo"])
        elif kind == "max":
            out.append(ends["hi"])
        elif kind == "percent":
            out.append(ends["lo"] + (ends["hi"] - ends["lo"]) * F.lit(float(v) / 100))
        elif kind == "percentile":
            out.append(exact[f"p{i}"])
            i += 1
        elif kind == "formula":
            out.append(F.expr(str(v)).cast("double"))
        else:
            raise ValueError(f"unknown threshold kind {kind!r}")
    return out


def top_threshold(df: DataFrame, column: str, n: int, percent: bool = False, bottom: bool = False) -> Column:
    """Value of the last row that belongs to the top (bottom) N or N percent; ties share it.

    N percent of the rows is max(1, floor(count * N / 100)).
    """
    c = F.col(column)
    if not percent:
        best = df.select(c.alias("v")).filter("v is not null")
        best = best.orderBy(F.col("v") if bottom else F.col("v").desc()).limit(n)
        return best.agg(F.max("v") if bottom else F.min("v")).scalar()
    blocks = value_blocks(df, c)
    count = whole(blocks, n=F.sum("n"))["n"]
    take = F.greatest(F.lit(1), F.floor(count * F.lit(n) / 100))
    return nth_value(blocks, take if bottom else count - take + 1)
