"""Typing and profiling over whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridspark.functions import scalars as S
from gridspark.scale import hot_keys, running, salted_join

MAX_TEXT = 32767
# Control characters a sheet cannot hold.
ILLEGAL = r"[\x00-\x08\x0B\x0C\x0E-\x1F]"
LONG_TEXT = 255


def type_cells(raw: DataFrame, epoch: int | Column = 1900) -> DataFrame:
    """Stored cells to typed columns.

    raw(…, t, v, formula, style_class): ``t`` is the stored type code (n, b, e,
    str, inlineStr, d; shared strings are decoded before), ``style_class`` the
    class of the number format. Blank values stay empty. ``epoch`` may be a
    column, for books of both date systems.
    """
    t = F.col("t")
    text = t.isin("str", "inlineStr")
    v = F.when(F.col("v") != "", F.when(text | (F.trim("v") != ""), F.col("v")))
    # one projection per step: values used again stay columns, and every generated method stays short
    parsed = raw.withColumn("__v", v).withColumns({"__number": F.when(t.isin("n", "b"), F.col("__v").try_cast("double")), "__iso": F.when(t == "d", F.col("__v"))})
    number = F.col("__number")
    dated = (t == "n") & F.col("style_class").isin("date", "datetime", "time")
    spanned = (t == "n") & (F.col("style_class") == "timedelta")
    day, clock = S.iso_parts(F.col("__iso"))
    staged = parsed.withColumns({"__serial": F.when(dated, S.from_serial(number, epoch)), "__day": day, "__clock": clock})
    day, clock = F.col("__day"), F.col("__clock")
    stamp = F.when(clock == "", day.try_cast("date").cast("timestamp_ntz")).otherwise(F.concat(day, F.lit(" "), clock).try_cast("timestamp_ntz"))
    return staged.withColumns(
        {
            "dtype": F.when(F.col("formula").isNotNull(), "f")
            .when(dated | (t == "d"), "d")
            .when(text, "s")
            .otherwise(t),
            "v_num": F.when((t == "n") & ~dated & ~spanned, number),
            "v_str": F.when(text, F.col("__v")),
            "v_bool": F.when(t == "b", number.try_cast("int") != 0),
            "v_ts": F.coalesce(F.col("__serial.ts"), F.when(day != "", stamp)),
            "time_ms": F.coalesce(F.col("__serial.time_ms"), F.when((day == "") & (clock != ""), S.clock_ms(clock))),
            "span_ms": F.when(spanned, S.duration_from_serial(number)),
            "err": F.when(t == "e", F.col("__v")).otherwise(F.col("__serial.err")),
        }
    ).drop("__v", "__number", "__iso", "__serial", "__day", "__clock")


def classify_cells(cells: DataFrame, code: Column) -> DataFrame:
    """Format class per cell, worked out once per style of a book; one style may hold most cells.

    Cells without a ``book`` are of one book.
    """
    keys = [k for k in ("book", "style_id") if k in cells.columns]
    styles = cells.select(*keys).distinct().withColumn("class", S.classify_format(code))
    return salted_join(cells, styles, keys, "left", hot=hot_keys(cells, keys))


def bind_values(df: DataFrame, column: str) -> DataFrame:
    """Type of text on its way into a sheet: formula, error or text.

    Text is cut at 32,767 characters, which ``cut`` tells; text with control
    characters is rejected (value NULL, flag set) instead of failing the job.
    """
    long = F.coalesce(F.length(F.col(column)) > MAX_TEXT, F.lit(False))
    cut = F.substring(F.col(column), 1, MAX_TEXT)
    bad = F.coalesce(cut.rlike(ILLEGAL), F.lit(False))
    kind = (
        F.when(F.startswith(cut, F.lit("=")) & (F.length(cut) > 1), "f")
        .when(S.error_code(cut).isNotNull(), "e")
        .otherwise("s")
    )
    return df.withColumns({"dtype": kind, column: F.when(~bad, cut), "rejected": bad, "cut": long})


def merge_runs(runs: DataFrame, keys: list[str], position: str, block: Column, pieces: int = 100_000) -> DataFrame:
    """Adjacent text runs of one font joined into one; empty runs are dropped first.

    runs(<keys>, <position>, font, text). A run of more than ``pieces`` pieces
    goes on in a further ``part``, so no group grows without bound.
    """
    kept = runs.filter(F.coalesce(F.col("text"), F.lit("")) != "")
    seen = running(kept, keys, [position], {"__before": ("lag", F.struct("font"))}, block)
    changed = (~F.col("__before.font").eqNullSafe(F.col("font")) | F.col("__before").isNull()).cast("int")
    numbered = running(seen, keys, [position], {"run": ("sum", changed), "__n": ("row_number", None)}, block)
    first = F.when(changed == 1, F.col("__n"))
    placed = running(numbered, keys, [position], {"__first": ("last", first)}, block)
    part = F.floor((F.col("__n") - F.col("__first")) / pieces).cast("int")
    item = F.struct(F.col(position).alias("at"), F.col("text").alias("text"))
    return placed.groupBy(*keys, "run", part.alias("part"), "font").agg(
        F.count(F.lit(1)).alias("pieces"),
        F.array_join(F.transform(F.array_sort(F.collect_list(item)), lambda p: p["text"]), "").alias("text"),
    )


def profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """Shared-item flags of every column in one aggregate pass, one row per column."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    made = []
    for n in columns:
        c, k = F.col(n), kinds[n]
        num = isinstance(k, T.NumericType)
        text = isinstance(k, T.StringType)
        date = isinstance(k, (T.TimestampNTZType, T.TimestampType, T.DateType))
        some = F.count(c) > 0
        no, null = F.lit(False), lambda t: F.lit(None).cast(t)
        real = c.cast("double") if num else null("double")
        day = F.date_format(c, "yyyy-MM-dd") if date else null("string")
        made.append(
            F.struct(
                F.lit(n).alias("field"),
                (F.count_if(c.isNull()) > 0).alias("blank"),
                (some if text else no).alias("string"),
                (some if num else no).alias("number"),
                ((F.count_if(real == F.floor(real)) == F.count(c)) & some if num else no).alias("integer"),
                (some if date else no).alias("date"),
                F.round(F.min(real), 2).alias("min_num"),
                F.round(F.max(real), 2).alias("max_num"),
                F.min(day).alias("min_date"),
                F.max(day).alias("max_date"),
                (F.count_if(F.length(c) > LONG_TEXT) > 0 if text else no).alias("long_text"),
                no.alias("mixed"),
            )
        )
    return df.agg(F.array(*made).alias("__all")).select(F.inline("__all"))


def profile_cells(cells: DataFrame) -> DataFrame:
    """The same flags per sheet column, where one column may mix types."""
    num, text, date = F.col("v_num"), F.col("v_str"), F.col("v_ts")
    has = lambda c: (F.count(c) > 0).cast("int")
    return cells.groupBy("book", "sheet", "col").agg(
        (F.count(text) > 0).alias("string"),
        (F.count(num) > 0).alias("number"),
        ((F.count_if(num == F.floor(num)) == F.count(num)) & (F.count(num) > 0)).alias("integer"),
        (F.count(date) > 0).alias("date"),
        F.min(num).alias("min_num"),
        F.max(num).alias("max_num"),
        F.min(date).alias("min_date"),
        F.max(date).alias("max_date"),
        (F.count_if(F.length(text) > LONG_TEXT) > 0).alias("long_text"),
        (has(text) + has(num) + has(date) > 1).alias("mixed"),
    )


def dedupe_names(df: DataFrame, keys: list[str], name: str, order: list[str], block: Column) -> DataFrame:
    """Unique titles: later duplicates of a name, whatever their case, are numbered on.

    A name is a stem and a number (``Sheet12``, none counts as 0). The first of equal names stays; the others
    get their stem with the numbers above the highest one that the stem has in use.
    """
    low = F.lower(F.col(name))
    digits = F.regexp_extract(low, "([0-9]{0,15})$", 1)
    parts = {"__low": low, "__stem": F.left(low, F.length(low) - F.length(digits)), "__no": F.coalesce(digits.try_cast("bigint"), F.lit(0))}
    seen = running(df.withColumns(parts), [*keys, "__low"], order, {"__n": ("row_number", None)}, block)
    again = running(seen, [*keys, "__stem"], order, {"__k": ("sum", (F.col("__n") > 1).cast("bigint"))}, block)
    stem = [*keys, "__stem"]
    highest = seen.groupBy(*stem).agg(F.max("__no").alias("__high"))
    placed = salted_join(again, highest, stem, "inner", hot=hot_keys(seen, stem))
    numbered = F.concat(F.left(F.col(name), F.length("__stem")), (F.col("__high") + F.col("__k")).cast("string"))
    return placed.withColumn("title", F.when(F.col("__n") > 1, numbered).otherwise(F.col(name))).drop(*parts, "__n", "__k", "__high")
