"""Typing, inference and scalar conversion as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridspark.functions.lets import let

# Error literals of the cell grid.
ERROR_CODES = ["#NULL!", "#DIV/0!", "#VALUE!", "#REF!", "#NAME?", "#NUM!", "#N/A"]

# Built-in number formats by id.
BUILTIN_FORMATS = {
    0: "General",
    1: "0",
    2: "0.00",
    3: "#,##0",
    4: "#,##0.00",
    5: '"$"#,##0_);("$"#,##0)',
    6: '"$"#,##0_);[Red]("$"#,##0)',
    7: '"$"#,##0.00_);("$"#,##0.00)',
    8: '"$"#,##0.00_);[Red]("$"#,##0.00)',
    9: "0%",
    10: "0.00%",
    11: "0.00E+00",
    12: "# ?/?",
    13: "# ??/??",
    14: "mm-dd-yy",
    15: "d-mmm-yy",
    16: "d-mmm",
    17: "mmm-yy",
    18: "h:mm AM/PM",
    19: "h:mm:ss AM/PM",
    20: "h:mm",
    21: "h:mm:ss",
    22: "m/d/yy h:mm",
    37: "#,##0_);(#,##0)",
    38: "#,##0_);[Red](#,##0)",
    39: "#,##0.00_);(#,##0.00)",
    40: "#,##0.00_);[Red](#,##0.00)",
    41: r'_(* #,##0_);_(* \(#,##0\);_(* "-"_);_(@_)',
    42: r'_("$"* #,##0_);_("$"* \(#,##0\);_("$"* "-"_);_(@_)',
    43: r'_(* #,##0.00_);_(* \(#,##0.00\);_(* "-"??_);_(@_)',
    44: r'_("$"* #,##0.00_)_("$"* \(#,##0.00\)_("$"* "-"??_)_(@_)',
    45: "mm:ss",
    46: "[h]:mm:ss",
    47: "mmss.0",
    48: "##0.0E+0",
    49: "@",
}

# Epochs, and the days from the 1900 epoch to the last and first representable day.
EPOCHS = {1900: "1899-12-30", 1904: "1904-01-01"}
DAY_MS = 86_400_000
_LAST_DAY, _FIRST_DAY = 2958465, -693593
_LATER = 1462  # days between the epochs

# Display units of a value axis.
DISPLAY_UNITS = {
    "hundreds": 1e2,
    "thousands": 1e3,
    "tenThousands": 1e4,
    "hundredThousands": 1e5,
    "millions": 1e6,
    "tenMillions": 1e7,
    "hundredMillions": 1e8,
    "billions": 1e9,
    "trillions": 1e12,
}


# --- numbers -----------------------------------------------------------------


def is_float_text(c: Column) -> Column:
    return c.rlike("[.eE]")


def cast_number(c: Column) -> Column:
    """Stored number text -> struct(i BIGINT, d DOUBLE); one of them set."""
    real = is_float_text(c)
    return F.struct(
        F.when(~real, c.try_cast("bigint")).alias("i"), F.when(real, c.try_cast("double")).alias("d")
    )


def _digits(c: Column) -> Column:
    """Whether a text holds nothing but the digits 0 to 9 (an empty one does)."""
    return F.translate(c, "0123456789", "") == ""


def _plain_number(c: Column) -> Column:
    """Digits with at most one point among them."""
    return _digits(F.concat(F.substring_index(c, ".", 1), F.substring(c, F.instr(c, ".") + 1, F.length(c))))


def infer_numeric(c: Column) -> Column:
    """Typed-in number text -> struct(i BIGINT, d DOUBLE); both NULL when not numeric.

    A sign, then digits that may hold one point, then perhaps ``e`` with a signed whole number. Without a
    point a number does not start with 0, unless it is a single digit.
    """
    size = F.regexp_replace(F.lower(c), "^-", "")
    at = F.instr(size, "e")
    mantissa = F.when(at > 0, F.substring(size, F.lit(1), at - 1)).otherwise(size)
    power = F.substring(size, at + 1, F.length(size))
    power = F.when(F.left(power, F.lit(1)).isin("+", "-"), F.substring(power, F.lit(2), F.length(power))).otherwise(power)
    pointed = mantissa.contains(".")
    stands = F.when(pointed, _plain_number(mantissa) & (F.length(mantissa) > 1)).otherwise(
        _digits(mantissa) & (mantissa != "") & ((F.length(mantissa) == 1) | ~mantissa.startswith("0"))
    )
    ok = stands & ((at == 0) | (_digits(power) & (power != "")))
    whole = ~pointed & (at == 0)
    return F.struct(
        F.when(ok & whole, c.try_cast("bigint")).alias("i"),
        F.when(ok & ~whole, c.try_cast("double")).alias("d"),
    )


def infer_percent(c: Column) -> Column:
    """``12.5%`` -> 0.125. One blank may stand before the sign."""
    body = F.substring(c, F.lit(1), F.length(c) - 1)
    body = F.when(F.right(body, F.lit(1)).isin(" ", "\t", "\n", "\r", "\f", "\x0b"), F.substring(body, F.lit(1), F.length(body) - 1)).otherwise(body)
    size = F.when(body.startswith("-"), F.substring(body, F.lit(2), F.length(body))).otherwise(body)
    return F.when(c.endswith("%") & _plain_number(size), body.try_cast("double") / 100)


def infer_time(c: Column) -> Column:
    """``H:M``, ``H:M:S`` or ``M:S.f`` -> microseconds of the day."""
    parts = F.split(c, ":")
    hour, minute, second = (F.get(parts, F.lit(i)) for i in range(3))

    def sixty(p: Column) -> Column:
        return _digits(p) & (F.length(p) == 2) & (p.try_cast("int") < 60)

    # an hour may be written with a third digit in front, 0 or 1
    hours = _digits(hour) & ((F.length(hour) == 2) | ((F.length(hour) == 3) & (F.left(hour, F.lit(1)) <= "1"))) & (hour.try_cast("int") < 24)
    clocked = hours & sixty(minute) & ((F.size(parts) == 2) | ((F.size(parts) == 3) & sixty(second)))
    clock = (hour.try_cast("bigint") * 3600 + minute.try_cast("bigint") * 60 + F.coalesce(second.try_cast("bigint"), F.lit(0))) * 1_000_000

    lead, rest = F.substring(c, 1, 2), F.substring(c, 4, 2)
    after = F.substring(c, 7, 6)
    fraction = F.left(after, F.length(after) - F.length(F.ltrim(after, F.lit("0123456789"))))
    minuted = sixty(lead) & sixty(rest) & (F.substring(c, 3, 1) == ":") & (F.substring(c, 6, 1) == ".") & (fraction != "")
    minutes = (lead.try_cast("bigint") * 60 + rest.try_cast("bigint")) * 1_000_000 + F.rpad(fraction, 6, "0").try_cast("bigint")
    return F.when(clocked, clock).when(minuted, minutes)


# Fixed value: splits a double into two halves whose products are exact.
_SPLIT = 134217729.0


def _digit_steps() -> list:
    """Steps to the 16 significant digits of ``x``; each names values worked out from those before it.

    size * 10^(15 - e) is rounded half-even from the exact value of the double: the product is taken with its
    rounding error (both factors split into exact halves), so the digit that decides is the true one. Values
    outside 1e-6 to 1e16 give NULLs. 10^0 to 10^21 are exact.
    """
    exact = F.array(*[F.lit(10.0**i) for i in range(22)])
    tens = F.array(*[F.lit(float(f"1e{i}")) for i in range(-7, 18)])

    def exponent(v) -> dict:
        # the logarithm may be off by one
        below, above = (F.try_element_at(tens, v("guess") + i) for i in (8, 9))
        return {"e": v("guess") + F.when(v("size") < below, -1).when(v("size") >= above, 1).otherwise(0)}

    def halves(v) -> dict:
        split = lambda c: c * _SPLIT - (c * _SPLIT - c)
        return {"p": v("size") * v("t"), "xh": split(v("size")), "th": split(v("t"))}

    def product(v) -> dict:
        xh, th, p = v("xh"), v("th"), v("p")
        xl, tl = v("size") - xh, v("t") - th
        error = ((xh * th - p) + xh * tl + xl * th) + xl * tl
        return {"base": F.floor(p), "up": ((p - F.floor(p).cast("double")) + error + 0.5)}

    def digits(v) -> dict:
        n = v("base") + F.floor(v("up"))
        tie = (F.floor(v("up")).cast("double") == v("up")) & (n % 2 == 1)
        return {"n": F.when(tie, n - 1).otherwise(n).cast("string")}

    return [
        lambda v: {"size": F.abs(v("x"))},
        lambda v: {"guess": F.when((v("size") >= 1e-6) & (v("size") < 1e16), F.floor(F.log10(v("size"))).cast("int"))},
        exponent,
        lambda v: {"t": F.try_element_at(exact, F.lit(16) - v("e"))},
        halves, product, digits,
    ]


def _sixteen(v) -> Column:
    """Text of ``x`` from the values of ``_digit_steps``."""
    x, size, e, n = v("x"), v("size"), v("e"), v("n")
    sign = F.when(x < 0, F.lit("-")).otherwise(F.lit(""))
    tidy = r"\.?0+$"
    # 16 or 17 digits with the point d places from the right
    d = F.lit(15) - e
    padded = F.lpad(n, F.greatest(F.length(n), d + 1), F.lit("0"))
    cut = F.length(padded) - d
    point = F.concat(F.substring(padded, F.lit(1), cut), F.lit("."), F.substring(padded, cut + 1, d))
    tail = F.concat(F.substring(n, 1, 1), F.lit("."), F.substring(n, 2, 15))
    small = F.concat(F.regexp_replace(tail, tidy, ""), F.lit("e-0"), F.abs(e).cast("string"))
    near = F.when(e >= -4, F.rtrim(F.rtrim(point, F.lit("0")), F.lit("."))).otherwise(small)
    far = F.concat(
        F.regexp_replace(F.regexp_extract(F.format_string("%.15e", size), r"^(\d\.\d+)e", 1), tidy, ""),
        F.regexp_extract(F.format_string("%.15e", x), r"(e[+-]\d+)$", 1),
    )
    return (
        F.when(x.isNull(), "none")
        .when(F.isnan(x) | (size == F.lit(float("inf"))), "")
        .when((x == F.floor(x)) & (size < 1e16), x.cast("decimal(20,0)").cast("string"))
        .when(e.isNotNull(), F.concat(sign, near))
        .otherwise(F.concat(sign, far))
    )


def safe_string(c: Column) -> Column:
    """Number as text with 16 significant digits; NaN and infinities empty; NULL ``none``.

    Digits come from the exact binary value, as C's ``%.16g`` takes them, not
    from the shortest text that reads back; beyond 1e16 and below 1e-6 from the latter.
    For whole tables ``safe_strings`` is faster.
    """

    def go(values: dict[str, Column], steps: list) -> Column:
        if not steps:
            return _sixteen(values.__getitem__)
        made = F.struct(*[x.alias(k) for k, x in {**values, **steps[0](values.__getitem__)}.items()])
        names = [*values, *steps[0](values.__getitem__)]
        return let(made, lambda s: go({k: s[k] for k in names}, steps[1:]))

    return let(F.struct(c.cast("double").alias("x")), lambda s: go({"x": s["x"]}, _digit_steps()))


def safe_strings(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """``df`` with ``safe_string`` of several columns, every step a projection of its own: generated code throughout."""
    from gridspark.scale import widened

    out = widened(df).withColumns({f"__{n}_x": c.cast("double") for n, c in columns.items()})
    made = {f"__{n}_x" for n in columns}
    for step in _digit_steps():
        new = {f"__{n}_{k}": x for n in columns for k, x in step(lambda k, n=n: F.col(f"__{n}_{k}")).items()}
        out, made = out.withColumns(new), made | set(new)
    return out.withColumns({n: _sixteen(lambda k, n=n: F.col(f"__{n}_{k}")) for n in columns}).drop(*made)


def short_text(c: Column) -> Column:
    """Number as the shortest text that reads back; whole numbers without a point."""
    return F.when((c == F.floor(c)) & (F.abs(c) < 1e15), c.cast("bigint").cast("string")).otherwise(
        c.cast("string")
    )


def clock_text(ms: Column) -> Column:
    """Milliseconds as ``HH:MM:SS``, with three decimals if there are any; hours may pass 24."""
    size = F.abs(ms)
    sign = F.when(ms < 0, "-").otherwise("")
    two = lambda v: F.lpad(v.cast("string"), 2, "0")
    hours = F.floor(size / 3_600_000)
    hour = F.when(hours < 10, two(hours)).otherwise(hours.cast("string"))
    part = F.when(size % 1000 != 0, F.concat(F.lit("."), F.lpad((size % 1000).cast("string"), 3, "0"))).otherwise("")
    return F.concat(sign, hour, F.lit(":"), two(F.floor(size / 60_000) % 60), F.lit(":"), two(F.floor(size / 1000) % 60), part)


def display_unit(c: Column, unit: str | float) -> Column:
    """Scale by a named or custom display unit."""
    return c / F.lit(DISPLAY_UNITS[unit] if isinstance(unit, str) else float(unit))


# --- serial dates ------------------------------------------------------------


def from_serial(c: Column, epoch: int | Column = 1900) -> Column:
    """Serial number -> struct(ts, time_ms, err).

    Values in [0, 1) are a time of day unless their fraction rounds up to a full
    day. In the 1900 epoch serials below 60 sit one day later, because that
    calendar counts a 29 February 1900. Serials off the calendar give ``#VALUE!``.
    """
    late = epoch == 1904 if isinstance(epoch, Column) else F.lit(epoch == 1904)
    day = F.floor(c)
    ms = F.bround((c - day) * DAY_MS).cast("bigint")
    clock = (c >= 0) & (c < 1) & (ms < DAY_MS)
    day = day + F.when(late, _LATER).when((c > 0) & (c < 60), 1).otherwise(0)  # both calendars counted from the earlier epoch
    total = day * DAY_MS + ms
    off = (total < _FIRST_DAY * DAY_MS) | (total >= (_LAST_DAY + 1) * DAY_MS)
    start = F.expr(f"timestamp_ntz'{EPOCHS[1900]} 00:00:00'")
    return F.struct(
        F.when(~clock & ~off, F.timestamp_add("MILLISECOND", total, start)).alias("ts"),
        F.when(clock, ms).alias("time_ms"),
        F.when(~clock & off, F.lit("#VALUE!")).alias("err"),
    )


def duration_from_serial(c: Column) -> Column:
    """Serial number -> milliseconds, fraction of a second rounded half-even."""
    us = F.bround(c * (DAY_MS * 1000)).cast("bigint")
    second = F.floor(us / 1_000_000)
    return (second * 1000 + F.bround((us - second * 1_000_000) / 1000)).cast("bigint")


def to_serial(c: Column, epoch: int = 1900) -> Column:
    """Timestamp (no zone) -> serial number."""
    days = F.datediff(c.cast("date"), F.lit(EPOCHS[epoch]).cast("date"))
    if epoch == 1900:
        days = F.when((days > 0) & (days <= 60), days - 1).otherwise(days)
    seconds = F.hour(c) * 3600 + F.minute(c) * 60 + F.extract(F.lit("SECOND"), c).cast("double")
    return days + seconds / 86400.0


def iso_parts(c: Column) -> tuple[Column, Column]:
    """Day and clock of ISO-8601 text, each empty where it is missing."""
    day = F.regexp_extract(c, r"^(\d{4}-\d{2}-\d{2})", 1)
    return day, F.regexp_extract(c, r"^(?:\d{4}-\d{2}-\d{2})?T?(\d{2}:\d{2}(?::\d{2}(?:\.\d{1,3})?)?)", 1)


def clock_ms(clock: Column) -> Column:
    """Milliseconds of a clock as ``iso_parts`` gives it; NULL from 24 hours on."""
    number = lambda at, n: F.coalesce(F.substring(clock, at, n).try_cast("bigint"), F.lit(0))
    part = F.coalesce(F.rpad(F.substring(clock, 10, 3), 3, "0").try_cast("bigint"), F.lit(0))
    return F.when(number(1, 2) < 24, ((number(1, 2) * 60 + number(4, 2)) * 60 + number(7, 2)) * 1000 + part)


def from_iso(c: Column) -> Column:
    """ISO-8601 text -> struct(date, time_us, ts, duration_us, err)."""
    day, clock = iso_parts(c)
    span = r"^PT(?:(\d+)H)?(?:(\d+)M)?(?:(\d+(?:\.\d{1,3})?)S)?"

    def amount(i: int) -> Column:
        return F.coalesce(F.regexp_extract(c, span, i).try_cast("double"), F.lit(0.0))

    has_day, has_clock = day != "", clock != ""
    is_span = ~has_day & ~has_clock & c.rlike(r"^PT\d+(\.\d+)?[HMS]")

    fraction = F.coalesce(F.rpad(F.get(F.split(clock, r"\."), F.lit(1)), 6, "0").try_cast("bigint"), F.lit(0))
    parts = F.split(F.element_at(F.split(clock, r"\."), 1), ":")

    def hms(i: int) -> Column:
        return F.coalesce(F.get(parts, F.lit(i)).try_cast("bigint"), F.lit(0))

    us = (hms(0) * 3600 + hms(1) * 60 + hms(2)) * 1_000_000 + fraction
    stamp = F.concat(day, F.lit(" "), clock).try_cast("timestamp_ntz")
    return F.struct(
        F.when(has_day & ~has_clock, day.try_cast("date")).alias("date"),
        F.when(~has_day & has_clock & (hms(0) < 24), us).alias("time_us"),
        F.when(has_day & has_clock, stamp).alias("ts"),
        F.when(
            is_span, F.bround((amount(1) * 3600 + amount(2) * 60 + amount(3)) * 1_000_000).cast("bigint")
        ).alias("duration_us"),
        F.when(
            c.isNotNull() & (c != "") & ~has_day & ~has_clock & ~is_span, F.lit("invalid datetime")
        ).alias("err"),
    )


def to_iso(c: Column) -> Column:
    """Timestamp -> ISO text; milliseconds only when there is a fraction."""
    whole = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
    fraction = F.extract(F.lit("SECOND"), c) % 1
    return F.when(fraction != 0, F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSS")).otherwise(whole)


# --- number formats ----------------------------------------------------------

# Format parts that show elapsed time, and the letters of dates and times.
ELAPSED = ["[h]", "[hh]", "[m]", "[mm]", "[s]", "[ss]"]
DATE_LETTERS = "dmhys"


def _visible(section: Column) -> Column:
    """A format section without quoted text, bracketed parts, and characters after ``_`` or a backslash."""
    quoted = F.split(section, '"')
    # every second piece stands in quotes, but for a last one whose quote never closes
    last = lambda p, i: F.when(i == F.size(quoted) - 1, F.concat(F.lit('"'), p)).otherwise(F.lit(""))
    shown = F.array_join(F.transform(quoted, lambda p, i: F.when(i % 2 == 0, p).otherwise(last(p, i))), "")
    closed = lambda p: F.when(p.contains("]"), F.substring(p, F.instr(p, "]") + 1, F.length(p))).otherwise(F.concat(F.lit("["), p))
    open_ = F.array_join(F.transform(F.split(shown, r"\["), lambda p, i: F.when(i == 0, p).otherwise(closed(p))), "")
    escaped = F.split(F.translate(open_, "\\", "_"), "_")
    return F.array_join(F.transform(escaped, lambda p, i: F.when(i == 0, p).otherwise(F.substring(p, F.lit(2), F.length(p)))), "")


def classify_format(c: Column) -> Column:
    """Format code -> date, time, datetime, timedelta or number."""
    first = F.lower(F.substring_index(c, ";", 1))
    elapsed = F.lit(False)
    for mark in ELAPSED:
        elapsed = elapsed | first.contains(mark)
    visible = _visible(first)
    dated = F.length(F.translate(visible, DATE_LETTERS, "")) < F.length(visible)
    has_date, has_time = c.contains("d") | c.contains("y"), c.contains("h") | c.contains("s")
    return (
        F.when(c.isNull(), "number")
        .when(elapsed, "timedelta")
        .when(~dated, "number")
        .when(has_date & has_time, "datetime")
        .when(has_date, "date")
        .otherwise("time")
    )


def format_code(c: Column) -> Column:
    """Built-in format id -> code."""
    pairs = [F.lit(x) for kv in BUILTIN_FORMATS.items() for x in kv]
    return F.try_element_at(F.create_map(*pairs), c.cast("int"))


def format_id(c: Column) -> Column:
    """Format code -> built-in id."""
    pairs = [F.lit(x) for k, v in BUILTIN_FORMATS.items() for x in (v, k)]
    return F.try_element_at(F.create_map(*pairs), c)


# --- text --------------------------------------------------------------------


def error_code(c: Column) -> Column:
    """The error literal, or NULL."""
    return F.when(c.isin(ERROR_CODES), c)


def escape_ctl(c: Column) -> Column:
    """Characters 1 to 25 as ``_xHHHH_``."""
    out = c
    for code in range(1, 26):
        out = F.replace(out, F.lit(chr(code)), F.lit(f"_x{code:04x}_"))
    return F.when(c.rlike("[\\x01-\\x19]"), out).otherwise(c)


def unescape_ctl(c: Column) -> Column:
    """``_xHHHH_`` back to characters, in one pass; half a surrogate pair stays escaped."""
    pattern = "_x((?![dD][89abAB])(?![dD][c-fC-F])[0-9A-Fa-f]{4})_"
    pieces = F.split(c, pattern, -1)
    codes = F.regexp_extract_all(c, F.lit(pattern), F.lit(1))
    chars = F.transform(codes, lambda h: F.decode(F.unhex(h), "UTF-16BE"))
    joined = F.zip_with(
        pieces, chars, lambda p, ch: F.concat(F.coalesce(p, F.lit("")), F.coalesce(ch, F.lit("")))
    )
    return F.when(c.contains("_x"), F.array_join(joined, "")).otherwise(c)


def flatten_runs(c: Column) -> Column:
    """Array of (font, text) runs -> plain text."""
    return F.array_join(F.transform(c, lambda r: F.coalesce(r["text"], F.lit(""))), "")


def normalise(c: Column) -> Column:
    """Strip, en-dash to hyphen, spaced hyphen to bare hyphen."""
    dashed = F.replace(F.trim(c), F.lit("–"), F.lit("-"))
    return F.replace(dashed, F.lit(" - "), F.lit("-"))


def sanitise_id(c: Column) -> Column:
    """Column id: spaces to underscores, parentheses dropped."""
    return F.translate(c, " ()", "_")
