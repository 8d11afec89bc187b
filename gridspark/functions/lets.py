"""Name a value once inside an expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value worked out once per row.

    Long chains that use a value many times otherwise grow past what one
    generated method may hold.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))
