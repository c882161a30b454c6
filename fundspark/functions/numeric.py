"""Numeric expressions: guarded parsing, division and rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fundspark.functions.text import strip

# Plain decimal numbers only: Spark's cast would also take '5d', 'NaN' or 'Infinity'.
NUMBER_PATTERN = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_double(c) -> Column:
    """Text to double; anything that is not a plain number gives NULL."""
    s = strip(c)
    return F.when(s.rlike(NUMBER_PATTERN), s.try_cast("double"))


def safe_div(a, b) -> Column:
    """a / b, NULL when b is zero or NULL (ANSI '/' would fail)."""
    return F.try_divide(_col(a), _col(b))


def nan_to_null(c) -> Column:
    c = _col(c)
    return F.when(F.isnan(c), F.lit(None).cast("double")).otherwise(c)


def half_even_int(c) -> Column:
    """Round to the nearest integer, ties to even, as an int (Spark's cast truncates)."""
    return F.rint(_col(c)).cast("int")


def bround(c, digits: int = 2) -> Column:
    """Round half to even at ``digits`` places."""
    return F.bround(_col(c), digits)
