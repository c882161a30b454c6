"""Date parsing and calendar expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fundspark.functions.text import strip

# Fixed formats of the source files.
NAV_DATE_FORMAT = "d-MMM-yyyy"          # 01-Apr-2006
DAY_FIRST_FORMATS = ("d-MMM-yyyy", "d/M/yyyy", "d-M-yyyy", "yyyy-MM-dd")
COMPACT_FORMAT = "yyyyMMdd"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Shape of the text each format can parse (a superset: digits and letters of any length
# with the format's separators). In a multi-format parse most values fail most formats,
# and the parser's failure path is an exception per value; text of another shape is not
# handed to it.
FORMAT_SHAPES = {
    "d-MMM-yyyy": r"^\d+-[A-Za-z]+-\d+$",
    "d/M/yyyy": r"^\d+/\d+/\d+$",
    "d-M-yyyy": r"^\d+-\d+-\d+$",
    "yyyy-MM-dd": r"^\d+-\d+-\d+$",
    "yyyyMMdd": r"^\d+$",
}


def parse_date(c, fmt: str = NAV_DATE_FORMAT, check_shape: bool = False) -> Column:
    """Strict parse of one format; text that does not match (or an impossible day) gives NULL."""
    s = strip(c)
    parsed = F.to_date(F.try_to_timestamp(s, F.lit(fmt)))
    shape = FORMAT_SHAPES.get(fmt) if check_shape else None
    return F.when(s.rlike(shape), parsed) if shape else parsed


def parse_day_first(c, formats=DAY_FIRST_FORMATS) -> Column:
    """Day-first date text in any of ``formats``; the first format that parses wins."""
    return F.coalesce(*[parse_date(c, f, check_shape=True) for f in formats])


def is_weekend(c) -> Column:
    """Saturday or Sunday (weekday(): Monday = 0)."""
    return F.weekday(_col(c)) >= 5


def year_end(c) -> Column:
    """December 31 of the value's year."""
    c = _col(c)
    return F.make_date(F.year(c), F.lit(12), F.lit(31))


def month_start(c) -> Column:
    return F.trunc(_col(c), "MM")
