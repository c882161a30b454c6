"""Text expressions (all JVM-side, no Python UDFs)."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Fixed value: the whitespace characters removed at both ends (those of regex \s).
WHITESPACE = " \t\n\r\x0b\x0c"


def strip(c) -> Column:
    """Remove leading and trailing whitespace (blanks, tabs, newlines), like Python's strip."""
    return F.btrim(_col(c), F.lit(WHITESPACE))


def blank_to_null(c) -> Column:
    """Stripped text, with the empty string turned into NULL."""
    return F.nullif(strip(c), F.lit(""))


def null_tokens(c, tokens: Iterable[str]) -> Column:
    """NULL when the value equals one of ``tokens`` (exact match), else the value."""
    tokens = list(tokens)
    c = _col(c)
    return F.when(c.isin(tokens), F.lit(None).cast("string")).otherwise(c)


def contains_any(c, literals: Iterable[str]) -> Column:
    """True when ``c`` contains any of the literal substrings; NULL input gives False."""
    c = F.coalesce(_col(c), F.lit(""))
    cond = F.lit(False)
    for lit in literals:
        cond = cond | F.contains(c, F.lit(lit))
    return cond


def regex_search(c, pattern: str, case_insensitive: bool = True) -> Column:
    """Regex search anywhere in the value; NULL gives False."""
    flags = "(?i)" if case_insensitive else ""
    return F.coalesce(_col(c).rlike(flags + pattern), F.lit(False))


def ellipsis(c, width: int = 50) -> Column:
    """First ``width`` characters, with '...' appended when the text was longer."""
    c = _col(c)
    return F.when(F.length(c) > width, F.concat(F.substring(c, 1, width), F.lit("..."))).otherwise(c)


def clean_header(name: str) -> str:
    """Normalise one header: trim, lower case, blanks and dots to '_', parentheses dropped."""
    out = name.strip().lower().replace(" ", "_").replace(".", "_")
    return re.sub(r"[()]", "", out)
