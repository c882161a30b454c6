"""Per-key time-series operators: fill, returns, drawdown, rolling return.

All take the key, order and value column names, so they work on any keyed
series. Every window is ``partitionBy(key).orderBy(order)``: one shuffle on
the key, and each window partition is one instrument's history. With one
row per (key, date) a partition is bounded by the number of dates (about
5,000 for 20 years), however many rows the table has, so no hot key can
grow a window task. ``one_per_date`` makes that so (repeats are combined
by a stated rule before any window); ``assert_unique`` checks it.
Operators that share a key reuse one exchange and one sort.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fundspark.functions.dates import year_end

TRADING_DAYS = 252  # fixed: rows per year for rolling and annualised figures


def series_window(key: str | Sequence[str], order: str):
    keys = [key] if isinstance(key, str) else list(key)
    return Window.partitionBy(*keys).orderBy(F.col(order).asc_nulls_last())


def _running(key, order):
    return series_window(key, order).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def missing_as_null(value: str) -> Column:
    """The value with NaN read as missing, as pandas does (Spark orders NaN above every number)."""
    v = F.col(value)
    return F.when(F.isnan(v), F.lit(None).cast("double")).otherwise(v)


def filled(value: str, key, order) -> Column:
    """Last non-missing value up to the current row (forward fill)."""
    return F.last(missing_as_null(value), ignorenulls=True).over(_running(key, order))


def forward_fill(
    df: DataFrame,
    key: str = "scheme_code",
    order: str = "date",
    value: str = "nav",
    out: str = "nav_filled",
    distinct: bool = False,
) -> DataFrame:
    """Add ``out`` = last non-null ``value`` per key up to the current row."""
    res = df.withColumn(out, filled(value, key, order))
    return res.distinct() if distinct else res


def pct_change(value: str, key, order, periods: int = 1, fill: bool = True) -> Column:
    """value / value ``periods`` rows earlier - 1 per key.

    With ``fill`` (the default of the reference's library) NULLs are padded
    forward first, so [1, NULL, 2] gives [NULL, 0, 1]. A zero base gives NULL.
    The padded value ``periods`` rows back is the last non-missing value up
    to that row -- a frame of the same window -- so current and previous
    value come from one window operator (no window over a window).
    """
    w = series_window(key, order)
    if fill:
        cur = filled(value, key, order)
        prev = F.last(missing_as_null(value), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -periods))
    else:
        cur = missing_as_null(value)
        prev = F.lag(cur, periods).over(w)
    return F.try_divide(cur, prev) - F.lit(1.0)


def period_returns(
    df: DataFrame,
    key: str = "scheme_code",
    order: str = "date",
    value: str = "nav",
    fill: bool = True,
) -> DataFrame:
    """Add ``perc_return`` (simple) and ``log_return`` = log1p(perc_return) per key."""
    ret = pct_change(value, key, order, 1, fill)
    return df.withColumns({"perc_return": ret, "log_return": F.log1p(ret)})


def annual_log_returns(
    returns: DataFrame,
    group_cols: Sequence[str] = ("scheme_code",),
    order: str = "date",
    log_return: str = "log_return",
) -> DataFrame:
    """Sum of log returns per group and calendar year end (Dec 31); all-NULL sums to 0.

    NULL group keys are kept as their own group.
    """
    return returns.groupBy(*group_cols, year_end(order).alias(order)).agg(
        F.coalesce(F.sum(log_return), F.lit(0.0)).alias(log_return)
    )


def drawdown_series(
    df: DataFrame, key: str = "scheme_code", order: str = "date", value: str = "nav"
) -> DataFrame:
    """Add running maximum ``cumulative_max`` and ``drawdown`` = value / running max - 1."""
    v = missing_as_null(value)
    cummax = F.max(v).over(_running(key, order))
    return df.withColumns({"cumulative_max": cummax, "drawdown": F.try_divide(v, cummax) - F.lit(1.0)})


def rolling_return(
    df: DataFrame,
    key: str = "scheme_code",
    order: str = "date",
    value: str = "nav",
    periods: int = TRADING_DAYS,
    out: str | None = None,
    fill: bool = True,
) -> DataFrame:
    """Add the return over ``periods`` rows (a row offset, not calendar days)."""
    name = out or f"rolling_return_{periods}"
    return df.withColumn(name, pct_change(value, key, order, periods, fill))


def one_per_date(
    df: DataFrame,
    key: str | Sequence[str] = "scheme_code",
    order: str = "date",
    value: str = "nav",
    by: Sequence[str] = (),
    keep: str = "last",
) -> DataFrame:
    """One row per (key, date): ``key``, ``order`` and the value that its repeats agree on by a stated rule.

    ``last`` / ``first`` take the value of the row with the largest /
    smallest ``by`` columns (compared in turn, NULL lowest; then the larger
    / smaller value); ``min``, ``max`` and ``mean`` combine the values. A
    missing value (NULL or NaN) gives way to any other; a date with none
    keeps NULL. Fills, returns and KPIs over the result are unambiguous and
    their windows hold at most one row per date of the calendar, however
    often a row is repeated: repeats are combined before the shuffle on
    (key, date), so a key with a third of all rows sends one row per date
    and task.
    """
    keys = [key] if isinstance(key, str) else list(key)
    v = missing_as_null(value)
    ordered = F.when(v.isNotNull(), F.struct(*[F.col(c) for c in by], v.alias("_v")))
    rules = {
        "last": lambda: F.max_by(v, ordered),
        "first": lambda: F.min_by(v, ordered),
        "min": lambda: F.min(v),
        "max": lambda: F.max(v),
        "mean": lambda: F.avg(v),
    }
    if keep not in rules:
        raise ValueError(f"keep must be one of {sorted(rules)}, not {keep!r}")
    return df.groupBy(*keys, order).agg(rules[keep]().alias(value))


def assert_unique(df: DataFrame, keys: Sequence[str]) -> None:
    """Raise when a (key, date) pair repeats: fills and lags would be ambiguous.

    An action: one partially aggregated shuffle, only the first offender is fetched.
    """
    dup = df.groupBy(*keys).count().filter("count > 1").select(*keys).take(1)
    if dup:
        raise ValueError(f"rows are not unique on {list(keys)}: {dup[0]}")
