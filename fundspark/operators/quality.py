"""Data-quality operators: completeness report, duplicates, value-range rules, summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fundspark.functions.numeric import half_even_int

# Fixed values of the completeness report.
COMPLETE, INCOMPLETE, HOLIDAY = "COMPLETE", "INCOMPLETE", "HOLIDAY"
DEFAULT_THRESHOLD = 0.95
DEFAULT_WINDOW = 5
HOLIDAY_BELOW = 0.5
TAIL_ROWS = 20

# Fixed value-range rules (documented thresholds).
MIN_NAV, MAX_NAV = 0.01, 10000.0
MIN_CODE, MAX_CODE = 100000, 999999
MIN_LAUNCH_YEAR, MAX_LAUNCH_YEAR = 1990, 2030
MAX_NULL_SHARE = 0.10
MAX_DUPLICATE_SHARE = 0.05


def _date_range(df: DataFrame, date: str, start=None, end=None) -> DataFrame:
    """Inclusive date bounds; bounds are values, never pasted into SQL text."""
    if start is not None:
        df = df.filter(F.col(date) >= F.lit(start).cast("date"))
    if end is not None:
        df = df.filter(F.col(date) <= F.lit(end).cast("date"))
    return df


def validation_report(
    df: DataFrame,
    key: str = "scheme_code",
    date: str = "date",
    threshold: float = DEFAULT_THRESHOLD,
    window: int = DEFAULT_WINDOW,
    start=None,
    end=None,
    holiday_below: float = HOLIDAY_BELOW,
) -> DataFrame:
    """One status row per date: distinct keys against a rolling baseline.

    The baseline is the mean of the previous ``window`` dates (current date
    excluded), rounded half to even; the first date has none and takes the
    median daily count, truncated. COMPLETE at ``ratio >= threshold``,
    HOLIDAY below ``holiday_below``, else INCOMPLETE.

    Plan: the distinct count shuffles on (date, key) then date, with partial
    aggregation, so a hot date is spread over many tasks. The two windows
    then run over one row per date (a calendar: thousands of rows), the
    only place a single partition is used.
    """
    counts = (
        _date_range(df.select(key, date), date, start, end)
        .groupBy(date)
        .agg(F.countDistinct(key).alias("scheme_count"))
    )
    ordered = Window.orderBy(F.col(date).asc_nulls_last())
    rolling = F.avg("scheme_count").over(ordered.rowsBetween(-window, -1))
    median = F.floor(F.median("scheme_count").over(Window.partitionBy())).cast("int")
    expected = F.coalesce(half_even_int(rolling), median)
    count = F.col("scheme_count")
    ratio = F.try_divide(count.cast("double"), expected)
    status = (
        # division by zero: a positive count over a zero baseline is infinitely complete
        F.when(ratio.isNull() & (count > 0) & (expected == 0), F.lit(COMPLETE))
        .when(ratio.isNull() | F.isnan(ratio), F.lit(INCOMPLETE))
        .when(ratio >= threshold, F.lit(COMPLETE))
        .when(ratio < holiday_below, F.lit(HOLIDAY))
        .otherwise(F.lit(INCOMPLETE))
    )
    return counts.select(
        F.col(date),
        count,
        expected.alias("rolling_avg"),
        expected.alias("expected_count"),
        ratio.alias("completeness_ratio"),
        status.alias("status"),
    )


def validation_stats(report: DataFrame, threshold: float = DEFAULT_THRESHOLD, window: int = DEFAULT_WINDOW) -> DataFrame:
    """Totals per status and the pass flag (no INCOMPLETE date), one row."""
    st = F.col("status")
    return report.agg(
        F.count(F.lit(1)).alias("total_dates"),
        F.count_if(st == COMPLETE).alias("complete_dates"),
        F.count_if(st == INCOMPLETE).alias("incomplete_dates"),
        F.count_if(st == HOLIDAY).alias("holiday_dates"),
    ).select(
        "*",
        F.lit(float(threshold)).alias("threshold"),
        F.lit(int(window)).alias("window"),
        (F.col("incomplete_dates") == 0).alias("passed"),
    )


def validation_view(report: DataFrame, date: str = "date", tail: int = TAIL_ROWS) -> DataFrame:
    """Rows worth showing: every non-COMPLETE date plus the last ``tail`` dates, with a marker."""
    from_end = F.row_number().over(Window.orderBy(F.col(date).desc_nulls_first()))
    marker = (
        F.when(F.col("status") == INCOMPLETE, F.lit(" <-- CHECK"))
        .when(F.col("status") == HOLIDAY, F.lit(" (holiday)"))
        .otherwise(F.lit(""))
    )
    return (
        report.withColumn("_from_end", from_end)
        .filter((F.col("_from_end") <= tail) | (F.col("status") != COMPLETE))
        .select(date, "scheme_count", "expected_count", "completeness_ratio", "status", marker.alias("marker"))
    )


def find_duplicates(df: DataFrame, keys: Sequence[str], distinct_first: Sequence[str] | None = None) -> DataFrame:
    """Key combinations that occur more than once, with their count.

    ``distinct_first`` removes exact duplicates over those columns before
    grouping (a key with two different values is still reported).
    Partial aggregation runs before the shuffle, so hot keys collapse map-side.
    """
    if distinct_first:
        df = df.select(*distinct_first).distinct()
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count")).filter(F.col("count") > 1)


def quality_rules(
    df: DataFrame,
    key: str = "scheme_code",
    value: str = "nav",
    launch: str | None = "launch_date",
    date: str | None = "date",
    min_value: float = MIN_NAV,
    max_value: float = MAX_NAV,
    min_code: int = MIN_CODE,
    max_code: int = MAX_CODE,
    min_year: int = MIN_LAUNCH_YEAR,
    max_year: int = MAX_LAUNCH_YEAR,
    max_null_share: float = MAX_NULL_SHARE,
    max_duplicate_share: float = MAX_DUPLICATE_SHARE,
) -> DataFrame:
    """Value-range and share rules as one aggregate row.

    Counts rows whose value, numeric key or launch year fall outside the
    bounds, the share of NULL values, and the share of rows repeating a
    (key, date) pair; each rule gets a pass flag. One scan plus one
    partially aggregated shuffle for the duplicate share.
    """
    v = F.col(value)
    code_num = F.col(key).cast("string").try_cast("bigint")
    launch_ok = launch is not None and launch in df.columns
    y = F.year(F.col(launch)) if launch_ok else None
    dup_keys = [key] + ([date] if date else [])
    # One shuffle: rule counters are summed per (key, date) map-side, then globally.
    per_key = df.groupBy(*dup_keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(v.isNotNull() & ((v < min_value) | (v > max_value))).alias("vo"),
        F.count_if(code_num.isNull() | (code_num < min_code) | (code_num > max_code)).alias("co"),
        F.count_if(v.isNull()).alias("nv"),
        (F.count_if(y.isNotNull() & ((y < min_year) | (y > max_year))) if launch_ok else F.lit(0).cast("bigint")).alias("lo"),
    )
    def total(c):
        return F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    out = per_key.agg(
        total("n").alias("rows"),
        total("vo").alias("value_out_of_range"),
        total("co").alias("code_out_of_range"),
        total("nv").alias("null_values"),
        total("lo").alias("launch_year_out_of_range"),
        total(F.col("n") - 1).alias("duplicate_rows"),
    )
    null_share = F.try_divide(F.col("null_values").cast("double"), F.col("rows"))
    dup_share = F.try_divide(F.col("duplicate_rows").cast("double"), F.col("rows"))
    return out.select(
        "*",
        null_share.alias("null_share"),
        dup_share.alias("duplicate_share"),
        (F.coalesce(null_share, F.lit(0.0)) <= max_null_share).alias("null_share_ok"),
        (F.coalesce(dup_share, F.lit(0.0)) <= max_duplicate_share).alias("duplicate_share_ok"),
        (F.col("value_out_of_range") == 0).alias("values_ok"),
        (F.col("code_out_of_range") == 0).alias("codes_ok"),
        (F.col("launch_year_out_of_range") == 0).alias("launch_years_ok"),
    )


def dataset_summary(df: DataFrame, key: str | None = None, approx_rsd: float | None = None) -> DataFrame:
    """Rows, columns and distinct keys, one row (bytes on disk: ``sources.readers.files_summary``).

    With ``approx_rsd`` the distinct count is a HyperLogLog++ estimate with that
    relative standard deviation: one pass with a fixed-size sketch per task
    instead of a shuffle of every key.
    """
    aggs = [F.count(F.lit(1)).alias("rows")]
    if key is not None:
        distinct = F.approx_count_distinct(key, approx_rsd) if approx_rsd else F.countDistinct(key)
        aggs.append(distinct.alias("distinct_keys"))
    return df.agg(*aggs).withColumn("columns", F.lit(len(df.columns)))


def value_range(df: DataFrame, date: str = "date", value: str = "nav", key: str | None = "scheme_code") -> DataFrame:
    """First and last date, lowest and highest value, span in years and distinct keys, one row."""
    aggs = [
        F.min(date).alias("first_date"),
        F.max(date).alias("last_date"),
        F.min(value).alias("min_value"),
        F.max(value).alias("max_value"),
        F.count(F.lit(1)).alias("rows"),
    ]
    if key is not None:
        aggs.append(F.countDistinct(key).alias("distinct_keys"))
    out = df.agg(*aggs)
    return out.withColumn("years", F.datediff("last_date", "first_date") / F.lit(365.25))


def format_report(view: DataFrame, date: str = "date") -> DataFrame:
    """Console text of the report view: date, thousands-separated counts, ratio in percent, marker."""
    line = F.format_string(
        "%-14s %8s %9s %8s %-10s%s",
        F.date_format(date, "yyyy-MM-dd"),
        F.format_number("scheme_count", 0),
        F.format_number("expected_count", 0),
        F.concat(F.format_number(F.col("completeness_ratio") * 100, 1), F.lit("%")),
        F.col("status"),
        F.col("marker"),
    )
    return view.select(date, line.alias("line"))
