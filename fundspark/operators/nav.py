"""Price tables: raw report cleaning, enrichment with metadata, combined and analytical tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundspark.functions.joins import METADATA_BROADCAST_ROWS, broadcast_if_small, is_small

from fundspark.functions.dates import NAV_DATE_FORMAT, parse_date
from fundspark.functions.numeric import parse_double
from fundspark.operators.series import pct_change

# Raw report header -> column, in the report's order.
NAV_COLUMN_MAPPING = {
    "Scheme Code": "scheme_code",
    "ISIN Div Payout/ISIN Growth": "isin_growth",
    "ISIN Div Reinvestment": "isin_dividend",
    "Net Asset Value": "nav",
    "Date": "date",
}
NAV_COLUMNS = list(NAV_COLUMN_MAPPING)

# Metadata columns carried into the enriched table (key not repeated).
ENRICH_COLUMNS = [
    "amc_name", "scheme_name", "scheme_type", "scheme_category", "scheme_nav_name",
    "scheme_category_level1", "scheme_category_level2", "is_direct", "is_growth_plan",
]


def clean_nav(raw: DataFrame, columns: Sequence[str] | None = None, mapping=NAV_COLUMN_MAPPING) -> DataFrame:
    """Raw report rows (strings) -> (scheme_code, isin_growth, isin_dividend, nav, date).

    Rows NULL in code, value or date are dropped *before* parsing, so an
    unparsable value ('N.A.', '1,234.5') or date ('31-Feb-2006') survives
    as NULL. Dates are strict ``d-MMM-yyyy`` (any case).
    """
    columns = list(columns or mapping)
    df = raw.select(*[F.col(f"`{c}`").alias(mapping.get(c, c)) for c in columns])
    df = df.filter(F.col("scheme_code").isNotNull() & F.col("nav").isNotNull() & F.col("date").isNotNull())
    return df.withColumns(
        {
            "scheme_code": F.col("scheme_code").cast("string"),
            "date": parse_date(F.col("date").cast("string"), NAV_DATE_FORMAT),
            "nav": parse_double(F.col("nav").cast("string")),
        }
    )


def enrich_nav(
    nav: DataFrame,
    meta: DataFrame,
    key: str = "scheme_code",
    columns: Sequence[str] = ENRICH_COLUMNS,
    growth_only: bool = True,
    broadcast_max_rows: int | None = METADATA_BROADCAST_ROWS,
) -> DataFrame:
    """Prices joined to growth-plan metadata, NULL prices dropped, exact repeats removed.

    DISTINCT runs on each side *before* the join: a join of two distinct
    inputs is distinct, so the result equals DISTINCT over the joined rows,
    but the shuffle carries the narrow price rows instead of 14 columns.
    The metadata side (about 16 K instruments) is broadcast only after a
    bounded count proves it small (``limit(n + 1).count()``); then prices
    are first cut to the keys it holds (a broadcast semi join in the scan's
    stage), so the DISTINCT shuffles only rows that the join keeps. Beyond
    the bound the join is left to the planner (sort-merge, AQE skew split,
    Spark's own Bloom filter). Filters run below the join, so they reach the scan.
    """
    m = meta.filter(F.col("is_growth_plan")) if growth_only else meta
    m_rows = m.select(key, *[c for c in columns if c != key])
    m = m_rows.distinct()
    prices = nav.filter(F.col("nav").isNotNull())
    # the rows before the DISTINCT bound the rows after it: count those, no shuffle
    if broadcast_max_rows and is_small(m_rows, broadcast_max_rows):
        prices = prices.join(F.broadcast(m_rows.select(key)), key, "left_semi")
        m = F.broadcast(m)
    return prices.distinct().join(m, key, "inner")


def combine_nav(historical: DataFrame, daily: DataFrame) -> DataFrame:
    """Historical and daily rows in one table by column name, exact repeats removed."""
    return historical.unionByName(daily, allowMissingColumns=True).distinct()


def analytical_dataset(
    prices: DataFrame,
    meta: DataFrame,
    key: str = "scheme_code",
    order: str = "date",
    value: str = "nav",
    extra: Sequence[str] = ("launch_date", "minimum_amount"),
    info: DataFrame | None = None,
) -> DataFrame:
    """Prices with metadata, launch date and minimum amount, day-over-day change, year and month.

    ``info`` holds the descriptive columns of the instruments (prices
    without an instrument there are left out); ``prices`` that carry them
    already need none. ``nav_change_pct`` is a fraction (as the source uses
    it), computed per key in date order with NULLs padded forward -- over
    the narrow price rows, before either join widens them: joins on the key
    keep or drop whole series, so the change is the same and the window's
    shuffle and sort carry three columns.
    """
    changed = with_daily_change(prices, key, order, value)
    if info is not None:
        changed = changed.join(broadcast_if_small(info, METADATA_BROADCAST_ROWS), key, "inner")
    return changed.join(broadcast_if_small(meta.select(key, *extra), METADATA_BROADCAST_ROWS), key, "left")


def with_daily_change(df: DataFrame, key: str = "scheme_code", order: str = "date", value: str = "nav") -> DataFrame:
    """Add ``nav_change_pct`` (a fraction: day-over-day change per key, NULLs padded), ``year``, ``month``."""
    return df.withColumn("nav_change_pct", pct_change(value, key, order)).withColumns(
        {"year": F.year(order), "month": F.month(order)}
    )


def load_historical_nav(spark, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """All landed history files (comma CSV with the report header) -> clean rows, one distributed scan."""
    from fundspark.sources.readers import read_csv_glob

    cols = list(columns or NAV_COLUMNS)
    return clean_nav(read_csv_glob(spark, path, cols), cols)


def write_clean_table(
    enriched: DataFrame, path: str, date: str = "date", key: str = "scheme_code", partitions: int | None = None
) -> None:
    """Store the enriched table partitioned by date; a run replaces only the dates it holds.

    A one-day run therefore adds or replaces that day instead of
    overwriting the whole table. Rows are range-partitioned on (date, key)
    before the write: each task holds a contiguous slice, so a date gets a
    few files instead of one per task, and a date with many rows is still
    split across tasks by key. Sorting inside each task orders the row
    groups, so their min/max statistics prune date and key filters.
    """
    from fundspark.sources.sinks import write_parquet

    n = partitions or int(enriched.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    laid_out = enriched.repartitionByRange(n, date, key).sortWithinPartitions(date, key)
    write_parquet(laid_out, path, partition_by=[date], dynamic_overwrite=True)
