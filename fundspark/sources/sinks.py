"""Sinks: Parquet, CSV and JSON writers, snapshots and dated dumps.

Writes never overwrite the path a job reads from: a new table goes to a
new ``as_of=`` partition (or a new path) and readers pick the latest.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

DEFAULT_COMPRESSION = "snappy"


def write_parquet(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    compression: str = DEFAULT_COMPRESSION,
    partition_by: Sequence[str] | None = None,
    dynamic_overwrite: bool = False,
) -> None:
    """Parquet with a codec; with ``dynamic_overwrite`` only the partitions present in ``df`` are replaced."""
    w = df.write.mode(mode).option("compression", compression)
    if dynamic_overwrite:
        w = w.option("partitionOverwriteMode", "dynamic")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", header: bool = True, partition_by=None) -> bool:
    """CSV with a header; returns False when there was no row to write.

    The rows are counted while they are written, so the plan runs once. An
    empty frame replaces what an earlier run left under ``path`` by an
    empty folder (with ``overwrite``).
    """
    seen = Observation()
    w = df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode(mode).option("header", header)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.csv(path)
    return seen.get["rows"] > 0


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One JSON object per row (e.g. a KPI record per fund)."""
    df.write.mode(mode).json(path)


def snapshot(spark: SparkSession, source: str, target: str, fmt: str = "delta", compression: str = DEFAULT_COMPRESSION) -> DataFrame:
    """Copy a table in any readable format to Parquet; returns the written table read back."""
    spark.read.format(fmt).load(source).write.mode("overwrite").option("compression", compression).parquet(target)
    return spark.read.parquet(target)


def dump_path(folder: str, prefix: str, ts: dt.datetime) -> str:
    """``<folder>/YYYY/MM/DD/<prefix>_<YYYYmmddHHMMSS>.csv`` (fixed naming of the instrument dump)."""
    return f"{folder}/{ts:%Y}/{ts:%m}/{ts:%d}/{prefix}_{ts:%Y%m%d%H%M%S}.csv"


def instrument_dump(df: DataFrame, folder: str, prefix: str, ts: dt.datetime) -> str | None:
    """Write the instrument records as one dated CSV directory; None when there is nothing to write."""
    path = dump_path(folder, prefix, ts)
    return path if write_csv(df, path) else None


def export_fund_report(
    kpis: DataFrame, series: DataFrame, path: str, key: str = "scheme_code", info: DataFrame | None = None
) -> None:
    """KPI JSON records and the series (key, date, nav, nav_change_pct, year, month) as CSV.

    The series of all funds are one table in key and date order, range
    partitioned: a file holds a contiguous range of funds, and the number
    of files follows the data, not the number of funds.
    """
    from fundspark.operators.performance import kpi_record

    write_json(kpi_record(kpis, key, info), f"{path}/fund_analysis_results")
    cols = [c for c in (key, "date", "nav", "nav_change_pct", "year", "month") if c in series.columns]
    ordered = series.select(*cols).repartitionByRange(*[c for c in (key, "date") if c in cols])
    write_csv(ordered.sortWithinPartitions(*[c for c in (key, "date") if c in cols]), f"{path}/fund_performance_data")


def write_dated(df: DataFrame, path: str, as_of, column: str = "ingest_date", fmt: str = "parquet") -> None:
    """Append ``df`` under ``<path>/<column>=<as_of>`` replacing only that date's partition."""
    out = df.withColumn(column, F.lit(str(as_of)).cast("date"))
    w = out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(column)
    w.format(fmt).save(path)


def read_latest_dated(
    spark: SparkSession, path: str, column: str = "ingest_date", fmt: str = "parquet", before=None
) -> DataFrame:
    """Rows of the newest dated partition (strictly before ``before`` when given).

    The newest date is a scalar over the partition column only; the filter
    on it prunes the scan to that one folder.
    """
    df = spark.read.format(fmt).load(path)
    dates = df.select(column)
    if before is not None:
        dates = dates.filter(F.col(column) < F.lit(str(before)).cast("date"))
    latest = dates.agg(F.max(column)).scalar()
    return df.filter(F.col(column) == F.lit(latest))


def write_bucketed_table(
    df: DataFrame,
    name: str,
    path: str,
    key: str,
    buckets: int,
    sort_by: Sequence[str] | None = None,
    compression: str = DEFAULT_COMPRESSION,
) -> DataFrame:
    """Store ``df`` as a table bucketed (hash-clustered) on ``key`` at ``path``.

    Reads of the table report hash partitioning on ``key``, so windows,
    aggregates and joins on ``key`` run on the scan's partitioning with no
    shuffle. Rows inside each bucket are sorted by ``sort_by`` (e.g. the key
    and the date), which also orders the window input. Choose ``buckets`` so a
    bucket is a few hundred MB; a bucket holds whole keys, so a key with a
    third of all rows is one bucket -- use this layout for per-instrument
    series, whose size the calendar bounds.
    """
    w = df.write.format("parquet").option("path", path).option("compression", compression).mode("overwrite")
    w = w.bucketBy(buckets, key)
    if sort_by:
        w = w.sortBy(*sort_by)
    w.saveAsTable(name)
    return df.sparkSession.table(name)
