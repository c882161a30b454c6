"""The source's scheduled flows, composed from the operators, sources and sinks.

Each job reads landed files or stored tables, runs one Spark plan and
writes its result so that a rerun replaces exactly what it wrote:

* ``metadata_update``: newest raw scheme list -> cleaned, checked table
  (skipped when the processed table is already newer);
* ``master_update``: cleaned scheme list -> new version of the master;
* ``prices_update``: landed price reports -> clean rows joined to growth-plan
  metadata -> clean table, replacing only the dates the run holds;
* ``history_load``: landed history CSV chunks -> clean raw table;
* ``completeness_update``: clean table -> per-date report (CSV) and totals;
* ``fund_report``: name search with fallback levels -> best-covered fund ->
  KPI record and series export;
* ``analytics_table_update``: clean table -> copy bucketed by instrument,
  on which per-instrument windows and aggregates need no shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundspark.operators import master, metadata, nav, quality
from fundspark.sources import readers, sinks


def metadata_update(spark: SparkSession, raw_glob: str, clean_path: str, legacy: str | None = None) -> DataFrame | None:
    """Clean the newest raw scheme list into ``clean_path`` when it is newer than the stored table.

    Returns the one-row check (counts and ``valid``); nothing is written when
    the check fails. Returns None when there is nothing new to process.
    """
    if not readers.is_newer(spark, raw_glob, clean_path, legacy):
        return None
    raw = readers.read_metadata_csv(spark, readers.newest_file(spark, raw_glob, legacy))
    clean = metadata.clean_scheme_metadata(raw)
    check = metadata.validate_metadata(clean)
    if check.first()["valid"]:
        sinks.write_parquet(clean, clean_path)
    return check


def master_update(spark: SparkSession, clean_path: str, master_path: str, as_of) -> DataFrame:
    """Merge the cleaned scheme list into a new ``as_of`` version of the master table."""
    latest = readers.read_parquet(spark, clean_path)
    return master.update_master_table(spark, master_path, latest, as_of)


def prices_update(spark: SparkSession, landing: str, meta_path: str, clean_path: str, sep: str = ";") -> DataFrame:
    """Landed daily reports -> enriched rows written into the date-partitioned clean table."""
    raw = readers.read_nav_report(spark, landing, sep=sep)
    if not readers.check_batch(raw):
        raise ValueError(f"no usable report under {landing}")
    enriched = nav.enrich_nav(nav.clean_nav(raw), readers.read_parquet(spark, meta_path))
    nav.write_clean_table(enriched, clean_path)
    return readers.read_parquet(spark, clean_path)


def history_load(spark: SparkSession, csv_glob: str, raw_path: str) -> DataFrame:
    """All landed history chunk files -> one clean raw table (Parquet)."""
    sinks.write_parquet(nav.load_historical_nav(spark, csv_glob), raw_path)
    return readers.read_parquet(spark, raw_path)


def completeness_update(
    spark: SparkSession,
    clean_path: str,
    report_path: str,
    threshold: float = quality.DEFAULT_THRESHOLD,
    window: int = quality.DEFAULT_WINDOW,
    start=None,
    end=None,
) -> DataFrame:
    """Per-date completeness of the clean table written as CSV; returns the totals row (``passed``)."""
    prices = readers.read_parquet(spark, clean_path)
    report = quality.validation_report(prices, threshold=threshold, window=window, start=start, end=end)
    # An empty report replaces an older one too: its totals are zero dates, not the last run's.
    report.orderBy("date").write.mode("overwrite").option("header", True).csv(report_path)
    written = spark.read.schema(report.schema).option("header", True).csv(report_path)
    stats = quality.validation_stats(written.select("date", "status"), threshold, window)
    return stats.withColumn("passed", F.col("passed") & (F.col("total_dates") > 0)) if "passed" in stats.columns else stats


def fund_report(
    spark: SparkSession,
    clean_path: str,
    levels,
    out: str,
    key: str = "scheme_code",
    columns=("scheme_code", "scheme_name", "amc_name", "scheme_category"),
) -> DataFrame:
    """The fund study: search by fallback levels, pick the best-covered match, export its KPIs.

    ``levels`` are boolean conditions (see ``performance.scheme_search``).
    The chosen fund is a one-row table, so restricting the prices to it is
    a broadcast semi join; KPI record and series go under ``out``. Returns
    the KPI row.
    """
    from fundspark.operators import performance

    prices = readers.read_parquet(spark, clean_path)
    found = performance.scheme_search(prices, levels, list(columns))
    candidates = prices.join(found.select(key).distinct(), key, "left_semi")
    chosen = performance.top_coverage(performance.coverage(candidates), key=key).select(key)
    series = prices.join(chosen, key, "left_semi")
    kpis = performance.fund_kpis(series)
    info = found.select(*columns).dropDuplicates([key])
    meta = series.select(key).distinct().join(info, key, "left")
    sinks.export_fund_report(kpis, nav.with_daily_change(series, key), out, key=key, info=meta)
    return kpis


def analytics_table_update(
    spark: SparkSession, clean_path: str, name: str, path: str, key: str = "scheme_code", buckets: int = 64
) -> DataFrame:
    """Copy the clean table into a table bucketed by instrument for the analytics queries.

    The clean table stays partitioned by date (daily replace); this copy is
    rebuilt from it and read by KPIs, returns and calendar tables, whose
    per-instrument windows then need no shuffle.
    """
    prices = readers.read_parquet(spark, clean_path)
    return sinks.write_bucketed_table(prices, name, path, key, buckets, sort_by=[key, "date"])
