"""Completeness report, duplicates, quality rules and small whole-table summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from fundspark.operators import quality
from fundspark.plans import standins as S
from fundspark.plans.registry import register


# --------------------------------------------------------------------------
# Completeness report (events: user = key, event day = date)
# --------------------------------------------------------------------------

_REPORT_SQL = f"""
WITH src AS ({S.EVENT_DAYS_SQL}),
counts AS (SELECT date, COUNT(DISTINCT scheme_code) AS scheme_count FROM src GROUP BY date),
base AS (
  SELECT date, scheme_count,
         COALESCE(CAST(AVG(scheme_count) OVER (ORDER BY date NULLS LAST
                       ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING) AS INTEGER),
                  CAST(FLOOR(quantile_cont(scheme_count, 0.5) OVER ()) AS INTEGER)) AS expected_count
  FROM counts),
report AS (
  SELECT date, scheme_count, expected_count AS rolling_avg, expected_count,
         CAST(scheme_count AS DOUBLE) / expected_count AS completeness_ratio,
         CASE WHEN CAST(scheme_count AS DOUBLE) / expected_count >= 0.95 THEN 'COMPLETE'
              WHEN CAST(scheme_count AS DOUBLE) / expected_count < 0.5 THEN 'HOLIDAY'
              ELSE 'INCOMPLETE' END AS status
  FROM base)
"""


def _report(spark, sf_dir):
    return quality.validation_report(S.event_days(spark, sf_dir))


@register("validation_report", _REPORT_SQL + "SELECT * FROM report")
def q_validation_report(spark, sf_dir):
    return _report(spark, sf_dir)


@register(
    "validation_stats",
    _REPORT_SQL
    + """
SELECT COUNT(*) AS total_dates,
       COUNT(*) FILTER (WHERE status = 'COMPLETE') AS complete_dates,
       COUNT(*) FILTER (WHERE status = 'INCOMPLETE') AS incomplete_dates,
       COUNT(*) FILTER (WHERE status = 'HOLIDAY') AS holiday_dates,
       CAST(0.95 AS DOUBLE) AS threshold, CAST(5 AS INTEGER) AS "window",
       COUNT(*) FILTER (WHERE status = 'INCOMPLETE') = 0 AS passed
FROM report""",
)
def q_validation_stats(spark, sf_dir):
    return quality.validation_stats(_report(spark, sf_dir))


@register(
    "validation_view",
    _REPORT_SQL
    + """
SELECT date, scheme_count, expected_count, completeness_ratio, status,
       CASE status WHEN 'INCOMPLETE' THEN ' <-- CHECK' WHEN 'HOLIDAY' THEN ' (holiday)' ELSE '' END AS marker
FROM (SELECT *, ROW_NUMBER() OVER (ORDER BY date DESC NULLS FIRST) AS rn FROM report)
WHERE rn <= 20 OR status <> 'COMPLETE'""",
)
def q_validation_view(spark, sf_dir):
    return quality.validation_view(_report(spark, sf_dir))


# --------------------------------------------------------------------------
# Duplicates and quality rules
# --------------------------------------------------------------------------


@register(
    "dup_code_date_nav",
    f"""WITH raw AS (SELECT * FROM ({S.NAV_RAW_SQL}) UNION ALL SELECT * FROM ({S.NAV_RAW_SQL}) WHERE date >= DATE '1998-01-01')
        SELECT scheme_code, date, nav, COUNT(*) AS count FROM raw GROUP BY 1, 2, 3 HAVING COUNT(*) > 1""",
)
def q_dup_code_date_nav(spark, sf_dir):
    """The history and a later reload of its last years, before exact repeats are removed."""
    raw = S.nav_raw(spark, sf_dir)
    reloaded = raw.unionByName(raw.filter(F.col("date") >= F.lit("1998-01-01").cast("date")))
    return quality.find_duplicates(reloaded, ["scheme_code", "date", "nav"])


@register(
    "dup_code_date",
    f"SELECT scheme_code, date, COUNT(*) AS count FROM ({S.NAV_RAW_SQL}) GROUP BY 1, 2 HAVING COUNT(*) > 1",
)
def q_dup_code_date(spark, sf_dir):
    return quality.find_duplicates(S.nav_raw(spark, sf_dir), ["scheme_code", "date"])


@register(
    "dup_code_date_distinct",
    f"""SELECT scheme_code, date, COUNT(*) AS count
        FROM (SELECT DISTINCT scheme_code, date, nav FROM ({S.NAV_RAW_SQL})) GROUP BY 1, 2 HAVING COUNT(*) > 1""",
)
def q_dup_code_date_distinct(spark, sf_dir):
    return quality.find_duplicates(
        S.nav_raw(spark, sf_dir), ["scheme_code", "date"], distinct_first=["scheme_code", "date", "nav"]
    )


@register(
    "quality_rules",
    f"""WITH o AS (SELECT *, make_date(1980 + scheme_code % 60, 1, 1) AS launch_date FROM ({S.ORDERS_SERIES_SQL})),
    g AS (SELECT scheme_code, date, COUNT(*) AS n,
                 COUNT(*) FILTER (WHERE nav IS NOT NULL AND (nav < 0.01 OR nav > 10000.0)) AS vo,
                 COUNT(*) FILTER (WHERE TRY_CAST(CAST(scheme_code AS VARCHAR) AS BIGINT) IS NULL
                                  OR TRY_CAST(CAST(scheme_code AS VARCHAR) AS BIGINT) < 100000
                                  OR TRY_CAST(CAST(scheme_code AS VARCHAR) AS BIGINT) > 999999) AS co,
                 COUNT(*) FILTER (WHERE nav IS NULL) AS nv,
                 COUNT(*) FILTER (WHERE year(launch_date) < 1990 OR year(launch_date) > 2030) AS lo
          FROM o GROUP BY 1, 2),
    t AS (SELECT CAST(COALESCE(SUM(n), 0) AS BIGINT) AS "rows",
                 CAST(COALESCE(SUM(vo), 0) AS BIGINT) AS value_out_of_range,
                 CAST(COALESCE(SUM(co), 0) AS BIGINT) AS code_out_of_range,
                 CAST(COALESCE(SUM(nv), 0) AS BIGINT) AS null_values,
                 CAST(COALESCE(SUM(lo), 0) AS BIGINT) AS launch_year_out_of_range,
                 CAST(COALESCE(SUM(n - 1), 0) AS BIGINT) AS duplicate_rows FROM g)
    SELECT *, CAST(null_values AS DOUBLE) / "rows" AS null_share,
           CAST(duplicate_rows AS DOUBLE) / "rows" AS duplicate_share,
           COALESCE(CAST(null_values AS DOUBLE) / "rows", 0) <= 0.1 AS null_share_ok,
           COALESCE(CAST(duplicate_rows AS DOUBLE) / "rows", 0) <= 0.05 AS duplicate_share_ok,
           value_out_of_range = 0 AS values_ok, code_out_of_range = 0 AS codes_ok,
           launch_year_out_of_range = 0 AS launch_years_ok
    FROM t""",
)
def q_quality_rules(spark, sf_dir):
    launch = F.make_date((F.lit(1980) + F.col("scheme_code") % 60).cast("int"), F.lit(1), F.lit(1))
    return quality.quality_rules(S.orders_series(spark, sf_dir).withColumn("launch_date", launch))


@register(
    "dataset_summary",
    'SELECT COUNT(*) AS "rows", COUNT(DISTINCT o_custkey) AS distinct_keys, CAST(6 AS INTEGER) AS "columns" FROM orders',
)
def q_dataset_summary(spark, sf_dir):
    return quality.dataset_summary(S.table(spark, sf_dir, "orders"), key="o_custkey")

# --------------------------------------------------------------------------
# Small operators on whole tables
# --------------------------------------------------------------------------


@register(
    "validation_report_range",
    _REPORT_SQL.replace(
        f"src AS ({S.EVENT_DAYS_SQL})",
        f"src AS (SELECT * FROM ({S.EVENT_DAYS_SQL}) WHERE date >= DATE '2024-01-05' AND date <= DATE '2024-01-20')",
    )
    + "SELECT * FROM report",
)
def q_validation_report_range(spark, sf_dir):
    return quality.validation_report(S.event_days(spark, sf_dir), start="2024-01-05", end="2024-01-20")


@register(
    "value_range",
    f"""SELECT MIN(date) AS first_date, MAX(date) AS last_date, MIN(nav) AS min_value, MAX(nav) AS max_value,
           COUNT(*) AS "rows", COUNT(DISTINCT scheme_code) AS distinct_keys,
           date_diff('day', MIN(date), MAX(date)) / 365.25 AS years
    FROM ({S.DAILY_SQL})""",
)
def q_value_range(spark, sf_dir):
    return quality.value_range(S.daily(spark, sf_dir))


@register("latest_date", f"SELECT MAX(date) AS latest_date FROM ({S.EVENT_DAYS_SQL})")
def q_latest_date(spark, sf_dir):
    from fundspark.operators import calendar as C2

    return C2.latest_date(S.event_days(spark, sf_dir))
