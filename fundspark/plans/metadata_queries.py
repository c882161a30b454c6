"""Metadata cleaning, enrichment, combined and analytical tables, master table, report cleaning."""

from __future__ import annotations

from pyspark.sql import functions as F

from fundspark.operators import master as M
from fundspark.operators import metadata as MD
from fundspark.functions.joins import METADATA_BROADCAST_ROWS, broadcast_if_small
from fundspark.functions.text import ellipsis
from fundspark.operators import nav as N
from fundspark.operators import series as T
from fundspark.operators import tables as TB
from fundspark.plans import standins as S
from fundspark.plans.registry import r6, register


# --------------------------------------------------------------------------
# Metadata (part as the scheme list)
# --------------------------------------------------------------------------


_META_COLS = [
    "amc_name", "scheme_code", "scheme_name", "scheme_type", "scheme_category", "scheme_nav_name",
    "minimum_amount", "launch_date", "closure_date", "isin_growth", "isin_dividend",
    "scheme_category_level1", "scheme_category_level2", "is_direct", "is_growth_plan",
]


@register("clean_metadata", f"WITH {S.PART_METADATA_SQL} SELECT {', '.join(_META_COLS)} FROM meta")
def q_clean_metadata(spark, sf_dir):
    return S.part_metadata(spark, sf_dir).select(*_META_COLS)


@register(
    "category_levels",
    f"WITH {S.PART_METADATA_SQL} SELECT scheme_code, scheme_category, scheme_category_level1, scheme_category_level2 FROM meta",
)
def q_category_levels(spark, sf_dir):
    raw = S.part_metadata_raw(spark, sf_dir).select(
        F.col("Code").alias("scheme_code"), F.nullif(F.trim("Scheme Category"), F.lit("")).alias("scheme_category")
    )
    return MD.category_levels(raw, rules=S.PART_LEVEL1_RULES)


@register(
    "plan_flags",
    f"WITH {S.PART_METADATA_SQL} SELECT scheme_code, scheme_nav_name, is_direct, is_growth_plan FROM meta",
)
def q_plan_flags(spark, sf_dir):
    raw = S.part_metadata_raw(spark, sf_dir).select(
        F.col("Code").alias("scheme_code"), F.col("Scheme NAV Name").alias("scheme_nav_name")
    )
    return MD.plan_flags(raw, direct=S.PART_DIRECT, growth=S.PART_GROWTH, non_growth=S.PART_NON_GROWTH)


@register(
    "validate_metadata",
    f"""WITH {S.PART_METADATA_SQL}
    SELECT COUNT(*) AS "rows", COUNT(DISTINCT scheme_code) AS distinct_codes, COUNT(DISTINCT amc_name) AS distinct_amcs,
           COUNT(*) FILTER (WHERE scheme_code IS NULL) AS null_codes,
           COUNT(*) - COUNT(DISTINCT scheme_code) - CASE WHEN COUNT(*) FILTER (WHERE scheme_code IS NULL) > 0 THEN 1 ELSE 0 END
             AS duplicate_codes,
           '' AS missing_columns, COUNT(*) > 0 AS valid
    FROM meta""",
)
def q_validate_metadata(spark, sf_dir):
    return MD.validate_metadata(S.part_metadata(spark, sf_dir))


@register(
    "normalised_headers",
    f"""SELECT "AMC" AS amc, "Code" AS code, "Scheme Name" AS scheme_name, "Scheme Minimum Amount" AS scheme_minimum_amount,
           "ISIN Div Payout/ ISIN Growth" AS "isin_div_payout/_isin_growth", "Launch Date" AS launch_date_dd_mm
    FROM ({S.PART_METADATA_RAW_SQL})""",
)
def q_normalised_headers(spark, sf_dir):
    raw = S.part_metadata_raw(spark, sf_dir).select(
        F.col("AMC").alias(" AMC "), F.col("Code").alias("CODE"), "Scheme Name", "Scheme Minimum Amount",
        "ISIN Div Payout/ ISIN Growth", F.col("Launch Date").alias("Launch Date (dd.mm)"),
    )
    return MD.normalise_headers(raw)


@register(
    "metadata_without_columns",
    f"""WITH {S.PART_METADATA_SQL} SELECT * REPLACE (CAST(NULL AS DATE) AS launch_date, CAST(NULL AS DOUBLE) AS minimum_amount) FROM (SELECT {', '.join(_META_COLS)} FROM meta)""",
)
def q_metadata_without_columns(spark, sf_dir):
    """A scheme list that lacks two columns: they come out as typed NULLs."""
    raw = S.part_metadata_raw(spark, sf_dir).drop("Launch Date", "Scheme Minimum Amount")
    clean = MD.clean_scheme_metadata(
        raw, level1_rules=S.PART_LEVEL1_RULES, direct=S.PART_DIRECT, growth=S.PART_GROWTH, non_growth=S.PART_NON_GROWTH
    )
    return clean.select(*_META_COLS)


@register(
    "short_names",
    """SELECT p_partkey, CASE WHEN length(n) > 50 THEN substr(n, 1, 50) || '...' ELSE n END AS short_name, length(n) > 50 AS cut
       FROM (SELECT p_partkey, repeat(p_name || ' ', 1 + p_size // 8) || p_type AS n FROM part)""",
)
def q_short_names(spark, sf_dir):
    """Names of one to seven times the part's, cut at 50 characters."""
    part = S.table(spark, sf_dir, "part")
    name = F.concat(F.expr("repeat(concat(p_name, ' '), cast(1 + p_size div 8 as int))"), F.col("p_type"))
    return part.select("p_partkey", ellipsis(name, 50).alias("short_name"), (F.length(name) > 50).alias("cut"))


# --------------------------------------------------------------------------
# Annual log returns by the instrument's twelve descriptive columns
# --------------------------------------------------------------------------

_TWELVE = [
    "scheme_code", "isin_growth", "isin_dividend", "amc_name", "scheme_name", "scheme_type", "scheme_category", "scheme_nav_name",
    "scheme_category_level1", "scheme_category_level2", "is_direct", "is_growth_plan",
]


@register(
    "annual_log_returns_all_keys",
    f"""WITH {S.PART_METADATA_SQL},
    d AS (SELECT CAST(l_partkey AS VARCHAR) AS scheme_code, CAST(l_shipdate AS DATE) AS date, MIN(l_extendedprice) AS nav
          FROM lineitem GROUP BY 1, 2),
    r AS (SELECT *, ln(nav / LAG(nav) OVER (PARTITION BY scheme_code ORDER BY date)) AS log_return FROM d)
    SELECT {', '.join('m.' + c for c in _TWELVE)}, make_date(CAST(year(date) AS INTEGER), 12, 31) AS date,
           (ROUND(COALESCE(SUM(log_return), 0), 6) + CAST(0 AS DOUBLE)) AS log_return
    FROM r JOIN meta m USING (scheme_code) WHERE m.scheme_category_level1 = 'Equity Scheme' AND m.is_direct GROUP BY ALL""",
)
def q_annual_log_returns_all_keys(spark, sf_dir):
    """Direct equity plans: the twelve keys include columns that are NULL for every row or for some."""
    prices = T.one_per_date(_lineitem_nav_by_part(spark, sf_dir), keep="min")
    meta = S.part_metadata(spark, sf_dir).select(*_TWELVE)
    chosen = meta.filter((F.col("scheme_category_level1") == "Equity Scheme") & F.col("is_direct"))
    returns = T.period_returns(prices).join(broadcast_if_small(chosen, METADATA_BROADCAST_ROWS), "scheme_code")
    return r6(T.annual_log_returns(returns, _TWELVE), ["log_return"])


# --------------------------------------------------------------------------
# Enrichment, combined and analytical tables
# --------------------------------------------------------------------------

_ENRICH_SQL = f"""WITH {S.PART_METADATA_SQL},
  nav AS (SELECT CAST(l_partkey AS VARCHAR) AS scheme_code, CAST(l_shipdate AS DATE) AS date, l_extendedprice AS nav FROM lineitem)
  SELECT DISTINCT nav.*, {', '.join('m.' + c for c in N.ENRICH_COLUMNS)}
  FROM nav JOIN (SELECT * FROM meta WHERE is_growth_plan) m USING (scheme_code)
  WHERE nav.nav IS NOT NULL"""


def _lineitem_nav_by_part(spark, sf_dir):
    li = S.table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_partkey").cast("string").alias("scheme_code"),
        F.to_date("l_shipdate").alias("date"),
        F.col("l_extendedprice").alias("nav"),
    )


@register("enrich_distinct", _ENRICH_SQL)
def q_enrich_distinct(spark, sf_dir):
    return N.enrich_nav(_lineitem_nav_by_part(spark, sf_dir), S.part_metadata(spark, sf_dir))


_SPLIT = ("1996-01-01", "1998-12-31")  # historical up to the second date, daily from the first


@register(
    "combined_table",
    f"""SELECT DISTINCT * FROM (
      SELECT * FROM ({S.NAV_RAW_SQL}) WHERE date <= DATE '{_SPLIT[1]}'
      UNION ALL
      SELECT * FROM ({S.NAV_RAW_SQL}) WHERE date >= DATE '{_SPLIT[0]}')""",
)
def q_combined_table(spark, sf_dir):
    raw = S.nav_raw(spark, sf_dir)
    hist = raw.filter(F.col("date") <= F.lit(_SPLIT[1]).cast("date"))
    daily = raw.filter(F.col("date") >= F.lit(_SPLIT[0]).cast("date"))
    return N.combine_nav(hist, daily)


@register(
    "analytical_dataset",
    f"""WITH d AS ({S.DAILY_SQL}), info AS ({S.FUND_INFO_SQL}),
    m AS (SELECT s_suppkey AS scheme_code, make_date(1990 + s_nationkey, 1, 1) AS launch_date, s_acctbal AS minimum_amount FROM supplier),
    e AS (SELECT d.*, info.scheme_name, info.scheme_category, info.amc_name FROM d JOIN info USING (scheme_code))
    SELECT e.*, m.launch_date, m.minimum_amount,
           (ROUND(nav / LAG(nav) OVER (PARTITION BY e.scheme_code ORDER BY date) - 1, 6) + CAST(0 AS DOUBLE)) AS nav_change_pct,
           CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month
    FROM e LEFT JOIN m USING (scheme_code)""",
)
def q_analytical_dataset(spark, sf_dir):
    sup = S.table(spark, sf_dir, "supplier")
    meta = sup.select(
        F.col("s_suppkey").alias("scheme_code"),
        F.make_date(F.lit(1990) + F.col("s_nationkey"), F.lit(1), F.lit(1)).alias("launch_date"),
        F.col("s_acctbal").alias("minimum_amount"),
    )
    return r6(N.analytical_dataset(S.daily(spark, sf_dir), meta, info=S.fund_info(spark, sf_dir)), ["nav_change_pct"])


# --------------------------------------------------------------------------
# Prices merged with metadata that repeats two of their column names
# --------------------------------------------------------------------------

_MERGED_META = [c for c in _META_COLS if c not in ("minimum_amount", "closure_date")]
_MERGED_NAV_SQL = """nav AS (SELECT CASE WHEN l_partkey % 20 <> 0 THEN CAST(l_partkey AS VARCHAR) END AS scheme_code,
           'INF' || CAST(l_suppkey AS VARCHAR) AS isin_growth, l_returnflag AS isin_dividend, l_extendedprice AS nav,
           CAST(l_shipdate AS DATE) AS date FROM lineitem)"""
_MERGED_META_SQL = f"""chosen AS (
    SELECT * EXCLUDE (scheme_code, minimum_amount, closure_date),
           CASE WHEN CAST(scheme_code AS BIGINT) % 20 <> 0 THEN scheme_code END AS scheme_code
    FROM meta WHERE scheme_type = 'Open Ended' AND is_growth_plan)"""
_MERGED_OUT = ", ".join(
    ["nav.scheme_code", "nav.isin_growth AS isin_growth_x", "nav.isin_dividend AS isin_dividend_x", "nav.nav", "nav.date"]
    + [f"c.{c} AS {c}_y" if c.startswith("isin") else f"c.{c}" for c in _MERGED_META if c != "scheme_code"]
)


def _merge_sides(spark, sf_dir):
    """Price rows and open-ended growth plans with clashing isin columns; some keys are NULL on both sides."""
    li = S.table(spark, sf_dir, "lineitem")
    part = F.col("l_partkey")
    prices = li.select(
        F.when(part % 20 != 0, part.cast("string")).alias("scheme_code"),
        F.concat(F.lit("INF"), F.col("l_suppkey").cast("string")).alias("isin_growth"),
        F.col("l_returnflag").alias("isin_dividend"),
        F.col("l_extendedprice").alias("nav"),
        F.to_date("l_shipdate").alias("date"),
    )
    chosen = S.part_metadata(spark, sf_dir).select(*_META_COLS)
    chosen = chosen.filter((F.col("scheme_type") == "Open Ended") & F.col("is_growth_plan")).drop("minimum_amount", "closure_date")
    code = F.col("scheme_code")
    return prices, chosen.withColumn("scheme_code", F.when(code.cast("bigint") % 20 != 0, code))


@register(
    "nav_metadata_merge",
    f"WITH {S.PART_METADATA_SQL}, {_MERGED_NAV_SQL}, {_MERGED_META_SQL} SELECT {_MERGED_OUT} FROM nav JOIN chosen c USING (scheme_code)",
)
def q_nav_metadata_merge(spark, sf_dir):
    prices, chosen = _merge_sides(spark, sf_dir)
    return TB.merge_tables(prices, chosen, "scheme_code", broadcast_max_rows=METADATA_BROADCAST_ROWS)


@register(
    "nav_metadata_left_merge",
    f"""WITH {S.PART_METADATA_SQL}, {_MERGED_NAV_SQL}, {_MERGED_META_SQL},
    j AS (SELECT {_MERGED_OUT} FROM nav LEFT JOIN chosen c ON nav.scheme_code = c.scheme_code)
    SELECT isin_growth_x AS isin_growth_nav, scheme_code IS NULL AS no_key, isin_growth_y IS NULL AS no_match, scheme_type,
           COUNT(*) AS "rows", COUNT(isin_dividend_y) AS dividends, (ROUND(SUM(nav) + CAST(0 AS DOUBLE), 2) + CAST(0 AS DOUBLE)) AS total
    FROM j GROUP BY ALL""",
)
def q_nav_metadata_left_merge(spark, sf_dir):
    """Every price row, summed by what the merge found; rows without a key stay and match nothing."""
    prices, chosen = _merge_sides(spark, sf_dir)
    merged = TB.merge_tables(prices, chosen, "scheme_code", how="left", suffixes=("_nav", "_meta"))
    groups = merged.groupBy(
        "isin_growth_nav", F.col("scheme_code").isNull().alias("no_key"), F.col("isin_growth_meta").isNull().alias("no_match"), "scheme_type"
    )
    return groups.agg(
        F.count(F.lit(1)).alias("rows"), F.count("isin_dividend_meta").alias("dividends"), F.round(F.sum("nav"), 2).alias("total")
    )


@register(
    "exact_sample",
    "SELECT * FROM orders ORDER BY md5('7' || chr(31) || CAST(o_orderkey AS VARCHAR)) LIMIT 1000",
)
def q_exact_sample(spark, sf_dir):
    """One thousand orders, the same in every engine and at every partitioning."""
    return TB.sample_n(S.table(spark, sf_dir, "orders"), 1000, ["o_orderkey"], seed=7)


# --------------------------------------------------------------------------
# Master table (instruments with orders before and after one date)
# --------------------------------------------------------------------------

# The runs' dates: at the cut, and the day after the last order, within the views' 30 days of the cut.
_AS_OF = {"existing": S.MASTER_CUT, "latest": "2001-08-02", "all": "2001-08-02"}
_MASTER_OUT = [
    "scheme_code", "scheme_name", "amc_name", "launch_date", "orders_in_window",
    "first_seen_date", "last_seen_date", "is_active", "attribute_last_updated",
]


def _master_initial_sql(which):
    d = _AS_OF[which]
    return f"""SELECT *, COALESCE(launch_date, DATE '{d}') AS first_seen_date, DATE '{d}' AS last_seen_date,
               TRUE AS is_active, DATE '{d}' AS attribute_last_updated FROM ({S.customer_snapshot_sql(which)})"""


_MERGE_SQL = f"""WITH e AS ({_master_initial_sql('existing')}), l AS ({S.customer_snapshot_sql('latest')}),
  j AS (SELECT e.scheme_code AS ek, e.scheme_name AS en, e.amc_name AS ea, e.launch_date AS el, e.orders_in_window AS eo,
               e.first_seen_date AS ef, e.last_seen_date AS els, e.attribute_last_updated AS eu, e.scheme_code IS NOT NULL AS in_e,
               l.scheme_code AS lk, l.scheme_name AS ln, l.amc_name AS la, l.launch_date AS ll, l.orders_in_window AS lo,
               l.scheme_code IS NOT NULL AS in_l
        FROM e FULL OUTER JOIN l ON e.scheme_code IS NOT DISTINCT FROM l.scheme_code),
  master AS (
  SELECT CASE WHEN in_l THEN lk ELSE ek END AS scheme_code,
         CASE WHEN in_l THEN ln ELSE en END AS scheme_name,
         CASE WHEN in_l THEN la ELSE ea END AS amc_name,
         CASE WHEN in_l THEN ll ELSE el END AS launch_date,
         CASE WHEN in_l THEN lo ELSE eo END AS orders_in_window,
         CASE WHEN in_l AND in_e THEN ef WHEN in_l THEN COALESCE(ll, DATE '{_AS_OF['latest']}') ELSE ef END AS first_seen_date,
         CASE WHEN in_l THEN DATE '{_AS_OF['latest']}' ELSE els END AS last_seen_date,
         in_l AS is_active,
         CASE WHEN in_l THEN DATE '{_AS_OF['latest']}' ELSE eu END AS attribute_last_updated
  FROM j)"""


def _merged(spark, sf_dir):
    existing = M.build_initial_master(S.customer_snapshot(spark, sf_dir, "existing"), _AS_OF["existing"])
    latest = S.customer_snapshot(spark, sf_dir, "latest")
    return M.merge_master(existing, latest, _AS_OF["latest"])


@register("master_initial", _master_initial_sql("all"))
def q_master_initial(spark, sf_dir):
    return M.build_initial_master(S.customer_snapshot(spark, sf_dir, "all"), _AS_OF["all"])


@register("master_merge", _MERGE_SQL + " SELECT * FROM master")
def q_master_merge(spark, sf_dir):
    return _merged(spark, sf_dir).select(*_MASTER_OUT)


@register(
    "master_views",
    _MERGE_SQL
    + f"""
    SELECT COUNT(*) AS total, COUNT(*) FILTER (WHERE is_active) AS active, COUNT(*) FILTER (WHERE NOT is_active) AS inactive,
           COUNT(*) FILTER (WHERE first_seen_date >= DATE '{_AS_OF['latest']}' - INTERVAL 30 DAY) AS recent,
           COUNT(*) FILTER (WHERE NOT is_active AND last_seen_date >= DATE '{_AS_OF['latest']}' - INTERVAL 30 DAY) AS recently_closed
    FROM master""",
)
def q_master_views(spark, sf_dir):
    return M.master_view_counts(_merged(spark, sf_dir), _AS_OF["latest"])


# --------------------------------------------------------------------------
# Raw report cleaning (events as report text with bad values)
# --------------------------------------------------------------------------


@register(
    "clean_nav",
    f"""SELECT CAST("Scheme Code" AS VARCHAR) AS scheme_code, "ISIN Div Payout/ISIN Growth" AS isin_growth,
           "ISIN Div Reinvestment" AS isin_dividend,
           CASE WHEN regexp_matches(trim("Net Asset Value"), '^[+-]?(\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?$')
                THEN TRY_CAST(trim("Net Asset Value") AS DOUBLE) END AS nav,
           CAST(try_strptime(trim("Date"), '%d-%b-%Y') AS DATE) AS date
    FROM ({S.EVENTS_REPORT_SQL}) WHERE "Scheme Code" IS NOT NULL AND "Net Asset Value" IS NOT NULL AND "Date" IS NOT NULL""",
)
def q_clean_nav(spark, sf_dir):
    return N.clean_nav(S.events_report_text(spark, sf_dir))
