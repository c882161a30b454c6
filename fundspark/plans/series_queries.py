"""Series, KPIs, peers, monthly and calendar tables, coverage and search on the daily stand-in."""

from __future__ import annotations

from pyspark.sql import functions as F

from fundspark.operators import performance as P
from fundspark.operators import series as T
from fundspark.plans import standins as S
from fundspark.plans.registry import r6, register


# --------------------------------------------------------------------------
# Series: fill, returns, drawdown, rolling return (daily stand-in)
# --------------------------------------------------------------------------

# Values on Wednesdays are blanked to exercise the fill (rows are kept).
_GAPPY_SQL = f"""gappy AS (SELECT scheme_code, date,
                          CASE WHEN isodow(date) = 3 THEN NULL ELSE nav END AS nav
                   FROM ({S.DAILY_SQL}))"""
_W = "PARTITION BY scheme_code ORDER BY date"
_RUN = f"({_W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"


def _gappy(spark, sf_dir):
    d = S.daily(spark, sf_dir)
    return d.withColumn("nav", F.when(F.weekday("date") == 2, F.lit(None).cast("double")).otherwise(F.col("nav")))


@register(
    "forward_fill",
    f"WITH {_GAPPY_SQL} SELECT *, LAST_VALUE(nav IGNORE NULLS) OVER {_RUN} AS nav_filled FROM gappy",
)
def q_forward_fill(spark, sf_dir):
    return T.forward_fill(_gappy(spark, sf_dir))


_RETURNS_SQL = f"""{_GAPPY_SQL},
  f AS (SELECT *, LAST_VALUE(nav IGNORE NULLS) OVER {_RUN} AS fl FROM gappy),
  r AS (SELECT scheme_code, date, nav, fl / LAG(fl) OVER ({_W}) - 1 AS perc_return FROM f),
  rl AS (SELECT *, ln(1 + perc_return) AS log_return FROM r)"""


@register(
    "period_returns",
    f"WITH {_RETURNS_SQL} SELECT scheme_code, date, nav, (ROUND(perc_return, 6) + CAST(0 AS DOUBLE)) AS perc_return, "
    "(ROUND(log_return, 6) + CAST(0 AS DOUBLE)) AS log_return FROM rl",
)
def q_period_returns(spark, sf_dir):
    return r6(T.period_returns(_gappy(spark, sf_dir)), ["perc_return", "log_return"])


@register(
    "annual_log_returns",
    f"""WITH {_RETURNS_SQL}
    SELECT scheme_code, make_date(CAST(year(date) AS INTEGER), 12, 31) AS date,
           (ROUND(COALESCE(SUM(log_return), 0), 6) + CAST(0 AS DOUBLE)) AS log_return
    FROM rl GROUP BY 1, 2""",
)
def q_annual_log_returns(spark, sf_dir):
    return r6(T.annual_log_returns(T.period_returns(_gappy(spark, sf_dir))), ["log_return"])


@register(
    "drawdown_series",
    f"""WITH d AS ({S.DAILY_SQL}), m AS (SELECT *, MAX(nav) OVER {_RUN} AS cumulative_max FROM d)
    SELECT scheme_code, date, nav, cumulative_max, (ROUND(nav / cumulative_max - 1, 6) + CAST(0 AS DOUBLE)) AS drawdown FROM m""",
)
def q_drawdown_series(spark, sf_dir):
    return r6(T.drawdown_series(S.daily(spark, sf_dir)), ["drawdown"])


@register(
    "rolling_return_252",
    f"""WITH d AS ({S.DAILY_SQL})
    SELECT *, (ROUND(nav / LAG(nav, 252) OVER ({_W}) - 1, 6) + CAST(0 AS DOUBLE)) AS rolling_return_252 FROM d""",
)
def q_rolling_return_252(spark, sf_dir):
    return r6(T.rolling_return(S.daily(spark, sf_dir)), ["rolling_return_252"])


# --------------------------------------------------------------------------
# Series on raw rows with repeats: one row per key and date first (the last order line of the day)
# --------------------------------------------------------------------------

# Prices of returned lines are missing, so that some dates have a missing and a present value.
_RAW_SQL = f"""raw AS (
    SELECT l_suppkey AS scheme_code, CAST(l_shipdate AS DATE) AS date, l_orderkey, l_linenumber,
           CASE WHEN l_returnflag <> 'R' THEN l_extendedprice END AS nav FROM lineitem),
  ranked AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY scheme_code, date
                 ORDER BY nav IS NOT NULL DESC, l_orderkey DESC, l_linenumber DESC, nav DESC) AS n FROM raw),
  one AS (SELECT scheme_code, date, nav FROM ranked WHERE n = 1)"""
_FILLED_SQL = f"""{_RAW_SQL},
  f AS (SELECT *, LAST_VALUE(nav IGNORE NULLS) OVER {_RUN} AS fl FROM one)"""


def _raw_rows(spark, sf_dir):
    li = S.table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_suppkey").alias("scheme_code"), F.to_date("l_shipdate").alias("date"), "l_orderkey", "l_linenumber",
        F.when(F.col("l_returnflag") != "R", F.col("l_extendedprice")).alias("nav"),
    )


def _one_per_date(spark, sf_dir):
    return T.one_per_date(_raw_rows(spark, sf_dir), by=["l_orderkey", "l_linenumber"])


@register("one_per_date", f"WITH {_RAW_SQL} SELECT * FROM one")
def q_one_per_date(spark, sf_dir):
    return _one_per_date(spark, sf_dir)


@register(
    "one_per_date_rules",
    f"""WITH {_RAW_SQL},
    first AS (SELECT scheme_code, date, nav FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY scheme_code, date
        ORDER BY nav IS NOT NULL DESC, l_orderkey, l_linenumber, nav) AS k FROM raw) WHERE k = 1)
    SELECT r.scheme_code, r.date, any_value(f.nav) AS first_nav, MIN(r.nav) AS min_nav, MAX(r.nav) AS max_nav,
           (ROUND(AVG(r.nav), 6) + CAST(0 AS DOUBLE)) AS mean_nav
    FROM raw r JOIN first f USING (scheme_code, date) GROUP BY 1, 2""",
)
def q_one_per_date_rules(spark, sf_dir):
    raw = _raw_rows(spark, sf_dir)
    by = ["l_orderkey", "l_linenumber"]
    found = None
    for rule in ("first", "min", "max", "mean"):
        part = T.one_per_date(raw, by=by, keep=rule).withColumnRenamed("nav", f"{rule}_nav")
        found = part if found is None else found.join(part, ["scheme_code", "date"])
    return r6(found, ["mean_nav"])


@register("fill_raw_rows", f"WITH {_FILLED_SQL} SELECT scheme_code, date, nav, fl AS nav_filled FROM f")
def q_fill_raw_rows(spark, sf_dir):
    return T.forward_fill(_one_per_date(spark, sf_dir))


@register(
    "returns_raw_rows",
    f"""WITH {_FILLED_SQL}, r AS (
      SELECT scheme_code, date, nav, fl / LAG(fl) OVER ({_W}) - 1 AS perc_return,
             fl / LAG(fl, 252) OVER ({_W}) - 1 AS rolling_return_252, MAX(nav) OVER {_RUN} AS cumulative_max FROM f)
    SELECT scheme_code, date, nav, (ROUND(perc_return, 6) + CAST(0 AS DOUBLE)) AS perc_return, (ROUND(ln(1 + perc_return), 6) + CAST(0 AS DOUBLE)) AS log_return,
           cumulative_max, (ROUND(nav / cumulative_max - 1, 6) + CAST(0 AS DOUBLE)) AS drawdown, (ROUND(rolling_return_252, 6) + CAST(0 AS DOUBLE)) AS rolling_return_252 FROM r""",
)
def q_returns_raw_rows(spark, sf_dir):
    """Returns, drawdown and 252-row return of raw lines: three operators over one shuffle of the calendar."""
    series = T.period_returns(_one_per_date(spark, sf_dir)).transform(T.drawdown_series).transform(T.rolling_return)
    return r6(series, ["perc_return", "log_return", "drawdown", "rolling_return_252"])


# --------------------------------------------------------------------------
# KPIs, labels, lump sum
# --------------------------------------------------------------------------

KPI_SQL = f"""d AS ({S.DAILY_SQL}),
  kr AS (SELECT *, MAX(nav) OVER {_RUN} AS cm, nav / LAG(nav) OVER ({_W}) - 1 AS ret FROM d),
  k0 AS (SELECT scheme_code, arg_min(nav, date) AS start_nav, arg_max(nav, date) AS end_nav,
                MIN(date) AS start_date, MAX(date) AS end_date, COUNT(*) AS data_points,
                STDDEV_SAMP(ret) AS daily_std, MIN(nav / cm - 1) AS max_drawdown
         FROM kr GROUP BY scheme_code),
  k1 AS (SELECT *, CAST(date_diff('day', start_date, end_date) AS INTEGER) AS days,
                date_diff('day', start_date, end_date) / 365.25 AS years,
                end_nav / start_nav AS growth_multiple, (end_nav / start_nav - 1) * 100 AS total_return_pct
         FROM k0),
  k2 AS (SELECT *, CASE WHEN years > 0 THEN pow(growth_multiple, 1 / years) - 1 END AS cagr,
                daily_std * sqrt(252) AS volatility FROM k1),
  kpis AS (SELECT *, CASE WHEN volatility > 0 THEN (cagr - 0.06) / volatility ELSE 0.0 END AS sharpe_ratio,
                  CASE WHEN volatility > 0 THEN cagr / volatility ELSE 0.0 END AS return_per_risk FROM k2)"""

KPI_DOUBLES = [
    "daily_std", "max_drawdown", "years", "growth_multiple", "total_return_pct",
    "cagr", "volatility", "sharpe_ratio", "return_per_risk",
]


@register(
    "fund_kpis",
    f"WITH {KPI_SQL} SELECT scheme_code, start_nav, end_nav, start_date, end_date, data_points, days, "
    + ", ".join(f"(ROUND({c}, 6) + CAST(0 AS DOUBLE)) AS {c}" for c in KPI_DOUBLES)
    + " FROM kpis",
)
def q_fund_kpis(spark, sf_dir):
    return r6(S.daily_kpis(spark, sf_dir), KPI_DOUBLES)


_RAW_KPI_SQL = KPI_SQL.replace(f"d AS ({S.DAILY_SQL})", f"{_RAW_SQL}, d AS (SELECT * FROM one WHERE nav IS NOT NULL)")


@register(
    "kpis_raw_rows",
    f"WITH {_RAW_KPI_SQL} SELECT scheme_code, start_nav, end_nav, start_date, end_date, data_points, days, "
    + ", ".join(f"(ROUND({c}, 6) + CAST(0 AS DOUBLE)) AS {c}" for c in KPI_DOUBLES)
    + " FROM kpis",
)
def q_kpis_raw_rows(spark, sf_dir):
    return r6(P.fund_kpis(_one_per_date(spark, sf_dir).where("nav is not null")), KPI_DOUBLES)


@register(
    "risk_labels",
    f"""WITH {KPI_SQL}
    SELECT scheme_code,
      CASE WHEN volatility > 0.25 THEN 'High' WHEN volatility > 0.15 THEN 'Medium' ELSE 'Low' END AS risk_level,
      CASE WHEN sharpe_ratio > 1 THEN 'Excellent' WHEN sharpe_ratio > 0.5 THEN 'Good' ELSE 'Average' END AS sharpe_rating,
      CASE WHEN cagr > 0.15 THEN 'Excellent' WHEN cagr > 0.10 THEN 'Good' ELSE 'Average' END AS performance_rating
    FROM kpis""",
)
def q_risk_labels(spark, sf_dir):
    return P.risk_labels(S.daily_kpis(spark, sf_dir)).select("scheme_code", "risk_level", "sharpe_rating", "performance_rating")


@register(
    "lump_sum",
    f"""WITH {KPI_SQL}
    SELECT scheme_code, CAST(100000.0 AS DOUBLE) AS amount, (ROUND(100000.0 * growth_multiple, 6) + CAST(0 AS DOUBLE)) AS final_value,
           (ROUND(100000.0 * growth_multiple - 100000.0, 6) + CAST(0 AS DOUBLE)) AS gain FROM kpis""",
)
def q_lump_sum(spark, sf_dir):
    return r6(P.lump_sum(S.daily_kpis(spark, sf_dir)).select("scheme_code", "amount", "final_value", "gain"), ["final_value", "gain"])


# --------------------------------------------------------------------------
# Peers (supplier's nation as the category)
# --------------------------------------------------------------------------

_PEER_SQL = f"""{KPI_SQL},
  info AS ({S.FUND_INFO_SQL}),
  f AS (SELECT k.scheme_code, k.cagr, k.data_points, k.years, i.scheme_category, i.scheme_name
        FROM kpis k JOIN info i USING (scheme_code) WHERE k.cagr IS NOT NULL),
  e AS (SELECT * FROM f WHERE data_points > 252 AND years > 0),
  pr AS (
    SELECT f.scheme_code, f.scheme_category, f.cagr * 100 AS cagr_pct,
      (SELECT COUNT(*) FROM e WHERE e.scheme_category = f.scheme_category AND e.scheme_code <> f.scheme_code) AS peer_count,
      (SELECT AVG(cagr) FROM e WHERE e.scheme_category = f.scheme_category AND e.scheme_code <> f.scheme_code) * 100 AS peer_avg_cagr_pct,
      (SELECT MAX(cagr) FROM e WHERE e.scheme_category = f.scheme_category AND e.scheme_code <> f.scheme_code) * 100 AS peer_best_cagr_pct,
      (SELECT MIN(cagr) FROM e WHERE e.scheme_category = f.scheme_category AND e.scheme_code <> f.scheme_code) * 100 AS peer_worst_cagr_pct,
      1 + (SELECT COUNT(*) FROM e WHERE e.scheme_category = f.scheme_category AND e.scheme_code <> f.scheme_code
                                    AND e.cagr > f.cagr) AS peer_rank
    FROM f),
  peers AS (SELECT *, peer_count + 1 AS total_funds,
                   CAST(peer_count + 1 - peer_rank + 1 AS DOUBLE) / (peer_count + 1) * 100 AS percentile
            FROM pr WHERE peer_count > 0)"""

_PEER_DOUBLES = ["cagr_pct", "peer_avg_cagr_pct", "peer_best_cagr_pct", "peer_worst_cagr_pct", "percentile"]


def _peers(spark, sf_dir):
    return P.peer_comparison(S.daily_kpis(spark, sf_dir), S.fund_info(spark, sf_dir))


@register(
    "peer_rank",
    f"WITH {_PEER_SQL} SELECT scheme_code, scheme_category, peer_count, peer_rank, total_funds, "
    "(ROUND(cagr_pct, 6) + CAST(0 AS DOUBLE)) AS cagr_pct, (ROUND(percentile, 6) + CAST(0 AS DOUBLE)) AS percentile FROM peers",
)
def q_peer_rank(spark, sf_dir):
    df = _peers(spark, sf_dir).select(
        "scheme_code", "scheme_category", "peer_count", "peer_rank", "total_funds", "cagr_pct", "percentile"
    )
    return r6(df, ["cagr_pct", "percentile"])


@register(
    "peer_summary",
    f"WITH {_PEER_SQL} SELECT scheme_code, "
    + ", ".join(f"(ROUND({c}, 6) + CAST(0 AS DOUBLE)) AS {c}" for c in _PEER_DOUBLES[1:4])
    + " FROM peers",
)
def q_peer_summary(spark, sf_dir):
    return r6(_peers(spark, sf_dir).select("scheme_code", *_PEER_DOUBLES[1:4]), _PEER_DOUBLES[1:4])


@register(
    "top_peers",
    f"""WITH {_PEER_SQL},
    t AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY scheme_category ORDER BY cagr DESC, scheme_code) AS position FROM e)
    SELECT scheme_category, CAST(position AS INTEGER) AS position, scheme_code,
           CASE WHEN length(scheme_name) > 50 THEN substr(scheme_name, 1, 50) || '...' ELSE scheme_name END AS scheme_name_short,
           (ROUND(cagr * 100, 6) + CAST(0 AS DOUBLE)) AS cagr_pct
    FROM t WHERE position <= 5""",
)
def q_top_peers(spark, sf_dir):
    return r6(P.top_peers(S.daily_kpis(spark, sf_dir), S.fund_info(spark, sf_dir)), ["cagr_pct"])


@register(
    "best_peers",
    f"""WITH {_PEER_SQL},
    pairs AS (SELECT i.scheme_code, e.scheme_code AS peer_code, e.scheme_name AS peer_name, e.cagr,
                     ROW_NUMBER() OVER (PARTITION BY i.scheme_code ORDER BY e.cagr DESC, e.scheme_code) AS position
              FROM info i JOIN e ON e.scheme_category = i.scheme_category AND e.scheme_code <> i.scheme_code)
    SELECT scheme_code, CAST(position AS INTEGER) AS position, peer_code,
           CASE WHEN length(peer_name) > 50 THEN substr(peer_name, 1, 50) || '...' ELSE peer_name END AS peer_name_short,
           (ROUND(cagr * 100, 6) + CAST(0 AS DOUBLE)) AS cagr_pct
    FROM pairs WHERE position <= 5""",
)
def q_best_peers(spark, sf_dir):
    return r6(P.best_peers(S.daily_kpis(spark, sf_dir), S.fund_info(spark, sf_dir)), ["cagr_pct"])


# --------------------------------------------------------------------------
# Months, seasonality, calendar table, histogram
# --------------------------------------------------------------------------

_MONTHLY_SQL = f"""d AS ({S.DAILY_SQL}),
  mo AS (SELECT scheme_code, date_trunc('month', date) AS year_month,
                arg_min(nav, date) FILTER (WHERE nav IS NOT NULL) AS nav_start,
                arg_max(nav, date) FILTER (WHERE nav IS NOT NULL) AS nav_end,
                MIN(date) AS date_start, MAX(date) AS date_end
         FROM d GROUP BY 1, 2),
  monthly AS (SELECT *, (nav_end / nav_start - 1) * 100 AS monthly_return,
                     CAST(month(date_start) AS INTEGER) AS month, CAST(year(date_start) AS INTEGER) AS year FROM mo)"""


def _monthly(spark, sf_dir):
    return P.monthly_returns(S.daily(spark, sf_dir))


@register(
    "monthly_returns",
    f"""WITH {_MONTHLY_SQL}
    SELECT scheme_code, CAST(year_month AS DATE) AS year_month, nav_start, nav_end, date_start, date_end,
           (ROUND(monthly_return, 6) + CAST(0 AS DOUBLE)) AS monthly_return, month, year FROM monthly""",
)
def q_monthly_returns(spark, sf_dir):
    return r6(_monthly(spark, sf_dir), ["monthly_return"])


@register(
    "seasonality",
    f"""WITH {_MONTHLY_SQL}
    SELECT scheme_code, month, (ROUND(AVG(monthly_return), 6) + CAST(0 AS DOUBLE)) AS mean, (ROUND(STDDEV_SAMP(monthly_return), 6) + CAST(0 AS DOUBLE)) AS std,
           COUNT(monthly_return) AS count, strftime(make_date(2000, month, 1), '%B') AS month_name
    FROM monthly GROUP BY scheme_code, month""",
)
def q_seasonality(spark, sf_dir):
    return r6(P.seasonality(_monthly(spark, sf_dir)), ["mean", "std"])


@register(
    "best_worst_month",
    f"""WITH {_MONTHLY_SQL},
    b AS (SELECT scheme_code, CAST(year_month AS DATE) AS best_month, (ROUND(monthly_return, 6) + CAST(0 AS DOUBLE)) AS best_return,
                 ROW_NUMBER() OVER (PARTITION BY scheme_code ORDER BY monthly_return DESC, year_month) AS rn
          FROM monthly WHERE monthly_return IS NOT NULL),
    w AS (SELECT scheme_code, CAST(year_month AS DATE) AS worst_month, (ROUND(monthly_return, 6) + CAST(0 AS DOUBLE)) AS worst_return,
                 ROW_NUMBER() OVER (PARTITION BY scheme_code ORDER BY monthly_return ASC, year_month) AS rn
          FROM monthly WHERE monthly_return IS NOT NULL)
    SELECT b.scheme_code, best_month, best_return, worst_month, worst_return
    FROM b JOIN w ON b.scheme_code = w.scheme_code AND b.rn = 1 AND w.rn = 1""",
)
def q_best_worst_month(spark, sf_dir):
    return r6(P.best_worst_month(_monthly(spark, sf_dir)), ["best_return", "worst_return"])


@register(
    "month_quartiles",
    f"""WITH {_MONTHLY_SQL},
    q AS (SELECT scheme_code, month, quantile_cont(monthly_return, 0.25) AS q1,
                 quantile_cont(monthly_return, 0.5) AS median, quantile_cont(monthly_return, 0.75) AS q3
          FROM monthly WHERE monthly_return IS NOT NULL GROUP BY 1, 2),
    q2 AS (SELECT *, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q),
    wh AS (SELECT m.scheme_code, m.month,
                  MIN(CASE WHEN monthly_return >= lo THEN monthly_return END) AS whisker_low,
                  MAX(CASE WHEN monthly_return <= hi THEN monthly_return END) AS whisker_high,
                  COUNT(*) FILTER (WHERE monthly_return < lo OR monthly_return > hi) AS outliers
           FROM monthly m JOIN q2 USING (scheme_code, month) WHERE monthly_return IS NOT NULL GROUP BY 1, 2)
    SELECT scheme_code, month, (ROUND(q1, 6) + CAST(0 AS DOUBLE)) AS q1, (ROUND(median, 6) + CAST(0 AS DOUBLE)) AS median, (ROUND(q3, 6) + CAST(0 AS DOUBLE)) AS q3,
           (ROUND(iqr, 6) + CAST(0 AS DOUBLE)) AS iqr, (ROUND(whisker_low, 6) + CAST(0 AS DOUBLE)) AS whisker_low, (ROUND(whisker_high, 6) + CAST(0 AS DOUBLE)) AS whisker_high,
           outliers, strftime(make_date(2000, month, 1), '%b') AS month_abbr
    FROM q2 JOIN wh USING (scheme_code, month)""",
)
def q_month_quartiles(spark, sf_dir):
    return r6(P.month_quartiles(_monthly(spark, sf_dir)), ["q1", "median", "q3", "iqr", "whisker_low", "whisker_high"])


_MONTH_COLS = ",\n".join(
    f"""(round_even(CASE WHEN COUNT(*) FILTER (WHERE month(date) = {i}) > 0
           THEN (COALESCE(PRODUCT(1 + r) FILTER (WHERE month(date) = {i}), 1.0) - 1) * 100 END, 2) + CAST(0 AS DOUBLE)) AS "{m}" """
    for i, m in enumerate(P.MONTH_ABBR, start=1)
)


@register(
    "calendar_return_table",
    f"""WITH d AS ({S.DAILY_SQL}), x AS (SELECT *, nav / LAG(nav) OVER ({_W}) - 1 AS r FROM d)
    SELECT scheme_code, CAST(year(date) AS INTEGER) AS year, {_MONTH_COLS},
           (round_even((arg_max(nav, date) / arg_min(nav, date) - 1) * 100, 2) + CAST(0 AS DOUBLE)) AS "YTD"
    FROM x GROUP BY 1, 2""",
)
def q_calendar_return_table(spark, sf_dir):
    return P.calendar_return_table(S.daily(spark, sf_dir))


@register(
    "return_histogram",
    f"""WITH d AS ({S.DAILY_SQL}), x AS (SELECT scheme_code, nav / LAG(nav) OVER ({_W}) - 1 AS v FROM d),
    y AS (SELECT * FROM x WHERE v IS NOT NULL AND NOT isnan(v) AND abs(v) < 'inf'::DOUBLE),
    rg AS (SELECT scheme_code, MIN(v) AS mn, MAX(v) AS mx, AVG(v) AS mean FROM y GROUP BY 1),
    rg2 AS (SELECT *, CASE WHEN mn = mx THEN mn - 0.5 ELSE mn END AS lo, CASE WHEN mn = mx THEN mx + 0.5 ELSE mx END AS hi FROM rg),
    b AS (SELECT y.scheme_code, lo, hi, mean,
                 LEAST(CAST(FLOOR((v - lo) * 50 / (hi - lo)) AS INTEGER) + 1, 50) AS bin FROM y JOIN rg2 USING (scheme_code))
    SELECT g.scheme_code, CAST(n.bin AS INTEGER) AS bin, (ROUND(lo + (n.bin - 1) * ((hi - lo) / 50), 6) + CAST(0 AS DOUBLE)) AS bin_low, (ROUND(lo + n.bin * ((hi - lo) / 50), 6) + CAST(0 AS DOUBLE)) AS bin_high,
           (SELECT COUNT(*) FROM b WHERE b.scheme_code = g.scheme_code AND b.bin = n.bin) AS count, (ROUND(mean, 6) + CAST(0 AS DOUBLE)) AS mean
    FROM rg2 g CROSS JOIN (SELECT UNNEST(generate_series(1, 50)) AS bin) n""",
)
def q_return_histogram(spark, sf_dir):
    rets = T.period_returns(S.daily(spark, sf_dir))
    return r6(P.return_histogram(rets), ["bin_low", "bin_high", "mean"])


# --------------------------------------------------------------------------
# Coverage (orders per customer) and search (part)
# --------------------------------------------------------------------------


@register(
    "coverage",
    f"""SELECT scheme_code, MIN(date) AS first_date, MAX(date) AS last_date, COUNT(*) AS data_points
    FROM ({S.ORDERS_SERIES_SQL}) WHERE scheme_code IS NOT NULL GROUP BY 1""",
)
def q_coverage(spark, sf_dir):
    return P.coverage(S.orders_series(spark, sf_dir))


@register(
    "top_coverage",
    f"""SELECT scheme_code, MIN(date) AS first_date, MAX(date) AS last_date, COUNT(*) AS data_points
    FROM ({S.ORDERS_SERIES_SQL}) WHERE scheme_code IS NOT NULL GROUP BY 1
    ORDER BY data_points DESC, scheme_code LIMIT 1""",
)
def q_top_coverage(spark, sf_dir):
    return P.top_coverage(P.coverage(S.orders_series(spark, sf_dir)))


# Search levels on part: p_name as the scheme name, p_type as the category,
# p_brand as the fund house. Level 1 finds nothing on the test data, so the
# fallback to level 2 is exercised.
_SEARCH_LEVELS_SQL = [
    "regexp_matches(p_brand, '(?i)flexi.*cap')",
    "(regexp_matches(p_type, '(?i)promo|economy') AND regexp_matches(p_name, '(?i)red.*(widget|gear)'))"
    " OR regexp_matches(p_name, '(?i)^hot gizmo')",
    "regexp_matches(p_name, '(?i)gizmo')",
]


@register(
    "scheme_search",
    f"""WITH t AS (SELECT p_partkey, p_name, p_brand, p_type,
                   CASE WHEN {_SEARCH_LEVELS_SQL[0]} THEN 1 WHEN {_SEARCH_LEVELS_SQL[1]} THEN 2
                        WHEN {_SEARCH_LEVELS_SQL[2]} THEN 3 END AS match_level FROM part)
    SELECT DISTINCT * FROM t WHERE match_level = (SELECT MIN(match_level) FROM t)""",
)
def q_scheme_search(spark, sf_dir):
    from fundspark.functions.text import regex_search as rx

    levels = [
        rx("p_brand", "flexi.*cap"),
        (rx("p_type", "promo|economy") & rx("p_name", "red.*(widget|gear)")) | rx("p_name", "^hot gizmo"),
        rx("p_name", "gizmo"),
    ]
    return P.scheme_search(S.table(spark, sf_dir, "part"), levels, ["p_partkey", "p_name", "p_brand", "p_type"])

@register(
    "first_keys",
    f"SELECT DISTINCT s_nationkey, s_name FROM supplier ORDER BY s_nationkey, s_name LIMIT 10",
)
def q_first_keys(spark, sf_dir):
    return P.first_keys(S.table(spark, sf_dir, "supplier"), ["s_nationkey", "s_name"], 10)
