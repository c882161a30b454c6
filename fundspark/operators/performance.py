"""Fund performance for every instrument at once.

KPIs, peers, monthly and calendar returns, histogram and coverage. The
per-key window pass (returns, running max) shuffles once on the key; the
following ``groupBy(key, ...)`` reuses that hash partitioning, so a KPI
table costs one exchange. Peer figures run on one row per fund.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fundspark.functions.text import ellipsis
from fundspark.operators.ranking import value_ranks
from fundspark.operators.series import TRADING_DAYS, _running, missing_as_null, pct_change

# Fixed values of the fund analysis.
DAYS_PER_YEAR = 365.25
RISK_FREE_RATE = 0.06
LUMP_SUM = 100000.0
MIN_PEER_ROWS = TRADING_DAYS  # peers need more than one year of rows
TOP_PEERS = 5
NAME_WIDTH = 50
HIST_BINS = 50
MONTH_ABBR = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]
RISK_HIGH, RISK_MEDIUM = 0.25, 0.15
SHARPE_EXCELLENT, SHARPE_GOOD = 1.0, 0.5
CAGR_EXCELLENT, CAGR_GOOD = 0.15, 0.10


def _first_non_null(value: str, order: str) -> Column:
    v = missing_as_null(value)
    return F.min_by(v, F.when(v.isNotNull(), F.col(order)))


def _last_non_null(value: str, order: str) -> Column:
    v = missing_as_null(value)
    return F.max_by(v, F.when(v.isNotNull(), F.col(order)))


def _finite(c: Column) -> Column:
    return F.when(~F.isnan(c) & (F.abs(c) < F.lit(math.inf)), c)


def fund_kpis(
    series: DataFrame,
    key: str = "scheme_code",
    order: str = "date",
    value: str = "nav",
    risk_free: float = RISK_FREE_RATE,
    trading_days: int = TRADING_DAYS,
) -> DataFrame:
    """One row of KPIs per key.

    start/end value are the first and last rows in date order; CAGR needs
    a positive span (else NULL); volatility = sample std of daily returns x
    sqrt(trading_days); Sharpe and return per risk are 0 when volatility is
    not positive or NULL.
    """
    x = series.select(key, order, value).withColumns(
        {
            "_ret": pct_change(value, key, order),
            "_cummax": F.max(missing_as_null(value)).over(_running(key, order)),
        }
    )
    kpi = x.groupBy(key).agg(
        F.min_by(value, order).alias("start_nav"),
        F.max_by(value, order).alias("end_nav"),
        F.min(order).alias("start_date"),
        F.max(order).alias("end_date"),
        F.count(F.lit(1)).alias("data_points"),
        F.stddev_samp(_finite(F.col("_ret"))).alias("daily_std"),
        F.min(F.try_divide(missing_as_null(value), F.col("_cummax")) - 1).alias("max_drawdown"),
    )
    # one projection for every derived figure (each expression refers only to aggregate columns)
    days = F.datediff("end_date", "start_date")
    years = days / F.lit(DAYS_PER_YEAR)
    multiple = F.try_divide(F.col("end_nav"), F.col("start_nav"))
    cagr = _finite(F.when(years > 0, F.pow(multiple, 1 / years) - 1))
    vol = F.col("daily_std") * F.lit(math.sqrt(trading_days))
    good_vol = F.coalesce((vol > 0) & ~F.isnan(vol), F.lit(False))
    return kpi.select(
        "*",
        days.alias("days"),
        years.alias("years"),
        multiple.alias("growth_multiple"),
        ((multiple - 1) * 100).alias("total_return_pct"),
        cagr.alias("cagr"),
        vol.alias("volatility"),
        F.when(good_vol, (cagr - risk_free) / vol).otherwise(F.lit(0.0)).alias("sharpe_ratio"),
        F.when(good_vol, cagr / vol).otherwise(F.lit(0.0)).alias("return_per_risk"),
    )


def risk_labels(kpis: DataFrame) -> DataFrame:
    """Risk level from volatility, ratings from Sharpe ratio and CAGR (fixed bands)."""
    vol, sharpe, cagr = F.col("volatility"), F.col("sharpe_ratio"), F.col("cagr")
    return kpis.withColumns(
        {
            "risk_level": F.when(vol > RISK_HIGH, "High").when(vol > RISK_MEDIUM, "Medium").otherwise("Low"),
            "sharpe_rating": F.when(sharpe > SHARPE_EXCELLENT, "Excellent")
            .when(sharpe > SHARPE_GOOD, "Good")
            .otherwise("Average"),
            "performance_rating": F.when(cagr > CAGR_EXCELLENT, "Excellent")
            .when(cagr > CAGR_GOOD, "Good")
            .otherwise("Average"),
        }
    )


def lump_sum(kpis: DataFrame, amount: float = LUMP_SUM) -> DataFrame:
    """Value of ``amount`` invested at the first row and held to the last, and the gain."""
    final = F.lit(float(amount)) * F.col("growth_multiple")
    return kpis.withColumns({"amount": F.lit(float(amount)), "final_value": final, "gain": final - F.lit(float(amount))})


def kpi_record(kpis: DataFrame, key: str = "scheme_code", info: DataFrame | None = None) -> DataFrame:
    """The KPI export as one JSON text per fund (percent figures as in the report).

    With ``info`` (key, scheme_name, amc_name, scheme_category) the record
    also names the fund, its AMC and category.
    """
    if info is not None:
        kpis = kpis.join(info.select(key, "scheme_name", "amc_name", "scheme_category"), key, "left")
    named = [
        F.col("scheme_name").alias("fund_name"),
        F.col("amc_name"),
        F.col("scheme_category").alias("category"),
    ] if info is not None else []
    rec = F.struct(
        *named,
        F.concat_ws(" to ", F.col("start_date").cast("string"), F.col("end_date").cast("string")).alias("analysis_period"),
        F.col("years").alias("duration_years"),
        F.col("total_return_pct"),
        (F.col("cagr") * 100).alias("cagr_pct"),
        (F.col("volatility") * 100).alias("volatility_pct"),
        F.col("sharpe_ratio"),
        (F.col("max_drawdown") * 100).alias("max_drawdown_pct"),
        F.col("start_nav"),
        F.col("end_nav"),
        F.col("growth_multiple"),
        F.col("data_points"),
    )
    return kpis.select(key, F.to_json(rec).alias("record"))


# --------------------------------------------------------------------------
# Peers
# --------------------------------------------------------------------------


def peer_comparison(
    kpis: DataFrame,
    info: DataFrame,
    key: str = "scheme_code",
    category: str = "scheme_category",
    min_rows: int = MIN_PEER_ROWS,
) -> DataFrame:
    """Each fund against every other eligible fund of its category.

    Eligible peers have more than ``min_rows`` rows and a positive span.
    Mean, best and worst peer CAGR exclude the fund itself; rank =
    1 + peers with a higher CAGR; percentile = (total - rank + 1) / total x 100
    with total = peers + 1. Funds without a peer get no row.
    Everything about the peers comes from one table of the distinct values
    of each category (``ranking.value_ranks``): ranks are sums of prefix
    counts over ranges of values, best and worst peers are its ends. No task
    holds a category, and nothing is run or kept while the query is built.
    """
    f = kpis.select(key, "cagr", "data_points", "years").join(info.select(key, category), key, "inner")
    elig = (F.col("data_points") > min_rows) & (F.col("years") > 0) & F.col("cagr").isNotNull()
    # a missing category equals no other category: such funds have no peers
    f = f.filter(F.col("cagr").isNotNull() & F.col(category).isNotNull())
    f = f.select(key, category, "cagr", elig.cast("int").alias("_elig"))
    ranks = value_ranks(f, [category], "cagr", weight="_elig")
    held, v = F.col("_n") > 0, F.col("cagr")
    below = F.col("_total") - F.col("_above") - F.col("_n")
    ends = ranks.groupBy(category).agg(
        F.max("_total").alias("_count"),
        F.sum(v * F.col("_n")).alias("_sum"),
        F.max(F.when(held, v)).alias("_max1"),
        F.min(F.when(held, v)).alias("_min1"),
        F.max(F.when(held & (F.col("_above") > 0), v)).alias("_max2"),
        F.min(F.when(held & (below > 0), v)).alias("_min2"),
        F.sum(F.when(F.col("_above") == 0, F.col("_n"))).alias("_nmax"),
        F.sum(F.when(below == 0, F.col("_n"))).alias("_nmin"),
    )
    x = f.join(ranks.select(category, "cagr", "_above"), [category, "cagr"]).join(ends, category)
    me = F.col("_elig") == 1
    peers = F.col("_count") - F.when(me, 1).otherwise(0)
    only_max = me & (F.col("cagr") == F.col("_max1")) & (F.col("_nmax") == 1)
    only_min = me & (F.col("cagr") == F.col("_min1")) & (F.col("_nmin") == 1)
    rank = F.col("_above") + 1
    total = F.col("peer_count") + 1
    return (
        x.withColumn("peer_count", peers.cast("bigint"))
        .filter(F.col("peer_count") > 0)
        .select(
            key,
            category,
            (F.col("cagr") * 100).alias("cagr_pct"),
            "peer_count",
            ((F.col("_sum") - F.when(me, F.col("cagr")).otherwise(0.0)) / F.col("peer_count") * 100).alias("peer_avg_cagr_pct"),
            (F.when(only_max, F.col("_max2")).otherwise(F.col("_max1")) * 100).alias("peer_best_cagr_pct"),
            (F.when(only_min, F.col("_min2")).otherwise(F.col("_min1")) * 100).alias("peer_worst_cagr_pct"),
            rank.alias("peer_rank"),
            total.alias("total_funds"),
            ((total - rank + 1) / total * 100).alias("percentile"),
        )
    )


def top_peers(
    kpis: DataFrame,
    info: DataFrame,
    key: str = "scheme_code",
    category: str = "scheme_category",
    name: str = "scheme_name",
    n: int = TOP_PEERS,
    min_rows: int = MIN_PEER_ROWS,
) -> DataFrame:
    """Best ``n`` eligible funds by CAGR per category (ties by key), names cut at 50 characters.

    ``row_number() <= n`` lets Spark insert a group limit before the shuffle,
    so each map task sends at most ``n`` rows per category.
    """
    f = kpis.filter((F.col("data_points") > min_rows) & (F.col("years") > 0) & F.col("cagr").isNotNull())
    f = f.select(key, "cagr").join(info.select(key, category, name).filter(F.col(category).isNotNull()), key, "inner")
    w = Window.partitionBy(category).orderBy(F.col("cagr").desc(), F.col(key).asc())
    return (
        f.withColumn("position", F.row_number().over(w))
        .filter(F.col("position") <= n)
        .select(category, "position", key, ellipsis(name, NAME_WIDTH).alias("scheme_name_short"), (F.col("cagr") * 100).alias("cagr_pct"))
    )


def best_peers(
    kpis: DataFrame,
    info: DataFrame,
    key: str = "scheme_code",
    category: str = "scheme_category",
    name: str = "scheme_name",
    n: int = TOP_PEERS,
    min_rows: int = MIN_PEER_ROWS,
) -> DataFrame:
    """Best ``n`` eligible peers of every fund of the category, the fund itself left out.

    ``n + 1`` funds of each category are enough to list any fund's peers, so every fund meets
    that many rows: the join gives at most ``n + 1`` rows a fund, however large the category.
    Funds without a category or without a peer get no row.
    """
    best = top_peers(kpis, info, key, category, name, n + 1, min_rows)
    best = best.select(
        category, F.col("position").alias("_at"), F.col(key).alias("peer_code"),
        F.col("scheme_name_short").alias("peer_name_short"), "cagr_pct",
    )
    funds = info.filter(F.col(category).isNotNull()).select(key, category)
    others = funds.join(best, category).filter(F.col("peer_code") != F.col(key))
    place = F.row_number().over(Window.partitionBy(key).orderBy("_at"))
    return (
        others.withColumn("position", place)
        .filter(F.col("position") <= n)
        .select(key, "position", "peer_code", "peer_name_short", "cagr_pct")
    )


# --------------------------------------------------------------------------
# Months and calendar
# --------------------------------------------------------------------------


def monthly_returns(series: DataFrame, key: str = "scheme_code", order: str = "date", value: str = "nav") -> DataFrame:
    """First-to-last return inside each calendar month (first/last non-null value), in percent."""
    m = series.groupBy(key, F.trunc(order, "MM").alias("year_month")).agg(
        _first_non_null(value, order).alias("nav_start"),
        _last_non_null(value, order).alias("nav_end"),
        F.min(order).alias("date_start"),
        F.max(order).alias("date_end"),
    )
    return m.withColumns(
        {
            "monthly_return": (F.try_divide(F.col("nav_end"), F.col("nav_start")) - 1) * 100,
            "month": F.month("date_start"),
            "year": F.year("date_start"),
        }
    )


def _month_name(month: Column, pattern: str = "MMMM") -> Column:
    return F.date_format(F.make_date(F.lit(2000), month, F.lit(1)), pattern)


def seasonality(monthly: DataFrame, key: str = "scheme_code") -> DataFrame:
    """Mean, sample std and count of monthly returns per calendar month."""
    return (
        monthly.groupBy(key, "month")
        .agg(
            F.avg("monthly_return").alias("mean"),
            F.stddev_samp("monthly_return").alias("std"),
            F.count("monthly_return").alias("count"),
        )
        .withColumn("month_name", _month_name(F.col("month")))
    )


def best_worst_month(monthly: DataFrame, key: str = "scheme_code") -> DataFrame:
    """Month with the highest and the lowest return per key; ties go to the earliest month."""
    r, ym = F.col("monthly_return"), F.col("year_month")
    return (
        monthly.filter(r.isNotNull() & ~F.isnan(r))
        .groupBy(key)
        .agg(
            F.min_by(ym, F.struct(-r, ym)).alias("best_month"),
            F.max(r).alias("best_return"),
            F.min_by(ym, F.struct(r, ym)).alias("worst_month"),
            F.min(r).alias("worst_return"),
        )
    )


def month_quartiles(monthly: DataFrame, key: str = "scheme_code") -> DataFrame:
    """Box-plot figures of monthly returns per calendar month.

    Quartiles by linear interpolation; whiskers are the most extreme
    returns within 1.5 IQR of the quartiles. Quartiles are window
    aggregates over (key, month) -- one value per year, so a small bounded
    partition -- and the whiskers aggregate on the same partitioning: one
    pass over the monthly table, no join back.
    """
    r = F.col("monthly_return")
    w = Window.partitionBy(key, "month")
    x = monthly.filter(r.isNotNull()).select(
        key,
        "month",
        r,
        F.percentile(r, 0.25).over(w).alias("q1"),
        F.percentile(r, 0.5).over(w).alias("median"),
        F.percentile(r, 0.75).over(w).alias("q3"),
    )
    iqr = F.col("q3") - F.col("q1")
    lo = F.col("q1") - 1.5 * iqr
    hi = F.col("q3") + 1.5 * iqr
    return (
        x.groupBy(key, "month", "q1", "median", "q3")
        .agg(
            F.min(F.when(r >= lo, r)).alias("whisker_low"),
            F.max(F.when(r <= hi, r)).alias("whisker_high"),
            F.count_if((r < lo) | (r > hi)).alias("outliers"),
        )
        .withColumn("iqr", F.col("q3") - F.col("q1"))
        .withColumn("month_abbr", _month_name(F.col("month"), "MMM"))
    )


def calendar_return_table(
    series: DataFrame, key: str = "scheme_code", order: str = "date", value: str = "nav", digits: int = 2
) -> DataFrame:
    """Year x month table of compounded daily returns plus YTD, in percent, rounded half to even.

    A month is prod(1 + daily return) - 1 over its rows (returns run across
    month ends; a month whose returns are all NULL gives 0; a month without
    rows stays NULL). YTD is last / first value of the year - 1. One
    conditional aggregate per month: a single groupBy, no pivot job.
    """
    x = series.select(key, order, value, pct_change(value, key, order).alias("_r"))
    mon = F.month(order)
    aggs = []
    for i, name in enumerate(MONTH_ABBR, start=1):
        inside = mon == i
        comp = F.coalesce(F.product(F.when(inside, 1 + F.col("_r"))), F.lit(1.0)) - 1
        aggs.append(F.bround(F.when(F.count_if(inside) > 0, comp * 100), digits).alias(name))
    ytd = F.try_divide(F.max_by(value, order), F.min_by(value, order)) - 1
    aggs.append(F.bround(ytd * 100, digits).alias("YTD"))
    return x.groupBy(key, F.year(order).alias("year")).agg(*aggs)


def return_histogram(
    returns: DataFrame, key: str = "scheme_code", ret: str = "perc_return", bins: int = HIST_BINS
) -> DataFrame:
    """Equal-width histogram of finite returns per key (the last bin is closed), with the mean.

    A key whose returns are all equal spans value +- 0.5, as numpy does.
    Range and mean are window aggregates over the key (one instrument's
    returns, the partitioning the returns already have), so the table is
    read once and binned counts aggregate without another shuffle. All bins
    are listed, empty ones with a count of zero.
    """
    r = _finite(F.col(ret))
    w = Window.partitionBy(key)
    x = returns.select(key, r.alias("_x")).filter(F.col("_x").isNotNull())
    mn, mx = F.min("_x").over(w), F.max("_x").over(w)
    same = mn == mx
    low = F.when(same, mn - 0.5).otherwise(mn)
    high = F.when(same, mx + 0.5).otherwise(mx)
    x = x.select(key, "_x", low.alias("range_low"), high.alias("range_high"), F.avg("_x").over(w).alias("mean"))
    b = F.floor((F.col("_x") - F.col("range_low")) * bins / (F.col("range_high") - F.col("range_low"))).cast("int") + 1
    width = (F.col("range_high") - F.col("range_low")) / bins
    counted = x.groupBy(key, "range_low", "range_high", "mean", F.least(b, F.lit(bins)).alias("b")).agg(F.count(F.lit(1)).alias("n"))
    # At most ``bins`` entries per key: empty bins are listed with a count of zero.
    held = counted.groupBy(key, "range_low", "range_high", "mean").agg(
        F.map_from_entries(F.collect_list(F.struct("b", "n"))).alias("held")
    )
    return (
        held.withColumn("bin", F.explode(F.sequence(F.lit(1), F.lit(bins))))
        .withColumn("count", F.coalesce(F.try_element_at("held", F.col("bin")), F.lit(0).cast("long")))
        .select(
            key,
            "bin",
            (F.col("range_low") + (F.col("bin") - 1) * width).alias("bin_low"),
            (F.col("range_low") + F.col("bin") * width).alias("bin_high"),
            "count",
            "mean",
        )
    )


# --------------------------------------------------------------------------
# Coverage and search
# --------------------------------------------------------------------------


def coverage(series: DataFrame, key: str = "scheme_code", order: str = "date", extra: Sequence[str] = ()) -> DataFrame:
    """First and last date and the number of rows per key (and ``extra`` columns)."""
    return (
        series.filter(F.col(key).isNotNull())
        .groupBy(key, *extra)
        .agg(F.min(order).alias("first_date"), F.max(order).alias("last_date"), F.count(F.lit(1)).alias("data_points"))
    )


def top_coverage(cov: DataFrame, key: str = "scheme_code", n: int = 1) -> DataFrame:
    """The ``n`` keys with most rows (ties by key): a per-partition top-n, then a merge."""
    return cov.orderBy(F.col("data_points").desc(), F.col(key).asc()).limit(n)


def scheme_search(df: DataFrame, levels: Sequence[Column], columns: Sequence[str]) -> DataFrame:
    """Fallback search: a level is used only when every earlier level found nothing.

    ``levels`` are boolean conditions, e.g. built with ``regex_search``
    (case-insensitive, NULL never matches) and combined with ``&`` / ``|``.
    One scan tags each row with its first matching level; the smallest
    level found comes from a scalar subquery, and the rows at that level are
    returned distinct over ``columns``.
    """
    level = F.lit(None).cast("int")
    for i in reversed(range(len(levels))):
        level = F.when(F.coalesce(levels[i], F.lit(False)), F.lit(i + 1)).otherwise(level)
    tagged = df.select(*columns, level.alias("match_level")).filter(F.col("match_level").isNotNull())
    best = tagged.agg(F.min("match_level")).scalar()
    return tagged.filter(F.col("match_level") == best).distinct()


def first_keys(df: DataFrame, columns: Sequence[str], n: int = 10, order: Sequence[str] | None = None) -> DataFrame:
    """The first ``n`` distinct rows over ``columns`` in a stated order (a per-partition top-n, then a merge)."""
    order = list(order or columns)
    return df.select(*columns).distinct().orderBy(*[F.col(c).asc_nulls_last() for c in order]).limit(n)


def sample_rows(df: DataFrame, fraction: float, seed: int = 42) -> DataFrame:
    """A Bernoulli sample with a fixed seed: each partition samples on its own, nothing is sorted."""
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)
