"""Series operators against plain pandas restatements of the same rules, on random series."""

import datetime as dt
import math

import numpy as np
import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from fundspark.operators import performance as P
from fundspark.operators import series as T

values = st.lists(
    st.one_of(st.none(), st.floats(min_value=0.5, max_value=1000, allow_nan=False)), min_size=1, max_size=40
)
SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def _frame(spark, navs_by_key):
    rows = []
    for k, navs in navs_by_key.items():
        for i, v in enumerate(navs):
            rows.append((k, dt.date(2020, 1, 1) + dt.timedelta(days=3 * i), v))
    return spark.createDataFrame(rows, "scheme_code string, date date, nav double"), rows


def _close(a, b):
    if a is None or (isinstance(a, float) and math.isnan(a)):
        return b is None or (isinstance(b, float) and math.isnan(b))
    return b is not None and abs(a - b) <= 1e-9 * max(1.0, abs(a))


@SETTINGS
@given(st.dictionaries(st.sampled_from(["a", "b", "c"]), values, min_size=1))
def test_returns_fill_drawdown_match_pandas(spark, navs_by_key):
    df, rows = _frame(spark, navs_by_key)
    pdf = pd.DataFrame(rows, columns=["scheme_code", "date", "nav"]).sort_values(["scheme_code", "date"])
    pdf["nav"] = pdf["nav"].astype(float)
    g = pdf.groupby("scheme_code")["nav"]
    filled = g.ffill()
    prev = filled.groupby(pdf["scheme_code"]).shift(1)
    ret = (filled / prev - 1).where(prev != 0)  # zero base -> NULL (documented change)
    cummax = g.cummax()
    expected = {
        (r.scheme_code, r.date): (f, rt, dd)
        for r, f, rt, dd in zip(pdf.itertuples(), filled, ret, pdf["nav"] / cummax - 1)
    }
    got = T.drawdown_series(T.period_returns(T.forward_fill(df)))
    for r in got.collect():
        f, rt, dd = expected[(r.scheme_code, r.date)]
        assert _close(None if pd.isna(f) else f, r.nav_filled)
        assert _close(None if pd.isna(rt) else float(rt), r.perc_return)
        assert _close(None if pd.isna(dd) else float(dd), r.drawdown)


@SETTINGS
@given(st.dictionaries(st.sampled_from(["a", "b"]), st.lists(st.floats(min_value=1, max_value=100, allow_nan=False), min_size=2, max_size=30), min_size=1))
def test_kpis_match_their_definitions(spark, navs_by_key):
    """Growth, spread of the daily returns and deepest fall, each worked out by a loop over the series."""
    df, rows = _frame(spark, navs_by_key)
    got = {r.scheme_code: r for r in P.fund_kpis(df).collect()}
    for k, navs in navs_by_key.items():
        r = got[k]
        assert r.data_points == len(navs)
        # compounding at the rate log(last / first) / years turns the first value into the last
        years = (rows_last(rows, k) - rows_first(rows, k)).days / 365.25
        rate = (math.log(navs[-1]) - math.log(navs[0])) / years
        assert math.isclose(1 + r.cagr, math.exp(rate), rel_tol=1e-9, abs_tol=1e-12)
        high, deepest, returns = navs[0], 0.0, []
        for before, now in zip([None, *navs], navs):
            high = max(high, now)
            deepest = min(deepest, (now - high) / high)
            if before is not None:
                returns.append((now - before) / before)
        assert _close(deepest, r.max_drawdown)
        if len(returns) < 2:
            assert r.volatility is None
            continue
        mean = sum(returns) / len(returns)
        spread = sum((x - mean) ** 2 for x in returns) / (len(returns) - 1)
        assert math.isclose(r.volatility**2, 252 * spread, rel_tol=1e-6, abs_tol=1e-12)
        # excess growth per unit of spread; none without spread
        assert math.isclose(r.sharpe_ratio * r.volatility, r.cagr - 0.06 if r.volatility > 0 else 0.0, rel_tol=1e-9, abs_tol=1e-9)


def rows_first(rows, key):
    return min(d for k, d, _ in rows if k == key)


def rows_last(rows, key):
    return max(d for k, d, _ in rows if k == key)


@SETTINGS
@given(st.lists(st.floats(min_value=1, max_value=100, allow_nan=False), min_size=2, max_size=80))
def test_compounded_months_multiply_to_year(spark, navs):
    rows = [("k", dt.date(2021, 1, 1) + dt.timedelta(days=4 * i), v) for i, v in enumerate(navs)]
    df = spark.createDataFrame(rows, "scheme_code string, date date, nav double")
    cal = P.calendar_return_table(df, digits=12).collect()
    # the product of compounded months in a year equals last / previous year's last, chained
    pdf = pd.DataFrame(rows, columns=["k", "date", "nav"])
    pdf["r"] = pdf["nav"].pct_change()
    pdf["year"] = [d.year for d in pdf["date"]]
    for row in cal:
        months = [row[m] for m in P.MONTH_ABBR if row[m] is not None]
        total = np.prod([1 + m / 100 for m in months]) - 1
        exp = (1 + pdf[pdf.year == row.year]["r"].fillna(0)).prod() - 1
        assert abs(total - exp) < 1e-6


# --------------------------------------------------------------------------
# Master merge: the three-way rule restated in plain Python
# --------------------------------------------------------------------------

keys = st.one_of(st.none(), st.sampled_from(["a", "b", "c", "d", "e"]))


def _merge_rule(existing, latest, today):
    """New keys added, keys in both updated (first seen kept), missing keys made inactive."""
    e_keys = {r[0] for r in existing}
    l_keys = {r[0] for r in latest}
    out = []
    for k, attr, launch in latest:
        if k not in e_keys:
            out.append((k, attr, launch, launch or today, today, True, today))
    for k, attr, launch, first, last, active, upd in existing:
        if k in l_keys:
            for k2, attr2, launch2 in latest:
                if k2 == k:
                    out.append((k, attr2, launch2, first, today, True, today))
        else:
            out.append((k, attr, launch, first, last, False, upd))
    return sorted(out, key=repr)


@SETTINGS
@given(
    st.lists(st.tuples(keys, st.sampled_from(["x", "y"]), st.sampled_from([None, dt.date(2020, 1, 5)])), max_size=8),
    st.lists(st.tuples(keys, st.sampled_from(["p", "q"]), st.sampled_from([None, dt.date(2021, 3, 1)])), max_size=8),
)
def test_merge_master_matches_rule(spark, old, new):
    from fundspark.operators import master as M

    today = dt.date(2022, 6, 1)
    existing = [(k, a, l, dt.date(2019, 1, 1), dt.date(2020, 1, 1), True, dt.date(2020, 1, 1)) for k, a, l in old]
    schema_e = ("scheme_code string, attr string, launch_date date, first_seen_date date, last_seen_date date, "
                "is_active boolean, attribute_last_updated date")
    e = spark.createDataFrame(existing, schema_e)
    lt = spark.createDataFrame(new, "scheme_code string, attr string, launch_date date")
    got = sorted((tuple(r) for r in M.merge_master(e, lt, "2022-06-01").collect()), key=repr)
    assert got == _merge_rule(existing, new, today)


# --------------------------------------------------------------------------
# Category levels and plan flags: the rules restated in plain Python
# --------------------------------------------------------------------------

FRAGMENTS = ["Equity", "equity", "Debt", "Hybrid", "Other", "Others", "Growth", " - ", " - ", "na", "error",
             "Fund", " ", "Direct", "dir ", "(gr)", "IDCW", "Income", "Plan", "-", "Accum"]
texts = st.one_of(st.none(), st.lists(st.sampled_from(FRAGMENTS), max_size=6).map("".join))


def _levels_rule(cat):
    from fundspark.operators.metadata import LEVEL1_RULES

    text = cat or ""
    has_sep = " - " in text
    parts = text.split(" - ", 1)
    head = parts[0].strip()
    l1 = "Others"
    if head:
        for kw, label in LEVEL1_RULES:
            if kw in head.lower():
                l1 = label
                break
    if has_sep:
        tail = parts[1].strip()
        l2 = l1 if tail in ("", "error", "null", "na") else tail
    else:
        l2 = cat if cat is not None else "Others"
    return l1, l2


def _flags_rule(name):
    from fundspark.operators.metadata import DIRECT_LITERALS, GROWTH_LITERALS, NON_GROWTH_LITERALS

    low = (name or "").lower()
    return (any(x in low for x in DIRECT_LITERALS),
            any(x in low for x in GROWTH_LITERALS) and not any(x in low for x in NON_GROWTH_LITERALS))


@SETTINGS
@given(st.lists(texts, min_size=1, max_size=20))
def test_levels_and_flags_match_rules(spark, values):
    from fundspark.operators import metadata as MD

    df = spark.createDataFrame([(i, v, v) for i, v in enumerate(values)], "i int, scheme_category string, scheme_nav_name string")
    got = {r.i: r for r in MD.plan_flags(MD.category_levels(df)).collect()}
    for i, v in enumerate(values):
        r = got[i]
        assert (r.scheme_category_level1, r.scheme_category_level2) == _levels_rule(v), v
        assert (r.is_direct, r.is_growth_plan) == _flags_rule(v), v


# --------------------------------------------------------------------------
# Laws: chunks tile the range; drawdown is never positive
# --------------------------------------------------------------------------


@SETTINGS
@given(st.dates(min_value=dt.date(2000, 1, 1), max_value=dt.date(2030, 1, 1)), st.integers(0, 400), st.integers(1, 120))
def test_chunks_tile_the_range(spark, start, span, days):
    from fundspark.operators import calendar as C

    end = start + dt.timedelta(days=span)
    rows = C.chunk_plan(spark, start, end, days=days).orderBy("chunk_no").collect()
    covered = []
    for r in rows:
        assert r.chunk_start <= r.chunk_end and (r.chunk_end - r.chunk_start).days < days
        covered += [r.chunk_start + dt.timedelta(days=i) for i in range((r.chunk_end - r.chunk_start).days + 1)]
    assert covered == [start + dt.timedelta(days=i) for i in range(span + 1)]  # every day once, in order


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.floats(min_value=0.01, max_value=1e6, allow_nan=False)), min_size=1, max_size=50))
def test_drawdown_never_positive(spark, navs):
    rows = [("k", dt.date(2020, 1, 1) + dt.timedelta(days=i), v) for i, v in enumerate(navs)]
    df = spark.createDataFrame(rows, "scheme_code string, date date, nav double")
    for r in T.drawdown_series(df).collect():
        assert r.drawdown is None or r.drawdown <= 0.0


# --------------------------------------------------------------------------
# count_above against brute force: ties, NULL values, weights, uneven groups
# --------------------------------------------------------------------------


@SETTINGS
@given(
    st.lists(
        st.tuples(
            st.sampled_from(["a", "b", "c"]),
            st.one_of(st.none(), st.integers(0, 6).map(float)),
            st.sampled_from([0, 1]),
        ),
        min_size=1,
        max_size=60,
    )
)
def test_count_above_is_exact(spark, rows):
    from fundspark.operators.ranking import count_above

    df = spark.createDataFrame([(i, g, v, w) for i, (g, v, w) in enumerate(rows)], "i int, g string, v double, w int")
    got = {r.i: r.n_above for r in count_above(df, ["g"], "v", weight="w", buckets=4).collect()}
    for i, (g, v, _) in enumerate(rows):
        expected = None if v is None else sum(w2 for g2, v2, w2 in rows if g2 == g and v2 is not None and v2 > v)
        assert got[i] == expected, (i, g, v)
