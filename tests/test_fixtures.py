"""Edge cases of FIXTURES.md, one small hand-made table per rule."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from fundspark.operators import aum as A
from fundspark.operators import calendar as C
from fundspark.operators import master as M
from fundspark.operators import metadata as MD
from fundspark.operators import nav as N
from fundspark.operators import performance as P
from fundspark.operators import quality as Q
from fundspark.operators import series as T
from fundspark.sources import readers as R

D = dt.date

REPORT = """Scheme Code;ISIN Div Payout/ISIN Growth;ISIN Div Reinvestment;Net Asset Value;Date

Open Ended Schemes ( Equity )
100033;INF0001;-;12.5;01-Apr-2006
100033;INF0001;-;12.5;01-Apr-2006
100034;;;N.A.;02-Apr-2006
100035;;;1,234.5;02-Apr-2006
100036;;;10.0;31-Feb-2006
100037;;;10.0;3-APR-2006
"""


def test_clean_nav_report(spark, scratch):
    p = os.path.join(scratch, "report.txt")
    with open(p, "w") as f:
        f.write(REPORT)
    raw = R.read_nav_report(spark, p)
    assert R.check_batch(raw)
    rows = N.clean_nav(raw).orderBy("scheme_code").collect()
    got = [(r.scheme_code, r.nav, r.date) for r in rows]
    assert got == [
        ("100033", 12.5, D(2006, 4, 1)),
        ("100033", 12.5, D(2006, 4, 1)),
        ("100034", None, D(2006, 4, 2)),
        ("100035", None, D(2006, 4, 2)),
        ("100036", 10.0, None),
        ("100037", 10.0, D(2006, 4, 3)),
    ]


def test_header_matching():
    m = MD.header_mapping(["Scheme Code", "ISIN Div Payout/ ISIN GrowthISIN Div Reinvestment", "AMC"])
    assert m == {"Scheme Code": "scheme_code", "ISIN Div Payout/ ISIN GrowthISIN Div Reinvestment": "isin_growth", "AMC": "amc_name"}
    with pytest.raises(ValueError):
        MD.header_mapping(["Code", "Scheme Code"])


@pytest.mark.parametrize(
    "cat,l1,l2",
    [
        ("Equity Scheme - Flexi Cap Fund", "Equity Scheme", "Flexi Cap Fund"),
        ("Hybrid - A - B", "Hybrid Scheme", "A - B"),
        ("Other Scheme - Index Funds", "Other Scheme", "Index Funds"),
        ("Debt Scheme - na", "Debt Scheme", "Debt Scheme"),
        ("Equity", "Equity Scheme", "Equity"),
        ("Growth", "Others", "Growth"),
        ("Others", "Other Scheme", "Others"),
        ("Income -", "Others", "Income -"),
        (None, "Others", "Others"),
    ],
)
def test_category_levels(spark, cat, l1, l2):
    df = spark.createDataFrame([(cat,)], "scheme_category string")
    r = MD.category_levels(df).first()
    assert (r.scheme_category_level1, r.scheme_category_level2) == (l1, l2)


@pytest.mark.parametrize(
    "name,direct,growth",
    [
        ("XYZ Flexi Cap - Direct Plan - Growth", True, True),
        ("ABC Income Fund - Growth", False, False),
        ("XYZ - Regular - IDCW", False, False),
        ("Indirect Tax Fund", True, False),
        ("Great Grand Fund", False, True),
        (None, False, False),
    ],
)
def test_plan_flags(spark, name, direct, growth):
    r = MD.plan_flags(spark.createDataFrame([(name,)], "scheme_nav_name string")).first()
    assert (r.is_direct, r.is_growth_plan) == (direct, growth)


def test_clean_metadata_values(spark):
    raw = spark.createDataFrame(
        [
            ("A", " 1 ", "  ", "05-Apr-1996", "5000", "Income - "),
            ("B", "2", "Fund", "05/04/1996", "Rs. 5000", None),
            ("C", "3", "X", "x", "", "Equity Scheme - Flexi Cap Fund"),
        ],
        "AMC string, Code string, `Scheme Name` string, `Launch Date` string, `Scheme Minimum Amount` string, `Scheme Category` string",
    )
    rows = MD.clean_scheme_metadata(raw).orderBy("amc_name").collect()
    assert [r.scheme_code for r in rows] == ["1", "2", "3"]
    assert [r.scheme_name for r in rows] == [None, "Fund", "X"]
    assert [r.launch_date for r in rows] == [D(1996, 4, 5), D(1996, 4, 5), None]
    assert [r.minimum_amount for r in rows] == [5000.0, None, None]
    assert rows[0].scheme_category_level2 == "Income -"
    assert rows[0].closure_date is None and rows[0].scheme_nav_name is None
    v = MD.validate_metadata(MD.clean_scheme_metadata(raw)).first()
    assert (v.rows, v.distinct_codes, v.duplicate_codes, v.valid) == (3, 3, 0, True)
    bad = MD.validate_metadata(raw.select("AMC")).first()
    assert bad.valid is False and "scheme_code" in bad.missing_columns


def test_merge_master(spark):
    as_of = "2020-06-01"
    schema = "scheme_code string, attr string, launch_date date, first_seen_date date, last_seen_date date, is_active boolean, attribute_last_updated date"
    existing = spark.createDataFrame(
        [
            ("a", "old", None, D(2019, 1, 1), D(2020, 1, 1), True, D(2020, 1, 1)),
            ("b", "b", None, D(2018, 1, 1), D(2020, 1, 1), True, D(2020, 1, 1)),
            ("z", "z", None, D(2017, 1, 1), D(2019, 1, 1), False, D(2019, 1, 1)),
            ("dup", "x", None, D(2017, 1, 1), D(2019, 1, 1), True, D(2019, 1, 1)),
            ("dup", "y", None, D(2017, 1, 1), D(2019, 1, 1), True, D(2019, 1, 1)),
        ],
        schema,
    )
    latest = spark.createDataFrame(
        [("a", "new", None), ("z", "z", None), ("n", "n", D(2020, 5, 5)), ("n2", "n2", None), ("dup", "p", None), ("dup", "q", None)],
        "scheme_code string, attr string, launch_date date",
    )
    out = M.merge_master(existing, latest, as_of)
    rows = {r.scheme_code: r for r in out.collect() if r.scheme_code != "dup"}
    t = D(2020, 6, 1)
    assert (rows["a"].attr, rows["a"].first_seen_date, rows["a"].last_seen_date, rows["a"].is_active) == ("new", D(2019, 1, 1), t, True)
    assert (rows["b"].is_active, rows["b"].last_seen_date, rows["b"].attr) == (False, D(2020, 1, 1), "b")
    assert (rows["z"].is_active, rows["z"].first_seen_date, rows["z"].last_seen_date) == (True, D(2017, 1, 1), t)
    assert (rows["n"].first_seen_date, rows["n"].is_active) == (D(2020, 5, 5), True)
    assert rows["n2"].first_seen_date == t
    assert out.filter("scheme_code = 'dup'").count() == 4
    # laws: applying the same snapshot again changes nothing; no key is lost
    again = M.merge_master(out.filter("scheme_code <> 'dup'"), latest.filter("scheme_code <> 'dup'"), as_of)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, out.filter("scheme_code <> 'dup'").select(*again.columns).collect()))
    keys = {r.scheme_code for r in out.select("scheme_code").distinct().collect()}
    assert keys == {"a", "b", "z", "dup", "n", "n2"}
    with pytest.raises(ValueError):
        M.merge_master(existing, latest, as_of, check_unique=True)
    init = M.build_initial_master(latest, as_of).filter("scheme_code = 'n2'").first()
    assert (init.first_seen_date, init.is_active) == (t, True)


def test_validation_report(spark):
    rows = []
    for day, n in enumerate([100, 100, 60, 20, 100], start=1):
        rows += [(f"s{i}", D(2024, 1, day)) for i in range(n)]
    df = spark.createDataFrame(rows, "scheme_code string, date date")
    rep = Q.validation_report(df).orderBy("date").collect()
    assert [r.expected_count for r in rep] == [100, 100, 100, 87, 70]
    assert [r.status for r in rep] == ["COMPLETE", "COMPLETE", "INCOMPLETE", "HOLIDAY", "COMPLETE"]
    assert abs(rep[3].completeness_ratio - 20 / 87) < 1e-12
    st = Q.validation_stats(Q.validation_report(df)).first()
    assert (st.total_dates, st.complete_dates, st.incomplete_dates, st.holiday_dates, st.passed) == (5, 3, 1, 1, False)
    # inclusive bounds
    assert Q.validation_report(df, start="2024-01-02", end="2024-01-04").count() == 3
    assert Q.validation_report(df.limit(0)).count() == 0


def test_half_even_baseline(spark):
    # averages 2.5 -> 2, 3.5 -> 4; median 7.5 -> 7
    def counts(ns):
        rows = []
        for day, n in enumerate(ns, start=1):
            rows += [(f"s{i}", D(2024, 1, day)) for i in range(n)]
        return Q.validation_report(spark.createDataFrame(rows, "scheme_code string, date date")).orderBy("date").collect()

    assert counts([2, 3, 9])[2].expected_count == 2
    assert counts([3, 4, 9])[2].expected_count == 4
    assert counts([5, 10])[0].expected_count == 7


def _series(spark, values, start=D(2024, 1, 1)):
    rows = [("k", start + dt.timedelta(days=i), v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "scheme_code string, date date, nav double")


def test_returns_fill_and_zero_base(spark):
    r = T.period_returns(_series(spark, [1.0, None, 2.0])).orderBy("date").collect()
    assert [x.perc_return for x in r] == [None, 0.0, 1.0]
    z = T.period_returns(_series(spark, [0.0, 4.0])).orderBy("date").collect()
    assert z[1].perc_return is None
    f = T.forward_fill(_series(spark, [None, 1.0, None, 3.0])).orderBy("date").collect()
    assert [x.nav_filled for x in f] == [None, 1.0, 1.0, 3.0]
    again = T.forward_fill(T.forward_fill(_series(spark, [None, 1.0, None, 3.0])).drop("nav").withColumnRenamed("nav_filled", "nav"))
    assert [x.nav_filled for x in again.orderBy("date").collect()] == [None, 1.0, 1.0, 3.0]


def test_drawdown_and_single_row(spark):
    d = T.drawdown_series(_series(spark, [10.0, 12.0, 9.0, 15.0])).orderBy("date").collect()
    assert [x.drawdown for x in d] == [0.0, 0.0, -0.25, 0.0]
    k = P.fund_kpis(_series(spark, [10.0, 12.0, 9.0, 15.0])).first()
    assert k.max_drawdown == -0.25
    one = P.fund_kpis(_series(spark, [10.0])).first()
    assert one.daily_std is None and one.sharpe_ratio == 0.0 and one.cagr is None


def test_rolling_252(spark):
    r = T.rolling_return(_series(spark, [float(i + 1) for i in range(253)])).orderBy("date").collect()
    assert r[251].rolling_return_252 is None and abs(r[252].rolling_return_252 - 252.0) < 1e-12


def test_months(spark):
    s = spark.createDataFrame(
        [("k", D(2024, 1, 2), 10.0), ("k", D(2024, 1, 31), 11.0), ("k", D(2024, 2, 1), 11.0), ("k", D(2024, 2, 29), 12.1),
         ("k", D(2024, 3, 1), None)],
        "scheme_code string, date date, nav double",
    )
    m = P.monthly_returns(s)
    bw = P.best_worst_month(m).first()
    assert bw.best_month == D(2024, 1, 1)  # 10 % in both months: the earliest wins
    cal = P.calendar_return_table(s).first()
    assert (cal.Jan, cal.Feb, cal.Mar, cal.Apr) == (10.0, 10.0, 0.0, None)


def test_bround_values(spark):
    assert spark.range(1).select(F.bround(F.lit(0.125), 2)).first()[0] == 0.12


def test_histogram_edges(spark):
    rets = spark.createDataFrame([("k", float(x)) for x in [0.0, 0.5, 1.0]], "scheme_code string, perc_return double")
    h = {r.bin: r["count"] for r in P.return_histogram(rets, bins=2).collect()}
    assert h == {2: 2, 1: 1}
    flat = spark.createDataFrame([("k", 1.0), ("k", 1.0)], "scheme_code string, perc_return double")
    counts = {r.bin: r["count"] for r in P.return_histogram(flat).collect()}
    assert counts == {b: 2 if b == 26 else 0 for b in range(1, 51)}  # all bins are listed


def test_peers_rank_exact(spark):
    kpis = spark.createDataFrame(
        [(f"f{i}", c, 300, 2.0) for i, c in enumerate([0.1, 0.3, 0.3, 0.2, -0.1])] + [("g", 0.5, 10, 2.0)],
        "scheme_code string, cagr double, data_points long, years double",
    )
    info = spark.createDataFrame([(k, "cat", k) for k in ["f0", "f1", "f2", "f3", "f4", "g"]], "scheme_code string, scheme_category string, scheme_name string")
    r = {x.scheme_code: x for x in P.peer_comparison(kpis, info).collect()}
    assert r["f1"].peer_rank == 1 and r["f2"].peer_rank == 1 and r["f3"].peer_rank == 3
    assert r["g"].peer_rank == 1 and r["g"].total_funds == 6  # not eligible itself, ranked against 5 peers
    assert abs(r["f1"].peer_best_cagr_pct - 30.0) < 1e-9  # tie at the top: the other 0.3 remains
    assert abs(r["f4"].peer_worst_cagr_pct - 10.0) < 1e-9  # the unique minimum is itself
    assert abs(r["f0"].peer_avg_cagr_pct - (0.3 + 0.3 + 0.2 - 0.1) / 4 * 100) < 1e-9


def test_count_above_matches_brute_force(spark):
    import random

    rnd = random.Random(7)
    rows = [("hot" if i % 3 else f"g{i % 5}", float(rnd.randint(0, 40))) for i in range(600)]
    df = spark.createDataFrame(rows, "g string, v double")
    from fundspark.operators.ranking import count_above

    got = {(r.g, r.v): r.n_above for r in count_above(df, ["g"], "v", buckets=8).collect()}
    for (g, v), n in got.items():
        assert n == sum(1 for gg, vv in rows if gg == g and vv > v)


def test_date_chunks(spark):
    rows = C.chunk_plan(spark, "2020-01-01", "2020-04-10").orderBy("chunk_no").collect()
    assert [(r.chunk_start, r.chunk_end) for r in rows] == [(D(2020, 1, 1), D(2020, 3, 30)), (D(2020, 3, 31), D(2020, 4, 10))]
    assert rows[0].file_name == "amfi_raw_nav_20200101_20200330.csv"
    assert C.chunk_plan(spark, "2020-05-01", "2020-04-10").count() == 0


def test_missing_dates(spark):
    stored = spark.createDataFrame([(D(2026, 11, 26),)], "date date")
    got = [r.date for r in C.missing_dates(stored, "2026-12-01").orderBy("date").collect()]
    assert got == [D(2026, 11, 27), D(2026, 11, 30), D(2026, 12, 1)]
    empty = stored.limit(0)
    assert [r.date for r in C.missing_dates(empty, "2026-11-29").collect()] == [D(2026, 11, 29)]


def test_pending_chunks(spark):
    plan = C.chunk_plan(spark, "2020-01-01", "2020-04-10")
    landed = spark.createDataFrame([("amfi_raw_nav_20200101_20200330.csv",)], "file_name string")
    st = {r.file_name: r.state for r in C.pending_chunks(plan, landed).collect()}
    assert st == {"amfi_raw_nav_20200101_20200330.csv": "skipped", "amfi_raw_nav_20200331_20200410.csv": "pending"}
    assert C.pending_chunks(plan, landed, force=True).filter("state = 'pending'").count() == 2


MAPPING = '{"years":[{"id":1,"financial_year":"April 2024 - March 2025"}],"data":{"periods":[{"id":1},{"id":2}]}}'
DATA = (
    '{"selectedPeriod":"October - December 2024","data":[{"Mfname":"A","SchemeType_Desc":"Open","schemes":['
    '{"AMFI_Code":101,"SchemeNAVName":"A1","AverageAumForTheMonth":{'
    '"ExcludingFundOfFundsDomesticButIncludingFundOfFundsOverseas":10.5,"FundOfFundsDomestic":0.0}},'
    '{"AMFI_Code":102,"SchemeNAVName":"A2"}]},{"Mfname":"B","SchemeType_Desc":"Open","schemes":[]}]}'
)


def test_aum(spark, scratch):
    for name, text in [("map_1.json", MAPPING), ("data_1_1.json", DATA)]:
        with open(os.path.join(scratch, name), "w") as f:
            f.write(text)
    label = R.read_json_docs(spark, os.path.join(scratch, "map_1.json"), A.MAPPING_REPLY)
    periods = label.select(F.lit(1).cast("bigint").alias("fy_id"), "reply")
    plan = A.request_plan(label, periods, num_years=2)
    assert sorted((r.fy_id, r.period_id) for r in plan.collect()) == [(1, 1), (1, 2)]  # FY 2 has no label
    assert A.request_plan(label, periods, 2, specific_period=3).count() == 0
    replies = R.read_json_docs(spark, os.path.join(scratch, "data_1_1.json"), A.DATA_REPLY).select(
        F.lit(1).cast("bigint").alias("fy_id"), F.lit(1).cast("bigint").alias("period_id"), "reply"
    )
    rows = A.load_aum(plan, replies, fetched_at="2024-12-01 00:00:00").orderBy("scheme_code").collect()
    assert [(r.scheme_code, r.aum_excl_fof, r.aum_fof_domestic, r.period) for r in rows] == [
        ("101", 10.5, 0.0, "October - December 2024"),
        ("102", 0.0, 0.0, "October - December 2024"),
    ]
    assert rows[0].financial_year == "April 2024 - March 2025"


def test_scheme_search_fallback(spark):
    from fundspark.functions.text import regex_search as rx

    df = spark.createDataFrame([("1", "Alpha Flexi Cap"), ("2", "Beta Multi Cap"), ("3", None)], "code string, name string")
    out = P.scheme_search(df, [rx("name", "nothing"), rx("name", "flexi|multi cap")], ["code", "name"])
    assert sorted(r.code for r in out.collect()) == ["1", "2"]


def test_load_historical_and_range(spark, scratch):
    import os

    from fundspark.operators import quality as Q2

    d = os.path.join(scratch, "hist")
    os.makedirs(d)
    for i in range(2):
        with open(os.path.join(d, f"amfi_raw_nav_2006040{i}_2006040{i}.csv"), "w") as f:
            f.write("Scheme Code,ISIN Div Payout/ISIN Growth,ISIN Div Reinvestment,Net Asset Value,Date,Extra\n")
            f.write(f"10{i},I,-,1{i}.5,0{i + 1}-Apr-2006,x\n")
    h = N.load_historical_nav(spark, f"{d}/*.csv")
    assert sorted((r.scheme_code, r.nav) for r in h.collect()) == [("100", 10.5), ("101", 11.5)]
    r = Q2.value_range(h).first()
    assert (r.first_date, r.last_date, r.min_value, r.max_value, r.distinct_keys) == (D(2006, 4, 1), D(2006, 4, 2), 10.5, 11.5, 2)


def test_first_keys_and_sample(spark):
    df = spark.range(100).selectExpr("id % 7 AS k", "id")
    assert [r.k for r in P.first_keys(df, ["k"], 3).collect()] == [0, 1, 2]
    a = P.sample_rows(df, 0.3, seed=1).collect()
    assert a == P.sample_rows(df, 0.3, seed=1).collect()


def test_format_report(spark):
    rows = [(f"s{i}", D(2024, 1, 1)) for i in range(1200)]
    view = Q.validation_view(Q.validation_report(spark.createDataFrame(rows, "scheme_code string, date date")))
    line = Q.format_report(view).first().line
    assert line.startswith("2024-01-01") and "1,200" in line and "100.0%" in line


def test_zero_baseline_and_null_keys(spark):
    # day 1 has only NULL keys (count 0); day 2 then has a zero baseline
    rows = [(None, D(2024, 1, 1))] * 3 + [(f"s{i}", D(2024, 1, 2)) for i in range(5)]
    rep = Q.validation_report(spark.createDataFrame(rows, "scheme_code string, date date")).orderBy("date").collect()
    assert [(r.scheme_count, r.expected_count, r.status) for r in rep] == [(0, 2, "HOLIDAY"), (5, 0, "COMPLETE")]


def test_hot_date_report(spark):
    # one date holds most rows: the distinct count goes through a (date, key) shuffle
    rows = [(f"s{i}", D(2024, 1, 1)) for i in range(3000)] + [(f"s{i}", D(2024, 1, 2)) for i in range(10)]
    rep = Q.validation_report(spark.createDataFrame(rows, "scheme_code string, date date")).orderBy("date").collect()
    assert [r.scheme_count for r in rep] == [3000, 10]


def test_nan_is_missing(spark):
    s = _series(spark, [10.0, float("nan"), 12.0, 9.0])
    r = T.drawdown_series(T.period_returns(T.forward_fill(s))).orderBy("date").collect()
    assert [x.nav_filled for x in r] == [10.0, 10.0, 12.0, 9.0]
    assert [x.perc_return for x in r][1:] == pytest.approx([0.0, 0.2, -0.25])
    assert r[3].cumulative_max == 12.0 and r[3].drawdown == -0.25
    k = P.fund_kpis(s).first()
    assert k.max_drawdown == -0.25


def test_null_category_has_no_peers(spark):
    kpis = spark.createDataFrame(
        [("a", 0.1, 300, 2.0), ("b", 0.2, 300, 2.0), ("c", 0.3, 300, 2.0)],
        "scheme_code string, cagr double, data_points long, years double",
    )
    info = spark.createDataFrame([("a", None, "a"), ("b", None, "b"), ("c", "x", "c")], "scheme_code string, scheme_category string, scheme_name string")
    assert P.peer_comparison(kpis, info).count() == 0
    assert [r.scheme_code for r in P.top_peers(kpis, info).collect()] == ["c"]
    assert P.best_peers(kpis, info).count() == 0


def test_best_peers_leave_the_fund_out(spark):
    kpis = spark.createDataFrame(
        [(c, g, 300, 2.0) for c, g in zip("abcdefg", [0.7, 0.6, 0.5, 0.4, 0.3, 0.2, 0.1], strict=True)],
        "scheme_code string, cagr double, data_points long, years double",
    )
    # "z" is too new to be a peer but has peers itself
    info = spark.createDataFrame([(c, "x", c) for c in "abcdefgz"], "scheme_code string, scheme_category string, scheme_name string")
    out = {}
    for r in P.best_peers(kpis, info).orderBy("scheme_code", "position").collect():
        out.setdefault(r.scheme_code, []).append((r.position, r.peer_code))
    assert {k: "".join(p for _, p in v) for k, v in out.items()} == {
        "a": "bcdef", "b": "acdef", "c": "abdef", "d": "abcef", "e": "abcdf", "f": "abcde", "g": "abcde", "z": "abcde"
    }
    assert all([i for i, _ in v] == [1, 2, 3, 4, 5] for v in out.values())


def test_dataset_summary_approx(spark):
    df = spark.range(20000).selectExpr("id % 5000 AS k")
    exact = Q.dataset_summary(df, "k").first()
    approx = Q.dataset_summary(df, "k", approx_rsd=0.02).first()
    assert exact.distinct_keys == 5000 and abs(approx.distinct_keys - 5000) < 5000 * 0.08
