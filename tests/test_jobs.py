"""The composed flows on scratch folders."""

import os

from fundspark import jobs
from fundspark.sources import readers as R

META_CSV = """AMC,Code,Scheme Name,Scheme Type,Scheme Category,Scheme NAV Name,Scheme Minimum Amount,Launch Date,Closure Date,ISIN Div Payout/ ISIN Growth,ISIN Div Reinvestment
A,100033,Alpha,Open Ended,Equity Scheme - Flexi Cap Fund,Alpha Flexi Cap - Direct Plan - Growth,5000,05-Apr-1996,,INF1,
B,100034,Beta,Open Ended,Debt Scheme - Liquid Fund,Beta Liquid - Regular - IDCW,1000,05/04/1999,,INF2,
"""
REPORT = """Scheme Code;ISIN Div Payout/ISIN Growth;ISIN Div Reinvestment;Net Asset Value;Date
Open Ended Schemes ( Equity )
100033;INF1;-;12.5;01-Apr-2024
100033;INF1;-;12.5;01-Apr-2024
100034;INF2;-;10.0;01-Apr-2024
100033;INF1;-;12.7;02-Apr-2024
"""


def test_flows(spark, scratch):
    meta_dir = os.path.join(scratch, "metadata")
    os.makedirs(meta_dir)
    with open(os.path.join(meta_dir, "scheme_metadata_20240401.csv"), "w") as f:
        f.write(META_CSV)
    clean_meta = os.path.join(scratch, "clean_meta")
    check = jobs.metadata_update(spark, f"{meta_dir}/scheme_metadata_*.csv", clean_meta)
    assert check.first()["valid"] and check.first()["rows"] == 2
    assert jobs.metadata_update(spark, f"{meta_dir}/scheme_metadata_*.csv", clean_meta) is None  # nothing newer

    m = jobs.master_update(spark, clean_meta, os.path.join(scratch, "master"), "2024-04-01")
    assert m.filter("is_active").count() == 2

    landing = os.path.join(scratch, "landing")
    os.makedirs(landing)
    with open(os.path.join(landing, "daily_20240402.txt"), "w") as f:
        f.write(REPORT)
    clean = jobs.prices_update(spark, landing, clean_meta, os.path.join(scratch, "clean"))
    # growth plans only, exact repeats removed
    assert sorted((r.scheme_code, str(r.date), r.nav) for r in clean.collect()) == [
        ("100033", "2024-04-01", 12.5), ("100033", "2024-04-02", 12.7)]

    name = "t_analytics_" + os.path.basename(scratch).replace("-", "_")
    bucketed = jobs.analytics_table_update(spark, os.path.join(scratch, "clean"), name, os.path.join(scratch, "analytics"), buckets=4)
    assert bucketed.count() == 2

    stats = jobs.completeness_update(spark, os.path.join(scratch, "clean"), os.path.join(scratch, "report"))
    assert stats.first()["total_dates"] == 2

    hist = os.path.join(scratch, "hist")
    os.makedirs(hist)
    with open(os.path.join(hist, "amfi_raw_nav_20240401_20240402.csv"), "w") as f:
        f.write(REPORT.replace(";", ",").replace("Open Ended Schemes ( Equity )\n", ""))
    raw = jobs.history_load(spark, f"{hist}/*.csv", os.path.join(scratch, "raw"))
    assert raw.count() == 4
    assert R.read_parquet(spark, os.path.join(scratch, "raw")).filter("nav IS NULL").count() == 0


def test_fund_report(spark, scratch):
    import datetime as dt
    import json

    from fundspark.functions.text import regex_search as rx

    rows = []
    for code, name, n in [("1", "Alpha Flexi Cap Fund", 30), ("2", "Beta Multi Cap Fund", 40), ("3", "Gamma Liquid", 50)]:
        for i in range(n):
            rows.append((code, name, "AMC", "Equity Scheme - Flexi Cap Fund", dt.date(2024, 1, 1) + dt.timedelta(days=i), 10.0 + i))
    df = spark.createDataFrame(rows, "scheme_code string, scheme_name string, amc_name string, scheme_category string, date date, nav double")
    df.write.parquet(f"{scratch}/clean")
    levels = [rx("scheme_name", "nothing here"), rx("scheme_name", "flexi|multi cap")]
    kpis = jobs.fund_report(spark, f"{scratch}/clean", levels, f"{scratch}/study").collect()
    assert [r.scheme_code for r in kpis] == ["2"]  # best coverage among the matches of level 2
    rec = json.loads(R.read_records(spark, f"{scratch}/study/fund_analysis_results").first().record)
    assert rec["fund_name"] == "Beta Multi Cap Fund" and rec["data_points"] == 40
