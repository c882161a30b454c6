"""Sources, sinks and the streaming ingest on scratch folders."""

import datetime as dt
import os
import time

from pyspark.sql import functions as F

from fundspark.operators import metadata as MD
from fundspark.sources import readers as R
from fundspark.sources import sinks as W
from fundspark.streaming import ingest


def test_parquet_csv_json_round_trip(spark, scratch):
    df = spark.range(10).select(F.col("id").cast("string").alias("scheme_code"), (F.col("id") * 1.5).alias("nav"),
                                F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).alias("date"))
    W.write_parquet(df, f"{scratch}/p", compression="zstd", partition_by=["date"])
    back = R.read_parquet(spark, f"{scratch}/p")
    assert back.count() == 10
    assert R.read_parquet_sql(spark, f"{scratch}/p").count() == 10
    assert W.write_csv(df, f"{scratch}/c")
    assert not W.write_csv(df.limit(0), f"{scratch}/empty")
    assert R.read_csv_glob(spark, f"{scratch}/c/*.csv", ["scheme_code", "nav"]).count() == 10
    W.write_json(df, f"{scratch}/j")
    assert R.read_records(spark, f"{scratch}/j").count() == 10
    W.snapshot(spark, f"{scratch}/p", f"{scratch}/snap", fmt="parquet")
    assert R.read_parquet(spark, f"{scratch}/snap").count() == 10
    s = R.files_summary(spark, f"{scratch}/snap/*.parquet").first()
    assert s.files >= 1 and s.bytes > 0


def test_dynamic_overwrite_and_latest(spark, scratch):
    a = spark.range(3).withColumn("v", F.lit("a"))
    W.write_dated(a, f"{scratch}/m", "2024-01-01")
    W.write_dated(a.withColumn("v", F.lit("b")), f"{scratch}/m", "2024-01-02")
    W.write_dated(a.withColumn("v", F.lit("c")), f"{scratch}/m", "2024-01-02")
    latest = W.read_latest_dated(spark, f"{scratch}/m")
    assert {r.v for r in latest.collect()} == {"c"}
    assert R.read_parquet(spark, f"{scratch}/m").count() == 6


def test_newest_file_and_freshness(spark, scratch):
    d = os.path.join(scratch, "meta")
    os.makedirs(d)
    for i, name in enumerate(["scheme_metadata_20240101.csv", "scheme_metadata_20240102.csv"]):
        with open(os.path.join(d, name), "w") as f:
            f.write("AMC,Code\nX,1\n")
        os.utime(os.path.join(d, name), (time.time() - 100 + i * 10, time.time() - 100 + i * 10))
    newest = R.newest_file(spark, f"{d}/scheme_metadata_*.csv")
    assert newest.endswith("scheme_metadata_20240102.csv")
    assert R.is_newer(spark, f"{d}/scheme_metadata_*.csv", f"{scratch}/not_there") is True
    assert R.is_newer(spark, f"{scratch}/nothing_*.csv", f"{scratch}/x") is False
    df = R.read_metadata_csv(spark, newest)
    assert MD.clean_scheme_metadata(df).first().scheme_code == "1"
    assert W.instrument_dump(df, f"{scratch}/dump", "mf", dt.datetime(2024, 5, 6, 7, 8, 9)).endswith(
        "dump/2024/05/06/mf_20240506070809.csv"
    )


def test_na_tokens(spark):
    df = spark.createDataFrame([("NA", "x"), ("null", "n/a")], "a string, b string")
    assert R.na_tokens_to_null(df).collect()[0].a is None
    assert R.na_tokens_to_null(df).collect()[1].b is None


def test_stream_ingest(spark, scratch):
    landing = os.path.join(scratch, "landing")
    os.makedirs(landing)
    text = ("Scheme Code;ISIN Div Payout/ISIN Growth;ISIN Div Reinvestment;Net Asset Value;Date\n"
            "1;I1;-;10.5;01-Apr-2024\n1;I1;-;10.5;01-Apr-2024\n2;I2;-;N.A.;01-Apr-2024\n3;I3;-;7;01-Apr-2024\n")
    with open(os.path.join(landing, "d1.csv"), "w") as f:
        f.write(text)
    meta = spark.createDataFrame(
        [("1", "A", "n1", "Open", "c", "x - Growth", "Others", "c", False, True), ("3", "B", "n3", "Open", "c", "y - IDCW", "Others", "c", False, False)],
        "scheme_code string, amc_name string, scheme_name string, scheme_type string, scheme_category string, "
        "scheme_nav_name string, scheme_category_level1 string, scheme_category_level2 string, is_direct boolean, is_growth_plan boolean",
    )
    target = os.path.join(scratch, "clean")
    # a stream's checkpoint belongs to one landing folder: a fresh name per test run
    name = "t_ingest_" + os.path.basename(scratch)
    q = ingest.start_ingest(spark, landing, meta, target, name=name)
    q.awaitTermination(120)
    out = R.read_parquet(spark, target).collect()
    assert [(r.scheme_code, r.nav) for r in out] == [("1", 10.5)]
    # a second file with a repeat and a new row: only the new row is appended
    with open(os.path.join(landing, "d2.csv"), "w") as f:
        f.write(text.split("\n")[0] + "\n1;I1;-;10.5;01-Apr-2024\n1;I1;-;11.0;02-Apr-2024\n")
    q = ingest.start_ingest(spark, landing, meta, target, name=name, max_files=1)
    q.awaitTermination(120)
    got = sorted((r.scheme_code, r.nav) for r in R.read_parquet(spark, target).collect())
    assert got == [("1", 10.5), ("1", 11.0)]


def test_export_fund_report(spark, scratch):
    import json

    from fundspark.operators import nav as N
    from fundspark.operators import performance as P

    rows = [("k", __import__("datetime").date(2024, 1, 1 + i), 10.0 + i) for i in range(5)]
    s = spark.createDataFrame(rows, "scheme_code string, date date, nav double")
    a = N.analytical_dataset(s, spark.createDataFrame([("k", None, 500.0)], "scheme_code string, launch_date date, minimum_amount double"))
    info = spark.createDataFrame([("k", "Fund K", "AMC K", "Equity Scheme - Flexi Cap Fund")], "scheme_code string, scheme_name string, amc_name string, scheme_category string")
    W.export_fund_report(P.fund_kpis(s), a, f"{scratch}/report", info=info)
    rec = json.loads(R.read_records(spark, f"{scratch}/report/fund_analysis_results").first().record)
    assert rec["data_points"] == 5 and abs(rec["growth_multiple"] - 1.4) < 1e-12
    assert (rec["fund_name"], rec["amc_name"], rec["analysis_period"]) == ("Fund K", "AMC K", "2024-01-01 to 2024-01-05")
    csv = spark.read.option("header", True).csv(f"{scratch}/report/fund_performance_data")
    assert csv.count() == 5 and {"date", "nav", "nav_change_pct", "year", "month"} <= set(csv.columns)


def test_storage_path():
    assert R.storage_path("s3a://b/funds/", "clean", "nav_daily_growth_plan") == "s3a://b/funds/clean/nav_daily_growth_plan.parquet"
    assert R.storage_path("/d", "raw", "x", "csv") == "/d/raw/x.csv"


def test_master_versions(spark, scratch):
    import datetime as dt

    from fundspark.operators import master as M

    path = f"{scratch}/master"
    v1 = spark.createDataFrame([("a", None), ("b", None)], "scheme_code string, launch_date date")
    m1 = M.update_master_table(spark, path, v1, "2024-01-01")
    assert m1.count() == 2 and m1.filter("is_active").count() == 2
    v2 = spark.createDataFrame([("a", None), ("c", dt.date(2024, 1, 15))], "scheme_code string, launch_date date")
    m2 = {r.scheme_code: r for r in M.update_master_table(spark, path, v2, "2024-02-01").collect()}
    assert (m2["b"].is_active, m2["a"].first_seen_date, m2["c"].first_seen_date) == (False, dt.date(2024, 1, 1), dt.date(2024, 1, 15))
    # rerunning the same day gives the same version; the first version is still stored
    again = M.update_master_table(spark, path, v2, "2024-02-01")
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, spark.createDataFrame(list(m2.values())).select(*again.columns).collect()))
    assert R.read_parquet(spark, path).filter("as_of = DATE'2024-01-01'").count() == 2


def test_clean_table_day_replace(spark, scratch):
    import datetime as dt

    from fundspark.operators import nav as N

    path = f"{scratch}/clean"
    d1 = spark.createDataFrame([("1", dt.date(2024, 1, 1), 1.0), ("1", dt.date(2024, 1, 2), 2.0)], "scheme_code string, date date, nav double")
    N.write_clean_table(d1, path)
    N.write_clean_table(spark.createDataFrame([("1", dt.date(2024, 1, 2), 2.5)], "scheme_code string, date date, nav double"), path)
    got = sorted((str(r.date), r.nav) for r in R.read_parquet(spark, path).collect())
    assert got == [("2024-01-01", 1.0), ("2024-01-02", 2.5)]


def test_read_parquet_nanos(spark, scratch):
    import pandas as pd
    import pyarrow as pa
    import pyarrow.parquet as pq

    t = pa.table({"scheme_code": ["1", "2"], "date": pa.array(pd.to_datetime(["2024-01-02", "2024-03-04"]).values, pa.timestamp("ns"))})
    pq.write_table(t, f"{scratch}/nanos.parquet", coerce_timestamps=None, version="2.6")
    df = R.read_parquet_nanos(spark, f"{scratch}/nanos.parquet", ["date"])
    got = sorted((r.scheme_code, str(r.date)) for r in df.select("scheme_code", F.to_date("date").alias("date")).collect())
    assert got == [("1", "2024-01-02"), ("2", "2024-03-04")]


def test_csv_files_keep_their_own_headers(spark, scratch):
    d = os.path.join(scratch, "mixed")
    os.makedirs(d)
    with open(f"{d}/a.csv", "w") as f:
        f.write("Scheme Code,Net Asset Value,Date\n1,10.5,01-Apr-2024\n")
    with open(f"{d}/b.csv", "w") as f:
        f.write("Date,Scheme Name,Net Asset Value,Scheme Code\n02-Apr-2024,x,11.5,2\n")
    got = R.read_csv_glob(spark, f"{d}/*.csv", ["Scheme Code", "Net Asset Value", "Date"]).collect()
    assert sorted(map(tuple, got)) == [("1", "10.5", "01-Apr-2024"), ("2", "11.5", "02-Apr-2024")]
    import pytest

    with pytest.raises(ValueError):
        R.read_csv_glob(spark, f"{d}/*.csv", ["Scheme Name"])


def test_stream_keeps_late_dates_and_extra_columns(spark, scratch):
    landing = os.path.join(scratch, "landing")
    os.makedirs(landing)
    head = "Scheme Code;ISIN Div Payout/ISIN Growth;ISIN Div Reinvestment;Net Asset Value;Date\n"
    with open(f"{landing}/d1.csv", "w") as f:
        f.write(head + "1;I1;-;10.5;01-Apr-2024\n")
    meta = spark.createDataFrame(
        [("1", "A", "n1", "Open", "c", "x - Growth", "Others", "c", False, True)],
        "scheme_code string, amc_name string, scheme_name string, scheme_type string, scheme_category string, "
        "scheme_nav_name string, scheme_category_level1 string, scheme_category_level2 string, is_direct boolean, is_growth_plan boolean",
    )
    target, name = os.path.join(scratch, "clean"), "t_late_" + os.path.basename(scratch)
    ingest.start_ingest(spark, landing, meta, target, name=name).awaitTermination(120)
    with open(f"{landing}/d2.csv", "w") as f:
        f.write("Scheme Name;" + head + "A;1;I1;-;9.5;01-Mar-2024\nA;1;I1;-;9.6;02-Mar-2024\nA;1;I1;-;11;02-Apr-2024\nA;1;I1;-;10.5;01-Apr-2024\n")
    ingest.start_ingest(spark, landing, meta, target, name=name).awaitTermination(120)
    got = sorted((str(r.date), r.nav) for r in R.read_parquet(spark, target).collect())
    assert got == [("2024-03-01", 9.5), ("2024-03-02", 9.6), ("2024-04-01", 10.5), ("2024-04-02", 11.0)]


def test_empty_report_does_not_pass(spark, scratch):
    from fundspark import jobs

    rows = [(str(k), __import__("datetime").date(2024, 1, d), 1.0) for k in range(3) for d in range(1, 6)]
    spark.createDataFrame(rows, "scheme_code string, date date, nav double").write.parquet(f"{scratch}/prices")
    first = jobs.completeness_update(spark, f"{scratch}/prices", f"{scratch}/report").first()
    assert first["total_dates"] == 5
    empty = jobs.completeness_update(spark, f"{scratch}/prices", f"{scratch}/report", start="2030-01-01", end="2030-01-31").first()
    assert empty["total_dates"] == 0 and not empty["passed"]
