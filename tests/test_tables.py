"""Merges with clashing names, exact samples, one row per date, the attempt ledger, pruned loads, replayed batches."""

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from fundspark.operators import aum as A
from fundspark.operators import calendar as C
from fundspark.operators import nav as N
from fundspark.operators import performance as P
from fundspark.operators import ranking as K
from fundspark.operators import series as T
from fundspark.operators import tables as TB
from fundspark.sources import readers as R
from fundspark.sources import sinks as W
from fundspark.streaming import ingest


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_merge_keeps_both_of_a_clashing_name(spark):
    left = spark.createDataFrame([(1, "a", "x", 1.0), (2, "b", "y", 2.0), (None, "c", "z", 3.0)], "k int, isin string, `a.b` string, nav double")
    right = spark.createDataFrame([(1, "A", "X"), (1, "B", "Y"), (None, "C", "Z"), (9, "D", "W")], "K int, ISIN string, `A.B` string")
    inner = TB.merge_tables(left, right, "k")
    assert inner.columns == ["k", "isin_x", "a.b_x", "nav", "ISIN_y", "A.B_y"]
    assert rows(inner) == [(1, "a", "x", 1.0, "A", "X"), (1, "a", "x", 1.0, "B", "Y")]
    assert rows(TB.merge_tables(left, right, "k", null_keys_match=True))[-1] == (None, "c", "z", 3.0, "C", "Z")
    outer = TB.merge_tables(left, right, "k", how="left", suffixes=("_l", "_r"))
    assert rows(outer) == [(1, "a", "x", 1.0, "A", "X"), (1, "a", "x", 1.0, "B", "Y"), (2, "b", "y", 2.0, None, None), (None, "c", "z", 3.0, None, None)]
    full = rows(TB.merge_tables(left, right, "k", how="full"))
    assert (9, None, None, None, "D", "W") in full and (None, None, None, None, "C", "Z") in full and len(full) == 6
    assert TB.merge_tables(left.limit(0), right, "k").count() == 0
    with pytest.raises(ValueError):
        TB.merge_tables(left.withColumn("isin_x", F.lit(1)), right, "k")
    with pytest.raises(ValueError):
        TB.merge_tables(left, right, "nope")


def test_merge_deals_null_keys_out(spark):
    left = spark.range(64_000).select(F.when(F.col("id") % 3 != 0, F.col("id")).alias("k"), F.col("id").alias("v"))
    right = spark.range(1000).select(F.col("id").alias("k"), F.lit(1).alias("w"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        merged = TB.merge_tables(left, right, "k", how="left")
        sizes = [r.n for r in merged.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sum(sizes) == 64_000 and max(sizes) < 0.25 * 64_000


def test_sample_is_exact_and_ignores_partitioning(spark):
    df = spark.range(5000).select(F.col("id").alias("k"), (F.col("id") % 7).alias("v"))
    one = rows(TB.sample_n(df, 100, ["k"], seed=1))
    assert len(one) == 100 == len(set(one))
    assert rows(TB.sample_n(df.repartition(13, "v"), 100, ["k"], seed=1)) == one != rows(TB.sample_n(df, 100, ["k"], seed=2))
    assert TB.sample_n(df, 10_000, ["k"]).count() == 5000 and TB.sample_n(df, 0, ["k"]).count() == 0
    same = spark.createDataFrame([(1, None)] * 5, "k int, v string")
    assert TB.sample_n(same, 3, ["k", "v"]).count() == 3
    # about the same share of every group, as a sample should have
    groups = {r.v: r["count"] for r in TB.sample_n(df, 2100, ["k"]).groupBy("v").count().collect()}
    assert all(220 < n < 380 for n in groups.values())


def test_one_row_per_date(spark):
    d = dt.date(2024, 1, 1)
    data = [("a", d, 1.0, 1), ("a", d, 5.0, 3), ("a", d, 4.0, 2), ("a", d, None, 9), ("b", d, None, 1), ("b", d, float("nan"), 2), (None, d, 2.0, None), (None, d, 3.0, None)]
    df = spark.createDataFrame(data, "scheme_code string, date date, nav double, seq int")
    got = lambda keep: {r.scheme_code: r.nav for r in T.one_per_date(df, by=["seq"], keep=keep).collect()}
    assert got("last") == {"a": 5.0, "b": None, None: 3.0}
    assert got("first") == {"a": 1.0, "b": None, None: 2.0}
    assert (got("min")["a"], got("max")["a"], got("mean")["a"]) == (1.0, 5.0, 10 / 3)
    with pytest.raises(ValueError):
        T.one_per_date(df, keep="any")
    assert T.one_per_date(df.limit(0)).count() == 0
    T.assert_unique(T.one_per_date(df), ["scheme_code", "date"])


def test_hot_key_is_bounded_by_the_calendar(spark):
    """A third of all rows are of one key; what enters its window is one row per date."""
    rnd = random.Random(2)
    data = [("hot" if rnd.random() < 1 / 3 else f"k{rnd.randint(0, 400)}", dt.date(2024, 1, 1) + dt.timedelta(rnd.randint(0, 29)), rnd.random(), i) for i in range(30_000)]
    df = spark.createDataFrame(data, "scheme_code string, date date, nav double, seq int").repartition(8)
    one = T.one_per_date(df, by=["seq"])
    assert one.where("scheme_code = 'hot'").count() == 30
    out = T.period_returns(one)
    last = {}
    for k, d, v, i in data:
        if k == "hot" and (d not in last or last[d][0] < i):
            last[d] = (i, v)
    want = [last[d][1] for d in sorted(last)]
    got = [r.nav for r in out.where("scheme_code = 'hot'").orderBy("date").collect()]
    assert got == want
    # repeats are combined before the first shuffle: partial aggregate below the exchange on (key, date)
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("partial_max_by") == 1 and re.search(r"Exchange hashpartitioning\(scheme_code#\d+, date#\d+", plan)


def test_ledger(spark, scratch):
    chunks = C.chunk_plan(spark, "2024-01-01", "2024-03-31", days=30)
    names = [r.file_name for r in chunks.orderBy("chunk_no").collect()]
    at = lambda m: dt.datetime(2024, 4, 1, 0, m)
    schema = "file_name string, attempted_at timestamp, attempt int, outcome string, message string"
    first = spark.createDataFrame([(names[0], at(1), 1, "failed", "x"), (names[1], at(2), 1, "fetched", None), (names[3], at(3), 1, "fetched", None)], schema)
    again = spark.createDataFrame([(names[0], at(5), 2, "fetched", None), (names[1], at(6), 2, "failed", "y"), ("other", at(7), 1, "failed", "z")], schema)
    for run in (first, again, again):  # a repeated append is one attempt
        C.record_attempts(run, f"{scratch}/ledger")
    landed = spark.createDataFrame([(names[3],)], "file_name string")
    ledger = C.chunk_ledger(chunks, R.read_parquet(spark, f"{scratch}/ledger"), landed)
    got = {r.file_name: (r.state, r.attempts, r.failures) for r in ledger.collect()}
    assert got == {names[0]: ("fetched", 2, 1), names[1]: ("failed", 2, 1), names[2]: ("pending", 0, 0), names[3]: ("skipped", 0, 0)}
    assert tuple(C.ledger_status(ledger).first()) == (4, 1, 1, 1, 1, 4, False)
    forced = C.chunk_ledger(chunks, R.read_parquet(spark, f"{scratch}/ledger"), landed, force=True)
    assert {r.file_name: r.state for r in forced.collect()}[names[3]] == "fetched"
    none = C.chunk_ledger(chunks, first.limit(0))
    assert tuple(C.ledger_status(none).first()) == (4, 0, 0, 0, 4, 0, True)


def test_distinct_shuffles_only_what_the_join_keeps(spark):
    nav = spark.range(1000).select((F.col("id") % 50).cast("string").alias("scheme_code"), F.col("id").cast("double").alias("nav"))
    meta = spark.createDataFrame([(str(i), f"n{i}", i < 5) for i in range(50)], "scheme_code string, scheme_name string, is_growth_plan boolean")
    out = N.enrich_nav(nav, meta, columns=["scheme_name"])
    assert out.count() == 100
    plan = out._jdf.queryExecution().executedPlan().toString()
    tail = plan[plan.index("Exchange hashpartitioning(scheme_code"):]
    assert "LeftSemi" in tail  # below the exchange of the DISTINCT


def test_planned_replies_only_are_read(spark, scratch):
    text = lambda y, p: '{"selectedPeriod":"P%d","data":[{"Mfname":"m","schemes":[{"AMFI_Code":"%d%d"}]}]}' % (p, y, p)
    replies = spark.createDataFrame([(y, p, text(y, p)) for y in range(1, 9) for p in range(1, 5)], "fy_id bigint, period_id bigint, json string")
    A.store_replies(replies, f"{scratch}/replies")
    plan = spark.createDataFrame([(2, "FY 2", 3), (5, "FY 5", 1), (99, "FY 99", 1)], "fy_id bigint, financial_year string, period_id bigint")
    out = A.load_stored_aum(spark, f"{scratch}/replies", plan, fetched_at="2024-12-01 00:00:00")
    assert rows(out.select("scheme_code", "financial_year", "period")) == [("23", "FY 2", "P3"), ("51", "FY 5", "P1")]
    text = out._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in text
    # the JSON is parsed above the join
    assert text.index("from_json") < text.index("BroadcastHashJoin")


def test_change_is_computed_before_the_rows_widen(spark):
    prices = spark.createDataFrame([("a", dt.date(2024, 1, i), float(i)) for i in (1, 2, 4)] + [("z", dt.date(2024, 1, 1), 1.0)], "scheme_code string, date date, nav double")
    info = spark.createDataFrame([("a", "name")], "scheme_code string, scheme_name string")
    meta = spark.createDataFrame([("a", dt.date(2020, 1, 1), 5.0)], "scheme_code string, launch_date date, minimum_amount double")
    out = N.analytical_dataset(prices, meta, info=info)
    assert [(r.nav, r.nav_change_pct, r.scheme_name, r.minimum_amount) for r in out.orderBy("date").collect()] == [
        (1.0, None, "name", 5.0), (2.0, 1.0, "name", 5.0), (4.0, 1.0, "name", 5.0),
    ]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "scheme_name" not in plan[plan.index("Window ["):].split("BroadcastQueryStage")[0].split("BroadcastExchange")[0]


def test_ranks_equal_brute_force(spark):
    rnd = random.Random(4)
    values = [0.0, -0.0, 1e-12, -1e-12, 1e300, -1e300, float("inf"), float("-inf"), float("nan"), None, 0.1, 0.1000000001]
    data = [(rnd.choice(["g", "h", None]), rnd.choice([rnd.choice(values), rnd.uniform(-1, 1), rnd.gauss(0, 1e6)]), rnd.randint(0, 1)) for _ in range(600)]
    df = spark.createDataFrame(data, "g string, v double, w int")
    order = lambda v: (1, 0.0) if v != v else (0, v)
    for r in K.count_above(df, ["g"], "v", weight="w").collect():
        if r.v is None:
            assert r.n_above is None
        else:
            assert r.n_above == sum(w for g, v, w in data if g == r.g and v is not None and order(v) > order(r.v)), r


def test_nothing_runs_while_peers_are_built(spark):
    kpis = spark.createDataFrame([(i, i / 7, 300, 2.0) for i in range(30)], "scheme_code int, cagr double, data_points int, years double")
    info = spark.createDataFrame([(i, "c" if i < 20 else "d") for i in range(30)], "scheme_code int, scheme_category string")
    store = spark.sparkContext._jsc.sc().dagScheduler()
    before = store.nextJobId()
    out = P.peer_comparison(kpis, info)
    assert store.nextJobId() == before
    got = {r.scheme_code: (r.peer_rank, r.peer_count, round(r.peer_best_cagr_pct * 7), round(r.peer_worst_cagr_pct * 7)) for r in out.collect()}
    assert got[19] == (1, 19, 1800, 0) and got[0] == (20, 19, 1900, 100) and got[29] == (1, 9, 2800, 2000)


def test_headers_are_read_from_the_heads_of_the_files(spark, scratch):
    with open(f"{scratch}/a.csv", "w") as f:
        f.write('\n  \n"Code","Name, long",Date\n1,x,d\n')
    with open(f"{scratch}/b c.csv", "w", encoding="utf-8") as f:
        f.write('﻿Date,Code,"Name, long"\nd,2,"y, z"\n')
    open(f"{scratch}/empty.csv", "w").close()
    found = R.files_by_header(spark, f"{scratch}/*.csv", ",")
    assert [h for h, _ in found] == [["Code", "Name, long", "Date"], ["Date", "Code", "Name, long"]]
    assert rows(R.read_csv_glob(spark, f"{scratch}/*.csv", ["Code", "Name, long"])) == [("1", "x"), ("2", "y, z")]
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") != str(1 << 60)
    assert len(R.first_lines(spark, f"{scratch}/*.csv", jobs=1)) == 2


def test_a_replayed_batch_neither_doubles_nor_loses_rows(spark, scratch):
    head = "Scheme Code;ISIN Div Payout/ISIN Growth;ISIN Div Reinvestment;Net Asset Value;Date\n"
    for name, body in (("a", "1;I;-;10;01-Apr-2024\n1;I;-;11;02-Apr-2024\n1;I;-;5;31-Feb-2024\n"), ("b", "1;I;-;9;01-Mar-2024\n1;I;-;10;01-Apr-2024\n1;I;-;5;31-Feb-2024\n")):
        with open(f"{scratch}/{name}.csv", "w") as f:
            f.write(head + body)
    meta = spark.createDataFrame(
        [("1", "A", "n1", "Open", "c", "x - Growth", "Others", "c", False, True)],
        "scheme_code string, amc_name string, scheme_name string, scheme_type string, scheme_category string, "
        "scheme_nav_name string, scheme_category_level1 string, scheme_category_level2 string, is_direct boolean, is_growth_plan boolean",
    )
    target = f"{scratch}/clean"
    ingest.store_batch(spark, [f"{scratch}/a.csv"], meta, target, "q-0")
    # a crash left part of batch 1: some of its rows are stored under its key
    part = ingest.new_rows(spark, [f"{scratch}/b.csv"], meta, target, batch="q-1").limit(1).withColumn(ingest.BATCH, F.lit("q-1"))
    part.write.mode("append").partitionBy("date", ingest.BATCH).parquet(target)
    for _ in range(2):
        ingest.store_batch(spark, [f"{scratch}/b.csv"], meta, target, "q-1")
        ingest.store_batch(spark, [f"{scratch}/a.csv"], meta, target, "q-0")
        got = sorted((str(r.date), r.nav) for r in R.read_parquet(spark, target).collect())
        assert got == [("2024-03-01", 9.0), ("2024-04-01", 10.0), ("2024-04-02", 11.0), ("None", 5.0)]


def test_an_empty_csv_replaces_the_old_one(spark, scratch):
    df = spark.range(3)
    assert W.write_csv(df, f"{scratch}/c") and not W.write_csv(df.limit(0), f"{scratch}/c")
    assert spark.read.schema("id long").option("header", True).csv(f"{scratch}/c").count() == 0


def test_sketches_merge_within_their_error(spark):
    df = spark.range(60_000).select((F.col("id") % 10).alias("day"), (F.col("id") % 20_011).alias("k"), (F.col("id") % 13).alias("s"))
    sketches = A.distinct_sketches(df, ["day"], ["k", "s"])
    assert sketches.count() == 10
    r = A.merged_distinct(sketches, ["k", "s"]).first()
    assert r.records == 60_000 and abs(r.k - 20_011) < 0.04 * 20_011 and r.s == 13
