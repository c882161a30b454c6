"""Plan checks: no Python in the plans, filters and columns reach the scan, bounded broadcasts."""

import pytest

import __spark_entry__ as E
from fundspark.operators import nav as N
from fundspark.plans import catalog
from fundspark.plans import standins as S

SF = "/root/testdata/sf0.001"


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


PYTHON_NODES = (
    "BatchEvalPython", "ArrowEvalPython", "PythonUDF", "MapInArrow", "MapInPandas", "FlatMapGroupsInArrow", "FlatMapGroupsInPandas",
    "FlatMapCoGroupsIn", "AggregateInPandas", "WindowInPandas", "PythonMapInArrow", "ExternalRDD", "SerializeFromObject",
)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_no_python_in_plan(spark, name):
    text = plan_text(catalog.QUERIES[name](spark, SF))
    assert not [n for n in PYTHON_NODES if n in text]


def test_enrich_broadcasts_checked_metadata_and_prunes(spark):
    df = N.enrich_nav(
        spark.read.parquet(f"{SF}/lineitem.parquet").selectExpr(
            "CAST(l_partkey AS STRING) AS scheme_code", "CAST(l_shipdate AS DATE) AS date", "l_extendedprice AS nav"
        ),
        S.part_metadata(spark, SF),
    )
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in text or "BroadcastExchange" in text
    # the price scan reads only the three columns the enrichment uses
    import re

    scans = [line for line in text.split("\n") if "FileScan parquet" in line and "l_partkey" in line]
    assert scans and all(re.search(r"\[l_partkey#\d+L?,l_extendedprice#\d+,l_shipdate#\d+\]", line) for line in scans), scans


def test_filter_pushdown_reaches_scan(spark, scratch):
    from fundspark.operators import quality

    # the stored layout: a real date column (in the stand-in it is derived from a timestamp)
    S.event_days(spark, SF).write.parquet(f"{scratch}/days")
    days = spark.read.parquet(f"{scratch}/days")
    df = quality.validation_report(days, start="2024-01-05", end="2024-01-10")
    text = plan_text(df)
    scan = [line for line in text.split("\n") if "FileScan parquet" in line][0]
    assert "GreaterThanOrEqual(date,2024-01-05)" in scan and "LessThanOrEqual(date,2024-01-10)" in scan, scan
    # and the events scan of the stand-in reads only the two columns it uses
    text2 = plan_text(quality.validation_report(S.event_days(spark, SF)))
    assert "event_type" not in text2 and "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint>" in text2


def test_no_unbounded_window_for_peer_rank(spark):
    import re

    df = E.queries()["peer_rank"](spark, SF)
    text = df._jdf.queryExecution().optimizedPlan().toString()
    specs = re.findall(r"windowspecdefinition\((.*?), specifiedwindowframe", text)
    # values within (category, range), ranges within the category
    assert specs
    for spec in specs:
        assert "cagr" not in spec or re.match(r"scheme_category#\d+, _b#\d+L?, cagr", spec), spec


def test_broadcast_only_under_bound(spark):
    from fundspark.functions.joins import broadcast_if_small

    small = spark.range(10)
    big = spark.range(1000)
    fact = spark.range(100000).withColumnRenamed("id", "k")
    j_small = fact.join(broadcast_if_small(small, 100), fact.k == small.id)
    j_big = fact.join(broadcast_if_small(big, 100), fact.k == big.id)
    assert "broadcast" in j_small._jdf.queryExecution().analyzed().toString().lower()
    assert "broadcast" not in j_big._jdf.queryExecution().analyzed().toString().lower()


def test_bucketed_table_needs_no_shuffle_for_series(spark, scratch):
    import re

    from fundspark.operators import performance
    from fundspark.sources import readers, sinks

    daily = S.daily(spark, SF)
    name = "t_bucketed_" + __import__("os").path.basename(scratch).replace("-", "_")
    t = sinks.write_bucketed_table(daily, name, f"{scratch}/bucketed", "scheme_code", 8, sort_by=["scheme_code", "date"])
    kpis = performance.fund_kpis(t)
    plan = kpis._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"Exchange hashpartitioning", plan), plan
    # same result as from the unbucketed input
    assert sorted(map(tuple, kpis.collect())) == sorted(map(tuple, performance.fund_kpis(daily).collect()))
    again = readers.register_bucketed_table(spark, name + "_again", f"{scratch}/bucketed", "scheme_code", 8)
    plan2 = performance.fund_kpis(again)._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"Exchange hashpartitioning", plan2)


def test_cluster_conf_sizes():
    from fundspark.session import cluster_conf

    conf = cluster_conf(100 * 1024**4, cores=8000)
    assert int(conf["spark.sql.shuffle.partitions"]) == 100000
    assert cluster_conf(10 * 1024**2, cores=8)["spark.sql.shuffle.partitions"] == "16"


def test_top_peers_limits_before_the_shuffle(spark):
    df = E.queries()["top_peers"](spark, SF)
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "WindowGroupLimit" in text and "Partial" in text


@pytest.mark.parametrize("name", ["fund_kpis", "calendar_return_table", "return_histogram"])
def test_series_aggregates_reuse_the_window_partitioning(spark, name):
    import re

    df = E.queries()[name](spark, SF)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    # one exchange builds the daily stand-in, one partitions by key for the window; nothing more
    assert len(re.findall(r"Exchange hashpartitioning", final)) == 2, final
