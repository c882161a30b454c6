"""Hot groups: one group holds a third of all rows."""

import random

from pyspark.sql import functions as F

from fundspark.operators import quality as Q
from fundspark.operators.ranking import count_above


def _rows(n=30000, hot_share=1 / 3, ties=False, seed=3):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        hot = rnd.random() < hot_share
        g = "hot" if hot else f"g{rnd.randint(0, 199)}"
        v = 1.0 if (hot and ties) else rnd.random()
        out.append((g, v))
    return out


def test_hot_group_is_split_into_buckets(spark):
    rows = _rows()
    df = spark.createDataFrame(rows, "g string, v double")
    out = count_above(df, ["g"], "v", buckets=32, keep_bucket=True)
    sizes = out.filter("g = 'hot'").groupBy("_b").count().agg(F.max("count"), F.count("*")).first()
    hot = sum(1 for g, _ in rows if g == "hot")
    assert sizes[1] >= 30  # the hot group spans (nearly) all 32 buckets
    assert sizes[0] <= 2 * hot / 32  # no window partition holds more than ~1/16 of the hot group
    # and the counts are exact
    sample = {r.v: r.n_above for r in out.filter("g = 'hot'").limit(200).collect()}
    hot_values = sorted(v for g, v in rows if g == "hot")
    import bisect

    for v, n in sample.items():
        assert n == len(hot_values) - bisect.bisect_right(hot_values, v)


def test_hot_group_of_ties_collapses(spark):
    df = spark.createDataFrame(_rows(ties=True), "g string, v double")
    out = count_above(df, ["g"], "v", keep_bucket=True)
    hot = out.filter("g = 'hot'")
    assert hot.select("n_above").distinct().collect()[0][0] == 0
    # ties become one row per (group, bucket, value) before any window runs
    assert hot.select("_b", "v").distinct().count() == 1


def test_hot_date_and_hot_key_aggregates(spark):
    rnd = random.Random(5)
    rows = [("hot" if rnd.random() < 1 / 3 else f"k{rnd.randint(0, 999)}", f"2024-01-{1 + rnd.randint(0, 27):02d}") for _ in range(30000)]
    df = spark.createDataFrame(rows, "scheme_code string, d string").withColumn("date", F.to_date("d"))
    rep = {r.date.day: r.scheme_count for r in Q.validation_report(df).collect()}
    for day in (1, 15, 28):
        exp = len({k for k, d in rows if int(d[-2:]) == day})
        assert rep[day] == exp
    dups = Q.find_duplicates(df, ["scheme_code", "date"])
    assert dups.filter("scheme_code = 'hot'").count() == 28
