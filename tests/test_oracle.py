"""Every registered query against its DuckDB statement (smallest tables by default)."""

import os

import pytest

import __spark_entry__ as E
from fundspark.plans import catalog
from oracle import compare, duck, type_differences

# the driver checks at sf0.01; FUNDSPARK_ORACLE_SF=/root/testdata/sf0.01 runs the same here
SF = os.environ.get("FUNDSPARK_ORACLE_SF", "/root/testdata/sf0.001")
NAMES = sorted(catalog.QUERIES)  # tests/llm has the tests of the optional part


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_oracle_or_is_listed():
    rows_only = set(catalog.QUERIES) - set(catalog.ORACLE)
    assert rows_only <= {"stream_ingest", "sink_round_trip"}, rows_only


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["date", "scheme_count", "rolling_avg", "expected_count", "completeness_ratio", "status"]


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = catalog.QUERIES[name](spark, SF)
    sql = catalog.ORACLE.get(name)
    if sql is None:
        assert df.count() >= 0
    else:
        assert not type_differences(df, con, sql)
        compare(df, con, sql)
