"""The query registry: name -> (spark, sf_dir) -> DataFrame, and name -> DuckDB SQL.

Each query is ``(spark, sf_dir) -> DataFrame`` and reads whole tables.
Computed doubles are rounded to 6 digits on both sides where the two
engines may differ in the last bit (sums, logs, powers). DuckDB keeps the sign of a value rounded to
zero and Spark's decimal rounding does not, so both sides add +0.0, which leaves other values unchanged.
"""

from __future__ import annotations

from collections.abc import Callable

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundspark.session import checkpoint_dir

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


def r6(df: DataFrame, cols) -> DataFrame:
    """Round computed doubles to 6 digits for the engine comparison (zero always +0.0)."""
    return df.withColumns({c: F.round(c, 6) + F.lit(0.0) for c in cols})


def scratch(spark, name):
    """A fresh folder under the shared checkpoint folder; raises when none is set."""
    base = checkpoint_dir(spark)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
