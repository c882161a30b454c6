"""Compare a Spark DataFrame with a DuckDB query on the same parquet tables."""

from __future__ import annotations

import datetime as dt
import math

import duckdb

from fundspark.plans.standins import TABLES


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v, digits=None):
    """Comparable form of a value; floats exactly (``digits`` rounds them when given)."""
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return v if digits is None else round(v, digits)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x, digits) for x in v)
    return v


def rows_of_spark(df):
    cols = sorted(df.columns)
    return cols, sorted((tuple(_norm(r[c]) for c in cols) for r in df.collect()), key=repr)


def rows_of_duck(con, sql):
    rel = con.sql(sql)
    names = rel.columns
    order = sorted(range(len(names)), key=lambda i: names[i])
    data = rel.fetchall()
    return [names[i] for i in order], sorted((tuple(_norm(r[i]) for i in order) for r in data), key=repr)


def compare(df, con, sql):
    sc, sr = rows_of_spark(df)
    dc, dr = rows_of_duck(con, sql)
    assert sc == dc, f"columns differ: {sc} vs {dc}"
    assert len(sr) == len(dr), f"row count {len(sr)} vs {len(dr)}"
    for a, b in zip(sr, dr):
        assert a == b, f"first difference:\n spark {a}\n duck  {b}"
    return len(sr)


SPARK_TO_DUCK = {
    "IntegerType()": "INTEGER", "LongType()": "BIGINT", "DoubleType()": "DOUBLE", "StringType()": "VARCHAR",
    "DateType()": "DATE", "BooleanType()": "BOOLEAN", "TimestampNTZType()": "TIMESTAMP",
}


def type_differences(df, con, sql):
    """Columns whose Spark type does not map to the DuckDB result type."""
    st = {f.name: SPARK_TO_DUCK.get(str(f.dataType), str(f.dataType)) for f in df.schema}
    rel = con.sql(sql)
    dt = dict(zip(rel.columns, [str(t) for t in rel.types]))
    return {k: (st.get(k), dt.get(k)) for k in set(st) | set(dt) if st.get(k) != dt.get(k)}
