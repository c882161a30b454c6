"""Load planning, AUM replies, sinks, the streaming ingest and sources read back from landed files."""

from __future__ import annotations

import datetime as dt
import functools
import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as PT

from fundspark.operators import aum as A
from fundspark.operators import calendar as C
from fundspark.operators import metadata as MD
from fundspark.operators import nav as N
from fundspark.operators import performance as P
from fundspark.plans import standins as S
from fundspark.plans.registry import ORACLE, r6, register, scratch
from fundspark.plans.series_queries import KPI_DOUBLES, KPI_SQL
from fundspark.sources import readers as R
from fundspark.sources import sinks as W
from fundspark.streaming import ingest as STREAM


# --------------------------------------------------------------------------
# Load planning on event dates
# --------------------------------------------------------------------------


_CHUNK = 7  # days per chunk for the 30-day event table


def _event_range(spark, sf_dir, extra_days=0):
    d = S.event_days(spark, sf_dir)
    return d.agg(F.min("date").alias("start_date"), F.date_add(F.max("date"), extra_days).alias("end_date"))


def _chunks_sql(extra_days=0):
    return f"""rng AS (SELECT MIN(date) AS start_date, MAX(date) + INTERVAL {extra_days} DAY AS end_date FROM ({S.EVENT_DAYS_SQL})),
    ch AS (SELECT CAST(start_date AS DATE) AS start_date, CAST(end_date AS DATE) AS end_date,
                  CAST(ROW_NUMBER() OVER (ORDER BY g) AS INTEGER) AS chunk_no, CAST(g AS DATE) AS chunk_start,
                  LEAST(CAST(g AS DATE) + INTERVAL {_CHUNK - 1} DAY, end_date)::DATE AS chunk_end
           FROM rng, generate_series(start_date, end_date, INTERVAL {_CHUNK} DAY) AS t(g)),
    chunks AS (SELECT *, 'amfi_raw_nav_' || strftime(chunk_start, '%Y%m%d') || '_' || strftime(chunk_end, '%Y%m%d') || '.csv' AS file_name FROM ch)"""


@register("date_chunks", f"WITH {_chunks_sql()} SELECT * FROM chunks")
def q_date_chunks(spark, sf_dir):
    return C.date_chunks(_event_range(spark, sf_dir), days=_CHUNK)


def _pending(spark, sf_dir):
    chunks = C.date_chunks(_event_range(spark, sf_dir, 20), days=_CHUNK)
    days = chunks.select("file_name", F.explode(F.sequence("chunk_start", "chunk_end")).alias("date"))
    present = S.event_days(spark, sf_dir).select("date").distinct()
    landed = days.join(present, "date", "left_semi").select("file_name")
    return C.pending_chunks(chunks, landed)


_PENDING_SQL = f"""WITH {_chunks_sql(20)},
    landed AS (SELECT DISTINCT file_name FROM chunks c JOIN (SELECT DISTINCT date FROM ({S.EVENT_DAYS_SQL})) d
               ON d.date BETWEEN c.chunk_start AND c.chunk_end),
    marked AS (SELECT c.*, CASE WHEN l.file_name IS NOT NULL THEN 'skipped' ELSE 'pending' END AS state
               FROM chunks c LEFT JOIN landed l USING (file_name))"""


@register("pending_chunks", _PENDING_SQL + " SELECT * FROM marked")
def q_pending_chunks(spark, sf_dir):
    return _pending(spark, sf_dir)


@register(
    "chunk_status",
    _PENDING_SQL
    + """ SELECT COUNT(*) AS total, COUNT(*) FILTER (WHERE state = 'skipped') AS skipped,
                 COUNT(*) FILTER (WHERE state = 'pending') AS pending FROM marked""",
)
def q_chunk_status(spark, sf_dir):
    return C.chunk_status(_pending(spark, sf_dir))


# Every event is an attempt to fetch its day's chunk; errors failed. A chunk with a signup on its first day had landed before.
_LEDGER_SQL = f"""{_PENDING_SQL},
    tries AS (SELECT m.file_name, e.ts, e.event_id, CASE WHEN e.event_type = 'error' THEN 'failed' ELSE 'fetched' END AS outcome
              FROM events e JOIN chunks m ON CAST(e.ts AS DATE) BETWEEN m.chunk_start AND m.chunk_end),
    before AS (SELECT DISTINCT file_name FROM events e JOIN chunks m ON CAST(e.ts AS DATE) = m.chunk_start AND e.user_id % 7 = 3
               WHERE e.event_type = 'signup' AND m.chunk_no % 2 = 0),
    latest AS (SELECT file_name, COUNT(*) AS attempts, COUNT(*) FILTER (WHERE outcome = 'failed') AS failures,
                      MAX(ts) AS attempted_at, arg_max(outcome, (ts, event_id)) AS outcome FROM tries GROUP BY 1),
    ledger AS (SELECT c.*, b.file_name IS NOT NULL AS had, l.attempted_at,
                 CASE WHEN b.file_name IS NOT NULL THEN 'skipped' ELSE COALESCE(l.outcome, 'pending') END AS state,
                 CASE WHEN b.file_name IS NOT NULL THEN 0 ELSE COALESCE(l.attempts, 0) END AS attempts,
                 CASE WHEN b.file_name IS NOT NULL THEN 0 ELSE COALESCE(l.failures, 0) END AS failures
               FROM chunks c LEFT JOIN before b USING (file_name) LEFT JOIN latest l USING (file_name))"""


def _ledger(spark, sf_dir):
    """The ledger written in two runs and a repeated append, then read back."""
    chunks = C.date_chunks(_event_range(spark, sf_dir, 20), days=_CHUNK)
    days = chunks.select("file_name", "chunk_no", "chunk_start", F.explode(F.sequence("chunk_start", "chunk_end")).alias("date"))
    ev = S.table(spark, sf_dir, "events").withColumn("date", F.to_date("ts"))
    tried = ev.join(days, "date")
    failed = F.col("event_type") == "error"
    attempts = tried.select(
        "file_name", F.col("ts").alias("attempted_at"), F.col("event_id").alias("attempt"),
        F.when(failed, F.lit("failed")).otherwise(F.lit("fetched")).alias("outcome"),
        F.when(failed, F.lit("no answer")).alias("message"),
    )
    out = scratch(spark, "ledger")
    for run in (attempts.where("attempt % 2 = 0"), attempts.where("attempt % 2 = 1"), attempts.where("attempt % 2 = 1")):
        C.record_attempts(run, out)
    had = (F.col("event_type") == "signup") & (F.col("date") == F.col("chunk_start")) & (F.col("chunk_no") % 2 == 0) & (F.col("user_id") % 7 == 3)
    return C.chunk_ledger(chunks, R.read_parquet(spark, out), landed=tried.where(had).select("file_name"))


@register(
    "chunk_ledger",
    f"{_LEDGER_SQL} SELECT start_date, end_date, chunk_no, chunk_start, chunk_end, file_name, state, attempts, failures, attempted_at FROM ledger",
)
def q_chunk_ledger(spark, sf_dir):
    return _ledger(spark, sf_dir)


@register(
    "ledger_status",
    f"""{_LEDGER_SQL} SELECT COUNT(*) AS total, COUNT(*) FILTER (WHERE state = 'skipped') AS skipped,
        COUNT(*) FILTER (WHERE state = 'fetched') AS fetched, COUNT(*) FILTER (WHERE state = 'failed') AS failed,
        COUNT(*) FILTER (WHERE state = 'pending') AS pending, CAST(SUM(attempts) AS BIGINT) AS attempts,
        COUNT(*) FILTER (WHERE state = 'failed') = 0 AS success FROM ledger""",
)
def q_ledger_status(spark, sf_dir):
    return C.ledger_status(_ledger(spark, sf_dir))


@register(
    "missing_dates",
    f"""WITH l AS (SELECT MAX(date) AS latest FROM ({S.EVENT_DAYS_SQL}))
    SELECT CAST(g AS DATE) AS date FROM l, generate_series(latest + INTERVAL 1 DAY, latest + INTERVAL 10 DAY, INTERVAL 1 DAY) t(g)
    WHERE isodow(CAST(g AS DATE)) < 6""",
)
def q_missing_dates(spark, sf_dir):
    return C.missing_dates(S.event_days(spark, sf_dir), F.date_add(F.col("latest_date"), 10))


@register(
    "gap_dates",
    f"""WITH d AS ({S.EVENT_DAYS_SQL}), r AS (SELECT MIN(date) AS lo, MAX(date) AS hi FROM d),
    cal AS (SELECT CAST(g AS DATE) AS date FROM r, generate_series(lo, hi + INTERVAL 20 DAY, INTERVAL 1 DAY) t(g))
    SELECT date FROM cal WHERE isodow(date) < 6 AND date NOT IN (SELECT date FROM d WHERE date IS NOT NULL)""",
)
def q_gap_dates(spark, sf_dir):
    d = S.event_days(spark, sf_dir)
    # the bounds are one scalar subquery each, not pasted text
    lo = d.agg(F.min("date")).scalar()
    hi = d.agg(F.date_add(F.max("date"), 20)).scalar()
    return C.gap_dates(d, lo, hi)


# --------------------------------------------------------------------------
# AUM replies built from orders (one reply per order, two fund houses)
# --------------------------------------------------------------------------


def _order_replies(spark, sf_dir):
    o = S.table(spark, sf_dir, "orders")
    y = F.year("o_orderdate")
    q = F.quarter("o_orderdate")
    scheme1 = F.struct(
        F.col("o_orderkey").alias("AMFI_Code"),
        F.concat(F.lit("order "), F.col("o_orderkey").cast("string")).alias("SchemeNAVName"),
        F.struct(F.col("o_totalprice").alias(A.AUM_EXCL_FOF), F.lit(0.5).cast("double").alias(A.AUM_FOF_DOMESTIC)).alias(
            "AverageAumForTheMonth"
        ),
    )
    # second scheme: no name and no amounts (fields omitted from the JSON text)
    scheme2 = F.struct(
        F.col("o_custkey").alias("AMFI_Code"),
        F.lit(None).cast("string").alias("SchemeNAVName"),
        F.lit(None).cast(f"struct<{A.AUM_EXCL_FOF}:double,{A.AUM_FOF_DOMESTIC}:double>").alias(
            "AverageAumForTheMonth"
        ),
    )
    house1 = F.struct(
        F.col("o_orderpriority").alias("Mfname"),
        F.col("o_orderstatus").alias("SchemeType_Desc"),
        F.when(F.col("o_orderstatus") == "F", F.array(scheme1, scheme2)).otherwise(F.array(scheme1)).alias("schemes"),
    )
    house2 = F.struct(
        F.lit("EMPTY").alias("Mfname"),
        F.lit(None).cast("string").alias("SchemeType_Desc"),
        # an empty scheme list of the same element type (codes are JSON numbers)
        F.array().cast(
            f"array<struct<AMFI_Code:bigint,SchemeNAVName:string,"
            f"AverageAumForTheMonth:struct<{A.AUM_EXCL_FOF}:double,{A.AUM_FOF_DOMESTIC}:double>>>"
        ).alias("schemes"),
    )
    reply = F.struct(
        F.concat(F.lit("Q"), q.cast("string"), F.lit(" "), y.cast("string")).alias("selectedPeriod"),
        F.array(house1, house2).alias("data"),
    )
    # JSON text as it would land (NULL fields are left out of the text)
    text = F.to_json(reply)
    docs = o.select(F.concat(F.lit("FY "), y.cast("string")).alias("financial_year"), text.alias("json"))
    return A.parse_replies(docs)


_AUM_SQL = """aum AS (
    SELECT CAST(o_orderkey AS VARCHAR) AS scheme_code, 'order ' || CAST(o_orderkey AS VARCHAR) AS scheme_name,
           o_orderpriority AS mf_name, o_orderstatus AS scheme_type, o_totalprice AS aum_excl_fof, CAST(0.5 AS DOUBLE) AS aum_fof_domestic,
           'FY ' || CAST(year(o_orderdate) AS VARCHAR) AS financial_year,
           'Q' || CAST(quarter(o_orderdate) AS VARCHAR) || ' ' || CAST(year(o_orderdate) AS VARCHAR) AS period
    FROM orders
    UNION ALL
    SELECT CAST(o_custkey AS VARCHAR), '', o_orderpriority, o_orderstatus, CAST(0.0 AS DOUBLE), CAST(0.0 AS DOUBLE),
           'FY ' || CAST(year(o_orderdate) AS VARCHAR),
           'Q' || CAST(quarter(o_orderdate) AS VARCHAR) || ' ' || CAST(year(o_orderdate) AS VARCHAR)
    FROM orders WHERE o_orderstatus = 'F')"""


@register("aum_flatten", f"WITH {_AUM_SQL} SELECT * FROM aum")
def q_aum_flatten(spark, sf_dir):
    return A.flatten_aum(_order_replies(spark, sf_dir))


@register(
    "aum_summary",
    f"""WITH {_AUM_SQL} SELECT COUNT(*) AS records, COUNT(DISTINCT scheme_code) AS schemes, COUNT(DISTINCT mf_name) AS amcs,
        COUNT(DISTINCT (financial_year, period)) AS fy_periods FROM aum""",
)
def q_aum_summary(spark, sf_dir):
    return A.aum_summary(A.flatten_aum(_order_replies(spark, sf_dir)))


@register("aum_rows_per_fy", f"WITH {_AUM_SQL} SELECT financial_year, COUNT(*) AS records FROM aum GROUP BY 1")
def q_aum_rows_per_fy(spark, sf_dir):
    return A.aum_rows_per_year(A.flatten_aum(_order_replies(spark, sf_dir)))


# --------------------------------------------------------------------------
# Sinks and the streaming ingest, written to scratch folders and read back
# --------------------------------------------------------------------------


_KPI_ROWS_SQL = (
    "SELECT scheme_code, start_date, end_date, data_points, "
    + ", ".join(f"(ROUND({c}, 6) + CAST(0 AS DOUBLE)) AS {c}" for c in KPI_DOUBLES)
    + ", CASE WHEN volatility > 0.25 THEN 'High' WHEN volatility > 0.15 THEN 'Medium' ELSE 'Low' END AS risk_level FROM kpis"
)


@register("sink_round_trip", f"WITH {KPI_SQL} SELECT k.*, f.sink FROM ({_KPI_ROWS_SQL}) k, (VALUES ('parquet'), ('csv')) f(sink)")
def q_sink_round_trip(spark, sf_dir):
    """KPIs written as partitioned Parquet and as CSV with a header; both copies are read back and compared."""
    out = scratch(spark, "sinks")
    kpis = P.risk_labels(S.daily_kpis(spark, sf_dir))
    columns = ["scheme_code", "start_date", "end_date", "data_points", *KPI_DOUBLES, "risk_level"]
    W.write_parquet(kpis, f"{out}/kpis", partition_by=["risk_level"], compression="zstd")
    W.write_csv(kpis.select(*columns), f"{out}/kpis_csv")
    parquet = R.read_parquet(spark, f"{out}/kpis").select(*columns)
    text = spark.read.schema(parquet.schema).option("header", True).csv(f"{out}/kpis_csv")
    both = parquet.withColumn("sink", F.lit("parquet")).unionByName(text.withColumn("sink", F.lit("csv")))
    return r6(both, KPI_DOUBLES)


_RECORD_DOUBLES = [
    "duration_years", "total_return_pct", "cagr_pct", "volatility_pct", "sharpe_ratio", "max_drawdown_pct",
    "start_nav", "end_nav", "growth_multiple",
]


def _report(spark, sf_dir, part):
    """The fund report of every fund, exported and one of its two outputs read back."""
    out = scratch(spark, "report")
    daily = S.daily(spark, sf_dir)
    W.export_fund_report(P.fund_kpis(daily), N.with_daily_change(daily), out, info=S.fund_info(spark, sf_dir))
    return f"{out}/{part}"


@register(
    "fund_report_kpis",
    f"""WITH {KPI_SQL}, info AS ({S.FUND_INFO_SQL})
    SELECT scheme_code, i.scheme_name AS fund_name, i.amc_name, i.scheme_category AS category,
           CAST(start_date AS VARCHAR) || ' to ' || CAST(end_date AS VARCHAR) AS analysis_period, (ROUND(years, 6) + CAST(0 AS DOUBLE)) AS duration_years,
           (ROUND(total_return_pct, 6) + CAST(0 AS DOUBLE)) AS total_return_pct, (ROUND(cagr * 100, 6) + CAST(0 AS DOUBLE)) AS cagr_pct, (ROUND(volatility * 100, 6) + CAST(0 AS DOUBLE)) AS volatility_pct,
           (ROUND(sharpe_ratio, 6) + CAST(0 AS DOUBLE)) AS sharpe_ratio, (ROUND(max_drawdown * 100, 6) + CAST(0 AS DOUBLE)) AS max_drawdown_pct, (ROUND(start_nav, 6) + CAST(0 AS DOUBLE)) AS start_nav,
           (ROUND(end_nav, 6) + CAST(0 AS DOUBLE)) AS end_nav, (ROUND(growth_multiple, 6) + CAST(0 AS DOUBLE)) AS growth_multiple, data_points
    FROM kpis JOIN info i USING (scheme_code)""",
)
def q_fund_report_kpis(spark, sf_dir):
    """The KPI records (JSON) of all funds, field by field."""
    records = R.read_records(spark, _report(spark, sf_dir, "fund_analysis_results"))
    fields = ["fund_name string", "amc_name string", "category string", "analysis_period string", "data_points bigint"]
    schema = ", ".join(fields + [f"{c} double" for c in _RECORD_DOUBLES])
    return r6(records.select("scheme_code", F.from_json("record", schema).alias("r")).select("scheme_code", "r.*"), _RECORD_DOUBLES)


@register(
    "fund_report_series",
    f"""WITH d AS ({S.DAILY_SQL})
    SELECT scheme_code, date, nav, (ROUND(nav / LAG(nav) OVER (PARTITION BY scheme_code ORDER BY date) - 1, 6) + CAST(0 AS DOUBLE)) AS nav_change_pct,
           CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month FROM d""",
)
def q_fund_report_series(spark, sf_dir):
    """The series (CSV) of all funds."""
    schema = "scheme_code bigint, date date, nav double, nav_change_pct double, year int, month int"
    path = _report(spark, sf_dir, "fund_performance_data")
    return r6(spark.read.schema(schema).option("header", True).csv(path), ["nav_change_pct"])


@register("dated_outputs", f"SELECT *, DATE '2001-08-02' AS ingest_date FROM ({S.customer_snapshot_sql('latest')})")
def q_dated_outputs(spark, sf_dir):
    """Two dated snapshots, the later one written twice; the newest date is read back."""
    out = scratch(spark, "dated")
    W.write_dated(S.customer_snapshot(spark, sf_dir, "existing"), out, S.MASTER_CUT)
    for which in ("all", "latest"):
        W.write_dated(S.customer_snapshot(spark, sf_dir, which), out, "2001-08-02")
    return W.read_latest_dated(spark, out)


@register(
    "day_replace",
    f"""WITH e AS ({S.EVENT_VALUES_SQL})
    SELECT scheme_code, date, CASE WHEN day(date) % 2 = 0 THEN nav * 2 ELSE nav END AS nav FROM e""",
)
def q_day_replace(spark, sf_dir):
    """A clean table partitioned by date, of which a second run replaces every other day."""
    out = scratch(spark, "clean")
    values = S.event_values(spark, sf_dir)
    N.write_clean_table(values, out)
    N.write_clean_table(values.filter(F.day("date") % 2 == 0).withColumn("nav", F.col("nav") * 2), out)
    return R.read_parquet(spark, out).select("scheme_code", "date", "nav")


@register("benchmark_snapshot", "SELECT * FROM orders")
def q_benchmark_snapshot(spark, sf_dir):
    """A table copied to Parquet and read back (any readable format; Delta needs its package)."""
    return W.snapshot(spark, f"{sf_dir.rstrip('/')}/orders.parquet", scratch(spark, "snapshot"), fmt="parquet")


@register(
    "instrument_dump",
    f"""SELECT trim("AMC") AS amc, trim("Code") AS code, trim("Scheme Name") AS scheme_name, trim("Scheme Category") AS scheme_category,
           TRUE AS dated FROM ({S.PART_METADATA_RAW_SQL})""",
)
def q_instrument_dump(spark, sf_dir):
    """Instrument records as a CSV file under year, month and day, read back by its headers."""
    raw = S.part_metadata_raw(spark, sf_dir)
    path = W.instrument_dump(raw, scratch(spark, "dump"), "instruments", dt.datetime(2024, 5, 6, 7, 8, 9))
    dump = R.read_csv_glob(spark, path, ["AMC", "Code", "Scheme Name", "Scheme Category"])
    dated = F.lit(path.endswith("/2024/05/06/instruments_20240506070809.csv"))
    return MD.normalise_headers(dump).withColumn("dated", dated)


_USERS_SQL = """users AS (
    SELECT CAST(user_id AS VARCHAR) AS scheme_code, 'AMC' AS amc_name, 'user ' || user_id AS scheme_name, 'Open Ended' AS scheme_type,
           'Equity Scheme - Flexi Cap Fund' AS scheme_category, 'user ' || user_id || ' - Direct Plan - Growth' AS scheme_nav_name,
           'Equity Scheme' AS scheme_category_level1, 'Flexi Cap Fund' AS scheme_category_level2, TRUE AS is_direct, TRUE AS is_growth_plan
    FROM events GROUP BY user_id HAVING MAX(value) > 50)"""


@register(
    "stream_ingest",
    f"""WITH clean AS ({ORACLE["clean_nav"]}), {_USERS_SQL}
    SELECT DISTINCT c.*, u.* EXCLUDE (scheme_code) FROM clean c JOIN users u USING (scheme_code) WHERE nav IS NOT NULL""",
)
def q_stream_ingest(spark, sf_dir):
    """Events landed in three deliveries with late and repeated rows, taken in by the file stream.

    The first start finds the later dates; the second, two micro-batches
    with the earlier dates and a repeat of the first delivery. Then the
    first delivery's batch is run once more, as after a crash.
    """
    out = scratch(spark, "stream")
    # one metadata row per user; the plan name comes from the user's largest event value,
    # and the growth flag from the plan-name rules
    users = S.table(spark, sf_dir, "events").groupBy("user_id").agg(F.max("value").alias("top"))
    nav_name = F.concat(
        F.lit("user "), F.col("user_id").cast("string"),
        F.when(F.col("top") > 50, F.lit(" - Direct Plan - Growth")).otherwise(F.lit(" - Regular Plan - IDCW")),
    )
    meta = users.select(
        F.col("user_id").cast("string").alias("scheme_code"),
        F.lit("AMC").alias("amc_name"),
        F.concat(F.lit("user "), F.col("user_id").cast("string")).alias("scheme_name"),
        F.lit("Open Ended").alias("scheme_type"),
        F.lit("Equity Scheme - Flexi Cap Fund").alias("scheme_category"),
        nav_name.alias("scheme_nav_name"),
    )
    meta = MD.plan_flags(MD.category_levels(meta))
    late = F.col("_day") < 15
    report = S.events_report_text(spark, sf_dir, day="_day")
    landing, target, name = f"{out}/landing", f"{out}/clean", f"ingest-{uuid.uuid4().hex[:8]}"

    def land(rows):
        rows.drop("_day").coalesce(1).write.mode("append").option("header", True).option("sep", ";").csv(landing)

    def run():
        STREAM.start_ingest(spark, landing, meta, target, name=name, max_files=1).awaitTermination()

    land(report.filter(~late))
    run()
    first = sorted(r["path"] for r in R.list_files(spark, f"{landing}/*.csv").select("path").collect())
    land(report.filter(late))
    land(report.filter(~late))
    run()
    batch = R.read_parquet(spark, target).agg(F.min(STREAM.BATCH)).first()[0]
    STREAM.store_batch(spark, first, meta, target, batch)
    return R.read_parquet(spark, target).drop(STREAM.BATCH)


# --------------------------------------------------------------------------
# Sources read back from landed files (written here from the tables)
# --------------------------------------------------------------------------

_CLEAN_NAV_SQL = ORACLE["clean_nav"]


@register("report_text_load", _CLEAN_NAV_SQL)
def q_report_text_load(spark, sf_dir):
    """Events as ';'-separated report files, read as all-string text and cleaned."""
    out = scratch(spark, "report")
    S.events_report_text(spark, sf_dir).write.option("header", True).option("sep", ";").csv(out)
    raw = R.read_nav_report(spark, out)
    if not R.check_batch(raw):
        raise ValueError("empty or malformed report batch")
    return N.clean_nav(raw)


@register("historical_csv_load", _CLEAN_NAV_SQL)
def q_historical_csv_load(spark, sf_dir):
    """Events as comma CSV chunk files with three kinds of headers, one with the separator in a quoted name."""
    out = scratch(spark, "history")
    text = S.events_report_text(spark, sf_dir, day="_day").withColumn("Extra, quoted", F.lit("x, y"))
    columns = [c for c in text.columns if c != "_day"]
    for turn, order in enumerate((columns, columns[::-1], [*columns[2:], *columns[:2]])):
        part = text.filter(F.col("_day") % 3 == turn).select(*[F.col(f"`{c}`") for c in order])
        part.write.mode("append").option("header", True).csv(out)
    return N.load_historical_nav(spark, f"{out}/*.csv")


@register("metadata_csv_load", ORACLE["clean_metadata"])
def q_metadata_csv_load(spark, sf_dir):
    """The scheme list landed twice as CSV; the newest file is found, read and cleaned, and is newer than nothing."""
    zone = R.storage_path(scratch(spark, "files"), "metadata", "landing", "")
    raw = S.part_metadata_raw(spark, sf_dir)
    raw.filter(F.col("AMC") == "none").coalesce(1).write.option("header", True).csv(f"{zone}/scheme_metadata_20240101.csv")
    raw.coalesce(1).write.option("header", True).csv(f"{zone}/scheme_metadata_20240102.csv")
    pattern = f"{zone}/scheme_metadata_*.csv/part-*"
    if not R.is_newer(spark, pattern, f"{zone}/processed"):
        raise ValueError("a raw file without a processed table must count as newer")
    text = R.read_metadata_csv(spark, R.newest_file(spark, pattern))
    clean = MD.clean_scheme_metadata(
        text, level1_rules=S.PART_LEVEL1_RULES, direct=S.PART_DIRECT, growth=S.PART_GROWTH, non_growth=S.PART_NON_GROWTH
    )
    W.write_parquet(clean, f"{zone}/processed")
    if R.is_newer(spark, pattern, f"{zone}/processed"):
        raise ValueError("a processed table written after the raw file must not count as older")
    return R.read_parquet(spark, f"{zone}/processed")


@register(
    "parquet_sources",
    """SELECT year(o_orderdate) AS y, source, COUNT(*) AS orders, (ROUND(SUM(o_totalprice), 2) + CAST(0 AS DOUBLE)) AS total
       FROM orders, (VALUES ('glob'), ('sql')) s(source) GROUP BY ALL""",
)
def q_parquet_sources(spark, sf_dir):
    """Orders stored in one folder per year, read by a glob and by SQL's path table."""
    out = R.storage_path(scratch(spark, "orders"), "raw", "orders", "")
    orders = S.table(spark, sf_dir, "orders").withColumn("y", F.year("o_orderdate").cast("bigint"))
    for half, rows in (("a", orders.filter("y < 1998")), ("b", orders.filter("y >= 1998"))):
        W.write_parquet(rows, f"{out}/{half}", partition_by=None)
    both = [R.read_parquet(spark, f"{out}/*").withColumn("source", F.lit("glob"))]
    both += [R.read_parquet_sql(spark, f"{out}/{half}").withColumn("source", F.lit("sql")) for half in ("a", "b")]
    rows = functools.reduce(lambda a, b: a.unionByName(b), both)
    return rows.groupBy("y", "source").agg(F.count(F.lit(1)).alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@register(
    "chunk_file_dates",
    f"WITH {_chunks_sql(20)} SELECT file_name, chunk_start, chunk_end FROM chunks UNION ALL SELECT 'x' || file_name, NULL, NULL FROM chunks",
)
def q_chunk_file_dates(spark, sf_dir):
    """The dates of a chunk read off its file name; other names have none."""
    names = C.date_chunks(_event_range(spark, sf_dir, 20), days=_CHUNK).select("file_name")
    return C.chunk_dates(names.unionByName(names.select(F.concat(F.lit("x"), "file_name").alias("file_name"))))


@register("aum_json_files", f"WITH {_AUM_SQL} SELECT * FROM aum")
def q_aum_json_files(spark, sf_dir):
    """AUM replies landed as JSON files (one document per line), read with a fixed schema."""
    out = scratch(spark, "aum")
    replies = _order_replies(spark, sf_dir)
    # each line: the landed reply text with the year label alongside
    line = F.concat(F.lit('{"financial_year":"'), F.col("financial_year"), F.lit('","reply":'), F.col("json"), F.lit("}"))
    replies.select(line).write.text(out)
    schema = PT.StructType([PT.StructField("financial_year", PT.StringType()), PT.StructField("reply", A.DATA_REPLY)])
    return A.flatten_aum(R.read_records(spark, out, schema))

_AUM_YEARS = 5  # years requested by the plan


def _aum_mapping_replies(spark, sf_dir):
    """Mapping replies per financial-year id: all year labels, and that year's periods (quarters).

    Both lists are bounded by the calendar (one entry per year; at most four
    quarters per year), so collecting them into one reply is safe.
    """
    o = S.table(spark, sf_dir, "orders")
    yq = o.select(F.year("o_orderdate").alias("y"), F.quarter("o_orderdate").alias("q")).distinct()
    years = yq.select("y").distinct()
    # ids 1..n in year order: a window over the distinct years (a calendar, not the orders)
    years = years.withColumn("fy_id", F.row_number().over(Window.orderBy("y")).cast("bigint"))
    label = F.struct(
        F.col("fy_id").alias("id"),
        F.concat(F.lit("FY "), F.col("y").cast("string")).alias("financial_year"),
    )
    labels = years.agg(F.sort_array(F.collect_list(label)).alias("years"))
    period = F.struct(F.col("q").cast("bigint").alias("id"))
    periods = yq.join(years, "y").groupBy("fy_id").agg(F.sort_array(F.collect_list(period)).alias("periods"))
    no_periods = F.struct(F.array().cast("array<struct<id:bigint>>").alias("periods"))
    no_years = F.lit(None).cast("array<struct<id:bigint,financial_year:string>>")
    label_reply = labels.select(F.struct("years", no_periods.alias("data")).alias("reply"))
    period_replies = periods.select(
        "fy_id", F.struct(no_years.alias("years"), F.struct("periods").alias("data")).alias("reply")
    )
    return label_reply, period_replies, years


@register(
    "aum_plan_load",
    f"""WITH {_AUM_SQL}
    SELECT * FROM aum
    WHERE CAST(substr(financial_year, 4) AS INTEGER) < (SELECT MIN(year(o_orderdate)) FROM orders) + {_AUM_YEARS}""",
)
def q_aum_plan_load(spark, sf_dir):
    label_reply, period_replies, years = _aum_mapping_replies(spark, sf_dir)
    plan = A.request_plan(label_reply, period_replies, num_years=_AUM_YEARS)
    data = _order_replies(spark, sf_dir)
    keyed = data.withColumn("y", F.regexp_extract("financial_year", r"(\d+)", 1).cast("int")).join(
        years.select("y", "fy_id"), "y"
    ).withColumn("period_id", F.regexp_extract("reply.selectedPeriod", r"^Q(\d)", 1).cast("bigint"))
    rows = A.load_aum(plan, keyed.select("fy_id", "period_id", "reply"), fetched_at="2024-12-01 00:00:00")
    return rows.select(*A.AUM_COLUMNS)


@register("aum_pruned_load", ORACLE["aum_plan_load"])
def q_aum_pruned_load(spark, sf_dir):
    """The replies landed by year and period id; the load reads and parses the planned ones only."""
    label_reply, period_replies, years = _aum_mapping_replies(spark, sf_dir)
    plan = A.request_plan(label_reply, period_replies, num_years=_AUM_YEARS)
    keyed = _order_replies(spark, sf_dir).withColumn("y", F.regexp_extract("financial_year", r"(\d+)", 1).cast("int"))
    keyed = keyed.join(years.select("y", "fy_id"), "y").withColumn(
        "period_id", F.regexp_extract("json", r'"selectedPeriod":"Q(\d)', 1).cast("bigint")
    )
    out = scratch(spark, "replies")
    A.store_replies(keyed.repartition("fy_id", "period_id"), out)
    return A.load_stored_aum(spark, out, plan, fetched_at="2024-12-01 00:00:00").select(*A.AUM_COLUMNS)


@register(
    "aum_distinct_sketches",
    f"""WITH {_AUM_SQL} SELECT COUNT(*) AS records, COUNT(DISTINCT scheme_code) AS schemes, COUNT(DISTINCT mf_name) AS amcs,
        TRUE AS schemes_within, TRUE AS amcs_within FROM aum""",
)
def q_aum_distinct_sketches(spark, sf_dir):
    """Sketches stored per year and period, merged on read, beside the exact counts they must be within 4 % of."""
    rows = A.flatten_aum(_order_replies(spark, sf_dir))
    out = scratch(spark, "sketches")
    W.write_parquet(A.distinct_sketches(rows, ["financial_year", "period"], ["scheme_code", "mf_name"]), out)
    about = A.merged_distinct(R.read_parquet(spark, out), ["scheme_code", "mf_name"]).select(
        "records", F.col("scheme_code").alias("_schemes"), F.col("mf_name").alias("_amcs")
    )
    exact = A.aum_summary(rows).select(F.col("records").alias("_records"), "schemes", "amcs")
    both = about.join(F.broadcast(exact), F.col("records") == F.col("_records"))  # one row each
    within = lambda a, b: F.abs(F.col(a) - F.col(b)) <= 0.04 * F.col(b)
    return both.select("records", "schemes", "amcs", within("_schemes", "schemes").alias("schemes_within"), within("_amcs", "amcs").alias("amcs_within"))


# --------------------------------------------------------------------------
# Bucketed analytics copy: KPIs over a table clustered by instrument
# --------------------------------------------------------------------------


@register("bucketed_fund_kpis", ORACLE["fund_kpis"])
def q_bucketed_fund_kpis(spark, sf_dir):
    """The daily series stored bucketed by supplier; the KPI plan then has no exchange."""
    out = scratch(spark, "bucketed")
    name = "fundspark_daily_" + out.rsplit("-", 1)[-1]
    table = W.write_bucketed_table(S.daily(spark, sf_dir), name, out, "scheme_code", 16, sort_by=["scheme_code", "date"])
    return r6(P.fund_kpis(table), KPI_DOUBLES)
