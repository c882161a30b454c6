"""Bind the generic operators to the driver's test tables.

The test tables hold no fund data, so each fund concept gets a stand-in
derived by Spark from the given tables (the work grows with them):

* ``daily``: lineitem per (l_suppkey, ship date) with the minimum extended
  price as the value -> (scheme_code, date, nav), unique per key and date.
* ``events`` per (user_id, day) -> (scheme_code, date) for completeness.
* ``supplier`` / ``nation`` -> fund metadata with the nation as category.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(scheme_code bigint, date date, nav double), one row per key and date."""
    li = table(spark, sf_dir, "lineitem")
    return li.groupBy(
        F.col("l_suppkey").alias("scheme_code"), F.to_date("l_shipdate").alias("date")
    ).agg(F.min("l_extendedprice").alias("nav"))


DAILY_SQL = """
    SELECT l_suppkey AS scheme_code, CAST(l_shipdate AS DATE) AS date, MIN(l_extendedprice) AS nav
    FROM lineitem GROUP BY 1, 2
"""


def nav_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw price rows with repeats: (scheme_code, date, nav) straight from lineitem."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_suppkey").alias("scheme_code"),
        F.to_date("l_shipdate").alias("date"),
        F.col("l_extendedprice").alias("nav"),
    )


NAV_RAW_SQL = """
    SELECT l_suppkey AS scheme_code, CAST(l_shipdate AS DATE) AS date, l_extendedprice AS nav
    FROM lineitem
"""


def event_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(scheme_code, date) from events: user as the key, event day as the date."""
    ev = table(spark, sf_dir, "events")
    return ev.select(F.col("user_id").alias("scheme_code"), F.to_date("ts").alias("date"))


EVENT_DAYS_SQL = "SELECT user_id AS scheme_code, CAST(ts AS DATE) AS date FROM events"


def fund_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Supplier as fund: (scheme_code, scheme_name, scheme_category, amc_name)."""
    s = table(spark, sf_dir, "supplier")
    n = table(spark, sf_dir, "nation")
    return s.join(n, s.s_nationkey == n.n_nationkey, "inner").select(
        F.col("s_suppkey").alias("scheme_code"),
        F.col("s_name").alias("scheme_name"),
        F.col("n_name").alias("scheme_category"),
        F.concat(F.lit("AMC_"), F.col("n_regionkey").cast("string")).alias("amc_name"),
    )


FUND_INFO_SQL = """
    SELECT s_suppkey AS scheme_code, s_name AS scheme_name, n_name AS scheme_category,
           'AMC_' || CAST(n_regionkey AS VARCHAR) AS amc_name
    FROM supplier JOIN nation ON s_nationkey = n_nationkey
"""


# --------------------------------------------------------------------------
# Raw metadata text from part (headers as in the source's scheme list)
# --------------------------------------------------------------------------

# Test-binding rules: the part table has no fund words, so the keyword and
# literal lists (parameters of the operators) are bound to its vocabulary.
PART_LEVEL1_RULES = [
    ("economy", "Equity Scheme"),
    ("small", "Debt Scheme"),
    ("promo", "Hybrid Scheme"),
    ("standard", "Other Scheme"),
]
PART_DIRECT = ["red", "blue "]
PART_GROWTH = ["ring", "gear", " bolt"]
PART_NON_GROWTH = ["hot"]


def part_metadata_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scheme-list text rows derived from part: every value a string, some deliberately bad."""
    p = table(spark, sf_dir, "part")
    size, key = F.col("p_size"), F.col("p_partkey")
    launch = F.make_date((1990 + size % 30).cast("int"), (1 + key % 12).cast("int"), (1 + key % 28).cast("int"))
    category = (
        F.when(size % 10 == 0, F.col("p_type"))
        .when(size % 10 == 1, F.concat(F.col("p_type"), F.lit(" - na")))
        .when(size % 10 == 2, F.concat(F.lit(" "), F.col("p_type"), F.lit(" - ")))
        .otherwise(F.concat(F.col("p_type"), F.lit(" - "), F.col("p_name")))
    )
    return p.select(
        F.col("p_brand").alias("AMC"),
        key.cast("string").alias("Code"),
        F.concat(F.lit(" "), F.col("p_name"), F.lit(" ")).alias("Scheme Name"),
        F.when(size > 25, F.lit("Close Ended")).otherwise(F.lit("Open Ended")).alias("Scheme Type"),
        category.alias("Scheme Category"),
        F.concat(F.col("p_name"), F.lit(" - "), F.col("p_brand")).alias("Scheme NAV Name"),
        F.when(size % 7 == 0, F.concat(F.lit("Rs. "), (size * 500).cast("string")))
        .otherwise((size * 500).cast("string"))
        .alias("Scheme Minimum Amount"),
        F.when(size % 3 == 0, F.date_format(launch, "dd-MMM-yyyy"))
        .when(size % 3 == 1, F.date_format(launch, "dd/MM/yyyy"))
        .otherwise(F.lit("x"))
        .alias("Launch Date"),
        F.when(size > 45, F.date_format(launch, "yyyy-MM-dd")).alias("Closure Date"),
        F.concat(F.lit("INF"), key.cast("string")).alias("ISIN Div Payout/ ISIN Growth"),
        F.lit(None).cast("string").alias("ISIN Div Reinvestment"),
    )


PART_METADATA_RAW_SQL = """
    SELECT p_brand AS "AMC", CAST(p_partkey AS VARCHAR) AS "Code",
           ' ' || p_name || ' ' AS "Scheme Name",
           CASE WHEN p_size > 25 THEN 'Close Ended' ELSE 'Open Ended' END AS "Scheme Type",
           CASE WHEN p_size % 10 = 0 THEN p_type WHEN p_size % 10 = 1 THEN p_type || ' - na'
                WHEN p_size % 10 = 2 THEN ' ' || p_type || ' - ' ELSE p_type || ' - ' || p_name END AS "Scheme Category",
           p_name || ' - ' || p_brand AS "Scheme NAV Name",
           CASE WHEN p_size % 7 = 0 THEN 'Rs. ' || CAST(p_size * 500 AS VARCHAR) ELSE CAST(p_size * 500 AS VARCHAR) END
             AS "Scheme Minimum Amount",
           CASE WHEN p_size % 3 = 0 THEN strftime(make_date(1990 + p_size % 30, 1 + p_partkey % 12, 1 + p_partkey % 28), '%d-%b-%Y')
                WHEN p_size % 3 = 1 THEN strftime(make_date(1990 + p_size % 30, 1 + p_partkey % 12, 1 + p_partkey % 28), '%d/%m/%Y')
                ELSE 'x' END AS "Launch Date",
           CASE WHEN p_size > 45 THEN strftime(make_date(1990 + p_size % 30, 1 + p_partkey % 12, 1 + p_partkey % 28), '%Y-%m-%d') END
             AS "Closure Date",
           'INF' || CAST(p_partkey AS VARCHAR) AS "ISIN Div Payout/ ISIN Growth",
           CAST(NULL AS VARCHAR) AS "ISIN Div Reinvestment"
    FROM part
"""


def part_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fundspark.operators.metadata import clean_scheme_metadata

    return clean_scheme_metadata(
        part_metadata_raw(spark, sf_dir),
        level1_rules=PART_LEVEL1_RULES,
        direct=PART_DIRECT,
        growth=PART_GROWTH,
        non_growth=PART_NON_GROWTH,
    )


def _sql_contains_any(expr: str, literals) -> str:
    return "(" + " OR ".join(f"contains({expr}, '{x}')" for x in literals) + ")"


def _sql_level1(expr: str) -> str:
    whens = " ".join(f"WHEN contains({expr}, '{k}') THEN '{v}'" for k, v in PART_LEVEL1_RULES)
    return f"CASE {whens} ELSE 'Others' END"


_HEAD = "lower(trim(split_part(COALESCE(scheme_category, ''), ' - ', 1)))"
_TAIL = "trim(CASE WHEN contains(COALESCE(scheme_category, ''), ' - ') THEN substr(scheme_category, strpos(scheme_category, ' - ') + 3) END)"
_NAME = "lower(COALESCE(scheme_nav_name, ''))"

PART_METADATA_SQL = f"""
  raw AS ({PART_METADATA_RAW_SQL}),
  typed AS (
    SELECT NULLIF(trim("AMC"), '') AS amc_name, trim("Code") AS scheme_code,
           NULLIF(trim("Scheme Name"), '') AS scheme_name, NULLIF(trim("Scheme Type"), '') AS scheme_type,
           NULLIF(trim("Scheme Category"), '') AS scheme_category, NULLIF(trim("Scheme NAV Name"), '') AS scheme_nav_name,
           CASE WHEN regexp_matches(trim("Scheme Minimum Amount"), '^[+-]?(\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?$')
                THEN TRY_CAST(trim("Scheme Minimum Amount") AS DOUBLE) END AS minimum_amount,
           CAST(COALESCE(try_strptime(trim("Launch Date"), '%d-%b-%Y'), try_strptime(trim("Launch Date"), '%d/%m/%Y'),
                         try_strptime(trim("Launch Date"), '%d-%m-%Y'), try_strptime(trim("Launch Date"), '%Y-%m-%d')) AS DATE) AS launch_date,
           CAST(COALESCE(try_strptime(trim("Closure Date"), '%d-%b-%Y'), try_strptime(trim("Closure Date"), '%d/%m/%Y'),
                         try_strptime(trim("Closure Date"), '%d-%m-%Y'), try_strptime(trim("Closure Date"), '%Y-%m-%d')) AS DATE) AS closure_date,
           "ISIN Div Payout/ ISIN Growth" AS isin_growth, "ISIN Div Reinvestment" AS isin_dividend
    FROM raw),
  lv AS (SELECT *, {_sql_level1(_HEAD)} AS scheme_category_level1 FROM typed),
  meta AS (
    SELECT *,
      CASE WHEN contains(COALESCE(scheme_category, ''), ' - ')
           THEN COALESCE(CASE WHEN {_TAIL} IN ('', 'error', 'null', 'na') THEN NULL ELSE {_TAIL} END, scheme_category_level1)
           ELSE COALESCE(scheme_category, 'Others') END AS scheme_category_level2,
      {_sql_contains_any(_NAME, PART_DIRECT)} AS is_direct,
      {_sql_contains_any(_NAME, PART_GROWTH)} AND NOT {_sql_contains_any(_NAME, PART_NON_GROWTH)} AS is_growth_plan
    FROM lv)"""


# --------------------------------------------------------------------------
# Master snapshots from orders per customer
# --------------------------------------------------------------------------

# Orders are cut at one date inside the table: the snapshot before it, the snapshot from it on, and all of them.
MASTER_CUT = "2001-07-10"


def customer_snapshot(spark: SparkSession, sf_dir: str, which: str) -> DataFrame:
    """A customer's orders of one priority as an instrument; ``which``: existing (before the cut), latest
    (from the cut on) or all. Launch is the first order of the snapshot."""
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer")
    d, cut = F.to_date("o_orderdate"), F.lit(MASTER_CUT).cast("date")
    held = {"existing": d < cut, "latest": d >= cut, "all": F.lit(True)}[which]
    per = (
        o.filter(held)
        .groupBy("o_custkey", "o_orderpriority")
        .agg(F.min(d).alias("launch_date"), F.count(F.lit(1)).alias("orders_in_window"))
    )
    return per.join(c, per.o_custkey == c.c_custkey, "inner").select(
        (F.col("c_custkey") * 10 + F.substring("o_orderpriority", 1, 1).cast("bigint")).alias("scheme_code"),
        F.concat("c_name", F.lit(" "), "o_orderpriority").alias("scheme_name"),
        F.col("c_mktsegment").alias("amc_name"),
        "launch_date",
        "orders_in_window",
    )


def customer_snapshot_sql(which: str) -> str:
    held = {"existing": f"< DATE '{MASTER_CUT}'", "latest": f">= DATE '{MASTER_CUT}'", "all": "IS NOT NULL"}[which]
    return f"""
    SELECT c_custkey * 10 + CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS scheme_code,
           c_name || ' ' || o_orderpriority AS scheme_name, c_mktsegment AS amc_name, launch_date, orders_in_window
    FROM (SELECT o_custkey, o_orderpriority, MIN(CAST(o_orderdate AS DATE)) AS launch_date, COUNT(*) AS orders_in_window
          FROM orders WHERE CAST(o_orderdate AS DATE) {held}
          GROUP BY o_custkey, o_orderpriority) p
    JOIN customer ON p.o_custkey = c_custkey"""


def lineitem_report_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as price-report text: supplier as the code, ship date as 'dd-MMM-yyyy', price as text."""
    li = table(spark, sf_dir, "lineitem")
    cents = F.floor(F.col("l_extendedprice") * 100).cast("bigint")
    price = F.concat((cents / 100).cast("bigint").cast("string"), F.lit("."), F.lpad((cents % 100).cast("string"), 2, "0"))
    return li.select(
        F.col("l_suppkey").cast("string").alias("Scheme Code"),
        F.concat(F.lit("INF"), F.col("l_partkey").cast("string")).alias("ISIN Div Payout/ISIN Growth"),
        F.lit("-").alias("ISIN Div Reinvestment"),
        price.alias("Net Asset Value"),
        F.date_format("l_shipdate", "dd-MMM-yyyy").alias("Date"),
    )


# --------------------------------------------------------------------------
# Stand-ins shared by several query modules
# --------------------------------------------------------------------------

ORDERS_SERIES_SQL = (
    "SELECT o_custkey AS scheme_code, CAST(o_orderdate AS DATE) AS date, o_totalprice AS nav FROM orders"
)


def orders_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a price series: customer as the key, order day as the date, total as the value."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_custkey").alias("scheme_code"), F.to_date("o_orderdate").alias("date"), F.col("o_totalprice").alias("nav")
    )


def daily_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """KPIs of every supplier's daily series."""
    from fundspark.operators.performance import fund_kpis

    return fund_kpis(daily(spark, sf_dir))


EVENT_VALUES_SQL = "SELECT user_id AS scheme_code, CAST(ts AS DATE) AS date, MIN(value) AS nav FROM events GROUP BY 1, 2"


def event_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(scheme_code, date, nav): the smallest event value per user and day."""
    ev = table(spark, sf_dir, "events")
    return ev.groupBy(F.col("user_id").alias("scheme_code"), F.to_date("ts").alias("date")).agg(F.min("value").alias("nav"))


def events_report_text(spark: SparkSession, sf_dir: str, day: str | None = None) -> DataFrame:
    """Events as price-report text with bad values: N.A. and missing prices, upper-case and impossible dates.
    ``day`` adds the event's day of the month under that name."""
    ev = table(spark, sf_dir, "events")
    cents = F.floor(F.col("value") * 100).cast("bigint")
    value_text = F.concat((cents / 100).cast("bigint").cast("string"), F.lit("."), F.lpad((cents % 100).cast("string"), 2, "0"))
    more = [F.day("ts").alias(day)] if day else []
    day = F.date_format("ts", "dd-MMM-yyyy")
    et = F.col("event_type")
    return ev.select(
        *more,
        F.col("user_id").cast("string").alias("Scheme Code"),
        F.concat(F.lit("INF"), et).alias("ISIN Div Payout/ISIN Growth"),
        F.lit("-").alias("ISIN Div Reinvestment"),
        F.when(et == "error", F.lit("N.A.")).when(et == "signup", F.lit(None)).otherwise(value_text).alias("Net Asset Value"),
        F.when(et == "click", F.upper(day)).when(et == "purchase", F.lit("31-Feb-2024")).otherwise(day).alias("Date"),
    )


EVENTS_REPORT_SQL = """
    SELECT CAST(user_id AS VARCHAR) AS "Scheme Code", 'INF' || event_type AS "ISIN Div Payout/ISIN Growth",
           '-' AS "ISIN Div Reinvestment",
           CASE WHEN event_type = 'error' THEN 'N.A.' WHEN event_type = 'signup' THEN NULL
                ELSE CAST(CAST(floor(value * 100) AS BIGINT) // 100 AS VARCHAR) || '.' ||
                     lpad(CAST(CAST(floor(value * 100) AS BIGINT) % 100 AS VARCHAR), 2, '0') END AS "Net Asset Value",
           CASE WHEN event_type = 'click' THEN upper(strftime(ts, '%d-%b-%Y')) WHEN event_type = 'purchase' THEN '31-Feb-2024'
                ELSE strftime(ts, '%d-%b-%Y') END AS "Date"
    FROM events"""
