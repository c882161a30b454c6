"""Assets under management: nested JSON replies -> flat rows, request plan, summary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fundspark.functions.joins import broadcast_if_small

PLAN_ROWS = 100_000  # a request plan beyond this is shuffled
# Fixed field names of the replies.
AUM_EXCL_FOF = "ExcludingFundOfFundsDomesticButIncludingFundOfFundsOverseas"
AUM_FOF_DOMESTIC = "FundOfFundsDomestic"

SCHEME = T.StructType(
    [
        T.StructField("AMFI_Code", T.StringType()),
        T.StructField("SchemeNAVName", T.StringType()),
        T.StructField(
            "AverageAumForTheMonth",
            T.StructType([T.StructField(AUM_EXCL_FOF, T.DoubleType()), T.StructField(AUM_FOF_DOMESTIC, T.DoubleType())]),
        ),
    ]
)
FUND_HOUSE = T.StructType(
    [
        T.StructField("Mfname", T.StringType()),
        T.StructField("SchemeType_Desc", T.StringType()),
        T.StructField("schemes", T.ArrayType(SCHEME)),
    ]
)
# A data reply: ``data`` is an array of fund houses.
DATA_REPLY = T.StructType([T.StructField("selectedPeriod", T.StringType()), T.StructField("data", T.ArrayType(FUND_HOUSE))])
# A mapping reply: ``data`` is an object holding the periods.
MAPPING_REPLY = T.StructType(
    [
        T.StructField(
            "years",
            T.ArrayType(T.StructType([T.StructField("id", T.LongType()), T.StructField("financial_year", T.StringType())])),
        ),
        T.StructField("data", T.StructType([T.StructField("periods", T.ArrayType(T.StructType([T.StructField("id", T.LongType())])))])),
    ]
)

AUM_COLUMNS = [
    "scheme_code", "scheme_name", "mf_name", "scheme_type",
    "aum_excl_fof", "aum_fof_domestic", "financial_year", "period",
]


def parse_replies(df: DataFrame, text: str = "json", schema: T.StructType = DATA_REPLY, out: str = "reply") -> DataFrame:
    """JSON text column -> struct column with a fixed schema (no inference)."""
    return df.withColumn(out, F.from_json(F.col(text), schema))


def flatten_aum(replies: DataFrame, fy_label: str = "financial_year", period_label: str = "period", reply: str = "reply") -> DataFrame:
    """Two inner explodes: fund houses, then their schemes; a house without schemes gives no row.

    Missing texts become '' and missing amounts 0.0; the period label is
    the reply's ``selectedPeriod`` unless the ``period_label`` column is given.
    """
    period = F.col(period_label) if period_label in replies.columns else F.col(f"{reply}.selectedPeriod")
    h = replies.select(F.col(fy_label).alias("financial_year"), period.alias("period"), F.explode(f"{reply}.data").alias("h"))
    s = h.select("financial_year", "period", "h.Mfname", "h.SchemeType_Desc", F.explode("h.schemes").alias("s"))
    aum = F.col("s.AverageAumForTheMonth")
    return s.select(
        F.coalesce(F.col("s.AMFI_Code"), F.lit("")).alias("scheme_code"),
        F.coalesce(F.col("s.SchemeNAVName"), F.lit("")).alias("scheme_name"),
        F.coalesce(F.col("Mfname"), F.lit("")).alias("mf_name"),
        F.coalesce(F.col("SchemeType_Desc"), F.lit("")).alias("scheme_type"),
        F.coalesce(aum[AUM_EXCL_FOF], F.lit(0.0)).alias("aum_excl_fof"),
        F.coalesce(aum[AUM_FOF_DOMESTIC], F.lit(0.0)).alias("aum_fof_domestic"),
        "financial_year",
        "period",
    )


def request_plan(
    label_reply: DataFrame,
    period_replies: DataFrame,
    num_years: int,
    specific_fy: int | None = None,
    specific_period: int | None = None,
) -> DataFrame:
    """(fy_id, financial_year, period_id) to load.

    ``label_reply``: one parsed mapping reply (column ``reply``) holding the
    year labels; ``period_replies``: (fy_id, reply) mapping replies holding
    each year's periods. Years without a label or without periods, and a
    requested period a year does not offer, are skipped by inner joins.
    """
    spark = label_reply.sparkSession
    ids = [specific_fy] if specific_fy is not None else list(range(1, num_years + 1))
    wanted = spark.range(1).select(F.explode(F.array(*[F.lit(int(i)).cast("bigint") for i in ids])).alias("fy_id"))
    labels = label_reply.select(F.explode("reply.years").alias("y")).select(
        F.col("y.id").alias("fy_id"), F.col("y.financial_year").alias("financial_year")
    )
    labels = labels.filter(F.col("financial_year").isNotNull() & (F.col("financial_year") != ""))
    periods = period_replies.select("fy_id", F.explode("reply.data.periods").alias("p")).select(
        "fy_id", F.col("p.id").alias("period_id")
    )
    if specific_period is not None:
        periods = periods.filter(F.col("period_id") == int(specific_period))
    return wanted.join(labels, "fy_id").join(periods, "fy_id")


def load_aum(plan: DataFrame, data_replies: DataFrame, fetched_at=None) -> DataFrame:
    """Planned (fy_id, period_id) ⋈ landed data replies -> flat rows with a load time.

    A planned pair without a reply (or a reply without ``data``) is skipped;
    the period label falls back to 'Period <id>'. For replies stored by
    ``store_replies``, ``load_stored_aum`` reads only the planned ones.
    """
    return _flat_with_period(plan.join(data_replies, ["fy_id", "period_id"], "inner"), fetched_at)


def store_replies(replies: DataFrame, path: str, mode: str = "append") -> None:
    """Land data replies (``fy_id``, ``period_id``, ``json`` text) in folders by year and period id.

    The text is stored as it came; nothing is parsed before it is asked for.
    """
    out = replies.select("json", "fy_id", "period_id")
    out.write.mode(mode).partitionBy("fy_id", "period_id").parquet(path)


def load_stored_aum(spark, path: str, plan: DataFrame, fetched_at=None) -> DataFrame:
    """The planned replies among those under ``path`` -> flat rows, as ``load_aum``.

    The plan (years x periods) is broadcast behind a bounded count; it is joined on
    the folder columns, so dynamic partition pruning lists and reads only
    the planned folders, and the JSON of a reply is parsed after the join:
    replies nobody asked for cost nothing. Years without a label are
    skipped, as in ``request_plan`` (and the planner prunes only by a side
    that has a filter).
    """
    plan = plan.filter(F.col("financial_year") != "")
    stored = spark.read.schema("json string, fy_id bigint, period_id bigint").parquet(path)
    wanted = stored.join(broadcast_if_small(plan, PLAN_ROWS), ["fy_id", "period_id"], "inner")
    # A filter on the text's contents would be pushed below the join, with its parsing; a row made of
    # both sides is parsed where it is made.
    whole = wanted.withColumn("json", F.when(F.col("financial_year") != "", F.col("json")))
    return _flat_with_period(parse_replies(whole), fetched_at)


def _flat_with_period(replies: DataFrame, fetched_at) -> DataFrame:
    named = replies.filter(F.col("reply.data").isNotNull()).withColumn(
        "period", F.coalesce(F.col("reply.selectedPeriod"), F.concat(F.lit("Period "), F.col("period_id").cast("string")))
    )
    ts = F.current_timestamp() if fetched_at is None else F.lit(fetched_at).cast("timestamp")
    return flatten_aum(named).withColumn("fetched_at", ts)


def distinct_sketches(rows: DataFrame, by: list[str], columns: list[str], lg_size: int = 14) -> DataFrame:
    """Per group of ``by``: row count and one HyperLogLog sketch per column, to be stored and merged later.

    A sketch has a fixed size (2^lg_size registers), so a group's row stays small
    however many values it saw, and new days only add rows.
    """
    return rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("records"), *[F.hll_sketch_agg(c, lg_size).alias(f"{c}_sketch") for c in columns]
    )


def merged_distinct(sketches: DataFrame, columns: list[str], by: list[str] | None = None) -> DataFrame:
    """Rows and approximate distinct counts from stored sketches, over all groups or per ``by``.

    The relative standard error is about 1.04 / sqrt(2^lg_size): 0.8 % at the default size.
    """
    return sketches.groupBy(*(by or [])).agg(
        F.sum("records").cast("bigint").alias("records"),
        *[F.hll_sketch_estimate(F.hll_union_agg(f"{c}_sketch")).alias(c) for c in columns],
    )


def aum_summary(rows: DataFrame) -> DataFrame:
    """Rows, distinct schemes, fund houses and (year, period) pairs in one aggregate."""
    return rows.agg(
        F.count(F.lit(1)).alias("records"),
        F.countDistinct("scheme_code").alias("schemes"),
        F.countDistinct("mf_name").alias("amcs"),
        F.countDistinct("financial_year", "period").alias("fy_periods"),
    )


def aum_rows_per_year(rows: DataFrame) -> DataFrame:
    return rows.groupBy("financial_year").agg(F.count(F.lit(1)).alias("records"))
