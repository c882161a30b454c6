"""Load planning: date chunks, missing weekdays, chunks still to land.

Plans are DataFrames, so they join with landed-file listings and scale
with them; nothing loops on the driver.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundspark.functions.dates import COMPACT_FORMAT, is_weekend, parse_date

# Chunk length and the name of a landed chunk file.
CHUNK_DAYS = 90
CHUNK_FILE_PREFIX = "amfi_raw_nav_"
CHUNK_FILE_SUFFIX = ".csv"


def _d(x):
    if isinstance(x, F.Column):
        return x
    return F.lit(str(x)).cast("date")


def date_chunks(ranges: DataFrame, start: str = "start_date", end: str = "end_date", days: int = CHUNK_DAYS) -> DataFrame:
    """Cut each (start, end) row into chunks of ``days`` days; the last is clipped to ``end``.

    Adds chunk_no (from 1), chunk_start, chunk_end and the chunk's file
    name (``amfi_raw_nav_<yyyyMMdd>_<yyyyMMdd>.csv``). Start after end gives no rows.
    """
    s, e = F.col(start), F.col(end)
    seq = F.when(s <= e, F.sequence(s, e, F.expr(f"INTERVAL {int(days)} DAYS")))
    out = ranges.select("*", F.posexplode(seq).alias("chunk_no", "chunk_start"))
    out = out.withColumn("chunk_no", F.col("chunk_no") + 1)
    out = out.withColumn("chunk_end", F.least(F.date_add("chunk_start", days - 1), e))
    name = F.concat(
        F.lit(CHUNK_FILE_PREFIX),
        F.date_format("chunk_start", "yyyyMMdd"),
        F.lit("_"),
        F.date_format("chunk_end", "yyyyMMdd"),
        F.lit(CHUNK_FILE_SUFFIX),
    )
    return out.withColumn("file_name", name)


def chunk_plan(spark, start, end, days: int = CHUNK_DAYS) -> DataFrame:
    """Chunks for one range given as dates or 'yyyy-MM-dd' text."""
    return date_chunks(spark.range(1).select(_d(start).alias("start_date"), _d(end).alias("end_date")), days=days).drop("id")


def chunk_dates(files: DataFrame, name: str = "file_name") -> DataFrame:
    """Add ``chunk_start`` and ``chunk_end`` as read off a chunk's file name (NULL when it is not one)."""
    shape = "^" + re.escape(CHUNK_FILE_PREFIX) + r"(\d{8})_(\d{8})" + re.escape(CHUNK_FILE_SUFFIX) + "$"
    part = lambda i: parse_date(F.nullif(F.regexp_extract(name, shape, i), F.lit("")), COMPACT_FORMAT)
    return files.withColumns({"chunk_start": part(1), "chunk_end": part(2)})


def pending_chunks(chunks: DataFrame, landed: DataFrame, file_col: str = "file_name", force: bool = False) -> DataFrame:
    """Chunks whose file has not landed (all of them with ``force``), with a state column."""
    landed_names = landed.select(F.col(file_col).alias("file_name")).distinct()
    if force:
        return chunks.withColumn("state", F.lit("pending"))
    marked = chunks.join(landed_names.withColumn("_landed", F.lit(True)), "file_name", "left")
    return marked.withColumn("state", F.when(F.col("_landed"), F.lit("skipped")).otherwise(F.lit("pending"))).drop("_landed")


def chunk_status(plan: DataFrame) -> DataFrame:
    """Totals of a marked plan: total, skipped (already landed) and pending."""
    st = F.col("state")
    return plan.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(st == "skipped").alias("skipped"),
        F.count_if(st == "pending").alias("pending"),
    )


# A ledger row: one attempt to fetch a chunk, never changed once written.
ATTEMPT_COLUMNS = ["file_name", "attempted_at", "attempt", "outcome", "message"]
OUTCOMES = ("fetched", "failed")


def record_attempts(attempts: DataFrame, path: str) -> None:
    """Append attempts to the ledger stored under ``path`` (Parquet). Rows are only ever added."""
    attempts.select(*ATTEMPT_COLUMNS).write.mode("append").parquet(path)


def last_attempts(attempts: DataFrame) -> DataFrame:
    """Per file: the outcome and message of its latest attempt, and the numbers of attempts and failures.

    Later means a later ``attempted_at``, then a larger ``attempt`` number,
    then the outcome in text order. One partial aggregate, so a file
    retried without end sends one row per task. A row written twice
    (a repeated append) counts once.
    """
    latest = F.struct("attempted_at", "attempt", "outcome", "message")
    once = attempts.select(*ATTEMPT_COLUMNS).distinct()
    return once.groupBy("file_name").agg(
        F.max(latest).alias("_last"),
        F.count(F.lit(1)).alias("attempts"),
        F.count_if(F.col("outcome") == "failed").alias("failures"),
    ).select("file_name", "attempts", "failures", *[F.col(f"_last.{c}").alias(c) for c in ATTEMPT_COLUMNS[1:] if c != "attempt"])


def chunk_ledger(chunks: DataFrame, attempts: DataFrame, landed: DataFrame | None = None, force: bool = False) -> DataFrame:
    """Every planned chunk with its state after a run.

    ``skipped``: its file had landed before (not with ``force``);
    ``fetched`` / ``failed``: the outcome of its latest attempt;
    ``pending``: not tried yet. Attempts on files outside the plan play no part.
    """
    plan = chunks if landed is None else pending_chunks(chunks, landed, force=force)
    skipped = F.col("state") == "skipped" if landed is not None and not force else F.lit(False)
    done = last_attempts(attempts)
    joined = plan.join(done.drop("message"), "file_name", "left")
    state = F.when(skipped, F.lit("skipped")).otherwise(F.coalesce(F.col("outcome"), F.lit("pending")))
    count = lambda c: F.when(skipped, F.lit(0)).otherwise(F.coalesce(F.col(c), F.lit(0))).cast("bigint")
    return joined.withColumns(
        {"state": state, "attempts": count("attempts"), "failures": count("failures")}
    ).drop("outcome")


def ledger_status(ledger: DataFrame) -> DataFrame:
    """Totals of a run: total, skipped, fetched, failed and pending chunks, attempts, and whether none failed."""
    st = F.col("state")
    return ledger.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(st == s).alias(s) for s in ("skipped", "fetched", "failed", "pending")],
        F.coalesce(F.sum("attempts"), F.lit(0)).cast("bigint").alias("attempts"),
    ).withColumn("success", F.col("failed") == 0)


def latest_date(stored: DataFrame, date: str = "date") -> DataFrame:
    """One row: the latest stored date (NULL when the table is empty)."""
    return stored.agg(F.max(date).alias("latest_date"))


def missing_dates(stored: DataFrame, as_of, date: str = "date", holidays: DataFrame | None = None) -> DataFrame:
    """Weekdays after the latest stored date up to ``as_of``; with no history, ``as_of`` alone.

    ``holidays`` (a ``date`` column) are removed by an anti join.
    """
    d = _d(as_of)
    latest = latest_date(stored, date)
    nxt = F.date_add("latest_date", 1)
    days = (
        F.when(F.col("latest_date").isNull(), F.array(d))
        .when(nxt <= d, F.sequence(nxt, d))
        .otherwise(F.array().cast("array<date>"))
    )
    out = latest.select(F.col("latest_date"), F.explode(days).alias("date"))
    out = out.filter(F.col("latest_date").isNull() | ~is_weekend("date")).select("date")
    if holidays is not None:
        out = out.join(holidays.select("date"), "date", "left_anti")
    return out


def gap_dates(stored: DataFrame, start, end, date: str = "date", weekdays_only: bool = True) -> DataFrame:
    """Calendar days in [start, end] with no stored row (weekends left out by default).

    The stored side is reduced to its distinct dates (a calendar, a few
    thousand rows) before the anti join.
    """
    cal = stored.sparkSession.range(1).select(F.explode(F.sequence(_d(start), _d(end))).alias("date"))
    if weekdays_only:
        cal = cal.filter(~is_weekend("date"))
    present = stored.select(F.col(date).alias("date")).distinct()
    return cal.join(present, "date", "left_anti")
