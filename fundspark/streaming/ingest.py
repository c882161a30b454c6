"""Incremental price ingest with Structured Streaming.

Each micro-batch names the newly landed report files; they are read once,
with their own headers, cleaned, reduced to distinct rows, joined with
growth-plan metadata and stored where the date-partitioned table does not
hold the row yet. Dates may arrive in any order: no watermark drops them.

The stored rows of a batch live in partitions of their own
(``date`` / ``ingest_batch``, the batch's key being the query's id and the
batch number). A batch that is run again after a crash, whatever part of it
had been written, is worked out against the rows of *other* batches and
replaces its own partitions: it neither doubles rows nor loses any. The
stream's checkpoint lives in the cluster's shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fundspark.operators.nav import ENRICH_COLUMNS, NAV_COLUMNS, clean_nav
from fundspark.session import checkpoint_dir
from fundspark.sources.readers import read_csv_glob

CLEAN_COLUMNS = ["scheme_code", "isin_growth", "isin_dividend", "nav", "date"]
BATCH = "ingest_batch"
FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"


def landed_files(spark: SparkSession, landing: str, max_files: int | None = None) -> DataFrame:
    """The paths of newly landed files, as a stream: files are listed, their contents not read."""
    r = spark.readStream.format("binaryFile").schema(FILE_SCHEMA)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.load(landing).select("path")


def new_rows(
    spark: SparkSession,
    paths: list[str],
    meta: DataFrame,
    target: str,
    sep: str = ";",
    key: str = "scheme_code",
    batch: str | None = None,
) -> DataFrame:
    """Distinct enriched rows of the files that no other batch has stored, on the dates they touch."""
    clean = clean_nav(read_csv_glob(spark, paths, NAV_COLUMNS, sep=sep)).filter(F.col("nav").isNotNull()).distinct()
    try:
        stored = spark.read.parquet(target)
    except Exception as exc:  # first run: nothing is stored
        if "PATH_NOT_FOUND" not in str(exc) and "UNABLE_TO_INFER_SCHEMA" not in str(exc):
            raise
    else:
        if batch is not None and BATCH in stored.columns:
            stored = stored.filter(F.col(BATCH) != batch)  # prunes the batch's own partitions
        old, same = stored.select(*CLEAN_COLUMNS).alias("old"), None
        for c in CLEAN_COLUMNS:
            on = F.col(f"new.{c}").eqNullSafe(F.col(f"old.{c}"))
            same = on if same is None else same & on
        # Dates are partitions of the table: the join prunes the scan to those the batch holds. Rows whose
        # date did not parse are a partition of their own, which no join on the date would find.
        touched = clean.select("date").distinct()
        held = old.join(touched, "date", "left_semi").unionByName(old.filter("date is null"))
        clean = clean.alias("new").join(held.alias("old"), same, "left_anti")
    growth = meta.filter(F.col("is_growth_plan")).select(key, *[c for c in ENRICH_COLUMNS if c != key])
    return clean.join(growth, key, "inner")


def store_batch(spark: SparkSession, paths: list[str], meta: DataFrame, target: str, batch: str, sep: str = ";") -> None:
    """Store a batch of files under its key. Running it again replaces exactly what it stored."""
    rows = new_rows(spark, paths, meta, target, sep=sep, batch=batch).withColumn(BATCH, F.lit(batch))
    w = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    w.partitionBy("date", BATCH).parquet(target)


def start_ingest(
    spark: SparkSession,
    landing: str,
    meta: DataFrame,
    target: str,
    name: str = "nav_ingest",
    available_now: bool = True,
    max_files: int | None = None,
    interval: str = "1 minute",
) -> StreamingQuery:
    """Start the ingest; with ``available_now`` it processes what has landed, then stops.

    ``max_files`` bounds the files per micro-batch (a backlog is split into
    several batches); ``interval`` is the trigger period of a continuous run.
    """

    def store(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        paths = sorted(r["path"] for r in batch.distinct().collect())  # one per file of the batch
        if paths:
            # The id belongs to the checkpoint: a restart goes on with it, a new checkpoint has another.
            query = session.sparkContext.getLocalProperty("sql.streaming.queryId")
            store_batch(session, paths, meta, target, f"{query}-{number}")

    ckpt = f"{checkpoint_dir(spark).rstrip('/')}/{name}"
    w = landed_files(spark, landing, max_files).writeStream.option("checkpointLocation", ckpt).queryName(name).foreachBatch(store)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=interval)
    return w.start()
