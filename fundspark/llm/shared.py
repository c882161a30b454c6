"""Helpers shared by the operators: tables kept in the cluster's shared folder, scalable ranking."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, as the cluster names it in ``spark.checkpoint.dir``; none is made up."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        raise RuntimeError("spark.checkpoint.dir is not set; a folder that all executors share is required")
    return folder.rstrip("/")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: later plans start from
    those files, so a lost executor costs nothing and their size is known to the planner."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm-{uuid.uuid4().hex}-{name}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_width(spark: SparkSession, needed: int = 1) -> int:
    """Partitions for a shuffle: the session's setting, or more if the data need more."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(needed), 1)


def ranked(
    df: DataFrame, keys: list[str], order: list[str], size: Column | None = None, chunks: int = 64, chunk: Column | None = None
) -> DataFrame:
    """Add ``_rank`` (0-based position within ``keys``) and ``_before`` (sum of ``size`` of the rows
    ahead), in the order (chunk, ``order``), where the chunk is a hash of ``order`` unless given (for
    a rank in ``order`` itself, one that never falls along it).

    A key that holds a third of all rows is ranked in ``chunks`` independent windows; the offsets
    come from one row per (key, chunk).
    """
    size = F.lit(0).cast("long") if size is None else size.cast("long")
    chunk = F.pmod(F.xxhash64(*order), F.lit(chunks)) if chunk is None else chunk
    rows = df.withColumns({"_chunk": chunk, "_size": size})
    within = Window.partitionBy(*keys, "_chunk").orderBy(*order)
    ahead = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy(*keys, "_chunk").agg(F.count(F.lit(1)).alias("_n"), F.sum("_size").alias("_s"))
    offsets = sums.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
        F.col("_chunk").alias("_c"),
        F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_n0"),
        F.coalesce(F.sum("_s").over(ahead), F.lit(0)).alias("_s0"),
    )
    local = rows.withColumns(
        {
            "_r": F.row_number().over(within) - 1,
            "_b": F.coalesce(F.sum("_size").over(within.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        }
    )
    on = F.col("_chunk") == F.col("_c")
    for i, k in enumerate(keys):
        on = on & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return local.join(offsets, on).select(
        *df.columns, (F.col("_r") + F.col("_n0")).alias("_rank"), (F.col("_b") + F.col("_s0")).alias("_before")
    )
