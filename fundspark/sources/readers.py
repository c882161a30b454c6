"""Sources: landed text reports, CSV, Parquet, table formats, JSON replies, file listings.

Raw text is always read as strings (no inference) and typed by the
operators with ``try_*`` parsing, so one bad value never fails a job.
"""

from __future__ import annotations

import csv
from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fundspark.functions.text import null_tokens

# Text that pandas' CSV reader treats as missing by default.
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]
METADATA_FILE_GLOB = "scheme_metadata_*.csv"
ZONES = ("raw", "clean", "metadata", "aum")


def storage_path(base: str, zone: str, name: str, ext: str = "parquet") -> str:
    """``<base>/<zone>/<name>.<ext>``; object-store credentials belong to ``spark.hadoop.fs.*``."""
    return f"{base.rstrip('/')}/{zone}/{name}.{ext}" if ext else f"{base.rstrip('/')}/{zone}/{name}"


def na_tokens_to_null(df: DataFrame, tokens=NA_TOKENS) -> DataFrame:
    """Every string column: a missing-value token becomes NULL."""
    cols = {f.name: null_tokens(F.col(f"`{f.name}`"), tokens) for f in df.schema if isinstance(f.dataType, T.StringType)}
    return df.withColumns(cols) if cols else df


def read_nav_report(spark: SparkSession, path: str, sep: str = ";") -> DataFrame:
    """Separator-delimited report with a header, all columns as strings.

    Section-heading lines (one field) become rows padded with NULLs and are
    dropped by ``clean_nav``'s NULL filter; blank lines are skipped.
    """
    return (
        spark.read.option("header", True)
        .option("sep", sep)
        .option("mode", "PERMISSIVE")
        .option("inferSchema", False)
        .csv(path)
    )


def check_batch(df: DataFrame, min_columns: int = 3) -> bool:
    """A usable batch has at least ``min_columns`` columns and one row (reads one row)."""
    return len(df.columns) >= min_columns and not df.isEmpty()


def read_csv_glob(spark: SparkSession, pattern: str, columns=None, sep: str = ",") -> DataFrame:
    """Many CSV files as strings, optionally cut to ``columns``; every file's own header names its columns.

    Files are grouped by header (of which only the first lines are read)
    and each group is one scan with that header as its schema, so files may
    order their columns differently or hold others. A file that lacks one
    of ``columns`` raises. Without ``columns`` the result has the columns of
    all files, NULL where a file has none.
    """
    groups = files_by_header(spark, pattern, sep)
    if not groups:
        raise FileNotFoundError(f"no file with a header matches {pattern}")
    parts = []
    for header, paths in groups:
        if missing := [c for c in columns or () if c not in header]:
            raise ValueError(f"{paths[0]} lacks the columns {missing}")
        schema = T.StructType([T.StructField(c, T.StringType()) for c in header])
        part = spark.read.schema(schema).option("header", True).option("enforceSchema", False).option("sep", sep).csv(paths)
        parts.append(part.select(*[F.col(f"`{c}`") for c in columns]) if columns else part)
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=not columns)
    return out


def first_lines(spark: SparkSession, pattern, jobs: int = 16) -> list[tuple[str, str]]:
    """(path, first non-blank line) of every file, without reading the rest of the files.

    Each file is a job of one task that stops at its first buffer (64 KB);
    ``jobs`` of them run side by side. Split sizes are set in a session of
    its own, so they hold for nothing else. Files without such a line are
    left out.
    """
    session = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(name):
            session.conf.set(name, value)
    # A file is one split: the first line of the first split is that of the file.
    for name in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"):
        session.conf.set(name, str(1 << 60))
    paths = sorted(r["path"] for r in list_files(session, pattern).select("path").collect())

    def head(path: str) -> list[tuple[str, str]]:
        return [(path, r["value"]) for r in session.read.text(path).where("trim(value) <> ''").take(1)]

    with ThreadPoolExecutor(jobs) as pool:
        return [line for lines in pool.map(head, paths) for line in lines]


def files_by_header(spark: SparkSession, pattern, sep: str) -> list[tuple[list[str], list[str]]]:
    """(columns, files) per distinct header among the files; files without a line are left out.

    Headers are CSV rows themselves: a quoted name may hold the separator.
    One row per file comes to the driver.
    """
    found: dict[str, list[str]] = {}
    for path, line in first_lines(spark, pattern):
        found.setdefault(line.removeprefix("\ufeff"), []).append(path)
    groups = [([c.strip() for c in next(csv.reader([line], delimiter=sep))], sorted(paths)) for line, paths in found.items()]
    return sorted(groups, key=lambda g: g[1])


def read_metadata_csv(spark: SparkSession, path: str, encoding: str = "UTF-8") -> DataFrame:
    """Comma CSV scheme list as strings, missing-value tokens turned into NULL."""
    df = spark.read.option("header", True).option("encoding", encoding).option("inferSchema", False).csv(path)
    return na_tokens_to_null(df)


def read_parquet(spark: SparkSession, *paths: str) -> DataFrame:
    """One file, a directory or a glob (e.g. ``raw/*.parquet``): filters and columns reach the scan."""
    return spark.read.parquet(*paths)


def read_parquet_sql(spark: SparkSession, path: str) -> DataFrame:
    """The same scan through SQL's path table syntax."""
    return spark.sql(f"SELECT * FROM parquet.`{path}`")


def read_table(spark: SparkSession, path: str, fmt: str = "delta") -> DataFrame:
    """A table in any installed format (``delta`` needs its package on the cluster)."""
    return spark.read.format(fmt).load(path)


def read_json_docs(spark: SparkSession, path: str, schema: T.StructType, multiline: bool = True) -> DataFrame:
    """Whole JSON documents with a fixed schema -> (file_path, reply struct)."""
    df = spark.read.schema(schema).option("multiLine", multiline).json(path)
    return df.select(F.col("_metadata.file_path").alias("file_path"), F.struct(*df.columns).alias("reply"))


def read_records(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """JSON-lines records (one object per line) -> table; columns as the records state them."""
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.json(path)


def list_files(spark: SparkSession, pattern: str) -> DataFrame:
    """Distributed file listing (path, modificationTime, length); file contents are not read."""
    return spark.read.format("binaryFile").load(pattern).select("path", "modificationTime", "length")


def newest_file(spark: SparkSession, pattern: str, legacy: str | None = None) -> str:
    """Path of the most recently modified file matching ``pattern``; else ``legacy``; else an error."""
    try:
        row = list_files(spark, pattern).agg(F.max_by("path", "modificationTime").alias("p")).first()
        if row is not None and row["p"] is not None:
            return row["p"]
    except Exception as exc:  # no match raises PATH_NOT_FOUND
        if "PATH_NOT_FOUND" not in str(exc) and "does not exist" not in str(exc):
            raise
    if legacy is not None:
        try:
            if not list_files(spark, legacy).isEmpty():
                return legacy
        except AnalysisException as exc:
            if "PATH_NOT_FOUND" not in str(exc):
                raise
    raise FileNotFoundError(f"no file matches {pattern}")


def _mtime(spark: SparkSession, pattern: str):
    try:
        return list_files(spark, pattern).agg(F.max("modificationTime")).first()[0]
    except AnalysisException as exc:  # only an absent path counts as missing
        if "PATH_NOT_FOUND" not in str(exc):
            raise
        return None


def is_newer(spark: SparkSession, raw_pattern: str, processed: str, legacy: str | None = None) -> bool:
    """Should the raw input be processed? Missing raw -> False; missing processed -> True."""
    try:
        raw = newest_file(spark, raw_pattern, legacy)
    except FileNotFoundError:
        return False
    done = _mtime(spark, processed.rstrip("/") + ("/*" if not processed.endswith(("parquet", "csv")) else ""))
    if done is None:
        done = _mtime(spark, processed)
    if done is None:
        return True
    return _mtime(spark, raw) > done


def files_summary(spark: SparkSession, pattern: str) -> DataFrame:
    """Number of files and bytes on disk under ``pattern``, one row."""
    return list_files(spark, pattern).agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))


def read_parquet_nanos(spark: SparkSession, path: str, columns) -> DataFrame:
    """Parquet written with nanosecond timestamps (as pandas via DuckDB writes dates).

    Spark refuses ``TIMESTAMP(NANOS)`` by default; with
    ``spark.sql.legacy.parquet.nanosAsLong`` the column reads as a long of
    nanoseconds and becomes a timestamp again (``columns`` lists those
    columns; midnight values become the date when cast with ``to_date``).
    The setting is restored afterwards; the returned frame keeps working
    because the scan schema is fixed when the frame is built.
    """
    key = "spark.sql.legacy.parquet.nanosAsLong"
    old = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        df = spark.read.parquet(path)
        df = df.withColumns({c: F.timestamp_micros(F.floor(F.col(c) / 1000)) for c in columns})
    finally:
        spark.conf.set(key, old)
    return df


def register_bucketed_table(spark: SparkSession, name: str, path: str, key: str, buckets: int, sort_by=None) -> DataFrame:
    """Make a bucketed table written earlier (``sinks.write_bucketed_table``) known to this session.

    The bucket spec lives in the catalog, not in the files: a new session
    (or a cluster without a shared metastore) declares it again here; the
    column list comes from the Parquet footers.
    """
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema)
    sort = f" SORTED BY ({', '.join(sort_by)})" if sort_by else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet CLUSTERED BY ({key}){sort} "
        f"INTO {int(buckets)} BUCKETS LOCATION '{path}'"
    )
    return spark.table(name)
