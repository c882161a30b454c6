"""Never-delete master table: first/last seen dates and an active flag per key."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MASTER_COLUMNS = ["first_seen_date", "last_seen_date", "is_active", "attribute_last_updated"]
RECENT_DAYS = 30  # fixed: window of the "recent" views


def _as_date(as_of) -> F.Column:
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, (dt.date, str)):
        return F.lit(str(as_of)).cast("date")
    return as_of


def build_initial_master(latest: DataFrame, as_of=None, launch: str = "launch_date") -> DataFrame:
    """Every key active; first seen = launch date, else ``as_of``; last seen = updated = ``as_of``."""
    d = _as_date(as_of)
    first = F.coalesce(F.col(launch), d) if launch in latest.columns else d
    return latest.withColumns(
        {"first_seen_date": first, "last_seen_date": d, "is_active": F.lit(True), "attribute_last_updated": d}
    )


def merge_master(
    existing: DataFrame,
    latest: DataFrame,
    as_of=None,
    key: str = "scheme_code",
    launch: str = "launch_date",
    check_unique: bool = False,
) -> DataFrame:
    """Upsert the latest snapshot into the master with one full outer join on the key.

    * key only in latest: added as in ``build_initial_master``;
    * key in both: attributes from latest, first seen kept, last seen =
      updated = ``as_of``, active again;
    * key only in the master: kept unchanged but inactive.

    The key is compared NULL-safely and each side carries a presence flag,
    so a NULL key is a key like any other. Repeated keys multiply as in a
    relational join, as the source does; ``check_unique`` instead raises
    before the join when either side repeats a key (one aggregate per side
    that fetches at most one offending key).
    """
    if check_unique:
        from fundspark.operators.series import assert_unique

        assert_unique(existing, [key])
        assert_unique(latest, [key])
    d = _as_date(as_of)
    attrs = [c for c in latest.columns if c != key and c not in MASTER_COLUMNS]
    only_old = [c for c in existing.columns if c != key and c not in attrs and c not in MASTER_COLUMNS]
    e = existing.select(
        F.col(key).alias("_ek"),
        *[F.col(c).alias(f"_e_{c}") for c in attrs + only_old if c in existing.columns],
        *[F.col(c).alias(f"_e_{c}") for c in MASTER_COLUMNS],
        F.lit(True).alias("_in_e"),
    )
    lt = latest.select(F.col(key).alias("_lk"), *[F.col(c).alias(f"_l_{c}") for c in attrs], F.lit(True).alias("_in_l"))
    j = e.join(lt, e["_ek"].eqNullSafe(lt["_lk"]), "full_outer")
    in_l = F.coalesce(F.col("_in_l"), F.lit(False))
    in_e = F.coalesce(F.col("_in_e"), F.lit(False))
    new_first = F.coalesce(F.col(f"_l_{launch}"), d) if launch in attrs else d
    cols = [F.when(in_l, F.col("_lk")).otherwise(F.col("_ek")).alias(key)]
    for c in attrs:
        old = F.col(f"_e_{c}") if c in existing.columns else F.lit(None)
        cols.append(F.when(in_l, F.col(f"_l_{c}")).otherwise(old).alias(c))
    cols += [
        F.when(in_l & in_e, F.col("_e_first_seen_date"))
        .when(in_l, new_first)
        .otherwise(F.col("_e_first_seen_date"))
        .alias("first_seen_date"),
        F.when(in_l, d).otherwise(F.col("_e_last_seen_date")).alias("last_seen_date"),
        in_l.alias("is_active"),
        F.when(in_l, d).otherwise(F.col("_e_attribute_last_updated")).alias("attribute_last_updated"),
    ]
    cols += [F.when(in_l, F.lit(None)).otherwise(F.col(f"_e_{c}")).alias(c) for c in only_old]
    return j.select(*cols)


def master_views(master: DataFrame, as_of=None, days: int = RECENT_DAYS) -> dict[str, DataFrame]:
    """Active, inactive, first seen within ``days``, and inactive with last seen within ``days``."""
    d = _as_date(as_of)
    since = F.date_sub(d, days)
    active = F.col("is_active")
    return {
        "active": master.filter(active),
        "inactive": master.filter(~active),
        "recent": master.filter(F.col("first_seen_date") >= since),
        "recently_closed": master.filter(~active & (F.col("last_seen_date") >= since)),
    }


def master_view_counts(master: DataFrame, as_of=None, days: int = RECENT_DAYS) -> DataFrame:
    """The four views as counts in one aggregate (one scan)."""
    d = _as_date(as_of)
    since = F.date_sub(d, days)
    active = F.col("is_active")
    return master.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(active).alias("active"),
        F.count_if(~active).alias("inactive"),
        F.count_if(F.col("first_seen_date") >= since).alias("recent"),
        F.count_if(~active & (F.col("last_seen_date") >= since)).alias("recently_closed"),
    )


def update_master_table(spark, path: str, latest: DataFrame, as_of, key: str = "scheme_code") -> DataFrame:
    """Merge ``latest`` into the master stored under ``path`` and store the result as a new version.

    Versions are ``as_of=<date>`` partitions. The newest version *before*
    ``as_of`` is read (partition pruning keeps the scan to it) and the merged
    table is written to this run's ``as_of`` partition with dynamic
    overwrite: the version being read is never overwritten, and a rerun of
    the same day rebuilds its version from the previous one. With no older
    version the initial master is built.
    """
    from pyspark.errors import AnalysisException

    from fundspark.sources.readers import list_files
    from fundspark.sources.sinks import read_latest_dated, write_dated

    try:
        versions = list_files(spark, f"{path.rstrip('/')}/as_of=*/*.parquet")
        has_older = not versions.filter(
            F.regexp_extract("path", r"as_of=(\d{4}-\d{2}-\d{2})", 1) < F.lit(str(as_of))
        ).isEmpty()
    except AnalysisException as exc:  # any other failure must not look like a first run
        if "PATH_NOT_FOUND" not in str(exc):
            raise
        has_older = False
    if has_older:
        existing = read_latest_dated(spark, path, column="as_of", before=as_of).drop("as_of")
        merged = merge_master(existing, latest, as_of, key=key)
    else:
        merged = build_initial_master(latest, as_of)
    write_dated(merged, path, as_of, column="as_of")
    return read_latest_dated(spark, path, column="as_of").drop("as_of")
