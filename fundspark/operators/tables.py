"""Operators on whole tables: joins with clashing column names, samples of an exact size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundspark.functions.joins import broadcast_if_small

NULL_KEY_SPREAD = 64  # places over which rows with a NULL key are dealt in a left or full join


def merged_names(
    left: Sequence[str], right: Sequence[str], on: Sequence[str], suffixes: tuple[str, str], case_sensitive: bool = False
) -> tuple[list[str], list[str]]:
    """Output names of the columns beside the key: a name on both sides gets each side's suffix.

    Names are compared as Spark resolves them (without case unless
    ``case_sensitive``). A result that would still repeat a name raises.
    """
    fold = (lambda c: c) if case_sensitive else str.lower
    keys = {fold(c) for c in on}
    rest_l, rest_r = ([c for c in side if fold(c) not in keys] for side in (left, right))
    clash = {fold(c) for c in rest_l} & {fold(c) for c in rest_r}
    out_l = [c + suffixes[0] if fold(c) in clash else c for c in rest_l]
    out_r = [c + suffixes[1] if fold(c) in clash else c for c in rest_r]
    every = [fold(c) for c in (*on, *out_l, *out_r)]
    if twice := sorted({c for c in every if every.count(c) > 1}):
        raise ValueError(f"the merged table would repeat {twice}; choose other suffixes than {suffixes}")
    return out_l, out_r


def merge_tables(
    left: DataFrame,
    right: DataFrame,
    on: str | Sequence[str],
    how: str = "inner",
    suffixes: tuple[str, str] = ("_x", "_y"),
    null_keys_match: bool = False,
    broadcast_max_rows: int | None = None,
) -> DataFrame:
    """Join two tables that share names beside the key: both columns are kept apart, none is ambiguous.

    The key columns come first and once (from whichever side has the row),
    then the left columns, then the right ones; a name found on both sides
    gets ``suffixes``. ``how`` is inner, left or full. A NULL key matches
    nothing, as in SQL, unless ``null_keys_match`` says that NULL keys
    equal each other, as data frame libraries have it. Repeated keys
    multiply. ``broadcast_max_rows`` broadcasts the right side of an inner
    or left join behind a bounded count.

    Rows whose key is NULL match nothing but stay in a left or full join;
    they would all be shuffled to one task, so a second, constant key deals
    them over ``NULL_KEY_SPREAD`` places.
    """
    if how not in ("inner", "left", "full"):
        raise ValueError(f"how must be inner, left or full, not {how!r}")
    on = [on] if isinstance(on, str) else list(on)
    sensitive = left.sparkSession.conf.get("spark.sql.caseSensitive") == "true"
    fold = (lambda c: c) if sensitive else str.lower

    def split(df: DataFrame, tag: str) -> tuple[DataFrame, list[str], list[str]]:
        """The table under positional names, with those of its key and of its other columns."""
        names = [f"_{tag}{i}" for i in range(len(df.columns))]
        at = {fold(c): n for c, n in zip(df.columns, names, strict=True)}
        if missing := [c for c in on if fold(c) not in at]:
            raise ValueError(f"the key {missing} is missing among {df.columns}")
        keys = [at[fold(c)] for c in on]
        return df.toDF(*names), keys, [n for n in names if n not in keys]

    names_l, names_r = merged_names(left.columns, right.columns, on, suffixes, sensitive)
    a, keys_a, rest_a = split(left, "a")
    b, keys_b, rest_b = split(right, "b")
    if broadcast_max_rows and how != "full":
        b = broadcast_if_small(b, broadcast_max_rows)
    same: Column = F.lit(True)
    for x, y in zip(keys_a, keys_b, strict=True):
        same = same & (F.col(x).eqNullSafe(F.col(y)) if null_keys_match else F.col(x) == F.col(y))
    if how != "inner" and not null_keys_match:

        def spread(keys: list[str], rest: list[str]) -> Column:
            null = F.lit(False)
            for k in keys:
                null = null | F.col(k).isNull()
            place = F.pmod(F.xxhash64(*keys, *rest), F.lit(NULL_KEY_SPREAD))
            return F.when(null, place).otherwise(F.lit(0).cast("bigint"))

        plain = lambda df, cols: [c for c in cols if not df.schema[c].dataType.simpleString().startswith("map")]
        a = a.withColumn("_pa", spread(keys_a, plain(a, rest_a)))
        # Right rows without a key never match in a left join; any hash modulo 1 is the 0 that the optimiser keeps as a key.
        b = b.withColumn("_pb", spread(keys_b, plain(b, rest_b)) if how == "full" else F.pmod(F.xxhash64(*keys_b), F.lit(1)))
        same = same & (F.col("_pa") == F.col("_pb"))
    joined = a.join(b, same, how)
    first = F.coalesce if how == "full" else lambda x, _: x
    return joined.select(
        *[first(F.col(x), F.col(y)).alias(c) for c, x, y in zip(on, keys_a, keys_b, strict=True)],
        *[F.col(n).alias(c) for n, c in zip(rest_a, names_l, strict=True)],
        *[F.col(n).alias(c) for n, c in zip(rest_b, names_r, strict=True)],
    )


def sample_n(df: DataFrame, n: int, columns: Sequence[str], seed: int = 42) -> DataFrame:
    """Exactly ``n`` rows (all of them if there are fewer), the same ones however the table is partitioned.

    The rows of the ``n`` smallest seeded hashes of ``columns`` are taken;
    name columns that identify a row, or rows of one hash are exchangeable.
    Each partition keeps its own ``n`` smallest before anything is
    shuffled (a top-n), so the cost is one scan and ``n`` rows a task. The
    hash is MD5 of the seed and the columns' text (NULL as a character of
    its own), which any engine computes alike.
    """
    if n < 0:
        raise ValueError("n must not be negative")
    parts = [F.lit(str(seed))] + [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\x00")) for c in columns]
    order = F.md5(F.concat_ws("\x1f", *parts).cast("binary"))
    out = df.withColumn("_order", order).orderBy("_order").limit(n)
    return out.drop("_order")
