"""Join helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Largest metadata side broadcast by default: at a few hundred bytes a row this is tens of
# MB, well inside executor memory; instrument lists are about 16 K rows.
METADATA_BROADCAST_ROWS = 200_000


def broadcast_if_small(df: DataFrame, max_rows: int, upper_bound: DataFrame | None = None) -> DataFrame:
    """Mark ``df`` for broadcast only when it provably has at most ``max_rows`` rows.

    The proof is a bounded count (``limit(max_rows + 1)``), so a large side
    is never scanned past the bound. ``upper_bound`` may name a cheaper frame
    with at least as many rows (e.g. ``df`` before a DISTINCT), so the count
    skips that shuffle. Beyond the bound the frame is returned unmarked and
    the planner shuffles (AQE can still switch to broadcast from runtime
    sizes and split skewed partitions).
    """
    return F.broadcast(df) if is_small(df if upper_bound is None else upper_bound, max_rows) else df


def is_small(df: DataFrame, max_rows: int) -> bool:
    """Has ``df`` at most ``max_rows`` rows? Counts no further than that."""
    return df.limit(max_rows + 1).count() <= max_rows
