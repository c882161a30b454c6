"""Registered queries over the driver's tables, with their DuckDB oracle SQL.

Each query is ``(spark, sf_dir) -> DataFrame`` and reads whole tables.
Computed doubles are rounded to 6 digits on both sides where the two
engines may differ in the last bit (sums, logs, powers). The queries live
in four modules by domain; importing them registers them, in this order
(the load module reuses the report-cleaning SQL of the metadata module).
"""

from __future__ import annotations

from fundspark.plans import quality_queries  # noqa: F401  isort: skip
from fundspark.plans import series_queries  # noqa: F401  isort: skip
from fundspark.plans import metadata_queries  # noqa: F401  isort: skip
from fundspark.plans import load_queries  # noqa: F401  isort: skip
from fundspark.plans.registry import ORACLE, QUERIES, Query  # noqa: F401
