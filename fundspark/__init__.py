"""fundspark: keyed time-series analytics for daily fund prices on Spark.

Every operator is a ``DataFrame -> DataFrame`` function built from Spark
expressions, joins and windows, so Catalyst sees the whole plan.
"""

from fundspark.session import build_session, checkpoint_dir, cluster_conf

__version__ = "0.1.0"
__all__ = ["build_session", "checkpoint_dir", "cluster_conf"]
