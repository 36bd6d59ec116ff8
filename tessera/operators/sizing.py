"""Size-checked broadcast.

A broadcast side is shipped whole to every executor, so it is only
allowed behind a row-count bound that was actually checked.  The check
is a bounded ``limit(n + 1).count()`` (it stops reading after n + 1
rows); above the bound the plain DataFrame is returned and Spark / AQE
choose a shuffle join from runtime statistics.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DIMENSION_ROW_LIMIT = 100_000


def is_bounded(df: DataFrame, max_rows: int) -> bool:
    return df.limit(max_rows + 1).count() <= max_rows


def broadcast_if_bounded(df: DataFrame, max_rows: int = DIMENSION_ROW_LIMIT) -> DataFrame:
    """``broadcast(df)`` when it has at most ``max_rows`` rows, else ``df``."""
    return F.broadcast(df) if is_bounded(df, max_rows) else df


def spread(df: DataFrame) -> DataFrame:
    """``df`` dealt over the session's cores if it has fewer partitions than those (a small
    file of one row group, say), before work that is heavy per row; else ``df``."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
