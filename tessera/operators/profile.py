"""Class profiles of sensor readings.

All outputs are aggregates computed in Spark; only those small results
ever need to leave the cluster (e.g. for charts).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions import scalars


def with_time_features(df: DataFrame, ms: str = "Arrival_Time") -> DataFrame:
    """Add ``Hour`` and ``Minutes`` (UTC) of an epoch-ms column."""
    return df.withColumns({"Hour": scalars.hour_of_day(ms),
                           "Minutes": scalars.minute_of_hour(ms)})


def counts(df: DataFrame, keys: Sequence[str], alias: str = "n") -> DataFrame:
    """Row count per key combination."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(alias))


def shares(df: DataFrame, key: str, alias: str = "share") -> DataFrame:
    """Count and share of total per key.

    The total is a scalar subquery over the per-key counts: Spark runs
    it once and hands the single value to every task, so no partition
    ever has to hold all keys (unlike an un-partitioned window).
    """
    per_key = counts(df, [key])
    total = per_key.agg(F.sum("n")).scalar()
    return per_key.select(key, "n", (F.col("n") / total).alias(alias))


def mean_truncated(df: DataFrame, keys: Sequence[str], value: str,
                   alias: str | None = None) -> DataFrame:
    """Mean per key truncated toward zero to int."""
    return df.groupBy(*keys).agg(F.avg(value).cast("int").alias(alias or f"mean_{value}"))


def pivot_mean(df: DataFrame, row: str, column: str, values: Sequence, value: str,
               truncate: bool = True, ordered: bool = False) -> DataFrame:
    """``row`` x ``column`` mean of ``value`` (A11); explicit pivot values
    keep the schema stable and skip the extra distinct job.  ``ordered``
    sorts by the row key once, at the end (O1), on the aggregated rows."""
    p = df.groupBy(row).pivot(column, list(values)).agg(F.avg(value))
    if truncate:
        p = p.select(row, *[F.col(f"`{v}`").cast("int").alias(str(v)) for v in values])
    return p.orderBy(row) if ordered else p


def pivot_count(df: DataFrame, row: str, column: str, values: Sequence,
                fill: int | None = None) -> DataFrame:
    """``row`` x ``column`` row counts (A10); absent cells NULL unless
    ``fill`` is given."""
    p = df.groupBy(row).pivot(column, list(values)).count()
    return p.fillna(fill, subset=[str(v) for v in values]) if fill is not None else p


def centroids(df: DataFrame, key: str, axes: Sequence[str] = ("x", "y", "z")) -> DataFrame:
    """Mean position per class."""
    return df.groupBy(key).agg(*[F.avg(a).alias(f"avg_{a}") for a in axes])


def axis_density(df: DataFrame, a: str, b: str, key: str, width: float) -> DataFrame:
    """Binned 2-axis counts per class (C20): what a scatter plot shows,
    aggregated instead of shipped row by row."""
    return df.groupBy(F.floor(F.col(a) / width).alias(f"{a}_bin"),
                      F.floor(F.col(b) / width).alias(f"{b}_bin"), key) \
        .agg(F.count(F.lit(1)).alias("n"))


def time_span(df: DataFrame, column: str, unit: str) -> DataFrame:
    """Min, max and the span in hours in one pass."""
    return df.agg(F.min(column).alias("min_time"), F.max(column).alias("max_time")) \
        .withColumn("span_hours", scalars.span_hours(F.col("max_time"), F.col("min_time"), unit))


def distinct_count(df: DataFrame, column: str, alias: str = "n_distinct",
                   approx: bool = False) -> DataFrame:
    """Number of distinct values (A25); ``approx`` uses HyperLogLog++."""
    agg = F.approx_count_distinct(column) if approx else F.count_distinct(column)
    return df.agg(agg.alias(alias))


# --- distinct counts that can be merged (A25) --------------------------------

SKETCH_BITS = 16


def distinct_sketches(df: DataFrame, keys: Sequence[str], column: str, bits: int = SKETCH_BITS) -> DataFrame:
    """One HyperLogLog sketch of ``column`` per key, to be stored: later counts over any
    union of keys need the sketches only."""
    return df.groupBy(*keys).agg(F.hll_sketch_agg(column, bits).alias("sketch"))


def merged_distinct(sketches: DataFrame, keys: Sequence[str], alias: str = "n_distinct") -> DataFrame:
    """Distinct values per (coarser) key from stored sketches; the relative error is about
    1.04 / 2 ** (bits / 2), and counts far below 2 ** bits are exact."""
    return sketches.groupBy(*keys).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias(alias))
