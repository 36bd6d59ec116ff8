"""Generic keyed aggregates.

The aggregate list is built from the schema (``df.dtypes``) on the
driver - only metadata - and evaluated as one ``groupBy().agg()``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NUMERIC = ("tinyint", "smallint", "int", "bigint", "float", "double")


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [c for c, t in df.dtypes
            if (t in NUMERIC or t.startswith("decimal")) and c not in exclude]


def sum_numeric(df: DataFrame, keys: Sequence[str], prefix: str = "sum_") -> DataFrame:
    """Sum of every numeric non-key column per group (A4)."""
    cols = numeric_columns(df, keys)
    return df.groupBy(*keys).agg(*[F.sum(F.col(f"`{c}`")).alias(f"{prefix}{c}") for c in cols])


def mean_numeric(df: DataFrame, keys: Sequence[str], prefix: str = "avg_") -> DataFrame:
    """Mean of every numeric non-key column per group."""
    cols = numeric_columns(df, keys)
    return df.groupBy(*keys).agg(*[F.avg(F.col(f"`{c}`")).alias(f"{prefix}{c}") for c in cols])


def row_count(df: DataFrame, alias: str = "n") -> DataFrame:
    """Global row count as a one-row DataFrame (A1)."""
    return df.agg(F.count(F.lit(1)).alias(alias))
