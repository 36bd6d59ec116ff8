"""Looking at results (S9-S11) without pulling unbounded data.

``to_pandas_bounded`` refuses to bring more than ``max_rows`` rows to
the driver: aggregate in Spark first (counts, shares, centroids, binned
density), then chart the small result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

DEFAULT_MAX_ROWS = 100_000


def preview(df: DataFrame, n: int = 20) -> list:
    """First ``n`` rows (S9) - a limit, not a full collect."""
    return df.limit(n).collect()


def schema_of(df: DataFrame) -> str:
    """The schema as a tree string."""
    return df.schema.treeString() if hasattr(df.schema, "treeString") else df.schema.simpleString()


def to_pandas_bounded(df: DataFrame, max_rows: int = DEFAULT_MAX_ROWS):
    """``toPandas`` of a result known to be small (S11); raises above the bound."""
    head = df.limit(max_rows + 1)
    pdf = head.toPandas()
    if len(pdf) > max_rows:
        raise ValueError(f"result has more than {max_rows} rows; aggregate it in Spark first")
    return pdf
