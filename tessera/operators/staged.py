"""Two-stage aggregates over keyed readings.

Both stages are ordinary ``groupBy().agg()`` calls in one plan: the
first stage's partial aggregate runs map-side, and the second stage
works on the (much smaller) per-key means.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def key_means(df: DataFrame, keys: Sequence[str], value: str = "value",
              alias: str = "mean_value") -> DataFrame:
    """Mean of ``value`` per key (A13).  Keys with a single reading work
    like any other (``avg`` keeps a sum/count pair internally)."""
    return df.groupBy(*keys).agg(F.avg(value).alias(alias))


def two_stage_extremes(df: DataFrame, fine_keys: Sequence[str] = ("day", "month", "curtain"),
                       coarse_keys: Sequence[str] = ("month", "curtain"),
                       value: str = "value", digits: int = 7, long: bool = False) -> DataFrame:
    """Mean per fine key, then max and min of those means per coarse key
    (C16, A14), rounded to ``digits``.

    ``long=True`` gives the two-row-per-key form (max row first in the
    ``kind`` order ``max``, ``min``) via ``stack``.
    """
    means = key_means(df, fine_keys, value)
    wide = means.groupBy(*coarse_keys).agg(
        F.round(F.max("mean_value"), digits).alias("max_mean"),
        F.round(F.min("mean_value"), digits).alias("min_mean"))
    if not long:
        return wide
    return wide.select(*coarse_keys,
                       F.expr("stack(2, 'max', max_mean, 'min', min_mean) AS (kind, mean_value)"))


def groups_always_above(df: DataFrame, threshold: float,
                        fine_keys: Sequence[str] = ("day", "month", "face", "curtain"),
                        pair_keys: Sequence[str] = ("month", "face"),
                        group_key: str = "month", member: str = "face",
                        value: str = "value", as_list: bool = True) -> DataFrame:
    """Groups whose *every* fine-key mean is >= ``threshold`` (C17, A26),
    listed as sorted members per ``group_key`` (A27), or with
    ``as_list=False`` as one row per passing (group, member) pair.

    "For all" is ``min(mean) >= t`` on the pair key: one aggregate
    instead of a set difference.  The member set per group is bounded
    by the member domain and is built with partial aggregation.
    """
    means = key_means(df, fine_keys, value)
    passing = (means.groupBy(*pair_keys).agg(F.min("mean_value").alias("__lowest"))
                    .where(F.col("__lowest") >= F.lit(threshold)))
    if not as_list:
        # one (group, member) row per passing pair: no per-group list, so
        # a member domain of any size stays distributed
        return passing.select(group_key, member)
    return passing.groupBy(group_key).agg(
        F.sort_array(F.collect_set(member)).alias(f"{member}s")).orderBy(group_key)
