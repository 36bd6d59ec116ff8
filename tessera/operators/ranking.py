"""Global numbers, ranks and value codes without a single-task window.

An un-partitioned window sends every row to one task.  Here rows are dealt
into ranges of the sort order, each range is sorted and written by a task of
its own, and a row's number is its place in its range plus the rows of the
ranges before.  Only one count per range reaches the driver.

Equal sort keys may fall into different ranges (a hash of the whole row breaks
ties), so a key that holds a third of the rows is spread as well.  Ranks and
value codes are made from one row per distinct value, counted before anything
is shuffled, and joined back.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.session import scratch_path

_RANGE, _PLACE = "__range", "__place"


def numbered(df: DataFrame, order: Sequence[Column | str], name: str = "number",
             weight: str | None = None, ranges: int | None = None) -> DataFrame:
    """``df`` with ``name``: 0, 1, 2, ... in the given order.

    With ``weight`` (a column of whole numbers) it is the sum of the weights of
    the rows before instead.  Rows that are equal in ``order`` are numbered in an
    order of their own, the same on every run.  ``ranges`` (default: the session's
    shuffle partitions) only spreads the work.
    """
    spark = df.sparkSession
    n = ranges or max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    keys = [F.col(c) if isinstance(c, str) else c for c in order]
    keys.append(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]))
    dealt = df.repartitionByRange(n, *keys).sortWithinPartitions(*keys) \
        .withColumn(_RANGE, F.spark_partition_id()) \
        .withColumn(_PLACE, F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1))
    path = scratch_path(spark, "numbered")
    dealt.write.parquet(path)                       # a range stays as it is, also if it is read again
    stored = spark.read.schema(dealt.schema).parquet(path)
    own = F.count(F.lit(1)) if weight is None else F.sum(weight)
    counts = sorted(stored.groupBy(_RANGE).agg(own).collect())          # one row per range
    before, offsets = 0, []
    for at, count in counts:
        offsets.append((at, before))
        before += count
    starts = spark.createDataFrame(offsets, f"{_RANGE} int, __before long")
    out = stored.join(F.broadcast(starts), _RANGE)
    if weight is None:
        place = F.col(_PLACE)
    else:                                          # within one range, so within one task's share
        from pyspark.sql import Window
        rows = Window.partitionBy(_RANGE).orderBy(_PLACE).rowsBetween(Window.unboundedPreceding, -1)
        place = F.coalesce(F.sum(weight).over(rows), F.lit(0))
    return out.select(*[F.col(f"`{c}`") for c in df.columns],
                      (F.col("__before") + place).cast("long").alias(name))


def value_codes(df: DataFrame, column: str, by_frequency: bool = True, name: str = "code") -> DataFrame:
    """(value, n, code): every value of a column, its rows and its place by falling count
    (ties: the smaller value first) or, without ``by_frequency``, by value.  NULL has no code."""
    counts = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")) \
        .agg(F.count(F.lit(1)).alias("n"))
    order = [F.desc("n"), F.asc("value")] if by_frequency else [F.asc("value")]
    return numbered(counts, order, name)


def with_codes(df: DataFrame, column: str, codes: DataFrame, name: str = "code") -> DataFrame:
    """``df`` with the code of ``column`` from a table of :func:`value_codes`; NULL for others."""
    return df.join(codes.select(F.col("value").alias("__value"), name),
                   F.col(column) == F.col("__value"), "left").drop("__value")


def ranked(df: DataFrame, order: str, descending: bool = False, rank: str = "rank",
           dense: str = "dense_rank") -> DataFrame:
    """``df`` with the rank (1, 2, 2, 4, ...) and the dense rank of ``order``; NULLs come last."""
    counts = df.groupBy(F.col(order).alias("__key")).agg(F.count(F.lit(1)).alias("__n"))
    key = F.desc_nulls_last("__key") if descending else F.asc_nulls_last("__key")
    places = numbered(counts, [key], dense)
    places = numbered(places, [F.col(dense)], rank, weight="__n")
    return df.join(places, F.col(order).eqNullSafe(F.col("__key")), "left").select(
        *[df[c] for c in df.columns], (F.col(rank) + 1).alias(rank), (F.col(dense) + 1).alias(dense))


def page(df: DataFrame, order: Sequence[Column | str], first: int, size: int, name: str = "position") -> DataFrame:
    """Rows ``first`` to ``first + size - 1`` (from 1) of the ordered table, as a table with their
    position: a limit and an offset that stay in Spark."""
    out = numbered(df, order, name).withColumn(name, F.col(name) + 1)
    return out.where(F.col(name).between(first, first + size - 1))
