"""Scalar helpers: dates, epoch parts, codes and indicator columns.

All NULL-on-bad-input (``try_*`` / ``get``) so that ANSI mode never
fails a job on one dirty cell.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

MS_PER_MINUTE = 60_000
MS_PER_HOUR = 3_600_000
UNIT_PER_HOUR = {"s": 3_600, "ms": 3_600_000, "us": 3_600_000_000, "ns": 3_600_000_000_000}


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_int(c: str | Column) -> Column:
    """String/number to int, NULL when it does not parse."""
    return _col(c).try_cast("int")


def date_from_pattern(c: str | Column, pattern: str = "dd-MM-yyyy",
                      slash_to_dash: bool = True) -> Column:
    """Text date to ``date`` with a pattern, NULL on bad input."""
    text = F.regexp_replace(_col(c), "/", "-") if slash_to_dash else _col(c)
    return F.try_to_timestamp(text, F.lit(pattern)).cast("date")


def epoch_millis(ts: str | Column) -> Column:
    """Milliseconds since 1970 of a ``timestamp_ntz`` read as UTC.

    Independent of the session time zone.
    """
    return F.timestamp_diff("MILLISECOND", _epoch_ntz(), _col(ts))


def epoch_micros(ts: str | Column) -> Column:
    """Microseconds since 1970 of a ``timestamp_ntz`` read as UTC."""
    return F.timestamp_diff("MICROSECOND", _epoch_ntz(), _col(ts))


def _epoch_ntz() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def hour_of_day(ms: str | Column) -> Column:
    """Hour (UTC) of an epoch-millisecond value."""
    return (F.floor(_col(ms) / MS_PER_HOUR) % 24).cast("int")


def minute_of_hour(ms: str | Column) -> Column:
    """Minute of the hour of an epoch-millisecond value."""
    return (F.floor(_col(ms) / MS_PER_MINUTE) % 60).cast("int")


def span_hours(max_c: Column, min_c: Column, unit: str = "ms") -> Column:
    """Time between two epoch values in hours; ``unit`` is their unit."""
    return (max_c - min_c) / F.lit(UNIT_PER_HOUR[unit])


def split_part_int(c: str | Column, sep: str, index: int) -> Column:
    """0-based ``index``-th part of ``split(c, sep)`` as int, NULL if absent."""
    return F.get(F.split(_col(c), sep), F.lit(index)).try_cast("int")


def suffix_code(c: str | Column, sep: str = "_", offset: int = 1) -> Column:
    """``nexus4_2`` -> 2 - offset."""
    return split_part_int(c, sep, 1) - F.lit(offset)


def code_lookup(c: str | Column, vocabulary: Mapping[str, float] | Iterable[str],
                dtype: str = "double") -> Column:
    """Fixed-vocabulary value -> numeric code; unknown -> NULL.

    A list gives codes by position.
    """
    if not isinstance(vocabulary, Mapping):
        vocabulary = {v: i for i, v in enumerate(vocabulary)}
    pairs = []
    for key, code in vocabulary.items():
        pairs += [F.lit(key), F.lit(code).cast(dtype)]
    return F.try_element_at(F.create_map(*pairs), _col(c))


def one_hot_columns(c: str | Column, vocabulary: Iterable[str], prefix: str) -> list[Column]:
    """One 0/1 column per vocabulary value, in one projection."""
    col = _col(c)
    return [F.when(col == F.lit(v), 1).otherwise(0).alias(f"{prefix}{v}") for v in vocabulary]
