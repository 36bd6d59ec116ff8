"""Words as bytes, and item sets cut into blocks of a proven size.

The operators that search documents for the words of a given set of items
share these.  A text is folded byte by byte: A-Z become a-z, the other
ASCII signs but digits separate words, bytes above 0x7F belong to words
(also where a text is not valid UTF-8).
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FOLDED = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
               for b in range(256))
ROWS = 256


def folded_words(text: bytes) -> list[bytes]:
    """Lower-cased runs of digits, letters and non-ASCII bytes."""
    return text.translate(FOLDED).split()


def plain_words(text: bytes) -> list[bytes]:
    """Runs of anything but space and U+0009 to U+000D."""
    return text.split()


def as_bytes(text: Column) -> Column:
    """The bytes of a text as they are; none for NULL."""
    return F.coalesce(text, F.lit("")).cast("binary")


def in_rows(batches: Iterator[pa.RecordBatch], rows: int = ROWS) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of at most ``rows`` rows."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def item_blocks(entries: DataFrame, most: int) -> list[DataFrame]:
    """``entries`` (with ``item_id``) as tables of at most ``most`` rows, each item whole in one.

    Only an item that has more rows by itself makes a larger block, and then
    alone.  Blocks are hash classes of the id, so a repeated run finds the same.
    """
    per_item = entries.groupBy("item_id").count()
    at = lambda k: F.pmod(F.xxhash64("item_id"), F.lit(k))
    k = 1
    while True:
        sizes = per_item.groupBy(at(k).alias("block")).agg(
            F.sum("count").alias("n"), F.count("*").alias("items"))
        if not sizes.filter((F.col("n") > most) & (F.col("items") > 1)).take(1):
            found = [r["block"] for r in sizes.select("block").sort("block").collect()]
            return [entries.filter(at(k) == b) for b in found]
        k *= 2
