"""A dictionary of values that grows with a stream.

A micro-batch cannot see the values of later ones, so each batch numbers the
values that are new in it, after those of the batches before, in the order of
the values.  The numbers of one batch are a table of their own,
``codes/epoch=N``, written with overwrite and read only by later batches: a
replayed batch finds what it found before and writes the same numbers.
Nothing but one count per batch reaches the driver.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.ranking import numbered
from tessera.streaming.replay import list_epochs, read_text, touch, write_text

_DONE = "_DONE"


@dataclass
class GrowingDictionary:
    """Numbers for the values of ``column`` (of type ``kind``), kept under ``state_dir``."""

    spark: SparkSession
    state_dir: str
    column: str
    kind: str = "string"

    def _path(self, epoch: int) -> str:
        return f"{self.state_dir}/codes/epoch={epoch}"

    def _epochs(self, before: int | None) -> list[int]:
        done = list_epochs(self.spark, f"{self.state_dir}/codes", _DONE)
        return [e for e in done if before is None or e < before]

    def size(self, before: int | None = None) -> int:
        """How many values are numbered (by the epochs before ``before``)."""
        done = self._epochs(before)
        return json.loads(read_text(self.spark, f"{self.state_dir}/sizes/{done[-1]}.json"))["size"] if done else 0

    def codes(self, before: int | None = None) -> DataFrame:
        """(value, code) of the epochs before ``before``, or of all."""
        done = self._epochs(before)
        schema = f"value {self.kind}, code long"
        if not done:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[self._path(e) for e in done])

    def extend(self, batch: DataFrame, epoch: int, by: str | None = None) -> int:
        """Numbers the new values of a batch; how many there are.  NULL gets no number.

        A batch of many blocks (column ``by``) gives the numbers that the blocks would give one after
        the other: a value's place is told by the first block that has it, and then by the value.
        """
        known = self.codes(before=epoch)
        first = F.min(by) if by else F.lit(0)
        new = batch.where(F.col(self.column).isNotNull()).groupBy(F.col(self.column).alias("value")) \
            .agg(first.alias("__first")).join(known, "value", "left_anti")
        start = self.size(before=epoch)
        numbered(new, [F.asc("__first"), F.asc("value")], "code").select("value", (F.col("code") + start).alias("code")) \
            .write.mode("overwrite").parquet(self._path(epoch))
        found = self.spark.read.parquet(self._path(epoch)).count()
        write_text(self.spark, f"{self.state_dir}/sizes/{epoch}.json", json.dumps({"size": start + found}))
        touch(self.spark, f"{self._path(epoch)}/{_DONE}")
        return found

    def encode(self, df: DataFrame, name: str = "code", before: int | None = None) -> DataFrame:
        """``df`` with the number of ``column``; NULL for a value that has none (yet)."""
        codes = self.codes(before).select(F.col("value").alias("__value"), F.col("code").alias(name))
        return df.join(codes, F.col(self.column) == F.col("__value"), "left").drop("__value")
