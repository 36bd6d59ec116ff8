"""A stream with two sinks, good records and dead letters, under one commit per batch.

Each micro-batch writes its records and its broken messages to folders of the
batch, with overwrite, and then one small commit file.  Readers see committed
batches only.  A failure between the two sinks leaves no commit; the replayed
batch overwrites what was there, so each message is read once, on one side.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tessera.streaming.decode import decode_json_value
from tessera.streaming.replay import list_epochs, touch

_DONE = "_DONE"


@dataclass
class DeadLetterSink:
    """Decodes JSON messages (column ``value``) of ``schema`` to two tables under ``state_dir``."""

    spark: SparkSession
    schema: T.StructType
    state_dir: str

    def _path(self, kind: str, epoch: int) -> str:
        return f"{self.state_dir}/{kind}/epoch={epoch}"

    def _write(self, rows: DataFrame, kind: str, epoch: int) -> None:
        rows.write.mode("overwrite").parquet(self._path(kind, epoch))

    def process(self, batch: DataFrame, epoch: int) -> None:
        decoded = decode_json_value(batch, self.schema, keep_raw=True)
        decoded.write.mode("overwrite").parquet(self._path("staged", epoch))     # decoded once
        staged = self.spark.read.schema(decoded.schema).parquet(self._path("staged", epoch))
        self._write(staged.where("NOT is_corrupt").select(self.schema.names), "good", epoch)
        self._write(staged.where("is_corrupt").select("raw_text"), "dead", epoch)
        touch(self.spark, f"{self._path('commits', epoch)}/{_DONE}")

    def _read(self, kind: str, schema: T.StructType) -> DataFrame:
        done = list_epochs(self.spark, f"{self.state_dir}/commits", _DONE)
        if not done:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[self._path(kind, e) for e in done])

    def good(self) -> DataFrame:
        return self._read("good", self.schema)

    def dead(self) -> DataFrame:
        return self._read("dead", T.StructType([T.StructField("raw_text", T.StringType())]))

    def run(self, stream: DataFrame) -> None:
        """Everything the stream has, then stop."""
        query = (stream.writeStream.foreachBatch(lambda df, e: self.process(df, e))
                 .option("checkpointLocation", f"{self.state_dir}/checkpoint").trigger(availableNow=True).start())
        query.awaitTermination()
        if query.exception() is not None:
            raise RuntimeError(str(query.exception()))
