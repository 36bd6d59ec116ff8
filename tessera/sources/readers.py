"""Batch and streaming readers.

All readers take a declared schema: inference costs an extra pass over
the data and a streaming source needs the schema up front anyway.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_csv_quoted(spark: SparkSession, path: str, schema: T.StructType,
                    multiline: bool = False) -> DataFrame:
    """Header CSV with ``"`` quoting/escaping.

    ``multiline`` allows line breaks inside quoted fields; it makes each
    file a single split (:mod:`tessera.sources.multiline` reads such files
    by several tasks).
    """
    return (spark.read.schema(schema)
            .option("header", True)
            .option("multiLine", multiline)
            .option("escape", '"')
            .option("mode", "PERMISSIVE")
            .csv(path))


def read_single_column_tsv(spark: SparkSession, path: str) -> DataFrame:
    """Tab-delimited read of a comma file: the whole line lands in one
    column named after the header line (S2 compat form)."""
    return spark.read.option("delimiter", "\t").option("header", True).csv(path)


def read_sensor_json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """JSON lines with a declared schema (S3)."""
    return spark.read.schema(schema).json(path)


def read_positional_csv(spark: SparkSession, path: str, names: list[str],
                        header: bool = True) -> DataFrame:
    """Header CSV read by position under our own column names.

    The header line of every file is dropped by the reader; all columns
    are strings and are typed by the caller.
    """
    schema = T.StructType([T.StructField(n, T.StringType(), True) for n in names])
    return spark.read.schema(schema).option("header", header).csv(path)


def read_kafka(spark: SparkSession, servers: str, topic: str,
               max_offsets_per_trigger: int = 100_000,
               starting_offsets: str = "earliest",
               fail_on_data_loss: bool = True) -> DataFrame:
    """Message stream from Kafka.

    Needs the Kafka connector on the classpath; the payload decoding is
    separate (:func:`tessera.streaming.decode.decode_json_value`) and
    works on any stream with a ``value`` column.
    """
    return (spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", servers)
            .option("subscribe", topic)
            .option("startingOffsets", starting_offsets)
            .option("failOnDataLoss", fail_on_data_loss)
            .option("maxOffsetsPerTrigger", max_offsets_per_trigger)
            .load())


def empty_table(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """A typed table with no rows."""
    return spark.createDataFrame([], schema)


def with_position(df: DataFrame) -> DataFrame:
    """A Parquet scan with ``__file`` and ``__row``: where each row stands in the input."""
    return df.select("*", F.col("_metadata.file_path").alias("__file"), F.col("_metadata.row_index").alias("__row"))
