"""Message payload decoding.

Works on any DataFrame - batch or streaming - with a binary/string
``value`` column, so it is independent of the source (Kafka, files).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_CORRUPT = "__corrupt_record"


def decode_json_value(df: DataFrame, schema: T.StructType, column: str = "value",
                      keep_raw: bool = False) -> DataFrame:
    """bytes -> text -> JSON -> top-level columns.

    Bytes that are not valid UTF-8 become the replacement character, so
    no message can stop a stream.  A message that is not a whole JSON
    object gives a row of NULLs; with ``keep_raw`` its text stands in
    ``raw_text`` and ``is_corrupt`` is true, so bad messages can be
    routed aside.  ``{}`` is a record without values, not a bad one.
    """
    text = F.make_valid_utf8(F.col(column).cast("string"))
    wide = T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType(), True)])
    parsed = df.select(text.alias("raw_text")).withColumn(
        "__rec", F.from_json("raw_text", wide, {"columnNameOfCorruptRecord": _CORRUPT}))
    bad = F.col("raw_text").isNull() | F.col("__rec").isNull() | F.col(f"__rec.{_CORRUPT}").isNotNull()
    fields = [F.when(~bad, F.col(f"__rec.`{f.name}`")).alias(f.name) for f in schema.fields]
    if not keep_raw:
        return parsed.select(*fields)
    return parsed.select(*fields, "raw_text", bad.alias("is_corrupt"))


def encode_json_value(df: DataFrame, column: str = "value") -> DataFrame:
    """Rows -> one JSON message per row as bytes (the inverse, for tests
    and for writing a topic)."""
    return df.select(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]))
                     .cast("binary").alias(column))
