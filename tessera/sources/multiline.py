"""CSV with line breaks inside quoted fields, read by several tasks per file.

Spark's own multi-line reader takes each file as one split.  Here the lines
are read as text, which splits anywhere, and records are put together again:

1. Each line says in which state it ends if it begins at the start of a
   record, and in which if it begins inside a quoted field.
2. Within a split (one task's share of a file) the state before each line
   follows from the lines before it and the split's first state.
3. A split's effect is one row; a prefix over the splits of a file gives
   every split its first state.
4. A record begins where a line begins outside quotes.  The lines of a split
   are joined to records in place; only the lines that continue a record of
   an earlier split, at most one group a split, go to that split.

The text is shuffled once, by (file, split), which bounds each group by the
size of a split.  Nothing reaches the driver.

Defined results: fields are quoted by ``"`` at their first sign and a quote
inside is doubled; a quote elsewhere is an ordinary sign; after a closing quote
the rest up to the comma belongs to the field.  Lines end with ``\\n`` or
``\\r\\n``.  The first record of a file that is not empty is its header;
empty records are dropped; a quote that is never closed takes the rest of its
file.  Missing fields are NULL and surplus ones are dropped, as in Spark's reader.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_FIELD = r'(?:"(?:[^"]++|"")*+"[^,]*+|[^",][^,]*+|)'
_OPEN = r'"(?:[^"]++|"")*+'
# Ends inside quotes, begun at a record's start or inside quotes.
FROM_OUTSIDE = rf'^(?:{_FIELD},)*+{_OPEN}\z'
FROM_INSIDE = rf'^(?:[^"]++|"")*+(?:"[^,]*+,(?:{_FIELD},)*+{_OPEN})?\z'

_SPLIT = ["__file", "__block"]


def _state(entry: Column, fixed: Column, flips: Column) -> Column:
    """The state after lines of which the last to fix it left ``fixed`` (NULL: none did) and
    ``flips`` lines since then changed it."""
    return (F.coalesce(fixed, entry) + flips) % 2


def _effects(lines: DataFrame) -> DataFrame:
    """Per line: how the lines before it in its split change the split's first state."""
    before = Window.partitionBy(*_SPLIT).orderBy("__seq").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy(*_SPLIT).orderBy("__seq")
    fixes = F.col("__out") == F.col("__in")
    flip = F.when(~fixes & (F.col("__out") == 1), 1).otherwise(0)
    counted = lines.withColumn("__flips", F.sum(flip).over(upto))
    last = F.last(F.when(fixes, F.struct("__out", "__flips")), ignorenulls=True)
    known, flips = last.over(before), F.coalesce(F.lag("__flips").over(upto), F.lit(0))
    return counted.withColumns({
        "__fixed": known["__out"], "__turns": flips - F.coalesce(known["__flips"], F.lit(0))})


def _splits(effects: DataFrame) -> DataFrame:
    """One row per split: its first state, the record that is open when it begins, and the file's
    header if it is in this split."""
    end = F.max_by(F.struct(
        F.when(F.col("__out") == F.col("__in"), F.col("__out")).otherwise(F.col("__fixed")).alias("fixed"),
        F.when(F.col("__out") == F.col("__in"), 0).otherwise(F.col("__turns") + F.col("__out")).alias("turns")),
        "__seq").alias("__end")
    starts = []
    for e in (0, 1):
        begin = F.when(_state(F.lit(e), F.col("__fixed"), F.col("__turns")) == 0, F.col("__seq"))
        starts += [F.max(begin).alias(f"__start{e}"), F.min(F.when(F.col("__line") != "", begin)).alias(f"__first{e}")]
    splits = effects.groupBy(*_SPLIT).agg(end, *starts)
    order = Window.partitionBy("__file").orderBy("__block")             # one row per split of a file
    upto, before = order.rowsBetween(Window.unboundedPreceding, 0), order.rowsBetween(Window.unboundedPreceding, -1)
    flips = F.col("__end.turns") % 2
    splits = splits.withColumn("__fix", F.col("__end.fixed")) \
        .withColumn("__all", F.sum(flips).over(upto)) \
        .withColumn("__fix_all", F.when(F.col("__fix").isNotNull(), F.struct("__fix", flips.alias("own"), "__all")))
    last = F.last("__fix_all", ignorenulls=True).over(before)
    seen = F.coalesce(F.lag("__all").over(order), F.lit(0))
    # a split that fixes its state also makes its own flips after that
    entry = F.when(last.isNull(), seen).otherwise(last["__fix"] + last["own"] + seen - last["__all"]) % 2
    splits = splits.withColumn("__entry", entry.cast("int"))
    own = F.when(F.col("__entry") == 0, F.col("__start0")).otherwise(F.col("__start1"))
    first = F.when(F.col("__entry") == 0, F.col("__first0")).otherwise(F.col("__first1"))
    splits = splits.withColumns({
        "__own": F.when(own.isNotNull(), F.struct(F.col("__block").alias("block"), own.alias("seq"))),
        "__lead": F.when(first.isNotNull(), F.struct(F.col("__block").alias("block"), first.alias("seq")))})
    head = F.min("__lead").over(Window.partitionBy("__file"))
    return splits.select(*_SPLIT, "__entry", F.last("__own", ignorenulls=True).over(before).alias("__open"),
                         F.when(head["block"] == F.col("__block"), head["seq"]).alias("__head"))


def read_csv_multiline(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Header CSV with ``"`` quoting whose quoted fields may hold line breaks; splittable.

    Split sizes follow ``spark.sql.files.maxPartitionBytes``.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.regexp_replace("value", r"\r\z", "").alias("__line"), F.col("_metadata.file_path").alias("__file"),
        F.col("_metadata.file_block_start").alias("__block"), F.monotonically_increasing_id().alias("__seq"))
    lines = lines.select(
        "*", F.when(F.contains("__line", F.lit('"')), F.rlike("__line", F.lit(FROM_OUTSIDE)).cast("int"))
        .otherwise(0).alias("__out"),
        F.when(F.contains("__line", F.lit('"')), F.rlike("__line", F.lit(FROM_INSIDE)).cast("int"))
        .otherwise(1).alias("__in"))
    effects = _effects(lines)
    placed = effects.join(_splits(effects), _SPLIT)
    begins = _state(F.col("__entry"), F.col("__fixed"), F.col("__turns")) == 0
    record = F.last(F.when(begins, F.col("__seq")), ignorenulls=True).over(
        Window.partitionBy(*_SPLIT).orderBy("__seq"))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("__seq", "__line"))),
                                      lambda x: x["__line"]), "\n").alias("__text")
    parts = placed.withColumn("__record", record).groupBy(*_SPLIT, "__record", "__open", "__head").agg(joined)
    tails = parts.where(F.col("__record").isNull()).groupBy(
        F.col("__file"), F.col("__open.block").alias("__block"), F.col("__open.seq").alias("__to")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col("__block").alias("b"), "__text"))),
                                 lambda x: x["__text"]), "\n").alias("__tail"))
    whole = parts.where(F.col("__record").isNotNull() & ~F.col("__record").eqNullSafe(F.col("__head"))) \
        .join(tails, _SPLIT, "left")
    text = F.when(F.col("__to") == F.col("__record"), F.concat_ws("\n", "__text", "__tail")).otherwise(F.col("__text"))
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    return whole.where(F.col("__text") != "").select(
        F.from_csv(text, ddl, {"escape": '"', "mode": "PERMISSIVE"}).alias("r")).select("r.*")
