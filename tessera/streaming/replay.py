"""Stage a table as an ordered file stream (test / replay harness).

A message broker hands out offsets in order; a file stream orders files
by modification time.  ``stage_blocks`` writes one file per block and
stamps the files with increasing times, so a stream with
``maxFilesPerTrigger=1`` sees the blocks one per micro-batch, in order.
Blocks that need no micro-batch of their own go ``PACK`` to a file and
``FILES_PER_BATCH`` files to a micro-batch, so that the fixed cost of a batch is
paid once per some hundred blocks and its rows are read by several tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PACK = 32
FILES_PER_BATCH = 16


def pack_of(block: Column) -> Column:
    """The file that a block goes to, in the order of the blocks; a block is never cut."""
    return F.floor(block / PACK)


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def stage_blocks(df: DataFrame, block_col: str, path: str, base_millis: int = 1_600_000_000_000
                 ) -> str:
    """Write ``df`` partitioned by ``block_col`` (one file per block) and
    order the files by block through their modification times."""
    df.repartition(block_col).write.mode("overwrite").partitionBy(block_col).parquet(path)
    spark = df.sparkSession
    fs, root = _fs(spark, path)
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        if not status.isDirectory() or "=" not in name:
            continue
        block = int(name.split("=", 1)[1])
        for f in fs.listStatus(status.getPath()):
            if f.getPath().getName().endswith(".parquet"):
                stamp = base_millis + 1000 * block
                fs.setTimes(f.getPath(), stamp, stamp)
    return path


def list_epochs(spark: SparkSession, path: str, marker: str | None = None, name: str = "epoch") -> list[int]:
    """Epoch numbers of ``path/epoch=N`` folders (those holding ``marker``
    if given), ascending."""
    prefix = f"{name}="
    fs, root = _fs(spark, path)
    if not fs.exists(root):
        return []
    out = []
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        if status.isDirectory() and name.startswith(prefix):
            if marker and not fs.exists(status.getPath().suffix(f"/{marker}")):
                continue
            out.append(int(name.split("=", 1)[1]))
    return sorted(out)


def touch(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.create(p, True).close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small text file (a few bytes of state) through Hadoop FS."""
    fs, p = _fs(spark, path)
    out = fs.create(p, True)
    out.write(bytearray(text.encode("utf-8")))
    out.close()


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        jvm = spark.sparkContext._jvm
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
