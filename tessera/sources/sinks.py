"""Sinks: CSV with array columns as text, and per-site placement output
(S6, C15).  Parquet keeps arrays and is the default format."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators import placement as pl
from tessera.session import scratch_path
from tessera.streaming.replay import read_text, write_text

_MANIFEST = "_manifest.json"
TASK_ROWS = 50_000          # rows of the base table to a task


def arrays_as_text(df: DataFrame) -> DataFrame:
    """Cast every array column to its ``[a, b]`` text form (CSV has no arrays)."""
    return df.select(*[F.col(f"`{f.name}`").cast("string").alias(f.name)
                       if isinstance(f.dataType, T.ArrayType) else F.col(f"`{f.name}`")
                       for f in df.schema.fields])


def write_csv(df: DataFrame, path: str, header: bool = True, mode: str = "overwrite") -> None:
    """CSV sink (S6); arrays are written as text."""
    (arrays_as_text(df).write.mode(mode).option("header", header)
     .option("escape", '"').csv(path))


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: Sequence[str] = ()) -> None:
    """Write ``df`` as Parquet (arrays kept) or CSV (arrays as text)."""
    if fmt == "csv":
        df = arrays_as_text(df)
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        writer = writer.option("header", True).option("escape", '"')
    writer.format(fmt).save(path)


def write_placement(base: DataFrame, details: DataFrame, specs: Sequence[pl.FragmentSpec],
                    root: str, fmt: str = "parquet", key: str = "id") -> dict[str, str]:
    """Write every site's pieces under ``root/<site>/<piece>``.

    The base table is written once and every fragment is read from that
    copy, so the parsing and the join run once, not once per piece (and
    the written copy cuts the lineage).  Returns piece -> path.
    """
    base_path = f"{root}/_base"
    base.write.mode("overwrite").parquet(base_path)
    stored = base.sparkSession.read.parquet(base_path)
    out: dict[str, str] = {}
    for spec in specs:
        frag = pl.fragment(stored, spec)
        pieces = {}
        if spec.split_any_of:
            pieces["part"], pieces["rest"] = pl.split_fragment(frag, spec)
        else:
            pieces["all"] = frag
        if spec.store_details:
            pieces["details"] = pl.derived_fragment(details, frag, key)
        for name, df in pieces.items():
            path = f"{root}/{spec.site}/{name}"
            write_table(df, path, fmt)
            out[f"{spec.site}/{name}"] = path
    return out


def pieces_of(spec: pl.FragmentSpec) -> list[str]:
    """The pieces a site stores."""
    return (["part", "rest"] if spec.split_any_of else ["all"]) + (["details"] if spec.store_details else [])


def write_pieces(base: DataFrame, details: DataFrame, specs: Sequence[pl.FragmentSpec], root: str,
                 key: str = "id") -> dict[str, int]:
    """Every site's pieces in one pass: ``root/site=<site>/piece=<piece>``.

    Each row of the base table is tagged with the pieces it belongs to and exploded
    once, and one job writes all of them.  Equal rows of a rest are one row (EXCEPT);
    attributes a site does not store are NULL there, and :func:`read_piece` leaves them
    out.  Detail rows follow the sites of their key.  The manifest, "<site>/<piece>" -> rows,
    counts what is stored, by the folders' names (an ``Observation`` would also count
    the rows of tasks that ran twice).
    """
    spark = base.sparkSession
    path = scratch_path(spark, "placement_base")
    base.write.parquet(path)                              # parsed and joined once
    stored = spark.read.schema(base.schema).parquet(path)
    tags, owners = [], []
    for spec in specs:
        here = F.coalesce(pl.site_condition(spec), F.lit(False))
        tag = lambda cond, piece: F.when(cond, F.struct(
            F.lit(spec.site).alias("site"), F.lit(piece).alias("piece")))
        if spec.split_any_of:
            own = F.coalesce(pl._any_of(spec.split_column, spec.split_any_of), F.lit(False))
            tags += [tag(here & own, "part"), tag(here & ~own, "rest")]
        else:
            tags.append(tag(here, "all"))
        if spec.store_details:
            owners.append(F.when(here, F.lit(spec.site)))
    present = lambda values: F.filter(F.array(*values), lambda x: x.isNotNull())
    dropped = {c: [s.site for s in specs if c in s.drop] for c in base.columns}
    kept = [F.when(F.col("t.site").isin(sites), None).otherwise(F.col(c)).alias(c) if sites else F.col(c)
            for c, sites in dropped.items()]
    rows = stored.withColumn("t", F.explode(present(tags))).select("t.site", "t.piece", *kept)
    # so many rows to a task, whatever the size of the table
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-stored.count() // TASK_ROWS))
    rows = rows.repartition(parts, *rows.columns).groupBy("site", "piece", *base.columns).agg(F.count(F.lit(1)).alias("__times"))
    times = F.when(F.col("piece") == "rest", 1).otherwise(F.col("__times").cast("int"))
    rows = rows.withColumn("__copy", F.explode(F.array_repeat(F.lit(0), times))).drop("__times", "__copy")
    if owners:
        sites = stored.select(key, F.explode(present(owners)).alias("site")).repartition(parts, key).distinct()
        rows = rows.unionByName(details.repartition(parts, key).join(sites, key).withColumn("piece", F.lit("details")), allowMissingColumns=True)
    rows.write.mode("overwrite").partitionBy("site", "piece").parquet(root)
    written = spark.read.schema(rows.schema).parquet(root).groupBy("site", "piece").count()
    counts = {f"{s.site}/{p}": 0 for s in specs for p in pieces_of(s)}
    counts.update({f"{s}/{p}": n for s, p, n in written.collect()})          # one row per piece
    schema = rows.drop("site", "piece").schema
    write_text(spark, f"{root}/{_MANIFEST}", json.dumps({"counts": counts, "schema": schema.json()}))
    return counts


def manifest(spark: SparkSession, root: str) -> dict[str, int]:
    """"<site>/<piece>" -> rows, as written."""
    return json.loads(read_text(spark, f"{root}/{_MANIFEST}"))["counts"]


def read_piece(spark: SparkSession, root: str, spec: pl.FragmentSpec, piece: str,
               columns: Sequence[str] | None = None) -> DataFrame:
    """One piece with the columns its site stores (of ``columns``, default all)."""
    told = json.loads(read_text(spark, f"{root}/{_MANIFEST}"))
    schema = T.StructType.fromJson(json.loads(told["schema"]))
    drop = () if piece == "details" else spec.drop
    wanted = [c for c in (columns or schema.names) if c not in drop]
    if not told["counts"][f"{spec.site}/{piece}"]:        # nothing written, no folder
        return spark.createDataFrame([], schema).select(wanted)
    return spark.read.schema(schema).parquet(f"{root}/site={spec.site}/piece={piece}").select(wanted)
