"""The incremental tree goes on learning, also where many blocks share a micro-batch."""

from pyspark.sql import functions as F

from tessera.operators import tree
from tessera.plans import catalog
from tessera.session import scratch_path
from tessera.streaming import prequential, replay


def test_many_blocks_at_once_are_as_one_by_one(spark, monkeypatch):
    """The same metrics and the same tree; a replay and a new object change nothing."""
    monkeypatch.setattr(replay, "PACK", 4)
    monkeypatch.setattr(replay, "FILES_PER_BATCH", 1)
    monkeypatch.setattr(tree, "DRIVER_CELLS", 300)
    x, y, i = F.col("id") * 37 % 101 / 101, F.col("id") * 53 % 103 / 103, F.col("id")
    kind = F.when(x > 0.6, "a").when(y > 0.5, "b").otherwise("c")
    rows = spark.range(1000).select(
        (F.floor(i / 100) + i.isin(900, 901).cast("int") * 1).alias("block"),
        F.when(i % 97 == 0, None).when(i > 640, F.concat(kind, F.lit("x"))).otherwise(kind).alias("label"),
        F.when(i % 89 != 0, F.array(x, F.when(i % 50 != 0, y), F.lit(float("nan")))).alias("features"))
    keep = lambda b: b.select("label", "features", *catalog._kept_epoch(b))
    learner = tree.HistogramTree(min_rows=20)
    many = prequential.Prequential(spark, keep, learner, scratch_path(spark, "many"))
    got = sorted(map(tuple, catalog._run_blocks(many, rows, "many").collect()))
    one = prequential.Prequential(spark, keep, learner, scratch_path(spark, "one"))
    for e in range(11):
        one.process(rows.where(F.col("block") == e), e)
    assert got == sorted(map(tuple, one.metrics().collect()))
    assert len(one._latest[1].nodes) > 3 and many._latest[0] == 10 and many._latest[1] == one._latest[1]
    again = prequential.Prequential(spark, keep, learner, many.state_dir)
    again.process_steps(spark.read.parquet(f"{many.state_dir}/steps/batch=1").localCheckpoint(), 1)
    assert got == sorted(map(tuple, again.metrics().collect()))


def test_tree_learns_from_every_block(spark, tmp_path, monkeypatch):
    spark.range(43 * 3).select((F.floor(F.col("id") / 3) * catalog.DOC_BLOCK + F.col("id") % 3).alias("doc_id"),
                               F.lit("il était à").alias("text"), F.lit("fr").alias("lang")) \
        .write.parquet(str(tmp_path / "documents.parquet"))
    runs, metrics = [], prequential.Prequential.metrics
    monkeypatch.setattr(prequential.Prequential, "metrics", lambda self: runs.append(self) or metrics(self))
    assert catalog.prequential_tree(spark, str(tmp_path)).agg(F.max("cum_rows")).first()[0] == 43 * 3
    epoch, model = runs[0]._latest
    assert epoch == 42 and sum(model.classes[0].values()) == 43 * 3
