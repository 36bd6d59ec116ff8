"""The incremental tree, the dead-letter stream and the one-pass placement writer."""

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators import tree
from tessera.operators.learn import accuracy
from tessera.plans import catalog, domain
from tessera.session import scratch_path
from tessera.sources import sinks
from tessera.streaming import deadletter, prequential, replay


def _batch(spark, lo, hi):
    """The class follows two thresholds; some values are missing."""
    x, y = F.rand(lo + 1), F.rand(lo + 2)
    return spark.range(lo, hi).select("id", x.alias("x"), y.alias("y")).select(
        F.when(F.col("x") > 0.6, "a").when(F.col("y") > 0.5, "b").otherwise("c").alias("label"),
        F.array("x", F.when(F.col("id") % 50 == 0, None).otherwise(F.col("y")), F.lit(float("nan"))).alias("features"))


def test_tree_learns_from_batches(spark):
    learner, model = tree.HistogramTree(), None
    for i in range(4):
        model = learner.update(model, _batch(spark, 2000 * i, 2000 * (i + 1)))
    test = accuracy(model.transform(_batch(spark, 50_000, 52_000))).first()
    assert test["accuracy"] > 0.9
    again = tree.HistogramTreeModel.from_json(model.to_json())
    assert again == model
    merged = learner.update(again, _batch(spark, 8000, 9000))
    assert merged == learner.update(model, _batch(spark, 8000, 9000))          # a replay gives the same


def test_tree_without_rows_or_labels(spark):
    learner = tree.HistogramTree()
    none = spark.createDataFrame([], "label string, features array<double>")
    model = learner.fit(none)
    assert model.transform(_batch(spark, 0, 10)).where("prediction IS NOT NULL").count() == 0
    one = spark.createDataFrame([(None, [1.0]), ("q", [None]), ("q", [2.0])], "label string, features array<double>")
    model = learner.update(model, one)
    assert {r.prediction for r in model.transform(one).collect()} == {"q"}


def test_prequential_tree_reads_no_old_batch(spark, monkeypatch):
    rows = _batch(spark, 0, 4000).withColumn("block", (F.monotonically_increasing_id() % 4).cast("int"))
    path = replay.stage_blocks(rows, "block", scratch_path(spark, "tree_source"))
    schema = rows.drop("block").schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)
    run = prequential.Prequential(spark, lambda b: b, tree.HistogramTree(), scratch_path(spark, "tree_state"))
    asked = []
    whole = prequential.Prequential.history
    monkeypatch.setattr(prequential.Prequential, "history", lambda self, upto, after=None:
                        asked.append((upto, after)) or whole(self, upto, after))
    run.run(stream)
    assert len(asked) >= 2 and all(after == upto - 1 for upto, after in asked)
    m = {r.epoch: r for r in run.metrics().collect()}
    assert m[max(m)].cum_rows == 4000 and m[max(m)].cum_correct > 0.6 * 4000
    fresh = prequential.Prequential(spark, lambda b: b, tree.HistogramTree(), run.state_dir)
    assert fresh._model_before(99) == run._latest[1]                           # as stored


SCHEMA = T.StructType([T.StructField("n", T.IntegerType())])


def test_dead_letters_survive_a_failure_between_the_sinks(spark, monkeypatch):
    rows = [(i, b"{\"n\": %d}" % i if i % 3 else b"{broken %d" % i) for i in range(30)]
    raw = spark.createDataFrame(rows, "id int, value binary").withColumn("block", (F.col("id") / 10).cast("int"))
    path = replay.stage_blocks(raw, "block", scratch_path(spark, "messages"))
    stream = spark.readStream.schema("id int, value binary").option("maxFilesPerTrigger", 1).parquet(path)
    sink = deadletter.DeadLetterSink(spark, SCHEMA, scratch_path(spark, "letters"))
    assert sink.good().count() == 0 and sink.dead().columns == ["raw_text"]
    write, calls = deadletter.DeadLetterSink._write, []

    def fails_once(self, df, kind, epoch):
        calls.append((kind, epoch))
        if kind == "dead" and calls.count(("dead", 1)) == 1 and epoch == 1:
            raise RuntimeError("killed between the sinks")
        write(self, df, kind, epoch)

    monkeypatch.setattr(deadletter.DeadLetterSink, "_write", fails_once)
    with pytest.raises(Exception):
        sink.run(stream)
    assert sorted(r.n for r in sink.good().collect()) == [i for i in range(10) if i % 3]      # epoch 1 not committed
    sink.run(stream)                                                                          # the replay
    assert sorted(r.n for r in sink.good().collect()) == [i for i in range(30) if i % 3]
    assert sorted(r.raw_text for r in sink.dead().collect()) == sorted("{broken %d" % i for i in range(0, 30, 3))


def test_pieces_equal_the_fragments(spark):
    from tessera.operators import placement as pl
    base = pl.placement_base(domain.movies(spark, SF_SMALL), domain.credits(spark, SF_SMALL))
    base = base.unionByName(base.limit(5)).cache()                  # equal rows: once in a rest, twice elsewhere
    details = domain.credits(spark, SF_SMALL)
    root = scratch_path(spark, "pieces")
    counts = sinks.write_pieces(base, details, catalog.SITES, root)
    assert counts == sinks.manifest(spark, root)
    for spec in catalog.SITES:
        frag = pl.fragment(base, spec)
        want = dict(zip(("part", "rest"), pl.split_fragment(frag, spec))) if spec.split_any_of else {"all": frag}
        if spec.store_details:
            want["details"] = pl.derived_fragment(details, frag)
        assert set(want) == set(sinks.pieces_of(spec))
        for piece, df in want.items():
            got = sinks.read_piece(spark, root, spec, piece, df.columns)
            assert got.columns == df.columns and got.count() == counts[f"{spec.site}/{piece}"]
            assert got.exceptAll(df).count() == 0 and df.exceptAll(got).count() == 0
