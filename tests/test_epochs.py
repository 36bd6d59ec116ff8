"""Test-then-train goes on for every block, also where many blocks share a micro-batch."""

import datetime

from pyspark.sql import functions as F
from test_streaming import _batch_oracle

from tessera.operators import learn
from tessera.plans import catalog
from tessera.session import scratch_path
from tessera.streaming import prequential, replay


def _events(spark, path, blocks, rows=4):
    """Class a in the first blocks, b later on: only a model that goes on learning ever says b."""
    now = datetime.datetime(2020, 1, 1)
    spark.createDataFrame(
        [(b * catalog.BLOCK_EVENTS + i, now, i, "a" if b < 20 or i == 0 else "b", 1.0, '{"k": 1}')
         for b in range(blocks) for i in range(rows)],
        "event_id long, ts timestamp, user_id long, event_type string, value double, props string") \
        .write.parquet(f"{path}/events.parquet")


def test_majority_learns_from_every_block(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(replay, "FILES_PER_BATCH", 1)          # 32 blocks, then the others
    _events(spark, tmp_path, 70)
    got = {r.epoch: (r.n_rows, r.n_correct) for r in catalog.prequential_metrics(spark, str(tmp_path)).collect()}
    rows = catalog._sensor_blocks(spark, str(tmp_path))
    assert got == _batch_oracle(rows, 10 ** 9) != _batch_oracle(rows, 40)
    assert got[69] == (4, 3)


def test_a_learner_of_whole_tables_trains_after_every_batch(spark, tmp_path, monkeypatch):
    """The forest is fitted again after each block, whatever its number."""
    _events(spark, tmp_path, 1)
    runs = []
    monkeypatch.setattr(catalog, "_run_blocks", lambda run, rows, name: runs.append(run) or spark.createDataFrame(
        [(0, 1, 1, 1, 1)], "epoch long, n_rows long, n_correct long, cum_rows long, cum_correct long"))
    catalog.prequential_forest(spark, str(tmp_path))
    run = prequential.Prequential(spark, lambda b: b, learn.MajorityClass(), scratch_path(spark, "late"),
                                  retrain_until=runs[0].retrain_until)
    assert not runs[0].steps() and runs[0].history_epochs is None
    for e in (0, 45):
        run.process(spark.createDataFrame([("a",)], "label string"), e)
    assert replay.list_epochs(spark, run._path("model"), "_DONE") == [0, 45]


def test_no_rows_no_epochs(spark):
    run = prequential.Prequential(spark, lambda b: b, learn.MajorityClass(), scratch_path(spark, "none"))
    rows = spark.createDataFrame([], "label string, block long")
    assert catalog._run_blocks(run, rows, "none").count() == 0
