"""Prequential (test-then-train) evaluation on Structured Streaming
(T4-T10, S7, U3).

Every micro-batch is first scored by the model trained on *earlier*
batches, then added to the training history, on which the model is retrained
(every ``retrain_every`` epochs; ``history_epochs`` bounds the training window;
with ``retrain_until`` only while ``epoch + 1`` is below it).  Rows are never scored
by a model that has seen them, and every row is scored (the first batch
may be scored by a model fitted on itself, ``first_batch='self'``).

State lives in tables under ``state_dir`` (a folder on shared storage),
not in driver variables, so a restarted query resumes where it stopped:

* ``history/epoch=N``  prepared rows of batch N (overwritten on replay)
* ``model/epoch=N``    model fitted on history <= N (``_DONE`` marks it)
* ``metrics/epoch=N``  rows scored and correct in batch N, and running
                       totals (one small JSON row per epoch)
* ``steps/batch=N``, ``frozen/batch=N``  prepared rows of many epochs
* ``steps_metrics/batch=N``, ``frozen_metrics/batch=N``  the same row for each of those epochs

A learner that has ``learn_epochs`` takes many epochs from one micro-batch, by their column
``epoch``: :meth:`Prequential.run_steps` still scores each by the model of those before it
and then learns from it.  With ``retrain_until`` the model stays as it is from that epoch on,
and :meth:`Prequential.run_frozen` scores many epochs at once.

All are written per epoch with overwrite, so replaying an epoch
after a failure gives the same tables (idempotent sink).  Training reads
the history table, never a union of past micro-batch plans.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.classification import (LogisticRegression, LogisticRegressionModel,
                                       RandomForestClassificationModel,
                                       RandomForestClassifier)
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tessera.operators.learn import MajorityClass, MajorityClassModel, hits
from tessera.streaming.replay import list_epochs, read_text, touch, write_text

_DONE = "_DONE"
_METRICS_SCHEMA = "n_rows long, n_correct long, cum_rows long, cum_correct long, epoch int"


def _model_class(learner):
    if isinstance(learner, RandomForestClassifier):
        return RandomForestClassificationModel
    if isinstance(learner, LogisticRegression):
        return LogisticRegressionModel
    raise TypeError(f"no model class known for {type(learner).__name__}")


def save_model(spark: SparkSession, model, path: str) -> None:
    if hasattr(model, "to_json"):
        write_text(spark, f"{path}/model.json", model.to_json())
    elif isinstance(model, MajorityClassModel):
        # one value: a few bytes of JSON, no Spark job needed
        write_text(spark, f"{path}/model.json", json.dumps(
            {"value": model.value, "counts": list(model.counts.items())}))
    else:
        model.write().overwrite().save(path)
    touch(spark, f"{path}/{_DONE}")


def load_model(spark: SparkSession, learner, path: str):
    if hasattr(learner, "load"):
        return learner.load(read_text(spark, f"{path}/model.json"))
    if isinstance(learner, MajorityClass):
        saved = json.loads(read_text(spark, f"{path}/model.json"))
        return MajorityClassModel(saved["value"], {k: n for k, n in saved["counts"]})
    return _model_class(learner).load(path)


@dataclass
class Prequential:
    """Test-then-train over a stream of micro-batches.

    prepare:  batch DataFrame -> (label, features...) rows
    learner:  object with ``fit(df) -> model``; ``model.transform`` adds
              ``prediction``
    """

    spark: SparkSession
    prepare: Callable[[DataFrame], DataFrame]
    learner: object
    state_dir: str
    first_batch: str = "self"
    retrain_until: int | None = None
    history_epochs: int | None = None
    retrain_every: int = 1
    # newest (epoch, model) trained in this process; after a restart it
    # is empty and the model is loaded from ``model/epoch=N`` instead.
    _latest: tuple | None = None
    # (epoch, cum_rows, cum_correct) of the newest metrics row written here
    _totals: tuple | None = None

    def _path(self, kind: str, epoch: int | None = None) -> str:
        base = f"{self.state_dir}/{kind}"
        return base if epoch is None else f"{base}/epoch={epoch}"

    def history(self, upto: int, after: int | None = None) -> DataFrame:
        """Prepared rows of the epochs up to ``upto`` (and after ``after``)."""
        h = self.spark.read.option("basePath", self._path("history")) \
            .parquet(self._path("history"))
        cond = F.col("epoch") <= upto
        if after is not None:
            cond = cond & (F.col("epoch") > after)
        elif self.history_epochs:
            cond = cond & (F.col("epoch") > upto - self.history_epochs)
        return h.where(cond).drop("epoch")

    def _fit(self, epoch: int):
        """A model of the history: from the rows since the last model where the learner
        can go on from it, else from all of them."""
        if not hasattr(self.learner, "update") or self.history_epochs:
            return self.learner.fit(self.history(epoch))
        model, at = self._model_before(epoch), self._trained_before(epoch)
        return self.learner.update(model, self.history(epoch, after=-1 if at is None else at))

    def _trained_before(self, epoch: int) -> int | None:
        """The last epoch before ``epoch`` that a model was trained at."""
        if self._latest is not None and self._latest[0] == epoch - 1:
            return epoch - 1
        earlier = [e for e in list_epochs(self.spark, self._path("model"), _DONE) if e < epoch]
        return earlier[-1] if earlier else None

    def _model_before(self, epoch: int):
        """Newest model trained on epochs before ``epoch`` (None if none)."""
        if self._latest is not None and self._latest[0] == epoch - 1:
            return self._latest[1]          # trained by this process just before
        earlier = [e for e in list_epochs(self.spark, self._path("model"), _DONE) if e < epoch]
        if not earlier:
            return None
        if self._latest is not None and self._latest[0] == earlier[-1]:
            return self._latest[1]
        return load_model(self.spark, self.learner, self._path("model", earlier[-1]))

    def process(self, batch: DataFrame, epoch: int) -> None:
        spark = self.spark
        prepared = self.prepare(batch)
        history_path = self._path("history", epoch)
        model = self._model_before(epoch)
        if model is not None:
            # score while persisting the batch: one pass over the batch, the
            # counts are collected by an Observation during the write job
            obs = Observation(f"prequential_{epoch}_{uuid.uuid4().hex[:8]}")
            scored = model.transform(prepared)
            scored.observe(obs, F.count(F.lit(1)).alias("n_rows"),
                           F.sum(hits(scored)).alias("n_correct")) \
                .select(*prepared.columns).write.mode("overwrite").parquet(history_path)
            got = obs.get
            n_rows, n_correct = got["n_rows"] or 0, got["n_correct"] or 0
        else:
            # persist the batch first (idempotent, cuts the lineage)
            prepared.write.mode("overwrite").parquet(history_path)
            rows = spark.read.parquet(history_path)
            if self.first_batch == "self":
                own = self.learner.fit(rows)
                scored = own.transform(rows)
                agg = scored.agg(F.count(F.lit(1)).alias("n_rows"),
                                 F.coalesce(F.sum(hits(scored)), F.lit(0)).alias("n_correct")
                                 ).first()
                n_rows, n_correct = agg["n_rows"], agg["n_correct"]
            else:
                n_rows, n_correct = 0, 0
        # one aggregate row per epoch: running totals continue from the
        # previous epoch's row (no window over the table), and a replay
        # rewrites the same small file
        base_rows, base_correct = self._previous_totals(epoch)
        row = {"n_rows": n_rows, "n_correct": n_correct,
               "cum_rows": base_rows + n_rows, "cum_correct": base_correct + n_correct}
        write_text(spark, f"{self._path('metrics', epoch)}/metrics.json", json.dumps(row))
        if self._totals is None or self._totals[0] < epoch:
            self._totals = (epoch, row["cum_rows"], row["cum_correct"])
        # 3. learn from everything seen so far
        if (self.retrain_until is None or epoch + 1 < self.retrain_until) and epoch % self.retrain_every == 0:
            fitted = self._fit(epoch)
            save_model(spark, fitted, self._path("model", epoch))
            self._latest = (epoch, fitted)

    def process_frozen(self, batch: DataFrame, number: int) -> None:
        """Scores whole epochs (column ``epoch``, kept by ``prepare``) that come after the
        last training; one row per epoch of the batch reaches the driver."""
        path = f"{self._path('frozen')}/batch={number}"
        prepared = self.prepare(batch)
        scored = self._model_before(self.retrain_until).transform(prepared)
        scored.select(*prepared.columns, hits(scored).alias("__hit")).write.mode("overwrite").parquet(path)
        per = self.spark.read.parquet(path).groupBy("epoch").agg(
            F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("__hit"), F.lit(0)).alias("k")).collect()
        self._write_totals("frozen_metrics", number, sorted(per))

    def _write_totals(self, kind: str, number: int, per: list[tuple[int, int, int]]) -> None:
        """The metrics (epoch, rows, hits) of a batch's epochs with totals that go on from the batch before."""
        if number:
            last = read_text(self.spark, f"{self._path(kind)}/batch={number - 1}/metrics.json")
            last = json.loads(last.splitlines()[-1])
            rows, correct = last["cum_rows"], last["cum_correct"]
        else:
            rows, correct = self._previous_totals(per[0][0])
        lines = []
        for epoch, n, k in per:
            rows, correct = rows + n, correct + k
            lines.append(json.dumps({"n_rows": n, "n_correct": k, "cum_rows": rows, "cum_correct": correct,
                                     "epoch": epoch}))
        write_text(self.spark, f"{self._path(kind)}/batch={number}/metrics.json", "\n".join(lines))

    def steps(self) -> bool:
        """Whether many epochs may share a micro-batch while the model learns."""
        return (hasattr(self.learner, "learn_epochs") and self.retrain_until is None
                and self.retrain_every == 1 and not self.history_epochs)

    def process_steps(self, batch: DataFrame, number: int) -> None:
        """Tests, then trains, epoch by epoch of a batch (column ``epoch``, kept by ``prepare``)."""
        path = f"{self._path('steps')}/batch={number}"
        self.prepare(batch).write.mode("overwrite").parquet(path)
        rows = self.spark.read.parquet(path)
        first, last = rows.agg(F.min("epoch"), F.max("epoch")).first()
        before = self._model_before(first)
        model, per = self.learner.learn_epochs(before, rows)
        if before is None and self.first_batch != "self":
            per[0] = (per[0][0], 0, 0)
        self._write_totals("steps_metrics", number, per)
        save_model(self.spark, model, self._path("model", last))
        self._latest = (last, model)

    def run_frozen(self, stream: DataFrame) -> None:
        """Scores all that a stream of later epochs has (after :meth:`run`), then stops."""
        self._run_all(stream, self.process_frozen, "frozen_checkpoint")

    def run_steps(self, stream: DataFrame) -> None:
        """Tests and trains on all that a stream of epochs has, then stops; micro-batches hold whole epochs."""
        self._run_all(stream, self.process_steps, "steps_checkpoint")

    def _run_all(self, stream: DataFrame, process: Callable[[DataFrame, int], None], checkpoint: str) -> None:
        q = (stream.writeStream.foreachBatch(lambda df, n: process(df, n))
             .option("checkpointLocation", self._path(checkpoint))
             .trigger(availableNow=True).start())
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(str(q.exception()))

    def run(self, stream: DataFrame, trigger: dict | None = None,
            timeout_s: float | None = None, stop_after_rows: int | None = None,
            poll_s: float = 1.0):
        """Start the stream with ``foreachBatch``.

        Default trigger is ``availableNow`` (process what exists, then
        stop).  With a processing-time trigger the query runs until
        ``timeout_s`` or, with ``stop_after_rows``, until that many rows
        have been scored (read from the metrics table, not a driver flag).
        """
        trigger = trigger or {"availableNow": True}
        q = (stream.writeStream.foreachBatch(lambda df, e: self.process(df, e))
             .option("checkpointLocation", self._path("checkpoint"))
             .trigger(**trigger).start())
        if stop_after_rows is None:
            q.awaitTermination(timeout_s)
        else:
            waited = 0.0
            while q.isActive and (timeout_s is None or waited < timeout_s):
                if q.awaitTermination(poll_s):
                    break
                waited += poll_s
                if self.rows_scored() >= stop_after_rows:
                    break
        if q.isActive:
            q.stop()
        if q.exception() is not None:
            raise RuntimeError(str(q.exception()))
        return q

    def _previous_totals(self, epoch: int) -> tuple[int, int]:
        if self._totals is not None and self._totals[0] == epoch - 1:
            return self._totals[1], self._totals[2]
        earlier = [e for e in list_epochs(self.spark, self._path("metrics")) if e < epoch]
        if not earlier:
            return 0, 0
        row = json.loads(read_text(self.spark,
                                   f"{self._path('metrics', earlier[-1])}/metrics.json"))
        return row["cum_rows"], row["cum_correct"]

    def rows_scored(self) -> int:
        done = list_epochs(self.spark, self._path("metrics"))
        if not done:
            return 0
        return self._previous_totals(done[-1] + 1)[0]

    def metrics(self) -> DataFrame:
        """Per-epoch and running accuracy (T8), read from the metrics table."""
        parts = []
        if list_epochs(self.spark, self._path("metrics")):
            parts.append(self.spark.read.schema(_METRICS_SCHEMA)
                         .option("basePath", self._path("metrics")).json(self._path("metrics")))
        for kind in ("steps_metrics", "frozen_metrics"):
            shared = [f"{self._path(kind)}/batch={n}"
                      for n in list_epochs(self.spark, self._path(kind), name="batch")]
            if shared:
                parts.append(self.spark.read.schema(_METRICS_SCHEMA).json(shared))
        m = reduce(DataFrame.unionByName, parts) if parts else self.spark.createDataFrame([], _METRICS_SCHEMA)
        return m.select(F.col("epoch").cast("long").alias("epoch"), "n_rows", "n_correct",
                        "cum_rows", "cum_correct")
