"""A decision tree that learns batch by batch.

The state is the tree and, per leaf, how many rows of each class fell into each
bin of each feature.  Such histograms add up, so a batch is read once, its counts
are one aggregate (partial aggregation: a task shuffles at most leaves x features
x bins x classes rows), and no earlier batch is ever read again.  A leaf splits
when, by Hoeffding's inequality, its best feature beats the second best, or when
both are within ``tie``.

The driver holds the state, whose size is bounded by the parameters
(``max_leaves`` x features x ``bins`` x ``max_classes`` counts), whatever the
number of rows.  Bins are cut at quantiles of the first batch.
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.learn import accuracy

DRIVER_CELLS = 500_000         # cells of epochs that the driver takes at a time, if an epoch has fewer


@dataclass
class HistogramTreeModel:
    """``nodes[i]`` is ``[feature, bin, left, right]`` or, for a leaf, None; ``counts[i]`` the leaf's
    cells (feature, bin, class) -> rows; ``classes[i]`` its rows per class."""

    edges: list[list[float]]
    nodes: list = field(default_factory=lambda: [None])
    counts: dict[int, dict[tuple[int, int, int], float]] = field(default_factory=dict)
    classes: dict[int, dict[int, float]] = field(default_factory=dict)
    labels: list = field(default_factory=list)
    features_col: str = "features"

    def leaf(self, node: int = 0) -> Column:
        """The leaf of a row; a missing or NaN value counts as the least."""
        if self.nodes[node] is None:
            return F.lit(node)
        f, b, left, right = self.nodes[node]
        value = F.get(F.col(self.features_col), F.lit(f))
        return F.when(F.coalesce(value > self.edges[f][b], F.lit(False)) & ~F.isnan(value), self.leaf(right)) \
            .otherwise(self.leaf(left))

    def bins(self) -> Column:
        """Per feature the number of edges below the value."""
        edges = F.array(*[F.array(*[F.lit(float(e)) for e in own]) for own in self.edges]).cast("array<array<double>>")
        return F.transform(F.col(self.features_col), lambda v, i: F.when(F.isnan(v), 0).otherwise(
            F.size(F.filter(F.get(edges, i), lambda e: F.coalesce(e < v, F.lit(False))))))

    def answer(self, leaf: int):
        own = self.classes.get(leaf) or {}
        return self.labels[min(own, key=lambda c: (-own[c], c))] if own else None

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with ``prediction``."""
        leaves = [i for i, n in enumerate(self.nodes) if n is None]
        answers = {i: self.answer(i) for i in leaves}
        kind = dict(df.dtypes).get("label", "string")
        pairs = [x for i in leaves if answers[i] is not None for x in (F.lit(i), F.lit(answers[i]).cast(kind))]
        found = F.try_element_at(F.create_map(*pairs), self.leaf()) if pairs else F.lit(None)
        return df.withColumn("prediction", found.cast(kind))

    def to_json(self) -> str:
        return json.dumps({"edges": self.edges, "nodes": self.nodes, "labels": self.labels,
                           "features_col": self.features_col,
                           "counts": [[i, [[*k, n] for k, n in own.items()]] for i, own in self.counts.items()],
                           "classes": [[i, list(own.items())] for i, own in self.classes.items()]})

    @classmethod
    def from_json(cls, text: str) -> HistogramTreeModel:
        told = json.loads(text)
        return cls(told["edges"], told["nodes"], {i: {tuple(c[:3]): c[3] for c in own} for i, own in told["counts"]},
                   {i: {c: n for c, n in own} for i, own in told["classes"]}, told["labels"], told["features_col"])


def _impurity(counts: np.ndarray) -> np.ndarray:
    """Rows times Gini impurity along the last axis."""
    total = counts.sum(axis=-1)
    return total - (counts ** 2).sum(axis=-1) / np.maximum(total, 1e-12)


@dataclass
class HistogramTree:
    """Learner for rows of ``label`` and ``features_col`` (an array of doubles)."""

    bins: int = 16
    max_leaves: int = 32
    min_rows: int = 50
    confidence: float = 0.01
    tie: float = 0.05
    max_classes: int = 1000
    features_col: str = "features"

    def fit(self, df: DataFrame) -> HistogramTreeModel:
        return self.update(None, df)

    def load(self, text: str) -> HistogramTreeModel:
        return HistogramTreeModel.from_json(text)

    def update(self, model: HistogramTreeModel | None, df: DataFrame) -> HistogramTreeModel:
        """The model after a batch; it and the batch are all that is read."""
        if model is None or not model.edges:
            model = HistogramTreeModel(self._edges(df), features_col=self.features_col)
        else:
            model = HistogramTreeModel.from_json(model.to_json())        # a replay starts from the same state
        binned = df.where("label IS NOT NULL").select(
            "label", model.leaf().alias("leaf"), F.posexplode(model.bins()).alias("feature", "bin"))
        table = binned.groupBy("leaf", "feature", "bin", "label").count()
        self._learn(model, [tuple(r) for r in table.toLocalIterator()])
        return model

    def learn_epochs(self, model: HistogramTreeModel | None, df: DataFrame
                     ) -> tuple[HistogramTreeModel | None, list[tuple[int, int, int]]]:
        """(the model after the epochs of ``df``, their (epoch, rows, hits)): each is scored by the
        model of those before it (the very first by its own) and then learnt, as :meth:`update` does.

        The counts of many epochs come from one aggregate by the leaves of the tree as it
        is; the epochs after one in which a leaf splits are counted again.  A tree splits
        ``max_leaves - 1`` times at most, so the passes are few.
        """
        epochs = sorted(r["epoch"] for r in df.select("epoch").distinct().collect())
        told, at, many = [], 0, 4
        model = model and HistogramTreeModel.from_json(model.to_json())  # a replay starts from the same state
        while at < len(epochs):
            if model is None or not model.edges:             # the bins come from this epoch
                rows = df.where(F.col("epoch") == epochs[at])
                learnt = self.update(model, rows)
                found = accuracy((learnt if model is None else model).transform(rows)).first()
                told.append((epochs[at], found["n_rows"], found["n_correct"] or 0))
                model, at = learnt, at + 1
                continue
            some = epochs[at:at + many]
            cells = self._cells(model, df.where(F.col("epoch").between(some[0], some[-1])))
            split = False
            for epoch in some:
                own = cells.get(epoch, [])
                rows = [(leaf, label, n) for leaf, feature, _, label, n in own if feature < 0]
                answers = {leaf: model.answer(leaf) for leaf, _, _ in rows}
                told.append((epoch, sum(n for *_, n in rows), sum(
                    n for leaf, label, n in rows if label is not None and label == answers[leaf])))
                split = self._learn(model, [c for c in own if c[1] >= 0 and c[3] is not None])
                at += 1
                if split:
                    break
            most = max(1, DRIVER_CELLS * len(some) // max(1, sum(map(len, cells.values()))))
            many = max(1, many // 2) if split else min(2 * many, most)
        return model, told

    def _cells(self, model: HistogramTreeModel, df: DataFrame) -> dict:
        """Per epoch the (leaf, feature, bin, label, rows); as feature -1 the rows themselves."""
        table = df.select("epoch", "label", model.leaf().alias("leaf"), F.posexplode(F.concat(
            F.array(F.lit(0)), F.coalesce(model.bins(), F.array().cast("array<int>")))).alias("feature", "bin"))
        table = table.groupBy("epoch", "leaf", F.col("feature") - 1, "bin", "label").count().toArrow()
        found: dict = {}
        for epoch, *cell in zip(*(c.to_pylist() for c in table.columns)):
            found.setdefault(epoch, []).append(tuple(cell))
        return found

    def _learn(self, model: HistogramTreeModel, cells: list[tuple]) -> bool:
        """Adds the (leaf, feature, bin, label, rows) of an epoch to the model; whether a leaf split."""
        number = {label: i for i, label in enumerate(model.labels)}
        if any(label not in number for *_, label, _ in cells):           # new labels are numbered in this order
            cells = sorted(cells, key=lambda r: tuple(map(str, r)))
        for leaf, feature, b, label, n in cells:
            c = number.setdefault(label, len(number))
            if c >= self.max_classes:
                raise ValueError(f"more than {self.max_classes} classes")
            own = model.counts.setdefault(leaf, {})
            own[(feature, b, c)] = own.get((feature, b, c), 0) + n
            if feature == 0:
                seen = model.classes.setdefault(leaf, {})
                seen[c] = seen.get(c, 0) + n
        model.labels = sorted(number, key=number.get)
        nodes = len(model.nodes)
        for leaf in sorted(model.counts):
            self._split(model, leaf)
        return len(model.nodes) > nodes

    def _edges(self, df: DataFrame) -> list[list[float]]:
        """Quantiles of each feature in the first batch: one aggregate, features x bins numbers."""
        shares = [i / self.bins for i in range(1, self.bins)]
        value = F.when(~F.isnan("v"), F.col("v"))
        rows = df.select(F.posexplode(self.features_col).alias("i", "v")).groupBy("i").agg(
            F.percentile_approx(value, shares, 10 * self.bins).alias("q")).collect()
        found = {r["i"]: sorted(set(r["q"] or [])) for r in rows}
        return [found.get(i, []) for i in range(max(found, default=-1) + 1)]

    def _split(self, model: HistogramTreeModel, leaf: int) -> None:
        own = model.classes.get(leaf, {})
        n = sum(own.values())
        grown = sum(node is None for node in model.nodes)
        if n < self.min_rows or len(own) < 2 or grown >= self.max_leaves:
            return
        cells = np.zeros((len(model.edges), self.bins, len(model.labels)))
        for (f, b, c), count in model.counts[leaf].items():
            cells[f, b, c] = count
        seen = cells.sum(axis=(1, 2))                       # rows since the leaf has been there
        below = cells.cumsum(axis=1)[:, :-1]
        above = cells.sum(axis=1, keepdims=True) - below
        gain = (_impurity(cells.sum(axis=1))[:, None] - _impurity(below) - _impurity(above)) / np.maximum(seen, 1)[:, None]
        for f, edges in enumerate(model.edges):
            gain[f, len(edges):] = -1
        best = gain.max(axis=1)
        order = np.argsort(-best, kind="stable")
        f = int(order[0])
        second = best[order[1]] if len(order) > 1 else 0.0
        reach = math.sqrt(math.log(1 / self.confidence) / (2 * max(1.0, seen[f])))
        if best[f] <= 1e-9 or seen[f] < self.min_rows or (best[f] - second <= reach and reach > self.tie):
            return
        b = int(gain[f].argmax())
        left, right = len(model.nodes), len(model.nodes) + 1
        model.nodes[leaf] = [f, b, left, right]
        model.nodes += [None, None]
        for child, counts in ((left, below[f, b]), (right, above[f, b])):
            model.classes[child] = {c: float(k) for c, k in enumerate(counts) if k}
        del model.counts[leaf], model.classes[leaf]
