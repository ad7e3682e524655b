"""Boosted trees under the Tweedie loss, on columns that are binned once.

Quantile bins are found and applied once; a row then keeps one byte per feature. Each
level of a tree is one job: tasks add up gradient, curvature and rows by (node, feature,
bin), these partial sums meet in one aggregate, and the driver chooses the splits from
nodes x features x bins numbers, whatever the number of rows. Tasks know the trees fitted
so far and compute margins from them; from time to time margins are stored.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockloom.session import materialize

# Rows of a task; fewer rows than that need one.
TASK_ROWS = 50_000
VALIDATION_SUM, VALIDATION_ROWS = -1, -2


class Tree(NamedTuple):
    """Nodes in heap order; a node without a split has feature -1 and its value counts."""

    feature: np.ndarray
    cut: np.ndarray
    threshold: np.ndarray
    value: np.ndarray

    def leaves(self, columns: np.ndarray, cuts: np.ndarray, levels: int) -> np.ndarray:
        """The node each row ends in; rows above a node's cut go right."""
        rows = np.arange(len(columns))
        node = np.zeros(len(columns), dtype=np.int64)
        for _ in range(levels):
            feature = self.feature[node]
            right = columns[rows, np.maximum(feature, 0)] > cuts[node]
            node = np.where(feature >= 0, 2 * node + 1 + right, node)
        return node


def _empty_tree(depth: int) -> Tree:
    nodes = 2 ** (depth + 1) - 1
    return Tree(
        np.full(nodes, -1, dtype=np.int64), np.zeros(nodes, dtype=np.int64),
        np.zeros(nodes), np.zeros(nodes),
    )


def _binned_rows(batch: pa.RecordBatch, features: int) -> np.ndarray:
    column = batch.column("bins")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int32)[column.offset :]
    data = np.frombuffer(column.buffers()[2], dtype=np.uint8)
    return data[offsets[0] : offsets[len(column)]].reshape(len(column), features)


def _margins(batch: pa.RecordBatch, bins: np.ndarray, trees: list[Tree], depth: int, step: float):
    margin = batch.column("margin").to_numpy()
    for tree in trees:
        margin = margin + step * tree.value[tree.leaves(bins, tree.cut, depth)]
    return margin


def binned(rows: DataFrame, names: tuple[str, ...], splits: list[np.ndarray], start: float) -> DataFrame:
    """(actual, is_validation, margin, bins): each row with one byte per feature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = np.empty((batch.num_rows, len(names)), dtype=np.uint8)
            for place, (name, cuts) in enumerate(zip(names, splits, strict=True)):
                table[:, place] = np.searchsorted(cuts, batch.column(name).to_numpy())
            yield pa.record_batch(
                [
                    batch.column("actual"),
                    batch.column("is_validation"),
                    pa.array(np.full(batch.num_rows, start)),
                    pa.array([row.tobytes() for row in table], pa.binary()),
                ],
                ["actual", "is_validation", "margin", "bins"],
            )

    return rows.mapInArrow(
        run, "actual double, is_validation boolean, margin double, bins binary"
    )


class Booster:
    """Fits trees one level, that is one job, at a time."""

    def __init__(
        self, rows: DataFrame, splits: list[np.ndarray], power: float, step: float, depth: int,
        ridge: float, least_rows: int,
    ) -> None:
        self.rows, self.splits, self.power, self.step, self.depth = rows, splits, power, step, depth
        self.ridge, self.least_rows = ridge, least_rows
        self.width = max(len(cuts) for cuts in splits) + 1
        self.trees: list[Tree] = []
        self.stored = 0
        self.gains: list[np.ndarray] = []

    def _sums(self, tree: Tree, level: int) -> tuple[np.ndarray, float | None]:
        """Sums by node of the level, feature and bin, and at level 0 the validation loss."""
        features, width, power = len(self.splits), self.width, self.power
        trees, depth, step = self.trees[self.stored :], self.depth, self.step
        first, nodes = 2**level - 1, 2**level

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((3, nodes * features * width))
            loss, held = 0.0, 0
            for batch in batches:
                bins = _binned_rows(batch, features)
                margin = _margins(batch, bins, trees, depth, step)
                actual = batch.column("actual").to_numpy()
                validation = batch.column("is_validation").to_numpy(zero_copy_only=False)
                high, low = np.exp(margin * (2.0 - power)), np.exp(margin * (1.0 - power))
                if level == 0:
                    each = 2.0 * (high / (2.0 - power) - actual * low / (1.0 - power))
                    loss, held = loss + each[validation].sum(), held + int(validation.sum())
                node = tree.leaves(bins, tree.cut, level) - first
                # Rows whose node was not split further stay above this level.
                own = ~validation & (node >= 0)
                bins, node = bins[own], node[own]
                slope = (high - actual * low)[own]
                curve = (high * (2.0 - power) + actual * low * (power - 1.0))[own]
                cells = (node[:, None] * features + np.arange(features)) * width + bins
                for place, weight in enumerate((slope, curve, np.ones(len(node)))):
                    each = np.repeat(weight, features)
                    total[place] += np.bincount(cells.ravel(), each, minlength=total.shape[1])
            used = np.flatnonzero(total[2])
            cell = np.concatenate([used, [VALIDATION_SUM, VALIDATION_ROWS]])
            sums = np.concatenate([total[:, used], [[loss, held], [0.0, 0.0], [0.0, 0.0]]], axis=1)
            yield pa.record_batch([pa.array(cell), *map(pa.array, sums)], ["cell", "g", "h", "n"])

        partial = self.rows.mapInArrow(run, "cell bigint, g double, h double, n double")
        found = partial.groupBy("cell").agg(F.sum("g"), F.sum("h"), F.sum("n")).toArrow()
        cell = found.column(0).to_numpy()
        sums = np.stack([found.column(i).to_numpy() for i in (1, 2, 3)])
        table = np.zeros((3, nodes * features * width))
        table[:, cell[cell >= 0]] = sums[:, cell >= 0]
        held = sums[0, cell == VALIDATION_ROWS].sum()
        loss = sums[0, cell == VALIDATION_SUM].sum() / held if held else None
        return table.reshape(3, nodes, features, width), loss

    def _split(self, tree: Tree, level: int, table: np.ndarray) -> bool:
        """Choose the best cut of each node of the level; whether any node was split."""
        left = np.cumsum(table, axis=3)[..., :-1]
        whole = table.sum(axis=3, keepdims=True)
        right = whole - left

        def score(sums: np.ndarray) -> np.ndarray:
            return sums[0] ** 2 / (sums[1] + self.ridge)

        gain = score(left) + score(right) - score(whole)
        gain[(left[2] < self.least_rows) | (right[2] < self.least_rows)] = -np.inf
        for place, cuts in enumerate(self.splits):
            gain[:, place, len(cuts) :] = -np.inf
        nodes, features, width = gain.shape
        best = gain.reshape(nodes, -1).argmax(axis=1)
        split = False
        for node, at in enumerate(best):
            feature, cut = divmod(int(at), width)
            if not gain[node, feature, cut] > 1e-9:
                continue
            split, own = True, 2**level - 1 + node
            tree.feature[own], tree.cut[own] = feature, cut
            tree.threshold[own] = self.splits[feature][cut]
            self.gains[-1][feature] += gain[node, feature, cut]
            for child, side in ((2 * own + 1, left), (2 * own + 2, right)):
                g, h, _ = side[:, node, feature, cut]
                tree.value[child] = -g / (h + self.ridge)
        return split

    def add_tree(self) -> tuple[Tree, float | None]:
        """Fit one more tree; also the validation loss of the trees before it."""
        tree, before = _empty_tree(self.depth), None
        self.gains.append(np.zeros(len(self.splits)))
        for level in range(self.depth):
            table, loss = self._sums(tree, level)
            if level == 0:
                before = loss
                g, h, _ = table[:, 0, 0].sum(axis=1)
                tree.value[0] = -g / (h + self.ridge)
            if not self._split(tree, level, table):
                break
        self.trees.append(tree)
        return tree, before

    def store_margins(self) -> None:
        """Add all trees to the stored margins, so that tasks need only later ones."""
        trees, depth, step = self.trees[self.stored :], self.depth, self.step
        features = len(self.splits)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                bins = _binned_rows(batch, features)
                margin = pa.array(_margins(batch, bins, trees, depth, step))
                yield batch.set_column(batch.schema.get_field_index("margin"), "margin", margin)

        self.rows = materialize(self.rows.mapInArrow(run, self.rows.schema))
        self.stored = len(self.trees)


class Forest:
    """Trees on the scale of the logarithm of the forecast."""

    def __init__(
        self, names: tuple[str, ...], start: float, step: float, depth: int, trees: list[Tree],
        gains: list[float],
    ) -> None:
        self.names, self.start, self.step, self.depth = tuple(names), start, step, depth
        self.trees, self.gains = trees, gains

    def forecast(self) -> Column:
        trees, start, step, depth = self.trees, self.start, self.step, self.depth

        @F.pandas_udf("double")
        def score(*columns: pd.Series) -> pd.Series:
            table = np.stack([c.to_numpy(dtype=float) for c in columns], axis=1)
            margin = np.full(len(table), start)
            for tree in trees:
                margin += step * tree.value[tree.leaves(table, tree.threshold, depth)]
            return pd.Series(np.exp(margin))

        return score(*(F.col(name).cast("double") for name in self.names))

    def dumps(self) -> str:
        trees = [[part.tolist() for part in tree] for tree in self.trees]
        return json.dumps([self.names, self.start, self.step, self.depth, trees, self.gains])

    @staticmethod
    def loads(text: str) -> Forest:
        names, start, step, depth, trees, gains = json.loads(text)
        kinds = (np.int64, np.int64, float, float)
        made = [Tree(*(np.array(p, dtype=k) for p, k in zip(t, kinds))) for t in trees]
        return Forest(tuple(names), start, step, depth, made, gains)


def fit_forest(
    rows: DataFrame,
    names: tuple[str, ...],
    target: str,
    power: float,
    rounds: int,
    step: float,
    depth: int,
    patience: int,
    bins: int,
    ridge: float = 1.0,
    least_rows: int = 5,
    store_every: int = 10,
) -> Forest:
    """Fit on the rows of ``rows`` that are not ``is_validation``; stop by those that are.

    Rounds end after ``patience`` rounds without gain on the validation rows, and trees
    after the best round are dropped. At most 256 ``bins`` per feature.
    """
    if not 2 <= bins <= 256:
        raise ValueError("a bin is one byte")
    plain = rows.select(
        F.col(target).cast("double").alias("actual"),
        "is_validation",
        *(F.col(name).cast("double").alias(name) for name in names),
    )
    plain = materialize(plain)
    fitted = plain.where(~F.col("is_validation"))
    shares = [i / bins for i in range(1, bins)]
    splits = [
        np.unique(np.array(cuts, dtype=float))
        for cuts in fitted.approxQuantile(list(names), shares, 1.0 / (8 * bins))
    ]
    mean, count = plain.agg(
        F.avg(F.when(~F.col("is_validation"), F.col("actual"))), F.count("*")
    ).first()
    start = math.log(max(mean or 0.0, 1e-6))
    parts = max(1, math.ceil(count / TASK_ROWS))
    few = plain.coalesce(1) if parts == 1 else plain.repartition(parts)
    booster = Booster(
        materialize(binned(few, names, splits, start)), splits, power, step, depth, ridge, least_rows
    )
    best_loss, best_round = math.inf, 0
    for number in range(rounds + 1):
        # A round also tells the loss of the trees before it.
        _, loss = booster.add_tree()
        if loss is None:
            best_round = number
        elif loss < best_loss:
            best_loss, best_round = loss, number
        elif number - best_round >= patience:
            break
        if (number + 1) % store_every == 0:
            booster.store_margins()
    gains = sum(booster.gains[:best_round], np.zeros(len(names)))
    return Forest(names, start, step, depth, booster.trees[:best_round], gains.tolist())
