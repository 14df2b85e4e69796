"""Forests of several depths from one fit."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from threading import Lock

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.sql import DataFrame, Row, SparkSession

from ebbwatch.operators.grown import Grown, grow
from ebbwatch.sources.storage import scratch_path

_NO_SPLIT = {"featureIndex": -1, "leftCategoriesOrThreshold": [], "numCategories": -1}


def _cut(nodes: Mapping[int, Row], depth: int) -> list[dict]:
    """The saved nodes of a tree, down to a depth and numbered anew; as in training, two leaves with one prediction are
    one leaf."""

    def grown(at: int, level: int) -> list[dict]:
        n = nodes[at].asDict()
        leaf = {**n, "gain": -1.0, "leftChild": -1, "rightChild": -1, "split": _NO_SPLIT}
        if n["leftChild"] < 0 or level == depth:
            return [leaf]
        left, right = (grown(n[side], level + 1) for side in ("leftChild", "rightChild"))
        if len(left) == len(right) == 1 and left[0]["prediction"] == right[0]["prediction"]:
            return [{**leaf, "prediction": left[0]["prediction"]}]
        return [{**n, "left": left, "right": right}] + left + right

    def numbered(tree: list[dict]) -> list[dict]:
        place = {id(n): i for i, n in enumerate(tree)}
        rows = []
        for i, n in enumerate(tree):
            below = {} if "left" not in n else {"leftChild": place[id(n["left"][0])], "rightChild": place[id(n["right"][0])]}
            rows.append({**{k: v for k, v in n.items() if k not in ("left", "right")}, "id": i, **below})
        return rows

    return numbered(grown(0, 0))


class CutForests:
    """The forests that a fitted one would have been with less depth.

    Levels are grown one after the other, and a node holds its own class counts, so a forest fitted to less depth with
    the same seed is the upper part of the deeper one. The driver holds the nodes of the model, as it does when it fits it.
    """

    def __init__(self, model: RandomForestClassificationModel):
        self.model, self.spark = model, SparkSession.active()
        path = scratch_path(self.spark, "forest")
        model.write().save(path)
        saved = self.spark.read.parquet(f"{path}/data")
        self.schema = saved.schema
        self.trees: dict[int, dict[int, Row]] = {}
        for tree, node in saved.select("treeID", "nodeData").collect():
            self.trees.setdefault(tree, {})[node.id] = node

    def at(self, depth: int) -> RandomForestClassificationModel:
        path = scratch_path(self.spark, "forest-cut")
        self.model.write().save(path)
        rows = [(tree, node) for tree, nodes in self.trees.items() for node in _cut(nodes, depth)]
        self.spark.createDataFrame(rows, self.schema).write.mode("overwrite").parquet(f"{path}/data")
        return RandomForestClassificationModel.load(path)


class GridForest(RandomForestClassifier):
    """A forest classifier that fits settings which differ in depth alone only once, as deep as asked for.

    After ``on_binned_rows``, it and its copies fit large tables on binned rows.
    """

    grown_from: int | None = None
    frames: dict

    def on_binned_rows(self, from_rows: int) -> GridForest:
        self.grown_from, self.frames = from_rows, {}
        return self

    def _fit(self, dataset: DataFrame) -> RandomForestClassificationModel:
        grown = None if self.grown_from is None else grow(self, dataset, self.grown_from, self.frames)
        if grown is None:
            return super()._fit(dataset)
        model = grown.at(self.getMaxDepth())
        model.grown = grown
        return model

    def fitMultiple(self, dataset: DataFrame, paramMaps: Sequence) -> Iterator[tuple[int, RandomForestClassificationModel]]:
        depth_of = lambda setting: setting.get(self.maxDepth, self.getMaxDepth())
        rest = lambda setting: frozenset((p.name, v) for p, v in setting.items() if p != self.maxDepth)
        deepest: dict[frozenset, int] = {}
        for setting in paramMaps:
            deepest[rest(setting)] = max(depth_of(setting), deepest.get(rest(setting), 0))
        # The deepest of each group come first, so that different forests are fitted side by side.
        order = sorted(range(len(paramMaps)), key=lambda i: depth_of(paramMaps[i]) < deepest[rest(paramMaps[i])])
        return _Forests(self, dataset, list(paramMaps), order, rest, deepest, depth_of)


class _Forests:
    """Iterator over (place of the setting, model) that may be used by many threads."""

    def __init__(self, estimator, dataset, settings, order, rest, deepest, depth_of):
        self.estimator, self.dataset, self.settings = estimator, dataset, settings
        self.rest, self.deepest, self.depth_of = rest, deepest, depth_of
        self.left, self.lock = iter(order), Lock()
        self.locks = {group: Lock() for group in deepest}
        self.fitted: dict[frozenset, RandomForestClassificationModel] = {}
        self.cut: dict[frozenset, CutForests | Grown] = {}

    def __iter__(self):
        return self

    def __next__(self):
        with self.lock:
            i = next(self.left)
        setting = self.settings[i]
        group, depth = self.rest(setting), self.depth_of(setting)
        with self.locks[group]:
            if group not in self.fitted:
                whole = {**setting, self.estimator.maxDepth: self.deepest[group]}
                self.fitted[group] = self.estimator.fit(self.dataset, whole)
            if depth == self.deepest[group]:
                return i, self.fitted[group]
            if group not in self.cut:
                self.cut[group] = getattr(self.fitted[group], "grown", None) or CutForests(self.fitted[group])
        return i, self.cut[group].at(depth)
