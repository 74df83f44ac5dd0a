"""Classifiers: forest, single tree, boosted trees and nearest neighbours.

Each ``transform`` adds ``prediction`` (a class of the label column) and
``probability`` (an array in class order).
"""

from __future__ import annotations

import math

import numpy as np
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReader
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gradeworks.operators.binned import (
    MAX_BINS,
    SLIGHT,
    Binned,
    GrownTree,
    bin_cuts,
    bin_rows,
    grow,
    store_weights,
    tree_rows,
    trees_of,
    votes_of,
)
from gradeworks.operators.forest import Growth, GrownForest, grow_forest, shares_of
from gradeworks.operators.grouped import GroupedRows
from gradeworks.operators.learner import TableParams, class_sizes
from gradeworks.operators.neighbors import knn_join, knn_votes
from gradeworks.operators.persistence import Stateful
from gradeworks.session import scratch, stage

DEEPEST = 30  # deepest tree that is grown; stands for "no limit"
GROUPED_DEPTH = 3  # deepest boosted trees whose cuts tell few groups apart
POINT, CLASS, MARK = "_point", "_class", "_mark"
# A small table often sits in one file, and one task would grow all trees from it.
SPREAD_PARTS, SPREAD_ROWS = 4096, 8192


def _param(name: str, doc: str, converter) -> Param:
    return Param(Params._dummy(), name, doc, converter)


def class_value(classes: list[int], index: Column) -> Column:
    return F.get(F.array(*[F.lit(c) for c in classes]), index.cast("int"))


def class_index(classes: list[int], label: str) -> Column:
    """Position of the class as the column trees are trained on.

    The number of classes goes along as metadata, which spares every fit a scan for it.
    """
    index = (F.array_position(F.array(*[F.lit(c) for c in classes]), F.col(label)) - 1).cast("double")
    return index.alias(CLASS, metadata={"ml_attr": {"type": "nominal", "name": CLASS, "num_vals": len(classes)}})


def assembled(df: DataFrame, features: list[str]) -> DataFrame:
    return VectorAssembler(inputCols=features, outputCol=POINT, handleInvalid="error").transform(df)


def balanced_weights(sizes: dict[int, int]) -> dict[int, float]:
    """Weight of each class's rows so that every class weighs the same in total."""
    total = sum(sizes.values())
    return {c: total / (len(sizes) * n) for c, n in sizes.items()}


def balanced_weight(sizes: dict[int, int], label: str) -> Column:
    """Weight of a row so that every class weighs the same in total."""
    weight = F.lit(1.0)
    for c, w in balanced_weights(sizes).items():
        weight = F.when(F.col(label) == c, F.lit(w)).otherwise(weight)
    return weight


class _Fitted(Model, TableParams, Stateful):
    """Common part of the fitted classifiers."""

    def __init__(self, key: str = "key", label: str = "label", features=(), classes=()):
        super().__init__()
        self._set(keyCol=key, labelCol=label)
        self.features = list(features)
        self.classes = list(classes)

    def _state(self) -> dict:
        return {"key": self.key, "label": self.label, "features": self.features, "classes": [int(c) for c in self.classes]}

    def save_to(self, path: str) -> None:
        """Save, over what is there."""
        self.write().overwrite().save(path)


class TreeModel(_Fitted):
    """A tree or a forest applied to named feature columns."""

    def __init__(self, inner: GrownForest, **common):
        super().__init__(**common)
        self.inner = inner

    def _transform(self, df: DataFrame) -> DataFrame:
        out = assembled(df, self.features).withColumn("probability", shares_of(self.inner)(vector_to_array(POINT)))
        best = F.array_position(F.col("probability"), F.array_max("probability")) - 1
        return out.withColumn("prediction", class_value(self.classes, best)).drop(POINT)

    def importances(self) -> dict[str, float]:
        return {f: float(w) for f, w in zip(self.features, self.inner.importances(), strict=True)}

    def _save_tables(self, spark: SparkSession, path: str) -> None:
        nodes, cuts = self.inner.tables()
        spark.createDataFrame(nodes).write.mode("overwrite").parquet(f"{path}/nodes")
        spark.createDataFrame(cuts).coalesce(1).write.mode("overwrite").parquet(f"{path}/cuts")

    @classmethod
    def _of_state(cls, state: dict, spark: SparkSession, path: str) -> TreeModel:
        nodes, cuts = (spark.read.parquet(f"{path}/{n}").toArrow() for n in ("nodes", "cuts"))
        return cls(GrownForest.of_tables(nodes, cuts, len(state["features"])), **_common(state))


def _common(state: dict) -> dict:
    return {n: state[n] for n in ("key", "label", "features", "classes")}


class _TreeParams(TableParams):
    max_depth = _param("max_depth", "depth limit, null for none", TypeConverters.identity)
    min_samples_leaf = _param("min_samples_leaf", "least rows in a leaf", TypeConverters.toInt)
    class_weight = _param("class_weight", "null or 'balanced'", TypeConverters.identity)

    def _grown(self, df: DataFrame, n_trees: int, forest: bool) -> TreeModel:
        depth, wanted = self.getOrDefault(self.max_depth), self.getOrDefault(self.class_weight)
        if depth is not None and depth > DEEPEST:
            raise ValueError(f"max_depth {depth} is above {DEEPEST}, the deepest tree that can be grown")
        if wanted not in (None, "balanced"):
            raise ValueError("class_weight must be None or 'balanced'")
        features, sizes = self.features_of(df), class_sizes(df, self.label)
        classes, n_rows = list(sizes), sum(sizes.values())
        weights = list(balanced_weights(sizes).values()) if wanted else [1.0] * len(sizes)
        offered = math.ceil(math.sqrt(len(features))) if forest else len(features)
        growth = Growth(
            offered, DEEPEST if depth is None else depth, self.getOrDefault(self.min_samples_leaf), np.array(weights), forest,
            self.getOrDefault(self.seed),
        )
        known = df.where(F.col(self.label).isNotNull())
        with scratch(df.sparkSession):
            rows = assembled(known, features).select(POINT, class_index(classes, self.label), F.xxhash64(self.key).alias(MARK))
            dealt = rows.repartition(max(1, min(SPREAD_PARTS, -(-n_rows // SPREAD_ROWS))))
            binned = bin_rows(dealt, POINT, CLASS, bin_cuts(known, features), len(classes), mark=MARK)
            inner = grow_forest(binned, n_rows, n_trees, growth)
        return TreeModel(inner, key=self.key, label=self.label, features=features, classes=classes)


class Forest(Estimator, _TreeParams):
    n_estimators = _param("n_estimators", "number of trees", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, keyCol="key", labelCol="label", n_estimators=300, max_depth=None, min_samples_leaf=1,
                 class_weight=None, seed=42):
        super().__init__()
        self._set(**self._input_kwargs)
        self._setDefault(keyCol="key", labelCol="label", n_estimators=300, max_depth=None, min_samples_leaf=1,
                         class_weight=None, seed=42)

    def _fit(self, df: DataFrame) -> TreeModel:
        return self._grown(df, self.getOrDefault(self.n_estimators), True)


class Tree(Estimator, _TreeParams):
    @keyword_only
    def __init__(self, *, keyCol="key", labelCol="label", max_depth=None, min_samples_leaf=1, class_weight=None, seed=42):
        super().__init__()
        self._set(**self._input_kwargs)
        self._setDefault(keyCol="key", labelCol="label", max_depth=None, min_samples_leaf=1, class_weight=None, seed=42)

    def _fit(self, df: DataFrame) -> TreeModel:
        return self._grown(df, 1, False)


class BoostedModel(_Fitted):
    """Weighted vote of trees, all evaluated in one step over Arrow batches."""

    def __init__(self, trees, votes, **common):
        super().__init__(**common)
        self.trees = list(trees)
        self.votes = list(votes)

    def _transform(self, df: DataFrame) -> DataFrame:
        shares = votes_of(self.trees, self.votes, len(self.classes))
        out = assembled(df, self.features).withColumn("probability", shares(vector_to_array(POINT)))
        best = F.array_position(F.col("probability"), F.array_max("probability")) - 1
        return out.withColumn("prediction", class_value(self.classes, best)).drop(POINT)

    def _state(self) -> dict:
        return super()._state() | {"votes": self.votes}

    def _save_tables(self, spark: SparkSession, path: str) -> None:
        spark.createDataFrame(tree_rows(self.trees)).coalesce(1).write.mode("overwrite").parquet(f"{path}/trees")

    @classmethod
    def _of_state(cls, state: dict, spark: SparkSession, path: str) -> BoostedModel:
        return cls(trees_of(spark.read.parquet(f"{path}/trees").toPandas()), state["votes"], **_common(state))


class BoostedTrees(Estimator, TableParams):
    """Multi-class boosting of shallow trees (Zhu et al., "Multi-class AdaBoost", 2009).

    Features are cut into at most ``max_bins`` bins once. Rounds of trees up to ``GROUPED_DEPTH``
    are worked out from groups of rows that no cut used so far tells apart; only a round with a
    new cut scans the rows. For deeper trees a round is one aggregation per level, over the stored
    weights times what the rounds since then did to them; every ``checkpoint_every`` rounds the
    weights are stored anew, so a round's time does not grow.
    """

    n_estimators = _param("n_estimators", "most rounds", TypeConverters.toInt)
    learning_rate = _param("learning_rate", "shrinks every vote", TypeConverters.toFloat)
    base_estimator_max_depth = _param("base_estimator_max_depth", "depth of each tree", TypeConverters.toInt)
    checkpoint_every = _param("checkpoint_every", "rounds between stored weights", TypeConverters.toInt)
    max_bins = _param("max_bins", "bins per feature, at most 256", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, keyCol="key", labelCol="label", n_estimators=300, learning_rate=1.0,
                 base_estimator_max_depth=1, checkpoint_every=10, max_bins=MAX_BINS, seed=42):
        super().__init__()
        self._set(**self._input_kwargs)
        self._setDefault(keyCol="key", labelCol="label", n_estimators=300, learning_rate=1.0,
                         base_estimator_max_depth=1, checkpoint_every=10, max_bins=MAX_BINS, seed=42)

    def _fit(self, df: DataFrame) -> BoostedModel:
        features, sizes = self.features_of(df), class_sizes(df, self.label)
        classes, bins = list(sizes), self.getOrDefault(self.max_bins)
        known = df.where(F.col(self.label).isNotNull())
        with scratch(df.sparkSession):
            rows = assembled(known, features).select(POINT, class_index(classes, self.label))
            binned = bin_rows(rows, POINT, CLASS, bin_cuts(known, features, bins), len(classes), bins)
            trees, votes = self._boost(binned, len(classes))
        return BoostedModel(trees, votes, key=self.key, label=self.label, features=features, classes=classes)

    def _boost(self, binned: Binned, k: int) -> tuple[list[GrownTree], list[float]]:
        rate, every = self.getOrDefault(self.learning_rate), self.getOrDefault(self.checkpoint_every)
        trees: list[GrownTree] = []
        votes: list[float] = []
        since: list[tuple[GrownTree, float]] = []  # trees whose factors the stored weights lack
        depth = self.getOrDefault(self.base_estimator_max_depth)
        grouped = GroupedRows(binned) if depth <= GROUPED_DEPTH else None
        for _ in range(self.getOrDefault(self.n_estimators)):
            tree, missed, total = grouped.grow(depth) if grouped else grow(binned, depth, since)
            error = missed / total
            if error <= SLIGHT:
                trees.append(tree)
                votes.append(1.0)
                break
            if error >= 1 - 1 / k:
                if not trees:
                    raise ValueError("the first tree is no better than chance")
                break
            vote = rate * (math.log((1 - error) / error) + math.log(k - 1))
            trees.append(tree)
            votes.append(vote)
            if grouped:
                grouped.boost(tree, math.exp(vote))
                continue
            since.append((tree, math.exp(vote)))
            if len(since) == every:
                binned, since = store_weights(binned, since, total - missed + missed * math.exp(vote)), []
        return trees, votes


class NeighborsModel(_Fitted):
    def __init__(self, train: DataFrame, n_neighbors: int, weights: str, metric: str, **common):
        super().__init__(**common)
        self.train, self.n_neighbors, self.weights, self.metric = train, n_neighbors, weights, metric

    def _transform(self, df: DataFrame) -> DataFrame:
        incomplete = F.greatest(*[F.col(f"`{c}`").isNull().cast("int") for c in self.features], F.lit(0), F.lit(0))
        if not df.where(incomplete == 1).isEmpty():
            raise ValueError(f"rows without a value in one of {self.features} have no neighbours; fill them first")
        found = knn_join(df, self.train, self.features, self.key, self.n_neighbors, self.metric, self.label)
        votes = knn_votes(found, self.classes, self.weights).withColumnRenamed("query", self.key)
        return df.join(votes, self.key, "inner")

    def _state(self) -> dict:
        return super()._state() | {"n_neighbors": self.n_neighbors, "weights": self.weights, "metric": self.metric}

    def _save_tables(self, spark: SparkSession, path: str) -> None:
        self.train.write.mode("overwrite").parquet(f"{path}/train")

    @classmethod
    def _of_state(cls, state: dict, spark: SparkSession, path: str) -> NeighborsModel:
        train = spark.read.parquet(f"{path}/train")
        return cls(train, state["n_neighbors"], state["weights"], state["metric"], **_common(state))


class Neighbors(Estimator, TableParams):
    n_neighbors = _param("n_neighbors", "neighbours that vote", TypeConverters.toInt)
    weights = _param("weights", "'uniform' or 'distance'", TypeConverters.toString)
    metric = _param("metric", "'euclidean' or 'manhattan'", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, keyCol="key", labelCol="label", n_neighbors=7, weights="distance", metric="euclidean", seed=42):
        super().__init__()
        self._set(**self._input_kwargs)
        self._setDefault(keyCol="key", labelCol="label", n_neighbors=7, weights="distance", metric="euclidean", seed=42)

    def _fit(self, df: DataFrame) -> NeighborsModel:
        features = self.features_of(df)
        rows = df.where(F.col(self.label).isNotNull()).select(self.key, *features, self.label)
        # written once, since every prediction reads the training rows again
        train = stage(rows, "knn-model")
        return NeighborsModel(
            train, self.getOrDefault(self.n_neighbors), self.getOrDefault(self.weights), self.getOrDefault(self.metric),
            key=self.key, label=self.label, features=features, classes=list(class_sizes(train, self.label)),
        )


MODELS = {"rf": Forest, "knn": Neighbors, "ada": BoostedTrees}


def build_model(name: str, **settings) -> Estimator:
    """``rf``, ``knn`` or ``ada`` with its settings by keyword."""
    if name not in MODELS:
        raise ValueError(f"unknown model {name!r}, known are {sorted(MODELS)}")
    return MODELS[name](**settings)


def load_model(spark: SparkSession, path: str) -> _Fitted:
    """A saved classifier of any kind; its metadata name the kind."""
    return DefaultParamsReader.loadParamsInstance(path, spark)
