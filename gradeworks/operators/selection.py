"""Feature selectors. A fitted selector keeps the key, the chosen columns and the label."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gradeworks.functions.order_stats import exact_quantiles
from gradeworks.operators.binned import Binned, Growing, bin_cuts, bin_rows, grow_jointly, grow_together, joint_cells, right_calls
from gradeworks.operators.learner import TableParams, class_sizes
from gradeworks.operators.models import CLASS, POINT, Tree, assembled, class_index
from gradeworks.operators.neighbors import nearest_to_anchors
from gradeworks.operators.persistence import Stateful
from gradeworks.operators.sampling import sample_rows, with_stratified_folds
from gradeworks.operators.scaling import fit_min_range, min_max
from gradeworks.session import broadcast_if_small, scratch, stage

FALLBACK = 10
JOINT_CELLS = 8_000_000  # cells of joint bins that one job counts


class Selection(Model, TableParams, Stateful):
    """Projection on the chosen columns."""

    def __init__(self, method: str, offered: Sequence[str], selected: Sequence[str], key: str, label: str,
                 threshold: float | None = None):
        super().__init__()
        self._set(keyCol=key, labelCol=label)
        self.method, self.offered, self.selected, self.threshold = method, list(offered), list(selected), threshold

    def _transform(self, df: DataFrame) -> DataFrame:
        ends = {c: c in df.columns for c in (self.key, self.label)}
        return df.select(
            *([self.key] if ends[self.key] else []),
            *[F.col(f"`{c}`") for c in self.selected],
            *([self.label] if ends[self.label] else []),
        )

    def _state(self) -> dict:
        names = ("method", "offered", "selected", "key", "label", "threshold")
        return {n: getattr(self, n) for n in names}

    @classmethod
    def _of_state(cls, state: dict, spark, path: str) -> Selection:
        return cls(**state)

    def info(self, spark) -> DataFrame:
        """One row: method, columns offered and kept, reduction in percent."""
        n_in, n_out = len(self.offered), len(self.selected)
        row = (self.method, n_in, n_out, round(100 * (1 - n_out / n_in), 1), self.threshold)
        return spark.createDataFrame(
            [row], "method string, n_in int, n_out int, reduction_pct double, threshold double"
        )


def scores_in_order(scores: DataFrame) -> list[tuple[str, float]]:
    """(feature, score) by column position; as many rows as the table has columns."""
    return [(r["feature"], r["score"]) for r in scores.orderBy("ordinal").collect()]


def best_in_column_order(scores: DataFrame, k: int) -> DataFrame:
    """The ``k`` best features, listed in column order; ties go to the later column."""
    best = scores.orderBy(F.col("score").desc(), F.col("ordinal").desc()).limit(k)
    return best.orderBy("ordinal")


def best_by_score(scores: DataFrame, k: int) -> DataFrame:
    """The ``k`` best features, best first; ties go to the later column."""
    return scores.orderBy(F.col("score").desc(), F.col("ordinal").desc()).limit(k)


def above_threshold(scores: DataFrame, threshold: float, fallback: int = FALLBACK) -> DataFrame:
    """Features above the threshold in column order; the ``fallback`` best when there are none."""
    everything = Window.partitionBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    place = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.col("score").desc(), "ordinal"))
    hits = F.count_if(F.col("score") > threshold).over(everything)
    return (
        scores.withColumns({"hits": hits, "place": place})
        .where((F.col("score") > threshold) | ((F.col("hits") == 0) & (F.col("place") <= fallback)))
        .orderBy(F.when(F.col("hits") > 0, F.col("ordinal")).otherwise(F.col("place")))
        .select("feature", "ordinal", "score")
    )


def mutual_information(df: DataFrame, features: Sequence[str], label: str, bins: int = 10) -> DataFrame:
    """``(feature, ordinal, score)`` in nats, for numeric features.

    Integer columns are used as they are; fractional ones are cut at their exact
    quantiles, equal values always sharing a bin. All features are counted in one
    scan, and only (feature, bin, class) counts are shuffled.
    """
    # cuts, class sizes and counts each read the needed columns, so they are stored
    df = stage(df.select(label, *[F.col(f"`{c}`") for c in features]), "scored")
    types = {f.name: f.dataType for f in df.schema.fields}
    fractional = [c for c in features if isinstance(types[c], (T.DoubleType, T.FloatType))]
    cuts = exact_quantiles(df, fractional, [i / bins for i in range(1, bins)])

    def cut_list(c: str) -> Column:
        if c not in fractional:
            return F.lit(None).cast("array<double>")
        return F.array(*[F.lit(x) for x in sorted(set(cuts.get((None, c), [])))]).cast("array<double>")

    own_cuts = F.get(F.array(*[cut_list(c) for c in features]), F.col("ordinal"))
    passed = F.size(F.filter(own_cuts, lambda cut: cut < F.col("value"))).cast("double")
    classes = list(class_sizes(df, label))
    per_bin = (
        df.where(F.col(label).isNotNull())
        .select(
            F.col(label).alias("class"),
            F.posexplode(F.array(*[F.col(f"`{c}`").cast("double") for c in features])).alias("ordinal", "value"),
        )
        .where(F.col("value").isNotNull())
        .groupBy("ordinal", F.when(own_cuts.isNull(), F.col("value")).otherwise(passed).alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"), *[F.count_if(F.col("class") == c).alias(f"n{i}") for i, c in enumerate(classes)])
    )

    def weighted_log(count: Column) -> Column:
        return F.when(count > 0, count * F.log(count)).otherwise(0.0)

    # the sum over cells of n log(n N / (bin class)), split so that no feature is gathered in one place
    cells = sum((F.sum(weighted_log(F.col(f"n{i}"))) for i in range(len(classes))), F.lit(0.0))
    of_class = sum((weighted_log(F.sum(f"n{i}")) for i in range(len(classes))), F.lit(0.0))
    total = F.sum("n")
    score = (cells - F.sum(weighted_log(F.col("n"))) - of_class + weighted_log(total)) / total
    names = F.array(*[F.lit(c) for c in features])
    return (
        per_bin.groupBy("ordinal")
        .agg(score.alias("score"))
        .select(F.get(names, F.col("ordinal")).alias("feature"), "ordinal", "score")
    )


def relief_scores(
    df: DataFrame, features: Sequence[str], key: str, label: str, n_neighbors: int = 10, n_samples: int = 500, seed: int = 42
) -> DataFrame:
    """``(feature, ordinal, score)``: distance to near misses less distance to near hits.

    Features are scaled to their range. Each of the sampled anchors takes its nearest
    rows of every class; misses weigh by the share of their class. A class smaller
    than ``n_neighbors`` contributes the rows it has.
    """
    rows = df.where(F.col(label).isNotNull())
    ranges = fit_min_range(rows, features)
    # a feature without values has no range and no distance
    point = F.array(*[min_max(c, *ranges.get(c, (0.0, 1.0))) for c in features])
    sizes = class_sizes(rows, label)
    total = sum(sizes.values())
    anchors = [
        (r["id"], r["y"], r["v"])
        for r in sample_rows(rows.select(key, label, *[F.col(f"`{c}`") for c in features]), key, n_samples, seed)
        .select(F.col(key).alias("id"), F.col(label).alias("y"), point.alias("v"))
        .collect()
    ]
    found = nearest_to_anchors(
        rows, features, key, label, [(a, v) for a, _, v in anchors], n_neighbors, "manhattan", point
    )

    spark = df.sparkSession
    parts = n_neighbors * len(anchors)
    coefficients = [
        (y, c, -1.0 / parts if c == y else sizes[c] / total / (1 - sizes[y] / total) / parts)
        for y in sizes
        for c in sizes
    ]
    key_type, class_type = (rows.schema[c].dataType.simpleString() for c in (key, label))
    weights = spark.createDataFrame(coefficients, f"y {class_type}, label {class_type}, weight double")
    anchor_rows = spark.createDataFrame(anchors, f"anchor {key_type}, y {class_type}, anchor_v array<double>")
    picked = (
        found.join(F.broadcast(anchor_rows), "anchor")
        .join(F.broadcast(weights), ["y", "label"])
        .select("neighbor", "anchor_v", "weight")
    )
    # at most anchors x classes x n_neighbors rows, whatever the size of the table
    picked = broadcast_if_small(picked, parts * len(sizes), 8 * len(features) + 24)
    gaps = rows.select(F.col(key).alias("neighbor"), point.alias("v")).join(picked, "neighbor")
    per_feature = gaps.select(
        "weight", F.posexplode(F.zip_with("v", "anchor_v", lambda a, b: F.abs(a - b))).alias("ordinal", "gap")
    )
    names = F.array(*[F.lit(c) for c in features])
    return (
        per_feature.groupBy("ordinal")
        .agg(F.sum(F.col("weight") * F.col("gap")).alias("score"))
        .select(F.get(names, F.col("ordinal")).alias("feature"), "ordinal", "score")
    )


class AllFeatures(Estimator, TableParams):
    @keyword_only
    def __init__(self, *, keyCol="key", labelCol="label", seed=42):
        super().__init__()
        self._set(**self._input_kwargs)
        self._setDefault(keyCol="key", labelCol="label", seed=42)

    def _fit(self, df: DataFrame) -> Selection:
        offered = self.features_of(df)
        return Selection("AllFeatures", offered, offered, self.key, self.label)


class MutualInfo(Estimator, TableParams):
    """The k features with the best scores, by mutual information or the caller's own function.

    ``scores`` is called with the table, the offered features and the label column and returns
    ``(feature, score)``, one row per feature.
    """

    k = Param(Params._dummy(), "k", "features kept", TypeConverters.toInt)
    scores = Param(Params._dummy(), "scores", "function that scores features", TypeConverters.identity)

    @keyword_only
    def __init__(self, *, keyCol="key", labelCol="label", k=30, scores=mutual_information, seed=42):
        super().__init__()
        self._set(**self._input_kwargs)
        self._setDefault(keyCol="key", labelCol="label", k=30, scores=mutual_information, seed=42)

    def _fit(self, df: DataFrame) -> Selection:
        offered = self.features_of(df)
        scores = self.getOrDefault(self.scores)(df, offered, self.label)
        if "ordinal" not in scores.columns:
            names = F.array(*[F.lit(c) for c in offered])
            scores = scores.withColumn("ordinal", (F.array_position(names, F.col("feature")) - 1).cast("int"))
        kept = best_in_column_order(scores, min(self.getOrDefault(self.k), len(offered)))
        return Selection("MutualInfo", offered, [r["feature"] for r in kept.collect()], self.key, self.label)


class Relief(Estimator, TableParams):
    k = Param(Params._dummy(), "k", "features kept", TypeConverters.toInt)
    n_neighbors = Param(Params._dummy(), "n_neighbors", "neighbours per class", TypeConverters.toInt)
    n_samples = Param(Params._dummy(), "n_samples", "anchor rows", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, keyCol="key", labelCol="label", k=30, n_neighbors=10, n_samples=500, seed=42):
        super().__init__()
        self._set(**self._input_kwargs)
        self._setDefault(keyCol="key", labelCol="label", k=30, n_neighbors=10, n_samples=500, seed=42)

    def _fit(self, df: DataFrame) -> Selection:
        offered = self.features_of(df)
        scores = relief_scores(
            df, offered, self.key, self.label, self.getOrDefault(self.n_neighbors), self.getOrDefault(self.n_samples),
            self.getOrDefault(self.seed),
        )
        kept = best_by_score(scores, min(self.getOrDefault(self.k), len(offered)))
        return Selection("ReliefF", offered, [r["feature"] for r in kept.collect()], self.key, self.label)


def _leading(held: np.ndarray) -> int:
    """How many places from the start on hold."""
    return len(held) if held.all() else int(held.argmin())


class Forward(Estimator, TableParams):
    """Adds the feature that most raises the cross-validated micro F1 of a shallow tree.

    Features are cut into bins once. All candidates and folds of a step are grown and tested from
    one count of their joint bins while these are few; then together, a job per level, and tested
    together in one more, so the jobs do not grow with either. Once a step calls every row right,
    the steps that can only take the first columns offered are tested at once.
    """

    k = Param(Params._dummy(), "k", "features kept", TypeConverters.toInt)
    cv = Param(Params._dummy(), "cv", "folds", TypeConverters.toInt)
    max_depth_dt = Param(Params._dummy(), "max_depth_dt", "depth of the scoring tree", TypeConverters.toInt)
    max_bins = Param(Params._dummy(), "max_bins", "bins per feature, at most 256", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, keyCol="key", labelCol="label", k=20, cv=3, max_depth_dt=8, max_bins=32, seed=42):
        super().__init__()
        self._set(**self._input_kwargs)
        self._setDefault(keyCol="key", labelCol="label", k=20, cv=3, max_depth_dt=8, max_bins=32, seed=42)

    def _fit(self, df: DataFrame) -> Selection:
        offered, cv, bins = self.features_of(df), self.getOrDefault(self.cv), self.getOrDefault(self.max_bins)
        k = min(self.getOrDefault(self.k), len(offered))
        rows = df.where(F.col(self.label).isNotNull())
        folded = with_stratified_folds(rows, self.key, self.label, cv, self.getOrDefault(self.seed), "_fold")
        classes = list(class_sizes(rows, self.label))
        chosen: list[int] = []
        with scratch(df.sparkSession):
            points = assembled(folded, offered).select(POINT, class_index(classes, self.label), "_fold")
            binned = bin_rows(points, POINT, CLASS, bin_cuts(rows, offered, bins), len(classes), bins, "_fold")
            depth, best = self.getOrDefault(self.max_depth_dt), 0.0
            while len(chosen) < k:
                rest = [i for i in range(len(offered)) if i not in chosen]
                if best == 1.0:
                    # no score is above 1, so the first column offered is taken if it keeps the score there
                    chain = [sorted([*chosen, *rest[:n]]) for n in range(1, k - len(chosen) + 1)]
                    kept = _leading(self._scores(binned, chain, cv, depth) == 1.0)
                    chosen += rest[:kept]
                    rest = rest[kept:]
                    if len(chosen) == k:
                        break
                scores = self._scores(binned, [sorted([*chosen, i]) for i in rest], cv, depth)
                best = float(scores.max())
                chosen.append(rest[int(scores.argmax())])
        return Selection("SFS", offered, [offered[i] for i in sorted(chosen)], self.key, self.label)

    @staticmethod
    def _scores(binned: Binned, sets: list[list[int]], cv: int, depth: int) -> np.ndarray:
        """Cross-validated micro F1, which is the share of right calls, of each set of columns; folds count alike."""
        if joint_cells(binned, sets, cv) <= JOINT_CELLS:
            shares = grow_jointly(binned, sets, cv, depth)
        else:
            trees = [Growing(own, fold) for own in sets for fold in range(cv)]
            grow_together(binned, trees, depth)
            shares = right_calls(binned, trees).reshape(len(sets), cv)
        return np.round(shares.mean(axis=1), 12)


class TreeImportance(Estimator, TableParams):
    """Keeps features whose importance in one tree exceeds the mean, the median or a number."""

    threshold = Param(Params._dummy(), "threshold", "'mean', 'median' or a number", TypeConverters.identity)
    max_depth = Param(Params._dummy(), "max_depth", "depth of the tree", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, keyCol="key", labelCol="label", threshold="mean", max_depth=12, seed=42):
        super().__init__()
        self._set(**self._input_kwargs)
        self._setDefault(keyCol="key", labelCol="label", threshold="mean", max_depth=12, seed=42)

    def _fit(self, df: DataFrame) -> Selection:
        wanted = self.getOrDefault(self.threshold)
        if isinstance(wanted, bool) or (wanted not in ("mean", "median") and not isinstance(wanted, (int, float))):
            raise ValueError(f"threshold must be 'mean', 'median' or a number, not {wanted!r}")
        offered = self.features_of(df)
        tree = Tree(
            keyCol=self.key, labelCol=self.label, max_depth=self.getOrDefault(self.max_depth),
            seed=self.getOrDefault(self.seed),
        ).fit(df)
        weights = tree.importances()
        if wanted == "mean":
            limit = sum(weights.values()) / len(weights)
        elif wanted == "median":
            ordered = sorted(weights.values())
            limit = (ordered[(len(ordered) - 1) // 2] + ordered[len(ordered) // 2]) / 2
        else:
            limit = float(wanted)
        scores = df.sparkSession.createDataFrame(
            [(c, i, weights[c]) for i, c in enumerate(offered)], "feature string, ordinal int, score double"
        )
        kept = [r["feature"] for r in above_threshold(scores, limit).collect()]
        return Selection("EmbeddedDT", offered, kept, self.key, self.label, round(limit, 6))


SELECTORS = {
    "all": AllFeatures,
    "mutual_info": MutualInfo,
    "relief": Relief,
    "sfs": Forward,
    "embedded_dt": TreeImportance,
}


def build_selector(name: str, **settings) -> Estimator:
    wanted = name.lower().strip()
    if wanted not in SELECTORS:
        raise ValueError(f"unknown selector {name!r}, known are {list(SELECTORS)}")
    return SELECTORS[wanted](**settings)
