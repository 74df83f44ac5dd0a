from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gradeworks.operators import clustering, models, neighbors, selection
from gradeworks.operators.evaluation import micro_f1
from gradeworks.operators.scaling import fit_min_range
from gradeworks.operators.search import (
    MODEL_SETTINGS,
    SelectionSearch,
    Trial,
    compare_selectors,
    draw_trials,
    search_space,
)

FEATURES = [f"f{i}" for i in range(6)]


@pytest.fixture(scope="module")
def points(spark):
    """Three classes told apart by two of six columns; one column constant, one whole."""
    rng = np.random.default_rng(2)
    y = rng.choice([1, 2, 3], 240, p=[0.15, 0.5, 0.35])
    x = rng.normal(size=(240, 6))
    x[:, 1] += 2.5 * y
    x[:, 4] -= 2.0 * (y == 3)
    x[:, 3] = 1.0
    x[:, 5] = rng.integers(0, 3, 240)
    rows = [(i, *map(float, v[:5]), int(v[5]), int(c)) for i, (v, c) in enumerate(zip(x, y))]
    schema = "id int, " + ", ".join(f"f{i} double" for i in range(5)) + ", f5 int, y int"
    df = spark.createDataFrame(rows, schema).cache()
    return df, x, y


ENDS = {"keyCol": "id", "labelCol": "y"}


@pytest.mark.parametrize("metric", ["euclidean", "manhattan"])
@pytest.mark.parametrize("shape", [{}, {"block_rows": 13}, {"block_rows": 10, "cell_rows": 25}, {"cell_rows": 9, "max_cells": 12}])
def test_neighbours_match_brute_force(points, metric, shape):
    df, x, _ = points
    queries, train = df.where("id % 4 = 0"), df.where("id % 4 <> 0")
    found = neighbors.knn_join(queries, train, FEATURES, "id", 5, metric, "y", **shape).collect()
    got = {}
    for r in sorted(found, key=lambda r: (r["query"], r["rank"])):
        got.setdefault(r["query"], []).append(r["neighbor"])
    t = np.array([i for i in range(240) if i % 4])
    for q in range(0, 240, 4):
        gap = x[t] - x[q]
        dist = np.abs(gap).sum(1) if metric == "manhattan" else np.sqrt((gap**2).sum(1))
        assert got[q] == [int(i) for i in t[np.lexsort((t, np.round(dist, 9)))][:5]]


def test_neighbours_in_a_crowded_place(spark):
    """A third of the rows share one point, so one cell is crowded and full of ties."""
    rng = np.random.default_rng(4)
    x = rng.normal(size=(150, 2))
    x[:50] = 0.5
    df = spark.createDataFrame([(i, *map(float, v)) for i, v in enumerate(x)], "id int, a double, b double")
    found = neighbors.knn_join(df, df, ["a", "b"], "id", 3, block_rows=8, cell_rows=20)
    rows = {(r["query"], r["rank"]): r for r in found.collect()}
    assert len(rows) == 450
    assert [rows[40, k]["neighbor"] for k in (1, 2, 3)] == [0, 1, 2] and rows[40, 3]["distance"] == 0.0


def test_fewer_training_rows_than_neighbours(points):
    df = points[0]
    found = neighbors.knn_join(df.where("id < 3"), df.where("id between 10 and 13"), FEATURES, "id", 9)
    assert found.count() == 12


def test_votes(spark):
    near = spark.createDataFrame(
        [(1, 3, 2.0), (1, 2, 1.0), (1, 3, 4.0), (2, 3, 0.0), (2, 1, 1.0), (2, 1, 1.0), (3, 2, 1.0), (3, 1, 1.0)],
        "query int, label int, distance double",
    )
    uniform = {r["query"]: r for r in neighbors.knn_votes(near, [1, 2, 3]).collect()}
    weighted = {r["query"]: r for r in neighbors.knn_votes(near, [1, 2, 3], "distance").collect()}
    assert [uniform[q]["prediction"] for q in (1, 2, 3)] == [3, 1, 1]
    assert [weighted[q]["prediction"] for q in (1, 2, 3)] == [2, 3, 1]
    assert weighted[1]["probability"] == pytest.approx([0, 1 / 1.75, 0.75 / 1.75]) and weighted[2]["probability"] == [0, 0, 1]
    with pytest.raises(ValueError):
        neighbors.knn_votes(near, [1], "other")


def brute_relief(x, y, ids, anchors, k):
    low, spread = x.min(0), x.max(0) - x.min(0)
    x = (x - low) / np.where(spread == 0, 1, spread)
    classes, counts = np.unique(y, return_counts=True)
    share = dict(zip(classes, counts / len(y)))
    weights = np.zeros(x.shape[1])
    for a in anchors:
        gap = np.abs(x - x[a])
        dist = np.round(gap.sum(1), 9)
        for c in classes:
            member = np.flatnonzero((y == c) & (ids != a))
            near = member[np.lexsort((member, dist[member]))][:k]
            factor = -1.0 if c == y[a] else share[c] / (1 - share[y[a]])
            weights += factor * gap[near].sum(0) / (k * len(anchors))
    return weights


@pytest.mark.parametrize("k", [4, 60])
def test_relief_matches_its_definition(points, k):
    """With k = 60 the rarest class has fewer rows than neighbours wanted."""
    df, x, y = points
    from gradeworks.operators.sampling import sample_rows

    anchors = [r["id"] for r in sample_rows(df, "id", 30).collect()]
    scores = selection.scores_in_order(selection.relief_scores(df.repartition(5), FEATURES, "id", "y", k, 30))
    assert [f for f, _ in scores] == FEATURES
    assert np.allclose([s for _, s in scores], brute_relief(x, y, np.arange(240), anchors, k), atol=1e-9)


def test_mutual_information_of_whole_numbers_is_exact(points):
    df, x, y = points
    score = dict(selection.scores_in_order(selection.mutual_information(df, FEATURES, "y")))
    joint = np.array([[((x[:, 5] == a) & (y == c)).mean() for c in (1, 2, 3)] for a in (0, 1, 2)])
    want = (joint * np.log(joint / joint.sum(1, keepdims=True) / joint.sum(0, keepdims=True))).sum()
    assert score["f5"] == pytest.approx(want) and score["f3"] == pytest.approx(0.0, abs=1e-12)
    assert max(score, key=score.get) == "f1"


def test_ties_and_orders_of_best_features(spark):
    scores = spark.createDataFrame([("a", 0, 0.5), ("b", 1, 0.9), ("c", 2, 0.5), ("d", 3, 0.1)], "feature string, ordinal int, score double")
    names = lambda df: [r["feature"] for r in df.collect()]
    assert names(selection.best_in_column_order(scores, 2)) == ["b", "c"]
    assert names(selection.best_by_score(scores, 3)) == ["b", "c", "a"]
    assert names(selection.above_threshold(scores, 0.4)) == ["a", "b", "c"]
    assert names(selection.above_threshold(scores, 0.5)) == ["b"]
    assert names(selection.above_threshold(scores, 2.0, fallback=3)) == ["b", "a", "c"]


@pytest.mark.parametrize(
    ("name", "settings", "kept"),
    [
        ("all", {}, 6),
        (" Mutual_Info ", {"k": 3}, 3),
        ("relief", {"k": 2, "n_samples": 40}, 2),
        ("sfs", {"k": 1, "cv": 2, "max_depth_dt": 3}, 1),
        ("embedded_dt", {"threshold": "mean", "max_depth": 4}, None),
    ],
)
def test_selectors_keep_rows_key_and_label(spark, points, name, settings, kept):
    df = points[0]
    chosen = selection.build_selector(name, **ENDS, **settings).fit(df)
    out = chosen.transform(df)
    assert out.count() == df.count() and out.columns == ["id", *chosen.selected, "y"]
    assert kept is None or len(chosen.selected) == kept
    assert "f1" in chosen.selected
    info = chosen.info(spark).first()
    assert (info["n_in"], info["n_out"]) == (6, len(chosen.selected))
    assert info["reduction_pct"] == round(100 * (1 - len(chosen.selected) / 6), 1)
    assert chosen.transform(df.drop("y")).columns == ["id", *chosen.selected]


def test_unknown_names_raise(points):
    with pytest.raises(ValueError, match="selector"):
        selection.build_selector("pca")
    with pytest.raises(ValueError, match="model"):
        models.build_model("svm")
    with pytest.raises(ValueError, match="threshold"):
        selection.TreeImportance(**ENDS, threshold="most").fit(points[0])


@pytest.mark.parametrize(
    ("name", "settings", "least"),
    [
        ("rf", {"n_estimators": 8, "max_depth": 5, "class_weight": "balanced"}, 0.85),
        ("rf", {"n_estimators": 3, "min_samples_leaf": 5}, 0.85),
        ("knn", {"n_neighbors": 5, "weights": "uniform", "metric": "manhattan"}, 0.75),
        ("ada", {"n_estimators": 7, "base_estimator_max_depth": 2, "checkpoint_every": 2}, 0.85),
    ],
)
def test_models_learn_predict_and_reload(spark, points, tmp_path, name, settings, least):
    df = points[0]
    fitted = models.build_model(name, **ENDS, **settings).fit(df)
    out = fitted.transform(df)
    assert micro_f1(out, "y", "prediction") >= least
    rows = out.select("id", "prediction", "probability").collect()
    assert len(rows) == 240 and all(sum(r["probability"]) == pytest.approx(1) and len(r["probability"]) == 3 for r in rows)
    assert all(r["prediction"] == int(np.argmax(np.round(r["probability"], 12))) + 1 for r in rows)
    fitted.save_to(str(tmp_path / "m"))
    loaded = models.load_model(spark, str(tmp_path / "m"))
    again = {r["id"]: r["prediction"] for r in loaded.transform(df.drop("y")).collect()}
    assert again == {r["id"]: r["prediction"] for r in rows}


def test_balanced_weights_even_out_the_classes(points):
    df, _, y = points
    sizes = {1: int((y == 1).sum()), 2: int((y == 2).sum()), 3: int((y == 3).sum())}
    totals = df.groupBy("y").agg(F.sum(models.balanced_weight(sizes, "y")).alias("w")).collect()
    assert [r["w"] for r in totals] == pytest.approx([80.0] * 3)


def test_boosting_rounds_follow_the_formula(spark):
    """One column, two classes: the first vote is the log odds of the first tree."""
    rows = [(i, float(i), 1 if i < 10 else 2) for i in range(20)]
    rows[3], rows[15] = (3, 3.0, 2), (15, 15.0, 1)
    df = spark.createDataFrame(rows, "id int, x double, y int")
    fitted = models.BoostedTrees(**ENDS, n_estimators=3, learning_rate=0.5).fit(df)
    assert len(fitted.votes) == 3 and fitted.votes[0] == pytest.approx(0.5 * np.log(0.9 / 0.1))


def test_boosting_stops_at_a_perfect_tree(spark):
    df = spark.createDataFrame([(i, float(i), 1 if i < 10 else 2) for i in range(20)], "id int, x double, y int")
    fitted = models.BoostedTrees(**ENDS, n_estimators=9).fit(df)
    assert fitted.votes == [1.0] and micro_f1(fitted.transform(df), "y", "prediction") == 1.0


def test_clusters(points):
    df, x, _ = points
    found = clustering.fit_clusters(df, ["f1", "f4"], 3, restarts=2)
    placed = {r["id"]: r for r in found.assign(df).collect()}
    centers = np.array(found.centers)
    dist = np.sqrt(((x[:, None, [1, 4]] - centers[None]) ** 2).sum(2))
    assert [placed[i]["cluster"] for i in range(240)] == list(dist.argmin(1))
    assert clustering.inertia(found.assign(df)).first()["inertia"] == pytest.approx(found.cost)
    out = found.transform(df)
    assert out.columns == [*df.columns, "cluster_0", "cluster_1", "cluster_2"]
    assert out.where("cluster_0 + cluster_1 + cluster_2 <> 1").count() == 0


def test_elbow_costs_fall(points):
    costs = [r["inertia"] for r in clustering.elbow(points[0], ["f1", "f4"], "id", 4, sample_size=200).orderBy("k").collect()]
    assert len(costs) == 3 and costs[0] > costs[-1]


def test_cluster_columns_are_in_numeric_order(spark):
    df = spark.createDataFrame([(0, 11)], "id int, cluster int")
    assert clustering.cluster_dummies(df, 12).columns[1:] == [f"cluster_{i}" for i in range(12)]


def test_min_range_of_a_constant(points):
    assert fit_min_range(points[0], ["f3"]) == {"f3": (1.0, 1.0)}


def test_search_space():
    assert len(search_space()) == 15 and len(search_space(include_sfs=False)) == 12
    assert len([1 for _, m, _, _ in search_space(include_sfs=False) if m == "ada"]) == 4
    assert "leaf_size" not in MODEL_SETTINGS["knn"]
    trials = draw_trials(200, seed=1)
    assert trials == draw_trials(200, seed=1) and trials != draw_trials(200, seed=2)
    assert {(t.selector, t.model) for t in trials} == {(s, m) for s, m, _, _ in search_space()}
    for t in trials:
        params = json.loads(t.params())
        if t.model == "rf":
            low, high = (100, 300) if t.selector == "sfs" else (100, 400)
            assert low <= params["model__n_estimators"] < high
            assert ("model__min_samples_leaf" in params) == (t.selector != "sfs")


def test_search(points):
    df = points[0]
    train, rest = df.where("id < 180"), df.where("id >= 180")
    trials = [
        Trial("mutual_info", "rf", {"k": 2}, {"n_estimators": 4, "max_depth": 4}),
        Trial("all", "knn", {}, {"n_neighbors": 3}),
        Trial("all", "rf", {}, {"n_estimators": 3, "class_weight": "heavy"}),
    ]
    search = SelectionSearch(cv=2, trials=trials)
    for early in (search.results, search.best_trial, search.best_score, lambda: search.predict(df), lambda: search.transform(df)):
        with pytest.raises(RuntimeError):
            early()
    search.fit(train, "id", "y")
    results = search.results().collect()
    assert [r["rank"] for r in results] == [1, 2, 3]
    assert results[2]["config"] == 2 and results[2]["mean_cv_score"] is None
    assert search.best_score() == results[0]["mean_cv_score"] and search.best_trial() == trials[results[0]["config"]]
    predicted = search.predict(rest)
    assert predicted.count() == 60 and {"prediction", "probability"} <= set(predicted.columns)
    assert search.transform(rest).columns == ["id", *search.best_pipeline.stages[0].selected, "y"]


def test_search_fails_only_when_all_fail(points):
    broken = [Trial("all", "rf", {}, {"class_weight": "heavy"})]
    with pytest.raises(RuntimeError, match="every"):
        SelectionSearch(cv=2, trials=broken).fit(points[0], "id", "y")


def test_selector_comparison(points):
    df = points[0]
    config = {"all": {}, "mutual_info": {"k": 2}, "relief": {"k": 2, "n_samples": 30}, "sfs": {"k": 1, "cv": 2}, "embedded_dt": {}}
    done = compare_selectors(df.where("id < 170"), df.where("id >= 170"), config, "id", "y")
    rows = done.results.collect()
    assert [r["selector"] for r in rows] == list(config) and max(r["n_features"] for r in rows) == 6
    assert done.best_score == max(r["score"] for r in rows)
    assert done.transform(df).columns == ["id", *done.selection.selected, "y"]
    with pytest.raises(ValueError):
        compare_selectors(df, df, {"pca": {}}, "id", "y")


def test_boosting_recovers_what_needs_many_stumps(spark):
    """A vote of three columns, which no single stump can express."""
    rng = np.random.default_rng(8)
    x = rng.integers(0, 2, (3000, 8))
    x[:, 2] = rng.integers(1, 8, 3000)
    y = np.where(x[:, 2] + 2 * x[:, 0] + 3 * x[:, 1] >= 5, 2, 1)
    rows = [(i, *map(float, v), int(c)) for i, (v, c) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "id int, " + ", ".join(f"f{i} double" for i in range(8)) + ", y int")
    fitted = models.BoostedTrees(**ENDS, n_estimators=100).fit(df)
    assert len(fitted.trees) == 100 and micro_f1(fitted.transform(df), "y", "prediction") == 1.0
    few = models.BoostedModel(fitted.trees[:5], fitted.votes[:5], key="id", label="y", features=fitted.features, classes=fitted.classes)
    assert micro_f1(few.transform(df), "y", "prediction") < 1.0


@pytest.mark.parametrize("depth", [1, 2, 3])
def test_boosted_rounds_against_plain_ones(spark, points, depth):
    """Every round's tree, error and weights against the same rounds on whole columns."""
    df, x, y = points
    fitted = models.BoostedTrees(**ENDS, n_estimators=6, base_estimator_max_depth=depth, checkpoint_every=2, max_bins=256).fit(df)
    classes = np.unique(y)
    w = np.full(len(y), 1 / len(y))
    for tree, vote in zip(fitted.trees, fitted.votes):
        calls = classes[tree.calls(x.T, by_bin=False)]
        missed = w[calls != y].sum() / w.sum()
        best = min(_best_stump_impurity(x, y, w)) if depth == 1 else None
        if best is not None:
            at = x[:, tree.feature[0]] <= tree.threshold[0]
            assert _impurity(y, w, at) == pytest.approx(best, abs=1e-9)
        assert vote == pytest.approx(np.log((1 - missed) / missed) + np.log(len(classes) - 1))
        w = w * np.where(calls != y, np.exp(vote), 1.0)


def _impurity(y, w, left):
    out = 0.0
    for side in (left, ~left):
        total = w[side].sum()
        out += total - sum(w[side & (y == c)].sum() ** 2 for c in np.unique(y)) / total if total > 0 else 0.0
    return out


def _best_stump_impurity(x, y, w):
    for f in range(x.shape[1]):
        for v in np.unique(x[:, f])[:-1]:
            yield _impurity(y, w, x[:, f] <= v)


def test_forward_selection_against_plain_trees(points):
    """The scores of all candidates of a step against the same trees grown one by one."""
    from gradeworks.operators.binned import Growing, bin_cuts, bin_rows, grow_together, right_calls

    df, x, y = points
    folded = df.withColumn("_fold", F.col("id") % 3)
    rows = models.assembled(folded, FEATURES).select(models.POINT, models.class_index([1, 2, 3], "y"), "_fold")
    binned = bin_rows(rows, models.POINT, models.CLASS, bin_cuts(df, FEATURES, 256), 3, 256, "_fold")
    trees = [Growing(features, fold) for features in ([0], [1], [1, 4], [0, 1, 5]) for fold in range(3)]
    grow_together(binned, trees, 3)
    shares = right_calls(binned, trees)
    fold = np.arange(240) % 3

    def grown(rows, features, depth):
        counts = np.array([(y[rows] == c).sum() for c in (1, 2, 3)])
        call = int(counts.argmax())
        options = [
            (round(_impurity(y[rows], np.ones(len(rows)), x[rows, f] <= v), 9), f, v) for f in features for v in np.unique(x[rows, f])[:-1]
        ]
        if not depth or counts.max() == counts.sum() or not options or min(options)[0] >= len(rows) - (counts**2).sum() / len(rows) - 1e-9:
            return call
        _, f, v = min(options)
        return f, v, grown(rows[x[rows, f] <= v], features, depth - 1), grown(rows[x[rows, f] > v], features, depth - 1)

    def call(tree, row):
        while isinstance(tree, tuple):
            tree = tree[2] if x[row, tree[0]] <= tree[1] else tree[3]
        return tree + 1

    for g, share in zip(trees, shares, strict=True):
        plain = grown(np.flatnonzero(fold != g.fold), g.features, 3)
        own = np.flatnonzero(fold == g.fold)
        assert share == pytest.approx(np.mean([call(plain, r) == y[r] for r in own]), abs=0.02)


def test_pruning_computes_few_of_all_pairs(spark):
    rng = np.random.default_rng(6)
    centers = rng.normal(0, 100, (40, 4))
    x = centers[rng.integers(0, 40, 4000)] + rng.normal(0, 0.5, (4000, 4))
    df = spark.createDataFrame([(i, *map(float, v)) for i, v in enumerate(x)], "id int, a double, b double, c double, d double")
    compared = spark.sparkContext.accumulator(0)
    found = neighbors.knn_join(df, df, ["a", "b", "c", "d"], "id", 5, block_rows=64, cell_rows=64, compared=compared)
    rows = found.collect()
    assert len(rows) == 20_000 and 0 < compared.value < 0.15 * 4000 * 4000
    by_query = {}
    for r in rows:
        by_query.setdefault(r["query"], []).append((r["rank"], r["neighbor"]))
    for q in range(0, 4000, 97):
        dist = np.round(np.sqrt(((x - x[q]) ** 2).sum(1)), 9)
        assert [n for _, n in sorted(by_query[q])] == np.lexsort((np.arange(4000), dist))[:5].tolist()


def _neighbours_and_pairs(spark, x, k, metric):
    names = [f"c{i}" for i in range(x.shape[1])]
    df = spark.createDataFrame([(i, *map(float, v)) for i, v in enumerate(x)], ["id", *names])
    compared = spark.sparkContext.accumulator(0)
    found = {}
    for r in sorted(neighbors.knn_join(df, df, names, "id", k, metric, compared=compared).collect(), key=lambda r: (r["query"], r["rank"])):
        found.setdefault(r["query"], []).append(r["neighbor"])
    assert sorted(found) == list(range(len(x)))
    for q in range(0, len(x), 97):
        gap = x - x[q]
        dist = np.round(np.abs(gap).sum(1) if metric == "manhattan" else np.sqrt((gap**2).sum(1)), 9)
        assert found[q] == np.lexsort((np.arange(len(x)), dist))[:k].tolist()
    return compared.value / len(x) ** 2


@pytest.mark.parametrize("metric", ["euclidean", "manhattan"])
def test_leaves_rule_out_pairs_where_blocks_overlap(spark, metric):
    x = np.random.default_rng(8).normal(size=(4000, 3))
    assert 0 < _neighbours_and_pairs(spark, x, 5, metric) < 0.3


def test_equal_rows_are_compared_once(spark):
    x = np.random.default_rng(9).integers(0, 3, (3000, 2)).astype(float)
    assert 0 < _neighbours_and_pairs(spark, x, 4, "euclidean") < 0.001


def test_moved_blocks_are_small_and_queries_meet_leaves_in_parts(spark, monkeypatch):
    rng = np.random.default_rng(10)
    x = np.concatenate([rng.normal(size=(2000, 2)), np.eye(6)[rng.integers(0, 6, 2000)]], axis=1)
    moved = neighbors.packed_values(x)
    assert (neighbors.unpacked(pa.scalar(moved, pa.binary()), 8) == x).all() and len(moved) < 0.3 * x.nbytes
    assert neighbors.unpacked(pa.scalar(neighbors.packed_values(x[:0]), pa.binary()), 8).shape == (0, 8)
    monkeypatch.setattr(neighbors, "ACTIVE_ROWS", 100)
    assert _neighbours_and_pairs(spark, x[:1500, :3], 5, "manhattan") > 0


def test_scans_do_not_grow_with_restarts(points, monkeypatch):
    steps = []
    plain = clustering._step
    monkeypatch.setattr(clustering, "_step", lambda rows, starts: steps.append(len(starts)) or plain(rows, starts))
    clustering.fit_clusters(points[0], ["f1", "f4"], 3, restarts=8)
    assert max(steps) == 8 and len(steps) < 80
    with pytest.raises(ValueError, match="fill"):
        clustering.fit_clusters(points[0].withColumn("f1", F.when(F.col("id") > 3, F.col("f1"))), ["f1", "f4"], 3)


@pytest.mark.parametrize("open_rows", [600, 10_000])
def test_few_scans_move_centers_as_plain_steps_do(spark, monkeypatch, open_rows):
    x = np.random.default_rng(5).normal(size=(3000, 3))
    df = spark.createDataFrame([(i, *map(float, v)) for i, v in enumerate(x)], "id int, a double, b double, c double").cache()
    monkeypatch.setattr(clustering, "OPEN_BYTES", open_rows * 24)
    monkeypatch.setattr(clustering, "STEP_ROWS", 50)
    monkeypatch.setattr(clustering, "SCAN_STEPS", 2)
    scans, plain = [], clustering._step
    monkeypatch.setattr(clustering, "_step", lambda rows, starts: scans.append(0) or plain(rows, starts))
    started: list[np.ndarray] = []
    first = clustering._first_centers
    monkeypatch.setattr(clustering, "_first_centers", lambda *args: started.append(first(*args)) or started[-1])
    found = clustering.fit_clusters(df, ["a", "b", "c"], 4, restarts=1)
    centers, steps = started[0], 0
    while steps < clustering.MAX_STEPS:
        at = ((x[:, None] - centers) ** 2).sum(2).argmin(1)
        moved = np.array([x[at == j].mean(0) for j in range(4)])
        far, centers, steps = ((moved - centers) ** 2).sum(1).max(), moved, steps + 1
        if far <= clustering.TOLERANCE**2:
            break
    assert np.allclose(found.centers, centers, atol=1e-9)
    assert found.cost == pytest.approx(((x[:, None] - centers) ** 2).sum(2).min(1).sum())
    assert steps > 20 and len(scans) <= (1 if open_rows > len(x) else steps * 3 // 4)


@pytest.mark.parametrize("selector", ["all", "mutual_info", "relief", "sfs", "embedded_dt"])
@pytest.mark.parametrize("model", ["rf", "knn", "ada"])
def test_pipelines_are_saved_and_read(points, tmp_path, selector, model):
    from pyspark.ml import PipelineModel

    df = points[0]
    limits = {"mutual_info": {"k": 3}, "relief": {"k": 3, "n_samples": 20}, "sfs": {"k": 1, "cv": 2, "max_depth_dt": 2}}
    sizes = {"rf": {"n_estimators": 2, "max_depth": 3}, "ada": {"n_estimators": 3}}
    fitted = Trial(selector, model, limits.get(selector, {}), sizes.get(model, {})).pipeline("id", "y", 3).fit(df)
    path = f"file://{tmp_path}/saved"
    fitted.save(path)
    read = PipelineModel.load(path)
    assert [type(s) for s in read.stages] == [type(s) for s in fitted.stages] and [s.uid for s in read.stages] == [s.uid for s in fitted.stages]
    assert read.stages[0].selected == fitted.stages[0].selected and read.stages[1].classes == [1, 2, 3]

    def rows(m):
        return sorted((r["id"], r["prediction"], *np.round(r["probability"], 9)) for r in m.transform(df).collect())

    assert rows(read) == rows(fitted)


def test_a_search_goes_on_where_it_stopped(points, tmp_path, monkeypatch):
    train, path = points[0], f"file://{tmp_path}/progress"
    trials = [Trial("all", "rf", {}, {"n_estimators": n, "max_depth": 2}) for n in (1, 2, 3)]
    trials += [Trial("all", "rf", {}, {"n_estimators": 1, "class_weight": "heavy"})]
    plain, fitted = SelectionSearch._score, []

    def stops(self, folded, trial, fold, key, label):
        if len(fitted) == 3:
            raise RuntimeError("the cluster went away")
        fitted.append((trial.params(), fold))
        return plain(self, folded, trial, fold, key, label)

    monkeypatch.setattr(SelectionSearch, "_score", stops)
    with pytest.raises(RuntimeError, match="away"):
        SelectionSearch(cv=2, trials=trials, parallelism=1, progress=path).fit(train, "id", "y")
    first, fitted2 = list(fitted), []

    def counts(self, folded, trial, fold, key, label):
        fitted2.append((trial.params(), fold))
        return plain(self, folded, trial, fold, key, label)

    monkeypatch.setattr(SelectionSearch, "_score", counts)
    done = SelectionSearch(cv=2, trials=trials, parallelism=1, progress=path).fit(train, "id", "y")
    assert len(first) == 3 and len(fitted2) == 5 and not set(first) & set(fitted2)
    monkeypatch.setattr(SelectionSearch, "_score", plain)
    whole = SelectionSearch(cv=2, trials=trials, parallelism=1).fit(train, "id", "y")
    assert [tuple(r) for r in done.results().collect()] == [tuple(r) for r in whole.results().collect()]
    # other rows do not take over these scores
    fitted2.clear()
    monkeypatch.setattr(SelectionSearch, "_score", counts)
    SelectionSearch(cv=2, trials=trials, parallelism=1, progress=path).fit(train.where("id > 3"), "id", "y")
    assert len(fitted2) == 8
