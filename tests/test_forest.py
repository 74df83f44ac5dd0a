"""Trees and forests grown from bins."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from gradeworks.operators import binned, forest, grouped, models, selection
from gradeworks.operators.models import Forest, Tree, TreeModel

ENDS = {"keyCol": "id", "labelCol": "y"}


@pytest.fixture(scope="module")
def ruled(spark):
    """A rule of two columns among noise."""
    noise = [(F.xxhash64("id", F.lit(i)) % 1000).cast("double").alias(f"n{i}") for i in range(6)]
    rows = spark.range(3000).select("id", (F.col("id") % 7).cast("double").alias("a"), (F.xxhash64("id") % 2 == 0).cast("double").alias("b"), *noise)
    return rows.withColumn("y", F.when(F.col("a") <= 2, 1).when(F.col("b") == 0, 2).otherwise(3)).persist()


def _trees(model: TreeModel) -> list[tuple]:
    """Every tree as nested cuts, whatever the order of its nodes."""
    f = model.inner

    def tree(n: int) -> tuple:
        if f.feature[n] < 0:
            return tuple(f.weight[n])
        return int(f.feature[n]), int(f.cut[n]), tree(f.left[n]), tree(f.left[n] + 1)

    return [tree(r) for r in f.roots]


def test_large_nodes_cut_by_all_tasks_give_the_same_trees(ruled, monkeypatch):
    settings = dict(**ENDS, n_estimators=6, class_weight="balanced")
    whole = _trees(Forest(**settings).fit(ruled))
    monkeypatch.setattr(forest, "NODE_ROWS", 400)
    monkeypatch.setattr(forest, "GROUP_ROWS", 150)
    monkeypatch.setattr(forest, "ROWS_AT_ONCE", 9000)
    monkeypatch.setattr(forest, "CELLS_AT_ONCE", 5000)
    assert _trees(Forest(**settings).fit(ruled.repartition(5))) == whole


def test_jobs_do_not_grow_with_the_depth(spark, ruled):
    # Spark ML's trees took a job or more for every level
    spark.sparkContext.setJobGroup("forest", "forest")
    Forest(**ENDS, n_estimators=4).fit(ruled)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("forest")) <= 16


def test_forest_tells_the_rule_in_every_row(spark, ruled, tmp_path):
    model = Forest(**ENDS, n_estimators=60).fit(ruled)
    out = model.transform(ruled)
    assert out.where("prediction <> y").count() == 0
    assert out.where("abs(aggregate(probability, 0D, (s, x) -> s + x) - 1) > 1e-9").count() == 0
    model.save_to(str(tmp_path / "forest"))
    loaded = TreeModel.load(str(tmp_path / "forest"))
    assert _trees(loaded) == _trees(model)
    assert loaded.transform(ruled).exceptAll(out).count() == 0


def test_tree_keeps_the_least_rows_and_the_depth(ruled):
    inner = Tree(**ENDS, min_samples_leaf=500, max_depth=3).fit(ruled).inner
    leaves = inner.weight[inner.feature < 0]
    assert leaves.sum(axis=1).min() >= 500 and len(leaves) <= 8 and leaves.sum() == 3000
    stump = Tree(**ENDS, max_depth=0).fit(ruled)
    assert len(stump.inner.feature) == 1 and stump.inner.weight.sum() == 3000


def test_importances_name_the_columns_of_the_rule(ruled):
    weights = Tree(**ENDS).fit(ruled).importances()
    assert weights["a"] + weights["b"] == pytest.approx(1) and min(weights["a"], weights["b"]) > 0.1


def test_draws_average_one_and_differ_between_trees():
    growth = forest.Growth(1, 1, 1, np.ones(2), True, 42)
    marks = forest._mixed(np.arange(200_000, dtype=np.uint64))
    draws = [forest.draws_of(marks, t, growth) for t in range(2)]
    assert abs(draws[0].mean() - 1) < 0.01 and abs((draws[0] == 0).mean() - np.exp(-1)) < 0.01
    assert abs(np.corrcoef(draws[0], draws[1])[0, 1]) < 0.01


@pytest.mark.parametrize("cells", [4_000_000, 6_000])
@pytest.mark.parametrize("depth", [1, 2, 3])
def test_rounds_from_groups_equal_rounds_from_rows(spark, ruled, depth, cells, monkeypatch):
    monkeypatch.setattr(grouped, "MAX_GROUP_CELLS", cells)
    fits = []
    for limit in (3, 0):
        monkeypatch.setattr(models, "GROUPED_DEPTH", limit)
        fits.append(models.BoostedTrees(**ENDS, n_estimators=8, base_estimator_max_depth=depth, learning_rate=0.5).fit(ruled))
    assert [(t.feature, t.cut, t.call) for t in fits[0].trees] == [(t.feature, t.cut, t.call) for t in fits[1].trees]
    assert fits[0].votes == pytest.approx(fits[1].votes, rel=1e-9)


def test_rounds_with_old_cuts_scan_no_rows(spark, ruled):
    voted = ruled.withColumn("y", F.when(F.col("a") + 3 * F.col("b") >= 5, 2).otherwise(1)).select("id", "a", "b", "y")
    spark.sparkContext.setJobGroup("rounds", "rounds")
    fitted = models.BoostedTrees(**ENDS, n_estimators=60).fit(voted)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    # before, each of the rounds took jobs of its own
    assert len(fitted.trees) == 60 and len(spark.sparkContext.statusTracker().getJobIdsForGroup("rounds")) < 40


def _folded(ruled, features):
    rows = models.assembled(ruled.withColumn("_fold", (F.col("id") % 3).cast("int")), features)
    points = rows.select(models.POINT, models.class_index([1, 2, 3], "y"), "_fold")
    return binned.bin_rows(points, models.POINT, models.CLASS, binned.bin_cuts(ruled, features, 16), 3, 16, "_fold")


def test_joint_counts_give_the_scores_of_trees_grown_by_level(ruled):
    blocks = _folded(ruled, ["a", "b", "n0", "n1"])
    sets = [[0], [2], [0, 1], [1, 3], [0, 2, 3]]
    trees = [binned.Growing(own, fold) for own in sets for fold in range(3)]
    binned.grow_together(blocks, trees, 4)
    by_level = binned.right_calls(blocks, trees).reshape(len(sets), 3)
    assert np.allclose(binned.grow_jointly(blocks, sets, 3, 4), by_level, atol=1e-12)


def test_forward_selection_takes_few_jobs_after_a_perfect_step(spark, ruled, monkeypatch):
    wide = ruled.select("id", "n0", "a", "n1", "b", "n2", "n3", "y")
    spark.sparkContext.setJobGroup("steps", "steps")
    fast = selection.Forward(**ENDS, k=6, max_bins=8).fit(wide).selected
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    # before, every step took a job per level and one more
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("steps")) <= 30
    few = selection.Forward(**ENDS, k=4, max_bins=8).fit(wide).selected
    monkeypatch.setattr(selection, "JOINT_CELLS", 0)
    monkeypatch.setattr(selection, "_leading", lambda held: 0)
    assert selection.Forward(**ENDS, k=4, max_bins=8).fit(wide).selected == few == ["n0", "a", "n1", "b"] and len(fast) == 6


def test_votes_are_those_of_all_trees(ruled):
    model = models.BoostedTrees(**ENDS, n_estimators=12, base_estimator_max_depth=2).fit(ruled)
    x = np.array(ruled.orderBy("id").select(*model.features).collect(), dtype=float)
    want = np.zeros((len(x), 3))
    for tree, vote in zip(model.trees, model.votes, strict=True):
        called = np.eye(3)[tree.calls(x.T, by_bin=False)]
        want += vote / sum(model.votes) * (called - (1 - called) / 2)
    want = np.exp(want / 2) / np.exp(want / 2).sum(axis=1, keepdims=True)
    got = np.array([r["probability"] for r in model.transform(ruled).orderBy("id").collect()])
    assert np.allclose(got, want, atol=1e-9)


def test_cuts_of_few_and_of_many_values(spark):
    df = spark.range(5000).select((F.col("id") % 5).alias("few"), (F.col("id") % 40).alias("some"), F.col("id").alias("many"), F.lit(None).cast("double").alias("none"))
    cuts = binned.bin_cuts(df, df.columns, 32)
    assert cuts[0].tolist() == [0, 1, 2, 3] and len(cuts[1]) == 31 and len(cuts[2]) == 31 and len(cuts[3]) == 0


def test_levels_and_jobs_do_not_grow_with_the_trees(spark, monkeypatch):
    monkeypatch.setattr(forest, "NODE_ROWS", 300)
    jobs = []
    cut, finish = forest._Batch._cut, forest._Batch._finish
    monkeypatch.setattr(forest._Batch, "_cut", lambda self, *nodes: jobs.append("cut") or cut(self, *nodes))
    monkeypatch.setattr(forest._Batch, "_finish", lambda self, *nodes: jobs.append("finish") or finish(self, *nodes))
    # all trees of the first fit together draw more rows than one job may take, their open nodes do not
    monkeypatch.setattr(forest, "ROWS_AT_ONCE", 6000)
    rng = np.random.default_rng(5)
    x = rng.integers(0, 6, (1000, 3))
    df = spark.createDataFrame([(i, *map(float, v), int(v[0] > 2)) for i, v in enumerate(x)], "id int, a double, b double, c double, y int")
    found = models.Forest(keyCol="id", labelCol="y", n_estimators=12).fit(df)
    assert len(found.inner.roots) == 12
    assert jobs.count("finish") <= 1 and jobs.count("cut") <= 8


def test_draws_follow_the_limits():
    growth = forest.Growth(1, 1, 1, np.ones(2), True, 42)
    marks = forest._mixed(np.arange(300_000, dtype=np.uint64))
    bits = (forest._mixed(marks ^ forest._salt(42, np.array([3]))) >> np.uint64(32)).astype(np.uint32)
    assert (forest.draws_of(marks, 3, growth) == (bits[:, None] >= forest.DRAW_LIMITS).sum(axis=1)).all()
