"""Nulls, NaN, ties and mixed files, on both sides of every switch that only chooses a strategy."""

from __future__ import annotations

import json
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from gradeworks.functions.hash_order import find_cuts
from gradeworks.functions.order_stats import exact_quantiles
from gradeworks.operators.evaluation import auc, roc_curve
from gradeworks.operators.imputation import fill, fit_fill_values
from gradeworks.operators.models import Forest, Neighbors
from gradeworks.operators.sampling import split_three
from gradeworks.operators.scaling import fit_min_range, rescale
from gradeworks.operators.search import SelectionSearch, Trial
from gradeworks.operators.selection import MutualInfo
from gradeworks.sources.cases import CASES
from gradeworks.sources.readers import read_delimited, read_json


@pytest.mark.parametrize("direct_rows", [3, 10, 100, 500_000])
def test_quantiles_leave_out_nan_and_null(spark, direct_rows):
    values = [float(i) for i in range(160)] + [math.nan] * 40 + [None] * 10 + [5.0] * 30
    frame = spark.createDataFrame([(v, i % 2) for i, v in enumerate(values)], "x double, g int")
    got = exact_quantiles(frame, ["x"], [0.25, 0.5, 0.99], by="g", direct_rows=direct_rows)
    for g in (0, 1):
        mine = [v for i, v in enumerate(values) if i % 2 == g and v is not None and not math.isnan(v)]
        assert got[g, "x"] == pytest.approx(np.quantile(mine, [0.25, 0.5, 0.99]))
    assert exact_quantiles(frame.where("isnan(x)"), ["x"], [0.5], direct_rows=direct_rows) == {}


@pytest.mark.parametrize("direct_rows", [5, 2_000_000])
def test_roc_leaves_out_rows_without_score_or_label(spark, direct_rows):
    rows = [(1 + i % 2, [((i * 7) % 23) / 23, ((i * 5) % 19) / 19]) for i in range(80)]
    gaps = [(1, None), (2, [None, 0.5]), (1, [math.nan, 0.2]), (None, [0.4, 0.6])]
    frame = spark.createDataFrame(rows + gaps, "y int, s array<double>")
    curve = roc_curve(frame, "y", "s", [1, 2], direct_rows=direct_rows)
    got = {r["class"]: r["auc"] for r in auc(curve).collect()}
    for k, c in enumerate((1, 2)):
        scored = [(y == c, s[k]) for y, s in [*rows, (2, [None, 0.5]), (1, [math.nan, 0.2])] if s[k] is not None and not math.isnan(s[k])]
        pairs = [(a > b) + (a == b) / 2 for p, a in scored if p for q, b in scored if not q]
        assert got[c] == pytest.approx(sum(pairs) / len(pairs))
    assert curve.agg(F.sum("tp") + F.sum("fp")).first()[0] == 162


def test_null_keys_and_too_many_strata_are_named(spark):
    frame = spark.createDataFrame([(1, 1), (None, 1), (3, 2)], "id int, label int")
    with pytest.raises(ValueError, match="'id' has null keys"):
        split_three(frame, "id", "label")
    many = spark.range(1200).selectExpr("id", "id AS stratum")
    with pytest.raises(ValueError, match="'stratum' has more than"):
        find_cuts(many, "id", lambda sizes: dict.fromkeys(sizes, [1]), by="stratum")


def test_flags_stored_as_doubles_are_filled(spark):
    frame = spark.createDataFrame(
        [(i, 1, v) for i, v in enumerate([1.0, 1.0, None, 0.0])], f"{CASES.key} int, {CASES.label} int, has_return double"
    )
    rows = fill(frame, fit_fill_values(frame, CASES)).orderBy(CASES.key).collect()
    assert [r["has_return"] for r in rows] == [1.0, 1.0, 1.0, 0.0]


def test_columns_without_values_are_left_as_they_are(spark):
    frame = spark.createDataFrame([(1.0, None), (3.0, None)], "a double, b double")
    ranges = fit_min_range(frame, ["a", "b"])
    assert ranges == {"a": (1.0, 2.0)}
    assert [tuple(r) for r in rescale(frame, ranges).collect()] == [(0.0, None), (1.0, None)]


def test_queries_without_a_feature_raise(spark):
    train = spark.createDataFrame([(i, float(i % 5), i % 2) for i in range(20)], "key int, x double, label int")
    model = Neighbors(n_neighbors=3).fit(train)
    assert model.transform(train).count() == 20
    with pytest.raises(ValueError, match="rows without a value"):
        model.transform(spark.createDataFrame([(1, 2.0, 0), (2, None, 0)], "key int, x double, label int"))


def test_depth_above_the_deepest_is_refused(spark):
    train = spark.createDataFrame([(i, float(i % 5), i % 2) for i in range(20)], "key int, x double, label int")
    with pytest.raises(ValueError, match="max_depth 31"):
        Forest(n_estimators=1, max_depth=31).fit(train)


def test_folders_of_json_arrays_and_lines(spark, tmp_path):
    (tmp_path / "a.json").write_text("\n " + json.dumps([{"x": 1, "y": "a"}, {"x": 2, "y": "b"}]))
    (tmp_path / "b.json").write_text('\n{"x": 3, "y": "c"}\n{"x": 4, "z": 1.5}\n')
    rows = read_json(spark, str(tmp_path)).collect()
    assert sorted((r["x"], r["y"], r["z"]) for r in rows if r["x"] < 4) == [(1, "a", None), (2, "b", None), (3, "c", None)]
    assert [(r["y"], r["z"]) for r in rows if r["x"] == 4] == [(None, 1.5)]
    assert sorted(r["x"] for r in read_json(spark, str(tmp_path / "a.json")).collect()) == [1, 2]
    assert sorted(r["x"] for r in read_json(spark, str(tmp_path / "b.json")).collect()) == [3, 4]


def test_quoted_line_breaks(spark, tmp_path):
    (tmp_path / "t.csv").write_text('a,b\n1,"two\nlines"\n2,NaN\n')
    rows = read_delimited(spark, str(tmp_path / "t.csv"), line_breaks=True).orderBy("a").collect()
    assert [tuple(r) for r in rows] == [(1, "two\nlines"), (2, None)]


def test_a_score_function_of_the_caller(spark):
    rows = spark.createDataFrame([(1, 1.0, 2.0, 3.0, 1), (2, 2.0, 1.0, 0.0, 2)], "key int, a double, b double, c double, label int")

    def by_name(df, features, label):
        return df.sparkSession.createDataFrame([(f, float(ord(f))) for f in features], "feature string, score double")

    assert MutualInfo(k=2, scores=by_name).fit(rows).selected == ["b", "c"]


def test_a_search_removes_what_its_trials_stored(spark):
    from pathlib import Path

    staged = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:")) / "staged"
    before = set(staged.iterdir()) if staged.exists() else set()
    rows = spark.createDataFrame([(i, float(i % 7), float(i % 3), int(i % 7 > 3)) for i in range(60)], "key int, a double, b double, label int")
    trials = [
        Trial("mutual_info", "knn", {"k": 1}, {"n_neighbors": 3}),
        Trial("mutual_info", "rf", {"k": 2}, {"n_estimators": 2, "max_depth": 40}),
    ]
    search = SelectionSearch(cv=2, trials=trials, parallelism=2).fit(rows, "key", "label")
    assert search.best_score() == 1.0 and search.predict(rows).count() == 60
    left = sorted(p.name.split("-")[0] for p in set(staged.iterdir()) - before)
    # the tables of the refitted winner and the order of the folds; none of the two trials and two folds
    assert left.count("knn") == 1 and left.count("scored") == 1
    failed = {r["config"]: r["mean_cv_score"] for r in search.results().collect()}
    assert failed == {0: 1.0, 1: None}
