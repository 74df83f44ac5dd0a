from __future__ import annotations

import math

import numpy as np
import pytest

from gradeworks.operators import evaluation as ev
from gradeworks.operators.search import ranked, summarize_folds
from gradeworks.sources.writers import class_table, summary_table, write_metrics

# Recorded per-class rates and supports of two splits, with their averages.
# Recorded scores.
RECORDED = {
    "validation": (
        [(0.4814, 0.9783, 0.7031, 0.5715, 3768), (0.8624, 0.5955, 0.7378, 0.7952, 22239), (0.6210, 0.9081, 0.7726, 0.6885, 13083)],
        (0.744871, 0.685100, 0.736084),
    ),
    "test": (
        [(0.4712, 0.9790, 0.7050, 0.5649, 3769), (0.8618, 0.5898, 0.7349, 0.7933, 22239), (0.6174, 0.9071, 0.7697, 0.6852, 13083)],
        (0.742319, 0.681116, 0.732478),
    ),
}


@pytest.fixture(scope="module")
def predicted(spark):
    rng = np.random.default_rng(11)
    y = rng.choice([1, 2, 3], 400, p=[0.1, 0.57, 0.33])
    called = np.where(rng.random(400) < 0.6, y, rng.integers(1, 4, 400))
    scores = np.round(rng.random((400, 3)) + 0.3 * (y[:, None] == np.array([1, 2, 3])), 2)  # many ties
    rows = [(int(a), int(b), [float(x) for x in s]) for a, b, s in zip(y, called, scores)]
    return spark.createDataFrame(rows, "y int, called int, scores array<double>"), y, called, scores


def test_confusion_fills_the_grid(spark):
    rows = spark.createDataFrame([(1, 1), (1, 2), (3, 2), (3, 9)], "y int, p int")
    cells = {(r["y_true"], r["y_pred"]): r["n"] for r in ev.confusion(rows, "y", "p").collect()}
    assert len(cells) == 16 and sum(cells.values()) == 4
    assert cells[1, 2] == 1 and cells[3, 9] == 1 and cells[9, 9] == 0 and cells[2, 2] == 0


def test_scores_against_plain_counting(predicted):
    rows, y, called, _ = predicted
    got = {r["class"]: r for r in ev.class_scores(ev.confusion(rows, "y", "called")).collect()}
    for c in (1, 2, 3):
        tp, fn = ((y == c) & (called == c)).sum(), ((y == c) & (called != c)).sum()
        fp, tn = ((y != c) & (called == c)).sum(), ((y != c) & (called != c)).sum()
        assert tuple(got[c][k] for k in ("tp", "fn", "fp", "tn", "support")) == (tp, fn, fp, tn, tp + fn)
        assert got[c]["tpr"] == pytest.approx(tp / (tp + fn)) and got[c]["tnr"] == pytest.approx(tn / (tn + fp))
        assert got[c]["precision"] == pytest.approx(tp / (tp + fp))
        assert got[c]["f1"] == pytest.approx(2 * tp / (2 * tp + fp + fn))


def test_summary(predicted):
    rows, y, called, _ = predicted
    scores = ev.class_scores(ev.confusion(rows, "y", "called"))
    got, per_class = ev.summary_scores(scores).first(), scores.toPandas()
    assert got["micro_f1"] == got["accuracy"] == pytest.approx((y == called).mean())
    assert got["macro_f1"] == pytest.approx(per_class["f1"].mean())
    assert got["g_mean"] == pytest.approx(math.sqrt(per_class["tpr"].mean() * per_class["tnr"].mean()))
    assert ev.micro_f1(rows, "y", "called") == got["micro_f1"]


@pytest.mark.parametrize("split", RECORDED)
def test_recorded_scores_keep_their_identities(spark, split):
    """Counts rebuilt from the recorded rates give the recorded averages."""
    classes, (micro, macro, g_mean) = RECORDED[split]
    total = sum(c[4] for c in classes)
    rows = []
    for i, (tpr, tnr, _, _, n) in enumerate(classes, 1):
        tp, tn = round(tpr * n), round(tnr * (total - n))
        rows.append((i, tp, n - tp, total - n - tn, tn, n, tpr, tnr))
    table = spark.createDataFrame(rows, "class int, tp long, fn long, fp long, tn long, support long, tpr double, tnr double")
    table = table.withColumn("precision", ev.ratio(table.tp, table.tp + table.fp))
    table = table.withColumn("f1", ev.ratio(2 * table.precision * table.tpr, table.precision + table.tpr))
    got = ev.summary_scores(table).first()
    assert got["accuracy"] == pytest.approx(micro, abs=1e-4)
    assert got["macro_f1"] == pytest.approx(macro, abs=1e-4)
    assert got["g_mean"] == pytest.approx(g_mean, abs=1e-4)
    for r, (_, _, precision, f1, _) in zip(table.orderBy("class").collect(), classes):
        assert r["precision"] == pytest.approx(precision, abs=1e-3) and r["f1"] == pytest.approx(f1, abs=1e-3)


def test_zero_denominators_give_zero(spark):
    rows = spark.createDataFrame([(1, 2), (1, 2)], "y int, p int")
    got = {r["class"]: r for r in ev.class_scores(ev.confusion(rows, "y", "p")).collect()}
    assert got[1]["precision"] == got[1]["f1"] == got[2]["tpr"] == 0.0
    shares = ev.normalized_confusion(ev.confusion(rows, "y", "p")).where("y_true = 2").collect()
    assert [r["share"] for r in shares] == [0.0, 0.0]


def test_report_averages(predicted):
    scores = ev.class_scores(ev.confusion(predicted[0], "y", "called"))
    report = {r["row"]: r for r in ev.classification_report(scores).collect()}
    per_class = scores.toPandas()
    assert set(report) == {"1", "2", "3", "macro avg", "weighted avg"}
    assert report["macro avg"]["recall"] == pytest.approx(per_class["tpr"].mean())
    assert report["weighted avg"]["f1"] == pytest.approx((per_class["f1"] * per_class["support"]).sum() / 400)
    assert report["macro avg"]["support"] == 400


@pytest.mark.parametrize("direct_rows", [1_000_000, 5])
def test_roc_and_auc_with_ties(predicted, direct_rows):
    rows, y, _, scores = predicted
    curve = ev.roc_curve(rows, "y", "scores", [1, 2, 3], n_ranges=16, direct_rows=direct_rows)
    areas = {r["class"]: r["auc"] for r in ev.auc(curve).collect()}
    points = curve.toPandas()
    for i, c in enumerate((1, 2, 3)):
        positive, negative = scores[y == c, i], scores[y != c, i]
        wins = (positive[:, None] > negative[None]).mean() + 0.5 * (positive[:, None] == negative[None]).mean()
        assert areas[c] == pytest.approx(wins)
        mine = points[points["class"] == c].sort_values("score", ascending=False)
        assert len(mine) == len(np.unique(scores[:, i]))
        assert mine["tpr"].iloc[-1] == mine["fpr"].iloc[-1] == 1.0
        assert (np.diff(mine["cum_tp"]) >= 0).all()
        at = mine.iloc[len(mine) // 2]
        assert at["cum_tp"] == (positive >= at["score"]).sum() and at["cum_fp"] == (negative >= at["score"]).sum()


def test_counts_and_long_form(predicted):
    rows, y, called, _ = predicted
    cells = ev.confusion(rows, "y", "called")
    counts = {r["class"]: (r["n_true"], r["n_pred"]) for r in ev.class_counts(cells).collect()}
    assert counts == {c: ((y == c).sum(), (called == c).sum()) for c in (1, 2, 3)}
    assert ev.long_scores(ev.class_scores(cells)).count() == 9


def test_input_checks(spark, predicted):
    rows = predicted[0]
    with pytest.raises(ValueError, match="score"):
        ev.evaluate(rows.selectExpr("y", "called", "slice(scores, 1, 2) AS scores"), "y", "called", "scores")
    with pytest.raises(ValueError, match="names"):
        ev.evaluate(rows, "y", "called", "scores", ["a", "b"])
    with pytest.raises(ValueError, match="lack"):
        ev.evaluate(spark.createDataFrame([(1, None), (2, 2)], "y int, called int"), "y", "called")


def test_metrics_are_written(spark, tmp_path, predicted):
    tables = ev.evaluate(predicted[0], "y", "called", "scores", ["low", "middle", "high"])
    write_metrics(tables, str(tmp_path / "eval"), {1: "low", 2: "middle", 3: "high"})
    summary = spark.read.csv(str(tmp_path / "eval/summary"), header=True)
    assert [r["metric"] for r in summary.collect()] == ["micro_f1", "macro_f1", "accuracy", "g_mean"]
    classes = spark.read.csv(str(tmp_path / "eval/classes"), header=True, inferSchema=True).orderBy("class").collect()
    want = class_table(tables.scores).orderBy("class").collect()
    assert [r["f1"] for r in classes] == [r["f1"] for r in want] and [r["name"] for r in classes] == ["low", "middle", "high"]
    assert summary_table(tables.summary).count() == 4


def test_failed_fold_ranks_last_and_ties_share_a_rank(spark):
    scores = [(0, 0, 0.5), (0, 1, 0.7), (1, 0, 0.6), (1, 1, 0.6), (2, 0, 0.9), (2, 1, None), (3, 0, 0.1), (3, 1, 0.2)]
    table = ranked(summarize_folds(spark.createDataFrame(scores, "config int, fold int, score double")))
    rows = {r["config"]: r for r in table.collect()}
    assert {c: r["rank"] for c, r in rows.items()} == {0: 1, 1: 1, 3: 3, 2: 4}
    assert rows[0]["std_cv_score"] == 0.1 and rows[2]["mean_cv_score"] is None
