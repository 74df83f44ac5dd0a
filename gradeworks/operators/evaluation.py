"""Tables that judge predictions: confusion counts, per-class and averaged scores, ROC.

Inputs are frames with the true class, the predicted class and, for ROC, an array of
class scores in class order. All tables after the counts work on classes x classes
rows, so the data is scanned once and only counts are shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gradeworks.functions.order_stats import Ranges, running_totals
from gradeworks.session import stage


def ratio(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def confusion(df: DataFrame, true: str, predicted: str) -> DataFrame:
    """``(y_true, y_pred, n)`` for every pair of classes seen on either side, zeros included."""
    pairs = df.groupBy(F.col(true).alias("y_true"), F.col(predicted).alias("y_pred")).agg(
        F.count(F.lit(1)).alias("n")
    )
    counted = pairs.agg(
        F.array_union(F.collect_set("y_true"), F.collect_set("y_pred")).alias("classes"),
        F.map_from_entries(F.collect_list(F.struct(F.struct("y_true", "y_pred"), "n"))).alias("counts"),
    )
    return (
        counted.select("counts", "classes", F.explode("classes").alias("y_true"))
        .select("counts", "y_true", F.explode("classes").alias("y_pred"))
        .select(
            "y_true",
            "y_pred",
            F.coalesce(
                F.try_element_at("counts", F.struct("y_true", "y_pred")), F.lit(0)
            ).alias("n"),
        )
    )


def normalized_confusion(cells: DataFrame) -> DataFrame:
    """Add ``share``: the part of the true class that got each prediction."""
    row = Window.partitionBy("y_true")
    return cells.withColumn("share", ratio(F.col("n"), F.sum("n").over(row)))


def class_scores(cells: DataFrame) -> DataFrame:
    """One row per class: tp, fn, fp, tn, recall, specificity, precision, f1, support."""
    sides = cells.select(
        F.inline(
            F.array(
                F.struct(
                    F.col("y_true").alias("class"),
                    F.when(F.col("y_true") == F.col("y_pred"), F.col("n")).otherwise(0).alias("tp"),
                    F.col("n").alias("actual"),
                    F.lit(0).cast("long").alias("called"),
                ),
                F.struct(
                    F.col("y_pred").alias("class"),
                    F.lit(0).cast("long").alias("tp"),
                    F.lit(0).cast("long").alias("actual"),
                    F.col("n").alias("called"),
                ),
            )
        )
    )
    sums = sides.groupBy("class").agg(
        F.sum("tp").alias("tp"), F.sum("actual").alias("support"), F.sum("called").alias("called")
    )
    everything = Window.partitionBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return (
        sums.withColumn("total", F.sum("support").over(everything))
        .select(
            "class",
            "tp",
            (F.col("support") - F.col("tp")).alias("fn"),
            (F.col("called") - F.col("tp")).alias("fp"),
            (F.col("total") - F.col("support") - F.col("called") + F.col("tp")).alias("tn"),
            "support",
        )
        .withColumns(
            {
                "tpr": ratio(F.col("tp"), F.col("tp") + F.col("fn")),
                "tnr": ratio(F.col("tn"), F.col("tn") + F.col("fp")),
                "precision": ratio(F.col("tp"), F.col("tp") + F.col("fp")),
            }
        )
        .withColumn(
            "f1", ratio(2 * F.col("precision") * F.col("tpr"), F.col("precision") + F.col("tpr"))
        )
    )


def summary_scores(scores: DataFrame) -> DataFrame:
    """One row: micro_f1, macro_f1, accuracy, g_mean; micro F1 pools the counts of all classes."""
    tp, fp, fn = F.sum("tp"), F.sum("fp"), F.sum("fn")
    return scores.agg(
        ratio(2 * tp, 2 * tp + fp + fn).alias("micro_f1"),
        F.avg("f1").alias("macro_f1"),
        ratio(tp, F.sum("support")).alias("accuracy"),
        F.sqrt(F.avg("tpr") * F.avg("tnr")).alias("g_mean"),
    )


def classification_report(scores: DataFrame) -> DataFrame:
    """Per class, then unweighted and support-weighted averages."""
    measures = ("precision", "tpr", "f1")
    names = {"precision": "precision", "tpr": "recall", "f1": "f1"}
    per_class = scores.select(
        F.col("class").cast("string").alias("row"), *[F.col(m).alias(names[m]) for m in measures], "support"
    )
    macro = scores.agg(
        F.lit("macro avg").alias("row"),
        *[F.avg(m).alias(names[m]) for m in measures],
        F.sum("support").alias("support"),
    )
    weighted = scores.agg(
        F.lit("weighted avg").alias("row"),
        *[ratio(F.sum(F.col(m) * F.col("support")), F.sum("support")).alias(names[m]) for m in measures],
        F.sum("support").alias("support"),
    )
    return per_class.unionByName(macro).unionByName(weighted)


def class_counts(cells: DataFrame) -> DataFrame:
    """``(class, n_true, n_pred)``."""
    return class_scores(cells).select(
        "class", F.col("support").alias("n_true"), (F.col("tp") + F.col("fp")).alias("n_pred")
    )


def long_scores(scores: DataFrame) -> DataFrame:
    """``(class, metric, value)`` for precision, recall and F1."""
    return scores.select("class", "precision", F.col("tpr").alias("recall"), "f1").unpivot(
        "class", ["precision", "recall", "f1"], "metric", "value"
    )


def one_vs_rest(df: DataFrame, true: str, scores: str, classes: Sequence[int], keep: Sequence[str] = ()) -> DataFrame:
    """``(class, is_positive, score)``: one row per input row and class."""
    per_class = F.array(
        *[
            F.struct(
                F.lit(c).alias("class"),
                (F.col(true) == F.lit(c)).cast("int").alias("is_positive"),
                F.get(F.col(scores), F.lit(i)).alias("score"),
            )
            for i, c in enumerate(classes)
        ]
    )
    return df.select(*keep, F.inline(per_class))


def roc_curve(
    df: DataFrame, true: str, scores: str, classes: Sequence[int], n_ranges: int | None = None, direct_rows: int = 2_000_000
) -> DataFrame:
    """``(class, score, tp, fp, cum_tp, cum_fp, tpr, fpr)``; equal scores make one step.

    Rows whose label or score is null or NaN have no place on a curve and are left out,
    score by score. Equal scores are added up and stored once, and all else is taken from
    these steps. Beyond ``direct_rows`` steps the running totals are cut into score ranges,
    by default of about a quarter of that, so that no class is one task.
    """
    rows = one_vs_rest(df, true, scores, classes).where("is_positive is not null and score is not null and not isnan(score)")
    steps = rows.groupBy("class", "score").agg(
        F.sum("is_positive").alias("tp"), F.sum(1 - F.col("is_positive")).alias("fp")
    )
    steps = stage(steps, "roc-steps")
    sums = {r["class"]: r for r in steps.groupBy("class").agg(F.sum("tp").alias("p"), F.sum("fp").alias("n"), F.count("score").alias("steps")).collect()}
    n_steps = sum(r["steps"] for r in sums.values())
    ranges = None
    if n_steps > direct_rows:
        n_ranges = n_ranges or max(2, 4 * n_steps // direct_rows)
        ranges = Ranges(tuple(steps.agg(Ranges.expression("score", n_ranges)).first()[0]))
    summed = running_totals(steps, "score", ["tp", "fp"], "class", ranges)
    positives, negatives = F.lit(None).cast("bigint"), F.lit(None).cast("bigint")
    for c, r in sums.items():
        positives = F.when(F.col("class") == c, F.lit(r["p"])).otherwise(positives)
        negatives = F.when(F.col("class") == c, F.lit(r["n"])).otherwise(negatives)
    return summed.withColumns({"tpr": ratio(F.col("cum_tp"), positives), "fpr": ratio(F.col("cum_fp"), negatives)})


def auc(curve: DataFrame) -> DataFrame:
    """``(class, auc)``: trapezoids between neighbouring steps, from the origin.

    The step before a row is its running total less its own counts, so no second
    ordering of the rows is needed.
    """
    area = F.sum(F.col("fp") * (F.col("cum_tp") - F.col("tp") / 2.0))
    return curve.groupBy("class").agg(ratio(area, F.sum("tp") * F.sum("fp")).alias("auc"))


@dataclass(frozen=True)
class Evaluation:
    confusion: DataFrame
    normalized: DataFrame
    scores: DataFrame
    summary: DataFrame
    report: DataFrame
    counts: DataFrame
    long: DataFrame
    roc: DataFrame | None = None
    auc: DataFrame | None = None


def check_predictions(
    df: DataFrame, true: str, predicted: str, scores: str | None, class_names: Sequence[str] | None
) -> list[int]:
    """Raise unless every row has both classes and full scores, and names match the classes."""
    width = F.size(scores) if scores else F.lit(0)
    facts = df.agg(
        F.count_if(F.col(true).isNull() | F.col(predicted).isNull()).alias("incomplete"),
        F.collect_set(true).alias("classes"),
        F.min(width).alias("shortest"),
        F.max(width).alias("longest"),
    ).first()
    classes = sorted(facts["classes"])
    if facts["incomplete"]:
        raise ValueError(f"{facts['incomplete']} rows lack a true or a predicted class")
    if scores and not facts["shortest"] == facts["longest"] == len(classes):
        raise ValueError("the score column must hold one score per class in every row")
    if class_names is not None and len(class_names) != len(classes):
        raise ValueError(f"{len(class_names)} class names given for {len(classes)} classes")
    return classes


def evaluate(
    df: DataFrame,
    true: str,
    predicted: str,
    scores: str | None = None,
    class_names: Sequence[str] | None = None,
) -> Evaluation:
    """All evaluation tables of one prediction frame."""
    classes = check_predictions(df, true, predicted, scores, class_names)
    cells = confusion(df, true, predicted)
    per_class = class_scores(cells)
    curve = roc_curve(df, true, scores, classes) if scores else None
    return Evaluation(
        confusion=cells,
        normalized=normalized_confusion(cells),
        scores=per_class,
        summary=summary_scores(per_class),
        report=classification_report(per_class),
        counts=class_counts(cells),
        long=long_scores(per_class),
        roc=curve,
        auc=auc(curve) if curve is not None else None,
    )


def micro_f1(df: DataFrame, true: str, predicted: str) -> float:
    """Share of right predictions, which is micro F1 when every row has one class."""
    return df.agg(F.avg((F.col(true) == F.col(predicted)).cast("double"))).first()[0]
