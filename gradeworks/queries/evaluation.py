"""Evaluation tables of predictions that are fixed arithmetic on the case key."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gradeworks.operators import evaluation as ops
from gradeworks.operators.search import ranked, summarize_folds
from gradeworks.queries.cleaning import SOUND
from gradeworks.queries.registry import long_rows, long_sql, query, rounded
from gradeworks.session import stage
from gradeworks.sources.cases import CASES, cases
from gradeworks.sources.writers import class_table, summary_table

MULTIPLIERS = (7, 11, 13)


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``case_id, grade, called, scores``: right in about three of five cases, scores with ties."""
    key, grade = F.col("case_id"), F.col("grade")
    scores = [
        ((key * m) % 97 + F.when(grade == c, 30).otherwise(0)) / F.lit(127.0)
        for c, m in zip(CASES.classes, MULTIPLIERS, strict=True)
    ]
    return cases(spark, sf_dir).select(
        "case_id",
        "grade",
        F.when(key % 5 < 3, grade).otherwise((key % 3 + 1).cast("int")).alias("called"),
        F.array(*scores).alias("scores"),
    )


PREDICTED = (
    SOUND
    + """, predicted AS (SELECT case_id, grade, CASE WHEN case_id % 5 < 3 THEN grade ELSE CAST(case_id % 3 + 1 AS INTEGER) END AS called,
  """
    + ", ".join(
        f"((case_id * {m}) % 97 + CASE WHEN grade = {c} THEN 30 ELSE 0 END) / 127.0::DOUBLE AS s{c}"
        for c, m in zip(CASES.classes, MULTIPLIERS, strict=True)
    )
    + """ FROM cases),
classes AS (SELECT grade AS c FROM predicted UNION SELECT called FROM predicted),
cells AS (SELECT a.c AS y_true, b.c AS y_pred, count(p.case_id) AS n FROM classes a CROSS JOIN classes b
  LEFT JOIN predicted p ON p.grade = a.c AND p.called = b.c GROUP BY a.c, b.c),
sides AS (SELECT c.c AS class, sum(n) FILTER (WHERE y_true = c.c AND y_pred = c.c) AS tp,
  sum(n) FILTER (WHERE y_true = c.c) AS support, sum(n) FILTER (WHERE y_pred = c.c) AS called, sum(n) AS total
  FROM cells CROSS JOIN classes c GROUP BY c.c),
rates AS (SELECT class, CAST(tp AS BIGINT) AS tp, CAST(support - tp AS BIGINT) AS fn, CAST(called - tp AS BIGINT) AS fp,
  CAST(total - support - called + tp AS BIGINT) AS tn, CAST(support AS BIGINT) AS support,
  coalesce(tp / nullif(support, 0), 0)::DOUBLE AS tpr,
  coalesce((total - support - called + tp) / nullif(total - support, 0), 0)::DOUBLE AS tnr,
  coalesce(tp / nullif(called, 0), 0)::DOUBLE AS "precision" FROM sides),
scores AS (SELECT *, coalesce(2 * "precision" * tpr / nullif("precision" + tpr, 0), 0) AS f1 FROM rates)
"""
)
STEPS_SQL = (
    """, one_vs_rest AS ("""
    + " UNION ALL ".join(f"SELECT {c} AS class, s{c} AS score, (grade = {c})::INT AS pos FROM predicted" for c in (1, 2, 3))
    + """), steps AS (SELECT class, score, sum(pos) AS tp, sum(1 - pos) AS fp FROM one_vs_rest GROUP BY class, score),
curve AS (SELECT class, score, tp, fp, sum(tp) OVER w AS cum_tp, sum(fp) OVER w AS cum_fp,
  sum(tp) OVER (PARTITION BY class) AS p, sum(fp) OVER (PARTITION BY class) AS n
  FROM steps WINDOW w AS (PARTITION BY class ORDER BY score DESC)),
sides_roc AS (SELECT class, score, cum_tp / p AS tpr, cum_fp / n AS fpr, cum_tp, cum_fp FROM curve),
lagged AS (SELECT class, tpr, fpr, lag(tpr, 1, 0) OVER w AS before_tpr, lag(fpr, 1, 0) OVER w AS before_fpr
  FROM sides_roc WINDOW w AS (PARTITION BY class ORDER BY score DESC)),
areas AS (SELECT class, sum((fpr - before_fpr) * (tpr + before_tpr) / 2) AS auc FROM lagged GROUP BY class)
"""
)


@query("ag18_confusion_matrix", PREDICTED + "SELECT y_true, y_pred, n FROM cells")
def confusion_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.confusion(predictions(spark, sf_dir), "grade", "called")


@query(
    "ag19_normalized_confusion",
    PREDICTED + "SELECT y_true, y_pred, n, round(n / sum(n) OVER (PARTITION BY y_true), 6) AS share FROM cells",
)
def normalized_confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(ops.normalized_confusion(ops.confusion(predictions(spark, sf_dir), "grade", "called")))


def _scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.class_scores(ops.confusion(predictions(spark, sf_dir), "grade", "called"))


@query(
    "ag20_class_scores",
    PREDICTED
    + """SELECT class, tp, fn, fp, tn, support, round(tpr, 6) AS tpr, round(tnr, 6) AS tnr,
    round("precision", 6) AS "precision", round(f1, 6) AS f1 FROM scores""",
)
def class_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_scores(spark, sf_dir))


SUMMARY_SQL = """SELECT round(sum(tp)::DOUBLE / sum(support), 6) AS micro_f1, round(avg(f1), 6) AS macro_f1,
  round(sum(tp)::DOUBLE / sum(support), 6) AS accuracy, round(sqrt(avg(tpr) * avg(tnr)), 6) AS g_mean FROM scores"""


@query("ag21_summary_scores", PREDICTED + SUMMARY_SQL)
def summary_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(ops.summary_scores(_scores(spark, sf_dir)))


@query(
    "ag22_classification_report",
    PREDICTED
    + """SELECT CAST(class AS VARCHAR) AS "row", round("precision", 6) AS "precision", round(tpr, 6) AS recall, round(f1, 6) AS f1,
      support FROM scores
    UNION ALL SELECT 'macro avg', round(avg("precision"), 6), round(avg(tpr), 6), round(avg(f1), 6), CAST(sum(support) AS BIGINT) FROM scores
    UNION ALL SELECT 'weighted avg', round(sum("precision" * support) / sum(support), 6), round(sum(tpr * support) / sum(support), 6),
      round(sum(f1 * support) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM scores""",
)
def classification_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(ops.classification_report(_scores(spark, sf_dir)))


@query(
    "ag23_class_counts",
    PREDICTED
    + """SELECT c AS class, (SELECT count(*) FROM predicted WHERE grade = c) AS n_true,
    (SELECT count(*) FROM predicted WHERE called = c) AS n_pred FROM classes""",
)
def class_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.class_counts(ops.confusion(predictions(spark, sf_dir), "grade", "called"))


@query(
    "ag24_long_scores",
    PREDICTED
    + """SELECT class, 'precision' AS metric, round("precision", 6) AS value FROM scores
    UNION ALL SELECT class, 'recall', round(tpr, 6) FROM scores UNION ALL SELECT class, 'f1', round(f1, 6) FROM scores""",
)
def long_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(ops.long_scores(_scores(spark, sf_dir)))


@query(
    "wf02_roc_curve",
    PREDICTED
    + STEPS_SQL
    + """SELECT class, round(score, 6) AS score, CAST(cum_tp AS BIGINT) AS cum_tp, CAST(cum_fp AS BIGINT) AS cum_fp,
    round(tpr, 6) AS tpr, round(fpr, 6) AS fpr FROM sides_roc""",
)
def roc_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    curve = ops.roc_curve(predictions(spark, sf_dir), "grade", "scores", CASES.classes)
    return rounded(curve.select("class", "score", "cum_tp", "cum_fp", "tpr", "fpr"))


@query("wf03_auc", PREDICTED + STEPS_SQL + "SELECT class, round(auc, 6) AS auc FROM areas")
def auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(ops.auc(ops.roc_curve(predictions(spark, sf_dir), "grade", "scores", CASES.classes)))


@query(
    "sf07_one_vs_rest",
    PREDICTED
    + " UNION ALL ".join(
        f"SELECT case_id, {c} AS class, (grade = {c})::INT AS is_positive, round(s{c}, 6) AS score FROM predicted"
        for c in (1, 2, 3)
    ),
)
def one_vs_rest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(ops.one_vs_rest(predictions(spark, sf_dir), "grade", "scores", CASES.classes, keep=["case_id"]))


@query(
    "io08_metrics_tables",
    PREDICTED
    + """SELECT CAST(class AS VARCHAR) AS name, round(tpr, 4) AS tpr, round(tnr, 4) AS tnr, round("precision", 4) AS "precision",
      round(f1, 4) AS f1, support FROM scores""",
)
def metrics_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return class_table(_scores(spark, sf_dir)).drop("class")


@query(
    "ml24_evaluation_bundle",
    PREDICTED
    + STEPS_SQL
    + f""", averages AS ({SUMMARY_SQL})
    SELECT 'micro_f1' AS metric, micro_f1 AS value FROM averages UNION ALL SELECT 'macro_f1', macro_f1 FROM averages
    UNION ALL SELECT 'accuracy', accuracy FROM averages UNION ALL SELECT 'g_mean', g_mean FROM averages
    UNION ALL SELECT concat('auc_', class), round(auc, 6) FROM areas
    UNION ALL SELECT concat('support_', class), support::DOUBLE FROM scores""",
)
def evaluation_bundle(spark: SparkSession, sf_dir: str) -> DataFrame:
    # written once, as every table of the bundle reads them
    tables = ops.evaluate(stage(predictions(spark, sf_dir), "predictions"), "grade", "called", "scores", ["low", "middle", "high"])
    return rounded(
        summary_table(tables.summary)
        .unionByName(tables.auc.select(F.concat(F.lit("auc_"), "class").alias("metric"), F.col("auc").alias("value")))
        .unionByName(
            tables.scores.select(
                F.concat(F.lit("support_"), "class").alias("metric"), F.col("support").cast("double").alias("value")
            )
        )
    )


SCORE_VALUES = ("tp", "fn", "fp", "tn", "support", "tpr", "tnr", "precision", "f1")
REPORT_SQL = """SELECT CAST(class AS VARCHAR) AS "row", "precision", tpr AS recall, f1, support FROM scores
    UNION ALL SELECT 'macro avg', avg("precision"), avg(tpr), avg(f1), sum(support) FROM scores
    UNION ALL SELECT 'weighted avg', sum("precision" * support) / sum(support), sum(tpr * support) / sum(support),
      sum(f1 * support) / sum(support), sum(support) FROM scores"""
COUNTS_SQL = """SELECT c AS class, (SELECT count(*) FROM predicted WHERE grade = c) AS n_true,
    (SELECT count(*) FROM predicted WHERE called = c) AS n_pred FROM classes"""
BUNDLE_SQL = [
    long_sql("confusion", "SELECT y_true, y_pred, n FROM cells", ["y_true", "y_pred"], ["n"]),
    long_sql("normalized", "SELECT y_true, y_pred, n / sum(n) OVER (PARTITION BY y_true) AS share FROM cells", ["y_true", "y_pred"], ["share"]),
    long_sql("scores", "SELECT * FROM scores", ["class"], SCORE_VALUES),
    long_sql("summary", SUMMARY_SQL, [], ["micro_f1", "macro_f1", "accuracy", "g_mean"]),
    long_sql("report", REPORT_SQL, ['"row"'], ["precision", "recall", "f1", "support"]),
    long_sql("counts", COUNTS_SQL, ["class"], ["n_true", "n_pred"]),
    long_sql("long", """SELECT class, 'precision' AS metric, "precision" AS value FROM scores UNION ALL SELECT class, 'recall', tpr FROM scores
      UNION ALL SELECT class, 'f1', f1 FROM scores""", ["class", "metric"], ["value"]),
    long_sql("roc", "SELECT class, CAST(round(score * 127) AS BIGINT) AS step, cum_tp, cum_fp, tpr, fpr FROM sides_roc",
             ["class", "step"], ["cum_tp", "cum_fp", "tpr", "fpr"]),
    long_sql("auc", "SELECT class, auc FROM areas", ["class"], ["auc"]),
]


@query("ml24_evaluation_tables", PREDICTED + STEPS_SQL + " UNION ALL ".join(BUNDLE_SQL))
def evaluation_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All nine tables of the bundle in long form."""
    found = ops.evaluate(stage(predictions(spark, sf_dir), "predictions"), "grade", "called", "scores", ["low", "middle", "high"])
    # scores are whole numbers over 127
    curve = found.roc.select("class", F.round(F.col("score") * 127).cast("bigint").alias("step"), "cum_tp", "cum_fp", "tpr", "fpr")
    tables = [
        ("confusion", found.confusion, ["y_true", "y_pred"]),
        ("normalized", found.normalized.drop("n"), ["y_true", "y_pred"]),
        ("scores", found.scores, ["class"]),
        ("summary", found.summary, []),
        ("report", found.report, ["row"]),
        ("counts", found.counts, ["class"]),
        ("long", found.long, ["class", "metric"]),
        ("roc", curve, ["class", "step"]),
        ("auc", found.auc, ["class"]),
    ]
    return rounded(reduce(DataFrame.unionByName, [long_rows(*t) for t in tables]), ["value"])


def _fold_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One configuration per priority, four folds by key, share of right calls."""
    rows = predictions(spark, sf_dir).join(cases(spark, sf_dir).select("case_id", "priority"), "case_id")
    return rows.groupBy(F.col("priority").alias("config"), (F.col("case_id") % 4).alias("fold")).agg(
        F.avg((F.col("grade") == F.col("called")).cast("double")).alias("score")
    )


FOLDS_SQL = (
    PREDICTED
    + """, fold_scores AS (SELECT priority AS config, p.case_id % 4 AS fold, avg((p.grade = called)::INT::DOUBLE) AS score
  FROM predicted p JOIN cases c ON p.case_id = c.case_id GROUP BY ALL),
summary AS (SELECT config, avg(score) AS mean, stddev_pop(score) AS dev FROM fold_scores GROUP BY config)
"""
)


@query(
    "ag28_fold_summary",
    FOLDS_SQL + "SELECT config, round(mean, 5) AS mean_cv_score, round(dev, 5) AS std_cv_score FROM summary",
)
def fold_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summarize_folds(_fold_scores(spark, sf_dir)).drop("mean")


@query(
    "wf01_rank_configurations",
    FOLDS_SQL
    + """SELECT config, round(mean, 5) AS mean_cv_score, round(dev, 5) AS std_cv_score,
    CAST(rank() OVER (ORDER BY mean DESC NULLS LAST) AS INTEGER) AS rank FROM summary""",
)
def rank_configurations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked(summarize_folds(_fold_scores(spark, sf_dir)))
