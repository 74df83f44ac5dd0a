"""Iterative and random operators, on cases whose grade follows a planted rule.

Statuses of the test data do not depend on the features, so no model could be checked on them.
Here the grade is a rule of two columns, which a model that works must recover in every row;
the SQL states the rule. All selectors, models and searches read the prepared table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gradeworks.operators import clustering, models, selection
from gradeworks.operators.evaluation import class_scores, confusion
from gradeworks.operators.sampling import split_three
from gradeworks.operators.search import SelectionSearch, Trial, compare_selectors
from gradeworks.plans.preparation import Preparation, fit_preparation
from gradeworks.plans.training import predict_only, train_final
from gradeworks.queries.registry import query
from gradeworks.session import stage, staged_path
from gradeworks.sources.cases import CASES, CASES_SQL, cases
from gradeworks.sources.checkpoint import load_best
from gradeworks.sources.writers import write_search_results

ENDS = {"keyCol": CASES.key, "labelCol": CASES.label}
# Each of these can express the rule, so each must reach the best score.
TRIALS = (
    Trial("mutual_info", "rf", {"k": 8}, {"n_estimators": 100, "max_depth": 15}),
    Trial("all", "ada", {}, {"n_estimators": 300, "base_estimator_max_depth": 2}),
    Trial("embedded_dt", "ada", {"threshold": "mean", "max_depth": 12}, {"n_estimators": 300, "base_estimator_max_depth": 2}),
)

PLANTED_SQL = f"""{CASES_SQL},
planted AS (
  SELECT * REPLACE (CASE WHEN n_lines <= 3 THEN 1 WHEN has_return = 0 THEN 2 ELSE 3 END AS grade)
  FROM cases WHERE n_lines IS NOT NULL)
"""
# A vote of three columns, which takes boosted stumps at least 50 rounds to tell in every row.
VOTED_SQL = f"""{CASES_SQL},
planted AS (
  SELECT * REPLACE (CASE WHEN n_lines + 2 * has_return + 3 * has_bulk >= 5 THEN 2 ELSE 1 END AS grade)
  FROM cases WHERE n_lines IS NOT NULL)
"""
ROUNDS = 150
EXACT_ROWS = f"WITH {PLANTED_SQL} SELECT case_id, grade, grade AS prediction FROM planted"
EXACT_SUBMISSION = f"WITH {VOTED_SQL} SELECT case_id, grade FROM planted"
EXACT_SCORES = """SELECT grade AS class, count(*) AS tp, 0 AS fn, 0 AS fp, sum(count(*)) OVER () - count(*) AS tn, count(*) AS support,
       1.0 AS tpr, 1.0 AS tnr, 1.0 AS precision, 1.0 AS f1
FROM planted GROUP BY grade"""

SEARCH_RESULTS = """SELECT * FROM (VALUES (1, 'mutual_info', 'rf', 1.0, 0.0, 0), (1, 'all', 'ada', 1.0, 0.0, 1),
(1, 'embedded_dt', 'ada', 1.0, 0.0, 2)) AS t(rank, selector, model, mean_cv_score, std_cv_score, config)"""


def planted_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cases with lines; few lines make grade 1, the others are graded by their returns."""
    rule = F.when(F.col("n_lines") <= 3, 1).when(F.col("has_return") == 0, 2).otherwise(3)
    return stage(cases(spark, sf_dir).where("n_lines is not null").withColumn("grade", rule), "planted")


@dataclass(frozen=True)
class Prepared:
    """The raw cases, the preparation learned on the training part, and all parts prepared by it."""

    raw: DataFrame
    preparation: Preparation
    train: DataFrame
    validation: DataFrame
    test: DataFrame

    @property
    def everything(self) -> DataFrame:
        return self.preparation.apply(self.raw)


def voted_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cases with lines, graded by a vote of their lines, returns and bulk lines."""
    vote = F.col("n_lines") + 2 * F.col("has_return") + 3 * F.col("has_bulk")
    graded = cases(spark, sf_dir).where("n_lines is not null").withColumn("grade", F.when(vote >= 5, 2).otherwise(1))
    return stage(graded, "planted")


def prepared_cases(spark: SparkSession, sf_dir: str, rule=planted_cases) -> Prepared:
    raw = rule(spark, sf_dir)
    train, validation, test = split_three(raw, CASES.key, CASES.label)
    preparation, ready = fit_preparation(train, CASES)
    return Prepared(
        raw, preparation, stage(ready, "prepared-train"), stage(preparation.apply(validation), "prepared-validation"),
        stage(preparation.apply(test), "prepared-test"),
    )


def _scores(predicted: DataFrame) -> DataFrame:
    return class_scores(confusion(predicted, CASES.label, "prediction"))


def _calls(predicted: DataFrame) -> DataFrame:
    return predicted.select("case_id", "grade", "prediction")


@query(
    "ml01_fit_clusters",
    f"""WITH {CASES_SQL}
SELECT case_id % 4 AS planted, count(*) AS n, 1 AS clusters, round(avg(abs(o - m)), 6) AS mean_distance
FROM (SELECT case_id, o, avg(o) OVER (PARTITION BY case_id % 4) AS m
      FROM (SELECT case_id, CAST(case_id % 7 AS DOUBLE) AS o FROM case_values))
GROUP BY 1""",
)
def fit_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    group = F.col("case_id") % 4
    rows = cases(spark, sf_dir).select(
        "case_id", group.alias("planted"), (group * 1000 + F.col("case_id") % 7).cast("double").alias("x"), (group * group * 500).cast("double").alias("y")
    )
    rows = stage(rows, "planted-groups")
    found = clustering.fit_clusters(rows, ["x", "y"], 4)
    return (
        found.assign(rows)
        .groupBy("planted")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.countDistinct("cluster").cast("int").alias("clusters"),
            F.round(F.avg("distance"), 6).alias("mean_distance"),
        )
    )


@query(
    "ml03_elbow",
    f"""WITH {CASES_SQL},
sample AS (SELECT case_id % 4 AS g, count(*)::DOUBLE AS n
           FROM (SELECT case_id FROM case_values ORDER BY md5('42|' || case_id) LIMIT 30000) GROUP BY 1),
w AS (SELECT sum(n) FILTER (g = 0) AS a, sum(n) FILTER (g = 1) AS b, sum(n) FILTER (g = 2) AS c, sum(n) FILTER (g = 3) AS d FROM sample)
SELECT CAST(k AS INTEGER) AS k,
       round(CASE k WHEN 2 THEN 100.0 * 100 * a * b / (a + b) + c * d / (c + d) WHEN 3 THEN c * d / (c + d) ELSE 0.0 END, 3) AS inertia
FROM w, range(2, 11) AS ks(k)""",
)
def elbow(spark: SparkSession, sf_dir: str) -> DataFrame:
    # four points: two far pairs, the first pair wider than the second
    place = F.element_at(F.array(*[F.lit(x) for x in (0.0, 100.0, 100_000.0, 100_001.0)]), (F.col("case_id") % 4 + 1).cast("int"))
    rows = cases(spark, sf_dir).select("case_id", place.alias("x"))
    costs = clustering.elbow(stage(rows, "planted-pairs"), ["x"], CASES.key)
    # a sum of squares near zero may come out as a rounding error below it
    return costs.withColumn("inertia", F.round(F.abs("inertia"), 3) + F.lit(0.0))


@query(
    "ml07_forward_selection",
    # once both columns of the rule are in, all scores are 1 and the first columns offered follow
    f"WITH {PLANTED_SQL} SELECT 'SFS' AS method, 20 AS n_kept, true AS has_rule, count(*) AS n FROM planted",
)
def forward_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready = prepared_cases(spark, sf_dir)
    found = selection.Forward(**ENDS).fit(ready.train)
    kept = found.transform(ready.everything)
    n_kept, has_rule = len(kept.columns) - 2, {"n_lines", "has_return"} <= set(kept.columns)
    return kept.agg(
        F.lit(found.method).alias("method"), F.lit(n_kept).alias("n_kept"), F.lit(has_rule).alias("has_rule"), F.count(F.lit(1)).alias("n")
    )


@query("ml08_embedded_selection", "SELECT 'EmbeddedDT' AS method, 'n_lines,has_return' AS kept")
def embedded_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = selection.TreeImportance(**ENDS).fit(prepared_cases(spark, sf_dir).train)
    return found.info(spark).select("method", F.lit(",".join(found.selected)).alias("kept"))


@query("ml11_forest", f"WITH {PLANTED_SQL} {EXACT_SCORES}")
def forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready = prepared_cases(spark, sf_dir)
    return _scores(models.Forest(**ENDS, class_weight="balanced").fit(ready.train).transform(ready.everything))


@query("ml13_boosted_trees", f"WITH {VOTED_SQL} {EXACT_SCORES}")
def boosted_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready = prepared_cases(spark, sf_dir, voted_cases)
    return _scores(models.BoostedTrees(**ENDS, n_estimators=ROUNDS).fit(ready.train).transform(ready.everything))


@query("ml14_tree", EXACT_ROWS)
def tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready = prepared_cases(spark, sf_dir)
    return _calls(models.Tree(**ENDS).fit(ready.train).transform(ready.everything))


def _search(ready: Prepared) -> SelectionSearch:
    return SelectionSearch(trials=TRIALS, parallelism=4).fit(ready.train, CASES.key, CASES.label)


@query("ml16_random_search", SEARCH_RESULTS)
def random_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _search(prepared_cases(spark, sf_dir)).results().drop("params")


@query("io09_search_results", SEARCH_RESULTS)
def search_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = staged_path(spark, "search")
    write_search_results(_search(prepared_cases(spark, sf_dir)).results(), path, with_params=False)
    kinds = "rank int, selector string, model string, mean_cv_score double, std_cv_score double, config int"
    written = spark.read.csv(path, header=True)
    return written.select(*[F.col(c.split()[0]).cast(c.split()[1]) for c in kinds.split(", ")])


@query(
    "ml17_compare_selectors",
    """SELECT * FROM (VALUES ('all', 1.0, 21), ('mutual_info', 1.0, 21), ('relief', 1.0, 21), ('sfs', 1.0, 20), ('embedded_dt', 1.0, 2))
AS t(selector, score, n_features)""",
)
def compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready = prepared_cases(spark, sf_dir)
    config = {name: {} for name in ("all", "mutual_info", "relief", "sfs", "embedded_dt")}
    return compare_selectors(ready.train, ready.validation, config, CASES.key, CASES.label).results


@query("ml18_search_predictions", EXACT_ROWS)
def search_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready = prepared_cases(spark, sf_dir)
    return _calls(_search(ready).predict(ready.everything))


@query("ml19_best_configuration", "SELECT 'mutual_info' AS selector, 'rf' AS model, 1.0 AS score")
def best_configuration(spark: SparkSession, sf_dir: str) -> DataFrame:
    search = _search(prepared_cases(spark, sf_dir))
    best = search.best_trial()
    return spark.createDataFrame([(best.selector, best.model, search.best_score())], "selector string, model string, score double")


def _trained(spark: SparkSession, ready: Prepared, out_dir: str):
    """A final run: boosted stumps on the prepared parts, all raw cases without their grade as the table to submit."""
    return train_final(
        ready.train, ready.validation, CASES, out_dir, ready.test, ready.everything.drop(CASES.label), "ada",
        {"n_estimators": ROUNDS}, ready.preparation,
    )


@query(
    "ml22_final_training",
    """SELECT part, 1.0 AS micro_f1, 1.0 AS macro_f1, 1.0 AS accuracy, 1.0 AS g_mean
FROM (VALUES ('validation'), ('test')) AS t(part)""",
)
def final_training(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = _trained(spark, prepared_cases(spark, sf_dir, voted_cases), staged_path(spark, "run"))
    part = done.validation.summary.withColumn("part", F.lit("validation"))
    return part.unionByName(done.test.summary.withColumn("part", F.lit("test")))


@query("io07_submission", EXACT_SUBMISSION)
def submission(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _trained(spark, prepared_cases(spark, sf_dir, voted_cases), staged_path(spark, "run")).submission


@query(
    "io10_conditional_checkpoint",
    "SELECT * FROM (VALUES (0, 1.0, true), (1, 1.0, false)) AS t(attempt, score, saved)",
)
def conditional_checkpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    out_dir, ready = staged_path(spark, "run"), prepared_cases(spark, sf_dir, voted_cases)
    runs = [_trained(spark, ready, out_dir) for _ in range(2)]
    return spark.createDataFrame(
        [(i, t.validation_score, t.saved) for i, t in enumerate(runs)], "attempt int, score double, saved boolean"
    )


@query("io11_load_checkpoint", f"WITH {VOTED_SQL} {EXACT_SCORES}")
def load_checkpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    out_dir, ready = staged_path(spark, "run"), prepared_cases(spark, sf_dir, voted_cases)
    _trained(spark, ready, out_dir)
    saved = load_best(spark, f"{out_dir}/model", CASES)
    return _scores(saved.model.transform(saved.preparation.apply(ready.raw)))


@query("ml23_predict_only", EXACT_SUBMISSION)
def predict_from_checkpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    out_dir, ready = staged_path(spark, "run"), prepared_cases(spark, sf_dir, voted_cases)
    _trained(spark, ready, out_dir)
    return predict_only(spark, ready.raw.drop(CASES.label), CASES, out_dir)
