"""Checks of inputs, column roles, and the places where a caller adds functions of their own."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gradeworks.operators.evaluation import check_predictions
from gradeworks.operators.selection import MutualInfo
from gradeworks.queries.cleaning import FLAWED, SOUND
from gradeworks.queries.evaluation import PREDICTED, predictions
from gradeworks.queries.registry import query, rounded
from gradeworks.session import stage, staged_path
from gradeworks.sources.cases import CASES, cases, stored_cases, table
from gradeworks.sources.readers import READERS, open_table

BINARY = ("has_return", "has_open", "has_bulk")


@query(
    "io04_guarded_open",
    """SELECT 'present' AS source, 'read' AS outcome, count(*) AS n FROM customer
    UNION ALL SELECT * FROM (VALUES ('absent', 'FileNotFoundError', NULL::BIGINT), ('torn', 'RuntimeError', NULL), ('unknown', 'ValueError', NULL))""",
)
def guarded_open(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sound file, a path without a file, records cut off before their end, and an unknown file type."""
    customers, path = table(spark, sf_dir, "customer"), staged_path(spark, "guarded")
    record = F.to_json(F.struct(*customers.columns))
    customers.write.csv(f"{path}.csv", header=True)
    customers.select(F.left(record, F.length(record) - 1)).write.text(f"{path}.json")
    found = []
    for source, place in (("present", ".csv"), ("absent", "-none.csv"), ("torn", ".json"), ("unknown", ".xls")):
        try:
            found.append((source, "read", open_table(spark, path + place).count()))
        except (FileNotFoundError, RuntimeError, ValueError) as error:
            found.append((source, type(error).__name__, None))
    return spark.createDataFrame(found, "source string, outcome string, n bigint")


FEATURES = (*CASES.geo, *CASES.continuous, *CASES.domains, *BINARY, "rare_note")


@query(
    "pf14_column_roles",
    FLAWED
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, CASE WHEN starts_with('{c}', 'has_') THEN 'binary' WHEN any_value(typeof({c})) = 'VARCHAR'
        THEN 'categorical' ELSE 'continuous' END AS role, count({c}) AS n_values FROM flawed"""
        for c in FEATURES
    ),
)
def column_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each feature's role, and how many values it holds."""
    rows = stored_cases(spark, sf_dir)
    roles = CASES.roles(rows)
    role_of = {c: role for role in ("continuous", "binary", "categorical") for c in getattr(roles, role)}
    counts = rows.agg(*[F.count(c).alias(c) for c in role_of]).first()
    return spark.createDataFrame([(c, r, counts[c]) for c, r in role_of.items()], "column_name string, role string, n_values bigint")


@query(
    "ml26_evaluator_checks",
    PREDICTED
    + """SELECT 'sound' AS flaw, 'classes ' || string_agg(DISTINCT grade::VARCHAR, ',' ORDER BY grade::VARCHAR) AS outcome FROM predicted
    UNION ALL SELECT 'gaps', count(*) || ' rows lack a true or a predicted class' FROM predicted WHERE case_id % 50 = 0
    UNION ALL SELECT 'short scores', 'the score column must hold one score per class in every row'
    UNION ALL SELECT 'names', '2 class names given for ' || count(DISTINCT grade) || ' classes' FROM predicted""",
)
def evaluator_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the evaluator says of sound predictions, and of three kinds of flaws."""
    sound, some = stage(predictions(spark, sf_dir), "predictions"), F.col("case_id") % 50 == 0
    gaps = sound.withColumn("called", F.when(~some, F.col("called")))
    short = sound.withColumn("scores", F.when(some, F.slice("scores", 1, 2)).otherwise(F.col("scores")))
    found = []
    for flaw, rows, names in (("sound", sound, None), ("gaps", gaps, None), ("short scores", short, None), ("names", sound, ["low", "high"])):
        try:
            classes = check_predictions(rows, "grade", "called", "scores", names)
            found.append((flaw, "classes " + ",".join(map(str, classes))))
        except ValueError as error:
            found.append((flaw, str(error)))
    return spark.createDataFrame(found, "flaw string, outcome string")


def by_covariance(df: DataFrame, features: list[str], label: str) -> DataFrame:
    """A caller's score: how far a feature moves with the label, in one scan of all features."""
    found = df.agg(*[F.abs(F.covar_pop(F.col(c).cast("double"), F.col(label).cast("double"))).alias(c) for c in features])
    cells = F.array(*[F.struct(F.lit(c).alias("feature"), F.lit(i).alias("ordinal"), F.col(c).alias("score")) for i, c in enumerate(features)])
    return found.select(F.inline(cells))


SCORED = (*CASES.continuous, *BINARY)


@query(
    "ext1_caller_scores",
    SOUND
    + "SELECT string_agg(feature, ',' ORDER BY ordinal) AS kept FROM (SELECT * FROM ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {i} AS ordinal, abs(covar_pop({c}::DOUBLE, grade::DOUBLE)) AS score FROM cases" for i, c in enumerate(SCORED)
    )
    + ") ORDER BY score DESC LIMIT 3)",
)
def caller_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three best features by a score function that the caller gives."""
    rows = cases(spark, sf_dir).select(CASES.key, *SCORED, CASES.label)
    found = MutualInfo(keyCol=CASES.key, labelCol=CASES.label, k=3, scores=by_covariance).fit(rows)
    return spark.createDataFrame([(",".join(found.selected),)], "kept string")


def read_piped(spark: SparkSession, path: str, schema=None) -> DataFrame:
    return spark.read.csv(path, sep="|", header=True, schema=schema, inferSchema=schema is None)


@query(
    "ext3_caller_reader",
    "SELECT CAST(s_nationkey AS INTEGER) AS s_nationkey, count(*) AS n, round(sum(s_acctbal), 2) AS balance FROM supplier GROUP BY s_nationkey",
)
def caller_reader(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file type that only the caller's reader knows, opened by its extension."""
    path = f"{staged_path(spark, 'suppliers')}.psv"
    table(spark, sf_dir, "supplier").write.csv(path, sep="|", header=True)
    READERS[".psv"] = read_piped
    try:
        suppliers = open_table(spark, path)
    finally:
        del READERS[".psv"]
    return rounded(suppliers.groupBy("s_nationkey").agg(F.count(F.lit(1)).alias("n"), F.sum("s_acctbal").alias("balance")), ["balance"], 2)
