"""Projections, filters and cleaning on the case table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gradeworks.operators import cleaning as ops
from gradeworks.operators.encoding import align
from gradeworks.queries.registry import query
from gradeworks.sources.cases import CASES, CASES_SQL, FLAWED_SQL, case_labels, case_values, cases, flawed_cases, stored_cases

SOUND = "WITH " + CASES_SQL
FLAWED = "WITH " + FLAWED_SQL

# Planted out-of-range values become null; what is left is the cleaned value.
RANGED = """
  CASE WHEN total_price > 0 THEN total_price END AS total_price,
  CASE WHEN balance BETWEEN -1000 AND 10000 THEN balance END AS balance,
  CASE WHEN n_lines > 0 AND n_lines <= 50 THEN n_lines END AS n_lines,
  CASE WHEN sum_qty >= 0 THEN sum_qty END AS sum_qty,
  CASE WHEN avg_discount BETWEEN 0 AND 1 THEN avg_discount END AS avg_discount"""
CONTENT = """region_id, nation_id, customer_id, total_price, balance, n_lines, sum_qty, avg_discount,
  priority, segment, has_return, has_open, has_bulk"""
PRIORITIES = "('1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW')"
SEGMENTS = "('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY')"
IN_DOMAIN = f"""
  (priority IS NULL OR priority IN {PRIORITIES}) AND (segment IS NULL OR segment IN {SEGMENTS})
  AND (has_return IS NULL OR has_return IN (0, 1)) AND (has_open IS NULL OR has_open IN (0, 1))
  AND (has_bulk IS NULL OR has_bulk IN (0, 1))
  AND region_id BETWEEN 0 AND 4 AND nation_id BETWEEN 0 AND 24 AND customer_id BETWEEN 0 AND 1000000000000000"""
# Fifteen columns besides the key, so at least int(15 * 0.7) = 10 values per row.
VALUES_PER_ROW = " + ".join(
    f"({c} IS NOT NULL)::INT"
    for c in (
        "region_id nation_id customer_id total_price balance n_lines sum_qty avg_discount "
        "priority segment has_return has_open has_bulk rare_note grade"
    ).split()
)
# Steps of the training clean-up as further table expressions.
CLEAN_SQL = f"""
filled_rows AS (SELECT * EXCLUDE (rare_note) FROM flawed WHERE {VALUES_PER_ROW} >= 10),
unique_rows AS (SELECT min(case_id) AS case_id, {CONTENT}, grade FROM filled_rows GROUP BY ALL),
ranged AS (SELECT case_id, region_id, nation_id, customer_id, {RANGED}, priority, segment,
  has_return, has_open, has_bulk, grade FROM unique_rows),
cleaned AS (SELECT * FROM ranged WHERE grade IS NOT NULL AND {IN_DOMAIN})
"""


@query("pf01_drop_columns", SOUND + "SELECT case_id, region_id, nation_id, customer_id, total_price, priority, segment FROM cases")
def drop_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    unwanted = ["balance", "n_lines", "sum_qty", "avg_discount", "has_return", "has_open", "has_bulk", "not_there"]
    return cases(spark, sf_dir).drop(*unwanted, CASES.label)


@query("pf02_column_subset", SOUND + "SELECT case_id, total_price, n_lines, has_bulk, grade FROM cases")
def column_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.select_columns(cases(spark, sf_dir), CASES, ["total_price", "n_lines", "has_bulk"])


@query(
    "pf03_align_schema",
    SOUND + "SELECT case_id, n_lines, 0 AS has_missing, total_price, 0 AS priority_9 FROM case_values",
)
def align_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    learned = ["n_lines", "has_missing", "total_price", "priority_9"]
    return align(case_values(spark, sf_dir), learned, keep=[CASES.key])


@query("pf04_key_first", SOUND + "SELECT case_id, segment, balance FROM case_values")
def key_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.select_columns(case_values(spark, sf_dir), CASES, ["segment", "balance"])


@query("pf05_drop_learned_columns", FLAWED + f"SELECT case_id, {CONTENT}, grade FROM flawed")
def drop_learned_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = stored_cases(spark, sf_dir)
    return ops.drop_learned(table, ops.sparse_columns(table, CASES))


@query("pf06_drop_unlabelled", FLAWED + "SELECT case_id, grade FROM flawed WHERE grade IS NOT NULL")
def drop_unlabelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.drop_unlabelled(flawed_cases(spark, sf_dir), CASES).select("case_id", "grade")


@query("pf07_nullify_out_of_range", FLAWED + f"SELECT case_id, {RANGED} FROM flawed")
def nullify_out_of_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.nullify_out_of_range(flawed_cases(spark, sf_dir), CASES).select("case_id", *CASES.continuous)


@query("pf08_keep_in_domain", FLAWED + f"SELECT case_id, {CONTENT} FROM flawed WHERE {IN_DOMAIN}")
def keep_in_domain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.keep_in_domain(flawed_cases(spark, sf_dir), CASES).drop("rare_note", "grade")


NULLIFIED = f"""
  CASE WHEN priority IN {PRIORITIES} THEN priority END AS priority,
  CASE WHEN segment IN {SEGMENTS} THEN segment END AS segment,
  CASE WHEN has_return IN (0, 1) THEN has_return END AS has_return,
  CASE WHEN has_open IN (0, 1) THEN has_open END AS has_open,
  CASE WHEN has_bulk IN (0, 1) THEN has_bulk END AS has_bulk"""


@query("pf09_nullify_out_of_domain", FLAWED + f"SELECT case_id, region_id, nation_id, {NULLIFIED} FROM flawed")
def nullify_out_of_domain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.nullify_out_of_domain(flawed_cases(spark, sf_dir), CASES).select(
        "case_id", "region_id", "nation_id", "priority", "segment", "has_return", "has_open", "has_bulk"
    )


@query("pf10_drop_sparse_rows", FLAWED + f"SELECT case_id, grade FROM flawed WHERE {VALUES_PER_ROW} >= 10")
def drop_sparse_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.drop_sparse_rows(flawed_cases(spark, sf_dir), CASES).select("case_id", "grade")


@query(
    "pf11_sparse_columns",
    FLAWED
    + ", counts AS (SELECT count(*) AS n_rows, "
    + ", ".join(
        f"count(*) FILTER (WHERE {c} IS NULL) AS {c}"
        for c in (*(x.strip() for x in CONTENT.split(",")), "rare_note", "grade")
    )
    + " FROM flawed), long AS (UNPIVOT counts ON COLUMNS(* EXCLUDE (n_rows)) INTO NAME column_name VALUE n_null)"
    + " SELECT column_name AS dropped FROM long WHERE n_null > n_rows * 0.4",
)
def sparse_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ops.sparse_columns(flawed_cases(spark, sf_dir), CASES)
    return spark.createDataFrame([(c,) for c in found], "dropped string")


@query(
    "pf15_cast_double",
    SOUND + "SELECT case_id, n_lines::DOUBLE AS n_lines, has_return::DOUBLE AS has_return, region_id::DOUBLE AS region_id FROM cases",
)
def cast_double(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = ["n_lines", "has_return", "region_id"]
    return ops.as_double(cases(spark, sf_dir).select("case_id", *wanted), wanted)


@query("j01_join_labels", SOUND + "SELECT * FROM cases")
def join_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return case_values(spark, sf_dir).join(case_labels(spark, sf_dir), CASES.key, "inner")


@query("ag01_distinct_rows", FLAWED + f"SELECT min(case_id) AS case_id, {CONTENT}, rare_note, grade FROM flawed GROUP BY ALL")
def distinct_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.distinct_rows(flawed_cases(spark, sf_dir), CASES)


@query(
    "ag05_total_nulls",
    FLAWED + f"SELECT CAST(sum(16 - 1 - ({VALUES_PER_ROW})) AS BIGINT) AS n_nulls FROM flawed",
)
def total_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.total_nulls(flawed_cases(spark, sf_dir))


VIOLATIONS = {
    "total_price": "total_price <= 0",
    "balance": "balance < -1000 OR balance > 10000",
    "n_lines": "n_lines <= 0 OR n_lines > 50",
    "sum_qty": "sum_qty < 0",
    "avg_discount": "avg_discount < 0 OR avg_discount > 1",
    "priority": f"priority NOT IN {PRIORITIES}",
    "segment": f"segment NOT IN {SEGMENTS}",
    "has_return": "has_return NOT IN (0, 1)",
    "has_open": "has_open NOT IN (0, 1)",
    "has_bulk": "has_bulk NOT IN (0, 1)",
}


@query(
    "ag06_violation_counts",
    FLAWED
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {rule}) AS n_violations FROM flawed"
        for c, rule in VIOLATIONS.items()
    ),
)
def violation_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = stored_cases(spark, sf_dir)
    counts = ops.count_out_of_range(table, CASES).unionByName(ops.count_out_of_domain(table, CASES))
    return counts.withColumnRenamed("column", "column_name")


@query("ml21_cleaning_sequence", FLAWED + "," + CLEAN_SQL + "SELECT * FROM cleaned")
def cleaning_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = ops.drop_sparse_rows(stored_cases(spark, sf_dir), CASES)
    return ops.clean_training(table.drop("rare_note"), CASES)


@query(
    "sf08_scalar_functions",
    SOUND
    + """SELECT case_id, abs(balance) AS magnitude, round(sqrt(total_price), 6) AS root, round(balance, 1) AS tenths,
      round(CASE WHEN n_lines = 4 THEN NULL ELSE sum_qty / (n_lines - 4) END, 6) AS per_line,
      segment IN ('BUILDING', 'MACHINERY') AS listed, total_price BETWEEN 100000 AND 200000 AS middling,
      n_lines IS NULL AS no_lines, n_lines IS NOT NULL AS any_lines FROM cases""",
)
def scalar_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cases(spark, sf_dir).select(
        "case_id",
        F.abs("balance").alias("magnitude"),
        F.round(F.sqrt("total_price"), 6).alias("root"),
        F.round("balance", 1).alias("tenths"),
        F.round(F.try_divide(F.col("sum_qty"), F.col("n_lines") - 4), 6).alias("per_line"),
        F.col("segment").isin("BUILDING", "MACHINERY").alias("listed"),
        F.col("total_price").between(100000, 200000).alias("middling"),
        F.col("n_lines").isNull().alias("no_lines"),
        F.col("n_lines").isNotNull().alias("any_lines"),
    )
