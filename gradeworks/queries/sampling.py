"""Samples, splits and folds on whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gradeworks.functions.hash_order import find_cuts, segment
from gradeworks.operators import sampling as ops
from gradeworks.queries.cleaning import SOUND
from gradeworks.queries.registry import query, rounded
from gradeworks.sources.cases import CASES, cases, table

MD5 = "md5(concat('42|', CAST(case_id AS VARCHAR)))"


def split_sql(source: str, key: str, label: str, name: str) -> str:
    """Exact stratified split: whole quotas first, the rest to the largest remainders."""
    return f"""
ordered AS (SELECT *, row_number() OVER (PARTITION BY {label}
  ORDER BY md5(concat('42|', CAST({key} AS VARCHAR)))) AS pos FROM {source}),
sizes AS (SELECT {label}, count(*) AS n, sum(count(*)) OVER () AS total FROM {source} GROUP BY {label}),
held AS (SELECT *, CAST(total - ceil(total * 30 / 100.0) AS BIGINT) AS n_train FROM sizes),
train_shares AS (SELECT *, (n * n_train) // total AS whole, (n * n_train) % total AS rest FROM held),
train_sizes AS (SELECT *, whole + CASE WHEN row_number() OVER (ORDER BY rest DESC, {label})
  <= n_train - sum(whole) OVER () THEN 1 ELSE 0 END AS t FROM train_shares),
left_over AS (SELECT *, n - t AS m, total - n_train AS held_out, (total - n_train) // 2 AS n_val FROM train_sizes),
val_shares AS (SELECT *, (m * n_val) // held_out AS whole_v, (m * n_val) % held_out AS rest_v FROM left_over),
split_sizes AS (SELECT {label} AS stratum, t, whole_v + CASE WHEN row_number() OVER (ORDER BY rest_v DESC, {label})
  <= n_val - sum(whole_v) OVER () THEN 1 ELSE 0 END AS v FROM val_shares),
{name} AS (SELECT o.*, CASE WHEN pos <= t THEN 'train' WHEN pos <= t + v THEN 'validation' ELSE 'test' END AS split
  FROM ordered o JOIN split_sizes s ON o.{label} = s.stratum)
"""


SPLIT_SQL = split_sql("cases", "case_id", "grade", "split_cases")
QUOTA_SQL = """
ordered AS (SELECT *, row_number() OVER (PARTITION BY grade ORDER BY {md5}) AS pos FROM cases),
sizes AS (SELECT grade, count(*) AS n, sum(count(*)) OVER () AS total FROM cases GROUP BY grade),
shares AS (SELECT *, CAST(floor(total * {fraction}) AS BIGINT) AS kept FROM sizes),
parts AS (SELECT *, (n * kept) // total AS whole, (n * kept) % total AS rest FROM shares),
quotas AS (SELECT grade, whole + CASE WHEN row_number() OVER (ORDER BY rest DESC, grade)
  <= kept - sum(whole) OVER () THEN 1 ELSE 0 END AS quota FROM parts)
SELECT case_id, o.grade FROM ordered o JOIN quotas q ON o.grade = q.grade WHERE pos <= quota
"""


@query("sm01_stratified_sample", SOUND + "," + QUOTA_SQL.format(md5=MD5, fraction="CAST(0.375 AS DOUBLE)"))
def stratified_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.stratified_sample(cases(spark, sf_dir), CASES.key, CASES.label, 0.375).select("case_id", "grade")


# Half the size of the table is half of its rows.
@query("sm01_reduce_to_size", SOUND + "," + QUOTA_SQL.format(md5=MD5, fraction="CAST(0.5 AS DOUBLE)"))
def reduce_to_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    whole = cases(spark, sf_dir)
    size = ops.table_size(whole).first()["size_mb"]
    return ops.reduce_to_size(whole, CASES, size / 2).select("case_id", "grade")


@query("sm02_stratified_split", SOUND + "," + SPLIT_SQL + "SELECT case_id, split FROM split_cases")
def stratified_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.with_split(cases(spark, sf_dir), CASES.key, CASES.label).select("case_id", "split")


@query(
    "sm03_uniform_sample",
    "SELECT event_id, event_type, value FROM events ORDER BY md5(concat('42|', CAST(event_id AS VARCHAR))) LIMIT 3000",
)
def uniform_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.sample_rows(table(spark, sf_dir, "events").select("event_id", "event_type", "value"), "event_id", 3000)


@query(
    "sm04_anchor_rows",
    "SELECT vec_id, label FROM embeddings ORDER BY md5(concat('7|', CAST(vec_id AS VARCHAR))) LIMIT 50",
)
def anchor_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.sample_rows(table(spark, sf_dir, "embeddings").select("vec_id", "label"), "vec_id", 50, seed=7)


@query(
    "sm05_stratified_folds",
    SOUND
    + f""", numbered AS (SELECT case_id, grade, row_number() OVER (PARTITION BY grade ORDER BY {MD5}) AS pos FROM cases),
    sizes AS (SELECT grade, count(*) AS n FROM cases GROUP BY grade),
    starts AS (SELECT grade, n, sum(n) OVER (ORDER BY grade) - n AS start FROM sizes),
    slots AS (SELECT grade, (start + i) % 5 AS fold, count(*) AS n
      FROM starts, unnest(range(CAST(n AS BIGINT))) AS u(i) GROUP BY ALL),
    ends AS (SELECT grade, fold, sum(n) OVER (PARTITION BY grade ORDER BY fold) AS stop, n FROM slots)
    SELECT case_id, CAST(fold AS INTEGER) AS fold FROM numbered JOIN ends
      ON numbered.grade = ends.grade AND pos <= stop AND pos > stop - n""",
)
def stratified_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.with_stratified_folds(cases(spark, sf_dir), CASES.key, CASES.label, 5).select("case_id", "fold")


@query(
    "wf04_quota_per_stratum",
    """WITH ordered AS (SELECT event_id, event_type,
      row_number() OVER (PARTITION BY event_type ORDER BY md5(concat('42|', CAST(event_id AS VARCHAR)))) AS pos FROM events)
    SELECT event_id, event_type FROM ordered WHERE pos <= 250""",
)
def quota_per_stratum(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "event_type")
    cuts = find_cuts(events, "event_id", lambda counts: {s: [250] for s in counts}, by="event_type")
    return events.where(segment(cuts, "event_id", by="event_type") == 0)


@query(
    "ag04_table_size",
    """SELECT count(*) AS n_rows, round(sum(8 + 4 + CASE WHEN value IS NULL THEN 0 ELSE 8 END
      + coalesce(octet_length(encode(event_type)), 0) + coalesce(octet_length(encode(props)), 0)) / 1048576.0, 6) AS size_mb
    FROM (SELECT event_id, CAST(user_id AS INTEGER) AS user_id, value, event_type, props FROM events)""",
)
def table_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select(
        "event_id", F.col("user_id").cast("int").alias("user_id"), "value", "event_type", "props"
    )
    return rounded(ops.table_size(events))
