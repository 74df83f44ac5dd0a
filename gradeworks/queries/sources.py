"""Readers and writers, each fed by a whole table written and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gradeworks.operators.sampling import with_split
from gradeworks.queries.cleaning import FLAWED, SOUND
from gradeworks.queries.registry import query, rounded
from gradeworks.queries.sampling import SPLIT_SQL
from gradeworks.session import staged_path
from gradeworks.sources.cases import CASES, cases, flawed_cases, table
from gradeworks.sources.readers import open_staged, open_table
from gradeworks.sources.writers import write_stage


@query(
    "io01_format_dispatch",
    """SELECT 'csv' AS kind, count(*) AS n, CAST(sum(c_custkey) AS BIGINT) AS key_sum FROM customer
    UNION ALL SELECT 'txt', count(*), CAST(sum(p_partkey) AS BIGINT) FROM part
    UNION ALL SELECT 'json', count(*), CAST(sum(s_suppkey) AS BIGINT) FROM supplier""",
)
def format_dispatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = []
    for kind, name, key in (("csv", "customer", "c_custkey"), ("txt", "part", "p_partkey"), ("json", "supplier", "s_suppkey")):
        path = f"{staged_path(spark, name)}.{kind}"
        source = table(spark, sf_dir, name)
        source.write.json(path) if kind == "json" else source.write.csv(path, header=True)
        read = open_table(spark, path)
        parts.append(read.agg(F.lit(kind).alias("kind"), F.count(F.lit(1)).alias("n"), F.sum(key).alias("key_sum")))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "io02_delimited_scan",
    FLAWED
    + """SELECT case_id, CAST(region_id AS BIGINT) AS region_id, total_price, balance, n_lines, sum_qty, priority, segment,
    CAST(has_return AS BIGINT) AS has_return, CAST(grade AS BIGINT) AS grade FROM flawed""",
)
def delimited_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{staged_path(spark, 'cases')}.csv"
    # gaps are written both as empty fields and as NaN
    wanted = flawed_cases(spark, sf_dir).select(
        "case_id", "region_id", "total_price", "balance", "n_lines", "sum_qty", "priority", "segment", "has_return", "grade"
    )
    wanted.withColumn("balance", F.coalesce("balance", F.lit(float("nan")))).write.csv(path, header=True)
    return open_table(spark, path)


@query(
    "io03_json_scan",
    SOUND + "SELECT case_id, customer_id, total_price, avg_discount, priority, CAST(grade AS BIGINT) AS grade FROM cases",
)
def json_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{staged_path(spark, 'cases')}.json"
    wanted = cases(spark, sf_dir).select("case_id", "customer_id", "total_price", "avg_discount", "priority", "grade")
    wanted.write.option("ignoreNullFields", False).json(path)
    return open_table(spark, path)


@query(
    "io05_staged_read",
    SOUND + "SELECT grade, count(*) AS n, round(avg(total_price), 6) AS mean_price FROM cases GROUP BY grade",
)
def staged_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = write_stage(cases(spark, sf_dir), staged_path(spark, "cases"))
    staged = open_staged(spark, path, CASES.label)
    return rounded(staged.groupBy("grade").agg(F.count(F.lit(1)).alias("n"), F.avg("total_price").alias("mean_price")))


@query(
    "io06_stage_writes",
    SOUND + "," + SPLIT_SQL + "SELECT split, grade, count(*) AS n, CAST(sum(case_id) AS BIGINT) AS key_sum FROM split_cases GROUP BY split, grade",
)
def stage_writes(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = staged_path(spark, "splits")
    with_split(cases(spark, sf_dir), CASES.key, CASES.label).write.partitionBy("split").parquet(path)
    return (
        open_staged(spark, path, CASES.label)
        .groupBy("split", "grade")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("case_id").alias("key_sum"))
    )
