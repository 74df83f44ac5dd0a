"""The case table: one row per order, shaped like the building survey.

Region, nation and customer give three geographic levels; order, customer and
line columns give continuous, categorical and 0/1 features; the order status is the
grade. Flaws the cleaning steps must find are planted by arithmetic on the order key,
the same way in the DataFrame and in the SQL text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gradeworks.session import stage
from gradeworks.spec import Range, TableSpec

CASES = TableSpec(
    key="case_id",
    label="grade",
    classes=(1, 2, 3),
    continuous=("total_price", "balance", "n_lines", "sum_qty", "avg_discount"),
    ranges={
        "total_price": Range(0, None, low_inclusive=False),
        "balance": Range(-1000, 10000),
        "n_lines": Range(0, 50, low_inclusive=False),
        "sum_qty": Range(0, None),
        "avg_discount": Range(0, 1),
    },
    geo={"region_id": (0, 4), "nation_id": (0, 24), "customer_id": (0, 10**15)},
    domains={
        "priority": ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"),
        "segment": ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"),
    },
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(
            F.count(F.lit(1)).alias("n_lines"),
            F.sum("l_quantity").alias("sum_qty"),
            F.round(F.avg("l_discount"), 6).alias("avg_discount"),
            F.max((F.col("l_returnflag") == "R").cast("int")).alias("has_return"),
            F.max((F.col("l_linestatus") == "O").cast("int")).alias("has_open"),
            F.max((F.col("l_quantity") >= 45).cast("int")).alias("has_bulk"),
        )
    )


def case_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sound features of every order; no label and no flaw."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    return (
        orders.join(_order_lines(spark, sf_dir), F.col("o_orderkey") == F.col("l_orderkey"), "left")
        .join(customers, F.col("o_custkey") == F.col("c_custkey"), "left")
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .select(
            F.col("o_orderkey").alias("case_id"),
            F.col("n_regionkey").alias("region_id"),
            F.col("c_nationkey").alias("nation_id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("o_totalprice").alias("total_price"),
            F.col("c_acctbal").alias("balance"),
            "n_lines",
            "sum_qty",
            "avg_discount",
            F.col("o_orderpriority").alias("priority"),
            F.col("c_mktsegment").alias("segment"),
            "has_return",
            "has_open",
            "has_bulk",
        )
    )


def case_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.col("o_orderstatus")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("case_id"),
        F.when(status == "F", 1).when(status == "O", 2).when(status == "P", 3).alias("grade"),
    )


def cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features and grade joined on the key."""
    return case_values(spark, sf_dir).join(case_labels(spark, sf_dir), "case_id", "inner")


def _every(n: int) -> Column:
    return F.col("case_id") % n == 0


def flawed_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The case table with planted gaps, impossible values, a sparse column and copies."""
    sound = cases(spark, sf_dir)
    gap = F.lit(None)

    def broken(column: str, *rules: tuple[int, Column]) -> Column:
        out = F.when(_every(83), gap) if column not in ("grade", "region_id", "nation_id") else None
        for n, value in rules:
            out = F.when(_every(n), value) if out is None else out.when(_every(n), value)
        return out.otherwise(F.col(column)).alias(column)

    flawed = sound.select(
        "case_id",
        broken("region_id", (73, gap)),
        broken("nation_id", (79, F.lit(99))),
        "customer_id",
        broken("total_price", (17, gap), (29, -F.col("total_price"))),
        broken("balance", (19, gap), (37, F.col("balance") + 100000)),
        broken("n_lines", (41, F.lit(99))),
        broken("sum_qty", (43, F.lit(-5.0))),
        broken("avg_discount", (13, gap)),
        broken("priority", (23, F.lit("0-NONE")), (47, gap)),
        broken("segment", (53, F.lit("?")), (59, gap)),
        broken("has_return", (61, F.lit(7)), (67, gap)),
        broken("has_open"),
        broken("has_bulk"),
        F.when(_every(3), F.col("total_price")).alias("rare_note"),
        broken("grade", (71, gap)),
    )
    copies = F.when(_every(31), F.array(F.col("case_id"), -1 - F.col("case_id"))).otherwise(F.array("case_id"))
    return flawed.withColumn("case_id", F.explode(copies))


def stored_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flawed case table written once, as a run reads it: for work that scans it more than once.

    Its columns are then plain attributes. A filter over many computed columns, pushed
    into their definitions, would cost the optimizer far more than the write.
    """
    return stage(flawed_cases(spark, sf_dir), "cases")


# The same tables as SQL common table expressions.
CASES_SQL = """
lines AS (
  SELECT l_orderkey, count(*) AS n_lines, sum(l_quantity) AS sum_qty,
         round(avg(l_discount), 6) AS avg_discount,
         max(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS has_return,
         max(CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END) AS has_open,
         max(CASE WHEN l_quantity >= 45 THEN 1 ELSE 0 END) AS has_bulk
  FROM lineitem GROUP BY l_orderkey),
case_values AS (
  SELECT o_orderkey AS case_id, n_regionkey AS region_id, c_nationkey AS nation_id,
         o_custkey AS customer_id, o_totalprice AS total_price, c_acctbal AS balance,
         n_lines, sum_qty, avg_discount, o_orderpriority AS priority, c_mktsegment AS segment,
         has_return, has_open, has_bulk
  FROM orders LEFT JOIN lines ON o_orderkey = l_orderkey
  LEFT JOIN customer ON o_custkey = c_custkey
  LEFT JOIN nation ON c_nationkey = n_nationkey),
case_labels AS (
  SELECT o_orderkey AS case_id,
         CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 WHEN 'P' THEN 3 END AS grade
  FROM orders),
cases AS (SELECT v.*, grade FROM case_values v JOIN case_labels l ON v.case_id = l.case_id)
"""

FLAWED_SQL = (
    CASES_SQL
    + """,
flawed_once AS (
  SELECT case_id,
    CASE WHEN case_id % 73 = 0 THEN NULL ELSE region_id END AS region_id,
    CASE WHEN case_id % 79 = 0 THEN 99 ELSE nation_id END AS nation_id,
    customer_id,
    CASE WHEN case_id % 83 = 0 OR case_id % 17 = 0 THEN NULL WHEN case_id % 29 = 0 THEN -total_price
         ELSE total_price END AS total_price,
    CASE WHEN case_id % 83 = 0 OR case_id % 19 = 0 THEN NULL WHEN case_id % 37 = 0 THEN balance + 100000
         ELSE balance END AS balance,
    CASE WHEN case_id % 83 = 0 THEN NULL WHEN case_id % 41 = 0 THEN 99 ELSE n_lines END AS n_lines,
    CASE WHEN case_id % 83 = 0 THEN NULL WHEN case_id % 43 = 0 THEN -5.0::DOUBLE ELSE sum_qty END AS sum_qty,
    CASE WHEN case_id % 83 = 0 OR case_id % 13 = 0 THEN NULL ELSE avg_discount END AS avg_discount,
    CASE WHEN case_id % 83 = 0 THEN NULL WHEN case_id % 23 = 0 THEN '0-NONE' WHEN case_id % 47 = 0 THEN NULL
         ELSE priority END AS priority,
    CASE WHEN case_id % 83 = 0 THEN NULL WHEN case_id % 53 = 0 THEN '?' WHEN case_id % 59 = 0 THEN NULL
         ELSE segment END AS segment,
    CASE WHEN case_id % 83 = 0 THEN NULL WHEN case_id % 61 = 0 THEN 7 WHEN case_id % 67 = 0 THEN NULL
         ELSE has_return END AS has_return,
    CASE WHEN case_id % 83 = 0 THEN NULL ELSE has_open END AS has_open,
    CASE WHEN case_id % 83 = 0 THEN NULL ELSE has_bulk END AS has_bulk,
    CASE WHEN case_id % 3 = 0 THEN total_price END AS rare_note,
    CASE WHEN case_id % 71 = 0 THEN NULL ELSE grade END AS grade
  FROM cases),
flawed AS (
  SELECT * FROM flawed_once
  UNION ALL
  SELECT * REPLACE (-1 - case_id AS case_id) FROM flawed_once WHERE case_id % 31 = 0)
"""
)
