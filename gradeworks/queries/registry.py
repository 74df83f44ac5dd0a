"""Registry of queries and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def rounded(df: DataFrame, columns: Sequence[str] | None = None, digits: int = 6) -> DataFrame:
    """Round doubles, so that sums added up in another order compare equal."""
    columns = columns or [c for c, t in df.dtypes if t == "double"]
    # adding zero turns a negative zero into a plain one
    return df.withColumns({c: F.round(F.col(f"`{c}`"), digits) + F.lit(0.0) for c in columns})


def long_rows(name: str, df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``(tab, item, metric, value)``: one row per cell of a result table, its keys joined to one text."""
    values = [c for c in df.columns if c not in keys]
    cells = F.array(*[F.struct(F.lit(c).alias("metric"), F.col(f"`{c}`").cast("double").alias("value")) for c in values])
    item = F.concat_ws("|", *[F.col(f"`{k}`").cast("string") for k in keys])
    return df.select(F.lit(name).alias("tab"), item.alias("item"), F.inline(cells))


def long_sql(name: str, sql: str, keys: Sequence[str], values: Sequence[str]) -> str:
    """SQL of the same rows from the table's SQL."""
    item = "concat_ws('|', " + ", ".join([*(f"CAST({k} AS VARCHAR)" for k in keys), "NULL"]) + ")"
    return " UNION ALL ".join(
        f"""SELECT '{name}' AS tab, {item} AS item, '{v}' AS metric, round(CAST("{v}" AS DOUBLE), 6) AS value FROM ({sql}) AS t"""
        for v in values
    )
