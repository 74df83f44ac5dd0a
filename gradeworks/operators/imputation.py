"""Fill values learned on the training table: medians, and most frequent values."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradeworks.functions.order_stats import exact_quantiles
from gradeworks.operators.learner import in_parallel
from gradeworks.spec import TableSpec


@dataclass(frozen=True)
class FillValues:
    medians: Mapping[str, float]
    modes: Mapping[str, object]
    levels: Mapping[str, list[str]]


def value_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """``(column, value, n)`` over all given columns, values as text, nulls left out."""
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value")) for c in columns]
    )
    return (
        df.select(F.inline(pairs))
        .where(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def smallest_on_tie() -> Column:
    """Sort key of the most frequent value: count first, then the smaller number or text."""
    return F.struct(-F.col("n"), F.expr("try_cast(value AS double)"), F.col("value"))


def modes(df: DataFrame, columns: list[str]) -> DataFrame:
    """``(column, value, n)`` of the most frequent value per column."""
    return (
        value_counts(df, columns)
        .groupBy("column")
        .agg(F.min_by("value", smallest_on_tie()).alias("value"), F.max("n").alias("n"))
    )


def fit_fill_values(df: DataFrame, spec: TableSpec) -> FillValues:
    """Medians and modes by column role, and the allowed levels each listed category has."""
    roles = spec.roles(df)
    columns = list(roles.binary + roles.categorical)
    listed = [c for c in spec.domains if c in columns]
    # a category gives back at most its listed domain, never an unbounded set of values
    level = F.lit(None).cast("string")
    for c in listed:
        allowed = (F.col("column") == c) & F.col("value").isin(*spec.domains[c])
        level = F.when(allowed, F.col("value")).otherwise(level)

    def frequent_values():
        if not columns:
            return []
        most = F.min_by("value", smallest_on_tie()).alias("mode")
        return value_counts(df, columns).groupBy("column").agg(most, F.collect_set(level).alias("levels")).collect()

    medians, frequent = in_parallel([lambda: exact_quantiles(df, list(roles.continuous), [0.5]), frequent_values], 2)
    modes_ = {r["column"]: int(float(r["mode"])) if r["column"] in roles.binary else r["mode"] for r in frequent}
    levels = {r["column"]: sorted(r["levels"]) for r in frequent}
    return FillValues(
        medians={c: medians[None, c][0] for c in roles.continuous if (None, c) in medians},
        modes=modes_,
        levels={c: levels.get(c, []) for c in listed},
    )


def fill(df: DataFrame, values: FillValues) -> DataFrame:
    """Replace nulls by the learned values; continuous columns become doubles."""
    filled = {
        c: F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(float(v)))
        for c, v in values.medians.items()
        if c in df.columns
    }
    filled |= {c: F.coalesce(F.col(f"`{c}`"), F.lit(v)) for c, v in values.modes.items() if c in df.columns}
    return df.withColumns(filled)
