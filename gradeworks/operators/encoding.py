"""One-hot columns and alignment to a learned list of columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradeworks.operators.imputation import value_counts
from gradeworks.spec import TableSpec


def learn_levels(df: DataFrame, spec: TableSpec, max_levels: int = 10_000) -> dict[str, list[str]]:
    """Sorted values present per listed categorical column, found in one scan.

    Every level becomes a column, so a table with more than ``max_levels`` has an identifier
    among its categories; that raises.
    """
    columns = [c for c in spec.domains if c in df.columns]
    levels: dict[str, list[str]] = {c: [] for c in columns}
    if columns:
        found = value_counts(df, columns).limit(max_levels + 1).collect()
        if len(found) > max_levels:
            raise ValueError(f"more than {max_levels} levels in {columns}")
        for row in found:
            levels[row["column"]].append(row["value"])
    return {c: sorted(v) for c, v in levels.items()}


def one_hot(df: DataFrame, levels: Mapping[str, Sequence[str]]) -> DataFrame:
    """Replace each column by 0/1 columns ``column_value``, one per level; null gives zeros."""
    present = {c: v for c, v in levels.items() if c in df.columns}
    dummies = [
        F.coalesce((F.col(f"`{c}`") == F.lit(v)).cast("int"), F.lit(0)).alias(f"{c}_{v}")
        for c, values in present.items()
        for v in values
    ]
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c not in present], *dummies)


def align(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Exactly the learned columns in their order: missing ones are 0, others go."""
    kept = [F.col(f"`{c}`") for c in keep if c in df.columns]
    present = set(df.columns)
    return df.select(
        *kept,
        *[F.col(f"`{c}`") if c in present else F.lit(0).alias(c) for c in columns if c not in keep],
    )
