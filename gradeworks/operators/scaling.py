"""Linear scaling with statistics learned on the training table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Moments = Mapping[str, tuple[float, float]]


def fit_standard(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """``{column: (mean, population deviation)}``; a constant column gets deviation 1."""
    present = [c for c in columns if c in df.columns]
    if not present:
        return {}
    row = df.agg(
        *[F.avg(c).alias(f"avg_{c}") for c in present],
        *[F.stddev_pop(c).alias(f"std_{c}") for c in present],
    ).first()
    return {c: (row[f"avg_{c}"], row[f"std_{c}"] or 1.0) for c in present if row[f"avg_{c}"] is not None}


def standardize(df: DataFrame, moments: Moments) -> DataFrame:
    return df.withColumns({c: (F.col(c) - m) / s for c, (m, s) in moments.items() if c in df.columns})


def fit_min_range(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """``{column: (minimum, range)}``; a constant column gets range 1, one without values is left out."""
    row = df.agg(
        *[F.min(F.col(f"`{c}`")).cast("double").alias(f"lo_{i}") for i, c in enumerate(columns)],
        *[F.max(F.col(f"`{c}`")).cast("double").alias(f"hi_{i}") for i, c in enumerate(columns)],
    ).first()
    return {c: (row[f"lo_{i}"], (row[f"hi_{i}"] - row[f"lo_{i}"]) or 1.0) for i, c in enumerate(columns) if row[f"lo_{i}"] is not None}


def min_max(column: str, lowest: float, spread: float) -> Column:
    return (F.col(f"`{column}`").cast("double") - F.lit(lowest)) / F.lit(spread)


def rescale(df: DataFrame, ranges: Mapping[str, tuple[float, float]]) -> DataFrame:
    return df.withColumns({c: min_max(c, lo, spread) for c, (lo, spread) in ranges.items()})
