"""Row and column cleaning: ranges, domains, missing values, repeated rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradeworks.spec import Range, TableSpec


def out_of_range(column: str, allowed: Range) -> Column:
    value = F.col(column)
    checks = []
    if allowed.low is not None:
        checks.append(value < allowed.low if allowed.low_inclusive else value <= allowed.low)
    if allowed.high is not None:
        checks.append(value > allowed.high)
    return reduce(lambda a, b: a | b, checks, F.lit(False))


def _present_ranges(df: DataFrame, spec: TableSpec) -> dict[str, Range]:
    return {c: r for c, r in spec.ranges.items() if c in df.columns}


def nullify_out_of_range(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Values outside their allowed range become null; no row is removed."""
    return df.withColumns(
        {c: F.when(~out_of_range(c, r), F.col(c)) for c, r in _present_ranges(df, spec).items()}
    )


def count_out_of_range(df: DataFrame, spec: TableSpec) -> DataFrame:
    """``(column, n_violations)`` per range rule, in one scan."""
    rules = _present_ranges(df, spec)
    return _one_row_to_long(
        df.agg(*[F.count_if(out_of_range(c, r)).alias(c) for c, r in rules.items()]),
        list(rules),
        "n_violations",
    )


def out_of_domain(column: str, allowed: tuple) -> Column:
    return ~F.col(column).isin(*allowed)


def keep_in_domain(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Training rows whose listed values are allowed or null and whose geo ids are in range.

    A null geo id fails its range check, so such a row goes.
    """
    checks = [F.col(c).isNull() | ~out_of_domain(c, v) for c, v in spec.domain_of(df).items()]
    checks += [F.col(c).between(*spec.geo[c]) for c in spec.geo_columns(df)]
    return df.where(reduce(lambda a, b: a & b, checks, F.lit(True)))


def nullify_out_of_domain(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Values outside their domain become null; every row stays and geo ids are left alone."""
    return df.withColumns({c: F.when(F.col(c).isin(*v), F.col(c)) for c, v in spec.domain_of(df).items()})


def count_out_of_domain(df: DataFrame, spec: TableSpec) -> DataFrame:
    domains = spec.domain_of(df)
    return _one_row_to_long(
        df.agg(*[F.count_if(out_of_domain(c, v)).alias(c) for c, v in domains.items()]),
        list(domains),
        "n_violations",
    )


def drop_unlabelled(df: DataFrame, spec: TableSpec) -> DataFrame:
    return df.dropna(subset=[spec.label]) if spec.label in df.columns else df


def drop_sparse_rows(df: DataFrame, spec: TableSpec, max_null: float = 0.30) -> DataFrame:
    """Keep rows with at least ``int(columns * (1 - max_null))`` values, the key not counted."""
    columns = [c for c in df.columns if c != spec.key]
    return df.dropna(thresh=int(len(columns) * (1 - max_null)), subset=columns)


def null_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row: ``n_rows`` and, per column, its number of nulls."""
    columns = columns or df.columns
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in columns],
    )


def total_nulls(df: DataFrame) -> DataFrame:
    """One row, ``n_nulls``: missing values in the whole table."""
    per_row = sum((F.col(f"`{c}`").isNull().cast("long") for c in df.columns), F.lit(0))
    return df.agg(F.coalesce(F.sum(per_row), F.lit(0)).alias("n_nulls"))


def sparse_columns(df: DataFrame, spec: TableSpec, max_null: float = 0.4) -> list[str]:
    """Columns with more than ``max_null * rows`` nulls, found in one scan."""
    columns = [c for c in df.columns if c != spec.key]
    counts = null_counts(df, columns).first()
    return [c for c in columns if counts[c] > counts["n_rows"] * max_null]


def drop_learned(df: DataFrame, columns: list[str] | tuple[str, ...]) -> DataFrame:
    """Drop the columns training dropped, where present."""
    return df.drop(*columns)


def distinct_rows(df: DataFrame, spec: TableSpec) -> DataFrame:
    """One row per distinct content, the key left aside; the smallest key survives.

    Copies are folded before the shuffle, so a row repeated very often is no hot key.
    """
    content = [c for c in df.columns if c != spec.key]
    if spec.key not in df.columns:
        return df.distinct()
    return df.groupBy(*content).agg(F.min(spec.key).alias(spec.key)).select(*df.columns)


def clean_training(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Distinct labelled rows inside their domains, impossible numbers turned to null.

    The row filters look at content alone, so they run ahead of the shuffle that folds
    copies, except where a range rule first makes a listed value null.
    """
    if set(spec.ranges) & (set(spec.domain_of(df)) | set(spec.geo)):
        unique = nullify_out_of_range(distinct_rows(df, spec), spec)
        return keep_in_domain(drop_unlabelled(unique, spec), spec)
    kept = keep_in_domain(drop_unlabelled(df, spec), spec)
    return nullify_out_of_range(distinct_rows(kept, spec), spec)


def clean_other(df: DataFrame, spec: TableSpec) -> DataFrame:
    return nullify_out_of_domain(nullify_out_of_range(df, spec), spec)


def select_columns(df: DataFrame, spec: TableSpec, columns: list[str]) -> DataFrame:
    """Key, the given columns, and the label where the table has one."""
    ends = [c for c in (spec.key, spec.label) if c in df.columns]
    return df.select(*[c for c in ends if c == spec.key], *columns, *[c for c in ends if c == spec.label])


def as_double(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


def _one_row_to_long(row: DataFrame, columns: list[str], value: str) -> DataFrame:
    entries = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias(value)) for c in columns])
    return row.select(F.inline(entries))
