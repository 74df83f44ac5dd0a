"""Exact seeded samples, stratified splits and folds."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gradeworks.functions.hash_order import Cuts, Stratum, find_cuts, segment
from gradeworks.spec import TableSpec

SPLITS = ("train", "validation", "test")


def _order(stratum: Stratum):
    return (stratum is None, stratum)


def shared_out(counts: Mapping[Stratum, int], total: int) -> dict[Stratum, int]:
    """Share ``total`` rows over strata in proportion, largest remainders first."""
    rows = sum(counts.values())
    if rows == 0:
        return dict.fromkeys(counts, 0)
    whole = {s: n * total // rows for s, n in counts.items()}
    rest = {s: n * total % rows for s, n in counts.items()}
    left = total - sum(whole.values())
    for s in sorted(counts, key=lambda s: (-rest[s], _order(s)))[:left]:
        whole[s] += 1
    return whole


def split_sizes(counts: Mapping[Stratum, int]) -> dict[Stratum, tuple[int, int, int]]:
    """Rows per stratum in train, validation and test: 30 % held out, then halved."""
    rows = sum(counts.values())
    held_out = -(-rows * 30 // 100)
    train = shared_out(counts, rows - held_out)
    rest = {s: counts[s] - train[s] for s in counts}
    validation = shared_out(rest, held_out - -(-held_out // 2))
    return {s: (train[s], validation[s], rest[s] - validation[s]) for s in counts}


def with_split(df: DataFrame, key: str, label: str | None, seed: int = 42) -> DataFrame:
    """Add ``split``: an exact 70/15/15 partition of the rows, stratified by label."""

    def ranks(counts):
        return {s: [t, t + v] for s, (t, v, _) in split_sizes(counts).items()}

    cuts = find_cuts(df, key, ranks, by=label, seed=seed)
    names = F.array(*[F.lit(s) for s in SPLITS])
    return df.withColumn("split", F.get(names, segment(cuts, key, by=label, seed=seed)))


def split_three(df: DataFrame, key: str, label: str | None, seed: int = 42) -> tuple[DataFrame, DataFrame, DataFrame]:
    marked = with_split(df, key, label, seed)
    return tuple(marked.where(F.col("split") == s).drop("split") for s in SPLITS)


def sample_rows(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """Uniform sample of ``min(n, rows)`` rows, without replacement."""
    cuts = find_cuts(df, key, lambda counts: {s: [n] for s in counts}, seed=seed)
    return df.where(segment(cuts, key, seed=seed) == 0)


def stratified_sample(df: DataFrame, key: str, label: str | None, fraction: float, seed: int = 42) -> DataFrame:
    """Keep ``floor(fraction * rows)`` rows with the label shares of the whole table."""

    def ranks(counts):
        kept = shared_out(counts, int(fraction * sum(counts.values())))
        return {s: [n] for s, n in kept.items()}

    cuts = find_cuts(df, key, ranks, by=label, seed=seed)
    return df.where(segment(cuts, key, by=label, seed=seed) == 0)


def fold_cuts(df: DataFrame, key: str, n_folds: int, seed: int = 42) -> Cuts:
    """Cuts between folds: consecutive runs of the shuffled order, sizes differing by at most one."""

    def ranks(counts):
        return {s: _run_ends([n // n_folds + (i < n % n_folds) for i in range(n_folds)]) for s, n in counts.items()}

    return find_cuts(df, key, ranks, seed=seed)


def with_folds(df: DataFrame, key: str, n_folds: int, seed: int = 42, name: str = "fold") -> DataFrame:
    return df.withColumn(name, segment(fold_cuts(df, key, n_folds, seed), key, seed=seed))


def with_stratified_folds(
    df: DataFrame, key: str, label: str, n_folds: int, seed: int = 42, name: str = "fold"
) -> DataFrame:
    """Folds that share out every class, and the whole table, as evenly as whole rows allow."""

    def ranks(counts):
        ends, start = {}, 0
        for s in sorted(counts, key=_order):
            stop = start + counts[s]
            # rows i, i + n_folds, ... of the label-sorted table belong to fold i
            sizes = [len(range(start + (i - start) % n_folds, stop, n_folds)) for i in range(n_folds)]
            ends[s], start = _run_ends(sizes), stop
        return ends

    cuts = find_cuts(df, key, ranks, by=label, seed=seed)
    return df.withColumn(name, segment(cuts, key, by=label, seed=seed))


def _run_ends(sizes: list[int]) -> list[int]:
    ends, total = [], 0
    for size in sizes[:-1]:
        total += size
        ends.append(total)
    return ends


def value_width(field: T.StructField) -> Column:
    """Bytes of one value in a plain fixed or length-counted encoding; 0 for null."""
    fixed = {T.BooleanType: 1, T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.FloatType: 4, T.DateType: 4}
    value = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return F.when(value.isNotNull(), F.octet_length(value)).otherwise(0)
    return F.when(value.isNotNull(), F.lit(fixed.get(type(field.dataType), 8))).otherwise(0)


def table_size(df: DataFrame) -> DataFrame:
    """One row: ``n_rows`` and ``size_mb``, the bytes of all values."""
    row_bytes = sum((value_width(f) for f in df.schema.fields), F.lit(0))
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        (F.coalesce(F.sum(row_bytes), F.lit(0)) / F.lit(1024.0 * 1024.0)).alias("size_mb"),
    )


def reduce_to_size(df: DataFrame, spec: TableSpec, limit_mb: float, seed: int = 42) -> DataFrame:
    """Stratified sample that fits the budget; the table itself when it already does."""
    size_mb = table_size(df).first()["size_mb"]
    if size_mb <= limit_mb:
        return df
    label = spec.label if spec.label in df.columns else None
    return stratified_sample(df, spec.key, label, limit_mb / size_mb, seed)
