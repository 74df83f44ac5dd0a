"""Shrunken target means per category, with cross-fitted values on the training rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gradeworks.functions.hash_order import Cuts, segment
from gradeworks.operators.sampling import fold_cuts
from gradeworks.session import lookup_join, stage

N_FOLDS = 5


def shrunken_mean(n: Column, s: Column, ss: Column, mean: Column, variance: Column) -> Column:
    """Category mean pulled to the global mean by the ratio of the two variances."""
    own_mean = F.try_divide(s, n)
    own_variance = F.greatest(F.try_divide(ss, n) - own_mean * own_mean, F.lit(0.0))
    weight = F.try_divide(variance * n, variance * n + own_variance)
    return F.coalesce(weight * own_mean + (1 - weight) * mean, mean)


@dataclass(frozen=True)
class TargetEncoder:
    """Statistics per (column, category, fold); a table because categories grow with the data.

    ``finished`` holds the encodings made of them: one row per category for tables the encoder
    never saw, with a null fold, and one per category and fold for the training rows. Applying
    the encoder only joins it.
    """

    columns: tuple[str, ...]
    label: str
    statistics: DataFrame  # level, category, fold, n, s, ss
    folds: tuple[tuple[int, int, float, float], ...]  # fold, n, s, ss over all rows
    cuts: Cuts
    seed: int = 42
    finished: DataFrame | None = None  # level, category, fold, encoding

    def finish(self) -> TargetEncoder:
        """The encoder with its encodings stored."""
        parts = []
        for c in self.columns:
            parts.append(self._all_folds(c).select(F.lit(c).alias("level"), "category", F.lit(None).cast("int").alias("fold"), "encoding"))
            parts.append(self._other_folds(c).select(F.lit(c).alias("level"), "category", F.col("fold").cast("int").alias("fold"), "encoding"))
        return replace(self, finished=stage(reduce(DataFrame.unionByName, parts), "target-encodings"))

    @property
    def total(self) -> tuple[int, float, float]:
        return tuple(sum(f[i] for f in self.folds) for i in (1, 2, 3))

    @staticmethod
    def _moments(n: int, s: float, ss: float) -> tuple[float, float]:
        mean = s / n if n else 0.0
        return mean, max(ss / n - mean * mean, 0.0) if n else 0.0

    def encodings(self, column: str) -> DataFrame:
        """``(category, encoding)`` from all training rows, for tables the encoder never saw."""
        return self.finished.where((F.col("level") == column) & F.col("fold").isNull()).select("category", "encoding")

    def fold_encodings(self, column: str) -> DataFrame:
        """``(category, fold, encoding)`` from the rows of the other folds."""
        return self.finished.where((F.col("level") == column) & F.col("fold").isNotNull()).select("category", "fold", "encoding")

    def _all_folds(self, column: str) -> DataFrame:
        mean, variance = self._moments(*self.total)
        totals = (
            self.statistics.where(F.col("level") == column)
            .groupBy("category")
            .agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("ss").alias("ss"))
        )
        encoding = shrunken_mean(F.col("n"), F.col("s"), F.col("ss"), F.lit(mean), F.lit(variance))
        return totals.select("category", encoding.alias("encoding"))

    def _other_folds(self, column: str) -> DataFrame:
        whole = Window.partitionBy("category")
        others = self.statistics.where(F.col("level") == column).select(
            "category",
            "fold",
            *[(F.sum(c).over(whole) - F.col(c)).alias(c) for c in ("n", "s", "ss")],
        )
        return others.select(
            "category",
            "fold",
            shrunken_mean(
                F.col("n"), F.col("s"), F.col("ss"), self._outside(0), self._outside(1)
            ).alias("encoding"),
        )

    def _outside(self, which: int) -> Column:
        """Mean or variance of all rows outside the row's fold."""
        n, s, ss = self.total
        values = [F.lit(self._moments(n - fn, s - fs, ss - fss)[which]) for _, fn, fs, fss in self.folds]
        return F.get(F.array(*values), F.col("fold"))

    def transform(self, df: DataFrame) -> DataFrame:
        mean, _ = self._moments(*self.total)
        for c in self.columns:
            table = self.encodings(c).withColumnRenamed("category", c)
            df = _replace(df.withColumn(c, F.col(c).cast("double")), table, [c], c, F.lit(mean))
        return df

    def transform_training(self, df: DataFrame, key: str) -> DataFrame:
        """Each row encoded by statistics of the folds it is not in."""
        folded = df.withColumn("fold", segment(self.cuts, key, seed=self.seed))
        for c in self.columns:
            table = self.fold_encodings(c).withColumnRenamed("category", c)
            folded = _replace(folded.withColumn(c, F.col(c).cast("double")), table, [c, "fold"], c, self._outside(0))
        return folded.drop("fold")


def _replace(df: DataFrame, table: DataFrame, on: list[str], column: str, unseen: Column) -> DataFrame:
    joined = lookup_join(df, table, on, table.count(), 32)
    value = F.coalesce(F.col("encoding"), unseen)
    return joined.select(*[value.alias(c) if c == column else F.col(f"`{c}`") for c in df.columns])


def category_statistics(folded: DataFrame, columns: Sequence[str], label: str) -> DataFrame:
    """``(level, category, fold, n, s, ss)`` of the label, all columns in one scan."""
    y = F.col(label).cast("double")
    pairs = F.array(
        *[F.struct(F.lit(c).alias("level"), F.col(c).cast("double").alias("category")) for c in columns]
    )
    return (
        folded.select("fold", y.alias("y"), F.inline(pairs))
        .groupBy("level", "category", "fold")
        .agg(F.count("y").alias("n"), F.sum("y").alias("s"), F.sum(F.col("y") * F.col("y")).alias("ss"))
    )


def fit_target_encoder(
    df: DataFrame, columns: Sequence[str], label: str, key: str, seed: int = 42, cuts: Cuts | None = None
) -> TargetEncoder:
    """Learn the statistics; ``cuts`` are those of the labelled rows' folds where already known."""
    if label not in df.columns:
        raise ValueError(f"target encoding needs the label column {label!r}")
    labelled = df.select(key, label, *columns).where(F.col(label).isNotNull())
    cuts = cuts or fold_cuts(labelled, key, N_FOLDS, seed)
    folded = labelled.withColumn("fold", segment(cuts, key, seed=seed))
    statistics = stage(category_statistics(folded, columns, label), "target-statistics")
    rows = (
        statistics.where(F.col("level") == columns[0])
        .groupBy("fold")
        .agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("ss").alias("ss"))
        .collect()
    )
    by_fold = {r["fold"]: (r["n"], r["s"], r["ss"]) for r in rows}
    folds = tuple((f, *by_fold.get(f, (0, 0.0, 0.0))) for f in range(N_FOLDS))
    return TargetEncoder(tuple(columns), label, statistics, folds, cuts, seed).finish()
