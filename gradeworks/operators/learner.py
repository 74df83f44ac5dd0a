"""Shared parameters of the selectors and classifiers, which are Spark ML estimators."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class TableParams(Params):
    """Key and label columns; every other column of the table is a feature."""

    keyCol = Param(Params._dummy(), "keyCol", "row key", TypeConverters.toString)
    labelCol = Param(Params._dummy(), "labelCol", "class column", TypeConverters.toString)
    seed = Param(Params._dummy(), "seed", "seed of the row order", TypeConverters.toInt)

    @property
    def key(self) -> str:
        return self.getOrDefault(self.keyCol)

    @property
    def label(self) -> str:
        return self.getOrDefault(self.labelCol)

    def features_of(self, df: DataFrame) -> list[str]:
        return [c for c in df.columns if c not in (self.key, self.label)]

    def settings(self) -> dict[str, object]:
        """Every parameter by name, set or default."""
        return {p.name: self.getOrDefault(p) for p in self.params if self.isDefined(p)}


def class_sizes(df: DataFrame, label: str) -> dict[int, int]:
    """Rows per class, in class order."""
    rows = df.where(F.col(label).isNotNull()).groupBy(label).count().collect()
    return dict(sorted((r[label], r["count"]) for r in rows))


def in_parallel(tasks: Sequence[Callable[[], object]], parallelism: int) -> list:
    """Results of independent jobs or fits, submitted from a few driver threads."""
    if parallelism <= 1 or len(tasks) <= 1:
        return [task() for task in tasks]
    inherit = inheritable_thread_target(SparkSession.active())
    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        return [f.result() for f in [pool.submit(inherit(task)) for task in tasks]]
