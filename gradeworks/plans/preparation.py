"""Preparation learned on the training table and only applied to every other one."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gradeworks.operators import cleaning
from gradeworks.operators.clustering import Clusters, fit_clusters
from gradeworks.operators.encoding import align, one_hot
from gradeworks.operators.imputation import FillValues, fill, fit_fill_values
from gradeworks.operators.learner import in_parallel
from gradeworks.operators.sampling import fold_cuts
from gradeworks.operators.scaling import fit_standard, standardize
from gradeworks.operators.target_encoding import N_FOLDS, TargetEncoder, fit_target_encoder
from gradeworks.session import stage
from gradeworks.spec import TableSpec


@dataclass(frozen=True)
class Preparation:
    """Everything learned from the training rows."""

    spec: TableSpec
    dropped: tuple[str, ...]
    fills: FillValues
    encoder: TargetEncoder | None
    moments: dict[str, tuple[float, float]]
    columns: tuple[str, ...]
    clusters: Clusters | None = None

    def apply(self, df: DataFrame) -> DataFrame:
        """Prepare a table the training never saw; no row is removed."""
        cleaned = cleaning.clean_other(cleaning.drop_learned(df, self.dropped), self.spec)
        filled = fill(cleaned, self.fills)
        encoded = self.encoder.transform(filled) if self.encoder else filled
        return self._finish(encoded)

    def apply_training(self, cleaned: DataFrame) -> DataFrame:
        """Prepare the cleaned training rows, their geo ids encoded across folds."""
        filled = fill(cleaned, self.fills)
        encoded = self.encoder.transform_training(filled, self.spec.key) if self.encoder else filled
        return self._finish(encoded)

    def _finish(self, df: DataFrame) -> DataFrame:
        ends = [c for c in (self.spec.key, self.spec.label) if c in df.columns]
        ready = standardize(align(one_hot(df, self.fills.levels), self.columns, keep=ends), self.moments)
        return self.clusters.transform(ready) if self.clusters else ready

    def save_to(self, path: str) -> None:
        """A one-row table of scalars and a table of category statistics."""
        spark = SparkSession.getActiveSession()
        head = {
            "dropped": self.dropped,
            "fills": asdict(self.fills),
            "moments": self.moments,
            "columns": self.columns,
            "clusters": asdict(self.clusters) if self.clusters else None,
        }
        if self.encoder:
            e = self.encoder
            head["encoder"] = {"columns": e.columns, "label": e.label, "folds": e.folds, "cuts": e.cuts[0], "seed": e.seed}
            e.statistics.write.mode("overwrite").parquet(f"{path}/statistics")
            e.finished.write.mode("overwrite").parquet(f"{path}/encodings")
        spark.createDataFrame([(json.dumps(head),)], "head string").write.mode("overwrite").parquet(f"{path}/head")

    @classmethod
    def load_from(cls, spark: SparkSession, path: str, spec: TableSpec) -> Preparation:
        head = json.loads(spark.read.parquet(f"{path}/head").first()["head"])
        encoder, clusters = head.get("encoder"), head["clusters"]
        return cls(
            spec,
            tuple(head["dropped"]),
            FillValues(**head["fills"]),
            TargetEncoder(
                tuple(encoder["columns"]), encoder["label"], spark.read.parquet(f"{path}/statistics"),
                tuple(tuple(f) for f in encoder["folds"]), {0: encoder["cuts"]}, encoder["seed"],
                spark.read.parquet(f"{path}/encodings"),
            ) if encoder else None,
            {c: tuple(m) for c, m in head["moments"].items()},
            tuple(head["columns"]),
            Clusters(tuple(clusters["columns"]), tuple(tuple(c) for c in clusters["centers"]), clusters["cost"])
            if clusters else None,
        )


def clean_for_fit(df: DataFrame, spec: TableSpec) -> tuple[DataFrame, tuple[str, ...]]:
    """Cleaned training rows and the columns dropped for too many gaps.

    Rows and columns are judged before the range rules, so the gaps these rules make
    do not count.
    """
    kept = cleaning.drop_sparse_rows(df, spec)
    dropped = tuple(cleaning.sparse_columns(kept, spec))
    return cleaning.clean_training(kept.drop(*dropped), spec), dropped


def fit_preparation(df: DataFrame, spec: TableSpec, seed: int = 42) -> tuple[Preparation, DataFrame]:
    """Learn the preparation and return it with the prepared training rows."""
    if spec.label not in df.columns:
        raise ValueError(f"the training table needs the label column {spec.label!r}")
    cleaned, dropped = clean_for_fit(df, spec)
    # written once: every statistic below reads a few of its columns
    cleaned = stage(cleaned, "cleaned")
    geo = spec.geo_columns(cleaned)
    fills, cuts = in_parallel(
        [
            lambda: fit_fill_values(cleaned, spec),
            lambda: fold_cuts(cleaned, spec.key, N_FOLDS, seed) if geo else None,
        ],
        2,
    )
    filled = fill(cleaned, fills)
    encoder, moments = in_parallel(
        [
            lambda: fit_target_encoder(filled, geo, spec.label, spec.key, seed, cuts) if geo else None,
            lambda: fit_standard(filled, spec.continuous),
        ],
        2,
    )
    hot = one_hot(filled, fills.levels)
    columns = tuple(c for c in hot.columns if c not in (spec.key, spec.label))
    preparation = Preparation(spec, dropped, fills, encoder, moments, columns)
    return preparation, preparation.apply_training(cleaned)


def with_clusters(
    preparation: Preparation, prepared: DataFrame, k: int, columns: Sequence[str] = (), restarts: int = 10, seed: int = 42
) -> Preparation:
    """The preparation extended by cluster columns learned on the prepared training rows."""
    columns = list(columns) or [c for c in preparation.spec.continuous if c in prepared.columns]
    return replace(preparation, clusters=fit_clusters(prepared, columns, k, restarts, seed))


def remaining_nulls(df: DataFrame, spec: TableSpec) -> int:
    return cleaning.total_nulls(df.drop(spec.label)).select(F.col("n_nulls")).first()[0]
