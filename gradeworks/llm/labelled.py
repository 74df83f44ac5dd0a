"""Bounded samples of labelled documents, and calibration of scores to probabilities."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gradeworks.llm.common import is_training_row
from gradeworks.session import broadcast_if_small

HASH_STEPS = 1 << 20


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, max_rows: int, max_bytes: int) -> DataFrame:
    """(doc_id, text, label) of at most about ``max_rows`` rows and ``max_bytes`` of text per class.

    Only rows open to learning, with label 0 or 1 and an id, take part; of several labels of
    an id the greatest counts. Ids are kept by a hash, in the same part of every class's rows
    as its bounds allow, so the same rows come out however the table is partitioned. Labels
    are a small table of bounded size when they meet the documents, so no text is shuffled.
    """
    known = (
        labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(label).cast("int").alias("label"))
        .where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & is_training_row(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
    )
    step = F.pmod(F.xxhash64(F.lit("sample"), F.col("doc_id")), F.lit(HASH_STEPS))
    sizes = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}

    def kept(bounds: dict[int, float]) -> DataFrame:
        part = F.lit(0.0)
        for value, share in bounds.items():
            part = F.when(F.col("label") == value, F.lit(min(1.0, share))).otherwise(part)
        return known.where(step < part * HASH_STEPS)

    shares = {k: max_rows / n for k, n in sizes.items()}
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))

    def joined(bounds: dict[int, float]) -> DataFrame:
        n_rows = sum(min(1.0, share) * sizes[k] for k, share in bounds.items())
        return texts.join(broadcast_if_small(kept(bounds), int(n_rows) + 1, 16), "doc_id")

    held = joined(shares).groupBy("label").agg(F.sum(F.octet_length("text")).alias("bytes"))
    over = {r["label"]: (r["bytes"] or 1) for r in held.collect()}
    tight = {k: min(1.0, share) * min(1.0, max_bytes / max(1, over.get(k, 1))) for k, share in shares.items()}
    return joined(tight)


def keep_one_per_text(rows: DataFrame) -> DataFrame:
    """Of rows with equal texts, the one with the smallest id, so that copies do not count twice."""
    first = Window.partitionBy(F.xxhash64("text"), F.octet_length("text")).orderBy("doc_id", "label")
    return rows.withColumn("_place", F.row_number().over(first)).where("_place = 1").drop("_place")


def monotone_fit(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the least-squares non-decreasing function of ``x`` (pool adjacent violators).

    Values of each pool are smoothed with one case of the overall mean, so that none is 0 or 1.
    Without cases the function is 0.
    """
    if not len(x):
        return np.array([0.0]), np.array([0.0])
    base = float(np.mean(y))
    values, inverse = np.unique(x, return_inverse=True)
    sums, counts = np.bincount(inverse, y), np.bincount(inverse).astype(float)
    pools: list[list[float]] = []  # sum, count, first x, last x
    for v, s, n in zip(values, sums, counts, strict=True):
        pools.append([s, n, v, v])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            s2, n2, _, last = pools.pop()
            pools[-1][0] += s2
            pools[-1][1] += n2
            pools[-1][3] = last
    knots = np.array([p for pool in pools for p in (pool[2], pool[3])])
    heights = np.repeat([(pool[0] + base) / (pool[1] + 1) for pool in pools], 2)
    return knots, np.maximum.accumulate(heights)


def logistic_fit(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, rounds: int = 40) -> np.ndarray:
    """Weights, the intercept last, by Newton's method with a small ridge."""
    a = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(a.shape[1])
    penalty = np.full(a.shape[1], ridge)
    penalty[-1] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        slope = a.T @ (p - y) + penalty * w
        curve = (a * (p * (1 - p))[:, None]).T @ a + np.diag(penalty)
        step = np.linalg.solve(curve, slope)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w
