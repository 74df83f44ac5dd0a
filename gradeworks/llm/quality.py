"""Quality by compression: which dictionary, of good or of bad texts, makes a text smaller.

Two zstandard dictionaries are built from a bounded sample of labelled texts. The difference of
the two compressed sizes over the larger one, together with the size that is left per byte, is
calibrated on other labelled texts: a logistic fit, then a monotone one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradeworks.llm.common import arrow_schema, as_batch, is_training_row, map_batches
from gradeworks.llm.labelled import keep_one_per_text, labelled_sample, logistic_fit, monotone_fit
from gradeworks.session import stage

SCORES_SCHEMA = "doc_id bigint, held_out boolean, score double, predicted int, good_bytes bigint, bad_bytes bigint"


@dataclass(frozen=True)
class QualityOptions:
    """``max_rows`` and ``max_bytes`` bound the labelled rows learned from, per class.

    Two thirds of them build the dictionaries of ``dictionary_bytes``, the others calibrate.
    """

    max_rows: int = 12_000
    max_bytes: int = 24 * 1024 * 1024
    dictionary_bytes: int = 32 * 1024
    level: int = 3
    threshold: float = 0.7


@dataclass(frozen=True)
class QualityModel:
    good: bytes
    bad: bytes
    means: list[float]
    scales: list[float]
    weights: list[float]
    knots: list[float]
    heights: list[float]
    options: QualityOptions

    def probability(self, features: np.ndarray) -> np.ndarray:
        """Probability of label 1 for rows of ``shape_features``; a share of the logistic one
        keeps texts in the order of their evidence where the monotone fit is flat."""
        if not self.weights:
            return np.full(len(features), self.heights[0])
        x = np.clip((features - self.means) / self.scales, -8, 8)
        plain = 1 / (1 + np.exp(-np.clip(x @ np.array(self.weights[:-1]) + self.weights[-1], -30, 30)))
        return 0.9 * np.interp(plain, self.knots, self.heights) + 0.1 * plain


def compressor(dictionary: bytes, level: int) -> zstandard.ZstdCompressor:
    if not dictionary:
        return zstandard.ZstdCompressor(level=level)
    data = zstandard.ZstdCompressionDict(dictionary)
    data.precompute_compress(level=level)
    return zstandard.ZstdCompressor(level=level, dict_data=data, write_content_size=False, write_checksum=False, write_dict_id=False)


def sizes(texts: list[str | None], good: zstandard.ZstdCompressor, bad: zstandard.ZstdCompressor) -> list[tuple[int, int, int]]:
    """(bytes, compressed with the good, with the bad dictionary) of whole texts."""
    out = []
    for text in texts:
        raw = (text or "").encode("utf-8", "replace")
        out.append((len(raw), len(good.compress(raw)), len(bad.compress(raw))))
    return out


def shape_features(measured: list[tuple[int, int, int]]) -> np.ndarray:
    """Normalised difference, size left per byte, their squares and product, log length."""
    m = np.array(measured, dtype=float).reshape(-1, 3)
    difference = (m[:, 2] - m[:, 1]) / np.maximum(np.maximum(m[:, 1], m[:, 2]), 1)
    left = np.minimum(m[:, 1], m[:, 2]) / np.maximum(m[:, 0], 1)
    length = np.log1p(m[:, 0])
    return np.column_stack([difference, left, difference**2, left**2, difference * left, length, difference * length, np.log(left + 0.01)])


def dictionary_of(texts: list[str], size: int) -> bytes:
    """A trained dictionary, or the texts themselves where there are too few to train one."""
    samples = [t.encode("utf-8", "replace") for t in texts if t]
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"\n".join(samples)[-size:]


def fit(docs: DataFrame, labels: DataFrame, options: QualityOptions = QualityOptions()) -> QualityModel:
    """Learn from ``docs`` (doc_id, text) and ``labels`` (doc_id, quality), training rows only.

    The driver gets the bounded sample's texts for the dictionaries and three sizes per row for
    the calibration. Without rows of both classes every text gets the share of good rows, 0
    without any.
    """
    sample = labelled_sample(docs, labels, "quality", options.max_rows, options.max_bytes)
    rows = stage(keep_one_per_text(sample), "quality-sample")
    counts = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts.get(0) or not counts.get(1):
        base = 1.0 if counts.get(1) else 0.0
        return QualityModel(b"", b"", [], [], [], [0.0], [base], options)
    teaches = F.pmod(F.xxhash64(F.lit("dictionary"), F.col("doc_id")), F.lit(3)) < 2
    dictionaries = {}
    for label in (0, 1):
        # the sample is bounded by max_bytes; text order does not depend on partitions
        texts = [r["text"] for r in rows.where(teaches & (F.col("label") == label)).orderBy("doc_id").select("text").collect()]
        dictionaries[label] = dictionary_of(texts, options.dictionary_bytes)
    measured = measure(rows.where(~teaches), dictionaries[1], dictionaries[0], options.level).toPandas()
    if measured["label"].nunique() < 2:
        measured = measure(rows, dictionaries[1], dictionaries[0], options.level).toPandas()
    features = shape_features(measured[["size", "good", "bad"]].values.tolist())
    y = measured["label"].to_numpy(float)
    means, scales = features.mean(axis=0), features.std(axis=0) + 1e-6
    x = np.clip((features - means) / scales, -8, 8)
    weights = logistic_fit(x, y, ridge=0.1)
    knots, heights = monotone_fit(1 / (1 + np.exp(-np.clip(x @ weights[:-1] + weights[-1], -30, 30))), y)
    return QualityModel(
        dictionaries[1], dictionaries[0], means.tolist(), scales.tolist(), weights.tolist(), knots.tolist(), heights.tolist(), options
    )


def measure(rows: DataFrame, good: bytes, bad: bytes, level: int) -> DataFrame:
    schema = "label bigint, size bigint, good bigint, bad bigint"
    arrow = arrow_schema(schema)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_good, by_bad = compressor(good, level), compressor(bad, level)
        for batch in batches:
            labels, texts = (batch.column(i).to_pylist() for i in (0, 1))
            yield as_batch(((y, *s) for y, s in zip(labels, sizes(texts, by_good, by_bad), strict=True)), arrow)

    return map_batches(rows.select("label", "text"), work, schema)


def score_documents(docs: DataFrame, model: QualityModel) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text) with its score, prediction and compressed sizes.

    Whole texts are compressed, nothing else is looked at. A null text is scored as an empty
    one; null ids and repeated rows are kept; other columns are left out. Narrow: no row moves.
    """
    schema = arrow_schema(SCORES_SCHEMA)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        good, bad = compressor(model.good, model.options.level), compressor(model.bad, model.options.level)
        for batch in batches:
            ids, held, texts = (c.to_pylist() for c in batch.columns)
            measured = sizes(texts, good, bad)
            scores = model.probability(shape_features(measured)).tolist() if ids else []
            yield as_batch(
                (
                    (i, h, min(1.0, max(0.0, s)), int(s >= model.options.threshold), m[1], m[2])
                    for i, h, s, m in zip(ids, held, scores, measured, strict=True)
                ),
                schema,
            )

    doc_id = F.col("doc_id").cast("bigint")
    return map_batches(docs.select(doc_id.alias("doc_id"), ~is_training_row(doc_id), "text"), work, SCORES_SCHEMA)
