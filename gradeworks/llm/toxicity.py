"""Toxic passages as maximum-scoring segments of token log-odds.

Tokens are words and, so that inflected forms share their evidence, word beginnings. Fitting
counts in how many labelled texts of each class a token occurs and takes the log-odds ratio
with an informative Dirichlet prior, which shrinks rare tokens. A token's score is the lower
confidence bound of its log-odds less a margin; a word has the score of its best token, and
words without a telling token cost a little. A
linear scan finds every maximal-scoring segment of a text. Segment scores become extreme-value
E-values (Karlin and Altschul: lambda solves sum p * exp(lambda * s) = 1 over the clean texts'
words), the significant ones are added up, and a monotone fit turns the sum into a probability.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradeworks.llm.common import arrow_schema, as_batch, is_training_row, map_batches
from gradeworks.llm.labelled import keep_one_per_text, labelled_sample, monotone_fit
from gradeworks.session import stage

WORD = re.compile(r"[^\W_]+")
BEGINNINGS = (4, 5, 6)
MAX_KNOWN_WORDS = 250_000
WORDS_SCHEMA = "token string, toxic bigint, clean bigint, seen bigint"
SCORES_SCHEMA = "doc_id bigint, held_out boolean, score double, predicted int, passages array<string>"


@dataclass(frozen=True)
class ToxicityOptions:
    """``max_rows`` and ``max_bytes`` bound the labelled rows learned from, per class.

    ``prior`` is the prior's weight in texts, ``margin`` what a word's log-odds must exceed,
    ``density`` the least share of telling words in a toxic passage (it sets the cost of other
    words), ``min_z`` the z-score that a word needs, ``max_e`` the E-value up to which a
    segment is significant.
    """

    max_rows: int = 20_000
    max_bytes: int = 64 * 1024 * 1024
    prior: float = 100.0
    margin: float = 0.5
    density: float = 0.01
    min_z: float = 3.0
    max_e: float = 0.5
    threshold: float = 0.3


def tokens_of(word: str) -> list[str]:
    return [word, *(f"{word[:k]}*" for k in BEGINNINGS if len(word) > k)]


class WordScores(dict):
    """Score of a word as written, 0 for most; kept for the next time, in bounded memory."""

    def __init__(self, tokens: dict[str, float]):
        super().__init__()
        self.tokens = tokens

    def __missing__(self, word: str) -> float:
        if len(self) >= MAX_KNOWN_WORDS:
            self.clear()
        score = self[word] = max(self.tokens.get(t, 0.0) for t in tokens_of(word.lower()))
        return score


@dataclass(frozen=True)
class ToxicityModel:
    tokens: dict[str, float]
    gap: float
    rate: float
    options: ToxicityOptions
    knots: list[float] = field(default_factory=lambda: [0.0])
    heights: list[float] = field(default_factory=lambda: [0.0])

    def segments(self, text: str, scores: WordScores) -> tuple[list[tuple[int, int, float]], float]:
        """Significant segments (start, end in code points, E-value), and the sum of their evidence."""
        words = WORD.findall(text)
        places = [i for i, w in enumerate(words) if scores[w]]
        if not places:
            return [], 0.0
        spans = [m.span() for m in WORD.finditer(text)]
        out, total = [], 0.0
        for first, last, score in maximal_segments(places, [scores[words[i]] for i in places], self.gap):
            e_value = len(words) * math.exp(-min(self.rate * score, 700.0))
            if e_value <= self.options.max_e:
                out.append((spans[places[first]][0], spans[places[last]][1], e_value))
                total -= math.log(e_value)
        return out, math.log1p(total)

    def is_toxic(self, segments: list, evidence: float) -> bool:
        """Whether a text holds a significant passage and scores at the threshold or above."""
        return bool(segments) and self.probability(evidence) >= self.options.threshold

    def probability(self, evidence: float) -> float:
        return float(np.interp(evidence, self.knots, self.heights))


def maximal_segments(places: list[int], scores: list[float], gap: float) -> Iterator[tuple[int, int, float]]:
    """All maximal-scoring segments of a sequence (Ruzzo and Tompa), as indexes of first and last.

    The sequence has ``scores`` > 0 at ``places`` and ``-gap`` everywhere else, so it is scanned
    from one place to the next. Candidates form a stack; each is (first, last, sum before it,
    sum up to its end), and a new one swallows those that it extends.
    """
    stack: list[tuple[int, int, float, float]] = []
    total, previous = 0.0, -1
    for k, (place, score) in enumerate(zip(places, scores, strict=True)):
        total -= gap * (place - previous - 1)
        previous = place
        first, left = k, total
        total += score
        right = total
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][2] >= left:
                j -= 1
            if j < 0 or stack[j][3] >= right:
                # those after j start no lower and stay maximal on their own
                stack.append((first, k, left, right))
                break
            first, left = stack[j][0], stack[j][2]
            del stack[j:]
    for first, last, left, right in stack:
        yield first, last, right - left


def count_tokens(rows: DataFrame) -> DataFrame:
    """Texts of each class in which a token occurs, and its occurrences in clean texts."""
    schema = arrow_schema(WORDS_SCHEMA)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # counts of a few hundred texts at a time, so that a task's memory is bounded
            for part in (batch.slice(i, 400) for i in range(0, batch.num_rows, 400)):
                toxic, clean, seen = Counter(), Counter(), Counter()
                for text, label in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    words = Counter(WORD.findall(text.lower()))
                    (toxic if label else clean).update({t for w in words for t in tokens_of(w)})
                    if not label:
                        for w, n in words.items():
                            for t in tokens_of(w):
                                seen[t] += n
                names = [*clean, *(t for t in toxic if t not in clean)]
                yield as_batch(((t, toxic[t], clean[t], seen[t]) for t in names), schema)

    counts = map_batches(rows.select("text", "label"), count, WORDS_SCHEMA)
    return counts.groupBy("token").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"), F.sum("seen").alias("seen"))


def fit(docs: DataFrame, labels: DataFrame, options: ToxicityOptions = ToxicityOptions()) -> ToxicityModel:
    """Learn from ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic), training rows only.

    The driver gets the telling tokens, whose number is bounded by the sample's texts and the
    z-score, and one number per sampled row. Without rows of both classes the model knows no
    token and its score is the share of toxic rows, 0 without any; it finds no passage, so
    ``drop_toxic`` keeps every text.
    """
    sample = labelled_sample(docs, labels, "toxic", options.max_rows, options.max_bytes)
    rows = stage(keep_one_per_text(sample), "toxicity-sample")
    sizes = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    n1, n0 = sizes.get(1, 0), sizes.get(0, 0)
    base = n1 / (n1 + n0) if n1 + n0 else 0.0
    blank = ToxicityModel({}, 1.0, 1.0, options, [0.0], [base])
    if not n1 or not n0:
        return blank
    counts = stage(count_tokens(rows), "toxicity-words")
    n_seen = counts.where(~F.col("token").endswith("*")).agg(F.sum("seen")).first()[0] or 1
    part = options.prior / (n1 + n0)
    alpha = (F.col("toxic") + F.col("clean")) * part
    in_toxic, in_clean = F.col("toxic") + alpha, F.col("clean") + alpha
    log_odds = F.log(in_toxic / (n1 + options.prior - in_toxic + 1)) - F.log(in_clean / (n0 + options.prior - in_clean + 1))
    deviation = F.sqrt(1 / in_toxic + 1 / in_clean)
    telling = (
        counts.select("token", "seen", "toxic", log_odds.alias("odds"), deviation.alias("deviation"))
        .where(F.col("odds") / F.col("deviation") >= options.min_z)
        .withColumn("score", F.col("odds") - F.col("deviation") - options.margin)
        .where((F.col("score") > 0) & (F.col("toxic") >= 3))
        .collect()
    )
    if not telling:
        return blank
    tokens = {r["token"]: r["score"] for r in telling}
    # clean share of each telling token; one added occurrence stands for those not seen
    shares = {r["token"]: (r["seen"] + 1) / (n_seen + len(tokens)) for r in telling}
    gap = -math.log(1 - options.density)
    found = ToxicityModel(tokens, gap, extreme_value_rate(tokens, shares, gap), options)
    evidence = evidence_of(rows, found).select("label", "evidence").toPandas()
    knots, heights = monotone_fit(evidence["evidence"].to_numpy(), evidence["label"].to_numpy(float))
    return ToxicityModel(tokens, gap, found.rate, options, knots.tolist(), heights.tolist())


def extreme_value_rate(tokens: dict[str, float], shares: dict[str, float], gap: float) -> float:
    """The positive root of sum p * exp(rate * score) = 1 over the tokens of clean texts."""
    rest = max(0.0, 1 - sum(shares.values()))

    def excess(rate: float) -> float:
        return rest * math.exp(-rate * gap) + sum(p * math.exp(min(rate * tokens[t], 500.0)) for t, p in shares.items()) - 1

    low, high = 1e-6, 1.0
    if excess(low) >= 0:
        # telling words are common in clean texts: no segment is a surprise
        return low
    while excess(high) < 0 and high < 64:
        high *= 2
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (middle, high) if excess(middle) < 0 else (low, middle)
    return low


def evidence_of(rows: DataFrame, model: ToxicityModel) -> DataFrame:
    schema = "label bigint, evidence double"
    arrow = arrow_schema(schema)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = WordScores(model.tokens)
        for batch in batches:
            labels, texts = (batch.column(i).to_pylist() for i in (0, 1))
            yield as_batch(((y, model.segments(t, scores)[1]) for y, t in zip(labels, texts, strict=True)), arrow)

    return map_batches(rows.select("label", "text"), work, schema)


def score_documents(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): score, prediction and the toxic passages.

    ``predicted`` says whether the score reaches the threshold; of equal scores all or none do.
    Whole texts are scanned. A null text is scored as an empty one; null ids and repeated rows
    are kept; other columns are left out. ``passages`` lists start:end of every significant
    segment in code points. Narrow: no row moves.
    """
    schema = arrow_schema(SCORES_SCHEMA)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = WordScores(model.tokens)
        for batch in batches:
            out = []
            ids, held, texts = (c.to_pylist() for c in batch.columns)
            for i, h, t in zip(ids, held, texts, strict=True):
                segments, evidence = model.segments(t or "", scores)
                passages = [f"{s}:{e}" for s, e, _ in segments]
                score = model.probability(evidence)
                out.append((i, h, score, int(score >= model.options.threshold), passages))
            yield as_batch(out, schema)

    doc_id = F.col("doc_id").cast("bigint")
    return map_batches(docs.select(doc_id.alias("doc_id"), ~is_training_row(doc_id), "text"), work, SCORES_SCHEMA)


def drop_toxic(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """Rows of ``docs`` without a significant toxic passage or scored below the threshold, all columns kept.

    Null and empty texts hold no passage and are kept, as are null ids and repeated rows. A model
    without evidence, for want of labels of both classes or of telling tokens, keeps all.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = WordScores(model.tokens)
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
            keep = [not model.is_toxic(*model.segments(t or "", scores)) for t in texts]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return map_batches(docs, work, docs.schema)
