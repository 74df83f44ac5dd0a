"""Scores of whole texts by a gated recurrent language model, and by smoothed word frequencies.

All training texts are counted and all are learned from, once. The network knows the most
frequent words, in classes of words that end alike; every other word belongs to a rare class,
by its last bytes, and has its smoothed share of that class. So each class is predicted from
the state, and every word of any text, seen or not, has a probability.

Learning is data-parallel: in each round every task goes on from the same weights over its part
of the round's texts, and the weights that come back are averaged by words read, in a tree of
small groups. As in any such training the weights depend on how the texts are dealt to tasks.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradeworks.llm.common import arrow_schema, as_batch, map_batches
from gradeworks.llm.recurrent_network import Lanes, Layout, Network
from gradeworks.session import stage

SMOOTHING = 0.1
ENDING = 3  # bytes of a word's end that decide its rare class
END_WORD = b""  # no word is empty, so this stands for the end of a text
LONG_WORDS = 2048
MERGED = 32  # sets of weights averaged at once

COUNTS_SCHEMA = "word binary, trained bigint, seen bigint"
ENCODED_SCHEMA = (
    "row bigint, doc_id bigint, held_out boolean, n_words bigint, n_known bigint, base double, inside double, "
    "items binary, rest array<binary>, rest_n array<bigint>"
)
SCORED_SCHEMA = "row bigint, doc_id bigint, held_out boolean, n_words bigint, n_known bigint, base double, inside double, network double"
MERGE_SCHEMA = "bucket bigint, n_words bigint, weights binary"


@dataclass(frozen=True)
class LanguageModelOptions:
    """``vocabulary`` words have weights, in classes of ``class_words``; all others are in ``rare_classes``.

    ``stored`` bounds the words, the most frequent of all texts, whose counts the tasks hold;
    the counts of the others are joined. The training texts are read in ``rounds`` parts.
    """

    vocabulary: int = 2048
    class_words: int = 64
    rare_classes: int = 32
    stored: int = 200_000
    hidden: int = 16
    width: int = 16
    lanes: int = 256
    window: int = 16
    rounds: int = 4
    seed: int = 42


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts, one after another, and how many each text has.

    Words are what is between ASCII white space, with only A-Z lowered; null is an empty text.
    """
    parts = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    ends = parts.offsets.to_numpy().astype(np.int64)
    words = parts.flatten().cast(pa.binary())
    held = pc.binary_length(words).to_numpy() > 0
    before = np.concatenate([[0], np.cumsum(held)])
    ends -= ends[0]
    return words.filter(pa.array(held)), before[ends[1:]] - before[ends[:-1]]


def is_held_out(doc_id: Column) -> Column:
    """Ids whose CRC-32 is divisible by 10 are not learned from; a null id counts as an empty one."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 10 == 0


def rare_class(word: bytes, n: int) -> int:
    return crc32(word[-ENDING:]) % n


def _rare_class(word: str, n: int) -> Column:
    return (F.crc32(F.expr(f"substring({word}, -{ENDING})")) % n).cast("int")


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, trained, seen): occurrences in training texts and in all; the end of texts is the empty word."""
    schema = arrow_schema(COUNTS_SCHEMA)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, sizes = split_words(batch.column(1))
            trained = ~batch.column(0).to_numpy(zero_copy_only=False).astype(bool)
            coded = words.dictionary_encode()
            number, distinct = coded.indices.to_numpy(), len(coded.dictionary)
            seen = np.bincount(number, minlength=distinct)
            learned = np.bincount(number[np.repeat(trained, sizes)], minlength=distinct)
            ends = [pa.array([END_WORD], pa.binary()), pa.array([int(trained.sum())], pa.int64()), pa.array([len(sizes)], pa.int64())]
            yield pa.RecordBatch.from_arrays([coded.dictionary, pa.array(learned, pa.int64()), pa.array(seen, pa.int64())], schema=schema)
            yield pa.RecordBatch.from_arrays(ends, schema=schema)

    rows = docs.select(is_held_out(F.col("doc_id")).alias("held_out"), "text")
    return map_batches(rows, count, COUNTS_SCHEMA).groupBy("word").agg(F.sum("trained").alias("trained"), F.sum("seen").alias("seen"))


@dataclass(frozen=True)
class Vocabulary:
    """Corpus totals, and the stored words with what a task needs of each."""

    n_tokens: int
    n_distinct: int
    n_ends: int
    words: list[bytes]
    counts: np.ndarray
    items: np.ndarray
    layout: Layout
    item_counts: np.ndarray
    rare_totals: np.ndarray  # the denominators of words inside rare classes
    least_step: int  # words of this step of frequency or above are stored

    @property
    def base_total(self) -> float:
        return self.n_tokens + SMOOTHING * (self.n_distinct + 1)

    def base_log(self, counts: np.ndarray) -> np.ndarray:
        """log10 of the smoothed frequency; without any training text every word is the one unseen word."""
        return np.log10((counts + SMOOTHING) / self.base_total)


def _step(seen: str) -> Column:
    """Steps of frequency, 16 per doubling."""
    return F.floor(16 * F.log2(seen)).cast("int")


def vocabulary(counts: DataFrame, options: LanguageModelOptions) -> Vocabulary:
    """Totals over all counted words, and the most frequent ones, whose number is bounded."""
    words = counts.where(F.col("word") != F.lit(END_WORD))
    total = counts.agg(F.sum("trained"), F.count_if(F.col("trained") > 0)).first()
    ends = counts.where(F.col("word") == F.lit(END_WORD)).first()
    steps = words.groupBy(_step("seen").alias("step")).agg(F.count(F.lit(1)).alias("n")).collect()
    least, room = 1 << 30, options.stored
    for r in sorted(steps, key=lambda r: -r["step"]):
        room -= r["n"]
        if room < 0:
            break
        least = r["step"]
    stored = words.where(_step("seen") >= least).select("word", "trained").collect()
    stored = sorted(((bytes(r["word"]), r["trained"]) for r in stored), key=lambda x: (-x[1], x[0]))
    frequent = [x for x in stored[: options.vocabulary] if x[1] > 0]
    # words with like endings share a class, which the state can tell from others
    ranked = sorted(frequent, key=lambda x: x[0][::-1])
    layout = Layout(len(ranked), options.class_words, options.rare_classes)
    item_of = {w: 1 + i for i, (w, _) in enumerate(ranked)}
    first_rare = 1 + layout.n_words
    rare = {
        r["rare"]: (r["n"], r["distinct"])
        for r in words.where(F.col("trained") > 0)
        .groupBy(_rare_class("word", options.rare_classes).alias("rare"))
        .agg(F.sum("trained").alias("n"), F.count(F.lit(1)).alias("distinct"))
        .collect()
    }
    n, distinct = np.zeros(options.rare_classes), np.zeros(options.rare_classes)
    for k, (a, b) in rare.items():
        n[k], distinct[k] = a, b
    for w, c in ranked:
        k = rare_class(w, options.rare_classes)
        n[k] -= c
        distinct[k] -= 1
    n_ends = ends["trained"] if ends else 0
    return Vocabulary(
        n_tokens=total[0] or 0,
        n_distinct=total[1],
        n_ends=n_ends,
        words=[w for w, _ in stored],
        counts=np.array([c for _, c in stored], dtype=np.int64),
        items=np.array([item_of.get(w) or first_rare + rare_class(w, options.rare_classes) for w, _ in stored], dtype=np.uint16),
        layout=layout,
        item_counts=np.concatenate([[n_ends], [c for _, c in ranked], n]).astype(float),
        rare_totals=n + SMOOTHING * (distinct + 1),
        least_step=least,
    )


class Numbers(dict):
    """Numbers of stored words; any other word is -1."""

    def __missing__(self, word: bytes) -> int:
        return -1


def encode(docs: DataFrame, known: Vocabulary) -> DataFrame:
    """Per row its items, the sums over its stored words, and its other words with their numbers."""
    spark, schema = docs.sparkSession, arrow_schema(ENCODED_SCHEMA)
    shipped = spark.sparkContext.broadcast(known)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = shipped.value
        number = Numbers(zip(v.words, range(len(v.words)), strict=True))
        n_rare, first_rare = v.layout.n_rare, 1 + v.layout.n_words
        # the last place of each table is that of words not stored, which are added later
        base = np.append(v.base_log(v.counts), 0.0)
        inside = np.zeros(len(base))
        rare = v.items >= first_rare
        inside[:-1][rare] = np.log10((v.counts[rare] + SMOOTHING) / v.rare_totals[v.items[rare] - first_rare])
        items, has = np.append(v.items, 0).astype(np.uint16), np.append(v.counts > 0, False)
        for batch in batches:
            rows, ids, held, texts = batch.columns
            words, sizes = split_words(texts)
            coded = words.dictionary_encode()
            distinct = coded.dictionary.to_pylist()
            number_of = np.fromiter(map(number.__getitem__, distinct), np.int64, len(distinct))
            place = coded.indices.to_numpy()
            numbers = number_of[place]
            item_of = items[number_of]
            others = np.flatnonzero(number_of < 0).tolist()
            item_of[others] = [first_rare + rare_class(distinct[i], n_rare) for i in others]
            raw = item_of[place].astype("<u2").tobytes()
            ends = np.cumsum(sizes)
            text = np.repeat(np.arange(len(sizes)), sizes)
            # each text's words that are not stored, once, with their numbers
            pairs, times = np.unique(text[numbers < 0] * max(len(distinct), 1) + place[numbers < 0], return_counts=True)
            offsets = np.searchsorted(pairs, np.arange(len(sizes) + 1) * max(len(distinct), 1)).astype(np.int32)
            rest = coded.dictionary.take(pa.array(pairs % max(len(distinct), 1)))
            columns = [
                rows, ids, held, pa.array(sizes, pa.int64()),
                *(pa.array(np.bincount(text, table[numbers], len(sizes)).astype(kind)) for table, kind in ((has, np.int64), (base, float), (inside, float))),
                pa.array([raw[2 * (e - n) : 2 * e] for e, n in zip(ends.tolist(), sizes.tolist(), strict=True)], pa.binary()),
                pa.ListArray.from_arrays(pa.array(offsets), rest),
                pa.ListArray.from_arrays(pa.array(offsets), pa.array(times, pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    doc_id = F.col("doc_id").cast("bigint")
    rows = docs.select(F.monotonically_increasing_id().alias("row"), doc_id.alias("doc_id"), is_held_out(doc_id).alias("held_out"), "text")
    return map_batches(rows, work, ENCODED_SCHEMA)


def rest_sums(encoded: DataFrame, counts: DataFrame, known: Vocabulary) -> DataFrame:
    """(row, rest_known, rest_base, rest_inside): sums over each row's words that are not stored.

    Words that very many rows hold are stored ones, so no word is hot in this join.
    """
    pairs = encoded.select("row", F.explode(F.arrays_zip(F.col("rest").alias("word"), F.col("rest_n").alias("n"))).alias("x")).select("row", "x.word", "x.n")
    others = counts.where((F.col("word") != F.lit(END_WORD)) & (_step("seen") < known.least_step)).select("word", "trained")
    joined = pairs.join(others, "word", "left")
    count = F.coalesce("trained", F.lit(0))
    totals = F.get(F.array(*[F.lit(float(x)) for x in known.rare_totals]), _rare_class("word", known.layout.n_rare))
    return joined.groupBy("row").agg(
        F.sum(F.when(count > 0, F.col("n")).otherwise(0)).alias("rest_known"),
        F.sum(F.col("n") * F.log10((count + SMOOTHING) / known.base_total)).alias("rest_base"),
        F.sum(F.col("n") * F.log10((count + SMOOTHING) / totals)).alias("rest_inside"),
    )


def lanes_of(batch: pa.RecordBatch, options: LanguageModelOptions) -> Lanes:
    held = batch.column("items").to_pylist()
    words = np.frombuffer(b"".join(held), "<u2").astype(np.int32)
    return Lanes(words, np.array([len(x) // 2 for x in held], dtype=np.int64), options.lanes)


def starting_network(known: Vocabulary, options: LanguageModelOptions) -> Callable[[], Network]:
    """Makes the network that learning starts from; holds the item counts only, not the words."""
    layout, item_counts = known.layout, known.item_counts
    return lambda: Network(layout, options.hidden, options.width, options.seed, item_counts)


def fit(encoded: DataFrame, known: Vocabulary, options: LanguageModelOptions) -> np.ndarray:
    """The weights after one pass over all training rows, in rounds; without any, those of the start."""
    spark, merge_schema = encoded.sparkSession, arrow_schema(MERGE_SCHEMA)
    begin = starting_network(known, options)
    weights = begin().flat()
    training = encoded.where(~F.col("held_out"))
    # a part takes as many steps as its longest text has words, so long texts share the last round
    last = F.lit(options.rounds - 1)
    turn = F.when(F.col("n_words") > LONG_WORDS, last).otherwise(F.pmod("row", F.lit(options.rounds)))

    def mean(table: pa.Table) -> pa.Table:
        total, summed = 0, None
        for n, raw in zip(table.column("n_words").to_pylist(), table.column("weights"), strict=True):
            part = np.frombuffer(raw.as_buffer(), np.float32).astype(float) * n
            total, summed = total + n, part if summed is None else summed + part
        bucket = table.column("bucket")[0].as_py() // MERGED
        return pa.Table.from_batches([as_batch([(bucket, total, (summed / total).astype(np.float32).tobytes())], merge_schema)])

    for round_ in range(options.rounds):
        shipped = spark.sparkContext.broadcast(weights)

        def learn(batches: Iterator[pa.RecordBatch], shipped=shipped) -> Iterator[pa.RecordBatch]:
            network, n = begin().load(shipped.value), 0
            for batch in batches:
                if batch.num_rows:
                    lanes = lanes_of(batch, options)
                    network.learn(lanes, options.window)
                    n += int(lanes.totals.sum())
            if n:
                yield as_batch([(TaskContext.get().partitionId() // MERGED, n, network.flat().astype(np.float32).tobytes())], merge_schema)

        rows = training.where(turn == round_).select("items")
        merged = map_batches(rows, learn, MERGE_SCHEMA)
        n_sets = encoded.rdd.getNumPartitions()
        while n_sets > 1:
            merged = merged.groupBy("bucket").applyInArrow(mean, MERGE_SCHEMA)
            n_sets = -(-n_sets // MERGED)
        found = merged.collect()
        if found:
            weights = np.frombuffer(found[0]["weights"], np.float32)
    return weights


def score_encoded(encoded: DataFrame, known: Vocabulary, weights: np.ndarray, options: LanguageModelOptions) -> DataFrame:
    """Rows with ``network``: the natural log probability of each text's classes, and of its words in word classes."""
    shipped, schema = encoded.sparkSession.sparkContext.broadcast(weights), arrow_schema(SCORED_SCHEMA)
    begin = starting_network(known, options)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network = begin().load(shipped.value)
        for batch in batches:
            logs = network.score(lanes_of(batch, options), options.window) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(schema) - 1], pa.array(logs)], schema=schema)

    return map_batches(encoded.select(*schema.names[:-1], "items"), work, SCORED_SCHEMA)


def score_documents(docs: DataFrame, options: LanguageModelOptions = LanguageModelOptions()) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text), with log10 probabilities of its whole text.

    ``base_score`` adds smoothed frequencies of the training texts' words, ``score`` is the
    network's. A null or empty text is its end alone; null ids count as empty ones and repeated
    rows are kept, each scored; other columns are left out; an empty table gives no rows.
    Without training rows every word is unseen and ``base_score`` is 0.
    """
    counts = stage(word_counts(docs), "lm-counts")
    known = vocabulary(counts, options)
    encoded = stage(encode(docs, known), "lm-encoded")
    weights = fit(encoded, known, options)
    scored = score_encoded(encoded, known, weights, options)
    rest = rest_sums(encoded, counts, known)
    end_log = float(known.base_log(np.array(known.n_ends)))

    def with_rest(own: str, rest: str) -> Column:
        return F.col(own) + F.coalesce(rest, F.lit(0))

    return scored.join(rest, "row", "left").select(
        "doc_id",
        "held_out",
        (F.col("n_words") + 1).alias("n_tokens"),
        (with_rest("n_known", "rest_known") + int(known.n_ends > 0)).alias("n_known"),
        F.lit(known.n_tokens).cast("bigint").alias("train_tokens"),
        (with_rest("base", "rest_base") + end_log).alias("base_score"),
        (with_rest("inside", "rest_inside") + F.col("network") / math.log(10)).alias("score"),
    )

