"""Stretches of words that repeat with a short period, and texts with one period of each kept.

A run of period q and at least max(24, 3q) words holds each of its words at least three times.
So a word with fewer occurrences in a segment cannot lie in a run there and splits it; the parts
are counted anew until no word is rare, and parts of fewer than 24 words are left out. The
surviving segments are scanned lag by lag. For a lag q from 8 on, a run holds two neighbouring
blocks that start at a multiple of q, so only those are compared, by hashes first; over all lags
these are n log n blocks. Smaller lags are compared word by word.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from hashlib import sha256
from itertools import chain
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradeworks.llm.common import arrow_schema, as_batch, map_batches

SHORTEST = 24  # words in a run, at least
TIMES = 3  # periods in a run, at least
# Lags below this are compared word by word: a run of such a lag is 24 words, more than three periods.
WORD_LAGS = SHORTEST // TIMES
# Rounds in which all segments of a batch are split together; what still splits is followed one by one.
SHARED_ROUNDS = 12
PRIME = (1 << 31) - 1
BASE = 1_000_003

RUNS_SCHEMA = (
    "doc_id bigint, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, "
    "runs_sha256 string, collapsed_sha256 string"
)


@dataclass(frozen=True, order=True)
class Run:
    """``length`` words from word ``start`` on whose smallest period is ``period``."""

    start: int
    period: int
    length: int

    @property
    def end(self) -> int:
        return self.start + self.length


class Codes(dict):
    """Numbers of words in order of their first use."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


def with_repeated_tail(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The words as read, or for every tenth id (by its CRC-32) with the tail replaced by repeats of its first words."""
    h = crc32(b"" if doc_id is None else str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (TIMES + g % 8)
    unit = words[a : a + p]
    return words[:a] + (unit * (-(-(n - a) // p)))[: n - a]


def split_rare(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[tuple[int, int]]:
    """Segments (start, end) of at least ``SHORTEST`` words in which every word occurs ``TIMES`` times or more.

    A word that is rarer in its segment lies in none of its runs and splits it, and the parts
    are looked at again until nothing splits. All segments are split together while many do;
    the few that go on are settled one by one.
    """
    settled: list[tuple[int, int]] = []
    for _ in range(SHARED_ROUNDS):
        long = ends - starts >= SHORTEST
        starts, ends = starts[long], ends[long]
        if not len(starts):
            return settled
        sizes = ends - starts
        offsets = np.cumsum(sizes) - sizes
        segment = np.repeat(np.arange(len(sizes)), sizes)
        places = np.arange(sizes.sum()) - np.repeat(offsets - starts, sizes)
        key = segment * (int(codes.max()) + 1) + codes[places]
        _, which, counts = np.unique(key, return_inverse=True, return_counts=True)
        cuts = np.flatnonzero(counts[which] < TIMES)
        touched = np.zeros(len(sizes), dtype=bool)
        touched[segment[cuts]] = True
        settled += zip(starts[~touched].tolist(), ends[~touched].tolist(), strict=True)
        # parts lie between a segment's start, its cuts and its end
        cut_places = places[cuts]
        borders_left = np.concatenate([starts[touched], cut_places + 1])
        borders_right = np.concatenate([cut_places, ends[touched]])
        starts, ends = np.sort(borders_left), np.sort(borders_right)
    for start, end in zip(starts.tolist(), ends.tolist(), strict=True):
        settled += settle(codes, start, end)
    return settled


def settle(codes: np.ndarray, start: int, end: int) -> Iterator[tuple[int, int]]:
    """The surviving parts of one segment, however deep it splits.

    Only the smaller parts of a split are counted anew; their counts are taken off the largest
    part's, so each word is counted a logarithmic number of times.
    """
    words = codes[start:end].tolist()
    where: dict[int, list[int]] = {}
    for place, word in enumerate(words, start):
        where.setdefault(word, []).append(place)
    counts = Counter(words)
    pending = [(start, end, counts, [w for w, n in counts.items() if n < TIMES])]
    while pending:
        left, right, counts, rare = pending.pop()
        if right - left < SHORTEST:
            continue
        cuts = sorted(p for w in rare for p in where[w][bisect_left(where[w], left) : bisect_left(where[w], right)])
        if not cuts:
            yield left, right
            continue
        parts = list(zip([left, *(c + 1 for c in cuts)], [*cuts, right], strict=True))
        largest = max(parts, key=lambda x: x[1] - x[0])
        changed = set()
        for part in parts:
            if part == largest:
                continue
            held = Counter(codes[part[0] : part[1]].tolist())
            if part[1] - part[0] >= SHORTEST:
                pending.append((*part, held, [w for w, n in held.items() if n < TIMES]))
            counts.subtract(held)
            changed.update(held)
        for cut in cuts:
            counts[int(codes[cut])] -= 1
        pending.append((*largest, counts, [w for w in changed if 0 < counts[w] < TIMES]))


def stretch(codes: np.ndarray, lag: int, left: int, right: int, low: int, high: int) -> tuple[int, int]:
    """The longest [start, end) within [low, high) that holds [left, right) and keeps period ``lag``."""
    step = 64
    while right < high:
        size = min(step, high - right)
        differs = codes[right : right + size] != codes[right - lag : right - lag + size]
        first = int(differs.argmax()) if differs.any() else size
        right += first
        if first < size:
            break
        step *= 2
    step = 64
    while left > low:
        size = min(step, left - low)
        differs = (codes[left - size : left] != codes[left - size + lag : left + lag])[::-1]
        first = int(differs.argmax()) if differs.any() else size
        left -= first
        if first < size:
            break
        step *= 2
    return left, right


def block_sums(codes: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """Running sums of code times a power of ``BASE``, and the powers, modulo ``PRIME``."""
    powers = np.ones(max(len(codes), longest) + 1, dtype=np.uint64)
    known = 1
    while known < len(powers):
        # the powers up to ``known`` times BASE ** known are the next ones
        factor = np.uint64(pow(BASE, known, PRIME))
        more = min(known, len(powers) - known)
        powers[known : known + more] = powers[:more] * factor % np.uint64(PRIME)
        known += more
    terms = (codes.astype(np.uint64) + np.uint64(1)) * powers[: len(codes)] % np.uint64(PRIME)
    sums = np.zeros(len(codes) + 1, dtype=np.uint64)
    np.cumsum(terms, out=sums[1:])
    return sums % np.uint64(PRIME), powers


def same_blocks(sums: np.ndarray, powers: np.ndarray, places: np.ndarray, lag: int) -> np.ndarray:
    """Whether the blocks of ``lag`` words at a place and right after it have equal hashes."""
    prime = np.uint64(PRIME)
    first = (sums[places + lag] + prime - sums[places]) % prime
    second = (sums[places + 2 * lag] + prime - sums[places + lag]) % prime
    return first * powers[lag] % prime == second


def runs_in(codes: np.ndarray, starts: Sequence[int], ends: Sequence[int]) -> list[Run]:
    """All runs inside the segments [start, end) of ``codes``, which are disjoint; runs cross no end of one."""
    order = sorted(range(len(starts)), key=lambda i: starts[i] - ends[i])
    if not order:
        return []
    # longest segments first, so that a lag reads only the front; a segment's place here and there differ by a shift
    sizes = np.array([ends[i] - starts[i] for i in order])
    fronts = np.cumsum(sizes)
    line = np.concatenate([codes[starts[i] : ends[i]] for i in order])
    tails = np.repeat(fronts, sizes)  # end of the segment of each place
    heads = np.repeat(fronts - sizes, sizes)
    covered = np.zeros(len(line) + 1, dtype=np.int64)  # the furthest end of a found run that starts here or before and holds this place
    found: list[tuple[int, int, int]] = []

    def keep(left: int, right: int, lag: int) -> None:
        found.append((left, right, lag))
        np.maximum(covered[left:right], right, out=covered[left:right])

    def new_run(left: int, right: int, lag: int) -> bool:
        # a stretch inside a run of a smaller period repeats with that period
        return right - left >= max(SHORTEST, TIMES * lag) and covered[left] < right

    longest = int(sizes[0])
    for lag in range(1, min(WORD_LAGS, longest)):
        same = (line[:-lag] == line[lag:]) & (tails[:-lag] == tails[lag:])
        edges = np.flatnonzero(np.diff(np.concatenate([[False], same, [False]]).astype(np.int8)))
        lengths = edges[1::2] - edges[::2]
        for k in np.flatnonzero(lengths >= SHORTEST - lag).tolist():
            left, right = int(edges[2 * k]), int(edges[2 * k + 1]) + lag
            if new_run(left, right, lag):
                keep(left, right, lag)
    sums, powers = block_sums(line, longest)
    n_long = np.searchsorted(-sizes, -TIMES * np.arange(longest // TIMES + 1), side="right")
    for lag in range(WORD_LAGS, longest // TIMES + 1):
        front = int(fronts[n_long[lag] - 1])
        places = np.arange(0, front - 2 * lag + 1, lag)
        places = places[line[places] == line[places + lag]]
        if not len(places):
            continue
        places = places[(tails[places] >= places + 2 * lag) & (covered[places] < places + 2 * lag)]
        places = places[same_blocks(sums, powers, places, lag)]
        done = -1
        for place in places.tolist():
            if place + 2 * lag <= done or covered[place] >= place + 2 * lag:
                continue
            if not np.array_equal(line[place : place + lag], line[place + lag : place + 2 * lag]):
                continue  # two blocks of one hash
            left, right = stretch(line, lag, place, place + 2 * lag, int(heads[place]), int(tails[place]))
            done = right
            if new_run(left, right, lag):
                keep(left, right, lag)
    shift = np.repeat([starts[i] for i in order], sizes) - heads
    return sorted(Run(left + int(shift[left]), lag, right - left) for left, right, lag in found)


def find_runs(words: Sequence[bytes]) -> list[Run]:
    """All runs of one text's words, by start, then period."""
    return runs_of_texts([words])[0]


def runs_of_texts(texts: Sequence[Sequence[bytes]]) -> list[list[Run]]:
    """The runs of each text, all texts scanned together."""
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    out: list[list[Run]] = [[] for _ in texts]
    if not sizes.sum():
        return out
    number = Codes()
    codes = np.fromiter(map(number.__getitem__, chain.from_iterable(texts)), np.int64, sizes.sum())
    ends = np.cumsum(sizes)
    segments = split_rare(codes, ends - sizes, ends)
    for run in runs_in(codes, [s for s, _ in segments], [e for _, e in segments]):
        text = int(np.searchsorted(ends, run.start, side="right"))
        out[text].append(Run(run.start - int(ends[text] - sizes[text]), run.period, run.length))
    return out


def collapsed(words: Sequence[bytes], runs: Sequence[Run]) -> list[bytes]:
    """The words without those that a run holds after its first period."""
    if not runs:
        return list(words)
    dropped = np.zeros(len(words) + 1, dtype=np.int64)
    for run in runs:
        dropped[run.start + run.period] += 1
        dropped[run.end] -= 1
    keep = np.cumsum(dropped[:-1]) == 0
    return [words[i] for i in np.flatnonzero(keep).tolist()]


def strongest(runs: Sequence[Run]) -> Run | None:
    """The run of the greatest exact length / period; of equal ones the first, then the shortest period."""
    best = None
    for run in runs:
        # runs come by start, then period, so only a greater one takes the place
        if best is None or run.length * best.period > best.length * run.period:
            best = run
    return best


def describe(doc_id: int | None, words: Sequence[bytes], runs: Sequence[Run]) -> tuple:
    listed = "".join(f"{r.start},{r.length},{r.period}\n" for r in runs)
    best = strongest(runs)
    figures = (best.start, best.length, best.period, 1000 * best.length // best.period) if best else (None,) * 4
    kept = b" ".join(collapsed(words, runs))
    return (doc_id, len(runs), *figures, sha256(listed.encode()).hexdigest(), sha256(kept).hexdigest())


def find_periodic_runs(docs: DataFrame, words_of=with_repeated_tail) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text) with its runs and a digest of the collapsed text.

    ``words_of`` may change a text's words before the scan, by its id; by default every tenth
    id's tail is made to repeat, a null id counting as an empty one. Whole texts are scanned.
    A null text has no words; texts without runs give nulls and the digests of nothing and of
    their own words. Null ids and repeated rows are kept, other columns are left out, an empty
    table stays empty. Of runs with equal exponents the first counts. Narrow: no row moves.
    """
    schema = arrow_schema(RUNS_SCHEMA)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = (c.to_pylist() for c in batch.columns)
            texts = [words_of((t or "").encode().split(), i) for i, t in zip(ids, texts, strict=True)]
            yield as_batch(map(describe, ids, texts, runs_of_texts(texts)), schema)

    return map_batches(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), work, RUNS_SCHEMA)


def collapse_runs(docs: DataFrame) -> DataFrame:
    """``docs`` with the repeats of every run taken out of ``text``; all rows and columns are kept.

    Words of changed texts are joined by one space; texts without runs, null and empty ones
    stay as they are.
    """
    at = docs.columns.index("text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).to_pylist()
            words = [(t or "").encode().split() for t in texts]
            cut = [
                b" ".join(collapsed(w, runs)).decode() if runs else t
                for t, w, runs in zip(texts, words, runs_of_texts(words), strict=True)
            ]
            yield batch.set_column(at, batch.schema.field(at), pa.array(cut, batch.schema.field(at).type))

    return map_batches(docs, work, docs.schema)
