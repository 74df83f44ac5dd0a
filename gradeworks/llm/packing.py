"""Best-fit packing of token pieces into sequences, certified by lower bounds.

Pieces are dealt at random into groups of a few thousand, and each group is packed by best-fit
decreasing. Dual-feasible functions give a lower bound of a group's bin count; the bins of a
group that meets it stay, but for the emptiest one, which only pays for rounding. A group with
a gap gives up its emptiest bins as well. What was given up by all groups is dealt again and
repacked, until the bound of the whole input is met, one group is left, or nothing improves.
"""

from __future__ import annotations

import math
import os
import re
from collections.abc import Iterator
from itertools import chain
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gradeworks.llm.common import arrow_schema, as_batch, empty_like, map_batches
from gradeworks.session import stage

TOKENIZER = "word_bpe_49k.json"
CAPACITY = 4096
END_ID = 1
GROUP_ROWS = 8192
MAX_STORED = 500_000
ROWS_AT_ONCE = 10_000
WORDS_AT_ONCE = 250_000
# white space to every reader of the vocabulary, so no token crosses it
WORD = re.compile(r"[^ \n\t\r]+")
PIECES_SCHEMA = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


# letters that all steps of the tokenizer lower alike, then marks that form a token run of their own
PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,!?;:*#&%$|]*)\Z")
WORD_END = "</w>"
STEMS_AT_ONCE = 1000


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts, one after another, and how many each text has; a null text has none."""
    texts = pc.fill_null(texts, "")
    # two kinds of white space are parts of words here, so texts with them are split apart
    if pc.any(pc.match_substring_regex(texts, "[\x0b\x0c]")).as_py():
        split = [WORD.findall(t) for t in texts.to_pylist()]
        return pa.array(chain.from_iterable(split), pa.string()), np.array([len(w) for w in split], np.int64)
    parts = pc.ascii_split_whitespace(texts)
    ends = parts.offsets.to_numpy().astype(np.int64)
    words = parts.flatten()
    held = pc.binary_length(words).to_numpy() > 0
    before = np.concatenate([[0], np.cumsum(held)])
    ends -= ends[0]
    return words.filter(pa.array(held)), before[ends[1:]] - before[ends[:-1]]


class WordIds:
    """Little-endian ids of words; those of their parts are kept in bounded memory, since texts repeat them.

    A plain word is a stem of letters in lower case and a tail of marks. Both are units to the
    tokenizer, whatever stands beside them, so they are encoded once for all words that share
    them, many at a time; the word-end mark tells where the next one begins.
    """

    def __init__(self, name: str):
        import public_tokenizers
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith(WORD_END)]] = True
        self.units: dict[str, bytes] = {"": b""}

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after another, and how many each text has."""
        words, sizes = split_words(texts)
        coded = words.dictionary_encode()
        # each distinct word is looked at once; the ids of all words are then copied together
        held = self.ids_of(coded.dictionary.to_pylist())
        lengths = np.fromiter(map(len, held), np.int64, len(held)) // 4
        starts = np.cumsum(lengths) - lengths
        table = np.frombuffer(b"".join(held), "<u4")
        number = coded.indices.to_numpy()
        out = []
        for part in (number[i : i + WORDS_AT_ONCE] for i in range(0, len(number), WORDS_AT_ONCE)):
            n = lengths[part]
            ends = np.cumsum(n)
            out.append(table[np.arange(ends[-1]) + np.repeat(starts[part] - (ends - n), n)])
        counts = np.concatenate([[0], np.cumsum(lengths[number])])[np.concatenate([[0], np.cumsum(sizes)])]
        return np.concatenate(out) if out else table[:0], np.diff(counts)

    def ids_of(self, words: list[str]) -> list[bytes]:
        """Ids of distinct words as bytes."""
        if len(self.units) > MAX_STORED:
            self.units = {"": b""}
        units, out = self.units, []
        split = [m and (m[1].lower(), m[2]) for m in map(PLAIN.match, words)]
        new = list({u for pair in split if pair for u in pair if u not in units})
        for i in range(0, len(new), STEMS_AT_ONCE):
            self.add_units(new[i : i + STEMS_AT_ONCE])
        odd = self.alone([w for w, pair in zip(words, split, strict=True) if not pair])
        for word, pair in zip(words, split, strict=True):
            out.append(units[pair[0]] + units[pair[1]] if pair else odd[word])
        return out

    def alone(self, words: list[str]) -> dict[str, bytes]:
        found = self.tokenizer.encode_batch_fast(words, add_special_tokens=False)
        return {w: np.array(e.ids, dtype="<u4").tobytes() for w, e in zip(words, found, strict=True)}

    def add_units(self, units: list[str]) -> None:
        (found,) = self.tokenizer.encode_batch_fast([" ".join(units)], add_special_tokens=False)
        ids = np.array(found.ids, dtype="<u4")
        stops = (4 * (np.nonzero(self.ends[ids])[0] + 1)).tolist()
        if len(stops) != len(units) or (stops and stops[-1] != 4 * len(ids)):
            # a vocabulary without word ends
            self.units.update(self.alone(units))
            return
        data = ids.tobytes()
        for unit, start, stop in zip(units, [0, *stops], stops, strict=False):
            self.units[unit] = data[start:stop]


def tokenize(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str = TOKENIZER, keep_ids: bool = False) -> DataFrame:
    """Pieces of at most ``capacity`` ids of every whole text of ``docs`` (doc_id, text).

    A text's ids end with ``END_ID``; a null text is empty, so it is one piece of one id. Only
    longer texts are cut. ``start`` counts the ids before a piece; ``ids_crc32`` is of the
    little-endian unsigned 32-bit ids; ``keep_ids`` adds the ids. Null ids of documents and
    repeated rows are kept; other columns are left out.
    """
    ddl = PIECES_SCHEMA + (", ids array<int>" if keep_ids else "")
    schema = arrow_schema(ddl)
    end = END_ID.to_bytes(4, "little")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordIds(tokenizer)
        for batch in batches:
            ids, counts = words.encode(batch.column(1))
            out, first = [], 0
            for doc_id, n in zip(batch.column(0).to_pylist(), counts.tolist(), strict=True):
                data = ids[first : first + n].tobytes() + end
                first += n
                for piece, at in enumerate(range(0, len(data), 4 * capacity)):
                    own = data[at : at + 4 * capacity]
                    row = (doc_id, piece, at // 4, len(own) // 4, crc32(own))
                    out.append((*row, np.frombuffer(own, "<u4").astype("i4").tolist()) if keep_ids else row)
            for i in range(0, len(out), ROWS_AT_ONCE):
                yield as_batch(out[i : i + ROWS_AT_ONCE], schema)

    return map_batches(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), work, ddl)


def dual_bound(lengths: np.ndarray, counts: np.ndarray, capacity: int) -> int:
    """Least number of bins by dual-feasible functions of Fekete and Schepers, in whole numbers.

    The functions are x itself, its roundings with k + 1 steps, and x with parts below a limit
    taken as nothing and those above its complement as a whole bin.
    """
    if not len(lengths):
        return 0
    order = np.argsort(lengths)
    x, n = lengths[order].astype(object), counts[order].astype(object)
    total = int((x * n).sum())
    best = -(-total // capacity)
    for k in range(1, 41):
        steps = (k + 1) * x
        value = np.where(steps % capacity == 0, k * x, capacity * (steps // capacity))
        best = max(best, -(-int((value * n).sum()) // (k * capacity)))
    # parts of a limit and more up to its complement count as they are
    plain = np.concatenate([[0], np.cumsum(x * n)])
    number = np.concatenate([[0], np.cumsum(n)])
    sizes = x.astype(np.int64)
    for limit in [int(v) for v in sizes if 2 * v <= capacity]:
        low, high = np.searchsorted(sizes, limit), np.searchsorted(sizes, capacity - limit, side="right")
        whole = int(number[-1] - number[high]) * capacity + int(plain[high] - plain[low])
        best = max(best, -(-whole // capacity))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bin, offset) of each length, and the fill of each bin.

    Open bins are stacked by their free space. The spaces in use are bits of one number, whose
    lowest bit from a length on is the tightest fit.
    """
    order = np.argsort(-lengths, kind="stable")
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    stacks: dict[int, list[int]] = {}
    spaces, fills = 0, []
    for i in order.tolist():
        length = int(lengths[i])
        fitting = spaces >> length
        if fitting:
            space = length + (fitting & -fitting).bit_length() - 1
            stack = stacks[space]
            b = stack.pop()
            if not stack:
                spaces ^= 1 << space
        else:
            space, b = capacity, len(fills)
            fills.append(0)
        bins[i], offsets[i] = b, fills[b]
        fills[b] += length
        left = space - length
        if left:
            stacks.setdefault(left, []).append(b)
            spaces |= 1 << left
    return bins, offsets, np.array(fills, np.int64)


def given_up(fills: np.ndarray, bound: int, capacity: int) -> np.ndarray:
    """Which bins are dealt again: the emptiest one, and with a gap enough of them to close it."""
    gap = len(fills) - bound
    order = np.argsort(fills, kind="stable")
    slack = np.cumsum(capacity - fills[order])
    wanted = 1 if not gap else int(np.searchsorted(slack, 2 * (gap + 1) * capacity)) + 1
    out = np.zeros(len(fills), bool)
    out[order[:wanted]] = True
    return out & (fills < capacity)


def pack(pieces: DataFrame, capacity: int = CAPACITY, group_rows: int = GROUP_ROWS, max_rounds: int = 12) -> DataFrame:
    """Add ``sequence_id`` and ``offset``, gapless from 0 in each sequence, to stored ``pieces``.

    ``length`` must be 1 to ``capacity``. Groups have about ``group_rows`` rows however the
    pieces are distributed; the driver gets counts per length, of which there are at most
    ``capacity``. A round that leaves more or as many sequences is dropped, so the result is
    never worse than the first packing. No pieces give no rows.
    """
    spark = pieces.sparkSession
    schema = T.StructType([*pieces.schema.fields, *T._parse_datatype_string("sequence_id long, offset long, _again boolean").fields])
    counted = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    rows = sum(counted.values())
    if not rows:
        return empty_like(spark, schema).drop("_again")
    bound = dual_bound(np.array(list(counted)), np.array(list(counted.values())), capacity)

    def packed(pending: DataFrame, number: int, groups: int) -> DataFrame:
        def place(key: tuple, table: pa.Table) -> pa.Table:
            lengths = table.column("length").to_numpy()
            bins, offsets, fills = best_fit_decreasing(lengths, capacity)
            values, n = np.unique(lengths, return_counts=True)
            again = given_up(fills, dual_bound(values, n, capacity), capacity)
            first = (number << 56) + (key[0].as_py() << 20)
            out = table.drop_columns(["_group"])
            out = out.append_column("sequence_id", pa.array(first + bins))
            return out.append_column("offset", pa.array(offsets)).append_column("_again", pa.array(again[bins]))

        # stored rows come in the same order again, so a lost task deals its rows alike
        group = F.pmod(F.xxhash64(F.lit(number), F.monotonically_increasing_id()), F.lit(groups))
        return stage(pending.withColumn("_group", group).groupBy("_group").applyInArrow(place, schema), "packed")

    def sequences(placed: DataFrame) -> int:
        return placed.where("offset = 0").count()

    kept: list[DataFrame] = []
    pending, n_kept, previous = pieces, 0, None
    for number in range(max_rounds):
        groups = math.ceil(rows / group_rows)
        placed = packed(pending, number, groups)
        n_placed = sequences(placed)
        if previous is not None and n_placed >= previous[1]:
            kept.append(previous[0])
            break
        again = placed.where("_again")
        rows = again.count()
        if groups == 1 or not rows or n_kept + n_placed == bound or number == max_rounds - 1:
            kept.append(placed)
            break
        n_again = sequences(again)
        kept.append(placed.where("not _again"))
        n_kept += n_placed - n_again
        previous = (again, n_again)
        pending = again.drop("sequence_id", "offset", "_again")
    out = kept[0]
    for part in kept[1:]:
        out = out.unionByName(part)
    return out.drop("_again")


def sequences_of(packed: DataFrame) -> DataFrame:
    """One row per sequence of packed pieces with their ids: the ids in order and the documents."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "ids")))
    return (
        packed.groupBy("sequence_id")
        .agg(parts.alias("parts"))
        .select("sequence_id", F.flatten("parts.ids").alias("ids"), F.col("parts.doc_id").alias("doc_ids"))
    )


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str = TOKENIZER) -> DataFrame:
    """Tokenize ``docs`` (doc_id, text) and pack their pieces; one row per piece."""
    return pack(stage(tokenize(docs, capacity, tokenizer), "pieces"), capacity)
