"""Benchmark decontamination by templates.

Texts become sequences of template tokens: words in lower case, with numbers, names and units
replaced by typed placeholders. Windows of templates are hashed and joined with those of the
benchmark, so a question with other numbers or names still meets its item. Windows on the same
diagonal (place in the text less place in the item) form an alignment, and the values that fill
its slots must be consistent: one value of the item always stands for one value of the text,
and two names never for the same one.

Words that may be names or not, capitalised ones at the start of a sentence and those that are
names inside a sentence of an item, are hashed in both readings, in every combination that
leaves enough plain words. A window is also hashed with all its values as plain words, so that
a copy is found whatever its case and however few of its words are plain.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gradeworks.llm.common import arrow_schema, as_batch, free_names, map_batches
from gradeworks.session import broadcast_if_small, stage

# scripts written without spaces between words, whose characters are tokens of their own
UNSPACED = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30fa\u30fc-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
LETTER = rf"[^\W\d_{UNSPACED}]"
TOKEN = re.compile(rf"{LETTER}+(?:['’]{LETTER}+)*|\d+(?:[.,]\d+)*|[%$€£°]|[.!?。！？\n]|(?=[^\W\d_])[{UNSPACED}]")
SENTENCE_MARKS, SYMBOLS = frozenset(".!?。！？\n"), frozenset("%$€£°")
UNITS = frozenset(
    "% $ € £ ° mm cm m km in ft yd mi mg g kg lb oz ml cl l gal ms s sec min h hr hrs kb mb gb tb hz khz mhz ghz w kw kwh v "
    "percent cent cents dollar dollars euro euros pound pounds meter meters metre metres kilometer kilometers kilometre "
    "kilometres mile miles inch inches foot feet gram grams kilogram kilograms liter liters litre litres second seconds "
    "minute minutes hour hours day days week weeks month months year years degree degrees".split()
)
MAX_KNOWN_WORDS = 200_000
BITMAP_BITS = 22
CHUNK_TOKENS, CHUNK_PLACES = 20_000, 1 << 16
BASE = np.uint64(0x9E3779B97F4A7C15)
WORD, NUMBER, NAME, UNIT, MARK = range(5)
WINDOWS_SCHEMA = "id bigint, text_hash bigint, place bigint, size int, window bigint, open boolean, slots array<string>"


@dataclass(frozen=True)
class TemplateOptions:
    """``width`` template tokens make a window; an item shorter than that is one window.

    Windows with at least ``min_literals`` plain words are open: other values may stand in their
    slots. The others are met by the same values only. ``min_share`` is the part of an item's
    windows, or of its open ones, that a text must hold.
    """

    width: int = 8
    min_literals: int = 4
    min_share: float = 0.5


def _hash(token: str) -> int:
    return xxhash.xxh3_64_intdigest(token)


PLACEHOLDERS = {NUMBER: _hash("<number>"), NAME: _hash("<name>"), UNIT: _hash("<unit>")}


# a hash that no token has in practice, for tokens that no item holds
FOREIGN = _hash("\0")


class Words(dict):
    """Number of a token as written, with its kind and hash inside a sentence, at its start, and as a plain word.

    The last kind is 1 for words whose lower form is one of ``names``. With a ``vocabulary``, the
    hash bits of the items' tokens, a token that cannot be in an item needs no hash, so all plain
    words of that sort, all names and all numbers share one number each.
    """

    def __init__(self, names: frozenset[int] = frozenset(), vocabulary: bytes | None = None):
        super().__init__()
        self.names, self.vocabulary = names, vocabulary
        self.reset()

    def reset(self) -> None:
        self.clear()
        # only of words that the reader has not taken over yet; the first three are those of tokens in no item
        self.kinds: list[tuple[int, ...]] = [(WORD, WORD, WORD, 0, 0), (NAME, WORD, WORD, 0, 0), (NUMBER, NUMBER, WORD, 0, 0)]
        self.hashes: list[tuple[int, int, int]] = [
            (FOREIGN, FOREIGN, FOREIGN), (PLACEHOLDERS[NAME], FOREIGN, FOREIGN), (PLACEHOLDERS[NUMBER], PLACEHOLDERS[NUMBER], FOREIGN),
        ]
        self.n = len(self.kinds)

    def __missing__(self, token: str) -> int:
        low = token.lower()
        exact = xxhash.xxh3_64_intdigest(low)
        named = token != low and len(token) > 1 and token[0].isupper() and not token.isupper()
        held = self.vocabulary is None or self.vocabulary[exact >> 64 - BITMAP_BITS]
        if not held and low not in UNITS and token not in SENTENCE_MARKS:
            number = self[token] = 2 if token[0].isdigit() else 1 if named else 0
            return number
        number = self[token] = self.n
        self.n += 1
        if token in SENTENCE_MARKS:
            kind = MARK
        elif token[0].isdigit():
            kind = NUMBER
        elif low in UNITS:
            kind = UNIT
        else:
            kind = WORD
        plain = PLACEHOLDERS.get(kind) or exact
        named = named and kind == WORD
        self.kinds.append((NAME if named else kind, kind, UNIT if token in SYMBOLS else WORD, int(exact in self.names), int(held)))
        self.hashes.append((PLACEHOLDERS[NAME] if named else plain, plain, exact))
        return number


@dataclass(frozen=True)
class Template:
    """Tokens of a text without sentence marks: ``kept`` are their places in ``read``.

    ``hashes`` read words that may be names, which ``maybe`` marks, as plain words; ``exact``
    reads every token so. ``foreign`` marks plain words that are in no item.
    """

    read: list[str]
    kept: np.ndarray
    kinds: np.ndarray
    hashes: np.ndarray
    exact: np.ndarray
    maybe: np.ndarray
    foreign: np.ndarray

    def token(self, place: int) -> str:
        return self.read[self.kept[place]]

    @property
    def tokens(self) -> list[str]:
        return [self.read[i] for i in self.kept]


class Reader:
    """Turns texts into templates; what is known of a token is kept in arrays that grow with it."""

    def __init__(self, names: frozenset[int] = frozenset(), vocabulary: bytes | None = None):
        self.words = Words(names, vocabulary)
        self.filled = 0
        self.kinds = np.zeros((1024, 5), np.int8)
        self.hashes = np.zeros((1024, 3), np.uint64)

    def read(self, text: str) -> Template:
        words = self.words
        if len(words) > MAX_KNOWN_WORDS:
            words.reset()
            self.filled = 0
        tokens = TOKEN.findall(text)
        numbers = np.fromiter(map(words.__getitem__, tokens), np.int64, len(tokens))
        self.fill()
        marks = self.kinds[numbers, 1] == MARK
        # column 1 holds what a token is at the start of a sentence, where names look like words
        starts = np.ones(len(tokens), np.int64)
        starts[1:] = marks[:-1]
        # a word like "m" or "in" is a unit only right after a number; symbols always are
        after_number = np.zeros(len(tokens), bool)
        after_number[1:] = self.kinds[numbers[:-1], 1] == NUMBER
        starts[(self.kinds[numbers, 1] == UNIT) & ~after_number & (self.kinds[numbers, 2] == WORD)] = 2
        keep = np.nonzero(~marks)[0]
        chosen, column = numbers[keep], starts[keep]
        kinds = self.kinds[chosen, column]
        at_start = (column == 1) & (self.kinds[chosen, 0] == NAME)
        maybe = (kinds == WORD) & (at_start | (self.kinds[chosen, 3] == 1))
        foreign = (kinds == WORD) & ~maybe & (self.kinds[chosen, 4] == 0)
        return Template(tokens, keep, kinds, self.hashes[chosen, column], self.hashes[chosen, 2], maybe, foreign)

    def fill(self) -> None:
        """Take over what is new in ``words``; the arrays double, so a word is copied a few times at most."""
        known, n = self.filled, self.words.n
        if n > len(self.kinds):
            self.kinds = np.resize(self.kinds, (2 * n, 5))
            self.hashes = np.resize(self.hashes, (2 * n, 3))
        if n > known:
            self.kinds[known:n] = self.words.kinds
            self.hashes[known:n] = np.array(self.words.hashes, np.uint64)
            self.words.kinds.clear()
            self.words.hashes.clear()
            self.filled = n


def sums_at(hashes: np.ndarray, places: np.ndarray, width: int) -> np.ndarray:
    """Sums of ``width`` token hashes from each place on, times powers of ``BASE``."""
    out = np.zeros(len(places), np.uint64)
    for j in range(width):
        out = out * BASE + hashes[places + j]
    return out


def mixed(sums: np.ndarray) -> np.ndarray:
    out = sums ^ (sums >> np.uint64(31))
    out *= np.uint64(0xBF58476D1CE4E5B9)
    out ^= out >> np.uint64(29)
    return out.view(np.int64)


def window_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` tokens, as signed numbers."""
    return mixed(sums_at(hashes, np.arange(max(0, len(hashes) - width + 1)), width))


def bit_of(windows: np.ndarray) -> np.ndarray:
    return windows.view(np.uint64) >> np.uint64(64 - BITMAP_BITS)


class Chunk:
    """Templates of some texts on end, whose windows are hashed together."""

    def __init__(self, rows: list[tuple[int | None, int, Template]]):
        self.rows = rows
        templates = [t for *_, t in rows]
        lengths = np.array([len(t.kinds) for t in templates])
        ends = np.cumsum(lengths)
        self.starts = ends - lengths
        self.owner = np.repeat(np.arange(len(rows)), lengths)
        self.end = np.repeat(ends, lengths)
        self.alone = np.repeat(lengths == 1, lengths)
        self.kinds = np.concatenate([t.kinds for t in templates])
        self.hashes = np.concatenate([t.hashes for t in templates])
        self.exact = np.concatenate([t.exact for t in templates])
        self.maybe = np.concatenate([t.maybe for t in templates])
        self.foreign = np.concatenate([[0], np.cumsum(np.concatenate([t.foreign for t in templates]))])
        # what a window's sum gains where a word is read as a name
        self.gain = np.where(self.maybe, np.uint64(PLACEHOLDERS[NAME]) - self.hashes, np.uint64(0))
        self.filled = np.concatenate([[0], np.cumsum(self.kinds != WORD)])

    def readings(self, size: int, min_literals: int) -> Iterator[tuple[np.ndarray, np.ndarray, tuple[int, ...] | None]]:
        """(places, windows, offsets of words read as names); None for offsets: all values are read as plain words."""
        every = np.nonzero(np.arange(len(self.kinds)) + size <= self.end)[0]
        # a plain word of no item keeps a window from meeting one in any reading
        every = every[self.foreign[every + size] == self.foreign[every]]
        powers = np.array([pow(int(BASE), size - 1 - j, 1 << 64) for j in range(size)], np.uint64)

        def named(places, sums, room, offsets):
            for j in range(offsets[-1] + 1 if offsets else 0, size):
                hit = np.nonzero(self.maybe[places + j] & (room > 0))[0]
                if len(hit):
                    at = places[hit]
                    more = sums[hit] + self.gain[at + j] * powers[j]
                    yield at, mixed(more), (*offsets, j)
                    yield from named(at, more, room[hit] - 1, (*offsets, j))

        for first in range(0, len(every), CHUNK_PLACES):
            places = every[first : first + CHUNK_PLACES]
            slots = self.filled[places + size] - self.filled[places]
            room = size - min_literals - slots
            # a single token is no passage of a longer text
            closed = ((slots > 0) | (room < 0)) & ((size > 1) | self.alone[places])
            yield places[closed], mixed(sums_at(self.exact, places[closed], size)), None
            places, room = places[room >= 0], room[room >= 0]
            sums = sums_at(self.hashes, places, size)
            yield places, mixed(sums), ()
            yield from named(places, sums, room, ())

    def windows(self, size: int, min_literals: int, bitmap: np.ndarray | None) -> Iterator[tuple]:
        """Rows of ``WINDOWS_SCHEMA`` that the bitmap lets through."""
        for places, windows, names in self.readings(size, min_literals):
            if bitmap is not None:
                let = bitmap[bit_of(windows)]
                places, windows = places[let], windows[let]
            for at, window in zip(places.tolist(), windows.tolist(), strict=True):
                owner = self.owner[at]
                key, text_hash, t = self.rows[owner]
                place, kinds = at - int(self.starts[owner]), self.kinds[at : at + size]
                slots = []
                if names is not None:
                    # the kind goes with the value, since only names must differ from each other
                    letters = ["" if k == WORD else "N" if k == NAME else "V" for k in kinds]
                    for j in names:
                        letters[j] = "A"
                    slots = [f"{letter}{t.token(place + j).lower()}" for j, letter in enumerate(letters) if letter]
                literals = int((kinds == WORD).sum())
                yield key, text_hash, place, size, window, literals >= min_literals, slots


def window_rows(
    texts: DataFrame, sizes: list[int], names: frozenset[int], min_literals: int, bitmap: np.ndarray | None, shorter: bool, vocabulary: bytes | None = None
) -> DataFrame:
    """Windows of ``texts`` (id, text, text_hash), of all ``sizes`` and in all readings, that the bitmap lets through.

    With ``shorter``, a text of fewer tokens than the only size is one window of its length.
    Slots carry the values of the placeholders, ``N`` before names, ``A`` before words that may
    be names, ``V`` before others. ``open`` tells that a window has ``min_literals`` plain words.
    """
    schema = arrow_schema(WINDOWS_SCHEMA)

    def cut(rows: list[tuple[int | None, int, Template]]) -> Iterator[pa.RecordBatch]:
        groups: dict[int, list] = {}
        for row in rows:
            for size in [min(sizes[0], len(row[2].kinds))] if shorter else sizes:
                groups.setdefault(size, []).append(row)
        chunks = {size: Chunk(group) for size, group in groups.items()} if shorter else dict.fromkeys(groups, Chunk(rows) if rows else None)
        for size, chunk in chunks.items():
            out = list(chunk.windows(size, min_literals, bitmap))
            if out:
                yield as_batch(out, schema)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(names, vocabulary)
        rows, tokens = [], 0
        for batch in batches:
            for key, text, text_hash in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                t = reader.read(text) if text else None
                if t is None or not len(t.kinds):
                    continue
                rows.append((key, text_hash, t))
                tokens += len(t.kinds)
                if tokens >= CHUNK_TOKENS:
                    yield from cut(rows)
                    rows, tokens = [], 0
        yield from cut(rows)

    return map_batches(texts, work, WINDOWS_SCHEMA)


def words_in(texts: DataFrame) -> tuple[frozenset[int], bytes]:
    """Hashes of the lower forms of all names inside sentences of ``texts``, and the hash bits of all tokens.

    The bits are a table of fixed size.
    """
    ddl = "hash bigint, name boolean"
    schema = arrow_schema(ddl)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader()
        for batch in batches:
            names, bits = set(), set()
            for t in (reader.read(text) for text in batch.column(1).to_pylist() if text):
                names.update(t.exact[t.kinds == NAME].view(np.int64).tolist())
                bits.update(bit_of(t.exact.view(np.int64)).tolist())
            yield as_batch([*((n, True) for n in names), *((n, False) for n in bits)], schema)

    rows = map_batches(texts, work, ddl).distinct().toPandas()
    named = rows["name"].to_numpy(bool)
    hashes = rows["hash"].to_numpy(np.int64)
    vocabulary = np.zeros(1 << BITMAP_BITS, np.uint8)
    vocabulary[hashes[~named]] = 1
    return frozenset(hashes[named].view(np.uint64).tolist()), vocabulary.tobytes()


def find_leaks(docs: DataFrame, benchmark: DataFrame, options: TemplateOptions = TemplateOptions()) -> DataFrame:
    """(doc_id, text_hash, item_id, n_windows, item_windows, share) of texts that hold an item.

    ``docs`` has doc_id and text, ``benchmark`` item_id and text. Whole texts are read. Windows
    that cannot be in the benchmark are dropped by a bitmap of fixed size; the others are
    joined by hash. Copies of every item are found, of an item of one token only as a whole
    text; items without a letter or digit have no tokens. Counts and share are those of all
    windows or of the open ones, whichever share is greater. Null and empty texts hold nothing
    and rows with a null item_id are left out. Equal items are found each; repeated documents
    give one row; null ids of documents are kept.

    A word of the item that is surely a name or value and stands for two of the text, or two
    names for one, tear an alignment; windows in which a word that may be a name does so are
    not counted in that reading.
    """
    items = benchmark.where(F.col("item_id").isNotNull()).select(F.col("item_id").cast("bigint").alias("id"), "text", F.lit(0).cast("bigint").alias("text_hash"))
    names, vocabulary = words_in(items)
    known = stage(window_rows(items, [options.width], names, options.min_literals, None, True), "benchmark-windows")
    totals = known.select(F.col("id").alias("item_id"), "place", F.col("open").cast("int").alias("open")).distinct()
    totals = totals.groupBy("item_id").agg(F.count(F.lit(1)).alias("all_windows"), F.sum("open").alias("open_windows"))
    sizes = sorted((r["size"] for r in known.select("size").distinct().collect()), reverse=True) or [options.width]
    bits = known.select(F.shiftrightunsigned("window", 64 - BITMAP_BITS).alias("bit")).distinct().toPandas()["bit"]
    bitmap = np.zeros(1 << BITMAP_BITS, bool)
    bitmap[bits.to_numpy(np.int64)] = True
    n_known = known.count()

    texts = docs.select(F.col("doc_id").cast("bigint").alias("id"), "text", F.xxhash64("text").alias("text_hash"))
    held = window_rows(texts, sizes, names, options.min_literals, bitmap, False, vocabulary).select(
        F.col("id").alias("doc_id"), "text_hash", F.col("place").alias("doc_place"), "size", "window", F.col("slots").alias("doc_slots")
    )
    theirs = known.select(
        F.col("id").alias("item_id"), F.col("place").alias("item_place"), "size", "window", "open", F.col("slots").alias("item_slots")
    )
    met = held.join(broadcast_if_small(theirs, n_known, 256), ["window", "size"])
    met = met.where(F.size("doc_slots") == F.size("item_slots"))
    met = met.withColumn("diagonal", F.col("doc_place") - F.col("item_place"))
    # slots meet in pairs: the item's value, the text's value, and whether both are sure
    sure = "s.item_slots not like 'A%' and s.doc_slots not like 'A%'"
    pair = f"named_struct('ours', regexp_replace(s.item_slots, '^A', 'N'), 'theirs', regexp_replace(s.doc_slots, '^A', 'N'), 'sure', {sure})"
    met = met.withColumn("pairs", F.expr(f"transform(arrays_zip(item_slots, doc_slots), s -> {pair})"))
    met = stage(met.drop("window", "size", "doc_place", "item_slots", "doc_slots"), "matched-windows")

    line = ["doc_id", "text_hash", "item_id", "diagonal"]
    pairs = met.select(*line, F.explode("pairs").alias("s")).groupBy(*line, "s.ours", "s.theirs").agg(F.max("s.sure").alias("sure"))
    forth, back = Window.partitionBy(*line, "ours"), Window.partitionBy(*line, "theirs")
    is_name, n_sure = F.col("ours").startswith("N"), F.sum(F.col("sure").cast("int"))
    pairs = pairs.select(
        *line,
        F.struct("ours", "theirs").alias("pair"),
        "sure",
        ((F.count(F.lit(1)).over(forth) > 1) | (is_name & (F.count(F.lit(1)).over(back) > 1))).alias("clash"),
        ((n_sure.over(forth) > 1) | (is_name & (n_sure.over(back) > 1))).alias("sure_clash"),
    )
    torn = pairs.where("clash").groupBy(*line).agg(
        F.max(F.expr("sure and sure_clash")).alias("torn"), F.collect_list(F.expr("if(sure, null, pair)")).alias("unsure")
    )
    whole = met.alias("m").join(
        torn.alias("t"),
        F.expr(
            "m.doc_id <=> t.doc_id and m.text_hash = t.text_hash and m.item_id = t.item_id and m.diagonal = t.diagonal"
            " and (t.torn or exists(m.pairs, s -> array_contains(t.unsure, named_struct('ours', s.ours, 'theirs', s.theirs))))"
        ),
        "left_anti",
    )
    places = whole.select("doc_id", "text_hash", "item_id", "item_place", F.col("open").cast("int").alias("open")).distinct()
    found = places.groupBy("doc_id", "text_hash", "item_id").agg(F.count(F.lit(1)).alias("n_all"), F.sum("open").alias("n_open"))
    found = found.join(totals, "item_id")
    by_open = F.expr("open_windows > 0 and n_open * all_windows >= n_all * open_windows")
    return (
        found.withColumn("n_windows", F.when(by_open, F.col("n_open")).otherwise(F.col("n_all")))
        .withColumn("item_windows", F.when(by_open, F.col("open_windows")).otherwise(F.col("all_windows")))
        .withColumn("share", F.col("n_windows") / F.col("item_windows"))
        .where(F.col("share") >= options.min_share)
        .select("doc_id", "text_hash", "item_id", "n_windows", "item_windows", "share")
    )


def drop_leaks(docs: DataFrame, benchmark: DataFrame, options: TemplateOptions = TemplateOptions()) -> DataFrame:
    """Rows of ``docs`` whose text holds no item of the benchmark, all columns kept.

    Null and empty texts hold nothing and are kept. Rows go by id and text, so another text
    under the same id stays.
    """
    id_, hash_ = free_names(docs, "leak_id", "leak_hash")
    leaks = find_leaks(docs, benchmark, options).select(F.col("doc_id").alias(id_), F.col("text_hash").alias(hash_)).distinct()
    leaks = stage(leaks, "leaks")
    same = docs["doc_id"].cast("bigint").eqNullSafe(F.col(id_)) & (F.xxhash64(docs["text"]) == F.col(hash_))
    return docs.join(broadcast_if_small(leaks, leaks.count(), 16), same, "left_anti")
