"""What five document filters remove, alone and in every order, by contractions of a count tensor.

Each document fails or passes five conditions, so the documents of a part are 2x2x2x2x2 counts,
one axis per filter. Every figure of every step of every order is a contraction of that tensor
with one selector per axis: pass (1, 0), fail (0, 1) or all (1, 1). The documents are read once,
whatever the number of orders.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import sha256
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradeworks.llm.common import arrow_schema, as_batch, map_batches, split_heavy_join
from gradeworks.session import stage

FILTERS = "ABCDE"
ORDERS = ["".join(order) for order in permutations(FILTERS)]
CELLS = 1 << len(FILTERS)
PASS, FAIL, ALL = (1, 0), (0, 1), (1, 1)

FEWEST_WORDS = 200
LEAST_DISTINCT_PERCENT = 50
MOST_CAPITALS_PERCENT = 2
MARKS = re.compile(rb"[#$%&*|]")
NOT_CAPITALS = bytes(b for b in range(256) if not 65 <= b <= 90)

FACTS_SCHEMA = "doc_id bigint, part string, digest binary, code int"
MEASURES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
AUDIT_SCHEMA = "part string, filter_order string, step int, " + ", ".join(f"{m} bigint" for m in MEASURES)


def bit(name: str) -> int:
    """The filter's bit in a cell's number; the first filter is the first axis."""
    return 1 << (len(FILTERS) - 1 - FILTERS.index(name))


def failures(text: str) -> int:
    """The conditions A to D that a text fails, as bits of its cell."""
    raw = text.encode()
    words = raw.split()  # at runs of the six ASCII white-space bytes
    code = bit("A") if len(words) < FEWEST_WORDS else 0
    if 100 * len(set(words)) < LEAST_DISTINCT_PERCENT * len(words):
        code |= bit("B")
    if 100 * len(raw.translate(None, NOT_CAPITALS)) > MOST_CAPITALS_PERCENT * len(text):
        code |= bit("C")
    if MARKS.search(raw):
        code |= bit("D")
    return code


def document_facts(docs: DataFrame) -> DataFrame:
    """(doc_id, part, digest, code) per row: its source, the SHA-256 of its text, its failures of A to D."""
    schema = arrow_schema(FACTS_SCHEMA)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, parts, texts = (c.to_pylist() for c in batch.columns)
            texts = [t or "" for t in texts]
            yield as_batch(
                ((i, p or "", sha256(t.encode()).digest(), failures(t)) for i, p, t in zip(ids, parts, texts, strict=True)), schema
            )

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("source").cast("string").alias("part"), "text")
    return map_batches(rows, work, FACTS_SCHEMA)


def cell_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, code, n, good, toxic): documents per part and cell of the five conditions.

    Copies are found by the smallest id of each digest. Only digests of several rows can hold
    one, and those of very many rows are broadcast, so no digest's rows meet in one task. Rows
    of an id are folded before the labels join, so that an id, or null, of very many rows is a
    few counts by then.
    """
    facts = stage(document_facts(docs), "audit-facts")
    copies = (
        facts.groupBy("digest")
        .agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > 1)
    )
    copies = stage(copies, "audit-copies")
    marked = split_heavy_join(facts, copies, ["digest"], "left", 64)
    repeats = F.coalesce(F.col("doc_id") > F.col("first_id"), F.lit(False))
    folded = marked.groupBy(
        "doc_id", "part", (F.col("code") + F.when(repeats, bit("E")).otherwise(0)).alias("code")
    ).agg(F.count(F.lit(1)).alias("n"))
    known = labels.groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")
    )
    return (
        folded.join(known, "doc_id", "left")
        .groupBy("part", "code")
        .agg(
            F.sum("n").alias("n"),
            F.sum(F.col("n") * F.coalesce("good", F.lit(0))).alias("good"),
            F.sum(F.col("n") * F.coalesce("toxic", F.lit(0))).alias("toxic"),
        )
    )


def selectors(steps: list[tuple[str, str]]) -> list[np.ndarray]:
    """One (steps x 2) array per axis for steps of (filters applied before, filter); the filter's own axis is fail."""

    def of(axis: str, before: str, name: str) -> tuple[int, int]:
        return FAIL if axis == name else PASS if axis in before else ALL

    return [np.array([of(axis, before, name) for before, name in steps], dtype=np.int64) for axis in FILTERS]


def contract(tensors: np.ndarray, chosen: list[np.ndarray]) -> np.ndarray:
    """Sums of (parts x 2x2x2x2x2) tensors under every step's selectors, as parts x steps."""
    return np.einsum("pabcde,sa,sb,sc,sd,se->ps", tensors, *chosen, optimize=True)


class Contractions:
    """Figures of all steps of all orders from the tensors of documents, good and toxic ones."""

    def __init__(self) -> None:
        self.steps = [(order[:k], order[k]) for order in ORDERS for k in range(len(FILTERS))]
        self.removed = selectors(self.steps)
        self.failing = selectors([("", name) for _, name in self.steps])
        self.alone = selectors([(FILTERS.replace(name, ""), name) for _, name in self.steps])
        # documents that pass what was applied so far, this step's filter included
        self.kept = [
            np.array([PASS if axis in before + name else ALL for before, name in self.steps], dtype=np.int64) for axis in FILTERS
        ]
        names = np.array([name for _, name in self.steps])
        self.same_filter = (names[:, None] == names[None, :]).astype(np.int64)

    def figures(self, n: np.ndarray, good: np.ndarray, toxic: np.ndarray) -> np.ndarray:
        """Parts x steps x measures, in the order of ``MEASURES``."""
        removed = contract(n, self.removed)
        out = [
            contract(n, self.kept),
            removed,
            contract(n, self.failing) - removed,
            contract(n, self.alone),
            contract(good, self.removed),
            contract(toxic, self.removed),
            removed @ self.same_filter,
        ]
        return np.stack(out, axis=2)


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step, for ``docs`` (doc_id, text, source).

    A null source is the part "", a null text an empty one. A row repeats a text if a smaller
    id has the same one; a null id is neither smaller nor greater, and equal ids do not repeat
    each other. A row is good or toxic if any label row of its id says 1. Empty tables give no
    rows; other columns are not read. Each part's tensor is 32 counts, added up before they
    meet, and parts are contracted in batches.
    """
    cells = cell_counts(docs, labels)
    kinds = ("n", "good", "toxic")
    tensors = cells.groupBy("part").agg(
        *[F.array(*[F.coalesce(F.sum(F.when(F.col("code") == k, F.col(m))), F.lit(0)) for k in range(CELLS)]).alias(m) for m in kinds]
    )
    schema = arrow_schema(AUDIT_SCHEMA)
    orders, steps = [o for o in ORDERS for _ in FILTERS], [k + 1 for _ in ORDERS for k in range(len(FILTERS))]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        contractions = Contractions()
        # some parts at a time: each gives 600 rows
        for batch in (b.slice(i, 100) for b in batches for i in range(0, b.num_rows, 100)):
            shape = (batch.num_rows, *[2] * len(FILTERS))
            n, good, toxic = (batch.column(m).flatten().to_numpy(zero_copy_only=False).reshape(shape) for m in kinds)
            figures = contractions.figures(n, good, toxic).reshape(-1, len(MEASURES))
            parts = np.repeat(np.array(batch.column("part").to_pylist(), dtype=object), len(steps))
            columns = [pa.array(parts, pa.string()), pa.array(orders * batch.num_rows), pa.array(steps * batch.num_rows, pa.int32())]
            columns += [pa.array(figures[:, k]) for k in range(len(MEASURES))]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return tensors.mapInArrow(work, AUDIT_SCHEMA)
