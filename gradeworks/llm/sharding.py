"""Histogram sort: near-equal shards by exact byte counts below candidate boundaries.

Rows are ordered by a 60-bit key: 36 bits of a hash of the text, then 24 bits of a hash of the
id. Equal texts are neighbours, and a text that holds a large part of all rows can still be cut,
by id. Each round counts the exact bytes in every cell of a grid over the key space, wherever
the rows lie, and refines the grid only inside the cells that hold an unmet boundary. When all
boundaries are within the tolerance, the rows are exchanged once.
"""

from __future__ import annotations

from bisect import bisect_left
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gradeworks.session import stage

KEY_BITS, TEXT_BITS, LEVEL_BITS = 60, 36, 12
ROWS_PER_CELL = 65_536


def order_key(text: Column, row_id: Column) -> Column:
    """Key of 60 bits. A null id is replaced by the row's place, so that many of them can be cut too."""
    low_bits = KEY_BITS - TEXT_BITS
    by_id = F.when(row_id.isNull(), F.xxhash64(F.monotonically_increasing_id())).otherwise(F.xxhash64(row_id))
    return F.shiftleft(F.shiftrightunsigned(F.xxhash64(text), 64 - TEXT_BITS), low_bits).bitwiseOR(
        F.shiftrightunsigned(by_id, 64 - low_bits)
    )


def find_splitters(rows: DataFrame, key: str, weight: str, n_shards: int, tolerance: float) -> list[int]:
    """``n_shards - 1`` keys; the weight below the i-th is within tolerance of i shares of the total.

    ``tolerance`` is a part of one share. Where a boundary cannot meet it because the rows at it
    have equal keys, the nearest possible boundary is taken. What reaches the driver is one sum
    per grid cell: 4,096 in the first round, at most 4,096 per open boundary later.
    """
    total = rows.agg(F.sum(weight)).first()[0] or 0
    if n_shards < 2 or not total:
        return [0] * (n_shards - 1)
    share = total / n_shards
    found: dict[int, int] = {}
    # cells that hold open boundaries: start of the cell -> (weight below it, boundaries in it)
    open_cells: dict[int, tuple[int, list[int]]] = {0: (0, list(range(1, n_shards)))}
    for bits in range(LEVEL_BITS, KEY_BITS + 1, LEVEL_BITS):
        width = 1 << (KEY_BITS - bits)
        parent = F.shiftright(F.col(key), KEY_BITS - bits + LEVEL_BITS)
        here = rows if bits == LEVEL_BITS else rows.where(parent.isin([c // (width << LEVEL_BITS) for c in open_cells]))
        sums = here.groupBy(F.shiftright(F.col(key), KEY_BITS - bits).alias("cell")).agg(F.sum(weight).alias("weight"))
        counted: dict[int, list[tuple[int, int]]] = {}
        for cell, add in sorted((r["cell"], r["weight"]) for r in sums.collect()):
            counted.setdefault(cell * width // (width << LEVEL_BITS) * (width << LEVEL_BITS), []).append((cell * width, add))
        deeper: dict[int, tuple[int, list[int]]] = {}
        for start, (below, boundaries) in open_cells.items():
            cells = counted[start]
            ends = [below + s for s in accumulate(add for _, add in cells)]
            for i in boundaries:
                at = min(bisect_left(ends, i * share), len(cells) - 1)
                before = ends[at - 1] if at else below
                low, high = i * share - before, ends[at] - i * share
                near_key = cells[at][0] if low <= high else cells[at][0] + width
                if min(low, high) <= tolerance * share or bits == KEY_BITS:
                    found[i] = near_key
                else:
                    deeper.setdefault(cells[at][0], (before, []))[1].append(i)
        open_cells = deeper
        if not open_cells:
            break
    return [found[i] for i in range(1, n_shards)]


def histogram_shards(
    rows: DataFrame, key: str, weight: str, n_shards: int, tolerance: float = 0.001
) -> DataFrame:
    """Add ``shard`` and ``slot``, its place in the shard, gapless from 0.

    ``rows`` must be stored, because they are read once per round. A shard is a range of keys.
    It is numbered in cells of about 65,536 rows, cut by the id bits of the key, so that neither
    a shard nor a hot text is numbered by one task; the numbers of cells before are added up.
    Within a cell, rows are in key order. No rows give no rows.
    """
    splitters = find_splitters(rows, key, weight, n_shards, tolerance)
    shard = sum((F.when(F.col(key) >= s, 1).otherwise(0) for s in splitters), F.lit(0)).cast("int")
    cells = rows.count() // (n_shards * ROWS_PER_CELL) + 1
    placed = rows.withColumns({"shard": shard, "_cell": F.col(key) % cells})
    before = Window.partitionBy("shard").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("shard", "_cell").agg(F.count(F.lit(1)).alias("_n"))
    starts = starts.select("shard", "_cell", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    in_cell = Window.partitionBy("shard", "_cell").orderBy(key)
    numbered = placed.withColumn("_place", F.row_number().over(in_cell).cast("bigint") - 1)
    return (
        numbered.join(starts, ["shard", "_cell"])
        .withColumn("slot", F.col("_start") + F.col("_place"))
        .drop("_cell", "_place", "_start")
    )


def shard_documents(docs: DataFrame, n_shards: int, tolerance: float = 0.001) -> DataFrame:
    """Every row of ``docs`` (doc_id, text) in one shard, sizes in bytes near equal.

    Size is the text's UTF-8 bytes, none for null, plus 16; crc32 of a null text is that of no
    bytes. Repeated rows are rows of their own; other columns are left out; null ids are kept.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    sized = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        (F.octet_length(text) + 16).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        order_key(text, F.col("doc_id")).alias("_key"),
    )
    return histogram_shards(stage(sized, "shard-keys"), "_key", "size", n_shards, tolerance).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
