"""A seeded, portable random order of rows, and exact cuts through it.

Rows are ordered by the md5 of seed and key. A sample, split or fold is then a
range of that order, so it is fixed by a few cut values: finding them scans only
the key and the stratum, and applying them is a comparison per row that moves no
data. A global ``row_number`` would put a whole stratum through one task.
"""

from __future__ import annotations

from collections.abc import Callable, Hashable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gradeworks.session import stage

MAX_STRATA = 1000
DIGITS = 3  # hex digits resolved per counting pass: 4096 ranges per stratum
BEFORE_ALL = ""
AFTER_ALL = "~"

Stratum = Hashable | None
Cuts = dict[Stratum, list[str]]


def row_hash(key: str, seed: int = 42) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}|"), F.col(key).cast("string")))


def find_cuts(
    df: DataFrame,
    key: str,
    ranks: Callable[[Mapping[Stratum, int]], Mapping[Stratum, Sequence[int]]],
    by: str | None = None,
    seed: int = 42,
    rank_rows: int = 1_000_000,
) -> Cuts:
    """Hash of the row at each wanted rank, per stratum.

    ``ranks`` maps the stratum sizes to cumulative ranks. Each counting pass narrows
    every wanted rank to one hash range; rows are ranked only inside ranges of at
    most ``rank_rows`` rows. Every row must have a key, and at most ``MAX_STRATA`` strata
    are cut, since their counts go to the driver.
    """
    # several narrow passes read strata and hashes only, so these two columns are stored
    rows = df.select((F.col(by) if by else F.lit(0)).alias("stratum"), row_hash(key, seed).alias("hash"))
    rows = stage(rows, "hash-order")
    if by is not None and rows.select("stratum").distinct().limit(MAX_STRATA + 1).count() > MAX_STRATA:
        raise ValueError(f"column {by!r} has more than {MAX_STRATA} values; it cannot be cut by stratum")
    first = _count_ranges(rows, 1)
    sizes: dict[Stratum, int] = {}
    if any(hash_range is None for _, hash_range in first):
        raise ValueError(f"column {key!r} has null keys, which have no place in the order")
    for (stratum, _), n in first.items():
        sizes[stratum] = sizes.get(stratum, 0) + n
    wanted = ranks(sizes)

    found: dict[tuple[Stratum, int], str] = {}
    open_targets = {}
    for stratum, cumulative in wanted.items():
        for rank in cumulative:
            if rank <= 0:
                found[stratum, rank] = BEFORE_ALL
            elif rank >= sizes[stratum]:
                found[stratum, rank] = AFTER_ALL
            else:
                open_targets[stratum, rank] = ("", rank, sizes[stratum])

    counts, width = first, 1
    ready = {}
    while open_targets:
        for (stratum, rank), (prefix, left, _) in list(open_targets.items()):
            ranges = sorted(r for s, r in counts if s == stratum and r.startswith(prefix))
            for hash_range in ranges:
                n = counts[stratum, hash_range]
                if left <= n:
                    break
                left -= n
            open_targets[stratum, rank] = (hash_range, left, n)
            if n <= rank_rows or len(hash_range) >= 30:
                ready[stratum, rank] = open_targets.pop((stratum, rank))
        if open_targets:
            width += 1
            inside = {(s, p) for (s, _), (p, _, _) in open_targets.items()}
            counts = _count_ranges(rows.where(_in_ranges(inside)), width)

    if ready:
        inside = {(s, p) for (s, _), (p, _, _) in ready.items()}
        within = Window.partitionBy("stratum", "range").orderBy("hash")
        positions = {(s, p, left): (s, rank) for (s, rank), (p, left, _) in ready.items()}
        lengths = sorted({len(p) for _, p in inside})
        ranked = reduce(
            DataFrame.unionByName,
            [
                rows.where(_in_ranges({(s, p) for s, p in inside if len(p) == length}))
                .withColumn("range", F.substring("hash", 1, length))
                for length in lengths
            ],
        ).withColumn("position", F.row_number().over(within))
        hits = ranked.where(F.col("position").isin([left for _, _, left in positions]))
        at = {(r["stratum"], r["range"], r["position"]): r["hash"] for r in hits.collect()}
        for (stratum, hash_range, left), target in positions.items():
            found[target] = at[stratum, hash_range, left]
        # two wanted ranks of a stratum never share (range, position)

    return {s: [found[s, rank] for rank in cumulative] for s, cumulative in wanted.items()}


def segment(cuts: Cuts, key: str, by: str | None = None, seed: int = 42) -> Column:
    """Number of cuts that lie before the row: 0 is the first range of the order."""
    row = row_hash(key, seed)

    def passed(values: Sequence[str]) -> Column:
        return reduce(lambda a, b: a + b, [(row > F.lit(v)).cast("int") for v in values], F.lit(0))

    if by is None:
        return passed(cuts[0]) if 0 in cuts else F.lit(0)
    chosen = F.lit(None).cast("int")
    for stratum, values in cuts.items():
        chosen = F.when(F.col(by).eqNullSafe(F.lit(stratum)), passed(values)).otherwise(chosen)
    return chosen


def _count_ranges(rows: DataFrame, level: int) -> dict[tuple[Stratum, str], int]:
    counted = rows.groupBy("stratum", F.substring("hash", 1, DIGITS * level).alias("range")).count()
    return {(r["stratum"], r["range"]): r["count"] for r in counted.collect()}


def _in_ranges(ranges: set[tuple[Stratum, str]]) -> Column:
    return reduce(
        lambda a, b: a | b,
        [F.col("stratum").eqNullSafe(F.lit(s)) & F.col("hash").startswith(p) for s, p in ranges],
    )
