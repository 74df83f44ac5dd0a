"""Exact order statistics and running totals without one huge sort or one huge group."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ACCURACY = 10_000  # rank error of the sketch is at most rows / ACCURACY
SLACK = 2.0  # how far the first cuts lie from a wanted position, in errors of the sketch
MAX_PASSES = 40


@dataclass
class _Zones:
    """One group's column cut into zones: cut ``i`` itself is zone ``2i + 1``, what lies before it zone ``2i``."""

    n: int
    cuts: np.ndarray
    before: np.ndarray | None = None  # values in the zones before each zone
    sizes: np.ndarray | None = None

    def zone_of(self, values: np.ndarray) -> np.ndarray:
        place = np.searchsorted(self.cuts, values, side="left")
        equal = np.zeros(len(values), bool)
        inner = place < len(self.cuts)
        equal[inner] = self.cuts[place[inner]] == values[inner]
        return 2 * place + equal

    def count(self, sizes: dict[int, int]) -> None:
        self.sizes = np.zeros(2 * len(self.cuts) + 1, dtype=np.int64)
        for zone, n in sizes.items():
            self.sizes[zone] = n
        self.before = np.cumsum(self.sizes) - self.sizes

    def holding(self, rank: int) -> int:
        """The zone of the value of this rank."""
        return int(np.searchsorted(self.before, rank, side="right")) - 1


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    by: str | None = None,
    direct_rows: int = 500_000,
) -> dict[tuple[object, str], list[float]]:
    """``{(group, column): [quantile, ...]}`` with linear interpolation; null and NaN are left out.

    Three scans, whatever the number of quantiles: one sketch per group and column gives cuts
    close to every wanted position; counts of the values between the cuts, found by binary
    search, say which zone holds each position; only the values of those zones are fetched. If
    they are more than ``direct_rows``, the zones are cut again in the same way. No table is
    sorted or shuffled: sketches, counts per zone and the fetched values are.
    """
    columns = list(columns)
    if not columns:
        return {}
    data = df.select(
        (F.col(by) if by else F.lit(None).cast("string")).alias("g"),
        *[F.when(~F.isnan(F.col(f"`{c}`").cast("double")), F.col(f"`{c}`").cast("double")).alias(f"c{i}") for i, c in enumerate(columns)],
    )
    reach = SLACK / ACCURACY
    ends = sorted({min(1.0, max(0.0, p + r)) for p in probabilities for r in (-reach, reach)})
    state: dict[tuple[object, int], _Zones] = {}
    sketches = [F.struct(F.count(f"c{i}").alias("n"), F.percentile_approx(f"c{i}", ends, ACCURACY).alias("q")).alias(f"s{i}") for i in range(len(columns))]
    for row in data.groupBy("g").agg(*sketches).collect():
        for i in range(len(columns)):
            if row[f"s{i}"]["n"]:
                state[row["g"], i] = _Zones(row[f"s{i}"]["n"], np.unique(np.array(row[f"s{i}"]["q"], dtype=float)))
    ranks = {key: sorted({r for p in probabilities for r in _ranks(p, zones.n)}) for key, zones in state.items()}
    for _ in range(MAX_PASSES):
        _count_zones(data, state)
        # a zone that is a cut holds one value, which is the cut
        wanted = {(*key, zone) for key, zones in state.items() for r in ranks[key] if not (zone := zones.holding(r)) % 2}
        if sum(state[g, i].sizes[zone] for g, i, zone in wanted) <= direct_rows:
            break
        _cut_again(data, state, ranks, wanted)
    else:
        raise RuntimeError(f"no exact quantiles of {columns} after {MAX_PASSES} passes")
    values = _values_in(data, state, wanted)
    found: dict[tuple[object, str], list[float]] = {}
    for (g, i), zones in state.items():
        at: dict[int, float] = {}
        for r in ranks[g, i]:
            zone = zones.holding(r)
            at[r] = float(zones.cuts[zone // 2] if zone % 2 else values[g, i, zone][r - zones.before[zone]])
        found[g, columns[i]] = [_between(p, zones.n, at) for p in probabilities]
    return found


def _ranks(p: float, n: int) -> tuple[int, int]:
    low = int(p * (n - 1))
    return low, min(low + 1, n - 1)


def _between(p: float, n: int, at: dict[int, float]) -> float:
    low, high = _ranks(p, n)
    part = p * (n - 1) - low
    return at[low] if part == 0 or at[low] == at[high] else at[low] * (1 - part) + at[high] * part


def _per_group(batches: Iterator[pa.RecordBatch], keys: Sequence[tuple[object, int]]) -> Iterator[tuple[tuple[object, int], np.ndarray]]:
    """The values of every (group, column) in each batch."""
    groups = {g for g, _ in keys}
    for batch in batches:
        held = batch.column("g")
        for g in groups:
            mask = held.is_null() if g is None else pc.equal(held, pa.scalar(g, held.type))
            part = batch.filter(mask)
            for i in (i for h, i in keys if h == g):
                yield (g, i), part.column(f"c{i}").drop_null().to_numpy(zero_copy_only=False)


def _count_zones(data: DataFrame, state: dict[tuple[object, int], _Zones]) -> None:
    """Count the values in every zone: one scan, one small aggregation."""
    keys, cuts = list(state), list(state.values())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = [np.zeros(2 * len(z.cuts) + 1, dtype=np.int64) for z in cuts]
        number = {key: k for k, key in enumerate(keys)}
        for key, values in _per_group(batches, keys):
            k = number[key]
            totals[k] += np.bincount(cuts[k].zone_of(values), minlength=len(totals[k]))
        rows = [(k, z, int(total[z])) for k, total in enumerate(totals) for z in np.flatnonzero(total).tolist()]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*rows, strict=True) if rows else ([], [], []))], names=["k", "zone", "n"])

    sizes: dict[int, dict[int, int]] = {}
    for r in data.mapInArrow(count, "k bigint, zone bigint, n bigint").groupBy("k", "zone").agg(F.sum("n").alias("n")).collect():
        sizes.setdefault(r["k"], {})[r["zone"]] = r["n"]
    for k, zones in enumerate(cuts):
        zones.count(sizes.get(k, {}))


def _inside(data: DataFrame, state: dict[tuple[object, int], _Zones], wanted: set[tuple[object, int, int]]) -> DataFrame:
    """``(k, value)``: the values that lie in the wanted zones, ``k`` their number in order of the zones."""
    order = sorted(wanted, key=lambda w: (str(w[0]), *w[1:]))
    keys = list(dict.fromkeys(w[:2] for w in order))
    zones = {key: state[key] for key in keys}
    numbers = {key: {w[2]: k for k, w in enumerate(order) if w[:2] == key} for key in keys}

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, values in _per_group(batches, keys):
            place = zones[key].zone_of(values)
            for zone, k in numbers[key].items():
                held = values[place == zone]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(held), k, np.int64)), pa.array(held)], names=["k", "value"])

    return data.mapInArrow(pick, "k bigint, value double")


def _values_in(data: DataFrame, state: dict[tuple[object, int], _Zones], wanted: set[tuple[object, int, int]]) -> dict[tuple[object, int, int], np.ndarray]:
    """The sorted values of the wanted zones, whose number is bounded."""
    if not wanted:
        return {}
    order = sorted(wanted, key=lambda w: (str(w[0]), *w[1:]))
    fetched = _inside(data, state, wanted).toPandas()
    return {w: np.sort(fetched["value"].to_numpy()[fetched["k"].to_numpy() == k]) for k, w in enumerate(order)}


def _cut_again(data: DataFrame, state: dict[tuple[object, int], _Zones], ranks: dict, wanted: set[tuple[object, int, int]]) -> None:
    """Add cuts inside the wanted zones, around the positions that they hold: one sketch per zone."""
    order = sorted(wanted, key=lambda w: (str(w[0]), *w[1:]))
    shares = []
    for g, i, zone in order:
        zones = state[g, i]
        size, first = int(zones.sizes[zone]), int(zones.before[zone])
        inside = [(r - first) / max(size - 1, 1) for r in ranks[g, i] if first <= r < first + size]
        shares.append(sorted({min(1.0, max(0.0, s + e)) for s in inside for e in (-SLACK / ACCURACY, SLACK / ACCURACY)}))
    # a sketch answers for all positions of all zones, as its shares have to be the same for every zone
    every = sorted({s for part in shares for s in part})
    for r in _inside(data, state, wanted).groupBy("k").agg(F.percentile_approx("value", every, ACCURACY).alias("q")).collect():
        g, i, _ = order[r["k"]]
        state[g, i].cuts = np.union1d(state[g, i].cuts, np.array(r["q"], dtype=float))


@dataclass(frozen=True)
class Ranges:
    """Ends that cut a column into ranges of similar size."""

    ends: tuple[float, ...]

    @classmethod
    def expression(cls, order: str, n_ranges: int = 256) -> Column:
        """Aggregate whose result gives the ends; a sketch is enough, as ends only balance the work."""
        return F.percentile_approx(order, [i / n_ranges for i in range(1, n_ranges)], ACCURACY)


def running_totals(
    df: DataFrame, order: str, totals: Sequence[str], by: str, ranges: Ranges | None = None
) -> DataFrame:
    """Add ``cum_<column>``: totals over rows of the group with a larger-or-equal ``order``.

    ``df`` holds one row per (group, order). With ``ranges`` each value range is summed
    on its own and the few range totals carry the sums over, so a group is no longer
    one task; the result is the same.
    """
    window = Window.partitionBy(by).orderBy(F.col(order).desc()).rowsBetween(Window.unboundedPreceding, 0)
    if ranges is None:
        return df.withColumns({f"cum_{c}": F.sum(c).over(window) for c in totals})

    splits = [float("-inf"), *sorted(set(ranges.ends)), float("inf")]
    ranged = Bucketizer(splits=splits, inputCol=order, outputCol="_range").transform(df)
    carry = Window.partitionBy(by).orderBy(F.col("_range").desc()).rowsBetween(Window.unboundedPreceding, -1)
    before = (
        ranged.groupBy(by, "_range")
        .agg(*[F.sum(c).alias(f"_{c}") for c in totals])
        .select(by, "_range", *[F.coalesce(F.sum(f"_{c}").over(carry), F.lit(0)).alias(f"_{c}") for c in totals])
    )
    inner = Window.partitionBy(by, "_range").orderBy(F.col(order).desc()).rowsBetween(Window.unboundedPreceding, 0)
    summed = ranged.withColumns({f"cum_{c}": F.sum(c).over(inner) for c in totals})
    return reduce(
        lambda out, c: out.withColumn(f"cum_{c}", F.col(f"cum_{c}") + F.col(f"_{c}")).drop(f"_{c}"),
        totals,
        summed.join(before, [by, "_range"]),
    ).drop("_range")
