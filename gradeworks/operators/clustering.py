"""K-means cluster features.

All starts and all numbers of clusters are moved by the same scans of the rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradeworks.functions.blocks import matrix
from gradeworks.operators.neighbors import row_distance, vector
from gradeworks.operators.sampling import sample_rows
from gradeworks.session import scratch, stage

START_ROWS = 10_000
MAX_STEPS = 300
TOLERANCE = 1e-4
STEP_ROWS = 4096
OPEN_BYTES = 32 * 1024 * 1024  # of a start's rows that its task moves its centers by
SCAN_STEPS = 8  # steps that make it worth sending them
SLIGHT = 1e-9  # a share of a distance that is taken for a rounding error


def nearest_centroid(df: DataFrame, columns: Sequence[str], centers: Sequence[Sequence[float]]) -> DataFrame:
    """Add ``cluster`` and ``distance``; the centers are few, so each row scans them in place."""
    point = vector(columns)
    options = F.array(
        *[
            F.struct(
                row_distance(point, F.array(*[F.lit(float(x)) for x in center])).alias("distance"),
                F.lit(i).alias("cluster"),
            )
            for i, center in enumerate(centers)
        ]
    )
    return (
        df.withColumn("_best", F.array_min(options))
        .withColumns({"cluster": F.col("_best.cluster"), "distance": F.col("_best.distance")})
        .drop("_best")
    )


def inertia(assigned: DataFrame) -> DataFrame:
    """One row: sum of squared distances to the assigned centers."""
    return assigned.agg(F.sum(F.col("distance") * F.col("distance")).alias("inertia"))


def cluster_dummies(df: DataFrame, k: int) -> DataFrame:
    """0/1 columns ``cluster_0`` .. in numeric order, also for clusters no row fell into."""
    return df.withColumns({f"cluster_{i}": (F.col("cluster") == i).cast("int") for i in range(k)}).drop("cluster")


@dataclass(frozen=True)
class Clusters:
    columns: tuple[str, ...]
    centers: tuple[tuple[float, ...], ...]
    cost: float

    @property
    def k(self) -> int:
        return len(self.centers)

    def assign(self, df: DataFrame) -> DataFrame:
        return nearest_centroid(df, self.columns, self.centers)

    def transform(self, df: DataFrame) -> DataFrame:
        """Append the 0/1 cluster columns."""
        return cluster_dummies(self.assign(df).drop("distance"), self.k)


def _first_centers(sample: np.ndarray, k: int, seed: int) -> np.ndarray:
    """k-means++ on sampled rows: each next center is drawn by squared distance to those before it."""
    draw = np.random.default_rng(seed)
    centers = [sample[draw.integers(len(sample))]]
    nearest = ((sample - centers[0]) ** 2).sum(axis=1)
    while len(centers) < k:
        total = nearest.sum()
        # once every sampled row is a center, further centers repeat some
        at = draw.choice(len(sample), p=nearest / total) if total > 0 else draw.integers(len(sample))
        centers.append(sample[at])
        nearest = np.minimum(nearest, ((sample - centers[-1]) ** 2).sum(axis=1))
    return np.array(centers)


def _nearest_two(x: np.ndarray, centers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number of the nearest center, of equal ones the first, and the squares to it and to the next; ``x`` has one row per column."""
    at, best, second = np.zeros(x.shape[1], np.int64), np.full(x.shape[1], np.inf), np.full(x.shape[1], np.inf)
    for i, center in enumerate(centers):
        square = np.zeros(x.shape[1])
        for own, c in zip(x, center, strict=True):
            gap = own - c
            square += np.multiply(gap, gap, out=gap)
        at[square < best] = i
        np.minimum(second, np.maximum(best, square), out=second)
        np.minimum(best, square, out=best)
    return at, best, second


def _sums(x: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    """Rows and column sums of every center's rows."""
    return np.stack([np.bincount(at, minlength=k), *(np.bincount(at, own, k) for own in x)], axis=1)


def _margins(x: np.ndarray, centers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nearest center, square to it, and how much farther the next one is."""
    # few enough rows at a time to stay in the cache
    parts = [_nearest_two(x[:, i : i + STEP_ROWS], centers) for i in range(0, x.shape[1], STEP_ROWS)] or [_nearest_two(x, centers)]
    at, best, second = (np.concatenate(c) for c in zip(*parts, strict=True))
    return at, best, np.sqrt(second) - np.sqrt(best)


def _drift(centers: np.ndarray, first: np.ndarray) -> float:
    """How much a row's margin may have shrunk since the centers were at ``first``, taken a little more."""
    return np.sort(np.sqrt(((centers - first) ** 2).sum(axis=1)))[-2:].sum() * (1 + SLIGHT) + SLIGHT


def _settle(centers: np.ndarray, held: np.ndarray, x: np.ndarray, safe: Callable[[np.ndarray], bool], most: int) -> tuple[np.ndarray, int, bool]:
    """Move centers by all rows while ``safe`` says so, at least once: centers, steps, whether they settled.

    ``held`` are the sums of rows that keep their center as long as ``safe`` holds, ``x`` are all other rows. Of
    many, those of the greatest margins are summed up in turn, and the others move the centers.
    """
    steps = 0
    while steps < most and (not steps or safe(centers)):
        at, _, margin = _margins(x, centers)
        if x.shape[1] > 2 * STEP_ROWS and (bound := np.partition(margin, len(margin) // 4)[len(margin) // 4]) > 0:
            open_, first = margin < bound, centers
            sums = held + _sums(x[:, ~open_], at[~open_], len(centers))
            still = lambda c: _drift(c, first) < bound and safe(c)  # noqa: B023, E731 - used up before the next turn
            centers, more, settled = _settle(centers, sums, x[:, open_], still, most - steps)
            steps += more
            if settled:
                return centers, steps, True
            continue
        sums = held + _sums(x, at, len(centers))
        n = sums[:, :1]
        # a center without rows stays where it is
        moved = np.where(n > 0, sums[:, 1:] / np.maximum(n, 1), centers)
        far = ((moved - centers) ** 2).sum(axis=1).max()
        centers, steps = moved, steps + 1
        if not far > TOLERANCE**2:
            return centers, steps, True
    return centers, steps, False


@dataclass(frozen=True)
class _Start:
    """Centers, the margin from which on a row is summed up, and the steps left."""

    centers: np.ndarray
    bound: float
    left: int


def _all_sums(x: np.ndarray, starts: Mapping[int, np.ndarray]) -> dict[int, np.ndarray]:
    """Sums of the rows of every start's centers, by two products of matrices for all starts; ``x`` has one row per column."""
    centers, sizes = np.concatenate([*starts.values()]), [len(c) for c in starts.values()]
    first = np.cumsum([0, *sizes[:-1]])
    near = centers @ x - (centers**2).sum(axis=1)[:, None] / 2
    own = (near == np.repeat(np.maximum.reduceat(near, first, axis=0), sizes, axis=0)).astype(float)
    sums = np.concatenate([own.sum(axis=1)[:, None], own @ x.T], axis=1)
    out = dict(zip(starts, np.split(sums, first[1:]), strict=True))
    # where centers are equally near, the first one gets the row
    return {s: c if c[:, 0].sum() == x.shape[1] else _sums(x, _nearest_two(x, starts[s])[0], sizes[i]) for i, (s, c) in enumerate(out.items())}


def _scan(points: DataFrame, starts: Mapping[int, _Start]) -> DataFrame:
    """Sums per task and start of the rows whose center is safe by its bound, and the other rows."""
    held, bounds = {s: x.centers for s, x in starts.items()}, {s: x.bound for s, x in starts.items()}
    width = next(iter(held.values())).shape[1]
    closed = {s: c for s, c in held.items() if bounds[s] == -np.inf}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {s: np.zeros((len(c), width + 1)) for s, c in held.items()}
        part = TaskContext.get().partitionId()

        def rows(number: int, cells: Mapping[int, np.ndarray]) -> pa.RecordBatch:
            n = len(cells)
            columns = [np.array([*cells], np.int32), np.full(n, part, np.int32), np.full(n, number, np.int32)]
            return pa.RecordBatch.from_arrays([*map(pa.array, columns), pa.array([c.tobytes() for c in cells.values()], pa.binary())], names=["start", "part", "number", "cells"])

        number = 0
        for batch in batches:
            open_: dict[int, list[np.ndarray]] = {s: [] for s in held}
            for x in (np.frombuffer(b.as_buffer()).reshape(width, -1) for b in batch.column(0)):
                for s, found in (_all_sums(x, closed) if closed else {}).items():
                    sums[s] += found
                for s in held.keys() - closed.keys():
                    at, _, margin = _margins(x, held[s])
                    unsafe = margin < bounds[s]
                    open_[s].append(x[:, unsafe].T)
                    sums[s] += _sums(x[:, ~unsafe], at[~unsafe], len(held[s]))
            number += 1
            if found := {s: np.concatenate(o) for s, o in open_.items() if o}:
                yield rows(number, found)
        yield rows(0, sums)

    return points.mapInArrow(work, "start int, part int, number int, cells binary")


def _costs(points: DataFrame, starts: Mapping[int, np.ndarray]) -> dict[int, float]:
    """Sum of the squares to the nearest center, for every start: one scan."""
    held, width = dict(starts), next(iter(starts.values())).shape[1]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        costs = dict.fromkeys(held, 0.0)
        for batch in batches:
            for x in (np.frombuffer(b.as_buffer()).reshape(width, -1) for b in batch.column(0)):
                for s, centers in held.items():
                    costs[s] += float(_nearest_two(x, centers)[1].sum())
        yield pa.RecordBatch.from_arrays([pa.array([*costs], pa.int32()), pa.array([*costs.values()])], names=["start", "cost"])

    rows = points.mapInArrow(work, "start int, cost double").groupBy("start").agg(F.sum("cost").alias("cost")).collect()
    return {r["start"]: r["cost"] for r in sorted(rows, key=lambda r: r["start"])}


def _step(points: DataFrame, starts: Mapping[int, _Start]) -> dict[int, tuple[np.ndarray, int, bool]]:
    """Centers of every start after as many steps as its unsafe rows tell, at least one: one scan for all starts."""
    held = dict(starts)

    def settle(key: tuple, table: pa.Table) -> pa.Table:
        start = key[0].as_py()
        centers = held[start].centers
        table = table.sort_by([("part", "ascending"), ("number", "ascending")])
        cells = [np.frombuffer(c.as_buffer()).reshape(-1, centers.shape[1] + (n == 0)) for n, c in zip(table["number"].to_pylist(), table["cells"], strict=True)]
        sums = sum((c for c in cells if c.shape[1] > centers.shape[1]), np.zeros((len(centers), centers.shape[1] + 1)))
        x = np.concatenate([np.zeros((0, centers.shape[1])), *(c for c in cells if c.shape[1] == centers.shape[1])])
        bound, left = held[start].bound, held[start].left
        moved, steps, settled = _settle(centers, sums, np.ascontiguousarray(x.T), lambda c: _drift(c, centers) < bound, left)
        return pa.table({"start": pa.array([start], pa.int32()), "centers": pa.array([moved.tobytes()], pa.binary()), "steps": pa.array([steps], pa.int32()), "settled": [settled]})

    dealt = _scan(points, starts).repartition(len(held), "start")
    rows = dealt.groupBy("start").applyInArrow(settle, "start int, centers binary, steps int, settled boolean").collect()
    return {r["start"]: (np.frombuffer(r["centers"]).reshape(held[r["start"]].centers.shape), r["steps"], r["settled"]) for r in rows}


def _fit_all(df: DataFrame, columns: Sequence[str], sizes: Mapping[int, int], seeds: Mapping[int, int]) -> dict[int, tuple[np.ndarray, float]]:
    """Centers and cost of every start (number of clusters in ``sizes``), all moved by the same scans.

    First centers come from a sample of ``START_ROWS`` rows, in hash order. A scan sums up the rows that
    cannot change their center soon, and one task per start moves its centers by these sums and by all other
    rows, about ``OPEN_BYTES`` of them, until a summed row might change; then the next scan follows. While centers
    move fast, a scan sums up all rows. A start
    whose centers have settled takes no further part; the last scan gives the costs of all.
    """
    missing = reduce(lambda a, b: a | b, [F.col(f"`{c}`").isNull() for c in columns])
    order = F.xxhash64(F.lit(min(seeds.values(), default=0)), *[F.col(f"`{c}`") for c in df.columns])
    points = stage(df.select(vector(columns).alias("v"), order.alias("o"), missing.alias("missing")), "cluster-points")
    if not points.where("missing").isEmpty():
        raise ValueError(f"rows without a value in one of {list(columns)} cannot be clustered; fill them first")
    sample = np.array([r["v"] for r in points.orderBy("o").limit(START_ROWS).select("v").collect()], dtype=float).reshape(-1, len(columns))
    if not len(sample):
        raise ValueError("there are no rows to cluster")
    share = OPEN_BYTES / (8 * len(columns) * points.count())
    width, middle = len(columns), sample.mean(axis=0)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = matrix(batch.column(0), width) - middle
            held = [np.ascontiguousarray(values[i : i + STEP_ROWS].T).tobytes() for i in range(0, len(values), STEP_ROWS)]
            yield pa.RecordBatch.from_arrays([pa.array(held, pa.binary())], names=["rows"])

    # columns of some thousand rows side by side, as every scan reads them, near zero for exact products
    rows = stage(points.select("v").mapInArrow(pack, "rows binary"), "cluster-rows")
    sample = sample - middle
    centers = {s: _first_centers(sample, k, seeds[s]) for s, k in sizes.items()}
    left, pace = dict.fromkeys(sizes, MAX_STEPS), dict.fromkeys(sizes, np.inf)
    while moving := {s: _Start(centers[s], _bound(sample, centers[s], share, pace[s]), n) for s, n in left.items() if n}:
        for s, (moved, steps, settled) in _step(rows, moving).items():
            pace[s] = _drift(moved, centers[s]) / steps
            centers[s], left[s] = moved, 0 if settled else left[s] - steps
    return {s: (centers[s] + middle, cost) for s, cost in _costs(rows, centers).items()}


def _bound(sample: np.ndarray, centers: np.ndarray, share: float, pace: float) -> float:
    """The margin below which about ``share`` of the rows lie, by the sample; none where centers at their pace soon pass it."""
    if share >= 1:
        return np.inf
    margins = np.sort(_margins(np.ascontiguousarray(sample.T), centers)[2])
    bound = float(margins[int(share * len(margins))])
    return bound if bound > SCAN_STEPS * pace else -np.inf


def fit_clusters(df: DataFrame, columns: Sequence[str], k: int, restarts: int = 10, seed: int = 42) -> Clusters:
    """K-means from several starts, moved together; the one with the least cost is kept, of equal ones the first."""
    with scratch(df.sparkSession):
        found = _fit_all(df, columns, dict.fromkeys(range(restarts), k), {s: seed + s for s in range(restarts)})
    centers, cost = min(found.values(), key=lambda x: x[1])
    return Clusters(tuple(columns), tuple(tuple(float(x) for x in c) for c in centers), float(cost))


def elbow(
    df: DataFrame, columns: Sequence[str], key: str, max_k: int = 10, sample_size: int = 30_000, seed: int = 42
) -> DataFrame:
    """``(k, inertia)`` for k = 2 .. max_k, one start each, all moved together, on a fixed-size sample."""
    sizes = {k: k for k in range(2, max_k + 1)}
    with scratch(df.sparkSession):
        sample = sample_rows(df.select(key, *columns), key, sample_size, seed)
        found = _fit_all(sample, columns, sizes, dict.fromkeys(sizes, seed))
    return df.sparkSession.createDataFrame([(k, float(cost)) for k, (_, cost) in sorted(found.items())], "k int, inertia double")
