"""Features cut into bins once, and trees grown from histograms of the bins.

Rows are packed into blocks of column-wise bins, a byte each. A level of a tree is one
aggregation: tasks add up class weights per (node, feature, bin), the sums meet by cell, and
the driver takes the best cut of each node from a table whose size the rows do not change.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field
from math import prod

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradeworks.session import stage

MAX_BINS = 128
MAX_CELLS = 32_000_000  # cells of all trees counted in one job
SKETCH = 10_000
# Gains are rounded so that sums added up in another order choose the same cut.
DECIMALS = 10
SLIGHT = 1e-12  # a share of the weight that is taken for a rounding error
BLOCK_SCHEMA = "n int, bins binary, classes binary, weights binary, folds binary"


@dataclass
class GrownTree:
    """Nodes as parallel lists; ``feature`` -1 marks a leaf, ``x <= threshold`` goes to ``left``."""

    feature: list[int] = field(default_factory=list)
    threshold: list[float] = field(default_factory=list)
    cut: list[int] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    call: list[int] = field(default_factory=list)

    def add(self, call: int) -> int:
        for column, value in ((self.feature, -1), (self.threshold, 0.0), (self.cut, 0), (self.left, -1), (self.right, -1), (self.call, call)):
            column.append(value)
        return len(self.feature) - 1

    def split(self, node: int, feature: int, cut: int, threshold: float, calls: tuple[int, int]) -> tuple[int, int]:
        left, right = self.add(calls[0]), self.add(calls[1])
        self.feature[node], self.threshold[node], self.cut[node] = feature, threshold, cut
        self.left[node], self.right[node] = left, right
        return left, right

    def walk(self, values: np.ndarray, by_bin: bool) -> np.ndarray:
        """The node each row ends in; ``values`` has one row per feature."""
        feature, left, right = (np.array(c) for c in (self.feature, self.left, self.right))
        limit = np.array(self.cut if by_bin else self.threshold)
        at = np.zeros(values.shape[1], np.int64)
        rows = np.arange(values.shape[1])
        while len(rows := rows[feature[at[rows]] >= 0]):
            node = at[rows]
            at[rows] = np.where(values[feature[node], rows] <= limit[node], left[node], right[node])
        return at

    def calls(self, values: np.ndarray, by_bin: bool) -> np.ndarray:
        return np.array(self.call)[self.walk(values, by_bin)]


@dataclass(frozen=True)
class Binned:
    """Blocks of ``n`` rows with their bins (features x n bytes), class numbers, weights and folds."""

    blocks: DataFrame
    cuts: list[np.ndarray]
    n_classes: int
    max_bins: int


def bin_cuts(df: DataFrame, features: Sequence[str], max_bins: int = MAX_BINS) -> list[np.ndarray]:
    """Ascending cuts per feature, at most ``max_bins`` - 1; a value's bin is the number of cuts below it.

    A feature of few values is cut at each of them, others at their quantiles. Two scans, the first
    of which only counts, since a sketch of quantiles costs far more than a count.
    """
    if not 2 <= max_bins <= 256:
        raise ValueError("max_bins must be 2 to 256, as a bin is stored in a byte")
    columns = [F.col(f"`{f}`").cast("double") for f in features]
    shares = [i / max_bins for i in range(1, max_bins)]

    def sketch(which: Sequence[int]) -> list[Column]:
        return [F.percentile_approx(columns[i], shares, SKETCH).alias(f"q{i}") for i in which]

    counted = df.agg(*[F.approx_count_distinct(c).alias(f"d{i}") for i, c in enumerate(columns)]).first()
    # the count is approximate, so twice as many are fetched as are wanted, and sketches begin at half
    few = [i for i in range(len(features)) if counted[f"d{i}"] <= 2 * max_bins]
    many = [i for i in range(len(features)) if 2 * counted[f"d{i}"] > max_bins]
    found = df.agg(*[F.collect_set(columns[i]).alias(f"s{i}") for i in few], *sketch(many)).first().asDict()
    if left := [i for i in few if i not in many and len(found[f"s{i}"]) > max_bins]:
        found |= df.agg(*sketch(left)).first().asDict()
    cuts = []
    for i in range(len(features)):
        values = sorted(found[f"s{i}"]) if i in few else None
        if values is None or len(values) > max_bins:
            values = [*sorted(set(found[f"q{i}"] or [])), np.inf]
        # the greatest value needs no cut
        cuts.append(np.array(values[:-1], dtype=float))
    return cuts


def bin_rows(
    rows: DataFrame, point: str, class_: str, cuts: list[np.ndarray], n_classes: int, max_bins: int = MAX_BINS, fold: str | None = None,
    mark: str | None = None,
) -> Binned:
    """Pack rows of a vector column, a class number, a fold and a 64-bit mark; every row weighs the same. Written once."""
    p, names = len(cuts), ["n", "bins", "classes", "weights", "folds", *(["marks"] if mark else [])]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            values = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(n, p)
            bins = np.stack([np.searchsorted(cuts[i], values[:, i], side="left") for i in range(p)]).astype(np.uint8)
            classes = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int8)
            folds = batch.column(2).to_numpy(zero_copy_only=False).astype(np.int16)
            marks = [batch.column(3).to_numpy(zero_copy_only=False)] if mark else []
            held = [pa.array([x.tobytes()], pa.binary()) for x in (bins, classes, np.ones(n), folds, *marks)]
            yield pa.RecordBatch.from_arrays([pa.array([n], pa.int32()), *held], names=names)

    chosen = (F.col(fold) if fold else F.lit(0)).cast("int")
    columns = [vector_to_array(F.col(point)).alias("p"), F.col(class_), chosen.alias("f"), *([F.col(mark).cast("bigint")] if mark else [])]
    packed = rows.select(*columns).mapInArrow(pack, BLOCK_SCHEMA + (", marks binary" if mark else ""))
    return Binned(stage(packed, "binned"), cuts, n_classes, max_bins)


def unpacked(batch: pa.RecordBatch, i: int, p: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    parts = {c: batch.column(c)[i].as_buffer() for c in ("bins", "classes", "weights")}
    bins = np.frombuffer(parts["bins"], np.uint8).reshape(p, -1)
    return bins, np.frombuffer(parts["classes"], np.int8), np.frombuffer(parts["weights"], np.float64)


def reweighted(weights: np.ndarray, bins: np.ndarray, classes: np.ndarray, boosts: Sequence[tuple[GrownTree, float]]) -> np.ndarray:
    """Weights after each tree's misses were multiplied by its factor."""
    for tree, factor in boosts:
        weights = weights * np.where(tree.calls(bins, by_bin=True) != classes, factor, 1.0)
    return weights


def histogram(binned: Binned, tree: GrownTree, leaves: Sequence[int], boosts: Sequence[tuple[GrownTree, float]]) -> np.ndarray:
    """Class weights per (leaf, feature, bin, class) of the rows in the given leaves: one job."""
    p, k, b = len(binned.cuts), binned.n_classes, binned.max_bins
    place = np.full(len(tree.feature), -1)
    place[list(leaves)] = np.arange(len(leaves))
    shape = (len(leaves), p, b, k)

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for batch in batches:
            for i in range(batch.num_rows):
                bins, classes, weights = unpacked(batch, i, p)
                weights = reweighted(weights, bins, classes, boosts)
                leaf = place[tree.walk(bins, by_bin=True)]
                held = leaf >= 0
                if not held.all():
                    bins, classes, weights, leaf = bins[:, held], classes[held], weights[held], leaf[held]
                for f in range(p):
                    cell = (leaf * b + bins[f]) * k + classes
                    total[:, f] += np.bincount(cell, weights, len(leaves) * b * k).reshape(len(leaves), b, k)
        cells = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(total.ravel()[cells])], names=["cell", "weight"])

    sums = binned.blocks.mapInArrow(add_up, "cell bigint, weight double").groupBy("cell").agg(F.sum("weight").alias("weight")).toPandas()
    out = np.zeros(int(np.prod(shape)))
    out[sums["cell"].to_numpy(np.int64)] = sums["weight"].to_numpy(float)
    return out.reshape(shape)


@dataclass(frozen=True)
class Cuts:
    """The best cut of each leaf: whether it lowers impurity, by how pure it is, where, and the class weights of both sides."""

    gains: np.ndarray
    purity: np.ndarray
    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray


def best_cuts(table: np.ndarray, least_rows: int = 1, class_weights: np.ndarray | None = None) -> Cuts:
    """The cuts (feature, bin) that lower Gini impurity most, for a (leaf, feature, bin, class) table.

    Of equal gains the first feature's lowest cut is taken. With ``least_rows`` both sides hold as
    many rows, each of which weighs as ``class_weights`` say.
    """
    left = table.cumsum(axis=2)
    whole = left[:, :, -1:, :]
    right = whole - left
    sums = left.sum(axis=3), right.sum(axis=3)
    classes = whole[:, 0, 0]
    total = classes.sum(axis=1)
    scale = np.maximum(total, np.finfo(float).tiny)
    with np.errstate(divide="ignore", invalid="ignore"):
        purity = (left**2).sum(axis=3) / sums[0] + (right**2).sum(axis=3) / sums[1]
        purity = np.round(np.nan_to_num(purity / scale[:, None, None], nan=-1.0, posinf=-1.0), DECIMALS)
    tiny = (total * 10.0**-DECIMALS)[:, None, None]
    purity[(sums[0] <= tiny) | (sums[1] <= tiny)] = -1.0
    if least_rows > 1:
        for side in (left, right):
            purity[(side / class_weights).sum(axis=3) < least_rows - 0.5] = -1.0
    leaves, n_bins = np.arange(len(table)), table.shape[2]
    best = purity.reshape(len(table), -1).argmax(axis=1)
    f, cut = best // n_bins, best % n_bins
    before = ((classes / scale[:, None]) ** 2).sum(axis=1)
    return Cuts(purity[leaves, f, cut] > before + 10.0**-DECIMALS, purity[leaves, f, cut], f, cut, left[leaves, f, cut], right[leaves, f, cut])


def split_leaves(
    binned: Binned, tree: GrownTree, leaves: Sequence[int], table: np.ndarray, missed: dict[int, float], total: float
) -> list[int]:
    """Cut the leaves of a level where that lowers impurity; the children that still miss some weight."""
    grown, found = [], best_cuts(table)
    for i in np.flatnonzero(found.gains).tolist():
        node, f, cut, sides = leaves[i], int(found.feature[i]), int(found.cut[i]), (found.left[i], found.right[i])
        pair = tree.split(node, f, cut, float(binned.cuts[f][cut]), tuple(int(s.argmax()) for s in sides))
        del missed[node]
        for child, side in zip(pair, sides, strict=True):
            missed[child] = float(side.sum() - side.max())
            if missed[child] > total * SLIGHT:
                grown.append(child)
    return grown


def grow(binned: Binned, max_depth: int, boosts: Sequence[tuple[GrownTree, float]] = ()) -> tuple[GrownTree, float, float]:
    """A tree of at most ``max_depth`` levels, the weight it misses and the whole weight; one job per level."""
    tree = GrownTree()
    tree.add(0)
    leaves, total = [0], 0.0
    missed: dict[int, float] = {}
    for depth in range(max_depth):
        table = histogram(binned, tree, leaves, boosts)
        if not depth:
            weights = table[0, 0].sum(axis=0)
            total = float(weights.sum())
            tree.call[0] = int(weights.argmax())
            missed[0] = total - float(weights.max())
        leaves = split_leaves(binned, tree, leaves, table, missed, total)
        if not leaves:
            break
    return tree, sum(missed.values()), total


@dataclass
class Growing:
    """A tree on some of the features, learned from the rows outside one fold."""

    features: list[int]
    fold: int
    tree: GrownTree = field(default_factory=GrownTree)
    leaves: list[int] = field(default_factory=lambda: [0])

    def __post_init__(self):
        if not self.tree.feature:
            self.tree.add(0)


def _cells(binned: Binned, features: Sequence[int]) -> np.ndarray:
    """Where each feature's cells begin, and their number: bins that occur times classes."""
    sizes = [(len(binned.cuts[f]) + 1) * binned.n_classes for f in features]
    return np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)


def _count_cells(binned: Binned, growing: Sequence[Growing]) -> list[np.ndarray]:
    """Rows per (leaf, feature, bin, class) of every tree's leaves: one job for all trees."""
    p, k = len(binned.cuts), binned.n_classes
    starts = [_cells(binned, g.features) for g in growing]
    sizes = np.array([len(g.leaves) * int(s[-1]) for g, s in zip(growing, starts, strict=True)], dtype=np.int64)
    bases = np.cumsum(sizes) - sizes
    work_list = list(zip(growing, starts, sizes.tolist(), strict=True))

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(int(sizes.sum()), dtype=np.int64)
        for batch in batches:
            for i in range(batch.num_rows):
                bins, classes, _ = unpacked(batch, i, p)
                folds = np.frombuffer(batch.column("folds")[i].as_buffer(), np.int16)
                outside = {f: np.flatnonzero(folds != f) for f in {g.fold for g in growing}}
                for (g, start, size), base in zip(work_list, bases.tolist(), strict=True):
                    place = np.full(len(g.tree.feature), -1)
                    place[g.leaves] = np.arange(len(g.leaves))
                    rows = outside[g.fold]
                    leaf = place[g.tree.walk(bins[:, rows], by_bin=True)]
                    rows, leaf = rows[leaf >= 0], leaf[leaf >= 0]
                    for f, at in zip(g.features, start[:-1].tolist(), strict=True):
                        cell = leaf * start[-1] + at + bins[f, rows].astype(np.int64) * k + classes[rows]
                        total[base : base + size] += np.bincount(cell, minlength=size)
        cells = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(total[cells])], names=["cell", "n"])

    sums = binned.blocks.mapInArrow(add_up, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
    table = np.zeros(int(sizes.sum()))
    table[sums["cell"].to_numpy(np.int64)] = sums["n"].to_numpy(float)
    return [table[b : b + n].reshape(len(g.leaves), -1) for g, b, n in zip(growing, bases.tolist(), sizes.tolist(), strict=True)]


def grow_together(binned: Binned, growing: Sequence[Growing], max_depth: int) -> None:
    """Grow all trees level by level; a level is one job however many trees there are.

    Only where the trees' tables together pass ``MAX_CELLS`` cells, the trees are taken in parts.
    """
    for depth in range(max_depth):
        pending = [g for g in growing if g.leaves]
        if not pending:
            break
        part: list[Growing] = []
        room = MAX_CELLS
        for g in [*pending, None]:
            size = len(g.leaves) * int(_cells(binned, g.features)[-1]) if g else MAX_CELLS + 1
            if part and size > room:
                for held, table in zip(part, _count_cells(binned, part), strict=True):
                    _split_leaves(binned, held, table, depth)
                part, room = [], MAX_CELLS
            if g:
                part.append(g)
                room -= size


def _split_leaves(binned: Binned, g: Growing, table: np.ndarray, depth: int) -> None:
    """Cut every leaf of a tree where that lowers impurity; of equal cuts the first feature's lowest is taken."""
    starts, k = _cells(binned, g.features), binned.n_classes
    every = np.arange(len(g.leaves))
    found = [best_cuts(table[:, starts[j] : starts[j + 1]].reshape(len(g.leaves), 1, -1, k)) for j in range(len(g.features))]
    purity = np.array([np.where(c.gains, c.purity, -1.0) for c in found])
    best = purity.argmax(axis=0)
    if not depth:
        g.tree.call[0] = int(table[0, : starts[1]].reshape(-1, k).sum(axis=0).argmax())
    grown = []
    for i in every[purity[best, every] >= 0].tolist():
        f, cuts = g.features[best[i]], found[best[i]]
        cut, left, right = int(cuts.cut[i]), cuts.left[i], cuts.right[i]
        pair = g.tree.split(g.leaves[i], f, cut, float(binned.cuts[f][cut]), (int(left.argmax()), int(right.argmax())))
        grown += [child for child, side in zip(pair, (left, right), strict=True) if side.sum() > side.max()]
    g.leaves = grown


def joint_cells(binned: Binned, sets: Sequence[Sequence[int]], n_folds: int) -> int:
    """Cells that ``grow_jointly`` counts: folds, bins of the features of each set, classes."""
    return sum(n_folds * binned.n_classes * prod(len(binned.cuts[f]) + 1 for f in own) for own in sets)


def grow_jointly(binned: Binned, sets: Sequence[Sequence[int]], n_folds: int, max_depth: int) -> np.ndarray:
    """Share of every fold that a tree learned from the others calls right, per set of features: one job.

    A tree of few features sees nothing but their bins, so rows are counted by fold, bins and
    class, and all levels are grown from these counts.
    """
    p, k = len(binned.cuts), binned.n_classes
    sizes = [[len(binned.cuts[f]) + 1 for f in own] for own in sets]
    shapes = [(n_folds, *size, k) for size in sizes]
    bases = np.cumsum([0, *[prod(shape) for shape in shapes]]).tolist()

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(bases[-1], dtype=np.int64)
        for batch in batches:
            for i in range(batch.num_rows):
                bins, classes, _ = unpacked(batch, i, p)
                folds = np.frombuffer(batch.column("folds")[i].as_buffer(), np.int16)
                for own, size, base, end in zip(sets, sizes, bases, bases[1:], strict=False):
                    cell = folds.astype(np.int64)
                    for f, n in zip(own, size, strict=True):
                        cell = cell * n + bins[f]
                    total[base:end] += np.bincount(cell * k + classes, minlength=end - base)
        cells = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(total[cells])], names=["cell", "n"])

    sums = binned.blocks.mapInArrow(add_up, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(bases[-1])
    counts[sums["cell"].to_numpy(np.int64)] = sums["n"].to_numpy(float)
    out = np.zeros((len(sets), n_folds))
    for s, (own, shape, base) in enumerate(zip(sets, shapes, bases, strict=False)):
        table = counts[base : base + prod(shape)].reshape(n_folds, -1)
        held = np.flatnonzero(table.sum(axis=0))
        *places, classes = np.unravel_index(held, shape[1:])
        bins = np.zeros((p, len(held)), np.uint8)
        bins[list(own)] = places
        table = table[:, held]
        for fold in range(n_folds):
            g, others = Growing(list(own), fold), table.sum(axis=0) - table[fold]
            for depth in range(max_depth):
                if not g.leaves:
                    break
                _split_leaves(binned, g, _held_cells(binned, g, bins, classes, others), depth)
            right = g.tree.calls(bins, by_bin=True) == classes
            out[s, fold] = table[fold][right].sum() / max(table[fold].sum(), 1)
    return out


def _held_cells(binned: Binned, g: Growing, bins: np.ndarray, classes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Rows per (leaf, feature, bin, class) of one tree's leaves, from counted rows."""
    start, k = _cells(binned, g.features), binned.n_classes
    place = np.full(len(g.tree.feature), -1)
    place[g.leaves] = np.arange(len(g.leaves))
    leaf = place[g.tree.walk(bins, by_bin=True)]
    rows = np.flatnonzero(leaf >= 0)
    size, out = len(g.leaves) * int(start[-1]), 0
    for f, at in zip(g.features, start[:-1].tolist(), strict=True):
        cell = leaf[rows] * start[-1] + at + bins[f, rows].astype(np.int64) * k + classes[rows]
        out = out + np.bincount(cell, counts[rows], size)
    return out.reshape(len(g.leaves), -1)


def right_calls(binned: Binned, grown: Sequence[Growing]) -> np.ndarray:
    """Share of each tree's own fold that it calls right: one job for all trees."""
    p, trees = len(binned.cuts), [(g.fold, g.tree) for g in grown]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        right, seen = np.zeros(len(trees), np.int64), np.zeros(len(trees), np.int64)
        for batch in batches:
            for i in range(batch.num_rows):
                bins, classes, _ = unpacked(batch, i, p)
                folds = np.frombuffer(batch.column("folds")[i].as_buffer(), np.int16)
                own = {f: np.flatnonzero(folds == f) for f in {f for f, _ in trees}}
                for t, (fold, tree) in enumerate(trees):
                    rows = own[fold]
                    right[t] += int((tree.calls(bins[:, rows], by_bin=True) == classes[rows]).sum())
                    seen[t] += len(rows)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(trees))), pa.array(right), pa.array(seen)], names=["tree", "right", "seen"])

    rows = binned.blocks.mapInArrow(count, "tree bigint, right bigint, seen bigint").groupBy("tree")
    sums = rows.agg(F.sum("right").alias("right"), F.sum("seen").alias("seen")).toPandas().sort_values("tree")
    return (sums["right"] / sums["seen"].clip(lower=1)).to_numpy(float)


def store_weights(binned: Binned, boosts: Sequence[tuple[GrownTree, float]], total: float) -> Binned:
    """The blocks with weights after ``boosts``, scaled to add up to 1, written once."""
    p = len(binned.cuts)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = []
            for i in range(batch.num_rows):
                bins, classes, weights = unpacked(batch, i, p)
                held.append((reweighted(weights, bins, classes, boosts) / total).tobytes())
            yield batch.set_column(batch.schema.get_field_index("weights"), "weights", pa.array(held, pa.binary()))

    return Binned(stage(binned.blocks.mapInArrow(work, BLOCK_SCHEMA), "binned"), binned.cuts, binned.n_classes, binned.max_bins)


def tree_rows(trees: Sequence[GrownTree]) -> pd.DataFrame:
    """All nodes of all trees, for saving."""
    return pd.DataFrame(
        [
            (t, n, tree.feature[n], tree.threshold[n], tree.cut[n], tree.left[n], tree.right[n], tree.call[n])
            for t, tree in enumerate(trees)
            for n in range(len(tree.feature))
        ],
        columns=["tree", "node", "feature", "threshold", "cut", "left", "right", "call"],
    )


def trees_of(rows: pd.DataFrame) -> list[GrownTree]:
    names = ["feature", "threshold", "cut", "left", "right", "call"]
    return [GrownTree(*(part[n].tolist() for n in names)) for _, part in rows.sort_values(["tree", "node"]).groupby("tree")]


def votes_of(trees: Sequence[GrownTree], votes: Sequence[float], k: int) -> Callable:
    """A function of a vector column's array form: the share of each class in the weighted vote of the trees.

    A class gets a tree's vote where the tree calls it and loses 1/(k-1) of it elsewhere. Equal
    trees, of which many rounds leave plenty, vote once with their votes together.
    """
    distinct: dict[tuple, list] = {}
    for tree, vote in zip(trees, votes, strict=True):
        same = (tuple(tree.feature), tuple(tree.threshold), tuple(tree.left), tuple(tree.right), tuple(tree.call))
        distinct.setdefault(same, [tree, 0.0])[1] += float(vote)
    held, total = list(distinct.values()), float(sum(votes))

    @F.arrow_udf("array<double>")
    def shares(points: pa.Array) -> pa.Array:
        n = len(points)
        values = np.ascontiguousarray(points.flatten().to_numpy(zero_copy_only=False).reshape(n, -1).T)
        got = np.zeros((n, k))
        rows = np.arange(n)
        for tree, vote in held:
            got[rows, tree.calls(values, by_bin=False)] += vote / total
        # the votes that a class did not get are those of the others
        rest = max(k - 1, 1)
        powers = np.exp((got - (got.sum(axis=1, keepdims=True) - got) / rest) / rest)
        powers /= powers.sum(axis=1, keepdims=True)
        return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * k), pa.array(powers.ravel()))

    return shares
