"""Trees and forests grown from byte bins.

A node of many rows is cut from a histogram that all tasks add up. The rows of smaller nodes are
sent, a byte per feature, to groups of nodes, and a group grows its nodes to the end. A tree's
draws of rows and a node's draw of features follow from hashes of row key, tree and node, so
neither depends on how the rows are dealt.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradeworks.operators.binned import Binned, best_cuts, unpacked

NODE_ROWS = 1_000_000  # a node of more rows is cut by all tasks
GROUP_ROWS = 300_000  # rows of a group of nodes, but for a node of more
ROWS_AT_ONCE = 100_000_000  # rows of nodes that are shuffled by one job
TABLE_CELLS = 4_000_000  # cells of the histograms that one job adds up
CELLS_AT_ONCE = 2_000_000
PURE = 1e-9  # a share of a node's weight that is taken for a rounding error
SENT_SCHEMA = "part int, at binary, classes binary, draws binary, bins binary"
GROWN_SCHEMA = "part int, feature binary, cut binary, left binary, weight binary"
# a row is drawn Poisson(1) times: the limits of 32 random bits from which on it is drawn once, twice and so on
_SHARES = np.cumsum([np.exp(-1.0) / factorial(i) for i in range(10)])
DRAW_LIMITS = (_SHARES * 2.0**32).astype(np.uint32)
# the draws that the upper 16 of the bits tell, but where a limit lies among the lower ones
_UPPER = DRAW_LIMITS >> np.uint32(16)
_DRAWS = np.searchsorted(DRAW_LIMITS, np.arange(1 << 16, dtype=np.uint32) << np.uint32(16), side="right").astype(np.uint8)
_UNTOLD = np.isin(np.arange(1 << 16), _UPPER)


@dataclass
class GrownForest:
    """Nodes of all trees; ``feature`` -1 marks a leaf, a bin up to ``cut`` goes to ``left``, others to the node after it."""

    cuts: list[np.ndarray]
    roots: np.ndarray
    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    weight: np.ndarray  # class weights of every node

    def walk(self, bins: np.ndarray, tree: int) -> np.ndarray:
        """The node each row ends in; ``bins`` has one row per feature."""
        at = np.full(bins.shape[1], self.roots[tree], np.int32)
        rows = np.arange(bins.shape[1])
        while len(rows := rows[self.feature[at[rows]] >= 0]):
            node = at[rows]
            at[rows] = self.left[node] + (bins[self.feature[node], rows] > self.cut[node])
        return at

    def leaves_of(self, bins: np.ndarray, tree: int, rows: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """The leaves that the given rows end in, each with its rows; for trees of few nodes."""
        stack = [(int(self.roots[tree]), rows)]
        while stack:
            node, rows = stack.pop()
            if not len(rows):
                continue
            if self.feature[node] < 0:
                yield node, rows
                continue
            right = bins[self.feature[node]][rows] > self.cut[node]
            stack += [(int(self.left[node]) + 1, rows[right]), (int(self.left[node]), rows[~right])]

    def shares(self, points: np.ndarray) -> np.ndarray:
        """Mean share of each class over the trees' leaves; ``points`` has one row per case."""
        bins = np.stack([np.searchsorted(c, points[:, i], side="left") for i, c in enumerate(self.cuts)]).astype(np.uint8)
        # a tree that drew no row has no shares
        leaf_shares = self.weight / np.maximum(self.weight.sum(axis=1, keepdims=True), np.finfo(float).tiny)
        total = np.zeros((len(points), self.weight.shape[1]))
        for t in range(len(self.roots)):
            total += leaf_shares[self.walk(bins, t)]
        return total / len(self.roots)

    def importances(self) -> np.ndarray:
        """Share of each feature in the impurity that the cuts of a tree take away, averaged over trees."""
        size = self.weight.sum(axis=1)
        impurity = size - (self.weight**2).sum(axis=1) / np.maximum(size, np.finfo(float).tiny)
        out = np.zeros(len(self.cuts))
        ends = [*self.roots[1:].tolist(), len(self.feature)]
        for first, end in zip(self.roots.tolist(), ends, strict=True):
            inner = first + np.flatnonzero(self.feature[first:end] >= 0)
            left = self.left[inner]
            lost = impurity[inner] - impurity[left] - impurity[left + 1]
            own = np.bincount(self.feature[inner], lost, len(out))
            if own.sum() > 0:
                out += own / own.sum()
        return out / out.sum() if out.sum() > 0 else out

    def tables(self) -> tuple[pa.Table, pa.Table]:
        """Nodes and cuts as tables, for saving."""
        root = np.zeros(len(self.feature), bool)
        root[self.roots] = True
        k = self.weight.shape[1]
        weight = pa.ListArray.from_arrays(pa.array(np.arange(len(root) + 1, dtype=np.int32) * k), pa.array(self.weight.ravel()))
        nodes = {"node": np.arange(len(root)), "root": root, "feature": self.feature, "cut": self.cut, "left": self.left, "weight": weight}
        numbers = np.concatenate([np.zeros(0, int), *[np.arange(len(c)) for c in self.cuts]])
        features = np.repeat(np.arange(len(self.cuts)), [len(c) for c in self.cuts])
        return pa.table(nodes), pa.table({"feature": features, "number": numbers, "value": np.concatenate([np.zeros(0), *self.cuts])})

    @classmethod
    def of_tables(cls, nodes: pa.Table, cuts: pa.Table, n_features: int) -> GrownForest:
        nodes, cuts = nodes.sort_by("node"), cuts.sort_by([("feature", "ascending"), ("number", "ascending")])
        owner, value = cuts["feature"].to_numpy(), cuts["value"].to_numpy()
        feature, cut, left = (nodes[c].to_numpy().astype(d) for c, d in (("feature", np.int16), ("cut", np.int16), ("left", np.int32)))
        weight = nodes["weight"].combine_chunks().flatten().to_numpy().reshape(len(feature), -1)
        roots = np.flatnonzero(nodes["root"].to_numpy()).astype(np.int32)
        return cls([value[owner == i] for i in range(n_features)], roots, feature, cut, left, weight)


@dataclass(frozen=True)
class Growth:
    """How trees are grown: features offered to a node, limits, class weights, whether rows are drawn."""

    offered: int
    max_depth: int
    least_rows: int
    class_weights: np.ndarray
    drawn: bool
    seed: int


def _mixed(x: np.ndarray) -> np.ndarray:
    """Hashes of 64-bit numbers (finalizer of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _salt(seed: int, tree: np.ndarray) -> np.ndarray:
    return _mixed((np.asarray(tree, np.uint64) + np.uint64(seed % 2**31 << 20)) * np.uint64(0x9E3779B97F4A7C15))


def draws_of(marks: np.ndarray, tree: int, growth: Growth) -> np.ndarray:
    """How often the tree draws each row."""
    if not growth.drawn:
        return np.ones(len(marks), np.uint8)
    bits = (_mixed(marks ^ _salt(growth.seed, np.array([tree]))) >> np.uint64(32)).astype(np.uint32)
    upper = bits >> np.uint32(16)
    out = _DRAWS[upper]
    untold = np.flatnonzero(_UNTOLD[upper])
    out[untold] = np.searchsorted(DRAW_LIMITS, bits[untold], side="right")
    return out


def features_of(tree: np.ndarray, path: np.ndarray, p: int, growth: Growth) -> np.ndarray:
    """The features offered to each node, ascending."""
    if growth.offered >= p:
        return np.broadcast_to(np.arange(p), (len(path), p))
    node = _mixed(_salt(growth.seed + 1, tree) ^ (path.astype(np.uint64) * np.uint64(0xD1342543DE82EF95)))
    order = _mixed(node[:, None] + np.arange(1, p + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return np.sort(np.argpartition(order, growth.offered - 1, axis=1)[:, : growth.offered], axis=1)


def _table(bins: np.ndarray, rows: np.ndarray, classes: np.ndarray, draws: np.ndarray, leaf: np.ndarray, offered: np.ndarray, b: int, k: int) -> np.ndarray:
    """Draws per (leaf, offered feature, bin, class) of the given rows."""
    n, s = offered.shape
    out = np.empty((n, s, b, k))
    base = leaf * (b * k) + classes
    for j in range(s):
        cell = base + bins[offered[leaf, j], rows].astype(np.int64) * k
        out[:, j] = np.bincount(cell, draws, n * b * k).reshape(n, b, k)
    return out


def _impure(weight: np.ndarray) -> np.ndarray:
    total = weight.sum(axis=-1)
    return total - weight.max(axis=-1) > PURE * total


def grow_group(bins: np.ndarray, classes: np.ndarray, draws: np.ndarray, at: np.ndarray, tree: np.ndarray, path: np.ndarray, depth: np.ndarray, b: int, growth: Growth) -> tuple[np.ndarray, ...]:
    """Grow nodes to the end from all their rows, level by level: feature, cut, left and class weights of every node.

    ``at`` is the place of a row's node in ``tree``, ``path`` (its number in a heap) and ``depth``;
    nodes found are numbered after these, children beside each other.
    """
    p, k = len(bins), len(growth.class_weights)
    root = np.bincount(at * k + classes, draws, len(tree) * k).reshape(-1, k) * growth.class_weights
    feature, cut, left, weight = [np.full(len(tree), -1)], [np.zeros(len(tree), int)], [np.full(len(tree), -1)], [root]
    made = len(tree)
    held = np.flatnonzero(_impure(root) & (depth < growth.max_depth))
    first = 0  # number of the level's first node
    rows, at = np.arange(len(at)), at.astype(np.int64)
    chunk = max(1, CELLS_AT_ONCE // (growth.offered * b * k))
    while len(held):
        place = np.full(len(tree), -1)
        place[held] = np.arange(len(held))
        leaf = place[at]
        rows, leaf = rows[leaf >= 0], leaf[leaf >= 0]
        # numbers of two bytes are sorted in linear time
        order = np.argsort(leaf.astype(np.uint16) if len(held) < 1 << 16 else leaf, kind="stable")
        rows, leaf = rows[order], leaf[order]
        ends = np.searchsorted(leaf, np.arange(len(held) + 1))
        child, next_tree, next_path, next_depth, next_weight = np.full(len(leaf), -1), [], [], [], []
        opened = 0
        for a in range(0, len(held), chunk):
            own = held[a : a + chunk]
            part = slice(ends[a], ends[a + len(own)])
            r, l = rows[part], leaf[part] - a
            offered = features_of(tree[own], path[own], p, growth)
            table = _table(bins, r, classes[r], draws[r], l, offered, b, k)
            found = best_cuts(table * growth.class_weights, growth.least_rows, growth.class_weights)
            gains = np.flatnonzero(found.gains)
            f, c = offered[np.arange(len(own)), found.feature], found.cut
            number = np.full(len(own), -1)
            number[gains] = opened + 2 * np.arange(len(gains))
            grown = first + own[gains]
            for store, values in ((feature, f[gains]), (cut, c[gains]), (left, made + number[gains])):
                level = store[-1]
                level[grown - first] = values
            child[part] = np.where(number[l] >= 0, number[l] + (bins[f[l], r] > c[l]), -1)
            opened += 2 * len(gains)
            next_tree.append(np.repeat(tree[own[gains]], 2))
            next_path.append((2 * path[own[gains]][:, None] + np.arange(2)).ravel())
            next_depth.append(np.repeat(depth[own[gains]] + 1, 2))
            next_weight.append(np.stack([found.left[gains], found.right[gains]], axis=1).reshape(-1, k))
        tree, path, depth = (np.concatenate(x) for x in (next_tree, next_path, next_depth))
        first, made = made, made + opened
        feature.append(np.full(opened, -1))
        cut.append(np.zeros(opened, int))
        left.append(np.full(opened, -1))
        weight.append(np.concatenate(next_weight))
        rows, at = rows[child >= 0], child[child >= 0]
        held = np.flatnonzero(_impure(weight[-1]) & (depth < growth.max_depth))
    kinds = (np.int16, np.int16, np.int32, float)
    return tuple(np.concatenate(x).astype(t) for x, t in zip((feature, cut, left, weight), kinds, strict=True))


@dataclass
class _Open:
    """A node that may be cut."""

    node: int
    tree: int
    path: int
    depth: int
    rows: float  # draws


def _marks(batch: pa.RecordBatch, i: int) -> np.ndarray:
    return np.frombuffer(batch.column("marks")[i].as_buffer(), np.uint64)


class _Batch:
    """Some trees of a forest while they grow."""

    def __init__(self, binned: Binned, trees: range, n_rows: int, growth: Growth):
        self.binned, self.trees, self.growth = binned, trees, growth
        n, k = len(trees), binned.n_classes
        self.forest = GrownForest(
            binned.cuts, np.arange(n, dtype=np.int32), np.full(n, -1, np.int16), np.zeros(n, np.int16), np.full(n, -1, np.int32), np.zeros((n, k))
        )
        self.open = [_Open(i, t, 1, 0, n_rows) for i, t in enumerate(trees)]

    def grow(self) -> GrownForest:
        most = max(1, TABLE_CELLS // (self.growth.offered * self.binned.max_bins * self.binned.n_classes))
        while large := [o for o in self.open if o.rows > NODE_ROWS and o.depth < self.growth.max_depth]:
            self._cut(large[:most])
        small, self.open, room = self.open, [], 0.0
        sent: list[list[_Open]] = []
        for o in small:
            if not sent or o.rows > room:
                sent.append([])
                room = ROWS_AT_ONCE
            sent[-1].append(o)
            room -= o.rows
        for nodes in sent:
            self._finish(nodes)
        return self.forest

    def _visit(self, nodes: Sequence[_Open]) -> Callable:
        """A function of a block's bins and marks: (place of the node, rows, draws) for every wanted node and its rows."""
        forest, growth = self.forest, self.growth
        place = np.full(len(forest.feature), -1)
        place[[o.node for o in nodes]] = np.arange(len(nodes))
        wanted = [(t, number) for t, number in enumerate(self.trees) if number in {o.tree for o in nodes}]

        def visit(bins: np.ndarray, marks: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
            for t, number in wanted:
                draws = draws_of(marks, number, growth)
                for node, rows in forest.leaves_of(bins, t, np.flatnonzero(draws)):
                    if place[node] >= 0:
                        yield int(place[node]), rows, draws[rows]

        return visit

    def _add(self, feature: np.ndarray, cut: np.ndarray, left: np.ndarray, weight: np.ndarray) -> None:
        f = self.forest
        pairs = ((f.feature, feature), (f.cut, cut), (f.left, left), (f.weight, weight))
        f.feature, f.cut, f.left, f.weight = (np.concatenate([a, b.astype(a.dtype)]) for a, b in pairs)

    def _cut(self, large: Sequence[_Open]) -> None:
        """Cut nodes of many rows by a histogram of all tasks: one job."""
        binned, growth = self.binned, self.growth
        b, k, p = binned.max_bins, binned.n_classes, len(binned.cuts)
        offered = features_of(np.array([o.tree for o in large]), np.array([o.path for o in large]), p, growth)
        visit, shape = self._visit(large), (len(large), offered.shape[1], b, k)

        def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(shape)
            for batch in batches:
                for i in range(batch.num_rows):
                    bins, classes, _ = unpacked(batch, i, p)
                    cell = bins.astype(np.int64) * k + classes
                    for node, rows, draws in visit(bins, _marks(batch, i)):
                        for j, f in enumerate(offered[node]):
                            total[node, j] += np.bincount(cell[f][rows], draws, b * k).reshape(b, k)
            cells = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(total.ravel()[cells])], names=["cell", "n"])

        sums = binned.blocks.mapInArrow(add_up, "cell bigint, n double").groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
        table = np.zeros(int(np.prod(shape)))
        table[sums["cell"].to_numpy(np.int64)] = sums["n"].to_numpy(float)
        table = table.reshape(shape)
        found = best_cuts(table * growth.class_weights, growth.least_rows, growth.class_weights)
        cut = {o.node for o in large}
        self.open = [o for o in self.open if o.node not in cut]
        for i, o in enumerate(large):
            if not o.depth:
                self.forest.weight[o.node] = table[i, 0].sum(axis=0) * growth.class_weights
            if not found.gains[i]:
                continue
            made, sides = len(self.forest.feature), np.stack([found.left[i], found.right[i]])
            self.forest.feature[o.node], self.forest.cut[o.node], self.forest.left[o.node] = offered[i, found.feature[i]], found.cut[i], made
            self._add(np.full(2, -1), np.zeros(2), np.full(2, -1), sides)
            if o.depth + 1 < growth.max_depth:
                draws = (sides / growth.class_weights).sum(axis=1)
                self.open += [_Open(made + j, o.tree, 2 * o.path + j, o.depth + 1, draws[j]) for j in range(2) if _impure(sides[j])]

    def _finish(self, nodes: Sequence[_Open]) -> None:
        """Send the rows of some nodes to groups of them, which grow them to the end: one job."""
        binned, growth = self.binned, self.growth
        p, b = len(binned.cuts), binned.max_bins
        parts: list[list[_Open]] = []
        room = 0.0
        for o in nodes:
            if not parts or o.rows > room:
                parts.append([])
                room = GROUP_ROWS
            parts[-1].append(o)
            room -= o.rows
        part_of = np.repeat(np.arange(len(parts)), [len(x) for x in parts])
        first = np.cumsum([0, *[len(x) for x in parts]])
        heads = [tuple(np.array([getattr(o, c) for o in part]) for c in ("tree", "path", "depth")) for part in parts]
        visit = self._visit(nodes)

        def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(batch.num_rows):
                    bins, classes, _ = unpacked(batch, i, p)
                    points = np.ascontiguousarray(bins.T)
                    pieces: dict[int, list[tuple]] = {}
                    for node, rows, draws in visit(bins, _marks(batch, i)):
                        part = int(part_of[node])
                        pieces.setdefault(part, []).append((np.full(len(rows), node - first[part], np.int32), rows, draws))
                    out = []
                    for part, found in pieces.items():
                        at, rows, draws = (np.concatenate(x) for x in zip(*found, strict=True))
                        out.append((part, at.tobytes(), classes[rows].tobytes(), draws.tobytes(), points[rows].tobytes()))
                    columns = list(zip(*out, strict=True)) or [()] * 5
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(columns[0], pa.int32()), *[pa.array(c, pa.binary()) for c in columns[1:]]],
                        names=["part", "at", "classes", "draws", "bins"],
                    )

        def finish(key: tuple, table: pa.Table) -> pa.Table:
            def whole(column: str, kind: type) -> np.ndarray:
                return np.frombuffer(b"".join(table.column(column).to_pylist()), kind)

            number = key[0].as_py()
            bins = np.ascontiguousarray(whole("bins", np.uint8).reshape(-1, p).T)
            classes, draws, at = whole("classes", np.int8), whole("draws", np.uint8), whole("at", np.int32)
            grown = grow_group(bins, classes.astype(np.int64), draws.astype(float), at.astype(np.int64), *heads[number], b, growth)
            return pa.table([pa.array([number], pa.int32()), *[pa.array([x.tobytes()], pa.binary()) for x in grown]], names=["part", "feature", "cut", "left", "weight"])

        sent = binned.blocks.mapInArrow(send, SENT_SCHEMA).repartition(len(parts), "part")
        for row in sorted(sent.groupBy("part").applyInArrow(finish, GROWN_SCHEMA).collect(), key=lambda r: r["part"]):
            feature, cut, left = (np.frombuffer(row[c], t) for c, t in (("feature", np.int16), ("cut", np.int16), ("left", np.int32)))
            weight = np.frombuffer(row["weight"], float).reshape(len(feature), -1)
            roots = [o.node for o in parts[row["part"]]]
            n, made = len(roots), len(self.forest.feature)
            # nodes after the roots are numbered on from those held; a leaf's left stays without meaning
            left = left + (made - n)
            self.forest.feature[roots], self.forest.cut[roots], self.forest.left[roots], self.forest.weight[roots] = feature[:n], cut[:n], left[:n], weight[:n]
            self._add(feature[n:], cut[n:], left[n:], weight[n:])


def grow_forest(binned: Binned, n_rows: int, n_trees: int, growth: Growth) -> GrownForest:
    """Grow ``n_trees`` trees from blocks whose ``marks`` are hashes of the row keys.

    Nodes of more than ``NODE_ROWS`` rows are cut for all trees together, a job for each level while
    their histograms are within ``TABLE_CELLS``; all others take a job for every ``ROWS_AT_ONCE`` rows.
    The driver gets the nodes.
    """
    return _joined([_Batch(binned, range(n_trees), n_rows, growth).grow()])


def _joined(grown: Sequence[GrownForest]) -> GrownForest:
    """One forest; a tree's nodes are put side by side, its root first."""
    parts, roots, made = [], [], 0
    for f in grown:
        # children come after their parents, so one pass names each node's tree
        tree = np.full(len(f.feature), -1)
        tree[f.roots] = np.arange(len(f.roots))
        level = f.roots
        while len(level := level[f.feature[level] >= 0]):
            left = f.left[level]
            tree[left] = tree[left + 1] = tree[level]
            level = np.concatenate([left, left + 1])
        order = np.argsort(tree, kind="stable")
        number = np.empty(len(order), np.int64)
        number[order] = np.arange(len(order))
        left = np.where(f.feature >= 0, number[np.maximum(f.left, 0) * (f.feature >= 0)] + made, -1)
        parts.append((f.feature[order], f.cut[order], left[order].astype(np.int32), f.weight[order]))
        roots.append(number[f.roots] + made)
        made += len(order)
    return GrownForest(grown[0].cuts, np.concatenate(roots).astype(np.int32), *(np.concatenate(x) for x in zip(*parts, strict=True)))


def shares_of(forest: GrownForest) -> Callable:
    """A function of a vector column's array form: the forest's share of each class."""
    p = len(forest.cuts)

    @F.arrow_udf("array<double>")
    def shares(points: pa.Array) -> pa.Array:
        values = points.flatten().to_numpy(zero_copy_only=False).reshape(-1, p)
        out = forest.shares(values)
        return pa.ListArray.from_arrays(pa.array(np.arange(len(out) + 1, dtype=np.int32) * out.shape[1]), pa.array(out.ravel()))

    return shares
