"""Exact nearest neighbours by cells and leaves of a tree of cuts.

Both sides are cut into blocks of rows along one tree of cuts, and a block into leaves of some ten
rows that lie near each other, each with its bounding box. The leaves of a query block meet their
nearest cells first, which bounds the distance of each query's neighbours; then the block meets the
cells whose boxes are not farther, in order of their least possible distance, and a query computes
only the leaves of a cell that its kth neighbour found so far does not rule out. A query block moves once,
a cell moves to the query blocks that need it, and neither side is collected. Of equal training rows
only the k of smallest ids can be neighbours; where most queries are equal, each is looked up once.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Accumulator, TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gradeworks.functions.blocks import DECIMALS, TABLE, box_distances, cut_tree, distances, matrix, nearest, nearest_rows
from gradeworks.session import stage

METRICS = ("euclidean", "manhattan")
SAMPLE_ROWS = 50_000  # the cuts between cells come from a sample; every row then has a cell
SAMPLE_LEAF = 8
SLACK = 10.0**-DECIMALS * 10  # distances are rounded, so bounds are taken a little wider
LEAF_ROWS = 64
MAX_BLOCK_ROWS = 131_072  # large query blocks, since every block moves the cells it needs
ACTIVE_ROWS = 32_768  # queries of a block that meet a cell's leaves at a time
ANCHOR_BYTES = 64 * 1024 * 1024
TASK_BUCKETS = 512


def vector(columns: Sequence[str]) -> Column:
    return F.array(*[F.col(f"`{c}`").cast("double") for c in columns])


def row_distance(a: Column, b: Column, metric: str = "euclidean") -> Column:
    """Distance of two array columns, in built-in expressions."""
    if metric == "manhattan":
        return F.aggregate(F.zip_with(a, b, lambda x, y: F.abs(x - y)), F.lit(0.0), lambda s, x: s + x)
    return F.sqrt(F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x))


def knn_join(
    queries: DataFrame,
    train: DataFrame,
    features: Sequence[str],
    key: str,
    k: int,
    metric: str = "euclidean",
    label: str | None = None,
    block_rows: int = 1024,
    cell_rows: int = 4096,
    max_cells: int = 50_000,
    compared: Accumulator | None = None,
) -> DataFrame:
    """``(query, neighbor, distance, rank[, label])``: the k nearest training rows per query, ties to the smaller id.

    Queries come in blocks of at least about ``block_rows`` rows, training rows in at most ``max_cells``
    cells of at least about ``cell_rows`` rows; both follow a tree of cuts through space.
    ``compared`` is an accumulator that counts the pairs of rows whose distance is computed.
    """
    if metric not in METRICS:
        raise ValueError(f"metric must be one of {METRICS}")
    class_ = F.col(label) if label else F.lit(None).cast("int")
    q = queries.select(F.col(key).alias("id"), vector(features).alias("v"))
    t = train.select(F.col(key).alias("id"), class_.alias("label"), vector(features).alias("v"))
    first = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    t = stage(t.withColumn("copy", first).where(F.col("copy") <= k).drop("copy"), "train")
    n = q.agg(F.count(F.lit(1)).alias("all"), F.approx_count_distinct(F.xxhash64("v")).alias("distinct")).first()
    copied = n["all"] > 2 * n["distinct"]
    single = q.groupBy("v").agg(F.min("id").alias("id")).select("id", "v") if copied else q
    single = stage(single, "queries") if copied else single
    places = _places(t, t.count())
    share = -(-(n["distinct"] if copied else n["all"]) // (2 * queries.sparkSession.sparkContext.defaultParallelism))
    q_blocks, _ = _in_blocks(single, places, max(block_rows, min(MAX_BLOCK_ROWS, share)), None, "query-blocks")
    cells, _ = _in_blocks(t, places, cell_rows, max_cells, "train-cells")
    boxes = _boxes(cells, len(features))
    id_type, label_type = t.schema["id"].dataType, t.schema["label"].dataType
    visit = _Visit(len(features), k, metric, compared)

    # first the nearest cells of every leaf, which bound the distance of every query's neighbours
    unbounded = q_blocks.withColumn("limits", F.lit(None).cast("array<double>"))
    limits = visit.run(_meet(unbounded, cells, _candidates(unbounded, boxes, metric, k)), "block bigint, limits array<double>", limits_only=True)
    bounded = stage(q_blocks.join(limits, "block"), "bounded-blocks")
    # then every cell that can hold something nearer
    schema = T.StructType(
        [
            T.StructField("query", id_type),
            T.StructField("neighbor", id_type),
            T.StructField("distance", T.DoubleType()),
            T.StructField("rank", T.IntegerType()),
            T.StructField("label", label_type),
        ]
    )
    found = visit.run(_meet(bounded, cells, _candidates(bounded, boxes, metric, k)), schema, limits_only=False)
    if copied:
        members = q.join(single.withColumnRenamed("id", "query"), "v").select("id", "query")
        found = found.join(members, "query").select(F.col("id").alias("query"), "neighbor", "distance", "rank", "label")
    return found if label else found.drop("label")


def _places(train: DataFrame, n_train: int):
    """A column of places in a tree of cuts, for both sides; near places share most cuts.

    The cuts come from about ``SAMPLE_ROWS`` rows by hash of the id.
    """
    some = F.pmod(F.xxhash64("id"), F.lit(max(1, -(-n_train // SAMPLE_ROWS)))) == 0
    sample = [r["v"] for r in train.where(some).select("v").limit(2 * SAMPLE_ROWS).collect()]
    cuts, _ = cut_tree(np.array(sample, float).reshape(len(sample), -1), SAMPLE_LEAF)

    @F.pandas_udf("bigint")
    def place(v: pd.Series) -> pd.Series:
        return pd.Series(cuts.leaf_of(np.stack(v.to_numpy())) if len(v) else [], dtype="int64")

    return place


def _in_blocks(rows: DataFrame, places, size: int, most: int | None, name: str) -> tuple[DataFrame, int]:
    """One row per block of about ``size`` rows of places that follow each other, and the number of rows.

    A block is a range of places. Where very many rows have one place, the range is several
    blocks by hash of the id.
    """
    placed = stage(rows.withColumn("z", places("v")), f"{name}-rows")
    n = placed.count()
    n_blocks = max(1, -(-n // max(1, size)))
    if most is not None:
        n_blocks = min(n_blocks, most)
    size = max(1, -(-n // n_blocks))
    shares = [i / n_blocks for i in range(1, n_blocks)]
    cuts = np.unique(np.array(placed.agg(F.percentile_approx("z", shares, max(10_000, 4 * n_blocks)).alias("q")).first()["q"] or [], np.int64)) if shares else np.array([], np.int64)

    @F.pandas_udf("bigint")
    def range_of(z: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(cuts, z.to_numpy(), side="left"))

    ranged = placed.withColumn("range", range_of("z"))
    full = {r["range"]: -(-r["n"] // size) for r in ranged.groupBy("range").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 2 * size).collect()}
    starts = np.ones(len(cuts) + 1, np.int64)
    starts[list(full)] = list(full.values())
    starts = np.concatenate([[0], np.cumsum(starts)])

    @F.pandas_udf("bigint")
    def block_of(range_: pd.Series, code: pd.Series) -> pd.Series:
        at = range_.to_numpy()
        return pd.Series(starts[at] + code.to_numpy() % (starts[at + 1] - starts[at]))

    code = F.pmod(F.xxhash64("id"), F.lit(1 << 30))
    fields = [c for c in ("id", "label", "v") if c in rows.columns]
    packed = (
        ranged.withColumn("block", block_of("range", code))
        .groupBy("block")
        .agg(F.collect_list(F.struct(*fields)).alias("rows"))
        .select(
            "block",
            F.col("rows.id").alias("ids"),
            *([F.col("rows.label").alias("labels")] if "label" in fields else []),
            F.flatten(F.col("rows.v")).alias("values"),
        )
    )
    return stage(_with_leaves(packed), name), n


def _with_leaves(packed: DataFrame) -> DataFrame:
    """Blocks with their rows in order of leaves, and ``starts``, where the leaves begin."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                held = {name: batch.column(name)[i].values for name in batch.schema.names if name not in ("block", "values")}
                points = matrix_of(batch.column("values")[i].values, len(batch.column("values")[i]) // len(held["ids"]))
                _, leaves = cut_tree(points, LEAF_ROWS)
                order, starts = np.concatenate(leaves), np.cumsum([0, *map(len, leaves[:-1])])
                held = {name: column.take(pa.array(order)) for name, column in held.items()}
                held |= {"starts": pa.array(starts, pa.int64())}
                lists = [pa.ListArray.from_arrays(pa.array([0, len(column)], pa.int32()), column) for column in held.values()]
                values = pa.array([packed_values(points[order])], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column("block").slice(i, 1), *lists, values], names=["block", *held, "values"])

    schema = T.StructType([f for f in packed.schema.fields if f.name != "values"])
    return packed.mapInArrow(work, schema.add("starts", T.ArrayType(T.LongType())).add("values", T.BinaryType()))


@dataclass(frozen=True)
class _Boxes:
    """Least and greatest value per feature, and number of rows, of every cell."""

    cells: np.ndarray
    low: np.ndarray
    high: np.ndarray
    sizes: np.ndarray

    def least_distance(self, low: np.ndarray, high: np.ndarray, metric: str) -> np.ndarray:
        """How near a row of each cell can be to a point of the box [low, high]."""
        gap = np.maximum(0.0, np.maximum(self.low - high, low - self.high))
        return gap.sum(axis=1) if metric == "manhattan" else np.sqrt((gap * gap).sum(axis=1))


def _boxes(cells: DataFrame, width: int) -> _Boxes:
    """The boxes of all cells, whose number is bounded."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = [unpacked(batch.column("values")[i], width) for i in range(batch.num_rows)]
            data = [[x.min(axis=0) for x in held], [x.max(axis=0) for x in held], [len(x) for x in held]]
            types = [pa.list_(pa.float64()), pa.list_(pa.float64()), pa.int64()]
            yield pa.RecordBatch.from_arrays([batch.column("block"), *(pa.array(d, t) for d, t in zip(data, types, strict=True))], names=["block", "low", "high", "n"])

    rows = cells.select("block", "values").mapInArrow(work, "block bigint, low array<double>, high array<double>, n bigint").toPandas()
    shape = (len(rows), width)
    return _Boxes(
        rows["block"].to_numpy(np.int64), np.array(rows["low"].tolist(), float).reshape(shape),
        np.array(rows["high"].tolist(), float).reshape(shape), rows["n"].to_numpy(np.int64),
    )


def _leaf_boxes(points: np.ndarray, starts: np.ndarray) -> _Boxes:
    low, high = np.minimum.reduceat(points, starts, axis=0), np.maximum.reduceat(points, starts, axis=0)
    return _Boxes(np.arange(len(starts)), low, high, np.diff([*starts, len(points)]))


def _candidates(q_blocks: DataFrame, boxes: _Boxes, metric: str, k: int) -> DataFrame:
    """``(block, cell, least)``: per query block the cells that some leaf's ``limits`` reach; without limits, the nearest with ``k`` rows."""
    shipped = q_blocks.sparkSession.sparkContext.broadcast(boxes)
    width = boxes.low.shape[1]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shipped.value
        for batch in batches:
            for i in range(batch.num_rows):
                points, starts = unpacked(batch.column("values")[i], width), batch.column("starts")[i].values.to_numpy()
                leaves, limits = _leaf_boxes(points, starts), batch.column("limits")[i]
                bounds = np.maximum.reduceat(limits.values.to_numpy(zero_copy_only=False), starts) if limits.is_valid else None
                least = np.full(len(known.cells), np.inf)
                wanted = np.zeros(len(known.cells), bool)
                for leaf, (low, high) in enumerate(zip(leaves.low, leaves.high, strict=True)):
                    own = known.least_distance(low, high, metric)
                    if bounds is None:
                        middle = (low + high) / 2
                        order = np.lexsort((known.least_distance(middle, middle, metric), own))
                        wanted[order[: int(np.searchsorted(np.cumsum(known.sizes[order]), k)) + 1]] = True
                    else:
                        wanted |= own <= bounds[leaf] + SLACK
                    np.minimum(least, own, out=least)
                chosen = np.flatnonzero(wanted)
                columns = [np.full(len(chosen), batch.column("block")[i].as_py(), np.int64), known.cells[chosen], least[chosen]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["block", "cell", "least"])

    return q_blocks.select("block", "values", "starts", "limits").mapInArrow(work, "block bigint, cell bigint, least double")


def _meet(q_blocks: DataFrame, cells: DataFrame, pairs: DataFrame) -> DataFrame:
    """Every query block, once, followed by its cells from the nearest on."""
    columns = ["block", "least", "ids", "labels", "values", "starts", "limits"]
    none = F.lit(None).cast("array<double>").alias("limits")
    sides = pairs.join(cells.withColumnRenamed("block", "cell"), "cell").withColumn("limits", none).select(columns)
    labels = F.lit(None).cast(cells.schema["labels"].dataType)
    own = q_blocks.withColumn("least", F.lit(-1.0)).withColumn("labels", labels).select(columns)
    return own.unionByName(sides).repartition("block").sortWithinPartitions("block", "least")


class _Visit:
    """Reads a query block and then its cells, keeping the k nearest rows of every query."""

    def __init__(self, width: int, k: int, metric: str, compared: Accumulator | None):
        self.width, self.k, self.metric, self.compared = width, k, metric, compared

    def run(self, met: DataFrame, schema: str | T.StructType, limits_only: bool) -> DataFrame:
        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            nearest_ = None
            for batch in batches:
                for i in range(batch.num_rows):
                    least, ids = batch.column("least")[i].as_py(), batch.column("ids")[i].values
                    points, starts = unpacked(batch.column("values")[i], self.width), batch.column("starts")[i].values.to_numpy()
                    if least < 0:
                        if nearest_ is not None:
                            yield nearest_.result(limits_only)
                        nearest_ = _Nearest(batch.column("block")[i].as_py(), ids, points, starts, batch.column("limits")[i], self, batch.schema)
                    else:
                        nearest_.add(least, ids, batch.column("labels")[i].values, points, starts)
            if nearest_ is not None:
                yield nearest_.result(limits_only)

        return met.mapInArrow(work, schema)


class _Nearest:
    """The k nearest rows seen so far of each query of a block, by distance and id; free places are infinitely far."""

    def __init__(self, block: int, ids: pa.Array, points: np.ndarray, starts: np.ndarray, limits: pa.Scalar, visit: _Visit, schema: pa.Schema):
        self.block, self.ids, self.points, self.starts, self.visit = block, ids, points, starts, visit
        self.id_type, self.label_type = schema.field("ids").type.value_type, schema.field("labels").type.value_type
        self.leaves = _leaf_boxes(points, starts)
        self.ends = [*starts[1:], len(points)]
        shape = (len(points), visit.k)
        self.dist, self.labels = np.full(shape, np.inf), np.full(shape, None, object)
        self.found = np.zeros(shape, ids.to_numpy(zero_copy_only=False).dtype)
        self.kth = limits.values.to_numpy(zero_copy_only=False).copy() if limits.is_valid else np.full(len(points), np.inf)

    def add(self, least: float, ids: pa.Array, labels: pa.Array, values: np.ndarray, starts: np.ndarray) -> None:
        if least > self.kth.max() + SLACK:
            return
        metric, cell = self.visit.metric, _leaf_boxes(values, starts)
        whole = _Boxes(np.zeros(0), self.points, self.points, np.zeros(0))
        # a query looks only into cells, and there into leaves, that can hold a nearer row than its kth
        active = np.flatnonzero(whole.least_distance(cell.low.min(axis=0), cell.high.max(axis=0), metric) <= self.kth + SLACK)
        if not len(active):
            return
        numbers, classes = ids.to_numpy(zero_copy_only=False), np.array(labels.to_pylist(), dtype=object)
        for at in range(0, len(active), ACTIVE_ROWS):
            self._look(active[at : at + ACTIVE_ROWS], cell, numbers, classes, values, starts)

    def _look(self, active: np.ndarray, cell: _Boxes, numbers: np.ndarray, classes: np.ndarray, values: np.ndarray, starts: np.ndarray) -> None:
        """Some queries look into the leaves of a cell."""
        gaps = box_distances(self.points[active], cell.low, cell.high, self.visit.metric)
        unbounded = ~np.isfinite(self.kth[active])
        nearest_leaf = np.where(unbounded, gaps.argmin(axis=1), -1)
        for first in (True, False) if unbounded.any() else (False,):
            for leaf, (start, size) in enumerate(zip(starts, cell.sizes, strict=True)):
                looks = nearest_leaf == leaf if first else (nearest_leaf != leaf) & (gaps[:, leaf] <= self.kth[active] + SLACK)
                if looks.any():
                    own = slice(start, start + size)
                    self._compare(active[looks], numbers[own], classes[own], values[own])

    def _compare(self, active: np.ndarray, numbers: np.ndarray, classes: np.ndarray, values: np.ndarray) -> None:
        """Keep the k nearest of what some queries hold and of some rows."""
        k = self.visit.k
        if self.visit.compared is not None:
            self.visit.compared.add(len(active) * len(values))
        parts = list(nearest_rows(self.points[active], values, numbers, k, self.visit.metric, self.kth[active]))
        query = np.concatenate([active[r] for r, _, _ in parts])
        if not len(query):
            return
        row = np.concatenate([c for _, c, _ in parts])
        own = query[np.flatnonzero(np.diff(query, prepend=-1))]
        at = np.concatenate([np.repeat(own, k), query])
        dist = np.concatenate([self.dist[own].ravel(), *(d for _, _, d in parts)])
        found = np.concatenate([self.found[own].ravel(), numbers[row]])
        held = np.concatenate([self.labels[own].ravel(), classes[row]])
        order = np.lexsort((found, dist, at))
        order = order[np.arange(len(order)) - np.searchsorted(at[order], at[order]) < k].reshape(len(own), k)
        self.dist[own], self.found[own], self.labels[own] = dist[order], found[order], held[order]
        self.kth[own] = np.minimum(self.kth[own], self.dist[own, -1])

    def result(self, limits_only: bool) -> pa.RecordBatch:
        if limits_only:
            limits = pa.ListArray.from_arrays(pa.array([0, len(self.kth)], pa.int32()), pa.array(self.kth))
            return pa.RecordBatch.from_arrays([pa.array([self.block], pa.int64()), limits], names=["block", "limits"])
        rows, rank = np.nonzero(np.isfinite(self.dist))
        return pa.RecordBatch.from_arrays(
            [
                self.ids.take(pa.array(rows)),
                pa.array(self.found[rows, rank], self.id_type),
                pa.array(self.dist[rows, rank]),
                pa.array((rank + 1).astype(np.int32)),
                pa.array(self.labels[rows, rank], self.label_type),
            ],
            names=["query", "neighbor", "distance", "rank", "label"],
        )


def packed_values(points: np.ndarray) -> bytes:
    """Rows of a block, column by column and compressed, as a cell moves to many query blocks."""
    return len(points).to_bytes(8, "little") + pa.compress(np.ascontiguousarray(points.T, dtype="<f8").tobytes(), codec="zstd", asbytes=True)


def unpacked(values: pa.BinaryScalar, width: int) -> np.ndarray:
    held = values.as_buffer()
    n = int.from_bytes(held[:8].to_pybytes(), "little")
    return np.ascontiguousarray(np.frombuffer(pa.decompress(held[8:], decompressed_size=8 * n * width, codec="zstd"), "<f8").reshape(width, n).T)


def matrix_of(values: pa.Array, width: int) -> np.ndarray:
    return values.to_numpy(zero_copy_only=False).reshape(-1, width)


def nearest_to_anchors(
    df: DataFrame,
    features: Sequence[str],
    key: str,
    label: str,
    anchors: Sequence[tuple[object, Sequence[float]]],
    k: int,
    metric: str = "manhattan",
    scaled: Column | None = None,
) -> DataFrame:
    """``(anchor, label, neighbor, distance, rank)``: per anchor the k nearest rows of each class.

    The anchors are a sample of bounded size, so they travel to the rows. A task keeps
    k rows per anchor and class while it reads its partition and emits only those; they are
    merged in two steps, first those of some tasks, so that no group holds the rows of all.
    The anchor itself is never its own neighbour.
    """
    width = len(features)
    if len(anchors) * (8 * width + 8) > ANCHOR_BYTES:
        raise ValueError(f"{len(anchors)} anchors of {width} features are more than tasks can hold")
    rows = df.select(
        F.col(key).alias("id"), F.col(label).alias("label"), (scaled if scaled is not None else vector(features)).alias("v")
    ).where(F.col("label").isNotNull())
    ids = np.array([a for a, _ in anchors])
    points = np.array([v for _, v in anchors], dtype=float)
    shipped = df.sparkSession.sparkContext.broadcast((ids, points))
    schema = T.StructType(
        [
            T.StructField("anchor", rows.schema["id"].dataType),
            T.StructField("label", rows.schema["label"].dataType),
            T.StructField("neighbor", rows.schema["id"].dataType),
            T.StructField("distance", T.DoubleType()),
            T.StructField("bucket", T.IntegerType()),
        ]
    )

    def best_of_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchor_ids, anchor_points = shipped.value
        best: dict[object, pd.DataFrame] = {}
        types: dict[str, pa.DataType] = {}
        step = max(1, 16 * TABLE // len(anchor_ids))
        for batch in (b.slice(i, step) for b in batches for i in range(0, b.num_rows, step)):
            types = {f.name: f.type for f in batch.schema}
            row_ids = batch.column("id").to_numpy(zero_copy_only=False)
            labels = batch.column("label").to_numpy(zero_copy_only=False)
            values = matrix(batch.column("v"), width)
            for c in np.unique(labels):
                member = labels == c
                own = row_ids[member]
                dist = distances(anchor_points, values[member], metric)
                dist[anchor_ids[:, None] == own[None, :]] = np.inf
                at, col = nearest(dist, own, k)
                new = pd.DataFrame({"at": at, "neighbor": own[col], "distance": dist[at, col]})
                new = pd.concat([best[c], new]) if c in best else new
                new = new[np.isfinite(new["distance"])].sort_values(["at", "distance", "neighbor"])
                best[c] = new.groupby("at").head(k)
        for c, kept in best.items():
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(anchor_ids[kept["at"].to_numpy()], type=types["id"]),
                    pa.array([c] * len(kept), type=types["label"]),
                    pa.array(kept["neighbor"].to_numpy(), type=types["id"]),
                    pa.array(kept["distance"].to_numpy()),
                    pa.array(np.full(len(kept), TaskContext.get().partitionId() % TASK_BUCKETS, np.int32)),
                ],
                names=["anchor", "label", "neighbor", "distance", "bucket"],
            )

    def best(found: DataFrame, *group: str) -> DataFrame:
        order = Window.partitionBy(*group).orderBy("distance", "neighbor")
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    some = best(rows.mapInArrow(best_of_partition, schema), "anchor", "label", "bucket").drop("bucket", "rank")
    return best(some, "anchor", "label")


def knn_votes(neighbors: DataFrame, classes: Sequence[int], weights: str = "uniform") -> DataFrame:
    """``(query, prediction, probability)``: equal or inverse-distance votes, ties to the first class.

    With inverse distances a neighbour at distance zero outvotes all others.
    """
    if weights not in ("uniform", "distance"):
        raise ValueError("weights must be 'uniform' or 'distance'")
    if weights == "uniform":
        vote = F.lit(1.0)
    else:
        exact = F.min("distance").over(Window.partitionBy("query")) == 0
        vote = F.when(exact, (F.col("distance") == 0).cast("double")).otherwise(F.try_divide(F.lit(1.0), F.col("distance")))
    sums = (
        neighbors.select("query", "label", vote.alias("vote"))
        .groupBy("query")
        .agg(
            F.sum("vote").alias("all"),
            *[F.sum(F.when(F.col("label") == c, F.col("vote")).otherwise(0.0)).alias(f"c{i}") for i, c in enumerate(classes)],
        )
    )
    shares = F.array(*[F.col(f"c{i}") / F.col("all") for i in range(len(classes))])
    first_best = F.array_position(F.col("probability"), F.array_max("probability")) - 1
    return sums.select("query", shares.alias("probability")).select(
        "query", F.get(F.array(*[F.lit(c) for c in classes]), first_best.cast("int")).alias("prediction"), "probability"
    )
