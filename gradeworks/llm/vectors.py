"""Exact top-k by inner product with a vector-approximation file.

Each component is kept as the number of its cell, one byte. A scan of the cells bounds every
score from both sides: with the cell's lower and upper edges, two matrix products per block.
Vectors whose upper bound reaches the k-th best lower bound are read exactly, those with the
highest bounds first; after that only vectors remain whose bound reaches the k-th exact score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gradeworks.llm.common import arrow_schema, as_batch, empty_like, map_batches
from gradeworks.session import stage

# rows are told apart by a number of their own, since ids may repeat
CANDIDATES_SCHEMA = "query bigint, row bigint, low double, high double"
SCORES_SCHEMA = "query bigint, row bigint, vec_id bigint, score bigint"
RESULT_SCHEMA = "query bigint, rank int, vec_id bigint, score bigint"
MOST_CERTAIN = 2**53  # up to here bounds in double precision are certain
SALTS = 64


@dataclass(frozen=True)
class SearchOptions:
    """``cells`` per component, at most 256, with edges at the quantiles of ``sample_rows`` rows.

    The sample only decides how tight the bounds are, not the result. ``query_rows`` queries
    are held by each task at a time; ``first_reads`` vectors per query are read exactly first.
    """

    cells: int = 64
    sample_rows: int = 10_000
    query_rows: int = 4096
    block_rows: int = 2048
    first_reads: int = 32


def quantized(table: DataFrame, scale: int = 256) -> DataFrame:
    """(row, vec_id, v) with v = floor(scale * x) per component, as whole numbers; to be stored.

    Rows with a null id, a null vector or a component that is null or not finite take no part.
    Rows that repeat an id are rows of their own, told apart by ``row``.
    """
    x = F.transform("embedding", lambda c: c.cast("double"))
    usable = F.col("embedding").isNotNull() & F.forall(
        "embedding", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) != float("inf"))
    )
    rows = table.where(F.col("vec_id").isNotNull() & usable)
    v = F.transform(x, lambda c: F.floor(c * scale).cast("bigint"))
    return rows.select(F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("bigint").alias("vec_id"), v.alias("v"))


def smallest_ids(vectors: DataFrame, keep: int) -> DataFrame:
    """Of rows with equal vectors, those with the ``keep`` smallest ids.

    Equal vectors have equal scores and ties go to smaller ids, so no other copy can be among
    ``keep - 1`` results and the query itself. Copies are thinned out by salt first, so that a
    vector held by many rows is not sorted by one task.
    """
    salted = vectors.withColumns({"_salt": F.pmod(F.xxhash64("row"), F.lit(SALTS)), "_h": F.xxhash64("v")})
    for by in (["_h", "v", "_salt"], ["_h", "v"]):
        place = F.row_number().over(Window.partitionBy(*by).orderBy("vec_id", "row"))
        salted = salted.withColumn("_place", place).where(F.col("_place") <= keep)
    return salted.select("row", "vec_id", "v")


def cell_edges(vectors: DataFrame, options: SearchOptions) -> np.ndarray:
    """Edges per component, dims x (cells + 1), from a sample of ids by hash; the outer ones are exact."""
    n = vectors.count()
    share = min(1.0, options.sample_rows / max(n, 1))
    sample = vectors.where(F.pmod(F.xxhash64(F.lit("edges"), "row"), F.lit(1 << 20)) < share * (1 << 20)).select("v")
    parts = F.posexplode("v").alias("d", "x")
    ends = {r["d"]: (r["low"], r["high"]) for r in vectors.select(parts).groupBy("d").agg(F.min("x").alias("low"), F.max("x").alias("high")).collect()}
    largest = max((max(abs(low), abs(high)) for low, high in ends.values()), default=0)
    if len(ends) * largest * largest > MOST_CERTAIN:
        raise ValueError(f"components up to {largest / 256:g} give scores beyond what {len(ends)} components are added up to exactly")
    values = np.array([r["v"] for r in sample.collect()], dtype=np.int64).reshape(-1, len(ends))
    edges = []
    for d in range(len(ends)):
        low, high = ends[d]
        inner = np.quantile(values[:, d], np.linspace(0, 1, options.cells + 1)[1:-1], method="lower") if len(values) else []
        steps = np.unique(np.concatenate([[low], inner, [high + 1]]))
        edges.append(np.pad(steps, (0, options.cells + 1 - len(steps)), mode="edge"))
    return np.array(edges, dtype=np.int64)


def approximations(vectors: DataFrame, edges: np.ndarray) -> DataFrame:
    """(row, cells): one byte per component."""
    ddl = "row bigint, cells binary"
    schema = arrow_schema(ddl)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = matrix(batch.column(1), len(edges))
            cells = np.empty(v.shape, np.uint8)
            for d, steps in enumerate(edges):
                inner = np.unique(steps)
                cells[:, d] = np.searchsorted(inner, v[:, d], side="right") - 1
            yield as_batch(zip(batch.column(0).to_pylist(), map(bytes, cells), strict=True), schema)

    return map_batches(vectors.select("row", "v"), work, ddl)


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dims)


def bounded_candidates(cells: DataFrame, ids: np.ndarray, queries: np.ndarray, edges: np.ndarray, k: int, block_rows: int) -> DataFrame:
    """Per query and task: vectors whose upper bound reaches the task's k-th best lower bound."""
    schema = arrow_schema(CANDIDATES_SCHEMA)
    dims = len(edges)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q = queries.astype(float)
        up, down = np.maximum(q, 0), np.minimum(q, 0)
        lower = edges[:, :-1].astype(float)
        upper = np.maximum(edges[:, 1:].astype(float) - 1, lower)
        best = np.full((len(q), k), -np.inf)
        found: list[tuple[np.ndarray, ...]] = []

        def thinned() -> list[tuple[np.ndarray, ...]]:
            if not found:
                return []
            columns = [np.concatenate(c) for c in zip(*found, strict=True)]
            keep = columns[3] >= best[columns[0], 0]
            return [tuple(c[keep] for c in columns)]

        size = 0
        for batch in batches:
            for part in (batch.slice(i, block_rows) for i in range(0, batch.num_rows, block_rows)):
                rows = part.column(0).to_numpy()
                c = np.frombuffer(b"".join(part.column(1).to_pylist()), np.uint8).reshape(part.num_rows, dims)
                low_edge, high_edge = lower[np.arange(dims), c], upper[np.arange(dims), c]
                low = up @ low_edge.T + down @ high_edge.T
                high = up @ high_edge.T + down @ low_edge.T
                own = ids[:, None] == rows[None, :]
                low[own] = high[own] = -np.inf
                best = np.partition(np.concatenate([best, low], axis=1), -k, axis=1)[:, -k:]
                best.sort(axis=1)
                at, column = np.nonzero((high >= best[:, :1]) & ~own)
                found.append((at, rows[column], low[at, column], high[at, column]))
                size += len(at)
                if size > 500_000:
                    found = thinned()
                    size = len(found[0][0])
                    # what stays cannot be thinned again before it doubles
                    size //= 2
        for at, vec, low, high in thinned():
            for i in range(0, len(at), 100_000):
                cut = slice(i, i + 100_000)
                arrays = [pa.array(ids[at[cut]]), pa.array(vec[cut]), pa.array(low[cut]), pa.array(high[cut])]
                yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    return map_batches(cells, work, CANDIDATES_SCHEMA)


def exact_scores(candidates: DataFrame, vectors: DataFrame, ids: np.ndarray, queries: np.ndarray) -> DataFrame:
    schema = arrow_schema(SCORES_SCHEMA)
    place = {int(i): n for n, i in enumerate(ids)}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            at = np.array([place[i] for i in batch.column(0).to_pylist()])
            score = np.einsum("ij,ij->i", queries[at], matrix(batch.column(3), queries.shape[1]))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(score)], schema=schema)

    read = candidates.select("query", "row").join(vectors, "row").select("query", "row", "vec_id", "v")
    return map_batches(read, work, SCORES_SCHEMA)


def ranked(scores: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id", "row")
    return scores.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def top_k(vectors: DataFrame, queries: DataFrame, k: int, options: SearchOptions = SearchOptions()) -> DataFrame:
    """The ``k`` best of ``vectors`` (row, vec_id, v) for each row of ``queries`` (row, vec_id, v).

    A query's own ``row`` is no candidate; ties go to smaller ids, then rows; with fewer
    candidates all come out. Components must be small enough for exact scores, else this raises. Vectors are compared with queries of the same length only. Queries are taken in
    blocks of ``query_rows``, so neither the driver nor a task holds more of them.
    """
    spark = vectors.sparkSession
    out = empty_like(spark, RESULT_SCHEMA)
    queries = stage(queries, "queries")
    shapes = queries.groupBy(F.size("v").alias("dims")).agg(F.count(F.lit(1)).alias("n")).orderBy("dims").collect()
    for shape in shapes:
        own = stage(smallest_ids(vectors.where(F.size("v") == shape["dims"]), k + 1), "vectors")
        if not shape["dims"]:
            edges = np.zeros((0, 2), np.int64)
        else:
            edges = cell_edges(own, options)
        cells = stage(approximations(own, edges), "approximations") if shape["dims"] else own.select("row", F.lit(b"").alias("cells"))
        blocks = -(-shape["n"] // options.query_rows)
        for block in range(blocks):
            here = queries.where((F.size("v") == shape["dims"]) & (F.pmod(F.xxhash64("row"), F.lit(blocks)) == block)).toPandas()
            if not len(here):
                continue
            rows = here["row"].to_numpy(np.int64)
            q = np.array(here["v"].tolist(), dtype=np.int64).reshape(len(here), shape["dims"])
            out = out.unionByName(search_block(own, cells, rows, q, edges, k, options))
    named = out.join(queries.select(F.col("row").alias("query"), F.col("vec_id").alias("query_id")), "query")
    return named.select("query_id", "rank", "vec_id", "score")


def search_block(
    vectors: DataFrame, cells: DataFrame, ids: np.ndarray, q: np.ndarray, edges: np.ndarray, k: int, options: SearchOptions
) -> DataFrame:
    found = stage(bounded_candidates(cells, ids, q, edges, k, options.block_rows), "candidates")
    by_low = Window.partitionBy("query").orderBy(F.desc("low"), "row")
    certain = found.withColumn("_p", F.row_number().over(by_low)).where(F.col("_p") == k).select("query", F.col("low").alias("least"))
    by_high = Window.partitionBy("query").orderBy(F.desc("high"), "row")
    open_ = found.join(certain, "query", "left").where("least is null or high >= least")
    ordered = stage(open_.withColumn("place", F.row_number().over(by_high)), "ordered-candidates")
    first = stage(exact_scores(ordered.where(F.col("place") <= options.first_reads), vectors, ids, q), "first-scores")
    kth = ranked(first, k).where(F.col("rank") == k).select("query", F.col("score").alias("kth"))
    rest = ordered.where(F.col("place") > options.first_reads).join(kth, "query", "left").where("kth is null or high >= kth")
    scores = first.unionByName(exact_scores(rest, vectors, ids, q))
    return ranked(scores, k).select("query", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def nearest(embeddings: DataFrame, k: int = 5, every: int = 50, options: SearchOptions = SearchOptions()) -> DataFrame:
    """Top ``k`` among all rows for the rows whose id is divisible by ``every``."""
    vectors = stage(quantized(embeddings), "quantized")
    return top_k(vectors, vectors.where(F.col("vec_id") % every == 0), k, options)
