"""What the operators of this subpackage share: tables, batches of texts, joins with hot keys."""

from __future__ import annotations

import ctypes
import gc
import math
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gradeworks.session import broadcast_if_small

BATCH_BYTES = "8MB"
MAX_HEAVY_KEYS, MIN_HEAVY_ROWS = 1000, 10_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def map_batches(
    df: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | T.StructType
) -> DataFrame:
    """``mapInArrow`` over batches of at most ``BATCH_BYTES``, in order, so that a task's memory is bounded."""
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    conf.set(name, BATCH_BYTES)
    return df.mapInArrow(giving_back(work), schema)


def giving_back(work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``work`` that returns the memory it has freed; Python workers outlive their tasks and would add it up over stages."""

    def done(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from work(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim is not None:
            trim(0)

    return done


def arrow_schema(ddl: str) -> pa.Schema:
    """Arrow form of a DDL schema of flat columns and lists of them."""
    flat = {
        "bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(),
        "boolean": pa.bool_(), "binary": pa.binary(),
    }

    def kind(name: str) -> pa.DataType:
        return pa.list_(kind(name[6:-1])) if name.startswith("array<") else flat[name]

    return pa.schema([(c.split()[0], kind(c.split()[1])) for c in ddl.split(", ")])


def as_batch(rows: Iterable[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """Column names like those wanted that ``df`` does not have, in any case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def is_training_row(doc_id: Column) -> Column:
    """Rows whose labels may be learned: crc32 of the id as text, modulo 4, is not 2."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 != 2


def split_heavy_join(left: DataFrame, right: DataFrame, on: list[str], how: str, row_bytes: int) -> DataFrame:
    """Equi-join of rows with one row per key, safe when a few keys hold most rows of ``left``.

    ``right`` has unique keys and a column ``n`` with the key's number of rows in ``left``. If
    all of ``right`` is small by its counted rows, it is broadcast. Otherwise keys with more
    than a thousandth of the rows, of which there are at most ``MAX_HEAVY_KEYS``, are broadcast
    and their rows stay where they are; the others meet by hash.
    """
    sizes = right.agg(F.count(F.lit(1)).alias("keys"), F.sum("n").alias("rows")).first()
    keys, rows = sizes["keys"], sizes["rows"] or 0
    small = broadcast_if_small(right, keys, row_bytes)
    if small is not right:
        return left.join(small.drop("n"), on, how)
    limit = max(MIN_HEAVY_ROWS, math.ceil(rows / MAX_HEAVY_KEYS))
    heavy = F.broadcast(right.where(F.col("n") > limit).drop("n"))
    marks = F.broadcast(right.where(F.col("n") > limit).select(*on))
    hot = left.join(heavy, on, "inner")
    rest = left.join(marks, on, "left_anti").join(right.where(F.col("n") <= limit).drop("n"), on, how)
    return hot.unionByName(rest)


def empty_like(spark: SparkSession, schema: str | T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)
