"""Session helpers: where intermediate tables live, and when a side may be broadcast."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_made: ContextVar[list[str] | None] = ContextVar("made", default=None)
MAX_BROADCAST_ROWS = 1_000_000
MAX_BROADCAST_BYTES = 64 * 1024 * 1024
MAX_HOT_KEYS, MIN_HOT_ROWS = 1000, 10_000
SALTS = 64


def shared_dir(spark: SparkSession) -> str:
    """Folder for checkpoints and staged tables, taken from ``spark.checkpoint.dir``.

    A scratch folder is made only in local mode, where the driver is the whole cluster.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    current = spark.sparkContext.getCheckpointDir()
    if configured:
        if current is None:
            spark.sparkContext.setCheckpointDir(configured)
        return configured
    if current is not None:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    scratch = tempfile.mkdtemp(prefix="gradeworks-")
    spark.sparkContext.setCheckpointDir(scratch)
    return spark.sparkContext.getCheckpointDir()


def checkpointed(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: cuts the lineage and survives the loss of executors."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def staged_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/staged/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Later jobs then prune columns in the Parquet scan, and the planner knows the
    table's real size when it picks a join strategy.
    """
    path = staged_path(df.sparkSession, name)
    if (made := _made.get()) is not None:
        made.append(path)
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Removes the tables staged inside the block, by this thread, when the block ends.

    For work whose results are values, such as one trial of a search. Frames that read the
    tables must not be used afterwards.
    """
    made: list[str] = []
    token = _made.set(made)
    try:
        yield
    finally:
        _made.reset(token)
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        for name in made:
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(conf).delete(path, True)


def broadcast_if_small(df: DataFrame, n_rows: int, row_bytes: int) -> DataFrame:
    """Broadcast hint only when the known row count proves the side small.

    Beyond the bound no hint is given: the join shuffles, and adaptive execution
    splits skewed partitions.
    """
    if n_rows <= MAX_BROADCAST_ROWS and n_rows * row_bytes <= MAX_BROADCAST_BYTES:
        return F.broadcast(df)
    return df


def lookup_join(left: DataFrame, right: DataFrame, on: list[str], n_right: int, row_bytes: int) -> DataFrame:
    """Left join with a table of unique keys, safe when a few keys, or null, hold most rows of ``left``.

    A right side of few counted rows is broadcast. Otherwise the rows of the hottest keys, at
    most ``MAX_HOT_KEYS``, and those without a key are dealt to ``SALTS`` parts, and a hot key's
    one row on the right is repeated for each part; all other rows meet by hash.
    """
    small = broadcast_if_small(right, n_right, row_bytes)
    if small is not right:
        return left.join(small, on, "left")
    keyless = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in on])
    counts = left.where(~keyless).groupBy(*on).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > MIN_HOT_ROWS)
    hottest = counts.orderBy(F.desc("n")).limit(MAX_HOT_KEYS).drop("n").collect()
    spark, kinds = left.sparkSession, left.select(*on).schema
    marks = F.broadcast(spark.createDataFrame(hottest, kinds).withColumn("_hot", F.lit(True)))
    part = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in left.columns]), F.lit(SALTS)).cast("int")
    dealt = left.join(marks, on, "left").withColumn("_salt", F.when(F.col("_hot") | keyless, part).otherwise(0)).drop("_hot")
    parts = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    repeated = right.join(marks, on, "left").withColumn("_salt", F.explode(parts)).drop("_hot")
    return dealt.join(repeated, [*on, "_salt"], "left").drop("_salt")
