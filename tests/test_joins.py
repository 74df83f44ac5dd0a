"""Joins with hot keys."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from gradeworks import session


@pytest.mark.parametrize("hot", [1, 20_000])
def test_lookup_keeps_every_row_and_deals_hot_keys(spark, monkeypatch, hot):
    monkeypatch.setattr(session, "MAX_BROADCAST_ROWS", 0)
    monkeypatch.setattr(session, "MIN_HOT_ROWS", hot)
    key = F.when(F.col("id") % 2 == 0, 7).when(F.col("id") % 10 == 1, F.lit(None)).otherwise(F.col("id") % 50).cast("int")
    left = spark.range(20_000).select("id", key.alias("k"), (F.col("id") % 3).alias("fold"))
    right = spark.range(40).select(F.col("id").cast("int").alias("k"), (F.col("id") * 2).alias("value"))
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "16"}
    before = {c: spark.conf.get(c) for c in conf}
    for c, v in conf.items():
        spark.conf.set(c, v)
    try:
        out = session.lookup_join(left, right, ["k"], 40, 16)
        sizes = out.groupBy(F.spark_partition_id().alias("p")).count().collect()
        rows = {r["id"]: (r["k"], r["value"]) for r in out.collect()}
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)
    assert out.columns == ["k", "id", "fold", "value"] and len(rows) == 20_000
    for i in range(20_000):
        k = 7 if i % 2 == 0 else None if i % 10 == 1 else i % 50
        assert rows[i] == (k, 2 * k if k is not None and k < 40 else None)
    assert (max(r["count"] for r in sizes) < 0.5 * 10_000) == (hot == 1)
