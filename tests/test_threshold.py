from __future__ import annotations

from pyspark.sql import functions as F

from __spark_entry__ import queries


def test_no_feature_above_the_threshold_gives_no_row(spark, sf_dir, tmp_path):
    # statuses of one kind say nothing of any feature; the query used to answer with the fallback
    for t in ("lineitem", "customer", "nation"):
        spark.read.parquet(f"{sf_dir}/{t}.parquet").write.parquet(str(tmp_path / f"{t}.parquet"))
    spark.read.parquet(f"{sf_dir}/orders.parquet").withColumn("o_orderstatus", F.lit("F")).write.parquet(str(tmp_path / "orders.parquet"))
    assert queries()["tk05_above_threshold"](spark, str(tmp_path)).count() == 0
