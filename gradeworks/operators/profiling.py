"""Profile tables of a labelled table: shares, gaps, correlations, distributions."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gradeworks.functions.blocks import matrix
from gradeworks.functions.order_stats import exact_quantiles
from gradeworks.operators.cleaning import null_counts
from gradeworks.operators.target_encoding import fit_target_encoder
from gradeworks.session import stage
from gradeworks.spec import TableSpec


def class_shares(df: DataFrame, label: str) -> DataFrame:
    """``(label, n, share_pct)`` per class, one decimal, in class order."""
    everything = Window.partitionBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return (
        df.where(F.col(label).isNotNull())
        .groupBy(label)
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("share_pct", F.round(F.col("n") * 100.0 / F.sum("n").over(everything), 1))
        .orderBy(label)
    )


def missing_shares(df: DataFrame, flag_above: float = 40.0) -> DataFrame:
    """``(column, null_pct, flagged)`` of columns with gaps, smallest share first."""
    counts = null_counts(df)
    entries = F.array(
        *[
            F.struct(F.lit(c).alias("column"), (F.col(f"`{c}`") * 100.0 / F.col("n_rows")).alias("null_pct"))
            for c in df.columns
        ]
    )
    return (
        counts.select(F.inline(entries))
        .where(F.col("null_pct") > 0)
        .withColumn("flagged", F.col("null_pct") > flag_above)
        .orderBy("null_pct", "column")
    )


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(a, b, r)`` for each pair of columns, from rows where both are present.

    Built-in ``corr`` for every pair makes an aggregation far too wide for generated
    code, so tasks add up the cross products of whole Arrow batches and each emits
    one small row per pair. Values are taken relative to the column mean, which
    keeps the sums well conditioned.
    """
    columns, width = list(columns), len(columns)
    # read twice, for the means and for the products, so the needed columns are stored
    data = stage(df.select(*[F.col(f"`{c}`").cast("double").alias(f"c{i}") for i, c in enumerate(columns)]), "correlated")
    means = data.agg(*[F.coalesce(F.avg(f"c{i}"), F.lit(0.0)) for i in range(width)]).first()
    centered = data.select(F.array(*[F.col(f"c{i}") - F.lit(m) for i, m in enumerate(means)]).alias("v"))
    low, high = np.triu_indices(width, 1)

    def cross_products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((6, len(low)))
        for batch in batches:
            x = matrix(batch.column("v"), width)
            there = ~np.isnan(x)
            x = np.where(there, x, 0.0)
            there = there.astype(float)
            products = (there.T @ there, x.T @ there, there.T @ x, (x * x).T @ there, there.T @ (x * x), x.T @ x)
            sums += np.array([p[low, high] for p in products])
        yield pa.RecordBatch.from_arrays(
            [pa.array(low.astype("int32")), pa.array(high.astype("int32")), *[pa.array(s) for s in sums]],
            names=["i", "j", "n", "x", "y", "xx", "yy", "xy"],
        )

    fields = ", ".join(f"{c} double" for c in ("n", "x", "y", "xx", "yy", "xy"))
    totals = (
        centered.mapInArrow(cross_products, f"i int, j int, {fields}")
        .groupBy("i", "j")
        .agg(*[F.sum(c).alias(c) for c in ("n", "x", "y", "xx", "yy", "xy")])
    )
    n = F.col("n")
    covariance = F.col("xy") - F.try_divide(F.col("x") * F.col("y"), n)
    spread = F.sqrt(
        (F.col("xx") - F.try_divide(F.col("x") * F.col("x"), n)) * (F.col("yy") - F.try_divide(F.col("y") * F.col("y"), n))
    )
    names = F.array(*[F.lit(c) for c in columns])
    return totals.select(
        F.get(names, F.col("i")).alias("a"),
        F.get(names, F.col("j")).alias("b"),
        F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.try_divide(covariance, spread))).alias("r"),
    )


def correlation_table(
    df: DataFrame, spec: TableSpec, shown_from: float = 0.3, encode_geo: bool = True
) -> DataFrame:
    """Lower triangle over continuous, geo, binary columns and label; ``shown`` hides weak pairs.

    Geo ids are replaced by cross-fitted target means for this table only.
    """
    geo = [c for c in spec.geo_columns(df) if dict(df.dtypes)[c] != "double"]
    if geo and encode_geo and spec.label in df.columns:
        encoder = fit_target_encoder(df, geo, spec.label, spec.key)
        labelled = encoder.transform_training(df.where(F.col(spec.label).isNotNull()), spec.key)
        # rows without label keep their plain id, as there is no target to encode by
        unlabelled = df.where(F.col(spec.label).isNull()).withColumns({c: F.col(c).cast("double") for c in geo})
        df = labelled.unionByName(unlabelled)
    columns = [
        c
        for c in (*spec.continuous, *spec.geo, *spec.binary_columns(df), spec.label)
        if c in df.columns
    ]
    return correlations(df, columns).withColumn("shown", F.abs("r") >= shown_from)


def strongest(table: DataFrame, label: str, n: int = 10) -> DataFrame:
    """``(feature, abs_r)``: the features most correlated with the label."""
    return (
        table.where((F.col("a") == label) | (F.col("b") == label))
        .select(F.when(F.col("a") == label, F.col("b")).otherwise(F.col("a")).alias("feature"), F.abs("r").alias("abs_r"))
        .orderBy(F.col("abs_r").desc_nulls_last(), "feature")
        .limit(n)
    )


def box_statistics(df: DataFrame, columns: Sequence[str], label: str, direct_rows: int = 500_000) -> DataFrame:
    """``(class, feature, q1, median, q3, low, high)`` with whiskers inside 1.5 box heights.

    Quartiles come first; the whiskers are then conditional extremes of one more scan. The
    needed columns are stored, since they are read several times.
    """
    labelled = stage(df.where(F.col(label).isNotNull()).select(label, *[F.col(f"`{c}`") for c in columns if c != label]), "boxed")
    quartiles = exact_quantiles(labelled, columns, [0.25, 0.5, 0.75], by=label, direct_rows=direct_rows)
    classes = sorted({g for g, _ in quartiles})

    def per_class(column: str, which: int, step: float) -> Column:
        chosen = F.lit(None).cast("double")
        for g in classes:
            if (g, column) in quartiles:
                q1, _, q3 = quartiles[g, column]
                chosen = F.when(F.col(label) == g, F.lit((q1, q3)[which] + step * (q3 - q1))).otherwise(chosen)
        return chosen

    extremes = []
    for i, c in enumerate(columns):
        value = F.col(c).cast("double")
        inside = (value >= per_class(c, 0, -1.5)) & (value <= per_class(c, 1, 1.5))
        extremes.append(F.min(F.when(inside, value)).alias(f"lo{i}"))
        extremes.append(F.max(F.when(inside, value)).alias(f"hi{i}"))
    entries = []
    for i, c in enumerate(columns):
        q = [F.lit(None).cast("double")] * 3
        for g in classes:
            if (g, c) in quartiles:
                q = [F.when(F.col(label) == g, F.lit(v)).otherwise(o) for v, o in zip(quartiles[g, c], q, strict=True)]
        entries.append(
            F.struct(
                F.lit(c).alias("feature"),
                q[0].alias("q1"),
                q[1].alias("median"),
                q[2].alias("q3"),
                F.least(F.col(f"lo{i}"), q[0]).alias("low"),
                F.greatest(F.col(f"hi{i}"), q[2]).alias("high"),
            )
        )
    boxes = labelled.groupBy(label).agg(*extremes)
    return boxes.select(F.col(label).alias("class"), F.inline(F.array(*entries))).where(F.col("q1").isNotNull())


def contingency(df: DataFrame, column: str, label: str, classes: Sequence[int]) -> DataFrame:
    """Share of each class inside every value of ``column``, in percent: ``class_<c>``."""
    counts = [F.count_if(F.col(label) == c).alias(f"class_{c}") for c in classes]
    total = reduce(lambda a, b: a + b, [F.col(f"class_{c}") for c in classes])
    return (
        df.where(F.col(column).isNotNull() & F.col(label).isNotNull())
        .groupBy(column)
        .agg(*counts)
        .where(total > 0)
        .select(column, *[(F.col(f"class_{c}") * 100.0 / total).alias(f"class_{c}") for c in classes])
    )


def region_counts(df: DataFrame, column: str) -> DataFrame:
    return (
        df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n")).orderBy(column)
    )


def tail_share(df: DataFrame, column: str, limit: float) -> DataFrame:
    """One row: rows kept by ``column <= limit``, and the percent left out (nulls among them)."""
    kept = F.count_if(F.col(column) <= limit)
    rows = F.count(F.lit(1))
    return df.agg(
        kept.alias("n_kept"),
        F.coalesce(F.try_divide((rows - kept) * F.lit(100.0), rows), F.lit(0.0)).alias("excluded_pct"),
    )


def density_histogram(df: DataFrame, column: str, label: str, bins: int = 40) -> DataFrame:
    """``(class, bin, low, n, density)``: equal bins over each class's own span, last one closed."""
    value = F.col(column).cast("double")
    rows = df.select(F.col(label).alias("class"), value.alias("x")).where(
        F.col("class").isNotNull() & F.col("x").isNotNull()
    )
    spans = {r["class"]: r for r in rows.groupBy("class").agg(F.min("x").alias("lo"), F.max("x").alias("hi"), F.count("x").alias("n")).collect()}
    low = width = total = F.lit(None).cast("double")
    for g, r in spans.items():
        # a class with one value gets a unit span around it
        lo, hi = (r["lo"], r["hi"]) if r["hi"] > r["lo"] else (r["lo"] - 0.5, r["hi"] + 0.5)
        low = F.when(F.col("class") == g, F.lit(lo)).otherwise(low)
        width = F.when(F.col("class") == g, F.lit((hi - lo) / bins)).otherwise(width)
        total = F.when(F.col("class") == g, F.lit(float(r["n"]))).otherwise(total)
    number = F.least(F.floor((F.col("x") - low) / width), F.lit(bins - 1)).cast("int")
    return (
        rows.groupBy("class", number.alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(
            "class", "bin", (low + F.col("bin") * width).alias("low"), "n", (F.col("n") / (total * width)).alias("density")
        )
    )


def adjusted_skewness(column: str) -> Column:
    """Sample skewness with the usual small-sample correction; null below three values."""
    n = F.count(column).cast("double")
    return F.when(n > 2, F.skewness(column) * F.sqrt(n * (n - 1)) / (n - 2))


def distinct_classes(df: DataFrame, label: str) -> DataFrame:
    return df.where(F.col(label).isNotNull()).select(label).distinct().orderBy(label)


def profile(df: DataFrame, spec: TableSpec, age: str | None = None, tail: float = 200.0) -> dict[str, DataFrame]:
    """The seven profile analyses as named tables; tables of absent columns are left out."""
    label, classes = spec.label, spec.classes
    continuous = [c for c in spec.continuous if c in df.columns]
    table = correlation_table(df, spec)
    tables = {
        "class_shares": class_shares(df, label),
        "missing_shares": missing_shares(df),
        "correlations": table,
        "strongest": strongest(table, label),
        "box_statistics": box_statistics(df, continuous, label),
    }
    for c in spec.domains:
        if c in df.columns:
            tables[f"contingency_{c}"] = contingency(df, c, label, classes)
    for c in spec.geo_columns(df)[:1]:
        tables["region_counts"] = region_counts(df, c)
        tables["region_shares"] = contingency(df, c, label, classes)
    if age in df.columns:
        tables["tail_share"] = tail_share(df, age, tail)
        tables["density_histogram"] = density_histogram(df.where(F.col(age) <= tail), age, label)
        tables["skewness"] = df.agg(adjusted_skewness(age).alias("skewness"))
    return tables
