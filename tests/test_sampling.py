from __future__ import annotations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gradeworks.functions.hash_order import find_cuts, segment
from gradeworks.operators import sampling
from gradeworks.spec import BUILDINGS


@pytest.fixture(scope="module")
def hundred(spark):
    return spark.createDataFrame([(i, [1, 2, 3, 1][i % 4]) for i in range(100)], "id int, damage_grade int")


def test_split_is_exact_disjoint_and_whole(spark, hundred):
    train, validation, test = sampling.split_three(hundred, "id", "damage_grade")
    assert (train.count(), validation.count(), test.count()) == (70, 15, 15)
    together = train.union(validation).union(test)
    assert together.distinct().count() == 100 and together.exceptAll(hundred).count() == 0
    shares = {r["damage_grade"]: r["count"] for r in train.groupBy("damage_grade").count().collect()}
    assert shares == {1: 35, 2: 18, 3: 17} or shares == {1: 35, 2: 17, 3: 18}


def test_split_is_the_same_every_time(hundred):
    a = sampling.with_split(hundred, "id", "damage_grade").collect()
    b = sampling.with_split(hundred.repartition(7), "id", "damage_grade").collect()
    assert sorted(a) == sorted(b)
    assert sorted(a) != sorted(sampling.with_split(hundred, "id", "damage_grade", seed=1).collect())


def test_split_without_label(hundred):
    sizes = {r["split"]: r["count"] for r in sampling.with_split(hundred, "id", None).groupBy("split").count().collect()}
    assert sizes == {"train": 70, "validation": 15, "test": 15}


def test_recorded_split_sizes_of_the_survey():
    """Class sizes of the public training set give the class supports recorded for its splits."""
    sizes = sampling.split_sizes({1: 25124, 2: 148259, 3: 87218})
    assert {c: v for c, (_, v, _) in sizes.items()} == {1: 3768, 2: 22239, 3: 13083}
    assert {c: t for c, (_, _, t) in sizes.items()} == {1: 3769, 2: 22239, 3: 13083}


@given(st.lists(st.integers(0, 500), min_size=1, max_size=6), st.floats(0, 1))
@settings(max_examples=200, deadline=None)
def test_shares_add_up_and_stay_near_the_proportion(counts, part):
    counts = dict(enumerate(counts))
    total = int(sum(counts.values()) * part)
    shares = sampling.shared_out(counts, total)
    assert sum(shares.values()) == total
    rows = sum(counts.values())
    for s, n in counts.items():
        assert 0 <= shares[s] <= n
        assert rows == 0 or abs(shares[s] - n * total / rows) < 1


@given(st.lists(st.integers(1, 300), min_size=1, max_size=5))
@settings(max_examples=100, deadline=None)
def test_split_sizes_cover_every_row(counts):
    counts = dict(enumerate(counts))
    for s, parts in sampling.split_sizes(counts).items():
        assert sum(parts) == counts[s] and min(parts) >= 0


def test_reduction_keeps_class_shares(spark):
    rows = spark.range(10_000).select(
        F.col("id"), F.when(F.col("id") < 1000, 1).when(F.col("id") < 8000, 2).otherwise(3).alias("damage_grade")
    )
    kept = sampling.stratified_sample(rows, "id", "damage_grade", 0.10)
    sizes = {r["damage_grade"]: r["count"] for r in kept.groupBy("damage_grade").count().collect()}
    assert sizes == {1: 100, 2: 700, 3: 200}


def test_reduction_to_a_budget(spark):
    rows = spark.range(1000).select(F.col("id").alias("building_id"), (F.col("id") % 3 + 1).alias("damage_grade"))
    size = sampling.table_size(rows).first()
    assert size["n_rows"] == 1000 and size["size_mb"] == 1000 * 16 / 2**20
    assert sampling.reduce_to_size(rows, BUILDINGS, 1.0) is rows
    assert sampling.reduce_to_size(rows, BUILDINGS, size["size_mb"] / 4).count() == 250
    assert sampling.reduce_to_size(rows.drop("damage_grade"), BUILDINGS, size["size_mb"] / 4).count() == 500


def test_sample_has_exactly_n_rows(hundred):
    assert sampling.sample_rows(hundred, "id", 17).count() == 17
    assert sampling.sample_rows(hundred, "id", 1000).count() == 100
    assert sampling.sample_rows(hundred, "id", 0).count() == 0


def test_cuts_found_by_repeated_narrowing(hundred):
    """With ranges too large to rank at once, the cuts are the same."""
    ranks = lambda counts: {s: [n // 3, n // 2] for s, n in counts.items()}
    once = find_cuts(hundred, "id", ranks, by="damage_grade")
    narrowed = find_cuts(hundred, "id", ranks, by="damage_grade", rank_rows=0)
    assert once == narrowed


def test_crowded_stratum_and_null_stratum(spark):
    rows = spark.range(900).select("id", F.when(F.col("id") % 3 > 0, F.col("id") % 3).alias("y"))
    kept = rows.where(segment(find_cuts(rows, "id", lambda c: {s: [10] for s in c}, by="y"), "id", by="y") == 0)
    assert {r["y"]: r["count"] for r in kept.groupBy("y").count().collect()} == {None: 10, 1: 10, 2: 10}


def test_folds_differ_by_at_most_one_row(hundred):
    sizes = sorted(r["count"] for r in sampling.with_folds(hundred, "id", 7).groupBy("fold").count().collect())
    assert sizes == [14] * 5 + [15] * 2


def test_stratified_folds(hundred):
    folded = sampling.with_stratified_folds(hundred, "id", "damage_grade", 3)
    assert sorted(r["count"] for r in folded.groupBy("fold").count().collect()) == [33, 33, 34]
    per_class = {}
    for r in folded.groupBy("damage_grade", "fold").count().collect():
        per_class.setdefault(r["damage_grade"], []).append(r["count"])
    for sizes in per_class.values():
        assert len(sizes) == 3 and max(sizes) - min(sizes) <= 1
