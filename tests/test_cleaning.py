from __future__ import annotations

import dataclasses

import pytest
from pyspark.sql import functions as F

from gradeworks.operators import cleaning
from gradeworks.spec import BUILDINGS, Range, TableSpec

SPEC = BUILDINGS


@pytest.fixture()
def buildings(spark):
    return spark.createDataFrame(
        [
            (1, 10, 2, 50, 1, 1, "h", 1),
            (2, 850, 16, 150, -1, None, "z", 0),
            (3, -5, 0, 0, 2, 3, "r", 2),
            (4, 45, 3, 20, 0, 2, "u", 1),
        ],
        "building_id long, age int, count_floors_pre_eq int, area_percentage int, count_families int, "
        "damage_grade int, foundation_type string, has_superstructure_adobe_mud int",
    )


def test_copies_fold_onto_the_smallest_key(spark):
    spec = TableSpec(key="id", label="y", classes=(1,))
    rows = spark.createDataFrame([(5, "a"), (1, "a"), (2, "b"), (3, "c"), (4, "c")], "id int, val string")
    kept = cleaning.distinct_rows(rows, spec)
    assert sorted(map(tuple, kept.collect())) == [(1, "a"), (2, "b"), (3, "c")]
    assert kept.columns == rows.columns


def test_copies_without_a_key_column(spark):
    spec = TableSpec(key="missing", label="y", classes=(1,))
    rows = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (3, "c"), (3, "c")], "id int, val string")
    assert cleaning.distinct_rows(rows, spec).count() == 3


def test_null_counts_as_equal_when_folding(spark):
    spec = TableSpec(key="id", label="y", classes=(1,))
    rows = spark.createDataFrame([(1, None), (2, None)], "id int, val string")
    assert cleaning.distinct_rows(rows, spec).count() == 1


def test_impossible_numbers_become_null(buildings):
    rows = {r["building_id"]: r for r in cleaning.nullify_out_of_range(buildings, SPEC).collect()}
    assert [rows[i]["age"] for i in (1, 2, 3, 4)] == [10, None, None, 45]
    assert [rows[i]["count_floors_pre_eq"] for i in (1, 2, 3, 4)] == [2, None, None, 3]
    assert [rows[i]["area_percentage"] for i in (1, 2, 3, 4)] == [50, None, None, 20]
    assert [rows[i]["count_families"] for i in (1, 2, 3, 4)] == [1, None, 2, 0]


def test_range_ends(spark):
    rows = spark.createDataFrame([(1, 0, 0, 100), (2, 800, 15, 101)], "building_id int, age int, count_floors_pre_eq int, area_percentage int")
    a, b = sorted(cleaning.nullify_out_of_range(rows, SPEC).collect())
    assert (a["age"], a["count_floors_pre_eq"], a["area_percentage"]) == (0, None, 100)
    assert (b["age"], b["count_floors_pre_eq"], b["area_percentage"]) == (800, 15, None)


def test_violations_are_counted_in_one_table(buildings):
    counts = dict(map(tuple, cleaning.count_out_of_range(buildings, SPEC).collect()))
    assert counts == {"age": 2, "count_floors_pre_eq": 2, "area_percentage": 2, "count_families": 1}
    assert dict(map(tuple, cleaning.count_out_of_domain(buildings, SPEC).collect())) == {
        "foundation_type": 1,
        "has_superstructure_adobe_mud": 1,
    }


def test_training_drops_rows_out_of_domain(buildings):
    kept = cleaning.keep_in_domain(buildings, SPEC)
    assert sorted(r["building_id"] for r in kept.collect()) == [1, 4]


def test_other_tables_keep_every_row(buildings):
    rows = {r["building_id"]: r for r in cleaning.nullify_out_of_domain(buildings, SPEC).collect()}
    assert len(rows) == 4
    assert rows[2]["foundation_type"] is None and rows[3]["foundation_type"] == "r"
    assert rows[3]["has_superstructure_adobe_mud"] is None and rows[2]["has_superstructure_adobe_mud"] == 0


def test_geo_ids_are_checked_on_training_only(spark):
    rows = spark.createDataFrame([(1, 5), (2, None), (3, 31)], "building_id int, geo_level_1_id int")
    assert [r["building_id"] for r in cleaning.keep_in_domain(rows, SPEC).collect()] == [1]
    other = cleaning.nullify_out_of_domain(rows, SPEC)
    assert sorted(r["building_id"] for r in other.collect()) == [1, 2, 3]
    assert other.where("geo_level_1_id = 31").count() == 1


def test_null_category_passes_the_domain(spark):
    rows = spark.createDataFrame([(1, None), (2, "n"), (3, "y")], "building_id int, roof_type string")
    assert sorted(r["building_id"] for r in cleaning.keep_in_domain(rows, SPEC).collect()) == [1, 2]


def test_sparse_rows_go(spark):
    spec = TableSpec(key="id", label="y", classes=(1,))
    rows = spark.createDataFrame([(1.0, 1.0, 1.0, 1.0), (None, None, None, 1.0), (None, None, None, None)], "a double, b double, c double, d double")
    assert cleaning.drop_sparse_rows(rows, spec, 0.5).count() == 1


def test_row_threshold_is_rounded_down_and_ignores_the_key(spark):
    spec = TableSpec(key="id", label="y", classes=(1,))
    # five columns besides the key: int(5 * 0.7) = 3 values are enough
    rows = spark.createDataFrame([(1, 1, 1, 1, None, None), (2, 1, 1, None, None, None)], "id int, a int, b int, c int, d int, e int")
    assert [r["id"] for r in cleaning.drop_sparse_rows(rows, spec).collect()] == [1]


def test_sparse_columns_are_remembered(spark):
    spec = TableSpec(key="id", label="y", classes=(1,))
    rows = spark.createDataFrame([(1, None), (2, None), (3, None), (4, 1)], "good int, poor int")
    found = cleaning.sparse_columns(rows, spec, 0.5)
    assert found == ["poor"]
    assert cleaning.drop_learned(rows, [*found, "absent"]).columns == ["good"]


def test_a_column_exactly_at_the_limit_stays(spark):
    spec = TableSpec(key="id", label="y", classes=(1,))
    rows = spark.createDataFrame([(1, None), (2, None), (3, 1), (4, 1), (5, 1)], "a int, b int")
    assert cleaning.sparse_columns(rows, spec, 0.4) == []


def test_unlabelled_rows_go(buildings):
    assert sorted(r["building_id"] for r in cleaning.drop_unlabelled(buildings, SPEC).collect()) == [1, 3, 4]
    assert cleaning.drop_unlabelled(buildings.drop("damage_grade"), SPEC).count() == 4


def test_training_sequence(buildings):
    assert sorted(r["building_id"] for r in cleaning.clean_training(buildings, SPEC).collect()) == [1, 4]


def test_filter_before_folding_equals_folding_first(buildings):
    """A range rule on a listed column switches to the plain order; both orders agree where both apply."""
    copies = buildings.unionByName(buildings.withColumn("building_id", F.col("building_id") + 10))
    direct = cleaning.clean_training(copies, SPEC)
    slow = cleaning.keep_in_domain(
        cleaning.drop_unlabelled(cleaning.nullify_out_of_range(cleaning.distinct_rows(copies, SPEC), SPEC), SPEC), SPEC
    )
    assert sorted(map(tuple, direct.collect())) == sorted(map(tuple, slow.collect()))


def test_range_on_a_listed_flag_runs_before_the_domain(buildings):
    spec = dataclasses.replace(SPEC, ranges={**SPEC.ranges, "has_superstructure_adobe_mud": Range(0, 1)})
    assert sorted(r["building_id"] for r in cleaning.clean_training(buildings, spec).collect()) == [1, 3, 4]


def test_rules_apply_only_to_present_columns(spark):
    rows = spark.createDataFrame([(1, "x")], "building_id int, note string")
    assert cleaning.clean_other(rows, SPEC).collect() == rows.collect()
    assert cleaning.clean_training(rows, SPEC).count() == 1


def test_total_nulls(spark):
    rows = spark.createDataFrame([(1, None), (None, None)], "a int, b int")
    assert cleaning.total_nulls(rows).first()["n_nulls"] == 3
