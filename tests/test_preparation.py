from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from gradeworks.functions.order_stats import exact_quantiles
from gradeworks.operators import encoding, imputation, scaling
from gradeworks.operators.target_encoding import fit_target_encoder
from gradeworks.plans import preparation as plan
from gradeworks.sources.cases import CASES, stored_cases
from gradeworks.spec import BUILDINGS, TableSpec


@pytest.fixture()
def gaps(spark):
    return spark.createDataFrame(
        [
            (1, 1, 50.0, 10.0, "n", "h", 1),
            (2, None, None, 20.0, "q", "h", None),
            (3, 3, 100.0, None, None, "i", 0),
            (4, 2, 75.0, 15.0, "n", "h", 1),
        ],
        "building_id int, damage_grade int, area_percentage double, height_percentage double, roof_type string, "
        "foundation_type string, has_superstructure_adobe_mud int",
    )


def test_roles_follow_prefix_and_type(gaps):
    roles = BUILDINGS.roles(gaps)
    assert roles.continuous == ("area_percentage", "height_percentage")
    assert roles.binary == ("has_superstructure_adobe_mud",)
    assert roles.categorical == ("roof_type", "foundation_type")


def test_fill_by_role(gaps):
    filled = {r["building_id"]: r for r in imputation.fill(gaps, imputation.fit_fill_values(gaps, BUILDINGS)).collect()}
    assert filled[2]["area_percentage"] == 75.0 and filled[3]["height_percentage"] == 15.0
    assert filled[3]["roof_type"] == "n" and filled[2]["has_superstructure_adobe_mud"] == 1
    assert filled[2]["damage_grade"] is None


def test_fill_uses_training_values_only(spark, gaps):
    values = imputation.fit_fill_values(gaps, BUILDINGS)
    other = spark.createDataFrame([(9, None, "x"), (10, 1000.0, None)], "building_id int, area_percentage double, roof_type string")
    filled = {r["building_id"]: r for r in imputation.fill(other, values).collect()}
    assert filled[9]["area_percentage"] == 75.0 and filled[10]["roof_type"] == "n"


def test_table_without_gaps_still_learns(spark):
    whole = spark.createDataFrame([(1, 1.0), (2, 3.0)], "building_id int, age double")
    assert imputation.fit_fill_values(whole, BUILDINGS).medians == {"age": 2.0}


def test_mode_tie_takes_the_smaller_value(spark):
    rows = spark.createDataFrame([(1, "x", 1), (2, "n", 0), (3, "x", 0), (4, "n", 1)], "building_id int, roof_type string, has_a int")
    assert imputation.fit_fill_values(rows, BUILDINGS).modes == {"roof_type": "n", "has_a": 0}


@pytest.mark.parametrize("direct_rows", [10_000_000, 40, 7])
def test_quantiles_are_exact_however_they_are_found(spark, direct_rows):
    rng = np.random.default_rng(3)
    values = np.concatenate([rng.normal(size=400), np.full(300, 0.25), rng.exponential(50, 200)])
    groups = rng.integers(0, 3, len(values))
    rows = spark.createDataFrame([(float(v), int(g), int(v)) for v, g in zip(values, groups)], "x double, g int, k int")
    probabilities = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    found = exact_quantiles(rows, ["x", "k"], probabilities, by="g", direct_rows=direct_rows)
    for g in range(3):
        assert np.allclose(found[g, "x"], np.quantile(values[groups == g], probabilities), atol=1e-9)
        assert np.allclose(found[g, "k"], np.quantile(values[groups == g].astype(int), probabilities), atol=1e-9)


def test_dummies(spark):
    rows = spark.createDataFrame([(1, 10, "h", "n"), (2, 20, "i", "q"), (3, 30, "h", None)], "building_id int, age int, foundation_type string, roof_type string")
    hot = encoding.one_hot(rows, encoding.learn_levels(rows, BUILDINGS))
    assert hot.columns == ["building_id", "age", "foundation_type_h", "foundation_type_i", "roof_type_n", "roof_type_q"]
    assert sorted(tuple(r)[2:] for r in hot.collect()) == [(0, 1, 0, 1), (1, 0, 0, 0), (1, 0, 1, 0)]


def test_alignment(spark):
    rows = spark.createDataFrame([(1, 5, 1, 1)], "id int, age int, roof_type_n int, damage_grade int")
    aligned = encoding.align(rows, ["foundation_type_w", "age"], keep=["id"])
    assert aligned.columns == ["id", "foundation_type_w", "age"] and tuple(aligned.first()) == (1, 0, 5)


def test_only_listed_columns_are_scaled(spark):
    rows = spark.createDataFrame([(1, 10, 20, 1), (2, 50, 80, 0), (3, 30, 50, 1)], "building_id int, age int, area_percentage int, foundation_type_h int")
    scaled = scaling.standardize(rows, scaling.fit_standard(rows, BUILDINGS.continuous))
    got = np.array([tuple(r) for r in scaled.orderBy("building_id").collect()], dtype=float)
    assert np.allclose(got[:, 1], [-1.224745, 1.224745, 0.0], atol=1e-6)
    assert np.allclose(got[:, 2], [-1.224745, 1.224745, 0.0], atol=1e-6)
    assert list(got[:, 3]) == [1, 0, 1]


def test_constant_column_scales_to_zero(spark):
    rows = spark.createDataFrame([(1, 7), (2, 7)], "building_id int, age int")
    scaled = scaling.standardize(rows, scaling.fit_standard(rows, ["age"]))
    assert [r["age"] for r in scaled.collect()] == [0.0, 0.0]


def brute_encoding(categories, y, train):
    """Shrunken mean per category by the definition, from the rows in ``train``."""
    mean, var = y[train].mean(), y[train].var()
    out = {}
    for c in np.unique(categories):
        own = y[train & (categories == c)]
        if not len(own) or var * len(own) + own.var() == 0:
            out[c] = mean
            continue
        weight = var * len(own) / (var * len(own) + own.var())
        out[c] = weight * own.mean() + (1 - weight) * mean
    return out, mean


@pytest.fixture(scope="module")
def graded(spark):
    rng = np.random.default_rng(5)
    # one category holds a third of the rows, others are rare
    categories = np.where(rng.random(300) < 0.34, 7, rng.integers(0, 60, 300))
    grades = rng.integers(1, 4, 300)
    rows = [(i, int(c), int(g)) for i, (c, g) in enumerate(zip(categories, grades))]
    return spark.createDataFrame(rows, "id int, area int, grade int"), categories, grades.astype(float)


def test_target_encoding_of_other_tables(spark, graded):
    rows, categories, y = graded
    want, mean = brute_encoding(categories, y, np.full(len(y), True))
    encoder = fit_target_encoder(rows, ["area"], "grade", "id")
    other = spark.createDataFrame([(1, 7), (2, 999), (3, None), (4, int(categories[0]))], "id int, area int")
    got = {r["id"]: r["area"] for r in encoder.transform(other).collect()}
    assert got == pytest.approx({1: want[7], 2: mean, 3: mean, 4: want[categories[0]]})


def test_target_encoding_of_training_rows_leaves_their_fold_out(graded):
    rows, categories, y = graded
    encoder = fit_target_encoder(rows, ["area"], "grade", "id")
    from gradeworks.functions.hash_order import segment

    folds = {r["id"]: r["f"] for r in rows.select("id", segment(encoder.cuts, "id").alias("f")).collect()}
    fold = np.array([folds[i] for i in range(len(y))])
    assert sorted(np.bincount(fold)) == [60] * 5
    got = {r["id"]: r["area"] for r in encoder.transform_training(rows, "id").collect()}
    for f in range(5):
        want, mean = brute_encoding(categories, y, fold != f)
        for i in np.flatnonzero(fold == f):
            assert got[i] == pytest.approx(want.get(categories[i], mean))


def test_target_encoding_needs_the_label(graded):
    with pytest.raises(ValueError, match="label"):
        fit_target_encoder(graded[0].drop("grade"), ["area"], "grade", "id")


@pytest.fixture(scope="module")
def prepared(spark, sf_dir):
    table = stored_cases(spark, sf_dir)
    return table, *plan.fit_preparation(table, CASES)


def test_prepared_training_rows(prepared):
    _, preparation, train = prepared
    assert preparation.dropped == ("rare_note",)
    assert train.columns == ["case_id", "grade", *preparation.columns]
    assert plan.remaining_nulls(train, CASES) == 0
    stats = train.agg(*[F.avg(c).alias(c) for c in CASES.continuous]).first()
    assert max(abs(stats[c]) for c in CASES.continuous) < 1e-9


def test_no_row_of_another_table_is_lost(prepared):
    table, preparation, train = prepared
    out = preparation.apply(table)
    assert out.count() == table.count() and out.columns == train.columns
    assert plan.remaining_nulls(out, CASES) == 0


def test_applying_learns_nothing(spark, prepared):
    """A row is prepared alike alone and among others."""
    table, preparation, _ = prepared
    one = table.where("case_id = 100")
    alone = preparation.apply(one).first()
    among = preparation.apply(table).where("case_id = 100").first()
    assert tuple(alone) == pytest.approx(tuple(among))


def test_unlabelled_table_and_missing_columns(prepared):
    table, preparation, _ = prepared
    out = preparation.apply(table.drop("grade", "has_bulk"))
    assert out.columns == ["case_id", *preparation.columns]
    assert out.select("has_bulk").distinct().collect()[0][0] == 0


def test_training_without_label_raises(prepared):
    with pytest.raises(ValueError, match="grade"):
        plan.fit_preparation(prepared[0].drop("grade"), CASES)


def test_saved_preparation_gives_the_same_rows(spark, tmp_path, prepared):
    table, preparation, train = prepared
    extended = plan.with_clusters(preparation, train, 3, restarts=1)
    extended.save_to(str(tmp_path / "p"))
    loaded = plan.Preparation.load_from(spark, str(tmp_path / "p"), CASES)
    a, b = extended.apply(table), loaded.apply(table)
    assert a.columns == b.columns and a.columns[-3:] == ["cluster_0", "cluster_1", "cluster_2"]
    assert a.exceptAll(b).count() == 0


def test_spec_without_geo_or_domains(spark):
    spec = TableSpec(key="id", label="y", classes=(1, 2), continuous=("x",))
    rows = spark.createDataFrame([(i, float(i), 1 + i % 2) for i in range(20)], "id int, x double, y int")
    preparation, train = plan.fit_preparation(rows, spec)
    assert train.count() == 20 and preparation.encoder is None
