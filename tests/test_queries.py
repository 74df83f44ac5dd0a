from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry
from tools.check_queries import TABLES, rows_of

# A spread of quick ones; tools/check_queries.py runs them all.
QUICK = [
    "pf07_nullify_out_of_range",
    "pf08_keep_in_domain",
    "ag01_distinct_rows",
    "ag03_missing_shares",
    "ag07_correlations",
    "ag09_box_statistics",
    "ag12_density_histogram",
    "ag13_skewness",
    "ag15_modes",
    "ag20_class_scores",
    "wf01_rank_configurations",
    "wf03_auc",
    "sm01_reduce_to_size",
    "sm02_stratified_split",
    "sm05_stratified_folds",
    "sf01_one_hot",
    "sf03_cross_fitted_encoding",
    "j03_encoding_lookup",
    "j04_nearest_centroid",
    "j06_near_hits_and_misses",
    "ml05_mutual_information",
    "ml12_knn_classifier",
    "ml20_prepare_other_table",
    "ml21_cleaning_sequence",
    "io02_delimited_scan",
    "io04_guarded_open",
    "pf14_column_roles",
    "ml26_evaluator_checks",
    "ext1_caller_scores",
    "ext3_caller_reader",
]


@pytest.fixture(scope="module")
def con(sf_dir):
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return connection


def test_every_oracle_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_oracles_parse(con):
    for name, sql in entry.oracle_sql().items():
        columns = [d[0] for d in con.execute(f"SELECT * FROM ({sql}) LIMIT 0").description]
        assert len(columns) == len(set(columns)), name


def test_flagship(spark):
    out = entry.entry(spark)
    assert out.columns == ["priority", "class_1", "class_2", "class_3"]
    rows = out.collect()
    assert len(rows) == 5 and all(sum(r[1:]) == pytest.approx(100) for r in rows)


@pytest.mark.parametrize("name", QUICK)
def test_query_equals_its_sql(spark, sf_dir, con, name):
    got = entry.queries()[name](spark, sf_dir)
    cursor = con.execute(entry.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(got.columns)
    assert rows_of(got.columns, got.collect()) == rows_of(names, cursor.fetchall())
