from __future__ import annotations

import random

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from gradeworks.llm import packing
from tools.check_queries import TABLES, rows_of

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
ITEM = "Alice Brown buys seven red apples and nine green pears at the old market in the town"
SECRET = 'api_key = "Zx81Kq72mmQw"'


def fixture(spark, folder):
    rng = random.Random(2)
    calm = [f"calm{k}" for k in range(300)]

    def prose(n):
        return " ".join(rng.choice(calm) for _ in range(n))

    texts = {i: prose(60) for i in range(300)}
    for i in range(0, 300, 4):
        texts[i] += " you vile rotten fool " + prose(20)
    texts[301] = prose(400)
    texts[302] = texts[301] + " end"
    texts[303] = texts[301]
    texts[305] = prose(30) + ". " + ITEM + ". " + prose(30)
    texts[307] = prose(30) + " " + SECRET + " " + prose(10)
    texts[309], texts[311] = None, ""
    rows = [(i, t, "en", "s", None if t is None else len(t)) for i, t in texts.items()]
    rows += [(None, "text without an id " + prose(20), None, None, None), rows[1]]
    spark.createDataFrame(rows, DOCS).write.parquet(f"{folder}/documents.parquet")
    labels = [(i, 1, int(i % 4 == 0)) for i in range(300)]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(0, ITEM), (1, None)], "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    gone = {i for i in range(0, 300, 4)} | {302, 303, 305}
    kept = [(i, t) for i, t, *_ in rows if i not in gone]
    kept.remove((rows[1][0], rows[1][1]))
    return kept


def test_stages_against_what_was_planted(spark, tmp_path):
    kept = fixture(spark, tmp_path)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    seen = {}
    for name, step in corpus_pipeline.STAGES:
        out = step(spark, docs, str(tmp_path))
        out.write.parquet(f"{tmp_path}/{name}")
        seen[name], columns = spark.read.parquet(f"{tmp_path}/{name}"), docs.columns
        if name != "packing":
            assert seen[name].columns == columns
        docs = seen[name]
    want = sorted(((i, t) for i, t in kept), key=str)
    assert sorted(((r["doc_id"], r["text"]) for r in seen["decontamination"].collect()), key=str) == want
    final = [(i, t and t.replace('api_key = "Zx81Kq72mmQw', "[SECRET]")) for i, t in kept]
    assert sorted(((r["doc_id"], r["text"]) for r in seen["secrets"].collect()), key=str) == sorted(final, key=str)
    model = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
    lengths = sorted(len(model.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in final)
    rows = seen["packing"].collect()
    assert sorted(r["length"] for r in rows) == lengths
    bound = packing.dual_bound(*np.unique(lengths, return_counts=True), packing.CAPACITY)
    assert len({r["sequence_id"] for r in rows}) == bound


def test_an_empty_table_stays_empty(spark, tmp_path):
    fixture(spark, tmp_path)
    empty = spark.read.parquet(f"{tmp_path}/documents.parquet").limit(0)
    for _, step in corpus_pipeline.STAGES:
        assert step(spark, empty, str(tmp_path)).count() == 0


def test_every_operator_has_its_query():
    names = [n for n in entry.queries() if n.startswith("op") or n == "pipeline"]
    assert [n.split("_")[0] for n in names] == [f"op{i}" for i in range(1, 11)] + ["pipeline"]


@pytest.mark.parametrize("name", ["op2_warc_boundary_chain", "op3_bbit_minhash", "op6_vector_approximation"])
def test_query_equals_its_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    got = entry.queries()[name](spark, sf_dir)
    cursor = con.execute(entry.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(got.columns)
    assert rows_of(got.columns, got.collect()) == rows_of(names, cursor.fetchall())


def test_workers_give_back_memory_when_a_task_ends(monkeypatch):
    import pyarrow as pa

    from gradeworks.llm import common

    calls = []

    class Pool:
        def release_unused(self):
            calls.append("released")

    monkeypatch.setattr(common.pa, "default_memory_pool", Pool)
    out = common.giving_back(lambda batches: (b for b in batches))(iter([1, 2]))
    assert next(out) == 1 and not calls
    assert list(out) == [2] and calls == ["released"]
    assert pa.default_memory_pool is Pool
