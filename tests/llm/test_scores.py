"""Classifiers on held-out rows, their parts against brute force, and token counts."""

from __future__ import annotations

import random
from zlib import crc32

import numpy as np
import pytest

from gradeworks.llm import labelled, quality, token_counts, toxicity

DOCS = "doc_id bigint, text string, label int, score string, toxic int, quality int"
HARD = [None, "", " ", "x" * 200_000, "a b c " * 30_000]


def held(i):
    return crc32(str(i).encode()) % 4 == 2


def accuracy(spark, sf, module, label):
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    scores = module.score_documents(docs, module.fit(docs, labels))
    rows = scores.join(labels, "doc_id").where("held_out").select(label, "predicted").collect()
    return sum(r[0] == r[1] for r in rows) / len(rows), max(np.mean([r[0] for r in rows]), 1 - np.mean([r[0] for r in rows]))


@pytest.mark.parametrize(("module", "label", "least"), [(quality, "quality", 0.95), (toxicity, "toxic", 0.92)])
def test_held_out_accuracy(spark, module, label, least):
    got, base = accuracy(spark, "/root/testdata/sf0.01", module, label)
    assert got >= least > base


def test_held_out_labels_are_not_learned(spark):
    rows = [(i, "good words here" if i % 2 else "vile words here") for i in range(400)]
    docs = spark.createDataFrame([(i, t, 1, "x", 0, 0) for i, t in rows], DOCS)
    labels = [(i, 1 - i % 2) for i, _ in rows]
    flipped = [(i, 1 - y if held(i) else y) for i, y in labels]
    for module in (toxicity, quality):
        out = []
        for chosen in (labels, flipped):
            table = spark.createDataFrame([(i, y, y) for i, y in chosen], "doc_id bigint, toxic int, quality int")
            out.append(sorted((r["doc_id"], r["score"]) for r in module.score_documents(docs, module.fit(docs, table)).collect()))
        assert out[0] == out[1]


@pytest.mark.parametrize("module", [toxicity, quality])
@pytest.mark.parametrize("answers", [[], [(1, 1)], [(None, 1), (1, None), (1, 0), (1, 1), (2, 0), (3, 7)]])
def test_hard_rows_and_few_labels(spark, module, answers):
    rows = [*enumerate(HARD), (None, "no id"), (1, ""), (1, "twice")]
    docs = spark.createDataFrame([(i, t, 1, "x", 0, 0) for i, t in rows], DOCS)
    labels = spark.createDataFrame([(i, y, y) for i, y in answers], "doc_id bigint, toxic int, quality int")
    got = module.score_documents(docs, module.fit(docs, labels)).collect()
    assert sorted(str(r["doc_id"]) for r in got) == sorted(str(i) for i, _ in rows)
    assert all(0 <= r["score"] <= 1 and r["held_out"] == (r["doc_id"] is not None and held(r["doc_id"])) for r in got)
    empty = spark.createDataFrame([], DOCS)
    assert module.score_documents(empty, module.fit(empty, labels)).count() == 0


def brute_segments(values):
    """All maximal segments by their definition: the best one, then those of what is left on both sides."""
    if not any(v > 0 for v in values):
        return []
    n = len(values)
    sums = {(i, j): sum(values[i:j]) for i in range(n) for j in range(i + 1, n + 1)}
    best = max(sums.values())
    i, j = min((k for k, s in sums.items() if abs(s - best) < 1e-9), key=lambda k: (k[1] - k[0], k[0]))
    right = [(a + j, b + j, s) for a, b, s in brute_segments(values[j:])]
    return [*brute_segments(values[:i]), (i, j, best), *right]


@pytest.mark.parametrize("seed", range(20))
def test_segments_against_brute_force(seed):
    rng = random.Random(seed)
    values = [rng.uniform(0.5, 3) if rng.random() < 0.4 else -0.7 for _ in range(14)]
    places = [i for i, v in enumerate(values) if v > 0]
    got = [(places[a], places[b] + 1, s) for a, b, s in toxicity.maximal_segments(places, [values[i] for i in places], 0.7)]
    want = brute_segments(values)
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert [g[2] for g in got] == pytest.approx([w[2] for w in want])


def test_passages_are_found_in_whole_texts(spark):
    rows = [(i, "calm words about the weather and the sea " * 40 + ("you vile rotten fool " if i % 3 == 0 else "")) for i in range(600)]
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i, _ in rows], "doc_id bigint, toxic int")
    rows2 = [(1, "calm words " * 4_000 + "rotten vile fool" + " calm words" * 10), (2, "calm words")]
    varied = spark.createDataFrame([(i, f"{t} {i}", 1, "x", 0, 0) for i, t in rows], DOCS)
    model = toxicity.fit(varied, labels)
    got = {r["doc_id"]: r for r in toxicity.score_documents(spark.createDataFrame([(i, t, 1, "x", 0, 0) for i, t in rows2], DOCS), model).collect()}
    assert got[1]["predicted"] == 1 and got[2]["predicted"] == 0 and got[2]["passages"] == []
    start, end = map(int, got[1]["passages"][0].split(":"))
    assert rows2[0][1][start:end] == "rotten vile fool"


def test_monotone_fit_against_brute_force():
    x, y = np.array([1, 1, 2, 3, 4, 5.0]), np.array([0, 1, 0, 1, 0, 1.0])
    knots, heights = labelled.monotone_fit(x, y)
    assert (np.diff(heights) >= 0).all() and knots[0] == 1 and knots[-1] == 5
    fit = np.interp(x, knots, heights)
    assert fit[0] == fit[2] and fit[3] == fit[4] and 0 < fit[0] < fit[3] < fit[5] < 1


def brute_count(word, vocabulary):
    marked = token_counts.WORD_MARK + word
    table = [(0.0, 0)]
    for end in range(1, len(marked) + 1):
        size = 1 if marked[end - 1] == token_counts.WORD_MARK else len(marked[end - 1].encode())
        options = [(table[end - 1][0] + vocabulary.byte_score * size, table[end - 1][1] + size)]
        options += [(table[s][0] + vocabulary.scores[marked[s:end]], table[s][1] + 1) for s in range(end) if marked[s:end] in vocabulary.scores]
        table.append(max(options, key=lambda o: (o[0], -o[1])))
    return table[-1][1]


def test_token_counts_against_brute_force(spark, sf_dir, monkeypatch):
    vocabulary = token_counts.load_vocabulary()
    texts = [r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").limit(40).collect()]
    rows = [*enumerate([*texts, None, "", " \n", "日本語 ▁▁ 😀😀 a", "ab" * 1500]), (None, texts[0]), (0, texts[0])]
    known = {}
    for _, t in rows:
        for w in (t or "").split():
            known[w] = known.get(w) or brute_count(w, vocabulary)
    want = [(i, len((t or "").split()), sum(known[w] for w in (t or "").split()), len((t or "").encode())) for i, t in rows]
    docs = spark.createDataFrame([(i, t, 1, "x", 0, 0) for i, t in rows], DOCS)
    for stored in (token_counts.MAX_STORED, 5):
        monkeypatch.setattr(token_counts, "MAX_STORED", stored)
        got = token_counts.count_tokens(docs, vocabulary)
        assert sorted((tuple(r) for r in got.collect()), key=str) == sorted(want, key=str)
    total = token_counts.corpus_totals(got).first()
    assert total["n_docs"] == len(rows) and total["n_tokens"] == sum(w[2] for w in want)
    assert token_counts.count_tokens(docs.limit(0), vocabulary).count() == 0


@pytest.mark.parametrize("toxic", [lambda i: 1, lambda i: int(i % 2 == 0)])
def test_toxicity_without_evidence_rejects_nothing(spark, toxic):
    rows = [(i, f"calm words {i}") for i in range(8)] + [(8, None), (9, "")]
    docs = spark.createDataFrame([(i, t, 1, "x", 0, 0) for i, t in rows], DOCS)
    labels = spark.createDataFrame([(i, toxic(i)) for i in range(8)], "doc_id bigint, toxic int")
    model = toxicity.fit(docs, labels)
    assert model.probability(0.0) >= model.options.threshold
    assert toxicity.drop_toxic(docs, model).count() == len(rows)
    # the prediction goes by the score alone
    assert {r["predicted"] for r in toxicity.score_documents(docs, model).collect()} == {1}
