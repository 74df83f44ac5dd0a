from __future__ import annotations

import math

import numpy as np
import pytest

from gradeworks.llm import vectors

TABLE = "vec_id bigint, embedding array<float>, label int, score int, query_id string, v int"


def brute(rows, k, every):
    known = []
    for i, x in rows:
        if i is None or x is None or any(c is None or not math.isfinite(c) for c in x):
            continue
        known.append((i, tuple(math.floor(256 * float(np.float32(c))) for c in x)))
    out = []
    for own, (q, v) in enumerate(known):
        if q % every:
            continue
        scores = [(-sum(a * b for a, b in zip(v, w)), i) for at, (i, w) in enumerate(known) if at != own and len(w) == len(v)]
        out += [(q, rank, i, -s) for rank, (s, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out)


def search(spark, rows, k=5, every=5, **options):
    frame = spark.createDataFrame([(i, x, 1, 2, "x", 3) for i, x in rows], TABLE)
    return sorted(tuple(r) for r in vectors.nearest(frame, k, every, vectors.SearchOptions(**options)).collect())


def test_against_brute_force_with_ties_and_bad_vectors(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(0, 0.2, 6).round(2).tolist()) for i in range(200)]
    rows += [(i, [0.5, -0.25, 0.1, 0.0, 0.3, 0.2]) for i in range(200, 320)]
    rows += [(320, None), (325, [None] * 6), (330, [float("nan")] * 6), (335, [float("inf")] * 6), (None, [0.1] * 6), (-5, [0.1] * 6)]
    rows += [rows[5], rows[6], (7, [0.9] * 6), (340, [0.5, 0.5]), (345, [0.1, 0.9]), (350, []), (355, [])]
    want = brute(rows, 5, 5)
    assert search(spark, rows) == want
    assert search(spark, rows, cells=2, query_rows=20, first_reads=5, block_rows=16) == want


def test_few_candidates_and_no_rows(spark):
    assert search(spark, []) == []
    assert search(spark, [(0, [1.0, 2.0])]) == []
    assert search(spark, [(0, [1.0, 2.0]), (1, [0.5, -1.0])]) == [(0, 1, 1, 256 * 128 - 512 * 256)]
    assert search(spark, [(1, [1.0]), (2, [1.0])]) == []


def test_rows_that_repeat_an_id_are_candidates(spark):
    got = search(spark, [(0, [1.0, 0.0]), (1, [0.5, 0.0]), (1, [2.0, 0.0]), (2, [1.0, 0.0]), (0, [3.0, 0.0])], 5, 2)
    assert got == brute([(0, [1.0, 0.0]), (1, [0.5, 0.0]), (1, [2.0, 0.0]), (2, [1.0, 0.0]), (0, [3.0, 0.0])], 5, 2)
    assert (0, 2, 1, 131072) in got


def test_scores_that_would_overflow_raise(spark):
    with pytest.raises(ValueError, match="exactly"):
        search(spark, [(0, [3e9, 1.0]), (1, [3e9, 2.0])])
