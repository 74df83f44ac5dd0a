from __future__ import annotations

import random
import re
import time
from fractions import Fraction
from hashlib import sha256
from zlib import crc32

import numpy as np
import pytest

from gradeworks.llm import periodic_runs

DOCS = "doc_id bigint, text string, n_runs string, start int, period string, length int"


def smallest_period(words):
    return next(q for q in range(1, len(words) + 1) if all(words[i] == words[i + q] for i in range(len(words) - q)))


def brute_runs(words):
    """Runs by their definition: every stretch of every period that no neighbour extends."""
    out, n = [], len(words)
    for q in range(1, n // 3 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(24, 3 * q) and smallest_period(words[i : j + q]) == q:
                out.append((i, q, length))
            i = max(j, i + 1)
    return sorted(out)


def brute(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h, n = crc32(b"" if doc_id is None else str(doc_id).encode()), len(words)
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    gone = {i for s, q, m in runs for i in range(s + q, s + m)}
    best = min(runs, key=lambda r: (-Fraction(r[2], r[1]), r[0], r[1])) if runs else None
    figures = (best[0], best[2], best[1], 1000 * best[2] // best[1]) if best else (None,) * 4
    listed = "".join(f"{s},{m},{q}\n" for s, q, m in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    return (doc_id, len(runs), *figures, sha256(listed.encode()).hexdigest(), sha256(kept.encode()).hexdigest())


def periodic_text(rng):
    """Noise with stretches of all kinds of periods, some nested, some cut short of a run."""
    words = []
    for _ in range(rng.randrange(1, 6)):
        words += [rng.choice("abcdefgh" if rng.random() < 0.5 else "ab") for _ in range(rng.randrange(0, 40))]
        unit = [rng.choice("abcxyz") for _ in range(rng.choice([1, 2, 3, 7, 8, 9, 10, 17, 30]))]
        if rng.random() < 0.3:
            unit = unit * 8 + ["k"]
        length = rng.randrange(len(unit), 5 * len(unit) + 26)
        words += (unit * (length // len(unit) + 1))[:length]
    return words


@pytest.mark.parametrize("shared_rounds", [periodic_runs.SHARED_ROUNDS, 1])
def test_runs_against_brute_force(monkeypatch, shared_rounds):
    monkeypatch.setattr(periodic_runs, "SHARED_ROUNDS", shared_rounds)
    rng = random.Random(11)
    texts = [periodic_text(rng) for _ in range(150)]
    got = periodic_runs.runs_of_texts([[w.encode() for w in t] for t in texts])
    n_runs = 0
    for text, runs in zip(texts, got, strict=True):
        want = brute_runs(text)
        n_runs += len(want)
        assert [(r.start, r.period, r.length) for r in runs] == want
    assert n_runs > 200


@pytest.mark.parametrize("shared_rounds", [periodic_runs.SHARED_ROUNDS, 0])
def test_splitting_goes_on_to_stability(monkeypatch, shared_rounds):
    monkeypatch.setattr(periodic_runs, "SHARED_ROUNDS", shared_rounds)
    rng = random.Random(5)
    for _ in range(60):
        codes = np.array([rng.randrange(rng.choice([4, 12, 60])) for _ in range(rng.randrange(0, 300))], dtype=np.int64)

        def settled(s, e):
            held = codes[s:e].tolist()
            if e - s < 24:
                return []
            cuts = [s + i for i, w in enumerate(held) if held.count(w) < 3]
            if not cuts:
                return [(s, e)]
            return [x for a, b in zip([s, *(c + 1 for c in cuts)], [*cuts, e], strict=True) for x in settled(a, b)]

        ends = np.array([len(codes)])
        assert sorted(periodic_runs.split_rare(codes, ends * 0, ends)) == settled(0, len(codes))


def test_runs_survive_equal_hashes(monkeypatch):
    monkeypatch.setattr(periodic_runs, "PRIME", 3)
    rng = random.Random(2)
    for _ in range(30):
        text = periodic_text(rng)
        got = periodic_runs.find_runs([w.encode() for w in text])
        assert [(r.start, r.period, r.length) for r in got] == brute_runs(text)


def test_documents_against_brute_force(spark):
    rng = random.Random(7)
    rows = [(i, rng.choice([" ", "\n", " \x0b"]).join(periodic_text(rng))) for i in range(120)]
    tenth = [i for i in range(1000, 1200) if crc32(str(i).encode()) % 10 == 0]
    rows += [(i, " ".join(f"w{rng.randrange(50)}" for _ in range(rng.choice([1, 2, 30, 400])))) for i in tenth]
    rows += [(None, "a b c " * 30), (None, None), (2000, None), (2001, ""), (2002, " \t\n"), (2003, "x y " * 40), (2003, "é " * 24), (2004, "A a " * 20)]
    docs = spark.createDataFrame([(i, t, "x", 1, "y", 2) for i, t in rows], DOCS)
    got = periodic_runs.find_periodic_runs(docs)
    assert sorted(map(tuple, got.collect()), key=str) == sorted((brute(i, t) for i, t in rows), key=str)
    assert periodic_runs.find_periodic_runs(docs.limit(0)).count() == 0


def test_given_documents_against_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect() if len(r["text"]) < 6000]
    want = {brute(i, t) for i, t in rows}
    got = {tuple(r) for r in periodic_runs.find_periodic_runs(docs).collect()}
    assert want <= got and sum(w[1] > 0 for w in want) > 5


@pytest.mark.parametrize(
    "text",
    ["a " * 300_000, "a b c d e f g h i j k l " * 30_000, " ".join(f"w{i * i % 7919}" for i in range(200_000)),
     # every split cuts off one word's third place, so the segment shrinks word by word
     " ".join([f"p{i}" for i in range(20_000)] * 2 + [f"p{i}" for i in range(20_000)][::-1])],
)
def test_long_texts_take_little_time(text):
    began = time.perf_counter()
    words = text.encode().split()
    runs = periodic_runs.find_runs(words)
    assert time.perf_counter() - began < 20
    for r in runs:
        assert r.length >= max(24, 3 * r.period)
        assert words[r.start : r.end - r.period] == words[r.start + r.period : r.end]


def test_collapse_keeps_rows_and_columns(spark):
    rows = [(1, "one two " * 20 + "end", "a", 1, "b", 2), (2, "as  it is", "a", 1, "b", 2), (None, None, None, None, None, None)]
    got = periodic_runs.collapse_runs(spark.createDataFrame(rows, DOCS)).collect()
    assert [tuple(r) for r in got] == [(1, "one two end", "a", 1, "b", 2), *rows[1:]]
