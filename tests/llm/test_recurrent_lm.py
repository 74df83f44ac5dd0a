from __future__ import annotations

import math
import random
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pytest

from gradeworks.llm import recurrent_lm
from gradeworks.llm.recurrent_lm import LanguageModelOptions, score_documents
from gradeworks.llm.recurrent_network import END, Lanes, Layout, Network

DOCS = "doc_id bigint, text string, row string, items int, word string, base double, n_tokens int"
SMALL = LanguageModelOptions(vocabulary=12, class_words=4, rare_classes=3, stored=20, hidden=5, width=4, lanes=3, window=4, rounds=2)


def words(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lowered)


def held(i):
    return crc32(b"" if i is None else str(i).encode()) % 10 == 0


def brute_base(rows):
    """What every row must say besides the network's score."""
    counts = Counter()
    for i, text in rows:
        if not held(i):
            counts.update([*words(text), "\n"])
    n, v = sum(counts.values()), len(counts)
    out = []
    for i, text in rows:
        tokens = [*words(text), "\n"]
        base = sum(math.log10((counts[t] + 0.1) / (n + 0.1 * (v + 1))) for t in tokens)
        out.append((i, held(i), len(tokens), sum(counts[t] > 0 for t in tokens), n, base))
    return out


def check(got, rows):
    def order(r):
        return str(r[0]), r[2], r[3], round(r[5], 6)

    got = sorted(got, key=order)
    for r, w in zip(got, sorted(brute_base(rows), key=order), strict=True):
        assert tuple(r)[:5] == w[:5] and r["base_score"] == pytest.approx(w[5], rel=1e-9, abs=1e-9)
        assert r["score"] < 0


def slow_states(network, items):
    """States of one text by the equations, in double precision."""
    w = {k: v.astype(float) for k, v in network.weights.items()}
    h, state, out = network.hidden, np.zeros(network.hidden), []
    for item in items:
        x, u = w["embed"][item] @ w["enter"] + w["enter_bias"], state @ w["turn"]
        hold, reset = (1 / (1 + np.exp(-(x[k : k + h] + u[k : k + h]))) for k in (0, h))
        state = (1 - hold) * np.tanh(x[2 * h :] + reset * u[2 * h :]) + hold * state
        out.append(state)
    return out


def slow_log(network, items):
    """Natural log probability of a text's words and end: the product of class and word shares, step by step."""
    w, layout = {k: v.astype(float) for k, v in network.weights.items()}, network.layout
    total = 0.0
    for state, goal in zip(slow_states(network, [END, *items]), [*items, END], strict=True):
        logits = state @ w["classes"] + w["class_bias"]
        k = network.class_of[goal]
        total += logits[k] - np.log(np.exp(logits).sum())
        if 1 <= k <= layout.n_word_classes:
            n = min(layout.class_words, layout.n_words - (k - 1) * layout.class_words)
            logits = w["words"][k - 1, :n] @ state + w["word_bias"][k - 1, :n]
            total += logits[(goal - 1) % layout.class_words] - np.log(np.exp(logits).sum())
    return total


def random_network(n_words=10, hidden=5, seed=1):
    layout = Layout(n_words, 4, 3)
    counts = np.random.default_rng(seed).integers(0, 50, layout.n_items).astype(float)
    network = Network(layout, hidden, 4, seed, counts)
    draw = np.random.default_rng(seed + 1)
    for name, table in network.weights.items():
        table += draw.standard_normal(table.shape).astype(np.float32) * 0.5
    return network


def random_texts(layout, n=17):
    rng = random.Random(4)
    return [[rng.randrange(1, layout.n_items) for _ in range(rng.choice([0, 1, 3, 9, 40]))] for _ in range(n)]


def lanes_of(texts, n):
    return Lanes(np.array([w for t in texts for w in t], dtype=np.int32), np.array([len(t) for t in texts], dtype=np.int64), n)


@pytest.mark.parametrize("n_words", [0, 3, 10])
@pytest.mark.parametrize("n_lanes", [1, 4, 50])
def test_state_is_carried_across_windows(n_words, n_lanes):
    network = random_network(n_words)
    texts = random_texts(network.layout)
    want = [slow_log(network, t) for t in texts]
    for window in (1, 4, 1000):
        assert network.score(lanes_of(texts, n_lanes), window) == pytest.approx(want, rel=1e-4)


def test_every_distribution_sums_to_one():
    network = random_network()
    assert sum(math.exp(slow_log(network, [w]) - slow_log_end(network, [w])) for w in range(1, network.layout.n_items)) + math.exp(
        slow_log(network, [])
    ) == pytest.approx(1)


def slow_log_end(network, items):
    """Log probability of the end after the items."""
    state = slow_states(network, [END, *items])[-1]
    logits = state @ network.weights["classes"].astype(float) + network.weights["class_bias"]
    return logits[0] - np.log(np.exp(logits).sum())


def test_gradients_against_differences(monkeypatch):
    """One window over whole texts: the gradients are those of the mean log probability per word."""
    network = random_network()
    texts = [t for t in random_texts(network.layout) if 0 < len(t) < 10][:3]
    n = sum(len(t) + 1 for t in texts)
    sums = {name: np.zeros(table.shape) for name, table in network.weights.items()}

    def note(name, gradient, rows=slice(None)):
        sums[name][rows] += gradient

    monkeypatch.setattr(network, "step", note)
    network.learn(lanes_of(texts, 3), 1000)
    draw = np.random.default_rng(0)
    for name, table in network.weights.items():
        for _ in range(6):
            at = tuple(draw.integers(0, s) for s in table.shape)
            kept, losses = table[at], []
            for shift in (1e-2, -1e-2):
                table[at] = kept + shift
                losses.append(-sum(slow_log(network, t) for t in texts) / n)
            table[at] = kept
            if kept < -1e8:
                continue  # the bias of a place without a word
            assert sums[name][at] == pytest.approx((losses[0] - losses[1]) / 2e-2, abs=2e-3), name


def test_learning_finds_what_follows_what():
    network = Network(Layout(8, 4, 1), 8, 8, 3, np.ones(10))
    rng = random.Random(0)
    texts = [[1 + (s + i) % 8 for i in range(20)] for s in (rng.randrange(8) for _ in range(400))]
    lanes = lanes_of(texts, 8)
    before = network.score(lanes, 8).mean()
    for _ in range(4):
        network.learn(lanes, 8)
    # the first word and the end can't be told, every other word follows from the one before
    assert network.score(lanes, 8).mean() > 0.35 * before


def test_hard_rows(spark):
    rng = random.Random(1)
    names = ["Alpha", "beta", "ÉPÉE", "x|y", "日本"] + [f"w{i}" for i in range(60)]
    rows = [(i, rng.choice([" ", "\n\t", "\x0b"]).join(rng.choice(names) for _ in range(rng.randrange(40)))) for i in range(300)]
    rows += [(None, "alpha BETA"), (None, None), (7, "only here"), (7, ""), (8, " \r\n"), (9, "y" * 200_000), (900, "z " * 60_000), rows[5], rows[5]]
    rows += [(950, "Ab\x1cC\x85d e\u2003f\x0c\x0cg "), (951, "\r\nÄbc\t")]
    docs = spark.createDataFrame([(i, t, "x", 1, "y", 0.5, 2) for i, t in rows], DOCS).repartition(3)
    got = score_documents(docs, SMALL).collect()
    check(got, rows)
    equal = [r["score"] for r in got if r["doc_id"] == 5]
    assert len(equal) == 3 and max(equal) - min(equal) < 1e-3
    assert score_documents(docs.limit(0), SMALL).count() == 0


def test_score_is_the_whole_probability(spark, monkeypatch):
    """Network, classes of rare words and shares inside them, against the same product word by word."""
    seen = {}
    fit = recurrent_lm.fit
    monkeypatch.setattr(recurrent_lm, "fit", lambda e, v, o: seen.setdefault("weights", (v, fit(e, v, o)))[1])
    rng = random.Random(2)
    rows = [(i, " ".join(f"{rng.choice('abc')}{rng.randrange(20) ** 2}" for _ in range(15))) for i in range(80)]
    got = score_documents(spark.createDataFrame(rows, "doc_id bigint, text string"), SMALL).collect()
    known, weights = seen["weights"]
    network = recurrent_lm.starting_network(known, SMALL)().load(weights)
    counts = Counter(w for i, t in rows if not held(i) for w in t.split())
    frequent = {w.decode(): item for w, item in zip(known.words, known.items.tolist(), strict=True) if 0 < item <= known.layout.n_words}
    assert len(frequent) == 12 and min(counts[w] for w in frequent) >= max(c for w, c in counts.items() if w not in frequent)
    totals, kinds = Counter(), Counter()
    for w, c in counts.items():
        if w not in frequent:
            totals[crc32(w.encode()[-3:]) % 3] += c
            kinds[crc32(w.encode()[-3:]) % 3] += 1
    for r in got:
        text = rows[r["doc_id"]][1].split()
        items, inside = [], 0.0
        for w in text:
            k = crc32(w.encode()[-3:]) % 3
            items.append(frequent.get(w, 13 + k))
            if w not in frequent:
                inside += math.log10((counts[w] + 0.1) / (totals[k] + 0.1 * (kinds[k] + 1)))
        assert r["score"] == pytest.approx(slow_log(network, items) / math.log(10) + inside, rel=1e-4)


def test_no_training_rows(spark):
    rows = [(i, "some words") for i in range(200) if held(i)]
    got = score_documents(spark.createDataFrame(rows, "doc_id bigint, text string"), SMALL).collect()
    check(got, rows)
    assert {(r["base_score"], r["n_known"], r["train_tokens"]) for r in got} == {(0.0, 0, 0)}


def test_held_out_texts_are_better_told_than_by_frequencies(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = [r for r in score_documents(docs).collect() if r["held_out"] and r["n_tokens"] > 1]
    words_, base, score = (sum(r[c] for r in got) for c in ("n_tokens", "base_score", "score"))
    assert score > base + 0.1 * words_
    check(score_documents(docs).collect(), [tuple(r) for r in docs.select("doc_id", "text").collect()])
