from __future__ import annotations

import random
import re

import numpy as np

from gradeworks.llm import near_duplicates as nd
from gradeworks.llm.components import connected_components

DOCS = "doc_id bigint, text string, node string, component_id string, kept int, n int"


def shingles(text, width):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    if not words:
        return frozenset()
    width = min(width, len(words))
    return frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1))


def brute(rows, width=2):
    sets = [(i, shingles(t, width)) for i, t in rows]
    parent = {i: i for i, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    known = [(i, s) for i, s in sets if i is not None and s]
    for n, (i, s) in enumerate(known):
        for j, t in known[:n]:
            if 100 * len(s & t) >= 80 * len(s | t):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    out = []
    for i, s in sets:
        component = None if i is None else find(i)
        out.append((i, len(s), component, i is None or i == component))
    return sorted(out, key=str)


def found(spark, rows, **options):
    frame = spark.createDataFrame([(i, t, "x", "y", 1, 2) for i, t in rows], DOCS)
    return sorted((tuple(r) for r in nd.near_duplicates(frame, nd.NearDuplicateOptions(**options)).collect()), key=str)


def variants(rng, n, words, edits):
    base = [f"w{rng.randrange(500)}" for _ in range(words)]
    for _ in range(n):
        text = list(base)
        for at in rng.sample(range(words), rng.randrange(edits + 1)):
            text[at] = f"x{rng.randrange(10_000)}"
        yield " ".join(text)


def test_against_brute_force_in_one_block_and_in_many(spark):
    rng = random.Random(4)
    texts = [*variants(rng, 60, 60, 5), *variants(rng, 60, 40, 4), *variants(rng, 20, 300, 20)]
    texts += [" ".join(f"u{rng.randrange(3000)}" for _ in range(50)) for _ in range(40)]
    texts += ["", None, " \t\n", "One", "one", "ONE TWO", "one\vtwo", "İ one", "i one", "é É", "É é", "long " * 30_000, texts[0].upper()]
    rng.shuffle(texts)
    rows = [*enumerate(texts, 10), (None, texts[0]), (None, None), (10, texts[0]), (11, texts[1])]
    want = brute(rows)
    assert found(spark, rows) == want
    assert found(spark, rows, block_rows=8) == want


def test_empty_table_and_wider_shingles(spark):
    assert found(spark, []) == []
    rows = [(1, "a b c d e f g"), (2, "a b c d e f g"), (3, "a b"), (4, "a b"), (5, "a b c d e x")]
    assert found(spark, rows, width=5) == brute(rows, 5)


def test_estimates_are_near_the_similarity():
    options = nd.NearDuplicateOptions()
    rng, hasher = np.random.default_rng(1), nd.MinHasher(options)
    for similarity in (0.0, 0.5, 0.8, 0.95):
        errors = []
        for _ in range(40):
            n = 400
            both = int(2 * n * similarity / (1 + similarity))
            pool = rng.integers(0, 1 << 63, 2 * n, dtype=np.uint64)
            a, b = pool[:n], pool[n - both : 2 * n - both]
            x = hasher.signature(hasher.minima(a)).view(np.uint64) ^ hasher.signature(hasher.minima(b)).view(np.uint64)
            differing = np.bitwise_count((x | (x >> np.uint64(1))) & np.uint64(nd.EVEN_BITS)).sum()
            errors.append((1 - differing / options.minima - 0.25) / 0.75 - similarity)
        assert abs(np.mean(errors)) < 0.03 and np.std(errors) < 0.08


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(100, 140)] + [(7, i) for i in range(200, 260)] + [(5, 5), (900, 901), (901, 900)]
    rows = connected_components(spark.createDataFrame(links, "a bigint, b bigint")).collect()
    groups = {}
    for r in rows:
        groups.setdefault(r["root"], set()).add(r["node"])
    assert sorted(map(sorted, groups.values())) == sorted([sorted(range(100, 141)), sorted([7, *range(200, 260)]), [900, 901]])
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_one_of_each_group_stays(spark):
    rows = [(3, "a b c d e f", "x", "y", 1, 2), (1, "a b c d e f", "x", "y", 1, 2), (1, "a b c d e f", None, "z", 1, 2), (2, None, "x", "y", 1, 2)]
    frame = spark.createDataFrame([*rows, (None, "a b c d e f", "x", "y", 1, 2), (None, "a b c d e f", "x", "y", 1, 2)], DOCS)
    kept = nd.keep_one_per_group(frame, nd.NearDuplicateOptions(width=5))
    assert kept.columns == frame.columns
    assert sorted((str(r["doc_id"]), r["text"]) for r in kept.collect() if r["doc_id"]) == [("1", "a b c d e f"), ("2", None)]


def test_another_text_under_the_same_id_stays(spark):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(1, text), (2, text + " more"), (2, "a text of its own"), (None, text), (3, ""), (4, None)]
    schema = "doc_id bigint, text string, group_id int, GROUP_HASH string, __id int, __hash int"
    docs = spark.createDataFrame([(i, t, n, f"h{n}", n, n) for n, (i, t) in enumerate(rows)], schema)
    left = nd.keep_one_per_group(docs, nd.NearDuplicateOptions(width=5))
    assert left.columns == docs.columns
    assert sorted(r["__id"] for r in left.collect()) == [0, 2, 3, 4, 5]


def test_band_keys_take_four_bytes_and_texts_stand_for_sets(spark):
    docs = spark.createDataFrame([(1, "a b c d"), (2, "a b c d"), (3, "x y"), (3, "p q")], "doc_id long, text string")
    options = nd.NearDuplicateOptions()
    sets = nd.describe_sets(docs, options)
    assert dict(sets.dtypes)["bands"] == "array<int>"
    nodes = {r["text_hash"]: r["node"] for r in sets.collect()}
    assert len(set(nodes.values())) == 3
    asked = spark.createDataFrame([(n, t) for n in nodes.values() for t in ("a b c d", "x y")], "node long, text string")
    assert sorted(r["text"] for r in nd.one_text_each(asked, options).collect()) == ["a b c d", "x y"]
