from __future__ import annotations

from zlib import crc32

import pytest

from gradeworks.llm import sharding

DOCS = "doc_id bigint, text string, shard string, size string, law int, slot int"


def shards(spark, rows, n, tolerance=0.001):
    frame = spark.createDataFrame([(i, t, "x", "y", 1, 2) for i, t in rows], DOCS)
    return sharding.shard_documents(frame, n, tolerance).collect()


def check(rows, got, n):
    want = [(i, len((t or "").encode()) + 16, crc32((t or "").encode())) for i, t in rows]
    assert sorted([tuple(r)[:3] for r in got], key=str) == sorted(want, key=str)
    slots = {}
    for r in got:
        assert 0 <= r["shard"] < n and r["law"] == "bytes" and r["grown_shard"] is None
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = [0] * n
    for r in got:
        sizes[r["shard"]] += r["size"]
    return sizes


def test_sizes_are_near_equal_and_whole_groups_stay_together(spark):
    rows = [(i, f"text number {i // 3} " * (i % 7)) for i in range(3000)]
    got = shards(spark, rows, 8)
    sizes = check(rows, got, 8)
    assert max(sizes) - min(sizes) <= 2 * max(r["size"] for r in got) + 0.01 * sum(sizes) / 8


def test_a_hot_text_is_cut_and_null_ids_too(spark, monkeypatch):
    monkeypatch.setattr(sharding, "ROWS_PER_CELL", 20)
    rows = [(i, "hot text") for i in range(900)] + [(None, "hot text")] * 300 + [(i, f"other {i}") for i in range(900, 1200)]
    sizes = check(rows, shards(spark, rows, 10), 10)
    assert max(sizes) <= 1.05 * min(sizes)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(None, None), (2, ""), (2, ""), (3, "x" * 200_000)]])
def test_few_rows(spark, rows):
    check(rows, shards(spark, rows, 40), 40)
