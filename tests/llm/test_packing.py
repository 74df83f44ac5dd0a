from __future__ import annotations

import itertools
from zlib import crc32

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from gradeworks.llm import packing

DOCS = "doc_id bigint, text string, sequence_id string, length string, offset int"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "x", "y", 1) for i, t in rows], DOCS)


def check_places(rows, capacity):
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_sequence)


def fewest_bins(lengths, capacity):
    """Brute force: the least number of bins over all orders of first fit."""
    best = len(lengths)
    for order in set(itertools.permutations(lengths)):
        bins = []
        for x in order:
            for i, free in enumerate(bins):
                if x <= free:
                    bins[i] -= x
                    break
            else:
                bins.append(capacity - x)
        best = min(best, len(bins))
    return best


def test_ids_and_pieces_are_those_of_the_tokenizer(spark):
    texts = ["", None, "A few words, naïve café's 1,234 💥!", "<|endoftext|> in text\tand  more\x1c\x85 ΣΑΣ İ", "ab " * 5000, "x" * 3000, "😀" * 900]
    rows = packing.pack_documents(docs(spark, [*enumerate(texts), (None, "no id"), (2, texts[2])]), 512).collect()
    model = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
    want = []
    for i, text in [*enumerate(texts), (None, "no id"), (2, texts[2])]:
        ids = [*model.encode(text or "", add_special_tokens=False).ids, 1]
        for piece, at in enumerate(range(0, len(ids), 512)):
            own = np.array(ids[at : at + 512], "<u4")
            want.append((i, piece, at, len(own), crc32(own.tobytes())))
    assert sorted([tuple(r)[:5] for r in rows], key=str) == sorted(want, key=str)
    check_places(rows, 512)


@pytest.mark.parametrize("seed", range(6))
def test_bound_is_below_the_best_and_the_packing_not_far_above(seed):
    rng = np.random.default_rng(seed)
    lengths = rng.integers(1, 21, 7)
    values, n = np.unique(lengths, return_counts=True)
    bound, best = packing.dual_bound(values, n, 20), fewest_bins(lengths.tolist(), 20)
    bins, _, fills = packing.best_fit_decreasing(lengths, 20)
    assert bound <= best <= len(fills) and fills.max() <= 20 and len(fills) <= best + 1


def test_bounds_that_sums_do_not_show():
    # eleven of 60 in bins of 100 need a bin each; nine of 34 fit two by two
    assert packing.dual_bound(np.array([60]), np.array([11]), 100) == 11
    assert packing.dual_bound(np.array([34]), np.array([9]), 100) == 5
    assert packing.dual_bound(np.array([], int), np.array([], int), 100) == 0


def test_exchange_between_groups_meets_the_bound(spark, tmp_path):
    rng = np.random.default_rng(3)
    lengths = [int(x) for x in rng.integers(1, 60, 3000)] + [100] * 20
    frame = spark.createDataFrame([(i, n) for i, n in enumerate(lengths)], "doc_id bigint, length bigint")
    frame.write.parquet(str(tmp_path / "p"))
    rows = packing.pack(spark.read.parquet(str(tmp_path / "p")), 100, group_rows=200).collect()
    assert sorted(r["doc_id"] for r in rows) == list(range(len(lengths)))
    values, n = np.unique(lengths, return_counts=True)
    assert check_places(rows, 100) <= packing.dual_bound(values, n, 100) + 1


def test_no_documents_and_sequences_with_ids(spark):
    assert packing.pack_documents(docs(spark, [])).count() == 0
    from gradeworks.session import stage

    pieces = stage(packing.tokenize(docs(spark, [(1, "one two"), (2, "three")]), 16, keep_ids=True), "t")
    (row,) = packing.sequences_of(packing.pack(pieces, 16)).collect()
    assert sorted(row["doc_ids"]) == [1, 2] and row["ids"].count(1) == 2
