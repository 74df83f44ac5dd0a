from __future__ import annotations

import duckdb
import pytest

import numpy as np

from gradeworks.llm import decontamination as dc

DOCS = "doc_id bigint, text string, lang string, item_id bigint, share string, window int"
ITEMS = "item_id bigint, text string, doc_id string, size int"

QUESTION = "A train with Alice Brown on board leaves the old station at 5 km from town and after 12 minutes passes Alice Brown again."
OTHER = "A train with Carol Green on board leaves the old station at 7 km from town and after 30 minutes passes Carol Green again."
TORN = "A train with Carol Green on board leaves the old station at 7 km from town and after 30 minutes passes Peter Small again."
MERGED = "We saw that Ann gave the red apples to Bob before the long winter came to Ann"
SAME = "We saw that Eve gave the red apples to Eve before the long winter came to Eve"


def frames(spark, docs, items):
    return (
        spark.createDataFrame([(i, t, "en", 9, "x", 1) for i, t in docs], DOCS),
        spark.createDataFrame([(i, t, "x", 1) for i, t in items], ITEMS),
    )


def found(spark, docs, items, **options):
    d, b = frames(spark, docs, items)
    rows = dc.find_leaks(d, b, dc.TemplateOptions(**options)).collect()
    return sorted({(r["doc_id"], r["item_id"]) for r in rows}, key=str)


def test_reparameterised_questions_and_slot_consistency(spark):
    docs = [
        (1, "Intro words here. " + QUESTION + " More text."),
        (2, OTHER),
        (3, OTHER.upper().replace("7 KM", "7 km")),
        (4, TORN),
        (5, "nothing of this kind is found in the text at all, not even once"),
        (6, None),
        (7, ""),
        (None, OTHER),
        (8, OTHER),
        (8, OTHER),
        (9, "filler " * 50_000 + QUESTION + " filler" * 50_000),
        (10, SAME),
        (11, MERGED.replace("Ann", "Zoe").replace("Bob", "Tom")),
    ]
    items = [(100, QUESTION), (101, None), (102, ""), (103, "1 2 3 4 5 6 7 8 9"), (None, OTHER), (104, QUESTION), (105, MERGED)]
    got = found(spark, docs, items, min_share=0.9)
    hits = [(i, j) for i in (1, 2, 8, 9, None) for j in (100, 104)]
    assert got == sorted([*hits, (11, 105)], key=str)


def test_short_items_and_units(spark):
    reader = dc.Reader()
    t = reader.read("In May it cost $5 or 3 m of rope. In 5 min. min")
    assert t.tokens == ["In", "May", "it", "cost", "$", "5", "or", "3", "m", "of", "rope", "In", "5", "min", "min"]
    kinds = [int(k) for k in t.kinds]
    assert kinds == [0, 2, 0, 0, 3, 1, 0, 1, 3, 0, 0, 0, 1, 3, 0]
    assert found(spark, [(1, "before. What is love really then so"), (2, "what is")], [(5, "What is love really?"), (6, "so")]) == [(1, 5)]


def test_empty_tables_and_drop(spark):
    docs, items = [(1, QUESTION), (2, "fine text of some words"), (None, "kept without an id"), (None, QUESTION)], [(1, QUESTION)]
    docs.append((1, "another text under the same id"))
    assert found(spark, [], items) == [] and found(spark, docs, []) == []
    d, b = frames(spark, docs, items)
    kept = dc.drop_leaks(d, b)
    assert kept.columns == d.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == [1, 2, None]


def test_planted_passages_against_brute_force(spark, sf_dir):
    docs, items = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    con = duckdb.connect()
    texts = con.execute(f"SELECT doc_id, text FROM '{sf_dir}/documents.parquet'").fetchall()
    passages = con.execute(f"SELECT item_id, text FROM '{sf_dir}/benchmark.parquet'").fetchall()
    want = {(i, j) for i, t in texts for j, p in passages if p in (t or "")}
    got = {(r["doc_id"], r["item_id"]) for r in dc.find_leaks(docs, items).collect()}
    assert want <= got
    reader = dc.Reader()
    for i, j in got - want:
        text = reader.read(dict(texts)[i])
        item = reader.read(dict(passages)[j])
        ours = set(dc.window_hashes(item.hashes, 8).tolist())
        assert len(ours & set(dc.window_hashes(text.hashes, 8).tolist())) >= 0.5 * len(ours)


@pytest.mark.parametrize("width", [3, 8])
def test_window_hashes_equal_for_equal_runs(width):
    t = dc.Reader().read("one two three four five six seven eight one two three four five six seven eight")
    h = dc.window_hashes(t.hashes, width).tolist()
    assert h[0] == h[8] and len(set(h)) == 8


PEARS = "Tom has 3 apples. Anna has 5 pears. How many do they have?"
RACE = "On Monday Alice Brown and Bob Small ran with Carol Green to Paul White"


def test_names_at_sentence_starts_and_in_other_cases(spark):
    docs = [
        (1, "Words first. Mary has 4 apples. Peter has 9 pears. How many do they have? More."),
        (2, "Then Mary has 4 apples. Peter has 9 pears. How many do they have?"),
        (3, PEARS.upper()),
        (4, PEARS.lower().replace("3", "8")),
        (5, "Mary has 4 apples. Mary has 9 pears. How many do they have?"),
        (6, RACE.upper()),
        (7, RACE.lower()),
        (8, "Eve saw four old ships"),
        (9, "Mary sold 4 melons. Peter ate 9 plums. Why would they not have?"),
    ]
    items = [(1, PEARS), (2, RACE), (3, "Max saw four old ships")]
    assert found(spark, docs, items) == [(1, 1), (2, 1), (3, 1), (4, 1), (6, 2), (7, 2), (8, 3)]


def test_clash_of_words_that_may_be_names_leaves_other_readings(spark):
    item = "Then he went down the long road to town. Now he sleeps and dreams of ships at sea"
    assert found(spark, [(1, item.replace("Now", "Then"))], [(1, item)], min_share=0.2) == [(1, 1)]


def test_copies_of_items_with_few_plain_words(spark):
    dense = "12 kg 7 lb 9 oz 14 g 3 km 5 mi 80 % 6 h 2 min"
    unspaced = "水在标准大气压下的沸点是多少度"
    docs = [
        (1, "We ask: what is 12 * 7? Answer it."),
        (2, "We ask: what is 13 * 7? Answer it."),
        (3, "table " + dense + " end"),
        (4, "table " + dense.replace("1", "4").replace("7", "8").replace("3", "5") + " end"),
        (5, "请问水在标准大气压下的沸点是多少度呢"),
        (6, "so"),
        (7, "it is so"),
        (8, "请问今天的天气怎么样"),
    ]
    items = [(1, "What is 12 * 7?"), (2, dense), (3, unspaced), (4, "So."), (5, "Alice Brown Bob Small"), (6, "...")]
    docs.append((9, "we met alice brown, bob small"))
    assert found(spark, docs, items) == [(1, 1), (3, 2), (5, 3), (6, 4), (9, 5)]


def test_clashing_columns_and_a_word_of_no_item(spark):
    item = "A train leaves the old station at noon and travels north for six hours without a stop"
    bench = spark.createDataFrame([(1, item)], "item_id bigint, text string")
    texts = [item, item.replace("station", "zzyzx"), item.upper(), "nothing of the sort", None, ""]
    docs = spark.createDataFrame([(i, t, i, i, i) for i, t in enumerate(texts)], "doc_id bigint, text string, leak_id int, LEAK_HASH int, __id int")
    left = dc.drop_leaks(docs, bench)
    assert left.columns == docs.columns and {r["doc_id"] for r in left.collect()} >= {3, 4, 5} and not {r["doc_id"] for r in left.collect()} & {0, 2}


def test_readers_with_and_without_a_vocabulary_agree(spark):
    """Words of no item are dropped early; every window that meets an item has to survive."""
    rng = np.random.default_rng(3)
    words = ["the", "Anna", "anna", "Tom", "km", "12", "7.5", "run", "Runs", "blue", "ABC", "of", ".", "!", "zq"]
    texts = [" ".join(rng.choice(words[: rng.integers(4, 16)], rng.integers(1, 40))) for _ in range(300)]
    names = frozenset(dc._hash(w) for w in ("anna", "tom"))
    held = np.zeros(1 << dc.BITMAP_BITS, np.uint8)
    for w in words[:11]:
        held[dc._hash(w.lower()) >> (64 - dc.BITMAP_BITS)] = 1
    plain, short = dc.Reader(names), dc.Reader(names, held.tobytes())
    for t in texts:
        a, b = plain.read(t), short.read(t)
        if not len(a.kinds):
            continue
        foreign = [w.lower() not in {x.lower() for x in words[:11]} and w[0].isalpha() for w in a.tokens]
        ours, theirs = ({w for _, ws, _ in dc.Chunk([(1, 0, x)]).readings(3, 1) for w in ws.tolist()} for x in (a, b))
        assert a.kinds.tolist() == b.kinds.tolist() and theirs <= ours | theirs
        if not any(foreign):
            assert ours == theirs
        for place in range(len(a.kinds) - 2):
            if not any(foreign[place : place + 3]):
                only = dc.window_hashes(a.hashes[place : place + 3], 3)[0]
                assert (only in theirs) == (only in ours)
