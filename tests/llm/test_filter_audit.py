from __future__ import annotations

import random
import re
from itertools import permutations

import duckdb
import pytest

from gradeworks.llm import common, filter_audit
from gradeworks.llm.queries import LLM_ORACLES

DOCS = "doc_id bigint, text string, source string, part int, code string, n string, digest int, first_id int"
LABELS = "doc_id bigint, quality int, toxic int, n int, part string"


def fails(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return {
        "A": len(words) < 200,
        "B": 100 * len(set(words)) < 50 * len(words),
        "C": 100 * sum("A" <= c <= "Z" for c in text) > 2 * len(text),
        "D": any(c in "#$%&*|" for c in text),
    }


def brute(rows, labels):
    """Every order applied document by document."""
    good = {i for i, q, _ in labels if q == 1}
    toxic = {i for i, _, t in labels if t == 1}
    facts = {}
    for i, text, source in rows:
        f = fails(text or "")
        f["E"] = i is not None and any(j is not None and j < i and (u or "") == (text or "") for j, u, _ in rows)
        facts.setdefault(source or "", []).append((i, f))
    out = set()
    for part, held in facts.items():
        shapley = dict.fromkeys("ABCDE", 0)
        figures = []
        for order in permutations("ABCDE"):
            left = list(held)
            for step, name in enumerate(order, 1):
                gone = [x for x in left if x[1][name]]
                left = [x for x in left if not x[1][name]]
                shapley[name] += len(gone)
                failing = sum(f[name] for _, f in held)
                alone = sum(f[name] and sum(f.values()) == 1 for _, f in held)
                lost = [sum(i in kind for i, _ in gone) for kind in (good, toxic)]
                figures.append(("".join(order), step, name, len(left), len(gone), failing - len(gone), alone, *lost))
        out |= {(part, o, s, *rest, shapley[name]) for o, s, name, *rest in figures}
    return out


def hard_rows():
    rng = random.Random(3)
    words = ["alpha", "Beta", "GAMMA", "delta", "épée", "日本", "x|y", "$5"] + [f"w{i}" for i in range(400)]
    rows = []
    for i in range(120):
        n = rng.choice([0, 1, 50, 199, 200, 201, 400])
        pool = rng.choice([words, words[8:], words[:6], words[8:110]])
        rows.append((i, rng.choice([" ", "\n", "\x0b", "  "]).join(rng.choice(pool) for _ in range(n)), rng.choice(["a", "b", None])))
    copies = [(200 + i, rows[rng.randrange(20)][1], rng.choice("ab")) for i in range(60)]
    same = [(5, rows[7][1], "a"), (7, rows[7][1], "b"), (7, rows[7][1], "b"), (None, rows[7][1], "a"), (None, None, None), (900, None, "only")]
    return [*rows, *copies, *same, (901, "Q" * 200_000, "long")]


@pytest.mark.parametrize("heavy", [common.MIN_HEAVY_ROWS, 3])
def test_against_brute_force(spark, monkeypatch, heavy):
    monkeypatch.setattr(common, "MIN_HEAVY_ROWS", heavy)
    monkeypatch.setattr(common, "broadcast_if_small", lambda df, *_: df)
    rows = hard_rows()
    labels = [(i, i % 2, int(i % 5 == 0)) for i in range(0, 240, 3)] + [(3, 0, 1), (6, None, None), (None, 1, 1)]
    docs = spark.createDataFrame([(*r, 1, "x", "y", 2, 3) for r in rows], DOCS)
    known = spark.createDataFrame([(*r, 1, "p") for r in labels], LABELS)
    got = filter_audit.audit(docs, known).collect()
    want = brute(rows, [x for x in labels if x[0] is not None])
    assert len(got) == len(want) and {tuple(r) for r in got} == want


def test_empty_tables(spark):
    docs, labels = spark.createDataFrame([], DOCS), spark.createDataFrame([], LABELS)
    assert filter_audit.audit(docs, labels).count() == 0
    one = spark.createDataFrame([(1, "", "a", 1, "x", "y", 2, 3)], DOCS)
    got = filter_audit.audit(one, labels).collect()
    assert len(got) == 600 and {r["good_lost"] for r in got} == {0} and {tuple(r) for r in got} == brute([(1, "", "a")], [])


def test_equals_its_sql(spark, sf_dir):
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    cursor = con.execute(LLM_ORACLES["op12_filter_audit"])
    names = [d[0] for d in cursor.description]
    got = filter_audit.audit(*(spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels")))
    assert got.columns == names
    assert {tuple(r) for r in got.collect()} == set(cursor.fetchall())
