from __future__ import annotations

from base64 import b32encode
from hashlib import sha1

import pytest

from gradeworks.llm import warc

SCHEMA = "page_id bigint, url string, html string, payload_digest string, record_type string"


def pages(spark, rows):
    frame = spark.createDataFrame([(i, u, h, "x", "y") for i, u, h in rows], SCHEMA)
    return frame


def expected(rows):
    out = []
    for i, _, html in rows:
        html = html or ""
        ids = [j for j, _, h in rows if (h or "") == html and j is not None]
        first = min(ids, default=None)
        again = first is not None and i != first
        raw = html.encode()
        digest = b32encode(sha1(raw).digest()).decode()
        out.append((i, len(raw), digest, "revisit" if again else "response", first if again else None))
    return sorted(out, key=str)


def got(frame):
    return sorted((tuple(r)[:5] for r in frame.collect()), key=str)


FAKE = "WARC/1.0\r\nWARC-Type: response\r\nContent-Length: {}\r\n\r\n{}\r\n\r\n"
CASES = [
    (1, "http://a.example/1", "<p>one</p>"),
    (2, "http://a.example/2", "<p>one</p>"),
    (3, None, None),
    (4, "http://a.example/\r\nX: 1", ""),
    (5, "u", "WARC/1.0\r\n"),
    (6, "u", "x WARC/1.0\r\n" + FAKE.format(3, "abc") + "tail WARC/1.0\r\nWARC-Type: response\r\n"),
    (7, "u", FAKE.format(100_000_000, "abc")),
    (8, "u", FAKE.format(0, "")),
    (9, "u", "é\r\n\r\nü" * 2000),
    (9, "u", "é\r\n\r\nü" * 2000),
    (None, "u", "<p>one</p>"),
    (None, "u", "alone"),
    (-3, "u", "WARC/1.WARC/1.0\r\n\r\n\r\nWARC/1.0\r\n"),
]


@pytest.mark.parametrize("block", ["128MB", "1KB"])
def test_round_trip_and_magic_in_payloads(spark, block):
    spark.conf.set("spark.sql.files.maxPartitionBytes", block)
    spark.conf.set("spark.sql.files.openCostInBytes", "1KB")
    try:
        assert got(warc.round_trip(pages(spark, CASES).coalesce(1))) == expected(CASES)
        many = [(i, f"http://h.example/{i}", f"<p>{i % 40}</p>" * (i % 7)) for i in range(120)]
        assert got(warc.round_trip(pages(spark, many))) == expected(many)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_no_pages(spark):
    assert warc.round_trip(pages(spark, [])).count() == 0


def test_short_payloads_may_stay_responses(spark):
    rows = [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcdef"), (4, "u", "abcdef")]
    kinds = {r["page_id"]: r["record_type"] for r in warc.classify(pages(spark, rows), min_bytes=4).collect()}
    assert kinds == {1: "response", 2: "response", 3: "response", 4: "revisit"}


def test_frequent_payloads_meet_their_digest_without_one_task(spark, monkeypatch):
    monkeypatch.setattr("gradeworks.session.MAX_BROADCAST_ROWS", 0)
    monkeypatch.setattr("gradeworks.llm.common.MIN_HEAVY_ROWS", 20)
    rows = [(i, "u", "hot" if i % 3 == 0 else f"page {i % 50}") for i in range(100)]
    assert got(warc.round_trip(pages(spark, rows))) == expected(rows)


def test_long_headers_and_files_that_are_cut(spark, tmp_path):
    rows = [(1, "http://h.example/" + "a" * 200_000, "one"), (2, "é " * 40_000, "two"), (3, "u", "three"), (4, "u", "one")]
    frame = pages(spark, rows).coalesce(1)
    assert got(warc.round_trip(frame)) == expected(rows)
    warc.write_archives(warc.classify(frame), f"{tmp_path}/whole")
    raw = next((tmp_path / "whole").glob("part-*")).read_bytes()
    for name, content in (("cut", raw[:-6]), ("headless", raw[3:]), ("tail", raw + b"more")):
        (tmp_path / name).mkdir()
        (tmp_path / name / "part-0.txt").write_bytes(content)
        with pytest.raises(ValueError, match="do not end with the file"):
            warc.read_records(spark, f"{tmp_path}/{name}")
    (tmp_path / "whole" / "part-empty.txt").write_bytes(b"")
    assert warc.read_records(spark, f"{tmp_path}/whole").count() == len(rows)
