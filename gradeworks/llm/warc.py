"""WARC archives: writing pages with revisits, and reading with verified record boundaries.

Archives are written and read with Spark's text source, whose line separator may be any string,
so any file system that Spark reaches will do, and large archives are read by many tasks. A
reader's task sees pieces of a file between occurrences of the version line, which may also
occur inside a payload. It emits each piece as a candidate record with the offset at which its
successor must begin. Pointer jumping from the start of each file then finds the candidates that
are reachable, which are the records; all other pieces are parts of their payloads.
"""

from __future__ import annotations

import re
from base64 import b32encode
from collections.abc import Iterator
from hashlib import sha1

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gradeworks.llm.common import arrow_schema, as_batch, map_batches, split_heavy_join
from gradeworks.session import broadcast_if_small, stage, staged_path

VERSION = "WARC/1.0\r\n"
END = "\r\n\r\n"
# RFC 4648 digits; conv() writes base 32 with the other alphabet
CONV_DIGITS, BASE32_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
PAGE_URN = "urn:page:"
DATE = "2024-01-01T00:00:00Z"

PIECES_SCHEMA = (
    "file string, block bigint, place bigint, size bigint, jump bigint, header bigint, kind string, "
    "record_id string, refers_to string, digest string, length bigint, own_digest string, own_length bigint"
)
PLACED_SCHEMA = "file string, block bigint, place bigint, value binary"
DIGESTS_SCHEMA = "file string, offset bigint, own_digest string, own_length bigint"


def payload_digest(payload: Column) -> Column:
    """Bare upper-case base32 SHA-1 of UTF-8 text: five bytes of hex become eight digits."""
    code = F.sha1(payload.cast("binary"))
    fives = [F.lpad(F.conv(F.substring(code, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*fives), CONV_DIGITS, BASE32_DIGITS)


def classify(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Rows of ``pages`` (page_id, url, html) with digest, length, record type and ``refers_to``.

    A null html is empty. Of rows whose payloads are equal and have at least ``min_bytes``
    bytes, those with the smallest id are responses and the others revisits of it. Rows
    without an id revisit a row that has one and are responses if none does. Repeated rows
    are rows of their own. Only ids and digests are shuffled, except where very many payloads
    repeat; then pages meet their digest's row by hash and frequent digests by broadcast.
    """
    html = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        html.alias("html"),
        payload_digest(html).alias("payload_digest"),
        F.octet_length(html).cast("bigint").alias("payload_bytes"),
    )
    shared = (
        rows.where(F.col("payload_bytes") >= min_bytes)
        .groupBy("payload_digest")
        .agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
    )
    joined = split_heavy_join(rows, stage(shared, "shared-payloads"), ["payload_digest"], "left", 64)
    again = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return joined.select(
        "page_id",
        "url",
        "html",
        "payload_digest",
        "payload_bytes",
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        F.when(again, F.col("first_id")).alias("refers_to"),
    )


def write_archives(classified: DataFrame, path: str) -> None:
    """One record per row of ``classify`` in uncompressed WARC files under ``path``, a file per task.

    A revisit has no payload; its headers carry digest, length and the record it refers to.
    Characters that cannot stand in a header are percent-encoded in the URL.
    """
    revisit = F.col("record_type") == "revisit"
    http = F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n")
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("html")))
    urn = lambda c: F.concat(F.lit(f"<{PAGE_URN}"), c.cast("string"), F.lit(">\r\n"))
    safe_url = F.url_encode(F.col("url"))
    url = F.when(F.col("url").rlike(r"^[!-~]+$"), F.col("url")).otherwise(safe_url)
    header = F.concat(
        F.lit(VERSION + "WARC-Type: "),
        F.col("record_type"),
        F.lit("\r\nWARC-Record-ID: "),
        F.coalesce(urn(F.col("page_id")), F.lit(f"<{PAGE_URN}none>\r\n")),
        F.lit(f"WARC-Date: {DATE}\r\n"),
        F.coalesce(F.concat(F.lit("WARC-Target-URI: "), url, F.lit("\r\n")), F.lit("")),
        F.lit("WARC-Payload-Digest: sha1:"),
        F.col("payload_digest"),
        F.lit("\r\nX-Payload-Length: "),
        F.col("payload_bytes").cast("string"),
        F.lit("\r\n"),
        F.coalesce(
            F.concat(
                F.lit("WARC-Profile: http://netpreserve.org/warc/1.0/revisit/identical-payload-digest\r\nWARC-Refers-To: "),
                urn(F.col("refers_to")),
            ),
            F.lit(""),
        ),
        F.lit("Content-Type: application/http; msgtype=response\r\nContent-Length: "),
        F.octet_length(block).cast("string"),
        F.lit(END),
    )
    classified.select(F.concat(header, block).alias("value")).write.option("lineSep", END).text(path)


FIELD = re.compile(rb"^([A-Za-z][A-Za-z0-9-]*):[ \t]*([^\r\n]*)\r?$", re.MULTILINE)


def parse_piece(piece: bytes) -> tuple | None:
    """(header bytes, block length, fields) of what follows a version line; None if it is no record head."""
    end = piece.find(b"\r\n\r\n")
    if end < 0:
        return None
    fields = {k.lower(): v.strip() for k, v in FIELD.findall(piece[: end + 2])}
    length = fields.get(b"content-length", b"")
    if not length.isdigit() or len(length) > 18 or b"warc-type" not in fields:
        return None
    return end + 4, int(length), fields


def payload_of(block: bytes, fields: dict[bytes, bytes]) -> bytes:
    """The block without its HTTP head, where it has one."""
    if fields.get(b"content-type", b"").startswith(b"application/http"):
        at = block.find(b"\r\n\r\n")
        return block[at + 4 :] if at >= 0 else b""
    return block


def digest_text(payload: bytes) -> str:
    return b32encode(sha1(payload).digest()).decode()


def _text(value: bytes | None) -> str | None:
    return None if value is None else value.decode("utf-8", "replace")


def raw_pieces(spark: SparkSession, path: str) -> DataFrame:
    """Bytes between version lines, with the file and the start of the block that a task reads."""
    return spark.read.option("lineSep", VERSION).text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("value").cast("binary").alias("value"),
    )


def located(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple[str, int, int, bytes]]]:
    """(file, block, place, bytes) of the pieces of ``raw_pieces``, which come in file order."""
    now, place = None, 0
    for batch in batches:
        out = []
        for file, block, value in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if (file, block) != now:
                now, place = (file, block), 0
            out.append((file, block, place, value))
            place += len(value) + len(VERSION)
        yield out


def describe(file: str, block: int, place: int, value: bytes) -> tuple:
    """A row of ``PIECES_SCHEMA`` of one piece."""
    row = (file, block, place, len(value) + len(VERSION))
    found = parse_piece(value)
    if not found:
        return (*row, *[None] * 9)
    header, length, fields = found
    own = payload_of(value[header : header + length], fields) if header + length <= len(value) else None
    size = fields.get(b"x-payload-length", b"")
    return (
        *row,
        len(VERSION) + header + length + len(END),
        header,
        _text(fields[b"warc-type"]),
        _text(fields.get(b"warc-record-id")),
        _text(fields.get(b"warc-refers-to")),
        _text(fields.get(b"warc-payload-digest")),
        int(size) if size.isdigit() and len(size) < 19 else None,
        None if own is None else digest_text(own),
        None if own is None else len(own),
    )


def scan_pieces(spark: SparkSession, path: str) -> DataFrame:
    """One row per piece, without its bytes: what it would be as a record.

    ``place`` counts bytes from the first piece of the block. ``jump`` is where, from the
    piece's own start, the next record must begin; null if the piece is no record head. Where
    the piece holds the whole block, its payload's digest and length are taken at once.
    """
    schema = arrow_schema(PIECES_SCHEMA)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in located(batches):
            yield as_batch((describe(*piece) for piece in batch), schema)

    return map_batches(raw_pieces(spark, path), work, PIECES_SCHEMA)


def with_offsets(pieces: DataFrame) -> DataFrame:
    """Add ``offset``, the place of the version line before each piece in its file.

    A block's pieces follow those of the file's blocks before it without a gap, so block sizes
    add up to offsets. The first piece of a file is what precedes its first version line.
    """
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = pieces.groupBy("file", "block").agg(F.sum("size").alias("bytes"))
    starts = blocks.select("file", "block", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("_start"))
    return pieces.join(starts, ["file", "block"]).withColumn("offset", F.col("_start") + F.col("place") - len(VERSION)).drop("_start")


def reachable(candidates: DataFrame) -> DataFrame:
    """(file, offset) of the candidates on the chain of successors from offset 0 of each file.

    ``candidates`` are (file, offset, next). Every round doubles the length of all pointers and
    adds what the known records point to, so a file of n records takes log2(n) rounds.
    """
    pointers = stage(candidates.select("file", "offset", "next"), "warc-pointers")
    heads = pointers.select("file", "offset")
    found = stage(pointers.where("offset = 0").select("file", "offset"), "warc-found")
    known = found.count()
    while True:
        step = found.join(pointers, ["file", "offset"]).select("file", F.col("next").alias("offset"))
        new = step.join(heads, ["file", "offset"], "left_semi")
        found = stage(found.unionByName(new).distinct(), "warc-found")
        now = found.count()
        if now == known:
            return found
        known = now
        further = pointers.select("file", F.col("offset").alias("next"), F.col("next").alias("_further"))
        doubled = pointers.join(further, ["file", "next"]).select("file", "offset", F.col("_further").alias("next"))
        pointers = stage(doubled, "warc-pointers")


def torn_payloads(spark: SparkSession, path: str, pieces: DataFrame, torn: DataFrame) -> DataFrame:
    """(file, offset, own_digest, own_length) of records whose payloads hold version lines.

    Only files with such records are read again. Each of their pieces belongs to the last record
    that begins at or before it; the pieces of a torn record, which are as large as its payload,
    meet in one group and are put together in order.
    """
    files = torn.select("file").distinct()
    starts = torn.select("file", "offset", F.col("offset").alias("owner"), F.col("next").alias("owner_next"))
    upto = Window.partitionBy("file").orderBy("offset").rowsBetween(Window.unboundedPreceding, 0)
    owned = (
        pieces.select("file", "block", "place", "offset")
        .join(files, "file", "left_semi")
        .join(starts, ["file", "offset"], "left")
        .withColumns({c: F.last(c, ignorenulls=True).over(upto) for c in ("owner", "owner_next")})
        .where("offset < owner_next")
        .select("file", "block", "place", "offset", "owner")
    )
    owned = stage(owned, "warc-torn")
    wanted = broadcast_if_small(owned, owned.count(), 160)
    placed = arrow_schema(PLACED_SCHEMA)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in located(batches):
            yield as_batch(batch, placed)

    values = map_batches(raw_pieces(spark, path).join(files, "file", "left_semi"), place, PLACED_SCHEMA)

    def put_together(table: pa.Table) -> pa.Table:
        whole = table.sort_by("offset")
        record = VERSION.encode().join(whole.column("value").to_pylist())
        header, length, fields = parse_piece(record)
        payload = payload_of(record[header : header + length], fields)
        row = (whole.column("file")[0].as_py(), whole.column("owner")[0].as_py(), digest_text(payload), len(payload))
        return pa.Table.from_batches([as_batch([row], arrow_schema(DIGESTS_SCHEMA))])

    return values.join(wanted, ["file", "block", "place"]).groupBy("file", "owner").applyInArrow(put_together, DIGESTS_SCHEMA)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the archives under ``path``: id, type, payload digest and length.

    Digest and length of a record with a payload are those of the bytes read back; a revisit
    has those that its headers state. Empty files give no rows; a file whose records do not
    follow each other from its first byte to its last is an error.
    """
    pieces = stage(with_offsets(scan_pieces(spark, path)), "warc-pieces")
    heads = pieces.where("jump is not null and offset >= 0").withColumn("next", F.col("offset") + F.col("jump"))
    records = stage(heads.join(reachable(heads), ["file", "offset"], "left_semi"), "warc-records")
    ends = pieces.groupBy("file").agg(F.max(F.col("offset") + F.col("size")).alias("bytes")).where("bytes > 0")
    reached = records.groupBy("file").agg(F.max("next").alias("end"))
    if broken := ends.join(reached, "file", "left").where("not (bytes <=> end)").head(3):
        told = "; ".join(f"{r['file']}: {r['bytes']} bytes, records up to {r['end'] or 0}" for r in broken)
        raise ValueError(f"WARC files whose records do not end with the file: {told}")
    torn = records.where("own_length is null")
    if not torn.isEmpty():
        whole = torn.drop("own_digest", "own_length").join(torn_payloads(spark, path, pieces, torn), ["file", "offset"], "left")
        records = records.where("own_length is not null").unionByName(whole)
    urn = rf"^<{PAGE_URN}(-?[0-9]+)>$"
    revisit = F.col("kind") == "revisit"

    def id_of(field: str) -> Column:
        return F.when(F.col(field).rlike(urn), F.regexp_extract(field, urn, 1).cast("bigint"))

    return records.select(
        id_of("record_id").alias("page_id"),
        F.when(revisit, F.col("length")).otherwise(F.col("own_length")).alias("payload_bytes"),
        F.when(revisit, F.regexp_replace("digest", "^sha1:", "")).otherwise(F.col("own_digest")).alias("payload_digest"),
        F.col("kind").alias("record_type"),
        id_of("refers_to").alias("refers_to"),
        "file",
        "offset",
    )


def round_trip(pages: DataFrame) -> DataFrame:
    """Write ``pages`` (page_id, url, html) as archives in the shared folder and read them back."""
    path = staged_path(pages.sparkSession, "warc")
    write_archives(classify(pages), path)
    return read_records(pages.sparkSession, path)
