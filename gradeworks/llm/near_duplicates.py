"""Near-duplicate documents by b-bit MinHash.

A document is the set of its distinct word shingles. Documents with equal sets are one class.
Bands of full minima put classes into buckets; of the minima only the low bits are kept, packed,
to estimate the similarity of candidates from the number of equal bits, corrected for chance.
Candidates whose estimate could belong to a link are compared on their full sets.

A bucket never becomes all its pairs. Its members are first compared with its smallest one, and
the links merge most of them. What remains are buckets whose members lie in several components;
there, only members outside the largest one are compared with the others, in blocks of bounded
size, inside tasks that send back no more links than members.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradeworks.llm.common import arrow_schema, as_batch, free_names, map_batches, split_heavy_join
from gradeworks.llm.components import connected_components
from gradeworks.session import broadcast_if_small, stage

SETS_SCHEMA = "doc_id bigint, node bigint, n_shingles bigint, signature array<bigint>, bands array<int>, text_hash bigint"
PAIRS_SCHEMA = "a bigint, b bigint"
MAX_KNOWN_WORDS = 150_000
BASE = np.uint64(0x9E3779B97F4A7C15)
EVEN_BITS = 0x5555555555555555
PER_LONG = 32


@dataclass(frozen=True)
class NearDuplicateOptions:
    """Sets of ``width``-word shingles are linked at ``percent`` of Jaccard similarity or more.

    At similarity s, ``bands`` of ``rows`` minima miss a link with probability
    (1 - s**rows)**bands: 3e-6 at 0.8. Two low bits of each minimum are kept. Estimates more
    than ``deviations`` standard deviations below the limit are not compared. A task of the
    comparison within buckets holds about ``block_rows`` sets or ``block_bytes`` of each side.
    """

    width: int = 2
    percent: int = 80
    bands: int = 32
    rows: int = 5
    deviations: float = 5.0
    block_rows: int = 4096
    block_bytes: int = 8 * 1024 * 1024
    seed: int = 1

    @property
    def minima(self) -> int:
        return self.bands * self.rows

    @property
    def most_differing(self) -> int:
        """Most differing bit pairs that a link may show."""
        s = self.percent / 100
        same = 0.25 + 0.75 * s
        deviation = (same * (1 - same) / self.minima) ** 0.5
        return int(self.minima * min(1.0, 1 - same + self.deviations * deviation))


class ShingleReader:
    """Hashes of the distinct shingles of texts, in order; words are hashed once and kept in bounded memory."""

    def __init__(self, width: int):
        self.width = width
        self.known: dict[bytes, int] = {}

    def read(self, text: str | None) -> np.ndarray:
        # only A-Z are lowered and only the six ASCII white spaces part words
        words = (text or "").encode("utf-8", "replace").lower().split()
        known = self.known
        if len(known) > MAX_KNOWN_WORDS:
            known.clear()
        for w in words:
            if w not in known:
                known[w] = xxhash.xxh3_64_intdigest(w)
        hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        width = min(self.width, len(words))
        if not width:
            return hashes
        n = len(words) - width + 1
        out = np.full(n, width, np.uint64)
        for j in range(width):
            out = out * BASE + hashes[j : j + n]
        out ^= out >> np.uint64(32)
        out *= np.uint64(0xD6E8FEB86659FD93)
        out ^= out >> np.uint64(29)
        return np.unique(out)


def set_hash(shingles: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(shingles.tobytes()) - (1 << 63)


class MinHasher:
    """Minima of a set under ``minima`` permutations of 32-bit numbers: an exclusive or, then an odd factor."""

    def __init__(self, options: NearDuplicateOptions):
        rng = np.random.default_rng(options.seed)
        self.options = options
        self.masks = rng.integers(0, 1 << 32, options.minima, dtype=np.uint32)
        self.factors = rng.integers(0, 1 << 32, options.minima, dtype=np.uint32) | np.uint32(1)

    def minima(self, shingles: np.ndarray) -> np.ndarray:
        x = (shingles ^ (shingles >> np.uint64(32))).astype(np.uint32)
        out = np.full(self.options.minima, 0xFFFFFFFF, np.uint32)
        for i in range(0, len(x), 512):
            part = (x[i : i + 512, None] ^ self.masks) * self.factors
            np.minimum(out, part.min(axis=0), out=out)
        return out

    def bands(self, minima: np.ndarray) -> np.ndarray:
        o = self.options
        parts = minima.reshape(o.bands, o.rows).astype(np.uint64)
        out = np.arange(1, o.bands + 1, dtype=np.uint64)
        for j in range(o.rows):
            out = (out + parts[:, j]) * BASE
            out ^= out >> np.uint64(31)
        # half of the bits will do beside the band's number: the few that meet by chance are compared as all others
        return (out >> np.uint64(32)).astype(np.uint32).view(np.int32)

    def signature(self, minima: np.ndarray) -> np.ndarray:
        low = (minima & np.uint32(3)).astype(np.uint64)
        low = np.pad(low, (0, -len(low) % PER_LONG)).reshape(-1, PER_LONG)
        return np.bitwise_or.reduce(low << (2 * np.arange(PER_LONG, dtype=np.uint64)), axis=1).view(np.int64)


def describe_sets(docs: DataFrame, options: NearDuplicateOptions) -> DataFrame:
    """Set size, set hash, packed signature and band keys per row; an empty set has no hash."""
    schema = arrow_schema(SETS_SCHEMA)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, hasher = ShingleReader(options.width), MinHasher(options)
        for batch in batches:
            for part in (batch.slice(i, 500) for i in range(0, batch.num_rows, 500)):
                out = []
                for doc_id, text, text_hash in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    shingles = reader.read(text)
                    if not len(shingles):
                        out.append((doc_id, None, 0, None, None, text_hash))
                        continue
                    minima = hasher.minima(shingles)
                    out.append((doc_id, set_hash(shingles), len(shingles), hasher.signature(minima), hasher.bands(minima), text_hash))
                yield as_batch(out, schema)

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.xxhash64("text").alias("text_hash"))
    return map_batches(rows, work, SETS_SCHEMA)


def differing(a: Column, b: Column) -> Column:
    """Number of differing bit pairs of two packed signatures."""
    x = F.zip_with(a, b, lambda p, q: p.bitwiseXOR(q))
    pairs = F.transform(x, lambda v: F.bit_count(v.bitwiseOR(F.shiftrightunsigned(v, 1)).bitwiseAND(F.lit(EVEN_BITS))))
    return F.aggregate(pairs, F.lit(0), lambda total, n: total + n)


def texts_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, text) of one document per wanted class (node, rep, rep_hash); ids may repeat with other texts."""
    small = broadcast_if_small(wanted, wanted.count(), 24)
    texts = docs.select(F.col("doc_id").cast("bigint").alias("rep"), F.xxhash64("text").alias("rep_hash"), "text")
    return texts.join(small, ["rep", "rep_hash"]).select("node", "text")


def is_link(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def confirmed(pairs: DataFrame, texts: DataFrame, options: NearDuplicateOptions) -> DataFrame:
    """The ``pairs`` (a, b) whose full sets are similar enough. Texts are set apart by their hash."""
    partners = stage(pairs.groupBy("b").agg(F.count(F.lit(1)).alias("n")), "partners")
    ours = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
    theirs = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")).join(partners, "b")
    both = split_heavy_join(ours, theirs, ["b"], "inner", 8192).select("a", "b", "text_a", "text_b")
    schema = arrow_schema(PAIRS_SCHEMA)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = ShingleReader(options.width)
        for batch in batches:
            out, sets = [], {}
            for a, b, text_a, text_b in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                one = reader.read(text_a)
                if b not in sets:
                    if len(sets) > 64:
                        sets.clear()
                    sets[b] = reader.read(text_b)
                # rows of another text under the same id are not the class that was asked for
                if set_hash(one) == a and set_hash(sets[b]) == b and is_link(one, sets[b], options.percent):
                    out.append((a, b))
            yield as_batch(out, schema)

    return map_batches(both, work, PAIRS_SCHEMA)


def near_duplicates(docs: DataFrame, options: NearDuplicateOptions = NearDuplicateOptions()) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) per row of ``docs`` (doc_id, text).

    ``component_id`` is the smallest id that links reach. Rows without words are linked with
    nothing; rows without an id too, have no component and are kept. Repeated rows repeat
    their result. Other columns are left out.
    """
    return grouped(docs, options).drop("text_hash")


def grouped(docs: DataFrame, options: NearDuplicateOptions) -> DataFrame:
    """The rows of ``near_duplicates`` with the hash of their text, which tells rows of one id apart."""
    rows = stage(describe_sets(docs, options), "sets")
    classes = stage(
        rows.where("node is not null and doc_id is not null")
        .groupBy("node")
        .agg(
            F.min(F.struct(F.col("doc_id").alias("rep"), F.col("text_hash").alias("rep_hash"))).alias("own"),
            F.count(F.lit(1)).alias("n"),
            F.first("n_shingles").alias("n_shingles"),
            F.first("signature").alias("signature"),
            F.first("bands").alias("bands"),
        )
        .select("node", "own.*", "n", "n_shingles", "signature", "bands"),
        "classes",
    )
    members = classes.select("node", F.posexplode("bands").alias("band", "hash"))
    members = members.select("node", F.shiftleft(F.col("band").cast("bigint"), 32).bitwiseOR(F.col("hash").cast("bigint").bitwiseAND(F.lit(0xFFFFFFFF))).alias("key"))
    shared = members.groupBy("key").agg(F.min("node").alias("pivot"), F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = stage(shared, "buckets")
    buckets = stage(split_heavy_join(members, shared, ["key"], "inner", 24).select("key", "node", "pivot"), "members")

    stars = stage(buckets.where("node <> pivot").select(F.col("node").alias("a"), F.col("pivot").alias("b")).distinct(), "stars")
    candidates = stage(estimated(stars, classes, options), "candidates")
    links = stage(confirmed(candidates, node_texts(docs, classes, candidates.select("a").union(candidates.select("b"))), options), "links")
    roots = connected_components(settle_buckets(docs, classes, buckets, links, options))

    named = classes.join(roots, "node", "left").select("node", "rep", "n", F.coalesce("root", "node").alias("root"))
    smallest = named.groupBy("root").agg(F.min("rep").alias("component_id"))
    ids = named.join(smallest, "root")
    ids = stage(ids.select("node", "component_id", "n"), "component-ids")
    with_id = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    out = split_heavy_join(rows.select("doc_id", "node", "n_shingles", "text_hash"), ids, ["node"], "left", 24)
    return out.select("doc_id", "n_shingles", with_id.alias("component_id"), "text_hash").withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    )


def estimated(pairs: DataFrame, classes: DataFrame, options: NearDuplicateOptions) -> DataFrame:
    """Pairs (a, b) whose sizes and packed signatures allow a link."""
    sides = classes.select("node", "signature", "n_shingles")
    partners = stage(pairs.groupBy(F.col("b").alias("node")).agg(F.count(F.lit(1)).alias("n")), "partners")
    theirs = sides.join(partners, "node").select(
        F.col("node").alias("b"), F.col("signature").alias("s_b"), F.col("n_shingles").alias("n_b"), "n"
    )
    ours = pairs.join(sides.select(F.col("node").alias("a"), F.col("signature").alias("s_a"), F.col("n_shingles").alias("n_a")), "a")
    both = split_heavy_join(ours, stage(theirs, "partner-sides"), ["b"], "inner", 80)
    close = F.lit(100) * F.least("n_a", "n_b") >= F.lit(options.percent) * F.greatest("n_a", "n_b")
    return both.where(close & (differing(F.col("s_a"), F.col("s_b")) <= options.most_differing)).select("a", "b")


def node_texts(docs: DataFrame, classes: DataFrame, nodes: DataFrame) -> DataFrame:
    wanted = stage(nodes.toDF("node").distinct().join(classes.select("node", "rep", "rep_hash"), "node"), "wanted")
    return stage(texts_of(docs, wanted), "wanted-texts")


def settle_buckets(docs: DataFrame, classes: DataFrame, buckets: DataFrame, links: DataFrame, options: NearDuplicateOptions) -> DataFrame:
    """``links`` and those that comparing members with the smallest of their bucket has not shown.

    First each member outside its bucket's largest component is compared in one bucket only, its
    largest. That merges most of them, so that little is left to compare in all other buckets.
    """
    done = None
    for rest in (False, True):
        members, shapes = open_buckets(classes, buckets, connected_components(links), options, done)
        if not rest:
            shaped = split_heavy_join(members, shapes.withColumn("size", F.col("n")), ["key"], "inner", 64).where("root <> largest")
            first = shaped.groupBy("node").agg(F.max_by("key", F.struct("size", "key")).alias("key")).select("key").distinct()
            shapes = stage(shapes.join(first, "key", "left_semi"), "first-shapes")
            done = shapes.select("n", "s")
        links = links.unionByName(compare_members(docs, classes, members, shapes, options))
    return links


def open_buckets(
    classes: DataFrame, buckets: DataFrame, roots: DataFrame, options: NearDuplicateOptions, done: DataFrame | None
) -> tuple[DataFrame, DataFrame]:
    """Members of buckets whose other members lie in several components, and the buckets' shapes.

    ``s`` is a hash of the whole bucket: the same members often meet in several buckets, and one
    of these stands for all; those in ``done`` (n, s) are left out. A shape has the largest
    component and the numbers of blocks and of chunks of members outside that component.
    """
    placed = buckets.join(roots, "node", "left").select("key", "node", "pivot", F.coalesce("root", "node").alias("root"))
    others = placed.where("node <> pivot").groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"))
    opened = others.where("low <> high").select("key")
    hashed = F.sum(F.xxhash64("node").cast("decimal(38,0)"))
    same = buckets.join(opened, "key", "left_semi").groupBy("key").agg(F.count(F.lit(1)).alias("n"), hashed.alias("s"))
    if done is not None:
        same = same.join(done, ["n", "s"], "left_anti")
    chosen = stage(same.groupBy("n", "s").agg(F.min("key").alias("key")), "open-buckets")
    marked = split_heavy_join(placed, chosen.select("key", "n"), ["key"], "inner", 16).select("key", "node", "root")
    members = stage(marked.join(classes.select("node", "n_shingles", "signature"), "node"), "open-members")

    parts = members.groupBy("key", "root").agg(F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("w"))
    order = F.struct("n", "root")
    total = parts.groupBy("key").agg(
        F.max_by("root", order).alias("largest"), F.sum("n").alias("m"), F.sum("w").alias("w"),
        (F.sum("n") - F.max("n")).alias("guests"), (F.sum("w") - F.max_by("w", order)).alias("guest_w"),
    )

    def number(rows: str, shingles: str) -> Column:
        by_rows, by_bytes = F.col(rows) / options.block_rows, F.col(shingles) * 8 / options.block_bytes
        return F.greatest(F.ceil(by_rows), F.ceil(by_bytes), F.lit(1)).cast("int")

    shapes = total.join(chosen, "key").select("key", "largest", "n", "s", number("m", "w").alias("blocks"), number("guests", "guest_w").alias("chunks"))
    return members, stage(shapes, "open-shapes")


def compare_members(
    docs: DataFrame, classes: DataFrame, members: DataFrame, shapes: DataFrame, options: NearDuplicateOptions
) -> DataFrame:
    """Links between members of one bucket and those of them that are outside its largest component."""
    shaped = split_heavy_join(members, shapes.drop("s"), ["key"], "inner", 48)

    def spread(count: str) -> Column:
        return F.pmod(F.xxhash64(F.lit(count), "node"), F.col(count)).cast("int")

    def every(count: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(count) - 1))

    columns = ["key", "node", "root", "signature"]
    hosts = shaped.select(*columns, spread("blocks").alias("block"), every("chunks").alias("chunk"), F.lit(False).alias("guest"))
    guests = shaped.where("root <> largest").select(*columns, every("blocks").alias("block"), spread("chunks").alias("chunk"), F.lit(True).alias("guest"))
    cell = ["key", "block", "chunk"]
    flagged = stage(
        hosts.unionByName(guests.select(hosts.columns)).groupBy(*cell).applyInArrow(possible_members(options), FLAGGED_SCHEMA), "possible"
    )
    texts = one_text_each(node_texts(docs, classes, flagged.select("node")), options)
    # texts are shorter than their sets, and compress
    return stage(flagged.join(texts, "node").groupBy(*cell).applyInArrow(joining_links(options), PAIRS_SCHEMA), "more-links")


FLAGGED_SCHEMA = "key bigint, block int, chunk int, node bigint, root bigint, guest boolean, signature array<bigint>"


def possible_members(options: NearDuplicateOptions):
    """Of the hosts and guests of one block, those with a possible partner in another component."""
    schema = arrow_schema(FLAGGED_SCHEMA)

    def work(table: pa.Table) -> pa.Table:
        guest = np.array(table.column("guest").to_pylist(), bool)
        roots = table.column("root").to_numpy()
        signatures = packed(table.column("signature"))
        flags = np.zeros(len(guest), bool)
        hosts = np.nonzero(~guest)[0]
        for i in np.nonzero(guest)[0]:
            near = hosts[possible(signatures, roots, i, hosts, options)]
            if len(near):
                flags[i] = True
                flags[near] = True
        kept = table.filter(pa.array(flags)).select(["key", "block", "chunk", "node", "root", "guest", "signature"])
        return kept.cast(schema) if kept.num_rows else schema.empty_table()

    return work


def packed(column: pa.ChunkedArray) -> np.ndarray:
    return np.array(column.to_pylist(), np.int64).view(np.uint64)


def possible(signatures: np.ndarray, roots: np.ndarray, i: int, others: np.ndarray, options: NearDuplicateOptions) -> np.ndarray:
    x = signatures[others] ^ signatures[i]
    count = np.bitwise_count((x | (x >> np.uint64(1))) & np.uint64(EVEN_BITS)).sum(axis=1)
    return (count <= options.most_differing) & (roots[others] != roots[i])


def joining_links(options: NearDuplicateOptions):
    """Links between components among the hosts and guests of one block, on full sets; a chain per component."""
    schema = arrow_schema(PAIRS_SCHEMA)

    def work(table: pa.Table) -> pa.Table:
        guest = np.array(table.column("guest").to_pylist(), bool)
        nodes, roots = table.column("node").to_pylist(), table.column("root").to_numpy().copy()
        signatures = packed(table.column("signature"))
        reader = ShingleReader(options.width)
        sets = [reader.read(t.as_py()) for chunk in table.column("text").chunks for t in chunk]
        hosts = np.nonzero(~guest)[0]
        out = []
        if len(hosts):
            sizes = np.array([len(sets[h]) for h in hosts])
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            everything = np.concatenate([sets[h] for h in hosts])
            for i in np.nonzero(guest)[0]:
                near = possible(signatures, roots, i, hosts, options)
                if not near.any():
                    continue
                own = sets[i]
                at = np.minimum(np.searchsorted(own, everything), len(own) - 1)
                both = np.add.reduceat((own[at] == everything).astype(np.int64), starts)
                linked = near & (100 * both >= options.percent * (sizes + len(own) - both))
                for root in np.unique(roots[hosts[linked]]):
                    partner = hosts[linked & (roots[hosts] == root)][0]
                    out.append((nodes[i], nodes[partner]))
                    roots[roots == root] = roots[i]
        return pa.Table.from_batches([as_batch(out, schema)], schema=schema)

    return work


def one_text_each(texts: DataFrame, options: NearDuplicateOptions) -> DataFrame:
    """(node, text): one text of each class that was asked for."""
    ddl = "node bigint, text string"
    schema = arrow_schema(ddl)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = ShingleReader(options.width)
        for batch in batches:
            rows = zip(*(c.to_pylist() for c in batch.columns), strict=True)
            yield as_batch(((n, t) for n, t in rows if set_hash(reader.read(t)) == n), schema)

    # ids that repeat with one text repeat it, too
    return stage(map_batches(texts.select("node", "text"), work, ddl).dropDuplicates(["node"]), "wanted-sets")


def keep_one_per_group(docs: DataFrame, options: NearDuplicateOptions) -> DataFrame:
    """Rows of ``docs`` that stand for their group, all columns kept; of repeated rows one stays.

    Rows go by id and text, so another text under the same id stays. Null and empty texts are
    near copies of nothing; of several under one id one stays.
    """
    id_, hash_ = free_names(docs, "group_id", "group_hash")
    own = (docs["doc_id"].cast("bigint"), F.xxhash64(docs["text"]))
    is_named = own[0].eqNullSafe(F.col(id_)) & (own[1] == F.col(hash_))
    found = grouped(docs, options).where("not kept")
    dropped = stage(found.select(F.col("doc_id").alias(id_), F.col("text_hash").alias(hash_)).distinct(), "dropped")
    left = docs.join(broadcast_if_small(dropped, dropped.count(), 16), is_named, "left_anti")
    # rows that repeat id and text are few or none; only they are shuffled
    same = [own[0].alias(id_), own[1].alias(hash_)]
    again = stage(left.groupBy(*same).agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"), "repeated")
    if again.isEmpty():
        return left
    again = broadcast_if_small(again, again.count(), 16)
    one_each = left.join(again, is_named, "left_semi").withColumn(hash_, own[1]).dropDuplicates(["doc_id", hash_])
    return left.join(again, is_named, "left_anti").unionByName(one_each.drop(hash_))
