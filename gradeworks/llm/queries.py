"""One registered query per operator, over its whole table, and the pipeline."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from gradeworks.llm import decontamination, packing, quality, recurrent_lm, token_counts, toxicity, vectors, warc
from gradeworks.llm.common import table
from gradeworks.llm.filter_audit import audit
from gradeworks.llm.near_duplicates import near_duplicates
from gradeworks.llm.periodic_runs import find_periodic_runs
from gradeworks.llm.secrets import find_secrets
from gradeworks.llm.sharding import shard_documents

LLM_QUERIES = {}
LLM_ORACLES: dict[str, str] = {}


def _register(function):
    LLM_QUERIES[function.__name__] = function
    return function


@_register
def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


@_register
def op2_warc_boundary_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages")).drop("file", "offset")


# base 32 of the 20 digest bytes: each digit is five bits of one of four runs of ten hex digits
LLM_ORACLES["op2_warc_boundary_chain"] = """
WITH p AS (
    SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS code,
           min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first_id
    FROM pages
)
SELECT page_id,
       CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(
           (CAST('0x' || substr(code, CAST(1 + 10 * (k // 8) AS INTEGER), 10) AS BIGINT) >> CAST(35 - 5 * (k % 8) AS INTEGER)) & 31
           AS INTEGER) + 1, 1)), '') AS payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM p
"""


@_register
def op3_bbit_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


LLM_ORACLES["op3_bbit_minhash"] = r"""
WITH RECURSIVE w AS (
    SELECT doc_id, list_filter(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
    FROM documents
),
s AS (
    SELECT doc_id, list_distinct(CASE
        WHEN len(words) = 0 THEN []
        WHEN len(words) = 1 THEN [words[1]]
        ELSE list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1]) END) AS shingles
    FROM w
),
c AS (SELECT shingles, min(doc_id) AS rep, len(shingles) AS n FROM (SELECT doc_id, list_sort(shingles) AS shingles FROM s) WHERE len(shingles) > 0 GROUP BY shingles),
e AS (SELECT rep, n, unnest(shingles) AS shingle FROM c),
links AS (
    SELECT a.rep AS a, b.rep AS b
    FROM e a JOIN e b ON a.shingle = b.shingle AND a.rep < b.rep AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
    GROUP BY a.rep, b.rep, a.n, b.n
    HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
),
sides AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT rep AS a, rep AS b FROM c UNION SELECT r.a, sides.b FROM reach r JOIN sides ON r.b = sides.a),
roots AS (SELECT a AS rep, min(b) AS component_id FROM reach GROUP BY a)
SELECT d.doc_id, CAST(len(d.shingles) AS BIGINT) AS n_shingles,
       coalesce(roots.component_id, d.doc_id) AS component_id,
       d.doc_id = coalesce(roots.component_id, d.doc_id) AS kept
FROM (SELECT doc_id, list_sort(shingles) AS shingles FROM s) d
LEFT JOIN c ON c.shingles = d.shingles
LEFT JOIN roots ON roots.rep = c.rep
"""


@_register
def op4_trie_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), token_counts.load_vocabulary())


@_register
def op5_template_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    leaks = decontamination.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return leaks.drop("text_hash")


@_register
def op6_vector_approximation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.nearest(table(spark, sf_dir, "embeddings"))


LLM_ORACLES["op6_vector_approximation"] = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
s AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id <> c.vec_id
    WHERE q.vec_id % 50 = 0
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
WHERE rank <= 5
"""


@_register
def op7_histogram_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"), n_shards=40)


@_register
def op8_compression_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score_documents(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


@_register
def op9_toxic_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score_documents(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


@_register
def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_secrets(table(spark, sf_dir, "documents"))


@_register
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_periodic_runs(table(spark, sf_dir, "documents"))


@_register
def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


LLM_ORACLES["op12_filter_audit"] = r"""
WITH words AS (
    SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
           list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
    FROM documents
),
facts AS (
    SELECT words.doc_id, part,
           len(w) < 200 AS a,
           100 * len(list_distinct(w)) < 50 * len(w) AS b,
           100 * (length(t) - length(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', ''))) > 2 * length(t) AS c,
           regexp_matches(t, '[#$%&*|]') AS d,
           coalesce(words.doc_id > min(words.doc_id) OVER (PARTITION BY t), false) AS e
    FROM words
),
known AS (SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic FROM labels GROUP BY doc_id),
cells AS (
    SELECT part, map {'A': a, 'B': b, 'C': c, 'D': d, 'E': e} AS fails,
           count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
    FROM facts LEFT JOIN known USING (doc_id) GROUP BY ALL
),
orders AS (
    SELECT v.x || w.x || x.x || y.x || z.x AS filter_order
    FROM (VALUES ('A'), ('B'), ('C'), ('D'), ('E')) v(x), (VALUES ('A'), ('B'), ('C'), ('D'), ('E')) w(x),
         (VALUES ('A'), ('B'), ('C'), ('D'), ('E')) x(x), (VALUES ('A'), ('B'), ('C'), ('D'), ('E')) y(x),
         (VALUES ('A'), ('B'), ('C'), ('D'), ('E')) z(x)
    WHERE len(list_distinct([v.x, w.x, x.x, y.x, z.x])) = 5
),
steps AS (
    SELECT filter_order, CAST(k AS INTEGER) AS step, filter_order[k] AS f, string_split(filter_order[1:k - 1], '') AS before
    FROM orders, range(1, 6) AS r(k)
),
told AS (
    SELECT *, fails[f] AS failing, len(list_filter(before, lambda x: x <> '' AND fails[x])) > 0 AS gone,
           len(list_filter(['A', 'B', 'C', 'D', 'E'], lambda x: fails[x])) AS n_fails
    FROM cells, steps
),
figures AS (
    SELECT part, filter_order, step, f,
           sum(CASE WHEN NOT gone AND NOT failing THEN n ELSE 0 END) AS kept,
           sum(CASE WHEN NOT gone AND failing THEN n ELSE 0 END) AS removed,
           sum(CASE WHEN gone AND failing THEN n ELSE 0 END) AS redundant,
           sum(CASE WHEN failing AND n_fails = 1 THEN n ELSE 0 END) AS unique_fails,
           sum(CASE WHEN NOT gone AND failing THEN good ELSE 0 END) AS good_lost,
           sum(CASE WHEN NOT gone AND failing THEN toxic ELSE 0 END) AS toxic_lost
    FROM told GROUP BY ALL
)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM figures
"""


@_register
def op13_gated_recurrent_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recurrent_lm.score_documents(table(spark, sf_dir, "documents"))


LLM_QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL is not None:
    LLM_ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
