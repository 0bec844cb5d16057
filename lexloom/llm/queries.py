"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import ann, bpe, chat, neardup, packing, pii, quality, suffix, toxicity, warc
from .common import documents

#: The key of the registered query; a deployment passes its own.
PII_KEY = "lexloom-demo-key"


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return toxicity.score(docs, toxicity.train(docs, documents(spark, sf_dir, "labels")))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.digests(documents(spark, sf_dir))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op4_quality_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(documents(spark, sf_dir))


def op5_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = documents(spark, sf_dir, "embeddings")
    return ann.search(vectors, vectors.where("vec_id % 50 = 0"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymise(documents(spark, sf_dir).select("doc_id", "text"), PII_KEY)


def op8_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(documents(spark, sf_dir), percent=85).select("doc_id", "n_shingles", "component_id", "kept")


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.chat(documents(spark, sf_dir, "conversations"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(documents(spark, sf_dir, "pages"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_toxicity, op2_suffix_dedup, op3_byte_bpe, op4_quality_bands, op5_ann, op6_packing, op7_pii, op8_neardup, op9_chat, op10_warc)
}

SQL = {
    "op9_chat": r"""
        WITH turns AS (
            SELECT DISTINCT conv_id, turn, coalesce(role, 'user') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
        ), said AS (
            SELECT conv_id,
                row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS n,
                sha256(role || chr(31) || text) AS h, '<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10) AS shown
            FROM turns
        ), prefixes AS (
            SELECT conv_id, n, string_agg(h, ',') OVER (PARTITION BY conv_id ORDER BY n ROWS UNBOUNDED PRECEDING) AS prefix,
                max(n) OVER (PARTITION BY conv_id) AS n_turns
            FROM said
        ), whole AS (
            SELECT prefix, min(conv_id) AS conv_id, count(*) AS n_equal, max(n_turns) AS n_turns FROM prefixes WHERE n = n_turns GROUP BY prefix
        )
        SELECT w.conv_id, w.n_turns, w.n_equal, r.rendered
        FROM whole w
        JOIN (SELECT conv_id, string_agg(shown, '' ORDER BY n) AS rendered FROM said GROUP BY conv_id) r USING (conv_id)
        WHERE w.prefix NOT IN (SELECT prefix FROM prefixes WHERE n < n_turns)
    """,
    "op8_neardup": r"""
        WITH RECURSIVE words AS (
            SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
            FROM documents
        ), shingles AS (
            SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                ELSE list_transform(generate_series(1, len(w) - 4), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s
            FROM words
        ), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
        ), links AS (
            SELECT p.a, p.b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL) p
            JOIN sizes u ON u.doc_id = p.a JOIN sizes v ON v.doc_id = p.b WHERE 100 * p.c >= 85 * (u.n + v.n - p.c)
        ), reach AS (
            SELECT doc_id AS a, doc_id AS b FROM words UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
        ), least AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
        SELECT d.doc_id, coalesce(z.n, 0) AS n_shingles, l.component_id, d.doc_id = l.component_id AS kept
        FROM documents d JOIN least l USING (doc_id) LEFT JOIN sizes z USING (doc_id)
    """,
    "op10_warc": """
        WITH p AS (
            SELECT page_id, coalesce(strlen(html), 0) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
        ), stored AS (
            SELECT payload_digest, max(page_id) AS kept FROM p WHERE payload_bytes >= 1000 GROUP BY payload_digest
        )
        SELECT p.page_id, p.payload_bytes, p.payload_digest,
            CASE WHEN p.page_id < s.kept THEN 'revisit' ELSE 'response' END AS record_type,
            CASE WHEN p.page_id < s.kept THEN s.kept END AS refers_to
        FROM p LEFT JOIN stored s USING (payload_digest)
    """,
}
