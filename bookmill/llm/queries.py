"""The queries op1_.. to op10_..: each applies its operator, with production parameters, to a whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import bpe, fingerprints, jaccard_join, language_id, lm_scoring, packing, quality, topk, url_filter, warc

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.tiktoken")


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score_held_out(_read(spark, sf_dir, "documents"))


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_edits(_read(spark, sf_dir, "documents"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(_read(spark, sf_dir, "documents"))


def op4_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(_read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.link(_read(spark, sf_dir, "documents"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(_read(spark, sf_dir, "pages"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_read(spark, sf_dir, "documents"), WORD_BPE)


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = warc.write_archives(_read(spark, sf_dir, "pages"))
    return warc.read_archives(spark, manifest, payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = bpe.encode(_read(spark, sf_dir, "documents"), BYTE_BPE, public_tokenizers.PATTERN)
    return bpe.decode(ids, BYTE_BPE).select(
        "doc_id", F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


_ALL = (
    op1_lm_scoring, op2_fingerprints, op3_language_id, op4_topk, op5_jaccard_join, op6_url_filter, op7_packing,
    op8_quality, op9_warc, op10_byte_bpe
)
QUERIES = {f.__name__: f for f in _ALL}
#: SQL of the operators that it can express. The others: op1 and op3 split documents by crc32, which DuckDB lacks, op3, op6 and
#: op8 learn models, op2 hashes shingles into bins, op7 and op10 tokenise; tests/llm holds them against brute-force versions.
ORACLES: dict[str, str] = {
    "op4_topk": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND list_count(embedding) = len(embedding)
              AND list_count(list_filter(embedding, lambda x: isfinite(CAST(x AS DOUBLE)))) = len(embedding)
        ), scored AS (
            SELECT q.vec_id AS query_id, v.vec_id, CAST(list_inner_product(q.e, v.e) AS BIGINT) AS score
            FROM v AS q JOIN v ON v.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0
        ), ranked AS (
            SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM scored
        )
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5""",
    "op5_jaccard_join": """
        WITH RECURSIVE words AS (
            SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS ws
            FROM documents
        ), placed AS (
            SELECT doc_id, len(ws) AS m, unnest(ws) AS w, generate_subscripts(ws, 1) AS pos FROM words
        ), runs AS (
            SELECT doc_id, m, pos, w || ' ' || lead(w, 1, '') OVER d || ' ' || lead(w, 2, '') OVER d || ' ' || lead(w, 3, '') OVER d || ' ' || lead(w, 4, '') OVER d AS s
            FROM placed WINDOW d AS (PARTITION BY doc_id ORDER BY pos)
        ), shingles AS (
            SELECT DISTINCT doc_id, s FROM runs WHERE pos <= m - 4 OR (m < 5 AND pos = 1)
        ), sizes AS (
            SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
        ), met AS (
            SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id
        ), links AS (
            SELECT a, b FROM met JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)
        ), edges AS (
            SELECT a, b FROM links UNION SELECT b, a FROM links
        ), reach(doc_id, other) AS (
            SELECT doc_id, doc_id FROM documents
            UNION
            SELECT reach.doc_id, edges.b FROM reach JOIN edges ON edges.a = reach.other
        )
        SELECT documents.doc_id, coalesce(n, 0) AS n_shingles, component_id
        FROM documents LEFT JOIN sizes USING (doc_id) JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) USING (doc_id)""",
    "op9_warc": """
        WITH p AS (
            SELECT page_id, coalesce(html, '') AS body FROM pages
        ), d AS (
            SELECT page_id, CAST(strlen(body) AS BIGINT) AS payload_bytes, sha1(body) AS payload_digest, max(page_id) OVER (PARTITION BY body) AS last FROM p
        )
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN payload_bytes >= 1000 AND page_id < last THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 1000 AND page_id < last THEN last END AS refers_to
        FROM d""",
}
