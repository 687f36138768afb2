"""The queries of this subpackage, over whole tables with production parameters, and their SQL where SQL can say them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from platelake.llm.byte_bpe import encode_decode
from platelake.llm.chat_format import format_chats
from platelake.llm.exact_dedup import exact_dedup
from platelake.llm.license_scan import scan_licenses
from platelake.llm.maxscore import top_k
from platelake.llm.mixing import mix_sources
from platelake.llm.shared import fresh_path, table
from platelake.llm.simhash import simhash_components
from platelake.llm.substring_dedup import remove_repeats
from platelake.llm.toxicity import score_toxicity, train_model
from platelake.llm.token_store import byte_bpe_encoder, read_tokens, write_tokens


def op1_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "tokens")
    encoder = byte_bpe_encoder(public_tokenizers.path("byte_bpe_50k.json"))
    write_tokens(table(spark, sf_dir, "documents"), path, encoder, vocabulary=50_257, end_id=0)
    return read_tokens(spark, path)


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score_toxicity(docs, train_model(docs, table(spark, sf_dir, "labels")))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_decode(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


def op6_maxscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return top_k(vectors, vectors.filter("vec_id % 100 = 0"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(table(spark, sf_dir, "documents"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents"))


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_chats(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_store": op1_token_store,
    "op2_license_scan": op2_license_scan,
    "op3_toxicity": op3_toxicity,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_byte_bpe": op5_byte_bpe,
    "op6_maxscore": op6_maxscore,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_simhash": op8_simhash,
    "op9_mixing": op9_mixing,
    "op10_chat_format": op10_chat_format,
}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES: dict[str, str] = {
    "op6_maxscore": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        pairs AS (
            SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_sum(list_transform(range(1, least(len(q.x), len(c.x)) + 1), lambda i: q.x[i] * c.x[i])) AS BIGINT) AS score
            FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id)
        SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
        FROM pairs QUALIFY rank <= 10""",
    "op7_exact_dedup": f"""
        WITH norm AS (SELECT doc_id, {_LOWER} AS t FROM documents)
        SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               doc_id = max(doc_id) OVER g AS kept, sha256(t) AS text_sha256
        FROM norm WINDOW g AS (PARTITION BY t)""",
    # Golden-ratio slots choose sources, in tiers of block lengths; the n-th slot of a source takes its n-th block.
    "op9_mixing": r"""
        WITH sized AS (
            SELECT doc_id, source, md5(CAST(doc_id AS VARCHAR)) AS o,
                   CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents),
        sums AS (SELECT source, CAST(sum(size) AS BIGINT) AS s FROM sized GROUP BY source),
        weighed AS (SELECT source, s, CAST([5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS BIGINT) AS w FROM sums),
        levels AS (
            SELECT source, s, w, CAST(sum(s) OVER () - coalesce(sum(3 * s) OVER f, 0) AS DOUBLE) / CAST(sum(w) OVER () - coalesce(sum(w) OVER f, 0) AS DOUBLE) AS level
            FROM weighed WINDOW f AS (ORDER BY 3 * s / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
        targets AS (SELECT source, s, least(CAST(3 * s AS DOUBLE), max(level) OVER () * w) AS target FROM levels),
        tiered AS (SELECT *, CAST(CASE WHEN target >= 1024 * 512 THEN 1024 WHEN target >= 64 * 512 THEN 64 WHEN target >= 4 * 512 THEN 4 ELSE 1 END AS BIGINT) AS b FROM targets),
        spans AS (
            SELECT source, b, coalesce(sum(target) OVER (t ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) / sum(target) OVER (PARTITION BY b) AS lo,
                   CASE WHEN lead(b) OVER t IS NULL THEN 2.0 ELSE sum(target) OVER (t ROWS UNBOUNDED PRECEDING) / sum(target) OVER (PARTITION BY b) END AS hi
            FROM tiered WHERE target > 0 WINDOW t AS (PARTITION BY b ORDER BY source NULLS FIRST)),
        slots AS (
            SELECT b, (i * 0.6180339887498949::DOUBLE) % 1.0::DOUBLE AS u
            FROM (SELECT b, unnest(range(CAST(ceil(sum(target) / b - 0.5) AS BIGINT))) AS i FROM tiered GROUP BY b)),
        got AS (SELECT source, count(*) AS got FROM spans JOIN slots ON spans.b = slots.b AND u >= lo AND u < hi GROUP BY source),
        drawn AS (
            SELECT t.source, s, target, b, (s + b - 1) // b AS per, least(coalesce(got, 0), 3 * ((s + b - 1) // b)) AS n
            FROM tiered t LEFT JOIN got ON t.source IS NOT DISTINCT FROM got.source),
        streams AS (
            SELECT doc_id, source, size, CAST(sum(size) OVER (PARTITION BY source ORDER BY o NULLS LAST, size ROWS UNBOUNDED PRECEDING) AS BIGINT) - size AS a FROM sized)
        SELECT doc_id, size, t.s AS source_size, t.target AS target,
               CAST(CASE WHEN size = 0 THEN 0 ELSE n // per * size + greatest(0, least(a + size, n % per * b) - a) END AS BIGINT) AS taken
        FROM streams d JOIN drawn t ON d.source IS NOT DISTINCT FROM t.source""",
}
