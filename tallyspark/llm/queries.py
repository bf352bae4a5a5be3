"""Registered queries of the training-data operators and, where SQL can express them, their DuckDB text."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tallyspark.llm import (
    bpe,
    decontaminate,
    exact_dedup,
    extract,
    negatives,
    neighbours,
    pii,
    runs,
    secrets,
    sharding,
    simhash,
    toxicity,
    warc,
)
from tallyspark.llm.common import read

RANKS = "byte_bpe_50k.tiktoken"

Query = Callable[[SparkSession, str], DataFrame]


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.report(read(spark, sf_dir, "documents"))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(read(spark, sf_dir, "documents"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.report(read(spark, sf_dir, "pages"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, sf_dir, "documents"))


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(read(spark, sf_dir, "documents"))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.report(read(spark, sf_dir, "documents"), public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


def op8_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.report(read(spark, sf_dir, "embeddings"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.report(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op10_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.report(read(spark, sf_dir, "pages"))


def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.report(read(spark, sf_dir, "documents"))


def op12_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.report(read(spark, sf_dir, "embeddings"))


def op13_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.report(read(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_decontaminate": op1_decontaminate,
    "op2_sharding": op2_sharding,
    "op3_pii": op3_pii,
    "op4_warc": op4_warc,
    "op5_simhash": op5_simhash,
    "op6_secrets": op6_secrets,
    "op7_bpe": op7_bpe,
    "op8_neighbours": op8_neighbours,
    "op9_toxicity": op9_toxicity,
    "op10_extract": op10_extract,
    "op11_exact_dedup": op11_exact_dedup,
    "op12_negatives": op12_negatives,
    "op13_runs": op13_runs,
}

ORACLE_SQL: dict[str, str] = {
    "op1_decontaminate": r"""
WITH d AS (
    SELECT doc_id, list_filter(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
    FROM documents
), b AS (
    SELECT item_id, list_filter(regexp_split_to_array(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
    FROM benchmark WHERE text IS NOT NULL
), places AS (
    SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0
), wins AS (
    SELECT DISTINCT item_id, array_to_string(list_slice(w, i, i + 9), ' ') AS win, least(len(w), 10) AS l FROM places
), lengths AS (
    SELECT DISTINCT l FROM wins
), spots AS (
    SELECT doc_id, w, l, unnest(range(1, len(w) - l + 2)) AS i FROM d, lengths WHERE len(w) >= l
), found AS (
    SELECT s.doc_id, s.i, s.l, x.item_id
    FROM (SELECT doc_id, i, l, array_to_string(list_slice(w, i, i + l - 1), ' ') AS win FROM spots) s
    JOIN wins x ON x.win = s.win
), hit AS (
    SELECT doc_id, count(DISTINCT p) AS n_hit
    FROM (SELECT doc_id, unnest(range(i, i + l)) AS p FROM (SELECT DISTINCT doc_id, i, l FROM found)) GROUP BY doc_id
), items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(listed, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
""",
    "op11_exact_dedup": r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       row_number() OVER (PARTITION BY t ORDER BY doc_id) = 1 AS kept, sha256(t) AS text_sha256
FROM d
""",
    "op12_negatives": r"""
WITH e AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND list_count(embedding) = len(embedding)
      AND len(list_filter(embedding, lambda x: NOT isfinite(x))) = 0
), pairs AS (
    SELECT a.vec_id AS anchor_id, a.label AS own, b.vec_id, b.label,
           CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
    FROM e a JOIN e b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
), positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM pairs WHERE label = own
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM pairs JOIN positives USING (anchor_id)
WHERE label <> own AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) <= 10
""",
}
