"""The operators of this subpackage over their whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata.llm import (
    exact_dedup,
    jaccard,
    language,
    merge_replay,
    mixing,
    near_vectors,
    prefix_trie,
    quality,
    ring_shards,
    secret_scan,
    token_shards,
    token_spans,
    toxicity,
)
from lakestrata.llm.samples import id_remainder, is_remainder
from lakestrata.llm.shipping import ship

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

TOKENIZER_FILE = public_tokenizers.path("byte_bpe_50k.json")
RANK_FILE = public_tokenizers.path("byte_bpe_50k.tiktoken")
PIECE_FILE = public_tokenizers.path("piece_bpe_32k.model")


def query(run: Callable[[SparkSession, str], DataFrame]) -> Callable:
    @wraps(run)
    def with_code(spark: SparkSession, sf_dir: str) -> DataFrame:
        return run(ship(spark), sf_dir)

    QUERIES[run.__name__] = with_code
    return with_code


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(scored: DataFrame, modulus: int, value: int) -> DataFrame:
    first, *rest = scored.columns
    return scored.select(first, is_remainder("doc_id", modulus, value).alias("held_out"), *rest)


@query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline  # its stages import this subpackage

    return corpus_pipeline.run(spark, sf_dir)


@query
def op1_toxicity_gru(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").where(id_remainder("doc_id", 5) != 0)
    model = toxicity.fit(docs, labels, "toxic")
    return held_out(toxicity.score_toxicity(docs, model, 0.5), 5, 0)


@query
def op2_quality_subwords(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").where(id_remainder("doc_id", 5) != 0)
    model = quality.fit(docs, labels, "quality")
    return held_out(quality.score_quality(docs, model, 0.3), 5, 0)


@query
def op3_bpe_merge_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge_replay.token_digests(
        table(spark, sf_dir, "documents"), RANK_FILE, public_tokenizers.PATTERN
    )


@query
def op4_mix_by_raking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


@query
def op5_wavelet_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_shards.token_file_digests(
        table(spark, sf_dir, "documents"), TOKENIZER_FILE, end_id=2
    )


@query
def op6_exact_dedup_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.deduplicate(table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256"
    )


ORACLE_SQL["op6_exact_dedup_stream"] = """
WITH texts AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') AS t
  FROM documents
)
SELECT doc_id,
       min(doc_id) OVER (PARTITION BY t) AS keep_id,
       count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY t) AS kept,
       sha256(t) AS text_sha256
FROM texts
"""


@query
def op7_jaccard_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    settings = jaccard.Settings(words=3, percent=90, slack=1.0)
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"), settings)


@query
def op8_secret_blob_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.find_secrets(table(spark, sf_dir, "documents"))


@query
def op9_vector_collisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors.vector_components(table(spark, sf_dir, "embeddings"))


@query
def op10_language_ftrl(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.fit(language.learnable(docs, 4, 2))
    return held_out(language.predict_language(docs, model), 4, 2)


@query
def op11_ring_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ring_shards.shard_documents(table(spark, sf_dir, "documents"), shards=40)


@query
def op12_token_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_spans.alignment_counts(
        table(spark, sf_dir, "documents"), TOKENIZER_FILE, PIECE_FILE
    )


@query
def op13_skeleton_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.conversation_trie(table(spark, sf_dir, "conversations"))


# Paths as lists of md5 sums; crc32 by its eight steps for each byte of the decimal id.
ORACLE_SQL["op13_skeleton_trie"] = """
WITH rows AS (
  SELECT conv_id, turn,
         coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL
), marked AS (
  SELECT conv_id, turn, md5(length(role) || ' ' || role || text) AS mark,
         substr(sha256(length(role) || ' ' || role || text), 1, 32) AS tie,
         len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS words
  FROM rows
), own AS (
  SELECT conv_id, conv_id - conv_id % 20 AS base,
         list({'mark': mark, 'words': words} ORDER BY turn NULLS FIRST, tie) AS turns,
         xor(list_reduce(
           list_prepend(4294967295::BIGINT,
             list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
           lambda crc, byte: list_reduce(
             list_prepend(xor(crc, byte), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
             lambda c, step: xor(c >> 1, (c & 1) * 3988292384))
         ), 4294967295::BIGINT) % 4 AS h
  FROM marked GROUP BY conv_id
), rebuilt AS (
  SELECT own.conv_id,
         list_concat(coalesce(heads.turns, [])[1:own.h], own.turns[own.h + 1:]) AS path
  FROM own LEFT JOIN own heads ON heads.conv_id = own.base
), members AS (
  SELECT conv_id, d AS depth,
         list_transform(path[1:d], lambda x: x.mark) AS node,
         list_transform(path[1:d - 1], lambda x: x.mark) AS parent,
         CASE WHEN d > 0 THEN path[d].words END AS words,
         d = len(path) AS ends
  FROM (SELECT conv_id, path, unnest(range(0, len(path) + 1)) AS d FROM rebuilt)
), nodes AS (
  SELECT node, depth, min(conv_id) AS conv_id,
         CASE WHEN depth > 0 THEN any_value(parent) END AS parent,
         count(*) AS n_convs, any_value(words) AS words,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)
                         FILTER (WHERE ends), '')) AS ends_sha256
  FROM members GROUP BY node, depth
), counted AS (
  SELECT n.*, p.conv_id AS parent_conv_id,
         (SELECT count(*) FROM nodes c WHERE c.depth = n.depth + 1 AND c.parent = n.node)
           AS n_children
  FROM nodes n LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.node = n.parent
), above AS (
  SELECT node[1:d] AS top, d, (n_convs - 1) * words AS saved, n_children = 0 AS leaf
  FROM (SELECT *, unnest(range(0, depth + 1)) AS d FROM counted)
), summed AS (
  SELECT top, d, sum(coalesce(saved, 0)) AS saved_tokens, count(*) FILTER (WHERE leaf) AS n_leaves
  FROM above GROUP BY top, d
)
SELECT conv_id, depth::BIGINT AS depth, parent_conv_id, n_convs::BIGINT AS n_convs,
       n_children::BIGINT AS n_children, n_leaves::BIGINT AS n_leaves,
       saved_tokens::BIGINT AS saved_tokens, ends_sha256
FROM counted JOIN summed ON top = node AND d = depth
"""
