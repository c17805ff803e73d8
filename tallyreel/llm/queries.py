"""The registered corpus queries: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyreel.llm import bpe, cotraining, decontaminate, hilbert, language_id, license_scan, near_dedup, permutation_index
from tallyreel.llm import quotes, repeats, token_align, token_scan, whitening
from tallyreel.llm.common import table

RANKS = "byte_bpe_50k.tiktoken"
BYTE_LEVEL, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"
# Free in the rank file, and the public vocabulary's end-of-document id.
END_OF_DOCUMENT = 50256


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    dictionaries = language_id.learn(docs.filter(~language_id.held_out()))
    out = language_id.predict(docs, dictionaries)
    return out.select("doc_id", language_id.held_out().alias("held_out"), "lang_pred", "score", "margin", "rejected")


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return cotraining.score(docs, cotraining.fit(docs, table(spark, sf_dir, "labels")))


def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = near_dedup.near_classes(table(spark, sf_dir, "documents"))
    return classes.withColumn("kept", F.col("doc_id") == F.col("class_id"))


def op4_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("vector"))
    return permutation_index.nearest(vectors, vectors.filter("vec_id % 50 = 0").select("vec_id"), k=5)


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    blocks = token_scan.tokenize(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN, END_OF_DOCUMENT)
    return token_scan.count_tokens(token_scan.settle(blocks), END_OF_DOCUMENT)


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return bpe.encode_decode(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


def op7_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.reply_order(table(spark, sf_dir, "conversations"))


def op8_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert.shard_rows(table(spark, sf_dir, "documents"), shards=40)


def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.removal_digests(table(spark, sf_dir, "documents"))


def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_labels(license_scan.find_licenses(table(spark, sf_dir, "documents")))


def op12_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return token_align.align(docs, public_tokenizers.path(BYTE_LEVEL), public_tokenizers.path(PIECES))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("vector"))
    return whitening.whiten(vectors)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        op1_language_id,
        op2_quality_classifier,
        op3_minhash_near_dedup,
        op4_permutation_index,
        op5_token_counts,
        op6_byte_bpe,
        op7_chat_formatting,
        op8_hilbert_shards,
        op9_benchmark_decontamination,
        op10_suffix_array_dedup,
        op11_license_scan,
        op12_cross_tokenizer_alignment,
        op13_embedding_whitening,
    )
}

# DuckDB SQL for the queries that SQL can express. The others are held against brute force in the tests.
ORACLE: dict[str, str] = {"op11_license_scan": license_scan.scan_sql()}

ORACLE["op7_chat_formatting"] = r"""
WITH RECURSIVE messages AS (SELECT row_number() OVER () AS m, conv_id, turn, role, text FROM conversations),
split AS (SELECT m, conv_id, turn, string_split_regex(coalesce(text, ''), '\r?\n') AS l FROM messages),
lines AS (SELECT m, conv_id, turn, unnest(l) AS line, generate_subscripts(l, 1) AS i FROM split),
levels AS (SELECT m, conv_id, turn, i, regexp_replace(line, '^(\s*>)+ ?', '') AS body,
                  length(regexp_replace(regexp_extract(line, '^(\s*>)+'), '[^>]', '', 'g')) AS level FROM lines),
starts AS (SELECT *, if(level = lag(level) OVER (PARTITION BY m ORDER BY i), 0, 1) AS begins FROM levels),
runs AS (SELECT *, sum(begins) OVER (PARTITION BY m ORDER BY i) AS run FROM starts),
passages AS (SELECT m, conv_id, turn, level, string_agg(body, chr(10) ORDER BY i) AS body FROM runs
             GROUP BY m, conv_id, turn, level, run),
own AS (SELECT m, conv_id, turn, coalesce(trim(string_agg(body, chr(10) ORDER BY i) FILTER (level = 0)), '') AS body
        FROM levels GROUP BY ALL),
parts AS (
    SELECT conv_id, turn, level, 0 AS part, body FROM passages
    UNION ALL SELECT conv_id, turn, level, 1, body FROM levels
    UNION ALL SELECT conv_id, turn, 0, 0, body FROM own),
said AS (SELECT DISTINCT conv_id, turn, level, part, trim(regexp_replace(lower(body), '[^\p{L}\p{N}]+', ' ', 'g')) AS words
         FROM parts WHERE conv_id IS NOT NULL AND turn IS NOT NULL),
origins AS (SELECT conv_id, words, min(turn) AS origin FROM said WHERE level = 0 AND words <> '' GROUP BY ALL),
links AS (
    SELECT q.conv_id, q.turn, arg_min(origin, (level, part, -origin)) AS parent, count(*) AS linked
    FROM said q JOIN origins o ON o.conv_id = q.conv_id AND o.words = q.words AND origin < q.turn
    WHERE level > 0 GROUP BY ALL),
climbs AS (
    SELECT conv_id, turn, parent AS root FROM links
    UNION ALL
    SELECT c.conv_id, c.turn, l.parent FROM climbs c JOIN links l ON l.conv_id = c.conv_id AND l.turn = c.root),
threads AS (SELECT conv_id, turn, min(root) AS root FROM climbs GROUP BY ALL),
quoted AS (SELECT m, (count(*) FILTER (level > 0))::int AS quoted FROM passages GROUP BY m),
placed AS (
    SELECT x.conv_id, x.turn, x.role, parent, coalesce(root, x.turn) AS thread, quoted,
           coalesce(linked, 0) AS linked, own.body AS text
    FROM messages x JOIN own USING (m) JOIN quoted USING (m)
    LEFT JOIN links l ON l.conv_id = x.conv_id AND l.turn = x.turn
    LEFT JOIN threads t ON t.conv_id = x.conv_id AND t.turn = x.turn)
SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY thread NULLS LAST, turn NULLS LAST, role NULLS LAST,
                                                                 text NULLS LAST) AS position,
       turn, role, parent, thread, quoted, linked, text,
       '<|' || coalesce(role, 'unknown') || '|>' || chr(10) || text || chr(10) || '<|end|>' || chr(10) AS formatted
FROM placed"""
