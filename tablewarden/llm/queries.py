"""One query for each operator over its whole table, and SQL where SQL can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

import public_tokenizers
from tablewarden.llm import (
    langid, merkle, naming, ngram_join, packing, passages, phrases, quality, sharding,
    token_files, toxicity, turns, word_table,
)
from tablewarden.llm.tables import table


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score_toxicity(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")))


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join_documents(table(spark, sf_dir, "documents"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(table(spark, sf_dir, "documents"))


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return token_files.round_trip(table(spark, sf_dir, "documents"), path, end_id=2)


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.find_repeats(table(spark, sf_dir, "documents"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.identify(docs, langid.learn(docs))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return packing.pack_documents(table(spark, sf_dir, "documents"), path, end_id=0)


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"), shards=24)


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.fingerprint_documents(table(spark, sf_dir, "documents"))


def op10_word_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return word_table.encode_and_decode(table(spark, sf_dir, "documents"), path)


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turns.repair_damaged(table(spark, sf_dir, "conversations"))


def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.mine_phrases(table(spark, sf_dir, "documents"))


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return naming.find_copies(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_ngram_join": op2_ngram_join,
    "op3_quality_rules": op3_quality_rules,
    "op4_token_files": op4_token_files,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_language_id": op6_language_id,
    "op7_packing": op7_packing,
    "op8_sharding": op8_sharding,
    "op9_fingerprints": op9_fingerprints,
    "op10_word_table": op10_word_table,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_phrase_collocations": op12_phrase_collocations,
    "op13_exact_dedup": op13_exact_dedup,
}

SQL: dict[str, str] = {
    "op12_phrase_collocations": f"""
        WITH pieces AS (
            SELECT coalesce(lang, 'und') AS lang,
                   unnest(regexp_split_to_array(
                       translate(coalesce(text, ''), '{naming.UPPER}', '{naming.LOWER}'),
                       '[.,;:!?\\x0A-\\x0D]')) AS piece
            FROM documents
        ), worded AS (
            SELECT lang, list_filter(regexp_split_to_array(piece, '[ \\t]+'), lambda w: w <> '') AS w
            FROM pieces
        ), starts AS (
            SELECT lang, w, size, unnest(range(1, len(w) - size + 2)) AS i
            FROM worded, (VALUES (1), (2), (3), (4)) AS sizes(size)
        ), counted AS (
            SELECT lang, array_to_string(w[i : i + size - 1], ' ') AS phrase, size, count(*) AS f
            FROM starts GROUP BY ALL
        ), totals AS (
            SELECT lang, sum(f)::BIGINT AS n FROM counted WHERE size = 1 GROUP BY lang
        ), frequent AS (
            SELECT *, string_split(phrase, ' ') AS w FROM counted WHERE f >= 30
        ), cuts AS (
            SELECT lang, phrase, f AS a, k, array_to_string(w[1 : k], ' ') AS first_part,
                   array_to_string(w[k + 1 : size], ' ') AS rest
            FROM frequent, (VALUES (1), (2), (3)) AS cut(k) WHERE k < size
        ), scored AS (
            SELECT c.lang, c.phrase, c.a, k, x.f AS l, y.f AS r,
                   (2000000::HUGEINT * c.a // (x.f::HUGEINT + y.f))::BIGINT AS score
            FROM cuts c
            JOIN frequent x ON x.lang = c.lang AND x.phrase = c.first_part
            JOIN frequent y ON y.lang = c.lang AND y.phrase = c.rest
        ), weakest AS (
            SELECT * FROM scored
            QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
        ), inside AS (
            SELECT lang, array_to_string(w[i : i + m - 1], ' ') AS phrase, max(f) AS longer
            FROM (SELECT *, unnest(range(1, size - m + 2)) AS i
                  FROM frequent, (VALUES (2), (3)) AS part(m) WHERE m < size)
            GROUP BY ALL
        ), ranked AS (
            SELECT s.lang, s.phrase, a, l, r, score,
                   row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, s.phrase) AS rank
            FROM weakest s LEFT JOIN inside USING (lang, phrase)
            WHERE longer IS NULL OR 100::HUGEINT * longer < 80::HUGEINT * a
        )
        SELECT lang, rank, phrase, a, l, r, n, score
        FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
    """,
    "op13_exact_dedup": f"""
        WITH folded AS (
            SELECT doc_id, translate(coalesce(text, ''), '{naming.UPPER}', '{naming.LOWER}') AS body
            FROM documents
        )
        SELECT doc_id,
               max(doc_id) OVER same AS keep_id,
               count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept,
               sha256(body) AS text_sha256
        FROM folded WINDOW same AS (PARTITION BY body)
    """,
}
