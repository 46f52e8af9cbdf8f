"""The operators as queries over whole tables, and their SQL twins where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from segmart.llm import (
    bpe, decontamination, exact_dedup, hard_negatives, jaccard_join, lexical_search, lm_scoring, packing,
    quality_classifier, quality_rules, substring_dedup, token_files, toxicity,
)
from segmart.llm.common import documents
from segmart.llm.tokens import Vocabulary
from segmart.session import scratch_path


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def vocabulary() -> Vocabulary:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return Vocabulary.read(path, public_tokenizers.PATTERN)


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(packing.token_pieces(documents(spark, sf_dir), vocabulary()))


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    ranks = bpe.Ranks.read(path, public_tokenizers.PATTERN)
    return bpe.round_trip_digests(documents(spark, sf_dir), ranks)


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = substring_dedup.repeated_spans(documents(spark, sf_dir))
    return spans.select("doc_id", "start", "stop", "n_words", "keep_id")


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.quality(documents(spark, sf_dir), labels(spark, sf_dir))


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.lm_scores(documents(spark, sf_dir), vocabulary())


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(documents(spark, sf_dir), labels(spark, sf_dir))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    folder = scratch_path(spark, "token-files")
    manifest = token_files.write_token_files(docs, folder, vocabulary())
    return token_files.read_token_files(manifest, folder, docs.schema["doc_id"].dataType)


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.groups_with_digests(documents(spark, sf_dir))


def op9_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    rule = jaccard_join.Similarity(k=3, percent=90)
    return jaccard_join.jaccard_components(documents(spark, sf_dir), rule).drop("key")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality_rules.stored_ledger(documents(spark, sf_dir))
    base = quality_rules.passes("base-1")
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~base).alias("base_failed"), quality_rules.passes(quality_rules.CURRENT).alias("kept"),
        "fail_bits",
    )


def benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/benchmark.parquet")


def op11_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination(documents(spark, sf_dir), benchmark(spark, sf_dir))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(vectors, label=moved)


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(documents(spark, sf_dir), benchmark(spark, sf_dir))


QUERIES = {
    query.__name__: query
    for query in (
        op1_best_fit_packing, op2_byte_bpe, op3_substring_dedup, op4_quality_classifier,
        op5_lm_scoring, op6_toxicity, op7_token_files, op8_exact_dedup, op9_ngram_jaccard, op10_quality_rules,
        op11_benchmark_decontamination, op12_hard_negatives, op13_lexical_search,
    )
}

ORACLE = {
    "op8_exact_dedup": r"""
        WITH d AS (
            SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm
            FROM documents)
        SELECT doc_id,
               min(doc_id) OVER (PARTITION BY norm) AS keep_id,
               count(*) OVER (PARTITION BY norm) AS group_size,
               doc_id = min(doc_id) OVER (PARTITION BY norm) AS kept,
               sha256(norm) AS text_sha256
        FROM d""",
    "op10_quality_rules": r"""
        WITH d AS (
            SELECT doc_id, coalesce(text, '') AS text,
                   list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
                   list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
            FROM documents),
        windows AS (
            SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM d),
        counted AS (
            SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, ws[i], ws[i + 1], ws[i + 2]) AS n FROM windows),
        covered AS (
            SELECT doc_id, count(DISTINCT p) AS n_repeat_words
            FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM counted WHERE n > 1) GROUP BY doc_id),
        m AS (
            SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words,
                   CAST(coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
                   CAST(length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
                   CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
                   CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
                   len(ls) AS n_lines,
                   length(regexp_replace(text, '[^\p{Lu}]+', '', 'g')) AS n_upper
            FROM d LEFT JOIN covered USING (doc_id)),
        f AS (
            SELECT *, CAST(
                   CASE WHEN n_words < 50 THEN 1 ELSE 0 END
                 + CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END
                 + CASE WHEN 100 * n_symbols > 10 * n_words THEN 4 ELSE 0 END
                 + CASE WHEN 100 * n_dup_lines > 30 * n_lines THEN 8 ELSE 0 END
                 + CASE WHEN 100 * n_upper > 50 * word_chars THEN 16 ELSE 0 END
                 + CASE WHEN word_chars < 2 * n_words OR word_chars > 20 * n_words THEN 32 ELSE 0 END
                   AS BIGINT) AS fail_bits FROM m)
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
               (fail_bits & 3) <> 0 AS base_failed, (fail_bits & 55) = 0 AS kept, fail_bits
        FROM f""",
    "op11_benchmark_decontamination": r"""
        WITH d AS (
            SELECT row_number() OVER () AS row, doc_id, list_filter(string_split_regex(
                       translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws
            FROM documents),
        b AS (
            SELECT item_id, list_filter(string_split_regex(
                       translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws
            FROM benchmark),
        item_windows AS (
            SELECT DISTINCT item_id, least(len(ws), 10) AS size,
                   unnest(list_transform(range(1, len(ws) - least(len(ws), 10) + 2),
                                         lambda i: array_to_string(ws[i : i + least(len(ws), 10) - 1], ' '))) AS win
            FROM b WHERE len(ws) > 0),
        sizes AS (SELECT DISTINCT size FROM item_windows),
        doc_windows AS (
            SELECT row, size, i, array_to_string(ws[i : i + size - 1], ' ') AS win
            FROM (SELECT row, ws, size, unnest(range(1, len(ws) - size + 2)) AS i FROM d, sizes)),
        found AS (
            SELECT row, i, size, win FROM doc_windows SEMI JOIN item_windows USING (size, win)),
        hits AS (
            SELECT row, count(DISTINCT p) AS n_hit
            FROM (SELECT row, unnest(range(i, i + size)) AS p FROM found) GROUP BY row),
        items AS (
            SELECT row, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
            FROM (SELECT DISTINCT row, CAST(item_id AS VARCHAR) AS id
                  FROM found JOIN item_windows USING (size, win)) GROUP BY row)
        SELECT doc_id, CAST(coalesce(len(ws), 0) AS BIGINT) AS n_words,
               CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
               sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
        FROM d LEFT JOIN hits USING (row) LEFT JOIN items USING (row)""",
    "op12_hard_negatives": r"""
        WITH v AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS x
            FROM embeddings
            WHERE label IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        scored AS (
            SELECT a.vec_id AS anchor_id, a.label AS anchor_label, v.vec_id, v.label,
                   CAST(list_dot_product(a.x, v.x) AS BIGINT) AS score
            FROM v a, v WHERE a.vec_id % 100 = 0 AND a.vec_id <> v.vec_id),
        positives AS (
            SELECT anchor_id, anchor_label, vec_id AS positive_id, score AS positive_score
            FROM scored WHERE label = anchor_label
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
        SELECT p.anchor_id, positive_id,
               CAST(row_number() OVER w AS INTEGER) AS rank, s.vec_id AS negative_id, positive_score, s.score AS negative_score
        FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND s.label <> p.anchor_label
             AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score
        WINDOW w AS (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id)
        QUALIFY row_number() OVER w <= 10""",
    "op13_lexical_search": r"""
        WITH d AS (
            SELECT row_number() OVER () AS row, doc_id, list_filter(string_split_regex(
                       translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws
            FROM documents),
        q AS (
            SELECT DISTINCT item_id, unnest(list_filter(string_split_regex(
                       translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda x: x <> '')) AS term
            FROM benchmark),
        corpus AS (SELECT count(*) AS N, CAST(sum(len(ws)) AS BIGINT) AS L FROM d WHERE len(ws) > 0),
        tf AS (SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(ws) AS term FROM d) GROUP BY row, term),
        weights AS (
            SELECT term, CAST(floor(1000 * ln(CAST(2 * N + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
            FROM tf, corpus GROUP BY term, N),
        lengths AS (SELECT row, doc_id, 50 + (50 * len(ws) * N) // L AS m FROM d, corpus WHERE len(ws) > 0),
        scored AS (
            SELECT item_id, row, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
            FROM q JOIN tf USING (term) JOIN weights USING (term) JOIN lengths USING (row) GROUP BY item_id, row)
        SELECT item_id, CAST(row_number() OVER w AS INTEGER) AS rank, doc_id, score
        FROM scored JOIN lengths USING (row) WHERE score > 0
        WINDOW w AS (PARTITION BY item_id ORDER BY score DESC, doc_id)
        QUALIFY row_number() OVER w <= 50""",
}
