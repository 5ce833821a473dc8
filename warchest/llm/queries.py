"""The registered corpus queries: each applies an operator to its whole table and derives the digest columns."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from warchest.llm import language_id, license_scan, quality_votes, simhash, toxicity
from warchest.llm.common import fold, spool, table
from warchest.llm.decontaminate import contaminated
from warchest.llm.exact_dedup import exact_duplicates
from warchest.llm.fp_search import search
from warchest.llm.hard_negatives import hard_negatives
from warchest.llm.lm_score import score_texts
from warchest.llm.mixing import mix, taken_words
from warchest.llm.sharding import shard_rows
from warchest.llm.token_counts import count_tokens

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
TOKEN_LIMIT = 2048
SHARDS = 8


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", fold(F.col("doc_id"), 5, 0))
    model = language_id.train(docs.where(F.col("doc_id").isNotNull() & ~F.col("held_out")))
    return language_id.predict(docs, model, keep=["doc_id", "held_out"])


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", fold(F.col("doc_id"), 7, 2))
    return score_texts(docs, F.col("doc_id").isNotNull() & ~F.col("held_out"), keep=["doc_id", "held_out"])


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taken_words(*mix(table(spark, sf_dir, "documents"))).select("doc_id", "size", "source_size", "target", "taken", "source")


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.scan(table(spark, sf_dir, "documents"))
    starts = F.transform("base", lambda b: b["first"].cast("long"))
    base, own = license_scan.labels_of(F.col("base")), license_scan.labels_of(F.col("detections"))
    return found.select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        license_scan.joined(base).alias("base_labels"), license_scan.joined(F.concat(base, own)).alias("labels"),
        license_scan.confidence(F.col("detections")).alias("score"),
    )


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hexed(F.col("fp")).alias("fingerprint"), "component_id")


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "coverage", "n_words", F.size("tiles").alias("n_tiles"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", fold(F.col("doc_id"), 5, 0))
    model = toxicity.train(docs.where(~F.col("held_out")), table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model, keep=["doc_id", "held_out"]).withColumn("predicted", toxicity.verdict(F.col("score")))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = count_tokens(table(spark, sf_dir, "documents"), TOKENIZER)
    return counts.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shard_rows(table(spark, sf_dir, "documents"), SHARDS)
    return placed.withColumns({"law": F.lit("rows"), "grown_shard": F.lit(None).cast("int")})


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, sf_dir, "embeddings").withColumn("label", label), F.col("vec_id") % 100 == 0)


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    voted = spool(quality_votes.votes(quality_votes.counts(table(spark, sf_dir, "documents"))), "votes")
    return quality_votes.judge(voted, quality_votes.fit(voted)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "posterior")


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": op1_language_id,
    "op2_lm_scoring": op2_lm_scoring,
    "op3_mixing": op3_mixing,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_license_scan": op5_license_scan,
    "op6_simhash": op6_simhash,
    "op7_decontamination": op7_decontamination,
    "op8_toxicity": op8_toxicity,
    "op9_token_counts": op9_token_counts,
    "op10_sharding": op10_sharding,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_quality_rules": op12_quality_rules,
    "op13_lexical_search": op13_lexical_search,
}

ORACLES: dict[str, str] = {
    "op4_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))""",
    "op11_hard_negatives": """
        WITH vectors AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
            FROM embeddings
            WHERE label IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        pairs AS (
            SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
                   CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
            FROM vectors a JOIN vectors b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
        positives AS (
            SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM pairs WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
        SELECT p.anchor_id, p.positive_id,
               CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.other_id) AS INTEGER) AS rank,
               n.other_id AS negative_id, p.positive_score, n.score AS negative_score
        FROM positives p JOIN pairs n ON n.anchor_id = p.anchor_id AND NOT n.same
         AND 80 * p.positive_score <= 100 * n.score AND n.score <= p.positive_score
        QUALIFY rank <= 5""",
    "op13_lexical_search": r"""
        WITH terms AS (
            SELECT doc_id, unnest(regexp_extract_all(
                       translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
            FROM documents),
        held AS (SELECT doc_id, term, count(*) AS tf FROM terms GROUP BY ALL),
        sizes AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM held GROUP BY doc_id),
        whole AS (SELECT count(*)::BIGINT AS big_n, sum(n)::BIGINT AS big_l FROM sizes),
        lengths AS (SELECT doc_id, 100 - 75 + ((75 * n * big_n) // big_l) AS m FROM sizes, whole),
        weights AS (
            SELECT term, floor(1000 * ln((2 * big_n + 2) / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
            FROM held, whole GROUP BY term, big_n),
        asked AS (
            SELECT item_id, unnest(regexp_extract_all(
                       translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
            FROM benchmark),
        scored AS (
            SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
            FROM asked JOIN held USING (term) JOIN weights USING (term) JOIN lengths USING (doc_id) GROUP BY ALL)
        SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
        FROM scored WHERE score > 0 QUALIFY rank <= 10""",
}
