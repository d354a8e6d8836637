"""The queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from smelter.llm.exact_dedup import exact_duplicates
from smelter.llm.hard_negatives import hard_negatives
from smelter.llm.html_blocks import extract_main_text
from smelter.llm.licenses import scan_licenses
from smelter.llm.line_dedup import line_report
from smelter.llm.mixing import mix
from smelter.llm.ngram_join import similar_documents
from smelter.llm.packing import pack
from smelter.llm.pii import pseudonymise
from smelter.llm.quality import assess
from smelter.llm.secret_scan import scan_secrets
from smelter.llm.sharding import shard
from smelter.llm.whitening import whiten


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet")


def op1_jump_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(documents(spark, sf_dir))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir))


def op3_isolation_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assess(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op4_block_labeller(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(documents(spark, sf_dir))


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_documents(documents(spark, sf_dir), k=3, num=90, den=100)


def op7_source_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_report(documents(spark, sf_dir))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(documents(spark, sf_dir))


def op10_feistel_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonymise(documents(spark, sf_dir))


def op11_grammar_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(documents(spark, sf_dir))


def op12_choleskyqr_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(embeddings(spark, sf_dir))


def op13_cover_tree_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives(embeddings(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_jump_shards": op1_jump_shards,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_isolation_rules": op3_isolation_rules,
    "op4_block_labeller": op4_block_labeller,
    "op5_license_scan": op5_license_scan,
    "op6_ngram_join": op6_ngram_join,
    "op7_source_schedule": op7_source_schedule,
    "op8_line_dedup": op8_line_dedup,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_feistel_pseudonyms": op10_feistel_pseudonyms,
    "op11_grammar_secrets": op11_grammar_secrets,
    "op12_choleskyqr_whitening": op12_choleskyqr_whitening,
    "op13_cover_tree_negatives": op13_cover_tree_negatives,
}

ORACLE: dict[str, str] = {
    "op7_source_schedule": r"""
        WITH sized AS (
            SELECT doc_id, source,
                   coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
                   md5('7:' || coalesce(doc_id::VARCHAR, '')) AS shuffle
            FROM documents),
        sources AS (
            SELECT source, sum(size)::BIGINT AS s,
                   [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w
            FROM sized GROUP BY source),
        filled AS (
            SELECT *,
                   (1.5::DOUBLE * sum(s) OVER () - coalesce(sum(2 * s) OVER before, 0)::DOUBLE)
                   / (sum(w) OVER () - coalesce(sum(w) OVER before, 0))::DOUBLE AS level
            FROM sources
            WINDOW before AS (ORDER BY s::DOUBLE / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
        water AS (
            SELECT arg_min(level, s::DOUBLE / w) AS level FROM filled WHERE 2 * s > level * w),
        plan AS (
            SELECT f.source, f.s, CASE WHEN 2 * f.s <= f.level * f.w OR water.level IS NULL THEN (2 * f.s)::DOUBLE
                                       ELSE water.level * f.w END AS target
            FROM filled f, water),
        placed AS (
            SELECT doc_id, d.source, size, s, target, floor(target + 0.5)::BIGINT AS t,
                   coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY shuffle, doc_id
                                            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
            FROM sized d JOIN plan p ON d.source IS NOT DISTINCT FROM p.source)
        SELECT doc_id, size, s AS source_size, target,
               greatest(0, least(size, t - start)) + greatest(0, least(size, t - s - start)) AS taken
        FROM placed""",
    "op9_exact_dedup": """
        WITH d AS (
            SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
            FROM documents)
        SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id,
               count(*) OVER (PARTITION BY t) AS group_size,
               doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
        FROM d""",
    "op13_cover_tree_negatives": """
        WITH x AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   list_transform(embedding, lambda c: floor(256 * c::DOUBLE)) AS v
            FROM embeddings
            WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
        met AS (
            SELECT a.vec_id AS anchor_id, c.vec_id AS id, a.label = c.label AS same,
                   list_inner_product(a.v, c.v)::BIGINT AS score
            FROM x a JOIN x c ON a.vec_id % 50 = 0 AND a.vec_id <> c.vec_id),
        positives AS (
            SELECT anchor_id, id AS positive_id, score AS positive_score FROM met WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
        negatives AS (
            SELECT p.*, m.id AS negative_id, m.score AS negative_score,
                   row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY m.score DESC, m.id) AS place
            FROM positives p JOIN met m ON m.anchor_id = p.anchor_id AND NOT m.same
              AND 50 * positive_score <= 100 * m.score AND 100 * m.score <= 95 * positive_score)
        SELECT anchor_id, positive_id, place::INTEGER AS rank, negative_id, positive_score, negative_score
        FROM negatives WHERE place <= 3""",
}
