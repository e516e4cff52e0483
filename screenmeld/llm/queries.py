"""Registered queries of the operators and their SQL twins where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from screenmeld.llm import (alignment, audit, extraction, fingerprints, language, line_dedup, mixing, neardup, packing, pii, quality,
                            shards, urls)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return register


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/pages.parquet")


@query("op1_line_dedup", r"""
WITH lines AS (
    SELECT doc_id, unnest(l) AS line, unnest(range(len(l))) AS pos
    FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)),
keyed AS (
    SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
common AS (
    SELECT key, max(doc_id) AS last FROM keyed WHERE length(key) >= 20
    GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
marked AS (
    SELECT k.*, c.key IS NOT NULL AND k.doc_id <> c.last AS gone FROM keyed k LEFT JOIN common c ON k.key = c.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id""")
def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = line_dedup.drop_repeated(documents(spark, sf_dir))
    return rows.select("doc.doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def vocabulary() -> dict[str, str]:
    """Places of the tokenizer files, which stay outside the repository."""
    return {"path": public_tokenizers.path("byte_bpe_50k.json"), "ranks": public_tokenizers.path("byte_bpe_50k.tiktoken"),
            "pattern": public_tokenizers.PATTERN}


@query("op2_best_fit_packing")
def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), **vocabulary())


@query("op3_language_crf")
def op3_language_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.language_id(documents(spark, sf_dir))


@query("op4_mix_sources")
def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.sample_plan(documents(spark, sf_dir))
    return plan.select("doc_id", "size", "source_size", "target", "taken", "source", F.col("copies"))


@query("op5_personal_data")
def op5_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(documents(spark, sf_dir))


@query("op6_quality_bands")
def op6_quality_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.compression_bands(documents(spark, sf_dir))


@query("op7_content_chunks")
def op7_content_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_edited(documents(spark, sf_dir))


@query("op8_url_filter")
def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.filter_urls(pages(spark, sf_dir))


@query("op9_extract_main_text")
def op9_extract_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.extract(pages(spark, sf_dir))


@query("op10_near_duplicates")
def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(documents(spark, sf_dir), words=2)


@query("op11_filter_audit", r"""
WITH given AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
firsts AS (SELECT t, min(doc_id) AS first FROM given GROUP BY t),
known AS (SELECT doc_id, max(CAST(quality = 1 AS INT)) AS good, max(CAST(toxic = 1 AS INT)) AS toxic FROM labels GROUP BY doc_id),
failed AS (
    SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
           CAST(len(w) < 200 AS INT) + 2 * CAST(100 * len(list_distinct(w)) < 50 * len(w) AS INT)
           + 4 * CAST(100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t) AS INT)
           + 8 * CAST(regexp_matches(t, '[#$%&*|]') AS INT) + 16 * CAST(coalesce(first < g.doc_id, FALSE) AS INT) AS bits
    FROM given g JOIN firsts USING (t) LEFT JOIN known k ON g.doc_id = k.doc_id),
combos AS (SELECT part, bits, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM failed GROUP BY part, bits),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM letters a, letters b, letters c, letters d, letters e
           WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
steps AS (
    SELECT filter_order, step, CAST(1 << (instr('ABCDE', filter_order[step]) - 1) AS INT) AS bit,
           CAST(list_sum([1 << (instr('ABCDE', x) - 1) FOR x IN string_split(filter_order[:step - 1], '') IF x <> '']) AS INT) AS before
    FROM orders, (SELECT CAST(unnest(range(1, 6)) AS INT) AS step))
SELECT part, filter_order, step,
       CAST(coalesce(sum(n) FILTER (bits & (bit | coalesce(before, 0)) = 0), 0) AS BIGINT) AS kept,
       CAST(coalesce(sum(n) FILTER (bits & bit <> 0 AND bits & coalesce(before, 0) = 0), 0) AS BIGINT) AS removed,
       CAST(coalesce(sum(n) FILTER (bits & bit <> 0 AND bits & coalesce(before, 0) <> 0), 0) AS BIGINT) AS redundant,
       CAST(coalesce(sum(n) FILTER (bits = bit), 0) AS BIGINT) AS unique_fails,
       CAST(coalesce(sum(good) FILTER (bits & bit <> 0 AND bits & coalesce(before, 0) = 0), 0) AS BIGINT) AS good_lost,
       CAST(coalesce(sum(toxic) FILTER (bits & bit <> 0 AND bits & coalesce(before, 0) = 0), 0) AS BIGINT) AS toxic_lost,
       CAST(coalesce(sum(n * 120 // greatest(bit_count(bits), 1)) FILTER (bits & bit <> 0), 0) AS BIGINT) AS shapley
FROM combos, steps GROUP BY part, filter_order, step""")
def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.filter_interactions(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


@query("op12_minimax_shards")
def op12_minimax_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.shard(documents(spark, sf_dir))


@query("op13_token_alignment")
def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(documents(spark, sf_dir), **vocabulary(), pieces=public_tokenizers.path("piece_bpe_32k.model"))
