"""Registered queries opN_<name>: thin wrappers that read the tables, call the operator with production parameters and derive the result columns."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import op1_license, op2_bpe, op3_langid, op4_decontaminate, op5_html, op6_mixing, op7_linededup, op8_quality, op9_sharding, op10_jaccard
from tessera.llm.common import ascii_crc, table

#: Folder of the public vocabulary files. TESSERA_TOKENIZERS names another one.
TOKENIZERS = os.environ.get("TESSERA_TOKENIZERS", "")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    if TOKENIZERS:
        return os.path.join(TOKENIZERS, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op1_license.summary(op1_license.scan(table(spark, sf_dir, "documents")))


def op2_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op2_bpe.encode_documents(table(spark, sf_dir, "documents"), tokenizer_path())


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("_held", F.coalesce(ascii_crc("doc_id") % 3 == 1, F.lit(False)))
    model = op3_langid.train(docs.where(~F.col("_held")))
    return op3_langid.predict(docs, model).withColumn("held_out", F.coalesce(ascii_crc("doc_id") % 3 == 1, F.lit(False))).select("doc_id", "held_out", "lang_pred", "score")


def op4_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op4_decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op5_html.extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op6_mixing_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = F.coalesce(ascii_crc("doc_id") % 5 == 1, F.lit(False))
    scored = op6_mixing.score(table(spark, sf_dir, "documents").select("doc_id", "text", (~held).alias("training")))
    return scored.select("doc_id", held.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "total_bits", "n_bytes")


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op7_linededup.digest(op7_linededup.dedup(table(spark, sf_dir, "documents"), least_documents=10))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = op8_quality.fit(docs, table(spark, sf_dir, "labels"))
    return op8_quality.judge(docs, model).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score")


def op9_sharding_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = op9_sharding.interleave(table(spark, sf_dir, "documents"), shards=16)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "source", "position")


def op10_jaccard_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op10_jaccard.jaccard_components(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_license_scan": op1_license_scan,
        "op2_bpe_codec": op2_bpe_codec,
        "op3_language_id": op3_language_id,
        "op4_benchmark_leaks": op4_benchmark_leaks,
        "op5_html_text": op5_html_text,
        "op6_mixing_score": op6_mixing_score,
        "op7_line_dedup": op7_line_dedup,
        "op8_quality_rules": op8_quality_rules,
        "op9_sharding_mix": op9_sharding_mix,
        "op10_jaccard_components": op10_jaccard_components,
    }


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL for the queries that SQL can express."""
    return {"op7_line_dedup": LINE_DEDUP}


LINE_DEDUP = r"""
WITH lines AS (
  SELECT doc_id, i, line, lower_ascii.k AS k
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
       LATERAL (SELECT unnest(range(1, len(ls) + 1)) AS i, unnest(ls) AS line) u,
       LATERAL (SELECT translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k) lower_ascii),
heavy AS (SELECT k FROM lines WHERE k <> '' GROUP BY k HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE k IN (SELECT k FROM heavy)) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE k NOT IN (SELECT k FROM heavy)), '')) AS kept_sha256
FROM lines GROUP BY doc_id
"""
