"""Registered queries of the operators of this subpackage, and the SQL of those that have one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from wordtide.llm import (
    attention, bpe, collocations, conversations, decontaminate, licenses, mixing, neardup, oracle, pieces, rules, substrings,
    suffixes, warc,
)
from wordtide.scratch import scratch_folder


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_minhash_near_dedup(spark, sf_dir):
    return neardup.near_duplicates(_table(spark, sf_dir, "documents"))


def op2_token_counts(spark, sf_dir):
    import public_tokenizers  # where the vocabulary files are; only this query needs it

    counted = bpe.token_counts(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op3_benchmark_decontamination(spark, sf_dir):
    documents, benchmark = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    return decontaminate.decontaminated(documents, benchmark).drop("items")


def op4_warc_round_trip(spark, sf_dir):
    folder = f"{scratch_folder(spark, 'warc')}/archives"
    return warc.round_trip(_table(spark, sf_dir, "pages"), folder)


def op5_quality_classifier(spark, sf_dir):
    found = attention.quality_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return found.select("doc_id", "held_out", "score", "predicted")


def op6_quality_rules(spark, sf_dir):
    return rules.quality_rules(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op7_source_mixing(spark, sf_dir):
    return mixing.mixed_sources(_table(spark, sf_dir, "documents"))


def op8_suffix_array_dedup(spark, sf_dir):
    cut = suffixes.suffix_dedup(_table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op9_license_scan(spark, sf_dir):
    found = licenses.license_matches(_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        F.size("matches").alias("n_licenses"),
        F.array_join("matches.license", ",").alias("licenses"),
        F.array_max("matches.containment").alias("containment"),
        F.array_min("matches.first_word").alias("first_word"),
    )


def op10_substring_dedup(spark, sf_dir):
    cut = substrings.substring_dedup(_table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op11_phrase_collocations(spark, sf_dir):
    return collocations.collocations(_table(spark, sf_dir, "documents"))


def op12_conversation_repair(spark, sf_dir):
    return conversations.repaired_conversations(_table(spark, sf_dir, "conversations"))


def op13_sentencepiece(spark, sf_dir):
    import public_tokenizers  # where the vocabulary files are

    return pieces.round_trips(_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_minhash_near_dedup": op1_minhash_near_dedup,
        "op2_token_counts": op2_token_counts,
        "op3_benchmark_decontamination": op3_benchmark_decontamination,
        "op4_warc_round_trip": op4_warc_round_trip,
        "op5_quality_classifier": op5_quality_classifier,
        "op6_quality_rules": op6_quality_rules,
        "op7_source_mixing": op7_source_mixing,
        "op8_suffix_array_dedup": op8_suffix_array_dedup,
        "op9_license_scan": op9_license_scan,
        "op10_substring_dedup": op10_substring_dedup,
        "op11_phrase_collocations": op11_phrase_collocations,
        "op12_conversation_repair": op12_conversation_repair,
        "op13_sentencepiece": op13_sentencepiece,
    }


def oracle_sql() -> dict[str, str]:
    return oracle.oracle_sql()
