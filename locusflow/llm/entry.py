"""Queries of this subpackage for the driver: one per operator, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from locusflow.llm.common import documents


def op1_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    from locusflow.llm.language_id import language_id

    return language_id(documents(spark, sf_dir))


def op2_huffman_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from locusflow.llm.huffman_ids import round_trip

    return round_trip(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), end_id=2)


def op3_variable_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    from locusflow.llm.packing import pack

    return pack(documents(spark, sf_dir))


def op4_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from locusflow.llm.spotsigs import edit_report

    return edit_report(documents(spark, sf_dir))


def op5_compression_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    from locusflow.llm.compression_quality import compression_bands

    return compression_bands(documents(spark, sf_dir))


def op6_toxicity_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    from locusflow.llm.toxicity import toxicity

    return toxicity(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op7_simhash_bk_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    from locusflow.llm.simhash_bk import near_duplicates

    return near_duplicates(documents(spark, sf_dir))


def op8_license_dice(spark: SparkSession, sf_dir: str) -> DataFrame:
    from locusflow.llm.licenses import scan

    return scan(documents(spark, sf_dir))


def op9_rank_array_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from locusflow.llm.bpe import round_trip

    return round_trip(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


def op10_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from locusflow.llm.suffix_dedup import removal_digests

    return removal_digests(documents(spark, sf_dir))


def op11_prefix_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from locusflow.llm.chat_prefixes import HOSTILE, HOSTILE_SCHEMA, round_trip

    given = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    return round_trip(given.unionByName(spark.createDataFrame(HOSTILE, HOSTILE_SCHEMA)))


def op12_filter_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    from locusflow.llm.filter_audit import interactions

    return interactions(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from locusflow.llm.hard_negatives import hard_negatives

    return hard_negatives(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op") and name[2].isdigit()}


def oracle_sql() -> dict[str, str]:
    from locusflow.llm.chat_prefixes import round_trip_sql
    from locusflow.llm.filter_audit import interactions_sql
    from locusflow.llm.hard_negatives import hard_negatives_sql
    from locusflow.llm.licenses import scan_sql

    return {"op8_license_dice": scan_sql(), "op11_prefix_targets": round_trip_sql(), "op12_filter_interactions": interactions_sql(), "op13_hard_negatives": hard_negatives_sql()}
