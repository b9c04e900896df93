"""The queries of the text operators, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from panelcraft.llm import (fim_assembly, host_trust, license_scan, line_dedup, masked_lm, merkle_manifest, oracle, piece_codec,
                            quality_llr, rans_store, simhash_grid, slack_packing, toxicity_channel, winnowing)
from panelcraft.llm.common import documents, labels


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_codec.digests(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    weights = quality_llr.bucket_weights(docs, quality_llr.trusted_sample(labels(spark, sf_dir)))
    return quality_llr.verdicts(docs, weights)


def op3_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnowing.compare_edited(documents(spark, sf_dir))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return slack_packing.pack_documents(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_grid.near_duplicates(documents(spark, sf_dir))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return toxicity_channel.judgements(docs, toxicity_channel.train(docs, labels(spark, sf_dir)))


def op7_masked_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return masked_lm.train_and_score(documents(spark, sf_dir))


def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_trust.verdicts(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rans_store.write_and_read(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), vocab=49_408)


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.report(documents(spark, sf_dir), whole_lines=True)


def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.report(documents(spark, sf_dir))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim_assembly.round_trip(documents(spark, sf_dir))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle_manifest.report(documents(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_quality_rules": op2_quality_rules,
    "op3_winnowing": op3_winnowing,
    "op4_best_fit_packing": op4_best_fit_packing,
    "op5_simhash": op5_simhash,
    "op6_toxicity": op6_toxicity,
    "op7_masked_lm": op7_masked_lm,
    "op8_url_filters": op8_url_filters,
    "op9_token_files": op9_token_files,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_license_scan": op11_license_scan,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_merkle_manifest": op13_merkle_manifest,
}

ORACLE_SQL: dict[str, str] = oracle.SQL
