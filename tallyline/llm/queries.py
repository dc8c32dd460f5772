"""The operators of this package as queries over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (
    divergence,
    exact_dedup,
    jaccard_join,
    language,
    mixing,
    packing,
    quality,
    secret_scan,
    sharding,
    spelling,
    substring_dedup,
    token_counts,
    toxicity,
)
from .common import documents, labels

Query = Callable[[SparkSession, str], DataFrame]


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir))


def op2_minimax_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(documents(spark, sf_dir))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(documents(spark, sf_dir))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(documents(spark, sf_dir))


def op5_raked_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir))


def op6_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify_all(documents(spark, sf_dir))


def op7_quality_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(documents(spark, sf_dir), labels(spark, sf_dir))


def op8_counterfactual_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_all(documents(spark, sf_dir), labels(spark, sf_dir))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(documents(spark, sf_dir))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.find_secrets(documents(spark, sf_dir))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(documents(spark, sf_dir))


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(documents(spark, sf_dir))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.source_divergence(documents(spark, sf_dir))


def all_queries() -> dict[str, Query]:
    return {
        fn.__name__: fn
        for fn in (
            op1_best_fit_packing, op2_minimax_sharding, op3_exact_dedup, op4_substring_dedup,
            op5_raked_mixing, op6_language_mixture, op7_quality_ratio,
            op8_counterfactual_toxicity, op9_jaccard_join, op10_secret_scan,
            op11_spelling_variants, op12_token_counts, op13_source_divergence,
        )
    }
