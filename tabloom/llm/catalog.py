"""The numbered queries: each applies one operator to a whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tabloom.llm import bpe, decontamination, hard_negatives, licenses, mixing, pii, ppm, quality, secrets, sharding, simhash, topk, whitening
from tabloom.llm.common import table


def op1_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.detected(table(spark, folder, "documents"))


def op2_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(table(spark, folder, "documents"))


def op3_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.sharded(table(spark, folder, "documents"))


def op4_topk(spark: SparkSession, folder: str) -> DataFrame:
    return topk.top_k(table(spark, folder, "embeddings"))


def op5_lm_score(spark: SparkSession, folder: str) -> DataFrame:
    return ppm.scored(table(spark, folder, "documents"), pruned=False)


def op6_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.contaminations(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op7_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"))


def op8_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.scan(table(spark, folder, "documents"))


def op9_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.rated(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op10_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mixed(table(spark, folder, "documents"))


def op11_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten(table(spark, folder, "embeddings"))


def op12_bpe(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    return bpe.round_trip(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    return hard_negatives.mined(table(spark, folder, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_pii,
        op2_licenses,
        op3_sharding,
        op4_topk,
        op5_lm_score,
        op6_decontamination,
        op7_simhash,
        op8_secrets,
        op9_quality,
        op10_mixing,
        op11_whitening,
        op12_bpe,
        op13_hard_negatives,
    )
}
ORACLES: dict[str, str] = {
    "op2_licenses": licenses.ORACLE,
    "op6_decontamination": decontamination.ORACLE,
    "op13_hard_negatives": hard_negatives.ORACLE,
}
