"""The registered queries ``opN_<name>``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from bankops.llm import (
    binary_ids, decontamination, filter_audit, importance, jaccard, language, licenses, packing, pii, quality, sharding, simhash, sql,
    token_counts,
)
from bankops.llm.registry import ORACLES, QUERIES, query, read
from bankops.session import scratch_path

__all__ = ["ORACLES", "QUERIES"]


@query("op4_pack")
def op4_pack(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(read(spark, folder, "documents"))


@query("op7_binary_ids")
def op7_binary_ids(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "ids")
    binary_ids.write_ids(read(spark, folder, "documents"), path)
    return binary_ids.read_ids(spark, path, with_ids=False)


@query("op8_token_counts")
def op8_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.count_tokens(read(spark, folder, "documents"))


@query("op5_jaccard_join", sql.JACCARD)
def op5_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.jaccard_components(read(spark, folder, "documents"))


@query("op10_quality", sql.QUALITY)
def op10_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality_rules(read(spark, folder, "documents"))


@query("op3_decontaminate")
def op3_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.find_leaks(read(spark, folder, "documents"), read(spark, folder, "benchmark"))


@query("op9_language")
def op9_language(spark: SparkSession, folder: str) -> DataFrame:
    return language.identify(read(spark, folder, "documents"))


@query("op1_shuffle_shards")
def op1_shuffle_shards(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "shards")
    sharding.write_shards(read(spark, folder, "documents"), path)
    return sharding.digest(spark, path)


@query("op2_license_scan")
def op2_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.license_scan(read(spark, folder, "documents"))


@query("op6_pii")
def op6_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.pii_report(read(spark, folder, "documents"))


@query("op11_filter_audit", sql.AUDIT)
def op11_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    return filter_audit.audit(read(spark, folder, "documents"), read(spark, folder, "labels"))


@query("op12_importance", sql.IMPORTANCE)
def op12_importance(spark: SparkSession, folder: str) -> DataFrame:
    return importance.resample(read(spark, folder, "documents"), read(spark, folder, "benchmark"), max_words=1)


@query("op13_simhash")
def op13_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.simhash_components(read(spark, folder, "documents"))
